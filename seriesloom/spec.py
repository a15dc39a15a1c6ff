"""Which column plays which role in a panel."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import types as T

# As many pieces as the session has shuffle partitions.
AS_SESSION = 0


@dataclass(frozen=True)
class PanelSpec:
    """Roles of a panel's columns, one row per (series_key, order_col).

    ``drivers`` are the birth, death and migration rate, in that order.

    ``origin`` is subtracted from the period before lines are fitted. Any value
    is right; one near the data keeps more digits.

    ``pieces`` is the number of pieces of equal rows that a panel is cut into,
    by series and period, so that no single task has to hold a whole series; by
    default as many as the session has shuffle partitions. ``None`` keeps each
    series in one piece: it saves writing the pieces, and is safe where the
    calendar bounds the number of rows per series (a row per month or day, say).
    """

    series_key: str = "series_key"
    order_col: str = "year"
    target: str = "population"
    drivers: tuple[str, str, str] = ("birth_rate", "death_rate", "migration_rate")
    origin: int = 0
    pieces: int | None = AS_SESSION

    def __post_init__(self):
        if len(self.drivers) != 3:
            raise ValueError("drivers must name the birth, death and migration rate")
        if self.pieces is not None and self.pieces < 0:
            raise ValueError("a panel cannot be cut into less than one piece")

    @property
    def variables(self) -> tuple[str, ...]:
        return (self.target, *self.drivers)

    @property
    def columns(self) -> tuple[str, ...]:
        return (self.series_key, self.order_col, *self.variables)

    def with_pieces(self, pieces: int | None) -> PanelSpec:
        return replace(self, pieces=pieces)

    def schema(
        self,
        key_type: T.DataType | None = None,
        order_type: T.DataType | None = None,
    ) -> T.StructType:
        """Declared schema of a panel file; values are doubles from the start."""
        fields = [
            T.StructField(self.series_key, key_type or T.LongType()),
            T.StructField(self.order_col, order_type or T.IntegerType()),
        ]
        fields += [T.StructField(v, T.DoubleType()) for v in self.variables]
        return T.StructType(fields)
