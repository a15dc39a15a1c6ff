"""Small panels made by rule."""

import random

from seriesloom.spec import PanelSpec

WHOLE = PanelSpec(pieces=None)

VALUES = "population double, birth_rate double, death_rate double, migration_rate double"
SCHEMA = f"series_key long, year int, {VALUES}"


def make(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def one_series(spark, populations, key=1, start=2000, births=None, deaths=None):
    births = births or [10.0 + i for i in range(len(populations))]
    deaths = deaths or [5.0 + 2 * i for i in range(len(populations))]
    rows = [
        (key, start + i, p, births[i], deaths[i], 1.0 - i) for i, p in enumerate(populations)
    ]
    return make(spark, rows)


def random_rows(seed, series=4, longest=40, span=120, nulls=0.1):
    """Series of different length with gaps, negative periods and some missing targets."""
    source = random.Random(seed)
    rows = []
    for key in range(series):
        periods = source.sample(range(-span // 2, span), source.randint(1, longest))
        for t in periods:
            target = None if source.random() < nulls else float(source.randint(-5, 50))
            rates = [float(source.randint(0, 3)) for _ in range(3)]
            rows.append((key, t, target, *rates))
    source.shuffle(rows)
    return rows


def by_key(df, *order):
    keys = order or ("series_key", "year")
    return sorted(df.collect(), key=lambda r: tuple(r[k] for k in keys))
