"""The registered queries in SQL, for an independent engine on the same tables."""

from __future__ import annotations

MONTHS = """
panel AS (
  SELECT CAST(c_nationkey AS BIGINT) AS series_key,
         CAST(year(o_orderdate) * 12 + month(o_orderdate) - 1 AS INTEGER) AS year,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS population,
         100.0e0 * count(*) FILTER (WHERE o_orderpriority = '1-URGENT') / count(*) AS birth_rate,
         100.0e0 * count(*) FILTER (WHERE o_orderstatus = 'F') / count(*) AS death_rate,
         100.0e0 * (count(*) FILTER (WHERE o_orderpriority = '5-LOW')
                  - count(*) FILTER (WHERE o_orderpriority = '1-URGENT')) / count(*)
           AS migration_rate
  FROM orders JOIN customer ON o_custkey = c_custkey
  GROUP BY 1, 2
)"""

DAYS = """
panel AS (
  SELECT CAST(user_id AS BIGINT) AS series_key,
         CAST(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS INTEGER) AS year,
         CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS population,
         CAST(count(*) FILTER (WHERE event_type = 'signup') AS DOUBLE) AS birth_rate,
         CAST(count(*) FILTER (WHERE event_type = 'error') AS DOUBLE) AS death_rate,
         CAST(count(*) FILTER (WHERE event_type = 'click')
            - count(*) FILTER (WHERE event_type = 'view') AS DOUBLE) AS migration_rate
  FROM events
  GROUP BY 1, 2
)"""

SECONDS = """
panel AS (
  SELECT event_type AS series_key,
         CAST(floor(epoch(ts)) AS BIGINT) AS year,
         CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS population,
         CAST(count(*) AS DOUBLE) AS birth_rate,
         CAST(count(*) FILTER (WHERE value < 5) AS DOUBLE) AS death_rate,
         CAST(count(*) FILTER (WHERE value >= 20)
            - count(*) FILTER (WHERE value < 20) AS DOUBLE) AS migration_rate
  FROM events
  GROUP BY 1, 2
)"""

MONTH_ORIGIN = 1995 * 12
SECOND_ORIGIN = 19723 * 86400
DAY_ORIGIN = 19723

# Bits after the point that a line fit keeps.
AMOUNT = 10
PERCENT = 20
RATE = 30
SLOPE = 50

VARIABLES = ("population", "birth_rate", "death_rate", "migration_rate")
RATES = VARIABLES[1:]
SERIES = "PARTITION BY series_key"
ORDERED = "PARTITION BY series_key ORDER BY year"


def _round(expression: str, bits: int) -> str:
    steps = f"{2**bits}.0e0"
    # adding zero turns a negative zero into a plain one
    return f"(round_even(({expression}) * {steps}, 0) / {steps} + 0.0e0)"


def _list(items) -> str:
    return ", ".join(items)


def _lag(column: str, back: int) -> str:
    return f"lag({column}, {back}) OVER ({ORDERED})"


def _change(column: str) -> str:
    return f"({column} / nullif({_lag(column, 1)}, 0) - 1) * 100"


def _mean(column: str, rows: int) -> str:
    frame = f"OVER ({ORDERED} ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)"
    return (
        f"CASE WHEN count({column}) {frame} = {rows} "
        f"THEN sum({column}) {frame} / {rows}.0e0 END"
    )


def _select(panel: str, columns, tail: str = "") -> str:
    return f"WITH {panel} SELECT {_list(columns)} FROM panel {tail}"


def _full_features(panel: str, keys=("series_key", "year", "population")) -> str:
    derived = {}
    for back in (1, 2, 3):
        for v in VARIABLES:
            derived[f"{v}_lag_{back}"] = _lag(v, back)
    for v in VARIABLES:
        derived[f"{v}_yoy_change"] = _change(v)
        derived[f"{v}_diff"] = f"{v} - {_lag(v, 1)}"
        for rows in (2, 3):
            derived[f"{v}_ma_{rows}"] = _mean(v, rows)
    derived["birth_death_ratio"] = "birth_rate / nullif(death_rate, 0)"
    derived["natural_growth"] = "birth_rate - death_rate"
    derived["total_growth"] = "birth_rate - death_rate + migration_rate"
    columns = [*keys, *RATES, "CAST(year AS DOUBLE) * CAST(year AS DOUBLE) AS year_squared"]
    columns += [f"coalesce({sql}, 0.0e0) AS {name}" for name, sql in derived.items()]
    return _select(panel, columns)


def _lines(origin: int, columns=VARIABLES, source: str = "panel", name: str = "lines") -> str:
    x = f"CAST(year - {origin} AS DOUBLE)"
    fits = [
        f"regr_slope({c}, {x}) AS {c}_slope, regr_intercept({c}, {x}) AS {c}_intercept"
        for c in columns
    ]
    return f"""
{name} AS (
  SELECT series_key, max(year) AS last_period, arg_max(population, year) AS last_actual,
         {_list(fits)}
  FROM {source} GROUP BY series_key
)"""


def _forecast(origin: int, period: str = "INTEGER", columns=VARIABLES) -> str:
    """Lines at the next six periods, with the change from step to step."""
    at = f"CAST(last_period + step - {origin} AS DOUBLE)"
    values = [f"{c}_slope * {at} + {c}_intercept AS {c}" for c in columns]
    needed = ["population"] if "population" in columns else columns
    head = f"""{_lines(origin, columns)},
ahead AS (
  SELECT series_key, CAST(last_period + step AS {period}) AS year, last_actual,
         {_list(values)}
  FROM lines, (SELECT unnest([1, 2, 3, 4, 5, 6]) AS step) AS steps
  WHERE coalesce({_list(f"{c}_slope" for c in needed)}) IS NOT NULL
)"""
    if "population" not in columns:
        return head
    return f"""{head},
forecast AS (
  SELECT *, (population - previous) / previous * 100 AS year_over_year_change,
         population / 1.0e6 AS population_millions
  FROM (SELECT *, coalesce(lag(population) OVER ({ORDERED}), last_actual) AS previous
        FROM ahead) AS steps
)"""


def _predicted(origin: int) -> str:
    """The line through the first 80 % of each series, and every row against it."""
    return f"""
numbered AS (
  SELECT *, row_number() OVER ({ORDERED}) AS position, count(*) OVER ({SERIES}) AS length
  FROM panel
),
split AS (
  SELECT series_key, year, population,
         position > floor(CAST(length AS DOUBLE) * 0.8e0) AS is_test
  FROM numbered
),
training AS (SELECT * FROM split WHERE NOT is_test),
{_lines(origin, ["population"], "training", "training_lines")},
predicted AS (
  SELECT s.*, population_slope * CAST(s.year - {origin} AS DOUBLE) + population_intercept
           AS prediction
  FROM split AS s JOIN training_lines AS l ON s.series_key = l.series_key
)"""


def _measures(rounded: bool = True) -> list[str]:
    columns = []
    for part, where in (("train", "NOT is_test"), ("test", "is_test")):
        only = f"FILTER (WHERE {where} AND prediction IS NOT NULL)"
        error = "(population - prediction)"
        measures = {
            "mae": (f"avg(abs({error})) {only}", AMOUNT),
            "rmse": (f"sqrt(avg({error} * {error}) {only})", AMOUNT),
            "r2": (
                f"1 - sum({error} * {error}) {only}"
                f" / nullif(var_pop(population) {only} * count(*) {only}, 0)",
                PERCENT,
            ),
        }
        for name, (sql, places) in measures.items():
            value = _round(sql, places) if rounded else sql
            columns.append(f"{value} AS {part}_{name}")
    return columns


def _banded() -> str:
    return f"""{MONTHS}, {_predicted(MONTH_ORIGIN)}, {_forecast(MONTH_ORIGIN)},
errors AS (SELECT series_key, {_list(_measures(rounded=False))} FROM predicted GROUP BY 1),
banded AS (
  SELECT f.*, test_rmse,
         CASE WHEN test_rmse IS NULL OR test_rmse = 0 THEN population * 0.98e0
              ELSE population - 1.96e0 * test_rmse END AS lower_bound,
         CASE WHEN test_rmse IS NULL OR test_rmse = 0 THEN population * 1.02e0
              ELSE population + 1.96e0 * test_rmse END AS upper_bound
  FROM forecast AS f LEFT JOIN errors AS e ON f.series_key = e.series_key
)"""


def _report() -> str:
    """Growth of each forecast; expects panel and a table named forecast."""
    return """
known AS (
  SELECT series_key, min(year) AS start_year, max(year) AS end_year,
         arg_max(population, year) AS current_population
  FROM panel GROUP BY 1
),
expected AS (
  SELECT series_key, min(year) AS forecast_first, max(year) AS forecast_last,
         arg_max(population, year) AS forecast_population, count(*) AS steps
  FROM forecast GROUP BY 1
),
report AS (
  SELECT k.*, forecast_first, forecast_last, forecast_population, steps,
         forecast_population - current_population AS total_change,
         (forecast_population - current_population) / current_population * 100
           AS percent_change,
         (forecast_population - current_population) / current_population * 100 / steps
           AS avg_annual_growth
  FROM known AS k JOIN expected AS e ON k.series_key = e.series_key
)"""


def _combined(panel: str, origin: int, period: str) -> str:
    return f"""WITH {panel}, {_forecast(origin, period, ["population"])},
combined AS (
  SELECT series_key, year, population, 'Historical' AS kind FROM panel
  UNION ALL
  SELECT series_key, year, population, 'Forecast' AS kind FROM forecast
)
SELECT series_key, year AS "Year", CAST(round_even(population, 0) AS BIGINT) AS "Population",
       round_even({_change("population")}, 2) + 0.0e0 AS "YoY Change (%)", kind AS "Type"
FROM combined"""


def _splits(panel: str) -> str:
    return f"""WITH {panel}
SELECT series_key, year, population,
       row_number() OVER ({ORDERED}) > floor(CAST(count(*) OVER ({SERIES}) AS DOUBLE) * 0.8e0)
         AS is_test
FROM panel"""


def _random_split(panel: str, condition: str) -> str:
    digest = "md5(concat(CAST(series_key AS VARCHAR), '|', CAST(year AS VARCHAR), '|42'))"
    return f"""WITH {panel},
kept AS (
  SELECT * FROM (SELECT *, row_number() OVER ({ORDERED}) AS position FROM panel) AS numbered
  WHERE {condition}
)
SELECT series_key, year, population,
       row_number() OVER ({SERIES} ORDER BY {digest}, year)
         <= ceil(CAST(count(*) OVER ({SERIES}) AS DOUBLE) * 0.2e0) AS is_test
FROM kept"""


def _last(panel: str, count: int) -> str:
    return f"""WITH {panel}
SELECT * EXCLUDE (backwards) FROM (
  SELECT *, row_number() OVER ({SERIES} ORDER BY year DESC) AS backwards FROM panel
) AS ranked WHERE backwards <= {count}"""


def _long_enough(panel: str) -> str:
    return f"""WITH {panel}
SELECT * FROM panel
WHERE series_key IN (SELECT series_key FROM panel GROUP BY 1 HAVING count(*) >= 27)"""


def _coefficients(panel: str, origin: int, bits) -> str:
    columns = [
        f"{_round(f'{c}_{part}', bits(c, part))} AS {c}_{part}"
        for c in VARIABLES
        for part in ("slope", "intercept")
    ]
    return f"WITH {panel}, {_lines(origin)} SELECT series_key, {_list(columns)} FROM lines"


def _rates() -> list[str]:
    return [f"{_round(r, RATE)} AS {r}" for r in RATES]


def _recursion() -> str:
    """Mean of the last three values, rolled forward six periods."""
    return f"""WITH RECURSIVE {DAYS}, {_lines(DAY_ORIGIN, RATES)},
ends AS (
  SELECT series_key, population, row_number() OVER ({SERIES} ORDER BY year DESC) AS backwards
  FROM panel
),
states AS (
  SELECT l.series_key, l.last_period,
         max(population) FILTER (WHERE backwards = 1) AS one,
         coalesce(max(population) FILTER (WHERE backwards = 2), 0.0e0) AS two,
         coalesce(max(population) FILTER (WHERE backwards = 3), 0.0e0) AS three
  FROM lines AS l JOIN ends AS e ON l.series_key = e.series_key
  WHERE {" AND ".join(f"{r}_slope IS NOT NULL" for r in RATES)}
  GROUP BY 1, 2
),
rolled AS (
  SELECT series_key, last_period AS year, one, two, three, 0 AS step FROM states
  UNION ALL
  SELECT series_key, year + 1, (one + two + three) / 3.0e0, one, two, step + 1
  FROM rolled WHERE step < 6
)
SELECT r.series_key, CAST(r.year AS INTEGER) AS year, one AS population,
       {_list(_round(f"{c}_slope * CAST(r.year - {DAY_ORIGIN} AS DOUBLE) + {c}_intercept", RATE)
              + f" AS {c}" for c in RATES)}
FROM rolled AS r JOIN lines AS l ON r.series_key = l.series_key
WHERE step > 0"""


def _commas(value: str) -> str:
    return f"format('{{:,.0f}}', {value})"


def _fixed(value: str, unit: str) -> str:
    return f"format('{{:.2f}}{unit}', {value})"


def _stump(name: str, source: str, centre: str, penalty: int = 3) -> str:
    """The best single split of ``long``'s features for the residuals, and its leaves' values less the centre."""
    return f"""
{name}_cuts AS (
  SELECT feature, x, sum(residual) AS s, count(*) AS n
  FROM long JOIN {source} USING (series_key, year) WHERE NOT is_test GROUP BY feature, x
),
{name}_sums AS (
  SELECT feature, x, lead(x) OVER w AS next, sum(s) OVER w AS below, sum(n) OVER w AS n_below,
         sum(s) OVER (PARTITION BY feature) AS s, sum(n) OVER (PARTITION BY feature) AS n
  FROM {name}_cuts WINDOW w AS (PARTITION BY feature ORDER BY x)
),
{name}_best AS (
  SELECT feature AS best, (x + next) / 2 AS threshold FROM {name}_sums WHERE next IS NOT NULL
  ORDER BY below * below / n_below + (s - below) * (s - below) / (n - n_below) DESC LIMIT 1
),
{name}_side AS (
  SELECT series_key, year, x <= threshold AS is_below FROM long JOIN {name}_best ON feature = best
),
{name}_value AS (
  SELECT d.series_key, d.year, value FROM {name}_side d JOIN (
    SELECT is_below, sum(residual - centre) / (count(*) + {penalty}) AS value
    FROM {name}_side JOIN {source} USING (series_key, year),
         (SELECT {centre} AS centre FROM {source} WHERE NOT is_test LIMIT 1) AS c
    WHERE NOT is_test GROUP BY is_below
  ) USING (is_below)
)""".strip()


def all_sql() -> dict[str, str]:
    keys = ["series_key", "year", "population"]
    panel_columns = ["series_key", "year", *VARIABLES]
    bounds = [f"{_round(c, AMOUNT)} AS {c}" for c in ("population", "lower_bound", "upper_bound")]
    sql: dict[str, str] = {}

    sql["panel_nation_month"] = _select(MONTHS, panel_columns)
    sql["panel_user_day"] = _select(DAYS, panel_columns)
    sql["panel_kind_second"] = _select(SECONDS, panel_columns)
    sql["csv_round_trip"] = _select(DAYS, panel_columns)
    sql["lenient_cast"] = """
SELECT o_orderkey,
       CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_totalprice END AS amount,
       TRY_CAST(o_orderpriority AS DOUBLE) AS priority
FROM orders"""

    sql["series_profile"] = f"""WITH {DAYS}
SELECT series_key, min(year) AS first_period, max(year) AS last_period, count(*) AS rows,
       arg_max(population, year) AS last_value
FROM panel GROUP BY 1"""
    sql["min_history_filter"] = _long_enough(DAYS)
    sql["min_history_filter_long"] = f"""WITH {SECONDS},
lengths AS (SELECT series_key, count(*) AS n FROM panel GROUP BY series_key)
SELECT {_list(["series_key", "year", *VARIABLES])} FROM panel
WHERE series_key IN (
  SELECT series_key FROM lengths WHERE n >= (SELECT ceil(avg(n)) FROM lengths)
)"""
    sql["last_state"] = _last(DAYS, 1)
    sql["last_k_rows"] = _last(DAYS, 3)
    sql["last_k_rows_long"] = _last(SECONDS, 3)

    sql["trend_coefficients"] = _coefficients(
        MONTHS, MONTH_ORIGIN, lambda c, part: AMOUNT if c == "population" else RATE
    )
    sql["trend_coefficients_long"] = _coefficients(
        SECONDS, SECOND_ORIGIN, lambda c, part: SLOPE if part == "slope" else RATE
    )
    sql["future_frame"] = f"""WITH {DAYS}
SELECT series_key, step, CAST(last_period + step AS INTEGER) AS year
FROM (SELECT series_key, max(year) AS last_period FROM panel GROUP BY 1) AS last_rows,
     (SELECT unnest([1, 2, 3, 4, 5, 6]) AS step) AS steps"""
    sql["rate_extrapolation"] = (
        f"WITH {MONTHS}, {_forecast(MONTH_ORIGIN, columns=RATES)}"
        f" SELECT series_key, year, {_list(_rates())} FROM ahead"
    )
    sql["trend_forecast"] = f"""WITH {MONTHS}, {_forecast(MONTH_ORIGIN)}
SELECT series_key, year, {_round("population", AMOUNT)} AS population, {_list(_rates())},
       {_round("year_over_year_change", PERCENT)} AS year_over_year_change,
       {_round("population_millions", PERCENT)} AS population_millions,
       CAST(trunc(population) AS BIGINT) AS whole_population
FROM forecast"""

    lags = [f"{_lag(v, b)} AS {v}_lag_{b}" for b in (1, 2, 3) for v in VARIABLES]
    sql["feat_lags"] = _select(DAYS, keys + lags)
    changes = [f"{_change(v)} AS {v}_yoy_change" for v in VARIABLES]
    changes += [f"{v} - {_lag(v, 1)} AS {v}_diff" for v in VARIABLES]
    sql["feat_changes"] = _select(DAYS, keys + changes)
    means = [f"{_mean(v, k)} AS {v}_ma_{k}" for k in (2, 3) for v in VARIABLES]
    sql["feat_moving_avg"] = _select(DAYS, keys + means)
    sql["feat_interactions"] = _select(
        DAYS,
        keys
        + [
            "birth_rate / nullif(death_rate, 0) AS birth_death_ratio",
            "birth_rate - death_rate AS natural_growth",
            "birth_rate - death_rate + migration_rate AS total_growth",
        ],
    )
    sql["pct_change_zero_base"] = f"""WITH {DAYS},
pairs AS (SELECT series_key, year, death_rate AS now, {_lag("death_rate", 1)} AS prior FROM panel)
SELECT series_key, year,
       CASE WHEN prior = 0 AND now > 0 THEN 'inf' WHEN prior = 0 AND now < 0 THEN '-inf' END
         AS infinite,
       CASE WHEN prior <> 0 THEN (now / prior - 1) * 100 END AS finite,
       CASE WHEN prior <> 0 THEN (now / prior - 1) * 100 ELSE 0.0e0 END AS filled
FROM pairs"""
    complete = " AND ".join(f"{v}_lag_{b} IS NOT NULL" for b in (1, 2, 3) for v in VARIABLES)
    for name, panel in (("features_basic", DAYS), ("features_basic_long", SECONDS)):
        basic = _select(panel, [*keys, *RATES, *lags])
        sql[name] = f"SELECT * FROM ({basic}) AS lagged WHERE {complete}"
    sql["features_full"] = _full_features(DAYS)
    sql["features_full_nation_month"] = _full_features(MONTHS)
    sql["features_full_long"] = _full_features(SECONDS)
    sql["feature_matrix"] = _full_features(DAYS, keys=())

    sql["split_time_ordered"] = _splits(DAYS)
    sql["split_time_ordered_long"] = _splits(SECONDS)
    sql["split_random"] = _random_split(DAYS, "position > 3")
    sql["split_random_long"] = _random_split(SECONDS, "TRUE")
    sql["metrics_by_series"] = (
        f"WITH {DAYS}, {_predicted(DAY_ORIGIN)}"
        f" SELECT series_key, {_list(_measures())} FROM predicted GROUP BY 1"
    )
    sql["metrics_by_series_long"] = (
        f"WITH {SECONDS}, {_predicted(SECOND_ORIGIN)}"
        f" SELECT series_key, {_list(_measures())} FROM predicted GROUP BY 1"
    )
    sql["metrics_overall"] = (
        f"WITH {DAYS}, {_predicted(DAY_ORIGIN)} SELECT {_list(_measures())} FROM predicted"
    )

    sql["forecast_band"] = f"WITH {_banded()} SELECT series_key, year, {_list(bounds)} FROM banded"
    sql["forecast_band_fallback"] = f"""WITH {MONTHS}, {_forecast(MONTH_ORIGIN)}
SELECT series_key, year, {_round("population", AMOUNT)} AS population,
       {_round("population * 0.98e0", AMOUNT)} AS lower_bound,
       {_round("population * 1.02e0", AMOUNT)} AS upper_bound
FROM forecast"""
    sql["forecast_yoy"] = f"""WITH {MONTHS}, {_forecast(MONTH_ORIGIN)}
SELECT series_key, year, {_round("population", AMOUNT)} AS population, last_actual,
       {_round("year_over_year_change", PERCENT)} AS year_over_year_change
FROM forecast"""
    sql["growth_report"] = f"""WITH {_banded()}, {_report()}
SELECT r.series_key, start_year, end_year, forecast_first, forecast_last, current_population,
       {_round("forecast_population", AMOUNT)} AS forecast_population,
       {_round("total_change", AMOUNT)} AS total_change,
       {_round("percent_change", PERCENT)} AS percent_change,
       {_round("avg_annual_growth", PERCENT)} AS avg_annual_growth,
       {_round("test_rmse", AMOUNT)} AS test_rmse,
       CAST(steps AS INTEGER) AS forecast_rows,
       {_round("forecast_population", AMOUNT)} AS last_forecast
FROM report AS r LEFT JOIN errors AS e ON r.series_key = e.series_key"""
    sql["forecast_table"] = f"""WITH {_banded()}
SELECT series_key, year AS "Year", round_even(population, 0) AS "Population",
       round_even(year_over_year_change, 2) + 0.0e0 AS "Change (%)",
       round_even(lower_bound, 0) AS "Lower Bound (95%)",
       round_even(upper_bound, 0) AS "Upper Bound (95%)",
       round_even(population_millions, 2) AS "Population (M)"
FROM banded"""
    sql["history_and_forecast"] = _combined(MONTHS, MONTH_ORIGIN, "INTEGER")
    sql["history_and_forecast_long"] = _combined(SECONDS, SECOND_ORIGIN, "BIGINT")
    sql["formatted_summary"] = f"""WITH {MONTHS}, {_forecast(MONTH_ORIGIN)}, {_report()}
SELECT series_key,
       concat('Current Population (', end_year, '): ', {_commas("current_population")})
         AS current_line,
       concat('Forecasted Population (', forecast_last, '): ', {_commas("forecast_population")})
         AS forecast_line,
       concat('Total Change: ', {_commas("total_change")}, ' (',
              {_fixed("percent_change", "%")}, ')') AS change_line,
       concat('Average Annual Growth Rate: ', {_fixed("avg_annual_growth", "%")})
         AS growth_line
FROM report"""
    sql["formatted_forecast"] = f"""WITH {MONTHS}, {_forecast(MONTH_ORIGIN)}
SELECT series_key, year,
       concat(format('{{:<10}}', year), format('{{:,}}', CAST(trunc(population) AS BIGINT)),
              repeat(' ', 10), {_fixed("year_over_year_change", "%")}, repeat(' ', 10),
              {_fixed("population_millions", "M")}) AS line
FROM forecast"""
    sql["historical_listing"] = f"""WITH {DAYS}
SELECT series_key, year,
       concat(year, ': ', format('{{:,}}', CAST(trunc(population) AS BIGINT)),
              ' (Birth Rate: ', birth_rate, ', Death Rate: ', death_rate,
              ', Migration: ', migration_rate, ')') AS line
FROM panel"""
    sql["formatted_slope"] = f"""WITH {MONTHS}, {_lines(MONTH_ORIGIN, ["population"])}
SELECT series_key, concat('Population trend: ', {_commas("population_slope")}, ' people per year')
         AS line
FROM lines"""
    edges = {
        "half": "p_size / 8.0e0",
        "cents": "p_size + 0.675e0",
        "tiny": "p_size / 1000.0e0 * 0.0005e0",
        "huge": "p_size * 1234567.0e0",
        "below": "-p_size / 1000.0e0",
    }
    shown = [f"CAST({value} AS VARCHAR) AS {name}_plain" for name, value in edges.items()]
    shown += [f"{_fixed(value, '%')} AS {name}_fixed" for name, value in edges.items()]
    sql["formatted_edges"] = f"SELECT p_partkey, {_list(shown)} FROM part"
    sql["missing_markers"] = """
SELECT event_id,
       CASE WHEN event_type NOT IN ('view', 'click', 'signup', 'error')
            THEN CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) END AS from_text,
       CASE WHEN event_type <> 'view' THEN value END AS from_double
FROM events"""
    sql["history_and_forecast_inf"] = f"""WITH {DAYS}, {_lines(DAY_ORIGIN, ["death_rate"])},
combined AS (
  SELECT series_key, year, death_rate, 'Historical' AS kind FROM panel
  UNION ALL
  SELECT series_key, CAST(last_period + step AS INTEGER),
         death_rate_slope * CAST(last_period + step - {DAY_ORIGIN} AS DOUBLE)
           + death_rate_intercept, 'Forecast'
  FROM lines, (SELECT unnest(range(1, 7)) AS step)
  WHERE death_rate_slope IS NOT NULL
),
moved AS (SELECT *, {_lag("death_rate", 1)} AS prior FROM combined)
SELECT series_key, year AS "Year",
       CASE WHEN prior = 0 AND death_rate > 0 THEN 'inf'
            WHEN prior = 0 AND death_rate < 0 THEN '-inf' END AS infinite,
       CASE WHEN prior <> 0 AND kind = 'Historical'
            THEN round_even((death_rate / prior - 1) * 100, 2) + 0.0e0 END AS finite,
       kind AS "Type"
FROM moved"""
    label = "concat(CAST(trunc(population / 1.0e6) AS BIGINT), 'M')"
    sql["chart_target_band"] = f"""WITH {_banded()},
steady AS (SELECT series_key, year, {_list(bounds)} FROM banded)
SELECT series_key, year, 'Historical' AS kind, population AS value,
       CAST(NULL AS DOUBLE) AS lower, CAST(NULL AS DOUBLE) AS upper,
       CASE WHEN position > length - 3 THEN {label} END AS label
FROM numbered
UNION ALL
SELECT series_key, year, 'Forecast', population, lower_bound, upper_bound, {label}
FROM steady"""
    sql["chart_target_band_long"] = f"""WITH {SECONDS},
{_forecast(SECOND_ORIGIN, "BIGINT", ["population"])},
steady AS (SELECT series_key, year, {_round("population", AMOUNT)} AS population FROM forecast),
numbered AS (
  SELECT *, row_number() OVER ({SERIES} ORDER BY year DESC) AS backwards FROM panel
)
SELECT series_key, year, 'Historical' AS kind, population AS value,
       CAST(NULL AS DOUBLE) AS lower, CAST(NULL AS DOUBLE) AS upper,
       CASE WHEN backwards <= 3 THEN {label} END AS label
FROM numbered
UNION ALL
SELECT series_key, year, 'Forecast', population, NULL, NULL, {label} FROM steady"""
    sql["chart_indicators_long"] = f"""WITH {MONTHS}, {_forecast(MONTH_ORIGIN, columns=RATES)},
points AS (
  SELECT series_key, year, 'Historical' AS kind, {_list(RATES)} FROM panel
  UNION ALL
  SELECT series_key, year, 'Forecast', {_list(_rates())} FROM ahead
)
""" + "\nUNION ALL\n".join(
        f"SELECT series_key, year, kind, '{r}' AS indicator, {r} AS value FROM points"
        for r in RATES
    )
    sql["recursive_forecast_linear"] = _recursion()
    flags = f"""
numbered_rows AS (
  SELECT series_key AS k, year AS y, row_number() OVER ({ORDERED}) AS nth,
         CAST(floor(count(*) OVER ({SERIES}) * CAST(0.8 AS DOUBLE)) AS BIGINT) AS train_rows
  FROM panel
),
flags AS (
  SELECT k, y, nth, nth > train_rows AS is_test,
         nth > floor(train_rows * CAST(0.8 AS DOUBLE)) AND nth <= train_rows AS is_validation
  FROM numbered_rows
)"""
    own = [f"population_{x}" for x in ("yoy_change", "diff", "ma_2", "ma_3")]
    made = _full_features(MONTHS)
    joined = f"WITH {MONTHS}, {flags}, made AS ({made}) SELECT"
    on = "FROM made JOIN flags ON k = series_key AND y = year"
    sql["training_table"] = (
        f"{joined} made.* EXCLUDE ({', '.join(own)}), is_test, is_validation {on} WHERE nth > 3"
    )
    sql["training_table_full"] = f"{joined} made.*, is_test, is_validation {on}"
    scored = f"SELECT made.series_key, made.year, made.population, is_test, is_validation {on}"
    sql["gbt_scored_rows"] = (
        f"WITH {MONTHS}, {flags}, made AS (SELECT series_key, year, population FROM panel)"
        f" {scored.replace(', is_validation', ', is_validation, TRUE AS predicted')} WHERE nth > 3"
    )
    sql["mean_model_metrics"] = f"""WITH {MONTHS}, {flags},
made AS (SELECT series_key, year, population FROM panel),
rows_used AS ({scored} WHERE nth > 3),
predicted AS (
  SELECT *, (SELECT avg(population) FROM rows_used WHERE NOT is_test) AS prediction FROM rows_used
)
SELECT {_list(_measures())} FROM predicted"""
    agree = ", ".join(f"TRUE AS {p}_{m}_agrees" for m in ("mae", "rmse", "r2") for p in ("train", "test"))
    sql["gbt_metric_checks"] = f"SELECT {agree}"
    names = [*RATES, "year_squared", "birth_death_ratio", "natural_growth", "total_growth"]
    names += [f"{v}_lag_{b}" for b in (1, 2, 3) for v in VARIABLES]
    names += [f"{r}_{x}" for r in RATES for x in ("yoy_change", "diff", "ma_2", "ma_3")]
    sql["feature_importance_checks"] = (
        f"SELECT unnest([{', '.join(repr(n) for n in names)}]) AS feature,"
        " TRUE AS sums_to_100, TRUE AS ten_are_first, TRUE AS in_order"
    )
    sql["gbt_tree_importances"] = f"SELECT unnest([{', '.join(repr(n) for n in names)}]) AS feature, TRUE AS same_importance"
    sql["gbt_tree_predictions"] = f"""WITH {MONTHS}, {flags}
SELECT k AS series_key, y AS year, TRUE AS same_prediction FROM flags WHERE nth > 3"""
    sql["gbt_tree_forecast"] = f"""WITH {MONTHS},
{_forecast(MONTH_ORIGIN, columns=RATES)}
SELECT series_key, year, TRUE AS same_step FROM ahead"""
    sql["gbt_stumps"] = f"""WITH {MONTHS}, {flags}, made AS ({made}),
rows_used AS (
  SELECT made.* EXCLUDE ({', '.join(own)}), is_test, is_validation {on} WHERE nth > 3
),
long AS (
  UNPIVOT (SELECT series_key, year, {', '.join(f"coalesce(CAST({n} AS DOUBLE), -1e300) AS {n}" for n in names)} FROM rows_used)
  ON COLUMNS(* EXCLUDE (series_key, year)) INTO NAME feature VALUE x
),
zero AS (SELECT series_key, year, population, is_test, population AS residual FROM rows_used),
{_stump('first', 'zero', 'avg(residual)')},
one AS (
  SELECT z.* EXCLUDE (residual), avg_all + value AS score, 2 * (population - avg_all - value) AS residual
  FROM zero z JOIN first_value USING (series_key, year),
       (SELECT avg(population) AS avg_all FROM zero WHERE NOT is_test) AS m
),
{_stump('second', 'one', '0')}
SELECT series_key, year, o.population, r.is_test, r.is_validation,
       {_round('score + CAST(0.05 AS DOUBLE) * value', AMOUNT)} AS prediction
FROM one o JOIN second_value USING (series_key, year) JOIN rows_used r USING (series_key, year)"""
    sql["model_round_trip"] = f"""WITH {MONTHS}, {flags}
SELECT k AS series_key, y AS year, TRUE AS same_prediction, TRUE AS has_errors
FROM flags WHERE nth > 3"""
    sql["recursive_forecast_checks"] = f"""WITH {MONTHS},
{_forecast(MONTH_ORIGIN, columns=RATES)}
SELECT series_key, year, {_list(_rates())},
       TRUE AS band_is_even, TRUE AS change_agrees, TRUE AS millions_agree
FROM ahead"""
    sql["append_features"] = (
        f"SELECT * FROM ({_full_features(DAYS)}) WHERE year = (SELECT max(CAST(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS INTEGER)) FROM events)"
    )
    fits = [
        f"{_round(f'{c}_{part}', AMOUNT if c == 'population' else RATE)} AS {c}_{part}"
        for c in VARIABLES
        for part in ("slope", "intercept")
    ]
    sql["append_lines"] = f"""WITH {DAYS}, {_lines(DAY_ORIGIN)},
sizes AS (SELECT series_key, count(*) AS rows FROM panel GROUP BY 1)
SELECT series_key, rows, last_period, {_list(fits)} FROM lines JOIN sizes USING (series_key)"""
    reasons = {
        "too few fields": "birth_rate > 0",
        "too many fields": "death_rate > 0",
        "no period": "migration_rate > 0",
        "no series key": "migration_rate < -1",
    }
    cases = " ".join(f"WHEN {condition} THEN '{reason}'" for reason, condition in reasons.items())
    sql["csv_rejects"] = f"""WITH {DAYS}
SELECT reason, count(*) AS lines,
       CASE WHEN reason <> 'no period' THEN CAST(sum(year) AS BIGINT) END AS years
FROM (SELECT coalesce(CASE {cases} END, 'accepted') AS reason, year FROM panel) GROUP BY 1"""
    sql["forecast_coverage"] = f"""WITH {DAYS}
SELECT series_key, count(*) AS rows, count(*) > 1 AS has_forecast,
       CASE WHEN count(*) = 1 THEN 'fewer than two periods' END AS reason
FROM panel GROUP BY series_key"""
    return sql
