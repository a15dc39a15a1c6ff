import pytest
from pyspark.sql import functions as F

from panels import SCHEMA, WHOLE, by_key, make, random_rows
from seriesloom.session import scratch_path, shared_dir, written
from seriesloom.sources import panel_csv, tables


def test_round_trip(spark, tmp_path):
    panel = make(spark, random_rows(3))
    path = str(tmp_path / "csv")
    for _ in range(2):
        panel_csv.write_csv(panel, path)
    back = panel_csv.read_panel(spark, path, WHOLE)
    assert back.dtypes == panel.dtypes
    assert by_key(back) == by_key(panel)


def test_single_series_with_trailing_blank(spark, tmp_path):
    path = tmp_path / "one.csv"
    path.write_text(
        "year,population,birth_rate,death_rate,migration_rate\n"
        "2001,100,1.5,2.5,-0.5\n2002,200,1.0,2.0,-0.6 "
    )
    rows = by_key(panel_csv.read_single_series(spark, str(path), WHOLE))
    assert tuple(rows[1]) == ("all", 2002, 200.0, 1.0, 2.0, -0.6)


def test_missing_and_unreadable_numbers(spark, tmp_path):
    path = tmp_path / "holes.csv"
    path.write_text(
        "year,population,birth_rate,death_rate,migration_rate\n2001,,NaN,x,1.5\n"
    )
    (row,) = panel_csv.read_single_series(spark, str(path), WHOLE).collect()
    assert tuple(row) == ("all", 2001, None, None, None, 1.5)


def test_header_must_match(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("series_key,year,people,birth_rate,death_rate,migration_rate\n1,2,3,4,5,6\n")
    with pytest.raises(Exception, match="(?i)header"):
        panel_csv.read_panel(spark, str(path), WHOLE).collect()


def test_written_tables_stay_below_the_shared_folder(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(shared_dir(spark))
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    table = written(make(spark, [(1, 2, 3.0, 4.0, 5.0, 6.0)], SCHEMA))
    assert table.count() == 1
    assert all(shared_dir(spark).split(":")[-1] in f for f in table.inputFiles())


def test_nation_month(spark):
    orders = make(
        spark,
        [
            (1, 7, "F", 10.10, "1995-01-05", "1-URGENT"),
            (2, 7, "O", 20.20, "1995-01-06", "5-LOW"),
            (3, 8, "F", 0.05, "1995-01-07", "5-LOW"),
            (4, 8, "F", 1.0, "1995-02-07", "3-MEDIUM"),
            (5, 99, "F", 1.0, "1995-02-07", "3-MEDIUM"),
        ],
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double,"
        "o_orderdate string, o_orderpriority string",
    ).withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz"))
    customer = make(spark, [(7, 3), (8, 3)], "c_custkey long, c_nationkey int")
    january, february = by_key(tables.nation_month(orders, customer))
    assert january["year"] == 1995 * 12
    assert january["population"] == 30.35
    assert january["birth_rate"] == 100.0 / 3
    assert january["death_rate"] == 200.0 / 3
    assert january["migration_rate"] == 100.0 / 3
    assert february["population"] == 1.0


def test_user_day_counts_days_across_months(spark):
    events = make(
        spark,
        [(1, "2024-01-01 23:59:59", "signup", 1.25), (1, "2024-02-01 00:00:00", "view", 2.5)],
        "user_id long, ts string, event_type string, value double",
    ).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    first, second = by_key(tables.user_day(events))
    assert second["year"] - first["year"] == 31
    assert (first["birth_rate"], second["migration_rate"]) == (1.0, -1.0)


def test_training_checkpoints_go_to_the_shared_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert named in spark.sparkContext.getCheckpointDir()


LINES = """series_key,year,population,birth_rate,death_rate,migration_rate
1,2001,100,1.5,2.5,-0.5
 1 , 2002 , 200 , 1.0 , 2.0 , -0.6 
1,2003,,NaN,x,1.5

1,2004,5
1,2005,1,2,3,4,5
,2006,1,2,3,4
key,2007,1,2,3,4
1,soon,1,2,3,4
1,2008.5,1,2,3,4
"1","2009","7","1","2","3"
"1,5",2011,1,2,3,4
1,2012,1,2,3,4,
series_key, year, population, birth_rate, death_rate, migration_rate
1,2010,1,2,3,
"""


def test_rejected_lines(spark, tmp_path):
    path = tmp_path / "panel.csv"
    path.write_text(LINES)
    found = panel_csv.read_checked(spark, str(path), WHOLE)
    rows = by_key(found.panel)
    assert [tuple(r) for r in rows] == [
        (1, 2001, 100.0, 1.5, 2.5, -0.5),
        (1, 2002, 200.0, 1.0, 2.0, -0.6),
        (1, 2003, None, None, None, 1.5),
        (1, 2009, 7.0, 1.0, 2.0, 3.0),
        (1, 2010, 1.0, 2.0, 3.0, None),
    ]
    refused = {r["line"]: r["reason"] for r in found.rejected.collect()}
    assert refused == {
        "1,2004,5": panel_csv.TOO_FEW,
        "1,2005,1,2,3,4,5": panel_csv.TOO_MANY,
        ",2006,1,2,3,4": panel_csv.NO_KEY,
        "key,2007,1,2,3,4": panel_csv.NO_KEY,
        "1,soon,1,2,3,4": panel_csv.NO_PERIOD,
        "1,2008.5,1,2,3,4": panel_csv.NO_PERIOD,
        '"1,5",2011,1,2,3,4': panel_csv.NO_KEY,
        "1,2012,1,2,3,4,": panel_csv.TOO_MANY,
    }
    assert {r["file"].rsplit("/", 1)[1] for r in found.rejected.collect()} == {"panel.csv"}
    lines = [x for x in LINES.split("\n") if x.strip() and not x.startswith("series_key")]
    assert len(rows) + len(refused) == len(lines)

    strict = panel_csv.read_checked(spark, str(path), WHOLE, strict=True)
    assert strict.panel.count() == 4
    assert strict.rejected.filter("reason = 'no number in death_rate'").count() == 1


def test_checked_files_give_the_same_panel(spark, tmp_path):
    panel = make(spark, random_rows(8)).repartition(3)
    path = str(tmp_path / "csv")
    panel_csv.write_csv(panel, path)
    found = panel_csv.read_checked(spark, path, WHOLE)
    assert found.panel.dtypes == panel.dtypes
    assert by_key(found.panel) == by_key(panel) and found.rejected.isEmpty()
