"""Ingest and lake rules that the oracle tables do not reach."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from barlab.operators import medallion
from barlab.session import object_store_settings, scratch_dir
from barlab.sources import ingest, lake

GOOD = '{"bars": [{"t": "2024-01-02T10:00:00Z", "o": 1, "h": 2, "l": 0.5, "c": 1.5, "v": 10, "n": 3, "vw": 1.2}], "next_page_token": null}'


def test_corrupt_pages_are_kept_aside(spark):
    pages = spark.createDataFrame([("a", GOOD), ("a", '{"bars": null}'), ("b", GOOD[:40]), ("c", "no json"), ("d", None)],
                                  "symbol string, body string")
    assert ingest.ingest_bars_json(pages).count() == 1
    got = {r["symbol"]: r["_corrupt"] for r in ingest.corrupt_pages(pages).collect()}
    assert got == {"b": GOOD[:40], "c": "no json", "d": ""}


def test_day_range_reports_empty_days(spark):
    bars = spark.createDataFrame([("a", dt.date(2024, 1, 2)), ("a", dt.date(2024, 1, 2)), ("a", dt.date(2024, 1, 4))],
                                 "symbol string, dt date")
    got = {str(r["dt"]): (r["n_bars"], r["status"]) for r in ingest.ingest_day_range(bars, end="2024-01-05").collect()}
    assert got == {"2024-01-02": (2, "ok"), "2024-01-03": (0, "empty"), "2024-01-04": (1, "ok"), "2024-01-05": (0, "empty")}


@pytest.fixture(scope="module")
def two_resolutions(spark):
    day, ts = dt.date(2024, 1, 2), dt.datetime(2024, 1, 2, 10)
    rows = [(ts + dt.timedelta(minutes=k), 10.0 + k, "1min") for k in range(3)] + [(ts, 20.0, "1h"), (ts + dt.timedelta(hours=1), 22.0, "1h")]
    df = spark.createDataFrame([(t, c, c, c, c, 1.0, 1, c, "s", r, day) for t, c, r in rows],
                               "ts timestamp, open double, high double, low double, close double, volume double, "
                               "num_trades long, vwap double, symbol string, resolution string, dt date")
    path = scratch_dir(spark, "two-resolutions")
    lake.write_lake(df, path)
    return path


def test_resolutions_never_mix(spark, two_resolutions):
    gold = medallion.silver_to_gold(lake.scan(spark, two_resolutions)).collect()
    got = {(r["resolution"], r["utc_timestamp"].hour, r["utc_timestamp"].minute): r["return_1m"] for r in gold}
    assert got["1min", 10, 0] is None and got["1h", 10, 0] is None
    assert got["1min", 10, 1] == pytest.approx(0.1) and got["1h", 11, 0] == pytest.approx(0.1)
    twice = lake.scan(spark, two_resolutions).withColumn("ingest_seq", F.lit(0))
    assert medallion.dedup_keep_first(twice.unionByName(twice)).count() == 5
    assert medallion.load_session(lake.scan(spark, two_resolutions), resolution="1h").count() == 2


def test_filters_on_the_view_prune_folders(spark, two_resolutions):
    name = lake.register_bar_view(spark, two_resolutions, "view_of_two", resolution="1min")
    df = spark.sql(f"SELECT * FROM {name} WHERE dt = DATE '2024-01-02' AND symbol = 's'")
    assert df.count() == 3
    plan = df._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters: ["):].split("]")[0]
    assert "dt" in filters and "symbol" in filters and "resolution" in filters


def test_object_store_settings():
    got = object_store_settings("https://store.example:9000/", "k", "s", region="r")
    assert got["spark.hadoop.fs.s3a.endpoint"] == "store.example:9000"
    assert got["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "true" and got["spark.hadoop.fs.s3a.endpoint.region"] == "r"
    assert object_store_settings("host:1", "k", "s")["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"


def test_bars_aggregate_by_hash(spark):
    from barlab import fixtures
    from tests.conftest import SF_SMOKE
    plan = fixtures.bars(spark, SF_SMOKE)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_clustered_lake_has_few_files(spark):
    rows = [(dt.datetime(2024, 1, 1 + d, 10), 1.0, f"s{k:03d}", "1h", dt.date(2024, 1, 1 + d)) for d in range(3) for k in range(200)]
    df = spark.createDataFrame(rows, "ts timestamp, close double, symbol string, resolution string, dt date")
    path = lake.write_lake_clustered(df, scratch_dir(spark, "clustered"))
    back = lake.scan(spark, path)
    assert back.count() == 600
    assert back.select(F.input_file_name()).distinct().count() <= 12


def test_new_york_session_window(spark):
    from barlab.functions import scalar
    rows = [(dt.datetime(2024, 1, 15, 14, 30),), (dt.datetime(2024, 7, 15, 14, 30),), (dt.datetime(2024, 7, 15, 13, 35),)]
    df = spark.createDataFrame(rows, "ts timestamp")
    got = df.select(scalar.in_time_windows(F.col("ts"), ("09:30", "09:40"), "America/New_York").alias("x")).collect()
    assert [r["x"] for r in got] == [True, False, True]  # 14:30 UTC is 09:30 in winter; 13:35 is 09:35 in summer


def test_drawdown_from_zero(spark):
    from barlab.functions import indicators as ind
    df = spark.createDataFrame([("s", k, x) for k, x in enumerate([-2.0, 1.0, 3.0, -4.0])], "symbol string, ts int, pnl double")
    dd = {z: [r["dd"] for r in ind.drawdown_cols(df, "pnl", keys=["symbol"], order="ts", from_zero=z).orderBy("ts").collect()]
          for z in (False, True)}
    assert dd == {False: [0.0, 0.0, 0.0, -4.0], True: [-2.0, -1.0, 0.0, -4.0]}


def test_no_shared_folder_fails_off_one_machine():
    from types import SimpleNamespace

    from barlab.session import ensure_checkpoint_dir
    away = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None),
                           sparkContext=SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077"))
    with pytest.raises(RuntimeError, match="checkpoint"):
        ensure_checkpoint_dir(away)


def test_unreadable_files_do_not_end_the_run(spark, tmp_path):
    """A truncated archive, a truncated page, an empty file and good pages with line breaks."""
    import datetime as dt
    import gzip

    from barlab.sources import ingest
    good = '{"bars": [\n {"t": "2024-01-02T10:00:00Z", "o": 1, "h": 2, "l": 0.5, "c": 1.5, "v": 10}\n], "next_page_token": null}'
    packed = gzip.compress((good * 200).encode())
    files = {"symbol=A/dt=2024-01-02/page=0/part-0.json": good.encode(), "symbol=A/dt=2024-01-03/page=0/part-0.json.gz": packed[:len(packed) // 2],
             "symbol=A/dt=2024-01-03/page=1/part-1.json.gz": gzip.compress(good.encode()), "symbol=B/dt=2024-01-02/page=0/part-0.json": good[:40].encode(),
             "symbol=B/dt=2024-01-04/page=0/part-0.json": b'{"bars": null}', "symbol=B/dt=2024-01-04/page=0/notes.txt": b"no page"}
    for name, data in files.items():
        at = tmp_path / name
        at.parent.mkdir(parents=True, exist_ok=True)
        at.write_bytes(data)
    landed = ingest.read_landed(spark, str(tmp_path), "part-*").cache()
    assert landed.count() == 5 and landed.filter("body IS NULL").count() == 1
    got = {(r["symbol"], r["dt"].day): (r["n_files"], r["n_failed"], r["n_bars"], r["status"]) for r in ingest.day_status(landed).collect()}
    assert got == {("A", 2): (1, 0, 1, "ok"), ("A", 3): (2, 1, 1, "failed"), ("B", 2): (1, 1, 0, "failed"), ("B", 3): (0, 0, 0, "empty"),
                   ("B", 4): (1, 0, 0, "empty")}
    bars = ingest.ingest_bars_json(landed).collect()
    assert len(bars) == 2 and {r["dt"] for r in bars} == {dt.date(2024, 1, 2)}


def test_counts_come_from_footers(spark):
    from barlab import fixtures
    from barlab.operators import medallion
    from barlab.session import scratch_dir
    from barlab.sources import lake
    from tests.conftest import SF_SMOKE
    path = lake.write_lake(medallion.bronze_to_silver(fixtures.bronze_bars(fixtures.bars(spark, SF_SMOKE))), scratch_dir(spark, "footers"))
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    count, inventory = lake.row_count(spark, path), lake.footer_inventory(spark, path)
    for df in (count, inventory):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "PushedAggregation: [COUNT(*)]" in plan
    scan = lake.scan(spark, path)
    assert count.first()["n_rows"] == scan.count()
    assert sorted(map(tuple, inventory.collect())) == sorted(map(tuple, lake.inventory(scan).collect()))
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
