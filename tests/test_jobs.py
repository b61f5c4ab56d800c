import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from ledgerline.__main__ import main
from ledgerline.operators.quality import DataQualityError, enforce, volume_checks
from ledgerline.plans.chain import run_chain
from ledgerline.plans.daily import run_daily
from ledgerline.plans.export import run_export
from ledgerline.plans.forecast import run_forecast
from ledgerline.plans.smoke import run_smoke
from ledgerline.plans.verify import run_verify
from ledgerline.schemas import DAILY_METRICS, DAILY_SERVING, FORECAST_SERVING
from ledgerline.sinks.export import export_tables
from ledgerline.sinks.tables import jdbc_sink, parquet_sink
from ledgerline.sources.lake import Lake
from ledgerline.sources.tables import TableUnavailable, read_jdbc, read_parquet
from ledgerline.suite.adapters import as_order_rows, order_events


@pytest.fixture
def lake(spark, sf_dir, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"), grain="month")
    lake.orders.upsert(as_order_rows(order_events(spark, sf_dir)))
    return lake


def test_daily_job_keeps_other_dates_and_replaces_its_own(lake):
    run_daily(lake, "2024-01-15")
    run_daily(lake, "2024-01-16")
    before = lake.read("daily_analytics").orderBy("processing_date").collect()
    run_daily(lake, "2024-01-16")
    after = lake.read("daily_analytics").orderBy("processing_date").collect()
    assert after == before
    assert [r["processing_date"] for r in after] == ["2024-01-15", "2024-01-16"]
    products = lake.read("top_products_daily")
    assert {r["processing_date"] for r in products.collect()} == {"2024-01-16"}
    assert lake.read("daily_analytics").columns == DAILY_METRICS.names


def test_rerun_after_new_orders_wins(spark, lake):
    first = run_daily(lake, "2024-01-15")["daily_analytics"].first()["total_orders"]
    late = lake.orders.snapshot().filter("order_date = '2024-01-15'").limit(1)
    lake.orders.upsert(late.selectExpr("'new' as order_id", *(c for c in late.columns if c != "order_id")))
    second = run_daily(lake, "2024-01-15")["daily_analytics"].first()["total_orders"]
    assert second == first + 1


def test_daily_job_on_an_empty_day(lake):
    tables = run_daily(lake, "2030-01-01")
    assert tables["daily_analytics"].first()["total_orders"] == 0
    assert tables["top_products_daily"].count() == 0
    assert "used_fallback" in tables["top_products_daily"].columns
    assert tables["daily_analytics"].first()["used_fallback"] is False


def test_daily_job_falls_back_when_asked(lake):
    tables = run_daily(lake, "2030-01-01", fallback=True)
    assert tables["daily_analytics"].first()["total_orders"] == lake.orders.snapshot().count()
    assert {r["used_fallback"] for r in tables["hourly_trends_daily"].collect()} == {True}
    assert tables["daily_analytics"].first()["used_fallback"] is True
    tables = run_daily(lake, "2024-01-15", fallback=True)
    assert {r["used_fallback"] for r in tables["hourly_trends_daily"].collect()} == {False}


def test_history_of_fallback_and_normal_days_has_all_columns(lake):
    for date, fallback in (("2024-01-15", False), ("2030-01-01", True)):
        run_daily(lake, date, fallback, keep_history=True)
    kept = lake.history("status_distribution_daily")
    assert dict(kept.dtypes)["processing_date"] == "string"
    flags = {(r["processing_date"], r["used_fallback"]) for r in kept.collect()}
    assert flags == {("2024-01-15", False), ("2030-01-01", True)}


def test_chain(spark, lake, tmp_path):
    serving = str(tmp_path / "serving")
    result = run_chain(
        lake,
        parquet_sink(serving),
        lambda table: read_parquet(spark, f"{serving}/{table}"),
        "2024-01-15",
    )
    status = {r["table_name"]: (r["row_count"], r["ok"]) for r in result.status.collect()}
    counts = {r["table_name"]: r["row_count"] for r in result.counts.collect()}
    assert set(status) == set(DAILY_SERVING.values())
    assert all(ok for _, ok in status.values())
    assert counts == {name: rows for name, (rows, _) in status.items()}


def test_export_isolates_a_missing_table(lake, tmp_path):
    run_daily(lake, "2024-01-15")
    broken = Lake(lake.spark, str(tmp_path / "other"))
    broken.overwrite("hourly_trends_daily", lake.read("hourly_trends_daily"))
    status = run_export(broken, parquet_sink(str(tmp_path / "serving"))).collect()
    assert [r["table_name"] for r in status if r["ok"]] == ["daily_hourly_trends"]
    assert all("TableUnavailable" in r["error"] for r in status if not r["ok"])


def test_forecast_job_keeps_the_lake_when_the_export_fails(lake):
    def sink(df, table):
        if table == "revenue_forecast":
            raise ConnectionError("database is away")
        df.write.format("noop").mode("overwrite").save()

    status = run_forecast(lake, sink, created_at=dt.datetime(2024, 2, 1)).collect()
    assert [(r["table_name"], r["ok"]) for r in status] == [
        ("historical_daily_revenue", True),
        ("revenue_forecast", False),
        ("forecast_summary", False),
        ("dow_seasonality_patterns", False),
    ]
    assert "database is away" in status[1]["error"] and status[2]["error"] == "skipped"
    for table in FORECAST_SERVING:
        stamps = lake.read(table).select("created_at").distinct().collect()
        assert [r[0] for r in stamps] == [dt.datetime(2024, 2, 1)]
    assert lake.read("revenue_forecast").count() == 7


def test_verify(lake):
    found = run_verify(lake)
    assert all(r["passed"] for r in found.checks.collect())
    assert found.sample.count() == 10
    counts = [r["count"] for r in found.by_status.collect()]
    assert counts == sorted(counts, reverse=True)


def test_history_of_the_replaced_tables(lake):
    for date in ("2024-01-15", "2024-01-16", "2024-01-16"):
        run_daily(lake, date, keep_history=True)
    kept = lake.history("top_products_daily").groupBy("processing_date").count().collect()
    assert {str(r[0]): r[1] for r in kept} == {"2024-01-15": 10, "2024-01-16": 10}


def test_smoke(lake):
    found = run_smoke(lake)
    assert tuple(found.round_trip.first()) == (1, 1, True)
    assert found.top_products.count() == 5
    stored = lake.read("test_analytics")
    assert stored.drop("test_date").collect() == found.summary.collect()
    today = lake.spark.range(1).select(F.current_date()).first()[0]
    assert (today - stored.first()["test_date"]).days in (0, 1)  # a run may pass midnight


def test_daily_job_leaves_no_scratch_behind(spark, lake):
    root = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    run_daily(lake, "2024-01-15")
    assert {f for f in set(os.listdir(root)) - before if f.startswith("daily-rollup")} == set()


def test_checks(spark):
    few = volume_checks(spark.range(3))
    assert [r["passed"] for r in enforce(few)] == [True, False]
    with pytest.raises(DataQualityError, match="not_empty"):
        enforce(volume_checks(spark.range(0)))


def test_verify_raises_on_a_missing_table(spark, tmp_path):
    with pytest.raises(TableUnavailable):
        run_verify(Lake(spark, str(tmp_path / "nothing")))


def test_jdbc_sink_settings():
    """No database is started; this checks what Spark's writer is told."""

    class Writer:
        def options(self, **options):
            self.set = options
            return self

        def jdbc(self, url, table, mode, properties):
            self.call = (url, table, mode, properties)

    class Frame:
        write = Writer()

    jdbc_sink("jdbc:db", {"user": "u"}, truncate=True, connections=4)(Frame, "t")
    assert Frame.write.call == ("jdbc:db", "t", "overwrite", {"user": "u"})
    assert Frame.write.set == {"truncate": "true", "numPartitions": "4", "batchsize": "10000"}


class FakeDatabase:
    """Records what Spark's writer and reader are told; holds ``extra`` rows too many for some writes."""

    def __init__(self, extra):
        self.extra, self.log, self.rows = list(extra), [], 0

    def jdbc(self, url, table, **options):
        self.log.append(("read", table))
        database = self

        class Counted:
            def first(self):
                return {"n": database.rows}

        return Counted()

    def write(self, frame):
        database = self

        class Writer:
            def options(self, **options):
                return self

            def jdbc(self, url, table, mode, properties):
                frame.write.format("noop").mode("overwrite").save()
                database.log.append(("write", table, mode))
                database.rows = frame_rows + (database.extra.pop(0) if database.extra else 0)

        frame_rows = 5
        return Writer()


@pytest.mark.parametrize("extra, writes", [([], 1), ([3], 2), ([3, 1], 3)])
def test_a_served_table_is_swapped_in_only_when_it_is_whole(spark, extra, writes):
    from ledgerline.sinks.tables import swapping_jdbc_sink

    database = FakeDatabase(extra)

    class Session:
        read = database

    class Frame:
        sparkSession = Session()

        def __init__(self, df):
            self.df = df

        def observe(self, *args):
            return Frame(self.df.observe(*args))

        @property
        def write(self):
            return database.write(self.df)

    def execute(session, url, properties, statements):
        database.log.append(("run", *statements))

    swapping_jdbc_sink("jdbc:db", {}, "r7", execute=execute)(Frame(spark.range(5)), "t")
    write, read = ("write", "t__r7", "overwrite"), ("read", "(select count(*) as n from t__r7) held")
    swap = ("run", "DROP TABLE IF EXISTS t", "ALTER TABLE t__r7 RENAME TO t")
    assert database.log == [write, read] * writes + [swap]


def test_a_served_table_that_never_is_whole_is_not_swapped_in(spark):
    from ledgerline.sinks.tables import swapping_jdbc_sink

    database = FakeDatabase([1, 1, 1])

    class Session:
        read = database

    class Frame:
        sparkSession = Session()

        def __init__(self, df):
            self.df = df

        def observe(self, *args):
            return Frame(self.df.observe(*args))

        @property
        def write(self):
            return database.write(self.df)

    def execute(*_):
        raise AssertionError("swapped")

    with pytest.raises(RuntimeError, match="holds 6 rows, 5 were sent"):
        swapping_jdbc_sink("jdbc:db", {}, "r7", execute=execute)(Frame(spark.range(5)), "t")


def test_jdbc_reader_settings():
    class Reader:
        def jdbc(self, url, table, **options):
            return url, table, options

    class Session:
        read = Reader()

    assert read_jdbc(Session, "u", "t", {}) == ("u", "t", {"properties": {}})
    got = read_jdbc(Session, "u", "t", {}, ["a = 1", "a = 2"])
    assert got[2]["predicates"] == ["a = 1", "a = 2"]


def test_export_reports_rows(spark):
    def sink(df, table):
        df.write.format("noop").mode("overwrite").save()

    status = export_tables(spark, {"a": lambda: spark.range(5), "b": lambda: spark.range(0)}, sink)
    assert [(r["table_name"], r["row_count"]) for r in status.collect()] == [("a", 5), ("b", 0)]


def test_command_line(spark, lake, tmp_path, capsys):
    assert main(["verify", "--lake", str(tmp_path / "nothing")], spark) == 1
    assert "no table at" in capsys.readouterr().err
    assert main(["verify", "--lake", lake.root], spark) == 0
    serving = str(tmp_path / "serving")
    chain = ["chain", "--lake", lake.root, "--date", "2024-01-15", "--serving-dir", serving]
    assert main(chain, spark) == 0
    assert main(["forecast", "--lake", lake.root, "--serving-dir", serving], spark) == 0
    assert main(["compact", "--lake", lake.root], spark) == 0
    assert main(["daily", "--lake", lake.root, "--date", "2024-01-16"], spark) == 0
    assert main(["export", "--lake", lake.root, "--serving-dir", serving], spark) == 0
    assert read_parquet(spark, f"{serving}/daily_overall_metrics").count() == 2


def test_command_line_ingest(spark, tmp_path):
    topic = tmp_path / "topic"
    topic.mkdir()
    (topic / "a.json").write_text('{"order_id":"o","quantity":2,"price":1.5}\n')
    lake = str(tmp_path / "lake")
    args = ["ingest", "--lake", lake, "--json-lines", str(topic), "--once"]
    assert main([*args, "--checkpoint", str(tmp_path / "c")], spark) == 0
    assert Lake(spark, lake).orders.snapshot().first()["total_amount"] == 3.0
