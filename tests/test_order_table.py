import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators.latest import latest_per_key
from ledgerline.session import file_system, path_exists
from ledgerline.sources import dated_table
from ledgerline.sources.dated_table import DatedTable, KeyedTable
from ledgerline.sources.hudi import HudiTable, connector_is_present
from ledgerline.sources.lake import Lake
from ledgerline.sources.tables import TableUnavailable

SCHEMA = T.StructType(
    [
        T.StructField("k", T.StringType()),
        T.StructField("ts", T.StringType()),
        T.StructField("v", T.IntegerType()),
        T.StructField("day", T.DateType()),
    ]
)


@pytest.fixture
def new_table(spark, tmp_path):
    counter = iter(range(100))

    def build(**options):
        return KeyedTable(spark, str(tmp_path / f"t{next(counter)}"), SCHEMA, "k", "day", "ts", **options)

    return build


def frame(spark, rows):
    """Rows (key, time, value); the day is that of the time."""
    day = [None if ts is None else dt.date.fromisoformat(ts[:10]) for _, ts, _ in rows]
    return spark.createDataFrame([(*r, d) for r, d in zip(rows, day, strict=True)], SCHEMA)


def content(df):
    return sorted(tuple(r)[:3] for r in df.collect())


def versions(seed=3, n=60):
    """Versions of a few keys, on days of two months."""
    rng = random.Random(seed)
    return [
        (f"k{rng.randrange(8)}", f"2024-{rng.randrange(1, 3):02d}-{rng.randrange(1, 6):02d}T00:00:{rng.randrange(20):02d}", rng.randrange(5))
        for _ in range(n)
    ]


def expected(rows):
    best = {}
    for k, ts, v in rows:
        best[k] = max(best.get(k, ("", -1)), (ts, v))
    return sorted((k, ts, v) for k, (ts, v) in best.items())


@pytest.mark.parametrize("grain", ["day", "month", "year"])
def test_arrival_order_and_batch_limits_do_not_matter(spark, new_table, grain):
    rows = versions()
    rng = random.Random(1)
    for batches in (1, 4):
        rng.shuffle(rows)
        table = new_table(grain=grain)
        for i in range(batches):
            table.upsert(frame(spark, rows[i::batches]))
        assert content(table.snapshot()) == expected(rows)


def test_times_are_compared_as_times_not_as_text(spark, new_table):
    table = new_table()
    table.upsert(frame(spark, [("a", "2024-01-01T00:00:09", 1), ("a", "2024-01-01T00:00:09.000001", 2)]))
    table.upsert(frame(spark, [("b", "2024-01-01 00:00:10", 1), ("b", "2024-01-01T00:00:09", 2)]))
    assert [r[2] for r in content(table.snapshot())] == [2, 1]


def test_a_key_moves_between_dates(spark, new_table):
    table = new_table()
    table.upsert(frame(spark, [("a", "2024-01-01", 1), ("b", "2024-01-02", 1)]))
    table.upsert(frame(spark, [("a", "2024-01-05", 2)]))  # the first of January loses its only row
    assert content(table.snapshot()) == [("a", "2024-01-05", 2), ("b", "2024-01-02", 1)]
    assert content(table.on("2024-01-01")) == [] and content(table.on("2024-01-05")) == [("a", "2024-01-05", 2)]
    table.upsert(frame(spark, [("a", "2024-01-03", 3)]))  # older than what is stored: nothing moves back
    assert content(table.on("2024-01-03")) == [] and len(content(table.snapshot())) == 2


def test_replayed_batch_changes_nothing(spark, new_table):
    table = new_table()
    first, second = frame(spark, [("a", "2024-01-01", 1)]), frame(spark, [("a", "2024-01-02", 2), ("c", "2024-01-01", 5)])
    table.upsert(first)
    table.upsert(second)
    before = content(table.snapshot())
    for batch in (second, first):
        table.upsert(batch)
        assert content(table.snapshot()) == before


@pytest.mark.parametrize("bits", [1 << 15, 1 << 29])
@pytest.mark.parametrize("late", ["event", "arrival"])
def test_rows_that_stay_keep_out_of_the_shuffle(spark, new_table, monkeypatch, bits, late):
    """With a bitmap that tells keys apart, and with one so full that most stored rows seem to be hit."""
    monkeypatch.setattr(dated_table, "SPLIT_BYTES", 0)
    monkeypatch.setattr(dated_table, "MOST_BITS", bits)
    table, want = new_table(grain="month", late_rows=late, keep_versions=True), {}
    for batch in range(3):
        rows = [(f"k{i}", f"2024-0{1 + i % 3}-0{1 + (batch * i) % 9}T00:00:00", batch) for i in range(batch, 20_000, 1 + 99 * batch)]
        table.upsert(frame(spark, rows), batch + 1)
        for k, ts, v in rows:
            want[k] = max(want.get(k, ("", -1)), (ts, v)) if late == "event" else (ts, v)
        assert content(table.snapshot()) == sorted((k, ts, v) for k, (ts, v) in want.items())
        assert content(table.snapshot(batch + 1)) == content(table.snapshot())
    table.delete(spark.createDataFrame([("k3", "2025-01-01"), (None, "2025-01-01")], "k string, ts string"))
    assert content(table.snapshot()) == sorted((k, ts, v) for k, (ts, v) in want.items() if k != "k3")


def test_a_write_is_shuffled_once_and_by_key(spark, new_table, monkeypatch):
    table, plans = new_table(grain="month"), []
    table.upsert(frame(spark, versions()))
    write = dated_table._write_dates

    def watched(rows, date, path, mode, even):
        plans.append((rows._jdf.queryExecution().optimizedPlan().toString(), even))
        write(rows, date, path, mode, even)

    monkeypatch.setattr(dated_table, "_write_dates", watched)
    table.upsert(frame(spark, versions(9)))
    assert len(plans) == 1 and plans[0][0].count("row_number()") >= 1 and not plans[0][1]
    monkeypatch.setattr(dated_table, "MOST_FILES", 0)  # a table in many small files
    table.upsert(frame(spark, versions(11)))
    assert plans[1][1]
    assert content(table.snapshot()) == expected(versions() + versions(9) + versions(11))


def test_folders_that_were_not_moved_yet_are_moved_by_the_next_write(spark, new_table, monkeypatch):
    table = new_table()
    table.upsert(frame(spark, [("a", "2024-01-01", 1), ("b", "2024-01-02", 1)]))
    with monkeypatch.context() as patch:
        patch.setattr(dated_table, "_overwrite_dates", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            table.upsert(frame(spark, [("a", "2024-01-01T01:00:00", 2), ("b", "2024-01-02T01:00:00", 2)]))
    files, one = file_system(spark, f"{table.path}_staged/_from=2024-01-01")
    there = file_system(spark, f"{table.path}/_from=2024-01-01")[1]
    files.delete(there, True)
    assert files.rename(one, there)  # cut off between the first folder and the second
    table.upsert(frame(spark, [("c", "2024-01-01", 3)]))
    assert [r[2] for r in content(table.snapshot())] == [2, 2, 3]
    assert not path_exists(spark, f"{table.path}_staged")


def test_only_touched_folders_are_written(spark, new_table):
    table = new_table()
    table.upsert(frame(spark, [(f"k{i}", f"2024-01-0{i}", i) for i in range(1, 6)]))

    def files():
        return {r[0] for r in spark.read.parquet(table.path).select("_metadata.file_path").distinct().collect()}

    before = files()
    table.upsert(frame(spark, [("k2", "2024-01-04", 9)]))
    kept = before & files()
    assert {f.split("_from=")[1][:10] for f in kept} == {"2024-01-01", "2024-01-03", "2024-01-05"}


def test_a_write_that_was_cut_off_is_finished_by_the_next(spark, new_table, monkeypatch):
    table = new_table()
    table.upsert(frame(spark, [("a", "2024-01-01", 1), ("b", "2024-01-01", 1)]))

    def lost(*_):
        raise RuntimeError("the driver is gone")

    with monkeypatch.context() as patch:
        patch.setattr(dated_table, "_overwrite_dates", lost)
        with pytest.raises(RuntimeError):
            table.upsert(frame(spark, [("a", "2024-01-02", 2)]))
    assert path_exists(spark, f"{table.path}_staged/_SUCCESS")
    # as if the folder had been removed, and nothing put in its place
    spark.createDataFrame([], table._stored).write.mode("overwrite").parquet(table.path)
    table.upsert(frame(spark, [("c", "2024-01-03", 3)]))
    assert content(table.snapshot()) == [("a", "2024-01-02", 2), ("b", "2024-01-01", 1), ("c", "2024-01-03", 3)]
    assert not path_exists(spark, f"{table.path}_staged")


def test_delete_and_late_rows(spark, new_table):
    table = new_table()
    table.upsert(frame(spark, [("a", "2024-01-01", 1), ("b", "2024-01-01", 1)]))
    table.delete(spark.createDataFrame([("a", "2024-01-05")], "k string, ts string"))
    assert content(table.snapshot()) == [("b", "2024-01-01", 1)]
    table.compact()
    table.upsert(frame(spark, [("a", "2024-01-03", 7)]))  # older than the deletion
    assert content(table.snapshot()) == [("b", "2024-01-01", 1)]
    table.upsert(frame(spark, [("a", "2024-01-06", 8)]))
    assert content(table.snapshot()) == [("a", "2024-01-06", 8), ("b", "2024-01-01", 1)]


def test_rows_without_a_date_or_a_key(spark, new_table):
    table = new_table()
    rows = [("a", None, 1), ("b", "2024-01-01", 1)]
    table.upsert(frame(spark, rows))
    table.upsert(spark.createDataFrame([(None, "2024-01-01", 1, None)], SCHEMA))
    assert {r[0] for r in content(table.snapshot())} == {"a", "b"}
    table.upsert(frame(spark, [("a", "2024-01-02", 2)]))
    assert content(table.snapshot()) == [("a", "2024-01-02", 2), ("b", "2024-01-01", 1)]


def test_a_table_written_by_two_grains(spark, new_table):
    table = new_table(grain="month")
    table.upsert(frame(spark, [("a", "2024-01-03", 1), ("b", "2024-01-03", 1)]))
    table.grain = "day"
    table.upsert(frame(spark, [("a", "2024-01-03T01:00:00", 2), ("c", "2024-01-04", 2)]))
    assert content(table.on("2024-01-03")) == [("a", "2024-01-03T01:00:00", 2), ("b", "2024-01-03", 1)]
    assert len(content(table.snapshot())) == 3


def test_time_travel(spark, new_table):
    table = new_table(keep_versions=True)
    for i in range(4):
        table.upsert(frame(spark, [("a", f"2024-01-0{i + 1}", i), (f"k{i}", "2024-01-01", i)]), version=10 + i)
    assert [dict((r[0], r[2]) for r in content(table.snapshot(10 + i)))["a"] for i in range(4)] == [0, 1, 2, 3]
    assert content(table.snapshot(13)) == content(table.snapshot())
    assert content(table.snapshot(9)) == []
    assert sorted(tuple(r) for r in table.versions().collect()) == [(10 + i, 2) for i in range(4)]
    table.delete(spark.createDataFrame([("a", "2024-02-01")], "k string, ts string"), version=20)
    assert "a" not in {r[0] for r in content(table.snapshot(20))} and "a" in {r[0] for r in content(table.snapshot(19))}
    with pytest.raises(TableUnavailable):
        new_table().snapshot(1)


def test_compaction_never_changes_a_snapshot(spark, new_table):
    table = new_table()
    rows = versions(5, 40)
    for i in range(3):
        table.upsert(frame(spark, rows[i::3]))
    before = content(table.snapshot())
    table.compact()
    assert content(table.snapshot()) == before == expected(rows)


def test_arrival_order_lets_the_later_write_win(spark, new_table):
    table = new_table(late_rows="arrival")
    table.upsert(frame(spark, [("a", "2024-01-05", 1)]))
    table.upsert(frame(spark, [("a", "2024-01-01", 2), ("a", "2024-01-02", 3)]))
    assert content(table.snapshot()) == [("a", "2024-01-02", 3)]


def test_missing_table(new_table):
    with pytest.raises(TableUnavailable):
        new_table().snapshot()
    with pytest.raises(TableUnavailable):
        new_table().on("2024-01-01")
    with pytest.raises(TableUnavailable):
        new_table().compact()
    with pytest.raises(ValueError):
        new_table(late_rows="never")
    with pytest.raises(ValueError):
        new_table(grain="hour")


def test_one_date_opens_one_folder_and_needs_no_shuffle(spark, new_table):
    table = new_table()
    table.upsert(frame(spark, versions()))
    plan = table.on("2024-01-03")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan
    filters = plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "_from" in filters and "2024-01-03" in str(table.on("2024-01-03")._jdf.queryExecution().optimizedPlan())
    assert "Exchange" not in table.snapshot()._jdf.queryExecution().executedPlan().toString()


def test_whole_dates_are_replaced(spark, tmp_path):
    schema = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("d", T.StringType())])
    table = DatedTable(spark, str(tmp_path / "d"), schema, "d")
    with pytest.raises(TableUnavailable):
        table.snapshot()
    table.upsert(spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], schema))
    table.upsert(spark.createDataFrame([(3, "2024-01-02")], schema))
    assert sorted(tuple(r) for r in table.snapshot().collect()) == [(1, "2024-01-01"), (3, "2024-01-02")]


def test_hot_key_is_reduced_before_the_shuffle(spark):
    hot = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("ts"),
    )
    newest = latest_per_key(hot, ["k"], [F.col("ts").desc()])
    assert newest.filter("k = 'hot'").first()["ts"] == 29_997
    assert newest.count() == 20_001
    plan = newest._jdf.queryExecution().executedPlan().toString()
    below_shuffle = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in below_shuffle


def test_hudi_settings(spark, tmp_path, monkeypatch):
    """The connector is not here; this checks what Spark's reader and writer are told, and that it says so."""
    lake = Lake(spark, str(tmp_path), order_format="hudi")
    assert isinstance(lake.orders, HudiTable) and not connector_is_present(spark)
    assert not lake.orders.exists()
    assert lake.orders.settings["hoodie.datasource.write.recordkey.field"] == "order_id"
    assert lake.orders.settings["hoodie.datasource.write.precombine.field"] == "order_timestamp"
    rows = spark.createDataFrame([("o",)], "order_id string")
    with pytest.raises(Exception, match="(?i)hudi"):
        lake.orders.delete(rows)
    with pytest.raises(Exception, match="(?i)hudi"):
        lake.orders.snapshot(as_of="20240101000000")

    class Writer:
        def __init__(self):
            self.set = {}

        def format(self, name):
            self.set["format"] = name
            return self

        def options(self, **options):
            self.set |= options
            return self

        def option(self, key, value):
            self.set[key] = value
            return self

        def mode(self, mode):
            self.set["mode"] = mode
            return self

        def save(self, path):
            self.set["path"] = path

    class Frame:
        write = Writer()

        def select(self, *_):
            return self

        def where(self, *_):
            return self

    lake.orders.upsert(Frame())
    assert Frame.write.set["format"] == "hudi" and Frame.write.set["mode"] == "append"
    assert Frame.write.set["hoodie.datasource.write.operation"] == "upsert"
    assert Frame.write.set["path"] == f"{tmp_path}/orders_raw"
