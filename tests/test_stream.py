import json
import random

import pytest
from pyspark.errors import AnalysisException, StreamingQueryException

from ledgerline.plans.ingest import ingest
from ledgerline.sources.lake import Lake
from ledgerline.sources.messages import json_lines_stream, kafka_stream
from ledgerline.streaming.changes import read_changes, start_change_feed
from ledgerline.streaming.ingest import run_to_end
from ledgerline.streaming.monitor import StreamMonitor
from ledgerline.suite.registry import QUERIES


def message(i, second, status="pending"):
    return json.dumps(
        {
            "order_id": f"ORD-{i}",
            "customer_id": f"CUST-{i % 3}",
            "product_id": f"PROD-{i % 2}",
            "quantity": i % 5 + 1,
            "price": i + 0.5,
            "order_timestamp": f"2024-01-01T00:00:{second:02d}",
            "status": status,
        }
    )


@pytest.fixture
def stage(spark, tmp_path):
    class Stage:
        lake = Lake(spark, str(tmp_path / "lake"))
        topic = tmp_path / "topic"
        files = 0

        def publish(self, lines):
            self.topic.mkdir(exist_ok=True)
            (self.topic / f"part-{self.files}.json").write_text("\n".join(lines) + "\n")
            self.files += 1

        def run(self, checkpoint="checkpoint", **options):
            raw = json_lines_stream(spark, str(self.topic), max_files_per_trigger=1)
            query = ingest(self.lake, raw, str(tmp_path / checkpoint), None, **options)
            assert run_to_end(query)
            return query

        def statuses(self):
            rows = self.lake.orders.snapshot().select("order_id", "status").collect()
            return {r["order_id"]: r["status"] for r in rows}

    return Stage()


def test_stream_equals_batch_in_any_arrival_order(spark, stage):
    versions = [(i % 10, s, f"s{s}") for s, i in enumerate(range(50))]
    random.Random(4).shuffle(versions)
    for start in range(0, 50, 10):
        stage.publish([message(*v) for v in versions[start : start + 10]])
    stage.run()
    newest = {f"ORD-{i}": f"s{max(s for j, s, _ in versions if j == i)}" for i in range(10)}
    assert stage.statuses() == newest


def test_restart_resumes_and_a_fresh_checkpoint_loses_nothing(stage):
    stage.publish([message(1, 1, "a")])
    stage.run()
    stage.publish([message(1, 2, "b"), message(2, 1, "a")])
    stage.run()
    assert stage.statuses() == {"ORD-1": "b", "ORD-2": "a"}
    stage.run("another-checkpoint")  # reads everything again
    assert stage.statuses() == {"ORD-1": "b", "ORD-2": "a"}


def test_a_batch_that_failed_after_its_upsert_is_replayed_in_place(stage, monkeypatch):
    import ledgerline.streaming.ingest as module

    stage.publish([message(1, 1, "a"), message(2, 1, "a")])
    stage.run()

    def fail(_):
        raise RuntimeError("lost between the two writes")

    stage.publish([message(1, 2, "b")])
    with monkeypatch.context() as patch:
        patch.setattr(module, "rejected", fail)
        with pytest.raises(StreamingQueryException, match="lost between"):
            stage.run()
    assert stage.statuses()["ORD-1"] == "b"  # written, not yet acknowledged by the stream
    stage.run()
    assert stage.statuses() == {"ORD-1": "b", "ORD-2": "a"}


def test_malformed_messages_are_set_aside(spark, stage):
    stage.publish([message(1, 1), "not json", '{"price": 3}'])
    stage.run()
    assert set(stage.statuses()) == {"ORD-1"}
    quarantine = spark.read.parquet(stage.lake.quarantine_path)
    assert sorted(r["value"] for r in quarantine.collect()) == ["not json", '{"price": 3}']


def test_ready_then_stopped(spark, stage, tmp_path):
    stage.publish([message(1, 1), "not json"])
    raw = json_lines_stream(spark, str(stage.topic))
    with StreamMonitor(spark) as monitor:
        query = ingest(stage.lake, raw, str(tmp_path / "c"), "1 second")
        try:
            assert monitor.wait_until_ready(query, timeout=60)
            query.processAllAvailable()
            assert set(stage.statuses()) == {"ORD-1"}
            assert not run_to_end(query, timeout=0.1)
            assert not monitor.wait_until_ended(query, timeout=0.1)
        finally:
            query.stop()
        assert monitor.wait_until_ended(query, timeout=60)
    assert not query.isActive
    status = monitor.status().first()
    assert (status["query"], status["state"], status["error"]) == ("order-ingest", "stopped", None)
    counts = monitor.batches().collect()
    assert [(r["messages"], r["accepted"], r["rejected"]) for r in counts] == [(2, 1, 1)]
    assert [r["passed"] for r in monitor.checks(minimum_rows=2).collect()] == [True, False]


def test_a_failed_stream_is_not_ready_and_says_why(spark, stage, monkeypatch):
    import ledgerline.streaming.ingest as module

    def fail(_):
        raise RuntimeError("no disk left")

    stage.publish([message(1, 1)])
    monkeypatch.setattr(module, "accepted", fail)
    raw = json_lines_stream(spark, str(stage.topic))
    with StreamMonitor(spark) as monitor:
        query = ingest(stage.lake, raw, str(stage.topic) + "-c", None)
        with pytest.raises(StreamingQueryException):
            run_to_end(query)
        assert monitor.wait_until_ended(query, timeout=60)
        assert not monitor.wait_until_ready(query, timeout=1)
    status = monitor.status().first()
    assert status["state"] == "failed" and "no disk left" in status["error"]
    assert monitor.batches().count() == 0
    assert [r["passed"] for r in monitor.checks().collect()] == [False, False]


def test_a_start_at_the_newest_message_skips_the_backlog_once(spark, stage, tmp_path):
    checkpoint = str(tmp_path / "latest")

    def run():
        raw = json_lines_stream(spark, str(stage.topic), starting="latest", checkpoint=checkpoint)
        assert run_to_end(ingest(stage.lake, raw, checkpoint, None))

    stage.publish([message(1, 1)])
    run()
    assert not stage.lake.orders.exists()
    stage.publish([message(2, 1)])  # while the stream is down
    run()
    stage.publish([message(3, 1)])
    run()
    assert set(stage.statuses()) == {"ORD-2", "ORD-3"}
    with pytest.raises(ValueError):
        json_lines_stream(spark, str(stage.topic), starting="latest")
    with pytest.raises(ValueError):
        json_lines_stream(spark, str(stage.topic), starting="sometime")


def test_changes_are_given_out_once_and_survive_a_restart(spark, stage, tmp_path):
    feed, checkpoint = str(tmp_path / "feed"), str(tmp_path / "state")

    def run():
        assert run_to_end(start_change_feed(json_lines_stream(spark, str(stage.topic)), feed, checkpoint, None))

    def changes(batch):
        rows = read_changes(spark, feed).where(f"batch = {batch}").collect()
        return {r["order_id"]: r["status"] for r in rows}

    stage.publish([message(1, 5, "a"), message(1, 3, "old"), message(2, 1, "a"), "not json"])
    run()
    assert changes(0) == {"ORD-1": "a", "ORD-2": "a"}
    # a late row, a repeated row, a newer row and a new key
    stage.publish([message(1, 4, "late"), message(2, 1, "a"), message(3, 1, "a")])
    run()
    assert changes(1) == {"ORD-3": "a"}
    stage.publish([message(2, 2, "b")])
    run()
    assert changes(2) == {"ORD-2": "b"}
    run()  # nothing new
    assert read_changes(spark, feed).count() == 4


def test_messages_are_written_and_read_by_many_tasks(spark, sf_dir, tmp_path, monkeypatch):
    """Each task writes its file, and a batch holds all files of a return flag."""
    from ledgerline.suite import tables

    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    written = []
    publish = tables._publish

    def watched(spark, sf, topic, flag):
        publish(spark, sf, topic, flag)
        written.append(len(spark.read.text(topic).inputFiles()))

    monkeypatch.setattr(tables, "_publish", watched)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    spark.conf.set("spark.sql.files.minPartitionNum", "8")
    try:
        counts = {r["batch_id"]: (r["messages"], r["rejected"]) for r in tables.x6(spark, sf_dir).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.unset("spark.sql.files.minPartitionNum")
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_returnflag").count().collect()
    flags = {r[0]: r[1] for r in lines}
    assert counts == {0: (flags["R"], 0), 1: (flags["N"], 0), 2: (flags["A"], 0), 3: (3, 3)}
    assert written[0] > 1 and written[1] > written[0] + 1


def test_four_batches_of_the_order_log(spark, sf_dir, monkeypatch):
    from ledgerline.suite import tables

    with StreamMonitor(spark) as monitor:
        want = tables.stream_upsert(spark, sf_dir).count()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    counts = [r["messages"] for r in monitor.batches().collect()]
    assert len(counts) == 4 and sum(counts) == spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    assert want == QUERIES["g5_latest_per_key"].run(spark, sf_dir).count()


def test_kafka_needs_its_connector(spark):
    with pytest.raises(AnalysisException, match="kafka"):
        kafka_stream(spark, "broker:9092")
