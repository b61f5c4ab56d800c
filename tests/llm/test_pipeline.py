"""The pipeline and the registered queries, on the smallest tables."""

import collections
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]

import check  # noqa: E402

import corpus_pipeline  # noqa: E402
from ledgerline.llm import decontaminate, odd_sketch, quality_rules  # noqa: E402
from ledgerline.llm.common import stored, table  # noqa: E402
from ledgerline.llm.queries import QUERIES  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", [n for n, (_, sql) in QUERIES.items() if sql])
def test_query_equals_sql(spark, name):
    run, sql = QUERIES[name]
    df = run(spark, SF_DIR)
    result = check.connect(SF_DIR).execute(sql)
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    assert check.canonical(df.columns, [tuple(r) for r in df.collect()]) == check.canonical(names, result.fetchall())


@pytest.mark.parametrize("name", [n for n, (_, sql) in QUERIES.items() if not sql])
def test_query_runs_whole(spark, name):
    rows = QUERIES[name][0](spark, SF_DIR).count()
    assert rows == table(spark, SF_DIR, "documents").count() or name.startswith("op3_")


def test_stages(spark):
    docs = table(spark, SF_DIR, "documents")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF_DIR), name)
        kept[name] = docs
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    def ids(name):
        return {r[0] for r in kept[name].select("doc_id").collect()}

    good = quality_rules.quality(table(spark, SF_DIR, "documents")).where("kept")
    assert ids("quality_rules") == {r["doc_id"] for r in good.collect()}
    groups = odd_sketch.near_duplicates(kept["quality_rules"], 80).where("kept")
    assert ids("near_duplicates") == {r["doc_id"] for r in groups.collect()}
    leaks = decontaminate.contaminated(kept["near_duplicates"], table(spark, SF_DIR, "benchmark"))
    assert ids("benchmark_free") == ids("near_duplicates") - {r["doc_id"] for r in leaks.collect()}
    assert ids("mixed") <= ids("benchmark_free")
    shards = collections.defaultdict(list)
    for r in kept["sharded"].collect():
        shards[r["shard"]].append(r["slot"])
    assert set(shards) == set(range(8))
    assert all(sorted(s) == list(range(len(s))) for s in shards.values())
    assert kept["sharded"].count() == kept["mixed"].count()


def test_run_leaves_only_the_tables_it_reads(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    result = corpus_pipeline.run(spark, SF_DIR)
    assert result.count() > 0
    left = {f.rsplit("-", 1)[0] for f in set(os.listdir(root)) - before}
    # results of the stages, and what the last, unfinished one reads
    assert {"quality_rules", "near_duplicates", "benchmark_free", "mixed"} <= left
    assert not {"sketches", "bands", "items", "streams", "slots", "labels"} & left


def test_pipeline_of_an_empty_table(spark):
    docs = table(spark, SF_DIR, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF_DIR), "empty")
    assert docs.count() == 0


def test_entry_registers_all(spark):
    import __spark_entry__ as entry

    names = {n for n in entry.queries() if n.startswith("op") or n == "pipeline"}
    assert names == set(QUERIES) | {"pipeline"}
