"""Merkle manifest of a table: a digest for each row, one root for all, and a proof from any row to the root.

Every node carries the interval of leaf ranks that it covers. A node of level k covers 16^k leaves, so its
parent is in the bucket ``low div 16^(k+1)`` of the next level: levels are built by grouping the buckets, and
ancestors are attached from the root down by joins on (tree, bucket) whose rows must lie in the interval of the
parent. What the parent covers less what the node covers are its siblings, left and right of it.

Leaves are ranked within their source by range-partitioned blocks, so a source of any size is many tasks; a
bucket has at most 16 rows. Proofs of the nodes above are strings of about one KB a level for 16 rows, and each
leaf meets them only in its own task. Sources form a second tree of the same kind over their subroots.

Defined cases: null columns are ``-`` in a leaf; null sources form one tree that sorts first; null ids sort
first and are never tampered with; rows of one id follow each other by their digest, and equal rows each are a
leaf; a lone leaf is its subroot, a lone subroot the root (their levels add no siblings); an empty table gives
no rows; columns other than the five are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import stored
from ledgerline.operators.ordering import numbered

ARITY = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(text: Column) -> Column:
    return F.sha2(F.concat(*[_field(F.col(c)) for c in FIELDS[:-1]], _field(text)), 256)


def _levels(leaves: DataFrame, name: str) -> list[DataFrame]:
    """Nodes of every level: (tree, low, high, n, digest, kids); level 0 are ``leaves`` (tree, low, high, n, ...).

    ``n`` is the number of leaves of the tree; a tree ends at the level whose one node covers them all.
    """
    largest = leaves.agg(F.max("n")).first()[0] or 0
    levels, width = [leaves], 1
    while largest > width:
        width *= ARITY
        nodes = (
            levels[-1]
            .where(F.col("n") > width // ARITY)
            .groupBy("tree", "n", F.expr(f"low div {width}").alias("bucket"))
            .agg(F.sort_array(F.collect_list(F.struct("low", "high", "digest"))).alias("kids"))
            .select(
                "tree",
                F.col("kids")[0]["low"].alias("low"),
                F.array_max("kids.high").alias("high"),
                "n",
                F.sha2(F.concat_ws("", "kids.digest"), 256).alias("digest"),
                "kids",
            )
        )
        levels.append(stored(nodes, name))
    return levels


def _siblings(low: str, high: str) -> Column:
    """Digests that the parent covers beside [low, high): those before it and those after it."""
    kids = F.col("kids")
    before = F.filter(kids, lambda k: k["high"] <= F.col(low))
    after = F.filter(kids, lambda k: k["low"] >= F.col(high))
    joined = [F.concat_ws("", F.transform(part, lambda k: k["digest"])) for part in (before, after)]
    return F.struct(joined[0].alias("left"), joined[1].alias("right"))


def _descend(levels: list[DataFrame], tops: DataFrame, extra: list[str], name: str) -> DataFrame:
    """The leaves with ``path`` (siblings of each level up to the top) and the columns ``extra`` of their tree's top.

    ``tops``: (tree, path, *extra) for the single node that ends each tree.
    """
    above = None
    for k in range(len(levels) - 1, -1, -1):
        width = ARITY**k
        nodes = levels[k]
        done = nodes.where(F.col("n") <= width).join(tops, "tree")
        if above is not None:
            parents = above.select(
                "tree", F.expr(f"low div {width * ARITY}").alias("bucket"), F.col("low").alias("_low"),
                F.col("high").alias("_high"), F.col("kids").alias("_kids"), F.col("path").alias("_path"), *extra,
            )
            rest = nodes.where(F.col("n") > width).withColumn("bucket", F.expr(f"low div {width * ARITY}"))
            inside = rest.join(parents, ["tree", "bucket"]).where("low >= _low and high <= _high")
            own = [c for c in nodes.columns if c != "kids"]
            siblings = inside.drop("kids").withColumnRenamed("_kids", "kids").withColumn("_own", _siblings("low", "high"))
            path = siblings.select(*own, F.concat(F.array("_own"), "_path").alias("path"), *extra)
            if k:
                path = path.join(nodes.select("tree", "low", "kids"), ["tree", "low"])
            done = done.select(*nodes.columns, "path", *extra).unionByName(path.select(*nodes.columns, "path", *extra))
        above = stored(done, name) if k else done
    return above


def _folded(start: Column) -> Column:
    """The digest that a leaf and the siblings of its path lead to."""
    return F.aggregate("path", start, lambda d, x: F.sha2(F.concat(x["left"], d, x["right"]), 256))


def manifest(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, source, rank, leaf, altered, subroot, root, path): every leaf with the siblings of its path.

    ``altered`` is the digest of the row with A-Z of the text lower-cased; ``path`` lists, level by level from leaf to
    root, the digests before and after the own node.
    """
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    tree = F.when(F.col("source").isNull(), "").otherwise(F.concat(F.lit("="), "source"))
    digests = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "source", tree.alias("tree"),
        leaf_digest(F.col("text")).alias("digest"),
        leaf_digest(F.translate("text", upper, lower)).alias("altered"),
    )
    placed = numbered(
        stored(digests, "leaves"), [F.col("doc_id").asc_nulls_first(), F.col("digest").asc()], ["tree"], "ranks", "low"
    )
    sizes = placed.groupBy("tree").agg(F.count("*").alias("n"))
    leaves = stored(placed.join(sizes, "tree").withColumn("high", F.col("low") + 1), "ranked")
    levels = _levels(leaves, "nodes")

    whole = None
    for k, nodes in enumerate(levels):
        ended = nodes.where(F.col("n") <= ARITY**k) if k == 0 else nodes.where(F.col("n").between(ARITY ** (k - 1) + 1, ARITY**k))
        ended = ended.select(F.col("tree").alias("of"), "digest")
        whole = ended if whole is None else whole.unionByName(ended)
    subroots = numbered(stored(whole, "subroots"), [F.col("of").asc()], name="order", column="low")
    trees = stored(
        subroots.select(
            F.lit("").alias("tree"), "of", "low", (F.col("low") + 1).alias("high"), "digest",
            F.lit(subroots.count()).cast("long").alias("n"),
        ),
        "trees",
    )
    upper_levels = _levels(trees, "tops")
    no_path = F.array().cast("array<struct<left:string,right:string>>")
    root = upper_levels[-1].where(F.col("high") - F.col("low") == F.col("n"))
    root = root.select("tree", no_path.alias("path"), F.col("digest").alias("root"))
    tops = _descend(upper_levels, root, ["root"], "upper").select(
        F.col("of").alias("tree"), "path", F.col("digest").alias("subroot"), "root"
    )
    found = _descend(levels, stored(tops, "subroot_paths"), ["subroot", "root"], "paths")
    return found.select(
        "doc_id", "source", F.col("low").alias("rank"), F.col("digest").alias("leaf"), "altered", "subroot", "root", "path"
    )


def report(docs: DataFrame) -> DataFrame:
    """Digest columns of ``documents``; rows whose id's checksum 5 divides are checked as if tampered with."""
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    siblings = F.concat_ws("", F.transform("path", lambda x: F.concat(x["left"], x["right"])))
    return (
        manifest(docs)
        .withColumn("folded_root", _folded(F.when(tampered, F.col("altered")).otherwise(F.col("leaf"))))
        .select(
            "doc_id", "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"), "folded_root",
            (F.col("folded_root") == F.col("root")).alias("verified"),
        )
    )


def _tree_sql(p: str, levels: int) -> list[str]:
    """CTEs of a tree over ``{p}0`` (tree, i, digest, ...): nodes ``{p}k``, its top ``{p}_top``, leaves with siblings ``{p}_path``."""
    parts = [f"{p}_n as (select tree, count(*) as n from {p}0 group by 1)"]
    columns, joins = [], []
    for k in range(levels):
        parts += [
            f"""{p}{k + 1} as (select tree, i // {ARITY} as i,
  case when max(n) = 1 then max(digest) else sha256(string_agg(digest, '' order by i)) end as digest
  from (select tree, i, digest, count(*) over (partition by tree) as n from {p}{k}) group by 1, 2)""",
            f"""{p}_s{k} as (select a.tree, a.i,
  coalesce(string_agg(b.digest, '' order by b.i) filter (where b.i < a.i), '') as l,
  coalesce(string_agg(b.digest, '' order by b.i) filter (where b.i > a.i), '') as r
  from {p}{k} a join {p}{k} b on a.tree = b.tree and a.i // {ARITY} = b.i // {ARITY} group by 1, 2)""",
        ]
        columns.append(f"s{k}.l as l{k}, s{k}.r as r{k}")
        joins.append(f"join {p}_s{k} s{k} on s{k}.tree = x.tree and s{k}.i = x.i // {ARITY**k}")
    return [
        *parts,
        f"{p}_top as (select tree, digest from {p}{levels})",
        f"{p}_path as (select x.*, n, {', '.join(columns)} from {p}0 x join {p}_n using (tree) {' '.join(joins)})",
    ]


def _fold_sql(rows: str, levels: int) -> str:
    """``rows`` with f0 folded to f{levels}; a tree of n leaves ends at the level that one node covers."""
    for k in range(levels):
        step = f"case when n <= {ARITY**k} then f{k} else sha256(l{k} || f{k} || r{k}) end"
        rows = f"select *, {step} as f{k + 1} from ({rows})"
    return rows


def sql(source: str, levels: int = 6) -> str:
    """The same rows in SQL, for trees of up to 16^levels leaves."""

    def leaf(text: str) -> str:
        columns = [*FIELDS[:-1], text]
        return "sha256(" + " || ".join(f"coalesce(strlen({c}::varchar)::varchar || ':' || {c}::varchar, '-')" for c in columns) + ")"

    siblings = " || ".join(f"l{k} || r{k}" for k in range(levels))
    crc = """xor(4294967295, list_reduce(list_prepend(4294967295::bigint,
    list_transform(range(strlen(id)), lambda i: ascii(id[i + 1])::bigint)), lambda c, b: list_reduce(
    list_prepend(xor(c, b), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))))"""
    return ",\n".join(
        [
            f"""with d as (select doc_id, doc_id::varchar as id, case when source is null then '' else '=' || source end as tree,
  {leaf("text")} as digest, {leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} as altered
  from {source})""",
            f"""a0 as (select *, row_number() over (partition by tree order by doc_id nulls first, digest) - 1 as i,
  coalesce({crc} % 5 = 0, false) as tampered from d)""",
            *_tree_sql("a", levels),
            "b0 as (select 0 as tree, row_number() over (order by tree) - 1 as i, digest, tree as of from a_top)",
            *_tree_sql("b", levels),
            f"""low as (select doc_id, tree as of, digest as leaf, {siblings} as lower_proof, f{levels} as folded
  from ({_fold_sql("select *, case when tampered then altered else digest end as f0 from a_path", levels)}))""",
            f"""high as ({_fold_sql(
                "select low.*, b_path.* exclude (of), folded as f0 from low join b_path using (of)", levels)})""",
        ]
    ) + f"""
select doc_id, leaf, digest as subroot, (select digest from b_top) as root,
  sha256(lower_proof || {siblings}) as proof_sha256, f{levels} as folded_root,
  f{levels} = (select digest from b_top) as verified from high"""
