"""Exact positions, bands, windows and running totals in a total order, without a window over all rows.

Rows are range-partitioned by the order, so every block holds one stretch of it; block sizes are counted and
summed up, and a row's position is its block's offset plus its place within the block. The window that sums
the sizes has one row per block. Many rows with one value spread over blocks, as the place in the
input is the last part of the order. The ordered rows are written once, so that positions never change when an
executor is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ledgerline.session import scratch_path

IN_BLOCK = 33  # monotonically_increasing_id: the partition above, the row within it below


def in_blocks(df: DataFrame, order: Sequence[Column], name: str, blocks: int | None = None) -> DataFrame:
    """``df`` in blocks of the order: adds ``_block`` (ascending) and ``_place`` (0, 1, ... within a block)."""
    spark = df.sparkSession
    blocks = blocks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [*order, F.col("_tie").asc()]
    path = scratch_path(spark, name)
    (
        df.withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(blocks, *keys)
        .sortWithinPartitions(*keys)
        .drop("_tie")
        .withColumn("_at", F.monotonically_increasing_id())
        .write.parquet(path)
    )
    stored = spark.read.schema(df.withColumn("_at", F.lit(0).cast("long")).schema).parquet(path)
    place = F.col("_at").bitwiseAND(F.lit((1 << IN_BLOCK) - 1).cast("long"))
    return stored.withColumns({"_block": F.shiftright("_at", IN_BLOCK), "_place": place}).drop("_at")


def before_blocks(sizes: DataFrame, amount: str) -> DataFrame:
    """(_block, before): the sum of ``amount`` over all earlier blocks; one row per block goes in."""
    earlier = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("_block", F.coalesce(F.sum(amount).over(earlier), F.lit(0).cast("long")).alias("before"))


def numbered(
    df: DataFrame, order: Sequence[Column], within: Sequence[str] = (), name: str = "numbered", column: str = "position"
) -> DataFrame:
    """Add ``column``: 0, 1, ... in the order, or within each value of ``within`` (which then sort first).

    Null groups count as one group. Rows that are equal in the order get positions in input order.
    """
    keys = [F.col(f"`{c}`").asc_nulls_first() for c in within] + list(order)
    placed = in_blocks(df, keys, name)
    sizes = placed.groupBy("_block").agg(F.count("*").alias("rows"))
    # one row per block: the number of shuffle partitions bounds it
    whole = placed.join(F.broadcast(before_blocks(sizes, "rows")), "_block")
    whole = whole.withColumn(column, F.col("before") + F.col("_place")).drop("_block", "_place", "before")
    if not within:
        return whole
    groups = whole.groupBy(*within).agg(F.min(column).alias("_first"))
    same = F.lit(True)
    for c in within:
        groups = groups.withColumnRenamed(c, f"_of_{c}")
        same = same & F.col(f"`{c}`").eqNullSafe(F.col(f"`_of_{c}`"))
    return whole.join(groups, same).withColumn(column, F.col(column) - F.col("_first")).select(*df.columns, column)


def ntile(
    df: DataFrame, order: Sequence[Column], bands: int, column: str = "band", name: str = "ntile"
) -> DataFrame:
    """Bands 1 to ``bands`` of equal size in the order (the first ones a row larger), as SQL's ``ntile`` deals them.

    The order should end with a key, so that equal values always fall into the same bands.
    """
    placed = numbered(df, order, name=name, column="_position")
    rows = placed.agg(F.count("*").alias("_rows"))
    size, larger = F.expr(f"_rows div {bands}"), F.col("_rows") % bands
    in_larger = F.col("_position") < larger * (size + 1)
    first = F.call_function("div", F.col("_position"), size + 1)
    rest = larger + F.call_function("div", F.col("_position") - larger * (size + 1), F.greatest(size, F.lit(1)))
    band = (F.when(in_larger, first).otherwise(rest) + 1).cast("int")
    return placed.crossJoin(F.broadcast(rows)).withColumn(column, band).drop("_position", "_rows")


def over_blocks(
    df: DataFrame,
    order: Sequence[Column],
    columns: Callable[[WindowSpec], dict[str, Column]],
    before: int = 0,
    after: int = 0,
    name: str = "series",
    blocks: int | None = None,
) -> DataFrame:
    """Window columns over one long series whose frames reach ``before`` rows back and ``after`` rows ahead.

    Every block is windowed by a task of its own, together with the rows next to it that its frames reach: these are the
    last and first rows of other blocks, handed over as copies and dropped again. ``columns`` maps the window to
    the new columns.
    """
    placed = in_blocks(df, order, name, blocks)
    sizes = [tuple(r) for r in placed.groupBy("_block").agg(F.count("*").alias("rows")).orderBy("_block").collect()]
    starts, at = [], 0
    for block, rows in sizes:  # one entry per block
        starts.append((block, at, at + rows))
        at += rows
    kinds = "array<struct<block: bigint, low: bigint, high: bigint>>"
    table = F.array(*[F.struct(*map(F.lit, s)) for s in starts]).cast(kinds)
    spans = placed.sparkSession.createDataFrame(starts, "_block bigint, _low bigint, _high bigint")
    whole = placed.join(F.broadcast(spans), "_block").withColumn("_position", F.col("_low") + F.col("_place"))
    border = whole.where((F.col("_position") >= F.col("_high") - before) | (F.col("_position") < F.col("_low") + after))

    def reached(x: Column) -> Column:
        behind = (F.col("_position") < x["low"]) & (F.col("_position") >= x["low"] - before)
        ahead = (F.col("_position") >= x["high"]) & (F.col("_position") < x["high"] + after)
        return behind | ahead

    handed = border.withColumn("_to", F.explode(F.transform(F.filter(table, reached), lambda x: x["block"])))
    rows = whole.withColumn("_to", F.col("_block")).withColumn("_own", F.lit(True))
    rows = rows.unionByName(handed.withColumn("_own", F.lit(False)))
    window = Window.partitionBy("_to").orderBy("_position")
    found = columns(window)
    return rows.withColumns(found).where("_own").select(*df.columns, *found)


def running_totals(df: DataFrame, order: Sequence[Column], value: str, column: str, name: str = "running") -> DataFrame:
    """Add the sum of ``value`` over all rows up to each one: block sums in front, a window within each block."""
    placed = in_blocks(df, order, name)
    sums = placed.groupBy("_block").agg(F.sum(value).alias("total"))
    earlier = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    front = sums.select("_block", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("_front"))
    within = Window.partitionBy("_block").orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)
    whole = placed.join(F.broadcast(front), "_block")
    return whole.withColumn(column, F.col("_front") + F.coalesce(F.sum(value).over(within), F.lit(0))).select(
        *df.columns, column
    )
