"""Registration of queries and small SQL building blocks."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession


class Query(NamedTuple):
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register ``(spark, sf_dir) -> DataFrame`` under ``name``."""

    def register(run: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(run, sql)
        return run

    return register


def total(x: str, over: str = "") -> str:
    """Money sum as DOUBLE. Order amounts of the suite are whole cents, so sums are exact in any order."""
    return f"(sum(cast({x} as double)) {over})"


def mean(x: str, over: str = "") -> str:
    """Money sum over the count."""
    return f"({total(x, over)} / count({x}) {over})"


def rounded(x: str, places: int = 2) -> str:
    """Half-up on the decimal text."""
    return f"cast(round(cast({x} as decimal(38,12)), {places}) as double)"


# The order table as a log with repeated keys: order lines with the header's customer and status.
# The unit price in cents is a half-up integer division. All amounts are in cents: the tables' amounts have
# two decimals, so the unit changes and nothing is cut.
ORDER_LOG = """
order_log as (
  select cast(l_orderkey as varchar) || '-' || cast(l_linenumber as varchar) as order_id,
         cast(o_custkey as varchar) as customer_id,
         cast(l_partkey as varchar) as product_id,
         cast(l_quantity as integer) as quantity,
         ((2 * cast(round(l_extendedprice * 100) as bigint) + cast(l_quantity as bigint))
            // (2 * cast(l_quantity as bigint)))::double as price,
         l_shipdate as order_timestamp,
         o_orderstatus as status,
         cast(l_quantity as integer)
           * (((2 * cast(round(l_extendedprice * 100) as bigint) + cast(l_quantity as bigint))
            // (2 * cast(l_quantity as bigint)))::double) as total_amount,
         cast(l_shipdate as date) as order_date,
         l_returnflag, o_orderpriority, l_suppkey, l_partkey, l_extendedprice, l_quantity
  from lineitem join orders on l_orderkey = o_orderkey
)"""

# One row per order id: the newest line.
SNAPSHOT = (
    ORDER_LOG
    + """,
snapshot as (
  select * exclude (rn) from (
    select *, row_number() over (partition by order_id order by order_timestamp desc,
      l_partkey desc, l_suppkey desc, l_extendedprice desc, l_quantity desc) as rn
    from order_log)
  where rn = 1
)"""
)

# Events as orders with a time of day.
EVENTS = """
order_events as (
  select cast(event_id as varchar) as order_id,
         cast(user_id as varchar) as customer_id,
         regexp_extract(props, '"k": ([0-9]+)', 1) as product_id,
         1 as quantity,
         round(value * 100) as price,
         ts as order_timestamp,
         event_type as status,
         round(value * 100) as total_amount,
         cast(ts as date) as order_date
  from events
)"""

# Order headers: a long series with gaps.
HEADERS = """
order_headers as (
  select cast(o_orderkey as varchar) as order_id,
         cast(o_custkey as varchar) as customer_id,
         o_orderstatus as status,
         round(o_totalprice * 100) as total_amount,
         o_orderdate as order_timestamp,
         cast(o_orderdate as date) as order_date
  from orders
)"""


def daily(source: str, name: str = "daily", keys: str = "", where: str = "") -> str:
    """CTE of the daily series of a source; ``keys`` ends with a comma when given."""
    return f"""
{name} as (
  select {keys} cast(order_date as timestamp) as order_date,
         {total("total_amount")} as revenue,
         count(order_id) as order_count,
         {mean("total_amount")} as avg_order_value,
         cast(dayofweek(order_date) + 1 as integer) as day_of_week,
         dayname(order_date) as day_name
  from {source} {where}
  group by all
)"""
