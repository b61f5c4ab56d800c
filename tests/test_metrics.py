import pytest
from pyspark.sql import functions as F

from ledgerline.operators import filters, metrics, rollup
from ledgerline.suite.adapters import order_events, order_snapshot


def test_ties_are_broken_by_key(orders):
    rows = [(f"o{i}", "c", f"p{i}", 1, 10.0, "2024-01-01", "s") for i in (3, 1, 2)]
    top = metrics.top(metrics.product_totals(orders(rows)), "total_revenue", "product_id", 2)
    assert [r["product_id"] for r in top.collect()] == ["p1", "p2"]


def test_null_ids_are_not_orders_but_are_rows(orders):
    df = orders([("a", "c", "p", 1, 1.0, "2024-01-01", "s"), (None, None, None, None, None, None, None)])
    assert metrics.order_summary(df).first()["total_orders"] == 1
    assert metrics.order_summary(df, count_all_rows=True).first()["total_orders"] == 2
    assert metrics.row_count(df).first()[0] == 2


def test_empty_input(orders):
    empty = orders([("a", "c", "p", 1, 1.0, "2024-01-01", "s")]).filter("false")
    totals = metrics.order_totals(empty).first()
    assert totals["total_orders"] == 0 and totals["total_revenue"] is None
    assert metrics.status_distribution(empty).count() == 0
    assert metrics.hourly_trends(empty).count() == 0


def test_unparseable_times_fall_in_the_null_hour(orders):
    df = orders(
        [("a", "c", "p", 1, 1.0, "garbage", "s"), ("b", "c", "p", 1, 2.0, "2024-01-01T05:00:00", "s")]
    )
    assert {r["hour"]: r["revenue"] for r in metrics.hourly_totals(df).collect()} == {None: 1.0, 5: 2.0}


def test_shares_sum_to_100(spark, sf_dir):
    snapshot = order_snapshot(spark, sf_dir)
    rows = metrics.status_distribution(snapshot).collect()
    assert abs(sum(r["percentage"] for r in rows) - 100) <= 0.01 * len(rows)
    totals = metrics.status_totals(snapshot)
    given = metrics.share_of_total(totals, total=totals.agg({"count": "sum"}))
    assert {tuple(r) for r in given.collect()} == {tuple(r) for r in rows}


def test_products_customers_and_total_agree(spark, sf_dir):
    snapshot = order_snapshot(spark, sf_dir)
    total = metrics.order_summary(snapshot).first()["total_revenue"]
    by_product = metrics.product_totals(snapshot).agg(F.sum("total_revenue")).first()[0]
    by_customer = metrics.customer_totals(snapshot).agg(F.sum("total_spent")).first()[0]
    assert total == pytest.approx(by_product, rel=1e-12) == pytest.approx(by_customer, rel=1e-12)


def test_rollup_gives_the_same_tables(spark, sf_dir):
    events = order_events(spark, sf_dir)
    rolled = rollup.order_rollup(events)

    def same(left, right):
        assert left.columns == right.columns
        assert sorted(map(tuple, left.collect())) == sorted(map(tuple, right.collect()))

    same(rollup.overall_from_rollup(rolled), metrics.order_totals(events))
    products = metrics.top(metrics.product_totals(events), "total_revenue", "product_id")
    same(rollup.top_products_from_rollup(rolled), products)
    customers = metrics.top(metrics.customer_totals(events), "total_spent", "customer_id")
    same(rollup.top_customers_from_rollup(rolled), customers)
    same(rollup.status_from_rollup(rolled), metrics.status_distribution(events))
    same(rollup.hourly_from_rollup(rolled), metrics.hourly_trends(events))


def test_rollup_with_null_keys(orders):
    df = orders([("a", None, "p", 1, 1.0, "2024-01-01", None), ("b", "c", None, 2, 2.0, None, "s")])
    overall = rollup.overall_from_rollup(rollup.order_rollup(df)).first()
    assert tuple(overall) == tuple(metrics.order_totals(df).first())
    assert (overall["unique_customers"], overall["unique_products"]) == (1, 1)


def test_fallback(orders):
    df = orders([("a", "c", "p", 1, 1.0, "2024-01-01", "s"), ("b", "c", "p", 1, 1.0, "2024-01-02", "s")])

    def picked(date):
        return sorted(
            (r["order_id"], r["used_fallback"])
            for r in filters.on_date_or_all(df, date).collect()
        )

    assert picked("2024-01-02") == [("b", False)]
    assert picked("2030-01-01") == [("a", True), ("b", True)]
    assert filters.on_date(df, "2030-01-01").count() == 0
    assert filters.on_date_or_all(df.filter("false"), "2030-01-01").count() == 0


def test_run_date_defaults_to_yesterday(spark):
    got = spark.range(1).select(filters.run_date(), F.date_sub(F.current_date(), 1)).first()
    assert got[0] == got[1]
    with pytest.raises(ValueError):
        filters.run_date("nope")


def test_metric_changes(spark):
    history = spark.createDataFrame(
        [("2024-01-01", 10.0), ("2024-01-02", 15.0), ("2024-01-03", 0.0), ("2024-01-04", 5.0)],
        "processing_date string, total_revenue double",
    )
    rows = metrics.metric_changes(history, ["total_revenue"]).orderBy("processing_date").collect()
    assert [r["total_revenue_change"] for r in rows] == [None, 5.0, -15.0, 5.0]
    assert [r["total_revenue_change_percent"] for r in rows] == [None, 50.0, -100.0, None]
