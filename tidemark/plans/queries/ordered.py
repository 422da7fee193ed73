"""Joins by order over the test tables."""

from pyspark.sql import functions as F

from tidemark.operators import ordered_joins as oj
from tidemark.plans.queries.registry import query, table


@query(
    "shipments_as_of",
    "V06 F16",
    """WITH r AS (SELECT l_partkey, CAST(l_shipdate AS DATE) AS day, sum(l_quantity) AS shipped FROM lineitem GROUP BY 1, 2),
l AS (SELECT l_partkey, CAST(l_shipdate AS DATE) AS sent FROM lineitem),
j AS (SELECT l.*, r.day, r.shipped FROM l ASOF LEFT JOIN r ON l.l_partkey = r.l_partkey AND l.sent > r.day)
SELECT l_partkey, count(*) AS lines, count(*) FILTER (WHERE sent - day <= 60) AS matched, CAST(sum(sent - day) FILTER (WHERE sent - day <= 60) AS BIGINT) AS days,
       round(sum(shipped) FILTER (WHERE sent - day <= 60), 4) AS shipped FROM j GROUP BY 1""",
)
def shipments_as_of(spark, sf):
    """Lines with their part's latest earlier day of shipments, sixty days back at most."""
    lines = table(spark, sf, "lineitem").select("l_partkey", F.to_date("l_shipdate").alias("sent"), "l_quantity")
    days = lines.groupBy("l_partkey", F.col("sent").alias("day")).agg(F.sum("l_quantity").alias("shipped"))
    j = oj.as_of_join(lines.drop("l_quantity"), days, ["l_partkey"], "sent", "day", ["shipped"], tolerance=60, strict=True)
    return j.groupBy("l_partkey").agg(
        F.count(F.lit(1)).alias("lines"), F.count("day").alias("matched"), F.sum(F.datediff("sent", "day")).cast("bigint").alias("days"), F.round(F.sum("shipped"), 4).alias("shipped")
    )


@query(
    "orders_open_at",
    "C15 N14",
    """WITH e AS (SELECT l_orderkey, CAST(max(l_shipdate) AS DATE) AS last FROM lineitem GROUP BY 1),
i AS (SELECT o_custkey, o_orderkey AS open_order, CAST(o_orderdate AS DATE) AS first, CASE WHEN o_orderstatus <> 'O' THEN last END AS last FROM orders LEFT JOIN e ON l_orderkey = o_orderkey)
SELECT o.o_custkey, count(*) AS pairs, count(*) FILTER (WHERE i.last IS NULL) AS still_open, count(DISTINCT o.o_orderkey) AS orders
FROM orders o JOIN i ON i.o_custkey = o.o_custkey AND i.first <= CAST(o.o_orderdate AS DATE) AND (i.last IS NULL OR CAST(o.o_orderdate AS DATE) <= i.last) GROUP BY 1""",
)
def orders_open_at(spark, sf):
    """Orders of a customer that are open on the day of each order; an unfinished order has no last day."""
    ends = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.to_date(F.max("l_shipdate")).alias("end"))
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", F.to_date("o_orderdate").alias("day"))
    # as many rows as there are orders: not for a broadcast, however small their files
    spans = orders.join(ends.hint("merge"), "o_orderkey", "left").select(
        "o_custkey", F.col("o_orderkey").alias("open_order"), F.col("day").alias("first"), F.when(F.col("o_orderstatus") != "O", F.col("end")).alias("last")
    )
    met = oj.range_join(orders.select("o_custkey", "o_orderkey", "day"), spans, ["o_custkey"], "day", "first", "last")
    return met.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("pairs"), F.count_if(F.col("last").isNull()).alias("still_open"), F.count_distinct("o_orderkey").alias("orders")
    )
