"""The same operators on the large fact tables as they are."""

from __future__ import annotations

from pyspark.sql import functions as F

from loyalscope.catalogue.base import query, sql_rate, table
from loyalscope.catalogue.distribution_queries import box_sql, correlation_sql, describe_sql, histogram_sql, rounded_box
from loyalscope.operators import cleaning, distributions, evaluation, features, learning, quality, reports, segments
from loyalscope.operators.quantiles import medians

_MEASURES = ["l_quantity", "l_extendedprice", "l_discount"]


@query("a8_describe_lineitem", describe_sql("lineitem", _MEASURES))
def describe_lineitem(spark, sf_dir):
    return distributions.describe_numeric(table(spark, sf_dir, "lineitem"), _MEASURES)


@query("a10_correlate_lineitem", correlation_sql("lineitem", _MEASURES))
def correlate_lineitem(spark, sf_dir):
    return distributions.correlations(table(spark, sf_dir, "lineitem"), _MEASURES)


@query("a12_histogram_price", histogram_sql("lineitem", "l_extendedprice", 30, "l_returnflag"))
def histogram_price(spark, sf_dir):
    return distributions.histogram(table(spark, sf_dir, "lineitem"), "l_extendedprice", 30, ["l_returnflag"])


@query("a13_box_price", box_sql("lineitem", "l_extendedprice", "l_returnflag"))
def box_price(spark, sf_dir):
    return rounded_box(distributions.box_stats(table(spark, sf_dir, "lineitem"), "l_extendedprice", ["l_returnflag"]))


@query("a16_median_by_priority", """SELECT o_orderpriority, 'o_totalprice' AS feature, round(quantile_cont(o_totalprice, 0.5), 4) AS median
    FROM orders GROUP BY o_orderpriority""")
def median_by_priority(spark, sf_dir):
    found = medians(table(spark, sf_dir, "orders"), ["o_totalprice"], ["o_orderpriority"])
    return found.withColumn("median", F.round("median", 4))


_FILLED = "count(*) FILTER (WHERE o_orderstatus = 'F')"


@query("a2_filled_by_priority", f"""SELECT o_orderpriority, count(*) AS total, {_FILLED} AS churned,
    {sql_rate(_FILLED, 'count(*)', 2)} AS churn_rate_pct FROM orders GROUP BY o_orderpriority""")
def filled_by_priority(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("filled", (F.col("o_orderstatus") == "F").cast("int"))
    return reports.rate_by(orders, "o_orderpriority", "filled")


@query("a5_price_share", f"""SELECT l_returnflag, l_linestatus, price, {sql_rate('price', '(sum(price) OVER ())', 2)} AS share_pct
    FROM (SELECT l_returnflag, l_linestatus, round(sum(l_extendedprice), 2) AS price FROM lineitem GROUP BY ALL)""")
def price_share(spark, sf_dir):
    grouped = table(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.round(F.sum("l_extendedprice"), 2).alias("price"))
    return reports.with_share(grouped, "price", digits=2)


@query("a6_events_by_user", "SELECT user_id, count(*) AS count FROM events GROUP BY user_id")
def events_by_user(spark, sf_dir):
    return reports.value_counts(table(spark, sf_dir, "events"), "user_id")


_SHAPE = "l_suppkey, l_quantity, l_discount"


@query("c6_repeated_lines", f"""SELECT CAST(sum(n - 1) AS BIGINT) AS duplicate_rows
    FROM (SELECT count(*) AS n FROM lineitem GROUP BY {_SHAPE})""")
def repeated_lines(spark, sf_dir):
    return quality.duplicate_count(table(spark, sf_dir, "lineitem").select(*_SHAPE.split(", ")))


@query("c11_order_keys", """SELECT count(*) AS total_rows, count(DISTINCT o_orderkey) AS distinct_keys,
    count(*) = count(DISTINCT o_orderkey) AS is_unique FROM orders""")
def order_keys(spark, sf_dir):
    return quality.key_report(table(spark, sf_dir, "orders"), "o_orderkey")


@query("m7_auc_of_price", """SELECT o_orderpriority, round((CAST(sum(place) FILTER (WHERE label = 1) AS DOUBLE) - n1 * (n1 + 1) / 2.0) / (n1 * n0), 4) AS roc_auc
    FROM (SELECT o_orderpriority, label, count(*) FILTER (WHERE label = 1) OVER w AS n1, count(*) FILTER (WHERE label = 0) OVER w AS n0,
        rank() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice)
        + (count(*) OVER (PARTITION BY o_orderpriority, o_totalprice) - 1) / 2.0 AS place
        FROM (SELECT *, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label FROM orders) WINDOW w AS (PARTITION BY o_orderpriority))
    GROUP BY o_orderpriority, n1, n0""")
def auc_of_price(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("filled", (F.col("o_orderstatus") == "F").cast("int"))
    return evaluation.roc_auc(orders, ["o_orderpriority"], "filled", "o_totalprice")


@query("t1_largest_orders", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def largest_orders(spark, sf_dir):
    filled = segments.filter_segment(table(spark, sf_dir, "orders"), equals={"o_orderstatus": "F"})
    return segments.top_n(filled.select("o_orderkey", "o_totalprice"), "o_totalprice", 20, "o_orderkey")


_FLAGS = ["l_returnflag", "l_linestatus"]


@query("a2f_discounted_by_each", " UNION ALL ".join(f"""SELECT '{d}' AS feature, {d} AS value, count(*) AS total,
    count(*) FILTER (WHERE l_discount >= 0.05) AS churned,
    round_even(count(*) FILTER (WHERE l_discount >= 0.05) * 100.0::DOUBLE / count(*), 1) AS churn_rate_pct FROM lineitem GROUP BY {d}""" for d in _FLAGS))
def discounted_by_each(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumn("discounted", (F.col("l_discount") >= 0.05).cast("int"))
    return reports.rate_by_each(lines, _FLAGS, "discounted")


@query("a9_describe_lineitem_flags", " UNION ALL ".join(f"""SELECT '{c}' AS feature, CAST(sum(n) AS BIGINT) AS count, count(*) AS "unique",
    min_by(v, (-n, v)) AS top, max(n) AS freq FROM (SELECT {c} AS v, count(*) AS n FROM lineitem GROUP BY {c})""" for c in _FLAGS))
def describe_lineitem_flags(spark, sf_dir):
    return distributions.describe_categorical(table(spark, sf_dir, "lineitem"), _FLAGS)


@query("a20_lineitem_bounds", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", min({c}) AS min, max({c}) AS max FROM lineitem" for c in _MEASURES))
def lineitem_bounds(spark, sf_dir):
    return reports.bounds(table(spark, sf_dir, "lineitem"), _MEASURES)


@query("f5_quantity_bands", """SELECT quantity_band, count(*) AS count FROM (SELECT CASE WHEN l_quantity > 0 AND l_quantity <= 10 THEN 'small'
    WHEN l_quantity > 10 AND l_quantity <= 30 THEN 'medium' WHEN l_quantity > 30 AND l_quantity <= 45 THEN 'large' END AS quantity_band FROM lineitem)
    GROUP BY quantity_band""")
def quantity_bands(spark, sf_dir):
    lines = features.bin_column(table(spark, sf_dir, "lineitem"), "l_quantity", [0, 10, 30, 45], ["small", "medium", "large"], "quantity_band")
    return lines.groupBy("quantity_band").agg(F.count("*").alias("count"))


@query("m2_split_orders", """, n AS (SELECT CAST(count(*) FILTER (WHERE o_orderstatus <> 'F') AS DOUBLE) AS n0,
        CAST(count(*) FILTER (WHERE o_orderstatus = 'F') AS DOUBLE) AS n1 FROM orders),
    q AS (SELECT n0, n1, wanted, floor(e0) + CASE WHEN e0 - floor(e0) >= e1 - floor(e1) THEN wanted - floor(e0) - floor(e1) ELSE 0 END AS q0
        FROM (SELECT *, wanted * n0 / (n0 + n1) AS e0, wanted * n1 / (n0 + n1) AS e1 FROM (SELECT *, ceil((n0 + n1) * 0.25::DOUBLE) AS wanted FROM n)))
    SELECT 0 AS label, CAST(q0 AS BIGINT) AS held_out, CAST(n0 - q0 AS BIGINT) AS kept FROM q
    UNION ALL SELECT 1, CAST(wanted - q0 AS BIGINT), CAST(n1 - wanted + q0 AS BIGINT) FROM q""")
def split_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderstatus") == "F").cast("int").alias("label"))
    kept, held_out = learning.stratified_split(orders, key="o_orderkey", fraction=0.25)
    both = kept.withColumn("side", F.lit(0)).unionByName(held_out.withColumn("side", F.lit(1)))
    return both.groupBy("label").agg(F.count_if(F.col("side") == 1).alias("held_out"), F.count_if(F.col("side") == 0).alias("kept"))


@query("a21_events_by_type", """SELECT event_type, count(*) FILTER (WHERE value > 20) AS churned, count(*) FILTER (WHERE value <= 20) AS retained
    FROM events GROUP BY event_type""")
def events_by_type(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("large", F.when(F.col("value").isNotNull(), (F.col("value") > 20).cast("int")))
    return reports.split_by(events, ["event_type"], "large")


@query("c8_event_gaps", """SELECT 'large_value' AS "column", count(*) FILTER (WHERE value <= 20 OR value IS NULL) AS missing_count,
    round(count(*) FILTER (WHERE value <= 20 OR value IS NULL) * 100.0::DOUBLE / count(*), 2) AS missing_pct FROM events""")
def event_gaps(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", F.when(F.col("value") > 20, F.col("value")).alias("large_value"))
    return quality.null_report(events)


@query("c2_fill_event_gaps", """SELECT event_id, round(coalesce(CASE WHEN value > 20 THEN value END,
    (SELECT quantile_cont(value, 0.5) FROM events WHERE value > 20)), 4) AS large_value FROM events""")
def fill_event_gaps(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", F.when(F.col("value") > 20, F.col("value")).alias("large_value"))
    return cleaning.impute_median(events, ["large_value"]).withColumn("large_value", F.round("large_value", 4))
