"""Relational queries: aggregations, reshaping, windows, sorts, joins,
filters and null handling, each with its DuckDB twin."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.catalog.registry import query, round_doubles
from quarry.functions import columns as C
from quarry.functions.rounding import rnd, rnd_sql as R
from quarry.operators import aggregates as A
from quarry.operators import filters as FL
from quarry.operators import joins as J
from quarry.operators import nulls as N
from quarry.operators import reshape as RS
from quarry.operators import windows as W
from quarry.operators.ordering import hash_unit_sql
from quarry.session import table

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
PART_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


def orders_with_nulls(spark, sf):
    """orders with NULLs injected: status 'P' and priority '5-LOW' become NULL."""
    o = table(spark, sf, "orders")
    return o.withColumn("o_orderstatus", F.expr("nullif(o_orderstatus, 'P')")).withColumn(
        "o_orderpriority", F.expr("nullif(o_orderpriority, '5-LOW')")
    )


ORDERS_NULLS_SQL = (
    "(SELECT o_orderkey, o_custkey, nullif(o_orderstatus, 'P') AS o_orderstatus, o_totalprice, o_orderdate,"
    " nullif(o_orderpriority, '5-LOW') AS o_orderpriority FROM orders)"
)


# ---- flagship: A7 on orders x customer (scan -> J3 -> A6 -> share -> O1) ------

def segment_priority_share(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_orderpriority")
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    joined = J.inner_renamed(o, c, "o_custkey", "c_custkey")
    return A.relative_frequency(joined, ["c_mktsegment"], "o_orderpriority").orderBy("c_mktsegment", F.desc("share"))


query(
    "a7_segment_priority_share",
    f"""SELECT c_mktsegment, o_orderpriority, count(*) AS n,
       {R('count(*) / sum(count(*)) OVER (PARTITION BY c_mktsegment)')} AS share
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment, o_orderpriority""",
)(segment_priority_share)


@query("a1_group_means", f"""SELECT l_returnflag, {R('avg(l_quantity)')} AS mean_l_quantity,
    {R('avg(l_extendedprice)')} AS mean_l_extendedprice, {R('avg(l_discount)')} AS mean_l_discount,
    {R('avg(l_tax)')} AS mean_l_tax FROM lineitem GROUP BY l_returnflag""")
def _a1(spark, sf):
    li = table(spark, sf, "lineitem")
    return round_doubles(A.group_means(li, ["l_returnflag"], ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]))


@query("a2_group_sum_count", f"""SELECT o_orderstatus, {R('sum(o_totalprice)', 2)} AS sum_o_totalprice,
    count(o_totalprice) AS count_o_totalprice FROM orders GROUP BY o_orderstatus""")
def _a2(spark, sf):
    return round_doubles(A.group_sum_count(table(spark, sf, "orders"), ["o_orderstatus"], "o_totalprice"), 2)


@query("a3_group_describe", f"""SELECT l_returnflag, count(l_quantity) AS n, {R('avg(l_quantity)')} AS mean,
    {R('stddev_samp(l_quantity)')} AS std, min(l_quantity) AS min,
    {R('quantile_cont(l_quantity, 0.25)')} AS q25, {R('quantile_cont(l_quantity, 0.5)')} AS q50,
    {R('quantile_cont(l_quantity, 0.75)')} AS q75, max(l_quantity) AS max FROM lineitem GROUP BY l_returnflag""")
def _a3(spark, sf):
    return round_doubles(A.group_describe(table(spark, sf, "lineitem"), ["l_returnflag"], "l_quantity"))


@query("a4_group_median", f"""SELECT p_brand, {R('median(p_retailprice)')} AS median FROM part GROUP BY p_brand""")
def _a4(spark, sf):
    return round_doubles(A.group_median(table(spark, sf, "part"), "p_brand", "p_retailprice"))


@query("a5_value_counts", "SELECT p_type, count(*) AS n FROM part WHERE p_type IS NOT NULL GROUP BY p_type")
def _a5(spark, sf):
    return A.value_counts(table(spark, sf, "part"), "p_type")


@query("a5_value_counts_keep_null",
       f"SELECT o_orderpriority, count(*) AS n FROM {ORDERS_NULLS_SQL} GROUP BY o_orderpriority")
def _a5b(spark, sf):
    return A.value_counts(orders_with_nulls(spark, sf), "o_orderpriority", dropna=False, sort="value")


@query("a6_counts_within", """SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders
    GROUP BY o_orderstatus, o_orderpriority""")
def _a6(spark, sf):
    return A.counts_within(table(spark, sf, "orders"), ["o_orderstatus"], "o_orderpriority")


@query("a8_share_total", f"""SELECT p_brand, count(*) AS n,
    {R('count(*) / (SELECT count(*) FROM part)')} AS share FROM part GROUP BY p_brand""")
def _a8(spark, sf):
    return A.relative_frequency_total(table(spark, sf, "part"), "p_brand")


_DESC_COLS = ["l_quantity", "l_discount", "l_tax"]


def _describe_sql(cols, source, where=""):
    parts = []
    stats = [
        ("count", "CAST(count({c}) AS DOUBLE)"), ("mean", "avg({c})"), ("std", "stddev_samp({c})"),
        ("min", "min({c})"), ("q25", "quantile_cont({c}, 0.25)"), ("q50", "quantile_cont({c}, 0.5)"),
        ("q75", "quantile_cont({c}, 0.75)"), ("max", "max({c})"),
    ]
    for c in cols:
        for name, expr in stats:
            e = expr.format(c=f"CAST({c} AS DOUBLE)")
            parts.append(f"SELECT '{c}' AS \"column\", '{name}' AS stat, {R(e)} AS value FROM {source} {where}")
    return " UNION ALL ".join(parts)


@query("a9_describe_numeric", _describe_sql(_DESC_COLS, "lineitem"))
def _a9(spark, sf):
    d = A.describe(table(spark, sf, "lineitem"), _DESC_COLS)
    return d.withColumn("value", rnd("value"))


@query("a9_describe_numeric_sorted", _describe_sql(_DESC_COLS, "lineitem"))
def _a9s(spark, sf):
    """A9 with exact quartiles from a distributed sort (the scale path for continuous columns)."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *_DESC_COLS)  # the key tells equal values apart
    d = A.describe(li, _DESC_COLS, method="sort")
    return d.withColumn("value", rnd("value"))


@query("a9_describe_categorical", """WITH long AS (
      SELECT 'p_brand' AS "column", p_brand AS value FROM part UNION ALL
      SELECT 'p_type', p_type FROM part UNION ALL SELECT 'p_name', p_name FROM part),
    freq AS (SELECT "column", value, count(*) AS n FROM long WHERE value IS NOT NULL GROUP BY ALL),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) AS r FROM freq)
    SELECT "column", CAST(sum(n) AS BIGINT) AS count, count(*) AS "unique",
      max(CASE WHEN r = 1 THEN value END) AS top, max(n) AS freq FROM ranked GROUP BY "column" """)
def _a9c(spark, sf):
    return A.describe_categorical(table(spark, sf, "part"), ["p_brand", "p_type", "p_name"])


@query("a10_filtered_describe", _describe_sql(["c_acctbal"], "customer", "WHERE c_acctbal > 0"))
def _a10(spark, sf):
    c = table(spark, sf, "customer")
    return A.filtered_describe(c, F.col("c_acctbal") > 0, ["c_acctbal"]).withColumn("value", rnd("value"))


@query("a11_distinct", "SELECT DISTINCT p_type FROM part")
def _a11(spark, sf):
    return A.distinct_values(table(spark, sf, "part"), "p_type")


@query("a12_dedup_report", """SELECT CAST(sum(n) AS BIGINT) AS rows_before, count(*) AS rows_after
    FROM (SELECT o_custkey, o_orderstatus, count(*) AS n FROM orders GROUP BY ALL)""")
def _a12(spark, sf):
    return A.dedup_report(table(spark, sf, "orders"), ["o_custkey", "o_orderstatus"])


@query("a13_functional_dependency", "SELECT p_brand, count(DISTINCT p_type) AS n_distinct FROM part GROUP BY p_brand")
def _a13(spark, sf):
    return A.functional_dependency(table(spark, sf, "part"), "p_brand", "p_type")


@query("a14_any_positive", """SELECT l_linestatus, max(CAST(l_discount <> 0 AS INTEGER)) AS any_l_discount,
    max(CAST(l_tax <> 0 AS INTEGER)) AS any_l_tax FROM lineitem GROUP BY l_linestatus""")
def _a14(spark, sf):
    return A.any_positive(table(spark, sf, "lineitem"), ["l_linestatus"], ["l_discount", "l_tax"])


@query("a15_moments", f"""SELECT count(l_extendedprice) AS n, {R('avg(l_extendedprice)')} AS mean,
    {R('stddev_samp(l_extendedprice)')} AS std, {R('var_samp(l_extendedprice)', 2)} AS var,
    {R('stddev_pop(l_extendedprice)')} AS std_pop, {R('var_pop(l_extendedprice)', 2)} AS var_pop,
    min(l_extendedprice) AS min, max(l_extendedprice) AS max FROM lineitem""")
def _a15(spark, sf):
    m = A.moments(table(spark, sf, "lineitem"), "l_extendedprice")
    return m.select("n", rnd("mean").alias("mean"), rnd("std").alias("std"), rnd("var", 2).alias("var"),
                    rnd("std_pop").alias("std_pop"), rnd("var_pop", 2).alias("var_pop"), "min", "max")


@query("a16_min_nonzero", """SELECT min(CASE WHEN l_discount <> 0 THEN l_discount END) AS min_nz_l_discount,
    min(CASE WHEN l_tax <> 0 THEN l_tax END) AS min_nz_l_tax FROM lineitem""")
def _a16(spark, sf):
    return A.min_nonzero(table(spark, sf, "lineitem"), ["l_discount", "l_tax"])


@query("a17_conditional_totals", f"""SELECT count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS n_match,
    {R("sum(CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice * 0.5 END)", 2)} AS weighted_sum FROM orders""")
def _a17(spark, sf):
    o = table(spark, sf, "orders")
    out = A.conditional_totals(o, F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice") * 0.5)
    return out.withColumn("weighted_sum", rnd("weighted_sum", 2))


@query("a18_chance_accuracy", f"""SELECT {R('sum(p * p)')} AS chance FROM (
    SELECT count(*) / (SELECT count(*) FROM orders) AS p FROM orders GROUP BY o_orderpriority)""")
def _a18(spark, sf):
    return A.chance_accuracy(table(spark, sf, "orders"), "o_orderpriority").withColumn("chance", rnd("chance"))


@query("a19_totals_frequency", """SELECT total, count(*) AS n_instants FROM (
    SELECT l_orderkey, sum(l_quantity) AS total FROM lineitem GROUP BY l_orderkey) GROUP BY total""")
def _a19(spark, sf):
    return A.totals_frequency(table(spark, sf, "lineitem"), "l_orderkey", "l_quantity")


@query("a20_rates", f"""SELECT l_returnflag, {R('sum(l_extendedprice)', 2)} AS sum_num, count(*) AS n,
    sum(l_quantity) AS sum_den, {R('sum(l_extendedprice) / count(*)')} AS per_row,
    {R('sum(l_extendedprice) / sum(l_quantity)')} AS per_unit FROM lineitem GROUP BY l_returnflag""")
def _a20(spark, sf):
    r = A.rates(table(spark, sf, "lineitem"), ["l_returnflag"], "l_extendedprice", "l_quantity")
    return r.select("l_returnflag", rnd("sum_num", 2).alias("sum_num"), "n", "sum_den",
                    rnd("per_row").alias("per_row"), rnd("per_unit").alias("per_unit"))


# ---- reshaping -----------------------------------------------------------------

@query("r1_pivot_counts", "SELECT o_orderstatus, " + ", ".join(
    f"count(*) FILTER (WHERE o_orderpriority = '{p}') AS \"{p}\"" for p in PRIORITIES) + " FROM orders GROUP BY o_orderstatus")
def _r1(spark, sf):
    return RS.pivot_counts(table(spark, sf, "orders"), "o_orderstatus", "o_orderpriority", PRIORITIES)


@query("r2_crosstab", "SELECT l_returnflag, " + ", ".join(
    f"count(*) FILTER (WHERE l_linestatus = '{s}') AS \"{s}\"" for s in ["F", "O"]) + " FROM lineitem GROUP BY l_returnflag")
def _r2(spark, sf):
    return RS.crosstab(table(spark, sf, "lineitem"), "l_returnflag", "l_linestatus", ["F", "O"])


@query("r3_pivot_values", "SELECT p_partkey, " + ", ".join(
    f"CASE WHEN p_type = '{t}' THEN p_retailprice END AS p_retailprice_{t}" for t in PART_TYPES) + " FROM part")
def _r3(spark, sf):
    return RS.pivot_values(table(spark, sf, "part"), "p_partkey", "p_type", "p_retailprice", PART_TYPES)


@query("r4_pivot_stats", "SELECT l_returnflag, " + ", ".join(
    f"count(l_quantity) FILTER (WHERE l_linestatus = '{s}') AS {s}_n, "
    f"{R(f'avg(l_quantity) FILTER (WHERE l_linestatus = {chr(39)}{s}{chr(39)})')} AS {s}_mean, "
    f"{R(f'stddev_samp(l_quantity) FILTER (WHERE l_linestatus = {chr(39)}{s}{chr(39)})')} AS {s}_std"
    for s in ["F", "O"]) + " FROM lineitem GROUP BY l_returnflag")
def _r4(spark, sf):
    return round_doubles(RS.pivot_stats(table(spark, sf, "lineitem"), "l_returnflag", "l_linestatus", "l_quantity",
                                        ["F", "O"]))


@query("r5_melt", """SELECT l_orderkey, l_linenumber, 'l_quantity' AS variable, l_quantity AS value FROM lineitem
    UNION ALL SELECT l_orderkey, l_linenumber, 'l_discount', l_discount FROM lineitem""")
def _r5(spark, sf):
    return RS.melt(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_quantity", "l_discount"])


@query("r6_value_group_pairs", """SELECT CAST(p_size AS DOUBLE) AS value, 'p_size' AS "group" FROM part WHERE p_size IS NOT NULL
    UNION ALL SELECT p_retailprice, 'p_retailprice' FROM part WHERE p_retailprice IS NOT NULL""")
def _r6(spark, sf):
    return RS.value_group_pairs(table(spark, sf, "part"), ["p_size", "p_retailprice"])


@query("r7_transpose", "SELECT 'r_regionkey' AS key, " + ", ".join(
    f"max(CASE WHEN r_name = '{n}' THEN r_regionkey END) AS \"{n}\"" for n in
    ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]) + " FROM region")
def _r7(spark, sf):
    return RS.transpose_small(table(spark, sf, "region"), "r_name")


@query("r8_top_values_report", """WITH long AS (
      SELECT 'p_brand' AS "column", p_brand AS value FROM part UNION ALL
      SELECT 'p_type', p_type FROM part UNION ALL SELECT 'p_size', CAST(p_size AS VARCHAR) FROM part),
    freq AS (SELECT "column", value, count(*) AS n FROM long GROUP BY ALL)
    SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value NULLS LAST) AS INTEGER)
      AS rank FROM freq) WHERE rank <= 3""")
def _r8(spark, sf):
    return RS.top_values_report(table(spark, sf, "part"), ["p_brand", "p_type", "p_size"], 3)


@query("r9_aligned_frequencies", """WITH long AS (SELECT 'l_returnflag' AS c, l_returnflag AS value FROM lineitem
      UNION ALL SELECT 'l_linestatus', l_linestatus FROM lineitem)
    SELECT value, count(*) FILTER (WHERE c = 'l_returnflag') AS l_returnflag,
      count(*) FILTER (WHERE c = 'l_linestatus') AS l_linestatus FROM long GROUP BY value""")
def _r9(spark, sf):
    out = RS.aligned_frequencies(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"])
    return out.select("value", *[F.col(c).cast("long").alias(c) for c in ["l_returnflag", "l_linestatus"]])


# ---- windows / sorts -------------------------------------------------------------

@query("w1_group_total", """SELECT l_orderkey, l_linenumber, l_quantity,
    sum(l_quantity) OVER (PARTITION BY l_orderkey) AS group_total FROM lineitem""")
def _w1(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return W.with_group_total(li, ["l_orderkey"], "l_quantity")


_RUNNING_SQL = """WITH f AS (SELECT p_brand, count(*) AS n FROM part WHERE p_brand IS NOT NULL GROUP BY p_brand)
    SELECT p_brand, n, CAST(sum(n) OVER (ORDER BY n DESC, p_brand ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cum_n,
      row_number() OVER (ORDER BY n DESC, p_brand) AS rank,
      {share} AS cum_share FROM f"""


@query("w2_running_share", _RUNNING_SQL.format(
    share=R("sum(n) OVER (ORDER BY n DESC, p_brand ROWS UNBOUNDED PRECEDING) / (SELECT sum(n) FROM f)")))
def _w2(spark, sf):
    freq = A.value_counts(table(spark, sf, "part"), "p_brand", sort=None)
    return W.running_share(freq, "p_brand").withColumn("cum_share", rnd("cum_share")).drop("prev_share")


@query("w3_cumulative_grid", f"""SELECT l_quantity, n, CAST(sum(n) OVER (ORDER BY l_quantity) AS BIGINT) AS cdf_n,
    {R('sum(n) OVER (ORDER BY l_quantity) / sum(n) OVER ()')} AS cdf
    FROM (SELECT l_quantity, count(*) AS n FROM lineitem GROUP BY l_quantity)""")
def _w3(spark, sf):
    # the grid is the set of distinct quantities (bounded: 1..50)
    grid = A.value_counts(table(spark, sf, "lineitem"), "l_quantity", sort=None)
    total = grid.agg(F.sum("n")).scalar()
    out = W.cumulative_over_grid(grid, "l_quantity", "n", "cdf_n")
    return out.withColumn("cdf", rnd(F.col("cdf_n") / total))


@query("w4_cumulative_contribution", f"""WITH t AS (SELECT p_brand, sum(p_retailprice) AS w FROM part GROUP BY p_brand),
    r AS (SELECT p_brand, w, sum(w) OVER (ORDER BY w DESC, p_brand ROWS UNBOUNDED PRECEDING) AS cum,
      row_number() OVER (ORDER BY w DESC, p_brand) AS rank, (SELECT sum(w) FROM t) AS total FROM t)
    SELECT p_brand, {R('w', 2)} AS w, rank, {R('cum / total')} AS cum_share FROM r WHERE (cum - w) / total < 0.5""")
def _w4(spark, sf):
    items = table(spark, sf, "part").groupBy("p_brand").agg(F.sum("p_retailprice").alias("w"))
    out = W.cumulative_contribution(items, "p_brand", "w", 0.5)
    return out.select("p_brand", rnd("w", 2).alias("w"), "rank", rnd("cum_share").alias("cum_share"))


@query("w5_rank", """SELECT o_orderpriority, n, CAST(rank() OVER (ORDER BY n DESC) AS INTEGER) AS rank
    FROM (SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY ALL)""")
def _w5(spark, sf):
    freq = A.value_counts(table(spark, sf, "orders"), "o_orderpriority", sort=None)
    return W.global_rank(freq, [("n", False)])


@query("o1_sort", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey")
def _o1(spark, sf):
    return W.sort(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"),
                  [F.desc("o_totalprice"), "o_orderkey"])


@query("o2_head", """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""")
def _o2(spark, sf):
    return W.head(table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice"),
                  [F.desc("o_totalprice"), "o_orderkey"], 10)


@query("o4_level_order", """SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY ALL""")
def _o4(spark, sf):
    freq = A.value_counts(table(spark, sf, "orders"), "o_orderpriority", sort=None)
    return W.order_by_levels(freq, "o_orderpriority", list(reversed(PRIORITIES)))


@query("o5_lump_by_share", """WITH f AS (SELECT p_brand, count(*) AS n FROM part WHERE p_brand IS NOT NULL GROUP BY ALL),
    r AS (SELECT p_brand, n, sum(n) OVER (ORDER BY n DESC, p_brand ROWS UNBOUNDED PRECEDING) AS cum,
      (SELECT sum(n) FROM f) AS total FROM f),
    k AS (SELECT p_brand FROM r WHERE (cum - n) / total < 0.5)
    SELECT CASE WHEN k.p_brand IS NOT NULL THEN part.p_brand ELSE 'Other' END AS p_brand, count(*) AS n
    FROM part LEFT JOIN k ON part.p_brand = k.p_brand GROUP BY 1""")
def _o5(spark, sf):
    lumped = W.lump_by_share(table(spark, sf, "part"), "p_brand", 0.5)
    return lumped.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"))


# ---- joins -----------------------------------------------------------------------

@query("j1_lookup", """SELECT l_orderkey, l_linenumber, p_brand, p_type FROM lineitem
    LEFT JOIN part ON l_partkey = p_partkey""")
def _j1(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("p_partkey"))
    p = table(spark, sf, "part").select("p_partkey", "p_brand", "p_type")
    return J.lookup(li, p, "p_partkey").drop("p_partkey")


@query("j2_left_exact_time", """WITH h AS (SELECT date_trunc('hour', ts) AS hour_ts, count(*) AS events_in_hour
      FROM events WHERE event_type = 'purchase' GROUP BY 1)
    SELECT event_id, event_type, events_in_hour FROM events LEFT JOIN h ON date_trunc('hour', ts) = h.hour_ts""")
def _j2(spark, sf):
    e = table(spark, sf, "events")
    hourly = (e.where(F.col("event_type") == "purchase")
              .groupBy(F.date_trunc("hour", "ts").alias("hour_ts")).agg(F.count(F.lit(1)).alias("events_in_hour")))
    left = e.select("event_id", "event_type", F.date_trunc("hour", "ts").alias("ev_hour"))
    return J.left_on_key(left, hourly, "ev_hour", "hour_ts").drop("ev_hour")


@query("j3_inner_renamed", """SELECT o_orderkey, o_totalprice, c_name, c_mktsegment FROM orders
    JOIN customer ON o_custkey = c_custkey""")
def _j3(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return J.inner_renamed(o, c, "o_custkey", "c_custkey")


@query("j4_full_outer", f"""WITH a AS (SELECT year(o_orderdate) AS yr, o_orderstatus, count(*) AS n_orders FROM orders GROUP BY ALL),
    b AS (SELECT year(o_orderdate) AS yr, o_orderstatus, {R('sum(o_totalprice)', 2)} AS urgent_total FROM orders
      WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 400000 GROUP BY ALL)
    SELECT CAST(coalesce(a.yr, b.yr) AS INTEGER) AS yr, coalesce(a.o_orderstatus, b.o_orderstatus) AS o_orderstatus,
      n_orders, urgent_total FROM a FULL JOIN b ON a.yr = b.yr AND a.o_orderstatus = b.o_orderstatus""")
def _j4(spark, sf):
    o = table(spark, sf, "orders").withColumn("yr", F.year("o_orderdate"))
    a = o.groupBy("yr", "o_orderstatus").agg(F.count(F.lit(1)).alias("n_orders"))
    b = (o.where((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_totalprice") > 400000))
         .groupBy("yr", "o_orderstatus").agg(rnd(F.sum("o_totalprice"), 2).alias("urgent_total")))
    return J.full_outer(a, b, ["yr", "o_orderstatus"])


@query("j5_side_by_side", """WITH b AS (SELECT p_brand AS value, count(*) AS n FROM part GROUP BY 1),
    t AS (SELECT p_type AS value, count(*) AS n FROM part GROUP BY 1),
    bn AS (SELECT row_number() OVER (ORDER BY n DESC, value) AS pos, * FROM b),
    tn AS (SELECT row_number() OVER (ORDER BY n DESC, value) AS pos, * FROM t)
    SELECT coalesce(bn.pos, tn.pos) AS pos, bn.value AS brand_value, bn.n AS brand_n, tn.value AS type_value, tn.n AS type_n
    FROM bn FULL JOIN tn ON bn.pos = tn.pos""")
def _j5(spark, sf):
    p = table(spark, sf, "part")
    b = p.groupBy(F.col("p_brand").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    t = p.groupBy(F.col("p_type").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    order = [F.desc("n"), F.asc("value")]
    return J.side_by_side({"brand": b, "type": t}, {"brand": order, "type": order})


_STATUS_NAMES = {"F": "filled", "O": "open", "P": "partial"}


@query("j8_map_values", """SELECT CASE o_orderstatus WHEN 'F' THEN 'filled' WHEN 'O' THEN 'open'
    WHEN 'P' THEN 'partial' ELSE 'unknown' END AS status_name, count(*) AS n FROM orders GROUP BY 1""")
def _j8(spark, sf):
    o = table(spark, sf, "orders")
    named = o.select(J.map_values("o_orderstatus", _STATUS_NAMES, F.lit("unknown")).alias("status_name"))
    return named.groupBy("status_name").agg(F.count(F.lit(1)).alias("n"))


@query("j9_semi_anti", """SELECT 'semi' AS kind, o_orderstatus, count(*) AS n FROM orders
      WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') GROUP BY ALL
    UNION ALL SELECT 'anti', o_orderstatus, count(*) FROM orders
      WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') GROUP BY ALL""")
def _j9(spark, sf):
    o = table(spark, sf, "orders")
    keys = table(spark, sf, "customer").where(F.col("c_mktsegment") == "BUILDING").select(
        F.col("c_custkey").alias("o_custkey"))
    s = J.semi(o, keys, "o_custkey").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    a = J.anti(o, keys, "o_custkey").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    return s.select(F.lit("semi").alias("kind"), "*").unionByName(a.select(F.lit("anti").alias("kind"), "*"))


# ---- filters ---------------------------------------------------------------------

@query("f1_mask_filter", """SELECT l_orderkey, l_linenumber, l_quantity, l_discount FROM lineitem
    WHERE (l_discount <> 0 AND l_quantity < 10) OR NOT (l_returnflag <> 'R' OR l_quantity <= 48)""")
def _f1(spark, sf):
    li = table(spark, sf, "lineitem")
    cond = ((F.col("l_discount") != 0) & (F.col("l_quantity") < 10)) | ~(
        (F.col("l_returnflag") != "R") | (F.col("l_quantity") <= 48))
    return li.where(cond).select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")


@query("f2_bounding_box", """SELECT c_custkey, c_nationkey, c_acctbal FROM customer
    WHERE c_acctbal BETWEEN 0 AND 5000 AND c_nationkey BETWEEN 5 AND 15""")
def _f2(spark, sf):
    c = table(spark, sf, "customer")
    return c.where(FL.in_box("c_acctbal", "c_nationkey", (0, 5000), (5, 15))).select(
        "c_custkey", "c_nationkey", "c_acctbal")


@query("f3_in_lists", """SELECT p_partkey, p_brand, p_type FROM part
    WHERE p_type IN ('PROMO', 'SMALL') AND p_brand NOT IN ('Brand#1', 'Brand#2', 'Brand#3')""")
def _f3(spark, sf):
    p = table(spark, sf, "part")
    return p.where(F.col("p_type").isin("PROMO", "SMALL") & ~F.col("p_brand").isin("Brand#1", "Brand#2", "Brand#3")
                   ).select("p_partkey", "p_brand", "p_type")


@query("f4_null_tests", f"""SELECT count(*) FILTER (WHERE o_orderstatus IS NULL) AS status_null,
    count(*) FILTER (WHERE o_orderstatus IS NOT NULL) AS status_present,
    count(*) FILTER (WHERE o_orderpriority IS NULL) AS priority_null FROM {ORDERS_NULLS_SQL}""")
def _f4(spark, sf):
    o = orders_with_nulls(spark, sf)
    return o.agg(F.count_if(F.col("o_orderstatus").isNull()).alias("status_null"),
                 F.count_if(F.col("o_orderstatus").isNotNull()).alias("status_present"),
                 F.count_if(F.col("o_orderpriority").isNull()).alias("priority_null"))


@query("f5_regex_filter", "SELECT p_partkey, p_name FROM part WHERE regexp_matches(p_name, '^(red|blue) |gear$')")
def _f5(spark, sf):
    return table(spark, sf, "part").where(C.matches("p_name", "^(red|blue) |gear$")).select("p_partkey", "p_name")


@query("f6_dropna", f"SELECT o_orderstatus, count(*) AS n FROM {ORDERS_NULLS_SQL} "
       "WHERE o_orderstatus IS NOT NULL AND o_orderpriority IS NOT NULL GROUP BY ALL")
def _f6(spark, sf):
    o = orders_with_nulls(spark, sf).na.drop(how="any", subset=["o_orderstatus", "o_orderpriority"])
    return o.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("f7_rows_with_nulls", f"SELECT o_orderkey, o_orderstatus, o_orderpriority FROM {ORDERS_NULLS_SQL} "
       "WHERE o_orderstatus IS NULL OR o_orderpriority IS NULL")
def _f7(spark, sf):
    o = orders_with_nulls(spark, sf).select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return FL.rows_with_nulls(o)


@query("f8_rows_at_max_ties", """SELECT p_partkey, p_retailprice FROM part
    WHERE p_retailprice = (SELECT max(p_retailprice) FROM part)""")
def _f8(spark, sf):
    return FL.rows_at_max(table(spark, sf, "part").select("p_partkey", "p_retailprice"), "p_retailprice",
                          all_ties=True)


@query("f8_rows_at_max_first", """SELECT p_partkey, p_size FROM part ORDER BY p_size DESC, p_partkey LIMIT 1""")
def _f8b(spark, sf):
    return FL.rows_at_max(table(spark, sf, "part").select("p_partkey", "p_size"), "p_size", ["p_partkey"])


@query("f9_assert_all", """SELECT bool_and(l_discount BETWEEN 0 AND 0.1) AS holds,
    count(*) FILTER (WHERE NOT (l_discount BETWEEN 0 AND 0.1)) AS violations FROM lineitem""")
def _f9(spark, sf):
    return FL.assert_all(table(spark, sf, "lineitem"), F.col("l_discount").between(0, 0.1))


@query("f10_exclude_text", "SELECT p_partkey, p_name FROM part WHERE NOT regexp_matches(p_name, 'bolt|gear')")
def _f10(spark, sf):
    return table(spark, sf, "part").where(FL.exclude_text("p_name", "bolt|gear")).select("p_partkey", "p_name")


# ---- nulls -----------------------------------------------------------------------

@query("n1_null_columns", f"""SELECT * FROM (SELECT 'o_orderkey' AS "column", count(*) FILTER (WHERE o_orderkey IS NULL) AS n_null FROM {ORDERS_NULLS_SQL}
    UNION ALL SELECT 'o_orderstatus', count(*) FILTER (WHERE o_orderstatus IS NULL) FROM {ORDERS_NULLS_SQL}
    UNION ALL SELECT 'o_orderpriority', count(*) FILTER (WHERE o_orderpriority IS NULL) FROM {ORDERS_NULLS_SQL}
    UNION ALL SELECT 'o_totalprice', count(*) FILTER (WHERE o_totalprice IS NULL) FROM {ORDERS_NULLS_SQL}) WHERE n_null > 0""")
def _n1(spark, sf):
    return N.null_columns(orders_with_nulls(spark, sf),
                          ["o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice"])


@query("n2_non_null_counts", f"""WITH c AS (SELECT count(o_orderkey) AS a, count(o_orderstatus) AS b,
      count(o_orderpriority) AS d FROM {ORDERS_NULLS_SQL})
    SELECT 'o_orderkey' AS "column", a AS n_non_null, greatest(a, b, d) - a AS missing_vs_max FROM c
    UNION ALL SELECT 'o_orderstatus', b, greatest(a, b, d) - b FROM c
    UNION ALL SELECT 'o_orderpriority', d, greatest(a, b, d) - d FROM c""")
def _n2(spark, sf):
    return N.non_null_counts(orders_with_nulls(spark, sf), ["o_orderkey", "o_orderstatus", "o_orderpriority"])


@query("n3_joint_missing", f"""SELECT 'status' AS subset, count(*) FILTER (WHERE o_orderstatus IS NULL) AS n_rows FROM {ORDERS_NULLS_SQL}
    UNION ALL SELECT 'priority', count(*) FILTER (WHERE o_orderpriority IS NULL) FROM {ORDERS_NULLS_SQL}
    UNION ALL SELECT 'both', count(*) FILTER (WHERE o_orderstatus IS NULL AND o_orderpriority IS NULL) FROM {ORDERS_NULLS_SQL}""")
def _n3(spark, sf):
    return N.joint_missing(orders_with_nulls(spark, sf), {
        "status": ["o_orderstatus"], "priority": ["o_orderpriority"], "both": ["o_orderstatus", "o_orderpriority"]})


@query("n4_fill", f"""SELECT coalesce(o_orderstatus, 'NaN') AS o_orderstatus, coalesce(o_orderpriority, 'Unknown') AS o_orderpriority,
    count(*) AS n FROM {ORDERS_NULLS_SQL} GROUP BY ALL""")
def _n4(spark, sf):
    o = N.fill(orders_with_nulls(spark, sf), {"o_orderstatus": "NaN", "o_orderpriority": "Unknown"})
    return o.groupBy("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@query("n5_median_replace", """SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN
      (SELECT median(c_acctbal) FROM customer WHERE NOT (c_acctbal < 0) AND c_acctbal > 0) ELSE c_acctbal END AS c_acctbal
    FROM customer""")
def _n5(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return round_doubles(N.replace_flagged_by_median(c, "c_acctbal", F.col("c_acctbal") < 0))


@query("n6_hot_deck", f"""WITH m AS (SELECT c_custkey, c_acctbal, c_acctbal < 0 AS flag FROM customer),
    d AS (SELECT c_custkey AS dkey, c_acctbal AS dval, CAST(floor({hash_unit_sql('c_custkey', None)} * 4096) AS INTEGER) AS b
      FROM m WHERE NOT flag),
    dn AS (SELECT dval, row_number() OVER (ORDER BY b, dkey) - 1 AS donor FROM d),
    n AS (SELECT count(*) AS nd FROM d)
    SELECT m.c_custkey, CASE WHEN flag THEN dn.dval ELSE m.c_acctbal END AS c_acctbal
    FROM m, n LEFT JOIN dn ON dn.donor = CASE WHEN flag THEN CAST(floor({hash_unit_sql('m.c_custkey', 7)} * n.nd) AS BIGINT) END""")
def _n6(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return N.hot_deck(c, "c_custkey", "c_acctbal", F.col("c_acctbal") < 0, seed=7)


@query("n7_recode_unknown", """SELECT CASE WHEN o_orderstatus IN ('P') THEN 'Unknown' ELSE o_orderstatus END AS o_orderstatus,
    count(*) AS n FROM orders GROUP BY 1""")
def _n7(spark, sf):
    o = N.recode_unknown(table(spark, sf, "orders"), "o_orderstatus", ["P"])
    return o.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
