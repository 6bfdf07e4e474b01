"""Column functions (P, G, D, M), category/feature operators (T) and
deterministic sampling (B), each with its DuckDB twin where SQL can say it."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.catalog.registry import query, round_doubles
from quarry.functions import columns as C
from quarry.functions.rounding import rnd, rnd_sql as R
from quarry.operators import daylight as DL
from quarry.operators import features as T
from quarry.operators import sampling as B
from quarry.operators.ordering import hash_unit, hash_unit_sql
from quarry.session import table

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
# place for the daylight dimension (latitude, longitude in degrees; fixed UTC offset in hours)
PLACE = (39.14, -77.20, -5.0)


# ---- P: projections ----------------------------------------------------------------

@query("p1_rename_rule", "SELECT p_partkey AS p_key, p_retailprice AS retail_price_usd FROM part")
def _p1(spark, sf):
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("p-key"), F.col("p_retailprice").alias("retail price-usd"))
    return C.rename_by_rule(p)


@query("p2_rename_map", "SELECT p_partkey AS key, p_brand AS brand_attr, p_type AS type_attr, p_size AS size FROM part")
def _p2(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    p = p.withColumnsRenamed({"p_brand": "p_brand_ATTRIBUTES", "p_type": "p_type_ATTRIBUTES"})
    return C.rename_map(p, {"p_partkey": "key"}, suffix=("_ATTRIBUTES", "_attr"), prefix=("p_", ""))


@query("p3_drop_columns", "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer")
def _p3(spark, sf):
    return C.drop_columns(table(spark, sf, "customer"), ["c_name", "no_such_column"], pattern="^c_acct")


@query("p4_slice_columns", "SELECT l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem")
def _p4(spark, sf):
    return C.slice_columns(table(spark, sf, "lineitem"), "l_quantity", "l_tax")


@query("p5_columns_of_type", "SELECT p_name, p_brand, p_type FROM part")
def _p5(spark, sf):
    p = table(spark, sf, "part")
    return p.select(*C.columns_of_type(p, "string"))


@query("p6_derived_column", f"""SELECT l_orderkey, l_linenumber,
    {R('l_extendedprice * (1 - l_discount)', 4)} AS revenue, l_quantity - 1 AS qty_minus_one FROM lineitem""")
def _p6(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", rnd(F.col("l_extendedprice") * (1 - F.col("l_discount")), 4)
                     .alias("revenue"), (F.col("l_quantity") - 1).alias("qty_minus_one"))


@query("p7_indicator", "SELECT o_orderkey, CAST(o_totalprice >= 300000 AS INTEGER) AS big FROM orders")
def _p7(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", C.indicator(F.col("o_totalprice") >= 300000).alias("big"))


@query("p8_update_where", """SELECT o_orderkey, CASE WHEN o_totalprice < 50000 THEN '5-LOW' ELSE o_orderpriority END
    AS o_orderpriority FROM orders""")
def _p8(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", C.update_where("o_orderpriority", F.col("o_totalprice") < 50000, "5-LOW"))


@query("p9_swap_where", """SELECT l_orderkey, l_linenumber,
    CASE WHEN l_tax > l_discount THEN l_tax ELSE l_discount END AS l_discount,
    CASE WHEN l_tax > l_discount THEN l_discount ELSE l_tax END AS l_tax FROM lineitem""")
def _p9(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_discount", "l_tax")
    return C.swap_where(li, "l_discount", "l_tax", F.col("l_tax") > F.col("l_discount"))


@query("p10_point_fix", """SELECT c_custkey, CASE WHEN c_custkey IN (1, 2, 3) THEN -c_acctbal ELSE c_acctbal END
    AS c_acctbal FROM customer""")
def _p10(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return C.flip_sign_for_keys(c, "c_custkey", [1, 2, 3], "c_acctbal")


@query("p11_cast", """SELECT l_orderkey, CAST(l_quantity AS INTEGER) AS l_quantity,
    CAST(l_linenumber AS BIGINT) AS l_linenumber, CAST(l_orderkey AS VARCHAR) AS key_text FROM lineitem""")
def _p11(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_quantity", "l_linenumber",
                                             F.col("l_orderkey").alias("key_text"))
    return C.cast_columns(li, {"l_quantity": "int", "l_linenumber": "bigint", "key_text": "string"})


@query("p13_label_by_position", "SELECT n_nationkey, " + "CASE n_regionkey " + " ".join(
    f"WHEN {i} THEN '{r}'" for i, r in enumerate(REGIONS)) + " END AS region_name FROM nation")
def _p13(spark, sf):
    n = table(spark, sf, "nation")
    return n.select("n_nationkey", C.label_by_position("n_regionkey", REGIONS).alias("region_name"))


# ---- G: strings ---------------------------------------------------------------------

@query("g1_replace_chars", "SELECT p_partkey, replace(p_name, ' ', '-') AS p_name FROM part")
def _g1(spark, sf):
    return table(spark, sf, "part").select("p_partkey", C.replace_chars("p_name", " ", "-").alias("p_name"))


@query("g2_split_part", "SELECT p_partkey, split_part(p_brand, '#', 2) AS brand_no, split_part(p_name, ' ', 1) AS adjective FROM part")
def _g2(spark, sf):
    p = table(spark, sf, "part")
    return p.select("p_partkey", C.split_part("p_brand", "#", 2).alias("brand_no"),
                    C.split_part("p_name", " ", 1).alias("adjective"))


@query("g3_squash_whitespace", "SELECT p_partkey, regexp_replace(trim(p_name), '\\s+', '', 'g') AS p_name FROM part")
def _g3(spark, sf):
    return table(spark, sf, "part").select("p_partkey", C.squash_whitespace("p_name").alias("p_name"))


@query("g4_concat", "SELECT p_partkey, p_type || '_' || p_brand AS label FROM part")
def _g4(spark, sf):
    return table(spark, sf, "part").select("p_partkey", C.join_text("p_type", "p_brand").alias("label"))


@query("g5_regex_flags", "SELECT p_partkey, regexp_matches(p_name, '^r|^.e|ge') AS hit FROM part")
def _g5(spark, sf):
    return table(spark, sf, "part").select("p_partkey", C.matches("p_name", "^r|^.e|ge").alias("hit"))


@query("g6_suffix", "SELECT p_partkey, ends_with(p_name, 'gear') AS is_gear FROM part")
def _g6(spark, sf):
    return table(spark, sf, "part").select("p_partkey", C.ends_with("p_name", "gear").alias("is_gear"))


# ---- D: dates -------------------------------------------------------------------------

@query("d1_parse_timestamp", """SELECT o_orderkey, strftime(strptime(strftime(o_orderdate, '%m/%d/%Y'), '%m/%d/%Y'),
    '%Y-%m-%d %H:%M:%S') AS parsed FROM orders""")
def _d1(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.date_format("o_orderdate", "MM/dd/yyyy").alias("txt"))
    ts = C.parse_timestamp("txt", "MM/dd/yyyy").cast("timestamp_ntz")
    return o.select("o_orderkey", F.date_format(ts, "yyyy-MM-dd HH:mm:ss").alias("parsed"))


@query("d2_date_plus_hours", """SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE) + to_hours(CAST(o_orderkey % 24 AS BIGINT)),
    '%Y-%m-%d %H:%M:%S') AS ts FROM orders""")
def _d2(spark, sf):
    o = table(spark, sf, "orders")
    ts = C.date_plus_hours(F.to_date("o_orderdate"), F.col("o_orderkey") % 24)
    return o.select("o_orderkey", F.date_format(ts, "yyyy-MM-dd HH:mm:ss").alias("ts"))


@query("d3_date_and_time_parts", """SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day,
    CAST(hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS INTEGER) AS sec_of_day FROM events""")
def _d3(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", F.to_date("ts").cast("string").alias("day"), C.seconds_of_day("ts").alias("sec_of_day"))


@query("d4_calendar_parts", """SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour, CAST(dayofyear(ts) AS INTEGER) AS dayofyear,
    CAST(isodow(ts) - 1 AS INTEGER) AS weekday, dayname(ts) AS weekday_name FROM events""")
def _d4(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", *[v.alias(k) for k, v in C.calendar_parts("ts").items()])


@query("d6_time_of_day_compare", """SELECT event_type, count(*) FILTER (WHERE hour(ts) * 3600 + minute(ts) * 60 + second(ts) < 21600)
    AS before_six, count(*) AS n FROM events GROUP BY event_type""")
def _d6(spark, sf):
    e = table(spark, sf, "events")
    return e.groupBy("event_type").agg(F.count_if(C.seconds_of_day("ts") < 6 * 3600).alias("before_six"),
                                       F.count(F.lit(1)).alias("n"))


# ---- M: maths -------------------------------------------------------------------------

@query("m1_math", f"""SELECT l_orderkey, l_linenumber, {R('ln(l_quantity)')} AS ln_q, {R('sqrt(l_extendedprice)')} AS sqrt_p,
    {R('exp(l_discount)')} AS exp_d, {R('pow(l_quantity, 2)')} AS sq_q, {R('abs(l_tax - 0.04)')} AS abs_t FROM lineitem""")
def _m1(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", rnd(C.log_or_neg_inf("l_quantity")).alias("ln_q"),
                     rnd(F.sqrt("l_extendedprice")).alias("sqrt_p"), rnd(F.exp("l_discount")).alias("exp_d"),
                     rnd(F.pow("l_quantity", 2)).alias("sq_q"), rnd(F.abs(F.col("l_tax") - 0.04)).alias("abs_t"))


@query("m2_round_half_even", "SELECT l_orderkey, l_linenumber, round_even(l_quantity / 4, 0) AS q4 FROM lineitem")
def _m2(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", C.round_half_even(F.col("l_quantity") / 4, 0).alias("q4"))


@query("m3_clip_logistic", f"""SELECT l_orderkey, l_linenumber, least(greatest(l_quantity, 10), 40) AS clipped,
    {R('1 / (1 + exp(-((l_quantity - 25) / 10)))')} AS logistic FROM lineitem""")
def _m3(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", C.clip("l_quantity", 10, 40).alias("clipped"),
                     rnd(C.logistic((F.col("l_quantity") - 25) / 10)).alias("logistic"))


# ---- T: features ------------------------------------------------------------------------

_TRAIN = "l_shipdate < TIMESTAMP '1998-01-01'"


@query("t1_minmax_fit_apply", f"""WITH p AS (SELECT min(l_quantity) AS mn_q, max(l_quantity) AS mx_q,
      min(l_extendedprice) AS mn_p, max(l_extendedprice) AS mx_p FROM lineitem WHERE {_TRAIN})
    SELECT l_orderkey, l_linenumber, {R('(l_quantity - mn_q) / (mx_q - mn_q)')} AS l_quantity_s,
      {R('(l_extendedprice - mn_p) / (mx_p - mn_p)')} AS l_extendedprice_s FROM lineitem, p""")
def _t1(spark, sf):
    li = table(spark, sf, "lineitem")
    cols = ["l_quantity", "l_extendedprice"]
    params = T.fit_minmax(li.where(F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz")), cols)
    out = T.apply_minmax(li, params, cols, suffix="_s")
    return out.select("l_orderkey", "l_linenumber", rnd("l_quantity_s").alias("l_quantity_s"),
                      rnd("l_extendedprice_s").alias("l_extendedprice_s"))


@query("t2_zscore_fit_apply", f"""WITH p AS (SELECT avg(l_quantity) AS m, stddev_pop(l_quantity) AS s FROM lineitem WHERE {_TRAIN})
    SELECT l_orderkey, l_linenumber, {R('(l_quantity - m) / s')} AS l_quantity_z FROM lineitem, p""")
def _t2(spark, sf):
    li = table(spark, sf, "lineitem")
    params = T.fit_zscore(li.where(F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz")), ["l_quantity"])
    out = T.apply_zscore(li, params, ["l_quantity"], suffix="_z")
    return out.select("l_orderkey", "l_linenumber", rnd("l_quantity_z").alias("l_quantity_z"))


_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@query("t3_one_hot", "SELECT p_partkey, " + ", ".join(
    f"CAST(p_type = '{t}' AS INTEGER) AS p_type_{t}" for t in _TYPES) + " FROM part")
def _t3(spark, sf):
    p = table(spark, sf, "part")
    levels = T.fit_levels(p, "p_type")
    return T.one_hot(p.select("p_partkey", "p_type"), "p_type", levels)


@query("t4_drop_reference", "SELECT p_partkey, " + ", ".join(
    f"CAST(p_type = '{t}' AS INTEGER) AS p_type_{t}" for t in _TYPES if t != "PROMO") + " FROM part")
def _t4(spark, sf):
    p = table(spark, sf, "part")
    dummies = T.one_hot(p.select("p_partkey", "p_type"), "p_type", T.fit_levels(p, "p_type"))
    return T.drop_reference(dummies, "p_type", "PROMO")


@query("t5_ordinal", """SELECT o_orderkey, CAST(coalesce(CASE nullif(o_orderpriority, '5-LOW') """ + " ".join(
    f"WHEN '{p}' THEN {i}" for i, p in enumerate(reversed(PRIORITIES))) + " END, -1) AS INTEGER) AS priority_level FROM orders")
def _t5(spark, sf):
    o = table(spark, sf, "orders").withColumn("o_orderpriority", F.expr("nullif(o_orderpriority, '5-LOW')"))
    return o.select("o_orderkey", T.ordinal("o_orderpriority", list(reversed(PRIORITIES))).alias("priority_level"))


@query("t6_codes", "SELECT p_partkey, CAST(dense_rank() OVER (ORDER BY p_brand) - 1 AS INTEGER) AS p_brand_code FROM part")
def _t6(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_brand")
    return T.apply_codes(p, T.fit_codes(p, "p_brand"), "p_brand").drop("p_brand")


_TE_TRAIN = "o_orderdate < TIMESTAMP '1998-01-01'"


@query("t7_target_encoding", f"""WITH tr AS (SELECT o_orderpriority, CAST(o_orderstatus = 'F' AS DOUBLE) AS y FROM orders WHERE {_TE_TRAIN}),
    pr AS (SELECT avg(y) AS prior FROM tr),
    st AS (SELECT o_orderpriority, count(*) AS n, avg(y) AS m FROM tr GROUP BY 1),
    enc AS (SELECT o_orderpriority, CASE WHEN n = 1 THEN prior ELSE
      prior * (1 - 1 / (1 + exp(-(n - 1) / 1.0))) + m * (1 / (1 + exp(-(n - 1) / 1.0))) END AS e FROM st, pr)
    SELECT o_orderkey, {R('coalesce(e, prior)')} AS o_orderpriority_te FROM orders LEFT JOIN enc USING (o_orderpriority), pr
    WHERE NOT ({_TE_TRAIN})""")
def _t7(spark, sf):
    o = table(spark, sf, "orders").withColumn("y", (F.col("o_orderstatus") == "F").cast("double"))
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    enc = T.fit_target_encoding(o.where(F.col("o_orderdate") < cut), "o_orderpriority", "y")
    test = o.where(~(F.col("o_orderdate") < cut)).select("o_orderkey", "o_orderpriority")
    out = T.apply_target_encoding(test, enc, "o_orderpriority")
    return out.select("o_orderkey", rnd("o_orderpriority_te").alias("o_orderpriority_te"))


@query("t8_quantile_bins", f"""WITH e AS (SELECT quantile_cont(l_extendedprice, [0, 0.25, 0.5, 0.75, 1.0]) AS q FROM lineitem),
    b AS (SELECT CAST((l_extendedprice > q[2])::INT + (l_extendedprice > q[3])::INT + (l_extendedprice > q[4])::INT AS INTEGER) AS bin, q
      FROM lineitem, e)
    SELECT bin, count(*) AS n, {R('q[bin + 1]', 4)} AS bin_lo, {R('q[bin + 2]', 4)} AS bin_hi FROM b GROUP BY bin, q""")
def _t8(spark, sf):
    li = table(spark, sf, "lineitem")
    binned = T.apply_quantile_bins(li, T.fit_quantile_edges(li, "l_extendedprice", 4), "l_extendedprice", 4)
    return binned.groupBy("bin", "bin_lo", "bin_hi").agg(F.count(F.lit(1)).alias("n")).select(
        "bin", "n", rnd("bin_lo", 4).alias("bin_lo"), rnd("bin_hi", 4).alias("bin_hi"))


@query("t9_equal_depth_bins", """SELECT p_partkey, CAST(floor((row_number() OVER (ORDER BY p_retailprice, p_partkey) - 1) / 100) AS BIGINT)
    AS bin FROM part""")
def _t9(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_retailprice")
    return T.equal_depth_bins(p, ["p_retailprice", "p_partkey"], 100).drop("p_retailprice")


@query("t10_threshold_bins", """SELECT CASE WHEN c_acctbal < 0 THEN 'negative' WHEN c_acctbal < 2500 THEN 'low'
    WHEN c_acctbal < 7500 THEN 'mid' ELSE 'high' END AS band, count(*) AS n FROM customer GROUP BY 1""")
def _t10(spark, sf):
    c = table(spark, sf, "customer")
    band = T.threshold_bins("c_acctbal", [0, 2500, 7500], ["negative", "low", "mid", "high"])
    return c.groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("n"))


@query("t11_consolidate", """SELECT CASE WHEN p_type IN ('LARGE', 'MEDIUM') THEN 'BIG' WHEN p_type IN ('SMALL') THEN 'LITTLE'
    ELSE p_type END AS p_group, count(*) AS n FROM part GROUP BY 1""")
def _t11(spark, sf):
    p = table(spark, sf, "part")
    g = T.consolidate("p_type", {"BIG": ["LARGE", "MEDIUM"], "LITTLE": ["SMALL"]})
    return p.groupBy(g.alias("p_group")).agg(F.count(F.lit(1)).alias("n"))


_KEEP = [f"Brand#{i}" for i in range(1, 6)]


@query("t12_lump_except", "SELECT CASE WHEN p_brand IN (" + ", ".join(f"'{b}'" for b in _KEEP) +
       ") THEN p_brand ELSE 'Other' END AS brand, count(*) AS n FROM part GROUP BY 1")
def _t12(spark, sf):
    p = table(spark, sf, "part")
    return p.groupBy(T.lump_except("p_brand", _KEEP).alias("brand")).agg(F.count(F.lit(1)).alias("n"))


@query("t13_spelling_candidates", """WITH w AS (SELECT split_part(p_name, ' ', 2) AS word FROM part)
    SELECT word, count(*) AS n, levenshtein(upper(word), 'GEAR') AS distance, 'gear' AS canonical FROM w
    WHERE regexp_matches(word, '^g|r$|a') GROUP BY word HAVING levenshtein(upper(word), 'GEAR') <= 3""")
def _t13(spark, sf):
    w = table(spark, sf, "part").select(C.split_part("p_name", " ", 2).alias("word"))
    return T.spelling_candidates(w, "word", "gear", "^g|r$|a", 3)


@query("t13_apply_spelling_table", """WITH w AS (SELECT split_part(p_name, ' ', 2) AS word FROM part),
    c AS (SELECT word AS from_value, 'gear' AS to_value FROM w WHERE regexp_matches(word, '^g|r$|a')
      GROUP BY word HAVING levenshtein(upper(word), 'GEAR') <= 3)
    SELECT coalesce(to_value, word) AS word, count(*) AS n FROM w LEFT JOIN c ON word = from_value GROUP BY 1""")
def _t13b(spark, sf):
    """T13 / T11 long form: the spelling table (candidates -> canonical) joined on the value."""
    w = table(spark, sf, "part").select(C.split_part("p_name", " ", 2).alias("word"))
    rules = T.spelling_candidates(w, "word", "gear", "^g|r$|a", 3).select(
        F.col("word").alias("from_value"), F.col("canonical").alias("to_value"))
    return T.consolidate_by_table(w, "word", rules).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


_T14_KEEP = ["PROMO_A", "PROMO_B", "SMALL_Brand#1", "LARGE_Brand#2"]


@query("t14_hierarchical_label", """WITH l AS (SELECT CASE WHEN p_type = 'PROMO' THEN p_type || '_' ||
      CASE WHEN regexp_matches(p_brand, '#1') THEN 'A' ELSE 'B' END ELSE p_type || '_' || p_brand END AS label FROM part)
    SELECT CASE WHEN label IN ('PROMO_A', 'PROMO_B', 'SMALL_Brand#1', 'LARGE_Brand#2') THEN label ELSE 'Other' END AS label,
      count(*) AS n FROM l GROUP BY 1""")
def _t14(spark, sf):
    p = table(spark, sf, "part")
    lab = T.hierarchical_label("p_type", "p_brand", "PROMO", "#1", _T14_KEEP)
    return p.groupBy(lab.alias("label")).agg(F.count(F.lit(1)).alias("n"))


@query("t15_regional_group", """SELECT CASE WHEN c_nationkey IS NULL THEN 'unknown' WHEN c_nationkey = 0 THEN 'home'
    WHEN c_nationkey IN (5, 10) THEN 'neighbour' WHEN n_regionkey = 0 THEN 'region' ELSE 'foreign' END AS area,
    count(*) AS n FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""")
def _t15(spark, sf):
    c = table(spark, sf, "customer")
    n = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
    j = c.join(F.broadcast(n), "c_nationkey", "left")  # nation: 25 rows by definition
    area = T.regional_group("c_nationkey", "n_regionkey", 0, [5, 10], 0)
    return j.groupBy(area.alias("area")).agg(F.count(F.lit(1)).alias("n"))


@query("t16_calendar_features", """SELECT CAST(isodow(ts) - 1 AS INTEGER) AS weekday, CAST(hour(ts) AS INTEGER) AS hour,
    count(*) AS n FROM events GROUP BY 1, 2""")
def _t16(spark, sf):
    e = table(spark, sf, "events").withColumns(C.calendar_parts("ts"))
    return e.groupBy("weekday", "hour").agg(F.count(F.lit(1)).alias("n"))


@query("t17_skew_reduction", f"""SELECT l_orderkey, l_linenumber, {R('sqrt(l_discount)')} AS sqrt_l_discount,
    {R('ln(l_extendedprice)')} AS log_l_extendedprice FROM lineitem""")
def _t17(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_discount", "l_extendedprice")
    out = T.reduce_skew(li, ["l_discount"], ["l_extendedprice"]).drop("l_discount", "l_extendedprice")
    return round_doubles(out)


def _coords(spark, sf):
    c = table(spark, sf, "customer")
    lat = F.col("c_acctbal") / 200.0
    lon = -(F.col("c_nationkey") * 4.0)
    u = hash_unit("c_custkey", seed=3)
    return c.select("c_custkey", F.when(u < 0.1, lon).otherwise(lat).alias("lat"),
                    F.when(u < 0.1, lat).when(u > 0.9, -lon).otherwise(lon).alias("lon"))


@query("t18_coordinate_repair", f"""WITH c AS (SELECT c_custkey, c_acctbal / 200.0 AS a, -(c_nationkey * 4.0) AS o,
      {hash_unit_sql('c_custkey', 3)} AS u FROM customer),
    raw AS (SELECT c_custkey, CASE WHEN u < 0.1 THEN o ELSE a END AS lat,
      CASE WHEN u < 0.1 THEN a WHEN u > 0.9 THEN -o ELSE o END AS lon FROM c),
    nn AS (SELECT * FROM raw WHERE lat IS NOT NULL AND lon IS NOT NULL),
    sw AS (SELECT c_custkey, CASE WHEN lon BETWEEN 20 AND 45 AND lat BETWEEN -80 AND -20 THEN lon ELSE lat END AS lat,
      CASE WHEN lon BETWEEN 20 AND 45 AND lat BETWEEN -80 AND -20 THEN lat ELSE lon END AS lon FROM nn),
    fx AS (SELECT c_custkey, lat, CASE WHEN NOT (lon BETWEEN -80 AND -20) AND (-lon BETWEEN -80 AND -20) THEN -lon ELSE lon END AS lon FROM sw)
    SELECT c_custkey, lat, lon FROM fx WHERE lat BETWEEN 20 AND 45 AND lon BETWEEN -80 AND -20""")
def _t18(spark, sf):
    return T.repair_coordinates(_coords(spark, sf), "lat", "lon", (20, 45), (-80, -20))


@query("t19_daily_rollup", """SELECT CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS day, round(avg(l_quantity) * 100) / 100 AS l_quantity,
    round(avg(l_discount) * 100) / 100 AS l_discount, max(CAST(coalesce(CAST(l_returnflag = 'R' AS INTEGER), 0) AS INTEGER)) AS returned
    FROM lineitem GROUP BY 1 HAVING avg(l_quantity) IS NOT NULL AND avg(l_discount) IS NOT NULL""")
def _t19(spark, sf):
    li = table(spark, sf, "lineitem")
    out = T.daily_rollup(li, F.to_date("l_shipdate"), ["l_quantity", "l_discount"],
                         [F.col("l_returnflag") == "R"], ["returned"])
    return out.withColumn("day", F.col("day").cast("string"))


_DL = DL.daylight_sql("d", *PLACE)


@query("t20_daylight_dimension", "WITH dd AS (SELECT DISTINCT CAST(ts - INTERVAL 300 MINUTE AS DATE) AS d FROM events) "
       "SELECT CAST(d AS VARCHAR) AS day, " + ", ".join(f"{v} AS {k}" for k, v in _DL.items()) + " FROM dd")
def _t20(spark, sf):
    e = table(spark, sf, "events").select(F.to_date(F.col("ts") - F.expr("INTERVAL 300 MINUTES")).alias("d"))
    dim = DL.daylight_dimension(e, "d", *PLACE)
    return dim.withColumn("day", F.col("day").cast("string"))


_DL_E = DL.daylight_sql("CAST(lt AS DATE)", *PLACE)
_SEC = "(hour(lt) * 3600 + minute(lt) * 60 + second(lt))"


@query("j7_daylight_classify", "WITH ev AS (SELECT event_id, ts - INTERVAL 300 MINUTE AS lt FROM events), "
       "b AS (SELECT event_id, " + _SEC + " AS s, " + ", ".join(f"{v} AS {k}" for k, v in _DL_E.items()) + " FROM ev) "
       "SELECT event_id, CASE WHEN s < blue_am_start THEN 'night' WHEN s < golden_am_start THEN 'blue_hour' "
       "WHEN s < golden_am_end THEN 'golden_hour' WHEN s < golden_pm_start THEN 'day' WHEN s < blue_pm_start THEN 'golden_hour' "
       "WHEN s < blue_pm_end THEN 'blue_hour' ELSE 'night' END AS daylight FROM b")
def _j7(spark, sf):
    e = table(spark, sf, "events").select("event_id", "ts")
    return DL.classify_daylight(e, "ts", *PLACE).select("event_id", "daylight")


@query("t21_assemble_features")
def _t21(spark, sf):
    li = table(spark, sf, "lineitem")
    return T.assemble(li, ["l_quantity", "l_discount", "l_tax"], "l_returnflag")


@query("t22_strip_test_labels", f"""WITH t AS (SELECT CASE WHEN {hash_unit_sql('o_orderkey', 1)} < 0.3 THEN 'test' ELSE 'train' END AS split,
      CASE WHEN {hash_unit_sql('o_orderkey', 1)} < 0.3 THEN o_orderstatus || '.' ELSE o_orderstatus END AS raw FROM orders)
    SELECT split, rtrim(raw, '.') AS label, count(*) AS n FROM t GROUP BY ALL""")
def _t22(spark, sf):
    o = B.hash_split(table(spark, sf, "orders"), "o_orderkey", 0.3, seed=1)
    raw = F.when(F.col("split") == "test", F.concat("o_orderstatus", F.lit("."))).otherwise(F.col("o_orderstatus"))
    return o.select("split", T.strip_trailing(raw).alias("label")).groupBy("split", "label").agg(
        F.count(F.lit(1)).alias("n"))


@query("t23_drop_leakage", "SELECT o_orderkey, o_custkey, CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority FROM orders")
def _t23(spark, sf):
    out = C.drop_columns(table(spark, sf, "orders"), ["o_totalprice", "o_orderstatus"])
    return out.withColumn("o_orderdate", F.col("o_orderdate").cast("string"))


# ---- B: sampling -------------------------------------------------------------------------

@query("b1_hash_sample", f"SELECT o_orderkey FROM orders WHERE {hash_unit_sql('o_orderkey', 42)} < 0.1")
def _b1(spark, sf):
    return B.hash_sample(table(spark, sf, "orders"), "o_orderkey", 0.1, seed=42).select("o_orderkey")


@query("b2_hash_split", f"""SELECT CASE WHEN {hash_unit_sql('o_orderkey', 5)} < 0.2 THEN 'test' ELSE 'train' END AS split,
    count(*) AS n FROM orders GROUP BY 1""")
def _b2(spark, sf):
    o = B.hash_split(table(spark, sf, "orders"), "o_orderkey", 0.2, seed=5)
    return o.groupBy("split").agg(F.count(F.lit(1)).alias("n"))


_B3 = f"""WITH r AS (SELECT o_orderkey, o_orderpriority,
      row_number() OVER (PARTITION BY o_orderpriority ORDER BY {hash_unit_sql('o_orderkey', 9)}, o_orderkey) AS pos,
      count(*) OVER (PARTITION BY o_orderpriority) AS n FROM orders)"""


@query("b3_stratified_split", _B3 + """ SELECT o_orderkey, CASE WHEN pos <= floor(n * 0.6) THEN 'train'
    WHEN pos <= floor(n * 0.8) THEN 'valid' ELSE 'test' END AS split FROM r""")
def _b3(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    out = B.stratified_split(o, "o_orderkey", "o_orderpriority", [0.6, 0.2, 0.2], ["train", "valid", "test"], seed=9)
    return out.select("o_orderkey", "split")


@query("b4_stratified_folds", _B3 + " SELECT o_orderkey, CAST((pos - 1) % 5 AS INTEGER) AS fold FROM r")
def _b4(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return B.stratified_folds(o, "o_orderkey", "o_orderpriority", 5, seed=9).select("o_orderkey", "fold")


def bootstrap_sql(key: str, value: str, source: str, reps: int, seed: int, by: str = "") -> str:
    u = hash_unit_sql([key, "rep"], seed)
    by_sel = f"{by}, " if by else ""
    return f"""WITH w AS (SELECT {by_sel}rep, {value} AS x, {B.poisson1_sql(u)} AS w
        FROM {source}, generate_series(1, {reps}) AS g(rep)),
      a AS (SELECT {by_sel}rep, sum(w) AS n, sum(w * x) AS sx, sum(w * x * x) AS sxx FROM w WHERE w > 0 GROUP BY ALL)
      SELECT {by_sel}CAST(rep AS INTEGER) AS rep, CAST(n AS INTEGER) AS n, {R('sx / n')} AS mean,
        {R('sqrt(greatest((sxx - sx * sx / n) / (n - 1), 0))')} AS sd FROM a"""


@query("b5_bootstrap_moments", bootstrap_sql("c_custkey", "c_acctbal", "customer", 200, 11))
def _b5(spark, sf):
    c = table(spark, sf, "customer")
    m = B.bootstrap_moments(c, "c_custkey", "c_acctbal", 200, seed=11)
    return m.select("rep", F.col("n").cast("int").alias("n"), rnd("mean").alias("mean"), rnd("sd").alias("sd"))


@query("t3_one_hot_sparse", """WITH l AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM (SELECT DISTINCT o_custkey AS v FROM orders WHERE o_custkey IS NOT NULL))
    SELECT o_orderkey, CAST(code AS INTEGER) AS position, 1.0::DOUBLE AS value FROM orders JOIN l ON l.v = o_custkey WHERE o_custkey <> (SELECT min(o_custkey) FROM orders)""")
def _t3_sparse(spark, sf):
    """One level per customer: far more levels than columns could hold; the first one is the reference."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    first = o.agg(F.min("o_custkey")).first()[0]
    v = T.one_hot_sparse(o, T.fit_codes(o, "o_custkey"), "o_custkey", "v", reference=first)
    return T.sparse_entries(v, "o_orderkey", "v")


_CLS = ["F", "O", "P"]


@query("t7_class_encoding", f"""WITH tr AS (SELECT o_orderpriority, o_orderstatus FROM orders WHERE {_TE_TRAIN}),
    pr AS (SELECT {', '.join(f"avg(CAST(o_orderstatus = '{c}' AS DOUBLE)) AS p{c}" for c in _CLS)} FROM tr),
    st AS (SELECT o_orderpriority, count(*) AS n, {', '.join(f"avg(CAST(o_orderstatus = '{c}' AS DOUBLE)) AS m{c}" for c in _CLS)} FROM tr GROUP BY 1),
    e AS (SELECT o_orderpriority, {', '.join(f"CASE WHEN n = 1 THEN p{c} ELSE p{c} * (1 - 1 / (1 + exp(-(n - 1) / 1.0))) + m{c} / (1 + exp(-(n - 1) / 1.0)) END AS e{c}" for c in _CLS)} FROM st, pr)
    SELECT o_orderkey, {', '.join(f'{R(f"coalesce(e{c}, p{c})")} AS "o_orderpriority_{c}"' for c in _CLS)} FROM orders LEFT JOIN e USING (o_orderpriority), pr WHERE NOT ({_TE_TRAIN})""")
def _t7_classes(spark, sf):
    o = table(spark, sf, "orders")
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    enc = T.fit_class_encoding(o.where(F.col("o_orderdate") < cut), "o_orderpriority", "o_orderstatus", _CLS)
    test = o.where(~(F.col("o_orderdate") < cut)).select("o_orderkey", "o_orderpriority")
    out = T.apply_class_encoding(test, enc, "o_orderpriority", _CLS)
    return out.select("o_orderkey", *[rnd(f"o_orderpriority_{c}").alias(f"o_orderpriority_{c}") for c in _CLS])


_ROW = ["l_quantity", "l_discount", "l_tax"]


@query("t2_scale_rows", f"""WITH m AS (SELECT *, (l_quantity + l_discount + l_tax) / 3 AS m FROM lineitem),
    s AS (SELECT *, sqrt((pow(l_quantity - m, 2) + pow(l_discount - m, 2) + pow(l_tax - m, 2)) / 3) AS s FROM m)
    SELECT l_orderkey, l_linenumber, {', '.join(f'{R(f"({c} - m) / s")} AS {c}_r' for c in _ROW)} FROM s""")
def _t2_rows(spark, sf):
    out = T.scale_rows(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *_ROW), _ROW, "_r")
    return out.select("l_orderkey", "l_linenumber", *[rnd(f"{c}_r").alias(f"{c}_r") for c in _ROW])


@query("j6_columns_of_the_same_row", "SELECT p_partkey, p_retailprice, CAST(p_type = 'PROMO' AS INTEGER) AS promo, p_retailprice / 2 AS half FROM part")
def _j6(spark, sf):
    from quarry.operators.joins import add_columns_same_rows

    p = table(spark, sf, "part").select("p_partkey", "p_retailprice", "p_type")
    return add_columns_same_rows(p, {"promo": (F.col("p_type") == "PROMO").cast("int"), "half": F.col("p_retailprice") / 2}).drop("p_type")
