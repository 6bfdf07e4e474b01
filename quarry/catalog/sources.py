"""Sources and sinks (S1-S12, K1-K2), set operations (U1-U3), the D5 time
zone drop and the streaming path; each source query writes a table derived
from the test data to a stage folder and reads it back with the operator."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, IntegerType, LongType, StringType, StructField, StructType)

from quarry.catalog.registry import query
from quarry.functions import columns as C
from quarry.sources import delimited as S
from quarry.sources.stage import stage_path, write_csv, write_stage
from quarry.session import table

CUSTOMER = StructType([StructField("c_custkey", LongType()), StructField("c_name", StringType()),
                       StructField("c_nationkey", IntegerType()), StructField("c_acctbal", DoubleType()),
                       StructField("c_mktsegment", StringType())])
PART = StructType([StructField("p_partkey", LongType()), StructField("p_name", StringType()),
                   StructField("p_brand", StringType()), StructField("p_type", StringType()),
                   StructField("p_size", IntegerType()), StructField("p_retailprice", DoubleType())])


@query("s1_csv_with_header", "SELECT * FROM customer")
def _s1(spark, sf):
    path = write_csv(table(spark, sf, "customer"), stage_path(spark, "s1"), header=True, compression=None)
    return S.read_csv(spark, path, CUSTOMER, header=True)


@query("s2_csv_names_supplied", "SELECT * FROM part")
def _s2(spark, sf):
    path = write_csv(table(spark, sf, "part"), stage_path(spark, "s2"), header=False, compression=None)
    return S.read_csv(spark, path, PART, header=False)


@query("s3_two_char_delimiter", "SELECT * FROM customer")
def _s3(spark, sf):
    path = write_csv(table(spark, sf, "customer"), stage_path(spark, "s3"), header=False, sep=", ", compression=None)
    return S.read_csv(spark, path, CUSTOMER, header=False, sep=", ")


@query("s4_null_sentinel", "SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS o_orderpriority FROM orders")
def _s4(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    path = write_csv(o, stage_path(spark, "s4"), header=True, compression=None)
    schema = StructType([StructField("o_orderkey", LongType()), StructField("o_orderpriority", StringType())])
    return S.read_csv(spark, path, schema, null_value="5-LOW")


def _with_extra_lines(spark, sf, marker: str, name: str):
    o = table(spark, sf, "orders").select(F.concat_ws(",", "o_orderkey", "o_orderstatus").alias("value"))
    extra = spark.range(1).select(F.lit(f"{marker} orders extract; columns: key, status").alias("value"))
    path = stage_path(spark, name)
    o.unionByName(extra).write.mode("overwrite").text(path)
    return path


_KS = StructType([StructField("o_orderkey", LongType()), StructField("o_orderstatus", StringType())])


@query("s5_skip_leading_line", "SELECT o_orderkey, o_orderstatus FROM orders")
def _s5(spark, sf):
    path = _with_extra_lines(spark, sf, "EXTRACT", "s5")
    return S.read_skipping(spark, path, _KS, "^EXTRACT ")


@query("s6_comment_lines", "SELECT o_orderkey, o_orderstatus FROM orders")
def _s6(spark, sf):
    path = _with_extra_lines(spark, sf, "#", "s6")
    return S.read_csv(spark, path, _KS, header=False, comment="#")


@query("s7_gzip_read", "SELECT * FROM customer")
def _s7(spark, sf):
    path = write_csv(table(spark, sf, "customer"), stage_path(spark, "s7"), header=True, compression="gzip")
    return S.read_csv(spark, path, CUSTOMER, header=True)


@query("s8_column_pruned_scan", "SELECT l_orderkey, l_extendedprice FROM lineitem")
def _s8(spark, sf):
    # only the two columns reach the Parquet reader (ReadSchema in the plan)
    return table(spark, sf, "lineitem").select("l_orderkey", "l_extendedprice")


@query("s9_parse_date_and_time", """SELECT o_orderkey, strftime(o_orderdate + to_hours(CAST(o_orderkey % 24 AS BIGINT)),
    '%Y-%m-%d %H:%M:%S') AS ts FROM orders""")
def _s9(spark, sf):
    o = table(spark, sf, "orders")
    txt = o.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("d"),
                   F.format_string("%02d:00:00", (F.col("o_orderkey") % 24).cast("int")).alias("t"))
    path = write_csv(txt, stage_path(spark, "s9"), header=True, compression=None)
    schema = StructType([StructField("o_orderkey", LongType()), StructField("d", StringType()),
                         StructField("t", StringType())])
    parsed = S.parse_datetime_columns(S.read_csv(spark, path, schema), "d", "t", "yyyy-MM-dd HH:mm:ss", "ts")
    return parsed.select("o_orderkey", F.date_format(F.col("ts").cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss").alias("ts"))


@query("s11_names_from_side_file", "SELECT * FROM customer")
def _s11(spark, sf):
    c = table(spark, sf, "customer")
    data = write_csv(c, stage_path(spark, "s11-data"), header=False, compression=None)
    lines = ["| customer extract description", "", "c_mktsegment: label column listing.",
             "| fields", "c_custkey: continuous.", "c_name: text.", "", "c_nationkey: code.", "c_acctbal: continuous."]
    desc = stage_path(spark, "s11-names")
    spark.createDataFrame([(i, s) for i, s in enumerate(lines)], "i int, value string").orderBy("i").select(
        "value").coalesce(1).write.mode("overwrite").text(desc)
    names = S.names_from_side_file(spark, desc, "c_mktsegment")
    raw = spark.read.option("header", False).csv(data)
    named = S.apply_names(raw, names)
    return C.cast_columns(named, {"c_custkey": "bigint", "c_nationkey": "int", "c_acctbal": "double"})


@query("s12_stage_table_reuse", """SELECT CAST(year(l_shipdate) AS INTEGER) AS yr, CAST(month(l_shipdate) AS INTEGER) AS mo, CAST(sum(l_quantity) AS DOUBLE) AS qty,
    count(*) AS n FROM lineitem GROUP BY 1, 2""")
def _s12(spark, sf):
    li = table(spark, sf, "lineitem")
    daily = li.groupBy(F.year("l_shipdate").alias("yr"), F.month("l_shipdate").alias("mo"),
                       F.to_date("l_shipdate").alias("day")).agg(F.sum("l_quantity").alias("qty"),
                                                                 F.count(F.lit(1)).alias("n"))
    path = write_stage(daily, stage_path(spark, "s12"), partition_by=["yr"])
    staged = spark.read.parquet(path)
    return staged.groupBy("yr", "mo").agg(F.sum("qty").alias("qty"), F.sum("n").alias("n"))


@query("k1_gzip_csv_sink", "SELECT c_custkey, c_mktsegment FROM customer")
def _k1(spark, sf):
    path = write_csv(table(spark, sf, "customer"), stage_path(spark, "k1"), header=True, compression="gzip",
                     columns=["c_custkey", "c_mktsegment"])
    schema = StructType([StructField("c_custkey", LongType()), StructField("c_mktsegment", StringType())])
    return S.read_csv(spark, path, schema)


@query("k2_projected_sink", "SELECT event_id, event_type FROM events")
def _k2(spark, sf):
    path = write_csv(table(spark, sf, "events"), stage_path(spark, "k2"), header=True, compression=None,
                     columns=["event_id", "event_type"])
    schema = StructType([StructField("event_id", LongType()), StructField("event_type", StringType())])
    return S.read_csv(spark, path, schema)


# ---- set operations ------------------------------------------------------------------

@query("u1_stack_results", """SELECT 'l_quantity' AS variable, count(l_quantity) AS n, round(avg(l_quantity) * 1e6) / 1e6 AS mean FROM lineitem
    UNION ALL SELECT 'l_discount', count(l_discount), round(avg(l_discount) * 1e6) / 1e6 FROM lineitem
    UNION ALL SELECT 'l_tax', count(l_tax), round(avg(l_tax) * 1e6) / 1e6 FROM lineitem""")
def _u1(spark, sf):
    """Results of several runs stacked with ``unionByName`` (one scan each is
    avoided: all runs come from one aggregate, unpivoted)."""
    from quarry.functions.rounding import rnd

    li = table(spark, sf, "lineitem")
    cols = ["l_quantity", "l_discount", "l_tax"]
    runs = [li.agg(F.lit(c).alias("variable"), F.count(c).alias("n"), rnd(F.avg(c)).alias("mean")) for c in cols]
    out = runs[0]
    for r in runs[1:]:
        out = out.unionByName(r)
    return out


@query("u2_same_rules_train_test", """SELECT CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN 'train' ELSE 'test' END AS split,
    CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'HIGH' ELSE 'OTHER' END AS priority, count(*) AS n FROM orders GROUP BY 1, 2""")
def _u2(spark, sf):
    """One rule function applied to train and test, tagged and unioned."""
    from quarry.operators.features import lump_except

    o = table(spark, sf, "orders")
    cut = F.lit("1998-01-01").cast("timestamp_ntz")

    def rules(df):
        return df.select(lump_except(F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.lit("HIGH"))
                                     .otherwise(F.col("o_orderpriority")), ["HIGH"], "OTHER").alias("priority"))

    tr = rules(o.where(F.col("o_orderdate") < cut)).withColumn("split", F.lit("train"))
    te = rules(o.where(~(F.col("o_orderdate") < cut))).withColumn("split", F.lit("test"))
    return tr.unionByName(te).groupBy("split", "priority").agg(F.count(F.lit(1)).alias("n"))


@query("u3_column_difference", "SELECT o_orderkey, o_custkey, CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority FROM orders")
def _u3(spark, sf):
    o = table(spark, sf, "orders")
    keep = [c for c in o.columns if c not in {"o_orderstatus", "o_totalprice"}]  # U3: set difference of names
    return o.select(*keep).withColumn("o_orderdate", F.col("o_orderdate").cast("string"))


@query("d5_drop_time_zone", """SELECT event_id, strftime(timezone('America/New_York', timezone('UTC', ts)), '%Y-%m-%d %H:%M:%S') AS local_ts FROM events""")
def _d5(spark, sf):
    e = table(spark, sf, "events")
    local = F.convert_timezone(F.lit("UTC"), F.lit("America/New_York"), F.col("ts"))
    return e.select("event_id", F.date_format(C.drop_zone(local), "yyyy-MM-dd HH:mm:ss").alias("local_ts"))


from quarry.catalog.registry import REGISTRY as _R  # noqa: E402


@query("st1_streaming_daylight", _R["j7_daylight_classify"][1])
def _st1(spark, sf):
    """The daylight classification run as a Structured Streaming job (availableNow)
    over a file stream of the events table; the result is read back from the sink."""
    from quarry.catalog.features import PLACE
    from quarry.streaming.stateless import classify_daylight_stream

    e = table(spark, sf, "events").select("event_id", "ts")
    src = write_stage(e, stage_path(spark, "st1-src"))
    sink, ck = stage_path(spark, "st1-sink"), stage_path(spark, "st1-ck")
    q = classify_daylight_stream(spark, src, e.schema, sink, ck, *PLACE)
    q.awaitTermination()
    return spark.read.parquet(sink).select("event_id", "daylight")
