"""

scan -> join -> clean / lump / encode -> split -> scale (fit on train) ->
drop reference levels -> assemble -> random forest and naive Bayes ->
ROC, AUC, best thresholds, accuracy -> one comparison table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import evaluation as E
from quarry.operators import features as T
from quarry.operators import models as M
from quarry.operators.joins import inner_renamed
from quarry.operators.sampling import hash_split
from quarry.session import table

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def census_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority",
                                               "o_orderstatus", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    j = inner_renamed(o, c, "o_custkey", "c_custkey")
    x = j.select(
        "o_orderkey", "o_totalprice", "c_acctbal", "c_mktsegment",
        T.ordinal("o_orderpriority", PRIORITIES).alias("priority"),
        T.lump_except(F.col("c_nationkey").cast("string"), [str(i) for i in range(5)], "other").alias("nation"),
        F.month("o_orderdate").alias("month"),
        (F.col("o_orderstatus") == "F").cast("int").alias("y"))
    x = hash_split(x, "o_orderkey", 0.25, seed=31)
    seg_levels = T.fit_levels(x.where(F.col("split") == "train"), "c_mktsegment")
    nat_levels = T.fit_levels(x.where(F.col("split") == "train"), "nation")
    x = T.one_hot(x, "c_mktsegment", seg_levels, prefix="seg")
    x = T.one_hot(x, "nation", nat_levels, prefix="nat")
    x = T.drop_reference(T.drop_reference(x, "seg", seg_levels[0]), "nat", nat_levels[-1])
    num = ["o_totalprice", "c_acctbal", "month"]
    params = T.fit_minmax(x.where(F.col("split") == "train"), num)
    x = T.apply_minmax(x, params, num)
    feats = [c for c in x.columns if c not in ("o_orderkey", "y", "split")]
    # fits and scores read the joined, encoded rows from the checkpoint
    v = M.vectorize(x.select(*feats, "y", "split").checkpoint(), feats, "y")
    train, test = v.where(F.col("split") == "train"), v.where(F.col("split") == "test")
    from pyspark.ml.functions import vector_to_array

    parts = []
    for name, est in (("forest", M.random_forest(20, "gini", 6, seed=1)), ("bayes", M.gaussian_nb())):
        scored = est.fit(train).transform(test).select(
            F.col("label").cast("int").alias("y"), F.col("prediction").cast("int").alias("pred"),
            vector_to_array("probability")[1].alias("score")).checkpoint()  # four readers
        roc = E.roc_table(scored, "y", "score")
        best = E.best_thresholds(roc).select("best_threshold", "best_sensitivity", "best_specificity")
        # one-row metric frames are stacked as (model, metric, value) rows: no keyless joins
        for frame in (E.accuracy(scored, "y", "pred").select("accuracy"), E.auc(scored, "y", "score"), best):
            parts.append(E.comparison_table({name: frame}))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
