"""

Fit/apply separation: ``fit_*`` returns a small parameter DataFrame (one row,
or one row per level); ``apply_*`` uses it either as a scalar subquery (one
row: a struct of all parameters, computed once) or through a join on the
level (AQE broadcasts the level table when it is small).
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.aggregates import group_quantiles
from quarry.operators.ordering import global_row_number, join_null_safe


def _params(params: DataFrame) -> Column:
    """One-row parameter frame -> a struct scalar subquery (evaluated once)."""
    return params.select(F.struct(*params.columns)).scalar()


# ---- T1 / T2 scaling ------------------------------------------------------------

def fit_minmax(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """T1 fit: min and max of each column (one row)."""
    return df.agg(*[F.min(c).cast("double").alias(f"min_{c}") for c in cols],
                  *[F.max(c).cast("double").alias(f"max_{c}") for c in cols])


def apply_minmax(df: DataFrame, params: DataFrame, cols: Sequence[str], suffix: str = "") -> DataFrame:
    """T1 apply: (x - min) / (max - min); a constant column maps to 0."""
    p = _params(params)
    out = {}
    for c in cols:
        rng = p[f"max_{c}"] - p[f"min_{c}"]
        out[f"{c}{suffix}"] = F.when(rng == 0, F.lit(0.0)).otherwise((F.col(c) - p[f"min_{c}"]) / rng)
    return df.withColumns(out)


def fit_zscore(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """T2 fit: mean and POPULATION standard deviation (as NumPy / scikit-learn)."""
    return df.agg(*[F.avg(c).alias(f"mean_{c}") for c in cols],
                  *[F.stddev_pop(c).alias(f"sd_{c}") for c in cols])


def apply_zscore(df: DataFrame, params: DataFrame, cols: Sequence[str], suffix: str = "") -> DataFrame:
    """T2 apply: (x - mean) / sd; zero variance maps to 0."""
    p = _params(params)
    out = {}
    for c in cols:
        sd = p[f"sd_{c}"]
        out[f"{c}{suffix}"] = F.when(sd == 0, F.lit(0.0)).otherwise((F.col(c) - p[f"mean_{c}"]) / sd)
    return df.withColumns(out)


def scale_rows(df: DataFrame, cols: Sequence[str], suffix: str = "") -> DataFrame:
    """T2 across a row: each value less the row's mean, over its population sd.

    A row of equal values maps to 0; NULL cells stay NULL and don't count.
    """
    cells = F.filter(F.array(*[F.col(c).cast("double") for c in cols]), lambda v: v.isNotNull())
    total = F.aggregate(cells, F.lit(0.0), lambda s, v: s + v)
    out = df.withColumn("__c", cells).withColumn("__m", F.try_divide(total, F.size("__c").cast("double")))
    squares = F.aggregate("__c", F.lit(0.0), lambda s, v: s + (v - F.col("__m")) * (v - F.col("__m")))
    out = out.withColumn("__s", F.sqrt(F.try_divide(squares, F.size("__c").cast("double"))))
    scaled = {f"{c}{suffix}": F.when(F.col("__s") == 0, F.when(F.col(c).isNotNull(), 0.0)).otherwise((F.col(c) - F.col("__m")) / F.col("__s")) for c in cols}
    return out.withColumns(scaled).drop("__c", "__m", "__s")


# ---- T3 - T6 encodings --------------------------------------------------------------

def fit_levels(df: DataFrame, col: str, max_levels: int = 1000) -> list:
    """T3 fit: the sorted level list of a category (it becomes column names).

    The distinct values are aggregated on the executors; only the level list
    itself (bounded by ``max_levels`` -- a schema cannot hold more columns)
    reaches the driver.
    """
    levels = df.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col).limit(max_levels + 1)
    values = [r[0] for r in levels.collect()]
    if len(values) > max_levels:
        raise ValueError(f"{col} has more than {max_levels} levels; use codes (T6) or target encoding (T7)")
    return values


def one_hot(df: DataFrame, col: str, levels: Sequence, prefix: str | None = None,
            drop_first: bool = False, keep_source: bool = False) -> DataFrame:
    """T3 apply: ``prefix_level`` 0/1 columns for a frozen level list."""
    prefix = prefix or col
    use = list(levels)[1:] if drop_first else list(levels)
    cols = {f"{prefix}_{lv}": (F.col(col) == F.lit(lv)).cast("int") for lv in use}
    cols = {k: F.coalesce(v, F.lit(0)) for k, v in cols.items()}
    out = df.withColumns(cols)
    return out if keep_source else out.drop(col)


def drop_reference(df: DataFrame, prefix: str, level: str) -> DataFrame:
    """T4: drop the named reference level's dummy column."""
    return df.drop(f"{prefix}_{level}")


def one_hot_sparse(df: DataFrame, codes: DataFrame, col: str, name: str | None = None, reference: object = None) -> DataFrame:
    """T3 / T4 for any number of levels: a sparse vector column instead of one column per level.

    ``codes`` is the level index of :func:`fit_codes`; it is joined, never
    collected. The vector of a level has a 1 at its code; NULL and unseen levels,
    and the named ``reference`` level (T4), have no entry. The size is the number
    of levels, one aggregate.
    """
    from pyspark.ml.feature import OneHotEncoderModel, OneHotEncoder

    name = name or f"{col}_vec"
    levels = codes.count()
    known = codes.select(F.col(col).alias("__level"), F.col("code").cast("double").alias("__code"))
    out = df.join(known, df[col] == known["__level"], "left").drop("__level")
    dropped = F.col("__code").isNull()
    if reference is not None:
        dropped = dropped | (F.col(col) == F.lit(reference))
    out = out.withColumn("__code", F.when(dropped, F.lit(float(levels))).otherwise(F.col("__code")))
    sizes = df.sparkSession.createDataFrame([(float(levels),)], "__code double")  # the last category is the empty one
    encoder: OneHotEncoderModel = OneHotEncoder(inputCols=["__code"], outputCols=[name], dropLast=True).fit(sizes)
    return encoder.transform(out).drop("__code")


def sparse_entries(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, position, value) of the entries that a sparse vector column stores."""
    v = F.unwrap_udt(F.col(vector))
    cells = F.explode(F.arrays_zip(v["indices"].alias("position"), v["values"].alias("value"))).alias("e")
    return df.select(key, cells).select(key, F.col("e").getField("position").alias("position"), F.col("e").getField("value").alias("value"))


def ordinal(col: Column | str, ordered_levels: Sequence[str]) -> Column:
    """T5: position in an ordered level list (0-based); unknown / NULL -> -1."""
    c = F.col(col) if isinstance(col, str) else col
    pos = F.array_position(F.array(*[F.lit(v) for v in ordered_levels]), c)
    return F.coalesce(pos - 1, F.lit(-1)).cast("int")


def fit_codes(df: DataFrame, col: str) -> DataFrame:
    """T6 fit: alphabetical codes 0..k-1 of the distinct levels (distributed numbering)."""
    levels = df.select(col).where(F.col(col).isNotNull()).distinct()
    return global_row_number(levels, [F.asc(col)], "code").withColumn("code", (F.col("code") - 1).cast("int"))


def apply_codes(df: DataFrame, codes: DataFrame, col: str, name: str | None = None) -> DataFrame:
    """T6 apply: code of the level, -1 when unseen."""
    name = name or f"{col}_code"
    joined = df.join(codes.withColumnRenamed("code", "__code"), col, "left")
    return joined.withColumn(name, F.coalesce(F.col("__code"), F.lit(-1))).drop("__code")


# ---- T7 target encoding --------------------------------------------------------------

def fit_target_encoding(df: DataFrame, col: str, target: str, min_samples_leaf: int = 1,
                        smoothing: float = 1.0, mode: str = "sigmoid") -> DataFrame:
    """T7 fit: per-level encoding shrunk to the prior.

    ``mode='sigmoid'``: weight = 1 / (1 + exp(-(n - min_samples_leaf) / smoothing)),
    levels seen once get the prior; ``mode='additive'``: weight = n / (n + smoothing).
    Result columns: level, n, mean, enc, prior.
    """
    prior = df.agg(F.avg(F.col(target).cast("double"))).scalar()
    stats = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"), F.avg(F.col(target).cast("double")).alias("mean"))
    if mode == "sigmoid":
        w = F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.col("n") - F.lit(min_samples_leaf)) / F.lit(float(smoothing))))
        enc = F.when(F.col("n") == 1, prior).otherwise(prior * (F.lit(1.0) - w) + F.col("mean") * w)
    else:
        w = F.col("n") / (F.col("n") + F.lit(float(smoothing)))
        enc = prior * (F.lit(1.0) - w) + F.col("mean") * w
    return stats.withColumn("enc", enc).withColumn("prior", prior)


def apply_target_encoding(df: DataFrame, enc: DataFrame, col: str, name: str | None = None) -> DataFrame:
    """T7 apply: joined encoding; unseen levels get the prior."""
    name = name or f"{col}_te"
    prior = enc.agg(F.first("prior")).scalar()
    joined = df.join(enc.select(col, F.col("enc").alias("__enc")), col, "left")
    return joined.withColumn(name, F.coalesce(F.col("__enc"), prior)).drop("__enc")


def fit_class_encoding(df: DataFrame, col: str, target: str, classes: Sequence, min_samples_leaf: int = 1,
                       smoothing: float = 1.0) -> DataFrame:
    """T7 per class: for every level the share of each class, shrunk to the class's prior.

    One aggregate over the levels gives all classes; a level seen once, and a
    NULL level, has its own row. Result columns: level, n, ``enc_{class}`` and
    ``prior_{class}``. Rows without a label don't count.
    """
    rows = df.where(F.col(target).isNotNull())
    shares = {c: F.avg((F.col(target) == F.lit(c)).cast("double")) for c in classes}
    prior = rows.agg(F.struct(*[e.alias(f"p{i}") for i, e in enumerate(shares.values())])).scalar()
    stats = rows.groupBy(col).agg(F.count(F.lit(1)).alias("n"), *[e.alias(f"__m{i}") for i, e in enumerate(shares.values())])
    w = F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.col("n") - F.lit(min_samples_leaf)) / F.lit(float(smoothing))))
    w = F.when(F.col("n") == 1, F.lit(0.0)).otherwise(w)
    return stats.select(
        col, "n", *[(prior[f"p{i}"] * (F.lit(1.0) - w) + F.col(f"__m{i}") * w).alias(f"enc_{c}") for i, c in enumerate(classes)],
        *[prior[f"p{i}"].alias(f"prior_{c}") for i, c in enumerate(classes)])


def apply_class_encoding(df: DataFrame, enc: DataFrame, col: str, classes: Sequence) -> DataFrame:
    """T7 per class, apply: ``{col}_{class}`` columns; an unseen level gets the priors."""
    prior = enc.agg(F.struct(*[F.first(f"prior_{c}").alias(f"p{i}") for i, c in enumerate(classes)])).scalar()
    known = enc.select(col, F.lit(True).alias("__known"), *[F.col(f"enc_{c}").alias(f"__e{i}") for i, c in enumerate(classes)])
    joined = join_null_safe(df, known, [col], "left")
    return joined.withColumns({f"{col}_{c}": F.when(F.col("__known"), F.col(f"__e{i}")).otherwise(prior[f"p{i}"])
                               for i, c in enumerate(classes)}).drop("__known", *[f"__e{i}" for i in range(len(classes))])


# ---- T8 - T10 binning --------------------------------------------------------------------

def fit_quantile_edges(df: DataFrame, col: str, n_bins: int, exact: bool = True) -> DataFrame:
    """T8 fit: n+1 quantile edges (one row, array column ``edges``)."""
    probs = [i / n_bins for i in range(n_bins + 1)]
    return group_quantiles(df, [], [col], probs, exact).select(F.col("q").alias("edges"))


def apply_quantile_bins(df: DataFrame, edges: DataFrame, col: str, n_bins: int, name: str = "bin") -> DataFrame:
    """T8 apply: right-closed bins, lowest edge included (like ``pd.qcut``).

    Adds ``name`` (0-based bin), ``{name}_lo`` and ``{name}_hi``.
    """
    e = edges.select("edges").scalar()
    idx = F.lit(0)
    for i in range(1, n_bins):
        idx = idx + (F.col(col) > e[i]).cast("int")
    idx = F.when(F.col(col).isNull(), F.lit(None)).otherwise(idx)
    return df.withColumn(name, idx).withColumn(f"{name}_lo", F.element_at(e, idx + 1)).withColumn(
        f"{name}_hi", F.element_at(e, idx + 2))


def equal_depth_bins(df: DataFrame, order: Sequence[Column | str], depth: int, name: str = "bin") -> DataFrame:
    """Consecutive runs of ``depth`` rows in a global order (distributed numbering)."""
    numbered = global_row_number(df, order, "__rn")
    return numbered.withColumn(name, F.floor((F.col("__rn") - 1) / depth).cast("long")).drop("__rn")


def threshold_bins(col: Column | str, thresholds: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the interval [t_i, t_{i+1}); ``labels`` has len(thresholds)+1 entries."""
    c = F.col(col) if isinstance(col, str) else col
    expr = F.lit(labels[-1])
    for t, lab in reversed(list(zip(thresholds, labels[:-1]))):
        expr = F.when(c < F.lit(t), F.lit(lab)).otherwise(expr)
    return F.when(c.isNull(), F.lit(None)).otherwise(expr)


# ---- T11 - T15 category rules ---------------------------------------------------------------

def consolidate(col: Column | str, groups: Mapping[str, Sequence[str]]) -> Column:
    """Value -> group by a rule table (literal map); values not listed are kept."""
    c = F.col(col) if isinstance(col, str) else col
    pairs = []
    for group, members in groups.items():
        for m in members:
            pairs += [F.lit(m), F.lit(group)]
    return F.coalesce(F.element_at(F.create_map(*pairs), c), c)


def consolidate_by_table(df: DataFrame, col: str, rules: DataFrame) -> DataFrame:
    """T11 / T13 for long rule tables: ``rules(from_value, to_value)`` joined on the value."""
    joined = df.join(rules, df[col] == rules["from_value"], "left")
    return joined.withColumn(col, F.coalesce(F.col("to_value"), F.col(col))).drop("from_value", "to_value")


def lump_except(col: Column | str, keep: Sequence[str], other: str = "Other") -> Column:
    """Everything outside a keep-list becomes ``other``."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c.isin(list(keep)), c).otherwise(F.lit(other))


def spelling_candidates(df: DataFrame, col: str, canonical: str, pattern: str, max_distance: int) -> DataFrame:
    """Distinct values that look like ``canonical`` (regex prefilter, then edit distance)."""
    vals = df.select(col).where(F.col(col).rlike(pattern)).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    d = F.levenshtein(F.upper(F.col(col)), F.lit(canonical.upper()))
    return vals.withColumn("distance", d).where(F.col("distance") <= max_distance).withColumn(
        "canonical", F.lit(canonical))


def hierarchical_label(title: Column | str, subtitle: Column | str, split_title: str, split_pattern: str,
                       keep: Sequence[str], other: str = "Other") -> Column:
    """``title_subtitle`` labels; one title is split in two by a regex on the
    subtitle; labels outside ``keep`` become ``other``."""
    t = F.col(title) if isinstance(title, str) else title
    s = F.col(subtitle) if isinstance(subtitle, str) else subtitle
    label = F.when(t == F.lit(split_title),
                   F.concat(t, F.lit("_"), F.when(s.rlike(split_pattern), F.lit("A")).otherwise(F.lit("B")))
                   ).otherwise(F.concat(t, F.lit("_"), s))
    return F.when(label.isin(list(keep)), label).otherwise(F.lit(other))


def regional_group(code: Column | str, region: Column | str, home, neighbours: Sequence, home_region) -> Column:
    """Home / neighbour / same region / foreign / unknown, in that priority."""
    c = F.col(code) if isinstance(code, str) else code
    r = F.col(region) if isinstance(region, str) else region
    return (F.when(c.isNull(), F.lit("unknown"))
            .when(c == F.lit(home), F.lit("home"))
            .when(c.isin(list(neighbours)), F.lit("neighbour"))
            .when(r == F.lit(home_region), F.lit("region"))
            .otherwise(F.lit("foreign")))


# ---- T17 - T19, T21 - T23 -----------------------------------------------------------------------

def reduce_skew(df: DataFrame, sqrt_cols: Sequence[str] = (), log_cols: Sequence[str] = ()) -> DataFrame:
    """Sqrt for zero-inflated columns, natural log for strictly positive ones."""
    out = {f"sqrt_{c}": F.sqrt(c) for c in sqrt_cols}
    out.update({f"log_{c}": F.when(F.col(c) > 0, F.ln(c)) for c in log_cols})
    return df.withColumns(out)


def repair_coordinates(df: DataFrame, lat: str, lon: str, lat_box: tuple[float, float],
                       lon_box: tuple[float, float]) -> DataFrame:
    """Drop NULL coordinates; swap lat/lon when the swapped pair falls in the box;
    flip the sign of a longitude whose negation falls in the box; keep rows in the box."""
    x = df.na.drop(subset=[lat, lon])
    swapped = F.col(lon).between(*lat_box) & F.col(lat).between(*lon_box)
    cols = [c for c in x.columns if c not in (lat, lon)]
    x = x.select(*cols, F.when(swapped, F.col(lon)).otherwise(F.col(lat)).alias(lat),
                 F.when(swapped, F.col(lat)).otherwise(F.col(lon)).alias(lon))
    flip = ~F.col(lon).between(*lon_box) & (-F.col(lon)).between(*lon_box)
    x = x.withColumn(lon, F.when(flip, -F.col(lon)).otherwise(F.col(lon)))
    return x.where(F.col(lat).between(*lat_box) & F.col(lon).between(*lon_box))


def daily_rollup(df: DataFrame, date_col: Column, measures: Sequence[str], flags: Sequence[Column],
                 flag_names: Sequence[str], digits: int = 2) -> DataFrame:
    """Flags NULL -> 0, mean of each measure over all stations of a day,
    any-flag per day, days with a NULL mean dropped, rounded."""
    x = df.select(date_col.alias("day"), *measures,
                  *[F.coalesce(f.cast("int"), F.lit(0)).alias(n) for f, n in zip(flags, flag_names)])
    agg = x.groupBy("day").agg(*[F.avg(m).alias(m) for m in measures], *[F.max(n).alias(n) for n in flag_names])
    agg = agg.na.drop(subset=list(measures))
    return agg.select("day", *[F.round(F.col(m) * 10**digits) / 10**digits for m in measures], *flag_names).toDF(
        "day", *measures, *flag_names)


def assemble(df: DataFrame, inputs: Sequence[str], label: str, out: str = "features") -> DataFrame:
    """Feature vector + label (``VectorAssembler``)."""
    from pyspark.ml.feature import VectorAssembler

    return VectorAssembler(inputCols=list(inputs), outputCol=out, handleInvalid="keep").transform(df).select(
        out, F.col(label).alias("label"))


def strip_trailing(col: Column | str, chars: str = ".") -> Column:
    """Labels of the test file end in '.'; strip before encoding."""
    c = F.col(col) if isinstance(col, str) else col
    return F.rtrim(c, F.lit(chars)) if hasattr(F, "rtrim") else F.regexp_replace(c, f"[{chars}]+$", "")


def logit_weight(n: float, min_samples_leaf: int = 1, smoothing: float = 1.0) -> float:
    """Scalar form of the T7 sigmoid weight (used by tests)."""
    return 1.0 / (1.0 + math.exp(-(n - min_samples_leaf) / smoothing))
