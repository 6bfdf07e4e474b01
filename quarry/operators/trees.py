"""Classification trees grown from histograms.

All trees of a search grow together, level by level. Features are binned once;
the table is counted by (bins, label, fold), so raw rows are read a single time
and equal rows weigh as one. One aggregate per level then counts (tree, node,
feature, bin, class) for every configuration and every fold that is left out,
and the best splits come from running sums over the bins. What reaches the
driver is the model: one row per node, bounded by trees x 2^depth.

A node splits while it is above ``max_depth``, holds ``min_split`` rows or more
and has a split with ``min_leaf`` rows or more on both sides that lowers the
impurity (``gini`` or ``entropy``). Among equal gains the first feature, then the
smallest threshold, is taken. Values up to the threshold go left; NULL goes
right. Rows without a label are left out of the fit.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.rounding import rnd
from quarry.operators.aggregates import group_quantiles

DEFAULTS = {"impurity": "gini", "max_depth": 5, "min_leaf": 1, "min_split": 2}
GAIN_DIGITS = 10


def fit_edges(df: DataFrame, features: Sequence[str], bins: int = 16) -> dict[str, list[float]]:
    """Candidate thresholds per feature: its distinct inner quantiles (at most bins - 1 numbers each)."""
    probs = [i / bins for i in range(1, bins)]
    quantiles = group_quantiles(df.select(*[F.col(f).cast("double").alias(f) for f in features]), [], list(features), probs)
    edges = {r["column"]: sorted({v for v in r["q"] if v is not None}) for r in quantiles.withColumn(
        "q", F.transform("q", lambda v: rnd(v))).collect() if r["q"] is not None}
    return {f: edges.get(f, []) for f in features}


def bin_of(column: str, edges: Sequence[float]) -> Column:
    """How many thresholds a value exceeds; NULL exceeds all."""
    above = [F.when(F.col(column) <= F.lit(e), 0).otherwise(1) for e in edges]
    return sum(above, F.lit(0))


def binned_counts(df: DataFrame, features: Sequence[str], label: str, edges: Mapping[str, Sequence[float]],
                  fold_col: str | None = None) -> DataFrame:
    """(bins, y, fold, w): how many rows share all bins, the label and the fold."""
    fold = F.col(fold_col).cast("int") if fold_col else F.lit(None).cast("int")
    rows = df.where(F.col(label).isNotNull()).select(
        F.array(*[bin_of(f, edges[f]) for f in features]).alias("bins"), F.col(label).alias("y"), fold.alias("fold"))
    return rows.groupBy("bins", "y", "fold").agg(F.count(F.lit(1)).alias("w"))


def _score(counts: Sequence[Column], n: Column, impurity: Column) -> Column:
    """Gini: sum of squares / n; entropy: sum of c ln c - n ln n (larger is purer)."""
    squares = sum((c * c for c in counts), F.lit(0)).cast("double")
    logs = [F.when(c > 0, c * F.ln(c.cast("double"))).otherwise(0.0) for c in (*counts, n)]
    return F.when(impurity == "gini", F.try_divide(squares, n.cast("double"))).otherwise(sum(logs[:-1], F.lit(0.0)) - logs[-1])


def _best_splits(histogram: DataFrame, settings: DataFrame, classes: int) -> DataFrame:
    """Every node's counts with its best allowed split (NULL feature: none)."""
    cs = [f"c{i}" for i in range(classes)]
    run = Window.partitionBy("tree", "node", "feature").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("tree", "node", "feature")
    h = histogram.select("tree", "node", "feature", "bin", *cs, *[F.sum(c).over(run).alias(f"l_{c}") for c in cs],
                         *[F.sum(c).over(whole).alias(f"t_{c}") for c in cs])
    left, total = [F.col(f"l_{c}") for c in cs], [F.col(f"t_{c}") for c in cs]
    right = [t - x for t, x in zip(total, left)]
    # the settings have one row per tree: a parameter, not data
    h = h.join(F.broadcast(settings), "tree").select(
        "*", sum(left, F.lit(0)).alias("n_l"), sum(right, F.lit(0)).alias("n_r"), sum(total, F.lit(0)).alias("n"))
    gain = (_score(left, F.col("n_l"), F.col("impurity")) + _score(right, F.col("n_r"), F.col("impurity"))
            - _score(total, F.col("n"), F.col("impurity"))) / F.col("n")
    allowed = ((F.col("n") >= F.col("min_split")) & (F.col("n_l") >= F.greatest(F.col("min_leaf"), F.lit(1)))
               & (F.col("n_r") >= F.greatest(F.col("min_leaf"), F.lit(1))))
    h = h.withColumn("gain", F.when(allowed, rnd(gain, GAIN_DIGITS)))
    h = h.withColumn("gain", F.when(F.col("gain") > 0, F.col("gain")))
    split = F.struct("feature", "bin", "gain", F.array(*left).alias("left"), F.array(*right).alias("right"))
    place = F.when(F.col("gain").isNotNull(), F.struct(-F.col("gain"), "feature", "bin"))
    return h.groupBy("tree", "node").agg(
        *[F.first(f"t_{c}").alias(c) for c in cs],
        F.when(F.max("gain").isNotNull(), F.min_by(split, place)).alias("best"))


def _moved(rows: DataFrame, splits: DataFrame | None, how: str) -> DataFrame:
    """Rows one level down; ``inner`` keeps the rows of split nodes, ``left`` all."""
    step = F.col("node") * 2 + (F.element_at("bins", F.col("feature") + 1) > F.col("bin")).cast("int")
    moved = rows.join(F.broadcast(splits), ["tree", "node"], how)  # one row per node of the model
    return moved.withColumn("node", F.when(F.col("feature").isNotNull(), step).otherwise(F.col("node"))).drop("feature", "bin")


def _with_trees(counts: DataFrame, held_out: Sequence[int | None], train: bool) -> DataFrame:
    """Every row once per tree that learns from it (or that it tests)."""
    out = F.array(*[F.lit(-1 if f is None else f) for f in held_out])
    rows = counts.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(len(held_out) - 1))))
    mine = F.coalesce(F.col("fold"), F.lit(-2)) == F.element_at(out, F.col("tree") + 1)
    return rows.where(~mine if train else mine).withColumn("node", F.lit(1).cast("long"))


def grow(counts: DataFrame, settings: Sequence[Mapping], held_out: Sequence[int | None], classes: Sequence,
         ) -> tuple[list[dict], list[DataFrame]]:
    """Grow one tree per setting, tree i without the rows of fold ``held_out[i]``.

    Returns the node rows (tree, node, depth, counts, n, prediction, feature,
    bin, gain; nodes numbered as in a heap, root 1) and the splits per level.
    """
    if not classes:
        return [], []  # nothing is labelled
    spark = counts.sparkSession
    given = [{**DEFAULTS, **s} for s in settings]
    table = spark.createDataFrame(
        [(i, s["impurity"], int(s["max_depth"]), int(s["min_leaf"]), int(s["min_split"])) for i, s in enumerate(given)],
        "tree int, impurity string, max_depth int, min_leaf int, min_split int")
    rows, nodes, levels = _with_trees(counts, held_out, True), [], []
    cs = [F.sum(F.when(F.col("y") == F.lit(c), F.col("w")).otherwise(0)).alias(f"c{i}") for i, c in enumerate(classes)]
    last: dict[tuple[int, int], list[int]] = {}
    for depth in range(max(s["max_depth"] for s in given) + 1):
        open_trees = [i for i, s in enumerate(given) if s["max_depth"] > depth]
        found = []
        if open_trees and (depth == 0 or last):
            histogram = (
                rows.where(F.col("tree").isin(open_trees))
                .select("tree", "node", "y", "w", F.posexplode("bins").alias("feature", "bin"))
                .groupBy("tree", "node", "feature", "bin").agg(*cs)
            )
            found = _best_splits(histogram, table, len(classes)).collect()
        seen = {(r["tree"], r["node"]): r for r in found}
        if depth == 0:
            for r in rows.where(~F.col("tree").isin(open_trees)).groupBy("tree").agg(*cs).collect() if len(open_trees) < len(given) else ():
                last[r["tree"], 1] = [r[f"c{i}"] for i in range(len(classes))]
            last.update({k: [r[f"c{i}"] for i in range(len(classes))] for k, r in seen.items()})
        following: dict[tuple[int, int], list[int]] = {}
        splits = []
        for (tree, node), total in sorted(last.items()):
            best = seen[tree, node]["best"] if (tree, node) in seen else None
            nodes.append({
                "tree": tree, "node": node, "depth": depth, "counts": total, "n": sum(total),
                "prediction": classes[max(range(len(total)), key=lambda i: (total[i], -i))],
                "feature": best["feature"] if best else None, "bin": best["bin"] if best else None,
                "gain": best["gain"] if best else None})
            if best:
                splits.append((tree, node, best["feature"], best["bin"]))
                following[tree, 2 * node], following[tree, 2 * node + 1] = best["left"], best["right"]
        if not splits:
            break
        levels.append(spark.createDataFrame(splits, "tree int, node long, feature int, bin int"))
        rows, last = _moved(rows, levels[-1], "inner"), following
    return nodes, levels


class Tree:
    """A fitted tree: its node rows, thresholds and class list (model-sized)."""

    def __init__(self, nodes: Sequence[Mapping], features: Sequence[str], edges: Mapping[str, Sequence[float]], impurity: str):
        self.nodes, self.features, self.edges, self.impurity = {n["node"]: n for n in nodes}, list(features), edges, impurity

    def threshold(self, node: Mapping) -> float | None:
        return None if node["feature"] is None else self.edges[self.features[node["feature"]]][node["bin"]]

    def predict(self) -> Column:
        """Nested native conditions from the node table."""
        def branch(number: int) -> Column:
            node = self.nodes[number]
            if node["feature"] is None:
                return F.lit(node["prediction"])
            goes_left = F.col(self.features[node["feature"]]) <= F.lit(self.threshold(node))
            return F.when(goes_left, branch(2 * number)).otherwise(branch(2 * number + 1))

        return branch(1) if self.nodes else F.lit(None)

    def node_table(self, spark) -> DataFrame:
        """K3: (node, depth, feature, threshold, n, counts, impurity, gain, prediction) as a table."""
        from math import log

        def impurity(counts: Sequence[int]) -> float:
            n = sum(counts)
            if self.impurity == "gini":
                return 1.0 - sum(c * c for c in counts) / (n * n)
            return -sum(c / n * log(c / n) for c in counts if c)

        rows = [(n["node"], n["depth"], None if n["feature"] is None else self.features[n["feature"]], self.threshold(n),
                 n["n"], [int(c) for c in n["counts"]], impurity(n["counts"]) if n["n"] else None, n["gain"], str(n["prediction"]))
                for n in self.nodes.values()]
        return spark.createDataFrame(rows, "node long, depth int, feature string, threshold double, n long, "
                                           "counts array<bigint>, impurity double, gain double, prediction string")


def class_list(df: DataFrame, label: str) -> list:
    """The labels, in order (model-sized, as in any fitted classifier)."""
    return [r[0] for r in df.select(label).where(F.col(label).isNotNull()).distinct().orderBy(label).collect()]


def fit_tree(df: DataFrame, features: Sequence[str], label: str, bins: int = 16, **settings) -> Tree:
    """L1: one tree with depth, leaf AND split limits."""
    edges = fit_edges(df.where(F.col(label).isNotNull()), features, bins)
    counts = binned_counts(df, features, label, edges).checkpoint()
    nodes, _ = grow(counts, [settings], [None], class_list(df, label))
    return Tree(nodes, features, edges, {**DEFAULTS, **settings}["impurity"])


def combinations(grids: Sequence[Mapping[str, Sequence]]) -> list[dict]:
    """All parameter combinations of several grids, each once, in order."""
    out = []
    for grid in grids:
        for values in product(*grid.values()):
            point = {**DEFAULTS, **dict(zip(grid, values))}
            if point not in out:
                out.append(point)
    return out


METRICS = ("accuracy", "precision", "recall", "f1", "specificity")


def _metrics(confusion: DataFrame, positive: object) -> DataFrame:
    """The metrics of (tree, y, predicted, w); NULL where a rate has no rows."""
    def count(c: Column) -> Column:
        return F.sum(F.when(c, F.col("w")).otherwise(0)).cast("double")

    y, p = F.col("y") == F.lit(positive), F.col("predicted") == F.lit(positive)
    sums = confusion.groupBy("tree").agg(
        count(F.col("y") == F.col("predicted")).alias("right"), F.sum("w").cast("double").alias("n"),
        count(y & p).alias("tp"), count(~y & p).alias("fp"), count(y & ~p).alias("fn"), count(~y & ~p).alias("tn"))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return sums.select("tree", F.try_divide(F.col("right"), F.col("n")).alias("accuracy"), F.try_divide(tp, tp + fp).alias("precision"),
                       F.try_divide(tp, tp + fn).alias("recall"), F.try_divide(2 * tp, 2 * tp + fp + fn).alias("f1"),
                       F.try_divide(tn, tn + fp).alias("specificity"))


def grid_search(df: DataFrame, features: Sequence[str], label: str, fold_col: str, folds: int,
                grids: Sequence[Mapping[str, Sequence]], positive: object = 1, refit: str = "f1", bins: int = 16,
                ) -> tuple[DataFrame, dict, Tree]:
    """Every combination of the grids, cross-validated, in one growth of all trees.

    Returns the table of all combinations (parameters; mean and sd of every
    metric over the folds; rank by the ``refit`` metric, ties by order), the best
    combination, and the tree refitted with it on all rows. Thresholds are
    fitted once, on all rows; they use no labels.
    """
    spark, points = df.sparkSession, combinations(grids)
    edges = fit_edges(df.where(F.col(label).isNotNull()), features, bins)
    counts = binned_counts(df, features, label, edges, fold_col).checkpoint()
    classes = class_list(df, label)
    settings = [p for p in points for _ in range(folds)] + points  # the last ones see all rows
    held_out = list(range(folds)) * len(points) + [None] * len(points)
    nodes, levels = grow(counts, settings, held_out, classes)
    tested = _with_trees(counts, held_out, False)
    for splits in levels:
        tested = _moved(tested, splits, "left")
    label_type = df.schema[label].dataType.simpleString()
    leaves = spark.createDataFrame([(n["tree"], n["node"], n["prediction"]) for n in nodes], f"tree int, node long, predicted {label_type}")
    confusion = tested.join(F.broadcast(leaves), ["tree", "node"]).groupBy("tree", "y", "predicted").agg(F.sum("w").alias("w"))
    names = spark.createDataFrame(
        [(i, p["impurity"], int(p["max_depth"]), int(p["min_leaf"]), int(p["min_split"])) for i, p in enumerate(points)],
        "combo int, impurity string, max_depth int, min_leaf int, min_split int")
    per_combo = _metrics(confusion, positive).withColumn("combo", F.floor(F.col("tree") / folds).cast("int")).groupBy("combo").agg(
        *[f(F.col(m)).alias(f"{p}_{m}") for m in METRICS for p, f in (("mean", F.avg), ("sd", F.stddev_samp))])
    # as many rows as combinations: a parameter
    order = Window.orderBy(F.desc_nulls_last(rnd(F.col(f"mean_{refit}"), GAIN_DIGITS)), "combo")
    results = names.join(per_combo, "combo", "left").withColumn("rank", F.row_number().over(order))
    best = results.where("rank = 1").first()["combo"]
    refitted = [n for n in nodes if n["tree"] == len(points) * folds + best]
    return results, points[best], Tree(refitted, features, edges, points[best]["impurity"])


# ---- the same in SQL, for the twins ---------------------------------------------------------


def tree_ctes(source: str, features: Sequence[str], settings: Sequence[Mapping], held_out: Sequence[int | None],
              classes: Sequence[int], bins: int = 16) -> str:
    """CTEs that grow the trees in DuckDB from ``source`` (rid, y, fold, features; y NULL: not learned from).

    ``sp`` holds every split (tree, depth, node, f, b, gain, counts) and ``w`` the final node of every (tree, rid)."""
    given = [{**DEFAULTS, **s} for s in settings]
    probs = ", ".join(str(i / bins) for i in range(1, bins))
    edges = " UNION ALL ".join(
        f"SELECT {i} AS f, list_sort(list_distinct(list_transform(quantile_cont(CAST({f} AS DOUBLE), [{probs}]), lambda v: round(v * 1e6) / 1e6))) AS e "
        f"FROM src WHERE y IS NOT NULL" for i, f in enumerate(features))
    long = " UNION ALL ".join(
        f"SELECT rid, {i} AS f, CASE WHEN {f} IS NULL THEN len(e) ELSE len(list_filter(e, lambda v: v < {f})) END AS b "
        f"FROM src, ed WHERE ed.f = {i}" for i, f in enumerate(features))
    trees = ", ".join(f"({i}, '{s['impurity']}', {s['max_depth']}, {s['min_leaf']}, {s['min_split']}, {'NULL' if o is None else o})"
                      for i, (s, o) in enumerate(zip(given, held_out)))
    count = ", ".join(f"count(*) FILTER (WHERE y = {c}) AS c{i}" for i, c in enumerate(classes))
    ids = range(len(classes))

    def score(kind: str, cs: Sequence[str], n: str) -> str:
        if kind == "gini":
            return f"(({' + '.join(f'{c} * {c}' for c in cs)})::DOUBLE / {n})"
        logs = [f"(CASE WHEN {c} > 0 THEN {c} * ln({c}) ELSE 0 END)" for c in cs]
        return f"({' + '.join(logs)} - {n} * ln({n}))"

    def gain(kind: str) -> str:
        parts = [score(kind, [f"{p}{i}" for i in ids], n) for p, n in (("l", "nl"), ("r", "nr"), ("t", "n"))]
        return f"({parts[0]} + {parts[1]} - {parts[2]}) / n"

    out = [f"src AS ({source})", f"ed AS ({edges})", f"lg AS ({long})",
           f"tr(tree, impurity, max_depth, min_leaf, min_split, held) AS (VALUES {trees})",
           "a0 AS (SELECT tree, rid, y, 1::BIGINT AS node FROM src, tr WHERE y IS NOT NULL AND fold IS DISTINCT FROM COALESCE(held, -1))",
           "w0 AS (SELECT tree, rid, 1::BIGINT AS node FROM src, tr)"]
    depth = max(s["max_depth"] for s in given)
    for d in range(depth):
        out.append(f"h{d} AS (SELECT tree, node, f, b, {count} FROM a{d} JOIN lg USING (rid) JOIN tr USING (tree) WHERE max_depth > {d} GROUP BY ALL)")
        run = "PARTITION BY tree, node, f"
        out.append(f"k{d} AS (SELECT tree, node, f, b, " + ", ".join(
            f"SUM(c{i}) OVER ({run} ORDER BY b)::BIGINT AS l{i}, SUM(c{i}) OVER ({run})::BIGINT AS t{i}" for i in ids) + f" FROM h{d})")
        out.append(f"m{d} AS (SELECT *, " + ", ".join(f"t{i} - l{i} AS r{i}" for i in ids) + ", " + ", ".join(
            f"{' + '.join(f'{p}{i}' for i in ids)} AS {n}" for p, n in (("l", "nl"), ("t", "n"))) + f", n - nl AS nr FROM k{d} JOIN tr USING (tree))")
        out.append(f"""g{d} AS (SELECT *, round(CASE WHEN impurity = 'gini' THEN {gain('gini')} ELSE {gain('entropy')} END * 1e{GAIN_DIGITS}) / 1e{GAIN_DIGITS} AS gain
          FROM m{d} WHERE n >= min_split AND nl >= greatest(min_leaf, 1) AND nr >= greatest(min_leaf, 1))""")
        out.append(f"s{d} AS (SELECT * FROM g{d} WHERE gain > 0 QUALIFY row_number() OVER (PARTITION BY tree, node ORDER BY gain DESC, f, b) = 1)")
        for x, join in (("a", "JOIN"), ("w", "LEFT JOIN")):
            y = ", t.y" if x == "a" else ""
            out.append(f"{x}{d + 1} AS (SELECT t.tree, t.rid{y}, CASE WHEN s.f IS NULL THEN t.node ELSE t.node * 2 + CAST(lg.b > s.b AS INTEGER) END AS node "
                       f"FROM {x}{d} t {join} s{d} s ON t.tree = s.tree AND t.node = s.node {join} lg ON lg.rid = t.rid AND lg.f = s.f)")
    columns = "tree, node, f, b, gain, n, " + ", ".join(f"l{i}, r{i}, t{i}" for i in ids)
    out.append("sp AS (" + " UNION ALL ".join(f"SELECT {d} AS depth, {columns} FROM s{d}" for d in range(depth)) + ")")
    out.append(f"w AS (SELECT * FROM w{depth})")
    # counts of every node: the root's, and both children of every split
    counts = " UNION ALL ".join(
        [f"SELECT tree, 1::BIGINT AS node, 0 AS depth, {count} FROM a0 GROUP BY tree",
         "SELECT tree, node * 2, depth + 1, " + ", ".join(f"l{i}" for i in ids) + " FROM sp",
         "SELECT tree, node * 2 + 1, depth + 1, " + ", ".join(f"r{i}" for i in ids) + " FROM sp"])
    out.append(f"nd AS ({counts})")
    wins = " ".join(f"WHEN c{i} = greatest({', '.join(f'c{j}' for j in ids)}) THEN {c}" for i, c in enumerate(classes))
    out.append(f"pr AS (SELECT *, CASE {wins} END AS prediction FROM nd)")
    return ", ".join(out)
