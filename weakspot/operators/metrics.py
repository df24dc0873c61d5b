"""Classification metrics as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from weakspot.functions import numeric as N
from weakspot.session import written_once

WEIGHTS = (1, 2, 3, 4)  # fixed values: ensemble weight grid
MOST_EDGES = 256  # cuts of one bucket at once


def f1_of(precision, recall):
    return N.ratio_or_zero(2 * F.col(precision) * F.col(recall), F.col(precision) + F.col(recall))


def outcome_counts(label: str = "label", prediction: str = "prediction") -> list:
    y, p = F.col(label) == 1, F.col(prediction) == 1
    return [F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
            F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn")]


def scores_of_counts(counts: DataFrame) -> DataFrame:
    """Accuracy, precision, recall, F1 from tp, fp, fn, tn; 0 for 0/0."""
    return (counts
            .withColumn("accuracy", N.ratio_or_zero(F.col("tp") + F.col("tn"),
                                                    F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")))
            .withColumn("precision", N.ratio_or_zero("tp", F.col("tp") + F.col("fp")))
            .withColumn("recall", N.ratio_or_zero("tp", F.col("tp") + F.col("fn")))
            .withColumn("f1", f1_of("precision", "recall")))


def binary_metrics(scored: DataFrame, by: list[str] = [], label: str = "label", prediction: str = "prediction"):
    """Metrics of class 1, one row for each value of ``by``, one pass."""
    return scores_of_counts(scored.groupBy(*by).agg(*outcome_counts(label, prediction)))


def confusion(scored: DataFrame, classes: list[int] = [0, 1], label: str = "label", prediction: str = "prediction"):
    """Rows are labels, columns ``pred_<class>``."""
    p = F.col(prediction).cast("int")
    return scored.groupBy(F.col(label).cast("int").alias("label")).agg(
        *[F.count_if(p == c).alias(f"pred_{c}") for c in classes])


def class_report(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1, support by class, accuracy, and their plain
    and support-weighted means, all from one confusion count."""
    cells = scored.groupBy(F.col(label).cast("int").alias("y"), F.col(prediction).cast("int").alias("p")).agg(
        F.count(F.lit(1)).alias("n"))
    right = F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0)
    # each cell counts once for its label and once for its prediction
    sides = F.array(F.struct(F.col("y").alias("class"), F.col("n").alias("support"),
                             right.alias("hit"), F.lit(0).cast("bigint").alias("predicted")),
                    F.struct(F.col("p").alias("class"), F.lit(0).cast("bigint").alias("support"),
                             F.lit(0).cast("bigint").alias("hit"), F.col("n").alias("predicted")))
    per_class = (cells.select(F.inline(sides)).groupBy("class")
                 .agg(F.sum("support").alias("support"), F.sum("hit").alias("hit"), F.sum("predicted").alias("predicted"))
                 .withColumn("precision", N.ratio_or_zero("hit", "predicted"))
                 .withColumn("recall", N.ratio_or_zero("hit", "support"))
                 .withColumn("f1", f1_of("precision", "recall")))
    total = F.sum("support")

    def weighted(c: str):
        return N.ratio_or_zero(F.sum(F.col(c) * F.col("support")), total)

    accuracy = N.ratio_or_zero(F.sum("hit"), total)
    names = ("precision", "recall", "f1")
    summary = per_class.agg(F.array(
        F.struct(F.lit("accuracy").alias("class"), *[accuracy.alias(c) for c in names], total.alias("support")),
        F.struct(F.lit("macro avg").alias("class"), *[F.avg(c).alias(c) for c in names], total.alias("support")),
        F.struct(F.lit("weighted avg").alias("class"), *[weighted(c).alias(c) for c in names], total.alias("support")),
    ).alias("rows")).select(F.inline("rows"))
    return per_class.select(F.col("class").cast("string").alias("class"), *names, "support").unionByName(summary)


def running_counts(df: DataFrame, order: str, values: list[str], bucket_rows: int = 1_000_000) -> DataFrame:
    """Running sums of ``values`` by descending ``order``, no one-task sort.

    ``order`` must be distinct. Quantiles cut it into buckets of about
    ``bucket_rows`` rows, at most ``MOST_EDGES`` at once; a bucket that holds
    more is cut again by its own quantiles, level by level, so no window grows
    with the table. Totals of the buckets of a level, summed along its parents,
    give each bucket's start, and windows add up inside the buckets.
    """
    kept = [F.col(f"`{c}`") for c in df.columns]
    held = df.withColumn("__p", F.array(F.lit(0)))
    level = 0
    while True:
        sizes = held.groupBy("__p").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > bucket_rows)
        crowded = sizes.select("__p", F.least(F.ceil(F.col("n") / bucket_rows), F.lit(MOST_EDGES)).cast("int").alias("__k"))
        if crowded.isEmpty():
            break
        # a sketch for each crowded bucket; its quantiles are the next cuts
        marked = attach_small(held, crowded, ["__p"], ["__k"])
        shares = F.array(*[F.lit(i / MOST_EDGES) for i in range(1, MOST_EDGES)])
        cuts = marked.filter("__k IS NOT NULL").groupBy("__p").agg(
            F.percentile_approx(order, shares, 10 * MOST_EDGES).alias("__q"), F.first("__k").alias("__k"))
        cuts = cuts.select("__p", F.array_distinct(F.filter("__q", lambda q, i: ((i + 1) * F.col("__k")) % MOST_EDGES < F.col("__k"))).alias("__q"))
        cut = attach_small(held, written_once(cuts, "cuts"), ["__p"], ["__q"])
        part = F.when(F.col("__q").isNull(), F.lit(0)).otherwise(F.size(F.filter("__q", lambda q: q < F.col(order))))
        held = written_once(cut.withColumn("__p", F.concat("__p", F.array(part))).drop("__q"), "buckets")
        level += 1
    totals = written_once(held.groupBy("__p").agg(*[F.sum(v).alias(f"__t_{v}") for v in values]), "totals")
    starts = totals.select("__p", *[F.lit(0).alias(f"__s_{v}") for v in values])
    for depth in range(level, 0, -1):
        # what lies above a bucket among its siblings, added for every level of its path
        parent, own = F.slice("__p", 1, depth), F.get("__p", F.lit(depth))
        sums = totals.groupBy(parent.alias("__parent"), own.alias("__own")).agg(*[F.sum(f"__t_{v}").alias(v) for v in values])
        above = W.partitionBy("__parent").orderBy(F.desc("__own")).rowsBetween(W.unboundedPreceding, -1)
        before = sums.select("__parent", "__own", *[F.coalesce(F.sum(v).over(above), F.lit(0)).alias(f"__a_{v}") for v in values])
        starts = (starts.withColumns({"__parent": parent, "__own": own}).join(before, ["__parent", "__own"])
                  .select("__p", *[(F.col(f"__s_{v}") + F.col(f"__a_{v}")).alias(f"__s_{v}") for v in values]))
    inside = W.partitionBy("__p").orderBy(F.desc(order)).rowsBetween(W.unboundedPreceding, W.currentRow)
    joined = held.join(starts, "__p")
    return joined.select(*kept, *[(F.col(f"__s_{v}") + F.sum(v).over(inside)).alias(f"cum_{v}") for v in values])


def attach_small(rows: DataFrame, groups: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Left join to groups that are few because each holds many rows; Spark
    broadcasts them when its own measure says that they fit."""
    return rows.join(groups.select(*keys, *values), keys, "left").select(*rows.columns, *values)


def pr_curve(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Precision and recall at each distinct score, highest score first."""
    points = scored.groupBy(F.col(score).cast("double").alias("threshold")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count(F.lit(1)).alias("n"))
    # four passes follow; a point is narrower and rarer than a row
    points = written_once(points, "curve")
    positives = points.agg(F.sum("pos").alias("p")).scalar()
    return running_counts(points, "threshold", ["pos", "n"]).select(
        "threshold",
        F.col("cum_pos").alias("tp"),
        (F.col("cum_n") - F.col("cum_pos")).alias("fp"),
        N.ratio_or_zero("cum_pos", "cum_n").alias("precision"),
        N.ratio_or_zero("cum_pos", positives).alias("recall"),
        F.col("pos").alias("new_tp"),
    )


def average_precision(curve: DataFrame) -> DataFrame:
    """Sum of recall steps times precision."""
    return curve.agg(N.ratio_or_zero(F.sum(F.col("new_tp") * F.col("precision")), F.sum("new_tp"))
                     .alias("average_precision"))


def imbalance_ratio(df: DataFrame, label: str = "label") -> DataFrame:
    return df.agg(F.count_if(F.col(label) == 0).alias("negatives"), F.count_if(F.col(label) == 1).alias("positives"),
                  F.count_distinct(label).alias("classes")).withColumn(
        "ratio", F.try_divide(F.col("negatives").cast("double"), F.col("positives").cast("double")))


def weight_grid(
    scored: DataFrame, a: tuple[str, str], b: tuple[str, str], label: str = "label", weights=WEIGHTS
) -> DataFrame:
    """F1 of the soft vote for each pair of integer weights.

    ``a`` and ``b`` name the probabilities of class 0 and 1. All pairs are
    counted side by side in one aggregate; no row is repeated.
    """
    y = F.col(label) == 1
    grid = [(w_a, w_b) for w_a in weights for w_b in weights]
    counts = []
    for w_a, w_b in grid:
        p = N.argmax_binary(N.weighted_mean(a[0], b[0], w_a, w_b), N.weighted_mean(a[1], b[1], w_a, w_b)) == 1
        counts.append(F.struct(
            F.lit(w_a).alias("w_a"), F.lit(w_b).alias("w_b"),
            F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
            F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn")))
    return scores_of_counts(scored.agg(F.array(*counts).alias("rows")).select(F.inline("rows")))


def best_weights(grid: DataFrame) -> DataFrame:
    """First strict maximum of F1 in weight order; (1, 1) when all are 0,
    which is also the first row of that order."""
    return grid.orderBy(F.desc("f1"), "w_a", "w_b").limit(1).select("w_a", "w_b", "f1")


def ranked(results: DataFrame, name: str = "model", metric: str = "f1") -> DataFrame:
    return results.orderBy(F.desc(metric), name)


def winner(results: DataFrame, name: str = "model", metric: str = "f1") -> DataFrame:
    return ranked(results, name, metric).limit(1)


def improvement(scored: DataFrame, base: str, tuned: str, label: str = "label") -> DataFrame:
    """F1 of two predictions and the relative change, in one pass."""
    y, b, t = F.col(label) == 1, F.col(base) == 1, F.col(tuned) == 1

    def f1(p):
        # 2tp / (2tp + fp + fn)
        return N.ratio_or_zero(2 * F.count_if(y & p), F.count_if(y) + F.count_if(p))

    return scored.agg(f1(b).alias("base_f1"), f1(t).alias("tuned_f1")).withColumn(
        "improvement", N.improvement_percent("base_f1", "tuned_f1"))
