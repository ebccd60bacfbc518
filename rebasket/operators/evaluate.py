"""AUC, ROC, precision-recall and score distribution.

Rows are first summed per distinct score. The running counts over the scores
use ranges whose number follows the distinct scores, so no task sees the whole
score range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rebasket.operators.running import range_blocks, running_totals
from rebasket.session import stored


def score_steps(rows: DataFrame, score: str, label: str, per_block: int | None = None,
                by: list[str] | None = None) -> DataFrame:
    """One row per distinct score: positives and negatives there, below, in total; for every group ``by``.

    Rows without a label, or with a NULL or NaN score, cannot be judged and are
    left out. The counts per score are stored, since the cut points and both totals read them.
    """
    by = by or []
    judged = rows.select(*by, F.col(score).cast("double").alias("score"), F.col(label).alias("_label"))
    judged = judged.where(F.col("score").isNotNull() & ~F.isnan("score") & F.col("_label").isNotNull())
    per_score = judged.groupBy(*by, "score").agg(
        F.count_if(F.col("_label") == 1).alias("pos"),
        F.count_if(F.col("_label") != 1).alias("neg"),
    )
    per_score = range_blocks(stored(per_score, "score-counts"), [*by, "score"], "score-blocks", per_block)
    return running_totals(per_score, by, F.col("block"), ["score"], ["pos", "neg"]).drop("block")


def roc_auc(rows: DataFrame, score: str, label: str, by: list[str] | None = None) -> DataFrame:
    """Area under the ROC curve, of every group ``by``; equal scores count half. NULL with one class only.

    All groups are measured in one grouped pass.
    """
    return steps_auc(score_steps(rows, score, label, by=by), by)


def steps_auc(steps: DataFrame, by: list[str] | None = None, **also: Column) -> DataFrame:
    """``roc_auc`` from ``score_steps``, with the sums ``also`` of every group."""
    below = F.col("neg_before") + F.col("neg") / 2
    totals = steps.groupBy(*(by or [])).agg(
        F.sum("pos").alias("positives"),
        F.sum("neg").alias("negatives"),
        F.sum(F.col("pos") * below).alias("wins"),
        *[F.sum(c).alias(name) for name, c in also.items()],
    )
    pairs = F.col("positives").cast("double") * F.col("negatives")
    return totals.select(*(by or []), "positives", "negatives", F.try_divide("wins", pairs).alias("auc"), *also)


def _at_threshold(rows: DataFrame, score: str, label: str) -> DataFrame:
    return score_steps(rows, score, label).select(
        "score",
        (F.col("pos_total") - F.col("pos_before")).alias("tp"),
        (F.col("neg_total") - F.col("neg_before")).alias("fp"),
        "pos_total",
        "neg_total",
    )


def roc_curve(rows: DataFrame, score: str, label: str) -> DataFrame:
    """One point per distinct score taken as threshold (score >= threshold is a yes)."""
    return _at_threshold(rows, score, label).select(
        F.col("score").alias("threshold"), "tp", "fp",
        F.try_divide("tp", "pos_total").alias("tpr"),
        F.try_divide("fp", "neg_total").alias("fpr"),
    )


def pr_curve(rows: DataFrame, score: str, label: str) -> DataFrame:
    return _at_threshold(rows, score, label).select(
        F.col("score").alias("threshold"), "tp", "fp",
        F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        F.try_divide("tp", "pos_total").alias("recall"),
    )


def _segments(rows: DataFrame, score: str, label: str) -> DataFrame:
    """Between a threshold and the next higher one: tp, fp there (a) and here (b), and all positives."""
    return score_steps(rows, score, label).select(
        (F.col("pos_total") - F.col("pos_before") - F.col("pos")).alias("tp_a"),
        (F.col("neg_total") - F.col("neg_before") - F.col("neg")).alias("fp_a"),
        "pos", "neg", F.col("pos_total").alias("p"),
    )


def pr_interpolated(rows: DataFrame, score: str, label: str, points: int = 1000) -> DataFrame:
    """Precision at ``points`` + 1 evenly spaced recalls: point, recall, precision.

    Between neighbouring thresholds false positives grow in proportion to true
    ones, which is no straight line in precision and recall. Recall 0 has the
    precision of the highest score. A segment names the points within it, so every
    point comes from one segment and nothing is joined. No positives, no points.
    """
    segments = _segments(rows, score, label).where("p > 0")
    first = F.floor(F.try_divide(F.col("tp_a") * points, F.col("p"))) + 1
    last = F.floor(F.try_divide((F.col("tp_a") + F.col("pos")) * points, F.col("p")))
    inside = segments.withColumns({"first": first, "last": last}).where("first <= last")
    tp = F.col("point") * F.col("p") / points
    fp = F.col("fp_a") + F.try_divide("neg", "pos") * (tp - F.col("tp_a"))
    drawn = inside.withColumn("point", F.explode(F.sequence("first", "last"))).select("point", (tp / (tp + fp)).alias("precision"))
    start = segments.where((F.col("tp_a") == 0) & (F.col("fp_a") == 0)).select(
        F.lit(0).cast("bigint").alias("point"), (F.col("pos") / (F.col("pos") + F.col("neg"))).alias("precision"))
    return drawn.unionByName(start).select(
        F.col("point").cast("int").alias("point"), (F.col("point") / points).alias("recall"), "precision")


def pr_auc(rows: DataFrame, score: str, label: str) -> DataFrame:
    """Exact area under the interpolated precision-recall curve; NULL without positives."""
    slope = F.try_divide("neg", "pos")
    rest = F.col("fp_a") - slope * F.col("tp_a")
    wide = 1 + slope
    bend = F.when(rest == 0, 0.0).otherwise(
        rest / (wide * wide) * F.log((wide * (F.col("tp_a") + F.col("pos")) + rest) / (wide * F.col("tp_a") + rest)))
    area = F.when(F.col("pos") > 0, F.col("pos") / wide - bend)
    totals = _segments(rows, score, label).agg(
        F.max("p").alias("positives"), F.sum("neg").alias("negatives"), F.sum(area).alias("area"))
    return totals.select("positives", "negatives", F.try_divide("area", "positives").alias("pr_auc"))


def quantiles(rows: DataFrame, value: str, by: list[str], probabilities: dict[str, float], per_block: int | None = None) -> DataFrame:
    """Exact quantiles of every group, between neighbouring values in proportion: ``by``, n and a column per probability.

    Values are counted first; the rank of a value is a running total over blocks.
    """
    counts = stored(rows.groupBy(*by, F.col(value).cast("double").alias("_value")).agg(F.count(F.lit(1)).alias("_n")), "value-counts")
    ranged = range_blocks(counts, [*by, "_value"], "value-blocks", per_block)
    ranked = running_totals(ranged, by, F.col("block"), ["_value"], ["_n"])

    def at(rank):
        return F.max(F.when((F.col("_n_before") <= rank) & (rank < F.col("_n_before") + F.col("_n")), F.col("_value")))

    found = []
    for name, p in probabilities.items():
        rank = (F.col("_n_total") - 1) * F.lit(p)
        share = F.max(rank - F.floor(rank))
        found.append((at(F.floor(rank)) + share * (at(F.ceil(rank)) - at(F.floor(rank)))).alias(name))
    return ranked.groupBy(*by).agg(F.max("_n_total").alias("n"), *found)


def score_density(rows: DataFrame, score: str, label: str, points: int = 512) -> DataFrame:
    """Gaussian kernel density of the scores of each label on an even grid over all scores: label, point, score, density.

    The bandwidth of a label is 0.9 times the lesser of its standard deviation and its
    quartile distance / 1.34 (the former, if the latter is 0; 1 if both are), times
    n ** -0.2. Scores are counted at their nearest grid point, so a label is at most
    ``points`` counts, and each counts for every point. NULL and NaN scores are left out.
    """
    s = F.col(score).cast("double")
    judged = stored(rows.where(s.isNotNull() & ~F.isnan(s)).select(F.col(label).alias("label"), s.alias("score")), "scores")
    span = judged.agg(F.min("score").alias("low"), F.max("score").alias("high")).first()
    low, step = span["low"] or 0.0, ((span["high"] or 0.0) - (span["low"] or 0.0)) / (points - 1)
    quarters = quantiles(judged, "score", ["label"], {"q1": 0.25, "q3": 0.75})
    spread = judged.groupBy(F.col("label").alias("_label")).agg(F.stddev_samp("score").alias("sd"))
    lesser = F.least("sd", (F.col("q3") - F.col("q1")) / 1.34)
    width = 0.9 * F.when(lesser > 0, lesser).when(F.col("sd") > 0, F.col("sd")).otherwise(1.0) * F.pow("n", F.lit(-0.2))
    shape = quarters.join(spread, F.col("label").eqNullSafe(F.col("_label"))).select(F.col("label").alias("_of"), "n", width.alias("bw"))
    bin_no = F.round((F.col("score") - low) / step).cast("int") if step else F.lit(0)
    counts = judged.groupBy("label", bin_no.alias("bin")).agg(F.count(F.lit(1)).alias("here"))
    each = counts.join(shape, F.col("label").eqNullSafe(F.col("_of"))).withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    off = (F.col("point") - F.col("bin")) * F.lit(step) / F.col("bw")
    kernel = F.exp(-off * off / 2) / (F.sqrt(F.lit(2.0) * F.lit(3.141592653589793)) * F.col("bw"))
    return each.groupBy("label", "point").agg(F.sum(F.col("here") * kernel / F.col("n")).alias("density")).select(
        "label", "point", (F.lit(low) + F.col("point") * F.lit(step)).alias("score"), "density")


def score_distribution(rows: DataFrame, score: str, label: str, bins: int = 20) -> DataFrame:
    """Rows and density per label and score bin over 0..1; a score of 1 is in the last bin.

    Scores below 0 count in the first bin and scores above 1 in the last; NULL
    and NaN scores are left out. The density of a label integrates to 1 over its bins.
    """
    s = F.col(score).cast("double")
    inside = F.greatest(F.least(F.floor(s * bins), F.lit(bins - 1)), F.lit(0))
    bin_no = inside.cast("int")
    counts = rows.where(s.isNotNull() & ~F.isnan(s)).groupBy(F.col(label).alias("label"), bin_no.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"))
    per_label = counts.groupBy(F.col("label").alias("_label")).agg(F.sum("n").alias("_total"))
    joined = counts.join(per_label, F.col("label").eqNullSafe(F.col("_label")))
    density = F.try_divide(F.col("n") * F.lit(bins), F.col("_total"))
    return joined.select("label", "bin", "n", density.alias("density"))
