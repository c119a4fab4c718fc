"""Scores of predictions against labels, and training losses over stored logits.

Rows: logits (array), target (int), and any batch key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rasterloom.functions import pixels

EPSILON = 1e-7


def confusion(pairs: DataFrame, classes: int = 4, by: list[str] | None = None, pred: str = "pred", target: str = "target") -> DataFrame:
    """tp, fp, fn of each class, absent classes too; one row a class and key. All counts in one pass."""
    by = by or []
    sums = []
    for k in range(classes):
        p, t = F.col(pred) == k, F.col(target) == k
        sums += [F.count_if(p & t).alias(f"tp{k}"), F.count_if(p & ~t).alias(f"fp{k}"), F.count_if(~p & t).alias(f"fn{k}")]
    wide = pairs.groupBy(*by).agg(*sums)
    rows = F.array(*[F.struct(F.lit(k).alias("class"), F.col(f"tp{k}").alias("tp"), F.col(f"fp{k}").alias("fp"), F.col(f"fn{k}").alias("fn")) for k in range(classes)])
    return wide.select(*by, F.explode(rows).alias("r")).select(*by, "r.class", "r.tp", "r.fp", "r.fn")


def rates(counts: DataFrame) -> DataFrame:
    e = F.lit(EPSILON)
    p, r = F.col("tp") / (F.col("tp") + F.col("fp") + e), F.col("tp") / (F.col("tp") + F.col("fn") + e)
    return counts.withColumn("precision", p).withColumn("recall", r).withColumn("f1", 2 * p * r / (p + r + e)).withColumn("iou", F.col("tp") / (F.col("tp") + F.col("fp") + F.col("fn") + e))


def epoch(pairs: DataFrame, batch: str, classes: int = 4) -> DataFrame:
    """Each class's metrics as unweighted means over the batches."""
    each = rates(confusion(pairs, classes, [batch]))
    return each.groupBy("class").agg(*[F.avg(c).alias(c) for c in ("iou", "precision", "recall", "f1")])


def running_loss(batches: DataFrame, order: str, loss: str = "loss", by: list[str] | None = None) -> DataFrame:
    """The mean loss so far at each batch. Batches of one epoch are few; by: keys of separate epochs."""
    w = Window.partitionBy(*(by or [F.lit(0)])).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return batches.withColumn("running", F.avg(loss).over(w))


def mean_loss(batches: DataFrame, loss: str = "loss") -> DataFrame:
    return batches.agg((F.coalesce(F.sum(loss), F.lit(0.0)) / F.greatest(F.count("*"), F.lit(1))).alias("mean_loss"))


def cross_entropy(logits: Column, target: Column) -> Column:
    top = F.array_max(logits)
    total = F.aggregate(logits, F.lit(0.0), lambda a, v: a + F.exp(v - top))
    return top + F.ln(total) - F.get(logits, target.cast("int"))


def focal_term(ce: Column, target: Column, alpha: float = 0.25, gamma: float = 2.0, weights: list[float] | None = None) -> Column:
    """Of the plain cross entropy; class weights scale the term."""
    scaled = ce if weights is None else ce * F.get(F.array(*[F.lit(float(w)) for w in weights]), target.cast("int"))
    return F.lit(alpha) * F.pow(1 - F.exp(-scaled), F.lit(gamma)) * scaled


def focal_loss(rows: DataFrame, alpha: float = 0.25, gamma: float = 2.0, weights: list[float] | None = None, by: list[str] | None = None) -> DataFrame:
    return rows.groupBy(*(by or [])).agg(F.avg(focal_term(cross_entropy(F.col("logits"), F.col("target")), F.col("target"), alpha, gamma, weights)).alias("focal"))


def dice_loss(rows: DataFrame, classes: int = 4, smooth: float = 1e-5, by: list[str] | None = None) -> DataFrame:
    """1 less the mean over classes of (2 I + s) / (U + s), I and U summed over all rows."""
    by = by or []
    p = rows.select(*by, "target", pixels.softmax(F.col("logits")).alias("p"))
    sums = []
    for k in range(classes):
        t = (F.col("target") == k).cast("double")
        sums += [F.sum(F.col("p")[k] * t).alias(f"i{k}"), F.sum(F.col("p")[k] + t).alias(f"u{k}")]
    wide = p.groupBy(*by).agg(*sums)
    scores = [(2 * F.coalesce(f"i{k}", F.lit(0.0)) + smooth) / (F.coalesce(f"u{k}", F.lit(0.0)) + smooth) for k in range(classes)]
    total = scores[0]
    for s in scores[1:]:
        total = total + s
    return wide.select(*by, (1 - total / classes).alias("dice"))


def combined_loss(rows: DataFrame, classes: int = 4, dice_weight: float = 0.5, **focal) -> DataFrame:
    f = focal_loss(rows, **focal)
    return f.crossJoin(dice_loss(rows, classes)).select("focal", "dice", ((1 - dice_weight) * F.col("focal") + dice_weight * F.col("dice")).alias("loss"))  # one row each
