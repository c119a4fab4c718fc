"""Per-pixel functions: bands, score vectors and decisions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rasterloom.functions.classes import simplify_model

# Channel means and deviations.
MEANS = (106.59, 105.66, 111.35)
DEVIATIONS = (39.78, 52.23, 45.62)


def normalized(bands: list[Column], means=MEANS, deviations=DEVIATIONS) -> list[Column]:
    return [(b - F.lit(m)) / F.lit(d) for b, m, d in zip(bands, means, deviations)]


def eight_bit(value: Column, kind: str, training: bool = False) -> Column:
    """A band value as 0..255: uint16 by 257 (by 256 where training data are read), float by 255, clipped and truncated."""
    if kind == "uint16":
        return F.floor(value / F.lit(256 if training else 257)).cast("smallint")
    if kind in ("float32", "float64", "float"):
        return F.floor(F.least(F.greatest(value * F.lit(255.0), F.lit(0.0)), F.lit(255.0))).cast("smallint")
    return value.cast("smallint")


def argmax(scores: Column) -> Column:
    """The place of the largest score; the first of equals."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def softmax(scores: Column) -> Column:
    shifted = F.transform(scores, lambda v: F.exp(v - F.array_max(scores)))
    return F.transform(shifted, lambda v: v / F.aggregate(shifted, F.lit(0.0), lambda a, b: a + b))


def biased(scores: Column, bias: dict[int, float] | None) -> Column:
    """Scores with a constant added to some classes."""
    if not bias:
        return scores
    table = F.create_map(*[F.lit(x) for k, b in bias.items() for x in (int(k), float(b))])
    return F.transform(scores, lambda v, i: v + F.coalesce(F.try_element_at(table, i), F.lit(0.0)))


def recovered(scores: Column, margin: float) -> Column:
    """The argmax, but 1 where 0 wins over 1 by less than the margin."""
    k = argmax(scores)
    if margin <= 0:
        return k
    return F.when((k == 0) & (scores[0] - scores[1] < F.lit(float(margin))), 1).otherwise(k)


def decided(scores: Column, bias: dict[int, float] | None = None, margin: float = 0.0, simplify: bool = False) -> Column:
    """Bias, argmax, recovery, then the nineteen classes to four."""
    k = recovered(biased(scores, bias), margin)
    return simplify_model(k) if simplify else k.cast("smallint")


def thresholded(p: Column, t: float = 0.5) -> Column:
    """1 from the threshold on."""
    return F.when(p >= F.lit(float(t)), 1).otherwise(0).cast("smallint")


def one_hot(value: Column, n: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: (value == k).cast("int"))


def postprocessed(scores: Column, mode: str, class_id: int | None = None, threshold: float = 0.5) -> Column:
    """`argmax`: the class; `binary`: whether one class's probability reaches the threshold."""
    if mode == "argmax":
        return argmax(scores).cast("smallint")
    if mode == "binary":
        if class_id is None:
            raise ValueError("binary needs a class_id")
        return thresholded(softmax(scores)[class_id], threshold)
    raise ValueError(f"unknown mode {mode}")
