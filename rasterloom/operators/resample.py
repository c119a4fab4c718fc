"""Resampling and smoothing of rasters with separable kernels.

A kernel along an axis is a table (dst, src, w); nearest, bilinear, bicubic and Gaussian kernels differ in that table
only. Applying one is a join on the axis and a sum. An axis table has length x taps rows, whatever the pixels.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _normal(rows: DataFrame) -> DataFrame:
    total = rows.groupBy("dst").agg(F.sum("w").alias("t")).withColumnRenamed("dst", "d")
    return rows.join(total, F.col("dst") == F.col("d")).select("dst", "src", (F.col("w") / F.col("t")).alias("w"))


def _axis(spark: SparkSession, n: int) -> DataFrame:
    return spark.range(n).select(F.col("id").cast("int").alias("dst"))


def nearest_axis(spark: SparkSession, n: int, m: int) -> DataFrame:
    """From n pixels to m."""
    src = F.least(F.floor((F.col("dst") + 0.5) * F.lit(n / m)), F.lit(n - 1)).cast("int")
    return _axis(spark, m).select("dst", src.alias("src"), F.lit(1.0).alias("w"))


def bilinear_axis(spark: SparkSession, n: int, m: int) -> DataFrame:
    """Corners not aligned; ends repeat."""
    at = F.greatest(F.lit(0.0), F.least((F.col("dst") + 0.5) * F.lit(n / m) - 0.5, F.lit(float(n - 1))))
    low = F.floor(F.col("at")).cast("int")
    two = F.array(F.struct(low.alias("src"), (1 - (F.col("at") - low)).alias("w")), F.struct(F.least(low + 1, F.lit(n - 1)).alias("src"), (F.col("at") - low).alias("w")))
    return _axis(spark, m).withColumn("at", at).select("dst", F.explode(two).alias("s")).select("dst", "s.src", "s.w").groupBy("dst", "src").agg(F.sum("w").alias("w"))


def _cubic(x: Column, a: float = -0.5) -> Column:
    x = F.abs(x)
    return F.when(x < 1, ((a + 2) * x - (a + 3)) * x * x + 1).when(x < 2, (((x - 5) * x + 8) * x - 4) * a).otherwise(0.0)


def bicubic_axis(spark: SparkSession, n: int, m: int) -> DataFrame:
    """The kernel widens when shrinking, which keeps fine patterns from aliasing."""
    scale = n / m
    wide = max(scale, 1.0)
    centre = (F.col("dst") + 0.5) * F.lit(scale)
    low = F.greatest(F.floor(centre - 2 * wide + 0.5), F.lit(0))
    high = F.least(F.floor(centre + 2 * wide + 0.5), F.lit(n))
    each = _axis(spark, m).select("dst", centre.alias("centre"), F.explode(F.sequence(low.cast("int"), (high - 1).cast("int"))).alias("src"))
    return _normal(each.select("dst", "src", _cubic((F.col("src") + 0.5 - F.col("centre")) / F.lit(wide)).alias("w")))


def gaussian_axis(spark: SparkSession, n: int, sigma: float, truncate: float = 4.0) -> DataFrame:
    """Edges mirrored, the edge pixel repeated."""
    radius = int(truncate * sigma + 0.5)
    each = _axis(spark, n).select("dst", F.explode(F.sequence(F.lit(-radius), F.lit(radius))).alias("k"))
    i = F.pmod(F.col("dst") + F.col("k"), F.lit(2 * n))
    mirrored = F.when(i < n, i).otherwise(2 * n - 1 - i).cast("int")
    total = sum(math.exp(-0.5 * (k / sigma) ** 2) for k in range(-radius, radius + 1))
    w = F.exp(F.lit(-0.5) * F.pow(F.col("k") / F.lit(sigma), F.lit(2.0))) / F.lit(total)
    return each.select("dst", mirrored.alias("src"), w.alias("w")).groupBy("dst", "src").agg(F.sum("w").alias("w"))


def applied(px: DataFrame, rows: DataFrame, cols: DataFrame, value: str = "value", keys: tuple[str, ...] = ()) -> DataFrame:
    """px (keys, row, col, value) through both kernels; the values become doubles."""
    c = cols.select(F.col("src").alias("cs"), F.col("dst").alias("cd"), F.col("w").alias("cw"))
    r = rows.select(F.col("src").alias("rs"), F.col("dst").alias("rd"), F.col("w").alias("rw"))
    across = px.join(c, F.col("col") == F.col("cs")).groupBy(*keys, "row", "cd").agg(F.sum(F.col(value) * F.col("cw")).alias(value))
    return across.join(r, F.col("row") == F.col("rs")).groupBy(*keys, F.col("rd").alias("row"), F.col("cd").alias("col")).agg(F.sum(F.col(value) * F.col("rw")).alias(value))


def resized(px: DataFrame, size: tuple[int, int], to: tuple[int, int], how: str = "bicubic", eight_bit: bool = True) -> DataFrame:
    """From (height, width) to another; eight_bit: rounded and kept within 0..255."""
    make = {"nearest": nearest_axis, "bilinear": bilinear_axis, "bicubic": bicubic_axis}[how]
    spark = px.sparkSession
    out = applied(px, make(spark, size[0], to[0]), make(spark, size[1], to[1]))
    if eight_bit:
        out = out.withColumn("value", F.greatest(F.lit(0), F.least(F.lit(255), F.floor(F.col("value") + 0.5))).cast("smallint"))
    return out


def gaussian(px: DataFrame, height: int, width: int, sigma: float | None) -> DataFrame:
    """The raster smoothed; no sigma leaves it as it is."""
    if not sigma:
        return px
    spark = px.sparkSession
    return applied(px, gaussian_axis(spark, height, sigma), gaussian_axis(spark, width, sigma))
