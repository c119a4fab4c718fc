"""Training patches: sampling, augmentation, samples, and parameter tables of models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rasterloom.functions import classes, pixels
from rasterloom.operators import blend


def _digits(n: int, *parts) -> Column:
    """The first n hexadecimal digits of a digest of the parts, as a number."""
    return F.conv(F.substring(F.md5(F.concat_ws("#", *parts).cast("binary")), 1, n), 16, 10).cast("long")


def sampled(tiles: DataFrame, patch: int = 512, per_tile: int = 100, seed: int = 0) -> DataFrame:
    """per_tile corners (y, x) of each tile (tile_id, height, width) larger than the patch, uniform and repeatable."""
    big = tiles.where((F.col("height") > patch) & (F.col("width") > patch))
    each = big.select("*", F.explode(F.sequence(F.lit(1), F.lit(per_tile))).alias("n"))
    part = lambda salt: _digits(8, "tile_id", "n", F.lit(seed), F.lit(salt)) / F.lit(float(1 << 32))
    return each.withColumn("patch_id", F.concat_ws("#", "tile_id", "n")).withColumn("y", F.floor(part(1) * (F.col("height") - patch)).cast("int")).withColumn("x", F.floor(part(2) * (F.col("width") - patch)).cast("int"))


def too_small(tiles: DataFrame, patch: int = 512) -> DataFrame:
    return tiles.where((F.col("height") <= patch) | (F.col("width") <= patch))


def draws(patches: DataFrame, seed: int = 0) -> DataFrame:
    """hflip, vflip and quarter turns (0 to 3) of each patch."""
    bits = _digits(1, "patch_id", F.lit(seed), F.lit(7))
    return patches.withColumn("hflip", (bits % 2) == 1).withColumn("vflip", (F.floor(bits / 2) % 2) == 1).withColumn("turns", F.floor(bits / 4).cast("int"))


def pixels_of(patches: DataFrame, tile_pixels: DataFrame, patch: int) -> DataFrame:
    """The pixels inside each patch, with their place in it: pr and pc."""
    p = patches.select(F.col("tile_id").alias("of"), "patch_id", F.col("y").alias("py"), F.col("x").alias("px"), *[c for c in ("hflip", "vflip", "turns") if c in patches.columns])
    inside = F.col("row").between(F.col("py"), F.col("py") + patch - 1) & F.col("col").between(F.col("px"), F.col("px") + patch - 1)
    joined = tile_pixels.join(p, (F.col("tile_id") == F.col("of")) & inside)
    return joined.withColumn("pr", F.col("row") - F.col("py")).withColumn("pc", F.col("col") - F.col("px")).drop("of", "py", "px")


def augmented(px: DataFrame, patch: int) -> DataFrame:
    """pr and pc after the patch's flips and turns; the same for image and mask, being one row."""
    last = F.lit(patch - 1)
    r, c = F.col("pr"), F.col("pc")
    c = F.when(F.col("hflip"), last - c).otherwise(c)
    r = F.when(F.col("vflip"), last - r).otherwise(r)
    side = F.lit(patch)
    turned = [(r, c), *[blend.augmented(m, r, c, side, side)[:2] for m in ("rot90", "rot180", "rot270")]]
    pick = lambda k: F.when(F.col("turns") == 1, turned[1][k]).when(F.col("turns") == 2, turned[2][k]).when(F.col("turns") == 3, turned[3][k]).otherwise(turned[0][k])
    return px.withColumn("_r", pick(0)).withColumn("_c", pick(1)).drop("pr", "pc").withColumnsRenamed({"_r": "pr", "_c": "pc"})


def samples(px: DataFrame, n_classes: int = 4) -> DataFrame:
    """Normalized bands, mask and one-hot mask of each pixel of a patch (r, g, b, value)."""
    red, green, blue = pixels.normalized([F.col("r"), F.col("g"), F.col("b")])
    return px.select("patch_id", "pr", "pc", red.alias("r"), green.alias("g"), blue.alias("b"), classes.simplify_scaled(F.col("value")).alias("mask")).withColumn("class_mask", pixels.one_hot(F.col("mask"), n_classes))


def paired(image: DataFrame, mask: DataFrame) -> DataFrame:
    """Image and mask pixels of the same place; an error where one has pixels that the other lacks."""
    a = image.withColumn("_a", F.lit(1))
    b = mask.select("tile_id", "row", "col", "value").withColumn("_b", F.lit(1))
    both = a.join(b, ["tile_id", "row", "col"], "full")
    guard = F.when(F.col("_a").isNull() | F.col("_b").isNull(), F.raise_error(F.concat(F.col("tile_id"), F.lit(": image and mask differ in shape"))).cast("int")).otherwise(1)
    return both.withColumn("_ok", guard).where("_ok = 1").drop("_a", "_b", "_ok")


def frozen(parameters: DataFrame, freeze_encoder: bool = True, decoder_blocks: int | None = None) -> DataFrame:
    """parameters (part: encoder, decoder or head; position; name; size) with trainable: the encoder and the first
    decoder blocks can be frozen, the head never."""
    w = Window.partitionBy("part").orderBy("position")
    ranked = parameters.withColumn("_n", F.row_number().over(w))
    stop = (F.col("part") == "encoder") & F.lit(freeze_encoder)
    if decoder_blocks is not None:
        stop = stop | ((F.col("part") == "decoder") & (F.col("_n") <= decoder_blocks))
    return ranked.withColumn("trainable", ~stop).drop("_n")


def parameter_totals(parameters: DataFrame) -> DataFrame:
    return parameters.agg(F.sum("size").alias("total"), F.sum(F.when(~F.col("trainable"), F.col("size")).otherwise(0)).alias("frozen"), F.sum(F.when(F.col("trainable"), F.col("size")).otherwise(0)).alias("trainable"))


def checkpoint_keys(entries: DataFrame) -> DataFrame:
    """Entries (name, ...) of a checkpoint without `criterion.*` and without the prefix `model.`."""
    return entries.where(~F.col("name").startswith("criterion.")).withColumn("name", F.regexp_replace("name", r"^model\.", ""))
