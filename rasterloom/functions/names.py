"""Tile ids, file names, request strings and small formatters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The block pattern of point-cloud file names: two numbers.
BLOCK_PATTERN = r"LHD_FXX_(\d+)_(\d+)_"


def basename(url: Column) -> Column:
    """What follows the last slash, a query string included."""
    return F.element_at(F.split(url, "/"), -1)


def tile_name(url: Column) -> Column:
    """The file name up to its first dot."""
    return F.substring_index(basename(url), ".", 1)


def block_id(url: Column, pattern: str = BLOCK_PATTERN, strict: bool = True) -> Column:
    """The two numbers of the block pattern, joined by `_`; without a match an error, or null if not strict."""
    found = F.concat_ws("_", F.regexp_extract(url, pattern, 1), F.regexp_extract(url, pattern, 2))
    other = F.raise_error(F.concat(F.lit("no tile id in "), url)).cast("string") if strict else F.lit(None).cast("string")
    return F.when(url.rlike(pattern), found).otherwise(other)


def block_parts(url: Column) -> Column:
    """The third and fourth `_` parts of the file name."""
    parts = F.split(basename(url), "_")
    return F.concat_ws("_", F.get(parts, F.lit(2)), F.get(parts, F.lit(3)))


def tile_key(tile_id: Column) -> Column:
    """struct(tx, ty) from `X_Y`, `orthophoto_X_Y` or such with `.tif`; null if it isn't two whole numbers."""
    stem = F.when(tile_id.endswith(".tif"), F.regexp_replace(basename(tile_id), r"\.tif$", "")).otherwise(tile_id)
    parts = F.split(F.replace(stem, F.lit("orthophoto_"), F.lit("")), "_")
    x, y = F.get(parts, F.lit(0)).try_cast("int"), F.get(parts, F.lit(1)).try_cast("int")
    return F.when((F.size(parts) == 2) & x.isNotNull() & y.isNotNull(), F.struct(x.alias("tx"), y.alias("ty")))


def coordinate_id(path: Column, prefix: str) -> Column:
    """A raster's file name without prefix and extension."""
    return F.regexp_replace(F.regexp_replace(basename(path), "^" + prefix, ""), r"\.tif$", "")


def orthophoto_url(tile: Column, base: str, suffix: str = ".tif") -> Column:
    return F.concat(F.lit(base.rstrip("/") + "/"), tile, F.lit(suffix))


def map_request(base: str, layer: str, crs: Column, left: Column, bottom: Column, right: Column, top: Column, width: Column, height: Column, image_format: str = "image/jpeg") -> Column:
    """A WMS 1.3.0 GetMap request."""
    box = F.concat_ws(",", *[c.cast("string") for c in (left, bottom, right, top)])
    pairs = [("SERVICE", F.lit("WMS")), ("VERSION", F.lit("1.3.0")), ("REQUEST", F.lit("GetMap")), ("LAYERS", F.lit(layer)), ("CRS", crs), ("BBOX", box), ("WIDTH", width.cast("string")), ("HEIGHT", height.cast("string")), ("FORMAT", F.lit(image_format)), ("STYLES", F.lit(""))]
    return F.concat(F.lit(base + "?"), F.concat_ws("&", *[F.concat(F.lit(k + "="), F.url_encode(v)) for k, v in pairs]))


def preview(text: Column, n: int = 500) -> Column:
    return F.substring(text, 1, n)


def class_bias(text: Column) -> Column:
    """`1:2.0,3:-1` as a map of class to bias."""
    return F.map_from_entries(F.transform(F.filter(F.split(text, ","), lambda p: p != ""), lambda p: F.struct(F.split(p, ":")[0].cast("int"), F.split(p, ":")[1].cast("double"))))


def parsed_bias(pairs: list[str] | None) -> dict[int, float] | None:
    """The same from command-line words."""
    if not pairs:
        return None
    return {int(k): float(v) for k, v in (p.split(":") for p in pairs)}


def file_size(n: Column) -> Column:
    """Bytes as KB, MB or GB with two decimals."""
    mb, gb = 1024.0**2, 1024.0**3
    scaled = F.when(n > gb, n / gb).when(n > mb, n / mb).otherwise(n / 1024.0)
    return F.concat(F.format_string("%.2f", scaled), F.when(n > gb, " GB").when(n > mb, " MB").otherwise(" KB"))


def vector_format(path: Column) -> Column:
    """The output format that a file name's extension asks for; unknown ones mean GPKG."""
    ext = F.lower(F.concat(F.lit("."), F.element_at(F.split(path, r"\."), -1)))
    return F.when(ext == ".shp", "ESRI Shapefile").when(ext == ".geojson", "GeoJSON").otherwise("GPKG")


def humanized(seconds: Column) -> Column:
    """A duration in words: seconds, then minutes, hours and days, each rounded down."""
    n = lambda unit: F.floor(seconds / unit).cast("long")

    def words(unit: int, one: str, name: str) -> Column:
        return F.when(n(unit) == 1, one).otherwise(F.concat(n(unit).cast("string"), F.lit(f" {name}")))

    return F.when(seconds < 1, "a moment").when(seconds < 60, words(1, "a second", "seconds")).when(seconds < 3600, words(60, "a minute", "minutes")).when(seconds < 86400, words(3600, "an hour", "hours")).otherwise(words(86400, "a day", "days"))
