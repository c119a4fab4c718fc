"""Class codes, their names, and the maps between them, as expressions and small dimension tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The four simplified classes.
SIMPLIFIED = {0: "else", 1: "herbaceous", 2: "hedge", 3: "trees"}

# The nineteen classes of the segmentation model.
MODEL_CLASSES = {
    0: "building",
    1: "greenhouse",
    2: "swimming_pool",
    3: "impervious surface",
    4: "pervious surface",
    5: "bare soil",
    6: "water",
    7: "snow",
    8: "herbaceous vegetation",
    9: "agricultural land",
    10: "plowed land",
    11: "vineyard",
    12: "deciduous",
    13: "coniferous",
    14: "brushwood",
    15: "clear cut",
    16: "ligneous",
    17: "mixed",
    18: "undefined",
}

# Point classification codes.
POINT_CODES = {
    0: "Never classified / Created",
    1: "Unclassified",
    2: "Ground",
    3: "Low Vegetation < 1.5m",
    4: "Medium Vegetation 1.5-5m",
    5: "High Vegetation 5-15m",
    6: "Building",
    7: "Low Point (noise)",
    8: "Reserved: very high vegetation > 15m",
    9: "Water",
    10: "Rail",
    11: "Road Surface",
    12: "Reserved",
    13: "Wire - Guard (Shield)",
    14: "Wire - Conductor (Phase)",
    15: "Transmission Tower",
    16: "Wire-structure Connector (Insulator)",
    17: "Bridge Deck",
    18: "High Noise",
}

# Labels of scaled rasters.
SCALED_LABELS = {0: "ground", 63: "grass", 127: "hedge", 191: "trees", 255: "else"}

# Which codes become which simplified class; every other code is 0.
MODEL_TO_SIMPLIFIED = {1: (8, 9, 10), 2: (14,), 3: (12, 13, 16, 17)}
POINT_TO_SIMPLIFIED = {1: (3,), 2: (4,), 3: (5, 8)}
SCALED_TO_SIMPLIFIED = {1: (63,), 2: (127,), 3: (191,)}


def _mapped(code: Column, table: dict[int, tuple[int, ...]]) -> Column:
    out = F.lit(0)
    for target, codes in table.items():
        out = F.when(code.isin(*codes), F.lit(target)).otherwise(out)
    return out.cast("smallint")


def simplify_model(code: Column) -> Column:
    """Nineteen model classes to four; unknown codes are 0."""
    return _mapped(code, MODEL_TO_SIMPLIFIED)


def simplify_points(code: Column) -> Column:
    """Point codes to four classes; ground and all others are 0."""
    return _mapped(code, POINT_TO_SIMPLIFIED)


def simplify_scaled(value: Column) -> Column:
    """Raster labels 0/63/127/191/255 to four classes; other values are 0."""
    return _mapped(value, SCALED_TO_SIMPLIFIED)


def dimension(spark: SparkSession, table: dict[int, str]) -> DataFrame:
    """A dictionary as a table of code and name."""
    return spark.createDataFrame([(k, v) for k, v in table.items()], "code int, name string")


def named(df: DataFrame, code: str, table: dict[int, str], default: str = "unknown", out: str = "class_name") -> DataFrame:
    """The rows with the code's name from a dictionary of fixed size."""
    dim = dimension(df.sparkSession, table).select(F.col("code").alias("_code"), F.col("name").alias("_name"))
    return df.join(F.broadcast(dim), F.col(code) == F.col("_code"), "left").withColumn(out, F.coalesce("_name", F.lit(default))).drop("_code", "_name")


def listed(spark: SparkSession, simplified: bool = True) -> DataFrame:
    return dimension(spark, SIMPLIFIED if simplified else MODEL_CLASSES)


def training_classes(spark: SparkSession) -> DataFrame:
    """The simplified classes that training looks at by default: all but `else`."""
    return listed(spark).where("name <> 'else'")


def head_names(n: int) -> list[str]:
    """Names of a model's n outputs."""
    return list(SIMPLIFIED.values()) if n == len(SIMPLIFIED) else [f"class_{k}" for k in range(n)]


def outputs_of_checkpoint(path: Column) -> Column:
    """How many classes a checkpoint file stands for: 19 for safetensors, else 4."""
    return F.when(path.endswith(".safetensors"), 19).otherwise(4)
