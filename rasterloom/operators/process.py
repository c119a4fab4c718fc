"""User functions over tiles, with errors caught to rows, and summaries of results (tile_id, status, error)."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RESULT = "tile_id string, status string, error string"


def processed(tiles: DataFrame, work: Callable[[dict], object]) -> DataFrame:
    """work is called with each row as a dict; a row of result for each tile, `failed` with the error if it raises."""
    import pandas as pd

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for row in frame.to_dict("records"):
                try:
                    work(row)
                    rows.append((row["tile_id"], "success", None))
                except Exception as e:  # noqa: BLE001  the contract: an error becomes a row
                    rows.append((row["tile_id"], "failed", f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["tile_id", "status", "error"])

    return tiles.mapInPandas(run, RESULT)


def successes(results: DataFrame) -> DataFrame:
    return results.where("status = 'success'")


def failures(results: DataFrame) -> DataFrame:
    return results.where("status = 'failed'")


def appended(*results: DataFrame) -> DataFrame:
    out = results[0]
    for r in results[1:]:
        out = out.unionByName(r)
    return out


def summary(results: DataFrame, elapsed: float) -> DataFrame:
    """Totals, the failed tiles in order, and the mean time a tile; other statuses count nowhere."""
    total = F.col("n_success") + F.col("n_failed")
    counted = results.agg(
        F.count_if(F.col("status") == "success").alias("n_success"),
        F.count_if(F.col("status") == "failed").alias("n_failed"),
    )
    return counted.select("n_success", "n_failed", total.alias("n_total"), F.when(total > 0, F.lit(float(elapsed)) / total).alias("mean_time"))


def failed_lines(results: DataFrame) -> DataFrame:
    return failures(results).select("tile_id", F.coalesce("error", F.lit("Unknown")).alias("error")).orderBy("tile_id")


def splits_of(results: DataFrame, split: str = "split") -> DataFrame:
    return results.groupBy(split).agg(F.count("*").alias("n"))
