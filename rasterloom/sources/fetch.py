"""Downloads to a folder, chunk by chunk; each URL gives a row of result. Where there is no network, stage the files."""

from __future__ import annotations

import os
import urllib.request

from pyspark.sql import DataFrame

from rasterloom.operators import process

CHUNK = 8192


def download(url: str, path: str | None = None, timeout: float | None = None) -> str:
    """The file behind a URL; without a path, under the URL's last part. HTTP errors raise."""
    path = path or url.split("/")[-1]
    with urllib.request.urlopen(url, timeout=timeout) as answer, open(path, "wb") as out:
        while chunk := answer.read(CHUNK):
            out.write(chunk)
    return path


def fetch_image(url: str, path: str, timeout: float = 60) -> str | None:
    """A map request's image; None, with a message, if the answer is no image."""
    with urllib.request.urlopen(url, timeout=timeout) as answer:
        kind = answer.headers.get("Content-Type", "")
        if "image" not in kind:
            print(f"expected an image, got {kind}: {answer.read(500).decode(errors='replace')}")
            return None
        with open(path, "wb") as out:
            while chunk := answer.read(CHUNK):
                out.write(chunk)
    return path


def downloaded(urls: DataFrame, folder: str) -> DataFrame:
    """urls: tile_id, url. Files that are there already are kept."""

    def work(row: dict) -> None:
        path = os.path.join(folder, row["url"].split("/")[-1])
        if not os.path.exists(path):
            os.makedirs(folder, exist_ok=True)
            download(row["url"], path)

    return process.processed(urls, work)
