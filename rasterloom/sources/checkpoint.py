"""Parameter tables of model checkpoints: safetensors headers, and the pickled index of zipped `.pth` files.

A pickle's classes are never imported: every name in it becomes an inert stand-in, so nothing of a file is run.
"""

from __future__ import annotations

import io
import json
import pickle
import struct
import zipfile
from collections.abc import Callable, Iterator
from contextlib import nullcontext

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from rasterloom.operators import patches
from rasterloom.sources import files


def header(data: bytes | Callable[[int, int], bytes]) -> list[tuple[str, str, list[int], int]]:
    """name, type, shape and element count of each tensor. data: the file's bytes, or a function that reads a range."""
    read = data if callable(data) else lambda at, n: data[at : at + n]
    n, = struct.unpack("<Q", read(0, 8))
    out = []
    for name, x in json.loads(read(8, n)).items():
        if name != "__metadata__":
            size = 1
            for d in x["shape"]:
                size *= d
            out.append((name, x["dtype"], x["shape"], size))
    return out


class _Ranged(io.RawIOBase):
    """A seekable file over a function that reads ranges."""

    def __init__(self, read: Callable[[int, int], bytes], size: int):
        self.part, self.size, self.at = read, size, 0

    def seekable(self) -> bool:
        return True

    def readable(self) -> bool:
        return True

    def seek(self, offset: int, whence: int = 0) -> int:
        self.at = offset + (0, self.at, self.size)[whence]
        return self.at

    def tell(self) -> int:
        return self.at

    def read(self, n: int = -1) -> bytes:
        n = self.size - self.at if n is None or n < 0 else min(n, self.size - self.at)
        data = self.part(self.at, n) if n > 0 else b""
        self.at += len(data)
        return data


class _Tensor:
    def __init__(self, kind: str, shape: list[int]):
        self.kind, self.shape = kind, shape


class _Kind:
    """A storage class, which is only named."""

    def __init__(self, name: str):
        self.name = name


class _Stub:
    """Stands in for any object of a pickle."""

    def __init__(self, *args, **kwargs):
        self.args = args

    def __call__(self, *args, **kwargs):
        return _Stub(*args)

    def __setstate__(self, state):
        pass

    def __setitem__(self, key, value):
        pass

    def append(self, value):
        pass

    extend = update = append


# Element types of stored arrays by the name of their storage.
_STORED = {"FloatStorage": "F32", "DoubleStorage": "F64", "HalfStorage": "F16", "BFloat16Storage": "BF16", "LongStorage": "I64", "IntStorage": "I32", "ShortStorage": "I16", "CharStorage": "I8", "ByteStorage": "U8", "BoolStorage": "BOOL"}


class _Index(pickle.Unpickler):
    def find_class(self, module: str, name: str):
        if (module, name) == ("collections", "OrderedDict"):
            return dict
        if name in ("_rebuild_tensor_v2", "_rebuild_tensor"):
            return lambda storage, offset, size, *rest: _Tensor(storage, list(size))
        if name in ("_rebuild_parameter", "_rebuild_parameter_with_state"):
            return lambda data, *rest: data
        return _Kind(_STORED[name]) if name in _STORED else _Stub

    def persistent_load(self, pid):
        return pid[1].name if isinstance(pid[1], _Kind) else "F32"


def pickled(read: Callable[[int, int], bytes], size: int) -> list[tuple[str, str, list[int], int]]:
    """As `header`, of a zipped checkpoint; of a dictionary with `state_dict`, what that holds."""
    with zipfile.ZipFile(_Ranged(read, size)) as z:
        name = next(n for n in z.namelist() if n.endswith("data.pkl"))
        found = _Index(io.BytesIO(z.read(name))).load()
    if isinstance(found, dict) and isinstance(found.get("state_dict"), dict):
        found = found["state_dict"]
    out = []
    for name, x in found.items() if isinstance(found, dict) else ():
        if isinstance(x, _Tensor):
            n = 1
            for d in x.shape:
                n *= d
            out.append((name, x.kind, x.shape, n))
    return out


def read(spark: SparkSession, path: str) -> DataFrame:
    """name, dtype, shape, size; loss parameters left out and the wrapper's prefix taken off. Only headers are read."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for r in f.itertuples():
                with files.opened(r.path) if near else nullcontext(bytes(r.content)) as data:
                    part = data if callable(data) else lambda at, n, d=data: d[at : at + n]
                    rows = pickled(part, int(r.length)) if part(0, 2) == b"PK" else header(part)
                    yield pd.DataFrame(rows, columns=["name", "dtype", "shape", "size"])

    near = files.ranged(path)
    rows = spark.read.format("binaryFile").load(path).select("path", "length", *([] if near else ["content"])).mapInPandas(run, "name string, dtype string, shape array<long>, size long")
    return patches.checkpoint_keys(rows)
