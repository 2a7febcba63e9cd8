"""Helpers that several operators of this subpackage share.

``shared_folder``/``stage_table`` cut lineage with a written table in the
folder that ``spark.checkpoint.dir`` names.  The rest turns Arrow string
columns into flat numpy arrays, so that hashing and windowing run over a
batch without a Python object per word.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

# bytes 0x20 and 0x09-0x0D separate words
SEPARATORS = b" \t\n\x0b\x0c\r"
WORD = "[^\\x20\\x09-\\x0D]+"

U64 = np.uint64
NO_ID = 2**63 - 1  # the key of a null id, larger than all others
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the cluster's shared checkpoint folder.  A local
    folder is made only where none is configured and the master is local."""
    base = checkpoint_dir(spark)
    if not base:
        master = spark.conf.get("spark.master", "local")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = checkpoint_dir(spark, tempfile.mkdtemp(prefix="homeward-"))
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later jobs scan
    it instead of computing it again, and a lost executor costs no lineage."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def map_arrow(df: DataFrame, function: Callable, schema) -> DataFrame:
    """``mapInArrow`` whose workers find this package where the driver found
    it, whatever the working directory."""
    environment = df.sparkSession.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join(p for p in [ROOT, *paths] if p)
    return df.mapInArrow(function, schema)


def row_key(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(did, th, text): an identity of each row that survives recomputation.
    A null id sorts after all others; null text is empty.  Rows that repeat
    id and text share a key and get the same result."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return df.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("did"),
        F.xxhash64(text).alias("th"),
        F.col(id_col).alias("row_id"),
        text.alias("text"),
    )


# ---- flat arrays ----------------------------------------------------------


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash (avalanche by xor-shift and multiply)."""
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    x = x ^ (x >> U64(29))
    x = x * U64(0xC2B2AE3D27D4EB4F)
    return x ^ (x >> U64(32))


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 2**64)
        self.up = self.down = np.ones(1, U64)

    def to(self, n: int):
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            self.up = np.concatenate([np.ones(1, U64), np.cumprod(np.full(n - 1, self.base, U64))])
            self.down = np.concatenate([np.ones(1, U64), np.cumprod(np.full(n - 1, self.inverse, U64))])
        return self.up, self.down


BYTE_POWERS = Powers(0x9E3779B97F4A7C15 | 1)
WORD_POWERS = Powers(0xA24BAED4963EE407 | 1)
# a random 64-bit value for each byte
BYTE_CODES = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))


class Rolling:
    """Prefix sums of a polynomial hash; the hash of any range in O(1)."""

    def __init__(self, values: np.ndarray, powers: Powers):
        up, self._down = powers.to(len(values) + 1)
        self._sum = np.zeros(len(values) + 1, U64)
        np.cumsum(values * up[: len(values)], out=self._sum[1:])

    def ranges(self, start, end) -> np.ndarray:
        return mix((self._sum[end] - self._sum[start]) * self._down[start])

    def windows(self, k: int) -> np.ndarray:
        n = len(self._sum) - k
        if n <= 0:
            return np.zeros(0, U64)
        return mix((self._sum[k:] - self._sum[:n]) * self._down[:n])


def flat_text(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def text_slices(offsets: np.ndarray, most: int):
    """Ranges of rows with at most ``most`` bytes (a longer row by itself)."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + most, "right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b
        a = b


_SEP = np.zeros(256, bool)
_SEP[list(SEPARATORS)] = True


def word_arrays(data: np.ndarray, offsets: np.ndarray):
    """(start byte, hash, first word of each text (n + 1)) of all words."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, U64), np.zeros(len(offsets), np.int64)
    inside = ~_SEP[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < n)]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    hashes = Rolling(BYTE_CODES[data], BYTE_POWERS).ranges(starts, ends)
    return starts, hashes, np.searchsorted(starts, offsets)


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` consecutive values, two passes at any ``w``."""
    n = len(x) - w + 1
    if n <= 0:
        return x[:0]
    if w == 1:
        return x
    pad = -len(x) % w
    top = np.iinfo(x.dtype).max
    blocks = np.concatenate([x, np.full(pad, top, x.dtype)]).reshape(-1, w)
    right = np.minimum.accumulate(blocks, axis=1).ravel()
    left = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(left[:n], right[w - 1 : w - 1 + n])
