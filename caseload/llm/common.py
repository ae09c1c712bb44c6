"""Helpers of the training-data operators: shared folder, code shipping, word hashing."""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from ..session import fresh_path

ROWS = 512  # rows of a block of texts at most
BLOCK = 1 << 21  # bytes of text of a block, if it has more than one row
PIECE = 1 << 18  # bytes hashed at once
BATCH = 16 << 20
_shipped: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once a session, as --py-files would, and keep batches
    of long texts small (``BATCH`` bytes) on their way to Python."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH)
    root = Path(__file__).resolve().parents[2]
    path = os.path.join(tempfile.mkdtemp(prefix="caseload-"), "caseload.zip")
    with zipfile.ZipFile(path, "w") as out:
        for file in sorted((root / "caseload").rglob("*.py")):
            out.write(file, file.relative_to(root))
    context.addPyFile(path)
    _shipped.add(context.applicationId)


def land(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: computed once, lineage cut.

    Files on the shared folder outlive any executor.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _trim() -> None:
    """Give freed memory back: worker processes live on from task to task."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


_leave: dict[str, Callable[[], None]] = {}  # module -> how it forgets what it keeps in a worker


def on_leave(module: str, forget: Callable[[], None]) -> None:
    """``forget`` is called in a worker process when a task of another module begins there."""
    _leave[module] = forget


def in_arrow(df: DataFrame, fn: Callable[[Iterator], Iterator], schema) -> DataFrame:
    """``df.mapInArrow`` that keeps the worker small between batches, and between operators: what
    another one keeps from task to task is forgotten first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        others = [forget for module, forget in _leave.items() if module != fn.__module__]
        for forget in others:
            forget()
        if others:
            _trim()
        for n, batch in enumerate(fn(batches), 1):
            yield batch
            if n % 8 == 0:
                _trim()
        _trim()

    return df.mapInArrow(run, schema)


# -- texts as bytes ---------------------------------------------------------------------------


def texts_of(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows one after another, and len + 1 offsets. Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def blocks(offsets: np.ndarray, size: int = BLOCK, rows: int = ROWS) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes; a longer row stands alone."""
    low, n = 0, len(offsets) - 1
    while low < n:
        high = int(np.searchsorted(offsets, offsets[low] + size, "right")) - 1
        high = min(max(high, low + 1), low + rows, n)
        yield low, high
        low = high


# -- hashing ----------------------------------------------------------------------------------

BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2 ** 64
INVERSE = pow(BASE, -1, 1 << 64)


@lru_cache(2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(n + 1, BASE, np.uint64)
    down = np.full(n + 1, INVERSE, np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** i and its inverse for i up to n at least; sizes are rounded up to be reused."""
    return _powers(1 << max(18, int(n).bit_length()))


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer: every bit of the result depends on every bit of ``h``."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def random_table(seed: int, n: int = 256) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95) + np.uint64(seed))


def separators(kind: str) -> np.ndarray:
    """True for bytes between words: 'space' (x20, x09-x0D), or 'punctuation' (all ASCII but
    letters and digits)."""
    out = np.zeros(256, bool)
    if kind == "space":
        out[[0x20, *range(0x09, 0x0E)]] = True
    else:
        out[[b for b in range(128) if not chr(b).isalnum()]] = True
    return out


def byte_values(lower: bool, seed: int = 7) -> np.ndarray:
    """A random 64-bit number for each byte; with ``lower``, A-Z as a-z."""
    values = random_table(seed)
    if lower:
        values[0x41:0x5B] = values[0x61:0x7B]
    return values


@dataclass
class Words:
    """Words of several rows: hash, byte range, and the first word of each row (n + 1)."""

    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray


def words_of(data: np.ndarray, offsets: np.ndarray, sep: np.ndarray, values: np.ndarray) -> Words:
    """Words of rows that lie one after another in ``data``; no word crosses a row.

    Works through pieces that end at a separator or a row end, so memory follows the piece and
    the longest word, not the longest row.
    """
    n = len(data)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    hashes, starts, ends, low = [], [], [], 0
    while low < n:
        high = min(n, low + PIECE)
        if high < n and not (edge[high] or sep[data[high]]):
            more = np.flatnonzero(sep[data[low:high]] | edge[low:high])
            if len(more) and more[-1] > 0:
                high = low + int(more[-1])
            else:
                while high < n and not (edge[high] or sep[data[high]]):
                    high += 1
        part, cut = data[low:high], edge[low : high + 1].copy()
        cut[0] = cut[-1] = True
        word = ~sep[part]
        prior = np.empty(len(part), bool)
        prior[0], prior[1:] = False, word[:-1]
        begin = np.flatnonzero(word & (~prior | cut[:-1]))
        after = np.empty(len(part), bool)
        after[-1], after[:-1] = False, word[1:]
        finish = np.flatnonzero(word & (~after | cut[1:])) + 1
        up, down = powers(len(part))
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(values[part] * up[: len(part)], out=sums[1:])
        hashes.append(mix((sums[finish] - sums[begin]) * down[begin]))
        starts.append(begin + low)
        ends.append(finish + low)
        low = high
    if not hashes:
        none = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint64), none, none, np.zeros(len(offsets), np.int64))
    start = np.concatenate(starts)
    return Words(np.concatenate(hashes), start, np.concatenate(ends), np.searchsorted(start, offsets))


def grams(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of n words inside a row, and the index of its first word."""
    total = len(words.hash)
    if total < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.arange(total - n + 1)
    row_end = np.repeat(words.first[1:], np.diff(words.first))
    at = at[at + n <= row_end[: len(at)]]
    out = np.zeros(len(at), np.uint64)
    for k in range(n):
        out = out * np.uint64(BASE) + words.hash[at + k]
    return mix(out), at


def row_of(first: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Row of each word index."""
    return np.searchsorted(first, at, "right") - 1
