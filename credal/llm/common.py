"""Shared helpers: intermediate tables, file access from tasks, Arrow batches.

Intermediate tables are Parquet folders below the session's checkpoint folder
(``spark.checkpoint.dir``). They cut the lineage: when an executor is lost,
the next stage rereads them instead of recomputing the whole plan.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from credal.session import ensure_checkpoint_dir


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name in the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/llm-{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and read it back."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Arrow batches of at most ``rows`` texts, unless the session sets fewer:
    a batch is held once by the JVM and once by Python."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= rows:
        spark.conf.set(key, str(rows))


def pieces(n: int, each: int) -> int:
    """Number of parts of at most about ``each`` rows."""
    return max(1, math.ceil(n / each))


def open_fs(uri: str):
    """(filesystem, path) of a URI for use inside a task: any store pyarrow
    knows (file, hdfs, s3, gs); a path without a scheme is a local path."""
    from pyarrow import fs
    if "://" not in uri:
        uri = "file://" + uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri)


def text_bytes(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column as one array, and the n + 1 offsets of
    its rows. Null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = pa.concat_arrays(col.chunks) if col.num_chunks else pa.array([], pa.string())
    col = pc.fill_null(col, "")
    width = np.int64 if pa.types.is_large_string(col.type) else np.int32
    if len(col) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    buffers = col.buffers()
    offsets = np.frombuffer(buffers[1], width)[col.offset: col.offset + len(col) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.empty(0, np.uint8)
    return data[offsets[0]: offsets[-1]], offsets - offsets[0]


def row_slices(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` total size each (at least one row)."""
    total = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    a = 0
    while a < len(sizes):
        b = int(np.searchsorted(total, total[a] + limit, side="right")) - 1
        b = min(len(sizes), max(a + 1, b))
        yield a, b
        a = b


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of equal ``keys`` in a sorted stream of batches, each as one table.
    Only the current group is held."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        cols = [np.asarray(batch.column(k)) for k in keys]
        cut = np.zeros(batch.num_rows, bool)
        for c in cols:
            cut[1:] |= c[1:] != c[:-1]
        first = tuple(c[0] for c in cols)
        cut[0] = last is not None and first != last
        prev = 0
        for k in np.flatnonzero(cut).tolist():
            if k > prev:
                held.append(batch.slice(prev, k - prev))
            yield pa.Table.from_batches(held)
            held, prev = [], k
        held.append(batch.slice(prev))
        last = tuple(c[-1] for c in cols)
    if held:
        yield pa.Table.from_batches(held)


# hashing of words and shingles in numpy ------------------------------------------
_M = (1 << 64) - 1


def mix64(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective 64-bit finaliser (shifts and odd multipliers), vectorised."""
    x = x + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & _M)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE = mix64(np.arange(256, dtype=np.uint64), 11) | np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]        # A-Z count as a-z
_BYTE[_SPACE] = 0
_BASE = np.uint64(0xD6E8FEB86659FD93)


def word_hashes(data: np.ndarray, offsets: np.ndarray, chunk: int = 1 << 22) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words ``[^\\x20\\x09-\\x0D]+`` (A-Z lower-cased) of
    every row, and the n + 1 offsets of the rows in them."""
    n = len(data)
    if n == 0:
        return np.empty(0, np.uint64), np.zeros(len(offsets), np.int64)
    inside = ~_SPACE[data]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    row_start = offsets[:-1][offsets[:-1] < n]
    begin[row_start] |= inside[row_start]
    starts = np.flatnonzero(begin)
    if len(starts) == 0:
        return np.empty(0, np.uint64), np.zeros(len(offsets), np.int64)
    bounds = np.append(starts, n)
    out = np.empty(len(starts), np.uint64)
    powers = np.ones(1, np.uint64)
    for a, b in row_slices(np.diff(bounds), chunk):
        lo, hi = bounds[a], bounds[b]
        lengths = np.diff(bounds[a: b + 1])
        at = np.arange(hi - lo, dtype=np.int64) - np.repeat(bounds[a:b] - lo, lengths)
        longest = int(lengths.max())
        if longest > len(powers):
            powers = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(longest, _BASE)]))
        part = _BYTE[data[lo:hi]] * powers[at]
        out[a:b] = np.add.reduceat(part, bounds[a:b] - lo)
    return mix64(out), np.searchsorted(starts, offsets).astype(np.int64)


def shingle_hashes(words: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted k-word shingle hashes of every row, and row offsets.
    A row of 1 to k - 1 words has its whole sequence as its only shingle."""
    n = len(words)
    mult = [np.uint64((0xC2B2AE3D27D4EB4F * (2 * j + 3)) & _M | 1) for j in range(k)]
    roll = np.zeros(max(0, n - k + 1), np.uint64)
    for j in range(k):
        roll += words[j: j + len(roll)] * mult[j]
    roll = mix64(roll, 3)
    sets = []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        if b - a >= k:
            sets.append(np.unique(roll[a: b - k + 1]))
        elif b > a:
            whole = np.zeros(1, np.uint64)
            for j in range(b - a):
                whole += words[a + j: a + j + 1] * mult[j]
            sets.append(mix64(whole, 100 + b - a))
        else:
            sets.append(np.empty(0, np.uint64))
    counts = np.fromiter((len(s) for s in sets), np.int64, len(sets))
    flat = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    return flat, np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
