"""What several corpus operators need: words, columns, bounded slices of Arrow batches, clean-up between phases."""

from __future__ import annotations

import ctypes
import gc
import time
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: a word is a run of anything but space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator reads; whatever else ``docs`` has cannot clash."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows whose ``column`` holds about ``limit`` bytes, one row at least.

    Keeps the memory of what works on a run bounded by ``limit`` or the longest value. After the last run, what was freed goes
    back to the system.
    """
    batch = None
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        run = np.cumsum(sizes.astype(np.int64)) // limit
        starts = np.flatnonzero(np.r_[True, run[1:] != run[:-1]])
        for start, end in zip(starts, [*starts[1:], batch.num_rows], strict=True):
            yield batch.slice(start, end - start)
    del batch
    release_memory()


def release_memory() -> None:
    """Return freed memory to the system; a Python worker lives on for other tasks, and its allocators would keep it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim is not None:
        trim(0)


def split_words(text: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of an array of texts, and where each text's words begin in it (one entry more than texts).

    Splits at the six ASCII white space characters only, as ``WORD`` does; null has no words.
    """
    lists = pc.ascii_split_whitespace(pc.fill_null(text, ""))
    flat = lists.flatten()
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    if len(flat) == 0:
        return flat, np.zeros(len(text) + 1, np.int64)
    full = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(text)), counts)
    starts = np.r_[0, np.cumsum(np.bincount(owner[full], minlength=len(text)))]
    return flat.filter(pa.array(full)), starts.astype(np.int64)


# The white space of ``WORD``.
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))


def mix64(x: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64: every bit of the input moves every bit of the output."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out, out=out)


def text_bytes(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts back to back, and where each begins (one entry more than texts); null is empty."""
    text = pc.fill_null(text, "").cast(pa.large_string())
    _, offsets, data = text.buffers()
    offsets = np.frombuffer(offsets, np.int64)[text.offset : text.offset + len(text) + 1]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def prefix_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running sums of a polynomial over ``data`` modulo 2**64, and the factor that moves a place to the front.

    ``(sums[e] - sums[s]) * back[s]`` depends on the bytes from s to e only.
    """
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(data)), out=sums[1:])
    return sums, _powers(_INVERSE, len(data) + 1)


def word_hashes(text: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """64 bits per word of an array of texts, and where each text's words begin; ``lower`` turns A-Z to a-z."""
    data, first = text_bytes(text)
    if lower:
        data = np.where((data >= 65) & (data <= 90), data + 32, data)
    full = ~_IS_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)  # a text's words do not join the next text's
    edge[first] = True
    start = np.flatnonzero(full & (edge[:-1] | ~np.r_[False, full[:-1]])) if len(data) else np.zeros(0, np.int64)
    end = np.flatnonzero(full & (edge[1:] | ~np.r_[full[1:], False])) + 1 if len(data) else start
    sums, back = prefix_hashes(data)
    hashes = mix64((sums[end] - sums[start]) * back[start])
    return hashes, np.searchsorted(start, first)


def window_hashes(words: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """64 bits per window of ``width`` words that lies in one text, and each window's text.

    A text with fewer words has one window, all of them; a text without words none.
    """
    counts = np.diff(first)
    n = np.where(counts > 0, np.maximum(counts - width + 1, 1), 0)
    owner = np.repeat(np.arange(len(counts)), n)
    start = first[:-1][owner] + np.arange(n.sum()) - (np.cumsum(n) - n)[owner]
    end = np.minimum(start + width, first[1:][owner])
    out = np.zeros(len(start), np.uint64)
    for k in range(width):
        inside = start + k < end
        out = np.where(inside, mix64(out * _BASE + words[np.where(inside, start + k, 0)] + np.uint64(k + 1)) if len(words) else out, out)
    return out, owner


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished phases now.

    Spark's cleaner removes them once the driver has collected the plans that refer to them, by
    default every half hour; a job of several phases would keep the files of all of them on disk.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
