"""What several operators share: reading tables, text as bytes, key order, components, cut lineage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scorepipe.session import shared_dir
from scorepipe.sources.tables import read_parquet

CHUNK_BYTES = 1 << 21
"""Bytes of text that one vectorised step works on, unless a single text is longer."""

GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_parquet(spark, sf_dir, "documents")


def settled(df: DataFrame) -> DataFrame:
    """Cut the lineage: written to the shared folder and read again, so no executor owns it."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def text_name(text: str) -> Column:
    """16 bytes that name a text; null and empty texts are one."""
    return F.unhex(F.md5(F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")))


def lean(work: Callable) -> Callable:
    """The same function for mapInArrow, which gives free memory back to the system when its task ends.

    Workers serve many tasks; without this each of them keeps the largest amount that any task ever took.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ctypes
        import gc

        try:
            yield from work(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
            if trim:
                trim(0)

    return run


def held_out(doc_id: Column) -> Column:
    """Rows that no fit may see: crc32 of the id as text is divisible by five."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def string_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, start of each text and the end of the last); a null text is empty."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) else b"")
    n = len(column)
    _, offsets, data = column.buffers()
    if n == 0 or offsets is None:
        return np.empty(0, np.uint8), np.zeros(n + 1, np.int64)
    starts = np.frombuffer(offsets, np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[starts[0] : starts[-1]], starts - starts[0]


def text_chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Neighbouring rows of a batch with at most ``limit`` bytes of text together, or one longer text."""
    data, starts = string_bytes(batch.column(batch.schema.get_field_index(column)))
    n, i = len(starts) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + limit, "right")) - 1)
        j = min(j, n)
        yield slice(i, j), data[starts[i] : starts[j]], starts[i : j + 1] - starts[i]
        i = j


def longs(batch: pa.RecordBatch, column: str) -> np.ndarray:
    """A BIGINT column; null is the smallest long, so it sorts first."""
    values = batch.column(batch.schema.get_field_index(column))
    return values.fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit word over all bits."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def paired(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Name of an ordered pair of names."""
    return mix(a * GOLDEN + (b ^ (b >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(1))


def word_spans(data: np.ndarray, starts: np.ndarray, in_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, index of the text) of every word in a chunk; ``in_word`` says which of the 256 bytes are letters."""
    inside = in_word[data]
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    edges = starts[1:-1]
    first = inside & ~before
    cut = edges[(edges > 0) & (edges < len(data))]
    first[cut] |= inside[cut]  # a text begins a new word
    begin = np.flatnonzero(first)
    last = np.empty_like(inside)
    last[-1:] = inside[-1:]
    last[:-1] = inside[:-1] & (~inside[1:] | first[1:])
    end = np.flatnonzero(last) + 1
    return begin, end, np.searchsorted(starts, begin, "right") - 1


def runs(sorted_key: np.ndarray) -> np.ndarray:
    """Where each run of equal keys starts."""
    if not len(sorted_key):
        return np.empty(0, np.int64)
    return np.concatenate([[0], np.flatnonzero(sorted_key[1:] != sorted_key[:-1]) + 1])


def merged_ranges(owner: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unite half-open ranges of the same owner that overlap or touch."""
    if not len(owner):
        return owner, low, high
    order = np.lexsort((low, owner))
    owner, low, high = owner[order], low[order], high[order]
    step = int(high.max()) + 1  # shifts each owner beyond the one before, so one running maximum serves all
    group = np.cumsum(np.concatenate([[0], owner[1:] != owner[:-1]])) * step
    ends = np.maximum.accumulate(high + group)
    fresh = np.ones(len(owner), bool)
    fresh[1:] = (low[1:] + group[1:] > ends[:-1]) | (owner[1:] != owner[:-1])
    last = np.append(np.flatnonzero(fresh)[1:] - 1, len(owner) - 1)
    return owner[fresh], low[fresh], (ends - group)[last]


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) of every node that has an edge; root is the smallest node it is connected with.

    ``edges`` has BIGINT columns ``a`` and ``b``. Large-star and small-star steps: every node hands its
    neighbours to the smallest of them, which doubles the distance covered in each round. Both steps are a
    minimum per node (combined in the tasks before the shuffle) and a join; each round is checkpointed.
    """
    now = settled(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    for _ in range(most_rounds):
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).filter("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).union(low.select("a", F.col("low").alias("b")))
        now = settled(small.filter("a <> b").distinct())
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = state
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
