"""Quality scores from histogram gradient-boosted trees over statistics of whole texts.

The statistics come out of one pass over the texts, vectorised over chunks of many documents, and are kept as
a narrow table. The trees are fitted on a bounded sample of labelled rows (``fit_rows``, those with the
smallest hash of their id), with features cut into at most 64 bins, and flattened into arrays: a tree of depth
d is a row of 2^d - 1 features and thresholds and of 2^d leaf values. Scoring walks all rows of a batch down
one level at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorepipe.llm import common

FIT_ROWS = 20_000
THRESHOLD = 0.3
CHUNK = 1 << 18

CLASSES = [b" \t\r\x0b\x0c", b"\n", b"0123456789", bytes(range(65, 91)), bytes(range(97, 123)), b".", b",;:", b"!", b"?", b"#*$%&", b"|", b"<>{}[]=/\\_~^`@+", b"\"'()-", bytes(range(128, 192)), bytes(range(192, 256))]
FEATURES = [
    *(f"share_{n}" for n in ("control", "space", "newline", "digit", "upper", "lower", "stop", "comma", "shout", "question", "symbol", "pipe", "markup", "quote", "tail_byte", "lead_byte")),
    "log_chars", "log_words", "word_length", "word_length_spread", "longest_word", "distinct_words", "top_word", "distinct_pairs",
    "distinct_lines", "line_words", "words_cased", "words_shouted", "words_marked", "words_single", "byte_entropy",
]


def per_text(owner: np.ndarray, n: int, weights: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(owner, weights, minlength=n).astype(np.float64)


def distinct(owner: np.ndarray, name: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(different names, occurrences of the most frequent) per text."""
    order = np.lexsort((name, owner))
    owner, name = owner[order], name[order]
    at = common.runs(common.paired(owner.astype(np.uint64), name))
    size = np.diff(np.append(at, len(owner)))
    most = np.zeros(n)
    np.maximum.at(most, owner[at], size)
    return per_text(owner[at], n), most


def statistics(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """[texts, features] of a chunk."""
    n = len(starts) - 1
    kind = np.zeros(256, np.int64)
    for i, members in enumerate(CLASSES, 1):
        kind[list(members)] = i
    k = len(CLASSES) + 1
    owner = np.repeat(np.arange(n), np.diff(starts))
    size = np.maximum(np.diff(starts), 1).astype(np.float64)
    by_byte = np.zeros((n, 256))
    if len(data):
        cells, times = np.unique(owner * 256 + data, return_counts=True)
        by_byte.ravel()[cells] = times
    by_kind = np.zeros((n, k))
    for i in range(k):
        by_kind[:, i] = by_byte[:, kind == i].sum(axis=1)
    share = by_byte / size[:, None]
    entropy = -(share * np.log2(np.where(share > 0, share, 1))).sum(axis=1)
    chars = size - by_kind[:, 14]

    letters = np.ones(256, bool)
    letters[list(b" \t\n\r\x0b\x0c")] = False
    begin, end, text = common.word_spans(data, starts, letters)
    words = per_text(text, n)
    some = np.maximum(words, 1)
    length = (end - begin).astype(np.float64)
    mean = per_text(text, n, length) / some
    spread = np.sqrt(np.maximum(per_text(text, n, length * length) / some - mean * mean, 0))
    longest = np.zeros(n)
    np.maximum.at(longest, text, length)
    up = np.multiply.accumulate(np.full(len(data) + 1, 0x9E3779B97F4A7C15, np.uint64))
    down = up[::-1]
    prefix = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=prefix[1:])
    name = common.mix((prefix[end] - prefix[begin]) * down[begin]) if len(begin) else np.empty(0, np.uint64)
    different, most = distinct(text, name, n)
    follows = text[1:] == text[:-1]
    pair = common.paired(name[:-1], name[1:])[follows]
    pairs, _ = distinct(text[1:][follows], pair, n)
    kinds = kind[data]
    cased = kinds[begin] == 4 if len(begin) else np.empty(0, bool)
    upper = np.concatenate([[0], np.cumsum(kinds == 4)])
    marked = np.concatenate([[0], np.cumsum((kinds >= 8) & (kinds <= 12))])
    shouted = (upper[end] - upper[begin]) * 2 > length
    marks = (marked[end] - marked[begin]) > 0

    lb, le, lt = common.word_spans(data, starts, np.arange(256) != 10)
    line_name = common.mix((prefix[le] - prefix[lb]) * down[lb]) if len(lb) else np.empty(0, np.uint64)
    lines = per_text(lt, n)
    different_lines, _ = distinct(lt, line_name, n)
    return np.column_stack([
        by_kind / size[:, None], np.log1p(chars * (np.diff(starts) > 0)), np.log1p(words), mean, spread, longest,
        different / some, most / some, pairs / np.maximum(per_text(text[1:][follows], n), 1), different_lines / np.maximum(lines, 1), words / np.maximum(lines, 1),
        per_text(text, n, cased) / some, per_text(text, n, shouted) / some, per_text(text, n, marks) / some, per_text(text, n, length == 1) / some, entropy,
    ]).astype(np.float32)


def measured(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, x ARRAY<FLOAT>): the statistics of every whole text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [statistics(data, starts) for _, data, starts in common.text_chunks(batch, "text", CHUNK)]
            x = np.concatenate(rows) if rows else np.zeros((0, len(FEATURES)), np.float32)
            lists = pa.ListArray.from_arrays(np.arange(0, x.size + 1, len(FEATURES), dtype=np.int32), x.ravel())
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["doc_id", "x"])

    return docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(common.lean(work), "doc_id BIGINT, x ARRAY<FLOAT>")


@dataclass
class Trees:
    """Flattened trees: feature and threshold by tree and node (children of i: 2i + 1, 2i + 2), leaf values by tree."""

    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray
    base: float

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        row = np.arange(len(x))
        inner = self.feature.shape[1]
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(x), np.int64)
            while len(node) and node[0] < inner:
                node = 2 * node + 1 + (x[row, feature[node]] > threshold[node])
            out += leaf[node - inner]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.log_odds(x)))


def fit_trees(x: np.ndarray, y: np.ndarray, rounds: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64, penalty: float = 1.0, least: float = 1.0) -> Trees:
    """Second-order boosting of the logistic loss on binned features; grown level by level from histograms."""
    n, k = x.shape
    inner = 2**depth - 1
    rate_of_ones = (y.sum() + 0.5) / (n + 1)
    base = float(np.log(rate_of_ones / (1 - rate_of_ones)))
    if n == 0 or y.min() == y.max():
        return Trees(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)), base)
    edges = [np.unique(np.quantile(x[:, j], np.arange(1, bins) / bins, method="lower")) for j in range(k)]
    binned = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], axis=1)  # bin b: x <= edges[b]
    cell = binned + np.arange(k) * bins
    margin = np.full(n, base)
    trees = []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            at = ((node - first)[:, None] * (k * bins) + cell).ravel()
            sums = [np.bincount(at, np.repeat(v, k), width * k * bins).reshape(width, k, bins) for v in (g, h)]
            left_g, left_h = (np.cumsum(s, axis=2) for s in sums)
            all_g, all_h = left_g[:, :, -1:], left_h[:, :, -1:]
            right_g, right_h = all_g - left_g, all_h - left_h
            gain = left_g**2 / (left_h + penalty) + right_g**2 / (right_h + penalty) - all_g**2 / (all_h + penalty)
            gain = np.where((left_h >= least) & (right_h >= least), gain, 0).reshape(width, -1)
            best = gain.argmax(axis=1)
            for i in range(width):
                j, b = divmod(int(best[i]), bins)
                if gain[i, best[i]] > 1e-6 and b < len(edges[j]):
                    feature[first + i], threshold[first + i] = j, edges[j][b]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > threshold[node])
        g_leaf, h_leaf = (np.bincount(node - inner, v, inner + 1) for v in (g, h))
        leaf = -rate * g_leaf / (h_leaf + penalty)
        margin += leaf[node - inner]
        trees.append((feature, threshold, leaf))
    return Trees(*(np.stack(v) for v in zip(*trees)), base)


def fit(measures: DataFrame, labels: DataFrame, label: str = "quality", fit_rows: int = FIT_ROWS) -> Trees:
    """Trees from at most ``fit_rows`` labelled rows that are not held out; rows without a label value or id don't count."""
    marked = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("y")).filter("y IN (0, 1) AND doc_id IS NOT NULL")
    known = measures.join(marked, "doc_id").filter(~common.held_out(F.col("doc_id")))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(fit_rows).select("x", "y").toArrow()
    y = sample.column("y").to_numpy().astype(np.float64)
    x = np.array(sample.column("x").to_pylist(), np.float32).reshape(len(y), len(FEATURES))
    return fit_trees(x, y)


def scored(measures: DataFrame, trees: Trees) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(trees.score(x))], ["doc_id", "score"])

    return measures.mapInArrow(common.lean(work), "doc_id BIGINT, score DOUBLE")


def quality_scores(docs: DataFrame, labels: DataFrame, label: str = "quality", threshold: float = THRESHOLD, fit_rows: int = FIT_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; the score is the probability of label 1.

    Null and empty texts have all-zero shares and are scored like any other. Repeated rows each give a row; a
    null id is scored and never held out. Extra columns are ignored. Without labelled rows, or with one class
    only, every score is the smoothed rate of ones (0.5 without rows). An empty table gives no rows.
    """
    measures = common.settled(measured(docs))
    out = scored(measures, fit(measures, labels, label, fit_rows))
    return out.select("doc_id", common.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text is predicted good, with all their columns.

    The verdict is made in the row's own pass, so repeated and null ids need no join.
    """
    trees = fit(common.settled(measured(docs)), labels)
    schema = docs.schema

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [trees.score(statistics(data, starts)) >= THRESHOLD for _, data, starts in common.text_chunks(batch, "text", CHUNK)]
            yield batch.filter(pa.array(np.concatenate(keep) if keep else np.empty(0, bool)))

    return docs.mapInArrow(common.lean(work), schema)
