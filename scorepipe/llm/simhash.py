"""Near duplicates by SimHash fingerprints, found with the keys of a Golay code.

A fingerprint is cut into four segments of 16 bits. When two differ in at most three bits, going round
the four segments some segment is equal and the next one differs in at most one bit: with one to three
faulty segments the error-free one before the least faulty stretch always has such a neighbour (all
distributions of three errors are checked in the tests). So a key is (segment number, that segment as it
is, a Golay code word index of the next one). The [23,12] Golay code is perfect: every word lies within
three bits of one code word. A word keeps the index of its own code word and those that its one-bit
neighbours decode to, at most six; two segments one bit apart share one of them.

Fingerprints with the same key meet in one sorted run and are compared bit by bit; a run gives a spanning
forest of its links, not its pairs. Components of the forests are the components of all links.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from scorepipe.llm import common

SHINGLE_WORDS = 3
MOST_BITS = 3
RUN_ROWS = 1 << 12
"""A longer run of one key is cut into tiles of this many fingerprints that meet in other tasks."""

GENERATOR = 0xC75  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1, generates the binary Golay code
SEPARATORS = rb"[^\x20\x09-\x0d]+"


def remainder(word: np.ndarray) -> np.ndarray:
    """Remainder of a 23-bit word by the generator; it tells the error pattern."""
    for bit in range(22, 10, -1):
        word = np.where(word >> bit & 1, word ^ (GENERATOR << (bit - 11)), word)
    return word


def nearby_codewords() -> np.ndarray:
    """[65536, 6]: code word indices of each 16-bit segment (its upper seven code bits are zero), -1 where there are fewer."""
    one = 1 << np.arange(23)
    i, j, k = np.array([(i, j, k) for i in range(23) for j in range(i) for k in range(j)]).T
    two = np.array([(i, j) for i in range(23) for j in range(i)]).T
    errors = np.concatenate([[0], one, one[two[0]] | one[two[1]], one[i] | one[j] | one[k]])
    pattern = np.empty(1 << 11, np.int64)  # 2,048 patterns, 2,048 remainders: the code is perfect
    pattern[remainder(errors)] = errors
    segment = np.arange(1 << 16)
    decoded = np.stack([(w ^ pattern[remainder(w)]) >> 11 for w in [segment, *(segment ^ (1 << i) for i in range(16))]], axis=1)
    decoded = np.sort(decoded, axis=1)
    none = 1 << 12
    decoded[:, 1:][decoded[:, 1:] == decoded[:, :-1]] = none
    decoded = np.sort(decoded, axis=1)
    decoded = decoded[:, : int((decoded < none).sum(axis=1).max())]
    return np.where(decoded < none, decoded, -1).astype(np.int16)


def fingerprint(text: bytes, words: int, seed: int = 42) -> int:
    """SimHash of one text: a bit is set when more than half of the shingle hashes have it."""
    from xxhash import xxh64_intdigest

    tokens = re.findall(SEPARATORS, text.lower())  # bytes.lower touches A-Z only
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    ends = np.cumsum([len(t) + 1 for t in tokens])
    begins = [0, *ends[:-1].tolist()]
    ends = (ends - 1).tolist()
    k = min(words, len(tokens))
    hashed = np.fromiter((xxh64_intdigest(joined[a:b], seed) for a, b in zip(begins, ends[k - 1 :])), np.uint64)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashed), 1 << 16):
        part = hashed[i : i + (1 << 16)]
        ones += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (ones * 2 > len(hashed)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, name, fp): fp BIGINT holds the fingerprint's 64 bits, name the MD5 of the text. A null or blank text has fingerprint zero."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.empty(batch.num_rows, np.uint64)
            for rows, data, starts in common.text_chunks(batch, "text"):
                raw = data.tobytes()
                for i in range(rows.start, rows.stop):
                    out[i] = fingerprint(raw[starts[i - rows.start] : starts[i - rows.start + 1]], shingle_words)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(out.view(np.int64))], ["doc_id", "name", "fp"])

    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), common.text_name(text).alias("name"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(common.lean(work), "doc_id BIGINT, name BINARY, fp BIGINT")


def keys(distinct: DataFrame) -> DataFrame:
    """(k, fp): the Golay keys of each fingerprint."""
    near = nearby_codewords()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = common.longs(batch, "fp").view(np.uint64)
            part = [(fp >> np.uint64(16 * s) & np.uint64(0xFFFF)).astype(np.int64) for s in range(4)]
            for s in range(4):
                code = near[part[(s + 1) % 4]].astype(np.int64)
                key = (np.int64(s) << 28) | (part[s][:, None] << 12) | code
                ok = code >= 0
                yield pa.RecordBatch.from_arrays([pa.array(key[ok]), pa.array(np.broadcast_to(fp.view(np.int64)[:, None], code.shape)[ok])], ["k", "fp"])

    return distinct.select("fp").mapInArrow(common.lean(work), "k BIGINT, fp BIGINT")


def forest(left: np.ndarray, right: np.ndarray | None, most_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (a, b) that connect what the links within ``left`` (or between it and ``right``) connect; never all pairs."""
    nodes = left if right is None else np.concatenate([left, right])
    label = np.arange(len(nodes))
    split = 0 if right is None else len(left)
    while True:
        low = label.copy()
        for i in range(0, len(left), 512):
            rows = slice(i, min(i + 512, len(left)))
            near = np.bitwise_count(left[rows, None] ^ nodes[split:][None, :]) <= most_bits
            across = np.where(near, label[split:][None, :], len(nodes)).min(axis=1, initial=len(nodes))
            low[rows] = np.minimum(low[rows], across)
            if right is not None:
                back = np.where(near, label[rows, None], len(nodes)).min(axis=0, initial=len(nodes))
                low[split:] = np.minimum(low[split:], back)
        # a label is the index of a node of the same component, so following it twice stays inside
        np.minimum.at(low, label, low.copy())
        low = low[low]
        if (low == label).all():
            away = np.flatnonzero(label != np.arange(len(nodes)))
            return nodes[away], nodes[label[away]]
        label = low


def links(keyed: DataFrame, parts: int, most_bits: int = MOST_BITS, run_rows: int = RUN_ROWS) -> DataFrame:
    """(a, b): links among fingerprints that share a key, enough to connect what all of them connect."""

    def runs_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted (k, fp) rows in; edges out, and of runs beyond ``run_rows`` the rows themselves, by tile."""
        key, held, tile = None, np.empty(0, np.uint64), 0

        def emit(kind, k, a, b):
            n = len(a)
            k = np.full(n, k, np.int64) if np.isscalar(k) else k
            return pa.RecordBatch.from_arrays([pa.array(np.full(n, kind, np.int32)), pa.array(k), pa.array(np.asarray(a).view(np.int64)), pa.array(np.asarray(b).view(np.int64))], ["tile", "k", "a", "b"])

        def close():
            if tile:
                return [emit(tile, key, held, held)]
            a, b = forest(held, None, most_bits)
            return [emit(0, key, a, b)] if len(a) else []

        for batch in batches:
            ks, fps = common.longs(batch, "k"), common.longs(batch, "fp").view(np.uint64)
            at = common.runs(ks)
            to = np.append(at[1:], len(ks))
            first = True
            done = []
            if key is not None and len(ks) and ks[0] != key:
                done += close()
                key, held, tile = None, held[:0], 0
            # runs of two that end inside the batch, all at once
            pair = np.flatnonzero((to - at == 2) & (to < len(ks)) & (at > 0))
            x, y = fps[at[pair]], fps[at[pair] + 1]
            near = np.bitwise_count(x ^ y) <= most_bits
            done.append(emit(0, ks[at[pair]][near], x[near], y[near]))
            single = np.flatnonzero(((to - at > 2) & (at > 0)) | (at == 0) | (to == len(ks)))
            for i in single:
                a, b = at[i], to[i]
                if key is not None and (not first or ks[a] != key):
                    done += close()
                    key, held, tile = None, held[:0], 0
                first = False
                key = int(ks[a])
                held = np.concatenate([held, fps[a:b]])
                while len(held) > run_rows:
                    tile += 1
                    done.append(emit(tile, key, held[:run_rows], held[:run_rows]))
                    held = held[run_rows:]
                if tile and b < len(ks):
                    tile += 1
            yield from done
        if key is not None:
            if tile:
                tile += 1
            yield from close()

    schema = "tile INT, k BIGINT, a BIGINT, b BIGINT"
    found = common.settled(keyed.repartition(parts, "k").sortWithinPartitions("k").mapInArrow(common.lean(runs_of), schema))
    near = found.filter("tile = 0").select("a", "b")
    tiles = found.filter("tile > 0").select("k", "tile", F.col("a").alias("fp"))
    if not tiles.take(1):
        return near

    def tile_pair(table: pa.Table) -> pa.Table:
        fp = table.column("fp").to_numpy().view(np.uint64)
        side = table.column("side").to_numpy()
        a, b = forest(fp[side == 0], fp[side == 1] if (side == 1).any() else None, most_bits)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    several = tiles.groupBy("k").agg(F.max("tile").alias("n"))
    met = (
        tiles.join(several, "k")
        .withColumn("other", F.explode(F.sequence(F.lit(1), F.col("n"))))
        .select("k", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"), (F.col("tile") > F.col("other")).cast("int").alias("side"), "fp")
    )
    return near.union(met.groupBy("k", "i", "j").applyInArrow(tile_pair, "a BIGINT, b BIGINT"))


def simhash_groups(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, most_bits: int = MOST_BITS, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row.

    fingerprint: 16 hex digits. component_id: the smallest id reachable over links of at most ``most_bits``
    (up to three) differing bits, the row's own included. Null and blank texts have fingerprint zero and link
    like any other. Repeated rows each give a row. Rows with a null id keep it and count only when a component
    has no other id (component_id is then null). Other columns are ignored. An empty table gives no rows.
    """
    marked = common.settled(fingerprints(docs, shingle_words, key, text).drop("name"))
    named = roots(marked, most_bits)
    lowest = named.groupBy("root").agg(F.min("low.doc_id").alias("component_id"))
    by_fp = named.join(lowest, "root").select("fp", "component_id")
    return marked.join(by_fp, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def roots(marked: DataFrame, most_bits: int) -> DataFrame:
    """(fp, low, root) of every distinct fingerprint: its first row (rows without an id last) and what names its component."""
    if not 0 <= most_bits <= 3:
        raise ValueError("the keys are complete for at most three differing bits")
    if "name" in marked.columns:
        first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("name")))
    else:  # a plain number is summed without sorting
        first = F.struct(F.min("doc_id").alias("doc_id"))
    distinct = common.settled(marked.groupBy("fp").agg(first.alias("low")))
    parts = int(marked.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rooted = common.components(links(keys(distinct), parts, most_bits))
    return distinct.join(rooted.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def keep_first(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, most_bits: int = MOST_BITS) -> DataFrame:
    """One row of ``docs`` for each component: the first by id (null ids last), then by the MD5 of the text.

    Of rows that repeat both, one stays, the first by the hash of all its columns.
    """
    marked = common.settled(fingerprints(docs, shingle_words))
    heads = roots(marked, most_bits).groupBy("root").agg(F.min("low").alias("head")).select("head.doc_id", "head.name")
    heads = common.settled(heads.select(F.col("doc_id").alias("__id"), F.col("name").alias("__name")))
    same = F.col("doc_id").cast("bigint").eqNullSafe(F.col("__id")) & (common.text_name("text") == F.col("__name"))
    kept = docs.join(heads, same, "left_semi")
    again = marked.groupBy("doc_id", "name").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    if not again.take(1):
        return kept
    place = F.row_number().over(Window.partitionBy("doc_id", common.text_name("text")).orderBy(F.xxhash64(*docs.columns)))
    return kept.withColumn("__place", place).filter("__place = 1").drop("__place")
