"""Exact removal of repeated byte strings by bucket-pointer refinement over sampled suffixes.

Every suffix has a bucket: the name of its first q bytes, q being half the string length. Refining a bucket
means sorting it on the bucket names of later offsets: the name of a doubled prefix is the pair of the names
at the offset and at half its length further on, and refined names serve the next refinement. Names are
hashes of content (64 bits to deal by, 48 more inside a bucket), so every task derives the same ones and no
global ranking is needed.

Sorting all suffixes would move many times the text. Of each window of ``length`` bytes only the suffix with
the smallest q-gram name stands for it (the last one on a tie); which one depends on the window's bytes
alone, so equal windows are stood for by equal suffixes. About one suffix in 26 is left at 100 bytes. Its
territory is the windows it stands for.

1. Suffixes are dealt by their q-gram bucket and sorted on the name of their territory, then position. In a
   bucket, later members of the same territory name are repeats as a whole. A first member whose bucket holds
   no other name is settled: none of its windows occurs elsewhere.
2. Windows of first members in a bucket with several names are refined one by one: dealt by the bucket of
   their first q bytes, sorted on the bucket of the next ones. All but the first of equal ones are repeats.
3. Repeats come back to their document, are united and cut out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorepipe.llm import common

LENGTH = 100
LEAST_LENGTH, MOST_LENGTH = 8, 1 << 15
CHUNK = 1 << 18
"""Bytes of text whose buckets are named at once; its arrays fit a core's cache."""


def byte_names() -> np.ndarray:
    """A fixed random 64-bit word for each byte value."""
    return common.mix(np.arange(1, 257, dtype=np.uint64) * common.GOLDEN)


class Powers:
    """Powers of the hash base and of its inverse, kept for the chunks of a task."""

    BASE = 0x9E3779B97F4A7C15

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)
        self.names = byte_names()

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up = np.full(n, self.BASE, np.uint64)
            self.down = np.full(n, pow(self.BASE, -1, 1 << 64), np.uint64)
            self.up[0] = self.down[0] = 1
            np.multiply.accumulate(self.up, out=self.up)
            np.multiply.accumulate(self.down, out=self.down)
        return self.up[:n], self.down[:n]


class Buckets:
    """Bucket names of the suffixes of a chunk, and which suffix stands for each window."""

    def __init__(self, data: np.ndarray, length: int, powers: Powers):
        self.length = length
        self.q = (length + 1) // 2
        first = (self.q + 1) // 2
        n = len(data)
        if n < length:
            self.gram = np.empty(0, np.uint64)
            return
        up, down = powers(n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(powers.names[data] * up[:-1], out=total[1:])
        short = common.mix((total[first:] - total[: n + 1 - first]) * down[: n + 1 - first])
        step = self.q - first
        self.gram = common.paired(short[: n - self.q + 1], short[step : step + n - self.q + 1])

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """Both bucket names of every window: of its first and of its last q bytes."""
        n = max(0, len(self.gram) - (self.length - self.q))
        return self.gram[:n], self.gram[self.length - self.q :]

    def stand_ins(self) -> np.ndarray:
        """For each window the suffix in it with the smallest q-gram name, the last of equal ones."""
        value, place = self.gram, np.arange(len(self.gram), dtype=np.int32)
        want, width = self.length - self.q + 1, 1
        while width < want:
            step = min(width, want - width)
            right = value[step:] <= value[:-step]
            place = np.where(right, place[step:], place[:-step])
            value = np.minimum(value[step:], value[:-step])
            width += step
        return place


def pieces(batch: pa.RecordBatch, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, starts, ids, offset of each text's first byte): whole texts, or overlapping stretches of a very long one."""
    ids = common.longs(batch, "doc_id")
    for rows, data, starts in common.text_chunks(batch, "text", CHUNK):
        if len(starts) == 2 and len(data) > 2 * CHUNK:
            for at in range(0, len(data) - length + 1, CHUNK):
                part = data[at : at + CHUNK + length - 1]
                yield part, np.array([0, len(part)]), ids[rows], np.array([at])
        else:
            yield data, starts, ids[rows], np.zeros(len(starts) - 1, np.int64)


def territories(data: np.ndarray, starts: np.ndarray, length: int, powers: Powers):
    """(q-gram name, territory name, text index, first window, windows) of each standing suffix of a chunk."""
    b = Buckets(data, length, powers)
    first, last = b.windows()
    if not len(first):
        e = np.empty(0, np.int64)
        return e.view(np.uint64), e.view(np.uint64), e, e, e
    owner = np.repeat(np.arange(len(starts) - 1, dtype=np.int32), np.diff(starts))
    window = np.flatnonzero(owner[: len(first)] == owner[length - 1 :])
    stand = b.stand_ins()[window]
    begin = common.runs(stand)
    end = np.append(begin[1:], len(stand)) - 1
    low, high, at = window[begin], window[end], stand[begin]
    span = (high - low).astype(np.uint64) << np.uint64(16) | (at - low).astype(np.uint64)
    name = common.paired(common.paired(common.paired(first[low], last[low]), common.paired(first[high], last[high])), span)
    text = owner[low].astype(np.int64)
    return b.gram[at], name, text, low - starts[text], high - low + 1


def earlier(*names: np.ndarray, doc: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Within a chunk: rows that open their class of equal names, and rows that repeat an earlier position."""
    order = np.lexsort((code, doc, *names[::-1]))
    fresh = np.ones(len(order), bool)
    if len(order):
        fresh[1:] = np.logical_or.reduce([n[order[1:]] != n[order[:-1]] for n in names])
    head = order[np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0))]
    repeat = (doc[order] != doc[head]) | (code[order] != code[head])
    return order[fresh], order[repeat]


#: Rows that travel: names a to deal and b to sort by, doc, and code = first window * 65,536 + windows.
#: A range already known as repeated travels along as code = -1 - first window, b = end, a = any name.
#: b comes first and has zeros below, next to the row's own leading zeros: that shortens compressed rows.
ROWS = "b BIGINT, a BIGINT, doc BIGINT, code BIGINT"
NAME_BITS = ~np.uint64(0xFFFF)


def row_batch(a, b, doc, code) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(x).view(np.int64)) for x in (b, a, doc, code)], ["b", "a", "doc", "code"])


def range_batch(doc: np.ndarray, low: np.ndarray, high: np.ndarray) -> pa.RecordBatch:
    doc, low, high = common.merged_ranges(doc, low, high)
    return row_batch(common.mix(np.ascontiguousarray(doc).view(np.uint64) ^ low.view(np.uint64)), high, doc, -1 - low)


def sampled(docs: DataFrame, length: int) -> DataFrame:
    """Standing suffixes of all documents, those that repeat within a chunk already told apart."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            for data, starts, ids, offset in pieces(batch, length):
                gram, name, text, low, n = territories(data, starts, length, powers)
                doc, low = ids[text], low + offset[text]
                code = low << 16 | n
                keep, repeat = earlier(gram, name, doc=doc, code=code)
                yield row_batch(gram[keep], name[keep] & NAME_BITS, doc[keep], code[keep])
                if len(repeat):
                    yield range_batch(doc[repeat], low[repeat], low[repeat] + n[repeat])

    return docs.mapInArrow(common.lean(work), ROWS)


def refined(rows: DataFrame, parts: int, settle: bool) -> DataFrame:
    """Sort the buckets; (doc, code) of repeated ranges and, while not settled, of what is still open.

    With ``settle`` a first member is final. Without it, the first member of each of several names in one
    bucket stays open and leaves as a row with code >= 0.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # the newest first member: a, b, doc, code, whether its bucket has another one before it
        for batch in batches:
            a, b, doc, code = (common.longs(batch, c) for c in ("a", "b", "doc", "code"))
            known = code < 0
            ranges = [(doc[known], -1 - code[known], b[known])]
            a, b, doc, code = (x[~known] for x in (a, b, doc, code))
            if last is not None:
                a, b, doc, code = (np.concatenate([[v], x]) for v, x in zip(last, (a, b, doc, code)))
            if len(a):
                bucket = np.concatenate([[True], a[1:] != a[:-1]])
                fresh = bucket | np.concatenate([[True], b[1:] != b[:-1]])
                at = np.flatnonzero(fresh)
                head = at[np.cumsum(fresh) - 1]
                repeat = (doc != doc[head]) | (code != code[head])
                low = code >> 16
                ranges.append((doc[repeat], low[repeat], low[repeat] + (code[repeat] & 0xFFFF)))
                if not settle:
                    same = a[at[1:]] == a[at[:-1]]
                    open_ = np.zeros(len(at), bool)
                    open_[1:] |= same
                    open_[:-1] |= same
                    if last is not None and last[4]:
                        open_[0] = True
                    out = at[:-1][open_[:-1]]  # the newest one waits for the next batch
                    if len(out):
                        yield pa.RecordBatch.from_arrays([pa.array(doc[out]), pa.array(code[out]), pa.array(np.zeros(len(out), np.int64))], ["doc", "code", "end"])
                    before = bool(open_[-1])
                else:
                    before = False
                last = (a[at[-1]], b[at[-1]], doc[at[-1]], code[at[-1]], before)
            d, lo, hi = common.merged_ranges(*(np.concatenate(x) for x in zip(*ranges)))
            yield pa.RecordBatch.from_arrays([pa.array(d), pa.array(-1 - lo), pa.array(hi)], ["doc", "code", "end"])
        if last is not None and last[4]:
            yield pa.RecordBatch.from_arrays([pa.array(x[None] if hasattr(x, "shape") else [x], pa.int64()) for x in (last[2], last[3], 0)], ["doc", "code", "end"])

    return rows.repartition(parts, "a").sortWithinPartitions("a", "b", "doc", "code").mapInArrow(common.lean(work), "doc BIGINT, code BIGINT, end BIGINT")


def packed(docs: DataFrame) -> DataFrame:
    """Texts compressed for their way through a shuffle; a column ``rest`` goes along as it is."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        squeeze = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for rows, data, starts in common.text_chunks(batch, "text"):
                raw = data.tobytes()
                z = [squeeze.compress(raw[i:j]) for i, j in zip(starts[:-1], starts[1:])]
                own = [pa.array(common.longs(batch, "doc_id")[rows]), pa.array(z, pa.binary())]
                more = [batch.column(i)[rows] for i, n in enumerate(batch.schema.names) if n == "rest"]
                yield pa.RecordBatch.from_arrays([*own, *more], ["doc_id", "z", "rest"][: 2 + len(more)])

    more = "".join(f", rest {kind}" for name, kind in docs.dtypes if name == "rest")
    # the filter keeps every row; an inner join would add it, and both uses must look alike to share a shuffle
    return docs.mapInArrow(common.lean(work), f"doc_id BIGINT, z BINARY{more}").filter("doc_id IS NOT NULL")


def unpacked(batch: pa.RecordBatch, squeezed) -> Iterator[tuple[int, bytes, np.ndarray]]:
    marks = batch.column(batch.schema.get_field_index("marks"))
    for doc, z, found in zip(common.longs(batch, "doc_id").tolist(), batch.column(batch.schema.get_field_index("z")), marks):
        pairs = np.zeros((0, 2), np.int64)
        if found.is_valid:
            pairs = np.stack([x.to_numpy() for x in found.values.flatten()], axis=1)
        yield doc, squeezed.decompress(z.as_py()), pairs


def by_document(marks: DataFrame) -> DataFrame:
    return marks.groupBy("doc").agg(F.collect_list(F.struct("code", "end")).alias("marks")).withColumnRenamed("doc", "doc_id")


def open_windows(texts: DataFrame, marks: DataFrame, length: int) -> DataFrame:
    """Every window of the ranges that are still open, with both its bucket names; known ranges travel along."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        powers, squeezed = Powers(), zstandard.ZstdDecompressor()
        for batch in batches:
            for doc, text, pairs in unpacked(batch, squeezed):
                known = pairs[pairs[:, 0] < 0]
                if len(known):
                    yield range_batch(np.full(len(known), doc), -1 - known[:, 0], known[:, 1])
                todo = pairs[pairs[:, 0] >= 0][:, 0]
                _, low, high = common.merged_ranges(np.zeros(len(todo), np.int64), todo >> 16, (todo >> 16) + (todo & 0xFFFF))
                data = np.frombuffer(text, np.uint8)
                for at in range(0, len(data) - length + 1, CHUNK):
                    inside = (low < at + CHUNK) & (high > at)
                    if not inside.any():
                        continue
                    first, last = Buckets(data[at : at + CHUNK + length - 1], length, powers).windows()
                    p = np.concatenate([np.arange(max(i, at), min(j, at + CHUNK)) for i, j in zip(low[inside], high[inside])])
                    yield row_batch(first[p - at], last[p - at] & NAME_BITS, np.full(len(p), doc), p << 16 | 1)

    return texts.join(by_document(marks).hint("shuffle_hash"), "doc_id").mapInArrow(common.lean(work), ROWS)


def without(text: bytes, pairs: np.ndarray, length: int) -> tuple[bytes, int]:
    """(what is left of a text, removed runs), given its ranges of repeated window starts."""
    _, low, high = common.merged_ranges(np.zeros(len(pairs), np.int64), -1 - pairs[:, 0], pairs[:, 1] + length - 1)
    keep, at = [], 0
    for i, j in zip(low.tolist(), high.tolist()):
        keep.append(text[at:i])
        at = j
    return b"".join([*keep, text[at:]]), len(low)


def cut(texts: DataFrame, marks: DataFrame, length: int) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        squeezed = zstandard.ZstdDecompressor()
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            ids = batch.column(batch.schema.get_field_index("rest")).field("__id").to_pylist()
            for doc, (_, text, pairs) in zip(ids, unpacked(batch, squeezed)):
                kept, spans = without(text, pairs, length)
                for column, value in zip(out, (doc, len(text), len(text) - len(kept), spans, hashlib.sha256(kept).hexdigest())):
                    column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    schema = "doc_id BIGINT, n_bytes BIGINT, n_removed BIGINT, n_spans BIGINT, kept_sha256 STRING"
    return texts.join(by_document(marks).hint("shuffle_hash"), "doc_id", "left").mapInArrow(common.lean(work), schema)


def repeated_spans(plain: DataFrame, texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc, code, end): ranges [-1 - code, end) of window starts whose ``length`` bytes also start earlier.

    ``texts`` are the packed texts of ``plain``; one frame for this and for the cutting, so that Spark shuffles it once.
    """
    if not LEAST_LENGTH <= length <= MOST_LENGTH:
        raise ValueError(f"length must lie between {LEAST_LENGTH} and {MOST_LENGTH}")
    parts = int(plain.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    first = refined(sampled(plain, length), parts, settle=False)
    return refined(open_windows(texts, first, length), parts, settle=True)


LOWEST = int(np.iinfo(np.int64).min)


def with_names(rows: DataFrame) -> DataFrame:
    """``rows`` (doc_id, text and more) with a doc_id that names one text, in the order of the ids and of MD5 of the texts.

    Ids that are all different name their texts already. Otherwise every distinct pair of id and text gets its number
    in a sort by both, and the texts are written with it once.
    """
    if not rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").take(1):
        return rows
    pair = rows.select("doc_id", common.text_name("text").alias("name")).distinct().orderBy("doc_id", "name")
    numbers = common.settled(pair.withColumn("number", F.monotonically_increasing_id()))
    kept = [c for c in rows.columns if c != "doc_id"]
    named = rows.withColumn("name", common.text_name("text")).join(numbers, ["doc_id", "name"])
    return common.settled(named.select(F.col("number").alias("doc_id"), *kept))


def plain_texts(docs: DataFrame, key: str, text: str, rest: list[str] = ()) -> DataFrame:
    """(doc_id, text, rest): a null id comes first, a null text is empty; ``rest`` holds other columns and the id itself."""
    own = F.col(key).cast("bigint")
    more = F.struct(own.alias("__id"), *[F.col(c) for c in rest]).alias("rest")
    return with_names(docs.select(F.coalesce(own, F.lit(LOWEST)).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"), more))


def remove_repeats(docs: DataFrame, length: int = LENGTH, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row; ``cleaned`` gives the texts themselves.

    Texts are judged as UTF-8 bytes. A byte goes when a string of ``length`` bytes that covers it also starts
    earlier: in a document with a smaller id, or earlier in the same one. Matches end at the end of a document;
    strings are judged on the input. Null texts are empty. Rows that repeat an id with the same text are one
    document and give the same result each; rows of one id with different texts are documents of their own, in
    the order of the MD5 of their texts. A null id sorts before all others and comes back null. Texts of any
    length are taken whole, in chunks. Extra columns are ignored. An empty table gives no rows.
    """
    rows = plain_texts(docs, key, text)
    plain = rows.select("doc_id", "text")
    texts = packed(rows)
    return cut(texts, repeated_spans(plain, texts, length), length)


def cleaned(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with the bytes that ``remove_repeats`` names cut from the text, all other columns as they were.

    A cut can leave part of a character, since strings are bytes; such parts are dropped. n_chars, where there
    is such a column, is counted anew. A null text comes back empty.
    """
    others = [c for c in docs.columns if c != "text"]
    wide = plain_texts(docs, "doc_id", "text", others)
    plain = wide.select("doc_id", "text")
    texts = packed(wide)
    marks = by_document(repeated_spans(plain, texts, length))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        squeezed = zstandard.ZstdDecompressor()
        for batch in batches:
            left = [without(text, pairs, length)[0].decode("utf-8", "ignore") for _, text, pairs in unpacked(batch, squeezed)]
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("rest")), pa.array(left, pa.string())], ["rest", "text"])

    kind = dict(wide.dtypes)["rest"]
    fixed = texts.join(marks.hint("shuffle_hash"), "doc_id", "left").mapInArrow(common.lean(work), f"rest {kind}, text STRING")
    columns = {c: F.col("rest")[c] for c in others} | {"text": F.col("text")}
    if "n_chars" in columns:
        columns["n_chars"] = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return fixed.select(*[columns[c].alias(c) for c in docs.columns])
