"""Benchmark items in documents, found by latent semantic retrieval and judged by common subsequences.

1. Words of all documents are hashed to a fixed number of features; each counts the blocks (runs of sixteen
   words) that hold it, over the whole corpus. TF-IDF follows.
2. A randomised singular value decomposition of the block matrix gives each feature a latent vector: tasks
   multiply their blocks with a random matrix and back, the driver orthogonalises a matrix of bounded size,
   tasks project once more. It is fitted on all documents. Feature vectors are brought to unit length, so that
   rare words weigh by their inverse frequency.
3. Passages are runs of blocks, for each item as many as surely hold all of it and half as many words put in. All
   passages of all documents are compared with the items, in the task that holds the text: candidates are those
   near by cosine, and all that hold as many of the item's words as the next step asks for. So no cosine, however
   small, drops a passage that would be accepted.
4. Candidates are judged on their words: the longest common subsequence with the item, and for paraphrases
   whether the answer, the item's last sentence, is there too.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorepipe.llm import common

FEATURES = 1 << 15
RANK = 64
BLOCK_WORDS = 16
CHUNK = 1 << 19
PART = 256
"""Features whose sums over all tasks are added up at a time."""
COSINE = 0.5
COPY = 0.8
PARAPHRASE = 0.5
LATENT_SHARE = 0.3
"""Common subsequence that is enough for a paraphrase whose passage is near by cosine."""
ANSWER = 0.8
STRETCH = 1.5
"""Passages hold every run of this many times the item's words, so that a text with words put in still fits."""
LEAST_WORDS = 6
"""Items with fewer words are hits only where all of them stand together."""
DENSE_CELLS = 1 << 23
PAIR_CELLS = 1 << 20
"""Passages x items that are compared at a time."""
ITEMS_AT_ONCE = 4096

LETTERS = np.ones(256, bool)
LETTERS[:128] = False
LETTERS[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
BASE = np.uint64(0x9E3779B97F4A7C15)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n of the base and of its inverse."""
    return tuple(np.multiply.accumulate(np.append(np.uint64(1), np.full(n, b, np.uint64))) for b in (BASE, np.uint64(pow(int(BASE), -1, 1 << 64))))


def hashed_words(data: np.ndarray, starts: np.ndarray, scale: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of every word in a chunk, index of its text). Words are letters, digits and non-ASCII; A-Z as a-z.

    ``scale`` are the powers of a longer chunk, so that a task raises them once.
    """
    begin, end, text = common.word_spans(data, starts, LETTERS)
    lower = np.arange(1, 257, dtype=np.uint64)
    lower[65:91] += np.uint64(32)
    up, down = scale if scale and len(scale[0]) > len(data) else powers(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(common.mix(lower)[data] * up[: len(data)], out=total[1:])
    return common.mix((total[end] - total[begin]) * down[begin]), text


def feature_of(word: np.ndarray) -> np.ndarray:
    return (word >> np.uint64(40)).astype(np.int64) & (FEATURES - 1)


def blocks_of(text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(block of each word, first word of each block, text of each block); a block never leaves its text."""
    first = common.runs(text)
    inside = np.arange(len(text)) - np.repeat(first, np.diff(np.append(first, len(text))))
    at = np.flatnonzero(inside % BLOCK_WORDS == 0)
    return np.repeat(np.arange(len(at)), np.diff(np.append(at, len(text)))), at, text[at]


def plain(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """(blocks that hold each feature, blocks) over all documents; as many numbers as there are features."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, scale = np.zeros(FEATURES + 1, np.int64), powers(CHUNK)
        for batch in batches:
            for _, data, starts in common.text_chunks(batch, "text", CHUNK):
                word, text = hashed_words(data, starts, scale)
                if len(word):
                    block, at, _ = blocks_of(text)
                    cells = np.sort(block * FEATURES + feature_of(word))
                    seen[:-1] += np.bincount(cells[common.runs(cells)] % FEATURES, minlength=FEATURES)
                    seen[-1] += len(at)
        some = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(seen[some])], ["feature", "n"])

    rows = docs.select("text").mapInArrow(common.lean(work), "feature BIGINT, n BIGINT").groupBy("feature").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(FEATURES + 1, np.int64)
    counts[rows.column("feature").to_numpy()] = rows.column("n").to_numpy()
    return counts[:-1], int(counts[-1])


def weights(counts: np.ndarray, blocks: int) -> np.ndarray:
    """Inverse block frequencies, above 0 even for a word of every block: frequency never takes an item out of the search."""
    return np.log((2 + blocks) / (1 + counts)).astype(np.float32)


def block_sums(feature: np.ndarray, block: np.ndarray, at: np.ndarray, latent: np.ndarray) -> np.ndarray:
    """Sum of the latent vectors of each block's words; the last row of ``latent`` is zero and fills up short blocks."""
    table = np.full((len(at), BLOCK_WORDS), len(latent) - 1, np.int64)
    table[block, np.arange(len(feature)) - at[block]] = feature
    table = np.ascontiguousarray(table.T)
    out = latent[table[0]]
    held = np.empty_like(out)
    for words in table[1:]:
        np.take(latent, words, axis=0, out=held, mode="clip")  # places are known to be right; without the check it writes straight to held
        out += held
    return out


def random_rows(seed: int, rank: int) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((FEATURES, rank)).astype(np.float32)


def multiplied(docs: DataFrame, idf: np.ndarray, right: np.ndarray, back: bool) -> np.ndarray:
    """Sum over tasks of A'(A right) (with ``back``) or of (A right)'(A right); A's rows are the blocks at unit length."""
    rank = right.shape[1]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, scale = np.zeros((rank, FEATURES if back else rank), np.float64), powers(CHUNK)
        padded = np.concatenate([right * idf[:, None], np.zeros((1, rank), np.float32)])
        for batch in batches:
            for _, data, starts in common.text_chunks(batch, "text", CHUNK):
                word, text = hashed_words(data, starts, scale)
                if not len(word):
                    continue
                block, at, _ = blocks_of(text)
                feature = feature_of(word)
                square = np.bincount(block, idf[feature] ** 2, len(at)).astype(np.float32)[:, None]
                product = block_sums(feature, block, at, padded)
                if back:
                    product /= square
                    sizes = np.diff(np.append(at, len(word)))
                    for total, values in zip(out, product.T.astype(np.float64)):
                        total += np.bincount(feature, np.repeat(values, sizes), FEATURES)
                else:
                    product /= np.sqrt(square)
                    out += product.T.astype(np.float64) @ product
        out = np.ascontiguousarray(out.T)
        if back:
            out *= idf[:, None]
        for i in range(0, len(out), PART):
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int64()), pa.array([out[i : i + PART].astype(np.float32).tobytes()], pa.binary())], ["part", "sums"])

    def added(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_py(), np.float32).astype(np.float64) for x in table.column("sums"))
        return pa.table({"part": table.column("part")[:1], "sums": pa.array([total.tobytes()], pa.binary())})

    # a task sends a matrix of fixed size, so there are as many tasks as the cluster keeps busy
    dealt = docs.select("text").coalesce(2 * docs.sparkSession.sparkContext.defaultParallelism)
    parts = dealt.mapInArrow(common.lean(work), "part BIGINT, sums BINARY").groupBy("part").applyInArrow(added, "part BIGINT, sums BINARY").collect()
    return np.concatenate([np.frombuffer(r["sums"]) for r in sorted(parts, key=lambda r: r["part"])]).reshape(-1, rank) if parts else np.zeros((FEATURES if back else rank, rank))


def latent_vectors(docs: DataFrame, idf: np.ndarray, rank: int = RANK) -> np.ndarray:
    """[FEATURES, rank] weighted unit vectors of the features from the leading right singular vectors of all documents.

    A feature that no document holds gets a random direction, so it still matches itself.
    """
    wide = rank + 8
    q, _ = np.linalg.qr(multiplied(docs, idf, random_rows(1, wide), back=True))
    gram = multiplied(docs, idf, q.astype(np.float32), back=False)
    values, vectors = np.linalg.eigh(gram)
    leading = np.argsort(values)[::-1][:rank]
    v = q @ vectors[:, leading]
    size = np.linalg.norm(v, axis=1, keepdims=True)
    spare = random_rows(2, rank)
    v = np.where(size > 1e-9, v / np.maximum(size, 1e-9), spare / np.linalg.norm(spare, axis=1, keepdims=True))
    return (v * idf[:, None]).astype(np.float32)


@dataclass
class Items:
    """Benchmark items of one pass: words, answers, unit latent vectors, and the passages' blocks each needs."""

    ids: list[int]
    words: list[np.ndarray]
    answers: list[np.ndarray]
    vectors: np.ndarray
    blocks: np.ndarray


def items_of(rows: list[tuple[int, str]], latent: np.ndarray) -> Items:
    ids, words, answers, vectors, blocks = [], [], [], [], []
    for item, text in rows:
        raw = (text or "").encode()
        word, _ = hashed_words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        if not len(word):
            continue
        sentences = [s for s in (text or "").replace("\n", " ").replace("?", ".").replace("!", ".").split(".") if s.strip()]
        last = sentences[-1].encode()
        answer, _ = hashed_words(np.frombuffer(last, np.uint8), np.array([0, len(last)]))
        vector = latent[feature_of(word)].sum(axis=0)
        ids.append(item)
        words.append(word)
        answers.append(answer)
        vectors.append(vector / max(float(np.linalg.norm(vector)), 1e-9))
        blocks.append(-(-int(np.ceil(STRETCH * len(word))) // BLOCK_WORDS) + 1)
    return Items(ids, words, answers, np.array(vectors, np.float32).reshape(len(ids), latent.shape[1]), np.array(blocks, np.int64))


def common_subsequence(places: dict[int, int], n: int, words: list[int]) -> int:
    """Length of the longest common subsequence with the item of n words whose word places are bit masks."""
    row = (1 << n) - 1
    full = row
    for w in words:
        match = places.get(w)
        if match:
            u = row & match
            row = ((row + u) | (row - u)) & full
    return n - row.bit_count()


def masks(words: np.ndarray) -> dict[int, int]:
    out: dict[int, int] = {}
    for i, w in enumerate(words.tolist()):
        out[w] = out.get(w, 0) | 1 << i
    return out


class Places:
    """Bit masks of the places of words in some texts; ``known`` are sorted words, the n-th of them is named n + 1."""

    def __init__(self, texts: list[np.ndarray], known: np.ndarray):
        self.sizes = np.array([len(w) for w in texts], np.int64)
        self.limbs = max(1, -(-int(self.sizes.max(initial=0)) // 64))
        self.width = len(known) + 1
        owner = np.repeat(np.arange(len(texts)), self.sizes)
        place = np.concatenate([np.arange(n) for n in self.sizes]) if len(texts) else np.empty(0, np.int64)
        cell = owner * self.width + (np.searchsorted(known, np.concatenate(texts)) + 1 if len(texts) else place)
        self.cells, at = np.unique(cell, return_inverse=True)
        self.table = np.zeros((self.limbs, len(self.cells) + 1), np.uint64)  # the last one is of words that are not there
        np.bitwise_or.at(self.table, (place >> 6, at), np.uint64(1) << (place & 63).astype(np.uint64))
        self.dense = None
        if len(texts) * self.width * self.limbs <= DENSE_CELLS:
            self.dense = np.zeros((self.limbs, len(texts) * self.width), np.uint64)
            self.dense[:, self.cells] = self.table[:, :-1]

    def of(self, cell: np.ndarray) -> list[np.ndarray]:
        if self.dense is not None:
            return [x[cell] for x in self.dense]
        at = np.minimum(np.searchsorted(self.cells, cell), len(self.cells) - 1)
        at = np.where(self.cells[at] == cell, at, len(self.cells))
        return [x[at] for x in self.table]

    def common(self, owner: np.ndarray, names: np.ndarray, low: np.ndarray, high: np.ndarray, least: np.ndarray, left: np.ndarray) -> np.ndarray:
        """``common_subsequence`` of text owner[i] with the blocks low[i] to high[i], for all i at once.

        ``names`` are the words by place in the block and block; left[block, text] are the words of the text in all
        blocks before. Where the length is below ``least`` it is given as 0: a pair ends as soon as the words
        that are still to come cannot bring it there.
        """
        out = np.zeros(len(owner), np.int64)
        for i in range(0, len(owner), 16384):
            open_ = np.arange(i, min(i + 16384, len(owner)))
            row = np.full((self.limbs, len(open_)), ~np.uint64(0))
            at = low[open_].copy()
            while len(open_):
                base = owner[open_] * self.width
                for k in range(len(names)):
                    carry = None
                    for j, match in enumerate(self.of(base + names[k][at])):
                        old = row[j]
                        hit = old & match
                        new = old + hit
                        if self.limbs > 1:
                            over = new < old
                            if carry is not None:
                                new += carry
                                over |= new < carry
                            carry = over.astype(np.uint64)
                        row[j] = new | (old ^ hit)
                at += 1
                length = np.bitwise_count(~row).sum(axis=0, dtype=np.int64)  # bits beyond the text are never matched and stay set
                own, end = owner[open_], high[open_]
                done = at >= end
                good = length + left[end, own] - left[at, own] >= least[open_]
                out[open_[done & good]] = length[done & good]
                more = good & ~done
                open_, row, at = open_[more], row[:, more], at[more]
        return out


def matches(
    docs: DataFrame, latent: np.ndarray, items: Items, cosine: float, copy: float, paraphrase: float, answer_share: float, latent_share: float = LATENT_SHARE
) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        padded, scale = np.concatenate([latent, np.zeros((1, latent.shape[1]), np.float32)]), powers(CHUNK)
        known = np.unique(np.concatenate(items.words)) if items.words else np.empty(0, np.uint64)
        hinted = np.zeros(FEATURES, bool)
        hinted[feature_of(known)] = True
        groups = []
        for size in np.unique(items.blocks):
            mine = np.flatnonzero(items.blocks == size)
            words = [items.words[i] for i in mine]
            lengths = np.array([len(w) for w in words])
            own = np.unique(np.concatenate(words))
            local = np.zeros(len(known) + 1, np.int64)  # names inside the group by names among all words
            local[np.searchsorted(known, own) + 1] = np.arange(1, len(own) + 1)
            held = np.zeros((len(own) + 1, len(mine)), np.uint8)
            for i, w in enumerate(words):
                held[np.searchsorted(own, w) + 1, i] = 1
            short = lengths < LEAST_WORDS
            least = np.where(short, lengths, np.array([[paraphrase], [latent_share]]) * lengths)  # far and near by cosine
            groups.append((size, mine, lengths, short, least, local, held, Places(words, own), Places([items.answers[i] for i in mine], own)))
        for batch in batches:
            ids = batch.column(0)
            for rows, data, starts in common.text_chunks(batch, "text", CHUNK):
                word, text = hashed_words(data, starts, scale)
                if not len(word):
                    continue
                block, at, owner = blocks_of(text)
                feature = feature_of(word)
                running = np.zeros((len(at) + 1, latent.shape[1]), np.float32)
                np.cumsum(block_sums(feature, block, at, padded), axis=0, out=running[1:])
                name = np.zeros(len(word), np.int64)
                some = np.flatnonzero(hinted[feature])
                place = np.minimum(np.searchsorted(known, word[some]), len(known) - 1)
                name[some] = np.where(known[place] == word[some], place + 1, 0)
                table = np.zeros((BLOCK_WORDS, len(at)), np.int64)
                table[np.arange(len(word)) - at[block], block] = name
                edge = np.append(at, len(word))
                begin = np.arange(len(at))
                last = np.append(common.runs(owner)[1:], len(at))  # end of each text's blocks
                stop = np.repeat(last, np.diff(np.concatenate([[0], last])))
                best: dict[tuple[int, int], tuple] = {}
                for size, mine, lengths, short, least, local, held, places, answers in groups:
                    end = np.minimum(begin + size, stop)
                    few = max(1, PAIR_CELLS // len(mine))
                    for low in range(0, len(at), few):  # short texts and many items make many pairs in a chunk
                        high = min(low + few, len(at))
                        top = end[high - 1]
                        until = end[low:high]
                        passage = running[until] - running[low:high]
                        norm = np.maximum(np.sqrt(np.einsum("ij,ij->i", passage, passage)), 1e-9)
                        near = passage @ items.vectors[mine].T
                        names = local[table[:, low:top]]
                        hits = held[names[0]]
                        for k in range(1, BLOCK_WORDS):
                            hits += held[names[k]]
                        shared = np.zeros((top - low + 1, len(mine)), np.int32)
                        np.cumsum(hits, axis=0, out=shared[1:])
                        # the cosine says how long a common subsequence must be; what shares fewer words has none
                        close = near >= (cosine * norm)[:, None]
                        until = until - low
                        ps, js = np.nonzero(shared[until] - shared[: high - low] >= np.where(close, least[1], least[0]))
                        length = places.common(js, names, ps, until[ps], least[close[ps, js].astype(int), js], shared)
                        good = np.flatnonzero(length)
                        ps, js, length = ps[good], js[good], length[good]
                        answer = answers.common(js, names, ps, until[ps], np.zeros(len(js)), shared)
                        for q in range(len(ps)):
                            p, j = low + int(ps[q]), int(js[q])
                            i, n = int(mine[j]), int(lengths[j])
                            if short[j] and not (np.lib.stride_tricks.sliding_window_view(word[edge[p] : edge[end[p]]], n) == items.words[i]).all(axis=1).any():
                                continue
                            share = int(length[q]) / n
                            answered = int(answer[q]) >= answer_share * len(items.answers[i])
                            if share < copy and not answered:
                                continue
                            key = (int(owner[p]), i)
                            best[key] = max(best.get(key, (-1.0, -1.0, False)), (share, float(near[ps[q], j] / norm[ps[q]]), bool(answered)))
                if best:
                    columns = list(zip(*((ids[rows.start + d].as_py(), items.ids[i], *v) for (d, i), v in best.items())))
                    kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.bool_())
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "item_id", "lcs_share", "cosine", "answered"])

    return docs.mapInArrow(common.lean(work), "doc_id BIGINT, item_id BIGINT, lcs_share DOUBLE, cosine DOUBLE, answered BOOLEAN")


def contaminated(
    docs: DataFrame, benchmark: DataFrame, cosine: float = COSINE, copy: float = COPY, paraphrase: float = PARAPHRASE, answer_share: float = ANSWER,
    rank: int = RANK, items_at_once: int = ITEMS_AT_ONCE, key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """(doc_id, item_id, lcs_share, cosine, answered): every document that holds a benchmark item, with the item.

    lcs_share is the share of the item's words that the best passage holds in order. A share of ``copy`` is a hit;
    below it the passage must also hold ``answer_share`` of the item's last sentence, and then a share of
    ``paraphrase`` is one, or of ``LATENT_SHARE`` where the passage is near the item by latent ``cosine``: words that
    were replaced or moved leave short common subsequences, but the passage still speaks of the same things.
    Items are taken ``items_at_once``, each part against all documents, so a task's memory does not grow with the
    benchmark. Null texts and items hold nothing; items of fewer than six words must stand there word for word.
    Repeated rows and null ids give rows of their own; extra columns are ignored; with no documents or items there are no rows.
    """
    rows = plain(docs, key, text)
    counts, blocks = document_frequencies(rows)
    latent = latent_vectors(rows, weights(counts, blocks), rank)
    bench = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"))
    parts = max(1, -(-bench.count() // items_at_once))
    out = None
    for part in range(parts):
        chosen = bench.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).orderBy("item_id", "text").collect()
        found = matches(rows, latent, items_of([(r["item_id"], r["text"]) for r in chosen], latent), cosine, copy, paraphrase, answer_share)
        out = found if out is None else out.union(found)
    return out


def without_items(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows whose text holds no benchmark item; a text is named by its 64-bit hash, whatever its id."""
    name = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    hit = contaminated(docs.select(name.alias("doc_id"), "text"), benchmark).select(F.col("doc_id").alias("__hit")).distinct()
    return docs.join(hit, name == F.col("__hit"), "left_anti")
