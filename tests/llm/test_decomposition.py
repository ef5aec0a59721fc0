"""Sums of the decomposition of op4 against a dense product, and hashes with shared powers."""

import tracemalloc

import numpy as np
import pyarrow as pa

from scorepipe.llm import common, decontaminate


def test_sums_are_those_of_a_dense_product(spark):
    """A word of every block keeps its digits: sums are in double precision, whatever the number of words."""
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice(["the"] * 40 + [f"w{i}" for i in range(60)], 4000)) for _ in range(20)] + ["", "one two"]
    docs = spark.createDataFrame([(t,) for t in texts] + [(None,)], "text STRING").coalesce(1)
    idf = (rng.random(decontaminate.FEATURES) + 1).astype(np.float32)
    right = decontaminate.random_rows(5, 3) ** 2  # all of one sign, so nothing cancels
    got = decontaminate.multiplied(docs, idf, right, back=True)
    rows = []
    for t in texts:
        raw = t.encode()
        word, text = decontaminate.hashed_words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        block, at, _ = decontaminate.blocks_of(text)
        a = np.zeros((len(at), decontaminate.FEATURES))
        np.add.at(a, (block, decontaminate.feature_of(word)), 1.0)
        square = a @ idf.astype(np.float64) ** 2
        rows.append((a * idf).T @ ((a * idf) @ right.astype(np.float64) / square[:, None]))
    want = sum(rows)
    some = want[:, 0] > 0
    assert some.sum() > 50 and not got[~some].any()
    assert np.abs(got[some] / want[some] - 1).max() < 3e-7


def test_words_have_the_same_hash_with_shared_powers():
    raw = "Some words, some more words and MORE of them".encode()
    data, starts = np.frombuffer(raw, np.uint8), np.array([0, 12, 12, len(raw)])
    for n in (3, len(raw), 500):
        for a, b in zip(decontaminate.hashed_words(data, starts), decontaminate.hashed_words(data, starts, decontaminate.powers(n))):
            assert np.array_equal(a, b)
    assert len(set(decontaminate.hashed_words(data, starts)[0].tolist())) == 6 and common.runs(np.array([1, 1, 2])).tolist() == [0, 2]


def test_short_texts_and_many_items_are_compared_in_bounded_steps(monkeypatch):
    """A chunk of one-word texts has as many passages as texts; pairs with all items at once took memory in proportion."""
    rng = np.random.default_rng(7)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = [(i, " ".join(rng.choice(vocabulary, 10))) for i in range(400)]
    latent = decontaminate.random_rows(9, 16)
    items = decontaminate.items_of(texts, latent)
    rows = [" ".join(rng.choice(vocabulary, 1)) for _ in range(15_000)]
    for at, i in ((3, 5), (7000, 399), (14_999, 0)):
        rows[at] = "before it " + texts[i][1] + " and after"
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(rows)), pa.int64()), pa.array(rows)], ["doc_id", "text"])

    class Docs:
        def mapInArrow(self, work, schema):  # noqa: N802 the name that data frames have
            return work

    def found():
        work = decontaminate.matches(Docs(), latent, items, decontaminate.COSINE, decontaminate.COPY, decontaminate.PARAPHRASE, decontaminate.ANSWER)
        tracemalloc.start()
        out = sorted(tuple(r.values()) for b in work(iter([batch])) for r in b.to_pylist())
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return out, peak / 1e6

    out, peak = found()
    assert {(3, 5), (7000, 399), (14_999, 0)} <= {r[:2] for r in out}
    assert peak < 80, peak
    monkeypatch.setattr(decontaminate, "PAIR_CELLS", 1000)  # passages reach beyond the end of a step
    few, _ = found()
    assert [(r[:3], r[4]) for r in few] == [(r[:3], r[4]) for r in out]
    assert np.abs(np.array([r[3] for r in few]) - [r[3] for r in out]).max() < 1e-5
