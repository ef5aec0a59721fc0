"""Cases that earlier cuts of the operators missed."""

import re

import numpy as np

from scorepipe.llm import decontaminate, outliers

DOCS = "doc_id BIGINT, text STRING, lang STRING, source STRING"


def docs_of(spark, texts, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", "s") for i, t in zip(ids, texts)], DOCS)


def vocabulary(rng, n=3000):
    return ["".join(x) for x in rng.choice(list("abcdefghij"), (n, 7))]


def hits(spark, texts, items):
    bench = spark.createDataFrame(list(enumerate(items)), "item_id BIGINT, text STRING")
    return {(r["doc_id"], r["item_id"]): r for r in decontaminate.contaminated(docs_of(spark, texts), bench).collect()}


# 4


def paraphrases(rng, share, put_in):
    """(items, documents): document i holds ``share`` of item i's words in order and its last sentence, ``put_in`` words between."""
    words = vocabulary(rng)
    items, texts = [], []
    for i in range(60):
        n = (6, 15, 17, 33, 50, 70, 140)[i % 7]
        item = rng.choice(words, n).tolist()
        cut = n - 2
        lose = rng.permutation(cut)[: n - int(np.ceil(share * n))]
        kept = ["lost" + w if j in lose else w for j, w in enumerate(item)]
        for _ in range(int(put_in * n)):
            kept.insert(rng.integers(1, len(kept) - 2), "put" + str(rng.integers(1000)))
        items.append(" ".join(item[:cut]) + ". " + " ".join(item[cut:]))
        before = rng.choice(words, rng.integers(1, 200)).tolist()
        texts.append(" ".join(before + kept + rng.choice(words, 80).tolist()))
    return items, texts


def test_every_planted_paraphrase_is_found(spark):
    rng = np.random.default_rng(5)
    for share, put_in in ((0.5, 0), (0.6, 0), (0.8, 0.4), (1.0, 0.5)):
        items, texts = paraphrases(rng, share, put_in)
        got = hits(spark, texts, items)
        missed = [i for i in range(len(items)) if (i, i) not in got]
        assert not missed, (share, put_in, missed)
        for (d, i), r in got.items():  # never more than a brute-force subsequence of the whole document
            a, b = (re.findall(r"\w+", t) for t in (items[i], texts[d]))
            row = [0] * (len(a) + 1)
            for w in b:
                new = [0]
                for j, v in enumerate(a):
                    new.append(row[j] + 1 if v == w else max(row[j + 1], new[j]))
                row = new
            assert round(r["lcs_share"] * len(a)) <= row[-1]


def test_subsequences_of_many_pairs_at_once(monkeypatch):
    rng = np.random.default_rng(0)
    for cells in (0, 1 << 23):
        monkeypatch.setattr(decontaminate, "DENSE_CELLS", cells)
        texts = [rng.integers(0, 30, n).astype(np.uint64) for n in (3, 64, 65, 150)]
        known = np.unique(np.concatenate(texts))
        names = rng.integers(0, len(known) + 1, (16, 40))
        left = np.zeros((41, 4), int)
        left[1:] = np.cumsum([[(np.isin(names[:, b], np.searchsorted(known, t) + 1)).sum() for t in texts] for b in range(40)], axis=0)
        own, low = rng.integers(0, 4, 200), rng.integers(0, 30, 200)
        high = low + rng.integers(1, 11, 200)
        whole = [decontaminate.common_subsequence(decontaminate.masks(np.searchsorted(known, texts[o]) + 1), len(texts[o]), names[:, a:b].T.ravel().tolist()) for o, a, b in zip(own, low, high)]
        least = rng.integers(1, 60, 200)
        got = decontaminate.Places(texts, known).common(own, names, low, high, least, left)
        assert got.tolist() == [n if n >= k else 0 for n, k in zip(whole, least)]


def test_short_items_must_stand_together(spark):
    rng = np.random.default_rng(6)
    texts = [" ".join(rng.choice(vocabulary(rng), 40)) for _ in range(30)]
    texts[3] += " paris on the seine and more"
    texts[4] += " paris lies on the river seine"
    assert set(hits(spark, texts, ["Paris, on the Seine."])) == {(3, 0)}


def test_frequency_never_removes_an_item(spark):
    rng = np.random.default_rng(7)
    words = vocabulary(rng)
    item = " ".join(words[:20]) + ". " + " ".join(words[20:24])
    short = [" ".join(rng.choice(words, 30)) + (" " + item if i % 3 == 0 else "") for i in range(300)]
    tiny = [" ".join(rng.choice(words, 20)) + (" " + item if i in (4, 9) else "") for i in range(12)]
    for texts in (short, tiny):
        got = hits(spark, texts, [item])
        assert set(got) == {(i, 0) for i, t in enumerate(texts) if item in t}
        assert min(r["cosine"] for r in got.values()) > 0.4  # the latent search sees them too
    assert (decontaminate.weights(np.array([0, 1, 50, 100]), 100) > 0).all()


# 6


def test_small_groups_are_judged_one_level_up(spark):
    rng = np.random.default_rng(8)
    clean = [" ".join("".join(rng.choice(list("abcdefgh"), rng.integers(2, 9))) for _ in range(60)) for _ in range(120)]
    junk = " ".join(f"{w}###$$" for w in clean[0].split())
    rows = [(i, t, "en", "big" if i < 60 else f"s{i % 20}") for i, t in enumerate(clean)]
    rows += [(200, junk, "en", "s3"), (201, junk, "en", "alone"), (202, junk, "xx", "alone"), (203, clean[5], "xx", "alone"), (204, junk, None, None)]
    got = {r["doc_id"]: r for r in outliers.quality_rules(spark.createDataFrame(rows, DOCS)).collect()}
    assert len(got) == 125 and all(r["distance"] is not None for r in got.values())
    assert {i for i, r in got.items() if not r["kept"]} == {200, 201, 202, 204}
    only = {r["doc_id"]: r for r in outliers.quality_rules(spark.createDataFrame(rows[:60], DOCS)).collect()}
    assert all(abs(only[i]["distance"] - got[i]["distance"]) < 1e-9 for i in range(60))  # large groups are judged as before


def test_decomposition_is_that_of_all_documents(spark):
    """Ten words make at most ten directions, so the randomised decomposition is exact; a sample of rows would differ."""
    rng = np.random.default_rng(5)
    names = [f"w{i}" for i in range(10)]
    texts = [" ".join(rng.choice(names, 5, p=np.arange(1, 11) / 55)) for _ in range(12_000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING").repartition(3)
    idf = decontaminate.weights(*decontaminate.document_frequencies(docs))
    raw = " ".join(names).encode()
    own = decontaminate.feature_of(decontaminate.hashed_words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[0])
    cells = np.array([[t.split().count(n) for n in names] for t in texts]) * idf[own]
    scale = np.sqrt((np.array([[t.split().count(n) for n in names] for t in texts]) * idf[own] ** 2).sum(axis=1, keepdims=True))
    rows = cells / scale
    leading = np.linalg.eigh(rows.T @ rows)[1][:, -4:]
    leading /= np.linalg.norm(leading, axis=1, keepdims=True)
    got = decontaminate.latent_vectors(docs, idf, 4)[own] / idf[own][:, None]
    assert np.abs(got @ got.T - leading @ leading.T).max() < 1e-3
