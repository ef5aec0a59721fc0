"""Nearest neighbours, collocations and the filter audit against brute force and SQL, and on awkward input."""

import collections
import itertools
import math
import re

import numpy as np
import pytest

from scorepipe.llm import audit, collocations, polytope
from scorepipe.llm.queries import ORACLES, QUERIES
from oracle import canonical, duck

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op12_collocations", "op13_filter_audit"])
def test_sql(spark, name):
    ours = QUERIES[name](spark, SMALL)
    result = duck(SMALL).execute(ORACLES[name])
    names = [c[0] for c in result.description]
    rows = [tuple(r) for r in ours.collect()]
    assert rows and canonical(rows, ours.columns) == canonical(result.fetchall(), names)


# filter audit

DOCS = "doc_id BIGINT, text STRING, lang STRING, part STRING, failed INT, digest STRING"


def audited(spark, rows, labels=()):
    docs = spark.createDataFrame([(i, t, lang, "p", 3, "d") for i, t, lang in rows], DOCS).repartition(3)
    marks = spark.createDataFrame(list(labels), "doc_id BIGINT, quality INT, toxic INT")
    return audit.filter_audit(docs, marks)


def brute_audit(rows, labels):
    out = {}
    good, toxic = ({i for i, *x in labels if i is not None and x[at] == 1} for at in (0, 1))
    low = -(1 << 63)
    failed = []
    for i, t, lang in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        own = {f for f, no in zip("ABCD", (
            len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), re.search("[#$%&*|]", t),
        )) if no}
        if any((u or "") == t and (low if j is None else j) < (low if i is None else i) for j, u, _ in rows):
            own.add("E")
        failed.append((lang or "", own, i in good, i in toxic))
    for part in {f[0] for f in failed}:
        mine = [f for f in failed if f[0] == part]
        removed_by = collections.Counter()
        for order in itertools.permutations("ABCDE"):
            for step, f in enumerate(order, 1):
                before = set(order[: step - 1])
                here = [x for x in mine if f in x[1] and not x[1] & before]
                removed_by[f] += len(here)
                out[part, "".join(order), step] = [
                    sum(not x[1] & (before | {f}) for x in mine), len(here), sum(f in x[1] and bool(x[1] & before) for x in mine),
                    sum(x[1] == {f} for x in mine), sum(x[2] for x in here), sum(x[3] for x in here), f,
                ]
        for key in out:
            if key[0] == part:
                out[key][-1] = removed_by[key[1][key[2] - 1]]
    return out


def test_audit_counts_as_brute_force_does(spark):
    rng = np.random.default_rng(5)
    words = ["w%d" % i for i in range(300)]
    plain = [" ".join(rng.choice(words, n)) for n in (250, 250, 400, 199, 200, 201)]
    texts = [
        *plain, "same " * 250, plain[0], plain[0], plain[0].upper(), plain[1] + " 5 % off", None, "", "", "É" * 40 + "A", "A\x0bB\x1cC " + plain[2],
        "a b " * 210, "\n\t " + plain[3] + " x | y",
    ]
    langs = ["en", None, "", "de"]
    rows = [(i if i % 7 else None, t, langs[i % 4]) for i, t in enumerate(texts)]
    rows += [(9, texts[9], "en"), (9, texts[9], "en"), (9, "another text", "en"), (3, texts[9], "fr")]
    labels = [(1, 1, 0), (1, 0, 1), (2, None, 1), (9, 1, None), (None, 1, 1), (77, 1, 1), *[(i, i % 2, i % 3 == 0) for i in range(10, 16)]]
    labels = [(i, q, None if t is None else int(t)) for i, q, t in labels]
    found = audited(spark, rows, labels).collect()
    columns = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    ours = {(r["part"], r["filter_order"], r["step"]): [r[c] for c in columns] for r in found}
    assert len(found) == len(ours) and ours == brute_audit(rows, labels)
    for part in ("", "en"):
        n = sum((r[2] or "") == part for r in rows)
        assert all(r["kept"] + sum(x["removed"] for x in found if (x["part"], x["filter_order"]) == (part, r["filter_order"]) and x["step"] <= r["step"]) == n
                   for r in found if r["part"] == part and r["filter_order"] in ("ABCDE", "EDCBA"))


def test_audit_of_nothing_and_one_long_text(spark):
    assert audited(spark, []).count() == 0
    row = audited(spark, [(1, "word " * 300_000, "en")], [(1, 1, 1)]).filter("filter_order = 'ABCDE' AND step = 2").first()
    assert (row["kept"], row["removed"], row["good_lost"], row["toxic_lost"], row["shapley"]) == (0, 1, 1, 1, 120)


def test_positional_counts_add_bits():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 3, 4, 10, 1000, 4097):
        words = rng.integers(0, 1 << 32, n, dtype=np.uint32)
        assert audit.positional_counts(words).tolist() == [int((words >> np.uint32(b) & 1).sum()) for b in range(32)]
    table = audit.truth_table()
    assert all((int(table[f]) >> s & 1) == (f & s == 0) for f in range(32) for s in range(32))


# collocations

CORPUS = "doc_id BIGINT, text STRING, lang STRING, phrase STRING, n INT, words INT, prefix STRING"


def corpus(spark, rows):
    return spark.createDataFrame([(i, t, lang, "x", 1, 2, "y") for i, (t, lang) in enumerate(rows)], CORPUS).repartition(3)


def brute_collocations(rows, most, least, percent, top):
    places = collections.defaultdict(collections.Counter)
    for text, lang in rows:
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, most + 1):
                places["und" if lang is None else lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = set()
    for lang, f in places.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        cand = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = collections.Counter()
        for p, a in cand.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inside[p[i : i + k]] = max(inside[p[i : i + k]], a)
        kept = []
        for p, a in cand.items():
            if 100 * inside[p] >= percent * a:
                continue
            score, _, left, right = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(kept)[:top], 1):
            out.add((lang, rank, p.decode(), -a, left, right, n, -score))
    return out


@pytest.mark.parametrize("most,least,top", [(3, 3, 20), (2, 2, 1000), (4, 3, 1000)])
def test_collocations_as_brute_force(spark, most, least, top):
    rng = np.random.default_rng(most)
    vocabulary = ["The", "of", "état", "ÉTAT", "x y", "new", "york", "a\x1cb", *("w%d" % i for i in range(40))]
    weight = np.array([30, 30, *[3] * 6, *[1] * 40], float)

    def text(n):
        words = rng.choice(vocabulary, n, p=weight / weight.sum())
        gaps = rng.choice([" ", "  ", "\t", ". ", ",", "\n", " ; ", "\x0b"], n, p=[0.7, 0.05, 0.05, 0.06, 0.04, 0.04, 0.03, 0.03])
        return "".join(w + g for w, g in zip(words, gaps))

    rows = [(text(rng.integers(1, 200)), (None, "en", "und", "", "a b")[i % 5]) for i in range(60)]
    rows += [("New York city hall", "en")] * 40 + [(None, "en"), ("", "xx"), ("...", "yy"), ("one", "zz"), ("a b", None)]
    found = collocations.collocations(corpus(spark, rows), most, least, 50, top).collect()
    assert {tuple(r) for r in found} == brute_collocations(rows, most, least, 50, top)
    assert len(found) == len({tuple(r) for r in found}) > 20


def test_collocations_join_light_phrases_by_key(spark, monkeypatch):
    rows = [("aa bb cc dd. ee ff", "en")] * 12 + [("bb cc " * 30, "en")]
    want = brute_collocations(rows, 3, 10, 50, 2000)
    for heavy in (1, 3, 10_000):  # none, some and all of the phrases are broadcast
        monkeypatch.setattr(collocations, "HEAVY", heavy)
        assert {tuple(r) for r in collocations.collocations(corpus(spark, rows)).collect()} == want


def test_collocations_of_nothing(spark):
    assert collocations.collocations(corpus(spark, [])).count() == 0
    assert collocations.collocations(corpus(spark, [(None, None), ("", "en")])).count() == 0


def test_first_of_each_in_several_rounds(spark):
    rows = [(("a", "b")[i % 20 == 0], i * 7919 % 100_003, f"n{i}") for i in range(5000)]
    df = spark.createDataFrame(rows, "g STRING, v INT, name STRING")
    from pyspark.sql import functions as F

    found = collocations.first_of_each(df, "g", [F.desc("v"), F.asc("name")], F.col("name"), 4).collect()
    for g in "ab":
        want = sorted((-v, n) for x, v, n in rows if x == g)[:4]
        assert sorted((r["rank"], r["name"]) for r in found if r["g"] == g) == [(i, n) for i, (_, n) in enumerate(want, 1)]


# nearest neighbours

VECTORS = "vec_id BIGINT, embedding ARRAY<DOUBLE>, label INT, bucket STRING, vector STRING, dim INT"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0, "b", "v", 3) for i, v in rows], VECTORS)


def brute_nearest(rows, is_query, k=10):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v and np.isfinite(np.array(v, float)).all() and any(v)]
    out = {}
    for i, v in ok:
        if is_query(i):
            best = out.setdefault(i, {})
            for j, w in ok:
                if j != i and len(w) == len(v):
                    best[j] = min(best.get(j, math.inf), float(np.sqrt(((v - w) ** 2).sum())))
    return {i: sorted((d, j) for j, d in best.items())[:k] for i, best in out.items()}


def recall(found, truth):
    got = collections.defaultdict(dict)
    for r in found:
        got[r["query_id"]][r["rank"]] = (r["score"], r["vec_id"])
    hits = 0
    for q, want in truth.items():
        mine = [got[q][rank] for rank in sorted(got[q])]
        assert mine == sorted(mine) and sorted(got[q]) == list(range(1, len(mine) + 1)) and len(mine) == len(want)
        hits += len({j for _, j in want} & {j for _, j in mine})
        scores = {j: d for d, j in want}
        assert all(math.isclose(scores[j], d, rel_tol=1e-12) for d, j in mine if j in scores)
    return hits / max(1, sum(map(len, truth.values())))


@pytest.mark.parametrize("kind", ["random", "clusters", "lengths"])
def test_recall(spark, kind):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 24))
    if kind == "clusters":
        x = x[rng.integers(0, 40, 3000)] + 0.2 * x
    if kind == "lengths":  # near by distance is not near by angle
        x *= np.exp(rng.normal(size=(3000, 1)))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    found = polytope.search(frame(spark, rows).repartition(4), polytope.F.col("vec_id") % 20 == 0).collect()
    assert recall(found, brute_nearest(rows, lambda i: i % 20 == 0)) >= 0.93


def test_copies_in_bulk_and_blocks(spark, monkeypatch):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(900, 8))
    x[100:500] = x[100]  # nearly half are copies of one vector
    x[500:700] = x[100] + 1e-6 * rng.normal(size=(200, 8))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    truth = brute_nearest(rows, lambda i: i % 10 == 0)
    monkeypatch.setattr(polytope, "BLOCK_ROWS", 16)
    monkeypatch.setattr(polytope, "BLOCK_QUERIES", 8)
    found = polytope.search(frame(spark, rows).repartition(5), polytope.F.col("vec_id") % 10 == 0, target=1.0).collect()
    assert recall(found, truth) >= 0.97
    copy = sorted((r["rank"], r["vec_id"], r["score"]) for r in found if r["query_id"] == 300)
    assert copy == [(i + 1, 100 + i, 0.0) for i in range(10)]


def test_awkward_vectors(spark):
    rows = [
        (0, [1.0, 0.0, 2.0]), (0, [1.0, 0.5, 2.0]), (1, [1.0, 0.0, 2.0]), (2, None), (3, []), (4, [0.0, 0.0, 0.0]), (5, [1.0, None, 2.0]),
        (6, [math.nan, 1.0, 1.0]), (7, [math.inf, 1.0, 1.0]), (None, [1.0, 0.0, 2.0]), (8, [1.0, 2.0]), (9, [1e150, 1e150, 0.0]), (10, [1e-200, 0.0, 0.0]),
        (100, [3.0, 4.0]), (200, [5.0]), (300, [0.0, 0.0]), (400, [1.0, 0.0, 2.5]),
    ]
    found = polytope.search(frame(spark, rows), polytope.F.col("vec_id") % 100 == 0, target=1.0).collect()
    truth = brute_nearest(rows, lambda i: i % 100 == 0)
    assert recall(found, {q: w for q, w in truth.items() if w}) == 1.0
    assert {r["query_id"] for r in found} == {0, 100, 400}
    assert not {r["vec_id"] for r in found} & {2, 3, 4, 5, 6, 7, None}
    first = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in found}
    assert first[0, 1] == (1, 0.0) and first[100, 1] == (8, math.sqrt(8))
    for none in ([], [(1, [1.0])], [(100, None)], [(100, [1.0, 1.0])]):
        assert polytope.search(frame(spark, none), polytope.F.col("vec_id") % 100 == 0).count() == 0


def test_hadamard_and_probing_order():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(5, 16))
    h = np.ones((1, 1))
    while len(h) < 16:
        h = np.block([[h, h], [h, -h]])
    assert np.allclose(polytope.hadamard(x), x @ h / 4)
    tables = polytope.Tables(12, 40_000)
    assert len(tables.axes) == 2
    v = rng.normal(size=(30, 12))
    own = tables.buckets(v)
    for bound in (0.0, 0.2, 0.5):
        probed = collections.defaultdict(set)
        for table, owner, bucket in tables.probes(v, bound):
            for q, b in zip(owner, bucket):
                assert (table, b) not in probed[q]
                probed[q].add((table, b))
        for q in range(30):
            assert all((t, own[q, t]) in probed[q] for t in range(tables.tables))
            short = tables.shortfall_of(v[q], own)
            assert all((short[j] <= bound + 1e-12) >= any((t, own[j, t]) in probed[q] for t in range(tables.tables)) for j in range(30))
            assert all((short[j] <= bound - 1e-12) <= any((t, own[j, t]) in probed[q] for t in range(tables.tables)) for j in range(30))
