"""Shared and null ids, and pages that once ended a query."""

import hashlib
import random
import time

import numpy as np
import pytest

from pyspark.sql import functions as F

from scorepipe.llm import common, decontaminate, licenses, outliers, pieces, render, simhash, suffix

DOCS = "doc_id BIGINT, text STRING, lang STRING, source STRING, name STRING, fp INT"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", f"r{k}", k) for k, (i, t) in enumerate(rows)], DOCS).repartition(3)


def passage(seed, n):
    return " ".join(np.random.default_rng(seed).choice(["".join(x) for x in np.random.default_rng(9).choice(list("abcdefghij"), (500, 6))], n))


# repeated strings


def brute_cut(rows, length=100):
    """What stays of each row; documents are distinct pairs of id and text, by id (null first) and MD5."""
    pairs = sorted({(-(1 << 63) if i is None else i, hashlib.md5((t or "").encode()).digest(), (t or "").encode()) for i, t in rows})
    seen, kept = set(), {}
    for i, _, text in pairs:
        gone = np.zeros(len(text), bool)
        for p in range(len(text) - length + 1):
            gram = text[p : p + length]
            if gram in seen:
                gone[p : p + length] = True
            seen.add(gram)
        kept[i, text] = bytes(np.frombuffer(text, np.uint8)[~gone]), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
    return [(i, len((t or "").encode()), *kept[-(1 << 63) if i is None else i, (t or "").encode()][1:],
             hashlib.sha256(kept[-(1 << 63) if i is None else i, (t or "").encode()][0]).hexdigest()) for i, t in rows]


def test_shared_ids_are_documents_of_their_own(spark):
    p, q = passage(1, 80), passage(2, 60)
    rows = [
        (1, p), (2, passage(3, 300) + p), (2, "short " + p[:120]), (2, passage(4, 20)), (3, p), (3, p), (3, q + " tail"),
        (None, q + " and more"), (None, passage(5, 90)), (None, q), (None, None), (7, ""), (None, passage(5, 90)), (9, passage(6, 400) + passage(5, 90)),
    ]
    found = suffix.remove_repeats(docs_of(spark, rows)).collect()
    assert sorted((tuple(r) for r in found), key=repr) == sorted(brute_cut(rows), key=repr)
    left = suffix.cleaned(docs_of(spark, rows))
    assert left.columns == [c.split()[0] for c in DOCS.split(", ")] and left.count() == len(rows)
    texts = {r["name"]: r["text"] for r in left.collect()}
    assert any(p in t for t in texts.values()) and any(q in t for t in texts.values())  # one copy of each passage stays
    assert texts["r3"] == passage(4, 20) and sum(p in t for t in texts.values()) == 1


# near duplicates


def test_one_row_of_each_component_stays(spark):
    t, u = passage(7, 60), passage(8, 60)
    rows = [(1, t), (1, t), (2, t), (3, u), (3, t), (None, t), (None, passage(9, 50)), (None, passage(9, 50)), (5, u), (4, ""), (6, None)]
    kept = simhash.keep_first(docs_of(spark, rows))
    assert kept.columns == [c.split()[0] for c in DOCS.split(", ")]
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr) == sorted([(1, t), (3, u), (None, passage(9, 50)), (4, "")], key=repr)


# benchmark items


def test_rows_go_by_their_own_text(spark):
    item = "the quick otter signs seven letters before the harbour master wakes up in the morning at nine"
    bench = spark.createDataFrame([(1, item)], "item_id BIGINT, text STRING")
    rows = [(None, passage(1, 50) + " " + item + " " + passage(2, 50)), (None, passage(3, 90)), (4, passage(4, 90)), (4, item), (5, None)]
    left = decontaminate.without_items(docs_of(spark, rows), bench).collect()
    assert sorted(r["name"] for r in left) == ["r1", "r2", "r4"]


# pages


@pytest.mark.parametrize("page,text", [
    ('<table><tr><td colspan="²">a</td><td>b</table>', "a  b"),
    ("<table><tr><td colspan=" + "1" * 5000 + ">a<td>b</table>", "a  b"),
    ("a &#" + "9" * 5000 + "; b", "a � b"),
    ('<p title="&#' + "0" * 5000 + '65;">c', "c"),
    ("&#" + "0" * 6000 + "65;z &#x" + "0" * 6000 + "42;", "Az B"),
    ("&#65 &#00000000;!", "A �!"),
    ("<table><tr><td>one<caption>cap</caption><tr><td>two</table>", "cap\none\ntwo"),
])
def test_odd_pages(page, text):
    assert render.rendered(page) == text


def test_deep_and_wide_pages_stay_linear():
    start = time.process_time()
    assert render.rendered("<div>" * 20_000 + "x") == "x"
    assert len(render.rendered("<ul><li>" * 4000 + "x")) < 100
    assert len(render.rendered("<blockquote>line" * 3000).split("\n")) >= 3000
    assert len(render.rendered("<table>" + "<tr><td colspan=1000>a<td>b" * 3000)) < 1_000_000
    assert len(render.rendered("<blockquote>line" * 3000)) < 3000 * 80
    assert time.process_time() - start < 20


def test_tag_soup_never_fails():
    rng = random.Random(1)
    tags = "p div li ul ol td tr table th head body html b span dl dd dt h1 h2 button option select blockquote caption details summary tbody".split()
    for _ in range(4000):
        parts = (f"<{rng.choice(tags)}>", f"</{rng.choice(tags)}>", "x ", "y&amp;")
        render.rendered("".join(rng.choice((f"<{rng.choice(tags)}>", f"</{rng.choice(tags)}>", *parts)) for _ in range(rng.randint(3, 60))))


# licenses


def test_labels_go_by_text_and_words(spark):
    notice = dict(licenses.TEMPLATES)["bsd"]
    other = passage(1, 40)
    rows = [(None, notice), (None, other), (9, "x y " + notice + " z"), (9, other), (9, None), (3, notice.upper() + " " + notice)]
    got = {r["name"]: r for r in docs_with_labels(spark, rows)}
    assert [got[f"r{i}"]["labels"] for i in range(6)] == ["bsd", "", "bsd", "", "", "bsd"]
    assert [got[f"r{i}"]["score"] for i in range(6)] == [1.0, 0.0, 1.0, 0.0, 0.0, 1.0]


def docs_with_labels(spark, rows):
    docs = docs_of(spark, rows)
    by_text = licenses.license_labels(docs.selectExpr("fp AS doc_id", "text")).withColumnRenamed("doc_id", "fp")
    by_id = licenses.license_labels(docs)
    assert sorted(map(repr, by_id.drop("doc_id").collect())) == sorted(map(repr, by_text.drop("fp").collect()))
    return by_text.join(docs, "fp").collect()


def test_votes_without_the_words_are_refused(spark):
    notice = dict(licenses.TEMPLATES)["bsd"].lower().replace(",", "").split()
    docs = docs_of(spark, [(1, " ".join(notice))])
    found = licenses.bands(docs).filter("label = 'bsd'")
    assert licenses.verified(found, docs).first()["coverage"] == 1.0
    # the same votes, but the text at their places is another one
    moved = docs_of(spark, [(1, " ".join(["one", *notice]))]).withColumn("old", F.lit(" ".join(notice)))
    name = found.first()["name"]
    wrong = licenses.verified(found.withColumn("name", common.text_name("label")), moved.withColumn("text", F.lit("bsd")))
    assert name is not None and wrong.first()["coverage"] == 0.0


# outliers


def test_each_statistic_rejects_by_itself(spark):
    rng = np.random.default_rng(2)
    plain = [passage(100 + i, 120) for i in range(200)]
    lines = ["\n".join(passage(500 + 9 * i + j, 12) for j in range(9)) for i in range(40)]
    odd = {
        "word_length": " ".join(w * 2 for w in plain[0].split()),
        "symbols": " ".join(w + rng.choice(["#", "$", "%"]) for w in plain[1].split()),
        "dup_lines": "\n".join([passage(900, 4)] * 1 + ["aaaaaa bbbbbb"] * 12 + ["cccccc dddddd"] * 12),
        "repeats": " ".join([passage(901, 100), passage(902, 10), passage(903, 20), passage(902, 10)]),
    }
    rows = list(enumerate([*plain, *lines, *odd.values()], 1))
    docs = docs_of(spark, rows)
    found = {r["doc_id"]: r for r in outliers.quality_rules(docs).collect()}
    only = dict(zip(odd, range(len(plain) + len(lines) + 1, len(rows) + 1)))
    for name, i in only.items():
        if name in ("dup_lines", "repeats"):  # short windows or few lines fail the base rules or stay below them
            continue
        assert not found[i]["base_failed"] and not found[i]["kept"], name
    assert sum(found[i]["kept"] for i in range(1, len(plain) + len(lines) + 1)) >= 0.97 * (len(plain) + len(lines))
    floors = np.array([floor for _, floor in outliers.RATES])
    reach = np.array([np.inf, np.inf, 1.0, np.sqrt(outliers.MOST_REPEATED / 100)])  # the largest value a sound row can have
    assert ((reach / floors) ** 2 > outliers.CUTOFF).all()


def test_quantiles_and_consistency():
    assert abs(outliers.chi_square_quantile(0.95, 4) - 9.487729) < 1e-5 and abs(outliers.CUTOFF - 18.466827) < 1e-5
    x = np.random.default_rng(3).normal(size=(200_000, 4))
    d = (x**2).sum(1)
    inner = x[d <= np.quantile(d, outliers.NEAREST)]
    assert abs(outliers.consistency(outliers.NEAREST) * inner.var() - 1) < 0.01


def test_lines_and_windows_reject(spark):
    plain = [passage(100 + i, 120).replace(" ", "\n", 8) for i in range(200)]
    many = "\n".join([passage(900, 60).replace(" ", "\n"), *["tail"] * 0])
    dup = "\n".join([*(passage(950 + j, 30) for j in range(3)), *["ab"] * 18])  # most lines repeat, few words do
    windows = " ".join([passage(904, 90), passage(905, 12), passage(906, 8), passage(905, 12)])
    rows = list(enumerate([*plain, many, dup, windows], 1))
    found = {r["doc_id"]: r for r in outliers.quality_rules(docs_of(spark, rows)).collect()}
    assert found[202]["n_dup_lines"] == 17 and not found[202]["kept"]
    assert found[203]["n_repeat_words"] == 24 and not found[203]["base_failed"] and not found[203]["kept"]


# tokens


def test_ids_outside_the_model_raise(spark):
    model = pieces.read_model()
    for ids in ([-1, 5], [10**6]):
        with pytest.raises(Exception, match="ids must lie between"):
            pieces.decode(spark.createDataFrame([(1, ids)], "doc_id BIGINT, ids ARRAY<INT>"), model).collect()
    found = pieces.decode(spark.createDataFrame([(1, None), (2, [])], "doc_id BIGINT, ids ARRAY<INT>"), model).collect()
    assert {r["doc_id"]: r["text"] for r in found} == {1: None, 2: ""}


# latent paraphrases


def moved_and_replaced(rng, n):
    """(items, documents): runs of the item's words in another order, some words replaced; the last sentence stays."""
    vocabulary = ["".join(x) for x in np.random.default_rng(11).choice(list("abcdefghijklmnop"), (4000, 6))]
    items, texts = [], []
    for _ in range(n):
        size = int(rng.choice([40, 60, 90]))
        words = rng.choice(vocabulary, size, replace=False).tolist()
        answer = rng.choice(vocabulary, 4, replace=False).tolist()
        cuts = np.array_split(np.arange(size), 4)
        moved = [words[i] for part in (cuts[2], cuts[0], cuts[3], cuts[1]) for i in part]
        moved = [w if rng.random() > 0.15 else "new" + w for w in moved]
        items.append(" ".join(words) + ". " + " ".join(answer) + ".")
        around = [" ".join(rng.choice(vocabulary, 150)) for _ in range(2)]
        texts.append(f"{around[0]} {' '.join(moved)} {' '.join(answer)} {around[1]}")
    clean = [" ".join(rng.choice(vocabulary, 300)) for _ in range(n)]
    return items, texts, clean


def test_latent_search_finds_moved_and_replaced_words(spark):
    items, texts, clean = moved_and_replaced(np.random.default_rng(12), 40)
    docs = docs_of(spark, list(enumerate([*texts, *clean])))
    bench = spark.createDataFrame(list(enumerate(items)), "item_id BIGINT, text STRING")
    found = {(r["doc_id"], r["item_id"]): r for r in decontaminate.contaminated(docs, bench).collect()}
    own = [r for (d, i), r in found.items() if d == i]
    assert len(own) >= 36 and len(found) == len(own)
    assert sum(r["lcs_share"] < decontaminate.PARAPHRASE for r in own) >= 20 and all(r["answered"] for r in own if r["lcs_share"] < decontaminate.COPY)
    exact = decontaminate.contaminated(docs, bench, cosine=9.0).count()  # without the latent path
    assert exact <= len(own) - 20
