"""How filters interact: what each of several filters removes, in every order, from every part of the corpus.

Each document fails some of the filters. Which of the 2^5 subsets of filters it survives is a row of a truth
table: a word of 32 bits, bit s set if no filter of subset s fails. The words of a part are summed per bit by
carry-save adders: three words of one weight become their sum bits at that weight and their carry bits at twice
the weight, so whole columns of 32 counters are added by a few bitwise operations on long arrays of words. The
survivors of every subset are all that the audit needs: each order of the filters is a chain of subsets.

Nulls, repeats and other cases: a null text is the empty text; a null language is the part of the empty string.
Rows that repeat both id and text are one document twice and do not count as copies of each other; a null id is
smaller than any other. Documents without a label count as documents only; of several labels of an id, the
largest of each kind holds. An empty table gives no rows. Texts of any length are read whole, one at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from scorepipe.llm import common

FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)
KINDS = ("all", "good", "toxic")

LEAST_WORDS = 200
CONTINUATION = bytes(range(0x80, 0xC0))
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
SYMBOLS = b"#$%&*|"


def own_failures(text: bytes) -> int:
    """Filters A to D that a text fails, as bits. ``split`` on bytes cuts at \\x20 and \\x09 to \\x0D alone."""
    words = text.split()
    points = len(text) if text.isascii() else len(text.translate(None, CONTINUATION))
    capitals = len(text) - len(text.translate(None, CAPITALS))
    short = len(words) < LEAST_WORDS
    poor = 100 * len(set(words)) < 50 * len(words)
    loud = 100 * capitals > 3 * points
    odd = len(text.translate(None, SYMBOLS)) < len(text)
    return short | poor << 1 | loud << 2 | odd << 3


def truth_table() -> np.ndarray:
    """Word of surviving subsets for every set of failed filters."""
    subsets = np.arange(SUBSETS)
    return np.array([int(((subsets & failed) == 0) @ (1 << subsets.astype(np.uint64))) for failed in range(SUBSETS)], np.uint32)


def positional_counts(words: np.ndarray) -> np.ndarray:
    """How many of the words have each of the 32 bits set, by carry-save addition."""
    counts, weight, level = np.zeros(32, np.int64), 1, words.astype(np.uint32)
    bits = np.arange(32, dtype=np.uint32)
    while len(level):
        carries = [level[:0]]
        while len(level) > 2:
            third = len(level) // 3
            a, b, c = level[:third], level[third : 2 * third], level[2 * third : 3 * third]
            half = a ^ b
            carries.append((a & b) | (half & c))
            level = np.concatenate([half ^ c, level[3 * third :]])
        for word in level:
            counts += weight * ((word >> bits) & 1).astype(np.int64)
        level, weight = np.concatenate(carries), 2 * weight
    return counts


def judged(docs: DataFrame) -> DataFrame:
    """(doc_id, part, failed, digest): the filters A to D each document fails, and a digest that names its text."""
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"),
    ).select("doc_id", "part", F.sha2("text", 256).alias("digest"), "text")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            failed = pa.array([own_failures(text.as_py()) for text in batch.column(3)], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], failed], ["doc_id", "part", "digest", "failed"])

    return rows.mapInArrow(common.lean(judge), "doc_id BIGINT, part STRING, digest STRING, failed INT")


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, part, failed, good, toxic) of every document, filter E included.

    The first document of a text is found by a minimum per digest (combined in the tasks before the shuffle) and
    joined back by digest and id together, so a text that a third of all documents share meets in no task.
    """
    rows = common.settled(judged(docs))
    smallest = F.coalesce("doc_id", F.lit(-(1 << 63)))
    firsts = rows.groupBy("digest").agg(F.min(smallest).alias("first"))
    first = rows.withColumn("first", smallest).join(firsts.withColumn("kept", F.lit(True)), ["digest", "first"], "left")
    copied = first.select(
        "doc_id", "part", (F.col("failed") + F.when(F.col("kept").isNull(), 1 << 4).otherwise(0)).alias("failed"),
        F.when(F.col("doc_id").isNull(), F.xxhash64("digest")).otherwise(0).alias("spread"),  # null ids meet nowhere
    )
    known = labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    ).withColumn("spread", F.lit(0).cast("bigint"))
    return copied.join(known, ["doc_id", "spread"], "left").select(
        "doc_id", "part", "failed", (F.coalesce("good", F.lit(0)) == 1).alias("good"), (F.coalesce("toxic", F.lit(0)) == 1).alias("toxic")
    )


def survivors(failed: DataFrame) -> DataFrame:
    """(part, all, good, toxic): arrays of the documents, the good ones and the toxic ones that survive each subset of filters."""
    table = truth_table()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = pc.dictionary_encode(batch.column(0))
            at, names = parts.indices.to_numpy(), parts.dictionary
            words = table[batch.column(1).to_numpy()]
            good, toxic = (batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3))
            order = np.argsort(at, kind="stable")
            for own in np.split(order, common.runs(at[order])[1:]) if len(order) else []:
                sums = [positional_counts(x) for x in (words[own], words[own[good[own]]], words[own[toxic[own]]])]
                part = names[int(at[own[0]])]
                columns = [pa.array([part.as_py()] * SUBSETS, pa.string()), pa.array(np.arange(SUBSETS, dtype=np.int32)), *map(pa.array, sums)]
                yield pa.RecordBatch.from_arrays(columns, ["part", "subset", *KINDS])

    found = failed.select("part", "failed", "good", "toxic").mapInArrow(common.lean(count), "part STRING, subset INT, all BIGINT, good BIGINT, toxic BIGINT")
    sums = found.groupBy("part", "subset").agg(*[F.sum(k).alias(k) for k in KINDS])
    cells = F.sort_array(F.collect_list(F.struct("subset", *KINDS)))  # 32 of a part
    return sums.groupBy("part").agg(cells.alias("cells")).select("part", *[F.col(f"cells.{k}").alias(k) for k in KINDS])


def audit(counts: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, from the survivors of every subset."""
    orders = ["".join(p) for p in permutations(FILTERS)]
    steps = counts.withColumn("filter_order", F.explode(F.lit(orders))).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))

    def subset(letters):
        bits = [F.when(F.contains(letters, F.lit(f)), 1 << i).otherwise(0) for i, f in enumerate(FILTERS)]
        return sum(bits[1:], bits[0])

    def of(kind, at):
        return F.element_at(kind, at + 1)

    steps = steps.withColumn("letter", F.substring("filter_order", F.col("step"), F.lit(1))).select(
        "*", subset(F.substring("filter_order", F.lit(1), F.col("step") - 1)).alias("before"), subset(F.col("letter")).alias("own"),
    )
    after = F.col("before") + F.col("own")
    every = F.lit(SUBSETS - 1)
    out = steps.select(
        "part", "filter_order", "step", "letter", of("all", after).alias("kept"),
        *[(of(k, F.col("before")) - of(k, after)).alias(name) for k, name in (("all", "removed"), ("good", "good_lost"), ("toxic", "toxic_lost"))],
        (of("all", F.lit(0)) - of("all", F.col("own"))).alias("fails"),
        (of("all", every - F.col("own")) - of("all", every)).alias("unique_fails"),
    )
    shapley = F.sum("removed").over(Window.partitionBy("part", "letter"))  # 120 rows each
    return out.select(
        "part", "filter_order", "step", "kept", "removed", (F.col("fails") - F.col("removed")).alias("redundant"),
        "unique_fails", "good_lost", "toxic_lost", shapley.alias("shapley"),
    )


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley).

    Filters, as conditions of failure: A under 200 words; B fewer than half of the words distinct; C more than 3 %
    capitals A to Z; D a symbol of ``#$%&*|``; E the text of a document with a smaller id.
    """
    return audit(survivors(failures(docs, labels)))


_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"
_ORDERS = ", ".join(f"('{''.join(p)}')" for p in permutations(FILTERS))
AUDIT_SQL = f"""
WITH words AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
lab AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
        FROM labels GROUP BY doc_id),
fail AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         [CASE WHEN len(w) < 200 THEN 'A' END,
          CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' END,
          CASE WHEN 100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) THEN 'C' END,
          CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' END,
          CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 'E' END] AS raw
         FROM words LEFT JOIN lab USING (doc_id)),
doc AS (SELECT part, list_aggregate(list_filter(raw, lambda x: x IS NOT NULL), 'string_agg', '') AS f, good, toxic FROM fail),
kinds AS (SELECT part, coalesce(f, '') AS f, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM doc GROUP BY 1, 2),
steps AS (SELECT o AS filter_order, CAST(s AS INT) AS step, substr(o, CAST(s AS INT), 1) AS letter, left(o, CAST(s AS INT) - 1) AS earlier
          FROM (VALUES {_ORDERS}) v(o), range(1, 6) r(s)),
hits AS (SELECT part, filter_order, step, letter, n, good, toxic, contains(f, letter) AS own,
         earlier <> '' AND regexp_matches(f, '[' || earlier || '-]') AS gone, f = letter AS alone
         FROM kinds, steps),
cells AS (SELECT part, filter_order, step, letter,
          sum(CASE WHEN NOT own AND NOT gone THEN n ELSE 0 END) AS kept, sum(CASE WHEN own AND NOT gone THEN n ELSE 0 END) AS removed,
          sum(CASE WHEN own AND gone THEN n ELSE 0 END) AS redundant, sum(CASE WHEN alone THEN n ELSE 0 END) AS unique_fails,
          sum(CASE WHEN own AND NOT gone THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN own AND NOT gone THEN toxic ELSE 0 END) AS toxic_lost
          FROM hits GROUP BY ALL)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM cells"""
