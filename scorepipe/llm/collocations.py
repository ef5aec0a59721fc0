"""Collocations: phrases whose words stand together more often than their parts would, by language.

Top-order marginalisation. Every word starts exactly one window of the longest length; a window that its piece
cuts short is padded. Lead columns give each word its window, and only these padded windows are counted. A shorter
phrase is a prefix of the windows that start with it, so ROLLUP sums the windows' counts to those of successively
shorter prefixes, down to all words of a language. No phrase of another length is ever exploded. The windows are
shuffled once, by all their words but the last, so the sums of the next shorter prefix are known in the same tasks.
Tasks combine the windows of a few megabytes of text first, so a passage that many documents share leaves a
task once for each of its windows.

A candidate's parts are looked up in the counts. Those that hold a ten-thousandth of all words (at most 10,000 for
each length, whatever the input) are broadcast, as many candidates share them; the others meet by key.

Nulls, repeats and other cases: a null text is empty, a null language is ``und``; neither ids nor repeated rows
matter, each row counts. An empty table gives no rows. Texts of any length are read whole. Columns beside text and
lang are not read. Counts up to 10^16 are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from scorepipe.llm import common

MOST_WORDS = 3
LEAST_COUNT = 10
DROP_PERCENT = 50
TOP = 2000
HEAVY = 10_000
"""Phrases with at least one in so many of all words are broadcast: at most that many for each length."""

WINDOW_BYTES = 1 << 22
CUTS = b".,;:!?\x0a\x0b\x0c\x0d"
SPACES = b"\x20\x09"


def byte_set(members: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


def windows(docs: DataFrame, most_words: int = MOST_WORDS) -> DataFrame:
    """(prefix, last, n): padded windows; prefix holds all words but the last and the language, joined by spaces.

    Words hold no space, so the language is what follows the last of their spaces, whatever it holds itself.
    """
    is_cut, is_space = byte_set(CUTS), byte_set(SPACES)
    in_word = ~(is_cut | is_space)
    lower = np.arange(256, dtype=np.uint8)
    lower[ord("A") : ord("Z") + 1] += 32

    def counted(data: np.ndarray, starts: np.ndarray, lang: str) -> pa.RecordBatch | None:
        begin, end, text = common.word_spans(data, starts, in_word)
        if not len(begin):
            return None
        offsets = np.concatenate([[0], np.cumsum(end - begin)]).astype(np.int32)
        letters = pa.py_buffer(np.ascontiguousarray(lower[data[in_word[data]]]))
        words = pa.Array.from_buffers(pa.string(), len(begin), [None, pa.py_buffer(offsets), letters]).dictionary_encode()
        code, pad = words.indices.to_numpy().astype(np.int64), len(words.dictionary)
        piece = np.cumsum(is_cut[data], dtype=np.int64)[begin] + text  # both only ever grow: equal sums, equal piece
        lead = [code]
        for k in range(1, most_words):
            later = np.full(len(code), pad)
            later[:-k] = np.where(piece[k:] == piece[:-k], code[k:], pad)
            lead.append(later)
        key = code
        for column in lead[1:]:
            if int(key.max()) >= (1 << 62) // (pad + 1):
                key = np.unique(key, return_inverse=True)[1]
            key = key * (pad + 1) + column
        _, first, n = np.unique(key, return_index=True, return_counts=True)
        names = pa.concat_arrays([words.dictionary, pa.array([""])])
        columns = [names.take(pa.array(column[first])) for column in lead]
        prefix = pc.binary_join_element_wise(*columns[:-1], pa.scalar(lang), " ")
        return pa.RecordBatch.from_arrays([prefix, columns[-1], pa.array(n)], ["prefix", "last", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = pc.dictionary_encode(batch.column(0))
            for at, lang in enumerate(langs.dictionary.to_pylist()):
                own = batch.filter(pc.equal(langs.indices, at))
                for _, data, starts in common.text_chunks(own, "text", WINDOW_BYTES):
                    found = counted(data, starts, lang)
                    if found is not None:
                        yield found

    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(common.lean(count), "prefix STRING, last STRING, n BIGINT")


def phrase_counts(docs: DataFrame, most_words: int = MOST_WORDS, least: int = LEAST_COUNT) -> DataFrame:
    """(lang, phrase, words, f) of all phrases up to the longest with at least ``least`` places; zero words: all words.

    The last words of a window are blanked where the window, or its prefix, is too rare to count as a phrase: such
    rows serve only the sums of shorter prefixes. Blanks end no phrase, and the filter that says so holds before
    the sums are shuffled.
    """
    dealt = windows(docs, most_words).repartition("prefix").groupBy("prefix", "last").agg(F.sum("n").alias("n"))
    both = dealt.withColumn("f", F.sum("n").over(Window.partitionBy("prefix")))
    parts = F.split("prefix", " ", most_words)
    words = [*(parts[k] for k in range(most_words - 2)), F.when(F.col("f") >= least, parts[most_words - 2]).otherwise("")]
    words.append(F.when(F.col("n") >= least, F.col("last")).otherwise(""))
    names = [f"w{k}" for k in range(most_words)]
    lead = both.select(parts[most_words - 1].alias("lang"), *[w.alias(name) for w, name in zip(words, names)], "n")
    depth = (F.lit(most_words) - F.bit_count(F.grouping_id())).cast("int")
    rolled = lead.rollup("lang", *names).agg(F.sum("n").alias("f"), depth.alias("words"))
    last = F.element_at(F.array(F.lit(" "), *names), F.col("words") + 1)
    rolled = rolled.filter((F.col("words") >= 0) & (last != "") & ((F.col("f") >= least) | (F.col("words") == 0)))
    return common.settled(rolled.select("lang", F.concat_ws(" ", *names).alias("phrase"), "words", "f"))


def looked_up(rows: DataFrame, counts: DataFrame, total: int, part: str, out: str) -> DataFrame:
    """Add the count of each row's phrase ``part``; the phrases that many rows may share are broadcast."""
    table = counts.select("lang", F.col("phrase").alias(part), F.col("f").alias(out))
    is_heavy = F.col(out) >= F.lit(total) / HEAVY
    near = rows.join(F.broadcast(table.filter(is_heavy)), ["lang", part], "left")
    rest = near.filter(F.col(out).isNull()).drop(out).join(table.filter(~is_heavy), ["lang", part])
    return near.filter(F.col(out).isNotNull()).unionByName(rest)


def scored(counts: DataFrame, total: int) -> DataFrame:
    """(lang, phrase, words, a, l, r, score) of every phrase of two words or more, at its lowest-scoring cut."""
    word = F.split("phrase", " ")
    cuts = counts.filter("words >= 2").withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1))).select(
        "lang", "phrase", "words", F.col("f").alias("a"), "k",
        F.array_join(F.slice(word, 1, F.col("k")), " ").alias("left"), F.array_join(F.slice(word, F.col("k") + 1, F.col("words")), " ").alias("right"),
    )
    cuts = looked_up(looked_up(cuts, counts, total, "left", "l"), counts, total, "right", "r")
    a, left, right = (F.col(c).cast("decimal(16,0)") for c in "alr")
    cuts = cuts.withColumns({"_squares": (a * a * F.lit(1_000_000).cast("decimal(7,0)")), "_product": left * right})
    cuts = cuts.withColumn("score", F.expr("_squares DIV _product"))
    lowest = F.min(F.struct("score", "k", "l", "r")).alias("low")
    return cuts.groupBy("lang", "phrase", "words", "a").agg(lowest).select("lang", "phrase", "words", "a", "low.l", "low.r", "low.score")


def held_in_longer(candidates: DataFrame, percent: int = DROP_PERCENT) -> DataFrame:
    """(lang, phrase) of candidates that stand inside a longer one which has at least ``percent`` of their places."""
    word = F.split("phrase", " ")
    inner = candidates.filter("words >= 3").withColumn("size", F.explode(F.sequence(F.lit(2), F.col("words") - 1)))
    inner = inner.withColumn("at", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)))
    inner = inner.select("lang", F.array_join(F.slice(word, F.col("at"), F.col("size")), " ").alias("phrase"), "a")
    longer = inner.groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    return candidates.join(longer, ["lang", "phrase"]).filter(100 * F.col("most") >= percent * F.col("a")).select("lang", "phrase")


def first_of_each(rows: DataFrame, group: str, order: list[Column], name: Column, limit: int) -> DataFrame:
    """The first ``limit`` rows of each group with their rank, whatever the size of a group.

    Rows are first ranked in buckets of about ten limits each; what is left of ten buckets meets in the next round.
    """
    total, digits = rows.count(), 0
    while total > 10 * limit * 10**digits:
        digits += 1
    for level in range(digits, -1, -1):
        bucket = F.pmod(F.xxhash64(name), F.lit(10**level))
        rank = F.row_number().over(Window.partitionBy(group, bucket).orderBy(*order))
        rows = rows.withColumn("rank", rank).filter(F.col("rank") <= limit)
    return rows


def collocations(
    docs: DataFrame, most_words: int = MOST_WORDS, least: int = LEAST_COUNT, percent: int = DROP_PERCENT, top: int = TOP
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first phrases of each language by score, count and name.

    score is floor(10^6 a a / (l r)) at the cut into a first part with l places and a rest with r places that
    scores lowest, ties to the shortest first part; n are all words of the language.
    """
    counts = phrase_counts(docs, most_words, least)
    sizes = counts.filter("words = 0").select("lang", F.col("f").alias("n"))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    candidates = common.settled(scored(counts, total))
    left = candidates.join(held_in_longer(candidates, percent), ["lang", "phrase"], "left_anti")
    best = first_of_each(common.settled(left), "lang", [F.desc("score"), F.desc("a"), F.asc("phrase")], F.col("phrase"), top)
    numbers = [F.col(c).cast("bigint").alias(c) for c in ("a", "l", "r", "n", "score")]
    return best.join(sizes, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", *numbers)


_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
COLLOCATIONS_SQL = f"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang,
                unnest(regexp_split_to_array(translate(coalesce(text, ''), '{_LETTERS}', '{_LETTERS.lower()}'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
spoken AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda w: w <> '') AS w FROM pieces),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM spoken),
phrases AS (SELECT lang, CAST(k AS INT) AS k, array_to_string(w[i : i + k - 1], ' ') AS phrase, w[i : i + k - 1] AS ws
            FROM places, range(1, 4) r(k) WHERE i + k - 1 <= len(w)),
f AS (SELECT lang, k, phrase, any_value(ws) AS ws, count(*) AS a FROM phrases GROUP BY lang, k, phrase),
n AS (SELECT lang, sum(a) AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS (SELECT * FROM f WHERE k >= 2 AND a >= 10),
cuts AS (SELECT c.lang, c.phrase, c.k, c.a, cut, x.a AS l, y.a AS r,
         CAST(1000000 AS HUGEINT) * c.a * c.a // (CAST(x.a AS HUGEINT) * y.a) AS score
         FROM (SELECT *, unnest(range(1, k)) AS cut FROM cand) c
         JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.ws[1 : cut], ' ')
         JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.ws[cut + 1 : c.k], ' ')),
low AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inner2 AS (SELECT lang, array_to_string(ws[p : p + 1], ' ') AS phrase, max(a) AS most
           FROM (SELECT *, unnest([1, 2]) AS p FROM cand WHERE k = 3) GROUP BY ALL),
kept AS (SELECT low.* FROM low LEFT JOIN inner2 USING (lang, phrase) WHERE most IS NULL OR low.k = 3 OR 100 * most < 50 * low.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN n USING (lang) WHERE rank <= 2000"""
