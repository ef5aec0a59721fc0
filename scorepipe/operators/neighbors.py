"""Exact k nearest neighbours without comparing all pairs.

Rows are cut into blocks by a median tree, so a block is a box of the feature space. A first look
inside the own block gives every row an upper limit for the distance of its k-th neighbour; a row
then visits only the blocks whose box comes closer than that limit. Work per task is bounded: blocks are split by hash when they hold too many rows, and so
are the rows that visit a block. Only k rows per row and visited block leave a task.

Copies need no search: a row with more than k copies has them as neighbours. At most k + 1 rows of
each set of copies take part, which is enough for the neighbours of every other row, so a point
that a third of the rows share is neither a hot block nor a hot key.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scorepipe.functions.keyed import hash_int, hash_key
from scorepipe.sources.tables import materialise

MAX_BLOCKS = 4096
SAMPLE_ROWS = 20_000
QUERY_SHARE = 256
NEIGHBOR = "id BIGINT, neighbor BIGINT, dist2 DOUBLE"


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All squared distances of two blocks, summed feature by feature in order."""
    out = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        gap = a[:, j, None] - b[None, :, j]
        out += gap * gap
    return out


def _with_self_away(d: np.ndarray, part: np.ndarray, cid: np.ndarray) -> np.ndarray:
    """Distances with those of a row to itself put to infinity; ``cid`` is sorted."""
    low, high = np.searchsorted(cid, part), np.searchsorted(cid, part, "right")
    once = np.flatnonzero(high == low + 1)
    d[once, low[once]] = np.inf
    for i in np.flatnonzero(high > low + 1):
        d[i, low[i]:high[i]] = np.inf
    return d


def _possible(q: np.ndarray, c: np.ndarray, size_c: np.ndarray, part: np.ndarray, cid: np.ndarray, last: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of all pairs that may be among the nearest: a matrix product, and twice its largest error as margin.

    The sums of products stay within (features + 4) roundings of both lengths; the margin takes eight times that.
    """
    size_q = np.einsum("ij,ij->i", q, q)
    d = q @ c.T
    d *= -2.0
    d += size_c
    slack = 16 * (q.shape[1] + 4) * np.finfo(float).eps * (size_q + size_c.max())
    _with_self_away(d, part, cid)
    kth = np.partition(d, last, axis=1)[:, last]
    return np.nonzero((d <= (kth + slack)[:, None]) & (d < np.inf))


def nearest_in_block(qid, q, cid, c, k, step: int = 256):
    """The k nearest candidates of each query row, itself excluded, ties by id."""
    ids, near, dist = [], [], []
    by_id = np.argsort(cid, kind="stable")
    cid, c = cid[by_id], c[by_id]
    last = min(k, len(cid)) - 1
    # squares of larger values could overflow in the product
    plain = not (np.abs(q).max(initial=0) < 1e100 and np.abs(c).max(initial=0) < 1e100)
    if not plain:  # lengths are taken from the middle of the candidates
        middle = c.mean(axis=0)
        centred = c - middle
        size = np.einsum("ij,ij->i", centred, centred)
    for s in range(0, len(q), step):
        part, own = qid[s:s + step], q[s:s + step]
        if plain:
            d = _with_self_away(squared_distances(own, c), part, cid)
            kth = np.partition(d, last, axis=1)[:, last]
            r, col = np.nonzero((d <= kth[:, None]) & np.isfinite(d))
            exact = d[r, col]
        else:
            r, col = _possible(own - middle, centred, size, part, cid, last)
            exact = np.zeros(len(r))
            for j in range(own.shape[1]):  # in the order of squared_distances
                gap = own[r, j] - c[col, j]
                exact += gap * gap
        # candidates are in id order, so the column number breaks ties
        order = np.lexsort((col, exact, r))
        r, col, exact = r[order], col[order], exact[order]
        place = np.arange(len(r)) - np.searchsorted(r, r)
        r, col, exact = r[place < k], col[place < k], exact[place < k]
        ids.append(part[r])
        near.append(cid[col])
        dist.append(exact)
    return pd.DataFrame({"id": np.concatenate(ids), "neighbor": np.concatenate(near), "dist2": np.concatenate(dist)})


def _matrix(series: pd.Series) -> np.ndarray:
    return np.stack(series.to_numpy()).astype(float)


def _without_surplus(rows: DataFrame, k: int) -> DataFrame:
    """At most k + 1 rows of each set of copies, lowest ids first.

    The window group limit keeps no more than that per task, before the shuffle.
    """
    w = Window.partitionBy("vec").orderBy("id")
    return rows.withColumn("copy", F.row_number().over(w)).filter(F.col("copy") <= k + 1).drop("copy")


def _median_tree(sample: np.ndarray, depth: int) -> tuple[list[int], list[float]]:
    """Split planes of a complete binary tree, node 1 the root, children of n at 2n and 2n + 1."""
    dims, cuts = [0] * 2**depth, [0.0] * 2**depth
    parts = {1: sample}
    for node in range(1, 2**depth):
        part = parts.pop(node)
        dim = int(np.argmax(part.max(axis=0) - part.min(axis=0))) if len(part) else 0
        cut = float(np.median(part[:, dim])) if len(part) else 0.0
        dims[node], cuts[node] = dim, cut
        left = part[:, dim] <= cut if len(part) else np.zeros(0, bool)
        parts[2 * node], parts[2 * node + 1] = part[left], part[~left]
    return dims, cuts


def _with_block(rows: DataFrame, dims: list[int], cuts: list[float], depth: int) -> DataFrame:
    """Leaf number of the median tree: a walk of `depth` steps in built-in expressions."""
    planes = rows.sparkSession.createDataFrame([(dims, cuts)], "dims ARRAY<INT>, cuts ARRAY<DOUBLE>")
    return rows.withColumn("plane", planes.select(F.struct("dims", "cuts")).scalar()).withColumn(
        "block",
        F.aggregate(
            F.sequence(F.lit(1), F.lit(depth)), F.lit(1),
            lambda node, _: node * 2
            + (F.get("vec", F.get("plane.dims", node)) > F.get("plane.cuts", node)).cast("int"),
        ) if depth else F.lit(1),
    ).drop("plane")


def _block_table(spark, counts: dict[int, int], name: str) -> DataFrame:
    """Number per block; at most MAX_BLOCKS rows, which is what allows the broadcast."""
    return F.broadcast(spark.createDataFrame(list(counts.items()), f"block INT, {name} INT"))


def _top_k(pairs: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("id").orderBy("dist2", "neighbor")
    return pairs.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def kept_neighbors(rows: DataFrame, k: int, block_rows: int = 4096) -> DataFrame:
    """(id, neighbor, dist2, rank) for rows (id BIGINT, vec ARRAY<DOUBLE>).

    Rows beyond the first k + 1 of a set of copies are not listed; see `nearest_neighbors`.
    """
    spark = rows.sparkSession
    kept = materialise(_without_surplus(rows.select("id", "vec"), k))
    n, width = kept.agg(F.count(F.lit(1)), F.max(F.size("vec"))).first()
    if not n:
        return spark.createDataFrame([], NEIGHBOR + ", rank INT")
    depth = max(0, min(int(math.log2(MAX_BLOCKS)), math.ceil(math.log2(n / block_rows))))
    if depth == 0:
        dims, cuts = [0], [0.0]
    else:
        # about SAMPLE_ROWS rows by hash; they steer the cut only, the result is exact for any planes
        share = int(min(1.0, SAMPLE_ROWS / n) * 2**60)
        picked = kept.filter(hash_int(hash_key("planes", F.col("id"))) < share).select("vec").toPandas()
        dims, cuts = _median_tree(_matrix(picked["vec"]), depth)
    placed = _with_block(kept, dims, cuts, depth)
    one_group = depth == 0
    if one_group:
        parts = {1: 1}
    else:
        boxes = placed.groupBy("block").agg(
            F.count(F.lit(1)).alias("n"),
            F.array(*[F.min(F.get("vec", F.lit(j))) for j in range(width)]).alias("lo"),
            F.array(*[F.max(F.get("vec", F.lit(j))) for j in range(width)]).alias("hi"),
        ).toPandas()  # at most MAX_BLOCKS rows
        parts = {int(b): math.ceil(int(c) / (2 * block_rows)) for b, c in zip(boxes["block"], boxes["n"])}
    part_count = _block_table(spark, parts, "parts")

    spread = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    placed = placed.join(part_count, "block").withColumn("part", spread)
    candidates = placed.select("block", "part", F.col("id").alias("cid"), F.col("vec").alias("cvec"))

    if one_group:
        visits = placed.select("id", "vec", F.lit(1).alias("block"), F.lit(0).alias("part"))
    else:
        def limit(pdf: pd.DataFrame) -> pd.DataFrame:
            ids, v = pdf["id"].to_numpy(), _matrix(pdf["vec"])
            near = nearest_in_block(ids, v, ids, v, k)
            far = near.groupby("id")["dist2"].agg(["size", "max"])
            full = far["max"].where(far["size"] == k, np.inf)
            return pd.DataFrame({"id": ids, "vec": list(v), "limit": full.reindex(ids).fillna(np.inf).to_numpy()})

        limited = placed.groupBy("block", "part").applyInPandas(limit, "id BIGINT, vec ARRAY<DOUBLE>, limit DOUBLE")
        shared = spark.sparkContext.broadcast(
            (boxes["block"].to_numpy(), _matrix(boxes["lo"]), _matrix(boxes["hi"]))
        )

        def route(batches):
            block, lo, hi = shared.value
            for pdf in batches:
                v, cap = _matrix(pdf["vec"]), pdf["limit"].to_numpy()
                gap = np.zeros((len(v), len(block)))
                for j in range(v.shape[1]):
                    out = np.maximum(np.maximum(lo[None, :, j] - v[:, j, None], v[:, j, None] - hi[None, :, j]), 0.0)
                    gap += out * out
                reach = [block[g <= c] for g, c in zip(gap, cap)]
                yield pd.DataFrame({"id": pdf["id"], "vec": pdf["vec"], "blocks": reach})

        routed = materialise(limited.mapInPandas(route, "id BIGINT, vec ARRAY<DOUBLE>, blocks ARRAY<INT>"))
        visits = routed.select("id", "vec", F.explode("blocks").alias("block")).join(part_count, "block").select(
            "id", "vec", "block", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
        )

    if one_group:
        # one block fits any task, so its visitors are shared out over the cores at once
        lanes = {1: max(1, min(spark.sparkContext.defaultParallelism, math.ceil(n / QUERY_SHARE)))}
    else:
        # as many shares of visiting rows per block as keep one share near four blocks of rows
        load = visits.filter("part = 0").groupBy("block").agg(F.count(F.lit(1)).alias("n")).collect()
        lanes = {r["block"]: max(1, math.ceil(r["n"] / (4 * block_rows))) for r in load}
    lane = F.pmod(F.xxhash64("id", F.lit(7)), F.col("lanes")).cast("int").alias("lane")
    visitors = visits.join(_block_table(spark, lanes, "lanes"), "block").select("id", "vec", "block", "part", lane)
    every_lane = F.explode(F.sequence(F.lit(0), F.col("host_lanes") - 1)).alias("lane")
    hosts = candidates.join(_block_table(spark, lanes, "host_lanes"), "block").select(
        "cid", "cvec", "block", "part", every_lane
    )

    def meet(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if q.empty or c.empty:
            return pd.DataFrame({"id": [], "neighbor": [], "dist2": []})
        return nearest_in_block(q["id"].to_numpy(), _matrix(q["vec"]), c["cid"].to_numpy(), _matrix(c["cvec"]), k)

    keys = ["block", "part", "lane"]
    pairs = visitors.groupBy(*keys).cogroup(hosts.groupBy(*keys)).applyInPandas(meet, NEIGHBOR)
    return _top_k(pairs, k)


def nearest_neighbors(df: DataFrame, key: str, features: list[str], k: int = 5, block_rows: int = 4096, salts: int = 32) -> DataFrame:
    """(id, neighbor, dist2, rank) of every row: its k nearest other rows, ties by id."""
    rows = df.select(quoted_id(key), F.array(*[F.col(f"`{c}`").cast("double") for c in features]).alias("vec"))
    listed = kept_neighbors(rows, k, block_rows)
    # rows past the first k + 1 copies: their neighbours are the first k copies
    first = _without_surplus(rows, k)
    heavy = first.groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("copies")).filter(F.size("copies") > k)
    salted = heavy.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    member = rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int"))
    surplus = member.join(salted, ["vec", "salt"]).filter(~F.array_contains("copies", F.col("id"))).select(
        "id", F.posexplode(F.slice("copies", 1, k)).alias("pos", "neighbor")
    )
    return listed.select("id", "neighbor", "dist2", "rank").unionByName(
        surplus.select("id", "neighbor", F.lit(0.0).cast("double").alias("dist2"), (F.col("pos") + 1).cast("int").alias("rank"))
    )


def quoted_id(key: str):
    return F.col(f"`{key}`").cast("bigint").alias("id")
