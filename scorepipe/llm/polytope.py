"""Nearest neighbours by cross-polytope hashing.

A table turns a unit vector by a pseudo-rotation (three rounds of random signs and a fast Hadamard transform, the
vector padded to a power of two) and names it after the nearest signed axis: the largest coordinate in absolute
value and its sign. Larger inputs add a second name from a further rotation, over as many axes as bring a bucket to
about BUCKET_ROWS rows; the first name always uses all axes. A query probes the bucket of every signed axis, or
pair of them, whose coordinates together fall short of the largest ones by at most a bound.

The bound is fitted: for a sample of the queries (FIT_QUERIES at most, by hash) the exact neighbours are found
among all rows, and the bound is the smallest one that reaches the share TARGET of them. So hard data probes more
buckets, and the recall holds at every size. Every row is in the index of every table.

Queries and rows meet by bucket. Buckets that hold a 65,536th of the rows or of the probes, and more than a block,
are cut into blocks of rows and of queries that meet in other tasks; their list has a bound and is broadcast. Within
a block only the nearest rows of each query leave the task, measured exactly on the original vectors. Equal vectors
are as near as each other to anything, so of a set of copies in a batch only the first k + 1 ids go into the index:
no other can be among the k nearest of any query, its own row left out.

Nulls, repeats and other cases: rows without an id, and vectors that are null, empty, zero or hold a null or a
non-finite component, take no part; neither do rows of another length than the query's. Of an id's repeated rows
the nearest counts, and none of them is a candidate of its own id. Ties go to the smaller id. An empty table
gives no rows. Columns beside the two named ones are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from scorepipe.llm import common

NEAREST = 10
TABLES = 4
BUCKET_ROWS = 512
FIT_QUERIES = 256
TARGET = 0.97
BLOCK_ROWS = 1 << 13
BLOCK_QUERIES = 1 << 11
HEAVY_SHARE = 1 << 16
SEED = 42
TILE = 1 << 21
"""Cells of distance arrays that a task holds at a time."""

PAIRS = "query_id BIGINT, vec_id BIGINT, score DOUBLE"


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row, orthonormal; the width is a power of two."""
    n, width = x.shape
    half = 1
    while half < width:
        x = x.reshape(n, width // (2 * half), 2, half)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], 2)
        half *= 2
    return x.reshape(n, width) / np.sqrt(width)


class Tables:
    """Hash tables for vectors of one length; a pure function of length, size and seed."""

    def __init__(self, dim: int, rows: int, tables: int = TABLES, seed: int = SEED):
        self.dim, self.width, self.tables = dim, 1 << max(0, dim - 1).bit_length(), tables
        self.axes = [self.width]  # of each name; a name has two values for each axis
        buckets, wanted = 2 * self.width, rows / BUCKET_ROWS
        while buckets < wanted:
            axes = min(self.width, 1 << max(0, int(np.ceil(np.log2(wanted / buckets))) - 1))
            self.axes.append(axes)
            buckets *= 2 * axes
        draw = np.random.default_rng([seed, dim])
        self.signs = draw.choice([-1.0, 1.0], (tables, len(self.axes), 3, self.width))

    def turned(self, x: np.ndarray) -> Iterator[list[np.ndarray]]:
        """Of each table: the rotated unit vectors of each name, cut to its axes."""
        unit = np.zeros((len(x), self.width))
        largest = np.abs(x).max(1, keepdims=True)  # first to this scale: squares of tiny or huge components stay finite
        unit[:, : self.dim] = x / largest
        unit /= np.linalg.norm(unit, axis=1, keepdims=True)
        for table in range(self.tables):
            names = []
            for signs, axes in zip(self.signs[table], self.axes):
                y = unit
                for s in signs:
                    y = hadamard(y * s)
                names.append(y[:, :axes])
            yield names

    def buckets(self, x: np.ndarray) -> np.ndarray:
        """[row, table]: the bucket of each vector."""
        out = np.zeros((len(x), self.tables), np.int64)
        for table, names in enumerate(self.turned(x)):
            for y in names:
                axis = np.abs(y).argmax(1)
                negative = y[np.arange(len(y)), axis] < 0
                out[:, table] = out[:, table] * (2 * y.shape[1]) + 2 * axis + negative
        return out

    @staticmethod
    def shortfalls(y: np.ndarray) -> np.ndarray:
        """[row, signed axis]: how far each falls short of the nearest one."""
        signed = np.stack([y, -y], 2).reshape(len(y), -1)
        return signed.max(1, keepdims=True) - signed

    def shortfall_of(self, query: np.ndarray, buckets: np.ndarray) -> np.ndarray:
        """The smallest bound at which a query probes one of these buckets; ``buckets`` is [row, table]."""
        best = np.full(len(buckets), np.inf)
        for table, names in enumerate(self.turned(query[None])):
            rest, short = buckets[:, table], np.zeros(len(buckets))
            for y in reversed(names):
                rest, code = np.divmod(rest, 2 * y.shape[1])
                short += self.shortfalls(y)[0][code]
            best = np.minimum(best, short)
        return best

    def probes(self, x: np.ndarray, bound: float) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(table, index of the query, bucket) of every bucket whose shortfall is within the bound."""
        for table, names in enumerate(self.turned(x)):
            owner, bucket, spent = np.arange(len(x)), np.zeros(len(x), np.int64), np.zeros(len(x))
            for y in names:
                short = self.shortfalls(y)
                at, code = np.nonzero(short[owner] <= bound - spent[:, None])
                owner, spent, bucket = owner[at], spent[at] + short[owner[at], code], bucket[at] * short.shape[1] + code
            yield table, owner, bucket


def vectors_of(batch: pa.RecordBatch, column: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix of their vectors) for each length of vector in a batch."""
    lists = batch.column(batch.schema.get_field_index(column))
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    values, ends = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64), np.cumsum(sizes)
    for dim in np.unique(sizes):
        rows = np.flatnonzero(sizes == dim)
        yield rows, values[(ends[rows] - dim)[:, None] + np.arange(dim)]


def nearest(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of the query, row id, distance) of the k nearest rows of each query, ties to smaller ids; more of them
    where the rows take several tiles.

    Distances are sums of squared differences in double precision.
    """
    found = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
    order = np.argsort(ids, kind="stable")
    dim, most = rows.shape[1], max(1, TILE // rows.shape[1])
    for j in range(0, len(rows), most):
        own = order[j : j + most]
        x, names = rows[own], ids[own]
        step = max(1, TILE // (len(x) * dim))
        for i in range(0, len(queries), step):
            gap = queries[i : i + step, None, :] - x[None]
            distance = np.sqrt((gap * gap).sum(2))
            distance[query_ids[i : i + step, None] == names[None]] = np.nan  # a query is no neighbour of its own
            best = np.argsort(distance, axis=1, kind="stable")[:, :k]  # nan last
            score = np.take_along_axis(distance, best, 1)
            q, at = np.nonzero(~np.isnan(score))
            found.append((q + i, names[best[q, at]], score[q, at]))
    return tuple(np.concatenate(x) for x in zip(*found))


def first_k(pairs: DataFrame, k: int) -> DataFrame:
    """The k nearest of each query, from pairs that may repeat; dealt once, by the query."""
    pairs = pairs.repartition("query_id").groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return pairs.withColumn("rank", rank).filter(F.col("rank") <= k)


def sound(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vector) of the rows that take part."""
    v = F.col("vector")
    finite = F.forall(v, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).alias("vector"))
    return rows.filter(F.col("vec_id").isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0))


def exact_nearest(rows: DataFrame, sample: list, k: int) -> list:
    """(query_id, vec_id, vector): the k nearest of all rows to each of a few queries."""
    by_dim: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for dim in {len(r["vector"]) for r in sample}:
        own = [r for r in sample if len(r["vector"]) == dim]
        by_dim[dim] = np.array([r["vec_id"] for r in own]), np.array([r["vector"] for r in own], np.float64)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for at, x in vectors_of(batch, "vector"):
                if x.shape[1] in by_dim:
                    query_ids, q = by_dim[x.shape[1]]
                    who, vec_ids, score = nearest(q, query_ids, x, ids[at], k)
                    yield pa.RecordBatch.from_arrays([pa.array(query_ids[who]), pa.array(vec_ids), pa.array(score)], ["query_id", "vec_id", "score"])

    near = first_k(rows.mapInArrow(common.lean(measure), PAIRS), k)
    found = rows.join(F.broadcast(near), "vec_id").select("query_id", "vec_id", "vector")  # FIT_QUERIES * k rows at most
    return found.collect()


def fitted(rows: DataFrame, queries: DataFrame, k: int, target: float) -> tuple[dict[int, Tables], dict[int, float]]:
    """Tables and probing bound for each length of vector."""
    sizes = {r["dim"]: r["n"] for r in rows.groupBy(F.size("vector").alias("dim")).agg(F.count(F.lit(1)).alias("n")).collect()}
    tables = {dim: Tables(dim, n) for dim, n in sizes.items()}
    sample = queries.orderBy(F.xxhash64("vec_id"), "vec_id").limit(FIT_QUERIES).collect()
    if not sample:
        return tables, {}
    vector = {r["vec_id"]: np.array(r["vector"], np.float64) for r in sample}
    short: dict[int, list[np.ndarray]] = {}
    for r in exact_nearest(rows, sample, k):
        dim = len(r["vector"])
        if len(vector[r["query_id"]]) == dim:
            own = tables[dim].buckets(np.array([r["vector"]], np.float64))
            short.setdefault(dim, []).append(tables[dim].shortfall_of(vector[r["query_id"]], own))
    slack = 1 + 1e-9  # sums in another order differ by rounding
    # the bound of a length without sampled queries reaches every bucket
    bounds = {dim: slack * float(np.quantile(np.concatenate(short[dim]), target, method="higher")) if dim in short else np.inf for dim in tables}
    return tables, bounds


def search(
    vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = NEAREST, target: float = TARGET
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found for every query, nearest first.

    ``is_query`` is a condition on the column ``vec_id``. ``score`` is the Euclidean distance of the original vectors.
    """
    rows = common.settled(sound(vectors, id_col, vector_col))
    single = rows.schema["vector"].dataType.elementType.simpleString() == "float"
    real = np.float32 if single else np.float64  # what travels is no wider than the original
    queries = rows.filter(is_query)
    tables, bounds = fitted(rows, queries, k, target)

    cells = f"dim INT, tab INT, bucket BIGINT, vec_id BIGINT, vector ARRAY<{'FLOAT' if single else 'DOUBLE'}>"

    def in_cells(table: int, buckets: np.ndarray, ids: np.ndarray, x: np.ndarray) -> pa.RecordBatch:
        n, dim = x.shape
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, dim, dtype=np.int32)), pa.array(x.ravel().astype(real)))
        columns = [np.full(n, dim, np.int32), np.full(n, table, np.int32), buckets, ids]
        return pa.RecordBatch.from_arrays([*map(pa.array, columns), lists], ["dim", "tab", "bucket", "vec_id", "vector"])

    def without_spare_copies(x: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Rows without those whose vector k + 1 rows of smaller ids share; equal vectors have equal names, so they are neighbours."""
        name = np.zeros(len(x), np.uint64)
        for column in x.view(np.uint64).T:
            name = common.paired(name, column)
        order = np.lexsort((ids, name))
        same = np.concatenate([[False], (x[order][1:] == x[order][:-1]).all(1)])
        place = np.arange(len(order))
        since = np.maximum.accumulate(np.where(same, 0, place))
        return order[place - since <= k]

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for at, x in vectors_of(batch, "vector"):
                kept = without_spare_copies(x, ids[at])
                x, own = x[kept], ids[at[kept]]
                for table, buckets in enumerate(tables[x.shape[1]].buckets(x).T):
                    yield in_cells(table, np.ascontiguousarray(buckets), own, x)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for at, x in vectors_of(batch, "vector"):
                dim = x.shape[1]
                for i in range(0, len(x), 64):  # a query may probe every bucket
                    for table, owner, buckets in tables[dim].probes(x[i : i + 64], bounds[dim]):
                        yield in_cells(table, buckets, ids[at[i + owner]], x[i + owner])

    if not bounds:
        return rows.sparkSession.createDataFrame([], "query_id BIGINT, rank INT, vec_id BIGINT, score DOUBLE")
    indexed = rows.mapInArrow(common.lean(index), cells)
    probing = queries.mapInArrow(common.lean(probe), cells)
    cell = ["dim", "tab", "bucket"]
    sizes = indexed.select(*cell, F.lit(1).alias("r"), F.lit(0).alias("q")).union(probing.select(*cell, F.lit(0), F.lit(1)))
    sizes = common.settled(sizes.groupBy(*cell).agg(F.sum("r").alias("r"), F.sum("q").alias("q")))
    all_rows, all_probes = sizes.agg(F.sum("r"), F.sum("q")).first()
    crowded = sizes.filter(
        ((F.col("r") > BLOCK_ROWS) & (F.col("r") * HEAVY_SHARE >= all_rows)) | ((F.col("q") > BLOCK_QUERIES) & (F.col("q") * HEAVY_SHARE >= all_probes))
    ).select(*cell, F.ceil(F.col("r") / BLOCK_ROWS).alias("row_blocks"), F.ceil(F.col("q") / BLOCK_QUERIES).alias("query_blocks"))

    def dealt(side: DataFrame, kind: int) -> DataFrame:
        """A row goes to one block of rows and meets every block of queries there; a query the other way round."""
        both = side.join(F.broadcast(crowded), cell, "left")
        row_blocks, query_blocks = (F.greatest(F.coalesce(c, F.lit(1)), F.lit(1)) for c in ("row_blocks", "query_blocks"))
        own, other = (row_blocks, query_blocks) if kind else (query_blocks, row_blocks)
        block = F.pmod(F.xxhash64("vec_id"), own)
        met = F.explode(F.sequence(F.lit(0).cast("bigint"), other - 1))
        names = ("row_block", "query_block") if kind else ("query_block", "row_block")
        return both.withColumn(names[0], block).withColumn(names[1], met).select(
            *cell, "row_block", "query_block", F.lit(kind).alias("kind"), "vec_id", "vector"
        )

    key = [*cell, "row_block", "query_block"]
    meeting = dealt(probing, 0).union(dealt(indexed, 1)).repartition(*key).sortWithinPartitions(*key, "kind")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []  # the cell at work and its queries; rows come after the queries of their cell
        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(6)], 1)
            ids = batch.column(6).to_numpy()
            lists = batch.column(7)
            starts = np.concatenate([[0], np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1, [len(keys)]]) if len(keys) else [0]
            out = []
            for a, b in zip(starts[:-1], starts[1:]):
                dim, kind, own = int(keys[a, 0]), int(keys[a, 5]), tuple(keys[a, :5])
                if own != now:
                    now, held = own, []
                if kind and not held:
                    continue
                x = lists.slice(a, b - a).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(b - a, dim)
                if not kind:
                    held.append((ids[a:b], x))
                    continue
                query_ids, q = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
                held = [(query_ids, q)]
                who, vec_ids, score = nearest(q, query_ids, x, ids[a:b], k)
                out.append((query_ids[who], vec_ids, score))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], ["query_id", "vec_id", "score"])

    best = first_k(meeting.mapInArrow(common.lean(meet), PAIRS), k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
