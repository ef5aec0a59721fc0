"""Boosted trees from second-order histograms, for many models over the same rows at once.

Rows are binned once into blocks of bytes. A level of a tree needs, for its open nodes, the gradients and
hessians per feature and bin: tasks sum them for their blocks, and the best splits are chosen from the sums
of all tasks. Sums of bounded size go to the driver, one array a task. Of deeper trees only the nodes of many rows are
split so; the rows of all others are shuffled once a tree, each node to one task, which grows what is below it. All
models (settings, left-out fold) share the blocks and the passes. Where the binned rows fit a task, its sums are
already whole, and the models grow to their end in the tasks, dealt to the cores by groups.

Gradients are rounded to multiples of 2^-24, so sums are integers: the trees do not depend on how rows are
dealt, all ways give the same trees, and a node's sums less those of one child are those of the other.
"""

from __future__ import annotations

import heapq
import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from scorepipe.functions.columns import quoted
from scorepipe.sources.tables import settled

MAX_BINS = 256
BLOCK_ROWS = 1 << 16
CELLS = 1 << 22
"""Cells (rows x features, a byte each) that a task bins at a time; tables up to this size are whole in the tasks."""
TASK_BLOCKS = 1
"""Blocks that are worth a task, while there are cores for it."""
FEW_SPLITS = 64
"""Trees with at most so many splits are walked split by split over bytes, larger ones row by row."""
MESSAGE_CELLS = 1 << 18
"""Sums (node x bin) that a task sends at most; of models with larger levels the lower nodes are grown from shuffled rows."""
PART_ROWS = 1 << 19
"""Rows of a node below which one task grows a deep tree to its end: about as long as a stage over all rows takes for one level."""
MODEL_ROWS = 1 << 23
"""Margins (row x model) that a task keeps at a time."""
LINEAGE = 20
"""Times that margins are kept before they are written to the shared folder."""
DENSE_CELLS = 1 << 20
"""Sums (node x bin) of a level that are kept for the next one."""
SLAB_CELLS = 1 << 16
"""Sums (node x bin) that a task makes and judges at a time, so that they stay in its core's cache."""
UNIT = float(1 << 24)
REFRESH = 5
"""Trees that are added to the stored margins at a time."""
LEAST_GAIN = 1e-6


@dataclass(frozen=True)
class Settings:
    """One model: tree and boosting settings, and the fold whose rows it does not see (-1: none)."""

    depth: int = 6
    rate: float = 0.3
    gamma: float = 0.0
    min_child: float = 1.0
    columns: float = 1.0
    positive: float = 1.0
    penalty: float = 1.0
    rounds: int = 100
    seed: int = 100
    fold: int = -1

    @staticmethod
    def of(params: dict, rounds: int = 100, seed: int = 100, fold: int = -1) -> Settings:
        """From the usual names of booster settings; what is not named keeps the booster's default."""
        names = {
            "max_depth": "depth", "learning_rate": "rate", "gamma": "gamma", "min_child_weight": "min_child",
            "colsample_bytree": "columns", "scale_pos_weight": "positive", "reg_lambda": "penalty",
        }
        return Settings(**{names[k]: v for k, v in params.items() if k in names}, rounds=rounds, seed=seed, fold=fold)

    def features(self, tree: int, n: int) -> np.ndarray:
        """The features that a tree may use, in order."""
        k = min(n, max(1, int(self.columns * n)))
        return np.sort(np.random.default_rng([self.seed, tree]).choice(n, k, replace=False))


class Tree:
    """Arrays over nodes; a row goes left where its bin is at most the node's. left = -1 marks a leaf."""

    def __init__(self):
        self.feature, self.bin, self.left, self.right = [-1], [-1], [-1], [-1]
        self.grad, self.hess, self.gain, self.value = [0.0], [0.0], [0.0], None

    @staticmethod
    def of(columns: dict) -> Tree:
        tree = Tree()
        vars(tree).update(columns)
        return tree

    def split(self, node: int, feature: int, at: int, gain: float, sums: tuple[float, float, float, float]) -> list[int]:
        children = [len(self.feature), len(self.feature) + 1]
        self.feature[node], self.bin[node], self.gain[node] = feature, at, gain
        self.left[node], self.right[node] = children
        for g, h in (sums[:2], sums[2:]):
            for column, x in ((self.feature, -1), (self.bin, -1), (self.left, -1), (self.right, -1), (self.grad, g), (self.hess, h), (self.gain, 0.0)):
                column.append(x)
        return children

    def finished(self, penalty: float) -> Tree:
        for name in ("feature", "bin", "left", "right"):
            setattr(self, name, np.array(getattr(self, name), np.int32))
        for name in ("grad", "hess", "gain"):
            setattr(self, name, np.array(getattr(self, name)))
        self.value = -self.grad / (self.hess + penalty)
        return self

    def step(self, bins: np.ndarray, node: np.ndarray) -> None:
        """Send rows at split nodes one level down."""
        feature, at, left, right = (np.asarray(x) for x in (self.feature, self.bin, self.left, self.right))
        rows = np.flatnonzero((left >= 0).take(node))
        own = node.take(rows)
        if bins.flags.c_contiguous:
            cell = (feature.astype(np.int64) * bins.shape[1]).take(own)
            cell += rows
            found = bins.ravel().take(cell)
        else:
            found = bins[feature[own], rows]
        node[rows] = np.where(found <= at.take(own), left.take(own), right.take(own))

    def leaves(self, bins: np.ndarray, depth: int) -> np.ndarray:
        """The node of every row after ``depth`` levels."""
        left = np.asarray(self.left)
        splits = np.flatnonzero(left >= 0)
        if len(splits) <= FEW_SPLITS:  # so all nodes have numbers of one byte
            below = np.zeros(len(left), np.int64)
            node = np.zeros(bins.shape[1], np.uint8)
            for s in splits.tolist():  # a child comes after its parent
                a, b = self.left[s], self.right[s]
                below[[a, b]] = below[s] + 1
                if below[s] < depth:
                    own = node == s
                    node += own.view(np.uint8) * np.uint8(a - s)
                    own &= bins[self.feature[s]] > self.bin[s]
                    node += own.view(np.uint8) * np.uint8(b - a)
            return node.astype(np.int32)
        node = np.zeros(bins.shape[1], np.int32)
        for _ in range(depth):
            self.step(bins, node)
        return node

    @property
    def numNodes(self) -> int:  # noqa: N802 the name that tree models have
        return len(self.feature)


class Growth:
    """A model at work: finished trees, the tree that grows, and its open nodes."""

    def __init__(self, settings: Settings, features: int):
        self.settings, self.n_features, self.trees = settings, features, []
        self._open()

    def _open(self) -> None:
        self.tree, self.frontier, self.level = Tree(), [0], 0
        self.features = self.settings.features(len(self.trees), self.n_features)

    @property
    def done(self) -> bool:
        return len(self.trees) >= self.settings.rounds

    def take(self, best: dict[int, tuple]) -> bool:
        """Split the open nodes by the best split of each; says whether the tree is finished."""
        opened = []
        for node in self.frontier:
            g, h, gain, feature, at, *sums = best[node]
            if self.level == 0:
                self.tree.grad[0], self.tree.hess[0] = g, h
            if gain > max(LEAST_GAIN, self.settings.gamma):
                children = self.tree.split(node, int(feature), int(at), gain, tuple(sums))
                # less weight than two children must have: it stays a leaf
                opened += [c for c in children if self.tree.hess[c] >= 2 * self.settings.min_child]
        self.level += 1
        self.frontier = opened if self.level < self.settings.depth else []
        if self.frontier:
            return False
        self.trees.append(self.tree.finished(self.settings.penalty))
        self._open()
        return True


def gradients(margin: np.ndarray, label: np.ndarray, positive: float, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivatives of the log loss, as whole multiples of 2^-24. ``weight``: that of every row, where it is at hand."""
    p = 1.0 / (1.0 + np.exp(-margin))
    w = np.where(label > 0, positive, 1.0) if weight is None else weight
    return np.rint((p - label) * w * UNIT), np.maximum(np.rint(p * (1 - p) * w * UNIT), 1.0)


# rows as blocks of bins


def few_values(df: DataFrame, features: list[str], most: int) -> dict[int, list[float]]:
    """The distinct values of every feature that has at most so many; missing values are refused.

    A task sends at most ``most`` values of a feature, or one mark that there are more.
    """
    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list[np.ndarray | None] = [np.empty(0)] * len(features)
        for batch in batches:
            for j, known in enumerate(seen):
                if known is not None:
                    values = np.unique(np.append(known, batch.column(j).to_numpy(zero_copy_only=False)))
                    seen[j] = values if len(values) <= most or np.isnan(values[-1]) else None
        column = [np.full(1 if v is None else len(v), j, np.int32) for j, v in enumerate(seen)]
        value = pa.array(np.concatenate([np.empty(0), *[np.array([np.inf]) if v is None else v for v in seen]]))
        more = [np.full(len(c), v is None) for c, v in zip(column, seen)]
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(column)), value, pa.array(np.concatenate(more))], ["feature", "value", "more"])

    cells = df.select(*[quoted(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)])
    found = cells.mapInArrow(look, "feature INT, value DOUBLE, more BOOLEAN").distinct()
    whole = found.groupBy("feature").agg(
        F.collect_set("value").alias("values"), F.max("more").alias("more"), F.max(F.isnan("value")).alias("missing")
    ).select("feature", "missing", F.when(~F.col("more") & (F.size("values") <= most), F.col("values")).alias("values"))
    rows = whole.collect()
    if any(r["missing"] for r in rows):
        raise ValueError(f"missing values in {[features[r['feature']] for r in rows if r['missing']]}")
    return {r["feature"]: r["values"] for r in rows if r["values"] is not None}


def fit_cuts(df: DataFrame, features: list[str], max_bins: int = MAX_BINS) -> list[np.ndarray]:
    """Upper bounds of all bins but the last, per feature: every value where there are few, else quantiles."""
    values = few_values(df, features, max_bins)
    many = [i for i in range(len(features)) if i not in values]
    marks = [i / max_bins for i in range(1, max_bins)]
    quantiles = df.agg(*[F.percentile_approx(quoted(features[i]).cast("double"), marks, 10_000).alias(f"q{i}") for i in many]).first() if many else []
    values.update({i: [*(q or []), math.inf] for i, q in zip(many, quantiles)})
    return [np.array(sorted(set(values[i]))[:-1]) for i in range(len(features))]


def binned(df: DataFrame, features: list[str], label: str, cuts: list[np.ndarray], fold: str | None = None) -> DataFrame:
    """(n, bins, label, fold): blocks of up to BLOCK_ROWS rows; bins are bytes, one feature after the other."""
    total = df.count()
    if not total:
        raise ValueError("no rows to fit")
    blocks = -(-total // BLOCK_ROWS)
    if total * len(features) > CELLS:  # as much for every core
        cores = df.sparkSession.sparkContext.defaultParallelism
        blocks = -(-blocks // cores) * cores
    cols = [quoted(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)]
    rows = df.select(*cols, quoted(label).cast("int").alias("y"), (quoted(fold).cast("int") if fold else F.lit(0)).alias("k"))
    rows = rows.repartition(blocks)
    most = max(1, min(BLOCK_ROWS, CELLS // max(1, len(features))))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def packed():
            bins, y, k = (np.concatenate([h[i] for h in held], axis=-1) for i in range(3))
            columns = [pa.array([len(y)], pa.int32()), *[pa.array([x.tobytes()], pa.binary()) for x in (bins, y, k)]]
            return pa.RecordBatch.from_arrays(columns, ["n", "bins", "label", "fold"])

        for batch in batches:
            for i in range(0, batch.num_rows, most):
                part = batch.slice(i, most)
                bins = np.stack([np.searchsorted(c, part.column(j).to_numpy(zero_copy_only=False)) for j, c in enumerate(cuts)]).astype(np.uint8)
                held.append((bins, *[part.column(len(cuts) + j).to_numpy(zero_copy_only=False).astype(np.int32) for j in (0, 1)]))
                size += part.num_rows
            if size >= BLOCK_ROWS:
                yield packed()
                held, size = [], 0
        if size:
            yield packed()

    return settled(rows.mapInArrow(pack, "n INT, bins BINARY, label BINARY, fold BINARY"))


def _block(batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = batch.column("n")[i].as_py()
    read = [np.frombuffer(batch.column(c)[i].as_buffer(), t) for c, t in (("bins", np.uint8), ("label", np.int32), ("fold", np.int32))]
    return read[0].reshape(-1, n), read[1], read[2]


def node_sums(bins: np.ndarray, features: np.ndarray, widths: np.ndarray, rows: np.ndarray | None, slots: np.ndarray | None, n_slots: int, g, h) -> np.ndarray:
    """[2, slot, bins of all features side by side]: g and h of every slot; without ``rows`` those of all."""
    out = np.empty((2, n_slots, int(widths[features].sum())), np.int64)
    at = 0
    for f in features:
        w = int(widths[f])
        key = bins[f] if rows is None else bins[f][rows]
        key = slots * w + key if n_slots > 1 else key.astype(np.int64)
        for k, x in enumerate((g, h)):
            out[k, :, at : at + w] = np.bincount(key, x, n_slots * w).reshape(n_slots, w)
        at += w
    return out


def best_of_sums(sums: np.ndarray, features: np.ndarray, widths: np.ndarray, min_child: float, penalty: float) -> dict[int, tuple]:
    """slot: (g, h, gain, feature, bin, left g, left h, right g, right h) from sums as `node_sums` gives them; ties go to the first feature and bin.

    The gain is the drop of the penalised loss, doubled: G^2 / (H + penalty) of both sides less that of the node.
    """
    w = widths[features]
    starts = np.cumsum(w) - w
    part = np.repeat(np.arange(len(w)), w)
    run = np.cumsum(sums, axis=2)
    run -= (run[:, :, starts] - sums[:, :, starts])[:, :, part]
    whole = run[:, :, w[0] - 1]
    (gl, hl), (gt, ht) = run / UNIT, whole[:, :, None] / UNIT
    gr, hr = gt - gl, ht - hl
    with np.errstate(invalid="ignore", divide="ignore"):
        gain = gl * gl / (hl + penalty) + gr * gr / (hr + penalty) - gt * gt / (ht + penalty)
    # bins without rows cut like the one before them; after the last one with rows nothing is left
    gain[(sums[1] == 0) | (run[1] == whole[1][:, None]) | (hl < min_child) | (hr < min_child)] = -np.inf
    first = gain.argmax(axis=1)
    at = np.arange(int(w.sum())) - starts[part]
    return {
        s: (gt[s, 0], ht[s, 0], gain[s, i], features[part[i]], at[i], gl[s, i], hl[s, i], gr[s, i], hr[s, i]) for s, i in enumerate(first.tolist())
    }


@dataclass
class Ask:
    """Sums that a model needs next: those of some nodes of the tree that grows."""

    tree: Tree
    level: int
    nodes: list[int]
    features: np.ndarray

    def rows(self, node: np.ndarray, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows of the asked nodes, number of the node of each)."""
        slot_of = np.full(len(self.tree.feature), -1)
        slot_of[self.nodes] = np.arange(len(self.nodes))
        slots = slot_of[node]
        rows = np.flatnonzero((slots >= 0) & train)
        return rows, slots[rows]


def planned(settings: Settings, widths: np.ndarray):
    """The growth of a model as a generator: it yields what it asks for, is sent the sums, and returns the trees.

    Of two children only the one with less weight is asked for; the other is the rest of their parent.
    """
    growth = Growth(settings, len(widths))
    while not growth.done:
        held, fresh = None, False
        while not fresh:
            tree, frontier, features = growth.tree, growth.frontier, growth.features
            pairs, chosen = [], frontier
            if held:
                known, sums = held
                open_ = set(frontier)
                pairs = [(i, tree.left[p], tree.right[p]) for i, p in enumerate(known) if tree.left[p] in open_ or tree.right[p] in open_]
                chosen = [left if tree.hess[left] <= tree.hess[right] else right for _, left, right in pairs]
            own = yield Ask(tree, growth.level, chosen, features)
            if pairs:
                rest = sums[:, [i for i, *_ in pairs]] - own
                place = {x: (k, j) for j, (_, left, right) in enumerate(pairs) for k, x in enumerate((chosen[j], left + right - chosen[j]))}
                at = np.array([place[x] for x in frontier])
                own = np.stack([own, rest])[at[:, 0], :, at[:, 1]].transpose(1, 0, 2)
            if not growth.level and not own[1].any():
                raise ValueError("no rows to fit")
            held = frontier, own
            best = best_of_sums(own, features, widths, settings.min_child, settings.penalty)
            fresh = growth.take({frontier[i]: x for i, x in best.items()})
    return growth.trees


def best_of_cells(sums: np.ndarray, total: np.ndarray, starts: np.ndarray, min_child: float, penalty: float) -> tuple[np.ndarray, ...]:
    """(gain, feature, bin, left sum) of the best split of each node; a gain of -inf where there is none.

    As `best_of_sums`, of (node, cell) sums whose real parts are gradients and whose imaginary parts are hessians.
    ``total``: the sum of each node. ``starts``: the first cell of each feature. Only cells with rows are looked at.
    """
    n, size = sums.shape
    out = np.full(n, -np.inf), np.full(n, -1, np.int32), np.full(n, -1, np.int32), np.zeros(n, complex)
    flat, k = sums.ravel(), len(starts)
    cells = np.flatnonzero(flat.imag != 0)
    begins = np.searchsorted(cells, (np.arange(n)[:, None] * size + starts).ravel())
    run = flat.take(cells)
    run[begins[1:]] -= np.repeat(total, k)[:-1]  # all features have the same sum, so each begins anew
    run = run.cumsum()
    least, begins = min_child * UNIT, begins[::k]
    ok = run.imag >= least
    ok &= np.repeat(total.imag, np.diff(begins, append=len(run))) - run.imag >= max(least, 1.0)
    counts = np.add.reduceat(ok, begins, dtype=np.int64)
    valid = np.flatnonzero(ok)
    if not len(valid):
        return out
    run = run.take(valid)

    def loss(g, h):
        g *= g
        h += penalty
        g /= h
        return g

    gl, hl, gt, ht = run.real / UNIT, run.imag / UNIT, total.real / UNIT, total.imag / UNIT
    gr, hr = np.repeat(gt, counts) - gl, np.repeat(ht, counts) - hl
    gain = loss(gl, hl)
    gain += loss(gr, hr)
    gain -= np.repeat(loss(gt, ht), counts)
    some = np.flatnonzero(counts)
    counts = counts[some]
    begins = np.cumsum(counts) - counts
    top = np.maximum.reduceat(gain, begins)
    hits = np.flatnonzero(gain == np.repeat(top, counts))
    hits = hits[np.searchsorted(hits, begins)]  # ties go to the first feature and bin
    cell = cells[valid[hits]] - some * size
    feature = np.searchsorted(starts, cell, "right") - 1
    for x, y in zip(out, (top, feature, cell - starts[feature], run[hits])):
        x[some] = y
    return out


class Cells:
    """Rows of some features of one tree, and sums over their nodes, feature and bins side by side."""

    def __init__(self, bins: np.ndarray, widths: np.ndarray, pairs: np.ndarray):
        self.bins, self.pairs, self.size = bins, pairs, int(widths.sum())
        self.starts = np.cumsum(widths) - widths

    def sums(self, rows: np.ndarray | None, slots: np.ndarray | None, n_slots: int) -> np.ndarray:
        """[slot, cell]: sums of the pairs of some rows, of all without ``rows``."""
        out = np.zeros(n_slots * self.size, complex)
        pairs = self.pairs if rows is None else self.pairs[rows]
        base = None if slots is None else slots * self.size
        for bins, start in zip(self.bins, self.starts.tolist()):
            key = bins if rows is None else bins[rows]
            np.add.at(out[start:], key.astype(np.int64) if base is None else base + key, pairs)
        return out.reshape(n_slots, self.size)

    def by_slot(self, rows: np.ndarray, slots: np.ndarray, n_slots: int):
        """Sums of at most SLAB_CELLS cells at a time: (slots from, to, sums)."""
        step = max(1, SLAB_CELLS // self.size)
        if n_slots <= step:
            yield 0, n_slots, self.sums(rows, slots, n_slots)
            return
        order = np.argsort(slots.astype(np.min_scalar_type(n_slots)), kind="stable")
        rows, slots = rows[order], slots[order]
        ends = np.searchsorted(slots, np.arange(n_slots + 1))
        for a in range(0, n_slots, step):
            b = min(a + step, n_slots)
            own = slice(ends[a], ends[b])
            yield a, b, self.sums(rows[own], slots[own] - a, b - a)


def grown(cells: Cells, slots: np.ndarray | None, levels: np.ndarray, settings: Settings) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """(node columns of the trees below some roots, node of every row): level by level, the roots first.

    ``slots``: the root of every row; without them there is one root. ``levels``: the levels that may follow each root.
    Features are numbered as in ``cells``. While nodes hold many rows, the sums of a level are kept for the next one (at
    most DENSE_CELLS cells): of two children only the one with less weight is summed, the other is the rest of their parent.
    """
    pairs, n, roots, size = cells.pairs, len(cells.pairs), len(levels), cells.size
    flat, least = cells.bins.ravel(), 2 * settings.min_child * UNIT
    if slots is None:
        total, node = np.array([pairs.sum()]), np.zeros(n, np.uint8)
    else:
        total, node = np.bincount(slots, pairs.real, roots) + 1j * np.bincount(slots, pairs.imag, roots), slots.astype(np.int32)
    sums, columns = [total], {k: [] for k in ("feature", "bin", "left", "gain")}
    frontier = np.flatnonzero(levels > 0)
    deep, total = levels[frontier], total[frontier]
    rows = slot = held = known = None  # without ``rows`` all rows are asked for, or are numbered by byte in ``node``
    first, count = 0, roots

    def places(number, of):
        """(rows, number) of those whose node has one."""
        own = number.take(of)
        some = np.flatnonzero(own >= 0)
        return some, own.take(some)

    if slots is not None:
        number = np.full(roots, -1)
        number[frontier] = np.arange(len(frontier))
        rows, slot = places(number, slots)
    while len(frontier):
        k = len(frontier)
        gain, feature, bin_, left = np.empty(k), np.empty(k, np.int64), np.empty(k, np.int64), np.empty(k, complex)
        many = n if rows is None else len(rows)
        keep = np.empty((k, size), complex) if k * size <= min(DENSE_CELLS, many * len(cells.bins)) else None

        def judge(where, own):
            gain[where], feature[where], bin_[where], left[where] = best_of_cells(own, total[where], cells.starts, settings.min_child, settings.penalty)
            if keep is not None:
                keep[where] = own

        if known is not None:
            parent, small, other, few, few_slots = known
            for a, b, own in cells.by_slot(few, few_slots, len(parent)):
                is_open = np.flatnonzero(small[a:b] >= 0)
                if len(is_open):
                    judge(small[a:b][is_open], own if len(is_open) == b - a else own[is_open])
                is_open = np.flatnonzero(other[a:b] >= 0)
                if len(is_open):
                    rest = held[parent[a:b][is_open]]
                    rest -= own if len(is_open) == b - a else own[is_open]
                    judge(other[a:b][is_open], rest)
        elif rows is None and not first:
            judge(np.arange(1), cells.sums(None, None, 1))
        else:
            if rows is None:
                number = np.full(first + count, -1)
                number[frontier] = np.arange(k)
                rows, slot = places(number, node)
            for a, b, own in cells.by_slot(rows, slot, k):
                judge(np.arange(a, b), own)
        split = np.flatnonzero(gain > max(LEAST_GAIN, settings.gamma))
        children = np.stack([left[split], total[split] - left[split]], 1).ravel()
        below = first + count + 2 * np.arange(len(split))
        for name, x in (("feature", feature[split]), ("bin", bin_[split]), ("gain", gain[split]), ("left", below)):
            column = np.full(count, 0.0 if name == "gain" else -1, np.float64 if name == "gain" else np.int32)
            column[frontier[split] - first] = x
            columns[name].append(column)
        sums.append(children)
        deep = np.repeat(deep[split] - 1, 2)
        is_open = (children.imag >= least) & (deep > 0)  # less weight than two children must have: it stays a leaf
        place = np.where(is_open, np.cumsum(is_open) - 1, -1)
        asked = np.flatnonzero(place.reshape(-1, 2).max(axis=1) >= 0)
        light = (children.imag[::2] > children.imag[1::2]).astype(np.int64)
        number = np.full(len(children), -1)
        number[2 * asked + light[asked]] = np.arange(len(asked))
        few = None
        # rows of split nodes go on to the children
        if node.dtype == np.uint8 and first + count + len(children) <= 256:
            for s, f, at, left in zip(frontier[split].tolist(), feature[split].tolist(), bin_[split].tolist(), below.tolist()):
                own = node == s
                node += own.view(np.uint8) * np.uint8(left - s)
                own &= cells.bins[f] > at
                node += own.view(np.uint8)
            rows = slot = None
            if keep is not None and len(asked):
                number = np.concatenate([np.full(first + count, -1), number])
                few = places(number, node)
        else:
            if rows is None:
                by = np.full(first + count, -1)
                by[frontier] = np.arange(k)
                rows, slot = places(by, node)
            if node.dtype == np.uint8:
                node = node.astype(np.int32)
            of = np.full(k, -1)
            of[split] = np.arange(len(split))
            some, at = places(of, slot)
            rows = rows.take(some)
            cell = (feature[split] * n).take(at)
            cell += rows
            child = 2 * at
            child += flat.take(cell) > bin_[split].astype(np.uint8).take(at)
            node[rows] = first + count + child
            if keep is not None and len(asked):
                few, few_slots = places(number, child)
                few = rows.take(few), few_slots
            some, slot = places(place, child)
            rows = rows.take(some)
        known = None
        if few is not None:
            two = place.reshape(-1, 2)
            known = split[asked], two[asked, light[asked]], two[asked, 1 - light[asked]], *few
        first, count, held = first + count, len(children), keep
        frontier, deep, total = first + np.flatnonzero(is_open), deep[is_open], children[is_open]
    for name, column in columns.items():
        column.append(np.full(count, 0.0 if name == "gain" else -1, np.float64 if name == "gain" else np.int32))
    out = {name: np.concatenate(column) for name, column in columns.items()}
    whole = np.concatenate(sums) / UNIT
    right = np.where(out["left"] >= 0, out["left"] + 1, -1).astype(np.int32)
    return {**out, "right": right, "grad": whole.real.copy(), "hess": whole.imag.copy()}, node


def grown_tree(bins: np.ndarray, widths: np.ndarray, pairs: np.ndarray, features: np.ndarray, settings: Settings) -> tuple[Tree, np.ndarray]:
    """(a tree, the node of every row) where all rows are at hand."""
    cells = Cells(bins[features], widths[features], pairs)
    columns, node = grown(cells, None, np.array([settings.depth]), settings)
    columns["feature"] = np.where(columns["feature"] >= 0, features[columns["feature"]], -1).astype(np.int32)
    return Tree.of(columns).finished(settings.penalty), node


def fit_block(bins: np.ndarray, label: np.ndarray, fold: np.ndarray, settings: Settings) -> tuple[np.ndarray, list[Tree]]:
    """Margins of all rows and the trees of a model whose rows are all in one task."""
    train, rest = np.flatnonzero(fold != settings.fold), np.flatnonzero(fold == settings.fold)
    if settings.rounds and not len(train):
        raise ValueError("no rows to fit")
    widths = bins.max(axis=1, initial=0).astype(np.int64) + 1
    own, others, label = np.ascontiguousarray(bins[:, train]), np.ascontiguousarray(bins[:, rest]), label[train]
    weight = np.where(label > 0, settings.positive, 1.0)
    margin, left_out, pairs, trees = np.zeros(len(train)), np.zeros(len(rest)), np.empty(len(train), complex), []
    for t in range(settings.rounds):
        pairs.real, pairs.imag = gradients(margin, label, settings.positive, weight)
        tree, node = grown_tree(own, widths, pairs, settings.features(t, len(bins)), settings)
        margin += settings.rate * tree.value[node]
        if len(rest):
            left_out += settings.rate * tree.value[tree.leaves(others, settings.depth)]
        trees.append(tree)
    out = np.empty(len(fold))
    out[train], out[rest] = margin, left_out
    return out, trees


_MARGINS = "model INT, n INT, label BINARY, fold BINARY, margin BINARY, trees BINARY"


def fit_many(
    blocks: DataFrame, models: list[Settings], features: int, keep_trees: bool = True, left_out: bool = False
) -> tuple[DataFrame, list[list[Tree]]]:
    """(margins, trees of each model): margins are blocks (model, n, label, fold, margin) of all rows, left-out ones too.

    With ``left_out`` the margins may be those of the rows that a model did not see, and no others. Up to CELLS cells
    the models are dealt to tasks that hold all blocks. Larger tables stay dealt: a level of the models whose sums
    have a bounded size is one stage over kept blocks; deeper models shuffle the rows of their lower nodes once a tree.
    """
    n, count = blocks.agg(F.sum("n"), F.count(F.lit(1))).first()
    if (n or 0) * features <= CELLS:
        return _fit_whole(blocks, models, keep_trees, left_out)
    cells = [2 ** max(0, s.depth - 2) * features * MAX_BINS for s in models]
    cores = blocks.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, min(cores, -(-count // TASK_BLOCKS)))
    most = max(1, MODEL_ROWS * tasks // n)
    groups: list[list[int]] = []
    for m in sorted((m for m, c in enumerate(cells) if c <= MESSAGE_CELLS), key=lambda m: (models[m].depth, m)):
        if not groups or len(groups[-1]) >= most or sum(cells[i] for i in groups[-1]) + cells[m] > MESSAGE_CELLS:
            groups.append([])
        groups[-1].append(m)
    found = [(own, *_fit_by_sums(blocks, [models[m] for m in own], features, tasks, left_out)) for own in groups]
    deep = [m for m, c in enumerate(cells) if c > MESSAGE_CELLS]
    for i in range(0, len(deep), most):
        own = deep[i : i + most]
        found.append((own, *_fit_by_parts(blocks, [models[m] for m in own], features, tasks, left_out)))
    trees: list[list[Tree]] = [[] for _ in models]
    out = None
    for own, margins, grown in found:
        for m, t in zip(own, grown):
            trees[m] = t
        if own != list(range(len(own))):
            margins = margins.withColumn("model", F.get(F.array(*map(F.lit, own)), F.col("model")))
        out = margins if out is None else out.unionByName(margins)
    return out, trees


def _joined(held: list[tuple], features: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Blocks laid end to end."""
    if not held:
        return np.zeros((features, 0), np.uint8), np.zeros(0, np.int32), np.zeros(0, np.int32)
    return tuple(np.concatenate([h[i] for h in held], axis=-1) for i in range(3))


def _narrow(x: np.ndarray) -> np.ndarray:
    """The same whole numbers in as few bytes as they need."""
    return x.astype(np.promote_types(*(np.min_scalar_type(v) for v in (x.min(initial=0), x.max(initial=0)))))


def _margin_rows(m: int, settings: Settings, label, fold, margin, trees: bytes, left_out: bool) -> Iterator[pa.RecordBatch]:
    own = np.flatnonzero(fold == settings.fold) if left_out else np.arange(len(fold))
    for i in range(0, max(1, len(own)), BLOCK_ROWS):
        rows = own[i : i + BLOCK_ROWS]
        data = [label[rows].tobytes(), fold[rows].tobytes(), margin[rows].tobytes(), trees if i == 0 else b""]
        columns = [pa.array([m], pa.int32()), pa.array([len(rows)], pa.int32()), *[pa.array([x], pa.binary()) for x in data]]
        yield pa.RecordBatch.from_arrays(columns, ["model", "n", "label", "fold", "margin", "trees"])


def _with_trees(found: DataFrame, models: list[Settings], keep_trees: bool) -> tuple[DataFrame, list[list[Tree]]]:
    trees: list[list[Tree]] = [[] for _ in models]
    if keep_trees:
        for r in found.filter(F.length("trees") > 0).select("model", "trees").collect():  # as large as the models
            trees[r["model"]] = [Tree.of(columns) for columns in pickle.loads(r["trees"])]
    return found.drop("trees"), trees


def _fit_whole(blocks: DataFrame, models: list[Settings], keep_trees: bool, left_out: bool) -> tuple[DataFrame, list[list[Tree]]]:
    """The models are dealt to tasks; each task holds all blocks."""
    groups = max(1, min(len(models), 4 * blocks.sparkSession.sparkContext.defaultParallelism))
    # dear models first and dealt round, so that no group gets all of them
    order = sorted(range(len(models)), key=lambda m: -models[m].depth * models[m].rounds)
    share = [order[g::groups] for g in range(groups)]

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                held.setdefault(batch.column("part")[i].as_py(), []).append(_block(batch, i))
        for part, own in held.items():
            bins, label, fold = _joined(own, 0)
            for m in share[part]:
                margin, trees = fit_block(bins, label, fold, models[m])
                yield from _margin_rows(m, models[m], label, fold, margin, pickle.dumps([vars(t) for t in trees]) if keep_trees else b"", left_out)

    dealt = blocks.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).repartitionByRange(groups, "part")
    return _with_trees(settled(dealt.mapInArrow(grow, _MARGINS)), models, keep_trees)


def _kept(blocks: DataFrame, models: int, features: int, tasks: int):
    """(bins, label, fold, margins) of each task's rows, kept by the executors, and the number of bins of each feature.

    Every stage reads the kept blocks, so they are small and kept as they are: serialised ones would be read through Java's streams.
    """
    dealt = blocks.withColumn("part", F.monotonically_increasing_id()).repartitionByRange(tasks, "part")

    def held(rows):
        read = [[np.frombuffer(r[c], t) for c, t in (("bins", np.uint8), ("label", np.int32), ("fold", np.int32))] for r in rows]
        bins, label, fold = _joined([(b.reshape(features, -1), y, k) for b, y, k in read], features)
        yield bins, _narrow(label), _narrow(fold), np.zeros((models, len(label)))

    state = dealt.rdd.mapPartitions(held).persist(StorageLevel.MEMORY_AND_DISK_DESER)
    tops = state.map(lambda part: part[0].max(axis=1, initial=0).astype(np.int64)).map(lambda x: x[None])
    return state, tops.reduce(np.maximum)[0] + 1


def _grown_margins(margin: np.ndarray, bins: np.ndarray, models: list[Settings], pending: dict[int, list[Tree]]) -> np.ndarray:
    if any(pending.values()):
        margin = margin.copy()
        for m, trees in pending.items():
            for tree in trees:
                margin[m] += models[m].rate * tree.value[tree.leaves(bins, models[m].depth)]
    return margin


def _kept_margins(spark: SparkSession, state, models: list[Settings], pending: dict[int, list[Tree]], left_out: bool) -> DataFrame:
    """The margins of kept blocks with those of the last trees, written to the shared folder."""
    def rows(part):
        bins, label, fold, margin = part
        margin = _grown_margins(margin, bins, models, pending)
        for m, s in enumerate(models):
            own = np.flatnonzero(fold == s.fold) if left_out else np.arange(len(fold))
            for i in range(0, len(own), BLOCK_ROWS):
                at = own[i : i + BLOCK_ROWS]
                yield m, len(at), *[bytearray(x[at].astype(t).tobytes()) for x, t in ((label, np.int32), (fold, np.int32), (margin[m], np.float64))]

    found = settled(spark.createDataFrame(state.flatMap(rows), "model INT, n INT, label BINARY, fold BINARY, margin BINARY"))
    state.unpersist()
    return found


def _added(parts, tasks: int) -> np.ndarray:
    return parts.treeReduce(np.add) if tasks > 64 else reduce(np.add, parts.collect())


def _fit_by_sums(blocks: DataFrame, models: list[Settings], features: int, tasks: int, left_out: bool) -> tuple[DataFrame, list[list[Tree]]]:
    """All models level by level over blocks kept by the executors; a level is one stage, whose tasks send one array each."""
    state, widths = _kept(blocks, len(models), features, tasks)
    plans = {m: planned(s, widths) for m, s in enumerate(models)}
    asked = {m: next(plan) for m, plan in plans.items()}
    grown_: list[list[Tree]] = [[] for _ in models]
    pending: dict[int, list[Tree]] = {m: [] for m in plans}
    old, updates = [], 0
    while asked:
        if sum(map(len, pending.values())) >= max(REFRESH, 2 * len(asked)):
            old.append(state)
            done = {m: list(trees) for m, trees in pending.items()}
            state = state.map(lambda part, done=done: (*part[:3], _grown_margins(part[3], part[0], models, done))).persist(StorageLevel.MEMORY_AND_DISK_DESER)
            pending, updates = {m: [] for m in plans}, updates + 1
            if not updates % LINEAGE:
                state.checkpoint()

        def sums(part, asked=asked, pending=pending):
            bins, label, fold, margin = part
            found = []
            for m, ask in asked.items():
                train = fold != models[m].fold
                if ask.level:  # margins are brought up to date for the asked rows only
                    rows, slots = ask.rows(ask.tree.leaves(bins, ask.level), train)
                    own, train = np.empty((features, len(rows)), np.uint8), 1.0
                    for f in {*ask.features.tolist(), *(f for tree in pending[m] for f in tree.feature.tolist() if f >= 0)}:
                        np.take(bins[f], rows, out=own[f], mode="clip")
                    now, y = margin[m][rows], label[rows]
                else:
                    own, slots, now, y = bins, None, margin[m], label
                for tree in pending[m]:
                    now = now + models[m].rate * tree.value[tree.leaves(own, models[m].depth)]
                g, h = (x * train for x in gradients(now, y, models[m].positive))
                found.append(node_sums(own, ask.features, widths, None, slots, len(ask.nodes), g, h).ravel())
            return np.concatenate(found)

        total = _added(state.map(sums), tasks)
        for rdd in old:
            rdd.unpersist()
        old, at, more = [], 0, {}
        for m, ask in asked.items():
            shape = 2, len(ask.nodes), int(widths[ask.features].sum())
            end = at + math.prod(shape)
            try:
                more[m] = plans[m].send(total[at:end].reshape(shape))
            except StopIteration:
                pass
            at = end
            if ask.tree.value is not None:
                grown_[m].append(ask.tree)
                pending[m].append(ask.tree)
        asked = more
    return _kept_margins(blocks.sparkSession, state, models, pending, left_out), grown_


@dataclass
class Crown:
    """The upper part of a tree that grows: nodes of many rows whose sums are asked for, and roots of what is grown below."""

    tree: Tree
    features: np.ndarray
    level: int = 0
    wide: list[int] = field(default_factory=lambda: [0])
    roots: list[tuple[int, int, float]] = field(default_factory=list)
    """(node, levels that may follow, about how many rows)."""

    def take(self, found: dict[int, tuple], settings: Settings, most: int) -> None:
        """Split the wide nodes of a level. ``found``: of each the rows and `best_of_sums`. Children of nodes with at most ``most`` rows are roots."""
        tree, wide = self.tree, []
        for node in self.wide:
            rows, (g, h, gain, feature, at, *sums) = found[node]
            if self.level == 0:
                tree.grad[0], tree.hess[0] = g, h
            if gain <= max(LEAST_GAIN, settings.gamma):
                continue
            for c in tree.split(node, int(feature), int(at), gain, tuple(sums)):
                if tree.hess[c] >= 2 * settings.min_child and self.level + 1 < settings.depth:
                    if rows > most:
                        wide.append(c)
                    else:
                        self.roots.append((c, settings.depth - self.level - 1, rows * tree.hess[c] / max(h, 1e-9)))
        self.wide, self.level = wide, self.level + 1

    def whole(self, parts: list[tuple[list[int], dict[str, np.ndarray]]], penalty: float) -> Tree:
        """The tree with what grew below its roots; nodes are numbered level by level, as if it had grown so."""
        names = ("feature", "bin", "left", "right", "grad", "hess", "gain")
        laid = {k: [np.array(getattr(self.tree, k))] for k in names}
        end = len(self.tree.feature)
        for roots, columns in parts:
            number = np.concatenate([roots, end + np.arange(len(columns["feature"]) - len(roots))]).astype(np.int64)
            for k in names:
                column = columns[k]
                if k in ("left", "right"):
                    column = np.where(column >= 0, number[column], -1)
                laid[k][0][roots] = column[: len(roots)]
                laid[k].append(column[len(roots) :])
            end += len(number) - len(roots)
        laid = {k: np.concatenate(x) for k, x in laid.items()}
        order = [np.zeros(1, np.int64)]
        while len(order[-1]):
            split = order[-1][laid["left"][order[-1]] >= 0]
            order.append(np.stack([laid["left"][split], laid["right"][split]], 1).ravel())
        order = np.concatenate(order)
        number = np.full(len(order) + 1, -1)
        number[order] = np.arange(len(order))
        return Tree.of({k: number[x[order]] if k in ("left", "right") else x[order] for k, x in laid.items()}).finished(penalty)


def _fit_by_parts(blocks: DataFrame, models: list[Settings], features: int, tasks: int, left_out: bool) -> tuple[DataFrame, list[list[Tree]]]:
    """Deep trees over blocks kept by the executors: two steps a tree.

    Levels of nodes with many rows are summed as in `_fit_by_sums`; so many rows that there are few such nodes, and a stage
    asks for at most MESSAGE_CELLS sums. The rows of all other nodes are then shuffled once, each node to one task, which grows
    what is below it to its end. Nodes go by their size, so that tasks get about as many rows.
    """
    state, widths = _kept(blocks, len(models), features, tasks)
    trees: list[list[Tree]] = [[] for _ in models]
    pending: dict[int, list[Tree]] = {}
    for t in range(max(s.rounds for s in models)):
        old = None
        if pending:
            old = state
            state = state.map(lambda part, done=pending: (*part[:3], _grown_margins(part[3], part[0], models, done))).persist(StorageLevel.MEMORY_AND_DISK_DESER)
            if not t % LINEAGE:
                state.checkpoint()
        crowns = {m: Crown(Tree(), s.features(t, features)) for m, s in enumerate(models) if t < s.rounds}
        while any(c.wide for c in crowns.values()):
            found: dict[int, dict[int, tuple]] = {m: {} for m in crowns}
            ask: dict[int, list[int]] = {}
            room_left = MESSAGE_CELLS
            todo = [(m, node, int(widths[c.features].sum())) for m, c in crowns.items() for node in c.wide]
            for i, (m, node, size) in enumerate(todo):
                ask.setdefault(m, []).append(node)
                room_left -= size
                if i + 1 == len(todo) or room_left < todo[i + 1][2]:
                    asked = {m: Ask(crowns[m].tree, crowns[m].level, nodes, crowns[m].features) for m, nodes in ask.items()}
                    for m, own in _sums_of(state, models, widths, asked, tasks).items():
                        found[m].update(own)
                    ask, room_left = {}, MESSAGE_CELLS
            for m, c in crowns.items():
                if c.wide:
                    c.take(found[m], models[m], PART_ROWS)
        below = _grown_below(state, models, widths, crowns, tasks)
        if old is not None:
            old.unpersist()
        pending = {m: [c.whole(below.get(m, []), models[m].penalty)] for m, c in crowns.items()}
        for m, (tree,) in pending.items():
            trees[m].append(tree)
    return _kept_margins(blocks.sparkSession, state, models, pending, left_out), trees


def _sums_of(state, models: list[Settings], widths: np.ndarray, asked: dict[int, Ask], tasks: int) -> dict[int, dict[int, tuple]]:
    """Of every asked node: its rows and its best split."""
    def sums(part):
        bins, label, fold, margin = part
        found = []
        for m, ask in asked.items():
            rows, slots = ask.rows(ask.tree.leaves(bins, ask.level), fold != models[m].fold)
            g, h = gradients(margin[m][rows], label[rows], models[m].positive)
            found.append(np.bincount(slots, minlength=len(ask.nodes)))
            found.append(node_sums(bins, ask.features, widths, rows, slots, len(ask.nodes), g, h).ravel())
        return np.concatenate(found)

    total, at, out = _added(state.map(sums), tasks), 0, {}
    for m, ask in asked.items():
        k, size = len(ask.nodes), int(widths[ask.features].sum())
        counts, own = total[at : at + k], total[at + k : at + k + 2 * k * size].reshape(2, k, size)
        at += k + 2 * k * size
        if not ask.level and not own[1].any():
            raise ValueError("no rows to fit")
        best = best_of_sums(own, ask.features, widths, models[m].min_child, models[m].penalty)
        out[m] = {node: (int(counts[i]), best[i]) for i, node in enumerate(ask.nodes)}
    return out


def _grown_below(state, models: list[Settings], widths: np.ndarray, crowns: dict[int, Crown], tasks: int) -> dict[int, list[tuple]]:
    """(roots, node columns of the trees below them) of every model, from tasks that hold all rows of their roots."""
    roots = [(rows, m, node, levels) for m, c in crowns.items() for node, levels, rows in c.roots]
    if not roots:
        return {}
    parts = max(tasks, math.ceil(sum(r[0] for r in roots) / PART_ROWS))
    load = [(0.0, p) for p in range(parts)]
    place: dict[int, dict[int, tuple[int, int]]] = {}
    for rows, m, node, levels in sorted(roots, key=lambda r: (-r[0], r[1:])):  # the largest first, each to the task with the fewest rows
        held, p = heapq.heappop(load)
        heapq.heappush(load, (held + rows, p))
        place.setdefault(m, {})[node] = p, levels
    views = {m: (crowns[m].tree, crowns[m].level, crowns[m].features) for m in place}

    def send(part):
        bins, label, fold, margin = part
        for m, (tree, level, chosen) in views.items():
            to = np.full(len(tree.feature), -1)
            to[list(place[m])] = [p for p, _ in place[m].values()]
            node = tree.leaves(bins, level)
            task = to.take(node)
            rows = np.flatnonzero((task >= 0) & (fold != models[m].fold))
            rows = rows[np.argsort(task[rows], kind="stable")]
            ends = np.searchsorted(task[rows], np.arange(parts + 1))
            g, h = gradients(margin[m][rows], label[rows], models[m].positive)
            for p in range(parts):
                own = slice(ends[p], ends[p + 1])
                if ends[p] < ends[p + 1]:
                    yield p, (m, node[rows[own]], bins[chosen][:, rows[own]], _narrow(g[own].astype(np.int64)), _narrow(h[own].astype(np.int64)))

    def grow(sent):
        held: dict[int, list] = {}
        for _, (m, *own) in sent:
            held.setdefault(m, []).append(own)
        for m, own in held.items():
            node, bins, g, h = (np.concatenate([x[i] for x in own], axis=-1) for i in range(4))
            own_roots, slots = np.unique(node, return_inverse=True)
            pairs = np.empty(len(node), complex)
            pairs.real, pairs.imag = g, h
            chosen = views[m][2]
            columns, _ = grown(Cells(bins, widths[chosen], pairs), slots, np.array([place[m][r][1] for r in own_roots.tolist()]), models[m])
            columns["feature"] = np.where(columns["feature"] >= 0, chosen[columns["feature"]], -1)
            yield m, own_roots.tolist(), columns

    out: dict[int, list[tuple]] = {}
    for m, own_roots, columns in state.flatMap(send).partitionBy(parts, lambda p: p).mapPartitions(grow).collect():  # as large as a tree
        out.setdefault(m, []).append((own_roots, columns))
    return out


def left_out_scores(margins: DataFrame, models: list[Settings]) -> DataFrame:
    """(model, fold, label, score) of the rows that each model did not see."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                m = batch.column("model")[i].as_py()
                label, fold, margin = (np.frombuffer(batch.column(c)[i].as_buffer(), t) for c, t in (("label", np.int32), ("fold", np.int32), ("margin", np.float64)))
                own = np.flatnonzero(fold == models[m].fold)
                score = 1.0 / (1.0 + np.exp(-margin[own]))
                columns = [np.full(len(own), m, np.int32), fold[own], label[own], score]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["model", "fold", "label", "score"])

    return margins.mapInArrow(unpack, "model INT, fold INT, label INT, score DOUBLE")


class Ensemble:
    """A fitted booster: node arrays of its trees, with thresholds instead of bins."""

    NODES = "tree INT, node INT, tree_weight DOUBLE, value DOUBLE, cover DOUBLE, gain DOUBLE, left INT, right INT, feature INT, threshold DOUBLE"

    def __init__(self, nodes: list[np.ndarray], features: list[str]):
        """``nodes``: the columns of NODES."""
        self.nodes, self.features = nodes, features

    @staticmethod
    def of(trees: list[Tree], cuts: list[np.ndarray], rate: float, features: list[str]) -> Ensemble:
        sizes = [t.numNodes for t in trees]

        def all_of(name):
            return np.concatenate([getattr(t, name) for t in trees])

        feature, at = all_of("feature"), all_of("bin")
        threshold = np.array([cuts[f][b] if f >= 0 else 0.0 for f, b in zip(feature, at)])
        number = [np.repeat(np.arange(len(trees), dtype=np.int32), sizes), np.concatenate([np.arange(n, dtype=np.int32) for n in sizes])]
        # log-odds are twice the weighted sum of the trees, the convention of half the log-odds
        weight = np.full(len(feature), rate / 2)
        return Ensemble([*number, weight, all_of("value"), all_of("hess"), all_of("gain"), all_of("left"), all_of("right"), feature, threshold], features)

    def node_table(self, spark: SparkSession) -> DataFrame:
        names = [c.split()[0] for c in self.NODES.split(", ")]
        return spark.createDataFrame(pa.table(dict(zip(names, map(pa.array, self.nodes)))), self.NODES)

    def save(self, path: str, spark: SparkSession) -> None:
        self.node_table(spark).coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str, features: list[str]) -> Ensemble:
        table = spark.read.parquet(path).orderBy("tree", "node").toArrow()
        return Ensemble([c.to_numpy() for c in table.columns], features)

    @property
    def trees(self) -> list[np.ndarray]:
        """The nodes of each tree."""
        return [TreeNodes(rows) for rows in np.split(np.arange(len(self.nodes[0])), np.flatnonzero(np.diff(self.nodes[0])) + 1)]

    @property
    def featureImportances(self):  # noqa: N802 the name that tree models have
        """Share of the total gain."""
        split = self.nodes[6] >= 0
        gains = np.bincount(self.nodes[8][split], self.nodes[5][split], len(self.features))
        return Vectors.dense(gains / gains.sum() if gains.any() else gains)

    def margins(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of rows; those with a missing value have none."""
        tree, _, weight, value, _, _, left, right, feature, threshold = self.nodes
        start = np.flatnonzero(np.append(True, tree[1:] != tree[:-1]))
        out = np.zeros(len(x))
        rows = np.arange(len(x))
        for s in start:
            node = np.zeros(len(x), np.int64)
            while True:
                at = s + node
                inner = np.flatnonzero(left[at] >= 0)
                if not len(inner):
                    break
                own = at[inner]
                node[inner] = np.where(x[rows[inner], feature[own]] <= threshold[own], left[own], right[own])
            out += 2 * weight[s] * value[s + node]
        out[np.isnan(x).any(axis=1)] = np.nan
        return out

    def transform(self, df: DataFrame, out: str = "score") -> DataFrame:
        """Add the probability of the positive class; NULL where a feature is."""
        own = self
        values = F.array(*[F.coalesce(quoted(c).cast("double"), F.lit(float("nan"))) for c in self.features])

        @F.pandas_udf("double")
        def probability(x):
            import pandas as pd

            margin = own.margins(np.stack(x.to_numpy())) if len(x) else np.empty(0)
            return pd.Series(1.0 / (1.0 + np.exp(-margin)))

        return df.withColumn(out, F.nanvl(probability(values), F.lit(None).cast("double")))


class TreeNodes:
    def __init__(self, rows: np.ndarray):
        self.numNodes = len(rows)


def fit(df: DataFrame, features: list[str], label: str, params: dict, rounds: int = 100, seed: int = 100) -> Ensemble:
    settings = Settings.of(params, rounds, seed)
    cuts = fit_cuts(df, features)
    _, trees = fit_many(binned(df, features, label, cuts), [settings], len(features))
    return Ensemble.of(trees[0], cuts, settings.rate, features)
