"""Second-order boosted trees with leaf penalties, from gradient histograms summed in Spark.

The features are binned once, to a byte each, in a written table of blocks (``BinnedMatrix``).
Any number of fits share it: each names its label, its weights (0 leaves a row out, so subsets
are masks) and the rows it is validated on. They grow in lockstep, level by level: a job
lets every partition add up the gradients and curvatures of its rows by (fit, class, node,
feature, bin). The sums are shuffled by node and a few features, added up and searched in tasks;
only the numbers of the best split of each come back, one record a task. There are as many tasks as cores,
or as sums to add up, so what the driver gets does not depend on rows, files or bins.

A split gains ``s(L) + s(R) - s(L + R)`` with ``s = max(|G| - l1, 0)^2 / (H + l2) / 2``, and a leaf weighs
``-sign(G) max(|G| - l1, 0) / (H + l2)`` times the rate. Objectives are squared error, logistic, and softmax
with one tree per class and round. Rows are sampled by a hash of their key, columns per tree.
With ``patience`` a fit stops when its held-back rows have not improved for so many rounds,
and keeps the rounds up to the best one.

Margins are kept next to the blocks and renewed every few rounds; a lost partition is made
again from the written table and the trees. Null labels and weights leave a row out.
"""

from __future__ import annotations

import itertools
import json
import pickle
import sys
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import asdict, astuple, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, cloudpickle
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from tillsight.session import cut_lineage

BINS = 256  # at most; a bin is a byte
BLOCK = 1 << 16  # rows of a block, and of a file of blocks
ROWS = 1 << 22  # rows of a task, once every core has one
SUMS = 1 << 20  # numbers that a task adds up and searches
RENEW = 3  # rounds after which the margins are written anew
CHAIN = 32  # renewals after which they are made from the table again
FEW = 1 << 10  # partitions whose few numbers the driver adds up itself
TOGETHER = 8  # features whose sums travel as one record

SPREAD = 0x9E3779B97F4A7C15


@dataclass(frozen=True)
class Boost:
    """How trees grow."""

    rounds: int = 200
    depth: int = 6
    rate: float = 0.05
    l1: float = 0.0
    l2: float = 0.0
    min_curvature: float = 0.0  # of a child; for squared error the sum of its weights
    min_weight: float = 1.0  # of a child's rows
    min_gain: float = 0.0
    row_share: float = 1.0
    column_share: float = 1.0
    objective: str = "squared"  # or logistic, softmax
    classes: int = 1  # of softmax
    patience: int | None = None
    seed: int = 42

    @property
    def outputs(self) -> int:
        return self.classes if self.objective == "softmax" else 1


@dataclass(frozen=True)
class Fit:
    """One model to be fitted on a shared matrix; names of numeric columns kept in it."""

    boost: Boost
    label: str
    weight: str | None = None
    held: str | None = None  # above 0: a row that only decides when to stop


@dataclass
class Tree:
    """Nodes in heap order: the children of i are 2 i + 1 (below the cut) and 2 i + 2."""

    feature: np.ndarray  # -1: a leaf
    bin: np.ndarray  # the last bin that goes left
    value: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> "Tree":
        n = (2 << depth) - 1
        return cls(np.full(n, -1, dtype=np.int32), np.zeros(n, dtype=np.int32), np.zeros(n))

    def leaves(self, bins: np.ndarray, levels: int) -> np.ndarray:
        """The node of each row after so many levels."""
        node = np.zeros(len(bins), dtype=np.int64)
        cells = np.ascontiguousarray(bins).ravel()
        rows = np.arange(len(bins), dtype=np.int64) * bins.shape[1]
        # A leaf stays where it is: no bin is above its cut, and its children are itself.
        leaf, own = self.feature < 0, np.arange(len(self.feature), dtype=np.int64)
        feature, cut = np.where(leaf, 0, self.feature).astype(np.int64), np.where(leaf, BINS, self.bin).astype(np.int32)
        child = np.where(leaf, own, 2 * own + 1)
        for _ in range(levels):
            right = cells.take(rows + feature.take(node)) > cut.take(node)
            node = child.take(node) + right
        return node

    @property
    def depth(self) -> int:
        return len(self.feature).bit_length() - 1

    def values(self, bins: np.ndarray) -> np.ndarray:
        return self.value[self.leaves(bins, self.depth)]


def cut_points(df: DataFrame, columns: Sequence[Column], bins: int = BINS) -> list[list[float]]:
    """For each feature the values at which bins begin: all values but the smallest one where
    they are fewer than bins, else quantiles. Two passes; at most ``bins`` values a feature
    reach the driver."""
    share = [i / bins for i in range(bins)]
    wanted = [F.percentile_approx(c, share, 100 * bins).alias(f"q{i}") for i, c in enumerate(columns)]
    row = df.agg(*wanted, *[F.approx_count_distinct(c, 0.02).alias(f"n{i}") for i, c in enumerate(columns)]).first()
    few = [i for i in range(len(columns)) if row[f"n{i}"] <= 0.9 * bins]
    sets = df.agg(*[F.collect_set(columns[i]).alias(f"s{i}") for i in few]).first() if few else {}
    found = [sets[f"s{i}"] if i in few else row[f"q{i}"] for i in range(len(columns))]
    # A set that turned out too large gives way to the quantiles.
    found = [row[f"q{i}"] if len(x or []) > bins else x for i, x in enumerate(found)]
    return [sorted({x for x in values or [] if x == x})[1:] for values in found]


def binned(values: np.ndarray, cuts: Sequence[Sequence[float]]) -> np.ndarray:
    """The number of cuts at or below each value; NaN lies above all."""
    out = np.empty(values.shape, dtype=np.uint8)
    for j, c in enumerate(cuts):
        out[:, j] = np.searchsorted(np.asarray(c, dtype=float), values[:, j], side="right")
    return out


@dataclass
class BinnedMatrix:
    """Binned features and further numeric columns of all rows, as a written table of blocks."""

    table: DataFrame
    features: list[str]
    cuts: list[list[float]]
    columns: list[str]
    tasks: int  # that read it, at most

    @classmethod
    def build(cls, df: DataFrame, features: Sequence[str] | Mapping[str, Column], columns: Mapping[str, Column],
              key: str | Column = "customer_id", bins: int = BINS, cuts: list[list[float]] | None = None) -> "BinnedMatrix":
        """``features`` are columns (null is 0) or named expressions; ``key`` tells rows apart in samples."""
        if not isinstance(features, Mapping):
            features = {f: F.coalesce(F.col(f"`{f}`").cast("double"), F.lit(0.0)) for f in features}
        cuts = cuts or cut_points(df, list(features.values()), bins)
        names = list(columns)
        rows = df.select(
            F.xxhash64(key).alias("key"), F.array(*features.values()).alias("x"),
            F.array(*[c.cast("double") for c in columns.values()]).alias("c"),
        )

        # Every level is a job: no more tasks than rows keep busy, nor than cores unless their blocks grow large.
        n = max(rows.count(), 1)
        rows = rows.repartition(-(-n // BLOCK))
        tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-n // ROWS))

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for start in range(0, batch.num_rows, BLOCK):
                    part = batch.slice(start, BLOCK)
                    x = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
                    c = part.column(2).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
                    block = {"key": part.column(0).to_numpy().view(np.uint64), "bins": binned(x, cuts), "columns": dict(zip(names, c.T.copy()))}
                    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(block)], pa.binary())], ["block"])

        return cls(cut_lineage(rows.mapInArrow(pack, "block binary")), list(features), cuts, names, tasks)

    def blocks(self) -> RDD:
        return self.table.rdd.coalesce(self.tasks).map(lambda r: pickle.loads(r[0]))


def usable(block: dict, fit: Fit) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Label, weight (0 for rows that take no part) and whether the row is held back."""
    y = block["columns"][fit.label]
    w = np.ones(len(y)) if fit.weight is None else block["columns"][fit.weight]
    w = np.where(np.isfinite(y) & np.isfinite(w), w, 0.0)
    held = np.zeros(len(y), dtype=bool) if fit.held is None else block["columns"][fit.held] > 0
    return np.where(w > 0, y, 0.0), w, held


def probabilities(margins: np.ndarray) -> np.ndarray:
    """Softmax over the first axis."""
    e = np.exp(margins - margins.max(axis=0))
    return e / e.sum(axis=0)


def slopes(boost: Boost, y: np.ndarray, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and curvature of the loss for each output and row."""
    if boost.objective == "squared":
        return margins - y, np.ones_like(margins)
    if boost.objective == "logistic":
        p = 1 / (1 + np.exp(-margins))
        return p - y, p * (1 - p)
    p = probabilities(margins)
    return p - (y[None, :] == np.arange(boost.classes)[:, None]), p * (1 - p)


def losses(boost: Boost, y: np.ndarray, margins: np.ndarray) -> np.ndarray:
    if boost.objective == "squared":
        return (margins[0] - y) ** 2
    if boost.objective == "logistic":
        return np.logaddexp(0, margins[0]) - y * margins[0]
    return -np.log(np.maximum(probabilities(margins)[y.astype(int), np.arange(len(y))], 1e-300))


def sampled(key: np.ndarray, boost: Boost, number: int) -> np.ndarray:
    """Rows that take part in a round."""
    if boost.row_share >= 1:
        return np.ones(len(key), dtype=bool)
    x = key ^ np.uint64((boost.seed * SPREAD + number * 0xD1B54A32D192ED03) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x.astype(float) / 2.0**64 < boost.row_share


def added(margins: np.ndarray, rounds: Sequence[Sequence[Tree]], bins: np.ndarray) -> np.ndarray:
    """Margins with the trees of more rounds."""
    out = margins.copy()
    for trees in rounds:
        for k, tree in enumerate(trees):
            out[k] += tree.values(bins)
    return out


@dataclass
class Growing:
    """A fit on its way."""

    fit: Fit
    base: np.ndarray
    done: list[list[Tree]] = field(default_factory=list)  # trees by round
    now: list[Tree] = field(default_factory=list)  # of the round that grows
    columns: list[np.ndarray] = field(default_factory=list)  # of each tree of the round
    history: list[float] = field(default_factory=list)  # loss of the held-back rows before each round
    kept: int = 0  # rounds that the stored margins hold
    over: bool = False

    def waited_out(self) -> bool:
        patience = self.fit.boost.patience
        return patience is not None and bool(self.history) and len(self.history) - 1 - int(np.argmin(self.history)) >= patience

    def best(self) -> int:
        """Rounds to keep."""
        if self.fit.boost.patience is None or not self.history:
            return len(self.done)
        return int(np.argmin(self.history))


def histograms(block: dict, growing: Sequence[tuple], level: int, columns: Mapping[tuple[int, int], np.ndarray] | None = None) -> list[np.ndarray]:
    """For each fit: sums of (gradient, curvature, weight) by output, node of the level, feature and bin;
    at the first level also loss and weight of the held-back rows. Of the features only the first one, from which
    the sums of a node come, and those among the ``columns`` of the fit's tree are counted."""
    out = []
    bins = block["bins"]
    for at, fit, pending, now, number, size in growing:
        boost = fit.boost
        y, w, held = usable(block, fit)
        margins = added(block["margins"][at], pending, bins)
        if level == 0:
            some = held & (w > 0)
            loss = losses(boost, y[some], margins[:, some]) if some.any() else np.zeros(0)
            out.append(np.array([(loss * w[some]).sum(), w[some].sum()]))
        rows = np.flatnonzero((w > 0) & ~held & sampled(block["key"], boost, number))
        g, h = slopes(boost, y[rows], margins[:, rows])
        g, h = g * w[rows], h * w[rows]
        first, nodes = (1 << level) - 1, 1 << level
        sums = np.zeros((boost.outputs, 3, bins.shape[1], nodes * size))
        own = bins[rows]
        for k in range(boost.outputs):
            node = now[k].leaves(own, level) - first
            there = np.flatnonzero(node >= 0)  # rows in leaves above the level are finished
            place, some = node[there] * size, own[there].T.copy()
            # The curvature of squared error is the weight; weights that are all 1 are counted.
            added_up = [(i, x[there]) for i, x in enumerate((g[k], h[k], w[rows])) if i != 1 or boost.objective != "squared"]
            added_up = [(i, None if i == 2 and (x == 1).all() else x) for i, x in added_up]
            for j in range(bins.shape[1]):
                if j and columns is not None and not columns[at, k][j]:
                    continue
                index = place + some[j]
                for i, x in added_up:
                    sums[k, i, j] = np.bincount(index, x, nodes * size)
        if boost.objective == "squared":
            sums[:, 1] = sums[:, 2]
        out.append(sums.reshape(boost.outputs, 3, bins.shape[1], nodes, size))
    return out


def summed(blocks: RDD, of_block: Callable[[dict], list[np.ndarray]], records: Callable | None = None,
           search: Callable | None = None, tasks: int = 1) -> list | None:
    """The arrays of all blocks added up: in each partition, then, if they are few numbers, by the driver or over
    a tree of tasks. With ``records``, which cuts the sums of a partition into ``(*key, partition), sums``, the sums
    of a key meet in one of so many tasks, in the order of the partitions, and only what ``search``
    finds in them comes back, as one record of each task. A single partition needs no shuffle."""

    def plus(a: list[np.ndarray], b: list[np.ndarray]) -> list[np.ndarray]:
        return [x + y for x, y in zip(a, b)]

    def in_part(part: Iterator[dict]) -> Iterator[list[np.ndarray]]:
        total = None
        for block in part:
            found = of_block(block)
            total = found if total is None else plus(total, found)
        if total is not None:
            yield total

    def together(part: Iterator[tuple]) -> Iterator[tuple]:
        for key, same in itertools.groupby(part, key=lambda r: r[0][:-1]):
            total = None
            for _, found in same:
                total = found if total is None else plus(total, found)
            yield key, total

    parts = blocks.mapPartitions(in_part)
    if records is not None:
        cut = parts.mapPartitionsWithIndex(lambda number, part: (r for total in part for r in records(number, total)))
        if blocks.getNumPartitions() > 1:
            cut = cut.repartitionAndSortWithinPartitions(tasks, lambda key: hash(key[:-1]))
        return [r for found in cut.mapPartitions(lambda part: [list(search(together(part)))]).collect() for r in found]
    if blocks.getNumPartitions() <= FEW:
        total = None
        for found in parts.collect():
            total = found if total is None else plus(total, found)
        return total
    return parts.treeReduce(plus)


def shrunk(g: np.ndarray, l1: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0.0)


def score(g: np.ndarray, h: np.ndarray, boost: Boost) -> np.ndarray:
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(h + boost.l2 > 0, shrunk(g, boost.l1) ** 2 / (h + boost.l2) / 2, 0.0)


def leaf(g: np.ndarray, h: np.ndarray, boost: Boost) -> np.ndarray:
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(h + boost.l2 > 0, -boost.rate * shrunk(g, boost.l1) / (h + boost.l2), 0.0)


@dataclass
class Split:
    """The best cut of a node among some features (-1: none gains), the weights of its children and of itself."""

    gain: float
    feature: int
    bin: int
    left: float
    right: float
    own: float


def best_split(total: np.ndarray, sums: np.ndarray, boost: Boost, columns: np.ndarray) -> Split:
    """``total`` are the node's gradient, curvature and weight, ``sums`` the same by feature and bin."""
    left = np.cumsum(sums, axis=2)[:, :, :-1]
    right = total[:, None, None] - left
    own = score(total[0], total[1], boost)
    gain = score(left[0], left[1], boost) + score(right[0], right[1], boost) - own
    # Sums of many numbers differ in their last digits: a child needs real rows.
    enough = (np.minimum(left[2], right[2]) >= max(boost.min_weight, 1e-6) - 1e-9) & (np.minimum(left[1], right[1]) >= boost.min_curvature - 1e-9)
    gain = np.where(enough & columns[:, None], gain, -np.inf)
    best, weight = gain.max(initial=-np.inf), float(leaf(total[0], total[1], boost))
    if not best > max(boost.min_gain, 1e-10 * abs(own), 1e-12):
        return Split(-np.inf, -1, 0, 0.0, 0.0, weight)
    # Of gains that differ by rounding only, the first feature and bin.
    feature, cut = divmod(int(np.flatnonzero(gain.ravel() >= best - 1e-10 * abs(best))[0]), gain.shape[1])
    child = (float(leaf(x[0][feature, cut], x[1][feature, cut], boost)) for x in (left, right))
    return Split(float(best), feature, cut, *child, weight)


def first_best(found: Sequence[Split]) -> Split:
    """Of the splits of one node, in the order of their features."""
    best = max(s.gain for s in found)
    return next(s for s in found if best == -np.inf or s.gain >= best - 1e-10 * abs(best))


def level_splits(blocks: RDD, growing: Sequence[tuple], level: int, cuts: Sequence[Sequence[float]],
                 columns: Mapping[tuple[int, int], np.ndarray]) -> dict[tuple, list]:
    """By (fit, output, node) the best splits of its groups of features, in their order; by (fit, -1, 0) its losses."""
    boosts = {ask[0]: ask[1].boost for ask in growing}

    def records(number: int, sums: list[np.ndarray]) -> Iterator[tuple]:
        found = iter(sums)
        for at, boost in boosts.items():
            if level == 0:
                yield (at, -1, 0, 0, number), [next(found)]
            own = next(found)
            for k, node in itertools.product(range(boost.outputs), range(1 << level)):
                total = own[k, :, 0, node].sum(axis=1)
                if not total[2]:
                    continue
                # The curvature of squared error is the weight.
                kinds = slice(None, None, 2) if boost.objective == "squared" else slice(None)
                for start in range(0, own.shape[2], TOGETHER):
                    size = max(map(len, cuts[start : start + TOGETHER])) + 1
                    yield (at, k, node, start, number), [total, own[k, kinds, start : start + TOGETHER, node, :size].copy()]

    def search(sums: Iterator[tuple]) -> Iterator[tuple]:
        for (at, k, node, start), found in sums:
            if k < 0:
                yield (at, k, node, start), tuple(found[0].tolist())
                continue
            total, own = found
            split = best_split(total, own if len(own) == 3 else own[[0, 1, 1]], boosts[at], columns[at, k][start : start + TOGETHER])
            if split.feature >= 0:
                split.feature += start
            # Plain numbers: a class of this module would travel with its code.
            yield (at, k, node, start), astuple(split)

    places, parts = sum(b.outputs for b in boosts.values()) << level, blocks.getNumPartitions()
    numbers = places * parts * 2 * (sum(map(len, cuts)) + len(cuts))
    tasks = min(parts, places * -(-len(cuts) // TOGETHER), -(-numbers // SUMS))
    out: dict[tuple, list] = {}
    for key, found in sorted(summed(blocks, lambda block: histograms(block, growing, level, columns), records, search, tasks), key=lambda r: r[0]):
        out.setdefault(key[:3], []).append(found if key[1] < 0 else Split(*found))
    return out


def grow(tree: Tree, node: int, split: Split) -> None:
    """Splits a node, given by its place in the tree, if that gains, and sets the values of its children."""
    if node == 0:
        tree.value[0] = split.own
    if split.feature >= 0:
        tree.feature[node], tree.bin[node] = split.feature, split.bin
        tree.value[2 * node + 1], tree.value[2 * node + 2] = split.left, split.right


def start_of(boost: Boost, sums: np.ndarray) -> np.ndarray:
    """The constant that fits best, from the weight of each class or the sum of labels."""
    total = max(sums[0], 1e-300)
    if boost.objective == "squared":
        return np.array([sums[1] / total])
    if boost.objective == "logistic":
        p = min(max(sums[1] / total, 1e-12), 1 - 1e-12)
        return np.array([np.log(p / (1 - p))])
    return np.log(np.maximum(sums[1:] / total, 1e-12))


def label_sums(block: dict, fits: Sequence[Fit]) -> list[np.ndarray]:
    out = []
    for fit in fits:
        y, w, held = usable(block, fit)
        w = np.where(held, 0.0, w)
        if fit.boost.objective == "softmax":
            out.append(np.array([w.sum(), *np.bincount(y.astype(int), w, fit.boost.classes)[: fit.boost.classes]]))
        else:
            out.append(np.array([w.sum(), (w * y).sum()]))
    return out


def fit_all(matrix: BinnedMatrix, fits: Mapping[str, Fit]) -> dict[str, "BoostedTrees"]:
    """All fits in lockstep on one matrix: as many jobs as the longest of them has levels."""
    plain = matrix.blocks().persist(StorageLevel.MEMORY_AND_DISK)
    wanted = list(fits.values())
    sums = summed(plain, lambda block: label_sums(block, wanted))
    if sums is None:
        raise ValueError("there are no rows to fit")
    growing = [Growing(f, start_of(f.boost, s)) for f, s in zip(wanted, sums)]
    state = with_margins(plain, [(g.base, []) for g in growing])
    older: list[RDD] = []
    width, number = len(matrix.features), 0
    bins = max(map(len, matrix.cuts), default=0) + 1
    while any(not g.over for g in growing):
        active = [(i, g) for i, g in enumerate(growing) if not g.over]
        for _, g in active:
            boost = g.fit.boost
            chosen = np.random.default_rng([boost.seed, number])
            g.now = [Tree.empty(boost.depth) for _ in range(boost.outputs)]
            g.columns = [columns_for(chosen, width, boost.column_share) for _ in g.now]
        for level in range(max(g.fit.boost.depth for _, g in active)):
            part = [(i, g) for i, g in active if level < g.fit.boost.depth and not (level and finished(g, level))]
            if not part:
                break
            ask = [(i, g.fit, g.done[g.kept :], g.now, number, bins) for i, g in part]
            columns = {(i, k): c for i, g in part for k, c in enumerate(g.columns)}
            for (i, k, node), found in level_splits(state, ask, level, matrix.cuts, columns).items():
                if k >= 0:
                    grow(growing[i].now[k], (1 << level) - 1 + node, first_best(found))
                elif found[0][1]:
                    growing[i].history.append(found[0][0] / found[0][1])
        number += 1
        for _, g in active:
            g.done.append(g.now)
            boost = g.fit.boost
            g.over = len(g.done) >= boost.rounds or g.waited_out()
        if number % RENEW == 0 and any(not g.over for g in growing):
            older.append(state)
            again = len(older) % CHAIN == 0
            more = [(g.base if again else None, g.done if again else g.done[g.kept :]) for g in growing]
            for g in growing:
                g.kept = len(g.done)
            state = with_margins(plain if again else state, more)
            if len(older) > 1:
                older[-2].unpersist()
    out = {}
    for name, g in zip(fits, growing):
        if g.fit.boost.patience is not None and g.history and not g.waited_out():
            pending = g.done[g.kept :]
            last = summed(state, lambda block, a=growing.index(g), f=g.fit, p=pending: held_loss(block, a, f, p))[0]
            g.history.append(last[0] / last[1])
        trees = g.done[: g.best()]
        out[name] = BoostedTrees(g.fit.boost, matrix.features, matrix.cuts, g.base, trees, g.history)
    for rdd in (*older[-1:], state, plain):
        rdd.unpersist()
    return out


def held_loss(block: dict, at: int, fit: Fit, pending: Sequence[Sequence[Tree]]) -> list[np.ndarray]:
    y, w, held = usable(block, fit)
    some = held & (w > 0)
    margins = added(block["margins"][at][:, some], pending, block["bins"][some])
    return [np.array([(losses(fit.boost, y[some], margins) * w[some]).sum(), w[some].sum()])]


def finished(g: Growing, level: int) -> bool:
    """Whether no node of the level above was split."""
    above = slice((1 << (level - 1)) - 1, (1 << level) - 1)
    return all((t.feature[above] < 0).all() for t in g.now)


def columns_for(rng: np.random.Generator, width: int, share: float) -> np.ndarray:
    out = np.ones(width, dtype=bool)
    if share < 1:
        out[:] = False
        out[rng.choice(width, max(1, round(share * width)), replace=False)] = True
    return out


def with_margins(blocks: RDD, more: list[tuple]) -> RDD:
    """Blocks with the margins of each fit: from a constant, or from those they hold, plus trees."""

    def renewed(block: dict) -> dict:
        bins, margins = block["bins"], []
        for i, (base, rounds) in enumerate(more):
            start = block["margins"][i] if base is None else np.repeat(np.asarray(base)[:, None], len(bins), axis=1)
            margins.append(added(start, rounds, bins))
        return {**block, "margins": margins}

    return blocks.map(renewed).persist(StorageLevel.MEMORY_AND_DISK)


def likeliest(probability: str) -> Column:
    """The first class with the largest probability."""
    return (F.array_position(probability, F.array_max(probability)) - 1).cast("double")


@dataclass
class BoostedTrees:
    """A fitted model. ``history`` holds the loss of the held-back rows before each round."""

    boost: Boost
    features: list[str]
    cuts: list[list[float]]
    base: np.ndarray
    rounds: list[list[Tree]]
    history: list[float]

    def margins(self, values: np.ndarray) -> np.ndarray:
        """Outputs by rows."""
        bins = binned(values, self.cuts)
        return added(np.repeat(np.asarray(self.base)[:, None], len(bins), axis=1), self.rounds, bins)

    def outputs(self, values: np.ndarray) -> np.ndarray:
        """Amounts, or probabilities by class, as one row for each row."""
        margins = self.margins(values)
        if self.boost.objective == "squared":
            return margins.T
        if self.boost.objective == "logistic":
            p = 1 / (1 + np.exp(-margins[0]))
            return np.stack([1 - p, p], axis=1)
        return probabilities(margins).T

    def with_outputs(self, df: DataFrame, values: Column, name: str) -> DataFrame:
        """Adds the outputs for a column of arrays of feature values; rows travel to Python in Arrow batches."""
        vectors = [f.name for f in df.schema if isinstance(f.dataType, VectorUDT) and f.name != name]
        given = df.withColumn(name, values).withColumns({v: vector_to_array(F.col(f"`{v}`")) for v in vectors})
        place, schema = given.columns.index(name), StructType([StructField(f.name, f.dataType) for f in given.schema])
        schema[name].dataType = ArrayType(DoubleType())

        def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = batch.column(place).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                found = self.outputs(x) if batch.num_rows else np.zeros((0, 1))
                columns = list(batch.columns)
                columns[place] = pa.ListArray.from_arrays(pa.array(np.arange(len(found) + 1, dtype=np.int32) * found.shape[1]), pa.array(found.ravel()))
                yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

        return given.mapInArrow(apply, schema).withColumns({v: array_to_vector(F.col(f"`{v}`")) for v in vectors})

    def transform(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        """Adds the amount, or for classes their ``probability`` and the likeliest one."""
        x = F.array(*[F.coalesce(F.col(f"`{f}`").cast("double"), F.lit(0.0)) for f in self.features])
        if self.boost.objective == "squared":
            return self.with_outputs(df, x, output).withColumn(output, F.col(output)[0])
        return self.with_outputs(df, x, "probability").withColumn(output, likeliest("probability"))

    def importances(self) -> list[float]:
        """How often each feature splits, as shares."""
        counts = np.zeros(len(self.features))
        for trees in self.rounds:
            for t in trees:
                counts += np.bincount(t.feature[t.feature >= 0], minlength=len(counts))
        return (counts / max(counts.sum(), 1)).tolist()

    def to_json(self) -> str:
        trees = [[{"feature": t.feature.tolist(), "bin": t.bin.tolist(), "value": t.value.tolist()} for t in r] for r in self.rounds]
        return json.dumps({
            "boost": asdict(self.boost), "features": self.features, "cuts": self.cuts, "base": list(map(float, self.base)),
            "rounds": trees, "history": list(map(float, self.history)),
        })

    @classmethod
    def from_json(cls, text: str) -> "BoostedTrees":
        d = json.loads(text)
        tree = lambda t: Tree(np.array(t["feature"], dtype=np.int32), np.array(t["bin"], dtype=np.int32), np.array(t["value"]))
        rounds = [[tree(t) for t in r] for r in d["rounds"]]
        return cls(Boost(**d["boost"]), d["features"], d["cuts"], np.array(d["base"]), rounds, d["history"])

    def save(self, path: str) -> None:
        SparkSession.active().createDataFrame([(self.to_json(),)], "model string").coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "BoostedTrees":
        return cls.from_json(spark.read.schema("model string").parquet(path).first()["model"])


class BoostedEstimator(Estimator):
    """Boosted trees as a stage of a pipeline, on the vectors of ``features``."""

    def __init__(self, boost: Boost, features: str = "features", label: str = "label", key: str = "customer_id",
                 validation_share: float | None = None, held: str = "is_validation"):
        super().__init__()
        self.boost, self.features, self.label, self.key, self.held = boost, features, label, key, held
        if validation_share is not None:
            self.validation_share = validation_share

    def _fit(self, dataset: DataFrame) -> "BoostedStage":
        width = len(dataset.select(self.features).filter(F.col(self.features).isNotNull()).first()[0])
        rows = dataset.withColumn("_x", vector_to_array(self.features))
        columns = {"label": F.col(self.label)}
        held = self.boost.patience is not None and self.held in dataset.columns
        if held:
            columns["held"] = F.col(self.held).cast("int")
        matrix = BinnedMatrix.build(rows, {str(i): F.get("_x", F.lit(i)) for i in range(width)}, columns, self.key)
        return BoostedStage(fit_all(matrix, {"model": Fit(self.boost, "label", held="held" if held else None)})["model"], self.features)


class BoostedStage(Model, MLWritable, MLReadable):
    """Fitted boosted trees as a stage; kept with its pipeline."""

    def __init__(self, trees: BoostedTrees | None = None, features: str = "features"):
        super().__init__()
        self.trees, self.features = trees, features

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out = self.trees.with_outputs(dataset, vector_to_array(self.features), "_p")
        if self.trees.boost.objective == "squared":
            return out.withColumn("prediction", F.col("_p")[0]).drop("_p")
        out = out.withColumn("prediction", likeliest("_p"))
        return out.withColumn("probability", array_to_vector("_p")).drop("_p")

    def write(self) -> MLWriter:
        return StageWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return StageReader()


class StageWriter(MLWriter):
    def __init__(self, stage: BoostedStage):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sparkSession, extraMetadata={"features": self.stage.features})
        self.stage.trees.save(f"{path}/trees")


class StageReader(MLReader):
    def load(self, path: str) -> BoostedStage:
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        return BoostedStage(BoostedTrees.load(self.sparkSession, f"{path}/trees"), meta["features"])


# Its functions travel to the executors by value, so a cluster needs no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
