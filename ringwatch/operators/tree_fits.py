"""K1, K4: the boosted trees of many settings grown together, in shared passes over binned training rows.

The trees are those of ``fit_tree`` (MLlib's ``GBTClassifier``): about ``BINS`` bins per feature with thresholds from
about 10,000 rows, regression trees by variance on the labels -1 and 1 and then on -gradient of the log-loss, a
weight of ``pos_weight`` for positives, ``step_size`` for every tree but the first, rows drawn per tree at the rate
``subsampling``. MLlib bins the rows anew in each fit and takes a pass per level of each tree of each trial. Here rows are
binned once, a byte per feature; a pass sums weights and targets by (trial, open node, feature, bin) for all trials, and the
driver picks the splits. A tree's leaves are stored with the rows when it is full grown, so margins need no second walk;
and as trees are only added, more rounds go on from the rounds before instead of starting again.

Rows are drawn by a hash of (seed, tree, row's id), so a fit does not depend on the order of rows or partitions.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringwatch.operators.compiled import CompiledTrees, Node
from ringwatch.operators.linear_fits import arrays, packed, summed
from ringwatch.session import discard, shared_dir

#: Bins per feature, rows that thresholds are taken from (MLlib's values), rows of a block.
BINS, SPLIT_ROWS, TREE_BLOCK_ROWS = 32, 10_000, 1 << 15
_BINNED_DDL = "n long, y binary, ids binary, bins binary, leaves binary"


def uniform(ids: np.ndarray, seed: int) -> np.ndarray:
    """A number from 0 to 1 for each id and seed."""
    x = ids.astype("<i8").view(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2 ** 64)
    for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(by)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(float) * 2.0 ** -53


def thresholds(values: np.ndarray, weights: np.ndarray, expected: float, most: int) -> np.ndarray:
    """MLlib's candidate thresholds of one feature: midpoints of its sampled values, about ``most``, of about equal weight
    between them. ``expected``: weight of the sample; what the values other than zero leave of it is the zeros'."""
    given = values != 0
    at, place = np.unique(values[given], return_inverse=True)
    weight = np.bincount(place, weights[given], len(at))
    if not len(at):
        return np.zeros(0)
    if expected - weight.sum() > np.finfo(float).eps * given.sum() * 100:
        k = int(np.searchsorted(at, 0.0))
        at, weight = np.insert(at, k, 0.0), np.insert(weight, k, expected - weight.sum())
    if len(at) - 1 <= most:
        return (at[:-1] + at[1:]) / 2
    stride, out = expected / (most + 1), []
    target, reached = stride, weight[0]
    for k in range(1, len(at)):
        before, reached = reached, reached + weight[k]
        if abs(before - target) < abs(reached - target):
            out.append((at[k - 1] + at[k]) / 2)
            target += stride
    return np.array(out)


@dataclass
class Tree:
    """Nodes as lists; leaves have feature -1, a right child follows its left one. ``open``: nodes whose split is still to be found."""

    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])
    level: list[int] = field(default_factory=lambda: [0])
    open: list[int] = field(default_factory=lambda: [0])

    def walk(self, bins: np.ndarray) -> np.ndarray:
        """The node that each row has come to."""
        feature, at, left = np.array(self.feature), np.array(self.bin), np.array(self.left)
        node, rows = np.zeros(bins.shape[1], np.int64), np.arange(bins.shape[1])
        for _ in range(max(self.level)):
            f = feature[node]
            node = np.where(f >= 0, left[node] + (bins[f, rows] > at[node]), node)
        return node

    def split(self, sums: np.ndarray, cuts: list[int], depth: int) -> None:
        """The best split of each open node from its sums (node, feature, bin, weight and target); nodes without a gain are leaves."""
        mine, self.open = self.open, []
        for node, own in zip(mine, sums):
            weight, target = own[0].sum(axis=0)
            if weight <= 0:
                continue
            self.value[node] = target / weight
            low = np.cumsum(own, axis=1)[:, :-1]
            high = np.cumsum(own[:, ::-1], axis=1)[:, ::-1][:, 1:]
            can = (low[..., 0] > 0) & (high[..., 0] > 0) & (np.arange(low.shape[1]) < np.array(cuts)[:, None])
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(can, low[..., 1] ** 2 / low[..., 0] + high[..., 1] ** 2 / high[..., 0] - target ** 2 / weight, -np.inf)
            f, b = np.unravel_index(int(gain.argmax()), gain.shape)
            if not gain[f, b] > 1e-12 * weight:
                continue
            self.feature[node], self.bin[node], self.left[node] = int(f), int(b), len(self.feature)
            for side in (low[f, b], high[f, b]):
                self.feature.append(-1)
                self.bin.append(0)
                self.left.append(0)
                self.value.append(float(side[1] / side[0]))
                self.level.append(self.level[node] + 1)
                if self.level[-1] < depth:
                    self.open.append(len(self.feature) - 1)

    def node(self, cuts: list[np.ndarray], at: int = 0) -> Node:
        if self.feature[at] < 0:
            return Node(self.value[at])
        return Node(self.value[at], self.feature[at], float(cuts[self.feature[at]][self.bin[at]]), None,
                    self.node(cuts, self.left[at]), self.node(cuts, self.left[at] + 1))


class TreeFits:
    """Boosted trees of several trials over one binned table. ``grow`` adds rounds to the trials that go on."""

    def __init__(self, train: DataFrame, features, settings: list[dict], seed: int = 42):
        self.spark, self.features, self.settings, self.seed = train.sparkSession, tuple(features), settings, seed
        d = len(self.features)
        ids = F.coalesce(F.col("txn_id").cast("long"), F.monotonically_increasing_id())
        path, rows = packed(train, list(self.features), ids, TREE_BLOCK_ROWS)

        def classes(batches):
            n = np.zeros(3)
            for y, x, _ in arrays(batches, d):
                n += [(y == 0).sum(), (y == 1).sum(), (~np.isin(y, (0, 1))).sum() + (~np.isfinite(x)).sum()]
            yield 0, n

        negative, positive, bad = summed(rows, classes).get(0, np.zeros(3))
        if bad:  # as MLlib does
            raise ValueError(f"{int(bad)} labels outside {{0, 1}} or inputs that are missing or not finite")
        if not negative + positive:
            raise ValueError("no training rows")
        self.weight = float(negative / positive if positive and negative else 1.0)
        n = negative + positive
        share = SPLIT_ROWS / n if n > SPLIT_ROWS else 1.0

        def drawn(batches):
            for y, x, i in arrays(batches, d):
                mine = np.flatnonzero(uniform(i, seed) < share) if share < 1 else np.arange(len(y))
                yield pa.RecordBatch.from_arrays([pa.array([np.vstack([y[None, mine], x[:, mine]]).tobytes()], pa.binary())], names=["rows"])

        sample = np.concatenate([np.frombuffer(bytes(r.rows)).reshape(d + 1, -1) for r in rows.mapInArrow(drawn, "rows binary").collect()], axis=1)
        weights = np.where(sample[0] == 1, self.weight, 1.0)
        expected = share * (negative + self.weight * positive)
        self.cuts = [thresholds(sample[1 + j], weights, expected, int(min(BINS, n)) - 1) for j in range(d)]
        cuts = self.cuts

        def binned(batches):
            for y, x, i in arrays(batches, d):
                bins = np.stack([np.searchsorted(c, v) for c, v in zip(cuts, x)]).astype(np.uint8)
                yield _block(y.astype(np.uint8), i, bins, np.zeros((0, len(y)), "<u2"))

        self._path = None
        self._store(rows.mapInArrow(binned, _BINNED_DDL))
        discard(self.spark, path)
        self.trees: list[list[Tree]] = [[] for _ in settings]
        self._stored: list[int] = []  # the trial of each tree whose leaves are stored, in order

    def _store(self, blocks: DataFrame) -> None:
        old, self._path = self._path, shared_dir(self.spark, f"binned-{uuid.uuid4().hex}")
        blocks.write.option("parquet.enable.dictionary", "false").parquet(self._path)
        self.blocks = self.spark.read.schema(_BINNED_DDL).parquet(self._path)
        if old:
            discard(self.spark, old)

    def close(self) -> None:
        """Delete the binned table."""
        discard(self.spark, self._path)

    def grow(self, live: list[int], rounds: int) -> None:
        """Trees for the trials ``live`` until each has ``rounds`` of them."""
        while any(len(self.trees[t]) < rounds for t in live):
            todo = [t for t in live if len(self.trees[t]) < rounds]
            growing = {t: Tree() for t in todo}
            while any(x.open for x in growing.values()):
                self._level({t: x for t, x in growing.items() if x.open})
            for t, tree in growing.items():
                self.trees[t].append(tree)
            self._keep_leaves(live, growing)

    def _weights(self, trial: int) -> list[float]:
        return [1.0] + [self.settings[trial]["step_size"]] * (len(self.trees[trial]) - 1)

    def _level(self, growing: dict[int, Tree]) -> None:
        d, seed, weight, stored = len(self.features), self.seed, self.weight, self._stored
        width = 1 + max(map(len, self.cuts))  # a sample that weighs more than expected has more than BINS
        drawn = {t: self.settings[t]["subsampling"] for t in growing}
        values = {t: [w * np.array(x.value) for w, x in zip(self._weights(t), self.trees[t])] for t in growing}
        place = {t: [k for k, own in enumerate(stored) if own == t] for t in growing}

        def run(batches):
            out = {t: np.zeros((d, len(x.open) * width, 2)) for t, x in growing.items()}
            for y, i, bins, leaves in _blocks(batches, d):
                draws: dict[int, np.ndarray] = {}
                sign = np.where(y == 1, 1.0, -1.0)
                w = np.where(y == 1, weight, 1.0)
                for t, tree in growing.items():
                    number = len(values[t])
                    at = np.full(len(tree.feature), -1)
                    at[tree.open] = np.arange(len(tree.open))
                    at = at[tree.walk(bins)]
                    here = at >= 0
                    if drawn[t] < 1:
                        if number not in draws:
                            draws[number] = uniform(i, seed + 1 + number)
                        here &= draws[number] < drawn[t]
                    if number:
                        margin = np.zeros(len(y))
                        for k, v in zip(place[t], values[t]):
                            margin += v[leaves[k]]
                        with np.errstate(over="ignore"):
                            target = 4.0 * sign / (1.0 + np.exp(2.0 * sign * margin))
                    else:
                        target = sign
                    mine = np.flatnonzero(here)
                    first, own, size = at[mine] * width, w[mine], len(tree.open) * width
                    both = own * target[mine]
                    for j in range(d):
                        cell = first + bins[j, mine]
                        out[t][j, :, 0] += np.bincount(cell, own, size)
                        out[t][j, :, 1] += np.bincount(cell, both, size)
            for t, x in out.items():
                yield t, x.ravel()

        for t, sums in summed(self.blocks, run).items():
            tree = growing[t]
            shaped = sums.reshape(d, len(tree.open), width, 2).transpose(1, 0, 2, 3)
            tree.split(shaped, [len(c) for c in self.cuts], self.settings[t]["max_depth"])

    def _keep_leaves(self, live: list[int], grown: dict[int, Tree]) -> None:
        """Store the leaf that each row has in the new trees; leaves of trials that went are left out."""
        d = len(self.features)
        kept = [k for k, t in enumerate(self._stored) if t in live]
        if max(len(x.feature) for x in grown.values()) > 1 << 16:
            raise ValueError("trees of more than 65,536 nodes")

        def run(batches):
            for y, i, bins, leaves in _blocks(batches, d):
                yield _block(y, i, bins, np.concatenate([leaves[kept], *[x.walk(bins).astype("<u2")[None] for x in grown.values()]]))

        self._store(self.blocks.mapInArrow(run, _BINNED_DDL))
        self._stored = [self._stored[k] for k in kept] + list(grown)

    def model(self, trial: int) -> CompiledTrees:
        """The trial's trees as they are now."""
        return CompiledTrees(self.features, {}, [t.node(self.cuts) for t in self.trees[trial]], self._weights(trial))


def _block(y, ids, bins, leaves) -> pa.RecordBatch:
    columns = [pa.array([len(y)])] + [pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for x in (y, ids, bins, leaves)]
    return pa.RecordBatch.from_arrays(columns, names=["n", "y", "ids", "bins", "leaves"])


def _blocks(batches, d: int):
    """(labels, ids, bins by feature, leaves by stored tree) of each block."""
    for batch in batches:
        for n, y, ids, bins, leaves in zip(*(batch.column(c).to_pylist() for c in ("n", "y", "ids", "bins", "leaves"))):
            yield (np.frombuffer(y, np.uint8), np.frombuffer(ids, "<i8"), np.frombuffer(bins, np.uint8).reshape(d, n),
                   np.frombuffer(leaves, "<u2").reshape(-1, n))
