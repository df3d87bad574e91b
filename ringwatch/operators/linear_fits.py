"""K4, K5: the logistic regressions of many settings fitted together, in shared passes over the training rows.

The objective is that of ``fit_edge_scorer`` (MLlib's ``LogisticRegression`` with ``standardization``): weighted mean
log-loss plus ``reg_param`` times the elastic net of the coefficients of features scaled by their weighted sample
standard deviation, the intercept free. It is convex, so any solver ends in the same place. MLlib takes a pass over the
rows per step and fit, hundreds in all; here one pass gives loss, gradient and Hessian of every setting that is not done
(numpy products over blocks of rows), and the driver takes a proximal Newton step of each, so about ten passes do for all.

Rows are packed once into blocks of doubles, in a shared table. Tasks' sums are added up by setting before they reach the
driver: (columns + 1) squared numbers each.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringwatch.operators.compiled import CompiledLinear, _number
from ringwatch.session import shared_dir

#: Rows of a block.
BLOCK_ROWS = 8192
#: Greatest number of passes (MLlib's maxIter of ``fit_edge_scorer``); a fit is done when a step moves no coefficient
#: of a scaled feature by more than this.
MAX_PASSES, TOLERANCE = 50, 1e-8
_SUMS_DDL = "part int, sums binary"


def packed(df: DataFrame, cols: list[str], ids: Column | None = None, block_rows: int | None = None) -> tuple[str, DataFrame]:
    """The rows' labels (``is_laundering``) and ``cols`` in blocks, written once, and where; with ``ids`` also those numbers."""
    d, named, most = len(cols), ids is not None, block_rows or BLOCK_ROWS

    def run(batches):
        waiting, held = [], 0

        def block():
            t = pa.Table.from_batches(waiting)
            columns = [c.to_numpy() for c in t.columns]
            x = np.stack(columns[1:1 + d]).astype("<f8") if d else np.zeros((0, t.num_rows))
            named_by = columns[-1].astype("<i8").tobytes() if named else b""
            return pa.RecordBatch.from_arrays([pa.array([t.num_rows]), pa.array([columns[0].astype("<f8").tobytes()], pa.binary()),
                                               pa.array([x.tobytes()], pa.binary()), pa.array([named_by], pa.binary())], names=["n", "y", "x", "ids"])

        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, most - held)
                batch = batch.slice(part.num_rows)
                waiting.append(part)
                held += part.num_rows
                if held == most:
                    yield block()
                    waiting, held = [], 0
        if held:
            yield block()

    rows = df.select(F.col("is_laundering").cast("double").alias("_y"), *[_number(f"`{c}`" if "." in c else c).alias(f"_{i}") for i, c in enumerate(cols)],
                     *([ids.cast("long").alias("_id")] if named else []))
    path = shared_dir(df.sparkSession, f"packed-{uuid.uuid4().hex}")
    made = rows.mapInArrow(run, "n long, y binary, x binary, ids binary")
    made.write.option("parquet.enable.dictionary", "false").parquet(path)
    return path, df.sparkSession.read.schema(made.schema).parquet(path)


def arrays(batches, d: int):
    """(labels, columns as rows of an array, ids) of each block."""
    for batch in batches:
        for n, y, x, ids in zip(*(batch.column(c).to_pylist() for c in ("n", "y", "x", "ids"))):
            yield np.frombuffer(y, "<f8"), np.frombuffer(x, "<f8").reshape(d, n), np.frombuffer(ids, "<i8")


def summed(blocks: DataFrame, run) -> dict[int, np.ndarray]:
    """The sums by part of what ``run`` yields in every task: (part, array)."""

    def each(batches):
        out = [(k, np.ascontiguousarray(v, "<f8").tobytes()) for k, v in run(batches)]
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], pa.int32()), pa.array([v for _, v in out], pa.binary())], names=["part", "sums"])

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, "<f8") for x in table.column("sums").to_pylist())
        return pa.table([pa.array([table.column("part")[0].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["part", "sums"])

    rows = blocks.mapInArrow(each, _SUMS_DDL).groupBy("part").applyInArrow(add, _SUMS_DDL).collect()  # a row per part
    return {r.part: np.frombuffer(bytes(r.sums), "<f8") for r in rows}


@dataclass
class Moments:
    """Rows, means and squared deviations from the mean of each class's columns."""

    n: np.ndarray
    mean: np.ndarray
    m2: np.ndarray

    @classmethod
    def of(cls, blocks: DataFrame, d: int) -> Moments:
        def first(batches):
            sums, bad = np.zeros((2, d + 1)), 0
            for y, x, _ in arrays(batches, d):
                bad += int((~np.isin(y, (0, 1))).sum()) + int((~np.isfinite(x)).sum())
                for c in (0, 1):
                    sums[c] += np.append((y == c).sum(), x[:, y == c].sum(axis=1))
            yield 0, np.append(sums.ravel(), bad)

        got = summed(blocks, first).get(0, np.zeros(2 * d + 3))
        if got[-1]:
            raise ValueError(f"{int(got[-1])} labels outside {{0, 1}} or inputs that are missing or not finite")
        sums = got[:-1].reshape(2, d + 1)
        mean = sums[:, 1:] / np.maximum(sums[:, :1], 1)

        def second(batches):
            m2 = np.zeros((2, d))
            for y, x, _ in arrays(batches, d):
                for c in (0, 1):
                    m2[c] += ((x[:, y == c] - mean[c][:, None]) ** 2).sum(axis=1)
            yield 0, m2.ravel()

        return cls(sums[:, 0], mean, summed(blocks, second).get(0, np.zeros(2 * d)).reshape(2, d))

    def deviations(self, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(means, sample standard deviations) where a class's rows weigh ``weight``."""
        w = weight * self.n
        total = w.sum()
        mean = (w[:, None] * self.mean).sum(axis=0) / total
        m2 = (weight[:, None] * self.m2 + w[:, None] * (self.mean - mean) ** 2).sum(axis=0)
        free = total - (weight * w).sum() / total
        return mean, np.sqrt(np.maximum(m2 / free, 0)) if free > 0 else np.zeros(len(mean))


@dataclass
class Fit:
    """One setting on its way. ``theta``: intercept, then coefficients of the commonly scaled columns."""

    weight: float
    l1: np.ndarray
    l2: np.ndarray
    theta: np.ndarray
    free: np.ndarray
    value: float = np.inf
    before: np.ndarray | None = None
    done: bool = False

    def penalty(self) -> float:
        return float((self.l1 * np.abs(self.theta) + self.l2 * self.theta ** 2 / 2).sum())

    def step(self, loss: float, gradient: np.ndarray, hessian: np.ndarray) -> None:
        value = loss + self.penalty()
        if self.before is not None and value > self.value + 1e-12 * max(1.0, abs(self.value)):
            self.theta = (self.before + self.theta) / 2  # too far: half the way
            self.done = float(np.abs(self.theta - self.before).max()) <= TOLERANCE
            if self.done:
                self.theta = self.before
            return
        self.value, self.before = value, self.theta
        self.theta = self.theta + self._move(gradient, hessian)
        self.done = float(np.abs(self.theta - self.before).max()) <= TOLERANCE

    def _move(self, g: np.ndarray, h: np.ndarray) -> np.ndarray:
        """The step to the least value of the quadratic model with the penalties: exact, or by coordinates where an L1 part is."""
        k = np.flatnonzero(self.free)
        h = h[np.ix_(k, k)] + np.diag(self.l2[k])
        h[np.diag_indices(len(k))] += 1e-12 * max(1.0, float(np.trace(h)) / len(k))
        g, at, l1 = g[k] + self.l2[k] * self.theta[k], self.theta[k], self.l1[k]
        move = np.zeros(len(self.theta))
        if not l1.any():
            move[k] = -np.linalg.solve(h, g)
            return move
        step, slope, diagonal = np.zeros(len(k)), g.copy(), h.diagonal()
        for _ in range(2000):
            largest = 0.0
            for j in range(len(k)):
                z = diagonal[j] * (at[j] + step[j]) - slope[j]
                new = np.sign(z) * max(abs(z) - l1[j], 0.0) / diagonal[j]
                by = new - at[j] - step[j]
                if by:
                    step[j] += by
                    slope += h[:, j] * by
                    largest = max(largest, abs(by))
            if largest <= TOLERANCE / 100:
                break
        move[k] = step
        return move


def fit_linear(train: DataFrame, cols: list[str], settings: list[dict]) -> list[CompiledLinear]:
    """The model of each setting (``reg_param``, ``elastic_net``, ``weight_power`` as in ``fit_edge_scorer``)."""
    d = len(cols)
    _, blocks = packed(train, cols)
    moments = Moments.of(blocks, d)
    n0, n1 = moments.n
    if not n0 + n1:
        raise ValueError("no training rows")
    if not n0 or not n1:  # one class: MLlib's constant model
        return [CompiledLinear(tuple(cols), [0.0] * d, float("inf") if n1 else float("-inf")) for _ in settings]
    mean, scale = moments.deviations(np.ones(2))
    live = scale > 0
    scale = np.where(live, scale, 1.0)
    fits = []
    for s in settings:
        w = (n0 / n1) ** s["weight_power"]
        relative = moments.deviations(np.array([1.0, w]))[1] / scale
        lam, alpha = s["reg_param"], s["elastic_net"]
        theta = np.append(np.log(w * n1 / n0), np.zeros(d))
        fits.append(Fit(w, np.append(0.0, lam * alpha * relative), np.append(0.0, lam * (1 - alpha) * relative ** 2), theta, np.append(True, live)))

    def one_pass(todo: list[int]) -> dict[int, np.ndarray]:
        theta = np.stack([fits[t].theta for t in todo], axis=1)
        weight = np.array([fits[t].weight for t in todo])

        def run(batches):
            k = len(todo)
            loss, gradient, hessian = np.zeros(k), np.zeros((k, d + 1)), np.zeros((k, d + 1, d + 1))
            for y, x, _ in arrays(batches, d):
                z = np.ones((len(y), d + 1))
                np.divide((x - mean[:, None]).T, scale, out=z[:, 1:])
                margin = z @ theta
                w = np.where(y[:, None] == 1, weight, 1.0)
                tail = np.exp(-np.abs(margin))
                p = np.where(margin >= 0, 1.0, tail) / (1.0 + tail)
                loss += (w * (np.maximum(margin, 0) + np.log1p(tail) - y[:, None] * margin)).sum(axis=0)
                gradient += (w * (p - y[:, None])).T @ z
                root = np.sqrt(w * p * (1.0 - p))
                for t in range(k):
                    own = z * root[:, t:t + 1]
                    hessian[t] += own.T @ own
            for t in range(k):
                yield todo[t], np.concatenate([[loss[t]], gradient[t], hessian[t].ravel()])

        return summed(blocks, run)

    for _ in range(MAX_PASSES):
        todo = [t for t, f in enumerate(fits) if not f.done]
        if not todo:
            break
        for t, sums in one_pass(todo).items():
            sums = sums / (n0 + fits[t].weight * n1)
            fits[t].step(sums[0], sums[1:d + 2], sums[d + 2:].reshape(d + 1, d + 1))
    out = []
    for f in fits:
        own = np.where(live, f.theta[1:] / scale, 0.0)
        out.append(CompiledLinear(tuple(cols), [float(c) for c in own], float(f.theta[0] - (own * mean).sum())))
    return out


def score_linear(models: list[CompiledLinear], valid: DataFrame, id_col: str = "txn_id") -> DataFrame:
    """(trial, txn_id, y, score) of every model's scores of ``valid``, in one pass; a row's score depends on its values alone."""
    cols = list(models[0].features)

    def run(batches):
        for y, x, ids in arrays(batches, len(cols)):
            for t, m in enumerate(models):
                margin = np.full(len(y), m.intercept)
                for j, c in enumerate(m.coefficients):
                    if c:
                        margin += x[j] * c
                with np.errstate(over="ignore"):
                    score = 1.0 / (1.0 + np.exp(-margin))
                label = pa.array(np.nan_to_num(y).astype(np.int32), mask=np.isnan(y))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(y), t, np.int32)), pa.array(ids), label, pa.array(score)],
                                                 names=["trial", id_col, "y", "score"])

    return packed(valid, cols, F.col(id_col))[1].mapInArrow(run, f"trial int, {id_col} long, y int, score double")
