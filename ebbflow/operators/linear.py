"""Logistic regression and linear margin classifier by Newton steps on
distributed Gram matrices, and cross-fitted probabilities for margins.

The objective is sum(w_i * loss_i) + |b|^2 / (2 C) on standardised features, the intercept
free. One pass over packed blocks of rows gives, for every fit that has not converged, the
loss, the gradient and the matrix X'WX: (d + 1)^2 numbers a fit, added up by Spark, whatever
the number of rows. The driver solves the small system; the next pass looks at the full step
and, for the hinge, at shorter ones beside it, and the best becomes the new point. All fits
(configurations and folds) share the passes and stop on their own, when the step is below a
fixed tolerance or lowers the objective by less than a fixed share. Fits of at most ``ALONE`` values
(rows x features) need no passes: all are one job, and a task takes all blocks and the steps of one fit.

Each fit standardises with the mean and population deviation of its own training rows, which
follow from the sums of each fold. The margin classifier's hinge is rounded quadratically
below its corner, so that it has second derivatives; the width shrinks over ``ROUNDS``, each
round starting from the last one's result.

Rows with a null label or a null or non-finite feature take no part in fits; a fit whose rows
have one class only predicts that class's share.
"""

from __future__ import annotations

import itertools
import json
import math
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ebbflow.session import materialize

BLOCK_ROWS = 16_384
TOLERANCE = 1e-10
#: A fit also ends when the step promises to lower the objective by less than this share.
GAIN = 1e-12
ROUNDS = (4.0, 1.0, 0.25, 0.05)
#: Shares of the Newton step that a pass tries.
TRIALS = {"logistic": (1.0, 0.25), "hinge": (1.0, 0.6, 0.3, 0.1, 0.02)}
#: Rows x features up to which one task takes all steps of a fit.
ALONE = 1 << 23

BLOCK = "ids array<string>, labels binary, folds binary, x binary"


@dataclass
class LinearFit:
    """One configuration on all folds but ``fold`` (all, if it is None)."""

    number: int
    loss: str                      # "logistic" or "hinge"
    c: float | None                # None: no penalty
    fold: int | None = None
    weight: tuple[float, float] = (1.0, 1.0)
    target: tuple[float, float] = (0.0, 1.0)
    mean: np.ndarray = field(default_factory=lambda: np.zeros(0))
    scale: np.ndarray = field(default_factory=lambda: np.zeros(0))
    beta: np.ndarray = field(default_factory=lambda: np.zeros(0))   # coefficients, then the intercept
    share: float = 0.5
    steps: int = 0
    platt: tuple[float, float] | None = None
    rounding: float = ROUNDS[-1]
    size: int = 0                  # training rows

    def rows(self, folds: np.ndarray) -> np.ndarray:
        return (folds >= 0) & (folds != (-1 if self.fold is None else self.fold))

    def margin(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) / self.scale @ self.beta[:-1] + self.beta[-1]

    def probability(self, x: np.ndarray) -> np.ndarray:
        if not 0 < self.share < 1:
            return np.full(len(x), self.share)
        m = self.margin(x)
        if self.loss == "hinge":
            a, b = self.platt or (1.0, 0.0)
            m = a * m + b
        return 1 / (1 + np.exp(-m))


def pieces(loss: str, m: np.ndarray, y: np.ndarray, target: tuple[float, float], width: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Loss of each row at margin ``m``, and its first and second derivative."""
    if loss == "logistic":
        t = np.where(y > 0, target[1], target[0])
        p = 1 / (1 + np.exp(-m))
        return np.logaddexp(0, m) - t * m, p - t, p * (1 - p)
    s = np.where(y > 0, 1.0, -1.0)
    gap = 1 - s * m
    inside = (gap > 0) & (gap < width)
    value = np.where(gap <= 0, 0.0, np.where(inside, gap**2 / (2 * width), gap - width / 2))
    return value, np.where(gap <= 0, 0.0, np.where(inside, -s * gap / width, -s)), np.where(inside, 1 / width, 0.0)


def blocks_of(rows: DataFrame, feature_cols: Sequence[str]) -> DataFrame:
    """A written table of packed rows (id, label, fold, features); fold -1 is held out of all fits."""
    names = [f"f{i}" for i in range(len(feature_cols))]
    wide = rows.where(F.col("label").isNotNull()).select(
        F.col("id").cast("string").alias("id"), F.col("label").cast("int").alias("label"),
        F.coalesce(F.col("fold").cast("int"), F.lit(-1)).alias("fold"), *[F.col(c).cast("double").alias(n) for c, n in zip(feature_cols, names)])

    def pack(batches):
        for batch in batches:
            x = np.stack([np.asarray(batch.column(n).fill_null(np.nan), float) for n in names], axis=1) if names else np.zeros((batch.num_rows, 0))
            keep = np.isfinite(x).all(axis=1)
            part = batch.filter(pa.array(keep))
            if part.num_rows:
                yield pa.RecordBatch.from_pydict({
                    "ids": pa.array([part.column("id").to_pylist()], pa.list_(pa.string())), "labels": [np.asarray(part.column("label"), np.int8).tobytes()],
                    "folds": [np.asarray(part.column("fold"), np.int8).tobytes()], "x": [x[keep].tobytes()]})

    n = wide.count()
    wide = wide.coalesce(1) if n <= BLOCK_ROWS else wide.repartition(math.ceil(n / BLOCK_ROWS))
    return materialize(wide.mapInArrow(pack, BLOCK), "linear-blocks")


def read_blocks(batches):
    """(ids, labels, folds, features) of every block."""
    for batch in batches:
        for k, r in enumerate(batch.select(["labels", "folds", "x"]).to_pylist()):
            y = np.frombuffer(r["labels"], np.int8)
            yield batch.column("ids")[k].values, y, np.frombuffer(r["folds"], np.int8), np.frombuffer(r["x"]).reshape(len(y), -1)


def added(blocks: DataFrame, task, alone: bool = False) -> dict[int, np.ndarray]:
    """Sums over all blocks of the arrays that ``task`` gives for a block, by their number. They
    are added in the tasks, then by Spark, so a few arrays reach the driver; the sums of a block
    that is ``alone`` are those already."""
    def local(batches):
        total: dict[int, np.ndarray] = {}
        for block in read_blocks(batches):
            for k, x in task(*block):
                total[k] = total[k] + x if k in total else x
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([np.ascontiguousarray(x, float).tobytes() for x in total.values()],
                                                                                          pa.binary())], names=["k", "x"])

    def merge(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, x in zip(batch.column("k").to_pylist(), batch.column("x").to_pylist()):
                total[k] = total[k] + np.frombuffer(x) if k in total else np.frombuffer(x)
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], names=["k", "x"])

    schema = "k int, x binary"
    out = blocks.mapInArrow(local, schema)
    if not alone:
        out = out.repartition(min(16, blocks.sparkSession.sparkContext.defaultParallelism), "k").mapInArrow(merge, schema)
    return {r["k"]: np.frombuffer(r["x"]) for r in out.toArrow().to_pylist()}


def make_fits(configs: Sequence[tuple[str, float | None]], folds: Sequence[int | None], blocks: DataFrame, d: int, balanced: bool = True,
              standardise: bool = True) -> list[LinearFit]:
    """Every configuration on every choice of rows, with its own scaling and class weights."""
    def moments(_, y, folds, x):
        for f in np.unique(folds[folds >= 0]):
            own = folds == f
            one = np.column_stack([x[own], y[own] > 0, np.ones(own.sum())])
            yield int(f), np.concatenate([one.sum(axis=0), (x[own] ** 2).sum(axis=0)])

    by = added(blocks, moments)
    out = []
    for (loss, c), fold in itertools.product(configs, folds):
        total = sum((x for f, x in by.items() if f != fold), np.zeros(2 * d + 2))
        n, pos = total[d + 1], total[d]
        mean = total[:d] / max(n, 1)
        scale = np.sqrt(np.maximum(0, total[d + 2:] / max(n, 1) - mean**2))
        scale[scale <= 1e-9 * np.maximum(1, np.abs(mean))] = 1.0
        if not standardise:
            mean, scale = np.zeros(d), np.ones(d)
        weight = (n / (2 * (n - pos)), n / (2 * pos)) if balanced and 0 < pos < n else (1.0, 1.0)
        out.append(LinearFit(len(out), loss, c, fold, weight, (0.0, 1.0), mean, scale, np.zeros(d + 1), pos / n if n else 0.0, size=int(n)))  # no rows, nothing to fit
    return out


class Search:
    """A fit between two steps: the best objective so far and the points to look at, the first of
    them the full step. There are none when it has ended."""

    def __init__(self, fit: LinearFit, tolerance: float):
        fit.rounding = ROUNDS[0]
        self.fit, self.tolerance, self.best, self.points = fit, tolerance, np.inf, [fit.beta]
        self.ridge = np.append(np.full(len(fit.beta) - 1, 1 / fit.c if fit.c else 0.0), 0.0)

    def step(self, values: Sequence[float], derivatives) -> None:
        """``values`` are the losses at the points; ``derivatives`` gives the loss's first and second ones at the point of a number."""
        f, d = self.fit, len(self.fit.beta)
        f.steps += 1
        objective = [v + (self.ridge * p**2).sum() / 2 for v, p in zip(values, self.points)]
        at = int(np.argmin(objective))
        if objective[at] >= self.best:  # no trial is better: look nearer, until that is within the tolerance
            self.points = [f.beta + (p - f.beta) / 50 for p in self.points]
            ended = max(np.abs(p - f.beta).max() for p in self.points) < self.tolerance
        else:
            self.best, f.beta = objective[at], self.points[at]
            first, second = derivatives(at)
            gradient, hessian = first + self.ridge * f.beta, second.reshape(d, d) + np.diag(self.ridge)
            step = -np.linalg.lstsq(hessian + 1e-12 * np.trace(hessian) / d * np.eye(d), gradient, rcond=None)[0]
            self.points = [f.beta + t * step for t in TRIALS[f.loss]]
            ended = np.abs(step).max() < self.tolerance or -(gradient @ step) < GAIN * abs(self.best)
            if ended and f.loss == "logistic":
                f.beta = f.beta + step  # within the tolerance, and nearer
        if ended and f.loss == "hinge" and f.rounding > ROUNDS[-1]:
            f.rounding = ROUNDS[ROUNDS.index(f.rounding) + 1]
            self.best, self.points = np.inf, [f.beta]
        elif ended:
            self.points = []


def scaled(f: LinearFit, y: np.ndarray, folds: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Standardised features with a one for the intercept, labels and weights of a block's rows in a fit."""
    rows = f.rows(folds)
    return np.column_stack([(x[rows] - f.mean) / f.scale, np.ones(rows.sum())]), y[rows], np.where(y[rows] > 0, f.weight[1], f.weight[0])


def newton(blocks: DataFrame, fits: list[LinearFit], tolerance: float = TOLERANCE) -> None:
    """Fit in place: all fits that have not ended take one step in each pass."""
    fits = [f for f in fits if 0 < f.share < 1]
    small = [f for f in fits if 0 < f.size * len(f.mean) <= ALONE]
    if small:
        _alone(blocks, small, tolerance)
    searches = {f.number: Search(f, tolerance) for f in fits if not 0 < f.size * len(f.mean) <= ALONE}
    alone = bool(searches) and blocks.limit(2).count() < 2
    while searches:
        active = [(s.fit, s.points) for s in searches.values()]

        def task(_, y, folds, x, active=active):
            for f, at in active:
                z, own, w = scaled(f, y, folds, x)
                found = []
                for beta in at:
                    value, first, second = pieces(f.loss, z @ beta, own, f.target, f.rounding)
                    found += [[w @ value], (w * first) @ z, (z.T @ (z * (w * second)[:, None])).ravel()]
                yield f.number, np.concatenate(found)

        for k, sums in added(blocks, task, alone).items():
            search, d = searches[k], len(searches[k].fit.beta)
            sums = sums.reshape(len(search.points), -1)
            search.step(sums[:, 0], lambda at: (sums[at, 1:d + 1], sums[at, d + 1:]))
            if not search.points:
                del searches[k]


def _alone(blocks: DataFrame, fits: list[LinearFit], tolerance: float) -> None:
    """The steps of each fit in one task, which takes all blocks."""
    def task(batches):
        found: dict[int, list] = {}
        for batch in batches:
            for unit, (_, *block) in zip(batch.column("unit").to_pylist(), read_blocks([batch])):
                found.setdefault(unit, []).append(block)
        for unit, own in found.items():
            f = fits[unit]
            own.sort(key=lambda b: b[2].tobytes())  # in order: the sums are the same, whatever came first
            parts = [scaled(f, *own.pop(0)) for _ in range(len(own))]
            search = Search(f, tolerance)
            while search.points:
                at = [[(w, z, *pieces(f.loss, z @ beta, y, f.target, f.rounding)) for z, y, w in parts] for beta in search.points]
                search.step([sum(w @ value for w, _, value, *_ in x) for x in at], lambda k: (
                    sum((w * first) @ z for w, z, _, first, _ in at[k]), sum(z.T @ (z * (w * second)[:, None]) for w, z, *_, second in at[k])))
            yield pa.RecordBatch.from_arrays([pa.array([unit], pa.int32()), pa.array([np.append(f.beta, [f.steps, f.rounding]).tobytes()], pa.binary())], names=["k", "x"])

    copies = blocks.withColumn("ids", F.array().cast("array<string>")).withColumn("unit", F.explode(F.sequence(F.lit(0), F.lit(len(fits) - 1))))
    for r in copies.repartitionById(len(fits), F.col("unit")).mapInArrow(task, "k int, x binary").toArrow().to_pylist():
        x, f = np.frombuffer(r["x"]), fits[r["k"]]
        f.beta, f.steps, f.rounding = x[:-2].copy(), int(x[-2]), float(x[-1])


def predictions(blocks: DataFrame, fits: list[LinearFit]) -> DataFrame:
    """(id, label, fit, fold, margin, probability) of the rows held out of each fit: the fold
    that it left out, or the rows of no fold for a fit on all."""
    def task(batches):
        for ids, y, folds, x in read_blocks(batches):
            for f in fits:
                rows = np.flatnonzero(folds == (-1 if f.fold is None else f.fold))
                whole = lambda v: pa.array(np.full(len(rows), v, np.int32))
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(rows)), pa.array(y[rows].astype(np.int32)), whole(f.number), whole(-1 if f.fold is None else f.fold),
                     pa.array(f.margin(x[rows])), pa.array(f.probability(x[rows]))], names=["id", "label", "fit", "fold", "margin", "probability"])

    return blocks.mapInArrow(task, "id string, label int, fit int, fold int, margin double, probability double")


def calibration(margins: DataFrame) -> tuple[float, float]:
    """Slope and intercept of P(1) as a logistic function of held-out margins (id, label,
    margin), with Platt's smoothed targets (n1 + 1) / (n1 + 2) and 1 / (n0 + 2)."""
    blocks = blocks_of(margins.select("id", "label", F.lit(0).alias("fold"), "margin"), ["margin"])
    fit, = make_fits([("logistic", None)], [None], blocks, 1, balanced=False, standardise=True)
    got = {r["label"]: r["n"] for r in margins.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    fit.target = 1 / (got.get(0, 0) + 2), (got.get(1, 0) + 1) / (got.get(1, 0) + 2)
    newton(blocks, [fit])
    if not 0 < fit.share < 1:
        return 0.0, math.log(fit.target[1] / (1 - fit.target[1])) if fit.share == 1 else math.log(fit.target[0] / (1 - fit.target[0]))
    a = float(fit.beta[0] / fit.scale[0])
    return a, float(fit.beta[1] - a * fit.mean[0])


def cross_fit(blocks: DataFrame, folds: list[LinearFit], final: LinearFit | None) -> tuple[float, float]:
    """Calibrate margin fits of one configuration: one calibration on the margins that the fits on
    the other folds give each row, applied to all of them and to the fit on all rows."""
    held = predictions(blocks, folds).select("id", "label", "margin")
    platt = calibration(held)
    for f in [*folds, *([final] if final else [])]:
        f.platt = platt
    return platt


@dataclass
class LinearModel:
    """A fitted linear classifier: scores rows that hold its feature columns."""

    feature_cols: list
    fit: LinearFit

    def predict(self, rows: DataFrame, key: str, keep: Sequence[str] = ()) -> DataFrame:
        """Plain expressions; a null feature gives a null probability."""
        f = self.fit
        m = F.lit(float(f.beta[-1]))
        for c, b, mean, scale in zip(self.feature_cols, f.beta, f.mean, f.scale):
            m = m + (F.col(c).cast("double") - float(mean)) * (float(b) / float(scale))
        if f.loss == "hinge":
            a, b = f.platt or (1.0, 0.0)
            m = m * a + b
        p = 1 / (1 + F.exp(-m)) if 0 < f.share < 1 else F.lit(float(f.share))
        return rows.select(F.col(key).alias("id"), *keep, p.alias("probability"), (p > 0.5).cast("int").alias("prediction"))

    def save(self, spark, path: str) -> None:
        from ebbflow.sources.io import write_json_row
        d = {k: v.tolist() if isinstance(v, np.ndarray) else v for k, v in asdict(self.fit).items()}
        write_json_row(spark.createDataFrame([(json.dumps({"feature_cols": self.feature_cols, "fit": d}),)], "model string"), path)

    @classmethod
    def load(cls, spark, path: str) -> "LinearModel":
        d = json.loads(spark.read.schema("model string").json(path).first()["model"])
        fit = {k: np.array(v) if k in ("mean", "scale", "beta") else tuple(v) if isinstance(v, list) else v for k, v in d["fit"].items()}
        return cls(d["feature_cols"], LinearFit(**fit))
