"""Binary logistic regression with elastic-net penalties: settings trained together, one pass over the rows a step.

The weights of all settings are a small matrix. A step is one aggregate for all of them: every task adds up the
gradients of its rows, as integers in fixed point, so the sum is the same however rows are dealt. The driver then takes
an accelerated proximal step (soft thresholds for the L1 part) on the matrix. Features are scaled to unit deviation and,
with an intercept, centred; penalties apply to scaled weights. A feature that never varies keeps weight zero.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.operators.scan import running_totals

#: A row's share of a gradient is rounded to 2**-28, so 2**29 rows of 2**6 deviations fit a task's sums.
GRADIENT_BITS = 28
#: Scores are ranked in steps of 2**-20, far above the noise of the last bits.
SCORE_BITS = 20


@dataclass(frozen=True)
class Setting:
    reg_param: float = 0.0001
    fit_intercept: bool = True
    max_iter: int = 10
    elastic_net: float = 1.0

    @property
    def lasso(self) -> float:
        return self.reg_param * self.elastic_net

    @property
    def ridge(self) -> float:
        return self.reg_param * (1.0 - self.elastic_net)


def grid(
    reg_params: Sequence[float] = (0.0001, 0.01, 1.0),
    intercepts: Sequence[bool] = (True, False),
    max_iters: Sequence[int] = (10,),
    elastic_nets: Sequence[float] = (0.1, 0.5, 1.0),
) -> list[Setting]:
    """Every combination; 18 by default."""
    return [Setting(*values) for values in product(reg_params, intercepts, max_iters, elastic_nets)]


@dataclass
class Fitted:
    """Weights of all settings on scaled features; the last column is the intercept."""

    settings: list[Setting]
    features: list[str]
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    rows: int
    steps: list[int] = field(default_factory=list)

    def shift(self) -> np.ndarray:
        """What is taken off the features before scaling, by setting."""
        return np.where([[s.fit_intercept] for s in self.settings], self.mean, 0.0)

    def coefficients(self) -> np.ndarray:
        """Weights for features as given, intercept last."""
        own = self.weights[:, :-1] / self.scale
        return np.column_stack([own, self.weights[:, -1] - (own * self.shift()).sum(axis=1)])


def _moments(points: DataFrame, features: Sequence[str]) -> tuple[int, np.ndarray, np.ndarray]:
    sums = [f(F.col(c)).alias(f"{k}_{i}") for i, c in enumerate(features) for k, f in (("s", F.sum), ("q", lambda x: F.sum(x * x)))]
    row = points.agg(F.count(F.lit(1)).alias("n"), *sums).first()
    n, size = row.n, range(len(features))
    if not n:
        return 0, np.zeros(len(features)), np.ones(len(features))
    mean = np.array([row[f"s_{i}"] / n for i in size])
    square = np.array([row[f"q_{i}"] / n for i in size])
    deviation = np.sqrt(np.maximum(square - mean * mean, 0.0))
    return n, mean, np.where(deviation > 0, deviation, np.inf)


def _scaled(batch: pa.RecordBatch, features: Sequence[str], scale: np.ndarray) -> np.ndarray:
    x = np.column_stack([batch.column(f).to_numpy(zero_copy_only=False).astype(float) for f in features])
    return np.column_stack([x / scale, np.ones(len(x))])


def _offsets(fitted: Fitted) -> np.ndarray:
    return np.column_stack([fitted.shift() / fitted.scale, np.zeros(len(fitted.settings))])


def mean_gradients(points: DataFrame, fitted: Fitted, at: np.ndarray) -> np.ndarray:
    """The gradient of every setting's mean loss at the weights ``at``, on scaled features."""
    features, scale, offsets = fitted.features, fitted.scale, _offsets(fitted)
    centred = np.array([s.fit_intercept for s in fitted.settings])
    one = float(1 << GRADIENT_BITS)
    ddl = "setting int, pos int, total bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(at.shape, np.int64)
        for batch in batches:
            x, label = _scaled(batch, features, scale), batch.column("label").to_numpy(zero_copy_only=False)
            for k in range(len(at)):
                own = x - offsets[k]
                error = 1.0 / (1.0 + np.exp(-(own @ at[k]))) - label
                total[k] += np.floor(own * error[:, None] * one + 0.5).astype(np.int64).sum(axis=0)
        setting, pos = np.indices(at.shape)
        columns = [pa.array(c.ravel(), t) for c, t in ((setting, pa.int32()), (pos, pa.int32()), (total, pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["setting", "pos", "total"])

    parts = points.select("label", *features).mapInArrow(run, ddl)
    sums = parts.groupBy("setting", "pos").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    found = np.zeros(at.shape)
    for row in sums.collect():  # one row for each weight
        found[row.setting, row.pos] = float(row.total) / one / max(1, fitted.rows)
    found[~centred, -1] = 0.0
    return found


def fit_all(points: DataFrame, features: Sequence[str], settings: Sequence[Setting], tolerance: float = 0.0) -> Fitted:
    """All ``settings`` on ``points(label 0 or 1, feature columns)``; each takes its ``max_iter`` steps.

    With a ``tolerance``, a setting whose optimality conditions hold within it stops early (``violations``). Rows without a
    label are left out, a null feature is an error of the aggregate's types. Without rows all weights stay zero.
    """
    points = points.filter("label is not null")
    n, mean, scale = _moments(points, features)
    settings, features = list(settings), list(features)
    fitted = Fitted(settings, features, mean, scale, np.zeros((len(settings), len(features) + 1)), n, [0] * len(settings))
    penalised = np.append(np.ones(len(features)), 0.0)
    lasso = np.array([[s.lasso] for s in settings]) * penalised
    ridge = np.array([[s.ridge] for s in settings]) * penalised
    used = np.isfinite(scale)
    raw = (1.0 + (mean[used] / scale[used]) ** 2).sum()
    bound = [0.25 * ((used.sum() + 1) if s.fit_intercept else raw) + s.ridge for s in settings]
    rate = np.array([[1.0 / b if b else 0.0] for b in bound])
    before, at, pace = fitted.weights, fitted.weights.copy(), 1.0
    open_ = np.ones(len(settings), bool)
    for step in range(max((s.max_iter for s in settings), default=0)):
        open_ &= np.array([step < s.max_iter for s in settings])
        if not open_.any() or not n:
            break
        moved = at - rate * (mean_gradients(points, fitted, at) + ridge * at)
        weights = np.sign(moved) * np.maximum(np.abs(moved) - rate * lasso, 0.0)
        weights = np.where(open_[:, None], weights, before)
        following = (1.0 + np.sqrt(1.0 + 4.0 * pace * pace)) / 2.0
        at = weights + (pace - 1.0) / following * (weights - before)
        before, pace = weights, following
        fitted.weights = weights
        fitted.steps = [s + int(o) for s, o in zip(fitted.steps, open_)]
        if tolerance and step % 10 == 9:
            open_ &= violations(points, fitted).max(axis=1) > tolerance
    return fitted


def violations(points: DataFrame, fitted: Fitted) -> np.ndarray:
    """By setting and weight, how far the optimality conditions are from holding.

    A weight in use needs a gradient opposite to its penalty's; one at zero a gradient no larger than the L1 penalty.
    """
    gradient, weights = mean_gradients(points, fitted, fitted.weights), fitted.weights
    out = np.zeros_like(weights)
    for k, s in enumerate(fitted.settings):
        w, g = weights[k, :-1], gradient[k, :-1] + s.ridge * weights[k, :-1]
        out[k, :-1] = np.where(w != 0, np.abs(g + s.lasso * np.sign(w)), np.maximum(np.abs(g) - s.lasso, 0.0))
        out[k, -1] = abs(gradient[k, -1])
    return out


def certificate(points: DataFrame, fitted: Fitted) -> DataFrame:
    """``(setting, feature, weight, coefficient, gradient, penalty, violation)``; the intercept is feature ''."""
    gradient, off = mean_gradients(points, fitted, fitted.weights), violations(points, fitted)
    own = fitted.coefficients()
    rows = [
        (k, name, *(float(m[k, i]) for m in (fitted.weights, own, gradient)), s.lasso if name else 0.0, float(off[k, i]))
        for k, s in enumerate(fitted.settings)
        for i, name in enumerate([*fitted.features, ""])
    ]
    schema = "setting int, feature string, weight double, coefficient double, gradient double, penalty double, violation double"
    return points.sparkSession.createDataFrame(rows, schema)


def scores(points: DataFrame, fitted: Fitted) -> DataFrame:
    """``(setting, label, score)`` for every row and setting; the score is the margin in steps of ``2**-SCORE_BITS``."""
    features, scale, offsets, weights = fitted.features, fitted.scale, _offsets(fitted), fitted.weights
    ddl = "setting int, label double, score bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _scaled(batch, features, scale)
            for k in range(len(weights)):
                margin = np.floor((x - offsets[k]) @ weights[k] * float(1 << SCORE_BITS) + 0.5).astype(np.int64)
                columns = [pa.array(np.full(len(x), k, np.int32)), batch.column("label"), pa.array(margin)]
                yield pa.RecordBatch.from_arrays(columns, ["setting", "label", "score"])

    return points.select("label", *features).mapInArrow(run, ddl)


def areas(scored: DataFrame) -> DataFrame:
    """``(setting, area)``: the exact area under the ROC curve of ``(setting, label, score)``; null where a class is absent."""
    ones, zeros = (F.count(F.when(F.col("label") == value, 1)) for value in (1.0, 0.0))
    cells = scored.groupBy("setting", "score").agg(ones.alias("ones"), zeros.alias("zeros"))
    run = running_totals(cells, ["setting"], "score", ["ones", "zeros"])
    above = F.sum(F.col("ones") * (F.col("upto_zeros") - F.col("zeros") / 2.0))
    sizes = F.any_value("all_ones").cast("double") * F.any_value("all_zeros")
    return run.groupBy("setting").agg(F.try_divide(above, sizes).alias("area"))


def search(points: DataFrame, features: Sequence[str], settings: Sequence[Setting], train: str = "train") -> tuple[DataFrame, Fitted]:
    """``(setting, reg_param, fit_intercept, max_iter, elastic_net, area)`` on the rows whose ``split`` is not ``train``.

    All settings are fitted on the ``train`` rows together and scored in one pass.
    """
    fitted = fit_all(points.filter(F.col("split") == train), features, settings)
    found = areas(scores(points.filter(F.col("split") != train), fitted))
    rows = [(k, s.reg_param, s.fit_intercept, s.max_iter, s.elastic_net) for k, s in enumerate(settings)]
    schema = "setting int, reg_param double, fit_intercept boolean, max_iter int, elastic_net double"
    return points.sparkSession.createDataFrame(rows, schema).join(found, "setting", "left"), fitted


def best(results: DataFrame, digits: int = 9) -> DataFrame:
    """``(param, value double)`` of the setting with the largest area, the first of those equal to ``digits`` digits."""
    first = results.orderBy(F.desc_nulls_last(F.round("area", digits)), "setting").limit(1)
    params = ["reg_param", "fit_intercept", "max_iter", "elastic_net"]
    return first.select(F.explode(F.array(*(F.struct(F.lit(p).alias("param"), F.col(p).cast("double").alias("value")) for p in params))).alias("p")).select("p.*")
