"""A feed-forward classifier trained by gradient aggregates: logistic hidden layers, softmax output, mean log loss.

An epoch is one pass: every task goes through its rows batch by batch, forward and back, and hands on one gradient
vector and its loss. Steps are scaled by the last few gradients (L-BFGS), on the driver. Each row's part is rounded to fixed point before it is added, so the sums are the same in any order
and for any partitioning. The driver holds the parameters, a few numbers for each pair of neighbouring units. A
step that does not lower the loss is taken back and tried at half the rate, so the loss falls from epoch to epoch.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.functions.vectors import checked, width_of

#: Each row's part is rounded to 2**-28; with parts of up to 2**6, a task adds up 2**29 rows.
PART_BITS = 28
#: Rows that are multiplied out at once.
CHUNK = 512


@dataclass(frozen=True)
class Epoch:
    number: int
    loss: float
    rate: float  # of the step that led here
    passes: int  # over the rows, so far


@dataclass
class Network:
    """``layers``: one matrix for each, a row for each unit it reads and a last row of offsets."""

    classes: list
    layers: list[np.ndarray]
    epochs: list[Epoch] = field(default_factory=list)


def start_layers(sizes: Sequence[int], seed: int = 1) -> list[np.ndarray]:
    """Weights drawn evenly from a range that narrows with the units read; offsets zero."""
    rng = np.random.default_rng(seed)
    out = []
    for below, above in zip(sizes, sizes[1:]):
        bound = np.sqrt(6.0 / (below + above))
        out.append(np.vstack([rng.uniform(-bound, bound, (below, above)), np.zeros((1, above))]))
    return out


def _outputs(x: np.ndarray, layers: Sequence[np.ndarray]) -> list[np.ndarray]:
    """What every layer gives; sums of a row do not depend on the rows beside it."""
    seen = [x]
    for k, layer in enumerate(layers):
        z = np.einsum("ij,jk->ik", seen[-1], layer[:-1]) + layer[-1]
        if k < len(layers) - 1:
            seen.append(1.0 / (1.0 + np.exp(-z)))
        else:
            z = np.exp(z - z.max(axis=1, keepdims=True))
            seen.append(z / z.sum(axis=1, keepdims=True))
    return seen


def _parts(x: np.ndarray, label: np.ndarray, layers: Sequence[np.ndarray]) -> np.ndarray:
    """By row, the gradient of the loss by every parameter, then the loss."""
    seen = _outputs(x, layers)
    chosen = seen[-1][np.arange(len(x)), label]
    delta, found = seen[-1].copy(), [-np.log(np.maximum(chosen, 1e-300))[:, None]]
    delta[np.arange(len(x)), label] -= 1.0
    for k in range(len(layers) - 1, -1, -1):
        weights = (seen[k][:, :, None] * delta[:, None, :]).reshape(len(x), -1)
        found[:0] = [weights, delta]
        if k:
            delta = np.einsum("ik,jk->ij", delta, layers[k][:-1]) * seen[k] * (1.0 - seen[k])
    return np.column_stack(found)


def labelled_rows(points: DataFrame, classes: Sequence, width: int) -> DataFrame:
    """``(x, label int)``: the label's place in ``classes``; a label outside of them is an error."""
    place = F.array_position(F.array(*(F.lit(c) for c in classes)), F.col("label"))
    unknown = F.raise_error(F.concat(F.lit("unknown class: "), F.coalesce(F.col("label").cast("string"), F.lit("null"))))
    label = F.when(F.coalesce(place, F.lit(0)) > 0, place - 1).otherwise(unknown.cast("bigint"))
    return points.select(checked(F.col("features").cast("array<double>"), width).alias("x"), label.cast("int").alias("label"))


def gradient(rows: DataFrame, layers: Sequence[np.ndarray], n: int) -> tuple[list[np.ndarray], float]:
    """The mean gradient, shaped as ``layers``, and the mean loss of the ``n`` rows of ``labelled_rows``."""
    shapes, one = [layer.shape for layer in layers], float(1 << PART_BITS)
    size, width = sum(layer.size for layer in layers) + 1, len(layers[0]) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            label = batch.column("label").to_numpy(zero_copy_only=False)
            for at in range(0, len(x), CHUNK):
                parts = _parts(x[at : at + CHUNK], label[at : at + CHUNK], layers)
                total += np.floor(parts * one + 0.5).astype(np.int64).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], ["pos", "total"])

    sums = rows.mapInArrow(run, "pos int, total bigint").groupBy("pos").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    found = np.zeros(size)
    for row in sums.collect():  # one for each parameter
        found[row.pos] = float(row.total) / one / n
    ends = np.cumsum([a * b for a, b in shapes])
    return [found[end - a * b : end].reshape(a, b) for end, (a, b) in zip(ends, shapes)], float(found[-1])


def fit(
    points: DataFrame,
    classes: Sequence,
    hidden: Sequence[int] = (16,),
    epochs: int = 40,
    rate: float = 1.0,
    seed: int = 1,
    layers: Sequence[np.ndarray] | None = None,
    history: int = 10,
    max_halvings: int = 30,
) -> Network:
    """Train on ``points(features array<double>, label)`` for ``epochs`` steps, each of which lowers the loss.

    The first step is ``rate`` times the gradient; later ones are scaled by the last ``history`` steps and what they changed in
    the gradient; with none, ``rate`` stays. Training ends early where no step of up to ``max_halvings`` halvings lowers the
    loss. Without rows an error is raised.
    """
    width, n = width_of(points), points.count()
    if not n or not width:
        raise ValueError("no rows to train on")
    classes = list(classes)
    now = [m.copy() for m in layers] if layers else start_layers([width, *hidden, len(classes)], seed)
    rows = labelled_rows(points, classes, width).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        slope, loss = gradient(rows, now, n)
        out, passes, pairs = Network(classes, now, [Epoch(0, loss, 0.0, 1)]), 1, []
        for number in range(1, epochs + 1):
            way, step = _direction(slope, pairs), 1.0 if pairs else rate
            for _ in range(max_halvings + 1):
                tried = [m - step * d for m, d in zip(now, way)]
                following, reached = gradient(rows, tried, n)
                passes += 1
                if reached < loss:
                    break
                step /= 2.0
            else:
                break
            moved, turned = _flat(tried) - _flat(now), _flat(following) - _flat(slope)
            if moved @ turned > 1e-10 * (turned @ turned):
                pairs = [*pairs, (moved, turned)][-history:] if history else []
            now, slope, loss, rate = tried, following, reached, rate if pairs else step
            out.layers = now
            out.epochs.append(Epoch(number, loss, step, passes))
        return out
    finally:
        rows.unpersist()


def _flat(layers: Sequence[np.ndarray]) -> np.ndarray:
    return np.concatenate([m.ravel() for m in layers])


def _direction(slope: Sequence[np.ndarray], pairs: Sequence[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    """The gradient times an estimate of the inverse curvature from pairs of steps and changes of the gradient."""
    way, shares = _flat(slope), []
    for moved, turned in reversed(pairs):
        shares.append((moved @ way) / (moved @ turned))
        way = way - shares[-1] * turned
    if pairs:
        moved, turned = pairs[-1]
        way = way * ((moved @ turned) / (turned @ turned))
    for (moved, turned), share in zip(pairs, reversed(shares)):
        way = way + (share - (turned @ way) / (moved @ turned)) * moved
    ends = np.cumsum([m.size for m in slope])
    return [way[end - m.size : end].reshape(m.shape) for end, m in zip(ends, slope)]


def parameter_table(points: DataFrame, layers: Sequence[np.ndarray]) -> DataFrame:
    """``(layer, source, target, value)``, all from 0; the offset's source is one past the last unit."""
    rows = [(k, i, j, float(m[i, j])) for k, m in enumerate(layers) for i in range(m.shape[0]) for j in range(m.shape[1])]
    return points.sparkSession.createDataFrame(rows, "layer int, source int, target int, value double")


def epoch_log(points: DataFrame, network: Network) -> DataFrame:
    """``(epoch, loss, rate, passes)``."""
    rows = [(e.number, e.loss, e.rate, e.passes) for e in network.epochs]
    return points.sparkSession.createDataFrame(rows, "epoch int, loss double, rate double, passes int")


def predicted(points: DataFrame, network: Network) -> DataFrame:
    """``(label, prediction)`` for every row; the first of equally likely classes."""
    kind, width = points.schema["label"].dataType.simpleString(), len(network.layers[0]) - 1
    layers, classes = network.layers, network.classes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            best = _outputs(x, layers)[-1].argmax(axis=1)
            named = pa.array(classes, batch.column("label").type).take(pa.array(best))
            yield pa.RecordBatch.from_arrays([batch.column("label"), named], ["label", "prediction"])

    rows = points.select(checked(F.col("features").cast("array<double>"), width).alias("x"), "label")
    return rows.mapInArrow(run, f"label {kind}, prediction {kind}")
