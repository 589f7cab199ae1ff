"""A classification tree by exact Gini splits, as a table of nodes and as a column expression.

Every value of every feature is a possible threshold. A level counts classes by node, feature and value, adds them up along the
values (``scan.running_totals``), and takes each node's best split, for all features and nodes of the level in one go. Rows
carry no state: a row's node is an expression of its features, which grows with the tree. The driver holds nodes only,
fewer than ``2 ** (max_depth + 1)``.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginalia.operators.scan import running_totals


class Node(NamedTuple):
    """Children of node n are 2n (at most the threshold) and 2n + 1; a leaf has no feature."""

    node: int
    counts: tuple[int, ...]
    feature: str | None = None
    threshold: float | None = None
    gain: float | None = None

    @property
    def prediction(self) -> int:
        """The class with the most rows, the smaller one of equals."""
        return max(range(len(self.counts)), key=lambda c: (self.counts[c], -c))


def node_of(nodes: dict[int, Node], of: str = "node", root: int = 1) -> Column:
    """The leaf that a row falls in (``node``), or its class (``prediction``), as nested conditions on feature columns."""
    found = nodes[root]
    if found.feature is None:
        return F.lit(found.node) if of == "node" else F.lit(float(found.prediction))
    low, high = node_of(nodes, of, 2 * root), node_of(nodes, of, 2 * root + 1)
    return F.when(F.col(found.feature) <= found.threshold, low).otherwise(high)


def best_splits(points: DataFrame, features: Sequence[str], classes: int) -> list:
    """For every ``node`` of ``points(node, label, feature columns)`` the split that leaves least impurity, if any.

    Of equal splits the first feature wins, then the smallest threshold. Impurity is weighed by rows; what is compared is the sum
    over both sides of the squared class counts over the rows.
    """
    sums = [f"c_{c}" for c in range(classes)]
    cells = F.explode(F.array(*(F.struct(F.lit(k).alias("feature"), F.col(f).alias("value")) for k, f in enumerate(features))))
    cells = points.select("node", "label", cells.alias("cell")).select("node", "label", "cell.feature", "cell.value")
    counted = [F.count(F.when(F.col("label") == float(c), 1)).alias(s) for c, s in enumerate(sums)]
    cells = cells.groupBy("node", "feature", "value").agg(*counted)
    run = running_totals(cells, ["node", "feature"], "value", sums)

    def sides(side):
        counts = [side(s).cast("double") for s in sums]
        rows, squares = counts[0], counts[0] * counts[0]
        for c in counts[1:]:
            rows, squares = rows + c, squares + c * c
        return rows, squares

    (n_low, low), (n_high, high), (n_all, all_) = (
        sides(lambda s: F.col(f"upto_{s}")),
        sides(lambda s: F.col(f"all_{s}") - F.col(f"upto_{s}")),
        sides(lambda s: F.col(f"all_{s}")),
    )
    scored = run.filter(n_high > 0).withColumn("score", low / n_low + high / n_high)
    scored = scored.withColumn("gain", (F.col("score") - all_ / n_all) / n_all)
    kept = F.struct("score", (-F.col("feature")).alias("f"), (-F.col("value")).alias("v"), "gain", "feature", "value", *(f"upto_{s}" for s in sums))
    return scored.groupBy("node").agg(F.max(kept).alias("best")).select("node", "best.*").collect()  # one row a node


def fit(points: DataFrame, features: Sequence[str], classes: int, max_depth: int = 5, min_gain: float = 1e-9) -> dict[int, Node]:
    """The nodes of a tree on ``points(label, feature columns)`` by number.

    A node is split if that lowers its Gini impurity by more than ``min_gain``. Rows without a label are left out; a feature that is
    null or not a number raises an error. No rows give a root without counts.
    """
    checked = [
        F.when(F.col(f).isNull() | F.isnan(F.col(f).cast("double")), F.raise_error(F.lit(f"{f} is not a number")))
        .otherwise(F.col(f).cast("double"))
        .alias(f)
        for f in features
    ]
    rows = points.filter("label is not null").select("label", *checked)
    first = rows.agg(*(F.count(F.when(F.col("label") == float(c), 1)) for c in range(classes))).first()
    nodes = {1: Node(1, tuple(first))}
    growing = {1}
    for _ in range(max_depth):
        if not growing or not any(nodes[n].counts[nodes[n].prediction] for n in growing):
            break
        placed = rows.withColumn("node", node_of(nodes))
        placed = placed.filter(F.col("node").isin(sorted(growing)))
        level, growing = best_splits(placed, features, classes), set()
        for row in level:
            if row.gain > min_gain:
                parent = nodes[row.node]
                low = tuple(row[f"upto_c_{c}"] for c in range(classes))
                high = tuple(a - b for a, b in zip(parent.counts, low))
                nodes[row.node] = parent._replace(feature=features[row.feature], threshold=row.value, gain=row.gain)
                for number, counts in ((2 * row.node, low), (2 * row.node + 1, high)):
                    nodes[number] = Node(number, counts)
                    if sum(1 for c in counts if c) > 1:
                        growing.add(number)
    return nodes


def node_table(nodes: dict[int, Node], points: DataFrame) -> DataFrame:
    """``(node, parent, feature, threshold, gain, n, counts array<bigint>, prediction)``, one row a node."""
    rows = [
        (n.node, n.node // 2 or None, n.feature, n.threshold, n.gain, sum(n.counts), list(n.counts), float(n.prediction))
        for n in nodes.values()
    ]
    schema = "node bigint, parent bigint, feature string, threshold double, gain double, n bigint, counts array<bigint>, prediction double"
    return points.sparkSession.createDataFrame(rows, schema)


def from_model(model, features: Sequence[str]) -> dict[int, Node]:
    """The same nodes from a fitted Spark ML decision tree with continuous features, counted on its training rows."""
    nodes: dict[int, Node] = {}

    def walk(at, number: int) -> None:
        counts = tuple(int(c) for c in at.impurityStats().stats())
        if at.subtreeDepth() == 0:
            nodes[number] = Node(number, counts)
            return
        split = at.split()
        nodes[number] = Node(number, counts, features[split.featureIndex()], split.threshold(), at.gain())
        walk(at.leftChild(), 2 * number)
        walk(at.rightChild(), 2 * number + 1)

    walk(model._call_java("rootNode"), 1)
    return nodes


def score(nodes: dict[int, Node], points: DataFrame) -> DataFrame:
    """``points`` with ``leaf`` and ``prediction``, by built-in expressions on the feature columns."""
    return points.withColumns({"leaf": node_of(nodes).cast("bigint"), "prediction": node_of(nodes, "prediction")})
