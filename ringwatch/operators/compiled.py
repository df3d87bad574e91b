"""Fitted models as column expressions (K1, K2, K5), with reasons per score.

A boosted-tree pipeline becomes, per tree, one nested CASE over the features that gives the
number of the leaf a row falls into, and lookups in constant arrays indexed by leaf:
the leaf's prediction, and per feature what the splits on it added along the path. The
logistic scorer becomes a weighted sum. Batch, stream and audit so score inside generated
code, without vectors, ML stages or Python; scores equal ``transform``.

Reasons: from the root to a leaf each split moves the prediction from its node's to its
child's, and that change is credited to the split's feature. Root predictions (``base``)
plus all contributions are the raw score (log-odds over two), exactly but for rounding.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass
class Node:
    """A tree's node: leaves have no feature; ``left`` holds rows at or below ``threshold`` or of ``categories``."""

    prediction: float
    feature: int | None = None
    threshold: float | None = None
    categories: tuple[float, ...] | None = None
    left: Node | None = None
    right: Node | None = None


def _read(java) -> Node:
    node = Node(float(java.prediction()))
    if java.getClass().getSimpleName() == "InternalNode":
        split = java.split()
        node.feature = int(split.featureIndex())
        if split.getClass().getSimpleName() == "ContinuousSplit":
            node.threshold = float(split.threshold())
        else:
            node.categories = tuple(float(c) for c in split.leftCategories())
        node.left, node.right = _read(java.leftChild()), _read(java.rightChild())
    return node


def _leaves(node: Node, path: dict[int, float]) -> list[tuple[float, dict[int, float]]]:
    """(prediction, what each feature's splits added on the way) of the leaves, from left to right."""
    if node.feature is None:
        return [(node.prediction, path)]
    out = []
    for child in (node.left, node.right):
        step = path | {node.feature: path.get(node.feature, 0.0) + child.prediction - node.prediction}
        out += _leaves(child, step)
    return out


def _leaf_sql(node: Node, first: int = 0) -> tuple[str, int]:
    """(SQL for the number of a row's leaf, number of leaves)."""
    if node.feature is None:
        return str(first), 1
    left, n = _leaf_sql(node.left, first)
    right, m = _leaf_sql(node.right, first + n)
    x = f"_x{node.feature}"
    test = f"{x} <= {node.threshold!r}D" if node.categories is None else f"{x} IN ({', '.join(f'{c!r}D' for c in node.categories)})"
    return f"CASE WHEN {test} THEN {left} ELSE {right} END", n + m


#: Columns whose missing values the models read as 0, in training and in ``score_with``.
ZERO_IF_MISSING = ("sender_seconds_since_last_send",)


def _number(c: str) -> Column:
    """A feature as the assembler sees it: missing values are 0 or NaN, and NaN is above every threshold."""
    return F.coalesce(F.col(c).cast("double"), F.lit(0.0 if c in ZERO_IF_MISSING else float("nan")))


@dataclass
class CompiledTrees:
    """A boosted-tree pipeline as expressions over the feature columns."""

    features: tuple[str, ...]
    labels: dict[str, list[str]]
    trees: list[Node]
    weights: list[float]

    @classmethod
    def of(cls, model: PipelineModel) -> CompiledTrees:
        labels = {s.getOutputCol(): list(s.labels) for s in model.stages if isinstance(s, StringIndexerModel)}
        assembler, boosted = model.stages[-2], model.stages[-1]
        if not isinstance(boosted, GBTClassificationModel):
            raise ValueError(f"not a boosted-tree pipeline: {type(boosted).__name__}")
        return cls(tuple(assembler.getInputCols()), labels, [_read(t._java_obj.rootNode()) for t in boosted.trees],
                   [float(w) for w in boosted.treeWeights])

    def _input(self, feature: str) -> Column:
        if feature not in self.labels:
            return _number(feature)
        known = self.labels[feature]  # a code: place among the training values, the next number for any other
        at = F.array_position(F.array(*map(F.lit, known)), F.col(feature.removesuffix("_code"))) if known else F.lit(0)
        return F.when(F.coalesce(at, F.lit(0)) > 0, (at - 1).cast("double")).otherwise(F.lit(float(len(known))))

    def _leaf_numbers(self, df: DataFrame) -> DataFrame:
        used = sorted({f for t in self.trees for f in _used(t)})
        df = df.select("*", *[self._input(self.features[j]).alias(f"_x{j}") for j in used])
        leaves = F.array(*[F.expr(_leaf_sql(t)[0]) for t in self.trees])
        return df.withColumn("_leaves", leaves).drop(*[f"_x{j}" for j in used])

    def _sum(self, values: list[list[float]]) -> Column:
        total = F.lit(0.0)
        for t, (per_leaf, w) in enumerate(zip(values, self.weights)):
            if any(per_leaf):
                total = total + F.array(*[F.lit(w * v) for v in per_leaf])[F.col("_leaves")[t]]
        return total

    @property
    def base(self) -> float:
        return sum(w * t.prediction for t, w in zip(self.trees, self.weights))

    def score(self, df: DataFrame, reasons: bool = False) -> DataFrame:
        """``df`` with ``margin`` (raw score) and ``score`` (probability of class 1); with ``reasons`` also ``base`` and
        ``contributions``, an array of (feature, value) over all features that any tree splits on."""
        paths = [_leaves(t, {}) for t in self.trees]
        out = self._leaf_numbers(df).withColumn("margin", self._sum([[p for p, _ in leaves] for leaves in paths]))
        out = out.withColumn("score", 1.0 / (1.0 + F.exp(-2.0 * F.col("margin"))))
        if reasons:
            used = sorted({f for t in self.trees for f in _used(t)})
            parts = [F.struct(F.lit(self.features[j]).alias("feature"),
                              self._sum([[path.get(j, 0.0) for _, path in leaves] for leaves in paths]).alias("value")) for j in used]
            kind = "array<struct<feature:string,value:double>>"
            out = out.withColumns({"base": F.lit(self.base), "contributions": (F.array(*parts) if parts else F.array()).cast(kind)})
        return out.drop("_leaves")


def _used(node: Node) -> set[int]:
    return set() if node.feature is None else {node.feature} | _used(node.left) | _used(node.right)


@dataclass
class CompiledLinear:
    """A logistic pipeline as a weighted sum of its input columns."""

    features: tuple[str, ...]
    coefficients: list[float]
    intercept: float

    @classmethod
    def of(cls, model: PipelineModel) -> CompiledLinear:
        assembler, fitted = model.stages[-2], model.stages[-1]
        return cls(tuple(assembler.getInputCols()), [float(c) for c in fitted.coefficients.toArray()], float(fitted.intercept))

    def score(self, df: DataFrame) -> DataFrame:
        """``df`` with ``margin`` (log-odds) and ``score`` (probability of class 1)."""
        margin = F.lit(self.intercept)
        for c, w in zip(self.features, self.coefficients):
            margin = margin + _number(c) * F.lit(w)
        return df.withColumn("margin", margin).withColumn("score", 1.0 / (1.0 + F.exp(-F.col("margin"))))


def explained_queue(scored: DataFrame, k: int = 20, n_reasons: int = 3) -> DataFrame:
    """Accounts ranked by their highest transfer score (payer side), top ``k``, with the ``n_reasons`` features of that
    transfer that raised its score most. ``scored`` is ``CompiledTrees.score`` with reasons. Ties go by transfer, then
    by account; features that lowered the score are no reasons."""
    best = scored.groupBy("from_account").agg(F.max_by(F.struct("txn_id", "score", "margin", "base", "contributions"),
                                                       F.struct(F.col("score"), -F.col("txn_id"))).alias("b"))
    top = best.select("from_account", "b.*").orderBy(F.col("score").desc(), F.col("from_account")).limit(k)
    raised = F.filter("contributions", lambda x: x["value"] > 0)
    ranked = F.array_sort(F.transform(raised, lambda x: F.struct((-x["value"]).alias("v"), x["feature"].alias("feature"))))
    reasons = F.transform(F.slice(ranked, 1, n_reasons), lambda x: F.struct(x["feature"].alias("feature"), (-x["v"]).alias("value")))
    return top.select(F.col("from_account").alias("account"), F.col("score").alias("max_score"), F.col("txn_id").alias("top_txn_id"),
                      reasons.alias("reasons"))
