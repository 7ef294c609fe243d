"""Fitted models as column expressions.

A linear form is a sum of columns, a forest nested conditions over its node table. Either scores a
table in one projection that Catalyst optimises like any other: no vector is assembled, no model
object or session travels to the tasks, and only the columns a model uses are read.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Children of a leaf in Spark's node tables.
_NONE = -1


@dataclass(frozen=True)
class Node:
    """A node of a tree: its mean prediction and, of an inner one, the condition ``feature <= threshold``."""

    prediction: float
    left: int = _NONE
    right: int = _NONE
    feature: int = -1
    threshold: float = 0.0

    @property
    def is_leaf(self) -> bool:
        return self.left == _NONE


@dataclass(frozen=True)
class LinearForm:
    """``intercept + sum(coefficient * feature)``; its logistic is a probability."""

    features: tuple[str, ...]
    coefficients: tuple[float, ...]
    intercept: float

    def margin(self) -> Column:
        total = F.lit(float(self.intercept))
        for f, c in zip(self.features, self.coefficients):
            total = total + _double(f) * F.lit(float(c))
        return total

    def probability(self) -> Column:
        """Null if any feature is."""
        return 1.0 / (1.0 + F.exp(-self.margin()))

    def bias(self, means: Sequence[float]) -> Column:
        """The margin at the mean of all features, which contributions start from."""
        return F.lit(float(self.intercept) + sum(c * m for c, m in zip(self.coefficients, means)))

    def contributions(self, means: Sequence[float]) -> dict[str, Column]:
        """Each feature's part of the margin above ``bias``: coefficient times distance from its mean."""
        return {f: (_double(f) - F.lit(float(m))) * F.lit(float(c)) for f, c, m in zip(self.features, self.coefficients, means)}


@dataclass(frozen=True)
class Forest:
    """Weighted regression trees of a boosted classifier; twice the margin's logistic is a probability."""

    features: tuple[str, ...]
    trees: tuple[dict[int, Node], ...]
    weights: tuple[float, ...]

    def _walk(self, nodes: dict[int, Node], at: int, leaf) -> Column:
        n = nodes[at]
        if n.is_leaf:
            return leaf(at)
        ahead = _double(self.features[n.feature]) <= F.lit(float(n.threshold))
        return F.when(ahead, self._walk(nodes, n.left, leaf)).otherwise(self._walk(nodes, n.right, leaf))

    def _used(self) -> list[str]:
        return [self.features[k] for k in sorted({n.feature for t in self.trees for n in t.values() if not n.is_leaf})]

    def _whole(self, value: Column) -> Column:
        """Null where a feature that any tree asks for is null, as no side of a condition is right then."""
        missing = [F.col(f).isNull() for f in self._used()]
        if not missing:
            return value
        any_missing = missing[0]
        for m in missing[1:]:
            any_missing = any_missing | m
        return F.when(~any_missing, value)

    def margin(self) -> Column:
        total = F.lit(0.0)
        for t, w in zip(self.trees, self.weights):
            total = total + self._walk(t, 0, lambda at, t=t, w=w: F.lit(float(t[at].prediction) * w))
        used = [_double(f) for f in self._used()]
        # Additions are generated, while an aggregate over an array is interpreted with all trees in it. A
        # function of higher order (exists) keeps whole-stage code off, which would put all conditions into
        # one method; a projection of its own is generated in small ones.
        return F.when(~F.exists(F.array(*used), lambda v: v.isNull()), total) if used else total

    def probability(self) -> Column:
        """Null if a feature that any tree asks for is."""
        return 1.0 / (1.0 + F.exp(-2.0 * self.margin()))

    def bias(self, means: Sequence[float] = ()) -> Column:
        """The roots' predictions: the margin of a row nothing is known of."""
        return F.lit(float(sum(t[0].prediction * w for t, w in zip(self.trees, self.weights))))

    def leaves(self) -> Column:
        """The leaf that each tree sends a row to, as an array of numbers in the order of the trees."""
        return self._whole(F.array(*[self._walk(t, 0, lambda at, k=_numbers(t): F.lit(k[at])) for t in self.trees]))

    def contributions(self, leaves: str) -> dict[str, Column]:
        """Each feature's part of the margin above ``bias``, from the column of ``leaves``.

        Along a path every step changes the node's prediction; the change is due to the feature that
        the step asks for. The changes of a path add up to its leaf less its root.
        """
        parts: dict[int, list[Column]] = {k: [] for k in range(len(self.features))}
        for nth, (tree, weight) in enumerate(zip(self.trees, self.weights)):
            changes = _path_changes(tree)
            order = sorted(_numbers(tree), key=_numbers(tree).get)
            for k in sorted({f for c in changes.values() for f in c}):
                table = F.array(*[F.lit(changes[at].get(k, 0.0) * weight) for at in order])
                parts[k].append(F.element_at(table, F.col(leaves)[nth]))
        zero = F.lit(0.0)
        return {
            self.features[k]: F.aggregate(F.array(*p), zero, lambda total, v: total + v) if p else F.when(F.col(leaves).isNotNull(), zero)
            for k, p in parts.items()
        }


def _double(feature: str) -> Column:
    return F.col(f"`{feature}`").cast("double")


def _numbers(tree: dict[int, Node]) -> dict[int, int]:
    """Leaves by node id, numbered from 1."""
    return {at: k for k, at in enumerate(sorted(i for i, n in tree.items() if n.is_leaf), 1)}


def _path_changes(tree: dict[int, Node]) -> dict[int, dict[int, float]]:
    """Per leaf: feature -> sum of the changes of prediction at the steps that ask for it."""
    found: dict[int, dict[int, float]] = {}
    open_ = [(0, {})]
    while open_:
        at, so_far = open_.pop()
        n = tree[at]
        if n.is_leaf:
            found[at] = so_far
            continue
        for child in (n.left, n.right):
            change = tree[child].prediction - n.prediction
            open_.append((child, so_far | {n.feature: so_far.get(n.feature, 0.0) + change}))
    return found


def forest_of(rows: Iterable, weights: Sequence[float], features: Sequence[str]) -> Forest:
    """A forest from rows (treeID, nodeData) as Spark saves them."""
    trees: dict[int, dict[int, Node]] = {}
    for tree, n in rows:
        split = n["split"]
        if n["leftChild"] != _NONE and split["numCategories"] != _NONE:
            raise ValueError("only continuous features are compiled")
        threshold = split["leftCategoriesOrThreshold"][0] if n["leftChild"] != _NONE else 0.0
        trees.setdefault(tree, {})[n["id"]] = Node(n["prediction"], n["leftChild"], n["rightChild"], split["featureIndex"], threshold)
    ordered = tuple(trees[k] for k in sorted(trees))
    if len(ordered) != len(weights):
        raise ValueError(f"{len(ordered)} trees but {len(weights)} weights")
    return Forest(tuple(features), ordered, tuple(float(w) for w in weights))


def read_forest(spark: SparkSession, stage_path: str, features: Sequence[str]) -> Forest:
    """A saved boosted model from its node table; as many rows as it has nodes."""
    nodes = [(r["treeID"], r["nodeData"]) for r in spark.read.parquet(f"{stage_path}/data").collect()]
    weights = spark.read.parquet(f"{stage_path}/treesMetadata").toDF("tree", "metadata", "weight")
    return forest_of(nodes, [r["weight"] for r in weights.orderBy("tree").collect()], features)


def read_linear(spark: SparkSession, stage_path: str, features: Sequence[str]) -> LinearForm:
    """A saved logistic regression of two classes from its coefficients."""
    row = spark.read.parquet(f"{stage_path}/data").first()
    if row["numClasses"] != 2 or row["isMultinomial"]:
        raise ValueError("only two classes are compiled")
    return LinearForm(tuple(features), tuple(row["coefficientMatrix"].toArray()[0].tolist()), float(row["interceptVector"][0]))


def _forest_in_memory(last, features: Sequence[str]) -> Forest:
    """The node table of a model that has not been saved, read node by node."""
    rows = []
    for tree, t in enumerate(last.trees):
        open_, n = [(t._java_obj.rootNode(), 0)], 1
        while open_:
            node, at = open_.pop()
            data = {"id": at, "prediction": node.prediction(), "leftChild": _NONE, "rightChild": _NONE}
            data["split"] = {"featureIndex": -1, "leftCategoriesOrThreshold": [], "numCategories": _NONE}
            if node.getClass().getSimpleName() == "InternalNode":
                if node.split().getClass().getSimpleName() != "ContinuousSplit":
                    raise ValueError("only continuous features are compiled")
                data |= {"leftChild": n, "rightChild": n + 1}
                data["split"] = {"featureIndex": node.split().featureIndex(), "leftCategoriesOrThreshold": [node.split().threshold()], "numCategories": _NONE}
                open_ += [(node.leftChild(), n), (node.rightChild(), n + 1)]
                n += 2
            rows.append((tree, data))
    return forest_of(rows, last.treeWeights, features)


def compiled(model: PipelineModel) -> LinearForm | Forest:
    """The last stage of a pipeline (assembler, classifier), fitted here or loaded."""
    assembler, last = model.stages[-2], model.stages[-1]
    features = assembler.getInputCols()
    if hasattr(last, "coefficients"):
        return LinearForm(tuple(features), tuple(float(c) for c in last.coefficients.toArray()), float(last.intercept))
    if hasattr(last, "treeWeights"):
        return _forest_in_memory(last, features)
    raise ValueError(f"cannot compile {type(last).__name__}")


def load_compiled(spark: SparkSession, path: str) -> LinearForm | Forest:
    """A saved pipeline (assembler, classifier) straight from its tables, without its objects."""
    uids = _metadata(spark, path)["paramMap"]["stageUids"]
    stages = [f"{path.rstrip('/')}/stages/{k}_{uid}" for k, uid in enumerate(uids)]
    features = _metadata(spark, stages[-2])["paramMap"]["inputCols"]
    kind = _metadata(spark, stages[-1])["class"].rpartition(".")[2]
    if kind == "LogisticRegressionModel":
        return read_linear(spark, stages[-1], features)
    if kind == "GBTClassificationModel":
        return read_forest(spark, stages[-1], features)
    raise ValueError(f"cannot compile {kind}")


def _metadata(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(f"{path.rstrip('/')}/metadata").first()["value"])


def score_with(df: DataFrame, form: LinearForm | Forest, keep: Sequence[str], out: str = "risk_score") -> DataFrame:
    """Probability of the positive class next to the kept columns; null if a feature is."""
    return df.select(*keep, form.probability().alias(out))


def attributed(df: DataFrame, form: LinearForm | Forest, keep: Sequence[str], means: Sequence[float] | None = None) -> DataFrame:
    """The kept columns with ``margin``, ``bias`` and ``contributions`` (feature, its part of the margin).

    The contributions and the bias add up to the margin. A linear form takes them from the ``means`` of
    its features, by default those of ``df``; a forest from its own nodes.
    """
    if isinstance(form, Forest):
        df = df.withColumn("__leaves", form.leaves())
        parts, bias = form.contributions("__leaves"), form.bias()
    else:
        if means is None:
            means = list(df.agg(F.array(*[F.avg(_double(f)) for f in form.features]).alias("m")).first()["m"])
        means = [0.0 if m is None else m for m in means]
        parts, bias = form.contributions(means), form.bias(means)
    entries = [F.struct(F.lit(f).alias("feature"), c.alias("contribution")) for f, c in parts.items()]
    return df.select(*keep, form.margin().alias("margin"), bias.alias("bias"), F.array(*entries).alias("contributions"))
