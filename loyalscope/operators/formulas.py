"""Fitted models as formulas: the same probability as a column, as SQL text, and as a plain function of one row."""

from __future__ import annotations

import json
import math
from collections import defaultdict
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, LogisticRegressionModel, RandomForestClassificationModel
from pyspark.ml.feature import StandardScalerModel, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from loyalscope.functions import quoted
from loyalscope.session import scratch_path

#: A tree is a value, or (feature number, threshold, tree up to the threshold, tree above it).
Tree = float | list


@dataclass(frozen=True)
class Formula:
    """intercept + sum(coefficient * (x - centre) * scale) + sum(weight * tree), and the logistic function of ``slope``
    times that unless slope is None."""

    features: list[str]
    intercept: float = 0.0
    linear: list[list[float]] = field(default_factory=list)  # coefficient, centre and scale of each feature
    trees: list[list] = field(default_factory=list)  # weight, tree
    slope: float | None = None

    def sql(self, quote: str = '"') -> str:
        """The probability as SQL text over the feature columns, which are doubles; null in one that is needed gives null."""
        names = [quote + name.replace(quote, quote * 2) + quote for name in self.features]
        terms = [_number(self.intercept)] if self.intercept or not (self.linear or self.trees) else []
        terms += [f"{_number(c)} * (({name} - {_number(centre)}) * {_number(scale)})" for name, (c, centre, scale) in zip(names, self.linear)]
        terms += [f"{_number(weight)} * {_branches(tree, names)}" for weight, tree in self.trees]
        total = _sum(terms)
        return total if self.slope is None else f"1e0 / (1e0 + exp({_number(-self.slope)} * {total}))"

    def column(self) -> Column:
        return F.expr(self.sql("`"))

    def value(self, row: Mapping[str, float]) -> float:
        """The probability of one row, without Spark."""
        x = [float(row[name]) for name in self.features]
        total = self.intercept + sum(c * ((v - centre) * scale) for v, (c, centre, scale) in zip(x, self.linear))
        total += sum(weight * _follow(tree, x) for weight, tree in self.trees)
        if self.slope is None:
            return total
        z = self.slope * total
        return 1 / (1 + math.exp(-z)) if z > -700 else 0.0

    def splits(self) -> int:
        return sum(_size(tree) for _, tree in self.trees)

    def dumps(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def loads(text: str) -> Formula:
        return Formula(**json.loads(text))


def _number(x: float) -> str:
    """A double literal that both engines read back exactly."""
    return f"({x:.17e})" if x < 0 else f"{x:.17e}"


def _sum(terms: list[str]) -> str:
    """Terms added in pairs, so that the expression is no deeper than the logarithm of their number."""
    if len(terms) == 1:
        return terms[0]
    half = len(terms) // 2
    return f"({_sum(terms[:half])} + {_sum(terms[half:])})"


def _branches(tree: Tree, names: Sequence[str]) -> str:
    if not isinstance(tree, (list, tuple)):
        return _number(tree)
    feature, threshold, low, high = tree
    return f"CASE WHEN {names[feature]} <= {_number(threshold)} THEN {_branches(low, names)} ELSE {_branches(high, names)} END"


def _follow(tree: Tree, x: Sequence[float]) -> float:
    while isinstance(tree, (list, tuple)):
        feature, threshold, low, high = tree
        tree = low if x[feature] <= threshold else high
    return tree


def _size(tree: Tree) -> int:
    return 1 + _size(tree[2]) + _size(tree[3]) if isinstance(tree, (list, tuple)) else 0


def formula(model: PipelineModel, spark: SparkSession) -> Formula:
    """The formula of a fitted random forest, boosted trees or logistic regression behind an assembler (and a scaler).

    Trees are read from the model's stored form, once; what comes to the driver is the model, whose size the learner's
    settings bound.
    """
    features = next(s for s in model.stages if isinstance(s, VectorAssembler)).getInputCols()
    last = model.stages[-1]
    if isinstance(last, LogisticRegressionModel):
        scaler = next((s for s in model.stages if isinstance(s, StandardScalerModel)), None)
        coefficients = last.coefficients.toArray().tolist()
        centres = scaler.mean.toArray().tolist() if scaler is not None and scaler.getWithMean() else [0.0] * len(features)
        scales = [1 / s if s else 0.0 for s in scaler.std.toArray().tolist()] if scaler is not None and scaler.getWithStd() else [1.0] * len(features)
        return Formula(features, float(last.intercept), [list(x) for x in zip(coefficients, centres, scales)], slope=1.0)
    if isinstance(last, RandomForestClassificationModel):
        if last.numClasses != 2:
            raise ValueError("two classes only")
        trees = _stored_trees(last, spark, lambda node: node["impurityStats"][1] / (sum(node["impurityStats"]) or 1.0))
        return Formula(features, trees=[[1 / len(trees), tree] for tree in trees])
    if isinstance(last, GBTClassificationModel):
        trees = _stored_trees(last, spark, lambda node: node["prediction"])
        return Formula(features, trees=[list(x) for x in zip(map(float, last.treeWeights), trees)], slope=2.0)
    raise ValueError(f"no formula for {type(last).__name__}")


def _stored_trees(model, spark: SparkSession, leaf) -> list[Tree]:
    path = scratch_path(spark, "trees")
    model.save(path)
    nodes: dict[int, dict] = defaultdict(dict)
    for row in spark.read.parquet(f"{path}/data").collect():
        nodes[row["treeID"]][row["nodeData"]["id"]] = row["nodeData"]
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)

    def grown(tree: dict, at: int) -> Tree:
        node = tree[at]
        if node["leftChild"] < 0:
            return float(leaf(node))
        if node["split"]["numCategories"] >= 0:
            raise ValueError("splits of continuous features only")
        return [node["split"]["featureIndex"], float(node["split"]["leftCategoriesOrThreshold"][0]),
                grown(tree, node["leftChild"]), grown(tree, node["rightChild"])]

    return [grown(nodes[i], 0) for i in sorted(nodes)]


# Optimality of a logistic regression -------------------------------------------------------------


def gradient(rows: DataFrame, line: Formula, penalty: float, label: str = "label", weight: str | None = None) -> DataFrame:
    """(component, gradient) of the weighted mean log loss plus penalty / 2 times the squared coefficients.

    The components are the features, whose coefficients belong to the scaled values, and ``(intercept)``, which bears no
    penalty. At a fitted regression all are 0 but for what the solver left. One aggregate, one row until the end. Rows with
    a null among features, label or weight are left out; without rows the gradients are null.
    """
    scaled = [(F.col(quoted(name)).cast("double") - centre) * scale for name, (_, centre, scale) in zip(line.features, line.linear)]
    w = F.col(quoted(weight)).cast("double") if weight else F.lit(1.0)
    known = rows.select(*[x.alias(f"x{i}") for i, x in enumerate(scaled)], w.alias("w"),
                        (line.column() - F.col(quoted(label)).cast("double")).alias("error")).na.drop()
    total = F.sum("w")
    parts = [(F.sum(F.col("w") * F.col("error") * F.col(f"x{i}")) / total + penalty * c).alias(f"g{i}") for i, (c, _, _) in enumerate(line.linear)]
    sums = known.agg(*parts, (F.sum(F.col("w") * F.col("error")) / total).alias("g"))
    each = [F.struct(F.lit(name).alias("component"), F.col(f"g{i}").alias("gradient")) for i, name in enumerate(line.features)]
    return sums.select(F.inline(F.array(*each, F.struct(F.lit("(intercept)").alias("component"), F.col("g").alias("gradient")))))


def gradient_sql(source: str, line: Formula, penalty: float, label: str = "label", weight: str = "1e0") -> str:
    """``gradient`` as SQL text over a table or subquery; ``weight`` is an expression."""
    names = ['"' + name.replace('"', '""') + '"' for name in line.features]
    scaled = [f"(({name} - {_number(centre)}) * {_number(scale)})" for name, (_, centre, scale) in zip(names, line.linear)]
    inner = ", ".join(f"{x} AS x{i}" for i, x in enumerate(scaled))
    parts = [f"SELECT '{name}' AS component, sum(w * error * x{i}) / sum(w) + {_number(penalty)} * {_number(c)} AS gradient FROM given"
             for i, (name, (c, _, _)) in enumerate(zip([n.replace("'", "''") for n in line.features], line.linear))]
    parts.append("SELECT '(intercept)', sum(w * error) / sum(w) FROM given")
    return f"WITH given AS (SELECT {inner}, {weight} AS w, {line.sql()} - {label} AS error FROM {source}) " + " UNION ALL ".join(parts)
