"""Boosted trees with a log or logit link on Spark ML trees (L2, L3).

Each round fits one Spark ML ``DecisionTreeRegressor`` to the working response with working weights (a Newton step), on a
hashed share of the rows and a drawn share of the features.  The leaf values then come from one grouped aggregate of
gradients and curvatures, soft-thresholded (L1), shrunken (L2) and multiplied by the learning rate.  The raw score is a
column that is checkpointed every few rounds, so a round costs one tree and one pass, whatever came before.

The same pass that sums a round's leaves scores the rounds before it on the validation rows: the search ends ``patience`` rounds
after the best one, and the model is its first trees; nothing is fitted again.

A model is a node table (tree, node, feature, cut, left, right, value): it is saved as such, scored by array functions
inside the JVM, and any SQL engine can score it (``score_sql``).
"""

from __future__ import annotations

import json
import math
import random
import re
from dataclasses import dataclass, field

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weekcast.session import ensure_checkpoint_dir

#: Curvature of the Poisson objective is taken this much higher on the log scale, which bounds a step.
POISSON_STEP = 0.7


@dataclass(frozen=True)
class Objective:
    """Per row and raw score: gradient (down), curvature, loss for the early stop, and the mean a score stands for."""
    name: str

    def mean(self, raw: Column) -> Column:
        return {"poisson": F.exp(raw), "logistic": 1 / (1 + F.exp(-raw)), "squared": raw}[self.name]

    def gradient(self, y: Column, raw: Column) -> Column:
        return y - self.mean(raw)

    def curvature(self, raw: Column) -> Column:
        if self.name == "poisson":
            return F.exp(raw + POISSON_STEP)
        if self.name == "logistic":
            p = self.mean(raw)
            return F.greatest(p * (1 - p), F.lit(1e-9))
        return F.lit(1.0)

    def loss(self, y: Column, raw: Column) -> Column:
        """What is reported of training rows: half the deviance but for terms of y alone."""
        if self.name == "poisson":
            return F.exp(raw) - y * raw
        if self.name == "logistic":
            return F.log1p(F.exp(-F.abs(raw))) + F.greatest(raw, F.lit(0.0)) - y * raw
        return (y - raw) * (y - raw)

    def metric(self, y: Column, raw: Column) -> Column:
        """What stops the search: absolute error, or the loss of a classifier."""
        return self.loss(y, raw) if self.name == "logistic" else F.abs(y - self.mean(raw))

    def start(self, mean: float) -> float:
        if self.name == "poisson":
            return math.log(max(mean, 1e-9))
        if self.name == "logistic":
            p = min(max(mean, 1e-9), 1 - 1e-9)
            return math.log(p / (1 - p))
        return mean


OBJECTIVES = {name: Objective(name) for name in ("poisson", "logistic", "squared")}


def leaf_value(gradient: float, curvature: float, reg_lambda: float, reg_alpha: float) -> float:
    """The step of one leaf: soft-thresholded gradient over shrunken curvature."""
    most = max(abs(gradient) - reg_alpha, 0.0)
    return math.copysign(most, gradient) / (curvature + reg_lambda) if most else 0.0


def tree_nodes(debug_string: str, features: list[str]) -> list[dict]:
    """The nodes of a fitted Spark ML tree, root first: feature, cut, left, right (numbers of nodes), or none of these at a leaf."""
    lines = [x for x in (line.strip() for line in debug_string.splitlines()[1:]) if x]
    nodes: list[dict] = []

    def read(at: int) -> tuple[int, int]:
        here = len(nodes)
        nodes.append({"feature": None, "cut": None, "left": None, "right": None, "value": 0.0})
        split = re.fullmatch(r"If \(feature (\d+) <= (\S+)\)", lines[at])
        if split is None:
            return here, at + 1
        left, at = read(at + 1)
        right, at = read(at + 1)  # behind its "Else"
        nodes[here].update(feature=features[int(split[1])], cut=float(split[2]), left=left, right=right)
        return here, at

    read(0)
    return nodes


def _known(feature: str) -> Column:
    """A feature; 0 where it is null or no number."""
    return F.coalesce(F.nanvl(F.col(feature).cast("double"), F.lit(0.0)), F.lit(0.0))


def _leaf_sql(nodes: list[dict], at: int = 0) -> str:
    node = nodes[at]
    if node["feature"] is None:
        return str(at)
    return (f"CASE WHEN `{node['feature']}` <= double('{node['cut']!r}') THEN {_leaf_sql(nodes, node['left'])} "
            f"ELSE {_leaf_sql(nodes, node['right'])} END")


def leaf_column(nodes: list[dict]) -> Column:
    """The leaf of a row, from its feature columns."""
    return F.expr(_leaf_sql(nodes))


def _value_column(nodes: list[dict]) -> Column:
    values = ", ".join(f"double('{float(n['value'])!r}')" for n in nodes)
    return F.expr(f"element_at(array({values}), _leaf + 1)")


@dataclass
class BoostedTrees:
    """A fitted model: where the raw score starts, and the trees that add to it."""
    objective: str
    features: list[str]
    start: float
    trees: list[list[dict]]
    history: list[dict] = field(default_factory=list)

    def raw(self) -> Column:
        """The raw score from a row's features: each tree is walked in as many steps as it is deep."""
        if not self.trees:
            return F.lit(float(self.start))
        place = {f: i for i, f in enumerate(self.features)}
        x = F.array(*[_known(f) for f in self.features])
        trees = [{"feature": [place.get(n["feature"], 0) for n in nodes], "cut": [n["cut"] or 0.0 for n in nodes],
                  "left": [i if n["left"] is None else n["left"] for i, n in enumerate(nodes)],
                  "right": [i if n["right"] is None else n["right"] for i, n in enumerate(nodes)],
                  "value": [float(n["value"]) for n in nodes]} for nodes in self.trees]
        # one constant of the plan, whatever the number of trees
        table = F.from_json(F.lit(json.dumps(trees)), "array<struct<feature:array<int>,cut:array<double>,left:array<int>,right:array<int>,value:array<double>>>")
        steps = F.sequence(F.lit(1), F.lit(max(map(depth, self.trees)))) if any(len(t) > 1 for t in self.trees) else F.array().cast("array<int>")

        def walked(t):
            return F.aggregate(steps, F.lit(0), lambda at, _: F.when(
                F.get(x, F.get(t["feature"], at)) <= F.get(t["cut"], at), F.get(t["left"], at)).otherwise(F.get(t["right"], at)))
        return F.aggregate(table, F.lit(float(self.start)), lambda total, t: total + F.get(t["value"], walked(t)))

    def mean(self) -> Column:
        return OBJECTIVES[self.objective].mean(self.raw())

    def node_table(self, spark: SparkSession) -> DataFrame:
        rows = [(k, i, n["feature"], n["cut"], n["left"], n["right"], float(n["value"])) for k, nodes in enumerate(self.trees) for i, n in enumerate(nodes)]
        return spark.createDataFrame(rows, "tree int, node int, feature string, cut double, left int, right int, value double")

    def save(self, path: str, spark: SparkSession) -> None:
        said = json.dumps({"objective": self.objective, "features": self.features, "start": self.start, "history": self.history})
        self.node_table(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        spark.createDataFrame([(said,)], "settings string").coalesce(1).write.mode("overwrite").parquet(f"{path}/settings")

    @staticmethod
    def load(path: str, spark: SparkSession) -> BoostedTrees:
        said = json.loads(spark.read.parquet(f"{path}/settings").first()["settings"])
        trees: list[list[dict]] = []
        for r in spark.read.parquet(f"{path}/nodes").orderBy("tree", "node").collect():  # the model, not data
            if r["node"] == 0:
                trees.append([])
            trees[-1].append({c: r[c] for c in ("feature", "cut", "left", "right", "value")})
        return BoostedTrees(said["objective"], said["features"], said["start"], trees, said["history"])


def depth(nodes: list[dict], at: int = 0) -> int:
    node = nodes[at]
    return 0 if node["feature"] is None else 1 + max(depth(nodes, node["left"]), depth(nodes, node["right"]))


def score_sql(rows: str, keys: list[str], features: list[str], nodes: str, start: float, deepest: int) -> str:
    """SQL (Spark's and DuckDB's) that walks a node table for the rows of a table: the keys and the raw score.  Features have to be numbers."""
    key = ", ".join(keys)
    pick = "CASE n.feature " + " ".join(f"WHEN '{f}' THEN r.{f}" for f in features) + " END"
    walk = f"SELECT {key}, {', '.join(f'r.{f}' for f in features)}, n.tree, n.node FROM {rows} r CROSS JOIN (SELECT tree, node FROM {nodes} WHERE node = 0) n"
    for _ in range(deepest):
        walk = (f"SELECT {', '.join(f'r.{c}' for c in [*keys, *features])}, r.tree, CASE WHEN n.feature IS NULL THEN n.node WHEN {pick} <= n.cut "
                f"THEN n.left ELSE n.right END AS node FROM ({walk}) r JOIN {nodes} n ON n.tree = r.tree AND n.node = r.node")
    return f"SELECT {key}, {start!r} + sum(n.value) AS raw FROM ({walk}) r JOIN {nodes} n ON n.tree = r.tree AND n.node = r.node GROUP BY {key}"


def boost(rows: DataFrame, features: list[str], objective: str = "poisson", label: str = "label", weight: str = "weight",
          valid: str = "is_valid", learning_rate: float = 0.03, max_rounds: int = 5000, patience: int | None = 200, max_depth: int = 6,
          min_instances: int = 40, subsample: float = 0.8, feature_share: float = 0.8, reg_lambda: float = 5.0, reg_alpha: float = 0.5,
          seed: int = 42, checkpoint_every: int = 5, max_bins: int = 32) -> BoostedTrees:
    """Fit on the rows where ``valid`` is false; those where it is true decide how many rounds are kept.

    ``patience`` rounds without a better validation metric end the search (None: never); without validation rows all
    ``max_rounds`` are kept.  ``history`` of the model has, per round, the mean training loss and the validation metric after
    it (round 0: before any tree)."""
    goal = OBJECTIVES[objective]
    ensure_checkpoint_dir(rows.sparkSession)
    columns = [_known(c).alias(c) for c in features]
    named = [F.col(label).cast("double").alias("_y"), F.col(weight).cast("double").alias("_w"), F.coalesce(F.col(valid), F.lit(False)).alias("_valid")]
    if objective == "poisson":
        named[0] = F.greatest(F.col(label).cast("double"), F.lit(0.0)).alias("_y")
    data = rows.select(*columns, *named).filter("_y is not null and _w > 0").withColumn("_row", F.monotonically_increasing_id()).checkpoint()
    first = data.agg(F.sum(F.when(~F.col("_valid"), F.col("_w") * F.col("_y"))).alias("y"), F.sum(F.when(~F.col("_valid"), F.col("_w"))).alias("w"),
                     F.count_if("_valid").alias("valid")).first()
    if not first["w"]:
        raise ValueError("no training rows")
    start, draw = goal.start(first["y"] / first["w"]), random.Random(seed)
    scored = data.withColumn("_raw", F.lit(float(start)))
    y, w, raw, held = F.col("_y"), F.col("_w"), F.col("_raw"), F.col("_valid")
    losses = [F.sum(F.when(~held, w * goal.loss(y, raw))).alias("_loss"), F.sum(F.when(~held, w)).alias("_weight"),
              F.sum(F.when(held, goal.metric(y, raw))).alias("_metric"), F.count_if(held).alias("_held")]
    trees, history, best = [], [], 0

    def judge(sums) -> bool:
        """Note what the rounds so far score; True if the search is over."""
        nonlocal best
        total = {c: sum(r[c] or 0 for r in sums) for c in ("_loss", "_weight", "_metric", "_held")}
        history.append({"loss": total["_loss"] / total["_weight"], "metric": total["_metric"] / total["_held"] if total["_held"] else None})
        if history[-1]["metric"] is None:
            best = len(history) - 1
        elif history[-1]["metric"] < history[best]["metric"]:
            best = len(history) - 1
        return patience is not None and len(history) - 1 - best >= patience

    while True:
        chosen = sorted(draw.sample(range(len(features)), max(1, math.ceil(feature_share * len(features)))))
        picked = [features[i] for i in chosen]
        part = F.pmod(F.xxhash64("_row", F.lit(seed), F.lit(len(trees))), F.lit(1_000_000)) < int(subsample * 1_000_000)
        bend = w * goal.curvature(raw)
        sample = scored.filter(~held & part).select(*picked, (w * goal.gradient(y, raw) / bend).alias("_z"), bend.alias("_h"))
        sample = VectorAssembler(inputCols=picked, outputCol="_x", handleInvalid="keep").transform(sample).select("_x", "_z", "_h")
        fitted = DecisionTreeRegressor(featuresCol="_x", labelCol="_z", weightCol="_h", maxDepth=max_depth, minInstancesPerNode=min_instances,
                                       maxBins=max_bins, seed=seed + len(trees)).fit(sample)
        nodes = tree_nodes(fitted.toDebugString, picked)
        leaves = scored.withColumn("_leaf", leaf_column(nodes))
        # the leaves' sums and, for what was scored so far, the losses: one pass
        used = ~held & part
        sums = leaves.groupBy("_leaf").agg(F.sum(F.when(used, w * goal.gradient(y, raw))).alias("_g"), F.sum(F.when(used, bend)).alias("_b"), *losses).collect()
        if judge(sums) or len(trees) == max_rounds:
            break
        for r in sums:
            nodes[r["_leaf"]]["value"] = learning_rate * leaf_value(r["_g"] or 0.0, r["_b"] or 0.0, reg_lambda, reg_alpha)
        trees.append(nodes)
        scored = leaves.withColumn("_raw", raw + _value_column(nodes)).drop("_leaf")
        if len(trees) % checkpoint_every == 0:
            scored = scored.checkpoint()
    return BoostedTrees(objective, list(features), float(start), trees[:best], history)
