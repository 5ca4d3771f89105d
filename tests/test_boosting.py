"""Boosted trees: leaf values, falling loss, early stop, scores in two engines."""
import math

import duckdb
import pytest
from pyspark.sql import functions as F

from weekcast.operators import boosting as b
from weekcast.session import shared_dir


@pytest.fixture(scope="module")
def rows(spark):
    x = spark.range(3000).withColumn("a", F.pmod(F.xxhash64("id"), F.lit(100)) / 10.0).withColumn("c", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(7)).cast("double"))
    mean = F.exp(0.25 * F.col("a") - F.when(F.col("c") > 3, 1.5).otherwise(0.0))
    noise = F.pmod(F.xxhash64("id", F.lit(2)), F.lit(1000)) / 500.0
    return x.select("id", "a", "c", F.floor(mean * noise).cast("double").alias("label"), (1 + F.col("id") % 2).cast("double").alias("weight"),
                    (F.col("id") % 5 == 0).alias("is_valid")).checkpoint()


def test_leaf_value():
    assert b.leaf_value(10.0, 2.0, 0.0, 0.0) == 5.0 and b.leaf_value(10.0, 3.0, 5.0, 0.5) == 9.5 / 8
    assert b.leaf_value(-10.0, 3.0, 5.0, 0.5) == -9.5 / 8 and b.leaf_value(0.4, 3.0, 5.0, 0.5) == 0.0


def test_tree_nodes():
    text = """DecisionTreeRegressionModel: uid=x, depth=2, numNodes=5, numFeatures=2
  If (feature 0 <= 1.5)
   Predict: 0.1
  Else (feature 0 > 1.5)
   If (feature 1 <= 1.0E-4)
    Predict: 1.0
   Else (feature 1 > 1.0E-4)
    Predict: 2.0
"""
    nodes = b.tree_nodes(text, ["p", "q"])
    assert [(n["feature"], n["cut"], n["left"], n["right"]) for n in nodes] == [
        ("p", 1.5, 1, 2), (None,) * 4, ("q", 1e-4, 3, 4), (None,) * 4, (None,) * 4]
    assert b.depth(nodes) == 2 and b.tree_nodes("head\n  Predict: 3.0\n", ["p"])[0]["feature"] is None


@pytest.mark.parametrize("objective", ["poisson", "logistic", "squared"])
def test_loss_falls_every_round(rows, objective):
    data = rows.withColumn("label", (F.col("label") > 1).cast("double")) if objective == "logistic" else rows
    model = b.boost(data, ["a", "c"], objective, learning_rate=0.3, max_rounds=6, patience=None, max_depth=3, subsample=1.0)
    losses = [h["loss"] for h in model.history]
    assert len(model.history) == 7 and all(y < x for x, y in zip(losses, losses[1:], strict=False))


def test_first_round_equals_a_plain_aggregate(rows, spark, tmp_path):
    """Leaf values of one round, computed by DuckDB from the rows and the node table."""
    model = b.boost(rows, ["a", "c"], learning_rate=0.1, max_rounds=1, patience=None, max_depth=3, subsample=1.0, feature_share=1.0)
    rows.write.parquet(str(tmp_path / "rows"))
    model.node_table(spark).write.parquet(str(tmp_path / "nodes"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW r AS SELECT * FROM '{tmp_path}/rows/*.parquet'; CREATE VIEW n AS SELECT * FROM '{tmp_path}/nodes/*.parquet'")
    walk = "SELECT r.*, 0 AS node FROM r WHERE NOT is_valid"
    for _ in range(3):
        walk = f"""SELECT w.* EXCLUDE (node), CASE WHEN n.feature IS NULL THEN w.node WHEN CASE n.feature WHEN 'a' THEN a ELSE c END <= n.cut THEN n.left
            ELSE n.right END AS node FROM ({walk}) w JOIN n ON n.node = w.node"""
    start = con.execute("SELECT ln(sum(weight * label) / sum(weight)) FROM r WHERE NOT is_valid").fetchone()[0]
    want = con.execute(f"""SELECT node, 0.1 * sign(g) * greatest(abs(g) - 0.5, 0) / (h + 5) FROM (SELECT node, sum(weight * (label - exp({start!r}))) AS g,
        sum(weight * exp({start!r} + 0.7)) AS h FROM ({walk}) GROUP BY node)""").fetchall()
    assert math.isclose(start, model.start) and len(want) >= 4
    for node, value in want:
        assert math.isclose(model.trees[0][node]["value"], value, rel_tol=1e-9)


def test_search_ends_patience_rounds_after_its_best(rows):
    """Labels of the validation rows are unlike those trained on, so that the best round is an early one."""
    odd = rows.withColumn("label", F.when(F.col("is_valid"), F.lit(3.0)).otherwise(F.col("label")))
    model = b.boost(odd, ["a", "c"], learning_rate=0.5, max_rounds=40, patience=3, max_depth=3)
    metrics = [h["metric"] for h in model.history]
    best = metrics.index(min(metrics))
    assert len(model.trees) == best and len(metrics) == best + 3 + 1 < 41


def test_no_refit(rows, monkeypatch):
    fits = []
    real = b.DecisionTreeRegressor.fit
    monkeypatch.setattr(b.DecisionTreeRegressor, "fit", lambda self, data: fits.append(1) or real(self, data))
    model = b.boost(rows, ["a", "c"], learning_rate=0.3, max_rounds=4, patience=2, max_depth=2)
    assert len(fits) == len(model.history)


def test_scores_in_two_engines_and_after_reload(rows, spark, tmp_path):
    model = b.boost(rows, ["a", "c"], learning_rate=0.3, max_rounds=5, patience=None, max_depth=3)
    scored = rows.select("id", model.raw().alias("raw"), model.mean().alias("mean"))
    ours = {r["id"]: (r["raw"], r["mean"]) for r in scored.collect()}
    path = shared_dir(spark, "boosted-test")
    model.save(path, spark)
    back = b.BoostedTrees.load(path, spark)
    assert {r["id"]: r["raw"] for r in rows.select("id", back.raw().alias("raw")).collect()} == {i: x for i, (x, _) in ours.items()}
    sql = b.score_sql("rows", ["id"], ["a", "c"], "nodes", model.start, 3)
    rows.createOrReplaceTempView("rows")
    model.node_table(spark).createOrReplaceTempView("nodes")
    rows.write.parquet(str(tmp_path / "rows"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW rows AS SELECT * FROM '{tmp_path}/rows/*.parquet'; CREATE VIEW nodes AS SELECT * FROM '{path}/nodes/*.parquet'")
    for found in (spark.sql(sql).collect(), con.execute(sql).fetchall()):
        assert len(found) == 3000 and all(math.isclose(raw, ours[i][0], abs_tol=1e-9) for i, raw in found)
    assert all(math.isclose(m, math.exp(x), rel_tol=1e-12) for x, m in ours.values())


def test_edges(rows, spark):
    with pytest.raises(ValueError):
        b.boost(rows.filter("is_valid"), ["a"], max_rounds=1)
    alone = b.boost(rows.filter("not is_valid"), ["a"], max_rounds=2, max_depth=2)  # without validation rows every round stays
    assert len(alone.trees) == 2 and alone.history[-1]["metric"] is None
    none = b.BoostedTrees("poisson", ["a"], 0.5, [])
    assert rows.select(none.raw().alias("r")).first()["r"] == 0.5
    odd = rows.limit(300).withColumn("label", F.when(F.col("id") % 3 == 0, None).otherwise(F.col("label"))).withColumn("a", F.when(F.col("id") % 2 == 0, F.lit(float("nan"))).otherwise(F.col("a")))
    assert b.boost(odd, ["a", "c"], max_rounds=1, patience=None).start is not None
