from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from weekcast.llm import mixing as m

from .conftest import sentence


def mix(docs, **options):
    sized = m.with_size(docs)
    return m.allocate(sized, m.source_targets(sized), **options).collect()


def brute_targets(sizes: dict, weights=(3, 1, 2), ratio=1.5, copies=2):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    open_, target, left = set(order), {}, ratio * sum(sizes.values())
    while True:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total > copies * sizes[s]]
        if not over:
            return target | {s: left * weight[s] / total for s in open_}
        for s in over:
            open_.discard(s)
            target[s] = copies * sizes[s]
            left -= target[s]
        if not open_:
            return target


@pytest.fixture(scope="module")
def many(make_docs):
    rows = [(i, sentence(i, 5 + i * 37 % 60), ("a", "b", "b", "b", "c", "d", None)[i % 7]) for i in range(1400)]
    return make_docs(rows)


@pytest.mark.parametrize("bin_rows", [3, 1000])
def test_targets_are_met(many, bin_rows):
    rows = mix(many, bin_rows=bin_rows)
    sizes, taken, target, largest = Counter(), Counter(), {}, defaultdict(int)
    for r in rows:
        sizes[r["source"]] += r["_size"]
        taken[r["source"]] += r["copies"] * r["_size"]
        largest[r["source"]] = max(largest[r["source"]], r["_size"])
        target[r["source"]] = r["target"]
        assert 0 <= r["copies"] <= 2 and r["source_size"] is not None
    want = brute_targets(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(want[s])
        assert abs(taken[s] - target[s]) <= largest[s]


def test_bins_and_reruns_agree(many):
    one, other = ({r["doc_id"]: r["copies"] for r in mix(many, bin_rows=n)} for n in (7, 500))
    assert one == other


def test_weights_make_unequal_probabilities(spark, many):
    docs = many.withColumn("w", F.when(F.col("doc_id") % 2 == 0, 1.5).otherwise(0.5))
    sized = m.with_size(docs)
    rows = m.allocate(sized, m.source_targets(sized), weight_col="w").collect()
    even = [r["copies"] for r in rows if r["doc_id"] % 2 == 0 and r["source"] == "b"]
    odd = [r["copies"] for r in rows if r["doc_id"] % 2 and r["source"] == "b"]
    assert sum(even) / len(even) > 1.5 * sum(odd) / len(odd)


def test_edges(make_docs, edge_rows):
    docs = make_docs(edge_rows, clashing=True)
    assert len(mix(docs)) == len(edge_rows)
    mixed = m.mixed_documents(docs)
    assert mixed.columns == docs.columns and all(r["copies"] == r["_size"] == r["_u"] == "x" for r in mixed.collect())
    assert mix(make_docs([])) == [] and m.mixed_documents(make_docs([])).collect() == []
    assert all(r["copies"] * r["_size"] == 0 for r in mix(make_docs([(1, None), (2, "")])))


@pytest.mark.parametrize("p", [0.001, 0.5, 0.999])
def test_bins_are_even_whatever_p_is(spark, p):
    u = m.uniform(1, F.col("id"))
    q = lambda p: (F.col("_u") / (1 - F.col("_u"))) / (p / (1 - p))
    rows = spark.range(20_000).select("id", F.lit("a").alias("source"), u.alias("_u"), F.lit(20_000).cast("long").alias("n_docs"))
    varied = F.when(F.col("id") % 3 == 0, F.lit(p)).otherwise(F.lit(p / 2))
    for one_p, at in ((True, F.lit(p)), (False, varied)):
        found = m.with_bins(rows.withColumn("_q", q(at)), "source", one_p, 200).groupBy("_bin").agg(
            F.count(F.lit(1)).alias("n"), F.min("_q").alias("low"), F.max("_q").alias("high")).orderBy("_bin").collect()
        assert max(r["n"] for r in found) < 320 and sum(r["n"] for r in found) == 20_000
        assert all(a["high"] <= b["low"] for a, b in zip(found, found[1:], strict=False))


def test_one_bin_a_source_is_ordered(many):
    sized = m.with_size(m.packed(many, _doc="doc_id", _source="source", _text="text"), "_doc", "_text").drop("_text")
    targets = m.source_targets(sized, "_source")
    small, one = ({r["_doc"]: r["copies"] for r in m.allocate(sized, targets, "_doc", "_source", bin_rows=n).collect()} for n in (5, 10**6))
    assert small == one and len(one) == 1400


def test_bins_agree_with_weights(many):
    docs = many.withColumn("w", F.col("doc_id") % 7 / 4 + 0.1)
    sized = m.with_size(docs)
    one, other = ({r["doc_id"]: r["copies"] for r in m.allocate(sized, m.source_targets(sized), weight_col="w", bin_rows=n).collect()} for n in (7, 10**6))
    assert one == other


@pytest.mark.parametrize("weights", [(4.0, 1.0, 0.25), (9.0, 8.0, 7.0), (2.0, 2.0, 2.0)])
def test_weights_keep_the_targets(many, weights):
    docs = many.withColumn("w", F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("doc_id") % 3 + 1).cast("int")))
    sized = m.with_size(docs)
    taken, target, largest = Counter(), {}, defaultdict(int)
    for r in m.allocate(sized, m.source_targets(sized), weight_col="w").collect():
        taken[r["source"]] += r["copies"] * r["_size"]
        target[r["source"]] = r["target"]
        largest[r["source"]] = max(largest[r["source"]], r["_size"])
    assert len(target) == 5 and all(abs(taken[s] - target[s]) <= largest[s] for s in target)


def test_weights_without_words_or_worth(make_docs):
    docs = make_docs([(1, "a b c", "x"), (2, "d e f", "x"), (3, None, "y"), (4, "", None)]).withColumn("w", F.when(F.col("doc_id") < 3, 0.0))
    sized = m.with_size(docs)
    assert {r["doc_id"]: r["copies"] * r["_size"] for r in m.allocate(sized, m.source_targets(sized), weight_col="w").collect()} == {1: 0, 2: 0, 3: 0, 4: 0}
