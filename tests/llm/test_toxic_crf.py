import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from weekcast.llm import toxic_crf as t
from weekcast.llm.common import held_out

from .conftest import sentence


def test_forward_backward_against_all_paths():
    rng = np.random.default_rng(0)
    crf = t.Crf({}, rng.normal(size=2), rng.normal(size=4))
    docs = [(6, [1, 2, 4], [[0], [0, 1], [1]]), (3, [], []), (4, [0, 3], [[1], [0]]), (1, [0], [[0]]), (0, [], [])]
    chains = t.Chains.of(docs)
    log_z, marginal = crf.infer(chains, chains.scores(crf.weights))
    enter, leave, stay, bias = crf.chain
    for i, (n, at, feats) in enumerate(docs):
        score = {p: crf.weights[f].sum() for p, f in zip(at, feats, strict=True)}
        total, toxic = 0.0, np.zeros(n)
        for path in itertools.product((0, 1), repeat=n):
            v = sum({(0, 0): 0.0, (0, 1): enter, (1, 0): leave, (1, 1): stay}[a, b] for a, b in zip((0, *path), path, strict=False))
            v += sum(bias + score.get(p, 0.0) for p, y in enumerate(path) if y)
            total, toxic = total + np.exp(v), toxic + np.exp(v) * np.array(path)
        assert log_z[i] == pytest.approx(np.log(total))
        assert marginal[i, :len(at)] == pytest.approx((toxic / total)[at])


def test_very_long_runs_stay_finite():
    crf = t.Crf({}, np.array([9.0]))
    chains = t.Chains.of([(5_000_000, [2_500_000], [[0]])])
    log_z, marginal = crf.infer(chains, chains.scores(crf.weights))
    assert np.isfinite(log_z).all() and marginal[0, 0] > 0.5


@pytest.fixture(scope="module")
def labelled(make_docs):
    rng = random.Random(1)
    bad = ["vilefool", "rottenly", "grimscum"]
    rows, labels = [], []
    for i in range(600):
        words, toxic = sentence(i, 40).split(), int(i % 5 == 0)
        if toxic:
            for _ in range(6):
                words[rng.randrange(40)] = rng.choice(bad) + rng.choice(["", "er", "ish", "x"])
        rows.append((i, " ".join(words)))
        labels.append((i, 1, toxic))
    return rows, labels


def test_held_out_accuracy_and_offsets(spark, make_docs, labelled):
    rows, labels = labelled
    docs = make_docs(rows)
    model = t.train(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = t.score_documents(docs, model).withColumn("out", held_out(F.col("doc_id"))).collect()
    tested = [r for r in got if r["out"]]
    assert 80 < len(tested) < 160
    assert sum((r["score"] >= 0.5) == (r["doc_id"] % 5 == 0) for r in tested) >= 0.97 * len(tested)
    texts = dict(rows)
    said = {texts[r["doc_id"]][s["start"]:s["end"]] for r in got for s in r["spans"]}
    assert said and all(w.startswith(("vilefool", "rottenly", "grimscum")) for w in said)


def test_labels_of_held_out_documents_are_not_learned(spark, make_docs, labelled):
    rows, labels = labelled
    docs = make_docs(rows)
    rest = {r[0] for r in docs.filter(held_out(docs["doc_id"])).select("doc_id").collect()}
    turned = [(i, q, 1 - x if i in rest else x) for i, q, x in labels]
    one, other = (t.train(docs, spark.createDataFrame(y, "doc_id long, quality int, toxic int")) for y in (labels, turned))
    assert one.features == other.features and np.allclose(one.weights, other.weights) and np.allclose(one.document, other.document)


def test_edges(spark, make_docs, edge_rows, labelled):
    schema = "doc_id long, quality int, toxic int"
    rows, labels = labelled
    model = t.train(make_docs(rows, clashing=True), spark.createDataFrame(labels, schema))
    got = t.score_documents(make_docs(edge_rows, clashing=True), model).collect()
    assert len(got) == len(edge_rows) and all(0 <= r["score"] < 0.5 and not r["spans"] for r in got)
    assert t.score_documents(make_docs([]), model).collect() == []
    for none in ([], [(1, 1, 0)], [(1, 1, 1)], [(1, None, None)]):
        some = t.train(make_docs(edge_rows), spark.createDataFrame(none, schema))
        assert t.score_documents(make_docs(edge_rows), some).count() == len(edge_rows)


def test_offsets_are_code_points(make_docs):
    crf = t.Crf({"fool": 0}, np.array([20.0]))
    (row,) = t.score_documents(make_docs([(1, "é😀 FOOL! x")]), crf).collect()
    assert [(s["start"], s["end"]) for s in row["spans"]] == [(3, 7)]


def test_ten_thousand_labels_are_read(spark, make_docs, monkeypatch):
    read, choose = [], t.sampled_labels

    def spy(*args):
        read.append(choose(*args))
        return read[-1]

    monkeypatch.setattr(t, "sampled_labels", spy)
    n = 13_000  # about 4/5 of them aren't held out
    t.train(make_docs([(i, "one two") for i in range(n)]), spark.createDataFrame([(i, 1, 0) for i in range(n)], "doc_id long, quality int, toxic int"))
    assert read[0].count() == 10_000
