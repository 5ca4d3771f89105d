import numpy as np
import pytest
from pyspark.sql import functions as F

from weekcast.llm import quality_bayes as q
from weekcast.llm.common import held_out

from .conftest import sentence

SCHEMA = "doc_id long, quality int, toxic int"


def text_of(i, good):
    words = sentence(i, 70).split()
    return " ".join(words) if good else " ".join(w + "%%%" for w in words) if i % 2 else " ".join(words).upper()


@pytest.fixture(scope="module")
def corpus(spark, make_docs):
    rows, labels = [], []
    for i in range(900):
        host = ("good.example", "mixed.example", "bad.example")[i % 3]
        good = (i // 3) % 20 < {"good.example": 19, "mixed.example": 10, "bad.example": 2}[host]
        rows.append((i, text_of(i, good), host, ("en", "de")[i // 3 % 2]))
        labels.append((i, int(good), 0))
    rows.append((5000, sentence(77, 70), "sparse.example", "en"))
    return rows, make_docs(rows), spark.createDataFrame(labels, SCHEMA), {i: g for i, g, _ in labels}


def test_held_out_accuracy(corpus):
    _, docs, labels, truth = corpus
    got = q.judge(docs, labels).withColumn("out", held_out(F.col("doc_id"))).collect()
    tested = [r for r in got if r["out"] and r["doc_id"] in truth]
    assert sum(r["kept"] == bool(truth[r["doc_id"]]) for r in tested) >= 0.98 * len(tested) > 0


def test_shrinkage(corpus):
    _, docs, labels, _ = corpus
    prior = {}
    for r in q.judge(docs, labels).join(docs.select("doc_id", "source", "lang"), "doc_id").collect():
        prior.setdefault(r["source"], []).append(r["site_prior"])
    mean = {s: np.mean(p) for s, p in prior.items()}
    assert mean["bad.example"] < mean["mixed.example"] < mean["good.example"]
    # one document says nothing about its own site: the site's prior is the whole's, which lies between the others
    assert mean["bad.example"] < mean["sparse.example"] < mean["good.example"]


def test_priors_against_a_plain_version(corpus):
    """The grouped sums and the method of moments, by loops."""
    rows, docs, labels, _ = corpus
    weights, share = q.train(docs, labels)
    got = {r["doc_id"]: r for r in q.judge(docs, labels).collect()}
    shift = np.log(share / (1 - share))
    good = {i: round(q.MILLION / (1 + np.exp(-(got[i]["evidence"] + shift)))) for i, *_ in rows}
    hosts, paths = {}, {}
    for i, _, h, p in rows:
        hosts.setdefault(h, []).append(good[i])
        paths.setdefault((h, p), []).append(good[i])
    mean = sum(good.values()) / q.MILLION / len(good)

    def worth(sites):  # (n, share, mean above)
        sites = [s for s in sites if s[0] > 1]
        n = sum(s[0] for s in sites)
        chance = sum(m * (1 - m) for _, _, m in sites)
        spread = (sum(k * (x - m) ** 2 for k, x, m in sites) - chance) / n
        return min(10_000, max(1, sum(k * m * (1 - m) for k, _, m in sites) / n / spread - 1)) if spread > 0 else 10_000
    a = worth([(len(v), sum(v) / len(v) / q.MILLION, mean) for v in hosts.values()])
    host = {h: (a * mean + sum(v) / q.MILLION) / (a + len(v)) for h, v in hosts.items()}
    b = worth([(len(v), sum(v) / len(v) / q.MILLION, host[h]) for (h, _), v in paths.items()])
    for i, _, h, p in rows:
        want = (b * host[h] + (sum(paths[h, p]) - good[i]) / q.MILLION) / (b + len(paths[h, p]) - 1)
        assert got[i]["site_prior"] == pytest.approx(min(0.999, max(0.001, want)), abs=1e-4)
        assert got[i]["score"] == pytest.approx(1 / (1 + np.exp(-(np.log(got[i]["site_prior"] / (1 - got[i]["site_prior"])) + got[i]["evidence"]))))


def test_reruns_agree(corpus):
    _, docs, labels, _ = corpus
    one, other = ({(r["doc_id"], r["score"]) for r in q.judge(docs.repartition(n), labels).collect()} for n in (2, 7))
    assert one == other


def test_edges(spark, make_docs, edge_rows, corpus):
    _, _, labels, _ = corpus
    docs = make_docs(edge_rows, clashing=True)
    assert q.judge(docs, labels).count() == len(edge_rows)
    for none in ([], [(4, 1, 0)], [(4, 0, 0)], [(4, None, None)]):
        assert all(r["kept"] for r in q.judge(docs, spark.createDataFrame(none, SCHEMA)).collect())
    assert q.judge(make_docs([]), labels).collect() == []
    left = q.good_documents(docs, spark.createDataFrame([], SCHEMA))
    assert left.columns == docs.columns and left.count() == len(edge_rows)


def test_removed_rows_are_those_rejected(corpus):
    _, docs, labels, _ = corpus
    kept = {r["doc_id"] for r in q.judge(docs, labels).collect() if r["kept"]}
    assert {r["doc_id"] for r in q.good_documents(docs, labels).collect()} == kept
