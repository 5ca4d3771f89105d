import random
import re

import pytest

from weekcast.llm import decontaminate as d

from .conftest import sentence


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items, window=10):
    spans = {}
    for item, text in items:
        w = words(text)
        n = min(window, len(w))
        spans[item] = {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if n else set()
    out = {}
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for item, windows in spans.items():
            for n in {len(x) for x in windows}:
                for i in range(len(w) - n + 1):
                    if tuple(w[i:i + n]) in windows:
                        hit.update(range(i, i + n))
                        found.add(str(item))
        out[doc] = (len(w), len(hit), sorted(found))
    return out


def found(docs, items, **options):
    return {r["doc_id"]: (r["n_words"], r["n_hit"], list(r["items"])) for r in d.find_hits(docs, items, **options).collect()}


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(4)
    items = [(k, sentence(500 + k, 12 + 3 * k)) for k in range(9)] + [(20, "Short ITEM, here"), (21, "one"), (22, ""), (23, None), (24, "Été çà Σ ΑΣ ÉTÉ fin"), (25, sentence(500, 12))]
    docs = []
    for i in range(60):
        text = sentence(i, rng.randrange(1, 80)).split()
        if i % 3 == 0:
            w = (items[rng.randrange(9)][1]).split()
            a = rng.randrange(len(w) - 9)
            text[len(text) // 2:len(text) // 2] = w[a:a + rng.choice([8, 9, 10, 11, 30])]
        docs.append((i, " ".join(text)))
    docs += [(100, "a short, item HERE. short item here"), (101, "x Été,çà Σ ΑΣ ÉTÉ fin"), (102, "x été çà Σ ας ÉTÉ fin"), (103, None), (104, ""),
             (105, (items[3][1] + " ") * 4)]
    return docs, items


@pytest.mark.parametrize("k, broadcast_rows", [(5, 200_000), (5, 0), (10, 200_000), (1, 200_000)])
def test_against_brute_force(spark, make_docs, corpus, k, broadcast_rows):
    docs, items = corpus
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert found(make_docs(docs).repartition(3), bench, k=k, broadcast_rows=broadcast_rows) == brute(docs, items)


def test_edges(spark, make_docs, edge_rows):
    bench = spark.createDataFrame([(1, sentence(1, 30)), (1, sentence(1, 30)), (None, sentence(2, 20))], "item_id long, text string")
    docs = make_docs(edge_rows, clashing=True)
    rows = d.find_hits(docs, bench).collect()
    assert len(rows) == len(edge_rows) and sum(r["doc_id"] == 5 and r["n_hit"] == 30 for r in rows) == 2
    clean = d.clean_documents(docs, bench)
    assert clean.columns == docs.columns and {r["doc_id"] for r in clean.collect()} == {1, 2, 3, 7, 8, 9}  # 6 holds the first item too
    empty = bench.limit(0)
    assert all(r["n_hit"] == 0 for r in d.find_hits(docs, empty).collect())
    assert d.find_hits(make_docs([]), bench).collect() == []


def test_main_path_runs_no_python(make_docs, corpus, spark):
    docs, items = corpus
    plan = d.find_hits(make_docs(docs), spark.createDataFrame(items, "item_id long, text string"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_a_long_benchmark_item(spark, make_docs):
    import time
    item = " ".join(f"w{i}" for i in range(5000))
    bench = spark.createDataFrame([("a", item), ("b", "w17 w18 w19")], "item_id string, text string")
    docs = make_docs([(1, "x " + " ".join(f"w{i}" for i in range(100, 130)) + " y"), (2, "w1 w2 w3"), (3, "q w17 w18 w19 q")])
    start = time.time()
    got = {r["doc_id"]: (r["n_hit"], r["items"]) for r in d.find_hits(docs, bench).collect()}
    assert got == {1: (30, ["a"]), 2: (0, []), 3: (3, ["b"])} and time.time() - start < 60
