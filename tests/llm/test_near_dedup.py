import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from weekcast.llm import near_dedup as n

from .conftest import WORDS, sentence


def shingles(text, width):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    k = min(width, len(words))
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)} if k else set()


def brute(rows, width, num, den=100):
    """Component of each doc_id by all pairs."""
    sets = {i: shingles(t, width) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a, b in itertools.combinations(sorted(sets), 2):
        if sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def changed(text, k, rng):
    words = text.split()
    for _ in range(k):
        words[rng.randrange(len(words))] = rng.choice(WORDS) + "x"
    return " ".join(words)


@pytest.fixture(scope="module")
def family():
    rng = random.Random(5)
    rows, i = [], 0
    for base in range(12):
        text = sentence(base, 120)
        for _ in range(8):
            rows.append((i, text))
            i += 1
            text = changed(text, rng.choice([0, 1, 2, 8]), rng)
    return rows + [(1000 + k, sentence(100 + k, 3 + k)) for k in range(40)] + [(2000, None), (2001, ""), (2002, "One two"), (2003, "one  TWO"), (2004, "two one")]


@pytest.mark.parametrize("width, num, block", [(3, 85, 512), (3, 85, 1), (5, 80, 512), (5, 80, 3)])
def test_against_all_pairs(make_docs, family, width, num, block):
    found = n.near_duplicates(make_docs(family).repartition(5), width=width, threshold=(num, 100), block=block).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == brute(family, width, num)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


def test_word_hashes_agree_for_any_batch():
    texts = [b"a b  c", b"", b" x\ty ", b"b", "é ab ba".encode()]
    together, counts = n.word_hashes(texts)
    assert counts.tolist() == [3, 0, 2, 1, 3]
    alone = np.concatenate([n.word_hashes([t])[0] for t in texts])
    assert (together == alone).all() and len(set(together.tolist())) == 8  # b occurs twice


def test_min_and_max_estimate_similarity():
    a, b = n.permutations(400, 1)
    x = n.shingle_sets([sentence(1, 300)], 1)[0]
    rng = np.random.default_rng(0)
    pool = rng.integers(0, 1 << 64, 3000, dtype=np.uint64)
    one, two = np.sort(pool[:2000]), np.sort(pool[1000:])
    sig = n.min_max_signatures([one, two, x], a, b)
    assert abs((sig[0] == sig[1]).mean() - 1 / 3) < 0.06
    assert abs((sig[0, ::2] == sig[1, ::2]).mean() - (sig[0, 1::2] == sig[1, 1::2]).mean()) < 0.12


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(900, 901)], "_a long, _b long")
    assert {r["_v"]: r["_c"] for r in n.components(edges).collect()} == {**{i: 0 for i in range(201)}, 900: 900, 901: 900}
    assert n.components(edges.limit(0)).collect() == []


def test_edges(make_docs, edge_rows):
    docs = make_docs(edge_rows, clashing=True)
    rows = n.near_duplicates(docs).collect()
    assert len(rows) == len(edge_rows)
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[5]["component_id"] == 4 and by_id[4]["kept"] and by_id[1]["kept"] and by_id[1]["n_shingles"] == 0
    assert by_id[None]["component_id"] is None
    assert n.near_duplicates(make_docs([])).collect() == []
    assert n.near_duplicates(make_docs([(1, None), (2, "")])).count() == 2


def test_one_of_each(make_docs, family):
    rows = [*family, family[0], (3000, None)]
    left = n.one_of_each(make_docs(rows), width=3, threshold=(85, 100))
    want = {i for i, (_, c) in brute(rows, 3, 85).items() if c == i}
    assert sorted(r["doc_id"] for r in left.collect()) == sorted(want)
    assert left.columns == ["doc_id", "text", "source", "lang"]


def test_many_null_ids_meet_their_own_texts_only(spark, make_docs):
    base = sentence(3, 120).split()
    rows = [(None, " ".join(base[:i % 100] + [f"x{i}"] + base[i % 100 + 1:])) for i in range(200)] + [(1, " ".join(base))]
    docs = make_docs(rows)
    signed = n.signature_table(docs, "doc_id", "text", 5, 60, 4, 5)
    members = signed.select("_id", "_t", F.lit(1).alias("_g"), F.lit("").alias("_x"), F.lit("").alias("_y"), F.xxhash64("_k1", "_k2").alias("_v"), "_k1", "_k2") \
                    .withColumnRenamed("_id", "_rep")
    confirmed = n._confirmed(docs, members, "doc_id", "text", 5, (80, 100))
    plan = confirmed._jdf.queryExecution().optimizedPlan().toString()
    assert "_t" in plan and confirmed.count() == 200  # a spanning forest of 201 linked texts
    got = n.near_duplicates(docs).collect()
    assert len(got) == 201 and sum(r["kept"] for r in got) == 1 and {r["component_id"] for r in got} == {1}


@pytest.mark.parametrize("share", [85, 88])
def test_recall_just_above_the_threshold(spark, make_docs, share):
    """Pairs of texts whose sets agree to just above 0.85 or 0.88: all are found."""
    rows = []
    for i in range(300):
        words = [f"w{i}_{k}" for k in range(400)]
        other, k = list(words), 0
        while True:  # replace words, three shingles each, while the sets agree enough
            shared = 398 - 3 * (k + 1)
            if 100 * shared < share * (2 * 398 - shared):
                break
            other[5 + 10 * k] = f"y{i}_{k}"
            k += 1
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(other))]
    got = {r["doc_id"]: r["component_id"] for r in n.near_duplicates(make_docs(rows), width=3, threshold=(85, 100), rows=5).collect()}
    found = sum(got[2 * i + 1] == 2 * i for i in range(300))
    assert found == 300


def test_size_estimates_stay_small_over_rounds(spark, monkeypatch):
    """A long path takes several rounds; the planner's size estimates don't multiply from one to the next."""
    names = list(range(400))
    random.Random(3).shuffle(names)
    edges = spark.createDataFrame(list(itertools.pairwise(names)), "_a long, _b long")
    sizes, empty = [], type(edges).isEmpty

    def size(df):
        return df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()

    def noted(df):
        sizes.append(size(df))
        return empty(df)
    monkeypatch.setattr(type(edges), "isEmpty", noted)
    found = n.components(edges)
    assert len(sizes) > 2 and max([*sizes, size(found)]) < 10 ** 30
    assert {(r["_v"], r["_c"]) for r in found.collect()} == {(v, 0) for v in names}
