import random
from collections import defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import types as T

from weekcast.llm import line_dedup as d


def brute(rows, min_docs, policy, min_chars=1):
    """doc_id, text -> kept text, by the definition."""
    def key(line):
        k = line.strip(" \t\n\x0b\x0c\r")
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in k)
    docs, first = defaultdict(set), {}
    for i, text in sorted(rows, key=lambda r: r[0]):
        for p, line in enumerate((text or "").split("\n")):
            docs[key(line)].add(i)
            first.setdefault(key(line), (i, p))
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        gone = [len(key(x)) >= min_chars and (len(docs[key(x)]) >= min_docs if policy == "frequent" else first[key(x)] != (i, p)) for p, x in enumerate(lines)]
        out.append((i, "\n".join(x for x, g in zip(lines, gone, strict=True) if not g)))
    return sorted(out, key=repr)


def kept(docs, **options):
    fields = [T.StructField("text", T.StringType())]
    rows = d.apply_bitmaps(docs, d.keep_bitmaps(docs, **options), lambda lines, left: (b"\n".join(left).decode(),), fields).collect()
    return sorted(((r["doc_id"], r["text"]) for r in rows), key=repr)


@pytest.mark.parametrize("policy", ["frequent", "first"])
@pytest.mark.parametrize("min_chars", [1, 3])
def test_against_brute_force(spark, make_docs, policy, min_chars):
    rng = random.Random(3)
    lines = ["Common Line", " common line\t", "", "  ", "é", "x", *[f"line {k}" for k in range(30)]]
    rows = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randrange(8)))) for i in range(120)] + [(900, None), (901, "")]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for batch in ("3", "10000"):  # runs go on over batches
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
            assert kept(make_docs(rows).repartition(6), min_docs=10, policy=policy, min_chars=min_chars) == brute(rows, 10, policy, min_chars)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_hot_line_over_partitions(spark, make_docs):
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [(i, f"own {i}\nhot") for i in range(200)] + [(500 + i, "rare") for i in range(9)]
        assert kept(make_docs(rows), min_docs=10) == brute(rows, 10, "frequent")
        assert kept(make_docs(rows), policy="first") == brute(rows, 10, "first")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_borders_stream_over_batches():
    rows = [(7, i // 2, 0) for i in range(9)] + [(8, 1, 0)] + [(9, i, 0) for i in range(4)]
    batches = [pa.RecordBatch.from_arrays([pa.array([h]), pa.array([i]), pa.array([p], pa.int32())], names=["_h", "_id", "_part"]) for h, i, p in rows]
    (out,) = d._borders(iter(batches))
    assert out.to_pydict() == {"part": [0, 0], "h": [7, 9], "n": [5, 4]}


def test_edges(make_docs, edge_rows):
    docs = make_docs(edge_rows, clashing=True)
    rows = kept(docs, min_docs=2)
    assert len(rows) == len(edge_rows)
    assert [x for i, x in rows if i == 4] == [""]  # its only line is in document 5 too
    assert [x for i, x in rows if i in (1, 2)] == ["", ""]
    assert kept(make_docs([])) == []
    with pytest.raises(ValueError):
        d.dropped_lines(d.line_table(docs, "doc_id", "text"), policy="none")


def test_one_id_over_partitions_is_one_document(spark, make_docs):
    options = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "40"}
    before = {k: spark.conf.get(k) for k in options}
    try:
        for k, v in options.items():
            spark.conf.set(k, v)
        for same in (7, None):
            rows = [(same, f"own {i}\nhot") for i in range(400)]
            assert kept(make_docs(rows), min_docs=10) == sorted(rows, key=repr)
            rows += [(500 + i, "hot") for i in range(9)]  # the tenth document
            assert kept(make_docs(rows), min_docs=10) == sorted([(i, x.removesuffix("hot").removesuffix("\n")) for i, x in rows], key=repr)
            assert kept(make_docs(rows), min_docs=11) == sorted(rows, key=repr)
            (first,) = [x for _, x in kept(make_docs(rows), policy="first") if x.endswith("hot")]
            assert first.startswith("own") or same is None
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_a_document_cut_by_borders_counts_once():
    around = d._neighbours([(0, 5, 1, 3, 3), (1, 5, 1, 3, 3), (2, 5, 2, 3, 4), (3, 6, 1, None, None), (4, 6, 2, None, 1)])
    assert around == {(0, 5): (False, 1), (1, 5): (True, 1), (2, 5): (True, 0), (3, 6): (False, 1), (4, 6): (True, 0)}


@pytest.mark.parametrize("most", [0, 5, 1000])
def test_rows_held_back_are_bounded(monkeypatch, most):
    held = []
    add = d._Held.add
    monkeypatch.setattr(d._Held, "add", lambda self, rows: (add(self, rows), held.append(sum(b.num_rows for b in self.batches)))[0])
    rows = [(8, 1)] * 60 + [(9, 1)] * 60 + [(9, 2)] * 3
    batches = [pa.RecordBatch.from_pylist([{"_h": h, "_id": i, "_t": t, "_pos": b"", "_n": 1, "_part": 0} for t, (h, i) in enumerate(rows)][k:k + 4])
               for k in range(0, len(rows), 4)]
    out = [r for b in d._drop_frequent(iter(batches), {}, 2, most_held=most) for r in b.to_pylist()]
    assert sorted(r["_t"] for r in out) == list(range(60, 123))
    assert max(held) <= most
