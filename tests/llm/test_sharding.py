import zlib
from collections import Counter

import numpy as np
import pytest

from weekcast.llm import sharding as s


def test_matrix_margins():
    sizes = [5, 0, 17, 1000, 3]
    matrix = s.communication_matrix(sizes, 7)
    assert matrix.sum(1).tolist() == sizes and matrix.min() >= 0
    assert sorted(matrix.sum(0).tolist()) == sorted(1025 // 7 + (j < 1025 % 7) for j in range(7))


def test_draws_follow_the_law():
    rng = np.random.default_rng(1)
    got = Counter(s.draw_hypergeometric(rng, 5, 7, 4) for _ in range(40_000))
    from math import comb
    for k in range(5):
        assert abs(got[k] / 40_000 - comb(5, k) * comb(7, 4 - k) / comb(12, 4)) < 0.01
    big = [s.draw_hypergeometric(rng, 10**12, 3 * 10**12, 10**6) for _ in range(300)]
    assert abs(np.mean(big) - 250_000) < 150 and 300 < np.std(big) < 600


@pytest.mark.parametrize("block_rows", [3, 50_000])
def test_exact_sizes_and_gapless_slots(spark, block_rows):
    rows = s.shuffle_into_shards(spark.range(1003).repartition(5), 24, block_rows=block_rows).collect()
    assert sorted(r["id"] for r in rows) == list(range(1003))
    for j in range(24):
        slots = sorted(r["slot"] for r in rows if r["shard"] == j)
        assert slots == list(range(1003 // 24 + (j < 1003 % 24)))


def test_every_place_is_as_likely(spark):
    at = Counter()
    for seed in range(60):
        for r in s.shuffle_into_shards(spark.range(8).coalesce(2), 2, seed=seed, block_rows=2).collect():
            at[r["id"], r["shard"]] += 1
    assert all(12 <= at[i, 0] <= 48 for i in range(8))


def test_edges(make_docs, edge_rows, tmp_path):
    out = s.shuffle_into_shards(make_docs(edge_rows, clashing=True), 3)
    rows = out.collect()
    assert Counter(r["shard"] for r in rows) == {0: 4, 1: 4, 2: 3}
    assert s.shuffle_into_shards(make_docs([]), 3).collect() == []
    s.write_shards(out.select("doc_id", "shard", "slot"), str(tmp_path / "shards"))
    assert out.sparkSession.read.parquet(str(tmp_path / "shards")).count() == len(edge_rows)


def test_query(spark):
    rows = s.op5(spark, "/root/testdata/sf0.001").collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    for r in rows:
        raw = (texts[r["doc_id"]] or "").encode()
        assert r["size"] == len(raw) + 8 and r["text_crc32"] == zlib.crc32(raw) and r["grown_shard"] is None
    assert len(rows) == len(texts)
