"""The pipeline, stage by stage, against brute force on the smallest tables."""

import zlib

import numpy as np
import pytest

import corpus_pipeline as p
from weekcast.llm import mixing, quality_bayes, token_files

from .test_decontaminate import brute as brute_hits
from .test_mixing import brute_targets
from .test_near_dedup import brute as brute_groups

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input and output rows of every stage, each written and read again."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    columns = docs.columns
    for k, (name, stage) in enumerate(p.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, SF).write.parquet(path)
        after = spark.read.parquet(path)
        assert k == len(p.STAGES) - 1 or after.columns == columns
        out.append((docs, after))
        docs = after
    return out


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def texts(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_quality_stage(spark, stages):
    before, after = stages[0]
    judged = quality_bayes.judge(before, spark.read.parquet(f"{SF}/labels.parquet")).collect()
    assert ids(after) == sorted(r["doc_id"] for r in judged if r["kept"])
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = set(ids(after))
    assert all(i in kept for i, y in labels.items() if y == 1)


def test_near_duplicate_stage(stages):
    before, after = stages[1]
    assert ids(after) == sorted(i for i, (_, c) in brute_groups(texts(before), 5, 80).items() if i == c)


def test_decontamination_stage(spark, stages):
    before, after = stages[2]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert ids(after) == sorted(i for i, (_, hit, _) in brute_hits(texts(before), items).items() if not hit)


def test_mixing_stage(stages):
    before, after = stages[3]
    rows = mixing.with_size(before).collect()
    sizes, taken, copies = {}, {}, {}
    for r in rows:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["_size"]
    for i in ids(after):
        copies[i] = copies.get(i, 0) + 1
    for r in rows:
        taken[r["source"]] = taken.get(r["source"], 0) + r["_size"] * copies.get(r["doc_id"], 0)
    largest = {s: max(r["_size"] for r in rows if r["source"] == s) for s in sizes}
    assert max(copies.values()) <= 2
    for s, target in brute_targets(sizes).items():
        assert abs(taken[s] - target) <= largest[s]


def test_token_stage(stages):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(token_files.default_tokenizer())
    before, after = stages[4]
    start = 0
    rows = sorted(after.collect(), key=lambda r: r["start"])
    want = sorted(texts(before))
    assert [r["doc_id"] for r in rows] == [i for i, _ in want]
    for r, (_, text) in zip(rows, want, strict=True):
        ids_ = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids_), zlib.crc32(ids_.tobytes()))
        start += len(ids_)


def test_run_gives_the_rows_of_its_stages(spark, stages):
    assert sorted(map(tuple, p.run(spark, SF).collect())) == sorted(map(tuple, stages[-1][1].collect()))
    assert p.ORACLE_SQL is None
