import zlib

import numpy as np
import pytest

from weekcast.llm import token_files as t

from .conftest import sentence

ODD = ["I'm don't <|endoftext|> x<|endoftext|>y  é é ½ ٣ a_b \x1c\x85 z q İ ΣΑΣ ÀB. Ÿ, ß! ÉTÉ", "", "  ", "́ a", "日本語 ok 😀", "a" * 3000,
       "x.. y. Z. ... Wörter, WÖRTER! é. ﬁ ÅK Åk", "tab\there\nline\x0bx\x0cy\r\nz", "it's IT'S 'll. O'Neil"]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(t.default_tokenizer())


def library_ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("cache_words", [2, 200_000])
def test_encoder_agrees_with_the_library(spark, tokenizer, cache_words):
    texts = ODD + [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    encoder = t.WordEncoder(t.default_tokenizer(), cache_words)
    got = [ids for i in range(0, len(texts), 50) for ids in encoder.encode([x.encode() for x in texts[i:i + 50]])]
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [library_ids(tokenizer, x) for x in texts]


def test_other_tokenizers_take_the_library_path():
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder = t.WordEncoder(path)
    assert not encoder.by_word
    assert np.frombuffer(encoder.encode([b"Hello  there\n"])[0], "<u4").tolist() == Tokenizer.from_file(path).encode("Hello  there\n", add_special_tokens=False).ids


@pytest.mark.parametrize("ids", [[], [2], [70_000, 1 << 31, 5], list(range(250, 763)), list(range(512)), [0] * 1024, [256] * 1025])
def test_random_access(ids):
    codes = t.Dac(t.encode_dac(np.array(ids, np.uint32)))
    assert len(codes) == len(ids) and [codes[i] for i in range(len(ids))] == ids
    for a in range(0, len(ids) + 1, 97):
        for b in range(a, len(ids) + 1, 101):
            assert codes.read(a, b).tolist() == ids[a:b]
    with pytest.raises(IndexError):
        codes[len(ids)]


@pytest.mark.parametrize("segment_tokens", [50, 1 << 19])
def test_round_trip(spark, tokenizer, make_docs, tmp_path, segment_tokens):
    rows = [(i, x) for i, x in enumerate([*ODD, None])] + [(3, "again"), (None, "no id")]
    docs = make_docs(rows, clashing=True).repartition(4)
    t.write_token_files(docs, t.default_tokenizer(), str(tmp_path / "f"), segment_tokens=segment_tokens)
    found = sorted(t.read_documents(spark, str(tmp_path / "f")).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in found] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i))
    want = {}
    for i, x in rows:
        want.setdefault(i, []).append([*library_ids(tokenizer, x), 2])
    start = 0
    for r in found:
        assert r["ids"] in want[r["doc_id"]] and r["start"] == start and r["n_tokens"] == len(r["ids"])
        start += r["n_tokens"]
    table = t.segments(spark, str(tmp_path / "f"))
    flat = [x for r in found for x in r["ids"]]
    assert [t.read_token(table, p) for p in (0, 7, start - 1)] == [flat[0], flat[7], flat[-1]]
    with pytest.raises(IndexError):
        t.read_token(table, start)


def test_empty_table(make_docs):
    assert t.token_digests(make_docs([])).collect() == []


def test_query(spark, tokenizer):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    start = 0
    for r in sorted(t.op10(spark, sf).collect(), key=lambda r: r["doc_id"]):
        ids = np.array([*library_ids(tokenizer, texts.pop(r["doc_id"])), 2], "<u4")
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert not texts


def test_packed_ids():
    for ids in ([], [0], [5, 255], [256, 65535, 1], [65536, 2], [2**32 - 1, 0, 7]):
        packed = t.packed_ids(np.array(ids, "<u4").tobytes())
        assert t.unpacked_ids(packed).tolist() == ids and len(packed) == 1 + len(ids) * max(1, -(-max(ids, default=1).bit_length() // 8))


def test_many_equal_rows_are_dealt_out(spark, make_docs, tmp_path):
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    t.write_token_files(make_docs([(7, sentence(1, 60))] * 4000 + [(1, "a")]).repartition(4), t.default_tokenizer(), str(tmp_path / "t"), segment_tokens=1 << 12)
    table = t.segments(spark, str(tmp_path / "t"))
    spark.conf.set(setting, before)
    parts = [r[1] for r in table.groupBy("part").sum("n_tokens").collect()]
    assert len(parts) >= 4 and max(parts) < 0.5 * sum(parts)
    digests = t.read_digests(spark, str(tmp_path / "t")).collect()
    assert len(digests) == 4001 and len({(r["n_tokens"], r["ids_crc32"]) for r in digests}) == 2


def test_ends_of_words():
    code = t.WordEncoder(t.default_tokenizer())
    texts = ["word$$$ word,%%% WORD. \u00c9t\u00e9!! (907) a-b don't x's \u201cq\u201d ... ''", "word's word-- word_ word'", "<|endoftext|> a<|endoftext|>."]
    raw = [x.encode() for x in texts]
    assert code.encode(raw) == code._alone(raw) == code.encode(raw)


def test_words_are_learned_once_where_they_are_met(tokenizer):
    code = t.WordEncoder(t.default_tokenizer(), cache_words=4)
    asked, learned = [], code._learned
    code._learned = code.cache.learn = lambda word: asked.append(word) or learned(word)
    for block in (["Alpha beta, beta", "alpha Été!"], ["beta, gamma alpha", "alpha"], ["delta beta", "Ωmega alpha, ''"]):
        raw = [x.encode() for x in block]
        assert [np.frombuffer(g, "<u4").tolist() for g in code.encode(raw)] == [library_ids(tokenizer, x) for x in block]
        assert len(asked) == len(set(asked)) and set(asked) <= code.cache.keys()      # no word is asked for again within a generation
        if len(code.cache) > code.cache_words:
            asked.clear()
    assert code.older                                                                  # a later block began another generation


def test_rows_pass_a_few_at_a_time(spark, make_docs, tmp_path, monkeypatch):
    """The jobs of ids and segments bound the rows of a batch between Spark and Python, and give the session's settings back."""
    docs, arrow = make_docs([(i, sentence(1, 600)) for i in range(4000)]).coalesce(1), "spark.sql.execution.arrow."
    names = [arrow + "maxRecordsPerBatch", arrow + "maxBytesPerBatch", "spark.sql.shuffle.partitions"]
    before, plain, jobs = {n: spark.conf.get(n) for n in names}, type(docs).mapInArrow, []

    def recorded(df, fn, schema):
        at = f"{tmp_path}/{len(jobs)}"
        jobs.append(at)

        def run(batches):
            def noted():
                for batch in batches:
                    with open(at, "a") as f:
                        f.write(f"{batch.num_rows}\n")
                    yield batch
            yield from fn(noted())
        return plain(df, run, schema)

    monkeypatch.setattr(type(docs), "mapInArrow", recorded)
    spark.conf.set(names[2], "1")
    try:
        rows = t.token_digests(docs).collect()
        assert {n: spark.conf.get(n) for n in names[:2]} == {n: before[n] for n in names[:2]}
    finally:
        spark.conf.set(names[2], before[names[2]])
    assert sorted(r["doc_id"] for r in rows) == list(range(4000)) and len({r["ids_crc32"] for r in rows}) == 1
    sizes = [[int(line) for line in open(at)] for at in jobs[:2]]
    assert [sum(job) for job in sizes] == [4000, 4000] and max(map(max, sizes)) <= 1000


def test_a_row_group_has_some_segments(spark, make_docs, tmp_path):
    import pyarrow.parquet as pq
    words = np.random.default_rng(1).integers(0, 60_000, (400, 12_000))
    docs = make_docs([(i, " ".join(map(str, row))) for i, row in enumerate(words.tolist())])
    setting = "spark.sql.shuffle.partitions"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "1")
    try:
        t.write_token_files(docs.coalesce(4), t.default_tokenizer(), str(tmp_path / "t"), segment_tokens=240_000)
    finally:
        spark.conf.set(setting, before)
    files = [pq.ParquetFile(f).metadata for f in (tmp_path / "t").glob("*.parquet")]
    groups = [m.row_group(i) for m in files for i in range(m.num_row_groups)]
    sizes = [sum(g.column(i).total_compressed_size for i in range(g.num_columns)) for g in groups]
    assert len(files) == 1 and files[0].num_rows < 100 and len(groups) > 1 and max(sizes) < 9 << 20
