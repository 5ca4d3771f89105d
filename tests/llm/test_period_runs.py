import hashlib
import random
import zlib

import numpy as np
import pytest

from weekcast.llm import period_runs as r


def plain(words, min_length):
    """All runs by comparing every word with the one q words on, for every q."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(min_length, 2 * q):
                found.setdefault((start, i + q), q)  # the smallest period comes first
    return sorted((s, e - s, q) for (s, e), q in found.items())


def ours(texts, min_length=12):
    return [sorted(zip(*(x.tolist() for x in runs), strict=True)) for runs in r.text_runs([[c.encode() for c in t] for t in texts], min_length)]


def fibonacci(n):
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


CASES = ["", "a", "a" * 11, "a" * 12, "a" * 200, "ab" * 40, "bababaababab", "b" + "ab" * 20 + "a" + "ab" * 20 + "ab", fibonacci(300),
         "x" + "abc" * 9 + "y" + "abc" * 9, ("a" * 30 + "b") * 5, ("ab" * 15 + "a") * 4 + "c" + "ba" * 9, "abcdefghijkl" * 2, "abcdefghijklm" * 2 + "a",
         "abcdef" * 2, "abcdef" * 2 + "a", "abcdefghijk" + "abcdefghijk"]


@pytest.mark.parametrize("min_length", [2, 5, 12])
def test_cases(min_length):
    assert ours(CASES, min_length) == [plain(t, min_length) for t in CASES]


@pytest.mark.parametrize("letters", ["a", "ab", "abc", "abcdefgh"])
def test_random_texts(letters):
    rng = random.Random(len(letters))
    for _ in range(40):
        texts = []
        for _ in range(rng.randint(1, 12)):
            t = ""
            while len(t) < rng.randint(0, 150):
                piece = "".join(rng.choice(letters) for _ in range(rng.randint(1, 25)))
                t += piece * rng.randint(1, 5) + piece[:rng.randint(0, len(piece))]
            texts.append(t)
        for least in (2, 12):
            assert ours(texts, least) == [plain(t, least) for t in texts], texts


def test_touching_runs_of_one_difference():
    """Progressions whose runs touch hold many periods of one block."""
    for m in (3, 8, 17, 40):
        for tail in ("", "b", "ba"):
            for head in ("", "b", "ab"):
                t = head + "ab" * m + "a" + "ab" * m + "a" + tail
                assert ours([t], 2) == [plain(t, 2)]


def test_wavelet_successor():
    rng = np.random.default_rng(1)
    for n in (1, 2, 7, 64, 100):
        values = rng.permutation(n).astype(np.int32)
        matrix = r.WaveletMatrix(values)
        left = rng.integers(0, n, 200)
        right = rng.integers(0, n + 1, 200)
        least = rng.integers(0, n + 2, 200)
        want = [min([v for v in values[a:b] if v >= x], default=r.NONE) for a, b, x in zip(left, right, least, strict=True)]
        assert matrix.successor(left, right, least).tolist() == want


def test_every_period_has_one_level():
    for least in (1, 2, 12, 30):
        for k, lo, hi in r.windows(4000, least):
            for p in (lo, hi):
                assert 1 << k <= max(1, (max(2 * p, least) - p + 1) // 2)
        covered = {p for k, lo, hi in r.windows(400, least) for p in range(lo, hi + 1)}
        assert covered == set(range(1, 201))


def expected(doc_id, text):
    words = [w for w in (text or "").replace("\x0b", " ").replace("\x0c", " ").replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if w]
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain(words, 12)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *((best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4),
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in dropped)))


def test_query_against_loops(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").filter("length(text) < 12000")
    docs.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(tuple(x) for x in r.op13(spark, str(tmp_path)).collect())
    assert got == sorted(expected(x["doc_id"], x["text"]) for x in docs.collect()) and any(x[1] for x in got)


def test_edges(spark, make_docs, edge_rows):
    rows = [x for x in edge_rows if x[0] != 6] + [(20, "w " * 5000, "a"), (21, "u v " * 300, "a"), (21, "u v " * 300, "a")]
    got = sorted((tuple(x) for x in r.detect_runs(make_docs(rows, clashing=True), change=r.repeated, outputs=False).collect()), key=repr)
    assert got == sorted((expected(x[0], x[1]) for x in rows), key=repr)
    assert r.detect_runs(make_docs([])).collect() == []


def test_outputs(make_docs):
    row = r.detect_runs(make_docs([(1, "x " + "a b c " * 5 + "y")])).first()
    assert [tuple(x) for x in row["runs"]] == [(1, 15, 3)] and row["collapsed"] == "x a b c y" and row["exponent_milli"] == 5000


def test_a_very_long_text(make_docs):
    rng = random.Random(5)
    words = [str(rng.randrange(50)) for _ in range(60_000)]
    text = " ".join(words + words[:25_000] + words[:25_000])
    row = r.detect_runs(make_docs([(1, text), (2, "a b")])).filter("doc_id = 1").first()
    assert (row["start"], row["length"], row["period"]) == (60_000, 50_000, 25_000)
