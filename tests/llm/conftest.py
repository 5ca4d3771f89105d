import pytest

WORDS = ("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega "
         "one two three four five six seven eight nine ten").split()


def sentence(seed: int, n: int) -> str:
    """n words of a fixed pseudo-random sequence."""
    x, out = seed * 7919 + 13, []
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[(x >> 8) % len(WORDS)])
    return " ".join(out)


#: Columns that clash with names the operators use or return.
CLASHING = ("_id", "_t", "_text", "_size", "_u", "_part", "kept", "score", "spans", "shard", "slot", "copies", "target",
            "source_size", "n_words", "component_id", "n_shingles", "_bin", "_s", "_gone_id", "n_hit", "items")


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows, clashing: bool = False):
        """rows: (doc_id, text[, source[, lang]])"""
        rows = [(*r, "web", "en")[:4] if len(r) == 2 else (*r, "en")[:4] if len(r) == 3 else r for r in rows]
        df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
        if clashing:
            from pyspark.sql import functions as F
            df = df.select("*", *[F.lit("x").alias(c) for c in CLASHING])
        return df
    return make


@pytest.fixture(scope="session")
def edge_rows():
    """Null and empty texts, blanks, ties, repeated rows, null ids and sources, and a very long text."""
    long_text = "\n".join(sentence(i, 40) for i in range(2500))
    same = sentence(1, 60)
    return [(1, None, "a"), (2, "", "a"), (3, " \n\t ", None), (4, same, "b"), (5, same, "b"), (5, same, "b"), (6, long_text, "b"),
            (7, "one", None), (8, "one two", "c"), (None, sentence(2, 80), "c"), (9, sentence(3, 70) + "\n" + sentence(3, 70), "a")]
