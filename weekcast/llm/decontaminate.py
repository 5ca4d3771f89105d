"""Benchmark decontamination by winnowing, in DataFrame functions only.

Words are hashed, every run of ``k`` words gets a hash, and the least hash of each ``window`` - k + 1
neighbouring runs is kept.  A span of ``window`` words is exactly one such neighbourhood, so texts that
share it keep the same hash there: fingerprints of a corpus and a benchmark meet in every shared
span of that length, with about 2 / (window - k + 2) of the positions kept.  Items shorter than the
window are one window of their own length; for each such length in the benchmark all runs of
that length are fingerprints.

Fingerprints of the documents join those of the benchmark.  Documents without a hit are done; the
others' hits are extended on their words: all windows of a candidate document join the windows of the benchmark as
text, so a hash collision costs time, never a wrong hit.

What is broadcast is counted first (``broadcast_rows``); beyond it the joins shuffle.

Edge cases: a null or empty text has no words and no hits; an item without words has no window;
equal items are items of their own; rows with equal id and text give equal rows; an empty benchmark
leaves every document clean; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded, documents, saved, text_key, without
from .registry import query

WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """The words of a text with A-Z in lower case (other letters stay: lower() is right for ASCII texts alone)."""
    plain = F.coalesce(text, F.lit(""))
    low = F.when(F.octet_length(plain) == F.char_length(plain), F.lower(plain)).otherwise(F.translate(plain, _UPPER, _LOWER))
    return F.regexp_extract_all(low, F.lit(WORDS), F.lit(0))


def _runs(hashes: str, length: int) -> Column:
    """A hash of each run of ``length`` words.  ``hashes`` names a column, so no lambda computes it again."""
    h = F.col(hashes)
    at = F.sequence(F.lit(0), F.size(h) - length)
    return F.when(F.size(h) >= length, F.transform(at, lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(length)]))).otherwise(
        F.array().cast("array<bigint>"))


def _least(runs: str, n: int) -> Column:
    """The least hash of each n neighbouring runs (none if there are fewer)."""
    g = F.col(runs)
    return F.when(F.size(g) >= n, F.transform(F.slice(g, F.lit(1), F.size(g) - (n - 1)), lambda x, i: F.least(x, *[F.get(g, i + j) for j in range(1, n)]) if n > 1 else x)).otherwise(
        F.array().cast("array<bigint>"))


def fingerprints(rows: DataFrame, word_col: str, k: int, window: int, short: list[int]) -> DataFrame:
    """``rows`` with _prints: distinct fingerprints, each a struct of len (window, or a short length) and hash."""
    names = rows.columns
    hashed = rows.withColumn("_h", F.transform(F.col(word_col), lambda w: F.xxhash64(w)))
    hashed = hashed.withColumn("_g", _runs("_h", k))
    kept = hashed.withColumn("_kept", F.array_distinct(_least("_g", window - k + 1)))

    def tag(column: str, length: int) -> Column:
        return F.transform(F.col(column), lambda x: F.struct(F.lit(length).alias("len"), x.alias("hash")))

    tagged = [tag("_kept", window)]
    for length in short:
        kept = kept.withColumn(f"_g{length}", F.array_distinct(_runs("_h", length)))
        tagged.append(tag(f"_g{length}", length))
    return kept.select(*names, (F.concat(*tagged) if short else tagged[0]).alias("_prints"))


def find_hits(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
              item_text_col: str = "text", window: int = 10, k: int = 5, broadcast_rows: int = 200_000) -> DataFrame:
    """``id_col``, _t (text key), n_words, n_hit (words inside an occurrence of a window) and items (array of the ids whose
    windows occur, sorted as strings) for every row of ``docs``."""
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    items = saved(benchmark.select(F.col(item_col).cast("string").alias("_item"), words(F.col(item_text_col)).alias("_w"))
                  .filter(F.size("_w") > 0).repartition(tasks, "_item", F.size("_w")))
    short = sorted(r[0] for r in items.select(F.size("_w")).filter(F.size("_w") < window).distinct().collect())  # window - 1 rows at most
    length = F.least(F.size("_w"), F.lit(window))
    windows = saved(items.select("_item", length.alias("_len"), F.explode(F.array_distinct(_texts(F.col("_w"), length))).alias("_text")))
    # saved before the explode: the filter that Spark infers for one would copy the fingerprints' expressions into each other
    printed = saved(fingerprints(items.filter(F.size("_w") >= window), "_w", k, window, [])
                    .unionByName(fingerprints(items.filter(F.size("_w") < window), "_w", k, window, short)
                                 .withColumn("_prints", F.filter("_prints", lambda p: p["len"] == F.size("_w"))))
                    .select("_prints"))
    prints = saved(printed.select(F.explode("_prints").alias("_p")).select(F.col("_p.len").alias("_len"), F.col("_p.hash").alias("_hash")).distinct()
                   .withColumn("_found", F.lit(1)))

    own = docs.select(F.col(id_col).alias("_id"), text_key(F.col(text_col)).alias("_t"), F.col(text_col).alias("_text"))
    split = own.select("_id", "_t", words(F.col("_text")).alias("_w")).withColumn("_n", F.size("_w").cast("long"))
    each = fingerprints(split, "_w", k, window, short).select("_id", "_t", "_n", F.posexplode_outer("_prints").alias("_at", "_p"))
    met = each.select("_id", "_t", "_n", "_at", F.col("_p.len").alias("_len"), F.col("_p.hash").alias("_hash")).join(
        bounded(prints, broadcast_rows), ["_len", "_hash"], "left")
    rows = saved(met.groupBy("_id", "_t", "_n").agg(F.count(F.when(F.coalesce("_at", F.lit(0)) == 0, 1)).alias("_rows"), F.max("_found").alias("_found")))

    candidates = rows.filter("_found = 1").select(F.col("_id").alias("_i"), F.col("_t").alias("_k"))
    texts = own.join(bounded(candidates, broadcast_rows), F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_t") == F.col("_k")), "left_semi").dropDuplicates(["_id", "_t"])
    found = texts.select("_id", "_t", words(F.col("_text")).alias("_w"))
    lengths = F.explode(F.array(F.lit(window), *[F.lit(n) for n in short])).alias("_len")
    spans = (found.select("_id", "_t", "_w", lengths).select("_id", "_t", "_len", F.posexplode(_texts(F.col("_w"), F.col("_len"))).alias("_at", "_text"))
             .join(bounded(windows, broadcast_rows), ["_len", "_text"]))
    hits = saved(spans.select("_id", "_t", "_len", "_at", "_item"))
    named = hits.groupBy("_id", "_t").agg(F.collect_set("_item").alias("_items"))
    before = Window.partitionBy("_id", "_t").orderBy("_at", "_len").rowsBetween(Window.unboundedPreceding, -1)
    stop = F.col("_at") + F.col("_len")
    new = F.greatest(F.lit(0), stop - F.greatest(F.col("_at"), F.coalesce(F.max(stop).over(before), F.lit(0))))
    covered = hits.select("_id", "_t", "_at", "_len").distinct().withColumn("_new", new).groupBy("_id", "_t").agg(F.sum("_new").alias("_hit"))
    all_hits = named.join(covered.withColumnsRenamed({"_id": "_i", "_t": "_k"}), F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_t") == F.col("_k"))).select("_i", "_k", "_items", "_hit")
    out = rows.join(all_hits, F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_t") == F.col("_k")), "left")
    out = out.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_rows"))))
    return out.select(F.col("_id").alias(id_col), "_t", F.col("_n").alias("n_words"), F.coalesce("_hit", F.lit(0)).cast("long").alias("n_hit"),
                      F.coalesce(F.array_sort("_items"), F.array().cast("array<string>")).alias("items"))


def _texts(w: Column, length: Column) -> Column:
    """The runs of ``length`` words as texts.  Both are columns of one narrow row, not computed again for each run."""
    return F.when(F.size(w) >= length, F.transform(F.sequence(F.lit(1), F.size(w) - length + 1), lambda i: F.array_join(F.slice(w, i, length), " "))).otherwise(
        F.array().cast("array<string>"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without a hit, unchanged."""
    hit = find_hits(docs, benchmark, id_col, text_col, **options).filter("n_hit > 0")
    return without(docs, hit.select(F.col(id_col).alias("_id"), "_t"), id_col, text_col)


_ORACLE = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x{0}-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x{0}-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iw AS (SELECT DISTINCT item, n, array_to_string(w[s:s + n - 1], ' ') AS g FROM (SELECT item, w, least(10, len(w)) AS n, unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) AS s FROM i WHERE len(w) > 0)),
dw AS (SELECT r, n, s, array_to_string(w[s:s + n - 1], ' ') AS g FROM (SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS s FROM d, (SELECT DISTINCT n FROM iw))),
h AS (SELECT r, s, n, item FROM dw JOIN iw USING (n, g)),
p AS (SELECT r, count(DISTINCT pos) AS n_hit FROM (SELECT r, unnest(generate_series(s, s + n - 1)) AS pos FROM h) GROUP BY r),
q AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM h) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN p USING (r) LEFT JOIN q USING (r)
"""


@query("op4_winnowing_decontamination", _ORACLE)
def op4(spark, sf_dir):
    hits = find_hits(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return hits.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                       F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
