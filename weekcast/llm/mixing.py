"""Mixing sources to target weights by Pareto order sampling.

Sources, in code point order (null last), get the weights of a repeating list and share
``total_ratio`` times all words by weight; a target stops at ``max_copies`` times its source's
size and the excess is shared again by weight (water filling, solved in closed form over the
sources ordered by cap per weight).

A document's expected number of copies is its source's target over its size.  The whole part is
allocated for certain; the fraction is its inclusion probability p.  Documents are ranked by
q = (u / (1 - u)) / (p / (1 - p)), u uniform in (0, 1) from a hash of seed, id and text, and a
source takes the prefix of that order whose words come closest to what is left of its target (the
last document is taken if more than half of it fits).  With ``weight_col`` a document's expectation
is proportional to its weight (null: 1; below 0: 0), clipped at ``max_copies``, at the level where a source's
expected words sum to its target; so inclusion probabilities differ within a source as well, and the prefix still
ends at the source's target (which it can't reach where documents of weight above 0 have too few words).

No window runs over a source: the rank scale is cut into bins of about ``bin_rows`` documents whatever p is
(on u where a source has one p; else on ln q, in cells that are cut again by their counts), the words of bins
are summed first, and only the one bin of a source in which its target ends is ordered, in one task.

Edge cases: a null text has size 0 and null sources form one source; documents of size 0 are
ranked like any other and take no words; repeated rows are documents of their own with equal u
(which of them a boundary takes doesn't matter); with no words at all every target is 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, documents, packed, saved, uniform
from .registry import query

SEED = 20240607


def with_size(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED) -> DataFrame:
    """``docs`` with _size (words) and _u."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.withColumns({"_size": F.regexp_count(text, F.lit(WORD)).cast("long"),
                             "_u": uniform(seed, F.col(id_col), F.md5(text.cast("binary")))})


def source_targets(sized: DataFrame, source_col: str = "source", weights: tuple[float, ...] = (3, 1, 2),
                   total_ratio: float = 1.5, max_copies: int = 2) -> DataFrame:
    """_src, source_size, n_docs, target: a row per source.  The windows run over this table alone."""
    per = sized.groupBy(F.col(source_col).alias("_src")).agg(F.sum("_size").alias("source_size"),
                                                              F.count(F.lit(1)).alias("n_docs"))
    place = F.row_number().over(Window.orderBy(F.col("_src").asc_nulls_last())) - 1
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    weighed = (per.withColumn("_w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int")))
               .withColumn("_cap", (F.col("source_size") * max_copies).cast("long"))
               .withColumn("_total", F.sum("source_size").over(every) * total_ratio))
    order = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("_src").asc_nulls_last())
    before = F.coalesce(F.sum("_cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    after = F.sum("_w").over(order.rowsBetween(0, Window.unboundedFollowing))
    level = (F.col("_total") - before) / after
    leveled = weighed.withColumn("_level", F.when(level <= F.col("_cap") / F.col("_w"), level))
    # the first source in order that stays under its cap sets the level; without one all are capped
    lam = F.first("_level", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    target = F.least(F.col("_cap").cast("double"), F.coalesce(lam * F.col("_w"), F.col("_cap").cast("double")))
    return leveled.withColumn("target", target).select("_src", "source_size", "n_docs", "target")


def with_bins(rows: DataFrame, source_col: str, one_p: bool, bin_rows: int) -> DataFrame:
    """``rows`` (with _u, _q and n_docs) with _bin: a struct that rises with _q, of about ``bin_rows`` documents a source and value."""
    bins = F.ceil(F.col("n_docs") / bin_rows)
    spread = F.least(F.floor(F.col("_u") * bins), bins - 1)
    # documents without a fraction take no part in the order; they are spread over bins below all others
    none = F.struct(F.lit(-(1 << 40)).alias("cell"), spread.alias("sub"))
    if one_p:  # q rises with u, which is uniform
        return rows.withColumn("_bin", F.when(F.col("_q").isNull(), none).otherwise(F.struct(F.lit(0).cast("long").alias("cell"), spread.alias("sub"))))
    # ln q is logit u - logit p: within a cell of 1/8 its density, a mixture of logistic ones, changes by e^(1/8) at most
    rows = (rows.withColumn("_at", 8 * F.greatest(F.least(F.log("_q"), F.lit(1000.0)), F.lit(-1000.0)))
            .withColumn("_cell", F.coalesce(F.floor("_at"), F.lit(-(1 << 40)))))
    cells = rows.groupBy(F.col(source_col).alias("_s"), F.col("_cell").alias("_c")).agg(F.ceil(F.count(F.lit(1)) / bin_rows).alias("_cuts"))
    rows = rows.join(cells, F.col(source_col).eqNullSafe(F.col("_s")) & (F.col("_cell") == F.col("_c")), "inner")
    sub = F.least(F.floor((F.col("_at") - F.col("_cell")) * F.col("_cuts")), F.col("_cuts") - 1)
    return rows.withColumn("_bin", F.when(F.col("_q").isNull(), none).otherwise(F.struct(F.col("_cell").alias("cell"), sub.alias("sub")))).drop("_s", "_c", "_cuts", "_at", "_cell")


def weight_levels(rows: DataFrame, source_col: str, max_copies: int) -> DataFrame:
    """_s and _level, a row per source: the level at which the words of least(max_copies, level * _weight) copies sum to the target.

    The words are concave and piecewise linear in the level, so Newton's steps from the level without a clip rise
    to the solution and end there; each is an aggregate over the table of sources and weights."""
    per = saved(rows.groupBy(F.col(source_col).alias("_src"), "_weight").agg(F.sum("_size").alias("_n"), F.first("target").alias("_target")))
    levels = per.select(F.col("_src").alias("_s"), F.lit(0.0).alias("_level"), F.lit(True).alias("_moved")).distinct()
    while True:
        clipped = F.col("_level") * F.col("_weight") >= max_copies
        level = (F.first("_target") - F.sum(F.when(clipped, F.col("_n")).otherwise(0)) * max_copies) / F.nullif(
            F.sum(F.when(clipped, 0.0).otherwise(F.col("_n") * F.col("_weight"))), F.lit(0.0))
        found = per.join(levels, F.col("_src").eqNullSafe(F.col("_s")), "inner").groupBy("_s").agg(level.alias("_new"), F.first("_level").alias("_level"))
        higher = F.coalesce(F.col("_new") > F.col("_level") * (1 + 1e-12), F.lit(False))
        levels = saved(found.select("_s", F.when(higher, F.col("_new")).otherwise(F.col("_level")).alias("_level"), higher.alias("_moved")))
        if levels.filter("_moved").isEmpty():
            return levels.select("_s", "_level")


def allocate(sized: DataFrame, targets: DataFrame, id_col: str = "doc_id", source_col: str = "source",
             max_copies: int = 2, weight_col: str | None = None, bin_rows: int = 1_000) -> DataFrame:
    """``sized`` with source_size, target and copies (long).  Other columns are carried, but for those with
    names of the operator's own (these three and any that begin with an underscore, save _size, _u and _row)."""
    given = {id_col, source_col, weight_col, "_size", "_u", "_row"}
    own = sized.select(*[c for c in sized.columns if c in given or not (c.startswith("_") or c in ("source_size", "n_docs", "target", "copies"))])
    rows = own.join(targets, F.col(source_col).eqNullSafe(F.col("_src")), "inner").drop("_src")
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    if weight_col:
        rows = rows.withColumn("_weight", F.greatest(F.coalesce(F.col(weight_col).cast("double"), F.lit(1.0)), F.lit(0.0)))
        levels = weight_levels(rows, source_col, max_copies)
        rows = rows.join(levels, F.col(source_col).eqNullSafe(F.col("_s")), "inner").drop("_s")
        expected = F.least(F.lit(float(max_copies)), F.col("_level") * F.col("_weight"))
    rows = (rows.withColumn("_e", expected)
            .withColumn("_whole", F.floor("_e").cast("long"))
            .withColumn("_p", F.col("_e") - F.col("_whole"))
            .withColumn("_q", F.when(F.col("_p") > 0, (F.col("_u") / (1 - F.col("_u"))) / (F.col("_p") / (1 - F.col("_p"))))))
    rows = with_bins(rows, source_col, weight_col is None, bin_rows)
    per_bin = rows.groupBy(F.col(source_col).alias("_s"), F.col("_bin").alias("_b")).agg(
        F.sum(F.when(F.col("_q").isNotNull(), F.col("_size")).otherwise(0)).alias("_words"),
        F.sum(F.col("_whole") * F.col("_size")).alias("_sure"))
    by_source = Window.partitionBy("_s")
    per_bin = saved(per_bin.withColumn("_before", F.coalesce(F.sum("_words").over(by_source.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
                    .withColumn("_certain", F.sum("_sure").over(by_source)))
    placed = rows.join(per_bin, F.col(source_col).eqNullSafe(F.col("_s")) & (F.col("_bin") == F.col("_b")), "inner")
    left, end = F.col("target") - F.col("_certain"), F.col("_before") + F.col("_words")
    # bins that end by then are taken, those that begin later aren't; one bin a source is left to be ordered
    split = F.col("_q").isNotNull() & (F.col("_before") <= left) & (end > left)
    order = Window.partitionBy("_s", "_b").orderBy("_q", id_col, "_size")
    in_bin = F.sum("_size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_size")
    placed = (placed.filter(~split).withColumn("_extra", F.when(F.col("_q").isNotNull() & (end <= left), 1).otherwise(0))
              .unionByName(placed.filter(split).withColumn("_extra", F.when(F.col("_before") + in_bin + F.col("_size") / 2 <= left, 1).otherwise(0))))
    placed = placed.withColumn("copies", F.least(F.col("_whole") + F.col("_extra"), F.lit(max_copies)).cast("long"))
    return placed.select(*own.columns, "source_size", "target", "copies")


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    weights: tuple[float, ...] = (3, 1, 2), total_ratio: float = 1.5, max_copies: int = 2) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken, with the same columns."""
    sized = with_size(packed(docs, _doc=id_col, _source=source_col, _text=text_col), "_doc", "_text").drop("_text")
    targets = source_targets(sized, "_source", weights, total_ratio, max_copies)
    taken = allocate(sized, targets, "_doc", "_source", max_copies).filter("copies > 0")
    return taken.withColumn("copies", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("_row.*")


_ORACLE = rf"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    (('0x' || substr(md5('{SEED}|' || coalesce(doc_id::VARCHAR, '~') || '|' || md5(coalesce(text, ''))), 1, 13))::BIGINT + 0.5::DOUBLE)
      / 4503599627370496::DOUBLE AS u FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n FROM d GROUP BY source),
w AS (SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w,
        2 * source_size AS cap, (sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE AS total FROM s),
l AS (SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev,
        row_number() OVER (ORDER BY cap / w, source NULLS LAST) AS k FROM w),
lam AS (SELECT min_by(lev, k) AS lam FROM l WHERE lev <= cap / w),
t AS (SELECT source, source_size, least(cap::DOUBLE, coalesce(lam * w, cap::DOUBLE)) AS target FROM l, lam),
e AS (SELECT d.*, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS e
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
q AS (SELECT *, floor(e)::BIGINT AS whole, e - floor(e) AS p FROM e),
r AS (SELECT *, CASE WHEN p > 0 THEN (u / (1 - u)) / (p / (1 - p)) END AS q FROM q),
c AS (SELECT *, sum(CASE WHEN q IS NULL THEN 0 ELSE size END) OVER (PARTITION BY source ORDER BY q NULLS FIRST, doc_id, size
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS before, sum(whole * size) OVER (PARTITION BY source) AS sure FROM r)
SELECT doc_id, size, source_size, target,
  (least(2, whole + CASE WHEN q IS NOT NULL AND before + size / 2 <= target - sure THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM c
"""


@query("op6_pareto_mixing", _ORACLE)
def op6(spark, sf_dir):
    sized = saved(with_size(documents(spark, sf_dir).select("doc_id", "source", "text")).drop("text"))
    mix = allocate(sized, source_targets(sized))
    return mix.select("doc_id", F.col("_size").alias("size"), "source_size", "target",
                      (F.col("copies") * F.col("_size")).alias("taken"))
