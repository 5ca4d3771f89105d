"""Near-duplicate groups by min-max hashing.

Signatures.  A text's words (A-Z lower-cased, split at ASCII white space) give 64-bit shingle hashes.
Under each of ``permutations`` permutations of the 64-bit numbers both the least and the greatest hash are
kept: two unbiased samples of the Jaccard similarity for one evaluation of the permutation.  The 2 x
permutations values are cut into bands; texts that agree on a band share a bucket.  With 60
permutations in 30 bands of 4, a pair at the standard threshold of 0.8 is in no common bucket with a
probability of (1 - 0.8^4)^30 = 1.4e-7, and of less above it; at 0.85, 24 bands of 5 leave 8e-6.

Groups.  Texts with equal shingle sets are one class (keyed by a 128-bit hash of the set), and only
classes go on, so copies are never paired.  A bucket links each of its classes to its smallest one;
connected components of these links are candidate groups and hold every pair that shares a bucket.
A group small enough is compared in one task, all pairs at once, on full shingle sets: a sparse
0/1 matrix times its transpose, in blocks of columns.  A larger one is cut by set size into classes of
ratio 1 / threshold and by hash into blocks: a pair that passes the threshold is in the same or in neighbouring
size classes, so each block meets the blocks it can have links with in tasks of two blocks.
No task holds more than two blocks, no pair leaves a task unless it is confirmed, and of those only a spanning
forest does.  Components of the confirmed links are the result.

The driver sees whether edges are left after a round, nothing else.  Components come from
hooking and contraction on stored tables.

Edge cases: a text without words has an empty set and is its own component; a text with fewer words
than a shingle is one shingle of the whole sequence; rows with equal doc_id and text are rows of one class;
rows with a null id take part (component null if only null ids are in it); an empty table gives an empty
result.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stored
from .common import documents, pieces, saved, text_key, utf8, without
from .registry import query

_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits all depend on all input bits (splitmix64's finish)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASE = np.uint64(0xD6E8FEB86659FD93)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(b" \t\n\x0b\x0c\r")] = True
_POWERS = [np.ones(1, np.uint64)]


def _powers(n: int) -> np.ndarray:
    if len(_POWERS[0]) < n:
        _POWERS[0] = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(max(n, 1 << 12), _BASE, np.uint64), dtype=np.uint64)])
    return _POWERS[0][:n]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of the texts in order, and how many words each text has.
    A hash mixes a polynomial in the bytes of the word, taken for all words at once."""
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    space = _IS_SPACE[data]
    before = np.concatenate([[True], space[:-1]])
    starts = np.flatnonzero(~space & before)
    ends = np.cumsum([len(t) + 1 for t in texts])
    per_text = np.diff(np.concatenate([[0], np.searchsorted(starts, ends)]))
    if not len(starts):
        return np.zeros(0, np.uint64), per_text
    stops = np.flatnonzero(space & ~before)
    lengths = stops - starts
    letters = data[~space].astype(np.uint64) + np.uint64(1)
    at = np.concatenate([[0], np.cumsum(lengths)])
    place = np.arange(at[-1]) - np.repeat(at[:-1], lengths)
    powers = _powers(int(lengths.max()) + 1)
    sums = np.add.reduceat(letters * powers[place], at[:-1])
    return _mixed(sums + powers[lengths] * _MIX), per_text


def shingle_sets(texts: list[str | None], width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    hashes, counts = word_hashes([utf8(t).lower() for t in texts])
    found, at = [], 0
    for n in counts.tolist():
        words = hashes[at:at + n]
        at += n
        k = min(width, n)
        if not k:
            found.append(np.zeros(0, np.uint64))
            continue
        value = np.full(n - k + 1, k, np.uint64)
        for j in range(k):
            value = _mixed((value + words[j:n - k + 1 + j]) * _MIX)
        found.append(np.unique(value))
    return found


def permutations(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """x -> a x + b mod 2^64 with odd a."""
    rng = np.random.default_rng(seed)
    return rng.integers(0, 1 << 64, n, dtype=np.uint64) | np.uint64(1), rng.integers(0, 1 << 64, n, dtype=np.uint64)


def min_max_signatures(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row per set: least and greatest value under each permutation (empty sets: zeros)."""
    out = np.zeros((len(sets), 2 * len(a)), np.uint64)
    full = [i for i, s in enumerate(sets) if len(s)]
    if full:
        values = np.concatenate([sets[i] for i in full])
        starts = np.concatenate([[0], np.cumsum([len(sets[i]) for i in full])[:-1]])
        for k in range(len(a)):
            moved = values * a[k] + b[k]
            out[full, 2 * k] = np.minimum.reduceat(moved, starts)
            out[full, 2 * k + 1] = np.maximum.reduceat(moved, starts)
    return out


def band_hashes(signatures: np.ndarray, rows: int) -> np.ndarray:
    n, width = signatures.shape
    value = np.zeros((n, width // rows), np.uint64)
    for j in range(rows):
        value = _mixed((value + signatures[:, j:width // rows * rows:rows]) * _MIX)
    return _mixed(value + np.arange(width // rows, dtype=np.uint64))  # a bucket belongs to one band


def _key(s: np.ndarray) -> tuple[int, int]:
    digest = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


def signature_table(docs: DataFrame, id_col: str, text_col: str, width: int, n_permutations: int, rows: int, seed: int) -> DataFrame:
    """_id, _t (text key), n_shingles, _k1, _k2 (hash of the set) and _bands (array of long), a row for every row."""
    a, b = permutations(n_permutations, seed)
    source = docs.select(F.col(id_col).alias("_id"), text_key(F.col(text_col)).alias("_t"), F.col(text_col).alias("_text"))
    schema = T.StructType([T.StructField("_id", source.schema["_id"].dataType), *T.StructType.fromDDL(
        "_t long, n_shingles long, _k1 long, _k2 long, _bands array<long>").fields])

    def run(batches):
        for batch in batches:
            for part in pieces(batch, "_text", 1 << 20):
                sets = shingle_sets(part.column("_text").to_pylist(), width)
                bands = band_hashes(min_max_signatures(sets, a, b), rows).view(np.int64)
                keys = [_key(s) for s in sets]
                flat, size = pa.array(bands.reshape(-1)), bands.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [part.column("_id"), part.column("_t"), pa.array([len(s) for s in sets], pa.int64()), pa.array([k for k, _ in keys], pa.int64()),
                     pa.array([k for _, k in keys], pa.int64()),
                     pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1) * size, pa.int32()), flat)], names=schema.names)

    return source.mapInArrow(run, schema)


def components(edges: DataFrame) -> DataFrame:
    """_v and _c, the smallest vertex that is reachable, of every vertex of ``edges`` (_a, _b long).

    Every round each vertex with a smaller neighbour is hooked to the least one, hooks are followed, and edges
    are drawn anew between where they lead, without loops and repetitions.  Two rounds follow hooks four steps far,
    which ends the stars that buckets make; if edges are left, later rounds follow them to their ends, so
    that each at least halves the vertices that have edges.  Vertices of finished components take no part.

    The tables of a round are stored as files, whose sizes the planner reads.  A checkpoint keeps the estimate of its plan instead, a
    product for each join, so that estimates grew to numbers of millions of digits in a few rounds, which the driver held and multiplied."""
    left = stored(edges.select(F.greatest("_a", "_b").alias("_a"), F.least("_a", "_b").alias("_b")).filter("_a <> _b").distinct(), "edges")
    first, steps = left, []

    def followed(hook: DataFrame) -> DataFrame:
        """Hooks twice as long; a vertex without a hook stays where it is."""
        further = hook.select(F.col("_v").alias("_p"), F.col("_p").alias("_q"))
        return hook.join(further, "_p", "left").select("_v", F.coalesce("_q", "_p").alias("_p"))

    while not left.isEmpty():
        hook = stored(left.groupBy(F.col("_a").alias("_v")).agg(F.min("_b").alias("_p")), "hooks")
        hook = stored(followed(followed(hook)), "hooks")
        while len(steps) >= 2:
            longer = stored(followed(hook), "hooks")
            if longer.exceptAll(hook).isEmpty():
                break
            hook = longer
        steps.append(hook)
        x, y = hook.withColumnsRenamed({"_v": "_a", "_p": "_x"}), hook.withColumnsRenamed({"_v": "_b", "_p": "_y"})
        drawn = left.join(x, "_a", "left").join(y, "_b", "left").select(F.coalesce("_x", "_a").alias("_x"), F.coalesce("_y", "_b").alias("_y")).filter("_x <> _y")
        left = stored(drawn.select(F.greatest("_x", "_y").alias("_a"), F.least("_x", "_y").alias("_b")).distinct(), "edges")
    found = first.select(F.col("_a").alias("_v")).union(first.select(F.col("_b").alias("_v"))).distinct().withColumn("_c", F.col("_v"))
    for hook in steps:
        found = found.join(hook.withColumnsRenamed({"_v": "_c", "_p": "_n"}), "_c", "left").select("_v", F.coalesce("_n", "_c").alias("_c"))
    return stored(found, "components")


def linked_pairs(sets: list[np.ndarray], threshold: tuple[int, int], other: np.ndarray | None = None) -> list[tuple[int, int]]:
    """A spanning forest of the pairs (i, j) with 100 |A & B| >= t |A | B|.  other: if given, which block each set is
    of; only pairs across count.  All intersections at once: 0/1 columns for shingles that two sets share."""
    n = len(sets)
    num, den = threshold
    sizes = np.array([len(s) for s in sets], np.int64)
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(n), sizes)
    _, place, often = np.unique(values, return_inverse=True, return_counts=True)
    shared = often[place] > 1
    column = np.cumsum(often > 1)[place[shared]] - 1
    row = owner[shared]
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    common = np.zeros((n, n), np.float32)
    step = max(64, (4 << 20) // max(n, 1))  # columns in a block: 16 MB
    last = int(column[-1]) + 1 if len(column) else 0
    for start in range(0, last, step):
        a, b = np.searchsorted(column, [start, start + step])
        block = np.zeros((n, step), np.float32)
        block[row[a:b], column[a:b] - start] = 1
        common += block @ block.T
    common = common.astype(np.int64)
    linked = den * common >= num * (sizes[:, None] + sizes[None, :] - common)
    root = list(range(n))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    found = []
    for i, j in zip(*np.nonzero(np.triu(linked, 1)), strict=True):
        x, y = find(int(i)), find(int(j))
        if x != y:
            root[max(x, y)] = min(x, y)
            found.append((int(i), int(j)))
    return found


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, threshold: tuple[int, int] = (80, 100),
                    n_permutations: int = 60, rows: int = 4, block: int = 512, seed: int = 5) -> DataFrame:
    """``id_col``, _t (text key), n_shingles, component_id (least id of those that links reach, its own included) and
    kept (it is that id) for every row.  Sets are linked where threshold[1] * |A & B| >= threshold[0] * |A | B|."""
    signed = saved(signature_table(docs, id_col, text_col, width, n_permutations, rows, seed))
    own = F.xxhash64("_k1", "_k2")  # names a class; the 128 bits tell classes apart where sets are compared
    classes = signed.filter("n_shingles > 0").groupBy("_k1", "_k2").agg(F.min("_id").alias("_rep"), F.min(F.struct("_id", "_t")).alias("_own"), F.first("n_shingles").alias("_n"), F.first("_bands").alias("_bands"))
    classes = saved(classes.withColumn("_v", own))
    hits = classes.select("_v", F.explode("_bands").alias("_bucket"))
    leads = hits.groupBy("_bucket").agg(F.min("_v").alias("_lead"), F.max("_v").alias("_last")).filter("_lead <> _last").drop("_last")
    stars = hits.join(leads, "_bucket").filter("_v <> _lead").select(F.col("_v").alias("_a"), F.col("_lead").alias("_b")).distinct()
    groups = components(stars).withColumnRenamed("_c", "_g")
    members = saved(_blocked(groups.join(classes.select("_v", "_k1", "_k2", F.col("_own._id").alias("_rep"), F.col("_own._t").alias("_t"), "_n"), "_v"), threshold, block))
    edges = saved(_confirmed(docs, members, id_col, text_col, width, threshold))
    return _result(signed, classes, components(edges), id_col)


def _blocked(members: DataFrame, threshold: tuple[int, int], block: int) -> DataFrame:
    """A row for each task that a class takes part in: _g, _x and _y (its two blocks, equal in small groups)."""
    ratio = math.log(threshold[1] / threshold[0])
    # sizes of linked sets differ by the ratio at most; a little less of it keeps rounding from moving them two classes apart
    sized = members.withColumn("_s", F.floor(F.log(F.col("_n").cast("double")) / (ratio * 1.000001)).cast("int"))
    counts = sized.groupBy("_g", "_s").agg(F.count(F.lit(1)).alias("_m"))
    # by group: its classes, and the blocks of each size (sizes are logarithms, so a group has few)
    groups = counts.groupBy("_g").agg(F.sum("_m").alias("_all"), F.map_from_entries(F.collect_list(F.struct(
        F.col("_s"), F.ceil(F.col("_m") / block).cast("int")))).alias("_blocks"))
    cut = sized.join(groups, "_g")
    cut = cut.withColumns({"_here": F.try_element_at("_blocks", F.col("_s")), "_above": F.try_element_at("_blocks", F.col("_s") + 1),
                           "_below": F.try_element_at("_blocks", F.col("_s") - 1)})
    cut = cut.withColumn("_i", F.pmod(F.xxhash64("_k2", "_k1"), F.col("_here")).cast("int"))
    name = lambda s, i: F.concat_ws(".", s.cast("string"), i.cast("string"))
    me = name(F.col("_s"), F.col("_i"))
    none = F.array().cast("array<struct<x:string,y:string>>")
    same = F.transform(F.sequence(F.lit(0), F.col("_here") - 1), lambda j: F.struct(
        name(F.col("_s"), F.least(F.col("_i"), j)).alias("x"), name(F.col("_s"), F.greatest(F.col("_i"), j)).alias("y")))
    up = F.when(F.col("_above").isNotNull(), F.transform(F.sequence(F.lit(0), F.col("_above") - 1), lambda j: F.struct(
        me.alias("x"), name(F.col("_s") + 1, j).alias("y")))).otherwise(none)
    down = F.when(F.col("_below").isNotNull(), F.transform(F.sequence(F.lit(0), F.col("_below") - 1), lambda j: F.struct(
        name(F.col("_s") - 1, j).alias("x"), me.alias("y")))).otherwise(none)
    alone = F.array(F.struct(F.lit("").alias("x"), F.lit("").alias("y")))
    tasks = F.when(F.col("_all") <= 2 * block, alone).otherwise(F.concat(same, up, down))
    spread = cut.withColumn("_task", F.explode(tasks))
    return spread.select("_g", F.col("_task.x").alias("_x"), F.col("_task.y").alias("_y"), "_v", "_k1", "_k2", "_rep", "_t")


def _confirmed(docs: DataFrame, members: DataFrame, id_col: str, text_col: str, width: int, threshold: tuple[int, int]) -> DataFrame:
    """_a, _b: a spanning forest of the links inside each task, confirmed on the full sets of the texts."""
    # by id and text: rows of one id, null or not, don't meet each other's classes
    texts = docs.select(F.col(id_col).alias("_rep"), text_key(F.col(text_col)).alias("_t"), F.col(text_col).alias("_text"))
    wanted = members.select("_rep", "_t", "_g", "_x", "_y", "_v", "_k1", "_k2")
    held = texts.join(wanted, texts["_rep"].eqNullSafe(wanted["_rep"]) & (texts["_t"] == wanted["_t"])).select("_g", "_x", "_y", "_v", "_k1", "_k2", "_text")

    def compare(table: pa.Table) -> pa.Table:
        sets, names, seen = [], [], set()
        for v, k1, k2, text in zip(*(table.column(c).to_pylist() for c in ("_v", "_k1", "_k2", "_text")), strict=True):
            (one,) = shingle_sets([text], width)
            if v not in seen and _key(one) == (k1, k2):  # rows with this id but another text belong elsewhere
                seen.add(v)
                sets.append(one)
                names.append(v)
        found = linked_pairs(sets, threshold) if len(sets) > 1 else []
        return pa.table({"_a": pa.array([names[i] for i, _ in found], pa.int64()), "_b": pa.array([names[j] for _, j in found], pa.int64())})

    return held.groupBy("_g", "_x", "_y").applyInArrow(compare, "_a long, _b long")


def _result(signed: DataFrame, classes: DataFrame, linked: DataFrame, id_col: str) -> DataFrame:
    labelled = classes.select("_k1", "_k2", "_rep", "_v").join(linked, "_v", "left").withColumn("_c", F.coalesce("_c", "_v"))
    least = labelled.groupBy("_c").agg(F.min("_rep").alias("_least"))
    known = labelled.join(least, "_c").select("_k1", "_k2", "_least")
    rows = signed.select("_id", "_t", "n_shingles", "_k1", "_k2").join(known, ["_k1", "_k2"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("_least")).otherwise(F.col("_id"))
    return rows.select(F.col("_id").alias(id_col), "_t", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col(id_col).eqNullSafe(F.col("component_id")))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` whose document is kept, unchanged; of rows with equal id and text one stays.
    Documents without words are in no group and stay."""
    found = saved(near_duplicates(docs, id_col, text_col, **options))
    left = without(docs, found.filter(~F.col("kept")).select(F.col(id_col).alias("_id"), "_t"), id_col, text_col)
    again = found.filter("kept and n_shingles > 0").groupBy(id_col, "_t").count().filter("count > 1")
    return left if again.isEmpty() else left.dropDuplicates([id_col, text_col])


_ORACLE = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 2)) AS i FROM w)
      UNION ALL SELECT doc_id, array_to_string(ws, ' ') FROM w WHERE len(ws) IN (1, 2)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (g) WHERE a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
u AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach(v, c) AS (SELECT doc_id, doc_id FROM w UNION SELECT u.b, reach.c FROM reach JOIN u ON u.a = reach.v),
m AS (SELECT v AS doc_id, min(c) AS component_id FROM reach GROUP BY v)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM m LEFT JOIN n USING (doc_id)
"""


@query("op3_minmax_near_dedup", _ORACLE)
def op3(spark, sf_dir):
    return near_duplicates(documents(spark, sf_dir), width=3, threshold=(85, 100), rows=5).drop("_t")
