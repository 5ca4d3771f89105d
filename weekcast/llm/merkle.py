"""Merkle manifest of a data set with checkpoint-and-recompute proofs.

A leaf is the hash of a row's fields.  The leaves of a group (a source) ascend by id; runs of ``arity`` consecutive
nodes become their parent until one node, the subroot, remains.  The subroots of all groups form a tree of the same
kind, whose top is the root.

1. Leaves are hashed where the texts are read; only digests travel.  They are range-partitioned and sorted by
   (group, id), and a leaf's place in its group is its place in the partition plus the counts of the partitions before,
   so a group that holds a third of all rows is spread over as many tasks as its rows ask for.
2. Only every ``every``-th level is written, as rows of one aligned subtree each: the ``arity ** every`` nodes (at most)
   below one node of the next written level.  A task hashes such a row up to that node; the levels between are not kept.
3. Proofs go from the top down.  Each aligned subtree regenerates its missing interior nodes from its written
   descendants, gives each of these the siblings on its way up followed by those of the subtree's own top, and drops
   the interior again.  A path has at most ``arity - 1`` digests a level.

A task holds one aligned subtree at a time, whatever the size of a group.  Every level is a written table in the shared
folder, so a lost executor's work is redone from there.

Edge cases: a null field is hashed as ``-``, an empty one as ``0:``; null groups and null ids come first; rows with equal
ids are ordered by their hash and are leaves of their own, also if they are equal altogether; a group with one row
has its leaf as subroot, and a table with one group the subroot as root (proof of no sibling: the hash of an empty
string); an empty table gives no rows and no root; a text of any length is hashed whole; columns other than those named
aren't read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import documents, saved, shared_dir
from .registry import query

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_hash(fields: list[F.Column]) -> F.Column:
    """SHA-256 of the fields, each as UTF-8 byte count, ``:``, value, or ``-`` where it is null."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]).cast("binary"), 256)


def height(n: int, arity: int) -> int:
    """Rounds of joining ``arity`` nodes until one of ``n`` remains."""
    h = 0
    while n > 1:
        n, h = -(-n // arity), h + 1
    return h


def joined(nodes: list[str], arity: int) -> list[str]:
    """The parents of a run of nodes that starts at a multiple of ``arity``."""
    return [digest("".join(nodes[i:i + arity])) for i in range(0, len(nodes), arity)]


def regenerated(nodes: list[str], rounds: int, arity: int) -> list[list[str]]:
    """The written nodes of an aligned subtree and its ``rounds`` levels above them."""
    levels = [nodes]
    for _ in range(rounds):
        levels.append(joined(levels[-1], arity))
    return levels


def siblings(levels: list[list[str]], place: int, arity: int) -> list[str]:
    """For each level but the last: the siblings left and right of the node above ``place``, each joined."""
    out = []
    for nodes in levels[:-1]:
        start = place - place % arity
        out += "".join(nodes[start:place]), "".join(nodes[place + 1:start + arity])
        place //= arity
    return out


def folded(leaf: str, path: list[str]) -> str:
    """The top that a leaf and the siblings on its way up lead to."""
    for left, right in zip(path[::2], path[1::2], strict=True):
        leaf = digest(left + leaf + right)
    return leaf


@dataclass
class Manifest:
    """Written levels (level 0 first), and per group: _g, _n, subroot."""
    levels: list[DataFrame]
    tops: DataFrame
    arity: int
    every: int


def _places(rows: DataFrame, order: list[F.Column]) -> DataFrame:
    """``rows`` with ``_n`` (rows of the group _g) and ``_i`` (place in the group, from 0)."""
    part = F.shiftright("_at", 33)
    placed = saved(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()))
    counts = placed.groupBy("_g", part.alias("_part")).agg(F.count(F.lit(1)).alias("_c"), F.min("_at").alias("_first"))
    group = Window.partitionBy("_g")  # a row for each partition that the group is in
    before = F.coalesce(F.sum("_c").over(group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    spans = counts.select("_g", "_part", F.sum("_c").over(group).alias("_n"), (before - F.col("_first")).alias("_shift"))
    return placed.withColumn("_part", part).join(spans, ["_g", "_part"]).withColumn("_i", F.col("_at") + F.col("_shift")).drop("_at", "_part", "_shift")


def _subtrees(rows: DataFrame, span: int, columns: list[str]) -> DataFrame:
    """One row per aligned subtree of ``span`` nodes: _g, _s (its number), _n, and its nodes in order."""
    at = F.pmod("_i", F.lit(span)).cast("int").alias("_k")
    return rows.groupBy("_g", F.floor(F.col("_i") / span).cast("long").alias("_s")).agg(
        F.max("_n").alias("_n"), F.sort_array(F.collect_list(F.struct(at, *columns))).alias("_nodes"))


def build(leaves: DataFrame, out: str, carried: tuple[str, ...] = (), arity: int = 16, every: int = 2) -> Manifest:
    """Write the manifest of ``leaves`` (_g: non-null string, _id, _leaf, and the columns ``carried``) below ``out``."""
    if arity < 2 or every < 1:
        raise ValueError("arity has to be 2 or more and every 1 or more")
    spark, span = leaves.sparkSession, arity ** every
    order = [F.col("_g").asc(), F.col("_id").asc_nulls_first(), F.col("_leaf").asc()]
    rows = _places(leaves, order)
    columns, levels, tops, base = ["_leaf", "_id", *carried], [], None, 0
    top_schema = "_g string, _s long, _n long, _h int, _leaf string"

    def climb(base):
        def run(batches):
            for b in _few(batches):
                made = []
                for n, nodes in zip(b.column("_n").to_pylist(), _leaves_of(b), strict=True):
                    h = height(n, arity)
                    made.append((h, regenerated(nodes, min(every, h - base), arity)[-1][0]))
                yield pa.RecordBatch.from_arrays([b.column("_g"), b.column("_s"), b.column("_n"), pa.array([h for h, _ in made], pa.int32()),
                                                  pa.array([t for _, t in made], pa.string())], names=["_g", "_s", "_n", "_h", "_leaf"])
        return run

    while True:
        path = f"{out}/level_{base}"
        _subtrees(rows, span, columns).write.parquet(path)
        levels.append(spark.read.parquet(path))
        up = saved(levels[-1].select("_g", "_s", "_n", "_nodes").mapInArrow(climb(base), top_schema))
        ended = up.filter(F.col("_h") <= base + every).select("_g", "_n", "_h", F.col("_leaf").alias("subroot"))
        tops = ended if tops is None else tops.unionByName(ended)
        rows = up.filter(F.col("_h") > base + every).select("_g", "_n", F.col("_s").alias("_i"), "_leaf")
        if rows.isEmpty():
            return Manifest(levels, tops, arity, every)
        columns, base = ["_leaf"], base + every


def _few(batches: Iterator[pa.RecordBatch], most: int = 64) -> Iterator[pa.RecordBatch]:
    """The batches in slices of some subtrees, of which a task holds one as Python objects."""
    for b in batches:
        yield from (b.slice(i, most) for i in range(0, b.num_rows, most))


def _ends(batch: pa.RecordBatch) -> list[int]:
    """Where each row's nodes start and end in ``_nodes`` laid end to end."""
    ends = batch.column("_nodes").offsets.to_pylist()
    return [e - ends[0] for e in ends]


def _leaves_of(batch: pa.RecordBatch) -> list[list[str]]:
    values, ends = batch.column("_nodes").flatten().field("_leaf").to_pylist(), _ends(batch)
    return [values[a:b] for a, b in zip(ends, ends[1:], strict=False)]


def paths(manifest: Manifest, tails: DataFrame) -> DataFrame:
    """The leaves' table, one row per aligned subtree, with ``_path``: what is above the subtree's top.

    ``tails`` has, per group, _g, _h, the siblings above its subroot (_path) and the columns subroot and root."""
    arity, every = manifest.arity, manifest.every
    upper = None
    for level in reversed(range(len(manifest.levels))):
        base = level * every
        # groups whose highest written level this is
        here = F.floor(F.greatest(F.col("_h") - 1, F.lit(0)) / every) * every == base
        own = tails.filter(here).select("_g", F.lit(0).cast("long").alias("_s"), "_h", "_path", "subroot", "root")
        upper = own if upper is None else own.unionByName(upper)
        trees = manifest.levels[level].join(upper, ["_g", "_s"])
        if level == 0:
            return trees
        upper = trees.select("_g", "_s", "_h", "_path", "subroot", "root", "_nodes").mapInArrow(_below(base, arity, every), upper.schema)


def _rounds(h: int, base: int, every: int) -> int:
    return min(every, h - base)


def _below(base: int, arity: int, every: int):
    """Per node of a written level above the leaves: the path above it, for the subtree it is the top of."""
    def run(batches):
        for b in _few(batches):
            for g, s, h, path, sub, root, nodes in zip(*(b.column(c).to_pylist() for c in ("_g", "_s", "_h", "_path", "subroot", "root")), _leaves_of(b), strict=True):
                levels, n = regenerated(nodes, _rounds(h, base, every), arity), len(nodes)
                first = s * arity ** every
                yield pa.RecordBatch.from_arrays(
                    [pa.array([g] * n, pa.string()), pa.array(range(first, first + n), pa.int64()), pa.array([h] * n, pa.int32()),
                     pa.array([siblings(levels, i, arity) + path for i in range(n)], pa.list_(pa.string())),
                     pa.array([sub] * n, pa.string()), pa.array([root] * n, pa.string())], names=["_g", "_s", "_h", "_path", "subroot", "root"])
    return run


def proofs(manifest: Manifest, out: str, claim: str | None = None, with_paths: bool = False) -> DataFrame:
    """Per leaf: _g, id, leaf, subroot, root, proof_sha256 (of the siblings, bottom up and left to right), folded_root (what
    the column ``claim``, or else the leaf, leads to with these siblings), verified, and with ``with_paths`` the siblings
    themselves (path: left and right of each level in turn).  The tree of the subroots is written below ``out``."""
    arity, every = manifest.arity, manifest.every
    top = build(manifest.tops.select(F.lit("").alias("_g"), F.col("_g").alias("_id"), F.col("subroot").alias("_leaf"), "_h"), out, ("_h",), arity, every)
    none = F.array().cast("array<string>")
    above = paths(top, top.tops.select("_g", "_h", none.alias("_path"), "subroot", F.col("subroot").alias("root")))
    tails = saved(above.select("_h", "_path", "root", "_nodes").mapInArrow(
        _tails(arity, every), "_g string, _h int, _path array<string>, subroot string, root string"))
    trees = paths(manifest, tails)
    node = trees.schema["_nodes"].dataType.elementType
    schema = T.StructType([T.StructField("_g", T.StringType()), T.StructField("id", node["_id"].dataType)] + [
        T.StructField(c, T.StringType()) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")] + [T.StructField("verified", T.BooleanType())]
        + ([T.StructField("path", T.ArrayType(T.StringType()))] if with_paths else []))

    def run(batches):
        for b in _few(batches):
            flat = b.column("_nodes").flatten()
            ids, claims = flat.field("_id"), flat.field(claim or "_leaf").to_pylist()
            for at, g, h, path, sub, root, nodes in zip(_ends(b), *(b.column(c).to_pylist() for c in ("_g", "_h", "_path", "subroot", "root")), _leaves_of(b)):
                levels, n = regenerated(nodes, _rounds(h, 0, every), arity), len(nodes)
                whole = [siblings(levels, i, arity) + path for i in range(n)]
                tops = [folded(claims[at + i], whole[i]) for i in range(n)]
                made = [pa.array([g] * n, pa.string()), ids.slice(at, n), pa.array(nodes, pa.string()), pa.array([sub] * n, pa.string()),
                        pa.array([root] * n, pa.string()), pa.array([digest("".join(p)) for p in whole], pa.string()),
                        pa.array(tops, pa.string()), pa.array([t == root for t in tops], pa.bool_())]
                yield pa.RecordBatch.from_arrays(made + ([pa.array(whole, pa.list_(pa.string()))] if with_paths else []), names=schema.names)

    return trees.select("_g", "_h", "_path", "subroot", "root", "_nodes").mapInArrow(run, schema)


def _tails(arity: int, every: int):
    """Per group: the siblings of its subroot up to the root, from the rows of the tree of subroots."""
    def run(batches):
        for b in _few(batches):
            flat = b.column("_nodes").flatten()
            ids, heights = flat.field("_id").to_pylist(), flat.field("_h").to_pylist()
            for at, top_h, path, root, nodes in zip(_ends(b), *(b.column(c).to_pylist() for c in ("_h", "_path", "root")), _leaves_of(b)):
                levels, n = regenerated(nodes, _rounds(top_h, 0, every), arity), len(nodes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[at:at + n], pa.string()), pa.array(heights[at:at + n], pa.int32()),
                     pa.array([siblings(levels, i, arity) + path for i in range(n)], pa.list_(pa.string())), pa.array(nodes, pa.string()),
                     pa.array([root] * n, pa.string())], names=["_g", "_h", "_path", "subroot", "root"])
    return run


def document_leaves(docs: DataFrame, fields: tuple[str, ...] = FIELDS, group_col: str = "source", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """_g, _id, _leaf of each row and _claim: the leaf of the row as a reader might find it, that is with A-Z of the text in
    lower case where 5 divides the CRC-32 of the id as text."""
    hit = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))
    altered = [F.translate(F.col(c), UPPER, LOWER) if c == text_col else F.col(c) for c in fields]
    group = F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit(""))  # null first, then bytewise
    leaf = leaf_hash([F.col(c) for c in fields])
    return docs.select(group.alias("_g"), F.col(id_col).alias("_id"), leaf.alias("_leaf"), F.when(hit, leaf_hash(altered)).alias("_claim")) \
               .withColumn("_claim", F.coalesce("_claim", "_leaf"))


def _sql(levels: int = 7) -> str:
    """The same for DuckDB, level by level, for groups of up to 16 ** levels rows."""
    def leaf(text):
        return "sha256(" + " || ".join(f"coalesce(octet_length(encode({c}::varchar))::varchar || ':' || {c}::varchar, '-')"
                                       for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    def tree(name, leaves):  # levels of nodes: g, i, h, and how many the level has
        parts = [f"{name}_0 as (select g, i, h, count(*) over (partition by g) as n from {leaves})"]
        for k in range(levels):
            parts.append(f"""{name}_{k + 1} as (select g, p as i, h, count(*) over (partition by g) as n from (
                select g, i // 16 as p, sha256(string_agg(h, '' order by i)) as h from {name}_{k} where n > 1 group by g, i // 16))""")
        parts.append(f"{name}_top as (" + " union all ".join(f"select g, h from {name}_{k} where n = 1" for k in range(levels + 1)) + ")")
        return parts

    def climb(name, start):  # siblings of every node on each leaf's way up
        parts, source = [], start
        for k in range(levels):
            parts.append(f"""{name}_s{k} as (select a.g, a.i, string_agg(b.h, '' order by b.i) filter (where b.i < a.i) as l,
                string_agg(b.h, '' order by b.i) filter (where b.i > a.i) as r from {name}_{k} a join {name}_{k} b on a.g = b.g and a.i // 16 = b.i // 16
                where a.n > 1 group by a.g, a.i)""")
            parts.append(f"""{name}_p{k} as (select {source}.* exclude (c, path), path || coalesce(s.l, '') || coalesce(s.r, '') as path,
                case when s.g is null then c else sha256(coalesce(s.l, '') || c || coalesce(s.r, '')) end as c
                from {source} left join {name}_s{k} s on s.g = {source}.g and s.i = {source}.i // {16 ** k})""")
            source = f"{name}_p{k}"
        return parts, source

    crc = """xor(list_reduce(list_concat([4294967295::bigint], flatten([[ord(x)::bigint, 0, 0, 0, 0, 0, 0, 0] for x in regexp_extract_all(doc_id::varchar, '.')])),
        lambda a, x: case when (xor(a, x) & 1) = 1 then xor(xor(a, x) >> 1, 3988292384) else xor(a, x) >> 1 end), 4294967295)"""
    parts = [f"""d as (select doc_id, coalesce('=' || source, '') as g, {leaf('text')} as leaf, case when {crc} % 5 = 0
        then {leaf(f"translate(text, '{UPPER}', '{LOWER}')")} else {leaf('text')} end as c from documents)""",
             "d0 as (select *, row_number() over (partition by g order by doc_id nulls first, leaf) - 1 as i, leaf as h from d)",
             *tree("t", "d0"),
             "u0 as (select '' as g, row_number() over (order by encode(g)) - 1 as i, h, g as sub from t_top)",
             *tree("u", "u0")]
    own, last = climb("t", "w")
    top, end = climb("u", "w1")
    parts += ["w as (select doc_id, g, i, leaf, c, '' as path from d0)", *own]
    parts += [f"w1 as (select doc_id, '' as g, u0.i, leaf, u0.h as subroot, {last}.c, {last}.path from {last} join u0 on u0.sub = {last}.g)"]
    parts += top
    return "with " + ",\n".join(parts) + f"""
select doc_id, leaf, subroot, u_top.h as root, sha256(path) as proof_sha256, c as folded_root, c = u_top.h as verified from {end} join u_top on u_top.g = {end}.g"""


@query("op11_merkle_manifest", _sql())
def op11(spark, sf_dir):
    out = shared_dir(spark, "manifest")
    leaves = saved(document_leaves(documents(spark, sf_dir)))
    made = proofs(build(leaves, f"{out}/groups", ("_claim",)), f"{out}/root", "_claim")
    return made.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
