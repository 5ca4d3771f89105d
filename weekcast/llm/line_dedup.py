"""Line deduplication that returns keep bitmaps.

Lines (split at \\n) are keyed by their text stripped of ASCII white space with A-Z in lower case.

1. Each document yields one row per distinct key: a 64-bit hash, its id and the positions of the
   lines with that key, so repeats within a document never reach a shuffle.
2. These rows are range-partitioned by (hash, document, first position) and sorted in that order.  A hot line's run is
   cut across partitions by the document part of the key, so no partition holds all of it.
3. Partitions are streamed.  A first pass counts the documents of each partition's first and last
   run and notes the ids at their ends (two rows a partition), so that a document whose rows are cut by a
   border counts once; the second knows from these what neighbours hold of its border runs
   and decides every line: ``policy="frequent"`` drops all lines of keys found in ``min_docs`` documents
   or more, ``policy="first"`` keeps the first occurrence by (document, position) alone.
4. The dropped positions of a document come together as one compressed bitmap of kept lines.

The text itself is not in any of these steps; ``apply_bitmaps`` joins the bitmaps to the texts.

Edge cases: a null or empty text is one empty line; keys shorter than ``min_chars`` code points are
always kept; rows with equal ids count as one document for ``min_docs`` and rows with equal id and
text have equal results; null ids form one document.  Hashes are 64 bits of BLAKE2b: among 10^10
distinct lines the chance that any two collide is under 3 in 10, and a collision matters only if it
lifts a rare line over the threshold.
"""

from __future__ import annotations

import hashlib
import struct
import tempfile
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SPACE, documents, pieces, saved, utf8
from .registry import query

_CONTINUATION = bytes(range(0x80, 0xC0))


def _hash(data: bytes) -> int:
    return struct.unpack("<q", hashlib.blake2b(data, digest_size=8).digest())[0]


def line_keys(text: str | None, min_chars: int) -> dict[int, list[int]]:
    """By hash of the key the positions of its lines."""
    found: dict[bytes, list[int]] = {}
    for i, line in enumerate(utf8(text).split(b"\n")):
        key = line.strip(SPACE).lower()
        if key and (min_chars == 1 or len(key.translate(None, _CONTINUATION)) >= min_chars):
            found.setdefault(key, []).append(i)
    return {_hash(k): v for k, v in found.items()}


def _with_hash(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """_id, _text and _t, by which lines and bitmaps find rows with one id but different texts."""
    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("_t"))


def line_table(docs: DataFrame, id_col: str, text_col: str, min_chars: int = 1) -> DataFrame:
    """_h, _id, _t (hash of the text), _first, _n (positions) and _pos (positions as packed u32)."""
    rows = _with_hash(docs, id_col, text_col)

    def run(batches):
        for batch in batches:
            for part in pieces(batch, "_text"):
                made, row = [], []
                for i, text in enumerate(part.column("_text").to_pylist()):
                    for h, where in line_keys(text, min_chars).items():
                        made.append((h, where[0], len(where), struct.pack(f"<{len(where)}I", *where)))
                        row.append(i)
                h, first, n, pos = zip(*made, strict=True) if made else ((), (), (), ())
                row = pa.array(row, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h, pa.int64()), part.column("_id").take(row), part.column("_t").take(row), pa.array(first, pa.int32()),
                     pa.array(n, pa.int32()), pa.array(pos, pa.binary())], names=["_h", "_id", "_t", "_first", "_n", "_pos"])

    schema = T.StructType([T.StructField("_h", T.LongType()), rows.schema["_id"], T.StructField("_t", T.LongType()),
                           T.StructField("_first", T.IntegerType()), T.StructField("_n", T.IntegerType()), T.StructField("_pos", T.BinaryType())])
    return rows.mapInArrow(run, schema)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, np.ndarray, np.ndarray, np.ndarray, bool]]:
    """Of each sorted batch: partition, hashes of its runs of equal hashes, their bounds, the documents that
    begin in each, and whether its first run goes on from the batch before."""
    edge = None
    for batch in batches:
        if not batch.num_rows:
            continue
        h, ids = batch.column("_h").to_numpy(), batch.column("_id")
        ends = np.flatnonzero(h[1:] != h[:-1]) + 1
        bounds = np.concatenate([[0], ends, [len(h)]])
        left, right = ids.slice(0, len(h) - 1), ids.slice(1)
        equal = pc.or_(pc.fill_null(pc.equal(left, right), False), pc.and_(pc.is_null(left), pc.is_null(right))).to_numpy(zero_copy_only=False)
        new = np.concatenate([[edge != (int(h[0]), ids[0].as_py())], (h[1:] != h[:-1]) | ~equal])
        yield (batch, batch.column("_part")[0].as_py(), h[bounds[:-1]], bounds, np.add.reduceat(new.astype(np.int64), bounds[:-1]),
               edge is not None and edge[0] == int(h[0]))
        edge = (int(h[-1]), ids[len(h) - 1].as_py())


def _borders(batches: Iterator[pa.RecordBatch], ids: bool = False) -> Iterator[pa.RecordBatch]:
    """part, h, n: the documents of the first and last run of a partition; two rows at most, however long they are.
    With ``ids`` also first and last: the ids of the first and the last row of each."""
    found: list[list] = []
    part = kind = None
    for batch, part, hashes, bounds, docs, goes_on in _runs(batches):
        column = batch.column("_id")
        kind = column.type
        if goes_on:
            found[-1][1] += int(docs[0])
            found[-1][3] = column[int(bounds[1]) - 1].as_py()
        for k in {0, len(hashes) - 1} - ({0} if goes_on else set()):
            found = [*found[:1], [int(hashes[k]), int(docs[k]), column[int(bounds[k])].as_py(), column[int(bounds[k + 1]) - 1].as_py()]]
    if found:
        h, n, first, last = zip(*found, strict=True)
        columns = {"part": pa.array([part] * len(found), pa.int32()), "h": pa.array(h, pa.int64()), "n": pa.array(n, pa.int64())}
        if ids:
            columns |= {"first": pa.array(first, kind), "last": pa.array(last, kind)}
        yield pa.RecordBatch.from_arrays([*columns.values()], names=[*columns])


def _neighbours(borders: list) -> dict[tuple[int, int], tuple[bool, int]]:
    """(part, hash) -> whether the run has rows in partitions before this one, and the documents it has in others
    alone, for runs of several partitions.  A document cut by a border (equal ids on both sides) counts once."""
    by_hash: dict[int, list[tuple]] = {}
    for part, h, n, first, last in borders:
        by_hash.setdefault(h, []).append((part, n, first, last))
    around = {}
    for h, found in by_hash.items():
        found.sort(key=lambda run: run[0])
        shared = sum(left[3] == right[2] for left, right in zip(found, found[1:], strict=False))
        total = sum(n for _, n, _, _ in found) - shared
        if len(found) > 1:
            around |= {(part, h): (i > 0, total - n) for i, (part, n, _, _) in enumerate(found)}
    return around


_NO_NEIGHBOUR = (False, 0)


class _Held:
    """Rows held back: at most ``most`` in memory, further ones in a temporary file of the task."""

    def __init__(self, most: int):
        self.most, self.rows, self.batches, self.file, self.writer = most, 0, [], None, None

    def add(self, rows: pa.RecordBatch) -> None:
        if self.rows + rows.num_rows <= self.most:
            self.batches.append(rows)
            self.rows += rows.num_rows
            return
        if self.file is None:
            self.file = tempfile.TemporaryFile()
            self.writer = pa.ipc.new_stream(self.file, rows.schema)
        self.writer.write_batch(rows)

    def take(self) -> Iterator[pa.RecordBatch]:
        yield from self.batches
        if self.file is not None:
            self.writer.close()
            self.file.seek(0)
            yield from pa.ipc.open_stream(self.file)

    def clear(self) -> None:
        if self.file is not None:
            self.writer.close()
            self.file.close()
        self.rows, self.batches, self.file, self.writer = 0, [], None, None


def _drop_frequent(batches, around: dict, min_docs: int, most_held: int = 100_000) -> Iterator[pa.RecordBatch]:
    """All rows of runs of ``min_docs`` documents.  What is held back of an open run has fewer documents than that,
    but with repeated ids any number of rows: beyond ``most_held`` they wait in a file."""
    held = _Held(most_held)
    docs_of_open = 0
    for batch, part, hashes, bounds, docs, goes_on in _runs(batches):
        totals = docs.copy()
        totals[0] += docs_of_open if goes_on else 0
        docs_of_open = int(totals[-1])
        if around:
            for k in {0, len(hashes) - 1}:
                totals[k] += around.get((part, int(hashes[k])), _NO_NEIGHBOUR)[1]
        if goes_on and totals[0] >= min_docs:
            yield from held.take()
        if not goes_on or len(hashes) > 1 or totals[0] >= min_docs:
            held.clear()
        rows = batch.select(["_id", "_t", "_pos"])
        goes = np.repeat(totals >= min_docs, np.diff(bounds))
        if goes.any():
            yield rows.filter(pa.array(goes))
        if totals[-1] < min_docs:
            held.add(rows.slice(int(bounds[-2])))


def _drop_repeats(batches, around: dict) -> Iterator[pa.RecordBatch]:
    """All occurrences but the first one of every run."""
    for batch, part, hashes, bounds, _, goes_on in _runs(batches):
        rows, first = batch.select(["_id", "_t", "_pos"]), bounds[:-1]
        if goes_on or around.get((part, int(hashes[0])), _NO_NEIGHBOUR)[0]:
            first = first[1:]
        later = np.ones(batch.num_rows, bool)
        later[first] = False
        yield rows.filter(pa.array(later))
        again = rows.take(pa.array(first[batch.column("_n").to_numpy()[first] > 1], pa.int64()))
        yield pa.RecordBatch.from_arrays([again.column("_id"), again.column("_t"), pa.array([p[4:] for p in again.column("_pos").to_pylist()], pa.binary())],
                                         names=["_id", "_t", "_pos"])


def dropped_lines(lines: DataFrame, min_docs: int = 10, policy: str = "frequent") -> DataFrame:
    """_id, _t, _pos of the lines that go.  ``lines`` is what ``line_table`` returns."""
    if policy not in ("frequent", "first"):
        raise ValueError(policy)
    order = ["_h", "_id", "_first", "_t"]
    sorted_lines = lines.repartitionByRange(*order).sortWithinPartitions(*order)
    held = saved(sorted_lines).withColumn("_part", F.spark_partition_id())
    schema = T.StructType([*T.StructType.fromDDL("part int, h long, n long").fields,
                           *(T.StructField(c, lines.schema["_id"].dataType) for c in ("first", "last"))])
    borders = held.select("_h", "_id", "_part").mapInArrow(lambda batches: _borders(batches, ids=True), schema).collect()  # two rows a partition
    shared = lines.sparkSession.sparkContext.broadcast(_neighbours(borders))

    def decide(batches):
        if policy == "first":
            return _drop_repeats(batches, shared.value)
        return _drop_frequent(batches, shared.value, min_docs)

    return held.mapInArrow(decide, lines.select("_id", "_t", "_pos").schema)


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 1, min_docs: int = 10,
                 policy: str = "frequent") -> DataFrame:
    """_id, _t and _drop (zlib-compressed bitmap, lowest bit first: set where the line goes) of each document
    that loses lines; a document without a row keeps all of its lines."""
    gone = dropped_lines(line_table(docs, id_col, text_col, min_chars), min_docs, policy)
    packed = gone.groupBy("_id", "_t").agg(F.collect_list("_pos").alias("_pos"))  # the lines of one document

    def pack(batches):
        for batch in batches:
            made = []
            for found in batch.column("_pos").to_pylist():
                where = np.unique(np.frombuffer(b"".join(found), "<u4"))
                bits = np.zeros(int(where[-1]) + 1, bool)
                bits[where] = True
                made.append(zlib.compress(np.packbits(bits, bitorder="little").tobytes()))
            yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("_t"), pa.array(made, pa.binary())], names=["_id", "_t", "_drop"])

    schema = T.StructType([*gone.select("_id", "_t").schema.fields, T.StructField("_drop", T.BinaryType())])
    return packed.mapInArrow(pack, schema)


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, value, fields: list[T.StructField], id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """``id_col`` and the fields that ``value(n_lines, kept_lines)`` returns, for every document."""
    rows = _with_hash(docs, id_col, text_col)
    marks = bitmaps.select(F.col("_id").alias("_i"), F.col("_t").alias("_k"), "_drop")
    joined = rows.join(marks, F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_t") == F.col("_k")), "left").select("_id", "_text", "_drop")
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), *fields])

    def run(batches):
        for batch in batches:
            for part in pieces(batch, "_text"):
                made = []
                for text, packed in zip(part.column("_text").to_pylist(), part.column("_drop").to_pylist(), strict=True):
                    lines = utf8(text).split(b"\n")
                    kept = lines
                    if packed is not None:
                        gone = np.unpackbits(np.frombuffer(zlib.decompress(packed), np.uint8), bitorder="little")[:len(lines)]
                        kept = [x for x, g in zip(lines, [*gone.tolist(), *[0] * (len(lines) - len(gone))], strict=True) if not g]
                    made.append(value(lines, kept))
                columns = zip(*made, strict=True) if made else [[] for _ in fields]
                yield pa.RecordBatch.from_arrays([part.column("_id"), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], names=schema.names)

    from pyspark.sql.pandas.types import to_arrow_type
    types = [to_arrow_type(f.dataType) for f in fields]
    return joined.mapInArrow(run, schema)


_ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS r FROM documents),
l AS (SELECT r, doc_id, generate_subscripts(ls, 1) AS pos, unnest(ls) AS line FROM (SELECT r, doc_id, string_split(t, chr(10)) AS ls FROM d)),
k AS (SELECT *, translate(regexp_replace(line, '^[ 	-
]+|[ 	-
]+$', '', 'g'),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
m AS (SELECT k.*, f.key IS NOT NULL AS gone FROM k LEFT JOIN f USING (key))
SELECT any_value(doc_id) AS doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY r
"""


@query("op9_line_dedup", _ORACLE)
def op9(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    fields = [T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType()), T.StructField("kept_sha256", T.StringType())]
    return apply_bitmaps(docs, keep_bitmaps(docs), lambda lines, kept: (len(lines), len(lines) - len(kept), hashlib.sha256(b"\n".join(kept)).hexdigest()), fields)
