"""Small helpers the text operators share.

Conventions of every operator in this folder:

* it takes a DataFrame and the names of the columns it reads (``id_col``, ``text_col``, ...), and
  selects only those, so further columns, whatever their names, can't clash with its own;
* a null text counts as an empty one;
* a row is a document: repeated rows give repeated results unless the docstring says otherwise;
* an empty table gives an empty result with the same columns.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, shared_dir  # noqa: F401 - re-exported

#: Java regular expression of one word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: The ASCII white space bytes, which are also those that ``bytes.split()`` and ``bytes.strip()`` use.
SPACE = b" \t\n\x0b\x0c\r"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def saved(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared checkpoint folder (survives lost executors)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def utf8(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def pieces(batch: pa.RecordBatch, column: str, most_bytes: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``most_bytes`` of text each (one row at least), in order."""
    start, held = 0, 0
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    for i, n in enumerate(lengths):
        if held and held + n > most_bytes:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < batch.num_rows:
        yield batch.slice(start)


def map_texts(df: DataFrame, text_col: str, fn: Callable[[list[str | None]], list[pa.Array]], schema: str,
              keep: list[str]) -> DataFrame:
    """One row per row of ``df``: the columns ``keep`` as they are and those that ``fn`` computes from
    a list of texts (arrays in the order of ``schema``).  The texts themselves aren't returned."""
    from pyspark.sql.types import StructType
    columns = list(dict.fromkeys([*keep, text_col]))
    out = StructType([*df.select(*keep).schema.fields, *StructType.fromDDL(schema).fields])
    names = out.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, text_col):
                made = fn(part.column(text_col).to_pylist())
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), *made], names=names)

    return df.select(*columns).mapInArrow(run, out)


def uniform(seed: int, *columns) -> F.Column:
    """A number in (0, 1) that depends on the seed and the columns' values alone (52 bits of an MD5),
    so that reruns agree and another SQL engine can compute the same."""
    parts = [F.lit(str(seed)), *(F.coalesce(c.cast("string"), F.lit("~")) for c in columns)]
    digits = F.substring(F.md5(F.concat_ws("|", *parts).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 52))


def packed(df: DataFrame, **named: str) -> DataFrame:
    """All columns of ``df`` in one struct, _row, and the named columns beside it: nothing an operator adds can clash."""
    return df.select(F.struct(*[df[c] for c in df.columns]).alias("_row"), *[df[c].alias(name) for name, c in named.items()])


def text_key(text: F.Column) -> F.Column:
    """A hash of a text that tells rows with one id but different texts apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def bounded(df: DataFrame, most: int) -> DataFrame:
    """A saved table marked for broadcast if it has no more rows than ``most``; else the join shuffles."""
    return F.broadcast(df) if df.count() <= most else df


def without(docs: DataFrame, gone: DataFrame, id_col: str, text_col: str, most: int = 200_000) -> DataFrame:
    """The rows of ``docs`` whose id and text key are not in ``gone`` (columns _id and _t), unchanged."""
    gone = bounded(saved(gone.select("_id", "_t").distinct()), most)
    return docs.join(gone, docs[id_col].eqNullSafe(gone["_id"]) & (text_key(docs[text_col]) == gone["_t"]), "left_anti")


def sampled_labels(labels: DataFrame, label: str, most: int, id_col: str = "doc_id") -> DataFrame:
    """At most ``most`` labelled rows (_id, _label) of the training part: those whose CRC-32 of the id as text isn't
    divisible by 5.  A hash of the id decides which, so reruns agree."""
    rows = labels.select(F.col(id_col).alias("_id"), F.col(label).cast("int").alias("_label")).filter("_id is not null and _label is not null")
    return rows.filter(~held_out(F.col("_id"))).groupBy("_id").agg(F.max("_label").alias("_label")).orderBy(F.xxhash64("_id"), "_id").limit(most)


def held_out(id_col: F.Column) -> F.Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))
