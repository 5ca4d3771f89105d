"""A uniform shuffle into shards of exact sizes, through a hypergeometric communication matrix.

1. The rows are kept in their partitions (reliable checkpoint, so a lost executor can't change them)
   and counted: n_p rows in partition p.
2. The driver draws how many rows each partition sends to each shard: row p of the matrix is
   multivariate hypergeometric given what the shards can still take, so that rows sum to n_p and
   columns to the shard sizes, with the law that a uniform permutation of all rows would give.
   The driver holds partitions x shards counts, nothing that grows with the rows.
3. Each partition permutes its list of shard labels and deals its rows by it (local permutation).
4. Exchange; a second random order within each shard gives the slots.  A shard isn't sorted by one
   task: random keys cut it into blocks, blocks are counted, and a block is ordered on its own.

Edge cases: a null text has size 8 and the CRC of no bytes; equal rows are dealt one by one; with
fewer rows than shards some shards stay empty; no rows give no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import documents, packed, saved
from .registry import query

SEED = 77_041


def draw_hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """Successes in n draws without replacement, by inversion over the mode +- 40 standard deviations
    (numpy's own generator ends at 10^9 items, which a corpus can pass)."""
    low, high = max(0, n - bad), min(n, good)
    if low == high:
        return low
    total = good + bad
    mode = min(high, max(low, (n + 1) * (good + 1) // (total + 2)))
    spread = 20 + int(40 * math.sqrt(n * (good / total) * (bad / total) * (total - n) / max(1, total - 1)))
    first, last = max(low, mode - spread), min(high, mode + spread)
    k = np.arange(first, last, dtype=np.float64)
    steps = np.log(good - k) + np.log(n - k) - np.log(k + 1) - np.log(bad - n + k + 1)
    logs = np.concatenate([[0.0], np.cumsum(steps)])
    mass = np.cumsum(np.exp(logs - logs.max()))
    return first + int(np.searchsorted(mass, rng.random() * mass[-1], side="right").clip(0, last - first))


def communication_matrix(sizes: list[int], n_shards: int, seed: int = SEED) -> np.ndarray:
    """Counts[partition, shard] for partitions of these sizes; shard sizes differ by one at most."""
    rng = np.random.default_rng(seed)
    total = sum(sizes)
    room = [total // n_shards + (j < total % n_shards) for j in range(n_shards)]
    matrix = np.zeros((len(sizes), n_shards), dtype=np.int64)
    for p, n in enumerate(sizes):
        others = sum(room)
        for j in range(n_shards):
            others -= room[j]
            matrix[p, j] = take = draw_hypergeometric(rng, room[j], others, n)
            room[j] -= take
            n -= take
    return matrix


def shuffle_into_shards(df: DataFrame, n_shards: int = 24, seed: int = SEED, block_rows: int = 50_000) -> DataFrame:
    """The rows of ``df`` with shard (int) and slot (long, gapless from 0 within the shard).  Input columns
    of these names are replaced.  The rows are checkpointed once: pass keys, or whole rows to write."""
    held = saved(packed(df.drop("shard", "slot"))).withColumn("_part", F.spark_partition_id())
    sizes = {r["_part"]: r["n"] for r in held.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a partition
    parts = sorted(sizes)
    total = sum(sizes.values())
    matrix = dict(zip(parts, communication_matrix([sizes[p] for p in parts], n_shards, seed), strict=True))
    blocks = max(1, math.ceil(total / n_shards / block_rows))
    shared = df.sparkSession.sparkContext.broadcast(matrix)

    def deal(batches):
        labels, at, keys = None, 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            if labels is None:
                part = batch.column("_part")[0].as_py()
                labels = np.repeat(np.arange(n_shards, dtype=np.int32), shared.value[part])
                np.random.default_rng([seed, 1, part]).shuffle(labels)
                keys = np.random.default_rng([seed, 2, part])
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(labels[at:at + n]), pa.array(keys.integers(0, 1 << 62, n)), pa.array(np.arange(at, at + n))],
                names=[*batch.schema.names, "shard", "_key", "_at"])
            at += n

    schema = T.StructType([*held.schema.fields, T.StructField("shard", T.IntegerType()), T.StructField("_key", T.LongType()),
                           T.StructField("_at", T.LongType())])
    dealt = held.mapInArrow(deal, schema).withColumn("_block", F.floor(F.col("_key") / F.lit(float(1 << 62)) * blocks).cast("int"))
    counts = dealt.groupBy("shard", "_block").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("shard").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    order = Window.partitionBy("shard", "_block").orderBy("_key", "_part", "_at")
    placed = dealt.join(starts, ["shard", "_block"]).withColumn("slot", (F.col("_start") + F.row_number().over(order) - 1).cast("long"))
    return placed.select("_row.*", "shard", "slot")


def write_shards(sharded: DataFrame, path: str, format: str = "parquet") -> None:  # noqa: A002 - as in DataFrameWriter
    """The shards as folders shard=0, shard=1, ..., each in slot order over its files."""
    ordered = sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    ordered.write.partitionBy("shard").format(format).save(path)


@query("op5_hypergeometric_shards")
def op5(spark, sf_dir):
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    keys = documents(spark, sf_dir).select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    return shuffle_into_shards(keys, 24).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
