"""Data-quality audit and consolidation.

Audits are aggregates: every count is a distributed ``agg`` and the results
are one-row frames, never Python loops over collected rows.  Key-set audits
use anti/semi joins, which Spark plans as broadcast joins when the register
is small and as shuffle joins otherwise (AQE decides from runtime sizes).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F


def date_range_filter(df: DataFrame, date_col: str, start: dt.date, end: dt.date) -> DataFrame:
    """Rows with ``start <= date < end + 1 day`` (half-open, so times on the
    last day are kept; trap R18).  A missing column raises (the reference
    silently returns None)."""
    if date_col not in df.columns:
        raise ValueError(f"column {date_col!r} not found")
    d = F.col(date_col)
    return df.where((d >= F.lit(start)) & (d < F.date_add(F.lit(end), 1)))


def date_range_audit(df: DataFrame, date_col: str, start: dt.date, end: dt.date) -> DataFrame:
    """One row: min/max date, rows, rows kept, rows dropped (null dates count as dropped) (F1)."""
    d = F.col(date_col)
    inside = (d >= F.lit(start)) & (d < F.date_add(F.lit(end), 1))
    return df.agg(F.min(d).alias("min_date"), F.max(d).alias("max_date"), F.count(F.lit(1)).alias("rows"),
                  F.count_if(F.coalesce(inside, F.lit(False))).alias("rows_in_range"),
                  F.count_if(~F.coalesce(inside, F.lit(False))).alias("rows_dropped"))


def dedup(df: DataFrame, subset: list[str]) -> DataFrame:
    """One row per ``subset`` value, keeping the smallest remaining tuple.

    "Keep first" on file order is not reproducible on a cluster (trap R19);
    the smallest tuple of the other columns is a total, deterministic order.
    Copies are merged on the map side by a hash aggregate of each column's
    minimum, maximum and count.  Where these agree, the group has one tuple.
    Only the rows of the other groups (found by a second scan) go through
    ``min`` of a struct, which sorts.
    """
    others = [c for c in df.columns if c not in subset]
    if not others:
        return df.dropDuplicates(subset)
    found = df.groupBy(*subset).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.min(c).alias(c) for c in others], *[F.max(c).alias(f"_max_{c}") for c in others],
        *[F.count(c).alias(f"_n_{c}") for c in others])
    one = F.lit(True)
    for c in others:
        one = one & F.col(c).eqNullSafe(F.col(f"_max_{c}")) & F.col(f"_n_{c}").isin(F.lit(0), F.col("_rows"))
    single = found.where(one).select(*df.columns)
    differ = found.where(~one).select(*[F.col(c).alias(f"_key_{c}") for c in subset])
    same_key = F.lit(True)
    for c in subset:
        same_key = same_key & df[c].eqNullSafe(differ[f"_key_{c}"])
    least = (df.join(differ, same_key, "left_semi").groupBy(*subset).agg(F.min(F.struct(*others)).alias("_keep"))
             .select(*subset, *[F.col(f"_keep.{c}").alias(c) for c in others]).select(*df.columns))
    return single.unionByName(least)


def dedup_counts(df: DataFrame, subset: list[str]) -> DataFrame:
    """One row: rows before, rows after, rows removed by ``dedup`` on ``subset`` (D1, A8), from one scan."""
    groups = df.groupBy(*subset).agg(F.count(F.lit(1)).alias("_n"))
    return (groups.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("rows_before"), F.count(F.lit(1)).alias("rows_after"))
            .withColumn("removed", F.col("rows_before") - F.col("rows_after")))


def first_per_key(df: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """One attribute row per key (D2): the smallest attribute tuple, deterministic.
    Distinct tuples come first (a hash aggregate), so the sort of ``min`` of a struct sees few rows."""
    return (df.where(F.col(key).isNotNull()).select(key, *cols).distinct().groupBy(key).agg(F.min(F.struct(*cols)).alias("_a"))
              .select(key, *[F.col(f"_a.{c}").alias(c) for c in cols]))


def enrich(sales: DataFrame, register: DataFrame, key: str = "store_id", how: str = "left") -> DataFrame:
    """Transactions joined to a register on the key (J1 left, J2 inner).

    Rows without a key match nothing: an inner join drops them first, a left join
    spreads them over reducers by a second join column (0 on rows with a key)."""
    if how == "inner":
        return sales.where(F.col(key).isNotNull()).join(register, key, how)
    others = [c for c in sales.columns if c != key]
    spread = F.when(F.col(key).isNull(), F.pmod(F.xxhash64(*others), F.lit(997)) + 1).otherwise(F.lit(0)).cast("long")
    return (sales.withColumn("_spread", spread).join(register.withColumn("_spread", F.lit(0).cast("long")), [key, "_spread"], how)
            .drop("_spread"))


def orphan_keys(sales: DataFrame, register: DataFrame, key: str = "store_id") -> DataFrame:
    """Distinct keys of the transactions that the register lacks."""
    return sales.select(key).where(F.col(key).isNotNull()).distinct().join(register.select(key), key, "left_anti")


def orphan_impact(sales: DataFrame, register: DataFrame, key: str = "store_id",
                  qty: str = "quantity") -> DataFrame:
    """One row: orphan keys, units and rows of orphan keys and their shares.

    Transactions are first reduced to one row per key (rows, units) with a
    partial aggregate, so the join with the register moves one row per key,
    never the raw rows of a hot store.
    """
    per_key = sales.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"), F.sum(qty).alias("_units"))
    reg = register.select(key).distinct().withColumn("_known", F.lit(True))
    flagged = per_key.join(reg, key, "left").withColumn(
        "_orphan", F.col(key).isNotNull() & F.col("_known").isNull())
    o = F.col("_orphan")
    out = flagged.agg(
        F.count_if(o).alias("orphan_keys"),
        F.coalesce(F.sum(F.when(o, F.col("_units"))), F.lit(0.0)).alias("orphan_units"),
        F.coalesce(F.sum("_units"), F.lit(0.0)).alias("total_units"),
        F.coalesce(F.sum(F.when(o, F.col("_rows"))), F.lit(0)).alias("orphan_rows"),
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("total_rows"))
    return out.withColumns({
        "pct_units": F.lit(100.0) * F.try_divide(F.col("orphan_units"), F.col("total_units")),
        "pct_rows": F.lit(100.0) * F.try_divide(F.col("orphan_rows"), F.col("total_rows")),
    })


def key_set_audit(sales: DataFrame, register: DataFrame, key: str = "store_id",
                  register_key: str | None = None) -> DataFrame:
    """One row: |keys in transactions|, |keys in register|, |transaction keys - register keys| (O2)."""
    rk = register_key or key
    a = sales.select(F.col(key).alias("_k"), F.lit(1).alias("_a"), F.lit(0).alias("_b"))
    b = register.select(F.col(rk).alias("_k"), F.lit(0).alias("_a"), F.lit(1).alias("_b"))
    keys = a.unionByName(b).where(F.col("_k").isNotNull()).groupBy("_k").agg(F.max("_a").alias("_a"), F.max("_b").alias("_b"))
    return keys.agg(F.count_if(F.col("_a") == 1).alias("keys_in_sales"), F.count_if(F.col("_b") == 1).alias("keys_in_register"),
                    F.count_if((F.col("_a") == 1) & (F.col("_b") == 0)).alias("keys_without_register"))


def profile(df: DataFrame, date_col: str = "txn_date", store: str = "store_id",
            product: str = "product_id") -> DataFrame:
    """One row: date range, row count, exact distinct stores/products and a null
    count for every column (A2, D4)."""
    aggs = [F.min(date_col).alias("min_date"), F.max(date_col).alias("max_date"),
            F.count(F.lit(1)).alias("rows"),
            F.count_distinct(store).alias("distinct_stores"),
            F.count_distinct(product).alias("distinct_products")]
    aggs += [F.count_if(F.col(f"`{c}`").isNull()).alias(f"nulls_{c}") for c in df.columns]
    return df.agg(*aggs)


def distinct_sketches(df: DataFrame, by: list[str | Column], columns: list[str], lg_k: int = 12) -> DataFrame:
    """A row per group of ``by`` with its row count and a HyperLogLog sketch (``2^lg_k`` registers) of each column.

    Sketches merge: those of new months are added to a stored table and ``distinct_estimates`` reads the sketches
    alone.  Nulls don't count.  Unlike exact distinct counts, nothing is expanded and each task ships a few KB a group.
    """
    sketches = [F.hll_sketch_agg(F.col(c).cast("string"), F.lit(lg_k)).alias(f"sketch_{c}") for c in columns]
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), *sketches)


def distinct_estimates(sketches: DataFrame, columns: list[str]) -> DataFrame:
    """One row: rows and estimated distinct values of each column over all groups of ``distinct_sketches``."""
    union = [F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(f"sketch_{c}")), F.lit(0)).alias(f"approx_{c}") for c in columns]
    return sketches.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), *union)


def sketch_error(lg_k: int = 12) -> float:
    """Relative error that an estimate exceeds about once in 15,000 (four standard errors of 1.04 / sqrt(2^lg_k))."""
    return 4 * 1.04 / 2 ** (lg_k / 2)


def table_shapes(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: name, rows, columns, column list."""
    parts = []
    for name, df in tables.items():
        parts.append(df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table_name"), "rows", F.lit(len(df.columns)).cast("long").alias("n_columns"),
            F.lit(",".join(df.columns)).alias("columns")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def sample_rows(df: DataFrame, key: list[str], fraction: float = 0.1, seed: int = 42) -> DataFrame:
    """A sample of about ``fraction`` of the rows (S7): those whose hash of seed and key falls below it.
    It doesn't depend on how rows lie in partitions, so reruns agree; rows with equal keys go together."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in key])
    return df.where(F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long") < F.lit(fraction * 4294967296))
