"""Building blocks shared by the operators: ordered string aggregation and size-checked broadcast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written

# Rows below which a side is broadcast.  The check reads at most this many rows plus one.
BROADCAST_MAX_ROWS = 200_000


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast ``df`` only when it provably has at most ``max_rows`` rows; otherwise leave it to a shuffle join
    (with AQE skew handling).  The probe is ``limit(max_rows + 1).count()``, so it never scans more than that."""
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def spread(df: DataFrame, factor: int = 2) -> DataFrame:
    """Round-robin an input that has fewer partitions than the cluster has cores (times ``factor``) before heavy
    per-row work such as tokenising.  A large scan already has many more partitions than cores, so at scale this
    returns ``df`` unchanged and adds no shuffle."""
    try:
        target = df.sparkSession.sparkContext.defaultParallelism * factor
        parts = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - sessions without RDD access: leave the input as it is
        return df
    return df.repartition(target) if parts < target else df


def _sorted_join(pairs: Column, sep: str) -> Column:
    return F.array_join(F.transform(F.array_sort(pairs), lambda x: x["piece"]), sep)


def ordered_concat(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], piece: Column,
                   out: str, sep: str = "", chunk_rows: int = 4096, chunk_on: int = -1) -> DataFrame:
    """One string per group: ``piece`` values joined by ``sep`` in ``order``.

    Two-level aggregation so that a hot group never sorts all its rows in one buffer: rows are first concatenated per
    (group, chunk) where the chunk is ``order[chunk_on] div chunk_rows`` (a numeric order column; the order columns
    before it are part of the chunk key, those after it only sort inside a chunk), then the few chunk strings of a
    group are joined in chunk order.  Both levels use partial aggregation.
    """
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    at = chunk_on % len(order_cols)
    lead, bucket = order_cols[:at], order_cols[at]
    chunk_fields = [c.alias(f"_c{i}") for i, c in enumerate(lead)] + [
        F.floor(bucket / F.lit(chunk_rows)).alias(f"_c{len(lead)}")]
    sort_fields = [c.alias(f"_o{i}") for i, c in enumerate(order_cols)]
    staged = df.select(*keys, F.struct(*chunk_fields).alias("_chunk"),
                       F.struct(*sort_fields, piece.alias("piece")).alias("_p"))
    level1 = (staged.groupBy(*keys, "_chunk")
              .agg(_sorted_join(F.collect_list("_p"), sep).alias("piece")))
    level2 = (level1.groupBy(*keys)
              .agg(_sorted_join(F.collect_list(F.struct(F.col("_chunk").alias("_o"), F.col("piece"))), sep)
                   .alias(out)))
    return level2


def fill_template(template: str, **cols: Column) -> Column:
    """``template.format(**cols)`` as a Column; fields must be plain ``{name}``."""
    import re

    parts: list[Column] = []
    pos = 0
    for m in re.finditer(r"\{(\w+)\}", template):
        if m.start() > pos:
            parts.append(F.lit(template[pos:m.start()]))
        parts.append(cols[m.group(1)].cast("string"))
        pos = m.end()
    if pos < len(template):
        parts.append(F.lit(template[pos:]))
    return F.concat(*parts) if len(parts) > 1 else parts[0]


def ordinal_within(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "ordinal",
                   partitions: int | None = None) -> DataFrame:
    """``row_number() over (partition by keys order by order)`` (1-based) without putting a key's rows in one task.

    Rows are dealt by range of ``keys + order`` and every partition's number becomes a column of the written rows,
    so each (key, bucket) group is numbered by a plain window over one partition's share of a key; a prefix sum of the
    groups' row counts (one row per key and bucket, summed by a window per key) gives the rows before each bucket.
    Only JVM operators are used.  Null keys form one group, payload columns pass unchanged, and rows equal in ``keys``
    and ``order`` are numbered in an arbitrary order; the rows are written before they are numbered, so a recomputed
    task numbers the same rows.  ``keys`` may be empty: the whole input is numbered.
    """
    keys, order = list(keys), list(order)
    n = partitions or max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    dealt = written(df.repartitionByRange(n, *keys, *order).withColumn("_bucket", F.spark_partition_id()))
    numbered = dealt.withColumn("_local", F.row_number().over(Window.partitionBy(*keys, "_bucket").orderBy(*order)))
    counts = dealt.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    before = (counts.withColumn("_off", F.coalesce(F.sum("_rows").over(
                  Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .select("_bucket", "_off", *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]))
    cond = F.col("_bucket") == F.col("_b")
    for i, k in enumerate(keys):
        cond = cond & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    joined = numbered.join(before.withColumnRenamed("_bucket", "_b"), cond)
    return joined.select(*df.columns, (F.col("_local") + F.col("_off")).alias(out))


def row_number_within(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "ordinal") -> DataFrame:
    """1-based ``row_number`` per key; the same path for every group size (see ``ordinal_within``)."""
    return ordinal_within(df, keys, order, out)
