"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import written


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, whole."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame) -> DataFrame:
    """``df`` with its lineage cut: written once as Parquet below ``spark.checkpoint.dir`` and read back.

    A written table is computed once (``checkpoint`` runs a plan twice) and survives lost executors.  The folder
    belongs to whoever set ``spark.checkpoint.dir`` and is cleared by them."""
    return written(df, "llm")


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of plans that nothing refers to any more: it does so only when the driver's
    JVM collects garbage, which a driver with free memory may leave for as long as the disk takes to fill."""
    spark.range(1).write.format("noop").mode("overwrite").save()     # the last query is still referred to until the next
    gc.collect()
    spark.sparkContext._jvm.System.gc()


# What workers keep of an operator's words for its later tasks, by module name.
WORD_CACHES = ("_tessera_encoders", "_tessera_codecs", "_tessera_aligners")


def lean(run, keeps: str = ""):
    """The task function ``run`` of a ``mapInArrow`` for workers that go on to other operators' tasks: the words that
    another operator than ``keeps`` left in the worker go first, and freed memory goes back to the system at the end."""
    def task(batches):
        import ctypes
        import sys

        import pyarrow as pa

        for name in WORD_CACHES:
            if name != keeps:
                sys.modules.pop(name, None)
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):       # glibc only
                libc.malloc_trim(0)

    return task


def key_filter(keys: DataFrame, column: str, bits: int = 23):
    """A broadcast bitmap of fixed size (2**bits bits) that holds every value of a column of 64-bit hashes (placed by
    its low bits); see ``may_hold``.

    It lets a map over texts leave out rows that no key wants before they are shuffled.  It can let through others,
    never hold one back, and its size does not grow with the input."""
    import numpy as np

    at = F.col(column).bitwiseAND((1 << bits) - 1)
    bit = F.expr("shiftleft(1L, cast(_at & 63 as int))")
    got = (keys.select(at.alias("_at")).select(F.shiftright("_at", 6).alias("w"), bit.alias("b"))
           .groupBy("w").agg(F.expr("bit_or(b)").alias("b")).toArrow())
    out = np.zeros(1 << (bits - 6), dtype=np.int64)
    out[got.column(0).to_numpy()] = got.column(1).to_numpy()
    return keys.sparkSession.sparkContext.broadcast(out)


def may_hold(bitmap, keys):
    """Which of ``keys`` (int64 array of well-mixed hashes) the bitmap of ``key_filter`` may hold."""
    import numpy as np

    at = keys & np.int64(64 * len(bitmap) - 1)
    return (bitmap[at >> 6] >> (at & 63)) & 1 == 1


def holds(keys: DataFrame, column: str, bits: int = 23):
    """The bitmap of ``key_filter`` as a SQL expression: a function from a Column of 64-bit hashes to whether the bitmap
    may hold it.  The bitmap is one written row of 2**(bits - 6) longs, read as a scalar subquery."""
    at = F.col(column).bitwiseAND((1 << bits) - 1)
    word = (keys.select(at.alias("_at")).select(F.shiftright("_at", 6).alias("w"), F.expr("shiftleft(1L, cast(_at & 63 as int))").alias("b"))
            .groupBy("w").agg(F.expr("bit_or(b)").alias("b")))
    every = keys.sparkSession.range(1 << (bits - 6)).withColumnRenamed("id", "w").join(word, "w", "left")
    row = saved(every.agg(F.array_sort(F.collect_list(F.struct("w", F.coalesce("b", F.lit(0).cast("long")).alias("b"))))["b"].alias("words")))

    def test(key: Column) -> Column:
        low = key.bitwiseAND((1 << bits) - 1)
        return F.getbit(F.get(row.scalar(), F.shiftright(low, 6).cast("int")), low.bitwiseAND(63).cast("int")) == 1

    return test


def text_key(text: Column) -> Column:
    """64-bit key of a text; a null text has the key of an empty one."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def wide_key(text: Column) -> Column:
    """128-bit key of a text, for joins that take equal keys as equal texts."""
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(7919), text).alias("b"))


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node of each node's component, for every node of ``edges``.

    Alternating large-star / small-star contraction: each round is two partial aggregations and two equi-joins, the
    edge set never grows beyond the input and ends as stars around each component's smallest node.  No group is
    collected: a hub's edges are only joined with one minimum per node, and AQE splits a skewed join partition.
    Each round is checkpointed, so a lost executor costs one round.  Rows with a null end and loops are ignored; an
    empty input gives an empty result.
    """
    u, v = F.col(a), F.col(b)
    e = (edges.where(u.isNotNull() & v.isNotNull() & (u != v))
         .select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct())
    e, before = saved(e), None
    for _ in range(max_rounds):
        now = e.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))"), F.expr("bit_xor(xxhash64(v, u, 1))")).first()
        if now[0] == 0 or now == before:
            break
        before = now
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.join(low, "u").where(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low2, "u").where(F.col("v") != F.col("m"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")))
        e = saved(small.unionAll(low2.select("u", F.col("m").alias("v"))).distinct())
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots).distinct()
