"""Vector search: exact over tiles for any number of queries, and approximate over an index partitioned by cell.

Scores are dot products of unit vectors in double precision.
"""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import dot
from ..session import written

# Functions of this module travel to executors by value, so tasks need no copy of it on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_BYTES = 64 << 20      # query vectors of one pass over the items, as doubles
TILE_ROWS = 1024            # vectors of a tile, of items and of queries
MAX_CELLS = 4096            # cells of an index; their pivots are broadcast
SAMPLE_QUERIES = 200        # queries that measure how many cells to probe


# --------------------------------------------------------------------------------------------------------- exact search
def query_blocks(queries: DataFrame, query_id: str, vec_col: str, block_bytes: int = BLOCK_BYTES):
    """The queries as (ids, matrix) in blocks of about ``block_bytes``; similar queries stand together.

    Null vectors are left out.  Each block is collected when its turn comes, so the driver holds one."""
    kept = written(queries.where(F.col(vec_col).isNotNull()).select(F.col(query_id).alias("_q"), F.col(vec_col).cast("array<double>").alias("_v")), "queries")
    n, dim, least = kept.agg(F.count(F.lit(1)), F.max(F.size("_v")), F.min(F.size("_v"))).first()
    if n and dim != least:
        raise ValueError("query vectors of different dimensions")
    blocks = -(-n * 8 * max(dim or 1, 1) // block_bytes)
    place = F.pmod(F.xxhash64(F.col("_q").cast("string")), F.lit(max(blocks, 1)))
    for k in range(blocks):
        got = kept.where(place == k).toArrow()
        if not got.num_rows:
            continue
        ids = got.column(0).to_pandas().to_numpy()
        matrix = got.column(1).combine_chunks().flatten().to_numpy().reshape(-1, dim)
        if len(ids) > TILE_ROWS:        # tiles of queries that are nearest to the same one of some of them
            some = matrix[np.linspace(0, len(ids) - 1, min(256, len(ids) // TILE_ROWS * 4), dtype=int)]
            near = np.concatenate([(matrix[i:i + 8192] @ some.T).argmax(axis=1) for i in range(0, len(ids), 8192)])
            order = np.argsort(near, kind="stable")
            ids, matrix = ids[order], matrix[order]
        yield ids, matrix


def ball(vectors):
    """Centre and radius of a ball that holds all ``vectors``."""
    centre = vectors.mean(axis=0)
    return centre, float(np.sqrt(((vectors - centre) ** 2).sum(axis=1).max()))


def highest_score(a, b) -> float:
    """No dot product between vectors of two balls is higher."""
    (c, r), (d, s) = a, b
    return float(c @ d) + r * float(np.sqrt(d @ d)) + s * float(np.sqrt(c @ c)) + r * s + 1e-9


def tile_scores(items: DataFrame, queries: DataFrame, threshold: float | None = None, k: int | None = None,
                item_id: str = "doc_id", query_id: str = "query_id", vec_col: str = "embedding",
                block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(query_id, item_id, score) of the pairs that reach ``threshold`` and, with ``k``, may be among a query's k best.

    Queries x items is dealt to tiles: the queries go out in blocks of bounded size, one pass over the items for each,
    and a task multiplies tiles of items with tiles of queries.  A tile pair whose balls cannot reach the threshold, or
    the k-th best score that the task has found for each of the tile's queries, is left out.  Ties with a k-th best score
    are all kept.  Items without a vector or of another dimension than the queries have no score; an item table without
    rows is an error (nothing is indexed); without queries there are no rows."""
    if items.isEmpty():
        raise ValueError("No documents indexed yet.")
    kinds = [x.schema[c].dataType.simpleString() for x, c in ((queries, query_id), (items, item_id))]
    schema = f"`{query_id}` {kinds[0]}, `{item_id}` {kinds[1]}, score double"
    out = None
    for ids, matrix in query_blocks(queries, query_id, vec_col, block_bytes):
        shared = items.sparkSession.sparkContext.broadcast((ids, matrix))
        dim = matrix.shape[1]
        usable = items.select(F.col(item_id).alias("_i"), F.col(vec_col).alias("_v")).where(F.col("_v").isNotNull() & (F.size("_v") == dim))

        def run(batches, shared=shared, dim=dim):
            import pandas as pd

            ids, matrix = shared.value
            tiles = [slice(a, min(a + TILE_ROWS, len(ids))) for a in range(0, len(ids), TILE_ROWS)]
            balls = [ball(matrix[t]) for t in tiles]
            best = None if k is None else np.full((len(ids), k), -np.inf)
            for batch in batches:
                names, flat = batch["_i"].to_numpy(), batch["_v"].to_numpy()
                for at in range(0, len(names), TILE_ROWS):
                    own = np.vstack(flat[at:at + TILE_ROWS]).astype(np.float64)
                    around = ball(own)
                    for tile, there in zip(tiles, balls, strict=True):
                        least = -np.inf if threshold is None else threshold
                        if k is not None:
                            least = max(least, best[tile, -1].min())
                        if highest_score(around, there) < least:
                            continue
                        scores = own @ matrix[tile].T
                        keep = np.ones(scores.shape, bool) if threshold is None else scores >= threshold
                        if k is not None:
                            top = -np.partition(-scores, min(k, len(own)) - 1, axis=0)[:k].T
                            best[tile] = -np.sort(-np.concatenate((best[tile], top), axis=1), axis=1)[:, :k]
                            keep &= scores >= best[tile, -1]
                        i, q = np.nonzero(keep)
                        if len(i):
                            yield pd.DataFrame({query_id: ids[tile][q], item_id: names[at:at + TILE_ROWS][i], "score": scores[i, q]})

        part = usable.mapInPandas(run, schema)
        out = part if out is None else out.unionAll(part)
    return items.sparkSession.createDataFrame([], schema) if out is None else out


def best_k(scored: DataFrame, k: int, item_id: str, query_id: str) -> DataFrame:
    """The ``k`` best rows of every query with ``rank``, ties by item id, score rounded to 6 places."""
    w = Window.partitionBy(query_id).orderBy(F.col("score").desc(), F.col(item_id))
    return (scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select(query_id, "rank", item_id, F.round("score", 6).alias("score")))


# -------------------------------------------------------------------------------------------------------- cell index
def pivots_of(items: DataFrame, cells: int, item_id: str, vec_col: str) -> DataFrame:
    """(cell, pivot): the vectors of the ``cells`` items with the smallest md5 of their id, numbered from 0."""
    if not 0 < cells <= MAX_CELLS:
        raise ValueError(f"an index has 1 to {MAX_CELLS} cells")
    rows = (items.where(F.col(vec_col).isNotNull()).select(F.md5(F.col(item_id).cast("string").cast("binary")).alias("_h"), F.col(vec_col).cast("array<double>").alias("pivot"))
            .orderBy("_h").limit(cells))
    number = F.row_number().over(Window.orderBy("_h")) - 1
    return rows.select(number.alias("cell"), "pivot")


def _nearest(rows: DataFrame, pivots, vec_col: str, n: int) -> DataFrame:
    """``rows`` with ``near``: the numbers of the ``n`` nearest pivots, best first, ties by number.  ``pivots`` is a
    broadcast matrix of at most MAX_CELLS rows."""
    from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

    schema = StructType([*rows.schema, StructField("near", ArrayType(IntegerType()))])

    def run(batches):
        import pyarrow as pa

        matrix = pivots.value
        for batch in batches:
            for at in range(0, batch.num_rows, TILE_ROWS):
                part = batch.slice(at, TILE_ROWS)
                vectors = np.vstack([v.values.to_numpy(zero_copy_only=False) for v in part.column(vec_col)]).astype(np.float64)
                scores = vectors @ matrix.T
                near = np.argsort(-scores, axis=1, kind="stable")[:, :n] if n > 1 else scores.argmax(axis=1)[:, None]
                listed = pa.ListArray.from_arrays(np.arange(0, near.size + 1, near.shape[1], dtype=np.int32), pa.array(near.ravel().astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*part.columns, listed], names=[*part.schema.names, "near"])

    return rows.mapInArrow(run, schema)


def write_cells(items: DataFrame, path: str, cells: int | None = None, item_id: str = "doc_id", vec_col: str = "embedding") -> None:
    """Persist an index under ``path``: ``vectors`` partitioned by cell (the nearest pivot of each vector) and ``pivots``.

    ``cells`` is sqrt(items) by default, MAX_CELLS at most.  Every vector is indexed; null vectors are left out and
    vectors of different dimensions are an error.  Rows are rebalanced by cell, so
    a cell that holds many vectors is written by several tasks."""
    n, dim, least = items.where(F.col(vec_col).isNotNull()).agg(F.count(F.lit(1)), F.max(F.size(vec_col)), F.min(F.size(vec_col))).first()
    if not n:
        raise ValueError("No documents indexed yet.")
    if dim != least:
        raise ValueError("vectors of different dimensions in one index")
    spark = items.sparkSession
    pivots = pivots_of(items, cells or min(MAX_CELLS, max(1, round(n ** 0.5))), item_id, vec_col)
    pivots.write.mode("overwrite").parquet(f"{path}/pivots")
    rows = items.where(F.col(vec_col).isNotNull()).select(F.col(item_id).alias("item"), F.col(vec_col).alias("vector"))
    near = _nearest(rows, _pivot_matrix(spark, path), "vector", 1)
    (near.select("item", "vector", F.col("near")[0].alias("cell")).hint("rebalance", "cell")
     .write.mode("overwrite").partitionBy("cell").parquet(f"{path}/vectors"))


def _pivot_matrix(spark: SparkSession, path: str):
    rows = spark.read.parquet(f"{path}/pivots").orderBy("cell").limit(MAX_CELLS).toArrow()
    return spark.sparkContext.broadcast(np.vstack(rows["pivot"].to_numpy()))


def probe_ranks(spark: SparkSession, path: str, queries: DataFrame, k: int, query_id: str = "query_id",
                vec_col: str = "embedding") -> DataFrame:
    """(query_id, item, cell_rank) for the exact ``k`` best items of every query: as how manieth the item's cell is
    probed.  Recall at p probes is the share of rows with cell_rank <= p."""
    vectors = spark.read.parquet(f"{path}/vectors")
    exact = best_k(tile_scores(vectors, queries.withColumnRenamed(vec_col, "vector"), k=k, item_id="item", query_id=query_id, vec_col="vector"), k, "item", query_id)
    matrix = _pivot_matrix(spark, path)
    near = _nearest(queries.where(F.col(vec_col).isNotNull()).select(query_id, vec_col), matrix, vec_col, len(matrix.value))
    return (exact.join(vectors.select("item", "cell"), "item").join(near.select(query_id, "near"), query_id)
            .select(query_id, "item", F.array_position("near", F.col("cell")).cast("int").alias("cell_rank")))


def probes_for(spark: SparkSession, path: str, queries: DataFrame, k: int, recall: float = 0.95, query_id: str = "query_id",
               vec_col: str = "embedding", sample: int = SAMPLE_QUERIES) -> int:
    """The least number of cells to probe so that ``recall`` of the exact ``k`` best items are found, measured on at most
    ``sample`` queries (those with the smallest md5 of their id)."""
    some = queries.where(F.col(vec_col).isNotNull()).orderBy(F.md5(F.col(query_id).cast("string").cast("binary"))).limit(sample)
    ranks = probe_ranks(spark, path, some, k, query_id, vec_col)
    at = F.array_sort(F.collect_list("cell_rank"))
    found = ranks.agg(F.try_element_at(at, F.ceil(F.size(at) * F.lit(recall)).cast("int"))).first()[0]
    return found or 1


def search_cells(spark: SparkSession, path: str, queries: DataFrame, k: int = 5, probes: int = 8, item_id: str = "doc_id",
                 query_id: str = "query_id", vec_col: str = "embedding") -> DataFrame:
    """Approximate top-k over an index of ``write_cells``: the vectors in the ``probes`` nearest cells of each query, scored
    exactly.

    The probed cells (at most MAX_CELLS) are broadcast, so partition pruning at run time leaves the files of all other
    cells unread; queries of any number then meet their cells' vectors in an equi-join."""
    return best_k(probed_pairs(spark, path, queries, probes, item_id, query_id, vec_col), k, item_id, query_id)


def probed_pairs(spark: SparkSession, path: str, queries: DataFrame, probes: int, item_id: str = "doc_id", query_id: str = "query_id",
                 vec_col: str = "embedding") -> DataFrame:
    """(query_id, item_id, score) of every query and every vector in its ``probes`` nearest cells."""
    near = _nearest(queries.where(F.col(vec_col).isNotNull()).select(query_id, vec_col), _pivot_matrix(spark, path), vec_col, probes)
    probed = written(near.select(query_id, F.col(vec_col).alias("_qv"), F.posexplode("near").alias("_rank", "cell")), "probes")
    wanted = F.broadcast(probed.where(F.col("_rank") < probes).select("cell").distinct())
    rows = spark.read.parquet(f"{path}/vectors").join(wanted, "cell", "left_semi")
    return rows.join(probed, "cell").select(query_id, F.col("item").alias(item_id), dot(F.col("_qv"), F.col("vector")).alias("score"))
