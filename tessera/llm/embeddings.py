"""Near-duplicate vectors through product quantisation.

Unit vectors are dealt to inverted lists by their nearest coarse centroid; their residuals are coded by a codebook
for each subspace.  Centroids and codebooks are fitted on a bounded sample; every vector is coded.  A vector probes
every list that can hold a partner: a point within distance r that lies in another centroid's cell puts the vector
within r of the bisector between the two centroids, so the lists whose bisector is nearer than r are sufficient.
In a list, distances are sums of table entries between the query's residual and the codes; a code's own error bounds
how far the table distance may be off, so no link is lost.  Candidates are ranked by the exact cosine in doubles.

Lists are worked in cells of at most about CELL items by CELL queries.  A cell returns link counts and a spanning
forest of its links, never the pairs.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, saved

SAMPLE = 20_000         # vectors on which centroids and codebooks are fitted, at most (about)
CELL = 4096
SUBSPACES, CODES = 8, 64


def _kmeans(x, k: int, seed: int, rounds: int = 8):
    import numpy as np

    rng = np.random.default_rng(seed)
    c = x[rng.permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        own = _nearest(x, c)
        count = np.bincount(own, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, own, x)
        c = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], c)
    return np.unique(c, axis=0)


def _nearest(x, c):
    import numpy as np

    half = (c * c).sum(axis=1) / 2
    return np.concatenate([np.argmin(half - x[i:i + 4096] @ c.T, axis=1) for i in range(0, len(x), 4096)]) if len(x) else np.empty(0, int)


def fit(sample, lists: int):
    """(centroids, codebooks) of unit vectors (rows of ``sample``)."""
    import numpy as np

    centroids = _kmeans(sample, min(lists, len(sample)), 1)
    rest = sample - centroids[_nearest(sample, centroids)]
    books = [_kmeans(part, min(CODES, len(part)), 2 + i) for i, part in enumerate(np.array_split(rest, SUBSPACES, axis=1))]
    return centroids, books


def encode(rest, books):
    """(codes, error): each residual's code in every subspace, and the length of what the codes leave out."""
    import numpy as np

    parts = np.array_split(rest, SUBSPACES, axis=1)
    codes = np.stack([_nearest(p, b) for p, b in zip(parts, books, strict=True)], axis=1).astype(np.uint8)
    left = sum(((p - b[codes[:, i]]) ** 2).sum(axis=1) for i, (p, b) in enumerate(zip(parts, books, strict=True)))
    return codes, np.sqrt(left)


def _matrix(column, width: int):
    """Rows of an Arrow list column as a float64 matrix, zero-filled to ``width``, and as unit vectors."""
    import numpy as np

    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    size = column.value_lengths().to_numpy()
    out = np.zeros((len(size), width))
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    peak = np.abs(out).max(axis=1, initial=0)[:, None]
    unit = out / np.where(peak > 0, peak, 1)
    return unit / np.maximum(np.sqrt((unit * unit).sum(axis=1))[:, None], 1e-300)


def _cell(threshold: float, books):
    """Links between the queries and items of a cell: a count for each query, and edges that connect what links do."""
    radius = math.sqrt(2 - 2 * threshold) + 1e-9

    def run(key, table):
        import numpy as np
        import pyarrow as pa

        centroid = np.asarray(table["centroid"].drop_null()[0].as_py()) if table.num_rows else None
        is_query = table["is_query"].to_numpy()
        ids, weight = table["k"].to_numpy(), table["weight"].to_numpy()
        x = _matrix(table["v"].combine_chunks(), len(centroid))
        query, item = np.flatnonzero(is_query), np.flatnonzero(~is_query)
        out_k, out_n, out_a, out_b = [], [], [], []
        if len(query) and len(item):
            codes, err = encode(x[item] - centroid, books)
            own = np.arange(len(item))          # label of each item: items joined by links share one
            for at in range(0, len(query), 256):
                q = query[at:at + 256]
                rest = np.array_split(x[q] - centroid, SUBSPACES, axis=1)
                table_sum = np.zeros((len(q), len(item)))
                for m, (part, book) in enumerate(zip(rest, books, strict=True)):
                    lookup = ((part[:, None, :] - book[None, :, :]) ** 2).sum(axis=2)
                    table_sum += lookup[:, codes[:, m]]
                near = table_sum <= (radius + err[None, :]) ** 2
                near &= ids[q][:, None] != ids[item][None, :]
                if near.mean() > 0.05:          # exact cosine: whole blocks where most are candidates
                    near &= x[q] @ x[item].T >= threshold
                    a, b = np.nonzero(near)
                else:
                    a, b = np.nonzero(near)
                    hit = np.einsum("ij,ij->i", x[q[a]], x[item[b]]) >= threshold
                    a, b = a[hit], b[hit]
                count = np.bincount(a, weights=weight[item[b]], minlength=len(q)).astype(np.int64)
                cut = np.searchsorted(a, np.arange(len(q) + 1))
                for i in np.flatnonzero(count):
                    found = b[cut[i]:cut[i + 1]]
                    label, first = np.unique(own[found], return_index=True)
                    out_k.append(ids[q[i]])
                    out_n.append(count[i])
                    for f in found[first]:
                        out_a.append(ids[q[i]])
                        out_b.append(ids[item[f]])
                    if len(label) > 1:
                        own[np.isin(own, label)] = label[0]
        n, m = len(out_k), len(out_a)
        return pa.Table.from_arrays(
            [pa.array(out_k + out_a, pa.int64()), pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(out_b, pa.int64())]),
             pa.array(out_n + [0] * m, pa.int64())], names=["k", "other", "links"])

    return run


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                 threshold: float = 0.98) -> DataFrame:
    """(id_col, n_links, component_id, kept) for every row.

    Two rows link if their labels are equal and not null and their cosine is at least ``threshold``.  Rows whose vector
    is null, empty, all zero or holds a null, NaN or infinity, link with nothing, nor do vectors of different length.
    Equal vectors are worked once and count as many links as there are copies.  ``component_id`` is the smallest
    id that links lead to; ``kept`` marks the row that has it.  Repeated rows are vectors of their own; an empty table
    gives an empty result; other columns are not carried.
    """
    spark = vectors.sparkSession
    v = F.col("v")
    ok = (F.size(F.coalesce(v, F.array())) > 0) & F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))) & F.exists(v, lambda e: e != 0)
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vec_col).alias("v"))
    rows = rows.withColumn("good", F.coalesce(ok, F.lit(False)) & F.col("label").isNotNull())
    keyed = rows.where("good").withColumn("k", F.xxhash64("label", "v"))
    classes = saved(keyed.groupBy("k", "label").agg(F.count(F.lit(1)).alias("weight"), F.min("id").alias("low"), F.any_value("v").alias("v"))
                    .withColumn("dim", F.size("v")))
    n, width = classes.agg(F.count(F.lit(1)), F.max("dim")).first()
    if n:
        part = max(1, n // SAMPLE)
        sample = classes.where(F.pmod(F.xxhash64(F.lit(3), "k"), F.lit(part)) == 0).select("v").toArrow()
        unit = _matrix(sample["v"].combine_chunks(), width)
        centroids, books = fit(unit, max(1, min(1024, round(math.sqrt(n) / 4))))
        links = _links(classes, centroids, books, width, threshold)
        per = links.where("other is null").groupBy("k").agg(F.sum("links").alias("links"))
        edges = links.where("other is not null").select(F.col("k").alias("a"), F.col("other").alias("b"))
    else:
        per = spark.createDataFrame([], "k long, links long")
        edges = spark.createDataFrame([], "a long, b long")
    comp = connected_components(edges).select(F.col("node").alias("k"), "component")
    found = (classes.select("k", "weight", "low").join(per, "k", "left").join(comp, "k", "left")
             .select("k", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "k").alias("c"), "low"))
    low = found.groupBy("c").agg(F.min("low").alias("component_id"))
    found = found.join(low, "c").select("k", "n_links", "component_id")
    out = (rows.withColumn("k", F.when(F.col("good"), F.xxhash64("label", "v"))).select("id", "k").join(found, "k", "left")
           .select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "id").alias("component_id")))
    return out.select(F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def _links(classes: DataFrame, centroids, books, width: int, threshold: float) -> DataFrame:
    spark = classes.sparkSession
    radius = math.sqrt(2 - 2 * threshold) + 1e-9
    model = spark.sparkContext.broadcast(centroids)

    def deal(batches):
        import numpy as np
        import pyarrow as pa

        c = model.value
        half, gap = (c * c).sum(axis=1) / 2, np.sqrt(((c[:, None] - c[None]) ** 2).sum(axis=2)) + np.eye(len(c))
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                d = half - _matrix(part.column(1), width) @ c.T      # half of squared distances, less a constant
                home = d.argmin(axis=1)
                row, probe = np.nonzero((d - d[np.arange(len(d)), home][:, None]) / gap[home] <= radius)
                k = part.column(0)
                yield pa.RecordBatch.from_arrays(
                    [pa.concat_arrays([k, k.take(pa.array(row))]), pa.array(np.concatenate((home, probe))),
                     pa.array(np.arange(len(home) + len(row)) >= len(home))], names=["k", "list", "is_query"])

    dealt = saved(classes.select("k", "v").mapInArrow(deal, "k long, list long, is_query boolean"))
    placed = dealt.join(classes.select("k", "label", "dim"), "k")
    cell = ["label", "dim", "list"]
    blocks = placed.groupBy(*cell).agg(F.ceil(F.count_if(~F.col("is_query")) / CELL).cast("int").alias("ni"),
                                       F.ceil(F.count_if("is_query") / CELL).cast("int").alias("nq"))
    mine = F.when(F.col("is_query"), F.pmod(F.xxhash64(F.lit(5), "k"), F.col("nq"))).otherwise(F.pmod(F.xxhash64(F.lit(5), "k"), F.col("ni"))).cast("int")
    others = F.explode(F.sequence(F.lit(0), F.when(F.col("is_query"), F.col("ni")).otherwise(F.col("nq")) - 1))
    spread = (placed.join(blocks.where("ni > 0"), cell).withColumn("mine", mine).withColumn("other", others)
              .select(*cell, "k", "is_query", F.when(F.col("is_query"), F.col("other")).otherwise(F.col("mine")).alias("bi"),
                      F.when(F.col("is_query"), F.col("mine")).otherwise(F.col("other")).alias("bq")))
    full = spread.join(classes.select("k", "weight", "v"), "k")

    def run(key, table):
        import pyarrow as pa

        at = model.value[table["list"][0].as_py()]
        return _cell(threshold, books)(key, table.append_column("centroid", pa.array([at.tolist()] + [None] * (table.num_rows - 1))))

    return saved(full.groupBy(*cell, "bi", "bq").applyInArrow(run, "k long, other long, links long"))
