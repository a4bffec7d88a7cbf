"""Exact search over tiles and approximate search over a cell index, against numpy."""

import numpy as np
import pytest

from tessera.operators import vectors
from tessera.operators.retrieve import vector_ann, vector_topk
from tessera.session import scratch_path


def unit(rng, n, dim=8, around=None, spread=0.05):
    x = rng.normal(size=(n, dim)) if around is None else around[rng.integers(0, len(around), n)] + spread * rng.normal(size=(n, around.shape[1]))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def frame(spark, matrix, name, partitions=4):
    import pandas as pd

    return spark.createDataFrame(pd.DataFrame({name: np.arange(len(matrix)), "embedding": list(matrix)})).repartition(partitions)


def exact(items, queries, k):
    s = queries @ items.T
    return {(q, int(i)) for q in range(len(queries)) for i in np.lexsort((np.arange(len(items)), -s[q]))[:k]}


def test_fifty_thousand_queries_in_blocks(spark):
    rng = np.random.default_rng(1)
    items, queries = unit(rng, 300), unit(rng, 50_000)
    scored = vectors.tile_scores(frame(spark, items, "doc_id"), frame(spark, queries, "query_id"), k=2, block_bytes=8 * 8 * 20_000)
    got = {(r.query_id, r.doc_id) for r in vectors.best_k(scored, 2, "doc_id", "query_id").toLocalIterator()}
    assert got == exact(items, queries, 2)


def test_tiles_that_cannot_reach_the_bound_lose_no_pair(spark, monkeypatch):
    monkeypatch.setattr(vectors, "TILE_ROWS", 16)
    rng = np.random.default_rng(2)
    centres = unit(rng, 12)
    items, queries = unit(rng, 600, around=centres), unit(rng, 200, around=centres)
    left, right = frame(spark, items, "doc_id"), frame(spark, queries, "query_id")
    got = {(r.query_id, r.doc_id) for r in vectors.tile_scores(left, right, threshold=0.9).collect()}
    s = queries @ items.T
    assert got == {(int(q), int(i)) for q, i in zip(*np.nonzero(s >= 0.9), strict=True)}
    top = {(r.query_id, r.doc_id) for r in vector_topk(left, right, 3).collect()}
    assert top == exact(items, queries, 3)


def test_no_dot_product_is_higher_than_the_bound():
    rng = np.random.default_rng(3)
    for _ in range(50):
        a, b = unit(rng, 9, around=unit(rng, 1)), unit(rng, 7, around=unit(rng, 1), spread=0.3)
        assert (a @ b.T).max() <= vectors.highest_score(vectors.ball(a), vectors.ball(b))


def test_ties_with_the_last_place_go_by_id(spark):
    items = frame(spark, np.array([[1.0, 0.0]] * 20 + [[0.0, 1.0]]), "doc_id", 3)
    queries = frame(spark, np.array([[1.0, 0.0]]), "query_id", 1)
    assert [r.doc_id for r in vector_topk(items, queries, 4).orderBy("rank").collect()] == [0, 1, 2, 3]
    assert vector_topk(items, queries.limit(0), 4).count() == 0


def test_cells_prune_what_is_read_and_keep_recall(spark):
    rng = np.random.default_rng(4)
    centres = unit(rng, 60, 32)
    items, queries = unit(rng, 6000, around=centres, spread=0.03), unit(rng, 80, around=centres, spread=0.03)
    left, right = frame(spark, items, "doc_id"), frame(spark, queries, "query_id", 2)
    want = exact(items, queries, 5)
    share = []
    for cells in (60, 400):
        path = scratch_path(spark, "cells")
        vectors.write_cells(left, path, cells)
        probes = vectors.probes_for(spark, path, right, 5)
        got = vectors.search_cells(spark, path, right, 5, probes)
        assert len({(r.query_id, r.doc_id) for r in got.collect()} & want) >= 0.9 * len(want)
        share.append(vectors.probed_pairs(spark, path, right, probes).count() / (len(items) * len(queries)))
    assert share[1] < share[0] and share[1] <= 0.05
    plan = vectors.search_cells(spark, path, right.limit(1), 5, 1)._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()
    assert sum(1 for _ in spark.read.parquet(f"{path}/vectors").select("item").toLocalIterator()) == len(items)


def test_all_probes_are_exact_and_bad_indexes_fail(spark):
    rng = np.random.default_rng(5)
    items, queries = unit(rng, 50), unit(rng, 4)
    left, right = frame(spark, items, "doc_id"), frame(spark, queries, "query_id")
    got = {(r.query_id, r.doc_id) for r in vector_ann(left, right, 5, cells=7, probes=7).collect()}
    assert got == exact(items, queries, 5)
    path = scratch_path(spark, "cells")
    with pytest.raises(ValueError, match="dimensions"):
        vectors.write_cells(left.unionAll(spark.createDataFrame([(99, [1.0])], left.schema)), path)
    with pytest.raises(ValueError, match="No documents"):
        vectors.write_cells(left.limit(0), path)
