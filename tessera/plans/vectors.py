"""Registered plans: vector search (threshold, exact top-k, approximate top-k), index persistence, pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.retrieve import (HREF_PATTERN, P_PATTERN, centroids, page_paragraphs, top_links,
                                  vector_ann, vector_threshold, vector_topk)
from ..operators.vectors import probe_ranks, probed_pairs, probes_for, write_cells
from ..sources.index import read_index, write_index
from ..operators.common import spread
from ..session import scratch_path
from .registry import register, table
from .sqltext import WS

VECTOR_THRESHOLD = 0.3
TOP_K = 5


def _label_queries(spark, sf_dir):
    """The query set: the unit-normalised centroid of each label's vectors (grows with the table, bounded by the
    number of labels)."""
    emb = table(spark, sf_dir, "embeddings")
    return centroids(emb, "label").withColumnRenamed("label", "query_id")


_CENTROID_SQL = """
  e AS (SELECT label, CAST(unnest(embedding) AS DOUBLE) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings),
  m AS (SELECT label, pos, avg(x) AS m FROM e GROUP BY label, pos),
  c AS (SELECT label, list(m ORDER BY pos) AS v FROM m GROUP BY label),
  cn AS (SELECT label AS query_id, list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) AS q FROM c),
  s AS (SELECT cn.query_id, emb.vec_id, list_dot_product(cn.q, CAST(emb.embedding AS DOUBLE[])) AS score
        FROM embeddings emb CROSS JOIN cn)"""


@register("vector_threshold", f"""WITH {_CENTROID_SQL}
SELECT query_id, vec_id, round(score, 6) AS score
FROM s WHERE score >= {VECTOR_THRESHOLD} ORDER BY query_id, score DESC, vec_id""")
def q_vector_threshold(spark, sf_dir):
    """All vectors with cosine >= 0.3 to each label centroid, best first."""
    emb = table(spark, sf_dir, "embeddings")
    return vector_threshold(emb, _label_queries(spark, sf_dir), VECTOR_THRESHOLD, item_id="vec_id")


@register("vector_topk", f"""WITH {_CENTROID_SQL}
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, round(score, 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
) WHERE rank <= {TOP_K}""")
def q_vector_topk(spark, sf_dir):
    """Five nearest vectors to each label centroid (exact)."""
    emb = table(spark, sf_dir, "embeddings")
    return vector_topk(emb, _label_queries(spark, sf_dir), TOP_K, item_id="vec_id")


# The cell index in SQL: pivots by md5, each vector in the cell of its nearest pivot, cells ranked per query, and as many
# probed as hold 95 % of the exact results.
_ANN_SQL = f"""{_CENTROID_SQL},
  pv AS (SELECT row_number() OVER (ORDER BY md5(CAST(vec_id AS VARCHAR))) - 1 AS cell, CAST(embedding AS DOUBLE[]) AS p
         FROM embeddings QUALIFY cell < (SELECT greatest(1, least(4096, round(sqrt(count(*))))) FROM embeddings)),
  cl AS (SELECT vec_id, cell FROM embeddings CROSS JOIN pv
         QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY list_dot_product(CAST(embedding AS DOUBLE[]), p) DESC, cell) = 1),
  qr AS (SELECT query_id, cell, row_number() OVER (PARTITION BY query_id ORDER BY list_dot_product(q, p) DESC, cell) AS cell_rank
         FROM cn CROSS JOIN pv),
  ex AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= {TOP_K}),
  er AS (SELECT ex.query_id, ex.vec_id, qr.cell_rank FROM ex JOIN cl USING (vec_id) JOIN qr ON qr.query_id = ex.query_id AND qr.cell = cl.cell),
  np AS (SELECT list_sort(list(cell_rank))[CAST(ceil(count(*) * 0.95) AS INTEGER)] AS probes FROM er),
  pr AS (SELECT s.query_id, s.vec_id, s.score FROM s JOIN cl USING (vec_id) JOIN qr ON qr.query_id = s.query_id AND qr.cell = cl.cell
         WHERE cell_rank <= (SELECT probes FROM np))"""


@register("vector_ann", f"""WITH {_ANN_SQL}
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id,
       round(score, 6) AS score FROM pr QUALIFY rank <= {TOP_K}""")
def q_vector_ann(spark, sf_dir):
    """Five nearest vectors to each label centroid from an index partitioned by cell; as many cells are probed as hold 95 %
    of the exact results, and no others are read."""
    emb = table(spark, sf_dir, "embeddings")
    return vector_ann(emb, _label_queries(spark, sf_dir), TOP_K, item_id="vec_id")


@register("vector_ann_recall", f"""WITH {_ANN_SQL}
SELECT CAST((SELECT probes FROM np) AS INTEGER) AS probes, (SELECT count(*) FROM pv) AS cells,
       (SELECT count(*) FROM pr) AS pairs, (SELECT count(*) FROM s) AS all_pairs,
       (SELECT count(*) FROM er WHERE cell_rank <= (SELECT probes FROM np)) AS found, (SELECT count(*) FROM er) AS wanted""")
def q_vector_ann_recall(spark, sf_dir):
    """What the cell index costs and finds: cells, cells probed per query, pairs scored of all, exact results found of all."""
    emb, queries = table(spark, sf_dir, "embeddings"), _label_queries(spark, sf_dir)
    path = scratch_path(spark, "cells")
    write_cells(emb, path, item_id="vec_id")
    probes = probes_for(spark, path, queries, TOP_K)
    ranks = probe_ranks(spark, path, queries, TOP_K)
    cost = probed_pairs(spark, path, queries, probes).agg(F.count(F.lit(1)).alias("pairs"))
    every = spark.read.parquet(f"{path}/vectors").agg(F.count(F.lit(1)).alias("_n")).join(queries.agg(F.count(F.lit(1)).alias("_q")))
    cells = spark.read.parquet(f"{path}/pivots").agg(F.count(F.lit(1)).alias("cells"))
    return (ranks.agg(F.count_if(F.col("cell_rank") <= probes).alias("found"), F.count(F.lit(1)).alias("wanted"))
            .join(cost).join(every).join(cells)
            .select(F.lit(probes).alias("probes"), "cells", "pairs", (F.col("_n") * F.col("_q")).alias("all_pairs"), "found", "wanted"))


# Every hundredth vector is a query and all vectors are items: as many queries as the table gives.
@register("vector_self_threshold", """
SELECT q.vec_id AS query_id, e.vec_id, round(list_dot_product(CAST(q.embedding AS DOUBLE[]), CAST(e.embedding AS DOUBLE[])), 6) AS score
FROM embeddings q CROSS JOIN embeddings e
WHERE q.vec_id % 100 = 0 AND list_dot_product(CAST(q.embedding AS DOUBLE[]), CAST(e.embedding AS DOUBLE[])) >= 0.3""")
def q_vector_self_threshold(spark, sf_dir):
    """All vectors with cosine >= 0.3 to each vector whose id is divisible by 100."""
    emb = table(spark, sf_dir, "embeddings")
    queries = emb.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    return vector_threshold(emb, queries, VECTOR_THRESHOLD, item_id="vec_id")


@register("index_roundtrip", """
SELECT vec_id, label, CAST(len(embedding) AS INTEGER) AS dim,
       round(sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))), 6) AS norm
FROM embeddings""")
def q_index_roundtrip(spark, sf_dir):
    """Persist the vector index (ids, vectors, checked dimension) to the shared folder and load it back."""
    emb = table(spark, sf_dir, "embeddings")
    path = scratch_path(spark, "index")
    write_index(emb.select(F.col("vec_id").alias("doc_id"), F.col("label").cast("string").alias("text"),
                           "embedding"), path)
    back = read_index(spark, path)
    from ..functions.text import dot

    return back.select(F.col("doc_id").alias("vec_id"), F.col("text").cast("int").alias("label"), "dim",
                       F.round(F.sqrt(dot("embedding", "embedding")), 6).alias("norm"))


def _entities_sql(x: str) -> str:
    for ent, ch in [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")]:
        x = f"replace({x}, '{ent}', '{ch}')"
    return x


_P_SQL = P_PATTERN.replace("'", "''")
_HREF_SQL = HREF_PATTERN.replace("'", "''")


@register("page_paragraphs", f"""
WITH h AS (SELECT page_id, url,
             regexp_replace(html, '(?is)<script\\b.*?</script>|<style\\b.*?</style>', '', 'g') AS h
           FROM pages WHERE html IS NOT NULL),
  p AS (SELECT page_id, url,
          list_filter(list_transform(regexp_extract_all(h, '{_P_SQL}', 1),
                        lambda x: trim({_entities_sql("regexp_replace(x, '<[^>]*>', '', 'g')")}, '{WS}')),
                      lambda x: length(x) > 60) AS ps
        FROM h),
  c AS (SELECT page_id, url, substr(trim(array_to_string(ps, chr(10)), '{WS}'), 1, 5000) AS content FROM p)
SELECT page_id, url, content,
       '====' || url || '====' || chr(10) || '信息类型：网络数据' || chr(10) || '内容：' || chr(10) || content || chr(10)
         AS block
FROM c WHERE length(content) > 100""")
def q_page_paragraphs(spark, sf_dir):
    """Paragraph text of every page (> 60 characters each, page > 100, cut at 5000) and its formatted block."""
    return page_paragraphs(spread(table(spark, sf_dir, "pages")))


@register("top_links", f"""
SELECT page_id, CAST(generate_subscripts(l, 1) AS INTEGER) AS rank, unnest(l) AS link FROM (
  SELECT page_id, list_filter(regexp_extract_all(html, '{_HREF_SQL}', 1), lambda x: x <> '')[1:3] AS l FROM pages)""")
def q_top_links(spark, sf_dir):
    """First three links of every page in document order."""
    return top_links(table(spark, sf_dir, "pages"), k=3)
