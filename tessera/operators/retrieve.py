"""Retrieval: keyword overlap, TF-IDF keywords, vector similarity (exact and approximate), page paragraphs."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd  # type hints of the pandas UDF below are resolved in this module
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import formats as fmt
from ..functions.text import (decode_entities, drop_script_style, first_line, py_strip, rest_lines,
                              strip_tags, tokens, unit_normalize)
from ..session import materialize, scratch_path, written
from .common import BROADCAST_MAX_ROWS, broadcast_if_small, fill_template, spread
from .vectors import best_k, probes_for, search_cells, tile_scores, write_cells


# ---------------------------------------------------------------------------------------------------------------- TF-IDF
def partition_by_doc(docs: DataFrame, id_col: str, max_rows_per_doc: int = 10_000,
                     one_row_per_doc: bool = False) -> tuple[DataFrame, bool]:
    """Hash-partition documents by id when their size is bounded -- each row a whole document, or an aggregate over
    the id column proving no document spans more than ``max_rows_per_doc`` rows -- so that everything computed per
    document afterwards needs no further exchange.  Returns ``(frame, partitioned)``; unbounded inputs are only
    spread (see ``spread``) and per-(document, term) aggregation takes care of large documents."""
    bounded = one_row_per_doc or (
        (docs.groupBy(id_col).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()[0] or 0)
        <= max_rows_per_doc)
    return (docs.repartition(id_col), True) if bounded else (spread(docs), False)


def term_weights(docs: DataFrame, id_col: str, text: Column, lower: bool = True,
                 allow_terms: DataFrame | None = None, stop_terms: DataFrame | None = None,
                 one_row_per_doc: bool = False, tokenizer: Callable[[Column], Column] | None = None,
                 max_rows_per_doc: int = 10_000, partitioned: bool | None = None) -> DataFrame:
    """``(id, term, tf, df, weight)`` with weight = tf * ln(N / df), N = number of documents with any term.

    * Documents of bounded size -- ``one_row_per_doc`` (each row is a whole document), or a cheap check (an
      aggregate over the id column only) proving no document has more than ``max_rows_per_doc`` rows -- are
      hash-partitioned by id once; counting, weighting and a later per-document top-k then run inside that
      partitioning with no further exchange.  Otherwise (some document spans very many rows) tf is a partial
      aggregation per (document, term) before its shuffle, which spreads a very large document over many tasks.
    * df is a partial aggregation per term; the (term, df) table is joined back by hash (Spark broadcasts it only
      when its runtime size is under the broadcast threshold).
    * N comes from a cheap scan of the input (documents holding at least one letter or digit); with allow/stop term
      tables it is counted from the filtered terms instead.
    The optional allow/stop term tables (column ``term``) stand in for a part-of-speech filter; ``tokenizer`` replaces
    the built-in token rule (any ``Column -> array<string>`` function, e.g. a pandas UDF).  ``partitioned`` tells
    that the caller already ran ``partition_by_doc`` (True: hash-partitioned by id; False: spread).
    """
    tok = tokenizer or (lambda c: tokens(c, lower))
    src = docs
    if partitioned is None:
        docs, _ = partition_by_doc(docs, id_col, max_rows_per_doc, one_row_per_doc)
    toks = docs.select(F.col(id_col), F.explode(tok(text)).alias("term"))
    filtered = allow_terms is not None or stop_terms is not None or tokenizer is not None
    if allow_terms is not None:
        toks = toks.join(broadcast_if_small(allow_terms.select("term").distinct()), "term", "left_semi")
    if stop_terms is not None:
        toks = toks.join(broadcast_if_small(stop_terms.select("term").distinct()), "term", "left_anti")
    tf = toks.groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("tf"))
    if filtered:
        n_docs = tf.select(F.countDistinct(id_col)).scalar()
    else:
        n_docs = src.where(text.rlike(r"[\p{L}\p{N}]")).select(F.countDistinct(id_col)).scalar()
    df = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return (tf.join(df, "term")
            .withColumn("weight", F.col("tf") * F.log(n_docs.cast("double") / F.col("df"))))


def top_terms(weights: DataFrame, id_col: str, k: int = 20, digits: int = 9) -> DataFrame:
    """Top ``k`` terms per document by weight (ties by term).  ``row_number() <= k`` lets Spark keep only k rows per
    document in each map partition before the shuffle (window group limit)."""
    w = Window.partitionBy(id_col).orderBy(F.round("weight", digits).desc(), F.col("term"))
    return (weights.withColumn("rank", F.row_number().over(w))
            .where(F.col("rank") <= k))


def row_counts(rows: DataFrame, keep: list[str], terms: Column, out: str = "_e") -> DataFrame:
    """(*keep, ``out``) with every row's terms counted inside the row: sorted structs (term, tf), runs of its sorted terms."""
    sorted_ = rows.select(*keep, F.sort_array(terms).alias("_s"))
    # Every element before which a run starts; the next start (or the end) gives the run's length.
    starts = F.filter(F.transform("_s", lambda x, i: i), lambda i: (i == 0) | (F.get("_s", i) != F.get("_s", i - 1)))
    runs = sorted_.select(*keep, "_s", starts.alias("_b"), F.size("_s").alias("_n"))
    counted = F.transform("_b", lambda b, j: F.struct(F.get("_s", b).alias("term"), (F.coalesce(F.get("_b", j + 1), F.col("_n")) - b).alias("tf")))
    return runs.select(*keep, counted.alias(out))


def term_candidates(counts: DataFrame, id_col: str, df: DataFrame, n_docs: int, k: int) -> DataFrame:
    """(id, term, tf): of ``counts`` (id, _e), a row per document, all terms that may be among its ``k`` heaviest.

    The terms of most documents, a bounded number, are known in every task, so a document's weights for them are computed
    where its row lies; of equal weights the ``k`` first terms stay, and those below the k-th weight go.  A rarer term
    goes only when it would weigh less than the k-th even in one document.  No row is sorted or moved for it."""
    import math

    spark = counts.sparkSession
    known = df.orderBy(F.col("df").desc(), "term").limit(BROADCAST_MAX_ROWS).toPandas()
    # Without a counted document every weight is null, and only the terms order them.
    idf = [math.log(n_docs / d) if n_docs else 0.0 for d in known["df"]]
    shared = spark.sparkContext.broadcast((known["term"].tolist(), idf, math.log(n_docs) if n_docs else math.inf))
    slack = 1e-6        # more than weights differ by that are equal when rounded

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        terms, idf, highest = shared.value
        vocabulary, idf = pa.array(terms, pa.string()), np.array(idf + [0.0])
        for batch in batches:
            row = pc.list_parent_indices(batch.column(1)).to_numpy(zero_copy_only=False)
            flat = pc.list_flatten(batch.column(1))
            tf = flat.field("tf").to_numpy(zero_copy_only=False)
            at = pc.fill_null(pc.index_in(flat.field("term").cast(pa.string()), value_set=vocabulary), -1).to_numpy(zero_copy_only=False)
            weight = tf * idf[at]
            order = np.flatnonzero(at >= 0)
            order = order[np.lexsort((order, -weight[order], row[order]))]
            r, w, place = row[order], weight[order], np.arange(len(order))
            new = np.append(True, r[1:] != r[:-1])[:len(order)]
            first = lambda starts: np.maximum.accumulate(np.where(starts, place, 0))
            least = np.full(batch.num_rows, -np.inf)
            kth = place - first(new) == k - 1
            least[r[kth]] = w[kth] - slack
            equal = place - first(new | np.append(True, w[1:] != w[:-1])[:len(order)])
            rare = np.flatnonzero(at < 0)
            rare = rare[tf[rare] * highest >= least[row[rare]]]
            kept = np.concatenate([order[(w >= least[r]) & (equal < k)], rare])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row[kept])), flat.field("term").take(pa.array(kept)),
                                              pa.array(tf[kept].astype(np.int64))], names=[id_col, "term", "tf"])

    kind = counts.schema[id_col].dataType.simpleString()
    return counts.select(id_col, "_e").mapInArrow(run, f"`{id_col}` {kind}, term string, tf bigint")


def heaviest_terms(docs: DataFrame, id_col: str, terms: Column, k: int = 20) -> DataFrame:
    """(id, term, tf, df, weight, rank): the ``k`` heaviest terms of every document by tf * ln(N / df).

    Terms are counted inside their row and the counts written once.  Document frequencies are one partial aggregation by
    term; a document of one row is pruned in its task (see ``term_candidates``), and only what may count is joined to the
    frequencies and ranked.  Documents of several rows (and rows without an id, one document) are summed by id and term
    first and pruned by nothing."""
    return heaviest_counted(written(row_counts(spread(docs), [id_col], terms), "counts"), id_col, k)


def heaviest_counted(counts: DataFrame, id_col: str, k: int = 20, df: DataFrame | None = None) -> DataFrame:
    """``heaviest_terms`` of stored counts (id, _e), ``_e`` a row's sorted (term, tf); ``df`` are the frequencies if known."""
    several = written(counts.groupBy(id_col).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > 1).select(F.col(id_col).alias("_id")), "several")
    single, tf = counts, None
    if several.count():
        same = F.col(id_col).eqNullSafe(F.col("_id"))
        single = counts.join(several, same, "left_anti")
        rows = counts.join(several, same, "left_semi").select(id_col, F.inline("_e").alias("term", "tf"))
        tf = rows.groupBy(id_col, "term").agg(F.sum("tf").alias("tf"))
    if df is None:
        posted = single.select(F.inline("_e").alias("term", "tf")).select("term")
        df = (posted if tf is None else posted.unionAll(tf.select("term"))).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    df = written(df, "frequencies")
    n_docs = counts.where(F.size("_e") > 0).agg(F.countDistinct(id_col)).first()[0]
    candidates = term_candidates(single, id_col, df, n_docs, k)
    if tf is not None:
        candidates = candidates.unionByName(tf)
    weights = candidates.join(df, "term").withColumn("weight", F.col("tf") * F.log(F.lit(float(n_docs)) / F.col("df")))
    return top_terms(weights, id_col, k)


def keyword_topk(docs: DataFrame, id_col: str, text_col: str, k: int = 20, lower: bool = True,
                 one_row_per_doc: bool = True) -> DataFrame:
    """Top-k keywords per document: ``(id, rank, term, weight)``.  Rows of one id are one document, whatever
    ``one_row_per_doc`` says."""
    return heaviest_terms(docs, id_col, tokens(text_col, lower), k).select(id_col, "rank", "term", F.round("weight", 6).alias("weight"))


# ------------------------------------------------------------------------------------------------------- keyword match
def keyword_retrieve(blocks: DataFrame, queries: DataFrame, threshold: float = 0.5, query_id: str = "query_id",
                     query_text: str = "text", top_k_terms: int = 20,
                     tokenizer: Callable[[Column], Column] | None = None,
                     body_tokenizer: Callable[[Column], Column] | None = None,
                     broadcast_max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Score every file of a block table against every query and keep files whose best score is **strictly** above
    ``threshold``.

    Three scores per (query, file), each = |distinct(Q) ∩ distinct(part)| / |distinct(Q)|:
      * name  -- tokens of the file name (the full path, so folder names count);
      * title -- tokens of the first line of the file's order-0 block (the last ingest wins);
      * body  -- the file's top-``top_k_terms`` TF-IDF keywords over the rest of order 0 and all other blocks.
    Case is kept on all three paths.  ``tokenizer`` (query, name and title tokens) and ``body_tokenizer`` (keyword
    candidates; default: the same) replace the built-in rule, e.g. with a pandas UDF returning ``array<string>``.

    Plan: per-file parts are built with partial aggregations.  A query set proven small (at most
    ``broadcast_max_rows`` query tokens) is broadcast and joined map-side on ``term``; a larger one goes through an
    exact prefix filter -- only each query's rarest tokens that could still reach the threshold are joined to the
    parts -- with exact verification of the candidate pairs.  Files sharing no token with a query score 0 and never
    pass a non-negative threshold, so no query x file product is formed.
    """
    if threshold < 0:
        raise ValueError("threshold must be >= 0 (a negative threshold would select every file)")
    tok = tokenizer or tokens
    tset = lambda c: F.array_distinct(tok(c))
    is_first = F.col("order_index") == 0
    # Names, titles and body terms each read their own columns; no block text is shuffled.
    names = blocks.select("filename").distinct()
    # Titles: only order-0 blocks, first line projected before the (sort-based) max_by.
    titles = (blocks.where(is_first).select("filename", "ingest_seq", first_line("content").alias("_t"))
              .groupBy("filename").agg(F.max_by("_t", "ingest_seq").alias("title")))
    name_terms = names.select("filename", F.lit("name").alias("part"),
                              F.explode(tset(F.col("filename"))).alias("term"))
    title_terms = titles.select("filename", F.lit("title").alias("part"),
                                F.explode(tset(F.col("title"))).alias("term"))
    body = blocks.select("filename", F.when(is_first, rest_lines("content")).otherwise(F.col("content")).alias("body"))
    body_terms = (heaviest_terms(body, "filename", (body_tokenizer or tok)(F.col("body")), top_k_terms)
                  .select("filename", F.lit("body").alias("part"), "term"))
    parts = name_terms.unionByName(title_terms).unionByName(body_terms)

    return score_parts(parts, queries, threshold, query_id, query_text, tset, broadcast_max_rows)


def score_parts(parts: DataFrame, queries: DataFrame, threshold: float, query_id: str, query_text: str,
                tset: Callable[[Column], Column], broadcast_max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """The scores of every query and file above ``threshold`` from the distinct terms of the files' parts,
    ``(filename, part, term)`` with part name, title or body (see ``keyword_retrieve``)."""
    q = queries.select(F.col(query_id).alias("query_id"), tset(F.col(query_text)).alias("qt"))
    q_size = q.select("query_id", F.size("qt").alias("q_size"))
    q_terms = q.select("query_id", F.explode("qt").alias("term"))
    q_small = q_terms.limit(broadcast_max_rows + 1).count() <= broadcast_max_rows
    counts = [F.count_if(F.col("part") == p).alias(f"n_{p}") for p in ("name", "title", "body")]
    if q_small:
        # A provably small query set: a map-side (broadcast) join; each part row meets at most the queries that
        # contain its token, a bounded multiplier.
        hits = parts.join(F.broadcast(q_terms), "term").groupBy("query_id", "filename").agg(*counts)
    else:
        # A large query set: exact prefix filter (set-similarity join).  A part passes only with more than
        # threshold * |Q| shared tokens, i.e. at least k = floor(threshold * |Q|) + 1; then it must share one of the
        # query's |Q| - k + 1 rarest tokens (rarity = number of part rows holding the token, ties by token).  Only
        # those prefix tokens are joined to the parts, so a token held by a large share of files is not joined
        # unless a query consists of such tokens; candidate pairs are verified with exact shared-token counts.
        # The parts are small (name, title, at most top_k_terms body terms per file) and used three times: computed
        # once into the checkpoint folder.
        parts = materialize(parts)
        freq = parts.groupBy("term").agg(F.count(F.lit(1)).alias("_fq"))
        ranked = (q_terms.join(freq, "term", "left")
                  .groupBy("query_id").agg(F.array_sort(F.collect_list(
                      F.struct(F.coalesce("_fq", F.lit(0)).alias("_fq"), F.col("term")))).alias("_r")))
        k = (F.floor(F.lit(threshold) * F.size("_r")) + 1).cast("int")
        prefix = (ranked.select("query_id", F.explode(F.slice("_r", 1, F.greatest(F.size("_r") - k + 1, F.lit(0))))
                                .alias("_t"))
                  .select("query_id", F.col("_t.term").alias("term")))
        candidates = parts.join(prefix, "term").select("query_id", "filename").distinct()
        hits = (parts.join(candidates, "filename")
                .join(q_terms, ["query_id", "term"], "left_semi")
                .groupBy("query_id", "filename").agg(*counts))
    # One row per query: AQE broadcasts it at run time from its measured size (no extra check job here).
    scored = hits.join(q_size, "query_id").select(
        "query_id", "filename",
        *[(F.col(f"n_{p}") / F.col("q_size")).alias(f"score_{p}") for p in ("name", "title", "body")])
    best = F.greatest("score_name", "score_title", "score_body")
    return (scored.where(best > F.lit(threshold))
            .select("query_id", "filename",
                    *[F.round(f"score_{p}", 6).alias(f"score_{p}") for p in ("name", "title", "body")],
                    F.round(best, 6).alias("score")))


def retrieved_text(hits: DataFrame, corpus: DataFrame, sep: str = "\n\n") -> DataFrame:
    """Per query: the corpus texts of its files in file-name order, joined by a blank line."""
    joined = hits.join(corpus, "filename")
    return joined.groupBy("query_id").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("filename", "corpus"))), lambda x: x["corpus"]), sep).alias("text"))


# ------------------------------------------------------------------------------------------------------------- vectors
def centroids(vectors: DataFrame, key: str, vec_col: str = "embedding") -> DataFrame:
    """Unit-normalised mean vector per key.  ``Summarizer.mean`` averages whole vectors JVM-side with partial
    aggregation (no per-element rows)."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    means = (vectors.where(F.col(vec_col).isNotNull())
             .groupBy(key).agg(Summarizer.mean(array_to_vector(vec_col)).alias("_m")))
    return means.select(key, unit_normalize(vector_to_array("_m")).alias(vec_col))


def vector_threshold(items: DataFrame, queries: DataFrame, threshold: float = 0.3, item_id: str = "doc_id",
                     query_id: str = "query_id", vec_col: str = "embedding") -> DataFrame:
    """All items with dot(q, v) >= threshold (inclusive), sorted per query best first, ties by item id (insertion
    order), for any number of queries (see ``vectors.tile_scores``).  The order is a global sort (range partitioning on
    query and score), so a query matching a large share of the items is spread over many tasks."""
    scored = tile_scores(items, queries, threshold, None, item_id, query_id, vec_col)
    return (scored.select(query_id, item_id, F.round("score", 6).alias("score"), F.col("score").alias("_s"))
            .orderBy(F.col(query_id), F.col("_s").desc(), F.col(item_id)).drop("_s"))


def vector_topk(items: DataFrame, queries: DataFrame, k: int = 5, item_id: str = "doc_id",
                query_id: str = "query_id", vec_col: str = "embedding") -> DataFrame:
    """k nearest by cosine (vectors are unit norm, so dot product): ``min(k, n)`` rows per query, best first, for any
    number of queries.

    Each task keeps what may be among its own top k per query; ``row_number() <= k`` then keeps k per query in each map
    partition before the shuffle (window group limit) and picks the final k."""
    return best_k(tile_scores(items, queries, None, k, item_id, query_id, vec_col), k, item_id, query_id)


def hit_texts(hits: DataFrame, texts: DataFrame, item_id: str = "doc_id", query_id: str = "query_id",
              text_col: str = "text", joined: bool = False) -> DataFrame:
    """Hit id -> item text (equi-join on the id).  ``joined=True`` gives one row per query with the texts joined by
    ``\n`` best first (the plain-string form of a search); otherwise ``(query, rank, id, score, text)``."""
    from .common import ordered_concat, row_number_within

    out = hits.join(texts.select(item_id, text_col), item_id)
    if not joined:
        return out
    if "rank" not in out.columns:      # threshold hits: best score first, ties by id
        out = row_number_within(out.withColumn("_low", -F.col("score")), [query_id], ["_low", item_id], "rank")
    return ordered_concat(out, [query_id], ["rank"], F.col(text_col), text_col, sep="\n")


def vector_ann(items: DataFrame, queries: DataFrame, k: int = 5, item_id: str = "doc_id",
               query_id: str = "query_id", vec_col: str = "embedding", recall: float = 0.95, cells: int | None = None,
               probes: int | None = None, path: str | None = None) -> DataFrame:
    """Approximate top-k: an index partitioned by cell is written under ``path`` (below the checkpoint folder by default)
    and only the cells nearest to the queries are read (see ``vectors.search_cells``).

    Without ``probes`` their number is the least that finds ``recall`` of the exact results of a bounded sample of the
    queries (``vectors.probes_for``)."""
    spark = items.sparkSession
    path = path or scratch_path(spark, "cells")
    write_cells(items, path, cells, item_id, vec_col)
    probes = probes or probes_for(spark, path, queries, k, recall, query_id, vec_col)
    return search_cells(spark, path, queries, k, probes, item_id, query_id, vec_col)


def prefixed_query(text: Column, prefix: str = fmt.QUERY_PREFIX) -> Column:
    """Instruction prefix put before a text before it is embedded."""
    return F.concat(F.lit(prefix), text)


def embed_texts(df: DataFrame, text_col: str, encode: Callable, out: str = "embedding",
                prefix: str | None = fmt.QUERY_PREFIX, normalize: bool = True) -> DataFrame:
    """Add an embedding column computed by a user model: ``encode(list[str]) -> 2-D array`` runs once per Arrow
    batch inside a pandas UDF (the model is shipped with the function; load it lazily inside ``encode`` for large
    models).  The instruction prefix is put before each text and vectors are unit-normalised, as the search
    operators expect."""
    import numpy as np

    @F.pandas_udf("array<float>")
    def _embed(texts: pd.Series) -> pd.Series:
        vecs = np.asarray(encode(texts.fillna("").tolist()), dtype=np.float64)
        if normalize and len(vecs):
            norms = np.linalg.norm(vecs, axis=1, keepdims=True)
            vecs = vecs / np.where(norms == 0, 1.0, norms)
        return pd.Series([v.astype(np.float32) for v in vecs], index=texts.index)

    text = prefixed_query(F.col(text_col), prefix) if prefix else F.col(text_col)
    return df.withColumn(out, _embed(text))


# --------------------------------------------------------------------------------------------------------------- pages
P_PATTERN = r"(?is)<p(?:\s[^>]*)?>(.*?)</p>"
HREF_PATTERN = r"(?is)<a\s[^>]*?href\s*=\s*[\"']([^\"']*)[\"']"


def page_paragraphs(pages: DataFrame, min_par: int = 60, max_len: int = 5000, min_page: int = 100,
                    id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per page: text of each ``<p>`` (tags removed, five entities decoded, stripped), kept when longer than
    ``min_par``; joined by ``\\n``, stripped, cut at ``max_len`` characters; pages kept when the text is longer than
    ``min_page``.  Script and style elements are removed first.  Row-wise: no shuffle."""
    html = drop_script_style(F.col(html_col))
    pars = F.transform(F.regexp_extract_all(html, F.lit(P_PATTERN), 1),
                       lambda p: py_strip(decode_entities(strip_tags(p))))
    kept = F.filter(pars, lambda p: F.length(p) > min_par)
    text = F.substring(py_strip(F.array_join(kept, "\n")), 1, max_len)
    # The text is produced by a (one-element) generator so that the length filter applies to the generated column:
    # a filter on a plain projection would be pushed below it and the extraction evaluated twice.
    out = (pages.where(F.col(html_col).isNotNull())
           .select(F.col(id_col), F.col(url_col), F.explode(F.array(text)).alias("content"))
           .where(F.length("content") > min_page))
    return out.withColumn("block", fill_template(fmt.PAGE_BLOCK, url=F.col(url_col), content=F.col("content")))


def top_links(pages: DataFrame, k: int = 3, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """First ``k`` links (non-empty ``href``) of each page in document order: ``(page_id, rank, link)``.  Row-wise."""
    links = F.filter(F.regexp_extract_all(F.col(html_col), F.lit(HREF_PATTERN), 1), lambda x: x != "")
    return (pages.select(F.col(id_col), F.posexplode(F.slice(links, 1, k)).alias("pos", "link"))
            .select(id_col, (F.col("pos") + 1).alias("rank"), "link"))
