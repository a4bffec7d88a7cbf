"""Retrieval operators against brute-force Python on small fixtures and the test tables."""

import math
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tessera.operators.retrieve import (centroids, keyword_retrieve, keyword_topk, page_paragraphs, top_links,
                                        vector_ann, vector_threshold, vector_topk)
from tessera.operators.blocks import block_table

from conftest import SF_CHECK

TOK = re.compile(r"[^\W_]+")


def toks(s):
    return TOK.findall(s)


def brute_keyword(files, queries, threshold, k=20):
    """files: {name: [(order, content)]}; the three-score rule written plainly in Python."""
    body_tf = {}
    titles = {}
    for name, blocks in files.items():
        c = Counter()
        for order, content in blocks:
            if order == 0:
                titles[name] = content.split("\n")[0]
                c.update(toks("\n".join(content.split("\n")[1:])))
            else:
                c.update(toks(content))
        if c:
            body_tf[name] = c
    n = len(body_tf)
    df = Counter(t for c in body_tf.values() for t in c)
    top = {}
    for name, c in body_tf.items():
        ranked = sorted(c, key=lambda t: (-round(c[t] * math.log(n / df[t]), 9), t))
        top[name] = set(ranked[:k])
    out = {}
    for qid, q in queries.items():
        qs = set(toks(q))
        for name in files:
            parts = [set(toks(name)), set(toks(titles.get(name, ""))), top.get(name, set())]
            sc = [len(qs & p) / len(qs) if qs else 0.0 for p in parts]
            if max(sc) > threshold:
                out[(qid, name)] = round(max(sc), 6)
    return out


def test_keyword_retrieve_matches_brute_force(spark):
    files = {
        "/data/hand/report_2025.pdf": [(0, "Hand hygiene training\nteam one attended hygiene hygiene"),
                                       (1, "audit results hygiene")],
        "/data/cars/market.docx": [(0, "Car market\nelectric cars sold cars"), (2, "battery market share")],
        "/data/misc/notes.txt": [(1, "no title block here training")],
    }
    queries = {1: "hygiene training report", 2: "electric market", 3: "", 4: "nothing matches"}
    rows = [(name, o, c) for name, bl in files.items() for o, c in bl]
    b = block_table(spark.createDataFrame(rows, "f string, o int, c string"), filename=F.col("f"),
                    content=F.col("c"), content_type=F.lit("text"), order_index=F.col("o"))
    q = spark.createDataFrame(list(queries.items()), "query_id long, text string")
    for t in (0.0, 0.3, 0.5):
        got = {(r.query_id, r.filename): r.score for r in keyword_retrieve(b, q, threshold=t).collect()}
        assert got == brute_keyword(files, queries, t), t


def test_keyword_threshold_is_strict(spark):
    b = block_table(spark.createDataFrame([("/x/alpha.txt", "alpha beta")], "f string, c string"),
                    filename=F.col("f"), content=F.col("c"), content_type=F.lit("text"), order_index=F.lit(0))
    q = spark.createDataFrame([(1, "alpha gamma")], "query_id long, text string")
    assert keyword_retrieve(b, q, threshold=0.5).count() == 0          # score exactly 0.5 is not > 0.5
    assert keyword_retrieve(b, q, threshold=0.49).count() == 1


def test_keyword_topk_rank_and_ties(spark):
    docs = spark.createDataFrame([(1, "b a a c"), (2, "c d")], "id int, text string")
    got = [(r.id, r.rank, r.term) for r in keyword_topk(docs, "id", "text", k=2).orderBy("id", "rank").collect()]
    # doc 1: a (tf 2), b (tf 1) beat c (in both docs, idf 0); doc 2: d then c
    assert got == [(1, 1, "a"), (1, 2, "b"), (2, 1, "d"), (2, 2, "c")]


def _emb(spark):
    return spark.read.parquet(f"{SF_CHECK}/embeddings.parquet")


def test_vector_search_matches_numpy(spark):
    emb = _emb(spark)
    q = centroids(emb, "label").withColumnRenamed("label", "query_id")
    E = emb.orderBy("vec_id").toPandas()
    Q = q.orderBy("query_id").toPandas()
    M = np.vstack(E.embedding.to_numpy()).astype(np.float64)
    S = np.vstack(Q.embedding.to_numpy()) @ M.T
    exp_top = {(int(qid), int(E.vec_id[j])) for i, qid in enumerate(Q.query_id)
               for j in sorted(range(len(E)), key=lambda j: (-S[i, j], E.vec_id[j]))[:5]}
    got_top = {(r.query_id, r.vec_id) for r in vector_topk(emb, q, 5, item_id="vec_id").collect()}
    assert got_top == exp_top
    exp_thr = {(int(qid), int(E.vec_id[j])) for i, qid in enumerate(Q.query_id) for j in range(len(E)) if S[i, j] >= 0.3}
    got_thr = {(r.query_id, r.vec_id) for r in vector_threshold(emb, q, 0.3, item_id="vec_id").collect()}
    assert got_thr == exp_thr


def test_vector_threshold_inclusive_and_rank(spark):
    items = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.6, 0.8]), (3, [0.0, 1.0])], "doc_id long, embedding array<double>")
    q = spark.createDataFrame([(9, [1.0, 0.0])], "query_id long, embedding array<double>")
    got = [r.doc_id for r in vector_threshold(items, q, 0.6).collect()]
    assert got == [1, 2]                                # 0.6 >= 0.6 kept, best first
    assert vector_topk(items, q, k=10).count() == 3     # min(k, n)


def test_ann_recall_against_exact(spark):
    emb = _emb(spark)
    q = centroids(emb, "label").withColumnRenamed("label", "query_id")
    exact = {(r.query_id, r.vec_id) for r in vector_topk(emb, q, 5, item_id="vec_id").collect()}
    approx = {(r.query_id, r.vec_id) for r in vector_ann(emb, q, 5, item_id="vec_id").collect()}
    assert len(approx & exact) / len(exact) >= 0.8


def test_page_paragraphs_rules(spark):
    long1 = "A" * 61
    long2 = "B" * 70
    html = (f"<html><script>var t='<p>{'Z' * 80}</p>';</script><p class='x'>{long1} &amp; more</p>"
            f"<p>short</p><P>{long2}</P></html>")
    pages = spark.createDataFrame([(1, "http://u/1", html), (2, "http://u/2", "<p>tiny</p>"), (3, "http://u/3", None)],
                                  "page_id long, url string, html string")
    rows = page_paragraphs(pages).collect()
    assert len(rows) == 1
    assert rows[0].content == f"{long1} & more\n{long2}"
    assert rows[0].block == f"====http://u/1====\n信息类型：网络数据\n内容：\n{long1} & more\n{long2}\n"


def test_top_links_first_k(spark):
    html = '<a href="/1">a</a><a name="x">no</a><a class="c" href=\'/2\'>b</a><a href="">e</a><a href="/3">c</a><a href="/4">d</a>'
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    assert [(r.rank, r.link) for r in top_links(pages, 3).orderBy("rank").collect()] == [(1, "/1"), (2, "/2"), (3, "/3")]


def test_custom_tokenizer_and_hit_texts(spark):
    from tessera.operators.retrieve import hit_texts

    b = block_table(spark.createDataFrame([("/x/a.txt", "Hello World")], "f string, c string"),
                    filename=F.col("f"), content=F.col("c"), content_type=F.lit("text"), order_index=F.lit(0))
    q = spark.createDataFrame([(1, "HELLO")], "query_id long, text string")
    low = lambda c: F.split(F.lower(c), r"[^a-z]+")
    assert keyword_retrieve(b, q, threshold=0.5).count() == 0
    assert keyword_retrieve(b, q, threshold=0.5, tokenizer=low).count() == 1
    hits = spark.createDataFrame([(1, 1, 7, 0.9), (1, 2, 8, 0.5)], "query_id long, rank int, doc_id long, score double")
    texts = spark.createDataFrame([(7, "seven"), (8, "eight")], "doc_id long, text string")
    assert hit_texts(hits, texts, joined=True).first().text == "seven\neight"


def test_term_weights_paths_agree(spark):
    from tessera.operators.retrieve import term_weights

    rows = [("f1", "a b b c"), ("f1", "c d"), ("f2", "a a e"), ("f3", "e f g g g")]
    docs = spark.createDataFrame(rows, "f string, t string")
    local = {(r.f, r.term): (r.tf, r.df, round(r.weight, 9))
             for r in term_weights(docs, "f", F.col("t")).collect()}
    spread_path = {(r.f, r.term): (r.tf, r.df, round(r.weight, 9))
                   for r in term_weights(docs, "f", F.col("t"), max_rows_per_doc=0).collect()}
    assert local == spread_path
    assert local[("f1", "b")] == (2, 1, round(2 * math.log(3 / 1), 9))


def test_vector_search_skips_unusable_vectors(spark):
    items = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [1.0, 0.0, 0.0])], "doc_id long, embedding array<double>")
    q = spark.createDataFrame([(9, [1.0, 0.0])], "query_id long, embedding array<double>")
    assert [r.doc_id for r in vector_topk(items, q, k=5).collect()] == [1]


def test_embed_texts_prefix_and_norm(spark):
    from tessera.operators.retrieve import embed_texts

    def encode(texts):
        return np.array([[len(t), 3.0, 4.0] for t in texts])

    df = spark.createDataFrame([(1, "abc"), (2, "")], "id long, text string")
    rows = {r.id: r.embedding for r in embed_texts(df, "text", encode, prefix="P:").collect()}
    assert abs(sum(x * x for x in rows[1]) - 1.0) < 1e-6
    raw = np.array([5.0, 3.0, 4.0])          # "P:abc" has 5 characters
    assert np.allclose(rows[1], raw / np.linalg.norm(raw), atol=1e-6)


def test_empty_store_is_an_error(spark):
    import pytest

    items = spark.createDataFrame([], "doc_id long, embedding array<double>")
    q = spark.createDataFrame([(9, [1.0, 0.0])], "query_id long, embedding array<double>")
    with pytest.raises(ValueError, match="No documents indexed"):
        vector_topk(items, q)


def test_allow_and_stop_terms(spark):
    from tessera.operators.retrieve import term_weights

    docs = spark.createDataFrame([(1, "apple pie and tea"), (2, "tea and cake")], "id int, t string")
    allow = spark.createDataFrame([("apple",), ("tea",), ("cake",)], "term string")
    stop = spark.createDataFrame([("and",)], "term string")
    got = {(r.id, r.term) for r in term_weights(docs, "id", F.col("t"), allow_terms=allow).collect()}
    assert got == {(1, "apple"), (1, "tea"), (2, "tea"), (2, "cake")}
    got = {(r.id, r.term) for r in term_weights(docs, "id", F.col("t"), stop_terms=stop).collect()}
    assert (1, "and") not in got and (1, "pie") in got


def test_retrieved_text_in_name_order(spark):
    from tessera.operators.retrieve import retrieved_text

    hits = spark.createDataFrame([(1, "/b"), (1, "/a"), (2, "/b")], "query_id long, filename string")
    corpus = spark.createDataFrame([("/a", "A-text"), ("/b", "B-text")], "filename string, corpus string")
    got = {r.query_id: r.text for r in retrieved_text(hits, corpus).collect()}
    assert got == {1: "A-text\n\nB-text", 2: "B-text"}


def test_keyword_retrieve_prefix_filter_path(spark):
    files = {
        "/data/a/common_one.txt": [(0, "common title\nalpha common beta")],
        "/data/b/common_two.txt": [(0, "other\ncommon gamma alpha")],
        "/data/c/three.txt": [(0, "common\ndelta")],
    }
    queries = {1: "common alpha", 2: "common", 3: "beta gamma delta common", 4: ""}
    rows = [(name, o, c) for name, bl in files.items() for o, c in bl]
    b = block_table(spark.createDataFrame(rows, "f string, o int, c string"), filename=F.col("f"),
                    content=F.col("c"), content_type=F.lit("text"), order_index=F.col("o"))
    q = spark.createDataFrame(list(queries.items()), "query_id long, text string")
    for t in (0.0, 0.3, 0.5, 0.7):
        big = {(r.query_id, r.filename): r.score
               for r in keyword_retrieve(b, q, threshold=t, broadcast_max_rows=0).collect()}
        small = {(r.query_id, r.filename): r.score for r in keyword_retrieve(b, q, threshold=t).collect()}
        assert big == small == brute_keyword(files, queries, t), t


def test_centroids_mean_then_unit_norm(spark):
    rows = [(1, 0, [1.0, 0.0, 0.0]), (2, 0, [0.0, 1.0, 0.0]), (3, 1, [0.0, 0.0, 2.0]), (4, 1, None)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    got = {r.label: r.embedding for r in centroids(df, "label").collect()}
    assert np.allclose(got[0], np.array([0.5, 0.5, 0.0]) / np.linalg.norm([0.5, 0.5, 0.0]))
    assert np.allclose(got[1], [0.0, 0.0, 1.0])


def test_hit_texts_joined_for_threshold_hits(spark):
    from tessera.operators.retrieve import hit_texts

    hits = spark.createDataFrame([("q", 1, 0.5), ("q", 2, 0.9), ("q", 3, 0.5)], "query_id string, doc_id long, score double")
    texts = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "doc_id long, text string")
    assert [r.text for r in hit_texts(hits, texts, joined=True).collect()] == ["b\na\nc"]


def test_pruned_top_terms_equal_the_plain_ranking(spark, monkeypatch):
    """Known and rare terms, ties, a document of two rows, rows without an id or a text: the same terms and weights."""
    import random

    from tessera.operators import retrieve

    rng = random.Random(5)
    text = lambda n: " ".join(f"t{int(rng.paretovariate(0.6)) % 60:02d}" for _ in range(n))
    rows = [(i, text(rng.randrange(0, 40))) for i in range(60)] + [(7, text(9)), (None, text(5)), (None, text(6)), (99, None), (98, "?!")]
    docs = spark.createDataFrame(rows, "id long, t string")
    want = retrieve.top_terms(retrieve.term_weights(docs, "id", F.col("t")), "id", 4).select("id", "rank", "term", F.round("weight", 6).alias("w"))
    want = sorted(map(str, want.collect()))
    for known in (0, 1, 12, 1000):
        monkeypatch.setattr(retrieve, "BROADCAST_MAX_ROWS", known)
        got = retrieve.heaviest_terms(docs, "id", retrieve.tokens(F.col("t"), True), 4).select("id", "rank", "term", F.round("weight", 6).alias("w"))
        assert sorted(map(str, got.collect())) == want
    lone = spark.createDataFrame([(None, "b a c a")], "id long, t string")
    assert [(r.rank, r.term) for r in retrieve.keyword_topk(lone, "id", "t", k=2).collect()] == [(1, "a"), (2, "b")]


def test_only_terms_that_may_count_leave_a_document(spark):
    from tessera.operators.retrieve import row_counts, term_candidates, tokens

    docs = spark.createDataFrame([(i, " ".join(f"w{j}" for j in range(i, i + 50))) for i in range(50)], "id long, t string")
    counts = row_counts(docs, ["id"], tokens(F.col("t")))
    df = counts.select(F.inline("_e").alias("term", "tf")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    assert term_candidates(counts, "id", df, 50, 3).count() <= 50 * 6
