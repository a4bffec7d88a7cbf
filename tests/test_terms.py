"""The persisted term index against keyword retrieval and hand counts."""

from collections import Counter

from pyspark.sql import functions as F

from tessera.functions.text import tokens
from tessera.operators.retrieve import keyword_retrieve
from tessera.sources.terms import index_retrieve, index_topk, row_counts, write_postings

BLOCKS = "filename string, content string, order_index int, ingest_seq long"


def blocks(spark, rows):
    return spark.createDataFrame(rows, BLOCKS).repartition(3)


ROWS = [("/a/x one.txt", "old title\nbody words here", 0, 0), ("/a/x one.txt", "New Title\nwords again and again", 0, 1), ("/a/x one.txt", "more words", 1, 0),
        ("/b/two.txt", "   ", 0, 0), ("/b/two.txt", None, 1, 0), ("/b/two.txt", "tail text", 2, 0), ("/c/three.txt", "gone\nx", 0, 0), ("/c/three.txt", "\nkept body body", 0, 3),
        (None, "lost", 0, 0)]


def test_counts_inside_a_row(spark):
    texts = ["b a b c a b", "", None, "one"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {(r.i, r.term): r.tf for r in row_counts(rows, ["i"], tokens(F.col("t"))).collect()}
    assert got == {(i, w): n for i, t in enumerate(texts) for w, n in Counter((t or "").split()).items()}


def test_postings_of_parts(spark):
    got = {(r.filename, r.part, r.term): r.tf for r in spark.table(write_postings(blocks(spark, ROWS), 4)).collect()}
    one = "/a/x one.txt"
    assert {k: v for k, v in got.items() if k[0] == one and k[1] != "name"} == {
        (one, "title", "New"): 1, (one, "title", "Title"): 1, (one, "body", "body"): 1, (one, "body", "words"): 3, (one, "body", "here"): 1,
        (one, "body", "again"): 2, (one, "body", "and"): 1, (one, "body", "more"): 1}
    assert {k[2] for k in got if k[0] == one and k[1] == "name"} == {"a", "x", "one", "txt"}
    assert {k[1:] for k in got if k[0] == "/c/three.txt" and k[1] != "name"} == {("body", "x"), ("body", "kept"), ("body", "body")}
    assert {k[0] for k in got} == {one, "/b/two.txt", "/c/three.txt"}


def test_retrieval_equals_the_scan(spark):
    queries = spark.createDataFrame([(1, "New words again"), (2, "tail text two"), (3, ""), (4, "kept nothing else"), (5, "old gone")], "query_id int, text string")
    rows = blocks(spark, [r for r in ROWS if r[0] and r[1]])
    want = sorted(map(tuple, keyword_retrieve(rows, queries, 0.2).collect()))
    assert sorted(map(tuple, index_retrieve(spark, write_postings(rows, 4), queries, 0.2).collect())) == want and want


def test_postings_are_read_without_an_exchange(spark):
    name = write_postings(blocks(spark, ROWS), 4)
    rows = spark.table(name)
    plan = rows.join(rows.groupBy("term").count().hint("merge"), "term")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan
    assert index_topk(spark, name, 1).where("filename = '/a/x one.txt'").count() == 1


def test_buckets_grow_with_the_postings_and_files_keep_their_counts(spark, monkeypatch):
    from tessera.sources import terms

    blocks = spark.createDataFrame([(f"/f{i}", 0, 0, "title\n" + " ".join(f"w{j}" for j in range(i, i + 20))) for i in range(20)],
                                   "filename string, order_index int, ingest_seq long, content string")
    want = sorted(map(tuple, index_topk(spark, write_postings(blocks), 3).collect()))
    monkeypatch.setattr(terms, "BUCKET_ROWS", 20)
    name = write_postings(blocks)
    buckets = [r.data_type for r in spark.sql(f"describe extended {name}").collect() if r.col_name == "Num Buckets"]
    assert int(buckets[0]) > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sorted(map(tuple, index_topk(spark, name, 3).collect())) == want and len(want) == 60
    assert spark.table(f"{name}_files").where("part = 'body'").count() == 20
