"""Block table and its text views on hand-made blocks (blank, gaps, re-ingest, Unicode space)."""

from pyspark.sql import functions as F

from tessera.operators.blocks import (block_table, file_text, merged_pages, paragraphs, preview, prompt_corpus,
                                      retrieval_record)
from tessera.operators.common import ordered_concat


def raw(spark):
    rows = [
        ("/d/a.pdf", 0, "text", "  标题\n正文第一行 ", 0),
        ("/d/a.pdf", 1, "table", "   ", 0),          # blank: dropped, order 1 stays a gap
        ("/d/a.pdf", 2, "table", "h1,h2\n1,2", 0),
        ("/d/b.DOCX", 0, "text", "　b body　", 0),
        ("/d/a.pdf", 0, "text", "标题二\n第二次", 1),  # the same file ingested again
    ]
    df = spark.createDataFrame(rows, "path string, pos int, kind string, text string, seq long")
    return block_table(df, filename=F.col("path"), content=F.col("text"), content_type=F.col("kind"),
                       order_index=F.col("pos"), ingest_seq=F.col("seq"))


def test_block_table_semantics(spark):
    b = raw(spark)
    rows = sorted((r.filename, r.filetype, r.content, r.order_index, r.ingest_seq) for r in b.collect())
    assert rows == [
        ("/d/a.pdf", ".pdf", "h1,h2\n1,2", 2, 0),
        ("/d/a.pdf", ".pdf", "标题\n正文第一行", 0, 0),
        ("/d/a.pdf", ".pdf", "标题二\n第二次", 0, 1),
        ("/d/b.DOCX", ".docx", "b body", 0, 0),
    ]


def test_prompt_corpus_order_and_format(spark):
    got = {r.filename: r.corpus for r in prompt_corpus(raw(spark)).collect()}
    assert got["/d/a.pdf"] == ("====文件名：/d/a.pdf====\n\n"
                               "信息类型: text\n内容：标题\n正文第一行\n\n"
                               "信息类型: table\n内容：h1,h2\n1,2\n\n"
                               "信息类型: text\n内容：标题二\n第二次\n\n")


def test_file_text_prints_filetype(spark):
    got = {r.filename: r.text for r in file_text(raw(spark)).collect()}
    assert got["/d/b.DOCX"] == "\n=== 📄 文件: /d/b.DOCX===\n\n信息类型: .docx\n\n内容: b body\n"


def test_retrieval_record_per_ingest(spark):
    got = {(r.filename, r.ingest_seq): r.record for r in retrieval_record(raw(spark)).collect()}
    assert len(got) == 3
    assert got[("/d/a.pdf", 1)] == "====文件名：/d/a.pdf====\n\n信息类型：text\n\n内容：标题二\n第二次\n"


def test_preview_lines_and_first_filetype(spark):
    p = preview(raw(spark), max_lines=1).where(F.col("filename") == "/d/a.pdf").collect()
    assert sorted(r.preview for r in p) == ["h1,h2", "标题", "标题二"]
    assert {r.file_filetype for r in p} == {".pdf"}
    full = preview(raw(spark), max_lines=-1).where(F.col("order_index") == 2).first()
    assert full.preview == "h1,h2\n    1,2"


def test_ordered_concat_chunks_equal_single_level(spark):
    df = spark.range(0, 1000).select((F.col("id") % 3).alias("g"), F.col("id").alias("o"),
                                     F.col("id").cast("string").alias("p"))
    small = {r.g: r.s for r in ordered_concat(df, ["g"], ["o"], F.col("p"), "s", sep=",", chunk_rows=7).collect()}
    big = {r.g: r.s for r in ordered_concat(df, ["g"], ["o"], F.col("p"), "s", sep=",").collect()}
    assert small == big
    assert small[0] == ",".join(str(i) for i in range(0, 1000, 3))


def test_paragraphs_numbered_tag(spark):
    docs = spark.createDataFrame([(1, "intro\n1. first step\n\n  2、第二步 \n• bullet\nplain")], "id int, text string")
    got = [(r.para_no, r.is_numbered, r.text) for r in paragraphs(docs, "id", "text").orderBy("para_no").collect()]
    assert got == [(0, False, "intro"), (1, True, "[编号段] 1. first step"), (3, True, "[编号段] 2、第二步"),
                   (4, True, "[编号段] • bullet"), (5, False, "plain")]


def test_merged_pages_repair(spark):
    pages = spark.createDataFrame([(1, 1, "第一页结束。"), (1, 2, "第二页\n续行"), (1, 3, ""), (2, 1, "x")],
                                  "f int, p int, t string")
    got = {r.f: r.text for r in merged_pages(pages, "f", "p", "t").collect()}
    assert got == {1: "第一页结束。\n第二页续行", 2: "x"}


def test_ordinal_within_matches_row_number_on_a_hot_key(spark):
    from pyspark.sql import Window

    from tessera.operators.common import ordinal_within

    # key 0 holds about a third of the rows and spans several range partitions
    df = spark.range(0, 3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 97).alias("k"),
                                     ((F.col("id") * 7919) % 3001).alias("o"), F.col("id").alias("v"))
    got = {(r.k, r.o): r.ordinal for r in ordinal_within(df, ["k"], ["o"], partitions=7).collect()}
    w = Window.partitionBy("k").orderBy("o")
    exp = {(r.k, r.o): r.rn for r in df.select("k", "o", F.row_number().over(w).alias("rn")).collect()}
    assert got == exp
    two = ordinal_within(df.withColumn("k2", F.col("k") % 2), ["k2", "k"], ["o"], partitions=5)
    assert {(r.k, r.o): r.ordinal for r in two.collect()} == exp


def test_ordinals_with_null_keys_wide_longs_and_no_keys(spark):
    from tessera.operators.common import ordinal_within, row_number_within

    rows = [(None if i % 3 == 0 else f"k{i % 3}", i, 2**53 + 1 if i % 2 else None) for i in range(40)]
    df = spark.createDataFrame(rows, "k string, o long, v long")
    got = {(r.k, r.o): (r.n, r.v) for r in row_number_within(df, ["k"], ["o"], "n").collect()}
    for key in (None, "k1", "k2"):
        mine = sorted(o for k, o, _ in rows if k == key)
        assert [got[(key, o)][0] for o in mine] == list(range(1, len(mine) + 1))
    assert all(got[(k, o)][1] == v for k, o, v in rows)
    whole = ordinal_within(df, [], ["o"], "n", partitions=7).orderBy("n").collect()
    assert [r.o for r in whole] == list(range(40)) and [r.n for r in whole] == list(range(1, 41))
    assert ordinal_within(df.limit(0), ["k"], ["o"]).count() == 0



def test_dense_order_closes_gaps(spark):
    from tessera.operators.blocks import dense_order

    df = spark.createDataFrame([("a", 0), ("a", 5), ("a", 2), ("b", 7)], "f string, pos int")
    got = {(r.f, r.pos): r.order_index for r in dense_order(df, ["f"], ["pos"]).collect()}
    assert got == {("a", 0): 0, ("a", 2): 1, ("a", 5): 2, ("b", 7): 0}


def test_join_paragraphs_round_trip(spark):
    from tessera.operators.blocks import join_paragraphs

    docs = spark.createDataFrame([(1, " a \n\nb\n 1. c")], "id int, text string")
    got = join_paragraphs(paragraphs(docs, "id", "text"), "id").first().text
    assert got == "a\nb\n[编号段] 1. c"
