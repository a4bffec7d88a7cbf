"""Streaming ingest equals batch, re-ingest appends; the driver entry points run."""

import os
import shutil
import tempfile

from pyspark.sql import functions as F

from tessera.operators.blocks import block_table
from tessera.streaming.ingest import read_ingested, start_ingest

from conftest import SF_SMALL


def to_blocks(batch, batch_id):
    return block_table(batch, filename=F.concat(F.lit("/c/"), F.col("conv_id").cast("string")),
                       content=F.col("text"), content_type=F.col("role"), order_index=F.col("turn"),
                       ingest_seq=F.lit(batch_id))


def test_stream_equals_batch_and_reingest_appends(spark):
    src = tempfile.mkdtemp(prefix="tessera-src-")
    out = tempfile.mkdtemp(prefix="tessera-out-")
    conv = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    shutil.copy(f"{SF_SMALL}/conversations.parquet", os.path.join(src, "part1.parquet"))
    schema = "conv_id long, turn long, role string, text string"
    start_ingest(spark, src, schema, to_blocks, out).awaitTermination()
    streamed = read_ingested(spark, out)
    batch = to_blocks(conv, 0)
    cols = ["filename", "content", "content_type", "order_index", "ingest_seq"]
    assert sorted(map(tuple, streamed.select(cols).collect())) == sorted(map(tuple, batch.select(cols).collect()))
    # the same file arriving again under a new name is a new ingest: rows are appended with the next ingest_seq
    shutil.copy(f"{SF_SMALL}/conversations.parquet", os.path.join(src, "part2.parquet"))
    start_ingest(spark, src, schema, to_blocks, out).awaitTermination()
    again = read_ingested(spark, out)
    assert again.count() == 2 * batch.count()
    assert {r.ingest_seq for r in again.select("ingest_seq").distinct().collect()} == {0, 1}
    recs = read_ingested(spark, out, "records")
    assert recs.count() == 2 * batch.select("filename").distinct().count()


def test_stream_append_reads_a_table_of_one_file_or_of_many(spark):
    from tessera.plans import QUERIES

    rows = [(c, t, "user", f"text {c} {t}") for c in range(4) for t in range(3)]
    conv = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    many, one = tempfile.mkdtemp(prefix="tessera-many-"), tempfile.mkdtemp(prefix="tessera-one-")
    conv.repartition(3).write.parquet(f"{many}/conversations.parquet")
    conv.coalesce(1).write.parquet(f"{one}/parts")
    part = next(f for f in os.listdir(f"{one}/parts") if f.endswith(".parquet"))
    shutil.copy(f"{one}/parts/{part}", f"{one}/conversations.parquet")
    want = sorted((f"/chats/conv_{c}.txt", ".txt", text, role, t, 0) for c, t, role, text in rows)
    for folder in (many, one):
        assert sorted(map(tuple, QUERIES["stream_append"](spark, folder).collect())) == want


def test_entry_and_all_queries_run(spark):
    import __spark_entry__ as ent

    df = ent.entry(spark)
    assert df.count() >= 0 and "score" in df.columns
    qs, orc = ent.queries(), ent.oracle_sql()
    assert set(orc) <= set(qs)
    for name, fn in qs.items():
        fn(spark, SF_SMALL).write.format("noop").mode("overwrite").save()


def test_decode_files_with_a_given_decoder(spark):
    from tessera.operators.blocks import block_table
    from tessera.sources.files import decode_files, file_manifest

    d = tempfile.mkdtemp(prefix="tessera-files-")
    with open(os.path.join(d, "a.CSV"), "w") as f:
        f.write("x,y\n1,\n2,b\n")
    with open(os.path.join(d, "notes.xyz"), "w") as f:
        f.write("ignored")
    man = {r.name: r for r in file_manifest(spark, d).select(F.regexp_extract("path", r"([^/]+)$", 1).alias("name"),
                                                             "filetype", "reader", "supported").collect()}
    assert man["a.CSV"].reader == ".csv" and man["a.CSV"].supported and not man["notes.xyz"].supported
    raw = decode_files(spark, d, {".csv": lambda data, path: [(0, "table", data.decode())]})
    blocks = block_table(raw, filename=F.col("path"), content=F.col("content"), content_type=F.col("content_type"),
                         order_index=F.col("order_index"), filetype=F.col("reader")).collect()
    assert len(blocks) == 1
    assert blocks[0].content == "x,y\n1,\n2,b" and blocks[0].filetype == ".csv"
    assert blocks[0].filename.endswith("/a.CSV")


def test_manifest_strict_fails_on_unknown_type(spark):
    import pytest

    from tessera.sources.files import file_manifest

    d = tempfile.mkdtemp(prefix="tessera-strict-")
    with open(os.path.join(d, "x.bin"), "w") as f:
        f.write("?")
    with pytest.raises(Exception, match="Unsupported file type"):
        file_manifest(spark, d, strict=True).collect()


def test_sinks_round_trip(spark):
    import json as _json

    import pytest

    from tessera.operators.blocks import export_clean
    from tessera.sources.files import write_export, write_json_documents, write_json_lines
    from tessera.sources.index import read_index

    from tessera.operators.blocks import block_table

    raw = spark.createDataFrame([("/c/1.txt", 0, "user", ' a,"b"\r\nc ')], "f string, turn long, role string, text string")
    blocks = block_table(raw, filename=F.col("f"), content=F.col("text"), content_type=F.col("role"),
                         order_index=F.col("turn"))
    out = tempfile.mkdtemp(prefix="tessera-sinks-")
    ex = export_clean(blocks)
    write_export(ex, out + "/csv", fmt="csv")
    back = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(out + "/csv").first()
    assert back.content == 'a,"b"\nc' and back.filetype == '.txt'
    write_export(ex, out + "/pq")
    assert spark.read.parquet(out + "/pq").first().content == 'a,"b"\nc'
    docs = spark.createDataFrame([("r", '{"b":1,"a":"é"}')], "report string, document string")
    write_json_lines(docs, out + "/jl")
    assert spark.read.json(out + "/jl").first().report == "r"
    write_json_documents(docs, "document", out + "/pretty")
    text = spark.read.text(out + "/pretty", wholetext=True).first().value
    assert _json.loads(text) == {"b": 1, "a": "é"} and "\n  " in text
    with pytest.raises(FileNotFoundError):
        read_index(spark, out + "/no-such-index")
