"""Registered plans: file manifest and routing, incremental ingest stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.blocks import block_table
from ..session import scratch_path
from ..sources.files import SUPPORTED_TYPES, file_manifest
from ..streaming.ingest import read_ingested, start_ingest
from .blocks import BLOCKS_SQL
from .registry import register, table


# The correctness check runs at the sf0.01 folder; DuckDB lists the same files with read_blob.
MANIFEST_SQL_DIR = "/root/testdata/sf0.01"


@register("file_manifest", f"""
WITH f AS (SELECT filename, size, lower(regexp_extract(filename, '(\\.[^./]+)$', 1)) AS ext
           FROM read_blob('{MANIFEST_SQL_DIR}/*'))
SELECT regexp_extract(filename, '([^/]+)$', 1) AS name, size AS length, ext AS filetype,
       CASE WHEN ext = '.doc' THEN '.docx' ELSE ext END AS reader,
       (CASE WHEN ext = '.doc' THEN '.docx' ELSE ext END) IN ({", ".join(f"'{t}'" for t in SUPPORTED_TYPES)}) AS supported
FROM f""")
def q_file_manifest(spark, sf_dir):
    """Files of the data folder with size, type and reader routing (contents are never read)."""
    m = file_manifest(spark, sf_dir)
    return m.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), "length", "filetype", "reader",
                    "supported")


CONV_SCHEMA = "conv_id long, turn long, role string, text string"


@register("stream_append", f"WITH {BLOCKS_SQL} SELECT * FROM blocks")
def q_stream_append(spark, sf_dir):
    """The conversations table, one file or a folder of files, ingested by a file-source stream (available-now trigger)
    into the block table; the appended table equals the batch block table."""
    out = scratch_path(spark, "ingest")

    def to_blocks(batch, batch_id):
        name = F.concat(F.lit("/chats/conv_"), F.col("conv_id").cast("string"), F.lit(".txt"))
        return block_table(batch, filename=name, content=F.col("text"), content_type=F.col("role"),
                           order_index=F.col("turn"), ingest_seq=F.lit(batch_id))

    # A glob that only the table matches: a stream takes a plain path for a folder, a glob for a file or a folder.
    q = start_ingest(spark, f"{sf_dir}/{{conversations.parquet}}", CONV_SCHEMA, to_blocks, out)
    q.awaitTermination()
    return read_ingested(spark, out).select("filename", "filetype", "content", "content_type", "order_index",
                                            "ingest_seq")


# File names as users write them: every kind of extension, and paths that are relative or not normal.
_NAME_SQL = """CASE doc_id % 4 WHEN 0 THEN '/corpus//' || source || '/./' WHEN 1 THEN '/corpus/x/../' || source || '/' WHEN 2 THEN '../' || source || '//y/../'
  ELSE './' || source || '/' END || 'doc_' || doc_id || CASE doc_id % 9 WHEN 0 THEN '.PDF' WHEN 1 THEN '.docx' WHEN 2 THEN '.doc' WHEN 3 THEN '.pptx'
  WHEN 4 THEN '.Xlsx' WHEN 5 THEN '.csv' WHEN 6 THEN '.txt' WHEN 7 THEN '.tar.gz' ELSE '' END"""


@register("route_names", """
WITH n AS (SELECT doc_id, CASE WHEN doc_id % 4 < 2 THEN '/corpus/' WHEN doc_id % 4 = 2 THEN '/home/' ELSE '/home/in/' END || source || '/doc_' || doc_id AS stem,
  ['.PDF', '.docx', '.doc', '.pptx', '.Xlsx', '.csv', '.txt', '.tar.gz', ''][CAST(doc_id % 9 AS INTEGER) + 1] AS ext,
  ['.pdf', '.docx', '.docx', '.pptx', '.xlsx', '.csv', '.txt', '.gz', ''][CAST(doc_id % 9 AS INTEGER) + 1] AS reader FROM documents)
SELECT doc_id, stem || ext AS path, CASE WHEN ext = '.doc' THEN '.doc' ELSE reader END AS filetype, reader,
       reader IN ('.pdf', '.docx', '.pptx', '.xlsx', '.csv') AS supported FROM n""")
def q_route_names(spark, sf_dir):
    """Routing of file names held in a table: absolute normal path, type, reader, and whether it is supported."""
    from ..sources.files import route_names

    names = table(spark, sf_dir, "documents").select("doc_id", F.expr(_NAME_SQL).alias("name"))
    return route_names(names, "name", base="/home/in")[0].drop("name")


@register("index_versions", """
SELECT row_number() OVER (ORDER BY vec_id % 3, vec_id) - 1 AS doc_id, CAST(vec_id AS VARCHAR) AS text, CAST(vec_id % 3 + 1 AS INTEGER) AS version
FROM embeddings WHERE vec_id % 3 < 2""")
def q_index_versions(spark, sf_dir):
    """A vector index grown by three appends, read as it was at its second version: ids go on from version to version."""
    from ..session import scratch_path
    from ..sources.index import append_index, read_version

    path = scratch_path(spark, "growing")
    emb = table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("string").alias("text"), "embedding", "vec_id")
    for part in range(3):
        append_index(emb.where(F.col("vec_id") % 3 == part), path, ["vec_id"])
    return read_version(spark, path, 2).select("doc_id", "text", "version")
