"""File sources and sinks: file manifest and type routing, CSV files as table blocks, JSON documents, exports."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd  # type hints of the pandas UDF below are resolved in this module
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.tables import serialize_tables

# Lower-cased extensions with a block reader, and the legacy type read as its successor.
SUPPORTED_TYPES = [".pdf", ".docx", ".pptx", ".xlsx", ".csv"]
TYPE_ALIASES = {".doc": ".docx"}


def _extension(path):
    return F.lower(F.regexp_extract(path, r"(\.[^./]+)$", 1))


def _route(path):
    ext = _extension(path)
    reader = ext
    for old, new in TYPE_ALIASES.items():
        reader = F.when(ext == old, F.lit(new)).otherwise(reader)
    return reader


def file_manifest(spark: SparkSession, path: str, recursive: bool = True, strict: bool = False,
                  supported: Sequence[str] = SUPPORTED_TYPES) -> DataFrame:
    """List files under ``path`` with their routing: ``(path, length, filetype, reader, supported)``.

    Uses the ``binaryFile`` source with only ``path`` and ``length`` selected, so file contents are never read.  The
    file type is the lower-cased extension (``.doc`` routes to the ``.docx`` reader).  Unsupported types are flagged;
    with ``strict=True`` the first one fails the job (``raise_error``), as an unknown type does at ingest.
    """
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
             .load(path).select("path", "length"))
    ext = _extension(F.col("path"))
    reader = _route(F.col("path"))
    ok = reader.isin(list(supported))
    out = files.select("path", "length", ext.alias("filetype"), reader.alias("reader"), ok.alias("supported"))
    if strict:
        out = out.withColumn("reader", F.when(F.col("supported"), F.col("reader")).otherwise(
            F.raise_error(F.concat(F.lit("Unsupported file type: "), F.col("filetype")))))
    return out


def route_names(names: DataFrame, path_col: str, strict: bool = False, supported: Sequence[str] = SUPPORTED_TYPES, base: str = "/"):
    """(routed, observation): the routing of file names held in a table.

    ``routed`` has every row's columns with path (absolute and normal), filetype, reader and supported; the same pass
    counts into the observation, whose ``get`` has ``kept`` and ``rejected`` after the first action.  With ``strict``
    the first unsupported type fails the job.  A null name has no type and is rejected."""
    from pyspark.sql import Observation

    from ..functions.text import normal_path

    path = normal_path(path_col, base)
    ext = F.coalesce(_extension(F.col("_path")), F.lit(""))
    ok = _route(F.col("_path")).isin(list(supported))
    routed = names.withColumn("_path", path).select(*[c for c in names.columns if c not in ("path", "filetype", "reader", "supported")], F.col("_path").alias("path"),
                                                    ext.alias("filetype"), F.coalesce(_route(F.col("_path")), F.lit("")).alias("reader"), F.coalesce(ok, F.lit(False)).alias("supported"))
    if strict:
        routed = routed.withColumn("reader", F.when(F.col("supported"), F.col("reader")).otherwise(
            F.raise_error(F.concat(F.lit("Unsupported file type: "), F.col("filetype")))))
    seen = Observation()
    return routed.observe(seen, F.count_if("supported").alias("kept"), F.count_if(~F.col("supported")).alias("rejected")), seen


def csv_blocks(spark: SparkSession, path: str, schema: str, group_col: str | None = None,
               order_col: str | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """CSV files -> one ``(0, 'table', csv text)`` block per file (or per ``group_col`` value, e.g. a partition
    folder).  Missing cells stay empty.  Rows are ordered by ``order_col`` (default: position in the file)."""
    df = spark.read.schema(schema).option("header", True).csv(path)
    if group_col is None:
        df = df.withColumn("filename", F.col("_metadata.file_path"))
        group_col = "filename"
    if order_col is None:
        df = df.withColumn("_row", F.monotonically_increasing_id())
        order_col = "_row"
    cols = list(columns) if columns else [c for c in df.columns if c not in (group_col, order_col, "_row")]
    out = serialize_tables(df, [group_col], [order_col], cols)
    return out.select(group_col, F.lit(0).alias("order_index"), F.lit("table").alias("content_type"), "content")


def read_json_documents(spark: SparkSession, path: str) -> DataFrame:
    """Whole JSON files as ``(path, text)``; parse with ``from_json`` against the schema you need (keeps key order
    when parsed to a map)."""
    return (spark.read.text(path, wholetext=True)
            .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")))


def write_json_lines(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON sink: one UTF-8 JSON object per line, non-ASCII kept as is, null fields written."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def pretty_json(col, indent: int = 2):
    """JSON text re-indented (``indent`` spaces, non-ASCII kept, key order kept) -- the human-readable document form.
    A small per-row helper in an Arrow-batched pandas UDF; use it at the edge, on finished documents."""
    import json

    def fmt(s: pd.Series) -> pd.Series:
        return s.map(lambda t: None if t is None else json.dumps(json.loads(t), ensure_ascii=False, indent=indent))

    return F.pandas_udf(fmt, "string")(F.col(col) if isinstance(col, str) else col)


def write_json_documents(df: DataFrame, doc_col: str, path: str, indent: int = 2, mode: str = "overwrite") -> None:
    """Indented JSON documents as UTF-8 text files (each document keeps its line breaks; files hold many
    documents, one after another)."""
    df.select(pretty_json(doc_col, indent).alias("value")).write.mode(mode).text(path)


def write_export(blocks: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Block table export partitioned by file type (csv with a header row, or parquet)."""
    w = blocks.write.mode(mode).partitionBy("filetype")
    if fmt == "csv":
        w.option("header", True).option("escape", '"').option("emptyValue", "") \
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    else:
        w.parquet(path)


# ------------------------------------------------------------------------------------------------ user decoders
BLOCK_ROW_SCHEMA = "path string, reader string, order_index int, content_type string, content string"


def decode_files(spark: SparkSession, path: str, decoders, recursive: bool = True) -> DataFrame:
    """Files -> raw block rows through per-type decoders: ``(path, reader, order_index, content_type, content)``.

    ``decoders`` maps a routed extension (see ``file_manifest``) to ``fn(bytes, path) -> [(order, type, text)]`` --
    the hook for document parsers (PDF, Word, slides, spreadsheets) that run per file.  Files are read with the
    ``binaryFile`` source and decoded in ``mapInPandas`` (Arrow batches, spread over the cluster); files without a
    decoder produce no rows (list them with ``file_manifest(..., strict=False)``).  Feed the result to
    ``operators.blocks.block_table``."""
    decoders = dict(decoders)
    # Routing is computed on the same scan (no join that would move file contents); narrow the files read with a
    # ``pathGlobFilter``-style path argument when most files have no decoder.
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(path)
             .select("path", "content", _route(F.col("path")).alias("reader"))
             .where(F.col("reader").isin(list(decoders))))

    def run(batches):
        for pdf in batches:
            out = []
            for p, reader, data in zip(pdf["path"], pdf["reader"], pdf["content"]):
                local = p[5:] if p.startswith("file:") else p
                for order, kind, text in decoders[reader](bytes(data), local):
                    out.append((local, reader, int(order), kind, text))
            yield pd.DataFrame(out, columns=["path", "reader", "order_index", "content_type", "content"])

    return files.mapInPandas(run, BLOCK_ROW_SCHEMA)
