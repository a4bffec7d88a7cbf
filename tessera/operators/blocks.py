"""Block table (one row per text or table block of a file) and the text views built from it.

Block table schema: ``filename, filetype, content, content_type, order_index, ingest_seq`` (+ ``ingested_at`` when
asked).  ``ingest_seq`` numbers ingest calls/batches; together with ``filename`` it identifies one ingest of a file,
and ``(ingest_seq, order_index)`` is the append order inside a file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import formats as fmt
from ..functions.text import cr_normalize, iso_now, py_strip, split_lines
from .common import fill_template, ordered_concat

BLOCK_COLUMNS = ["filename", "filetype", "content", "content_type", "order_index", "ingest_seq"]


def block_table(rows: DataFrame, filename: Column, content: Column, content_type: Column, order_index: Column,
                filetype: Column | None = None, ingest_seq: Column | None = None,
                with_time: bool = False) -> DataFrame:
    """Shape raw block tuples into the block table.

    Blank blocks (after a Unicode strip) are dropped, kept ones are stripped; ``order_index`` keeps its gaps.  The
    file type defaults to the lower-cased extension of the file name.  ``with_time`` adds one ingest timestamp per
    query (``current_timestamp()`` is evaluated once per query) as ``ingested_at`` and as ISO text ``timestamp``.
    """
    if filetype is None:
        filetype = F.lower(F.regexp_extract(filename, r"(\.[^./]+)$", 1))
    if ingest_seq is None:
        ingest_seq = F.lit(0).cast("long")
    out = rows.select(
        filename.alias("filename"), filetype.alias("filetype"), py_strip(content).alias("content"),
        content_type.alias("content_type"), order_index.cast("int").alias("order_index"),
        ingest_seq.cast("long").alias("ingest_seq"),
    ).where(F.col("content") != "")
    if with_time:
        out = out.withColumn("ingested_at", F.current_timestamp()).withColumn("timestamp", iso_now())
    return out


def prompt_corpus(blocks: DataFrame, header: str = fmt.FILE_HEADER, row: str = fmt.CORPUS_ROW,
                  strip_result: bool = False) -> DataFrame:
    """Per file: header, then one ``type/content`` row per block in append order -> ``(filename, corpus)``.

    One row per file, never one corpus-wide string; concatenate at the edge if a single text is needed (files in
    name order).
    """
    piece = fill_template(row, content_type=py_strip(F.col("content_type")), content=py_strip(F.col("content")))
    body = ordered_concat(blocks, ["filename"], ["ingest_seq", "order_index"], piece, "body")
    text = F.concat(fill_template(header, filename=F.col("filename")), F.col("body"))
    if strip_result:
        text = py_strip(text)
    return body.select("filename", text.alias("corpus"))


def file_text(blocks: DataFrame, header: str = fmt.STORE_HEADER, row: str = fmt.STORE_ROW) -> DataFrame:
    """Whole-store text per file; the row label prints the *file type* (kept as in the source system)."""
    piece = fill_template(row, filetype=F.col("filetype"), content=F.col("content"))
    body = ordered_concat(blocks, ["filename"], ["ingest_seq", "order_index"], piece, "body")
    return body.select("filename", F.concat(fill_template(header, filename=F.col("filename")),
                                            F.col("body")).alias("text"))


def retrieval_record(blocks: DataFrame, path_col: str = "filename", header: str = fmt.FILE_HEADER,
                     row: str = fmt.RECORD_ROW) -> DataFrame:
    """One record per ingest call ``(filename, ingest_seq)``: the text that is embedded for vector retrieval."""
    piece = fill_template(row, content_type=F.col("content_type"), content=F.col("content"))
    body = ordered_concat(blocks.withColumn("_path", F.col(path_col)), ["filename", "ingest_seq", "_path"],
                          ["order_index"], piece, "body")
    return body.select("filename", "ingest_seq",
                       F.concat(fill_template(header, filename=F.col("_path")), F.col("body")).alias("record"))


def preview(blocks: DataFrame, max_lines: int = -1) -> DataFrame:
    """Per block: the file's first file type, and the first ``max_lines`` lines (all when ``max_lines <= 0``)."""
    first_type = blocks.groupBy("filename").agg(
        F.min_by("filetype", F.struct("ingest_seq", "order_index")).alias("file_filetype"))
    lines = split_lines(py_strip(F.col("content")))
    if max_lines > 0:
        lines = F.slice(lines, 1, max_lines)
    return (blocks.join(first_type, "filename")
            .select("filename", "file_filetype", "content_type", "order_index", "ingest_seq",
                    F.array_join(lines, fmt.PREVIEW_JOIN).alias("preview")))


def export_clean(blocks: DataFrame) -> DataFrame:
    """Export view: carriage-return forms normalised to ``\\n``, all block columns kept."""
    cols = [cr_normalize(F.col("content").cast("string")).alias("content") if c == "content" else F.col(c)
            for c in blocks.columns]
    return blocks.select(*cols)


# Rule for text that arrives without a paragraph numbering property: "1.", "1、", "1)", "(1)", "一、", or a bullet.
NUMBERED_RULE = r"^(\(?\d+[.、)）]|[一二三四五六七八九十]+、|[•·\-*]\s)"


def paragraphs(docs: DataFrame, id_col: str, text_col: str, numbered: Column | None = None,
               tag: str = fmt.NUMBERED_TAG, rule: str = NUMBERED_RULE) -> DataFrame:
    """Document text -> paragraphs ``(id, para_no, text, is_numbered)``: lines stripped, blank ones dropped,
    numbered ones prefixed with ``tag``.  ``numbered`` may be an input flag column per paragraph; by default the
    flag comes from ``rule`` on the stripped text."""
    exploded = docs.select(F.col(id_col), F.posexplode(F.split(F.col(text_col), "\n")).alias("para_no", "raw"))
    stripped = exploded.withColumn("text", py_strip(F.col("raw"))).where(F.col("text") != "")
    flag = numbered if numbered is not None else F.col("text").rlike(rule)
    return stripped.select(
        id_col, "para_no", flag.alias("is_numbered"),
        F.when(flag, F.concat(F.lit(tag), F.col("text"))).otherwise(F.col("text")).alias("text"))


def join_paragraphs(paras: DataFrame, id_col: str) -> DataFrame:
    """Paragraphs joined by ``\\n`` in order: the document's single text block."""
    return ordered_concat(paras, [id_col], ["para_no"], F.col("text"), "text", sep="\n")


def merged_pages(pages: DataFrame, file_col: str, page_col: str, text_col: str) -> DataFrame:
    """Page texts of a file joined by ``\\n`` (pages without text are skipped), then line-break repair."""
    from ..functions.text import repair_line_breaks

    kept = pages.where(F.col(text_col).isNotNull() & (F.col(text_col) != ""))
    merged = ordered_concat(kept, [file_col], [page_col], F.col(text_col), "merged", sep="\n")
    return merged.select(file_col, repair_line_breaks(F.col("merged")).alias("text"))


def dense_order(df: DataFrame, partition: list[str], order: list[str], out: str = "order_index") -> DataFrame:
    """0-based ordinal inside each group (for block sources that carry positions with gaps); a file with very many
    blocks is numbered across many tasks (``ordinal_within``)."""
    from .common import row_number_within

    return row_number_within(df, partition, order, out="_ord").withColumn(out, (F.col("_ord") - 1).cast("int")) \
        .drop("_ord")
