"""CSV files read line by line in parallel, with quoted commas, quotes and line breaks.

A line break inside quotes does not end a record.  Whether a line starts inside quotes is the parity of all quote
characters before it in its file: a prefix sum over the lines of each split of the file plus the sum of the splits
before it.  So a file is read in splits, by any number of tasks, and no task needs more than one split's lines in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import written
from .common import ordered_concat

# The text between a cell's quotes, up to the first quote that is not doubled; without one, up to the last quote.  Both
# repetitions are possessive: the regex engine loops over them, where a greedy one takes stack for every character.
QUOTED = r'(?:[^"]++|"")*+(?=")|(?:[^"]++|""(?=[^"]*+"))*+(?=")'
# A cell up to the next comma outside quotes: quoted (quotes doubled inside) or plain.
CELL = rf'(?s)(?:^|,)("(?:{QUOTED})"[^,]*|[^,]*)'


def csv_lines(spark: SparkSession, path: str) -> DataFrame:
    """(filename, split, at, line): the lines of all files below ``path``, ``at`` ascending inside a split, written once."""
    rows = spark.read.option("recursiveFileLookup", "true").option("lineSep", "\n").text(path)
    return written(rows.select(F.col("_metadata.file_path").alias("filename"), F.col("_metadata.file_block_start").alias("split"),
                               F.monotonically_increasing_id().alias("at"), F.col("value").alias("line")), "lines")


def sum_before(rows: DataFrame, value: Column, out: str) -> DataFrame:
    """``rows`` with the sum of ``value`` over all earlier lines of the file: those of the split by a window, those of the
    earlier splits by a window over one row for each split."""
    lines = Window.partitionBy("filename", "split").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    splits = Window.partitionBy("filename").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_value", value)
    totals = rows.groupBy("filename", "split").agg(F.sum("_value").alias("_total"))
    totals = totals.select("filename", "split", F.coalesce(F.sum("_total").over(splits), F.lit(0)).alias("_before"))
    return (rows.withColumn("_inside", F.coalesce(F.sum("_value").over(lines), F.lit(0))).join(totals, ["filename", "split"])
            .withColumn(out, F.col("_inside") + F.col("_before")).drop("_value", "_inside", "_before"))


def csv_records(lines: DataFrame, quote: str = '"') -> DataFrame:
    """(filename, record_no, text): the records of every file from 0, line breaks inside quotes kept, blank records left
    out.  A carriage return that ends a record is dropped."""
    quotes = F.length("line") - F.length(F.replace("line", F.lit(quote), F.lit("")))
    placed = sum_before(lines, quotes.cast("long"), "_quotes").withColumn("_starts", (F.col("_quotes") % 2 == 0).cast("long"))
    numbered = sum_before(placed, F.col("_starts"), "_number").withColumn("_record", F.col("_number") + F.col("_starts") - 1)
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("split", "at", "line"))), lambda x: x["line"]), "\n")
    records = numbered.groupBy("filename", "_record").agg(F.regexp_replace(text, r"\r\z", "").alias("text"))
    return records.where("text <> ''").select("filename", F.col("_record").alias("record_no"), "text")


def csv_cells(text: Column) -> Column:
    """The cells of a record: quotes around a cell removed, doubled quotes inside it single."""
    plain = lambda c: F.when(c.startswith('"'), F.replace(F.regexp_extract(c, rf'(?s)^"({QUOTED})"', 1), F.lit('""'), F.lit('"'))).otherwise(c)
    return F.transform(F.regexp_extract_all(text, F.lit(CELL), 1), plain)


def csv_line(cells: Column) -> Column:
    """A record from its cells: a cell with a comma, quote or line break is quoted, quotes inside it doubled."""
    shown = lambda c: F.when(c.rlike(r'[,"\r\n]'), F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(c)
    return F.array_join(F.transform(cells, shown), ",")


def csv_rows(spark: SparkSession, path: str) -> DataFrame:
    """(filename, record_no, cells) of every record of all files below ``path``, the header first."""
    return csv_records(csv_lines(spark, path)).select("filename", "record_no", csv_cells(F.col("text")).alias("cells"))


def csv_maps(rows: DataFrame) -> DataFrame:
    """(filename, record_no, cells map<string,string>): every record after a file's first as header -> cell; missing cells
    are empty, cells beyond the header are named by their place from 1, of equal headers the last counts."""
    first = rows.groupBy("filename").agg(F.min_by("cells", "record_no").alias("header"), F.min("record_no").alias("_first"))
    n = F.greatest(F.size("header"), F.size("cells"))
    names = F.transform(F.sequence(F.lit(1), n), lambda i: F.coalesce(F.get("header", i - 1), i.cast("string")))
    values = F.transform(F.sequence(F.lit(1), n), lambda i: F.coalesce(F.get("cells", i - 1), F.lit("")))
    return (rows.join(first, "filename").where("record_no > _first")
            .select("filename", "record_no", F.map_from_arrays(names, values).alias("cells")))


def csv_file_blocks(spark: SparkSession, path: str) -> DataFrame:
    """One (0, 'table', CSV text) block for each file below ``path``: header and records, quoted only where needed.

    Cells keep their text; a header-only file gives its header; records shorter than the header are filled with empty
    cells; a file without lines gives no block."""
    rows = csv_rows(spark, path)
    width = rows.groupBy("filename").agg(F.size(F.min_by("cells", "record_no")).alias("_width"))
    missing = F.greatest(F.col("_width") - F.size("cells"), F.lit(0))
    full = rows.join(width, "filename").withColumn("cells", F.concat("cells", F.array_repeat(F.lit(""), missing)))
    text = ordered_concat(full, ["filename"], ["record_no"], csv_line(F.col("cells")), "content", sep="\n")
    return text.select("filename", F.lit(0).alias("order_index"), F.lit("table").alias("content_type"), F.concat("content", F.lit("\n")).alias("content"))
