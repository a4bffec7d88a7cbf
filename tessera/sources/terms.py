"""A persisted term index: postings (term, filename, part, tf) bucketed by term.

The text of a block table is read once: term counts are taken inside a row, and only counts are shuffled, once, by
term.  Later reads by term (document frequencies, joins with query terms) find the postings bucketed and sorted by it
and need no exchange on their side.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import first_line, rest_lines, tokens
from ..operators.common import spread
from ..operators.retrieve import heaviest_counted, row_counts as counted_rows, score_parts, top_terms
from ..session import scratch_path

PARTS = ("name", "title", "body")
# Postings of a bucket, on average: few enough to be summed and sorted in a task's memory.
BUCKET_ROWS = 1_000_000


def row_counts(rows: DataFrame, keep: list[str], terms: Column) -> DataFrame:
    """(*keep, term, tf) of every row's terms, counted inside the row."""
    return counted_rows(rows, keep, terms).select(*keep, F.inline("_e").alias("term", "tf"))


def write_postings(blocks: DataFrame, buckets: int | None = None, tokenizer: Callable[[Column], Column] = tokens,
                   path: str | None = None) -> str:
    """Index a block table and return the name of the postings' table, in the session's catalog, stored under ``path``
    (below the checkpoint folder by default).

    A file's name terms, the terms of its title (first line of its order-0 block; the last ingest's) and those of its
    body (everything else, all blocks) are posted as parts name, title and body.  Blank and null contents post no
    title or body; null file names are left out.  ``tf`` is the term's count in the part (1 for name terms).

    The counts of every block's parts stand beside the postings as table ``<name>_files``, whose rows (filename, part,
    seq, _e) serve what is asked by file.  Without ``buckets`` their number grows with the postings."""
    spark = blocks.sparkSession
    name = f"postings_{uuid.uuid4().hex[:12]}"
    first = F.col("order_index") == 0
    content = F.coalesce("content", F.lit(""))
    part = lambda name, seq, text: F.struct(F.lit(name).alias("part"), seq.cast("long").alias("seq"), text.alias("text"))
    text = [part("name", F.lit(0), F.col("filename")), part("title", F.when(first, F.col("ingest_seq")), first_line("content")),
            part("body", F.lit(0), F.when(first, rest_lines("content")).otherwise(content))]
    rows = (spread(blocks).where("filename is not null")
            .select("filename", F.explode(F.filter(F.array(*text), lambda x: x["seq"].isNotNull())).alias("_p")).select("filename", "_p.*"))
    terms = F.coalesce(tokenizer(F.col("text")), F.array().cast("array<string>"))
    counted_rows(rows, ["filename", "part", "seq"], terms).write.option("path", scratch_path(spark, "counts")).saveAsTable(f"{name}_files")
    counts = spark.table(f"{name}_files")
    # Every title has a row, so that a last title without terms still replaces an earlier one.
    last = counts.where("part = 'title'").groupBy(F.col("filename").alias("_file")).agg(F.max("seq").alias("_last"))
    titles = counts.where("part = 'title'").join(last, (F.col("filename") == F.col("_file")) & (F.col("seq") == F.col("_last")), "left_semi")
    posted = counts.where("part <> 'title'").unionAll(titles).select("filename", "part", F.inline("_e").alias("term", "tf"))
    n = buckets or max(int(spark.conf.get("spark.sql.shuffle.partitions")), (counts.select(F.sum(F.size("_e"))).first()[0] or 0) // BUCKET_ROWS, 1)
    # Dealt by term once: the sum over a file's blocks and the buckets use the same exchange.
    posted = posted.repartition(n, "term").groupBy("term", "filename", "part").agg(F.sum("tf").alias("_tf"))
    posted = posted.select("term", "filename", "part", F.when(F.col("part") == "name", F.lit(1).cast("long")).otherwise(F.col("_tf")).alias("tf"))
    posted.write.bucketBy(n, "term").sortBy("term").option("path", path or scratch_path(spark, "postings")).saveAsTable(name)
    return name


def posted_weights(spark: SparkSession, name: str, part: str = "body") -> DataFrame:
    """(filename, term, tf, df, weight) of a part's postings, weight = tf * ln(N / df), N = files with a term in the part.

    Document frequencies are counted and joined back by term inside the buckets: no exchange of postings."""
    rows = spark.table(name).where(F.col("part") == part).select("term", "filename", "tf")
    files = spark.table(name).where(F.col("part") == part).select(F.countDistinct("filename")).scalar()
    df = rows.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return rows.join(df.hint("merge"), "term").withColumn("weight", F.col("tf") * F.log(files.cast("double") / F.col("df")))


def heaviest_body(spark: SparkSession, name: str, k: int) -> DataFrame:
    """(filename, term, weight, rank): the ``k`` heaviest body terms of every file, from the counts stored by file and the
    frequencies in the buckets; no posting is shuffled by file (see ``retrieve.term_candidates``)."""
    counts = spark.table(f"{name}_files").where("part = 'body'").select("filename", "_e")
    df = spark.table(name).where("part = 'body'").groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return heaviest_counted(counts, "filename", k, df)


def index_topk(spark: SparkSession, name: str, k: int = 20, part: str = "body") -> DataFrame:
    """(filename, rank, term, weight): the ``k`` heaviest terms of every file."""
    top = heaviest_body(spark, name, k) if part == "body" else top_terms(posted_weights(spark, name, part), "filename", k)
    return top.select("filename", "rank", "term", F.round("weight", 6).alias("weight"))


def index_retrieve(spark: SparkSession, name: str, queries: DataFrame, threshold: float = 0.5, query_id: str = "query_id",
                   query_text: str = "text", top_k_terms: int = 20, tokenizer: Callable[[Column], Column] = tokens) -> DataFrame:
    """Keyword retrieval (see ``retrieve.keyword_retrieve``) from the index; no text of the files is read."""
    if threshold < 0:
        raise ValueError("threshold must be >= 0 (a negative threshold would select every file)")
    short = spark.table(name).where(F.col("part") != "body").select("filename", "part", "term")
    body = heaviest_body(spark, name, top_k_terms).select("filename", F.lit("body").alias("part"), "term")
    return score_parts(short.unionByName(body), queries, threshold, query_id, query_text, lambda c: F.array_distinct(tokenizer(c)))
