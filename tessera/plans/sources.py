"""How the test tables become the inputs of the operators (block tables, query sets, vector sets)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.blocks import block_table
from .registry import table


def document_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document is one file with a single text block at order 0, under a folder named after its source."""
    docs = table(spark, sf_dir, "documents")
    name = F.concat(F.lit("/corpus/"), F.col("source"), F.lit("/doc_"), F.col("doc_id").cast("string"), F.lit(".txt"))
    return block_table(docs, filename=name, content=F.col("text"), content_type=F.lit("text"),
                       order_index=F.lit(0))


def conversation_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each conversation is one file; a turn is a block (order = turn number), the role is its content type."""
    conv = table(spark, sf_dir, "conversations")
    name = F.concat(F.lit("/chats/conv_"), F.col("conv_id").cast("string"), F.lit(".txt"))
    return block_table(conv, filename=name, content=F.col("text"), content_type=F.col("role"),
                       order_index=F.col("turn"))


def benchmark_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")
