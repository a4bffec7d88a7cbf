"""Vector index persistence: ``(doc_id, text, embedding, dim)`` as parquet.

The dimension is stored per row and checked on write (every vector must have the same length, fixed by the data);
loading a missing path raises ``FileNotFoundError`` before Spark is asked.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.common import ordinal_within


def write_index(index: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write ``(doc_id, text, embedding)``; the rows carry ``dim`` and a mixed dimension fails the job."""
    checked = index.select("doc_id", "text", "embedding", F.size("embedding").alias("dim"))
    # The check comes first (one partial aggregate over the lengths), so a bad index never replaces a good one.
    if checked.agg(F.countDistinct("dim").alias("n")).first()["n"] > 1:
        raise ValueError("vectors of different dimensions in one index")
    checked.write.mode(mode).parquet(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Load an index written by ``write_index``."""
    try:
        return spark.read.parquet(path)
    except Exception as e:  # AnalysisException: PATH_NOT_FOUND
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            raise FileNotFoundError(f"index not found: {path}") from e
        raise


# ------------------------------------------------------------------------------------------------------ growing index
def index_versions(spark: SparkSession, path: str) -> DataFrame:
    """(version, first_id, items, dim): the committed appends of a growing index; a missing index has none."""
    schema = "version int, first_id long, items long, dim int"
    try:
        return spark.read.schema(schema).parquet(f"{path}/versions/*")
    except Exception as e:  # AnalysisException: PATH_NOT_FOUND
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            return spark.createDataFrame([], schema)
        raise


def append_index(rows: DataFrame, path: str, order: list[str]) -> int:
    """Append ``(text, embedding)`` rows to the index under ``path`` and return the new version's number, from 1.

    Ids follow the stored counter: the rows get a dense range in ``order`` (rows equal in it in any order), dealt and
    numbered over many tasks.  The dimension is fixed by the first version; rows of another, or without a vector, are an
    error and add nothing.  The rows are written first and the version's record last, so a failed append leaves nothing
    that a reader sees, and its next try replaces what it wrote.  Appends run one at a time."""
    spark = rows.sparkSession
    last = index_versions(spark, path).agg(F.max("version"), F.max(F.col("first_id") + F.col("items")), F.max("dim")).first()
    version, first, dim = (last[0] or 0) + 1, last[1] or 0, last[2]
    items, low, high, missing = rows.agg(F.count(F.lit(1)), F.min(F.size("embedding")), F.max(F.size("embedding")), F.count_if(F.col("embedding").isNull())).first()
    if missing:
        raise ValueError("rows without a vector in an index")
    if items and (low != high or dim not in (None, high)):
        raise ValueError("vectors of different dimensions in one index")
    numbered = ordinal_within(rows.select(*dict.fromkeys(["text", "embedding", *order])), [], order, "_n")
    (numbered.select((F.col("_n") - 1 + first).cast("long").alias("doc_id"), "text", "embedding")
     .write.mode("overwrite").parquet(f"{path}/rows/version={version}"))
    record = spark.createDataFrame([(version, first, items, high if dim is None else dim)], "version int, first_id long, items long, dim int")
    record.coalesce(1).write.mode("overwrite").parquet(f"{path}/versions/{version}")
    return version


def read_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """(doc_id, text, embedding, version): a growing index as it was at ``version`` (the last by default).

    Only folders of committed versions up to that one are read; an index or version that does not exist raises
    ``FileNotFoundError``."""
    known = [r.version for r in index_versions(spark, path).select("version").collect()]
    if not known or version is not None and version not in known:
        raise FileNotFoundError(f"index version not found: {path}")
    wanted = [v for v in known if version is None or v <= version]
    return spark.read.option("basePath", f"{path}/rows").parquet(*[f"{path}/rows/version={v}" for v in sorted(wanted)])
