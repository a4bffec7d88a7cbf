"""SimHash document fingerprints and radius search, in DataFrame operations only.

A document's terms are its words and pairs of neighbouring words (lower-cased); a term weighs as often as it occurs.
In scripts that do not separate words every character is a word.
Every term's 64-bit hash votes with its weight for or against each bit.  Fingerprints within a Hamming radius are
found through block tables: the bits are permuted so that each choice of ``BLOCKS - radius`` of ``BLOCKS`` blocks
stands in front once; two fingerprints that differ in at most ``radius`` bits agree in the whole front of some table.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved, wide_key

BITS = 64
_ALONE = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]"
WORDS = rf"\s+|(?<={_ALONE})(?=\S)|(?<=\S)(?={_ALONE})"
LANES = 0x0000000100000001      # bits k and k + 32 of a hash, counted in the two halves of one long


def fingerprints(texts: DataFrame) -> DataFrame:
    """(key, fp): the fingerprint of each key of ``texts`` (key, t), once; equal keys have equal texts.  A text without
    words has fingerprint 0."""
    # Votes are summed by key and task: copies in one task scale all votes alike, and every task's result is the same.
    words = texts.select("key", F.split(F.lower("t"), WORDS, -1).alias("w"), F.spark_partition_id().alias("task"))
    at = words.select("key", "task", "w", F.posexplode("w").alias("i", "x"))
    after = F.coalesce(F.get("w", F.col("i") + 1), F.lit(""))
    filled = F.col("x") != ""
    # The word and its pair with the next one vote together; blank edges of a text vote for nothing.
    both = at.select("key", "task", filled.alias("is"), F.xxhash64("x").alias("a"), F.xxhash64("x", after).alias("b"))

    def votes(k: int) -> Column:
        lane = lambda h: F.shiftrightunsigned(h, k).bitwiseAND(LANES)
        return F.sum(F.when(F.col("is"), lane("a") + lane("b")).otherwise(F.lit(0))).alias(f"s{k}")

    sums = both.groupBy("key", "task").agg(F.count_if("is").alias("n"), *[votes(k) for k in range(32)])

    def bit(k: int) -> Column:      # set if more than half of the 2 n votes are for it
        total = F.col(f"s{k}").bitwiseAND(0xFFFFFFFF) if k < 32 else F.shiftrightunsigned(f"s{k - 32}", 32)
        return F.when(total > F.col("n"), F.lit(1 << k if k < 63 else -(1 << 63)).cast("long")).otherwise(F.lit(0).cast("long"))

    fp = bit(0)
    for k in range(1, BITS):
        fp = fp.bitwiseOR(bit(k))
    return sums.select("key", fp.alias("fp")).groupBy("key").agg(F.min("fp").alias("fp"))


def likeness(a: Column, b: Column) -> Column:
    return F.lit(1.0) - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def within_radius(queries: DataFrame, items: DataFrame, radius: int = 3, blocks: int | None = None) -> DataFrame:
    """(query, item) fingerprints (long) of ``queries`` (fp) and ``items`` (fp) that differ in at most ``radius`` bits,
    each pair once; both inputs are taken as distinct.  ``blocks`` (``radius + 2``) sets the number of tables,
    C(blocks, radius), and their keys' width, about 64 * (blocks - radius) / blocks bits."""
    blocks = blocks or radius + 2
    cuts = [round(BITS * i / blocks) for i in range(blocks + 1)]
    masks = []
    for keep in combinations(range(blocks), blocks - radius):
        mask = sum(((1 << cuts[i + 1]) - 1) ^ ((1 << cuts[i]) - 1) for i in keep)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    tables = F.array(*[F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("front"))
                       for i, m in enumerate(masks)])
    side = lambda df, c: df.select(F.col("fp").alias(c), F.explode(tables).alias("x")).select(c, "x.t", "x.front")
    differ = F.bit_count(F.col("query").bitwiseXOR(F.col("item")))
    return (side(queries, "query").join(side(items, "item"), ["t", "front"]).where(differ <= radius)
            .select("query", "item").distinct())


def with_next(docs: DataFrame, id_col: str, text_col: str, buckets: int | None = None) -> DataFrame:
    """(id, t, next) with the text of the next row in order of id (ties by text; after the last the first).  Rows are
    dealt by ranges of ids from approximate quantiles; a range's last row takes the first of the next range that has
    rows, found in a table of one row per range."""
    base = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    n = buckets or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = base.agg(F.percentile_approx("id", F.array(*[F.lit(i / n) for i in range(1, n)]), 10_000)).first()[0] if n > 1 else None
    bucket = F.lit(0)
    for c in sorted(set(cuts or [])):
        bucket = bucket + F.when(F.col("id") > c, 1).otherwise(0)
    ranged = base.withColumn("bucket", bucket)
    order = Window.partitionBy("bucket").orderBy("id", "t")
    inside = ranged.withColumn("next", F.lead("t").over(order))
    low = ranged.groupBy("bucket").agg(F.min("id").alias("low"), F.max(F.col("id").isNull()).alias("none"))
    is_low = F.when(F.col("none"), F.col("id").isNull()).otherwise(F.col("id") == F.col("low"))
    # One row per range: its size is the number of ranges.
    first = saved(ranged.join(F.broadcast(saved(low)), "bucket").where(is_low).groupBy("bucket").agg(F.min("t").alias("start")))
    ring = Window.orderBy("bucket")         # one row per range
    follow = first.select("bucket", F.coalesce(F.lead("start").over(ring), F.first("start").over(ring)).alias("follow"))
    return (inside.join(follow, "bucket")
            .select("id", "t", F.coalesce("next", "follow").alias("next")))


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 3,
                      query_step: int = 100) -> DataFrame:
    """(id_col, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_near) per row.

    The edited text has its last floor(n / 2) code points replaced by the first as many of the next document (by id,
    ties by text; the last one's next is the first).  ``n_near``: for rows whose id is divisible by ``query_step``,
    how many other rows have a fingerprint within ``radius`` bits; else null.  Null texts are empty, with fingerprint
    0; equal texts have equal fingerprints; repeated rows and ids keep a row each; an empty table gives an empty
    result; other columns are not carried."""
    half = F.floor(F.char_length("t") / 2).cast("int")
    rows = (with_next(docs, id_col, text_col).withColumn("n", F.char_length("t"))
            .withColumn("edited", F.concat(F.substring("t", F.lit(1), F.col("n") - half), F.substring("next", F.lit(1), half))))
    keyed = rows.select("id", "n", wide_key(F.col("t")).alias("tk"), wide_key(F.col("edited")).alias("ek"),
                        wide_key(F.col("next")).alias("nk"), F.sha2("edited", 256).alias("sha"))
    pair = lambda c: F.struct(wide_key(F.col(c)).alias("key"), F.col(c).alias("t"))
    fps = saved(fingerprints(rows.select(F.explode(F.array(pair("t"), pair("edited"))).alias("x")).select("x.*")))
    for key, name in (("tk", "fp"), ("ek", "edited_fp"), ("nk", "next_fp")):
        keyed = keyed.join(fps.select(F.col("key").alias(key), F.col("fp").alias(name)), key)
    keyed = saved(keyed.select("id", "n", "sha", "fp", "edited_fp", "next_fp"))
    items = keyed.groupBy("fp").count()
    asked = F.pmod("id", F.lit(query_step)) == 0
    near = (within_radius(keyed.where(asked).select("fp").distinct(), items.select("fp"), radius)
            .join(items.withColumnRenamed("fp", "item"), "item").groupBy("query").agg((F.sum("count") - 1).alias("n_near")))
    hexed = lambda c: F.lower(F.lpad(F.hex(c), 16, "0"))
    return (keyed.join(near, (F.col("fp") == F.col("query")) & asked, "left")
            .select(F.col("id").alias(id_col), F.col("n").cast("long").alias("n_chars"), F.col("sha").alias("edited_sha256"),
                    hexed("fp").alias("fingerprint"), hexed("edited_fp").alias("edited_fingerprint"),
                    likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"), likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
                    "n_near"))
