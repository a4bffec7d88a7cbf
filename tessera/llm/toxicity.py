"""Toxicity scores from a linear classifier over character n-grams, scaled by naive Bayes log-count ratios.

A text is the set of its character n-grams of lengths 3 to 6 (lower case, white space as one kind of space, a space at
both ends), hashed into a fixed number of features.  In the labelled rows every feature has a log-count ratio: the
log of its share of the toxic documents over its share of the others.  A logistic regression learns one weight for
each ratio, so a feature enters a score as weight x ratio and features that tell nothing are nearly silent from the
start.  Learning reads a bounded sample of labelled rows; scoring reads whole texts, on the executors.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ORDERS = (3, 4, 5, 6)       # lengths of the n-grams
BITS = 20                   # 2**BITS features
BLOCK = 1 << 20             # characters of a text that are hashed at a time
MIN_DOCS = 5                # sampled documents that hold a feature at least
MIN_RATIO = 1.0             # features with a smaller log-count ratio (either way) are left out
HALVES = 0.5                # the score from which a document counts as toxic


def hashed(codes):
    """Feature numbers of every n-gram of ``codes`` (code points), repeats included; one array for each length."""
    out = []
    h = np.zeros(len(codes), np.uint32)
    for n in range(1, max(ORDERS) + 1):
        if n > len(codes):
            break
        h = h[:len(codes) - n + 1] * np.uint32(0x01000193) + codes[n - 1:] + np.uint32(1)
        if n in ORDERS:
            mixed = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D + 2 * n)
            out.append(mixed >> np.uint32(32 - BITS))
    return out


def blocks(text: str | None):
    """The code points of a text in blocks that overlap by the longest n-gram less one character."""
    codes = np.frombuffer(f" {' '.join((text or '').lower().split())} ".encode("utf-32-le", "replace"), np.uint32)
    for at in range(0, max(1, len(codes) - max(ORDERS) + 1), BLOCK):
        yield codes[at:at + BLOCK + max(ORDERS) - 1]


def feature_set(text: str | None, wanted=None):
    """The distinct features of a whole text; with ``wanted`` (booleans by feature) only those."""
    found = []
    for codes in blocks(text):
        for f in hashed(codes):
            f = f if wanted is None else f[wanted[f]]
            if len(f):
                found.append(np.unique(f))
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint32)


def log_count_ratios(sets, labels):
    """(ratio by feature, documents by feature): log of smoothed shares of the documents of either label."""
    y = np.asarray(labels, bool)
    held = []
    for side in (False, True):
        rows = [s for s, t in zip(sets, y, strict=True) if t == side]
        held.append(np.bincount(np.concatenate([np.zeros(0, np.uint32), *rows]), minlength=1 << BITS))
    share = [(n + 1.0) / (np.sum(y == side) + 2.0) for side, n in zip((False, True), held, strict=True)]
    return np.log(share[1] / share[0]), held[0] + held[1]


def train(texts: list[str], labels: list[int], toxic_share: float, rounds: int = 150, penalty: float = 0.2) -> dict:
    """{"weight" by feature, "bias"}: logistic regression on the ratios of the features that a document holds.

    ``toxic_share`` is the share of toxic rows among all labelled rows; the samples of the two labels weigh as their
    shares do, the rarer at least a quarter.  Gradient steps with momentum over the whole sample; the same input gives
    the same weights.  Without rows of both labels no feature is learned and every score is that share."""
    if len(set(labels)) < 2:
        edge = float(np.log((toxic_share + 1e-9) / (1 - toxic_share + 1e-9)))
        return {"weight": np.zeros(1 << BITS, np.float32), "bias": edge}
    prior = min(0.75, max(0.25, toxic_share))
    sets = [feature_set(t) for t in texts]
    y = np.asarray(labels, float)
    ratio, docs = log_count_ratios(sets, labels)
    wanted = (docs >= MIN_DOCS) & (np.abs(ratio) >= MIN_RATIO)
    sets = [s[wanted[s]] for s in sets]
    size = np.array([len(s) for s in sets])
    column = np.concatenate([np.zeros(0, np.uint32), *sets]).astype(np.int64)
    row = np.repeat(np.arange(len(sets)), size)
    used, column = np.unique(column, return_inverse=True)
    value = ratio[used][column]
    share = np.where(y == 1, prior / max(1, (y == 1).sum()), (1 - prior) / max(1, (y == 0).sum()))
    weight, bias = np.zeros(len(used)), np.log(prior / (1 - prior))
    speed, speed_bias = np.zeros(len(used)), 0.0
    # A step bound by the largest curvature that the data can show.
    squares = np.bincount(row, value * value, minlength=len(sets)) + 1.0
    rate = 1.0 / (0.25 * float((share * squares).sum()) * 4 + penalty / len(sets))
    for i in range(rounds):
        ahead, ahead_bias = weight + 0.9 * speed, bias + 0.9 * speed_bias
        z = np.bincount(row, value * ahead[column], minlength=len(sets)) + ahead_bias
        gap = share * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
        slope = np.bincount(column, value * gap[row], minlength=len(used)) + penalty / len(sets) * ahead
        speed, speed_bias = 0.9 * speed - rate * slope, 0.9 * speed_bias - rate * gap.sum()
        weight, bias = weight + speed, bias + speed_bias
    out = np.zeros(1 << BITS, np.float32)
    out[used] = weight * ratio[used]
    return {"weight": out, "bias": float(bias)}


def score_text(model: dict, wanted, text: str | None) -> float:
    """The probability that a whole text is toxic; ``wanted`` marks the features with a weight."""
    z = model["bias"] + float(model["weight"][feature_set(text, wanted)].sum(dtype=np.float64))
    return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def held_out(id_col: str = "doc_id"):
    """The rows kept from learning: those whose crc32 of the id as text is 0 modulo 5."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        per_label: int = 1500) -> dict:
    """A classifier trained on whole texts of at most ``per_label`` documents of each label (those with the smallest hash
    of their id).  Null labels, and labels of unknown documents, are left out; a document with both labels is toxic;
    rows that share an id train one by one."""
    marked = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
              .groupBy(F.col(id_col).alias("_id")).agg(F.max(F.col(label_col).cast("int")).alias("_toxic"))
              .join(docs.select(F.col(id_col).alias("_id")).distinct(), "_id", "left_semi"))
    share = marked.agg(F.avg(F.col("_toxic").cast("double"))).first()[0]
    if share is None:
        return train([], [], 0.0)
    by_hash = [F.xxhash64(F.lit(17), F.col("_id").cast("string")), F.col("_id")]
    sample = None
    for toxic in (0, 1):
        part = marked.where(F.col("_toxic") == toxic).orderBy(*by_hash).limit(per_label)
        sample = part if sample is None else sample.unionAll(part)
    rows = (docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
            .join(F.broadcast(sample), "_id").orderBy(*by_hash, "_text").select("_text", "_toxic").toArrow())
    return train(rows["_text"].to_pylist(), rows["_toxic"].to_pylist(), share)


def score(docs: DataFrame, model: dict, text_col: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(*carry, score, predicted): the probability of a toxic label for every whole text, and 1 from ``HALVES`` on.

    Null, empty and blank texts score alike (their n-grams are none).  Repeated rows keep a row each; an empty table
    gives an empty result; only the ``carry`` columns are carried, under their names, so others cannot clash."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = docs.select(*carry).schema

    def run(batches):
        import pyarrow as pa

        model = shared.value
        wanted = model["weight"] != 0
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                scores = [score_text(model, wanted, t) for t in part.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[1:], pa.array(scores, pa.float64()), pa.array([int(s >= HALVES) for s in scores], pa.int32())],
                    names=[*carry, "score", "predicted"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    return docs.select(F.col(text_col).cast("string").alias("_text"), *carry).mapInArrow(run, f"{kinds}, score double, predicted int")
