"""Alignment of two tokenizers' tokens over the same bytes.

Both tokenizers cut a text into tokens; the byte offsets where tokens end are two ascending lists.  The shorter list
drives a galloping search (exponential steps, then binary) into the longer: the common offsets cut both token lists
into groups, and the ranks of a token's start and end in the other list give the range of tokens that it overlaps.

Where both tokenizers are known to open a token (a space between two other characters, a mark behind a letter, a line
break) a text is cut; every distinct part is encoded once by a worker, many parts are aligned at a time, and a bounded
number is remembered, so a text is the sequence of its parts' groups.  Link counts of the corpus are summed inside
tasks before they are shuffled; the table of counts goes to the executors in blocks of at most ``BLOCK_PAIRS`` id pairs,
as many passes as that takes, so its size never depends on the corpus.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved

CACHE_CHUNKS = 150_000          # chunks, and parts of chunks, that a worker remembers (about 100 MB together)
BLOCK_PAIRS = 2_000_000         # id pairs of one broadcast (17 bytes each)
TASK_PAIRS = 200_000            # id pairs that a task counts before it passes them on

# A space that opens a token in both tokenizers: it stands between two characters that are no white space.
_TOUCHING = re.compile(r"\s | \s")
_OPENS = re.compile(r"(?<=\S) (?=\S)")


def gallop(ends, values, low):
    """The rank of each of ``values`` in ascending ``ends``, none of whose first ``low`` (one number for each value)
    reach it: exponential steps from ``low``, then binary search in the last step, for all values at once."""
    low, n = np.array(low, np.int64), len(ends)
    high, step = low.copy(), np.ones(len(low), np.int64)
    going = np.flatnonzero(high < n)
    while len(going := going[ends[high[going]] < values[going]]):
        low[going] = high[going] + 1
        high[going] += step[going]
        step[going] *= 2
        going = going[high[going] < n]
    np.minimum(high, n, out=high)
    while len(open_ := np.flatnonzero(low < high)):
        middle = (low[open_] + high[open_]) // 2
        less = ends[middle] < values[open_]
        low[open_[less]] = middle[less] + 1
        high[open_[~less]] = middle[~less]
    return low


def common_ends(a, b, low_a, low_b):
    """(booleans of a, booleans of b): which offsets of two ascending lists are in both; the shorter one drives.  The
    rank of a value of one list in the other is known to be ``low_b`` (for values of a) or ``low_a`` at least."""
    if len(a) > len(b):
        return common_ends(b, a, low_b, low_a)[::-1]
    rank = gallop(b, a, low_b)
    inside = rank < len(b)
    held = np.zeros(len(a), bool)
    held[inside] = b[rank[inside]] == a[inside]
    other = np.zeros(len(b), bool)
    other[rank[held]] = True
    return held, other


def overlaps(start, end, b, low):
    """(i, j): the index pairs of tokens [start, end) and of the tokens that end at ascending ``b`` that share bytes,
    from the ranks of start and end; both sides cover the same bytes without gaps."""
    first = gallop(b, start + 1, low)           # the first that ends behind the start
    last = gallop(b, end, first)                # the first that reaches the end
    size = last - first + 1
    i = np.repeat(np.arange(len(start)), size)
    return i, np.arange(len(i)) - np.repeat(np.cumsum(size) - size, size) + first[i]


def chunks(text: str) -> list[str]:
    """``text`` without the spaces that open a token: joined by one space each, the chunks are the text."""
    return _OPENS.split(text) if _TOUCHING.search(text) or text[:1] == " " or text[-1:] == " " else text.split(" ")


class Aligner:
    """Parts of texts encoded by both tokenizers and aligned.

    An entry is None where the joined bytes of either tokenizer's tokens differ from the part's, else (groups as text,
    each closed by ";", id pairs as unsigned 64-bit a * 2**32 + b, tokens of a, tokens of b, groups)."""

    def __init__(self, byte_bpe_path: str, piece_path: str):
        import regex
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_bpe_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        plainly = [p for i, p in enumerate(pieces) if not self.b.is_byte(i) and not self.b.is_control(i) and not self.b.is_unknown(i)]
        if type(self.a.pre_tokenizer).__name__ != "ByteLevel" or self.a.normalizer is not None:
            raise ValueError(f"not a byte-level BPE file: {byte_bpe_path}")
        if any("▁" in p.lstrip("▁") or "\n" in p for p in plainly):
            raise ValueError(f"pieces go on behind a space or a line break: {piece_path}")
        # Inside a chunk both tokenizers open a token before a line break, behind a single one, and where a mark follows a
        # letter, unless some piece goes on there.
        marks = r"[!-@\[-`{-~]"
        ways = [r"(?<=\S)(?=\n)", r"(?<=\S\n)(?=\S)"]
        if not any(regex.search(rf"\p{{L}}{marks}", p) for p in plainly):
            ways.append(rf"(?<=\p{{L}})(?={marks})")
        self.cut = regex.compile("|".join(ways)).split
        # Byte-level BPE writes a byte as a printable character: itself, or the next one from 256 on.
        plain = [x for x in range(256) if 33 <= x <= 126 or 161 <= x <= 172 or x >= 174]
        byte = {chr(x): x for x in plain} | {chr(256 + n): x for n, x in enumerate(x for x in range(256) if x not in plain)}
        size = self.a.get_vocab_size()
        self.a_bytes = [bytes(byte.get(c, 0) for c in self.a.id_to_token(i) or "") for i in range(size)]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.lengths = [np.array(list(map(len, t))) for t in (self.a_bytes, self.b_bytes)]
        # The text of an id inside its group's list and at its end.
        self.names = [np.array([[b"%d," % i for i in range(n)], [b"%d%s" % (i, end) for i in range(n)]], object)
                      for n, end in ((size, b"|"), (len(pieces), b";"))]
        self.known: dict[str, tuple | None] = {}
        self.parts: dict[str, tuple | None] = {}

    def encoded(self, parts: list[str]) -> tuple[list, list]:
        """The ids of both tokenizers for each part; a part that opens with a space keeps it, as in the text.  Behind a
        line break, which no piece holds, the second tokenizer's leading space touches nothing."""
        ids_a = [x.ids for x in self.a.encode_batch_fast(parts, add_special_tokens=False)]
        spaced = [p[:1] == " " for p in parts]
        ids_b = self.b.encode([p[1:] if s else "\n" + p for p, s in zip(parts, spaced, strict=True)], num_threads=1)
        return ids_a, [x if s else x[2:] for x, s in zip(ids_b, spaced, strict=True)]

    def aligned(self, parts: list[str]) -> dict[str, tuple | None]:
        """The entries of distinct parts, all aligned together: every part's end is a common offset."""
        ids = self.encoded(parts)
        out: dict[str, tuple | None] = dict.fromkeys(parts)
        good = []
        for k, part in enumerate(parts):
            raw = part.encode()
            if all(b"".join([t[i] for i in side[k]]) == raw for t, side in ((self.a_bytes, ids[0]), (self.b_bytes, ids[1]))):
                good.append(k)
        if not good:
            return out
        flat, of, end, start, first, count = [], [], [], [], [], []
        for side, lengths in zip(ids, self.lengths, strict=True):
            size = np.array([len(side[k]) for k in good])
            flat.append(np.array([i for k in good for i in side[k]], np.int64))
            of.append(np.repeat(np.arange(len(good)), size))
            end.append(np.cumsum(lengths[flat[-1]]))
            start.append(end[-1] - lengths[flat[-1]])
            first.append(np.cumsum(size) - size)
            count.append(size)
        common = common_ends(end[0], end[1], first[0][of[1]], first[1][of[0]])
        group = [np.cumsum(c) - c for c in common]
        i, j = overlaps(start[0], end[0], end[1], first[1][of[0]])
        pairs = (flat[0][i] << 32 | flat[1][j]).tobytes()
        until = 8 * np.cumsum(np.bincount(of[0][i], minlength=len(good)))
        # The ids stand group by group, the first tokenizer's before the second's.
        text = np.empty(len(flat[0]) + len(flat[1]), object)
        place = [np.arange(len(flat[0])) + np.searchsorted(group[1], group[0], "left"),
                 np.arange(len(flat[1])) + np.searchsorted(group[0], group[1], "right")]
        for k in (0, 1):
            text[place[k]] = self.names[k][common[k].astype(int), flat[k]]
        text, ends = text.tolist(), np.cumsum(count[0] + count[1]).tolist()
        groups = np.bincount(of[0][common[0]], minlength=len(good)).tolist()
        at = low = 0
        for k, stop, till, n_a, n_b, n in zip(good, ends, until.tolist(), count[0].tolist(), count[1].tolist(), groups, strict=True):
            out[parts[k]] = (b"".join(text[at:stop]), pairs[low:till], n_a, n_b, n)
            at, low = stop, till
        return out

    def entries(self, texts: list[str]) -> list[list | None]:
        """The entries of every text's chunks, or None for a text without tokens."""
        cut = [chunks(t) if t else [] for t in texts]
        new = list(set().union(*cut).difference(self.known))
        split = [[" " + c] if c.isalpha() else self.cut(" " + c) for c in new]
        missing = list({p for ps in split for p in ps if p not in self.parts})
        self.parts.update(self.aligned(missing) if missing else {})
        for c, ps in zip(new, split, strict=True):
            own = [self.parts[p] for p in ps]
            self.known[c] = own[0] if len(own) == 1 else None if None in own else (
                b"".join([e[0] for e in own]), b"".join([e[1] for e in own]), *[sum(x) for x in zip(*[e[2:] for e in own], strict=True)])
        out = [list(map(self.known.__getitem__, cs)) for cs in cut]
        for kept, last in ((self.known, new), (self.parts, missing)):
            for c in last[len(last) - max(0, len(kept) - CACHE_CHUNKS):]:
                del kept[c]
        return [None if not e or None in e else e for e in out]


def batches_of(texts: list[str | None], chars: int = 1_000_000):
    """(first, last + 1) of consecutive texts that hold about ``chars`` characters together."""
    at = size = 0
    for k, t in enumerate(texts):
        size += len(t or "") + 100
        if size >= chars or k + 1 == len(texts):
            yield at, k + 1
            at, size = k + 1, 0


def worker_aligner(byte_bpe_path: str, piece_path: str) -> Aligner:
    """The aligner of a worker process, kept for its next tasks."""
    import os
    import sys
    import types

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    kept = sys.modules.setdefault("_tessera_aligners", types.ModuleType("_tessera_aligners")).__dict__
    name = f"{byte_bpe_path}|{piece_path}"
    if name not in kept:
        kept[name] = Aligner(byte_bpe_path, piece_path)
    return kept[name]


def align(docs: DataFrame, byte_bpe_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times): the alignment of every row's space and text.

    ``pairs`` are the distinct id pairs that overlapping tokens link, each a * 2**32 + b, ascending, and ``times`` how
    often.  A null or empty text, and a text whose joined bytes either tokenizer changes, has no tokens: zeros, an empty
    string and no pairs.  Repeated rows keep a row each; an empty table gives an empty result; other columns are not
    carried, so their names cannot clash.  The work is a map over partitions."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        work = worker_aligner(byte_bpe_path, piece_path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for at, stop in batches_of(texts):
                part = batch.slice(at, stop - at)
                rows = []
                for found in work.entries(texts[at:stop]):
                    if found is None:
                        rows.append((0, 0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int64)))
                        continue
                    links = np.frombuffer(b"".join([e[1] for e in found]), np.int64)
                    pairs, times = np.unique(links, return_counts=True)
                    digest = hashlib.sha256(b"".join([e[0] for e in found])[:-1]).hexdigest()
                    rows.append((sum(e[2] for e in found), sum(e[3] for e in found), sum(e[4] for e in found), len(links), digest, pairs, times))
                cols = list(zip(*rows, strict=True))
                sizes = np.concatenate(([0], np.cumsum([len(p) for p in cols[5]]))).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(sizes), pa.array(np.concatenate(cols[k]), t)) for k, t in ((5, pa.int64()), (6, pa.int32()))]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *[pa.array(cols[k], pa.int64()) for k in range(4)], pa.array(cols[4], pa.string()), *lists],
                    names=[id_col, "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])

    return (docs.select(id_col, F.col(text_col).cast("string"))
            .mapInArrow(run, f"`{id_col}` {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
                             "pairs array<bigint>, times array<int>"))


def pair_counts(rows: DataFrame) -> DataFrame:
    """(pair, count, best): how many links of all rows hold each id pair, and whether that is the highest count of its
    id of the second tokenizer.  Tasks sum their pairs first and pass on at most ``TASK_PAIRS`` at a time."""
    def run(batches):
        import pyarrow as pa

        def summed(parts):
            keys, place = np.unique(np.concatenate([p for p, _ in parts]), return_inverse=True)
            return keys, np.bincount(place, np.concatenate([n for _, n in parts]), len(keys)).astype(np.int64)

        parts, size = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 100):
                p, n = (batch.column(k).slice(at, 100).flatten().to_numpy() for k in (0, 1))
                parts.append((p, n.astype(np.int64)))
                size += len(p)
                if size > 4 * TASK_PAIRS:
                    parts = [summed(parts)]
                    size = len(parts[0][0])
                    if size > TASK_PAIRS:
                        yield pa.RecordBatch.from_arrays(list(map(pa.array, parts[0])), names=["pair", "count"])
                        parts, size = [], 0
        if size:
            yield pa.RecordBatch.from_arrays(list(map(pa.array, summed(parts))), names=["pair", "count"])

    counts = (rows.select("pairs", "times").mapInArrow(run, "pair long, count long")
              .groupBy("pair").agg(F.sum("count").alias("count")))
    counts = saved(counts.withColumn("_b", F.col("pair").bitwiseAND(0xFFFFFFFF)))
    top = counts.groupBy("_b").agg(F.max("count").alias("_top"))
    return counts.join(top, "_b").select("pair", "count", (F.col("count") == F.col("_top")).alias("best"))


def with_counts(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """``rows`` with n_best (links whose pair has the highest count of its second id) and count_sum (the counts of all
    links), in as many passes over the rows as the counts have blocks."""
    spark = rows.sparkSession
    counts = saved(counts)
    blocks = max(1, -(-counts.count() // BLOCK_PAIRS))
    kept = [c for c in rows.columns if c not in ("n_best", "count_sum")]
    rows = rows.withColumn("n_best", F.lit(0).cast("long")).withColumn("count_sum", F.lit(0).cast("long"))
    schema = rows.schema
    for k in range(blocks):
        block = counts.where(F.pmod(F.xxhash64("pair"), F.lit(blocks)) == k).orderBy("pair").toArrow()
        shared = spark.sparkContext.broadcast([c.to_numpy() for c in block.columns])

        def run(batches, shared=shared):
            import pyarrow as pa

            keys, count, best = shared.value
            for batch in batches:
                for at in range(0, batch.num_rows, 200):
                    part = batch.slice(at, 200)
                    pairs, times = part.column("pairs"), part.column("times")
                    of = np.repeat(np.arange(part.num_rows), pairs.value_lengths().to_numpy())
                    p, n = pairs.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)
                    sums = np.zeros((2, part.num_rows), np.int64)
                    if len(keys):
                        place = np.minimum(np.searchsorted(keys, p), len(keys) - 1)
                        hit = keys[place] == p
                        of, n, place = of[hit], n[hit], place[hit]
                        np.add.at(sums[0], of, n * best[place])
                        np.add.at(sums[1], of, n * count[place])
                    known = [part.column(c) for c in kept]
                    more = [pa.array(part.column(c).to_numpy() + s) for c, s in zip(("n_best", "count_sum"), sums, strict=True)]
                    yield pa.RecordBatch.from_arrays([*known, *more], names=[*kept, "n_best", "count_sum"])

        rows = rows.mapInArrow(run, schema)
        if k + 1 < blocks:
            rows = saved(rows)
    return rows


def alignments(docs: DataFrame, byte_bpe_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``align`` with n_best and count_sum of the whole table."""
    rows = saved(align(docs, byte_bpe_path, piece_path, id_col, text_col))
    return with_counts(rows, pair_counts(rows))


def digests(rows: DataFrame) -> DataFrame:
    return rows.drop("pairs", "times")
