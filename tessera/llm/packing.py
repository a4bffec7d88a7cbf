"""Cost-balanced packing of token sequences.

Every document becomes its ids and a closing id 0.  Full pieces of ``capacity`` tokens fill a sequence each; what is
left of a document goes, with its group, to a task that takes the remainders by descending cost (linear plus
quadratic attention cost of the piece) and puts each into the open sequence of least cost that has room for it.  A
remainder that fits nowhere is cut over the sequences of least cost with any room.  A group opens no more sequences
than its tokens need, so a group pads less than one sequence.
"""

from __future__ import annotations

import heapq
import math
import zlib
from array import array

from public_tokenizers import PATTERN
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean

PIECE = "start long, length long, ids_crc32 long, doc_tokens long"
CACHE_CHUNKS = 1_000_000      # distinct chunks a worker remembers


def attention_cost(tokens: int, linear: float = 1024.0, quadratic: float = 1.0) -> float:
    """Estimated cost of a piece: a term per token and one per pair of tokens that attend to each other."""
    return linear * tokens + quadratic * tokens * tokens


def encoder(tokenizer_path: str):
    """A function from a text to its ids (little-endian unsigned 32-bit bytes), kept by a worker process for its tasks.

    The library spends most of its time on a word outside the byte-pair merges, so its merges are called for each
    distinct match of the pattern alone.  A space that touches no other white space opens a match, so a text is cut at
    its spaces and every chunk is looked up; a text with other white space at its spaces is encoded as a whole.  The
    first ``CACHE_CHUNKS`` chunks that a worker meets are remembered."""
    import re
    import sys
    import types

    import regex
    from tokenizers import Tokenizer

    kept = sys.modules.setdefault("_tessera_encoders", types.ModuleType("_tessera_encoders")).__dict__
    if tokenizer_path in kept:
        return kept[tokenizer_path]
    model = Tokenizer.from_file(tokenizer_path)
    if type(model.pre_tokenizer).__name__ != "ByteLevel" or model.normalizer is not None:
        raise ValueError(f"not a byte-level BPE file: {tokenizer_path}")
    merged, matches = model.model.tokenize, regex.compile(PATTERN).findall
    # Byte-level BPE writes a byte as a printable character: itself, or the next one from 256 on.
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    sign = {b: 256 + n for n, b in enumerate(b for b in range(256) if b not in plain)}
    spaces, touching = re.compile(r"\s\s").search, re.compile(r"\s | \s").search

    def match_ids(match: str) -> bytes:
        return array("I", [t.id for t in merged(match.encode().decode("latin-1").translate(sign))]).tobytes()

    class Matches(dict):
        def __missing__(self, match):
            ids = match_ids(match)
            if len(self) < CACHE_CHUNKS:
                self[match] = ids
            return ids

    class Chunks(dict):        # by chunk without the space that opens it
        def __missing__(self, chunk):
            if chunk.isalpha() or len(parts := matches(" " + chunk)) == 1:
                ids = match_ids(" " + chunk)
            else:
                ids = b"".join([self[p[1:]] if p[0] == " " else other[p] for p in parts])
            if len(self) < CACHE_CHUNKS:
                self[chunk] = ids
            return ids

    other, known = Matches(), Chunks()
    look = known.__getitem__

    def encode(text: str) -> bytes:
        if text[:1] == " " or text[-1:] == " " or spaces(text) and touching(text):
            return b"".join(map(match_ids, matches(text)))
        head, *rest = text.split(" ")
        return b"".join([*map(other.__getitem__, matches(head)), *map(look, rest)])

    kept[tokenizer_path] = encode
    return encode


def tokenized(docs: DataFrame, tokenizer_path: str, capacity: int, id_col: str, text_col: str) -> DataFrame:
    """Pieces of every document: full ones (``ids`` null) and the remainder with its ids (unsigned 32-bit)."""
    def run(batches):
        import pyarrow as pa

        encode = encoder(tokenizer_path)
        for batch in batches:
            names, texts = batch.column(0), batch.column(1)
            for at in range(0, len(texts), 500):
                row, start, length, crc, total, rest = [], [], [], [], [], []
                for k, text in enumerate(texts.slice(at, 500).to_pylist()):
                    ids = encode(text or "") + b"\0\0\0\0"
                    n = len(ids) // 4
                    for s in range(0, n, capacity):
                        piece = ids[4 * s:4 * (s + capacity)]
                        row.append(at + k)
                        start.append(s)
                        length.append(len(piece) // 4)
                        crc.append(zlib.crc32(piece))
                        total.append(n)
                        rest.append(None if len(piece) == 4 * capacity else piece)
                yield pa.RecordBatch.from_arrays(
                    [names.take(pa.array(row, pa.int64())), *(pa.array(x, pa.int64()) for x in (start, length, crc, total)),
                     pa.array(rest, pa.binary())],
                    names=[id_col, "start", "length", "ids_crc32", "doc_tokens", "ids"])

    kind = docs.select(id_col).schema[0].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(lean(run, "_tessera_encoders"), f"`{id_col}` {kind}, {PIECE}, ids binary")


def balance(lengths: list[int], capacity: int) -> list[list[tuple[int, int, int]]]:
    """For each remainder its cuts (from, tokens, sequence).  Remainders are taken by descending length (so by
    descending cost; ties in the given order) and go to the sequence of least cost with room for all of it, else in
    parts to those of least cost with any room."""
    n = math.ceil(sum(lengths) / capacity)
    room, cost = [capacity] * n, [0.0] * n
    heap = [(0.0, s) for s in range(n)]
    out: list[list[tuple[int, int, int]]] = [[] for _ in lengths]

    def put(doc: int, at: int, tokens: int, seq: int) -> None:
        out[doc].append((at, tokens, seq))
        room[seq] -= tokens
        cost[seq] += attention_cost(tokens)
        if room[seq]:
            heapq.heappush(heap, (cost[seq], seq))

    for doc in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        need, passed = lengths[doc], []
        # The heap is in order of cost; looking past 64 sequences without room costs more than a cut.
        while heap and len(passed) < 64:
            _, seq = heapq.heappop(heap)
            if room[seq] >= need:
                put(doc, 0, need, seq)
                need = 0
                break
            passed.append(seq)
        at = 0
        for seq in passed:
            if need and (take := min(need, room[seq])):
                put(doc, at, take, seq)
                at, need = at + take, need - take
            elif room[seq]:
                heapq.heappush(heap, (cost[seq], seq))
        while need:
            _, seq = heapq.heappop(heap)
            take = min(need, room[seq])
            put(doc, at, take, seq)
            at, need = at + take, need - take
    return out


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 1024, id_col: str = "doc_id", text_col: str = "text",
         group_docs: int = 2000) -> DataFrame:
    """(id_col, start, length, ids_crc32, doc_tokens, sequence_id, offset): every token of every document in exactly
    one piece, sequences of at most ``capacity`` tokens filled from offset 0 without gaps.

    A null or empty text is a document of the one closing id.  Repeated rows are documents of their own.  Groups are
    made by a hash of the id and the remainder's tokens, about ``group_docs`` documents each, so neither a hot id nor
    a null one gathers in one task; a group's order is by length, start, checksum and id, so a recomputed task packs
    alike.  An empty table gives no pieces; other input columns are not carried."""
    groups = max(1, math.ceil(docs.count() / group_docs))
    pieces = tokenized(docs, tokenizer_path, capacity, id_col, text_col)
    key = F.pmod(F.xxhash64(id_col, "start", "ids_crc32"), F.lit(groups))
    kind = pieces.schema[0].dataType.simpleString()

    def run(group):
        import pyarrow as pa
        import pyarrow.compute as pc

        group = group.take(pc.sort_indices(group, [("length", "descending"), ("start", "ascending"),
                                                   ("ids_crc32", "ascending"), (id_col, "ascending")]))
        cols = {c: group[c].to_pylist() for c in ("start", "length", "ids_crc32", "doc_tokens", "ids")}
        base = group["_group"][0].as_py() << 32
        full = [i for i, x in enumerate(cols["ids"]) if x is None]
        part = [i for i, x in enumerate(cols["ids"]) if x is not None]
        rows = [(i, cols["start"][i], cols["length"][i], cols["ids_crc32"][i], cols["doc_tokens"][i], base + s, 0)
                for s, i in enumerate(full)]
        filled: dict[int, int] = {}
        for i, cuts in zip(part, balance([cols["length"][i] for i in part], capacity), strict=True):
            ids, whole = cols["ids"][i], cols["length"][i]
            for at, tokens, seq in cuts:
                s = base + len(full) + seq
                crc = cols["ids_crc32"][i] if tokens == whole else zlib.crc32(ids[4 * at:4 * (at + tokens)])
                rows.append((i, cols["start"][i] + at, tokens, crc, cols["doc_tokens"][i], s, filled.get(s, 0)))
                filled[s] = filled.get(s, 0) + tokens
        row, *rest = zip(*rows, strict=True)
        return pa.Table.from_arrays([group[id_col].take(pa.array(row)), *(pa.array(x, pa.int64()) for x in rest)], names)

    names = [id_col, *(x.split()[0] for x in PIECE.split(", ")), "sequence_id", "offset"]
    grouped = pieces.withColumn("_group", key).groupBy("_group")
    return grouped.applyInArrow(run, f"`{id_col}` {kind}, {PIECE}, sequence_id long, offset long")
