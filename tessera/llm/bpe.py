"""Byte-level BPE encoding and decoding with recursive DuckDB queries inside Spark tasks.

Each task reads its partition in Arrow batches and looks up the distinct chunks of a block of texts.  Pattern matches
("words") not met before go to an in-memory DuckDB as rows (word, tokens, ranks of neighbouring tokens); a recursive
query contracts every word's leftmost pair of minimum rank, and joins the new token and its two neighbours with the
merge table, until no word has a pair left.  An ordered aggregation over the vocabulary table gives each word's decoded
bytes.  A worker remembers at most about ``cache_words`` words, those met lately first, so memory is bounded whatever
the partition holds.
"""

from __future__ import annotations

import base64

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import splits

# One query's words; bounds the rows a recursion holds (about one a token of each word, over all rounds).
QUERY_WORDS = 40_000
# Characters of texts that are looked up together.
BLOCK_CHARS = 4_000_000
# Longer words would need one round per byte: their pairs are contracted with a heap, in the same order.
LONG_WORD = 400

# In place of a rank: the pair is in no merge.
NO_MERGE = 1 << 40

ENCODE_SQL = f"""
WITH RECURSIVE state AS (
    SELECT w, toks, ranks, list_min(ranks) AS low FROM words_in
    UNION ALL
    SELECT w, toks, ranks, list_min(ranks) AS low
    FROM (SELECT s.w, s.toks[:p - 1] || [s.low] || s.toks[p + 2:] AS toks,
                 s.ranks[:greatest(p - 2, 0)] || CASE WHEN p > 1 THEN [coalesce(l.rank, {NO_MERGE})] ELSE [] END
                 || CASE WHEN p + 2 <= len(s.toks) THEN [coalesce(r.rank, {NO_MERGE})] ELSE [] END || s.ranks[p + 2:] AS ranks
          FROM (SELECT *, list_position(ranks, low) AS p FROM state WHERE low < {NO_MERGE}) s
          LEFT JOIN merges l ON l.pair = CASE WHEN p > 1 THEN s.toks[p - 1] * 4294967296 + s.low END
          LEFT JOIN merges r ON r.pair = s.low * 4294967296 + s.toks[p + 2]))
SELECT w, toks AS ids FROM state WHERE low IS NULL OR low = {NO_MERGE} ORDER BY w
"""

DECODE_SQL = """
SELECT r, list(v.bytes ORDER BY pos) AS decoded, count(*) - count(v.id) AS unknown
FROM (SELECT r, unnest(ids) AS id, generate_subscripts(ids, 1) AS pos FROM ids_in) t LEFT JOIN vocabulary v USING (id)
GROUP BY r ORDER BY r
"""


class _Codec:
    """The merge and vocabulary tables of one rank file in an in-memory DuckDB, and the words met so far."""

    def __init__(self, ranks_path: str, pattern: str, cache_words: int):
        import duckdb
        import numpy as np
        import pyarrow as pa
        import regex

        with open(ranks_path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.match, self.limit = regex.compile(pattern).findall, cache_words
        self.byte_ids = np.array([self.ranks[bytes([i])] for i in range(256)], dtype=np.int64)
        self.pair_ranks = np.array([[self.ranks.get(bytes([i, j]), NO_MERGE) for j in range(256)] for i in range(256)], dtype=np.int64)
        pairs, low = [], []
        for tok, rank in self.ranks.items():
            for k in range(1, len(tok)):
                left, right = self.ranks.get(tok[:k]), self.ranks.get(tok[k:])
                if left is not None and right is not None:
                    pairs.append(left << 32 | right)
                    low.append(rank)
        self.db = duckdb.connect()
        self.db.execute("SET threads = 1")
        self.db.execute("SET memory_limit = '400MB'")
        self.db.execute("SET temp_directory = ''")
        self.db.register("merges_in", pa.table({"pair": pa.array(pairs, pa.int64()), "rank": pa.array(low, pa.int64())}))
        self.db.register("vocabulary_in", pa.table({"id": pa.array(self.ranks.values(), pa.int64()),
                                                    "bytes": pa.array(self.ranks.keys(), pa.binary())}))
        for name in ("merges", "vocabulary"):
            self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM {name}_in")
        # Of chunks and of pattern matches: those met since the last ageing, and before it.
        self.words: dict[str, tuple[bytes, bytes]] = {}
        self.pieces: dict[str, tuple[bytes, bytes]] = {}
        self.old_words, self.old_pieces = self.words, self.pieces

    def _long(self, word: bytes) -> list[int]:
        import heapq

        n, ranks = len(word), self.ranks
        nxt, prv, end = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        alive = [True] * n
        heap = [(ranks[word[i:i + 2]], i, i + 2) for i in range(n - 1) if word[i:i + 2] in ranks]
        heapq.heapify(heap)
        while heap:
            _, i, e = heapq.heappop(heap)
            j = nxt[i]
            if not alive[i] or j >= n or end[j] != e:
                continue
            alive[j], end[i], nxt[i] = False, e, nxt[j]
            if nxt[i] < n:
                prv[nxt[i]] = i
                k = end[nxt[i]]
                if (rank := ranks.get(word[i:k])) is not None:
                    heapq.heappush(heap, (rank, i, k))
            if prv[i] >= 0 and (rank := ranks.get(word[prv[i]:e])) is not None:
                heapq.heappush(heap, (rank, prv[i], e))
        return [ranks[word[i:end[i]]] for i in range(n) if alive[i]]

    def learn(self, words: list[str]) -> None:
        """Put the ids (int32 bytes) and decoded bytes of new words into the cache."""
        import numpy as np
        import pyarrow as pa

        short: list[str] = []
        for w in words:
            if (rank := self.ranks.get(raw := w.encode())) is not None:       # a word in the vocabulary is one token
                self.pieces[w] = np.array([rank], dtype=np.int32).tobytes(), raw
            elif len(raw) > LONG_WORD:
                ids = self._long(raw)
                self.pieces[w] = np.array(ids, dtype=np.int32).tobytes(), self.decode([ids])[0]
            else:
                short.append(w)
        for at in range(0, len(short), QUERY_WORDS):
            part = short[at:at + QUERY_WORDS]
            raw = [w.encode() for w in part]
            end = np.cumsum([len(x) for x in raw], dtype=np.int32)
            flat = np.frombuffer(b"".join(raw), dtype=np.uint8)
            pairs = np.delete(self.pair_ranks[flat[:-1], flat[1:]], end[:-1] - 1)     # without those across two words
            cut = np.concatenate(([0], end)).astype(np.int32)
            self.db.register("words_in", pa.table({
                "w": np.arange(len(part)), "toks": pa.ListArray.from_arrays(cut, self.byte_ids[flat]),
                "ranks": pa.ListArray.from_arrays(cut - np.arange(len(cut), dtype=np.int32), pairs)}))
            flat = self.db.sql(ENCODE_SQL).to_arrow_table()["ids"].combine_chunks()
            ids = flat.values.to_numpy().astype(np.int32)
            cut = flat.offsets.to_numpy()
            for i, (w, text) in enumerate(zip(part, self.decode(flat), strict=True)):
                self.pieces[w] = ids[cut[i]:cut[i + 1]].tobytes(), text

    def decode(self, rows) -> list[bytes]:
        """The bytes of each list of ids (lists or an Arrow array of them)."""
        import numpy as np
        import pyarrow as pa

        self.db.register("ids_in", pa.table({"r": pa.array(range(len(rows)), pa.int64()),
                                             "ids": rows if isinstance(rows, pa.Array) else pa.array(rows, pa.list_(pa.int64()))}))
        out = [b""] * len(rows)
        for found in self.db.sql(DECODE_SQL).to_arrow_table().to_batches():
            if any(found["unknown"].to_pylist()):
                raise ValueError("an id is not in the vocabulary")
            # The bytes of a row's tokens stand together.
            tokens = found["decoded"].flatten().cast(pa.large_binary())
            ends = np.frombuffer(tokens.buffers()[1], np.int64)[tokens.offset:][:len(tokens) + 1]
            cut = ends[np.concatenate(([0], np.cumsum(found["decoded"].value_lengths().to_numpy())))].tolist()
            data = tokens.buffers()[2].to_pybytes()
            for r, start, end in zip(found["r"].to_pylist(), cut, cut[1:], strict=False):
                out[r] = data[start:end]
        return out

    def encode(self, texts: list[str]):
        """Arrow arrays of each text's ids as int32 bytes, and of the decoded bytes."""
        import pyarrow as pa

        ids, decoded, at = [], [], 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size + len(texts[end]) <= BLOCK_CHARS):
                size += len(texts[end])
                end += 1
            for out, found in zip((ids, decoded), self._encode(texts[at:end]), strict=True):
                out.append(found)
            at = end
        return pa.concat_arrays(ids), pa.concat_arrays(decoded)

    def _age(self) -> None:
        """Half the limit is for what was met lately: entries not met again while it fills are forgotten."""
        if len(self.words) > self.limit // 2 or len(self.pieces) > self.limit // 2:
            self.old_words, self.old_pieces = self.words, self.pieces
            self.words, self.pieces = {}, {}

    @staticmethod
    def _unknown(met: set[str], recent: dict, old: dict) -> list[str]:
        """What of ``met`` is not remembered; older entries become recent ones."""
        out = []
        for x in met.difference(recent):
            if (entry := old.get(x)) is None:
                out.append(x)
            else:
                recent[x] = entry
        return out

    def _encode(self, texts: list[str]):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        self._age()
        split = np.array([splits(t) for t in texts])
        # Parts of the texts that are cut at their spaces (without the space that opens all but the first) and of the others.
        cut = pc.split_pattern(pa.array([t for t, s in zip(texts, split, strict=True) if s], pa.string()), " ")
        other = [self.match(t) for t, s in zip(texts, split, strict=True) if not s]
        spaced, head = cut.flatten().dictionary_encode(), np.zeros(len(cut.flatten()), dtype=bool)
        head[cut.offsets.to_numpy()[:-1]] = True
        code = spaced.indices.to_numpy().astype(np.int64)
        code[head] += len(spaced.dictionary)
        used = np.unique(code)
        names, n = spaced.dictionary.to_pylist(), len(spaced.dictionary)
        parts = [" " + names[c] if c < n else names[c - n] for c in used.tolist()]
        whole = pa.array([p for ps in other for p in ps], pa.string()).dictionary_encode()
        pieces = whole.dictionary.to_pylist()
        # ASCII letters after at most one space are one match.
        new = {c: [c] if c.isascii() and (c.isalpha() or c[:1] == " " and c[1:].isalpha()) else self.match(c)
               for c in self._unknown(set(parts), self.words, self.old_words)}
        self.learn(sorted(self._unknown(set().union(pieces, *new.values()), self.pieces, self.old_pieces)))
        for c, ps in new.items():
            # A chunk of one word shares the word's entry.
            self.words[c] = self.pieces[ps[0]] if len(ps) == 1 else (
                b"".join([self.pieces[p][0] for p in ps]), b"".join([self.pieces[p][1] for p in ps]))
        known = [*map(self.words.__getitem__, parts), *map(self.pieces.__getitem__, pieces)]
        order = np.concatenate((np.searchsorted(used, code), whole.indices.to_numpy() + len(parts)))
        counts = np.empty(len(texts), dtype=np.int64)
        counts[split], counts[~split] = np.diff(cut.offsets.to_numpy()), [len(ps) for ps in other]
        # Texts of both kinds back in their order.
        kind = np.argsort(~split, kind="stable")
        begin = np.empty(len(texts), dtype=np.int64)
        begin[kind] = np.cumsum(counts[kind]) - counts[kind]
        ends = np.cumsum(counts)
        at = pa.array(order[np.repeat(begin - ends + counts, counts) + np.arange(ends[-1])])
        ends = np.concatenate(([0], ends))
        for side in range(2):
            joined = pa.array([x[side] for x in known], pa.large_binary()).take(at)
            offsets = np.frombuffer(joined.buffers()[1], np.int64)[:len(joined) + 1][ends] if len(joined) else np.zeros(len(ends), np.int64)
            yield pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(texts), [None, pa.py_buffer(offsets), joined.buffers()[2]])


def _kept_codec(ranks_path: str, pattern: str, cache_words: int) -> _Codec:
    """The codec of a worker process, kept for its later tasks, so that a worker builds its tables once and learns a word
    once; ``cache_words`` bounds what it remembers."""
    import sys
    import types

    kept = sys.modules.setdefault("_tessera_codecs", types.ModuleType("_tessera_codecs")).__dict__
    key = f"{ranks_path}\0{pattern}\0{cache_words}"
    if key not in kept:
        kept[key] = _Codec(ranks_path, pattern, cache_words)
    return kept[key]


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           cache_words: int = 300_000) -> DataFrame:
    """(id_col, ids array<int>, decoded binary) for every row: the ids of the whole text and what they decode to.

    A null or empty text has no ids and decodes to no bytes; a repeated row gives a repeated result; an empty table
    gives an empty one.  Other input columns are not carried, so their names cannot clash.  The work is a map over
    partitions: a lost executor repeats only its partitions."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        codec = None
        for batch in batches:
            codec = codec or _kept_codec(ranks_path, pattern, cache_words)
            texts = [t or "" for t in batch.column(1).to_pylist()]
            # Rows of a part share one output batch of bounded size.
            for at in range(0, len(texts), 1000):
                ids, decoded = codec.encode(texts[at:at + 1000])
                ends = np.frombuffer(ids.buffers()[1], np.int64)[:len(ids) + 1]
                flat = np.frombuffer(ids.buffers()[2] or b"", dtype=np.int32)[ends[0] // 4:ends[-1] // 4]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(ids)), pa.ListArray.from_arrays(((ends - ends[0]) // 4).astype(np.int32), flat),
                     decoded.cast(pa.binary())], names=[id_col, "ids", "decoded"])

    kind = docs.select(id_col).schema[0].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, ids array<int>, decoded binary")


def decode(rows: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id_col, decoded binary): the bytes of every row's ids, by ordered aggregation; a null list gives no bytes and
    an id outside the vocabulary is an error."""
    def run(batches):
        import pyarrow as pa

        codec = None
        for batch in batches:
            codec = codec or _Codec(ranks_path, pattern, 1)
            rows_in = [x or [] for x in batch.column(1).to_pylist()]
            for at in range(0, len(rows_in), 500):
                part = codec.decode(rows_in[at:at + 500])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(part)), pa.array(part, pa.binary())],
                                                 names=[id_col, "decoded"])

    kind = rows.select(id_col).schema[0].dataType.simpleString()
    return rows.select(id_col, ids_col).mapInArrow(run, f"`{id_col}` {kind}, decoded binary")


def digests(encoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of ``encode``'s rows."""
    return encoded.select(id_col, F.size("ids").cast("long").alias("n_tokens"),
                          F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                          F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))
