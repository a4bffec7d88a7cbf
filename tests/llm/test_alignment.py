"""Alignment of two tokenizers against a brute-force alignment of whole texts."""

import hashlib
import random
from bisect import bisect_right
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers

from tessera.llm import alignment

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["a  b", "<s> </s> <|endoftext|> x", "▁x y", "x▁", " lead", "trail ", "\n\n a\tb", "日本語 テキスト 漢字", "é́   x", None, "",
         "\x1c a \x1cb", "don't can't I'll  ", "👩‍👩‍👧 x 👍🏽", "a" * 3000, " " * 50, "<0x0A> <unk>", "　x 　y", "\0 x", "a​b  ﻿q",
         "1234567 12 3", "a.b,c\nd\n\ne.\n\tf don't-x's", "\n", "word.", ".word", "x\n y", "स्ते।", "same words here", "same words here", "same words there " * 500]


def brute(texts):
    """Whole texts, every pair of tokens compared by their byte ranges."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(BYTE_BPE)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    plain = [x for x in range(256) if 33 <= x <= 126 or 161 <= x <= 172 or x >= 174]
    byte = {chr(x): x for x in plain} | {chr(256 + n): x for n, x in enumerate(x for x in range(256) if x not in plain)}
    docs, count = [], Counter()
    for text in texts:
        raw = b" " + (text or "").encode()
        ids = [a.encode(" " + (text or ""), add_special_tokens=False).ids, b.encode(text or "")]
        tokens = [[bytes(byte[c] for c in a.id_to_token(i)) for i in ids[0]],
                  [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ids[1], b.id_to_piece(ids[1]), strict=True)]]
        if not text or any(b"".join(t) != raw for t in tokens):
            docs.append(None)
            continue
        ranges = []
        for side in tokens:
            at, own = 0, []
            for t in side:
                own.append((at, at + len(t)))
                at += len(t)
            ranges.append(own)
        holder = [[], []]
        for side in (0, 1):
            holder[side] = [k for k, (s, e) in enumerate(ranges[side]) for _ in range(s, e)]
        links = [(ids[0][i], ids[1][j]) for i, j in sorted(set(zip(*holder, strict=True)))]
        cut = sorted({e for _, e in ranges[0]} & {e for _, e in ranges[1]})
        own = [defaultdict(list), defaultdict(list)]
        for k in (0, 1):
            for i, (start, _) in zip(ids[k], ranges[k], strict=True):
                own[k][bisect_right(cut, start)].append(str(i))
        groups = [f"{','.join(own[0][n])}|{','.join(own[1][n])}" for n in range(len(cut))]
        count.update(links)
        docs.append((len(ids[0]), len(ids[1]), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    top = {}
    for (_, y), n in count.items():
        top[y] = max(top.get(y, 0), n)
    return [(0, 0, 0, 0, "", 0, 0) if d is None else
            (*d[:3], len(d[3]), d[4], sum(count[x] == top[x[1]] for x in d[3]), sum(count[x] for x in d[3])) for d in docs]


def run(spark, texts):
    rows = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)], "doc_id long, text string, n_a long").repartition(3)
    got = alignment.digests(alignment.alignments(rows, BYTE_BPE, PIECES))
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]
    return [tuple(r)[1:] for r in got.orderBy("doc_id").collect()]


def test_alignments_match_brute_force(spark):
    assert run(spark, TEXTS) == brute(TEXTS)


def test_counts_in_blocks_and_a_full_cache(spark, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK_PAIRS", 7)
    monkeypatch.setattr(alignment, "TASK_PAIRS", 3)
    monkeypatch.setattr(alignment, "CACHE_CHUNKS", 2)
    texts = [f"{t} and {i}" for i, t in enumerate(("some text", "other  text", "some", "x▁y"))]
    assert run(spark, texts) == brute(texts)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_galloping_finds_ranks_and_common_ends():
    rng = random.Random(4)
    for _ in range(300):
        a, b = (np.array(sorted(rng.sample(range(1, 60), rng.randrange(0, 40))), np.int64) for _ in range(2))
        values = np.array([rng.randrange(0, 70) for _ in range(9)])
        rank = np.searchsorted(a, values)
        low = [rng.randrange(0, r + 1) for r in rank]
        assert alignment.gallop(a, values, low).tolist() == rank.tolist()
        held = alignment.common_ends(a, b, np.zeros(len(b), int), np.zeros(len(a), int))
        assert [h.tolist() for h in held] == [np.isin(a, b).tolist(), np.isin(b, a).tolist()]


def test_overlaps_are_byte_ranges_that_meet():
    rng = random.Random(5)
    for _ in range(200):
        a, b = (np.array([*sorted(rng.sample(range(1, 30), rng.randrange(0, 12))), 30]) for _ in range(2))
        starts = [[0, *x[:-1]] for x in (a, b)]
        want = [(i, j) for i, e in enumerate(a) for j, f in enumerate(b) if starts[1][j] < e and f > starts[0][i]]
        assert list(zip(*alignment.overlaps(np.array(starts[0]), a, b, np.zeros(len(a), int)), strict=True)) == want


def test_sample_of_the_documents(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = [r.text for r in rows.orderBy("doc_id").collect()]
    assert run(spark, texts) == brute(texts)
