"""Small tests of the training-data operators: brute force, exact round trips, and the defined edge cases."""

import hashlib
import os
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tessera.llm import bpe, chat, common, embeddings, fingerprints, htmltext, language, lines, packing, shingle_join, substring

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
DOC = "doc_id long, text string, lang string, source string, n_chars long, fp string, k long"


def docs(spark, texts, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", None, None, "x", 1) for i, t in zip(ids, texts, strict=True)], DOC).repartition(3)


def prose(seed, n=60, vocabulary=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def near_copies():
    base = [prose(s, 80) for s in range(12)]
    out = list(base)
    for s, t in enumerate(base[:6]):
        words = t.split()
        for cut in range(1, 5):
            out.append(" ".join(words[:40] + [f"new{s}x{cut}"] + words[40 + cut:]))
    return [*out, base[0], base[0], "", None, "  \n\t ", "one two three", "One TWO three", "one two four"]


def union_find(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_components_of_chains_stars_and_nothing(spark):
    chain = [(i, i + 1) for i in range(100, 140)] + [(i * 7 % 50, i) for i in range(1, 50)] + [(5, 5), (None, 3)]
    got = {r.node: r.component for r in common.connected_components(spark.createDataFrame(chain, "a long, b long")).collect()}
    root = union_find(200, [(a, b) for a, b in chain if a is not None])
    assert got == {i: root[i] for e in chain if e[0] is not None and e[0] != e[1] for i in e}
    assert common.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_lean_tasks_drop_the_words_of_other_operators(monkeypatch):
    import sys

    for name in common.WORD_CACHES:
        monkeypatch.setitem(sys.modules, name, object())
    def run(batches):
        yield from batches

    assert list(common.lean(run, "_tessera_encoders")(iter([1, 2]))) == [1, 2]
    assert [name for name in common.WORD_CACHES if name in sys.modules] == ["_tessera_encoders"]
    with pytest.raises(ZeroDivisionError):
        list(common.lean(lambda batches: (1 // x for x in batches))(iter([0])))
    assert "_tessera_encoders" not in sys.modules


def test_language_sample_is_the_smallest_hashes(spark, monkeypatch):
    rows = docs(spark, [prose(i, 8) for i in range(60)] + ["", None]).withColumn("lang", F.when(F.col("doc_id") % 3 > 0, F.concat(F.lit("l"), F.col("doc_id") % 2)))
    rows = rows.unionAll(rows)
    monkeypatch.setattr(language, "train", lambda texts, labels: list(zip(labels, texts, strict=True)))
    want = sorted((r.lang, r.h, r.text[:20]) for r in rows.select("*", F.xxhash64(F.lit(11), F.col("doc_id").cast("string"), "text").alias("h")).collect()
                  if r.lang and r.text)
    want = [(x, t) for lang in ("l0", "l1") for x, _, t in [w for w in want if w[0] == lang][:7]]
    assert language.fit(rows, per_label=7, chars=20) == want


def test_ngram_groups_match_brute_force(spark):
    texts = near_copies()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in shingle_join.near_groups(docs(spark, texts)).collect()}
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()})
    links = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    root = union_find(len(sets), links)
    assert len(set(root)) < len(texts) - 10
    assert got == {i: (len(s), root[i]) for i, s in enumerate(sets)}
    assert shingle_join.near_groups(docs(spark, [])).count() == 0


def test_ngram_sketches_bound_the_difference():
    rng = np.random.default_rng(3)
    for n in (3, 40, 300):
        a = rng.integers(0, 2**63, n).astype(np.uint64)
        b = np.concatenate((a[n // 5:], rng.integers(0, 2**63, n // 4).astype(np.uint64)))
        doc = np.repeat([0, 1], [len(a), len(b)])
        x, y = shingle_join.bit_sketches(doc, np.concatenate((a, b)), np.array([len(a), len(b)]))
        assert shingle_join.hamming(x, y) <= len(set(a.tolist()) ^ set(b.tolist()))
        assert shingle_join.hamming(x, x) == 0


def test_ngram_large_bucket_finds_links_between_other_members(spark, monkeypatch):
    monkeypatch.setattr(shingle_join, "SMALL_BUCKET", 2)
    shared = prose(99, 40)
    texts = [shared + " " + prose(200 + i // 2, 40) + (" end" if i % 2 else "") for i in range(24)]
    got = [r.component_id for r in shingle_join.near_groups(docs(spark, texts)).orderBy("doc_id").collect()]
    assert got == [i - i % 2 for i in range(24)]


def test_ngram_cells_return_forests(spark):
    """Members of one bucket, all alike by sketch: no more pairs come out than connect the components."""
    n = 40
    bits = spark.createDataFrame([(i, 30, bytearray(8)) for i in range(n)], "set_key long, n long, bits binary")
    held = spark.createDataFrame([(7, i) for i in range(n)], "bucket long, x long")
    comp = spark.createDataFrame([(i, 0) for i in range(10)], "node long, component long")
    none = spark.createDataFrame([], "a long, b long")
    inside = lambda far, forests: {(r.a, r.b) for r in shingle_join._inside(held, held, bits, comp, far, 75, forests).collect()}
    found = inside(none, 1)
    assert len(found) == n - 10
    root = union_find(n, [*((i, 0) for i in range(1, 10)), *found])
    assert set(root) == {0}
    # Refuted pairs do not come again, and several forests have no pair in common.
    every = spark.createDataFrame([(i, j) for j in range(n) for i in range(j) if (i, j) not in {(3, 20), (20, 30)}], "a long, b long")
    assert inside(every, 1) == {(3, 20), (20, 30)}
    assert len(inside(none, 3)) > 2 * (n - 10) and not inside(every.unionAll(spark.createDataFrame([(3, 20), (20, 30)])), 8)


def test_ngram_rounds_find_links_among_many_refuted_pairs(spark, monkeypatch):
    """Sets of a bucket whose sketches say nothing: only repeated rounds reach the linked pairs."""
    monkeypatch.setattr(shingle_join, "SMALL_BUCKET", 2)
    monkeypatch.setattr(shingle_join, "MORE_FORESTS", 64)
    monkeypatch.setattr(shingle_join, "bit_sketches", lambda doc, h, count: [bytes(8)] * len(count))
    shared = prose(99, 40)
    texts = [shared + " " + prose(200 + i // 2, 40) + (" end" if i % 2 else "") for i in range(12)]
    got = [r.component_id for r in shingle_join.near_groups(docs(spark, texts)).orderBy("doc_id").collect()]
    assert got == [i - i % 2 for i in range(12)]


def brute_repeats(texts, length):
    seen, out = set(), []
    for t in texts:
        b, gone = (t or "").encode(), set()
        for p in range(len(b) - length + 1):
            if b[p:p + length] in seen:
                gone.update(range(p, p + length))
            seen.add(b[p:p + length])
        spans = sum(1 for i in gone if i - 1 not in gone)
        kept = bytes(x for i, x in enumerate(b) if i not in gone)
        out.append((len(b), len(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def test_substring_repeats_match_brute_force(spark):
    passage = prose(7, 30)
    texts = [prose(1), passage + prose(2), prose(3) + passage, prose(1), "a" * 500, "ab" * 300, "ab" * 60 + passage[:90], None, "",
             "é" * 120, passage[3:], prose(4, 20) + passage[20:150] + prose(5, 20) + passage[10:140], "x" * 99, "x" * 99, passage + "ß" + passage]
    got = [tuple(r)[1:] for r in substring.digests(substring.remove_repeats(docs(spark, texts))).orderBy("doc_id").collect()]
    assert got == brute_repeats(texts, 100)
    assert substring.remove_repeats(docs(spark, [])).count() == 0


def test_substring_sorts_of_a_common_phrase_are_bounded(spark, monkeypatch):
    """A phrase in other surroundings in each document, and a passage in pairs of them: sorts stay small, rows are right."""
    monkeypatch.setattr(substring, "SORT_CONTEXTS", 20)
    inner = substring.repeats

    def bounded(contexts, *rest):
        if len(contexts) > 20:
            raise MemoryError(f"{len(contexts)} contexts in one sort")
        return inner(contexts, *rest)

    monkeypatch.setattr(substring, "repeats", bounded)
    phrase = "all rights reserved by the owners of this page and its text, see the terms"
    texts = [f"{prose(i, 20)} {phrase} {prose(i + 500, 20)}{prose(i // 2 + 900, 30)}" for i in range(80)]
    got = [tuple(r)[1:] for r in substring.digests(substring.remove_repeats(docs(spark, texts))).orderBy("doc_id").collect()]
    assert got == brute_repeats(texts, 100)


def test_substring_rows_of_one_id_and_carried_columns(spark):
    text = prose(1, 50)
    rows = docs(spark, [text, text, None, text + "y"], [4, 4, None, 4])
    got = substring.remove_repeats(rows, carry=("lang", "fp")).collect()
    # the two equal rows are one document; which text of the id is first is settled by a hash
    assert sorted(len(r.kept) for r in got if r.doc_id == 4) in ([0, 0, len(text) + 1], [1, len(text), len(text)])
    assert {r.lang for r in got} == {"en"}
    assert next(r for r in got if r.doc_id is None).n_bytes == 0


def test_suffix_sort_orders_and_marks(spark):
    buf = np.frombuffer(bytes(random.Random(2).choices(b"ab", k=400)), np.uint8)
    start = np.arange(0, 380)
    group = start // 95
    order, same = substring.suffix_sort(substring.PrefixHash(buf), buf, start, group, 6)
    key = [(group[i], buf[start[i]:start[i] + 6].tobytes(), i) for i in order]
    assert key == sorted(key)
    assert [bool(x) for x in same] == [i > 0 and key[i][:2] == key[i - 1][:2] for i in range(len(key))]


def test_line_dedup_keeps_first_of_near_lines(spark):
    a = "the quick brown fox jumps over the lazy dog while seventeen other animals look on from the old fence by the river bank today"
    near = a.replace("seventeen", "eighteen")
    texts = [a + "\n\nalone here\n" + "你好世界这是一个测试行用来检查没有空格的文字", near + "\nsecond line of its own\n\n", "  " + a.upper() + " ", None, "", "\n\n",
             "你好世界这是一个测试行用来检查没有空格的文字\nx"]
    got = {r.doc_id: r for r in lines.dedup_lines(docs(spark, texts), carry=("fp", "lang")).collect()}
    assert got[0].text == texts[0] and got[0].n_removed == 0
    assert got[1].text == "second line of its own\n\n" and (got[1].n_lines, got[1].n_removed) == (4, 1)
    assert got[2].text == "" and got[3].text is None and (got[3].n_lines, got[4].n_lines, got[5].n_lines) == (0, 1, 3)
    assert got[6].text == "x" and got[6].fp == "x"
    assert lines.dedup_lines(docs(spark, [])).count() == 0


def test_line_dedup_of_many_lines_with_one_passage(spark):
    passage = "this long passage stands in very many lines and is followed by words that only one pair of lines has"
    texts = [f"{passage} {prose(i // 2, 26)}{' end' if i % 2 else ''}" for i in range(60)]
    got = lines.dedup_lines(docs(spark, texts)).orderBy("doc_id").collect()
    assert [r.n_removed for r in got] == [i % 2 for i in range(60)]


def near_by_force(texts, threshold=0.75):
    """Documents of one line each whose line goes: a smaller one is in its component of near lines."""
    def windows(x):
        return {x[i:i + lines.WIDTH] for i in range(max(1, len(x) - lines.WIDTH + 1))}

    sets = [windows(x.strip().lower()) for x in texts]
    links = [(i, j) for i in range(len(texts)) for j in range(i) if len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j])]
    root = union_find(len(texts), links)
    return {i for i in range(len(texts)) if root[i] in {root[j] for j in range(i)}}


def removed_lines(spark, texts):
    return {r.doc_id for r in lines.dedup_lines(docs(spark, texts)).where("n_removed > 0").collect()}


def test_line_dedup_reads_every_character_of_long_words(spark):
    rng = random.Random(3)
    blob = "".join(rng.choice("0123456789abcdef") for _ in range(9000))
    texts = ["https://www.example.org/a/report-2021.pdf", "https://www.example.org/zzz/other", "see https://www.example.org/a",
             "see https://www.example.org/totally-different", "key: 3f9a1c7be0d24a1199ffee01", "key: 3f9a1c7be0d2ffffffffffff",
             blob, blob[:5000] + "x" + blob[5000:], blob[:3000] + blob[:2990:-1], "汉字没有空格的一行文字也要完整地读到最后一个字为止才行" * 3,
             "汉字没有空格的一行文字也要完整地读到最后一个字为止才行" * 3 + "了", "short", "shore"]
    want = near_by_force(texts)
    assert want == {7, 10}
    assert removed_lines(spark, texts) == want


def test_line_dedup_of_overlapping_templates(spark, monkeypatch):
    """All lines share all bands, so every pair is a candidate: the components are those of brute force."""
    monkeypatch.setattr(lines, "signatures", lambda x: x.select("key").distinct().select(
        "key", *[F.lit(0).cast("long").alias(f"m{i}") for i in range(lines.BANDS * lines.ROWS)]))
    # Three templates of 32 lines, every shingle of which stands in many lines: five places have one of two words.
    texts = []
    for k in range(3):
        own = prose(k, 24, 10**6)
        texts += [own + "".join(f" place number {j} has {'nope' if i >> j & 1 else 'good'}" for j in range(5)) for i in range(32)]
    want = near_by_force(texts)
    assert want == set(range(96)) - {0, 32, 64}
    assert removed_lines(spark, texts) == want


def test_line_dedup_pairs_only_lines_that_may_be_near(spark, monkeypatch):
    """Lines that share a rare shingle are paired if the shingles from there on leave enough to share, in either path."""
    # (shingle, line, component, failed, shingles of the line, place of the shingle, lines that have it)
    rows = [(1, 10, 10, 1, 100, 0, 4), (1, 11, 11, None, 100, 0, 4), (1, 12, 12, None, 50, 0, 4), (1, 13, 10, 1, 100, 0, 4),
            (2, 11, 11, None, 100, 20, 3), (2, 14, 14, 1, 90, 0, 3), (2, 15, 15, None, 100, 1, 3),
            (3, 16, 16, None, 8, 0, 2), (3, 17, 17, None, 8, 0, 2)]
    rare = spark.createDataFrame(rows, "s long, key long, component long, failed int, n int, pos int, lines long").coalesce(1)
    for crowd in (256, 1):
        monkeypatch.setattr(lines, "CROWD", crowd, raising=False)
        got = {(r.a, r.b) for r in lines._across(rare, 0.75).collect()}
        assert got == {(10, 11), (11, 13), (14, 15)}, crowd
    assert {(r.a, r.b) for r in lines._with_smallest(rare, 0.75).collect()} == {(10, 11)}


def test_shuffle_files_of_finished_plans_go(spark):
    import time

    def blocks():
        return {f"{d}/{f}" for d, _, names in os.walk(spark.conf.get("spark.local.dir", "/tmp")) for f in names
                if f.startswith("shuffle_") and f.endswith(".data")}

    before = blocks()
    spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count().write.format("noop").mode("overwrite").save()
    own = blocks() - before
    assert own
    common.release(spark)
    end = time.time() + 60
    while own & blocks() and time.time() < end:
        time.sleep(0.2)
    assert not own & blocks()


def test_bpe_matches_tiktoken_and_decodes(spark):
    import base64

    import tiktoken

    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = ["Hello world, it's 2026!", "a  b \n c\t", " lead", "trail ", "x" * 3000, "<|endoftext|>", "naïve café 你好 🙂", None, "", "a" * 5 + "\n" * 9]
    encoded = bpe.encode(docs(spark, texts), RANKS, public_tokenizers.PATTERN, cache_words=3)
    got = {r.doc_id: r for r in encoded.collect()}
    for i, t in enumerate(texts):
        assert got[i].ids == enc.encode_ordinary(t or "") and bytes(got[i].decoded) == (t or "").encode()
    back = {r.doc_id: bytes(r.decoded) for r in bpe.decode(encoded, RANKS, public_tokenizers.PATTERN).collect()}
    assert back == {i: (t or "").encode() for i, t in enumerate(texts)}
    assert bpe.encode(docs(spark, []), RANKS, public_tokenizers.PATTERN).count() == 0


def test_bpe_remembers_words_met_again_and_cuts_any_text():
    import base64

    import tiktoken

    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng, signs = random.Random(4), [*"  \n\t'sdlvemrtzq1²½.,!#_\0\x1c\x85", "\u00a0", "é", "中", "ª", "ǅ", "😀", "\u0301"]
    texts = ["".join(rng.choices(signs, k=rng.randrange(40))) for _ in range(3000)] + [prose(i, 30) for i in range(50)] + ["qzx" * 200, " "]
    codec = bpe._Codec(RANKS, public_tokenizers.PATTERN, 2000)
    for at in range(0, len(texts), 500):
        ids, decoded = codec.encode(texts[at:at + 500])
        for t, i, d in zip(texts[at:at + 500], ids.to_pylist(), decoded.to_pylist(), strict=True):
            assert np.frombuffer(i, np.int32).tolist() == enc.encode_ordinary(t) and d.decode() == t
    # What is met in every block stays known while other words come and go.
    learnt = []
    codec.learn = lambda words, learn=codec.learn: (learnt.extend(words), learn(words))
    for at in range(12):
        codec.encode(["common words stay", *(prose(1000 + 100 * at + i, 12) + f" w{at}x{i}" for i in range(90))])
    assert "common" in learnt or "common" in codec.pieces
    assert learnt.count(" stay") <= 1


def test_packing_places_every_token_once(spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = [prose(i, 20 * (i % 37)) for i in range(60)] + [None, "", prose(5, 3000), " odd  spaces \n here "]
    ids = [*range(len(texts) - 1), None]
    rows = packing.pack(docs(spark, texts, ids), path, group_docs=20).collect()
    model = Tokenizer.from_file(path)
    model.encode_special_tokens = True
    want = {i: np.array([*model.encode(t or "", add_special_tokens=False).ids, 0], "<u4") for i, t in zip(ids, texts, strict=True)}
    pieces, used = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        used[r.sequence_id].append(r)
        assert r.ids_crc32 == zlib.crc32(want[r.doc_id][r.start:r.start + r.length].tobytes()) and r.doc_tokens == len(want[r.doc_id])
    for i, w in want.items():
        own = sorted(pieces[i], key=lambda r: r.start)
        assert [r.start for r in own] == np.cumsum([0, *[r.length for r in own]])[:-1].tolist() and sum(r.length for r in own) == len(w)
    for seq in used.values():
        seq.sort(key=lambda r: r.offset)
        assert [r.offset for r in seq] == np.cumsum([0, *[r.length for r in seq]])[:-1].tolist() and sum(r.length for r in seq) <= 1024
    assert sum(map(len, want.values())) > 0.7 * 1024 * len(used)
    assert packing.pack(docs(spark, []), path).count() == 0


def test_encoder_gives_the_library_ids():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    model = Tokenizer.from_file(path)
    model.encode_special_tokens = True
    rng, signs = random.Random(3), [*" \n\t'sdlvemrt1²½.,!#_\0\x1c\x85", "\u00a0", "é", "中", "ª", "ǅ", "😀", "\u0301", "<|endoftext|>"]
    texts = ["", " ", prose(1), "it's  we'll\n\n 'ok' a\tb ", *("".join(rng.choices(signs, k=rng.randrange(15))) for _ in range(5000))]
    encode = packing.encoder(path)
    for text, want in zip(texts, model.encode_batch_fast(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(encode(text), "<u4").tolist() == want.ids, text
    with pytest.raises(ValueError):
        packing.encoder(public_tokenizers.path("word_bpe_49k.json"))


def test_balance_evens_cost():
    rng = random.Random(4)
    lengths = [rng.randrange(1, 1000) for _ in range(400)]
    cuts = packing.balance(lengths, 1024)
    room, cost = defaultdict(int), defaultdict(float)
    for n, parts in zip(lengths, cuts, strict=True):
        assert sum(t for _, t, _ in parts) == n and [a for a, _, _ in parts] == np.cumsum([0, *[t for _, t, _ in parts]])[:-1].tolist()
        for _, t, s in parts:
            room[s] += t
            cost[s] += packing.attention_cost(t)
    assert max(room.values()) <= 1024 and len(room) == -(-sum(lengths) // 1024)


def test_language_gradients_match_differences():
    rng = np.random.default_rng(1)
    model = {k: (v.astype(np.float64) if k != "classes" else v) for k, v in language.new_model(["a", "b", "c"], 3).items()}
    data, label = rng.integers(0, 256, (6, 4)).astype(np.uint8), np.array([0, 1, 2, 1])
    _, grad = language.gradients(model, data, label)
    for name in ("uf", "ur", "of", "or", "cf", "cr", "b", "xf"):
        at = (1, 0) if name != "xf" else (4, int(data[2, 1]))
        eps = 1e-4
        up, down = ({**model, name: model[name].copy()} for _ in range(2))
        up[name][at] += eps
        down[name][at] -= eps
        slope = (language.gradients(up, data, label)[0] - language.gradients(down, data, label)[0]) / (2 * eps) / 1
        assert slope == pytest.approx(float(grad[name][at]), rel=2e-2, abs=2e-4)


def test_language_learns_and_has_defined_edges(spark):
    words = {"xx": "aba bab abba baab", "yy": "okto tokk kotto oktok"}
    rng = random.Random(0)
    texts = [(lang, " ".join(rng.choices(words[lang].split(), k=30))) for lang in ("xx", "yy") for _ in range(30)]
    model = language.train([t for _, t in texts], [c for c, _ in texts], rounds=30, windows=64)
    rows = docs(spark, [texts[0][1], texts[-1][1], None, "", "123 !!", texts[0][1] * 40])
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(rows, model, carry=("doc_id", "fp")).collect()}
    assert [got[i][0] for i in range(6)] == ["xx", "yy", "und", "und", "und", "xx"]
    assert got[2][1] == 0 and 0.5 < got[0][1] <= 1
    whole = language.document_scores(model, [texts[0][1] * 40, texts[-1][1]])
    assert np.allclose(whole.sum(axis=1), 1, atol=1e-4)
    assert language.identify(docs(spark, []), model).count() == 0


def test_language_without_labels_is_unknown(spark):
    for rows in (docs(spark, []), docs(spark, ["some text", None]).withColumn("lang", F.lit(None).cast("string"))):
        got = language.identify(rows, language.fit(rows)).collect()
        assert len(got) == rows.count() and all((r.lang_pred, r.score) == ("und", 0.0) for r in got)


def test_fingerprints_of_edits(spark):
    texts = [prose(i, 40) for i in range(9)] + ["", None, prose(0, 40), "single", "😀é" * 7]
    ids = [i * 50 for i in range(len(texts))]
    got = fingerprints.fingerprint_edits(docs(spark, texts, ids)).orderBy("doc_id").collect()
    plain = [t or "" for t in texts]
    for k, r in enumerate(got):
        t, after = plain[k], plain[(k + 1) % len(plain)]
        edited = t[:len(t) - len(t) // 2] + after[:len(t) // 2]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.near_next == 1 - bin(int(r.fingerprint, 16) ^ int(got[(k + 1) % len(got)].fingerprint, 16)).count("1") / 64
        near = sum(bin(int(r.fingerprint, 16) ^ int(o.fingerprint, 16)).count("1") <= 3 for o in got) - 1
        assert r.n_near == (near if r.doc_id % 100 == 0 else None)
    assert got[0].fingerprint == got[11].fingerprint and got[9].fingerprint == "0" * 16
    assert np.mean([r.near_edited for r in got[:9]]) > np.mean([r.near_next for r in got[:9]])
    assert fingerprints.fingerprint_edits(docs(spark, [])).count() == 0


def test_fingerprints_of_scripts_without_spaces(spark):
    rng = random.Random(9)
    text = "".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(600))
    other = "".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(600))
    texts = [(1, text), (2, text[:300] + "的" + text[301:]), (3, other)]
    df = spark.createDataFrame(texts, "key long, t string")
    fp = {r.key: r.fp & (1 << 64) - 1 for r in fingerprints.fingerprints(df).collect()}
    assert bin(fp[1] ^ fp[2]).count("1") <= 6 < 16 < bin(fp[1] ^ fp[3]).count("1")


def test_radius_search_is_complete(spark):
    rng = random.Random(6)
    base = [rng.getrandbits(64) for _ in range(30)]
    items = base + [x ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 6))) for x in base]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    df = spark.createDataFrame([(signed(x),) for x in set(items)], "fp long")
    got = {(r.query, r.item) for r in fingerprints.within_radius(df, df, 3).collect()}
    assert got == {(signed(a), signed(b)) for a in set(items) for b in set(items) if bin(a ^ b).count("1") <= 3}


def test_chat_snapshots_collapse(spark):
    turns = [(r, f"t{i}") for i, r in enumerate(["user", "assistant"] * 3)]
    logs = {1: turns[:2], 2: turns[:4], 3: turns, 4: turns, 5: [*turns[:3], ("assistant", "other")], 6: [("user", None)], 7: [(None, "t0")], 8: [("user", "t0")]}
    rows = [(c, i, r, t, 9) for c, ts in logs.items() for i, (r, t) in enumerate(ts)] + [(3, 0, "user", "t0", 1), (None, 0, "user", "zz", 1)]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, part int")
    got = {r.conv_id: r for r in chat.format_chats(df).collect()}
    assert sorted(got) == [3, 5, 6, 7] and got[3].n_turns == 6
    assert got[6].rendered == "<|im_start|>user\n<|im_end|>\n" and got[7].rendered.startswith("<|im_start|>unknown\nt0")
    long = spark.createDataFrame([(c, i, "user", f"{i}") for c, n in ((1, 700), (2, 300)) for i in range(n)], "conv_id long, turn int, role string, text string")
    parts = chat.format_chats(long).orderBy("part").collect()
    assert [(r.conv_id, r.part, r.n_turns) for r in parts] == [(1, 0, 700), (1, 1, 700), (1, 2, 700)]
    assert "".join(r.rendered for r in parts) == "".join(f"<|im_start|>user\n{i}<|im_end|>\n" for i in range(700))
    assert chat.format_chats(df.limit(0)).count() == 0


def test_vectors_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "CELL", 16)
    rng = np.random.default_rng(5)
    base = rng.normal(size=(40, 12))
    vectors = [*base, *(base[:20] + rng.normal(scale=0.05, size=(20, 12))), *(base[0] + rng.normal(scale=0.08, size=(30, 12))), *[base[1]] * 25]
    labels = [i % 3 for i in range(40)] + [i % 3 for i in range(20)] + [0] * 30 + [1] * 25
    rows = [(i, [float(x) for x in v], c, 1) for i, (v, c) in enumerate(zip(vectors, labels, strict=True))]
    n = len(rows)
    odd = [(n, None, 0, 1), (n + 1, [0.0] * 12, 0, 1), (n + 2, [float("nan")] * 12, 0, 1), (n + 3, [1.0, None] + [0.0] * 10, 0, 1),
           (n + 4, [float(x) for x in base[0]], None, 1), (n + 5, [1.0, 2.0], 0, 1), (n + 6, [], 0, 1), (n + 7, [float("inf")] * 12, 1, 1)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, label int, k int")
    got = {r.vec_id: r for r in embeddings.near_vectors(df).collect()}
    x = np.array([np.array(r[1], np.float32).astype(float) for r in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    link = (x @ x.T >= 0.98) & (np.array(labels)[:, None] == np.array(labels)) & ~np.eye(n, dtype=bool)
    root = union_find(n, list(zip(*np.nonzero(link), strict=True)))
    assert link.sum() > 700
    for i in range(n):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (int(link[i].sum()), root[i], root[i] == i)
    assert all((got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True) for i in range(n, n + len(odd)))
    assert embeddings.near_vectors(df.limit(0)).count() == 0


PAGE = """<!doctype html><html><head><title> A &amp; B </title><style>p{}</style><script>if (a<b) "</p>"</script></head><body>
<h1>Head</h1><p>One <b>bold</b> word<p>Two<br>lines &lt;here&gt;
<ul><li>first<li>second<ol start=3><li>inner</ol></ul><div hidden>no</div><div style="display: none">no</div>
<table><tr><th>Name<th>Size<tr><td>apple<td>10</td></tr><tr><td>fig</td><td>2 x</td></table><pre>  keep
   this</pre><!-- no --><p>end <img alt="pic">"""


def test_html_layout(spark):
    got = htmltext.render(htmltext.parse(PAGE))
    assert got == ("Head\n\nOne bold word\n\nTwo\nlines <here>\n\n- first\n- second\n\n  3. inner\n\nName   Size\napple  10\nfig    2 x\n\n"
                   "  keep\n   this\n\nend pic")
    df = spark.createDataFrame([(1, PAGE), (2, None), (3, ""), (4, "a < b <"), (5, "<div>" * 5000 + "deep")], "page_id long, html string")
    rows = {r.page_id: r for r in htmltext.extract(df).collect()}
    assert rows[1].title == "A & B" and rows[1].text == got and rows[2].text == "" and rows[3].n_chars == 0
    assert rows[4].text == "a < b <" and rows[5].text == "deep"
    assert htmltext.extract(df.limit(0)).count() == 0


def test_html_formulas_drawings_and_choices(spark):
    page = ("<p>Area <math><semantics><mi>r</mi><mo>+</mo><mn>1</mn><annotation>r plus 1</annotation></semantics></math> holds"
            "<p>Draw <svg><title>no</title><desc>no</desc><defs><text>no</text></defs><text x=1>left</text><text>right</text></svg>"
            "<p>Pick <select><option>red<option selected>blue</select> now")
    assert htmltext.render(htmltext.parse(page)) == "Area r+1 holds\n\nDraw\nleft\nright\n\nPick\nred\nblue\nnow"


def test_pipeline_keeps_documents_of_low_score(spark):
    import corpus_pipeline as p

    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet")
    short = docs(spark, ["Ereaea.", "Ourere ertible thheedre.", "Re.", "A.", "De.", "123 !!"], range(10**6, 10**6 + 6)).select(rows.columns)
    short = short.withColumn("doc_id", F.col("doc_id").cast(rows.schema["doc_id"].dataType))
    kept = {r.doc_id for r in p.language_id(spark, rows.unionByName(short), sf).where("doc_id >= 1000000").collect()}
    assert kept == set(range(10**6, 10**6 + 5))


def test_pipeline_keeps_clean_documents_and_its_columns(spark, tmp_path):
    import corpus_pipeline as p

    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet")
    kept = p.language_id(spark, rows, sf)
    assert kept.columns == rows.columns and kept.count() >= 0.97 * rows.count()
    deduped = p.line_dedup(spark, rows, sf)
    assert deduped.columns == rows.columns and deduped.count() <= rows.count()
    one = p.ngram_jaccard(spark, rows, sf)
    groups = shingle_join.near_groups(rows)
    assert one.columns == rows.columns and one.count() == groups.select("component_id").distinct().count()
    cut = p.substring_dedup(spark, one, sf)
    assert cut.columns == rows.columns and cut.where(F.col("text").rlike(r"\S")).count() == cut.count()
    packed = p.pack(spark, cut, sf)
    assert packed.select("doc_id").distinct().count() == cut.count()
