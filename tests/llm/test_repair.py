"""Structure repair against a search over all edit sequences."""

import hashlib
import heapq
import itertools
import random
import re
import zlib
from collections import defaultdict

from tessera.llm import repair

GRAMMAR = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
NAMES = {"u": "user", "a": "assistant"}


def brute(rows):
    """The report of one conversation's rows, in order, by a best-first search over single edits."""
    seen, fault = set(), []
    for _, role, text in rows:
        inked = re.findall(r"[^\x20\x09-\x0D]", text)
        fault.append("blank" if not inked else "duplicate" if (role, text) in seen else None if inked[-1] in ".!?" else "truncated")
        seen.add((role, text))
    heap, done = [(0, "", 0, 0, ())], set()
    while True:
        cost, audit, i, state, out = heapq.heappop(heap)
        if i == len(rows) and state in (0, 3):
            break
        if (i, state) in done:      # of one position and state no later audit can win: none is a prefix at equal cost
            continue
        done.add((i, state))
        steps = [(c, GRAMMAR[state, c]) for c in "sua" if (state, c) in GRAMMAR]
        if len(audit) < 2 * len(rows) + 4:
            for c, to in steps:
                if c in NAMES:
                    heapq.heappush(heap, (cost + 2, audit + "I", i, to, (*out, (NAMES[c], ""))))
        if i < len(rows):
            _, role, text = rows[i]
            extra = fault[i] == "truncated"
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, state, out))
            for c, to in steps if fault[i] in (None, "truncated") else ():
                if c == role[:1]:
                    heapq.heappush(heap, (cost + extra, audit + "K", i + 1, to, (*out, (role, text))))
                if c in NAMES:
                    heapq.heappush(heap, (cost + 2 + extra, audit + "R", i + 1, to, (*out, (NAMES[c], text))))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    return (gaps, *map(fault.count, ("blank", "duplicate", "truncated")), illegal, cost, audit,
            hashlib.sha256("\n".join(f"{r}:{x}" for r, x in out).encode()).hexdigest())


def expected(rows, damage=True):
    of = defaultdict(list)
    for conv, turn, role, text in rows:
        of[conv] += []
        d = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damage else 9
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if d == 1 else re.sub("[.!?]", "", text) if d == 2 else text
        of[conv] += [(turn, "user" if d == 4 else role, text)] * (0 if d == 0 else 2 if d == 3 else 1)
    return {c: brute(sorted(v, key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))) for c, v in of.items()}


def run(df, damage=True):
    return {r[0]: tuple(r)[1:] for r in repair.digests(*repair.repair(df, damage=damage)).collect()}


KIND = "conv_id long, turn long, role string, text string, cost string, pos long"


def odd_rows(n, longest):
    rng = random.Random(n)
    return [(c, rng.choice([None, k, k, k, k]), rng.choice(["user", "assistant", "system", "tool", None, "", "user", "assistant"]),
             rng.choice(["a.", "b", "c!", " ", "x y", None, "dd?  ", f"{k}.", f"{k}"]))
            for c in [*range(n), None] for k in range(rng.randrange(0, longest))]


def test_repairs_match_a_search_over_edits(spark):
    rows = odd_rows(60, 9)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], KIND).repartition(4)
    assert run(df) == expected(rows)
    assert run(df, damage=False) == expected(rows, damage=False)


def test_long_conversations_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(repair, "BLOCK_ROWS", 2)
    monkeypatch.setattr(repair, "FAN", 2)
    rows = odd_rows(6, 20)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], KIND).repartition(4)
    assert run(df) == expected(rows)


def test_given_conversations(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    assert run(df) == expected([tuple(r) for r in df.collect()])


def test_turns_of_a_repair(spark):
    df = spark.createDataFrame([(1, 0, "system", "s.", "", 0), (1, 1, "assistant", "a.", "", 0), (1, 2, "user", "q", "", 0), (2, 0, "user", " ", "", 0)], KIND)
    report, turns, audits = repair.repair(df, damage=False)
    assert {r.conv_id: (r.cost, r.audit) for r in report.collect()} == {1: (5, "KIKD"), 2: (3, "D")}
    assert sorted(map(tuple, repair.repaired_turns(turns, audits).collect())) == [
        (1, 0, "system", "s."), (1, 1, "user", ""), (1, 2, "assistant", "a.")]
    assert run(df.limit(0)) == {}


def test_any_split_gives_the_same_cell():
    """The full table over all spans and splits has the cell of the one split that the operator takes."""
    rng = random.Random(3)
    for _ in range(40):
        codes = rng.choices("suaoSUAOx", k=rng.randrange(1, 9))
        table = {(i, i + 1): repair.terminal(c) for i, c in enumerate(codes)}
        for size in range(2, len(codes) + 1):
            for i in range(len(codes) - size + 1):
                splits = [repair.combined(table[i, k], table[k, i + size]) for k in range(i + 1, i + size)]
                assert all(s == splits[0] for s in splits)
                table[i, i + size] = splits[0]
        assert repair.parse([repair.terminal(c) for c in codes]) == table[0, len(codes)]
