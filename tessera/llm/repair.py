"""Structure repair of conversations by weighted interval parsing (CYK).

A repaired conversation has an optional system turn and then one or more pairs of user and assistant turns, or it is
empty.  Its automaton has the states of ``STEPS``; the repair grammar in Chomsky normal form has one nonterminal
(p, q) for each pair of states, with the rules

    (p, q) -> (p, r) (r, q)             for all states r
    (p, q) -> a turn                    by keeping, reroling or deleting it, after any insertions before it

A cell holds, for the nonterminals that derive a span of turns, the least (cost, audit); ties go to the ASCII-least
audit, and insertions are closed over in the lexical rules and at the end of the conversation.  Insertions stand before
the turn they precede, so every audit of a span ends with the edit of its last turn and none is a prefix of another:
least parts make the least whole.  Because the nonterminals are pairs of states, a derivation of a span passes some
state at every inner border, so all splits of a span give the same cell and one split is enough.  Cells are combined
bottom-up by span length: inside blocks of rows, then blocks of a conversation, a bounded number at a time, so a
conversation of any length is parsed without holding its turns in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

USER, ASSISTANT = "user", "assistant"
# Fixed values of the contract: states 0 (nothing yet), 1 (after system), 2 (after user), 3 (after assistant), the role
# initial of each step, where a conversation may end, and the cost of each edit.
STEPS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ENDS = (0, 3)
LEGAL_PAIRS = ("su", "ua", "au")
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
SPACE = r"[^\x20\x09-\x0D]"         # a character that is no white space
BLOCK_ROWS = 1024                   # turns of a block, of one row of codes
FAN = 32                            # cells that one step combines


# ------------------------------------------------------------------------------------------------------------ cells
def insertions() -> dict[tuple[int, int], int]:
    """(p, q) -> the least number of inserted user or assistant turns that lead from p to q (0 for p = q)."""
    out = {(p, p): 0 for p in range(4)}
    for n in range(1, 5):
        for (p, q), k in list(out.items()):
            for (r, initial), to in STEPS.items():
                if k == n - 1 and r == q and initial in "ua" and (p, to) not in out:
                    out[p, to] = n
    return out


def terminal(code: str) -> dict[tuple[int, int], tuple[int, str]]:
    """The cell of one turn.  Its code is the role initial (s, u, a, or o for any other), in upper case if the turn is
    truncated, or "x" if it has to go."""
    low = code.lower()
    extra = TRUNCATED if code != low else 0
    steps = [((p, p), DELETE, "D") for p in range(4)]
    if code != "x":
        steps += [((p, q), extra, "K") for (p, initial), q in STEPS.items() if initial == low]
        steps += [((p, q), REROLE + extra, "R") for (p, initial), q in STEPS.items() if initial in "ua"]
    cell: dict = {}
    for (p, r), n in insertions().items():
        for (at, q), cost, letter in steps:
            if at == r:
                found = (cost + n * INSERT, "I" * n + letter)
                cell[p, q] = min(cell.get((p, q), found), found)
    return cell


def combined(left: dict, right: dict) -> dict:
    """The cell of two neighbouring spans: every binary rule, the least (cost, audit) of each nonterminal."""
    after: dict[int, list] = {}
    for (r, q), value in right.items():
        after.setdefault(r, []).append((q, value))
    cell: dict = {}
    for (p, r), (cost, audit) in left.items():
        for q, (more, rest) in after.get(r, ()):
            known = cell.get((p, q))
            if known is None or cost + more < known[0] or cost + more == known[0] and audit + rest < known[1]:
                cell[p, q] = (cost + more, audit + rest)
    return cell


def parse(cells: list[dict]) -> dict:
    """The cell of the whole span of ``cells``, combined bottom-up by span length; no cells: the empty span."""
    if not cells:
        return {(p, p): (0, "") for p in range(4)}
    while len(cells) > 1:
        cells = [combined(*cells[i:i + 2]) if i + 1 < len(cells) else cells[i] for i in range(0, len(cells), 2)]
    return cells[0]


def finished(cell: dict) -> tuple[int, str]:
    """The least (cost, audit) from the first state to an end, with the insertions after the last turn."""
    ways = [(cost + n * INSERT, audit + "I" * n) for (p, r), (cost, audit) in cell.items() if p == 0
            for (at, q), n in insertions().items() if at == r and q in ENDS]
    return min(ways)


# ---------------------------------------------------------------------------------------------------------- summaries
SUMMARY = "struct<illegal:bigint,first:string,last:string,cell:array<struct<p:int,q:int,cost:bigint,audit:string>>>"


def block_summary(codes: str, initials: str) -> tuple:
    """Illegal neighbours, first and last role initial, and the cell of a block of turns."""
    known = {c: terminal(c) for c in set(codes)}
    illegal = sum(initials[i:i + 2] not in LEGAL_PAIRS for i in range(len(initials) - 1))
    return illegal, initials[0], initials[-1], _listed(parse([known[c] for c in codes]))


def merged_summary(parts: list) -> tuple:
    """The summary of neighbouring spans, in order."""
    illegal = sum(p["illegal"] for p in parts)
    illegal += sum(a["last"] + b["first"] not in LEGAL_PAIRS for a, b in zip(parts, parts[1:], strict=False))
    cells = [{(x["p"], x["q"]): (x["cost"], x["audit"]) for x in p["cell"]} for p in parts]
    return illegal, parts[0]["first"], parts[-1]["last"], _listed(parse(cells))


def _listed(cell: dict) -> list[tuple[int, int, int, str]]:
    return [(p, q, cost, audit) for (p, q), (cost, audit) in sorted(cell.items())]


def finished_summary(parts: list) -> tuple[int, int, str]:
    """(illegal, cost, audit) of a whole conversation from its last summaries."""
    illegal, _, _, listed = merged_summary(parts)
    return illegal, *finished({(p, q): (cost, audit) for p, q, cost, audit in listed})


def summaries(turns: DataFrame) -> DataFrame:
    """(conv, illegal, cost, audit) of every conversation of (conv, pos, code, initial).

    Blocks of BLOCK_ROWS consecutive positions are parsed first; while a conversation has more than FAN summaries they
    are combined FAN at a time, each round written, so no task holds more than FAN of them."""
    of_block = F.udf(block_summary, SUMMARY, useArrow=True)
    of_parts = F.udf(merged_summary, SUMMARY, useArrow=True)
    rows = F.array_sort(F.collect_list(F.struct("pos", "code", "initial")))
    level = saved(turns.groupBy("conv", F.expr(f"pos div {BLOCK_ROWS}").alias("block")).agg(rows.alias("r"))
                  .select("conv", "block", of_block(F.array_join("r.code", ""), F.array_join("r.initial", "")).alias("s")))
    parts = F.array_sort(F.collect_list(F.struct("block", "s")))["s"]
    while (level.groupBy("conv").count().agg(F.max("count")).first()[0] or 0) > FAN:
        number = F.row_number().over(Window.partitionBy("conv").orderBy("block")) - 1
        level = saved(level.withColumn("group", F.floor(number / FAN)).groupBy("conv", "group").agg(parts.alias("p"))
                      .select("conv", F.col("group").alias("block"), of_parts("p").alias("s")))
    done = F.udf(finished_summary, "struct<illegal:bigint,cost:bigint,audit:string>", useArrow=True)
    return level.groupBy("conv").agg(parts.alias("p")).select("conv", done("p").alias("f")).select("conv", "f.*")


# ------------------------------------------------------------------------------------------------------------- turns
def damaged(chats: DataFrame) -> DataFrame:
    """The rows of (conv, turn, role, text) after the contract's damage by crc32 of `conv:turn` modulo 20."""
    blank = F.lit(" ")
    name = F.concat_ws(":", F.coalesce(F.col("conv").cast("string"), blank), F.coalesce(F.col("turn").cast("string"), blank))
    rows = chats.select("conv", "turn", F.coalesce(F.col("role").cast("string"), blank).alias("role"),
                        F.coalesce(F.col("text").cast("string"), blank).alias("text"),
                        F.pmod(F.crc32(name.cast("binary")), F.lit(20)).alias("_d")).where("_d <> 0")
    d = F.col("_d")
    text = F.when(d == 1, "").when(d == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.select("conv", "turn", F.when(d == 4, USER).otherwise(F.col("role")).alias("role"), text.alias("text"),
                       F.explode(F.when(d == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))


def placed(rows: DataFrame) -> DataFrame:
    """The rows with ``pos``, unique and ascending in order of (turn, role, text, copy) inside each conversation.

    Rows are dealt by range of conversation and turn and sorted, so a conversation of any size spreads over tasks and
    every partition holds consecutive rows; they are written with their positions."""
    n = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    by = ["conv", "turn", "role", "text", "copy"]
    return saved(rows.repartitionByRange(n, *by).sortWithinPartitions(*by).withColumn("pos", F.monotonically_increasing_id()))


def faults(turns: DataFrame) -> DataFrame:
    """(conv, turn, pos, fault, initial, code): the first fault of each row (blank, duplicate, truncated or null)."""
    text = F.col("text")
    key = [F.xxhash64("role", "text").alias("k1"), F.xxhash64(F.lit(7919), "role", "text").alias("k2")]
    initial = F.substring("role", 1, 1)
    rows = turns.select("conv", "turn", "pos", *key, F.when(initial.isin("s", "u", "a"), initial).otherwise("o").alias("initial"),
                        (~text.rlike(SPACE)).alias("blank"), (~text.rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("cut"))
    first = rows.groupBy("conv", "k1", "k2").agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("first"))
    fault = (F.when(F.col("blank"), "blank").when(F.col("first").isNull(), "duplicate").when(F.col("cut"), "truncated"))
    code = (F.when(F.col("fault").isin("blank", "duplicate"), "x").when(F.col("fault") == "truncated", F.upper("initial"))
            .otherwise(F.col("initial")))
    return (rows.join(first, "pos", "left").withColumn("fault", fault)
            .select("conv", "turn", "pos", "fault", "initial", code.alias("code")))


def repaired_turns(turns: DataFrame, audits: DataFrame, digest: bool = False) -> DataFrame:
    """(conv, at, role, text): the repaired conversations turn by turn; with ``digest`` (conv, repaired_sha256) instead,
    the hash of `role:text` of all turns joined by newlines.

    Every conversation's audit goes ahead of its turns in a stream sorted by conversation and position, which a task
    reads once, holding one audit and one batch."""
    kind = turns.schema["conv"].dataType.simpleString()
    stream = (turns.select("conv", "pos", "role", "text")
              .unionAll(audits.select("conv", F.lit(-1).cast("long").alias("pos"), F.lit("").alias("role"), F.col("audit").alias("text")))
              .repartition("conv").sortWithinPartitions("conv", "pos"))

    def run(batches):
        import hashlib

        import pyarrow as pa

        conv_type, audit, at, count, spoken, state, conv = None, "", 0, 0, 0, hashlib.sha256(), None
        rows: list = []

        def put(role, text):
            nonlocal count
            if digest:
                state.update(("\n" * (count > 0) + role + ":" + text).encode())
            else:
                rows.append((conv, count, role, text))
            count += 1

        def inserts():
            nonlocal at, spoken
            while audit[at:at + 1] == "I":
                put((USER, ASSISTANT)[spoken % 2], "")
                at, spoken = at + 1, spoken + 1

        def close():
            inserts()
            if digest and conv_type is not None:
                rows.append((conv, state.hexdigest()))

        def flush():
            out = list(zip(*rows, strict=True)) or [()] * (2 if digest else 4)
            rows.clear()
            kinds = [conv_type, pa.string()] if digest else [conv_type, pa.int64(), pa.string(), pa.string()]
            names = ["conv", "repaired_sha256"] if digest else ["conv", "at", "role", "text"]
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, kinds, strict=True)], names=names)

        for batch in batches:
            for new, pos, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if pos < 0:
                    close()
                    conv_type = batch.column(0).type
                    conv, audit, at, count, spoken, state = new, text, 0, 0, 0, hashlib.sha256()
                    continue
                inserts()
                letter, at = audit[at], at + 1
                if letter == "D":
                    continue
                if letter == "K":
                    put(role, text)
                    spoken += role[:1] != "s"
                else:
                    put((USER, ASSISTANT)[spoken % 2], text)
                    spoken += 1
            if conv_type is not None:
                yield flush()
        if conv_type is not None:
            close()
            yield flush()

    return stream.mapInArrow(run, f"conv {kind}, repaired_sha256 string" if digest else f"conv {kind}, at long, role string, text string")


def repair(chats: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
           damage: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(report, turns, audits): the report of every conversation, and what ``repaired_turns`` takes.

    The report has conv_id, gaps, blank, duplicate, truncated, illegal, cost and audit.  Rows are taken in order of (turn,
    role, text), null turns first.  Null roles and texts read as one space (a null text is blank); a role whose initial
    is not s, u or a, or is missing, cannot be kept.  Rows with a null conversation id are a conversation of their own;
    a repeated row is a duplicate of the first.  A conversation without rows has zeros and an empty audit; an empty
    table gives an empty result; other columns are not carried, so none can clash.  ``damage=False`` repairs the rows
    as they are."""
    rows = chats.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"),
                        F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    blank = F.lit(" ")
    turns = placed(damaged(rows) if damage else rows.select(
        "conv", "turn", F.coalesce(F.col("role").cast("string"), blank).alias("role"),
        F.coalesce(F.col("text").cast("string"), blank).alias("text"), F.lit(0).alias("copy")))
    found = saved(faults(turns))
    parsed = saved(summaries(found))
    count = [F.count_if(F.col("fault") == x).alias(x) for x in ("blank", "duplicate", "truncated")]
    counts = found.groupBy(F.col("conv").alias("_c")).agg(*count)
    span = (found.where("turn is not null").select("conv", "turn").distinct().groupBy(F.col("conv").alias("_g"))
            .agg((F.max("turn") - F.min("turn") + 1 - F.count(F.lit(1))).alias("gaps")))
    every = rows.select(F.col("conv").alias("_every")).distinct()
    same = lambda name: F.col("_every").eqNullSafe(F.col(name))
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    report = (every.join(parsed, same("conv"), "left").join(counts, same("_c"), "left").join(span, same("_g"), "left")
              .select(F.col("_every").alias(conv_col), *[F.coalesce(n, F.lit(0).cast("long")).alias(n) for n in numbers],
                      F.coalesce("audit", F.lit("")).alias("audit")))
    return report, turns, parsed


def digests(report: DataFrame, turns: DataFrame, audits: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """The report with ``repaired_sha256``; a conversation without rows has the hash of the empty string."""
    hashed = repaired_turns(turns, audits, digest=True).withColumnRenamed("conv", "_conv")
    empty: Column = F.sha2(F.lit("").cast("binary"), 256)
    return (report.join(hashed, F.col(conv_col).eqNullSafe(F.col("_conv")), "left")
            .withColumn("repaired_sha256", F.coalesce("repaired_sha256", empty)).drop("_conv"))
