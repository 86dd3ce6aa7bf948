"""Conversation structure repair: the cheapest edits that make each conversation's roles ``(s?(ua)+)?``.

Rows are damaged first (see ``damaged``), then each conversation's rows are taken by turn (nulls first; equal turns by
role, text, then copy). Each row has at most one fault, the first that holds: blank (no character outside ASCII white
space), duplicate (the same role and text on an earlier row), truncated (its last such character is not ``.``, ``!`` or
``?``). Edits: Keep (0), Rerole to user or assistant (2), Delete (3; the only edit for blank and duplicate rows), Insert an
empty user or assistant row anywhere (2); a kept or reroled truncated row costs 1 more. The role initials of the result
must read ``(s?(ua)+)?``; of all cheapest edit sequences the one whose initials (``D``, ``I``, ``K``, ``R``) are
ASCII-least is taken.

Method, secondary-sorted streaming: one exchange deals rows by conversation (a window sorted by role and text inside each
conversation marks duplicates on the way). Inside each partition rows are sorted by conversation and *descending* turn,
and a ``mapInPandas`` pass runs the dynamic programme backwards over Arrow batches, carrying four costs (one per state of
the pattern's automaton) from batch to batch and writing beside each row its compact backpointers: for each state the
first edit of the ASCII-least cheapest continuation. The same partition is sorted ascending and a second pass walks the
backpointers forwards, carrying the state, a running sha256 and the counts across batches, and writes one row per
conversation. Memory per task is a batch plus the audit of the conversation being walked: a conversation holding a third
of all rows streams through one task, which it has to, as the programme is sequential, but never sits in memory whole.

Defined cases: null role or text is one space; a null conv_id is one conversation; conversations whose rows are all
dropped by damage return zeros, an empty audit and the sha256 of the empty string; an empty table gives no rows; columns
beside conv_id, turn, role and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: The pattern's automaton. States: 0 start, 1 after s, 2 after u, 3 after a; 0 and 3 accept.
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
#: The role an insert or a rerole must take in each state (neither can make a system row).
MADE = {0: "user", 1: "user", 2: "assistant", 3: "user"}
COST = {"K": 0, "R": 2, "D": 3, "I": 2}
ACCEPTING = (0, 3)
SPACE = r"\x20\x09-\x0D"

FAULTS = "conv_id long, cnull boolean, turn long, tnull boolean, role string, text string, copy int, fault string"


def damaged(rows: DataFrame) -> DataFrame:
    """Rows after damage by crc32(``conv_id:turn``) % 20 (nulls written as one space): 0 drops the row, 1 empties its
    text, 2 removes its ``.!?``, 3 repeats it (same turn, ``copy`` 1), 4 makes its role user. Null role and text are
    one space."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    how = F.crc32(key.cast("binary")) % 20
    text, role = F.coalesce(F.col("text"), F.lit(" ")), F.coalesce(F.col("role"), F.lit(" "))
    return (rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), how.alias("how"))
            .where("how != 0")
            .select("conv_id", "turn",
                    F.when(F.col("how") == 4, "user").otherwise(F.col("role")).alias("role"),
                    F.when(F.col("how") == 1, "").when(F.col("how") == 2, F.regexp_replace("text", "[.!?]", ""))
                    .otherwise(F.col("text")).alias("text"),
                    F.explode(F.when(F.col("how") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
                    .alias("copy")))


def with_faults(rows: DataFrame) -> DataFrame:
    """Damaged rows dealt by conversation with their first fault: ``b``, ``d``, ``t`` or empty."""
    same = Window.partitionBy("conv_id").orderBy("role", "text", F.col("turn").asc_nulls_first(), "copy")
    seen = (F.lag("role").over(same) == F.col("role")) & (F.lag("text").over(same) == F.col("text"))
    blank = ~F.col("text").rlike(f"[^{SPACE}]")
    last = F.regexp_extract("text", f"([^{SPACE}])[{SPACE}]*$", 1)
    fault = (F.when(blank, "b").when(F.coalesce(seen, F.lit(False)), "d")
             .when(~last.isin(".", "!", "?"), "t").otherwise(""))
    return rows.select("*", fault.alias("fault")).select(
        F.coalesce("conv_id", F.lit(0)).cast("long").alias("conv_id"), F.col("conv_id").isNull().alias("cnull"),
        F.coalesce("turn", F.lit(0)).cast("long").alias("turn"), F.col("turn").isNull().alias("tnull"),
        "role", "text", "copy", "fault")


def _options(state: int, role: str, fault: str, after: list[float]) -> list[tuple[float, str, int]]:
    """(cost, edit, next state) of the edits of one row; ``after`` holds the costs from the next row on."""
    extra = 1 if fault == "t" else 0
    found = [(COST["D"] + after[state], "D", state)]
    if fault in ("b", "d"):
        return found
    nxt = STEP.get((state, role[:1]))
    if nxt is not None:
        found.append((extra + after[nxt], "K", nxt))
    nxt = STEP[(state, MADE[state][:1])]
    found.append((COST["R"] + extra + after[nxt], "R", nxt))
    return found


def _with_inserts(row: list[tuple[float, str]]) -> list[tuple[float, str]]:
    """Costs and first edits of the four states once inserts before the row are allowed (a few relaxations)."""
    best = list(row)
    for _ in range(4):
        for q in range(4):
            nxt = STEP[(q, MADE[q][:1])]
            cand = (COST["I"] + best[nxt][0], "I")
            if cand < best[q]:
                best[q] = cand
    return best


END = _with_inserts([(0.0, "") if q in ACCEPTING else (float("inf"), "") for q in range(4)])


def step_back(role: str, fault: str, after: list[float]) -> tuple[list[float], str]:
    """Costs from this row on and the four backpointers (one edit initial per state)."""
    row = [min((c, e) for c, e, _ in _options(q, role, fault, after)) for q in range(4)]
    best = _with_inserts(row)
    return [c for c, _ in best], "".join(e for _, e in best)


def _backwards(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    key, after = None, None
    for frame in frames:
        marks = []
        for conv, cnull, role, fault in zip(frame["conv_id"], frame["cnull"], frame["role"], frame["fault"]):
            if (conv, cnull) != key:
                key, after = (conv, cnull), [c for c, _ in END]
            after, back = step_back(role, fault, after)
            marks.append(back)
        yield frame.assign(back=marks)


class _Walk:
    """One conversation walked forwards along the backpointers."""

    def __init__(self, conv, cnull):
        self.conv, self.cnull = conv, cnull
        self.state, self.cost, self.audit = 0, 0, []
        self.digest, self.lines = hashlib.sha256(), 0
        self.counts = {"b": 0, "d": 0, "t": 0}
        self.illegal, self.previous = 0, None
        self.turns, self.low, self.high, self.last_turn = 0, None, None, None

    def _line(self, role: str, text: str):
        self.digest.update((("\n" if self.lines else "") + f"{role}:{text}").encode())
        self.lines += 1

    def _insert(self):
        made = MADE[self.state]
        self.audit.append("I")
        self.cost += COST["I"]
        self._line(made, "")
        self.state = STEP[(self.state, made[:1])]

    def row(self, turn, tnull, role, text, fault, back):
        if fault:
            self.counts[fault] += 1
        initial = role[:1]
        if self.previous is not None and self.previous + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.previous = initial
        if not tnull:
            if turn != self.last_turn:
                self.turns += 1
            self.last_turn = turn
            self.low = turn if self.low is None else min(self.low, turn)
            self.high = turn if self.high is None else max(self.high, turn)
        while back[self.state] == "I":
            self._insert()
        edit = back[self.state]
        self.audit.append(edit)
        extra = 1 if fault == "t" else 0
        if edit == "D":
            self.cost += COST["D"]
        elif edit == "K":
            self.cost += extra
            self._line(role, text)
            self.state = STEP[(self.state, initial)]
        else:
            made = MADE[self.state]
            self.cost += COST["R"] + extra
            self._line(made, text)
            self.state = STEP[(self.state, made[:1])]

    def result(self) -> dict:
        while END[self.state][1] == "I":
            self._insert()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return {"conv_id": None if self.cnull else self.conv, "gaps": gaps, "blank": self.counts["b"],
                "duplicate": self.counts["d"], "truncated": self.counts["t"], "illegal": self.illegal,
                "cost": self.cost, "audit": "".join(self.audit), "repaired_sha256": self.digest.hexdigest()}


RESULT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired_sha256 string")


def _forwards(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    walk = None
    for frame in frames:
        done = []
        for conv, cnull, turn, tnull, role, text, fault, back in zip(
                frame["conv_id"], frame["cnull"], frame["turn"], frame["tnull"], frame["role"], frame["text"],
                frame["fault"], frame["back"]):
            if walk is None or (walk.conv, walk.cnull) != (conv, cnull):
                if walk is not None:
                    done.append(walk.result())
                walk = _Walk(conv, cnull)
            walk.row(int(turn), bool(tnull), role, text, fault, back)
        if done:
            yield _frame(done)
    if walk is not None:
        yield _frame([walk.result()])


def _frame(rows: list[dict]) -> pd.DataFrame:
    frame = pd.DataFrame(rows)
    frame["conv_id"] = frame["conv_id"].astype("Int64")
    return frame


def repair_conversations(rows: DataFrame) -> DataFrame:
    """One row per conversation after damage; see the module docstring (``RESULT`` columns)."""
    faults = with_faults(damaged(rows))
    order = [F.col("cnull"), F.col("conv_id"), F.col("tnull").desc(), F.col("turn"), F.col("role"), F.col("text"),
             F.col("copy")]
    backwards = [F.col("cnull"), F.col("conv_id"), F.col("tnull"), F.col("turn").desc(), F.col("role").desc(),
                 F.col("text").desc(), F.col("copy").desc()]
    marked = faults.sortWithinPartitions(*backwards).mapInPandas(_backwards, FAULTS + ", back string")
    return marked.sortWithinPartitions(*order).mapInPandas(_forwards, RESULT)


def repaired_table(rows: DataFrame) -> DataFrame:
    """``repair_conversations`` with every original conv_id: those without rows after damage get zeros, an empty
    audit and the sha256 of the empty string."""
    found = repair_conversations(rows)
    every = rows.select("conv_id").distinct().withColumnRenamed("conv_id", "_id")
    zero = F.lit(0).cast("long")
    joined = every.join(found, every["_id"].eqNullSafe(found["conv_id"]), "left")
    return joined.select(
        F.col("_id").alias("conv_id"),
        *[F.coalesce(c, zero).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
