"""Conversation structure repair: turns aligned to the alternating role grammar by Wagner-Fischer tables.

A conversation's rows, in order of turn (nulls first; ties by role, then text digest), must become a sequence whose
role initials read `(s?(ua)+)?`. Edits: Keep costs 0, Rerole (to user or assistant) 2, Delete 3, Insert (an empty
text, user or assistant) 2; blank and duplicate rows must be deleted; a truncated row that stays adds 1. Of all
cheapest edit sequences the one with the ASCII-least string of edit initials (the audit) is applied.

The grammar's strings differ in their length only (and in the leading s), so one table serves every feasible length:
cell (i, k) is the cost of turning the rows from i on into the last k roles. A greedy repair gives the incumbent
cost; with `base` the cost no repair avoids, a path of that cost inserts and deletes at most (incumbent - base) / 2
further rows, which is the half width of the Ukkonen band around the diagonal. Lengths whose cost ties are
backtraced and their audits compared.

A conversation of more than `SEGMENT` rows is aligned segment by segment from its end: a segment's table is made
once for each role it may end on, and the best (cost, audit) for each role that may come next is carried to the
segment before. So time grows with the rows, and a conversation's needs in a task are some bytes a row, the size of
the audit that it must return; its texts are only streamed, in a second sorted pass that applies the audit.

Defined results: null conversation ids are one conversation; null roles and texts count as one space; a row whose
role has another initial can be reroled or deleted; equal rows may be in any order; a conversation without rows that
are alive has zeros, an empty audit and no turns; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logtide.llm.common import map_arrow, slices, written

REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
SEGMENT = 512
FAR = 1 << 28                        # cost of what cannot be
OTHER, SYSTEM, USER, ASSISTANT = 0, 1, 2, 3
# What a repaired prefix ends on: nothing yet, the system turn, a user turn, an assistant turn.
START, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT = 0, 1, 2, 3
NOT_BLANK = r"[^\x20\x09-\x0D]"


class Rows:
    """A run of rows to align: role codes, which must go, and what a row costs extra if it stays."""

    def __init__(self, codes: np.ndarray, must: np.ndarray, extra: np.ndarray):
        self.codes, self.must, self.extra = codes, must, extra

    def __len__(self) -> int:
        return len(self.codes)

    def part(self, a: int, b: int) -> Rows:
        return Rows(self.codes[a:b], self.must[a:b], self.extra[a:b])

    def base(self) -> int:
        """What every repair pays."""
        return int(DELETE * self.must.sum() + self.extra[~self.must].sum())


def greedy_cost(rows: Rows, expected: int) -> int:
    """Cost of a repair that keeps every row it can, inserting the role that is missing before it."""
    cost = rows.base()
    for code, must in zip(rows.codes.tolist(), rows.must.tolist()):
        if must:
            continue
        if code == expected:
            expected = USER + ASSISTANT - expected
        elif code in (USER, ASSISTANT):
            cost += INSERT                                   # the other role goes in before; the same is expected after
        else:
            cost += REROLE
            expected = USER + ASSISTANT - expected
    return cost


class Table:
    """Banded costs of turning the rows from i on into the k roles that end on `last` (see the module doc)."""

    def __init__(self, rows: Rows, last: int):
        self.rows, self.last = rows, last
        m = len(rows)
        # an ending on the other role, and two roles where none are needed, cost some inserts more
        incumbent = max(greedy_cost(rows, USER), greedy_cost(rows, ASSISTANT)) + 2 * INSERT
        self.half = (incumbent - rows.base()) // 2 + 1
        self.left = np.concatenate([np.cumsum(~rows.must[::-1])[::-1], [0]]).astype(np.int64)   # rows that may stay
        width = 2 * self.half + 1
        steps = np.arange(width, dtype=np.int32) * INSERT
        odd = np.arange(width) % 2 == 1
        cells = np.full((m + 1, width), FAR, np.int32)
        cells[m, self.half:] = steps[:width - self.half]
        for i in range(m - 1, -1, -1):
            below = cells[i + 1]
            if rows.must[i]:
                cells[i] = below + DELETE
                continue
            first = int(self.left[i]) - self.half              # k of the row's first cell
            ends_same = odd if first % 2 == 0 else ~odd           # k odd: the role k from the end is `last`
            code = int(rows.codes[i])
            change = np.full(width, REROLE + int(rows.extra[i]), np.int32)
            if code in (USER, ASSISTANT):
                change[ends_same if code == last else ~ends_same] -= REROLE
            here = below + change
            here[:-1] = np.minimum(here[:-1], below[1:] + DELETE)
            if first <= 0:
                here[:-first + 1] = FAR                           # no roles left: the rows can only be deleted
                here[-first] = below[-first + 1] + DELETE if -first + 1 < width else FAR
            cells[i] = np.minimum(np.minimum.accumulate(here - steps) + steps, FAR)
        self.cells = cells

    def cost(self, i: int, k: int) -> int:
        j = k - int(self.left[i]) + self.half
        return int(self.cells[i, j]) if k >= 0 and 0 <= j < self.cells.shape[1] else FAR

    def lengths(self, i: int, after: int) -> tuple[np.ndarray, np.ndarray]:
        """(k, cost) from row i on for every length that fits what comes before, k > 0 unless that is `last`."""
        ks = np.arange(self.cells.shape[1]) + int(self.left[i]) - self.half
        even = (after != AFTER_USER) == (self.last == ASSISTANT)    # the first role is u, but after u
        least = 0 if after == self.last else 1
        fits = (ks >= least) & (ks % 2 == (0 if even else 1)) & (self.cells[i] < FAR)
        return ks[fits], self.cells[i][fits]

    def audit(self, i: int, k: int) -> str:
        """The ASCII-least of the cheapest edits from cell (i, k) on."""
        rows, out = self.rows, []
        while i < len(rows) or k > 0:
            now = self.cost(i, k)
            if i < len(rows) and self.cost(i + 1, k) + DELETE == now:
                out.append("D")
                i += 1
            elif k > 0 and self.cost(i, k - 1) + INSERT == now:
                out.append("I")
                k -= 1
            else:
                same = rows.codes[i] == (self.last if k % 2 else USER + ASSISTANT - self.last)
                out.append("K" if same else "R")
                i, k = i + 1, k - 1
        return "".join(out)


def _before(rows: Rows, after: int, costs: dict[int, int], audits: dict[int, str], tables: dict[int, Table]) -> tuple[int, str]:
    """Best (cost, audit) from these rows to the end, given what comes before and the best from each state behind."""
    m = len(rows)
    found: list[tuple[int, object]] = []                          # (cost, how to make its audit)

    def ending(i: int, state: int, spent: int, head: str) -> None:
        for last, table in tables.items():
            ks, cells = table.lengths(i, state)
            for k in ks[cells == cells.min(initial=FAR)].tolist():
                found.append((spent + table.cost(i, k) + costs[last],
                              lambda t=table, k=k, q=last: head + t.audit(i, k) + audits[q]))

    ending(0, after, 0, "")
    if after in (START, AFTER_SYSTEM):                            # every row goes: what comes before stays as it is
        found.append((DELETE * m + costs[after], lambda: "D" * m + audits[after]))
    if after == START:                                            # or a system turn stays and leads
        for t in np.flatnonzero((rows.codes == SYSTEM) & ~rows.must).tolist():
            spent, head = DELETE * t + int(rows.extra[t]), "D" * t + "K"
            ending(t + 1, AFTER_SYSTEM, spent, head)
            rest = m - t - 1
            found.append((spent + DELETE * rest + costs[AFTER_SYSTEM],
                          lambda head=head, rest=rest: head + "D" * rest + audits[AFTER_SYSTEM]))
    least = min(c for c, _ in found)
    if least >= FAR:
        return FAR, ""
    return least, min(make() for c, make in found if c == least)


def align(rows: Rows, segment: int = SEGMENT) -> tuple[int, str]:
    """(cost, audit) of the cheapest repair, of several the ASCII-least audit."""
    costs = {START: 0, AFTER_SYSTEM: FAR, AFTER_USER: FAR, AFTER_ASSISTANT: 0}
    audits = {state: "" for state in costs}
    starts = list(range(0, len(rows), segment)) or [0]
    for a in reversed(starts):
        part = rows.part(a, min(a + segment, len(rows)))
        tables = {last: Table(part, last) for last in (AFTER_USER, AFTER_ASSISTANT) if costs[last] < FAR}
        best = {state: _before(part, state, costs, audits, tables) for state in ([START] if a == 0 else costs)}
        costs = {state: c for state, (c, _) in best.items()}
        audits = {state: w for state, (_, w) in best.items()}
    return costs[START], audits[START]


# ---- Spark: faults and audits from narrow rows, then one pass over the texts --------------------------------------

def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def turn_rows(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str,
              alive: Column | None = None) -> DataFrame:
    """(conv, turn, role, text, alive, d1, d2): nulls of role and text as one space, two 64-bit digests of the text."""
    picked = rows.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"),
                         _text(role_col).alias("role"), _text(text_col).alias("text"),
                         (alive if alive is not None else F.lit(True)).alias("alive"))
    return picked.withColumns({"d1": F.xxhash64("text"), "d2": F.xxhash64(F.lit("turn"), "text")})


def faults(turns: DataFrame) -> DataFrame:
    """(conv, turn, role, d1, d2, copy, alive, code, fault) of `turn_rows`, one exchange; copy numbers equal rows in
    their order, fault is each row's first one or null."""
    initial = F.substring("role", 1, 1)
    code = (F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT)
            .otherwise(OTHER).cast("byte"))
    stripped = F.rtrim("text", F.lit(" \t\n\x0b\x0c\r"))
    light = turns.select("conv", "turn", "role", "d1", "d2", "alive", code.alias("code"),
                         (~F.col("text").rlike(NOT_BLANK)).alias("blank"),
                         (~F.substring(stripped, -1, 1).isin(".", "!", "?")).alias("open"))
    same = Window.partitionBy("conv", "alive", "role", "d1", "d2").orderBy(F.asc_nulls_first("turn"))
    seen = light.repartition("conv").withColumn("copy", F.row_number().over(same))
    fault = F.when(F.col("blank"), "blank").when(F.col("copy") > 1, "duplicate").when(F.col("open"), "truncated")
    return seen.select("conv", "turn", "role", "d1", "d2", "copy", "alive", "code", fault.alias("fault"))


def _runs(column: pa.Array) -> Iterator[tuple[object, int, int]]:
    """(value, from, to) of the runs of equal values, null as None."""
    if len(column):
        ends = pc.run_end_encode(column)
        a = 0
        for value, b in zip(ends.values.to_pylist(), ends.run_ends.to_pylist()):
            yield value, a, b
            a = b


def _summary(turn: np.ndarray, known: np.ndarray, codes: np.ndarray, fault: np.ndarray, segment: int) -> dict:
    """The counts, cost and audit of one conversation's alive rows."""
    turns = turn[known]
    legal = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
    legal_codes = np.array([a * 4 + b for a, b in legal])
    cost, audit = align(Rows(codes, (fault == 1) | (fault == 2), (fault == 3).astype(np.int64)), segment)
    return {"gaps": int(turns.max() - turns.min() + 1 - len(np.unique(turns))) if len(turns) else 0,
            "blank": int((fault == 1).sum()), "duplicate": int((fault == 2).sum()), "truncated": int((fault == 3).sum()),
            "illegal": int((~np.isin(codes[:-1].astype(np.int64) * 4 + codes[1:], legal_codes)).sum()),
            "cost": cost, "audit": audit}


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
FAULT_CODES = {"blank": 1, "duplicate": 2, "truncated": 3}


def audits(turns: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit) of every conversation of `turn_rows`.

    A conversation's rows come sorted through one task, some bytes each, as its audit is one value of one row."""
    fault = F.coalesce(*[F.when(F.col("fault") == name, F.lit(c)) for name, c in FAULT_CODES.items()], F.lit(0))
    light = (faults(turns).sortWithinPartitions("conv", F.asc_nulls_first("turn"), "role", "d1", "d2", "copy")
             .select("conv", "turn", "alive", "code", fault.cast("byte").alias("fault")))

    def run(batches):
        now, held = None, []                                      # conversation, its alive rows so far
        done: list[dict] = []

        def close() -> None:
            t, k, c, f = (np.concatenate(x) for x in zip(*held))
            done.append({"conv": now} | _summary(t, k, c, f, segment))

        def made() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays(
                [pa.array([d["conv"] for d in done], conv_type), *[pa.array([d[c] for d in done], pa.int64()) for c in COUNTS],
                 pa.array([d["audit"] for d in done], pa.string())], names=["conv", *COUNTS, "audit"])
            done.clear()
            return batch

        conv_type = None
        for b in batches:
            conv_type = b.schema.field("conv").type
            alive = b.column("alive").to_numpy(zero_copy_only=False)
            turn = pc.fill_null(b.column("turn"), 0).to_numpy()
            known = pc.is_valid(b.column("turn")).to_numpy(zero_copy_only=False)
            codes, fault_codes = b.column("code").to_numpy(), b.column("fault").to_numpy()
            for conv, i, j in _runs(b.column("conv")):
                if held and conv != now:
                    close()
                    held = []
                now = conv
                on = alive[i:j]
                held.append((turn[i:j][on], known[i:j][on], codes[i:j][on], fault_codes[i:j][on]))
            if sum(len(d["audit"]) + 64 for d in done) > 1 << 20:
                yield made()
        if held:
            close()
        if done:
            yield made()

    conv_type_sql = turns.schema["conv"].dataType.simpleString()
    return map_arrow(light, run, f"conv {conv_type_sql}, " + ", ".join(f"`{c}` long" for c in COUNTS) + ", audit string")


def _edited(batches) -> Iterator[tuple[bool, pa.RecordBatch, int, object, str | None, str | None]]:
    """The repaired turns of sorted rows, each conversation's audit row first.

    Yields (True, batch, row, conv, None, None) where a conversation begins, then (False, None, 0, conv, role, text)
    for each of its turns."""
    def inserted(audit: str, at: int, role: str) -> tuple[int, str, list[str]]:
        out = []
        while at < len(audit) and audit[at] == "I":
            out.append(role)
            role = "assistant" if role == "user" else "user"
            at += 1
        return at, role, out

    conv, audit, at, role = None, "", 0, "user"
    for whole in batches:
        for b in slices(whole, "text"):
            texts, roles, kinds, audits_ = (b.column(c).to_pylist() for c in ("text", "role", "kind", "audit"))
            convs = b.column("conv").to_pylist()
            for i, kind in enumerate(kinds):
                if kind == 0:
                    conv, audit, at, role = convs[i], audits_[i], 0, "user"
                    yield True, b, i, conv, None, None
                    if not audit.strip("I"):                      # no rows follow
                        at, role, new = inserted(audit, at, role)
                        for r in new:
                            yield False, None, 0, conv, r, ""
                    continue
                at, role, new = inserted(audit, at, role)
                for r in new:
                    yield False, None, 0, conv, r, ""
                edit = audit[at]
                at += 1
                if edit == "R":
                    yield False, None, 0, conv, role, texts[i]
                elif edit == "K":
                    yield False, None, 0, conv, roles[i], texts[i]
                if edit == "R" or edit == "K" and not roles[i].startswith("s"):
                    role = "assistant" if role == "user" else "user"
                if at < len(audit) and not audit[at:at + 3].strip("I"):
                    end, after, new = inserted(audit, at, role)   # inserts at the very end
                    if end == len(audit):
                        at, role = end, after
                        for r in new:
                            yield False, None, 0, conv, r, ""


def _stream(turns: DataFrame, found: DataFrame) -> DataFrame:
    """Audit rows and alive rows with their texts, together and in order, each conversation in one partition."""
    heads = found.select("conv", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"),
                         F.lit("").alias("text"), F.lit(0).cast("long").alias("d1"), F.lit(0).cast("long").alias("d2"),
                         *COUNTS, "audit")
    rows = turns.where("alive").select("conv", F.lit(1).alias("kind"), "turn", "role", "text", "d1", "d2")
    return (heads.unionByName(rows, allowMissingColumns=True).repartition("conv")
            .sortWithinPartitions("conv", "kind", F.asc_nulls_first("turn"), "role", "d1", "d2"))


def _prepared(rows, conv_col, turn_col, role_col, text_col, alive, segment) -> tuple[DataFrame, DataFrame]:
    turns = turn_rows(rows, conv_col, turn_col, role_col, text_col, alive)
    return turns, written(rows.sparkSession, audits(turns, segment), "turn-audits")


def repaired_turns(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                   text_col: str = "text", alive: Column | None = None, segment: int = SEGMENT) -> DataFrame:
    """(conv, place, role, text): the turns of every repaired conversation, place from 0.

    Rows where `alive` is false only name their conversation."""
    turns, found = _prepared(rows, conv_col, turn_col, role_col, text_col, alive, segment)

    def run(batches):
        place, out, size = 0, [], 0
        for begins, b, i, conv, role, text in _edited(batches):
            if begins:
                place, conv_type = 0, b.schema.field("conv").type
                continue
            out.append((conv, place, role, text))
            place, size = place + 1, size + len(text) + 64
            if size > 1 << 20:
                yield _batch(out, conv_type)
                out, size = [], 0
        if out:
            yield _batch(out, conv_type)

    conv_type_sql = turns.schema["conv"].dataType.simpleString()
    return map_arrow(_stream(turns, found), run, f"conv {conv_type_sql}, place long, role string, text string")


def _batch(rows: list[tuple], conv_type: pa.DataType) -> pa.RecordBatch:
    conv, place, role, text = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(conv, conv_type), pa.array(place, pa.int64()), pa.array(role, pa.string()),
                                       pa.array(text, pa.string())], names=["conv", "place", "role", "text"])


def repair_report(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text", alive: Column | None = None, segment: int = SEGMENT) -> DataFrame:
    """(conv id, counts, cost, audit, repaired_sha256) of every conversation; the digest is taken while its turns,
    as `role:text` joined by newlines, stream by."""
    turns, found = _prepared(rows, conv_col, turn_col, role_col, text_col, alive, segment)

    def run(batches):
        heads, digests, size = [], [], 0

        def made() -> pa.RecordBatch:
            cut = pa.Table.from_batches(heads).combine_chunks().to_batches()[0]
            out = pa.RecordBatch.from_arrays(
                [cut.column("conv"), *[cut.column(c) for c in COUNTS], cut.column("audit"),
                 pa.array([d.hexdigest() for d in digests], pa.string())],
                names=[conv_col, *COUNTS, "audit", "repaired_sha256"])
            heads.clear(), digests.clear()
            return out

        first = True
        for begins, b, i, _, role, text in _edited(batches):
            if begins:
                if size > 1 << 20:
                    yield made()
                    size = 0
                heads.append(b.slice(i, 1))
                digests.append(hashlib.sha256())
                first, size = True, size + b.column("audit")[i].as_buffer().size + 256
                continue
            digests[-1].update(("" if first else "\n").encode() + f"{role}:{text}".encode())
            first = False
        if heads:
            yield made()

    conv_type_sql = turns.schema["conv"].dataType.simpleString()
    return map_arrow(_stream(turns, found), run, f"`{conv_col}` {conv_type_sql}, " + ", ".join(f"`{c}` long" for c in COUNTS)
                     + ", audit string, repaired_sha256 string")


# ---- the query's stand-in input ------------------------------------------------------------------------------------

def damaged(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text") -> DataFrame:
    """(conv, turn, role, text, alive): one row in twenty each is dropped (alive is false), emptied, stripped of
    `[.!?]`, repeated, or given to the user, by crc32 of `conv:turn`; nulls count as one space."""
    key = F.concat(_text(conv_col), F.lit(":"), _text(turn_col))
    fate = F.crc32(key.cast("binary")) % 20
    text = F.when(fate == 1, "").when(fate == 2, F.translate(_text(text_col), ".!?", "")).otherwise(_text(text_col))
    return rows.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
        F.when(fate == 4, "user").otherwise(_text(role_col)).alias("role"), text.alias("text"), (fate != 0).alias("alive"),
        F.explode(F.when(fate == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy")).drop("_copy")
