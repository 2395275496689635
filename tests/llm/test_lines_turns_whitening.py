"""Line dedup, conversation repair and whitening against brute force and SQL."""

import hashlib
import random
import zlib
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pytest
from pyspark.sql import functions as F

from logtide.llm import line_dedup, queries, turn_repair, whitening
from logtide.llm.turn_repair import Rows, align
from tests.llm.helpers import DOC_SCHEMA, LOWER

SF = "/root/testdata/sf0.001"
BLANKS = " \t\n\x0b\x0c\r"


# ---- lines ---------------------------------------------------------------------------------------------------------

def _deduped(rows, least_chars=20, least_docs=3):
    """(id, n_lines, n_dropped, text) by brute force; None sorts below every id."""
    def order(i):
        return (i is not None, i if i is not None else 0)

    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            key = line.strip(BLANKS).translate(LOWER)
            if len(key) >= least_chars:
                holders[key].add(i)
    out = []
    for i, text in rows:
        lines, kept = (text or "").split("\n"), []
        for line in lines:
            ids = holders.get(line.strip(BLANKS).translate(LOWER), ())
            if len(ids) < least_docs or order(i) == max(map(order, ids)):
                kept.append(line)
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def _line_rows():
    long, other = "this line is long enough to count", "Ünïcode lines count by code point"
    texts = [None, "", "\n", "\n\n\n", long, f" {long.upper()}\t\n\x0b{long}\r\n{long}", f"a\n{long}\nb\n{other}\n",
             f"{other}\n{other}\n\n{other}", f"{other.replace('Ü', 'ü')}", "short\n" * 5, "short", "short\nshort",
             "x" * 19, "x" * 19 + "\n", "x" * 19, "é" * 20, "é" * 20 + "\nz", "\x0cé" + "é" * 19, f"{long}\x85"]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(5, f"{long}\n{other}"), (6, texts[6]), (6, texts[6]), (None, long), (None, f"{long}\n{other}"), (-3, other)]
    rng = random.Random(3)
    pool = [f"common line number {k:04d} of the pool" for k in range(30)] + ["tiny"] * 5
    return rows + [(100 + k, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 40)))) for k in range(60)]


def _frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", None) for i, t in rows], DOC_SCHEMA)


@pytest.mark.parametrize("parts", [1, 7])
def test_lines_match_brute_force(spark, parts):
    rows = _line_rows()
    docs = _frame(spark, rows).repartition(parts).withColumns({c: F.lit(0) for c in ("h", "doc", "split", "dropped", "text_hash")})
    got = [tuple(r) for r in line_dedup.dedup_lines(docs).collect()]
    assert sorted(got, key=str) == sorted(_deduped(rows), key=str)


def test_bitmaps_are_runs_of_dropped_lines(spark):
    line = "a line that everybody seems to repeat"
    rows = [(1, f"{line}\n{line}\nown\n{line}"), (2, f"own\n{line}"), (3, f"{line}\nown"), (4, "own")]
    maps = {r.doc: ([(x["first"], x["count"]) for x in r.dropped], r.n_dropped)
            for r in line_dedup.keep_bitmaps(_frame(spark, rows)).collect()}
    assert maps == {1: ([(0, 2), (3, 1)], 3), 2: ([(1, 1)], 1)}


def test_a_hot_line_and_a_repeated_row_stay_spread(spark):
    """A third of the rows one repeated row with a common line, a third null ids: counted right, and a split gives
    the second step only its first documents' lines."""
    line = "the very same boilerplate line again"
    rows = [(7, f"{line}\nseven")] * 300 + [(None, line)] * 300 + [(1000 + k, f"{line}\n{k}") for k in range(300)]
    docs = _frame(spark, rows).repartition(10)
    got = line_dedup.dedup_lines(docs).groupBy("doc_id").agg(F.sum("n_dropped").alias("n")).collect()
    want = {i: 1 for i in range(1000, 1299)} | {1299: 0, 7: 300, None: 300}
    assert {r.doc_id: r.n for r in got} == want
    lines = line_dedup.keyed_lines(docs)
    firsts = line_dedup.first_occurrences(lines)
    assert firsts.count() <= 3 * lines.select("split").distinct().count()


def test_long_text_and_empty_table_of_lines(spark):
    big = "\n".join(f"line {k % 5000} of a very long text indeed" for k in range(400_000))           # 15 MB
    rows = [(1, big), (2, "line 17 of a very long text indeed"), (3, "line 17 of a very long text indeed\nend")]
    got = {r.doc_id: (r.n_lines, r.n_dropped, hashlib.md5(r.text.encode()).hexdigest())
           for r in line_dedup.dedup_lines(_frame(spark, rows)).collect()}
    assert got == {i: (n, d, hashlib.md5(t.encode()).hexdigest()) for i, n, d, t in _deduped(rows)}
    empty = line_dedup.dedup_lines(_frame(spark, rows).limit(0))
    assert empty.columns == ["doc_id", "n_lines", "n_dropped", "text"] and empty.count() == 0


# ---- turns ---------------------------------------------------------------------------------------------------------

def _cheapest(codes, must, extra):
    """(cost, audit) by exhaustive recursion over the grammar's states."""
    after = {0: 2, 1: 2, 2: 3, 3: 2}

    @lru_cache(None)
    def best(i, state, inserts):
        found = [(0, "")] if i == len(codes) and state in (0, 3) else []
        if i < len(codes):
            moves = [(3, "D", state)]
            if not must[i]:
                if codes[i] == after[state]:
                    moves.append((extra[i], "K", after[state]))
                if state == 0 and codes[i] == 1:
                    moves.append((extra[i], "K", 1))
                moves.append((2 + extra[i], "R", after[state]))
            for cost, edit, then in moves:
                c, a = best(i + 1, then, 0)
                found.append((cost + c, edit + a))
        if inserts < 4:
            c, a = best(i, after[state], inserts + 1)
            found.append((2 + c, "I" + a))
        return min(found, default=(10 ** 6, ""))

    return best(0, 0, 0)


@pytest.mark.parametrize("segment", [512, 3, 1])
def test_alignment_is_the_cheapest_and_least(segment):
    rng = random.Random(segment)
    for n in range(1500):
        size = rng.randrange(9) if n % 8 else rng.randrange(10, 40)
        codes = rng.choices(range(4), rng.choice([(1, 1, 1, 1), (0, 1, 4, 4), (1, 8, 1, 1), (3, 0, 1, 1)]), k=size)
        must = [rng.random() < rng.choice([0.1, 0.5]) for _ in codes]
        extra = [int(not m and rng.random() < 0.3) for m in must]
        rows = Rows(np.array(codes, np.int8), np.array(must, bool), np.array(extra, np.int64))
        assert align(rows, segment) == _cheapest(tuple(codes), tuple(must), tuple(extra)), (codes, must, extra)


CONVERSATIONS = "conv_id long, turn long, role string, text string"


def _repaired(rows):
    """Per conversation (counts, cost, audit, turns) by brute force, rows as (conv, turn, role, text)."""
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        groups[conv].append((turn, " " if role is None else role, " " if text is None else text))
    out = {}
    for conv, g in groups.items():
        g.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, faults = set(), []
        for _, role, text in g:
            faults.append("blank" if not text.strip(BLANKS) else "duplicate" if (role, text) in seen
                          else "truncated" if text.rstrip(BLANKS)[-1] not in ".!?" else None)
            seen.add((role, text))
        turns = [t for t, _, _ in g if t is not None]
        initials = [r[:1] for _, r, _ in g]
        codes = tuple({"s": 1, "u": 2, "a": 3}.get(c, 0) for c in initials)
        cost, audit = _cheapest(codes, tuple(f in ("blank", "duplicate") for f in faults),
                                tuple(int(f == "truncated") for f in faults))
        made, i, state = [], 0, "user"
        for edit in audit:
            role, text = ("", "") if edit == "I" else g[i][1:]
            i += edit != "I"
            if edit == "D":
                continue
            made.append((role if edit == "K" else state, text))
            if edit != "K" or role[:1] != "s":
                state = "assistant" if state == "user" else "user"
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
                     *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
                     sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit, made)
    return out


def _conversations(n=150, seed=4):
    rng = random.Random(seed)
    texts = ["", " \t", "Fine.", "Fine.", "really?", "cut off", "ok! \n", "mid. sentence", "Ünd?", None, "x" * 3000 + "."]
    rows = []
    for conv in range(n):
        for turn in range(rng.randrange(1, 12)):
            rows.append((conv if conv else None, rng.choice([turn, turn, turn, turn + 2, None]),
                         rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]),
                         rng.choice(texts) if rng.random() < 0.5 else f"text {rng.random()}."))
    return rows


@pytest.mark.parametrize("segment", [512, 2])
def test_repaired_conversations_match_brute_force(spark, segment):
    rows = _conversations()
    frame = (spark.createDataFrame(rows, CONVERSATIONS).withColumns({"kind": F.lit("x"), "audit": F.lit("y"), "d1": F.lit(1)})
             .repartition(5))
    want = _repaired(rows)
    ties = {(c, t) for c, t, *_ in rows if sum((c, t) == r[:2] for r in rows) > 1}
    safe = {c for c in want if not any(t[0] == c for t in ties)}       # ties of a turn may be in any order
    assert len(safe) > 20
    report = {r.conv_id: r for r in turn_repair.repair_report(frame, segment=segment).collect()}
    assert set(report) == set(want)
    turns = defaultdict(list)
    for r in turn_repair.repaired_turns(frame, segment=segment).orderBy("conv", "place").collect():
        assert r.place == len(turns[r.conv])
        turns[r.conv].append((r.role, r.text))
    for conv in safe:
        got = report[conv]
        *counts, made = want[conv]
        assert [got[c] for c in (*turn_repair.COUNTS, "audit")] == counts
        assert turns[conv] == made
    for conv, r in report.items():
        assert r.repaired_sha256 == hashlib.sha256("\n".join(f"{a}:{b}" for a, b in turns[conv]).encode()).hexdigest()
        initials = "".join(role[:1] for role, _ in turns[conv])
        assert initials in ("", "s" * initials.startswith("s") + "ua" * (len(initials) // 2))


def test_damage_of_conversations(spark):
    rows = [(c, t, "assistant", f"One. Two! {c}?") for c in range(60) for t in range(4)] + [(None, None, None, None)]
    got = defaultdict(list)
    for r in turn_repair.damaged(spark.createDataFrame(rows, CONVERSATIONS)).collect():
        got[r.conv_id, r.turn].append((r.role, r.text, r.alive))
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fate, role, text = zlib.crc32(key.encode()) % 20, role or " ", text or " "
        row = ("user" if fate == 4 else role, {1: "", 2: text.translate(str.maketrans("", "", ".!?"))}.get(fate, text), fate != 0)
        assert got[conv, turn] == [row] * (2 if fate == 3 else 1)


def test_dropped_and_long_conversations(spark):
    """Conversations without rows keep their id; one conversation may hold most rows and a very long text."""
    rows = [(1, k, "user" if k % 2 == 0 else "assistant", f"turn {k}.") for k in range(3000) if k % 50 != 7]
    rows += [(2, 0, "user", "z" * 20_000_000 + "."), (2, 1, "assistant", "short."), (3, 0, "user", "gone.")]
    frame = spark.createDataFrame(rows, CONVERSATIONS)
    got = {r.conv_id: r for r in turn_repair.repair_report(frame, alive=F.col("conv_id") != 3).collect()}
    assert got[3][1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got[2].audit == "KK" and got[2].cost == 0
    assert got[2].repaired_sha256 == hashlib.sha256(f"user:{rows[-3][3]}\nassistant:short.".encode()).hexdigest()
    assert got[1].gaps == 60 and got[1].cost == 2 * 60 and got[1].audit.count("I") == 60
    empty = turn_repair.repair_report(frame.limit(0))
    assert empty.columns[0] == "conv_id" and empty.count() == 0 and turn_repair.repaired_turns(frame.limit(0)).count() == 0


# ---- whitening -----------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("values", [
    np.linspace(1, 2, 40), np.r_[1 + 1e-9 * np.arange(10), np.linspace(0, 0.5, 30)], np.r_[np.ones(8), np.zeros(20)],
    np.r_[1 + 1e-13 * np.arange(12), 1e-6 * np.arange(20)], np.ones(5), np.zeros(3), np.array([4.0])])
def test_eigenvectors_in_double_precision(values):
    rng = np.random.default_rng(len(values))
    q = np.linalg.qr(rng.normal(size=(len(values), len(values))))[0].astype(np.longdouble)
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    found, x = whitening.eigenvectors(a)
    assert np.all(np.diff(found) <= 0)
    assert np.abs(x.T @ x - np.eye(len(values))).max() < 2e-15
    assert np.abs(a @ x - x * found).max() < 1e-15 * max(1, np.abs(values).max())


def _vectors(seed=0, n=400, dim=12):
    rng = np.random.default_rng(seed)
    m = (rng.normal(size=(n, dim)) * np.linspace(1, 3, dim)).astype(np.float32)
    return [(i, v.tolist(), 0) for i, v in enumerate(m)]


VECTORS = "vec_id long, embedding array<float>, label int"


def _whitened(rows, components=4):
    x = np.array([np.floor(256 * np.array(v, np.float64)) for _, v, _ in rows]).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    centred = fit - s / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:components]
    made = (x - s / n) @ axes[:, order] / np.sqrt(values[order])
    return n, ((n * x - s) ** 2).sum(1), made, values[order] / values.sum()


def test_whitening_matches_numpy(spark):
    base = _vectors()
    usable = base + [(7, base[3][1], 0), (None, base[5][1], 1), (9, [0.0] * 12, 0), (10, [-0.0] * 12, 0)]
    bad = [(500, None, 0), (501, [], 0), (502, [None] + [1.0] * 11, 0), (503, [float("nan")] * 12, 0),
           (504, [float("inf")] + [0.0] * 11, 0), (505, [3e38] * 12, 0)]
    frame = spark.createDataFrame(usable + bad, VECTORS).withColumns({"x": F.lit(1), "dim": F.lit(2)}).repartition(5)
    got = defaultdict(list)
    for r in whitening.whiten(frame).collect():
        got[r.vec_id].append(r)
    n, deviation, made, explained = _whitened(usable)
    assert set(got) == {i for i, _, _ in usable}
    signs = None
    for (i, _, _), d, w in zip(usable, deviation.tolist(), made):
        rows = sorted((r for r in got[i] if r.deviation == d), key=lambda r: r.component)
        assert {r.component for r in rows} == {1, 2, 3, 4} and all(r.n == n for r in rows)
        values = np.array([r.whitened for r in rows[::len(rows) // 4]])
        signs = np.sign(values * w) if signs is None else signs
        np.testing.assert_allclose(values, signs * w, rtol=1e-9, atol=1e-11)
        np.testing.assert_allclose([r.explained for r in rows[::len(rows) // 4]], explained, rtol=1e-12)
        assert all(r.identity_error < 1e-12 for r in rows)
    assert sum(map(len, got.values())) == 4 * len(usable)


def test_whitening_of_degenerate_tables(spark):
    frame = spark.createDataFrame([(1, [0.5, 0.25], 0), (2, [0.5, 0.25], 0), (3, [1.0], 0), (4, [3.0], 0),
                                   (5, [2.0 ** 40, 0.0, 0.0], 0), (6, [0.0, 2.0 ** 40, 0.0], 0)], "vec_id long, embedding array<double>, label int")
    got = {(r.vec_id, r.component): r for r in whitening.whiten(frame).collect()}
    assert set(got) == {(1, 1), (1, 2), (2, 1), (2, 2), (3, 1), (4, 1)} | {(i, k) for i in (5, 6) for k in (1, 2, 3)}
    assert all(got[i, k][3:] == (0, None, None, None) for i in (1, 2) for k in (1, 2))
    assert got[3, 1].whitened == -1.0 and got[4, 1].whitened == 1.0 and got[3, 1].deviation == 512 ** 2
    assert got[3, 1].explained == 1.0 and got[3, 1].identity_error == 0.0
    assert got[5, 1].deviation is None and abs(got[5, 1].whitened) == 1.0                  # 2^97 is no long
    assert got[5, 1].explained == 1.0 and got[5, 2].whitened is None and got[5, 3].whitened is None
    assert whitening.whiten(frame.limit(0)).count() == 0


def test_whitening_query_on_the_table(spark):
    rows = queries.op11_whitening(spark, SF).collect()
    source = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    n, deviation, made, explained = _whitened([(r.vec_id, r.embedding, 0) for r in source])
    by_id = defaultdict(dict)
    for r in rows:
        by_id[r.vec_id][r.component] = r
    w = np.array([[by_id[r.vec_id][k].whitened for k in (1, 2, 3, 4)] for r in source])
    np.testing.assert_allclose(w * np.sign(w[0] * made[0]), made, rtol=1e-8, atol=1e-10)
    assert [by_id[r.vec_id][1].deviation for r in source] == deviation.tolist() and {r.n for r in rows} == {n}
