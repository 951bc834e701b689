"""Line deduplication, periodic runs and conversation repair against brute force, on odd and on ordinary rows."""

import hashlib
import os
import random
import re
import zlib
from functools import cache

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from airgrid.llm import conversation_repair, line_dedup, periodic_runs, queries
from airgrid.shipping import ship

SF = "/root/testdata/sf0.001"
tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
WS = " \t\n\x0b\f\r"
sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
crc = lambda s: zlib.crc32(s.encode())


def split_words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


# --- lines


def brute_lines(rows, min_chars=20, min_docs=3):
    fold = lambda line: re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(WS))
    holders = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            holders.setdefault(fold(line), set()).add(i)
    order = lambda i: (i is not None, i or 0)
    last = {k: max(v, key=order) for k, v in holders.items() if len(k) >= min_chars and len(v) >= min_docs}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if last.get(fold(x), i) == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


COMMON = "This line is in many of the documents"
LINES = [
    (1, f"{COMMON}\nown line of the first document"),
    (2, f"  {COMMON.upper()}\t\n\n{COMMON}\nshort"),
    (3, f"{COMMON}\n{COMMON}"),
    (3, f"x\n{COMMON}"),
    (3, f"x\n{COMMON}"),
    (4, "twice only, so it stays here\nshort"),
    (5, "twice only, so it stays here\nshort"),
    (6, None),
    (7, ""),
    (8, "short\nshort\nshort"),
    (9, "Ünser gemeinsamer Ärger über Zeilen\nÉ"),
    (10, "ünser gemeinsamer ärger über zeilen\n"),
    (11, "Ünser GEMEINSAMER Ärger über Zeilen"),
    (-(2**63), "Ünser gemeinsamer Ärger über Zeilen "),
    (None, f"{COMMON}\nnobody's own words are these"),
    (None, f"{COMMON}\nnobody's own words are these"),
    (12, "nineteen characters\r\nnineteen characterss\v"),
    (13, "nineteen characters\nnineteen characterss"),
    (14, "nineteen characters\n\fnineteen characterss"),
    (15, "Ünser gemeinsamer Ärger über Zeilen"),
]


@pytest.mark.parametrize("max_broadcast", [0, 1000])
def test_lines(spark, max_broadcast):
    docs = spark.createDataFrame([(i, t, "x", k) for k, (i, t) in enumerate(LINES)], "doc_id long, text string, line string, t int")
    got = line_dedup.drop_lines(docs, columns=("doc_id", "line", "t"), max_broadcast=max_broadcast)
    assert got.columns == ["doc_id", "line", "t", "n_lines", "n_dropped", "kept_text"]
    assert sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept_text"]) for r in got.collect()), key=str) == brute_lines(LINES)
    assert line_dedup.drop_lines(docs.limit(0)).count() == 0


def test_lines_of_a_hot_line_and_a_long_text(spark):
    rows = [(i, f"{COMMON}\nline of document {i} alone, at length") for i in range(3000)] + [(5000, "\n".join([COMMON, "between the copies"] * 20000)), (4999, "\n".join([COMMON] * 30000))]
    got = line_dedup.drop_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept_text"]) for r in got.collect()), key=str) == brute_lines(rows)


def test_lines_use_no_python(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = line_dedup.drop_lines(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# --- runs


def smallest_period(w):
    return next(p for p in range(1, len(w) + 1) if w[p:] == w[: len(w) - p])


def brute_runs(w, min_length=12):
    out = []
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i < len(w) - q:
            j = i
            while j < len(w) - q and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(min_length, 2 * q) and smallest_period(w[i : j + q]) == q:
                out.append((i, j - i + q, q))
            i = max(j, i) + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


@st.composite
def sequences(draw):
    out = []
    for _ in range(draw(st.integers(1, 4))):
        unit = draw(st.lists(st.integers(0, draw(st.integers(0, 6))), min_size=1, max_size=10))
        out += unit * draw(st.integers(1, 5)) + unit[: draw(st.integers(0, 10))]
        out += [100 + draw(st.integers(0, 30)) for _ in range(draw(st.integers(0, 4)))]
    return out


@settings(max_examples=120, deadline=None)
@given(sequences(), st.sampled_from([4, 12]))
def test_runs(w, min_length):
    assert periodic_runs.runs_of(np.array(w), min_length) == brute_runs(w, min_length)


@pytest.mark.parametrize("seed", range(6))
def test_long_runs(seed):
    r = random.Random(seed)
    w = []
    while len(w) < 900:
        unit = [r.randrange(r.choice([2, 5, 400])) for _ in range(r.choice([1, 3, 8, 15, 16, 17, 64, 100, 150]))]
        w += (unit * 8)[: r.randrange(len(unit), 6 * len(unit) + 1)] + [r.randrange(3)] * r.randrange(3)
    assert periodic_runs.runs_of(np.array(w)) == brute_runs(w)


def test_runs_of_self_similar_and_uniform_sequences():
    a, b = [0], [0, 1]
    while len(b) < 600:
        a, b = b, b + a
    assert periodic_runs.runs_of(np.array(b)) == brute_runs(b)
    assert periodic_runs.runs_of(np.zeros(200_000, dtype=np.int64)) == [(0, 200_000, 1)]
    unit = np.random.default_rng(1).integers(0, 50, 30_000)
    assert periodic_runs.runs_of(np.concatenate([unit] * 7)[:200_000]) == [(0, 200_000, 30_000)]


def test_splitting_goes_on_until_nothing_changes():
    w = np.array([1, 2, 3, 4] * 4 + [9] + [5, 1, 6, 2, 7, 3, 8, 4, 5])
    assert [x.tolist() for x in periodic_runs.surviving(w)] == [[0], [16]]


def brute_run_row(doc_id, text):
    w = split_words(text)
    n = len(w)
    h = crc(str(doc_id)) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    first = (*top, 1000 * top[1] // top[2]) if top else (None,) * 4
    return (doc_id, len(runs), *first, sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


@tables
def test_run_query_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = {tuple(r) for r in queries.op12_periodic_runs(spark, SF).collect()}
    assert got == {brute_run_row(r["doc_id"], r["text"]) for r in docs}
    assert sum(r[1] > 0 for r in got) >= 10


def test_query_of_a_text_with_very_many_runs(spark, tmp_path):
    """Twenty thousand runs in one text, many of one length: the first of the longest is given."""
    doc_id = next(i for i in range(100) if crc(str(i)) % 10)
    text = " ".join(f"a{k} " * (12 + (k in (7, 9))) + f"sep{k}" for k in range(20_000))
    spark.createDataFrame([(doc_id, text)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    r = queries.op12_periodic_runs(spark, str(tmp_path)).collect()[0]
    assert tuple(r)[:6] == (doc_id, 20_000, 7 * 13, 13, 1, 13_000)
    assert r["runs_sha256"] == sha("".join(f"{13 * k + (k > 7) + (k > 9)},{12 + (k in (7, 9))},1\n" for k in range(20_000)))
    assert r["collapsed_sha256"] == sha(" ".join(f"a{k} sep{k}" for k in range(20_000)))


def test_runs_odd_rows(spark, tmp_path):
    damaged = [i for i in range(200) if crc(str(i)) % 10 == 0]
    rows = [(1, None, "a"), (2, "", "b"), (3, " \t\n", None), (4, "na " * 12, "c"), (4, "na na " * 12, "d"), (4, "na " * 12, "c"), (None, "x y z\v" * 5, "e"), (5, "ha" * 50_000, "f"), (6, "a b " * 300, "g")]
    rows += [(i, " ".join(f"w{k}" for k in range(10 + i)), "h") for i in damaged] + [(damaged[0], None, "i"), (damaged[1], "word", "j")]
    docs = spark.createDataFrame([(i, t, x, x) for i, t, x in rows], "doc_id long, text string, runs string, collapsed_text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in queries.op12_periodic_runs(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted((brute_run_row(i, t) for i, t, _ in rows), key=str)
    ship(spark)
    both = periodic_runs.detect(docs, columns=("doc_id", "runs"))
    assert both.count() == len(rows) and periodic_runs.detect(docs.limit(0)).count() == 0


# --- conversations


def brute_repair(rows):
    """(cost, audit, repaired rows) of rows (role, text, must_delete, truncated), from the end, with all edits spelt out."""
    n = len(rows)
    accept = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}

    @cache
    def best(i, state, inserts):
        ways = []
        if i == n and state in ("", "a"):
            ways.append((0, "", ()))
        if inserts < 3:
            for role in ("user", "assistant"):
                if role[0] in accept[state]:
                    c, a, r = best(i, role[0], inserts + 1)
                    ways.append((c + 2, "I" + a, ((role, ""), *r)))
        if i < n:
            role, text, must, late = rows[i]
            c, a, r = best(i + 1, state, 0)
            ways.append((c + 3, "D" + a, r))
            if not must:
                if role[:1] in accept[state]:
                    c, a, r = best(i + 1, role[:1], 0)
                    ways.append((c + late, "K" + a, ((role, text), *r)))
                for new in ("user", "assistant"):
                    if new[0] in accept[state]:
                        c, a, r = best(i + 1, new[0], 0)
                        ways.append((c + 2 + late, "R" + a, ((new, text), *r)))
        return min(ways) if ways else (10**9, "", ())

    return best(0, "", 0)


def brute_conversation(key, rows):
    """rows (turn, role, text) as they are after damage."""
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, marked, counts = set(), [], [0, 0, 0]
    for _, r, x in rows:
        body = x.strip(WS)
        fault = 0 if not body else 1 if (r, x) in seen else 2 if body[-1] not in ".!?" else None
        seen.add((r, x))
        if fault is not None:
            counts[fault] += 1
        marked.append((r, x, fault in (0, 1), fault == 2))
    turns = {t for t, _, _ in rows if t is not None}
    gaps = min(max(turns) - min(turns) + 1 - len(turns), 2**63 - 1) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    cost, audit, repaired = brute_repair(tuple(marked))
    return (key, gaps, *counts, illegal, cost, audit, sha("\n".join(f"{r}:{x}" for r, x in repaired))), [(key, i, *r) for i, r in enumerate(repaired)]


ROLES = ["system", "user", "assistant", "tool", "", "u", "sys", None]
TEXTS = ["One.", "Two!", "cut off", "", " \n", None, "three?", "é.", "Four."]


def odd_conversations(n=300):
    r = random.Random(5)
    rows = []
    for c in range(n):
        some = ROLES[: r.choice([3, 3, 8])]
        for t in range(r.randrange(1, 11)):
            turn = r.choice([t, t, t, t, t + 7, None, -(2**63), 2**62])
            rows.append((None if c == 0 else c, turn, r.choice(some), r.choice(TEXTS[: r.choice([2, 9])]) if r.random() < 0.7 else f"Own {c} {t}."))
    return rows


@pytest.mark.parametrize("batch", [3, 10000])
def test_repair_by_brute_force(spark, batch):
    """Batches of three rows and a spill after two, so that conversations run over both."""
    ship(spark)
    rows = odd_conversations()
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, fault string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = conversation_repair.repair(df, spill=8)
        found = sorted((tuple(r) for r in got.collect()), key=str)
        fixed = conversation_repair.repaired(df, got).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = [brute_conversation(k, [r[1:] for r in rows if r[0] == k]) for k in {r[0] for r in rows}]
    assert found == sorted((w for w, _ in want), key=str)
    assert sorted(((r["conv_id"], r["position"], r["role"], r["text"]) for r in fixed), key=str) == sorted((x for _, own in want for x in own), key=str)


def test_repair_of_a_giant_conversation_holds_no_rows(spark):
    """100,000 turns of one conversation through one stream, spilled many times."""
    ship(spark)
    n = 100_000
    df = spark.range(n).select(F.lit("c").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.lit("Turn "), "id", F.lit(".")).alias("text"))
    want = hashlib.sha256("\n".join(f"{'ua'[i % 2] == 'u' and 'user' or 'assistant'}:Turn {i}." for i in range(n)).encode()).hexdigest()
    r = conversation_repair.repair(df, spill=1000).collect()
    assert len(r) == 1 and r[0]["audit"] == "K" * n and r[0]["cost"] == 0 and r[0]["repaired_sha256"] == want


def test_repair_of_nothing(spark):
    ship(spark)
    df = spark.createDataFrame([(1, 1, "user", "Hi.")], "conv_id long, turn long, role string, text string")
    assert [tuple(r) for r in conversation_repair.repair(df, present=F.lit(False)).collect()] == [(1, 0, 0, 0, 0, 0, 0, "", sha(""))]
    assert conversation_repair.repair(df.limit(0)).count() == 0 and conversation_repair.repaired(df.limit(0), conversation_repair.repair(df.limit(0))).count() == 0


def brute_damage(rows):
    out = {}
    for c, t, r, x in rows:
        own = out.setdefault(c, [])
        r, x = " " if r is None else r, " " if x is None else x
        d = crc(f"{' ' if c is None else c}:{' ' if t is None else t}") % 20
        if d != 0:
            x = "" if d == 1 else re.sub("[.!?]", "", x) if d == 2 else x
            own += [(t, "user" if d == 4 else r, x)] * (2 if d == 3 else 1)
    return sorted((brute_conversation(k, own)[0] for k, own in out.items()), key=str)


@tables
def test_repair_query_by_brute_force(spark, tmp_path):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted((tuple(r) for r in queries.op11_conversation_repair(spark, SF).collect()), key=str) == brute_damage(rows)
    odd = odd_conversations(100)
    spark.createDataFrame(odd, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    assert sorted((tuple(r) for r in queries.op11_conversation_repair(spark, str(tmp_path)).collect()), key=str) == brute_damage(odd)


def test_states_are_few():
    """Costs relative to the least stay small, so the steps that are remembered are few."""
    conversation_repair.step.cache_clear()
    r = random.Random(1)
    c = conversation_repair.Conversation("k", 1 << 20)
    for i in range(20_000):
        c.row(i, r.choice(["system", "user", "assistant", "x"]), "t", r.choice(conversation_repair.FAULTS))
    assert conversation_repair.step.cache_info().currsize < 3000
