"""Expressions on texts and times are evaluated once for a row, and right on what larger tables hold."""

import random
import re

import pytest
from pyspark.sql import functions as F

from airgrid import plans
from airgrid.functions import text, times
from airgrid.operators import layout


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_roundtrip_of_ids_like_recorder_codes(spark, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    ids = [0, 7, 99_999, 100_000, 123_456, 999_999_999, 1_000_000_000, 12_345_678_901, -123_456]
    rows = [(n, i % 3, f"2024-01-0{1 + i % 2} 0{i}:15:00") for i, n in enumerate(ids)]
    df = spark.createDataFrame(rows, "event_id long, user_id long, at string").select("event_id", "user_id", F.to_timestamp("at").alias("ts"), F.lit("view").alias("event_type"))
    df.write.parquet(f"{tmp_path}/events.parquet")
    got = plans.QUERIES["entries_roundtrip"](spark, str(tmp_path))
    db = duckdb.connect()
    db.sql(f"create view events as select event_id, user_id, ts::timestamp as ts, event_type from '{tmp_path}/events.parquet/*.parquet'")
    want = db.sql(plans.SQL["entries_roundtrip"]).select(*got.columns).fetchall()
    assert sorted([str(v) for v in r] for r in got.collect()) == sorted([str(v) for v in r] for r in want)
    assert len(want) == len(ids) and "suite fin" in {r["subtitle"] for r in got.collect()}


def test_tail_cut_of_plain_and_blank_anchors(spark):
    """Against the pattern; places count in characters, of which some are two of Java's."""
    rng = random.Random(3)
    pieces = ["a", "(a+", "10%", "\\E", " ", " ", " ", "\t", ".", ",", "a b", "x y", "😀", "é"]
    rows = [("".join(rng.choices(pieces, k=rng.randrange(12))), ["".join(rng.choices(pieces, k=rng.randrange(1, 3))) for _ in range(rng.randrange(4))]) for _ in range(600)]
    rows = [(t, [x for x in a if "😀" not in x or not re.search("[  \t]", x)]) for t, a in rows if not ("😀" in t and any(re.search("[  \t]", x) for x in a))]
    blank = "[" + re.escape(text.BLANKS) + "]"

    def cut(t, anchors):
        at = [m.start() for a in anchors if a and (m := re.search(rf"(?:(?<={blank})|(?<![\s\S])){re.escape(a)}(?={blank}|\Z|[.,;:!?])", t))]
        return (t[: min(at)].strip(text.BLANKS), t[min(at) :].strip(text.BLANKS)) if at else (t, "")

    got = spark.createDataFrame(rows, "t string, a array<string>").select("t", "a", text.cut_garbled_tail(F.col("t"), F.col("a")).alias("c")).collect()
    assert len(got) > 200 and any(r["c"]["tail"] for r in got)
    assert [(r["t"], r["a"], tuple(r["c"])) for r in got] == [(r["t"], r["a"], cut(r["t"], r["a"])) for r in got]


def test_weekday_is_read_once_and_parts_lose_no_day(spark):
    for day, parts in text.DAY_PARTS.items():
        assert "".join(parts) == day and len(parts) == (2 if len(day) <= 5 else 3)
    rng = random.Random(5)
    letters = "adeijlmnrsuvzé "

    def misread(day):
        s = list(day)
        for _ in range(rng.randrange(4)):
            i = rng.randrange(len(s))
            s[i : i + 1] = rng.choice([[], [rng.choice(letters)], [s[i], rng.choice(letters)]])
        return "".join(s) or "z"

    given = [rng.choice(["", "12 ", "le"]) + misread(rng.choice(text.WEEKDAYS)) + rng.choice([" 1999", "x", ""]) for _ in range(400)]

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            out = [i]
            for j, y in enumerate(b, 1):
                out.append(min(row[j] + 1, out[-1] + 1, row[j - 1] + (x != y)))
            row = out
        return row[-1]

    def want(t):
        t = t.lower()
        words = [w for w in re.split(r"[\W\d_]+", t) if len(w) >= 4]
        own = re.sub(r"[\W\d_]+", "", t)
        found = []
        for d in text.WEEKDAYS:
            most = 1 if len(d) <= 5 else 2
            subs = [own[i : i + n] for n in (len(d) - 1, len(d), len(d) + 1) for i in range(len(own) - n + 1)]
            if any(abs(len(w) - len(d)) <= most and distance(w, d) <= most for w in [*words, *subs]):
                found.append(d)
        return found[0] if len(found) == 1 else None

    df = spark.createDataFrame([(t,) for t in given], "t string")
    got = df.select("t", text.match_weekday(F.col("t")).alias("d"))
    assert [(r["t"], r["d"]) for r in got.collect()] == [(t, want(t)) for t in given]
    assert plan(got).count("regexp_replace(") == 1


def test_times_are_parsed_once(spark):
    df = spark.createDataFrame([("3:5:x",), ("99999999999:1",), (None,), ("-5:7:09",)], "t string")
    got = df.select(times.normalize_time(F.col("t")).alias("t"))
    assert [r["t"] for r in got.collect()] == [None, None, "00:00:00", "-5:07:09"]
    assert plan(got).count("regexp_extract(") == 1


def test_bounds_of_many_pages(spark):
    rng = random.Random(7)
    spans = {p: [rng.randrange(4) or None for _ in range(rng.randrange(1, 14))] for p in range(60)}
    blocks = spark.createDataFrame([(p, i, s) for p, own in spans.items() for i, s in enumerate(own)], "page_id int, block_pos int, row_span int")
    columns = spark.createDataFrame([(p, c, c * 100, 90 + c) for p in spans for c in range(1 + p % 3)], "page_id int, column_index int, x int, width int")
    bands = spark.createDataFrame([(p, r, r * 50, 50 + r) for p in spans for r in range(2 + p % 4)], "page_id int, row int, y int, height int")
    want = set()
    for p, own in spans.items():
        for i, place in enumerate(layout.place_blocks([s or 1 for s in own], 1 + p % 3, 2 + p % 4)):
            want.add((p, i, *((None,) * 4 if place is None else (place[0] * 100, place[1] * 50, 90 + place[0], sum(50 + place[1] + k for k in range(place[2]))))))
    got = layout.assign_bounds(blocks, columns, bands)
    assert {tuple(r) for r in got.collect()} == want
    assert "MapInPandas" not in plan(got)
