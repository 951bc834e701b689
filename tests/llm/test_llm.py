import base64
import collections
import hashlib
import io
import itertools
import random
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from airgrid.llm.common import bounded_sample
from airgrid.llm import exact_dedup, graphs, html_extraction, language_id, license_scan, mixing, ngram_join, packing, quality_rules, toxicity, warc

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


def prose(seed, n=120):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(50)) for _ in range(n))


def docs(spark, texts, source="s", extra=False):
    rows = [(i, t, "en", source, len(t or "")) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, DOCS)
    # Columns with names that an operator might use itself.
    return df.withColumns({c: F.lit(1) for c in ("size", "kept", "digest", "n", "t", "id", "score")}) if extra else df


ODD = [None, "", " \n\t", "a", "a b", "!!!", "é" * 50, "x" * 30_000, prose(1), prose(1), prose(1) + " ", "\x00 \x1c \x85 z", "퟿ 日本 ﬁ İ Σας"]


# 1


def test_language_needs_a_letter(spark):
    """Numbers that aren't digits are no letters; a letter of any script is one."""
    model = language_id.Identifier({"en": b"some words of a language", "de": "ein paar Wörter".encode()})
    assert [model.identify(t)[0] for t in ("\u00bd \u00b2", "\u2460", "12 + 3_4", "", None, " \n")] == ["und"] * 6
    assert all(model.identify(t)[0] != "und" for t in ("\u2460a", "\u65e5", "\u00aa", "\u00df"))


def test_language_dictionaries_share_a_bound(spark, monkeypatch):
    """However many languages there are, their dictionaries together stay within ALL_BYTES."""
    monkeypatch.setattr(language_id, "ALL_BYTES", 5000)
    df = spark.createDataFrame([(i, f"text {i} of this language " * 40, f"l{i % 50}") for i in range(200)], "doc_id long, text string, lang string")
    found = language_id.learn(df)
    assert len(found) == 50 and 50 <= sum(map(len, found.values())) <= 5000


def test_language_id(spark):
    samples = {"en": ["the cat and the dog are in the house with that other one"] * 5, "de": ["der hund und die katze sind nicht mit dem anderen in einem haus"] * 5}
    rows = [(i, f"{t} {i}", lang) for i, (lang, t) in enumerate((lang, t) for lang, ts in samples.items() for t in ts)]
    d = language_id.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert sorted(d) == ["de", "en"]
    test = docs(spark, [*ODD, "the dog and the cat in that house", "die katze und der hund nicht in einem haus"], extra=True)
    got = {r["doc_id"]: r for r in language_id.predict(test, d).collect()}
    assert got[len(ODD)]["lang_pred"] == "en" and got[len(ODD) + 1]["lang_pred"] == "de"
    assert [got[i]["lang_pred"] for i in (0, 1, 2, 5)] == ["und"] * 4 and all(0 <= r["score"] <= 1 for r in got.values())
    assert got[8]["lang_pred"] == got[9]["lang_pred"]
    assert {r["lang_pred"] for r in language_id.predict(test, {}).collect()} == {"und"}
    assert language_id.predict(test.limit(0), d).count() == 0 and language_id.learn(test.select("doc_id", "text", "lang").limit(0)) == {}


def test_language_id_held_out(spark):
    r = random.Random(3)
    parts = {"en": "th ing er and ou of".split(), "fr": "eau ion les que ai ent".split(), "de": "sch ung ein der ich tz".split()}
    rows = [(i, " ".join("".join(r.choices(parts[lang], k=3)) for _ in range(40)), lang) for i, lang in enumerate(r.choices(list(parts), k=300))]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    d = language_id.learn(df.where("doc_id < 200"))
    got = language_id.predict(df.where("doc_id >= 200"), d, keep=("doc_id", "lang"))
    assert got.where("lang = lang_pred").count() >= 97


# 2


def brute_dedup(texts):
    norm = [("".join(c for c in t or "" if c not in " \t\n\x0b\f\r")) for t in texts]
    groups = collections.defaultdict(list)
    for i, x in enumerate(norm):
        groups[x].append(i)
    out = {}
    for x, own in groups.items():
        keep = max(own, key=lambda i: (len(texts[i] or ""), -i))
        for i in own:
            out[i] = (keep, len(own), i == keep, hashlib.sha256(x.encode()).hexdigest())
    return out


def test_exact_dedup_of_the_smallest_id(spark):
    least, most = -(2**63), 2**63 - 1
    df = spark.createDataFrame([(least, "a b"), (most, "ab "), (0, "ab"), (least, "other"), (None, "ab ")], "doc_id long, text string")
    got = {(r["doc_id"], r["text_sha256"]): (r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.deduplicate(df).collect()}
    a, b = (hashlib.sha256(x).hexdigest() for x in (b"ab", b"other"))
    assert got == {(least, a): (least, 4, True), (most, a): (least, 4, False), (0, a): (least, 4, False), (None, a): (least, 4, False), (least, b): (least, 1, True)}


@pytest.mark.parametrize("collide", [False, True])
def test_exact_dedup(spark, collide):
    texts = [*ODD, *[prose(7)] * 40, "a  b", "ab", "b a"]
    digest = (lambda c: F.length(c).cast("string")) if collide else exact_dedup.sha256
    got = exact_dedup.deduplicate(docs(spark, texts, extra=True).repartition(5), digest_of=digest).collect()
    want = brute_dedup(texts)
    assert {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in got} == {k: v[:3] for k, v in want.items()}
    if not collide:
        assert {r["doc_id"]: r["text_sha256"] for r in got} == {k: v[3] for k, v in want.items()}
    assert len(got) == len(texts)


def test_exact_dedup_odd_ids(spark):
    df = spark.createDataFrame([(None, "x"), (5, "x"), (5, "x"), (None, "y")], "doc_id long, text string")
    got = sorted(map(str, exact_dedup.deduplicate(df).select("doc_id", "keep_id", "group_size", "kept").collect()))
    assert len(got) == 4 and sum("kept=True" in x for x in got) == 2


@pytest.mark.parametrize("collide", [False, True])
def test_exact_dedup_repeated_rows(spark, collide):
    """Of rows that repeat an id and a text one is kept, whatever else they hold; the others count."""
    digest = (lambda c: F.length(c).cast("string")) if collide else exact_dedup.sha256
    rows = [(5, "a b", "x")] * 40 + [(5, "a b", "y"), (5, "ab", "z"), (6, "a b", "x"), (None, "q", "n"), (None, "q", "m"), (7, "zz", "x"), (7, "yy", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    got = exact_dedup.deduplicate(df, columns=("doc_id", "text", "source"), digest_of=digest).collect()
    assert sorted((str(r["doc_id"]), r["text"], r["source"]) for r in got) == sorted((str(i), t, s) for i, t, s in rows)
    kept = sorted((str(r["doc_id"]), r["text"], r["group_size"], r["keep_id"]) for r in got if r["kept"])
    assert kept == [("5", "a b", 43, 5), ("7", "yy", 1, 7), ("7", "zz", 1, 7), ("None", "q", 2, None)]


def test_exact_dedup_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert exact_dedup.deduplicate(df.limit(0)).count() == 0


# 3


def test_license_scan(spark):
    apache, mit = "Licensed under the Apache License, Version 2.0.", "Released under the MIT License."
    rows = [(1, "a/LICENSE", apache), (2, "a/b/x.py", "code\nmore code"), (3, "a/b/y.py", f"code one two three four five six\n{mit}\nmore"), (4, "z/w.py", "nothing"), (5, None, None), (6, "a/b/c/d/e.py", ""), (7, "a/b/c/LICENSE", mit), (8, "ab/x", "text")]
    df = spark.createDataFrame(rows, "doc_id long, path string, text string").withColumn("score", F.lit(0))
    got = {r["doc_id"]: (r["license"], r["how"], r["is_license_file"]) for r in license_scan.scan(df.repartition(3)).collect()}
    assert got == {1: ("Apache-2.0", "own", True), 2: ("Apache-2.0", "inherited", False), 3: ("MIT", "own", False), 4: (None, "none", False), 5: (None, "none", False), 6: ("MIT", "inherited", False), 7: ("MIT", "own", True), 8: (None, "none", False)}
    assert license_scan.scan(df.limit(0)).count() == 0


def test_license_inheritance_by_brute_force(spark):
    """Random trees: a file without a licence of its own has that of the nearest directory above it with a licence file."""
    r = random.Random(12)
    full = license_scan.with_full_texts()
    names = ["MIT", "BSD-3-Clause", "Apache-2.0", "MPL-2.0"]
    dirs = {tuple(r.choice("abc") for _ in range(r.randrange(5))) for _ in range(60)}
    held = {d: r.choice(names) for d in sorted(dirs) if r.random() < 0.3}
    files = [("/".join([*d, "LICENSE"]), full[name][-1], name) for d, name in held.items()]
    for k in range(250):
        d = tuple(r.choice("abcd") for _ in range(r.randrange(6)))
        own = r.choice(names) if k % 9 == 0 else None
        notice = license_scan.TEMPLATES[own][0] if own else ""
        files.append(("/".join([*d, f"f{k}"]), f"{prose(k, 40)}\n{notice}\n{prose(k + 1, 40)}" if k % 5 else notice, own))
    df = spark.createDataFrame([(i, p, t) for i, (p, t, _) in enumerate(files)], "doc_id long, path string, text string")
    got = {x["doc_id"]: (x["license"], x["how"]) for x in license_scan.scan(df.repartition(4)).collect()}
    # A file that is nothing but a notice speaks for its directory as well.
    speaking = {}
    for x in license_scan.scan(df).where("is_license_file").select("path", "own_license", "own_score").collect():
        speaking.setdefault(tuple(x["path"].split("/")[:-1]), []).append((-x["own_score"], x["path"], x["own_license"]))
    assert {d: min(v)[2] for d, v in speaking.items() if d in held}.keys() == held.keys()
    for i, (path, _, own) in enumerate(files):
        d = tuple(path.split("/")[:-1])
        above = next((min(speaking[d[:n]])[2] for n in range(len(d), -1, -1) if d[:n] in speaking), None)
        assert got[i] == ((own, "own") if own else (above, "inherited") if above else (None, "none")), path


def test_license_windows_at_every_offset(spark):
    """A notice anywhere in one long line is found, wherever it stands between two windows."""
    gpl, mpl = license_scan.TEMPLATES["GPL-3.0"][1], license_scan.TEMPLATES["MPL-2.0"][0]
    rows = [(f"d{k}/x", f"{prose(k, 150 + k)} {t} {prose(k + 1, 150)}", name) for name, t in (("GPL-3.0", gpl), ("MPL-2.0", mpl)) for k in range(24)]
    df = spark.createDataFrame([(i, f"{n}/{p}", t) for i, (p, t, n) in enumerate(rows)], "doc_id long, path string, text string")
    got = {x["doc_id"]: x["license"] for x in license_scan.scan(df).collect()}
    assert got == {i: n for i, (_, _, n) in enumerate(rows)}


def test_license_query_of_rows_without_names(spark, tmp_path):
    """A file without an id speaks for no directory; null sources and languages are directories of their own."""
    from airgrid.llm import queries

    mit = license_scan.with_full_texts()["MIT"][-1]
    rows = [(None, mit, "en", "s"), (1, "code", "en", "s"), (2, mit, None, "s"), (3, "code", None, "s"), (4, "code", "en", None), (5, "code", "s", "en"), (6, None, None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: (r["license"], r["how"]) for r in queries.op3_license_scan(spark, str(tmp_path)).collect()}
    assert got == {None: ("MIT", "own"), 1: (None, "none"), 2: ("MIT", "own"), 3: ("MIT", "inherited"), 4: (None, "none"), 5: (None, "none"), 6: (None, "none")}


def test_license_scores(spark):
    """Against plain cosines of all lines, without anchors."""
    import math

    r = random.Random(2)
    notices = [t for ts in license_scan.TEMPLATES.values() for t in ts]
    texts = ["\n".join(r.choice(notices) if r.random() < 0.2 else " ".join(r.choices([*WORDS, "the", "License", "under", "public"], k=8)) for _ in range(4)) for _ in range(60)]
    df = spark.createDataFrame([(i, f"d/{i}", t) for i, t in enumerate(texts)], "doc_id long, path string, text string")
    vocabulary = {w for t in notices for w in license_scan.tokens(t)}
    counts = {w: sum(w in license_scan.tokens(t) for t in texts) for w in vocabulary}
    idf, other = license_scan.weights(len(texts), counts)
    templates = license_scan.vectors(license_scan.TEMPLATES, idf, other)
    for row in license_scan.scan(df).collect():
        best = 0.0
        for unit in [texts[row["doc_id"]], *texts[row["doc_id"]].split("\n")]:
            v = {w: c * idf.get(w, other) for w, c in collections.Counter(license_scan.tokens(unit)).items()}
            norm = math.sqrt(sum(x * x for x in v.values())) or 1
            best = max(best, *(sum(x * v.get(w, 0) for w, x in t.items()) / norm for _, _, t in templates))
        assert row["own_score"] == pytest.approx(best if best >= license_scan.THRESHOLD else 0, abs=1e-6)


def test_license_texts_and_headers(spark):
    """Full texts are licence files; notices over several lines, or at the end of a long one, count."""
    full = license_scan.with_full_texts()
    mit = "Copyright (c) 2020 Someone\n\n" + full["MIT"][-1]
    lgpl = "/*\n * This library is free software; you can redistribute it and/or\n * modify it under the terms of the GNU Lesser General Public\n * License as published by the Free Software Foundation; either\n * version 2.1 of the License, or (at your option) any later version.\n */\n"
    gpl = " ".join(prose(5, 30).split()) + " This work is licensed under the GNU General Public License, version 3."
    texts = {"a/LICENSE": mit, "a/x.py": "code", "b/COPYING": full["BSD-3-Clause"][-1], "b/c/x.py": "code", "d/x.c": lgpl + prose(6, 200), "e/x.py": gpl, "f/x.py": prose(7, 300) + "\n" + full["MIT"][-1].replace("\n", "\n# ")}
    texts |= {f"{name}/LICENSE": full[name][-1] for name in ("Apache-2.0", "GPL-3.0", "LGPL-2.1", "MPL-2.0")}
    texts |= {f"z/{i}": prose(i) for i in range(100)}
    df = spark.createDataFrame([(i, p, t) for i, (p, t) in enumerate(texts.items())], "doc_id long, path string, text string")
    got = {r["path"]: (r["license"], r["how"], r["is_license_file"]) for r in license_scan.scan(df.repartition(3)).collect()}
    assert [got[p] for p in ("a/LICENSE", "a/x.py", "b/COPYING", "b/c/x.py")] == [("MIT", "own", True), ("MIT", "inherited", False), ("BSD-3-Clause", "own", True), ("BSD-3-Clause", "inherited", False)]
    assert [got[p] for p in ("d/x.c", "e/x.py", "f/x.py")] == [("LGPL-2.1", "own", False), ("GPL-3.0", "own", False), ("MIT", "own", False)]
    assert all(got[f"{name}/LICENSE"] == (name, "own", True) for name in ("Apache-2.0", "GPL-3.0", "LGPL-2.1", "MPL-2.0"))
    assert {got[f"z/{i}"] for i in range(100)} == {(None, "none", False)}


# 4


def brute_signals(text):
    text = text or ""
    ws = " \t\n\x0b\f\r"
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text) if w]
    grams = collections.defaultdict(list)
    for i in range(len(words) - 2):
        grams[tuple(words[i : i + 3])].append(i)
    covered = {i + k for own in grams.values() if len(own) > 1 for i in own for k in range(3)}
    lines = [x for x in text.split("\n") if x.strip(ws)]
    return len(words), sum(map(len, words)), sum(c in quality_rules.SYMBOLS for c in text), len(lines) - len(set(lines)), len(covered)


def test_quality_signals(spark):
    texts = [*ODD, "a b c a b c", "x x x x x", "l1\nl1\n\n \nl1 \nl2", "a b c d " * 500, "$$ ## <a> |", " ".join(WORDS) * 3, "a b c\td\na b c"]
    df = quality_rules.judge(docs(spark, texts, extra=True))
    for r in df.collect():
        want = brute_signals(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want, texts[r["doc_id"]][:50]
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
    assert quality_rules.judge(docs(spark, []).limit(0)).count() == 0


def test_quality_cascade(spark):
    clean, junk = prose(3).capitalize().replace("1", "").replace("2", ""), [prose(4).replace(" ", "$$$ "), prose(5).upper().replace(" ", "!! ")]
    texts = [clean, *junk]
    df = docs(spark, texts)
    assert {r["doc_id"] for r in quality_rules.judge(df).where("kept").collect()} == {0}
    names = list(quality_rules.RULES)
    t, norm = F.col("q_t"), F.col("q_norm")
    for order in (names, names[::-1]):  # any order has the same verdicts
        got = quality_rules.prepared(df, "text", ["doc_id"]).where(quality_rules.verdict(order, t, norm, quality_rules.Asked(t, norm))).collect()
        assert {r["q_own_0"] for r in got} == {0}
    # b is cheap; a rejects more, but all that b leaves; c rejects nothing.
    assert quality_rules.order_of({"a": 2.0, "b": 0.1, "c": 0.1}, {0: 5, 1: 3, 3: 4}) == ["b", "a", "c"]
    assert quality_rules.order_of({"a": 1.0, "b": 1.0, "c": 1.0}, {0: 5, 3: 4, 1: 1, 4: 2}) == ["a", "c", "b"]


def test_quality_survivors(spark):
    """The lazy cascade keeps what the judge keeps, with the input's own columns, whatever they are called."""
    texts = [*ODD, "a b c d " * 500, prose(3), prose(4).replace(" ", "$$$ "), prose(5).upper(), "\n".join(["one line of text here"] * 60), *[prose(i, 60).translate(str.maketrans("0123456789", "abcdefghij")) for i in range(20)]]
    df = docs(spark, texts, extra=True).withColumns({"n_words": F.lit("x"), "n_symbols": F.lit(2), "base_failed": F.lit(None).cast("int")}).repartition(3)
    judged = quality_rules.judge(df)
    kept = {r["doc_id"] for r in judged.where("kept").collect()}
    left = quality_rules.survivors(df)
    assert left.columns == df.columns and {r["doc_id"] for r in left.collect()} == kept and kept
    assert left.first()["n_words"] == "x" and judged.columns.count("n_words") == 1
    assert quality_rules.survivors(df.limit(0)).count() == 0


def test_quality_first_rule_is_stable(spark):
    """The rule that rejects most, and costs next to nothing, is asked first in each run."""
    texts = [prose(i, 200).translate(str.maketrans("0123456789", "abcdefghij")) for i in range(60)] + ["few words"] * 20 + ["a b c d " * 200] * 10
    for _ in range(2):
        assert quality_rules.order_of(*quality_rules.measure(docs(spark, texts)))[0] == "few_words"


def test_quality_costs_are_measured(spark):
    """Five measurements: counting repeated words costs more than looking at the number of words, by far, and the order is one."""
    texts = [prose(i, 300) for i in range(60)] + ["few words"] * 20 + ["#$% " * 60] * 10
    df = docs(spark, texts)
    orders = set()
    for _ in range(5):
        cost, rejected = quality_rules.measure(df)
        assert cost["many_repeats"] > 5 * cost["few_words"] and cost["many_repeats"] == max(cost.values()) > 0
        assert all(c >= 0 for c in cost.values()) and sum(rejected.values()) == len(texts)
        orders.add(tuple(quality_rules.order_of(cost, rejected)))
    assert len({o[:2] for o in orders}) == 1
    assert all(o[0] == "few_words" for o in orders)


def test_quality_order_follows_costs():
    """The dearest rule is last unless it rejects most per cost; noise within the factor changes nothing."""
    rejected = {0: 50, 1: 10, 2: 10, 4: 40}
    assert quality_rules.order_of({"a": 1.0, "b": 5.0, "c": 100.0}, rejected) == ["a", "b", "c"]
    assert quality_rules.order_of({"a": 1.0, "b": 5.0, "c": 2.0}, rejected) == ["c", "a", "b"]
    assert quality_rules.order_of({"a": 1.2, "b": 5.0, "c": 4.1}, rejected) == ["a", "c", "b"]
    assert quality_rules.order_of({"z": 1.0, "y": 1.3, "x": 40.0}, {0: 9}) == ["y", "z", "x"]


# 5


def test_tokens_are_the_tokenizers(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(TOKENIZER)  # as the file is
    own = packing.WordTokenizer(TOKENIZER)
    r = random.Random(1)
    odd = ["".join(r.choices("aAéÉñß'.,!?  \n\t1½#$-sStTrReE", k=60)) for _ in range(300)]
    for text in [*ODD, *odd, "it's WE'LL o'reilly ''s", "<|endoftext|> a", "a<|startoftext|>b <|endoftext|>", "<|ENDOFTEXT|> <| endoftext |>", "é<|endoftext|>é"]:
        assert own.encode(text) == np.array(t.encode(text or "", add_special_tokens=False).ids, dtype="<u4").tobytes(), text


def test_difference():
    # 8 against 7 leaves 1, 6 against 5 leaves 1, 4 against 1 leaves 3, and that against 1 leaves 2: sums of 16 and 14.
    assert sorted(sum([8, 7, 6, 5, 4][i] for i in w) for w in packing.difference([8, 7, 6, 5, 4], 2)) == [14, 16]
    r = random.Random(5)
    for _ in range(20):
        sizes = [r.randrange(1, 512) for _ in range(200)]
        out = packing.windows(sizes, 2048)
        assert sorted(itertools.chain(*out)) == list(range(200)) and all(sum(sizes[i] for i in w) <= 2048 for w in out)
        sums = [sum(sizes[i] for i in w) for w in out]
        assert max(sums) - min(sums) < 100
    assert packing.difference([], 3) == [] and len(packing.windows([2048, 2048, 1], 2048)) == 3


def test_packing(spark):
    texts = [*ODD, *[prose(i, 40 + 13 * i) for i in range(120)]]
    rows = packing.pack(docs(spark, texts, extra=True).repartition(3), TOKENIZER, with_ids=True).collect()
    own = packing.WordTokenizer(TOKENIZER)
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
        assert r["ids_crc32"] == zlib.crc32(r["ids"]) and len(r["ids"]) == 4 * r["length"]
    for i, t in enumerate(texts):
        pieces = sorted(by_doc[i], key=lambda r: r["start"])
        want = own.encode(t) + b"\1\0\0\0"
        assert b"".join(bytes(p["ids"]) for p in pieces) == want
        assert [p["start"] for p in pieces] == [0, *itertools.accumulate(p["length"] for p in pieces)][:-1] and {p["doc_tokens"] for p in pieces} == {len(want) // 4}
    for own_rows in by_sequence.values():
        at = 0
        for r in sorted(own_rows, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048
    assert packing.pack(docs(spark, []).limit(0), TOKENIZER).count() == 0


# 6


def test_kernel_is_the_kernel():
    """Against a plain count of common subsequences."""

    def phi(s):
        sym = [27, *map(toxicity.symbol, s), 28]
        out = collections.Counter()
        for size, gap in zip(toxicity.SIZES, toxicity.GAPS, strict=True):
            for at in itertools.combinations(range(len(sym)), size):
                if at[-1] - at[0] < size + gap:
                    out[tuple(sym[i] for i in at)] += toxicity.DECAY ** (at[-1] - at[0] + 1 - size)
        return out

    def cosine(a, b):
        a, b = phi(a), phi(b)
        return sum(v * b[k] for k, v in a.items()) / np.sqrt(sum(v * v for v in a.values()) * sum(v * v for v in b.values()))

    spans = ["idiot", "i-d-i-o-t", "idiiot", "other", "aaaaa"]
    k = toxicity.kernel(spans, spans)
    for (i, a), (j, b) in itertools.product(enumerate(spans), repeat=2):
        assert k[i, j] == pytest.approx(cosine(a, b), abs=1e-5)
    assert k[0, 1] > k[0, 3] and k[0, 2] > k[0, 3]


def test_toxicity(spark):
    r = random.Random(4)
    bad = ["idiot", "moron", "scumbag"]
    rows = []
    for i in range(240):
        words = prose(i, 40).split()
        if i % 4 == 0:
            words.insert(r.randrange(40), r.choice(bad))
        rows.append((i, " ".join(words), int(i % 4 == 0)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.learn(df.where("doc_id < 160").select("doc_id", "text"), df.select("doc_id", "toxic"))
    got = toxicity.score(df.where("doc_id >= 160"), model, keep=("doc_id", "toxic")).collect()
    assert sum((x["score"] >= 0.3) == (x["toxic"] == 1) for x in got) >= 0.97 * len(got)
    gapped = toxicity.score(docs(spark, ["you i-d-i-o-t", "an idiiot", "a m o r o n here", "quite harmless alpha1", "you id iot there", *ODD], extra=True), model).orderBy("doc_id").collect()
    assert [x["predicted"] for x in gapped[:4]] == [1, 1, 1, 0] and gapped[4]["predicted"] == 1 and all(0 <= x["score"] <= 1 for x in gapped)
    assert {x["score"] for x in toxicity.score(docs(spark, ["idiot"]), None).collect()} == {0.0}
    assert toxicity.score(docs(spark, []).limit(0), model).count() == 0
    assert toxicity.fit(["a"], [0]) is None


def test_folded_table_is_the_machine():
    """Scores from the table against the machine itself: kernels with the landmarks, times its weights."""
    r = np.random.default_rng(6)
    marks = ["idiot", "moron", "alpha", "gamma1", "nu xi", "stupid"]
    alpha = r.normal(size=len(marks))
    spans = ["idiot", "id iot", "i-d-i-o-t", "mooron", "alpha", "gamma2", "unrelated", "x", "stupidity", "été", *marks]
    model = toxicity.Model(toxicity.folded(marks, alpha), -0.5, 1.0, 0.0)
    explicit = toxicity.kernel(spans, marks) @ alpha - 0.5
    got = model.raw(spans)
    above = explicit > -0.5 + 1e-4  # others only need to stay below that
    assert above.any() and got[above] == pytest.approx(explicit[above], abs=1e-4) and (got[~above] <= -0.5 + 1e-4).all()


def test_toxicity_repeated_ids(spark, monkeypatch):
    """What reaches the driver is bounded by documents, not by rows that repeat their ids."""
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda texts, toxic: seen.extend(texts))
    df = spark.createDataFrame([(i % 7, f"text {i}") for i in range(4000)], "doc_id long, text string")
    toxicity.learn(df, df.select("doc_id", (F.col("doc_id") % 2).alias("toxic")), max_docs=3)
    assert len(seen) == 6
    d = language_id.learn(df.withColumn("lang", F.lit("en")), max_docs=5)
    assert d["en"].count(b"text") == 5


def test_bounded_sample(spark):
    df = spark.createDataFrame([(i, "a" if i % 10 else "b", f"t{i}") for i in range(5000)], "doc_id long, k string, text string")
    got = bounded_sample(df, "k", 40, 3, "doc_id", ("text",))
    assert sorted((r["k"], r["count"]) for r in got.groupBy("k").count().collect()) == [("a", 40), ("b", 40)]
    assert got.where("text <> concat('t', doc_id)").count() == 0
    assert sorted(map(str, got.collect())) == sorted(map(str, bounded_sample(df.repartition(5), "k", 40, 3, "doc_id", ("text",)).collect()))


def test_toxicity_letters_further_apart():
    for text in ("you s . t . u . p . i . d here", "you s  t  u  p  i  d here", "you s-t-u-p-i-d here"):
        assert "stupid" in toxicity.spans_of(text)
    assert "stupid" not in toxicity.spans_of("s .... t .... u .... p .... i .... d")


def test_ids_pass_unchanged(spark):
    big = [2**60 + 1, None, 7]
    df = spark.createDataFrame([(i, f"some text {k}") for k, i in enumerate(big)], "doc_id long, text string").coalesce(1)
    model = toxicity.Model(np.zeros(toxicity.CODES, dtype=np.float32), -1.0, 1.0, 0.0)
    for out in (language_id.predict(df, {"en": b"some text"}), toxicity.score(df, model), packing.pack(df, TOKENIZER), ngram_join.join(df), exact_dedup.deduplicate(df)):
        assert {r["doc_id"] for r in out.collect()} == set(big)


# 7


def brute_join(texts):
    words = [(t or "").encode("utf-8", "replace").split() for t in texts]
    grams = [{tuple(w[j : j + min(5, len(w))]) for j in range(len(w) - min(5, len(w)) + 1)} for w in words]
    links = collections.defaultdict(set)
    for i, j in itertools.combinations(range(len(texts)), 2):
        if words[i] and words[j] and len(grams[i] & grams[j]) >= 0.8 * len(grams[i] | grams[j]):
            links[i].add(j)
            links[j].add(i)
    label = {}
    for i in range(len(texts)):
        if i not in label:
            todo = [i]
            while todo:
                x = todo.pop()
                if x not in label:
                    label[x] = i
                    todo += links[x]
    n = {i: len({tuple(words[j]) for j in links[i]} - {tuple(words[i])}) for i in range(len(texts))}
    return {i: (label[i], n[i], max(1, sum(words[i] == w for w in words)) if words[i] else 1) for i in range(len(texts))}


@pytest.mark.parametrize("block,tie_block,small", [(2, 3, 1), (7, 5, 2), (256, 20_000, 16)])
def test_ngram_join(spark, monkeypatch, block, tie_block, small):
    monkeypatch.setattr(ngram_join, "SMALL", small)
    r = random.Random(8)
    texts = list(ODD)
    for k in range(6):
        base = prose(100 + k, 150).split()
        for _ in range(8):
            w = list(base)
            for _ in range(r.randrange(0, 9)):
                w[r.randrange(len(w))] = r.choice(WORDS)
            texts.append(" ".join(w))
    got = {x["doc_id"]: (x["class_id"], x["n_links"], x["n_copies"]) for x in ngram_join.join(docs(spark, texts, extra=True), block=block, tie_block=tie_block).collect()}
    assert got == brute_join(texts)


@pytest.mark.parametrize("edits", [4, 9, 14])
def test_ngram_join_of_large_families(spark, edits):
    """Families of hundreds in blocks of sixteen: most links are counted by margins, those around the threshold in cells."""
    r = random.Random(edits)
    texts = []
    for k in range(2):
        base = prose(200 + k, 160).split()
        for _ in range(150):
            w = list(base)
            for _ in range(r.randrange(0, edits)):
                w[r.randrange(len(w))] = r.choice(WORDS)
            texts.append(" ".join(w[r.randrange(3) :]))
    r.shuffle(texts)
    got = {x["doc_id"]: (x["class_id"], x["n_links"], x["n_copies"]) for x in ngram_join.join(docs(spark, texts), block=16).collect()}
    assert got == brute_join(texts)


def test_ngram_join_of_twenty_thousand_near_copies(spark):
    """A boilerplate page with one field: all pairs are links, none of them is compared."""
    n = 20_000
    base = prose(300, 120)
    df = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.lit(base + " number "), F.col("id").cast("string"), F.lit(" " + base[:200])).alias("text"))
    began = time.perf_counter()
    rows = ngram_join.join(df).groupBy("class_id", "n_links", "n_copies").count().collect()
    assert [tuple(x) for x in rows] == [(0, n - 1, 1, n)]
    assert time.perf_counter() - began < 120
    members = spark.createDataFrame([(1, 7, 10), (2, 7, 10)], "id long, component long, size long").withColumns({"first_id": F.col("id")})
    margins = spark.createDataFrame([(7, 1, 5, 0), (7, 2, 0, 0)], "component long, id long, margin long, least long").select("component", "id", "margin", "least")
    assert ngram_join.open_cells(members, margins, 16).isEmpty()


def test_ngram_join_odd(spark):
    df = spark.createDataFrame([(None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (2, None)], "doc_id long, text string")
    got = sorted((x["doc_id"] or 0, x["class_id"] or 0, x["n_links"]) for x in ngram_join.join(df).collect())
    assert got == [(0, 0, 0), (1, 1, 0), (1, 1, 0), (2, 2, 0)]
    assert ngram_join.join(df.limit(0)).count() == 0


def test_ngram_join_repeated_ids(spark):
    """An id with two texts is linked by either of them; the other rows of its id don't stand for the text."""
    a, b = prose(1, 60), prose(2, 60)
    near = lambda t: t.replace(" ", " x ", 1)
    df = spark.createDataFrame([(3, a), (5, a), (5, b), (5, b), (7, near(b)), (8, near(a))], "doc_id long, text string")
    got = sorted((x["doc_id"], x["class_id"], x["n_links"]) for x in ngram_join.join(df.repartition(3)).collect())
    assert got == [(3, 3, 1), (5, 3, 1), (5, 5, 1), (5, 5, 1), (7, 5, 1), (8, 3, 1)]


def test_led_leaves_all_connected():
    """Against all pairs: the same connected parts, with fewer comparisons."""
    r = np.random.default_rng(3)
    bases = r.integers(0, 256, (5, ngram_join.BANDS * ngram_join.ROWS), dtype=np.uint8)
    rows = bases[r.integers(0, 5, 120)].copy()
    for row in rows:
        at = r.integers(0, rows.shape[1], r.integers(0, 30))
        row[at] = r.integers(0, 256, len(at))
    side = np.arange(120) % 2
    for across in (False, True):
        x, y = np.triu_indices(120, 1)
        if across:
            x, y = x[side[x] != side[y]], y[side[x] != side[y]]
        want = dict(zip(*ngram_join.hung_together(*ngram_join.similar(rows, x, y, 0.8)), strict=True))
        pairs = list(ngram_join.led(rows, side, across, 0.8))
        got = dict(zip(*ngram_join.hung_together(*(np.concatenate(z) for z in zip(*pairs, strict=True))), strict=True))
        assert got == want and len(set(want.values())) == 5


def test_pruning_keeps_what_may_match():
    from math import comb

    for n in (24, 120, 240):
        m = ngram_join.least_matches(n)
        tail = lambda k: sum(comb(n + 1, i) * 0.8**i * 0.2 ** (n + 1 - i) for i in range(k + 1))
        assert tail(m) >= 1e-6 and (m == 0 or tail(m - 1) < 1e-6)


def test_shared_counts():
    sets = [np.array(sorted(random.Random(i).sample(range(60), 25))) for i in range(90)]
    a, b = np.triu_indices(90, 1)
    got = ngram_join.shared(lambda i: sets[i], a, b)
    assert got.tolist() == [len(set(sets[i]) & set(sets[j])) for i, j in zip(a, b, strict=True)]


def test_components(spark):
    r = random.Random(1)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(40)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x, y in edges:
        x, y = sorted((find(x), find(y)))
        parent[y] = x
    got = {x["id"]: x["component"] for x in graphs.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for e in edges if e[0] != e[1] for x in e}


# 8

PAGE = """<html><body><header><h1>Site</h1></header><div id="menu"><ul><li><a href=x>A</a><li><a href=y>B</a></ul></div><div class="wrap"><main class="content-12"><h1>T &amp; U</h1>
<p>Hello <b>bold</b>&nbsp;text one long enough to count for something<p>Second para<br>line<ul><li>one<li>two</ul><div class="share">share me</div><blockquote>quote</blockquote><aside>side</aside><form>f</form></main>
<div class="comments"><p>Nice article, a long comment that goes on and on and on and on and on and on</p></div></div><div class=cookie-notice>cookies</div><footer>foot</footer><script>var x="<p>no</p>"</script></body></html>"""


def test_html(spark):
    want = "T & U\n\nHello bold text one long enough to count for something\n\nSecond para line\n\none\n\ntwo\n\nquote"
    odd = "<html><body><div class=x7><p>Only here, a text that is long enough for a page of its own</p></div></body></html>"
    rows = [(i, "http://h.example/a", PAGE) for i in range(5)] + [(5, "http://h.example/b", None), (6, None, ""), (7, "bad", "just text &lt; 5"), (8, "http://h.example/c", odd), (9, "http://k.example/c", "<p>a<p>b &lt;i&gt;"), (None, "http://h.example/", PAGE)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"text": F.lit(1), "host": F.lit("x")})
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in html_extraction.extract_pages(df.repartition(3)).collect()}
    for i in (*range(5), None):
        assert got[i] == (want, len(want))
    assert [got[i][0] for i in (5, 6, 7, 9)] == ["", "", "just text < 5", "a\n\nb <i>"]
    assert got[8][0].startswith("Only here")
    assert html_extraction.extract_pages(df.limit(0)).count() == 0


def test_html_long():
    source = "<div>" * 3000 + "<p>x" * 3000
    assert html_extraction.extract(html_extraction.parse(source), []).count("x") == 3000


@pytest.mark.parametrize("tag", ["div", "ul", "b", "div class=related", "table><td"])
def test_html_deep(tag):
    """Nested 40,000 deep, in time and memory that grow with the length alone."""
    source = "<article>" + f"<{tag}>" * 40_000 + "<p>some words of a sentence, eight of them at least</p>" + "</x>" * 20_000
    assert "some words" in html_extraction.extract(html_extraction.parse(source), [])
    assert html_extraction.extract(html_extraction.parse("<p>text " + "<a " * 40_000), []).startswith("text")


def test_html_brute_force(spark):
    """Generated pages with a known main text, in several layouts of a host: every article comes out whole and alone."""
    r = random.Random(8)
    sentence = lambda k: " ".join(prose(k, 12).split()) + "."
    rows, want = [], {}
    for i in range(120):
        blocks = [("h1", f"Title {i}")] + [(r.choice(["p", "p", "p", "h2", "blockquote"]), sentence(1000 * i + k)) for k in range(r.randrange(3, 9))]
        main = "".join(f"<{t}>{x}</{t}>" for t, x in blocks)
        head = "<header class=site-header><a href=/>Home</a> Site name</header><nav><ul><li><a href=a>One</a><li><a href=b>Two</a></ul></nav>"
        side = "<aside><p>About this site and more words of it</p></aside><div class=comments><div class=comment><p>Nice one, really</p></div></div><footer>(c) all rights</footer><script>var a = '<p>x</p>'</script>"
        body = {
            0: f"{head}<article class='post-{i} entry'><header class=entry-header>{main[: main.index('</h1>') + 5]}</header>{main[main.index('</h1>') + 5 :]}</article>{side}",
            1: f"{head}<div id=page><main role=main><div class=content>{main}</div></main></div>{side}",
            2: f"{head}<div class=layout>{main[: main.index('</h1>') + 5]}<div class=body-text>{main[main.index('</h1>') + 5 :]}</div></div>{side}",
        }[i % 3]
        rows.append((i, f"http://h{i % 2}.example/{i}", f"<html><head><title>t</title></head><body>{body}</body></html>"))
        want[i] = "\n\n".join(x for _, x in blocks)
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = {x["page_id"]: x["text"] for x in html_extraction.extract_pages(df).collect()}
    assert got == want


def test_html_votes_are_parsed_once(spark):
    df = spark.createDataFrame([(i, "http://h.example/", PAGE) for i in range(6)], "page_id long, url string, html string")
    found = html_extraction.consensus(html_extraction.votes(df)).collect()
    assert [(r["host"], r["n"], len(r["winners"])) for r in found] == [("h.example", 6, 1)]
    assert found[0]["winners"] == [html_extraction.path_of(["html", "body", "div.wrap", "main"])]


def test_html_keeps_all_prose(spark):
    """Prose outside the heaviest container isn't lost; link lists beside it are left out."""
    one, two = "First part of the text. " * 40, "Second part of the text. " * 60
    links = "<div><ul><li><a href=x>Somewhere else on this site</a><li><a href=y>Another page of it</a></ul></div>"
    for a, b, x, y in (("content", "details", one, two), ("", "", two * 2, one)):
        source = f"<html><body>{links}<div class='{a}'><p>{x}</p></div><div class='{b}'><p>{y}</p></div></body></html>"
        df = spark.createDataFrame([(i, "http://h.example/", source) for i in range(4)], "page_id long, url string, html string")
        assert {r["text"] for r in html_extraction.extract_pages(df).collect()} == {f"{x.strip()}\n\n{y.strip()}"}
    assert html_extraction.extract(html_extraction.parse(f"<p>{one}</p><div><p>{two}</p></div>"), []).count("part") == 100


SAYS = [f"Sentence number {k} of the article says a few more words than eight." for k in range(6)]
ASIDES = ["We use cookies to make this site work well for all of you.", "Subscribe to our newsletter and get the best stories once a week.", "You may like this other story about the same thing as well.", "Nice piece, thank you very much for writing it down here."]


@pytest.mark.parametrize("article", ["article", "main", "div class='content'"])
def test_html_leaves_out_what_names_mark_inside(article):
    """Notices, newsletters, related stories, footers and comments around and between the paragraphs of an article."""
    p = [f"<p>{x}</p>" for x in SAYS]
    end = article.split()[0]
    for name, aside in zip(("notice", "newsletter", "related-posts", "comment"), ASIDES, strict=True):
        for place in (0, len(p)):
            body = [*p[:place], f"<div class='{name}'><p>{aside}</p></div>", *p[place:]]
            got = html_extraction.extract(html_extraction.parse(f"<body><{article}>{''.join(body)}</{end}></body>"), [])
            assert got == "\n\n".join(SAYS), (name, place)
    for name in ("newsletter", "footer", "share"):
        body = [*p[:3], f"<div class='{name}'><p>{ASIDES[1]}</p></div>", *p[3:]]
        assert html_extraction.extract(html_extraction.parse(f"<body><{article}>{''.join(body)}</{end}></body>"), []) == "\n\n".join(SAYS)


def test_html_parts_of_papers_stay():
    p = [f"<p>{x}</p>" for x in SAYS]
    for source in (
        f"<body><div>{''.join(p[:3])}<div id='discussion'>{''.join(p[3:])}</div></div></body>",
        f"<body><div>{p[0]}<section class='related-work'>{''.join(p[1:])}</section></div></body>",
        f"<body><article>{''.join(p[:2])}<section class='related-work'>{''.join(p[2:4])}</section><section id='discussion'>{''.join(p[4:])}</section></article></body>",
        f"<body><article><div class='notice'>{p[0]}<h1></h1></div>{''.join(p[1:])}</article></body>".replace(p[0] + "<h1></h1>", f"<h1>{SAYS[0]}</h1>"),
        f"<body><article>{''.join(p[:3])}<div class='notice'>{p[3]}</div>{''.join(p[4:])}</article></body>",
    ):
        assert html_extraction.extract(html_extraction.parse(source), []) == "\n\n".join(SAYS)


def test_html_forms():
    """A page that is one form keeps its prose and loses its fields; other forms go."""
    p = "".join(f"<p>{x}</p>" for x in SAYS)
    fields = "<select><option>One</option></select><input value='x'><button>Send it</button><textarea>typed</textarea>"
    whole = f"<body><form id='aspnetForm'><input type='hidden' value='abc'><nav><a href='/'>Home</a></nav><div id='content'>{p}</div>{fields}</form></body>"
    assert html_extraction.extract(html_extraction.parse(whole), []) == "\n\n".join(SAYS)
    for form in (f"<form>Name: <input> Mail: <input>{fields}</form>", f"<form><p>{ASIDES[1]}</p>{fields}</form>", f"<div role='form'>{ASIDES[1]}{fields}</div>"):
        for source in (f"<body>{form}<article>{p}</article></body>", f"<body><article>{p}{form}</article></body>", f"<body><div>{p}</div>{form}</body>"):
            assert html_extraction.extract(html_extraction.parse(source), []) == "\n\n".join(SAYS)


def test_html_line_beside_the_winning_path(spark):
    """Twenty pages of one layout; the twenty-first has a correction beside the block that wins."""
    p = "".join(f"<p>{x}</p>" for x in SAYS * 20)
    rows = [(k, "http://h/", f"<body><div class='page'><div class='text'>{p}</div></div></body>") for k in range(20)]
    rows.append((20, "http://h/", f"<body><div class='page'><div class='text'>{p}</div><p>Correction: the name was wrong.</p></div></body>"))
    got = {r["page_id"]: r["text"] for r in html_extraction.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    text = "\n\n".join(SAYS * 20)
    assert got == {**dict.fromkeys(range(20), text), 20: text + "\n\nCorrection: the name was wrong."}


def test_html_small_block_on_the_winning_path(spark):
    """A rare layout with a teaser on its host's usual path keeps its article."""
    usual = "<html><body><div class=story><p>" + "A usual page of this host. " * 30 + "</p></div></body></html>"
    rare = "<html><body><div class=story><p>A teaser of some words.</p></div><section><p>" + "The rare article itself. " * 50 + "</p></section></body></html>"
    df = spark.createDataFrame([(i, "http://h.example/", rare if i == 0 else usual) for i in range(30)], "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_extraction.extract_pages(df.repartition(2)).collect()}
    assert got[0].count("rare article") == 50 and "teaser" in got[0] and got[1].count("usual") == 30


def test_html_names_inside_an_article():
    """A name alone takes nothing out of an article; links, forms, lists of comments and adverts do."""
    keep = [
        "<section id=discussion><p>{}</p></section>", "<section id='related-work'><h2 id=search>Search</h2><p>{}</p></section>", "<div class=legal>{}</div>",
        "<p class=notice>{}</p>", "<div class='entry-header'><h1><a href=x>The title</a></h1><p>{}</p></div>", "<p>Some <span class=alert>{}</span></p>",
    ]
    drop = [
        "<div class=share>{}</div>", "<div class=related><ul><li><a href=x>{}</a></ul></div>", "<div class=widget>{}<input name=q></div>", "<div class=ad>{}</div>",
        "<ol class=comments><li>{}<li>two</ol>", "<div class=comment>{}</div><div class=comment>b</div>",
    ]
    for tag in ("article", "div class=content", "main"):
        inner = [f.format(f"keep{i}") for i, f in enumerate(keep)] + [f.format(f"drop{i}") for i, f in enumerate(drop)]
        source = f"<body><{tag}><p>{'The text of this page. ' * 30}</p>{''.join(inner)}</{tag.split()[0]}><div class=legal>outside</div></body>"
        got = html_extraction.extract(html_extraction.parse(source), [])
        assert [i for i in range(len(keep)) if f"keep{i}" not in got] == [] and [i for i in range(len(drop)) if f"drop{i}" in got] == []
        assert "Search" in got and "The title" in got and "outside" not in got


# 9


def brute_targets(sizes, weights, cap=3):
    out, fixed = [0.0] * len(sizes), set()
    while True:
        left = sum(sizes) - sum(cap * sizes[i] for i in fixed)
        total = sum(w for i, w in enumerate(weights) if i not in fixed)
        for i, w in enumerate(weights):
            out[i] = cap * sizes[i] if i in fixed else left * w / total
        over = {i for i in range(len(sizes)) if i not in fixed and out[i] > cap * sizes[i]}
        if not over:
            return out
        fixed |= over


def test_targets_and_seats():
    r = random.Random(9)
    for _ in range(200):
        sizes = [r.choice([0, r.randrange(1, 5000)]) for _ in range(r.randrange(1, 9))]
        if sum(sizes):
            weights = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
            assert mixing.targets(sizes, weights) == pytest.approx(brute_targets(sizes, weights), abs=1e-6)
        votes, most = np.array([r.choice([0, 1, 5, r.random() * 100]) for _ in range(6)]), np.array([r.randrange(1, 30) for _ in range(6)])
        seats = r.randrange(0, 60)
        want = np.zeros(6, dtype=int)
        for _ in range(min(seats, int(most[votes > 0].sum()))):
            want[int(np.where((want < most) & (votes > 0), votes / (2 * want + 1), -1).argmax())] += 1
        assert mixing.sainte_lague(seats, votes, most).tolist() == want.tolist()


def test_mixing(spark):
    texts = [prose(i, 20 + 7 * (i % 40)) for i in range(400)]
    rows = [(i, t, "en", None if i % 9 == 0 else "big" if i % 3 else f"s{i % 5}", len(t)) for i, t in enumerate(texts)] + [(900, None, "en", "s1", 0), (901, "", "en", "empty", 0)]
    df = spark.createDataFrame(rows, DOCS).withColumns({"size": F.lit(1), "target": F.lit("x")})
    got = mixing.mix(df.repartition(5)).collect()
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(df.repartition(2)).collect()))
    source = {r[0]: r[3] for r in rows}
    sizes = collections.Counter()
    for r in rows:
        sizes[r[3]] += len((r[1] or "").split())
    names = sorted((s for s in sizes if s is not None)) + [None]
    want = dict(zip(names, brute_targets([sizes[s] for s in names], [(5, 2, 1)[i % 3] for i in range(len(names))]), strict=True))
    taken = collections.Counter()
    for r in got:
        assert r["size"] == len((rows[r["doc_id"]][1] if r["doc_id"] < 900 else "" or "").split()) and 0 <= r["taken"] <= 3 * r["size"]
        assert r["target"] == pytest.approx(want[source[r["doc_id"]]]) and r["source_size"] == sizes[source[r["doc_id"]]]
        taken[source[r["doc_id"]]] += r["taken"]
    for s in names:
        assert abs(taken[s] - want[s]) <= mixing.BLOCK
    out = mixing.rows_taken(df).collect()
    words = collections.Counter()
    for r in out:
        words[r["doc_id"]] += len(r["text"].split())
    assert words == collections.Counter({r["doc_id"]: r["taken"] for r in got if r["taken"]})
    assert mixing.mix(df.limit(0)).count() == 0


@pytest.mark.parametrize("words", [1, 20, 40, 100])
def test_mixing_small_sources(spark, words):
    """No source falls out, however small, and each gives about its target."""
    df = spark.createDataFrame([(i, " ".join(["w"] * words), f"s{i:02}") for i in range(60)] + [(100 + i, None, "none") for i in range(50)], "doc_id long, text string, source string")
    got = mixing.mix(df).collect()
    want = brute_targets([60 - 60] + [words] * 60, [(5, 2, 1)[i % 3] for i in range(61)])  # "none" is the first by code point
    assert len(got) == 110 and sum(r["taken"] for r in got) == 60 * words
    for r in got:
        i = r["doc_id"]
        assert r["target"] == pytest.approx(want[1 + i] if i < 60 else 0.0) and r["taken"] <= 3 * r["size"] and r["source_size"] == (words if i < 60 else 0)
        assert abs(r["taken"] - r["target"]) <= max(1, words // mixing.FINE)


def test_mixing_shards_and_repeated_rows(spark, monkeypatch):
    """Many shards of one source add up to its target; rows that repeat an id are each taken for themselves."""
    monkeypatch.setattr(mixing, "SHARD_WORDS", 500)
    rows = [(i, prose(i, 30 + i % 50), "a" if i % 3 else "b") for i in range(300)] + [(7, prose(7, 37), "a")] * 5
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit(1))
    got = mixing.mix(df).groupBy("target").agg(F.sum("taken").alias("t"), F.count(F.lit(1)).alias("n")).collect()
    assert sum(r["n"] for r in got) == len(rows) and all(abs(r["t"] - r["target"]) <= mixing.BLOCK for r in got)
    taken = mixing.rows_taken(df).select("doc_id", F.size(F.split("text", " ")).alias("w"), "size").collect()
    assert sum(r["w"] for r in taken) == sum(r["t"] for r in got) and {r["size"] for r in taken} == {1}


def test_words_for():
    assert mixing.words_for(np.array([2, 1]), np.array([10, 3]), 8, 24).tolist() == [16, 8]
    assert mixing.words_for(np.array([2, 2]), np.array([10, 3]), 8, 26).tolist() == [17, 9]
    assert mixing.words_for(np.array([2, 1]), np.array([10, 3]), 8, 20).tolist() == [12, 8]


# 10


def test_warc_changed_payload():
    data = warc.record(5, None, b"abc", None)
    assert warc.parse(data)["payload"] == b"abc"
    with pytest.raises(ValueError):
        warc.parse(data.replace(b"abc", b"xyz"))


def test_warc(spark):
    rows = [(1, "http://a/ b", "<p>x"), (2, "http://a/c", "<p>x"), (3, None, None), (4, "http://é", ""), (None, "http://n", "<p>x"), (2**60 + 1, "http://big", "z" * 200_000), (7, "http://a/d", "日本"), (7, "http://a/d", "日本")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"h": F.lit(1), "last": F.lit("x")})
    archives = warc.write(df.repartition(3))
    got = sorted((str(r["page_id"]), r["record_type"], r["refers_to"], r["payload_bytes"], r["payload_digest"], None if r["payload"] is None else bytes(r["payload"])) for r in warc.read(archives).collect())
    last = {}
    for i, _, h in rows:
        last[h or ""] = max(last.get(h or "", -1), -1 if i is None else i)
    want = []
    for i, _, h in rows:
        p = (h or "").encode()
        first = i == last[h or ""]
        want.append((str(i), "response" if first else "revisit", None if first else last[h or ""], len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), p if first else None))
    assert got == sorted(want)
    assert warc.read(warc.write(df.limit(0))).count() == 0


def test_warc_bytes():
    data = warc.record(5, "http://x/ y", b"abc\r\n\r\ndef", None)
    assert warc.parse(data)["payload"] == b"abc\r\n\r\ndef" and b"http://x/%20y" in data
    assert warc.parse(warc.record(None, None, b"", 9))["refers_to"] == 9
    d = warc.dictionary([warc.record(i, f"http://x/{i}", f"<p>page {i} of the site</p>".encode() * 5, None) for i in range(200)])
    import struct

    import zstandard

    tool = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(d))
    stream = io.BytesIO(struct.pack("<II", warc.MAGIC, len(d)) + d + b"".join(tool.compress(warc.record(i, None, b"x" * i, None)) for i in range(0, 200_000, 50_000)))
    assert [len(warc.parse(x)["payload"]) for x in warc.read_records(stream)] == [0, 50_000, 100_000, 150_000]
    assert warc.dictionary([]) == b"" and warc.dictionary([b"ab"]) == b"ab"
