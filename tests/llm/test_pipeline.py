import random

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from test_llm import DOCS, brute_dedup, brute_join, brute_signals, brute_targets
from test_llm import prose as numbered

from airgrid.llm.common import shared_dir


def prose(seed, n=120):
    return numbered(seed, n).translate(str.maketrans("0123456789", "abcdefghij"))


def corpus():
    r = random.Random(2)
    texts = [prose(i, 60 + i) for i in range(60)] + [prose(3, 63)] * 5 + [prose(4, 64).replace(" ", "\n")] + [None, "", "short text", "word " * 90, prose(9).replace(" ", "$$$ ")]
    for k in range(5):
        w = prose(200 + k, 200).split()
        for _ in range(4):
            v = list(w)
            v[r.randrange(200)] = "changed"
            texts.append(" ".join(v))
    return texts


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    texts = corpus()
    rows = [(i, t, "en", f"s{i % 3}" if i % 7 else None, len(t or "")) for i, t in enumerate(texts)]
    path = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{path}/documents.parquet")
    docs, out = spark.read.parquet(f"{path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        to = shared_dir(spark, name)
        stage(spark, docs, path).write.parquet(to)
        docs = spark.read.parquet(to)
        out[name] = (before, docs)
    return path, out


def texts_of(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_stages(stages):
    _, out = stages
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "exact_duplicates", "near_duplicates", "mixture", "sequences"]
    for name in names[:-1]:
        assert tuple(out[name][1].columns) == corpus_pipeline.COLUMNS


def test_quality(stages):
    before, after = map(texts_of, stages[1]["quality"])
    for i, t in before.items():
        n, _, symbols, _, repeated = brute_signals(t)
        if n < 50 or 2 * repeated > n or 10 * symbols > n:
            assert i not in after
        else:
            assert after[i] == t


def test_exact(stages):
    before, after = map(texts_of, stages[1]["exact_duplicates"])
    ids = sorted(before)
    want = {ids[k] for k, v in brute_dedup([before[i] for i in ids]).items() if v[2]}
    assert set(after) == want


def test_near(stages):
    before, after = map(texts_of, stages[1]["near_duplicates"])
    ids = sorted(before)
    want = {ids[v[0]] for v in brute_join([before[i] for i in ids]).values()}
    assert set(after) == want


def test_mixture_and_sequences(stages):
    before, after = (df.collect() for df in stages[1]["mixture"])
    size = sum(len(r["text"].split()) for r in before)
    assert abs(sum(len(r["text"].split()) for r in after) - size) <= 64 * 8
    pieces = stages[1]["sequences"][1].collect()
    assert pieces
    assert sum(r["length"] for r in pieces) == sum(r["doc_tokens"] for r in pieces if r["start"] == 0)


def test_mixture_by_brute_force(stages):
    """Each source's words come near its target, no document is there more than three times, and rows are whole or one is cut for each shard."""
    before, after = (df.collect() for df in stages[1]["mixture"])
    sizes, taken, target = {}, {}, {}
    for r in before:
        sizes[r["source"]] = sizes.get(r["source"], 0) + len(r["text"].split())
    for r in after:
        taken[r["source"]] = taken.get(r["source"], 0) + len(r["text"].split())
    names = sorted(sizes, key=lambda s: (s is None, s))
    for name, want in zip(names, brute_targets([sizes[s] for s in names], [(5, 2, 1)[k % 3] for k in range(len(names))]), strict=True):
        target[name] = want
        assert abs(taken.get(name, 0) - want) <= 64, name
    texts = {r["doc_id"]: r["text"] for r in before}
    own = {}
    for r in after:
        own.setdefault(r["doc_id"], []).append(r["text"])
    for i, parts in own.items():
        assert sum(len(t.split()) for t in parts) <= 3 * len(texts[i].split())
        assert all(set(t.split()) <= set(texts[i].split()) for t in parts)


def test_run(spark, stages):
    path, out = stages
    assert sum(r["length"] for r in corpus_pipeline.run(spark, path).collect()) == sum(r["length"] for r in out["sequences"][1].collect())


def test_empty(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_near_duplicates_of_ids_with_two_texts(spark, tmp_path):
    """A near copy goes, another text of the same id stays; of an id with two near copies, or the same words twice, one row stays."""
    a, b, c, d = (prose(k, 80) for k in range(4, 8))
    rows = [(1, a), (5, a + " tail"), (5, b), (7, c), (8, d), (8, d + " tail"), (9, "one two"), (9, "one  two"), (9, ""), (9, None), (-(2**63), c + " end"), (-(2**63), "other words")]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCS).repartition(3)
    got = sorted((r["doc_id"], r["text"] or "") for r in corpus_pipeline.near_duplicates(spark, df, str(tmp_path)).collect())
    texts = [t.replace("  ", " ") for _, t in got]
    kept_of_8 = [t for i, t in got if i == 8]
    assert len(kept_of_8) == 1 and kept_of_8[0] in (d, d + " tail")
    assert sorted(texts) == sorted([a, b, c + " end", kept_of_8[0], "one two", "", "", "other words"])


def test_stages_odd_input(spark, tmp_path):
    """Extra columns with the operators' own names, repeated rows, null ids and sources: each stage keeps its columns, and one row of each repeat."""
    long = prose(1, 80)
    rows = [(1, long, "en", "a", 5), (1, long, "en", "a", 5), (1, long, "en", "a", 5), (2, prose(2, 90), None, None, None), (None, prose(3, 70), "en", "b", 1), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, DOCS)
    extra = ("n_words", "n_symbols", "kept", "base_failed", "size", "target", "laps", "class_id", "k", "n", "digest", "norm", "q_size", "q_t", "own_0", "id", "t", "rows")
    wide = df.withColumns({c: F.lit("x") for c in extra}).repartition(2)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, wide, str(tmp_path))
        assert tuple(out.columns) == corpus_pipeline.COLUMNS
        ids = [r["doc_id"] for r in out.collect()]
        assert 2 in ids and None in ids
        if name in ("exact_duplicates", "near_duplicates"):
            assert ids.count(1) == 1
        if name == "quality":
            assert ids.count(1) == 3
        assert stage(spark, wide.limit(0), str(tmp_path)).count() == 0
    packed = corpus_pipeline.STAGES[-1][1](spark, wide, str(tmp_path)).collect()
    assert {r["doc_id"] for r in packed} == {1, 2, None} and sum(r["start"] == 0 for r in packed) == 6
