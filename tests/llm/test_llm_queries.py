"""Every query opN_<name> as the driver calls it, on the tables of sf0.001."""

import os
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F
from test_llm import TOKENIZER, brute_dedup, brute_join, brute_signals, brute_targets

from airgrid.llm import language_id, queries, toxicity

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")

COLUMNS = {
    "op1_language_id": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op2_exact_dedup": {"doc_id": "bigint", "keep_id": "bigint", "group_size": "bigint", "kept": "boolean", "text_sha256": "string"},
    "op3_license_scan": {"doc_id": "bigint", "license": "string"},
    "op4_quality_rules": {"doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint", "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean"},
    "op5_packing": {"doc_id": "bigint", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "doc_tokens": "bigint", "sequence_id": "bigint", "offset": "bigint"},
    "op6_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op7_ngram_join": {"doc_id": "bigint", "class_id": "bigint", "n_links": "bigint"},
    "op8_html_extraction": {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"},
    "op9_mixing": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    "op12_periodic_runs": {"doc_id": "bigint", "n_runs": "bigint", "start": "bigint", "length": "bigint", "period": "bigint", "exponent_milli": "bigint", "runs_sha256": "string", "collapsed_sha256": "string"},
    "op13_line_dedup": {"doc_id": "bigint", "n_lines": "bigint", "n_dropped": "bigint", "kept_sha256": "string"},
    "op10_warc": {"page_id": "bigint", "payload_bytes": "bigint", "payload_digest": "string", "record_type": "string", "refers_to": "bigint"},
}


@pytest.fixture(scope="module")
def tables(spark):
    docs = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()]
    return docs, spark.read.parquet(f"{SF}/pages.parquet").count()


@pytest.fixture(scope="module")
def got(spark):
    out = {}
    for name, query in queries.QUERIES.items():
        df = query(spark, SF)
        out[name] = (dict(df.dtypes), df.collect())
    return out


@pytest.mark.parametrize("name", COLUMNS)
def test_rows_and_columns(got, tables, name):
    kinds, rows = got[name]
    assert COLUMNS[name].items() <= kinds.items()
    n = tables[1] if "page_id" in kinds else len(tables[0])
    assert len({r[0] for r in rows}) == n and (name == "op5_packing" or len(rows) == n)


def test_columns_of_conversations(spark, got):
    kinds, rows = got["op11_conversation_repair"]
    names = {"gaps", "blank", "duplicate", "truncated", "illegal", "cost"}
    assert kinds == {"conv_id": "bigint", "audit": "string", "repaired_sha256": "string"} | dict.fromkeys(names, "bigint")
    ids = [r[0] for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id").distinct().collect()]
    assert sorted(r["conv_id"] for r in rows) == sorted(ids)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(got, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    cursor = con.execute(queries.SQL[name])
    names = [c[0] for c in cursor.description]
    key = lambda row: tuple(map(str, row))
    assert sorted(cursor.fetchall(), key=key) == sorted((tuple(r[c] for c in names) for r in got[name][1]), key=key)


def held_out(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


@pytest.mark.parametrize("name", ["op1_language_id", "op6_toxicity"])
def test_held_out_rows_are_marked(got, name):
    assert all(r["held_out"] == held_out(r["doc_id"]) for r in got[name][1]) and all(0 <= r["score"] <= 1 for r in got[name][1])


@pytest.fixture(scope="module")
def spoiled(spark, tmp_path_factory):
    """The tables with other texts, languages, sources and labels in the held-out rows, and other sources everywhere."""
    path = str(tmp_path_factory.mktemp("spoiled"))
    out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs.withColumns({"text": F.when(out, F.lit("zug zug zug idiot zug")).otherwise(F.col("text")), "lang": F.when(out, F.lit("qq")).otherwise(F.col("lang")), "source": F.lit("s")}).write.parquet(f"{path}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    labels.withColumn("toxic", F.when(out, 1 - F.col("toxic")).otherwise(F.col("toxic"))).write.parquet(f"{path}/labels.parquet")
    return path


@pytest.mark.parametrize("name", ["op1_language_id", "op6_toxicity"])
def test_held_out_rows_are_not_learned_from(spark, got, spoiled, name):
    answer = lambda rows: {r["doc_id"]: (r["score"], r["lang_pred"] if name[2] == "1" else r["predicted"]) for r in rows if not r["held_out"]}
    assert answer(queries.QUERIES[name](spark, spoiled).collect()) == answer(got[name][1])


def test_language_by_brute_force(spark, got, tables):
    """Each text by zstandard alone: the language whose dictionary makes it smallest."""
    import zstandard

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    dictionaries = language_id.learn(docs.where(F.crc32(F.col("doc_id").cast("string")) % 4 != 2).select("doc_id", "text", "lang"))
    tools = {k: zstandard.ZstdCompressor(level=language_id.LEVEL, dict_data=zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT), write_content_size=False) for k, d in dictionaries.items()}
    predicted = {r["doc_id"]: r["lang_pred"] for r in got["op1_language_id"][1]}
    right = total = 0
    for i, text, lang, _ in tables[0]:
        if not text or not any(c.isalpha() for c in text):
            assert predicted[i] == "und"
            continue
        data = text.lower().encode()
        size = {k: sum(len(t.compress(data[j : j + language_id.SLICE_BYTES])) for j in range(0, len(data), language_id.SLICE_BYTES)) for k, t in tools.items()}
        assert predicted[i] == min(sorted(size), key=size.get)
        if lang is not None and held_out(i):
            right, total = right + (predicted[i] == lang), total + 1
    assert right >= 0.9 * total


def test_toxicity_by_brute_force(spark, got):
    """Scores of whole texts from the model, without Spark."""
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = toxicity.learn(docs.where(F.crc32(F.col("doc_id").cast("string")) % 4 != 2), labels)
    rows = {r["doc_id"]: (r["score"], r["predicted"]) for r in got["op6_toxicity"][1]}
    for r in docs.collect():
        want = float(model.scores([r["text"]])[0]) if model else 0.0
        assert rows[r["doc_id"]] == (pytest.approx(want, abs=1e-9), int(rows[r["doc_id"]][0] >= 0.3))


def test_dedup_signals_and_links_by_brute_force(got, tables):
    ids, texts = [d[0] for d in tables[0]], [d[1] for d in tables[0]]
    dedup = {r["doc_id"]: r for r in got["op2_exact_dedup"][1]}
    for k, (keep, size, kept, sha) in brute_dedup(texts).items():
        assert tuple(dedup[ids[k]][c] for c in ("keep_id", "group_size", "kept", "text_sha256")) == (ids[keep], size, kept, sha)
    signals = {r["doc_id"]: r for r in got["op4_quality_rules"][1]}
    for i, t in zip(ids, texts, strict=True):
        assert tuple(signals[i][c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == brute_signals(t)
    links = {r["doc_id"]: r for r in got["op7_ngram_join"][1]}
    for k, (label, n, copies) in brute_join(texts).items():
        assert tuple(links[ids[k]][c] for c in ("class_id", "n_links", "n_copies")) == (ids[label], n, copies)


def test_packing_by_round_trip(got, tables):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(TOKENIZER)
    pieces, used = {}, {}
    for r in got["op5_packing"][1]:
        pieces.setdefault(r["doc_id"], []).append(r)
        used.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for i, text, *_ in tables[0]:
        ids, at = [*t.encode(text or "", add_special_tokens=False).ids, 1], 0
        for p in sorted(pieces[i], key=lambda p: p["start"]):
            part = b"".join(x.to_bytes(4, "little") for x in ids[at : at + p["length"]])
            assert p["start"] == at and p["doc_tokens"] == len(ids) and p["ids_crc32"] == zlib.crc32(part)
            at += p["length"]
        assert at == len(ids)
    for own in used.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))] and sum(n for _, n in own) <= 2048
    assert sum(n for own in used.values() for _, n in own) >= 0.95 * 2048 * (len(used) - 1)


def test_mixing_by_brute_force(got, tables):
    sizes, taken, target = {}, {}, {}
    rows = {r["doc_id"]: r for r in got["op9_mixing"][1]}
    for i, text, _, source in tables[0]:
        r = rows[i]
        assert r["size"] == len((text or "").encode().split()) and 0 <= r["taken"] <= 3 * r["size"]
        sizes[source], taken[source] = sizes.get(source, 0) + r["size"], taken.get(source, 0) + r["taken"]
        assert target.setdefault(source, r["target"]) == r["target"]
    names = sorted(sizes, key=lambda s: (s is None, s))
    want = brute_targets([sizes[s] for s in names], [(5, 2, 1)[k % 3] for k in range(len(names))])
    for s, w in zip(names, want, strict=True):
        assert target[s] == pytest.approx(w) and abs(taken[s] - w) <= 64 and {r["source_size"] for r, d in ((rows[d[0]], d) for d in tables[0]) if d[3] == s} == {sizes[s]}
