"""Language identification by compression: a text has the language whose dictionary makes it smallest.

Letters are lower-cased. For each language a raw-content Zstandard dictionary is filled with whole labelled texts. A text is compressed
once with each dictionary; the smallest result names the language, and the gap to the second smallest is the
margin. A narrow margin sets `rejected`, beside the best guess, so that a caller can drop or route such rows.

Edge cases: a null, empty or letterless text has language `und`, score 0 and is rejected; of equal sizes the
first language by code point wins, with score 0; an empty training table gives `und` everywhere; columns of the
input other than the id and the text are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airgrid.llm.common import bounded_sample, cut

#: Labelled documents read for each language at most; bytes of each dictionary, of all together, and of a slice.
MAX_DOCS = 128
DICTIONARY_BYTES, ALL_BYTES, SLICE = 1 << 17, 1 << 26, 512
LEVEL = 3
#: Whole texts are compressed in slices, each against the fresh dictionary: else a long text is its own dictionary.
SLICE_BYTES = 1 << 13
#: A relative margin that counts as certain, and one below which the guess is rejected.
CERTAIN, NARROW = 0.08, 0.01
SCHEMA = "lang_pred string, score double, rejected boolean"


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", max_docs: int = MAX_DOCS, size: int = DICTIONARY_BYTES) -> dict[str, bytes]:
    """Dictionary of each language, from at most max_docs texts of it.

    The dictionary is made, in a task, of evenly spaced slices of all of them, in the order of a seeded hash. All
    languages share ALL_BYTES, so that what reaches the driver and is broadcast stays bounded, however many there are.
    """
    rows = bounded_sample(labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull()), lang, max_docs, 1, key, (text,))
    rows = cut(rows.select(F.col(lang).alias("name"), F.xxhash64(F.lit(1), F.col(key)).alias("h"), F.col(text).alias("text")))
    each = min(size, ALL_BYTES // max(1, rows.select("name").distinct().count()))

    def slices(own: pd.DataFrame) -> pd.DataFrame:
        data = "\n".join(own.sort_values(["h", "text"])["text"].str.lower()).encode("utf-8", "replace")
        return pd.DataFrame({"name": own["name"].iloc[:1], "data": [spread(data, each)]})

    return {r["name"]: bytes(r["data"]) for r in rows.groupBy("name").applyInPandas(slices, "name string, data binary").orderBy("name").collect()}


def spread(data: bytes, size: int) -> bytes:
    """size bytes of data, in slices that are spread evenly over all of it."""
    slices = -(-len(data) // SLICE)
    n = min(slices, max(1, size // SLICE))
    return b"".join(data[i * slices // n * SLICE :][:SLICE] for i in range(n))[:size]


class Identifier:
    def __init__(self, dictionaries: dict[str, bytes]):
        self.names = sorted(dictionaries)
        self.compressors = []
        for name in self.names:
            d = zstandard.ZstdCompressionDict(dictionaries[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            self.compressors.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_checksum=False, write_content_size=False))

    def sizes(self, text: str) -> list[int]:
        data = text.lower().encode("utf-8", "replace")
        parts = [data[i : i + SLICE_BYTES] for i in range(0, len(data), SLICE_BYTES)]
        return [sum(len(c.compress(p)) for p in parts) for c in self.compressors]

    def identify(self, text: str | None) -> tuple[str, float, bool]:
        if not text or not self.names or not any(map(str.isalpha, text)):
            return "und", 0.0, True
        sizes = self.sizes(text)
        ranked = sorted(range(len(sizes)), key=lambda i: (sizes[i], self.names[i]))
        if len(ranked) == 1:
            return self.names[0], 1.0, False
        best, second = sizes[ranked[0]], sizes[ranked[1]]
        margin = (second - best) / second
        return self.names[ranked[0]], min(1.0, margin / CERTAIN), margin < NARROW


def predict(docs: DataFrame, dictionaries: dict[str, bytes], text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """keep and SCHEMA for each row of docs; a scan and no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries)  # a bounded number of bytes for each language
    kept = docs.select(*keep, F.col(text).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Identifier(shared.value)
        for b in batches:
            got = [model.identify(t) for t in b.column(b.num_columns - 1).to_pylist()]
            new = [pa.array([g[i] for g in got], kind) for i, kind in enumerate((pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *new], names=[*b.schema.names[:-1], "lang_pred", "score", "rejected"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1])
    return kept.mapInArrow(run, f"{schema}, {SCHEMA}")
