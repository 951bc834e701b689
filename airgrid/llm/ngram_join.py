"""Similarity join on the Jaccard index of word n-grams, with Bayesian pruning of candidates.

1. Texts of equal words are one node of the join, so copies cost nothing later.
2. MinHash values in BANDS bands of ROWS put nodes into buckets. Nodes of a bucket meet with their signatures (a byte of
   each MinHash value), which are compared CHUNK at a time; a pair goes when the posterior probability (uniform prior)
   that its similarity reaches the threshold falls below TOLERANCE. A node is compared with all others of its bucket
   that don't hang together with it yet, until all that is left hangs together. Only one tie of each node leaves a task.
3. The connected components of the ties are families. Texts of families meet in cells of two blocks of a family; there
   each pair is pruned in the same way, and the sets of word n-grams of all that are left are compared exactly.
   A cell gives the links of each node and the smallest node it hangs together with, never the pairs.
4. A family of more than a block of nodes, such as the copies of a boilerplate page, isn't compared in pairs. Its core is
   the n-grams that most of a few of its texts have. With C the core, M(a) what a lacks of it and D(a) what a has besides,
   a and b have |C| - |M(a)| - |M(b)| + x n-grams in common, x >= 0 counting what M(a) and M(b), and D(a) and D(b), share.
   So they are linked if the margins 9 |C| - 18 |M| - 8 |text| of both (at a threshold of 0.8) add up to 0 or more,
   whatever x is: sums over the margins' histogram count those links, and all texts that the one with the largest
   margin is linked to are one class. Each text meets the core once. Only pairs whose margins add up to less than 0 are
   compared in cells, one of them a text of negative margin.
5. Components of all those are the classes; links add up over the cells.

Nodes that only share a bucket by chance, or by a passage, are pruned before any text moves, so a family is about a class.
A pair at the threshold shares no bucket with probability (1 - 0.8^ROWS)^BANDS, 5e-6; pruning adds about TOLERANCE at
each chunk.

Edge cases: words are the runs of characters other than [\\x20\\x09-\\x0D]; a text of 1 to n-1 words has one n-gram,
all its words; a null, empty or blank text has none, so no link and a class of its own; rows that repeat an id with
another text are each taken for their own text, and a class has the smallest id of its rows; rows with a null id keep null
ids and have no links; an empty table gives an empty result; columns other than the id and the text are not looked at.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Callable, Iterator
from fractions import Fraction
from functools import cache
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airgrid.llm.common import cut
from airgrid.llm.graphs import components

N, THRESHOLD = 5, 0.8
BANDS, ROWS = 40, 6
CHUNK, TOLERANCE = 24, 1e-6
#: Nodes of a bucket's block; nodes and bytes of text of a family's block, about; nodes of a bucket from which they aren't compared all at once.
TIE_BLOCK, BLOCK, BLOCK_BYTES, SMALL = 20_000, 1024, 1 << 24, 16
#: Texts of a large family that its core is taken from, about.
CORE_TEXTS = 40
_RANDOM = np.random.default_rng(7)
_FACTORS = _RANDOM.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _RANDOM.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "replace").split() if text else []


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def hashes(words: list[bytes], n: int = N) -> np.ndarray:
    """A 64-bit hash of each n-gram, in order."""
    h = np.array([xxhash.xxh3_64_intdigest(w) for w in words], dtype=np.uint64)
    size = min(n, len(h))
    if not size:
        return h
    total = np.zeros(len(h) - size + 1, dtype=np.uint64)
    for i in range(size):
        total += h[i : len(h) - size + 1 + i] * _PLACE[i]
    return mixed(total)


def minhash(h: np.ndarray) -> np.ndarray:
    """BANDS * ROWS values of 64 bits; h is not empty."""
    out = np.full(len(_FACTORS), np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(h), 512):
        np.minimum(out, (h[i : i + 512, None] * _FACTORS).min(axis=0), out=out)
    return out


def signature(values: np.ndarray) -> bytes:
    """A byte of each value; unequal values have equal bytes once in 256 times."""
    return mixed(values).astype(np.uint8).tobytes()


def band_keys(values: np.ndarray) -> np.ndarray:
    total = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    for i, column in enumerate((values >> np.uint64(32)).reshape(BANDS, ROWS).T):
        total = mixed(total + (column + np.uint64(1)) * _PLACE[i])
    return total.astype(np.int64)


@cache
def least_matches(compared: int, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> int:
    """Fewest equal values out of those compared with which P(similarity >= threshold) is at least tolerance.

    With a uniform prior that probability is P(Binomial(compared + 1, threshold) <= equal values).
    """
    total = 0.0
    for m in range(compared + 1):
        total += comb(compared + 1, m) * threshold**m * (1 - threshold) ** (compared + 1 - m)
        if total >= tolerance:
            return m
    return compared


def digest_of(words: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def text_hashes(text: Column) -> list[Column]:
    """Two 64-bit hashes, t1 and t2, of a whole text, by which a row's result can be found."""
    return [F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(1), text).alias("t2")]


def sketches(docs: DataFrame, key: str, text: str, n: int) -> DataFrame:
    """(id, digest of the words, bytes of the text, band keys and signature; these are null without words; two hashes of the text) of each row."""
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("t"), *text_hashes(F.col(text)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            digests, sizes, keys, signatures = [], [], [], []
            for t in b.column(1).to_pylist():
                words = words_of(t)
                values = minhash(hashes(words, n)) if words else None
                digests.append(digest_of(words))
                sizes.append(len(t or ""))
                keys.append(band_keys(values) if words else None)
                signatures.append(signature(values) if words else None)
            new = [pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()), pa.array(keys, pa.list_(pa.int64())), pa.array(signatures, pa.binary())]
            yield pa.RecordBatch.from_arrays([b.column(0), *new, *b.columns[2:]], names=["id", "digest", "size", "bands", "signature", "t1", "t2"])

    return rows.mapInArrow(run, "id long, digest binary, size long, bands array<long>, signature binary, t1 long, t2 long")


def whole_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows that are sorted by their first columns, as tables of whole groups with the place where each group starts."""

    def starts_of(t: pa.Table) -> np.ndarray:
        new = np.ones(t.num_rows, dtype=bool)
        if keys and t.num_rows:
            new[1:] = False
            for c in t.columns[:keys]:
                x = c.to_numpy()
                new[1:] |= x[1:] != x[:-1]
        return np.flatnonzero(new)

    held = None
    for b in batches:
        if not b.num_rows:
            continue
        t = pa.Table.from_batches([b])
        t = t if held is None else pa.concat_tables([held, t])
        starts = starts_of(t)
        if starts[-1]:
            yield t.slice(0, int(starts[-1])), starts[:-1]
        held = t.slice(int(starts[-1]))
    if held is not None:
        yield held, np.zeros(1, dtype=np.int64)


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, BANDS * ROWS)


def similar(signatures: np.ndarray, a: np.ndarray, b: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Of the pairs (a[i], b[i]) of rows those that pruning leaves. Bytes are equal by chance too, which the threshold for them allows for."""
    of_bytes = threshold + (1 - threshold) / 256
    equal = np.zeros(len(a), dtype=np.int32)
    for at in range(0, signatures.shape[1], CHUNK):
        if not len(a):
            break
        equal += (signatures[a, at : at + CHUNK] == signatures[b, at : at + CHUNK]).sum(axis=1, dtype=np.int32)
        alive = equal >= least_matches(min(at + CHUNK, signatures.shape[1]), of_bytes)
        a, b, equal = a[alive], b[alive], equal[alive]
    return a, b


def led(signatures: np.ndarray, side: np.ndarray, across: bool, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs that pruning leaves, enough of them that all such pairs hang together.

    A leader is compared with all that don't hang together with it yet, and is done; the next one is a node outside
    the largest part. Across two blocks only nodes of the other block count. Each pair is compared, or hangs together.
    """
    part, open_ = np.arange(len(signatures)), np.ones(len(signatures), dtype=bool)
    while True:
        largest = np.bincount(part[open_], minlength=1).argmax()
        outside = np.flatnonzero(open_ & (part != largest))
        if not len(outside):
            return
        leader = outside[0]
        others = np.flatnonzero(open_ & (part != part[leader]) & ((side != side[leader]) if across else True))
        open_[leader] = False
        a, b = similar(signatures, np.full(len(others), leader), others, threshold)
        if len(b):
            yield a, b
            part[np.isin(part, part[b])] = part[leader]


def parts(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of each of n nodes the smallest one that it hangs together with by the pairs (a[i], b[i])."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def hung_together(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node that it hangs together with) by the pairs, of the nodes that aren't the smallest."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    label = parts(len(nodes), at[: len(a)], at[len(a) :])
    other = label != np.arange(len(nodes))
    return nodes[other], nodes[label[other]]


def ties_of(cells: DataFrame, threshold: float) -> DataFrame:
    """Ties (a, b) of nodes from cells (bucket, i, j, node, block, signature) that lie together and in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, starts in whole_groups(batches, 3):
            ids, side, signatures = t["node"].to_numpy(), t["block"].to_numpy(), matrix(t["signature"])
            across = t["i"].to_numpy() != t["j"].to_numpy()
            sizes = np.diff(np.append(starts, len(ids)))
            pairs: list[tuple[np.ndarray, np.ndarray]] = []
            for m in np.unique(sizes[sizes > 1]).tolist():
                own = starts[sizes == m]
                if m <= SMALL:
                    x, y = np.triu_indices(m, 1)
                    pairs.append(similar(signatures, (own[:, None] + x).ravel(), (own[:, None] + y).ravel(), threshold))
                else:
                    pairs += [(a + s, b + s) for s in own.tolist() for a, b in led(signatures[s : s + m], side[s : s + m], bool(across[s]), threshold)]
            if pairs:
                a, b = (ids[np.concatenate(x)] for x in zip(*pairs, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in hung_together(a, b)], names=["a", "b"])

    return cells.mapInArrow(run, "a long, b long")


class Grams:
    """The word n-grams of texts, each gram as a number that stands for it alone."""

    def __init__(self, words: Callable[[int], list[bytes]], n: int):
        self.words, self.n = words, n
        self.number: dict[tuple, int] = {}
        self.known: dict[int, np.ndarray] = {}

    def of(self, i: int) -> np.ndarray:
        if i not in self.known:
            w = self.words(i)
            size = min(self.n, len(w))
            found = [self.number.setdefault(tuple(w[j : j + size]), len(self.number)) for j in range(len(w) - size + 1)]
            self.known[i] = np.unique(np.array(found, dtype=np.int64))
        return self.known[i]


def linked(grams: Grams, signatures: np.ndarray, left: np.ndarray, right: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of the pairs (left[i], right[i]) of texts those that reach the threshold, in batches: pruned, then compared exactly."""
    for k in range(0, len(left), 1 << 20):
        a, b = similar(signatures, left[k : k + (1 << 20)], right[k : k + (1 << 20)], threshold)
        if len(a):
            both = np.array([len(np.intersect1d(grams.of(i), grams.of(j), assume_unique=True)) for i, j in zip(a.tolist(), b.tolist(), strict=True)]) if len(a) < 1000 else shared(grams.of, a, b)
            sizes = np.zeros(len(signatures), dtype=np.int64)
            for i in np.union1d(a, b).tolist():
                sizes[i] = len(grams.of(i))
            good = both >= threshold * (sizes[a] + sizes[b] - both) - 1e-9
            yield a[good], b[good]


def shared(grams: Callable[[int], np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Common n-grams of many pairs at once: products of incidence matrices over n-grams of two texts at least."""
    left, right = np.unique(a), np.unique(b)
    own = np.union1d(left, right)
    sets = [grams(int(i)) for i in own]
    rows, cols = np.repeat(np.arange(len(own)), [len(x) for x in sets]), np.concatenate(sets)
    often = np.bincount(cols) > 1
    keep = often[cols]
    rows, cols = rows[keep], (np.cumsum(often) - 1)[cols[keep]]
    total = np.zeros((len(left), len(right)), dtype=np.float32)
    order = np.argsort(cols, kind="stable")
    rows, cols = rows[order], cols[order]
    of_left, of_right = np.searchsorted(own, left), np.searchsorted(own, right)
    width = 1 << 12
    for start in range(0, int(often.sum()), width):
        lo, hi = np.searchsorted(cols, (start, start + width))
        m = np.zeros((len(own), width), dtype=np.float32)
        m[rows[lo:hi], cols[lo:hi] - start] = 1
        total += m[of_left] @ m[of_right].T
    return total[np.searchsorted(left, a), np.searchsorted(right, b)].astype(np.int64)


def cell_links(ids: list[int], blocks: list[int], texts: list[str], signatures: np.ndarray, across: bool, n: int, threshold: float, margins: list[int] | None = None) -> Iterator[tuple[int, int, int]]:
    """(id, smallest id that it hangs together with here, links here) of the nodes of a cell.

    The pairs are those within the cell's block, or those across its two blocks (none if one of them is empty); with
    margins only those whose margins add up to less than 0.
    """
    key = np.array(ids, dtype=np.int64)
    order = np.argsort(key, kind="stable")  # so that the smallest node is the one with the smallest id
    key, block, signatures = key[order], np.array(blocks)[order], signatures[order]
    grams = Grams(lambda i: words_of(texts[order[i]]), n)
    if across:
        left, right = (x.ravel() for x in np.meshgrid(np.flatnonzero(block == block.min()), np.flatnonzero(block > block.min())))
    else:
        left, right = np.triu_indices(len(key), 1)
    if margins and margins[0] is not None:
        margin = np.array(margins)[order]
        open_ = margin[left] + margin[right] < 0
        left, right = left[open_], right[open_]
    links, root = np.zeros(len(key), dtype=np.int64), np.arange(len(key))
    for a, b in linked(grams, signatures, left, right, threshold):
        links += np.bincount(a, minlength=len(key)) + np.bincount(b, minlength=len(key))
        root = parts(len(key), np.concatenate([a, np.arange(len(key))]), np.concatenate([b, root]))
    yield from zip(key.tolist(), key[root].tolist(), links.tolist(), strict=True)


def links_of(cells: DataFrame, n: int, threshold: float) -> DataFrame:
    """(component, k, id, root, links) from cells (component, i, j, k, id, block, signature, margin, t) that lie together and in order."""
    kinds = {"component": pa.int64(), "k": pa.int32(), "id": pa.int64(), "root": pa.int64(), "links": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, starts in whole_groups(batches, 3):
            out: list[tuple] = []
            for start, end in zip(starts.tolist(), [*starts[1:].tolist(), t.num_rows], strict=True):
                g = t.slice(start, end - start).to_pydict()
                signatures = np.frombuffer(b"".join(g["signature"]), dtype=np.uint8).reshape(end - start, -1)
                found = cell_links(g["id"], g["block"], g["t"], signatures, g["i"][0] != g["j"][0], n, threshold, g["margin"])
                out += [(g["component"][0], g["k"][0], *x) for x in found]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*out, strict=True), kinds.values(), strict=True)], names=list(kinds))

    return cells.mapInArrow(run, "component long, k int, id long, root long, links long")


def gram_set(text: str, n: int) -> set[bytes]:
    """The word n-grams of a text, their words one space apart."""
    w = words_of(text)
    size = min(n, len(w))
    return {b" ".join(w[j : j + size]) for j in range(len(w) - size + 1)} if w else set()


def cores_of(sample: DataFrame, n: int) -> DataFrame:
    """(component, core) of texts (component, t) of each family: the n-grams that half of them have at least. Any core gives right links; a good one few open pairs."""
    texts = sample.groupBy("component").agg(F.collect_list("t").alias("ts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cores = []
            for ts in b.column("ts").to_pylist():
                counts = Counter(g for t in ts for g in gram_set(t, n))
                cores.append(sorted(g for g, c in counts.items() if 2 * c >= len(ts)))
            yield pa.RecordBatch.from_arrays([b.column("component"), pa.array(cores, pa.list_(pa.binary()))], names=["component", "core"])

    return texts.mapInArrow(run, "component long, core array<binary>")


def margins_of(rows: DataFrame, blocks: DataFrame, cores: DataFrame, n: int, threshold: float) -> DataFrame:
    """(component, id, margin) of rows (component, id, block, t). Each of the blocks gets its core as its first row, so each text travels once."""
    none = [F.lit(None).cast(kind).alias(c) for c, kind in (("id", "long"), ("t", "string"))]
    first = blocks.join(cores, "component", "left").select("component", "block", F.lit(0).alias("kind"), *none, F.coalesce("core", F.array().cast("array<binary>")).alias("core"))
    own = rows.select("component", "block", F.lit(1).alias("kind"), "id", "t", F.lit(None).cast("array<binary>").alias("core"))
    both = first.unionByName(own).repartition("component", "block").sortWithinPartitions("component", "block", "kind")
    up, down = Fraction(threshold).limit_denominator(1000).as_integer_ratio()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        core: set[bytes] = set()
        for b in batches:
            out: tuple[list, ...] = ([], [], [])
            for component, kind, i, t, new in zip(*(b.column(c).to_pylist() for c in ("component", "kind", "id", "t", "core")), strict=True):
                if kind == 0:
                    core = set(new)
                else:
                    own = gram_set(t, n)
                    # Linked: common >= up / (up + down) (|a| + |b|); twice that, so that halves of the core are whole.
                    margin = (up + down) * (len(core) - 2 * len(core - own)) - 2 * up * len(own)
                    for column, x in zip(out, (component, i, margin), strict=True):
                        column.append(x)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["component", "id", "margin"])

    return both.mapInArrow(run, "component long, id long, margin long")


def linked_by_margin(margins: DataFrame) -> DataFrame:
    """(component, id, margin, links, root) with the other nodes whose margin makes up for a node's own, and the family's node of the largest margin if that does.

    Counted over the histogram of each family's margins, which has no more values than its texts have lengths.
    """
    bars = margins.groupBy("component", "margin").agg(F.count(F.lit(1)).alias("c"))
    # At a value v the bars of v and more; a node of margin m asks at -m. Bars come before questions of the same value.
    marks = bars.select("component", F.col("margin").alias("v"), F.lit(0).alias("asks"), "c", F.lit(None).cast("long").alias("margin"))
    marks = marks.unionByName(bars.select("component", (-F.col("margin")).alias("v"), F.lit(1).alias("asks"), F.lit(0).cast("long").alias("c"), "margin"))
    upto = F.sum("c").over(Window.partitionBy("component").orderBy(F.desc("v"), "asks").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    counts = marks.withColumn("n", upto).where("asks = 1").select("component", "margin", "n")
    tops = margins.groupBy("component").agg(F.max("margin").alias("top"), F.min("margin").alias("least"), F.max_by("id", F.struct("margin", "id")).alias("hub"))
    found = margins.join(counts, ["component", "margin"]).join(tops, "component")
    links = F.col("n") - F.when(F.col("margin") >= 0, 1).otherwise(0)  # itself among them
    return found.select("component", "id", "margin", "least", links.alias("links"), F.when(F.col("margin") + F.col("top") >= 0, F.col("hub")).otherwise(F.col("id")).alias("root"))


def dealt(rows: DataFrame, group: str, first: Column | None = None) -> DataFrame:
    """Each row of a group of k blocks in the k cells (i, j) of its block, each cell lying together and in order; of two blocks from `first` on there is no cell."""
    others = F.sequence(F.lit(0), F.col("k") - 1)
    if first is not None:
        others = F.filter(others, lambda x: F.least(x, F.col("block")) < first)
    cells = rows.withColumn("other", F.explode(others))
    cells = cells.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")}).drop("other")
    return cells.select(group, "i", "j", *(c for c in rows.columns if c != group)).repartition(group, "i", "j").sortWithinPartitions(group, "i", "j")


def spread(k: Column, *seed: Column | str) -> Column:
    """One of k blocks, by a hash."""
    return F.pmod(F.xxhash64(*seed), k).cast("int")


def blocks_of(count: Column, size: Column, block: int) -> Column:
    return F.least(F.ceil(F.greatest(count / block, size / BLOCK_BYTES)), count).cast("int")


def open_cells(members: DataFrame, margins: DataFrame, block: int) -> DataFrame:
    """Members of large families that still have pairs to compare, in blocks: those of negative margins in the first ones.

    A text whose margin the least one of its family can't bring below 0 has no such pair.
    """
    open_ = members.select("id", "component", "size").join(margins.where("margin + least < 0").select("id", "margin"), "id").withColumn("negative", F.col("margin") < 0)
    size = open_.groupBy("component").agg(*(f(F.when(w, x)).alias(name) for name, f, w, x in (("m0", F.count, F.col("negative"), F.lit(1)), ("m1", F.count, ~F.col("negative"), F.lit(1)), ("s0", F.sum, F.col("negative"), F.col("size")), ("s1", F.sum, ~F.col("negative"), F.col("size")))))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    size = size.select("component", blocks_of(F.col("m0"), zero("s0"), block).alias("k0"), blocks_of(F.col("m1"), zero("s1"), block).alias("k1"))
    at = F.when(F.col("negative"), spread(F.col("k0"), "id")).otherwise(F.col("k0") + spread(F.greatest(F.col("k1"), F.lit(1)), "id")).cast("int")
    placed = open_.join(size, "component").select("id", "margin", at.alias("block"), (F.col("k0") + F.col("k1")).alias("k"), "k0")
    return members.join(placed, "id")


def join(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = N, threshold: float = THRESHOLD, block: int = BLOCK, tie_block: int = TIE_BLOCK) -> DataFrame:
    """(key, class_id, n_links, n_copies, represents, t1, t2) of each row of docs.

    class_id is the smallest id of the class; n_links counts the other distinct texts that reach the threshold,
    n_copies the documents of the same words, this one among them; represents is true for the rows of the class's smallest
    id and, of that, one text; t1 and t2 are the row's text_hashes.
    """
    sketch = cut(sketches(docs, key, text, n))
    nodes = sketch.where("id is not null and bands is not null").groupBy("digest").agg(F.min("id").alias("first_id"), F.countDistinct("id").alias("n_copies"))
    nodes = cut(cut(nodes).withColumn("node", F.monotonically_increasing_id()))
    named = nodes.select(F.col("digest").alias("of"), "first_id", "node")
    own = sketch.where("bands is not null").join(named, (F.col("digest") == F.col("of")) & (F.col("id") == F.col("first_id"))).select("node", "first_id", "t1", "t2", "digest", "size", "bands", "signature").dropDuplicates(["digest"])
    own = cut(own)
    buckets = own.select(F.explode("bands").alias("bucket"), "node")
    often = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    shared_by = buckets.join(often, "bucket").select("bucket", "node", F.ceil(F.col("c") / tie_block).cast("int").alias("k")).withColumn("block", spread(F.col("k"), "node", "bucket"))
    met = shared_by.join(own.select("node", "signature"), "node").select("bucket", "k", "node", "block", "signature")
    families = components(ties_of(dealt(met, "bucket"), threshold))
    families = families.select(F.col("id").alias("node"), "component").join(own.drop("bands"), "node")
    size = families.groupBy("component").agg(F.count(F.lit(1)).alias("m"), F.sum("size").alias("bytes"))
    members = families.join(size, "component").withColumn("k", blocks_of(F.col("m"), F.col("bytes"), block))
    members = members.select(F.col("node").alias("id"), "first_id", "t1", "t2", "component", "m", "size", "k", spread(F.col("k"), F.col("node")).alias("block"), "signature")
    # Only texts of families travel on, once before the cells are dealt; rows that repeat one lie together already.
    row = ["first_id", "t1", "t2"]
    texts = docs.select(F.col(key).cast("long").alias("first_id"), *text_hashes(F.col(text)), F.coalesce(F.col(text), F.lit("")).alias("t")).where("first_id is not null")
    members = cut(members.join(texts, row).dropDuplicates(row).drop(*row))
    columns = ("component", "k", "id", "block", "signature", "margin", "t")
    small = members.where(F.col("m") <= block).withColumn("margin", F.lit(None).cast("long"))
    found = cut(links_of(dealt(small.select(*columns), "component"), n, threshold))
    large = members.where(F.col("m") > block)
    if not large.isEmpty():
        sample = large.where(F.xxhash64("id", F.lit(3)) / 2.0**64 + 0.5 <= CORE_TEXTS / F.col("m"))
        margins = cut(linked_by_margin(cut(margins_of(large, large.select("component", "block").distinct(), cores_of(sample.select("component", "t"), n), n, threshold))))
        found = found.unionByName(margins.select("component", F.lit(2).alias("k"), "id", "root", "links"))
        rest = open_cells(large.drop("k", "block"), margins, block)
        if not rest.isEmpty():
            cells = dealt(rest.select(*columns, "k0"), "component", F.col("k0"))
            found = found.unionByName(cut(links_of(cells, n, threshold)).withColumn("k", F.lit(2)))
    links = found.groupBy("id").agg(F.sum("links").alias("n_links"), F.min("root").alias("root"))
    wide = found.where("k > 1 and id <> root").select(F.col("id").alias("a"), F.col("root").alias("b"))
    if not wide.isEmpty():  # families of several cells: their parts are put together
        links = links.join(components(wide).withColumnRenamed("component", "joined"), "id", "left").withColumn("root", F.coalesce("joined", "root"))
    links = cut(links.withColumnRenamed("id", "node").join(nodes.select("node", "first_id", "digest"), "node"))
    least = links.groupBy("root").agg(F.min(F.struct("first_id", "digest")).alias("least"))
    links = links.join(least, "root").select("node", "least", "n_links")
    result = sketch.join(nodes, "digest", "left").join(links, "node", "left")
    has = F.col("id").isNotNull() & F.col("bands").isNotNull()
    least = F.coalesce("least", F.struct("first_id", "digest"))
    return result.select(
        F.col("id").alias(key),
        F.when(has, least["first_id"]).otherwise(F.col("id")).alias("class_id"),
        F.when(has, F.coalesce("n_links", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("n_links"),
        F.when(has, F.col("n_copies")).otherwise(F.lit(1)).cast("long").alias("n_copies"),
        (~has | ((F.col("id") == least["first_id"]) & (F.col("digest") == least["digest"]))).alias("represents"),
        "t1",
        "t2",
    )
