"""Periodic runs of words: stretches in which the same words come round with one period.

A run is a stretch of consecutive words with smallest period q, at least max(MIN_LENGTH, 2 q) long, that no neighbouring
word extends. They are found in each text by itself:

1. Splitting. A word with no equal within half the length of its segment is too rare there for any run that it
   could join, so it splits the segment. Its parts are shorter, so more of their words are too rare; that goes on until
   nothing changes. Most prose falls to pieces shorter than MIN_LENGTH.
2. Lag scan of the segments that survive: stretches of words that equal the word q places on. Lags below DIRECT are
   compared everywhere. A lag in [2 g, 4 g) needs 2 g equal words in a row, which hold a block of g words that starts at
   a multiple of g; so only lags at which such a block is found again are compared, outwards from it.
3. A stretch counts if no q / r (r a prime divisor of q) is a period of it as well.

Texts are dealt by Spark as the scan gives them; nothing is shuffled, and a text takes memory in proportion to its length.

Edge cases: a null, empty or blank text has no words, so no runs and an empty collapsed text; rows that repeat an id
are each taken for themselves; an empty table gives an empty result; columns to be given back may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_LENGTH, DIRECT = 12, 8
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def numbers_of(words: list[bytes]) -> np.ndarray:
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(w, len(known)) for w in words), dtype=np.int64, count=len(words))


def surviving(ids: np.ndarray, min_length: int = MIN_LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the segments that splitting leaves, in order."""
    n = len(ids)
    before, after = np.full(n, -n - 1), np.full(n, 2 * n + 1)  # places of the next equal words
    order = np.argsort(ids, kind="stable")
    same = ids[order[1:]] == ids[order[:-1]]
    before[order[1:][same]], after[order[:-1][same]] = order[:-1][same], order[1:][same]
    lo, hi = np.array([0]), np.array([n])
    done: list[tuple[np.ndarray, np.ndarray]] = []
    while True:
        long = hi - lo >= min_length
        lo, hi = lo[long], hi[long]
        if not len(lo):
            break
        sizes = hi - lo
        of = np.repeat(np.arange(len(lo)), sizes)
        at = np.arange(len(of)) + np.repeat(lo - (np.cumsum(sizes) - sizes), sizes)
        half = sizes[of] // 2
        joins = (before[at] >= np.maximum(lo[of], at - half)) | (after[at] < np.minimum(hi[of], at + half + 1))
        whole = np.bincount(of, ~joins, len(lo)) == 0
        done.append((lo[whole], hi[whole]))
        left = at[joins & ~whole[of]]  # only segments that were split are looked at again
        edge = np.flatnonzero(np.diff(left) != 1)
        lo, hi = (left[np.append(0, edge + 1)], left[np.append(edge, len(left) - 1)] + 1) if len(left) else (left, left)
    lo, hi = (np.concatenate(x) for x in zip(*done, strict=True)) if done else (np.zeros(0, np.int64),) * 2
    order = np.argsort(lo)
    return lo[order], hi[order]


def primes_of(q: int) -> list[int]:
    out, r = [], 2
    while r * r <= q:
        if q % r == 0:
            out.append(r)
            while q % r == 0:
                q //= r
        r += 1
    return [*out, q] if q > 1 else out


def stretches(c: np.ndarray, q: int, min_length: int) -> Iterator[tuple[int, int, int]]:
    """Runs of period q at most, by comparing all words with those q places on."""
    equal = np.zeros(max(len(c) - q, 0) + 2, dtype=np.int8)
    equal[1:-1] = c[:-q] == c[q:]
    change = np.flatnonzero(np.diff(equal))
    starts, ends = change[::2], change[1::2] + q
    good = ends - starts >= max(min_length, 2 * q)
    yield from ((s, e - s, q) for s, e in zip(starts[good].tolist(), ends[good].tolist(), strict=True))


def reach(c: np.ndarray, at: int, q: int) -> tuple[int, int]:
    """The widest [start, end) around `at` in which words equal those q places on; steps double, so it costs what it finds."""
    lo, hi = at, at
    step = 64
    while hi < len(c) - q:
        equal = c[hi : min(hi + step, len(c) - q)] == c[hi + q : hi + q + step]
        n = len(equal) if equal.all() else int(equal.argmin())
        hi += n
        if n < len(equal):
            break
        step *= 2
    step = 64
    while lo > 0:
        equal = (c[max(lo - step, 0) : lo] == c[max(lo - step, 0) + q : lo + q])[::-1]
        n = len(equal) if equal.all() else int(equal.argmin())
        lo -= n
        if n < len(equal):
            break
        step *= 2
    return lo, hi


def found_again(c: np.ndarray, h: np.ndarray, g: int, found: list[tuple[int, int, int]]) -> np.ndarray:
    """(lag, start) of blocks of g words, h their hashes, that are there again 2 g to 4 g - 1 places on; in order.

    Lags that are multiples of the period of a known run around both places say nothing new.
    """
    _, rank, often = np.unique(h, return_inverse=True, return_counts=True)
    starts = np.arange(0, len(h), g)
    starts = starts[often[rank[starts]] > 1]
    if not len(starts):
        return np.zeros((0, 2), dtype=np.int64)
    places = np.sort(rank * (len(h) + 1) + np.arange(len(h)))
    base = rank[starts] * (len(h) + 1)
    first = np.searchsorted(places, base + np.minimum(starts + 2 * g, len(h)))
    last = np.searchsorted(places, base + np.minimum(starts + 4 * g, len(h)))
    n = last - first
    at = np.repeat(starts, n)
    lag = places[np.arange(n.sum()) + np.repeat(first - (np.cumsum(n) - n), n)] % (len(h) + 1) - at
    new = np.ones(len(at), dtype=bool)
    for s, length, p in found:
        if length >= 3 * g:
            i, j = np.searchsorted(at, (s, s + length))
            new[i:j] &= (at[i:j] + lag[i:j] + g > s + length) | (lag[i:j] % p != 0)
    pairs = np.stack([lag[new], at[new]], axis=1)
    return pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]


def runs_of(ids: np.ndarray, min_length: int = MIN_LENGTH) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a sequence of numbers of words, by start and period."""
    lo, hi = surviving(ids, min_length)
    if not len(lo):
        return []
    # The segments one after another, each followed by a number of its own that nothing equals.
    c = np.concatenate([x for i, (a, b) in enumerate(zip(lo.tolist(), hi.tolist(), strict=True)) for x in (ids[a:b], [-1 - i])])
    found = []

    def take(s: int, length: int, q: int) -> None:
        own = c[s : s + length]
        if not any((own[q // r :] == own[: -(q // r)]).all() for r in primes_of(q)):
            found.append((s, length, q))

    longest = int((hi - lo).max())
    for q in range(1, min(DIRECT, longest // 2 + 1)):
        for run in stretches(c, q, min_length):
            take(*run)
    g, h = 1, (c.astype(np.uint64) + np.uint64(1)) * _A
    while 4 * g <= longest:
        if g >= DIRECT // 2:
            known, end = -1, -1
            for q, at in found_again(c, h, g, list(found)).tolist():
                if q == known and at < end:
                    continue
                s, e = reach(c, at, q)
                known, end = q, e
                if e - s >= max(min_length - q, q):
                    take(s, e - s + q, q)
            if len(np.unique(h)) == len(h):  # no block is there twice, so no longer one is
                break
        if len(h) <= g:
            break
        h = (h[:-g] ^ (h[:-g] >> np.uint64(29))) * _A + (h[g:] ^ (h[g:] >> np.uint64(31))) * _B
        g *= 2
    offset = np.cumsum(np.append(0, hi - lo + 1))
    starts = np.array([s for s, _, _ in found], dtype=np.int64)
    of = np.searchsorted(offset, starts, side="right") - 1
    return sorted((int(s - offset[i] + lo[i]), length, q) for s, i, (_, length, q) in zip(starts, of, found, strict=True)) if found else []


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words, one space apart, without those that a run holds after its first period."""
    if not runs:
        return b" ".join(words)
    depth = np.zeros(len(words) + 1, dtype=np.int64)
    for s, length, q in runs:
        depth[s + q] += 1
        depth[s + length] -= 1
    return b" ".join(words[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0).tolist())


def detect(docs: DataFrame, text: str = "text", columns: tuple[str, ...] = ("doc_id",), min_length: int = MIN_LENGTH) -> DataFrame:
    """columns of each row of docs, with its runs, an array of (start, length, period) by start and period, and its collapsed_text."""
    own = [F.col(c).alias(f"own_{i}") for i, c in enumerate(columns)]
    rows = docs.select(F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8").alias("t"), *own)
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            runs, texts = [], []
            for t in b.column(0).to_pylist():
                words = t.split()
                found = runs_of(numbers_of(words), min_length) if len(words) >= min_length else []
                runs.append([{"start": s, "length": n, "period": q} for s, n, q in found])
                texts.append(collapsed(words, found))
            new = [pa.array(runs, run_type), pa.array(texts, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays([*new, *b.columns[1:]], names=["runs", "collapsed_text", *b.schema.names[1:]])

    kinds = ", ".join(f"own_{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(columns))
    out = rows.mapInArrow(run, f"runs array<struct<start:long,length:long,period:long>>, collapsed_text string, {kinds}")
    return out.select(*(F.col(f"own_{i}").alias(c) for i, c in enumerate(columns)), "runs", "collapsed_text")
