"""Toxicity by a subsequence string-kernel support vector machine with Nyström landmarks.

The kernel of two spans is the cosine of their gap-weighted counts of common subsequences of 3 and 4 characters,
each DECAY to the power of the length it stretches over, so characters that are left out or put in between weaken
a match and don't break it. The spans of a sentence are its tokens, folded to BASE symbols with marks for the two
ends, and pairs of neighbours of up to PIECE characters with the blank as a symbol, so that words broken in pieces are
seen whole; long tokens give overlapping windows, and single characters set apart by up to three separators are joined
to a span of their own. No other span runs over blanks, so a phrase of longer harmless words is not seen as one.

Training (on the driver, on a bounded sample of labelled documents): a sentence has its document's label, and a
sentence of a toxic document is represented by the span that looks most toxic, a multiple-instance choice that is
made anew after each round. Landmarks are frequent such spans and spans of clean sentences that come near them.
Spans become K(x, landmarks) K(landmarks)^-1/2, and a linear support vector machine (squared hinge) separates them.
The machine and the landmarks fold into one weight for each subsequence, so scoring costs a table look-up for each.

A text has the score of its most toxic span, as a probability fitted on the labels.
Edge cases: a null or empty text, or one without a span, has the score of the most harmless span; texts and tokens
of any length are scored whole; repeated rows get equal scores; without labels of both classes, or evidence in them, every score is 0;
an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import functools
import itertools
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airgrid.llm.common import bounded_sample

#: Labelled documents of each class that training reads at most; landmarks of each class; longest span.
MAX_DOCS, LANDMARKS, SPAN = 1000, 80, 18
DECAY, SIZES, GAPS = 0.6, (3, 4), (3, 2)
THRESHOLD = 0.3
#: Characters of neighbouring tokens that are seen as one span too, at most.
PIECE = 4
#: Spans whose scores a worker remembers at most.
REMEMBERED = 400_000
SENTENCE = re.compile(r"(?<=[.!?])\s+|\n")
#: Single letters with one to three separators between them.
SPACED = re.compile(r"(?<!\S)\w(?:[ ._*\-]{1,3}\w){2,}(?!\S)")
#: Spans that fewer toxic texts hold are no evidence; labels have errors.
SUPPORT = 3
#: Log likelihood ratio that a span needs, against chance among very many spans.
EVIDENCE = 9.0
ACCENTED = "éèêäöüßçñíóá"
BASE = 32 + len(ACCENTED)
CODES = BASE**4


@functools.lru_cache(maxsize=200_000)
def symbol(c: str) -> int:
    """1-26 letters, 27 and 28 the two ends, 29 other letters, 30 digits, 31 the rest, then ACCENTED; other accents are left off."""
    if c in ACCENTED:
        return 32 + ACCENTED.index(c)
    base = unicodedata.normalize("NFD", c.lower())[:1]
    if "a" <= base <= "z":
        return ord(base) - 96
    return 29 if base.isalpha() else 30 if base.isdigit() else 31


@functools.cache
def places(n: int) -> tuple[tuple[np.ndarray, np.ndarray], ...]:
    """For each subsequence size: the index tuples in a span of n symbols (end marks count), and their weights."""
    out = []
    for size, gap in zip(SIZES, GAPS, strict=True):
        rows = [(i, *(i + j for j in more)) for i in range(n) for more in itertools.combinations(range(1, min(size + gap, n - i)), size - 1)]
        at = np.array(rows, dtype=np.int64).reshape(-1, size)
        out.append((at, (DECAY ** (at[:, -1] - at[:, 0] + 1 - size)).astype(np.float32)))
    return tuple(out)


def coded(spans: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(positions in spans, codes, weights) of spans of one length, by length; codes has a row for each span."""
    by_length: dict[int, list[int]] = {}
    for i, s in enumerate(spans):
        by_length.setdefault(len(s), []).append(i)
    for n, own in sorted(by_length.items()):
        for k in range(0, len(own), 2000):
            part = own[k : k + 2000]
            sym = np.full((len(part), n + 2), 28, dtype=np.int32)
            sym[:, 0] = 27
            sym[:, 1:-1] = np.array([symbol(c) for i in part for c in spans[i]], dtype=np.int32).reshape(len(part), n)
            codes, weights = [], []
            for size, (at, w) in zip(SIZES, places(n + 2), strict=True):
                code = np.zeros((len(part), len(at)), dtype=np.int32)
                for j in range(size):
                    code = code * BASE + sym[:, at[:, j]]
                codes.append(code)
                weights.append(w)
            yield np.array(part), np.concatenate(codes, axis=1), np.concatenate(weights)


def norms(codes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Root of the kernel of each row with itself: weights of equal codes add up before they are squared."""
    order = np.argsort(codes, axis=1, kind="stable")
    sorted_codes = np.take_along_axis(codes, order, axis=1)
    w = weights[order]
    new = np.ones_like(sorted_codes, dtype=bool)
    new[:, 1:] = sorted_codes[:, 1:] != sorted_codes[:, :-1]
    starts = np.flatnonzero(new.ravel())
    sums = np.add.reduceat(w.ravel(), starts)
    out = np.bincount(starts // codes.shape[1], weights=sums * sums, minlength=len(codes))
    return np.sqrt(out)


def features(spans: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(codes, values) of each span, at length 1."""
    out: list = [None] * len(spans)
    for own, codes, weights in coded(spans):
        for i, row in zip(own, codes, strict=True):
            u, inverse = np.unique(row, return_inverse=True)
            v = np.bincount(inverse.ravel(), weights=weights)
            out[i] = (u, v / max(np.sqrt(v @ v), 1e-9))
    return out


def kernel(spans: list[str], landmarks: list[str]) -> np.ndarray:
    """A row for each span, a column for each landmark. Only subsequences of landmarks have a row in memory."""
    marks = features(landmarks)
    codes = np.unique(np.concatenate([u for u, _ in marks]))
    dense = np.zeros((len(codes) + 1, len(landmarks)), dtype=np.float32)  # the last row stands for all other codes
    for i, (u, v) in enumerate(marks):
        dense[np.searchsorted(codes, u), i] = v
    out = np.zeros((len(spans), len(landmarks)), dtype=np.float64)
    for k in range(0, len(spans), 1000):
        for i, (u, v) in enumerate(features(spans[k : k + 1000]), k):
            at = np.minimum(np.searchsorted(codes, u), len(codes) - 1)
            out[i] = v @ dense[np.where(codes[at] == u, at, len(codes))]
    return out


def spans_of(text: str) -> set[str]:
    """The tokens of a text, pairs of short neighbours in a sentence, letters that stand apart as one token, and windows of long tokens."""
    tokens: set[str] = set()
    for line in text.split("\n"):
        own = line.split()
        tokens.update(own)
        tokens.update([f"{a} {b}" for a, b in zip(own, own[1:], strict=False) if len(a) <= PIECE and len(b) <= PIECE and a[-1] not in ".!?"])
    if SPACED.search(text):
        tokens.update(re.sub(r"[\W_]", "", m) for m in SPACED.findall(text))
    long = [t for t in tokens if len(t) > SPAN]
    for t in long:
        tokens.discard(t)
        tokens.update(t[i : i + SPAN] for i in range(0, len(t) - SPAN // 2, SPAN // 2))
    return tokens


@dataclass
class Model:
    table: np.ndarray  # a weight for each code
    bias: float
    slope: float  # of the probability, over the score of a text
    shift: float
    known: dict[str, float] = field(default_factory=dict)  # scores of spans, for a while

    def raw(self, spans: list[str]) -> np.ndarray:
        out = np.zeros(len(spans), dtype=np.float64)
        for own, codes, weights in coded(spans):
            dot = self.table[codes] @ weights
            # Most spans can't score above the bias: their norms need no sorting.
            some = dot > 0
            out[own] = np.where(some, 0, np.minimum(dot, 0))
            if some.any():
                out[own[some]] = dot[some] / np.maximum(norms(codes[some], weights), 1e-9)
        return out + self.bias

    def probability(self, raw: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * raw + self.shift, -30, 30)))

    def scores(self, texts: list[str | None]) -> np.ndarray:
        floor = self.bias - 1
        each = [spans_of(t.lower()) if t else set() for t in texts]
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        new = list(set().union(*each).difference(known))
        known.update(zip(new, self.raw(new).tolist(), strict=True))
        return self.probability(np.array([max((known[s] for s in own), default=floor) for own in each], dtype=np.float64))


def folded(landmarks: list[str], alpha: np.ndarray) -> np.ndarray:
    """A weight for each subsequence: the machine alpha over kernels with landmarks, as one table."""
    table = np.zeros(CODES, dtype=np.float32)
    for a, (u, v) in zip(alpha, features(landmarks), strict=True):
        table[u] += (a * v).astype(np.float32)
    return table


def machine(x: np.ndarray, y: np.ndarray, weight: np.ndarray, cost: float = 20.0) -> tuple[np.ndarray, float]:
    """Linear support vector machine of squared hinge loss, by Newton steps; y is -1 or 1."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x1.shape[1])
    ridge = np.eye(x1.shape[1])
    ridge[-1, -1] = 1e-3
    for _ in range(30):
        inside = y * (x1 @ w) < 1
        a = x1[inside] * weight[inside, None]
        new = np.linalg.solve(ridge / cost + a.T @ x1[inside], a.T @ y[inside])
        if np.allclose(new, w, atol=1e-8):
            break
        w = new
    return w[:-1], float(w[-1])


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a probability over one score; slightly smoothed, so that separable labels stay finite."""
    t = np.where(y > 0, 1 - 1 / (2 + (y > 0).sum()), 1 / (2 + (y <= 0).sum()))
    a, b = 1.0, 0.0
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g = np.array([((p - t) * x).sum() + 1e-4 * a, (p - t).sum()])
        s = p * (1 - p) + 1e-9
        h = np.array([[(s * x * x).sum() + 1e-4, (s * x).sum()], [(s * x).sum(), s.sum()]])
        step = np.linalg.solve(h, g)
        a, b = a - np.clip(step[0], -5, 5), b - np.clip(step[1], -5, 5)
    return float(a), float(b)


def fit(texts: list[str], toxic: list[int], rounds: int = 3, landmarks: int = LANDMARKS) -> Model | None:
    """None unless there are texts of both classes and spans that tell them apart."""
    once = dict(zip((t.lower() for t in texts), toxic, strict=True))  # copies count once
    lower, toxic = list(once), list(once.values())
    docs = [spans_of(t) for t in lower]
    sentences = [[spans_of(s) for s in SENTENCE.split(t)] for t in lower]
    bad, good = [i for i, y in enumerate(toxic) if y == 1 and docs[i]], [i for i, y in enumerate(toxic) if y != 1 and docs[i]]
    if not bad or not good:
        return None
    in_bad, in_good = Counter(s for i in bad for s in docs[i]), Counter(s for i in good for s in docs[i])
    support = min(SUPPORT, 1 + len(bad) // 20)
    before: dict[str, set] = {}  # what stands before a span: near copies of a text repeat that too
    for i in bad:
        tokens = lower[i].split()
        for left, s in zip(["", *tokens], tokens, strict=False):
            before.setdefault(s, set()).add(left)
        for s in docs[i].difference(tokens):
            before.setdefault(s, set()).add(i)
    odds = {s: np.log((n + 0.1) / (len(bad) + 1)) - np.log((in_good[s] + 0.5) / (len(good) + 1)) + 0.01 * np.log1p(n) for s, n in in_bad.items() if n >= support and len(before[s]) >= support}
    p = len(bad) / (len(bad) + len(good))
    gain = lambda n, g: n * np.log(n / (n + g) / p) + (g * np.log(g / (n + g) / (1 - p)) if g else 0)
    odds = {s: o for s, o in odds.items() if o > np.log(2) and gain(in_bad[s], in_good[s]) > EVIDENCE}
    if not odds:
        return None
    clean = sorted(in_good, key=lambda s: (-in_good[s], s))
    rng = np.random.default_rng(6)
    witness = Counter(max(own, key=lambda s: (odds[s], s)) for i in bad if (own := docs[i] & odds.keys()))
    negatives = set(clean[:500]) | {clean[i] for i in rng.integers(0, len(clean), 3000)}
    model = None
    for turn in range(rounds):
        positives = sorted(witness, key=lambda s: (-witness[s], s))
        marks = positives[:landmarks]
        near = sorted(negatives - set(positives))
        if model is not None:
            raw = model.raw(near)
            near_marks = [near[i] for i in np.argsort(-raw, kind="stable")[:landmarks]]
        else:
            near_marks = [near[i] for i in rng.integers(0, len(near), landmarks)] if near else []
        marks = list(dict.fromkeys(marks + near_marks))
        own = kernel(marks, marks)
        values, vectors = np.linalg.eigh((own + own.T) / 2)
        root = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-3))) @ vectors.T
        x = kernel(positives + near, marks) @ root
        y = np.array([1.0] * len(positives) + [-1.0] * len(near))
        share = np.array([witness[s] for s in positives], dtype=float)
        weight = np.concatenate([np.sqrt(share) / np.sqrt(share).mean(), np.full(len(near), 1.0)])
        w, bias = machine(x, y, weight)
        alpha = root @ w
        model = Model(folded(marks, alpha), bias, 1.0, 0.0)
        spans = sorted(set(in_bad) | set(in_good))
        known = dict(zip(spans, model.raw(spans).tolist(), strict=True))
        if turn + 1 < rounds:
            # Each toxic text is seen through the sentence that scores highest; clean texts add what comes near.
            suspicion = {z: known[z] + 0.3 * o for z, o in odds.items()}
            witness = Counter()
            for i in bad:
                best = max(((suspicion[z], z) for s in sentences[i] for z in s if z in suspicion), default=None)
                if best:
                    witness[best[1]] += 1
            hard = sorted(in_good, key=lambda s: (-known[s], s))[:3000]
            negatives = set(hard) | negatives
    of_text = np.array([max((known[s] for s in d), default=model.bias - 1) for d in docs])
    model.slope, model.shift = logistic(of_text, np.array([1 if y == 1 else 0 for y in toxic]))
    return model


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", max_docs: int = MAX_DOCS) -> Model | None:
    """From at most max_docs documents of each class, chosen by a seeded hash: the bound of what reaches the driver.

    Rows that repeat an id are one document, with the larger label and the smallest text.
    """
    y = labels.where(F.col(label).isin(0, 1)).groupBy(key).agg(F.max(label).alias("__y"))
    chosen = bounded_sample(docs.select(key).join(y, key), "__y", max_docs, 6, key)
    near = docs.select(key, F.coalesce(F.col(text), F.lit("")).alias("__t")).join(F.broadcast(chosen), key)  # 2 * max_docs ids
    rows = near.groupBy(key).agg(F.min("__t").alias("__t"), F.min("__y").alias("__y")).orderBy(key).collect()
    return fit([r["__t"] for r in rows], [r["__y"] for r in rows])


def score(docs: DataFrame, model: Model | None, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """keep, score double and predicted int for each row of docs; a scan and no shuffle."""
    kept = docs.select(*keep, F.col(text).alias("__text"))
    small = None if model is None else (np.flatnonzero(model.table), model.table[np.flatnonzero(model.table)], model.bias, model.slope, model.shift)
    shared = docs.sparkSession.sparkContext.broadcast(small)  # at most a weight for each subsequence of the landmarks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None
        if shared.value is not None:
            at, values, *rest = shared.value
            table = np.zeros(CODES, dtype=np.float32)
            table[at] = values
            own = Model(table, *rest)
        for b in batches:
            texts = b.column(b.num_columns - 1).to_pylist()
            got = [own.scores(texts[i : i + 1000]) if own else np.zeros(len(texts[i : i + 1000])) for i in range(0, len(texts), 1000)]
            scores = np.concatenate(got) if got else np.zeros(0)
            new = [pa.array(scores), pa.array((scores >= THRESHOLD).astype("int32"))]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *new], names=[*b.schema.names[:-1], "score", "predicted"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1])
    return kept.mapInArrow(run, f"{schema}, score double, predicted int")
