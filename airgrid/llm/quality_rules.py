"""Quality rules as a short-circuit cascade, with DataFrame operations only.

Each rule is a Boolean column over a text and its signals. On a bounded sample every rule is timed, over the time of
an empty run, and its rejections are taken together with those of the others; the cascade asks next whichever rule
rejects most of what is left per cost, and stops at the first that rejects. A rule's signals are computed when it is
asked, so a text that a cheap rule rejects never has its word windows made (`survivors`). The order changes the
cost, never the verdict: a text is kept if no rule rejects it. `judge` gives all signals of all rows, so there only
the verdict is a cascade.

Edge cases: null counts as the empty text, which has no words and fails a base rule; words of any length and texts of
any length are taken whole; repeated rows and null ids get verdicts like others; an empty table gives an empty
result. `survivors` gives back the input's columns, whatever their names; `judge` leaves out input columns that are
named like one of its own.
"""

from __future__ import annotations

import math
import time
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airgrid.llm.common import WS_CHARS, WS_CLASS, cut

#: Fixed value: the characters that count as symbols.
SYMBOLS = "[#*$%&|<>]"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: Rows of the sample that costs and rejection rates are taken from, at most about; times that each row is there in a timed run, and runs of each rule.
SAMPLE_ROWS, COPIES, RUNS = 400, 5, 2
#: Shares of the dearest cost, and factors of gain, that are not told apart.
FLOOR, NOISE = 0.002, 1.5


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of value, which is computed once however often body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def spaced(t: Column) -> Column:
    """The words, one space apart."""
    return F.regexp_replace(F.btrim(t, F.lit(WS_CHARS)), WS_CLASS + "+", " ")


def count_of(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def duplicate_lines(t: Column) -> Column:
    lines = F.filter(F.split(t, "\n"), lambda x: F.length(F.btrim(x, F.lit(WS_CHARS))) > 0)
    return F.when(F.instr(t, "\n") > 0, let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))).otherwise(0).cast("long")


def repeated_words(norm: Column) -> Column:
    """Words in windows of three that stand in the text twice or more. Windows are compared as words; only texts with an equal pair sort theirs."""
    windows = F.regexp_extract_all(F.concat(F.lit(" "), norm), F.lit(r" (?=([^ ]++ [^ ]++ [^ ]++))"), F.lit(1))

    def covered(found: Column) -> Column:
        placed = F.sort_array(F.transform(found, lambda s, i: F.struct(s.alias("s"), i.alias("i"))))

        def twice(own: Column) -> Column:
            same = lambda x, j: F.coalesce(F.get(own, j)["s"] == x["s"], F.lit(False))
            return F.sort_array(F.transform(F.filter(own, lambda x, j: same(x, j - 1) | same(x, j + 1)), lambda x: x["i"]))

        # A window covers its three words, less those that the next such window covers too.
        words = lambda at: F.aggregate(F.transform(at, lambda p, j: F.least(F.lit(3), F.coalesce(F.get(at, j + 1) - p, F.lit(3)))), F.lit(0), lambda n, x: n + x)
        return let(let(placed, twice), words)

    return let(windows, lambda x: F.when(F.size(F.array_distinct(x)) < F.size(x), covered(x)).otherwise(0)).cast("long")


#: name -> signal, of the text and its spaced words. The first two are at hand in all rows that `prepared` gives.
SIGNALS: dict[str, Callable[[Column, Column], Column]] = {
    "n_words": lambda t, norm: F.col("q_words"),
    "word_chars": lambda t, norm: F.col("q_chars"),
    "n_symbols": lambda t, norm: count_of(norm, SYMBOLS).cast("long"),
    "n_dup_lines": lambda t, norm: duplicate_lines(t),
    "n_repeat_words": lambda t, norm: repeated_words(norm),
}

#: name -> reject?, of the text, its spaced words and its signals. All are ratios, in whole numbers, so that any engine
#: agrees on them. The first two are the base.
RULES: dict[str, Callable[[Column, Column, Mapping[str, Column]], Column]] = {
    "few_words": lambda t, norm, s: s["n_words"] < MIN_WORDS,
    "many_repeats": lambda t, norm, s: 100 * s["n_repeat_words"] > MAX_REPEAT_PERCENT * s["n_words"],
    "many_symbols": lambda t, norm, s: 10 * s["n_symbols"] > s["n_words"],
    "many_dup_lines": lambda t, norm, s: let(s["n_dup_lines"], lambda n: (n > 2) & (100 * n > 30 * (1 + F.length(t) - F.length(F.replace(t, F.lit("\n"), F.lit("")))))),
    "odd_word_length": lambda t, norm, s: (s["word_chars"] < 2 * s["n_words"]) | (s["word_chars"] > 16 * s["n_words"]),
    "many_bangs": lambda t, norm, s: 10 * count_of(norm, "[!?]") > s["n_words"],
    "many_capitals": lambda t, norm, s: 2 * count_of(norm, "[A-Z]+") > s["word_chars"],
    "many_digits": lambda t, norm, s: 4 * count_of(norm, "[0-9]+") > s["word_chars"],
    "few_letters": lambda t, norm, s: 2 * count_of(norm, r"\p{L}+") < s["word_chars"],
}
BASE = ("few_words", "many_repeats")


class Asked(Mapping):
    """Signals as expressions, so that one is computed where a rule asks for it."""

    def __init__(self, t: Column, norm: Column):
        self.t, self.norm = t, norm

    def __getitem__(self, name: str) -> Column:
        return SIGNALS[name](self.t, self.norm)

    def __iter__(self):
        return iter(SIGNALS)

    def __len__(self) -> int:
        return len(SIGNALS)


def prepared(docs: DataFrame, text: str, columns: list[str]) -> DataFrame:
    """columns as q_own_0, q_own_1 ..., with the text, its spaced words, their number and their characters.

    The generator keeps filters on these columns above it: pushed down, they would repeat the work for each use.
    """
    t = F.coalesce(F.col(text), F.lit(""))

    def row(norm: Column) -> Column:
        chars = F.length(F.replace(norm, F.lit(" "), F.lit(""))).cast("long")
        n = lambda c: F.when(c == 0, F.lit(0)).otherwise(F.length(norm) - c + 1).cast("long")
        return let(chars, lambda c: F.struct(t.alias("q_t"), norm.alias("q_norm"), n(c).alias("q_words"), c.alias("q_chars")))

    return docs.select(*(F.col(c).alias(f"q_own_{i}") for i, c in enumerate(columns)), F.inline(F.array(let(spaced(t), row))))


def seconds(rows: DataFrame) -> float:
    """Wall time of computing all rows once. Without a shuffle no run finds the work of an earlier one done."""
    began = time.perf_counter()
    rows.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def measure(docs: DataFrame, text: str = "text", rows: int = SAMPLE_ROWS, rules: dict[str, Callable] = RULES) -> tuple[dict[str, float], dict[int, int]]:
    """Seconds that asking each rule of the whole sample takes, and how many of its rows each set of rules rejects.

    A set is a number whose bits are the rules in their order. The sample, of about that many rows, lies in one partition,
    so that wall time is the rule's own, and there COPIES times, so that a run is more than its start. Of RUNS runs,
    after one that compiles, the shortest counts, less what a run takes that asks nothing.
    """
    n = max(1, docs.count())
    sample = prepared(docs.sample(fraction=min(1.0, rows / n), seed=4), text, [])
    sample = cut(sample.coalesce(1) if n <= rows else sample.repartition(1))
    many = cut(sample.withColumn("q_k", F.explode(F.sequence(F.lit(1), F.lit(COPIES)))))
    t, norm = F.col("q_t"), F.col("q_norm")
    asked = {"": F.col("q_words") < 0} | {name: rule(t, norm, Asked(t, norm)) for name, rule in rules.items()}
    asking = {name: many.select(reject.alias("r")) for name, reject in asked.items()}
    took = {name: min([seconds(df) for _ in range(RUNS + 1)][1:]) for name, df in asking.items()}
    bits = sum((F.when(asked[name], 1 << i).otherwise(0) for i, name in enumerate(rules)), F.lit(0))
    rejected = {r["bits"]: r["count"] for r in sample.select(bits.alias("bits")).groupBy("bits").count().collect()}  # 2^rules rows at most
    return {name: max(0.0, took[name] - took[""]) / COPIES for name in rules}, rejected


def order_of(cost: dict[str, float], rejected: dict[int, int]) -> list[str]:
    """Next is always the rule with most rejections, among rows that no earlier rule rejected, per cost; when none rejects any more, the cheapest.

    Costs below FLOOR of the dearest can't be told from nothing and count as that; rules within NOISE of the best are
    taken by name, so that the noise of the clock doesn't change the order.
    """
    floor = FLOOR * max([*cost.values(), 1e-9])
    price = {name: max(c, floor) for name, c in cost.items()}
    bit = {name: 1 << i for i, name in enumerate(cost)}
    out, left, rows = [], set(cost), dict(rejected)
    while left:
        gain = {k: sum(n for b, n in rows.items() if b & bit[k]) / price[k] for k in left}
        if not any(gain.values()):
            gain = {k: 1 / price[k] for k in left}
        name = min(k for k in left if gain[k] * NOISE >= max(gain.values()))
        out.append(name)
        left.remove(name)
        rows = {b: n for b, n in rows.items() if not b & bit[name]}
    return out


def verdict(order: list[str], t: Column, norm: Column, signals: Mapping[str, Column], rules: dict[str, Callable] = RULES) -> Column:
    """True if kept. CASE WHEN asks no rule after the first that rejects."""
    out = F
    for name in order:
        out = out.when(rules[name](t, norm, signals), F.lit(False))
    return out.otherwise(F.lit(True)) if order else F.lit(True)


def survivors(docs: DataFrame, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of docs that no rule rejects. One scan, after the sample's; signals are computed only where a rule asks for them."""
    order = order_of(*measure(docs, text, sample_rows))
    t, norm = F.col("q_t"), F.col("q_norm")
    rows = prepared(docs, text, docs.columns).where(verdict(order, t, norm, Asked(t, norm)))
    return rows.select(*(F.col(f"q_own_{i}").alias(c) for i, c in enumerate(docs.columns)))


def judge(docs: DataFrame, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """docs with the signals, base_failed and kept; no row is dropped. One scan, after the sample's."""
    order = order_of(*measure(docs, text, sample_rows))
    columns = [c for c in docs.columns if c not in (*SIGNALS, "base_failed", "kept")]
    t, norm = F.col("q_t"), F.col("q_norm")
    own = [f"q_own_{i}" for i in range(len(columns))]
    rows = prepared(docs, text, columns).select(*own, "q_t", "q_norm", "q_words", "q_chars", F.inline(F.array(F.struct(*(v(t, norm).alias(k) for k, v in SIGNALS.items())))))
    signals = {name: F.col(name) for name in SIGNALS}
    base = ~verdict([n for n in order if n in BASE], t, norm, signals)
    rows = rows.withColumn("base_failed", base)
    # The base's own part of the cascade is known by now.
    kept = F.when(F.col("base_failed"), F.lit(False)).otherwise(verdict([n for n in order if n not in BASE], t, norm, signals))
    return rows.select(*(F.col(o).alias(c) for o, c in zip(own, columns, strict=True)), *SIGNALS, "base_failed", kept.alias("kept"))
