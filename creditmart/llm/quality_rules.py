"""Quality rules as a learnt decision list, in DataFrame operations only.

Every text is measured once (counts of words, symbols, repeated lines and windows, and a few shares).
From labelled documents, sequential covering learns an ordered list of rules, each a conjunction of
thresholds on the measures: a rule is grown literal by literal by information gain on two thirds of
the rows not yet covered, then pruned from its end on the other third, and kept if it is precise there.
All it needs per step is one count of good and bad documents by measure and threshold band, made by
Spark over all labelled documents; only those counts reach the driver. The list becomes one Spark
CASE expression.

Base rules come first: too few words, or too large a share of words in repeated five-word windows.
Defined cases: null, empty and blank texts have no words and fail the base rules; without labels the list
is empty and the base rules alone decide; a null doc_id is kept as a row and never learnt from; repeated
rows are measured each; extra columns are not read by ``quality_rules``. Windows are compared by
64-bit hash within one text, so two different windows count as equal with a chance below 1e-10 a text.
A text's words are split, hashed and sorted inside its row: time grows as n log n with its length.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditmart.llm.common import WHITE, WHITE_RUN, held_out, let, whole_text, without
from creditmart.sources.stage import stage

SYMBOLS = "#*$%&|<>"
WINDOW = 5
FEATURES = {
    "n_words": "cast(n_words AS double)",
    "symbol_share": "n_symbols / n_words",
    "dup_line_share": "n_dup_lines / n_words",
    "repeat_share": "n_repeat_words / n_words",
    "word_length": "word_chars / n_words",
    "distinct_share": "n_distinct / n_words",
    "upper_share": "n_upper / n_words",
    "echo_share": "n_echo / n_words",
    "mark_share": "n_marks / n_words",
}
PERCENTS = (0, 2, 5, 10, 20, 30, 40, 50, 60, 70, 80, 90, 95, 98, 100)


@dataclass(frozen=True)
class Learning:
    """Parameters of sequential covering."""

    max_rules: int = 8
    max_literals: int = 3
    min_covered: int = 5
    min_precision: float = 0.8
    seed: int = 11


@dataclass(frozen=True)
class Literal:
    feature: str
    below: bool
    threshold: float

    def sql(self) -> str:
        return f"{self.feature} {'<' if self.below else '>='} {self.threshold!r}D"


Rule = tuple[Literal, ...]


def _covered(grams: Column) -> Column:
    """Words in windows whose hash occurs twice or more; ``grams`` are the hashes by position."""

    def starts(pairs: Column) -> Column:
        def own(k: Column) -> Column:
            h = F.get(pairs, k)["h"]
            return (h == F.get(pairs, k - 1)["h"]) | (h == F.get(pairs, k + 1)["h"])

        every = F.sequence(F.lit(0), F.size(pairs) - 1)
        return F.sort_array(F.transform(F.filter(every, lambda k: F.coalesce(own(k), F.lit(False))), lambda k: F.get(pairs, k)["i"]))

    pairs = F.sort_array(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return let(let(pairs, starts), lambda s: F.aggregate(
        F.sequence(F.lit(0), F.size(s) - 1), F.lit(0).cast("long"),
        lambda total, k: total + F.least(F.lit(WINDOW), F.coalesce(F.get(s, k + 1) - F.get(s, k), F.lit(WINDOW)))))


def _repeat_words(words: Column) -> Column:
    grams = F.transform(F.sequence(F.lit(0), F.size(words) - WINDOW), lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(WINDOW))))
    counted = let(grams, lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0).cast("long")).otherwise(_covered(g)))
    return F.when(F.size(words) <= WINDOW, F.lit(0).cast("long")).otherwise(counted)


def _of_words(words: Column) -> Column:
    n = F.size(words)
    echo = F.when(n < 2, F.lit(0)).otherwise(F.size(F.filter(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.get(words, i) == F.get(words, i - 1))))
    return F.struct(
        n.cast("long").alias("n_words"), _repeat_words(words).alias("n_repeat_words"), F.size(F.array_distinct(words)).cast("long").alias("n_distinct"),
        F.size(F.filter(words, lambda w: (w == F.upper(w)) & (w != F.lower(w)))).cast("long").alias("n_upper"), echo.cast("long").alias("n_echo"),
    )


def measures(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id`` and the counts that the rules use."""
    own = whole_text(text)
    words = F.filter(F.split(own, WHITE_RUN), lambda w: w != "")
    lines = F.filter(F.split(own, "\n"), lambda x: F.length(without(x, WHITE)) > 0)
    length = F.char_length(own)
    return docs.select(
        F.col(f"`{key}`").alias("doc_id"),
        F.char_length(without(own, WHITE)).cast("long").alias("word_chars"),
        (length - F.char_length(without(own, SYMBOLS))).cast("long").alias("n_symbols"),
        (length - F.char_length(without(own, "!?"))).cast("long").alias("n_marks"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        let(words, _of_words).alias("w"),
    ).select("*", "w.*").drop("w")


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def _with_features(measured: DataFrame) -> DataFrame:
    return measured.select("*", *(F.expr(f"coalesce(try_divide({e.split(' / ')[0]}, {e.split(' / ')[1]}), 0D)" if " / " in e else e).alias(f"f_{n}") for n, e in FEATURES.items()))


def learn(measured: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id", how: Learning = Learning()) -> list[Rule]:
    """Rules that reject, in order. Labels of the test fold, null labels and documents that fail the base rules are not used."""
    known = labels.filter(F.col(f"`{label}`").isNotNull() & ~held_out(key)).groupBy(F.col(f"`{key}`").alias("label_key")).agg((F.avg(F.col(f"`{label}`").cast("double")) < 0.5).alias("bad"))
    rows = _with_features(measured.filter(~base_failed())).join(known, F.col("doc_id") == F.col("label_key"))
    names = list(FEATURES)
    rows = stage(rows.select("bad", (F.pmod(F.xxhash64("doc_id", F.lit(how.seed)), F.lit(3)) > 0).alias("grow"), *(f"f_{n}" for n in names)), "rule-rows")
    percents = F.array(*(F.lit(p / 100) for p in PERCENTS))
    marks = rows.groupBy("bad").agg(*(F.percentile_approx(f"f_{n}", percents, 10_000).alias(n) for n in names)).collect()
    thresholds = {n: sorted({v for r in marks for v in r[n]}) for n in names}
    # The band of a value: how many thresholds it has reached.
    band = lambda n: F.size(F.filter(F.array(*(F.lit(v) for v in thresholds[n])), lambda t: t <= F.col(f"f_{n}")))
    if len(marks) < 2:
        return []
    rows = stage(rows.select("bad", "grow", F.array(*(band(n) for n in names)).alias("bands")), "rule-bands")

    def holds(literals: list[tuple[int, bool, int]]) -> Column:
        test = F.lit(True)
        for f, below, b in literals:
            test = test & ((F.col("bands")[f] < b) if below else (F.col("bands")[f] >= b))
        return test

    rules: list[list[tuple[int, bool, int]]] = []
    left = rows
    while len(rules) < how.max_rules:
        rule = _grow(left, holds, how, thresholds, names)
        rule = _prune(left, holds, rule, how)
        if not rule:
            break
        rules.append(rule)
        left = left.filter(~holds(rule))
    return [tuple(Literal(names[f], below, thresholds[names[f]][b - 1]) for f, below, b in rule) for rule in rules]


def _grow(left: DataFrame, holds, how: Learning, thresholds: dict, names: list[str]) -> list:
    rule: list[tuple[int, bool, int]] = []
    while len(rule) < how.max_literals:
        counts = (
            left.filter(F.col("grow") & holds(rule)).select("bad", F.posexplode("bands").alias("f", "band"))
            .groupBy("f", "band").agg(F.count_if("bad").alias("bad"), F.count_if(~F.col("bad")).alias("good")).collect()
        )
        bad, good = (sum(r[k] for r in counts if r["f"] == 0) for k in ("bad", "good"))
        if not bad or not good and rule:
            break
        best, choice = 0.0, None
        for f, name in enumerate(names):
            for b in range(1, len(thresholds[name]) + 1):
                above_bad, above_good = (sum(r[k] for r in counts if r["f"] == f and r["band"] >= b) for k in ("bad", "good"))
                for below, p, n in ((False, above_bad, above_good), (True, bad - above_bad, good - above_good)):
                    if p >= how.min_covered:
                        won = p * (math.log2(p / (p + n)) - math.log2(bad / (bad + good)))
                        if won > best + 1e-9:
                            best, choice = won, (f, below, b)
        if choice is None:
            break
        rule.append(choice)
    return rule


def _prune(left: DataFrame, holds, rule: list, how: Learning) -> list:
    """The beginning of the rule that is best on the pruning rows; empty if none is precise enough."""
    if not rule:
        return []
    starts = [rule[: i + 1] for i in range(len(rule))]
    r = left.filter(~F.col("grow")).agg(*(F.count_if(holds(s) & (F.col("bad") if k == "bad" else ~F.col("bad"))).alias(f"{k}{i}") for i, s in enumerate(starts) for k in ("bad", "good"))).first()
    worth = [(r[f"bad{i}"] - r[f"good{i}"]) / (r[f"bad{i}"] + r[f"good{i}"]) if r[f"bad{i}"] + r[f"good{i}"] else -1.0 for i in range(len(starts))]
    i = max(range(len(starts)), key=lambda i: worth[i])
    return starts[i] if (1 + worth[i]) / 2 >= how.min_precision else []


def verdict(rules: list[Rule]) -> Column:
    """The number of the first rule that rejects a row, from 1; 0 where none does. Reads the measures."""
    if not rules:
        return F.lit(0)
    cases = " ".join(f"WHEN {' AND '.join('f_' + x.sql() for x in rule)} THEN {i}" for i, rule in enumerate(rules, 1))
    return F.expr(f"CASE {cases} ELSE 0 END")


def judge(measured: DataFrame, rules: list[Rule]) -> DataFrame:
    """``doc_id, n_words``, the four counts, ``base_failed, kept``, and the ``rule`` that rejected (0: none)."""
    return _with_features(measured).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base_failed().alias("base_failed"),
        (~base_failed() & (verdict(rules) == 0)).alias("kept"), verdict(rules).alias("rule"),
    )


def quality_rules(docs: DataFrame, labels: DataFrame, how: Learning = Learning()) -> DataFrame:
    measured = stage(measures(docs), "rule-measures")
    return judge(measured, learn(measured, labels, how=how))
