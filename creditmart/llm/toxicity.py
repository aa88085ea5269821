"""Toxicity by a weighted finite-state pattern grammar.

Words become symbols: insult, threat, target, negation, reported speech, other. Five small
transducers read the symbols of a clause; their composition (a product automaton, compiled once to a
table) names the pattern of the clause: what was matched, whether at someone, negated, or reported.
A document's evidence is the strength of its matched clauses by pattern; a logistic model weighs it.

The insult lexicon starts from seeds and is learnt from labelled documents: words and word
beginnings that toxic texts have far more often than others, by a likelihood ratio that grows with the
number of candidates tried, one text of each group of near copies. Its terms, their strengths and
the pattern weights are all the labels are used for.

Fitting uses at most ``max_rows`` labelled documents outside the test fold (a parameter); the
lexicon has at most ``MAX_TERMS`` entries, so what is broadcast is bounded. Scoring runs over whole
texts in one pass without a shuffle. Defined cases: null, empty and blank texts have no clause and
get the model's base score; without labels the seeds alone decide; repeated rows score alike; extra
columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmart.llm.common import held_out, let, whole_text
from creditmart.llm.labelled import training_rows
from creditmart.sources.stage import stage

MAX_ROWS = 50_000
MAX_CANDIDATES = 200_000
MAX_TERMS = 8_192
PREFIXES = (4, 5, 6)
CACHE_SIZE = 400_000

# Seed words of each symbol, in English, German, French and Spanish.
INSULT, THREAT, TARGET, NEGATION, REPORT = range(1, 6)
SEEDS = {
    INSULT: "idiot moron stupid dumb pathetic worthless scum trash loser clown disgusting imbecile idiota dumm dummkopf abschaum stupide imbécile estúpido imbécil basura",
    THREAT: "kill hurt destroy punch beat strangle umbringen töten verprügeln tuer frapper détruire matar golpear destruir",
    TARGET: "you your yours they them he him she her these those people du dich dir ihr euch sie er tu toi vous ils elle lui tú usted ustedes ellos ella",
    NEGATION: "not never no don't doesn't isn't aren't wasn't without nicht kein keine nie niemals ne pas jamais sans nunca jamás sin",
    REPORT: "said says wrote writes called quoted claimed reported sagte schrieb behauptete dit écrit affirme dijo escribió afirmó",
}
CLAUSE_END = re.compile(r"[.!?;:,]\W*$")
EDGES = re.compile(r"^\W+|\W+$")


@dataclass(frozen=True)
class Transducer:
    """A state machine over symbols: from a state and a symbol to the next state; ``final`` reads the state at a clause's end."""

    start: int
    step: Callable[[int, int], int]
    final: Callable[[int], int]


def seen(symbol: int) -> Transducer:
    return Transducer(0, lambda state, s: 1 if s == symbol else state, lambda state: state)


def matched(symbol: int) -> Transducer:
    """0, 1, or 2 for several."""
    return Transducer(0, lambda state, s: min(2, state + (s == symbol)), lambda state: state)


def negated(reach: int) -> Transducer:
    """Whether a match lies within ``reach`` words after a negation. States: words left, then the verdict."""
    verdict = reach + 1

    def step(state: int, s: int) -> int:
        if state == verdict or state and s in (INSULT, THREAT):
            return verdict
        return reach if s == NEGATION else max(0, state - 1)

    return Transducer(0, step, lambda state: int(state == verdict))


def compose(parts: list[Transducer], symbols: int = 6) -> tuple[np.ndarray, list[tuple[int, ...]]]:
    """The product of the machines: a table [state, symbol] -> state, and each state's outputs. State 0 is the start."""
    states, todo = {tuple(p.start for p in parts): 0}, [tuple(p.start for p in parts)]
    rows = []
    for state in todo:
        row = []
        for s in range(symbols):
            after = tuple(p.step(x, s) for p, x in zip(parts, state, strict=True))
            if after not in states:
                states[after] = len(states)
                todo.append(after)
            row.append(states[after])
        rows.append(row)
    return np.array(rows), [tuple(p.final(x) for p, x in zip(parts, state, strict=True)) for state in todo]


TABLE, OUTPUTS = compose([matched(INSULT), matched(THREAT), seen(TARGET), negated(3), seen(REPORT)])
STEPS = TABLE.tolist()
#: (kind, at someone, negated, reported); kinds: one insult, several, a threat, both.
PATTERNS = list(product(range(4), range(2), range(2), range(2)))
NUMBER = {p: i for i, p in enumerate(PATTERNS)}


def pattern_of(output: tuple[int, ...]) -> int:
    insults, threats, target, negation, report = output
    kind = (3 if insults else 2) if threats else (1 if insults > 1 else 0)
    return NUMBER[kind, target, negation, report]


@dataclass
class Model:
    terms: dict[str, float] = field(default_factory=dict)  # insults: whole words, and beginnings marked by a final *
    weights: np.ndarray = field(default_factory=lambda: np.zeros(2 * len(PATTERNS) + 1))


def _core(word: str) -> str:
    return EDGES.sub("", word)


class _Lexicon(dict):
    """word as written (lower case) -> (symbol, strength, ends a clause), kept for a bounded number of words."""

    def __init__(self, terms: dict[str, float]):
        super().__init__()
        self.terms = terms
        self.seeds = {w: s for s, words in SEEDS.items() for w in words.split()}

    def __missing__(self, word: str) -> int:
        """Packed: clause end in bit 0, the symbol in bits 1-3, the strength in hundredths above."""
        core = _core(word)
        symbol = self.seeds.get(core, 0)
        strength = max([self.terms.get(core, 0.0), *(self.terms.get(core[:n] + "*", 0.0) for n in PREFIXES if len(core) > n)])
        if symbol in (INSULT, THREAT):
            strength = max(strength, 1.0)
        elif strength > 0:
            symbol = INSULT
        value = (int(strength * 100) << 4) + (symbol << 1) + bool(CLAUSE_END.search(word))
        if len(self) >= CACHE_SIZE:
            self.clear()
        if len(word) <= 64:
            self[word] = value
        return value


def evidence(text: str, lexicon: _Lexicon) -> np.ndarray:
    """By pattern: the clauses' summed strength, then their number, both damped."""
    found = np.zeros(2 * len(PATTERNS))
    for line in text.lower().split("\n"):
        codes = list(map(lexicon.__getitem__, line.split()))
        done = 0
        for i, code in enumerate(codes):
            if code < 16 or i < done:
                continue
            first = i
            while first > done and not codes[first - 1] & 1:
                first -= 1
            state, strength, done = 0, 0, first
            for code in codes[first:]:
                state, strength, done = STEPS[state][code >> 1 & 7], strength + (code >> 4), done + 1
                if code & 1:
                    break
            pattern = pattern_of(OUTPUTS[state])
            found[pattern] += strength / 100
            found[len(PATTERNS) + pattern] += 1
    return np.log1p(found)


def score(features: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(features @ weights[1:] + weights[0], -30, 30)))


def _terms_of(text: str) -> set[str]:
    words = {_core(w) for w in text.lower().split()}
    return {w for w in words if 0 < len(w) <= 40} | {w[:n] + "*" for n in PREFIXES for w in words if len(w) > n}


def term_counter(only: set[str] | None) -> Callable:
    """For mapInPandas over texts: in how many texts of a task each term is."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch["text"]:
                terms = _terms_of(text)
                counts.update(terms if only is None else terms & only)
            if len(counts) > 500_000:
                yield pd.DataFrame(list(counts.items()), columns=["term", "n"])
                counts = Counter()
        yield pd.DataFrame(list(counts.items()), columns=["term", "n"])

    return run


def gain(n1: float, n0: float, all1: float, all0: float) -> float:
    """Log-likelihood gained by giving a term's texts a toxicity rate of their own; 0 unless it is above the base rate."""
    rate, base = n1 / (n1 + n0), all1 / (all1 + all0)
    if rate <= base or base >= 1:
        return 0.0
    return n1 * math.log(rate / base) + (n0 * math.log((1 - rate) / (1 - base)) if n0 else 0.0)


def _near_copy_key(text: str) -> F.Column:
    """The smallest hash of five words: near copies mostly share it. Shorter texts: the hash of the text."""
    return let(F.split(F.lower(F.trim(F.col(text))), r"\s+"), lambda w: F.when(F.size(w) < 5, F.xxhash64(F.col(text))).otherwise(F.array_min(
        F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - 4, F.lit(1))), lambda i: F.xxhash64(F.slice(w, i, F.lit(5)))))))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_rows: int = MAX_ROWS) -> Model:
    spark = docs.sparkSession
    rows = training_rows(docs, labels, label, max_rows)
    rows = stage(rows.groupBy(_near_copy_key("text").alias("copy"), "label").agg(F.first("text").alias("text")).drop("copy"), "toxic-training")
    totals = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    model = Model()
    if totals.get(1, 0) and totals.get(0, 0):
        counted = rows.filter("label = 1").select("text").mapInPandas(term_counter(None), "term string, n long")
        often = counted.groupBy("term").agg(F.sum("n").alias("n")).filter("n >= 2")
        n1 = {r["term"]: r["n"] for r in often.orderBy(F.desc("n"), "term").limit(MAX_CANDIDATES).collect()}
        only = spark.sparkContext.broadcast(set(n1))
        counted = rows.filter("label = 0").select("text").mapInPandas(lambda batches: term_counter(only.value)(batches), "term string, n long")
        n0 = {r["term"]: r["n"] for r in counted.groupBy("term").agg(F.sum("n").alias("n")).collect()}
        needed = math.log(len(n1) + 1) + 2
        gains = {t: gain(n, n0.get(t, 0), totals[1], totals[0]) for t, n in n1.items()}
        good = sorted((t for t, g in gains.items() if g > needed and n1[t] > 4 * n0.get(t, 0) * totals[1] / totals[0]), key=lambda t: (-gains[t], t))
        model.terms = {t: math.log((n1[t] + 0.5) / (totals[1] + 1)) - math.log((n0.get(t, 0) + 0.5) / (totals[0] + 1)) for t in good[:MAX_TERMS]}
    terms = spark.sparkContext.broadcast(model.terms)

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lexicon = _Lexicon(terms.value)
        for batch in batches:
            yield pd.DataFrame({"label": batch["label"], "x": [evidence(t, lexicon).tolist() for t in batch["text"]]})

    data = rows.mapInPandas(measured, "label int, x array<double>").toPandas()
    model.weights = logistic(np.array(data["x"].tolist()).reshape(len(data), 2 * len(PATTERNS)), data["label"].to_numpy(float))
    return model


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Weights, bias first, by Newton steps towards a prior under which every unnegated, unreported match counts for toxic."""
    n = 2 * len(PATTERNS)
    prior = np.zeros(n + 1)
    prior[0] = -2.0
    prior[1 : len(PATTERNS) + 1] = [2.0 if not (p[2] or p[3]) else 0.5 for p in PATTERNS]
    weights, design = prior.copy(), np.hstack([np.ones((len(y), 1)), x.reshape(len(y), n)])
    keep = np.eye(n + 1) * ridge
    keep[0, 0] = 1e-3 if len(y) else 1.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(design @ weights, -30, 30)))
        slope = design.T @ (p - y) + keep @ (weights - prior)
        step = np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + keep, slope)
        weights -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return weights


def toxicity(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``."""
    shared = docs.sparkSession.sparkContext.broadcast((model.terms, model.weights))

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        terms, weights = shared.value
        lexicon = _Lexicon(terms)
        for batch in batches:
            features = np.array([evidence(t, lexicon) for t in batch["text"]]).reshape(len(batch), -1)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "held_out": batch["held_out"], "score": score(features, weights)})

    rows = docs.select(F.col(f"`{key}`").cast("string").alias("doc_id"), held_out(key).alias("held_out"), whole_text(text).alias("text"))
    found = rows.mapInPandas(scored, "doc_id string, held_out boolean, score double")
    return found.select(F.col("doc_id").cast("long").alias("doc_id"), "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
