"""Periodic runs of words by grammar compression.

A run is a stretch of words with smallest period q, at least ``max(SHORTEST, POWER * q)`` words long, that
cannot be extended on either side. Documents are worked through in batches; a document's words are numbered
for itself, so each has a grammar of its own although numpy builds those of a batch together.

1. Re-Pair: pairs of neighbouring symbols that occur twice or more in a document become nonterminals,
   the most frequent first, until no pair is repeated. Pairs that do not overlap in the text are replaced in the same round.
2. Every nonterminal X = A B has one boundary, between A and B, looked at once, in X's first occurrence; the
   symbols left at the end have a boundary between any two. A run crosses the boundary of the smallest
   node that holds it. It has 2q words on one side at least, so a square starts or ends there: two
   equal neighbouring stretches of q words. Squares are found by names for the stretches of 1, 2, 4, 8, ...
   words (a name is a pair of names of half the length, so equal names are equal words), of which only
   repeated ones are carried on. Extending a square to both sides inside X gives its run.
3. What X's boundary has is carried to all places of X in the derivation. Runs cut off at the
   border of X lie in the whole run, which a larger node's boundary found: the maximal intervals of
   each period stay. A multiple of a run's period has the same interval and goes.

Long repetitive stretches have few boundaries, because they are compressed; the words of ordinary
prose are hardly ever repeated at a matching distance. Work is near n log n for n words either way.

Defined cases: null, empty and blank texts have no words and no runs; repeated rows are answered
each; a null id is never altered by ``alter``; extra columns are not read; an empty table gives an
empty result. A task holds one batch of words, and so the longest document (about 300 bytes a word).
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmart.llm.common import whole_text

SHORTEST, POWER = 6, 4
BATCH_WORDS = 1 << 17


def _rank(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stable order of the keys, and a number for each key such that equal keys have equal ones."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    number = np.empty(len(keys), np.int64)
    number[order] = np.cumsum(np.r_[True, ordered[1:] != ordered[:-1]]) - 1 if len(keys) else 0
    return order, number


class Grammar:
    """Re-Pair of a batch of word numbers in which every document ends with a number of its own.

    Rule i, of symbol ``words + i``, has the symbols ``left[i], right[i]``; ``rounds`` has the numbers of the first
    rule of each round, ``size`` the words of each symbol. ``symbols`` are left in the end, ``at`` has their first words.
    """

    def __init__(self, words: np.ndarray):
        self.words = int(words.max()) + 1 if len(words) else 0
        self.symbols, self.at = words.astype(np.int64), np.arange(len(words))
        self.left, self.right, self.rounds = np.zeros(0, np.int64), np.zeros(0, np.int64), []
        self.size = np.ones(self.words, np.int64)
        live = np.ones(max(0, len(words) - 1), bool)  # a pair that is not repeated never will be
        while live.any():
            live = self._round(live)

    def _round(self, live: np.ndarray) -> np.ndarray:
        at = np.flatnonzero(live)
        a, b = self.symbols[at], self.symbols[at + 1]
        pair = _rank(a * len(self.size) + b)[1]
        # In a stretch of one symbol its pair counts at every other place.
        same = a == b
        first = np.r_[True, (np.diff(at) != 1) | ~same[:-1] | ~same[1:]]
        odd = same & ((np.arange(len(at)) - np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))) % 2 == 1)
        count = np.bincount(pair[~odd], minlength=len(at))
        repeated = count[pair] > 1
        # A place is taken if its pair is more frequent than those it overlaps with.
        rank = np.empty(len(count), np.int64)
        rank[np.argsort(count, kind="stable")] = np.arange(1, len(count) + 1)
        ranks = np.zeros(len(live) + 2, np.int64)
        can = repeated & ~odd
        ranks[at[can] + 1] = rank[pair[can]]
        taken = can & (ranks[at + 1] > ranks[at]) & (ranks[at + 1] > ranks[at + 2])
        taken &= np.bincount(pair[taken], minlength=len(count))[pair] > 1
        live = np.zeros(len(self.symbols), bool)
        live[at[repeated]] = True
        if taken.any():
            places = at[taken]
            _, one, rule = np.unique(pair[taken], return_index=True, return_inverse=True)
            left, right = self.symbols[places[one]], self.symbols[places[one] + 1]
            self.symbols[places] = rule + len(self.size)
            self.rounds.append(len(self.left))
            self.left, self.right = np.r_[self.left, left], np.r_[self.right, right]
            self.size = np.r_[self.size, self.size[left] + self.size[right]]
            live[places] = True
            live[places[places > 0] - 1] = True
            stays = np.ones(len(self.symbols), bool)
            stays[places + 1] = False
            self.symbols, self.at, live = self.symbols[stays], self.at[stays], live[stays]
        return live[:-1]

    def levels(self) -> Iterator[np.ndarray]:
        """The rules by rounds, parents first."""
        high = len(self.left)
        for low in reversed(self.rounds):
            yield np.arange(low, high)
            high = low

    def places(self) -> np.ndarray:
        """The first word of one occurrence of each symbol."""
        place = np.full(len(self.size), -1, np.int64)
        place[self.symbols] = self.at
        for rules in self.levels():
            start, left, right = place[rules + self.words], self.left[rules], self.right[rules]
            place[right] = np.where(place[right] < 0, start + self.size[left], place[right])
            place[left] = np.where(place[left] < 0, start, place[left])
        return place

    def occurrences(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(symbol, first word) of all places of the wanted symbols (a mask) in the derivation."""
        inside = wanted.copy()
        for rules in reversed(list(self.levels())):
            inside[rules + self.words] |= inside[self.left[rules]] | inside[self.right[rules]]
        held = inside[self.symbols]
        symbols, at = [self.symbols[held]], [self.at[held]]
        for rules in self.levels():
            s, p = np.concatenate(symbols), np.concatenate(at)
            mine = (s >= rules[0] + self.words) & (s <= rules[-1] + self.words)
            left, right = self.left[s[mine] - self.words], self.right[s[mine] - self.words]
            symbols, at = [s, left[inside[left]], right[inside[right]]], [p, p[mine][inside[left]], (p[mine] + self.size[left])[inside[right]]]
        s, p = np.concatenate(symbols), np.concatenate(at)
        return s[wanted[s]], p[wanted[s]]


def _spread(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which, number) of every number in the ranges first[i] <= number < last[i]."""
    n = np.maximum(0, last - first)
    which = np.repeat(np.arange(len(n)), n)
    return which, np.arange(len(which)) - (np.cumsum(n) - n)[which] + first[which]


def _reach(words: np.ndarray, i: np.ndarray, j: np.ndarray, step: int) -> np.ndarray:
    """How many words agree from i and from j (i < j) on, going by step 1 or -1, up to the end of a document."""
    found, open_ = np.zeros(len(i), np.int64), np.arange(len(i))
    offsets = np.arange(64)
    while len(open_):
        a, b = ((x[open_] + step * found[open_])[:, None] + step * offsets for x in (i, j))
        equal = (words[np.clip(a, 0, len(words) - 1)] == words[np.clip(b, 0, len(words) - 1)]) & (a >= 0) & (b < len(words))
        whole = equal.all(axis=1)
        found[open_] += np.where(whole, 64, np.argmin(equal, axis=1))
        open_ = open_[whole]
    return found


def crossing(words: np.ndarray, low: np.ndarray, cut: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Rows (boundary, begin, end, period): the runs across each boundary ``cut``, as far as they lie in ``low .. high``."""
    n = len(words)
    found = np.zeros((0, 4), np.int64)
    places, names, k = np.arange(n), words.astype(np.int64), 1
    while len(places):  # names of k words find the periods k to 2k - 1
        order, names = _rank(names)
        repeated = np.bincount(names)[names] > 1
        full = np.full(n, -1, np.int64)
        full[places[repeated]] = names[repeated]
        order = order[repeated[order]]
        keys = names[order] * n + places[order]
        squares = [_squares(full, keys, low, cut, high, k, right) for right in (True, False)]
        found = np.concatenate([found, _extended(words, np.concatenate(squares), found, low, high)])
        places = places[repeated]
        places = places[places + k < n]
        second = full[places + k]
        places, second = places[second >= 0], second[second >= 0]
        names = full[places] * (full.max() + 1) + second
        k *= 2
    return found[found[:, 2] - found[:, 1] >= np.maximum(SHORTEST, POWER * found[:, 3])]


def _squares(full: np.ndarray, keys: np.ndarray, low: np.ndarray, cut: np.ndarray, high: np.ndarray, k: int, right: bool) -> np.ndarray:
    """Rows (boundary, begin, period) of the squares that start (or end) at a boundary, for periods k to 2k - 1.

    ``full`` names the k words from each place, -1 where they are not repeated; ``keys`` are the sorted (name, place).
    """
    n = len(full)
    start = cut if right else cut - k
    longest = np.minimum(2 * k - 1, (high - cut if right else cut - low) // 2)
    mine = np.flatnonzero(longest >= k)
    mine = mine[full[start[mine]] >= 0]
    at, longest = start[mine], longest[mine]
    near, far = (at + k, at + longest + 1) if right else (at - longest, at - k + 1)
    near, far = (np.searchsorted(keys, full[at] * n + x) for x in (near, far))
    which, number = _spread(near, far)
    which, other = mine[which], keys[number] % n
    q, c = np.abs(other - start[which]), cut[which]
    # One end of the two stretches has equal names; with the other end's too, all their q words agree.
    one, two = (c + q - k, c + 2 * q - k) if right else (c - 2 * q, c - q)
    equal = (full[one] == full[two]) & (full[one] >= 0)
    return np.stack([which, c if right else c - 2 * q, q], axis=1)[equal]


def _extended(words: np.ndarray, squares: np.ndarray, known: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """(boundary, begin, end, period) of squares (boundary, begin, period), but for those within a known run of which their period is a multiple."""
    known = known[np.argsort(known[:, 0], kind="stable")]
    near, far = (np.searchsorted(known[:, 0], squares[:, 0], side) for side in ("left", "right"))
    which, number = _spread(near, far)
    of, by = squares[which], known[number]
    explained = (of[:, 2] % by[:, 3] == 0) & (by[:, 1] <= of[:, 1]) & (by[:, 2] >= of[:, 1] + 2 * of[:, 2])
    boundary, begin, q = squares[np.bincount(which[explained], minlength=len(squares)) == 0].T
    end = begin + 2 * q + _reach(words, begin + q, begin + 2 * q, 1)
    begin = begin - _reach(words, begin - 1, begin - 1 + q, -1)
    return np.unique(np.stack([boundary, np.maximum(begin, low[boundary]), np.minimum(end, high[boundary]), q], axis=1), axis=0)


def maximal(runs: np.ndarray) -> np.ndarray:
    """Of rows (begin, end, period): those within no other of the same period, and of equal intervals the smallest period; by begin, then period."""
    runs = runs[np.lexsort((-runs[:, 1], runs[:, 0], runs[:, 2]))]
    if not len(runs):
        return runs
    # Ends as they come, raised from period to period, so that one running maximum serves all.
    raised = runs[:, 1] + np.cumsum(np.r_[0, np.diff(runs[:, 2]) > 0]) * (runs[:, 1].max() + 1)
    runs = runs[np.r_[True, raised[1:] > np.maximum.accumulate(raised)[:-1]]]
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    runs = runs[np.r_[True, (np.diff(runs[:, :2], axis=0) != 0).any(axis=1)]]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def runs_of(documents: list[list]) -> list[list[tuple[int, int, int]]]:
    """For each list of words its runs (start, length, period), by start, then period."""
    numbers, starts, total, used = [], [], 0, 0
    for words in documents:
        number = {w: used + i for i, w in enumerate(dict.fromkeys(words))}
        numbers.append(np.fromiter(map(number.__getitem__, words), np.int64, len(words)))
        numbers.append(np.array([used + len(number)]))  # ends the document
        starts.append(total)
        used += len(number) + 1
        total += len(words) + 1
    out: list[list[tuple[int, int, int]]] = [[] for _ in documents]
    if not documents:
        return out
    words, starts = np.concatenate(numbers), np.array(starts)
    ends = np.r_[starts[1:], total] - 1
    grammar = Grammar(words)

    first = grammar.places()
    rule = np.flatnonzero(grammar.size[grammar.words :] >= SHORTEST)
    low = first[rule + grammar.words]
    cut, high = low + grammar.size[grammar.left[rule]], low + grammar.size[rule + grammar.words]
    of = np.searchsorted(starts, grammar.at, "right") - 1
    between = np.flatnonzero((np.r_[-1, of[:-1]] == of) & (grammar.at < ends[of]) & (ends[of] - starts[of] >= SHORTEST))
    at = grammar.at[between]
    found = crossing(words, np.r_[low, starts[of[between]]], np.r_[cut, at], np.r_[high, ends[of[between]]])
    top = found[:, 0] >= len(rule)
    inner = found[~top]
    inner = np.c_[rule[inner[:, 0]] + grammar.words, inner[:, 1:3] - low[inner[:, 0], None], inner[:, 3]]
    inner = inner[np.argsort(inner[:, 0], kind="stable")]
    wanted = np.zeros(len(grammar.size), bool)
    wanted[inner[:, 0]] = True
    symbol, place = grammar.occurrences(wanted)
    which, number = _spread(np.searchsorted(inner[:, 0], symbol, "left"), np.searchsorted(inner[:, 0], symbol, "right"))
    carried = np.c_[inner[number, 1:3] + place[which, None], inner[number, 3]]
    runs = maximal(np.concatenate([found[top, 1:], carried]))
    for document, (begin, end, q) in zip(np.searchsorted(starts, runs[:, 0], "right") - 1, runs.tolist(), strict=True):
        out[document].append((begin - int(starts[document]), end - begin, q))
    return out


def altered(words: list, doc_id: str | None) -> list:
    """The words with a repetition planted in one document of ten, by the CRC-32 of the id."""
    h, n = (0, 0) if doc_id is None else (zlib.crc32(doc_id.encode()), len(words))
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * ((n - a) // p + 1))[: n - a]


def summary(words: list, runs: list[tuple[int, int, int]]) -> tuple:
    """``n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256``."""
    best, dropped = None, np.zeros(len(words) + 1, np.int64)
    for run in runs:
        start, length, q = run
        if best is None or length * best[2] > best[1] * q:
            best = run
        dropped[start + q] += 1
        dropped[start + length] -= 1
    text = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = [words[i] for i in np.flatnonzero(np.cumsum(dropped)[:-1] == 0)] if runs else words
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (len(runs), *top, hashlib.sha256(text.encode()).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest())


FIELDS = ["n_runs", "start", "length", "period", "exponent_milli"]


def finder(planted: bool, batch_words: int) -> Callable:
    """For mapInPandas over (doc_id, text as bytes)."""

    def rows(held: list[tuple[str | None, list]]) -> pd.DataFrame:
        made = [(i, *summary(w, r)) for (i, w), r in zip(held, runs_of([w for _, w in held]), strict=True)]
        found = pd.DataFrame(made, columns=["doc_id", *FIELDS, "runs_sha256", "collapsed_sha256"])
        return found.astype({"doc_id": object} | dict.fromkeys(FIELDS, "Int64"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                words = text.split()  # of bytes: at the six ASCII white space characters
                held.append((doc_id, altered(words, doc_id) if planted else words))
                size += len(words) + 1
                if size >= batch_words:
                    yield rows(held)
                    held, size = [], 0
        yield rows(held)

    return run


def periodic_runs(docs: DataFrame, planted: bool = False, key: str = "doc_id", text: str = "text", batch_words: int = BATCH_WORDS) -> DataFrame:
    """One row per document: ``doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256``.

    The run shown has the greatest length / period, then the smallest start, then the smallest period. ``collapsed_sha256``
    is of the words that are left when each run keeps its first period only, joined by single spaces.
    ``planted`` gives one document in ten a repetition first (``altered``).
    """
    rows = docs.select(F.col(f"`{key}`").cast("string").alias("doc_id"), whole_text(text).cast("binary").alias("text"))
    schema = "doc_id string, " + ", ".join(f"{f} long" for f in FIELDS) + ", runs_sha256 string, collapsed_sha256 string"
    found = rows.mapInPandas(finder(planted, batch_words), schema)
    return found.withColumn("doc_id", F.col("doc_id").cast(docs.schema[key].dataType))
