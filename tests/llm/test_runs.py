"""op13 against a look at every period of every document."""

from __future__ import annotations

import hashlib
import random
import sys
import zlib
from fractions import Fraction
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))

import cases  # noqa: E402
from conftest import SMALL  # noqa: E402

from creditmart.llm import queries, runs  # noqa: E402


def plain_runs(words: list) -> list[tuple]:
    found = []
    for q in range(1, len(words) // 4 + 1):
        same = [words[i] == words[i + q] for i in range(len(words) - q)] + [False]
        start = None
        for i, equal in enumerate(same):
            if equal and start is None:
                start = i
            if not equal and start is not None:
                length = i + q - start
                part = words[start : start + length]
                if length >= max(6, 4 * q) and not any(all(part[k] == part[k + r] for k in range(length - r)) for r in range(1, q)):
                    found.append((start, length, q))
                start = None
    return sorted(found, key=lambda r: (r[0], r[2]))


def answer(doc_id, text: str | None) -> tuple:
    """op13 of one document."""
    words = cases.words_of(text)
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = plain_runs(words)
    dropped = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    code = lambda s: hashlib.sha256(s.encode()).hexdigest()
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(found), *top, code("".join(f"{s},{length},{q}\n" for s, length, q in found)), code(" ".join(w for i, w in enumerate(words) if i not in dropped)))


@pytest.mark.parametrize("seed", range(4))
def test_runs_of_repetitive_words(seed):
    pick = random.Random(seed)
    for _ in range(60):
        documents = []
        for _ in range(pick.randint(0, 10)):
            words = [pick.randrange(pick.choice([1, 2, 3, 30])) for _ in range(pick.randint(0, pick.choice([8, 40, 120])))]
            for _ in range(pick.randint(0, 3) if words else 0):
                a = pick.randrange(len(words))
                p = 1 + pick.randrange(max(1, (len(words) - a) // 3 + 1))
                words = (words[:a] + (words[a : a + p] * 99)[: pick.randint(1, 120)] + words[a : a + 3])[:300]
            documents.append(words)
        assert runs.runs_of(documents) == [plain_runs(w) for w in documents]


def test_grammar_gives_back_its_words():
    pick = random.Random(1)
    words = np.array([pick.randrange(3) for _ in range(500)] + [3] + [4, 5] * 40 + [6])
    grammar = runs.Grammar(words)

    def expand(symbol: int) -> list[int]:
        rule = symbol - grammar.words
        return [symbol] if rule < 0 else expand(grammar.left[rule]) + expand(grammar.right[rule])

    parts = [expand(s) for s in grammar.symbols]
    assert sum(parts, []) == words.tolist() and len(grammar.symbols) < 250
    assert np.cumsum([0, *map(len, parts)])[:-1].tolist() == grammar.at.tolist()
    pairs = list(zip(grammar.symbols.tolist(), grammar.symbols[1:].tolist(), strict=False))
    assert len(set(pairs)) == len(pairs)  # no pair is left twice
    wanted = np.ones(len(grammar.size), bool)
    for symbol, place in zip(*grammar.occurrences(wanted), strict=True):
        assert words[place : place + grammar.size[symbol]].tolist() == expand(symbol)


def test_multiples_and_parts_of_runs_go():
    found = runs.maximal(np.array([(0, 12, 3), (2, 12, 3), (0, 12, 6), (0, 8, 2), (20, 40, 3), (20, 30, 3)]))
    assert found.tolist() == [[0, 8, 2], [0, 12, 3], [20, 40, 3]]


@pytest.mark.parametrize("batch_words", [40, 1 << 17])
def test_queries_rows(spark, batch_words):
    rows = [*cases.texts(), (60, "a b " * 200, "a"), (61, "a\x0bb\x0cc\rd " * 9, "a"), (62, "é\xa0é " * 30, "a"), (63, "w " * 5, "a"), (64, "w " * 6, "a"), (65, "a b a b a b a", "a")]
    rows += [(1000 + i, cases.prose(20 + i, i), "b") for i in range(60)]
    found = runs.periodic_runs(cases.table(spark, rows), planted=True, batch_words=batch_words)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted((answer(i, t) for i, t, _ in rows), key=repr)


def test_ids_of_any_type_and_no_rows(spark):
    df = spark.createDataFrame([("x", "w " * 8), (None, "w " * 8)], "doc_id string, text string")
    assert {r["doc_id"]: r["length"] for r in runs.periodic_runs(df).collect()} == {"x": 8, None: 8}
    assert runs.periodic_runs(df.limit(0)).count() == 0


def test_query_over_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    found = queries.op13_periodic_runs(spark, SMALL).collect()
    short = {r["doc_id"]: r["text"] for r in docs if len(cases.words_of(r["text"])) <= 1200}
    assert len(short) > len(docs) * 0.8
    assert sorted(tuple(r) for r in found if r["doc_id"] in short) == sorted(answer(i, t) for i, t in short.items())
