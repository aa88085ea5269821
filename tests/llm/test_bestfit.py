"""op12: ids rebuilt, plans against a plain search, places without gaps."""

from __future__ import annotations

import random
import sys
import zlib
from collections import Counter
from itertools import combinations_with_replacement
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))

import cases  # noqa: E402
from conftest import MEDIUM  # noqa: E402

from creditmart.llm import bestfit, queries, token_units  # noqa: E402


def sequences(lengths: list[int], window: int) -> int:
    """Plans the lengths and checks that each piece is in one sequence and none is too long."""
    count = np.bincount(np.array(lengths, int), minlength=window + 1)
    made, used = bestfit.plan(count), Counter()
    for held, times in made:
        assert times > 0 and sum(x * n for x, n in held.items()) <= window
        for x, n in held.items():
            used[x] += n * times
    assert used == Counter(lengths)
    return sum(times for _, times in made)


def best_fit(lengths: list[int], window: int) -> int:
    """Best fit decreasing, a piece at a time."""
    gaps: list[int] = []
    for x in sorted(lengths, reverse=True):
        fits = [g for g in gaps if g >= x]
        if fits:
            gaps.remove(min(fits))
        gaps.append((min(fits) if fits else window) - x)
    return len(gaps)


@pytest.mark.parametrize("seed", range(3))
def test_plans_are_no_worse_than_best_fit(seed):
    pick = random.Random(seed)
    for _ in range(150):
        window = pick.choice([4, 16, 64, 200])
        top = pick.randint(1, window)
        lengths = [pick.randint(pick.choice([1, (top + 1) // 2]), top) for _ in range(pick.randint(0, 150))]
        n = sequences(lengths, window)
        assert -(-sum(lengths) // window) <= n <= best_fit(lengths, window) + 1 + len(lengths) // 50


def test_plan_of_many_pieces_wastes_nothing():
    pick = random.Random(5)
    lengths = [min(4096, 1 + int(pick.lognormvariate(6.3, 1.1))) for _ in range(20_000)]
    assert sequences(lengths, 4096) == -(-sum(lengths) // 4096)
    assert sequences([1] * 100_000, 4096) == 25 and sequences([4096] * 3, 4096) == 3 and sequences([], 4096) == 0


def test_sums_stay_indexed_as_lengths_run_out():
    pick = random.Random(2)
    count = np.array([0] + [pick.choice([0, 0, 1, 2]) for _ in range(60)])
    supply = bestfit.Supply(count, 1)
    for _ in range(25):
        have = np.flatnonzero(supply.count)
        for gap in range(1, 61):
            found = supply.exact(gap, Counter())
            bag = Counter({int(x): int(supply.count[x]) for x in have})
            ways = [w for k in (1, 2, 3) for w in combinations_with_replacement(have.tolist(), k) if sum(w) == gap and not Counter(w) - bag]
            assert bool(found) == bool(ways) and (not found or sum(found) == gap and not Counter(found) - bag)
        if len(have):
            length = pick.choice(have.tolist())
            supply.use(length, int(supply.count[length]))


@pytest.mark.parametrize("window", [16, 4096])
def test_pieces_rebuild_their_documents(spark, window):
    rows = cases.texts()
    tokenizer = token_units.load(token_units.public_path("word_bpe_49k.json"))
    how = bestfit.BestFit(window=window, cache_size=50)
    found = bestfit.pack(cases.table(spark, rows).repartition(4), how).collect()
    want: Counter = Counter()
    for i, t, _ in rows:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        for piece, start in enumerate(range(0, len(ids), window)):
            part = np.array(ids[start : start + window], "<u4")
            want[i, piece, start, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found) == want
    filled: Counter = Counter()
    for r in sorted(found, key=lambda r: r["offset"]):
        assert r["offset"] == filled[r["sequence_id"]]
        filled[r["sequence_id"]] += r["length"]
    assert max(filled.values()) <= window
    total = sum(filled.values())
    assert len(filled) <= best_fit([r["length"] for r in found], window) + 1 and len(filled) >= -(-total // window)


def test_empty_table_and_ids_of_any_type(spark):
    df = spark.createDataFrame([("x", "a b c"), (None, None)], "doc_id string, text string")
    assert sorted(((r["doc_id"] or "", r["length"]) for r in bestfit.pack(df).collect())) == [("", 1), ("x", 4)]
    assert bestfit.pack(df.limit(0)).count() == 0


def test_query_over_documents(spark):
    found = queries.op12_best_fit(spark, MEDIUM).collect()
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet").count()
    assert len({r["doc_id"] for r in found}) == docs
    tokens = sum(r["length"] for r in found)
    assert len({r["sequence_id"] for r in found}) <= -(-tokens // 4096) + 1
