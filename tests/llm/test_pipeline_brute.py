"""Each stage of the pipeline on a small table, against a plain version of its step on the same input."""

from __future__ import annotations

import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))

import cases  # noqa: E402
import corpus_pipeline  # noqa: E402
from conftest import SMALL  # noqa: E402

from creditmart.llm import mixing, quality_knn, token_units  # noqa: E402
from creditmart.sources.stage import stage  # noqa: E402


@pytest.fixture(scope="module")
def stages(spark) -> list:
    """What goes into each stage and what comes out of the last."""
    found = [spark.read.parquet(f"{SMALL}/documents.parquet")]
    for name, step in corpus_pipeline.STAGES:
        found.append(stage(step(spark, found[-1], SMALL), "brute-" + name.replace(" ", "-")))
    return [df.collect() for df in found]


def ids(rows: list) -> list:
    return sorted(r["doc_id"] for r in rows)


def test_the_classifier_keeps_by_its_neighbours_votes(spark, stages):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = quality_knn.fit(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    terms, kept, near_the_edge = quality_knn._Terms(), [], 0
    for r in stages[0]:
        row = quality_knn.vector(r["text"] or "", terms) @ model.projection
        similar = model.vectors @ (row / max(np.linalg.norm(row), 1e-9))
        best = np.argsort(-similar, kind="stable")[: model.neighbours]
        weight = np.maximum(similar[best], 0).astype(float) ** 8 + 1e-9
        score = float((weight * model.labels[best]).sum() / weight.sum())
        if abs(score - 0.3) < 1e-3:  # rounding or a tie among neighbours may decide
            near_the_edge += 1
        elif score >= 0.3:
            kept.append(r["doc_id"])
    assert set(kept) <= set(ids(stages[1])) and len(stages[1]) <= len(kept) + near_the_edge
    assert 0 < len(stages[1]) < len(stages[0])
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    good = [i for i, q in labels.items() if q == 1]
    assert len(set(good) & set(ids(stages[1]))) >= 0.97 * len(good)


def test_of_equal_texts_the_longest_stays(stages):
    groups = defaultdict(list)
    for r in stages[1]:
        groups[cases.squeezed(r["text"])].append((-len(r["text"] or ""), r["doc_id"]))
    assert ids(stages[2]) == sorted(min(g)[1] for g in groups.values())
    texts = {r["doc_id"]: r for r in stages[0]}
    assert all(r == texts[r["doc_id"]] for r in stages[2])


def test_of_near_copies_the_first_stays(stages):
    rows = [(r["doc_id"], r["text"], r["source"]) for r in stages[2]]
    _, groups = cases.shingle_links(rows)
    expected = {min(rows[x][0] for x in g) for g in groups.values()}
    assert ids(stages[3]) == sorted(expected)


def test_the_mix_meets_its_targets_with_words_of_its_documents(stages):
    source, words = {r["doc_id"]: r["source"] for r in stages[3]}, {r["doc_id"]: cases.words_of(r["text"]) for r in stages[3]}
    size: dict = defaultdict(int)
    for i, w in words.items():
        size[source[i]] += len(w)
    names = sorted(size, key=lambda s: (s is None, s or ""))
    targets = dict(zip(names, mixing.share_out([size[s] for s in names], mixing.weights(len(names)), 3), strict=True))
    taken, by_document = defaultdict(int), Counter()
    for r in stages[4]:
        mixed, at = cases.words_of(r["text"]), 0
        for w in words[r["doc_id"]]:  # a copy has words of its document, in their order
            at += at < len(mixed) and w == mixed[at]
        assert at == len(mixed) > 0 and r["source"] == source[r["doc_id"]]
        taken[r["source"]] += len(mixed)
        by_document[r["doc_id"]] += len(mixed)
    assert all(abs(taken[s] - targets[s]) <= 1 for s in names)
    assert all(n <= 3 * len(words[i]) for i, n in by_document.items())


def test_the_sequences_hold_every_id_once(stages):
    tokenizer = token_units.load(token_units.public_path("word_bpe_49k.json"))
    encoded = [(r["doc_id"], np.array([*tokenizer.encode(r["text"], add_special_tokens=False).ids, 1], "<u4")) for r in stages[4]]
    pieces = stages[5]
    assert sum(r["length"] for r in pieces) == sum(len(x) for _, x in encoded)
    assert Counter((r["doc_id"], r["doc_tokens"]) for r in pieces if r["start"] == 0) == Counter((i, len(x)) for i, x in encoded)
    crcs = defaultdict(set)
    for i, x in encoded:
        crcs[i].add((len(x), x.tobytes()))
    for r in pieces:
        cut = slice(4 * r["start"], 4 * (r["start"] + r["length"]))
        assert any(n == r["doc_tokens"] and zlib.crc32(x[cut]) == r["ids_crc32"] for n, x in crcs[r["doc_id"]])
    filled: Counter = Counter()
    for r in sorted(pieces, key=lambda r: r["offset"]):
        assert r["offset"] == filled[r["sequence_id"]]
        filled[r["sequence_id"]] += r["length"]
    assert all(n <= 2048 for n in filled.values())
