"""op11 against a plain tree, with blocks small enough for several rounds."""

from __future__ import annotations

import hashlib
import random
import sys
import zlib
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

import cases  # noqa: E402

from creditmart.llm import merkle  # noqa: E402


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value) -> str:
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(nodes: list[str]) -> tuple[str | None, list[list[tuple]]]:
    proofs, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, proof in enumerate(proofs):
            other = at[i] ^ 1
            proof.append((nodes[other] if other < len(nodes) else "", at[i] & 1))
            at[i] //= 2
        nodes = [digest(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)]
    return (nodes[0] if nodes else None), proofs


def evidence(rows: list[tuple]) -> list[tuple]:
    """op11 of (doc_id, source, lang, n_chars, text) by building every tree."""
    groups: dict = {}
    for i, s, lang, n, t in rows:
        leaf, tampered = (digest(*map(field, (i, s, lang, m, t))) for m in (n, None if n is None else n + 1))
        groups.setdefault(lang, []).append(((i is not None, i or 0), leaf, tampered, i))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([leaf for _, leaf, _, _ in sorted(groups[g], key=lambda r: r[:2])]) for g in order}
    root, upper = tree([trees[g][0] for g in order])
    out = []
    for g, above in zip(order, upper, strict=True):
        for (_, leaf, tampered, i), proof in zip(sorted(groups[g], key=lambda r: r[:2]), trees[g][1], strict=True):
            at = tampered if i is not None and zlib.crc32(str(i).encode()) % 7 == 0 else leaf
            for h, left in proof + above:
                at = digest(h, at) if left else digest(at, h)
            out.append((i, leaf, trees[g][0], root, digest(*(h for h, _ in proof + above)), at, at == root))
    return out


def check(spark, rows: list[tuple]) -> list[tuple]:
    df = spark.createDataFrame([(*r, "x", 1, "g") for r in rows], "doc_id long, source string, lang string, n_chars long, text string, leaf string, rank int, grp string")
    found = sorted(map(tuple, merkle.tamper_evidence(df.repartition(5)).collect()), key=repr)
    assert found == sorted(evidence(rows), key=repr)
    return found


@pytest.mark.parametrize("digits", [2, 10])
def test_proofs_of_awkward_rows(spark, monkeypatch, digits):
    monkeypatch.setattr(merkle, "DIGITS", digits)
    langs = [None, "", "en", "é", "e", "zz"]
    rows = [(i, s, langs[k % 6], None if t is None else len(t), t) for k, (i, t, s) in enumerate(cases.texts())]
    rows += [(7, None, "one", None, None), (None, None, None, None, None), (None, None, None, None, None), (-3, "s", "en", -1, "a:b")]
    rows += [(50, "s", "copies", 1, "x")] * 37
    found = check(spark, rows)
    assert {v for *_, v in found} == {True, False}


def test_trees_of_every_size(spark, monkeypatch):
    """Groups of 1 to 20 leaves: complete runs, single nodes at any level, several rounds."""
    monkeypatch.setattr(merkle, "DIGITS", 2)
    pick = random.Random(4)
    check(spark, [(pick.randrange(10**9), "s", f"g{g}", g, str(pick.random())) for g in range(1, 21) for _ in range(g)])


def test_many_groups_and_a_single_row(spark, monkeypatch):
    monkeypatch.setattr(merkle, "DIGITS", 3)
    check(spark, [(i, None, f"lang {i}", i, None) for i in range(150)])
    check(spark, [(5, "s", None, 1, "t")])


def test_empty_table(spark):
    assert check(spark, []) == []


def test_proof_lists_siblings_from_the_leaf_up(spark):
    df = spark.createDataFrame([(i, "g", f"h{i}") for i in range(5)], "k long, g string, h string")
    found = {r["rank"]: r for r in merkle.manifest(df, "k", "g", "h", ["k"]).collect()}
    first = digest("h0", "h1")
    assert [tuple(s) for s in found[2]["proof"]] == [("h3", False), (first, True), (digest(digest("h4")), False)]
    assert [tuple(s) for s in found[4]["proof"]] == [(None, False), (None, False), (digest(first, digest("h2", "h3")), True)]
    assert found[0]["subroot"] == found[0]["root"] and found[0]["k"] == 0
