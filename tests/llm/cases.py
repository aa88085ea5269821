"""Small tables with everything that can go wrong, and plain-Python versions of what the operators do."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, digest string, n_points int, maybe string, bucket0 int, "
    "row long, score double, mix_row long, join_row long, block string, words int, label int"
)
WORDS = "the of and tion idiot quick brown fox über señor L'été don't 42 x".split()


def prose(n: int, seed: int) -> str:
    pick = random.Random(seed)
    return " ".join(pick.choice(WORDS) + str(pick.randrange(40)) for _ in range(n))


def texts() -> list[tuple]:
    """(doc_id, text, source), with nulls, empties, blanks, copies, ties, near copies, repeated rows and a very long text."""
    base, other = prose(60, 1), prose(90, 2)
    near = base.split()
    near[30] = "changed"
    rows = [
        (1, base, "a"), (2, base, "b"), (3, base.replace(" ", "  "), "a"), (4, " ".join(near), None), (5, other, "é"), (6, None, "a"), (7, "", "a"),
        (8, " \t\n", None), (9, "one two three", "b"), (10, "one two three", "b"), (11, "one two\nthree", "b"), (None, base, "a"), (12, other + "\n" + base, "zz"),
        (13, "line one is here\nline one is here\n\nline one is here", "b"), (14, ("a b c d e " * 30).strip(), "a"), (15, "naïve 日本語 テキスト   <|endoftext|> x\0y", "c"),
        (16, prose(9, 5), "c"), (17, prose(3000, 6), "d"), (18, "### $$$ %%% &&& " * 20, "c"), (5, other, "é"), (19, "x" * 5000, "c"), (20, prose(40, 9)[:49], "c"),
        (21, prose(40, 9)[:49], "c"), (22, other[:200], "a"), (23, "zz" + other[20:300], "a"),
    ]
    return rows + [(100 + i, prose(20 + i, 50 + i), "abc"[i % 3]) for i in range(12)]


def table(spark, rows: list[tuple]):
    extra = ("d", 3, "m", 0, 5, 0.5, 1, 2, "b", 4, 1)
    return spark.createDataFrame([(i, t, "en", s, None if t is None else len(t), *extra) for i, t, s in rows], SCHEMA)


def labels(spark, rows: list[tuple] | None = None):
    made = [(i, (i % 7 > 0) * 1, (i % 5 == 1) * 1) for i in range(0, 130)] + [(None, 1, 0), (3, None, None), (4, 1, 0)]
    return spark.createDataFrame(made if rows is None else rows, "doc_id long, quality int, toxic int")


def squeezed(text: str | None) -> str:
    return re.sub(r"[\x20\x09-\x0d]", "", text or "")


def words_of(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0d]+", text or "")


def removed(rows: list[tuple]) -> list[tuple]:
    """op1 by looking at every 50-byte string."""
    order = lambda i: (i is None, i or 0)
    data = [(i, (t or "").encode()) for i, t, _ in rows]
    first: dict[bytes, tuple] = {}
    for i, b in data:
        for k in range(len(b) - 49):
            first[b[k : k + 50]] = min(first.get(b[k : k + 50], order(i)), order(i))
    out = []
    for i, b in data:
        cut = bytearray(len(b))
        for k in range(len(b) - 49):
            if first[b[k : k + 50]] < order(i):
                cut[k : k + 50] = b"\1" * 50
        kept = bytes(x for x, y in zip(b, cut, strict=True) if not y)
        out.append((i, len(b), sum(cut), len(re.findall(b"\1+", bytes(cut))), hashlib.sha256(kept).hexdigest()))
    return out


def shingle_links(rows: list[tuple], threshold: float = 0.8) -> tuple[dict, dict]:
    """op4 on row numbers: links and groups, from all pairs."""
    sets = []
    for _, t, _ in rows:
        w = words_of(t)
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    root, links = list(range(len(rows))), Counter()

    def find(x: int) -> int:
        while root[x] != x:
            x = root[x]
        return x

    for x in range(len(rows)):
        for y in range(x):
            if sets[x] and len(sets[x] & sets[y]) >= threshold * len(sets[x] | sets[y]):
                links[x] += 1
                links[y] += 1
                root[max(find(x), find(y))] = min(find(x), find(y))
    groups = defaultdict(list)
    for x in range(len(rows)):
        groups[find(x)].append(x)
    return links, {x: g for g in groups.values() for x in g}


def repeat_words(words: list[str]) -> int:
    places = defaultdict(list)
    for k in range(len(words) - 4):
        places[tuple(words[k : k + 5])].append(k)
    return len({p for v in places.values() if len(v) > 1 for k in v for p in range(k, k + 5)})
