"""Deals token rests over cells so that lexical neighbours of the whole corpus share one.

A rest becomes a vector: the BM25 weights of its tokens, projected on the ``RANK`` main directions of a
sample of the corpus. A tree of cuts, each at the median along the widest direction of what it cuts,
is grown from the sample; every rest walks down it, so which cell it is in depends on its tokens only.
A tree has at most ``FAN`` leaves. Larger corpora get a tree for each cell, grown in tasks from
a sample of the cell, until cells have about four shards. In its task a cell is halved the same
way, by exact ranks, down to shards.

A last coordinate made from a hash breaks ties: rests with equal vectors are halved too, so a large
group of copies fills several cells evenly. Samples are bounded (``SAMPLE`` rests a tree). The trees of a
level are broadcast, 280 KB each at most.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmart.sources.stage import stage

RANK, FAN, SAMPLE, JITTER = 64, 1_024, 16_384, 1e-3
PART = 1 << 15  # cells of the sample that the driver multiplies at a time


@dataclass(frozen=True)
class Weights:
    """What the weights of tokens need: ``shared`` is a broadcast of (idf, mean length, type of ids)."""

    idf: np.ndarray
    shared: object
    k1: float
    b: float


def counted(rests: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(rest, token, how often) of every token of every rest, in this order, and the rests' lengths."""
    lengths = np.array([len(r) for r in rests])
    tokens = np.concatenate([np.sort(r, kind="stable") for r in rests])  # 16-bit ids are sorted digit by digit
    new = np.r_[True, tokens[1:] != tokens[:-1]]
    new[(np.cumsum(lengths) - lengths)[lengths > 0]] = True
    at = np.flatnonzero(new)
    return np.repeat(np.arange(len(rests)), lengths)[at], tokens[at].astype(np.int64), np.diff(np.r_[at, len(tokens)]), lengths


def weighted(rests: list[np.ndarray], idf: np.ndarray, mean_length: float, k1: float, b: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rest, token, weight) of every token of every rest; the weights of a rest have length 1."""
    rest, token, tf, lengths = counted(rests)
    weight = idf[token] * tf * (k1 + 1) / (tf + k1 * (1 - b + b * lengths[rest] / max(mean_length, 1e-9)))
    norm = np.sqrt(np.bincount(rest, weight**2, len(rests)))
    return rest, token, (weight / np.maximum(norm, 1e-9)[rest]).astype(np.float32)


def _sums(group: np.ndarray, weight: np.ndarray, rows: np.ndarray, index: np.ndarray, size: int) -> np.ndarray:
    """The sums of weight x rows[index] by group, for a part of the cells at a time."""
    out = np.zeros((size, rows.shape[1]), dtype=np.float32)
    for i in range(0, len(group), PART):
        order = i + np.argsort(group[i : i + PART], kind="stable")
        part = group[order]
        starts = np.r_[0, np.flatnonzero(np.diff(part)) + 1]
        out[part[starts]] += np.add.reduceat(rows[index[order]] * weight[order, None], starts)
    return out


def sampled(ids: list[np.ndarray], weights: Weights, mean_length: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``weighted`` of a whole sample, in narrow types and for a few rests at a time: the driver holds it."""
    found = []
    for i in range(0, len(ids), 512):
        rest, token, weight = weighted(ids[i : i + 512], weights.idf, mean_length, weights.k1, weights.b)
        found.append(((rest + i).astype(np.int32), token.astype(np.int32), weight))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def projection(cells: tuple[np.ndarray, np.ndarray, np.ndarray], rests: int, tokens: int) -> np.ndarray:
    """The main directions of the sample in the space of tokens, by subspace iteration."""
    rest, token, weight = cells
    random, basis = np.random.Generator(np.random.PCG64(7)), np.empty((tokens, RANK), dtype=np.float32)
    for i in range(0, tokens, 4_096):
        basis[i : i + 4_096] = random.standard_normal((min(4_096, tokens - i), RANK))
    for _ in range(3):
        image = np.linalg.qr(_sums(rest, weight, basis, token, rests))[0]
        basis = _sums(token, weight, image, rest, tokens)
        if basis.shape[1] < RANK:
            basis = np.pad(basis, ((0, 0), (0, RANK - basis.shape[1])))
    basis /= np.maximum(np.linalg.norm(basis, axis=0), 1e-9)
    return basis


def projected(rests: list[np.ndarray], ties: np.ndarray, weights: Weights, mean_length: float, basis: np.ndarray) -> np.ndarray:
    """The vectors of rests, of length 1, with the coordinate that breaks ties."""
    rest, token, weight = weighted(rests, weights.idf, mean_length, weights.k1, weights.b)
    edges = np.searchsorted(rest, np.arange(len(rests) + 1)).tolist()
    found = np.stack([weight[a:b] @ basis[token[a:b]] for a, b in zip(edges, edges[1:], strict=False)])
    found /= np.maximum(np.linalg.norm(found, axis=1, keepdims=True), 1e-9)
    return np.column_stack([found, JITTER * ((ties & 0xFFFF) / 65_536 - 0.5)]).astype(np.float16).astype(np.float32)


def vectors(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype=np.float16).reshape(len(column), RANK + 1).astype(np.float32)


def widest(x: np.ndarray) -> np.ndarray:
    """The direction in which vectors differ most, and the ties with it."""
    direction = np.linalg.eigh(np.cov(x[:, :-1], rowvar=False))[1][:, -1] if len(x) > 1 else np.zeros(x.shape[1] - 1)
    direction = direction * (np.sign(direction[np.argmax(np.abs(direction))]) or 1)
    return np.r_[direction, 1].astype(np.float32)


def grow(x: np.ndarray, depth: int) -> np.ndarray:
    """A tree of 2**depth leaves in heap order: a row of direction and limit for each cut."""
    tree = np.zeros(((1 << depth) - 1, x.shape[1] + 1), dtype=np.float32)
    parts = {0: np.arange(len(x))}
    for node in range(len(tree)):
        part = parts.pop(node)
        tree[node, :-1] = widest(x[part])
        along = x[part] @ tree[node, :-1]
        tree[node, -1] = np.median(along) if len(part) else 0
        parts[2 * node + 1], parts[2 * node + 2] = part[along <= tree[node, -1]], part[along > tree[node, -1]]
    return tree


def leaf(x: np.ndarray, tree: np.ndarray) -> np.ndarray:
    node = np.zeros(len(x), dtype=np.int64)
    for _ in range((len(tree) + 1).bit_length() - 1):
        node = 2 * node + 1 + (np.einsum("ij,ij->i", x, tree[node, :-1]) > tree[node, -1])
    return node - len(tree)


def halves(x: np.ndarray, most: int) -> list[np.ndarray]:
    """Row numbers, ascending, of parts of at most so many rows."""
    done, parts = [], [np.arange(len(x))]
    while parts:
        part = parts.pop()
        if len(part) <= most:
            done.append(part)
            continue
        order = np.argsort(x[part] @ widest(x[part]), kind="stable")
        parts += [np.sort(part[order[len(part) // 2 :]]), np.sort(part[order[: len(part) // 2]])]
    return done


def cells(rests: DataFrame, n: int, weights: Weights, shard_pieces: int, fan: int = FAN) -> tuple[DataFrame, int]:
    """The rests with their ``cell`` and vector ``vec``, and the number of cells. ``n``: how many rests there are."""
    shared = weights.shared
    mean_length, narrow = shared.value[1:]
    levels, depth, most = [], max(0, (-(-n // (4 * shard_pieces)) - 1).bit_length()), fan.bit_length() - 1
    while depth > 0 or not levels:
        levels.append(min(depth, most))
        depth -= levels[-1]
    tie = F.xxhash64("doc_id", "start", "doc_tokens", "row")
    share = lambda rows: F.pmod(F.xxhash64(tie), F.lit(1 << 30)) < int(min(1, rows / max(1, n)) * (1 << 30))
    sample = rests.filter(share(SAMPLE)).select("rest", tie.alias("tie")).toPandas().sort_values("tie")
    basis, tree = np.zeros((len(weights.idf), RANK), np.float32), np.zeros((0, RANK + 2), np.float32)
    if levels[0] and len(sample):
        ids, ties = [np.frombuffer(r, dtype=narrow) for r in sample["rest"]], sample["tie"].to_numpy()
        del sample
        pa.default_memory_pool().release_unused()
        basis = projection(sampled(ids, weights, mean_length), len(ids), len(weights.idf))
        x = np.concatenate([projected(ids[i : i + 512], ties[i : i + 512], weights, mean_length, basis) for i in range(0, len(ids), 512)])
        tree = grow(x, levels[0])
        del ids, x
    context, k1, b = rests.sparkSession.sparkContext, weights.k1, weights.b
    sent = context.broadcast((basis, tree))

    @F.pandas_udf("cell long, vec binary")
    def place(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        (basis, tree), (idf, mean_length, narrow) = sent.value, shared.value
        how = Weights(idf, None, k1, b)
        for rest, ties in batches:
            if len(rest):
                parts = range(0, len(rest), 512)
                x = np.concatenate([projected([np.frombuffer(r, dtype=narrow) for r in rest.iloc[i : i + 512]], ties.iloc[i : i + 512].to_numpy(), how, mean_length, basis) for i in parts])
                yield pd.DataFrame({"cell": leaf(x, tree), "vec": [v.tobytes() for v in x.astype(np.float16)]})
            else:
                yield pd.DataFrame({"cell": np.zeros(0, np.int64), "vec": np.zeros(0, object)})

    placed, count = rests.withColumn("at", place("rest", tie)).select("*", "at.cell", "at.vec").drop("at"), 1 << levels[0]
    for depth in levels[1:]:
        placed = stage(placed, "pack-cells")
        placed, count = _refined(placed, placed.filter(share(SAMPLE * count)), depth), count << depth
    return placed, count


def _refined(placed: DataFrame, sample: DataFrame, depth: int) -> DataFrame:
    """Every cell cut into 2**depth, by a tree of its own."""

    def grown(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"cell": [key[0]], "tree": [grow(vectors(group.sort_values("vec")["vec"]), depth).tobytes()]})

    trees = sample.select("cell", "vec").groupBy("cell").applyInPandas(grown, "cell long, tree binary").toPandas()
    sent = placed.sparkSession.sparkContext.broadcast(dict(zip(trees["cell"], trees["tree"], strict=True)))

    @F.pandas_udf("long")
    def finer(cell: pd.Series, vec: pd.Series) -> pd.Series:
        out = cell.to_numpy(np.int64) << depth
        for value in np.unique(cell):
            rows = np.flatnonzero(cell == value)
            if value in sent.value:
                out[rows] += leaf(vectors(vec.iloc[rows]), np.frombuffer(sent.value[value], np.float32).reshape(-1, RANK + 2))
        return pd.Series(out)

    return placed.withColumn("cell", finer("cell", "vec"))
