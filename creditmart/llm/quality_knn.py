"""Quality classifier: nearest-neighbour voting in a latent semantic space.

A document becomes a vector of hashed terms: its words, its word shapes (case, digits, the symbols and
punctuation attached), immediate repetitions, and coarse bands of length and of word variety. A word is
a run between white space; a run of more than 64 characters counts as consecutive words of 64. Terms
weigh by the square root of their share, times inverse document frequency. A truncated singular value
decomposition of the labelled sample gives ``rank`` latent dimensions. Every document is compared with
all labelled vectors by exact cosine products, block by block, and its ``neighbours`` nearest vote,
weighted by similarity.

Fitting uses at most ``max_rows`` labelled documents outside the test fold, with their document
frequencies (a parameter; 8,192 vectors of 64 floats are 2 MiB). These vectors, the projection and
the labels are what is broadcast. Scoring streams over whole texts without a shuffle, in blocks of
``BLOCK`` documents. Defined cases: null, empty and blank texts are documents without words, which
have a term of their own; without labels every score is 0.5; repeated rows score alike; extra columns
are not read by ``quality`` and kept by ``keep_good``.
"""

from __future__ import annotations

import operator
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditmart.llm.common import fresh, held_out, whole_text
from creditmart.llm.labelled import training_rows

WORDS, SHAPES, BANDS = 512, 384, 128
SIZE = WORDS + SHAPES + BANDS
SHARES = np.concatenate([np.full(WORDS, 0.3), np.full(SHAPES, 1.0), np.full(BANDS, 0.6)]).astype(np.float32)
BLOCK = 256
CACHE_SIZE = 300_000
LONGEST = 64
SHAPE = (re.compile(r"[^\W\d_]+"), re.compile(r"\d+"))


def _slot(text: str, size: int) -> int:
    return zlib.crc32(text.encode("utf-8", "surrogatepass")) % size


class _Terms(dict):
    """word (of at most ``LONGEST`` characters) -> its word slot and shape slot, packed."""

    def __missing__(self, word: str) -> int:
        letters = SHAPE[0].sub(lambda m: "A" if len(m[0]) > 1 and m[0].isupper() else "T" if m[0][0].isupper() else "a", word)
        shape = SHAPE[1].sub("0", letters)
        value = _slot(word.lower(), WORDS) * SHAPES + _slot(shape, SHAPES)
        if len(self) >= CACHE_SIZE:
            self.clear()
        self[word] = value
        return value


def _band(name: str, share: float) -> int:
    return _slot(f"{name} {int(share * 10)}", BANDS)


def words_of(text: str) -> list[str]:
    """The runs between white space, those longer than ``LONGEST`` in consecutive pieces."""
    words = text.split()
    if max(map(len, words), default=0) <= LONGEST:
        return words
    return [w[i : i + LONGEST] for w in words for i in range(0, len(w), LONGEST)]


def vector(text: str, terms: _Terms) -> np.ndarray:
    """The term shares of a text; each family of terms has a length of its own."""
    words = words_of(text)
    n, found = len(words), np.zeros(SIZE, dtype=np.float32)
    if n == 0:
        found[WORDS + SHAPES + _slot("empty", BANDS)] = 1
        return found * SHARES
    word, shape = np.divmod(np.fromiter(map(terms.__getitem__, words), dtype=np.int64, count=n), SHAPES)
    found[:WORDS] = np.sqrt(np.bincount(word, minlength=WORDS) / n)
    found[WORDS : WORDS + SHAPES] = np.sqrt(np.bincount(shape, minlength=SHAPES) / n)
    repeated = sum(map(operator.eq, words, islice(words, 1, None)))
    # Long texts repeat words of themselves; variety is taken over runs of 200 words.
    runs = range(0, n, 200)
    variety = sum(len(set(words[i : i + 200])) for i in runs) / n
    bands = (f"length {min(n, 4000).bit_length()}" if n >= 10 else "short", f"short {n}" if n < 10 else "not short")
    for slot in (*(_slot(b, BANDS) for b in bands), _band("repeated", repeated / n), _band("variety", variety)):
        found[WORDS + SHAPES + slot] += 0.5
    return found * SHARES


@dataclass
class Model:
    projection: np.ndarray  # terms x rank, inverse document frequencies included
    vectors: np.ndarray  # labelled documents x rank, of length 1
    labels: np.ndarray
    neighbours: int


def _unit(rows: np.ndarray) -> np.ndarray:
    return (rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = 8_192, rank: int = 64, neighbours: int = 15) -> Model:
    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        terms = _Terms()
        for batch in batches:
            yield pd.DataFrame({"label": batch["label"], "x": [vector(t, terms).astype(np.float16).tobytes() for t in batch["text"]]})

    data = training_rows(docs, labels, label, max_rows).mapInPandas(vectors, "label int, x binary").toPandas()
    data = data.sort_values(["label", "x"])  # the model does not depend on the order of arrival
    x = np.frombuffer(b"".join(data["x"]), dtype=np.float16).astype(np.float32).reshape(len(data), SIZE)
    if not len(x):
        return Model(np.zeros((SIZE, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0, np.float32), neighbours)
    idf = np.log((1 + len(x)) / (1 + (x > 0).sum(axis=0))) + 1
    weighted = (x * idf).astype(np.float64)
    values, basis = np.linalg.eigh(weighted.T @ weighted)
    projection = (idf[:, None] * basis[:, np.argsort(-values)[:rank]]).astype(np.float32)
    return Model(projection, _unit(x @ projection), data["label"].to_numpy(np.float32), neighbours)


def votes(rows: np.ndarray, model: Model) -> np.ndarray:
    """The similarity-weighted share of label 1 among each row's nearest labelled vectors."""
    if not len(model.labels):
        return np.full(len(rows), 0.5)
    near = _unit(rows @ model.projection) @ model.vectors.T
    k = min(model.neighbours, near.shape[1])
    best = np.argpartition(-near, k - 1, axis=1)[:, :k]
    weight = np.maximum(np.take_along_axis(near, best, axis=1), 0).astype(np.float64) ** 8 + 1e-9
    return np.clip((weight * model.labels[best]).sum(axis=1) / weight.sum(axis=1), 0, 1)


def scores(texts: pd.Series, model: Model, terms: _Terms) -> np.ndarray:
    starts = range(0, len(texts), BLOCK)
    parts = [votes(np.stack([vector(t, terms) for t in texts.iloc[i : i + BLOCK]]), model) for i in starts]
    return np.concatenate(parts) if parts else np.zeros(0)


def quality(docs: DataFrame, model: Model, threshold: float = 0.3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        terms = _Terms()
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "held_out": batch["held_out"], "score": scores(batch["text"], shared.value, terms)})

    rows = docs.select(F.col(f"`{key}`").cast("string").alias("doc_id"), held_out(key).alias("held_out"), whole_text(text).alias("text"))
    found = rows.mapInPandas(scored, "doc_id string, held_out boolean, score double")
    return found.select(F.col("doc_id").cast("long").alias("doc_id"), "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: Model, threshold: float = 0.3, text: str = "text") -> DataFrame:
    """The input rows that score at least the threshold, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(T.DoubleType())
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        terms = _Terms()
        for texts in batches:
            yield pd.Series(scores(texts, shared.value, terms))

    name, = fresh(docs, "score")
    return docs.withColumn(name, score(whole_text(text))).filter(F.col(name) >= threshold).drop(name)
