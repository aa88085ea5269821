"""Lexical retrieval packing: every document's tokens into sequences of at most ``window`` tokens.

1. Each document becomes token ids with an end id. Its full windows are sequences of their own; the
   rest, shorter than a window, is packed. Document frequencies of all tokens are counted over all
   documents on the way (one row per token of the vocabulary and task, then summed).
2. Rests are dealt over shards of bounded size by what they say, over the whole corpus (``locality``):
   lexical neighbours share a shard wherever in the table they come from. A shard holds a BM25 inverted
   index of its rests, with the corpus-wide document frequencies and mean length. A neighbour beyond a
   cell's border is still missed; README has the measured recall by size.
3. In a shard, the longest unused rest is the seed of a window. The index returns its unused
   neighbours, best first; they fill the window in that order, and the one that does not fit is cut to
   fill it exactly, its remainder staying in the index. What a shard has left at the end, less than one
   window, is cut into sequences whose lengths are powers of two, which need no padding.

Defined cases: null, empty and blank texts have the end id alone; repeated rows are packed each;
extra columns are not read. An empty table gives an empty result. Ties in score and length go by the
order of (doc_id, row). Memory in a task: one document's ids, or one cell (about four shards of
``shard_pieces`` pieces). Collected and broadcast: the document frequencies and a projection, bounded by
the vocabulary, and the trees of ``locality``.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmart.llm import locality
from creditmart.llm.common import whole_text
from creditmart.llm.token_units import document_encoder, kept, load, public_path
from creditmart.sources.stage import stage

PIECE = "row long, doc_id string, start long, length long, ids_crc32 long, doc_tokens long"
WHOLE = ["row", "doc_id", "start", "length", "ids_crc32", "doc_tokens", "rest"]
CELL_SHARDS = 64  # ids of shards kept for each cell, which has about four


@dataclass(frozen=True)
class Packing:
    """Parameters of a packing."""

    tokenizer: str = "word_bpe_49k.json"
    window: int = 2_048
    end_id: int = 1
    shard_pieces: int = 1_024
    k1: float = 1.2
    b: float = 0.75
    cache_size: int = 1_000_000


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def tokeniser(how: Packing, keep_ids: bool) -> Callable:
    """For mapInPandas over (row, doc_id, text): a row per piece, then one per token with its document frequency.

    ``rest`` has the ids of pieces still to be packed (of all pieces if ``keep_ids``), 32 bits each.
    """
    path = how.tokenizer if "/" in how.tokenizer else public_path(how.tokenizer)
    names = [*(f.split()[0] for f in PIECE.split(", ")), "rest", "token"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with kept(document_encoder, path, how.cache_size) as encoded:
            yield from pieces(batches, encoded)

    def pieces(batches: Iterator[pd.DataFrame], encoded: Callable[[str], bytes]) -> Iterator[pd.DataFrame]:
        end = np.array([how.end_id], dtype="<u4").tobytes()
        seen = np.zeros(max(encoded.vocabulary, how.end_id + 1), dtype=np.int64)
        narrow = "<u2" if len(seen) <= 1 << 16 else "<u4"
        # Document frequencies: a mark for each token of a document, added up in bytes for 255 documents at a time.
        mark, marked, documents = np.zeros(len(seen), np.uint8), np.zeros(len(seen), np.uint8), 0

        for batch in (whole.iloc[i : i + 1_000] for whole in batches for i in range(0, max(1, len(whole)), 1_000)):
            rows = []
            for row, doc_id, text in zip(batch["row"], batch["doc_id"], batch["text"], strict=True):
                packed = encoded(text) + end
                ids = np.frombuffer(packed, dtype="<u4")
                mark[ids] = 1
                marked += mark
                mark[ids] = 0
                documents += 1
                if documents % 255 == 0:
                    seen += marked
                    marked[:] = 0
                for start in range(0, len(ids), how.window):
                    piece = ids[start : start + how.window]
                    whole = len(piece) == how.window
                    rest = None if whole and not keep_ids else piece.astype(narrow).tobytes()
                    rows.append((row, doc_id, start, len(piece), zlib.crc32(packed[4 * start : 4 * (start + len(piece))]), len(ids), rest, -1))
            yield pd.DataFrame(rows, columns=names).astype({"rest": object, "doc_id": object})
        seen += marked
        tokens = np.flatnonzero(seen)
        if len(tokens):
            yield pd.DataFrame({"row": 0, "doc_id": None, "start": 0, "length": 0, "ids_crc32": 0, "doc_tokens": seen[tokens], "rest": None, "token": tokens})

    return run


class Index:
    """A BM25 inverted index of the rests of one shard; scores of used rests count for nothing."""

    def __init__(self, rests: list[np.ndarray], idf: np.ndarray, mean_length: float, how: Packing):
        docs, terms, tf, lengths = locality.counted(rests)
        useful = idf[terms] > 0  # a term in most documents does not tell them apart
        docs, terms, tf = docs[useful], terms[useful], tf[useful]
        norm = how.k1 * (1 - how.b + how.b * lengths / max(mean_length, 1e-9))
        weight = idf[terms] * tf * (how.k1 + 1) / (tf + norm[docs])
        self.rest_terms = np.split(terms, np.searchsorted(docs, np.arange(1, len(rests))))
        order = np.argsort(terms, kind="stable")
        self.docs, self.weight = docs[order], weight[order]
        edges = np.searchsorted(terms[order], np.arange(len(idf) + 1))
        self.first, self.count = edges[:-1], np.diff(edges)
        self.n = len(rests)

    def scores(self, seed: int) -> np.ndarray:
        """Of every rest for the seed's terms."""
        terms = self.rest_terms[seed]
        count = self.count[terms]
        at = np.repeat(self.first[terms] - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(count.sum())
        return np.bincount(self.docs[at], weights=self.weight[at], minlength=self.n)


def pack_shard(rests: list[np.ndarray], idf: np.ndarray, mean_length: float, how: Packing) -> Iterator[list[tuple[int, int, int]]]:
    """Sequences of (rest, from, to); rests come longest first."""
    index = Index(rests, idf, mean_length, how)
    begin, length = np.zeros(len(rests), np.int64), np.array([len(r) for r in rests])
    unused, left = np.ones(len(rests), bool), int(length.sum())

    def take(rest: int, space: int) -> tuple[int, int, int]:
        start, stop = int(begin[rest]), int(min(length[rest], begin[rest] + space))
        begin[rest] = stop
        unused[rest] = stop < length[rest]
        return rest, start, stop

    while left >= how.window:
        open_ = length - begin
        seed = int(np.argmax(np.where(unused, open_, -1)))
        pieces, space = [take(seed, how.window)], how.window - int(open_[seed])
        if space > 0:
            near = np.where(unused, index.scores(seed), -1.0)
            ranked = np.argsort(-near, kind="stable")
            # All that the window can hold lie within the ranks whose lengths add up to its space.
            enough = int(np.searchsorted(np.cumsum(np.where(unused[ranked], open_[ranked], 0)), space)) + 1
            for rest in ranked[:enough]:
                if unused[rest] and space > 0:
                    pieces.append(take(int(rest), space))
                    space -= pieces[-1][2] - pieces[-1][1]
        left -= sum(b - a for _, a, b in pieces)
        yield pieces
    while left:
        space, pieces = 1 << (left.bit_length() - 1), []
        left -= space
        for rest in np.flatnonzero(unused):
            if space:
                pieces.append(take(int(rest), space))
                space -= pieces[-1][2] - pieces[-1][1]
        yield pieces


def cell_packer(how: Packing, shared, keep_ids: bool) -> Callable:
    """For applyInPandas over the pieces of a cell: the pieces with their sequence and place."""

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        idf, mean_length, narrow = shared.value
        first, number, out = int(key[0]) * CELL_SHARDS, 0, []
        group = group.sort_values(["length", "doc_id", "row", "start"], ascending=[False, True, True, True], na_position="last")
        whole = (group["length"] == how.window).to_numpy()
        for row, doc_id, start, length, code, tokens, rest in group.loc[whole, WHOLE].itertuples(index=False, name=None):
            out.append((row, doc_id, start, length, code, tokens, (first << 32) + number, 0, rest))
            number += 1
        near = group[~whole]
        parts = locality.halves(locality.vectors(near["vec"]), how.shard_pieces) if len(near) else []
        for shard, part in enumerate(parts, first):
            cut, number = near.iloc[part], 0
            rests = [np.frombuffer(r, dtype=narrow) for r in cut["rest"]]
            keys = list(zip(cut["row"], cut["doc_id"], cut["start"], cut["length"], cut["ids_crc32"], cut["doc_tokens"], strict=True))
            for pieces in pack_shard(rests, idf, mean_length, how):
                offset = 0
                for rest, a, b in pieces:
                    row, doc_id, start, length, code, tokens = keys[rest]
                    ids = rests[rest][a:b]
                    out.append((row, doc_id, start + a, b - a, code if b - a == length else crc(ids), tokens, (shard << 32) + number, offset, ids.tobytes() if keep_ids else None))
                    offset += b - a
                number += 1
        names = [*(f.split()[0] for f in PIECE.split(", ")), "sequence_id", "offset", "ids"]
        found = pd.DataFrame(out, columns=names).astype({"doc_id": object, "ids": object})
        if keep_ids:
            found["ids"] = [np.frombuffer(x, dtype=narrow).astype(np.int32) for x in found["ids"]]
        return found if keep_ids else found.drop(columns="ids")

    return run


def pack(docs: DataFrame, how: Packing = Packing(), key: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``, and ``ids`` if wanted."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{key}`").cast("string").alias("doc_id"), whole_text(text).alias("text"))
    found = stage(rows.mapInPandas(tokeniser(how, with_ids), f"{PIECE}, rest binary, token int"), "pack-pieces")
    pieces = found.filter("token < 0").drop("token")
    size = pieces.agg(F.count("*").alias("pieces"), F.count_if(F.col("start") == 0).alias("docs"), F.count_if(F.col("length") < how.window).alias("rests"), F.sum("length").alias("tokens")).first()
    counts = found.filter("token >= 0").groupBy("token").agg(F.sum("doc_tokens").alias("n")).toPandas()
    vocabulary = int(counts["token"].max()) + 1 if len(counts) else 1
    df = np.full(vocabulary, size["docs"], dtype=np.float64)
    df[counts["token"].to_numpy(int)] = counts["n"].to_numpy(float)
    idf = np.maximum(0, np.log((size["docs"] - df + 0.5) / (df + 0.5))).astype(np.float32)
    path = how.tokenizer if "/" in how.tokenizer else public_path(how.tokenizer)
    narrow = "<u2" if max(load(path).get_vocab_size(with_added_tokens=True), how.end_id + 1) <= 1 << 16 else "<u4"
    shared = docs.sparkSession.sparkContext.broadcast((idf, (size["tokens"] or 0) / max(1, size["docs"]), narrow))
    rests, whole = pieces.filter(F.col("length") < how.window), pieces.filter(F.col("length") >= how.window)
    placed, cells = locality.cells(rests, size["rests"], locality.Weights(idf, shared, how.k1, how.b), how.shard_pieces)
    dealt = F.pmod(F.xxhash64("doc_id", "start", "doc_tokens", "row"), F.lit(1 + (size["pieces"] - size["rests"]) // (4 * how.shard_pieces)))
    placed = placed.unionByName(whole.select("*", (F.lit(cells) + dealt).alias("cell"), F.lit(None).cast("binary").alias("vec")))
    schema = f"{PIECE}, sequence_id long, offset long" + (", ids array<int>" if with_ids else "")
    packed = placed.groupBy("cell").applyInPandas(cell_packer(how, shared, with_ids), schema)
    kind = docs.schema[key].dataType
    return packed.select(F.col("doc_id").cast(kind).alias("doc_id"), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *["ids"] * with_ids)
