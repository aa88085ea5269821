"""N-gram Jaccard join by MinHash banding.

1. Every text's words (runs of non-white characters) give its set of five-word shingles, a MinHash
   signature, and band hashes; texts with equal words form a class, and only one row of a class
   goes on. Bands and rows come from the wanted recall at the threshold.
2. Class numbers meet by band hash; buckets of one are dropped. A bucket is cut into blocks of
   bounded size, and each pair of blocks is a group of its own, so that no bucket is ever held in one
   task. A pair that shares several bands is looked at in the first of them only. Groups hand on one
   row per class with the partners to verify, never a row per pair.
3. Shingle sets are made again from the texts of just those classes (a broadcast bitmap of fixed
   largest size picks the rows before their texts are shuffled) and meet in the same groups, where
   every candidate pair is verified on its full sets. Links are added up per class.
4. Links are also reduced to a spanning forest in each group, whose connected components are the
   groups of near duplicates.

Defined cases: a text of one to four words has one shingle, its words; null, empty and blank texts
have no shingle, link with nothing and are groups of their own; repeated rows are copies of each
other; rows with equal ids are told apart by their words; extra columns are not read by
``ngram_join`` and kept by ``drop_near_duplicates``. Shingles are compared as 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmart.llm.common import fresh, whole_text
from creditmart.llm.components import connected_components
from creditmart.llm.exact_dedup import filter_bits, flag_repeats, slots_as_bitmaps
from creditmart.sources.stage import stage

SHINGLE = 5
THRESHOLD = 0.8
RECALL = 0.9999
HASHES = 128
SEED = 20240229
BLOCK_ROWS = 256
BLOCK_SHINGLES = 1 << 20
CACHE_SIZE = 300_000
WHITE = b" \t\n\x0b\x0c\r"


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, hashes: int = HASHES) -> tuple[int, int]:
    """(bands, rows a band): the most rows with which a pair at the threshold still meets with the wanted probability."""
    fits = [r for r in range(1, hashes + 1) if 1 - (1 - threshold**r) ** (hashes // r) >= recall]
    if not fits:
        raise ValueError("no banding of that many hashes reaches the recall")
    return hashes // fits[-1], fits[-1]


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        value = xxhash.xxh64_intdigest(word)
        if len(self) >= CACHE_SIZE:
            self.clear()
        if len(word) <= 64:
            self[word] = value
        return value


def words_of(text: str) -> list[bytes]:
    """The words as UTF-8; bytes split at exactly the six ASCII white characters."""
    return text.encode("utf-8", "surrogatepass").split()


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def shingles(words: list[bytes], hashes: _WordHashes) -> np.ndarray:
    """The sorted set of shingle hashes."""
    n = len(words)
    if n == 0:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=n)
    width = min(n, SHINGLE)
    total = np.full(n - width + 1, width, dtype=np.uint64)
    for k in range(width):
        total = total * np.uint64(0x9E3779B97F4A7C15) + _mixed(h[k : n - width + 1 + k])
    return np.unique(_mixed(total))


def band_hashes(found: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One hash per band of the MinHash signature; the band's number is part of it."""
    random = np.random.Generator(np.random.PCG64(SEED))
    factors = random.integers(1, 2**63, (bands * rows, 1), dtype=np.uint64) | np.uint64(1)
    lowest = np.full(bands * rows, np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(found), 4096):
        part = found[None, i : i + 4096] * factors
        part ^= part >> np.uint64(29)
        np.minimum(lowest, part.min(axis=1), out=lowest)
    signature = lowest.reshape(bands, rows)
    total = np.arange(bands, dtype=np.uint64) + np.uint64(1)
    for r in range(rows):
        total = _mixed(total * np.uint64(0x9E3779B97F4A7C15) + signature[:, r])
    return total.view(np.int64)


def _digest(words: list[bytes]) -> str:
    import xxhash

    return xxhash.xxh3_128_hexdigest(b" ".join(words))


def signer(bands: int, rows: int) -> Callable:
    """For mapInPandas over batches with a text: the words' digest, the number of shingles, the band hashes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = _WordHashes()
        for batch in batches:
            digests, sizes, signatures = [], [], []
            for text in batch["text"]:
                words = words_of(text)
                found = shingles(words, hashes)
                digests.append(_digest(words))
                sizes.append(len(found))
                signatures.append(band_hashes(found, bands, rows) if len(words) >= SHINGLE else np.zeros(0, np.int64))
            yield batch.drop(columns="text").assign(digest=pd.Series(digests, dtype=object), n_shingles=np.array(sizes, np.int64), bands=pd.Series(signatures, dtype=object))

    return run


def _whole_groups(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Batches of rows sorted by (bucket, i, j), cut between groups, with where the groups begin.

    Most groups have two or three rows; taking many at once spares a call for each. A group is at most
    two blocks, so what is held over from batch to batch is bounded.
    """
    held = None
    for batch in batches:
        if held is not None:
            batch = pd.concat([held, batch], ignore_index=True)
        if len(batch):
            starts = np.flatnonzero(_begins(batch))
            held = batch.iloc[starts[-1] :].reset_index(drop=True)
            if len(starts) > 1:
                yield batch.iloc[: starts[-1]], starts[:-1]
    if held is not None and len(held):
        yield held, np.zeros(1, np.int64)


def _begins(rows: pd.DataFrame) -> np.ndarray:
    key = rows[["bucket", "i", "j"]].to_numpy(np.int64)
    return np.r_[True, (key[1:] != key[:-1]).any(axis=1)]


def candidates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For mapInPandas over sorted pairs of blocks: per class the partners whose first common band this is."""
    for rows, starts in _whole_groups(batches):
        ends = np.r_[starts[1:], len(rows)]
        cids, block, band = (rows[c].to_numpy(np.int64) for c in ("cid", "block", "band"))
        apart = (rows["i"] != rows["j"]).to_numpy()
        bands = np.stack(rows["bands"].to_list())
        before = np.arange(bands.shape[1])
        places: list[int] = []
        partners: list[np.ndarray] = []
        nobody = np.zeros(0, np.int64)
        # Groups of two, all at once.
        two = starts[ends - starts == 2]
        met = ((bands[two] == bands[two + 1]) & (before < band[two, None])).any(axis=1) | (apart[two] & (block[two] == block[two + 1]))
        for x in two[~met].tolist():
            places += (x, x + 1)
            partners += (cids[x + 1 : x + 2], nobody)
        for a, b in zip(starts[ends - starts > 2].tolist(), ends[ends - starts > 2].tolist(), strict=True):
            found: dict[int, np.ndarray] = {}
            for x in range(a, b - 1):
                fresh_pair = ~(bands[x + 1 : b, : band[a]] == bands[x, : band[a]]).any(axis=1)
                if apart[a]:
                    fresh_pair &= block[x + 1 : b] != block[x]
                if fresh_pair.any():
                    found[x] = x + 1 + np.flatnonzero(fresh_pair)
            for x in sorted({*found, *(int(y) for others in found.values() for y in others)}):
                places.append(x)
                partners.append(cids[found[x]] if x in found else nobody)
        out = rows.iloc[places][["bucket", "i", "j", "cid"]].reset_index(drop=True)
        yield out.assign(partners=pd.Series(partners, dtype=object))


def verifier(threshold: float) -> Callable:
    """For mapInPandas over the same groups with shingle sets: links per class, and one edge of a spanning forest."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows, starts in _whole_groups(batches):
            out: list[tuple[int, int, int]] = []
            columns = (rows["cid"].tolist(), rows["copies"].tolist(), rows["partners"].tolist(), rows["shingles"].tolist())
            for a, b in zip(starts.tolist(), np.r_[starts[1:], len(rows)].tolist(), strict=True):
                out += _verified(threshold, *(c[a:b] for c in columns))
            yield pd.DataFrame(out, columns=["cid", "links", "root"], dtype="int64")

    return run


def _verified(threshold: float, cids: list, copies: list, partners: list, shingle_sets: list) -> list[tuple[int, int, int]]:
    sets = {c: np.frombuffer(s, dtype=np.uint64) for c, s in zip(cids, shingle_sets, strict=True)}
    sizes, links, root = dict(zip(cids, copies, strict=True)), dict.fromkeys(sets, 0), {c: c for c in sets}

    def find(c: int) -> int:
        while root[c] != c:
            root[c] = root[root[c]]
            c = root[c]
        return c

    for x, others in dict(zip(cids, partners, strict=True)).items():
        for y in map(int, others):
            small, large = sorted((sets[x], sets[y]), key=len)
            if len(small) < threshold * len(large):
                continue
            at = np.minimum(np.searchsorted(large, small), len(large) - 1)
            both = int(np.count_nonzero(large[at] == small))
            if both >= threshold * (len(small) + len(large) - both) - 1e-9:
                links[x] += sizes[y]
                links[y] += sizes[x]
                a, b = find(x), find(y)
                root[max(a, b)] = min(a, b)
    return [(c, n, find(c)) for c, n in links.items() if n]


def _shingler(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hashes = _WordHashes()
    for batch in batches:
        words = [words_of(t) for t in batch["text"]]
        same = [_digest(w) == d for w, d in zip(words, batch["digest"], strict=True)]
        sets = [shingles(w, hashes).tobytes() for w, s in zip(words, same, strict=True) if s]
        yield pd.DataFrame({"cid": batch["cid"][same].to_numpy(), "shingles": pd.Series(sets, dtype=object)})


def _sets(docs: DataFrame, classes: DataFrame, wanted: DataFrame, key: str, text: str) -> DataFrame:
    """``cid, shingles`` of the wanted classes, from the text of one row of each."""
    needed = stage(wanted.select("cid").distinct().join(classes, "cid").select("cid", "digest", "rep"), "join-needed")
    bits = filter_bits(needed.count())
    id_ = F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("none"))
    rows = docs.select(id_.alias("id"), whole_text(text).alias("text"))
    near = flag_repeats(rows, "id", stage(slots_as_bitmaps(needed, F.coalesce(F.col("rep").cast("string"), F.lit("none")), bits), "join-bitmaps"), bits, "maybe")
    joined = near.filter("maybe").join(needed, F.col("id") == F.coalesce(F.col("rep").cast("string"), F.lit("none")))
    sets = joined.select("cid", "digest", "text").mapInPandas(_shingler, "cid long, shingles binary")
    # Rows that repeat their class's id (or lack one) give its set again.
    return sets.groupBy("cid").agg(F.first("shingles").alias("shingles"))


def link_classes(docs: DataFrame, key: str, text: str, threshold: float, recall: float, block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, DataFrame]:
    """The rows' keys and classes (``row, doc_id, digest``), and the classes (``digest, rep, copies, links, component``)."""
    bands, per_band = choose_bands(threshold, recall)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{key}`").cast("string").alias("doc_id"), whole_text(text).alias("text"))
    signed = stage(rows.mapInPandas(signer(bands, per_band), "row long, doc_id string, digest string, n_shingles long, bands array<long>"), "join-signatures")
    signed = signed.withColumn("doc_id", F.col("doc_id").cast(docs.schema[key].dataType))
    order = F.struct(F.col("doc_id").isNull().alias("a"), F.col("doc_id").alias("b"))
    grouped = signed.filter("n_shingles > 0").groupBy("digest").agg(
        F.min(order)["b"].alias("rep"), F.count("*").alias("copies"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"),
    )
    classes = stage(grouped.select(F.monotonically_increasing_id().alias("cid"), "*"), "join-classes")
    placed = classes.select("cid", "n_shingles", F.posexplode("bands").alias("band", "bucket"))
    buckets = stage(
        placed.groupBy("bucket").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("size")).filter("n > 1")
        .select("bucket", F.greatest(F.ceil(F.col("n") / block_rows), F.ceil(F.col("size") / BLOCK_SHINGLES)).alias("blocks")),
        "join-buckets",
    )
    members = stage(placed.join(buckets, "bucket").select("bucket", "band", "cid", "blocks", F.pmod(F.xxhash64("cid", "bucket"), "blocks").alias("block")), "join-members")
    others = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    in_pairs = members.join(classes.select("cid", "bands"), "cid").select("bucket", "band", "cid", "block", "bands", F.explode(others).alias("other"))
    pairs = in_pairs.select("bucket", "band", "cid", "block", "bands", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    together = lambda df: df.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "cid")
    wanted = stage(together(pairs).mapInPandas(candidates, "bucket long, i long, j long, cid long, partners array<long>"), "join-candidates")
    sets = stage(_sets(docs, classes, wanted, key, text), "join-sets")
    with_sets = wanted.join(sets, "cid").join(classes.select("cid", "copies"), "cid")
    links = stage(together(with_sets).mapInPandas(verifier(threshold), "cid long, links long, root long"), "join-links")
    components = connected_components(links.filter("cid <> root"), "cid", "root")
    least = F.min(F.struct(F.col("rep").isNull().alias("a"), F.col("rep").alias("b")))
    joined = (
        classes.select("cid", "digest", "rep", "copies")
        .join(links.groupBy("cid").agg(F.sum("links").alias("links")), "cid", "left")
        .join(components.withColumnsRenamed({"node": "cid"}), "cid", "left")
        .withColumn("component", F.coalesce("component", "cid"))
    )
    joined = stage(joined, "join-linked")
    names = joined.groupBy("component").agg(least["b"].alias("class_id"))
    return signed.select("row", "doc_id", "digest", "n_shingles"), stage(joined.join(names, "component"), "join-result")


def ngram_join(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One row per document: ``doc_id``; ``class_id``, the smallest id of its group of near duplicates; ``n_links``, the
    number of other documents at the threshold or above; ``rep_id``, the smallest id with the same words; ``copies``, how many have them."""
    rows, classes = link_classes(docs, key, text, threshold, recall)
    joined = rows.join(classes.select("digest", "rep", "copies", "links", "class_id"), "digest", "left")
    alone = F.col("n_shingles") == 0
    return joined.select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, F.lit(0)).otherwise(F.col("copies") - 1 + F.coalesce("links", F.lit(0))).cast("long").alias("n_links"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("rep")).alias("rep_id"), F.coalesce("copies", F.lit(1)).cast("long").alias("copies"),
    )


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """The input rows with all their columns, one of each group of near duplicates: the one with the smallest id."""
    own, kept = fresh(docs, "join_row", "kept_row")
    numbered = stage(docs.withColumn(own, F.monotonically_increasing_id()), "join-documents")
    rows, classes = link_classes(numbered.select(F.col(own).alias("join_key"), F.col(f"`{text}`").alias("text")), "join_key", "text", threshold, recall)
    ids = numbered.select(F.col(own).alias("doc_id"), F.col(f"`{key}`").alias("id"))
    first = F.min(F.struct(F.col("id").isNull().alias("a"), F.col("id").alias("b"), F.col("doc_id").alias("c")))
    stay = (
        rows.filter("n_shingles > 0").join(classes.select("digest", "component"), "digest").join(ids, "doc_id")
        .groupBy("component").agg(first["c"].alias(kept)).select(kept)
    )
    stay = stay.union(rows.filter("n_shingles = 0").select("doc_id"))
    return numbered.join(stay, F.col(own) == F.col(kept), "left_semi").drop(own)
