"""Removal of long strings that an earlier document has, by blockwise suffix grouping over a difference cover.

A byte goes if it lies in a ``LENGTH``-byte string that also starts in a document with a smaller id.

1. Texts that equal an earlier document's go whole (found as in ``exact_dedup``: only possibly repeated
   rows are shuffled). The others are written once, in blocks of bounded size.
2. Cover samples. D is a perfect difference cover modulo V: for any two positions i and j there is a
   d < V with i + d and j + d both at a place of D modulo V. So of two equal strings of LENGTH bytes,
   some sample of one names the same LENGTH - V + 1 bytes as a sample of the other. Each block submits
   the sorted distinct names of its samples; every name bucket, one at a time, answers which names two
   documents have. Only |D| of V suffixes take part, and no name comes with its text.
3. Suffixes. Only a suffix with such a sample among its first V bytes can have a long tie; the others are
   settled. The suffixes left submit the name of their LENGTH-byte prefix and the smallest document of
   the block that has it; each suffix bucket is sorted, one at a time, and answers, in a bit per prefix,
   whether a document before that one has it.
4. Blocks mark, merge and cut the bytes.

What the contract asks of the sorted suffixes is only which are equal on LENGTH bytes and which of
these comes from the first document. Names are therefore hashes (48 bits for samples, where a
collision only costs work; 64 bits for prefixes), buckets are ranges of them, and bytes of equal order
need never be fetched from other blocks: a bucket is a plain array, as large as its share of the names.

Defined cases: null counts as empty; texts of under LENGTH bytes lose nothing, and equal copies of
those neither; rows with the same id do not remove from each other; a null id comes after all ids;
matches do not cross documents; extra columns are not read; an empty table gives an empty result.
A hot text or passage is one name a block in the exchange, however often a block has it. A task holds
one block (``block_rows`` rows, hashed in slices) or one bucket (about ``BUCKET_NAMES`` names).
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmart.llm.common import whole_text
from creditmart.llm.exact_dedup import filter_bits, flag_repeats, repeat_filter
from creditmart.sources.stage import stage, stage_table

LENGTH = 50
#: A perfect difference set, every non-zero difference modulo V once.
V, COVER = 21, (0, 1, 4, 14, 16)
SAMPLE = LENGTH - V + 1
BUCKET_NAMES = 1 << 21
BLOCK_ROWS = 1_024
SLICE = 1 << 20
LAST = np.iinfo(np.int64).max  # stands for a null id
FACTOR = 0x9E3779B97F4A7C15
BYTES = np.random.Generator(np.random.PCG64(50)).integers(1, 2**63, 256, dtype=np.uint64)
REPLY = "block long, kind int, bucket int, bits binary"


def _joined(a: np.ndarray, wide: int, b: np.ndarray, more: int) -> np.ndarray:
    """Hashes of the strings of ``wide`` bytes and the ``more`` bytes after them."""
    n = min(len(a), len(b) - wide)
    return a[:n] * np.uint64(pow(FACTOR, more, 1 << 64)) + b[wide : wide + n]


def rolling(data: np.ndarray, width: int) -> np.ndarray:
    """A hash of the ``width`` bytes from every position, by doubling."""
    if len(data) < width:
        return np.zeros(0, np.uint64)
    part, size, done, covered = BYTES[data], 1, None, 0
    while True:
        if width & size:
            done, covered = (part, size) if done is None else (_joined(done, covered, part, size), covered + size)
        if covered == width:
            break
        part, size = _joined(part, size, part, size), size * 2
    done = (done ^ (done >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    done = (done ^ (done >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return done ^ (done >> np.uint64(33))


class Block:
    """The texts of a block as one array of bytes, documents in the order of their ids."""

    def __init__(self, rows: pd.DataFrame):
        rows = rows.sort_values(["doc_id", "place"])
        texts = [t.encode("utf-8", "surrogatepass") for t in rows["text"]]
        self.rows, self.texts = rows, texts
        self.data = np.frombuffer(b"".join(texts), dtype=np.uint8)
        self.ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
        self.ids = rows["doc_id"].to_numpy(np.int64)

    def doc_of(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, positions, side="right")

    def fitting(self, positions: np.ndarray, width: int) -> np.ndarray:
        """The positions whose string of that width ends inside their document."""
        return positions[positions + width <= self.ends[self.doc_of(positions)]] if len(positions) else positions

    def hashes(self, positions: np.ndarray, width: int) -> np.ndarray:
        """Of the strings at ascending positions, slice by slice."""
        parts = []
        for start in range(0, len(self.data), SLICE):
            a, b = np.searchsorted(positions, (start, start + SLICE))
            if b > a:
                parts.append(rolling(self.data[start : start + SLICE + width - 1], width)[positions[a:b] - start])
        return np.concatenate(parts) if parts else np.zeros(0, np.uint64)

    def samples(self) -> np.ndarray:
        base = np.arange(0, len(self.data), V, dtype=np.int64)
        every = (base[:, None] + np.array(COVER)).ravel()
        return self.fitting(every[every < len(self.data)], SAMPLE)

    def sample_names(self, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sample positions, the distinct names ascending, each sample's place among them, and which names two documents have."""
        at = self.samples()
        names, place = np.unique(self.hashes(at, SAMPLE) >> np.uint64(64 - bits), return_inverse=True)
        doc = self.ids[self.doc_of(at)] if len(at) else at
        low, high = np.full(len(names), LAST), np.full(len(names), -LAST - 1)
        np.minimum.at(low, place, doc)
        np.maximum.at(high, place, doc)
        return at, names, place, low < high

    def suffixes(self, repeated: np.ndarray, at: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The positions with a repeated sample among their first V bytes."""
        mark = np.zeros(len(self.data) + 1, dtype=np.int32)
        hit = at[repeated[place]]
        np.add.at(mark, np.maximum(hit - (V - 1), 0), 1)
        np.add.at(mark, hit + 1, -1)
        return self.fitting(np.flatnonzero(np.cumsum(mark[:-1]) > 0), LENGTH)

    def prefixes(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The distinct prefix names ascending, each suffix's place among them, and the smallest id that has each."""
        names, first, place = np.unique(self.hashes(at, LENGTH), return_index=True, return_inverse=True)
        return names, place, self.ids[self.doc_of(at[first])]  # documents lie in the order of their ids


def name_bits(names: int) -> int:
    """Bits of a sample name, whole bytes: twelve more than it takes to number all names, so that chance repeats stay rare at every size."""
    return min(64, 8 * -(-(max(names, 1).bit_length() + 12) // 8))


def _edges(names: np.ndarray, buckets: int, bits: int) -> np.ndarray:
    """Where each bucket of ascending names begins; buckets are equal ranges of the upper 16 bits."""
    bucket = ((names >> np.uint64(bits - 16)) * np.uint64(buckets)) >> np.uint64(16)
    return np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))


def _packed(names: np.ndarray, bits: int) -> bytes:
    """Upper 16 bits first: ascending, so the shuffle's compression takes most of them away."""
    high = (names >> np.uint64(bits - 16)).astype("<u2")
    return high.tobytes() + names.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : (bits - 16) // 8].tobytes()


def _unpacked(data: bytes, n: int, bits: int) -> np.ndarray:
    wide, rest = np.zeros((n, 8), np.uint8), (bits - 16) // 8
    wide[:, :rest] = np.frombuffer(data, np.uint8, n * rest, 2 * n).reshape(n, rest)
    return wide.view("<u8").ravel() | (np.frombuffer(data, "<u2", n).astype(np.uint64) << np.uint64(bits - 16))


class IdTable:
    """Ids as places in a block's ascending list of ids, in as few bits as the list needs."""

    def __init__(self, ids: np.ndarray):
        self.ids = np.unique(ids)
        gaps = np.diff(self.ids).astype(np.uint64)
        width = next(w for w in (2, 4, 8) if not len(gaps) or int(gaps.max()) < 1 << 8 * w)
        self.head = np.array([len(self.ids), width, self.ids[0] if len(self.ids) else 0], "<i8").tobytes() + gaps.astype(f"<u{width}").tobytes()
        self.bits = max(1, (max(len(self.ids), 1) - 1).bit_length())

    def pack(self, ids: np.ndarray) -> bytes:
        place = np.searchsorted(self.ids, ids)
        return self.head + np.packbits((place[:, None] >> np.arange(self.bits)) & 1).tobytes()

    @staticmethod
    def unpack(data: bytes, n: int) -> np.ndarray:
        count, width, first = map(int, np.frombuffer(data, "<i8", 3))
        gaps = np.frombuffer(data, f"<u{width}", max(count - 1, 0), 24)
        ids = first + np.r_[np.int64(0), np.cumsum(gaps.astype(np.int64))]
        bits = max(1, (max(count, 1) - 1).bit_length())
        places = np.unpackbits(np.frombuffer(data, np.uint8, offset=24 + gaps.nbytes), count=n * bits).reshape(n, bits)
        return ids[(places.astype(np.int64) << np.arange(bits)).sum(axis=1)]


def name_submitter(buckets: int, wide: int):
    """For applyInPandas over a block: its sample names by bucket, each with a bit: whether two documents have it."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        _, names, _, several = Block(rows).sample_names(wide)
        edges = _edges(names, buckets, wide)
        full = np.flatnonzero(np.diff(edges))
        out = [(int(rows["block"].iloc[0]), int(k), int(b - a), _packed(names[a:b], wide), np.packbits(several[a:b]).tobytes()) for k in full for a, b in [edges[k : k + 2]]]
        return pd.DataFrame(out, columns=["block", "bucket", "n", "names", "extra"]).astype({"names": object, "extra": object})

    return run


def name_bucket(wide: int):
    """For applyInPandas over a bucket: to each block, which of its names two documents have."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        sizes = rows["n"].to_numpy()
        names = np.concatenate([_unpacked(d, n, wide) for d, n in zip(rows["names"], sizes, strict=True)])
        several = np.concatenate([np.unpackbits(np.frombuffer(e, np.uint8), count=n) for e, n in zip(rows["extra"], sizes, strict=True)])
        order = np.argsort(names, kind="stable")
        ordered = names[order]
        same = np.r_[False, ordered[1:] == ordered[:-1]]
        yes = np.zeros(len(names), bool)
        yes[order] = same | np.r_[same[1:], False]
        return _replies(rows, sizes, yes | (several > 0), 0)

    return run


def _replies(rows: pd.DataFrame, sizes: np.ndarray, yes: np.ndarray, kind: int) -> pd.DataFrame:
    at = np.r_[0, np.cumsum(sizes)]
    bits = [np.packbits(yes[a:b]).tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]
    return pd.DataFrame({"block": rows["block"].to_numpy(), "kind": np.int32(kind), "bucket": rows["bucket"].to_numpy(), "bits": pd.Series(bits, dtype=object)})


def _answers(replies: pd.DataFrame, kind: int, names: np.ndarray, buckets: int, bits: int) -> np.ndarray:
    """A block's replies as one boolean for each of its names."""
    yes, edges = np.zeros(len(names), bool), _edges(names, buckets, bits)
    for bucket, packed in replies.loc[replies["kind"] == kind, ["bucket", "bits"]].itertuples(index=False, name=None):
        a, b = edges[bucket : bucket + 2]
        yes[a:b] = np.unpackbits(np.frombuffer(packed, np.uint8), count=b - a) > 0
    return yes


def _suffixes_left(rows: pd.DataFrame, replies: pd.DataFrame, buckets: int, wide: int) -> tuple[Block, np.ndarray]:
    block = Block(rows)
    at, names, place, _ = block.sample_names(wide)
    return block, block.suffixes(_answers(replies, 0, names, buckets, wide), at, place)


def prefix_submitter(buckets: int, wide: int):
    """For cogroup(text, replies): the block's prefix names by bucket, each with the smallest id that has it."""

    def run(rows: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows):
            block, at = _suffixes_left(rows, replies, buckets, wide)
            names, _, first = block.prefixes(at)
            edges = _edges(names, buckets, 64)
            table = IdTable(first)
            for k in np.flatnonzero(np.diff(edges)):
                a, b = edges[k : k + 2]
                out.append((int(rows["block"].iloc[0]), int(k), int(b - a), _packed(names[a:b], 64), table.pack(first[a:b])))
        return pd.DataFrame(out, columns=["block", "bucket", "n", "names", "extra"]).astype({"block": "int64", "bucket": "int32", "n": "int64", "names": object, "extra": object})

    return run


def prefix_bucket(rows: pd.DataFrame) -> pd.DataFrame:
    """For applyInPandas over a suffix bucket: sorted once; to each block, whether a smaller id has a prefix."""
    sizes = rows["n"].to_numpy()
    names = np.concatenate([_unpacked(d, n, 64) for d, n in zip(rows["names"], sizes, strict=True)])
    ids = np.concatenate([IdTable.unpack(e, n) for e, n in zip(rows["extra"], sizes, strict=True)])
    order = np.argsort(names, kind="stable")
    starts = np.flatnonzero(np.r_[True, names[order][1:] != names[order][:-1]])
    lowest = np.repeat(np.minimum.reduceat(ids[order], starts), np.diff(np.r_[starts, len(order)]))
    yes = np.zeros(len(names), bool)
    yes[order] = ids[order] > lowest
    return _replies(rows, sizes, yes, 1)


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def cutter(buckets: int, wide: int, with_text: bool):
    """For cogroup(text, replies): the block's documents without the bytes that go."""

    def run(rows: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows):
            block, at = _suffixes_left(rows, replies, buckets, wide)
            names, place, first = block.prefixes(at)
            gone = _answers(replies, 1, names, buckets, 64)[place] | (block.ids[block.doc_of(at)] > first[place]) if len(at) else np.zeros(0, bool)
            mark = np.zeros(len(block.data) + 1, dtype=np.int32)
            np.add.at(mark, at[gone], 1)
            np.add.at(mark, at[gone] + LENGTH, -1)
            covered = np.cumsum(mark[:-1]) > 0
            for (doc_id, place_), end, text in zip(block.rows[["doc_id", "place"]].itertuples(index=False, name=None), block.ends, block.texts, strict=True):
                cut = covered[end - len(text) : end]
                spans = int(np.count_nonzero(cut[1:] & ~cut[:-1]) + cut[0]) if len(cut) else 0
                kept = np.frombuffer(text, np.uint8)[~cut].tobytes() if spans else text
                out.append((place_, doc_id, len(text), len(text) - len(kept), spans, hashlib.sha256(kept).hexdigest(), kept))
        names_ = ["place", *(f.split()[0] for f in RESULT.split(", ")), "kept"]
        found = pd.DataFrame(out, columns=names_).astype({"kept_sha256": object, "kept": object} | dict.fromkeys(names_[:5], "int64"))
        return found if with_text else found.drop(columns="kept")

    return run


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", block_rows: int = BLOCK_ROWS, bucket_names: int = BUCKET_NAMES, with_text: bool = False) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``, and the bytes ``kept`` if wanted. Ids are integers."""
    spark = docs.sparkSession
    own = docs.select(F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(int(LAST))).alias("doc_id"), whole_text(text).alias("text"))
    own = own.withColumn("digest", F.sha2("text", 256))
    digests = stage(own.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n")), "suffix-digests")
    total = digests.agg(F.count("*").alias("rows"), F.sum("n").alias("bytes")).first()
    bits = filter_bits(total["rows"])
    bitmaps = stage(repeat_filter(digests, "digest", bits), "suffix-filter")
    firsts = stage(
        flag_repeats(digests, "digest", bitmaps, bits, "maybe").filter("maybe").groupBy("digest").agg(F.min("doc_id").alias("first")).withColumnRenamed("digest", "first_digest"),
        "suffix-firsts",
    )
    flagged = flag_repeats(own, "digest", bitmaps, bits, "maybe")
    alone = flagged.filter(~F.col("maybe")).select("doc_id", "text")
    left = flagged.filter("maybe").select("doc_id", "text", "digest").join(firsts, (F.col("digest") == F.col("first_digest")) & (F.col("doc_id") == F.col("first")), "left_semi")
    copies = flag_repeats(digests, "digest", bitmaps, bits, "maybe").filter("maybe").join(firsts, F.col("digest") == F.col("first_digest")).filter("doc_id > first")
    long = F.col("n") >= LENGTH
    copied = copies.select(
        "doc_id", F.col("n").alias("n_bytes"), F.when(long, F.col("n")).otherwise(F.lit(0)).cast("long").alias("n_removed"),
        long.cast("long").alias("n_spans"), F.when(long, F.sha2(F.lit(""), 256)).otherwise(F.col("digest")).alias("kept_sha256"), long.alias("emptied"), "digest",
    )
    place = F.monotonically_increasing_id()
    rows = alone.union(left.select("doc_id", "text")).withColumn("place", place).withColumn("block", F.floor(F.col("place") / block_rows))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    blocks = stage_table(rows, f"suffix_blocks_{uuid.uuid4().hex}", parts, "block")
    samples = (total["bytes"] or 0) * len(COVER) // V
    wide, buckets = name_bits(samples), int(min(1 << 16, max(16, -(-samples // bucket_names))))
    submission = "block long, bucket int, n long, names binary, extra binary"
    of_block, texts = lambda df: df.groupBy("block"), blocks.select("block", "place", "doc_id", "text")
    names = of_block(texts).applyInPandas(name_submitter(buckets, wide), submission)
    first_replies = stage(names.groupBy("bucket").applyInPandas(name_bucket(wide), REPLY), "suffix-names")
    prefixes = of_block(texts).cogroup(of_block(first_replies)).applyInPandas(prefix_submitter(buckets, wide), submission)
    second_replies = stage(prefixes.groupBy("bucket").applyInPandas(prefix_bucket, REPLY), "suffix-prefixes")
    schema = f"place long, {RESULT}" + (", kept binary" if with_text else "")
    cut = of_block(texts).cogroup(of_block(first_replies.union(second_replies))).applyInPandas(cutter(buckets, wide, with_text), schema).drop("place")
    if with_text:
        # A short copy keeps its bytes; they are its text, below LENGTH bytes.
        short = flagged.filter(F.col("maybe") & (F.octet_length("text") < LENGTH)).select("digest", F.col("text").cast("binary").alias("kept")).dropDuplicates(["digest"])
        copied = copied.join(short, "digest", "left").withColumn("kept", F.when(F.col("emptied"), F.lit(b"")).otherwise(F.col("kept")))
    found = cut.unionByName(copied.drop("emptied", "digest"))
    return found.withColumn("doc_id", F.when(F.col("doc_id") != int(LAST), F.col("doc_id")))
