"""Best-fit packing: every document's tokens into as few sequences of at most ``window`` tokens as it can.

1. Each document becomes token ids with an end id; only one longer than a window is cut, into windows
   and a last shorter piece. No ids are kept: a piece is its length and a checksum.
2. Pieces of equal length are interchangeable, so what is packed is the number of pieces of each length:
   at most ``window`` numbers, whatever the size of the table. The driver plans over them (``plan``):
   lengths from the longest down are seeds. Which single lengths, sums of two and sums of three are available is
   indexed, and brought up to date as a length runs out; a combination that fills the seed's gap exactly
   is consumed as often as the counts allow, in one step. Gaps that three pieces cannot fill take
   the longest piece that leaves one which they can. Seeds without an exact filling wait; what is left in the
   end is packed best fit, longest first, equal gaps at a time.
3. A piece's number among those of its length is its number in its task and length, plus the pieces of earlier
   tasks (a table of a row per task and length). The plan says, for ranges of such numbers,
   which sequence a piece goes to and where.

Defined cases: null, empty and blank texts have the end id alone; repeated rows are packed each; extra columns
are not read; an empty table gives an empty result. Which of several equally long pieces goes where
follows the order of the table's partitions.

Scale: tokens never leave their task, and pieces are joined once with the numbers of their task. Collected: the count of
each length. Broadcast: the plan, whose steps each use up a length or a gap, not a piece.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from creditmart.llm.common import whole_text
from creditmart.llm.token_units import document_encoder, kept, public_path
from creditmart.sources.stage import stage

PIECE = "doc_id string, piece int, start long, length int, ids_crc32 long, task int, number long"
NUMBER_BITS = 44  # of a length's piece numbers


@dataclass(frozen=True)
class BestFit:
    """Parameters of a packing."""

    tokenizer: str = "word_bpe_49k.json"
    window: int = 4_096
    end_id: int = 1
    cache_size: int = 1_000_000


class Supply:
    """How many pieces of each length there are, and which sums of one, two and three of the lengths.

    ``one`` says which lengths there are; ``two, three`` count the ordered ways to make each sum from those of ``least`` and more
    (``part``). How many pieces a way needs is checked where it is used.
    """

    def __init__(self, count: np.ndarray, least: int):
        self.count = count.astype(np.int64)
        self.one = self.count > 0
        size = len(count)
        self.part = self.one.astype(np.int64)
        self.part[:least] = 0
        self.two, self.three = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for source, sums in ((self.part, self.two), (self.two, self.three)):
            for a in np.flatnonzero(self.part):
                sums[a:] += source[: size - a]

    def use(self, length: int, pieces: int) -> None:
        self.count[length] -= pieces
        if self.count[length]:
            return
        a, size = length, len(self.count)
        self.one[a] = False
        if self.part[a]:
            self.three[a:] -= 3 * self.two[: size - a]
            self.two[a:] -= 2 * self.part[: size - a]
            if 2 * a < size:
                self.three[2 * a :] += 3 * self.part[: size - 2 * a]
                self.two[2 * a] += 1
            if 3 * a < size:
                self.three[3 * a] -= 1
            self.part[a] = 0

    def _has(self, lengths: Iterable[int], held: Counter) -> bool:
        return all(self.count[x] - held[x] >= n for x, n in Counter(lengths).items())

    def _pair(self, gap: int, held: Counter) -> tuple[int, ...] | None:
        if self.two[gap]:
            a = np.arange((gap + 1) // 2, gap)
            for x in a[(self.part[a] > 0) & (self.part[gap - a] > 0)].tolist():
                if self._has((x, gap - x), held):
                    return x, gap - x
        return None

    def exact(self, gap: int, held: Counter) -> tuple[int, ...] | None:
        """One, two or three lengths of this sum, as even as they come, besides the pieces held."""
        if self.one[gap] and self._has((gap,), held):
            return (gap,)
        pair = self._pair(gap, held)
        if pair or not self.three[gap]:
            return pair
        a = np.arange((gap + 2) // 3, gap - 1)
        for x in a[(self.part[a] > 0) & (self.two[gap - a] > 0)].tolist():
            if self.count[x] > held[x]:
                rest = self._pair(gap - x, held + Counter((x,)))
                if rest:
                    return x, *rest
        return None

    def filling(self, seed: int) -> Counter | None:
        """What fills a sequence with a seed exactly: one to three pieces more, after the longest ones where it takes more than three."""
        held = Counter((seed,))
        gap = len(self.count) - 1 - seed
        while gap:
            found = self.exact(gap, held)
            if found:
                return held + Counter(found)
            free = np.flatnonzero(self.part[: gap + 1])
            free = free[self.count[free] > [held[x] for x in free.tolist()]]
            if not len(free):
                return None
            rest = gap - free
            promising = free[self.one[rest] | (self.two[rest] > 0) | (self.three[rest] > 0)]
            length = int((promising if len(promising) else free)[-1])
            pieces = max(1, min(int(self.count[length]) - held[length], gap // length - 4))
            held[length] += pieces
            gap -= pieces * length
        return held


def _best_fit(count: np.ndarray) -> list[tuple[Counter, int]]:
    """Best fit, longest first, of so many pieces of each length: (pieces of a sequence, sequences alike)."""
    window = len(count) - 1
    open_: dict[int, list[tuple[Counter, int]]] = {}  # by gap
    gaps: list[int] = []  # ascending

    def put(gap: int, held: Counter, bins: int) -> None:
        if gap not in open_:
            open_[gap] = []
            insort(gaps, gap)
        open_[gap].append((held, bins))

    for length in np.flatnonzero(count)[::-1].tolist():
        left = int(count[length])
        while left:
            at = bisect_left(gaps, length)
            if at == len(gaps):
                each = min(window // length, left)
                bins, rest = divmod(left, each)
                put(window - each * length, Counter({length: each}), bins)
                left = rest
                continue
            gap = gaps[at]
            held, bins = open_[gap].pop()
            if not open_[gap]:
                del open_[gap], gaps[at]
            each = min(gap // length, left)
            filled = min(bins, left // each)
            left -= filled * each
            put(gap - each * length, held + Counter({length: each}), filled)
            if bins > filled:
                put(gap, held, bins - filled)
    return [x for bins in open_.values() for x in bins]


def _plan(count: np.ndarray, least: int) -> list[tuple[Counter, int]]:
    supply, waiting, made = Supply(count, least), np.zeros(len(count), np.int64), []
    for seed in range(len(count) - 1, 0, -1):
        while supply.count[seed]:
            held = supply.filling(seed) if seed >= least or seed == len(count) - 1 else None
            if held is None:
                waiting[seed] = supply.count[seed]
                supply.use(seed, int(supply.count[seed]))
            else:
                times = min(int(supply.count[x]) // n for x, n in held.items())
                for x, n in held.items():
                    supply.use(x, n * times)
                made.append((held, times))
    return made + _best_fit(waiting)


def plan(count: np.ndarray) -> list[tuple[Counter, int]]:
    """(pieces of each length in a sequence, how many such sequences) that use up ``count`` (by length, 0 to the window).

    Short pieces spent on exact fillings are missed later by long ones without any. So the shortest piece that
    sums of two and three may use is tried at several lengths, unless no plan can have fewer sequences.
    """
    window = len(count) - 1
    fewest = -(-int((count.astype(np.int64) * np.arange(window + 1)).sum()) // window)
    best: tuple = ()
    for least in (1, *(window >> k for k in (4, 3, 2, 1) if window >> k > 1)):
        made = _plan(count, least)
        sequences = sum(times for _, times in made)
        if not best or sequences < best[0]:
            best = sequences, made
        if sequences == fewest:
            break
    return best[1]


def directions(made: list[tuple[Counter, int]]) -> np.ndarray:
    """Rows (key, each, sequence, offset), by key: where pieces go from number ``key`` (length and number) on, ``each`` to a sequence."""
    rows, number, sequence = [], Counter(), 0
    for held, times in made:
        offset = 0
        for length, each in sorted(held.items(), reverse=True):
            rows.append(((length << NUMBER_BITS) + number[length], each, sequence, offset))
            number[length] += each * times
            offset += each * length
        sequence += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)


def pieces_of(how: BestFit) -> Callable:
    """For mapInPandas over (doc_id, text): the pieces, numbered by length within the task."""
    path = how.tokenizer if "/" in how.tokenizer else public_path(how.tokenizer)
    names = [f.split()[0] for f in PIECE.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with kept(document_encoder, path, how.cache_size) as encode:
            yield from pieces(batches, encode)

    def pieces(batches: Iterator[pd.DataFrame], encode: Callable[[str], bytes]) -> Iterator[pd.DataFrame]:
        end = np.array([how.end_id], dtype="<u4").tobytes()
        task, numbers = TaskContext.get().partitionId(), [0] * (how.window + 1)
        step = 4 * how.window
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = encode(text) + end
                for piece, at in enumerate(range(0, len(ids), step)):
                    part = ids[at : at + step]
                    length = len(part) // 4
                    rows.append((doc_id, piece, at // 4, length, zlib.crc32(part), task, numbers[length]))
                    numbers[length] += 1
            yield pd.DataFrame(rows, columns=names).astype({"doc_id": object})

    return run


def pack(docs: DataFrame, how: BestFit = BestFit(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``."""
    rows = docs.select(F.col(f"`{key}`").cast("string").alias("doc_id"), whole_text(text).alias("text"))
    pieces = stage(rows.mapInPandas(pieces_of(how), PIECE), "bestfit-pieces")
    tasks = stage(pieces.groupBy("task", "length").agg(F.count("*").alias("n")), "bestfit-tasks")
    count = np.zeros(how.window + 1, np.int64)
    for r in tasks.groupBy("length").agg(F.sum("n").alias("n")).collect():
        count[r["length"]] = r["n"]
    sent = docs.sparkSession.sparkContext.broadcast(directions(plan(count)))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        keys, each, sequence, offset = sent.value.T
        key = (length.to_numpy(np.int64) << NUMBER_BITS) + number.to_numpy(np.int64)
        at = np.searchsorted(keys, key, "right") - 1
        along, which = np.divmod(key - keys[at], each[at])
        return pd.DataFrame({"sequence_id": sequence[at] + along, "offset": offset[at] + which * length.to_numpy(np.int64)})

    before = F.sum("n").over(Window.partitionBy("length").orderBy("task")) - F.col("n")
    numbered = pieces.join(tasks.select("task", "length", before.alias("before")), ["task", "length"])
    placed = numbered.withColumn("at", place("length", F.col("number") + F.col("before")))
    kind = docs.schema[key].dataType
    return placed.select(F.col("doc_id").cast(kind).alias("doc_id"), "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "at.sequence_id", "at.offset")
