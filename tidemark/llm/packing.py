"""Best-fit packing of tokenised documents into sequences of a fixed length.

Only lengths matter, so the plan is made from a histogram with one count per
length, at most as many as a sequence has places, however large the corpus is.
Exact-complement hashing goes from the longest length down: the gap it leaves is
looked up among the single lengths, then the pair sums, then the triple sums that
are still available, and each combination found is used as often as its rarest
length allows. What has no exact complement is packed best-fit, longest first,
into the smallest gap that takes it. Filling early gaps with triples can take short
pieces that later gaps need, so plans of every depth are made and the one with the
fewest sequences is taken. Every piece gets a rank within its length
from salted counts and finds its place in the plan by that rank.

Rows: a null text counts as empty and gives one piece with the end token alone;
repeated rows each get a place; an empty table gives an empty table; only the key
and the text column are read. No piece is dropped and none is longer than a
sequence.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import bpe, common

CAPACITY = 2048
END_TOKEN = 0
# Rows that one (length, salt) group ranks on average.
SALT_ROWS = 20_000


# Text is cut into pieces before it gets to the library.
_ONE_PIECE = r"(?s).+"


@lru_cache(maxsize=2)
def _pieces(path: str) -> bpe.Pieces:
    """Ids of a vocabulary file; merges of new pieces by the tiktoken library."""
    own = bpe.codec(path)
    special = own.pieces.special
    ranks = {word: token for token, word in enumerate(own.bytes) if token not in special.values()}
    merges = tiktoken.Encoding("own", pat_str=_ONE_PIECE, mergeable_ranks=ranks, special_tokens={})
    return bpe.Pieces(lambda raw: merges.encode_ordinary(raw.decode()), special)


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids; only the first may be short."""
    first = n % capacity or min(n, capacity)
    bounds = [0, *range(first, n + 1, capacity)]
    return list(zip(bounds, np.diff(bounds).tolist(), strict=False))


def pieces(
    docs: DataFrame,
    vocabulary: str,
    capacity: int = CAPACITY,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every document's ids and end token."""
    source = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    kind = dict(source.dtypes)["doc_id"]
    end = np.array([END_TOKEN], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _pieces(vocabulary)
        for batch in common.steps(batches, 1):
            row, number, start, length, crc = [], [], [], [], []
            for i, value in enumerate(batch.column(1).to_pylist()):
                packed = own.packed(value or "") + end
                for k, (at, size) in enumerate(cut(len(packed) // 4, capacity)):
                    row.append(i)
                    number.append(k)
                    start.append(at)
                    length.append(size)
                    crc.append(zlib.crc32(packed[4 * at : 4 * (at + size)]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(row, pa.int64())),
                    pa.array(number, pa.int32()),
                    *(pa.array(v, pa.int64()) for v in (start, length, crc)),
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    return common.mapped(source, run, schema)


@dataclass
class Plan:
    """Which ranks of each length go where.

    A row is a run of equal lengths in one pattern: ranks from ``low`` on, ``copies``
    of them in each of ``times`` sequences, starting at ``offset`` in the sequence.
    """

    capacity: int
    rows: list[tuple[int, int, int, int, int, int]] = field(default_factory=list)
    sequences: int = 0

    def arrays(self) -> dict[int, np.ndarray]:
        """Runs per length, ordered by rank: low, copies, offset, first sequence."""
        out: dict[int, list] = {}
        for length, low, copies, offset, first, _ in self.rows:
            out.setdefault(length, []).append((low, copies, offset, first))
        return {length: np.array(sorted(rows), np.int64) for length, rows in out.items()}


def _complement(left: np.ndarray, lead: int, gap: int, depth: int) -> tuple[int, ...] | None:
    """Up to ``depth`` available lengths that fill ``gap`` exactly, none longer than ``lead``."""

    def free(*lengths: int) -> bool:
        return all(left[x] >= lengths.count(x) + (x == lead) for x in lengths)

    if gap == 0:
        return ()
    if depth > 0 and gap <= lead and free(gap):
        return (gap,)
    if depth < 2:
        return None
    top = min(lead, gap)
    there = left[: top + 1] > 0
    for b in _pairs(there, gap):
        if free(b, gap - b):
            return b, gap - b
    if depth < 3:
        return None
    wide = np.zeros(gap + 1, bool)
    wide[: top + 1] = there
    sums = np.rint(np.fft.irfft(np.fft.rfft(wide, 2 * gap + 2) ** 2, 2 * gap + 2))[: gap + 1] > 0
    for a in np.flatnonzero(there & sums[gap - np.arange(top + 1)])[::-1].tolist():
        for b in _pairs(there[: a + 1], gap - a):
            if free(a, b, gap - a - b):
                return a, b, gap - a - b
    return None


def _pairs(there: np.ndarray, gap: int) -> list[int]:
    """The larger length of each pair with this sum, largest first."""
    b = np.arange((gap + 1) // 2, min(len(there) - 1, gap - 1) + 1)
    return b[there[b] & there[gap - b]][::-1].tolist()


def make_plan(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Packs ``counts[length]`` pieces of each length; the best plan of any depth."""
    return min((_plan(counts, capacity, depth) for depth in (3, 2, 1, 0)), key=lambda p: p.sequences)


def _plan(counts: dict[int, int], capacity: int, depth: int) -> Plan:
    """Exact complements of up to ``depth`` lengths, then best fit."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    used = np.zeros(capacity + 1, np.int64)
    plan = Plan(capacity)

    def emit(pattern: list[int], times: int) -> None:
        offset = 0
        for length in sorted(set(pattern), reverse=True):
            copies = pattern.count(length)
            plan.rows.append((length, int(used[length]), copies, offset, plan.sequences, times))
            used[length] += copies * times
            offset += copies * length
        plan.sequences += times

    for lead in range(capacity, 0, -1):
        while left[lead] and (
            rest := _complement(left, lead, capacity - lead, depth)) is not None:
            pattern = [lead, *rest]
            times = min(int(left[x]) // pattern.count(x) for x in pattern)
            for x in pattern:
                left[x] -= times
            emit(pattern, times)
    for pattern, times in _best_fit(left, capacity):
        emit(pattern, times)
    return plan


def _best_fit(left: np.ndarray, capacity: int) -> list[tuple[list[int], int]]:
    """Best fit, longest first, for many pieces of a length at a time."""
    open_: dict[int, list[tuple[list[int], int]]] = {}
    for length in range(capacity, 0, -1):
        n = int(left[length])
        while n:
            gap = min((g for g in open_ if g >= length), default=None)
            if gap is None:
                stack = min(n, capacity // length)
                times = n // stack
                open_.setdefault(capacity - stack * length, []).append(([length] * stack, times))
                n -= stack * times
                continue
            pattern, times = open_[gap].pop()
            if not open_[gap]:
                del open_[gap]
            here = min(n, times)
            if times > here:
                open_.setdefault(gap, []).append((pattern, times - here))
            open_.setdefault(gap - length, []).append(([*pattern, length], here))
            n -= here
    return [group for groups in open_.values() for group in groups]


def ranked(rows: DataFrame, order: list[str], salt_rows: int = SALT_ROWS) -> DataFrame:
    """Adds ``rank`` from 0 within each length, counted in salted groups."""
    salts = 1 + rows.count() // salt_rows
    salted = rows.withColumn("salt", F.pmod(F.xxhash64(*order), F.lit(salts)))
    before = F.expr("sum(n) over (partition by length order by salt) - n").alias("before")
    base = salted.groupBy("length", "salt").agg(F.count("*").alias("n")).select("length", "salt", before)
    within = F.expr(f"row_number() over (partition by length, salt order by {', '.join(order)})")
    return (
        salted.withColumn("within", within)
        .join(base, ["length", "salt"])
        .withColumn("rank", F.col("before") + F.col("within") - 1)
        .select(*rows.columns, "rank")
    )


def pack(rows: DataFrame, order: list[str], capacity: int = CAPACITY, salt_rows: int = SALT_ROWS) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows with a ``length`` up to ``capacity``.

    ``rows`` is read several times: pass a written table. The driver sees one count
    per length.
    """
    counts = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect()}
    places = make_plan(counts, capacity).arrays()
    source = ranked(rows, order, salt_rows)
    names = [c for c in source.columns if c != "rank"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("length").to_numpy(False)
            ranks = batch.column("rank").to_numpy(False)
            sequence, offset = np.zeros(len(ranks), np.int64), np.zeros(len(ranks), np.int64)
            for length in np.unique(lengths).tolist():
                own, runs = np.flatnonzero(lengths == length), places[length]
                low, copies, start, first = runs[np.searchsorted(runs[:, 0], ranks[own], "right") - 1].T
                nth, within = np.divmod(ranks[own] - low, copies)
                sequence[own], offset[own] = first + nth, start + within * length
            columns = [batch.column(n) for n in names] + [pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(columns, [*names, "sequence_id", "offset"])

    kinds = dict(source.dtypes)
    schema = ", ".join(f"`{n}` {kinds[n]}" for n in names) + ", sequence_id long, offset long"
    return common.mapped(source, place, schema)


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of all documents with their places."""
    cut_up = common.written(pieces(docs, vocabulary, capacity), "pieces")
    return pack(cut_up, ["doc_id", "piece", "ids_crc32"], capacity)
