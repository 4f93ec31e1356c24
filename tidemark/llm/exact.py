"""Exact deduplication of a new batch against an immutable snapshot.

The snapshot's digests get one static binary-fuse filter per digest bucket. The
distinct digests of the new batch are screened by the filter of their bucket:
what the filter rejects is new for certain, what it lets through joins the exact
digests of the bucket. Repeats inside the batch are grouped on their own. Digests
that occur more than once by any of these ways are only suspects: their rows are
grouped by digest and whole text, so a digest shared by different texts cannot
join them.

Rows: null text counts as empty; only A-Z are lower-cased; of equal texts the row
with the largest key stays, a null key being the smallest, and of rows equal in
both exactly one. Every row is returned. An empty table gives an empty table; only
the key and the text column are read. Counting combines before every shuffle, and
joins to a frequent text are left joins that adaptive execution can split.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import common

# Rows per bucket: a filter over as many keys takes about 1.2 bytes a key.
BUCKET_ROWS = 200_000
ATTEMPTS = 100
# Rows of one text that one task compares with their group.
SALT_ROWS = 200
# Digests whose filters are sent to every executor: 20 MB.
BROADCAST_DIGESTS = 16_000_000
_MIX = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def _mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finaliser: every output bit depends on every input bit."""
    h = keys ^ np.uint64(seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    for factor in _MIX:
        h = (h ^ (h >> np.uint64(33))) * factor
    return h ^ (h >> np.uint64(33))


class FuseFilter:
    """A three-wise binary-fuse filter with eight bits a slot; static once built.

    Never rejects a key it was built from; lets through about one in 256 others.
    """

    def __init__(self, seed: int, segment: int, segments: int, slots: np.ndarray):
        self.seed, self.segment, self.segments, self.slots = seed, segment, segments, slots

    @staticmethod
    def _places(h: np.ndarray, segment: int, segments: int) -> np.ndarray:
        """Three slots in three neighbouring segments for each hash."""
        span, mask = np.uint64(segment * segments), np.uint64(segment - 1)
        first = ((h >> np.uint64(32)) * span) >> np.uint64(32)
        second = (first + np.uint64(segment)) ^ ((h >> np.uint64(18)) & mask)
        third = (first + np.uint64(2 * segment)) ^ (h & mask)
        return np.stack([first, second, third]).astype(np.int64)

    @staticmethod
    def _prints(h: np.ndarray) -> np.ndarray:
        return ((h ^ (h >> np.uint64(41))) & np.uint64(255)).astype(np.uint8)

    @classmethod
    def build(cls, keys: np.ndarray) -> FuseFilter:
        keys = np.unique(keys.astype(np.uint64))
        n = max(2, len(keys))
        segment = 1 << max(2, int(math.log(n) / math.log(3.33) + 2.25))
        factor = max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(n))
        segments = max(1, math.ceil(n * factor / segment) - 2)
        for seed in range(ATTEMPTS):
            h = _mixed(keys, seed)
            places = cls._places(h, segment, segments)
            order = cls._peel(places, (segments + 2) * segment)
            if order is not None:
                return cls(seed, segment, segments, cls._fill(h, places, order, (segments + 2) * segment))
        raise RuntimeError("no seed peels these keys")

    @staticmethod
    def _peel(places: np.ndarray, size: int) -> list[tuple[np.ndarray, np.ndarray]] | None:
        """Rounds of (keys, their only slot): keys that are alone somewhere go first."""
        keys = np.arange(places.shape[1])
        count = np.bincount(places.ravel(), minlength=size)
        held = np.zeros(size, np.int64)  # xor of the keys in a slot: the key, if alone
        for row in places:
            np.bitwise_xor.at(held, row, keys)
        rounds, left, alone = [], len(keys), np.flatnonzero(count == 1)
        while len(alone):
            found, first = np.unique(held[alone], return_index=True)
            rounds.append((found, alone[first]))
            left -= len(found)
            for row in places[:, found]:
                np.subtract.at(count, row, 1)
                np.bitwise_xor.at(held, row, found)
            touched = np.unique(places[:, found])
            alone = touched[count[touched] == 1]
        return rounds if left == 0 else None

    @classmethod
    def _fill(cls, h, places, rounds, size: int) -> np.ndarray:
        slots, prints = np.zeros(size, np.uint8), cls._prints(h)
        for keys, own in reversed(rounds):
            slots[own] = 0
            a, b, c = places[:, keys]
            slots[own] = prints[keys] ^ slots[a] ^ slots[b] ^ slots[c]
        return slots

    def may_hold(self, keys: np.ndarray) -> np.ndarray:
        h = _mixed(keys.astype(np.uint64), self.seed)
        a, b, c = self._places(h, self.segment, self.segments)
        return self._prints(h) == self.slots[a] ^ self.slots[b] ^ self.slots[c]


def _keys(digests) -> np.ndarray:
    """64 bits of each digest; short digests are padded."""
    return np.array([int.from_bytes(d[:8].ljust(8, b"\0"), "little") for d in digests], np.uint64)


def _may_hold(filters: dict[int, FuseFilter], buckets: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Asks the filter of each key's bucket; a bucket without filter holds nothing."""
    out = np.zeros(len(keys), bool)
    for bucket in np.unique(buckets).tolist():
        if bucket in filters:
            rows = np.flatnonzero(buckets == bucket)
            out[rows] = filters[bucket].may_hold(keys[rows])
    return out


def digested(
    docs: DataFrame, key: str, text: str, n_buckets: int, digest_bytes: int, filters=None
) -> DataFrame:
    """``doc_id``, ``sha`` (SHA-256 of the normalised text), ``digest`` (its first bytes), ``bucket``.

    With ``filters``, a broadcast of filters by bucket, also ``body``, the normalised
    text, and only rows that the filters let through; an empty broadcast lets all through.
    """
    source = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    schema = f"doc_id {dict(source.dtypes)['doc_id']}, sha binary, digest binary, bucket int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.steps(batches, 1):
            bodies = [(b or b"").lower() for b in batch.column(1).cast(pa.binary()).to_pylist()]
            shas = [hashlib.sha256(b).digest() for b in bodies]
            keys = _keys(s[:digest_bytes] for s in shas)
            buckets = (keys % np.uint64(n_buckets)).astype(np.int32)
            columns = [
                batch.column(0),
                pa.array(shas, pa.binary()),
                pa.array([s[:digest_bytes] for s in shas], pa.binary()),
                pa.array(buckets, pa.int32()),
            ]
            names = ["doc_id", "sha", "digest", "bucket"]
            if filters is not None:
                columns.append(pa.array(bodies, pa.binary()).cast(pa.string()))
                names.append("body")
            out = pa.RecordBatch.from_arrays(columns, names)
            if filters is not None and filters.value:
                out = out.filter(pa.array(_may_hold(filters.value, buckets, keys)))
            yield out

    return common.mapped(source, run, schema + (", body string" if filters is not None else ""))


def build_filters(snapshot: DataFrame) -> DataFrame:
    """One filter per ``bucket`` over the distinct ``digest`` values of a snapshot."""

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        f = FuseFilter.build(_keys(pdf["digest"]))
        row = (int(pdf["bucket"].iloc[0]), f.seed, f.segment, f.segments, f.slots.tobytes())
        return pd.DataFrame([row], columns=["bucket", "seed", "segment", "segments", "slots"])

    schema = "bucket int, seed int, segment int, segments int, slots binary"
    return snapshot.select("bucket", "digest").groupBy("bucket").applyInPandas(build, schema)


def _loaded(rows) -> dict[int, FuseFilter]:
    return {
        r.bucket: FuseFilter(r.seed, r.segment, r.segments, np.frombuffer(r.slots, np.uint8)) for r in rows
    }


def screen(incoming: DataFrame, filters: DataFrame) -> DataFrame:
    """``bucket``, ``digest`` and ``maybe``: whether the snapshot may hold the digest."""

    def check(pdf: pd.DataFrame, filter_rows: pd.DataFrame) -> pd.DataFrame:
        own = _loaded(filter_rows.itertuples())
        maybe = _may_hold(own, pdf["bucket"].to_numpy(), _keys(pdf["digest"]))
        return pdf[["bucket", "digest"]].assign(maybe=maybe)

    left = incoming.select("bucket", "digest").groupBy("bucket")
    schema = "bucket int, digest binary, maybe boolean"
    return left.cogroup(filters.groupBy("bucket")).applyInPandas(check, schema)


def suspects(rows: DataFrame) -> DataFrame:
    """Digests on more than one row, and on how many: ``bucket``, ``digest``, ``n``.

    ``rows`` has ``bucket``, ``digest`` and ``fresh`` (new batch or snapshot).
    """
    counted = rows.groupBy("fresh", "bucket", "digest").agg(F.count("*").alias("n"))
    counted = common.written(counted, "digests")
    snapshot, incoming = counted.filter("not fresh"), counted.filter("fresh")
    screened = screen(incoming, common.written(build_filters(snapshot), "filters"))
    positive = screened.filter("maybe").select("digest")
    seen = positive.join(snapshot.select("digest"), "digest", "left_semi")
    # Only what the filters let through and the snapshot confirms is counted over both sides.
    both = counted.join(seen, "digest", "left_semi").groupBy("bucket", "digest").agg(F.sum("n").alias("n"))
    alone = counted.filter("n > 1").select("bucket", "digest", "n")
    return both.unionByName(alone).groupBy("bucket", "digest").agg(F.max("n").alias("n"))


def dedup(
    docs: DataFrame,
    fresh=None,
    key: str = "doc_id",
    text: str = "text",
    digest_bytes: int = 32,
) -> DataFrame:
    """One row per document: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    ``fresh`` is a column expression over the key that tells the new batch from the
    snapshot; by default a hash of the key halves the table. It moves work between
    filter and grouping and never changes the result. ``digest_bytes`` below 32
    makes digests collide, for tests.
    """
    if fresh is None:
        fresh = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 1
    n_buckets = 1 + docs.count() // BUCKET_ROWS
    rows = digested(docs, key, text, n_buckets, digest_bytes)
    rows = common.written(rows.withColumn("fresh", F.coalesce(fresh, F.lit(True))), "rows")
    several = common.written(suspects(rows), "suspects")
    single = rows.join(several, "digest", "left_anti").select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )
    texts = digested(docs, key, text, n_buckets, digest_bytes, _suspect_filters(several))
    texts = common.written(texts.join(several.select("digest", "n"), "digest"), "texts")
    return single.unionByName(_grouped(texts))


def _suspect_filters(several: DataFrame):
    """Filters over the suspects for all executors, so that other texts need not be moved.

    About 1.2 bytes a digest; beyond ``BROADCAST_DIGESTS`` none are sent and the join
    that follows, which decides in either case, gets all texts.
    """
    small = several.count() <= BROADCAST_DIGESTS
    rows = build_filters(several).collect() if small else []
    return several.sparkSession.sparkContext.broadcast(_loaded(rows))


def _grouped(texts: DataFrame) -> DataFrame:
    """Rows of suspect digests, grouped by their bytes.

    A group is repeated for every ``SALT_ROWS`` rows of its digest, so that the rows of
    a frequent text find it in many tasks.
    """
    groups = texts.groupBy("digest", "body").agg(
        F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"), F.max("n").alias("n")
    )
    last = F.expr(f"n div {SALT_ROWS}")
    groups = groups.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), last))).drop("n")
    salted = texts.withColumn("salt", F.pmod(F.xxhash64("doc_id"), last + 1)).drop("n")
    rows = salted.join(groups, ["digest", "body", "salt"]).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("best"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )
    # Rows with the best key of their group: one of them stays, were the key repeated.
    first = F.expr("row_number() over (partition by doc_id, text_sha256 order by best)") == 1
    return rows.select(
        "doc_id", "keep_id", "group_size", (F.col("best") & first).alias("kept"), "text_sha256"
    )


def keep(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with all their columns, whatever their names."""
    names, places = docs.columns, (docs.columns.index(key), docs.columns.index(text))
    docs = common.numbered(docs)
    key, text = (docs.columns[place] for place in places)
    found = dedup(docs, key=key, text=text).groupBy("doc_id", "text_sha256").agg(
        F.count("*").alias("rows"), F.max("kept").alias("kept")
    )
    odd = found.filter("rows > 1 or not kept").select(
        F.col("doc_id").alias("odd_id"), F.col("text_sha256").alias("odd_sha"), "kept"
    )
    odd = common.written(odd, "odd")
    name = "sha"
    named = _with_sha(docs, text, name)
    same = named[key].eqNullSafe(F.col("odd_id")) & (named[name] == F.col("odd_sha"))
    once = named.join(common.bounded(odd), same, "left_anti").drop(name)
    # One of the rows that are repeated with their key.
    again = odd.filter("kept")
    if again.isEmpty():
        return once.toDF(*names)
    first = named.join(common.bounded(again), same, "left_semi").dropDuplicates([key, name])
    return once.unionByName(first.drop(name)).toDF(*names)


def _with_sha(docs: DataFrame, text: str, name: str) -> DataFrame:
    """All rows with the digest of their normalised text in hexadecimal digits."""
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.steps(batches, place):
            bodies = batch.column(place).cast(pa.binary()).to_pylist()
            shas = [hashlib.sha256((b or b"").lower()).hexdigest() for b in bodies]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(shas, pa.string())], [*batch.schema.names, name]
            )

    fields = [*docs.schema.fields, T.StructField(name, T.StringType())]
    return common.mapped(docs, run, T.StructType(fields))
