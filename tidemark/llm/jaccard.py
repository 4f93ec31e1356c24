"""Join of documents whose sets of word shingles are similar: a parity-sketch join.

Every shingle has a hash; the shingles that fall into one place of a sketch are joined
by XOR. What two sets share cancels out, so a sketch that keeps one bit a place has a
Hamming distance that never exceeds the size of the sets' symmetric difference, which a
similarity of t limits to (1 - t) / (1 + t) of the sum of their sizes. A sketch with
more blocks than that limit therefore has equal blocks for every pair of similar sets.
Sets join on equal blocks within a band of sizes, a sketch of fixed width rejects most
pairs that fail, and the shingle hashes themselves decide.

Nearly all blocks belong to one set alone, and to find that out must not cost a row each. A
task sorts the block keys of some thousand sets and sends, for each range of keys, the steps
between them with the number of the set: about five bytes a key. The task of a range gives back the
keys that it got more than once; only those become rows of key and set.

Documents with equal sets form a class, and classes take part once. A block that many
classes share is not expanded into all pairs: its members are compared with its leader,
the one with the most shared blocks. Sets that this leaves in several components meet once
more by their rarest shingles. Where groups are still large, members are described by their
differences from a centre: the leader, with every shingle turned round that more than half
of the members have otherwise. Two members whose differences together stay within the limit
link for certain, and so does each of them with the member nearest to the centre. All others
that link share differences, so they join again on a few of those that several components
have, in groups of at most half the size, until all groups are in one component or so small
that all pairs are compared. No link that matters for the components is lost.

Rows: null, empty and wordless texts have an empty set and link with nothing; equal
texts link; repeated rows each give a row; an empty table gives an empty table; only
the key and the text column are read. Whole texts are worked on. Hashes have 64 bits.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import common, graph

# Upper size of a band over its lower one.
BAND_RATIO = 1.25
# Blocks beyond those that linked sets can differ in: so many, and one for each SPARE_SHARE
# of these. Linked sets share more blocks than that, unrelated ones with a common passage few.
SPARE_BLOCKS, SPARE_SHARE = 2, 4
# Keys that a task sorts at a time, sets among them at most, and keys in one range.
CHUNK_KEYS, CHUNK_SETS, RANGE_KEYS = 1 << 20, 1 << 16, 2 << 20
# Words of the fixed sketch that pairs are screened with.
SCREEN_WORDS = 16
# Classes in a group of which all pairs are compared: of blocks, and of differences.
SMALL_GROUP = 4
SMALL_REGROUP = 24

_ONE = np.uint64(1)
_U64 = 0xFFFFFFFFFFFFFFFF


def _odd(seed: int) -> int:
    """A fixed odd 64-bit number for each seed."""
    return int.from_bytes(hashlib.sha256(b"odd%d" % seed).digest()[:8], "little") | 1


_BASE = _odd(1)
_STEP = np.array([_odd(i) for i in range(2, 10)], np.uint64)
_BYTE = np.array([_odd(1000 + i) for i in range(256)], np.uint64)
_INVERSE = pow(_BASE, -1, 1 << 64)


def mixed(h: np.ndarray, seed: int = 0) -> np.ndarray:
    h = h + np.uint64(seed * 0x9E3779B97F4A7C15 & _U64)
    for factor in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
        h = (h ^ (h >> np.uint64(31))) * np.uint64(factor)
    return h ^ (h >> np.uint64(32))


class _Powers:
    """Powers of the rolling-hash base and of its inverse, grown on demand."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            steps = np.full(size, _BASE, np.uint64), np.full(size, _INVERSE, np.uint64)
            for s in steps:
                s[0] = 1
            self.up, self.down = np.cumprod(steps[0]), np.cumprod(steps[1])
        return self.up[:n], self.down[:n]


_powers = _Powers()


def word_hashes(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of texts that lie one after the other, and each text's first word.

    ``raw`` holds the bytes, ``bounds`` where texts start and end. Words are runs
    without the six ASCII white-space characters; A-Z count as a-z.
    """
    raw = np.where((raw >= 65) & (raw <= 90), raw + np.uint8(32), raw)
    inside = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
    edge = np.zeros(len(raw) + 1, bool)
    edge[bounds] = True
    before = np.concatenate([[False], inside[:-1]]) & ~edge[:-1]
    after = np.concatenate([inside[1:], [False]]) & ~edge[1:]
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    up, down = _powers.get(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[raw] * up[: len(raw)], out=sums[1:])
    hashes = mixed((sums[ends] - sums[starts]) * down[starts])
    return hashes, np.searchsorted(starts, bounds)


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a shorter text is one shingle."""
    texts = texts.cast(pa.binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.zeros(0, np.uint8)
    words, first = word_hashes(raw, (offsets - offsets[0]).astype(np.int64))
    n = max(0, len(words) - size + 1)
    rolled = np.zeros(n, np.uint64)
    for i in range(size):
        rolled += words[i : i + n] * _STEP[i]
    rolled = mixed(rolled)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(rolled[a : b - size + 1]))
        else:
            part = (words[a:b] * _STEP[: b - a]).sum(keepdims=True, dtype=np.uint64)
            out.append(mixed(part, size + b - a)[: b - a])
    return out


class Threshold:
    """Sets link at ``100 * shared >= percent * union``."""

    def __init__(self, percent: int):
        self.percent = percent

    def most_apart(self, a: int, b: int) -> int:
        """Largest symmetric difference of linked sets of these sizes."""
        return (100 - self.percent) * (a + b) // (100 + self.percent)

    def bands(self, n: int) -> list[int]:
        """Bands of a set: its own, and the next if a set up there may still link with it."""
        band = max(0, int(math.log(n) / math.log(BAND_RATIO)) - 1)
        while self.top(band) < n:
            band += 1
        return [band, band + 1] if 100 * n >= self.percent * (self.top(band) + 1) else [band]

    def top(self, band: int) -> int:
        """Largest size in a band."""
        return math.ceil(BAND_RATIO ** (band + 1)) - 1

    def spare(self, band: int) -> int:
        """Blocks that linked sets of a band share beyond the first."""
        return SPARE_BLOCKS + self.most_apart(self.top(band), self.top(band)) // SPARE_SHARE

    def blocks(self, band: int) -> int:
        """More than the most shingles that linked sets of a band can differ in."""
        return 1 + self.spare(band) + self.most_apart(self.top(band), self.top(band))

    def empty(self, band: int) -> int:
        """With up to so many empty blocks a set gives no keys for them."""
        return self.spare(band) // 2

    def need(self, n: int) -> int:
        """Keys that a set of this size has in common with any set that it links with, at least."""
        return min(
            self.blocks(band) - self.most_apart(n, min(self.top(band), 100 * n // self.percent)) - self.empty(band)
            for band in self.bands(n)
        )


def parity(tokens: np.ndarray, words: int) -> np.ndarray:
    """A sketch of ``words`` times 64 bits: parity of the tokens that hash to each bit."""
    bit = (tokens >> np.uint64(11)) % np.uint64(64 * words)
    odd = np.bincount(bit.astype(np.int64), minlength=64 * words) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<u8")


def block_keys(tokens: np.ndarray, threshold: Threshold) -> np.ndarray:
    """A key for the blocks of the set's sketch in each of its bands.

    A linked pair has more equal blocks than the band has spare ones; a set with no more
    empty blocks than half of those need not look for others with the same empty ones.
    """
    out = []
    hashes = mixed(tokens, 7)
    for band in threshold.bands(len(tokens)) if len(tokens) else ():
        n = threshold.blocks(band)
        block = (tokens % np.uint64(n)).astype(np.int64)
        sketch = np.zeros(n, np.uint64)
        np.bitwise_xor.at(sketch, block, hashes)
        key = mixed(mixed(np.arange(n, dtype=np.uint64) + np.uint64(band << 40)) ^ sketch, 3)
        empty = np.bincount(block, minlength=n) == 0
        out.append(key if empty.sum() > threshold.empty(band) else key[~empty])
    return np.concatenate(out).view(np.int64) if out else np.zeros(0, np.int64)


def _source(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))


def _set_id(tokens: np.ndarray) -> int:
    return int.from_bytes(hashlib.sha256(tokens.tobytes()).digest()[:8], "little", signed=True)


def sketches(source: DataFrame, size: int, threshold: Threshold) -> DataFrame:
    """``doc_id``, ``n_shingles``, the id ``sid`` of the set and the keys it needs to ``share`` to link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.steps(batches, 1):
            sets = shingle_sets(batch.column(1).fill_null(""), size)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_set_id(s) if len(s) else None for s in sets], pa.int64()),
                    pa.array([threshold.need(len(s)) if len(s) else None for s in sets], pa.int64()),
                ],
                ["doc_id", "n_shingles", "sid", "share"],
            )

    kind = dict(source.dtypes)["doc_id"]
    return common.mapped(source, run, f"doc_id {kind}, n_shingles long, sid long, share long")


def coded(values: np.ndarray) -> bytes:
    """Rising numbers as steps, the lowest bytes of all steps first, without the bytes that are zero."""
    planes = np.diff(values, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T
    count = max((i + 1 for i in range(8) if planes[i].any()), default=1)
    return bytes([count]) + planes[:count].tobytes()


def decoded(data: bytes, n: int) -> tuple[np.ndarray, bytes]:
    """The numbers, and what follows them."""
    count = data[0]
    steps = np.zeros((n, 8), np.uint8)
    steps[:, :count] = np.frombuffer(data, np.uint8, count * n, 1).reshape(count, n).T
    return np.cumsum(steps.view("<u8").ravel(), dtype=np.uint64), data[1 + count * n :]


# What a row between the two steps of ``shared_blocks`` holds.
_RANGE, _TWICE, _SETS = range(3)


def _chunks(sets: Iterator[tuple[int, np.ndarray]], bits: int, width: int, ranges: int):
    """Rows ``bucket, chunk, kind, n, data`` of sets given by id and block keys.

    A chunk's keys go to their ranges, each once; the rows of a key that several of its own sets
    have are known to be shared and go anywhere, so a very frequent key fills no range.
    """
    part = TaskContext.get().partitionId()
    number, ids, keys = 0, {}, []

    def rows():
        chunk = (part << 32) | number
        owner = np.repeat(np.arange(len(keys)), [len(k) for k in keys]).astype("<u2")
        values = np.concatenate(keys).view(np.uint64) >> np.uint64(64 - bits)
        order = np.lexsort((owner, values))
        values, owner = values[order], owner[order]
        # A set may have a key twice where blocks are alike.
        once = np.ones(len(values), bool)
        once[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
        values, owner = values[once], owner[once]
        first = np.ones(len(values), bool)
        first[1:] = values[1:] != values[:-1]
        run = np.cumsum(first) - 1
        twice = np.bincount(run)[run] > 1
        elsewhere = ranges + (part * 31 + number) % ranges
        yield elsewhere, chunk, _SETS, len(ids), np.array(list(ids), "<i8").tobytes()
        if twice.any():
            yield elsewhere, chunk, _TWICE, int(twice.sum()), coded(values[twice]) + owner[twice].tobytes()
        values, owner = values[first], owner[first]
        bucket = (values // np.uint64(width)).astype(np.int64)
        ends = np.flatnonzero(np.diff(bucket, append=-1)) + 1
        start = 0
        for end in ends.tolist():
            some = values[start:end]
            yield int(bucket[start]), chunk, _RANGE, end - start, coded(some) + owner[start:end].tobytes()
            start = end

    count = 0
    for sid, own in sets:
        if sid not in ids:
            ids[sid] = len(ids)
            keys.append(own)
            count += len(own)
            if count >= CHUNK_KEYS or len(ids) == CHUNK_SETS:
                yield from rows()
                number, ids, keys, count = number + 1, {}, [], 0
    if count:
        yield from rows()


def _repeated(frames: pd.DataFrame) -> pd.DataFrame:
    """The keys of a range that several chunks have; what is known already passes through."""
    values, chunks, owners, found = [], [], [], []
    for chunk, kind, n, data in zip(frames["chunk"], frames["kind"], frames["n"], frames["data"], strict=True):
        if kind == _SETS:
            one = {"key": None, "chunk": chunk, "owner": np.arange(n), "sid": np.frombuffer(data, "<i8")}
            found.append(pd.DataFrame(one))
            continue
        keys, rest = decoded(data, n)
        owner = np.frombuffer(rest, "<u2")
        if kind == _TWICE:
            found.append(pd.DataFrame({"key": keys.view(np.int64), "chunk": chunk, "owner": owner, "sid": None}))
        else:
            values.append(keys)
            chunks.append(np.full(n, chunk, np.int64))
            owners.append(owner)
    if values:
        keys = np.concatenate(values)
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        same = keys[1:] == keys[:-1]
        take = np.zeros(len(keys), bool)
        take[1:] |= same
        take[:-1] |= same
        order = order[take]
        one = {"key": keys[take].view(np.int64), "chunk": np.concatenate(chunks)[order]}
        found.append(pd.DataFrame({**one, "owner": np.concatenate(owners)[order], "sid": None}))
    whole = pd.concat([f.astype({"key": "Int64", "sid": "Int64"}) for f in found])
    return whole.astype({"chunk": "int64", "owner": "int32"})[["key", "chunk", "owner", "sid"]]


def shared_blocks(source: DataFrame, size: int, threshold: Threshold, shingles: int) -> DataFrame:
    """``key, sid`` of the block keys that more than one set has, each once.

    ``shingles`` is the number of shingles of all documents; there are fewer keys than that.
    """
    spark = source.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(2 * parts, -(-shingles // RANGE_KEYS))
    # With eight bits to spare few keys of different blocks look alike; the sets decide anyway.
    bits = min(52, max(40, shingles.bit_length() + 8))
    width = -(-(1 << bits) // ranges)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sets():
            for batch in common.steps(batches, 0):
                for s in shingle_sets(batch.column(0).fill_null(""), size):
                    if len(s):
                        yield _set_id(s), block_keys(s, threshold)

        names = ["bucket", "chunk", "kind", "n", "data"]
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
        for row in _chunks(sets(), bits, width, ranges):
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types, strict=True)], names)

    sent = common.mapped(source.select("text"), run, "bucket long, chunk long, kind int, n int, data binary")
    found = sent.groupBy("bucket").applyInPandas(_repeated, "key long, chunk long, owner int, sid long")
    found = common.written(found, "blocks")
    sets = found.filter("key is null").select("chunk", "owner", "sid")
    postings = found.filter("key is not null").select("key", "chunk", "owner").join(sets, ["chunk", "owner"])
    postings = common.written(postings.select("key", "sid").distinct(), "postings")
    common.dropped(found)
    # Copies of one set in several chunks share its keys with nobody else.
    shared = common.written(_several(postings), "members")
    common.dropped(postings)
    return shared


def _several(postings: DataFrame) -> DataFrame:
    """The rows of keys that more than one set has."""
    blocks = postings.groupBy("key").agg(F.min("sid").alias("low"), F.max("sid").alias("high"))
    return postings.join(blocks.filter("low < high").select("key"), "key", "left_semi")


def likely(blocks: DataFrame, sketched: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Written ``key, sid`` and ``sid, weight`` without sets that share too few keys to link with any other.

    What goes takes keys from those that stay, so this is repeated while it removes more
    than a tenth of the sets. A set with a link never goes: its partner has as many of its keys.
    """
    needs = sketched.join(common.bounded(blocks.select("sid").distinct()), "sid", "left_semi")
    needs = common.written(needs.groupBy("sid").agg(F.first("share").alias("share")), "needs")
    before = needs.count()
    while True:
        weights = blocks.groupBy("sid").agg(F.count("*").alias("weight"))
        enough = weights.join(needs, "sid").filter("weight >= share").select("sid", "weight")
        weights = common.written(enough, "weights")
        rows = blocks.join(common.bounded(weights.select("sid")), "sid", "left_semi")
        left = common.written(_several(rows), "members")
        common.dropped(blocks)
        blocks, after = left, weights.count()
        if 10 * after >= 9 * before:
            common.dropped(needs)
            return blocks, weights
        before = after
        common.dropped(weights)


def whole_sets(source: DataFrame, size: int) -> DataFrame:
    """``sid``, its shingle hashes ``tokens`` and the fixed sketch ``screen``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.steps(batches, 1):
            sets = [s for s in shingle_sets(batch.column(1).fill_null(""), size) if len(s)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([_set_id(s) for s in sets], pa.int64()),
                    pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                    pa.array([parity(s, SCREEN_WORDS).view(np.int64) for s in sets], pa.list_(pa.int64())),
                ],
                ["sid", "tokens", "screen"],
            )

    return common.mapped(source, run, "sid long, tokens array<long>, screen array<long>")


def _side(sets: DataFrame, name: str, *columns: str) -> DataFrame:
    return sets.select(F.col("sid").alias(name), *(F.col(c).alias(f"{c}_{name}") for c in columns))


def linked(pairs: DataFrame, sets: DataFrame, threshold: Threshold) -> DataFrame:
    """The pairs ``a, b`` of set ids whose sets link: by sketch first, then by shingles."""
    small = sets.select("sid", "screen", F.size("tokens").alias("n"))
    screened = pairs.join(_side(small, "a", "screen", "n"), "a").join(_side(small, "b", "screen", "n"), "b")
    apart = F.aggregate(
        F.zip_with("screen_a", "screen_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))),
        F.lit(0),
        lambda s, x: s + x,
    )
    limit = (100 - threshold.percent) * (F.col("n_a") + F.col("n_b"))
    screened = screened.filter((100 + threshold.percent) * apart <= limit).select("a", "b")
    screened = common.written(screened, "screened")
    pairs = common.bounded(screened)
    # Each side gets its sets where they lie; only sets that are compared are moved.
    left = _side(sets, "a", "tokens").join(pairs, "a")
    right = _side(sets, "b", "tokens").join(pairs, "b")
    both = left.join(right.hint("merge"), ["a", "b"])
    shared = F.size(F.array_intersect("tokens_a", "tokens_b"))
    union = F.size("tokens_a") + F.size("tokens_b") - shared
    return both.filter(100 * shared >= threshold.percent * union).select("a", "b")


class _Links:
    """Links found so far, the pairs compared for them and the components they make."""

    def __init__(self, sets: DataFrame, threshold: Threshold):
        self.sets, self.threshold = sets, threshold
        self.found: DataFrame | None = None
        self.compared: DataFrame | None = None
        self.components: DataFrame | None = None

    def compare(self, pairs: DataFrame) -> None:
        """Compares the pairs not seen before and joins the components of those that link."""
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        if self.compared is not None:
            pairs = pairs.join(self.compared, ["a", "b"], "left_anti")
        pairs = common.written(pairs, "pairs")
        links = common.written(linked(pairs, self.sets, self.threshold), "links")
        self.compared = pairs if self.compared is None else self.compared.union(pairs)
        if not links.isEmpty():
            self.found = links if self.found is None else self.found.union(links)
            self.components = common.written(graph.components(self.found), "components")

    def label(self, members: DataFrame) -> DataFrame:
        """Adds ``component`` to rows with ``sid``."""
        if self.components is None:
            return members.withColumn("component", F.col("sid"))
        named = self.components.withColumnRenamed("node", "sid")
        return members.join(named, "sid", "left").withColumn("component", F.coalesce("component", "sid"))


def _open(members: DataFrame, links: _Links) -> DataFrame:
    """Members of groups whose classes are in several components.

    Adds the ``component``, the group's number of ``classes``, its leader ``lead`` and
    the leader's component ``lead_part``.
    """
    labelled = common.written(links.label(members.select("key", "sid", "weight")), "labelled")
    groups = labelled.groupBy("key").agg(
        F.count("*").alias("classes"),
        F.min("component").alias("first"),
        F.max("component").alias("last"),
        F.max(F.struct("weight", "sid", "component")).alias("lead"),
    )
    groups = groups.filter("first < last").select(
        "key", "classes", F.col("lead.sid").alias("lead"), F.col("lead.component").alias("lead_part")
    )
    found = common.written(labelled.join(groups, "key"), "open")
    common.dropped(labelled)
    return found


def _pairs(members: DataFrame, most: int) -> DataFrame:
    """All pairs of small groups, and each member of a larger one with the leader."""
    large = members.filter((F.col("classes") > most) & (F.col("component") != F.col("lead_part")))
    small = members.filter(F.col("classes") <= most).select("key", "sid", "component")
    other = small.select("key", F.col("sid").alias("b"), F.col("component").alias("other"))
    within = small.join(other, "key").filter("sid < b and component <> other")
    return large.select(F.col("lead").alias("a"), F.col("sid").alias("b")).union(
        within.select(F.col("sid").alias("a"), "b")
    )


def _across(tokens: DataFrame, *group: str) -> DataFrame:
    """Tokens that several components of a group have, and how many sets: others decide nothing."""
    return tokens.groupBy(*group, "token").agg(
        F.count("*").alias("times"), F.min("component").alias("first"), F.max("component").alias("last")
    ).filter("first < last").drop("first", "last")


def _rarest(members: DataFrame, sets: DataFrame, threshold: Threshold) -> DataFrame:
    """The sets of all groups once, by their rarest shingles.

    Sets that link share as many shingles as either needs. A set that shares fewer with all
    other components together goes; of one that stays, the most frequent of these, up to one
    less than it needs, are left out: two that link still share one in the order that both follow.
    """
    ids = common.written(members.select("sid", "weight", "component").distinct(), "rest")
    own = sets.select("sid", F.explode("tokens").alias("token"), F.size("tokens").alias("n"))
    own = own.join(common.bounded(ids.select("sid", "component")), "sid")
    shared = own.drop("component").join(_across(own), "token").groupBy("sid", "n").agg(
        F.array_sort(F.collect_list(F.struct("times", "token"))).alias("shared")
    )
    needs = F.ceil(threshold.percent * F.col("n") / 100)
    places = (F.size("shared") - needs + 1).cast("int")
    keys = shared.withColumn("places", places).filter("places > 0")
    keys = keys.select("sid", F.explode(F.slice("shared", F.lit(1), F.col("places"))).alias("one"))
    keys = keys.select(F.col("one.token").alias("key"), "sid").join(common.bounded(ids), "sid")
    found = common.written(keys.select("key", "sid", "weight"), "rarest")
    common.dropped(ids)
    return found


def _differences(members: DataFrame, sets: DataFrame, cluster: str) -> DataFrame:
    """``cluster``, ``sid``, ``weight``, size ``n`` and differences ``apart`` from the centre.

    A cluster is what has one leader, or one group of it.
    """
    led = members.filter("sid <> lead").select(F.col(cluster).alias("cluster"), "lead", "sid", "weight").distinct()
    led = common.written(led, "led")
    # Only sets of these members and their leaders are moved.
    own = sets.select("sid", F.col("tokens").alias("own")).join(common.bounded(led), "sid")
    leads = common.bounded(led.select("lead").distinct())
    lead = sets.select(F.col("sid").alias("lead"), F.col("tokens").alias("theirs")).join(leads, "lead", "left_semi")
    apart = F.concat(F.array_except("own", "theirs"), F.array_except("theirs", "own"))
    both = own.join(lead, "lead")
    rows = both.select("cluster", "sid", "weight", F.size("own").alias("n"), apart.alias("apart"))
    rows = first = common.written(rows, "apart")
    held = rows.select("cluster", F.explode("apart").alias("token")).groupBy("cluster", "token").agg(
        F.count("*").alias("n")
    )
    sizes = rows.groupBy("cluster").agg(F.count("*").alias("all"))
    turned = held.join(sizes, "cluster").filter("2 * n > all").groupBy("cluster").agg(
        F.collect_list("token").alias("turned")
    )
    none = F.array().cast("array<bigint>")
    rows = rows.join(turned, "cluster", "left").withColumn("turned", F.coalesce("turned", none))
    apart = F.concat(F.array_except("apart", "turned"), F.array_except("turned", "apart"))
    found = common.written(rows.withColumn("apart", apart).drop("turned"), "apart")
    common.dropped(led, first)
    return found


def _core(rows: DataFrame, threshold: Threshold) -> DataFrame:
    """Pairs of a cluster's member nearest to the centre with those that link to it for certain."""
    room = (100 - threshold.percent) * F.col("n") - (100 + threshold.percent) * F.size("apart")
    rows = rows.select("cluster", "sid", room.alias("room"))
    nearest = rows.groupBy("cluster").agg(F.max(F.struct("room", "sid")).alias("nearest"))
    sure = rows.join(nearest, "cluster").filter("room + nearest.room >= 0 and sid <> nearest.sid")
    return sure.select(F.col("nearest.sid").alias("a"), F.col("sid").alias("b"))


def _regrouped(rows: DataFrame, links: _Links) -> DataFrame:
    """Members by their differences from the centre.

    Those that ``_core`` leaves in several components link only if they share differences: with
    at most ``reach`` between them, half of what both together have beyond that. The partner has
    no fewer than the fewest in any ``other`` component, nor than its own beyond ``reach``. Of the
    differences that other components have, all but one less than a member needs are enough, in
    an order that all follow; it starts with those that the fewest members have.
    """
    percent = links.threshold.percent
    most = rows.groupBy("cluster").agg(F.max("n").alias("most"))
    # The other set has at most this many shingles.
    largest = F.least(F.floor(100 * F.col("n") / percent), "most")
    reach = F.floor((100 - percent) * (F.col("n") + largest) / (100 + percent))
    held = links.label(rows).withColumn("all", F.size("apart")).join(most, "cluster").withColumn("reach", reach)
    held = common.written(held, "held")
    least = held.groupBy("cluster", "component").agg(F.min("all").alias("least"))
    first = least.groupBy("cluster").agg(F.min(F.struct("least", "component")).alias("first"))
    second = least.join(first, "cluster").filter("component <> first.component")
    # Clusters of one component need nothing more.
    second = second.groupBy("cluster", "first").agg(F.min("least").alias("second"))
    tokens = held.select("cluster", "sid", "component", F.explode("apart").alias("token"))
    shared = tokens.join(_across(tokens, "cluster"), ["cluster", "token"]).groupBy("cluster", "sid").agg(
        F.array_sort(F.collect_list(F.struct("times", "token"))).alias("shared")
    )
    beyond = F.col("all") - F.col("reach")
    other = F.when(F.col("component") == F.col("first.component"), F.col("second")).otherwise(F.col("first.least"))
    needs = F.greatest(F.lit(1), F.ceil((beyond + F.greatest(other, beyond)) / 2))
    places = (F.size("shared") - needs + 1).cast("int")
    keys = held.drop("apart").join(shared, ["cluster", "sid"]).join(second, "cluster")
    keys = keys.withColumn("places", places).filter("places > 0")
    keys = keys.select("cluster", "sid", "weight", F.explode(F.slice("shared", F.lit(1), F.col("places"))).alias("one"))
    keys = keys.select(F.xxhash64("cluster", "one.token").alias("key"), "sid", "weight")
    found = common.written(keys.distinct(), "regrouped")
    common.dropped(held)
    return found


def find_links(sketched: DataFrame, source: DataFrame, size: int, threshold: Threshold) -> DataFrame | None:
    """Components of set ids that links connect: ``node``, ``component``; None without links."""
    shingles = sketched.agg(F.sum("n_shingles")).first()[0] or 0
    blocks, weights = likely(shared_blocks(source, size, threshold, shingles), sketched)
    members = blocks.join(weights, "sid")
    sets = _candidates(weights.select("sid"), sketched, source, size)
    links = _Links(sets, threshold)

    # One comparison for each class first, with its best leader: it settles most groups.
    leaders = members.groupBy("key").agg(F.max(F.struct("weight", "sid")).alias("lead"))
    best = members.join(leaders, "key").groupBy("sid").agg(F.max("lead").alias("lead"))
    links.compare(best.select(F.col("lead.sid").alias("a"), F.col("sid").alias("b")).filter("a <> b"))
    members = _open(members, links)
    common.dropped(blocks)
    links.compare(_pairs(members, SMALL_GROUP))
    rest = _open(members.filter(F.col("classes") > SMALL_GROUP), links)
    common.dropped(members)
    rarest = _rarest(rest, sets, threshold)
    common.dropped(rest)
    members, cluster = _open(rarest, links), "lead"
    common.dropped(rarest)
    while not members.isEmpty():
        links.compare(_pairs(members, SMALL_REGROUP))
        still = _open(members.filter(F.col("classes") > SMALL_REGROUP), links)
        common.dropped(members)
        members = still
        if members.isEmpty():
            break
        rows = _differences(members, sets, cluster)
        common.dropped(members)
        links.compare(_core(rows, threshold))
        regrouped = _regrouped(rows, links)
        common.dropped(rows)
        members, cluster = _open(regrouped, links), "key"
        common.dropped(regrouped)
    common.dropped(members, sets, weights)
    return links.components


def _candidates(ids: DataFrame, sketched: DataFrame, source: DataFrame, size: int) -> DataFrame:
    """The sets of the classes in any shared block, each from one of its documents."""
    docs = sketched.join(common.bounded(ids), "sid", "left_semi").groupBy("sid").agg(F.min("doc_id").alias("doc_id"))
    docs = common.written(docs.select(F.col("doc_id").alias("id")).distinct(), "candidates")
    chosen = source.join(common.bounded(docs), F.col("doc_id").eqNullSafe(F.col("id")), "left_semi")
    # Keys may repeat: what else they bring in is taken out again.
    sets = common.written(whole_sets(chosen, size).join(common.bounded(ids), "sid", "left_semi"), "sets")
    common.dropped(docs)
    if sets.count() > ids.count():
        several = sets
        sets = common.written(several.dropDuplicates(["sid"]), "sets")
        common.dropped(several)
    return sets


def keep(
    docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 3, percent: int = 90
) -> DataFrame:
    """One row of each component, with all its columns, and all rows without words.

    The smallest key stays, a null key only if there is no other; of rows that share it
    exactly one, whatever their texts.
    """
    names, places = docs.columns, (docs.columns.index(key), docs.columns.index(text))
    docs = common.numbered(docs)
    key, text = (docs.columns[place] for place in places)
    threshold = Threshold(percent)
    source = _source(docs, key, text)
    sketched = common.written(sketches(source, size, threshold), "sketches")
    found = find_links(sketched, source, size, threshold)
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id")).alias("least")
    classes = sketched.filter("sid is not null").groupBy("sid").agg(least, F.count("*").alias("rows"))
    odd = classes.filter("rows > 1").select("sid", F.col("least.doc_id").alias("keep_id"), F.lit(True).alias("stays"))
    if found is not None:
        linked_ = classes.join(found.withColumnRenamed("node", "sid"), "sid")
        best = linked_.groupBy("component").agg(F.min(F.struct("least", "sid")).alias("best"))
        chosen = linked_.join(best, "component").select(
            "sid", F.col("least.doc_id").alias("keep_id"), (F.col("sid") == F.col("best.sid")).alias("stays")
        )
        odd = odd.join(found.select(F.col("node").alias("sid")), "sid", "left_anti").unionByName(chosen)
    odd = common.written(odd.withColumnRenamed("sid", "odd_sid"), "near-copies")
    name = "sid"
    once = _with_sid(docs, text, size, name)
    once = once.join(common.bounded(odd), F.col(name) == F.col("odd_sid"), "left_anti").drop(name)
    again = common.written(odd.filter("stays"), "near-copies-kept")
    if again.isEmpty():
        return once.toDF(*names)
    ids = common.bounded(again.select("keep_id").distinct())
    first = docs.join(ids, docs[key].eqNullSafe(F.col("keep_id")), "left_semi")
    first = _with_sid(first, text, size, name)
    same = (F.col(name) == F.col("odd_sid")) & first[key].eqNullSafe(F.col("keep_id"))
    first = first.join(common.bounded(again), same, "left_semi").dropDuplicates([key, name])
    return once.unionByName(first.drop(name)).toDF(*names)


def _with_sid(docs: DataFrame, text: str, size: int, name: str) -> DataFrame:
    """All rows with the id of their set."""
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.steps(batches, place):
            sets = shingle_sets(batch.column(place).fill_null(""), size)
            sids = pa.array([_set_id(s) if len(s) else None for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, sids], [*batch.schema.names, name])

    fields = [*docs.schema.fields, T.StructField(name, T.LongType())]
    return common.mapped(docs, run, T.StructType(fields))


def components(
    docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 3, percent: int = 90
) -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles``, ``component_id``.

    ``component_id`` is the smallest key reachable over links, the document's own included.
    """
    threshold = Threshold(percent)
    source = _source(docs, key, text)
    sketched = common.written(sketches(source, size, threshold), "sketches")
    found = find_links(sketched, source, size, threshold)
    rows = sketched.select("doc_id", "n_shingles", "sid")
    classes = rows.filter("sid is not null").groupBy("sid").agg(F.min("doc_id").alias("least"))
    if found is not None:
        linked_ = classes.join(found.withColumnRenamed("node", "sid"), "sid")
        least = linked_.groupBy("component").agg(F.min("least").alias("reached"))
        reached = linked_.select("sid", "component").join(least, "component").select("sid", "reached")
        classes = classes.join(reached, "sid", "left")
        classes = classes.select("sid", F.coalesce("reached", "least").alias("least"))
    return rows.join(classes, "sid", "left").select(
        "doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id")
    )
