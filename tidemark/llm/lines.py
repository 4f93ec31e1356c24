"""Near-equal lines across all documents: a deletion-neighbourhood join.

Two lines within one edit (a character put in, taken out or changed) have a common
variant: one loses a character, or both lose the character at the same place. Variants
are hashed keys from prefix sums of weighted code points, so all keys of a line cost one
pass. As a line has as many variants as characters, they are emitted in three rounds.
Keys of the first two leave out a whole segment instead of one character (halves, then
sixteenths); only lines that share such a key go on, and in the last round they emit the
variants of the segments that a shared key left open. Every pair within one edit agrees
outside the segment of its edit, so no pair is lost. Equal variants meet in aggregates
that keep the earliest line, never in pairs of a group, and the edit distance to that line is
verified on the texts.

A place is (key of the document, number of the line), null keys last. A line goes if a line
at an earlier place is within one edit of it, also where that one goes itself. Equal lines
form a class that takes part once, however often it stands.

Rows: lines are what stands between newlines, whole and as written; those of fewer than
``LEAST`` characters take no part and stay. Null and empty texts have no lines and stay as
they are. Rows that repeat a key and a text share their places and so their fate; lines
that meet at one place do not count as earlier than each other. An empty table gives an
empty table; other columns are passed through, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common

# Characters of the shortest line that is compared.
LEAST = 10
# Segments of a line in the rounds before single characters.
HALVES, SEGMENTS = 2, 16
# Parts that the lines of one class are dealt over where they are looked up.
SALTS = 8
PLACE = "struct<none: boolean, doc: {kind}, line: int>"

_MASK = (1 << 64) - 1


def _mixed(values: np.ndarray) -> np.ndarray:
    """A well-mixed permutation of unsigned 64-bit integers."""
    x = values.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def line_id(line: str) -> bytes:
    return hashlib.blake2b(line.encode("utf-8", "surrogatepass"), digest_size=16).digest()


class Variants:
    """Keys of one line with parts left out."""

    def __init__(self, line: str):
        codes = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32)
        self.length = len(codes)
        values, weights = _mixed(codes), _mixed(np.arange(self.length + 1))
        zero = np.zeros(1, np.uint64)
        # Sums of a character's value times the weight of its place, and of the place before it.
        self.whole = np.concatenate([zero, np.cumsum(values * weights[1:], dtype=np.uint64)])
        self.moved = np.concatenate([zero, np.cumsum(values * weights[:-1], dtype=np.uint64)])

    def bounds(self, lost: int, parts: int) -> np.ndarray:
        return np.arange(parts + 1) * (self.length - lost) // parts

    def coarse(self, parts: int) -> np.ndarray:
        """Keys with each segment left out: of the line as it is, then with a character too many."""
        keys = []
        for lost, sums in enumerate((self.whole, self.moved)):
            cuts = self.bounds(lost, parts)
            rest = self.whole[cuts[:-1]] + (sums[self.length] - sums[cuts[1:] + lost])
            salt = (self.length - lost) * parts * 2 + np.arange(parts)
            keys.append(_mixed(rest ^ _mixed(salt)))
        return np.concatenate(keys).view(np.int64)

    def fine(self, opened: list[int], parts: int) -> tuple[np.ndarray, np.ndarray]:
        """Keys and places of single deletions in the opened segments; place -1 is the whole line."""
        cuts = self.bounds(1, parts)
        spots = [np.arange(cuts[s - parts], cuts[s - parts + 1] + 1) for s in opened if s >= parts]
        at = np.unique(np.concatenate(spots)) if spots else np.zeros(0, int)
        keys = self.whole[at] + (self.moved[self.length] - self.moved[at + 1])
        sizes = np.full(len(at), self.length - 1)
        if any(s < parts for s in opened):
            at, keys, sizes = np.append(at, -1), np.append(keys, self.whole[-1]), np.append(sizes, self.length)
        return _mixed(keys ^ _mixed(sizes)).view(np.int64), at


def coarse_of(lines: list[str], parts: int) -> pa.ListArray:
    """``Variants.coarse`` of many lines at once: sums over all of them, keys by differences."""
    sizes = np.array([len(line) for line in lines], np.int64)
    starts = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])
    codes = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32)
    values = _mixed(codes)
    places = np.arange(len(codes)) - np.repeat(starts[:-1], sizes)
    weights = _mixed(np.arange(int(sizes.max(initial=0)) + 1))
    zero = np.zeros(1, np.uint64)
    whole = np.concatenate([zero, np.cumsum(values * weights[places + 1], dtype=np.uint64)])
    moved = np.concatenate([zero, np.cumsum(values * weights[places], dtype=np.uint64)])
    first, last = starts[:-1, None], starts[1:, None]
    keys = []
    for lost, sums in enumerate((whole, moved)):
        left = sizes[:, None] - lost
        cuts = first + np.arange(parts + 1) * left // parts
        rest = (whole[cuts[:, :-1]] - whole[first]) + (sums[last] - sums[cuts[:, 1:] + lost])
        keys.append(_mixed(rest ^ _mixed(left * parts * 2 + np.arange(parts))))
    flat = np.concatenate(keys, axis=1).view(np.int64).ravel()
    return pa.ListArray.from_arrays(pa.array(np.arange(len(lines) + 1) * 2 * parts, pa.int32()), pa.array(flat))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a line that takes part: its id, place and keys of halves."""
    for batch in common.steps(batches, 1, common.STEP_BYTES // 2):
        docs, places, held = [], [], []
        for row, text in enumerate(batch.column(1).to_pylist()):
            for place, line in enumerate((text or "").split("\n")):
                if len(line) >= LEAST:
                    docs.append(row)
                    places.append(place)
                    held.append(line)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([line_id(line) for line in held], pa.binary()),
                batch.column(0).take(pa.array(docs, pa.int64())),
                pa.array(places, pa.int32()),
                coarse_of(held, HALVES),
            ],
            ["id", "doc", "line", "keys"],
        )


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in common.steps(batches, 1, common.STEP_BYTES // 2):
        keys = coarse_of(batch.column(1).to_pylist(), SEGMENTS)
        yield pa.RecordBatch.from_arrays([batch.column(0), keys], ["id", "keys"])


def _single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in common.steps(batches, 1, common.STEP_BYTES // 8):
        for row, (line, opened) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
            keys, at = Variants(line).fine(opened, SEGMENTS)
            own = pa.array(np.full(len(keys), row))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(own), pa.array(keys), pa.array(at, pa.int32())], ["id", "key", "at"]
            )


def _shared(keyed: DataFrame) -> DataFrame:
    """``id`` and ``pos`` of the keys that more than one line has."""
    posts = keyed.select("id", F.posexplode("keys").alias("pos", "key"))
    often = posts.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key")
    return posts.join(often, "key", "left_semi")


def dropped(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc`` and its ``lines`` that go, as (number, id), for every document that loses any."""
    source = docs.select(F.col(key).alias("doc"), F.col(text).alias("text"))
    kind = dict(source.dtypes)["doc"]
    lines = common.written(
        common.mapped(source, _scan, f"id binary, doc {kind}, line int, keys array<long>"), "lines"
    )
    place = F.struct(F.col("doc").isNull().alias("none"), "doc", "line")
    classes = common.written(
        lines.groupBy("id").agg(
            F.min(place).alias("first"), F.count(F.lit(1)).alias("n"), F.first("keys").alias("keys")
        ),
        "line-classes",
    )
    near = _near(source, classes, kind)
    least = (
        classes.join(near, "id", "left")
        .filter("n > 1 OR best IS NOT NULL")
        .select("id", F.least("first", F.coalesce("best", "first")).alias("earliest"))
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    )
    salted = lines.select("id", "doc", "line", F.pmod(F.xxhash64("doc", "line"), F.lit(SALTS)).cast("int").alias("salt"))
    gone = salted.join(least, ["id", "salt"]).filter(place > F.col("earliest"))
    return gone.groupBy("doc").agg(F.collect_set(F.struct("line", "id")).alias("lines"))


def _standing(source: DataFrame, wanted: DataFrame) -> DataFrame:
    """``doc, line, text`` of the lines at the places of ``wanted``, and some more.

    Few lines are wanted, so hashes of their places go to all tasks, if they are not too many, and the texts of
    the others are not moved.
    """
    lines = source.select(
        F.col("doc"), F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("line", "text")
    )
    spot = F.xxhash64("doc", "line").alias("spot")
    spots = wanted.select(spot)
    if spots.count() > common.BROADCAST_IDS:
        return lines
    return lines.select("*", spot).join(F.broadcast(spots), "spot", "left_semi").drop("spot")


def _near(source: DataFrame, classes: DataFrame, kind: str) -> DataFrame:
    """``id`` and the ``best`` place: the first of all other lines within one edit."""
    candidates = _shared(classes.select("id", "keys")).select("id").distinct()
    candidates = common.written(classes.select("id", "first").join(candidates, "id"), "line-candidates")
    wanted = candidates.select("id", "first", F.col("first.doc").alias("doc"), F.col("first.line").alias("line"))
    found = _standing(source, wanted)
    same = found["doc"].eqNullSafe(wanted["doc"]) & (found["line"] == wanted["line"])
    held = wanted.join(found, same).select("id", "first", "text")

    def right(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows that share a key may hold other lines at the same place."""
        for batch in batches:
            pairs = zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())
            yield batch.filter(pa.array([line_id(line) == one for one, line in pairs], pa.bool_()))

    schema = f"id binary, first {PLACE.format(kind=kind)}, text string"
    held = common.written(common.mapped(held, right, schema).dropDuplicates(["id"]), "line-texts")

    keyed = common.written(
        common.mapped(held.select("id", "text"), _segments, "id binary, keys array<long>"), "line-segments"
    )
    opened = _shared(keyed).groupBy("id").agg(F.collect_set("pos").alias("opened"))
    single = held.select("id", "text").join(opened, "id").select("id", "text", "opened")
    posts = common.mapped(single, _single, "id binary, key long, at int").join(
        held.select("id", F.struct("first", "id").alias("me")), "id"
    )
    posts = common.written(posts, "line-variants")

    # Deletions at the same place: one character changed. A whole line and a deletion: one more.
    changed = posts.groupBy("key", "at").agg(F.min("me").alias("best"))
    whole = F.col("at") < 0
    longer = changed.groupBy("key").agg(
        F.min(F.when(whole, F.col("best"))).alias("uncut"), F.min(F.when(~whole, F.col("best"))).alias("cut")
    )
    pairs = posts.join(changed, ["key", "at"]).select("me", "best").unionByName(
        posts.join(longer, "key").select("me", F.when(whole, F.col("cut")).otherwise(F.col("uncut")).alias("best"))
    )
    pairs = pairs.filter("best < me").distinct()
    one = held.select(F.col("id").alias("one"), F.col("text").alias("a"))
    two = held.select(F.col("id").alias("two"), F.col("text").alias("b"))
    pairs = pairs.select(F.col("me.id").alias("one"), F.col("best.id").alias("two"), F.col("best.first").alias("best"))
    verified = pairs.join(one, "one").join(two, "two").filter(F.levenshtein("a", "b", 1) >= 0)
    return verified.groupBy(F.col("one").alias("id")).agg(F.min("best").alias("best"))


def keep(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows and columns, the text without the lines that go."""
    place, kinds = docs.columns.index(text), docs.schema
    data = common.numbered(docs)
    gone = dropped(docs, key, text).select(F.col("doc").alias("_doc"), F.col("lines").alias("_gone"))
    data = data.join(gone, data[f"c{docs.columns.index(key)}"].eqNullSafe(gone["_doc"]), "left").drop("_doc")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.steps(batches, place):
            texts = batch.column(place).to_pylist()
            for row, out in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                if out and texts[row]:
                    texts[row] = _without(texts[row], {(o["line"], o["id"]) for o in out})
            columns = batch.columns[:-1]
            columns[place] = pa.array(texts, columns[place].type)
            yield pa.RecordBatch.from_arrays(columns, names=kinds.names)

    return common.mapped(data, cut, kinds)


def _without(text: str, out: set[tuple[int, bytes]]) -> str:
    places = {place for place, _ in out}
    return "\n".join(
        line for place, line in enumerate(text.split("\n")) if place not in places or (place, line_id(line)) not in out
    )


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: its number of lines, and digest and length of what ``keep`` leaves of its text."""
    before = F.when(F.length(text) > 0, F.size(F.split(text, "\n"))).otherwise(0).cast("long")
    # Counted before the texts are moved, so that each is moved once.
    left = docs.select(F.col(key).alias("doc_id"), before.alias("n_lines"), F.col(text).alias("kept"))
    left = keep(left, "doc_id", "kept")
    kept = F.coalesce("kept", F.lit(""))
    return left.select(
        "doc_id",
        "n_lines",
        F.sha2(kept, 256).alias("kept_sha256"),
        F.length(kept).cast("long").alias("n_kept_chars"),
    )
