"""Byte-pair encoding and decoding with a public vocabulary.

Encoding a piece of text looks up, with one Aho-Corasick pass, the longest token
that starts at every byte. A backtracking walk then takes the longest token that
is compatible with the token before it, falls back to its longest shorter prefix,
and gives up a position for good once no token fits there, so every position is
visited a bounded number of times and the result is exactly that of applying the
merges in order. Two tokens are compatible if no merge would ever join bytes
across their border. Decoding gathers bytes through an offset table.

Rows: a null text counts as empty and has no tokens; repeated rows each give a
row; an empty table gives an empty table; only the key and the text column are
read, so other columns may have any name. Texts are worked on whole.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common

# The pattern that cuts text into pieces before the merges, in full
# and for text within Latin-1.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ÿ"
_DIGITS = "0-9²³¹¼½¾"
_SPACE = r"\t-\r \x85\xa0"
_ANY_TEXT = regex.compile(PIECES)
_LATIN = re.compile(
    rf"'(?:s|t|re|ve|m|ll|d)| ?[{_LETTERS}]+| ?[{_DIGITS}]+| ?[^{_SPACE}{_LETTERS}{_DIGITS}]+"
    rf"|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)
_BEYOND_LATIN = re.compile(r"[^\x00-\xff]")

# Pieces whose ids a worker remembers; the memory is emptied when it is full.
REMEMBERED = 400_000
REMEMBERED_BYTES = 64
NO_TOKEN = -1


def _byte_of_symbol() -> dict[str, int]:
    """The byte behind each symbol of a byte-level vocabulary.

    Printable Latin-1 characters stand for themselves, the others follow from 256 on.
    """
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class _Memory(dict):
    """Packed ids of pieces seen before; asks ``encode_piece`` for new ones."""

    def __init__(self, encode_piece):
        super().__init__()
        self.encode_piece = encode_piece

    def __missing__(self, piece: str) -> bytes:
        packed = np.array(self.encode_piece(piece.encode()), "<u4").tobytes()
        if len(piece) <= REMEMBERED_BYTES:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = packed
        return packed


class Pieces:
    """Cuts text into pieces and packs the ids that ``encode_piece`` gives for each.

    The strings of special tokens get their own ids wherever they stand.
    """

    def __init__(self, encode_piece, special: dict[str, int]):
        self.special = special
        self.known = _Memory(encode_piece)
        longest_first = sorted(special, key=len, reverse=True)
        self._cut = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")")

    def _plain(self, text: str) -> bytes:
        pieces = (_ANY_TEXT if _BEYOND_LATIN.search(text) else _LATIN).findall(text)
        return b"".join(map(self.known.__getitem__, pieces))

    def packed(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not any(word in text for word in self.special):
            return self._plain(text)
        return b"".join(
            np.array([self.special[part]], "<u4").tobytes() if part in self.special else self._plain(part)
            for part in self._cut.split(text)
        )


class Codec:
    """A vocabulary file of byte-level merges, ready to encode and decode."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        symbols = _byte_of_symbol()
        vocab = spec["model"]["vocab"]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = 1 + max([*vocab.values(), *special.values()])
        self.bytes = [b""] * size
        for word, token in vocab.items():
            self.bytes[token] = bytes(symbols[c] for c in word)
        for word, token in special.items():
            self.bytes[token] = word.encode()
        self._load_merges(spec["model"]["merges"], vocab, size)
        self._load_prefixes(vocab)
        self.lengths = np.array([len(b) for b in self.bytes], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.blob = np.frombuffer(b"".join(self.bytes), np.uint8)
        self.length = self.lengths.tolist()
        self.pieces = Pieces(self.encode_piece, special)
        self._fits: dict[tuple[int, int], bool] = {}

    def _load_merges(self, merges, vocab: dict[str, int], size: int) -> None:
        """For each token the merge that made it, and when: base tokens have order 0."""
        self.order = [0] * size
        self.left = list(range(size))
        self.right = list(range(size))
        self.joined: dict[tuple[int, int], int] = {}
        for when, merge in enumerate(merges, 1):
            first, second = merge.split(" ") if isinstance(merge, str) else merge
            a, b, token = vocab[first], vocab[second], vocab[first + second]
            self.joined[a, b] = token
            if not self.order[token]:
                self.order[token], self.left[token], self.right[token] = when, a, b

    def _load_prefixes(self, vocab: dict[str, int]) -> None:
        """Tokens that their own bytes encode to, the automaton over them, shorter prefixes."""
        self.token_of: dict[bytes, int] = {}
        for token in vocab.values():
            made = self.order[token]
            if not made or self._compatible(self.left[token], self.right[token], made):
                self.token_of[self.bytes[token]] = token
        self.shorter = [NO_TOKEN] * len(self.bytes)
        self.automaton = ahocorasick.Automaton()
        for word, token in self.token_of.items():
            self.automaton.add_word(word.decode("latin-1"), (len(word) - 1, token))
            for end in range(len(word) - 1, 0, -1):
                if (prefix := self.token_of.get(word[:end])) is not None:
                    self.shorter[token] = prefix
                    break
        self.automaton.make_automaton()

    def _compatible(self, a: int, b: int, limit: float = float("inf")) -> bool:
        """Whether no merge before ``limit`` joins the end of ``a`` with the start of ``b``.

        Goes back in time along both sides of the border: the later of the two
        merges is undone first, and each pair seen on the way must not have been
        joined while it lay there. Equal merges happen from left to right.
        """
        order = self.order
        while True:
            token = self.joined.get((a, b))
            if token is not None and order[token] < limit:
                return False
            if order[a] > order[b]:
                limit, a = order[a], self.right[a]
            elif order[b]:
                limit, b = order[b] + 1, self.left[b]
            else:
                return True

    def _fit(self, a: int, b: int) -> bool:
        known = self._fits.get((a, b))
        if known is None:
            if len(self._fits) >= REMEMBERED:
                self._fits.clear()
            known = self._fits[a, b] = self._compatible(a, b)
        return known

    def encode_piece(self, raw: bytes) -> list[int]:
        """The ids of one piece."""
        whole = self.token_of.get(raw)
        if whole is not None:
            return [whole]
        longest = [NO_TOKEN] * len(raw)
        for end, (back, token) in self.automaton.iter(raw.decode("latin-1")):
            longest[end - back] = token
        length, shorter, fits = self.length, self.shorter, self._fit
        closed = bytearray(len(raw) + 1)
        out: list[int] = []
        at, token = 0, longest[0]
        while True:
            end = at + length[token]
            if not closed[end] and (not out or fits(out[-1], token)):
                out.append(token)
                if end == len(raw):
                    return out
                at, token = end, longest[end]
            elif shorter[token] != NO_TOKEN:
                token = shorter[token]
            else:
                closed[at] = 1
                token = out.pop()
                at -= length[token]

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        return self.pieces.packed(text)

    def decode_bytes(self, packed: bytes) -> bytes:
        ids = np.frombuffer(packed, "<u4").astype(np.int64)
        lengths = self.lengths[ids]
        before = np.cumsum(lengths) - lengths
        place = np.repeat(self.starts[ids] - before, lengths)
        place += np.arange(len(place))
        return self.blob[place].tobytes()

    def decode(self, packed: bytes) -> str:
        return self.decode_bytes(packed).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One codec per worker process and file."""
    return Codec(path)


def encode(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``ids``: the token ids packed as little-endian unsigned 32-bit integers.

    ``vocabulary`` is the path of a tokenizers file that all machines can read.
    """
    source = docs.select(F.col(key), F.col(text).alias("text"))
    schema = f"{key} {dict(source.dtypes)[key]}, ids binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(vocabulary)
        for batch in common.steps(batches, 1):
            ids = [own.encode(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], [key, "ids"])

    return common.mapped(source, run, schema)


def decode(encoded: DataFrame, vocabulary: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key``, ``ids`` and the ``text`` they stand for; null ids count as none."""
    source = encoded.select(F.col(key), F.col(ids).alias("ids"))
    schema = f"{key} {dict(source.dtypes)[key]}, ids binary, text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(vocabulary)
        for batch in common.steps(batches, 1):
            texts = [own.decode(i or b"") for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string())], [key, "ids", "text"]
            )

    return common.mapped(source, run, schema)


def digests(decoded: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts and SHA-256 of the ids and of the decoded text."""
    return decoded.select(
        key,
        F.expr("coalesce(length(ids), 0) div 4").cast("long").alias("n_tokens"),
        F.sha2(F.coalesce("ids", F.lit(b"")), 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )
