"""Language of a text by a bidirectional gated recurrent network over its bytes.

A small network reads the bytes of a window in both directions; at every position the
two states give a probability for each language, and the mean over all positions that
hold letters is the text's probability. Texts of any length are cut into windows, none
is left out. Training runs in numpy by backpropagation through time, on windows of a
bounded sample: at most ``DOCS`` texts of a language, picked by a hash of the key, and
``WINDOWS`` windows from places all over each of them.

Rows: null texts and texts without a letter are ``und`` with score 0; without rows to
learn from all are; rows without a language teach nothing; repeated rows each give a
row; an empty table gives an empty table; only the key, the text and, for learning, the
language are read. Neither key nor language enters a prediction.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common

UNDETERMINED = "und"
# Bounds of the training sample.
DOCS = 500
WINDOWS = 8
# Bytes that the network reads in one go.
WINDOW = 64
HIDDEN = 8
EPOCHS = 4
BATCH = 128
RATE = 0.01
SEED = 7
# Windows that are run side by side.
WIDTH = 4096

_LETTER = re.compile(r"[^\W\d_]")
_IS_LETTER = np.array([chr(i).isalpha() and i < 128 or i >= 128 for i in range(256)])


def _soft(x: np.ndarray) -> np.ndarray:
    """x / (1 + |x|): a squashing function without exponentials."""
    return x / (1 + np.abs(x))


def _slope(y: np.ndarray) -> np.ndarray:
    """Derivative of ``_soft`` by its value."""
    return (1 - np.abs(y)) ** 2


class Gru:
    """One direction: gates and candidate of ``h`` units, columns are sequences."""

    names = ("embed", "recur", "bias")

    def __init__(self, hidden: int, rng: np.random.Generator):
        self.h = hidden
        self.embed = rng.normal(0, 0.3, (3 * hidden, 256)).astype(np.float32)
        self.recur = rng.normal(0, 0.5 / np.sqrt(hidden), (3 * hidden, hidden)).astype(np.float32)
        self.bias = np.zeros((hidden, 1), np.float32)

    def step(self, byte: np.ndarray, state: np.ndarray):
        """Next state, with what the way back needs."""
        h = self.h
        given = self.embed[:, byte]
        pull = self.recur @ state
        gates = _soft(given[: 2 * h] + pull[: 2 * h])
        opened = 0.5 + 0.5 * gates
        inner = pull[2 * h :] + self.bias
        candidate = _soft(given[2 * h :] + opened[h:] * inner)
        return state + opened[:h] * (candidate - state), (gates, opened, inner, candidate, state)

    def forward(self, data: np.ndarray, mask: np.ndarray):
        """States after every position; positions outside the mask keep none."""
        state = np.zeros((self.h, data.shape[1]), np.float32)
        states, notes = [], []
        for byte, on in zip(data, mask, strict=True):
            state, note = self.step(byte, state)
            state = state * on
            states.append(state)
            notes.append(note)
        return states, notes

    def backward(self, data, mask, notes, wanted):
        """Gradients of the parameters from those of the states, last position first."""
        h = self.h
        grads = {n: np.zeros_like(getattr(self, n)) for n in self.names}
        carry = np.zeros_like(wanted[0])
        for t in range(len(data) - 1, -1, -1):
            gates, opened, inner, candidate, before = notes[t]
            d = (wanted[t] + carry) * mask[t]
            d_candidate = d * opened[:h] * _slope(candidate)
            d_update = d * (candidate - before) * 0.5 * _slope(gates[:h])
            d_reset = d_candidate * inner * 0.5 * _slope(gates[h:])
            d_inner = d_candidate * opened[h:]
            d_pull = np.vstack([d_update, d_reset, d_inner])
            d_given = np.vstack([d_update, d_reset, d_candidate])
            np.add.at(grads["embed"].T, data[t], d_given.T)
            grads["recur"] += d_pull @ before.T
            grads["bias"] += d_inner.sum(1, keepdims=True)
            carry = d * (1 - opened[:h]) + self.recur.T @ d_pull
        return grads


@dataclass
class Network:
    """Both directions and the layer that labels a position."""

    languages: list[str]
    ahead: Gru
    back: Gru
    out: np.ndarray
    base: np.ndarray

    @classmethod
    def fresh(cls, languages: list[str], hidden: int, seed: int = SEED) -> Network:
        rng = np.random.default_rng(seed)
        hidden = max(hidden, len(languages))
        out = rng.normal(0, 0.1, (len(languages), 2 * hidden)).astype(np.float32)
        return cls(
            languages, Gru(hidden, rng), Gru(hidden, rng), out, np.zeros((len(languages), 1), np.float32)
        )

    def parameters(self) -> dict[str, np.ndarray]:
        both = {f"{d}.{n}": getattr(getattr(self, d), n) for d in ("ahead", "back") for n in Gru.names}
        return both | {"out": self.out, "base": self.base}

    def _label(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        scores = self.out @ np.vstack([first, second]) + self.base
        scores = np.exp(scores - scores.max(0))
        return scores / scores.sum(0)

    def positions(self, data: np.ndarray, mask: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Probabilities at every position, last one first."""
        states = []
        state = np.zeros((self.ahead.h, data.shape[1]), np.float32)
        whole = bool(mask.all())
        for byte in data:
            state = self.ahead.step(byte, state)[0]
            states.append(state)
        state = np.zeros_like(state)
        for t in range(len(data) - 1, -1, -1):
            state = self.back.step(data[t], state)[0]
            if not whole:
                state = state * mask[t]
            yield t, self._label(states[t], state)

    def loss_and_gradients(self, data: np.ndarray, mask: np.ndarray, label: np.ndarray):
        """Mean cross entropy over all positions and its gradients."""
        first, notes = self.ahead.forward(data, mask)
        second, back_notes = self.back.forward(data[::-1], mask[::-1])
        second = second[::-1]
        n, total = mask.sum(), 0.0
        grads = {"out": np.zeros_like(self.out), "base": np.zeros_like(self.base)}
        wanted, back_wanted = [], []
        for t in range(len(data)):
            p = self._label(first[t], second[t])
            total -= (np.log(p[label, np.arange(len(label))] + 1e-9) * mask[t]).sum()
            p[label, np.arange(len(label))] -= 1
            p *= mask[t] / n
            grads["out"] += p @ np.vstack([first[t], second[t]]).T
            grads["base"] += p.sum(1, keepdims=True)
            d = self.out.T @ p
            wanted.append(d[: self.ahead.h])
            back_wanted.append(d[self.ahead.h :])
        for name, value in self.ahead.backward(data, mask, notes, wanted).items():
            grads[f"ahead.{name}"] = value
        back = self.back.backward(data[::-1], mask[::-1], back_notes, back_wanted[::-1])
        for name, value in back.items():
            grads[f"back.{name}"] = value
        return total / n, grads

    def train(self, windows: list[bytes], labels: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> None:
        """Adam over shuffled batches."""
        rng = np.random.default_rng(seed)
        parameters = self.parameters()
        mean = {n: np.zeros_like(p) for n, p in parameters.items()}
        square = {n: np.zeros_like(p) for n, p in parameters.items()}
        step, steps = 0, epochs * -(-len(windows) // BATCH)
        for _ in range(epochs):
            order = rng.permutation(len(windows))
            for at in range(0, len(order), BATCH):
                rows = order[at : at + BATCH]
                data, mask = framed([windows[i] for i in rows])
                _, grads = self.loss_and_gradients(data, mask, labels[rows])
                step += 1
                rate = RATE * (1 - 0.9 * step / steps)
                for n, p in parameters.items():
                    mean[n] = 0.9 * mean[n] + 0.1 * grads[n]
                    square[n] = 0.999 * square[n] + 0.001 * grads[n] ** 2
                    move = mean[n] / (1 - 0.9**step)
                    p -= (rate * move / (np.sqrt(square[n] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)

    def pooled(self, raw: np.ndarray, bounds: np.ndarray, width: int = WIDTH) -> np.ndarray:
        """Mean probabilities of texts that lie one after the other, over bytes of letters."""
        counts = -(-np.diff(bounds) // WINDOW)
        owner = np.repeat(np.arange(len(counts)), counts)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        start = bounds[owner] + nth * WINDOW
        length = np.minimum(WINDOW, bounds[owner + 1] - start)
        # Full windows run together, so that few batches need a mask.
        order = np.argsort(-length, kind="stable")
        sums, letters = np.zeros((len(self.languages), len(counts))), np.zeros(len(counts))
        for at in range(0, len(order), width):
            rows = order[at : at + width]
            place = start[rows] + np.arange(length[rows[0]])[:, None]
            mask = (place < (start + length)[rows]).astype(np.float32)
            data = raw[np.minimum(place, len(raw) - 1)]
            counted = mask * _IS_LETTER[data]
            window_sums = np.zeros((len(self.languages), len(rows)), np.float32)
            for t, p in self.positions(data, mask):
                window_sums += p * counted[t]
            for k in range(len(self.languages)):
                sums[k] += np.bincount(owner[rows], window_sums[k], len(counts))
            letters += np.bincount(owner[rows], counted.sum(0), len(counts))
        return sums / np.maximum(letters, 1)


def framed(windows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes by position and window, and which of them are there."""
    longest = max(map(len, windows))
    data = np.zeros((longest, len(windows)), np.uint8)
    mask = np.zeros((longest, len(windows)), np.float32)
    for i, w in enumerate(windows):
        data[: len(w), i] = np.frombuffer(w, np.uint8)
        mask[: len(w), i] = 1
    return data, mask


def sample_windows(docs: DataFrame, key: str, text: str, lang: str) -> DataFrame:
    """``lang`` and ``bytes`` of windows to learn from."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    rows = rows.filter("lang is not null and text is not null")
    rank = F.expr("row_number() over (partition by lang order by xxhash64(key), key)")
    # Keys are ranked without their texts, which are then fetched for the few that are chosen.
    chosen = rows.select("lang", "key").withColumn("rank", rank).filter(F.col("rank") <= DOCS)
    chosen = common.written(chosen.select("lang", "key").distinct(), "chosen")
    sample = rows.join(F.broadcast(chosen), ["lang", "key"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.steps(batches, 1):
            langs, cuts = [], []
            for language, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if not _LETTER.search(value):
                    continue
                raw = value.encode().lower()
                rng = np.random.default_rng(zlib.crc32(raw))
                last = max(0, len(raw) - WINDOW)
                for at in sorted({int(a) for a in rng.integers(0, last + 1, WINDOWS)}):
                    langs.append(language)
                    cuts.append(raw[at : at + WINDOW])
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(cuts, pa.binary())], ["lang", "bytes"]
            )

    return common.mapped(sample.select("lang", "text"), run, "lang string, bytes binary")


def learn(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Network | None:
    """A network trained on the rows; None if no row teaches anything."""
    rows = sample_windows(docs, key, text, lang).orderBy("lang", "bytes").collect()
    languages = sorted({r.lang for r in rows})
    if not languages:
        return None
    network = Network.fresh(languages, HIDDEN)
    number = {language: i for i, language in enumerate(languages)}
    # Languages with few rows count as much as others.
    by_language = [[bytes(r.bytes) for r in rows if r.lang == language] for language in languages]
    most = max(map(len, by_language))
    windows = [w for ws in by_language for w in (ws * -(-most // len(ws)))[:most]]
    labels = np.repeat([number[language] for language in languages], most)
    network.train(windows, labels)
    return network


def predict(docs: DataFrame, network: Network | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``lang_pred`` and ``score``."""
    source = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = f"{key} {dict(source.dtypes)['key']}, lang_pred string, score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.steps(batches, 1):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            known = np.array([network is not None and bool(_LETTER.search(t)) for t in texts], bool)
            langs, scores = np.full(len(texts), UNDETERMINED, object), np.zeros(len(texts))
            rows = np.flatnonzero(known)
            if len(rows):
                raws = [texts[i].encode().lower() for i in rows]
                bounds = np.concatenate([[0], np.cumsum([len(r) for r in raws])])
                pooled = network.pooled(np.frombuffer(b"".join(raws), np.uint8), bounds)
                best = pooled.argmax(0)
                langs[rows] = np.array(network.languages, object)[best]
                scores[rows] = np.minimum(1.0, pooled[best, np.arange(len(rows))])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(langs, pa.string()), pa.array(scores)], [key, "lang_pred", "score"]
            )

    return common.mapped(source, run, schema)


def held_out(key: str = "doc_id") -> Column:
    """Rows that nothing is learned from."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 4 == 2, F.lit(False))
