"""Toxicity by a weighted finite-state grammar over clauses.

Words become symbols: insult, threatening verb, target, intent, negation, reporting word,
quotation mark or other. Small transducers each rewrite the symbols with marks: what a
negation reaches, what is said by somebody else, what is aimed at somebody, what is
intended. One composition reads a clause from the left, another reads what that wrote from the
right, so that negations, targets and objects count on both sides; it ends in transducers
for insults and for threats, which give factors. A threat takes an intent (or stands first,
as an order), a verb and an object; a target before the verb is its subject and does not count.
Only clauses with an insult or a threatening verb are run; a clause scores the sum of its
words' weights times their factors, so a bare insult weighs less than one aimed at somebody,
and a denied or quoted one less than a plain one. The strongest clause, the sum over clauses
and their number give the probability by a logistic curve.

Insults are learned from labelled rows: whole words and word beginnings that stand in
far more toxic than other texts. Counts go over all labelled rows; the logistic curve
is fitted on at most ``FIT_ROWS`` of them, picked by a hash of the key.

Rows: null and empty texts get the score of a text without matches; without labels of
both kinds every score is below one half; a key labelled twice counts as toxic if one
label says so, null labels and null keys teach nothing; repeated rows each give a row;
an empty table gives an empty table; only the key and the text column are read. Texts
are worked on whole.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common

# Labelled rows that the logistic curve is fitted on at most.
FIT_ROWS = 20_000
# A feature stands in at least this share of the toxic texts, and in so many.
SUPPORT_SHARE = 0.01
SUPPORT = 4
# Most features that are weighed; a text of a thousand features cannot reach it at the share above.
FEATURES = 200_000
# Least log odds of an insult: twenty times as frequent in toxic texts.
LEAST_WEIGHT = 3.0
PREFIXES = (4, 5, 6)
# A threat weighs what the weakest insult does.
THREAT_WEIGHT = LEAST_WEIGHT
CLAUSE_CAP = 10.0

# Words of the grammar, in English, German, French and Spanish.
TARGETS = frozenset(
    "you your yours yourself u ur he she they them his her their him du dich dir dein deine ihr euch euer "
    "sie er tu te toi ton ta vous votre il elle ils elles usted ustedes tú tu te vosotros él ella ellos".split()
)
# Of these, those that stand before their verb as its object.
CLITICS = frozenset("dich dir euch ihn te os lo los".split())
INTENTS = frozenset(
    "will ll going gonna shall must should want wanna let werde werden wird will muss soll sollte lass lasst "
    "wollen vais va allons veux dois voy vas vamos quiero debo".split()
)
NEGATIONS = frozenset(
    "not no never neither nor without isn aren wasn weren don doesn didn nicht kein keine keinen nie niemals "
    "ohne ne pas jamais sans aucun nunca jamás tampoco sin ningún".split()
)
REPORTING = frozenset(
    "said says say told tells called calls wrote writes quoted quotes reported reports claimed claims "
    "sagte sagt schrieb schreibt nannte dit disait écrit appelé dijo dice escribió llamó".split()
)
THREATS = frozenset(
    "kill hurt destroy beat burn smash shoot stab hang strangle töten umbringen verletzen zerstören "
    "verbrennen tuer blesser détruire brûler frapper matar herir destruir quemar golpear".split()
)

_WORD = re.compile(r"[^\W\d_]+")
_TOKEN = re.compile(r"[^\W\d_]+|[\"“”«»„]")
BREAKS = ".!?;:\n|"
_BREAK = re.compile("[" + re.escape(BREAKS) + "]")
_QUOTES = frozenset('"“”«»„')

# Symbols: i insult, h threatening verb, t target, c pronoun that is an object before its verb too,
# m intent, n negation, r reporting word, q quotation mark, o other.
SYMBOLS = "ihtcmnrqo"
NEGATION_REACH, TARGET_REACH, INTENT_REACH, OBJECT_REACH = 3, 4, 4, 3


@dataclass
class Transducer:
    """A deterministic transducer: ``step(state, symbol)`` gives output, factor and next state."""

    start: object
    step: Callable[[object, str], tuple[str, float, object]]


def compose(*parts: Transducer) -> Transducer:
    """Each reads what the one before it writes; factors multiply."""

    def step(states, symbol):
        factor, after = 1.0, []
        for part, state in zip(parts, states):
            symbol, one, state = part.step(state, symbol)
            factor *= one
            after.append(state)
        return symbol, factor, tuple(after)

    return Transducer(tuple(part.start for part in parts), step)


def _reach(markers: str, mark: str, words: int, marked: str = "ih", start: int = 0) -> Transducer:
    """Marks symbols within so many words after a marker, or after the start of the clause."""

    def step(left, symbol):
        if symbol[0] == "q":
            return symbol, 1.0, left
        if symbol[0] in markers:
            return symbol, 1.0, words
        return symbol + mark if left and symbol[0] in marked else symbol, 1.0, max(0, left - 1)

    return Transducer(start, step)


def _reported() -> Transducer:
    """Marks insults and threats between quotation marks, and in a clause after a reporting word."""

    def step(state, symbol):
        quoted, told = state
        if symbol[0] == "q":
            quoted = not quoted
        told = told or symbol[0] == "r"
        return symbol + "'" if (quoted or told) and symbol[0] in "ih" else symbol, 1.0, (quoted, told)

    return Transducer((False, False), step)


def _insult() -> Transducer:
    """An insult weighs more if somebody is meant, on whichever side of it."""

    def step(state, symbol):
        if symbol[0] != "i":
            return symbol, 1.0, state
        return symbol, 1.25 if "@" in symbol else 1.0, state

    return Transducer(None, step)


def _threat() -> Transducer:
    """A verb is a threat only with an intent and an object; a target before it is its subject."""

    def step(state, symbol):
        if symbol[0] != "h":
            return symbol, 1.0, state
        return symbol, 1.25 if "m" in symbol and "*" in symbol else 0.0, state

    return Transducer(None, step)


def _softened() -> Transducer:
    """What is denied or said by somebody else weighs less; all other symbols weigh nothing."""

    def step(state, symbol):
        if symbol[0] not in "ih":
            return symbol, 0.0, state
        return symbol, (0.4 if "-" in symbol else 1.0) * (0.6 if "'" in symbol else 1.0), state

    return Transducer(None, step)


# Read from the left. Intent is a word of intent or, for an order, the start of the clause.
ONWARD = compose(
    _reach("n", "-", NEGATION_REACH),
    _reported(),
    _reach("tc", "@", TARGET_REACH, "i"),
    _reach("m", "m", INTENT_REACH, "h", start=1),
    _reach("c", "*", OBJECT_REACH, "h"),
)
# Read from the right, over what the first has written.
BACKWARD = compose(
    _reach("n", "-", NEGATION_REACH),
    _reach("tc", "@", TARGET_REACH, "i"),
    _reach("tc", "*", OBJECT_REACH, "h"),
    _insult(),
    _threat(),
    _softened(),
)


def table_of(machine: Transducer, symbols: list[str]) -> list[dict[str, tuple[str, float, int]]]:
    """All states that can be reached, numbered from the start: output, factor and next state by symbol."""
    numbers, table = {machine.start: 0}, []
    todo = [machine.start]
    while todo:
        state = todo.pop(0)
        row = {}
        for symbol in symbols:
            out, factor, after = machine.step(state, symbol)
            if after not in numbers:
                numbers[after] = len(numbers)
                todo.append(after)
            row[symbol] = out, factor, numbers[after]
        table.append(row)
    return table


MARKS = table_of(ONWARD, list(SYMBOLS))
FACTORS = table_of(BACKWARD, sorted({out for row in MARKS for out, _, _ in row.values()}))


def features_of(word: str) -> list[str]:
    """What a word can be known by: itself, marked by a blank, and its beginnings."""
    return [word + " ", *(word[:n] for n in PREFIXES if len(word) > n)]


def text_features(text: str) -> set[str]:
    words = set(_WORD.findall(text.lower()))
    return {w + " " for w in words}.union(*({w[:n] for w in words if len(w) > n} for n in PREFIXES))


@dataclass
class Model:
    """Weights of the insults and of the logistic curve."""

    weights: dict[str, float] = field(default_factory=dict)
    curve: tuple[float, ...] = ()
    rate: float = 0.0

    def scanner(self) -> ahocorasick.Automaton:
        """Finds where a clause may hold an insult or a threat."""
        found = ahocorasick.Automaton()
        for word in {*(f.strip() for f in self.weights), *THREATS}:
            found.add_word(word, len(word))
        found.make_automaton()
        return found

    def symbol(self, word: str) -> tuple[str, float]:
        weight = max((self.weights.get(f, 0.0) for f in features_of(word)), default=0.0)
        if weight:
            return "i", weight
        if word in THREATS:
            return "h", THREAT_WEIGHT
        if word in NEGATIONS:
            return "n", 0.0
        if word in CLITICS:
            return "c", 0.0
        if word in TARGETS:
            return "t", 0.0
        if word in INTENTS:
            return "m", 0.0
        return ("r" if word in REPORTING else "o"), 0.0

    def clause(self, text: str) -> float:
        """The composed grammar run over one clause in lower case, onward and then backward."""
        state, read = 0, []
        for token in _TOKEN.findall(text):
            symbol, weight = ("q", 0.0) if token in _QUOTES else self.symbol(token)
            marked, _, state = MARKS[state][symbol]
            read.append((marked, weight))
        state, score = 0, 0.0
        for marked, weight in reversed(read):
            _, factor, state = FACTORS[state][marked]
            score += factor * weight
        return score

    def measure(self, text: str, scanner: ahocorasick.Automaton) -> tuple[float, float, float]:
        """Strongest clause, capped sum, and number of clauses that score, of a whole text."""
        text = text.lower()
        scores, done = [], 0
        for end, length in scanner.iter(text):
            start = end + 1 - length
            if start < done or (start and text[start - 1].isalpha()):
                continue
            low = max(done, *(text.rfind(c, done, start) + 1 for c in BREAKS))
            stop = _BREAK.search(text, end)
            done = stop.end() if stop else len(text)
            scores.append(self.clause(text[low:done]))
        scores = [s for s in scores if s > 0]
        return (
            max(scores, default=0.0),
            sum(min(s, CLAUSE_CAP) for s in scores),
            float(len(scores)),
        )

    def probability(self, measures: np.ndarray) -> np.ndarray:
        if not self.curve:
            return np.full(len(measures), min(self.rate, 0.49))
        return 1 / (1 + np.exp(-np.clip(_shaped(measures) @ np.array(self.curve), -30, 30)))


def _shaped(measures: np.ndarray) -> np.ndarray:
    return np.column_stack([measures[:, 0], np.log1p(measures[:, 1]), np.log1p(measures[:, 2]), np.ones(len(measures))])


def fit_curve(measures: np.ndarray, toxic: np.ndarray, ridge: float = 0.1, rounds: int = 50) -> tuple[float, ...]:
    """Logistic regression by Newton's method with a small penalty."""
    x, y = _shaped(measures), toxic.astype(float)
    w = np.zeros(x.shape[1])
    penalty = ridge * np.eye(len(w))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + penalty, x.T @ (y - p) - penalty @ w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(w.tolist())


def _counted(texts: DataFrame, only: frozenset[str] | None) -> DataFrame:
    """``feature`` and in how many texts it stands; each task sums up its own first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in common.steps(batches, 0):
            for text in batch.column(0).to_pylist():
                held = text_features(text or "")
                counts.update(held if only is None else held & only)
            if len(counts) > 2 * FEATURES:
                yield _counts(counts)
                counts = Counter()
        yield _counts(counts)

    return common.mapped(texts, run, "feature string, n long").groupBy("feature").agg(F.sum("n").alias("n"))


def _counts(counts: Counter[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["feature", "n"]
    )


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """A model from the texts that ``labels`` marks 0 or 1; pass only rows to learn from."""
    marks = labels.select(F.col(key).alias("doc_id"), F.col(label).alias("toxic")).dropna()
    marks = common.written(marks.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "marks")
    texts = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    both = texts.join(common.bounded(marks), "doc_id")
    # Copies of a toxic text would make all its words look toxic.
    toxic = common.written(both.filter("toxic = 1").select("text").distinct(), "toxic")
    n_toxic = toxic.count()
    n_other = marks.filter("toxic = 0").count()
    if not n_toxic or not n_other:
        return Model(rate=n_toxic / max(1, n_toxic + n_other))
    support = max(SUPPORT, math.ceil(SUPPORT_SHARE * n_toxic))
    often = _counted(toxic, None).filter(F.col("n") >= support).orderBy(F.desc("n"), "feature").limit(FEATURES)
    in_toxic = {r.feature: r.n for r in often.collect()}
    others = both.filter("toxic = 0").select("text")
    in_others = {r.feature: r.n for r in _counted(others, frozenset(in_toxic)).collect()}
    model = Model(rate=n_toxic / (n_toxic + n_other))
    for word, n in in_toxic.items():
        # The count in other texts is taken at the upper end of its error.
        other = in_others.get(word, 0)
        weight = math.log(n / (n_toxic + 1)) - math.log((other + 1 + math.sqrt(other)) / (n_other + 1))
        if weight >= LEAST_WEIGHT:
            model.weights[word] = weight
    chosen = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT_ROWS)
    sample = texts.join(F.broadcast(chosen), "doc_id")
    rows = np.array([tuple(r) for r in measured(sample, model, "toxic").collect()], float)
    if len(np.unique(rows[:, 0])) == 2:
        model.curve = fit_curve(rows[:, 1:4], rows[:, 0])
    return model


def measured(docs: DataFrame, model: Model, key: str, text: str = "text") -> DataFrame:
    """``key`` and what the grammar measures: ``best``, ``total``, ``clauses``, and the ``score``."""
    source = docs.select(F.col(key).alias(key), F.col(text).alias("text"))
    schema = f"{key} {dict(source.dtypes)[key]}, best double, total double, clauses double, score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = model.scanner()
        for batch in common.steps(batches, 1):
            values = [model.measure(t or "", scanner) for t in batch.column(1).to_pylist()]
            values = np.array(values, float).reshape(-1, 3)
            columns = [pa.array(c) for c in (*values.T, model.probability(values))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], [key, "best", "total", "clauses", "score"])

    return common.mapped(source, run, schema)


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``score`` and ``predicted``: 1 from one half on."""
    return measured(docs, model, key, text).select(
        key, "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def keep_clean(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows whose text scores below one half, with all their columns."""
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = model.scanner()
        for batch in common.steps(batches, place):
            values = [model.measure(t or "", scanner) for t in batch.column(place).to_pylist()]
            yield batch.filter(pa.array(model.probability(np.array(values, float).reshape(-1, 3)) < 0.5))

    return common.mapped(docs, run, docs.schema)


def held_out(key: str = "doc_id") -> Column:
    """Rows that nothing is learned from."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 5 == 0, F.lit(False))
