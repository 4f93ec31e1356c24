"""Personal data in text, with column functions only.

Regular expressions propose spans. Validators confirm them: parts of an address
stay below 256, card numbers pass the Luhn sum, account numbers leave one when
divided by 97, phone numbers have 9 to 15 digits. Every span has a score that
starts with its kind and rises with telling words nearby. The four base kinds are
kept whatever the words around them are; the further kinds ``iban`` and ``ssn`` need
the score ``MIN_SCORE``.

A match's place comes from the lengths of the gaps and matches before it, so each
pattern reads the text once, and a second time only where it matches. The patterns
never go back over a run of characters: possessive repeats, and a match may only
start where a run starts or the last match ended, which finds the same matches as
the plain patterns.

Rows: a null text counts as empty and has no spans; every row gives a row; only the
text column is read and the result columns replace columns of the same name.
Positions count code points, ends are exclusive.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Characters on both sides of a span in which telling words count.
NEARBY = 40
NEARBY_SCORE = 0.4
MIN_SCORE = 0.5
# Entries that one step of a running sum goes over.
RUN = 256

_LOCAL = "A-Za-z0-9._%+-"
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"


@dataclass(frozen=True)
class Kind:
    """A kind of personal data: what proposes it, its first score, words that speak for it."""

    name: str
    pattern: str
    score: float
    words: str
    base: bool = True


KINDS = (
    Kind(
        "email",
        rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        0.9,
        "mail|contact|write",
    ),
    Kind("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", 0.5, "ip|address|host|server"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", 0.6, "card|visa|credit|payment"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 0.6, "phone|call|tel|mobile|fax"),
    Kind(
        "iban",
        r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[0-9]{1,3})?)",
        0.8,
        "iban|account|bank|konto",
        base=False,
    ),
    Kind(
        "ssn",
        r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
        0.3,
        "ssn|social security|tax id",
        base=False,
    ),
)
BASE_NAMES = tuple(k.name for k in KINDS if k.base)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _mod97(value: Column) -> Column:
    """Remainder of an account number, moved and spelt out as the standard says."""
    plain = F.replace(value, F.lit(" "), F.lit(""))
    moved = F.concat(F.substr(plain, F.lit(5)), F.substring(plain, 1, 4))

    def step(rest: Column, char: Column) -> Column:
        code = F.ascii(char)
        return F.when(code >= 65, (rest * 100 + code - 55) % 97).otherwise((rest * 10 + code - 48) % 97)

    return F.aggregate(F.split(moved, ""), F.lit(0), lambda r, c: F.when(c == "", r).otherwise(step(r, c)))


def _is_alnum(char: Column) -> Column:
    return char.rlike("^[A-Za-z0-9]$")


def _confirmed(kind: Kind, match: Column, before: Column, after: Column) -> Column:
    """Whether a proposed match holds; ``before`` and ``after`` are the text around it."""
    if kind.name == "ip":
        return match.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")
    if kind.name == "card":
        digits = _digits(match)
        # The sum is only asked for where the length is right.
        return F.when(F.length(digits).between(12, 19), F.call_function("luhn_check", digits)).otherwise(False)
    if kind.name == "phone":
        return F.length(_digits(match)).between(9, 15)
    apart = ~_is_alnum(F.right(before, F.lit(1))) & ~_is_alnum(F.left(after, F.lit(1)))
    if kind.name == "iban":
        return apart & (_mod97(match) == 1)
    if kind.name == "ssn":
        return apart
    return F.lit(True)


def _running(values: Column, start: Column) -> Column:
    """``start`` and the sums up to each value but the last."""
    sums = F.aggregate(values, F.array(start), lambda a, v: F.array_append(a, F.element_at(a, -1) + v))
    return F.slice(sums, 1, F.size(values))


def running(values: Column) -> Column:
    """Sums of all values before each; goes over runs, so long arrays stay cheap."""
    n = F.size(values)
    runs = F.transform(
        F.sequence(F.lit(0), F.floor((n - 1) / RUN).cast("int")), lambda i: F.slice(values, i * RUN + 1, RUN)
    )
    totals = F.transform(runs, lambda r: F.aggregate(r, F.lit(0), lambda a, v: a + v))
    offsets = _running(totals, F.lit(0))
    return F.flatten(F.zip_with(runs, offsets, lambda r, o: _running(r, o)))


_SPAN = "array<struct<start:int,place:int,end:int,kind:string,score:double>>"


def _spans(kind: Kind, place: int, text: Column, matches: Column, gaps: Column, starts: Column) -> Column:
    """Confirmed spans of one kind."""

    def span(match: Column, i: Column) -> Column:
        start = F.get(starts, i)
        before = F.right(F.get(gaps, i), F.lit(NEARBY))
        after = F.left(F.get(gaps, i + 1), F.lit(NEARBY))
        near = F.lower(F.concat_ws(" ", before, after)).rlike(rf"(?:^|[^a-z])(?:{kind.words})(?:[^a-z]|$)")
        score = F.least(F.lit(1.0), F.when(near, kind.score + NEARBY_SCORE).otherwise(kind.score))
        kept = _confirmed(kind, match, before, after)
        if not kind.base:
            kept = kept & (score >= MIN_SCORE)
        made = F.struct(
            start.cast("int").alias("start"),
            F.lit(place).alias("place"),
            (start + F.length(match)).cast("int").alias("end"),
            F.lit(kind.name).alias("kind"),
            score.alias("score"),
        )
        return F.when(kept, made)

    found = F.filter(F.transform(matches, span), lambda s: s.isNotNull())
    return F.when(F.size(matches) > 0, found).otherwise(F.array()).cast(_SPAN)


def find(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``found``: every span with kind, place and score, by start and then kind."""
    own = [f"_pii_{k.name}" for k in KINDS]
    body = F.coalesce(F.col(text), F.lit(""))
    out = docs.withColumns(
        {o: F.regexp_extract_all(body, F.lit(k.pattern), F.lit(0)) for o, k in zip(own, KINDS, strict=True)}
    )
    empty = F.array().cast("array<string>")
    out = out.withColumns(
        {
            f"{o}_gaps": F.when(F.size(o) > 0, F.split(body, k.pattern, -1)).otherwise(empty)
            for o, k in zip(own, KINDS, strict=True)
        }
    )

    def lengths(o: str) -> Column:
        """Of each gap and the match after it."""
        return F.zip_with(
            F.slice(f"{o}_gaps", 1, F.size(o)), F.col(o), lambda gap, match: F.length(gap) + F.length(match)
        )

    out = out.withColumns({f"{o}_steps": F.when(F.size(o) > 0, lengths(o)) for o in own})
    out = out.withColumns(
        {
            f"{o}_starts": F.when(
                F.size(o) > 0,
                F.zip_with(
                    running(F.col(f"{o}_steps")),
                    F.transform(F.slice(f"{o}_gaps", 1, F.size(o)), F.length),
                    lambda a, b: a + b,
                ),
            )
            for o in own
        }
    )
    parts = [
        _spans(k, i, body, F.col(o), F.col(f"{o}_gaps"), F.col(f"{o}_starts"))
        for i, (o, k) in enumerate(zip(own, KINDS, strict=True))
    ]
    out = out.withColumn("found", F.array_sort(F.concat(*parts)))
    return out.drop(*own, *(f"{o}_{s}" for o in own for s in ("gaps", "steps", "starts")))


def written_out(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def digests(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts of the base kinds and the spans in text form."""
    base = F.filter("found", lambda s: s["kind"].isin(*BASE_NAMES))

    def count(name: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == name)).cast("long").alias(f"n_{name}")

    return found.select(
        key,
        *map(count, BASE_NAMES),
        F.sha2(written_out(base).cast("binary"), 256).alias("base_sha256"),
        written_out(F.col("found")).alias("spans"),
    )


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """Puts the kind in brackets in place of every span; overlapping spans become one.

    Keeps all columns; a null text stays null.
    """
    done = find(docs.select(F.struct("*").alias("row"), F.col(text).alias("text")))
    done = done.withColumn("found", _merged(F.col("found")))
    clean = F.when(F.size("found") > 0, _marked(F.col("text"), F.col("found"))).otherwise(F.col("text"))
    return done.select(*(clean.alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns))


def _merged(spans: Column) -> Column:
    """Overlapping spans as one, under the kind that starts first."""

    def segment(start: Column, end: Column, kind: Column) -> Column:
        return F.struct(start.alias("start"), end.alias("end"), kind.alias("kind"))

    def step(done: Column, span: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        wider = segment(last["start"], F.greatest(last["end"], span["end"]), last["kind"])
        return F.when(
            F.coalesce(span["start"] < last["end"], F.lit(False)),
            F.concat(F.slice(done, 1, F.size(done) - 1), F.array(wider)),
        ).otherwise(F.array_append(done, segment(span["start"], span["end"], span["kind"])))

    return F.aggregate(spans, F.array().cast("array<struct<start:int,end:int,kind:string>>"), step)


def _marked(text: Column, segments: Column) -> Column:
    """The text with a mark for each segment, built from cuts of ``RUN`` segments."""
    n = F.size(segments)

    def end_before(i: Column) -> Column:
        return F.coalesce(F.get(segments, i - 1)["end"], F.lit(0))

    def cut(number: Column) -> Column:
        low = end_before(number * RUN)
        high = end_before(F.least(n, (number + 1) * RUN))

        def mark(body: Column) -> Column:
            def one(segment: Column, i: Column) -> Column:
                start = end_before(number * RUN + i)
                gap = F.substr(body, start - low + 1, segment["start"] - start)
                return F.concat(gap, F.lit("["), F.upper(segment["kind"]), F.lit("]"))

            return F.array_join(F.transform(F.slice(segments, number * RUN + 1, RUN), one), "")

        # A bound variable, so that the cut is made once.
        return F.get(F.transform(F.array(F.substr(text, low + 1, high - low)), mark), F.lit(0))

    cuts = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / RUN).cast("int")), cut)
    tail = F.substr(text, end_before(n) + 1, F.length(text))
    return F.concat(F.array_join(cuts, ""), tail)
