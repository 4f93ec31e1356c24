import hashlib
import random
import re

import pytest

from tidemark.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, char in enumerate(reversed(digits)):
        value = int(char) * (1 + i % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def base(text):
    out = []
    for place, (kind, pattern) in enumerate(PLAIN.items()):
        for match in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", match.group())
            if kind == "ip" and max(map(int, match.group().split("."))) > 255:
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((match.start(), place, match.end(), kind))
    return ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in sorted(out))


def random_texts(n):
    rng = random.Random(3)
    parts = ["a", "b1", "@", ".", "x.y", "1", "42", "255", "300", "-", " ", "+1", "(", ")", "_", "é", "🦆"]
    parts += ["4041894974608795", "GB82WEST12345698765432", "123-45-6789", "ssn", "a@b.co"]
    return ["".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(n)]


TEXTS = [
    None,
    "",
    "a@b.c_d@e.f a@@b.c",
    "1.2.3.4.5.6.7.8.9 256.1.1.1 00255.1.1.1",
    "éé +1 (988) 555-2485 🦆 a@b.co 4041894974608795 1.2.3.4",
    "a" * 20_000,
    "1 " * 5_000,
    "a@b." * 1_000,
    "+1" + "(" * 5_000,
    *random_texts(250),
]


@pytest.fixture(scope="module")
def found(spark):
    data = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    data = data.selectExpr("*", "1 AS kind", "2 AS start", "3 AS row")
    return data, {r.doc_id: r for r in pii.digests(pii.find(data)).collect()}


def test_base_spans(found):
    for key, text in enumerate(TEXTS):
        row, plain = found[1][key], base(text or "")
        assert row.base_sha256 == hashlib.sha256(plain.encode()).hexdigest(), text
        kinds = [span.split(":")[0] for span in plain.split(",")]
        assert (row.n_email, row.n_ip, row.n_card, row.n_phone) == tuple(map(kinds.count, PLAIN))
        assert set(filter(None, plain.split(","))) <= set(row.spans.split(","))


def test_redaction_covers_every_span(found):
    data, spans = found
    got = pii.redact(data)
    assert got.columns == data.columns
    for row in got.collect():
        text = TEXTS[row.doc_id]
        merged = []
        for start, end, kind in sorted(
            (int(s), int(e), k) for k, s, e in (x.split(":") for x in spans[row.doc_id].spans.split(",") if x)
        ):
            if merged and start < merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], end)
            else:
                merged.append([start, end, kind])
        out, at = "", 0
        for start, end, _ in merged:
            out += text[at:start] + "\0"
            at = end
        plain = None if text is None else out + text[at:]
        marked = row.text and re.sub(r"\[(EMAIL|IP|CARD|PHONE|IBAN|SSN)\]", "\0", row.text)
        assert marked == plain


@pytest.mark.parametrize(
    "text, expected",
    [
        ("pay to DE89 3704 0044 0532 0130 00 now", ["iban"]),
        ("GB82WEST12345698765432", ["iban"]),
        ("GB82WEST12345698765433", []),
        ("xGB82WEST12345698765432", []),
        ("social security 123-45-6789", ["ssn"]),
        ("part 123-45-6789", []),
        ("call +1 (988) 555-2485", ["phone"]),
    ],
)
def test_validators_and_context(spark, text, expected):
    row = pii.find(spark.createDataFrame([(text,)], "text string")).first()
    assert [s.kind for s in row.found] == expected


def test_context_raises_the_score(spark):
    rows = spark.createDataFrame([("visa 4041894974608795",), ("x 4041894974608795",)], "text string")
    near, far = (r.found[0].score for r in pii.find(rows).collect())
    assert near > far


def test_plan_is_native_and_table_may_be_empty(spark, documents):
    data = pii.digests(pii.find(documents([])))
    assert data.count() == 0
    plan = data._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_many_spans_in_one_text(spark):
    text = "x a@b.co " * 3000
    data = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = pii.digests(pii.find(data)).first()
    assert row.n_email == 3000 and row.spans.split(",")[2999] == f"email:{2999 * 9 + 2}:{2999 * 9 + 8}"
    assert pii.redact(data).first().text == "x [EMAIL] " * 3000
