import random

import numpy as np
import pytest

from tidemark.llm import toxicity

MODEL = toxicity.Model(weights={"gronk ": 6.0, "blarf": 6.0}, curve=(1.0, 0.5, 0.0, -4.0), rate=0.1)


def clause(text):
    return MODEL.clause(text)


def test_grammar():
    plain, aimed = clause("what a gronk"), clause("you are a gronk")
    assert 0 < plain < aimed
    assert clause("you are not a gronk") < plain
    assert clause("they said you are a gronk") < aimed
    assert clause('"you gronk" is a phrase') < aimed
    assert clause("a nice day") == 0
    # A beginning counts for every word it starts; a whole word only for itself.
    assert clause("blarfish") == plain and clause("gronkish") == 0
    # Negation ends after a few words.
    assert clause("not one two three gronk") == plain


def test_threats():
    threats = ["i will kill you", "i am going to hurt you", "kill him now", "ich werde dich töten", "je vais te tuer"]
    # No object, no intent, or the target is the subject.
    others = ["they shoot films", "you kill", "kill the lights", "you they will kill", "you will burn", "he hurt them"]
    assert len({clause(text) for text in threats}) == 1 and clause(threats[0]) > 0
    assert all(clause(text) == 0 for text in others)
    assert 0 < clause("i will not kill you") < clause(threats[0]) > clause("he said i will kill you") > 0
    assert clause("i will kill one two three four you") == 0


def test_both_directions():
    plain, aimed = clause("what a gronk"), clause("you gronk")
    assert clause("what a gronk you are") == aimed > plain
    assert clause("a gronk one two three four you") == plain == clause("you one two three four gronk")
    assert clause("a gronk it is not") == clause("not a gronk") < plain
    assert clause("gronk one two three not") == plain


def test_composition_by_hand():
    """The tables give what the parts give one after the other."""
    rng = random.Random(1)
    for _ in range(200):
        symbols = rng.choices(toxicity.SYMBOLS, k=12)
        marked, state, at = [], toxicity.ONWARD.start, 0
        for symbol in symbols:
            out, _, state = toxicity.ONWARD.step(state, symbol)
            assert out == toxicity.MARKS[at][symbol][0]
            at = toxicity.MARKS[at][symbol][2]
            marked.append(out)
        state, at = toxicity.BACKWARD.start, 0
        for symbol in reversed(marked):
            _, factor, state = toxicity.BACKWARD.step(state, symbol)
            _, got, at = toxicity.FACTORS[at][symbol]
            assert got == pytest.approx(factor) and (symbol[0] in "ih" or not factor)


def test_whole_text_is_measured():
    scanner = MODEL.scanner()
    far = "a clean sentence. " * 5000 + "you gronk. another blarfish day!"
    best, total, clauses = MODEL.measure(far, scanner)
    assert clauses == 2 and best == pytest.approx(clause("you gronk")) and total > best
    assert MODEL.measure("", scanner) == (0, 0, 0)
    one = "gronk " * 10_000
    assert MODEL.measure(one, scanner)[2] == 1


def training(spark, n=400, seed=2):
    """Toxic texts hold an invented insult or a word with an invented beginning."""
    rng = random.Random(seed)
    words = [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(20) for j in range(20)]
    rows, labels = [], []
    for i in range(n):
        text = rng.choices(words, k=rng.randint(5, 80))
        toxic = i % 4 == 0
        if toxic:
            for _ in range(rng.randint(1, 4)):
                text.insert(rng.randrange(len(text)), rng.choice(["scumble", f"zorp{rng.choice(words)}"]))
        rows.append((i, " ".join(text) + "."))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS toxic", "2 AS feature")
    return docs, spark.createDataFrame(labels, "doc_id long, toxic int")


def test_learns_words_and_beginnings(spark):
    docs, labels = training(spark)
    model = toxicity.learn(docs, labels.filter("doc_id < 300"))
    assert "scumble " in model.weights and "zorp" in model.weights
    rows = toxicity.score(docs, model).join(labels, "doc_id").filter("doc_id >= 300").collect()
    assert all(r.predicted == r.toxic for r in rows)
    clean = toxicity.keep_clean(docs, model)
    assert clean.columns == docs.columns
    assert {r.doc_id % 4 for r in clean.collect()} == {1, 2, 3}


def test_edges(spark, documents, edge_rows):
    data = documents(edge_rows)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    for labels in (none, spark.createDataFrame([(4, 0), (None, 1), (5, None)], "doc_id long, toxic int")):
        model = toxicity.learn(data, labels)
        rows = toxicity.score(data, model).collect()
        assert len(rows) == len(edge_rows) and all(0 <= r.score < 0.5 and r.predicted == 0 for r in rows)
    both = spark.createDataFrame([(4, 0), (7, 1), (7, 0), (2, 0)], "doc_id long, toxic int")
    model = toxicity.learn(data, both)
    assert toxicity.score(data, model).count() == len(edge_rows)
    assert toxicity.keep_clean(documents([]), model).count() == 0
    assert toxicity.learn(documents([]), both).curve == ()


def test_logistic_fit():
    rng = np.random.default_rng(0)
    measures = rng.random((500, 3)) * 5
    toxic = (measures[:, 0] > 2.5).astype(float)
    model = toxicity.Model(curve=toxicity.fit_curve(measures, toxic))
    assert ((model.probability(measures) >= 0.5) == toxic).mean() > 0.95
