import numpy as np
import pytest

from tidemark.llm import language
from tidemark.llm.common import table

SMALL = "/root/testdata/sf0.01"


def test_gradients():
    network = language.Network.fresh(["a", "b", "c"], 4)
    data, mask = language.framed([b"hello wo", b"abc", b"zz top!"])
    label = np.array([0, 1, 2])
    _, grads = network.loss_and_gradients(data, mask, label)
    for name, values in network.parameters().items():
        at = np.unravel_index(np.abs(grads[name]).argmax(), values.shape)
        kept, sides = values[at], []
        for move in (0.01, -0.01):
            values[at] = kept + move
            sides.append(network.loss_and_gradients(data, mask, label)[0])
        values[at] = kept
        assert (sides[0] - sides[1]) / 0.02 == pytest.approx(grads[name][at], rel=0.05, abs=1e-4), name


def test_pooling_covers_whole_texts():
    """Windows of any width give what a plain walk over each window gives."""
    network = language.Network.fresh(["a", "b"], 4, seed=3)
    texts = [b"first text, a long one " * 9, b"x", b"another 123", b"m" * 64]
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    got = network.pooled(np.frombuffer(b"".join(texts), np.uint8), bounds, width=3)
    for i, text in enumerate(texts):
        total, letters = np.zeros(2), 0
        for at in range(0, len(text), language.WINDOW):
            data, mask = language.framed([text[at : at + language.WINDOW]])
            for t, p in network.positions(data, mask):
                if language._IS_LETTER[data[t, 0]]:
                    total += p[:, 0]
                    letters += 1
        assert got[:, i] == pytest.approx(total / letters, abs=1e-5)


@pytest.fixture(scope="module")
def learned(spark):
    docs = table(spark, SMALL, "documents")
    return docs, language.learn(docs.filter(~language.held_out()))


def test_held_out_accuracy(learned):
    docs, network = learned
    rows = docs.filter(language.held_out()).join(language.predict(docs, network), "doc_id").collect()
    assert len(rows) > 150
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) >= 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_edges(documents, edge_rows, learned):
    rows = edge_rows + [(30, "12 34 !?"), (31, "ß")]
    got = language.predict(documents(rows), learned[1]).collect()
    assert len(got) == len(rows)
    by_key = {r.doc_id: r for r in got}
    for key in (1, 2, 3, 9, 30):
        assert (by_key[key].lang_pred, by_key[key].score) == ("und", 0.0)
    assert by_key[31].lang_pred in learned[1].languages
    assert language.predict(documents([]), learned[1]).count() == 0


def test_nothing_to_learn_from(spark, documents):
    rows = documents([(1, "a text"), (2, None)]).selectExpr("*", "CAST(NULL AS STRING) AS lang")
    assert language.learn(rows) is None
    assert {r.lang_pred for r in language.predict(rows, None).collect()} == {"und"}
    mixed = spark.createDataFrame([(1, "some text", "xx"), (2, "12", "yy"), (None, "more", "xx")], "doc_id long, text string, lang string")
    assert language.learn(mixed).languages == ["xx"]
