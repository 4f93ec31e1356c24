import random

import numpy as np
import pytest

from tidemark.llm import lines


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute(rows):
    """Texts that are left, in the order of the rows."""
    places = [
        ((key is None, key or 0, place), line)
        for key, text in rows
        for place, line in enumerate((text or "").split("\n"))
        if len(line) >= lines.LEAST
    ]
    out = []
    for key, text in rows:
        if text is None:
            out.append((key, None))
            continue
        left = [
            line
            for place, line in enumerate(text.split("\n"))
            if len(line) < lines.LEAST
            or not any(
                at < (key is None, key or 0, place) and abs(len(o) - len(line)) < 2 and edits(o, line) < 2
                for at, o in places
            )
        ]
        out.append((key, "\n".join(left)))
    return out


def check(spark, rows):
    got = lines.keep(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(repr, ((r.doc_id, r.text) for r in got))) == sorted(map(repr, brute(rows)))
    return got


def changed(rng, line):
    at, char = rng.randrange(len(line) + 1), rng.choice("abc é🦆")
    return rng.choice([line[:at] + char + line[at:], line[:at] + line[at + 1 :], line[:at] + char + line[at + 1 :]])


def test_equals_brute_force(spark):
    rng = random.Random(3)
    base = ["".join(rng.choices("ab ", k=rng.randint(8, 60))) for _ in range(30)]
    base += ["a" * 12, "a" * 13, "ab" * 8, "é🦆" * 9]
    rows = []
    for key in range(60):
        text = []
        for _ in range(rng.randint(1, 5)):
            line = rng.choice(base)
            for _ in range(rng.randint(0, 3)):
                line = changed(rng, line) or "x"
            text.append(line)
        rows.append((key * 7 % 60, "\n".join(text)))
    rows += [(3, "another line of document three"), (None, "a line without a key\n" + base[0]), (None, "a line without a kez")]
    check(spark, rows)


def test_one_edit_anywhere(spark):
    """Lines around every length and an edit at every place."""
    rng = random.Random(4)
    rows = []
    for size in (*range(10, 40), 400):
        line = "".join(rng.choices("abcdefgh", k=size))
        for at in range(0, size + 1, 1 if size < 40 else 37):
            forms = [line[:at] + "z" + line[at:], line[:at] + "y" + line[at + 1 :], line[:at] + line[at + 1 :]]
            rows += [[line, form] for form in forms if edits(form, line) < 2]
    for one, two in rows:
        for long, short in ((one, two), (two, one)):
            shared = set()
            for parts in (lines.HALVES, lines.SEGMENTS):
                a, b = lines.Variants(long).coarse(parts), lines.Variants(short).coarse(parts)
                shared = set(np.intersect1d(a, b).tolist())
                assert shared
            a, b = lines.Variants(long), lines.Variants(short)
            keys = []
            for v in (a, b):
                opened = [i for i, k in enumerate(v.coarse(lines.SEGMENTS).tolist()) if k in shared]
                keys.append(set(v.fine(opened, lines.SEGMENTS)[0].tolist()))
            assert keys[0] & keys[1], (long, short)


def test_keys_of_many_lines():
    rng = random.Random(5)
    held = ["".join(rng.choices("abé🦆", k=rng.choice([10, 11, 17, 33, 900]))) for _ in range(50)]
    for parts in (lines.HALVES, lines.SEGMENTS):
        assert lines.coarse_of(held, parts).to_pylist() == [lines.Variants(line).coarse(parts).tolist() for line in held]
        assert lines.coarse_of([], parts).to_pylist() == []


def test_two_edits_stay(spark):
    line = "the quick brown fox jumps over the lazy dog"
    check(spark, [(1, line), (2, line.replace("quick", "quack")), (3, line.replace("quick", "quaek")), (4, line[1:-1])])


def test_one_common_line(spark):
    """A third of all lines are one line; the earliest stays."""
    rows = [(i, f"line number {i * 7919} of its own {i}\n" + ("the common line" if i % 3 else "")) for i in range(600)]
    got = lines.keep(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [r.doc_id for r in got if "common" in r.text] == [1]


def test_edges(spark, documents, edge_rows):
    data = documents(edge_rows)
    got = lines.keep(data)
    assert got.columns == data.columns
    out = got.collect()
    assert len(out) == len(edge_rows)
    # Rows that repeat a key and a text are not earlier than each other.
    assert [r.text for r in out if r.doc_id == 7] == [t for k, t in edge_rows if k == 7]
    assert all(r.text is None for r in out if r.doc_id in (1, 9))
    assert [r.text for r in out if r.doc_id == 2] == [""]
    empty = documents([])
    assert lines.keep(empty).count() == 0 and lines.digests(empty).count() == 0


@pytest.mark.parametrize("name", ["id", "LINES", "first", "c0", "_gone"])
def test_clashing_columns(spark, name):
    data = spark.createDataFrame([(1, "one line of text", 5), (2, "one line of texts", 6)], f"doc_id long, text string, {name} int")
    assert [tuple(r) for r in lines.keep(data).orderBy("doc_id").collect()] == [(1, "one line of text", 5), (2, "", 6)]


@pytest.mark.parametrize("most", (0, 2_000_000))
def test_only_wanted_lines_are_moved(spark, documents, monkeypatch, most):
    """Beyond the bound all lines are joined by a shuffle; the result is the same."""
    rows = [(i, f"only {i} of these {i * 7919}\nshared line of text {'ab'[i % 2]}") for i in range(40)]
    data = documents(rows)
    monkeypatch.setattr(lines.common, "BROADCAST_IDS", most)
    source = data.select(data.doc_id.alias("doc"), "text")
    wanted = spark.createDataFrame([(3, 1), (4, 1)], "doc long, line int")
    found = [(r.doc, r.line) for r in lines._standing(source, wanted).collect()]
    assert sorted(found) == ([(3, 1), (4, 1)] if most else [(i, j) for i in range(40) for j in range(2)])
    assert sorted((r.doc_id, r.text) for r in lines.keep(data).select("doc_id", "text").collect()) == sorted(brute(rows))


def test_digests_move_each_text_once(spark, documents, monkeypatch):
    data = documents([(1, "a line that stays\na line that stays"), (2, None)])
    moved, keep = [], lines.keep
    monkeypatch.setattr(lines, "keep", lambda docs, *names: (moved.append(docs.dtypes), keep(docs, *names))[1])
    assert sorted((r.doc_id, r.n_lines, r.n_kept_chars) for r in lines.digests(data).collect()) == [(1, 2, 17), (2, 0, 0)]
    assert [kind for _, kind in moved[0]].count("string") == 1
