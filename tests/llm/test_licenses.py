import random

import numpy as np
import pytest

from tidemark.llm import licenses
from tidemark.llm.common import table

SMALL = "/root/testdata/sf0.01"
SCANNER = licenses.Scanner(licenses.TEMPLATES)
# Lines of the supplied tables.
LINES = {
    "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    "Released under the MIT License.": "MIT",
    "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
}


def names(text):
    return [n[2] for n in SCANNER.scan(text)]


@pytest.mark.parametrize("line", LINES)
def test_lines(line):
    text = f"Some prose before it.\n{line}\nSome prose behind it."
    ((start, stop, name, saved, changes),) = SCANNER.scan(text)
    assert name == LINES[line] and changes == "" and saved > 0
    assert text[start:stop] == line[line.lower().index("under") :].rstrip(".")
    assert names(line.upper().replace(" ", "\t")) == [name]


def test_versions_and_kinds():
    assert names("Licensed under the GNU General Public License, version 2.") == ["GPL-2.0"]
    assert names("Licensed under the GNU General Public License, version 9.") == []
    assert names("Licensed under the Apache License, Version 1.1.") == []
    assert names("Licensed under the GNU Lesser General Public License, version 3") == ["LGPL-3.0"]
    assert names("Licensed under CC BY 4.0.") == ["CC-BY-4.0"] and names("Licensed under CC BY-SA 4.0") == ["CC-BY-SA-4.0"]
    assert names("Licensed under CC BY-NC 3.0.") == []
    assert names("The license of the driver was taken. MIT is a university; she has a copyright.") == []
    both = "Licensed under CC BY 4.0. Released under the MIT License. Released under the MIT License."
    assert names(both) == ["CC-BY-4.0", "MIT", "MIT"]


@pytest.mark.parametrize("name", licenses.WORDINGS)
def test_wordings_with_changes(name):
    """Wrapped lines and a few other words are told; many other words are no notice."""
    words = licenses.WORDINGS[name].split()
    wrapped = "\n".join(" ".join(words[i : i + 9]) for i in range(0, len(words), 9))
    assert names(f"import this\n\n{wrapped}\n\nprint(1)") == [name]
    at = words.index("software" if name in ("ISC", "Unlicense") else "copyright")
    other = " ".join([*words[:at], "program", *words[at + 1 :]])
    ((*_, found, _, changes),) = SCANNER.scan(other)
    assert found == name and changes.split()[1] == "+program" and changes.startswith("-")
    rng = random.Random(1)
    assert names(" ".join(w if rng.random() < 0.6 else "other" for w in words)) == []


def test_every_template_has_a_cue():
    assert all(licenses._CUE.search(text) for _, text in licenses.TEMPLATES)
    assert not licenses._CUE.search("sie kam mit der Bahn, cc an alle")


def test_span_by_brute_force():
    rng = np.random.default_rng(2)

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    for _ in range(60):
        block, template = rng.integers(0, 3, rng.integers(0, 12)), rng.integers(0, 3, rng.integers(1, 6))
        least, start, end = licenses.nearest_span(block, template)
        spans = [(i, j) for i in range(len(block) + 1) for j in range(i, len(block) + 1)]
        assert least == min(edits(template, block[i:j]) for i, j in spans) == edits(template, block[start:end])


def test_differences():
    assert licenses.differences("a b c".split(), "a x c".split()) == "-b +x"
    assert licenses.differences("a b c e f".split(), "a c e f d".split()) == "-b +d"


def test_long_blocks():
    """Notices far inside, also where pieces of a block meet."""
    body = " ".join(licenses.WORDINGS["MIT"].split())
    for pad in (0, 1700, 1850, 1999, 5000):
        text = "license " * pad + body + " license" * 3000
        assert names(text) == ["MIT"]
    many = " ".join(["Released under the MIT License."] * 1500)
    assert names(many) == ["MIT"] * 1500


def test_tables(spark):
    """Every license line of the sample is found, and nothing else."""
    docs = table(spark, SMALL, "documents")
    got = {r.doc_id: r for r in licenses.report(licenses.find(docs)).collect()}
    rows = docs.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for key, text in rows:
        held = [LINES[line] for line in (text or "").split("\n") if line in LINES]
        assert got[key].n_notices == len(held) and got[key].licenses == ",".join(sorted(set(held))), text


def test_edges(spark, documents, edge_rows):
    rows = [*edge_rows, (None, "Released under the MIT License."), (20, "Released under the MIT License.")]
    out = licenses.report(licenses.find(documents(rows)))
    got = out.collect()
    assert len(got) == len(rows) and sum(r.n_notices for r in got) == 2
    assert all(r.licenses == "" and r.most_saved is None for r in got if not r.n_notices)
    assert licenses.report(licenses.find(documents([]))).count() == 0
    assert licenses.find(documents(rows), []).filter("size(notices) > 0").count() == 0
