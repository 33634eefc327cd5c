"""Licence scan against brute force over words."""

import re

import pytest

from optlake.llm import licenses as L

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def brute(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    at, labels = [], set()
    for phrase, label in L.BASE_PHRASES.items():
        p = phrase.split()
        places = [i for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p]
        at += places
        labels |= {label} if places else set()
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def test_corpus_and_edges(docs, llm):
    from optlake.llm.queries import QUERIES

    rows = llm.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in QUERIES["op7_licenses"](llm, "/root/testdata/sf0.001").collect()}
    for r in rows:
        assert tuple(got[r.doc_id])[1:6] == brute(r.text)
    texts = [None, "", "CC-BY cc, by CC BY cc by-sa", "cc byé", "accc by", "All RIGHTS\nreserved " * 5000, "İ cc by", "x" * 10**6]
    found = {r.doc_id: r for r in L.scan_licenses(docs(texts)).collect()}
    for i, t in enumerate(texts):
        r = found[i]
        assert (r.n_words, len(r.base_starts), min(r.base_starts, default=None), max(r.base_starts, default=None), r.base_labels) == brute(t)
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert L.scan_licenses(docs([])).count() == 0


@pytest.mark.parametrize("text,labels,score", [
    ("MIT", {"mit"}, 0.95), ("GPL-3.0-only or MIT", {"gpl", "mit"}, 0.95), ("GPL-2.0-or-later and MIT", {"gpl", "mit"}, 0.5),
    ("mit or gpl-3.0 and cc-by-nc-4.0", {"mit", "gpl", "cc-by-nc"}, 0.95), ("(mit or gpl-3.0) and cc-by-nc-4.0", {"mit", "gpl", "cc-by-nc"}, 0.2),
    ("GPL-2.0 WITH Classpath-exception-2.0", {"gpl"}, 0.5), ("Apache-2.0 the rest is prose", {"apache"}, 0.9),
    ("(MIT or", set(), 1.0), ("and MIT", set(), 1.0), ("Own-Thing-1.0", {"other"}, 0.3), ("((mit))", {"mit"}, 0.95), ("mit)", {"mit"}, 0.95),
    ("", set(), 1.0)])
def test_expressions(text, labels, score):
    assert L.evaluate(text) == (labels, score)


def test_tags():
    scan = L.scanner()
    assert scan("x\n# SPDX-License-Identifier: (MIT OR Apache-2.0)\ncode")[3] == {"mit", "apache"}
    assert scan("SPDX-License-Identifier:")[3] == set()
    assert scan("under the MIT License.")[3] == {"mit"} and scan("permit license")[3] == set()


def test_many_tags_in_one_line():
    """Each tag reads its own expression only: the time is linear in the line."""
    import time

    tag = next(iter(L.TAGS))
    scan, took = L.scanner(), []
    for n in (10_000, 40_000):
        line = f"{tag} mit or gpl-3.0; x; " * n
        t0 = time.time()
        found = scan(line)
        took.append(time.time() - t0)
        assert {"mit", "gpl"} <= found[3]
    assert took[1] < 10 * took[0] + 1 and took[1] < 15
