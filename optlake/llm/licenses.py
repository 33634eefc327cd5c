"""Licence scan: identifier tags, notice phrases, and/or/with expressions.

One pass over the corpus, no shuffle.  A text becomes its words joined by
single blanks; an Aho-Corasick automaton over that string finds every notice
phrase, and one over the raw text finds identifier tags.  The expression after
a tag is parsed by a shunting-yard parser (``with`` binds tighter than ``and``,
``and`` tighter than ``or``) into reverse Polish form and evaluated to its
licence labels and to a permissiveness score: ``or`` takes the best branch,
``and`` the worst, ``with`` keeps the licence's own.

Defined results: null and empty texts have no words and no labels (score 1.0,
since nothing restricts them).  An expression that does not parse gives the
labels of its longest well-formed start.  Very long texts are read whole.
Repeated rows give repeated results; an empty table gives no rows.  Other columns
are ignored.
"""

from __future__ import annotations

import re

import ahocorasick
from pyspark.sql import DataFrame

from optlake.llm.common import map_columns, words_of

# Phrases of the contract and their labels.
BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# Notice phrases (as words) that the method adds, and their labels.
NOTICE_PHRASES = {
    "mit license": "mit", "apache license": "apache", "bsd license": "bsd", "isc license": "isc",
    "mozilla public license": "mpl", "lesser general public license": "lgpl",
    "affero general public license": "agpl", "cc by sa": "cc-by-sa", "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd", "cc0": "cc0", "public domain": "public-domain", "unlicense": "unlicense",
    "creative commons attribution": "cc-by", "creative commons zero": "cc0",
    "permission is hereby granted free of charge": "mit",
    "redistribution and use in source and binary forms": "bsd",
}
# Identifiers (lower case, without version and suffix) and their labels.
IDENTIFIERS = {
    "mit": "mit", "apache": "apache", "bsd": "bsd", "isc": "isc", "mpl": "mpl", "lgpl": "lgpl", "agpl": "agpl",
    "gpl": "gpl", "cc-by": "cc-by", "cc-by-sa": "cc-by-sa", "cc-by-nc": "cc-by-nc", "cc-by-nd": "cc-by-nd",
    "cc-by-nc-sa": "cc-by-nc", "cc-by-nc-nd": "cc-by-nc", "cc0": "cc0", "unlicense": "unlicense", "zlib": "zlib",
}
TAGS = ("spdx-license-identifier:", "license-expression:")
# How freely a text under the label may be used, 0 to 1.
OPENNESS = {
    "cc0": 1.0, "public-domain": 1.0, "unlicense": 1.0, "mit": 0.95, "isc": 0.95, "zlib": 0.95, "bsd": 0.95,
    "apache": 0.9, "cc-by": 0.85, "mpl": 0.7, "lgpl": 0.6, "cc-by-sa": 0.6, "gpl": 0.5, "agpl": 0.4,
    "cc-by-nd": 0.3, "cc-by-nc": 0.2, "other": 0.3, "reserved": 0.0,
}
_BINDS = {"or": 1, "and": 2, "with": 3}
_TOKEN = re.compile(r"\(|\)|[a-z0-9][a-z0-9.+-]*")
_VERSION = re.compile(r"-v?\d[\d.]*(-only|-or-later|-clause)?\+?$|\+$")

def automaton(patterns) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for p in patterns:
        found.add_word(p, p)
    found.make_automaton()
    return found


def identifier_label(token: str) -> str:
    token = _VERSION.sub("", token)
    while token and token not in IDENTIFIERS:
        token = token.rpartition("-")[0]
    return IDENTIFIERS.get(token, "other")


def well_formed_start(tokens) -> list[str]:
    """The longest start of a token stream that is a whole expression; reads no token past the first fault."""
    read, best, depth, operand = [], 0, 0, False
    for t in tokens:
        opens = t == "(" or t not in _BINDS and t != ")"
        if opens == operand:  # an operand or "(" follows an operand, or an operator or ")" follows none
            break
        if t == ")" and not depth:
            break
        depth += (t == "(") - (t == ")")
        operand = t == ")" or opens and t != "("
        read.append(t)
        if operand and not depth:
            best = len(read)
    return read[:best]


def to_postfix(tokens: list[str]) -> list[str]:
    """Shunting-yard: a well-formed expression in reverse Polish order."""
    out, ops = [], []
    for t in tokens:
        if t == "(":
            ops.append(t)
        elif t == ")":
            while ops[-1] != "(":
                out.append(ops.pop())
            ops.pop()
        elif t in _BINDS:
            while ops and ops[-1] != "(" and _BINDS[ops[-1]] >= _BINDS[t]:
                out.append(ops.pop())
            ops.append(t)
        else:
            out.append(t)
    return out + ops[::-1]


def evaluate(expression: str) -> tuple[set[str], float]:
    """Labels and openness of an expression, or of its longest well-formed start."""
    lower = expression.lower()
    return evaluate_at(lower, 0, len(lower))


def evaluate_at(text: str, start: int, stop: int) -> tuple[set[str], float]:
    """``evaluate`` for a part of a lower-cased text; what follows the first fault is not read."""
    stack: list[tuple[set[str], float]] = []
    for t in to_postfix(well_formed_start(m[0] for m in _TOKEN.finditer(text, start, stop))):
        if t not in _BINDS:
            label = identifier_label(t)
            stack.append(({label}, OPENNESS[label]))
            continue
        b, a = stack.pop(), stack.pop()
        if t == "with":
            stack.append(a)
        else:
            stack.append((a[0] | b[0], (max if t == "or" else min)(a[1], b[1])))
    return stack.pop() if stack else (set(), 1.0)


def scanner():
    """Function text -> (n_words, base starts, base labels, labels, score)."""
    phrases = automaton([f" {p} " for p in {**BASE_PHRASES, **NOTICE_PHRASES}])
    tags = automaton(TAGS)

    def scan(text: str | None):
        words = words_of(text)
        joined = f" {b' '.join(words).decode('latin-1')} "  # phrases are ASCII, so bytes may stand for characters
        places: dict[str, list[int]] = {}
        at = index = 0  # words before the last match, so that each blank is counted about once
        for end, p in phrases.iter(joined):
            begin = end + 1 - len(p)
            index += joined.count(" ", at, begin) if begin >= at else -joined.count(" ", begin, at)
            at = begin
            places.setdefault(p[1:-1], []).append(index)
        base = sorted(w for p, at in places.items() if p in BASE_PHRASES for w in at)
        base_labels = {BASE_PHRASES[p] for p in places if p in BASE_PHRASES}
        found = base_labels | {NOTICE_PHRASES[p] for p in places if p in NOTICE_PHRASES}
        score = min((OPENNESS[x] for x in found), default=1.0)
        if text and ":" in text:
            lower, stop = text.lower(), -1
            for end, _ in tags.iter(lower):
                if stop < end:  # the line's end is looked for once
                    stop = lower.find("\n", end)
                    stop = stop if stop >= 0 else len(lower)
                labels, open_ = evaluate_at(lower, end + 1, stop)
                found |= labels
                score = min(score, open_)
        return len(words), base, base_labels, found, score

    return scan


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Licence findings of every text: words, places of base phrases, labels, score."""
    def start():
        scan = scanner()

        def step(ids, texts):
            got = [scan(t) for t in texts]
            return [ids, [g[0] for g in got], [g[1] for g in got], [",".join(sorted(g[2])) for g in got],
                    [",".join(sorted(g[3])) for g in got], [g[4] for g in got]]

        return step

    return map_columns(docs, [id_col, text_col],
                       f"`{id_col}` long, n_words long, base_starts array<long>, base_labels string, labels string, "
                       "score double", start)
