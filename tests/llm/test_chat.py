"""Chat formatting: round trips, event folding, digests against brute force."""

import hashlib

from hypothesis import given, settings, strategies as st

from optlake.llm import chat as C

TURNS = "conv_id long, turn long, role string, text string"
_TEXT = st.lists(st.sampled_from(list("ab\\\n<|>") + ["<|im_end|>", "<|im_start|>", "<\\|", "é", "\U0001f600"]), max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(_TEXT, _TEXT), max_size=4))
def test_round_trip(turns):
    pieces = [C.render(r, t) for r, t in turns]
    assert C.parse("".join(p for p, _, _ in pieces)) == turns
    for (p, a, b), (r, t) in zip(pieces, turns):
        assert C.unescape(p[a:b]) == (t if r == "assistant" else "")


def digest(rows):
    turns = [(r or "", t or "") for _, r, t in sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1] or "", x[2] or ""))]
    trained = "".join(t for r, t in turns if r == "assistant")
    return (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(trained),
            hashlib.sha256(trained.encode()).hexdigest(), sum(len(C.render(r, t)[0]) for r, t in turns))


def test_query_against_brute_force(llm):
    from optlake.llm.queries import CONTROL_TEXT, QUERIES

    rows = llm.read.parquet("/root/testdata/sf0.001/conversations.parquet").collect()
    want = {-1: digest([(0, "user", CONTROL_TEXT), (1, "assistant", CONTROL_TEXT)])}
    for c in {r.conv_id for r in rows}:
        want[c] = digest([(r.turn, r.role, r.text) for r in rows if r.conv_id == c])
    got = {r[0]: tuple(r)[1:] for r in QUERIES["op10_chat"](llm, "/root/testdata/sf0.001").collect()}
    assert got == want


def test_edges(llm):
    long = "x" * 300_000 + "<|im_end|>"
    rows = [(1, 0, "user", None), (1, 1, "assistant", ""), (1, 1, "assistant", ""), (1, None, "system", "s"), (2, 0, None, "t"),
            (None, 0, "assistant", long), (3, 0, "assistant", "odd"), (3, 1, "assistant", "é\U0001f600!")]
    df = llm.createDataFrame([(*r, 1, "p") for r in rows], TURNS + ", seq int, payload string")
    got = {r[0]: tuple(r)[1:] for r in C.read_back(C.format_conversations(C.events_of_turns(df))).collect()}
    assert got == {c: digest([r[1:] for r in rows if r[0] == c]) for c in {r[0] for r in rows}}
    assert C.read_back(C.format_conversations(C.events_of_turns(llm.createDataFrame([], TURNS)))).count() == 0


def test_fold(llm):
    log = [(0, "start", "user", ""), (2, "delta", None, "lo"), (1, "delta", None, "hel"), (3, "regenerate", None, None),
           (4, "delta", None, "new "), (5, "delta", None, "text"), (6, "edit", None, "edited"), (7, "delta", None, "!")]
    df = llm.createDataFrame([(9, 0, 1, s, op, role, p) for s, op, role, p in log] + [(9, 1, 1, 0, "delta", None, "x")],
                             "conv_id long, turn long, msg long, seq long, op string, role string, payload string")
    got = sorted(tuple(r) for r in C.fold_messages(df.repartition(3)).collect())
    assert got == [(9, 0, 1, "user", "edited!"), (9, 1, 1, "", "x")]
