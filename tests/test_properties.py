"""Properties of the folds: idempotent, partitioning-independent, batch
splits equal one batch; keep-last equals a row_number reference."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st

from optlake.operators.merge import keep_last, upsert_eod
from support import rows

SCHEMA = ("contract string, tradetime int, underlying_symbol string, strike double, "
          "bid double, ask double, raw_json string, seq int")


def _rand_rows(n, seed, start_seq=0):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        out.append((f"C{rnd.randint(0, 4)}", rnd.randint(0, 2), rnd.choice(["A", "B"]), float(rnd.randint(1, 9)),
                    rnd.choice([None, float(rnd.randint(1, 99))]), float(rnd.randint(1, 99)),
                    rnd.choice([None, f"r{i}"]), start_seq + i))
    return out


def _fold(spark, held, staged):
    h = spark.createDataFrame(held, SCHEMA) if held is not None else None
    return upsert_eod(h, spark.createDataFrame(staged, SCHEMA), stamp=None)


def test_fold_is_idempotent(spark):
    held_rows = _rand_rows(30, 1)
    staged_rows = _rand_rows(40, 2, start_seq=100)
    once = _fold(spark, held_rows, staged_rows)
    once_rows = [tuple(r) for r in once.select("contract", "tradetime", "underlying_symbol", "strike", "bid", "ask",
                                               "raw_json").collect()]
    held2 = [r + (0,) for r in once_rows]
    twice = _fold(spark, held2, staged_rows)
    assert rows(once) == rows(twice)


def test_fold_independent_of_partitioning(spark):
    staged = spark.createDataFrame(_rand_rows(200, 3), SCHEMA)
    a = upsert_eod(None, staged, stamp=None)
    b = upsert_eod(None, staged.repartition(7), stamp=None)
    c = upsert_eod(None, staged.coalesce(1), stamp=None)
    assert rows(a) == rows(b) == rows(c)


def test_batches_equal_one_batch(spark):
    b1 = _rand_rows(50, 4, start_seq=0)
    b2 = _rand_rows(50, 5, start_seq=1000)
    step = _fold(spark, None, b1)
    step_rows = [tuple(r) + (0,) for r in step.select("contract", "tradetime", "underlying_symbol", "strike", "bid",
                                                      "ask", "raw_json").collect()]
    two_steps = _fold(spark, step_rows, b2)
    one_step = _fold(spark, None, b1 + b2)
    assert rows(two_steps) == rows(one_step)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 2), st.integers(-5, 5)), min_size=1, max_size=40))
def test_keep_last_matches_reference(spark, data):
    recs = [(k, t, v, i) for i, (k, t, v) in enumerate(data)]
    df = spark.createDataFrame(recs, "k int, t int, v int, seq int")
    got = rows(keep_last(df, ["k", "t"]), "k", "t", "v")
    best = {}
    for k, t, v, i in recs:
        if (k, t) not in best or i > best[(k, t)][1]:
            best[(k, t)] = (v, i)
    assert got == sorted((k, t, v) for (k, t), (v, _) in best.items())


def test_change_counts(spark):
    from optlake.operators.merge import change_counts, change_labels

    held = spark.createDataFrame([("A", 1, 1.0, "x"), ("B", 1, 2.0, "y")], "contract string, tradetime int, bid double, raw_json string")
    staged = spark.createDataFrame([("A", 1, 1.0, None, 1), ("B", 1, 3.0, None, 1), ("C", 1, 4.0, None, 1)],
                                   "contract string, tradetime int, bid double, raw_json string, seq int")
    labels = {r.contract: r.change for r in change_labels(held, staged).collect()}
    assert labels == {"A": "unchanged", "B": "updated", "C": "inserted"}
    c = change_counts(change_labels(held, staged)).collect()[0]
    assert (c.inserted_rows, c.updated_rows, c.skipped_existing_rows) == (1, 1, 1)
