"""Toxicity: held-out accuracy, planted words, edges."""

from pyspark.sql import functions as F

from optlake.llm import toxicity as T


def test_held_out_accuracy(llm, scratch):
    sf = "/root/testdata/sf0.1"
    docs, labels = llm.read.parquet(f"{sf}/documents.parquet"), llm.read.parquet(f"{sf}/labels.parquet")
    model = T.fit(docs, labels.where(~T.held_out()), scratch)
    got = (T.score_toxicity(docs.join(labels, "doc_id").where(T.held_out()).select("doc_id", "text", "toxic"), model, keep=["doc_id", "toxic"])
           .select("toxic", (F.col("score") >= 0.5).cast("int").alias("p")).collect())
    right = [r.toxic == r.p for r in got]
    assert len(right) > 500 and sum(right) / len(right) >= 0.97
    assert sum(r.p for r in got if not r.toxic) <= 0.01 * len(got)  # clean documents stay


def test_query_shape(llm):
    from optlake.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    df = QUERIES["op4_toxicity"](llm, sf)
    assert df.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    rows = df.collect()
    assert len(rows) == llm.read.parquet(f"{sf}/documents.parquet").count()
    import zlib
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def make(docs, llm):
    mild = [f"the quiet {w} of a {w}ing house" for w in ("stone", "river", "green", "wooden")]
    rows = [(i, " ".join(mild[(i + j) % 4] for j in range(8)) + (" you vilest vile scoundrel" if i % 2 else "")) for i in range(120)]
    rows += [(1000, None), (1001, ""), (1002, mild[0] * 20_000), (1003, "a vile scoundrel"), (1004, "a vileness"), (1003, "a vile scoundrel")]
    labels = llm.createDataFrame([(i, i % 2, 1) for i in range(120)] + [(1, 1, 0), (None, 1, 0), (3, None, 0), (7777, 1, 0)],
                                 "doc_id long, toxic int, score int")
    return docs(rows), labels


def test_planted_and_edges(docs, llm, scratch):
    df, labels = make(docs, llm)
    model = T.fit(df, labels, scratch)
    got = [(r.doc_id, r.score) for r in T.score_toxicity(df, model).collect()]
    by = dict(got)
    assert all((by[i] >= 0.5) == (i % 2 == 1) for i in range(120))
    assert by[1000] == by[1001] < 0.5 and by[1002] < 0.5
    assert by[1003] >= 0.5 and len({s for i, s in got if i == 1003}) == 1
    assert T.score_toxicity(docs([]), model).count() == 0


def test_one_class_only(docs, llm, scratch):
    df, labels = make(docs, llm)
    for some in (labels.where("toxic = 0"), labels.limit(0)):
        model = T.fit(df, some, scratch)
        assert all(r.score < 1e-9 for r in T.score_toxicity(df, model).collect())
    assert T.fit(docs([]), labels, scratch).word.size == 2
