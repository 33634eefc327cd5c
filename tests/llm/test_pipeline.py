"""The pipeline's stages on a small corpus against brute-force decisions, and the entry module."""

import hashlib

import corpus_pipeline as C
from optlake.llm import neardup, pii
from test_decontam import items_frame
from test_neardup import brute

SF = "/root/testdata/sf0.001"


def test_registered():
    import __spark_entry__ as E

    names = list(E.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))
    assert [n for n, _ in C.STAGES] == ["toxicity", "near_duplicates", "decontamination", "personal_data", "byte_bpe"]


def test_stages(llm):
    docs = llm.read.parquet(f"{SF}/documents.parquet")
    plain = {r.doc_id: r for r in docs.collect()}
    kept = C.drop_toxic(llm, docs, SF)
    assert kept.columns == C.COLUMNS
    labels = {r.doc_id: r.toxic for r in llm.read.parquet(f"{SF}/labels.parquet").collect()}
    ids = {r.doc_id for r in kept.collect()}
    clean = [i for i, t in labels.items() if t == 0 and i in plain]
    assert sum(i in ids for i in clean) >= 0.95 * len(clean)

    single = C.drop_near_copies(llm, docs, SF)
    want = brute([(i, r.text) for i, r in plain.items()], C.SHINGLE, C.SIMILAR)
    assert {r.doc_id: r for r in single.collect()} == {i: plain[i] for i, (c) in want.items() if c == i}

    free = {r.doc_id for r in C.drop_leaks(llm, docs, SF).collect()}
    bench = [r.text for r in llm.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaked = {i for i, r in plain.items() if any(b in (r.text or "") for b in bench)}
    assert leaked and not leaked & free and len(free) >= len(plain) - 2 * len(leaked)

    hidden = {r.doc_id: r for r in C.hide_personal_data(llm, docs, SF).collect()}
    assert set(hidden) == set(plain)
    for i, r in hidden.items():
        assert r.n_chars == len(r.text) and (pii.base_spans(plain[i].text) or r.text == plain[i].text)
        assert not pii.base_spans(r.text)


def test_run(llm):
    rows = C.run(llm, SF).collect()
    assert rows and len({r.doc_id for r in rows}) == len(rows)
    assert all(r.n_tokens == len(r.ids) for r in rows)
    assert all(r.ids_sha256 == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in r.ids)).hexdigest() for r in rows)


def test_nulls_and_repeats(docs, llm, tmp_path):
    """Null ids, null and empty texts, repeated rows and clashing columns pass every stage."""
    rows = [(None, "text without id"), (1, None), (2, ""), (3, "a few words of plain text here"), (3, "a few words of plain text here"), (4, "x@y.org")]
    df = docs(rows)
    items_frame(llm, []).write.parquet(str(tmp_path / "benchmark.parquet"))
    llm.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for name, stage in C.STAGES:
        out = stage(llm, df, str(tmp_path))
        out.write.parquet(str(tmp_path / name))
        df = llm.read.parquet(str(tmp_path / name))
        assert df.count() == len(rows), name
    assert neardup.near_duplicates(docs(rows), C.Scratch(llm)).count() == len(rows)


def test_empty_documents(docs, llm, tmp_path):
    """An empty table, with columns whose names clash with the operators' own, passes every stage."""
    items_frame(llm, [(1, "one two three four five six seven eight nine ten")]).write.parquet(str(tmp_path / "benchmark.parquet"))
    llm.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    df = docs([])
    for name, stage in C.STAGES:
        out = stage(llm, df, str(tmp_path))
        assert name == C.STAGES[-1][0] or out.columns == C.COLUMNS
        out.write.parquet(str(tmp_path / name))
        df = llm.read.schema(out.schema).parquet(str(tmp_path / name))
        assert df.count() == 0, name
