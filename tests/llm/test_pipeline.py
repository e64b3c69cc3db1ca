"""The stages against plain versions, each on its own input, and the whole on odd tables."""

import re

from frames import empty_documents, odd_documents
from test_queries import SF, base_spans, check_packing

import corpus_pipeline
from linewatch.llm import bagminhash, decontaminate, toxicity


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "secrets", "packing"]

    clean = stages["toxicity"](spark, docs, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet").where(~toxicity.held_out())
    grammar = toxicity.learn(docs.where(~toxicity.held_out()), labels)
    m = toxicity.matcher(grammar)
    rows = {r.doc_id: r for r in docs.collect()}
    assert clean.columns == columns
    assert sorted(r.doc_id for r in clean.collect()) == sorted(i for i, r in rows.items() if m.score(r.text or "") < 0.7)

    single = stages["near_duplicates"](spark, clean, SF)
    classes = bagminhash.near_duplicates(clean).collect()
    assert single.columns == columns
    assert sorted(r.doc_id for r in single.collect()) == sorted({r.class_id for r in classes})

    fresh = stages["decontamination"](spark, single, SF)
    bad = {r.doc_id for r in decontaminate.decontaminate(single, spark.read.parquet(f"{SF}/benchmark.parquet")).collect() if r.contaminated}
    assert fresh.columns == columns
    assert {r.doc_id for r in fresh.collect()} == {r.doc_id for r in single.collect()} - bad

    masked = stages["secrets"](spark, fresh, SF)
    assert masked.columns == columns and masked.schema == docs.schema
    for r in masked.collect():
        before = rows[r.doc_id].text
        if not base_spans(before or "") and "[SECRET]" not in (r.text or ""):
            assert r.text == before and r.n_chars == rows[r.doc_id].n_chars
        else:
            assert r.n_chars == len(r.text)
            # What lies between the masks is the text's own.
            assert re.fullmatch("(?s:.*)".join(map(re.escape, r.text.split("[SECRET]"))), before)

    pieces = stages["packing"](spark, masked, SF)
    check_packing(pieces.collect(), {r.doc_id: r.text for r in masked.collect()})


def ids_of(df):
    return [r.doc_id for r in df.collect()]


def test_odd_tables(spark):
    for docs in (odd_documents(spark), empty_documents(spark)):
        kept = docs
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, kept, SF)
            assert out.columns == docs.columns
            kept = spark.createDataFrame(out.collect(), docs.schema)
        pieces = corpus_pipeline.STAGES[-1][1](spark, kept, SF)
        assert {r.doc_id for r in pieces.collect()} == {r.doc_id for r in kept.collect()}
        # One row of each class; null and empty texts are classes of their own. A run of "a" is hexadecimal.
        found = sorted(str((r.doc_id, r.text)) for r in kept.collect() if r.text and len(r.text) < 1000)
        want = [(3, " "), (4, "!!! ???"), (10, "[SECRET]"), (6, "one"), (7, "one two three"), (7, "another text of the id"), (9, "äöü ßé ñ 漢字 😀"), (None, "no id here")]
        assert found == (sorted(map(str, want)) if ids_of(docs) else [])
        assert sum(not r.text for r in kept.collect()) == sum(not r.text for r in docs.collect())
