import importlib

import corpus_pipeline
from pricestream.llm import op4_best_fit_packing as packing
SF001 = "/root/testdata/sf0.001"


def test_stages_chain_and_end_in_bins(spark):
    docs = corpus_pipeline.read_table(spark, SF001, "documents")
    n, columns = docs.count(), docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialize(stage(spark, docs, SF001), name)
        assert docs.columns == columns and 0 < docs.count() <= n
        n = docs.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF001).toPandas()
    assert packed.doc_id.nunique() == n
    assert packed.groupby("bin_id").piece_tokens.sum().max() <= packing.CAPACITY


def test_registered():
    entry = importlib.import_module("__spark_entry__")
    names = entry.queries()
    assert "pipeline" in names
    for n in range(1, 14):
        assert sum(k.startswith(f"op{n}_") for k in names) == 1


def test_substring_stage_changes_only_what_it_removes(spark):
    docs = corpus_pipeline.read_table(spark, SF001, "documents")
    before = {r.doc_id: r.text for r in docs.collect()}
    after = {r.doc_id: r for r in corpus_pipeline.substring_dedup(spark, docs, SF001).collect()}
    assert set(after) == set(before)
    same = [i for i, r in after.items() if (r.text or "").split() == (before[i] or "").split()]
    assert 0 < len(same) < len(after)
    assert all(after[i].text == before[i] for i in same)
    assert all(r.n_chars == len(r.text) for r in after.values() if r.text is not None)
