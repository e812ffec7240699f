"""Further columns with clashing names, and the pipeline's stages, on the table of edge cases."""

import collections

import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

import corpus_pipeline  # noqa: E402
from pricestream.llm import op10_bpe as bpe  # noqa: E402
from pricestream.llm import op2_lm_scoring as lm  # noqa: E402
from pricestream.llm import op5_substring_dedup as substring  # noqa: E402
from pricestream.llm import op7_fingerprints as lcp  # noqa: E402
from pricestream.llm import op8_simhash_dedup as simhash  # noqa: E402
from pricestream.llm import op9_quality_rules as quality  # noqa: E402
from conftest import SF001  # noqa: E402
from llm.conftest import CLASHES  # noqa: E402

OPERATORS = {
    "op2": lambda df: lm.lm_scores(df),
    "op5": lambda df: substring.dedup_substrings(df),
    "op7": lambda df: lcp.fingerprints(df),
    "op8": lambda df: simhash.simhash_groups(df),
    "op9": lambda df: quality.quality_verdicts(df),
    "op10": lambda df: bpe.bpe_encode(df, public_tokenizers.path("byte_bpe_50k.json")),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_values_of_clashing_columns_survive(edge, name):
    """Every row comes back with its own values; only columns that the operator adds itself are replaced."""
    before = edge.collect()
    done = OPERATORS[name](edge)
    kept = [c for c in CLASHES if c in done.columns and any(str(r[c]).startswith(f"{c}-") for r in done.select(c).limit(1).collect())]
    rows = done.collect()
    assert len(rows) == len(before)
    if not kept:        # an operator that returns its own columns only
        assert collections.Counter(r.doc_id for r in rows) == collections.Counter(r.doc_id for r in before)
        return
    assert len(kept) >= len(CLASHES) - 6
    key = lambda r: (str(r.doc_id), *(r[c] for c in kept))
    assert sorted(map(key, rows)) == sorted(map(key, before))


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES[1:4])
def test_stages_on_edge_cases(spark, edge, empty, name, stage):
    """Rows that stay are whole rows of the input (texts aside), and an empty table stays empty."""
    done = stage(spark, edge, SF001)
    assert done.columns == edge.columns
    others = [c for c in edge.columns if c not in ("text", "n_chars")]
    before = collections.Counter(tuple(str(r[c]) for c in others) for r in edge.collect())
    after = collections.Counter(tuple(str(r[c]) for c in others) for r in done.collect())
    assert not after - before and sum(after.values()) > 0
    if name == "substring_dedup":
        assert after == before
    assert stage(spark, empty, SF001).count() == 0


def test_packing_stage_on_edge_cases(spark, edge, empty):
    packed = corpus_pipeline.best_fit_packing(spark, edge, SF001).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in edge.collect()}
    assert corpus_pipeline.best_fit_packing(spark, empty, SF001).count() == 0
