"""Training-data pipeline over ``documents``.

Stages, in order: toxicity (what the classifier rejects goes), quality rules (what they reject
goes), SimHash near-dedup (one document of each group stays), substring dedup (repeated passages
go from the texts) and best-fit packing (rows of packed pieces). Each stage takes the whole result of
the one before it, written as Parquet to the shared checkpoint folder and read again; so a lost
executor costs its own tasks, not the stages before. All but the last return the columns of
``documents``. Null texts, empty tables and repeated rows are handled as each operator says.

A stage's result reads the intermediate tables that the stage wrote; once it is written itself,
these are spent, and the next stage's start deletes them.
"""

from __future__ import annotations

import functools
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricestream.llm.op3_toxicity import score_toxicity, train
from pricestream.llm.op4_best_fit_packing import pack_texts
from pricestream.llm.op5_substring_dedup import dedup_substrings
from pricestream.llm.op8_simhash_dedup import keep_one_per_group
from pricestream.llm.op9_quality_rules import quality_verdicts
from pricestream.session import collected_tables, delete_path, materialize
from pricestream.sources.tables import read_table


_SPENT = threading.local()


def _stage(number: int):
    """Marks a stage: its intermediate tables are deleted when the stage after it starts."""
    def wrap(f):
        @functools.wraps(f)
        def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
            spent = getattr(_SPENT, "tables", None) or {}
            for path in spent.pop(number - 1, []):
                delete_path(spark, path)
            with collected_tables() as written:
                result = f(spark, docs, sf_dir)
            spent[number] = written
            _SPENT.tables = spent
            return result
        return run_stage
    return wrap


#: Columns that the operators read; a table's others are set aside under names that no operator adds.
_READ = ("doc_id", "text", "lang", "source", "n_chars")


def _beside(docs: DataFrame, operate) -> DataFrame:
    """``operate`` on ``docs``, whose further columns come back with their own values, whatever their names."""
    own = {c: f"__own_{i}" for i, c in enumerate(docs.columns) if c not in _READ}
    done = operate(docs.select(*[F.col(f"`{c}`").alias(own.get(c, c)) for c in docs.columns]))
    return done.select(*[F.col(own.get(c, c)).alias(c) for c in docs.columns])


@_stage(1)
def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier (learned from the labelled ones among ``docs``) does not call toxic. A null text is scored
    as an empty one; repeated rows each get the verdict of their text; an empty table stays empty."""
    model = train(docs, read_table(spark, sf_dir, "labels"))
    return _beside(docs, lambda d: score_toxicity(d, model).filter("predicted = 0"))


@_stage(2)
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no outlier of their language and source (null is a value of either). Null and
    empty texts have too few words and go."""
    return _beside(docs, lambda d: quality_verdicts(d).filter("kept"))


@_stage(3)
def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one of the smallest id, one row of it where ids repeat. Null and
    empty texts have fingerprint zero and are a group."""
    return _beside(docs, keep_one_per_group)


@_stage(4)
def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the words of passages that stand earlier in the corpus. White space between the words that stay
    does not change, a document that loses nothing is byte for byte what it was, and ``n_chars`` counts the new text. A null text
    stays null; a document may end up with an empty text."""
    done = _beside(docs, dedup_substrings)
    return done.withColumn("n_chars", F.char_length("text").cast("long"))


@_stage(5)
def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of pieces of documents with their bins (see ``pack_texts``); documents without tokens have one empty piece."""
    return pack_texts(docs)


STAGES = [
    ("toxicity", toxicity),
    ("quality_rules", quality_rules),
    ("simhash_dedup", simhash_dedup),
    ("substring_dedup", substring_dedup),
    ("best_fit_packing", best_fit_packing),
]

#: Its rows need a trained classifier, robust estimates and the tokenizer's counts: not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of the documents that stay."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
