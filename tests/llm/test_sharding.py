"""Hilbert shards against brute force: the curve, the laws, the order and what a reader skips."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricestream.llm import op11_hilbert_sharding as op
from conftest import SF001
from llm.conftest import CLASHES

DIMS = ("lang", "source", "n_chars")


@pytest.mark.parametrize("dims, bits", [(1, 4), (2, 1), (2, 4), (3, 3), (4, 2)])
def test_curve_visits_every_point_by_single_steps(dims, bits):
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), axis=-1).reshape(-1, dims)
    place = op.hilbert_index(grid, bits)
    assert sorted(place.tolist()) == list(range(len(grid)))
    walk = grid[np.argsort(place)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def levels(values, bits):
    """Number of percentiles below each value; a percentile is the least value with its share at or below."""
    known = sorted(v for v in values if v is not None)
    bounds = [known[max(0, -(-k * len(known) >> bits) - 1)] for k in range(1, 1 << bits)] if known else []
    return [0 if v is None else sum(v > b for b in bounds) for v in values]


def check(rows, shards, law="rows"):
    """Sizes, checksums and the law of the shards."""
    for r in rows:
        data = (r.text or "").encode()
        assert (r.size, r.text_crc32) == (len(data) + 1, zlib.crc32(data))
    rows = sorted(rows, key=lambda r: (r.shard, r.slot))
    per = [[r for r in rows if r.shard == s] for s in range(shards)]
    assert sum(map(len, per)) == len(rows)
    for p in per:
        assert [r.slot for r in p] == list(range(len(p)))
    assert [r.curve for r in rows] == sorted(r.curve for r in rows)
    if law == "rows":
        assert max(map(len, per)) - min(map(len, per)) <= 1
    else:
        share = sum(r.size for r in rows) / shards
        worst = max(r.size for r in rows)
        assert all(abs(sum(r.size for r in p) - share) <= worst for p in per)
    return rows


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").collect()
    got = {r.doc_id: r for r in op.op11_hilbert_sharding(spark, SF001).collect()}
    text = [[r.lang for r in docs], [r.source for r in docs]]
    points = np.stack([*(levels([None if v is None else v.encode() for v in t], 5) for t in text),
                       levels([r.n_chars for r in docs], 5)], axis=1)
    place = op.hilbert_index(points, 5)
    assert [got[r.doc_id].curve for r in docs] == place.tolist()
    by_curve = sorted(got.values(), key=lambda r: (r.shard, r.slot))
    n = len(docs)
    assert [r.shard for r in by_curve] == [k * 16 // n for k in range(n)]
    assert [r.curve for r in by_curve] == sorted(place.tolist())
    assert {(r.law, r.grown_shard) for r in by_curve} == {("rows", None)}
    for r in docs:
        data = (r.text or "").encode()
        assert (got[r.doc_id].size, got[r.doc_id].text_crc32) == (len(data) + 1, zlib.crc32(data))


@pytest.mark.parametrize("law", ["rows", "bytes"])
@pytest.mark.parametrize("cell", [500_000, 7])
def test_edge_cases(edge, empty, law, cell):
    done = op.hilbert_shards(edge, DIMS, 5, law, 3, rows_per_cell=cell)
    rows = check(done.collect(), 5, law)
    key = lambda r: tuple(str(r[c]) for c in edge.columns if c != "shard")
    assert sorted(map(key, rows)) == sorted(map(key, edge.collect()))           # all columns, clashing ones too
    assert [c for c in edge.columns if c != "shard"] == [c for c in done.columns if c in edge.columns and c != "shard"]
    assert set(CLASHES) - {"shard"} <= set(done.columns)
    assert op.hilbert_shards(empty, DIMS, 5, law, 3).count() == 0


def test_cut_cells_give_the_same_shards(edge):
    cols = ["doc_id", "size", "text_crc32", "curve", "shard", "slot"]
    a, b = (sorted(map(str, op.hilbert_shards(edge, DIMS, 4, "rows", 2, rows_per_cell=c).select(*cols).collect()))
            for c in (500_000, 5))
    assert a == b


def test_one_value_in_a_third_of_the_rows_and_fewer_rows_than_shards(spark):
    df = spark.range(300).select(F.col("id").alias("doc_id"), F.lit("same").alias("text"),
                                 F.when(F.col("id") < 200, "hot").otherwise(F.col("id").cast("string")).alias("source"))
    check(op.hilbert_shards(df, ("source",), 7, rows_per_cell=20).collect(), 7)
    few = op.hilbert_shards(df.limit(3), ("source",), 16).collect()
    assert sorted(r.shard for r in few) == [0, 5, 10] and {r.slot for r in few} == {0}


def test_files_are_pruned_on_every_dimension(spark, tmp_dir):
    rng = np.random.default_rng(1)
    data = [(i, "t", f"lang{a}", f"site-{b:03}", int(c)) for i, (a, b, c) in enumerate(
        zip(rng.integers(0, 4, 4000), rng.integers(0, 100, 4000), rng.integers(0, 10_000, 4000)))]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    op.write_shards(op.hilbert_shards(df, DIMS, 32), tmp_dir, 32)
    files = spark.read.parquet(tmp_dir).withColumn("f", F.input_file_name()).groupBy("f").agg(
        *[f(c).alias(f"{f.__name__}_{c}") for c in DIMS for f in (F.min, F.max)]).collect()
    assert len(files) == 32
    read = {c: np.mean([sum(r[f"min_{c}"] <= v <= r[f"max_{c}"] for r in files) for v in vs])
            for c, vs in (("lang", ["lang0", "lang3"]), ("source", ["site-010", "site-090"]), ("n_chars", [500, 9000]))}
    assert all(n <= 16 for n in read.values()), read      # by id, every file holds every value range
