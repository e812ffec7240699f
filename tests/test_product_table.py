"""Per-product tables: what a version writes and reads, merging, deletions, lookups."""

import os

import pytest
from pyspark.sql import functions as F

from pricestream.streaming.product_table import ProductTable

SCHEMA = "product_id string, demand long, price double"


def rows(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def as_dict(df):
    return {r.product_id: (r.demand, r.price) for r in df.collect()}


def sizes(root):
    """Bytes of the data files below a folder, by path."""
    return {os.path.join(d, f): os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(root) for f in names
            if f.endswith(".parquet") and "/manifest/" not in d}


def test_versions_write_their_changes_and_leave_other_buckets(spark, tmp_dir):
    t = ProductTable(spark, tmp_dir, SCHEMA, buckets=16, fan=3)
    state = {f"P{i}": (i, float(i)) for i in range(4000)}
    t.create(rows(spark, [(k, *v) for k, v in state.items()]))
    base = sizes(tmp_dir)
    for version in range(6):
        change = {f"P{i}": (i + version, 1.0) for i in (7, 8, 9)} | {f"N{version}": (version, 0.5)}
        before = sizes(tmp_dir)
        t.commit(version, rows(spark, [(k, *v) for k, v in change.items()]))
        state |= change
        assert as_dict(t.read()) == state
        written = {p: s for p, s in sizes(tmp_dir).items() if p not in before}
        merged = sum("/base/" in p for p in written)
        assert sum(s for p, s in written.items() if "/changes/" in p) < 0.2 * sum(base.values())
        assert merged <= 4                                     # only full buckets are merged
    kept = [p for p in base if os.path.exists(p)]
    assert len(kept) >= 16 - 3 - 6                             # buckets without changes keep their first files
    assert t.versions() == [4, 5]
    ids = rows(spark, [("P7", 0, 0.0), (" P8\t", 0, 0.0)]).select("product_id")
    got = t.of(ids)
    assert as_dict(got) == {k: state[k] for k in ("P7", "P8")}
    opened = {os.path.dirname(f) for f in got.inputFiles()}
    assert len({os.path.basename(d) for d in opened}) <= 2     # two buckets at most
    one = t.lookup("P9")
    assert as_dict(one) == {"P9": state["P9"]} and len({os.path.dirname(f) for f in one.inputFiles()}) <= 1 + t.fan
    assert "EqualTo(product_id,P9)" in one._jdf.queryExecution().executedPlan().toString()


def test_replayed_version_and_fail_closed(spark, tmp_dir):
    t = ProductTable(spark, tmp_dir, SCHEMA, buckets=4, fan=1)
    t.create(rows(spark, [("A", 1, 1.0)]))
    for v in range(3):
        for _ in range(2):                                     # each version twice, also with merging
            t.commit(v, rows(spark, [("A", v + 10, None), (f"B{v}", v, 2.0)]))
    assert as_dict(t.read()) == {"A": (12, None), "B0": (0, 2.0), "B1": (1, 2.0), "B2": (2, 2.0)}
    assert as_dict(t.read(1)) == {"A": (11, None), "B0": (0, 2.0), "B1": (1, 2.0)}
    with pytest.raises(RuntimeError):
        t.commit(7, rows(spark, []))
    with pytest.raises(RuntimeError):
        t.create(rows(spark, []))
    with pytest.raises(RuntimeError):
        ProductTable(spark, f"{tmp_dir}/none", SCHEMA).read()


def test_upsert_and_delete_over_versions(spark, tmp_dir):
    t = ProductTable(spark, tmp_dir, SCHEMA, buckets=8, fan=2)
    t.create(rows(spark, [(f"P{i}", i, 1.0) for i in range(100)]))
    gone = spark.createDataFrame([("P3",), ("P4",), ("absent",)], "product_id string")
    t.commit(0, rows(spark, [("P1", 50, 9.0)]), deleted=gone)
    assert t.read().count() == 98 and as_dict(t.lookup("P1")) == {"P1": (50, 9.0)} and t.lookup("P3").count() == 0
    t.commit(1, rows(spark, [("P3", 7, 7.0)]))                 # comes back
    everything = t.read().select("product_id")
    assert everything.count() == 99
    t.commit(2, rows(spark, []), deleted=t.read(1).select("product_id"))
    t.commit(3, rows(spark, []))
    assert t.read().count() == 0
    t.commit(4, rows(spark, [("Z", 1, 1.0)]))
    assert as_dict(t.read()) == {"Z": (1, 1.0)}


def test_lookup_reads_one_sorted_file(spark, tmp_dir):
    t = ProductTable(spark, tmp_dir, SCHEMA, buckets=1)
    t.create(spark.range(0, 20_000, 2).select(F.format_string("P%08d", "id").alias("product_id"), F.col("id").alias("demand"),
                                              F.lit(1.0).alias("price")))
    import pyarrow.parquet as pq
    (path,) = [p for p in sizes(tmp_dir)]
    column = pq.ParquetFile(path).metadata.row_group(0).column(0)
    assert column.path_in_schema == "product_id" and column.statistics.min == "P00000000"
    with open(path, "rb") as f:
        assert len(f.read()) > 10_000                          # ids, numbers and the filter
    assert as_dict(t.lookup("P00000004")) == {"P00000004": (4, 1.0)} and t.lookup("P00000005").count() == 0
