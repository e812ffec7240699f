"""Shards as runs of a Hilbert curve over several metadata dimensions.

Every dimension is quantised to ``2 ** bits`` levels that hold about equally many rows (bounds from one
mergeable percentile sketch over all rows; texts by their first bytes, which keep the order). A row's
levels name a cell of the grid, and the cells lie on a Hilbert curve, so neighbours on the curve are
neighbours in every dimension. Rows sorted by the curve are cut into runs: a run covers a small range
of each dimension, and a reader that filters on any of them skips most files by their
minimum and maximum.

The number of cells is bounded (``dims * bits <= MOST_BITS``), so what depends on the order of the cells is
a small table: cell, place on the curve, rows and bytes before it. A row's place is its cell's start
and its running number inside the cell, an ordered scan (``operators.scan``) that cuts cells with many rows. Texts are
shuffled only where they are written.

Laws: ``rows``: counts of the shards differ by at most one; ``bytes``: cuts at equal shares of the bytes, so a shard
misses the share by less than its two border rows. Size is the text's bytes in UTF-8 (null: none) plus 1.

Edge cases: a null dimension is on the lowest level. Rows of one cell are ordered by text hash, id (null first) and a
hash of all columns; so equal texts of equal metadata lie together, and wholly equal rows are interchangeable.
An empty table gives an empty result; with fewer rows than shards some shards are empty. Further columns come
through; one of an added column's name is replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricestream.llm.frames import carry, prepare, restore
from pricestream.operators.scan import Running, deal, scan
from pricestream.session import materialize
from pricestream.sources.tables import read_table

DIMENSIONS = ("lang", "source", "n_chars")
SHARDS, BITS = 16, 5
#: Bits of a cell number: at most 2 ** MOST_BITS cells.
MOST_BITS = 20
#: Bytes of a text that order it among others; accuracy of the percentile sketch.
PREFIX, ACCURACY = 7, 10_000
ROWS_PER_CELL = 500_000


def hilbert_index(levels: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of points given as rows of levels (0 .. 2 ** bits - 1).

    From the highest bit down, each dimension's bit says whether the lower bits of the first
    dimension are flipped or swapped with its own; the Gray code of what is left, read bit by bit over
    the dimensions, is the place."""
    x = levels.astype(np.int64).T.copy()
    for k in range(bits - 1, 0, -1):
        low = (1 << k) - 1
        for d in range(len(x)):
            high = (x[d] >> k) & 1 == 1
            swap = np.where(high, 0, (x[0] ^ x[d]) & low)
            x[0] ^= np.where(high, low, swap)
            x[d] ^= swap
    for d in range(1, len(x)):
        x[d] ^= x[d - 1]
    flip = np.zeros_like(x[0])
    for k in range(bits - 1, 0, -1):
        flip ^= np.where((x[-1] >> k) & 1 == 1, (1 << k) - 1, 0)
    x ^= flip
    out = np.zeros_like(x[0])
    for k in range(bits - 1, -1, -1):
        for d in range(len(x)):
            out = out << 1 | (x[d] >> k) & 1
    return out


def _number(df: DataFrame, col: str, skip: int) -> Column:
    """A dimension as a number that keeps its order: numbers and times as they are, texts by ``PREFIX`` bytes
    after the ``skip`` that all have in common."""
    kind, c = df.schema[col].dataType, F.col(f"`{col}`")
    if isinstance(kind, T.StringType):
        part = F.substring(c.cast("binary"), skip + 1, PREFIX)
        return F.conv(F.rpad(F.hex(part), 2 * PREFIX, "0"), 16, 10).cast("bigint")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp"))
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("bigint")
    return c.cast("double" if isinstance(kind, (T.FractionalType, T.DecimalType)) else "bigint")


def _common_prefix(df: DataFrame, texts: Sequence[str]) -> dict[str, int]:
    """Bytes that all values of each text column begin with."""
    ends = [f(F.col(f"`{c}`").cast("binary")) for c in texts for f in (F.min, F.max)]
    if not ends:
        return {}
    row = df.agg(*ends).first()
    out = {}
    for i, c in enumerate(texts):
        low, high = bytes(row[2 * i] or b""), bytes(row[2 * i + 1] or b"")
        out[c] = next((k for k, (a, b) in enumerate(zip(low, high)) if a != b), min(len(low), len(high)))
    return out


def quantised(df: DataFrame, dims: Sequence[str], bits: int) -> Column:
    """The grid cell of every row, as a column over ``df``: the levels of the dimensions, ``bits`` bits each."""
    skip = _common_prefix(df, [c for c in dims if isinstance(df.schema[c].dataType, T.StringType)])
    numbers = [_number(df, c, skip.get(c, 0)) for c in dims]
    shares = [k / (1 << bits) for k in range(1, 1 << bits)]
    row = df.agg(*[F.percentile_approx(n, shares, ACCURACY) for n in numbers]).first()
    bounds = [np.array(sorted(b or [])) for b in row]  # at most 2 ** bits a dimension

    def cell(*values: pa.Array) -> pa.Array:
        out = np.zeros(len(values[0]), np.int32)
        for i, (v, b) in enumerate(zip(values, bounds)):
            if len(b):
                # the number of bounds below the value: few values are spread over all levels too
                level = np.searchsorted(b, v.fill_null(b[0].item()).to_numpy(zero_copy_only=False))
                out += (level << bits * i).astype(np.int32)
        return pa.array(out)
    return F.arrow_udf(cell, "int")(*numbers)


def hilbert_shards(df: DataFrame, dims: Sequence[str] = DIMENSIONS, shards: int = SHARDS, law: str = "rows",
                   bits: int = BITS, id_col: str = "doc_id", text_col: str = "text",
                   rows_per_cell: int = ROWS_PER_CELL, keep_text: bool = True) -> DataFrame:
    """``df`` with size, text_crc32, curve (place on the curve), shard and slot (0.. in the shard), all long but
    shard (int). Without ``keep_text`` the text is not carried along."""
    if law not in ("rows", "bytes"):
        raise ValueError("law must be 'rows' or 'bytes'")
    if not 0 < len(dims) * bits <= MOST_BITS:
        raise ValueError(f"dimensions times bits must be 1 to {MOST_BITS}")
    prepare(df.sparkSession)
    columns = [c for c in df.columns if keep_text or c != text_col]
    cell = quantised(df, dims, bits)
    everything = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    rows = carry(df.select("*", cell.alias("__cell_no"), everything.alias("__row")), doc_id=id_col, text=text_col,
                 cell="__cell_no", row="__row")
    text = F.coalesce("text", F.lit(""))
    rows = (rows.withColumn("size", (F.octet_length(text) + 1).cast("long")).withColumn("text_crc32", F.crc32(text))
            .withColumn("key", F.xxhash64(text)))
    if not keep_text:
        rows = rows.drop("text")

    n_dims = len(dims)

    def place(batches):
        for batch in batches:
            c = batch.column("cell").to_numpy()
            points = np.stack([c >> bits * i & (1 << bits) - 1 for i in range(n_dims)], axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hilbert_index(points, bits))],
                                             [*batch.schema.names, "curve"])

    cells = rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("b"))
    cells = cells.mapInArrow(place, "cell int, n long, b long, curve long")
    w = Window.orderBy("curve").rowsBetween(Window.unboundedPreceding, -1)  # at most 2 ** MOST_BITS rows
    cells = materialize(cells.select("cell", "curve", "n", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("rows_before"),
                                     F.coalesce(F.sum("b").over(w), F.lit(0)).alias("bytes_before"), "b"), "curve-cells")
    total = cells.agg(F.sum("n"), F.sum("b")).first()

    order = ["key", "doc_id", "row"]
    dealt = deal(rows.withColumn("one", F.lit(1).cast("long")), "cell", order, rows_per_cell,
                 cells.select("cell", F.col("n").alias("__n")))
    rows = scan(dealt, in_cell=Running("sum", "one"), size_in_cell=Running("sum", "size"))
    rows = rows.join(cells.select("cell", "curve", "rows_before", "bytes_before"), "cell")
    at = F.col("rows_before") + F.col("in_cell") - 1
    # twice the bytes up to the middle of the row: whole numbers
    middle = 2 * (F.col("bytes_before") + F.col("size_in_cell")) - F.col("size")
    whole = total[0] if law == "rows" else 2 * (total[1] or 0)
    share = (at if law == "rows" else middle).cast("decimal(38,0)") * shards / F.lit(whole or 1).cast("decimal(38,0)")
    rows = rows.withColumn("at", at).withColumn("shard", F.floor(share).cast("int"))
    if law == "rows":  # the first row of shard s is the ceiling of s * rows / shards
        first = F.ceil(F.col("shard").cast("decimal(38,0)") * (total[0] or 0) / shards).cast("long")
        rows = rows.withColumn("slot", F.col("at") - first)
    else:
        rows = materialize(rows, "placed")
        firsts = rows.groupBy("shard").agg(F.min("at").alias("first"))  # one row a shard
        rows = rows.join(firsts, "shard").withColumn("slot", F.col("at") - F.col("first"))
    added = ["size", "text_crc32", "curve", "shard", "slot"]
    return restore(rows, columns, added, doc_id=id_col, **({"text": text_col} if keep_text else {}))


def write_shards(sharded: DataFrame, path: str, shards: int = SHARDS, rows_per_group: int = 10_000) -> None:
    """Writes ``hilbert_shards`` rows as Parquet, one file a shard, in order of the slots. Row groups are small, so
    their minima and maxima prune too."""
    (sharded.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "slot")
     .write.mode("overwrite").option("parquet.block.row.count.limit", rows_per_group).parquet(path))


def op11_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard (null) and curve."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", *DIMENSIONS)
    done = hilbert_shards(docs, keep_text=False)
    return done.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"), "curve")
