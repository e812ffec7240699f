"""SimHash near-dedup with bit-sliced comparison.

A document's 64-bit fingerprint has a bit set where over half of its shingles' XXH64
hashes (seed 42, UTF-8) have it; shingles are runs of three words of the text with A-Z in
lower case, repeats included (fewer words: the whole sequence; none: fingerprint zero).
Fingerprints link at ``radius`` or fewer differing bits; a group is a connected component.

Equal fingerprints are one node, so copies cost nothing. Candidates: of four 16-bit
fields two agree in any pair at distance 2 or less, so each distinct fingerprint goes
to six field-pair buckets. Buckets with more than ``BUCKET_SPLIT`` fingerprints are dealt anew
by two of the four bytes of their other 32 bits; such a part has at most 2^16 members,
however many near copies there are, and no pair is lost. Inside a bucket, 64 fingerprints
are one block of vertical bit planes: each plane is compared with one query bit by a
single XOR, distances of all 64 grow in carry-save counters, and a block is abandoned
when all its members exceed the radius. A bucket emits a spanning forest, not its pairs.

Edge cases: null and empty texts have fingerprint zero and link like any others. The group id
is the smallest non-null id in the group (null if all are null). Rows with equal ids or
wholly equal rows are rows of the same group. An empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricestream.llm import words as W
from pricestream.llm.frames import carry, prepare, restore, schema_of
from pricestream.llm.graph import components
from pricestream.session import materialize
from pricestream.sources.tables import read_table

SHINGLE, RADIUS, SEED = 3, 2, 42
#: A bucket with more distinct fingerprints than this is dealt anew by further bits.
BUCKET_SPLIT = 4096
#: Rows a comparison task takes on average.
BUCKET_ROWS = 200_000
#: (query, block) pairs compared at once in a task.
SLAB = 1 << 18

_ONE = np.uint64(1)


def fingerprint(texts: pa.Array, shingle: int = SHINGLE) -> np.ndarray:
    """SimHash of every text of an Arrow array (unsigned 64 bit)."""
    w = W.split_words(pc.ascii_lower(texts))
    n_docs, n_words = len(texts), np.diff(w.offsets)
    out = np.zeros(n_docs, np.uint64)
    if not len(w.codes):
        return out
    joined = pc.binary_join(pa.LargeListArray.from_arrays(
        pa.array([0, len(w.codes)], pa.int64()), w.vocab.take(pa.array(w.codes))), pa.scalar(" ", pa.large_string()))
    data = joined[0].as_buffer().to_pybytes()
    size = np.asarray(pc.binary_length(w.vocab)).astype(np.int64)[w.codes]
    ends = np.cumsum(size + 1) - 1
    starts = ends - size
    first = np.flatnonzero(W.starts_in_one_text(w.offsets, shingle))
    doc = W.doc_of(w.offsets)
    few = np.flatnonzero((n_words > 0) & (n_words < shingle))
    begin = np.concatenate((starts[first], starts[w.offsets[few]]))
    end = np.concatenate((ends[first + shingle - 1], ends[w.offsets[few + 1] - 1]))
    owner = np.concatenate((doc[first], few))
    h = xxhash.xxh64_intdigest
    hashes = np.fromiter((h(data[a:b], SEED) for a, b in zip(begin.tolist(), end.tolist())), np.uint64, len(begin))
    order = np.argsort(owner, kind="stable")
    hashes, owner = hashes[order], owner[order]
    heads = np.flatnonzero(np.diff(owner, prepend=-1))
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = np.add.reduceat(bits, heads, axis=0, dtype=np.int64)
    count = np.diff(np.append(heads, len(owner)))
    major = (2 * ones > count[:, None]).astype(np.uint8)
    out[owner[heads]] = np.packbits(major, axis=1, bitorder="little").view("<u8")[:, 0]
    return out


def with_fingerprints(df: DataFrame, keep_text: bool = True) -> DataFrame:
    """Adds ``fp`` (the fingerprint's bits as a long) to a frame with a ``text`` column."""
    prepare(df.sparkSession)
    names = [c for c in df.columns if keep_text or c != "text"]

    def add(batches):
        for batch in batches:
            for part in W.slices(batch, "text", 2 << 20):
                fp = fingerprint(W.as_texts(part.column("text"))).view(np.int64)
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in names], pa.array(fp)], [*names, "fp"])

    return df.mapInArrow(add, schema_of(df, *names, fp="long"))


def near_pairs(key: np.ndarray, fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of different fingerprints with an equal key and at most ``radius`` differing
    bits, as two arrays of places; ``fp`` unsigned, (key, fp) sorted and distinct."""
    n = len(fp)
    seg_first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if n else np.zeros(0, np.int64)
    seg_size = np.diff(np.append(seg_first, n))
    seg = np.repeat(np.arange(len(seg_first)), seg_size)
    place = np.arange(n) - seg_first[seg]
    blocks_of = -(-seg_size // 64)
    block_base = np.cumsum(blocks_of) - blocks_of
    block, lane = block_base[seg] + place // 64, (place % 64).astype(np.uint64)
    block_first = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1]))) if n else seg_first
    planes = np.stack([np.bitwise_or.reduceat(((fp >> np.uint64(b)) & _ONE) << lane, block_first)
                       for b in range(64)]) if n else np.zeros((64, 0), np.uint64)
    member = np.bitwise_or.reduceat(_ONE << lane, block_first) if n else np.zeros(0, np.uint64)
    todo = np.where(seg_size[seg] > 1, blocks_of[seg] - place // 64, 0)
    total, left, right, at = np.cumsum(todo), [], [], 0
    while at < n:
        base = total[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(total, base + SLAB, "right")))
        count = todo[at:end]
        row = np.repeat(np.arange(at, end), count)
        step = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        blk = block[row] + step
        # members of the query's own block up to itself are not candidates
        out = ~member[blk] | np.where(step == 0, (((_ONE << lane[row]) - _ONE) << _ONE) | _ONE, np.uint64(0))
        row, blk, out = _within(row, blk, out, fp, planes, radius)
        if len(row):
            bits = np.unpackbits((~out).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            a, lanes = np.nonzero(bits)
            left.append(row[a])
            right.append(block_first[blk[a]] + lanes)
        at = end
    none = np.zeros(0, np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def _within(row, blk, out, fp, planes, radius):
    """Carry-save counting over the planes; ``out`` marks lanes that are no candidates or beyond."""
    width = max(1, radius.bit_length())
    digits = [np.zeros(len(row), np.uint64) for _ in range(width)]
    for b in range(64):
        carry = planes[b][blk] ^ (np.uint64(0) - ((fp[row] >> np.uint64(b)) & _ONE))
        for i, digit in enumerate(digits):
            digits[i], carry = digit ^ carry, digit & carry
        out = out | carry
        if b % 8 == 7:
            # lanes whose count exceeds the radius, by comparing the digits from the top
            over, equal = np.zeros_like(out), ~np.zeros_like(out)
            for i in range(width - 1, -1, -1):
                if radius >> i & 1:
                    equal = equal & digits[i]
                else:
                    over, equal = over | (equal & digits[i]), equal & ~digits[i]
            out = out | over
            alive = out != ~np.uint64(0)
            if not alive.all():
                row, blk, out = row[alive], blk[alive], out[alive]
                digits = [d[alive] for d in digits]
    return row, blk, out


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest reachable place for each of ``n`` places under the pairs (a, b)."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        label = label[label]
        if (label == before).all():
            break
    return label


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b): links between distinct fingerprints that connect all within the radius.
    ``prints`` has distinct longs in ``fp``."""
    if radius > 2:
        raise ValueError("two of four equal fields are certain up to two differing bits")
    spark = prints.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(parts, -(-6 * prints.count() // BUCKET_ROWS))
    field = [f"(shiftrightunsigned(fp, {16 * i}) & 65535)" for i in range(4)]
    byte = [f"(shiftrightunsigned(fp, {8 * i}) & 255)" for i in range(8)]
    pairs = list(combinations(range(4), 2))
    keys = [f"named_struct('t', {t}, 'key', shiftleft(cast({t} as bigint), 32) | shiftleft({field[i]}, 16) | {field[j]})"
            for t, (i, j) in enumerate(pairs)]
    cand = prints.select("fp", F.expr(f"inline(array({', '.join(keys)}))"))
    hot = cand.groupBy("key").count().filter(F.col("count") > BUCKET_SPLIT).select("key")
    cold = cand.join(hot, "key", "left_anti").select("key", "fp")
    more = []
    for t, pair in enumerate(pairs):
        rest = [b for f in range(4) if f not in pair for b in (2 * f, 2 * f + 1)]
        more.append("array(" + ", ".join(f"xxhash64(key, {s}, {byte[x]}, {byte[y]})"
                                         for s, (x, y) in enumerate(combinations(rest, 2))) + ")")
    deeper = (cand.join(hot, "key", "left_semi")
              .select("fp", F.explode(F.expr("element_at(array(" + ", ".join(more) + "), t + 1)")).alias("key"))
              .select("key", "fp"))

    def compare(tab: pa.Table) -> pa.Table:
        key = tab.column("key").combine_chunks().to_numpy()
        fp = tab.column("fp").combine_chunks().to_numpy().view(np.uint64)
        order = np.lexsort((fp, key))
        key, fp = key[order], fp[order]
        fresh = np.ones(len(fp), bool)
        fresh[1:] = (key[1:] != key[:-1]) | (fp[1:] != fp[:-1])
        key, fp = key[fresh], fp[fresh]
        root = _forest(len(fp), *near_pairs(key, fp, radius))
        child = np.flatnonzero(root != np.arange(len(fp)))
        return pa.table({"a": fp[child].view(np.int64), "b": fp[root[child]].view(np.int64)})

    rows = cold.union(deeper).withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))
    return rows.groupBy("bucket").applyInArrow(compare, "a long, b long")


def groups(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, root) for the distinct fingerprints ``prints`` that have a link."""
    return components(links(prints, radius)).select(F.col("node").alias("fp"), F.col("component").alias("root"))


def _grouped(marked: DataFrame) -> DataFrame:
    """``marked`` (with fp) and the group's ``root`` fingerprint."""
    prints = materialize(marked.select("fp").distinct(), "fingerprints")
    return marked.join(groups(prints), "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def simhash_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` without its text, and the columns fingerprint (16 hex digits) and component_id."""
    columns = [c for c in df.columns if c != text_col]
    marked = materialize(with_fingerprints(carry(df, doc_id=id_col, text=text_col), keep_text=False), "simhash")
    # group ids per distinct fingerprint first: a fingerprint that a third of the rows
    # share is one row of the aggregate
    prints = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("low")), "fingerprints")
    rooted = prints.join(groups(prints.select("fp")), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    rooted = materialize(rooted, "rooted")
    least = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    of = rooted.join(least, "root").select("fp", "component_id")
    done = marked.join(of, "fp").withColumn("fingerprint", F.lower(F.lpad(F.hex("fp"), 16, "0")))
    return restore(done, columns, ["fingerprint", "component_id"], doc_id=id_col)


def keep_one_per_group(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that stay: of each group the one with the smallest id (nulls last)."""
    marked = carry(df, doc_id=id_col, text=text_col).withColumn("row", F.monotonically_increasing_id())
    # stored with its row numbers, so that these hold whatever is computed again later
    marked = materialize(with_fingerprints(marked), "simhash-rows")
    small = _grouped(marked.select("fp", "doc_id", "row"))
    stay = small.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("m"))
    done = marked.join(stay.select(F.col("m.row").alias("row")), "row", "left_semi")
    return restore(done, df.columns, [], doc_id=id_col, text=text_col)


def op8_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: doc_id, fingerprint, component_id."""
    return simhash_groups(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
