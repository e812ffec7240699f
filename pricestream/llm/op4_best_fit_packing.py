"""Conflict-constrained best-fit packing.

Documents are packed into sequences (bins) of ``capacity`` tokens so that no bin holds two documents
of one source or of one duplicate cluster. A document longer than a bin is cut into full pieces
and a rest; full pieces are bins of their own. Pieces are placed longest first. A shard's open
bins stand in order of residual space and carry a bitmap of their sources and one of their
duplicate clusters; the search starts at the least residual that fits and goes on to
the successor until a bin's bitmaps have none of the piece's bits, so a piece gets the tightest
compatible bin, and a new bin only if there is none.

Documents are dealt into shards of about ``SHARD_DOCS`` (their number depends on the rows alone, not on the
session's settings) by a hash of id and text, which splits sources, copies and null ids alike; shards are packed side by side, so the loss to open bins at
their ends stays below a bin's worth for each source of a shard. Lengths are the tokens of the public
tokenizer (end token included); the duplicate cluster is a hash of the lower-cased words.

Edge cases: a null or empty text is its end token alone and is in the cluster of the empty text. All
null sources are one source. Repeated rows are packed as often as they occur, in different bins.
Equal lengths are placed in order of id, nulls first. An empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricestream.llm import words as W
from pricestream.llm.frames import carry, prepare, restore, schema_of
from pricestream.llm.op1_token_codes import encoder
from pricestream.session import materialize
from pricestream.sources.tables import read_table

CAPACITY = 2048
SHARD_DOCS = 4096
_PIECES = {"piece": "int", "piece_start": "long", "piece_tokens": "long", "bin_id": "long"}


def with_lengths(df: DataFrame, tokenizer: str) -> DataFrame:
    """A frame with a ``text`` column without it, and n_tokens (with the end token) and cluster."""
    with open(tokenizer, encoding="utf-8") as f:  # a vocabulary, so of bounded size
        data = df.sparkSession.sparkContext.broadcast(f.read())
    prepare(df.sparkSession)
    names = [c for c in df.columns if c != "text"]

    def measure(batches):
        count = encoder(data.value).lengths
        for batch in batches:
            for part in W.slices(batch, "text", 4 << 20):
                texts = W.as_texts(part.column("text"))
                n_tokens = count(texts) + 1
                cluster = [xxhash.xxh3_64_intdigest(" ".join(t.split())) for t in pc.utf8_lower(texts).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in names], pa.array(n_tokens),
                     pa.array(np.array(cluster, np.uint64).view(np.int64))], [*names, "n_tokens", "cluster"])

    return df.mapInArrow(measure, schema_of(df, *names, n_tokens="long", cluster="long"))


def pack(lengths: list[int], sources: list, clusters: list, capacity: int) -> list[int]:
    """Bin of every piece; ``lengths`` in descending order, each at most ``capacity``.
    A cluster of None conflicts with nothing."""
    source_bit = {s: 1 << i for i, s in enumerate(dict.fromkeys(sources))}
    count = Counter(clusters)
    cluster_bit = {c: 1 << i for i, c in enumerate(c for c in count if count[c] > 1 and c is not None)}
    held_sources, held_clusters, out = [], [], []
    open_: list[tuple[int, int]] = []  # (residual, bin) in order
    for length, source, cluster in zip(lengths, sources, clusters):
        s, c = source_bit[source], cluster_bit.get(cluster, 0)
        for at in range(bisect_left(open_, (length, -1)), len(open_)):
            residual, b = open_[at]
            if not held_sources[b] & s and not held_clusters[b] & c:
                del open_[at]
                break
        else:
            residual, b = capacity, len(held_sources)
            held_sources.append(0)
            held_clusters.append(0)
        held_sources[b] |= s
        held_clusters[b] |= c
        if residual > length:
            insort(open_, (residual - length, b))
        out.append(b)
    return out


def pack_documents(df: DataFrame, id_col: str = "doc_id", source_col: str = "source", length_col: str = "n_tokens",
                   cluster_col: str = "cluster", capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: ``df``'s columns and piece, piece_start, piece_tokens, bin_id."""
    spark = df.sparkSession
    prepare(spark)
    rows = materialize(carry(df, doc_id=id_col, source=source_col, length=length_col, cluster=cluster_col), "lengths")
    shards = max(1, -(-rows.count() // SHARD_DOCS))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", "cluster", "length"), F.lit(shards)).cast("int"))
    names = ["doc_id", "source", "length", "cluster", "rest"]

    def place(tab: pa.Table) -> pa.Table:
        shard = tab.column("shard")[0].as_py()
        ids = tab.column("doc_id").to_pylist()
        length = tab.column("length").combine_chunks().to_numpy()
        full, rest = length // capacity, length % capacity
        # one row for every full piece and for the rest
        pieces = full + (rest > 0)
        row = np.repeat(np.arange(len(ids)), pieces)
        piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        size = np.where(piece < full[row], capacity, rest[row])
        order = sorted(range(len(row)), key=lambda k: (-size[k], ids[row[k]] is not None, ids[row[k]] or 0, piece[k]))
        source, cluster = tab.column("source").to_pylist(), tab.column("cluster").to_pylist()
        bins = np.empty(len(row), np.int64)
        bins[order] = pack([int(size[k]) for k in order], [source[row[k]] for k in order],
                           [cluster[row[k]] for k in order], capacity)
        out = tab.select(names).take(pa.array(row))
        for name, column in (("piece", pa.array(piece.astype(np.int32))), ("piece_start", pa.array(piece * capacity)),
                             ("piece_tokens", pa.array(size)), ("bin_id", pa.array((shard << 32) + bins))):
            out = out.append_column(name, column)
        return out

    done = dealt.groupBy("shard").applyInArrow(place, schema_of(rows, *names, **_PIECES))
    return restore(done, df.columns, list(_PIECES), doc_id=id_col, source=source_col, length=length_col, cluster=cluster_col)


def pack_texts(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Packs a documents table: doc_id, source, n_tokens, cluster and the piece's columns."""
    import public_tokenizers
    docs = docs.select("doc_id", "text", "source")
    return pack_documents(with_lengths(docs, tokenizer or public_tokenizers.path("word_bpe_49k.json")))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per piece of a document: doc_id, source, n_tokens, cluster, piece, piece_start,
    piece_tokens, bin_id."""
    return pack_texts(read_table(spark, sf_dir, "documents"))
