"""Substring dedup with difference-cover anchors.

Every word that a window of ``window`` consecutive words covers is removed when the
same window starts earlier in the corpus (smaller id, or same document and earlier
start). Windows are judged on the input.

Anchors are runs of ``window - period + 1`` words hashed only where the place in the
document modulo ``period`` is in ``cover``, a difference cover: for two equal windows at
any two places there is an offset below ``period`` at which both have a cover place, so
they share an aligned anchor. Three steps over blocks of whole documents
(see ``exchange``):

1. blocks send their distinct anchor hashes; buckets answer which occur in more than one
   place;
2. around repeated anchors, blocks extend to all windows that contain one, and send these
   windows' 128-bit hashes with the earliest owner in the block; buckets answer whose
   window is the first of the corpus;
3. blocks remove the words under windows that are not the first.

The documents are shuffled once; the three steps read the same exchange. Its rows come in
another order at each read (blocks are fetched from other executors as they arrive), so steps 2 and 3,
which speak of places in a block, put them in order first. No pairs are made: a passage that a
third of the corpus shares is one entry per block.

The kept words' white space stays as it was in a text that loses some, and other texts stay as they are.

Edge cases: a null text has no words and stays null; an empty or short text is kept.
Null ids come before all others. Rows with the same id are ordered by block and a hash
of their text; of wholly equal rows, which are in one block, one is the earlier one. An empty
table gives an empty result.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricestream.llm import exchange as X
from pricestream.llm import words as W
from pricestream.llm.frames import carry, prepare, restore, schema_of, table
from pricestream.sources.tables import read_table

WINDOW = 20
#: A difference cover modulo 13 (every residue is a difference of two members).
PERIOD, COVER = 13, (0, 1, 3, 9)

_MESSAGE = "block int, bucket int, n long, payload binary"
_MESSAGE_TYPES = {"block": pa.int32(), "bucket": pa.int32(), "n": pa.int64(), "payload": pa.binary()}


def _messages(rows: list[tuple]) -> pa.Table:
    cols = list(zip(*rows)) or [[], [], [], []]
    return pa.table({k: pa.array(c, t) for (k, t), c in zip(_MESSAGE_TYPES.items(), cols)})


def _one(tab: pa.Table, col: str) -> np.ndarray:
    return tab.column(col).combine_chunks().to_numpy(zero_copy_only=False)


def _hashed(tab: pa.Table) -> tuple[W.Words, np.ndarray]:
    w = W.split_words(W.as_texts(tab.column("text")))
    return w, W.word_hashes(w.vocab)[w.codes]


def _anchors(w: W.Words, word_hash: np.ndarray, size: int, period: int, cover) -> tuple[np.ndarray, np.ndarray]:
    """Places of the anchors and their hashes."""
    inside = W.starts_in_one_text(w.offsets, size)
    place = np.arange(len(w.codes)) - np.repeat(w.offsets[:-1], np.diff(w.offsets))
    at = np.flatnonzero(inside & np.isin(place[:len(inside)] % period, cover))
    return at, W.window_hashes(word_hash, size)[at] if len(at) else np.empty(0, np.uint64)


def dedup_substrings(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                     period: int = PERIOD, cover: tuple = COVER, keep_spaces: bool = True) -> DataFrame:
    """``df`` with the repeated words removed from its text, and the columns n_words and n_removed (long).
    White space between kept words stays as it is (see ``without_words``), and a text that loses no word is
    not touched; without ``keep_spaces`` kept words are joined by one space in every text."""
    if not 0 < period <= window or {(a - b) % period for a in cover for b in cover} != set(range(period)):
        raise ValueError("cover must be a difference cover modulo period, and period at most window")
    size = window - period + 1
    prepare(df.sparkSession)
    n = X.block_count(df, text_col)
    docs = X.blocked(carry(df, doc_id=id_col, text=text_col), "doc_id", "text", n)
    by_block = docs.groupBy("block")

    def send_anchors(tab: pa.Table) -> pa.Table:
        block = tab.column("block")[0].as_py()
        w, h = _hashed(tab)
        at, key = _anchors(w, h, size, period, cover)
        keys, count = np.unique(key, return_counts=True)
        cut, rows = X.bucket_bounds(keys, n), []
        for b in np.flatnonzero(np.diff(cut)):
            part = slice(cut[b], cut[b + 1])
            many = np.packbits(count[part] > 1).tobytes()
            k = int(cut[b + 1] - cut[b])
            rows.append((block, int(b), k, many + X.pack_sorted(keys[part])))
        return _messages(rows)

    def answer_anchors(tab: pa.Table) -> pa.Table:
        counts = _one(tab, "n")
        payloads = [p.as_py() for p in tab.column("payload")]
        keys = [X.unpack_sorted(p[(k + 7) // 8:], k) for p, k in zip(payloads, counts)]
        _, inverse, seen = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
        shared = seen[inverse] > 1
        rows, at = [], 0
        for block, bucket, k, p in zip(_one(tab, "block"), _one(tab, "bucket"), counts, payloads):
            own = np.unpackbits(np.frombuffer(p, np.uint8, (k + 7) // 8), count=k).astype(bool)
            rows.append((int(block), int(bucket), int(k), np.packbits(own | shared[at:at + k]).tobytes()))
            at += k
        return _messages(rows)

    def send_windows(tab: pa.Table, answers: pa.Table) -> pa.Table:
        if not tab.num_rows:
            return _messages([])
        block = tab.column("block")[0].as_py()
        tab, ids = _ordered(tab)
        w, h = _hashed(tab)
        at, key = _anchors(w, h, size, period, cover)
        keys, inverse = np.unique(key, return_inverse=True)
        repeated = _bits(answers, len(keys))[inverse]
        near = np.zeros(len(w.codes) + 1, np.int64)
        near[1:][at[repeated]] = 1
        near = np.cumsum(near)
        starts = np.flatnonzero(W.starts_in_one_text(w.offsets, window))
        starts = starts[near[starts + period] > near[starts]]
        if not len(starts):
            return _messages([])
        high = W.window_hashes(h, window)[starts]
        low = W.window_hashes(h ^ np.uint64(0xA5A5A5A5A5A5A5A5), window)[starts]
        doc = W.doc_of(w.offsets)[starts]
        # the earliest occurrence of each distinct window of the block stands first
        order = np.lexsort((starts, low, high))
        head = np.ones(len(order), bool)
        same = (high[order][1:] == high[order][:-1]) & (low[order][1:] == low[order][:-1])
        head[1:] = ~same
        first = order[head]
        number = np.empty(len(order), np.int64)
        number[order] = np.cumsum(head) - 1
        memo = [X.pack_sorted(starts.astype(np.uint64)), X.pack(number), X.pack(first)]
        rows = [(block, -1 - block, len(starts), len(first).to_bytes(8, "little") + b"".join(
            len(m).to_bytes(8, "little") + m for m in memo))]
        keys = high[first]
        cut = X.bucket_bounds(keys, n)
        for b in np.flatnonzero(np.diff(cut)):
            part = first[cut[b]:cut[b + 1]]
            sorted_high = X.pack_sorted(high[part])
            rows.append((block, int(b), len(part), low[part].tobytes() + len(sorted_high).to_bytes(8, "little")
                         + sorted_high + X.pack(ids[doc[part]].view(np.uint64))))
        return _messages(rows)

    def answer_windows(tab: pa.Table) -> pa.Table:
        if tab.column("bucket")[0].as_py() < 0:
            return tab.select(list(_MESSAGE_TYPES))
        counts = _one(tab, "n")
        low, ids, high = [], [], []
        for p, k in zip(tab.column("payload"), counts):
            p = p.as_py()
            size = int.from_bytes(p[8 * k:8 * k + 8], "little")
            low.append(np.frombuffer(p, np.uint64, k))
            high.append(X.unpack_sorted(p[8 * k + 8:8 * k + 8 + size], k))
            ids.append(X.unpack(p[8 * k + 8 + size:], k).view(np.int64))
        low, ids, high = map(np.concatenate, (low, ids, high))
        # one owner per block; equal ids in two blocks are different texts, ordered by block
        order = np.lexsort((np.repeat(_one(tab, "block"), counts), ids, low, high))
        head = np.ones(len(order), bool)
        head[1:] = (high[order][1:] != high[order][:-1]) | (low[order][1:] != low[order][:-1])
        wins = np.zeros(len(order), bool)
        wins[order[head]] = True
        rows, at = [], 0
        for block, bucket, k in zip(_one(tab, "block"), _one(tab, "bucket"), counts):
            rows.append((int(block), int(bucket), int(k), np.packbits(wins[at:at + k]).tobytes()))
            at += k
        return _messages(rows)

    def remove(tab: pa.Table, answers: pa.Table) -> pa.Table:
        tab, _ = _ordered(tab)
        texts = W.as_texts(tab.column("text"))
        w = W.split_words(texts)
        gone = np.zeros(len(w.codes) + 1, np.int64)
        memo = answers.filter(pc.less(answers.column("bucket"), 0))
        if memo.num_rows:
            starts, number, first = _memo(memo.column("payload")[0].as_py(), memo.column("n")[0].as_py())
            wins = _bits(answers.filter(pc.greater_equal(answers.column("bucket"), 0)), len(first))
            original = np.zeros(len(starts), bool)
            original[first[wins]] = True
            repeats = starts[~original]
            np.add.at(gone, repeats, 1)
            np.add.at(gone, repeats + window, -1)
        keep = np.cumsum(gone)[:-1] == 0
        before = np.concatenate(([0], np.cumsum(keep)))
        n_words = np.diff(w.offsets)
        n_removed = n_words - np.diff(before[w.offsets])
        if keep_spaces:
            whole = tab.column("text").combine_chunks().cast(pa.string())
            changed = n_removed > 0
            parts = [without_words(t, keep[w.offsets[i]:w.offsets[i + 1]]) for i, t in zip(
                np.flatnonzero(changed), texts.filter(pa.array(changed)).to_pylist())]
            text = pc.replace_with_mask(whole, pa.array(changed), pa.array(parts, pa.string()))
        else:
            kept = pa.LargeListArray.from_arrays(before[w.offsets], w.vocab.take(pa.array(w.codes[keep])))
            text = pc.binary_join(kept, pa.scalar(" ", pa.large_string())).cast(pa.string())
            text = pc.if_else(pc.is_null(tab.column("text").combine_chunks()), pa.scalar(None, pa.string()), text)
        return table(doc_id=tab.column("doc_id"), text=text, rest=tab.column("rest"), n_words=n_words, n_removed=n_removed)

    out_schema = schema_of(docs, "doc_id", "text", "rest", n_words="long", n_removed="long")
    step1 = by_block.applyInArrow(send_anchors, _MESSAGE)
    step1 = step1.groupBy("bucket").applyInArrow(answer_anchors, _MESSAGE)
    step2 = by_block.cogroup(step1.groupBy("block")).applyInArrow(
        lambda a, b: send_windows(a, b.sort_by("bucket")), _MESSAGE)
    step2 = step2.groupBy("bucket").applyInArrow(answer_windows, _MESSAGE)
    done = by_block.cogroup(step2.groupBy("block")).applyInArrow(
        lambda a, b: remove(a, b.sort_by("bucket")), out_schema)
    return restore(done, df.columns, ["n_words", "n_removed"], doc_id=id_col, text=text_col)


_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def without_words(text: str, keep: np.ndarray) -> str:
    """``text`` with only the words marked in ``keep``. The white space between words that stay next to each other is not
    touched. Where words went from between two, one of the two gaps around them stays: the first, or
    the last if only that breaks a line. White space before the first and after the last word stays."""
    spans = [m.span() for m in _WORD.finditer(text)]
    if not keep.any():
        return ""
    edge = np.diff(keep.astype(np.int8), prepend=0, append=0)
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1  # runs of kept words
    out = [text[:spans[0][0]]]
    for k, (a, b) in enumerate(zip(first.tolist(), last.tolist())):
        if k:
            gone = last[k - 1]
            left, right = text[spans[gone][1]:spans[gone + 1][0]], text[spans[a - 1][1]:spans[a][0]]
            out.append(right if "\n" in right and "\n" not in left else left)
        out.append(text[spans[a][0]:spans[b][1]])
    return "".join([*out, text[spans[-1][1]:]])


def _bits(answers: pa.Table, n: int) -> np.ndarray:
    parts = [np.unpackbits(np.frombuffer(p.as_py(), np.uint8), count=k)
             for p, k in zip(answers.column("payload"), _one(answers, "n"))] if answers.num_rows else []
    bits = np.concatenate(parts).astype(bool) if parts else np.zeros(0, bool)
    if len(bits) != n:
        raise RuntimeError(f"answers for {len(bits)} keys, asked for {n}")
    return bits


def _memo(data: bytes, n_starts: int) -> list[np.ndarray]:
    n_first, at, out = int.from_bytes(data[:8], "little"), 8, []
    for f, n in ((X.unpack_sorted, n_starts), (X.unpack, n_starts), (X.unpack, n_first)):
        size = int.from_bytes(data[at:at + 8], "little")
        out.append(f(data[at + 8:at + 8 + size], n).astype(np.int64))
        at += 8 + size
    return out


def _ordered(tab: pa.Table) -> tuple[pa.Table, np.ndarray]:
    """The documents of a block by id (null: before all), then hash of the text, and their ids. At every read of the
    block this is the same order, but for rows equal in id and text."""
    ids = pc.fill_null(tab.column("doc_id").cast(pa.int64()), -(1 << 63)).combine_chunks().to_numpy()
    tie = [xxhash.xxh3_64_intdigest(t, 1) for t in W.as_texts(tab.column("text")).to_pylist()]
    order = np.lexsort((np.array(tie, np.uint64), ids))
    return tab.take(pa.array(order)), ids[order]


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 and text (the kept words)."""
    done = dedup_substrings(read_table(spark, sf_dir, "documents").select("doc_id", "text"), keep_spaces=False)
    text = F.coalesce("text", F.lit(""))
    return done.select("doc_id", "n_words", "n_removed", F.sha2(text, 256).alias("kept_sha256"), text.alias("text"))


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20),
k AS (SELECT doc_id, i, row_number() OVER (PARTITION BY array_to_string(w[i:i + 19], ' ') ORDER BY doc_id, i) AS r FROM s),
gone AS (SELECT DISTINCT doc_id, i + unnest(range(0, 20)) AS p FROM k WHERE r > 1),
t AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n
         FROM t ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256, coalesce(text, '') AS text
FROM d LEFT JOIN kept USING (doc_id)
"""
