"""Document fingerprints by locally consistent parsing.

The code points of a text are parsed into phrases, phrases into phrases of phrases, level by
level. On each level runs of one name become a single name; then deterministic coin
tossing turns names into labels below six: a name's label is the lowest bit in which it differs from
its left neighbour and that bit's value, a few times over. Local maxima of the labels start
phrases, and a phrase's name is a hash of the names in it. Whether a phrase starts at a place
depends on a few names to its left and one to its right, so equal substrings are parsed
alike, up to a margin at their ends, wherever they stand.

The fingerprint sketches the names of the levels from ``LEVEL`` on (of the last level, if a text has
no more): names fall into ``BINS`` bins by their upper bits and each bin keeps 16 bits
of its least name, four hex digits, 0000 if empty. The likeness of two fingerprints, the
share of equal bins among those that are not empty in both, estimates the Jaccard likeness of
the name sets.

Edge cases: null and empty texts have no names: all bins are empty; two such fingerprints have
likeness 1, one and another have 0. Texts of any length are parsed whole. For the next
document, null ids come first and equal ids are ordered by a hash of the text; the only row of a table
is its own next one. An empty table gives an empty result.
"""

from __future__ import annotations

from hashlib import sha256
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricestream.llm import exchange as X
from pricestream.llm import words as W
from pricestream.llm.frames import carry, prepare, restore, schema_of
from pricestream.sources.tables import read_table

LEVEL, BINS = 3, 128
#: Rounds of coin tossing: 64 bits -> 128 -> 14 -> 8 -> 6 labels.
ROUNDS = 4
_RUN, _PLACE = np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def _labels(names: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Coin tossing against the left neighbour; ``starts``: first places of texts. Neighbours differ."""
    x = names
    for _ in range(ROUNDS):
        left = np.empty_like(x)
        left[1:] = x[:-1]
        left[starts] = ~x[starts]
        differ = x ^ left
        low = differ & (~differ + differ.dtype.type(1))
        bit = (x & low) != 0
        x = (2 * np.bitwise_count(low - low.dtype.type(1)) + bit).astype(np.uint8)
    return x


class Phrases(NamedTuple):
    """One level: phrase names, phrases per text; first name of every run, first run of every phrase, and of
    every text."""
    names: np.ndarray
    sizes: np.ndarray
    runs: np.ndarray
    heads: np.ndarray
    starts: np.ndarray


def _within(places: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """How many of the sorted ``places`` lie in each text."""
    return np.diff(np.append(np.searchsorted(places, starts), len(places)))


def _next_level(names: np.ndarray, sizes: np.ndarray) -> Phrases:
    """Phrases of sequences of names. Texts have at least one name."""
    starts = np.cumsum(sizes) - sizes
    # runs
    fresh = np.ones(len(names), bool)
    fresh[1:] = names[1:] != names[:-1]
    fresh[starts] = True
    runs = np.flatnonzero(fresh)
    if len(runs) < len(names):
        count = np.diff(np.append(runs, len(names)))
        names = names[runs].astype(np.uint64)
        many = count > 1
        names[many] = W.mix(names[many] + count[many].astype(np.uint64) * _RUN)
        sizes = _within(runs, starts)
        starts = np.cumsum(sizes) - sizes
    label = _labels(names, starts)
    head = np.zeros(len(names), bool)
    head[1:-1] = (label[1:-1] > label[:-2]) & (label[1:-1] > label[2:])
    # at the end of a text there is no right neighbour
    last = np.append(starts[1:], len(names)) - 1
    inner = last[sizes > 1]
    head[inner] = label[inner] > label[inner - 1]
    head[starts] = True
    at = np.flatnonzero(head)
    place = (np.arange(len(names)) - np.repeat(at, np.diff(np.append(at, len(names))))).astype(np.uint64)
    inside = W.mix(names.astype(np.uint64) + (place + np.uint64(1)) * _PLACE)
    return Phrases(W.mix(np.add.reduceat(inside, at)), _within(at, starts), runs, at, starts)


def _code_points(texts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)


def _prints(names: np.ndarray, sizes: np.ndarray, who: np.ndarray, n: int) -> np.ndarray:
    """Fingerprints of ``n`` texts from the first level's names of those (``who``) that have any."""
    out = np.zeros((n, BINS), np.uint16)
    least = np.full(n * BINS, ~np.uint64(0))
    level = 1
    while len(who):
        ended = sizes == 1
        take = np.repeat(ended | (level >= LEVEL), sizes)
        owner = np.repeat(who, sizes)
        key = W.mix(names[take] + np.uint64(level if level < LEVEL else LEVEL))
        slot = owner[take] * BINS + (key % np.uint64(BINS)).astype(np.int64)
        np.minimum.at(least, slot, key)
        stay = np.repeat(~ended, sizes)
        names, who, sizes = names[stay], who[~ended], sizes[~ended]
        if len(who):
            names, sizes = _next_level(names, sizes)[:2]
            level += 1
    least = least.reshape(n, BINS)
    full = least != ~np.uint64(0)
    out[full] = (1 + (least[full] >> np.uint64(7)) % np.uint64(65535)).astype(np.uint16)
    return out


def sketch(texts: list[str]) -> np.ndarray:
    """Fingerprints as an array (texts, BINS) of unsigned 16 bit."""
    sizes = np.array([len(t) for t in texts], np.int64)
    who = np.flatnonzero(sizes)
    if not len(who):
        return np.zeros((len(texts), BINS), np.uint16)
    first = _next_level(_code_points(texts), sizes[who])
    return _prints(first.names, first.sizes, who, len(texts))


def sketch_edited(texts: list[str], keep: list[int], ends: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of the texts, and of the texts of which the first ``keep`` code points stay and the rest is
    replaced by ``ends``. A text that is not empty keeps one code point at least.

    The edited text's first level is parsed anew only from the last phrase that the edit cannot touch: a phrase start
    depends on ROUNDS + 1 runs to its left and one to its right, so the parse takes up that many runs
    before that phrase and agrees with the text's own from there."""
    sizes = np.array([len(t) for t in texts], np.int64)
    who = np.flatnonzero(sizes)
    if not len(who):
        return (np.zeros((len(texts), BINS), np.uint16),) * 2
    first = _next_level(_code_points(texts), sizes[who])
    begin = np.cumsum(sizes[who]) - sizes[who]
    # the run with the last kept code point may grow or shrink; the one before it may lose its start
    touched = np.searchsorted(first.runs, begin + np.array(keep, np.int64)[who] - 1, "right") - 1
    phrase = np.searchsorted(first.heads, touched - 2, "right") - 1
    own = np.cumsum(first.sizes) - first.sizes
    resume = first.heads[np.maximum(phrase, 0)] - (ROUNDS + 1)
    reuse = (phrase > own) & (resume >= first.starts)
    place = np.where(reuse, first.runs[np.maximum(resume, 0)] - begin, 0).tolist()
    tails = [texts[w][p:keep[w]] + ends[w] for w, p in zip(who.tolist(), place)]
    tail = _next_level(_code_points(tails), np.array([len(t) for t in tails], np.int64))
    # phrases of a tail that start before the shared one
    skip = np.searchsorted(tail.heads, tail.starts + np.where(reuse, ROUNDS + 1, 0))
    end = np.cumsum(tail.sizes)
    shared = np.where(reuse, phrase - own, 0)
    pieces = []
    for a, n, b, c in zip(own.tolist(), shared.tolist(), skip.tolist(), end.tolist()):
        pieces += [first.names[a:a + n], tail.names[b:c]]
    m = len(texts)
    done = _prints(np.concatenate([first.names, *pieces]), np.concatenate((first.sizes, shared + end - skip)),
                   np.concatenate((who, who + m)), 2 * m)
    return done[:m], done[m:]


def to_strings(prints: np.ndarray) -> list[str]:
    return [row.astype(">u2").tobytes().hex() for row in prints]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Likeness of fingerprints, row by row."""
    used = ((a != 0) | (b != 0)).sum(axis=1)
    same = ((a == b) & (a != 0)).sum(axis=1)
    return np.where(used == 0, 1.0, same / np.maximum(used, 1))


#: Code points that are parsed together: their arrays stay in a core's cache.
TOGETHER = 1 << 16


def _runs_of(texts: list[str], most: int):
    """First and last places of runs of texts of about ``most`` code points, so that memory stays bounded."""
    at, total = 0, np.cumsum([len(t) for t in texts])
    while at < len(texts):
        base = total[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(total, base + most, "right")))
        yield at, end
        at = end


def _sketches(texts: list[str], most: int = TOGETHER) -> np.ndarray:
    return np.concatenate([np.zeros((0, BINS), np.uint16), *[sketch(texts[a:b]) for a, b in _runs_of(texts, most)]])


def _edited(texts: list[str], most: int = TOGETHER) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Fingerprints of all texts but the last, of those edited by their next ones, and checksums of the edited."""
    prints, new, checks = [np.zeros((0, BINS), np.uint16)], [np.zeros((0, BINS), np.uint16)], []
    for a, b in _runs_of(texts[:-1], most):
        run = texts[a:b]
        keep = [len(t) - len(t) // 4 for t in run]
        ends = [following[:len(t) // 4] for t, following in zip(run, texts[a + 1:b + 1])]
        checks += [sha256((t[:k] + e).encode()).hexdigest() for t, k, e in zip(run, keep, ends)]
        one, two = sketch_edited(run, keep, ends)
        prints.append(one)
        new.append(two)
    return np.concatenate(prints), np.concatenate(new), checks


def fingerprints(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` and the column fingerprint."""
    rows = carry(df, text=text_col)
    prepare(df.sparkSession)

    def add(batches):
        for batch in batches:
            for part in W.slices(batch, "text", 4 << 20):
                prints = _sketches(W.as_texts(part.column("text")).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(to_strings(prints), pa.string())],
                                                 ["text", "rest", "fingerprint"])

    done = rows.mapInArrow(add, schema_of(rows, "text", "rest", fingerprint="string"))
    return restore(done, df.columns, ["fingerprint"], text=text_col)


def _sort_key(tab) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of rows: null ids, ids, tie."""
    ids = tab.column("doc_id")
    ids = ids.combine_chunks() if isinstance(ids, pa.ChunkedArray) else ids
    tie = tab.column("tie")
    tie = tie.combine_chunks() if isinstance(tie, pa.ChunkedArray) else tie
    return pc.is_valid(ids).to_numpy(zero_copy_only=False), pc.fill_null(ids, 0).to_numpy(), tie.to_numpy()


def edited_fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For every document the fingerprints of its text and of the text whose last quarter is
    replaced by the beginning of the next document: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next.

    Documents are dealt into ranges of ids; the first document of a range also goes to the range
    before it, so every document meets its next one and texts are shuffled once."""
    spark = df.sparkSession
    prepare(spark)
    docs = carry(df, doc_id=id_col, text=text_col).select("doc_id", "text").withColumn("tie", F.xxhash64("text"))
    n = X.block_count(docs)

    def first(batches):
        best = None
        for batch in batches:
            if batch.num_rows:
                order = np.lexsort(_sort_key(batch)[::-1])[:1]
                row = tuple(int(k[order[0]]) for k in _sort_key(batch))
                best = row if best is None else min(best, row)
        if best is not None:
            yield pa.RecordBatch.from_pydict({"v": [best[0]], "i": [best[1]], "t": [best[2]]})

    # one row per range
    lows = sorted(tuple(r) for r in docs.select("doc_id", "tie").repartitionByRange(n, F.asc_nulls_first("doc_id"), "tie")
                  .mapInArrow(first, "v long, i long, t long").collect())
    ranges = max(len(lows), 1)
    low = [np.array(c, np.int64) for c in zip(*lows)] or [np.zeros(0, np.int64)] * 3

    def deal(batches):
        for batch in batches:
            keys = [np.concatenate((b, k.astype(np.int64))) for b, k in zip(low, _sort_key(batch))]
            bound = np.arange(len(keys[0])) < ranges
            order = np.lexsort((~bound, *keys[::-1]))
            place = np.empty(len(order), np.int64)
            place[order] = np.cumsum(bound[order]) - 1
            number = place[ranges:]
            opens = np.all([k[:ranges][number] == k[ranges:] for k in keys], axis=0)
            guest = batch.filter(pa.array(opens))
            for part, where, is_guest in ((batch, number, False), (guest, (number[opens] - 1) % ranges, True)):
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(where.astype(np.int32)), pa.array(np.full(part.num_rows, is_guest))],
                    ["doc_id", "text", "tie", "range", "guest"])

    def compare(tab: pa.Table) -> pa.Table:
        order = np.lexsort((*_sort_key(tab)[::-1], tab.column("guest").combine_chunks().to_numpy(zero_copy_only=False)))
        tab = tab.take(pa.array(order))
        own = pc.sum(pc.invert(tab.column("guest"))).as_py() or 0
        texts = W.as_texts(tab.column("text")).to_pylist()[:own + 1]
        prints, new, checks = _edited(texts)
        prints, m = np.concatenate((prints, _sketches(texts[-1:]))), min(own, len(new))
        return pa.table({
            "doc_id": tab.column("doc_id").slice(0, m), "n_chars": pa.array([len(t) for t in texts[:m]], pa.int64()),
            "edited_sha256": pa.array(checks, pa.string()),
            "fingerprint": pa.array(to_strings(prints[:m]), pa.string()),
            "edited_fingerprint": pa.array(to_strings(new), pa.string()),
            "near_edited": likeness(prints[:m], new), "near_next": likeness(prints[:m], prints[1:m + 1])})

    dealt = docs.mapInArrow(deal, schema_of(docs, "doc_id", "text", "tie", range="int", guest="boolean"))
    return dealt.repartition(n, "range").groupBy("range").applyInArrow(
        compare, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                 "edited_fingerprint string, near_edited double, near_next double")


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document; see ``edited_fingerprints``."""
    return edited_fingerprints(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
