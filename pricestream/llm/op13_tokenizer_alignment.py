"""Cross-tokenizer alignment with a minimal perfect hash of the linked id pairs.

Two tokenizers cut the same bytes (a space and the text). Where tokens of both end at one byte
offset, a group ends; every token occurrence of the one tokenizer is linked with every one of the other in
its group. How many documents of the corpus hold a pair of ids linked is counted in two passes:

1. blocks of whole documents align their texts and send each bucket of the pair space its
   distinct pairs with their document counts. A bucket's messages are added up in lanes of ``FAN_IN``
   blocks, then lanes of lanes; at the root the distinct pairs get a minimal perfect hash (levels
   of bit arrays), every lane's counts become a dense vector indexed by it, and the vectors are
   summed as a tree. The pairs are kept in the order of their slots, so that a lookup is verified;
2. the buckets look the messages' pairs up and answer the blocks, which align their texts again
   and add up what their links count.

A text is cut at single spaces between other characters: neither tokenizer joins across these (the
piece vocabulary is checked for it), so each distinct stretch of a block is encoded and aligned once.
The number of pairs is bounded by the product of the vocabularies, so the number of buckets is,
and messages grow with the input alone; they are written once. Documents are shuffled in each pass.

Edge cases: null and empty texts, and texts whose joined tokens of either side are not the
bytes of space and text (one with U+2581 in it, say), have no tokens: zeros and an empty groups text; their pairs
are not counted. Rows count as documents, also rows with one id (or a null id) or wholly equal
ones. Further columns come through; one of an added column's name is replaced. An empty table gives an
empty result.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache
from hashlib import sha256
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricestream.llm import exchange as X
from pricestream.llm import words as W
from pricestream.llm.frames import carry, prepare, restore, schema_of, table
from pricestream.llm.op10_bpe import SPLIT, byte_characters
from pricestream.session import materialize
from pricestream.sources.tables import read_table

#: Blocks of a lane, and lanes that are added up in one step of the tree.
FAN_IN = 64
#: Blocks for each bucket; buckets at most (a bucket then has about 800,000 pairs if every pair of two
#: vocabularies of 50,000 and 32,000 ids occurs).
BUCKET_BLOCKS, MOST_BUCKETS = 2, 2048
#: Texts given to a tokenizer at once; pairs of a group that are made by repetition (above: by distinct ids).
TOGETHER, PLAIN_GROUP = 20_000, 4096
#: Cells of the table (texts x pairs) that is filled at once to count documents.
HELD_AT_ONCE = 1 << 26

_CUT = re.compile(r"(?<=\S) (?=\S)")
_MESSAGE = "block int, bucket int, lane int, n long, keys binary, counts binary"
_ANSWER = "block int, bucket int, n long, counts binary"
_INDEX = "bucket int, n long, hash binary, keys binary, counts binary"


# --- the hash ---------------------------------------------------------------------------

class PerfectHash:
    """Slots 0..n-1 for n distinct unsigned 64-bit keys. On each level the remaining keys are thrown into a bit
    array; those alone in their place stay, the others go on. A key's slot is the rank of its bit."""

    SPARE = 1.6

    def __init__(self, levels: list[np.ndarray]):
        self.bits = levels
        ranks = np.cumsum(np.concatenate([np.zeros(1, np.int64), *levels]), dtype=np.int64)
        start = np.cumsum([0, *map(len, levels)])
        self.rank = [ranks[a:b] for a, b in zip(start[:-1], start[1:])]

    @staticmethod
    def _places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        seed = np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        return (W.mix(keys ^ W.mix(np.array([seed]))[0]) % np.uint64(size)).astype(np.int64)

    @classmethod
    def of(cls, keys: np.ndarray) -> "PerfectHash":
        levels, rest = [], keys.astype(np.uint64)
        while len(rest):
            size = int(len(rest) * cls.SPARE) + 8
            at = cls._places(rest, len(levels), size)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            rest = rest[~alone[at]]
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; for a key that is not in the set any slot, or -1."""
        out, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, (bits, rank) in enumerate(zip(self.bits, self.rank)):
            if not len(left):
                break
            at = self._places(keys[left].astype(np.uint64), level, len(bits))
            hit = bits[at]
            out[left[hit]] = rank[at[hit]]
            left = left[~hit]
        return out

    def tobytes(self) -> bytes:
        return X.join_fields(*chain.from_iterable((len(b).to_bytes(8, "little"), np.packbits(b).tobytes()) for b in self.bits))

    @classmethod
    def frombytes(cls, data: bytes) -> "PerfectHash":
        f = X.split_fields(data)
        return cls([np.unpackbits(np.frombuffer(b, np.uint8), count=int.from_bytes(n, "little")).astype(bool)
                    for n, b in zip(f[::2], f[1::2])])


def tree_sum(vectors: list[np.ndarray]) -> np.ndarray:
    while len(vectors) > 1:
        vectors = [np.sum(vectors[i:i + 2], axis=0) for i in range(0, len(vectors), 2)]
    return vectors[0]


# --- alignment --------------------------------------------------------------------------

class Stretches(NamedTuple):
    """The distinct stretches of a block's texts, aligned. ``offsets``, ``codes``: the stretches of each text (none for
    a text without tokens); per stretch the numbers of tokens, groups and links, the groups' text, and its distinct
    pairs ``pairs[starts[i]:starts[i+1]]`` with the number of links of each."""
    offsets: np.ndarray
    codes: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    groups: pa.Array
    starts: np.ndarray
    pairs: np.ndarray
    links: np.ndarray


def _by_ranks(spec: dict, token_bytes: list[bytes]):
    """An encoder by ranks, where the vocabulary allows it: ids in order of the merges, and the usual split. Rank and id
    are then the same, and it gives the ids that the merges give."""
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    merges = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    ids = [model["vocab"][m] for m in merges]
    if (spec.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True)
            or model.get("ignore_merges") or any(a >= b for a, b in zip(ids, ids[1:]))):
        return None
    import tiktoken
    added = {t["id"] for t in spec["added_tokens"]}
    ranks = {x: i for i, x in enumerate(token_bytes) if i not in added}
    return tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


class Aligner:
    """Tokens of a byte-level BPE file (A) and of a piece model (B), and their groups."""

    def __init__(self, a_json: str, b_model: bytes):
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer
        spec = json.loads(a_json)
        byte_of = {c: b for b, c in enumerate(byte_characters())}
        vocab = {**spec["model"]["vocab"], **{t["content"]: t["id"] for t in spec["added_tokens"]}}
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.a_bytes[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        self.ranks = _by_ranks(spec, self.a_bytes)
        if self.ranks is None:
            self.a = Tokenizer.from_str(a_json)
            self.a.encode_special_tokens = True  # their strings in a text are plain text
            self.a.no_truncation()
            self.a.no_padding()
        self.b = SentencePieceProcessor(model_proto=b_model)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        #: whether stretches are independent: no piece goes on over the start of a word
        self.cuts = not any("▁" in p.lstrip("▁") for p in pieces)
        self.a_size, self.b_size = (np.array([len(x) for x in v]) for v in (self.a_bytes, self.b_bytes))
        self.a_pool, self.b_pool = (np.frombuffer(b"".join(v), np.uint8) for v in (self.a_bytes, self.b_bytes))
        self.a_text, self.b_text = (pa.array(map(str, range(len(v))), pa.large_string()) for v in (self.a_bytes, self.b_bytes))

    def _stretches(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """Offsets, numbers and the distinct stretches of every text."""
        cut = pc.split_pattern(texts, " ") if self.cuts else pa.LargeListArray.from_arrays(
            pa.array(np.arange(len(texts) + 1)), texts)
        offsets = np.asarray(cut.offsets).astype(np.int64)
        flat = cut.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
        offsets, codes = offsets - offsets[0], np.asarray(flat.indices).astype(np.int64)
        units = flat.dictionary.to_pylist()
        # parts next to further white space are not stretches of their own: these texts are cut again, one by one
        odd = np.array([not u or u[0].isspace() or u[-1].isspace() for u in units], bool)
        count = np.diff(offsets)
        empty = np.asarray(pc.binary_length(texts)) == 0
        again = (_sums(odd[codes], offsets) > 0) & ~empty & (count > 1)
        if again.any() or empty.any():
            number = dict(zip(units, range(len(units))))
            parts, held = [], np.split(codes, offsets[1:-1]) if len(texts) else []
            for i, own in enumerate(held):
                if again[i]:
                    own = np.array([number.setdefault(u, len(number)) for u in _CUT.split(texts[i].as_py())], np.int64)
                parts.append(own[:0] if empty[i] else own)
            codes, offsets = np.concatenate(parts), np.cumsum([0, *map(len, parts)])
            units = list(number)
        used, codes = np.unique(codes, return_inverse=True)
        return offsets, codes, [units[i] for i in used.tolist()]

    def _ids(self, units: list[str], ends: np.ndarray, side: str) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of tokens of the stretches, and the ids. ``ends``: where each ends in the bytes of all."""
        if side == "a" and self.ranks is not None:
            # the stretches one after the other: no token goes over the space between two
            ids = [np.asarray(self.ranks.encode_ordinary(f" {' '.join(units[i:i + TOGETHER])}"), np.int64)
                   for i in range(0, len(units), TOGETHER)] if self.cuts else [
                       np.asarray(self.ranks.encode_ordinary(f" {u}"), np.int64) for u in units]
            ids = np.concatenate(ids) if ids else np.zeros(0, np.int64)
            return np.diff(np.searchsorted(np.cumsum(self.a_size[ids]), ends, "right"), prepend=0), ids
        lists = []
        for i in range(0, len(units), TOGETHER):
            part = units[i:i + TOGETHER]
            if side == "a":
                lists += [e.ids for e in self.a.encode_batch_fast([f" {u}" for u in part], add_special_tokens=False)]
            else:
                lists += self.b.encode(part, num_threads=1)
        count = np.fromiter(map(len, lists), np.int64, len(lists))
        return count, np.fromiter(chain.from_iterable(lists), np.int64, int(count.sum()))

    @staticmethod
    def _whole(data: np.ndarray, size: np.ndarray, count: np.ndarray, ids: np.ndarray, pool: np.ndarray,
               token_size: np.ndarray) -> np.ndarray:
        """Which stretches (``size`` bytes each of ``data``) the tokens give back byte for byte."""
        each = token_size[ids]
        before = np.concatenate(([0], np.cumsum(each)))
        ends = np.cumsum(count)
        got = before[ends] - before[ends - count]
        start = (np.cumsum(token_size) - token_size)[ids]
        joined = pool[np.arange(int(before[-1])) + np.repeat(start - before[:-1], each)]
        right = got == size
        if right.all() and (joined == data).all():
            return right
        first, at = np.cumsum(size) - size, before[ends - count]
        for i in np.flatnonzero(right):
            right[i] = (joined[at[i]:at[i] + size[i]] == data[first[i]:first[i] + size[i]]).all()
        return right

    def align(self, texts: pa.Array) -> Stretches:
        offsets, codes, units = self._stretches(texts)
        size = np.asarray(pc.binary_length(pa.array(units, pa.large_string()))).astype(np.int64) + 1
        data = np.frombuffer("".join([f" {u}" for u in units]).encode(), np.uint8)
        (n_a, a), (n_b, b) = (self._ids(units, np.cumsum(size), side) for side in "ab")
        good = (self._whole(data, size, n_a, a, self.a_pool, self.a_size)
                & self._whole(data, size, n_b, b, self.b_pool, self.b_size))
        a, b = a[np.repeat(good, n_a)], b[np.repeat(good, n_b)]
        n_a, n_b, size = n_a * good, n_b * good, size * good
        # a text with a bad stretch has no tokens
        bad = np.concatenate(([0], np.cumsum(~good[codes])))[offsets]
        stays = np.repeat(np.diff(bad) == 0, np.diff(offsets))
        before = np.concatenate(([0], np.cumsum(stays)))
        offsets, codes = before[offsets], codes[stays]

        end_a, end_b = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        cut = np.intersect1d(end_a, end_b, assume_unique=True)
        of_a, of_b = np.searchsorted(cut, end_a), np.searchsorted(cut, end_b)
        many_a, many_b = np.bincount(of_a, minlength=len(cut)), np.bincount(of_b, minlength=len(cut))
        unit = np.searchsorted(np.cumsum(size), cut)  # the stretch of each group
        n_groups = np.bincount(unit, minlength=len(units))
        n_links = np.bincount(unit, many_a * many_b, len(units)).astype(np.int64)
        starts, pairs, links = self._pairs(a, b, of_a, many_a, many_b, unit, len(units))
        return Stretches(offsets, codes, n_a, n_b, n_groups, n_links, self._texts(a, b, many_a, many_b, n_groups),
                         starts, pairs, links)

    def _texts(self, a, b, many_a, many_b, n_groups) -> pa.Array:
        def joined(parts: pa.Array, sizes: np.ndarray, mark: str) -> pa.Array:
            lists = pa.LargeListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes)))), parts)
            return pc.binary_join(lists, pa.scalar(mark, pa.large_string()))
        one, two = joined(self.a_text.take(pa.array(a)), many_a, ","), joined(self.b_text.take(pa.array(b)), many_b, ",")
        return joined(pc.binary_join_element_wise(one, two, pa.scalar("|", pa.large_string())), n_groups, ";")

    def _pairs(self, a, b, of_a, many_a, many_b, unit, n_units):
        wide = len(self.b_size)
        first_a, first_b = np.cumsum(many_a) - many_a, np.cumsum(many_b) - many_b
        plain = many_a * many_b <= PLAIN_GROUP
        times = np.where(plain, many_b, 0)[of_a]
        start = np.cumsum(times) - times
        at_b = np.arange(int(times.sum())) + np.repeat(first_b[of_a] - start, times)
        keys = [np.repeat(unit[of_a] * (len(self.a_size) * wide) + a * wide, times) + b[at_b]]
        links = [np.ones(len(keys[0]), np.int64)]
        for g in np.flatnonzero(~plain):
            ua, ca = np.unique(a[first_a[g]:first_a[g] + many_a[g]], return_counts=True)
            ub, cb = np.unique(b[first_b[g]:first_b[g] + many_b[g]], return_counts=True)
            keys.append((unit[g] * (len(self.a_size) * wide) + ua[:, None] * wide + ub).reshape(-1))
            links.append((ca[:, None] * cb).reshape(-1))
        keys, links = np.concatenate(keys), np.concatenate(links)
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        head = np.flatnonzero(np.diff(keys, prepend=-1))
        links = np.add.reduceat(links[order], head) if len(head) else links
        owner, pairs = np.divmod(keys[head], len(self.a_size) * wide)
        return np.searchsorted(owner, np.arange(n_units + 1)), pairs, links


@lru_cache(maxsize=2)
def _aligner(a_json: str, b_model: bytes) -> Aligner:
    return Aligner(a_json, b_model)


def _spread(starts: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all entries of the lists ``which`` one after the other, and their numbers."""
    size = starts[which + 1] - starts[which]
    first = np.cumsum(size) - size
    return np.repeat(starts[which] - first, size) + np.arange(int(size.sum())), size


def document_pairs(s: Stretches) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of a block, how many of its texts hold each, and the place of each of ``s.pairs`` among them."""
    known, place = np.unique(s.pairs, return_inverse=True)
    count, step = np.zeros(len(known), np.int64), max(1, HELD_AT_ONCE // max(len(known), 1))
    for a in range(0, len(s.offsets) - 1, step):
        cut = s.offsets[a:a + step + 1]
        at, size = _spread(s.starts, s.codes[cut[0]:cut[-1]])
        held = np.zeros((len(cut) - 1, len(known)), bool)
        held[np.repeat(np.repeat(np.arange(len(cut) - 1), np.diff(cut)), size), place[at]] = True
        count += held.sum(axis=0)
    # a pair only in stretches of texts without tokens has no count
    alive = count > 0
    return known[alive], count[alive], np.where(alive, np.cumsum(alive) - 1, -1)[place]


def _by_bucket(pairs: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the pairs by bucket, then value, and where each bucket starts."""
    bucket = (W.mix(pairs.astype(np.uint64)) >> np.uint64(32)).astype(np.int64) * buckets >> 32
    order = np.lexsort((pairs, bucket))
    return order, np.searchsorted(bucket[order], np.arange(buckets + 1))


# --- the passes -------------------------------------------------------------------------

class Alignment:
    """Both passes over ``df``. ``index``: the written table of the buckets' hashes, keys and counts."""

    def __init__(self, df: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text"):
        spark = df.sparkSession
        prepare(spark)
        with open(a_path, encoding="utf-8") as f, open(b_path, "rb") as g:  # vocabularies, so of bounded size
            self.files = spark.sparkContext.broadcast((f.read(), g.read()))
        self.names, self.columns = dict(doc_id=id_col, text=text_col), df.columns
        rows = carry(df, **self.names)
        self.blocks = X.block_count(rows)
        self.buckets = min(MOST_BUCKETS, -(-self.blocks // BUCKET_BLOCKS))
        # rows go round, so equal rows are spread
        block = F.pmod(F.monotonically_increasing_id(), F.lit(self.blocks)).cast("int")
        self.docs = rows.withColumn("block", block).repartitionById(self.blocks, F.col("block"))
        a = _aligner(*self.files.value)
        self.b_ids, self.pairs = len(a.b_size), len(a.a_size) * len(a.b_size)
        # small beside the texts, and read by the counting and by the answers
        self.messages = materialize(self.docs.groupBy("block").applyInArrow(self._send(), _MESSAGE), "pair-messages")
        self.index = self._count()

    def _send(self):
        files, buckets = self.files, self.buckets

        def send(tab: pa.Table) -> pa.Table:
            s = _aligner(*files.value).align(W.as_texts(tab.column("text")))
            pairs, count, _ = document_pairs(s)
            order, cut = _by_bucket(pairs, buckets)
            pairs, count, block = pairs[order].astype(np.uint64), count[order], tab.column("block")[0].as_py()
            rows = [(block, int(k), block // FAN_IN, int(cut[k + 1] - cut[k]), X.pack_sorted(pairs[cut[k]:cut[k + 1]]),
                     X.pack_counts(count[cut[k]:cut[k + 1]])) for k in np.flatnonzero(np.diff(cut))]
            return _rows(rows, _MESSAGE)
        return send

    def _count(self) -> DataFrame:
        def add_up(tab: pa.Table) -> pa.Table:
            keys, inverse = np.unique(np.concatenate([k for k, _ in _sparse(tab)]), return_inverse=True)
            count = np.bincount(inverse, np.concatenate([c for _, c in _sparse(tab)])).astype(np.uint64)
            row = (-1, tab.column("bucket")[0].as_py(), tab.column("lane")[0].as_py(), len(keys), X.pack_sorted(keys),
                   X.pack_counts(count))
            return _rows([row], _MESSAGE)

        def root(tab: pa.Table) -> pa.Table:
            lanes = list(_sparse(tab))
            keys = np.unique(np.concatenate([k for k, _ in lanes]))
            hashed = PerfectHash.of(keys)
            by_slot = np.empty_like(keys)
            by_slot[hashed.slots(keys)] = keys

            def dense(lane):
                out = np.zeros(len(keys), np.uint64)
                out[hashed.slots(lane[0])] = lane[1]
                return out
            total = tree_sum([tree_sum([dense(x) for x in lanes[i:i + 8]]) for i in range(0, len(lanes), 8)])
            row = (tab.column("bucket")[0].as_py(), len(keys), hashed.tobytes(), X.pack(by_slot), X.pack(total))
            return _rows([row], _INDEX)

        sums, lanes = self.messages, -(-self.blocks // FAN_IN)
        sums = sums.groupBy("bucket", "lane").applyInArrow(add_up, _MESSAGE)
        while lanes > FAN_IN:
            lanes = -(-lanes // FAN_IN)
            sums = sums.withColumn("lane", F.floor(F.col("lane") / FAN_IN).cast("int"))
            sums = sums.groupBy("bucket", "lane").applyInArrow(add_up, _MESSAGE)
        return materialize(sums.groupBy("bucket").applyInArrow(root, _INDEX), "pair-index")

    def pair_counts(self) -> DataFrame:
        """(a, b, n): documents that hold the ids linked."""
        wide = self.b_ids

        def read(batches):
            for batch in batches:
                for k in range(batch.num_rows):
                    n = batch.column("n")[k].as_py()
                    a, b = np.divmod(X.unpack(batch.column("keys")[k].as_py(), n).astype(np.int64), wide)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(a), pa.array(b), pa.array(X.unpack(batch.column("counts")[k].as_py(), n).astype(np.int64))],
                        ["a", "b", "n"])
        return self.index.mapInArrow(read, "a long, b long, n long")

    def best_counts(self) -> np.ndarray:
        """The highest count of each id of the first tokenizer (one number per vocabulary entry)."""
        wide, size = self.b_ids, self.pairs // self.b_ids

        def read(batches):
            for batch in batches:
                for k in range(batch.num_rows):
                    n, best = batch.column("n")[k].as_py(), np.zeros(size, np.int64)
                    a = X.unpack(batch.column("keys")[k].as_py(), n).astype(np.int64) // wide
                    np.maximum.at(best, a, X.unpack(batch.column("counts")[k].as_py(), n).astype(np.int64))
                    own = np.flatnonzero(best)
                    yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(best[own])], ["a", "n"])
        out = np.zeros(size, np.int64)
        for r in self.index.mapInArrow(read, "a long, n long").groupBy("a").agg(F.max("n").alias("n")).toLocalIterator():
            out[r["a"]] = r["n"]
        return out

    def documents(self, digests: bool = False) -> DataFrame:
        """The rows with n_a, n_b, n_groups, n_links, n_best, count_sum (long) and groups (string); with ``digests``
        groups_sha256 instead of the groups and the text."""
        files, buckets, b_ids = self.files, self.buckets, self.b_ids
        best = self.docs.sparkSession.sparkContext.broadcast(self.best_counts())  # one number per vocabulary entry
        lanes = -(-self.blocks // FAN_IN)

        def answer(tab: pa.Table, index: pa.Table) -> pa.Table:
            if not tab.num_rows:
                return _rows([], _ANSWER)
            n = index.column("n")[0].as_py()
            hashed = PerfectHash.frombytes(index.column("hash")[0].as_py())
            by_slot, counts = (X.unpack(index.column(c)[0].as_py(), n) for c in ("keys", "counts"))
            rows = []
            for block, bucket, k, keys in zip(*(tab.column(c).to_pylist() for c in ("block", "bucket", "n", "keys"))):
                keys = X.unpack_sorted(keys, k)
                slots = hashed.slots(keys)
                if (slots < 0).any() or (by_slot[slots] != keys).any():
                    raise RuntimeError(f"bucket {bucket} does not know all pairs of block {block}")
                rows.append((block, bucket, k, X.pack_counts(counts[slots])))
            return _rows(rows, _ANSWER)

        names = ["doc_id", "rest"] if digests else ["doc_id", "text", "rest"]
        last = "groups_sha256" if digests else "groups"

        def finish(tab: pa.Table, answers: pa.Table) -> pa.Table:
            s = _aligner(*files.value).align(W.as_texts(tab.column("text")))
            pairs, _, place = document_pairs(s)
            order, _ = _by_bucket(pairs, buckets)
            answers = answers.sort_by("bucket")
            told = [X.unpack_counts(c, n) for c, n in zip(answers.column("counts").to_pylist(), answers.column("n").to_pylist())]
            count = np.empty(len(pairs), np.int64)
            count[order] = np.concatenate(told) if told else []
            of_pair = np.append(count, 0)[place]
            at_best = s.links * (of_pair == best.value[s.pairs // b_ids])
            per_unit = [s.n_a, s.n_b, s.n_groups, s.n_links, _sums(at_best, s.starts), _sums(s.links * of_pair, s.starts)]
            cols = [_sums(u[s.codes], s.offsets) for u in per_unit]
            lists = pa.LargeListArray.from_arrays(pa.array(s.offsets), s.groups.take(pa.array(s.codes)))
            texts = pc.binary_join(lists, pa.scalar(";", pa.large_string()))
            if digests:
                texts = pa.array([sha256(t.encode()).hexdigest() if t else "" for t in texts.to_pylist()], pa.string())
            return table(**{c: tab.column(c) for c in names}, **dict(zip(_NUMBERS, cols)), **{last: texts.cast(pa.string())})

        index = self.index.withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))))
        answers = (self.messages.groupBy("bucket", "lane").cogroup(index.groupBy("bucket", "lane"))
                   .applyInArrow(answer, _ANSWER).repartitionById(self.blocks, F.col("block")))
        added = {**dict.fromkeys(_NUMBERS, "long"), last: "string"}
        done = self.docs.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
            finish, schema_of(self.docs, *names, **added))
        columns = [c for c in self.columns if not digests or c != self.names["text"]]
        return restore(done, columns, list(added), **{n: self.names[n] for n in names if n != "rest"})


_NUMBERS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of each run of ``values``."""
    before = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return before[offsets[1:]] - before[offsets[:-1]]


def _rows(rows: list[tuple], schema: str) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    names, types = zip(*(f.split() for f in schema.split(", ")))
    return pa.table([pa.array(c, kinds[t]) for c, t in zip(list(zip(*rows)) or [[]] * len(names), types)], names=list(names))


def _sparse(tab: pa.Table):
    for n, keys, counts in zip(*(tab.column(c).to_pylist() for c in ("n", "keys", "counts"))):
        yield X.unpack_sorted(keys, n), X.unpack_counts(counts, n)


def align_tokenizers(df: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
                     digests: bool = False) -> DataFrame:
    """See ``Alignment.documents``."""
    return Alignment(df, a_path, b_path, id_col, text_col).documents(digests)


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    import public_tokenizers
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return align_tokenizers(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"),
                            digests=True)
