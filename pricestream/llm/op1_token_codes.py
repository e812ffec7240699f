"""Token ids of all documents as directly addressable codes.

Ids are cut into 8-bit chunks. Level 0 holds the lowest chunk of every id, level k the
k-th chunk of those ids that have one; a bitmap per level marks where an id continues, and a
rank directory (ones before every 512th bit) turns a place of one level into the place
on the next. So any token is read with one directory entry and one partial popcount a level; no
block is decoded.

File format: a folder ``segments`` of Parquet files (the container; uncompressed), one row
per segment of whole documents in ascending order of id: part, segment, start (tokens of the part
before it), n_tokens, doc_ids, doc_ends, and levels (chunks, bitmap, directory); and a
folder ``parts`` with the tokens before each part. Parts are ranges of ids, so a global place is
base of the part + start + place in the segment.

Texts are encoded with the tokenizers library. For tokenizers that drop white space before
anything else joins (checked in the vocabulary file), each distinct word of a task's batch
is encoded once; words of Latin letters are given to the library many at a time and
told apart by the word-end mark.

Edge cases: a null or empty text is the end id alone. Null ids come first; rows of equal
ids are ordered by a hash of the text. An empty table writes an empty file.
"""

from __future__ import annotations

import json
import uuid
import zlib
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricestream.llm import exchange as X
from pricestream.llm import words as W
from pricestream.llm.frames import carry, prepare
from pricestream.session import checkpoint_dir
from pricestream.sources.tables import read_table

END_ID = 1
#: Text bytes of a part, tokens of a segment (more if one document has more).
PART_BYTES, SEGMENT_TOKENS = 16 << 20, 1 << 18
DIRECTORY_BITS = 512
#: Words a worker remembers; beyond that its memory starts anew. Words given to the library at once.
REMEMBERED, TOGETHER = 400_000, 2000

_LATIN = r"^[A-Za-zÀ-ÖØ-öø-ÿ]+[.,]?$"
_POPCOUNT = np.array([bin(i).count("1") for i in range(256)], np.uint8)


class Codes:
    """Directly addressable codes of one array of ids."""

    def __init__(self, levels: list[tuple[bytes, bytes, bytes]]):
        self.chunks = [np.frombuffer(c, np.uint8) for c, _, _ in levels]
        self.bitmap = [np.frombuffer(b, np.uint8) for _, b, _ in levels]
        self.directory = [np.frombuffer(d, np.uint32) for _, _, d in levels]

    @staticmethod
    def levels_of(ids: np.ndarray) -> list[tuple[bytes, bytes, bytes]]:
        rest, out = ids.astype(np.uint64), []
        while len(rest) or not out:
            more = rest >= 256
            bits = np.zeros(-(-max(len(rest), 1) // DIRECTORY_BITS) * DIRECTORY_BITS, bool)
            bits[:len(rest)] = more
            ones = bits.reshape(-1, DIRECTORY_BITS).sum(axis=1)
            directory = (np.cumsum(ones) - ones).astype(np.uint32)
            packed = np.packbits(bits[:len(rest)], bitorder="little").tobytes()
            out.append(((rest & np.uint64(255)).astype(np.uint8).tobytes(), packed, directory.tobytes()))
            rest = rest[more] >> np.uint64(8)
        return out

    def access(self, places: np.ndarray) -> np.ndarray:
        """The ids at any places."""
        at = np.asarray(places, np.int64)
        who, out = np.arange(len(at)), np.zeros(len(at), np.int64)
        for k, chunks in enumerate(self.chunks):
            if not len(at):
                break
            out[who] |= chunks[at].astype(np.int64) << (8 * k)
            bitmap = self.bitmap[k]
            on = (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
            at, who = at[on], who[on]
            at = self._rank(k, at)
        return out

    def _rank(self, k: int, at: np.ndarray) -> np.ndarray:
        """Ones before each place: the directory entry and the popcount of the bits after it."""
        bitmap, block, size = self.bitmap[k], at // DIRECTORY_BITS, DIRECTORY_BITS // 8
        if len(at) * size < 4 * len(bitmap):
            lanes = block[:, None] * size + np.arange(size)
            inside = lanes < (at >> 3)[:, None]
            partial = (_POPCOUNT[bitmap[np.minimum(lanes, len(bitmap) - 1)]] * inside).sum(axis=1, dtype=np.int64)
        else:  # many places: popcounts of the bytes of each block, summed once
            pad = np.zeros(-(-len(bitmap) // size) * size, np.int64)
            pad[:len(bitmap)] = _POPCOUNT[bitmap]
            before = pad.reshape(-1, size).cumsum(axis=1) - pad.reshape(-1, size)
            partial = before.reshape(-1)[at >> 3]
        last = _POPCOUNT[bitmap[at >> 3] & ((1 << (at & 7)) - 1).astype(np.uint8)]
        return self.directory[k][block].astype(np.int64) + partial + last.astype(np.int64)


def _drops_white_space(spec: dict) -> bool:
    """Whether a text's ids are those of its words one after the other: the normalizer
    neither joins nor splits across ASCII white space, and the first split removes it."""
    normalizers = (spec.get("normalizer") or {}).get("normalizers", [spec.get("normalizer")])
    plain = all(n is None or n["type"] in ("NFC", "Lowercase") or (
        n["type"] == "Replace" and n["pattern"] == {"Regex": r"\s+"} and n["content"] == " ") for n in normalizers)
    pre = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])[0]
    return (plain and pre.get("type") == "Split" and pre.get("behavior") == "Removed" and pre.get("invert") is True
            and r"[^\s" in (pre.get("pattern") or {}).get("Regex", "") and spec["model"].get("end_of_word_suffix") is not None
            and not any(t.get("lstrip") or t.get("rstrip") for t in spec["added_tokens"]))


class LibraryEncoder:
    """Ids of whole texts, as the tokenizers library gives them without special tokens."""

    def __init__(self, data: str):
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(data)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        spec = json.loads(data)
        self.by_word = _drops_white_space(spec)
        if self.by_word:
            suffix, vocab = spec["model"]["end_of_word_suffix"], spec["model"]["vocab"]
            self.ends = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)
            self.ends[[i for t, i in vocab.items() if t.endswith(suffix)]] = True
            self.mark = {m: ids[0] for m, ids in zip(".,", self._ids([".", ","])) if len(ids) == 1}
            self.known: dict[str, list[int]] = {}

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Offsets and ids."""
        if not self.by_word:
            lists = self._ids(texts.to_pylist())
            offsets = np.cumsum([0, *map(len, lists)])
            return offsets, np.fromiter((i for x in lists for i in x), np.int32, int(offsets[-1]))
        w = W.split_words(texts)
        start, size, pool = self._words(w.vocab)
        count = size[w.codes] if len(w.codes) else np.zeros(0, np.int64)
        total = np.concatenate(([0], np.cumsum(count)))
        # places in 32 bits where they fit: half the memory to move
        kind = np.int32 if max(total[-1], len(pool)) < 1 << 31 else np.int64
        at = np.repeat((start[w.codes] - total[:-1]).astype(kind), count)
        at += np.arange(total[-1], dtype=kind)
        return total[w.offsets], pool[at]

    def lengths(self, texts: pa.Array) -> np.ndarray:
        """The number of ids of each text; the ids themselves are not laid out."""
        if not self.by_word:
            return np.diff(self(texts)[0])
        w = W.split_words(texts)
        size = self._sizes(w.vocab)
        total = np.concatenate(([0], np.cumsum(size[w.codes] if len(w.codes) else [], dtype=np.int64)))
        return np.diff(total[w.offsets])

    def _sizes(self, vocab: pa.Array) -> np.ndarray:
        code, marks, entries = self._entries(vocab)
        return np.fromiter(map(len, entries), np.int64, len(entries))[code] + (marks > 0)

    def _entries(self, vocab: pa.Array) -> tuple[np.ndarray, np.ndarray, list[list[int]]]:
        """For every word the number of its core and the id of its mark plus 1 (0: none); and the ids of the cores."""
        latin = pc.match_substring_regex(vocab, _LATIN)
        lower = pc.if_else(latin, pc.utf8_lower(vocab), vocab)
        # a word of Latin letters and one mark after it is encoded without the mark
        cores = pc.if_else(latin, pc.utf8_rtrim(lower, ".,"), lower)
        marks = np.zeros(len(vocab), np.int64)
        for m, i in self.mark.items():
            marks[pc.and_(latin, pc.ends_with(lower, m)).to_numpy(zero_copy_only=False)] = i + 1
        cores = cores.dictionary_encode()
        code, plain = np.asarray(cores.indices), np.zeros(len(cores.dictionary), bool)
        plain[code[latin.to_numpy(zero_copy_only=False)]] = True
        return code, marks, self._cores(cores.dictionary.to_pylist(), plain.tolist())

    def _words(self, vocab: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of every word, as start and size in a pool."""
        code, marks, entries = self._entries(vocab)
        core_size = np.array([len(e) for e in entries], np.int64)
        core_pool = np.fromiter(chain.from_iterable(entries), np.int32, int(core_size.sum()))
        core_start = np.cumsum(core_size) - core_size
        marked = marks > 0
        size = core_size[code] + marked
        start = np.cumsum(size) - size
        at = np.repeat(core_start[code] - start, size) + np.arange(int(size.sum()))
        pool = core_pool[np.minimum(at, len(core_pool) - 1)] if len(core_pool) else np.zeros(0, np.int32)
        pool[(start + size - 1)[marked]] = marks[marked] - 1
        return start, size, pool

    def _cores(self, cores: list[str], plain: list[bool]) -> list[list[int]]:
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        fast = [c for c, p in zip(cores, plain) if p and c not in known]
        slow = [c for c, p in zip(cores, plain) if not p and c not in known]
        for i in range(0, len(fast), TOGETHER):
            group = fast[i:i + TOGETHER]
            flat = self._ids([" ".join(group)])[0]
            cut = (np.flatnonzero(self.ends[np.array(flat)]) + 1).tolist()
            if len(cut) != len(group):  # a word of several pieces
                known.update(zip(group, self._ids(group)))
                continue
            known.update(zip(group, map(flat.__getitem__, map(slice, [0, *cut[:-1]], cut))))
        known.update(zip(slow, self._ids(slow)))
        return list(map(known.__getitem__, cores))


@lru_cache(maxsize=2)
def encoder(data: str) -> LibraryEncoder:
    return LibraryEncoder(data)


_SEGMENT = ("part int, segment int, start long, n_tokens long, doc_ids array<long>, doc_ends array<long>, "
            "levels array<struct<chunks: binary, bitmap: binary, directory: binary>>")


def write_tokens(df: DataFrame, tokenizer: str, path: str, id_col: str = "doc_id", text_col: str = "text",
                 end_id: int = END_ID) -> None:
    """Writes the ids of all texts of ``df``, each followed by ``end_id``, to ``path``."""
    spark = df.sparkSession
    with open(tokenizer, encoding="utf-8") as f:  # a vocabulary, so of bounded size
        data = spark.sparkContext.broadcast(f.read())
    prepare(spark)
    docs = carry(df, doc_id=id_col, text=text_col).select("doc_id", "text")
    n = X.block_count(docs, block_bytes=PART_BYTES)
    order = [F.asc_nulls_first("doc_id"), F.xxhash64("text")]
    docs = docs.repartitionByRange(n, *order).sortWithinPartitions(*order)

    def encode(batches):
        from pyspark import TaskContext
        part, number, start = TaskContext.get().partitionId(), 0, 0
        encode_texts = encoder(data.value)
        ids, docs_, ends, held = [], [], [], 0

        def segment():
            flat = np.concatenate(ids)
            levels = [dict(zip(("chunks", "bitmap", "directory"), x)) for x in Codes.levels_of(flat)]
            return pa.RecordBatch.from_pylist([{
                "part": part, "segment": number, "start": start, "n_tokens": len(flat), "doc_ids": docs_,
                "doc_ends": ends, "levels": levels}], schema=arrow)

        for batch in batches:
            for piece in W.slices(batch, "text", 8 << 20):
                offsets, flat = encode_texts(W.as_texts(piece.column("text")))
                flat = np.insert(flat, offsets[1:], end_id)
                offsets = offsets + np.arange(len(offsets))
                doc_ids = piece.column("doc_id").to_pylist()
                a = 0
                while a < len(doc_ids):
                    b = min(max(a + 1, int(np.searchsorted(offsets, offsets[a] + SEGMENT_TOKENS - held, "right")) - 1), len(doc_ids))
                    ids.append(flat[offsets[a]:offsets[b]])
                    docs_ += doc_ids[a:b]
                    ends += (offsets[a + 1:b + 1] - offsets[a] + held).tolist()
                    held += int(offsets[b] - offsets[a])
                    a = b
                    if held >= SEGMENT_TOKENS or a < len(doc_ids):
                        yield segment()
                        number, start = number + 1, start + held
                        ids, docs_, ends, held = [], [], [], 0
        if docs_:
            yield segment()

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string
    arrow = to_arrow_schema(_parse_datatype_string(_SEGMENT))
    segments = docs.mapInArrow(encode, _SEGMENT)
    segments.write.option("compression", "none").mode("overwrite").parquet(f"{path}/segments")
    # one row per part
    totals = (spark.read.parquet(f"{path}/segments").groupBy("part").agg(F.sum("n_tokens").alias("n"))
              .orderBy("part").collect())
    bases, base = [], 0
    for row in totals:
        bases.append((row["part"], base, row["n"]))
        base += row["n"]
    spark.createDataFrame(bases, "part int, base long, n_tokens long").coalesce(1).write.mode("overwrite").parquet(f"{path}/parts")


def _segments(spark: SparkSession, path: str) -> DataFrame:
    parts = spark.read.parquet(f"{path}/parts").select("part", "base")
    return spark.read.parquet(f"{path}/segments").join(parts, "part").withColumn("start", F.col("base") + F.col("start"))


def _codes(batch: pa.RecordBatch, i: int) -> Codes:
    return Codes([(x["chunks"], x["bitmap"], x["directory"]) for x in batch.column("levels")[i].as_py()])


def read_tokens(spark: SparkSession, path: str, digests: bool = False) -> DataFrame:
    """One row per document of the file: doc_id, start, n_tokens, and ids (array of long), or
    with ``digests`` ids_crc32 instead."""
    prepare(spark)
    kind = pa.int64() if digests else pa.list_(pa.int64())

    def read(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                codes, first = _codes(batch, i), batch.column("start")[i].as_py()
                ends = np.asarray(batch.column("doc_ends")[i].values).astype(np.int64)
                starts = np.concatenate(([0], ends[:-1]))
                ids = codes.access(np.arange(ends[-1]))
                if digests:
                    data = ids.astype("<u4").tobytes()
                    last = pa.array([zlib.crc32(data[4 * a:4 * b]) for a, b in zip(starts.tolist(), ends.tolist())], kind)
                else:
                    last = pa.ListArray.from_arrays(pa.array(np.append(starts, ends[-1]), pa.int32()), pa.array(ids))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_ids")[i].values, pa.array(first + starts), pa.array(ends - starts), last],
                    ["doc_id", "start", "n_tokens", name])

    name = "ids_crc32" if digests else "ids"
    return _segments(spark, path).mapInArrow(
        read, f"doc_id long, start long, n_tokens long, {name} {'long' if digests else 'array<long>'}")


def tokens_at(spark: SparkSession, path: str, places: list[int]) -> DataFrame:
    """(place, id) for the given global places, each read directly from its segment."""
    prepare(spark)
    wanted = np.unique(np.asarray(places, np.int64))

    def read(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                first, n = batch.column("start")[i].as_py(), batch.column("n_tokens")[i].as_py()
                own = wanted[np.searchsorted(wanted, first):np.searchsorted(wanted, first + n)]
                if len(own):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(own), pa.array(_codes(batch, i).access(own - first))], ["place", "id"])

    return _segments(spark, path).mapInArrow(read, "place long, id long")


def op1_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document, from the files: doc_id, start, n_tokens, ids_crc32."""
    import public_tokenizers
    path = f"{checkpoint_dir(spark).rstrip('/')}/token-codes-{uuid.uuid4().hex}"
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    write_tokens(docs, public_tokenizers.path("word_bpe_49k.json"), path)
    return read_tokens(spark, path, digests=True)
