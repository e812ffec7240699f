"""BPE encoding and decoding with a tokenization automaton.

The merges are compiled into a deterministic automaton over tokens whose paths are exactly
the token sequences that BPE produces. It starts as one state with a loop for every byte.
Merges are added in order of rank, each by one gadget: for the rule (u, v), the
state s that u leads to is copied without its arc v, all u-arcs now lead to the copy, and
every state that has an arc u gets an arc uv to where s's arc v led. A token's arcs all
lead to one state, and a copy differs from its original by one missing arc, so the
table holds, per state, its original, the missing token and the rule that made it.
An arc uv exists in a state that is as old as the rule exactly if arc u does.

Encoding: the text is split as the tokenizer does; each distinct piece of a task's batch is
run through the table once, at each place longest arc label first. A prefix has at most
one accepting path, so a place that turned out dead is never entered again. Decoding
emits the labels (bytes) of the arcs and reads them as UTF-8, replacing what is invalid.

The vocabulary file is a parameter (``path``); it is read by the driver, and the compiled
tables (their size is the vocabulary's) go to the tasks in the closure.

Edge cases: null and empty texts have no tokens and decode to the empty string. Strings of
added special tokens become their ids, as in the library. An empty table gives an empty result.
"""

from __future__ import annotations

import json
from functools import lru_cache
from hashlib import sha256
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession

from pricestream.llm import words as W
from pricestream.llm.frames import carry, prepare, restore, schema_of
from pricestream.sources.tables import read_table

#: Fixed value: how byte-level tokenizers split a text before the merges.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Pieces a worker remembers; beyond that its memory starts anew.
REMEMBERED = 400_000


def byte_characters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: printable Latin-1
    bytes stand for themselves, the others follow from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class Vocabulary(NamedTuple):
    labels: list[bytes]  # bytes of every id
    merges: list[tuple[int, int, int]]  # left, right, merged, in order of rank
    added: dict[str, int]


def read_vocabulary(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, byte_of = spec["model"], {c: b for b, c in enumerate(byte_characters())}
    if model.get("end_of_word_suffix") or model.get("continuing_subword_prefix") or model.get("ignore_merges"):
        raise ValueError("a byte-level BPE without affixes is needed")
    added = {t["content"]: t["id"] for t in spec["added_tokens"]}
    labels = [b""] * (max([*model["vocab"].values(), *added.values()]) + 1)
    for token, i in model["vocab"].items():
        labels[i] = bytes(byte_of[c] for c in token)
    for token, i in added.items():
        labels[i] = token.encode()
    merges = []
    for rule in model["merges"]:
        u, v = rule.split(" ") if isinstance(rule, str) else rule
        merges.append((model["vocab"][u], model["vocab"][v], model["vocab"][u + v]))
    return Vocabulary(labels, merges, added)


class Automaton:
    """States 0..: ``original``, ``missing`` and ``born`` (rank of the rule that made the
    state, -1 for the start); per token ``leads_to``, ``rank`` (-1 for bytes) and ``left``;
    rules that found no arc to act on have no effect."""

    def __init__(self, vocabulary: Vocabulary):
        n = len(vocabulary.labels)
        self.labels = vocabulary.labels
        self.original, self.missing, self.born = [0], [-1], [-1]
        self.leads_to, self.left = [0] * n, [-1] * n
        self.rank = [-2] * n
        for i, label in enumerate(self.labels):
            if len(label) == 1:
                self.rank[i] = -1
        for k, (u, v, merged) in enumerate(vocabulary.merges):
            if self.rank[merged] != -2 or -2 in (self.rank[u], self.rank[v]):
                continue  # made by an earlier rule already, or of a part that none makes
            s = self.leads_to[u]
            if not self.has_arc(s, v):
                continue  # u and v never stand side by side
            to = self.leads_to[v]
            self.original.append(s)
            self.missing.append(v)
            self.born.append(k)
            self.leads_to[u] = len(self.original) - 1
            self.rank[merged], self.left[merged] = k, u
            self.leads_to[merged] = to
        self.trie: dict[int, int] = {}
        self.token_at: list[int] = [-1]
        for token, label in enumerate(self.labels):
            if self.rank[token] == -2:
                continue
            node = 0
            for byte in label:
                key = node << 8 | byte
                node = self.trie.get(key) or self._grow(key)
            self.token_at[node] = token
        self.arcs: dict[int, bool] = {}

    def _grow(self, key: int) -> int:
        self.token_at.append(-1)
        self.trie[key] = len(self.token_at) - 1
        return self.trie[key]

    def has_arc(self, state: int, token: int) -> bool:
        original, missing, born, rank = self.original, self.missing, self.born, self.rank
        while True:
            r = rank[token]
            while born[state] > r:
                if missing[state] == token:
                    return False
                state = original[state]
            if r < 0:
                return True
            token = self.left[token]

    def encode_piece(self, piece: bytes) -> list[int]:
        """Labels of the one path that spells ``piece``."""
        trie, token_at, arcs, leads_to, size = self.trie, self.token_at, self.arcs, self.leads_to, len(self.leads_to)
        end, at, state = len(piece), 0, 0
        dead, path, open_ = set(), [], []
        while at < end:
            # arcs whose label continues the piece here, the longest last
            node, found = 0, []
            for i in range(at, end):
                node = trie.get(node << 8 | piece[i])
                if node is None:
                    break
                if token_at[node] >= 0:
                    found.append((token_at[node], i + 1))
            while True:
                while found:
                    token, to = found.pop()
                    if to in dead:
                        continue
                    key = state * size + token
                    ok = arcs.get(key)
                    if ok is None:
                        ok = arcs[key] = self.has_arc(state, token)
                    if ok:
                        break
                else:
                    # no arc leads on from this place: go back one arc
                    dead.add(at)
                    if not path:
                        raise ValueError("no path spells this piece")
                    path.pop()
                    at, state, found = open_.pop()
                    continue
                break
            open_.append((at, state, found))
            path.append(token)
            at, state = to, leads_to[token]
        return path


@lru_cache(maxsize=2)
def _automaton(data: str) -> Automaton:
    labels, merges, added = json.loads(data)
    return Automaton(Vocabulary([bytes.fromhex(x) for x in labels], [tuple(m) for m in merges], added))


def _shipped(vocabulary: Vocabulary) -> str:
    return json.dumps([[x.hex() for x in vocabulary.labels], vocabulary.merges, vocabulary.added])


class Emitter:
    """Writes one byte string per id for whole arrays of ids."""

    def __init__(self, strings: list[bytes]):
        self.size = np.array([len(s) for s in strings], np.int64)
        self.start = np.concatenate(([0], np.cumsum(self.size)))[:-1]
        self.pool = np.frombuffer(b"".join(strings), np.uint8)

    def __call__(self, ids: np.ndarray) -> np.ndarray:
        size = self.size[ids]
        shift = np.repeat(self.start[ids] - (np.cumsum(size) - size), size)
        return self.pool[shift + np.arange(len(shift))]


#: White space next to a space or line break, or at either end: the split pattern does not cut
#: such a text at every space. (Fixed set: Unicode white space.)
_SPACE = r"\s\v\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_ODD = rf"[{_SPACE}][ \n]|[ \n][{_SPACE}]|^[ \n]|[ \n]$"


class Coder:
    """Encodes and decodes Arrow arrays of texts."""

    def __init__(self, automaton: Automaton, added: dict[str, int]):
        self.automaton, self.added = automaton, added
        self.split = regex.compile(SPLIT)
        self.special = regex.compile("|".join(
            regex.escape(t, special_only=True) for t in sorted(added, key=len, reverse=True)) or r"(?!)")
        self.known: dict[str, list[int]] = {}
        self.labels = Emitter(automaton.labels)
        self.decimal = Emitter([b"%d," % i for i in range(len(automaton.labels))])

    def _encode(self, text: str) -> list[int]:
        out, known = [], self.known
        for piece in self.split.findall(text):
            ids = known.get(piece)
            if ids is None:
                if len(known) >= REMEMBERED:
                    known.clear()
                ids = known[piece] = self.automaton.encode_piece(piece.encode())
            out += ids
        return out

    def _whole(self, text: str) -> list[int]:
        out, at = [], 0
        for m in self.special.finditer(text):
            out += self._encode(text[at:m.start()])
            out.append(self.added[m.group()])
            at = m.end()
        return out + self._encode(text[at:])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Offsets and ids. A single space or line break between two other characters always
        starts a piece, so texts are cut there into units and each distinct unit is
        encoded once; other texts are encoded whole."""
        n = len(texts)
        odd = pc.match_substring_regex(texts, _ODD)
        for token in self.added:
            odd = pc.or_(odd, pc.match_substring(texts, token))
        odd = odd.to_numpy(zero_copy_only=False)
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        off = np.asarray(lists.offsets).astype(np.int64)
        flat = lists.values.slice(off[0], off[-1] - off[0]).dictionary_encode()
        off = off - off[0]
        code, units = np.asarray(flat.indices).astype(np.int64), flat.dictionary
        head = off[:-1]
        used = np.repeat(~odd, np.diff(off))
        used[head] = False
        needed = np.bincount(code[used], minlength=len(units)) > 0
        entries = [self._encode(u if u[:1] == "\n" else " " + u) if need else []
                   for u, need in zip(units.to_pylist(), needed.tolist())]
        firsts = units.take(pa.array(code[head])).to_pylist()
        entries += [self._whole(texts[i].as_py()) if odd[i] else self._encode(firsts[i]) for i in range(n)]
        code[head] = len(units) + np.arange(n)
        used[head] = True
        size = np.array([len(e) for e in entries], np.int64)
        pool = np.fromiter((i for e in entries for i in e), np.int32, int(size.sum()))
        start = np.cumsum(size) - size
        total = np.concatenate(([0], np.cumsum(np.where(used, size[code], 0))))
        code = code[used]
        count = size[code]
        at = np.repeat(start[code] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
        return total[off], pool[at]

    def emit(self, strings: Emitter, offsets: np.ndarray, ids: np.ndarray) -> list[bytes]:
        """The strings of each text's ids, joined."""
        data = strings(ids).tobytes()
        ends = np.concatenate(([0], np.cumsum(strings.size[ids])))[offsets].tolist()
        return [data[a:b] for a, b in zip(ends, ends[1:])]

    def decode(self, offsets: np.ndarray, ids: np.ndarray) -> list[str]:
        return [b.decode("utf-8", "replace") for b in self.emit(self.labels, offsets, ids)]


@lru_cache(maxsize=2)
def _coder(data: str) -> Coder:
    labels, merges, added = json.loads(data)
    vocabulary = Vocabulary([bytes.fromhex(x) for x in labels], [tuple(m) for m in merges], added)
    return Coder(Automaton(vocabulary), added)


def _shipped(path: str) -> str:
    v = read_vocabulary(path)
    return json.dumps([[x.hex() for x in v.labels], v.merges, v.added])


def bpe_encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
               digests: bool = False) -> DataFrame:
    """``df`` and the column ids (array of int); with ``digests`` instead of ids and text
    n_tokens (long), ids_sha256 and decoded_sha256 of the ids and of the text decoded from them."""
    columns = [c for c in df.columns if not digests or c != text_col]
    rows = carry(df, doc_id=id_col, text=text_col)
    names = ["doc_id", "rest"] if digests else ["doc_id", "text", "rest"]
    data = df.sparkSession.sparkContext.broadcast(_shipped(path))
    prepare(df.sparkSession)

    def run(batches):
        coder = _coder(data.value)
        for batch in batches:
            for part in W.slices(batch, "text", 8 << 20):
                offsets, ids = coder.encode(W.as_texts(part.column("text")))
                keep = [part.column(c) for c in names]
                if digests:
                    lists = coder.emit(coder.decimal, offsets, ids)
                    out = {"n_tokens": pa.array(np.diff(offsets)),
                           "ids_sha256": pa.array([sha256(x[:-1]).hexdigest() for x in lists], pa.string()),
                           "decoded_sha256": pa.array([sha256(t.encode()).hexdigest()
                                                       for t in coder.decode(offsets, ids)], pa.string())}
                else:
                    out = {"ids": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids))}
                yield pa.RecordBatch.from_arrays([*keep, *out.values()], [*names, *out])

    added = {"n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"} if digests else {"ids": "array<int>"}
    done = rows.mapInArrow(run, schema_of(rows, *names, **added))
    return restore(done, columns, list(added), doc_id=id_col, **({} if digests else {"text": text_col}))


def bpe_decode(df: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """``df`` and the column decoded (string) of its ids (null: empty)."""
    rows = carry(df, ids=ids_col)
    data = df.sparkSession.sparkContext.broadcast(_shipped(path))
    prepare(df.sparkSession)

    def run(batches):
        coder = _coder(data.value)
        for batch in batches:
            lists = pc.fill_null(batch.column("ids"), pa.scalar([], batch.column("ids").type))
            offsets = np.asarray(lists.offsets).astype(np.int64)
            ids = np.asarray(lists.values)[offsets[0]:offsets[-1]]
            text = coder.decode(offsets - offsets[0], ids)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(text, pa.string())], ["ids", "rest", "decoded"])

    done = rows.mapInArrow(run, schema_of(rows, "ids", "rest", decoded="string"))
    return restore(done, df.columns, ["decoded"], ids=ids_col)


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    import public_tokenizers
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe_encode(docs, public_tokenizers.path("byte_bpe_50k.json"), digests=True)
