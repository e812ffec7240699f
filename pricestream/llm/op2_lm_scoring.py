"""Language-model scoring with a weighted backoff automaton.

The model is a word trigram model with Dirichlet-smoothed levels,

    p3(c|ab) = (n(abc) + K3 p2(c|b)) / (n(ab) + K3),  p2(c|b) = (n(bc) + K2 p1(c)) / (n(b) + K2),
    p1(c)    = (n(c) + 0.5) / (N + 0.5 (V + 1)),

over the training documents, each closed by an end token; it sums to one over the vocabulary and one
unknown word. As an automaton, every context seen in training is a state, every n-gram seen an arc
with its log10 probability to the state of its longest suffix, and a state's failure arc
leads to the state without its first word with weight log10(K / (n(context) + K)).

The automaton of a large corpus fits no single task, but a block of documents only meets its own
n-grams. Blocks (see ``exchange``) send their distinct n-grams with their training counts;
buckets add these up over the corpus and answer with the totals (and their share of N and
V); each block then compiles the part of the automaton it needs and its documents run through
it, left to right, carrying the state and adding up weights. Many lanes run side by side:
a long text is cut into lanes of ``LANE`` tokens, and a lane starts two tokens early, which
is enough to be in the state that the whole text would be in.

Words and n-grams have 64-bit keys at every size.

Edge cases: a null or empty text is the end token alone. Null ids count as the empty text in the
fold rule, so they are training rows. Repeated rows count as often as they occur. Without any training row every
token has probability 1. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricestream.llm import exchange as X
from pricestream.llm import words as W
from pricestream.llm.frames import carry, prepare, restore, schema_of
from pricestream.sources.tables import read_table

FOLDS, HELD_OUT_FOLD = 5, 1
#: Prior weight of the lower order, for contexts of one and of two words.
K2, K3 = 1000.0, 10.0
LANE = 512
#: Hashes of the two marks that are no words.
START, END = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)

_MESSAGE = "block int, bucket int, payload binary"


def held_out(id_col: str = "doc_id") -> F.col:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % FOLDS == HELD_OUT_FOLD


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, a place of each, and the number of every key among them."""
    order = np.argsort(keys)
    ordered = keys[order]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = ordered[1:] != ordered[:-1]
    number = np.empty(len(keys), np.int64)
    number[order] = np.cumsum(fresh) - 1
    return ordered[fresh], order[fresh], number


class Tokens:
    """A block's token sequence: two start marks, the words and the end mark of each text. Without ``index`` only
    what the counts need."""

    def __init__(self, texts: pa.Array, train: np.ndarray, index: bool = True):
        w = W.split_words(pc.ascii_lower(texts))
        n = np.diff(w.offsets)
        self.offsets = w.offsets + 3 * np.arange(len(w.offsets))
        size = int(self.offsets[-1])
        # distinct words, and the place of each position's word among them
        self.words, number = np.unique(np.concatenate((W.word_hashes(w.vocab), np.array([START, END], np.uint64))),
                                       return_inverse=True)
        inner = np.ones(size, bool)
        inner[self.offsets[:-1]] = inner[self.offsets[:-1] + 1] = inner[self.offsets[1:] - 1] = False
        self.word_at = np.empty(size, np.int64)
        self.word_at[inner] = number[w.codes]
        self.word_at[self.offsets[:-1]] = self.word_at[self.offsets[:-1] + 1] = number[-2]
        self.word_at[self.offsets[1:] - 1] = number[-1]
        key = self.words[self.word_at]
        follows, self.real = np.ones(size, bool), np.ones(size, bool)
        follows[self.offsets[:-1]] = False
        self.real[self.offsets[:-1]] = self.real[self.offsets[:-1] + 1] = False
        self.train = np.repeat(train, n + 3)
        self.n_tokens = n + 1
        at2, at3 = np.flatnonzero(follows), np.flatnonzero(self.real)
        self._keys = np.concatenate((W.window_hashes(key, 2)[at2 - 1], W.window_hashes(key, 3)[at3 - 2]))
        self._where = np.concatenate((at2, at3))
        if index:
            self.grams, one, number = _distinct(self._keys)
            self.gram2_at, self.gram3_at = np.zeros(size, np.int64), np.zeros(size, np.int64)
            self.gram2_at[at2], self.gram3_at[at3] = number[:len(at2)], number[len(at2):]
            self.gram_position, self.gram_is3 = self._where[one], one >= len(at2)

    def word_counts(self) -> np.ndarray:
        return np.bincount(self.word_at[self.train & self.real], minlength=len(self.words))

    def gram_counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted distinct n-grams and their training counts."""
        train = self.train[self._where]
        seen = np.sort(self._keys[train])
        first = np.flatnonzero(np.diff(seen, prepend=~seen[:1]))
        n = np.diff(np.append(first, len(seen)))
        grams = np.sort(np.concatenate((seen[first], self._keys[~train])))
        grams = grams[np.diff(grams, prepend=~grams[:1]) != 0]
        count = np.zeros(len(grams), np.int64)
        count[np.searchsorted(grams, seen[first])] = n
        return grams, count


class Automaton:
    """States: 0 is the root, then one per word and one per word pair seen in training."""

    def __init__(self, t: Tokens, n1: np.ndarray, n_gram: np.ndarray, total: int, distinct: int):
        n_words = len(t.words)
        self.n_words = n_words
        denominator = total + 0.5 * (distinct + 1)
        p1 = (n1 + 0.5) / denominator if total else np.ones(n_words)
        self.unknown = np.log10(0.5 / denominator) if total else 0.0
        context1 = n1.astype(np.float64)
        start = np.searchsorted(t.words, START)
        pair_start = t.gram2_at[1]
        context1[start] = n_gram[pair_start]  # as many as training texts
        seen1 = context1 > 0
        self.state1 = np.where(seen1, np.cumsum(seen1), 0)
        seen = n_gram > 0
        pair = np.flatnonzero(~t.gram_is3 & seen)
        state2 = np.zeros(len(t.grams), np.int64)
        state2[pair] = 1 + seen1.sum() + np.arange(len(pair))
        b, c = t.word_at[t.gram_position[pair] - 1], t.word_at[t.gram_position[pair]]
        p2 = np.ones(len(t.grams))
        p2[pair] = (n_gram[pair] + K2 * p1[c]) / (context1[b] + K2)
        triple = np.flatnonzero(t.gram_is3 & seen)
        at = t.gram_position[triple]
        history, suffix, last = t.gram2_at[at - 1], t.gram2_at[at], t.word_at[at]
        p3 = (n_gram[triple] + K3 * p2[suffix]) / (n_gram[history] + K3)
        word = np.flatnonzero(n1 > 0)
        source = np.concatenate((np.zeros(len(word), np.int64), self.state1[b], state2[history]))
        label = np.concatenate((word, c, last))
        target = np.concatenate((self.state1[word], state2[pair], state2[suffix]))
        weight = np.log10(np.concatenate((p1[word], p2[pair], p3)))
        key = source * n_words + label
        order = np.argsort(key)
        self.arc, self.target, self.weight = key[order], target[order], weight[order]
        if not len(self.arc):
            self.arc, self.target, self.weight = np.array([-1]), np.zeros(1, np.int64), np.zeros(1)
        self.fail = np.concatenate(([0], np.zeros(seen1.sum(), np.int64), self.state1[c]))
        self.fail_weight = np.log10(np.concatenate((
            [1.0], K2 / (context1[seen1] + K2), K3 / (n_gram[pair] + K3))))
        self.start = int(state2[pair_start])

    def run(self, words: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One token for every lane: log10 probabilities and next states."""
        out, to = np.zeros(len(words)), np.zeros(len(words), np.int64)
        lane = np.arange(len(words))
        while len(lane):
            key = state * self.n_words + words
            at = np.minimum(np.searchsorted(self.arc, key), len(self.arc) - 1)
            hit = self.arc[at] == key
            done = lane[hit]
            out[done] += self.weight[at[hit]]
            to[done] = self.target[at[hit]]
            lane, state, words = lane[~hit], state[~hit], words[~hit]
            root = state == 0
            out[lane[root]] += self.unknown
            lane, state, words = lane[~root], state[~root], words[~root]
            out[lane] += self.fail_weight[state]
            state = self.fail[state]
        return out, to


def traverse(t: Tokens, automaton: Automaton) -> np.ndarray:
    """log10 probability of every text."""
    cuts = -(-t.n_tokens // LANE)
    doc = np.repeat(np.arange(len(cuts)), cuts)
    number = np.arange(len(doc)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
    begin = t.offsets[doc] + 2 + number * LANE
    end = np.minimum(begin + LANE, t.offsets[doc + 1])
    # first lanes start after the start marks, the others warm up on two tokens
    state = np.where(number == 0, automaton.start, 0)
    for k in (2, 1):
        later = np.flatnonzero(number > 0)
        _, state[later] = automaton.run(t.word_at[begin[later] - k], state[later])
    order = np.argsort(begin - end, kind="stable")
    at, end, state, total = begin[order], end[order], state[order], np.zeros(len(doc))
    size = end - at
    for k in range(int(size[0]) if len(size) else 0):
        n = int(np.searchsorted(-size, -k, "left"))  # lanes longer than k
        weight, state[:n] = automaton.run(t.word_at[at[:n] + k], state[:n])
        total[:n] += weight
    return np.bincount(doc[order], total, minlength=len(cuts))


def lm_scores(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """``df`` and held_out, n_tokens, n_known, train_tokens, base_score, score."""
    prepare(df.sparkSession)
    columns = [c for c in df.columns if keep_text or c != text_col]
    base = carry(df, doc_id=id_col, text=text_col).withColumn("held_out", held_out())
    n = X.block_count(base)
    by_block = X.packed_blocks(base.withColumn("deal", F.xxhash64("doc_id", "text")), "deal", n).groupBy("block")
    names = [c for c in ("doc_id", "text", "rest") if keep_text or c != "text"]

    def tokens(tab: pa.Table, index: bool) -> Tokens:
        train = ~tab.column("held_out").combine_chunks().to_numpy(zero_copy_only=False)
        return Tokens(W.as_texts(tab.column("text")), train, index)

    def rows(data: list[tuple]) -> pa.Table:
        cols = list(zip(*data)) or [[], [], []]
        kinds = {"block": pa.int32(), "bucket": pa.int32(), "payload": pa.binary()}
        return pa.table({k: pa.array(c, t) for (k, t), c in zip(kinds.items(), cols)})

    def send(tab: pa.Table) -> pa.Table:
        block, t = tab.column("block")[0].as_py(), tokens(X.unpacked(tab.column("payload")), index=False)
        c1, (grams, cg) = t.word_counts(), t.gram_counts()
        cut1, cutg, out = X.bucket_bounds(t.words, n), X.bucket_bounds(grams, n), []
        for b in range(n):
            one, gram = slice(cut1[b], cut1[b + 1]), slice(cutg[b], cutg[b + 1])
            out.append((block, b, X.join_fields(
                int(cut1[b + 1] - cut1[b]).to_bytes(8, "little"), X.pack_sorted(t.words[one]), X.pack_counts(c1[one]),
                int(cutg[b + 1] - cutg[b]).to_bytes(8, "little"), X.pack_sorted(grams[gram]), X.pack_counts(cg[gram]))))
        return rows(out)

    def add_up(tab: pa.Table) -> pa.Table:
        fields = [X.split_fields(p.as_py()) for p in tab.column("payload")]
        answers, share = [], b""
        for f in (0, 3):
            count = [int.from_bytes(x[f], "little") for x in fields]
            keys = np.concatenate([X.unpack_sorted(x[f + 1], k) for x, k in zip(fields, count)])
            own = np.concatenate([X.unpack_counts(x[f + 2], k) for x, k in zip(fields, count)])
            _, inverse = np.unique(keys, return_inverse=True)
            total = np.bincount(inverse, own).astype(np.uint64)
            if f == 0:
                share = int(total.sum()).to_bytes(8, "little") + int((total > 0).sum()).to_bytes(8, "little")
            cut = np.cumsum([0, *count])
            answers.append([X.pack_counts(total[inverse[a:b]]) for a, b in zip(cut, cut[1:])])
        out = [(block, bucket, X.join_fields(share, a, g)) for block, bucket, a, g in zip(
            tab.column("block").to_pylist(), tab.column("bucket").to_pylist(), *answers)]
        return rows(out)

    def score(tab: pa.Table, answers: pa.Table) -> pa.Table:
        tab = X.unpacked(tab.column("payload"))
        t = tokens(tab, index=True)
        cut1, cutg = X.bucket_bounds(t.words, n), X.bucket_bounds(t.grams, n)
        n1, n_gram, total, distinct = np.zeros(len(t.words), np.int64), np.zeros(len(t.grams), np.int64), 0, 0
        got = answers.to_pydict()
        for b, payload in zip(got["bucket"], got["payload"]):
            share, a, g = X.split_fields(payload)
            total += int.from_bytes(share[:8], "little")
            distinct += int.from_bytes(share[8:], "little")
            n1[cut1[b]:cut1[b + 1]] = X.unpack_counts(a, int(cut1[b + 1] - cut1[b]))
            n_gram[cutg[b]:cutg[b + 1]] = X.unpack_counts(g, int(cutg[b + 1] - cutg[b]))
        if len(got["bucket"]) != n:
            raise RuntimeError(f"{len(got['bucket'])} of {n} buckets answered")
        automaton = Automaton(t, n1, n_gram, total, distinct)
        doc = W.doc_of(t.offsets)[t.real]
        c = n1[t.word_at[t.real]]
        base_p = np.log10((c + 0.5) / (total + 0.5 * (distinct + 1))) if total else np.zeros(len(c))
        m = tab.num_rows
        return pa.table([*[tab.column(x) for x in names], tab.column("held_out"), pa.array(t.n_tokens),
                         pa.array(np.bincount(doc, c > 0, minlength=m).astype(np.int64)),
                         pa.array(np.full(m, total, np.int64)), pa.array(np.bincount(doc, base_p, minlength=m)),
                         pa.array(traverse(t, automaton))], names=[*names, *added])

    added = {"held_out": "boolean", "n_tokens": "long", "n_known": "long", "train_tokens": "long",
             "base_score": "double", "score": "double"}
    totals = by_block.applyInArrow(send, _MESSAGE).groupBy("bucket").applyInArrow(add_up, _MESSAGE)
    done = by_block.cogroup(totals.groupBy("block")).applyInArrow(score, schema_of(base, *names, **added))
    return restore(done, columns, list(added), doc_id=id_col, **({"text": text_col} if keep_text else {}))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score
    (both rounded to six decimals, so that the order of addition does not show)."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    done = lm_scores(docs, keep_text=False)
    return done.withColumn("base_score", F.round("base_score", 6)).withColumn("score", F.round("score", 6))


#: The same sums in SQL (K2 = 1000, K3 = 10; one and two spaces stand for the end and start marks;
#: the first table is the usual CRC-32 table by its rule).
ORACLE = r"""
WITH tab AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i::BIGINT, range(8)), lambda c, k:
             xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)) AS v
    FROM (SELECT unnest(range(256)) AS i))),
d AS (
  SELECT doc_id, xor(list_reduce(list_prepend(4294967295::BIGINT,
             list_transform(string_split(coalesce(doc_id::VARCHAR, ''), ''), lambda x: ascii(x)::BIGINT)),
             lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295::BIGINT) % 5 = 1 AS held_out,
         list_append(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), ' ') AS w
  FROM documents, tab),
tok AS (SELECT doc_id, held_out, unnest(w) AS c, unnest(range(len(w))) AS i FROM d),
s AS (SELECT doc_id, held_out, c, coalesce(lag(c) OVER o, '  ') AS b, coalesce(lag(c, 2) OVER o, '  ') AS a
      FROM tok WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
one AS (SELECT c, count(*) AS n FROM s WHERE NOT held_out GROUP BY c),
two AS (SELECT b, c, count(*) AS n FROM s WHERE NOT held_out GROUP BY b, c),
three AS (SELECT a, b, c, count(*) AS n FROM s WHERE NOT held_out GROUP BY a, b, c),
docs AS (SELECT count(*) AS n FROM d WHERE NOT held_out),
context1 AS (SELECT c AS b, n FROM one UNION ALL SELECT '  ', n FROM docs),
context2 AS (SELECT b AS a, c AS b, n FROM two UNION ALL SELECT '  ', '  ', n FROM docs),
total AS (SELECT sum(n)::BIGINT AS n, count(*) AS v FROM one),
p AS (
  SELECT doc_id, held_out, coalesce(one.n, 0) AS n1, total.n AS train_tokens,
         (coalesce(one.n, 0) + 0.5::DOUBLE) / (total.n + 0.5::DOUBLE * (total.v + 1)) AS p1,
         coalesce(two.n, 0) AS n2, coalesce(context1.n, 0) AS m1, coalesce(three.n, 0) AS n3, coalesce(context2.n, 0) AS m2
  FROM s CROSS JOIN total LEFT JOIN one USING (c) LEFT JOIN two USING (b, c) LEFT JOIN context1 USING (b)
  LEFT JOIN three USING (a, b, c) LEFT JOIN context2 USING (a, b))
SELECT doc_id, held_out, count(*) AS n_tokens, count(*) FILTER (n1 > 0) AS n_known, train_tokens,
       round(sum(log10(p1)), 6) AS base_score,
       round(sum(log10((n3 + 10 * (n2 + 1000 * p1) / (m1 + 1000)) / (m2 + 10))), 6) AS score
FROM p GROUP BY doc_id, held_out, train_tokens
"""
