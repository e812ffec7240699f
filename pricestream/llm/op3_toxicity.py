"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents of the training rows are the positives; a sample of all training
documents, whatever their label, is the unlabelled set. With the class prior p (the share of toxic
rows among the labelled training rows) the risk of a linear classifier g is

    p * E_pos[l(g)] + max(0, E_unl[l(-g)] - p * E_pos[l(-g)]),   l(z) = log(1 + exp(-z))

so documents labelled "not toxic" are never needed as such. Where the second term of a minibatch
would be negative, the step goes back along its gradient (Kiryo et al., 2017).

Inputs of a score are the words of the text only: lower-cased, cut to their letters, hashed
to a fixed number of features, present or not. The classifier is fitted with numpy on the
driver on at most ``MAX_POSITIVE`` and ``MAX_UNLABELLED`` rows, those with the smallest hashes of id, text
and place in the table, so the rows of a repeated or null id are drawn one by one (positives: rows of at
most about ``MAX_POSITIVE`` confirmed ids, chosen by a hash of the id); its weights, 2^18 floats, go to the tasks, which score every
whole text without a shuffle.

Edge cases: null and empty texts have no features and get the bias's score. Several labels of one
id count as toxic if one is. Null ids are training rows that no label names. Without any
confirmed toxic row every score is 0. An empty table gives an empty result.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricestream.llm import words as W
from pricestream.llm.frames import carry, prepare, restore, schema_of
from pricestream.sources.tables import read_table

FEATURES = 1 << 18
#: Bounds of the training sample; what is drawn of the rows before the smallest hashes are taken, as a multiple.
MAX_POSITIVE, MAX_UNLABELLED = 4000, 12000
DRAWN = 1.2
THRESHOLD = 0.3
FOLDS, HELD_OUT_FOLD = 4, 2
EPOCHS, BATCHES, RATE, DECAY, MIN_DOCS, MIN_Z, SEED = 40, 10, 0.05, 4e-4, 8, 4.0, 7


class Model(NamedTuple):
    weights: np.ndarray
    bias: float
    prior: float


def word_features(vocab: pa.Array) -> np.ndarray:
    """Feature of every word, -1 if it has no letter."""
    letters = pc.utf8_lower(pc.replace_substring_regex(vocab, r"^[^\pL]+|[^\pL]+$", ""))
    out = (W.word_hashes(letters, 3) % np.uint64(FEATURES)).astype(np.int64)
    out[pc.equal(letters, "").to_numpy(zero_copy_only=False)] = -1
    return out


def presence(w: W.Words, feature: np.ndarray, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, feature) pairs, only those with ``wanted[feature]`` if given."""
    use = feature >= 0
    if wanted is not None:
        use &= wanted[feature]
    at = np.flatnonzero(use[w.codes]) if len(w.codes) else np.zeros(0, np.int64)
    pair = np.unique(W.doc_of(w.offsets)[at] * FEATURES + feature[w.codes[at]])
    return pair // FEATURES, pair % FEATURES


def held_out(id_col: str = "doc_id", folds: int = FOLDS, fold: int = HELD_OUT_FOLD) -> F.col:
    """Whether crc32 of the id as text (null: empty) is ``fold`` modulo ``folds``."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % folds == fold


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return np.exp(-np.logaddexp(0, -z))


def _telling(flat: np.ndarray, in_positive: np.ndarray, n_pos: int, n_unl: int) -> np.ndarray:
    """Features whose shares of positives and of unlabelled documents differ by MIN_Z standard
    errors; words of a few documents are noise that a linear model would learn by heart."""
    a = np.bincount(flat[in_positive], minlength=FEATURES)
    b = np.bincount(flat[~in_positive], minlength=FEATURES)
    share = (a + b + 1) / (n_pos + n_unl + 2)
    error = np.sqrt(share * (1 - share) * (1 / max(n_pos, 1) + 1 / max(n_unl, 1)))
    return (np.abs(a / max(n_pos, 1) - b / max(n_unl, 1)) >= MIN_Z * error) & (a + b >= MIN_DOCS)


def fit(docs: list[np.ndarray], positive: np.ndarray, prior: float) -> Model:
    """Minibatch Adam on the non-negative risk. ``docs`` are feature arrays."""
    size = np.array([len(d) for d in docs])
    flat = np.concatenate(docs) if len(docs) else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(docs)), size)
    keep = _telling(flat, positive[owner], int(positive.sum()), int((~positive).sum()))[flat]
    owner = owner[keep]
    flat = flat[keep]
    size = np.bincount(owner, minlength=len(docs))
    first = np.cumsum(size) - size
    weights, bias = np.zeros(FEATURES), np.log(prior / (1 - prior))
    m, v, mb, vb, t = np.zeros(FEATURES), np.zeros(FEATURES), 0.0, 0.0, 0
    rng = np.random.default_rng(SEED)
    pos, unl = np.flatnonzero(positive), np.flatnonzero(~positive)
    for _ in range(EPOCHS):
        for p, u in zip(np.array_split(rng.permutation(pos), BATCHES), np.array_split(rng.permutation(unl), BATCHES)):
            if not len(p) or not len(u):
                continue
            rows = np.concatenate((p, u))
            count = size[rows]
            row = np.repeat(np.arange(len(rows)), count)
            cols = flat[np.repeat(first[rows] - (np.cumsum(count) - count), count) + np.arange(count.sum())]
            z = np.bincount(row, weights[cols], minlength=len(rows)) + bias
            zp, zu = z[:len(p)], z[len(p):]
            negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
            toward = np.concatenate((-prior * _sigmoid(zp) / len(p), _sigmoid(zu) / len(u)))
            if negative >= 0:
                g = toward
                g[:len(p)] -= prior * _sigmoid(-zp) / len(p)
            else:
                g = -toward
            gw = np.bincount(cols, g[row], minlength=FEATURES) + DECAY * weights
            gb, t = g.sum(), t + 1
            m, v = 0.9 * m + 0.1 * gw, 0.999 * v + 0.001 * gw * gw
            mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
            c1, c2 = 1 - 0.9 ** t, 1 - 0.999 ** t
            weights -= RATE * (m / c1) / (np.sqrt(v / c2) + 1e-8)
            bias -= RATE * (mb / c1) / (np.sqrt(vb / c2) + 1e-8)
    return Model(weights, float(bias), prior)


def _share(count: int, most: int) -> F.col:
    """Condition that holds for about ``most`` of ``count`` rows, by a hash of the id."""
    return F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(1_000_000)) < int(1e6 * min(1.0, most / max(count, 1)))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic") -> Model:
    """Fits the classifier on the training rows' confirmed toxic and unlabelled texts."""
    prepare(docs.sparkSession)
    docs = carry(docs, doc_id=id_col, text=text_col).select("doc_id", "text").filter(~held_out())
    labels = (labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).alias("toxic"))
              .filter(F.col("doc_id").isNotNull() & ~held_out())
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    n, n_toxic = labels.agg(F.count("toxic"), F.count(F.when(F.col("toxic") == 1, 1))).first()
    n_docs = docs.count()
    if not n_toxic or not n_docs:
        return Model(np.zeros(FEATURES), -np.inf, 0.0)
    # at most about MAX_POSITIVE ids
    confirmed = F.broadcast(labels.filter((F.col("toxic") == 1) & _share(n_toxic, MAX_POSITIVE)).select("doc_id"))
    # the place keeps equal rows apart
    docs = docs.withColumn("pick", F.xxhash64(F.lit(SEED), "doc_id", "text", F.monotonically_increasing_id()))
    toxic = docs.join(confirmed, "doc_id")

    def features(batches):
        for batch in batches:
            for part in W.slices(batch, "text"):
                w = W.split_words(W.as_texts(part.column("text")))
                doc, feature = presence(w, word_features(w.vocab))
                ends = np.searchsorted(doc, np.arange(part.num_rows + 1))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(feature.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("pick"), lists],
                                                 ["doc_id", "pick", "features"])

    def draw(rows: DataFrame, count: int, most: int) -> DataFrame:
        """``most`` rows at most: those with the smallest picks."""
        some = rows.filter(F.pmod("pick", F.lit(1 << 32)) < int((1 << 32) * min(1.0, DRAWN * most / max(count, 1))))
        some = some.select("doc_id", "text", "pick").mapInArrow(features, "doc_id long, pick long, features array<int>")
        return some.orderBy(F.pmod("pick", F.lit(1 << 32)), "pick").limit(most)

    rows = draw(toxic, toxic.count(), MAX_POSITIVE).withColumn("positive", F.lit(True)).union(
        draw(docs, n_docs, MAX_UNLABELLED).withColumn("positive", F.lit(False))).toArrow()
    rows = rows.sort_by([("positive", "ascending"), ("doc_id", "ascending"), ("pick", "ascending")])
    lists = [np.asarray(x.values) for x in rows.column("features")]
    prior = min(max(n_toxic / n, 1e-4), 0.9)
    return fit(lists, rows.column("positive").to_numpy(), prior)


def score_toxicity(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
                   keep_text: bool = True) -> DataFrame:
    """``df`` and score (double) and predicted (int)."""
    columns = [c for c in df.columns if keep_text or c != text_col]
    rows = carry(df, doc_id=id_col, text=text_col)
    names = ["doc_id", "text", "rest"] if keep_text else ["doc_id", "rest"]
    data = df.sparkSession.sparkContext.broadcast(model)  # FEATURES floats
    prepare(df.sparkSession)

    def score(batches):
        weights, bias, _ = data.value
        wanted = weights != 0
        for batch in batches:
            for part in W.slices(batch, "text"):
                w = W.split_words(W.as_texts(part.column("text")))
                doc, feature = presence(w, word_features(w.vocab), wanted)
                z = np.bincount(doc, weights[feature], minlength=part.num_rows) + bias
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in names], pa.array(_sigmoid(z))], [*names, "score"])

    done = rows.mapInArrow(score, schema_of(rows, *names, score="double"))
    done = done.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
    return restore(done, columns, ["score", "predicted"], doc_id=id_col, **({"text": text_col} if keep_text else {}))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, read_table(spark, sf_dir, "labels"))
    return score_toxicity(docs, model, keep_text=False).select("doc_id", held_out().alias("held_out"), "score", "predicted")
