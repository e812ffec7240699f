"""Quality rules: base rules on word statistics, then robust multivariate outliers.

Statistics of a whole text: n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words.
Base rules fail a document with under ten words or with over a fifth of its words in
repeated 5-word windows. What passes is judged against the minimum-covariance-determinant
estimate of its language and source: of the transformed vector (log mean word length,
root of symbols per word, share of repeated lines, share of repeated words; each with
pseudo-counts so that short texts are not outliers by noise) concentration steps run from
several deterministic starts (quartile spreads; hyperbolic-tangent scores; spatial signs, the
latter two along their own axes with quartile scales), each keeps the closest three quarters of the
group, and the estimate of least determinant wins. A document is rejected when its squared
Mahalanobis distance exceeds the cutoff.

Each concentration step covers all rows: distances fall into fixed logarithmic bins,
(group, start, bin) sums of x and xx' are partially aggregated, and an estimate comes from its
nearest bins (of the last one a part, so that all starts fit equally many rows); a source with a third
of all rows is a few hundred aggregate rows. The scatter is regularised by a ridge per coordinate:
``RIDGE`` times the robust deviation inside the sources of the language, pooled (the median over the
language's rows, which a few bad sources do not move), but not less than the coordinate's floor; without it a group of copies or of texts without any symbol would have no
spread. Groups under ``MIN_GROUP`` rows use their language's estimate, languages under it the whole table's.

Edge cases: a null or empty text has no words (base_failed). Null language or source is a
group of its own. Repeated rows count as often as they occur and get equal verdicts. An empty table
gives an empty result.
"""

from __future__ import annotations

from math import exp, factorial

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricestream.llm import words as W
from pricestream.llm.frames import carry, prepare, restore, schema_of
from pricestream.session import materialize
from pricestream.sources.tables import read_table

SYMBOLS, MIN_WORDS, REPEAT_WINDOW, REPEAT_PERCENT = r"[#*$%&|<>]", 10, 5, 20
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Share of a group that the estimate is fitted to, rows below which a group is not fitted,
#: concentration steps, upper tail of the chi-square at the cutoff.
SUPPORT, MIN_GROUP, STEPS, TAIL = 0.75, 200, 6, 1e-5
#: Ridge as a multiple of the language's pooled robust deviation.
RIDGE = 2.0
#: Transformed coordinates and the floor of each one's ridge (standard deviation): the least deviation worth rejecting.
COORDINATES = (
    ("ln((word_chars + 100) / (n_words + 20))", 0.02),
    ("sqrt(n_symbols / (n_words + 20))", 0.08),
    ("n_dup_lines / (n_lines + 5)", 0.12),
    ("n_repeat_words / (n_words + 20)", 0.08),
)
_P = len(COORDINATES)
_PAIRS = [(i, j) for i in range(_P) for j in range(i, _P)]
#: Grid of the starting quantiles, of quantiles in units of a spread, bins per doubling of a distance.
GRID, UNIT_GRID, BINS = 512, 64, 8
#: Parts that a group is dealt into where estimates are joined to its rows.
SALTS = 32


def chi2_cdf(x: float, df: int) -> float:
    """Chi-square distribution function, even degrees of freedom."""
    return 1 - exp(-x / 2) * sum((x / 2) ** k / factorial(k) for k in range(df // 2))


def chi2_quantile(q: float, df: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, df) < q else (low, mid)
    return high


#: Makes the scatter of the closest SUPPORT of normal data consistent.
CONSISTENCY = SUPPORT / chi2_cdf(chi2_quantile(SUPPORT, _P), _P + 2)
CUTOFF = chi2_quantile(1 - TAIL, _P)


def text_stats(texts: pa.Array) -> dict[str, np.ndarray]:
    """STATS and n_lines (lines with a word) of every text."""
    w = W.split_words(texts)
    n = len(texts)
    doc = W.doc_of(w.offsets)
    per = lambda per_word: np.bincount(doc, per_word, minlength=n).astype(np.int64)
    chars = np.asarray(pc.utf8_length(w.vocab))[w.codes]
    symbols = np.asarray(pc.count_substring_regex(w.vocab, SYMBOLS))[w.codes]
    # windows found twice in one text: equal hashes of (window, text)
    inside = W.starts_in_one_text(w.offsets, REPEAT_WINDOW)
    repeat = np.zeros(len(w.codes) + 1, np.int64)
    if inside.any():
        at = np.flatnonzero(inside)
        key = W.window_hashes(W.word_hashes(w.vocab)[w.codes], REPEAT_WINDOW)[at]
        key = W.mix(key + doc[at].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(key), bool)
        twice[order[1:][same]] = twice[order[:-1][same]] = True
        np.add.at(repeat, at[twice], 1)
        np.add.at(repeat, at[twice] + REPEAT_WINDOW, -1)
    covered = np.cumsum(repeat)[:-1] > 0
    lists = pc.split_pattern(texts, "\n")
    off = np.asarray(lists.offsets).astype(np.int64)
    lines = lists.values.slice(off[0], off[-1] - off[0]).dictionary_encode()
    real = np.asarray(pc.match_substring_regex(lines.dictionary, r"[^\x20\x09-\x0D]").cast(pa.int8())).astype(bool)
    code = np.asarray(lines.indices).astype(np.int64)
    owner = np.repeat(np.arange(n), np.diff(off))
    keep = real[code] if len(code) else np.zeros(0, bool)
    n_lines = np.bincount(owner[keep], minlength=n)
    unique = np.unique(owner[keep] * (len(lines.dictionary) + 1) + code[keep])
    n_unique = np.bincount(unique // (len(lines.dictionary) + 1), minlength=n)
    return {"n_words": np.diff(w.offsets), "word_chars": per(chars), "n_symbols": per(symbols),
            "n_dup_lines": (n_lines - n_unique).astype(np.int64), "n_repeat_words": per(covered),
            "n_lines": n_lines.astype(np.int64)}


def with_stats(df: DataFrame, keep_text: bool = True) -> DataFrame:
    """Adds the statistics to a frame with a ``text`` column."""
    prepare(df.sparkSession)
    names = [c for c in df.columns if keep_text or c != "text"]
    extra = {k: "long" for k in (*STATS, "n_lines")}

    def add(batches):
        for batch in batches:
            for part in W.slices(batch, "text"):
                stats = text_stats(W.as_texts(part.column("text")))
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in names], *[pa.array(stats[k]) for k in extra]], [*names, *extra])

    return df.mapInArrow(add, schema_of(df, *names, **extra))


def _distance() -> str:
    """Squared Mahalanobis distance from params m0.., v00.. as SQL."""
    return " + ".join(f"{1 if i == j else 2} * v{i}{j} * (x{i} - m{i}) * (x{j} - m{j})" for i, j in _PAIRS)


_ALL = range(_P)
_FIT = ", ".join([*[f"m{i} double" for i in _ALL], *[f"v{i}{j} double" for i, j in _PAIRS]])
_PARAMS = f"grp string, start int, det double, {_FIT}"
_AXES = "grp string, start int, " + ", ".join(f"e{i}{k} double" for i in _ALL for k in _ALL)


def _symmetric(entry) -> np.ndarray:
    out = np.empty((_P, _P))
    for i, j in _PAIRS:
        out[i, j] = out[j, i] = entry(i, j)
    return out


def _params(grp: str, start: int, mean: np.ndarray, scatter: np.ndarray) -> dict:
    inv = np.linalg.inv(scatter)
    return ({"grp": grp, "start": start, "det": float(np.linalg.det(scatter))} | {f"m{i}": mean[i] for i in _ALL}
            | {f"v{i}{j}": inv[i, j] for i, j in _PAIRS})


def _ridge(row) -> np.ndarray:
    return np.diag([float(row[f"r{i}"]) ** 2 for i in _ALL])


def _solve(key: tuple, bins: pd.DataFrame) -> pd.DataFrame:
    """Location and inverse scatter of the nearest SUPPORT of a group's rows."""
    bins = bins.sort_values("bin")
    n = bins["n"].to_numpy(np.float64)
    total = SUPPORT * n.sum()
    weight = np.clip((total - (n.cumsum() - n)) / n, 0, 1)
    mean = np.array([(weight * bins[f"s{i}"]).sum() for i in _ALL]) / total
    cov = _symmetric(lambda i, j: (weight * bins[f"s{i}{j}"]).sum() / total - mean[i] * mean[j])
    return pd.DataFrame([_params(*key, mean, CONSISTENCY * cov + _ridge(bins.iloc[0]))])


def _axes(key: tuple, sums: pd.DataFrame) -> pd.DataFrame:
    """Principal axes of a group's tanh scores (start 1) and of its spatial signs (start 2)."""
    rows = []
    for start, name in ((1, "t"), (2, "u")):
        axes = np.linalg.eigh(_symmetric(lambda i, j: sums[f"{name}{i}{j}"].iloc[0]))[1]
        rows.append({"grp": key[0], "start": start} | {f"e{i}{k}": axes[i, k] for i in _ALL for k in _ALL})
    return pd.DataFrame(rows)


def _along_axes(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """A start whose scatter has the given axes and the quartile scales along them."""
    row = rows.iloc[0]
    axes = np.array([[row[f"e{i}{k}"] for k in _ALL] for i in _ALL])
    quart = np.array([row[f"p{k}"] for k in _ALL]) / UNIT_GRID
    unit = np.array([row[f"d{i}"] for i in _ALL])
    center = np.array([row[f"c{i}"] for i in _ALL]) + unit * (axes @ quart[:, 1])
    scatter = unit[:, None] * (axes * ((quart[:, 2] - quart[:, 0]) / 1.349) ** 2 @ axes.T) * unit
    return pd.DataFrame([_params(*key, center, scatter + _ridge(row))])


def _salted(params: DataFrame) -> DataFrame:
    """Params for each salt, so that a group with most of the rows is many join keys."""
    return params.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))


def _spreads(points: DataFrame, members: DataFrame, scales: DataFrame) -> DataFrame:
    """Per ``grp``: its medians c0.., ridges r0.. and units d0.. (root of squared quartile spread and ridge). ``members``
    (grp, of) has the groups whose robust deviations are pooled (median over rows) as the scale ``of``, ``scales`` (grp, of) the scale a group takes."""
    quart = points.groupBy("grp").agg(F.count("*").alias("n"), *[
        F.expr(f"percentile(round(x{i} * {GRID}), array(0.25, 0.5, 0.75))").alias(f"q{i}") for i in _ALL])
    quart = materialize(quart.select("grp", "n", *[F.expr(f"q{i}[1] / {GRID}").alias(f"c{i}") for i in _ALL],
                                     *[F.expr(f"pow((q{i}[2] - q{i}[0]) / {GRID} / 1.349, 2)").alias(f"w{i}") for i in _ALL]),
                        "quality-spreads")
    ridges = quart.join(members, "grp").groupBy("of").agg(*[
        F.expr(f"greatest({RIDGE}D * sqrt(percentile(w{i}, 0.5D, n)), {floor}D)").alias(f"r{i}")
        for i, (_, floor) in enumerate(COORDINATES)])
    units = [F.expr(f"sqrt(w{i} + r{i} * r{i})").alias(f"d{i}") for i in _ALL]
    return materialize(quart.join(scales, "grp").join(ridges, "of").select(
        "grp", *[f"{k}{i}" for k in "cr" for i in _ALL], *units), "quality-ridges")


def _starts(points: DataFrame, spreads: DataFrame) -> DataFrame:
    """Params of the three starts of each group."""
    plain = spreads.select(
        "grp", F.lit(0).alias("start"), F.expr(" * ".join(f"d{i} * d{i}" for i in _ALL)).alias("det"),
        *[F.col(f"c{i}").alias(f"m{i}") for i in _ALL],
        *[F.expr(f"1 / (d{i} * d{i})" if i == j else "0D").alias(f"v{i}{j}") for i, j in _PAIRS])
    scaled = points.join(_salted(spreads), ["grp", "salt"]).select(
        "grp", "salt", *[F.expr(f"(x{i} - c{i}) / d{i}").alias(f"z{i}") for i in _ALL])
    square = "greatest(" + " + ".join(f"z{i} * z{i}" for i in _ALL) + ", 1e-18)"
    sums = scaled.groupBy("grp").agg(
        *[F.sum(F.expr(f"tanh(z{i}) * tanh(z{j})")).alias(f"t{i}{j}") for i, j in _PAIRS],
        *[F.sum(F.expr(f"z{i} * z{j} / {square}")).alias(f"u{i}{j}") for i, j in _PAIRS])
    axes = materialize(sums.groupBy("grp").applyInPandas(_axes, _AXES), "mcd-axes")
    along = scaled.join(_salted(axes), ["grp", "salt"]).groupBy("grp", "start").agg(
        *[F.expr(f"percentile(round({UNIT_GRID} * (" + " + ".join(f"z{i} * e{i}{k}" for i in _ALL)
                 + ")), array(0.25, 0.5, 0.75))").alias(f"p{k}") for k in _ALL])
    along = along.join(axes, ["grp", "start"]).join(spreads, "grp")
    return plain.unionByName(along.groupBy("grp", "start").applyInPandas(_along_axes, _PARAMS))


def _estimates(points: DataFrame, members: DataFrame, scales: DataFrame) -> DataFrame:
    """Params per ``grp`` of ``points`` (grp, salt, x0..): concentration steps from every start, then the estimate
    of least determinant (the first start's of equal ones)."""
    spreads = _spreads(points, members, scales)
    params = materialize(_starts(points, spreads), "mcd-start")
    ridges = spreads.select("grp", *[f"r{i}" for i in _ALL])
    bin_ = f"cast(floor({BINS} * log2(greatest({_distance()}, 1e-9))) as int)"
    for _ in range(STEPS):
        sums = points.join(_salted(params), ["grp", "salt"]).withColumn("bin", F.expr(bin_)).groupBy("grp", "start", "bin").agg(
            F.count("*").alias("n"), *[F.sum(f"x{i}").alias(f"s{i}") for i in _ALL],
            *[F.sum(F.expr(f"x{i} * x{j}")).alias(f"s{i}{j}") for i, j in _PAIRS])
        params = materialize(sums.join(ridges, "grp").groupBy("grp", "start").applyInPandas(_solve, _PARAMS), "mcd-step")
    best = F.min_by(F.struct(*[c for c in params.columns if c != "grp"]), F.struct("det", "start")).alias("best")
    return params.groupBy("grp").agg(best).select("grp", "best.*")


def quality_verdicts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                     source_col: str = "source", keep_text: bool = True) -> DataFrame:
    """``df`` (without its text if not ``keep_text``) and STATS (long), base_failed and
    kept (boolean)."""
    columns = [c for c in df.columns if keep_text or c != text_col]
    base = carry(df, doc_id=id_col, text=text_col, lang=lang_col, source=source_col)
    rows = with_stats(base, keep_text).withColumn(
        "base_failed", F.expr(f"n_words < {MIN_WORDS} or 100 * n_repeat_words > {REPEAT_PERCENT} * n_words"))
    rows = rows.select("*", *[F.expr(e).alias(f"x{i}") for i, (e, _) in enumerate(COORDINATES)])
    rows = materialize(rows, "quality")
    fit = rows.filter("not base_failed").select(
        "lang", "source", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).alias("salt"), *[f"x{i}" for i in range(_P)])
    # null fields are left out of the JSON, so they differ from empty strings
    levels = [F.to_json(F.struct("lang", "source")), F.concat(F.lit("lang "), F.to_json(F.struct("lang"))), F.lit("all")]
    sizes = materialize(fit.groupBy("lang", "source").agg(F.count("*").alias("n")), "group-sizes")
    by_lang = sizes.groupBy("lang").agg(F.sum("n").alias("n_lang"))
    level = (sizes.withColumnRenamed("n", "n_group").join(by_lang.withColumnRenamed("lang", "lang_"),
             F.col("lang").eqNullSafe(F.col("lang_")))
             .select(levels[0].alias("exact"), F.when(F.col("n_group") >= MIN_GROUP, levels[0])
                     .when(F.col("n_lang") >= MIN_GROUP, levels[1]).otherwise(levels[2]).alias("grp")))
    points = fit.select(F.explode(F.array(*levels)).alias("grp"), "salt", *[f"x{i}" for i in range(_P)])
    # a group's ridge comes from all groups of its language, the whole table's from all
    of_lang = sizes.select(levels[0].alias("grp"), levels[1].alias("of"))
    whole = F.lit("all").alias("of")
    members = of_lang.unionByName(of_lang.select("grp", whole))
    scales = of_lang.unionByName(of_lang.select(F.col("of").alias("grp"), "of").distinct()).unionByName(
        of_lang.limit(1).select(F.lit("all").alias("grp"), whole))
    params = level.join(_estimates(points, members, scales), "grp").drop("grp", "start", "det")
    judged = rows.withColumn("exact", levels[0]).join(params, "exact", "left")
    judged = judged.withColumn("kept", F.expr(f"not base_failed and coalesce({_distance()} <= {CUTOFF}D, false)"))
    return restore(judged, columns, [*STATS, "base_failed", "kept"],
                   doc_id=id_col, lang=lang_col, source=source_col, **({"text": text_col} if keep_text else {}))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: doc_id, the statistics, base_failed, kept."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return quality_verdicts(docs, keep_text=False).drop("lang", "source")
