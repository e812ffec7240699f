"""Each operator against brute force on a small table with every edge case."""

import collections
import hashlib
import itertools
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pytest
import xxhash

public_tokenizers = pytest.importorskip("public_tokenizers")

from pyspark.sql import functions as F  # noqa: E402

from pricestream.llm import exchange  # noqa: E402
from pricestream.llm import op10_bpe as bpe  # noqa: E402
from pricestream.llm import op1_token_codes as codes  # noqa: E402
from pricestream.llm import op2_lm_scoring as lm  # noqa: E402
from pricestream.llm import op3_toxicity as toxicity  # noqa: E402
from pricestream.llm import op4_best_fit_packing as packing  # noqa: E402
from pricestream.llm import op5_substring_dedup as substring  # noqa: E402
from pricestream.llm import op6_html_extraction as html  # noqa: E402
from pricestream.llm import op7_fingerprints as lcp  # noqa: E402
from pricestream.llm import op8_simhash_dedup as simhash  # noqa: E402
from pricestream.llm import op9_quality_rules as quality  # noqa: E402
from pricestream.llm import words as W  # noqa: E402
from llm.conftest import CLASHES, SCHEMA, edge_rows, words  # noqa: E402

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))


def test_words():
    texts = pa.array([" a  b\x0bc\x1cd ", None, "", "x\ny z"])
    w = W.split_words(W.as_texts(texts))
    assert w.offsets.tolist() == [0, 3, 3, 3, 6]
    assert [w.vocab[int(c)].as_py() for c in w.codes] == ["a", "b", "c\x1cd", "x", "y", "z"]


def test_parts_of_arrays():
    texts = ["Ärger One", None, "", "ÉTÉ Two three FOUR", "ß 日本 X", "last ONE é"] * 3
    for kind in (pa.string(), pa.large_string()):
        whole = pa.array(texts, kind)
        batch = pa.RecordBatch.from_arrays([whole], ["text"])
        for a, b in ((0, 18), (3, 5), (7, 11), (16, 2)):
            part = W.as_texts(batch.slice(a, b).column("text"))
            low = pa.compute.ascii_lower(part)
            assert low.to_pylist() == [(t or "").translate(LOWER) for t in texts[a:a + b]]
            assert (simhash.fingerprint(part) == [brute_fingerprint(t) for t in texts[a:a + b]]).all()
        cut = [p.num_rows for p in W.slices(batch, "text", 20)]
        assert sum(cut) == 18 and len(cut) > 3


# 1 ------------------------------------------------------------------------------------

def test_codes_random_access():
    rng = np.random.default_rng(0)
    for high in (10, 300, 70_000, 2 ** 31):
        ids = rng.integers(0, high, 5000)
        c = codes.Codes(codes.Codes.levels_of(ids))
        some = rng.integers(0, 5000, 7)
        assert (c.access(some) == ids[some]).all() and (c.access(np.arange(5000)) == ids).all()
    assert len(codes.Codes(codes.Codes.levels_of(np.zeros(0, int))).access([])) == 0


def test_token_files(spark, edge, empty, tmp_dir):
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    codes.write_tokens(edge, path, f"{tmp_dir}/t")
    got = {(r.doc_id, tuple(r.ids)): r for r in codes.read_tokens(spark, f"{tmp_dir}/t").collect()}
    tk = Tokenizer.from_file(path)
    rows = edge_rows()
    expected = collections.Counter((i, (*tk.encode(t or "", add_special_tokens=False).ids, 1)) for i, t, _, _ in rows)
    assert set(got) == set(expected)
    all_rows = sorted(codes.read_tokens(spark, f"{tmp_dir}/t").collect(), key=lambda r: r.start)
    assert collections.Counter((r.doc_id, tuple(r.ids)) for r in all_rows) == expected
    assert [r.start for r in all_rows] == np.cumsum([0, *[r.n_tokens for r in all_rows]])[:-1].tolist()
    ids = [r.doc_id for r in all_rows]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    flat = [x for r in all_rows for x in r.ids]
    places = [0, 5, len(flat) - 1]
    assert {r.place: r.id for r in codes.tokens_at(spark, f"{tmp_dir}/t", places).collect()} == {p: flat[p] for p in places}
    codes.write_tokens(empty, path, f"{tmp_dir}/e")
    assert codes.read_tokens(spark, f"{tmp_dir}/e").count() == 0


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_library_encoder(name):

    from tokenizers import Tokenizer
    path = public_tokenizers.path(name)
    with open(path, encoding="utf-8") as f:
        encode = codes.LibraryEncoder(f.read())
    rng = random.Random(1)
    parts = [" ", "\n", "  ", "a", "The", "'s", "'T", "123", "é", "É", "İ", "Σ", "日本", "\t", "\x1c", "!!", "<|endoftext|>",
             "<|ENDOFTEXT|>", "\r\n", "ing", "😀", "　", "́", "\x85", "\v", ".", ",", "ß", "ẞ"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(800)]
    offsets, ids = encode(pa.array(texts, pa.large_string()))
    tk = Tokenizer.from_file(path)
    for k, e in enumerate(tk.encode_batch(texts, add_special_tokens=False)):
        assert ids[offsets[k]:offsets[k + 1]].tolist() == e.ids, texts[k]


# 2 ------------------------------------------------------------------------------------

def test_lm_scores(edge, empty):
    data = [(i, t, zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1,
             words((t or "").translate(LOWER)) + ["\0"]) for i, t, _, _ in edge_rows()]
    one, two, three, n = collections.Counter(), collections.Counter(), collections.Counter(), 0
    for _, _, out, w in data:
        if not out:
            n += 1
            one.update(w)
            two.update(zip(["<s>"] + w, w))
            three.update(zip(["<s>", "<s>"] + w, ["<s>"] + w, w))
    total, distinct = sum(one.values()), len(one)
    context = dict(one) | {"<s>": n}
    two["<s>", "<s>"] = n
    expected = []
    for i, t, out, w in data:
        a, b, score, base = "<s>", "<s>", 0.0, 0.0
        for c in w:
            p1 = (one[c] + 0.5) / (total + 0.5 * (distinct + 1))
            p2 = (two[b, c] + lm.K2 * p1) / (context.get(b, 0) + lm.K2)
            p3 = (three[a, b, c] + lm.K3 * p2) / (two[a, b] + lm.K3)
            score, base, a, b = score + math.log10(p3), base + math.log10(p1), b, c
        expected.append((i, out, len(w), sum(one[c] > 0 for c in w), total, round(base, 3), round(score, 3)))
    done = lm.lm_scores(edge)
    assert [c for c in done.columns if c not in ("held_out", "score", "n_tokens", "n_known", "train_tokens", "base_score")] == [
        c for c in edge.columns if c not in ("held_out", "score")]
    got = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 3), round(r.score, 3))
           for r in done.collect()]
    assert ordered(sorted(got, key=str)) == ordered(sorted(expected, key=str))
    assert lm.lm_scores(empty).count() == 0


def test_packed_blocks_keep_rows_and_spread_copies(spark):
    """Copies that are a third of a table and more fill no block, and every row comes back whole."""
    rows = [(i, f"text {i}") for i in range(3000)] + [(7, "one text")] * 6000
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(4).withColumn(
        "deal", F.xxhash64("doc_id", "text"))
    blocks = exchange.packed_blocks(table, "deal", 16).collect()
    got, size = [], collections.Counter()
    for r in blocks:
        t = exchange.unpacked(pa.chunked_array([pa.array([bytes(r.payload)], pa.binary())]))
        assert t.column_names == ["doc_id", "text"]
        got += list(zip(*t.to_pydict().values()))
        size[r.block] += t.num_rows
    assert sorted(got) == sorted(rows)
    assert set(size) <= set(range(16)) and max(size.values()) < 1.4 * len(rows) / 16
    assert exchange.packed_blocks(table.limit(0), "deal", 16).count() == 0


def test_sorted_keys_round_trip():
    rng = np.random.default_rng(1)
    sets = [np.empty(0, np.uint64), np.array([0], np.uint64), np.array([2**64 - 1], np.uint64), np.array([5, 5, 5], np.uint64),
            np.array([0, 2**64 - 1], np.uint64), np.array([9, 10], np.uint64)]
    sets += [np.sort(rng.integers(0, 2**63, n, np.uint64) * np.uint64(2)) for n in (2, 3, 257, 5000)]
    for keys in sets:
        assert np.array_equal(exchange.unpack_sorted(exchange.pack_sorted(keys), len(keys)), keys)
    part = sets[-1] >> np.uint64(8)
    assert len(exchange.pack_sorted(part + np.uint64(2**60))) == len(exchange.pack_sorted(part)) < 6 * len(part)


def test_gram_keys_are_whole():
    t = lm.Tokens(pa.array(["a b c d", "b c a"], pa.large_string()), np.array([True, False]))
    assert len(t.grams) == 18 and int(t.grams.max()) >> 60 > 0


# 3 ------------------------------------------------------------------------------------

def test_toxicity_learns_and_handles_edges(spark, edge, empty):
    import random
    rng = random.Random(5)
    plain = [f"w{i}" for i in range(300)]
    docs, labels = [], []
    for i in range(1200):
        toxic = i % 8 == 0
        w = [rng.choice(plain) for _ in range(60)] + ([rng.choice(["vile1", "vile2", "vile3"]) for _ in range(3)] if toxic else [])
        rng.shuffle(w)
        docs.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    table = spark.createDataFrame(docs, "doc_id long, text string")
    marks = spark.createDataFrame(labels + [(3, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.train(table, marks)
    truth = dict(labels)
    rows = toxicity.score_toxicity(table, model).withColumn("h", toxicity.held_out()).filter("h").collect()
    assert all(0 <= r.score <= 1 for r in rows)
    assert np.mean([r.predicted == truth[r.doc_id] for r in rows]) > 0.97
    scored = toxicity.score_toxicity(edge, model)
    assert scored.count() == len(edge_rows()) and scored.filter("score is null").count() == 0
    assert toxicity.score_toxicity(empty, model).count() == 0
    nothing = toxicity.train(empty, marks)
    assert {r.score for r in toxicity.score_toxicity(edge, nothing).collect()} == {0.0}


def test_toxicity_sample_is_bounded_with_repeated_ids(spark, monkeypatch):
    """An id or null with a third of all rows is neither wholly in the sample nor wholly out."""
    monkeypatch.setattr(toxicity, "MAX_POSITIVE", 100)
    monkeypatch.setattr(toxicity, "MAX_UNLABELLED", 300)
    fitted = []
    monkeypatch.setattr(toxicity, "fit", lambda docs, positive, prior: fitted.append((docs, positive)))
    ids = [i for i in range(1, 40) if zlib.crc32(str(i).encode()) % toxicity.FOLDS != toxicity.HELD_OUT_FOLD]
    for hot in (None, ids[0]):
        rows = [(k + 1000, f"own word{k}") for k in range(2000)] + [(hot, "hot")] * 1000 + [(i, "toxic") for i in ids[1:]]
        table = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
        marks = spark.createDataFrame([(i, 1) for i in ids] + [(1000, 0)], "doc_id long, toxic int")
        toxicity.train(table, marks)
        docs, positive = fitted.pop()
        assert (~positive).sum() == 300 and positive.sum() == (len(ids) - 1 if hot is None else 100)
        one_word = sum(len(d) == 1 for d, p in zip(docs, positive) if not p)
        assert 60 < one_word < 180


# 4 ------------------------------------------------------------------------------------

def test_pack_is_best_fit():
    import random
    rng = random.Random(2)
    n, capacity = 400, 50
    lengths = sorted((rng.randint(1, 50) for _ in range(n)), reverse=True)
    sources = [rng.choice("aaab" "cdefg") for _ in range(n)]
    clusters = [rng.choice([None, *range(30)]) for _ in range(n)]
    bins: list[list[int]] = []
    expected = []
    for k in range(n):
        fits = [(capacity - sum(lengths[j] for j in b), i) for i, b in enumerate(bins)
                if capacity - sum(lengths[j] for j in b) >= lengths[k]
                and all(sources[j] != sources[k] and (clusters[k] is None or clusters[j] != clusters[k]) for j in b)]
        i = min(fits)[1] if fits else len(bins)
        if i == len(bins):
            bins.append([])
        bins[i].append(k)
        expected.append(i)
    assert packing.pack(lengths, sources, clusters, capacity) == expected


def test_pack_documents(edge, empty):
    packed = packing.pack_texts(edge).toPandas()
    assert len(packed[packed.piece == 0]) == len(edge_rows())
    g = packed.groupby("bin_id")
    assert g.piece_tokens.sum().max() <= packing.CAPACITY
    assert (g.size() == g.source.nunique(dropna=False)).all() and (g.size() == g.cluster.nunique()).all()
    long = packed[packed.doc_id == 103].sort_values("piece")
    assert long.piece_tokens.sum() == long.n_tokens.iloc[0] > 10 * packing.CAPACITY
    assert (long.piece_start.to_numpy() == np.arange(len(long)) * packing.CAPACITY).all()
    assert packing.pack_texts(empty).count() == 0


def test_packing_does_not_depend_on_the_session(spark, edge):
    held, got = spark.conf.get("spark.sql.shuffle.partitions"), []
    table = edge.filter("doc_id < 100").select("doc_id", "text", "source")
    try:
        for n in ("2", "50"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            got.append(sorted((r.doc_id, r.bin_id) for r in packing.pack_texts(table).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", held)
    assert got[0] == got[1]


# 5 ------------------------------------------------------------------------------------

def brute_substrings(rows, window):
    seen, out = set(), []
    for i, t in rows:
        w = words(t)
        gone = [False] * len(w)
        for j in range(len(w) - window + 1):
            key = tuple(w[j:j + window])
            if key in seen:
                gone[j:j + window] = [True] * window
            seen.add(key)
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return out


def test_substring_dedup(spark, edge, empty):
    unique = [r for r in edge_rows() if r[0] not in (None, 104, 105)]
    done = substring.dedup_substrings(edge, keep_spaces=False)
    assert [c for c in done.columns if c not in ("n_words", "n_removed")] == [
        c for c in edge.columns if c not in ("n_words", "n_removed")]
    rows = done.collect()
    expected = brute_substrings(sorted((i, t) for i, t, _, _ in unique if t is not None), 20)
    got = sorted((r.doc_id, r.n_words, r.n_removed, r.text) for r in rows
                 if r.doc_id not in (None, 100, 104, 105))
    assert got == expected
    assert [(r.text, r.n_words, r.n_removed) for r in rows if r.doc_id == 100] == [(None, 0, 0)]
    assert substring.dedup_substrings(empty).count() == 0
    # of wholly equal rows one keeps its words; null ids come first
    text = " ".join(f"u{i}" for i in range(25))
    twins = spark.createDataFrame([(5, text), (5, text), (None, text)], "doc_id long, text string")
    assert sorted((r.doc_id is not None, r.n_removed) for r in substring.dedup_substrings(twins).collect()) == [
        (False, 0), (True, 25), (True, 25)]


def test_substring_dedup_whatever_order_blocks_are_read_in(spark):
    """On several executors the rows of a shuffle come in another order at each read."""
    def mixed(batches):
        for batch in batches:
            yield batch.take(pa.array(np.random.default_rng().permutation(batch.num_rows)))

    rows = [(i, t) for i, (_, t, _, _) in enumerate(edge_rows()[:40])]
    table = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).mapInArrow(mixed, "doc_id long, text string")
    held = spark.conf.get("spark.sql.exchange.reuse")
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        got = sorted((r.doc_id, r.n_words, r.n_removed, r.text)
                     for r in substring.dedup_substrings(table, keep_spaces=False).collect())
    finally:
        spark.conf.set("spark.sql.exchange.reuse", held)
    assert got == brute_substrings(rows, 20)


@pytest.mark.parametrize("period,cover", [(1, (0,)), (7, (0, 1, 3)), (13, (0, 1, 3, 9))])
def test_difference_covers(spark, period, cover):
    rows = [(i, t) for i, (_, t, _, _) in enumerate(edge_rows()[:40])]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.n_words, r.n_removed, r.text)
                 for r in substring.dedup_substrings(table, window=14, period=period, cover=cover, keep_spaces=False).collect())
    assert got == brute_substrings(rows, 14)
    with pytest.raises(ValueError):
        substring.dedup_substrings(table, period=13, cover=(0, 1, 2))


def test_white_space_between_kept_words_stays(edge):
    plain = {r.doc_id: r for r in substring.dedup_substrings(edge, keep_spaces=False).collect()}
    rows = substring.dedup_substrings(edge).collect()
    before = {(r.doc_id, r.block): r.text for r in edge.collect()}
    assert len(rows) == len(before) and any(r.n_removed for r in rows)
    for r in rows:
        was = before[r.doc_id, r.block]
        if r.n_removed:
            assert words(r.text) == words(plain[r.doc_id].text) or r.doc_id is None or r.doc_id in (104, 105)
            assert set(r.text) <= set(was)
        else:
            assert r.text == was            # untouched texts are the same text


@pytest.mark.parametrize("text, keep, left", [
    (" a  b\tc \n", "111", " a  b\tc \n"), ("a b\n\nc", "101", "a\n\nc"), ("a\n\nb c", "101", "a\n\nc"), ("a\tb  c", "101", "a\tc"),
    ("a b c\n", "110", "a b\n"), ("\n a b c", "011", "\n b c"), ("a b c", "010", "b"), (" a b ", "00", ""), ("a\nb\nc d", "1001", "a\nd")])
def test_gaps_where_words_went(text, keep, left):
    assert substring.without_words(text, np.array([k == "1" for k in keep])) == left


# 6 ------------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="</p>";</script></head><body class="no-sidebar">
<header><h1>Site</h1></header><nav><ul><li><a href="/x">Home</a></ul></nav>
<div class="cookie-notice">We use cookies</div><article><header><h1>A &amp;  B</h1></header>
<p>One<br>two <b>three</b><p>Four&nbsp;five<!-- no --><form><input><p>sign up</form>
<aside>more</aside><section id="comments"><article>troll</article></section><script>x<y</script></article>
<div class="ad">Buy</div><footer>&copy; x</footer>"""


def test_html_structure():
    assert html.main_texts([html.blocks_of(PAGE)], [0]) == ["A & B\n\nOne two three\n\nFour five"]
    assert html.blocks_of("") == [] and html.blocks_of("just &lt;text") == [(html.OPEN, "just <text")]
    assert html.blocks_of("<p>open <b>never closed") == [(html.OPEN, "open never closed")]


def test_suffix_runs_by_brute_force():
    rng = np.random.default_rng(1)
    tokens, page = rng.integers(0, 3, 300), np.sort(rng.integers(0, 9, 300))
    for run in (1, 2, 3, 5, 8):
        where = collections.defaultdict(set)
        spans = {}
        for i in range(300 - run + 1):
            if page[i] == page[i + run - 1]:
                spans[i] = tuple(tokens[i:i + run])
                where[spans[i]].add(page[i])
        got = html.suffix_runs(tokens, page, run)
        assert got.tolist() == [len(where[spans[i]]) if i in spans else 0 for i in range(300)]
        names, row = rng.permutation(10) // 2, page  # some rows are one page, and their numbers in no order
        got = html.suffix_runs(tokens * 10 ** 6, names[page], run, row=row)
        assert got.tolist() == [len({names[p] for p in where[spans[i]]}) if i in spans else 0 for i in range(300)]


def test_suffix_runs_of_few_words():
    for n in range(10):
        got = html.suffix_runs(np.arange(n), np.zeros(n, np.int64))
        assert got.tolist() == [1 if i + html.RUN <= n else 0 for i in range(n)]
        assert html.main_texts([html.blocks_of(" ".join("abcdefghi"[:n]))], [0]) == [" ".join("abcdefghi"[:n])]


def test_html_host_boilerplate(spark):
    page = ("<html><body><div>Home News Sport Weather Contact About Login Terms of use</div><div>{}</div>"
            "<div>Copyright by the great company of all rights reserved since 1999</div></body></html>")
    unique = [" ".join(f"w{k}x{j * 7 % 31}" for j in range(40)) for k in range(6)]
    rows = [(k, f"http://h.example/{k}", page.format(t)) for k, t in enumerate(unique)]
    rows += [(10, None, None), (11, "http://[bad", ""), (12, "http://H.example/z", PAGE), (12, "http://H.example/z", PAGE),
             (None, "http://o.example/", "<p>alone</p>")]
    table = spark.createDataFrame([(*r, "k") for r in rows], "page_id long, url string, html string, text string")
    got = {r.page_id: r for r in html.extract_text(table).collect()}
    assert [got[k].text for k in range(6)] == unique
    assert (got[10].text, got[11].text, got[None].text, got[10].n_chars) == ("", "", "alone", 0)
    assert got[12].text == "A & B\n\nOne two three\n\nFour five"
    assert html.extract_text(table).count() == len(rows)
    assert html.extract_text(table.limit(0)).count() == 0


PLAIN = "<html><body><div>Home News Sport Weather Contact About Login Terms of use</div><div>{}</div>{}</body></html>"
FOOT = "Copyright by the great company of all rights reserved since 1999"


def unique_text(k):
    return " ".join(f"w{k}x{j * 7 % 31}" for j in range(40))


def test_html_marked_blocks_are_evidence():
    """A footer without a mark goes if another page of the host marks it; a marked one always goes."""
    pages = [PLAIN.format(unique_text(0), f"<div>{FOOT}</div>"),
             f"<article><p>{unique_text(1)}</p></article><footer>{FOOT}</footer><nav>only here</nav>"]
    got = html.main_texts([html.blocks_of(p) for p in pages], [0, 1])
    assert got == ["Home News Sport Weather Contact About Login Terms of use\n\n" + unique_text(0), unique_text(1)]
    blocks = html.blocks_of('<p>a <span class="ad">b</span> c</p><aside>d</aside>e')
    assert blocks == [(html.OPEN, "a"), (html.MARKED, "b"), (html.OPEN, "c"), (html.MARKED, "d"), (html.OPEN, "e")]


def test_html_runs_count_over_the_whole_host(spark, monkeypatch):
    """257 and more pages of a host, long pages, and template lines in articles: the pieces do not show."""
    long = " ".join(f"z{j}" for j in range(700_000))  # over 4 MB
    rows = [(k, f"http://h.example/{k}", PLAIN.format(unique_text(k), f"<div>{FOOT}</div>")) for k in range(257)]
    rows += [(300, "http://h.example/long", PLAIN.format(long, f"<div>{FOOT}</div>"))]
    rows += [(400 + k, f"http://a.example/{k}", f"<article><p>{unique_text(k)}</p><p>{FOOT}</p></article>") for k in range(10)]
    rows += [(500 + k, f"http://b.example/{k}", f"<article><p>{unique_text(k)}</p><p>{FOOT if k < 7 else k}</p></article>")
             for k in range(10)]
    want = ({k: unique_text(k) for k in range(257)} | {300: long} | {400 + k: unique_text(k) for k in range(10)}
            | {500 + k: f"{unique_text(k)}\n\n{FOOT if k < 7 else k}" for k in range(10)})
    for size in (2 << 20, 1500):
        monkeypatch.setattr(html, "RANGE_BYTES", size)
        some = [r for r in rows if size > 1500 or r[0] != 300]
        table = spark.createDataFrame(some, "page_id long, url string, html string").repartition(3)
        got = {r.page_id: r for r in html.extract_text(table).collect()}
        assert {k: r.text for k, r in got.items()} == {r[0]: want[r[0]] for r in some}
        assert all(r.n_chars == len(r.text) for r in got.values())


def test_html_nominated_runs():
    """No run on the template's share of a host is lost by the pieces' nominations, and few others stay."""
    rng = np.random.default_rng(2)
    piece = np.sort(rng.integers(0, 40, 2000))  # pages of 40 pieces, of 2000
    share = rng.random(300) ** 2
    share[:20] = np.linspace(0.78, 1, 20)
    on = rng.random((300, 2000)) < share[:, None]
    on[20] = piece < 10  # on all pages of a quarter of the pieces
    pages = np.bincount(piece, minlength=40)
    seen = np.stack([np.bincount(piece, row, minlength=40) for row in on])
    key, part = np.nonzero(seen >= html.NOMINATE * pages)
    got = set(html.can_be_template(key.astype(np.uint64), seen[key, part], pages[part], 2000).tolist())
    assert set(np.flatnonzero(on.sum(axis=1) >= html.TEMPLATE_SHARE * 2000).tolist()) <= got
    assert 20 not in got and len(got) <= on.sum() / 2000 / (html.NOMINATE * 2 / 3) and (on[list(got)].mean(axis=1) > 0.26).all()


def test_html_piece_runs_are_the_suffix_arrays():
    """Runs of a piece by its suffix array: hashes, places and pages against a plain count; repeated rows are one page."""
    rng = random.Random(7)
    pages = [[(html.OPEN, " ".join(rng.choice("ab") for _ in range(rng.randint(0, 40))))] for _ in range(12)]
    numbers = [0, 0, *range(1, 11)]
    runs = html.piece_runs(pages, numbers, "h")
    spans, where, base = {}, collections.defaultdict(set), 0
    for (_, text), number in zip((p[0] for p in pages), numbers):
        ws = text.split()
        for i in range(len(ws) - html.RUN + 1):
            spans[base + i] = tuple(ws[i:i + html.RUN])
            where[spans[base + i]].add(number)
        base += len(ws)
    assert sorted(runs.at.tolist()) == sorted(spans) and runs.n_words == base
    assert (np.diff(runs.keys.astype(object)) > 0).all() and len(runs.keys) == len(where)
    name = {}
    for at, place in zip(runs.at.tolist(), runs.place.tolist()):
        assert name.setdefault(spans[at], place) == place and runs.pages[place] == len(where[spans[at]])
    assert len(set(name.values())) == len(where)
    other = html.piece_runs(pages[::-1], numbers[::-1], "h")
    assert (other.keys == runs.keys).all() and (other.pages == runs.pages).all()
    listed = np.sort(np.append(runs.keys[::3], np.uint64(5)))
    some = html.listed_runs(pages, numbers, "h", listed)
    assert (some.keys == runs.keys[::3]).all() and (some.pages == runs.pages[::3]).all() and some.n_words == runs.n_words
    assert set(zip(some.at.tolist(), (3 * some.place).tolist())) == {
        (a, p) for a, p in zip(runs.at.tolist(), runs.place.tolist()) if p % 3 == 0}


# 7 ------------------------------------------------------------------------------------

def test_fingerprints(edge, empty):
    rows = [r for r in edge_rows() if r[0] not in (None, 104, 105)]
    rows = sorted((i, t or "") for i, t, _, _ in rows)
    table = edge.filter("doc_id is not null and doc_id not in (104, 105)")
    got = {r.doc_id: r for r in lcp.edited_fingerprints(table).collect()}
    for k, (i, t) in enumerate(rows):
        following, q = rows[(k + 1) % len(rows)][1], len(t) // 4
        edited = t[:len(t) - q] + following[:q]
        a, b, c = (lcp.sketch([x]) for x in (t, edited, following))
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (lcp.to_strings(a)[0], lcp.to_strings(b)[0])
        assert (r.near_edited, r.near_next) == (lcp.likeness(a, b)[0], lcp.likeness(a, c)[0])
    assert lcp.edited_fingerprints(edge).count() == len(edge_rows())
    assert lcp.edited_fingerprints(empty).count() == 0
    assert lcp.fingerprints(edge).count() == len(edge_rows())


def plain_mix(x):
    full = (1 << 64) - 1
    x ^= x >> 31
    x = x * 0x7FB5D329728EA185 & full
    x ^= x >> 27
    x = x * 0x81DADEF4BC2DD44D & full
    return x ^ (x >> 33)


def plain_fingerprint(text):
    """Locally consistent parsing one name at a time, without numpy."""
    full, names, level, least = (1 << 64) - 1, [ord(c) for c in text], 0, {}
    while names:
        width = 32 if level == 0 else 64
        runs = [(k, len(list(g))) for k, g in itertools.groupby(names)]
        if any(c > 1 for _, c in runs):
            names, width = [plain_mix((k + c * 0xC2B2AE3D27D4EB4F) & full) if c > 1 else k for k, c in runs], 64
        label = names
        for _ in range(lcp.ROUNDS):
            left = [label[0] ^ ((1 << width) - 1), *label]
            low = [(x ^ y) & -(x ^ y) for x, y in zip(label, left)]
            label, width = [2 * (b.bit_length() - 1) + bool(x & b) for x, b in zip(label, low)], 8
        heads = [i for i in range(len(names)) if i == 0 or (
            label[i] > label[i - 1] and (i + 1 == len(names) or label[i] > label[i + 1]))]
        phrases = [names[a:b] for a, b in zip(heads, [*heads[1:], len(names)])]
        names = [plain_mix(sum(plain_mix((x + j * 0x165667B19E3779F9) & full) for j, x in enumerate(p, 1)) & full)
                 for p in phrases]
        level += 1
        if level >= lcp.LEVEL or len(names) == 1:
            for x in names:
                key = plain_mix((x + min(level, lcp.LEVEL)) & full)
                least[key % lcp.BINS] = min(least.get(key % lcp.BINS, full), key)
        if len(names) == 1:
            break
    return "".join(f"{1 + (least[b] >> 7) % 65535:04x}" if b in least else "0000" for b in range(lcp.BINS))


def test_fingerprints_equal_a_plain_parse():
    rng = random.Random(5)
    alphabets = ["ab", "abcdefghij ", "e\u00e9\u65e5\U0001f600 x"]
    texts = ["", "a", "aaaa", "ab" * 300, "abc" * 200] + [
        "".join(rng.choice(alphabets[i % 3]) * rng.choice((1, 1, 1, 2, 40)) for _ in range(rng.randint(0, 400))) for i in range(90)]
    prints, edited, checks = lcp._edited([*texts, texts[0]], 3000)
    for i, t in enumerate(texts):
        k, following = len(t) // 4, texts[(i + 1) % len(texts)]
        e = t[:len(t) - k] + following[:k]
        assert lcp.to_strings(prints[i:i + 1]) == [plain_fingerprint(t)]
        assert lcp.to_strings(edited[i:i + 1]) == [plain_fingerprint(e)]
        assert checks[i] == hashlib.sha256(e.encode()).hexdigest()


def test_phrases_do_not_depend_on_the_offset():
    rng = np.random.default_rng(0)
    text = "".join(chr(97 + c) for c in rng.integers(0, 26, 4000))
    a, b = lcp.sketch([text]), lcp.sketch(["xyz" * 5 + "q" + text])
    assert lcp.likeness(a, b)[0] > 0.85
    other = "".join(chr(97 + c) for c in rng.integers(0, 26, 4000))
    assert lcp.likeness(a, lcp.sketch([other]))[0] < 0.05
    assert lcp.likeness(lcp.sketch([""]), lcp.sketch([""]))[0] == 1


# 8 ------------------------------------------------------------------------------------

def brute_fingerprint(text):
    w = words((text or "").translate(LOWER))
    shingles = [" ".join(w[j:j + 3]) for j in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_groups(spark, edge, empty):
    rows = [(i, t) for i, t, _, _ in edge_rows()]
    base = rows[3][1] + " " + rows[4][1] + " " + rows[8][1]
    rows += [(200 + k, f"{base} {base} {base} x{k}") for k in range(30)]
    table = spark.createDataFrame([(i, t, "k", "f") for i, t in rows], "doc_id long, text string, fp string, component_id string")
    prints = [brute_fingerprint(t) for _, t in rows]
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    least = {}
    for (i, _), g in zip(rows, group):
        if i is not None:
            least[g] = min(i, least.get(g, i))
    expected = sorted((str(i), f"{p:016x}", least.get(g)) for (i, _), p, g in zip(rows, prints, group))
    got = sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in simhash.simhash_groups(table).collect())
    assert got == expected
    kept = simhash.keep_one_per_group(table)
    assert kept.columns == table.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(v) for v in [
        *least.values(), *[None for g in set(group) - set(least)]])
    assert simhash.keep_one_per_group(edge).columns == edge.columns
    assert simhash.simhash_groups(empty).count() == 0 and simhash.keep_one_per_group(empty).count() == 0


def test_near_pairs_and_deeper_buckets(spark, monkeypatch):
    rng = np.random.default_rng(0)
    one = np.uint64(1)
    base = rng.integers(0, 2 ** 63, 12).astype(np.uint64)
    flip = lambda n: one << rng.integers(0, 64, n).astype(np.uint64)
    fp = np.unique(np.concatenate([base[rng.integers(0, 12, 1500)] ^ flip(1500) ^ flip(1500), base]))
    key = (fp >> np.uint64(62)).astype(np.int64)
    order = np.lexsort((fp, key))
    key, fp = key[order], fp[order]
    a, b = simhash.near_pairs(key, fp, 2)
    close = {(i, j) for i in range(len(fp)) for j in range(i + 1, len(fp))
             if key[i] == key[j] and int(fp[i] ^ fp[j]).bit_count() <= 2}
    assert set(zip(a.tolist(), b.tolist())) == close
    # with tiny limits every bucket is dealt anew and no link is lost
    monkeypatch.setattr(simhash, "BUCKET_SPLIT", 3)
    few = fp[:200]
    table = spark.createDataFrame([(int(x),) for x in few.view(np.int64)], "fp long")
    got = {r.fp: r.root for r in simhash.groups(table).collect()}
    label = list(range(len(few)))
    for i in range(len(few)):
        for j in range(i):
            if int(few[i] ^ few[j]).bit_count() <= 2:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    mine = [got.get(int(x), int(x)) for x in few.view(np.int64)]
    assert len(set(zip(mine, label))) == len(set(mine)) == len(set(label))


# 9 ------------------------------------------------------------------------------------

def brute_stats(text):
    text = text or ""
    w = words(text)
    where = collections.defaultdict(list)
    for j in range(len(w) - 4):
        where[tuple(w[j:j + 5])].append(j)
    repeated = {p for v in where.values() if len(v) > 1 for j in v for p in range(j, j + 5)}
    lines = [x for x in text.split("\n") if words(x)]
    return (len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(repeated))


def test_quality_stats_and_verdicts(edge, empty):
    done = quality.quality_verdicts(edge)
    assert set(edge.columns) <= set(done.columns)
    rows = done.collect()
    key = lambda x: str(x)
    got = sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows), key=key)
    expected = []
    for i, t, _, _ in edge_rows():
        s = brute_stats(t)
        expected.append((i, *s, s[0] < 10 or 100 * s[4] > 20 * s[0]))
    assert got == sorted(expected, key=key)
    assert not any(r.kept and r.base_failed for r in rows)
    assert quality.quality_verdicts(empty).count() == 0


def test_quality_rejects_outliers_and_keeps_the_rest(spark):
    import random
    rng = random.Random(4)
    rows = []
    for i in range(900):
        w = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(30, 200))]
        if i % 9 == 0:
            w = [x + "###" for x in w]
        rows.append((i, " ".join(w), "en" if i % 2 else None, "hot" if i % 3 else "rare"))
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    out = quality.quality_verdicts(table).collect()
    assert all(r.kept == (r.doc_id % 9 != 0) for r in out)


def test_chi_square():
    assert abs(quality.chi2_quantile(0.95, 4) - 9.4877) < 1e-3


# 10 -----------------------------------------------------------------------------------

def test_bpe_equals_the_library(edge, empty):
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    tk = Tokenizer.from_file(path)
    encoded = bpe.bpe_encode(edge, path)
    done = bpe.bpe_decode(encoded, path)
    assert [c for c in done.columns if c not in ("ids", "decoded")] == [c for c in edge.columns if c != "ids"]
    for r in done.collect():
        ids = tk.encode(r.text or "", add_special_tokens=False).ids
        assert r.ids == ids and r.decoded == tk.decode(ids, skip_special_tokens=False)
    assert bpe.bpe_encode(empty, path, digests=True).count() == 0


def test_bpe_pieces_and_invalid_bytes():
    import random

    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    coder, tk = bpe._coder(bpe._shipped(path)), Tokenizer.from_file(path)
    rng = random.Random(1)
    parts = [" ", "\n", "  ", "a", "the", "'s", "123", "é", "日本", "\t", "\x1c", "!!", "<|endoftext|>", "\r\n", "ing", "😀",
             "　", "don't", "́", "\x85", "\v"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(1000)]
    texts += ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(1, 40))) for _ in range(600)]
    texts += ["a" * k for k in range(40)] + ["-" * k for k in range(100)]
    offsets, ids = coder.encode(pa.array(texts, pa.large_string()))
    for k, e in enumerate(tk.encode_batch(texts, add_special_tokens=False)):
        assert ids[offsets[k]:offsets[k + 1]].tolist() == e.ids, texts[k]
    odd = np.array([rng.randrange(50257) for _ in range(400)])
    cuts = np.arange(0, 401, 4)
    assert coder.decode(cuts, odd) == [tk.decode(odd[a:a + 4].tolist(), skip_special_tokens=False) for a in cuts[:-1]]


def test_clashing_columns_come_through(edge):
    assert set(CLASHES) <= set(edge.columns) and edge.schema == SCHEMA


def _plain_determinant(x: np.ndarray, ridge: np.ndarray, starts: int = 60) -> tuple[float, np.ndarray]:
    """Least determinant over random subsets and its squared distances, row by row and without bins."""
    rng, best = np.random.default_rng(5), (np.inf, None)
    h = int(quality.SUPPORT * len(x))
    for _ in range(starts):
        use = rng.choice(len(x), 8, replace=False)
        for _ in range(40):
            centre = x[use].mean(axis=0)
            scatter = np.cov(x[use].T, bias=True) * (quality.CONSISTENCY if len(use) == h else 1) + ridge
            gap = x - centre
            d2 = np.einsum("ij,jk,ik->i", gap, np.linalg.inv(scatter), gap)
            use = np.argsort(d2, kind="stable")[:h]
        best = min(best, (np.linalg.det(scatter), d2), key=lambda b: b[0])
    return best


def test_quality_takes_the_least_determinant(spark):
    rng = np.random.default_rng(3)
    shape = np.array([[0.5, 0, 0, 0], [0.45, 0.1, 0, 0], [0, 0, 0.3, 0], [0, 0, -0.25, 0.1]])
    x = rng.normal(size=(900, 4)) @ shape.T
    x[:180] = [1.2, -1.2, 0.9, 0.9] + rng.normal(size=(180, 4)) * 0.05  # a fifth of the rows: one far cluster across the axes
    points = spark.createDataFrame([("g", i % quality.SALTS, *map(float, r)) for i, r in enumerate(x)],
                                   "grp string, salt long, x0 double, x1 double, x2 double, x3 double")
    one = spark.createDataFrame([("g", "l")], "grp string, of string")
    row = quality._estimates(points, one, one).first()
    r = quality._spreads(points, one, one).first()
    ridge = np.diag([r[f"r{i}"] ** 2 for i in range(4)])
    least, d2 = _plain_determinant(x, ridge)
    assert least * 0.97 <= row["det"] <= least * 1.03
    inv = quality._symmetric(lambda i, j: row[f"v{i}{j}"])
    gap = x - [row[f"m{i}"] for i in range(4)]
    own = np.einsum("ij,jk,ik->i", gap, inv, gap)
    clear = np.abs(d2 / quality.CUTOFF - 1) > 0.1
    assert ((own > quality.CUTOFF) == (d2 > quality.CUTOFF))[clear].all()


def test_quality_ridge_follows_the_language(spark):
    rows = [("a", 100, 1.0), ("b", 300, 3.0)]
    points = spark.createDataFrame([(g, i % 32, c * (i % 101 - 50) / 100, 0.0, 0.0, 0.0) for g, n, c in rows for i in range(n)],
                                   "grp string, salt long, x0 double, x1 double, x2 double, x3 double")
    members = spark.createDataFrame([("a", "l"), ("b", "l")], "grp string, of string")
    got = {r["grp"]: r for r in quality._spreads(points, members, members).collect()}
    # quartile spreads of 0.5 and 1.5; most rows have the latter
    assert got["a"]["r0"] == got["b"]["r0"] == pytest.approx(quality.RIDGE * 1.5 / 1.349, rel=0.02)
    assert [got["a"][f"r{i}"] for i in (1, 2, 3)] == [f for _, f in quality.COORDINATES[1:]]
