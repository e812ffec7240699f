"""Cross-tokenizer alignment against whole texts through both libraries, and its perfect hash."""

import collections
import hashlib

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from pricestream.llm import op13_tokenizer_alignment as op  # noqa: E402
from pricestream.llm.op10_bpe import byte_characters  # noqa: E402
from llm.conftest import SCHEMA  # noqa: E402

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
NUMBERS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def brute(texts):
    """Per text the six numbers and the groups, one token at a time; and the count of each pair."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer
    one, two = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    one.encode_special_tokens = True
    byte_of = {c: i for i, c in enumerate(byte_characters())}
    aligned = []
    for t in texts:
        a = one.encode(" " + t, add_special_tokens=False).ids if t else []
        b = two.encode(t) if t else []
        bytes_a = [bytes(byte_of[c] for c in one.id_to_token(i)) for i in a]
        bytes_b = [bytes([int(two.id_to_piece(i)[3:5], 16)]) if two.is_byte(i) else two.id_to_piece(i).replace("\u2581", " ").encode()
                   for i in b]
        if not t or b"".join(bytes_a) != (" " + t).encode() or b"".join(bytes_b) != (" " + t).encode():
            aligned.append([])
            continue
        groups, i, j = [], 0, 0
        while i < len(a):
            ga, gb, la, lb = [a[i]], [b[j]], len(bytes_a[i]), len(bytes_b[j])
            i, j = i + 1, j + 1
            while la != lb:
                if la < lb:
                    ga.append(a[i]); la += len(bytes_a[i]); i += 1
                else:
                    gb.append(b[j]); lb += len(bytes_b[j]); j += 1
            groups.append((ga, gb))
        aligned.append(groups)
    count = collections.Counter()
    for groups in aligned:
        count.update({(x, y) for ga, gb in groups for x in ga for y in gb})
    best = collections.Counter()
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    out = []
    for groups in aligned:
        links = [(x, y) for ga, gb in groups for x in ga for y in gb]
        out.append((sum(len(g) for g, _ in groups), sum(len(g) for _, g in groups), len(groups), len(links),
                    sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links),
                    ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in groups)))
    return out, count


ODD = ["  two  spaces ", " lead", "trail ", "a\nb\n c", "tab\tand\x0bmore \x85 x", "low\u2581line", "<s> <0x41> <|endoftext|>", "\x00nul",
       "e\u0301 \u00a0nbsp \u3000wide", "\u65e5\u672c\u8a9e\u306e\u6587 \U0001f600 x", "it's we'll 3.14 #$%", " ", "\n", "a", "aaaa" * 300, "z" * 41,
       "\U0001f468\u200d\U0001f469\u200d\U0001f467 " * 5, "one\x1ctwo \x1f three"]


def test_alignment_equals_brute_force(spark, edge, empty):
    extra = [(1000 + i, t, None, None, None, *([None] * (len(SCHEMA) - 5))) for i, t in enumerate(ODD)]
    df = edge.unionByName(spark.createDataFrame(extra, SCHEMA))
    rows = df.collect()
    want, count = brute([r.text for r in rows])
    work = op.Alignment(df, A, B)
    done = work.documents().collect()
    key = lambda r: tuple(str(r[c]) for c in df.columns)
    assert sorted((key(r), *(r[c] for c in NUMBERS), r.groups) for r in done) == sorted(
        (key(r), *w) for r, w in zip(rows, want))
    assert {(r.a, r.b): r.n for r in work.pair_counts().collect()} == count
    digests = op.align_tokenizers(df.select("doc_id", "text"), A, B, digests=True).collect()
    sha = [hashlib.sha256(w[6].encode()).hexdigest() if w[6] else "" for w in want]
    assert sorted((str(r.doc_id), r.groups_sha256, *(r[c] for c in NUMBERS)) for r in digests) == sorted(
        (str(r.doc_id), h, *w[:6]) for r, h, w in zip(rows, sha, want))
    assert op.align_tokenizers(empty, A, B).count() == 0


def test_lanes_of_lanes_and_wide_groups(spark, edge, monkeypatch):
    want = sorted(map(str, op.align_tokenizers(edge.select("doc_id", "text"), A, B, digests=True).collect()))
    monkeypatch.setattr(op, "FAN_IN", 2)          # 8 blocks: three levels
    monkeypatch.setattr(op, "PLAIN_GROUP", 0)     # every group by its distinct ids
    assert sorted(map(str, op.align_tokenizers(edge.select("doc_id", "text"), A, B, digests=True).collect())) == want


def test_perfect_hash():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 1000, 50_000):
        keys = np.unique(rng.integers(0, 1 << 40, n).astype(np.uint64))
        h = op.PerfectHash.frombytes(op.PerfectHash.of(keys).tobytes())
        assert sorted(h.slots(keys).tolist()) == list(range(len(keys)))
    other = h.slots(keys + np.uint64(1 << 41))
    assert (other < len(keys)).all()              # a foreign key gets some slot: callers verify


def test_query_equals_brute_force(spark):
    from conftest import SF001
    rows = spark.read.parquet(f"{SF001}/documents.parquet").collect()
    want, _ = brute([r.text or "" for r in rows])
    got = {r.doc_id: r for r in op.op13_tokenizer_alignment(spark, SF001).collect()}
    for r, w in zip(rows, want):
        assert tuple(got[r.doc_id][c] for c in NUMBERS) == w[:6]
        assert got[r.doc_id].groups_sha256 == (hashlib.sha256(w[6].encode()).hexdigest() if w[6] else "")
