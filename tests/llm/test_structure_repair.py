"""Conversation structure repair against a search over all edits, row by row, with every edge case."""

import functools
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricestream.llm import op12_structure_repair as op
from conftest import SF001

SCHEMA = "conv_id long, turn long, role string, text string"
NEXT = {"": "su", "s": "u", "u": "a", "a": "u"}
FULL = {"u": "user", "a": "assistant"}


def blank(text):
    return not re.search(r"[^\x20\x09-\x0D]", text)


def cheapest(rows):
    """(cost, audit, lines) over all edits: rows are (role, text, fault)."""
    @functools.cache
    def best(i, last, inserts=2):
        found = []
        if i == len(rows) and last in ("", "a"):
            found.append((0, "", ()))
        if i < len(rows):
            role, text, fault = rows[i]
            cost, audit, lines = best(i + 1, last)
            found.append((4 + cost, "D" + audit, lines))
            if fault not in ("blank", "duplicate"):
                extra = 3 * (fault == "truncated")
                if role[:1] and role[:1] in NEXT[last]:
                    cost, audit, lines = best(i + 1, role[0])
                    found.append((extra + cost, "K" + audit, (f"{role}:{text}", *lines)))
                to = NEXT[last][-1]
                cost, audit, lines = best(i + 1, to)
                found.append((3 + extra + cost, "R" + audit, (f"{FULL[to]}:{text}", *lines)))
        if inserts:
            to = NEXT[last][-1]
            cost, audit, lines = best(i, to, inserts - 1)
            found.append((3 + cost, "I" + audit, (f"{FULL[to]}:", *lines)))
        return min(found, key=lambda x: x[:2], default=(10 ** 9, "", ()))
    return best(0, "")


def brute(rows):
    """conv_id -> the result for rows (conv_id, turn, role, text), after damage."""
    after = {}
    for conv, turn, role, text in rows:
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        k, role, text = zlib.crc32(name.encode()) % 20, " " if role is None else role, " " if text is None else text
        own = after.setdefault(conv, [])
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        own += [(turn, "user" if k == 4 else role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    return {conv: repaired(own) for conv, own in after.items()}


def repaired(own):
    own = sorted(own, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, faults = set(), []
    for _, role, text in own:
        faults.append("blank" if blank(text) else "duplicate" if (role, text) in seen else
                      "truncated" if text.rstrip(" \t\n\x0b\x0c\r")[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = [t for t, _, _ in own if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(own))
    cost, audit, lines = cheapest([(r, t, f) for (_, r, t), f in zip(own, faults)])
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def random_rows(n=400, seed=5):
    rng = random.Random(seed)
    texts = ["Yes.", "No", "Why? ", "end.\n", "", " \t", "...", "Ünï ok!", "a b c", None, "x\ny.", "Yes.", "tail\x1c"]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "Sys", "u"]
    rows = []
    for conv in range(n):
        for turn in range(rng.randint(1, 9)):
            turn = None if rng.random() < .05 else turn + (rng.random() < .1) * 7
            rows.append((conv if conv % 50 else None, turn, rng.choice(roles), rng.choice(texts)))
            if rng.random() < .05:
                rows.append(rows[-1])
    return rows


def as_rows(df):
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256)
            for r in df.collect()}


@pytest.mark.parametrize("long_rows", [50_000, 3])
def test_repair_equals_search(spark, long_rows):
    rows = random_rows(400 if long_rows > 10 else 60)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("block", F.lit("clash")).repartition(5)
    got = as_rows(op.repair_conversations(op.damaged(df), long_rows))
    assert got == brute(rows)


def test_query_equals_search(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert as_rows(op.op12_structure_repair(spark, SF001)) == brute(rows)


def test_empty_tables_and_dropped_conversations(spark):
    assert op.repair_conversations(op.damaged(spark.createDataFrame([], SCHEMA))).count() == 0
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got = as_rows(op.repair_conversations(op.damaged(spark.createDataFrame([(dropped, 0, "user", "Hi.")], SCHEMA))))
    assert got == {dropped: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_blocks_of_any_size_and_long_conversations():
    rng = np.random.default_rng(2)
    n = np.append(rng.integers(0, 12, 300), [5000, 0, 1])
    offsets = np.concatenate(([0], np.cumsum(n)))
    kinds = rng.integers(0, 9, offsets[-1]).astype(np.uint8)
    one = op.solve(kinds, offsets, 1)
    for size in (2, 3, 4):
        assert all((a == b).all() for a, b in zip(one, op.solve(kinds, offsets, size)))
    # the choices give sequences of the wanted form at the stated cost
    choices = op.tables().choices
    for i in range(len(n)):
        cost, state = 0, 0
        for k, c in zip(kinds[offsets[i]:offsets[i + 1]].tolist(), one[2][offsets[i]:offsets[i + 1]]):
            c = choices[c]
            cost += 3 * c.letters.count("I") + 4 * c.letters.count("D") + 3 * c.letters.count("R") + 3 * (k % 2 and k < 8 and c.kept != "")
            state = c.state
        assert cost + 3 * len(op.END_LETTERS[state]) == one[0][i]
