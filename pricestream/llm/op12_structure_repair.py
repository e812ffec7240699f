"""Conversation structure repair with Four-Russians block tables.

A conversation's rows, in order of turn, are edited at the least cost so that the initials of their roles read
``(s?(ua)+)?``: Keep 0, Rerole to user or assistant 3, Delete 4 (required for blank rows and repeats), Insert an empty
row of user or assistant 3; a row that ends without a full stop and is not deleted adds 3. Of the cheapest
edits the one whose initials come first in ASCII order is taken.

The state is what was put out last: nothing, system, user, assistant. The least cost from a row to the end is a vector of
four numbers; without its least number it is one of few vectors, found by a closure over the nine kinds of
rows. For every vector and every block of ``BLOCK`` kinds a table holds the vector before the block
and the cost that was taken off, so blocks are processed from the end by one lookup each. Then the blocks are expanded
backward from the vector at their end, which gives the vector after every row, and a second table tells for
vector, kind and state the first optimal edit: read from the first row on, ties are decided by the letter alone.

Blocks of whole conversations are dealt round tasks. A conversation of more than ``long_rows`` rows or
``LONG_BYTES`` bytes is dealt by Spark's range exchange instead, in ranges of its rows: only one byte a row (kind and fault)
of it meets in one task, which writes the audit of the same length; the ranges then write
their lines, and these run through the checksum as a stream, range by range.

Edge cases: nulls in role and text read as one space; null turns come first; rows of one turn are ordered by role and
text; a null conversation id is a conversation. Blank or unknown roles have no place and are reroled or deleted. A conversation without
rows has cost 0, an empty audit and the hash of the empty text. Further columns are not carried: the result has a row
a conversation. An empty table gives an empty result.
"""

from __future__ import annotations

from functools import lru_cache
from hashlib import sha256
from itertools import product
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricestream.llm import exchange as X
from pricestream.llm import words as W
from pricestream.llm.frames import prepare
from pricestream.session import materialize
from pricestream.sources.tables import read_table

#: Rows of a block of the tables.
BLOCK = 4
#: Rows and bytes of a conversation that is not handled in one piece; bytes of a block of conversations.
LONG_ROWS, LONG_BYTES, BLOCK_BYTES = 50_000, 16 << 20, 4 << 20

REROLE, DELETE, INSERT, CUT_OFF = 3, 4, 3, 3
#: States: nothing yet, after system, after user, after assistant. What a new row has to be, and the state after it.
USER, ASSISTANT = "user", "assistant"
_TAKES = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
_WANTED = ("u", "u", "a", "u")
_NAME = {"u": USER, "a": ASSISTANT}
#: Kinds of rows: initial (s, u, a, other) times 2, plus 1 if cut off; a row to delete; no row (fills a block).
INITIALS = "sua?"
GONE, NONE = 8, 9
#: Faults, in the order in which they count.
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)


# --- tables -----------------------------------------------------------------------------

class Choice(NamedTuple):
    letters: str   # initials of the edits
    lines: str     # inserted rows
    kept: str      # "" (deleted), "keep" or the new role
    state: int     # state after it


class Tables(NamedTuple):
    vectors: np.ndarray     # the normalised cost vectors; 0 is the one at the end
    step: np.ndarray        # [vector, kind] -> vector before the row
    block_step: np.ndarray  # [vector, block] -> vector before the block
    block_gain: np.ndarray  # [vector, block] -> cost taken off
    choice: np.ndarray      # [vector after the row, kind, state] -> choice
    choices: list[Choice]


def _inserted(costs: list[int]) -> list[int]:
    """Least costs when rows may be inserted first."""
    w = list(costs)
    for _ in range(2):
        w = [min(c, INSERT + w[_TAKES[q][_WANTED[q]]]) for q, c in enumerate(w)]
    return w


def _edits(kind: int, q: int):
    """(letter, cost, new role, state after) of the edits of a row of this kind in state ``q``."""
    yield "D", DELETE, "", q
    if kind != GONE:
        initial, extra = INITIALS[kind // 2], CUT_OFF * (kind % 2)
        if initial in _TAKES[q]:
            yield "K", extra, "keep", _TAKES[q][initial]
        yield "R", REROLE + extra, _NAME[_WANTED[q]], _TAKES[q][_WANTED[q]]


def _before(after: tuple[int, ...], kind: int) -> list[int]:
    return _inserted([min(cost + after[to] for _, cost, _, to in _edits(kind, q)) for q in range(4)])


def _first_choice(after: tuple[int, ...], kind: int, q: int) -> Choice:
    """The optimal edits up to and with this row whose letters come first: D, I, K, R."""
    w, letters, lines = _before(after, kind), "", ""
    while True:
        options = {letter: (role, to) for letter, cost, role, to in _edits(kind, q) if cost + after[to] == w[q]}
        wanted = _WANTED[q]
        if "D" not in options and INSERT + w[_TAKES[q][wanted]] == w[q]:
            letters, lines, q = letters + "I", f"{lines}{_NAME[wanted]}:\n", _TAKES[q][wanted]
            continue
        letter = min(options)
        role, to = options[letter]
        return Choice(letters + letter, lines, role, to)


#: What is inserted at the end, by state.
END_LETTERS = ("", "II", "I", "")
END_LINES = ("", f"{USER}:\n{ASSISTANT}:\n", f"{ASSISTANT}:\n", "")


@lru_cache(maxsize=None)
def tables(size: int = BLOCK) -> Tables:
    end = tuple(_inserted([0, 1 << 20, 1 << 20, 0]))
    number, step, gain = {end: 0}, [], []
    vectors = [end]
    for v in vectors:  # grows until the closure is reached
        to, off = [], []
        for kind in range(NONE):
            w = _before(v, kind)
            w, least = tuple(c - min(w) for c in w), min(w)
            if w not in number:
                number[w] = len(vectors)
                vectors.append(w)
            to.append(number[w])
            off.append(least)
        step.append([*to, number[v]])
        gain.append([*off, 0])
    step, gain = np.array(step, np.int32), np.array(gain, np.int64)
    block_step, block_gain = np.arange(len(vectors), dtype=np.int32)[:, None], np.zeros((len(vectors), 1), np.int64)
    for _ in range(size):  # one more kind on the right, which is the first to be processed
        block_gain = (gain[:, :, None] + block_gain[step]).transpose(0, 2, 1).reshape(len(vectors), -1)
        block_step = block_step[step].transpose(0, 2, 1).reshape(len(vectors), -1)
    choices: dict[Choice, int] = {}
    choice = np.zeros((len(vectors), NONE, 4), np.uint8)
    for v, kind, q in product(range(len(vectors)), range(NONE), range(4)):
        choice[v, kind, q] = choices.setdefault(_first_choice(vectors[v], kind, q), len(choices))
    return Tables(np.array(vectors), step, block_step, block_gain, choice, list(choices))


def solve(kinds: np.ndarray, offsets: np.ndarray, size: int = BLOCK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Least cost and last state of each conversation, and the choice at each row."""
    t = tables(size)
    n = np.diff(offsets)
    blocks = -(-n // size)
    block_end = np.cumsum(blocks)
    # conversations end at the end of a block: their first block is filled up in front
    place = np.arange(len(kinds)) + np.repeat(block_end * size - n - offsets[:-1], n)
    grid = np.full(int(blocks.sum()) * size, NONE, np.uint8)
    grid[place] = kinds
    grid = grid.reshape(-1, size)
    code = grid @ (NONE + 1) ** np.arange(size - 1, -1, -1)
    by_size = np.argsort(-n, kind="stable")
    cost, at, right = np.zeros(len(n), np.int64), np.zeros(len(n), np.int32), np.zeros(len(code), np.int32)
    live = np.searchsorted(-blocks[by_size], -np.arange(int(blocks.max(initial=0))))  # those with more blocks
    for r, k in enumerate(live):
        who = by_size[:k]
        b = block_end[who] - 1 - r
        right[b] = at[who]
        cost[who] += t.block_gain[at[who], code[b]]
        at[who] = t.block_step[at[who], code[b]]
    cost += t.vectors[at, 0]
    after = np.empty(grid.shape, np.int32)
    for j in range(size - 1, -1, -1):
        after[:, j] = right
        right = t.step[right, grid[:, j]]
    after = after.reshape(-1)[place]
    choice, state = np.zeros(len(kinds), np.uint8), np.zeros(len(n), np.int64)
    to = np.array([c.state for c in t.choices])
    live = np.searchsorted(-n[by_size], -np.arange(int(n.max(initial=0))))
    for r, k in enumerate(live):
        who = by_size[:k]
        i = offsets[who] + r
        choice[i] = t.choice[after[i], kinds[i], state[who]]
        state[who] = to[choice[i]]
    return cost, state, choice


# --- rows -------------------------------------------------------------------------------

def _ordered(tab: pa.Table) -> pa.Table:
    """The rows in order, each as often as it stands."""
    keys = [(c, "ascending") for c in ("conv_id", "turn", "role", "text")]
    order = pc.sort_indices(tab, keys, null_placement="at_start").to_numpy()
    return tab.take(pa.array(np.repeat(order, tab.column("copies").to_numpy()[order])))


def _text(col) -> pa.Array:
    return W.as_texts(col)


def _codes(role: pa.Array, text: pa.Array, again: np.ndarray) -> np.ndarray:
    """One byte a row: fault times 4 plus initial."""
    as_mask = lambda x: x.to_numpy(zero_copy_only=False).astype(bool)
    out = np.full(len(role), INITIALS.index("?"), np.uint8)
    for i, c in enumerate(INITIALS[:3]):
        out[as_mask(pc.starts_with(role, pattern=c))] = i
    trimmed = pc.ascii_rtrim(text, characters=" \t\n\x0b\x0c\r")
    blank = as_mask(pc.equal(pc.binary_length(trimmed), 0))
    ended = np.logical_or.reduce([as_mask(pc.ends_with(trimmed, pattern=m)) for m in ".!?"])
    return out + 4 * np.select([blank, again, ~ended], [BLANK, DUPLICATE, TRUNCATED], SOUND).astype(np.uint8)


def _seen_before(conv: np.ndarray, role: pa.Array, text: pa.Array) -> np.ndarray:
    keys = [np.asarray(x.dictionary_encode().indices) for x in (role, text)]
    order = np.lexsort((*keys, conv))
    same = np.ones(len(order), bool)
    for k in (conv, *keys):
        same[1:] &= k[order][1:] == k[order][:-1]
    same[:1] = False
    out = np.empty(len(order), bool)
    out[order] = same
    return out


def _kinds(codes: np.ndarray) -> np.ndarray:
    fault = codes >> 2
    return np.where((fault == BLANK) | (fault == DUPLICATE), GONE, 2 * (codes & 3) + (fault == TRUNCATED)).astype(np.uint8)


def _lines(choice: np.ndarray, role: pa.Array, text: pa.Array) -> pa.Array:
    """What each row puts out, every line with its end."""
    choices = tables().choices
    one = lambda x: pa.scalar(x, pa.large_string())
    pick = lambda xs: pa.array(xs, pa.large_string()).take(pa.array(choice))
    kept = pick([c.kept for c in choices])
    head = pc.if_else(pc.equal(kept, one("keep")), role, kept)
    line = pc.binary_join_element_wise(head, one(":"), text, one("\n"), one(""))
    line = pc.if_else(pc.equal(kept, one("")), one(""), line)
    return pc.binary_join_element_wise(pick([c.lines for c in choices]), line, one(""))


def _joined(parts: pa.Array, offsets: np.ndarray) -> pa.Array:
    return pc.binary_join(pa.LargeListArray.from_arrays(pa.array(offsets), parts), pa.scalar("", pa.large_string()))


def _audits(choice: np.ndarray, offsets: np.ndarray, state: np.ndarray) -> list[str]:
    letters = pa.array([c.letters for c in tables().choices], pa.large_string()).take(pa.array(choice))
    return [a + END_LETTERS[s] for a, s in zip(_joined(letters, offsets).to_pylist(), state.tolist())]


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    before = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return before[offsets[1:]] - before[offsets[:-1]]


def _measures(codes: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    fault, initial = codes >> 2, codes & 3
    starts = np.zeros(len(codes) + 1, bool)
    starts[offsets] = True
    legal = {INITIALS.index(a) * 4 + INITIALS.index(b) for a, b in ("su", "ua", "au")}
    pair = np.concatenate(([0], initial[:-1] * 4 + initial[1:])) if len(codes) else initial
    illegal = ~np.isin(pair, list(legal)) & ~starts[:-1]
    return {"blank": _sums(fault == BLANK, offsets), "duplicate": _sums(fault == DUPLICATE, offsets),
            "truncated": _sums(fault == TRUNCATED, offsets), "illegal": _sums(illegal, offsets)}


_NUMBERS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_LAST = {"audit": "string", "repaired_sha256": "string"}


def _repair_block(tab: pa.Table) -> pa.Table:
    """Whole conversations: everything in one piece."""
    conv = pc.unique(tab.column("conv_id"))
    tab = _ordered(tab)
    number = pc.index_in(tab.column("conv_id"), conv).combine_chunks().to_numpy()
    by_conv = np.argsort(number, kind="stable")
    tab, number = tab.take(pa.array(by_conv)), number[by_conv]
    offsets = np.searchsorted(number, np.arange(len(conv) + 1))
    role, text = _text(tab.column("role")), _text(tab.column("text"))
    codes = _codes(role, text, _seen_before(number, role, text))
    cost, state, choice = solve(_kinds(codes), offsets)
    lines = _joined(_lines(choice, role, text), offsets).to_pylist()
    hashes = [sha256((x + END_LINES[s])[:-1].encode()).hexdigest() for x, s in zip(lines, state.tolist())]
    known = tab.column("turn").is_valid().combine_chunks().to_numpy(zero_copy_only=False)
    turn, number = tab.column("turn").combine_chunks().fill_null(0).to_numpy(), number
    gaps = np.zeros(len(conv), np.int64)
    own, turn = number[known], turn[known]          # ascending in each conversation
    first = np.flatnonzero(np.diff(own, prepend=-1))
    if len(own):
        last = np.append(first[1:], len(own)) - 1
        new = np.ones(len(own), np.int64)
        new[1:] = (own[1:] != own[:-1]) | (turn[1:] != turn[:-1])
        gaps[own[first]] = turn[last] - turn[first] + 1 - np.add.reduceat(new, first)
    return pa.table({"conv_id": conv, "gaps": gaps, **_measures(codes, offsets), "cost": cost,
                     "audit": pa.array(_audits(choice, offsets, state), pa.string()),
                     "repaired_sha256": pa.array(hashes, pa.string())}).select(["conv_id", *_NUMBERS, *_LAST])


# --- the operator -----------------------------------------------------------------------

def repair_conversations(df: DataFrame, long_rows: int = LONG_ROWS) -> DataFrame:
    """Rows (conv_id, turn, role, text, copies) -> one row a conversation: conv_id, gaps, blank, duplicate, truncated,
    illegal, cost (long), audit, repaired_sha256. ``copies``: how often a row stands (0: not at all, but its
    conversation is in the result)."""
    spark = df.sparkSession
    prepare(spark)
    kind = df.schema["conv_id"].dataType.simpleString()
    out = ", ".join([f"conv_id {kind}", *(f"{c} long" for c in _NUMBERS), *(f"{c} {t}" for c, t in _LAST.items())])
    rows = df.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
                     F.when(F.col("copies") > 0, F.coalesce("text", F.lit(" "))).otherwise("").alias("text"),
                     F.col("copies").cast("int").alias("copies"))
    sizes = rows.groupBy("conv_id").agg(F.sum(F.greatest("copies", F.lit(1))).alias("n"),
                                        F.sum((F.octet_length("text") * F.col("copies")).cast("long")).alias("b"))
    total = sizes.agg(F.sum("b").alias("b"), F.max((F.col("n") > long_rows) | (F.col("b") > LONG_BYTES)).alias("any")).first()
    long = None
    if total["any"]:
        long = materialize(sizes.where((F.col("n") > long_rows) | (F.col("b") > LONG_BYTES)).select(
            F.col("conv_id").alias("long_id")), "long-conversations")
        its = rows["conv_id"].eqNullSafe(long["long_id"])
        long, rows = rows.join(long, its, "left_semi"), rows.join(long, its, "left_anti")
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(total["b"] or 0) // BLOCK_BYTES))
    block = F.pmod(F.xxhash64("conv_id"), F.lit(n)).cast("int")
    done = (rows.withColumn("block", block).repartitionById(n, F.col("block")).groupBy("block")
            .applyInArrow(lambda tab: _repair_block(tab), out))
    return done if long is None else done.unionByName(_repair_long(long, kind, out, long_rows))


def _repair_long(rows: DataFrame, kind: str, out: str, rows_per_range: int) -> DataFrame:
    """Conversations in ranges of their rows."""
    turns = rows.groupBy("conv_id").agg(*[f(F.when(F.col("copies") > 0, F.col("turn"))).alias(n) for f, n in (
        (F.min, "low"), (F.max, "high"), (F.count_distinct, "known"))])
    gaps = turns.select("conv_id", F.coalesce(F.col("high") - F.col("low") + 1 - F.col("known"), F.lit(0)).alias("gaps"))
    stands = (rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").cast("int").alias("copies"))
              .withColumn("h1", F.xxhash64("text")).withColumn("h2", F.xxhash64("text", F.lit(1))))
    place = F.struct(F.col("turn").isNotNull().alias("k"), "turn")
    firsts = stands.where("copies > 0").groupBy("conv_id", "role", "h1", "h2").agg(F.min(place).alias("first"))
    r = firsts.select(*[F.col(c).alias(f"__{c}") for c in firsts.columns])
    same = [stands[c].eqNullSafe(r[f"__{c}"]) for c in ("conv_id", "role", "h1", "h2")]
    stands = stands.join(r, same, "left").withColumn("again", ~place.eqNullSafe(F.col("__first")))
    n = -(-int(rows.agg(F.sum(F.greatest("copies", F.lit(1)))).first()[0]) // rows_per_range)
    parts = materialize(stands.select("conv_id", "turn", "role", "text", "copies", "again")
                        .repartitionByRange(n + 1, "conv_id", "turn", "role", "text")
                        .withColumn("part", F.spark_partition_id()), "conversation-ranges")
    by_part = parts.groupBy("conv_id", "part")

    def columns(tab: pa.Table):
        """Roles, texts and codes of a range in order; all but the first of several copies are repeats."""
        order = pc.sort_indices(tab, [(c, "ascending") for c in ("turn", "role", "text")], null_placement="at_start")
        tab = tab.take(order)
        copies = tab.column("copies").to_numpy()
        at = np.repeat(np.arange(tab.num_rows), copies)
        again = tab.column("again").to_numpy()[at] | (np.diff(at, prepend=-1) == 0)
        role, text = _text(tab.column("role")).take(pa.array(at)), _text(tab.column("text")).take(pa.array(at))
        return role, text, _codes(role, text, again)

    def bytes_of(tab: pa.Table) -> pa.Table:
        return pa.table({"conv_id": tab.column("conv_id").slice(0, 1), "part": tab.column("part").slice(0, 1),
                         "codes": pa.array([columns(tab)[2].tobytes()], pa.binary())})

    def choose(tab: pa.Table) -> pa.Table:
        """One byte a row of a whole conversation."""
        tab = tab.sort_by("part")
        each = [np.frombuffer(c, np.uint8) for c in tab.column("codes").to_pylist()]
        codes, cut = np.concatenate(each), np.cumsum([0, *map(len, each)])
        offsets = np.array([0, len(codes)])
        cost, state, choice = solve(_kinds(codes), offsets)
        one = {**_measures(codes, offsets), "cost": cost, "audit": _audits(choice, offsets, state)}
        rest = tab.num_rows - 1
        return pa.table({"conv_id": tab.column("conv_id"), "part": tab.column("part"),
                         "choices": pa.array([choice[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary()),
                         # the numbers stand with the last range
                         **{c: pa.array([None] * rest + [v[0]], pa.string() if c == "audit" else pa.int64()) for c, v in one.items()},
                         "ending": pa.array([None] * rest + [END_LINES[state[0]]], pa.string())})

    def write(tab: pa.Table, chosen: pa.Table) -> pa.Table:
        role, text, _ = columns(tab)
        lines = _lines(np.frombuffer(chosen.column("choices")[0].as_py(), np.uint8), role, text)
        text = "".join(lines.to_pylist()) + (chosen.column("ending")[0].as_py() or "")
        return chosen.drop_columns(["choices", "ending"]).append_column("lines", pa.array([text], pa.string()))

    numbers = [c for c in _NUMBERS if c != "gaps"]
    passed = ", ".join([f"conv_id {kind}", "part int", *(f"{c} long" for c in numbers), "audit string"])
    codes = by_part.applyInArrow(bytes_of, f"conv_id {kind}, part int, codes binary")
    chosen = codes.groupBy("conv_id").applyInArrow(
        lambda tab: choose(tab).select(["conv_id", "part", "choices", *numbers, "audit", "ending"]),
        passed.replace("part int", "part int, choices binary") + ", ending string")
    written = by_part.cogroup(chosen.groupBy("conv_id", "part")).applyInArrow(
        lambda tab, c: write(tab, c).select(["conv_id", "part", *numbers, "audit", "lines"]), passed + ", lines string")

    def stream(batches):
        """Checksums over the lines of the ranges, one after the other."""
        digest, held, conv = None, b"", None
        for batch in batches:
            for i in range(batch.num_rows):
                if digest is None:
                    digest = sha256()
                data = held + batch.column("lines")[i].as_py().encode()
                held = data[-1:]            # the end of the last line of all is left out
                digest.update(data[:-1])
                if batch.column("cost")[i].is_valid:
                    yield pa.RecordBatch.from_arrays(
                        [*(batch.column(c).slice(i, 1) for c in ("conv_id", *numbers, "audit")),
                         pa.array([digest.hexdigest()], pa.string())], ["conv_id", *numbers, *_LAST])
                    digest, held = None, b""

    streamed = ", ".join([f"conv_id {kind}", *(f"{c} long" for c in numbers), *(f"{c} {t}" for c, t in _LAST.items())])
    done = written.repartition("conv_id").sortWithinPartitions("conv_id", "part").mapInArrow(stream, streamed)
    g = gaps.withColumnRenamed("conv_id", "__conv")
    return done.join(g, done["conv_id"].eqNullSafe(g["__conv"])).select("conv_id", *_NUMBERS, *_LAST)


def damaged(df: DataFrame) -> DataFrame:
    """``df`` (conv_id, turn, role, text) with ``copies``, damaged by crc32 of ``conv_id:turn`` modulo 20: 0 drops the row, 1 empties
    the text, 2 takes its full stops, 3 repeats the row, 4 makes it the user's. Nulls read as one space."""
    name = F.concat(*[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id",)], F.lit(":"),
                    F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    k = F.crc32(name) % 20
    text = F.coalesce("text", F.lit(" "))
    return df.select("conv_id", "turn", F.when(k == 4, USER).otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
                     F.when(k == 1, "").when(k == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
                     F.when(k == 0, 0).when(k == 3, 2).otherwise(1).alias("copies"))


def op12_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    return repair_conversations(damaged(read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")))


#: The same by a row-at-a-time dynamic program: of each state the cheapest edits, ties by their letters
#: (the first table is the usual CRC-32 table by its rule).
ORACLE = r"""
WITH RECURSIVE tab AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i::BIGINT, range(8)), lambda c, k:
             xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)) AS v
    FROM (SELECT unnest(range(256)) AS i))),
src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(list_prepend(4294967295::BIGINT,
             list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ascii(x)::BIGINT)),
             lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295::BIGINT) % 20 AS k
  FROM conversations, tab),
dam AS (
  SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN k = 1 THEN '' WHEN k = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE WHEN k = 3 THEN 2 ELSE 1 END)) AS copy
  FROM src WHERE k <> 0),
ord AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen,
         NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank, left(role, 1) AS c
  FROM dam),
f AS (
  SELECT *, NOT blank AND seen > 1 AS dup, NOT blank AND seen = 1 AND NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS cut,
         lag(c) OVER (PARTITION BY conv_id ORDER BY i) AS p
  FROM ord),
m AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
         count(*) FILTER (blank) AS blank, count(*) FILTER (dup) AS duplicate, count(*) FILTER (cut) AS truncated,
         count(*) FILTER (i > 1 AND p || c NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM f GROUP BY conv_id),
ins(q, q2, letters, lines) AS (VALUES
  (0, 0, '', ''), (0, 2, 'I', 'user:' || chr(10)), (0, 3, 'II', 'user:' || chr(10) || 'assistant:' || chr(10)),
  (1, 1, '', ''), (1, 2, 'I', 'user:' || chr(10)), (1, 3, 'II', 'user:' || chr(10) || 'assistant:' || chr(10)),
  (2, 2, '', ''), (2, 3, 'I', 'assistant:' || chr(10)), (2, 2, 'II', 'assistant:' || chr(10) || 'user:' || chr(10)),
  (3, 3, '', ''), (3, 2, 'I', 'user:' || chr(10)), (3, 3, 'II', 'user:' || chr(10) || 'assistant:' || chr(10))),
ed(q, c, letter, q2, role) AS (VALUES
  (0, 's', 'K', 1, NULL), (0, 'u', 'K', 2, NULL), (1, 'u', 'K', 2, NULL), (2, 'a', 'K', 3, NULL), (3, 'u', 'K', 2, NULL),
  (0, NULL, 'R', 2, 'user'), (1, NULL, 'R', 2, 'user'), (2, NULL, 'R', 3, 'assistant'), (3, NULL, 'R', 2, 'user'),
  (0, NULL, 'D', 0, NULL), (1, NULL, 'D', 1, NULL), (2, NULL, 'D', 2, NULL), (3, NULL, 'D', 3, NULL)),
dp AS (
  SELECT conv_id, 0::BIGINT AS i, 0 AS q, 0::BIGINT AS cost, '' AS audit, '' AS lines FROM m
  UNION ALL
  SELECT conv_id, i, q, cost, audit, lines FROM (
    SELECT dp.conv_id, f.i, ed.q2 AS q,
           dp.cost + 3 * length(ins.letters) + CASE letter WHEN 'D' THEN 4 WHEN 'R' THEN 3 ELSE 0 END
             + CASE WHEN cut AND letter <> 'D' THEN 3 ELSE 0 END AS cost,
           dp.audit || ins.letters || letter AS audit,
           dp.lines || ins.lines || CASE WHEN letter = 'D' THEN '' ELSE coalesce(ed.role, f.role) || ':' || f.text || chr(10) END AS lines
    FROM dp JOIN f ON f.conv_id = dp.conv_id AND f.i = dp.i + 1 JOIN ins ON ins.q = dp.q
         JOIN ed ON ed.q = ins.q2 AND (ed.c IS NULL OR ed.c = f.c) AND (letter = 'D' OR NOT (blank OR dup)))
  QUALIFY row_number() OVER (PARTITION BY conv_id, q ORDER BY cost, audit) = 1),
done AS (
  SELECT dp.conv_id, cost + CASE q WHEN 1 THEN 6 WHEN 2 THEN 3 ELSE 0 END AS cost,
         audit || CASE q WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END AS audit,
         lines || CASE q WHEN 1 THEN 'user:' || chr(10) || 'assistant:' || chr(10) WHEN 2 THEN 'assistant:' || chr(10) ELSE '' END AS lines
  FROM dp JOIN m ON m.conv_id = dp.conv_id AND dp.i = m.n),
best AS (SELECT * FROM done QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY cost, audit) = 1)
SELECT s.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost,
       coalesce(audit, '') AS audit,
       sha256(coalesce(CASE WHEN lines = '' THEN '' ELSE left(lines, length(lines) - 1) END, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) s LEFT JOIN m USING (conv_id) LEFT JOIN best USING (conv_id)
"""
