import random
import re

import pytest
from pyspark.sql import types as T

#: Names that operators use inside or add.
CLASHES = ["block", "rest", "fp", "row", "tie", "range", "guest", "shard", "kept", "score", "predicted", "held_out",
           "n_words", "n_removed", "fingerprint", "component_id", "bin_id", "ids", "key", "bucket", "grp", "exact", "x0"]
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       T.StructField("n_chars", T.LongType())] + [T.StructField(c, T.StringType()) for c in CLASHES])


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def make_texts(n=40, seed=3):
    """Short texts over few words, with copies, near copies and a passage that many share."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(30))
    out = []
    for i in range(n):
        t = " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 80)))
        if i % 5 == 0:
            t = t + "\n" + passage + " tail"
        if i % 7 == 0 and out:
            t = rng.choice(out)
        out.append(t)
    return out


def edge_rows():
    """Nulls in any column, empty and blank and very long texts, ties, repeated rows."""
    long = " ".join(f"z{i % 997}" for i in range(60_000))
    rows = [(i, t, "en", "s0") for i, t in enumerate(make_texts())]
    rows += [(100, None, "en", "s0"), (101, "", None, "s1"), (102, " \n\t ", "en", None), (103, long, "de", "s2"),
             (None, "a null id", "en", "s0"), (None, None, None, None), (104, "tie one", "en", "s0"), (104, "tie two", "en", "s0"),
             (105, "same row twice", "en", "s0"), (105, "same row twice", "en", "s0"), (106, "Ünï code 日本 😀 <|endoftext|>", "fr", "s0"),
             (107, "### *** ||| " * 30, "en", "s0")]
    return rows


@pytest.fixture(scope="session")
def edge(spark):
    data = [(i, t, lang, s, None if t is None else len(t), *[f"{c}-{k}" for c in CLASHES])
            for k, (i, t, lang, s) in enumerate(edge_rows())]
    return spark.createDataFrame(data, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
