import random

import pytest
from pyspark.sql import types as T

DOC_SCHEMA = T.StructType([T.StructField(n, t) for n, t in (
    ("doc_id", T.LongType()), ("TEXT", T.StringType()), ("text", T.StringType()), ("lang", T.StringType()), ("block", T.LongType()),
    ("n_words", T.StringType()), ("_row", T.StringType()))])


def vocabulary(n, seed):
    r = random.Random(seed)
    return ["".join(r.choice(["ba", "ko", "mi", "tu", "xe", "ré", "no", "ly"]) for _ in range(r.randint(1, 4))) + f"{i:x}" for i in range(n)]


@pytest.fixture(scope="session")
def corpus():
    """Texts with shared passages, copies, near copies and odd cases: (doc_id, text)."""
    r, words = random.Random(5), vocabulary(400, 1)
    passages = [" ".join(r.choice(words) for _ in range(n)) for n in (9, 13, 14, 30, 60)]
    rows = []
    for i in range(70):
        parts = [" ".join(r.choice(words) for _ in range(r.randint(0, 60)))]
        for p in r.sample(passages, r.randint(0, 2)):
            parts += [p, " ".join(r.choice(words) for _ in range(r.randint(0, 20)))]
        rows.append((100 - i if i % 3 else i + 200, (" \t\n"[i % 3]).join(parts)))
    rows += [(500 + k, rows[4][1]) for k in range(6)] + [rows[4], rows[4]]
    near = rows[7][1].split()
    rows += [(600 + k, " ".join(near[:k] + ["changed"] + near[k + 1:])) for k in range(0, min(12, len(near)))]
    rows += [(700, None), (701, ""), (702, " \n\t "), (703, "one"), (704, "Two words"), (None, rows[4][1]), (None, None), (705, "na " * 400),
             (706, "na " * 380 + "end"), (707, "x" * 5000), (708, "É\u00a0\u2003é \x1c\x85 ünï " + rows[3][1].upper()), (709, "a<|endoftext|>b it's 12% <|startoftext|>"),
             (-3, passages[4] + " " + passages[3]), (710, " ".join(r.choice(words) for _ in range(6000)) + " " + passages[3])]
    return rows


@pytest.fixture(scope="session")
def docs(spark, corpus):
    """The corpus with columns whose names clash with one another and with internal ones."""
    return spark.createDataFrame([(i, "other", t, "en", 7, "seven", "row") for i, t in corpus], DOC_SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
