import random

import pytest
from pyspark.sql import Row


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def corpus(seed=1, n=60):
    """Documents with copies, near copies, hot passages, odd texts, and columns whose names the operators use too."""
    rng = random.Random(seed)
    passage = words(rng, 40)
    texts = []
    for _ in range(n):
        texts.append(words(rng, rng.randrange(20, 120), 3000))
    base = words(rng, 150, 3000).split()
    for _ in range(25):
        near = list(base)
        for _ in range(rng.randrange(0, 5)):
            near[rng.randrange(len(near))] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(near))
    texts += [texts[0]] * 12 + [f"{words(rng, 30, 3000)} {passage} {words(rng, 30, 3000)}" for _ in range(20)]
    texts += ["", " \t\n", "one", "two words", "ONE", "a b c d e", "A B C D E", "é ü 😀 ñ", words(rng, 20_000, 5000), "same line here\n" * 40, "###" * 30]
    rows = [(i, t, rng.choice(["en", "fr", None]), rng.choice(["s0", "s0", "s0", "s1", "s2", None])) for i, t in enumerate(texts)]
    rows += [(None, None, None, None), (5000, None, "en", "s1"), rows[3], rows[3]]
    return rows


SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    """With further columns, named like those that operators add."""
    df = spark.createDataFrame([(*r, len(r[1] or ""), 1, "x", 2, "y") for r in rows], f"{SCHEMA}, n_chars long, size int, row string, node int, key string").repartition(5)
    return df.persist()


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)


def as_rows(df):
    return [r.asDict() if isinstance(r, Row) else r for r in df.collect()]
