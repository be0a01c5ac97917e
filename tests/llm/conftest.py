import random

import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    # Names that the operators use themselves.
    "key string, text_key string, n_tokens long, uid long, score double, line string, number int"
)
EXTRA = ("en", "src0", 7, "k", "t", 3, 4, 0.5, "l", 1)

# Nulls, empty and blank texts, repeated rows and ids, one very long text.
ODD = [
    (1, "a b c"),
    (1, "a b c"),
    (1, "A b  c d"),
    (None, None),
    (None, "no id\nno id"),
    (2, None),
    (3, ""),
    (4, " \n\t "),
    (5, "é " * 20000 + "x" * 3000),
    (6, "0 1"),
]


@pytest.fixture
def documents(spark):
    def make(rows):
        return spark.createDataFrame([(i, t, *EXTRA) for i, t in rows], SCHEMA)

    return make


@pytest.fixture
def odd(documents):
    return documents(ODD)


@pytest.fixture
def corpus(documents):
    """Texts with copies, near copies and shared passages."""
    rng = random.Random(7)
    words = [f"w{i}" for i in range(400)]
    passage = [rng.choice(words) for _ in range(60)]
    rows = []
    for i in range(60):
        text = [rng.choice(words) for _ in range(rng.randrange(30, 200))]
        if i % 3 == 0:
            at = rng.randrange(len(text))
            text[at:at] = passage
        rows.append((i, text))
    for i in range(60, 90):
        copy = list(rows[rng.randrange(60)][1])
        for _ in range(rng.randrange(0, 3)):
            copy[rng.randrange(len(copy))] = rng.choice(words)
        rows.append((i, copy))
    for i in range(90, 100):  # one group of near copies
        copy = list(rows[5][1])
        copy[rng.randrange(len(copy))] = f"own{i}"
        rows.append((i, copy))
    rows += [(i, ["x", "y"] * 40) for i in (100, 101)] + [(102, ["z"] * 80)]

    def lines(text):
        return "\n".join(" ".join(text[k : k + 12]) for k in range(0, len(text), 12))

    return documents([(i, lines(t)) for i, t in rows])


def texts(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def plan_nodes(df):
    return df._jdf.queryExecution().executedPlan().toString()
