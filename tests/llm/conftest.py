"""Documents with awkward cases, shared by the tests of all operators."""

import random

import pytest

WORDS = ["alpha", "beta", "gamma", "delta", "Über", "straße", "x1", "tree", "river", "stone", "cloud", "wind"]


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n)).capitalize() + "."


def make_texts(seed=3):
    """Plain texts, copies, near copies, shared passages, null, empty, blank, very short, periodic and very long texts."""
    rng = random.Random(seed)
    plain = [" ".join(sentence(rng, rng.randrange(4, 14)) for _ in range(rng.randrange(1, 12))) for _ in range(40)]
    passage = " ".join(sentence(rng, 12) for _ in range(7))
    texts = list(plain)
    texts += [plain[0]] * 9 + [plain[1]] * 2  # copies
    for k in range(8):  # near copies
        words = plain[k % 4].split() * 2
        words[rng.randrange(len(words))] = "changed"
        texts.append(" ".join(words))
    texts += [plain[k] + " " + passage + "\n" + plain[k + 1] for k in range(5, 11)]
    texts += [None, None, "", "", " \t\n", "one", "one two three four", "ONE two\tthree  four", "x" * 900, "ab" * 500, "a b " * 700, "word " * 30_000, "é" * 450, passage]
    return texts


@pytest.fixture(scope="session")
def texts():
    return make_texts()


@pytest.fixture(scope="session")
def docs(spark, texts):
    """Ids in no order of the texts; columns that operators might use inside."""
    rows = [((7 * i + 3) % len(texts), t, "en" if i % 2 else None, i, f"s{i}", i / 2) for i, t in enumerate(texts)]
    schema = "doc_id long, text string, lang string, `set` int, `_score` string, `a.b` double"
    return spark.createDataFrame(rows, schema).repartition(3, "doc_id")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string")


@pytest.fixture(scope="session")
def odd(spark):
    """Null and repeated ids, repeated rows."""
    long = " ".join(f"w{i}" for i in range(120))
    rows = [(None, "a b c d e f"), (None, None), (5, long), (5, long), (5, "other words here that are new"), (6, long), (None, long), (7, None)]
    return spark.createDataFrame(rows, "doc_id long, text string")
