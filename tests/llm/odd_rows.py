"""Fixtures: rows of every odd kind."""

import random

import pytest

from conftest import SMALL

LONG = " ".join(f"word{i % 977}" for i in range(60_000))


def texts():
    """Nulls, empty, blank, odd, long and repeated texts, and near copies."""
    rng = random.Random(11)
    base = [" ".join(rng.choice(WORDS) for _ in range(rng.randint(3, 60))) for _ in range(40)]
    near = [" ".join([*t.split()[:-1], "Changed"]) for t in base[:10]]
    odd = [None, "", " ", "\n\t ", "one", "ONE", "é ß İ Σ ﬁ 日本 🙂", "<s> </s> <|endoftext|>", "\x00 a", "▁ ▁▁x  y", "!!! ???", LONG, "x" * 20_000]
    return odd + base + near + base[:5]


WORDS = "the cat Sat on a mat and ran to you Because it's été über niño 12 3.5 end. (yes) no-one A b c d e f g h".split()


@pytest.fixture(scope="session")
def docs(spark):
    """Rows with a null id, a repeated row, one id before two texts, and names that the operators use themselves."""
    rows = [(i, t, "en" if i % 2 else "fr") for i, t in enumerate(texts())]
    rows += [(None, "a text without an id", None), rows[20], (3, "another text under id 3", "en")]
    rows = [(i, t, lang, 0.5, 1, "s", [1]) for i, t, lang in rows]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, score double, version int, node string, features array<int>"
    ).repartition(3)


@pytest.fixture(scope="session")
def rows(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)


@pytest.fixture(scope="session")
def small():
    return SMALL
