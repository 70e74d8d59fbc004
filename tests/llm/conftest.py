"""Small documents that hold the odd cases, and the sample documents."""

from __future__ import annotations

import random

import pytest

SMALL = "/root/testdata/sf0.001"


def odd_texts() -> list[str | None]:
    rng = random.Random(5)
    words = ["alpha", "Beta", "gamma,", "délta", "日本語", "x", "the", "of", "42", "a.b"]
    line = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage = line(60)
    texts = [
        None,
        "",
        " \t\n",
        "one",
        "two  words ",
        line(30),
        line(400) + "\n" + passage + "\n" + line(50),
        passage,
        line(10) + " " + passage + "\n\n" + passage + " end",
        "same line\nsame line\n\nsame line \n" + line(25),
        "\x1c\x85  odd   spaces\r\n \n x",
        "a  b   c\n\n\n d \n",
        "don't we'll 123abc  456  <|endoftext|> </s>[INST] x",
        "😀😀 emoji 😀 text",
        "z" * 5000,
        "1 " * 4000,
        line(20_000),
        "ab" * 300 + line(8) + "ab" * 300,
    ]
    base = line(300)
    for i in range(12):
        near = base.split()
        near[20 * i + 7] = f"edit{i}"
        texts.append(" ".join(near))
    return [*texts, base, base, base.upper()]


@pytest.fixture(scope="session")
def odd(spark):
    """Odd documents with null and repeated ids and clashing extra columns; and as Python rows."""
    texts = odd_texts()
    rows = [(i * 3 - 5, t, ["s1", None, "s0", "é"][i % 4]) for i, t in enumerate(texts)]
    rows += [(None, texts[6], "s1"), (None, None, None), rows[9], rows[9], (4, "repeated id", "s0")]
    extra = [
        (*r[:2], "en", r[2], len(r[1] or ""), i, "x", 1, 2, "y") for i, r in enumerate(rows)
    ]
    schema = (
        "doc_id long, text string, lang string, source string, n_chars long, size int, row string, "
        "failed int, block int, spans string"
    )
    return spark.createDataFrame(extra, schema).repartition(3), rows


@pytest.fixture(scope="session")
def none(spark):
    """An empty documents table."""
    return spark.createDataFrame(
        [], "doc_id long, text string, lang string, source string, n_chars long"
    )


@pytest.fixture(scope="session")
def sample(spark):
    """The sample documents, and as (doc_id, text) rows."""
    df = spark.read.parquet(f"{SMALL}/documents.parquet")
    return df, [(r.doc_id, r.text, r.source) for r in df.collect()]


@pytest.fixture(params=["odd", "sample"])
def corpus(request):
    return request.getfixturevalue(request.param)


@pytest.fixture(scope="session")
def multiset():
    """Rows of a result or of tuples, in one order, nulls included."""

    def build(rows):
        return sorted((tuple(r) for r in rows), key=repr)

    return build
