"""Fixtures of the operator tests: a small corpus with copies, repeats, odd texts and clashing columns."""

from __future__ import annotations

import random

import pytest

#: Extra columns named like those the operators use inside.
CLASHES = "bucket string, slice string, label string, n_words string, part string, words string, kept string, number string, _at string, spans string"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHES}"


def prose(rng: random.Random, words: int) -> str:
    syllables = ["ka", "lo", "mi", "ren", "tus", "vel", "or", "sha", "pin", "dra"]
    made = ["".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(words)]
    return " ".join(w + rng.choice(["", "", "", ",", ".", "\n"]) for w in made)


def corpus() -> list[tuple[int, str | None]]:
    rng = random.Random(7)
    base = [prose(rng, rng.choice([5, 40, 90, 300])) for _ in range(40)]
    passage = prose(rng, 60)
    texts: list[str | None] = [*base, base[3], base[3], base[5] + " tail", passage + " " + base[1], base[2] + "\n" + passage, passage * 3]
    for n in range(12):
        words = base[6].split(" ")
        words[(7 * n) % len(words)] = f"edit{n}"
        texts.append(" ".join(words))
    texts += [None, "", " ", "\n\n", "one", "One", "one two", "ONE TWO", "é" * 150, "é" * 150 + "x", "  " * 200, "aaaa " * 300, "ab" * 400, "12 34 !!", "日本語 テキスト " * 30, "x" * 20_000, "\u0000a\u0000"]
    texts.append("<|endoftext|> don't <|startoftext|>we'll  \t go\r\n" * 3)
    return [(i * 3, t) for i, t in enumerate(texts)]


@pytest.fixture(scope="session")
def texts():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, texts):
    rows = [(i, t, "en" if i % 2 else None, None, len(t or ""), *["x"] * 10) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Null ids, repeated rows and nulls in every column."""
    long_text = prose(random.Random(3), 80)
    nothing = (None,) * 10
    rows = [(None, None, None, None, None, *nothing), (1, long_text, "en", None, 1, *nothing), (1, long_text, "en", None, 1, *nothing), (None, long_text, None, None, None, *nothing), (2, long_text + " end", "en", "s", 2, *nothing)]
    return spark.createDataFrame(rows, SCHEMA)
