"""Tables with every awkward case at once, and the rules of the operators in plain Python."""

import random
import re

import pytest

LOWER = re.compile("[A-Z]")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return LOWER.sub(lambda m: m[0].lower(), text or "")


def spaced(text):
    return SPACED.findall(text or "")


def alnum(text):
    return ALNUM.findall(lower(text))


def texts():
    """Null, empty, blank, short, odd, repeated, near-equal and long texts."""
    draw = random.Random(7)
    vocabulary = ["alpha", "Beta", "gamma,", "délta.", "the", "of", "Über", "x1", "über", "ζeta", "<|endoftext|>"]
    base = [draw.choice(vocabulary) + str(draw.randrange(50)) for _ in range(120)]
    near = list(base)
    near[60] = "changed"
    long = " ".join(draw.choice(vocabulary) + str(draw.randrange(900)) for _ in range(30_000))
    return [None, None, "", "", " ", "\n\n", "one", "one", "two words", "\ta\r\nb  c ", "a\x0bb\x1cc\xa0d", " lead", "trail ",
            " ".join(base), " ".join(base), " ".join(near), " ".join(base[:119]), "line\nline\n\nother\nline", "x " * 400,
            "#" * 30 + " $%& <|> " * 9, "</s>[INST] a <\\s> [\\\\/INST]", long, "é" * 5000, "word " * 9 + "word"]


@pytest.fixture(scope="session")
def docs(spark):
    """documents with a null key, repeated rows, and columns whose names the operators use themselves."""
    rows = [(i, t, "en", "s", 7, "z") for i, t in enumerate(texts())]
    rows += [(None, "no key here at all", None, None, None, None), (13, rows[13][1], "en", "s", 7, "z")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, size long, entity string")


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)


def given(docs):
    return [(r["doc_id"], r["text"]) for r in docs.collect()]


def same_rows(got, want):
    """Equal as bags, with nulls."""
    assert sorted(map(repr, got)) == sorted(map(repr, want))
