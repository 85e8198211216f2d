import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, n_tokens string, score string, component_id string, `DIGEST` string, id int, record string, _kept string, n_words int, node long, part string, `ROW` string, kept boolean, _text string, fresh string"


def rows_of(texts):
    """(id, text) as documents, with further columns whose names operators use inside."""
    return [(i, t, "en", "src0", None, "x", "y", "z", "w", 1, None, "k", 5, 6, "p", "r", None, "t", "f") for i, t in texts]


@pytest.fixture(scope="session")
def words():
    rng = random.Random(3)
    return ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(1, 8))) for _ in range(400)]


@pytest.fixture(scope="session")
def odd_texts(words):
    """Nulls, empty and odd texts, copies, near copies and a very long one."""
    rng = random.Random(4)
    base = [rng.choice(words) for _ in range(120)]
    near = [*base[:60], "changed", *base[61:]]
    texts = [None, "", " ", "\n\n", "one", "one two three four", "Ünïcödé “quotes” — naïve İstanbul ΣΑΣ", "a  b   c \t d\r\n e \x1c! f", "'s 's it's I'LL 1234 12½ <|endoftext|> <s> \x00 x", " ".join(base), " ".join(base).upper(), " ".join(near), " ".join(base)]
    texts += [" ".join(rng.choice(words) for _ in range(rng.randint(1, 200))) for _ in range(25)]
    texts.append(" ".join(rng.choice(words) for _ in range(60_000)))
    out = list(enumerate(texts))
    out += [(9, texts[9]), (40, texts[3]), (None, texts[9]), (41, "x" * 5000), (42, "la " * 3000)]
    return out


@pytest.fixture(scope="session")
def docs(spark, odd_texts):
    return spark.createDataFrame(rows_of(odd_texts), DOCS).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)
