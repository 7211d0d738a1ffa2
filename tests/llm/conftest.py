import random

import pytest

from riskloom.session import ship_package

DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string, tk long, carry int, slot int, label string, kept boolean, n_tokens int"


def words(rng, n):
    return [rng.choice("ab cde Fgh über it's x. <b> 12 don't #tag ÉTÉ 日本 ok, the of and".split()) + rng.choice(["", "", str(rng.randint(0, 99))])
            for _ in range(n)]


@pytest.fixture(scope="session")
def rows():
    """Small documents with copies, shared passages, nulls, blanks, ties, one long text and special strings."""
    rng = random.Random(3)
    passage = " ".join(words(rng, 70))
    base = [" ".join(words(rng, rng.randint(1, 160))) for _ in range(30)]
    texts = [*base, base[0], base[3], base[3] + " tail", passage, "start " + passage, passage + " end " + base[7],
             base[9] + "\n" + passage[20:] + "\n" + base[9], "", "   \n\t ", "one", "one two", "one two three", None, None,
             " ".join(words(rng, 9000)), "a<|endoftext|>b  <|endoftext|>", "nbsp\xa0x\x1cy\x85z  two  blanks \n\n end ",
             "line with words\n" * 40 + passage, "same same same same " * 30]
    out = []
    for i, t in enumerate(texts):
        out.append((i * 3 if i != 20 else 10**12, t, "en", [None, "b", "a", "c"][i % 4], None, "k", 1, 2, 3, "l", None, 9))
    return out


@pytest.fixture(scope="session")
def docs(spark, rows):
    ship_package(spark)
    return spark.createDataFrame(rows, DOCS).repartition(5)


@pytest.fixture(scope="session")
def odd_docs(spark, docs, rows):
    """The documents with repeated rows and null ids besides."""
    extra = [rows[1], rows[1], (None, rows[5][1], *rows[5][2:]), (None, None, *rows[5][2:]), (rows[8][0], "another text of this id", *rows[8][2:])]
    return docs.unionByName(spark.createDataFrame(extra, DOCS))


@pytest.fixture(scope="session")
def no_docs(spark, docs):
    return docs.where("false")
