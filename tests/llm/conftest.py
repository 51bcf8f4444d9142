import random

import pytest
from pyspark.sql import types as T

from cascadia.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    return session


#: Names that operators use themselves, or used once.
HELPERS = (
    "key tie line kept ids spans rep row doc new lost id text_key surrogates "
    "_text_key _surrogates _lost_lines _lost_doc _tie _new _kept _kept_text"
).split()

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        *(T.StructField(n, T.StringType()) for n in HELPERS),
    ]
)


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) pairs, with extra columns whose names clash."""

    def build(*rows):
        extra = [None if n in ("tie", "ids") else f"own {n}" for n in HELPERS]
        full = [(i, t, "en", "s", None if t is None else len(t), *extra) for i, t in rows]
        return spark.createDataFrame(full, DOCS)

    return build


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    syllables = "ba co di fu ge ha jo ki lu me na po ri su te va wo xi yu za".split()
    return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Null and empty texts, white space, a null key, repeated rows, a very long text."""
    long = "\n".join(prose(s, 60) + "." for s in range(400))
    return [
        (1, None),
        (2, ""),
        (3, " \n\t "),
        (None, prose(90, 30)),
        (5, prose(91, 80)),
        (5, prose(91, 80)),
        (6, prose(91, 80)),
        (7, long),
        (8, "x" * 5000),
        (9, "one two"),
        (10, "é漢字🙂 <|endoftext|>  two  spaces and\x1c more\n"),
    ]
