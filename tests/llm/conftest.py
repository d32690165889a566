import random

import pytest

COLUMNS = ("doc_id long, text string, lang string, source string, n_chars long, n int, key string, tile string, rep string, "
           "row string, part string, term string, label string, toxic string, spans string, component string, line string")


def frame(spark, texts, ids=None, langs=None):
    """Documents with further columns whose names clash with inner ones."""
    ids = ids or range(len(texts))
    rows = [(i, t, (langs or ["en"] * len(texts))[k], "src", None if t is None else len(t), *(["x"] * 0), 1, *["x"] * 11)
            for k, (i, t) in enumerate(zip(ids, texts))]
    return spark.createDataFrame(rows, COLUMNS)


WORDS = "the of and river stone light under bright window garden seven morning walked slowly because mountain paper table".split()


def prose(random_, n):
    return " ".join(random_.choice(WORDS) + random_.choice(["", "", "", ",", "."]) for _ in range(n))


@pytest.fixture
def rng():
    return random.Random(5)


@pytest.fixture
def odd(spark, rng):
    """Null and empty texts, white space, a very long text, ties, repeated rows, null ids."""
    long = "\n".join(prose(rng, 30) for _ in range(400))
    texts = [None, "", " \n\t ", "a", long, long + " more words at the end", "same text in a tie", "same text in a tie", "x" * 5000]
    docs = frame(spark, texts)
    return docs.unionAll(docs.filter("doc_id in (0, 4, 6)")).unionAll(frame(spark, ["no id here", None], ids=[None, None]))
