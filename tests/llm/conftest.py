import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tid string, n string, start string, pos string"


def words(rnd, n, size=60):
    return " ".join(rnd.choice("abcdefghijklm") + str(rnd.randrange(size)) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """(doc_id, text): nulls, empty and long texts, exact and near copies, repeated rows, shared passages."""
    rnd = random.Random(7)
    base, passage = words(rnd, 300), words(rnd, 70)
    near = base.split()
    near[150] = "Changed"
    rows = [(1, base), (2, base), (3, " ".join(near)), (4, None), (5, ""), (6, " \t\n"), (7, "one two"), (8, "One two é"), (9, words(rnd, 20) + " " + passage + " " + words(rnd, 30))]
    rows += [(10 + i, words(rnd, 15) + "\n" + passage + "  " + words(rnd, 15)) for i in range(4)]
    rows += [(20, "la la " * 300), (21, "la la " * 90), (22, words(rnd, 30_000, 10**6)), (23, "x" * 5000), (2, base)]
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    """With extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(k, t, ["en", "fr", None][k % 3], "s", None if t is None else len(t), "x", "x", "x", "x") for k, t in odd_rows], SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
