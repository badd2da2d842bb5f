import random

import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, size string, rows string, n string"


def words(rng, n, vocabulary=4000):
    return ["w%03x%s" % (rng.randrange(vocabulary), rng.choice("abcdef")) for _ in range(n)]


@pytest.fixture(scope="session")
def doc_rows():
    """Ordinary texts, exact and near copies, repeats, nulls, an empty and a very long text; columns with clashing names."""
    rng = random.Random(3)
    base = [" ".join(words(rng, rng.randrange(30, 200))) for _ in range(30)]
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(100 + i, base[0]) for i in range(40)]  # copies
    for i in range(60):  # near copies of one text, not all near each other
        w = base[1].split(" ")
        for _ in range(rng.randrange(1, 5)):
            w[rng.randrange(len(w))] = "edit%d" % rng.randrange(10**6)
        rows.append((200 + i, " ".join(w)))
    rows += [(300, None), (301, ""), (302, " \t\n\x0b\x0c\r "), (303, "one two"), (304, "ONE Two"), (305, "one two"), (None, base[2]), (306, "é ü x 日本 \U0001f600 " * 9)]
    rows += [(307, base[3]), (307, base[3]), (308, "\n".join(words(rng, 30000, 10**6))), (309, "x" * 70000)]
    return [(i, t, None if i is None else "en", None if i in (5, 6) else f"s{(i or 0) % 3}", len(t or ""), "k", "s", "r", "n") for i, t in rows]


@pytest.fixture(scope="session")
def docs(spark, doc_rows):
    return spark.createDataFrame(doc_rows, DOC_SCHEMA).repartition(5).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


def by_row(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, str(x)) for x in r))
