"""What the tests of this folder share."""

import pytest

#: id, text, lang, source, and a column that clashes with names used inside.
DOCS = "doc_id long, text string, lang string, source string, n_chars long, _id string, kept string, taken long, _row int"


@pytest.fixture(scope="session")
def docs(spark):
    def make(rows):
        full = [(r[0], r[1], (r + (None,) * 4)[2], (r + (None,) * 4)[3], None if r[1] is None else len(r[1]), "x", "y", 5, 1) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture(scope="session")
def small(spark):
    """The smallest given table, as rows too."""
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return df, [tuple(r) for r in df.select("doc_id", "text", "lang", "source").collect()]

ODD = [(1, None), (2, ""), (3, " \t\n "), (None, "a b c"), (None, None), (5, "é à ü ß 你好 \x1c x"), (5, "é à ü ß 你好 \x1c x"), (5, "other text of the same id"),
       (6, "long " * 50_000), (7, "word" * 50_000), (8, "one"), (9, "one")]


def closure(n, links):
    """Component number of each of ``n`` nodes."""
    up = list(range(n))

    def root(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in links:
        up[root(a)] = root(b)
    return [root(x) for x in range(n)]
