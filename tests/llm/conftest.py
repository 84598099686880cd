import random

import pytest

#: Columns beyond those of documents, with names that operators use themselves.
CLASHING = "size long, key string, row string, node long, bucket long, score double, shard int, target double, queue string, train boolean, licence string, path string, sample string, a long, b long"
DOCS = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}"


def doc(doc_id, text, source="s0", lang="en"):
    return (doc_id, text, lang, source, len(text or ""), 1, "k", "r", 2, 3, 0.5, 4, 0.1, "q", True, "l", "p", "s", 5, 6)


def prose(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice("bcdfgklmnprst") + r.choice("aeiou") for _ in range(r.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls in any column, empty, blank, short and very long texts, repeated rows, copies, ties."""
    long = prose(1, 150_000)
    return [
        doc(1, prose(2, 60)), doc(2, prose(2, 60), "s1"), doc(3, prose(3, 60)), doc(3, prose(3, 60)), doc(4, None), doc(5, ""), doc(6, " \t\n "), doc(7, "one"), doc(8, "one", None),
        doc(9, "one two three four"), doc(10, long, None), doc(None, prose(2, 60)), doc(None, prose(4, 30)), doc(11, "x" * 300_000), doc(12, "éè 한국 \U0001f600 \x1f\x85 end"), (13, None, None, None, None, *[None] * 15),
    ]


@pytest.fixture(scope="session")
def edge(spark, edge_rows):
    return spark.createDataFrame(edge_rows, DOCS).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)
