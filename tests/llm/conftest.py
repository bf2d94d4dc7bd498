import pytest

WORDS = "the of and to in stone river light paper green window seven north summer glass bread".split()


def prose(seed: int, n: int) -> str:
    return " ".join(WORDS[(seed * 7 + i * i * 3 + i * seed) % len(WORDS)] + str((seed * 31 + i * 17) % 97) for i in range(n))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty, very long and repeated texts, a repeated id, and columns whose names clash."""
    long = prose(3, 30_000)
    rows = [
        (1, prose(1, 200), "en", "a", 5),
        (2, prose(1, 200), "en", "a", 5),
        (3, None, "en", "a", None),
        (4, "", None, "b", 0),
        (5, "ab", "de", None, 2),
        (6, long, "en", "a", 9),
        (7, "x " + long, "fr", "c", 9),
        (8, prose(8, 120), "en", "b", 1),
        (8, prose(8, 120), "en", "b", 1),
        (None, prose(1, 200), None, None, None),
        (9, "é" * 150 + " <|endoftext|> \n\n  \t" + "é" * 150, "xx", "a", 1),
        (10, " \n ", "en", "c", 3),
    ]
    rows = [(*r, 1, 1.0, True, 7, 7, "x") for r in rows]
    return spark.createDataFrame(
        rows,
        "doc_id long, text string, lang string, source string, n_chars long, size int, score double, kept boolean, h1 int, class_id int, spans string",
    ).repartition(3, "source")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")
