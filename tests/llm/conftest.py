import pytest

# One table with the awkward rows every operator must take: nulls in each column, empty
# and wordless texts, ties, repeated rows, and a long text.
_BASE = "the quick brown fox jumps over the lazy dog while seven wise owls look on from the old oak tree"
LONG = " ".join(f"word{i % 977} filler" for i in range(30_000))
ROWS = [
    (1, _BASE, "en", "a", 10),
    (2, _BASE, "en", "a", 10),
    (3, _BASE + " today", "en", "b", None),
    (4, _BASE.upper(), "en", None, 10),
    (5, "der schnelle braune fuchs springt über den faulen hund und die eule schläft\n\n" + _BASE, "de", "b", 10),
    (6, "", None, "a", 0),
    (7, None, "en", "a", None),
    (8, "  \n \t ", "de", "b", 4),
    (9, "12345 --- !!", None, "c", 12),
    (10, "ein wort", "de", "c", 8),
    (None, "text of a row without an id, said once", "en", "c", 3),
    (None, _BASE, "en", "c", 3),
    (11, "repeated row of some words here", "en", "a", 5),
    (11, "repeated row of some words here", "en", "a", 5),
    (12, LONG, "en", "a", len(LONG)),
    (13, "wörter mit ümlaut und eßzett, straße und größe", "de", "b", 9),
]
DDL = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(ROWS, DDL)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DDL)
