import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rank int, n int"


@pytest.fixture(scope="session")
def awkward(spark):
    """Documents with nulls in every column, empty, blank, very long and repeated texts, equal ids,
    and columns named like those that operators make."""
    long = " ".join(f"word{k} of" for k in range(60_000))
    rows = [
        (1, "the same old line of words again\nand one more line of its own", "en", "a", 60),
        (2, "the same old line of words again\nanother line that only this has", "en", "b", 60),
        (3, None, "fr", "a", None),
        (None, "a text without any id at all here", None, None, 33),
        (4, "", "en", "a", 0),
        (5, " \t\n \r", "en", "", 5),
        (6, long, "en", "a", len(long)),
        (7, "le texte est en français\nune deux trois quatre cinq", "fr", "c", 40),
        (7, "le texte est en français\nune deux trois quatre cinq", "fr", "c", 40),
        (7, "a different text of the same id", None, "c", 31),
        (8, "12345 !!! <|endoftext|> 678", None, "b", 27),
        (9, "ends with blanks   ", "en", None, 19),
    ]
    return spark.createDataFrame([(*r, 1, 1) for r in rows], SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
