import pytest

# The words of white space, case and length that the contracts name, and what may go wrong with rows.
LONG = " ".join(f"long{i}" for i in range(30_000))
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog.", "en", "a"),
    (2, "the QUICK brown fox\tjumps over the lazy dog.", "en", "a"),
    (3, None, "en", None),
    (4, "", None, "b"),
    (5, " \n\t", "de", "b"),
    (6, "Thequickbrownfoxjumpsoverthelazydog.", "en", "c"),
    (7, "word", "en", "c"),
    (8, LONG, "en", "d"),
    (9, LONG + " more", "en", "d"),
    (10, "ÄÖ über straße " * 30, "de", None),
    (10, "ÄÖ über straße " * 30, "de", None),
    (None, "no id here at all, but six words", "en", "a"),
    (11, "\n".join(f"line number {i} of a text that goes on" for i in range(12)), "en", "b"),
    (12, "own\n" + "\n".join(f"line number {i} of a text that goes on" for i in range(12)) + "\nend", "en", "b"),
]
SCHEMA = "doc_id long, text string, lang string, source string"
CLASHES = "id row size key digest text_key runs lines deleted_lines shard slot taken target part at place times held_out score bucket n".split()


@pytest.fixture(scope="session")
def edge(spark):
    """Rows with nulls, empty and long texts, ties and repeats, and columns whose names operators use themselves."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(TEXTS, SCHEMA)
    return df.withColumns({c: F.lit(7) for c in CLASHES})


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"
