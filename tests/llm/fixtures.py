"""Rows and tables that the tests of this folder share; tests import the fixtures by name."""

import pytest

SMALL = "/root/testdata/sf0.001"

PROSE = (
    "the quick brown fox jumps over a lazy dog while seven wizards brew potions near the old stone bridge and "
    "nobody in town remembers when the last ferry crossed that river under such heavy autumn rain or why it sank "
    "although some claim that lanterns still glow below"
)


def awkward_rows():
    """(doc_id, text, lang, source): nulls, empties, a very long text, ties and repeated rows."""
    long_text = " ".join(f"w{k % 997}x{k % 31}" for k in range(60_000))
    return [
        (1, PROSE, "en", "a"),
        (2, PROSE.upper(), "en", "a"),
        (3, PROSE + " tail", "en", "b"),
        (4, None, "en", "a"),
        (5, "", None, None),
        (6, " \n\t ", "en", "a"),
        (7, "one two", "de", "a"),
        (8, "ONE  two", "de", "a"),
        (9, "é ü x   y", "de", None),
        (10, long_text, "en", "a"),
        (11, "same same same same\nsame same same same", None, "b"),
        (12, PROSE, "en", "a"),
        (12, PROSE, "en", "a"),
        (None, "no id here", "en", "a"),
        (13, "line\r\n line \nLINE\n\nend", "en", "c"),
    ]


SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="session")
def awkward(spark):
    """The awkward rows, with further columns whose names the operators use themselves."""
    frame = spark.createDataFrame(awkward_rows(), SCHEMA)
    clashing = ["kept", "component_id", "spans", "low", "windows", "anchor", "position", "size", "cell", "range",
                "bucket", "weight", "vertex", "n_words", "keep_bitmap", "owner_id", "id", "place", "quality"]
    for name in clashing:
        frame = frame.selectExpr("*", f"'x' AS {name}")
    return frame


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")
