import pytest

EDGE_SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, kept string, n_words string, hits string, items int, "
    "measured_all string, rejected_host string, row string, licenses string, license_row string, hit_labels string, class_id string, h string, k string"
)
LONG = "lorem ipsum dolor sit amet " * 4000


@pytest.fixture(scope="session")
def edges(spark):
    """Nulls in every column, empty and long texts, repeated rows, columns of any name."""
    rest = (None,) * 14
    rows = [
        (1, None, "en", "a", 0, *rest), (2, "", None, None, None, *rest), (3, " \n\t ", "en", "a", 3, *rest), (4, "!!! ???", "en", "b", 7, *rest),
        (5, "one", "en", "a", 3, *rest), (5, "one", "en", "a", 3, *rest), (None, "two words", "en", "a", 9, *rest), (None, "two words", "en", "a", 9, *rest),
        (6, LONG, "la", "b", len(LONG), *rest), (7, "z" * 30_000, "xx", "b", 30_000, *rest), (8, "Über Straße 漢字 😀 'll it's\r\n\0x", "de", "a", 1, *rest),
    ]
    return spark.createDataFrame(rows, EDGE_SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], EDGE_SCHEMA)
