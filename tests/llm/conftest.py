import pytest

from rowlens.llm.common import prepare

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id int, value string, n_words string"


@pytest.fixture(scope="session")
def llm(spark):
    return prepare(spark)


@pytest.fixture(scope="session")
def make(llm):
    """Documents of (doc_id, text[, source]) with extra columns whose names the operators use inside."""

    def build(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), 7, "x", "y") for r in rows]
        return llm.createDataFrame(full, SCHEMA)

    return build


WORDS = [f"w{i}" for i in range(400)]


def text(start, n):
    return " ".join(WORDS[(start * 37 + 7 * i + i * i) % 400] for i in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, ties and repeated rows."""
    long = text(1, 30_000)
    return [
        (1, text(3, 60), "a"),
        (2, None, "a"),
        (3, "", None),
        (4, " \n\t ", None),
        (5, long, "b"),
        (6, long + " more", "b"),
        (7, text(3, 60), "a"),
        (7, text(3, 60), "a"),
        (None, text(3, 60), "a"),
        (9, "one two", "c"),
        (10, "one two", "c"),
        (11, text(9, 40) + "\n" + text(3, 60) + "\nplain line", "c"),
    ]
