import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, block string, rest int, w string, unit string, fp string, score string"


@pytest.fixture(scope="session")
def frame(spark):
    """Documents with extra columns whose names the operators also use inside."""
    def make(rows):
        return spark.createDataFrame(
            [(i, t, "en", "s", len(t) if t is not None else None, "b", 1, "w", "u", "f", "x") for i, t in rows], SCHEMA)

    return make


#: Nulls, blank and empty texts, ties, repeated rows, a repeated id, odd white space, one long text.
EDGE = [(1, "alpha beta gamma delta"), (2, None), (3, ""), (4, "  \t\n "), (5, "alpha beta gamma delta"), (5, "alpha beta gamma delta"),
        (6, "same id one"), (6, "same id two"), (None, "no id at all"), (None, None), (7, "ÉÀ ß 日本  x\x00y  z \n w "),
        (8, " ".join(f"w{k % 977}" for k in range(60000))), (9, "12 34 ### 56")]
