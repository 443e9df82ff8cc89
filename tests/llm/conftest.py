import pytest

WORDS = "the of and to in is that for it was with as on be at by this from or an".split()


@pytest.fixture
def odd_docs(spark):
    """Null, empty, blank, repeated and very long rows, and extra columns with names that operators use themselves."""
    long = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
    rows = [
        (1, None, "en"), (2, "", "en"), (3, " \n\t ", None), (4, "one two three four five six seven eight nine ten", "en"),
        (4, "one two three four five six seven eight nine ten", "en"), (5, long, "xx"), (6, long + " end", None), (None, "no key here", "en"),
        (7, "\n\n\n", "de"), (8, "Größe ▁ 東京 \U0001f600\nline two", "de"),
    ]
    extra = "id long, row long, digest string, bucket long, root long, n long, kept string, nos string, _doc string, doc string, host string, tokens string"
    blank = (9, 9, "x", 9, 9, 9, "x", "x", "x", "x", "x", "x")
    return spark.createDataFrame([r + blank for r in rows], "doc_id long, text string, lang string, " + extra)
