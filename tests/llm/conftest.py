import pytest

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    """All rows of the smallest documents table, by doc_id."""
    return [
        (r["doc_id"], r["text"])
        for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").orderBy("doc_id").collect()
    ]


@pytest.fixture(scope="session")
def odd_rows(spark):
    """Nulls, empty and long texts, ties, repeated rows, a clashing column."""
    rows = [
        (1, None, "x"),
        (2, "", "x"),
        (3, "   \n\t ", "x"),
        (4, "one two three", "x"),
        (5, "One two three", None),
        (6, "word " * 60_000, "x"),
        (7, "tail\x00 byte é ß 日本 😀\n\nlast", "x"),
        (7, "tail\x00 byte é ß 日本 😀\n\nlast", "x"),
        (None, "one two three", "x"),
        (None, None, None),
        (8, "12345 %% ..", "x"),
    ]
    return spark.createDataFrame(rows, "doc_id bigint, text string, shard string")
