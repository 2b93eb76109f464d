import pytest

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}


@pytest.fixture(scope="session")
def odd_rows(spark):
    """Nulls, blanks, ties, repeated rows and columns whose names operators use themselves."""
    long = " ".join(f"word{k % 977} tail{k % 31}" for k in range(60_000))
    rows = [
        (1, None, None, None, 5, "x"), (2, "", "en", "s", 0, None), (3, " \t\n ", "en", "s", 3, "y"), (4, "one two three", None, "s", 13, "y"),
        (5, "a b c d e f g h", "en", None, 15, "y"), (6, "A B C D E F G H", "en", "s", 15, "y"), (6, "A B C D E F G H", "en", "s", 15, "y"),
        (7, long, "en", "big", len(long), "y"), (8, "日本語 テスト 😀 <|endoftext|> </s>", "ja", "s", 30, "y"),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long, node string"
    df = spark.createDataFrame(rows, schema)
    for name in ("label", "score", "taken_id", "found_id", "found_spans", "component", "p", "size", "key"):
        df = df.withColumn(name, df["node"])
    return df


@pytest.fixture(scope="session")
def no_rows(odd_rows):
    return odd_rows.where("false")
