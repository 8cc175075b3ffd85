import pytest
from pyspark.sql import functions as F

#: Null and empty texts, blanks, repeated rows, a null id, ties, a long text.
ROWS = [
    (1, "the cat sat on the mat\nand it was happy with that\nthe end of the story", "en"),
    (2, None, "en"),
    (3, "", None),
    (4, " \t\n ", "en"),
    (5, "the cat sat on the mat\nand it was happy with that\nthe end of the story", "en"),
    (5, "the cat sat on the mat\nand it was happy with that\nthe end of the story", "en"),
    (None, "le chat est sur la table avec les autres chats du quartier", "fr"),
    (7, "le chat est sur la table avec les autres chats du quartier", "fr"),
    (8, "word " * 30_000, None),
    (9, "1234 5678 !!", "fr"),
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Documents with every odd case, and columns whose names the operators use inside."""
    df = spark.createDataFrame(ROWS, "doc_id long, text string, lang string")
    for clash in ("source", "fp", "pos", "n", "line", "component_id", "sequence_id", "k1", "score", "word", "key", "next", "n_lines", "n_deleted", "lines", "start", "place", "fold", "copies", "items", "diagonals"):
        df = df.withColumn(clash, F.lit("x"))
    return df.withColumn("n_chars", F.length("text").cast("long"))


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def small_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark, small_dir):
    return spark.read.parquet(f"{small_dir}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r.doc_id: r.text for r in documents.collect()}
