import duckdb
import public_tokenizers
import pytest
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.fixture(scope="session")
def texts(duck):
    return duck.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()


#: Columns whose names the operators make themselves are among them.
ODD = ["n_words", "kept", "n_lines", "component_id", "spans", "text `x`", "fp"]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and blank texts, a very long text, repeated rows, ties and
    extra columns with clashing names."""
    line = "The same line stands in many documents here."
    rows = [
        (1, None), (2, ""), (3, " \t\n\x0b"), (4, line), (5, line + "\n" + line), (6, "x\n" + line.upper()),
        (6, "x\n" + line.upper()), (7, "word " * 30), (8, "a b"), (9, "é ß   日本 password=abcdefgh12"),
        (None, line), (None, None), (10, "long text of many words, " * 120_000), (11, line + "\n\n"),
    ]
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]
                          + [T.StructField(c, T.StringType()) for c in ODD])
    return spark.createDataFrame([(i, t, *["odd"] * len(ODD)) for i, t in rows], schema)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def word_bpe():
    return public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="session")
def piece_model():
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        return f.read()
