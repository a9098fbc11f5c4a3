import pytest

HARD = [(900001, None), (900002, ""), (900003, " \n\t "), (900004, "a b c a b c a b x"), (900005, "a B"), (900006, "A  b\n"),
        (None, "a\nb\na\n"), (900007, "word " * 3000), (900007, "word " * 3000), (900008, "é日本語 \x1c <|endoftext|> it's!"),
        (900009, "mail a@b.co_x@d.e ip 1.2.3.4.5 300.1.1.1 card 4111 1111 1111 1111, 4111-1111-1111-1112 "
                 "tel +1 (519) 555-5645 iban GB82 WEST 1234 5698 7654 32 password=f48865c76c86ee5394")]


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    """The documents table with hard rows and a column whose name clashes."""
    from pyspark.sql import functions as F
    d = spark.read.parquet(f"{sf_dir}/documents.parquet")
    extra = spark.createDataFrame([(i, t, None, None, None) for i, t in HARD], d.schema)
    return d.unionByName(extra).withColumn("_t", F.lit(1)).withColumn("row", F.lit("x")).cache()


@pytest.fixture(scope="session")
def rows(docs):
    return [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)
