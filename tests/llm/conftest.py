import pytest
from pyspark.sql import types as T

DOCUMENT = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("score", T.StringType()), T.StructField("node", T.StringType())]
)

EN = "the house of the old man stands by the river and the boats wait for their people every morning"
FR = "la maison du vieux monsieur est au bord de la rivière où les bateaux attendent les gens chaque matin"
DE = "das haus des alten mannes steht am fluss und die boote warten jeden morgen auf ihre leute dort"
ES = "la casa del hombre viejo está junto al río y los barcos esperan a su gente todas las mañanas"


def rows_of(texts, **columns):
    """Documents with the clashing columns score and node."""
    return [
        (i, t, columns.get("lang", {}).get(i), columns.get("source", {}).get(i, "s"), None if t is None else len(t), "x", "y") for i, t in enumerate(texts)
    ]


@pytest.fixture(scope="session")
def docs(spark):
    def make(rows):
        return spark.createDataFrame(rows, DOCUMENT)

    return make


@pytest.fixture(scope="session")
def hard(docs):
    """Nulls in every column, empty, wordless and long texts, ties, repeated rows and columns with clashing names."""
    long = " ".join(f"word{i % 977} and{i}" for i in range(150_000))
    rows = rows_of([EN, FR, DE, ES, "", None, "!!!", "!!!", EN, "Hi", "a\n\nb\n" + EN, long], lang={0: "en", 1: "fr", 2: "de", 3: "es", 8: "en"})
    rows += [rows[0], rows[0], (None, EN, None, None, None, None, None), (None, None, None, None, None, None, None)]
    return docs(rows)


@pytest.fixture(scope="session")
def none(docs):
    return docs([])
