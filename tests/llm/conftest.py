from pathlib import Path

import pytest

FOLDER = "/root/testdata/sf0.001"
#: Null ids and texts, empty and one-word texts, repeated rows, ties, a long text, and columns that clash.
ODD = [
    (1, "The quick brown fox jumps over the lazy dog and runs away into the forest again", "en", 5),
    (1, "The quick brown fox jumps over the lazy dog and runs away into the forest again", "en", 5),
    (2, "The quick brown fox jumps over the lazy dog and runs away into the forest again", None, 5),
    (3, "", "en", None), (4, None, "fr", 7), (None, "one", "en", 1), (5, "...", None, None),
    (6, "le chat est dans la maison avec le chien et la souris " * 400, "fr", 9),
    (7, "Été à la mer\n\nñandú 漢字 🙂 naïve", "fr", 2), (8, "1" * 3000, "en", 3), (9, "\t \n", "en", 3),
]
CLASH = ("id", "row", "key", "h", "text_", "spans", "fp", "n", "block", "page", "lang_")


@pytest.fixture(scope="module")
def odd(spark):
    df = spark.createDataFrame(ODD, "doc_id long, text string, lang string, n_chars long")
    for c in CLASH:
        df = df.withColumn(c, df.n_chars)
    return df.repartition(3)


@pytest.fixture(scope="module")
def none(odd):
    return odd.where("false")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.collect()}


def root() -> Path:
    return Path(__file__).resolve().parents[2]
