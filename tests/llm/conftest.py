import pathlib
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session", autouse=True)
def shared_folder(spark, tmp_path_factory):
    """The folder that a cluster would name in spark.checkpoint.dir."""
    spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))


@pytest.fixture
def documents(spark):
    """Makes a documents table from (doc_id, text) or (doc_id, text, source)."""

    def make(*rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture(scope="session")
def table(spark):
    return lambda name: spark.read.parquet(f"{DATA}/{name}.parquet")


@pytest.fixture
def awkward(documents):
    """Nulls, empty and blank texts, repeated rows, a null and a repeated doc_id, a very long text, columns that clash."""
    long = " ".join(f"w{i % 977}" for i in range(60_000)) + "\n" + "same line here\n" * 500
    rows = [
        (1, None), (2, ""), (3, " \n\t "), (4, "one two three four five six seven"), (4, "one two three four five six seven"),
        (None, "one two three four five six seven"), (5, long), (6, long), (7, "x"), (8, "é" * 70 + "\x00  ß"),
        (8, "another text under the same id " * 5), (9, "### $$$ %%% | | |"), (10, "line\nline\nline\r\nline"),
    ]
    df = documents(*rows)
    clash = ("key", "node", "line", "key_", "bucket", "shard", "block", "n", "at", "found", "first", "x", "score", "__key", "tag", "n_lines")
    for name in clash:
        df = df.withColumn(name, F.lit("clash"))
    return df
