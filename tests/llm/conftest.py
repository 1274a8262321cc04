import pytest

from payloom.llm.packaging import ship_package

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture(scope="session")
def docs(spark):
    """A documents table from (doc_id, text[, source]) rows, with a column whose name operators use inside."""
    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), 1) for r in rows]
        names = ("n_words", "kept", "size", "bucket", "component_id", "node", "quality", "passages", "body", "target", "n", "taken_id", "copy")
        df = spark.createDataFrame(full, SCHEMA + ", n_tokens long")
        return df.selectExpr("*", *(f"n_tokens AS {n}" for n in names))
    return make
