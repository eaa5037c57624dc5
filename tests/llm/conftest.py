import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Documents with every awkward case: nulls, empties, ties, copies, long texts, clashing extra columns."""
    def make(texts, sources=None, extra=False):
        rows = [(i, t, "en", (sources or [None, "a", "b", "é"])[i % len(sources or "abcd")], len(t or "")) for i, t in enumerate(texts)]
        df = spark.createDataFrame(rows, DOCS)
        if extra:
            from pyspark.sql import functions as F
            for name in ("size", "shard", "fp", "recipe", "n", "u", "v", "_salt", "_block", "kept", "label", "copies"):
                df = df.withColumn(name, F.lit("x"))
        return df
    return make
