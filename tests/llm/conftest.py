import pytest
from pyspark.sql import functions as F

from llm_samples import CLASHES, ODD_ROWS


@pytest.fixture(scope="session")
def odd_docs(spark):
    docs = spark.createDataFrame(
        ODD_ROWS, "doc_id bigint, text string, lang string, source string, n_chars bigint, extra string"
    )
    return docs.withColumns({c: F.lit("clash") for c in CLASHES}).coalesce(2)


@pytest.fixture(scope="session")
def odd_labels(spark):
    return spark.createDataFrame(
        [(1, 1, 0), (2, None, 1), (6, 1, 0), (6, 0, 1), (None, 1, 1), (9, 0, None), (99, 1, 0)],
        "doc_id bigint, quality int, toxic int",
    )
