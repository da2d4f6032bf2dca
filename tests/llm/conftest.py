import tempfile

import pytest


@pytest.fixture
def table(spark):
    """Writes rows as Parquet and reads them back, so that plans begin with a scan."""

    def make(rows, schema):
        at = "file://" + tempfile.mkdtemp()
        spark.createDataFrame(rows, schema).coalesce(2).write.mode("overwrite").parquet(at)
        return spark.read.parquet(at)

    return make


DOCS = "doc_id long, text string, lang string, source string, n_chars long"
