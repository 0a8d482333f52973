import pytest

pytest.importorskip("scanloom.llm")

from scanloom.llm.queries import ORACLES, QUERIES
from tests.oracle import SF, compare


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_oracle(spark, name):
    compare(spark, QUERIES[name], ORACLES[name])


def test_whole_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").count()
    for name in ("op5_licenses", "op7_toxicity", "op10_mixing"):
        assert QUERIES[name](spark, SF).count() == docs
