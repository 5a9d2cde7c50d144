"""Every query of the folder against its SQL, on whole tables."""

import pytest
from compare import differences

from silverlode.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, small, duck, name):
    assert differences(QUERIES[name](spark, small), duck, ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - {"op12_negatives"}))
def test_one_row_for_each_of_its_rows(spark, small, name):
    got = QUERIES[name](spark, small)
    key = got.columns[0]
    source = {"doc_id": "documents", "page_id": "pages", "conv_id": "conversations"}[key]
    ids = spark.read.parquet(f"{small}/{source}.parquet").select(key).distinct().count()
    assert got.select(key).distinct().count() == got.count() == ids + (key == "conv_id")
