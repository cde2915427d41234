import pytest

from graphloom.llm import queries
from tests.conftest import SMALL


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query_agrees_with_its_sql(same, name):
    same(queries, name)


def test_columns_of_found_queries(spark):
    want = {
        "p1_found": [("batch_no", "int"), ("workflow_id", "string")],
        "p5_found": [("structural_hash_a", "string"), ("structural_hash_b", "string")],
        "p6_found": [("item_kind", "string"), ("item_a", "string"), ("item_b", "string")],
        "p7_found": [("field", "string"), ("term", "string"), ("mark", "string")],
        "p8_found": [("doc_id", "bigint"), ("item_id", "bigint")],
        "p10_found": [("doc_id", "bigint"), ("kind", "string"), ("found_text", "string")],
    }
    assert {n: queries.QUERIES[n](spark, SMALL).dtypes for n in want} == want
