"""Every query that SQL can express against its twin, the others for one row per input row; the registry itself."""

import pytest
from oracle_check import compare, duck

import __spark_entry__ as entry_module
from larkspur import llm

FOLDER = "/root/testdata/sf0.001"
TABLE = {"op7": "pages", "op9": "conversations"}


def test_operators_and_pipeline():
    numbers = sorted(int(n[2:].split("_")[0]) for n in llm.QUERIES)
    assert numbers == list(range(1, 14))
    assert set(llm.QUERIES) <= set(entry_module.queries()) and "pipeline" in entry_module.queries()
    assert set(llm.SQL) <= set(entry_module.oracle_sql())


@pytest.mark.parametrize("name", sorted(llm.SQL))
def test_same_as_sql(spark, name):
    assert compare(llm.QUERIES[name](spark, FOLDER), duck(FOLDER), llm.SQL[name]) is None


#: Queries on conversations; their own tests hold them against brute force.
CONVERSATIONS = {n for n in llm.QUERIES if n.startswith(("op11", "op12"))}


@pytest.mark.parametrize("name", sorted(set(llm.QUERIES) - set(llm.SQL) - CONVERSATIONS))
def test_a_row_for_each_document(spark, name):
    ids = sorted(r[0] for r in llm.QUERIES[name](spark, FOLDER).select("doc_id").collect())
    assert ids == sorted(r[0] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id").collect())
