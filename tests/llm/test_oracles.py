"""Queries of the training-data operators that SQL can express, against that SQL."""

import pytest

from compare import duck, duck_rows, spark_rows
from conftest import SF
from tallyforge.llm.oracles import ORACLE_SQL
from tallyforge.llm.queries import QUERIES


@pytest.mark.parametrize("key", ["op1_topk_search", "op3_chat_format", "op7_jaccard_join", "op10_line_dedup"])
def test_oracle(spark, key):
    assert spark_rows(QUERIES[key](spark, SF)) == duck_rows(duck(SF), ORACLE_SQL[key])
