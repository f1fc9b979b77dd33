"""Operators that SQL can express, against DuckDB."""
import pytest

import __spark_entry__ as E
from oracle_check import check, duck

SF = "/root/testdata/sf0.001"
NAMES = ["op3_topk_search", "op6_line_dedup", "op9_decontamination", "op12_collocations"]


def test_every_operator_has_a_query():
    names = [n for n in E.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, len(names) + 1))
    assert "pipeline" in E.queries()
    assert [n for n in E.oracle_sql() if n in names] == NAMES


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_duckdb(spark, name):
    r = check(spark, duck(SF), SF, name, E.queries()[name], E.oracle_sql()[name])
    assert r["cols"] and r["exact"], r
