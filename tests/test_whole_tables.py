"""Queries read whole tables: they have the rows of their SQL without its bounds on ids."""

import re

import pytest
from parity import differences, duck

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
BOUND = re.compile(r"\b\w*(?:key|event_id) ?< ?[0-9]{3,4}\b")
SQL = {k: q for k, q in entry.oracle_sql().items() if not re.match("op[0-9]", k)}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_no_sql_has_a_bound_on_ids():
    assert [k for k, q in SQL.items() if BOUND.search(q)] == []


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, con, name):
    assert differences(entry.queries()[name](spark, SF), SQL[name], con) == []


def test_customers_of_late_orders_are_used(spark, tmp_path):
    spark.createDataFrame([(1,), (2,), (3,)], "c_custkey long").write.parquet(str(tmp_path / "customer.parquet"))
    spark.createDataFrame([(7, 1), (1_000_000, 2)], "o_orderkey long, o_custkey long").write.parquet(str(tmp_path / "orders.parquet"))
    q = entry.queries()
    assert [r[0] for r in q["unused_dim"](spark, str(tmp_path)).collect()] == [3]
    assert sorted(r[0] for r in q["used_dim"](spark, str(tmp_path)).collect()) == [1, 2]


def test_best_strength_reads_every_part(spark, tmp_path):
    names = {1: "red bolt", 2: "bolt red", 3: "red ring", 1000: "red", 1001: "red", 1002: "blue", 1003: "ring", 5000: "blue"}
    spark.createDataFrame(list(names.items()), "p_partkey long, p_name string").write.parquet(str(tmp_path / "part.parquet"))
    got = {r["p_partkey"]: (r["strength"], r["other"]) for r in entry.queries()["best_strength"](spark, str(tmp_path)).collect()}
    want = {}
    for k, n in names.items():
        if k % 3 < 2:
            a, found = set(n.split()), []
            for o, m in names.items():
                b = set(m.split())
                x, y = a - {"ring"}, b - {"ring"}
                if o % 3 == 2 and a & b and (a == b or x and y and (x <= y or y <= x)):
                    found.append((a != b and x != y, o, m))
            if found:
                far, _, m = min(found)
                want[k] = ("contained" if far else "exact", m)
    assert got == want and any(k >= 1000 for k in got)
