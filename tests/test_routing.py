import pytest

from framelake.plans import catalog


@pytest.fixture
def tables(spark, tmp_path):
    fine = dict(l_discount=0.1, l_partkey=41, l_quantity=5.0, l_linenumber=1)
    rows = [fine | {"l_suppkey": s, "l_orderkey": 75 * o} for s in range(5) for o in (1, 50, 73)]  # frames 2, 51, 74
    rows[2]["l_partkey"] = 80  # frame 74 of sequence 0: no height
    rows[4]["l_partkey"] = 12 * 40 + 11  # frame 51 of sequence 1: class 11
    spark.createDataFrame(rows, "l_discount double, l_partkey long, l_quantity double, l_linenumber long, l_suppkey long, l_orderkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(k, f"c{k}", k) for k in (0, 1, 2, 3)], "c_custkey long, c_name string, c_nationkey int").write.parquet(f"{tmp_path}/customer.parquet")
    return str(tmp_path)


def test_route_looks_at_all_rows_faults_and_stamps(spark, tables):
    out = catalog.QUERIES["I11_routing_all_rows"](spark, tables)
    want = {"seq00": "rebuild", "seq01": "rebuild", "seq02": "profile", "seq03": "validate", "seq04": "profile"}
    assert {r.sequence: r.route for r in out.collect()} == want
