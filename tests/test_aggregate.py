import random

import pytest

from framelake.operators import aggregate as A
from pyspark.sql import functions as F


def test_a_users_aggregate_is_the_same_for_any_split(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["hot"] * 8 + ["a", None]), rng.choice([None, -1.0, 0.0, rng.lognormvariate(3, 2)])) for _ in range(2000)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = set()
    for parts, kept, fan_in in ((1, 100_000, 32), (7, 1, 2), (40, 2, 3)):
        out = A.user_aggregate(df.repartition(parts), ["k"], A.Quantiles("v", [0.0, 0.5, 0.9, 1.0]), "n bigint, low double, mid double, high double, top double", kept, fan_in)
        got.add(tuple(sorted((tuple(r) for r in out.collect()), key=repr)))
    assert len(got) == 1
    for k, n, *estimates in got.pop():
        v = sorted(x for key, x in rows if key == k and x is not None and x > 0)
        assert n == len(v)
        for q, e in zip((0.0, 0.5, 0.9, 1.0), estimates, strict=True):
            assert abs(e - v[int(q * (n - 1))]) <= 0.0100001 * v[int(q * (n - 1))]
    assert A.user_aggregate(df.limit(0), ["k"], A.Quantiles("v", [0.5]), "n bigint, p double").count() == 0
    none = A.user_aggregate(df.where("v <= 0"), ["k"], A.Quantiles("v", [0.5]), "n bigint, p double").collect()
    assert {(r.n, r.p) for r in none} == {(0, None)}


def test_table_hash_follows_rows_and_not_their_order(spark):
    rng = random.Random(4)
    rows = [(rng.randrange(5), rng.choice(["x", "", None, "1:2,", "-"])) for _ in range(200)]
    schema = "a int, b string"
    one = lambda rows, parts=3: tuple(A.table_hash(spark.createDataFrame(rows, schema).repartition(parts)).first())
    base = one(rows)
    assert one(rng.sample(rows, len(rows)), 11) == base and base[0] == 200
    assert A.table_hash(spark.createDataFrame(rows, schema).select("b", "a")).first().table_hash == base[1]
    others = {one([*rows, rows[0]])[1], one([*rows, rows[0], rows[0]])[1], one(rows[1:])[1], one([(9, "x"), *rows[1:]])[1], base[1]}
    assert len(others) == 5
    assert one([(1, None)])[1] != one([(1, "")])[1] != one([(1, "-")])[1]
    assert tuple(A.table_hash(spark.createDataFrame([], schema)).first()) == (0, "0-0")


@pytest.mark.parametrize("copied", [70, 69])
def test_counters_come_with_the_pass(spark, copied):
    rows, seen = A.counted(spark.range(100).repartition(5), kept=F.col("id") < 70, empty=F.col("id") >= 90, copied=F.col("id") < copied)
    assert rows.groupBy().sum("id").first()[0] == 4950
    assert seen.get == {"kept": 70, "empty": 10, "copied": copied}
    assert len(A.copied_as_kept(seen.get)) == 70 - copied
