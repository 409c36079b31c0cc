from pyspark.sql import functions as F

from framelake.operators.tracks import six_digits


def test_numbers_are_formatted_once_and_as_six_digits(spark):
    values = [0.0, 1.0, 100000.0, 123456.0, 0.5, 1.05, 10.5, 1234.5, 99999.96, 1e-4, 0.00012345, 9.5e-5, 1e-10, 123456.7, 1e6, 2.5e9, -0.25, -1e-7, 1 / 3, 200.0, 0.1002003]
    out = spark.createDataFrame([(v,) for v in values], "v double").select("v", six_digits(F.col("v")).alias("t"))
    assert [r.t for r in out.collect()] == ["%.6g" % v for v in values]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("%.5e") == 1
