"""Path expressions (top cluster, combination, head replacement)."""

from pyspark.sql import functions as F

from flowstrata.functions import paths as PT


def test_cl_top_and_friends(spark):
    df = spark.createDataFrame([("1:2:3",), ("12",), (None,)], "cl string")
    got = [tuple(r) for r in df.select(
        PT.cl_top("cl"), PT.path_replace_head("cl", F.lit("9")), PT.path_depth("cl")).collect()]
    assert got[0] == ("1", "9:2:3", 3)
    assert got[1] == ("12", "9", 1)
    assert got[2][0] is None


def test_combined_or_original(spark):
    df = spark.createDataFrame([("3:1", "3", "2:1"), ("4:2", "4", None)], "cl string, top string, sub string")
    got = [r[0] for r in df.select(PT.combined_or_original("cl", "top", "sub")).collect()]
    assert got == ["3:2:1", "4:2"]


def test_zero_padded_names(spark):
    df = spark.createDataFrame([(3, 12, "7")], "r long, w int, top string")
    got = df.select(PT.cluster_file_name("r", "w", "net", "top")).first()[0]
    assert got.startswith("000000000003_net_cluster-7")
