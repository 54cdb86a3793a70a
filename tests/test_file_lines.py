"""Line numbers count from 2 in every file, also when Spark reads a file in many splits."""

from shelfmark.operators import validation as v


def test_lines_of_each_file(spark, tmp_path):
    for name, n in (("long", 3000), ("short", 7)):
        folder = tmp_path / name
        folder.mkdir()
        (folder / "part.csv").write_text("i,name\n" + "".join(f"{i},shop {i} {'x' * (i % 13)}\n" for i in range(n)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        files = spark.read.option("header", True).csv(str(tmp_path / "*"))
        assert files.rdd.getNumPartitions() > 5
        got = v.number_lines_per_file(files).select("_file", "i", "row_number").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(got) == 3007
    assert all(r.row_number == int(r.i) + 2 for r in got)
    assert {r._file.rsplit("/", 2)[-2] for r in got} == {"long", "short"}
