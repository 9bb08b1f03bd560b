"""White space, encoded names and stream sources made of several files."""

from framesift.catalog import streams
from framesift.operators.validation import numbered_lines
from framesift.sources.documents import file_path


def test_lines_of_tabs_are_blank(spark):
    files = spark.createDataFrame([("train", "a", "0 1\n\t\n \t \r\n \n1 2\t")], "split string, stem string, text string")
    assert [(r["line_no"], r["line"]) for r in numbered_lines(files).collect()] == [(1, "0 1"), (2, "1 2")]


def test_paths_are_decoded(spark, tmp_path):
    names = ["a b.txt", "a+b.txt", "50%.txt", "%41.txt", "场景.txt"]
    for name in names:
        (tmp_path / name).write_text("x")
    found = {r["p"] for r in spark.read.text(str(tmp_path)).select(file_path().alias("p")).collect()}
    assert found == {str(tmp_path / name) for name in names}


def test_stream_reads_a_folder_of_parts(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    for folder in (str(tmp_path), "/root/testdata/sf0.001"):
        assert streams._drain(streams._arriving(spark, folder)).count() == events.count()
