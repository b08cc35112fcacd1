"""CSV hand-offs (A5-A7) and trap T5."""

from privlink.schemas import MESSAGES
from privlink.sources.files import read_csv, write_csv

ROWS = [
    ("1", "a", "a", "Thu May 06 12:00:00 +0000 2010", "line one\nline two", "f1"),
    ("2", "b", "b", "x", "  outer blanks  ", "f2"),
    ("3", "c", "c", "x", 'quote " and \\ backslash, comma', "f3"),
    ("4", "d", "d", "x", "", "f4"),
    ("5", "e", "e", "x", None, "f5"),
    ("6", "\\N", "\\n", "\\s", "a\r\nb\rc\\\\nd\\", '"'),
]


def test_safe_round_trip(spark, workdir):
    df = spark.createDataFrame(ROWS, MESSAGES)
    write_csv(df, workdir + "/m")
    back = read_csv(spark, workdir + "/m", MESSAGES)
    got = sorted(map(tuple, back.collect()), key=lambda r: r[0])
    # newlines, quotes, backslashes, outer blanks and empty text survive
    assert got == sorted(ROWS, key=lambda r: r[0])


def test_a_safe_file_has_a_line_for_each_row(spark, workdir):
    df = spark.createDataFrame(ROWS, MESSAGES)
    write_csv(df, workdir + "/m", single_file=True)
    assert spark.read.text(workdir + "/m").count() == len(ROWS) + 1  # and the header


def test_original_dialect_splits_newlines(spark, workdir):
    """The original jobs' options turn a message with a line end into broken rows."""
    df = spark.createDataFrame(ROWS, MESSAGES)
    write_csv(df, workdir + "/m", dialect="original")
    assert read_csv(spark, workdir + "/m", MESSAGES, dialect="original").count() > len(ROWS)


def test_original_dialect_reads_what_the_original_jobs_wrote(spark, workdir):
    rows = [("1", "a", "a", "x", 'quote " and comma, end', "f1"), ("2", "b", "b", "x", "  blanks  ", "f2"), ("3", "c", "c", "x", "", "f3")]
    spark.createDataFrame(rows, MESSAGES).write.csv(workdir + "/m", header=True)
    got = sorted(map(tuple, read_csv(spark, workdir + "/m", MESSAGES, dialect="original").collect()))
    assert [r[4] for r in got] == ['quote " and comma, end', "blanks", None]


def test_single_file(spark, workdir):
    df = spark.createDataFrame(ROWS, MESSAGES).repartition(3)
    write_csv(df, workdir + "/one", single_file=True)
    import glob

    assert len(glob.glob(workdir + "/one/part-*.csv")) == 1
