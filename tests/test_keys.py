"""File-name key from a path URI (A4, G3, G4, T12, T13) and the built key (D3)."""

from pyspark.sql import functions as F

from privlink.functions.keys import encode_file_name, file_name_from_path, person_file_key


def _names(spark, paths):
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    return [r[0] for r in df.select(file_name_from_path("p")).collect()]


def test_last_segment_decoded_any_depth(spark):
    got = _names(
        spark,
        [
            "hdfs:///DataSet1/social/Ann_Lee_1TwitterData.json",
            "file:/a/b/c/d/e/f/g/h/Bo_Diaz%20Ruiz_2TwitterData.json",
            "s3a://bucket/x/Customer%23000000001_SEG_1TwitterData.json",
            "file:/x/A+B_C_3TwitterData.json",  # '+' is literal in a path
            "file:/x/bad%zz_4TwitterData.json",  # malformed escape kept as is
            "file:/x/%20padded%20",  # outer blanks trimmed
            "plainname.json",
            None,
        ],
    )
    assert got == [
        "Ann_Lee_1TwitterData.json",
        "Bo_Diaz Ruiz_2TwitterData.json",
        "Customer#000000001_SEG_1TwitterData.json",
        "A+B_C_3TwitterData.json",
        "bad%zz_4TwitterData.json",
        "padded",
        "plainname.json",
        None,
    ]


def test_encode_then_decode_is_identity(spark):
    names = ["Ann Lee#1 100% sure?", "plain", "a+b"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    back = df.select(file_name_from_path(F.concat(F.lit("file:/x/"), encode_file_name("n")))).collect()
    assert [r[0] for r in back] == names


def test_person_key(spark):
    df = spark.createDataFrame([("Ann", "Lee", "1"), (None, "Lee", "1"), (None, None, None)], "g string, f string, i string")
    got = [r[0] for r in df.select(person_file_key("g", "f", "i")).collect()]
    assert got == ["Ann_Lee_1TwitterData.json", "Lee_1TwitterData.json", "TwitterData.json"]


def test_folder_values_as_spark_writes_them(spark, workdir):
    """Names with characters that the folder and the file URI each escape."""
    from privlink.functions.keys import folder_value_from_path

    names = ["Ann Lee +50%_1", "a/b=c:d?e", "%41", "100%", "#1 'x' {y}", "é日本", " outer ", "plain", None]
    df = spark.createDataFrame([(n, str(i)) for i, n in enumerate(names)], "person string, value string")
    df.write.partitionBy("person").text(f"{workdir}/t")
    rows = spark.read.text(f"{workdir}/t").select("value", folder_value_from_path("_metadata.file_path", "person").alias("person"), folder_value_from_path("_metadata.file_path", "other").alias("other")).collect()
    assert {int(r["value"]): r["person"] for r in rows} == dict(enumerate(names))
    assert all(r["other"] is None for r in rows)


def test_the_innermost_folder_counts(spark):
    from privlink.functions.keys import folder_value_from_path

    df = spark.createDataFrame([("file:/p=1/x/p=2%253D/part-0",), ("file:/xp=1/f",), (None,)], "u string")
    assert [r[0] for r in df.select(folder_value_from_path("u", "p")).collect()] == ["2=", None, None]
