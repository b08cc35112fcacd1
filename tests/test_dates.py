"""Date parsing (G9, G10) and traps T6, T10."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from privlink.functions.dates import clinical_day, message_day


def _one(spark, fn, text, **kw):
    return spark.createDataFrame([(text,)], "s string").select(fn("s", **kw).alias("d")).first()["d"]


def test_message_day(spark):
    assert _one(spark, message_day, "Sat Dec 14 07:24:08 +0000 2009") == dt.date(2009, 12, 14)
    assert _one(spark, message_day, "Mon Jan 4 23:59:59 +0000 2010") == dt.date(2010, 1, 4)
    assert _one(spark, message_day, None) is None


def test_message_day_is_utc_day(spark):
    # other offsets are converted to the UTC day, independent of session zone
    assert _one(spark, message_day, "Sat Dec 14 23:30:00 -0200 2009") == dt.date(2009, 12, 15)
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert _one(spark, message_day, "Sat Dec 14 01:00:00 +0000 2009") == dt.date(2009, 12, 14)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_clinical_day_keeps_local_day(spark):
    """T6: the written local day, offset cut, not applied."""
    assert _one(spark, clinical_day, "2010-05-06T23:30:00-04:00") == dt.date(2010, 5, 6)
    assert _one(spark, clinical_day, "2010-05-06") == dt.date(2010, 5, 6)
    assert _one(spark, clinical_day, "2010-5-6") == dt.date(2010, 5, 6)


def test_lenient_and_strict(spark):
    """T10: bad text is NULL by default; strict mode fails the job."""
    for bad in ("2010-05", "junk", ""):
        assert _one(spark, clinical_day, bad) is None
    assert _one(spark, message_day, "junk") is None
    with pytest.raises(Exception):
        _one(spark, clinical_day, "junk", strict=True)
    with pytest.raises(Exception):
        _one(spark, message_day, "junk", strict=True)
    assert _one(spark, clinical_day, None, strict=True) is None
