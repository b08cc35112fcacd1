"""The link as a written table, part by part."""

import os

import pytest
from pyspark.sql import functions as F

from linkqueries.queries import QUERIES
from privlink.operators.link import link_by_interval
from privlink.plans.parts import link_in_parts

from .test_scale import _people, _plan, _shuffle_files

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("part_bytes", [1 << 30, 400])
def test_parts_give_the_rows_of_the_link(spark, workdir, part_bytes):
    m, c = _people(spark)
    m, c = m.union(m.limit(3)), c.union(c.limit(2))  # keys that repeat, and none
    before = _shuffle_files(spark)
    key = F.col("k")
    out = link_in_parts(m, c, f"{workdir}/linked", condition_key=key, part_bytes=part_bytes)
    assert not _shuffle_files(spark) - before and os.listdir(workdir) == ["linked"]  # what was staged is gone
    whole = link_by_interval(m, c, condition_key=key)
    assert out.schema.names == whole.schema.names and _rows(out) == _rows(whole)
    less = link_in_parts(m, c, f"{workdir}/less", condition_key=key, part_bytes=part_bytes, then=lambda x: x.drop("k"))
    assert _rows(less) == _rows(whole.drop("k"))


def test_keys_of_other_types_meet_in_every_part(spark, workdir):
    m = spark.sql("SELECT id AS filename, DATE'2020-01-02' AS created_at FROM range(50)")
    c = spark.sql("SELECT CAST(id AS int) AS k, DATE'2020-01-01' AS assertedDate, DATE'2020-01-03' AS abatementDate FROM range(0, 50, 2)")
    out = link_in_parts(m, c, f"{workdir}/linked", condition_key=F.col("k"), part_bytes=100)
    assert out.count() == 50 and out.where("k = filename").count() == 25


@pytest.mark.parametrize("name", ["hashed_copy_hmac", "link_mixed_spans"])
def test_a_copy_is_made_when_the_shuffles_of_the_link_are_gone(spark, name):
    before = _shuffle_files(spark)
    df = QUERIES[name](spark, SF)
    assert not [x for x in _plan(df) if x.startswith("Exchange")] and not _shuffle_files(spark) - before
    assert df.count() > 0


def test_a_stream_holds_the_shuffles_of_one_batch(spark, monkeypatch):
    from linkqueries import queries
    from privlink.session import conf_of, shared_dir

    monkeypatch.setattr(queries, "STREAM_BATCH_BYTES", 20_000)
    top = shared_dir(spark).removeprefix("file:")
    old, before = set(os.listdir(top)), _shuffle_files(spark)
    with conf_of(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"):
        df = QUERIES["stream_link_report_murmur3"](spark, SF)
    assert not _shuffle_files(spark) - before
    (ckpt,) = [x for x in set(os.listdir(top)) - old if x.startswith("stream-ckpt")]
    assert len([x for x in os.listdir(f"{top}/{ckpt}/commits") if x.isdigit()]) > 1
    assert _rows(df) == _rows(QUERIES["exposure_report_murmur3"](spark, SF))
