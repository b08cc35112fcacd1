"""The six batch jobs end to end, folder to folder.

Each job reads the previous job's written table, so every hand-off cuts
lineage: a lost executor re-runs one job's tasks from a written table, never
the whole chain from the raw documents. Hand-offs are parquet by default
(columnar, typed, column pruning in later jobs; small row groups, so that the
next scan splits); ``hop_format="csv"`` writes the original CSV layouts, in a
dialect that keeps every text or in the original one. Only per-code reports
and one-row tables are written as single files.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.analysis import exposure_counts, report_of_counts, stats_of_counts, told_apart
from ..operators.flatten import (
    conditions_from_resources,
    flatten_conditions,
    flatten_messages,
    flatten_patients,
    patient_conditions,
    patients_from_resources,
    resources_of,
)
from ..operators.link import link_by_interval
from ..operators.privacy import encrypt_columns, hash_columns, key_record, new_key, spread
from ..schemas import CONDITIONS, LINKED, MESSAGES, PERSONAL_COLUMNS, protected
from ..session import joins_by_measured_size
from ..sources.files import (
    DIALECTS,
    drop_path,
    read_bundles,
    read_resources,
    read_csv,
    read_message_docs,
    read_message_lines,
    write_csv,
    write_parquet,
)

# Fixed folder names of the hand-off tables.
PATIENTS = "patientsDFData"
SOCIAL = "social-media-usersDFData"
JOINED = "joinedDFData"
HASHED = "hashedDFData"
ENCRYPTED = "encryptedDFData"
KEY = "KEY"
RESOURCES_STAGE = "_resources"  # parsed clinical resources, always parquet
COUNTS_STAGE = "_counts-{kind}"  # rows of a copy merged by code, user and record, always parquet
ANALYSIS = "analysis-{kind}"
ANALYSIS_STATS = "analysis-{kind}-stats"

@dataclass
class JobsResult:
    out_dir: str
    key: str | None = None
    paths: dict = field(default_factory=dict)


class Hop:
    """The hand-off tables under one base folder. ``dialect`` is that of CSV
    hand-offs; "original" reads what the original jobs left, and is read by them."""

    def __init__(self, spark: SparkSession, out_dir: str, fmt: str, dialect: str = "safe"):
        if fmt not in ("parquet", "csv"):
            raise ValueError("hop_format must be 'parquet' or 'csv'")
        if dialect not in DIALECTS:
            raise ValueError(f"csv dialect must be one of {sorted(DIALECTS)}")
        self.spark, self.out, self.fmt, self.dialect = spark, out_dir.rstrip("/"), fmt, dialect

    def path(self, name: str) -> str:
        return f"{self.out}/{name}"

    def write(self, df: DataFrame, name: str, small: bool = False) -> str:
        p = self.path(name)
        with joins_by_measured_size(self.spark):
            if self.fmt == "csv":
                write_csv(df, p, single_file=small, dialect=self.dialect)
            else:
                write_parquet(df, p, single_file=small)
        return p

    def read(self, name: str, schema) -> DataFrame:
        p = self.path(name)
        if self.fmt == "csv":
            return read_csv(self.spark, p, schema, self.dialect)
        return self.spark.read.schema(schema).parquet(p)

    def drop(self, name: str) -> None:
        """Delete a hand-off folder."""
        drop_path(self.spark, self.path(name))


def run_jobs(
    spark: SparkSession,
    bundles_path: str,
    messages_path: str,
    out_dir: str,
    *,
    messages_as_lines: bool = False,
    resources_per_line: bool = False,
    **kw,
) -> JobsResult:
    """Flatten -> link -> hashed and encrypted copies -> analysis of each,
    from the clinical and message folders. ``resources_per_line`` reads the
    clinical folder as one resource per line (bulk-export NDJSON) instead of
    bundle documents. See ``run_jobs_on`` for the other options."""
    b = read_resources(spark, bundles_path) if resources_per_line else read_bundles(spark, bundles_path)
    docs = read_message_lines(spark, messages_path) if messages_as_lines else read_message_docs(spark, messages_path)
    return run_jobs_on(spark, b, docs, out_dir, resources=resources_per_line, **kw)


def run_jobs_on(
    spark: SparkSession,
    bundles: DataFrame,
    message_docs: DataFrame,
    out_dir: str,
    *,
    key: str | None = None,
    hop_format: str = "parquet",
    hash_algo: str = "murmur3",
    hash_key: bytes | None = None,
    write_key: bool = False,
    resources: bool = False,
    csv_dialect: str = "safe",
    strict_dates: bool = False,
    keep_stage: bool = False,
) -> JobsResult:
    """The jobs over bundle and message-document frames (``path`` column).

    The key is generated when not given and returned to the caller; it is
    written next to the data only with ``write_key=True``. Every hand-off has
    the original layout. ``strict_dates`` stops on date text that is no date,
    as the original jobs did; else such a message stays unmatched.
    """
    hop = Hop(spark, out_dir, hop_format, csv_dialect)
    res = JobsResult(out_dir=out_dir)
    res.paths.update(job_conditions(hop, bundles, resources=resources, keep_stage=keep_stage))
    res.paths.update(job_messages(hop, message_docs))
    res.paths.update(job_link(hop, strict_dates=strict_dates))
    res.key = key or new_key()
    res.paths.update(job_privacy(hop, res.key, hash_algo=hash_algo, hash_key=hash_key, write_key=write_key))
    for kind in ("hash", "encrypt"):
        res.paths.update(job_analysis(hop, kind))
    return res


# -- the jobs, one per original program; each reads and writes under one base folder


def job_conditions(hop: Hop, bundles: DataFrame, resources: bool = False, stage: bool = True, keep_stage: bool = False) -> dict:
    """1A: clinical bundles (or resource rows) -> patient-condition table.

    Both sides of the patient-condition join come from the same documents.
    With ``stage`` the Condition and Patient resources are parsed once and
    written as a columnar staging table, which the two sides then read with
    column pruning, instead of parsing the JSON twice. The staging table holds
    clear clinical data; it is deleted after the join unless ``keep_stage``.
    """
    out = {}
    if stage:
        rows = bundles.filter(F.col("resourceType").isin("Condition", "Patient")) if resources else resources_of(bundles)
        p = hop.path(RESOURCES_STAGE)
        write_parquet(rows, p)
        bundles, resources = hop.spark.read.schema(rows.schema).parquet(p), True
    if resources:
        pc = patient_conditions(conditions_from_resources(bundles), patients_from_resources(bundles))
    else:
        pc = patient_conditions(flatten_conditions(bundles), flatten_patients(bundles))
    pc = pc.withColumn("code", F.col("code").try_cast("long"))
    out["patients"] = hop.write(pc, PATIENTS)
    if stage and keep_stage:
        out["resources"] = hop.path(RESOURCES_STAGE)
    elif stage:
        hop.drop(RESOURCES_STAGE)
    return out


def job_messages(hop: Hop, message_docs: DataFrame) -> dict:
    """1B: message documents -> message table."""
    return {"messages": hop.write(flatten_messages(message_docs), SOCIAL)}


def job_link(hop: Hop, strict_dates: bool = False) -> dict:
    """2: messages + conditions -> linked table."""
    linked = link_by_interval(hop.read(SOCIAL, MESSAGES), hop.read(PATIENTS, CONDITIONS), strict_dates=strict_dates)
    # even files, so that the privacy step, which costs most, has even tasks
    return {"joined": hop.write(spread(linked, joined=True), JOINED)}


def job_privacy(
    hop: Hop,
    key: str,
    *,
    hash_algo: str = "murmur3",
    hash_key: bytes | None = None,
    write_key: bool = False,
) -> dict:
    """3: linked table -> hashed copy, encrypted copy (and key record).

    A row of the written linked table is known by its place there, so equal
    rows get tokens of their own on every hand-off format.
    """
    joined = hop.read(JOINED, LINKED)
    out = {"hashed": hop.write(hash_columns(joined, PERSONAL_COLUMNS, algo=hash_algo, key=hash_key), HASHED)}
    out["encrypted"] = hop.write(encrypt_columns(joined, key, PERSONAL_COLUMNS), ENCRYPTED)
    if write_key:
        out["key"] = hop.write(key_record(hop.spark, key, _dt.date.today()), KEY, small=True)
    return out


def job_analysis(hop: Hop, kind: str) -> dict:
    """4A (``kind="hash"``) / 4B (``kind="encrypt"``): report and stats."""
    folder, suffix = {"hash": (HASHED, "_hashed"), "encrypt": (ENCRYPTED, "_encrypted")}[kind]
    uid, rec = f"SynSocial_UID{suffix}", f"Synthea_UID{suffix}"
    # one scan of the copy: report and stats both follow from its merged rows, in which
    # users and records are only told apart, so tokens are neither moved nor written again
    counts = exposure_counts(told_apart(hop.read(folder, protected(suffix)), uid, rec), uid, rec)
    stage = hop.path(COUNTS_STAGE.format(kind=kind))
    write_parquet(counts, stage)
    counts = hop.spark.read.schema(counts.schema).parquet(stage)
    out = {
        f"analysis-{kind}": hop.write(report_of_counts(counts, uid), ANALYSIS.format(kind=kind), small=True),
        f"analysis-{kind}-stats": hop.write(stats_of_counts(counts, uid, rec), ANALYSIS_STATS.format(kind=kind), small=True),
    }
    hop.drop(COUNTS_STAGE.format(kind=kind))
    return out
