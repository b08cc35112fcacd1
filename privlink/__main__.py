"""Command line: the original six programs as steps over one base folder.

    spark-submit --py-files privlink.zip scripts/privlink_job.py conditions --base hdfs:///linkage --bundles ...
    python -m privlink messages --base DIR --messages DIR [--lines]
    python -m privlink link --base DIR [--strict-dates]
    python -m privlink privacy --base DIR (--write-key | --key-env VAR) [--hash hmac-sha256 --hash-key-env VAR]
    python -m privlink analysis --base DIR --kind hash|encrypt
    python -m privlink all --base DIR --bundles DIR --messages DIR (--write-key | --key-env VAR)

``--format csv`` writes CSV hand-offs (default: parquet), with
``--csv-dialect original`` as the original jobs wrote and read them. The
session comes from spark-submit (cluster settings are not set here); only
the settings the jobs rely on (UTC zone, adaptive execution) are applied.
The encryption key comes from the environment variable of --key-env, or is
made and written beside the data with --write-key. It is never printed, and
encryption refuses to start if neither keeps it.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import SparkSession

from .operators.privacy import new_key
from .plans.jobs import Hop, job_analysis, job_conditions, job_link, job_messages, job_privacy, run_jobs
from .session import configure
from .sources.files import DIALECTS, read_bundles, read_message_docs, read_message_lines, read_resources


def main(argv: list[str] | None = None) -> dict:
    p = argparse.ArgumentParser(prog="privlink")
    p.add_argument("step", choices=["conditions", "messages", "link", "privacy", "analysis", "all"])
    p.add_argument("--base", required=True, help="folder holding the hand-off tables")
    p.add_argument("--bundles", help="folder of clinical bundle documents")
    p.add_argument("--messages", help="folder of message documents")
    p.add_argument("--lines", action="store_true", help="message files are JSON lines")
    p.add_argument("--resources", action="store_true", help="clinical files hold one resource per line (NDJSON)")
    p.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    p.add_argument("--csv-dialect", default="safe", choices=sorted(DIALECTS), help="of CSV hand-offs")
    p.add_argument("--strict-dates", action="store_true", help="stop on text that is no date")
    p.add_argument("--keep-stage", action="store_true", help="keep the parsed clinical resources")
    p.add_argument("--hash", default="murmur3", choices=["murmur3", "hmac-sha256"])
    p.add_argument("--hash-key-env", help="environment variable holding the hashing key")
    p.add_argument("--key-env", help="environment variable holding the Fernet key")
    p.add_argument("--write-key", action="store_true", help="write the key beside the data")
    p.add_argument("--kind", choices=["hash", "encrypt"])
    a = p.parse_args(argv)
    if a.step in ("privacy", "all") and not (a.write_key or a.key_env):
        p.error("give --key-env or --write-key: a key that is kept nowhere makes the encrypted copy unreadable")

    spark = configure(SparkSession.builder.appName(f"privlink-{a.step}").getOrCreate())
    hop = Hop(spark, a.base, a.format, a.csv_dialect)
    hash_key = os.environ[a.hash_key_env].encode("utf-8") if a.hash_key_env else None
    key = os.environ[a.key_env] if a.key_env else None

    def docs():
        return read_message_lines(spark, a.messages) if a.lines else read_message_docs(spark, a.messages)

    if a.step == "conditions":
        src = read_resources(spark, a.bundles) if a.resources else read_bundles(spark, a.bundles)
        return job_conditions(hop, src, resources=a.resources, keep_stage=a.keep_stage)
    if a.step == "messages":
        return job_messages(hop, docs())
    if a.step == "link":
        return job_link(hop, strict_dates=a.strict_dates)
    if a.step == "privacy":
        return job_privacy(hop, key or new_key(), hash_algo=a.hash, hash_key=hash_key, write_key=a.write_key)
    if a.step == "analysis":
        if not a.kind:
            p.error("analysis needs --kind")
        return job_analysis(hop, a.kind)
    res = run_jobs(
        spark, a.bundles, a.messages, a.base, messages_as_lines=a.lines, resources_per_line=a.resources,
        key=key, hop_format=a.format,
        hash_algo=a.hash, hash_key=hash_key, write_key=a.write_key, csv_dialect=a.csv_dialect,
        strict_dates=a.strict_dates, keep_stage=a.keep_stage,
    )
    return res.paths


if __name__ == "__main__":
    for name, path in main().items():
        print(f"{name}\t{path}")
