"""Registered queries over the test tables and their DuckDB oracle SQL.

Every query reads the given tables (or frames Spark derives from them) in
full, so its work grows with the scale factor. Names describe what runs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from privlink.functions.crypto import HMAC_BLOCK, HMAC_IPAD, HMAC_OPAD, new_key
from privlink.functions.dates import clinical_day, message_day
from privlink.operators.analysis import distinct_bitmaps, exposure_report, exposure_stats, merge_bitmaps, stats_of_bitmaps, told_apart, user_code_counts
from privlink.operators.flatten import (
    conditions_from_resources,
    flatten_conditions,
    flatten_messages,
    flatten_patients,
    patient_conditions,
    patients_from_resources,
    resources_of,
)
from privlink.operators.lineage import dangling_edges, lineage_datasets, lineage_edges
from privlink.operators.link import link_by_interval
from privlink.operators.privacy import decrypt_columns, encrypt_columns, hash_columns, key_record, spread
from privlink.plans.jobs import run_jobs_on
from privlink.plans.parts import link_in_parts
from privlink.schemas import PERSONAL_COLUMNS, REPORT, STATS
from privlink.session import joins_by_measured_size, scratch_path, shuffles_released
from privlink.sources.files import packed, read_bundles, read_csv, read_lineage_docs, read_message_docs, read_message_lines, read_resources, write_csv, write_docs, write_json, write_parquet
from privlink.streaming.incremental import link_stream

from . import testdata as td
from .murmur_sql import hashed_select

# Fixed demonstration key of the keyed-hash queries (the oracle needs it).
DEMO_HASH_KEY = b"privlink-demo-hash-key"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def linked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_by_interval(td.messages(spark, sf_dir), td.conditions(spark, sf_dir))


def linked_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The linked rows as a written table. A whole copy of them is about as large as the shuffles of
    the link, which are gone by the time the copy is made of the table."""
    return link_in_parts(td.messages(spark, sf_dir), td.conditions(spark, sf_dir), scratch_path(spark, "linked"))


# -- SQL helpers -------------------------------------------------------------


def _with_linked(body: str) -> str:
    return f"WITH linked AS ({td.LINKED_SQL})\n{body}"


def _round2(num: str, den: str) -> str:
    # Spark rounds the double's shortest decimal text HALF_UP; do the same.
    return (
        f"CAST(round(CAST(CAST(CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE) AS VARCHAR) "
        f"AS DECIMAL(38,17)), 2) AS DOUBLE)"
    )


def _report_sql(users: str, source: str = "linked") -> str:
    return _with_linked(
        f"""
, per_code AS (
  SELECT code, {users} AS users, count(*) AS msgs
  FROM {source} WHERE code IS NOT NULL GROUP BY code)
SELECT CAST(users AS FLOAT) AS User_Count, code AS Medical_Codes,
       CAST(msgs AS FLOAT) AS Message_Count, {_round2('msgs', 'users')} AS Avg_Msg_per_User
FROM per_code"""
    )


# users = groups of (uid, code): distinct non-NULL ids plus one NULL group
_GROUP_USERS = "count(DISTINCT SynSocial_UID) + max(CASE WHEN SynSocial_UID IS NULL THEN 1 ELSE 0 END)"
# with a fresh IV per row every non-NULL token is its own group
_ROW_USERS = "count(SynSocial_UID) + max(CASE WHEN SynSocial_UID IS NULL THEN 1 ELSE 0 END)"


def _stats_sql(users: str, records: str) -> str:
    return _with_linked(
        f"""
SELECT CAST({users} AS BIGINT) AS "Social-Media-Users",
       CAST({records} AS BIGINT) AS "Medical-Records",
       CAST(count(DISTINCT code) AS BIGINT) AS "Medical-Codes"
FROM linked"""
    )


def _hmac_sql(col: str, key: bytes) -> str:
    k = key.ljust(HMAC_BLOCK, b"\0")
    ipad = bytes(b ^ HMAC_IPAD for b in k).hex()
    opad = bytes(b ^ HMAC_OPAD for b in k).hex()
    return f"sha256(unhex('{opad}') || unhex(sha256(unhex('{ipad}') || encode({col}))))"


_CLEAR_COLS = [
    "created_at", "text", *td.MESSAGE_ID, "display", "code", "assertedDate",
    "abatementDate", "condition_id",
]

# -- link ----------------------------------------------------------------------

register("link_by_interval", f"SELECT * FROM ({td.LINKED_SQL})")(linked)

# -- analysis on the clear copy -----------------------------------------------


@register("exposure_report_clear", _report_sql(_GROUP_USERS))
def _report_clear(spark, sf_dir):
    return exposure_report(linked(spark, sf_dir))


@register(
    "exposure_stats_clear",
    _stats_sql("count(DISTINCT SynSocial_UID)", "count(DISTINCT Synthea_UID)"),
)
def _stats_clear(spark, sf_dir):
    return exposure_stats(linked(spark, sf_dir))


@register(
    "user_code_counts",
    _with_linked(
        'SELECT SynSocial_UID, code, count(*) AS "count" FROM linked '
        "WHERE code IS NOT NULL GROUP BY SynSocial_UID, code"
    ),
)
def _user_code_counts(spark, sf_dir):
    return user_code_counts(linked(spark, sf_dir))


# -- hashed copies ------------------------------------------------------------


@register(
    "hashed_copy_hmac",
    _with_linked(
        "SELECT "
        + ", ".join(_CLEAR_COLS)
        + ", "
        + ", ".join(f"{_hmac_sql(c, DEMO_HASH_KEY)} AS {c}_hashed" for c in PERSONAL_COLUMNS)
        + " FROM linked"
    ),
)
def _hashed_hmac(spark, sf_dir):
    return hash_columns(linked_table(spark, sf_dir), algo="hmac-sha256", key=DEMO_HASH_KEY)


@register("exposure_report_hmac", _report_sql(_GROUP_USERS))
def _report_hmac(spark, sf_dir):
    h = hash_columns(linked(spark, sf_dir), algo="hmac-sha256", key=DEMO_HASH_KEY)
    return exposure_report(h, uid="SynSocial_UID_hashed")


@register(
    "exposure_stats_hmac",
    _stats_sql("count(DISTINCT SynSocial_UID)", "count(DISTINCT Synthea_UID)"),
)
def _stats_hmac(spark, sf_dir):
    h = hash_columns(linked(spark, sf_dir), algo="hmac-sha256", key=DEMO_HASH_KEY)
    return exposure_stats(h, uid="SynSocial_UID_hashed", record="Synthea_UID_hashed")


_MURMUR_COPY_SQL = hashed_select("linked", _CLEAR_COLS, PERSONAL_COLUMNS)


@register("hashed_copy_murmur3", _with_linked(_MURMUR_COPY_SQL))
def _hashed_murmur3(spark, sf_dir):
    return hash_columns(linked(spark, sf_dir), algo="murmur3")


# murmur3 maps NULL to 42, so an unmatched row's NULL record id is one more
# distinct "record" (T1); collisions, if any, are reproduced too.
@register(
    "exposure_report_murmur3",
    _with_linked(
        f""", hashed AS ({_MURMUR_COPY_SQL}),
per_code AS (
  SELECT code, count(DISTINCT SynSocial_UID_hashed) AS users, count(*) AS msgs
  FROM hashed WHERE code IS NOT NULL GROUP BY code)
SELECT CAST(users AS FLOAT) AS User_Count, code AS Medical_Codes,
       CAST(msgs AS FLOAT) AS Message_Count, {_round2('msgs', 'users')} AS Avg_Msg_per_User
FROM per_code"""
    ),
)
def _report_murmur3(spark, sf_dir):
    h = hash_columns(linked(spark, sf_dir), algo="murmur3")
    return exposure_report(h, uid="SynSocial_UID_hashed")


_STATS_MURMUR_SQL = _with_linked(
    f""", hashed AS ({_MURMUR_COPY_SQL})
SELECT CAST(count(DISTINCT SynSocial_UID_hashed) AS BIGINT) AS "Social-Media-Users",
       CAST(count(DISTINCT Synthea_UID_hashed) AS BIGINT) AS "Medical-Records",
       CAST(count(DISTINCT code) AS BIGINT) AS "Medical-Codes"
FROM hashed"""
)


@register("exposure_stats_murmur3", _STATS_MURMUR_SQL)
def _stats_murmur3(spark, sf_dir):
    h = hash_columns(linked(spark, sf_dir), algo="murmur3")
    return exposure_stats(h, uid="SynSocial_UID_hashed", record="Synthea_UID_hashed")


@register("exposure_stats_murmur3_bitmaps", _STATS_MURMUR_SQL)
def _stats_bitmaps(spark, sf_dir):
    """Bitmaps of the hashed copy for each month, merged to those of the whole copy."""
    uid, record = "SynSocial_UID_hashed", "Synthea_UID_hashed"
    h = hash_columns(linked(spark, sf_dir), algo="murmur3").withColumn("month", F.trunc("created_at", "month"))
    monthly = distinct_bitmaps(h, (uid, record, "code"), by=("month",))
    return stats_of_bitmaps(merge_bitmaps(monthly), uid, record)


# -- encrypted copy -------------------------------------------------------------


def linked_rows(spark, sf_dir) -> DataFrame:
    """The linked table in even partitions, as the link job writes it: every test
    table is a single row group, hence one scan task, and encryption costs far more than the shuffle."""
    return spread(linked(spark, sf_dir), joined=True)


def encrypted(spark, sf_dir, key: str | None = None) -> DataFrame:
    return encrypt_columns(linked_rows(spark, sf_dir), key or new_key(), row_id_cols=td.LINKED_ROW_ID)


@register("exposure_report_encrypted", _report_sql(_ROW_USERS))
def _report_encrypted(spark, sf_dir):
    return exposure_report(encrypted(spark, sf_dir), uid="SynSocial_UID_encrypted")


@register("exposure_stats_encrypted", _stats_sql("count(SynSocial_UID)", "count(Synthea_UID)"))
def _stats_encrypted(spark, sf_dir):
    return exposure_stats(
        encrypted(spark, sf_dir), uid="SynSocial_UID_encrypted", record="Synthea_UID_encrypted"
    )


# deterministic tokens: equal values share a token, so the report equals the
# clear one
@register("exposure_report_encrypted_deterministic", _report_sql(_GROUP_USERS))
def _report_encrypted_det(spark, sf_dir):
    e = encrypt_columns(linked_rows(spark, sf_dir), new_key(), row_id_cols=td.LINKED_ROW_ID, deterministic=True)
    return exposure_report(e, uid="SynSocial_UID_encrypted")


@register(
    "exposure_stats_encrypted_deterministic",
    _stats_sql("count(DISTINCT SynSocial_UID)", "count(DISTINCT Synthea_UID)"),
)
def _stats_encrypted_det(spark, sf_dir):
    e = encrypt_columns(linked_rows(spark, sf_dir), new_key(), row_id_cols=td.LINKED_ROW_ID, deterministic=True)
    return exposure_stats(e, uid="SynSocial_UID_encrypted", record="Synthea_UID_encrypted")


@register(
    "encrypt_decrypt_roundtrip",
    _with_linked("SELECT *, true AS tokens_valid FROM linked"),
)
def _roundtrip(spark, sf_dir):
    key = new_key()
    enc = encrypt_columns(linked_rows(spark, sf_dir), key, row_id_cols=td.LINKED_ROW_ID)
    return decrypt_columns(enc, key, check_column="tokens_valid")


@register("key_record_roundtrip", _with_linked("SELECT *, true AS tokens_valid FROM linked"))
def _key_record(spark, sf_dir):
    """Encrypted copy and key record written; the copy opened with the key as read back."""
    key, copy, record = new_key(), scratch_path(spark, "encrypted"), scratch_path(spark, "key")
    write_parquet(encrypt_columns(linked_table(spark, sf_dir), key, row_id_cols=td.LINKED_ROW_ID), copy)
    write_parquet(key_record(spark, key), record, single_file=True)
    return decrypt_columns(spark.read.parquet(copy), spark.read.parquet(record), check_column="tokens_valid")


@register(
    "encrypted_token_uniqueness",
    _with_linked(
        "SELECT count(SynSocial_UID) AS user_tokens, count(Synthea_UID) AS record_tokens, "
        "count(*) AS n_rows FROM linked"
    ),
)
def _token_uniqueness(spark, sf_dir):
    e = told_apart(encrypted(spark, sf_dir), "SynSocial_UID_encrypted", "Synthea_UID_encrypted")
    return e.agg(
        F.count_distinct("SynSocial_UID_encrypted").alias("user_tokens"),
        F.count_distinct("Synthea_UID_encrypted").alias("record_tokens"),
        F.count(F.lit(1)).alias("n_rows"),
    )


# -- nested inputs: flatten, parse, link ---------------------------------------


_COND_COMMON = f"""
       strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '{td.CLINICAL_ZONE}' AS assertedDate,
       CASE WHEN o_orderstatus = 'O' THEN NULL
            ELSE strftime(CAST(o_orderdate AS DATE) + CAST(o_orderkey % {td.SPELL_MODULUS} AS INTEGER), '%Y-%m-%d')
                 || '{td.ABATEMENT_TIME}' END AS abatementDate,
       CASE WHEN o_orderkey % 2 = 0 THEN 'urn:uuid:' ELSE 'Patient/' END || CAST(o_custkey AS VARCHAR) AS reference,
       CAST(o_orderkey AS VARCHAR) AS condition_id"""

FLAT_CONDITIONS_SQL = f"""
SELECT o_orderpriority AS display, CAST(o_orderkey % {td.CODE_MODULUS} AS VARCHAR) AS code, {_COND_COMMON}
FROM orders WHERE o_orderkey % {td.NO_CODING_MOD} <> 0
UNION ALL
SELECT o_orderpriority || ' (secondary)' AS display,
       CAST(o_orderkey % {td.CODE_MODULUS} + {td.SECOND_CODE_OFFSET} AS VARCHAR) AS code, {_COND_COMMON}
FROM orders WHERE o_orderkey % {td.NO_CODING_MOD} <> 0 AND o_orderkey % {td.TWO_CODINGS_MOD} = 0
"""

FLAT_PATIENTS_SQL = f"""
SELECT CASE WHEN c_custkey % {td.NULL_GIVEN_MOD} = 0 THEN NULL ELSE c_name END AS Given_Name,
       CAST(c_custkey AS VARCHAR) AS Identifier, CAST(c_custkey AS VARCHAR) AS id,
       c_mktsegment AS Family_Name
FROM customer WHERE c_custkey % {td.NO_NAME_MOD} <> 0
"""

PATIENT_CONDITIONS_SQL = f"""
SELECT c.display, c.code, c.assertedDate, c.abatementDate, p.Given_Name, p.Identifier,
       p.id AS Synthea_UID, p.Family_Name, c.condition_id
FROM ({FLAT_CONDITIONS_SQL}) c JOIN ({FLAT_PATIENTS_SQL}) p
  ON regexp_replace(c.reference, '^(urn:uuid:|Patient/)', '') = p.id
"""

_FILE_NAME_SQL = "c_name || '_' || c_mktsegment || '_' || CAST(c_custkey AS VARCHAR) || 'TwitterData.json'"

FLAT_MESSAGES_SQL = f"""
SELECT CAST(o_custkey AS VARCHAR) AS SynSocial_UID, c_name AS name, lower(c_name) AS screen_name,
       strftime(l_shipdate + to_hours(CAST((l_linenumber * 3) % 24 AS BIGINT)), '%a %b %d %H:%M:%S +0000 %Y')
         AS created_at,
       l_returnflag || l_linestatus AS text,
       {_FILE_NAME_SQL} AS filename
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
"""

# a document per order: a message's place is that of its line item
PLACED_MESSAGES_SQL = FLAT_MESSAGES_SQL.replace(
    "AS filename",
    f"""AS filename, '{td.MESSAGE_FOLDER}' || CAST(o_orderkey AS VARCHAR) || '/'
         || replace(replace(replace(replace({_FILE_NAME_SQL}, '%', '%25'), ' ', '%20'), '#', '%23'), '?', '%3F') AS source_path,
       row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate) - 1 AS message_pos""",
)

NESTED_LINKED_SQL = f"""
SELECT m.SynSocial_UID, m.name, m.screen_name, CAST(l_shipdate AS DATE) AS created_at, m.text, m.filename,
       c.display, TRY_CAST(c.code AS BIGINT) AS code,
       CAST(substr(c.assertedDate, 1, 10) AS DATE) AS assertedDate,
       CAST(substr(c.abatementDate, 1, 10) AS DATE) AS abatementDate,
       c.Given_Name, c.Identifier, c.Synthea_UID, c.Family_Name, c.condition_id
FROM (SELECT CAST(o_custkey AS VARCHAR) AS SynSocial_UID, c_name AS name, lower(c_name) AS screen_name,
             l_shipdate, l_returnflag || l_linestatus AS text, {_FILE_NAME_SQL} AS filename
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey) m
LEFT JOIN ({PATIENT_CONDITIONS_SQL}) c
  ON m.filename = concat_ws('_', c.Given_Name, c.Family_Name, c.Identifier) || 'TwitterData.json'
 AND CAST(substr(c.assertedDate, 1, 10) AS DATE) <= CAST(m.l_shipdate AS DATE)
 AND CAST(m.l_shipdate AS DATE) <= CAST(substr(c.abatementDate, 1, 10) AS DATE)
"""


def _nested_conditions(spark, sf_dir):
    b = td.bundles(spark, sf_dir)
    return patient_conditions(flatten_conditions(b, with_id=True), flatten_patients(b))


def _nested_messages(spark, sf_dir):
    return flatten_messages(td.message_docs(spark, sf_dir))


def nested_linked(spark, sf_dir):
    c = _nested_conditions(spark, sf_dir).withColumn("code", F.col("code").try_cast("long"))
    return link_by_interval(_nested_messages(spark, sf_dir), c)


register("flatten_conditions", FLAT_CONDITIONS_SQL)(
    lambda spark, sf_dir: flatten_conditions(td.bundles(spark, sf_dir), with_id=True)
)
register("flatten_patients", FLAT_PATIENTS_SQL)(lambda spark, sf_dir: flatten_patients(td.bundles(spark, sf_dir)))
register("patient_conditions", PATIENT_CONDITIONS_SQL)(_nested_conditions)
register("flatten_messages", PLACED_MESSAGES_SQL)(
    lambda spark, sf_dir: flatten_messages(td.message_docs(spark, sf_dir), with_position=True)
)


@register(
    "message_days",
    f"SELECT SynSocial_UID, created_at, CAST(l_shipdate AS DATE) AS day FROM ({FLAT_MESSAGES_SQL.replace('AS filename', 'AS filename, l_shipdate')})",
)
def _message_days(spark, sf_dir):
    m = _nested_messages(spark, sf_dir)
    return m.select("SynSocial_UID", "created_at", message_day("created_at").alias("day"))


@register(
    "clinical_days",
    f"""SELECT condition_id, assertedDate, CAST(substr(assertedDate, 1, 10) AS DATE) AS asserted_day,
       abatementDate, CAST(substr(abatementDate, 1, 10) AS DATE) AS abatement_day
FROM ({FLAT_CONDITIONS_SQL})""",
)
def _clinical_days(spark, sf_dir):
    c = flatten_conditions(td.bundles(spark, sf_dir), with_id=True)
    return c.select(
        "condition_id",
        "assertedDate",
        clinical_day("assertedDate").alias("asserted_day"),
        "abatementDate",
        clinical_day("abatementDate").alias("abatement_day"),
    )


register("link_from_nested", NESTED_LINKED_SQL)(nested_linked)


# JSON lines written by Spark and read back through the library's readers


@register("json_roundtrip_messages", f"SELECT * EXCLUDE (filename) FROM ({FLAT_MESSAGES_SQL})")
def _json_messages(spark, sf_dir):
    path = scratch_path(spark, "json-messages")
    write_json(td.message_docs(spark, sf_dir).select(F.inline("messages")), path)
    return flatten_messages(read_message_lines(spark, path)).drop("filename")


@register("json_roundtrip_resources", PATIENT_CONDITIONS_SQL)
def _json_resources(spark, sf_dir):
    path = scratch_path(spark, "json-resources")
    write_json(resources_of(td.bundles(spark, sf_dir), kinds=("Condition", "Patient", "Observation")), path)
    r = read_resources(spark, path)
    return patient_conditions(conditions_from_resources(r, with_id=True), patients_from_resources(r))


# documents as files: written by Spark, one file each, and read by the document readers


_BLOCK = f"({{}} // {td.BUNDLE_ORDERS})"
_WHOLE = f"{_BLOCK} % {td.BROKEN_MOD} <> 0"
BUNDLE_DOCUMENTS_SQL = f"""
SELECT c.display, c.code, c.assertedDate, c.abatementDate, p.Given_Name, p.Identifier,
       p.id AS Synthea_UID, p.Family_Name, c.condition_id
FROM ({FLAT_CONDITIONS_SQL}) c JOIN ({FLAT_PATIENTS_SQL}) p
  ON regexp_replace(c.reference, '^(urn:uuid:|Patient/)', '') = p.id
JOIN (SELECT o_custkey, min(o_orderkey) AS first_order FROM orders GROUP BY o_custkey) f ON p.id = CAST(f.o_custkey AS VARCHAR)
WHERE {_WHOLE.format("CAST(c.condition_id AS BIGINT)")} AND {_WHOLE.format("first_order")}
"""


@register("bundle_documents", BUNDLE_DOCUMENTS_SQL)
def _bundle_documents(spark, sf_dir):
    """A bundle per file; every ninth file is broken and gives no resource."""
    path = scratch_path(spark, "bundle-documents")
    write_docs(td.bundle_documents(spark, sf_dir), path)
    r = packed(resources_of(read_bundles(spark, path)), scratch_path(spark, "bundle-resources"))
    return patient_conditions(conditions_from_resources(r, with_id=True), patients_from_resources(r))


_PERSON_SQL = f"c_name || ' +50%_' || c_mktsegment || '_' || CAST(c_custkey AS VARCHAR) || '{td.MESSAGE_FILE_SUFFIX}'"
PERSON_DOCUMENTS_SQL = FLAT_MESSAGES_SQL.replace(_FILE_NAME_SQL, _PERSON_SQL) + f"WHERE (c_custkey + o_orderkey // {td.PERSON_ORDERS}) % {td.BROKEN_MOD} <> 0"


@register("message_documents", PERSON_DOCUMENTS_SQL)
def _message_documents(spark, sf_dir):
    """A folder per person, with a file for each of the person's documents; the file
    name column is the folder's, and broken files give no message."""
    path = scratch_path(spark, "message-documents")
    write_docs(td.person_documents(spark, sf_dir), path, folder="person")
    return flatten_messages(read_message_docs(spark, path), folder="person")


# spells of a day, of 30 years and up to the year 9999, overlapping per person


@register("link_mixed_spans", f"""
SELECT m.*, c.condition_id, c.first_day, c.last_day
FROM (SELECT SynSocial_UID, filename, created_at, {', '.join(td.MESSAGE_ID)} FROM ({td.MESSAGES_SQL})) m
LEFT JOIN ({td.MIXED_SPANS_SQL}) c
  ON m.filename = c.person AND c.first_day <= m.created_at AND m.created_at <= c.last_day
""")
def _mixed_spans(spark, sf_dir):
    m = td.messages(spark, sf_dir).select("SynSocial_UID", "filename", "created_at", *td.MESSAGE_ID)
    c = td.mixed_spans(spark, sf_dir)
    return link_in_parts(
        m, c, scratch_path(spark, "mixed-spans"), condition_key=F.col("person"), start="first_day", end="last_day", then=lambda linked: linked.drop("person")
    )


@register(
    "exposure_report_from_nested",
    _report_sql(_GROUP_USERS, source="nested").replace("WITH linked AS (", f"WITH nested AS ({NESTED_LINKED_SQL}), linked AS (", 1),
)
def _report_nested(spark, sf_dir):
    return exposure_report(hash_columns(nested_linked(spark, sf_dir), algo="murmur3"), uid="SynSocial_UID_hashed")


# -- lineage documents ----------------------------------------------------------------

LINEAGE_DATASETS_SQL = """
SELECT 'customer_' || CAST(c_custkey AS VARCHAR) || '@sf' AS qualifiedName, c_name AS name,
       c_name || ' folder' AS displayName, c_mktsegment AS description, 'hdfs' AS owner,
       c_custkey * 1000 AS createTime, make_timestamp(c_custkey * 1000 * 1000) AS created
FROM customer
UNION ALL
SELECT 'order_' || CAST(o_orderkey AS VARCHAR) || '@sf', 'order ' || CAST(o_orderkey AS VARCHAR),
       NULL, o_orderpriority, 'hdfs', epoch_ms(o_orderdate), o_orderdate
FROM orders
"""

LINEAGE_EDGES_SQL = """
SELECT 'job_' || CAST(o_orderkey AS VARCHAR) || '@sf' AS process, 'job-' || CAST(o_orderkey AS VARCHAR) || '.py' AS process_name,
       'input' AS direction, 'customer_' || CAST(o_custkey AS VARCHAR) || '@sf' AS dataset,
       'g-c-' || CAST(o_custkey AS VARCHAR) AS guid, 'hdfs_folder' AS dataset_type
FROM orders
UNION ALL
SELECT 'job_' || CAST(o_orderkey AS VARCHAR) || '@sf', 'job-' || CAST(o_orderkey AS VARCHAR) || '.py',
       'output', 'order_' || CAST(o_orderkey AS VARCHAR) || CASE WHEN o_orderstatus = 'F' THEN '@sf' ELSE '@elsewhere' END, 'g-o-' || CAST(o_orderkey AS VARCHAR), 'hdfs_folder'
FROM orders
"""

register("lineage_datasets", LINEAGE_DATASETS_SQL)(lambda spark, sf_dir: lineage_datasets(td.lineage_docs(spark, sf_dir)))
register("lineage_edges", LINEAGE_EDGES_SQL)(lambda spark, sf_dir: lineage_edges(td.lineage_docs(spark, sf_dir)))


@register(
    "lineage_dangling_edges",
    f"SELECT * FROM ({LINEAGE_EDGES_SQL}) e WHERE dataset NOT IN (SELECT qualifiedName FROM ({LINEAGE_DATASETS_SQL}))",
)
def _dangling(spark, sf_dir):
    docs = td.lineage_docs(spark, sf_dir)
    return dangling_edges(lineage_edges(docs), lineage_datasets(docs))


@register(
    "lineage_documents_dangling",
    f"SELECT * FROM ({LINEAGE_EDGES_SQL}) e WHERE dataset NOT IN (SELECT qualifiedName FROM ({LINEAGE_DATASETS_SQL}))",
)
def _documents_dangling(spark, sf_dir):
    """The dangling ends in catalogue files that were written and read back."""
    path = scratch_path(spark, "lineage-documents")
    write_docs(td.lineage_documents(spark, sf_dir), path)
    docs = packed(read_lineage_docs(spark, path), scratch_path(spark, "lineage-entities"))
    return dangling_edges(lineage_edges(docs), lineage_datasets(docs))


# -- CSV hand-offs: write, read back with the fixed schema -----------------------------



def _csv_roundtrip(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(spark, name)
    write_csv(df, path)
    return read_csv(spark, path, df.schema)


register("csv_roundtrip_linked", f"SELECT * FROM ({td.LINKED_SQL})")(
    lambda spark, sf_dir: _csv_roundtrip(spark, linked(spark, sf_dir), "csv-linked")
)

# message-like text with newlines, quotes and outer blanks in most rows; some
# texts made empty or NULL by a rule on the key
@register(
    "csv_roundtrip_documents",
    f"SELECT * REPLACE (CASE WHEN doc_id % {td.NULL_TEXT_MOD} = 0 THEN NULL WHEN doc_id % {td.EMPTY_TEXT_MOD} = 0 THEN '' ELSE text END AS text) FROM documents",
)
def _csv_documents(spark, sf_dir):
    text = F.when(F.col("doc_id") % td.NULL_TEXT_MOD == 0, F.lit(None)).when(F.col("doc_id") % td.EMPTY_TEXT_MOD == 0, F.lit("")).otherwise(F.col("text"))
    return _csv_roundtrip(spark, td.table(spark, sf_dir, "documents").withColumn("text", text), "csv-documents")


# -- the six jobs end to end, with written hand-offs ---------------------------------


_NESTED_WITH = f"WITH nested AS ({NESTED_LINKED_SQL}), linked AS ("


def _run_jobs(spark: SparkSession, sf_dir: str, hop_format: str):
    out = scratch_path(spark, f"jobs-{hop_format}")
    return run_jobs_on(spark, td.bundles(spark, sf_dir), td.message_docs(spark, sf_dir), out, hop_format=hop_format)


def _read_result(spark, res, name: str, hop_format: str, schema):
    p = res.paths[name]
    return spark.read.parquet(p) if hop_format == "parquet" else read_csv(spark, p, schema)


_JOBS_REPORT_SQL = _report_sql(_GROUP_USERS, source="nested").replace("WITH linked AS (", _NESTED_WITH, 1)


@register("jobs_report_hash_parquet", _JOBS_REPORT_SQL)
def _jobs_report_parquet(spark, sf_dir):
    return _read_result(spark, _run_jobs(spark, sf_dir, "parquet"), "analysis-hash", "parquet", REPORT)


@register("jobs_report_hash_csv", _JOBS_REPORT_SQL)
def _jobs_report_csv(spark, sf_dir):
    return _read_result(spark, _run_jobs(spark, sf_dir, "csv"), "analysis-hash", "csv", REPORT)


# encrypted copy: one token per linked row on either hand-off
_JOBS_STATS_SQL = _NESTED_WITH.replace(", linked AS (", "") + """
SELECT CAST(count(SynSocial_UID) AS BIGINT) AS "Social-Media-Users",
       CAST(count(Synthea_UID) AS BIGINT) AS "Medical-Records",
       CAST(count(DISTINCT code) AS BIGINT) AS "Medical-Codes"
FROM nested"""


@register("jobs_stats_encrypt_parquet", _JOBS_STATS_SQL)
def _jobs_stats_encrypt(spark, sf_dir):
    return _read_result(spark, _run_jobs(spark, sf_dir, "parquet"), "analysis-encrypt-stats", "parquet", STATS)


@register("jobs_stats_encrypt_csv", _JOBS_STATS_SQL)
def _jobs_stats_encrypt_csv(spark, sf_dir):
    return _read_result(spark, _run_jobs(spark, sf_dir, "csv"), "analysis-encrypt-stats", "csv", STATS)


# -- the link as a Structured Streaming job ------------------------------------------


#: Packed bytes of messages in a micro-batch, whose shuffles go when it is written.
STREAM_BATCH_BYTES = 1 << 30


@register("stream_link_report_murmur3", _report_sql(_GROUP_USERS))
def _stream_link_report(spark, sf_dir):
    """Messages (derived from the tables, written by Spark) arrive as a
    parquet stream; the stream-static link writes hashed rows; the report
    runs over what the stream wrote."""
    src, known = scratch_path(spark, "stream-src"), scratch_path(spark, "stream-conditions")
    msgs, conditions = td.messages(spark, sf_dir), td.conditions(spark, sf_dir)
    with joins_by_measured_size(spark):
        write_parquet(msgs, src)
        write_parquet(conditions, known)
    out = scratch_path(spark, "stream-out")
    stream = spark.readStream.schema(msgs.schema).option("maxBytesPerTrigger", STREAM_BATCH_BYTES).parquet(src)
    with shuffles_released(spark):
        q = link_stream(stream, spark.read.schema(conditions.schema).parquet(known), out, protect="hash",
                        checkpoint=scratch_path(spark, "stream-ckpt"))
        q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return exposure_report(spark.read.parquet(out), uid="SynSocial_UID_hashed")
