"""Nested inputs to flat tables.

* clinical bundles -> conditions (one row per coding) and patients (first
  identifier, first name, first given name), joined to the patient-condition
  table
* message documents -> one row per message with its source file name
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.keys import file_name_from_path, folder_value_from_path

# Fixed prefixes a FHIR reference or id may carry.
REFERENCE_PREFIX_PATTERN = r"^(urn:uuid:|Patient/)"


def extract_resources(bundles: DataFrame, kind: str) -> DataFrame:
    """One row per bundle entry whose resource is ``kind``; resource fields
    as columns. Entries are filtered inside the array before exploding."""
    wanted = F.filter(F.col("entry"), lambda e: e["resource"]["resourceType"] == F.lit(kind))
    return bundles.select(F.explode(wanted).alias("e")).select("e.resource.*")


def resources_of(bundles: DataFrame, kinds=("Condition", "Patient")) -> DataFrame:
    """All entries of the given kinds as resource rows (one explode). Write
    this once and read it twice to parse the bundles a single time for the
    patient-condition join."""
    wanted = F.filter(F.col("entry"), lambda e: e["resource"]["resourceType"].isin(*kinds))
    return bundles.select(F.explode(wanted).alias("e")).select("e.resource.*")


def flatten_conditions(bundles: DataFrame, with_id: bool = False) -> DataFrame:
    """Columns: display, code, assertedDate, abatementDate, reference.

    One row per coding, code and display of the same coding kept together.
    A condition without codings gives no row. The end date is read from
    ``abatementDateTime`` (raw FHIR) or ``abatement.dateTime``.
    """
    return conditions_from_resources(extract_resources(bundles, "Condition"), with_id)


def conditions_from_resources(resources: DataFrame, with_id: bool = False) -> DataFrame:
    """``flatten_conditions`` over resource rows (e.g. one resource per line);
    rows of other resource types are ignored."""
    c = resources.filter(F.col("resourceType") == "Condition")
    cols = [
        F.col("c.display").alias("display"),
        F.col("c.code").alias("code"),
        "assertedDate",
        F.coalesce(F.col("abatement.dateTime"), F.col("abatementDateTime")).alias("abatementDate"),
        F.col("subject.reference").alias("reference"),
    ]
    if with_id:
        cols.append(F.col("id").alias("condition_id"))
    return c.select(F.explode("code.coding").alias("c"), "*").select(*cols)


def flatten_patients(bundles: DataFrame) -> DataFrame:
    """Columns: Given_Name, Identifier, id, Family_Name.

    First identifier value, family of the first name, first given name of
    the first name. Patients without an identifier, a name, or a given name
    on their first name give no row; a NULL first element is kept.
    """
    return patients_from_resources(extract_resources(bundles, "Patient"))


def patients_from_resources(resources: DataFrame) -> DataFrame:
    """``flatten_patients`` over resource rows; other types are ignored."""
    p = resources.filter(F.col("resourceType") == "Patient")
    first_name = F.get(F.col("name"), 0)
    return p.filter(
        (F.size("identifier") > 0) & (F.size("name") > 0) & (F.size(first_name["given"]) > 0)
    ).select(
        F.get(first_name["given"], 0).alias("Given_Name"),
        F.get(F.col("identifier"), 0)["value"].alias("Identifier"),
        "id",
        first_name["family"].alias("Family_Name"),
    )


def _bare_ref(c):
    return F.regexp_replace(c, REFERENCE_PREFIX_PATTERN, "")


def patient_conditions(conditions: DataFrame, patients: DataFrame) -> DataFrame:
    """Inner join of conditions to their patient.

    Columns: display, code, assertedDate, abatementDate, Given_Name,
    Identifier, Synthea_UID, Family_Name (+ condition_id when present).
    References and ids are compared without ``urn:uuid:`` / ``Patient/``.

    Both sides usually come from the same documents, which are then parsed
    once for each side; write the resources to a table first (``resources_of``,
    as the conditions job does) to parse them once.
    """
    c = conditions.withColumn("__ref", _bare_ref(F.col("reference"))).alias("c")
    p = patients.withColumn("__ref", _bare_ref(F.col("id"))).alias("p")
    extra = ["c.condition_id"] if "condition_id" in conditions.columns else []
    return c.join(p, F.col("c.__ref") == F.col("p.__ref"), "inner").select(
        "c.display",
        "c.code",
        "c.assertedDate",
        "c.abatementDate",
        "p.Given_Name",
        "p.Identifier",
        F.col("p.id").alias("Synthea_UID"),
        "p.Family_Name",
        *extra,
    )


def flatten_messages(docs: DataFrame, path_col: str = "path", with_position: bool = False, folder: str | None = None) -> DataFrame:
    """Columns: SynSocial_UID, name, screen_name, created_at, text, filename
    (+ source_path and message_pos, the message's identity, when asked).

    ``path_col`` holds the source file path (URI); the file name is its last
    segment, decoded, or with ``folder`` the value of the partition folder of
    that name (a layout of one folder per person, whatever the files in it are called).
    Documents without messages give no row. The position is
    the message's place in its document, or the document's ``line`` if it has one.
    """
    name = file_name_from_path(F.col(path_col)) if folder is None else folder_value_from_path(F.col(path_col), folder)
    pos = F.col("line") if "line" in docs.columns else F.col("pos").cast("long")
    x = docs.select("*", F.posexplode("messages").alias("pos", "m")).select(
        "m", pos.alias("message_pos"), name.alias("filename"), F.col(path_col).alias("source_path")
    )
    extra = ["source_path", "message_pos"] if with_position else []
    return x.select(
        F.col("m.user.id").alias("SynSocial_UID"),
        F.col("m.user.name").alias("name"),
        F.col("m.user.screen_name").alias("screen_name"),
        F.col("m.created_at").alias("created_at"),
        F.col("m.text").alias("text"),
        "filename",
        *extra,
    )
