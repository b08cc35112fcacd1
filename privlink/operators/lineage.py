"""Catalogue documents as tables: datasets, process edges, dangling ends."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Fixed entity type names of the catalogue documents.
DATASET_TYPE = "hdfs_folder"
PROCESS_TYPE = "SparkProcess"


def lineage_datasets(docs: DataFrame, type_name: str = DATASET_TYPE) -> DataFrame:
    """One row per dataset entity.
    Columns: qualifiedName, name, displayName, description, owner,
    createTime (epoch ms), created (timestamp, session zone wall clock)."""
    a = "entity.attributes"
    return docs.filter(F.col("entity.typeName") == type_name).select(
        F.col(f"{a}.qualifiedName").alias("qualifiedName"),
        F.col(f"{a}.name").alias("name"),
        F.col(f"{a}.displayName").alias("displayName"),
        F.col(f"{a}.description").alias("description"),
        F.col(f"{a}.owner").alias("owner"),
        F.col(f"{a}.createTime").alias("createTime"),
        F.timestamp_millis(F.col(f"{a}.createTime")).cast("timestamp_ntz").alias("created"),
    )


_REF_ARRAY = "array<struct<guid:string,typeName:string,uniqueAttributes:struct<qualifiedName:string>>>"


def _ends(arr, direction: str):
    return F.transform(
        F.coalesce(arr, F.array().cast(_REF_ARRAY)),
        lambda r: F.struct(
            F.lit(direction).alias("direction"),
            r["uniqueAttributes"]["qualifiedName"].alias("dataset"),
            r["guid"].alias("guid"),
            r["typeName"].alias("dataset_type"),
        ),
    )


def lineage_edges(docs: DataFrame, type_name: str = PROCESS_TYPE) -> DataFrame:
    """One row per process input or output.
    Columns: process, process_name, direction ('input'/'output'), dataset,
    guid, dataset_type. Both arrays are turned into edges in one explode."""
    a = "entity.attributes"
    p = docs.filter(F.col("entity.typeName") == type_name)
    edges = F.concat(_ends(F.col(f"{a}.inputs"), "input"), _ends(F.col(f"{a}.outputs"), "output"))
    return p.select(
        F.col(f"{a}.qualifiedName").alias("process"),
        F.col(f"{a}.name").alias("process_name"),
        F.explode(edges).alias("e"),
    ).select("process", "process_name", "e.*")


def dangling_edges(edges: DataFrame, datasets: DataFrame) -> DataFrame:
    """Edges whose dataset end names no known dataset (anti join)."""
    known = datasets.select(F.col("qualifiedName").alias("__qn"))
    return edges.join(known, edges["dataset"] == known["__qn"], "left_anti")
