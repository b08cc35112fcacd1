"""Catalogue documents as tables (K1, K2, K4)."""

import json
import os

from privlink.operators.lineage import dangling_edges, lineage_datasets, lineage_edges
from privlink.sources.files import read_lineage_docs


def _dataset(name, created=1000000000000):
    return {"entity": {"typeName": "hdfs_folder", "attributes": {
        "owner": "hdfs", "createTime": created, "qualifiedName": f"store_{name}@test",
        "displayName": f"{name} folder", "name": name, "description": name}}}


def _process(name, inputs, outputs):
    ref = lambda n: {"guid": f"g-{n}", "typeName": "hdfs_folder", "uniqueAttributes": {"qualifiedName": f"store_{n}@test"}}
    return {"entity": {"typeName": "SparkProcess", "attributes": {
        "owner": "hdfs", "qualifiedName": f"{name}@test", "displayName": None, "description": name,
        "userName": None, "name": f"{name}.py", "startTime": 1, "endTime": 2, "processId": name,
        "inputs": [ref(n) for n in inputs], "outputs": [ref(n) for n in outputs]}}}


def test_lineage_tables(spark, workdir):
    docs = [
        _dataset("people"), _dataset("notes"), _dataset("linked"),
        _process("link-step", ["notes", "people"], ["linked"]),
        _process("protect-step", ["linked"], ["copy"]),  # copy not declared
    ]
    for i, d in enumerate(docs):
        with open(os.path.join(workdir, f"doc{i}.json"), "w") as f:
            json.dump(d, f, indent=2)
    d = read_lineage_docs(spark, workdir)
    ds = lineage_datasets(d)
    assert ds.count() == 3 and str(ds.first()["created"]).startswith("2001-09-09")
    e = lineage_edges(d)
    assert sorted((r["process"], r["direction"]) for r in e.collect()) == [
        ("link-step@test", "input"), ("link-step@test", "input"), ("link-step@test", "output"),
        ("protect-step@test", "input"), ("protect-step@test", "output"),
    ]
    bad = dangling_edges(e, ds).collect()
    assert [r["dataset"] for r in bad] == ["store_copy@test"]
