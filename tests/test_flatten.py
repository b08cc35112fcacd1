"""Flatten operators (L1-L4, A1-A4, B1-B6) and traps T7, T9, T12, T13."""

import os

from privlink.operators.flatten import flatten_conditions, flatten_messages, flatten_patients, patient_conditions
from privlink.sources.files import read_bundles, read_message_docs, read_message_lines

from .fixtures import write_bundles, write_messages


def test_conditions_one_row_per_coding(spark, workdir):
    write_bundles(workdir)
    c = flatten_conditions(read_bundles(spark, workdir), with_id=True)
    rows = sorted((r["condition_id"], r["code"], r["display"]) for r in c.collect())
    # c2 has two codings: two aligned rows, not a code x display product (T7)
    assert [r for r in rows if r[0] == "c2"] == [("c2", "10509002", "Acute bronchitis"), ("c2", "195662009", "Acute pharyngitis")]
    assert not any(r[0] == "c5" for r in rows)  # no coding, no row
    assert len(rows) == 6
    ends = {r["condition_id"]: r["abatementDate"] for r in c.collect()}
    assert ends["c2"] == "2010-05-12" and ends["c1"].startswith("2010-05-20") and ends["c3"] is None
    assert c.columns == ["display", "code", "assertedDate", "abatementDate", "reference", "condition_id"]


def test_patients_first_elements(spark, workdir):
    write_bundles(workdir)
    p = {r["id"]: r for r in flatten_patients(read_bundles(spark, workdir)).collect()}
    assert set(p) == {"p1", "p2"}  # p3 has no name
    assert (p["p1"]["Given_Name"], p["p1"]["Identifier"], p["p1"]["Family_Name"]) == ("Ann", "100", "Lee")


def test_patient_conditions_strip_reference_prefix(spark, workdir):
    """T9: 'urn:uuid:' and 'Patient/' references both find their patient."""
    write_bundles(workdir)
    b = read_bundles(spark, workdir)
    pc = patient_conditions(flatten_conditions(b), flatten_patients(b))
    assert pc.columns == ["display", "code", "assertedDate", "abatementDate", "Given_Name", "Identifier", "Synthea_UID", "Family_Name"]
    uids = sorted(r["Synthea_UID"] for r in pc.collect())
    assert uids == ["p1"] * 4 + ["p2"]


def test_messages_permissive_and_file_names(spark, workdir):
    """A3: broken / empty / odd files give no rows; A4, T12, T13: the file
    name is the decoded last segment, whatever the folder depth."""
    deep = os.path.join(workdir, "a", "b", "c")
    write_messages(deep)
    m = flatten_messages(read_message_docs(spark, deep), with_position=True)
    rows = m.collect()
    assert len(rows) == 6
    names = {r["filename"] for r in rows}
    assert names == {"Ann_Lee_100TwitterData.json", "Bo_Diaz Ruiz_200TwitterData.json", "Nobody_X_999TwitterData.json"}
    assert m.columns == ["SynSocial_UID", "name", "screen_name", "created_at", "text", "filename", "source_path", "message_pos"]
    assert {r["SynSocial_UID"] for r in rows} == {"11", "22", "33"}  # numeric ids read as text
    assert sorted(r["message_pos"] for r in rows if r["name"] == "Ann") == [0, 1, 2, 3]


def test_message_lines(spark, workdir):
    import json

    os.makedirs(workdir, exist_ok=True)
    with open(os.path.join(workdir, "Ann_Lee_100TwitterData.json"), "w") as f:
        for i in range(3):
            f.write(json.dumps({"user": {"id": 1, "name": "Ann", "screen_name": "ann"}, "created_at": "x", "text": f"m{i}"}) + "\n")
    m = flatten_messages(read_message_lines(spark, workdir))
    assert sorted(r["text"] for r in m.collect()) == ["m0", "m1", "m2"]
    assert {r["filename"] for r in m.collect()} == {"Ann_Lee_100TwitterData.json"}


def test_resources_per_line_match_bundles(spark, workdir):
    """One resource per line (bulk export) gives the same tables as bundles."""
    import json

    from privlink.operators.flatten import conditions_from_resources, patients_from_resources
    from privlink.sources.files import read_resources

    bdir, rdir = os.path.join(workdir, "b"), os.path.join(workdir, "r")
    write_bundles(bdir)
    os.makedirs(rdir)
    for name in sorted(os.listdir(bdir)):
        with open(os.path.join(bdir, name)) as f, open(os.path.join(rdir, name + ".ndjson"), "w") as out:
            for e in json.load(f)["entry"]:
                out.write(json.dumps(e["resource"]) + "\n")
    b = read_bundles(spark, bdir)
    r = read_resources(spark, rdir)
    by_b = patient_conditions(flatten_conditions(b, with_id=True), flatten_patients(b))
    by_r = patient_conditions(conditions_from_resources(r, with_id=True), patients_from_resources(r))
    assert sorted(map(tuple, by_b.collect())) == sorted(map(tuple, by_r.collect()))
    assert by_r.count() == 5
