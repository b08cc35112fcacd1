"""Hand-made input folders: clinical bundles and message documents."""

import json
import os


def patient(pid, given, family, ident, extra_names=()):
    names = [{"family": family, "given": given}] if given is not None or family is not None else []
    return {
        "fullUrl": f"urn:uuid:{pid}",
        "resource": {
            "resourceType": "Patient",
            "id": pid,
            "identifier": [{"value": ident}, {"value": "other"}],
            "name": names + list(extra_names),
        },
    }


def condition(cid, pid, codings, asserted, abatement=None, nested_abatement=False, ref_prefix="urn:uuid:"):
    r = {
        "resourceType": "Condition",
        "id": cid,
        "code": {"coding": [{"code": c, "display": d} for c, d in codings]},
        "subject": {"reference": f"{ref_prefix}{pid}"},
        "assertedDate": asserted,
    }
    if abatement is not None:
        if nested_abatement:
            r["abatement"] = {"dateTime": abatement}
        else:
            r["abatementDateTime"] = abatement
    return {"fullUrl": f"urn:uuid:{cid}", "resource": r}


def write_bundles(folder):
    os.makedirs(folder, exist_ok=True)
    b1 = {
        "resourceType": "Bundle",
        "entry": [
            patient("p1", ["Ann", "Marie"], "Lee", "100"),
            condition("c1", "p1", [("444814009", "Viral sinusitis")], "2010-05-06T23:30:00-04:00", "2010-05-20T10:00:00-04:00"),
            condition("c2", "p1", [("195662009", "Acute pharyngitis"), ("10509002", "Acute bronchitis")], "2010-05-10", "2010-05-12", nested_abatement=True),
            condition("c3", "p1", [("38341003", "Hypertension")], "2009-01-01"),  # never ends
            {"fullUrl": "urn:uuid:o1", "resource": {"resourceType": "Observation", "id": "o1"}},
        ],
    }
    b2 = {
        "resourceType": "Bundle",
        "entry": [
            patient("p2", ["Bo"], "Diaz Ruiz", "200"),
            condition("c4", "p2", [("444814009", "Viral sinusitis")], "2011-02-01", "2011-02-03", ref_prefix="Patient/"),
            condition("c5", "p2", [], "2011-02-01", "2011-02-03"),  # no coding: no row
        ],
    }
    b3 = {"resourceType": "Bundle", "entry": [patient("p3", None, None, "300"), condition("c6", "p3", [("1", "x")], "2011-01-01", "2011-12-31")]}
    for i, b in enumerate((b1, b2, b3)):
        with open(os.path.join(folder, f"bundle{i}.json"), "w") as f:
            json.dump(b, f, indent=2)


def tweet(uid, name, when, text):
    return {"user": {"id": uid, "name": name, "screen_name": name.lower()}, "created_at": when, "text": text}


def write_messages(folder):
    os.makedirs(folder, exist_ok=True)
    docs = {
        "Ann_Lee_100TwitterData.json": [
            tweet(11, "Ann", "Thu May 06 12:00:00 +0000 2010", "feeling sick"),
            tweet(11, "Ann", "Tue May 11 08:00:00 +0000 2010", "still sick\nsecond line"),
            tweet(11, "Ann", "Fri May 21 08:00:00 +0000 2010", "  better  "),
            tweet(11, "Ann", "Tue May 11 09:00:00 +0000 2010", 'quote " and \\ backslash'),
        ],
        "Bo_Diaz Ruiz_200TwitterData.json": [tweet("22", "Bo", "Wed Feb 02 01:00:00 +0000 2011", "")],
        "Nobody_X_999TwitterData.json": [tweet(33, "No", "Wed Feb 02 01:00:00 +0000 2011", "unmatched")],
    }
    for name, msgs in docs.items():
        with open(os.path.join(folder, name), "w") as f:
            json.dump({"messages": msgs}, f, indent=2)
    with open(os.path.join(folder, "broken.json"), "w") as f:
        f.write("{ this is not json")
    with open(os.path.join(folder, "empty.json"), "w") as f:
        json.dump({"messages": []}, f)
    with open(os.path.join(folder, "toplevel-array.json"), "w") as f:
        json.dump([1, 2, 3], f)
