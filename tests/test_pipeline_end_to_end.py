from __future__ import annotations

import copy
import json
import math
import os
import uuid
from collections import Counter
from dataclasses import replace

import pytest
from fixtures import ATS, BROKEN, CSV, GITHUB, NOTES, RESUME, TWO_PEOPLE, table

from dossier.__main__ import main
from dossier.plans.config import DEFAULT, ConfigError, Source, faults, load_config, validate_config
from dossier.plans.pipeline import Pipeline
from dossier.plans.project import ProjectionError, ValidationError, validate_output
from dossier.session import checkpoint_dir, clear_scratch, scratch_path
from dossier.sources.scan import InputSpec, scan

ALL = [InputSpec("people.csv", CSV), InputSpec("people.json", ATS), InputSpec("hub.json", GITHUB), InputSpec("ines.txt", RESUME), InputSpec("fair.txt", NOTES), InputSpec("cut.json", BROKEN), InputSpec("void.txt", b"")]
#: The namespace of candidate ids.
NAMESPACE = uuid.UUID("6f0b8d2e-1c3a-5b7d-9e11-2a4c6e8f0a13")


@pytest.fixture(scope="module")
def run(spark):
    return Pipeline(spark).run(ALL)


@pytest.fixture(scope="module")
def profile(run):
    return run.output()


def test_types_and_log(run):
    told = {r["origin"]: (r["source_type"], r["event"], r["detail"]) for r in run.ingest_log().collect()}
    assert told == {
        "people.csv": ("recruiter_csv", "ok", "5 claims"), "people.json": ("ats_json", "ok", "17 claims"), "hub.json": ("github", "ok", "8 claims"), "ines.txt": ("resume", "ok", "13 claims"),
        "fair.txt": ("recruiter_notes", "ok", "6 claims"), "cut.json": ("ats_json", "failed", "malformed_json"), "void.txt": ("recruiter_notes", "failed", "empty_source"),
    }


def test_one_person_from_five_sources(profile):
    keys = ["+34612345678", "github:inesv", "ines@varga.example", "iv@luma.example", "linkedin:ines-varga"]
    assert profile["candidate_id"] == str(uuid.uuid5(NAMESPACE, "|".join(sorted(keys))))
    assert (profile["full_name"], profile["headline"], profile["years_experience"]) == ("Ines Varga", "Makes robots stop in time", 11)
    assert (profile["emails"], profile["phones"]) == (["ines@varga.example", "iv@luma.example"], ["+34612345678"])
    assert profile["links"] == {"linkedin": "https://linkedin.com/in/ines-varga", "github": "https://github.com/inesv", "portfolio": "https://varga.example", "other": []}
    assert [s["name"] for s in profile["skills"]] == ["Python", "Kubernetes", "Rust", "C", "PostgreSQL", "Kafka"]
    jobs = {(e["company"], e["title"], e["start"], e["end"], e["summary"]) for e in profile["experience"]}
    assert jobs == {("Luma Robotics", "Lead Controls Engineer", "2020-03", None, "Stopping distances, and who is near."), ("Taller Norte", "Firmware Developer", "2014-09", "2020-02", None)}
    assert profile["education"] == [{"institution": "Escola Tecnica do Mar", "degree": "MSc", "field": "Automation", "end_year": 2014}]


def test_confidences(profile):
    """Sources that agree corroborate: 1 - the product of their doubts."""
    agree = lambda *c: round(1 - math.prod(1 - x for x in c), 3)
    skills = {s["name"]: s["confidence"] for s in profile["skills"]}
    code_host, form, paper, note = 0.7, 0.7, 0.8, 0.4
    assert skills["C"] == code_host and skills["PostgreSQL"] == form and skills["Kafka"] == note
    assert skills["Rust"] == agree(code_host, paper) and skills["Kubernetes"] == agree(form, paper) and skills["Python"] == agree(code_host, form, paper, note)
    assert profile["field_confidence"]["full_name"] == agree(0.8, 0.8, 0.5, 0.7)
    assert 0 < profile["overall_confidence"] < 1


def test_conflicts_and_provenance(profile):
    conflicts = {c["field"]: c for c in profile["conflicts"]}
    assert conflicts["years_experience"]["winner"] == "11.0" and [a["value"] for a in conflicts["years_experience"]["alternatives"]] == ["6"]  # the closed job spans 66 months
    assert profile["field_confidence"]["years_experience"] == 0.5
    assert conflicts["location.country"]["winner"] is None and {a["value"] for a in conflicts["location.country"]["alternatives"]} == {"ES", "DE"} and profile["location"]["country"] is None
    assert {p["field"] for p in profile["provenance"]} >= {"full_name", "emails", "skills", "experience", "education"}
    assert all(p["source"] for p in profile["provenance"])


@pytest.fixture(scope="module")
def many(spark):
    """Independent scenarios in one run."""
    lab = table(("candidate", "city", "employer", "role", "email"), ("Tove Lindqvist", "Bergen", "Harbour Lab", "Diver", "tove@harbour.example"))
    memo = b"Candidate: Tove Lindqvist\nBased in: Bergen\nEmployer: Harbour Lab\nKnows her knots.\n"
    left, right = (f"Candidate: Omar Reyes\nBased in: Quito\n{extra}\n".encode() for extra in ("tall", "not so tall"))
    crew = table(("name", "email", "company", "city"), *((f"Crew {chr(65 + i)}", f"crew{i}@ship.example", "Blue Line", "Bergen") for i in range(25)))
    specs = [InputSpec("two.csv", TWO_PEOPLE), InputSpec("lab.csv", lab), InputSpec("memo.txt", memo), InputSpec("l.txt", left), InputSpec("r.txt", right), InputSpec("crew.csv", crew), InputSpec("two_again.csv", TWO_PEOPLE), InputSpec("letter", b"x", "telegram"), InputSpec("wide.csv", b"name,email\n" + b"x" * 200_000 + b",y\n")]
    return Pipeline(spark).run(specs)


def test_identities(many):
    rows = many.profiles.select("full_name", "emails", "candidate_id").collect()
    count = Counter("Crew" if r["full_name"].startswith("Crew ") else r["full_name"] for r in rows)
    # Namesakes with addresses of their own; a note without keys that joins by name and two attributes; a name and a city, which aren't
    # enough; and colleagues of one company and city with keys of their own.
    assert count == {"Noor Haddad": 2, "Tove Lindqvist": 1, "Omar Reyes": 2, "Crew": 25}
    ids = [r["candidate_id"] for r in many.json().collect()]
    assert ids == sorted(ids) and len(set(ids)) == len(rows) - 1  # namesakes without keys share what their id is made of


def test_duplicates_and_unknown_types(many):
    events = {r["origin"]: r["event"] for r in many.ingest_log().collect()}
    assert (events["two.csv"], events["two_again.csv"], events["letter"]) == ("ok", "dedupe", "skip")
    assert many.summary()["candidates"] == 30
    broken = many.sources.where("origin = 'wide.csv'").first()
    assert not broken["ok"] and broken["error"].startswith("malformed_csv: field larger")


def configured(**changes):
    return {"fields": [{"path": "full_name", "type": "string"}], "on_missing": "null"} | changes


def test_custom_view(run):
    config = configured(fields=[
        {"path": "id", "compute": "candidate_id", "type": "string"}, {"path": "full_name", "type": "string", "required": True}, {"path": "primary.email", "from": "emails[0]", "type": "string", "required": True},
        {"path": "primary.phone", "from": "phones[0]", "type": "string", "normalize": "E164"}, {"path": "skills", "from": "skills[].name", "type": "string[]", "normalize": "canonical"}, {"path": "second", "from": "phones[5]", "type": "string"},
        {"path": "name", "from": "full_name", "normalize": "lower", "type": "string"}, {"path": "schools", "from": "education[].institution", "type": "string[]"},
    ], include_confidence=True)
    out = replace(run, config=config).output()
    assert out["primary"] == {"email": "ines@varga.example", "phone": "+34612345678"} and out["name"] == "ines varga"
    assert out["skills"][:2] == ["Python", "Kubernetes"] and out["second"] is None and out["schools"] == ["Escola Tecnica do Mar"]
    assert out["field_confidence"]["primary.email"] == run.output()["field_confidence"]["emails"] and "second" not in out["field_confidence"]
    assert "second" not in replace(run, config=config | {"on_missing": "omit"}).output()


def test_gates(spark, run):
    def check(config):
        Pipeline(spark, config).check(replace(run, config=config))

    other = {"path": "links.other", "type": "string[]", "required": True}
    region = {"path": "region", "from": "location.region", "type": "string"}
    with pytest.raises(ProjectionError):
        check(configured(fields=[region], on_missing="error"))
    with pytest.raises(ValidationError, match="'region' is null"):
        check(configured(fields=[region | {"required": True}]))
    with pytest.raises(ValidationError, match="empty"):
        check(configured(fields=[other]))
    check(configured(fields=[region]))
    with pytest.raises(ValidationError):
        validate_output({"full_name": 123}, configured())


@pytest.mark.parametrize("bad", [
    [], {"fields": []}, configured(fields=[{"path": "x", "from": "emailz[0]"}]), configured(fields=[{"path": "full_name", "type": "blob"}]), configured(on_missing="maybe"), configured(include_confidence="yes"),
    configured(fields=[{"path": "full_name"}, {"path": "full_name"}]), configured(fields=[{"path": "a", "compute": "magic"}]), configured(fields=[{"path": "full_name", "normalize": "shout"}]), configured(fields=[{"path": "full_name", "required": 1}]),
    configured(fields=[{"path": "n", "from": "skills[0].name"}]), configured(fields=["x"]), configured(fields=[{"path": ""}]),
])
def test_bad_configurations(bad):
    with pytest.raises(ConfigError):
        validate_config(bad)


def test_good_configurations():
    validate_config(copy.deepcopy(DEFAULT))
    assert load_config() == DEFAULT and load_config() is not DEFAULT
    kinds = [Source.parse(x).kind for x in ("emails[0]", "emails", "skills[].name[0]", "nope")]
    assert kinds == ["string", "string[]", "string", None] and Source.parse("a..b") is None


def test_all_faults_are_told_at_once():
    bad = {"fields": [{"path": "x", "from": "emailz"}, {"path": "x", "type": "blob", "required": 1}, 5], "on_missing": "maybe", "include_conflicts": 0}
    told = "\n".join(faults(bad))
    assert len(faults(bad)) == 8 and all(x in told for x in ("on_missing", "include_conflicts", "emailz", "blob", "fields[1].required", "fields[2]", "used 2 times"))


def test_scratch_is_cleared_and_must_be_shared(spark):
    class Elsewhere:
        conf = type("C", (), {"get": staticmethod(lambda *a: None)})
        sparkContext = type("S", (), {"master": "yarn", "getConf": staticmethod(lambda: {})})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(Elsewhere)
    path = scratch_path(spark, "own")
    spark.range(3).write.parquet(path)
    before = list(spark.sparkContext._dossier_written)
    spark.sparkContext._dossier_written[:] = [path]  # other tests still read theirs
    assert clear_scratch(spark) == 1 and not os.path.exists(path.removeprefix("file://"))
    spark.sparkContext._dossier_written = [p for p in before if p != path]


def test_scan_and_command_line(spark, tmp_path, capsys):
    (tmp_path / "a.csv").write_bytes(CSV)
    (tmp_path / "memo.txt").write_bytes(NOTES)
    rows = scan(spark, [str(tmp_path / "*.csv"), f"recruiter_notes={tmp_path}/memo.txt"]).collect()
    assert sorted((r["origin"], r["source_type"]) for r in rows) == [("a.csv", None), ("memo.txt", "recruiter_notes")]
    with pytest.raises(FileNotFoundError):
        scan(spark, [str(tmp_path / "*.nothing")])
    with pytest.raises(FileNotFoundError):
        scan(spark, [str(tmp_path / "none.csv")])
    bad, good = tmp_path / "bad.json", tmp_path / "good.json"
    bad.write_text(json.dumps(configured(fields=[{"path": "emailz"}])))
    good.write_text(json.dumps(configured(fields=[{"path": "headline", "required": True}])))
    assert main(["validate-config", str(bad)]) == 2 and main(["validate-config", str(good)]) == 0
    assert main(["transform", str(tmp_path / "a.csv"), "--config", str(bad)]) == 2
    assert main(["transform", str(tmp_path / "a.csv"), "--out", str(tmp_path / "out" / "p.json"), "--explain"]) == 0
    assert json.loads((tmp_path / "out" / "p.json").read_text())["full_name"] == "Ines Varga"
    assert "full_name: value='Ines Varga'" in capsys.readouterr().err
