from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from dossier import queries
from dossier.operators import entries, resolve
from dossier.operators.graph import connected_components
from dossier.operators.normalize import Context, _of_family
from dossier.operators.resolve import blocked_pairs, star_edges
from dossier.operators.vote import evidence_groups, merge_spans, ranked, recency, vote, year_of
from dossier.sources import adapters


def roots(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    return {v: find(v) for v in parent}


@pytest.mark.parametrize("edges", [
    [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 200)], [(i, 100 - i) for i in range(40)], [(5, 5), (7, 7), (7, 9)],
    [(random.Random(k).randrange(80), random.Random(k + 999).randrange(80)) for k in range(70)],
])
def test_components(spark, edges):
    got = {r["vertex"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == roots(edges)


def test_components_of_texts_nulls_and_nothing(spark):
    rows = [("b", "a"), ("c", "b"), (None, "x"), ("y", None), ("b", "a")]
    got = {r["vertex"]: r["component"] for r in connected_components(spark.createDataFrame(rows, "src string, dst string")).collect()}
    assert got == {"a": "a", "b": "a", "c": "a"}
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_stars_and_blocks(spark):
    keys = spark.createDataFrame([("r2", "k"), ("r1", "k"), ("r3", "m")], "record_id string, key string")
    assert {tuple(r) for r in star_edges(keys).collect()} == {("r2", "r1"), ("r1", "r1"), ("r3", "r3")}
    blocks = spark.createDataFrame([(f"n{i}", "company", "acme") for i in range(5)] + [(f"m{i}", "company", "big") for i in range(9)], "record_id string, kind string, key string")
    free = spark.createDataFrame([("n1",), ("n3",), ("m1",)], "record_id string")
    pairs, skipped = blocked_pairs(blocks, free, cap=6)
    assert {tuple(r) for r in pairs.collect()} == {(a, b) for a in ("n0", "n1", "n2", "n3", "n4") for b in ("n0", "n1", "n2", "n3", "n4") if a < b and {a, b} & {"n1", "n3"}}
    assert [(r["key"], r["size"]) for r in skipped.collect()] == [("big", 9)]


def test_pairs_of_nodes_in_several_blocks_are_told_once_and_not_shuffled(spark, monkeypatch):
    monkeypatch.setattr(resolve, "CELL", 3)
    rng = random.Random(4)
    rows = [(i, rng.choice(["company", "school"]), rng.choice(["x", "y", None])) for i in range(30) for _ in range(4)]
    free, cap = {i for i in range(30) if i % 4 == 1}, 60
    pairs, skipped = blocked_pairs(spark.createDataFrame(rows, "record_id int, kind string, key string"), spark.createDataFrame([(i,) for i in free], "record_id int"), cap=cap)
    groups: dict = {}
    for i, kind, key in rows:
        if key:
            groups.setdefault((kind, key), []).append(i)
    want = {(a, b) for g in groups.values() if len(g) <= cap for a in g for b in g if a < b and {a, b} & free}
    assert sorted(tuple(r) for r in pairs.collect()) == sorted(want) and skipped.count() == 0
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in plan and "Aggregate" not in plan[: plan.index("Join")]


def test_customers_without_a_nation_make_no_pairs(spark, tmp_path):
    rows = [(7, None, "A"), (8, None, "A"), (14, 1, "A"), (15, 1, "A"), (16, 1, None), (21, 1, "B")]
    spark.createDataFrame(rows, "c_custkey long, c_nationkey int, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    assert [tuple(r) for r in queries.QUERIES["tier_b_pairs"](spark, str(tmp_path)).collect()] == [(14, 15)]


@pytest.mark.parametrize("kind", ["ats_json", "github", "resume", "recruiter_notes", "recruiter_csv"])
def test_claims_are_worked_out_once(spark, kind):
    """Spark infers no filter from what is exploded: such a filter works out all items a second time, at the scan."""
    rows = spark.createDataFrame([], "source_id string, origin string, content binary, source_type string, ts string")
    plan = adapters.ADAPTERS[kind](rows)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("flatten(array(") <= 1 and "size(filter(flatten" not in plan and len(plan) < 150_000


def test_records_of_one_export_are_dealt_out(spark):
    body = b'{"applicants": [' + b", ".join(b'{"name": "P Q%d"}' % i for i in range(64)) + b"]}"
    rows = spark.createDataFrame([("s", "a.json", bytearray(body), "ats_json", None, True, True, False)], "source_id string, origin string, content binary, source_type string, ts string, known boolean, ok boolean, duplicate boolean")
    found = adapters.extract(rows).withColumn("part", F.spark_partition_id())
    assert found.count() == 64 and found.select("part").distinct().count() > 1


def test_dates_of_entries_are_read_once(spark):
    kinds = f"path string, raw string, exp {adapters.EXP}, edu {adapters.EDU}, source_id string, family string"
    for family in ("experience", "education", "link"):
        plan = _of_family(spark.createDataFrame([], kinds), family, Context())._jdf.queryExecution().optimizedPlan().toString()
        assert len(plan) < 50_000, family


def claims(spark, rows):
    return spark.createDataFrame([("g", k, v, s, f"t:{s}", w, c) for k, v, s, w, c in rows], "g string, match_key string, value string, source_id string, label string, w double, c double")


def decide(spark, rows, high=False):
    return vote(ranked(evidence_groups(claims(spark, rows), ["g"]), ["g"]), F.lit(high)).first()


def test_votes(spark):
    one = decide(spark, [("a", "A", "s1", 0.8, 0.8), ("a", "a", "s1", 0.8, 0.5)])
    assert (one["value"], one["confidence"], one["method"], one["sources"]) == ("A", 0.8, "single_source", ["t:s1"])
    two = decide(spark, [("a", "A", "s1", 0.8, 0.8), ("a", "B", "s2", 0.5, 0.5)])
    assert (two["value"], two["confidence"], two["method"]) == ("A", 0.9, "corroborated")
    clear = decide(spark, [("a", "A", "s1", 0.8, 0.8), ("b", "B", "s2", 0.5, 0.5)])
    assert (clear["value"], clear["method"], [x["value"] for x in clear["alternatives"]]) == ("A", "evidence_vote", ["B"])
    tie = [("a", "A", "s1", 0.7, 0.70), ("b", "B", "s2", 0.65, 0.65)]
    low, high = decide(spark, tie), decide(spark, tie, True)
    assert (low["value"], low["confidence"], low["conflict"]) == ("A", 0.3, "demoted")
    assert (high["value"], high["confidence"], high["conflict"], [x["value"] for x in high["alternatives"]]) == (None, 0.0, "honesty_gate_null", ["A", "B"])


def test_recency(spark):
    df = spark.createDataFrame([("2024-01-01",), ("2022-07",), ("1990",), (None,), ("soon",)], "ts string")
    got = [r[0] for r in df.select(F.round(recency(year_of(F.col("ts")), F.lit(2024.0)), 4)).collect()]
    assert got == [1.0, 0.925, 0.7, 1.0, 1.0]


def test_spans(spark):
    rows = [("a", 0, 11), ("a", 6, 17), ("a", 18, 23), ("a", 30, 29), ("b", 0, 29), ("c", 5, None), ("d", 0, 5), ("d", 0, 5), ("d", 100, 100), ("e", 0, 100), ("e", 10, 20), ("e", 50, 60)]
    got = {r["k"]: (r["months"], r["years"]) for r in merge_spans(spark.createDataFrame(rows, "k string, s int, e int"), ["k"]).collect()}
    assert got == {"a": (24, 2), "b": (30, 2), "d": (7, 1), "e": (101, 8)}


def entry(company, title, start=None, end=None, current=False, c=0.5, source="s", summary=None):
    return {"company": company, "title": title, "start": start, "end": end, "summary": summary, "is_current": current, "c": c, "source_id": source, "label": f"t:{source}"}


def merged(spark, *groups):
    kind = "array<struct<company:string,title:string,start:string,end:string,summary:string,is_current:boolean,c:double,source_id:string,label:string>>"
    df = spark.createDataFrame([(i, g) for i, g in enumerate(groups)], f"group_id int, entries {kind}")
    return {r["group_id"]: [e.asDict() for e in r["experience"]] for r in entries.merge_entries(df).collect()}


def test_entries_merge_by_first_fit(spark):
    jobs = [
        entry("Acme", "Engineer", "2020-01", None, True, 0.5, "s1"), entry("ACME", "Staff Engineer", "2021-01", None, True, 0.8, "s2", "did things"),
        entry("Acme", "Janitor", "2001", "2002", False, 0.4, "s3"), entry(None, "Engineer", "2020", "2021", False, 0.3, "s4"), entry(None, "Engineer", "2020", "2021", False, 0.3, "s5"),
    ]
    found = merged(spark, jobs, [], None, [entry("A", "x", "2000", "2001", False, 0.4, "s1"), entry("A", "x", "2001-05", "2003", False, 0.9, "s1", "long")])
    got = found[0]
    assert [(e["company"], e["title"], e["start"], e["end"]) for e in got] == [("ACME", "Staff Engineer", "2020-01", None), (None, "Engineer", "2020", "2021"), (None, "Engineer", "2020", "2021"), ("Acme", "Janitor", "2001", "2002")]
    assert got[0]["confidence"] == 0.9 and got[0]["sources"] == ["t:s1", "t:s2"] and got[0]["summary"] == "did things"
    assert [e["sources"] for e in got[1:3]] == [["t:s4"], ["t:s5"]]
    assert found[1] == found[2] == []
    assert found[3] == [{"company": "A", "title": "x", "start": "2000", "end": "2003", "summary": "long", "confidence": 0.9, "sources": ["t:s1"]}]


def test_homes_match_first_fit_by_hand():
    """Against a plain first fit: each entry joins the first job of its company whose first entry agrees with it."""
    from difflib import SequenceMatcher

    rng = random.Random(8)
    month = lambda d, unknown, default: unknown if not d else 12 * int(d[:4]) + (int(d[5:]) if len(d) > 4 else default) - 1
    for _ in range(60):
        rows = []
        for _ in range(rng.randint(0, 14)):
            start = rng.choice([None, f"{rng.randint(2000, 2006)}", f"{rng.randint(2000, 2006)}-0{rng.randint(1, 9)}"])
            end = rng.choice([None, f"{rng.randint(2002, 2009)}"])
            rows.append((rng.choice(["Acme", "ACME", "Zeta", None]), rng.choice(["Dev", "Developer", "Cook", "Head Cook", None]), start, end, rng.random() < 0.2))
        spans = [(month(r[2], -(10**9), 1), 10**9 if r[4] else month(r[3], 10**9, 12)) for r in rows]
        leads: dict = {}
        want = []
        for i, r in enumerate(rows):
            name, home = (r[0] or "").casefold(), i
            for j in leads.setdefault(name, []) if name else []:
                a, b = ((x[1] or "").casefold() for x in (rows[j], r))
                meets = max(spans[i][0], spans[j][0]) <= min(spans[i][1], spans[j][1])
                if meets and (a in b or b in a or (r[4] and rows[j][4]) or SequenceMatcher(None, a, b).ratio() >= 0.6):
                    home = j
                    break
            if home == i:
                leads[name] = [*leads.get(name, []), i]
            want.append(home)
        assert entries.homes(*([r[k] for r in rows] for k in range(5)))[1] == want
