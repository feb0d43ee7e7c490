from __future__ import annotations

import itertools
import re

import pytest

from dossier.llm import decontaminate, license_scan

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def brute(text):
    words = WORD.findall(lower(text))
    hits = [(k, label) for phrase, label in license_scan.BASE for k in range(len(words)) if words[k : k + len(phrase.split())] == phrase.split()]
    return len(words), len(hits), min((k for k, _ in hits), default=None), max((k for k, _ in hits), default=None), ",".join(sorted({x for _, x in hits}))


TEXTS = [
    None, "", "!!!", "MIT License", "the mit  license, mit-license! MIT.LICENSE", "GNU General Public License version 3", "gnu general\npublic license apache license cc by 4.0", "cc by cc by cc by",
    "Licensed under CC BY-NC 4.0", "éMIT License", "mit licenseé", "Apache License, Version 2.0; SPDX-License-Identifier: BSD-3-Clause", "gnu gnu general public license", "cc cc by", "permission is hereby granted, free of charge, to any person obtaining a copy",
]


def test_base_phrases_match_brute_force(docs_of, corpus):
    rows = list(enumerate(TEXTS)) + [(100 + i, t) for i, t in corpus]
    got = {r["doc_id"]: r for r in license_scan.license_digest(docs_of(rows)).collect()}
    for i, t in rows:
        r = got[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute(t), t
        labels = set(r["labels"].split(",")) - {""}
        assert set(r["base_labels"].split(",")) - {""} <= labels and 0 <= r["score"] <= 1


def test_method_labels_and_suppression(docs_of):
    got = {r["doc_id"]: r["labels"] for r in license_scan.license_digest(docs_of(list(enumerate(TEXTS)))).collect()}
    assert got[5] == "gpl,gpl-3"
    assert got[8] == "cc-by,cc-by-nc-4"  # the longer detection hides the shorter rule, but the base phrase stays
    assert got[11] == "apache,apache-2.0,bsd-3"
    assert got[14] == "mit"


def test_there_are_hundreds_of_rules_and_all_compile():
    rules = license_scan.rules()
    assert len(rules) >= 200
    license_scan.Scanner(rules)


def test_gate_changes_nothing(corpus):
    """Every rule tried on every text finds the same as behind its keywords."""
    gated, open_ = license_scan._scanner(), license_scan.Scanner(tuple(license_scan.Rule(r.label, r.pattern, (), r.priority) for r in license_scan.rules()))
    for t in [*TEXTS, *(t for _, t in corpus[:30])]:
        line = b" " + b" ".join(license_scan.fold((t or "").encode()).split()) + b" "
        assert gated.detections(line) == open_.detections(line), t


def test_suppression_prefers_priority_then_length():
    found = [(0, 10, "a", 20), (2, 6, "b", 50), (0, 12, "c", 20), (3, 5, "d", 50), (20, 24, "e", 1)]
    assert license_scan.suppressed(found) == [(0, 12, "c", 20), (2, 6, "b", 50), (20, 24, "e", 1)]


def test_empty_tables(docs_of, spark):
    assert license_scan.license_digest(docs_of([])).count() == 0
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find_overlaps(docs_of([(1, "a b c")]), none).count() == 0
    some = spark.createDataFrame([(1, "a b c d e f g h")], "item_id long, text string")
    assert decontaminate.find_overlaps(docs_of([]), some).count() == 0


@pytest.fixture(scope="module")
def planted():
    item = "the quick brown fox jumps over the lazy dog while seven wizards box quietly near an old mill by the river bank"
    other = "colourless green ideas sleep furiously under pale blue moonlight tonight again"
    changed = item.split()
    for k in (3, 9, 15):
        changed[k] = "zebra"
    half = item.split()[:13]
    scattered = [w if k % 2 else "noise" for k, w in enumerate(item.split())]
    docs = [(1, f"intro words {item} outro"), (2, "aa bb " + " ".join(changed) + " cc"), (3, " ".join(half)), (4, " ".join(scattered)), (5, "the quick brown fox " * 3), (6, other.upper() + "!!"), (7, None), (8, ""), (9, "nothing to see here at all my friend"), (1, f"intro words {item} outro")]
    tests = [(10, item), (11, other), (12, None), (13, ""), (14, "too short")]
    return docs, tests


def overlap_brute(doc, item):
    """Slide the item over the document word by word."""
    words = lambda t: WORD.findall(lower(t))
    d, i = words(doc), words(item)
    size = min(decontaminate.STRETCH, len(i))
    if len(i) < decontaminate.LEAST_WORDS:
        return False
    return any(sum(d[p + k] == i[q + k] for k in range(size)) >= 0.8 * size for q in range(len(i) - size + 1) for p in range(len(d) - size + 1))


def test_overlaps_match_brute_force(docs_of, spark, planted):
    docs, tests = planted
    bench = spark.createDataFrame(tests, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_overlaps(docs_of(docs), bench).collect()}
    assert got == {(d, i) for d, t in docs for i, x in tests if t and x and overlap_brute(t, x)} == {(1, 10), (2, 10), (3, 10), (6, 11)}
    kept = decontaminate.clean(docs_of(docs), bench)
    assert kept.columns == docs_of([]).columns and sorted(r["doc_id"] for r in kept.collect()) == [4, 5, 7, 8, 9]


def test_texts_found_without_a_broadcast(docs_of, spark, planted, monkeypatch):
    docs, tests = planted
    bench = spark.createDataFrame(tests, "item_id long, text string")
    whole = sorted(map(tuple, decontaminate.find_overlaps(docs_of(docs), bench).collect()), key=str)
    monkeypatch.setattr(decontaminate, "MOST_BROADCAST", 0)
    monkeypatch.setattr(decontaminate, "CELLS", 30)
    assert sorted(map(tuple, decontaminate.find_overlaps(docs_of(docs), bench).collect()), key=str) == whole
    assert sorted(r["doc_id"] for r in decontaminate.clean(docs_of(docs), bench).collect()) == [4, 5, 7, 8, 9]


def test_equal_words_take_no_quadratic_time():
    import time

    start = time.time()
    item, text = (decontaminate.lowered([b"same " * n]).h for n in (400, 20_000))
    assert decontaminate.best_overlap(item, text) == (0, 400, 400)
    assert time.time() - start < 4
    text = decontaminate.lowered([b"mit license " * 50_000])
    line = b" " + b"mit license " * 50_000
    start = time.time()
    found = license_scan._scanner().detections(line)
    assert len(found) >= 50_000 and time.time() - start < 8


def test_suppression_matches_brute_force():
    import random

    rng = random.Random(5)
    for _ in range(200):
        found = [(a, a + rng.randint(1, 12), rng.choice("xy"), rng.choice((20, 50))) for a in (rng.randrange(30) for _ in range(rng.randrange(40)))]
        kept = []
        for d in sorted(set(found), key=lambda d: (-d[3], d[0] - d[1], d[0], d[2])):
            if not any(a <= d[0] and d[1] <= b for a, b, _, _ in kept):
                kept.append(d)
        assert license_scan.suppressed(found) == sorted(kept)


def test_every_two_substitutions_are_survived():
    """Whatever two of thirteen words change, some mask still hits."""
    n = decontaminate.STRETCH
    for x in range(n):
        for y in range(n):
            assert any(all(m[k] == "0" or p + k not in (x, y) for k in range(len(m))) for m in decontaminate.MASKS for p in range(n - len(m) + 1)), (x, y)


@pytest.mark.parametrize("n", range(1, 15))
def test_every_permitted_substitution_is_found(n):
    """Items of every length, with every set of words that may differ, and none with one word more."""
    item = [f"item{k}" for k in range(n)]
    hashes = lambda t: decontaminate.lowered([t]).h
    own = hashes(" ".join(item).encode())
    assert decontaminate.best_overlap(own, hashes(b"nothing here")) is None
    size = min(n, decontaminate.STRETCH)
    most = max(d for d in range(size) if size - d >= 0.8 * size - 1e-9)
    said = lambda gone: " ".join(["before", "it", *(f"other{k}" if k in gone else w for k, w in enumerate(item)), "after"]).encode()
    for gone in itertools.combinations(range(size), most):
        found = decontaminate.best_overlap(own, hashes(said(gone)))
        assert found, gone
        if n <= size:
            assert found == (2, n, n - most)
    if n <= size:
        assert not any(decontaminate.best_overlap(own, hashes(said(gone))) for gone in itertools.combinations(range(n), most + 1))


def test_short_items_are_found_in_tables(docs_of, spark):
    docs = [(1, "say open sesame now"), (2, "open the sesame"), (3, "sesame open"), (4, "a b c d e f g"), (5, "a b x d e f g"), (6, "a b x d y f g"), (7, None), (8, "open"), (9, "sesame")]
    tests = [(10, "Open, sesame!"), (11, "a b c d e f g"), (12, "???")]
    bench = spark.createDataFrame(tests, "item_id long, text string")
    got = {tuple(r) for r in decontaminate.find_overlaps(docs_of(docs), bench).collect()}
    assert got == {(1, 10, 1, 2, 2), (4, 11, 0, 7, 7), (5, 11, 0, 7, 6)}
    assert sorted(r["doc_id"] for r in decontaminate.clean(docs_of(docs), bench).collect()) == [2, 3, 6, 7, 8, 9]


def said_by(pattern):
    """Texts that a rule's regex matches: each alternative, each class member, optional parts absent and present."""

    def texts(parts):
        out = [""]
        for op, of in parts:
            kind = str(op)
            if kind == "LITERAL":
                said = [chr(of)]
            elif kind == "IN":
                said = [chr(x if str(k) == "LITERAL" else x[0]) for k, x in of]
            elif kind == "BRANCH":
                said = [x for branch in of[1] for x in texts(branch)]
            elif kind == "SUBPATTERN":
                said = texts(of[3])
            elif kind in ("MAX_REPEAT", "MIN_REPEAT"):
                said = [x * k for k in sorted({of[0], max(1, of[0])}) for x in texts(of[2])]
            else:
                said = {"ANY": ["x"], "ASSERT_NOT": [""]}[kind]
            out = [a + b for a in out for b in dict.fromkeys(said)]
        return out

    return texts(re._parser.parse(pattern))


def test_every_alternative_passes_its_gate():
    """What a rule matches holds the rule's keywords, so the gate hides nothing."""
    gated = license_scan._scanner()
    for r in license_scan.rules():
        for t in said_by(r.pattern):
            assert re.fullmatch(r.pattern, t) and set(r.keywords) <= set(t.split()), (r, t)
    named = lambda t: {d[2] for d in gated.detections(b" " + t + b" ")}
    for t, label in ((b"unauthorized use of this document", "proprietary"), (b"unauthorised copying of this file", "proprietary"), (b"freebsd license", "bsd-2"), (b"0bsd license", "0bsd")):
        assert named(t) == {label}


def test_gate_changes_nothing_for_any_alternative():
    gated, open_ = license_scan._scanner(), license_scan.Scanner(tuple(license_scan.Rule(r.label, r.pattern, (), r.priority) for r in license_scan.rules()))
    for t in dict.fromkeys(t for r in license_scan.rules() for t in said_by(r.pattern)):
        line = b" " + t.encode() + b" "
        assert gated.detections(line) == open_.detections(line) != [], t
