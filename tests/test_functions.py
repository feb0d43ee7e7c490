from __future__ import annotations

import difflib
import unicodedata
import uuid

import pytest
from pyspark.sql import functions as F

from dossier.functions.contact import classify_link, extract_emails, extract_phones, normalize_email, normalize_name, normalize_phone, strip_tracking
from dossier.functions.semantic import normalize_country, normalize_date, normalize_skill, parse_location, parse_years, py_round3
from dossier.functions.text import casefold, clean_text, decode_bytes
from dossier.operators.resolve import NAMESPACE_HEX, sequence_ratio, uuid5


@pytest.fixture(scope="module")
def each(spark):
    def run(values, make, kind="string"):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
        rows = df.select("i", make(F.col("x")).alias("y")).orderBy("i").collect()
        return [r["y"].asDict() if hasattr(r["y"], "asDict") else r["y"] for r in rows]

    return run


def py_clean(s):
    s = unicodedata.normalize("NFC", s or "")
    return " ".join("".join(c for c in s if unicodedata.category(c) not in ("Cc", "Cf") or c in "\n\t").split())


TEXTS = ["plain", "  a \t b\n\nc ", "é", "é", "zero​width ‮rtl‬", " nbsp em　", "bell\x07\rfeed\x0c", None, "", "﻿mark", "Straße ΣΑΣ"]


def test_clean_and_fold(each):
    assert each(TEXTS, clean_text) == [py_clean(t) for t in TEXTS]
    assert each(["Straße", "ABC", "ΣΑΣ", None], casefold) == ["strasse", "abc", "σασ", None]


def test_decode(each):
    assert each([b"plain", "﻿mark é".encode(), "é".encode("latin-1"), b"", None], decode_bytes, "binary") == ["plain", "mark é", "é", "", None]


def test_names(each):
    got = each(["Jane Doe", " jane   DOE (she/her) ", "O'Brien, Pat.", "...", "", None], normalize_name)
    assert [(g["value"], g["key"], g["quality"]) for g in got] == [("Jane Doe", "jane doe", 1.0), ("jane DOE", "jane doe", 1.0), ("O'Brien, Pat", "obrien pat", 1.0), (None, None, 0.0), (None, None, 0.0), (None, None, 0.0)]


def test_emails(each):
    got = each(["Jane.Doe+recruiting@Gmail.com", "<a.b@x.org>", "not-an-email", "a@b", "j@googlemail.com", None, "x y@z.com"], normalize_email)
    assert [(g["value"], g["key"]) for g in got] == [("jane.doe+recruiting@gmail.com", "janedoe@gmail.com"), ("a.b@x.org", "a.b@x.org"), (None, None), (None, None), ("j@googlemail.com", "j@googlemail.com"), (None, None), ("xy@z.com", "xy@z.com")]
    assert each(["to a@b.co or a@b.co, c@d.e.f!", None], extract_emails) == [["a@b.co", "c@d.e.f"], []]


def test_phones(each):
    raw = ["+1 (415) 555-0142", "1-415-555-0142", "555-0142", "+1 415 555 0142 ext 22", "+12", "", "call me", "020 7946 0958"]
    got = each(raw, normalize_phone)
    assert [g["value"] for g in got] == ["+14155550142", "+14155550142", None, "+14155550142", None, None, None, None]
    assert got[3]["ext"] == "22" and got[2]["reason"] == "no_country_code_and_no_region_hint"
    assert each(["020 7946 0958", "030 1234567"], lambda c: normalize_phone(c, F.lit("GB")))[0]["value"] == "+442079460958"
    assert each(["030 1234567"], lambda c: normalize_phone(c, F.lit(None).cast("string"), "DE"))[0] | {"ext": None} == {"value": "+49301234567", "key": "+49301234567", "quality": 0.9, "reason": "region_from:DE", "ext": None}
    assert each(["a +1 415 555 0142 b 12 c 415.555.0142 x5", None], extract_phones) == [["+1 415 555 0142", "415.555.0142 x5"], []]


def test_dates(each):
    raw = ["2021-03", "Jan 2021", "2017", "Present", "03/04/21", "25/03/2020", "Jan 49", "Jan 50", "not a date", "2020 Sept", "13/14/2020", "05/21", "2021-13", "99", None, "1999.12.31", "June-98", "15/2020"]
    want = ["2021-03", "2021-01", "2017", None, "2021", "2020-03", "2049-01", "1950-01", None, "2020-09", "2020", "2021-05", None, "1999", None, "1999-12", "1998-06", None]
    got = each(raw, normalize_date)
    assert [g["value"] for g in got] == want
    assert got[3]["is_current"] and got[4]["precision"] == "year" and got[4]["quality"] == 0.6 and got[8]["quality"] == 0.0 and got[10]["quality"] == 0.5
    assert [each(["03/04/21"], lambda c, at=at: normalize_date(c, at))[0]["value"] for at in ("US", "EU", "UK", "IN")] == ["2021-03", "2021-04", "2021-04", "2021-04"]


def test_countries_and_places(each):
    got = each(["USA", "United Kingdom", "Berlin, Germany", "Atlantis", "de", "U.S.", "", None], normalize_country)
    assert [(g["value"], g["canonical"]) for g in got] == [("US", True), ("GB", True), ("DE", True), ("Atlantis", False), ("DE", True), ("U.S.", False), (None, False), (None, False)]
    assert each(["Berlin, Germany", "Germany", "Berlin", "Austin, TX, USA", ""], parse_location) == [
        {"city": "Berlin", "region": None, "country": "Germany"}, {"city": None, "region": None, "country": "Germany"}, {"city": "Berlin", "region": None, "country": None},
        {"city": "Austin", "region": "TX", "country": "USA"}, {"city": None, "region": None, "country": None},
    ]


def test_skills(each):
    got = each(["k8s", "nodejs", "Postgres", "Cobol-77-Mainframe", "kuberntes", "haskell lang", "", None, "PYTHON"], normalize_skill)
    assert [(g["value"], g["canonical"], g["quality"]) for g in got] == [("Kubernetes", True, 1.0), ("JavaScript", True, 1.0), ("PostgreSQL", True, 1.0), ("Cobol-77-Mainframe", False, 0.3), ("Kubernetes", True, 0.947), ("Haskell Lang", False, 0.3), (None, False, 0.0), (None, False, 0.0), ("Python", True, 1.0)]


def test_links(each):
    raw = ["https://www.linkedin.com/in/janedoe?utm_source=x", "github.com/janedoe", "http://janedoe.dev/", "x.org/a/b?ref=1&q=2#top", "", "https://", "https://github.com"]
    got = each(raw, classify_link)
    assert [(g["value"], g["kind"], g["handle"], g["quality"]) for g in got] == [
        ("https://linkedin.com/in/janedoe", "linkedin", "janedoe", 1.0), ("https://github.com/janedoe", "github", "janedoe", 1.0), ("https://janedoe.dev", "portfolio", None, 0.8),
        ("https://x.org/a/b?q=2", "other", None, 0.8), (None, "other", None, 0.0), (None, "other", None, 0.0), ("https://github.com", "github", None, 0.7),
    ]
    assert each(["utm_x=1&a=2&&FBCLID=3&trk=4&b", "", None], strip_tracking) == ["a=2&b", "", ""]


def test_numbers(each):
    assert [g["value"] for g in each(["7", "7.5", "-1", "81", "1_0", "nan", "true", None, " 12 "], parse_years)] == [7.0, 7.5, None, None, None, None, None, None, 12.0]
    values = [0.0625, 1.0005, 0.0125, 2.6755, 0.1235, None]
    assert each(values, py_round3, "double") == [v if v is None else round(v, 3) for v in values]


def test_ids_and_ratio(each, spark):
    names = ["a", "name:jane doe;b:city=x", "ünï"]
    space = uuid.UUID(NAMESPACE_HEX)
    assert each(names, uuid5) == [str(uuid.uuid5(space, n)) for n in names]
    pairs = [("tide", "diet"), ("diet", "tide"), ("", ""), (None, "a")]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a string, b string")
    got = [r[0] for r in df.orderBy("i").select(sequence_ratio("a", "b")).collect()]
    assert got == [None if a is None else difflib.SequenceMatcher(None, a, b).ratio() for a, b in pairs]


def test_clean_texts_runs_over_whole_tables(spark, tmp_path):
    """Null texts and those beyond ASCII are rows like all others, for the query and for its SQL."""
    duckdb = pytest.importorskip("duckdb")
    from dossier.queries import QUERIES, SQL

    texts = [*TEXTS, "Café äö", "a b　c ", "soft­hyphen ‍﻿", "\u0085next\x1fline", "漢字 \U0001f642", "x\x80y\x9fz"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    want = {i: py_clean(t) for i, t in enumerate(texts)}
    assert {r["doc_id"]: r["clean"] for r in QUERIES["clean_texts"](spark, str(tmp_path)).collect()} == want
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert dict(db.execute(SQL["clean_texts"]).fetchall()) == want
