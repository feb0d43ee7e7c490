"""Registered queries: each operator of the library over the supplied tables, with equivalent SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dossier.functions.contact import classify_link, extract_emails, extract_phones, normalize_email, normalize_name, normalize_phone, strip_tracking
from dossier.functions.semantic import expand_year, month_index, normalize_country, normalize_date, normalize_skill, parse_location, parse_years
from dossier.functions.text import clean_text, or_null
from dossier.operators.entries import merge_entries
from dossier.operators.graph import connected_components
from dossier.operators.resolve import blocked_pairs, sequence_ratio, star_edges, uuid5
from dossier.operators.vote import contribution, evidence_groups, merge_spans, noisy_or, overall_confidence, ranked, recency, vote, year_of
from dossier.plans.pipeline import Pipeline
from dossier.plans.project import internal_violations, missing, output_violations
from dossier.sources.adapters import as_list, first_of, languages_by_bytes, with_gazetteer
from dossier.sources.scan import content_address, detect_type, register
from dossier.vocab import COUNTRY_ALIASES, IMPORTANCE, ISO_COUNTRIES, Vocabulary

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def quoted(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


VOTE_SQL = """
WITH c AS (SELECT l_partkey, l_suppkey, l_returnflag AS v, least(0.999, CASE WHEN l_linestatus = 'O' THEN 0.8 ELSE 0.7 END * (1 - l_discount)) AS c FROM lineitem),
s AS (SELECT l_partkey, v, l_suppkey, max(c) AS c FROM c GROUP BY ALL),
g AS (SELECT l_partkey, v, 1 - product(1 - c) AS score, count(*) AS n FROM s GROUP BY ALL),
r AS (SELECT *, row_number() OVER w AS k, sum(score) OVER (PARTITION BY l_partkey) AS total, lead(score) OVER w AS second, count(*) OVER (PARTITION BY l_partkey) AS groups FROM g WINDOW w AS (PARTITION BY l_partkey ORDER BY score DESC, v))
"""


def part_votes(spark: SparkSession, sf_dir: str, high_stakes: bool) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    w = F.when(F.col("l_linestatus") == "O", 0.8).otherwise(0.7)
    claims = li.select("l_partkey", F.col("l_returnflag").alias("match_key"), F.col("l_returnflag").alias("value"), F.col("l_suppkey").alias("source_id"), F.col("l_suppkey").cast("string").alias("label"), w.alias("w"), contribution(w, 1 - F.col("l_discount"), F.lit(1.0)).alias("c"))
    return vote(ranked(evidence_groups(claims, ["l_partkey"]), ["l_partkey"]), F.lit(high_stakes), rounded=False)


@query(VOTE_SQL + """
SELECT l_partkey, v AS value, CASE WHEN groups > 1 THEN CASE WHEN (score - second) / score < 0.1 THEN 'demoted_conflict' ELSE 'evidence_vote' END WHEN n = 1 THEN 'single_source' ELSE 'corroborated' END AS method,
round(CASE WHEN groups > 1 AND (score - second) / score < 0.1 THEN least(score * score / total, 0.3) ELSE score * score / total END, 6) AS confidence, CAST(groups AS INT) AS n_groups FROM r WHERE k = 1
""")
def evidence_vote(spark, sf_dir):
    v = part_votes(spark, sf_dir, False)
    return v.select("l_partkey", "value", "method", F.round("confidence", 6).alias("confidence"), F.size("ranked").alias("n_groups"))


@query(VOTE_SQL + """
SELECT l_partkey, CASE WHEN groups > 1 AND (score - second) / score < 0.1 THEN NULL ELSE v END AS value, round((score - second) / score, 6) AS margin,
CASE WHEN groups > 1 AND (score - second) / score < 0.1 THEN 'honesty_gate_null' END AS conflict FROM r WHERE k = 1
""")
def honesty_gate(spark, sf_dir):
    return part_votes(spark, sf_dir, True).select("l_partkey", "value", F.round("margin", 6).alias("margin"), "conflict")


@query("""SELECT doc_id, 'sha256:' || substr(sha256('documents'::BLOB || '\\x00'::BLOB || encode(coalesce(text, ''))), 1, 16) AS source_id FROM documents""")
def content_addresses(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", content_address(F.encode(F.coalesce("text", F.lit("")), "UTF-8"), F.lit("documents")).alias("source_id"))


@query("""
SELECT doc_id, 'sha256:' || substr(sha256('resume'::BLOB || '\\x00'::BLOB || encode(coalesce(text, ''))), 1, 16) AS source_id, row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id) > 1 AS duplicate, coalesce(text, '') <> '' AS ok FROM documents
""")
def source_dedupe(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    inputs = d.select(F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("origin"), F.encode("text", "UTF-8").alias("content"), F.lit("resume").alias("source_type"), F.lit(None).cast("string").alias("ts"), F.col("doc_id").cast("long").alias("ordinal"))
    return register(inputs).select(F.col("ordinal").alias("doc_id"), "source_id", "duplicate", "ok")


ENDINGS = (".csv", ".json", ".txt", ".pdf", "_resume", "_cv_notes", "_github_x", "")


@query(f"""
WITH p AS (SELECT page_id, 'page' || page_id || [{quoted(ENDINGS)}][page_id % 8 + 1] AS origin, lower(html) AS low FROM pages)
SELECT page_id, origin, CASE WHEN origin LIKE '%.csv' THEN 'recruiter_csv' WHEN origin LIKE '%.pdf' THEN 'resume' WHEN origin LIKE '%.json' THEN 'ats_json'
WHEN origin LIKE '%.txt' THEN CASE WHEN contains(low, chr(10) || 'experience') OR contains(low, chr(10) || 'education') OR contains(low, 'summary' || chr(10)) OR contains(low, 'skills' || chr(10)) OR contains(low, 'work experience') THEN 'resume' ELSE 'recruiter_notes' END
WHEN contains(origin, 'resume') OR contains(origin, 'cv') THEN 'resume' WHEN contains(origin, 'notes') THEN 'recruiter_notes' WHEN contains(origin, 'github') THEN 'github' WHEN contains(origin, 'ats') THEN 'ats_json' ELSE 'recruiter_notes' END AS source_type FROM p
""")
def detect_types(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    ending = F.get(F.array(*map(F.lit, ENDINGS)), (F.col("page_id") % 8).cast("int"))
    p = p.withColumn("origin", F.concat(F.lit("page"), F.col("page_id").cast("string"), ending))
    return p.select("page_id", "origin", detect_type(F.col("origin"), F.encode("html", "UTF-8")).alias("source_type"))


@query("""
WITH n AS (SELECT 'customer' AS t, c_custkey AS k, c_name AS s FROM customer UNION ALL SELECT 'supplier', s_suppkey, s_name FROM supplier UNION ALL SELECT 'part', p_partkey, p_name FROM part)
SELECT t, k, trim(s, ' .,-') AS value, trim(regexp_replace(regexp_replace(lower(trim(s, ' .,-')), '[^\\w\\s]', '', 'g'), '\\s+', ' ', 'g')) AS match_key FROM n
""")
def normalize_names(spark, sf_dir):
    rows = [table(spark, sf_dir, t).select(F.lit(t).alias("t"), F.col(k).alias("k"), F.col(s).alias("s")) for t, k, s in (("customer", "c_custkey", "c_name"), ("supplier", "s_suppkey", "s_name"), ("part", "p_partkey", "p_name"))]
    n = rows[0].unionByName(rows[1]).unionByName(rows[2]).withColumn("n", normalize_name(F.col("s")))
    return n.select("t", "k", F.col("n.value").alias("value"), F.col("n.key").alias("match_key"))


EMAIL_SQL = r"[A-Za-z0-9!#$%&''*+/=?^_`{|}~.-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"


@query(f"""
WITH e AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(text, '{EMAIL_SQL}')) AS e FROM documents)
SELECT doc_id, lower(e) AS value, CASE WHEN split_part(lower(e), '@', 2) IN ('gmail.com', 'googlemail.com') THEN replace(split_part(split_part(lower(e), '@', 1), '+', 1), '.', '') ELSE split_part(split_part(lower(e), '@', 1), '+', 1) END || '@' || split_part(lower(e), '@', 2) AS match_key
FROM e WHERE regexp_matches(lower(e), '^[a-z0-9!#$%&''*+/=?^_`{{|}}~.-]+@[a-z0-9](?:[a-z0-9-]{{0,61}}[a-z0-9])?(?:\\.[a-z0-9](?:[a-z0-9-]{{0,61}}[a-z0-9])?)+$')
""")
def emails(spark, sf_dir):
    e = table(spark, sf_dir, "documents").select("doc_id", F.explode(extract_emails(F.col("text"))).alias("e")).withColumn("n", normalize_email(F.col("e")))
    return e.where("n.value is not null").select("doc_id", F.col("n.value").alias("value"), F.col("n.key").alias("match_key"))


@query(r"""
WITH p AS (SELECT doc_id, trim(unnest(regexp_extract_all(text, '(?:\+?\d[\d\s().-]{6,}\d)(?:\s*(?:ext|x)\.?\s*\d{1,6})?'))) AS p FROM documents),
d AS (SELECT doc_id, p, regexp_replace(regexp_replace(p, '(?i)\b(?:ext|x|extension)\.?\s*(\d{1,6})\s*$', ''), '\D', '', 'g') AS digits, contains(regexp_replace(p, '(?i)\b(?:ext|x|extension)\.?\s*(\d{1,6})\s*$', ''), '+') AS plus FROM p WHERE length(regexp_replace(p, '\D', '', 'g')) >= 7)
SELECT doc_id, p AS raw, CASE WHEN plus THEN CASE WHEN length(digits) BETWEEN 7 AND 15 THEN '+' || digits END WHEN length(digits) = 11 AND digits LIKE '1%' THEN '+' || digits
WHEN length(CASE WHEN digits LIKE '0%' THEN substr(digits, 2) ELSE digits END) BETWEEN 7 AND 13 THEN '+49' || CASE WHEN digits LIKE '0%' THEN substr(digits, 2) ELSE digits END END AS e164 FROM d
""")
def phones(spark, sf_dir):
    p = table(spark, sf_dir, "documents").select("doc_id", F.explode(extract_phones(F.col("text"))).alias("raw"))
    return p.select("doc_id", "raw", normalize_phone(F.col("raw"), None, "DE")["value"].alias("e164"))


LINK_PARTS = r"""
WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN url ELSE 'https://' || url END AS u FROM pages),
s AS (SELECT page_id, regexp_replace(lower(regexp_extract(u, '^([^:]*)://([^/?#]*)', 2)), '^www\.', '') AS host, rtrim(regexp_extract(u, '^([^:]*)://([^/?#]*)([^?#]*)', 3), '/') AS path, regexp_extract(u, '\?([^#]*)', 1) AS q FROM u),
k AS (SELECT page_id, coalesce(string_agg(part, '&' ORDER BY i), '') AS query FROM (SELECT page_id, unnest(string_split(q, '&')) AS part, generate_subscripts(string_split(q, '&'), 1) AS i FROM s) WHERE part <> '' AND NOT regexp_matches(split_part(part, '=', 1), '(?i)^(?:utm_|fbclid$|gclid$|mc_|ref$|ref_src$|trk$|original_referer$)') GROUP BY page_id)
"""


@query(LINK_PARTS + """
SELECT s.page_id, 'https://' || host || path || CASE WHEN coalesce(query, '') <> '' THEN '?' || query ELSE '' END AS value, CASE WHEN path = '' AND coalesce(query, '') = '' THEN 'portfolio' ELSE 'other' END AS kind, 0.8 AS quality FROM s LEFT JOIN k USING (page_id)
""")
def links(spark, sf_dir):
    p = table(spark, sf_dir, "pages").withColumn("n", classify_link(F.col("url")))
    return p.select("page_id", F.col("n.value").alias("value"), F.col("n.kind").alias("kind"), F.col("n.quality").alias("quality"))


@query(LINK_PARTS + "SELECT s.page_id, coalesce(query, '') AS query FROM s LEFT JOIN k USING (page_id)")
def tracking(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", strip_tracking(F.regexp_extract("url", r"\?([^#]*)", 1)).alias("query"))


@query(f"""
SELECT doc_id, CASE WHEN upper(lang) IN ({quoted(ISO_COUNTRIES)}) THEN upper(lang) ELSE coalesce(a.code, lang) END AS value, (upper(lang) IN ({quoted(ISO_COUNTRIES)}) OR a.code IS NOT NULL) AS canonical, CASE WHEN upper(lang) IN ({quoted(ISO_COUNTRIES)}) OR a.code IS NOT NULL THEN 1.0 ELSE 0.4 END AS quality
FROM documents LEFT JOIN (VALUES {", ".join(f"('{k}', '{v}')" for k, v in COUNTRY_ALIASES.items())}) a(alias, code) ON a.alias = lower(lang)
""")
def countries(spark, sf_dir):
    d = table(spark, sf_dir, "documents").withColumn("n", normalize_country(F.col("lang")))
    return d.select("doc_id", F.col("n.value").alias("value"), F.col("n.canonical").alias("canonical"), F.col("n.quality").alias("quality"))


@query("""
WITH d AS (SELECT o_orderkey, o_orderkey % 7 AS m, o_orderdate AS d FROM orders)
SELECT o_orderkey, CASE m WHEN 0 THEN strftime(d, '%Y-%m') WHEN 1 THEN strftime(d, '%Y-%m') WHEN 2 THEN NULL WHEN 3 THEN CASE WHEN day(d) > 12 THEN strftime(d, '%Y-%m') ELSE strftime(d, '%Y') END WHEN 4 THEN strftime(d, '%Y') WHEN 5 THEN NULL ELSE NULL END AS value,
CASE m WHEN 3 THEN CASE WHEN day(d) > 12 THEN 1.0 ELSE 0.6 END WHEN 5 THEN 1.0 WHEN 6 THEN 0.0 WHEN 2 THEN 0.0 ELSE 1.0 END AS quality, CASE m WHEN 3 THEN CASE WHEN day(d) > 12 THEN 'month' ELSE 'year' END WHEN 4 THEN 'year' WHEN 5 THEN NULL WHEN 6 THEN NULL WHEN 2 THEN NULL ELSE 'month' END AS precision, m = 5 AS is_current FROM d
""")
def dates(spark, sf_dir):
    o, d = table(spark, sf_dir, "orders"), F.col("o_orderdate")
    said = [F.date_format(d, p) for p in ("yyyy-MM-dd", "MMM yyyy", "MM/yyyy", "dd/MM/yyyy", "yyyy")] + [F.lit("Present"), F.lit("sometime")]
    o = o.withColumn("n", normalize_date(F.get(F.array(*said), (F.col("o_orderkey") % 7).cast("int"))))
    return o.select("o_orderkey", *(F.col(f"n.{k}").alias(k) for k in ("value", "quality", "precision", "is_current")))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 100 < 50 THEN 2000 + o_orderkey % 100 ELSE 1900 + o_orderkey % 100 END AS year, CAST(year(o_orderdate) * 12 + month(o_orderdate) - 1 AS INT) AS month_start, CAST(year(o_orderdate) * 12 + 11 AS INT) AS year_end FROM orders""")
def years_and_months(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", expand_year(F.col("o_orderkey") % 100).alias("year"), month_index(F.date_format("o_orderdate", "yyyy-MM")).alias("month_start"), month_index(F.date_format("o_orderdate", "yyyy"), end=True).alias("year_end"))


ALIASES = {a: s for a, s in Vocabulary().skill_index().items() if len(a) >= 3}


@query(f"""
WITH t AS (SELECT conv_id, turn, regexp_extract_all(lower(text), '[a-z0-9+#.]+') AS w FROM conversations),
g AS (SELECT conv_id, turn, i, n, array_to_string(w[i:i + n - 1], ' ') AS gram FROM t, unnest(range(1, len(w) + 1)) AS a(i), (VALUES (1), (2), (3)) AS b(n) WHERE i + n - 1 <= len(w)),
h AS (SELECT conv_id, turn, skill, gram, row_number() OVER (PARTITION BY conv_id, turn, skill ORDER BY i, n DESC) AS k FROM g JOIN (VALUES {", ".join(f"('{a}', '{s}')" for a, s in ALIASES.items())}) v(alias, skill) ON gram = alias)
SELECT conv_id, turn, skill, gram FROM h WHERE k = 1
""")
def gazetteer_hits(spark, sf_dir):
    c = with_gazetteer(table(spark, sf_dir, "conversations"), "text", Vocabulary())
    return c.select("conv_id", "turn", F.explode("hits").alias("h")).select("conv_id", "turn", "h.skill", "h.gram")


@query("""SELECT event_id, coalesce(json_extract_string(props, '$.key'), json_extract_string(props, '$.k')) AS value, 1 AS n FROM events""")
def json_alias_first(spark, sf_dir):
    v = F.try_parse_json(F.col("props"))
    found = first_of(v, ("key", "k"))
    return table(spark, sf_dir, "events").select("event_id", F.try_variant_get(found, "$", "string").alias("value"), F.size(as_list(found)).alias("n"))


@query("""
WITH t AS (SELECT source, lang, sum(n_chars) AS total FROM documents WHERE lang IS NOT NULL GROUP BY source, lang)
SELECT source, lang, CAST(row_number() OVER (PARTITION BY source ORDER BY total DESC, lang) - 1 AS INT) AS k FROM t
""")
def lang_aggregate(spark, sf_dir):
    """Documents as repositories of their source: languages by characters, as a code host's export counts them by bytes."""
    d = table(spark, sf_dir, "documents").where("lang is not null")
    per_source = d.groupBy("source", "lang").agg(F.sum("n_chars").alias("n"))
    repos = per_source.groupBy("source").agg(F.to_json(F.collect_list(F.struct(F.create_map("lang", "n").alias("languages")))).alias("repos"))
    ranked_ = languages_by_bytes(F.try_variant_get(F.parse_json("repos"), "$", "array<variant>"))
    return repos.select("source", F.posexplode(ranked_).alias("k", "lang"))


@query(f"""
WITH RECURSIVE k AS (SELECT doc_id, text AS key FROM documents UNION SELECT doc_id, unnest(regexp_extract_all(text, '{EMAIL_SQL}')) FROM documents),
e AS (SELECT DISTINCT k.doc_id AS a, m.b FROM k JOIN (SELECT key, min(doc_id) AS b FROM k GROUP BY key) m USING (key)),
u AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT u.a, r.c FROM u JOIN r ON r.doc_id = u.b)
SELECT doc_id, min(c) AS component FROM r GROUP BY doc_id
""")
def tier_a_components(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    keys = d.select("doc_id", F.md5("text").alias("key")).unionByName(d.select("doc_id", F.explode(extract_emails(F.col("text"))).alias("key"))).distinct()
    return connected_components(star_edges(keys, "doc_id")).select(F.col("vertex").alias("doc_id"), "component")


@query("""
SELECT a.c_custkey AS a, b.c_custkey AS b FROM customer a JOIN customer b ON a.c_nationkey = b.c_nationkey AND a.c_mktsegment = b.c_mktsegment AND a.c_custkey < b.c_custkey WHERE a.c_custkey % 7 = 0 OR b.c_custkey % 7 = 0
""")
def tier_b_pairs(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    pairs, _ = blocked_pairs(c, c.where("c_custkey % 7 = 0").select("c_custkey"), node="c_custkey", block=("c_nationkey", "c_mktsegment"), cap=1 << 20)
    return pairs


@query("""
WITH h AS (SELECT c_custkey, sha1(unhex('6f0b8d2e1c3a5b7d9e112a4c6e8f0a13') || encode('name:' || lower(c_name))) AS h FROM customer)
SELECT c_custkey, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || substr('89ab89ab89ab89ab', instr('0123456789abcdef', substr(h, 17, 1)), 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS candidate_id FROM h
""")
def candidate_uuid(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", uuid5(F.concat(F.lit("name:"), F.lower("c_name"))).alias("candidate_id"))


@query("""
WITH s AS (SELECT l_orderkey, l_suppkey, max(least(0.999, 0.5137 * (1 - l_discount))) AS c FROM lineitem GROUP BY ALL)
SELECT l_orderkey, round(1 - product(1 - c), 6) AS score FROM s GROUP BY l_orderkey
""")
def corroboration(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").withColumn("c", contribution(F.lit(0.5137), 1 - F.col("l_discount"), F.lit(1.0)))
    best = li.groupBy("l_orderkey", "l_suppkey").agg(F.max("c").alias("c"))
    folded = F.array_sort(F.collect_list(F.struct("l_suppkey", "c")))
    return best.groupBy("l_orderkey").agg(F.round(noisy_or(F.transform(folded, lambda x: x["c"])), 6).alias("score"))


@query("""
WITH y AS (SELECT o_orderkey, year(o_orderdate) + (month(o_orderdate) - 1) / 12.0 AS y FROM orders)
SELECT o_orderkey, round(greatest(0.7, 1 - 0.05 * ((SELECT max(y) FROM y) - y)), 6) AS recency FROM y
""")
def recency_of_orders(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("y", year_of(F.date_format("o_orderdate", "yyyy-MM-dd")))
    newest = F.broadcast(o.agg(F.max("y").alias("newest")))
    return o.crossJoin(newest).select("o_orderkey", F.round(recency(F.col("y"), F.col("newest")), 6).alias("recency"))


@query("""
WITH g AS (SELECT user_id, event_type, max(least(0.999, greatest(0, value / 1000))) AS score FROM events GROUP BY ALL)
SELECT user_id, string_agg(event_type, ',' ORDER BY round(score, 9) DESC, event_type) AS "values", round(max(score), 6) AS confidence FROM g GROUP BY user_id
""")
def union_dedupe_list(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    claims = e.select("user_id", F.col("event_type").alias("match_key"), F.col("event_type").alias("value"), F.lit("events").alias("source_id"), F.lit("events").alias("label"), F.lit(1.0).alias("w"), F.greatest(F.lit(0.0), contribution(F.lit(1.0), F.col("value") / 1000, F.lit(1.0))).alias("c"))
    r = ranked(evidence_groups(claims, ["user_id"]).withColumn("score", F.round("score", 9)), ["user_id"])
    return r.select("user_id", F.array_join(F.transform("ranked", lambda g: g["display"]), ",").alias("values"), F.round(-F.col("ranked")[0]["less"], 6).alias("confidence"))


@query("""
WITH s AS (SELECT o_custkey, year(o_orderdate) * 12 + month(o_orderdate) - 1 AS s, year(o_orderdate) * 12 + month(o_orderdate) - 1 + o_orderkey % 9 AS e FROM orders),
m AS (SELECT DISTINCT o_custkey, unnest(range(s, e + 1)) AS m FROM s)
SELECT o_custkey, count(*) AS months, CAST(CASE WHEN count(*) % 12 = 6 THEN 2 * ((count(*) // 12 + 1) // 2) ELSE round(count(*) / 12.0) END AS BIGINT) AS years FROM m GROUP BY o_custkey
""")
def merge_spans_years(spark, sf_dir):
    s = month_index(F.date_format("o_orderdate", "yyyy-MM"))
    return merge_spans(table(spark, sf_dir, "orders").select("o_custkey", s.alias("s"), (s + F.col("o_orderkey") % 9).alias("e")), ["o_custkey"])


@query()
def first_fit_cluster(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    size = F.col("p_size")
    entry = F.struct(F.col("p_partkey").alias("ord"), F.col("p_type").alias("company"), F.col("p_name").alias("title"), (2000 + size % 20).cast("string").alias("start"), (2001 + size % 20).cast("string").alias("end"), F.lit(None).cast("string").alias("summary"), (size == 1).alias("is_current"), (size / 100.0).alias("c"), F.col("p_partkey").cast("string").alias("source_id"), F.col("p_brand").alias("label"))
    return merge_entries(p.groupBy("p_brand").agg(F.array_sort(F.collect_list(entry)).alias("entries")), "p_brand").select("p_brand", F.explode("experience").alias("e")).select("p_brand", "e.*")


@query(VOTE_SQL + f"""
, f AS (SELECT l_partkey, score * score / total AS c, groups FROM r WHERE k = 1)
SELECT l_partkey, round(greatest(0, c - 0.15 * ({len(IMPORTANCE) - 2} / {float(len(IMPORTANCE))}) - least(0.2, 0.05 * (groups - 1))), 6) AS overall FROM f
""")
def overall(spark, sf_dir):
    v = vote(ranked_parts(spark, sf_dir), F.lit(False), margin_floor=-1.0, rounded=False)
    confs = F.create_map(F.lit("full_name"), F.col("confidence"), F.lit("skills"), F.col("confidence"))
    return v.select("l_partkey", F.round(overall_confidence(confs, F.map_keys(confs), F.size("ranked") - 1), 6).alias("overall"))


def ranked_parts(spark, sf_dir):
    return part_votes(spark, sf_dir, False).select("l_partkey", "ranked", "total")


@query("""
WITH n AS (SELECT doc_id, regexp_replace(nfc_normalize(coalesce(text, '')), '[\\x00-\\x08\\x0B-\\x1F\\x7F-\\x{9F}\\p{Cf}]', '', 'g') AS t FROM documents)
SELECT doc_id, trim(regexp_replace(t, '[\\s\\p{Z}]+', ' ', 'g')) AS clean FROM n
""")
def clean_texts(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", clean_text(F.col("text")).alias("clean"))


@query("""
WITH s AS (SELECT DISTINCT event_type AS s FROM events UNION SELECT DISTINCT p_type FROM part UNION SELECT DISTINCT lang FROM documents)
SELECT s AS raw, CASE WHEN s = 'es' THEN 'Elasticsearch' WHEN lower(s) = s THEN upper(s[1]) || s[2:] ELSE s END AS value, s = 'es' AS canonical FROM s
""")
def skills(spark, sf_dir):
    raw = table(spark, sf_dir, "events").select(F.col("event_type").alias("raw")).union(table(spark, sf_dir, "part").select("p_type")).union(table(spark, sf_dir, "documents").select("lang")).distinct()
    return raw.withColumn("n", normalize_skill(F.col("raw"))).select("raw", F.col("n.value").alias("value"), F.col("n.canonical").alias("canonical"))


@query("""
SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN NULL ELSE c_name END AS city, CASE c_custkey % 3 WHEN 2 THEN c_mktsegment END AS region, CASE c_custkey % 3 WHEN 0 THEN 'Germany' WHEN 1 THEN c_mktsegment ELSE 'Germany' END AS country FROM customer
""")
def locations(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey") % 3
    raw = F.when(k == 0, "Germany").when(k == 1, F.concat_ws(", ", "c_name", "c_mktsegment")).otherwise(F.concat_ws(" , ", "c_name", "c_mktsegment", F.lit("Germany")))
    return c.select("c_custkey", parse_location(raw).alias("x")).select("c_custkey", "x.*")


@query("""SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN NULL WHEN p_size <= 80 THEN CAST(p_size AS DOUBLE) END AS years FROM part""")
def years_numbers(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", parse_years(F.when(F.col("p_partkey") % 4 == 0, F.lit("about 5")).otherwise(F.col("p_size").cast("string")))["value"].alias("years"))


@query()
def similar_names(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_name")
    next_ = F.lead("p_name").over(Window.partitionBy("p_brand").orderBy("p_partkey"))
    return p.withColumn("next", next_).where("next is not null").select("p_partkey", "p_name", "next", F.round(sequence_ratio("p_name", "next"), 6).alias("ratio"))


def customer_sources(spark, sf_dir) -> DataFrame:
    """One delimited file for each nation, and one note for every fifth customer, made from the table of customers."""
    c = table(spark, sf_dir, "customer").withColumn("mail", F.concat(F.lit("c"), F.col("c_custkey").cast("string"), F.lit("@example.com")))
    phone = F.concat(F.lit("+1 415 "), F.lpad(F.col("c_custkey").cast("string"), 7, "0"))
    line = F.concat_ws(",", "c_name", "mail", phone, "c_mktsegment")
    files = c.groupBy("c_nationkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("c_custkey", line.alias("line")))), lambda x: x["line"]), "\n").alias("body"))
    csvs = files.select(F.concat(F.lit("nation"), F.col("c_nationkey").cast("string"), F.lit(".csv")).alias("origin"), F.encode(F.concat(F.lit("name,email,phone,company\n"), "body"), "UTF-8").alias("content"), F.col("c_nationkey").cast("long").alias("ordinal"))
    notes = c.where("c_custkey % 5 = 0").select(F.concat(F.lit("n"), F.col("c_custkey").cast("string"), F.lit("_notes.md")).alias("origin"), F.encode(F.concat(F.lit("Candidate: "), "c_name", F.lit("\nPython and kafka too\nreach: "), "mail"), "UTF-8").alias("content"), (1000 + F.col("c_custkey")).alias("ordinal"))
    return csvs.unionByName(notes).select("origin", "content", F.lit(None).cast("string").alias("source_type"), F.lit(None).cast("string").alias("ts"), "ordinal")


@query("""
SELECT trim(c_name, ' .,-') AS full_name, 'c' || c_custkey || '@example.com' AS email, '+1415' || lpad(c_custkey::VARCHAR, 7, '0') AS phone, c_mktsegment AS company, CASE WHEN c_custkey % 5 = 0 THEN 'Kafka,Python' ELSE '' END AS skills,
CASE WHEN c_custkey % 5 = 0 THEN 2 ELSE 1 END AS n_sources, round(CASE WHEN c_custkey % 5 = 0 THEN 1 - 0.2 * 0.7 ELSE 0.8 END, 3) AS name_confidence FROM customer
""")
def profiles(spark, sf_dir):
    result = Pipeline(spark).run(customer_sources(spark, sf_dir))
    p = result.profiles
    return p.select("full_name", F.col("emails")[0].alias("email"), F.col("phones")[0].alias("phone"), F.col("experience")[0]["company"].alias("company"), F.array_join(F.transform("skills", lambda s: s["name"]), ",").alias("skills"), F.size(F.col("envelopes")["full_name"]["sources"]).alias("n_sources"), F.round(F.col("field_confidences")["full_name"], 3).alias("name_confidence"))


CONFIG = {
    "fields": [
        {"path": "person.name", "from": "full_name", "type": "string", "required": True}, {"path": "person.mail", "from": "emails[0]", "type": "string"}, {"path": "mails", "from": "emails", "type": "string[]"},
        {"path": "employers", "from": "experience[].company", "type": "string[]"}, {"path": "country", "from": "location.country", "type": "string"},
    ],
    "on_missing": "omit",
}


@query("""
SELECT '{"person":{"name":"' || c_name || '","mail":"c' || c_custkey || '@example.com"},"mails":["c' || c_custkey || '@example.com"],"employers":["' || c_mktsegment || '"]}' AS json FROM customer
""")
def project_config(spark, sf_dir):
    return Pipeline(spark, CONFIG).run(customer_sources(spark, sf_dir)).json().select("json")


GATE_FIELDS = [{"path": "full_name", "required": True}, {"path": "headline", "required": True}, {"path": "city", "from": "location.city"}, {"path": "mails", "from": "emails", "type": "string[]", "required": True}]


@query("""SELECT gate, path, count(*) AS n FROM customer, (VALUES ('missing', 'city'), ('missing', 'headline'), ('output', 'headline')) AS v(gate, path) GROUP BY gate, path""")
def validate_gate(spark, sf_dir):
    """What the gates hold back where a view demands what the sources don't tell: a headline and, under on_missing = error, a city."""
    config = {"fields": GATE_FIELDS, "on_missing": "error"}
    result = Pipeline(spark, config).run(customer_sources(spark, sf_dir), check=False)
    told = lambda gate, df, path: df.select(F.lit(gate).alias("gate"), path.alias("path"))
    found = told("missing", missing(result.profiles, config), F.col("path")).unionByName(told("output", output_violations(result.profiles, config, result.ctx), F.regexp_extract("problem", r"'(\w+)'", 1)))
    found = found.unionByName(told("internal", internal_violations(result.profiles), F.lit("")))
    return found.groupBy("gate", "path").agg(F.count(F.lit(1)).alias("n"))


def person_sources(spark, sf_dir) -> DataFrame:
    """Of every customer a resume, an entry of their nation's applicant export, and an export of a code host."""
    c = table(spark, sf_dir, "customer")
    key, low = F.col("c_custkey").cast("string"), F.lower("c_mktsegment")
    mail = F.concat(F.lit("p"), key, F.lit("@people.example"))
    name = F.concat(F.lit("Buyer "), F.initcap(low))
    resume = F.concat(name, F.lit("\nBerlin, Germany\n"), mail, F.lit(" | linkedin.com/in/p"), key, F.lit("\n\nEXPERIENCE\nBuyer, "), "c_mktsegment", F.lit(" - Jan 2010 - Dec 2015\nBought parts.\nAnd sold.\n\nEDUCATION\nBSc, Trade, College "), F.col("c_nationkey").cast("string"), F.lit(" - 2009\n\nSKILLS\nPython, Kafka\n"))
    phone = F.concat(F.lit("030 "), F.lpad(key, 7, "0"))
    applicant = F.struct(
        name.alias("display_name"), F.struct(F.array(mail).alias("emails"), phone.alias("telephone")).alias("contact"), F.struct(F.lit("Berlin").alias("town"), F.lit("DE").alias("country_code")).alias("geo"),
        F.array(F.struct(F.col("c_mktsegment").alias("employer"), F.lit("Senior buyer").alias("role"), F.lit("2012-03").alias("from"), F.lit("2016").alias("to"))).alias("jobs"),
        F.array(F.struct(F.concat(F.lit("College "), F.col("c_nationkey").cast("string")).alias("college"), F.lit("BSc").alias("level"), F.lit(2009).alias("completed"))).alias("education"), F.lit(20).alias("yoe"),
    )
    host = F.to_json(F.struct(F.struct(F.concat(F.lit("p"), key).alias("login"), mail.alias("email"), F.lit("Likes ").alias("bio")).alias("user"), F.array(F.struct(F.lit("Rust").alias("language"))).alias("repos")))
    row = lambda origin, body, ordinal: (origin.alias("origin"), F.encode(body, "UTF-8").alias("content"), F.lit(None).cast("string").alias("source_type"), F.lit(None).cast("string").alias("ts"), ordinal.cast("long").alias("ordinal"))
    number = F.col("c_custkey")
    forms = c.groupBy("c_nationkey").agg(F.to_json(F.struct(F.collect_list(applicant).alias("applicants"))).alias("body"))
    return (
        c.select(*row(F.concat(F.lit("r"), key, F.lit(".txt")), resume, number * 2)).unionByName(c.select(*row(F.concat(F.lit("h"), key, F.lit(".json")), host, number * 2 + 1)))
        .unionByName(forms.select(*row(F.concat(F.lit("forms"), F.col("c_nationkey").cast("string"), F.lit(".json")), F.col("body"), -1 - F.col("c_nationkey"))))
    )


@query("""
SELECT 'p' || c_custkey || '@people.example' AS email, '+4930' || lpad(c_custkey::VARCHAR, 7, '0') AS phone, 'Buyer ' || upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) AS full_name, 'Berlin' AS city, 'DE' AS country, 'https://linkedin.com/in/p' || c_custkey AS linkedin,
'https://github.com/p' || c_custkey AS github, 'Kafka:0.8,Python:0.8,Rust:0.7' AS skills, c_mktsegment || '|2010-01|2016|Bought parts. And sold.' AS job, 1 AS n_jobs, 'College ' || c_nationkey || '|BSc|Trade|2009' AS school, 1 AS n_schools, 20.0 AS years, 'years_experience:7' AS clash, 3 AS n_sources FROM customer
""")
def person_profiles(spark, sf_dir):
    """Resumes, applicant records and exports of a code host reconciled: one profile a customer. A phone number without a country gets that of
    the candidate; two tellings of one job are merged; stated years clash with those that spans cover."""
    p = Pipeline(spark).run(person_sources(spark, sf_dir), check=False).profiles
    job, school, clash = F.col("experience")[0], F.col("education")[0], F.col("conflicts")[0]
    shown = lambda *parts: F.concat_ws("|", *(x.cast("string") for x in parts))
    return p.select(
        F.col("emails")[0].alias("email"), F.col("phones")[0].alias("phone"), "full_name", F.col("location.city").alias("city"), F.col("location.country").alias("country"), F.col("links.linkedin").alias("linkedin"), F.col("links.github").alias("github"),
        F.array_join(F.transform("skills", lambda s: F.concat(s["name"], F.lit(":"), s["confidence"].cast("string"))), ",").alias("skills"), shown(job["company"], job["start"], job["end"], job["summary"]).alias("job"), F.size("experience").alias("n_jobs"),
        shown(school["institution"], school["degree"], school["field"], school["end_year"]).alias("school"), F.size("education").alias("n_schools"), F.col("years_experience").alias("years"), F.concat(clash["field"], F.lit(":"), clash["alternatives"][0]["value"]).alias("clash"),
        F.size(F.array_distinct(F.transform("provenance", lambda x: x["source"]))).alias("n_sources"),
    )


@query("""SELECT 'Co ' || c_custkey AS company, CAST(2 AS BIGINT) AS records, c_name AS full_name FROM customer""")
def weak_matches(spark, sf_dir):
    """Notes without any address join the record of the same name, company and city; names are numbered, so they are all alike, and what keeps
    them apart is the company."""
    c = table(spark, sf_dir, "customer")
    key = F.col("c_custkey").cast("string")
    firm, town = F.concat(F.lit("Co "), key), F.concat(F.lit("Town "), F.col("c_nationkey").cast("string"))
    rows = c.groupBy("c_nationkey").agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws(",", "c_name", F.concat(F.lit("w"), key, F.lit("@weak.example")), firm, town))), "\n").alias("body"))
    row = lambda origin, body, kind, ordinal: (origin.alias("origin"), F.encode(body, "UTF-8").alias("content"), F.lit(kind).alias("source_type"), F.lit(None).cast("string").alias("ts"), ordinal.cast("long").alias("ordinal"))
    files = rows.select(*row(F.concat(F.lit("w"), F.col("c_nationkey").cast("string"), F.lit(".csv")), F.concat(F.lit("name,email,company,city\n"), "body"), "recruiter_csv", -1 - F.col("c_nationkey")))
    notes = c.select(*row(F.concat(key, F.lit(".txt")), F.concat(F.lit("Candidate: "), "c_name", F.lit("\nEmployer: "), firm, F.lit("\nBased in: "), town), "recruiter_notes", F.col("c_custkey")))
    result = Pipeline(spark).run(files.unionByName(notes), check=False)
    records = result.membership.groupBy("group_id").agg(F.count(F.lit(1)).alias("records"))
    return result.profiles.join(records, "group_id").select(F.col("experience")[0]["company"].alias("company"), "records", "full_name")


@query(f"""
SELECT n_nationkey, coalesce(a.code, n_name) AS value, a.code IS NOT NULL AS canonical, CASE WHEN a.code IS NULL THEN 'unknown_country_kept_as_text' ELSE '' END AS reason
FROM nation LEFT JOIN (VALUES {", ".join(f"('{k}', '{v}')" for k, v in COUNTRY_ALIASES.items())}) a(alias, code) ON a.alias = lower(n_name)
""")
def nation_countries(spark, sf_dir):
    n = table(spark, sf_dir, "nation").withColumn("n", normalize_country(F.col("n_name")))
    return n.select("n_nationkey", F.col("n.value").alias("value"), F.col("n.canonical").alias("canonical"), F.col("n.reason").alias("reason"))


@query("""
WITH d AS (SELECT o_orderkey, year(o_orderdate) AS y, month(o_orderdate) AS m, day(o_orderdate) AS d FROM orders)
SELECT o_orderkey, y || '-' || lpad(CAST(CASE WHEN d > 12 THEN m ELSE d END AS VARCHAR), 2, '0') AS us, y || '-' || lpad(CAST(m AS VARCHAR), 2, '0') AS eu, y || '-' || lpad(CAST(m AS VARCHAR), 2, '0') AS year_first,
CASE WHEN y % 100 < 50 THEN 2000 + y % 100 ELSE 1900 + y % 100 END || '-' || lpad(CAST(m AS VARCHAR), 2, '0') AS two_digits FROM d
""")
def date_locales(spark, sf_dir):
    """Days and months in either order, a year before its month, and years of two digits."""
    o, d = table(spark, sf_dir, "orders"), F.col("o_orderdate")
    value = lambda pattern, locale: normalize_date(F.date_format(d, pattern), locale)["value"]
    return o.select("o_orderkey", value("dd/MM/yyyy", "US").alias("us"), value("dd.MM.yyyy", "EU").alias("eu"), value("yyyy MMM", None).alias("year_first"), value("MMM yy", None).alias("two_digits"))


@query("""
SELECT c_custkey, CASE c_nationkey % 3 WHEN 0 THEN '+49' || lpad(c_custkey::VARCHAR, 8, '0') WHEN 1 THEN '+10' || lpad(c_custkey::VARCHAR, 8, '0') ELSE '+44' || lpad(c_custkey::VARCHAR, 8, '0') END AS e164,
CASE c_nationkey % 3 WHEN 0 THEN 'region_from:DE' WHEN 1 THEN 'region_from:US' ELSE 'region_from:GB' END AS reason, c_custkey::VARCHAR AS ext FROM customer
""")
def phone_regions(spark, sf_dir):
    """Numbers without a country code: those of the candidate's country, with its trunk zero where it has one, else the default's; and extensions."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_nationkey") % 3
    raw = F.concat(F.lit("0"), F.lpad(F.col("c_custkey").cast("string"), 8, "0"), F.lit(" ext "), F.col("c_custkey").cast("string"))
    n = normalize_phone(raw, F.when(k == 0, "DE").when(k == 1, "us"), "GB")
    return c.select("c_custkey", n.alias("n")).select("c_custkey", F.col("n.value").alias("e164"), F.replace("n.reason", F.lit("us"), F.lit("US")).alias("reason"), F.col("n.ext").alias("ext"))


@query("""
WITH b AS (SELECT c_nationkey, c_mktsegment, count(*) AS size FROM customer GROUP BY ALL)
SELECT CAST(c_nationkey AS VARCHAR) || '|' || c_mktsegment AS key, size, size > 12 AS skipped FROM b WHERE size > 12
UNION ALL SELECT 'pairs', coalesce(sum(size * (size - 1) // 2), 0)::BIGINT, false FROM b WHERE size <= 12
""")
def block_cap(spark, sf_dir):
    """Blocks beyond the cap are reported with their sizes and make no pairs; all others make every pair."""
    c = table(spark, sf_dir, "customer")
    blocks = c.select("c_custkey", F.concat_ws("|", "c_nationkey", "c_mktsegment").alias("key"))
    pairs, skipped = blocked_pairs(blocks, c.select("c_custkey"), node="c_custkey", block=("key",), cap=12)
    return skipped.select("key", "size", F.lit(True).alias("skipped")).unionByName(pairs.agg(F.lit("pairs").alias("key"), F.count(F.lit(1)).alias("size"), F.lit(False).alias("skipped")))


FLAGGED = {
    "fields": [{"path": "who.name", "from": "full_name", "normalize": "lower"}, {"path": "knows", "from": "skills[].name", "type": "string[]", "normalize": "canonical"}, {"path": "headline"}, {"path": "trust", "compute": "overall_confidence", "type": "number"}],
    "include_confidence": True, "include_conflicts": True, "on_missing": "null",
}


@query("""
SELECT lower(c_name) AS name, CASE WHEN c_custkey % 5 = 0 THEN '["Kafka","Python"]' ELSE '[]' END AS knows, NULL::VARCHAR AS headline, CASE WHEN c_custkey % 5 = 0 THEN '0.86' ELSE '0.8' END AS confidence, '[]' AS conflicts, true AS trusted FROM customer
""")
def view_flags(spark, sf_dir):
    """A view with renamed, normalised and computed fields, nulls for what is missing, confidences and conflicts."""
    view = Pipeline(spark, FLAGGED).run(customer_sources(spark, sf_dir)).json()
    at = lambda path: F.get_json_object("json", path)
    return view.select(at("$.who.name").alias("name"), at("$.knows").alias("knows"), at("$.headline").alias("headline"), at("$.field_confidence['who.name']").alias("confidence"), at("$.conflicts").alias("conflicts"), at("$.trust").cast("double").between(0.1, 0.99).alias("trusted"))
