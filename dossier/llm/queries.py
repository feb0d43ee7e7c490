"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dossier.llm import bpe, decontaminate, exact_dedup, langid, license_scan, lm_score, minhash, sharding, substring, toxicity

VOCABULARY_FILE = "byte_bpe_multi_50k.tiktoken"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(VOCABULARY_FILE)
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode(docs, path, public_tokenizers.PATTERN).drop("text")
    return bpe.digests(coded, path, public_tokenizers.PATTERN)


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(read(spark, sf_dir, "documents"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_overlaps(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, read(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select("doc_id", (langid.fold_of("doc_id") == 0).alias("held_out"), "score", "predicted")


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return lm_score.score(docs, lm_score.fit(docs, read(spark, sf_dir, "labels")))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return langid.predict(docs, langid.train(docs))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(read(spark, sf_dir, "documents"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring.remove_repeats(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_digest(read(spark, sf_dir, "documents"))


def op10_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, sf_dir, "documents"), words=3, percent=85)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_byte_bpe, op2_exact_dedup, op3_decontaminate, op4_toxicity, op5_lm_score, op6_language_id, op7_sharding, op8_substring_dedup, op9_license_scan, op10_minhash_dedup)}


def oracle_sql() -> dict[str, str]:
    """SQL for what SQL can express; the others are tested against brute force, round trips or held-out labels."""
    return {"op2_exact_dedup": OP2_SQL, "op8_substring_dedup": OP8_SQL, "op10_minhash_dedup": OP10_SQL}


OP2_SQL = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM d JOIN g USING (t)
"""

OP8_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (SELECT doc_id, i, sha256(array_to_string(ws[i:i + 34], ' ')) AS h FROM w, unnest(range(1, len(ws) - 33)) AS r(i)),
rep AS (SELECT h FROM win GROUP BY h HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, i + k AS p FROM win JOIN rep USING (h), range(0, 35) AS s(k)),
gl AS (SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id),
pos AS (SELECT doc_id, p, ws[p] AS word FROM w, unnest(range(1, len(ws) + 1)) AS r(p)),
kept AS (SELECT pos.doc_id, string_agg(word, ' ' ORDER BY pos.p) AS t FROM pos LEFT JOIN gone ON pos.doc_id = gone.doc_id AND pos.p = gone.p WHERE gone.p IS NULL GROUP BY pos.doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(len(gl.ps), 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
FROM w LEFT JOIN gl USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

OP10_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 2], ' ') AS g FROM w, unnest(range(1, len(ws) - 1)) AS r(i) WHERE len(ws) >= 3
  UNION ALL SELECT doc_id, array_to_string(ws, ' ') FROM w WHERE len(ws) BETWEEN 1 AND 2
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM common JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 85 * (na.n + nb.n - c)),
both_ways AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT doc_id, doc_id AS r FROM w UNION SELECT both_ways.a, reach.r FROM both_ways JOIN reach ON reach.doc_id = both_ways.b),
comp AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM comp LEFT JOIN n USING (doc_id)
"""
