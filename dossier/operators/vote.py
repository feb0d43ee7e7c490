"""Evidence: contributions, corroboration, votes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from dossier.functions.semantic import py_round3
from dossier.vocab import IMPORTANCE

# The most a single claim counts; the most a demoted value is trusted; a lead under which a vote is a tie; recency; penalties.
CONTRIBUTION_CAP, DEMOTED_CAP, TIE_MARGIN = 0.999, 0.30, 0.10
RECENCY_SLOPE, RECENCY_FLOOR = 0.05, 0.7
COVERAGE_PENALTY, CONFLICT_PENALTY, MOST_CONFLICT_PENALTY = 0.15, 0.05, 0.20


def clamp01(c: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), c))


def contribution(weight: Column, quality: Column, recency: Column) -> Column:
    return clamp01(F.least(F.lit(CONTRIBUTION_CAP), weight * quality * recency))


def year_of(ts: Column) -> Column:
    """The year of YYYY[-MM...] with months as fractions; null if there is none."""
    month = F.when(F.length(ts) >= 7, F.regexp_extract(ts, r"^.{5}(\d\d)", 1).try_cast("int"))
    return F.when(ts.rlike(r"^\d{4}"), F.substring(ts, 1, 4).try_cast("int") + (F.coalesce(month, F.lit(1)) - 1) / 12.0)


def recency(year: Column, newest: Column) -> Column:
    """1 for the newest and the undated, less by RECENCY_SLOPE a year of age down to RECENCY_FLOOR."""
    return F.when(year.isNull(), 1.0).otherwise(clamp01(F.greatest(F.lit(RECENCY_FLOOR), 1.0 - RECENCY_SLOPE * (newest - year))))


def noisy_or(contributions: Column) -> Column:
    """1 - the product of (1 - c) over an array, folded in its order."""
    return clamp01(1.0 - F.aggregate(contributions, F.lit(1.0), lambda p, c: p * (1.0 - clamp01(c))))


def evidence_groups(claims: DataFrame, by: list[str], key: str = "match_key", source: str = "source_id", label: str = "label", value: str = "value", c: str = "c", w: str = "w") -> DataFrame:
    """One row per *by* and key: display, score, labels, n_sources.

    Of a source's claims for one key the largest contribution counts; sources corroborate by noisy-or, folded in order of their ids, so that
    the result doesn't hang on the order of rows. display is the value of the claim with the largest contribution, then weight, then of
    the first source, then in order of values. Two grouped steps, the first of which combines before its shuffle.
    """
    best = F.min(F.struct((-F.col(c)).alias("c"), (-F.col(w)).alias("w"), F.col(source).alias("source"), F.col(value).alias("value"))).alias("rep")
    per_source = claims.groupBy(*by, key, source).agg(F.max(c).alias("c"), best, F.max(label).alias("label"))
    folded = F.array_sort(F.collect_list(F.struct(F.col(source).alias("s"), F.col("c").alias("c"))))
    return per_source.groupBy(*by, key).agg(
        F.min("rep")["value"].alias("display"), noisy_or(F.transform(folded, lambda x: x["c"])).alias("score"), F.array_sort(F.collect_set("label")).alias("labels"), F.count(F.lit(1)).cast("int").alias("n_sources"),
    )


def ranked(groups: DataFrame, by: list[str]) -> DataFrame:
    """One row per *by*: ranked, an array of groups, best score first, then by display and labels; total, the sum of scores."""
    entry = F.struct((-F.col("score")).alias("less"), F.col("display").alias("display"), F.col("labels").alias("labels"), F.col("n_sources").alias("n_sources"))
    out = groups.groupBy(*by).agg(F.array_sort(F.collect_list(entry)).alias("ranked"))
    return out.withColumn("total", F.aggregate("ranked", F.lit(0.0), lambda a, g: a - g["less"]))


def vote(ranks: DataFrame, high_stakes: Column, margin_floor: float = TIE_MARGIN, rounded: bool = True) -> DataFrame:
    """Decide each row of ranked(): adds value, confidence, sources, method, alternatives, margin, conflict (its reason or null).

    A sole group wins. Of several the first wins if its lead over the second (as a share of its score) reaches *margin_floor*; else
    fields of high stakes get no value, and others keep it with a confidence of at most DEMOTED_CAP. Losing groups stay visible.
    """
    r = F.col("ranked")
    top, second = r[0], F.get(r, F.lit(1))
    score = -top["less"]
    digits = py_round3 if rounded else (lambda c: c)
    margin = F.when(F.size(r) > 1, F.when(score > 0, (score + second["less"]) / score).otherwise(0.0))
    agreement = score / F.when(F.col("total") == 0, 1.0).otherwise(F.col("total"))
    sole, tie = F.size(r) == 1, (F.size(r) > 1) & (margin < margin_floor)
    none = tie & high_stakes
    conf = clamp01(score * agreement)
    method = F.when(sole & (top["n_sources"] == 1), "single_source").when(sole, "corroborated").when(none, "honesty_gate_null").when(tie, "demoted_conflict").otherwise("evidence_vote")
    shown = F.transform(r, lambda g: F.struct(g["display"].alias("value"), (-g["less"]).alias("score"), g["labels"].alias("sources")))
    out = ranks.withColumn("value", F.when(~none, top["display"])).withColumn("method", method)
    out = out.withColumn("_conf", F.when(none, 0.0).when(tie, F.least(conf, F.lit(DEMOTED_CAP))).otherwise(conf))
    out = out.withColumn("sources", F.when(none, F.array().cast("array<string>")).otherwise(top["labels"]))
    out = out.withColumn("alternatives", F.when(none, shown).otherwise(F.slice(shown, 2, 1 << 20))).withColumn("margin", margin)
    out = out.withColumn("conflict", F.when(none, "honesty_gate_null").when(tie, "demoted"))
    return out.withColumn("confidence", digits(F.col("_conf"))).drop("_conf")


def overall_confidence(confidences: Column, present: Column, conflicts: Column) -> Column:
    """From map<field, confidence>, array<field> and a number: the weighted mean of what is known, less penalties for missing important
    fields and for conflicts. Unrounded."""
    num = den = F.lit(0.0)
    for f, w in IMPORTANCE.items():
        c = F.try_element_at(confidences, F.lit(f))
        num = num + F.when(c.isNotNull(), c * w).otherwise(0.0)
        den = den + F.when(c.isNotNull(), w).otherwise(0.0)
    mean = F.when(den > 0, num / F.when(den > 0, den)).otherwise(0.0)
    missing = F.size(F.array_except(F.array(*map(F.lit, IMPORTANCE)), present))
    return clamp01(mean - COVERAGE_PENALTY * (missing / F.lit(float(len(IMPORTANCE)))) - F.least(F.lit(MOST_CONFLICT_PENALTY), CONFLICT_PENALTY * conflicts))


def merge_spans(spans: DataFrame, by: list[str], start: str = "s", end: str = "e") -> DataFrame:
    """(by, months, years): the months that inclusive spans of months cover; spans that touch or overlap count once; spans that end before
    they start are ignored. years: months / 12, half to even."""
    valid = spans.where((F.col(start).isNotNull()) & (F.col(end) >= F.col(start)))
    before = Window.partitionBy(*by).orderBy(start, end).rowsBetween(Window.unboundedPreceding, -1)
    marked = valid.withColumn("_reach", F.max(end).over(before))
    # What a span adds is what lies beyond everything before it.
    added = F.greatest(F.lit(0), F.col(end) - F.greatest(F.col(start) - 1, F.coalesce("_reach", F.col(start) - 1)))
    out = marked.groupBy(*by).agg(F.sum(added).cast("long").alias("months"))
    return out.withColumn("years", F.bround(F.col("months") / 12.0).cast("long"))
