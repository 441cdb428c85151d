"""Grades of conflicts between the values that several sources give (op ids G1-G10, A11, D1, D3, J12).

Values are compared per candidate and field. Only distinct values in comparison form are gathered; a pair
that settles the worst grade ends the comparison, so long lists are not compared in full.
"""

from __future__ import annotations

from itertools import combinations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType

from ..functions import text as tx
from ..functions.similarity import matching_ratio, ratio_udf
from .survivorship import CONFLICT_FIELDS, ID_FIELDS, conflict_value

# Abbreviations of venues, words that tell no venues apart, thresholds of the grades, confidences.
VENUE_ALIASES = {"jacc": "journal of the american college of cardiology", "cjca": "canadian journal of cardiology", "mrm": "magnetic resonance in medicine"}
VENUE_LIGHT = ("the", "of", "and", "in", "for", "journal")
TITLE_A, TITLE_B, VARIANT_LENGTH, VARIANT_JACCARD = 0.985, 0.92, 0.55, 0.72
VENUE_A, VENUE_B, VENUE_RAW_B, VENUE_JACCARD = 0.96, 0.88, 0.9, 0.9
CONFIDENCE = {"none": 0.9, "A": 0.8, "B": 0.65, "blocked": 0.25, "C": 0.45}
BLOCKING = ("doi", "pmid", "pmcid", "title")


def least_ratio(values: list[str], enough: float) -> float:
    """The smallest similarity of two of the values, 1 for fewer than two; the first below enough ends the search."""
    low = 1.0
    for a, b in combinations(values, 2):
        low = min(low, matching_ratio(a, b))
        if low < enough:
            break
    return low


def are_variants(a: str, b: str) -> bool:
    """Whether one title holds most of the other, or both have mostly the same words."""
    short, long = sorted((a, b), key=len)
    if short in long and len(short) >= VARIANT_LENGTH * len(long):
        return True
    x, y = set(a.split()), set(b.split())
    return bool(x and y) and len(x & y) >= VARIANT_JACCARD * len(x | y)


def grade_titles(values: list[str]) -> str:
    """A for equal but for details, B for close or variants of one another, C for different titles."""
    forms = [f for f in map(tx.comparison, values) if f]
    low = least_ratio(forms, TITLE_B)
    if low >= TITLE_B:
        return "A" if low >= TITLE_A else "B"
    return "B" if all(are_variants(a, b) for a, b in combinations(forms, 2)) else "C"


def venue_alias(value: str | None) -> str:
    """A venue in comparison form, its abbreviation spelt out, without a leading article."""
    form = tx.comparison(value) or ""
    form = VENUE_ALIASES.get(form, form).removeprefix("the ")
    return VENUE_ALIASES.get(form, form)


def same_venue(a: str, b: str) -> bool:
    """Whether two aliases name one venue: equal, one in the other, or (nearly) equal telling words."""
    if not a or not b:
        return False
    if a in b or b in a:
        return True
    x, y = (set(v.split()).difference(VENUE_LIGHT) for v in (a, b))
    return bool(x and y) and len(x & y) >= VENUE_JACCARD * len(x | y)


def grade_venues(values: list[str]) -> str:
    """A for one venue in other words, B for similar names, C for different venues."""
    aliases = [venue_alias(v) for v in values]
    if all(same_venue(aliases[0], other) for other in aliases[1:]):
        return "A"
    named = [a for a in aliases if a]
    low = least_ratio(named, VENUE_B) if len(named) > 1 else 0.0
    if low >= VENUE_B:
        return "A" if low >= VENUE_A else "B"
    forms = [f for f in map(tx.comparison, values) if f]
    return "B" if least_ratio(forms, VENUE_RAW_B) >= VENUE_RAW_B else "C"


@F.pandas_udf(StringType())
def text_grade_udf(field: pd.Series, values: pd.Series) -> pd.Series:
    """Grades of the sorted distinct values of titles and venues."""
    grade = {"title": grade_titles, "venue": grade_venues}
    return pd.Series([grade[f](list(v)) for f, v in zip(field, values, strict=True)], dtype=object)


def conflict_values(records: DataFrame, fields: tuple[str, ...] = CONFLICT_FIELDS) -> DataFrame:
    """(candidate_id, field_name, v): the distinct values of matched rows in the form in which they are compared (G1)."""
    cleaned = {"title": tx.title_udf("title"), "venue": tx.venue_udf("venue")}
    rows = records.where("matched").select("candidate_id", *[cleaned.get(f, F.col(f).cast("string")).alias(f) for f in fields])
    long = rows.unpivot(["candidate_id"], list(fields), "field_name", "value")
    return long.select("candidate_id", "field_name", conflict_value(F.col("field_name"), F.col("value")).alias("v")).where("v is not null").distinct()


def graded_conflicts(records: DataFrame, fields: tuple[str, ...] = CONFLICT_FIELDS) -> DataFrame:
    """(candidate_id, field_name, n_values, grade) of the fields of which matched rows give several values.

    Identifiers that differ are always C. Years are B if all are at most one apart, else C (also if fewer
    than two of them are numbers). Titles and venues are graded by similarity. Null and blank values don't count;
    candidates without a conflict give no rows.
    """
    per = conflict_values(records, fields).groupBy("candidate_id", "field_name").agg(F.array_sort(F.collect_set("v")).alias("vs")).where("size(vs) > 1")
    years = F.filter(F.transform("vs", lambda v: v.try_cast("int")), lambda y: y.isNotNull())
    close = (F.size(years) > 1) & (F.array_max(years) - F.array_min(years) <= 1)
    texts = F.col("field_name").isin("title", "venue")
    plain = per.where(~texts).withColumn("grade", F.when(F.col("field_name").isin(*ID_FIELDS), "C").when(F.col("field_name") == "year", F.when(close, "B").otherwise("C")).otherwise("B"))
    graded = per.where(texts).withColumn("grade", text_grade_udf("field_name", "vs"))
    return plain.unionByName(graded).select("candidate_id", "field_name", F.size("vs").cast("bigint").alias("n_values"), "grade")


def assessment(records: DataFrame) -> DataFrame:
    """(candidate_id, n_conflicts, n_severe, worst, blocked, confidence) of every candidate with matched rows.

    Severe conflicts (C) of an identifier, the title or the year block a merge, and so do any two of them.
    """
    severe = F.col("grade") == "C"
    per = graded_conflicts(records).groupBy("candidate_id").agg(F.count("*").alias("n_conflicts"), F.count_if(severe).alias("n_severe"), F.max("grade").alias("worst"), F.bool_or(severe & F.col("field_name").isin(*BLOCKING, "year")).alias("hard"))
    out = records.where("matched and candidate_id is not null").select("candidate_id").distinct().join(per, "candidate_id", "left")
    blocked = F.coalesce("hard", F.lit(False)) | (F.coalesce("n_severe", F.lit(0)) >= 2)
    worst = F.coalesce("worst", F.lit("none"))
    confidence = F.when(blocked, CONFIDENCE["blocked"])
    for grade in ("none", "A", "B", "C"):
        confidence = confidence.when(worst == grade, CONFIDENCE[grade])
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return out.select("candidate_id", zero("n_conflicts"), zero("n_severe"), worst.alias("worst"), blocked.alias("blocked"), confidence.alias("confidence"))


def proposal_quality(assessed: DataFrame) -> DataFrame:
    """One row: proposals in all, of low confidence (under 0.8, unknown as 0), with conflicts, blocked, and by grade."""
    grade = lambda g: F.count_if(F.col("worst") == g).alias(f"grade_{g.lower()}")
    return assessed.agg(F.count("*").alias("n"), F.count_if(F.coalesce("confidence", F.lit(0.0)) < 0.8).alias("low_confidence"), F.count_if(F.col("n_conflicts") > 0).alias("with_conflicts"), F.count_if("blocked").alias("blocked"), grade("A"), grade("B"), grade("C"))


def routed(assessed: DataFrame) -> DataFrame:
    """(candidate_id, route, reason): blocked candidates go to review, the others on."""
    reason = F.when(F.col("blocked"), F.when(F.col("n_severe") >= 2, "several_severe").otherwise("severe_conflict"))
    return assessed.select("candidate_id", F.when(F.col("blocked"), "review").otherwise("assign").alias("route"), reason.alias("reason"))


def stored_assessment(queue: DataFrame) -> DataFrame:
    """(candidate_id, blocked, reason, severe) read from stored payloads, of the present shape or the older one.

    The present shape says canonical_blocked itself. In the older one a field's values stand under its name; more than
    one DOI, PMID or PMCID blocks. Broken, empty or missing payloads block nothing.
    """
    at = lambda f: F.get_json_object("assessment_json", f"$.{f}")
    several = lambda f: F.coalesce(F.size(F.from_json(at(f), "array<string>")) > 1, F.lit(False))
    old = F.array_compact(F.array(*[F.when(several(f), F.lit(f)) for f in ("doi", "pmcid", "pmid")]))
    present = at("canonical_blocked").isNotNull()
    blocked = F.when(present, at("canonical_blocked").isin("true", "1")).otherwise(F.size(old) > 0)
    reason = F.when(present, at("canonical_block_reason")).when(F.size(old) > 0, F.concat(F.lit("legacy_severe_conflict:"), F.array_join(old, ",")))
    return queue.select("candidate_id", blocked.alias("blocked"), reason.alias("reason"), F.array_join(old, ",").alias("severe"))


def suppressed_dois(records: DataFrame, candidates: DataFrame) -> DataFrame:
    """(candidate_id, id, doi, consensus, reason): DOIs of pubmed that other sources speak against.

    The consensus is the first DOI in row order that two sources other than pubmed give; else that of the one
    crossref row, if the candidate's URL is not of NCBI (or it has a PMCID) and venue and year agree; else that of the
    one europepmc row by PMID, if the one pubmed row by PMID has the same PMID, and venue and year agree. candidates has
    candidate_id, venue, year, url and pmcid, one row each. Venues agree by ``same_venue``.
    """
    form = lambda f: conflict_value(F.lit(f), F.col(f))
    rows = records.where("matched").select("candidate_id", "id", "source_name", "query_type", "venue", "year", form("doi").alias("d"), form("pmid").alias("pmid"), form("pmcid").alias("pmcid"), "doi").where("d is not null")
    per_doi = rows.groupBy("candidate_id", "d").agg(F.min("id").alias("first"), F.countDistinct(F.when(F.coalesce("source_name", F.lit("")) != "pubmed", F.col("source_name"))).alias("n"))
    shared = per_doi.where("n >= 2").groupBy("candidate_id").agg(F.min_by("d", "first").alias("shared"))
    only = lambda when, name: F.when(F.count_if(when) == 1, F.max(F.when(when, F.struct("d", "venue", "year", "pmid", "pmcid")))).alias(name)
    by_pmid = F.col("query_type") == "pmid"
    single = rows.groupBy("candidate_id").agg(only(F.col("source_name") == "crossref", "cr"), only((F.col("source_name") == "europepmc") & by_pmid, "ep"), only((F.col("source_name") == "pubmed") & by_pmid, "pm"))
    c = candidates.select("candidate_id", F.col("venue").alias("c_venue"), F.col("year").alias("c_year"), F.col("url").alias("c_url"), F.col("pmcid").alias("c_pmcid"))
    x = single.join(shared, "candidate_id", "left").join(c, "candidate_id", "left")
    host = F.lower(F.regexp_extract("c_url", r"^[^:/?#]+://([^/?#]*)", 1))
    outside = F.coalesce((host != "") & ~host.contains("ncbi.nlm.nih.gov"), F.lit(False))
    years = lambda y: F.coalesce(F.nullif("c_year", F.lit("")) == F.nullif(y, F.lit("")), F.lit(True))
    cr = F.col("cr").isNotNull() & (outside | F.col("c_pmcid").isNotNull()) & venues_agree_udf("c_venue", "cr.venue") & years("cr.year")
    ep = F.col("ep").isNotNull() & (F.col("ep.pmid") == F.col("pm.pmid")) & (F.col("ep.d") != F.col("pm.d")) & (F.col("pm.pmcid").isNotNull() | ~outside) & venues_agree_udf("pm.venue", "ep.venue") & years("ep.year")
    chosen = F.when(F.col("shared").isNotNull(), F.struct(F.col("shared").alias("d"), F.lit("consensus").alias("why"))).when(cr, F.struct(F.col("cr.d").alias("d"), F.lit("crossref_plus_candidate_url").alias("why"))).when(F.coalesce(ep, F.lit(False)), F.struct(F.col("ep.d").alias("d"), F.lit("europepmc_pmid_consensus").alias("why")))
    x = x.select("candidate_id", "c_pmcid", chosen.alias("k")).where("k is not null")
    hit = rows.where("source_name = 'pubmed' and query_type in ('title', 'pmid')").join(x, "candidate_id").where(F.col("d") != F.col("k.d"))
    why = F.when(F.col("pmcid") != F.col("c_pmcid"), "candidate_pmcid").otherwise(F.col("k.why"))
    return hit.select("candidate_id", "id", "doi", F.col("k.d").alias("consensus"), F.concat(F.lit("pubmed_"), "query_type", F.lit("_doi_conflicts_with_"), why).alias("reason"))


@F.pandas_udf(BooleanType())
def venues_agree_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    """Whether venues are the same or much alike; unknown ones are not."""
    return pd.Series([bool(x and y) and (same_venue(venue_alias(x), venue_alias(y)) or matching_ratio(tx.comparison(x) or "", tx.comparison(y) or "") >= VENUE_RAW_B) for x, y in zip(a, b, strict=True)], dtype=bool)


# ---- polluted titles. Patterns of names with footnotes, of degrees, and of scripts other than Latin.
FOOTNOTED = r"\b(?:[A-Z][a-z]+(?:\s+[A-Z][a-z]+){0,2}|[A-Z]{1,4}(?:\s+[A-Z][a-z]+){0,2})\s+\d+\b"
DEGREES = r"(?i)\b(?:phd|msc|md|fmed\s*sci|mbbs|bsc|frcp|mph)\b"
OTHER_SCRIPT = r"[\x{4e00}-\x{9fff}\x{3400}-\x{4dbf}\x{3040}-\x{30ff}\x{ac00}-\x{d7af}\x{0400}-\x{04ff}\x{0600}-\x{06ff}]"


def title_pollution(title):
    """Struct of flags of a title (G8): not in Latin script, a blob of names with footnotes, names or degrees at its end."""
    parts = F.filter(F.transform(F.split(title, ","), lambda p: F.trim(p)), lambda p: p != "")
    tail = F.array_join(F.slice(parts, F.greatest(F.size(parts) - 1, F.lit(1)), 2), ", ")
    names = (F.size(parts) >= 3) & (F.regexp_count(tail, F.lit(r"\b[A-Z][a-z]+\b")) >= 3)
    foreign = title.rlike(OTHER_SCRIPT) | (title.rlike(r"\p{L}") & ~title.rlike(r"\p{IsLatin}"))
    no = lambda c: F.coalesce(c, F.lit(False))
    return F.struct(no(foreign).alias("foreign"), no(F.regexp_count(title, F.lit(FOOTNOTED)) >= 3).alias("footnotes"), no(title.rlike(DEGREES) | names).alias("names_at_end"))


def without_names(title):
    """A title without degrees and what follows them, and without names after its last commas (G8); null if nothing changes."""
    out = F.regexp_replace(title, rf"{DEGREES}.*$", "")
    out = F.regexp_replace(F.regexp_replace(out, r"[ ,;]+$", ""), r"(?:,\s*[A-Z][a-z]+(?:\s+[A-Z]\.?)?(?:\s+[A-Z][a-z]+){0,2})+$", "")
    out = F.trim(F.regexp_replace(F.regexp_replace(out, r"(?:(?:^|\s)(?:[A-Z][a-z]+|[A-Z]\.?)[,.]*){2,}$", ""), r"[ ,;]+$", ""))
    return F.when((out != "") & (out != title) & title_pollution(title)["names_at_end"], out)


def salvaged_titles(titles: DataFrame, answers: DataFrame, threshold: float = 0.85, gain: float = 0.05) -> DataFrame:
    """(candidate_id, cleaned, raw_similarity, similarity, id): titles that match an answer once the names at their end are off.

    The best answer to the cleaned title must reach the threshold, gain on the best one to the raw title, and carry an
    identifier. titles has candidate_id and title, answers candidate_id, id, title, doi, pmid, pmcid.
    """
    rows = titles.withColumn("cleaned", without_names(F.col("title"))).where("cleaned is not null").withColumnRenamed("title", "raw")
    both = rows.join(answers.where("title is not null"), "candidate_id").withColumn("s", ratio_udf("cleaned", "title")).withColumn("r", ratio_udf("raw", "title"))
    best = both.groupBy("candidate_id", "cleaned").agg(F.max("r").alias("r"), F.max(F.struct(F.col("s"), (-F.col("id")).alias("neg"), F.expr("coalesce(doi, pmid, pmcid, '') <> ''").alias("known"))).alias("b"))
    return best.where((F.col("b.s") >= threshold) & (F.col("b.s") >= F.col("r") + gain) & F.col("b.known")).select("candidate_id", "cleaned", F.round("r", 3).alias("raw_similarity"), F.round("b.s", 3).alias("similarity"), (-F.col("b.neg")).alias("id"))
