"""Queries of whole stages: lookups, links, acceptance, grading, audits, and their SQL. Importing registers them."""

from __future__ import annotations

from pyspark.sql import functions as F

from .functions import identifiers as ids
from .functions import text as tx
from .operators import acceptance, grading, links, lookups, relational, reports, resolve
from .plans import normalize, stages
from .queries import _CANON, _FIND_DOI, _NAMES, _SQUEEZE, _at, query
from .tables import table as _t

# ---- what candidates can be asked for: one row per candidate, from its earliest row with a title
_PATTERNS = {"pmid": ids.PMID, "pmcid": ids.PMCID, "arxiv": ids.ARXIV}
_FIRST = f"""first AS (SELECT candidate_id, id, {_at(_FIND_DOI, 'c')} AS doi, nullif(regexp_extract(c, '{_PATTERNS['pmid']}', 1), '') AS pmid, nullif(upper(regexp_extract(c, '{_PATTERNS['pmcid']}', 1)), '') AS pmcid, nullif(regexp_extract(c, '{_PATTERNS['arxiv']}', 1), '') AS arxiv,
 {_at(_CANON, 'u')} AS url, nullif({_SQUEEZE.format('raw_title')}, '') AS title, venue_guess AS venue, nullif(trim(year_guess), '') AS year
 FROM (SELECT *, concat_ws(chr(10), raw_title, raw_link, raw_snippet, target_url) AS c, coalesce(target_url, raw_link) AS u, row_number() OVER (PARTITION BY candidate_id ORDER BY coalesce(trim(raw_title), '') = '', id) AS k FROM paper_candidate WHERE candidate_id IS NOT NULL) WHERE k = 1)"""


def _first(s, d):
    c = _t(s, d, "paper_candidate").where("candidate_id is not null")
    cols = ["raw_title", "raw_authors", "raw_link", "raw_snippet", "target_url", "venue_guess", "year_guess"]
    one = c.groupBy("candidate_id").agg(F.min_by(F.struct("id", *cols), F.struct(F.coalesce(F.trim("raw_title") == "", F.lit(True)), "id")).alias("x")).select("candidate_id", "x.*")
    keys = normalize.normalized_keys(one)
    own = one.select("candidate_id", F.nullif(tx.squeeze(F.col("raw_title")), F.lit("")).alias("title"), F.col("venue_guess").alias("venue"))
    return keys.select("candidate_id", "id", "doi", "pmid", "pmcid", "arxiv", "url", F.col("year_guess").alias("year")).join(own, "candidate_id")


def _doi_key(x: str) -> str:
    return f"regexp_replace(lower(trim({x})), '^https://doi\\.org/', '')"


_MEDICAL = f"regexp_matches(lower(concat_ws(' ', venue, title)), '{lookups.BIOMEDICAL}')"
_ASKED = " UNION ALL ".join(
    [f"SELECT candidate_id, '{p}' AS provider, 'doi' AS query_type, {_doi_key('doi')} AS query_key FROM first WHERE doi IS NOT NULL UNION ALL SELECT candidate_id, '{p}', 'title', title FROM first WHERE doi IS NULL AND title IS NOT NULL" for p in ("crossref", "openalex", "semanticscholar")]
    + [f"SELECT candidate_id, '{p}', 'pmid', pmid FROM first WHERE pmid IS NOT NULL UNION ALL SELECT candidate_id, '{p}', 'title', title FROM first WHERE pmid IS NULL AND doi IS NULL AND title IS NOT NULL AND {_MEDICAL}" for p in ("pubmed", "europepmc")]
    + ["SELECT candidate_id, 'arxiv', 'arxiv_id', arxiv FROM first WHERE arxiv IS NOT NULL UNION ALL SELECT candidate_id, 'arxiv', 'title', title FROM first WHERE arxiv IS NULL AND contains(lower(title), 'arxiv')"]
)
_INTENTS = f"WITH {_FIRST}, asked AS ({_ASKED})"
_LEADERS = "led AS (SELECT candidate_id, min(leader_candidate_id) AS leader FROM candidate_resolution_status WHERE status = 'clustered' AND leader_candidate_id IS NOT NULL AND leader_candidate_id <> candidate_id GROUP BY 1)"


def _asked(s, d):
    return lookups.intents(_first(s, d))


def _followers(s, d):
    return _t(s, d, "candidate_resolution_status").where("status = 'clustered'").select("candidate_id", F.col("leader_candidate_id").alias("leader"))


@query(f"{_INTENTS} SELECT * FROM asked")
def lookup_intents(s, d):
    """What to ask which provider for every candidate."""
    return _asked(s, d)


@query(f"{_INTENTS}, {_LEADERS} SELECT candidate_id, provider, query_type, query_key FROM asked WHERE candidate_id NOT IN (SELECT candidate_id FROM led) UNION ALL SELECT led.candidate_id, provider, query_type, query_key FROM led JOIN asked ON asked.candidate_id = led.leader")
def cloned_intents(s, d):
    """Intents in which followers ask what their leaders ask."""
    return lookups.with_followers(_asked(s, d), _followers(s, d))


_LANE = "CASE WHEN provider = 'semanticscholar' THEN 'slow_fallback' WHEN query_type IN ('doi', 'doi_batch', 'pmid', 'pmcid', 'arxiv_id') THEN 'identifier_fastpath' WHEN provider IN ('crossref', 'openalex', 'arxiv') THEN 'title_core' WHEN provider IN ('pubmed', 'europepmc') THEN 'biomedical_fallback' ELSE 'slow_fallback' END"


@query(f"{_INTENTS} SELECT candidate_id, provider, query_type, query_key, lane, CASE lane WHEN 'identifier_fastpath' THEN 1 WHEN 'title_core' THEN 2 ELSE 3 END::BIGINT AS lane_rank FROM (SELECT *, {_LANE} AS lane FROM asked) WHERE lane <> 'slow_fallback'")
def laned_intents(s, d):
    """Intents of three lanes with their rank."""
    return lookups.in_lanes(_asked(s, d), lookups.LANES[:3])


@query(f"""{_INTENTS}, r AS (SELECT a.*, coalesce(f.title, '') || chr(31) || coalesce(f.year, '') AS ctx FROM asked a JOIN first f ON f.candidate_id = a.candidate_id),
 c AS (SELECT provider, query_type, query_key, ctx, count(*) AS n, min(candidate_id) AS first_one FROM r GROUP BY ALL), k AS (SELECT provider, query_type, query_key, count(*) AS contexts FROM c GROUP BY ALL)
SELECT provider, query_type, query_key, variant, sum(n)::BIGINT AS n_intents, min(first_one) AS first_candidate FROM (SELECT c.*, CASE WHEN query_type IN ('doi', 'doi_batch', 'pmid', 'pmcid', 'arxiv_id') OR contexts = 1 THEN 'default' ELSE 'ctx_' || substr(sha1(ctx), 1, 16) END AS variant FROM c JOIN k USING (provider, query_type, query_key)) GROUP BY ALL""")
def dispatch_groups(s, d):
    """The requests that intents need; titles asked with other years ask apart."""
    asked = _asked(s, d).join(_first(s, d).select("candidate_id", "title", "year"), "candidate_id")
    return lookups.dispatch_groups(asked, ["title", "year"])


_KEYS = f"""keys AS (SELECT DISTINCT candidate_id, key_type, key FROM (SELECT candidate_id, 'doi' AS key_type, regexp_replace(lower(trim(doi)), '^https?://doi\\.org/', '') AS key FROM first UNION ALL SELECT candidate_id, 'pmid', trim(pmid) FROM first UNION ALL SELECT candidate_id, 'pmcid', upper(trim(pmcid)) FROM first
 UNION ALL SELECT candidate_id, 'arxiv', lower(trim(arxiv)) FROM first UNION ALL SELECT candidate_id, 'scholar_cluster', regexp_extract(url, '[?&]cluster=([^&#]+)', 1) FROM first UNION ALL SELECT candidate_id, 'url', trim(url) FROM first) WHERE key <> '')"""


@query(f"WITH {_FIRST}, {_KEYS} SELECT * FROM keys")
def exact_keys(s, d):
    """The exact keys of candidates (I8)."""
    return links.exact_keys(_first(s, d))


@query(f"""{_INTENTS}, {_KEYS}, k AS (SELECT candidate_id, list(DISTINCT key_type) FILTER (WHERE key_type <> 'doi') AS other FROM keys GROUP BY 1), l AS (SELECT DISTINCT leader_candidate_id AS candidate_id FROM candidate_resolution_status WHERE status = 'clustered' AND leader_candidate_id IS NOT NULL),
 t AS (SELECT DISTINCT candidate_id FROM asked WHERE query_type = 'title' AND provider IN ('crossref', 'openalex', 'arxiv'))
SELECT t.candidate_id, CASE WHEN l.candidate_id IS NOT NULL THEN 'cluster_leader_path' WHEN k.candidate_id IS NOT NULL THEN 'identifier_present_but_not_sufficient_for_provider_path' ELSE 'no_identifier_available' END AS reason,
 CASE WHEN l.candidate_id IS NULL AND len(other) = 1 THEN CASE other[1] WHEN 'pmid' THEN 'pmid_without_doi' WHEN 'pmcid' THEN 'pmcid_only' WHEN 'url' THEN 'url_canonical_only' WHEN 'scholar_cluster' THEN 'scholar_cluster_only' ELSE 'arxiv_only' END WHEN l.candidate_id IS NULL AND len(other) > 1 THEN 'mixed_non_doi_identifier' END AS subreason
FROM t LEFT JOIN k ON k.candidate_id = t.candidate_id LEFT JOIN l ON l.candidate_id = t.candidate_id""")
def title_reasons(s, d):
    """Why candidates ask by title."""
    leaders = _followers(s, d).where("leader is not null").select("leader").distinct()
    return lookups.title_reasons(_asked(s, d), links.exact_keys(_first(s, d)), leaders)


# ---- stored answers
_QK = "nullif(trim(CASE WHEN query_type IN ('doi', 'doi_batch') THEN regexp_replace(lower(trim(query_string)), '^https://doi\\.org/', '') WHEN query_type = 'title' THEN regexp_replace(query_string, '\\s+', ' ', 'g') ELSE trim(query_string) END), '')"
_HTTP = "try_cast(json_extract_string(j, '$.http_error') AS INT)"
_STORED = f"""stored AS (SELECT provider, query_type, query_key, id, candidate_id, cache_status, CASE WHEN http IS NOT NULL THEN 'http_' || http WHEN cache_status = 'transient_error' THEN 'provider_error' END AS error_type,
 created_at + to_minutes(CASE cache_status WHEN 'positive_match' THEN 43200 WHEN 'permanent_no_match' THEN 4320 ELSE 15 END) AS expires_at
 FROM (SELECT source_name AS provider, query_type, {_QK} AS query_key, id, candidate_id, created_at, {_HTTP} AS http, CASE WHEN lower(json_extract_string(j, '$.error')) NOT IN ('', 'false', 'null', '0', '[]', '{{}}') THEN 'transient_error' WHEN {_HTTP} = 404 THEN 'permanent_no_match' WHEN {_HTTP} IS NOT NULL THEN 'transient_error' WHEN coalesce(matched, false) THEN 'positive_match' ELSE 'permanent_no_match' END AS cache_status
  FROM (SELECT *, CASE WHEN json_valid(raw_payload_json) THEN raw_payload_json END AS j FROM source_record)))"""
_NOW = "TIMESTAMP '2025-01-01 00:00:00'"


@query(f"WITH {_STORED} SELECT * FROM stored")
def stored_answers(s, d):
    """Lookups with what their answer says and until when it holds."""
    return lookups.stored_answers(_t(s, d, "source_record"))


_VALID = f"valid AS (SELECT provider, query_type, query_key, max(id) AS id, arg_max(cache_status, id) AS cache_status, arg_max(expires_at, id) AS expires_at FROM stored WHERE query_key IS NOT NULL AND cache_status IN ('positive_match', 'permanent_no_match') AND expires_at > {_NOW} GROUP BY ALL)"


@query(f"WITH {_STORED}, {_VALID} SELECT * FROM valid")
def valid_answers(s, d):
    """The latest answer of each lookup that holds on a day."""
    return lookups.valid_answers(lookups.stored_answers(_t(s, d, "source_record")), F.lit("2025-01-01 00:00:00").cast("timestamp_ntz"))


@query(f"""{_INTENTS}, {_STORED}, v AS (SELECT provider, query_type, query_key, arg_max(cache_status, id) AS cache_status FROM stored WHERE query_key IS NOT NULL AND cache_status <> 'transient_error' AND expires_at > TIMESTAMP '1970-01-01' GROUP BY ALL)
SELECT candidate_id, provider, query_type, query_key, coalesce(cache_status, 'no_answer') AS outcome, cache_status IS NULL AND candidate_id = min(candidate_id) OVER (PARTITION BY provider, query_type, query_key) AS is_request FROM asked LEFT JOIN v USING (provider, query_type, query_key)""")
def fanned_out(s, d):
    """Intents with the stored answer of their lookup; one candidate of a lookup asks."""
    answers = lookups.valid_answers(lookups.stored_answers(_t(s, d, "source_record")), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    return lookups.fanned_out(_asked(s, d), answers)


@query(f"""{_INTENTS}, st AS (SELECT candidate_id, source_name AS provider, query_type, arg_max(CASE WHEN matched THEN 'ok' WHEN external_id IS NULL THEN 'error' ELSE 'no_match' END, id) AS status FROM source_record GROUP BY ALL)
SELECT asked.* FROM asked LEFT JOIN st USING (candidate_id, provider, query_type) WHERE status IS NULL OR status = 'error'""")
def runnable_intents(s, d):
    """Intents without an answer or whose last one failed (F5, E13); unmatched rows without an id count as failed."""
    status = F.when(F.col("matched"), "ok").when(F.col("external_id").isNull(), "error").otherwise("no_match")
    return lookups.runnable(_asked(s, d), _t(s, d, "source_record").select("id", "candidate_id", F.col("source_name").alias("provider"), "query_type", status.alias("status")))


_PLAN = """per AS (SELECT coalesce(source_name, 'none') AS provider, query_type, count(*) AS n_intents, count(DISTINCT query_string) AS n_unique, CAST(CASE WHEN source_name = 'openalex' AND query_type = 'doi' THEN ceil(count(DISTINCT query_string) / 50) ELSE count(DISTINCT query_string) END AS BIGINT) AS n_requests FROM source_record GROUP BY 1, 2, source_name),
 lines AS (SELECT provider, query_type, CASE WHEN query_type IN ('doi', 'pmid', 'pmcid', 'arxiv_id', 'doi_batch') THEN 'identifier' WHEN query_type IS NOT NULL THEN 'title' END AS family, n_intents, n_unique, n_requests FROM per UNION ALL SELECT provider, 'all', 'all', sum(n_intents)::BIGINT, sum(n_unique)::BIGINT, sum(n_requests)::BIGINT FROM per GROUP BY provider)"""


@query(f"WITH {_PLAN} SELECT *, n_intents - n_unique AS n_duplicate, n_intents - n_requests AS saved, n_unique - n_requests AS saved_by_batching FROM lines")
def plan_report(s, d):
    """Lookups, distinct ones, requests and savings per provider and type, and per provider."""
    return lookups.plan_report(_t(s, d, "source_record"))


@query(f"WITH {_PLAN} SELECT provider, query_type, n_intents - n_requests AS saved FROM lines WHERE query_type <> 'all' AND n_intents > n_requests ORDER BY saved DESC, provider, query_type")
def plan_recommendations(s, d):
    """The lookups that are worth sharing, the most saving first."""
    return lookups.recommendations(lookups.plan_report(_t(s, d, "source_record")))


@query("""WITH o AS (SELECT DISTINCT source_name, query_type, query_string, candidate_id FROM source_record WHERE query_string IS NOT NULL), t AS (SELECT source_name, query_type, query_string, count(candidate_id) AS n_candidates FROM o GROUP BY 1, 2, 3 HAVING count(*) > 1 ORDER BY n_candidates DESC, source_name NULLS FIRST, query_type NULLS FIRST, query_string LIMIT 10)
SELECT source_name, query_type, query_string, n_candidates, array_to_string(list_sort(list(candidate_id))[1:5], ',') AS candidates FROM t JOIN o ON o.source_name IS NOT DISTINCT FROM t.source_name AND o.query_type IS NOT DISTINCT FROM t.query_type AND o.query_string = t.query_string GROUP BY t.source_name, t.query_type, t.query_string, n_candidates""".replace("SELECT source_name, query_type, query_string, n_candidates, array", "SELECT t.source_name, t.query_type, t.query_string, n_candidates, array"))
def shared_lookups(s, d):
    """The ten lookups that most candidates share, with their first candidates."""
    return lookups.shared_lookups(_t(s, d, "source_record"))


# ---- links and assignment
@query(f"""WITH {_FIRST}, {_KEYS}, alias AS (SELECT key_type, key, arg_min(paper_id, l.id) AS paper_id FROM library_prelink_match l JOIN keys USING (candidate_id) WHERE paper_id IS NOT NULL GROUP BY 1, 2),
 hits AS (SELECT k.candidate_id, list_position(['doi', 'pmid', 'pmcid', 'arxiv', 'scholar_cluster', 'url'], k.key_type) AS p, a.paper_id, k.key_type FROM keys k JOIN alias a USING (key_type, key) WHERE k.candidate_id NOT IN (SELECT candidate_id FROM library_prelink_match WHERE paper_id IS NOT NULL AND candidate_id IS NOT NULL))
SELECT candidate_id, paper_id, key_type || '_exact' AS rule, CASE key_type WHEN 'arxiv' THEN 0.99::DOUBLE WHEN 'scholar_cluster' THEN 0.98::DOUBLE WHEN 'url' THEN 0.97::DOUBLE ELSE 1.0::DOUBLE END AS confidence FROM (SELECT *, row_number() OVER (PARTITION BY candidate_id ORDER BY p, paper_id) AS n FROM hits) WHERE n = 1""")
def prelinked(s, d):
    """Candidates that a key ties to a paper of the library, by the first rule that hits."""
    keys, own = links.exact_keys(_first(s, d)), _t(s, d, "library_prelink_match")
    return links.prelinked(keys, links.library_aliases(own, keys), own.where("paper_id is not null"))


@query("""WITH p AS (SELECT min(candidate_id) AS paper_id, doi FROM source_record WHERE matched AND trim(doi) <> '' GROUP BY doi), st AS (SELECT min(p.paper_id) AS paper_id, arg_max(CASE WHEN matched THEN 'ok' WHEN r.external_id IS NULL THEN 'error' ELSE 'no_match' END, r.id) AS status FROM source_record r JOIN p ON p.doi = r.query_string WHERE source_name = 'openalex' GROUP BY p.paper_id)
SELECT p.paper_id, p.doi FROM p LEFT JOIN st ON st.paper_id = p.paper_id WHERE status IS NULL OR status = 'error'""")
def open_access_queue(s, d):
    """DOIs that are still to be asked for open access (F14, F8, J4); lookups by that DOI at one provider stand for statuses."""
    r = _t(s, d, "source_record")
    papers = r.where("matched and trim(doi) <> ''").groupBy("doi").agg(F.min("candidate_id").alias("paper_id"))
    status = F.when(F.col("matched"), "ok").when(F.col("external_id").isNull(), "error").otherwise("no_match")
    asked = r.where("source_name = 'openalex'").join(papers.select(F.col("doi").alias("p"), "paper_id"), F.col("query_string") == F.col("p")).select("paper_id", F.lit("unpaywall").alias("provider"), status.alias("status"), "id")
    return links.oa_queue(papers, asked)


# ---- acceptance
@query()
def accepted_answers(s, d):
    """Matched records with the evidence that they are their candidate's paper (X3-X7, E11); sequence similarity is no SQL."""
    rows = acceptance.accepted(acceptance.evidence(acceptance.asked_answers(_t(s, d, "paper_candidate"), _t(s, d, "source_record"))))
    return rows.select("candidate_id", "id", F.round("similarity", 6).alias("similarity"), "author", "venue_agrees", "accepted")


@query()
def best_answers(s, d):
    """The best record of each candidate."""
    rows = acceptance.accepted(acceptance.evidence(acceptance.asked_answers(_t(s, d, "paper_candidate"), _t(s, d, "source_record"))))
    return acceptance.best_answers(rows, "candidate_id", "id").select("candidate_id", "id", "source_name", "accepted", F.round("similarity", 6).alias("similarity"))


_FAMILY = f"string_split_regex(list_extract({_NAMES.format('raw_authors')}, 1), '\\s+')[-1]"


@query(f"""WITH c AS (SELECT candidate_id, arg_min(struct_pack(f := {_FAMILY}), id) AS x FROM paper_candidate WHERE trim(raw_title) <> '' GROUP BY 1)
SELECT r.id, CASE WHEN coalesce(c.x.f, '') <> '' AND a IS NOT NULL THEN contains(lower(a), lower(trim(c.x.f))) END AS author FROM (SELECT *, CASE WHEN json_valid(authors_json) THEN trim(json_extract_string(authors_json, '$[0]')) END AS a FROM source_record WHERE matched) r JOIN c ON c.candidate_id = r.candidate_id""")
def author_hints(s, d):
    """Whether the first author's family name is in the record's first author; null if either is unknown."""
    from .functions import similarity as sim

    rows = acceptance.asked_answers(_t(s, d, "paper_candidate"), _t(s, d, "source_record"))
    return rows.select("id", sim.family_in_first(F.col("q_family"), F.col("authors")).alias("author"))


# ---- grading
@query("""SELECT candidate_id, CASE WHEN b IS NOT NULL THEN b IN ('true', '1') ELSE len(old) > 0 END AS blocked, CASE WHEN b IS NOT NULL THEN json_extract_string(j, '$.canonical_block_reason') WHEN len(old) > 0 THEN 'legacy_severe_conflict:' || array_to_string(old, ',') END AS reason, array_to_string(old, ',') AS severe
FROM (SELECT candidate_id, j, json_extract_string(j, '$.canonical_blocked') AS b, list_filter(['doi', 'pmcid', 'pmid'], lambda f: coalesce(json_array_length(j, '$.' || f) > 1, false)) AS old FROM (SELECT candidate_id, CASE WHEN json_valid(assessment_json) THEN assessment_json END AS j FROM merge_review_queue))""")
def stored_assessments(s, d):
    """Blocks read from stored payloads, of the present shape or the older one."""
    return grading.stored_assessment(_t(s, d, "merge_review_queue"))


@query()
def suppressed_dois(s, d):
    """DOIs of pubmed that other sources speak against."""
    return grading.suppressed_dois(_t(s, d, "source_record"), _first(s, d))


@query()
def routed_candidates(s, d):
    """Candidates whose conflicts send them to review."""
    return grading.routed(grading.assessment(_t(s, d, "source_record")))


_F8 = r"\b(?:[A-Z][a-z]+(?:\s+[A-Z][a-z]+){0,2}|[A-Z]{1,4}(?:\s+[A-Z][a-z]+){0,2})\s+\d+\b"


@query(rf"""SELECT id, coalesce(regexp_matches(raw_title, '[\x{{4e00}}-\x{{9fff}}\x{{3400}}-\x{{4dbf}}\x{{3040}}-\x{{30ff}}\x{{ac00}}-\x{{d7af}}\x{{0400}}-\x{{04ff}}\x{{0600}}-\x{{06ff}}]') OR (regexp_matches(raw_title, '\p{{L}}') AND NOT regexp_matches(raw_title, '\p{{Latin}}')), false) AS "foreign",
 coalesce(len(regexp_extract_all(raw_title, '{_F8}')) >= 3, false) AS footnotes, coalesce(regexp_matches(raw_title, '(?i)\b(?:phd|msc|md|fmed\s*sci|mbbs|bsc|frcp|mph)\b') OR (len(p) >= 3 AND len(regexp_extract_all(array_to_string(p[-2:], ', '), '\b[A-Z][a-z]+\b')) >= 3), false) AS names_at_end
FROM (SELECT *, list_filter(list_transform(string_split(raw_title, ','), lambda x: trim(x)), lambda x: x <> '') AS p FROM paper_candidate)""")
def title_pollution(s, d):
    """Titles in other scripts, with footnoted names, or with names at their end."""
    return _t(s, d, "paper_candidate").select("id", grading.title_pollution(F.col("raw_title")).alias("x")).select("id", "x.*")


@query()
def salvaged_titles(s, d):
    """Titles that match a record once the names at their end are off."""
    return grading.salvaged_titles(_first(s, d).select("candidate_id", "title"), _t(s, d, "source_record"))


@query()
def merged_records(s, d):
    """The merged record of every candidate (M3)."""
    return stages.merged_records(_t(s, d, "paper_candidate"), _t(s, d, "source_record"))


@query("""WITH c AS (SELECT candidate_id, arg_min(struct_pack(t := raw_title, a := raw_authors, y := year_guess, v := venue_guess), id) AS x FROM paper_candidate GROUP BY 1), s AS (SELECT candidate_id, count(*) AS n_sources, count(*) FILTER (WHERE matched) AS n_matched, array_to_string(list_sort(list(DISTINCT source_name) FILTER (WHERE matched)), ',') AS sources, max(match_score) AS best_score, max(latency_ms) AS slowest FROM source_record GROUP BY 1),
 a AS (SELECT candidate_id, min(paper_id) AS paper_id, min(merge_confidence) AS confidence FROM fallback_audit GROUP BY 1)
SELECT q.candidate_id, q.reason, json_extract_string(j, '$.grade') AS grade, json_extract_string(j, '$.verdict') AS verdict, json_extract_string(j, '$.compared_with') AS compared_with, coalesce(json_array_length(j, '$.severe'), 0)::BIGINT AS n_severe, c.x.t AS raw_title, c.x.a AS raw_authors, c.x.y AS year_guess, c.x.v AS venue_guess, r.status, r.resolution_rule, r.leader_candidate_id, s.n_sources, s.n_matched, nullif(s.sources, '') AS sources, s.best_score, s.slowest, a.paper_id, a.confidence,
 CAST(q.updated_at AS VARCHAR) AS updated_at FROM (SELECT *, CASE WHEN json_valid(assessment_json) THEN assessment_json END AS j FROM merge_review_queue) q LEFT JOIN c USING (candidate_id) LEFT JOIN s USING (candidate_id) LEFT JOIN a USING (candidate_id) LEFT JOIN candidate_resolution_status r USING (candidate_id)""")
def review_rows(s, d):
    """The review queue with everything that a reviewer sees: 21 columns of five tables."""
    at = lambda f: F.get_json_object("assessment_json", f"$.{f}")
    q = _t(s, d, "merge_review_queue").select("candidate_id", "reason", at("grade").alias("grade"), at("verdict").alias("verdict"), at("compared_with").alias("compared_with"), F.coalesce(F.json_array_length(at("severe")), F.lit(0)).cast("bigint").alias("n_severe"), F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss").alias("updated_at"))
    c = _t(s, d, "paper_candidate").groupBy("candidate_id").agg(F.min_by(F.struct("raw_title", "raw_authors", "year_guess", "venue_guess"), "id").alias("x")).select("candidate_id", "x.*")
    sources = F.nullif(F.array_join(F.array_sort(F.collect_set(F.when(F.col("matched"), F.col("source_name")))), ","), F.lit(""))  # a candidate's few sources
    r = _t(s, d, "source_record").groupBy("candidate_id").agg(F.count("*").alias("n_sources"), F.count_if("matched").alias("n_matched"), sources.alias("sources"), F.max("match_score").alias("best_score"), F.max("latency_ms").alias("slowest"))
    a = _t(s, d, "fallback_audit").groupBy("candidate_id").agg(F.min("paper_id").alias("paper_id"), F.min("merge_confidence").alias("confidence"))
    st = _t(s, d, "candidate_resolution_status").select("candidate_id", "status", "resolution_rule", "leader_candidate_id")
    return q.join(c, "candidate_id", "left").join(r, "candidate_id", "left").join(a, "candidate_id", "left").join(st, "candidate_id", "left")


# ---- reports and audits
@query("SELECT count(*) FILTER (WHERE wall_time_ms IS NOT NULL) AS n, sum(wall_time_ms)::BIGINT AS total_ms, round(avg(wall_time_ms), 3) AS mean_ms, max(wall_time_ms) AS max_ms, round(avg(wall_time_ms) * 10000 / 3600000, 4) AS hours_for_target FROM mail_ingestion_record")
def mail_timing(s, d):
    """Time per mail, and what 10,000 mails would take."""
    return reports.timing(_t(s, d, "mail_ingestion_record"), 10_000)


@query(f"""WITH {_STORED} SELECT provider, query_type, outcome, count(*) AS n, count(DISTINCT candidate_id) AS n_candidates, count(*) FILTER (WHERE outcome = 'positive_match') AS n_answered, coalesce(sum(latency_ms), 0)::BIGINT AS latency, CAST(grouping(provider, query_type, outcome) AS BIGINT) AS level
FROM (SELECT s.provider, s.query_type, s.cache_status AS outcome, s.candidate_id, r.latency_ms FROM stored s JOIN source_record r ON r.id = s.id) GROUP BY CUBE (provider, query_type, outcome)""")
def dispatch_cube(s, d):
    """Counters of lookups by provider, type and outcome with all totals."""
    r = _t(s, d, "source_record")
    facts = lookups.stored_answers(r).select("id", "provider", "query_type", F.col("cache_status").alias("outcome"), "candidate_id").join(r.select("id", "latency_ms"), "id")
    return reports.dispatch_cube(facts)


@query("""WITH l AS (SELECT candidate_id, max(paper_id) AS p FROM library_prelink_match GROUP BY 1), q AS (SELECT DISTINCT candidate_id FROM merge_review_queue), m AS (SELECT candidate_id, bool_or(matched) AS m FROM source_record GROUP BY 1)
SELECT count(*) AS n_candidates, count(*) FILTER (WHERE m.candidate_id IS NULL) AS need_lookup, count(*) FILTER (WHERE m.m AND q.candidate_id IS NULL AND l.p IS NULL) AS need_dedup, count(*) FILTER (WHERE q.candidate_id IS NOT NULL) AS in_review FROM (SELECT DISTINCT candidate_id FROM paper_candidate WHERE candidate_id IS NOT NULL) c LEFT JOIN m USING (candidate_id) LEFT JOIN q USING (candidate_id) LEFT JOIN l USING (candidate_id)""")
def remaining_work(s, d):
    """How many candidates still need lookups or an assignment, or wait for review."""
    c = _t(s, d, "paper_candidate").where("candidate_id is not null").select("candidate_id").distinct()
    m = _t(s, d, "source_record").groupBy("candidate_id").agg(F.bool_or("matched").alias("m"), F.lit(True).alias("has_m"))
    q = _t(s, d, "merge_review_queue").select("candidate_id", F.lit(True).alias("has_q")).distinct()
    p = _t(s, d, "library_prelink_match").groupBy("candidate_id").agg(F.max("paper_id").alias("p"))
    rows = c.join(m, "candidate_id", "left").join(q, "candidate_id", "left").join(p, "candidate_id", "left")
    return rows.agg(F.count("*").alias("n_candidates"), F.count_if(F.col("has_m").isNull()).alias("need_lookup"), F.count_if(F.col("m") & F.col("has_q").isNull() & F.col("p").isNull()).alias("need_dedup"), F.count_if("has_q").alias("in_review"))


@query("""WITH s AS (SELECT run_id, count(*) AS n, count(*) FILTER (WHERE parse_status = 'parsed') AS parsed, count(*) FILTER (WHERE error_code IS NOT NULL) AS errors, count(*) FILTER (WHERE is_google_scholar_alert = 1) AS alerts, coalesce(sum(num_candidates_extracted), 0)::BIGINT AS candidates, round(coalesce(avg(wall_time_ms), 0), 4) AS mean_ms FROM mail_ingestion_record GROUP BY 1)
SELECT coalesce(run_id, 'none') AS run_id, n, parsed, errors, alerts, candidates, mean_ms, round(candidates / nullif(n, 0), 4) AS per_mail FROM s""")
def run_report(s, d):
    """Counts, errors, yield and time of each run."""
    m = _t(s, d, "mail_ingestion_record").groupBy("run_id").agg(F.count("*").alias("n"), F.count_if(F.col("parse_status") == "parsed").alias("parsed"), F.count_if(F.col("error_code").isNotNull()).alias("errors"), F.count_if(F.col("is_google_scholar_alert") == 1).alias("alerts"), F.coalesce(F.sum("num_candidates_extracted"), F.lit(0)).alias("candidates"), F.round(F.coalesce(F.avg("wall_time_ms"), F.lit(0.0)), 4).alias("mean_ms"))
    return m.withColumn("per_mail", F.round(F.col("candidates") / F.nullif("n", F.lit(0)), 4)).withColumn("run_id", F.coalesce("run_id", F.lit("none")))


@query("""SELECT fallback_mode, relation_type, count(*) AS n, count(*) FILTER (WHERE fallback_mode = 'normalized_only') AS n_normalized_only, count(*) FILTER (WHERE coalesce(merge_confidence, 0) < 0.8) AS low_confidence, round(avg(merge_confidence), 6) AS mean_confidence FROM fallback_audit GROUP BY 1, 2""")
def fallback_modes(s, d):
    """Fallbacks by mode and relation."""
    return _t(s, d, "fallback_audit").groupBy("fallback_mode", "relation_type").agg(F.count("*").alias("n"), F.count_if(F.col("fallback_mode") == "normalized_only").alias("n_normalized_only"), F.count_if(F.coalesce("merge_confidence", F.lit(0.0)) < 0.8).alias("low_confidence"), F.round(F.avg("merge_confidence"), 6).alias("mean_confidence"))


@query()
def fallback_scores(s, d):
    """Suspicion of audited rows from their candidate's keys, best title similarity and unmatched lookups."""
    first = _first(s, d)
    best = acceptance.evidence(acceptance.asked_answers(_t(s, d, "paper_candidate"), _t(s, d, "source_record").withColumn("matched", F.lit(True)))).groupBy("candidate_id").agg(F.max("similarity").alias("similarity"))
    unmatched = _t(s, d, "source_record").groupBy("candidate_id").agg(F.count_if(~F.coalesce("matched", F.lit(False))).alias("unmatched"))
    held = sum((F.col(k).isNotNull().cast("int") for k in ("doi", "pmid", "pmcid")), F.lit(0)).alias("identifiers")
    rows = _t(s, d, "fallback_audit").select("candidate_id", "paper_id").join(first.select("candidate_id", held, "venue", "year"), "candidate_id", "left").join(best, "candidate_id", "left").join(unmatched, "candidate_id", "left")
    return reports.suspicion(rows)


@query("""WITH x AS (SELECT mail_uid, coalesce(sha1(concat_ws('|', coalesce(mail_uid, ''), coalesce(message_id, ''), coalesce(subject, ''), coalesce(internal_date, ''), coalesce(from_address, ''), coalesce(mailbox, '')))) AS h, id FROM mail_ingestion_record) SELECT id, 'local163_' || h AS acquired_id FROM x""")
def acquired_ids(s, d):
    """Ids of acquired mails from six fields, empty ones kept."""
    cols = ["mail_uid", "message_id", "subject", "internal_date", "from_address", "mailbox"]
    return _t(s, d, "mail_ingestion_record").select("id", ids.acquired_id(*[F.col(c) for c in cols]).alias("acquired_id"))


@query(r"""SELECT id, nullif(regexp_extract(message_id, '^<?\s*([^@<>\s]+)@', 1), '') AS local_part, nullif(regexp_extract(message_id, '([0-9]+)(?:[^0-9]*)$', 1), '') AS token FROM mail_ingestion_record""")
def message_tokens(s, d):
    """Parts of message ids that name a message within its page."""
    return _t(s, d, "mail_ingestion_record").select("id", ids.message_part(F.col("message_id")).alias("local_part"), ids.last_number(F.col("message_id")).alias("token"))


@query(r"""WITH m AS (SELECT id, lower(regexp_replace(coalesce(subject, ''), '\s+', '', 'g')) AS su, trim(coalesce(internal_date, '')) AS da FROM mail_ingestion_record), k AS (SELECT su, min(id) AS first_id FROM m WHERE su <> '' GROUP BY 1)
SELECT m.id, k.first_id, m.da = '' OR f.da = '' OR contains(m.da, f.da) OR contains(f.da, m.da) AS same_row FROM m JOIN k ON k.su = m.su JOIN m f ON f.id = k.first_id WHERE m.id <> k.first_id""")
def mailbox_rows(s, d):
    """Mails against the first of their subject: whether the dates agree, blanks agreeing with all (X11)."""
    m = _t(s, d, "mail_ingestion_record").select("id", ids.subject_key(F.col("subject")).alias("su"), F.trim(F.coalesce("internal_date", F.lit(""))).alias("da"))
    first = m.where("su <> ''").groupBy("su").agg(F.min_by(F.struct("id", "da"), "id").alias("f"))
    return m.join(first, "su").where("id <> f.id").select("id", F.col("f.id").alias("first_id"), ids.dates_agree(F.col("da"), F.col("f.da")).alias("same_row"))


@query("SELECT id, candidate_id FROM (SELECT id, candidate_id, row_number() OVER (ORDER BY id) AS k FROM candidate_batch b WHERE NOT EXISTS (SELECT 1 FROM paper_candidate c WHERE c.candidate_id = b.candidate_id)) WHERE k > 10 AND k <= 60")
def resumed_batch(s, d):
    """The next rows of a queue after an offset that were not taken before (S23, S16, L1); offset and limit are the feature."""
    due = relational.unprocessed(_t(s, d, "candidate_batch").select("id", "candidate_id"), _t(s, d, "paper_candidate"), on="candidate_id")
    return due.orderBy("id").offset(10).limit(50)


@query("""SELECT source_name AS provider, query_type, query_string, 'https://api.example/' || coalesce(source_name, 'none') || '?' || concat_ws('&', CASE WHEN coalesce(trim(query_string), '') <> '' THEN 'q=' || replace(url_encode(trim(query_string)), '%20', '+') END, CASE WHEN query_type <> '' THEN 'type=' || query_type END) AS url FROM source_record""")
def request_urls(s, d):
    """The URL that a lookup asks; blank parameters are left out."""
    base = F.concat(F.lit("https://api.example/"), F.coalesce("source_name", F.lit("none")))
    return _t(s, d, "source_record").select(F.col("source_name").alias("provider"), "query_type", "query_string", ids.request_url(base, q=F.col("query_string"), type=F.col("query_type")).alias("url"))
