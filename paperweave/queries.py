"""Queries of the core and their SQL (for DuckDB, over views named as the tables)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .functions import identifiers as ids
from .functions import similarity as sim
from .functions import text as tx
from .operators import delivery, grading, relational, reports, resolve, survivorship
from .plans import normalize
from .tables import table as _t

QUERIES: dict = {}
SQL: dict[str, str] = {}
FLAGSHIP = "normalized_keys"

# ---- SQL fragments that mirror the column expressions
_URI = r"^(?:([^:/?#]+):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#.*)?$"
_HOST = f"nullif(lower(regexp_extract(@, '{_URI}', 2)), '')"


def _tidy(x: str) -> str:
    out = f"regexp_replace(lower(trim({x})), '^https://doi\\.org/', '')"
    for p in ids.DOI_ENDINGS:
        out = f"regexp_replace({out}, '{p}', '')"
    return f"nullif({out}, '')"


_DOI = ids.DOI
_FIND_DOI = _tidy(f"nullif(regexp_extract(@, '{_DOI}', 0), '')")
_UNWRAP = r"CASE WHEN regexp_matches(@, '(?i)^[^:/?#]+://scholar\.[^/?#]*/scholar_url\?') AND regexp_extract(@, '[?&]url=([^&#]*)', 1) <> '' THEN url_decode(url_decode(regexp_extract(@, '[?&]url=([^&#]*)', 1))) END"
_CANON = f"CASE WHEN coalesce(@, '') <> '' THEN coalesce({_UNWRAP}, coalesce(nullif(lower(regexp_extract(@, '{_URI}', 1)), ''), 'https') || '://' || lower(regexp_extract(@, '{_URI}', 2)) || regexp_extract(@, '{_URI}', 3) || CASE WHEN regexp_extract(@, '{_URI}', 4) <> '' THEN '?' || regexp_extract(@, '{_URI}', 4) ELSE '' END) END"
_NAMES = "list_filter(list_transform(string_split(coalesce({}, ''), ','), lambda x: trim(x)), lambda x: x <> '')"
_SQUEEZE = r"trim(regexp_replace({}, '[\s\x{{00A0}}\x{{2000}}-\x{{200A}}\x{{202F}}\x{{3000}}\x{{0085}}\x{{2028}}\x{{2029}}\x{{1680}}\x{{205F}}]+', ' ', 'g'))"


def _at(fragment: str, column: str) -> str:
    """A fragment over a column."""
    return fragment.replace("@", column)


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


_MKEY = r"nullif(regexp_replace(message_id, '^[\s<>]+|[\s<>]+$', '', 'g'), '')"


# ---- messages (problem 4)
@query(rf"""
WITH RECURSIVE r AS (SELECT id, nullif(mail_uid, '') AS u, {_MKEY} AS m FROM mail_ingestion_record),
 e AS (SELECT a.id AS x, b.id AS y FROM r a JOIN r b ON a.u = b.u UNION SELECT a.id, b.id FROM r a JOIN r b ON a.m = b.m),
 t AS (SELECT id AS x, id AS y FROM r UNION SELECT t.x, e.y FROM t JOIN e ON t.y = e.x)
SELECT x AS id FROM t GROUP BY x HAVING min(y) < x""")
def p4_found(s, d):
    return delivery.repeats(_t(s, d, "mail_ingestion_record"))



@query(rf"""
WITH k AS (SELECT DISTINCT regexp_extract(m, '^([A-Za-z][A-Za-z_-]*)-', 1) || '@' || regexp_extract(m, '@(\S+)$', 1) AS producer, CAST(regexp_extract(m, '-(\d+)@', 1) AS BIGINT) AS number
  FROM (SELECT {_MKEY} AS m FROM mail_ingestion_record) WHERE regexp_matches(m, '^([A-Za-z][A-Za-z_-]*)-(0|[1-9][0-9]{{0,17}})@(\S+)$')),
 i AS (SELECT *, number - row_number() OVER (PARTITION BY producer, number // 65536 ORDER BY number) AS island FROM k)
SELECT producer, min(number) AS lo, max(number) AS hi FROM i GROUP BY producer, number // 65536, island""")
def p4_ranges(s, d):
    return delivery.seen_ranges(delivery.identifiers(_t(s, d, "mail_ingestion_record")))


# ---- projections and scalar functions
@query(rf"""SELECT id, candidate_id, len({_NAMES.format('raw_authors')}) AS n_authors,
 string_split_regex(list_extract({_NAMES.format('raw_authors')}, 1), '\s+')[-1] AS first_author_family, nullif(trim(year_guess), '') AS year_guess,
 {_at(_FIND_DOI, "c")} AS doi, nullif(regexp_extract(c, '(?i)(?:pubmed\.ncbi\.nlm\.nih\.gov/|pmid[/:\s])(\d{{5,10}})', 1), '') AS pmid,
 nullif(upper(regexp_extract(c, '(?i)(?:pmc(?:\.ncbi\.nlm\.nih\.gov)?/articles/|pmcid[/:\s])(PMC\d+)', 1)), '') AS pmcid,
 nullif(regexp_extract(c, '(?i)arxiv\.org/(?:abs|pdf)/([0-9]{{4}}\.[0-9]{{4,5}})(?:v\d+)?', 1), '') AS arxiv, {_at(_CANON, 'u')} AS url, {_at(_HOST, 'u')} AS host
FROM (SELECT *, concat_ws(chr(10), raw_title, raw_link, raw_snippet, target_url) AS c, coalesce(target_url, raw_link) AS u FROM paper_candidate)""")
def normalized_keys(s, d):
    return normalize.normalized_keys(_t(s, d, "paper_candidate"))


@query()
def normalized_candidates(s, d):
    return normalize.normalized(_t(s, d, "paper_candidate"))


@query(f"SELECT id, {_SQUEEZE.format('raw_title')} AS title, {_NAMES.format('raw_authors')}[1] AS first_name, array_to_string({_NAMES.format('raw_authors')}, '|') AS names FROM paper_candidate")
def squeezed_titles(s, d):
    names = tx.name_list(F.col("raw_authors"))
    return _t(s, d, "paper_candidate").select("id", tx.squeeze(F.col("raw_title")).alias("title"), F.try_element_at(names, F.lit(1)).alias("first_name"), F.array_join(names, "|").alias("names"))


@query(rf"""WITH t AS (SELECT id, {_SQUEEZE.format('raw_source_text')} AS x FROM paper_candidate),
 p AS (SELECT id, instr(x, ' - ') AS a, trim(substr(x, 1, instr(x, ' - ') - 1)) AS l, trim(substr(x, instr(x, ' - ') + 3)) AS r FROM t),
 q AS (SELECT *, regexp_matches(r, '^\d{{4}}$') AS oy, trim(string_split(r, ',')[-1]) AS tail FROM p)
SELECT id, CASE WHEN a > 0 THEN nullif(l, '') END AS authors,
 CASE WHEN a > 0 AND NOT oy THEN nullif(CASE WHEN contains(r, ',') AND regexp_matches(tail, '^\d{{4}}$') THEN trim(regexp_replace(r, ',[^,]*$', '')) ELSE r END, '') END AS venue,
 CASE WHEN a > 0 AND oy THEN r WHEN a > 0 AND contains(r, ',') AND regexp_matches(tail, '^\d{{4}}$') THEN tail END AS year FROM q""")
def snippet_parts(s, d):
    return _t(s, d, "paper_candidate").select("id", tx.snippet_parts(F.col("raw_source_text")).alias("x")).select("id", "x.*")


@query("""SELECT id, CASE WHEN coalesce(trim(raw_title), '') = '' THEN NULL WHEN starts_with(lower(trim(raw_title)), '[html]') THEN 'html' WHEN starts_with(lower(trim(raw_title)), '[pdf]') THEN 'pdf'
 WHEN lower(target_url) LIKE '%.pdf' OR lower(target_url) LIKE '%/pdf/%' THEN 'pdf' WHEN lower(target_url) LIKE '%/article/%' OR lower(target_url) LIKE '%/abs/%' OR lower(target_url) LIKE '%/abstract%' OR lower(target_url) LIKE '%/full/%' THEN 'html' END AS resource_type,
 coalesce(length(raw_title) BETWEEN 20 AND 500 AND NOT regexp_matches(lower(raw_title), 'view all|my profile|google scholar|alert|unsubscribe'), false) AS plausible,
 coalesce(contains(x, '. .') OR contains(x, '…') OR x LIKE '%...', false) AS cut FROM (SELECT *, """ + _SQUEEZE.format("raw_title") + """ AS x FROM paper_candidate)""")
def title_flags(s, d):
    return _t(s, d, "paper_candidate").select("id", tx.resource_type(F.col("raw_title"), F.col("target_url")).alias("resource_type"), tx.plausible_title(F.col("raw_title")).alias("plausible"), tx.cut_title(F.col("raw_title")).alias("cut"))


@query("""SELECT id, CASE WHEN lower(from_address) LIKE '%scholaralerts-noreply@google.com%' THEN 'from_address_match'
 WHEN regexp_matches(lower(subject), 'google scholar|google 学术|new articles|new citations|new results|related articles') THEN 'subject_hint_match' ELSE 'no_match' END AS reason FROM mail_ingestion_record""")
def alert_reasons(s, d):
    return _t(s, d, "mail_ingestion_record").select("id", tx.alert_reason(F.col("from_address"), F.col("subject")).alias("reason"))


@query(f"SELECT id, {_at(_FIND_DOI, 'doi')} AS doi, {_tidy('external_id')} AS external FROM source_record")
def source_dois(s, d):
    return _t(s, d, "source_record").select("id", ids.find_doi(F.col("doi")).alias("doi"), ids.tidy_doi(F.col("external_id")).alias("external"))


@query(f"SELECT host, count(*) AS n FROM (SELECT {_at(_HOST, 'target_url')} AS host FROM paper_candidate) WHERE host IS NOT NULL GROUP BY host ORDER BY n DESC, host LIMIT 10")
def top_hosts(s, d):
    rows = _t(s, d, "paper_candidate").select(ids.host(F.col("target_url")).alias("host")).where("host is not null")
    return rows.groupBy("host").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "host").limit(10)


@query("SELECT mail_uid, id, 'cand_' || substr(sha1(concat_ws('|', coalesce(mail_uid, ''), CAST(candidate_index_in_mail AS VARCHAR), coalesce(raw_title, ''))), 1, 16) AS derived_id FROM paper_candidate")
def derived_ids(s, d):
    return _t(s, d, "paper_candidate").select("mail_uid", "id", ids.candidate_id(F.col("mail_uid"), F.col("candidate_index_in_mail"), F.col("raw_title")).alias("derived_id"))


# ---- filters and joins
@query("SELECT c.id, c.candidate_id FROM paper_candidate c WHERE NOT EXISTS (SELECT 1 FROM candidate_resolution_status r WHERE r.candidate_id = c.candidate_id) AND NOT EXISTS (SELECT 1 FROM merge_review_queue q WHERE q.candidate_id = c.candidate_id)")
def unresolved_candidates(s, d):
    return relational.unprocessed(_t(s, d, "paper_candidate").select("id", "candidate_id"), _t(s, d, "candidate_resolution_status"), _t(s, d, "merge_review_queue"), on="candidate_id")


@query("SELECT c.id, c.candidate_id FROM paper_candidate c WHERE c.candidate_id IN (SELECT candidate_id FROM merge_review_queue)")
def queued_candidates(s, d):
    return _t(s, d, "paper_candidate").select("id", "candidate_id").join(_t(s, d, "merge_review_queue").select("candidate_id"), "candidate_id", "left_semi")


@query("""SELECT q.candidate_id, q.reason, json_extract_string(q.assessment_json, '$.grade') AS grade, r.status, r.resolution_rule, s.n_sources, s.n_matched, a.paper_id FROM merge_review_queue q
 LEFT JOIN candidate_resolution_status r ON r.candidate_id = q.candidate_id LEFT JOIN (SELECT candidate_id, count(*) AS n_sources, count(*) FILTER (WHERE matched) AS n_matched FROM source_record GROUP BY 1) s ON s.candidate_id = q.candidate_id
 LEFT JOIN (SELECT candidate_id, min(paper_id) AS paper_id FROM fallback_audit GROUP BY 1) a ON a.candidate_id = q.candidate_id""")
def review_export(s, d):
    q = _t(s, d, "merge_review_queue").select("candidate_id", "reason", F.get_json_object("assessment_json", "$.grade").alias("grade"))
    r = _t(s, d, "candidate_resolution_status").select("candidate_id", "status", "resolution_rule")
    n = _t(s, d, "source_record").groupBy("candidate_id").agg(F.count("*").alias("n_sources"), F.count_if("matched").alias("n_matched"))
    a = _t(s, d, "fallback_audit").groupBy("candidate_id").agg(F.min("paper_id").alias("paper_id"))
    return q.join(r, "candidate_id", "left").join(n, "candidate_id", "left").join(a, "candidate_id", "left")


@query("SELECT candidate_id, source_name, arg_max(id, id) AS id, arg_max(title, id) FILTER (WHERE true) AS title, max(id) AS last_id FROM (SELECT candidate_id, source_name, id, coalesce(title, '') AS title FROM source_record) GROUP BY 1, 2")
def latest_records(s, d):
    rows = _t(s, d, "source_record").select("candidate_id", "source_name", "id", F.coalesce("title", F.lit("")).alias("title"), F.col("id").alias("last_id"))
    return relational.latest(rows, ["candidate_id", "source_name"], "id")


@query("""SELECT candidate_id, id, richness FROM (SELECT candidate_id, id, richness, row_number() OVER (PARTITION BY candidate_id ORDER BY richness DESC, id) AS k
 FROM (SELECT candidate_id, id, coalesce(length(title), 0) + coalesce(length(abstract), 0) + coalesce(length(venue), 0) AS richness FROM source_record)) WHERE k = 1""")
def richest_records(s, d):
    rows = _t(s, d, "source_record").select("candidate_id", "id", "title", "abstract", "venue")
    return relational.richest(rows, ["candidate_id"], ["title", "abstract", "venue"], "id").select("candidate_id", "id", "richness")


@query("""WITH k AS (SELECT id, doi, pmid, pmcid FROM source_record), t AS (SELECT 'doi' AS rule, doi AS key, min(candidate_id) AS target FROM source_record WHERE matched AND doi IS NOT NULL GROUP BY doi UNION ALL SELECT 'pmid', pmid, min(candidate_id) FROM source_record WHERE matched AND pmid IS NOT NULL GROUP BY pmid UNION ALL SELECT 'pmcid', pmcid, min(candidate_id) FROM source_record WHERE matched AND pmcid IS NOT NULL GROUP BY pmcid),
 h AS (SELECT k.id, 0 AS p, t.rule, t.target FROM k JOIN t ON t.rule = 'doi' AND t.key = k.doi WHERE k.doi <> '' UNION ALL SELECT k.id, 1, t.rule, t.target FROM k JOIN t ON t.rule = 'pmid' AND t.key = k.pmid WHERE k.pmid <> '' UNION ALL SELECT k.id, 2, t.rule, t.target FROM k JOIN t ON t.rule = 'pmcid' AND t.key = k.pmcid WHERE k.pmcid <> '')
SELECT id, target, rule FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY p) AS n FROM h) WHERE n = 1""")
def first_rule_hits(s, d):
    rows = _t(s, d, "source_record")
    kinds = ["doi", "pmid", "pmcid"]
    held = rows.where("matched").select("candidate_id", *kinds).unpivot(["candidate_id"], kinds, "rule", "key").where("key is not null")
    return relational.first_rule(rows.select("id", *kinds), held.select("rule", "key", F.col("candidate_id").alias("target")), "id", kinds)


@query("SELECT * FROM (SELECT id, 'doi' AS key_type, doi AS key FROM source_record UNION ALL SELECT id, 'pmid', pmid FROM source_record UNION ALL SELECT id, 'pmcid', pmcid FROM source_record UNION ALL SELECT id, 'url', url FROM source_record) WHERE trim(key) <> ''")
def identity_keys(s, d):
    return relational.unpivot_keys(_t(s, d, "source_record"), "id", ["doi", "pmid", "pmcid", "url"])


@query("""WITH a AS (SELECT candidate_id, max(year) AS year, count(*) AS n FROM source_record WHERE matched AND source_name IN ('crossref', 'openalex') GROUP BY 1), b AS (SELECT candidate_id, max(year) AS year, count(*) AS n FROM source_record WHERE matched AND source_name NOT IN ('crossref', 'openalex') GROUP BY 1)
SELECT coalesce(a.candidate_id, b.candidate_id) AS candidate_id, a.year AS year_a, a.n AS n_a, b.year AS year_b, b.n AS n_b, CASE WHEN b.candidate_id IS NULL THEN 'only_a' WHEN a.candidate_id IS NULL THEN 'only_b' ELSE 'changed' END AS side
FROM a FULL JOIN b ON a.candidate_id = b.candidate_id WHERE a.candidate_id IS NULL OR b.candidate_id IS NULL OR a.year IS DISTINCT FROM b.year OR a.n IS DISTINCT FROM b.n""")
def run_differences(s, d):
    rows = _t(s, d, "source_record").where("matched and source_name is not null")
    own = lambda x: rows.where(x).groupBy("candidate_id").agg(F.max("year").alias("year"), F.count("*").alias("n"))
    return relational.differences(own("source_name in ('crossref', 'openalex')"), own("source_name not in ('crossref', 'openalex')"), "candidate_id", ["year", "n"])


@query()
def best_source_title(s, d):
    """Each candidate's own matched record with the most similar title."""
    c = _t(s, d, "paper_candidate").where("trim(raw_title) <> ''").groupBy("candidate_id").agg(F.min_by("raw_title", "id").alias("raw_title"))
    r = _t(s, d, "source_record").where("matched and title is not null").select("candidate_id", "id", "title")
    both = c.join(r, "candidate_id").withColumn("ratio", F.round(sim.ratio_udf("raw_title", "title"), 6))
    return both.groupBy("candidate_id").agg(F.max(F.struct("ratio", -F.col("id"))).alias("x")).select("candidate_id", (-F.col("x.col2")).alias("id"), "x.ratio")


_TOK = "list_distinct(list_filter(string_split_regex(lower(coalesce({}, '')), '[^a-z0-9]+'), lambda x: x <> ''))"


@query(f"""WITH c AS (SELECT candidate_id, arg_min(raw_title, id) AS t FROM paper_candidate WHERE trim(raw_title) <> '' GROUP BY 1), p AS (SELECT r.id, {_TOK.format('c.t')} AS a, {_TOK.format('r.title')} AS b FROM c JOIN source_record r ON r.candidate_id = c.candidate_id WHERE r.matched)
SELECT id, round(CASE WHEN len(list_distinct(list_concat(a, b))) > 0 THEN len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))) ELSE 0.0 END, 6) AS jaccard FROM p""")
def title_jaccard(s, d):
    c = _t(s, d, "paper_candidate").where("trim(raw_title) <> ''").groupBy("candidate_id").agg(F.min_by("raw_title", "id").alias("t"))
    r = _t(s, d, "source_record").where("matched").select("candidate_id", "id", "title")
    return c.join(r, "candidate_id").select("id", F.round(ids.token_jaccard(F.col("t"), F.col("title")), 6).alias("jaccard"))


# ---- aggregations, windows, sets
@query("SELECT source_name, query_type, count(*) AS n_intents, count(DISTINCT query_string) AS n_unique, count(*) - count(DISTINCT query_string) AS n_duplicate, CAST(CASE WHEN source_name = 'openalex' AND query_type = 'doi' THEN ceil(count(DISTINCT query_string) / 50) ELSE count(DISTINCT query_string) END AS BIGINT) AS n_requests FROM source_record GROUP BY 1, 2")
def duplicate_queries(s, d):
    return reports.duplicate_queries(_t(s, d, "source_record"))


@query("SELECT source_name, query_type, query_string, count(DISTINCT candidate_id) AS n_candidates, min(candidate_id) AS first_candidate FROM source_record WHERE query_string IS NOT NULL GROUP BY 1, 2, 3 HAVING count(DISTINCT candidate_id) > 1 ORDER BY n_candidates DESC, source_name, query_type, query_string LIMIT 10")
def top_duplicate_groups(s, d):
    return reports.top_duplicate_groups(_t(s, d, "source_record"))


@query("SELECT key, CAST((row_number() OVER (ORDER BY key) - 1) // 50 AS BIGINT) AS batch_no FROM (SELECT DISTINCT query_string AS key FROM source_record WHERE query_string IS NOT NULL)")
def lookup_batches(s, d):
    return reports.batch_numbers(_t(s, d, "source_record"), "query_string")


@query("SELECT coalesce(source_name, 'none') AS source_name, count(*) AS n, round(avg(CAST(matched AS DOUBLE)), 6) AS match_rate, round(avg(latency_ms), 4) AS mean_latency, median(latency_ms) AS median_latency, coalesce(sum(latency_ms), 0)::BIGINT AS total_latency FROM source_record GROUP BY 1")
def latency_report(s, d):
    return reports.latency_report(_t(s, d, "source_record"))


@query("SELECT source_name, query_type, count(*) AS n, count(*) FILTER (WHERE matched) AS n_matched, CAST(grouping(source_name, query_type) AS BIGINT) AS level FROM source_record GROUP BY GROUPING SETS ((source_name, query_type), (source_name), ())")
def metric_cube(s, d):
    return reports.metric_cube(_t(s, d, "source_record"))


@query("SELECT json_extract_string(assessment_json, '$.grade') AS grade, coalesce(reason, 'none') AS reason, count(*) AS n FROM merge_review_queue GROUP BY 1, 2")
def review_grades(s, d):
    return _t(s, d, "merge_review_queue").groupBy(F.get_json_object("assessment_json", "$.grade").alias("grade"), F.coalesce("reason", F.lit("none")).alias("reason")).agg(F.count("*").alias("n"))


@query("SELECT stage, count(*) AS n, count(*) FILTER (WHERE status = 'clustered') AS n_clustered, count(leader_candidate_id) AS n_leaders FROM (SELECT *, resolution_stage AS stage FROM candidate_resolution_status) GROUP BY stage")
def stage_counts(s, d):
    return _t(s, d, "candidate_resolution_status").groupBy(F.col("resolution_stage").alias("stage")).agg(F.count("*").alias("n"), F.count_if(F.col("status") == "clustered").alias("n_clustered"), F.count("leader_candidate_id").alias("n_leaders"))


@query("SELECT (SELECT count(*) FROM paper_candidate) AS n_candidates, (SELECT count(DISTINCT candidate_id) FROM paper_candidate) AS n_distinct, (SELECT count(DISTINCT paper_id) FROM library_prelink_match) AS n_papers, round((SELECT count(DISTINCT paper_id) FROM library_prelink_match) / (SELECT count(DISTINCT candidate_id) FROM paper_candidate), 3) AS ratio")
def run_summary(s, d):
    c = _t(s, d, "paper_candidate").agg(F.count("*").alias("n_candidates"), F.countDistinct("candidate_id").alias("n_distinct"))
    p = _t(s, d, "library_prelink_match").agg(F.countDistinct("paper_id").alias("n_papers"))
    return c.crossJoin(p).withColumn("ratio", F.round(F.col("n_papers") / F.nullif("n_distinct", F.lit(0)), 3))  # one row each


@query("""WITH k AS (SELECT candidate_id, count(DISTINCT doi) + count(DISTINCT pmid) + count(DISTINCT pmcid) AS identifiers, count(*) FILTER (WHERE NOT matched) AS unmatched, max(venue) AS venue FROM source_record GROUP BY 1)
SELECT a.candidate_id, a.paper_id, CASE WHEN coalesce(identifiers, 0) = 0 THEN 2 ELSE 0 END + CASE WHEN coalesce(merge_confidence, 0) < 0.45 THEN 2 WHEN coalesce(merge_confidence, 0) < 0.7 THEN 1 ELSE 0 END + CASE WHEN coalesce(unmatched, 0) <= 2 THEN 1 ELSE 0 END
 + CASE WHEN coalesce(trim(venue), '') = '' THEN 1 ELSE 0 END + CASE WHEN coalesce(trim(year_guess), '') = '' THEN 1 ELSE 0 END AS score, n AS paper_rows, n = 1 AS "unique"
FROM fallback_audit a LEFT JOIN k ON k.candidate_id = a.candidate_id LEFT JOIN (SELECT paper_id, count(*) AS n FROM fallback_audit GROUP BY 1) p ON p.paper_id = a.paper_id""")
def audit_scores(s, d):
    """Suspicion of audited rows; the stored confidence stands for the similarity, which the table has not."""
    r = _t(s, d, "source_record").groupBy("candidate_id").agg((F.countDistinct("doi") + F.countDistinct("pmid") + F.countDistinct("pmcid")).alias("identifiers"), F.count_if(~F.col("matched")).alias("unmatched"), F.max("venue").alias("venue"))
    a = _t(s, d, "fallback_audit").select("candidate_id", "paper_id", F.col("merge_confidence").alias("similarity"), F.col("year_guess").alias("year"))
    return reports.suspicion(a.join(r, "candidate_id", "left"))


@query("SELECT id, mail_uid, concat_ws(' ### ', " + ", ".join(f"'{i:+d}:' || lag(candidate_id, {-i}) OVER w" for i in range(-3, 4) if i) + ") AS neighbours, row_number() OVER w AS place FROM paper_candidate WINDOW w AS (PARTITION BY mail_uid ORDER BY id)")
def neighbour_keys(s, d):
    rows = _t(s, d, "paper_candidate").select("id", "mail_uid", "candidate_id")
    return relational.neighbour_keys(rows, "mail_uid", "id", "candidate_id").drop("candidate_id")


@query("SELECT candidate_id FROM (SELECT candidate_id FROM library_prelink_match WHERE paper_id IS NOT NULL EXCEPT SELECT candidate_id FROM merge_review_queue) UNION SELECT leader_candidate_id FROM candidate_resolution_status WHERE leader_candidate_id IS NOT NULL")
def linked_or_leading(s, d):
    linked = _t(s, d, "library_prelink_match").where("paper_id is not null").select("candidate_id")
    leaders = _t(s, d, "candidate_resolution_status").where("leader_candidate_id is not null").select(F.col("leader_candidate_id").alias("candidate_id"))
    return linked.subtract(_t(s, d, "merge_review_queue").select("candidate_id")).union(leaders).distinct()


# ---- survivorship and assignment
def _picked(field: str, boost: str) -> str:
    return f"SELECT candidate_id, '{field}' AS field_name, id, source_name, coalesce(query_type, '') AS q, {field} AS value, CASE source_name WHEN 'crossref' THEN 4 WHEN 'openalex' THEN 3 WHEN 'semanticscholar' THEN 2 WHEN 'pubmed' THEN 1 ELSE 0 END + {boost} AS score FROM source_record WHERE matched AND {field} <> ''"


_BOOST = "CASE WHEN query_type IN ('doi', 'doi_batch', 'pmid') THEN 3 WHEN query_type = 'title' THEN -1 ELSE 0 END"
_PICK = " UNION ALL ".join(_picked(f, _BOOST if f in survivorship.ID_FIELDS else "0") + ("" if f in survivorship.PUBMED_FIELDS else " AND (source_name <> 'pubmed' OR source_name IS NULL)") for f in survivorship.MERGED_FIELDS)


@query(f"SELECT candidate_id, field_name, value, source_name, n_values FROM (SELECT *, row_number() OVER (PARTITION BY candidate_id, field_name ORDER BY score DESC, coalesce(source_name, ''), q, id) AS k, count(*) OVER (PARTITION BY candidate_id, field_name) AS n_values FROM ({_PICK})) WHERE k = 1")
def picked_fields(s, d):
    return survivorship.picked_fields(_t(s, d, "source_record"))


_CV = {"year": "t", "doi": r"regexp_replace(regexp_replace(lower(t), '^https://doi\.org/', ''), '[ ./]+$', '')", "pmid": "t"}
_LONG = " UNION ALL ".join(f"SELECT candidate_id, '{f}' AS field_name, nullif({x}, '') AS v FROM (SELECT candidate_id, trim(regexp_replace({f}, '\\s+', ' ', 'g')) AS t FROM source_record WHERE matched)" for f, x in _CV.items())
_CONFLICTS = f"""SELECT candidate_id, field_name, count(DISTINCT v) AS n_values, CASE WHEN field_name IN ('doi', 'pmid') THEN 'C' WHEN count(try_cast(v AS INT)) > 1 AND max(try_cast(v AS INT)) - min(try_cast(v AS INT)) <= 1 THEN 'B' ELSE 'C' END AS grade
 FROM (SELECT DISTINCT * FROM ({_LONG})) WHERE v IS NOT NULL GROUP BY 1, 2 HAVING count(DISTINCT v) > 1"""


@query(_CONFLICTS)
def field_conflicts(s, d):
    """Conflicts of identifiers and years."""
    return grading.graded_conflicts(_t(s, d, "source_record"), ("year", "doi", "pmid"))


@query()
def graded_conflicts(s, d):
    """Conflicts of all five fields; titles and venues are graded by sequence similarity, which SQL has not."""
    return grading.graded_conflicts(_t(s, d, "source_record"))


@query()
def merge_assessment(s, d):
    return grading.assessment(_t(s, d, "source_record"))


@query()
def proposal_quality(s, d):
    return grading.proposal_quality(grading.assessment(_t(s, d, "source_record")))


def _keyed(s, d):
    """Candidates with the identifiers of their matched records and their URL, one row per candidate."""
    c = normalize.normalized_keys(_t(s, d, "paper_candidate")).groupBy("candidate_id").agg(F.min("id").alias("id"), F.min("url").alias("url"))
    doi = ids.find_doi(F.col("doi"))
    r = _t(s, d, "source_record").where("matched").groupBy("candidate_id").agg(F.min(doi).alias("doi"), F.min(F.nullif("pmid", F.lit(""))).alias("pmid"), F.min(F.nullif("pmcid", F.lit(""))).alias("pmcid"))
    return c.join(r, "candidate_id", "left")


@query()
def exact_clusters(s, d):
    return resolve.clusters(_keyed(s, d), ["doi", "pmid", "pmcid", "url"])


@query()
def canonical_assignment(s, d):
    """All rules of the assignment, with the titles and names of candidates; papers linked before are founders."""
    c = _t(s, d, "paper_candidate")
    form = F.regexp_replace(F.lower(F.regexp_replace("raw_title", r"[^\\p{L}\\p{N}]+", " ")), r"^ | $", "")
    first = c.where("trim(raw_title) <> ''").groupBy("candidate_id").agg(F.min_by(F.struct(form.alias("t"), tx.first_family(F.col("raw_authors")).alias("f"), F.col("year_guess").alias("y")), "id").alias("x"))
    title = F.when((F.length("x.t") > 0) & F.col("x.f").isNotNull(), F.concat_ws("|", "x.t", F.lower("x.f")))
    rows = _keyed(s, d).join(first.select("candidate_id", title.alias("title_family"), F.col("x.y").alias("year")), "candidate_id", "left")
    linked = _t(s, d, "library_prelink_match").where("paper_id is not null").groupBy("paper_id").agg(F.min("candidate_id").alias("candidate_id"))
    known = linked.join(rows.drop("id", "url"), "candidate_id").drop("candidate_id")
    return resolve.assign(rows, ["doi", "pmid", "pmcid"], title="title_family", year="year", canonicals=known)


# ---- further filters, orders and audits
@query("SELECT id, doi FROM source_record WHERE doi ILIKE '%.pdf%' OR doi ILIKE '%/download%' OR doi ILIKE '%_reference.pdf%'")
def untidy_dois(s, d):
    """Values of doi with file endings."""
    return _t(s, d, "source_record").where("doi ilike '%.pdf%' or doi ilike '%/download%' or doi ilike '%_reference.pdf%'").select("id", "doi")


@query(r"SELECT id, CASE WHEN regexp_matches(year_guess, '^[0-9]') THEN try_cast(regexp_extract(year_guess, '^[0-9]+', 0) AS BIGINT) END AS number FROM paper_candidate")
def leading_numbers(s, d):
    """The leading digits of a text as a number, null without, or where they are no 64-bit number."""
    return _t(s, d, "paper_candidate").select("id", F.when(F.col("year_guess").rlike("^[0-9]"), F.regexp_extract("year_guess", "^[0-9]+", 0).try_cast("bigint")).alias("number"))


@query("SELECT * FROM ((SELECT id, 'first' AS part FROM mail_ingestion_record ORDER BY id LIMIT 25) UNION ALL (SELECT id, 'last' FROM mail_ingestion_record ORDER BY id DESC LIMIT 25))")
def batch_cuts(s, d):
    """The first and the last n rows of a queue (L1, L2); the limits are the feature."""
    mails = _t(s, d, "mail_ingestion_record").select("id")
    cut = lambda o, name: mails.orderBy(o).limit(25).select("id", F.lit(name).alias("part"))
    return cut("id", "first").unionByName(cut(F.desc("id"), "last"))


@query(f"""WITH x AS (SELECT source_name, {_at(_FIND_DOI, 'doi')} AS doi, latency_ms, url FROM source_record WHERE matched)
SELECT source_name, count(DISTINCT doi) AS n_dois, count(*) AS n_rows, count(url) AS n_urls, coalesce(sum(latency_ms), 0)::BIGINT AS latency FROM x GROUP BY 1""")
def doi_placements(s, d):
    """Distinct DOIs, filled URLs and time spent per source."""
    rows = _t(s, d, "source_record").where("matched").withColumn("d", ids.find_doi(F.col("doi")))
    return rows.groupBy("source_name").agg(F.countDistinct("d").alias("n_dois"), F.count("*").alias("n_rows"), F.count("url").alias("n_urls"), F.coalesce(F.sum("latency_ms"), F.lit(0)).alias("latency"))


@query("""WITH m AS (SELECT run_id, count(*) AS n, coalesce(sum(num_candidates_extracted), 0)::BIGINT AS found, coalesce(sum(wall_time_ms), 0)::BIGINT AS ms FROM mail_ingestion_record GROUP BY 1)
SELECT run_id, n, found, ms, n - lag(n) OVER w AS d_n, found - lag(found) OVER w AS d_found FROM m WINDOW w AS (ORDER BY run_id)""")
def run_deltas(s, d):
    """Counts per run and their change from the run before (A2, A22); one row per run."""
    from pyspark.sql.window import Window

    zero = lambda c: F.coalesce(F.sum(c), F.lit(0))
    per = _t(s, d, "mail_ingestion_record").groupBy("run_id").agg(F.count("*").alias("n"), zero("num_candidates_extracted").alias("found"), zero("wall_time_ms").alias("ms"))
    w = Window.orderBy("run_id")  # runs, not rows
    return per.withColumn("d_n", F.col("n") - F.lag("n").over(w)).withColumn("d_found", F.col("found") - F.lag("found").over(w))


@query()
def residual_buckets(s, d):
    """Candidates by how their title fits the latest ones of openalex and crossref."""
    c = _t(s, d, "paper_candidate").where("trim(raw_title) <> ''").groupBy("candidate_id").agg(F.min_by("raw_title", "id").alias("t"))
    r = relational.latest(_t(s, d, "source_record").where("title is not null and source_name in ('openalex', 'crossref')").select("candidate_id", "source_name", "id", "title"), ["candidate_id", "source_name"], "id")
    both = c.join(r, "candidate_id").withColumn("s", F.round(sim.ratio_udf("t", "title"), 4)).withColumn("j", F.round(ids.token_jaccard(F.col("t"), F.col("title")), 4))
    of = lambda name, c: F.max(F.when(F.col("source_name") == name, F.col(c)))
    per = both.groupBy("candidate_id").agg(reports.residual_bucket(of("openalex", "s"), of("openalex", "j"), of("crossref", "s"), of("crossref", "j")).alias("bucket"))
    return per.groupBy("bucket").agg(F.count("*").alias("n"))


@query(r"""SELECT signature, count(*) AS n, count(DISTINCT venue) AS n_spellings FROM (SELECT venue, array_to_string(list_sort(list_distinct(list_filter(string_split_regex(lower(venue), '[^a-z0-9]+'), lambda x: x NOT IN ('', 'the', 'of', 'and', 'in', 'for', 'journal')))), ' ') AS signature FROM source_record WHERE venue IS NOT NULL) GROUP BY 1""")
def venue_signatures(s, d):
    """Venues by their telling words in any order."""
    light = F.array(*[F.lit(w) for w in ("", "the", "of", "and", "in", "for", "journal")])
    words = F.array_sort(F.array_distinct(F.array_except(F.split(F.lower("venue"), "[^a-z0-9]+"), light)))
    rows = _t(s, d, "source_record").where("venue is not null").select("venue", F.array_join(words, " ").alias("signature"))
    return rows.groupBy("signature").agg(F.count("*").alias("n"), F.countDistinct("venue").alias("n_spellings"))


@query("""SELECT s.candidate_id, s.id, coalesce(s.n_later, 0)::BIGINT AS n_later FROM (SELECT candidate_id, id, source_name, matched, count(*) FILTER (WHERE matched) OVER (PARTITION BY candidate_id ORDER BY id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS n_later FROM source_record) s WHERE NOT s.matched""")
def unmatched_then_matched(s, d):
    """Lookups without an answer and how many later ones of the candidate had one."""
    from pyspark.sql.window import Window

    later = Window.partitionBy("candidate_id").orderBy("id").rowsBetween(1, Window.unboundedFollowing)
    rows = _t(s, d, "source_record").select("candidate_id", "id", "matched")
    return rows.withColumn("n_later", F.count_if("matched").over(later)).where("not matched").select("candidate_id", "id", "n_later")
