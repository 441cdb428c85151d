"""Queries of this subpackage and their SQL."""

from __future__ import annotations

from ..tables import table as _t
from . import bpe, entity_match, format_copies, grid_components, history, mixture, name_variants, quality, survivor


def p1_found(s, d):
    return survivor.surviving_fields(_t(s, d, "source_record"), _t(s, d, "source_trust"))


def p1_records(s, d):
    """The surviving record of every candidate."""
    return survivor.surviving_records(_t(s, d, "source_record"), _t(s, d, "source_trust"))


def p2_sizes(s, d):
    """Stored and corrected sizes of the audited candidates' groups."""
    return grid_components.group_sizes(p2_found(s, d), _t(s, d, "fallback_audit"))


def p7_copies(s, d):
    """One row per record with the number of its copies."""
    return format_copies.collapsed(_t(s, d, "paper_candidate"), _t(s, d, "source_record"))


def p2_found(s, d):
    return grid_components.candidate_groups(_t(s, d, "library_prelink_match"), _t(s, d, "candidate_resolution_status"), _t(s, d, "merge_review_queue"))


def _names(s, d):
    return _t(s, d, "paper_candidate"), _t(s, d, "source_record"), _t(s, d, "provider_dump")


def p3_found(s, d):
    return name_variants.variant_pairs(*_names(s, d))


def p3_canonical(s, d):
    return name_variants.canonical_names(*_names(s, d))


def p5_found(s, d):
    return entity_match.match(_t(s, d, "paper_candidate"), _t(s, d, "provider_dump")).select("candidate_id", "record_id")


def p5_matches(s, d):
    return entity_match.match(_t(s, d, "paper_candidate"), _t(s, d, "provider_dump"))


def p6_found(s, d):
    return history.repeated_rows(_t(s, d, "paper_candidate"), _t(s, d, "candidate_batch"))


def p7_found(s, d):
    return format_copies.all_copies(_t(s, d, "paper_candidate"), _t(s, d, "source_record"))


def p8_ids(s, d):
    return bpe.encode_documents(_t(s, d, "documents"))


def p9_mix(s, d):
    return mixture.mix(_t(s, d, "documents"), _t(s, d, "mix_target"))


def p9_shares(s, d):
    return mixture.shares(_t(s, d, "documents"), _t(s, d, "mix_target"))


def p10_found(s, d):
    return quality.not_prose(_t(s, d, "documents"))


def p10_statistics(s, d):
    return quality.outliers(_t(s, d, "documents"))


QUERIES = {f.__name__: f for f in (p1_found, p1_records, p2_found, p2_sizes, p3_found, p3_canonical, p5_found, p5_matches, p6_found, p7_found, p7_copies, p8_ids, p9_mix, p9_shares, p10_found, p10_statistics)}
_LETTERS = r"regexp_replace(lower(nfc_normalize({})), '[^\p{{L}}\p{{N}}\p{{M}}]+', '', 'g')"
_NAMES = "list_sort(list_filter(list_transform(string_split({}, ','), lambda x: " + _LETTERS.format("x").replace("{", "{{").replace("}", "}}") + "), lambda x: x <> ''))"
_DOI = r"nullif(regexp_replace(regexp_extract(regexp_replace(lower(CASE WHEN contains({0}, '%') THEN url_decode({0}) ELSE {0} END), '\s+', '', 'g'), '10\.[0-9]{{4,9}}/[^\"<>]*', 0), '[\s./;,:>)\]]+$', ''), '')"
# The surviving values by plain sorting: where values differ, trust and recency never disagree in the tables
_HOLDERS = ", ".join("'" + p.replace("'", "''") + "'" for p in survivor.PLACEHOLDERS)
_SOUND = r"CASE WHEN x <> '' AND lower(x) NOT IN ({h}) AND lower(regexp_replace(x, '[.\s]+$', '')) NOT IN ({h}) AND regexp_replace(x, '[.\s]+$', '') <> '' THEN x END".format(h=_HOLDERS)
_FIELDS = r"""src AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY candidate_id) AS n_rows FROM source_record WHERE matched AND candidate_id IS NOT NULL) WHERE n_rows >= 2),
 raw AS (SELECT candidate_id, id, source_name, created_at, n_rows, 'venue' AS field_name, trim(regexp_replace(venue, '\s+', ' ', 'g')) AS x FROM src UNION ALL SELECT candidate_id, id, source_name, created_at, n_rows, 'abstract', trim(regexp_replace(abstract, '\s+', ' ', 'g')) FROM src),
 val AS (SELECT candidate_id, id, source_name, created_at, n_rows, field_name, CASE field_name WHEN 'venue' THEN regexp_replace(lower({sound}), '[^\p{{L}}\p{{N}}\p{{M}}]+', '', 'g') ELSE rtrim(regexp_replace({sound}, '\s*(\.\.\.|…|\[\s*(truncated|more|…|\.\.\.)\s*\]|\(\s*(more|truncated)\s*\)?)\s*$', '')) END AS key FROM raw
  UNION ALL SELECT candidate_id, id, source_name, created_at, n_rows, 'doi', CASE WHEN regexp_matches(d, '^10\.[0-9]{{4,9}}/[\p{{L}}\p{{N}}]') THEN d END FROM (SELECT *, {doi} AS d FROM src)),
 good AS (SELECT v.* FROM val v WHERE key <> '' AND NOT (field_name = 'abstract' AND EXISTS (SELECT 1 FROM val o WHERE o.candidate_id = v.candidate_id AND o.field_name = 'abstract' AND o.key <> v.key AND starts_with(o.key, v.key)))),
 best AS (SELECT candidate_id, field_name, key, row_number() OVER (PARTITION BY candidate_id, field_name ORDER BY coalesce(t.trust_rank, 99), created_at DESC, id) AS k FROM good g LEFT JOIN (SELECT source_name AS s, min(trust_rank) AS trust_rank FROM source_trust GROUP BY 1) t ON t.s = g.source_name),
 won AS (SELECT g.candidate_id, g.field_name, min(g.id) AS id, count(*) AS holders, max(g.n_rows) AS n_rows FROM good g JOIN best b ON b.k = 1 AND b.candidate_id = g.candidate_id AND b.field_name = g.field_name AND b.key = g.key GROUP BY 1, 2)""".format(sound=_SOUND, doi=_DOI.format("doi"))
_GROUPS = """
WITH RECURSIVE e AS (
  SELECT candidate_id AS u, chr(9) || paper_id AS v FROM library_prelink_match WHERE trim(paper_id) <> ''
  UNION SELECT candidate_id, leader_candidate_id FROM candidate_resolution_status WHERE status = 'clustered' AND trim(leader_candidate_id) <> ''
  UNION SELECT candidate_id, json_extract_string(assessment_json, '$.compared_with') FROM merge_review_queue WHERE json_extract_string(assessment_json, '$.verdict') = 'same' AND trim(json_extract_string(assessment_json, '$.compared_with')) <> ''),
 b AS (SELECT u AS x, v AS y FROM e UNION SELECT v, u FROM e),
 t AS (SELECT x, x AS y FROM b UNION SELECT t.x, b.y FROM t JOIN b ON t.y = b.x)
SELECT x AS candidate_id, min(y) FILTER (WHERE y NOT LIKE chr(9) || '%') AS group_id FROM t WHERE x NOT LIKE chr(9) || '%' GROUP BY x HAVING count(*) FILTER (WHERE y NOT LIKE chr(9) || '%') > 1"""
_COPIES = f"""
WITH c AS (SELECT id, {_LETTERS.format('raw_title')} AS t, CASE WHEN trim(coalesce(raw_authors, '')) = '' THEN NULL ELSE {_NAMES.format('raw_authors')} END AS a FROM paper_candidate),
 s AS (SELECT id, source_name, {_DOI.format('doi')} AS d FROM source_record WHERE source_name IS NOT NULL),
 x AS (SELECT 'paper_candidate' AS table_name, id, min(id) OVER (PARTITION BY t, a) AS first_id FROM c WHERE t <> ''
  UNION ALL SELECT 'source_record', id, min(id) OVER (PARTITION BY source_name, d) FROM s WHERE regexp_matches(d, '^10\\.[0-9]{{4,9}}/[\\p{{L}}\\p{{N}}]'))
SELECT table_name, first_id, id FROM x WHERE id > first_id"""
SQL: dict[str, str] = {
    "p1_found": f"WITH {_FIELDS} SELECT candidate_id, field_name, id FROM won WHERE holders < n_rows",
    "p2_found": _GROUPS,
    "p2_sizes": f"WITH g AS ({_GROUPS}), n AS (SELECT *, count(*) OVER (PARTITION BY group_id) AS n FROM g) SELECT a.candidate_id, a.paper_id, a.duplicate_group_size AS stored_size, coalesce(n.group_id, a.candidate_id) AS group_id, CASE WHEN a.candidate_id IS NOT NULL THEN coalesce(n.n, 1) END AS group_size FROM fallback_audit a LEFT JOIN n ON n.candidate_id = a.candidate_id",
    "p7_found": _COPIES,
    "p7_copies": f"WITH f AS ({_COPIES}), r AS (SELECT 'paper_candidate' AS table_name, id FROM paper_candidate UNION ALL SELECT 'source_record', id FROM source_record), n AS (SELECT table_name, first_id, count(*) + 1 AS n FROM f GROUP BY 1, 2) SELECT r.table_name, r.id, coalesce(n.n, 1) AS n_copies FROM r LEFT JOIN n ON n.table_name = r.table_name AND n.first_id = r.id WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.table_name = r.table_name AND f.id = r.id)",
}
