"""Stages on small fixtures: lookups, links, acceptance, grading, audits."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from paperweave.functions import similarity
from paperweave.operators import acceptance, durable, grading, links, lookups, reports
from paperweave.plans import stages
from paperweave.sources import mime, store


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


# ---- grades
@pytest.mark.parametrize(
    ("values", "grade"),
    [
        (["deep learning for stroke", "deep learning for stroke."], "A"),
        (["deep learning for acute stroke triage", "deep learning for acute stroke triages x"], "B"),
        (["imaging of the heart in mice", "imaging of the heart in mice: a long term study"], "B"),
        (["imaging of the heart", "a wholly different matter"], "C"),
    ],
)
def test_title_grades(values, grade):
    assert grading.grade_titles(values) == grade


@pytest.mark.parametrize(
    ("values", "grade"),
    [
        (["jacc", "journal of the american college of cardiology"], "A"),
        (["the journal of hearts", "hearts"], "A"),
        (["annals of applied hearts", "hearts of applied annals"], "A"),
        (["annals of vascular medicine", "annals of vascular medicin e"], "A"),
        (["annals of vascular medicine", "proceedings in robotics"], "C"),
    ],
)
def test_venue_grades(values, grade):
    assert grading.grade_venues(values) == grade


SOURCE = "candidate_id string, id long, source_name string, query_type string, matched boolean, title string, venue string, year string, doi string, pmid string, pmcid string, extra int"


def test_conflicts_by_grade(spark):
    df = spark.createDataFrame(
        [
            ("a", 1, "crossref", "doi", True, "Hearts of mice", "JACC", "2020", "10.1/a", None, None, 0),
            ("a", 2, "openalex", "doi", True, "Hearts of mice.", "Journal of the American College of Cardiology", "2021", "https://doi.org/10.1/A", None, None, 0),
            ("b", 3, "crossref", "doi", True, None, None, "2020", None, "1", None, 0),
            ("b", 4, "openalex", "doi", True, " ", None, "2024", None, "2", None, 0),
            ("c", 5, "openalex", "doi", False, "x", None, "2024", None, "2", None, 0),
            ("d", 6, None, None, True, None, None, "n.d.", None, None, None, 0),
            ("d", 7, None, None, True, None, None, "2024", None, None, None, 0),
        ],
        SOURCE,
    )
    assert rows(grading.graded_conflicts(df).select("candidate_id", "field_name", "grade")) == [("a", "venue", "A"), ("a", "year", "B"), ("b", "pmid", "C"), ("b", "year", "C"), ("d", "year", "C")]
    got = grading.assessment(df)
    assert rows(got.select("candidate_id", "worst", "blocked", "confidence")) == [("a", "B", False, 0.65), ("b", "C", True, 0.25), ("d", "C", True, 0.25)]
    assert tuple(grading.proposal_quality(got).head()) == (3, 3, 3, 2, 0, 1, 2)
    assert rows(grading.routed(got)) == [("a", "assign", None), ("b", "review", "several_severe"), ("d", "review", "severe_conflict")]
    assert rows(grading.assessment(df.limit(0))) == []


def test_stored_payloads(spark):
    q = spark.createDataFrame([("a", '{"canonical_blocked": true, "canonical_block_reason": "r"}'), ("b", '{"doi": ["x", "y"], "title": ["t", "u"]}'), ("c", '{"doi": ["x"]}'), ("d", "{broken"), ("e", None)], "candidate_id string, assessment_json string")
    assert rows(grading.stored_assessment(q)) == [("a", True, "r", ""), ("b", True, "legacy_severe_conflict:doi", "doi"), ("c", False, None, ""), ("d", False, None, ""), ("e", False, None, "")]


def test_suppressed_dois(spark):
    made = [
        ("a", 1, "crossref", "doi", True, None, "V", "2020", "10.1/x", None, None, 0),
        ("a", 2, "openalex", "doi", True, None, "V", "2020", "10.1/X", None, None, 0),
        ("a", 3, "pubmed", "title", True, None, "V", "2020", "10.1/other", None, "PMC1", 0),
        ("b", 4, "crossref", "title", True, None, "Annals of Hearts", "2020", "10.1/c", None, None, 0),
        ("b", 5, "pubmed", "pmid", True, None, None, "2020", "10.1/d", "9", None, 0),
        ("c", 6, "europepmc", "pmid", True, None, "Annals of Hearts", "2020", "10.1/e", "9", None, 0),
        ("c", 7, "pubmed", "pmid", True, None, "Annals of Hearts", "2020", "10.1/f", "9", "PMC2", 0),
        ("d", 8, "pubmed", "pmid", True, None, None, None, "10.1/g", None, None, 0),
    ]
    c = spark.createDataFrame([("a", None, None, None, "PMC7"), ("b", "Annals of Hearts", "2020", "https://journal.example/1", None), ("c", None, None, None, None), ("d", None, None, None, None)], "candidate_id string, venue string, year string, url string, pmcid string")
    got = grading.suppressed_dois(spark.createDataFrame(made, SOURCE), c)
    assert rows(got.select("candidate_id", "id", "reason")) == [("a", 3, "pubmed_title_doi_conflicts_with_candidate_pmcid"), ("b", 5, "pubmed_pmid_doi_conflicts_with_crossref_plus_candidate_url"), ("c", 7, "pubmed_pmid_doi_conflicts_with_europepmc_pmid_consensus")]


def test_polluted_titles(spark):
    df = spark.createDataFrame([("心脏成像",), ("Ann Smith 1 Bob Jones 2 Cy Young 3",), ("Imaging of hearts, Ann Smith, Bob Jones PhD",), ("Imaging of hearts in mice",), (None,)], "t string")
    flags = [tuple(r[0]) for r in df.select(grading.title_pollution(F.col("t"))).collect()]
    assert flags == [(True, False, False), (False, True, False), (False, False, True), (False, False, False), (False, False, False)]
    assert [r[0] for r in df.select(grading.without_names(F.col("t"))).collect()][2:] == ["Imaging of hearts", None, None]
    t = df.where("t like 'Imaging%'").select(F.lit("a").alias("candidate_id"), F.col("t").alias("title"))
    answers = spark.createDataFrame([("a", 1, "Imaging of hearts", "10.1/a", None, None), ("a", 2, None, None, None, None)], "candidate_id string, id long, title string, doi string, pmid string, pmcid string")
    assert [(r.cleaned, r.similarity, r.id) for r in grading.salvaged_titles(t, answers).collect()] == [("Imaging of hearts", 1.0, 1)]


# ---- acceptance
def test_acceptance(spark):
    schema = "k string, n int, source_name string, q_title string, q_year string, q_family string, q_venue string, q_doi string, title string, year string, authors array<string>, venue string, doi string"
    t = "Deep learning for the triage of septic shock"
    made = [
        ("same", 1, "openalex", t, "2020", "Fizo", None, None, t, "2021", None, None, None),
        ("other doi", 1, "openalex", t, None, None, None, "10.1/a", t, None, None, None, "10.1/b"),
        ("other author", 1, "openalex", t, None, "Fizo", None, None, t, None, ["Goka"], None, None),
        ("other venue", 1, "openalex", t, None, None, "Hearts", None, t, None, None, "Kidneys of men", None),
        ("cut", 1, "openalex", t + "…", "2020", "Fizo", "Hearts", None, t + " in rural mice", "2020", ["A Fizo"], "Annals of Hearts", None),
        ("cut", 2, "openalex", t, None, None, None, None, "Nothing alike at all", None, None, None, None),
        ("pubmed", 1, "pubmed", t, None, None, None, None, t + "ing x", None, None, None, None),
        ("none", 1, "openalex", None, None, None, None, None, None, None, None, None, None),
    ]
    got = acceptance.accepted(acceptance.evidence(spark.createDataFrame(made, schema)))
    assert {(r.k, r.n): r.accepted for r in got.collect()} == {("same", 1): True, ("other doi", 1): False, ("other author", 1): False, ("other venue", 1): False, ("cut", 1): True, ("cut", 2): False, ("pubmed", 1): False, ("none", 1): False}
    best = acceptance.best_answers(got, "k", "n")
    assert {r.k: r.n for r in best.collect()}["cut"] == 1
    assert similarity.matching_ratio("a", "a") == 1.0


# ---- lookups
def test_intents_and_groups(spark):
    df = spark.createDataFrame([("a", "https://doi.org/10.1/A", "7", None, "Stroke in mice", None), ("b", None, None, None, "Brain  imaging", None), ("c", None, None, "2401.1", None, None), ("d", " ", None, None, " ", None)], "candidate_id string, doi string, pmid string, arxiv string, title string, venue string")
    asked = lookups.intents(df)
    assert rows(asked.where("candidate_id = 'a'").select("provider", "query_type", "query_key")) == [("crossref", "doi", "10.1/a"), ("europepmc", "pmid", "7"), ("openalex", "doi", "10.1/a"), ("pubmed", "pmid", "7"), ("semanticscholar", "doi", "10.1/a")]
    assert {r.provider for r in asked.where("candidate_id = 'b'").collect()} == {"crossref", "openalex", "semanticscholar", "pubmed", "europepmc"}
    assert rows(asked.where("candidate_id in ('c', 'd')")) == [("c", "arxiv", "arxiv_id", "2401.1")]
    assert {r.provider for r in lookups.intents(df, broad=True, open_access=True).where("candidate_id = 'b'").collect()} >= {"arxiv"}
    led = lookups.with_followers(asked, spark.createDataFrame([("a", "c"), ("b", "b"), ("x", None)], "candidate_id string, leader string"))
    assert {r.provider for r in led.where("candidate_id = 'a'").collect()} == {"arxiv"} and led.where("candidate_id = 'b'").count() == 5
    assert rows(lookups.in_lanes(asked, ("slow_fallback",)).select("candidate_id", "lane_rank")) == [("a", 4), ("b", 4)]
    two = spark.createDataFrame([("a", "p", "title", "t", 1), ("b", "p", "title", "t", 2), ("c", "p", "doi", "d", 1), ("d", "p", "doi", "d", 2), ("e", "p", "title", "u", None)], "candidate_id string, provider string, query_type string, query_key string, ctx_col int")
    got = lookups.dispatch_groups(two, ["ctx_col"])
    assert got.count() == 4 and rows(got.where("variant = 'default'").select("query_key", "n_intents")) == [("d", 2), ("u", 1)]


def test_answers_hold_for_a_time(spark):
    at = lambda d: dt.datetime(2025, 1, d)
    made = [(1, "p", "title", "T  x", "a", True, "{}", at(1)), (2, "p", "title", "T x", "b", False, '{"error": "down"}', at(2)), (3, "p", "doi", "10.1/A", "a", False, '{"http_error": 404}', at(1)), (4, "q", "doi", None, "a", True, None, at(1)), (5, "q", "doi", "10.1/b", "a", False, '{"http_error": 503}', at(1)), (6, "q", "doi", "10.1/c", "a", None, "{broken", at(1))]
    stored = lookups.stored_answers(spark.createDataFrame(made, "id long, source_name string, query_type string, query_string string, candidate_id string, matched boolean, raw_payload_json string, created_at timestamp_ntz"))
    assert {r.id: (r.cache_status, r.error_type) for r in stored.collect()} == {1: ("positive_match", None), 2: ("transient_error", "provider_error"), 3: ("permanent_no_match", "http_404"), 4: ("positive_match", None), 5: ("transient_error", "http_503"), 6: ("permanent_no_match", None)}
    now = F.lit("2025-01-03 00:00:00").cast("timestamp_ntz")
    assert {r.id for r in lookups.valid_answers(stored, now).collect()} == {1, 3, 6}
    asked = spark.createDataFrame([("a", "p", "title", "T x"), ("b", "p", "title", "T x"), ("c", "p", "doi", "none"), ("d", "p", "doi", "none")], "candidate_id string, provider string, query_type string, query_key string")
    out = lookups.fanned_out(asked, lookups.valid_answers(stored, now))
    assert rows(out.select("candidate_id", "outcome", "is_request")) == [("a", "positive_match", False), ("b", "positive_match", False), ("c", "no_answer", True), ("d", "no_answer", False)]


# ---- links
def test_links(spark):
    df = spark.createDataFrame([("a", 1, "https://doi.org/10.1/X", None, "pmc9", None, "https://s.example/scholar?cluster=77&hl=en"), ("b", 2, "10.1/x", None, None, None, None), ("c", 3, None, None, None, None, "https://s.example/scholar?cluster=77&hl=de"), ("d", 4, None, None, None, None, None)], "candidate_id string, id long, doi string, pmid string, pmcid string, arxiv string, url string")
    keys = links.exact_keys(df)
    assert {(r.key_type, r.key) for r in keys.where("candidate_id = 'a'").collect()} == {("doi", "10.1/x"), ("pmcid", "PMC9"), ("scholar_cluster", "77"), ("url", "https://s.example/scholar?cluster=77&hl=en")}
    held = spark.createDataFrame([(5, "a", "P5"), (2, "a", "P2"), (9, "z", None)], "id long, candidate_id string, paper_id string")
    aliases = links.library_aliases(held, keys)
    assert {r.paper_id for r in aliases.collect()} == {"P2"}
    linked = held.where("paper_id is not null")
    assert rows(links.prelinked(keys, aliases, linked)) == [("b", "P2", "doi_exact", 1.0), ("c", "P2", "scholar_cluster_exact", 0.98)]
    assert rows(links.resolve_next(df, aliases, linked, 1).select("candidate_id")) == [("b",)]
    old = spark.createDataFrame([("a", "x"), ("b", "y")], "candidate_id string, v string")
    new = spark.createDataFrame([("a", "new"), ("b", "new")], "candidate_id string, v string")
    assert rows(links.load_proposals(old, new, linked)) == [("a", "x"), ("b", "new")]


def test_open_access(spark):
    papers = spark.createDataFrame([("P1", "10.1/a"), ("P2", "10.1/b"), ("P3", " "), ("P4", "10.1/d")], "paper_id string, doi string")
    st = spark.createDataFrame([("P1", "unpaywall", "error", 1), ("P1", "unpaywall", "ok", 2), ("P2", "unpaywall", "error", 3), ("P4", "other", "ok", 4)], "paper_id string, provider string, status string, id long")
    assert rows(links.oa_queue(papers, st)) == [("P2", "10.1/b"), ("P4", "10.1/d")]
    df = spark.createDataFrame([("{}", True), ('{"http_error": 404}', False), ('{"error": "x"}', False), ('{"http_error": 500}', False), (None, None)], "p string, m boolean")
    assert [r[0] for r in df.select(links.oa_status(F.col("p"), F.col("m"))).collect()] == ["ok", "no_match", "error", "error", "no_match"]
    shape = "paper_id string, status string, is_open boolean, url string, score double, id long"
    held = spark.createDataFrame([("P1", "ok", True, "u", 1.0, 1)], shape)
    answers = spark.createDataFrame([("P1", "error", None, None, None, 2), ("P2", "ok", None, "v", 0.5, 3)], shape)
    assert rows(links.oa_snapshots(held, answers).select("paper_id", "url", "is_open")) == [("P1", "u", True), ("P2", "v", False)]


# ---- audits, documents, durable tables
def test_audits(spark):
    a = spark.createDataFrame([("a", "P", 0, 0.2, 5, None, " "), ("b", "P", 1, 0.6, 1, "V", "2020"), ("c", None, None, None, None, "V", "2020")], "candidate_id string, paper_id string, identifiers int, similarity double, unmatched int, venue string, year string")
    assert rows(reports.suspicion(a)) == [("a", "P", 6, 2, False), ("b", "P", 2, 2, False), ("c", None, 5, None, None)]
    b = spark.createDataFrame([(0.5, 0.3, 0.95, 0.9), (0.6, 0.3, 0.85, 0.1), (None, None, 0.5, 0.9), (0.1, 0.1, 0.85, 0.5)], "a double, b double, c double, d double")
    assert [r[0] for r in b.select(reports.residual_bucket(*map(F.col, "abcd"))).collect()] == ["likely_openalex_recall_gap", "possible_normalization_or_ranking_issue", "source_title_noise_or_crossref_cleanup", "mixed_or_unclear"]
    assert reports.render("R", b.limit(1)).startswith("R\na=0.5")
    assert store.plan_document("x.json", "R", b).startswith("{") and store.plan_document("x.md", "R", b).startswith("# R")


def test_mailboxes(spark, tmp_path):
    for name, subject in (("1;2,S", "one"), ("2;2,", "two"), ("3;2,", "three")):
        (tmp_path / name).write_bytes(f"Subject: {subject}\r\n\r\nx".encode())
    subjects = lambda **k: sorted(r.subject for r in mime.mailbox(spark, str(tmp_path), **k).collect())
    assert subjects() == ["one", "three", "two"] and subjects(unseen_only=True) == ["three", "two"] and subjects(limit=1) == ["three"]


def test_scratch_tables_can_be_cleaned(spark):
    kept = durable.Scratch(spark, "gone").keep(spark.range(3))
    folder = kept.inputFiles()[0]
    durable.clean(spark)
    assert not store.exists(spark, folder)


def test_policy_and_settings():
    p = stages.Policy().with_overlay({"broad": "yes", "lanes": "title_core, ", "salvage_threshold": "0.9", "batch_limit": " ", "unknown": 1})
    assert p == stages.Policy(lanes=("title_core",), broad=True, salvage_threshold=0.9)
    values, source = stages.settings({"PAPERWEAVE_A": "1", "X": "2"}, "# c\nexport PAPERWEAVE_A=0\nPAPERWEAVE_B='b'\n")
    assert values == {"a": "1", "b": "b"} and source == "file+environment" and stages.settings({}) == ({}, "defaults")


def test_parse_stage(spark):
    link = '<div><h3><a href="https://x.example/1">A title that is long enough to be one</a></h3><div>A B - V, 2020</div></div>'
    mails = spark.createDataFrame([("m1", True), ("m2", True), ("m3", True), ("m4", False), ("m5", True)], "mail_uid string, is_alert boolean")
    snaps = spark.createDataFrame([("m1", link), ("m2", "<p>none</p>"), ("m4", link), ("m5", link)], "mail_uid string, body_html string")
    found, events = stages.parse_stage(mails, snaps, spark.createDataFrame([("m5",)], "mail_uid string"))
    assert rows(events) == [("m1", "ok", 1), ("m2", "no_candidates", 0), ("m3", "missing_snapshot", 0)]
    assert [(r.mail_uid, r.candidate_index_in_mail) for r in found.collect()] == [("m1", 1)]


def test_merged_records(spark):
    c = spark.createDataFrame([("a", 1, "Own title of a", "X Y", None, None, None, "Own venue", "2019", 0), ("b", 2, "Own title of b", None, None, None, None, None, None, 0)], "candidate_id string, id long, raw_title string, raw_authors string, raw_link string, raw_snippet string, target_url string, venue_guess string, year_guess string, extra int")
    shape = "candidate_id string, id long, source_name string, query_type string, matched boolean, title string, authors_json string, venue string, year string, doi string, pmid string, pmcid string, abstract string"
    r = spark.createDataFrame([("a", 1, "crossref", "doi", True, "T", '["X Y"]', None, "2020", "10.1000/a", None, None, None), ("a", 2, "openalex", "doi", True, "T", None, None, None, "10.1000/a", None, None, None), ("a", 3, "pubmed", "title", True, "T", None, None, None, "10.1000/z", "7", None, "abs")], shape)
    got = {x.candidate_id: x for x in stages.merged_records(c, r).collect()}
    assert (got["a"].title, got["a"].venue, got["a"].year, got["a"].doi, got["a"].pmid, got["a"].blocked, got["a"].confidence) == ("T", "Own venue", "2020", "10.1000/a", "7", False, 0.9)
    assert (got["b"].title, got["b"].doi, got["b"].confidence) == ("Own title of b", None, None)


def test_stage_log(spark):
    log = stages.run_stages(spark, {"one": lambda: spark.range(3), "two": lambda: spark.range(5)}, lambda name, df: df)
    assert [(r.stage, r.rows) for r in log.collect()] == [("one", 3), ("two", 5)]
