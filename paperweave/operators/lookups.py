"""Lookups at providers: what to ask, how to group it, what is known already (op ids C1-C2, E1-E4, E6, E7, E12, E14, F4-F6, G11, G12, I9, I13, J13, L4, A13-A16)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Parts of words in biomedical titles and venues, minutes that stored answers live, lanes in their order, types of identifiers.
BIOMEDICAL = "mri|magnetic resonance|stroke|brain|cerebral|neurolog|radiolog|cardio|vascular|medic|clinical|neuro|oncolog|disease|patient"
TTL_MINUTES = {"positive_match": 43_200, "permanent_no_match": 4_320, "transient_error": 15}
LANES = ("identifier_fastpath", "title_core", "biomedical_fallback", "slow_fallback")
IDENTIFIERS = ("doi", "doi_batch", "pmid", "pmcid", "arxiv_id")
BATCHED, BATCH_SIZE = ("openalex", "doi"), 50


def _full(c):
    return F.nullif(F.trim(c), F.lit(""))


def query_key(query_type, text):
    """The form in which lookups are the same: DOIs bare and in lower case, titles with single blanks, others trimmed."""
    bare = F.regexp_replace(F.lower(F.trim(text)), r"^https://doi\.org/", "")
    return _full(F.when(query_type.isin("doi", "doi_batch"), bare).when(query_type == "title", F.regexp_replace(text, r"\s+", " ")).otherwise(F.trim(text)))


def intents(rows: DataFrame, broad: bool = False, open_access: bool = False) -> DataFrame:
    """(candidate_id, provider, query_type, query_key): what to ask for every candidate.

    rows has candidate_id, doi, pmid, arxiv, title and venue. The DOI is asked for where there is one, else the title;
    pubmed and europepmc take a PMID, else a biomedical title without DOI (with broad, europepmc the DOI too); arxiv
    its own id or a title that names it (with broad any title); unpaywall a DOI if open_access is asked for.
    Candidates without any of them ask nothing.
    """
    title, doi, pmid, arxiv = (_full(F.col(c)) for c in ("title", "doi", "pmid", "arxiv"))
    medical = F.lower(F.concat_ws(" ", F.col("venue"), title)).rlike(BIOMEDICAL)
    ask = lambda provider, kind, text, when: F.when(when & text.isNotNull(), F.struct(F.lit(provider).alias("provider"), F.lit(kind).alias("query_type"), text.alias("text")))
    always, bare = F.lit(True), doi.isNull()
    wanted = [ask(p, kind, text, when) for p in ("crossref", "openalex", "semanticscholar") for kind, text, when in (("doi", doi, always), ("title", title, bare))]
    wanted += [ask(p, kind, text, when) for p in ("pubmed", "europepmc") for kind, text, when in (("pmid", pmid, always), ("title", title, pmid.isNull() & bare & medical))]
    wanted += [ask("europepmc", "doi", doi, pmid.isNull() & title.isNotNull() & medical & broad), ask("arxiv", "arxiv_id", arxiv, always), ask("arxiv", "title", title, arxiv.isNull() & (F.lower(title).contains("arxiv") | broad)), ask("unpaywall", "doi", doi, F.lit(open_access))]
    out = rows.select("candidate_id", F.explode(F.array_compact(F.array(*wanted))).alias("x")).select("candidate_id", "x.*")
    return out.select("candidate_id", "provider", "query_type", query_key(F.col("query_type"), F.col("text")).alias("query_key")).where("query_key is not null")


def with_followers(asked: DataFrame, followers: DataFrame) -> DataFrame:
    """Intents in which followers (candidate_id, leader) ask what their leader asks, in place of their own."""
    led = followers.where("leader is not null and leader <> candidate_id").groupBy("candidate_id").agg(F.min("leader").alias("leader"))
    own = asked.join(led, "candidate_id", "left_anti")
    return own.unionByName(led.join(asked.withColumnRenamed("candidate_id", "leader"), "leader").select(*own.columns))


def lane(provider, query_type):
    """The lane of a lookup."""
    fast, core, medical, slow = LANES
    return F.when(provider == "semanticscholar", slow).when(query_type.isin(*IDENTIFIERS), fast).when(provider.isin("crossref", "openalex", "arxiv"), core).when(provider.isin("pubmed", "europepmc"), medical).otherwise(slow)


def in_lanes(asked: DataFrame, lanes: tuple[str, ...] = LANES) -> DataFrame:
    """Intents of the enabled lanes with lane and its rank."""
    rank = F.array_position(F.array(*[F.lit(x) for x in LANES]), F.col("lane"))
    return asked.withColumn("lane", lane(F.col("provider"), F.col("query_type"))).where(F.col("lane").isin(*lanes)).withColumn("lane_rank", rank.cast("bigint"))


def context_hash(*columns: str):
    """Hash of what an answer's acceptance depends on; nulls count as empty."""
    return F.concat(F.lit("ctx_"), F.substring(F.sha1(F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])), 1, 16))


def dispatch_groups(asked: DataFrame, context: list[str]) -> DataFrame:
    """(provider, query_type, query_key, variant, n_intents, first_candidate): the requests that intents need.

    Intents of one key share a request if it is by identifier, or if the columns context agree in all of
    them; else each context asks for itself (variant is its hash).
    """
    key = ["provider", "query_type", "query_key"]
    rows = asked.withColumn("ctx", context_hash(*context))
    by_context = rows.groupBy(*key, "ctx").agg(F.count("*").alias("n"), F.min("candidate_id").alias("first"))
    shared = F.col("query_type").isin(*IDENTIFIERS)
    alone = by_context.groupBy(*key).agg(F.count("*").alias("contexts"))
    variant = F.when(shared | (F.col("contexts") == 1), "default").otherwise(F.col("ctx"))
    return by_context.join(alone, key).withColumn("variant", variant).groupBy(*key, "variant").agg(F.sum("n").alias("n_intents"), F.min("first").alias("first_candidate"))


# Names of the gaps that a single key other than a DOI leaves.
GAPS = {"pmid": "pmid_without_doi", "pmcid": "pmcid_only", "url": "url_canonical_only", "scholar_cluster": "scholar_cluster_only", "arxiv": "arxiv_only"}


def gap_kind(kinds):
    """Which keys other than a DOI an array of key types has (G12): null for none, a name for one, mixed for several."""
    other = F.array_except(kinds, F.array(F.lit("doi")))
    names = F.create_map(*[F.lit(x) for kv in GAPS.items() for x in kv])
    return F.when(F.size(other) == 1, F.try_element_at(names, F.element_at(other, 1))).when(F.size(other) > 1, "mixed_non_doi_identifier")


def title_reasons(asked: DataFrame, keys: DataFrame, leaders: DataFrame) -> DataFrame:
    """(candidate_id, reason, subreason) of the candidates that ask by title (E12): they lead a group, have other keys, or none.

    keys has (candidate_id, key_type); leaders (leader) the candidates that others follow.
    """
    by_title = in_lanes(asked, ("title_core",)).where("query_type = 'title'").select("candidate_id").distinct()
    held = keys.groupBy("candidate_id").agg(F.collect_set("key_type").alias("kinds"))  # at most one per kind
    rows = by_title.join(held, "candidate_id", "left").join(leaders.select(F.col("leader").alias("candidate_id"), F.lit(True).alias("leads")).distinct(), "candidate_id", "left")
    has = F.col("kinds").isNotNull()
    reason = F.when(F.col("leads"), "cluster_leader_path").when(has, "identifier_present_but_not_sufficient_for_provider_path").otherwise("no_identifier_available")
    return rows.select("candidate_id", reason.alias("reason"), F.when(F.col("leads").isNull() & has, gap_kind(F.col("kinds"))).alias("subreason"))


# ---- stored answers
def answer_status(payload, matched):
    """What a stored answer says: an error passes, a missing page stays missing."""
    error, http = F.get_json_object(payload, "$.error"), F.get_json_object(payload, "$.http_error").try_cast("int")
    failed = F.coalesce(~F.lower(error).isin("", "false", "null", "0", "[]", "{}"), F.lit(False))
    return F.when(failed, "transient_error").when(http == 404, "permanent_no_match").when(http.isNotNull(), "transient_error").when(F.coalesce(matched, F.lit(False)), "positive_match").otherwise("permanent_no_match")


def stored_answers(records: DataFrame) -> DataFrame:
    """(provider, query_type, query_key, id, candidate_id, cache_status, error_type, expires_at) of the lookups made."""
    http = F.get_json_object("raw_payload_json", "$.http_error").try_cast("int")
    status = answer_status(F.col("raw_payload_json"), F.col("matched"))
    rows = records.select(F.col("source_name").alias("provider"), "query_type", query_key(F.col("query_type"), F.col("query_string")).alias("query_key"), "id", "candidate_id", status.alias("cache_status"), http.alias("http"), "created_at")
    minutes = F.create_map(*[F.lit(x) for kv in TTL_MINUTES.items() for x in kv])[F.col("cache_status")]
    error = F.when(F.col("http").isNotNull(), F.concat(F.lit("http_"), F.col("http").cast("string"))).when(F.col("cache_status") == "transient_error", "provider_error")
    return rows.select("provider", "query_type", "query_key", "id", "candidate_id", "cache_status", error.alias("error_type"), (F.col("created_at") + F.make_dt_interval(F.lit(0), F.lit(0), minutes)).alias("expires_at"))


def valid_answers(stored: DataFrame, now, with_errors: bool = False) -> DataFrame:
    """The latest answer of each lookup that has not expired at now and is no passing error."""
    kinds = ["positive_match", "permanent_no_match"] + (["transient_error"] if with_errors else [])
    rows = stored.where(F.col("cache_status").isin(*kinds) & (F.col("expires_at").isNull() | (F.col("expires_at") > now)))
    key = ["provider", "query_type", "query_key"]
    return rows.where("query_key is not null").groupBy(*key).agg(F.max_by(F.struct("id", "cache_status", "expires_at"), "id").alias("x")).select(*key, "x.*")


def fanned_out(asked: DataFrame, answers: DataFrame) -> DataFrame:
    """Intents with the answer of their lookup, if any; the first candidate of a lookup counts as its request.

    asked has (candidate_id, provider, query_type, query_key), answers (the three, cache_status). outcome is
    the answer's status, or no_answer.
    """
    key = ["provider", "query_type", "query_key"]
    first = asked.groupBy(*key).agg(F.min("candidate_id").alias("first"))
    rows = asked.join(first, key).join(answers.select(*key, "cache_status"), key, "left")
    return rows.select("candidate_id", *key, F.coalesce("cache_status", F.lit("no_answer")).alias("outcome"), ((F.col("candidate_id") == F.col("first")) & F.col("cache_status").isNull()).alias("is_request"))


def runnable(asked: DataFrame, statuses: DataFrame) -> DataFrame:
    """Intents without a status, or whose last try failed."""
    key = ["candidate_id", "provider", "query_type"]
    last = statuses.groupBy(*key).agg(F.max_by("status", "id").alias("status"))
    return asked.join(last, key, "left").where("status is null or status = 'error'").select(*asked.columns)


# ---- plans
def plan_report(records: DataFrame) -> DataFrame:
    """(provider, query_type, family, n_intents, n_unique, n_duplicate, n_requests, saved, saved_by_batching).

    query_type is null in the totals of a provider. Requests by DOI to openalex go out in batches of 50.
    """
    per = records.groupBy(F.coalesce("source_name", F.lit("none")).alias("provider"), "query_type").agg(F.count("*").alias("n_intents"), F.countDistinct("query_string").alias("n_unique"))
    batched = (F.col("provider") == BATCHED[0]) & (F.col("query_type") == BATCHED[1])
    per = per.withColumn("n_requests", F.when(batched, F.ceil(F.col("n_unique") / BATCH_SIZE)).otherwise(F.col("n_unique")).cast("bigint"))
    family = F.when(F.col("query_type").isin(*IDENTIFIERS), "identifier").when(F.col("query_type").isNotNull(), "title")
    total = per.groupBy("provider").agg(*[F.sum(c).alias(c) for c in ("n_intents", "n_unique", "n_requests")]).withColumn("query_type", F.lit("all"))
    both = per.withColumn("family", family).unionByName(total.withColumn("family", F.lit("all")))
    return both.select("provider", "query_type", "family", "n_intents", "n_unique", (F.col("n_intents") - F.col("n_unique")).alias("n_duplicate"), "n_requests", (F.col("n_intents") - F.col("n_requests")).alias("saved"), (F.col("n_unique") - F.col("n_requests")).alias("saved_by_batching"))


def recommendations(report: DataFrame) -> DataFrame:
    """The lines of a plan that save requests, the most first."""
    return report.where("saved > 0 and query_type <> 'all'").orderBy(F.desc("saved"), "provider", "query_type").select("provider", "query_type", "saved")


def shared_lookups(records: DataFrame, n: int = 10, listed: int = 5) -> DataFrame:
    """The n lookups that most candidates share, with their first candidates in order.

    Only the smallest ``listed`` candidates are kept, found by rank after counting.
    """
    key = ["source_name", "query_type", "query_string"]
    one = records.where("query_string is not null").select(*key, "candidate_id").distinct()
    top = one.groupBy(*key).agg(F.count("*").alias("n_candidates")).where("n_candidates > 1").orderBy(F.desc("n_candidates"), *key).limit(n)
    named = top.select(*[F.col(k).alias(f"t_{k}") for k in key], "n_candidates")
    same = [F.col(k).eqNullSafe(F.col(f"t_{k}")) for k in key]
    ranked = one.join(F.broadcast(named), same).select(*key, "candidate_id", "n_candidates").withColumn("k", F.row_number().over(Window.partitionBy(*key).orderBy("candidate_id"))).where(F.col("k") <= listed)  # n rows are broadcast
    names = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "candidate_id"))), lambda x: x["candidate_id"]), ",")
    return ranked.groupBy(*key, "n_candidates").agg(names.alias("candidates"))
