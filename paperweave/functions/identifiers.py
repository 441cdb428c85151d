"""Identifiers and URLs as column expressions (op ids I1-I10, X2)."""

from __future__ import annotations

from pyspark.sql import functions as F

# Patterns of identifiers.
DOI = r"(?i)10\.\d{4,9}/[-._;()/:A-Z0-9]+"
PMID = r"(?i)(?:pubmed\.ncbi\.nlm\.nih\.gov/|pmid[/:\s])(\d{5,10})"
PMCID = r"(?i)(?:pmc(?:\.ncbi\.nlm\.nih\.gov)?/articles/|pmcid[/:\s])(PMC\d+)"
ARXIV = r"(?i)arxiv\.org/(?:abs|pdf)/([0-9]{4}\.[0-9]{4,5})(?:v\d+)?"
#: What is taken off the end of a DOI, each once and in this order.
DOI_ENDINGS = (r"/\d+/\d+/[^/]+\.pdf$", r"/\d{5,}/[^/]+\.pdf$", r"(/download|/full\.pdf|_reference\.pdf|\.pdf)$", r"/full$", r"/abstract$", r"/pdf$", r"[ ./;,]+$")
URI = r"^(?:([^:/?#]+):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#.*)?$"


def _full(col):
    return F.when(col != "", col)


def tidy_doi(col):
    """A DOI in lower case without resolver, file endings and final punctuation."""
    out = F.regexp_replace(F.lower(F.trim(col)), r"^https://doi\.org/", "")
    for pattern in DOI_ENDINGS:
        out = F.regexp_replace(out, pattern, "")
    return _full(out)


def find_doi(col):
    """The first DOI in a text, tidied."""
    return tidy_doi(_full(F.regexp_extract(col, DOI, 0)))


def find_pmid(col):
    return _full(F.regexp_extract(col, PMID, 1))


def find_pmcid(col):
    return _full(F.upper(F.regexp_extract(col, PMCID, 1)))


def find_arxiv(col):
    return _full(F.regexp_extract(col, ARXIV, 1))


def percent_decode(col):
    """Percent escapes decoded; a plus stays, and text with broken escapes is left as it is."""
    return F.coalesce(F.try_url_decode(F.regexp_replace(col, r"\+", "%2B")), col)


def doi_of_url(url):
    """The DOI hidden in a URL under up to four rounds of escapes (I4)."""
    out = url
    for _ in range(4):
        out = F.when(F.instr(out, "%") > 0, percent_decode(out)).otherwise(out)
    found = find_doi(out)
    slug = F.regexp_replace(F.regexp_extract(out, r"(?i)^[^:]+://[^/?#]*nature\.com[^?#]*?/articles/([A-Za-z0-9.-]+)", 1), r"(?i)(_reference)?\.pdf$", "")
    return F.coalesce(found, F.when(slug != "", tidy_doi(F.concat(F.lit("10.1038/"), slug))))


def host(url):
    """The host of a URL in lower case, null if there is none."""
    return _full(F.lower(F.regexp_extract(url, URI, 2)))


def unwrapped(url, wrapper: str = r"(?i)^[^:/?#]+://scholar\.[^/?#]*/scholar_url\?"):
    """The target of a redirecting link, decoded; null for other links."""
    target = F.regexp_extract(url, r"[?&]url=([^&#]*)", 1)
    return F.when(url.rlike(wrapper) & (target != ""), percent_decode(percent_decode(target)))


def canonical_url(url):
    """A URL with scheme and host in lower case, without fragment; redirecting links give their target."""
    part = lambda i: F.regexp_extract(url, URI, i)
    scheme = F.coalesce(_full(F.lower(part(1))), F.lit("https"))
    plain = F.concat(scheme, F.lit("://"), F.lower(part(2)), part(3), F.when((part(4) != "") & ~F.lower(part(2)).contains("scholar.google."), F.concat(F.lit("?"), part(4))).otherwise(""))
    return F.when(F.coalesce(url, F.lit("")) != "", F.coalesce(unwrapped(url), plain))


def candidate_id(mail_uid, index, title):
    """Id of a parsed candidate from its place and title."""
    key = F.concat_ws("|", F.coalesce(mail_uid, F.lit("")), index.cast("string"), F.coalesce(title, F.lit("")))
    return F.concat(F.lit("cand_"), F.substring(F.sha1(key), 1, 16))


def mail_uid_of(*parts):
    """Id of a mail from its non-empty parts."""
    full = F.filter(F.array(*parts), lambda x: F.coalesce(x, F.lit("")) != "")
    return F.concat(F.lit("local_"), F.sha1(F.array_join(full, "|")))


def token_jaccard(a, b):
    """Share of common words in all words of two texts; 0 if both are empty."""
    words = lambda c: F.array_distinct(F.filter(F.split(F.lower(F.coalesce(c, F.lit(""))), r"[^a-z0-9]+"), lambda x: x != ""))
    either = F.size(F.array_union(words(a), words(b)))
    return F.when(either > 0, F.size(F.array_intersect(words(a), words(b))) / either).otherwise(0.0)


def acquired_id(*parts):
    """Id of an acquired mail from its parts, of which empty ones keep their place."""
    return F.concat(F.lit("local163_"), F.sha1(F.concat_ws("|", *[F.coalesce(p, F.lit("")) for p in parts])))


def message_part(message_id):
    """What stands before the host in a message id."""
    return _full(F.regexp_extract(message_id, r"^<?\s*([^@<>\s]+)@", 1))


def last_number(text):
    """The last run of digits of a text."""
    return _full(F.regexp_extract(text, r"([0-9]+)(?:[^0-9]*)$", 1))


def subject_key(subject):
    """A subject without white space in lower case; empty for null (X11)."""
    return F.lower(F.regexp_replace(F.coalesce(subject, F.lit("")), r"\s+", ""))


def dates_agree(a, b):
    """Whether two date texts are the same or one holds the other; a blank agrees with all (X11)."""
    return (a == "") | (b == "") | a.contains(b) | b.contains(a)


def request_url(base, **params):
    """A URL with encoded parameters; null and blank ones are left out."""
    given = [F.when(F.coalesce(F.trim(v), F.lit("")) != "", F.concat(F.lit(f"{k}="), F.url_encode(F.trim(v)))) for k, v in params.items()]
    return F.concat(base, F.lit("?"), F.concat_ws("&", *given))
