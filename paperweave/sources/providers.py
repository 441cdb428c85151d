"""Provider payloads as rows of one common record, and recorded responses as a source (op ids S10, S11)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import inverted_text

_CROSSREF = "struct<title:array<string>,author:array<struct<given:string,family:string>>,`container-title`:array<string>,`published-print`:struct<`date-parts`:array<array<int>>>,`published-online`:struct<`date-parts`:array<array<int>>>,published:struct<`date-parts`:array<array<int>>>,issued:struct<`date-parts`:array<array<int>>>,DOI:string,URL:string,type:string,abstract:string>"
_OPENALEX = "struct<id:string,display_name:string,publication_year:int,type:string,ids:struct<doi:string,pmid:string,pmcid:string>,authorships:array<struct<author:struct<display_name:string>>>,primary_location:struct<source:struct<display_name:string,type:string>,landing_page_url:string,raw_type:string>,abstract_inverted_index:map<string,array<int>>>"
_SCHOLAR = "struct<paperId:string,title:string,authors:array<struct<name:string>>,venue:string,year:int,externalIds:struct<DOI:string,PubMed:string,PubMedCentral:string>,url:string>"
_EUROPEPMC = "struct<id:string,source:string,title:string,authorString:string,journalTitle:string,pubYear:string,doi:string,pmid:string,pmcid:string,abstractText:string,pubType:string>"
_UNPAYWALL = "struct<doi:string,is_oa:boolean,oa_status:string,best_oa_location:struct<url:string,host_type:string,version:string,license:string>,title:string,year:int,genre:string,journal_name:string>"

COMMON = ["external_id", "title", "authors", "abstract", "venue", "year", "publication_type", "doi", "pmid", "pmcid", "url"]


def _full(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def _last_part(c: Column) -> Column:
    return _full(F.regexp_extract(c, r"([^/]+)/?$", 1))


def _bare_doi(c: Column) -> Column:
    return _full(F.regexp_replace(c, r"(?i)^https?://(dx\.)?doi\.org/", ""))


def _record(**fields: Column) -> Column:
    return F.struct(*[(fields[c] if c in fields else F.lit(None).cast("array<string>" if c == "authors" else "string")).alias(c) for c in COMMON])


def crossref(body: Column) -> Column:
    """The first item of a response, or the item itself, as a common record."""
    x = F.from_json(F.coalesce(F.get_json_object(body, "$.message.items[0]"), F.get_json_object(body, "$.message"), body), _CROSSREF)
    year = F.coalesce(*[F.try_element_at(F.try_element_at(x[k]["date-parts"], F.lit(1)), F.lit(1)) for k in ("published-print", "published-online", "published", "issued")])
    names = F.filter(F.transform(x["author"], lambda a: F.trim(F.concat_ws(" ", a["given"], a["family"]))), lambda n: n != "")
    return _record(external_id=x["DOI"], title=F.try_element_at(x["title"], F.lit(1)), authors=names, abstract=x["abstract"], venue=F.try_element_at(x["container-title"], F.lit(1)), year=year.cast("string"), publication_type=x["type"], doi=x["DOI"], url=x["URL"])


def openalex_items(body: Column) -> Column:
    """All works of a response as an array of common records; a single work gives one."""
    items = F.coalesce(F.from_json(F.get_json_object(body, "$.results"), f"array<{_OPENALEX}>"), F.array(F.from_json(body, _OPENALEX)))

    def one(w: Column) -> Column:
        return _record(external_id=w["id"], title=w["display_name"], authors=F.filter(F.transform(w["authorships"], lambda a: a["author"]["display_name"]), lambda n: n.isNotNull()), abstract=inverted_text(w["abstract_inverted_index"]), venue=w["primary_location"]["source"]["display_name"], year=w["publication_year"].cast("string"), publication_type=w["type"], doi=_bare_doi(w["ids"]["doi"]), pmid=_last_part(w["ids"]["pmid"]), pmcid=_last_part(w["ids"]["pmcid"]), url=w["primary_location"]["landing_page_url"])

    return F.transform(items, one)


def openalex(body: Column) -> Column:
    return F.try_element_at(openalex_items(body), F.lit(1))


def semanticscholar(body: Column) -> Column:
    x = F.from_json(F.coalesce(F.get_json_object(body, "$.data[0]"), body), _SCHOLAR)
    return _record(external_id=x["paperId"], title=x["title"], authors=F.transform(x["authors"], lambda a: a["name"]), venue=_full(x["venue"]), year=x["year"].cast("string"), doi=x["externalIds"]["DOI"], pmid=x["externalIds"]["PubMed"], pmcid=x["externalIds"]["PubMedCentral"], url=x["url"])


def europepmc(body: Column) -> Column:
    x = F.from_json(F.coalesce(F.get_json_object(body, "$.resultList.result[0]"), body), _EUROPEPMC)
    names = F.filter(F.transform(F.split(F.regexp_replace(x["authorString"], r"\.$", ""), ","), lambda n: F.trim(n)), lambda n: n != "")
    return _record(external_id=x["id"], title=x["title"], authors=names, abstract=x["abstractText"], venue=x["journalTitle"], year=x["pubYear"], publication_type=x["pubType"], doi=x["doi"], pmid=F.coalesce(x["pmid"], F.when(x["source"] == "MED", x["id"])), pmcid=x["pmcid"])


def unpaywall(body: Column) -> Column:
    x = F.from_json(body, _UNPAYWALL)
    return _record(external_id=x["doi"], title=x["title"], venue=x["journal_name"], year=x["year"].cast("string"), publication_type=x["genre"], doi=x["doi"], url=x["best_oa_location"]["url"])


def open_access(body: Column) -> Column:
    """Struct (is_oa, oa_status, url, host_type, version, license) of an open-access response."""
    x = F.from_json(body, _UNPAYWALL)
    best = x["best_oa_location"]
    return F.struct(F.coalesce(x["is_oa"], F.lit(False)).alias("is_oa"), x["oa_status"].alias("oa_status"), *[best[c].alias(c) for c in ("url", "host_type", "version", "license")])


def _xpath(body: Column, path: str) -> Column:
    return _full(F.xpath_string(body, F.lit(path)))


def pubmed(body: Column) -> Column:
    path = "/PubmedArticleSet/PubmedArticle[1]"
    parts = F.xpath(body, F.lit(f"{path}//AbstractText/text()"))
    last, first = F.xpath(body, F.lit(f"{path}//Author/LastName/text()")), F.xpath(body, F.lit(f"{path}//Author/ForeName/text()"))
    return _record(external_id=_xpath(body, f"{path}//PMID"), title=_xpath(body, f"{path}//ArticleTitle"), authors=F.zip_with(first, last, lambda a, b: F.concat_ws(" ", a, b)), abstract=_full(F.array_join(parts, " ")), venue=_xpath(body, f"{path}//Journal/Title"), year=_xpath(body, f"{path}//PubDate/Year"), doi=_xpath(body, f"{path}//ArticleId[@IdType='doi']"), pmid=_xpath(body, f"{path}//PMID"), pmcid=_xpath(body, f"{path}//ArticleId[@IdType='pmc']"))


def arxiv(body: Column) -> Column:
    """The first entry of an Atom feed; the feed's default namespace is dropped first."""
    xml = F.regexp_replace(body, r' xmlns(:\w+)?="[^"]*"', "")
    bare = F.regexp_replace(xml, r"(</?)\w+:(\w)", "$1$2")
    return _record(external_id=_xpath(bare, "/feed/entry[1]/id"), title=_full(F.regexp_replace(_xpath(bare, "/feed/entry[1]/title"), r"\s+", " ")), authors=F.xpath(bare, F.lit("/feed/entry[1]/author/name/text()")), abstract=_full(F.regexp_replace(_xpath(bare, "/feed/entry[1]/summary"), r"\s+", " ")), year=F.substring(_xpath(bare, "/feed/entry[1]/published"), 1, 4), doi=_xpath(bare, "/feed/entry[1]/doi"), url=_xpath(bare, "/feed/entry[1]/id"))


READERS = {"crossref": crossref, "openalex": openalex, "semanticscholar": semanticscholar, "europepmc": europepmc, "pubmed": pubmed, "arxiv": arxiv, "unpaywall": unpaywall}


def parse_responses(responses: DataFrame) -> DataFrame:
    """(…, record) for (provider, body_text, …): each body read by its provider's reader; others give null.

    Broken bodies give a record of nulls.
    """
    looks_xml = F.col("body_text").rlike(r"^\s*<")
    record = F.lit(None)
    for name, reader in READERS.items():
        body = F.when((F.col("provider") == name) & (looks_xml if name in ("pubmed", "arxiv") else ~looks_xml), F.col("body_text"))
        record = F.when(F.col("provider") == name, reader(body)) if name == "crossref" else record.when(F.col("provider") == name, reader(body))
    return responses.withColumn("record", record)


def replay(requests: DataFrame, recorded: DataFrame) -> DataFrame:
    """Requests (provider, url, ord) with the recorded responses in turn.

    The n-th request of a URL gets the n-th recording, later ones the last; a request without any recording
    gets nulls and ``missing`` true. recorded has (provider, url, ordinal, body_text, status_code), ordinal
    from 1.
    """
    turn = F.row_number().over(Window.partitionBy("provider", "url").orderBy("ord"))
    last = recorded.groupBy("provider", "url").agg(F.max("ordinal").alias("last"))
    asked = requests.withColumn("turn", turn).join(last, ["provider", "url"], "left").withColumn("ordinal", F.when(F.col("last").isNotNull(), F.least("turn", "last"))).drop("turn", "last")
    out = asked.join(recorded, ["provider", "url", "ordinal"], "left")
    return out.withColumn("missing", F.col("ordinal").isNull())
