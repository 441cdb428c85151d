import json

from paperweave.sources import providers

BODIES = [
    ("crossref", json.dumps({"message": {"items": [{"title": ["T"], "author": [{"given": "A", "family": "B"}, {"family": "C"}], "container-title": ["J"], "issued": {"date-parts": [[2021, 3]]}, "DOI": "10.1/x", "URL": "u", "type": "article"}]}})),
    ("openalex", json.dumps({"results": [{"id": "W1", "display_name": "T", "publication_year": 2021, "type": "article", "ids": {"doi": "https://doi.org/10.1/x", "pmid": "https://pubmed/12345"}, "authorships": [{"author": {"display_name": "A B"}}], "primary_location": {"source": None}, "abstract_inverted_index": {"world": [1], "Hello": [0]}}]})),
    ("semanticscholar", json.dumps({"data": [{"paperId": "p", "title": "T", "authors": [{"name": "A B"}], "venue": "", "year": 2021, "externalIds": {"DOI": "10.1/x", "PubMed": "12345"}}]})),
    ("europepmc", json.dumps({"resultList": {"result": [{"id": "12345", "source": "MED", "title": "T", "authorString": "B A, C D.", "journalTitle": "J", "pubYear": "2021"}]}})),
    ("pubmed", "<PubmedArticleSet><PubmedArticle><PMID>12345</PMID><ArticleTitle>T</ArticleTitle><AbstractText>x</AbstractText><AbstractText>y</AbstractText><Author><LastName>B</LastName><ForeName>A</ForeName></Author><Journal><Title>J</Title><PubDate><Year>2021</Year></PubDate></Journal><ArticleId IdType='doi'>10.1/x</ArticleId></PubmedArticle></PubmedArticleSet>"),
    ("arxiv", '<feed xmlns="http://www.w3.org/2005/Atom" xmlns:arxiv="http://arxiv.org/schemas/atom"><entry><id>http://arxiv.org/abs/1</id><title>T</title><summary>s</summary><published>2021-01-01</published><author><name>A B</name></author><arxiv:doi>10.1/x</arxiv:doi></entry></feed>'),
    ("unpaywall", json.dumps({"doi": "10.1/x", "is_oa": True, "oa_status": "gold", "best_oa_location": {"url": "u"}, "title": "T", "year": 2021})),
    ("crossref", "{broken"),
    ("other", "{}"),
    ("openalex", None),
]


def test_payloads(spark):
    df = spark.createDataFrame([(i, p, b) for i, (p, b) in enumerate(BODIES)], "i int, provider string, body_text string")
    got = {r.i: r.record for r in providers.parse_responses(df).collect()}
    assert all(got[i].title == "T" and got[i].year == "2021" for i in range(7))
    assert [got[i].doi for i in (0, 1, 2, 4, 5, 6)] == ["10.1/x"] * 6
    assert got[0].authors == ["A B", "C"] and got[1].abstract == "Hello world" and got[1].venue is None and got[1].pmid == "12345"
    assert got[3].pmid == "12345" and got[3].authors == ["B A", "C D"] and got[4].abstract == "x y" and got[4].authors == ["A B"] and got[5].authors == ["A B"]
    assert got[8] is None and got[7].title is None and got[9].title is None


def test_replay(spark):
    asked = spark.createDataFrame([("p", "u", 1), ("p", "u", 2), ("p", "u", 3), ("p", "v", 4)], "provider string, url string, ord int")
    seen = spark.createDataFrame([("p", "u", 1, "a", 200), ("p", "u", 2, "b", 429)], "provider string, url string, ordinal int, body_text string, status_code int")
    got = [(r.ord, r.body_text, r.missing) for r in providers.replay(asked, seen).orderBy("ord").collect()]
    assert got == [(1, "a", False), (2, "b", False), (3, "b", False), (4, None, True)]
