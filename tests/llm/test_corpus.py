import numpy as np
import pytest

from paperweave.llm import bpe, mixture, quality

DOCS = "doc_id long, text string, source string, extra int"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_ids_equal_the_tokenizer(spark, data):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(bpe.VOCABULARY)
    t.encode_special_tokens = True
    texts = [None, "", " ", "\n\n a", "aaaaaaaaaaaaaaaaaaaaa aaaa", "don't we'll 12345 x²", "naïve Β-amyloid　日本語🎉", "<|endoftext|> is text", "a\u0085b c\x1cd", "x" * 5000 + " " * 300 + "\t\r\n!!!??"]
    docs = spark.createDataFrame([(i, x, "s", 0) for i, x in enumerate(texts)], DOCS).unionByName(spark.read.parquet(f"{data}/documents.parquet").selectExpr("doc_id + 1000 as doc_id", "text", "source", "0 as extra"))
    got = {r.doc_id: r.ids for r in bpe.encode_documents(docs).collect()}
    want = {r.doc_id: t.encode(r.text or "", add_special_tokens=False).ids for r in docs.collect()}
    assert got == want
    assert rows(bpe.encode_documents(docs.limit(0))) == []


def test_split_tree_adds_up():
    counts = np.array([100, 7, 0, 33])
    per = mixture.split_tree(counts, 6, np.random.default_rng(1))
    assert (per.sum(0) == counts).all() and per.sum(1).max() - per.sum(1).min() <= 1


def test_mix_reaches_the_shares(spark):
    docs = spark.createDataFrame([(i, f"some words {i} " * (1 + i % 9), ["a", "a", "a", "b", "c", None][i % 6], 0) for i in range(1200)] + [(9001, None, "a", 0), (9002, "", "b", 0)], DOCS)
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.4, 3), ("c", 0.1, 2), ("missing", 0.0, 1)], "source string, target_share double, max_repeats int")
    got = {r.source: r for r in mixture.shares(docs, targets).collect()}
    for s, share, most in (("a", 0.5, 1), ("b", 0.4, 3), ("c", 0.1, 2)):
        assert abs(got[s].actual_share - share) < 0.01 and got[s].most_uses <= most
    assert got["missing"].n_tokens == 0
    mixed = mixture.mix(docs, targets, shard_tokens=2000)
    assert mixed.select("shard").distinct().count() > 1
    assert mixed.groupBy("doc_id", "copy").count().where("count > 1").count() == 0
    assert rows(mixture.mix(docs.limit(0), targets)) == [] == rows(mixture.mix(docs, targets.limit(0)))


PROSE = "The model was trained on many images and tested in a hospital. We found that it was better than the other one, and this did not depend on the scanner. "


@pytest.mark.parametrize(
    ("text", "kind"),
    [
        (PROSE, "prose"),
        (PROSE.upper(), "prose"),
        ("<p>" + PROSE + "</p>", "prose"),
        (PROSE.replace(" ", "\n", 3), "prose"),
        ("本研究在30家医院进行，共纳入940名患者。结果显示，治疗组的指标明显改善。", "prose"),
        ("- one thing\n- another thing\n- a third thing\n- the last", "list"),
        ("1) I Punisiko\n2) P Tabadakal\n3) H Goduskevin\n4) A Remasenon", "list"),
        ("aged mice; type 2 diabetes; endurance athletes; community-dwelling women; treatment response", "list"),
        ("date\tcount\tsite\n3908\tno\tyes\n3673\tNA\tno\n1\t2\t3", "table"),
        ("| n | score |\n| --- | --- |\n| 1 | 2 |\n| 3 | 4 |", "table"),
        ("<table><tr><td>status</td><td>site</td></tr><tr><td>3.5</td><td>seven</td></tr></table>", "table"),
        ("a,b,c\n1,2,3\n4,5,6\n7,8,9", "table"),
        ("loading " * 100, "junk"),
        ("dgckrn pmxhylrdf gqbmf ypkr myjgrvvml zt qctpyxkkgjx ngcgvt hvrg", "junk"),
        ("T h e  m o d e l  w a s  t r a i n e d  o n  m a n y  i m a g e s", "junk"),
        ("=" * 400, "junk"),
    ],
)
def test_classes(spark, text, kind):
    base = [(i, PROSE * (1 + i % 4), "s", 0) for i in range(40)]
    docs = spark.createDataFrame([*base, (99, text, "s", 0)], DOCS)
    assert {r.doc_id: r.text_class for r in quality.outliers(docs).collect()}[99] == kind


def test_statistics_of_odd_inputs(spark):
    docs = spark.createDataFrame([(1, None, "s", 0), (2, "", "s", 0), (3, " \n", "s", 0), (4, "word " * 50_000, "s", 0), (4, "word", "s", 0)], DOCS)
    got = quality.statistics(docs).collect()
    assert sorted((r.doc_id, r.language is None) for r in got) == [(1, True), (2, True), (3, True), (4, False), (4, False)]
    assert {r.doc_id for r in quality.not_prose(docs).collect()} <= {4}
    assert rows(quality.not_prose(docs.limit(0))) == []


def test_contributions_add_up(spark, data):
    got = quality.outliers(spark.read.parquet(f"{data}/documents.parquet")).collect()
    for r in got[:50]:
        assert abs(sum(r[f"from_{s}"] for s in quality.STATS) - r.d2) < 1e-3 * max(1, r.d2)
