import cProfile
import pstats
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from paperweave.llm import entity_match, format_copies, grid_components, history, name_variants, papers, survivor


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


# ---- groups
def test_grid_components_equal_brute_force(spark):
    rng = random.Random(1)
    edges = [(f"p{i:03}", f"p{i + 1:03}") for i in range(60)] + [("hub", f"h{i}") for i in range(40)] + [(f"r{rng.randrange(50):02}", f"r{rng.randrange(50):02}") for _ in range(30)]
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        if a != b:
            up[find(a)] = find(b)
    groups = {}
    for x in up:
        groups.setdefault(find(x), []).append(x)
    want = sorted((x, min(g)) for g in groups.values() for x in g)
    df = spark.createDataFrame([*edges, (None, "x"), ("y", "y")], "u string, v string")
    assert rows(grid_components.grid_components(df, cell_edges=10)) == want
    assert rows(grid_components.grid_components(df.limit(0))) == []


def test_candidate_groups(spark):
    pre = spark.createDataFrame([("c1", "P"), ("c2", "P"), ("c2", "P"), ("c3", None), ("c9", " "), (None, "P"), ("c8", "Q")], "candidate_id string, paper_id string")
    st = spark.createDataFrame([("c4", "clustered", "c2"), ("c5", "rejected", "c2"), ("c6", "clustered", None), ("c7", "clustered", "c7")], "candidate_id string, status string, leader_candidate_id string")
    rv = spark.createDataFrame([("c0", '{"verdict": "same", "compared_with": "c4"}'), ("c5", '{"verdict":"different","compared_with":"c1"}'), ("c6", '{"verdict":"same","compared_with":null}'), ("c7", "{broken"), ("c7", None)], "candidate_id string, assessment_json string")
    got = grid_components.candidate_groups(pre, st, rv)
    assert rows(got) == [("c0", "c0"), ("c1", "c0"), ("c2", "c0"), ("c4", "c0")]
    audit = spark.createDataFrame([("c1", "P", None), ("c5", None, 3), (None, None, 1)], "candidate_id string, paper_id string, duplicate_group_size int")
    assert rows(grid_components.group_sizes(got, audit).select("candidate_id", "group_size")) == [("c1", 4), ("c5", 1), (None, None)]


# ---- surviving values
SOURCE = "candidate_id string, id long, source_name string, matched boolean, doi string, venue string, abstract string, created_at timestamp_ntz, n int"


def test_surviving_fields(spark):
    import datetime as dt

    at = lambda d: dt.datetime(2025, 1, d)
    df = spark.createDataFrame(
        [
            ("a", 1, "arxiv", True, "10.99190/pre.1v1", "Letters in X", "One two three. Four", at(1), 0),
            ("a", 2, "pubmed", True, "DOI: 10.99100/x.2", "LETTERS IN X.", "One two three. Four five six.", at(2), 0),
            ("a", 3, "openalex", True, "10.99190%2Fpre.1v1", "-", None, at(1), 0),
            ("a", 4, "arxiv", True, "https://doi.example/", "N/A", "One two…", at(1), 0),
            ("b", 5, "pubmed", True, "10.99100/y", None, None, at(1), 0),
            ("c", 6, "pubmed", True, "10.99100/z", "V", "No abstract", at(1), 0),
            ("c", 7, None, True, "10.99100/Z", "v", "", at(1), 0),
            ("c", 8, "crossref", False, "10.99100/other", "W", "t", at(9), 0),
        ],
        SOURCE,
    )
    trust = spark.createDataFrame([("pubmed", 1), ("crossref", 2), ("openalex", 4), ("arxiv", 6)], "source_name string, trust_rank int")
    assert rows(survivor.surviving_fields(df, trust)) == [("a", "abstract", 2), ("a", "doi", 2), ("a", "venue", 1)]
    assert rows(survivor.surviving_fields(df.limit(0), trust)) == [] == rows(survivor.surviving_fields(df.where("id = 5"), trust))
    assert rows(survivor.surviving_records(df, trust).where("candidate_id = 'a'").select("doi")) == [("DOI: 10.99100/x.2",)]


# ---- copies
def test_copies(spark):
    c = spark.createDataFrame([(1, "A-b c", "X Y, Z", 0), (2, "ab_C!", "z , x y", 0), (3, "A-b c", "X Y", 0), (4, "ＡＢ​c", None, 0), (5, "a b c", " ", 0), (6, None, "q", 0), (7, " ", "q", 0), (8, "…", "q", 0), (9, "é", None, 0), (10, "é", "", 0), (11, "e", None, 0), (12, "abc", "x y,z,…", 0)], "id long, raw_title string, raw_authors string, extra int")
    s = spark.createDataFrame([(1, "p", "doi:10.1234/A."), (2, "p", "10.1234/a"), (3, "q", "10.1234/a"), (4, "p", "10."), (5, "p", None), (6, None, "10.1234/a"), (7, "p", "10.1234/a ")], "id long, source_name string, doi string")
    want = [("paper_candidate", 1, 2), ("paper_candidate", 1, 12), ("paper_candidate", 4, 5), ("paper_candidate", 9, 10), ("source_record", 1, 2), ("source_record", 1, 7)]
    assert rows(format_copies.all_copies(c, s)) == sorted(want, key=str)
    assert rows(format_copies.all_copies(c.limit(0), s.limit(0))) == []
    assert rows(format_copies.collapsed(c, s).where("n_copies > 1")) == [("paper_candidate", 1, 3), ("paper_candidate", 4, 2), ("paper_candidate", 9, 2), ("source_record", 1, 3)]
    assert format_copies.collapsed(c, s).count() == 12 - 4 + 7 - 2


# ---- papers
@pytest.mark.parametrize(
    ("a", "b", "same"),
    [
        ("Can shear-wave elastography improve triage of sepsis?", "[PDF] Can shear wave elastogrphy improve triage triage of sepsis", 2),
        ("Cell-free DNA profiling of hearts", "cell‐free deoxyribonucleic acid profiling of hearts", 3),
        ("Deep learning for the triage of sepsis in older adults", "Deep learning for the triage of …", 2),
        ("Effect of x on gait speed in older adults", "Effect of x on gait speed in aged mice", 0),
        ("Loss of β-amyloid aggravates sepsis in older adults", "Loss of beta-amyloid aggravates sepsis in older adults", 3),
        ("Treatment of hypertension in older adults", "Treatment of hypotension in older adults", 0),
        ("Outcomes of hyperthyroidism in older women", "Outcomes of hypothyroidism in older women", 0),
        ("Levels of IL-6 in older women with sepsis", "Levels of IL-8 in older women with sepsis", 0),
        ("Severity of asthma in children", "Severity of asthma in rural children", 1),
    ],
)
def test_same_title(a, b, same):
    (x, cut_x, _), (y, cut_y, _) = papers.title_form(a), papers.title_form(b)
    assert papers.same_title(x, y, cut_x, cut_y) == same


def test_usual_words_are_no_typing_errors():
    a, b = "prediction of gait sleep in older adults", "prediction of gait steep in older adults"
    counts = papers.Counts(np.zeros(papers.COUNT_CELLS + 1, np.int64), np.zeros(papers.COUNT_CELLS + 1, np.int64))
    assert papers.same_title(a, b, False, False, counts) == 2
    for w in ("sleep", "steep"):
        counts.titles[papers.cell(w)] = 5_000
    assert papers.same_title(a, b, False, False, counts) == 0


def test_a_missing_inner_word_needs_more_agreement():
    t1, t2 = (papers.title_form(t)[0] for t in ("Severity of asthma in children of school age", "Severity of asthma in rural children of school age"))
    same = lambda y2, v2, k2: papers.same_paper(t1, t2, False, False, "", "", ["adamor", "bedolin"], k2, 2020, y2, "journal of hearts", v2)
    assert same(2020, "journal of hearts", ["adamor", "bedolin"])
    assert not same(2020, "annals of lungs", ["adamor", "bedolin"]) and not same(2024, "", ["adamor", "bedolin"]) and not same(2020, "", ["adamor", "zemorin", "wesolat"])


@pytest.mark.parametrize("title", ["Outcomes after SARS-CoV-2", "Insulin in diabetes type 2", "Survival in WHO grade III", "Dyspnoea in NYHA class II", "A new cohort profile of rural mice", "Re-irradiation of rural mice", "Effects of angiotensin II blockade"])
def test_numbers_and_words_that_count_no_parts(title):
    assert papers.title_form(title)[2] == ""


def test_masks_never_reject_titles_that_share_half_their_words(spark):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(40)]
    titles = [" ".join(rng.sample(vocabulary, rng.randrange(1, 30))) for _ in range(60)]
    m = papers.masks(titles, [[]] * 60)
    made = [(*[m[c][i] for c in papers.MASKS], *[m[c][j] for c in papers.MASKS], 2 * len(set(titles[i].split()) & set(titles[j].split())) >= min(m["n_words"][i], m["n_words"][j]) - 1) for i in range(60) for j in range(60)]
    df = spark.createDataFrame(made, ", ".join(f"{c}{i} long" for i in (1, 2) for c in papers.MASKS) + ", share boolean")
    assert df.where("share").where(~papers.alike_words()).count() == 0
    assert df.where("not share").where(~papers.alike_words()).count() > 0


def test_markers_tell_papers_apart():
    for t in ("A study of hearts in rural mice: part II", "A study of hearts in rural mice, a second cohort", "Erratum: A study of hearts in rural mice", "A study of hearts in rural mice - II. Extended follow-up"):
        assert papers.title_form(t)[2]
    assert not papers.title_form("A multicentre cohort study of hearts")[2]
    assert papers.title_form(None) == ("", False, "") == papers.title_form("")


CANDIDATE = "id long, candidate_id string, raw_title string, raw_authors string, year_guess string, venue_guess string, extra int"


def candidates(spark):
    return spark.createDataFrame(
        [
            (1, "c1", "Deep learning for triage of septic shock in rural mice", "T Fizonorad, Ana Gokatonen", "2021", "Journal of Hearts", 0),
            (2, "c2", "Deep learnnig for triage of septic shock in rural mice", "Thomas Fizonorad, A Gokatonen", None, None, 0),
            (3, "c3", "Erratum", "P Zemorin", "2020", None, 0),
            (4, "c4", None, "P Zemorin", "2020", None, 0),
            (5, None, "Deep learning for triage of septic shock in rural mice", None, None, None, 0),
            (6, "c6", "A quite different paper about renal outcomes after sepsis", None, "2020", "Journal of Kidneys", 0),
        ],
        CANDIDATE,
    )


def test_entity_matching(spark):
    dump = spark.createDataFrame([(10, "DEEP LEARNING FOR TRIAGE OF SEPTIC SHOCK IN RURAL MICE.", '["Fizonorad, Thomas", "Ana Gokatonen"]', "2021", "J. Hearts"), (11, "Erratum", '["Q Other"]', "2020", None), (12, "erratum", '["P Zemorin"]', None, None), (13, None, "broken", None, None), (14, "A quite different paper about renal outcomes after sepsis", None, "2020", "Journal of Kidneys"), (15, "Deep learning for triage of septic shock in rural mice: part II", '["Thomas Fizonorad", "Ana Gokatonen"]', "2021", "J. Hearts")], "record_id long, title string, authors_json string, year string, venue string")
    c = candidates(spark)
    got = entity_match.match(c.unionByName(c), dump)
    assert rows(got.select("candidate_id", "record_id")) == [("c1", 10), ("c2", 10), ("c3", 12), ("c6", 14)]
    assert all(0 <= r.confidence <= 1 for r in got.collect())
    assert rows(entity_match.match(c.limit(0), dump)) == [] == rows(entity_match.match(c, dump.limit(0)))


def _form_rows(spark, made):
    """(rid, words, keys, blocks) as forms with masks."""
    masks = papers.masks([m[1] for m in made], [m[2] for m in made])
    return spark.createDataFrame([(m[0], m[1], m[2], "", m[3], *[masks[c][i] for c in papers.MASKS]) for i, m in enumerate(made)], "rid long, words string, keys array<string>, marker string, blocks array<long>, low long, high long, n_words int, ends long")


def test_hot_blocks_lose_no_pair(spark, monkeypatch):
    from paperweave.operators.durable import Scratch

    rng = random.Random(8)
    words = [f"term{i}" for i in range(12)]
    names = ["fizonorad", "gokatonen", "zemorin"]
    make = lambda start: [(start + i, " ".join(rng.sample(words, 6)), rng.sample(names, rng.randrange(3)), [entity_match.NAMED | 7, 9]) for i in range(40)]
    left, right = make(0), make(100)
    for rows_ in (left, right):
        for i, r in enumerate(rows_):  # rows without the name don't have its block
            if not r[2]:
                rows_[i] = (*r[:3], [9])
    want = rows(entity_match.block_pairs(_form_rows(spark, left), _form_rows(spark, right), Scratch(spark, "cool")))
    monkeypatch.setattr(entity_match, "HOT_BLOCK", 5)
    got = rows(entity_match.block_pairs(_form_rows(spark, left), _form_rows(spark, right), Scratch(spark, "hot")))
    # of a title's block the split parts keep pairs whose names share a beginning or an end, or are missing
    shared = {(a[0], b[0]) for a in left for b in right if not a[2] or not b[2] or set(a[2]) & set(b[2])}
    assert set(got) >= set(want) & shared and set(got) <= set(want)


def test_vectors_put_equal_word_sets_together():
    words = [f"word{i} shared other{i % 7}".split() for i in range(50)]
    vectors, counts = entity_match.train(words)
    index = entity_match.Index(vectors, counts, 50, 12)
    signature, blocks = index.describe(["alpha beta gamma delta epsilon", "epsilon delta gamma beta alpha alpha", "quite another title about mice"], [["fizo"], ["fizo"], ["nobody"]])
    assert signature[0] == signature[1] and sorted(blocks[0])[:entity_match.TABLES] == sorted(blocks[1])[:entity_match.TABLES] and blocks[0][0] == blocks[1][0]
    assert bin((int(signature[0]) ^ int(signature[2])) & (2**64 - 1)).count("1") > 8
    assert entity_match.train([])[0].shape == vectors.shape


def test_calibration_rises():
    x = np.concatenate([np.linspace(0, 0.6, 50), np.linspace(0.5, 1, 50)])
    slope, offset = entity_match.calibrate(x, np.repeat([0.0, 1.0], 50))
    assert slope > 0 and 1 / (1 + np.exp(-(slope + offset))) > 0.8


def test_new_batches(spark):
    batch = spark.createDataFrame([(1, "n1", "Deep learning for triage of septic shock in ruralmice", "T. Fizonorad, A. Gokatonen", "2021", None, 0), (2, "n2", "A brand new paper about imaging of kidneys", "P Zemorin", "2020", None, 0), (3, "n3", "a brand new papper about imaging of kidneys", "Zemorin P", "2020", None, 0), (4, "n4", "A brand new paper about imaging of kidneys", "P Zemorin", "2020", None, 0), (5, "n5", None, "P Zemorin", None, None, 0), (6, "n6", "Deep learning for triage of septic shock in rural mice, a second cohort", "T Fizonorad, Ana Gokatonen", "2022", None, 0)], CANDIDATE).withColumn("batch_no", F.when(F.col("id") > 2, 2).otherwise(1))
    assert rows(history.repeated_rows(candidates(spark), batch)) == [(1,), (3,), (4,)]
    assert rows(history.repeated_rows(candidates(spark).limit(0), batch)) == [(3,), (4,)]
    assert rows(history.repeated_rows(candidates(spark), batch.limit(0))) == []


def test_winnowing_keeps_a_run_of_every_window():
    rng = random.Random(2)
    common = "".join(rng.choice("abcdefghij") for _ in range(history.RUN + history.WINDOW - 1))
    for _ in range(50):
        a, b = ("".join(rng.choice("klmnop") for _ in range(rng.randrange(30))) + common + "".join(rng.choice("klmnop") for _ in range(rng.randrange(30))) for _ in range(2))
        assert set(history.winnow(a)) & set(history.winnow(b))
    assert len(history.winnow("ab")) == 1 and len(history.winnow("".join(rng.choice("abcdefghij") for _ in range(600)))) > 20


def test_fingerprints_meet_by_any_name_and_by_the_venue():
    title, names = "deep learning for triage of septic shock in rural mice", "fizonorad gokatonen zemorin kelenor tamatere vekesired bremeskino zunadored".split()
    stored = set(history.fingerprints(title, names, "journal of hearts"))
    for n in names:
        assert len(stored & set(history.fingerprints(title, [n], ""))) > 1
    for other in ([], ["fizonrad", "gokatnen"]):
        assert stored & set(history.fingerprints("deep learning for triage of septic shock in rurl mice", other, "j hearts"))
        assert stored & set(history.fingerprints(title, other, ""))


def test_altered_title_with_misspelt_names_repeats(spark):
    batch = spark.createDataFrame([(1, "n1", "Deep learning for triage of septic shock in rurl mice", "T Fizonrad, Ana Gokatnen", "2021", "Journal of Hearts", 0), (2, "n2", "Deep learning for triage of septic shock in rurl mice", None, "2021", "Journal of Hearts", 0)], CANDIDATE).withColumn("batch_no", F.lit(None).cast("int"))
    assert rows(history.repeated_rows(candidates(spark), batch)) == [(1,), (2,)]


def test_a_kept_store_is_opened_and_takes_in_what_a_batch_brought(spark, tmp_path):
    schema = "id long, raw_title string, raw_authors string, year_guess string, venue_guess string"
    c = spark.createDataFrame([(1 << 41, "Deep learning for triage of septic shock", "T Fizonorad", "2021", None)], schema)
    new = spark.createDataFrame([(9, "A brand new paper about imaging of kidneys", "P Zemorin", "2020", None)], schema)
    again = spark.createDataFrame([(20, "A brand-new paper about imaging of kidneys", "Zemorin P", "2020", None), (21, "Deep learning for triage of septic shock", "T Fizonorad", "2021", None)], schema)
    history.open_history(c, str(tmp_path / "store"))
    assert rows(history.accept_batch(history.Store.open(spark, str(tmp_path / "store")), new)) == []
    store = history.Store.open(spark, str(tmp_path / "store"))  # nothing but the folder links the batches
    assert store.generations == 2 and rows(history.accept_batch(store, again)) == [(20,), (21,)]


def test_filters_exclude_what_no_generation_holds(spark):
    fp = spark.createDataFrame([(i % 3, i * 7919 * 2654435761) for i in range(300)], "part int, fp long")
    filters = history.build_filters(fp.where("part < 2"), 3, 200)
    asked = fp.withColumn("rid", F.lit(1).cast("long"))
    passed = history.prescreen(asked, filters).groupBy("part").count().collect()
    assert {r["part"]: r["count"] for r in passed} == {0: 100, 1: 100}


# ---- names
@pytest.mark.parametrize(
    ("name", "want"),
    [
        ("Fizonorad, T.K.", ("person", "fizonorad", "", "tk")),
        ("FIZONORAD Thomas", ("person", "fizonorad", "thomas", "t")),
        ("Fizonorad Tom", ("person", "fizonorad", "thomas", "t")),
        ("Bella K. Fizonorad", ("person", "fizonorad", "isabella", "ik")),
        ("TK FIZONORAD", ("person", "fizonorad", "", "tk")),
        ("the Vekesired Sleep Consort.", ("consortium", "vekesired", "", "")),
        ("Collaboration Bremeskino Heart", ("collaboration", "bremeskino", "", "")),
    ],
)
def test_names_are_read(name, want):
    assert name_variants.parse_name(name, frozenset(name_variants.NICKNAMES.values()), {}) == want


def test_variants(spark):
    t = "A long title about the hearts of mice"
    c = spark.createDataFrame([(1, t, "T Fizonorad, E Zunadored, Rel Heart Network"), (2, t, "Thomas  Fizonorad, Edward Zunadored, Rel Network"), (3, t, "T Fizonrad, …, "), (4, "Another title that nobody shares at all", "T Fizonorat"), (5, None, None), (6, t, "Elizabeth Zunadored"), (7, t, "T Fizonorad")], "id long, raw_title string, raw_authors string")
    r = spark.createDataFrame([(1, t, '["Fizonorad, T.", "T Fizonorad"]'), (2, t, "broken"), (3, None, None)], "id long, title string, authors_json string")
    d = r.limit(0)
    got = rows(name_variants.variant_pairs(c, r, d))
    names = {x for p in got for x in p}
    assert ("T Fizonorad", "Thomas Fizonorad") in got and ("T Fizonorad", "T Fizonrad") in got and ("Fizonorad, T.", "T Fizonorad") in got
    assert ("Rel Heart Network", "Rel Network") in got and "T Fizonorat" not in names and "…" not in names
    assert ("Edward Zunadored", "Elizabeth Zunadored") not in got
    assert all(a < b for a, b in got)
    assert rows(name_variants.variant_pairs(c.limit(0), r.limit(0), d)) == []


def test_variants_met_beyond_the_first_letters_of_a_title(spark):
    t = "A long title about the hearts of mice and the kidneys of men"
    c = spark.createDataFrame([(1, t, "T Fizonorad, E Zunadored, Ana Gokatonen"), (2, "A lnog title title about the hearts of mice and the kidneys of men", "T Fizonrad"), (3, None, "T Fizonorda, E Zunadored, Ana Gokatonen"), (4, "Something else entirely on sleep in rural stroke cohorts", "T Fizonerad, P Kelenor"), (5, t, "T Fizonorad, E Zunadored")], "id long, raw_title string, raw_authors string")
    none = spark.createDataFrame([], "id long, title string, authors_json string")
    got = rows(name_variants.variant_pairs(c, none, none))
    assert ("T Fizonorad", "T Fizonrad") in got and ("T Fizonorad", "T Fizonorda") in got
    assert "T Fizonerad" not in {x for p in got for x in p}


def test_a_much_more_frequent_name_outweighs_a_strange_context(spark):
    many = [(i, f"Paper {i} of rather many on quite {i} distinct matters", "T Fizonorad") for i in range(3000)]
    c = spark.createDataFrame([*many, (9001, "Something else entirely on sleep in rural stroke cohorts", "T Fizonrad")], "id long, raw_title string, raw_authors string")
    none = spark.createDataFrame([], "id long, title string, authors_json string")
    assert rows(name_variants.variant_pairs(c, none, none)) == [("T Fizonorad", "T Fizonrad")]


# ---- cost of forms and of pairs
def _calls(f):
    """Python and C calls that f makes, which is what a row costs whatever the machine."""
    seen = cProfile.Profile()
    seen.runcall(f)
    return pstats.Stats(seen).total_calls


def _made_names(rng, n):
    word = lambda: "".join(rng.choice("abcdeiklmnorstuv") for _ in range(8))
    return [", ".join(f"{word()} {word()}" for _ in range(3)) for _ in range(n)]


def test_blocks_of_new_words_are_made_together():
    rng = random.Random(7)
    vectors, counts = entity_match.train([["alpha", "beta", "gamma"], ["beta", "delta"]])
    index = entity_match.Index(vectors, counts, 50, 12)
    keys = [sorted(n.replace(",", "").split()) for n in _made_names(rng, 2_000)]
    titles = [" ".join(rng.sample("deep learning for triage of septic shock in rural mice".split(), 8)) for _ in keys]
    together = []
    assert _calls(lambda: together.append(index.describe(titles, keys))) < 40 * len(keys)
    # a name's code doesn't depend on what else is in the batch
    alone = entity_match.Index(vectors, counts, 50, 12)
    for i in range(20):
        name_codes = lambda blocks: {b for b in blocks if b & entity_match.NAMED and not b & entity_match.LETTERS}
        assert name_codes(together[0][1][i]) == name_codes(alone.describe(titles[i : i + 1], keys[i : i + 1])[1][0])
    words = ["a", "ab", "straße", "deep"]
    cells, begin = entity_match._all_runs(words)
    assert [x.tolist() for x in np.split(cells, begin[1:])] == [entity_match._runs(w) for w in words]


def test_differing_titles_cost_few_calls():
    a, b = "deep learning for triage of septic shock in rural mice", "deep learning for imaging of chronic pain in rural mice"
    assert papers.same_title(a, b, False, False) == 0
    assert _calls(lambda: papers.same_title(a, b, False, False)) < 100


def test_sharper_name_masks_fail_no_pair_that_begins_or_ends_alike(spark):
    rng = random.Random(9)
    names = ["".join(rng.choice("abc") for _ in range(3)) + rng.choice("xyz") * 2 + "".join(rng.choice("abc") for _ in range(3)) for _ in range(60)]
    forms = papers.ends_of_names(spark.createDataFrame([(i, rng.sample(names, i % 4)) for i in range(60)], "rid long, keys array<string>"))
    side = lambda i: forms.select(*[F.col(c).alias(f"{c}{i}") for c in forms.columns])
    pairs = side(1).crossJoin(side(2)).withColumn("passed", papers.alike_ends())
    n = {True: 0, False: 0}
    for r in pairs.collect():
        a, b = r["keys1"], r["keys2"]
        may = not a or not b or any(x[:3] == y[:3] or x[-3:] == y[-3:] for x in a for y in b)
        n[may] += r["passed"]
        assert r["passed"] or not may
    assert n[True] and n[False] < sum(not papers.same_names(r["keys1"], r["keys2"]) for r in pairs.collect())


def test_forms_cost_few_calls():
    rng = random.Random(10)
    counts = papers.Counts(np.zeros(papers.COUNT_CELLS + 1, np.int64), np.zeros(papers.COUNT_CELLS + 1, np.int64))
    names = _made_names(rng, 1_000)
    titles = [" ".join(rng.sample("deep learning for triage of septic shock in rural mice".split(), 8)) for _ in names]
    assert _calls(lambda: papers.form_lists(titles, names, ["2020"] * 1_000, ["Heart"] * 1_000, counts)) < 155 * len(names)


def _misspelt(rng, word):
    i = rng.randrange(1, len(word) - 1)
    return rng.choice([word[:i] + word[i + 1 :], word[:i] + rng.choice("abcxyzé") + word[i:], word[:i] + rng.choice("abcxyz") + word[i + 1 :], word[: i - 1] + word[i] + word[i - 1] + word[i + 1 :]])


def test_name_codes_fail_no_pair_whose_names_are_alike(monkeypatch):
    rng = random.Random(12)
    names = ["".join(rng.choice("aeiklnorstuvжé") for _ in range(rng.choice([3, 5, 6, 8, 10, 11, 14]))) for _ in range(40)]
    typed = lambda w: w if len(w) < 5 else _misspelt(rng, _misspelt(rng, w)) if len(w) > 10 and rng.random() < 0.5 else _misspelt(rng, w)
    lists = [[]] * 4 + [rng.sample(names, rng.randrange(1, 7)) for _ in range(60)]
    lists += [sorted({typed(w) if rng.random() < 0.6 else w for w in x}) for x in lists] + [[w[0] + "".join(rng.choice("bcdfg") for _ in w) + w[-3:] for w in x] for x in lists]
    years = [rng.choice([0, 2019, 2020, 2021, 2022]) for _ in lists]
    codes = papers.code_lists(years, lists)
    pairs = [(i, j) for i in range(len(lists)) for j in range(len(lists))]
    passed = papers.alike_codes(codes.take([i for i, _ in pairs]), codes.take([j for _, j in pairs]))
    n, others = {True: 0, False: 0}, 0
    for (i, j), p in zip(pairs, passed.tolist(), strict=True):
        share = papers.same_names(lists[i], lists[j])
        may = share >= papers.LEAST_NAMES or share < 0 and (not years[i] or not years[j] or abs(years[i] - years[j]) <= 1)
        n[may] += p
        others += not may
        assert p or not may, (lists[i], lists[j])
    assert n[True] > 200 and n[False] < 0.2 * others
    # in portions, without codes, and with too many names
    monkeypatch.setattr(papers, "WORD_PAIRS", 50)
    assert (papers.alike_codes(codes.take([i for i, _ in pairs]), codes.take([j for _, j in pairs])) == passed).all()
    many = papers.code_lists([2020, 2001, 2020], [names * 7, names[:2], names[2:4]])
    assert many.is_null().to_pylist() == [True, False, False]
    assert papers.alike_codes(many, many.take([1, 2, 1])).tolist() == [True, False, False]
    assert papers.alike_codes(codes[:0], codes[:0]).tolist() == []


def test_equal_ends_of_other_names_make_no_pair_of_titles(spark):
    """Only pairs whose names may be typings of each other leave the blocks of titles; pairs without names need the year."""
    from paperweave.operators.durable import Scratch

    title = "deep learning for triage of septic shock"
    forms = lambda made: _form_rows(spark, [(i, title, keys, [9]) for i, keys, _ in made]).join(spark.createDataFrame([(i, c) for (i, _, _), c in zip(made, papers.code_lists([y for *_, y in made], [k for _, k, _ in made]).to_pylist(), strict=True)], "rid long, codes binary"), "rid")
    left = forms([(1, ["fizonorad", "gokatonen"], 2020), (2, [], 2020)])
    right = forms([(11, ["belumurad", "sivuktonen"], 2020), (12, ["fizonroad", "krelutim"], 2020), (13, ["zemorin"], 2012), (14, ["zemorin"], 2021), (15, ["zemorin"], 0)])
    assert rows(entity_match.block_pairs(left, right, Scratch(spark, "names"))) == [(1, 12), (2, 11), (2, 12), (2, 14), (2, 15)]


def test_rows_of_runs_are_added_in_order():
    rng = np.random.default_rng(3)
    for sizes in ([], [0], [3, 0, 1, 7, 0, 2, 12], [1] * 5):
        size = np.array(sizes, np.int64)
        at = rng.integers(0, 20, int(size.sum()))
        for table in (rng.integers(-9, 9, (20, 4)), rng.standard_normal((20, 4)).astype(np.float32)):
            want = [sum((table[j] for j in run), np.zeros(4, table.dtype)) for run in np.split(at, np.cumsum(size)[:-1])] if sizes else np.zeros((0, 4))
            got = entity_match._sum_runs(table, at, size)
            assert got.dtype == table.dtype and (got == np.array(want)).all()
