import random

from pyspark.sql import functions as F

from paperweave.operators import delivery, grading, graph, relational, reports, resolve, survivorship


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def brute_components(edges):
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        up[find(a)] = find(b)
    out = {}
    for x in up:
        out.setdefault(find(x), set()).add(x)
    return sorted(map(sorted, out.values()))


def test_components(spark):
    rng = random.Random(3)
    edges = [(f"n{i}", f"n{i + 1}") for i in range(40)] + [(f"r{rng.randrange(60)}", f"r{rng.randrange(60)}") for _ in range(40)] + [("hub", f"h{i}") for i in range(50)]
    df = spark.createDataFrame([*edges, ("a", None), ("b", "b")], "u string, v string")
    for settle in (0, 30, graph.SETTLE):
        found = {}
        for n, c in graph.connected_components(df, settle=settle).collect():
            found.setdefault(c, set()).add(n)
        assert sorted(map(sorted, found.values())) == brute_components([e for e in edges if e[0] != e[1]])
    assert graph.connected_components(df.limit(0)).collect() == []


MAIL = "id long, mail_uid string, message_id string, extra string"


def test_messages_deliver_once(spark):
    m = spark.createDataFrame([(1, "u1", "<A-1@x>", ""), (2, "u2", " A-1@x ", ""), (3, "u2", None, ""), (4, "u3", "A-01@x", ""), (5, "u4", "A-1@y", ""), (6, None, "zz@x", ""), (7, "", "<zz@x>", ""), (8, None, None, ""), (9, None, "<>", ""), (10, "u1", "zz@x", "")], MAIL)
    assert rows(delivery.repeats(m)) == [(10,), (2,), (3,), (6,), (7,)]
    assert rows(delivery.messages(m.where("id in (4, 8)")).select("id", "first_id", "via")) == [(4, 4, "lookup"), (8, 8, "none")]
    assert delivery.repeats(m.limit(0)).collect() == []


def test_ranges(spark):
    m = spark.createDataFrame([(i, None, f"P-{n}@h", "") for i, n in enumerate([1, 2, 3, 3, 7, 65535, 65536, 9])], MAIL)
    ranges = delivery.seen_ranges(delivery.identifiers(m))
    assert rows(ranges.select("lo", "hi")) == [(1, 3), (65535, 65535), (65536, 65536), (7, 7), (9, 9)]
    new = spark.createDataFrame([(20, None, "P-3@h", ""), (21, None, "P-8@h", ""), (22, None, "P-8@h", ""), (23, None, "odd", ""), (24, None, "P-8@other", "")], MAIL)
    taken = delivery.accept(new, ranges, new.limit(0).select(F.lit("").alias("message_key")))
    assert rows(taken.select("id", "kind")) == [(21, "range"), (23, "lookup"), (24, "range")]
    merged = delivery.merge_ranges(ranges, delivery.seen_ranges(taken.where("kind = 'range'").select("producer", "number")))
    assert (7, 9) in rows(merged.where("producer = 'P@h'").select("lo", "hi"))


def test_relational(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k int, v string, o int")
    new = spark.createDataFrame([(2, "c", 1), (2, "d", 2), (3, "e", 1)], "k int, v string, o int")
    assert rows(relational.upsert(old, new, ["k"], "o").select("k", "v")) == [(1, "a"), (2, "d"), (3, "e")]
    assert rows(relational.insert_new(old, new, ["k"], "o").select("k", "v")) == [(3, "e")]
    assert rows(relational.latest(new, ["k"], "o").select("k", "v")) == [(2, "d"), (3, "e")]
    assert rows(relational.unprocessed(old, new, on="k").select("k")) == [(1,)]
    text = spark.createDataFrame([(1, "x", None, 1), (1, "xx", "", 2), (1, "xx", None, 3)], "k int, a string, b string, o int")
    assert rows(relational.richest(text, ["k"], ["a", "b"], "o").select("k", "o")) == [(1, 2)]
    near = relational.neighbour_keys(spark.createDataFrame([(1, i, f"k{i}") for i in range(3)], "p int, o int, key string"), "p", "o", "key", 1)
    assert rows(near.select("o", "neighbours", "place")) == [(0, "+1:k1", 1), (1, "-1:k0 ### +1:k2", 2), (2, "-1:k1", 3)]


def test_neighbours_reach_across_blocks(spark):
    at = [0, 1, 5, 6, 7, 40, 41, 90]
    df = spark.createDataFrame([("p", o, f"k{o}") for o in at] + [(None, 3, "n")], "p string, o long, key string")
    got = {(r.p, r.o): (r.neighbours, r.place) for r in relational.neighbour_keys(df, "p", "o", "key", 2, block=4).collect()}
    for i, o in enumerate(at):
        want = " ### ".join(f"{j:+d}:k{at[i + j]}" for j in (-2, -1, 1, 2) if 0 <= i + j < len(at))
        assert got["p", o] == (want, i + 1)
    assert got[None, 3] == ("", 1)
    rules = spark.createDataFrame([("doi", "d1", "p1"), ("pmid", "m1", "p2"), ("doi", "d1", "p0")], "rule string, key string, target string")
    asked = spark.createDataFrame([(1, "d1", "m1"), (2, "", "m1"), (3, None, None)], "id int, doi string, pmid string")
    assert rows(relational.first_rule(asked, rules, "id", ["doi", "pmid"])) == [(1, "p0", "doi"), (2, "p2", "pmid")]


def test_clusters_take_the_most_telling_leader(spark):
    df = spark.createDataFrame([("c1", 1, None, "u"), ("c2", 2, "d", "u"), ("c3", 3, "d", ""), ("c4", 4, None, None), ("c5", 5, "e", "")], "candidate_id string, id long, doi string, url string")
    assert rows(resolve.clusters(df, ["doi", "url"])) == [("c1", "c2", 3), ("c2", "c2", 3), ("c3", "c2", 3)]


def test_assignment_equals_the_sequential_fold(spark):
    rng = random.Random(5)
    data = [(f"c{i:03}", i, rng.choice([None, "", *"abcdefgh"]), rng.choice([None, *"pqrstuvw"])) for i in range(120)]
    held, want = [{}, {}], []
    for c, _, *own in data:
        hit = next(((i, held[i][k]) for i, k in enumerate(own) if k and k in held[i]), None)
        if hit:
            want.append((c, hit[1], f"rule_{hit[0] + 1}"))
        else:
            for i, k in enumerate(own):
                if k:
                    held[i].setdefault(k, c)
            want.append((c, c, "new"))
    df = spark.createDataFrame(data, "candidate_id string, id long, doi string, pmid string")
    got = resolve.assign(df, ["doi", "pmid"])
    assert rows(got.drop("confidence")) == sorted(want, key=str)
    assert {(r.rule == "new", r.confidence) for r in got.collect()} == {(True, 0.6), (False, 0.95)}


def test_assignment_with_titles_and_founders_from_before(spark):
    rng = random.Random(9)
    pick = lambda n, letters: [rng.choice([None, *letters]) for _ in range(n)]
    data = [(f"c{i:03}", i, d, t, y) for i, (d, t, y) in enumerate(zip(pick(90, "abcdefgh"), pick(90, "pqrst"), pick(90, "12"), strict=True))]
    before = [("P1", "a", "p", "1"), ("P2", "h", None, None)]
    held = [{}, {}, {}]
    keys = lambda d, t, y: [d, (t, y) if t and y else None, t]

    def found(name, own):
        for i, k in enumerate(own):
            if k:
                held[i].setdefault(k, name)

    for p, d, t, y in before:
        found(p, keys(d, t, y))
    want = []
    for c, _, d, t, y in data:
        own = keys(d, t, y)
        hit = next(((i, held[i][k]) for i, k in enumerate(own) if k and k in held[i]), None)
        if hit is None:
            found(c, own)
        want.append((c, *((hit[1], ["rule_1", "title_year", "title"][hit[0]], [0.95, 0.75, 0.75][hit[0]]) if hit else (c, "new", 0.6))))
    df = spark.createDataFrame(data, "candidate_id string, id long, doi string, t string, y string")
    known = spark.createDataFrame(before, "paper_id string, doi string, t string, y string")
    assert rows(resolve.assign(df, ["doi"], title="t", year="y", canonicals=known)) == sorted(want, key=str)
    assert rows(resolve.assign(df.limit(0), ["doi"])) == []


SOURCE = "candidate_id string, id long, source_name string, query_type string, matched boolean, title string, authors_json string, venue string, year string, doi string, pmid string, pmcid string, abstract string"


def test_survivorship(spark):
    df = spark.createDataFrame([("c", 1, "pubmed", "title", True, "T pub", None, "V", "2025", "10.1/a", "123", None, "abs"), ("c", 2, "crossref", "doi", True, "T cross", None, "V.", "2026", "10.1/b", None, None, None), ("c", 3, "openalex", "doi", False, "no", None, None, None, None, None, None, None), ("d", 4, None, None, True, "", None, None, None, None, None, None, None)], SOURCE)
    got = {(r.candidate_id, r.field_name): (r.value, r.source_name) for r in survivorship.picked_fields(df).collect()}
    assert got["c", "title"] == ("T cross", "crossref") and got["c", "pmid"] == ("123", "pubmed") and got["c", "abstract"] == ("abs", "pubmed")
    assert {(r.field_name, r.grade) for r in grading.graded_conflicts(df).collect()} == {("title", "C"), ("year", "B"), ("doi", "C")}
    assert rows(grading.assessment(df)) == [("c", 3, 2, "C", True, 0.25), ("d", 0, 0, "none", False, 0.9)]


def test_batches_count_on_over_parts(spark):
    df = spark.createDataFrame([(f"{'abc'[i % 3]}query{i:03}",) for i in range(130)] + [(None,)], "q string")
    got = {r.key: r.batch_no for r in reports.batch_numbers(df, "q").collect()}
    assert got == {k: i // 50 for i, k in enumerate(sorted(got))}


def test_ranges_decide_what_repeats(spark):
    m = spark.createDataFrame([(i, f"u{i}", f"<Prod-{i % 40}@h>" if i % 5 else f"odd{i % 10}") for i in range(1, 101)], "id long, mail_uid string, message_id string")
    want = rows(delivery.repeats(m))
    assert want == sorted([(i,) for i in range(1, 101) if (i > 10 if i % 5 == 0 else i > 40)], key=str)

    class Forgets(delivery.Seen):
        def take(self, batch):
            self.ranges = None
            return super().take(batch)

    lost = delivery.messages(m, Forgets(delivery.Scratch(spark, "test"))).where("id > first_id").select("id")
    assert set(rows(lost)) < set(want)


def test_messages_equal_brute_force(spark):
    import random

    rng = random.Random(3)
    made = [(i, rng.choice([None, " ", f"u{rng.randrange(60)}"]), rng.choice([None, f"P-{rng.randrange(50)}@h", f"<x{rng.randrange(50)}>"])) for i in range(200)]
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for i, u, k in made:
        for n in ([("u", u)] if u and u.strip() else []) + ([("k", k)] if k else []):
            a, b = find(("i", i)), find(n)
            up[a] = b
    first = {}
    for i, _, _ in made:
        first.setdefault(find(("i", i)), i)
    df = spark.createDataFrame(made, "id long, mail_uid string, message_id string")
    assert rows(delivery.messages(df).select("id", "first_id")) == sorted([(i, first[find(("i", i))]) for i, _, _ in made], key=str)
