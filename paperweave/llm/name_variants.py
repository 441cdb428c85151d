"""Variant spellings of names, by noisy-channel attribution.

Every distinct string is read as a person (surname, given name, initials) or a group (stem, kind). Spellings
of a surname or stem that differ by one edit are candidates for one another; the frequent ones are canonical
forms. A rarer spelling is attached to the canonical form of maximum posterior: the form's frequency as
prior, the likelihood of the typing error, the likelihood of the abbreviation between their given names, and
how much of the titles and co-authors that they are met with is alike. Within a surname, initials and nicknames are attached to the
given name that fits and is most frequent.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.durable import Scratch
from ..tables import width
from .papers import near, plain

#: A word in more than this share of all names, and in this many more, is a given name (so there are at most some hundred).
GIVEN_SHARE, GIVEN_LEAST = 0.001, 25
#: Log likelihood of one typing error.
TYPO = math.log(0.02)
#: Likelihood ratios of a context that is the canonical form's and of one that isn't, same author against another.
ALIKE, STRANGE = 450.0, 0.1
#: Letters of a run of a title, and runs kept of its first letters (so many) and of the rest.
RUN, FIRST, KEEP_FIRST, KEEP_REST = 7, 30, 3, 4
#: Runs and co-authors in more than this share of all contents (and in more than so many) tell nothing.
COMMON_TOKEN, COMMON_LEAST = 0.002, 400

# Words of groups by kind, topics, and short forms of given names.
KINDS = {"study group": "group", "study grp": "group", "group": "group", "grp": "group", "network": "network", "netw": "network", "consortium": "consortium", "consort": "consortium", "collaboration": "collaboration", "collab": "collaboration", "investigators": "investigators", "invest": "investigators", "team": "team", "initiative": "initiative"}
TOPICS = frozenset("stroke heart kidney sleep imaging registry study the of for trial".split())
NICKNAMES = {
    "alex": "alexander", "sasha": "alexander", "aleks": "alexander", "ben": "benjamin", "benny": "benjamin", "charlie": "charlotte", "lottie": "charlotte", "dasha": "daria", "dima": "dmitri", "mitya": "dmitri", "ed": "edward", "ned": "edward", "ted": "edward", "eddie": "edward", "katya": "ekaterina", "liz": "elizabeth", "beth": "elizabeth", "betty": "elizabeth", "lisa": "elizabeth", "fran": "francesca", "franca": "francesca", "fred": "frederick", "freddie": "frederick", "gabi": "gabriela", "gaby": "gabriela", "gianni": "giovanni", "vanni": "giovanni", "bella": "isabella", "isa": "isabella", "izzy": "isabella", "hannes": "johannes", "hans": "johannes", "jo": "josephine", "josie": "josephine", "kate": "katherine", "kathy": "katherine", "katie": "katherine", "kat": "katherine", "maggie": "margaret", "peggy": "margaret", "meg": "margaret", "masha": "maria", "matt": "matthew", "mike": "michael", "mick": "michael", "misha": "michael", "nikos": "nikolaos", "niko": "nikolaos", "nick": "nikolaos", "pat": "patricia", "trish": "patricia", "patty": "patricia", "pasha": "pavel", "renate": "renata", "rick": "richard", "dick": "richard", "rich": "richard", "bob": "robert", "rob": "robert", "bobby": "robert", "sam": "samuel", "sue": "susanna", "susie": "susanna", "theo": "theodora", "dora": "theodora", "tom": "thomas", "tommy": "thomas", "jim": "james", "jimmy": "james", "jack": "john", "johnny": "john", "joe": "joseph", "pepe": "jose", "paco": "francisco", "tony": "anthony", "dan": "daniel", "danny": "daniel", "dave": "david", "steve": "steven", "chris": "christopher", "andy": "andrew", "drew": "andrew", "greg": "gregory", "jeff": "jeffrey", "jen": "jennifer", "jenny": "jennifer", "becky": "rebecca", "debbie": "deborah", "sandy": "sandra", "vicky": "victoria", "volodya": "vladimir", "vova": "vladimir", "vlad": "vladimir", "bill": "william", "will": "william", "billy": "william", "liam": "william",
}
_SPLIT = regex.compile(r"[^\p{L}\p{N}'’\-,.]+")
_INITIALS = regex.compile(r"^(?:[\p{Lu}]\.?-?){1,3}$|^(?:\p{L}\.){1,3}$|^\p{L}\.?$")
_PARSED = "name string, n bigint, kind string, stem string, given string, initials string"


def _given(word: str, lexicon: tuple[str, ...], near_cache: dict) -> str | None:
    """The given name that a word is (spelt out, short, or with one typing error), or None.

    Of several that a mistyped word may be, the nearest is taken, then the first in the order of the alphabet.
    """
    if word in NICKNAMES:
        return NICKNAMES[word]
    if word not in near_cache:
        if len(near_cache) > 300_000:
            near_cache.clear()
        found = word if word in lexicon else None
        if found is None and len(word) >= 4:
            found = min((g for g in lexicon if abs(len(g) - len(word)) <= 1 and near(word, g)), key=lambda g: (not _one_more(word, g), sum(a != b for a, b in zip(word, g, strict=False)), g), default=None)
        if found is None and len(word) >= 5:
            found = next((full for nick, full in NICKNAMES.items() if abs(len(nick) - len(word)) == 1 and _one_more(word, nick)), None)
        near_cache[word] = found
    return near_cache[word]


def _one_more(a: str, b: str) -> bool:
    """Whether one word is the other with one letter more."""
    if len(a) < len(b):
        a, b = b, a
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def parse_name(name: str, lexicon: tuple[str, ...], near_cache: dict) -> tuple[str, str, str, str]:
    """(kind, stem, given, initials) of a name; kind is person, a kind of group, or empty for no name."""
    low = plain(name)
    words = [w for w in regex.findall(r"[\p{L}\p{N}]+", low)]
    if not words:
        return "", "", "", ""
    kinds = [KINDS[w] for w in words if w in KINDS]
    if not kinds and len(words) > 1:
        kinds = [KINDS[k] for w in words for k in KINDS if len(w) > 7 and len(k) > 7 and near(w, k)]
        if kinds:
            words = [w for w in words if not any(len(w) > 7 and len(k) > 7 and near(w, k) for k in KINDS)]
    if kinds and len(words) > 1:
        rest = [w for w in words if w not in KINDS and w not in TOPICS]
        if len(rest) > 1:
            odd = [w for w in rest if not any(len(t) > 3 and near(w, t) for t in TOPICS)]
            rest = odd or rest
        return kinds[0], " ".join(rest), "", ""
    tokens = [t for t in _SPLIT.split(name.strip()) if t.strip(".,-'’")]
    family, others = [], tokens
    if "," in name:
        head, _, tail = name.partition(",")
        family = [t for t in _SPLIT.split(head) if t.strip(".,-'’")]
        others = [t for t in _SPLIT.split(tail) if t.strip(".,-'’")]
    initials, long = [], []
    for t in others:
        t = t.strip(",'’")
        bare = plain(t.replace(".", "").replace("-", ""))
        if len(bare) <= 3 and _INITIALS.match(t) and (len(bare) <= 2 or "." in t) and not (bare in NICKNAMES and not t.isupper()):
            initials.append(bare)
        else:
            long.append(t.strip("."))
    given = ""
    if not family:
        if len(long) == 1:
            family, long = long, []
        elif long:
            marks = [_given(plain(t), lexicon, near_cache) for t in long]
            caps = [t.isupper() and len(t) > 2 for t in long]
            if any(caps) and not all(caps):
                family = [t for t, c in zip(long, caps, strict=True) if c]
                long = [t for t, c in zip(long, caps, strict=True) if not c]
            else:
                at = next((i for i, m in enumerate(marks) if m), 0)
                family = [t for i, t in enumerate(long) if i != at]
                long = [long[at]]
        else:
            family, initials = initials[-1:], initials[:-1]
    if long:
        word = plain(long[0])
        given = _given(word, lexicon, near_cache) or word
    stem = " ".join(regex.findall(r"[\p{L}\p{N}]+", plain(" ".join(family))))
    text = "".join(initials)
    return "person", stem, given, (given[:1] + text) if given else text


def occurrences(candidates: DataFrame, records: DataFrame, dump: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((name, paper) of all rows of the three tables, (paper, title, names) of their contents, with repeats).

    Names are comma-separated entries of raw_authors and elements of authors_json, trimmed, inner white space
    as one blank. Empty entries and ``…`` are no names; broken JSON has none. paper is a hash of title and names.
    """
    lists = candidates.select(F.col("raw_title").alias("title"), F.split("raw_authors", ",").alias("names")).unionByName(records.select("title", F.from_json("authors_json", "array<string>").alias("names"))).unionByName(dump.select("title", F.from_json("authors_json", "array<string>").alias("names")))
    contents = lists.where("names is not null").select(F.xxhash64("title", "names").alias("paper"), "title", "names")
    out = contents.select("paper", F.explode("names").alias("name"))
    name = F.trim(F.regexp_replace("name", r"(?U)\s+", " "))
    return out.select(name.alias("name"), "paper").where("name <> '' and name <> '…' and name <> '...'"), contents


def tokens(contents: DataFrame, scratch: Scratch) -> DataFrame:
    """(paper, token, word) of contents: winnowed runs of all letters of the title, and words of the names.

    word is the hash of a name's word, null for runs. Tokens that many contents have are left out.
    """
    # decorations before the title and mark-up in it are no letters of it
    letters = F.regexp_replace(F.regexp_replace(F.lower("x.title"), r"^\s*(\[[a-z]{1,9}\]|new article:)\s*|</?i>", ""), r"[^\p{L}\p{N}]+", "")
    one = contents.groupBy("paper").agg(F.min(F.struct("title", "names")).alias("x")).select("paper", F.coalesce(letters, F.lit("")).alias("t"), "x.names")
    runs = F.when(F.length("t") >= RUN, F.transform(F.sequence(F.lit(1), F.length("t") - (RUN - 1)), lambda i: F.xxhash64(F.substring(F.col("t"), i, F.lit(RUN))))).otherwise(F.array().cast("array<bigint>"))
    listed = one.select("paper", runs.alias("r"), F.array_distinct(F.regexp_extract_all(F.lower(F.array_join("names", " ")), F.lit(r"(\p{L}{4,})"), F.lit(1))).alias("w"))
    head = F.slice(F.array_sort(F.slice("r", 1, FIRST)), 1, KEEP_FIRST)
    rest = F.slice(F.array_sort(F.slice("r", FIRST + 1, 100_000)), 1, KEEP_REST)
    kept = F.transform(F.array_distinct(F.concat(head, rest)), lambda h: F.struct(h.alias("token"), F.lit(False).alias("word")))
    words = F.transform("w", lambda x: F.struct(F.xxhash64(x).alias("token"), F.lit(True).alias("word")))
    rows = scratch.keep(listed.select("paper", F.explode(F.concat(kept, words)).alias("x")).select("paper", "x.*"), "tokens")
    n = one.count()
    common = rows.groupBy("token").agg(F.count("*").alias("k")).where(F.col("k") > max(COMMON_LEAST, COMMON_TOKEN * n)).select("token")
    return rows.join(common, "token", "left_anti").select("paper", "token", "word")


def parsed_names(named: DataFrame) -> DataFrame:
    """The distinct names of (name, n) read as persons and groups."""
    words = named.select("n", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("name"), F.lit(r"(\p{L}{3,})"), F.lit(1)))).alias("w"))
    total = named.agg(F.sum("n")).head()[0] or 0
    frequent = words.groupBy("w").agg(F.sum("n").alias("n")).where(F.col("n") > GIVEN_LEAST + GIVEN_SHARE * total).select("w")  # at most words per name / GIVEN_SHARE rows
    # the same rule at every size: frequent words of names and the fixed list
    learnt = {plain(r["w"]) for r in frequent.collect()} - TOPICS - {w for k in KINDS for w in k.split()} - NICKNAMES.keys()
    lexicon = tuple(sorted(learnt | set(NICKNAMES.values())))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache: dict = {}
        for pdf in batches:
            rows = [parse_name(x, lexicon, cache) for x in pdf["name"]]
            yield pd.concat([pdf[["name", "n"]].reset_index(drop=True), pd.DataFrame(rows, columns=["kind", "stem", "given", "initials"])], axis=1)

    return named.repartition(width(named.sparkSession), "name").mapInPandas(run, _PARSED).where("stem <> ''")


def near_stems(stems: DataFrame) -> DataFrame:
    """(grp, stem, canonical, n, m) of stems that differ by one typing error, the more frequent one as canonical.

    Stems of three letters and more meet where they are equal after one letter is left out (of either or
    both), which covers a letter more, less, other, or two neighbours swapped.
    """
    short = F.transform(F.sequence(F.lit(1), F.length("stem")), lambda i: F.concat(F.substring(F.col("stem"), F.lit(1), i - 1), F.substring(F.col("stem"), i + 1, F.length("stem"))))
    keyed = stems.where(F.length("stem") >= 3).select("grp", "stem", "n", F.explode(F.array_distinct(F.concat(F.array("stem"), short))).alias("k")).select("grp", "stem", "n", F.xxhash64("grp", "k").alias("k"))
    a, b = keyed, keyed.select(F.col("stem").alias("canonical"), F.col("n").alias("m"), "k")
    pairs = a.join(b, "k").where("(m, canonical) > (n, stem)").select("grp", "stem", "canonical", "n", "m").distinct()
    # equal after leaving out one letter each may be two edits apart: neighbours swapped
    return pairs.where((F.levenshtein("stem", "canonical") <= 1) | ((F.length("stem") == F.length("canonical")) & (F.levenshtein("stem", "canonical") == 2)))


def _fit(given: str, initials: str, other_given: str, other_initials: str) -> bool:
    """Whether given name and initials of two names may be one person's."""
    if not initials or not other_initials:
        return False
    if given and other_given and given != other_given and not near(given, other_given):
        return False
    n = min(len(initials), len(other_initials))
    return initials[:n] == other_initials[:n] or (bool(given) and bool(other_given) and initials[1:n] == other_initials[1:n])


def attach(parsed: DataFrame, met: DataFrame, contents: DataFrame, scratch: Scratch) -> DataFrame:
    """(name, n, kind, canonical, given, initials): parsed names with the canonical spelling of their stem.

    met has (name, paper), contents (paper, title, names). A stem is attached to the near stem of maximum
    posterior, if that beats its being a name of its own; chains of attachments end at their last stem.
    """
    # persons meet by surname and first letter, groups by kind
    group = F.when(F.col("kind") == "person", F.concat(F.lit("p"), F.substring("initials", 1, 1))).otherwise(F.col("kind"))
    grouped = scratch.keep(parsed.withColumn("grp", group), "parsed")
    stems = scratch.keep(grouped.groupBy("grp", "stem").agg(F.sum("n").alias("n"), F.count("*").alias("forms"), F.max("given").alias("given"), F.max("initials").alias("initials")), "stems")
    pairs = scratch.keep(near_stems(stems), "near")
    wanted = pairs.select("grp", "stem").unionByName(pairs.select("grp", F.col("canonical").alias("stem"))).distinct()
    stem_id = F.xxhash64("grp", "stem")
    papers_of = scratch.keep(met.join(grouped.select("name", "grp", "stem").join(wanted, ["grp", "stem"]), "name").select(stem_id.alias("sid"), F.xxhash64("stem").alias("own"), "paper").distinct(), "papers")
    told = tokens(contents, scratch)
    # of the canonical forms all tokens, of their variants those of each paper; a variant's own word is no context
    paired = pairs.select("grp", "stem", "canonical", stem_id.alias("sid"), F.xxhash64("grp", "canonical").alias("cid"))
    known = papers_of.join(paired.select(F.col("cid").alias("sid")).distinct(), "sid").join(told, "paper").select(F.col("sid").alias("cid"), "token").distinct()
    asked = paired.select("sid", "cid").join(papers_of, "sid").join(told, "paper").where("token <> own")
    hits = asked.join(known.withColumn("hit", F.lit(1)), ["cid", "token"], "left")
    part = lambda w: F.try_divide(F.count(F.when(w, F.col("hit"))), F.count_if(w))
    by_paper = hits.groupBy("sid", "cid", "paper").agg(part(~F.col("word")).alias("title"), part(F.col("word")).alias("names"))
    # half of the title's runs or of the co-authors make a context the canonical form's
    alike = by_paper.select("sid", "cid", F.least(F.lit(1.0), 2 * F.greatest("title", "names")).alias("alike")).groupBy("sid", "cid").agg(F.avg("alike").alias("alike"))
    scored = scratch.keep(pairs.join(paired, ["grp", "stem", "canonical"]).join(alike, ["sid", "cid"], "left"), "scored")
    # prior: how much more frequent the canonical form is; channel: typing errors; context: papers alike, 0 where nothing is known
    context = F.coalesce(F.log(F.col("alike") * ALIKE + (1 - F.col("alike")) * STRANGE), F.lit(0.0))
    score = F.log(F.col("m") / F.col("n")) + TYPO + context
    best = scored.withColumn("score", score).where("score > 0").groupBy("grp", "stem").agg(F.max(F.struct("score", "m", "canonical"))["canonical"].alias("canonical"))
    best = scratch.keep(best, "attached")
    return grouped.join(_ends_of(best, scratch), ["grp", "stem"], "left").select("name", "n", "kind", "grp", F.coalesce("canonical", "stem").alias("canonical"), "given", "initials")


def _ends_of(attached: DataFrame, scratch: Scratch) -> DataFrame:
    """attached (grp, stem, canonical) with chains followed to their end.

    Each form is attached to a more frequent one, so chains end; every round doubles the steps taken, until
    nothing moves.
    """
    up = attached
    while True:
        above = up.select("grp", F.col("stem").alias("canonical"), F.col("canonical").alias("above"))
        nxt = scratch.keep(up.join(above, ["grp", "canonical"], "left").select("grp", "stem", F.coalesce("above", "canonical").alias("canonical"), F.col("above").isNotNull().alias("moved")), "chains")
        up = nxt.drop("moved")
        if nxt.where("moved").isEmpty():
            return up


def _persons(forms: dict[tuple[str, str], int]) -> dict[tuple[str, str], int]:
    """The entity of each (given, initials) of one canonical surname and first letter, from their counts.

    Spelt-out and frequent forms found entities; every other form attaches to the entity of maximum
    posterior: the most frequent one that its initials and given name fit.
    """
    seeds: list[list] = []
    where = {}
    for (given, initials), n in sorted(forms.items(), key=lambda f: (-(10 * bool(f[0][0]) + len(f[0][1])), -f[1], f[0])):
        fits = [i for i, s in enumerate(seeds) if _fit(given, initials, s[0], s[1])]
        if fits:
            i = max(fits, key=lambda i: (seeds[i][2], -i))
            seeds[i][2] += n
            if len(initials) > len(seeds[i][1]):
                seeds[i][1] = initials
        else:
            i = len(seeds)
            seeds.append([given, initials, n])
        where[given, initials] = i
    return where


_FORMS = ["grp", "canonical", "given", "initials", "entity"]


def _person_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Entities of sorted distinct forms: those of one surname and first letter come together."""
    held: dict[tuple[str, str], int] = {}
    key = None
    out: list[tuple] = []

    def close() -> None:
        out.extend((*key, *form, e) for form, e in _persons(held).items())
        held.clear()

    for pdf in batches:
        for grp, canonical, given, initials, n in zip(*(pdf[c] for c in (*_FORMS[:4], "n")), strict=True):
            if held and key != (grp, canonical):
                close()
            key = (grp, canonical)
            held[given, initials] = n
        if len(out) > 10_000:
            yield pd.DataFrame(out, columns=_FORMS)
            out.clear()
    if held:
        close()
    if out:
        yield pd.DataFrame(out, columns=_FORMS)


def entities(candidates: DataFrame, records: DataFrame, dump: DataFrame) -> DataFrame:
    """(name, n, grp, canonical, entity): every distinct name with the key of the author it is attached to.

    What Python holds at a time are the distinct given names and initials met with one surname and first letter,
    counted before; spellings and rows are joined to them. Null lists give no names; empty tables give no rows.
    """
    scratch = Scratch(candidates.sparkSession, "names")
    listed, contents = occurrences(candidates, records, dump)
    met = scratch.keep(listed.groupBy("name", "paper").agg(F.count("*").alias("n")), "met")
    named = scratch.keep(met.groupBy("name").agg(F.sum("n").alias("n")), "named")
    attached = scratch.keep(attach(parsed_names(named), met.select("name", "paper"), contents, scratch), "names")
    people = attached.where("kind = 'person'")
    key = _FORMS[:4]
    forms = people.groupBy(*key).agg(F.sum("n").alias("n")).repartition(width(candidates.sparkSession), "grp", "canonical").sortWithinPartitions("grp", "canonical")
    told = forms.mapInPandas(_person_batches, "grp string, canonical string, given string, initials string, entity int")
    persons = people.join(told, key).select("name", "n", "grp", "canonical", "entity")
    groups = attached.where("kind <> 'person'").select("name", "n", "grp", "canonical", F.lit(0).alias("entity"))
    return persons.unionByName(groups)


def variant_pairs(candidates: DataFrame, records: DataFrame, dump: DataFrame) -> DataFrame:
    """(name_a, name_b): pairs of different strings that name the same author, name_a < name_b."""
    found = Scratch(candidates.sparkSession, "entities").keep(entities(candidates, records, dump).select("grp", "canonical", "entity", "name"), "entities")
    key = ["grp", "canonical", "entity"]
    many = found.join(found.groupBy(*key).agg(F.count("*").alias("k")).where("k > 1").drop("k"), key)
    a, b = many.withColumnRenamed("name", "name_a"), many.withColumnRenamed("name", "name_b")
    return a.join(b, key).where("name_a < name_b").select("name_a", "name_b")


def canonical_names(candidates: DataFrame, records: DataFrame, dump: DataFrame) -> DataFrame:
    """(name, canonical_name, n): every name with the most frequent spelling of its author."""
    found = entities(candidates, records, dump)
    key = ["grp", "canonical", "entity"]
    best = found.groupBy(*key).agg(F.max(F.struct("n", "name"))["name"].alias("canonical_name"))
    return found.join(best, key).select("name", "canonical_name", "n")
