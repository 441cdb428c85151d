"""Comparable forms of papers and the exact check whether two of them are the same paper."""

from __future__ import annotations

import html
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Counts of name words are kept in a table of this many cells, whatever the corpus.
COUNT_CELLS = 1 << 18
#: A name word in more than this share of all names is taken for a given name or a title.
COMMON_NAME = 0.0015

# Words of serials (after which a title's tail is a venue), words that don't tell papers apart,
# words that name organisations, and pairs of spellings that mean the same.
SERIAL = "journal annals archives frontiers proceedings reports letters international review northern advances open transactions bulletin j ann arch front proc rep lett int rev adv north"
LIGHT = frozenset("a an and as at by for from in into is it its of on or the to with what vs versus de la der die das und et y".split())
GROUP = frozenset("group network consortium collaboration investigators study registry collab consort invest netw grp team sleep stroke heart kidney imaging".split())
SAME_WORDS = {"deoxyribonucleic acid": "dna", "ribonucleic acid": "rna", "magnetic resonance imaging": "mri", "computed tomography": "ct", "haem": "hem", "aemi": "emi", "labell": "label", "modell": "model", "tumour": "tumor", "oedema": "edema", "paediatric": "pediatric", "randomis": "randomiz", "harmonis": "harmoniz", "behaviour": "behavior", "fibre": "fiber", "centre": "center", "oesophag": "esophag", "α": "alpha", "β": "beta", "γ": "gamma"}

_TAG = regex.compile(r"</?\s*[a-zA-Z]{1,6}\s*/?>")
_HEAD = regex.compile(r"\[(?:[a-z]{1,3}|pdf|html?|cita[a-z]*|book)\]|new\s*art[a-z]*\s*:?\s*[a-z]?\s*:\s*[a-z]?(?=\s)|new article:?\S?\s")
_TAIL = regex.compile(r"(?:\[\s*internet\s*\]|\((?:19|20)\d\d\))$")
_EDGE = " \t\n\r\xa0\u2003\u2009\"'“”«»*_‘’"
_END = _EDGE + ".;!,]"
_VENUE_TAIL = regex.compile(r"\s[-–—‐]\s*(?:the\s+)?(?:" + "|".join(SERIAL.split()) + r")\b[^:]{0,70}$", regex.I)
_WORDS = regex.compile(r"[\p{L}\p{N}]+")
_DIGIT = regex.compile(r"\d")
_HIDDEN = regex.compile(r"[\p{Cf}\p{M}]+")
_BLANKS = bytes(i if chr(i).isalnum() else 32 for i in range(128)) + bytes(range(128, 256))
_BLANKS_IN_LIST = _BLANKS[:44] + b"," + _BLANKS[45:]
# Nouns that a number or numeral belongs to, so that it counts no parts.
_NUMBERED = "type|types|grade|grades|class|classes|stage|stages|phase|phases|level|levels|factor|category|covid|cov|version|tier|il|cox|complex|world war|angiotensin|collagen|interleukin|figure|table"
_MARKER = [
    ("erratum", regex.compile(r"^(?:erratum|corrigendum|correction|addendum|retraction|publisher correction|author correction)\b(?=.{8})|\b(?:erratum|corrigendum|correction|retraction)$")),
    ("cohort", regex.compile(r"\b(?:second|third|2nd|3rd|new|independent|replication) cohort$|\bcohort (?:2|3|ii|iii)\b|\breplication study$")),
    ("part", regex.compile(rf"\bpart (?:2|3|4|ii|iii|iv|two|three)\b|(?<!\b(?:{_NUMBERED}) )\b(?:ii|iii|iv)\b(?=(?: \S+){{0,3}}$)|\bextended follow ?up$")),
    ("reply", regex.compile(r"^(?:reply to|comment on|response to|commentary on)\b(?=.{8})")),
]
#: What a title must hold for a marker to be looked for.
_TRIGGER = {"erratum": ("erratum", "corr", "addendum", "retraction"), "cohort": ("cohort", "replication"), "part": ("part ", " ii", " iv", "extended"), "reply": ("reply", "comment", "response")}
# a number at the end counts parts only if it stands alone there (not "CoV-2") and belongs to no noun
_NUMBER_END = regex.compile(rf"(?<!\b(?:{_NUMBERED}))\s*[\s:,.;–—]\s*[23]$")
_REPLY = regex.compile(r"^re\s*:(?=.{8})")
# Beginnings that turn a word into its opposite, or into another one, by an edit or two.
_OPPOSED = [("hyper", "hypo"), ("inter", "intra"), ("macro", "micro"), ("endo", "exo"), ("endo", "ecto"), ("ante", "anti"), ("ab", "ad"), ("poly", "oligo"), ("supra", "infra"), ("super", "supra"), ("iso", "aniso"), ("normo", "hypo"), ("eu", "dys"), ("un", ""), ("in", ""), ("non", ""), ("im", ""), ("dis", "")]


class _Known(dict):
    """Values of words, made once and kept; emptied when there are too many."""

    def __init__(self, make, most: int = 400_000):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, word):
        if len(self) > self.most:
            self.clear()
        v = self[word] = self.make(word)
        return v


def plain(text: str) -> str:
    """Lower-case text without accents, hidden characters, tags and escapes."""
    if "&" in text:
        text = html.unescape(text)
    if "<" in text:
        text = _TAG.sub(" ", text)
    if not text.isascii():
        text = _HIDDEN.sub("", unicodedata.normalize("NFKD", text))
        return text.casefold().replace("ø", "o").replace("ł", "l").replace("æ", "ae")
    return text.lower()


def split_words(text: str) -> list[str]:
    """The runs of letters and digits of a text."""
    return text.encode().translate(_BLANKS).decode().split() if text.isascii() else _WORDS.findall(text)


def title_form(title: str | None) -> tuple[str, bool, str]:
    """(words joined by blanks, cut short?, marker) of a title without decorations."""
    if not title:
        return "", False, ""
    t = plain(title).replace("_", " ").lstrip(_EDGE)
    while t:
        if t[0] == "[" or t.startswith("new"):
            m = _HEAD.match(t)
            if m:
                t = t[m.end() :].lstrip(_EDGE)
                continue
            if t[0] == "[" and len(t) > 16 and "]" not in t[1:15]:
                t = t[1:].lstrip(_EDGE)
                continue
        break
    cut = False
    for _ in range(4):
        before = t
        u = t.rstrip(_EDGE + "])")
        if u.endswith(("…", "...", ". .")):
            cut, t = True, u.rstrip("…. ")
        t = t.rstrip(_END)
        if t[-1:] in ")t" or before[-1:] == "]":
            t = _TAIL.sub("", before.rstrip(_EDGE + ".;!,") if before[-1:] == "]" else t).rstrip(_END)
        if (" - " in t or "–" in t or "—" in t or "‐" in t) and (m := _VENUE_TAIL.search(t)) and m.start() > 25:
            t = t[: m.start()]
        if t == before:
            break
    words = " ".join(split_words(t))
    for a, b in SAME_WORDS.items():
        if a in words:
            words = words.replace(a, b)
    return words, cut, _marker(words, t, cut)


def _marker(words: str, text: str, cut: bool) -> str:
    """What a title says about being no first paper; the end of a cut title says nothing."""
    if text.startswith("re") and _REPLY.match(text):
        return "reply"
    for name, pattern in _MARKER:
        for x in _TRIGGER[name]:
            if x in words:
                if (m := pattern.search(words)) and not (cut and m.end() == len(words) and name != "erratum"):
                    return name
                break
    return "part" if text[-1:] in ("2", "3") and not cut and _NUMBER_END.search(text) else ""


def name_words(names: str | None) -> list[list[str]]:
    """The words of three letters and more of every name of a comma-separated list."""
    if not names:
        return []
    if names.isascii() and "&" not in names and "<" not in names:
        split = [n.split() for n in names.lower().encode().translate(_BLANKS_IN_LIST).decode().split(",")]
    else:
        split = [split_words(plain(n.strip())) for n in names.split(",")]
    return [ws for n in split if (ws := [w for w in n if len(w) >= 3 and not w.isdigit()])]


def values(column: pa.Array) -> list:
    """What to_pylist gives of texts, and of numbers and flags without nulls, in a tenth of the time."""
    return column.to_numpy(zero_copy_only=False).tolist()


def cell(word: str) -> int:
    return zlib.crc32(word.encode()) % COUNT_CELLS


_cells = _Known(cell)


class Counts:
    """How many names and how many titles have the words of each cell, over all rows (two tables of COUNT_CELLS).

    The last entry of each table is the number of names, or of titles.
    """

    def __init__(self, names: np.ndarray, titles: np.ndarray):
        self.names, self.titles = names, titles
        #: From so many titles on a word is no typing error.
        self.usual = 30 + 0.0003 * float(titles[-1])


def count_words(rows: DataFrame) -> Counts:
    """The counts of (title, names). What the driver gets is bounded by COUNT_CELLS."""
    size = COUNT_CELLS + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 * size, dtype=np.int64)
        at = _Known(cell)
        for batch in batches:
            found: list[int] = []
            titles, names = [x for x in values(batch.column(0)) if x], 0
            for x in titles:
                found += [at[w] for w in set(split_words(plain(x)))]
            of_titles = len(found)
            for x in values(batch.column(1)):
                for ws in name_words(x):
                    names += 1
                    found += [at[w] for w in (set(ws) if len(ws) > 1 else ws)]
            cells = np.array(found, dtype=np.int64)
            cells[:of_titles] += size
            total += np.bincount(cells, minlength=2 * size)
            total[-1] += len(titles)
            total[COUNT_CELLS] += names
        where = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"cell": pa.array(where), "n": pa.array(total[where])})

    counted = rows.select("title", "names").mapInArrow(run, "cell bigint, n bigint")
    out = np.zeros(2 * size, dtype=np.int64)
    got = counted.groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out[got.column("cell").to_numpy()] = got.column("n").to_numpy()
    return Counts(out[:size], out[size:])


class KeyFinder:
    """Telling words of names under one table of counts; results are kept per list of names."""

    def __init__(self, counts: np.ndarray):
        self.counts, self.limit, self.listed = counts, max(40.0, COMMON_NAME * float(counts[-1])), counts.tolist()
        self.lists = _Known(lambda names: sorted({w for ws in name_words(names) for w in self.of_words(ws)}), 100_000)

    def of_words(self, ws: list[str]) -> list[str]:
        """The telling ones of the words of a name."""
        if len(ws) > 1:
            ws = [w for w in ws if w not in GROUP and w != "the"] or ws
        if len(ws) == 1:  # the only word is the rarest
            return ws
        n = [self.listed[cell(w)] for w in ws]
        bound = min(self.limit, 2 * min(n) + 2)
        return [w for w, m in zip(ws, n, strict=True) if len(w) >= 4 and m <= bound] or [min(zip(n, ws, strict=True))[1]]

    def keys(self, names: str | None) -> list[str]:
        """The words that few names have, or else the rarest word, of every name of a list."""
        if not names:
            return []
        return self.lists[names]


_finders: dict[int, KeyFinder] = {}


def _finder(counts: np.ndarray) -> KeyFinder:
    found = _finders.get(id(counts))
    if found is None or found.counts is not counts:
        _finders.clear()
        found = _finders[id(counts)] = KeyFinder(counts)
    return found


_venues: dict[str, str] = {}


def _venue_words(venue: str | None) -> str:
    if not venue:
        return ""
    found = _venues.get(venue)
    if found is None:
        if len(_venues) > 200_000:
            _venues.clear()
        found = _venues[venue] = "" if venue.strip().lower() in _NO_VENUE else " ".join(split_words(plain(venue)))
    return found


@lru_cache(maxsize=500_000)
def near(a: str, b: str) -> bool:
    """Whether two words differ by typing only: by one edit, by two from six letters on, by three from eleven on.

    An edit is a letter more, less or other, or two neighbours swapped. The words begin or end with the same
    letter, digits must be equal, and beginnings of opposite meaning are no typing.
    """
    return a == b or ((a[:1] == b[:1] or a[-1:] == b[-1:]) and _edits_near(a, b) and not _opposed(a, b))


def _opposed(a: str, b: str) -> bool:
    return min(len(a), len(b)) > 5 and any((a.startswith(x) and b.startswith(y) and a[len(x) :] == b[len(y) :]) or (a.startswith(y) and b.startswith(x) and a[len(y) :] == b[len(x) :]) for x, y in _OPPOSED)


def _edits_near(a: str, b: str) -> bool:
    la, lb = len(a), len(b)
    n = min(la, lb)
    limit = 1 if n < 6 else 2 if n < 11 else 3
    if abs(la - lb) > limit or n < 2 or not (a.isalpha() and b.isalpha()) and _DIGIT.findall(a) != _DIGIT.findall(b):
        return False
    i = 0
    while i < n and a[i] == b[i]:
        i += 1
    j = 0
    while j < n - i and a[la - 1 - j] == b[lb - 1 - j]:
        j += 1
    x, y = a[i : la - j], b[i : lb - j]
    if not x or not y:
        return True
    if len(x) == len(y) == 1 or (len(x) == 2 and x == y[::-1]):
        return True
    if limit == 1 or i + j < 2:
        return False
    own, others = set(x), set(y)
    if len(own - others) > limit or len(others - own) > limit:  # an edit takes away one letter at most
        return False
    before, row = [], list(range(len(y) + 1))
    for r, c in enumerate(x, 1):
        now = [r]
        for k, d in enumerate(y, 1):
            v = min(row[k] + 1, now[k - 1] + 1, row[k - 1] + (c != d))
            if r > 1 and k > 1 and c == y[k - 2] and x[r - 2] == d:
                v = min(v, before[k - 2] + 1)
            now.append(v)
        if min(now) > limit:
            return False
        before, row = row, now
    return row[-1] <= limit


def _titles_with(counts: Counts, word: str) -> int:
    return int(counts.titles[_cells[word]])


def _mistyped(a: str, b: str, counts: Counts | None) -> bool:
    """Whether one of two words is the other with typing errors: not if both are usual words of titles."""
    return near(a, b) and (counts is None or min(_titles_with(counts, a), _titles_with(counts, b)) < counts.usual)


def _explained(left: list[str], right: list[str], known: set[str], counts: Counts | None) -> tuple[list[str], list[str]]:
    """What remains of two lists of words after pairing off words that differ by typing.

    known are words of both titles; a word may also have run together with one of them.
    """
    right = list(right)
    rest = []
    for w in left:
        first, last, size = w[0], w[-1], len(w)
        for v in right:  # the first conditions are those of ``near`` that cost least
            if (v[0] == first or v[-1] == last) and -4 < len(v) - size < 4 and _mistyped(w, v, counts):
                right.remove(v)
                break
        else:
            rest.append(w)
    if rest and right and not (_parts_of(rest, right, known) or _parts_of(right, rest, known)):
        a, b = "".join(rest), "".join(right)
        return ([], []) if len(a) > 5 and _mistyped(a, b, counts) else (rest, right)
    begins = tuple([k for k in known if len(k) > 1])
    for one, other in ((rest, right), (right, rest)):
        for w in list(one):
            if len(w) < 5 or w not in one:
                continue
            if w.startswith(begins) and any(w.startswith(k) and (w[len(k) :] in known) for k in begins):
                one.remove(w)
                continue
            for v in list(other):
                if len(w) > len(v) >= 3 and ((near(w[-len(v) :], v) and (w[: -len(v)] in known or w[: -len(v)] in other)) or (near(w[: len(v)], v) and (w[len(v) :] in known or w[len(v) :] in other))):
                    one.remove(w)
                    other.remove(v)
                    for k in (w[: -len(v)], w[len(v) :]):
                        if k in other:
                            other.remove(k)
                    break
    if rest and right:
        a, b = "".join(rest), "".join(right)
        if len(a) > 5 and _mistyped(a, b, counts):
            return [], []
    return rest, right


def _parts_of(some: list[str], other: list[str], known: set[str]) -> bool:
    """Whether every telling word of some may have run together of other words, or be light or a part of one."""
    parts = ()
    for w in some:
        if w in LIGHT or any([v.startswith(w) or v.endswith(w) for v in other]):
            continue
        parts = parts or (*other, *[k for k in known if len(k) > 1])
        if len(w) < 5 or not (w.startswith(parts) or w.endswith(parts)):
            return False
    return True


def same_title(a: str, b: str, cut_a: bool, cut_b: bool, counts: Counts | None = None) -> int:
    """3: equal letters; 2: equal but for typing, order, repeated or light words, or a missing end; 1: one word inside is missing too; 0: not.

    Titles of different letters share at least about half of the words of the shorter one (see ``alike_words``).
    """
    if a == b:
        return 3
    if a.replace(" ", "") == b.replace(" ", ""):
        return 3
    wa, wb = a.split(), b.split()
    sa, sb = set(wa), set(wb)
    both = sa & sb
    if 2 * len(both) < min(len(sa), len(sb)) - 1:
        return 0
    left = [w for w in dict.fromkeys(wa) if w not in sb]
    right = [w for w in dict.fromkeys(wb) if w not in sa]
    left, right = _explained(left, right, both, counts) if left or right else (left, right)
    heavy_l = [w for w in left if w not in LIGHT]
    heavy_r = [w for w in right if w not in LIGHT]
    if not heavy_l and not heavy_r:
        return 2
    if heavy_l and heavy_r:
        # a word that the shorter text was cut in
        if (cut_a or cut_b) and len(heavy_l) == 1 and heavy_r[0].startswith(heavy_l[0]) and wa[-1] == heavy_l[0]:
            heavy_l = []
        elif (cut_a or cut_b) and len(heavy_r) == 1 and heavy_l[0].startswith(heavy_r[0]) and wb[-1] == heavy_r[0]:
            heavy_r = []
        else:
            joined_l, joined_r = "".join(left), "".join(right)
            return 2 if len(joined_l) > 6 and (joined_l == joined_r or _mistyped(joined_l, joined_r, counts)) else 0
    extra, words, short = (heavy_l, wa, wb) if heavy_l else (heavy_r, wb, wa)
    if len(short) < 4 and not (cut_a or cut_b):
        return 0
    # the longer title goes on after the shorter one, or one word inside is missing
    known = set(short)
    end = len(words)
    while end and (words[end - 1] not in known or words[end - 1] in LIGHT):
        end -= 1
    inner = [w for w in extra if w in words[:end]]
    if not inner and len(short) >= 4:
        return 2
    return 1 if len(inner) == 1 and len(short) >= 5 else 0


def venue_initials(venue: str) -> str:
    """The first letters of the words of a venue; agreeing venues mostly have the same."""
    return "".join(w[0] for w in venue.split() if w not in LIGHT)


def same_venue(a: str, b: str) -> bool | None:
    """Whether two venues agree, abbreviations included; None if one is unknown."""
    if not a or not b:
        return None
    wa = [w for w in a.split() if w not in LIGHT]
    wb = [w for w in b.split() if w not in LIGHT]
    if len(wa) != len(wb):
        return "".join(wa) == "".join(wb)
    return all(x[: min(len(x), len(y))] == y[: min(len(x), len(y))] or near(x, y) for x, y in zip(wa, wb, strict=True))


def same_names(a: list[str], b: list[str]) -> float:
    """Share of the telling name words of the shorter list that the other has, typing aside.

    Mistyped words must begin or end with the same three letters.
    """
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return -1.0
    rest = [w for w in a if w not in b]
    hits = len(a) - len(rest)
    if rest:
        free, close = [w for w in b if w not in a], 0
        for w in rest:
            if len(w) > 4:
                first, last = w[:3], w[-3:]
                for v in free:
                    if (v.startswith(first) or v.endswith(last)) and near(w, v):
                        close += 1
                        break
        hits += sum([0.9] * close)
    return hits / len(a)


def same_paper(t1: str, t2: str, cut1: bool, cut2: bool, m1: str, m2: str, k1, k2, y1: int, y2: int, v1: str, v2: str, counts: Counts | None = None) -> bool:
    """Whether two forms are the same paper. A word missing inside asks for more agreement of everything else."""
    if m1 != m2 or not t1 or not t2:
        return False
    names = same_names(k1, k2)
    return not 0 <= names < LEAST_NAMES and _same_given_names(names, t1, t2, cut1, cut2, " ".join(k1), " ".join(k2), y1, y2, v1, v2, counts)


#: Share of the telling name words of the shorter list that any two versions of a paper have in common.
LEAST_NAMES = 0.25


def _same_given_names(names: float, t1: str, t2: str, cut1: bool, cut2: bool, k1: str, k2: str, y1: int, y2: int, v1: str, v2: str, counts: Counts | None) -> bool:
    """Whether two forms of one marker are the same paper; names is what ``same_names`` says of k1 and k2."""
    titles = same_title(t1, t2, cut1, cut2, counts)
    if not titles:
        return False
    gap = abs(y1 - y2) if y1 and y2 else 0
    venue = same_venue(v1, v2)
    short = min(len(t1), len(t2)) < 22
    if titles == 1 and not (names >= 0.6 and venue is not False and gap <= 1 and (venue or (y1 and y1 == y2) or (" " in k1 and " " in k2))):
        return False
    if names < 0:
        return not short and venue is not False and gap <= 1 and (titles == 3 or venue is True)
    if short:
        return names >= 0.5 and venue is not False and gap <= 2
    if titles == 3:
        return True
    if cut1 or cut2:
        return names >= 0.4 and (venue is not False or gap == 0)
    return names >= 0.3 and (gap <= 1 or venue is not False)


FORM = "rid bigint, h1 bigint, h2 bigint, words string, cut boolean, marker string, keys array<string>, year int, venue string, low bigint, high bigint, n_words int, ends bigint"
_YEAR = regex.compile(r"(?:19|20)\d\d")
#: Which of 128 bits a word has; two of 64 bits for the first and for the last three letters of a name's word.
_bits = _Known(lambda w: zlib.crc32(w.encode()) * 0x9E3779B1 >> 13 & 127)
_ends = _Known(lambda w: 1 << (zlib.crc32(w[:3].encode()) % 61) | 1 << (zlib.crc32(b"-" + w[-3:].encode()) % 61))


def _joined_bits(bits: np.ndarray, sizes: np.ndarray) -> list[int]:
    """The bits of each list of so many numbers, as one number a list."""
    out, some = np.zeros(len(sizes), np.int64), np.flatnonzero(sizes)
    if len(some):
        out[some] = np.bitwise_or.reduceat(bits, (np.cumsum(sizes) - sizes)[some])
    return out.tolist()


def masks(words: list[str], keys: list[list[str]]) -> dict[str, list]:
    """The columns low and high (128 bits, one for each word of a title), n_words (distinct) and ends (of names)."""
    own = [set(t.split()) for t in words]
    n_words, n_keys = (np.fromiter(map(len, x), np.int64, len(x)) for x in (own, keys))
    bit = np.array([_bits[w] for x in own for w in x], np.int64)
    one = np.left_shift(np.int64(1), bit & 63)
    ends = np.array([_ends[w] for k in keys for w in k], np.int64)
    return {"low": _joined_bits(np.where(bit < 64, one, 0), n_words), "high": _joined_bits(np.where(bit < 64, 0, one), n_words), "n_words": n_words.tolist(), "ends": _joined_bits(ends, n_keys)}


#: Columns of a form that ``alike_masks`` needs, suffixed with 1 and 2.
MASKS = ("low", "high", "n_words", "ends")


def alike_words():
    """Condition on the suffixed MASKS that no pair fails whose titles share about half of their words.

    Two titles share at most as many words as their masks share bits, plus the words that fell on one bit
    within the title that has fewer of these.
    """
    bits = lambda i: F.bit_count(f"low{i}") + F.bit_count(f"high{i}")
    clash = lambda i: F.col(f"n_words{i}") - bits(i)
    both = F.bit_count(F.col("low1").bitwiseAND(F.col("low2"))) + F.bit_count(F.col("high1").bitwiseAND(F.col("high2")))
    return 2 * (both + F.least(clash(1), clash(2))) >= F.least("n_words1", "n_words2") - 1


def alike_names():
    """Condition on the suffixed MASKS that no pair fails of which some names begin or end alike, or one has none."""
    return (F.col("ends1") == 0) | (F.col("ends2") == 0) | (F.col("ends1").bitwiseAND(F.col("ends2")) != 0)


def ends_of_names(forms: DataFrame) -> DataFrame:
    """forms with first3 and last3: for the first and for the last three letters of every word of keys one of 64 bits."""
    bits = lambda end: F.aggregate("keys", F.lit(0).cast("bigint"), lambda m, k: m.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(F.xxhash64(end(k, F.lit(3))), F.lit(64)).cast("int"))))
    return forms.withColumns({"first3": bits(F.left), "last3": bits(F.right)})


def alike_ends():
    """What ``alike_names`` says, by the sharper masks first3 and last3, suffixed with 1 and 2."""
    meet = lambda c: F.col(f"{c}1").bitwiseAND(F.col(f"{c}2")) != 0
    return (F.col("first31") == 0) | (F.col("first32") == 0) | meet("first3") | meet("last3")


#: Letters of a name's word in its code: one of so many bits for each; above them its length (2 bits) and its ends (3 and 3).
LETTER_BITS = 24
#: Forms with more names have no codes; word pairs that are compared at a time.
MOST_CODES, WORD_PAIRS = 255, 1 << 20


def _name_code(word: str) -> int:
    """32 bits of a name's word: its letters, how many edits are typing (see ``near``), its first and last three letters."""
    m = 0
    for c in word:
        m |= 1 << ord(c) % LETTER_BITS
    n = len(word)
    return m | ((n > 5) + (n > 10)) << LETTER_BITS | (zlib.crc32(word[:3].encode()) & 7) << 26 | (zlib.crc32(word[-3:].encode()) & 7) << 29


_name_codes = _Known(_name_code)


def code_lists(years: list[int], keys: list[list[str]]) -> pa.Array:
    """For each form its year and then the codes of its name words, 4 bytes each; null if there are more than MOST_CODES.

    Bytes, as Spark takes the size of an Arrow batch after every row, which for lists reads the whole batch.
    """
    size = np.fromiter(map(len, keys), np.int64, len(keys))
    many = size > MOST_CODES
    if many.any():
        keys, size = [() if m else k for k, m in zip(keys, many.tolist(), strict=True)], np.where(many, 0, size)
    codes = np.fromiter([_name_codes[w] for k in keys for w in k], np.uint32, int(size.sum()))
    end = np.cumsum(size + 1)
    all_, first = np.empty(int(end[-1]) if len(end) else 0, np.uint32), end - size - 1
    named = np.ones(len(all_), bool)
    named[first] = False
    all_[first], all_[named] = np.array(years, np.uint32), codes
    ends = np.concatenate([[0], 4 * end]).astype(np.int32)
    lists = pa.Array.from_buffers(pa.binary(), len(keys), [None, pa.py_buffer(ends), pa.py_buffer(all_)])
    return pc.if_else(pa.array(many), pa.scalar(None, pa.binary()), lists) if many.any() else lists


def _read_codes(lists: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(all numbers, where those of each list begin, how many it has: none if it is null)."""
    if not len(lists):
        return np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)
    _, ends, data = lists.buffers()
    at = np.frombuffer(ends, np.int32)[lists.offset : lists.offset + len(lists) + 1].astype(np.int64) // 4
    flat = np.frombuffer(data, np.uint32, int(at[-1])) if data is not None else np.zeros(0, np.uint32)
    return flat, at[:-1], np.where(lists.is_null().to_numpy(zero_copy_only=False), 0, np.diff(at))


def _runs_of(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places begin, begin + 1, ... of runs of these sizes, one run after the other."""
    return np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


def alike_codes(one: pa.Array, other: pa.Array) -> np.ndarray:
    """Which pairs of ``code_lists`` may be the same paper: no pair fails that ``same_paper`` takes.

    Enough words of the shorter list must have one in the other that may be a typing of it: a beginning or an end
    alike and, either way, no more strange letters than edits are allowed. Without names on one side the years agree.
    Pairs with a null pass.
    """
    (f1, b1, n1), (f2, b2, n2) = _read_codes(one), _read_codes(other)
    codes, b2 = np.concatenate([f1, f2]), b2 + len(f1)
    passed = np.ones(len(n1), bool)
    blank = np.flatnonzero(np.minimum(n1, n2) == 1)
    y1, y2 = (codes[b[blank]].astype(np.int64) for b in (b1, b2))
    passed[blank] = (y1 == 0) | (y2 == 0) | (np.abs(y1 - y2) <= 1)
    named = np.flatnonzero(np.minimum(n1, n2) > 1)
    portion = np.cumsum((n1 * n2)[named]) // WORD_PAIRS
    for rows in np.split(named, np.flatnonzero(np.diff(portion)) + 1) if len(named) else ():
        swap = n1[rows] > n2[rows]
        short, long = np.where(swap, n2[rows], n1[rows]) - 1, np.where(swap, n1[rows], n2[rows]) - 1
        begin, begin_long = np.where(swap, b2[rows], b1[rows]) + 1, np.where(swap, b1[rows], b2[rows]) + 1
        words, against = _runs_of(begin, short), np.repeat(long, short)
        a, b = np.repeat(codes[words], against), codes[_runs_of(np.repeat(begin_long, short), against)]
        x = a ^ b
        # a pair with alike ends, and not more letters on a side that the other lacks than edits
        edits = 1 + np.minimum(a >> np.uint32(LETTER_BITS) & np.uint32(3), b >> np.uint32(LETTER_BITS) & np.uint32(3))
        strange = x & np.uint32((1 << LETTER_BITS) - 1)
        may = ((x & np.uint32(7 << 26)) == 0) | ((x & np.uint32(7 << 29)) == 0)
        may &= (np.bitwise_count(strange & a) <= edits) & (np.bitwise_count(strange & b) <= edits)
        met = np.logical_or.reduceat(may, np.cumsum(against) - against)
        passed[rows] = np.add.reduceat(met, np.cumsum(short) - short, dtype=np.int64) >= LEAST_NAMES * short
    return passed


def form_lists(titles: list, names: list, years: list, venues: list, counts: Counts) -> dict[str, list]:
    """The columns of FORM (but rid and hashes) for a batch."""
    finder = _finder(counts.names)
    seen: dict[str | None, tuple[str, bool, str]] = {}
    forms = []
    for t in titles:
        form = seen.get(t)
        if form is None:
            form = seen[t] = title_form(t)
        forms.append(form)
    words = [t[0] for t in forms]
    keys = [finder.keys(x) for x in names]
    return {
        "words": words,
        "cut": [t[1] for t in forms],
        "marker": [t[2] for t in forms],
        "keys": keys,
        "year": [int(m.group()) if y and (m := _YEAR.search(y)) else 0 for y in years],
        "venue": [_venue_words(v) for v in venues],
    } | masks(words, keys)


_ARROW = {"words": pa.string(), "cut": pa.bool_(), "marker": pa.string(), "keys": pa.list_(pa.string()), "year": pa.int32(), "venue": pa.string(), "low": pa.int64(), "high": pa.int64(), "n_words": pa.int32(), "ends": pa.int64()}


def form_arrays(batch: pa.RecordBatch, counts: Counts) -> tuple[dict[str, list], dict[str, pa.Array]]:
    """(lists, Arrow columns) of FORM for a batch with columns rid, h1, h2, title, names, year, venue."""
    column = lambda c: batch.column(batch.schema.get_field_index(c))
    lists = form_lists(*(values(column(c)) for c in ("title", "names", "year", "venue")), counts)
    return lists, {c: column(c) for c in ("rid", "h1", "h2")} | {c: pa.array(lists[c], t) for c, t in _ARROW.items()}


# Placeholders of a venue.
_NO_VENUE = frozenset(["-", "n/a", "null", "none", "n.d.", "nd", "unknown venue", "[no journal]", "unknown", ""])


def names_of_json(column):
    """The names of a JSON array as one comma-separated text; broken JSON gives null. Commas inside names become blanks."""
    return F.array_join(F.transform(F.from_json(column, "array<string>"), lambda x: F.regexp_replace(x, ",", " ")), ", ")


_COMPARED = ["keys", "words", "cut", "year", "venue"]


def verify(pairs: DataFrame, left: DataFrame, right: DataFrame, counts: Counts, gather: bool = False, met: bool = False) -> DataFrame:
    """The pairs (rid1, rid2) whose forms are the same paper; left and right are the forms of the two sides.

    Pairs travel as ids; the forms join them only here. With gather, pairs that came from many tasks are shuffled
    before the check, so that Spark can size its tasks (for few pairs against a large store). met: pairs were
    chosen by ``alike_ends``, so their names aren't compared before.
    """
    shared = pairs.sparkSession.sparkContext.broadcast(counts)  # two tables of COUNT_CELLS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        for batch in batches:
            # names first: pairs that they settle need no further columns
            names = [same_names(a.split(), b.split()) for a, b in zip(values(batch.column(2)), values(batch.column(3)), strict=True)]
            open_ = [not 0 <= n < LEAST_NAMES for n in names]
            batch = batch.filter(pa.array(open_, pa.bool_()))
            columns = [values(batch.column(2 + i)) for i in range(2 * len(_COMPARED))]
            k1, k2, t1, t2, cut1, cut2, y1, y2, v1, v2 = columns
            left = [n for n, o in zip(names, open_, strict=True) if o]
            keep = [_same_given_names(*x, counts) for x in zip(left, t1, t2, cut1, cut2, k1, k2, y1, y2, v1, v2, strict=True)]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    form = lambda df, i: df.select(*[(F.array_join(c, " ") if c == "keys" else F.col(c)).alias(f"{c}{i}") for c in ("rid", "marker", *_COMPARED)])
    joined = pairs.select("rid1", "rid2").join(form(right, 2), "rid2").join(form(left, 1), "rid1").where("marker1 = marker2")
    part = lambda c, end: F.transform(F.split(c, " "), lambda x: end(x, F.lit(3)))
    alike = F.expr("keys1 = '' or keys2 = ''") | F.arrays_overlap(part("keys1", F.left), part("keys2", F.left)) | F.arrays_overlap(part("keys1", F.right), part("keys2", F.right))
    joined = joined if met else joined.where(alike)
    return (joined.repartition("rid1", "rid2") if gather else joined).select("rid1", "rid2", *[f"{c}{i}" for c in _COMPARED for i in (1, 2)]).mapInArrow(run, "rid1 bigint, rid2 bigint")


def keyed(rows: DataFrame) -> DataFrame:
    """rows with h1 and h2, 128 bits of hash of title, names, year and venue."""
    cols = ["title", "names", "year", "venue"]
    whole = [F.coalesce(F.col(c).cast("string"), F.lit("\x01")) for c in cols]
    return rows.withColumn("h1", F.xxhash64(*whole)).withColumn("h2", F.xxhash64(F.lit(71), *whole))


def contents(rows: DataFrame) -> DataFrame:
    """Distinct contents (rid, h1, h2, title, names, year, venue) of rows (id, title, names, year, venue).

    Exact copies share the smallest id as rid; they are merged on the map side, and texts are shuffled once.
    """
    cols = ["title", "names", "year", "venue"]
    first = keyed(rows).groupBy("h1", "h2").agg(F.min("id").alias("rid"), *[F.any_value(c).alias(c) for c in cols])
    return first.select("rid", "h1", "h2", *cols)


def links(rows: DataFrame, forms: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """(id, extra..., rid): the content of every row."""
    return keyed(rows).select("id", *extra, "h1", "h2").join(forms.select("h1", "h2", "rid"), ["h1", "h2"]).select("id", *extra, "rid")
