"""Per-document text quality: statistics and a robust distance from prose.

One pass over each whole text gives its statistics. Per language, mean and covariance of prose are
estimated robustly: starting from the medians, the moments of the half of the documents nearest to the
present centre are taken again and again (concentration steps) until they settle, as sums that every
partition contributes. Only deviations away from prose count (fewer sentences, more marks, and so on). A document's
squared Mahalanobis distance decides whether it is prose, and splits into one contribution per statistic; what
contributes most decides whether an outlier is a list, a table or junk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.durable import Scratch
from ..tables import width

# Common words by language, then words that mostly occur in clauses.
COMMON = {
    "en": "the of and to in a is that for it as was with be by on not he his but at are this have from or had an they which one were all we when there can who has been if would than about into could after other our it's its no more before most such these those may did during between each both only how what your",
    "de": "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis mehr durch man wurde wurden wir ob zwischen gruppe",
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il sont avec nous ont été être cette aux d'une à après chez entre l'étude n'avons dont mais ou si leur ces n'a sans deux",
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o pero sus le ha me si sin sobre este ya entre cuando todo esta ser son dos también fue había era muy hasta desde está nos durante tras fueron hubo",
}
COMMON |= {
    "it": "il di che la e un in per è con non una si da al del della le dei nel alla sono come più ha anche ma gli lo o i delle dalla stato state nei tra essere questo questa hanno era",
    "pt": "o de que e do da em um para é com não uma os no se na por mais as dos como mas foi ao das tem à seu sua ou quando muito nos já também só pelo pela até isso ela entre era depois sem mesmo foram",
    "nl": "de het een en van in is dat op te zijn met voor niet aan er om ook als bij maar door over uit nog naar heeft hebben wordt werd deze dit die tot of geen meer was tussen worden",
    "ru": "и в не на что с по как из у за от для к но это было были был при до или также их после все так мы не он она они более между без если",
}
COMMON_JA = "のはをにがとでもたてるしなれすか"
COMMON_ZH = "的了在是和我们不有中为与者对个后于以可仍需"
CLAUSE = "was were is are be been being has have had did does do can could will would should may might must we i it they you this that there these those which when who not whether if because although nobody wurde wurden ist sind war waren hat haben konnte konnten wir dass ob bleibt est sont été ont avons avait était nous n'a que qui fue fueron es son ha han hubo está no se"
TERMINAL = ".!?。！？…"

_LANGUAGES = list(COMMON)
_COMMON = {k: frozenset(v.split()) for k, v in COMMON.items()}
_CLAUSE = frozenset(CLAUSE.split())
_ZH, _JA = frozenset(COMMON_ZH), frozenset(COMMON_JA)
#: Per common word of two letters and more the languages that have it, as bits.
_HAS = {w: sum(1 << i for i, k in enumerate(_LANGUAGES) if w in _COMMON[k]) for w in frozenset().union(*_COMMON.values()) if len(w) > 1}
#: Least share of a language's common words in a text, and how many different ones, for it to be told; below, it counts as the first language.
LEAST_COMMON, LEAST_DIFFERENT = 0.1, 3
_WORD = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}]|[\p{L}\p{M}\p{N}]+(?:['’\-.][\p{L}\p{M}\p{N}]+)*")
_MARK = regex.compile(r"^\s*(?:[-–—•*‣◦▪●○·→>»✓☐☑+]\s|\[[ xX]?\]\s|\[?\(?\d{1,3}[\])]\s?|\d{1,3}[.:]\s|\(?[a-zA-Zivx]{1,4}\)\s|[a-z]\.\s|#\d+\s|\(\d{1,3}\)|§)")
_TAG = regex.compile(r"<[^<>\s][^<>]{0,200}>")
_CELLTAG = regex.compile(r"<t[dhr]\b|\\begin\{tabular", regex.I)
_URL = regex.compile(r"(?:https?://|www\.)\S+")
_SENT = regex.compile(r"[^.!?。！？]+(?:[.!?](?=\S)[^.!?。！？]*)*[.!?。！？]+|[^.!?。！？]+$")
_BOX = regex.compile(r"[│┃║|+\-─━═┌┐└┘├┤┬┴┼╔╗╚╝╠╣╦╩╬=:\s]+")
_GAP = regex.compile(r"(?<=\S) {3,}(?=\S)")
_SEMI = regex.compile(r";(?!\s)")
_COMMA = regex.compile(r",(?!\s)")
_LEADER = regex.compile(r"\.{4,}|…{2,}|(?:\. ){4,}")

#: The statistics in the order of the result's columns.
STATS = ["log_words", "mean_word_length", "symbol_ratio", "digit_ratio", "terminal_lines", "common_words", "clause_words", "sentence_share", "marked_lines", "entry_lines", "cell_lines", "separators", "repetition", "odd_words", "url_share"]
_SCHEMA = "doc_id bigint, language string, n_words bigint, mean_words_per_line double, " + ", ".join(f"{s} double" for s in STATS)


def _cells(line: str) -> int:
    """Cells of a line under the delimiter that gives most of them; 0 or 1 if it is no row."""
    best = 0
    for d in ("\t", "|", "│"):
        if d in line:
            best = max(best, line.count(d) + 1)
    best = max(best, len(_GAP.findall(line)) + 1)
    for d, tight in ((";", _SEMI), (",", _COMMA)):
        if d in line and len(found := tight.findall(line)) == line.count(d) and len(found) > 1:
            best = max(best, len(found) + 1)
    return best


_ALNUM, _SPACE, _DIGIT, _ALPHA, _STRANGE, _BROKEN, _HAN = (1 << i for i in range(7))


def _flags() -> np.ndarray:
    """What kinds of character each code point is."""
    out = np.zeros(0x110000, np.uint8)
    for i in range(0x30000):
        c = chr(i)
        out[i] = _ALNUM * c.isalnum() | _SPACE * c.isspace() | _DIGIT * c.isdigit() | _ALPHA * (c.isalpha() or c == " ")
    for c in "§¶¤¬~^`\\{}<>_�":
        out[ord(c)] |= _STRANGE
    for c in "ÂÃâ€™Ÿ¼Œ�¤§¶":
        out[ord(c)] |= _BROKEN
    out[0x4E00:0xA000] |= _HAN
    out[0x3040:0x3100] |= _HAN
    return out


_kinds: list[np.ndarray] = []
_odd: dict[str, bool] = {}


def _kinds_of(text: str) -> np.ndarray:
    if not _kinds:
        _kinds.append(_flags())
    return _kinds[0][np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)]


def _odd_word(w: str) -> bool:
    found = _odd.get(w)
    if found is None:
        if len(_odd) > 300_000:
            _odd.clear()
        vowels = any(c in "aeiouyäöüáéíóúàèêâîôûåøæœ" or ord(c) > 0x24F for c in w)
        mixed = len(w) > 5 and any(c.isdigit() for c in w) and any(c.isalpha() for c in w)
        found = _odd[w] = (len(w) > 3 and w.isalpha() and not vowels) or len(w) > 30 or mixed
    return found


def _language(lower: list[str], han: int) -> tuple[str, int]:
    """(language, common words) of the words of a text."""
    if han * 2 > len(lower):
        kana = sum(1 for w in lower if "\u3040" <= w < "\u3100")
        return ("ja", sum(1 for w in lower if w in _JA)) if kana * 5 > len(lower) else ("zh", sum(1 for w in lower if w in _ZH))
    seen: dict[int, int] = {}
    get = _HAS.get
    for w in lower:
        if (m := get(w)) is not None:
            seen[m] = seen.get(m, 0) + 1
    hits = [sum(n for m, n in seen.items() if m >> i & 1) for i in range(len(_LANGUAGES))]
    best = max(range(len(hits)), key=lambda i: (hits[i], i == 0))
    if best and (hits[best] < LEAST_COMMON * len(lower) or len(_COMMON[_LANGUAGES[best]].intersection(lower)) < LEAST_DIFFERENT):
        best = 0
    known = _COMMON[_LANGUAGES[best]]
    return _LANGUAGES[best], sum(1 for w in lower if w in known)


def _sentences(joined: str, language: str) -> int:
    """Letters of a text that are in sentences: of 4 to 90 words, some of them common, and mostly letters."""
    kinds = _kinds_of(joined)
    alpha = np.concatenate([[0], np.cumsum((kinds & _ALPHA) > 0)])
    han = np.concatenate([[0], np.cumsum((kinds & _HAN) > 0)]) if language in ("zh", "ja") else None
    common = _COMMON.get(language, _ZH)
    good = 0
    for m in _SENT.finditer(joined):
        i, j = m.span()
        if joined[j - 1] not in ".!?。！？":
            continue
        if han is not None:
            k = han[j] - han[i]
            if k >= 5 and 2 * k > j - i:
                good += j - i
            continue
        ws = m.group().lower().split()
        k = len(ws)
        if 4 <= k <= 90 and alpha[j] - alpha[i] > 0.75 * (j - i) and sum(1 for w in ws if w in common or w.strip(".,;:!?()\"'’") in common) >= 0.15 * k:
            good += j - i
    return good


def describe(text: str) -> tuple:
    """(language, n_words, mean words per line, *STATS) of a text. Blank texts give language None and zeros."""
    if not text or not text.strip():
        return (None, 0, 0.0, *[0.0] * len(STATS))
    plain, tables, items = text, 0, 0
    if "<" in text or "\\" in text:
        tables = len(_CELLTAG.findall(text))
        items = text.count("<li")
        plain = _TAG.sub(" ", regex.sub(r"</?(?:p|br|div|li|ul|ol|h\d)\b[^<>]*>", "\n", text))
    kinds = _kinds_of(plain)
    count = lambda flag: int(np.count_nonzero(kinds & flag))
    chars = (len(plain) - count(_SPACE)) or 1
    urls = sum(len(u) for u in _URL.findall(plain)) if "http" in plain or "www." in plain else 0
    lower = _WORD.findall(plain.lower())
    n = len(lower) or 1
    language, hits = _language(lower, count(_HAN))
    common = hits / n
    clause = common if language in ("zh", "ja") else sum(1 for w in lower if w in _CLAUSE) / n
    symbols = (chars - count(_ALNUM)) / chars
    digits = count(_DIGIT) / chars
    lines = [x for x in plain.split("\n") if x.strip()] or [""]
    m = len(lines)
    terminal = sum(1 for x in lines if x.rstrip(" \"'”»)")[-1:] in TERMINAL) / m
    size = sum(map(len, lines)) or 1
    marks = [bool(_MARK.match(x)) for x in lines]
    marked = sum(len(x) for x, k in zip(lines, marks, strict=True) if k or (".." in x or "…" in x or ". ." in x) and _LEADER.search(x)) / size
    if items:
        marked = max(marked, min(1.0, items / max(1, m - 1)))
    # a marked entry may go on in the next line, which has no mark
    if 0.3 < marked < 0.8 and m >= 4:
        covered = sum(len(x) for i, x in enumerate(lines) if marks[i] or (i and marks[i - 1] and (i + 1 == m or marks[i + 1])))
        marked = max(marked, covered / size)
    entry = 0
    if m >= 3:
        for i, x in enumerate(lines):
            s = x.strip()
            follow = lines[i + 1].lstrip()[:1] if i + 1 < m else ""
            if s[-1:] not in ".!?。！？;:,-" and not follow.islower() and len(s) < 200:
                entry += len(x)
    tabular = _tabular(lines, size)
    if tables >= 2:
        tabular = 1.0
    seps = 0.0 if tables >= 2 else min(1.0, (plain.count(";") + plain.count("|") + plain.count("·") + plain.count("•") + plain.count(",") + plain.count(" / ")) / n)
    joined = " ".join(plain.split())
    good = _sentences(joined, language)
    expected = 1 - min(1.0, (60 + n**0.75) / n)
    repetition = max(0.0, 1 - len(set(lower)) / n - max(0.0, expected)) ** 2
    odd = 0.0
    if language not in ("zh", "ja"):
        odd = sum(1 for w in lower if _odd_word(w)) / n
        single = sum(1 for w in lower if len(w) == 1 and w.isalpha()) / n
        odd = max(odd, single if single > 0.6 else 0.0)
    if tabular < 0.3 and marked < 0.3:
        odd = max(odd, min(1.0, 4 * count(_STRANGE) / chars))
    broken = count(_BROKEN) / chars
    odd = max(odd, min(1.0, 5 * broken) if broken > 0.1 else 0.0)
    return (language, len(lower), n / m, float(np.log1p(len(lower))), sum(map(len, lower)) / n, symbols, digits, terminal, common, clause, good / (len(joined) or 1), min(1.0, marked), entry / size, tabular, seps, repetition, odd, min(1.0, urls / chars))


def _tabular(lines: list[str], size: int) -> float:
    """Share of the text in rows of cells."""
    if len(lines) < 2:
        return 0.0
    cells = [_cells(x) if "\t" in x or "|" in x or "│" in x or ";" in x or "," in x or "   " in x else 1 for x in lines]
    rows = [c for c in cells if c >= 2]
    boxed = [bool(_BOX.fullmatch(x)) for x in lines]
    usual = max(set(rows), key=rows.count) if rows else 0
    tabular = sum(len(x) for x, c, b in zip(lines, cells, boxed, strict=True) if c >= 2 and (abs(c - usual) <= 1 or b)) / size
    rules = sum(len(x) for x, b in zip(lines, boxed, strict=True) if b)
    return min(1.0, tabular + rules / size * (tabular > 0.2)) if rules < 0.6 * size else 0.0


def _describe_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = ["language", "n_words", "mean_words_per_line", *STATS]
    for pdf in batches:
        out = pd.DataFrame([describe(t) for t in pdf["text"]], columns=names)
        out.insert(0, "doc_id", pdf["doc_id"].to_numpy())
        yield out


def statistics(documents: DataFrame) -> DataFrame:
    """(doc_id, language, n_words, mean_words_per_line, STATS...): one row per document.

    Null, empty and blank texts get language null and zeros. language is told from the text itself
    (en, de, fr, es, it, pt, nl, ru, zh, ja), not from the column lang.
    """
    n = width(documents.sparkSession)
    return documents.select("doc_id", "text").repartition(n, "doc_id").mapInPandas(_describe_batches, _SCHEMA)


#: Scale of each statistic: its square is added to the variances, so a constant one can't explode.
FLOOR = dict(zip(STATS, [0.6, 0.5, 0.03, 0.03, 0.3, 0.06, 0.04, 0.15, 0.1, 0.25, 0.1, 0.15, 0.05, 0.05, 0.1], strict=True))
#: Which deviations lead away from prose: larger values (1), smaller ones (-1), neither (0: length of text and words).
AWAY = dict(zip(STATS, [0, 0, 1, 1, 0, -1, -1, -1, 1, 1, 1, 1, 1, 1, 1], strict=True))
#: Squared distance beyond which a document is no prose.
CUTOFF = 42.0
#: Contribution from which strange words and the like make junk; outliers with less of everything are items, unless
#: the repetition itself is beyond REPEATED.
TELLING, REPEATED = 5.0, 0.6
#: Documents that the estimate of all languages together counts as in that of each, and bins of the distance.
POOLED, BINS = 50.0, 96
_SIGN = np.array([AWAY[k] for k in STATS], float)
_RIDGE = np.array([FLOOR[k] for k in STATS], float) ** 2


def _parts(x: np.ndarray, mean: np.ndarray, inverse: np.ndarray) -> np.ndarray:
    """The contribution of each statistic to the squared distance of each row of x."""
    d = np.where(_SIGN == 0, 0.0, (x - mean) * _SIGN).clip(min=0) * _SIGN
    return d * (d @ inverse)


def _bin(d2: np.ndarray) -> np.ndarray:
    """Bins of equal ratio, so that half of the rows can be told from counts."""
    return np.clip(np.log2(np.maximum(d2, 1e-6)) * 4 + 56, 0, BINS - 1).astype(np.int64)


def _moments(stats: DataFrame, model: dict) -> dict[str, list[tuple[int, np.ndarray, np.ndarray]]]:
    """Per language and bin of the distance the count, sums and products; BINS rows per language reach the driver."""
    k = len(STATS)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[tuple[str, int], np.ndarray] = {}
        for pdf in batches:
            for language, own in pdf.groupby("language"):
                x = own[STATS].to_numpy(float)
                b = _bin(_parts(x, *model[language]).sum(1))
                for at in np.unique(b):
                    y = x[b == at]
                    row = np.concatenate([[len(y)], y.sum(0), (y.T @ y).ravel()])
                    total[language, int(at)] = total.get((language, int(at)), 0) + row
        if total:
            yield pd.DataFrame({"language": [t[0] for t in total], "bin": [t[1] for t in total], "sums": list(total.values())})

    out: dict[str, dict[int, np.ndarray]] = {}
    for r in stats.select("language", *STATS).mapInPandas(run, "language string, bin int, sums array<double>").toLocalIterator():
        own = out.setdefault(r["language"], {})
        own[r["bin"]] = own.get(r["bin"], 0) + np.array(r["sums"])
    found: dict[str, list] = {}
    for language, bins in out.items():
        found[language] = [(bins[b][0], bins[b][1 : k + 1], bins[b][k + 1 :].reshape(k, k)) for b in sorted(bins)]
    return found


def _nearest_half(bins: list[tuple]) -> tuple[float, np.ndarray, np.ndarray]:
    """Count, sums and products of the nearest bins that hold half of the rows."""
    need = sum(b[0] for b in bins) / 2
    n, total, products = 0.0, 0, 0
    for count, sums, squares in bins:
        n, total, products = n + count, total + sums, products + squares
        if n >= need:
            break
    return n, total, products


def _model(halves: dict[str, tuple]) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Mean and inverse covariance per language; that of all languages counts as POOLED documents in each."""
    n = sum(h[0] for h in halves.values())
    mean, square = sum(h[1] for h in halves.values()) / n, sum(h[2] for h in halves.values()) / n
    out = {}
    for language, (own, sums, products) in halves.items():
        m = (sums + POOLED * mean) / (own + POOLED)
        cov = (products + POOLED * square) / (own + POOLED) - np.outer(m, m)
        out[language] = (m, np.linalg.inv(cov + np.diag(_RIDGE)))
    return out


def distances(documents: DataFrame, steps: int = 20, tolerance: float = 0.03) -> DataFrame:
    """The statistics with d2 and contributions (array in the order of STATS, which sums to d2); blank texts are left out.

    More than half of the documents of a language must be prose for its estimate to be one of prose. Steps end
    when no mean moves by more than ``tolerance`` of the statistic's scale.
    """
    scratch = Scratch(documents.sparkSession, "quality")
    stats = scratch.keep(statistics(documents).where("language is not null"), "stats")
    medians = stats.groupBy("language").agg(*[F.percentile_approx(k, 0.5).alias(k) for k in STATS]).collect()  # a row per language
    if not medians:
        return stats.selectExpr("*", "0D as d2", "array() :: array<double> as contributions")
    model = {r["language"]: (np.array([r[k] for k in STATS], float), np.diag(1 / (4 * _RIDGE))) for r in medians}
    # rows of statistics are small: a task for every 20,000 of them
    few = stats.coalesce(max(1, stats.count() // 20_000))
    for _ in range(steps):
        new = _model({language: _nearest_half(bins) for language, bins in _moments(few, model).items()})
        moved = max(float((np.abs(new[k][0] - model[k][0]) / np.sqrt(_RIDGE)).max()) for k in new)
        model = new
        if moved < tolerance:
            break

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            parts = np.zeros((len(pdf), len(STATS)))
            for language, at in pdf.groupby("language").indices.items():
                parts[at] = _parts(pdf[STATS].to_numpy(float)[at], *model[language])
            yield pdf.assign(d2=parts.sum(axis=1), contributions=list(parts))

    return stats.mapInPandas(score, _SCHEMA + ", d2 double, contributions array<double>")


def classify(rows: DataFrame) -> DataFrame:
    """Adds text_class: prose within the cutoff; else what contributes most to the distance decides.

    Rows of cells make a table; marks, entries and separators a list; strange words and signs, links and repeated words
    junk, if they contribute more than TELLING. Strange and repeated words weigh less than marks, as lists have short forms
    and headings, and symbols don't tell one from the other.
    """
    part = lambda *names: sum((F.element_at("contributions", STATS.index(k) + 1) for k in names), F.lit(0.0))
    cells, marks = 3 * part("cell_lines"), part("marked_lines", "entry_lines", "separators")
    junk = 0.5 * part("odd_words") + part("url_share") + 0.15 * part("repetition")
    kind = F.when(F.col("d2") <= CUTOFF, "prose").when((cells > 0) & (cells >= F.greatest(marks, junk)), "table").when((junk > F.greatest(marks, F.lit(TELLING))) | ((marks <= TELLING) & (F.col("repetition") > REPEATED)), "junk").otherwise("list")
    return rows.withColumn("text_class", kind)


def not_prose(documents: DataFrame) -> DataFrame:
    """(doc_id, text_class) of documents that are mostly not running sentences."""
    return classify(distances(documents)).where("text_class <> 'prose'").select("doc_id", "text_class")


def outliers(documents: DataFrame) -> DataFrame:
    """Every non-blank document with its statistics, d2, class and the contribution of each statistic."""
    rows = classify(distances(documents))
    parts = [F.round(F.element_at("contributions", i + 1), 6).alias(f"from_{s}") for i, s in enumerate(STATS)]
    return rows.select("doc_id", "language", "n_words", "mean_words_per_line", *STATS, F.round("d2", 6).alias("d2"), *parts, "text_class")
