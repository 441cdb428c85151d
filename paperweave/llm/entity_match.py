"""Matching papers across sources without keys: walk embeddings, hyperplane blocks, exact reranking.

Records and the words of their attributes form a graph. Random walks over it (record, word, record, ...)
train skip-gram vectors of words; a table of letter-run vectors made of them gives every word of every
record a vector, seen in training or not. Hyperplane codes of the title's vector (several tables) and
of the vector of each telling name word are the blocks. All pairs that share a block
and about half of their title's words are reranked by the exact comparison of their fields, and the cosine of
the signatures is calibrated to a confidence on a bounded sample of reranked pairs.

The vectors are fitted on at most SAMPLE records; every record is indexed and compared. Codes of titles
get longer with the number of records, so their blocks don't grow with it.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.durable import Scratch
from . import papers

#: Records that the vectors are fitted on; walks from each, and their steps.
SAMPLE, WALKS, STEPS = 8_000, 2, 6
#: Size of a vector, and cells of the table of letter runs.
DIM, CELLS = 48, 1 << 14
#: Tables of titles, and bits of a name word's code.
TABLES, NAME_BITS = 4, 44
#: Words that are made vectors of at a time.
PORTION = 4_096
#: A block with more rows than this on a side is split by the words of the title.
HOT_BLOCK = 4_000
#: Pairs that the calibration is fitted on.
CALIBRATION = 20_000


#: Marks of blocks: of a name's word, of equal letters; other blocks are below.
NAMED, LETTERS = 1 << 60, 1 << 61


def _mixed(code: int, text: str) -> int:
    """A block of a code together with a text."""
    return (code * 0x9E3779B97F4A7C15 ^ zlib.crc32(text.encode()) * 0x632BE59BD9B4E019) & ((1 << 59) - 1)


def _runs(word: str) -> list[int]:
    w = f"<{word}>".encode()
    return [zlib.crc32(w[i : i + 3]) % CELLS for i in range(len(w) - 2)] + [zlib.crc32(w) % CELLS]


#: What each of three bytes adds to their crc32.
_THREE = [np.array([zlib.crc32(bytes([0] * i + [b] + [0] * (2 - i))) ^ zlib.crc32(bytes(3)) for b in range(256)], np.int64) for i in range(3)]


def _all_runs(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(cells of the runs of all words, where each word's begin): ``_runs`` of many words at once."""
    texts = [f"<{w}>".encode() for w in words]
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    end = np.cumsum(size)
    b = np.frombuffer(b"".join(texts), np.uint8)
    cells = np.zeros(len(b), np.int64)
    cells[:-2] = (_THREE[0][b[:-2]] ^ _THREE[1][b[1:-1]] ^ _THREE[2][b[2:]] ^ zlib.crc32(bytes(3))) % CELLS
    cells[end - 2] = np.array([zlib.crc32(t) for t in texts], np.int64) % CELLS  # the whole word, after its runs
    used = np.ones(len(b), bool)
    used[end - 1] = False
    return cells[used], end - size - np.arange(len(words))


def _identity(seed: int = 5) -> np.ndarray:
    """Random vectors of the cells; the same in every process."""
    return np.random.default_rng(seed).standard_normal((CELLS, DIM)).astype(np.float32)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-9)


def _sum_runs(table: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The sum of the rows of a table at the places of each run, in their order; runs of these sizes follow each other in at.

    The first rows of all runs are added at once, then the second ones and so on: a fraction of the time of reduceat.
    """
    order = np.argsort(-size, kind="stable")  # the longest first: runs that go on are the first ones
    begin = (np.cumsum(size) - size)[order]
    more = len(size) - np.cumsum(np.bincount(size)) if len(size) else ()
    sums = np.zeros((len(size), table.shape[1]), table.dtype)
    for i, n in enumerate(more[:-1]):
        sums[:n] += table[at[begin[:n] + i]]
    out = np.empty_like(sums)
    out[order] = sums
    return out


def _add_rows(table: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    """Adds rows to those of a table at indices that may repeat."""
    order = np.argsort(at, kind="stable")
    sorted_at = at[order]
    first = np.flatnonzero(np.concatenate([[True], sorted_at[1:] != sorted_at[:-1]]))
    table[sorted_at[first]] += np.add.reduceat(rows[order], first, axis=0)


def train(records: list[list[str]], seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """(vectors of the cells, records per cell of whole words) from the words of sampled records."""
    rng = np.random.default_rng(seed)
    seen: dict[str, int] = {}
    lists = [[seen.setdefault(w, len(seen)) for w in set(r)] for r in records if r]
    counts = np.zeros(CELLS, np.float32)
    if len(lists) < 2:
        return np.zeros((CELLS, DIM), np.float32), counts
    words = list(seen)
    cells = [_runs(w) for w in words]
    base = _identity()
    start = _unit(np.stack([base[c].sum(0) for c in cells]))
    vec, ctx = start.copy(), np.zeros_like(start)
    flat = np.concatenate([np.array(x) for x in lists])
    size = np.array([len(x) for x in lists])
    begin = np.cumsum(size) - size
    owner = np.repeat(np.arange(len(lists)), size)
    order = np.argsort(flat, kind="stable")
    of_word, n_word = owner[order], np.bincount(flat, minlength=len(words))
    begin_word = np.cumsum(n_word) - n_word
    paths = []
    for _ in range(WALKS):
        rec, path = np.arange(len(lists)), []
        for _ in range(STEPS):
            w = flat[begin[rec] + (rng.random(len(rec)) * size[rec]).astype(np.int64)]
            rec = of_word[begin_word[w] + (rng.random(len(rec)) * n_word[w]).astype(np.int64)]
            path.append(w)
        paths.append(np.stack(path, 1))
    walks = np.concatenate(paths)
    centre = np.concatenate([walks[:, i] for d in (1, 2) for i in range(STEPS - d)])
    context = np.concatenate([walks[:, i + d] for d in (1, 2) for i in range(STEPS - d)])
    shuffle = rng.permutation(len(centre))
    noise = n_word**0.75 / (n_word**0.75).sum()
    pool = rng.choice(len(words), 1 << 18, p=noise)
    step = 0.05
    for at in range(0, len(shuffle), 4096):
        pick = shuffle[at : at + 4096]
        c, o = centre[pick], context[pick]
        for target, label in ((o, 1.0), *((pool[rng.integers(0, len(pool), len(c))], 0.0) for _ in range(3))):
            g = (label - 1 / (1 + np.exp(-np.einsum("ij,ij->i", vec[c], ctx[target]).clip(-8, 8))))[:, None].astype(np.float32) * step
            up, down = g * ctx[target], g * vec[c]
            _add_rows(vec, c, up)
            _add_rows(ctx, target, down)
    out, n = np.zeros((CELLS, DIM), np.float32), np.zeros(CELLS, np.float32)
    delta = vec - start
    for i, cs in enumerate(cells):
        out[cs] += delta[i]
        n[cs] += 1
        counts[cs[-1]] += n_word[i]
    return out / np.maximum(n, 1)[:, None], counts


class Index:
    """Word vectors, weights and hyperplanes in one Python worker."""

    def __init__(self, vectors: np.ndarray, counts: np.ndarray, total: int, bits: int):
        self.table = _identity() + 4.0 * vectors
        self.counts, self.total, self.bits = counts, max(total, 1), bits
        rng = np.random.default_rng(23)
        name_planes = rng.standard_normal((DIM, NAME_BITS)).astype(np.float32)
        self.sign_planes = rng.standard_normal((DIM, 64)).astype(np.float32)
        self.title_planes = rng.standard_normal((DIM, TABLES * bits)).astype(np.float32)
        # which side of a plane a name is on, as sums of whole numbers: equal words have equal codes in whatever company
        whole = lambda x: np.rint(x.astype(np.float64) * 256)
        self.name_sides = (whole(self.table) @ whole(name_planes)).astype(np.int64)
        self.vectors, self.used = np.zeros((1 << 12, DIM), np.float32), 0
        self.rows: dict[str, int] = {}
        self.codes: dict[str, int] = {}

    def _learn(self, words: list[str]) -> None:
        """Makes vectors of words, at self.rows in self.vectors."""
        words = [w for w in dict.fromkeys(words) if w not in self.rows]
        while self.used + len(words) > len(self.vectors):
            self.vectors = np.concatenate([self.vectors, np.zeros_like(self.vectors)])
        for i in range(0, len(words), PORTION):
            some = words[i : i + PORTION]
            cells, begin = _all_runs(some)
            v = _sum_runs(self.table, cells, np.diff(begin, append=len(cells)))
            rare = np.log1p(self.total / (1.0 + self.counts[cells[np.append(begin[1:], len(cells)) - 1]])) / math.log1p(self.total)
            weight = (0.2 + rare) * np.array([0.3 if w in papers.LIGHT else 1.0 for w in some])
            self.vectors[self.used : self.used + len(some)] = v * (weight / np.maximum(np.linalg.norm(v, axis=1), 1e-9))[:, None]
            self.rows.update(zip(some, range(self.used, self.used + len(some)), strict=True))
            self.used += len(some)

    def _learn_names(self, words: list[str]) -> None:
        """Makes codes of name words, in self.codes."""
        words = [w for w in dict.fromkeys(words) if w not in self.codes]
        for i in range(0, len(words), PORTION):
            some = words[i : i + PORTION]
            cells, begin = _all_runs(some)
            bits = _sum_runs(self.name_sides, cells, np.diff(begin, append=len(cells))) > 0
            self.codes.update(zip(some, (bits @ (1 << np.arange(NAME_BITS, dtype=np.int64)) | NAMED).tolist(), strict=True))

    def _sums(self, lists: list[list[str]]) -> np.ndarray:
        """The sum of the vectors of each list of words."""
        flat = [w for x in lists for w in x]
        self._learn(flat)
        rows = np.fromiter([self.rows[w] for w in flat], np.int64, len(flat))
        return _sum_runs(self.vectors, rows, np.fromiter(map(len, lists), np.int64, len(lists)))

    def _codes(self, vectors: np.ndarray) -> np.ndarray:
        """A code for every table, marked with the table's number."""
        low = (vectors @ self.title_planes > 0).reshape(len(vectors), TABLES, self.bits).astype(np.int64)
        return (low << np.arange(self.bits)).sum(2) | (np.arange(1, TABLES + 1, dtype=np.int64) << 50)

    def describe(self, words: list[str], keys: list[list[str]]) -> tuple[np.ndarray, list[list[int]]]:
        """(64-bit signatures, block codes) of a batch of forms. A title's words count once, in any order."""
        if self.used > 300_000:
            self.used = 0
            self.rows.clear()
        if len(self.codes) > 300_000:
            self.codes.clear()
        self._learn_names([w for k in keys for w in k])
        titles = self._sums([sorted(set(t.split())) for t in words])
        bits = (titles @ self.sign_planes > 0).astype(np.uint64)
        signature = (bits << np.arange(64, dtype=np.uint64)).sum(1, dtype=np.uint64).astype(np.int64)
        codes = self._codes(titles).tolist()
        blocks, names = [], self.codes
        for i, k in enumerate(keys):
            letters = words[i].replace(" ", "").encode()
            whole = zlib.crc32(letters) << 24 ^ zlib.adler32(letters)  # equal letters meet whatever their words
            if len(words[i]) >= 22:
                blocks.append([*{names[w] for w in k}, whole | LETTERS, *codes[i]])
            else:
                # short titles are shared by many papers, and match only with a name: their letters count with its beginning
                blocks.append([*{names[w] for w in k}, *{_mixed(whole, w[:3]) for w in k}])
        return signature, blocks


_FORM = papers.FORM + ", signature bigint, blocks array<bigint>, codes binary"
#: What a block tells of a form besides its id; a block of a name's word tells nothing of the names.
_OF_NAMES = ("first3", "last3", "codes")
_JOINED = ("low", "high", "n_words", "marker", *_OF_NAMES)
_indexes: dict[int, Index] = {}


def fit(samples: DataFrame) -> tuple[np.ndarray, np.ndarray, int]:
    """Vectors of the cells, word counts, and size of the sample (rid, title, names, year, venue), which is bounded."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for t, n, y, v in zip(pdf["title"], pdf["names"], pdf["year"], pdf["venue"], strict=True):
            words = papers.title_form(t)[0].split()
            words += [w for ws in papers.name_words(n) for w in ws if len(w) > 3]
            words += [f"v:{w}" for w in papers._WORDS.findall(papers.plain(v or ""))] + ([f"y:{y}"] if y else [])
            rows.append(words)
        vectors, counts = train(rows)
        return pd.DataFrame({"cell": np.arange(CELLS), "n": counts, "vector": list(vectors), "total": len(rows)})

    got = samples.groupBy(F.lit(1).alias("one")).applyInPandas(run, "cell int, n float, vector array<float>, total bigint").toPandas()  # CELLS rows
    vectors, counts = np.zeros((CELLS, DIM), np.float32), np.zeros(CELLS, np.float32)
    if len(got):
        vectors[got["cell"]] = np.stack(got["vector"])
        counts[got["cell"]] = got["n"]
    return vectors, counts, int(got["total"].max()) if len(got) else 0


def index(content: DataFrame, counts: papers.Counts, model: tuple[np.ndarray, np.ndarray, int], bits: int) -> DataFrame:
    """FORM rows with signature, blocks and codes."""
    shared = content.sparkSession.sparkContext.broadcast((counts, *model))  # CELLS x DIM and COUNT_CELLS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, vectors, cells, total = shared.value
        key = id(shared.value)
        if key not in _indexes:
            _indexes.clear()
            _indexes[key] = Index(vectors, cells, total, bits)
        for batch in batches:
            lists, arrays = papers.form_arrays(batch, counts)
            signature, blocks = _indexes[key].describe(lists["words"], lists["keys"])
            yield pa.RecordBatch.from_pydict(arrays | {"signature": pa.array(signature), "blocks": pa.array(blocks, pa.list_(pa.int64())), "codes": papers.code_lists(lists["year"], lists["keys"])})

    return content.mapInArrow(run, _FORM).where("words <> ''")


def _blocks(forms: DataFrame, hot: DataFrame, number: int) -> DataFrame:
    """(block, rid, masks, marker, codes), suffixed: one row per block of a form. Forms without codes have nulls.

    Hot blocks are split: those of a name by every telling word of the title, those of a title by the first and
    the last three letters of every name (and one part for rows without names, which meet all others).
    """
    forms = papers.ends_of_names(forms.withColumn("marker", F.xxhash64("marker")))
    codes = F.col("codes") if "codes" in forms.columns else F.lit(None).cast("binary")
    rows = forms.withColumn("codes", codes).select("rid", *_JOINED, "words", "keys", F.explode("blocks").alias("block"))
    # rows that share a name's word meet it: masks of zero and codes of null pass
    of_title = F.col("block").bitwiseAND(NAMED) == 0
    rows = rows.withColumns({c: F.when(of_title, F.col(c)).otherwise(F.lit(None if c == "codes" else 0)) for c in _OF_NAMES})
    marked = rows.join(hot.select("block", F.lit(True).alias("is_hot")), "block", "left")
    light = F.array(*[F.lit(w) for w in sorted(papers.LIGHT)])
    telling = F.array_except(F.split("words", " "), light)
    ends = F.array_distinct(F.concat(F.transform("keys", lambda k: F.substring(k, 1, 3)), F.transform("keys", lambda k: F.concat(F.lit("-"), F.right(k, F.lit(3))))))
    # a row without names on one side meets every row of the other
    own, others = F.lit(f"{number}"), F.lit(f"{3 - number}")
    by_names = F.when(F.size("keys") > 0, F.concat(ends, F.array(others))).otherwise(F.array(own, others))
    parts = F.when(F.col("is_hot").isNull(), F.array(F.lit(None).cast("string"))).when(F.col("block").bitwiseAND(NAMED) != 0, telling).otherwise(by_names)
    split = marked.withColumn("part", F.explode(parts))
    mark = F.col("block").bitwiseAND(LETTERS)
    block = F.when(F.col("part").isNull(), F.col("block")).otherwise(F.xxhash64("block", "part").bitwiseAND(~LETTERS).bitwiseOR(mark))
    return split.select(block.alias("block"), *[F.col(c).alias(f"{c}{number}") for c in ("rid", *_JOINED)])


def block_pairs(left: DataFrame, right: DataFrame, scratch: Scratch) -> DataFrame:
    """(rid1, rid2) of all rows that share a block and may share about half of the words of the shorter title.

    In blocks of titles names, where both have some, must be such that enough of them may be typings of each other,
    and years must agree where names are missing (see ``papers.alike_codes``).
    """
    sides = left.select("blocks").unionByName(right.select("blocks"))
    least = max(2, HOT_BLOCK // max(1, sides.rdd.getNumPartitions()))

    def often(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a block with more than HOT_BLOCK rows has at least ``least`` of them in some partition
        seen = [b.column(0).flatten().to_numpy(zero_copy_only=False) for b in batches]
        block, n = np.unique(np.concatenate(seen) if seen else np.zeros(0, np.int64), return_counts=True)
        yield pa.RecordBatch.from_pydict({"block": pa.array(block[n >= least], pa.int64()), "n": pa.array(n[n >= least], pa.int64())})

    hot = scratch.keep(sides.mapInArrow(often, "block bigint, n bigint").groupBy("block").agg(F.sum("n").alias("n")).where(F.col("n") > HOT_BLOCK), "hot")
    pairs = _blocks(left, hot, 1).join(_blocks(right, hot, 2), "block")
    near = pairs.where("marker1 = marker2").where(papers.alike_words() | (F.col("block").bitwiseAND(LETTERS) != 0)).where(papers.alike_ends())

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.select([0, 1]).filter(pa.array(papers.alike_codes(batch.column(2), batch.column(3)), pa.bool_()))

    return near.select("rid1", "rid2", "codes1", "codes2").mapInArrow(met, "rid1 bigint, rid2 bigint").distinct()


def differing_bits(pairs: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """pairs (rid1, rid2, ...) with differ, the bits in which their signatures differ."""
    a, b = left.select(F.col("rid").alias("rid1"), F.col("signature").alias("s1")), right.select(F.col("rid").alias("rid2"), F.col("signature").alias("s2"))
    return pairs.join(a, "rid1").join(b, "rid2").withColumn("differ", F.bit_count(F.col("s1").bitwiseXOR(F.col("s2")))).drop("s1", "s2")


def calibrate(cosines: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve fitted by Newton steps with a weak prior."""
    x = np.stack([cosines, np.ones_like(cosines)], 1)
    beta = np.zeros(2)
    for _ in range(30):
        p = 1 / (1 + np.exp(-(x @ beta).clip(-30, 30)))
        grad = x.T @ (labels - p) - 0.01 * beta
        hess = (x * (p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(2)
        beta += np.linalg.solve(hess, grad)
    return float(beta[0]), float(beta[1])


def match(candidates: DataFrame, dump: DataFrame) -> DataFrame:
    """(candidate_id, record_id, confidence): pairs that are the same paper, one row per distinct pair.

    Titles without letters or digits match nothing. Names, year and venue may be null, blank or broken
    JSON, and then count as unknown. Repeated rows don't repeat pairs. Empty tables give no rows.
    """
    spark = candidates.sparkSession
    scratch = Scratch(spark, "match")
    rows1 = candidates.select("id", "candidate_id", F.col("raw_title").alias("title"), F.col("raw_authors").alias("names"), F.col("year_guess").alias("year"), F.col("venue_guess").alias("venue"))
    rows2 = dump.select(F.col("record_id").alias("id"), "title", papers.names_of_json("authors_json").alias("names"), "year", "venue")
    titled = F.col("title").rlike(r"[\p{L}\p{N}]")
    rows1, rows2 = rows1.where(titled).where("candidate_id is not null"), rows2.where(titled)
    both = rows1.drop("candidate_id").unionByName(rows2)
    counts = papers.count_words(both)
    n = int(counts.titles[-1])
    sample = both.where(F.pmod(F.xxhash64("title", "id"), F.lit(max(1, math.ceil(n / SAMPLE)))) == 0).limit(2 * SAMPLE)
    model = fit(sample)
    # one bit more for twice the records
    bits = min(40, max(8, math.ceil(math.log2(n + 2)) - 2))
    forms1 = scratch.keep(index(papers.contents(rows1), counts, model, bits), "candidates")
    forms2 = scratch.keep(index(papers.contents(rows2), counts, model, bits), "records")
    pairs = scratch.keep(block_pairs(forms1, forms2, scratch), "pairs")
    same = scratch.keep(papers.verify(pairs, forms1, forms2, counts, met=True), "same")
    n_pairs = pairs.count()
    some = F.pmod(F.xxhash64("rid1", "rid2"), F.lit(max(1, math.ceil(n_pairs / CALIBRATION)))) == 0
    asked = pairs.where(some).limit(2 * CALIBRATION).join(same.withColumn("label", F.lit(1)), ["rid1", "rid2"], "left")
    labelled = differing_bits(asked, forms1, forms2).select("differ", F.coalesce("label", F.lit(0)).alias("label")).toPandas()  # at most 2 x CALIBRATION rows
    slope, offset = calibrate(np.cos(np.pi * labelled["differ"].to_numpy(np.float64) / 64), labelled["label"].to_numpy(np.float64)) if len(labelled) else (0.0, 0.0)
    confidence = 1 / (1 + F.exp(-(F.lit(slope) * F.cos(F.col("differ") * (math.pi / 64)) + F.lit(offset))))
    scored = differing_bits(same, forms1, forms2)
    found = scored.join(papers.links(rows1, forms1, ("candidate_id",)).select("candidate_id", F.col("rid").alias("rid1")).distinct(), "rid1").join(papers.links(rows2, forms2).select(F.col("id").alias("record_id"), F.col("rid").alias("rid2")), "rid2")
    return found.groupBy("candidate_id", "record_id").agg(F.min("differ").alias("differ")).select("candidate_id", "record_id", F.round(confidence, 6).alias("confidence"))
