"""Deduplicating new batches against all history with winnowed fingerprints and partitioned Bloom filters.

The content of a row is its title and its names. The letters of a title are winnowed: of every window of
runs the one with the smallest hash is kept, wherever in the title it lies. Fingerprints are hashes of a kept
run together with a telling word of a name, of two kept runs that follow one another together with the initials
of the venue (rows whose names are missing or misspelt match by that, or by equal words), and of the set of words.

A ``Store`` is a folder: the forms of accepted contents with their fingerprints, one Bloom filter per partition
of the fingerprint space, and the counts of words that forms depend on, frozen when the store was built. Each
accepted batch adds a generation of forms and filters; nothing of the raw history is read again. A batch sends
its fingerprints to their partitions, drops those that all filters exclude, looks the others up in the store,
keeps pairs whose words cover one another, verifies them exactly, and is added.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.durable import Scratch
from ..tables import width
from . import papers

#: Letters of a run, and runs in a window of winnowing.
RUN, WINDOW = 6, 24
#: Rows of ids and masks (at most 48 bytes each) up to which a batch's side of a join is broadcast.
SMALL = 600_000
#: Hashes per fingerprint and bits of a filter per fingerprint; fingerprints that one partition is made for.
BLOOM_HASHES, BLOOM_RATE, PART_LOAD = 4, 12, 400_000


def _mix(x: int) -> int:
    """A 64-bit mix of an integer, as a signed value."""
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & 0xFFFFFFFFFFFFFFFF
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB & 0xFFFFFFFFFFFFFFFF
    x ^= x >> 31
    return x - (1 << 64) if x >> 63 else x


def winnow(letters: str) -> list[int]:
    """Hashes of the runs kept, in their order: the smallest (the last of equal ones) of every window.

    Texts that share RUN + WINDOW - 1 letters in a row keep a run in common.
    """
    b = letters.encode("utf-32-le")
    runs = [zlib.crc32(b[i : i + 4 * RUN]) for i in range(0, max(1, len(b) - 4 * RUN + 4), 4)]
    kept, at = [], -1
    for start in range(max(1, len(runs) - WINDOW + 1)):
        end = min(start + WINDOW, len(runs))
        if at < start:
            low = min(runs[start:end])
            at = max(i for i in range(start, end) if runs[i] == low)
        elif runs[end - 1] <= runs[at]:
            at = end - 1
        else:
            continue
        kept.append(runs[at])
    return list(dict.fromkeys(kept))


def fingerprints(words: str, keys: list[str], venue: str) -> list[int]:
    """The fingerprints of a form."""
    letters = words.replace(" ", "")
    kept = winnow(letters)
    out = {_mix((zlib.crc32(k.encode()) << 32 | r) ^ 0x5851F42D4C957F2D) for k in keys for r in kept}
    if venue:
        at = zlib.crc32(papers.venue_initials(venue).encode())
        out |= {_mix((r << 32 | q) ^ at * 0x2545F491) for r, q in zip(kept, kept[1:] or kept, strict=False)}
    if len(letters) >= 20:
        out.add(_mix(zlib.crc32(" ".join(sorted(set(words.split()))).encode()) << 3 | 5))
    return list(out)


_FORM = papers.FORM + ", prints array<bigint>"


def _forms(content: DataFrame, counts: papers.Counts) -> DataFrame:
    shared = content.sparkSession.sparkContext.broadcast(counts)  # two tables of COUNT_CELLS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, arrays = papers.form_arrays(batch, shared.value)
            prints = [fingerprints(w, k, v) if w else [] for w, k, v in zip(lists["words"], lists["keys"], lists["venue"], strict=True)]
            yield pa.RecordBatch.from_pydict(arrays | {"prints": pa.array(prints, pa.list_(pa.int64()))})

    return content.mapInArrow(run, _FORM).where("words <> ''")


def _listed(forms: DataFrame, parts: int, *columns: str) -> DataFrame:
    """(part, fp, columns...): the fingerprints of forms and the partitions that they belong to."""
    out = forms.select(*columns, F.explode("prints").alias("fp"))
    return out.select(F.pmod(F.shiftright("fp", 7), F.lit(parts)).cast("int").alias("part"), "fp", *columns)


def _positions(fp: np.ndarray, bits: int) -> np.ndarray:
    h = fp.astype(np.uint64)
    a, b = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    return (a[:, None] + np.arange(BLOOM_HASHES, dtype=np.uint64) * b[:, None]) % np.uint64(bits)


def build_filters(listed: DataFrame, parts: int, total: int) -> DataFrame:
    """(part, bits): the Bloom filter of each partition of (part, fp), sized for total fingerprints in all."""
    bits = max(1 << 12, int(BLOOM_RATE * total / parts * 1.3) // 8 * 8)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        filters: dict[int, np.ndarray] = {}
        for pdf in batches:
            for part, own in pdf.groupby("part"):
                b = filters.setdefault(part, np.zeros(bits // 8, np.uint8))
                at = _positions(own["fp"].to_numpy(), bits).ravel()
                np.bitwise_or.at(b, (at >> np.uint64(3)).astype(np.int64), (1 << (at & np.uint64(7))).astype(np.uint8))
        if filters:
            yield pd.DataFrame({"part": list(filters), "bits": [b.tobytes() for b in filters.values()]})

    # a task for every 200,000 fingerprints, so small batches start few
    tasks = max(1, min(parts, width(listed.sparkSession), total // 200_000 + 1))
    return listed.select("part", "fp").repartition(tasks, "part").mapInPandas(run, "part int, bits binary")


def prescreen(asked: DataFrame, filters: DataFrame) -> DataFrame:
    """The rows of asked (part, fp, rid) whose fingerprint any filter of its partition may hold."""

    def run(own: pd.DataFrame, filt: pd.DataFrame) -> pd.DataFrame:
        hit = np.zeros(len(own), bool)
        for one in filt["bits"]:
            bits = np.frombuffer(one, np.uint8)
            at = _positions(own["fp"].to_numpy(), 8 * len(bits))
            hit |= ((bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(axis=1)
        return own[hit]

    return asked.groupBy("part").cogroup(filters.groupBy("part")).applyInPandas(run, "part int, fp bigint, rid bigint")


def _small(df: DataFrame, most: int = SMALL) -> DataFrame:
    """A written table marked for broadcast if it has at most so many rows (they are counted); else as it is."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


class Store:
    """Accepted contents in a folder: generations of forms and of filters, and the counts they were built with.

    Ids of the history are kept as even numbers and those of batches as odd ones, so they can't clash.
    """

    def __init__(self, spark: SparkSession, folder: str, counts: papers.Counts, parts: int, generations: int):
        self.spark, self.folder, self.counts, self.parts, self.generations = spark, folder, counts, parts, generations

    @property
    def forms(self) -> DataFrame:
        return self.spark.read.schema(_FORM).parquet(*[f"{self.folder}/forms-{g}" for g in range(self.generations)])

    @property
    def filters(self) -> DataFrame:
        return self.spark.read.schema("part int, bits binary").parquet(*[f"{self.folder}/filters-{g}" for g in range(self.generations)])

    def add(self, forms: DataFrame) -> None:
        """Accept forms as a new generation."""
        g = self.generations
        forms.write.parquet(f"{self.folder}/forms-{g}")
        kept = self.spark.read.schema(_FORM).parquet(f"{self.folder}/forms-{g}")
        total = kept.agg(F.sum(F.size("prints"))).head()[0] or 0
        if not self.parts:  # the first generation sets the partitions
            self.parts = max(width(self.spark), int(total / PART_LOAD) + 1)
        build_filters(_listed(kept, self.parts), self.parts, total).write.parquet(f"{self.folder}/filters-{g}")
        self.generations = g + 1
        self._note()

    def _note(self) -> None:
        row = (self.generations, self.parts)
        self.spark.createDataFrame([row], "generations int, parts int").write.mode("overwrite").parquet(f"{self.folder}/state")

    @classmethod
    def build(cls, content: DataFrame, counts: papers.Counts, folder: str) -> Store:
        """A store of distinct contents; its counts stay as they are from now on."""
        spark = content.sparkSession
        table = pa.table({"names": counts.names, "titles": counts.titles, "cell": np.arange(len(counts.names))})
        spark.createDataFrame(table).write.parquet(f"{folder}/counts")
        store = cls(spark, folder, counts, 0, 0)
        store.add(_forms(content, counts))
        return store

    @classmethod
    def open(cls, spark: SparkSession, folder: str) -> Store:
        """The store kept in a folder."""
        got = spark.read.parquet(f"{folder}/counts").toArrow().sort_by("cell")  # COUNT_CELLS rows
        state = spark.read.parquet(f"{folder}/state").head()
        return cls(spark, folder, papers.Counts(got.column("names").to_numpy(), got.column("titles").to_numpy()), state["parts"], state["generations"])


def screen(store: Store, content: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """((rid) of the batch's contents that are the same paper as one in the store or an earlier one of the batch, forms).

    The batch's fingerprints that pass the filters, and then its candidate pairs, are written and counted: up to
    SMALL rows they are broadcast and the store is read without being shuffled, beyond that both sides are shuffled.
    """
    new = scratch.keep(_forms(content, store.counts), "new")
    few = new if new.limit(SMALL // 20 + 1).count() > SMALL // 20 else F.broadcast(new)
    asked = _listed(new, store.parts, "rid")
    positive = _small(scratch.keep(prescreen(asked, store.filters).select("fp", F.col("rid").alias("rid1")), "positive"))
    mine = few.select(*[F.col(c).alias(f"{c}1") for c in ("rid", *papers.MASKS)])
    side = lambda f: _listed(f, store.parts, "rid", *papers.MASKS).select("fp", *[F.col(c).alias(f"{c}2") for c in ("rid", *papers.MASKS)])
    old = side(store.forms).join(positive, "fp")
    fresh = side(new).join(asked.select("fp", F.col("rid").alias("rid1")), "fp").where("rid2 < rid1")
    covered = lambda df: df.join(mine, "rid1").where(papers.alike_words() & papers.alike_names()).select("rid1", "rid2").distinct()
    pairs = _small(scratch.keep(covered(old).unionByName(covered(fresh)), "pairs"))
    alike = papers.verify(pairs, few, store.forms.unionByName(new), store.counts, gather=True).select("rid1")
    literal = store.forms.select("h1", "h2").join(few.select(F.col("rid").alias("rid1"), "h1", "h2"), ["h1", "h2"]).select("rid1")
    return scratch.keep(alike.unionByName(literal).distinct().select(F.col("rid1").alias("rid")), "repeated"), new


def update(store: Store, new: DataFrame) -> None:
    """Accept the forms of a batch, in place: a generation of forms and filters is written, the others stay."""
    store.add(new)


def _rows(table: DataFrame, odd: int) -> DataFrame:
    cols = [F.col("raw_title").alias("title"), F.col("raw_authors").alias("names"), F.col("year_guess").alias("year"), F.col("venue_guess").alias("venue")]
    return table.select((F.col("id") * 2 + odd).alias("id"), *cols).where(F.col("title").rlike(r"[\p{L}\p{N}]"))


def accept_batch(store: Store, batch: DataFrame) -> DataFrame:
    """(id) of the rows of a batch that are no new paper; the batch's contents are added to the store."""
    scratch = Scratch(store.spark, "batch")
    rows = _rows(batch, 1)
    repeated, new = screen(store, papers.contents(rows), scratch)
    link = papers.links(rows, new)
    update(store, new)
    literal = link.where("id > rid").select("id")
    near = link.join(repeated, "rid").select("id")
    return scratch.keep(literal.unionByName(near).distinct().select(F.shiftright("id", 1).alias("id")), "ids")


def open_history(history: DataFrame, folder: str | None = None) -> Store:
    """A store of the accepted rows, in a folder of its own unless one is given."""
    folder = folder or Scratch(history.sparkSession, "store").root
    rows = _rows(history, 0)
    return Store.build(papers.contents(rows), papers.count_words(rows), folder)


def repeated_rows(history: DataFrame, batches: DataFrame) -> DataFrame:
    """(id) of batch rows that are the same paper as a history row or a batch row with a smaller id.

    Batches are taken one after the other in the order of batch_no (null last); each meets the store that the
    ones before left. Ids must rise with batch_no and lie within 62 bits. Rows without a title are no case. Null
    and blank names or venues are unknown: such rows repeat a paper only by an equal long title. Rows with an
    equal title, names, year and venue are copies and count from the second on; so do batch rows whose copy is
    in the history. Further columns are ignored; empty tables give no rows.
    """
    store = open_history(history)
    numbers = sorted((r[0] for r in batches.select("batch_no").distinct().collect()), key=lambda n: (n is None, n or 0))  # one row per batch
    out = None
    for n in numbers:
        found = accept_batch(store, batches.where(F.col("batch_no").eqNullSafe(F.lit(n))))
        out = found if out is None else out.unionByName(found)
    return batches.select("id").limit(0) if out is None else out
