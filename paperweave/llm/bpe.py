"""Encoding of a corpus with a public byte-level BPE vocabulary, in DuckDB per partition.

Texts are cut into words by the vocabulary's pattern. Every distinct word that a task has not met yet is
encoded by a recursive query: rows (word, position, token) join the merge table, the leftmost pair of
minimum rank of each word is contracted (with all later places of that pair, which come next in any case),
and so on until no pair of a word is in the table; an ordered aggregation gives the ids of each word. Texts
never leave their task, so nothing but the input is shuffled, and no word is hot.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from ..tables import width

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
#: Fixed value: the pattern that cuts texts into words.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words a task keeps with their ids; beyond that it forgets them and encodes them again when they return.
KEPT_WORDS = 400_000
#: Words that one recursive query takes.
QUERY_WORDS = 20_000

_ENCODE = """
WITH RECURSIVE step AS (
    SELECT w, p, t, 0 AS i FROM initial
  UNION ALL
    (WITH pairs AS (
        SELECT s.w, s.p, s.t, s.i, lead(s.t) OVER win AS nt, row_number() OVER win AS k
        FROM step s WINDOW win AS (PARTITION BY s.w ORDER BY s.p)),
     ranked AS (SELECT p.*, m.rank, m.merged FROM pairs p LEFT JOIN merges m ON m.l = p.t AND m.r = p.nt),
     best AS (SELECT *, min(rank) OVER (PARTITION BY w) AS least FROM ranked),
     hit AS (SELECT *, coalesce(rank = least, false) AS h FROM best WHERE least IS NOT NULL),
     runs AS (SELECT *, k - coalesce(max(CASE WHEN NOT h THEN k END) OVER (PARTITION BY w ORDER BY k ROWS UNBOUNDED PRECEDING), 0) AS place FROM hit),
     joined AS (SELECT *, h AND place % 2 = 1 AS starts FROM runs),
     kept AS (SELECT *, coalesce(lag(starts) OVER (PARTITION BY w ORDER BY k), false) AS eaten FROM joined)
     SELECT w, p, CASE WHEN starts THEN merged ELSE t END AS t, i + 1 AS i FROM kept WHERE NOT eaten)
)
SELECT w, list(t ORDER BY p) AS ids FROM (SELECT *, max(i) OVER (PARTITION BY w) AS last FROM step) WHERE i = last GROUP BY w ORDER BY w
"""


def _byte_letters() -> list[str]:
    """The printable letter that stands for each byte in vocabulary files of this kind."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class Encoder:
    """Encodes words in one Python worker; the merge table is loaded once."""

    def __init__(self, vocabulary: str):
        with open(vocabulary, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab = model["vocab"]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.byte_id = np.array([vocab[c] for c in _byte_letters()], dtype=np.int32)
        # batches of words are bounded, so nothing needs to be spilt to a disk of the worker
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "500MB", "temp_directory": ""})
        merges = pa.table({"l": pa.array([vocab[a] for a, _ in pairs], pa.int32()), "r": pa.array([vocab[b] for _, b in pairs], pa.int32()), "rank": pa.array(range(len(pairs)), pa.int32()), "merged": pa.array([vocab[a + b] for a, b in pairs], pa.int32())})
        self.db.register("merges_in", merges)
        self.db.execute("CREATE TABLE merges AS SELECT * FROM merges_in")
        self.db.unregister("merges_in")
        self.find = regex.compile(PATTERN).findall
        self.known: dict[str, np.ndarray] = {}

    def learn(self, words: list[str]) -> None:
        """Encodes words that are not known yet."""
        for at in range(0, len(words), QUERY_WORDS):
            part = words[at : at + QUERY_WORDS]
            raw = [w.encode() for w in part]
            sizes = np.fromiter(map(len, raw), np.int64, len(raw))
            w = np.repeat(np.arange(len(raw), dtype=np.int64), sizes)
            p = np.arange(len(w), dtype=np.int64) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            t = self.byte_id[np.frombuffer(b"".join(raw), np.uint8)]
            self.db.register("initial_in", pa.table({"w": w, "p": p, "t": t}))
            self.db.execute("CREATE OR REPLACE TEMP TABLE initial AS SELECT * FROM initial_in")
            self.db.unregister("initial_in")
            found = self.db.sql(_ENCODE).to_arrow_table()
            ids = found.column("ids").combine_chunks()
            values, offsets = ids.values.to_numpy(zero_copy_only=False).astype(np.int32), ids.offsets.to_numpy()
            for i, word in enumerate(part):
                self.known[word] = values[offsets[i] : offsets[i + 1]]

    def encode(self, texts: list[str | None]) -> pa.Array:
        """The ids of each text as an Arrow list; empty for null and empty texts."""
        if len(self.known) > KEPT_WORDS:
            self.known.clear()
        cut = [self.find(t) if t else [] for t in texts]
        new = {w for ws in cut for w in ws if w not in self.known}
        if new:
            self.learn(sorted(new))
        known = self.known
        parts = [known[w] for ws in cut for w in ws]
        lengths = [sum(len(known[w]) for w in ws) for ws in cut]
        values = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))


_encoders: dict[str, Encoder] = {}


def _encoder(vocabulary: str) -> Encoder:
    if vocabulary not in _encoders:
        _encoders[vocabulary] = Encoder(vocabulary)
    return _encoders[vocabulary]


def _slices(batch: pa.RecordBatch, characters: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about so many bytes of text each (at least one row)."""
    sizes = [len(x) if x is not None else 0 for x in batch.column(1).cast(pa.binary()).to_pylist()]
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if held and held + n > characters:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < len(sizes):
        yield batch.slice(start)


def encode_documents(documents: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, ids): the token ids of each text without special tokens.

    Null and empty texts give an empty list. Strings of special tokens in a text are ordinary text. Whole
    texts are encoded, of any length. ``vocabulary`` is the path of the tokenizer file on every executor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary)
        for batch in batches:
            for part in _slices(batch, 4_000_000):
                ids = encoder.encode(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), ids], ["doc_id", "ids"])

    n = width(documents.sparkSession)
    return documents.select("doc_id", "text").repartition(n, "doc_id").mapInArrow(run, "doc_id bigint, ids array<int>")
