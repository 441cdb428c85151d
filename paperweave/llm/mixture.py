"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Documents are hashed into blocks of their source. From the tokens of the blocks follow the size of the mix
(the largest at which every source can give its share without using a document too often) and how often each
block is used. Exact quotas of block uses are then split down a binary tree of output shards: at every node
the left half draws its uses without replacement from what the node holds, a multivariate hypergeometric
draw, so shards add up exactly. Shards take disjoint runs of each source's permuted uses and are shuffled
locally.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.durable import Scratch
from ..tables import width

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
#: Blocks of a source. The driver holds one number per block of a listed source, whatever the corpus.
BLOCKS = 2048
#: Tokens of an output shard.
SHARD_TOKENS = 1_000_000
_counters: dict = {}


def token_counts(documents: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, source, n_tokens): size of each whole text in tokens; 0 for null and empty texts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        if vocabulary not in _counters:
            _counters[vocabulary] = Tokenizer.from_file(vocabulary)
            _counters[vocabulary].encode_special_tokens = True
        counter = _counters[vocabulary]
        for pdf in batches:
            texts = [t or "" for t in pdf["text"]]
            sizes = []
            for i in range(0, len(texts), 256):
                sizes += [len(e) for e in counter.encode_batch_fast(texts[i : i + 256], add_special_tokens=False)]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "source": pdf["source"], "n_tokens": sizes})

    n = width(documents.sparkSession)
    return documents.select("doc_id", "source", "text").repartition(n, "doc_id").mapInPandas(run, "doc_id bigint, source string, n_tokens bigint")


def split_tree(counts: np.ndarray, shards: int, rng: np.random.Generator) -> np.ndarray:
    """(shards, sources): how many of the counts each shard gets. Rows differ by at most one in total."""
    out = np.zeros((shards, len(counts)), dtype=np.int64)
    sizes = np.diff(np.linspace(0, counts.sum(), shards + 1).round().astype(np.int64))
    stack = [(0, shards, counts.astype(np.int64))]
    while stack:
        lo, hi, held = stack.pop()
        if hi - lo == 1:
            out[lo] = held
            continue
        mid = (lo + hi) // 2
        left = rng.multivariate_hypergeometric(held, int(sizes[lo:mid].sum()), method="marginals")
        stack += [(lo, mid, left), (mid, hi, held - left)]
    return out


def _plan(blocks: pd.DataFrame, targets: pd.DataFrame, seed: int, shard_tokens: int) -> tuple[pd.DataFrame, dict]:
    """Uses of blocks (source, block, copy, shard, fill) and the token quota of each source.

    fill is the number of tokens that may be taken of the block in that use; below the block's size the
    use is the last, partial one of its source.
    """
    rng = np.random.default_rng(seed)
    held = blocks.groupby("source")["tokens"].sum()
    live = targets[(targets["target_share"] > 0) & targets["source"].isin(held[held > 0].index) & (targets["max_repeats"] > 0)].sort_values("source")
    if live.empty:
        return pd.DataFrame(columns=["source", "block", "copy", "shard", "fill"]), {}
    size = min(held[r.source] * r.max_repeats / r.target_share for r in live.itertuples())
    quotas = {r.source: size * r.target_share for r in live.itertuples()}
    uses = []
    for r in live.itertuples():
        own = blocks[blocks["source"] == r.source].sort_values("block")
        b, t = own["block"].to_numpy(), own["tokens"].to_numpy()
        left, copy = quotas[r.source], 0
        while left > 0.5 and copy < r.max_repeats:
            order = rng.permutation(len(b))
            before = np.concatenate([[0], np.cumsum(t[order])])
            fill = np.minimum(t[order], np.maximum(0, np.floor(left - before[:-1] + 0.5)))
            take = fill > 0
            uses.append(pd.DataFrame({"source": r.source, "block": b[order][take], "copy": copy, "fill": fill[take].astype(np.int64)}))
            left -= before[-1]
            copy += 1
    uses = pd.concat(uses, ignore_index=True)
    shards = max(1, math.ceil(sum(quotas.values()) / shard_tokens))
    names = sorted(quotas)
    counts = np.array([(uses["source"] == s).sum() for s in names])
    per = split_tree(counts, min(shards, int(counts.sum())), rng)
    uses["shard"] = 0
    for j, s in enumerate(names):
        at = rng.permutation(np.flatnonzero((uses["source"] == s).to_numpy()))
        uses.loc[at, "shard"] = np.repeat(np.arange(len(per)), per[:, j])
    return uses, quotas


#: Rows of a plan up to which it is broadcast.
SMALL_PLAN = 200_000


def mix(documents: DataFrame, targets: DataFrame, seed: int = 17, shard_tokens: int = SHARD_TOKENS, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, source, n_tokens, copy, shard, position): the mixed corpus, one row per use of a document.

    A document is used in at most max_repeats rows, numbered by copy from 0. The last use of a source's
    blocks takes documents of one block, in hashed order, as far as they fit the quota. position orders a
    shard at random. Documents without tokens, of null or unlisted sources are left out; a listed source
    without tokens has no rows, and the others keep their shares of one another. No target gives no rows.
    """
    spark = documents.sparkSession
    scratch = Scratch(spark, "mix")
    sized = token_counts(documents.where("source is not null"), vocabulary).where("n_tokens > 0").join(targets.select("source").distinct(), "source", "left_semi")
    sized = scratch.keep(sized.withColumn("block", F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(BLOCKS)).cast("int")), "sized")
    blocks = sized.groupBy("source", "block").agg(F.sum("n_tokens").alias("tokens")).toPandas()  # BLOCKS per listed source
    wanted = targets.groupBy("source").agg(F.sum("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats")).toPandas()
    uses, _ = _plan(blocks, wanted, seed, shard_tokens)
    schema = "source string, block int, copy int, shard int, fill bigint, whole boolean"
    full = uses.merge(blocks, on=["source", "block"]) if len(uses) else uses.assign(tokens=[])
    rows = list(zip(full["source"], full["block"].astype(int), full["copy"].astype(int), full["shard"].astype(int), full["fill"].astype(int), (full["fill"] >= full["tokens"]), strict=True))
    plan = spark.createDataFrame([(a, int(b), int(c), int(d), int(e), bool(w)) for a, b, c, d, e, w in rows], schema)
    # max_repeats is data: a plan that is not small is shuffled
    used = sized.join(F.broadcast(plan) if len(rows) <= SMALL_PLAN else plan, ["source", "block"])
    partial = Window.partitionBy("source", "block", "copy").orderBy(F.xxhash64("doc_id", F.lit(seed + 1)), "doc_id")
    part = used.where("not whole").withColumn("before", F.sum("n_tokens").over(partial.rowsBetween(Window.unboundedPreceding, -1)))
    part = part.where(F.coalesce("before", F.lit(0)) + F.col("n_tokens") / 2 <= F.col("fill")).drop("before")
    chosen = used.where("whole").unionByName(part)
    order = Window.partitionBy("shard").orderBy(F.xxhash64("doc_id", "copy", F.lit(seed + 2)), "doc_id", "copy")
    return chosen.select("doc_id", "source", "n_tokens", "copy", "shard", F.row_number().over(order).alias("position"))


def shares(documents: DataFrame, targets: DataFrame, seed: int = 17, vocabulary: str = VOCABULARY) -> DataFrame:
    """(source, target_share, actual_share, n_tokens, n_uses, n_documents, most_uses) of the mix, per listed source."""
    mixed = mix(documents, targets, seed, vocabulary=vocabulary)
    per = mixed.groupBy("source", "doc_id").agg(F.count("*").alias("uses"), F.sum("n_tokens").alias("tokens"))
    per = per.groupBy("source").agg(F.sum("tokens").alias("n_tokens"), F.sum("uses").alias("n_uses"), F.count("*").alias("n_documents"), F.max("uses").alias("most_uses"))
    total = per.agg(F.sum("n_tokens").alias("total"))
    out = targets.join(per, "source", "left").crossJoin(total)  # one row on the right
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return out.select("source", "target_share", F.round(F.coalesce(F.col("n_tokens") / F.col("total"), F.lit(0.0)), 9).alias("actual_share"), zero("n_tokens"), zero("n_uses"), zero("n_documents"), zero("most_uses"))
