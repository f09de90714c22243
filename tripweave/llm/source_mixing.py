"""Mixing sources to target weights, by whole blocks of words.

Each source is a stream of words in a fixed order of its documents, cut into blocks of one length. The
number of blocks a source gives is set by its target; each is thrown at an output shard, which makes the counts of a source
over the shards a multinomial draw. The slots of a source are numbered through, and a
keyed pseudorandom permutation of its block numbers (a Feistel network, walked until it falls inside the range) says
which block fills which slot. A second pass over a source uses another permutation. Slots and blocks meet by
(source, block number), which spreads any hot source. ``packed_blocks`` gives the mix itself, the texts of the blocks of each
shard; ``taken_words`` counts the same slots by document without moving texts.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tripweave.llm.common import Scratch, apart, small_side, text_of

#: Weights by place of the source, and the share of all words that the mix has.
WEIGHTS, SHARE, MOST_TIMES = (5, 2, 1), 1.5, 2
#: Words in a block; a source of few words is cut into ``LEAST_BLOCKS`` shorter ones so that it can meet its target.
BLOCK_WORDS, LEAST_BLOCKS = 256, 64
#: Documents summed in one window group, and blocks in an output shard.
GROUP_DOCS, SHARD_BLOCKS = 20_000, 4096
ROUNDS = 6


def word_count(text):
    return F.size(F.array_remove(F.split(text, r"\s+"), "")).cast("long")


def targets(sizes: DataFrame, scratch: Scratch) -> DataFrame:
    """source, source_size, n_docs, target from one row per source.

    Sources in code point order, null last, weigh 5, 2, 1, 5, ... A target is the weight times a common
    level, and at most twice the source. Reaching the level by sharing the excess again until none is
    above is the same as this: sources are capped in order of size per weight, and the level is the rest of the
    words over the rest of the weights at the first source that it does not cap. The window has one row per source.
    """
    ordered = sizes.withColumn("place", F.row_number().over(W.orderBy(F.col("source").isNull(), "source")) - 1)
    weighted = ordered.withColumn("weight", F.element_at(
        F.array(*[F.lit(float(w)) for w in WEIGHTS]), (F.pmod("place", F.lit(len(WEIGHTS))) + 1).cast("int")))
    cap = F.col("source_size") * float(MOST_TIMES)
    by_need = W.orderBy(cap / F.col("weight"), "place")
    before = by_need.rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy()
    levels = weighted.withColumns({
        "level": (SHARE * F.sum("source_size").over(everything) - F.coalesce(F.sum(cap).over(before), F.lit(0.0)))
        / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))),
        "need": cap / F.col("weight")})
    level = F.min(F.when(F.col("need") >= F.col("level"), F.struct("need", "place", "level"))).over(everything)
    return scratch.keep(levels.withColumn("common", level["level"]).select(
        "source", "source_size", "n_docs",
        F.least(cap, F.coalesce(F.col("weight") * F.col("common"), cap)).alias("target")), "targets")


def feistel(index: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A pseudorandom permutation of 0 .. size-1 for each key, applied to ``index``; all arrays of uint64."""
    half = np.array([max(1, (max(int(s) - 1, 1).bit_length() + 1) // 2) for s in np.unique(size)], np.uint64)
    half = half[np.searchsorted(np.unique(size), size)]
    low = (np.uint64(1) << half) - np.uint64(1)
    out, walk = index.astype(np.uint64), np.arange(len(index))
    while len(walk):
        x, h, m, k = out[walk], half[walk], low[walk], key[walk]
        left, right = x >> h, x & m
        for r in range(ROUNDS):
            f = (right + k + np.uint64(r * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) * np.uint64(0xBF58476D1CE4E5B9)
            f = (f ^ (f >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
            left, right = right, left ^ ((f ^ (f >> np.uint64(32))) & m)
        out[walk] = left << h | right
        walk = walk[out[walk] >= size[walk]]
    return out.astype(np.int64)


def _placed(docs: DataFrame, scratch: Scratch, *carried: str) -> tuple[DataFrame, DataFrame]:
    """Every row with its words' place in the stream of its source, and the sources with their blocks. ``carried`` columns stay beside it.

    The order of a source is by hash group and then by id, so a hot source is summed up in many tasks;
    only the totals of groups are summed in one window, a row per ``GROUP_DOCS`` documents.
    """
    sized = scratch.keep(docs.select(
        F.col("doc_id"), F.col("source"), F.xxhash64("text").alias("mark"), word_count(text_of()).alias("size"), *carried), "sizes")
    goals = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs")), scratch)
    goals = goals.withColumns({
        "words": F.greatest(F.lit(1), F.least(F.lit(BLOCK_WORDS), F.floor(F.col("source_size") / LEAST_BLOCKS))).cast("long"),
        "groups": F.ceil(F.col("n_docs") / GROUP_DOCS).cast("long")})
    goals = goals.withColumn("blocks", F.ceil(F.col("source_size") / F.col("words")).cast("long"))
    # One row per source. Full passes over the source and the rest, in blocks of the mean length.
    whole = F.floor(F.col("target") / F.greatest("source_size", F.lit(1)))
    goals = goals.withColumn("slots", F.when(F.col("source_size") == 0, 0).otherwise(
        F.least(MOST_TIMES * F.col("blocks"), whole * F.col("blocks") + F.round(
            (F.col("target") - whole * F.col("source_size")) * F.col("blocks") / F.col("source_size")))).cast("long"))
    goals = goals.withColumn("code", F.xxhash64(F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n"))))
    goals = scratch.keep(goals, "goals")
    rows = sized.join(small_side(goals.select("code", "groups"), goals.count()), F.xxhash64(F.coalesce(F.concat(F.lit("s"), sized["source"]), F.lit("n"))) == goals["code"])
    rows = rows.withColumn("group", F.pmod(F.xxhash64("doc_id", "mark"), "groups"))
    within = W.partitionBy("code", "group").orderBy("doc_id", "mark")
    rows = rows.withColumns({
        "nth": F.row_number().over(within),
        "inner": F.sum("size").over(within.rowsBetween(W.unboundedPreceding, 0)) - F.col("size")})
    rows = scratch.keep(rows.select("doc_id", "mark", "code", "group", "nth", "inner", "size", *carried), "rows")
    totals = rows.groupBy("code", "group").agg(F.sum("size").alias("total"))
    base = totals.select("code", "group", (F.sum("total").over(
        W.partitionBy("code").orderBy("group").rowsBetween(W.unboundedPreceding, 0)) - F.col("total")).alias("base"))
    placed = rows.join(base, ["code", "group"]).withColumn("start", F.col("base") + F.col("inner")).drop("base", "inner")
    return placed, goals


def slots(goals: DataFrame, seed: int = 0) -> DataFrame:
    """(code, slot, shard, block): the mix as a list of blocks; a shard takes the slots thrown at it."""
    total = F.sum("slots").over(W.partitionBy())
    each = goals.withColumn("shards", F.greatest(F.lit(1), F.ceil(total / SHARD_BLOCKS)).cast("long")).where("slots > 0")
    # Slots are dealt out in runs, so that a large source is no single row to unfold.
    runs = each.select("code", "blocks", "slots", "shards", F.explode(F.sequence(
        F.lit(0).cast("long"), F.floor((F.col("slots") - 1) / SHARD_BLOCKS))).alias("run")).repartition("code", "run")
    one = runs.select("code", "blocks", "shards", F.explode(F.sequence(
        F.col("run") * SHARD_BLOCKS, F.least((F.col("run") + 1) * SHARD_BLOCKS, F.col("slots")) - 1)).alias("slot"))

    def permuted(frames):
        for f in frames:
            code, slot = f["code"].to_numpy(np.int64).view(np.uint64), f["slot"].to_numpy(np.uint64)
            size = f["blocks"].to_numpy(np.uint64)
            key = code ^ ((slot // size + np.uint64(seed * 2 + 1)) * np.uint64(0xD6E8FEB86659FD93))
            thrown = (slot + key) * np.uint64(0x94D049BB133111EB)
            shard = (thrown ^ (thrown >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(11)
            yield pd.DataFrame({
                "code": f["code"], "slot": f["slot"], "shard": (shard % f["shards"].to_numpy(np.uint64)).astype(np.int64),
                "block": feistel(slot % size, size, key)})

    return one.mapInPandas(permuted, "code long, slot long, shard long, block long")


def pieces(placed: DataFrame, goals: DataFrame, *carried: str) -> DataFrame:
    """Every document cut at the block ends of its source: (code, block, row, place in the block, first word, words)."""
    cut = placed.where("size > 0").join(small_side(goals.select("code", "words"), goals.count()), "code")
    first = F.floor(F.col("start") / F.col("words"))
    last = F.floor((F.col("start") + F.col("size") - 1) / F.col("words"))
    cut = cut.withColumn("block", F.explode(F.sequence(first, last)))
    begin = F.greatest(F.col("start"), F.col("block") * F.col("words"))
    end = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * F.col("words"))
    return cut.select("code", "block", "group", "nth", begin.alias("at"), (begin - F.col("start")).alias("first"), (end - begin).alias("n"), *carried)


def mix(docs: DataFrame, seed: int = 0, *carried: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows placed in their sources, the sources with targets, and the mix as a list: (code, slot, shard, block)."""
    scratch = Scratch(docs.sparkSession, "mixing")
    placed, goals = _placed(docs, scratch, *carried)
    return placed, goals, slots(goals, seed)


def packed_blocks(docs: DataFrame, seed: int = 0) -> DataFrame:
    """The mix itself: shard, source, slot, block, ``n_words`` and ``text``, the block's words joined by one space.

    One row for each slot; a shard's rows are its output. Blocks of a source all have the same number of words but the last. Rows as in
    ``taken_words``; an empty table gives no blocks.
    """
    words = F.array_remove(F.split(text_of(), r"\s+"), "")
    placed, goals, chosen = mix(docs.select("doc_id", "source", "text"), seed, "text")
    # Texts are cut into words once; a piece holds the words of one block.
    cut = pieces(placed.withColumn("text", words), goals, "text").select(
        "code", "block", "at", "n", F.slice("text", (F.col("first") + 1).cast("int"), F.col("n").cast("int")).alias("words"))
    blocks = cut.groupBy("code", "block").agg(
        F.sum("n").alias("n_words"), F.array_join(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("at", "words"))), lambda x: x["words"])), " ").alias("text"))
    named = small_side(goals.select("code", "source"), goals.count())
    return chosen.hint("merge").join(blocks, ["code", "block"]).join(named, "code").select("shard", "source", "slot", "block", "n_words", "text")


def taken_words(docs: DataFrame, seed: int = 0) -> DataFrame:
    """One row per input row: doc_id, size, source_size, target, ``taken``, the words the mix takes of it, and ``n_shards`` they go to.

    A null text has no words and a null source is a source, the last. Equal rows are placed one after the
    other, each by itself; an empty table gives an empty result. No row is taken more than twice.
    """
    placed, goals, chosen = mix(docs, seed)
    # Slots unfold from a table of one row per source, so their estimated size is far too small to plan a broadcast by.
    taken = pieces(placed, goals).join(chosen.hint("merge"), ["code", "block"]).groupBy("code", "group", "nth").agg(
        F.sum("n").alias("taken"), F.size(F.collect_set("shard")).cast("long").alias("n_shards"))
    zero = F.lit(0).cast("long")
    return placed.join(taken, ["code", "group", "nth"], "left").join(
        small_side(goals.select("code", "source_size", "target"), goals.count()), "code").select(
        "doc_id", "mark", "size", "source_size", "target", F.coalesce("taken", zero).alias("taken"), F.coalesce("n_shards", zero).alias("n_shards"))


def mixed_documents(docs: DataFrame, seed: int = 0) -> DataFrame:
    """The documents the mix takes words of, with their columns and ``taken`` (``taken_by_mix`` where they have a column of that name).

    Rows of one id and text each get the words taken of one of them. An empty table gives an empty result.
    """
    name = "taken_by_mix" if "taken" in docs.columns else "taken"
    key = ["id", "none", "mark"]
    found = taken_words(docs, seed).select(F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("none"), "mark", "taken")
    found = Scratch(docs.sparkSession, "mixed").keep(found, "taken")
    rows = apart(docs, F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("none"), F.xxhash64("text").alias("mark"))
    often = found.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1").select(*key)
    n = often.count()
    if not n:
        kept = rows.join(found.where("taken > 0"), key)
    else:
        # Equal rows are numbered on both sides; all others need no number.
        once = rows.join(small_side(often, n), key, "left_anti").withColumn("nth", F.lit(1))
        again = rows.join(small_side(often, n), key, "left_semi")
        again = again.withColumn("nth", F.row_number().over(W.partitionBy(*key).orderBy(F.xxhash64("row"))))
        numbered = found.withColumn("nth", F.row_number().over(W.partitionBy(*key).orderBy("taken")))
        kept = once.union(again).join(numbered.where("taken > 0"), [*key, "nth"])
    return kept.select(*[F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns], F.col("taken").alias(name))
