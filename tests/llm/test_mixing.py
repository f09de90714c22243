"""The mix as blocks: their texts, the draw over the shards, and the words taken of each row."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tripweave.llm import source_mixing


@pytest.fixture(scope="module")
def docs(spark):
    frame = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return frame.withColumn("source", F.when(F.col("source") == "src7", None).when(F.col("source") < "src2", "hot").otherwise(F.col("source")))


def test_blocks_hold_whole_runs_of_their_source(docs):
    blocks = source_mixing.packed_blocks(docs).collect()
    placed, goals, chosen = source_mixing.mix(docs)
    goal = {r["source"]: r for r in goals.collect()}
    assert Counter((r["source"], r["slot"]) for r in blocks).most_common(1)[0][1] == 1
    by_block = defaultdict(set)
    per_source = Counter()
    for r in blocks:
        words = brute.WORD.findall(r["text"])
        assert len(words) == r["n_words"] and " ".join(words) == r["text"]
        by_block[r["source"], r["block"]].add(r["text"])
        per_source[r["source"]] += r["n_words"]
    assert all(len(t) == 1 for t in by_block.values())
    for source, g in goal.items():
        assert per_source[source] == pytest.approx(g["target"], rel=0.02)
        sizes = {len(next(iter(t)).split(" ")) for (s, b), t in by_block.items() if s == source and b < g["blocks"] - 1}
        assert sizes <= {g["words"]}
    # Every block that was taken is a run of words of one document after the other, in the order of the stream.
    texts = {r["doc_id"]: brute.WORD.findall(r["text"] or "") for r in docs.collect()}
    for source in goal:
        stream = []
        for r in placed.join(goals.where(F.col("source").eqNullSafe(F.lit(source))).select("code"), "code").orderBy("start", "size").collect():
            assert r["size"] == 0 or r["start"] == len(stream)
            stream += texts[r["doc_id"]]
        for (s, b), t in by_block.items():
            if s == source:
                assert next(iter(t)) == " ".join(stream[b * goal[s]["words"]:(b + 1) * goal[s]["words"]])


def test_taken_words_are_those_of_the_blocks(docs):
    taken = source_mixing.taken_words(docs)
    blocks = source_mixing.packed_blocks(docs)
    assert taken.agg(F.sum("taken")).first()[0] == blocks.agg(F.sum("n_words")).first()[0]
    for r in taken.collect():
        assert (r["n_shards"] > 0) == (r["taken"] > 0) and r["taken"] <= 2 * r["size"]


def test_shard_counts_are_a_multinomial_draw(docs, monkeypatch):
    """Of each source, counts over many shards lie about their mean as independent throws would."""
    monkeypatch.setattr(source_mixing, "SHARD_BLOCKS", 60)
    blocks = source_mixing.slots(source_mixing.mix(docs)[1]).collect()
    shards = 1 + max(r["shard"] for r in blocks)
    assert shards > 20
    assert len({r["shard"] for r in blocks}) == shards
    counts = Counter((r["code"], r["shard"]) for r in blocks)
    for code in {r["code"] for r in blocks}:
        n = sum(r["code"] == code for r in blocks)
        chi = sum((counts[code, k] - n / shards) ** 2 for k in range(shards)) / (n / shards)
        assert 0.3 * shards < chi < 2.5 * shards
    assert source_mixing.slots(source_mixing.mix(docs)[1], seed=1).exceptAll(source_mixing.slots(source_mixing.mix(docs)[1])).count() > 0


def test_equal_rows_and_clashing_columns(spark):
    text = " ".join(f"w{i}" for i in range(3000))
    data = [(1, text, "a", 5, 7), (1, text, "a", 5, 7), (1, text, "a", 6, 7), (None, text, None, 1, 1), (None, None, "b", 1, 1), (2, "one two", "b", 1, 1), (3, "", None, 1, 1)]
    frame = spark.createDataFrame(data, "doc_id long, text string, source string, extra int, n_shards int")
    each = sorted(r["taken"] for r in source_mixing.taken_words(frame).collect() if r["doc_id"] == 1)
    mixed = source_mixing.mixed_documents(frame)
    assert mixed.columns == [*frame.columns, "taken"]
    rows = mixed.collect()
    assert sorted(r["taken"] for r in rows if r["doc_id"] == 1) == [x for x in each if x]
    assert sum(r["taken"] for r in rows) == source_mixing.taken_words(frame).agg(F.sum("taken")).first()[0]
    assert Counter(r["extra"] for r in rows if r["doc_id"] == 1) <= Counter([5, 5, 6])
    clash = source_mixing.mixed_documents(frame.withColumn("taken", F.lit("mine")))
    assert clash.columns == [*frame.columns, "taken", "taken_by_mix"] and {r["taken"] for r in clash.collect()} == {"mine"}
    none = frame.limit(0)
    assert source_mixing.packed_blocks(none).count() == 0 == source_mixing.mixed_documents(none).count()
