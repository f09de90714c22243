"""SimHash near-dedup with covering locality-sensitive hashing.

Bit i of a fingerprint gets a non-zero vector m(i) over GF(2) of dimension radius + 1. Mask v, one for each
non-zero vector v, keeps the bits with <m(i), v> = 1. For any ``radius`` differing bits some v is orthogonal to all
their vectors, so that mask hides all differences: every pair within the radius shares a
bucket in some table, with no probability involved. Fifteen masks cover radius 3.

Only distinct fingerprints enter the tables, so copies cost nothing. A bucket is compared in one task
up to a fixed size; a larger one is dealt out again by four blocks of the bits its mask left out, one of
which two fingerprints within the radius must share, until it is small.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.llm.common import Scratch, apart, beside_row, together
from tripweave.llm.components import connected

SHINGLE, SEED, RADIUS = 3, 42, 3
#: Fingerprints that one bucket may hold in a task, and those compared pair by pair.
MOST_IN_BUCKET, MOST_PAIRED = 20_000, 1024
#: Shingle hashes summed at once.
BLOCK = 1 << 15


def fingerprint(text: str | None) -> int:
    """The 64-bit fingerprint of the word shingles; a text of fewer words is one shingle, one without words gives zero."""
    words = (text or "").encode().lower().split()
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    if n <= SHINGLE:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = [*accumulate(len(w) + 1 for w in words)]
    starts = [0, *ends[:n - SHINGLE]]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b - 1], SEED) for a, b in zip(starts, ends[SHINGLE - 1:])], "<u8")
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), BLOCK):
        part = hashes[i:i + BLOCK]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * counts > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and ``fp``, the fingerprint as a signed long, for each input row."""
    def batch_of(batches):
        for batch in batches:
            found = np.array([fingerprint(t) for t in batch.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(batch_of, "doc_id long, fp long")


def covering_masks(radius: int = RADIUS) -> list[int]:
    """One mask for each non-zero vector of radius + 1 bits."""
    vectors = [i % ((1 << radius + 1) - 1) + 1 for i in range(64)]
    return [sum(1 << i for i, m in enumerate(vectors) if (m & v).bit_count() & 1) for v in range(1, 1 << radius + 1)]


def wider_masks(mask: int, radius: int = RADIUS) -> list[int]:
    """The mask with one of radius + 1 blocks of its missing bits each."""
    free = [i for i in range(64) if not mask >> i & 1]
    return [mask | sum(1 << i for i in free[b::radius + 1]) for b in range(min(radius + 1, max(1, len(free))))]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def linked_stars(fps: np.ndarray, mask: int, radius: int) -> list[tuple[int, int]]:
    """Edges that connect what is linked among distinct fingerprints: a star for each component of the bucket."""
    if len(fps) > MOST_PAIRED and mask != (1 << 64) - 1:
        out = []
        for wider in wider_masks(mask, radius):
            key = fps & np.uint64(wider)
            order = np.argsort(key, kind="stable")
            cuts = np.flatnonzero(np.diff(key[order])) + 1
            for part in np.split(order, cuts):
                if len(part) > 1:
                    out += linked_stars(fps[part], wider, radius)
        return out
    label = np.arange(len(fps))
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= radius
    while True:
        least = np.where(near, label[None, :], len(fps)).min(axis=1)
        if (least == label).all():
            break
        label = least
    return [(int(fps[i]), int(fps[k])) for i, k in enumerate(label) if i != k]


def _pairs(buckets: Iterator[tuple[int, np.ndarray]], radius: int):
    for mask, fps in buckets:
        if len(fps) == 2:
            if int(fps[0] ^ fps[1]).bit_count() <= radius:
                yield int(fps[0]), int(fps[1])
        elif len(fps) > 2:
            yield from linked_stars(fps, mask, radius)


def links(fps: DataFrame, scratch: Scratch, radius: int = RADIUS, most: int = MOST_IN_BUCKET) -> DataFrame:
    """(u, v): edges between distinct fingerprints whose components are those of "within the radius"."""
    masks = [_signed(m) for m in covering_masks(radius)]
    rows = fps.select("fp", F.explode(F.array(*[F.lit(m) for m in masks])).alias("mask"))
    edges, level = None, 0
    while True:
        def compare(batches):
            """Rows come sorted by table and bucket. A bucket that outgrows ``most`` is passed on for the next level."""
            held: list[np.ndarray] = []
            size, now, over = 0, None, False
            for batch in batches:
                key = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("mask", "key")])
                fp = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
                cuts = [0, *(np.flatnonzero((np.diff(key) != 0).any(axis=0)) + 1).tolist(), len(fp)]
                done, out = [], []
                for a, b in zip(cuts, cuts[1:]):
                    if a == b:
                        continue
                    this = (int(key[0, a]), int(key[1, a]))
                    if this != now:
                        if size > 1 and not over:
                            done.append((now[0] & (1 << 64) - 1, np.concatenate(held)))
                        held, size, now, over = [], 0, this, False
                    held.append(fp[a:b])
                    size += b - a
                    if size > most and this[0] != -1:
                        out += [(int(x), this[0]) for part in held for x in part]
                        held, over = [], True
                yield _batch([*_pairs(iter(done), radius)], out)
            if size > 1 and not over:
                yield _batch([*_pairs(iter([(now[0] & (1 << 64) - 1, np.concatenate(held))]), radius)], [])

        keyed = rows.withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))
        found = scratch.keep(keyed.repartition("mask", "key").sortWithinPartitions("mask", "key").mapInArrow(
            compare, "a long, b long, again boolean"), f"level{level}")
        new = found.where(~F.col("again")).select(F.col("a").alias("u"), F.col("b").alias("v"))
        edges = new if edges is None else edges.union(new)
        masks = sorted({w for m in masks for w in wider_masks(m & (1 << 64) - 1, radius)})
        if found.where("again").isEmpty():
            return edges
        large = found.where("again").select(F.col("a").alias("fp"), F.col("b").alias("mask"))
        table = {r["mask"]: wider_masks(r["mask"] & (1 << 64) - 1, radius) for r in large.select("mask").distinct().collect()}
        wide = F.create_map(*[x for m, ws in table.items() for x in (F.lit(m), F.array(*[F.lit(_signed(w)) for w in ws]))])
        rows, level = large.select("fp", F.explode(wide[F.col("mask")]).alias("mask")), level + 1
        masks = []


def _batch(pairs: list[tuple[int, int]], again: list[tuple[int, int]]) -> pa.RecordBatch:
    a = np.array([x for x, _ in pairs] + [x for x, _ in again], np.uint64).view(np.int64)
    b = np.array([_signed(x) for _, x in pairs] + [x for _, x in again], np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(a), pa.array(b), pa.array([False] * len(pairs) + [True] * len(again), pa.bool_())], ["a", "b", "again"])


def _linked(docs: DataFrame, scratch: Scratch, radius: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, fp) of each row, and for each fingerprint its least id and its ``root``: the least fingerprint reachable."""
    marked = scratch.keep(fingerprints(docs), "fingerprints")
    distinct = scratch.keep(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    roots = scratch.keep(connected(links(distinct, scratch, radius), scratch), "roots")
    return marked, distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """doc_id, ``fingerprint`` and ``component_id`` for each input row.

    Null and empty texts have fingerprint zero and are linked like others. component_id is the least id
    reachable over fingerprints at most ``radius`` bits apart; null only where all ids of the component are null.
    Repeated rows and ids are rows like others; an empty table gives an empty result.
    """
    marked, found = _linked(docs, Scratch(docs.sparkSession, "simhash"), radius)
    least = found.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = found.select("fp", "root").join(least, "root").select("fp", "component_id")
    return marked.join(by_fp, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "fp")


def _with_fingerprint(rows: DataFrame) -> DataFrame:
    """``row``, ``text`` and ``id`` with ``fp`` beside them."""
    def batch_of(batches):
        for batch in batches:
            found = np.array([fingerprint(t) for t in batch.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found.view(np.int64))], [*batch.schema.names, "fp"])

    return rows.mapInArrow(batch_of, beside_row(rows, "text string, id long, fp long"))


def keep_one_of_each(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """One row of ``docs`` for each component: of its least id, should that id repeat there of the least fingerprint.

    Where all ids of a component are null, one of its rows stays. An id that lies in several components may stay in each.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    marked, found = _linked(docs, scratch, radius)
    # For each component its least id and the least fingerprint of that id; a fingerprint lies in one component.
    first = found.groupBy("root").agg(F.min(F.struct(F.col("least").isNull().alias("none"), "least", "fp")).alias("x"))
    often = marked.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("least")).agg(F.count("*").alias("n")).where("n > 1")
    chosen = scratch.keep(first.select("x.none", "x.least", "x.fp").join(often, "least", "left").select(
        F.col("least").alias("id"), "fp", "none", (F.col("none") | F.col("n").isNotNull()).alias("again")), "chosen")
    rows = apart(docs, F.col("doc_id").cast("long").alias("id"))
    kept = rows.join(chosen.where(~F.col("again")).select("id"), "id", "left_semi").select("row", "text")
    rest = chosen.where("again")
    if rest.isEmpty():
        return together(kept, docs)
    # Ids that repeat, or are null: one row by fingerprint and digest, which only these rows pay for.
    some = rows.join(rest.where(~F.col("none")).select("id").distinct(), "id", "left_semi").select("row", "text", "id")
    if not rest.where("none").isEmpty():
        some = some.union(rows.where(F.col("id").isNull()).select("row", "text", "id"))
    key = [F.col("id").isNull().alias("none"), F.coalesce("id", F.lit(0)).alias("key"), "fp"]
    one = _with_fingerprint(some).groupBy(*key).agg(F.min_by(F.struct("row", "text"), F.xxhash64("text")).alias("x"))
    one = one.join(rest.select(*key), ["none", "key", "fp"], "left_semi").select("x.row", "x.text")
    return together(kept.union(one), docs)
