"""Line dedup with two Bloom filters, for lines seen once and lines seen twice.

1. Each task sends the distinct 64-bit hashes of the long lines in its documents, with a mark on those it met
   in two of them, to the block that owns them; so a line found everywhere arrives a few times from each task.
2. A block streams its hashes through a once-seen and a twice-seen filter. A hash that is already in
   the first is a suspect; the second tells which suspects may have been reported before, and only for
   those an exact look-up is made. False positives of either filter cost work and never a line.
3. Only lines with suspect hashes leave the documents again, as digests, to be counted exactly and to
   choose the document that keeps them.
4. The lines to drop are gathered by document and cut out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.llm.common import SPACE, Scratch, apart, beside_row, partitions_for, small_side, text_of

LEAST_LENGTH = 40
LEAST_DOCS = 5
#: Hashes a block is laid out for, filter bits for each of them, and probes.
BLOCK_LINES = 1 << 21
#: Hashes a task combines before it sends them on.
COMBINED_LINES = 1 << 20
BITS_PER_LINE = 12
PROBES = 5


def line_key(line: str) -> str:
    """White space stripped from both ends, A-Z in lower case; other letters stay."""
    key = line.strip(SPACE)
    return key.lower() if key.isascii() else key.encode().lower().decode()


def long_keys(text: str, least: int) -> set[bytes]:
    """The distinct long keys of a text, as UTF-8."""
    return {key.encode() for line in text.split("\n") if len(line) >= least and len(key := line_key(line)) >= least}


def _digest(key: bytes) -> bytes:
    return hashlib.sha256(key).digest()


class Bloom:
    """A Bloom filter over 64-bit hashes."""

    def __init__(self, bits: int):
        self.size = 1 << max(10, (bits - 1).bit_length())
        self.words = np.zeros(self.size >> 3, np.uint8)

    def _places(self, hashes: np.ndarray) -> np.ndarray:
        # The owner of a block is chosen by other bits than these, after mixing.
        a = (hashes ^ (hashes >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        b = (a ^ (a >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) | np.uint64(1)
        return (a[:, None] + np.arange(PROBES, dtype=np.uint64) * b[:, None]) >> np.uint64(20) & np.uint64(self.size - 1)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        p = self._places(hashes)
        return (self.words[p >> np.uint64(3)] >> (p & np.uint64(7)).astype(np.uint8) & 1).all(axis=1)

    def add(self, hashes: np.ndarray) -> None:
        p = self._places(hashes).ravel()
        np.bitwise_or.at(self.words, p >> np.uint64(3), np.left_shift(1, (p & np.uint64(7)).astype(np.uint8), dtype=np.uint8))


def combined(batches: Iterator[np.ndarray], limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct hashes, and whether each came more than once, of at least ``limit`` hashes at a time."""
    held: list[np.ndarray] = []
    size = 0
    for hashes in batches:
        held.append(hashes)
        size += len(hashes)
        if size >= limit:
            u, n = np.unique(np.concatenate(held), return_counts=True)
            yield u, n > 1
            held, size = [], 0
    if size:
        u, n = np.unique(np.concatenate(held), return_counts=True)
        yield u, n > 1


def second_sights(batches: Iterator[tuple[np.ndarray, np.ndarray]], lines: int) -> Iterator[np.ndarray]:
    """Hashes that come again or are marked as met twice, each once, from a stream of (hashes, marks).

    Memory is two filters and the result, which is at most the distinct hashes of the block.
    """
    once, twice = Bloom(lines * BITS_PER_LINE), Bloom(lines * BITS_PER_LINE)
    told: set[int] = set()
    for hashes, marks in batches:
        u, back, n = np.unique(hashes, return_inverse=True, return_counts=True)
        marked = np.zeros(len(u), bool)
        marked[back[marks]] = True
        again = u[(n > 1) | marked | once.holds(u)]
        once.add(u)
        maybe = twice.holds(again)
        fresh = again[~maybe]
        unsure = np.array([h for h in again[maybe].tolist() if h not in told], np.uint64)
        twice.add(fresh)
        new = np.concatenate([fresh, unsure])
        told.update(new.tolist())
        if len(new):
            yield new


def _texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    return [t or "" for t in batch.column(name).to_pylist()]


def suspects(docs: DataFrame, scratch: Scratch, least: int) -> DataFrame:
    """``h``: hashes of lines that at least two rows hold, and a few more."""
    spark = docs.sparkSession

    def hashes(batches):
        found = (np.array([xxhash.xxh64_intdigest(key) for text in _texts(batch) for key in long_keys(text, least)], np.uint64)
                 for batch in batches)
        for h, marks in combined(found, COMBINED_LINES):
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(marks)], ["h", "twice"])

    lines = scratch.keep(docs.select("text").mapInArrow(hashes, "h long, twice boolean"), "hashes")
    n = partitions_for(spark, lines.count(), BLOCK_LINES)

    def again(batches):
        stream = ((batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64), batch.column(1).to_numpy(zero_copy_only=False))
                  for batch in batches)
        for new in second_sights((x for x in stream if len(x[0])), BLOCK_LINES):
            yield pa.RecordBatch.from_arrays([pa.array(new.view(np.int64))], ["h"])

    return scratch.keep(lines.repartition(n, "h").mapInArrow(again, "h long"), "suspects")


def repeated_lines(docs: DataFrame, scratch: Scratch, least: int, least_docs: int) -> DataFrame:
    """(id, none, digest) of the lines each document loses. ``none`` says that the id is null."""
    found = suspects(docs, scratch, least)

    def keyed(batches):
        for batch in batches:
            rows = [(d, key) for d, text in zip(batch.column("doc_id").to_pylist(), _texts(batch)) for key in long_keys(text, least)]
            yield pa.RecordBatch.from_arrays([
                pa.array([d for d, _ in rows], pa.int64()),
                pa.array(np.array([xxhash.xxh64_intdigest(k) for _, k in rows], np.uint64).view(np.int64)),
                pa.array([_digest(k) for _, k in rows], pa.binary())], ["doc_id", "h", "digest"])

    rows = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(keyed, "doc_id long, h long, digest binary")
    rows = rows.join(small_side(found, found.count()), "h", "left_semi").select("doc_id", "digest")
    rows = scratch.keep(rows, "lines")
    # A null id is one document, before all others.
    losing = scratch.keep(rows.groupBy("digest").agg(
        F.count_distinct("doc_id").alias("n"), F.max(F.col("doc_id").isNull().cast("int")).alias("none"),
        F.max("doc_id").alias("last")).where(F.col("n") + F.col("none") >= least_docs).select("digest", "last"), "losing")
    return rows.join(small_side(losing, losing.count()), "digest").where(~F.col("doc_id").eqNullSafe(F.col("last"))).select(
        F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("none"), "digest")


def drop_repeated_lines(docs: DataFrame, least: int = LEAST_LENGTH, least_docs: int = LEAST_DOCS) -> DataFrame:
    """``row`` (the other columns), ``text`` (what stays), n_lines and n_dropped for each input row.

    A line's key is the line without white space at its ends, A-Z in lower case. Keys of at least
    ``least`` code points in at least ``least_docs`` documents stay only in the document of largest id
    that holds them, there on every line. A null or empty text is one empty line. Rows that share an id are one
    document; null ids are one document, before all others. An empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "lines")
    source = apart(docs, F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("none"))
    gone = repeated_lines(docs.select("doc_id", text_of().alias("text")), scratch, least, least_docs)
    gone = gone.groupBy("id", "none").agg(F.collect_set("digest").alias("gone"))
    rows = source.join(gone, ["id", "none"], "left").select("row", "text", "gone")

    def cut(batches):
        for batch in batches:
            texts, counts, dropped = [], [], []
            for text, drops in zip(_texts(batch), batch.column("gone").to_pylist()):
                lines = text.split("\n")
                counts.append(len(lines))
                if drops:
                    out = set(drops)
                    lines = [x for x in lines if len(x) < least or len(k := line_key(x)) < least or _digest(k.encode()) not in out]
                    text = "\n".join(lines)
                texts.append(text)
                dropped.append(counts[-1] - len(lines))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(texts, pa.string()), pa.array(counts, pa.int64()), pa.array(dropped, pa.int64())],
                ["row", "text", "n_lines", "n_dropped"])

    return rows.mapInArrow(cut, beside_row(rows, "text string, n_lines long, n_dropped long"))

