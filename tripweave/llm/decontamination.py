"""Benchmark decontamination by Wu-Manber search for many patterns at once.

Patterns are windows of normalised benchmark words, written with a space on either side of each word,
so that a byte match is a word match. A shift table, indexed by a hash of the last ``BLOCK`` bytes
under the cursor, says how far the cursor may jump; where it says zero, the suffix bucket of that hash lists the
patterns to compare, and a direct comparison confirms them. Cursors of many stretches of text advance
together, as one array, so the tables are consulted at array speed while each cursor jumps on its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.llm.common import Scratch, apart, beside_row, partitions_for, text_of, together

WINDOW = 10
#: Bytes of benchmark text whose tables a worker holds at once; a larger benchmark takes several passes.
PASS_BYTES = 4 << 20
#: Bytes a block of the shift table covers at most, and the bits of its hash.
BLOCK, HASH_BITS = 8, 20
#: Bytes of text searched at once, and bytes of it that one cursor walks.
BATCH_BYTES, STRETCH = 4 << 20, 2048

#: Bytes that are part of a word, A-Z taken as a-z: digits, letters, all beyond ASCII.
KEPT = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(KEPT).split()


def windows_of(words: list[bytes], window: int) -> list[bytes]:
    """The windows of an item as patterns; an item of fewer words, but not none, is one window."""
    if not words:
        return []
    return [b" " + b" ".join(words[i:i + window]) + b" " for i in range(max(1, len(words) - window + 1))]


class WuManber:
    """Shift table, suffix buckets and patterns of one set."""

    def __init__(self, patterns: list[bytes]):
        self.patterns = patterns
        self.m = min(map(len, patterns))
        self.block = min(BLOCK, self.m)
        self.shift = np.full(1 << HASH_BITS, self.m - self.block + 1, np.uint8 if self.m < 256 else np.int32)
        heads = np.frombuffer(b"".join(p[:self.m] for p in patterns), np.uint8).reshape(len(patterns), self.m)
        for end in range(self.block, self.m + 1):
            np.minimum.at(self.shift, self._hash_rows(heads[:, end - self.block:end]), self.m - end)
        suffix = self._hash_rows(heads[:, self.m - self.block:])
        self.order = np.argsort(suffix, kind="stable")
        self.begin = np.searchsorted(suffix[self.order], np.arange((1 << HASH_BITS) + 1))
        padded = np.zeros((len(patterns), 8), np.uint8)
        padded[:, :min(8, self.m)] = heads[:, :8]
        self.prefix = padded.copy().view(np.uint64).ravel()

    @property
    def _mask(self) -> np.uint64:
        return np.uint64((1 << 8 * self.block) - 1)

    def _hash(self, x: np.ndarray) -> np.ndarray:
        x = (x & self._mask) * np.uint64(0x9E3779B97F4A7C15)
        return (x >> np.uint64(64 - HASH_BITS)).astype(np.int64)

    def _hash_rows(self, rows: np.ndarray) -> np.ndarray:
        padded = np.zeros((len(rows), 8), np.uint8)
        padded[:, :self.block] = rows
        return self._hash(padded.view(np.uint64).ravel())

    def search(self, text: bytes) -> list[tuple[int, int]]:
        """(position, pattern number) of every occurrence of every pattern in ``text``."""
        last = len(text) - self.m
        if last < 0:
            return []
        raw = np.frombuffer(text + b"\0" * 8, np.uint8)
        eight = np.ndarray((len(text) + 1,), "<u8", raw.data, 0, (1,))
        cursor = np.arange(0, last + 1, STRETCH, dtype=np.int64)
        end = np.minimum(cursor + STRETCH, last + 1)
        found: list[tuple[int, int]] = []
        prefix_mask = np.uint64((1 << 8 * min(8, self.m)) - 1)
        while len(cursor):
            h = self._hash(eight[cursor + (self.m - self.block)])
            jump = self.shift[h].astype(np.int64)
            here = np.flatnonzero(jump == 0)
            if len(here):
                at, bucket = cursor[here], h[here]
                size = self.begin[bucket + 1] - self.begin[bucket]
                which = np.repeat(np.arange(len(here)), size)
                inside = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size)
                pattern = self.order[self.begin[bucket][which] + inside]
                same = (eight[at] & prefix_mask)[which] == self.prefix[pattern]
                for a, p in zip(at[which[same]].tolist(), pattern[same].tolist()):
                    if text.startswith(self.patterns[p], a):
                        found.append((a, p))
                jump[here] = 1
            cursor += jump
            go = cursor < end
            if not go.all():
                cursor, end = cursor[go], end[go]
        return found


class Benchmark:
    """The patterns of some items, with the items each belongs to; one search table for full windows and one for short items."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        owners: dict[bytes, tuple[str, ...]] = {}
        for item, text in items:
            alone = (item,)  # one object for all patterns that this item alone has
            for pattern in windows_of(words_of(text), window):
                had = owners.get(pattern)
                if had is None:
                    owners[pattern] = alone
                elif item not in had:
                    owners[pattern] = (*had, item)
        full = sorted(p for p in owners if p.count(b" ") == window + 1)
        short = sorted(p for p in owners if p.count(b" ") <= window)
        #: Each table with the items of its patterns, by pattern number.
        self.tables = [(WuManber(ps), [owners[p] for p in ps]) for ps in (full, short) if ps]

    def hits(self, texts: list[bytes]) -> list[list[tuple[int, int, tuple[str, ...]]]]:
        """Occurrences in each text as (position, words, items). Texts are padded with spaces and follow each other after a line end."""
        out: list[list] = [[] for _ in texts]
        begin = np.cumsum([0] + [len(t) + 1 for t in texts])
        joined = b"\n".join(texts)
        for table, owners in self.tables:
            for at, p in table.search(joined):
                k = int(np.searchsorted(begin, at, side="right")) - 1
                out[k].append((at - int(begin[k]), table.patterns[p].count(b" ") - 1, owners[p]))
        return out


def _judge(texts: list[str | None], benchmark: Benchmark) -> list[tuple[int, list[tuple[int, int]], list[str]]]:
    """(words, spans of hit words, items) of each text."""
    out = []
    for first in _slices([len(t or "") for t in texts]):
        part = [words_of(t) for t in texts[first[0]:first[1]]]
        padded = [b" " + b" ".join(w) + b" " for w in part]
        for words, text, found in zip(part, padded, benchmark.hits(padded)):
            spans, items = [], set()
            for at, n, own in found:
                # The spaces up to a match, its own first one included, number its first word.
                spans.append((at, n))
                items.update(own)
            if spans:
                spaces = np.flatnonzero(np.frombuffer(text, np.uint8) == 32)
                spans = sorted({(int(np.searchsorted(spaces, at)), n) for at, n in spans})
            out.append((len(words), spans, list(items)))
    return out


def _slices(sizes: list[int]):
    begin = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > BATCH_BYTES:
            yield begin, i
            begin, total = i, 0
        total += n
    if begin < len(sizes):
        yield begin, len(sizes)


def _covered(spans) -> int:
    total = reach = 0
    for start, n in sorted(spans):
        total += max(0, start + n - max(start, reach))
        reach = max(reach, start + n)
    return total


def _passes(benchmark: DataFrame, limit: int) -> Iterator[list[tuple[str, str]]]:
    """The items in groups of at most ``limit`` bytes, but for a single larger item. The benchmark is the stated query set. The
    driver fetches it part by part as the passes ask for them, and holds one group and one part at a time."""
    parts = partitions_for(benchmark.sparkSession, benchmark.agg(F.sum(F.octet_length(text_of()))).first()[0] or 0, limit)
    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), text_of().alias("text"))
    group, size = [], 0
    for r in rows.repartitionByRange(parts, "item_id", "text").sortWithinPartitions("item_id", "text").toLocalIterator():
        n = len(r["text"].encode())
        if size and size + n > limit:
            yield group
            group, size = [], 0
        group.append((str(r["item_id"]), r["text"]))
        size += n
    yield group


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """``row`` (the other columns), ``text``, n_words, ``spans`` (first word, words) and ``items`` for each input row.

    A window is ``window`` consecutive words of an item, or the whole item if it has fewer, but not none. Null
    and empty texts have no words. Repeated rows and ids are rows like others; an empty benchmark hits nothing.
    A pass over the documents holds the tables of at most ``pass_bytes`` of benchmark text. Where more than one is needed, each but the last is
    written to the shared folder and its tables are given up before the next.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "contamination")
    rows = apart(docs, F.lit(0).cast("long").alias("n_words"), F.expr("CAST(array() AS array<struct<first:int,n:int>>)").alias("spans"),
                 F.expr("CAST(array() AS array<string>)").alias("items"))
    schema = beside_row(rows, "text string, n_words long, spans array<struct<first:int,n:int>>, items array<string>")
    held = None
    for nth, group in enumerate(_passes(benchmark, pass_bytes)):
        if held is not None:
            kept = scratch.keep(rows, f"pass{nth}")
            held.unpersist(blocking=True)
            scratch.release(f"pass{nth - 1}")
            rows = kept
        tables = held = spark.sparkContext.broadcast({"items": group})  # bounded by pass_bytes

        def search(batches, tables=tables):
            # The value lives in the Python worker as long as the broadcast, so its tables are built once and serve all tasks there.
            own = tables.value.get("tables")
            if own is None:
                own = tables.value["tables"] = Benchmark(tables.value["items"], window)
            for batch in batches:
                texts = batch.column("text").to_pylist()
                spans, items = batch.column("spans").to_pylist(), batch.column("items").to_pylist()
                judged = _judge(texts, own)
                yield pa.RecordBatch.from_arrays([
                    batch.column("row"), batch.column("text"), pa.array([n for n, _, _ in judged], pa.int64()),
                    pa.array([had + [{"first": a, "n": n} for a, n in new] for had, (_, new, _) in zip(spans, judged)],
                             pa.list_(pa.struct([("first", pa.int32()), ("n", pa.int32())]))),
                    pa.array([sorted({*had, *new}) for had, (_, _, new) in zip(items, judged)], pa.list_(pa.string()))],
                    ["row", "text", "n_words", "spans", "items"])

        rows = rows.mapInArrow(search, schema)
    return rows


def contamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row per input row: doc_id, its words, those inside a window of the benchmark, and the items found."""
    found = find_contamination(docs.select("doc_id", "text"), benchmark, **options)

    def count(batches):
        for batch in batches:
            spans = batch.column("spans").to_pylist()
            items = batch.column("items").to_pylist()
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("n_words"),
                pa.array([_covered([(s["first"], s["n"]) for s in x]) for x in spans], pa.int64()),
                pa.array(list(map(len, items)), pa.int64()),
                pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in items], pa.string())],
                ["doc_id", "n_words", "n_hit", "n_items", "items_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = found.select(F.col("row.doc_id").alias("doc_id"), "n_words", "spans", "items").mapInArrow(
        count, f"doc_id {kind}, n_words long, n_hit long, n_items long, items_sha256 string")
    return rows.withColumn("contaminated", F.col("n_hit") > 0)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` in which no window of the benchmark occurs."""
    return together(find_contamination(docs, benchmark, **options).where(F.size("spans") == 0), docs)
