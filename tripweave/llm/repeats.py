"""Where repeated windows of text are looked for: what the two substring operators share.

A window is ``window`` consecutive symbols. Each window is owned by the least hash among its grams of ``gram`` symbols, which
depends on the window's content alone, so equal windows have equal owners. Neighbouring windows mostly share
their owner and form a run. Only runs whose owner occurs more than once leave their document, as
segments of text, and all windows of an owner meet in one shard, where an index finds the equal ones exactly.

* Exact copies of whole texts are set aside first, by digest.
* An owner with more than ``HOT`` runs (a passage in very many documents) is not gathered: its windows are
  compared by 128-bit digests, which are counted map-side first.
* The text is written once, bucketed by row, and never shuffled again; positions and segments are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.llm.common import Scratch, apart, partitions_for

#: Runs of one owner that are gathered in one shard.
HOT = 20_000
#: Symbols hashed at once; windows in a run at most; bytes of text in a bucket; files a bucketed write may make.
BLOCK, MOST_WINDOWS, BUCKET_BYTES, MOST_FILES = 1 << 21, 4096, 24 << 20, 4000
#: Bytes of segments that one index holds.
INDEX_BYTES = 8 << 20
#: Fixed odd base of the rolling hash, and its inverse modulo 2**64.
BASE = 0xD1342543DE82EF95
INVERSE = pow(BASE, -1, 1 << 64)


@dataclass(frozen=True)
class Kind:
    """What a symbol is. ``symbols`` gives one 64-bit number a symbol for some texts, and the symbols in each;
    ``cut`` prepares a text for taking segments; ``size`` of it counts symbols."""

    window: int
    gram: int
    symbols: Callable[[list[str]], tuple[np.ndarray, list[int]]]
    prepare: Callable[[str], object]
    segment: Callable[[object, int, int], bytes]


def powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)


def sliding(least_or_most: np.ufunc, a: np.ndarray, width: int) -> np.ndarray:
    """The least or the most of every ``width`` neighbours."""
    size = 1
    while size * 2 <= width:
        a = least_or_most(a[:-size], a[size:])
        size *= 2
    return least_or_most(a[:len(a) - (width - size)], a[width - size:]) if size < width else a


def owners(symbols: np.ndarray, sizes: list[int], kind: Kind) -> tuple[np.ndarray, ...]:
    """(text number, first window, windows, owner) of the runs in some texts whose symbols follow each other.

    Where an owner stands twice within one run, as in periodic text, the run may repeat itself: a run of no windows
    is added, so that its owner counts as found again.
    """
    n, w, k = len(symbols), kind.window, kind.gram
    if n < w:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64))
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(symbols * powers(n, BASE), out=total[1:])
    grams = mixed((total[k:] - total[:-k]) * powers(n - k + 1, INVERSE))
    least = sliding(np.minimum, grams, w - k + 1)
    ends = np.cumsum(sizes)
    begins = ends - sizes
    text = np.repeat(np.arange(len(sizes)), sizes)[:len(least)]
    valid = np.flatnonzero(ends[text] - np.arange(len(least)) >= w)
    if not len(valid):
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64))
    value = least[valid]
    new = np.ones(len(valid), bool)
    new[1:] = (value[1:] != value[:-1]) | (valid[1:] != valid[:-1] + 1)
    first = np.flatnonzero(new)
    length = np.diff(np.append(first, len(valid)))
    parts = -(-length // MOST_WINDOWS)
    if (parts > 1).any():
        nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        first, length = np.repeat(first, parts) + nth * MOST_WINDOWS, np.repeat(length, parts) - nth * MOST_WINDOWS
        length = np.minimum(length, MOST_WINDOWS)
    where = text[valid[first]]
    rim = np.zeros(w - k, np.uint64)
    owner = np.flatnonzero(sliding(np.maximum, np.concatenate([rim, least, rim]), w - k + 1) == grams)
    twice = np.unique(grams[owner[1:]][grams[owner[1:]] == grams[owner[:-1]]])
    at = np.flatnonzero(np.isin(value[first], twice)) if len(twice) else np.zeros(0, np.int64)
    none = np.zeros(len(at), np.int64)
    return (np.concatenate([where, where[at]]), np.concatenate([valid[first] - begins[where], none]),
            np.concatenate([length, none]), np.concatenate([value[first], value[first][at]]))


def _runs_of(texts: list[str], kind: Kind) -> tuple[np.ndarray, ...]:
    """The runs of some texts. Texts are hashed in blocks, longer ones in overlapping pieces."""
    out: list[tuple[np.ndarray, ...]] = []

    def block(first: int, last: int) -> None:
        symbols, sizes = kind.symbols(texts[first:last])
        if len(symbols) <= 2 * BLOCK or last > first + 1:
            where, lo, r, v = owners(symbols, sizes, kind)
            out.append((where + first, lo, r, v))
            return
        for start in range(0, len(symbols) - kind.window + 1, BLOCK):
            piece = symbols[start:start + BLOCK + kind.window - 1]
            where, lo, r, v = owners(piece, [len(piece)], kind)
            out.append((where + first, lo + start, r, v))

    first = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > BLOCK:
            block(first, i)
            first = i
            size = 0
        size += len(t)
    block(first, len(texts))
    return tuple(np.concatenate(x) for x in zip(*out))


def _texts(batch: pa.RecordBatch) -> list[str]:
    return [t or "" for t in batch.column("text").to_pylist()]


def stored(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """rid, doc (the id), row (other columns), text and its digest, bucketed by rid."""
    rows = apart(docs).withColumns({
        "text": F.coalesce("text", F.lit("")), "rid": F.monotonically_increasing_id(), "doc": F.col("row.doc_id").cast("long")})
    rows = rows.withColumns({"d1": F.xxhash64(F.lit(1), "text"), "d2": F.xxhash64(F.lit(2), "text")})
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = int(min(max(8, -(-size // BUCKET_BYTES)), 50_000))
    tasks = docs.rdd.getNumPartitions()
    if tasks * buckets > MOST_FILES:
        few = MOST_FILES // buckets
        rows = rows.coalesce(few) if few >= 8 and few * 4 * BUCKET_BYTES >= size else rows.repartition(buckets, "rid")
    return scratch.bucketed(rows, "text", "rid", buckets)


def copies(table: DataFrame) -> DataFrame:
    """rid of the rows whose whole text others have, with ``first`` (no id of an earlier document has it) and ``n``.

    A null id counts as later than all others.
    """
    rows = table.select("rid", "doc", "d1", "d2")
    groups = rows.groupBy("d1", "d2").agg(
        F.count("*").alias("n"), F.min("doc").alias("least"), F.min("rid").alias("one")).where("n > 1")
    return rows.join(groups, ["d1", "d2"]).select("rid", "n", F.col("doc").eqNullSafe(F.col("least")).alias("first"),
                                                  (F.col("rid") == F.col("one")).alias("one"))


def repeated_runs(table: DataFrame, kind: Kind, scratch: Scratch, hot: int) -> DataFrame:
    """(rid, runs): the runs of each row whose owner occurs more than once, with ``often`` for hot owners."""
    def find(batches):
        for batch in batches:
            rid = batch.column("rid").to_numpy()
            where, lo, r, v = _runs_of(_texts(batch), kind)
            yield pa.RecordBatch.from_arrays([
                pa.array(v.view(np.int64)), pa.array(rid[where]), pa.array(lo.astype(np.int32)), pa.array(r.astype(np.int32))],
                ["v", "rid", "lo", "r"])

    runs = scratch.keep(table.select("rid", "text").mapInArrow(find, "v long, rid long, lo int, r int"), "runs", compression="zstd")
    often = runs.groupBy("v").agg(F.count("*").alias("n")).where("n > 1")
    again = runs.where("r > 0").join(often, "v").groupBy("rid").agg(
        F.collect_list(F.struct("lo", "r", "v", (F.col("n") > hot).alias("often"))).alias("runs"))
    return scratch.keep(again, "again", compression="zstd")


def _entries(batch: pa.RecordBatch) -> Iterator[tuple[int, int | None, str, list[dict]]]:
    return zip(batch.column("rid").to_pylist(), batch.column("doc").to_pylist(), _texts(batch), batch.column("runs").to_pylist())


def segments(table: DataFrame, again: DataFrame, kind: Kind) -> DataFrame:
    """(v, seg, r, rid, lo, doc) of the runs of ordinary owners."""
    def cut(batches):
        for batch in batches:
            rows = []
            for rid, doc, text, runs in _entries(batch):
                own = kind.prepare(text)
                rows += [(x["v"], kind.segment(own, x["lo"], x["lo"] + x["r"] + kind.window - 1), x["r"], rid, x["lo"], doc) for x in runs]
            for i in range(0, len(rows), 20_000):
                v, seg, r, rid, lo, doc = zip(*rows[i:i + 20_000])
                yield pa.RecordBatch.from_arrays([
                    pa.array(v, pa.int64()), pa.array(seg, pa.binary()), pa.array(r, pa.int32()), pa.array(rid, pa.int64()),
                    pa.array(lo, pa.int32()), pa.array(doc, pa.int64())], ["v", "seg", "r", "rid", "lo", "doc"])

    own = again.select("rid", F.filter("runs", lambda x: ~x["often"]).alias("runs")).where(F.size("runs") > 0)
    return table.select("rid", "doc", "text").join(own, "rid").mapInArrow(
        cut, "v long, seg binary, r int, rid long, lo int, doc long")


def hot_windows(table: DataFrame, again: DataFrame, kind: Kind) -> DataFrame:
    """(g1, g2, rid, at, doc): 128-bit digests of the windows of hot owners."""
    def digest(batches):
        for batch in batches:
            for rid, doc, text, runs in _entries(batch):
                own = kind.prepare(text)
                at = [x["lo"] + j for x in runs for j in range(x["r"])]
                for i in range(0, len(at), 50_000):
                    part = at[i:i + 50_000]
                    g = np.frombuffer(b"".join(xxhash.xxh3_128_digest(kind.segment(own, a, a + kind.window)) for a in part), "<i8").reshape(-1, 2)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(g[:, 0]), pa.array(g[:, 1]), pa.array([rid] * len(part), pa.int64()),
                        pa.array(part, pa.int32()), pa.array([doc] * len(part), pa.int64())], ["g1", "g2", "rid", "at", "doc"])

    own = again.select("rid", F.filter("runs", lambda x: x["often"]).alias("runs")).where(F.size("runs") > 0)
    return table.select("rid", "doc", "text").join(own, "rid").mapInArrow(
        digest, "g1 long, g2 long, rid long, at int, doc long")


@dataclass
class Shard:
    """Segments that one index holds: the distinct ones, and where each occurs."""

    segs: list[bytes]
    windows: np.ndarray  # of each distinct segment
    which: np.ndarray  # distinct segment of each occurrence
    rid: np.ndarray
    lo: np.ndarray
    doc: np.ndarray  # dense order of the documents, null last


def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[Shard]:
    """Rows come sorted by owner; a shard takes whole owners until it is large enough."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        v = batch.column("v").to_numpy()
        start = 0
        for cut in [*(np.flatnonzero(np.diff(v)) + 1).tolist(), len(v)]:
            if size > INDEX_BYTES and held and (start or held[-1].column("v")[-1].as_py() != v[0]):
                yield _shard(held)
                held, size = [], 0
            if cut > start:
                part = batch.slice(start, cut - start)
                held.append(part)
                size += int(np.sum(part.column("r").to_numpy())) + 200 * (cut - start)
                start = cut
    if held:
        yield _shard(held)


def _shard(held: list[pa.RecordBatch]) -> Shard:
    table = pa.Table.from_batches(held)
    ids: dict[bytes, int] = {}
    which = np.array([ids.setdefault(s, len(ids)) for s in table["seg"].to_pylist()], np.int64)
    r = table["r"].to_numpy()
    windows = np.zeros(len(ids), np.int64)
    windows[which] = r
    doc = table["doc"].to_pandas()
    order = np.where(doc.isna(), np.iinfo(np.int64).max, table["doc"].fill_null(0).to_numpy())
    return Shard(list(ids), windows, which, table["rid"].to_numpy(), table["lo"].to_numpy().astype(np.int64),
                 np.unique(order, return_inverse=True)[1])


def _spans(rid: np.ndarray, at: np.ndarray, window: int) -> pa.RecordBatch:
    """Windows, in order within their row, as merged stretches (rid, first, end)."""
    new = np.ones(len(at), bool)
    new[1:] = (rid[1:] != rid[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1 if len(at) else first
    return pa.RecordBatch.from_arrays(
        [pa.array(rid[first]), pa.array(at[first].astype(np.int64)), pa.array(at[last].astype(np.int64) + window)], ["rid", "a", "b"])


def judged(shard: Shard, judge: Callable[[Shard, np.ndarray, np.ndarray], np.ndarray], window: int) -> pa.RecordBatch:
    """The stretches of a shard's windows that ``judge`` (occurrence, place in the segment) picks."""
    r = shard.windows[shard.which]
    occurrence = np.repeat(np.arange(len(r)), r)
    place = np.arange(r.sum()) - np.repeat(np.cumsum(r) - r, r)
    gone = judge(shard, occurrence, place)
    return _spans(shard.rid[occurrence[gone]], shard.lo[occurrence[gone]] + place[gone], window)


def repeated_spans(table: DataFrame, kind: Kind, judge: Callable, hot_rule: Callable[[DataFrame], DataFrame],
                   scratch: Scratch, whole: DataFrame, hot: int = HOT) -> DataFrame:
    """(rid, spans): stretches to remove of each row. ``whole`` has the rows that need no search, which go whole."""
    searched = table.join(whole.where(~F.col("one")).select("rid"), "rid", "left_anti")
    again = repeated_runs(searched, kind, scratch, hot)
    scratch.release("runs")
    seg = segments(table, again, kind)
    # Segments overlap: about window + run symbols for each run. A shard partition holds some tens of MB of them.
    n = partitions_for(table.sparkSession, again.agg(F.sum(F.size("runs"))).first()[0] or 0, 60_000)

    def index(batches):
        for shard in shards(batches):
            yield judged(shard, judge, kind.window)

    spans = seg.repartition(n, "v").sortWithinPartitions("v").mapInArrow(index, "rid long, a long, b long")
    if not again.where(F.exists("runs", lambda x: x["often"])).isEmpty():
        windows = hot_rule(hot_windows(table, again, kind))
        spans = spans.union(windows.select("rid", F.col("at").cast("long").alias("a"), (F.col("at") + kind.window).cast("long").alias("b")))
    # A stretch without end stands for the whole text.
    spans = spans.union(whole.where("all").select("rid", F.lit(0).cast("long"), F.lit(-1).cast("long")))
    return scratch.keep(spans.groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("a", "b"))).alias("spans")), "spans")


def merged(spans: list[dict] | None, size: int, window: int) -> list[tuple[int, int]]:
    """Disjoint stretches in order. An endless one means the whole text, if it has a window at all."""
    out: list[tuple[int, int]] = []
    for s in spans or ():
        a, b = s["a"], s["b"]
        if b < 0:
            return [(0, size)] if size >= window else []
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out
