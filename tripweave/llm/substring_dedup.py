"""Substring dedup over words: an FM-index per shard finds windows that start earlier elsewhere.

A shard indexes the distinct segments of its owners (see ``repeats``) and keeps nothing but the compressed index. The segments are then streamed
against it, some at a time: each window is searched backwards, word by word, over a wavelet matrix of the transformed text; windows whose matching statistic reaches the window length report their interval. All windows of one interval are equal,
so the earliest of them is the first occurrence in the corpus and the others go.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.llm.common import Scratch, beside_row
from tripweave.llm.fm_index import FMIndex
from tripweave.llm.repeats import HOT, BASE, INVERSE, Kind, Shard, copies, merged, mixed, powers, repeated_spans, stored

WINDOW, GRAM = 20, 8
#: Segments streamed against an index at once.
STREAMED = 4096


def word_symbols(texts: list[str]) -> tuple[np.ndarray, list[int]]:
    """A 64-bit hash of every word of some texts."""
    words = [t.encode().split() for t in texts]
    sizes = [len(w) for w in words]
    joined = b" ".join([b" ".join(w) for w in words if w])
    if not joined:
        return np.zeros(0, np.uint64), sizes
    raw = np.frombuffer(joined, np.uint8)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(0x9E3779B9)) * powers(len(raw), BASE), out=total[1:])
    gaps = np.flatnonzero(raw == 32)
    begin, end = np.concatenate([[0], gaps + 1]), np.concatenate([gaps, [len(raw)]])
    return mixed((total[end] - total[begin]) * powers(len(raw), INVERSE)[begin]), sizes


def word_kind(window: int = WINDOW) -> Kind:
    return Kind(window, max(1, min(GRAM, window * 2 // 5)), word_symbols, lambda t: t.encode().split(),
                lambda words, a, b: b" ".join(words[a:b]))


def first_windows(window: int):
    """Picks the windows of a shard that start earlier in the shard."""
    def judge(shard: Shard, occurrence: np.ndarray, place: np.ndarray) -> np.ndarray:
        # The text: word numbers from 1, a zero before each segment.
        ids: dict[bytes, int] = {}
        total = sum(s.count(b" ") + 2 for s in shard.segs)
        words = np.fromiter(chain.from_iterable(
            chain((0,), (ids.setdefault(w, len(ids) + 1) for w in s.split(b" "))) for s in shard.segs), np.int32, total)
        index = FMIndex(words, window)
        del words
        r = shard.windows
        length, low = np.zeros(int(r.sum()), np.int64), np.zeros(int(r.sum()), np.int64)
        done = 0
        for first in range(0, len(r), STREAMED):
            part, own = shard.segs[first:first + STREAMED], r[first:first + STREAMED]
            text = np.fromiter(chain.from_iterable(chain((0,), map(ids.__getitem__, s.split(b" "))) for s in part), np.int64)
            begin = np.flatnonzero(text == 0) + 1
            inside = np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)
            n = len(inside)
            length[done:done + n], low[done:done + n], _ = index.matching(text, np.repeat(begin, own) + inside + window, window, 2)
            done += n
        # Windows with the same interval are equal; the others are equal to nothing but their own copies.
        group = np.where(length >= window, low, index.bwt.n + np.arange(done))
        group = np.unique(group, return_inverse=True)[1]
        # Windows of an occurrence are numbered like those of its segment.
        offset = np.cumsum(r) - r
        own = group[offset[shard.which[occurrence]] + place]
        key = shard.doc[occurrence].astype(np.int64) << 32 | shard.lo[occurrence] + place
        earliest = np.full(int(group.max(initial=-1)) + 1, np.iinfo(np.int64).max)
        np.minimum.at(earliest, own, key)
        return key > earliest[own]

    return judge


def earlier_hot(windows: DataFrame) -> DataFrame:
    """Windows of hot owners that start earlier elsewhere; a null id comes last."""
    key = F.struct(F.col("doc").isNull().alias("none"), F.col("doc"), F.col("at"))
    first = windows.groupBy("g1", "g2").agg(F.min(key).alias("first"))
    return windows.join(first, ["g1", "g2"]).where(F.col("first") < key)


def drop_repeated_substrings(docs: DataFrame, window: int = WINDOW, hot: int = HOT) -> DataFrame:
    """``row`` (the other columns), ``text`` (the kept words, one space between), n_words and n_removed for each input row.

    A word goes if a window of ``window`` words covers it whose words also start earlier: in a smaller
    id, or in the same id at an earlier word. Rows that share an id are the same document at the same places, so
    neither is earlier; a null id comes after all others. Null and empty texts have no words; an empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "substrings")
    kind = word_kind(window)
    table = stored(docs, scratch)
    # A later copy of a whole text goes whole. Rows of the first id stay in the search, all of them.
    whole = scratch.keep(copies(table).select("rid", F.col("first").alias("one"), (~F.col("first")).alias("all")), "copies")
    spans = repeated_spans(table, kind, first_windows(window), earlier_hot, scratch, whole, hot)
    rows = table.select("rid", "row", "text").join(spans, "rid", "left").select("row", "text", "spans")

    def cut(batches):
        for batch in batches:
            kept, sizes, gone = [], [], []
            for text, found in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                words = text.encode().split()
                sizes.append(len(words))
                at, parts = 0, []
                for a, b in merged(found, len(words), window):
                    parts += words[at:a]
                    at = b
                parts += words[at:]
                gone.append(sizes[-1] - len(parts))
                kept.append(b" ".join(parts).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(kept, pa.string()), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64())],
                ["row", "text", "n_words", "n_removed"])

    return rows.mapInArrow(cut, beside_row(rows, "text string, n_words long, n_removed long"))
