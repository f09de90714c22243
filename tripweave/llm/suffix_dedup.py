"""Suffix-array dedup over bytes, by distributed prefix doubling.

Positions are ranked by what follows them, in rounds of growing length. The first round is Spark's: it hashes
``GRAM`` bytes, groups and sorts positions by that rank, and drops those whose rank is unique.
For windows that is enough to look at one position in about sixty-nine (see ``repeats``). The later rounds run where Spark's
shuffle and sort brought equal first ranks together: pairs of ranks at offsets 8, 16, 32, ... are sorted, equal pairs get
one new rank, until every rank is unique or the threshold is passed. Ranks in these rounds are exact, not hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.llm.common import Scratch, beside_row
from tripweave.llm.repeats import HOT, Kind, Shard, copies, merged, repeated_spans, stored

WINDOW, GRAM = 200, 64


def byte_symbols(texts: list[str]) -> tuple[np.ndarray, list[int]]:
    raw = [t.encode() for t in texts]
    joined = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint64)
    return (joined + np.uint64(0x9E3779B9)) * np.uint64(0x9E3779B97F4A7C15), list(map(len, raw))


def byte_kind(window: int = WINDOW) -> Kind:
    return Kind(window, max(1, min(GRAM, window // 3)), byte_symbols, str.encode, lambda raw, a, b: raw[a:b])


def _ranked(key: np.ndarray) -> np.ndarray:
    """Ranks from 1 by sorting; equal keys share one."""
    order = np.argsort(key)
    sorted_ = key[order]
    rank = np.empty(len(key), np.uint64)
    rank[order] = np.cumsum(np.concatenate([[True], sorted_[1:] != sorted_[:-1]])).astype(np.uint64)
    return rank


def prefix_doubling(text: np.ndarray, starts: np.ndarray, window: int) -> np.ndarray:
    """Ranks of the ``window`` bytes at ``starts``: equal where the bytes are. Starts need not be near the end of ``text``.

    A round only sorts positions that a start still needs; a start whose rank is unique is done.
    """
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    n, length = len(text), min(8, window)
    first = np.ndarray((n,), "<u8", padded.data, 0, (1,)) & np.uint64((1 << 8 * length) - 1)
    rank = _ranked(first.copy())
    while length < window:
        step = min(length, window - length)
        pair = np.zeros(n, np.uint64)
        pair[:n - step] = rank[:n - step] << np.uint64(32) | rank[step:]
        if length + step >= window:
            return _ranked(pair[starts])
        rank = _ranked(pair)
        length += step
    return rank[starts]


def repeated_windows(window: int):
    """Picks the windows of a shard that start more than once in it."""
    def judge(shard: Shard, occurrence: np.ndarray, place: np.ndarray) -> np.ndarray:
        text = np.frombuffer(b"".join(shard.segs), np.uint8)
        begin = np.cumsum([0] + [len(s) for s in shard.segs])[:-1]
        r = shard.windows
        seg = np.repeat(np.arange(len(r)), r)
        inside = np.arange(r.sum()) - np.repeat(np.cumsum(r) - r, r)
        rank = prefix_doubling(text, begin[seg] + inside, window)
        # Each distinct segment counts as often as it occurs.
        often = np.bincount(shard.which, minlength=len(r))
        seen = np.bincount(rank.astype(np.int64), weights=often[seg])
        offset = np.cumsum(r) - r
        return seen[rank.astype(np.int64)][offset[shard.which[occurrence]] + place] > 1

    return judge


def repeated_hot(windows: DataFrame) -> DataFrame:
    again = windows.groupBy("g1", "g2").agg(F.count("*").alias("n")).where("n > 1")
    return windows.join(again, ["g1", "g2"])


def drop_repeated_bytes(docs: DataFrame, window: int = WINDOW, hot: int = HOT) -> DataFrame:
    """``row`` (the other columns), ``kept`` (the bytes that stay), n_bytes, n_removed and n_spans for each input row.

    A byte of the UTF-8 text goes if a string of ``window`` bytes covers it that starts anywhere else too, in the same document
    included. Strings never cross documents. Null and empty texts have no bytes; repeated rows are copies of each other whatever
    their ids; an empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "suffixes")
    kind = byte_kind(window)
    table = stored(docs, scratch)
    # Every copy of a whole text goes whole; one of them stays in the search for the others' sake.
    whole = scratch.keep(copies(table).select("rid", "one", F.lit(True).alias("all")), "copies")
    spans = repeated_spans(table, kind, repeated_windows(window), repeated_hot, scratch, whole, hot)
    rows = table.select("rid", "row", "text").join(spans, "rid", "left").select("row", "text", "spans")

    def cut(batches):
        for batch in batches:
            kept, sizes, gone, runs = [], [], [], []
            for text, found in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                raw = text.encode()
                at, parts, stretches = 0, [], merged(found, len(raw), window)
                for a, b in stretches:
                    parts.append(raw[at:a])
                    at = b
                kept.append(b"".join([*parts, raw[at:]]))
                sizes.append(len(raw))
                gone.append(len(raw) - len(kept[-1]))
                runs.append(len(stretches))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(kept, pa.binary()), *[pa.array(x, pa.int64()) for x in (sizes, gone, runs)]],
                ["row", "kept", "n_bytes", "n_removed", "n_spans"])

    return rows.mapInArrow(cut, beside_row(rows, "kept binary, n_bytes long, n_removed long, n_spans long"))
