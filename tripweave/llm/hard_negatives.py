"""Hard negatives by angular triangle filtering.

Scores are integer inner products. Every row keeps its angles to a few reference directions. For a block of
rows these give windows; with an anchor's own angles the triangle inequality bounds the angle between the anchor and
any row of the block, and the norms turn that into an interval of scores, widened for rounding. Only where the
interval overlaps the scores an anchor still asks for are the integers multiplied.

Anchors come in passes of a bounded number, broadcast with what they ask for; the table streams by.
A first look at one row in ``SHARE`` gives each anchor a floor that its answers cannot lie below, so that the
pass over all rows sends on few rows for each anchor, however many tasks there are.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.llm.common import Scratch

POSITIVES, NEGATIVES = 5, 3
#: Negative scores in percent of the positive's.
LEAST_PERCENT, MOST_PERCENT = 50, 95
#: Anchors of one pass, rows of one window, reference directions and the rows they are drawn from at most.
PASS, WINDOW, REFERENCES, REFERENCE_ROWS = 16_384, 512, 8, 4096
#: One row in so many gives the floors.
SHARE = 64
#: Doubles multiply integers exactly below this.
EXACT = 1 << 53
LEAST, MOST = -(1 << 63), (1 << 63) - 1
LARGEST = float(1 << 200)


def whole_components(values: pa.ListArray) -> np.ndarray:
    """floor(256 * x) of each component of vectors of one length, as doubles that are whole numbers; held at +-LARGEST."""
    flat = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    with np.errstate(over="ignore"):
        return np.clip(np.floor(256 * flat), -LARGEST, LARGEST).reshape(len(values), -1)


def scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact integer inner products, held at the ends of a long where they lie beyond."""
    high = float(np.abs(anchors).max(initial=0)) * float(np.abs(rows).max(initial=0)) * anchors.shape[1]
    if high < EXACT:
        return (anchors @ rows.T).astype(np.int64)
    ints = lambda m: np.array([[int(x) for x in r] for r in m], object).reshape(m.shape)
    return np.clip(ints(anchors) @ ints(rows).T, LEAST, MOST).astype(np.int64)


def angles_of(rows: np.ndarray, norms: np.ndarray, references: np.ndarray) -> np.ndarray:
    """The angle of each row to each reference direction; a zero row counts as orthogonal, its norm decides."""
    unit = rows / np.where(norms > 0, norms, 1)[:, None]
    return np.arccos(np.clip(unit @ references.T, -1, 1))


@dataclass
class Pass:
    """A block of anchors of one width, sorted by number, and what each may still find."""

    number: np.ndarray
    vec_id: np.ndarray
    label: np.ndarray
    rows: np.ndarray
    references: np.ndarray
    #: Intervals of scores each anchor asks for: (anchors, intervals), both ends included.
    low: np.ndarray
    high: np.ndarray
    #: Whether rows of the anchor's label are asked for, or of another.
    same: bool
    most: int

    def __post_init__(self):
        self.norms = np.sqrt((self.rows * self.rows).sum(axis=1))
        self.angles = angles_of(self.rows, self.norms, self.references)


def score_bounds(asked: Pass, norms: np.ndarray, angles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """No score of an anchor with any row of these norms and angles lies outside (lowest, highest); one number for each anchor."""
    least, most = angles.min(axis=0), angles.max(axis=0)
    # The angle of anchor and row is at least the distance of the anchor's angle from the window, and at most their sum,
    # or what is left of the full turn.
    near = np.maximum(np.maximum(least - asked.angles, asked.angles - most), 0).max(axis=1)
    far = np.minimum(asked.angles + most, 2 * np.pi - asked.angles - least)
    far = np.clip(far, 0, np.pi).min(axis=1)
    slack = 1e-6
    top, bottom = np.cos(np.maximum(near - slack, 0)), np.cos(np.minimum(far + slack, np.pi))
    longest, shortest = norms.max(), norms.min()
    lift = lambda c, up: asked.norms * np.where((c > 0) == up, longest, shortest) * c
    room = asked.norms * longest * 1e-6 + 1
    return lift(bottom, False) - room, lift(top, True) + room


class Best:
    """For each (anchor, interval) of a pass the ``most`` best (score, least id) seen so far."""

    def __init__(self, asked: Pass):
        self.asked = asked
        n, k = asked.low.shape
        self.score = np.full((n, k, asked.most), LEAST, np.int64)
        self.ids = np.full((n, k, asked.most), MOST, np.int64)
        self.held = np.zeros((n, k, asked.most), bool)
        self.floor = asked.low.copy()
        self.scored = self.seen = 0

    def add(self, vec_id: np.ndarray, label: np.ndarray, rows: np.ndarray, norms: np.ndarray, angles: np.ndarray) -> None:
        """One window of rows."""
        asked = self.asked
        self.seen += len(asked.rows) * len(rows)
        low, high = score_bounds(asked, norms, angles)
        some = np.flatnonzero(((high[:, None] >= self.floor) & (low[:, None] <= asked.high)).any(axis=1))
        for a in range(0, len(some), 1024):
            at = some[a:a + 1024]
            self.scored += len(at) * len(rows)
            found = scores(asked.rows[at], rows)
            fits = (asked.label[at][:, None] == label) == asked.same
            fits &= asked.vec_id[at][:, None] != vec_id
            for k in range(asked.low.shape[1]):
                i, j = np.nonzero(fits & (found >= self.floor[at, k][:, None]) & (found <= asked.high[at, k][:, None]))
                if len(i):
                    self._merge(at[i], k, found[i, j], vec_id[j])

    def _merge(self, anchor: np.ndarray, k: int, score: np.ndarray, ids: np.ndarray) -> None:
        who = np.unique(anchor)
        held = self.held[who, k]
        anchor = np.concatenate([np.repeat(who, self.asked.most)[held.ravel()], anchor])
        score = np.concatenate([self.score[who, k][held], score])
        ids = np.concatenate([self.ids[who, k][held], ids])
        order = np.lexsort((ids, -1 - score, anchor))
        anchor, score, ids = anchor[order], score[order], ids[order]
        new = np.r_[True, (np.diff(anchor) != 0) | (np.diff(score) != 0) | (np.diff(ids) != 0)]
        anchor, score, ids = anchor[new], score[new], ids[new]
        start = np.r_[True, np.diff(anchor) != 0]
        rank = np.arange(len(anchor)) - np.flatnonzero(start)[np.cumsum(start) - 1]
        best = rank < self.asked.most
        anchor, score, ids, rank = anchor[best], score[best], ids[best], rank[best]
        self.held[who, k] = False
        self.score[anchor, k, rank], self.ids[anchor, k, rank], self.held[anchor, k, rank] = score, ids, True
        full = self.held[who, k, -1]
        self.floor[who[full], k] = np.maximum(self.floor[who[full], k], self.score[who[full], k, -1])

    def rows(self) -> pa.RecordBatch:
        a, k, r = np.nonzero(self.held)
        return pa.RecordBatch.from_arrays(
            [pa.array(self.asked.number[a]), pa.array(k.astype(np.int32)), pa.array(self.score[a, k, r]), pa.array(self.ids[a, k, r])],
            ["number", "k", "score", "vec_id"])


FOUND = "number long, k int, score long, vec_id long"


def _search(rows: DataFrame, asked: Pass) -> DataFrame:
    """The best of each task for each (anchor, interval), merged: (number, k, score, vec_id), at most ``asked.most`` of each."""
    box = rows.sparkSession.sparkContext.broadcast(asked)
    width = asked.rows.shape[1]

    def search(batches):
        best = Best(box.value)
        for batch in batches:
            vectors = batch.column("vec")
            x = np.frombuffer(b"".join(vectors.to_pylist()), "<f8").reshape(-1, width)
            angles = np.frombuffer(b"".join(batch.column("angles").to_pylist()), "<f8").reshape(len(x), -1)
            vec_id, label, norms = (batch.column(c).to_numpy() for c in ("vec_id", "label", "norm"))
            for a in range(0, len(x), WINDOW):
                best.add(*(v[a:a + WINDOW] for v in (vec_id, label, x, norms, angles)))
        yield best.rows()

    found = rows.where(F.col("width") == width).select("vec_id", "label", "vec", "norm", "angles").mapInArrow(search, FOUND)
    # Ids of equal score count once; the map side keeps what the task kept.
    order = F.struct((-1 - F.col("score")).alias("s"), F.col("vec_id").alias("v"))
    top = found.groupBy("number", "k").agg(F.array_sort(F.collect_set(order)).alias("all"))
    return top.select("number", "k", F.explode(F.slice("all", 1, asked.most)).alias("x")).select(
        "number", "k", (-1 - F.col("x.s")).alias("score"), F.col("x.v").alias("vec_id"))


def _floors(found: DataFrame, asked: Pass) -> np.ndarray:
    """The intervals' lower ends, raised to the worst of ``most`` rows already found."""
    worst = found.groupBy("number", "k").agg(F.min("score").alias("s"), F.count("*").alias("n")).where(F.col("n") >= asked.most).toArrow()
    low = asked.low.copy()
    at = np.searchsorted(asked.number, worst["number"].to_numpy())
    k = worst["k"].to_numpy()
    low[at, k] = np.maximum(low[at, k], worst["s"].to_numpy())
    return low


def _ask(stored: DataFrame, asked: Pass, scratch: Scratch, name: str) -> DataFrame:
    few = stored.where(F.pmod(F.xxhash64("vec_id"), F.lit(SHARE)) == 0)
    asked.low = _floors(_search(few, asked), asked)
    return scratch.keep(_search(stored, asked), name)


def _stored(rows: DataFrame, references: dict[int, np.ndarray]) -> DataFrame:
    """Whole components as packed doubles, with norm and angles; rows of like angles lie together in a file."""
    box = rows.sparkSession.sparkContext.broadcast(references)

    def store(batches):
        for batch in batches:
            values = batch.column("embedding").cast(pa.list_(pa.float64()))
            widths = np.diff(values.offsets.to_numpy())
            for width, directions in box.value.items():
                at = pa.array(np.flatnonzero(widths == width))
                if len(at):
                    x = whole_components(values.take(at))
                    norms = np.sqrt((x * x).sum(axis=1))
                    angles = angles_of(x, norms, directions)
                    near = angles.argmin(axis=1)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("vec_id").take(at), batch.column("label").take(at), pa.array(np.full(len(at), width, np.int32)),
                         pa.array(near.astype(np.int32)), pa.array(angles.min(axis=1)), pa.array(norms),
                         pa.array([a.tobytes() for a in angles], pa.binary()), pa.array([v.tobytes() for v in x], pa.binary())], STORED_NAMES)

    return rows.mapInArrow(store, STORED).sortWithinPartitions("width", "near", "angle")


STORED = "vec_id long, label long, width int, near int, angle double, norm double, angles binary, vec binary"
STORED_NAMES = [c.split()[0] for c in STORED.split(", ")]


def _references(rows: DataFrame, width: int) -> np.ndarray:
    """Directions spread over a bounded sample: each next one is the row farthest from those before."""
    rows = rows.where(F.size("embedding") == width)
    share = max(1, rows.count() // REFERENCE_ROWS)
    some = rows.where(F.pmod(F.xxhash64("vec_id", "label", "embedding"), F.lit(share)) == 0).select(
        F.col("embedding").cast("array<double>").alias("v")).limit(2 * REFERENCE_ROWS).toArrow()["v"]
    x = np.array([w for v in some.chunks if len(v) for w in whole_components(v)]).reshape(-1, width)
    norms = np.sqrt((x * x).sum(axis=1))
    x = x[norms > 0] / norms[norms > 0][:, None]
    if not len(x):
        return np.eye(1, width)
    chosen = [x[0]]
    near = x @ x[0]
    while len(chosen) < min(REFERENCES, len(x)):
        chosen.append(x[int(near.argmin())])
        near = np.maximum(near, x @ chosen[-1])
    return np.array(chosen)


def mine_hard_negatives(
    vectors: DataFrame, is_anchor=None, positives: int = POSITIVES, negatives: int = NEGATIVES,
    least_percent: int = LEAST_PERCENT, most_percent: int = MOST_PERCENT, anchors_a_pass: int = PASS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score over ``vectors`` (vec_id, embedding, label).

    ``is_anchor`` is a condition on vec_id, by default vec_id % 50 = 0. Rows with a null id, label or vector, or a null or non-finite
    component, take no part; neither do empty vectors. Vectors of other length than the anchor's are not compared with it. Ties go to
    the smaller vec_id. Rows that bear the anchor's own id are not "other" rows; rows of equal id and score count
    once for an anchor; an anchor whose id has rows of different label or vector is mined for each and its results
    are the distinct rows of all. Scores beyond a long are held at its ends. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "negatives")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", F.col("label").cast("long").alias("label"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("embedding") > 0)
                      & ~F.coalesce(F.exists("embedding", bad), F.lit(True)))
    anchors = rows.where((F.col("vec_id") % 50 == 0) if is_anchor is None else is_anchor)
    widths = sorted(r["w"] for r in anchors.select(F.size("embedding").alias("w")).distinct().collect())
    references = {w: _references(rows, w) for w in widths}
    stored = scratch.keep(_stored(rows, references), "stored")
    anchors = stored.where((F.col("vec_id") % 50 == 0) if is_anchor is None else is_anchor).distinct()
    counts = {r["width"]: r["n"] for r in anchors.groupBy("width").agg(F.count("*").alias("n")).collect()}
    out = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    for width, n in sorted(counts.items()):
        # Anchors are dealt to passes by hash, so that none holds many more than its share.
        passes = -(-n // anchors_a_pass)
        for p in range(passes):
            part = anchors.where((F.col("width") == width) & (F.pmod(F.xxhash64("vec_id", "label", "vec"), F.lit(passes)) == p)).toArrow()
            if part.num_rows:
                out = out.union(_mine(stored, part, references[width], positives, negatives, least_percent, most_percent, scratch, f"{width}-{p}"))
    return out.distinct()


def _mine(stored, part, references, positives, negatives, least_percent, most_percent, scratch, name) -> DataFrame:
    n = part.num_rows
    spark = stored.sparkSession
    order = np.lexsort((part["label"].to_numpy(), part["vec_id"].to_numpy()))
    part = part.take(pa.array(order))
    x = np.frombuffer(b"".join(part["vec"].to_pylist()), "<f8").reshape(n, -1)
    vec_id, label = part["vec_id"].to_numpy(), part["label"].to_numpy()
    asked = Pass(np.arange(n), vec_id, label, x, references, np.full((n, 1), LEAST), np.full((n, 1), MOST), True, positives)
    found = _ask(stored, asked, scratch, f"positives-{name}").orderBy("number", F.desc("score"), "vec_id").toArrow()
    number, score, positive = (found[c].to_numpy() for c in ("number", "score", "vec_id"))
    start = np.r_[True, np.diff(number) != 0] if len(number) else np.zeros(0, bool)
    place = np.arange(len(number)) - np.flatnonzero(start)[np.cumsum(start) - 1] if len(number) else np.zeros(0, np.int64)
    # Least and largest score that lie in percent of the positive's: whole numbers, in Python's integers.
    low, high = np.full((n, positives), MOST), np.full((n, positives), LEAST)
    low[number, place] = [max(LEAST, -(-least_percent * s // 100)) for s in score.tolist()]
    high[number, place] = [min(MOST, most_percent * s // 100) for s in score.tolist()]
    asked = Pass(np.arange(n), vec_id, label, x, references, low, high, False, negatives)
    hard = _ask(stored, asked, scratch, f"negatives-{name}")
    # One row for each positive of a pass.
    found = spark.createDataFrame(pa.table({"number": number, "k": pa.array(place, pa.int32()), "anchor_id": vec_id[number],
                                            "positive_id": positive, "positive_score": score}))
    order = F.struct((-1 - F.col("score")).alias("s"), F.col("vec_id").alias("v"))
    return hard.join(F.broadcast(found), ["number", "k"]).groupBy("number", "k", "anchor_id", "positive_id", "positive_score").agg(
        F.array_sort(F.collect_list(order)).alias("all")).select(
        "anchor_id", "positive_id", "positive_score", F.posexplode("all").alias("at", "x")).select(
        "anchor_id", "positive_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.v").alias("negative_id"),
        "positive_score", (-1 - F.col("x.s")).alias("negative_score"))
