"""Near-duplicate vectors by product quantisation over inverted lists.

A bounded sample gives coarse directions and, for each subspace of the residuals, 256 code words. Every row is stored
in the list of its nearest direction with one byte a subspace and the exact length of what the code leaves out. A row
asks its own list and those whose direction is nearly as close (``margin``); all that shuffles is a row for its own list
and one for each list it asks. In a list, table look-ups give the score of each (asking row, stored code); by the stored
length no pair above the threshold is lost there, and exact cosines decide what remains. A task
gives counts and a star for each connected set, never pairs.

A list too large for one task is cut in blocks, and pairs of blocks are compared. Dense places of such lists get pivots:
rows within half the threshold's angle of one pivot are all linked by the triangle inequality, so they count
as one group without any comparison, and only what lies outside is compared with them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripweave.llm.common import Scratch, partitions_for, small_side
from tripweave.llm.components import connected

THRESHOLD = 0.9
#: Rows that the index is fitted on at most (twice that bounds what reaches the driver), and rows a list holds on average.
SAMPLE, LIST_ROWS, MOST_LISTS = 32_768, 4096, 4096
#: Components of one subspace, its code words, and lists that a row asks at most besides its own.
SUBSPACE, WORDS, VISITS = 8, 256, 8
#: Stored rows of one block, asking rows of one block, and rows scored at once.
BLOCK, ASKING_BLOCK, AT_ONCE = 8192, 65_536, 256
#: Sampled rows in all that pivots are looked for among, and pivots of one list at most.
PIVOT_SAMPLE, PIVOTS = 16_384, 8
SLACK = 1e-4


@dataclass
class Index:
    """What the sample gives: unit directions, subspaces of the residual, code words."""

    width: int
    threshold: float
    centres: np.ndarray
    parts: list[np.ndarray]
    words: list[np.ndarray]

    @property
    def margin(self) -> float:
        """Scores of a row's nearest list and its partner's differ by chance by about this: two unit vectors ``gap`` apart
        see the difference of two directions, about 1.4 long, under that much noise in each of ``width`` components."""
        gap = np.sqrt(2 - 2 * self.threshold)
        return float(1.6 * 1.4 * gap / np.sqrt(self.width))


def _kmeans(rows: np.ndarray, k: int, rounds: int, unit: bool, rng: np.random.Generator) -> np.ndarray:
    centres = rows[rng.choice(len(rows), min(k, len(rows)), replace=False)]
    for _ in range(rounds):
        near = _nearest(rows, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, rows)
        counts = np.bincount(near, minlength=len(centres))[:, None]
        centres = np.where(counts > 0, sums / np.maximum(counts, 1), centres)
        if unit:
            length = np.linalg.norm(centres, axis=1, keepdims=True)
            centres = np.where(length > 1e-6, centres / np.maximum(length, 1e-6), rows[rng.choice(len(rows), len(centres))])
    return centres


def _nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    half = (centres * centres).sum(axis=1) / 2
    return np.concatenate([(rows[i:i + 4096] @ centres.T - half).argmax(axis=1) for i in range(0, len(rows), 4096)])


def fit(sample: np.ndarray, rows: int, threshold: float = THRESHOLD, list_rows: int = LIST_ROWS) -> Index:
    """An index for ``rows`` unit vectors, fitted on ``sample``."""
    rng = np.random.default_rng(42)
    lists = int(min(MOST_LISTS, max(1, -(-rows // list_rows)), max(1, len(sample) // 8)))
    centres = _kmeans(sample, lists, 8, True, rng)
    rest = sample - centres[_nearest(sample, centres)]
    parts = np.array_split(np.arange(sample.shape[1]), max(1, sample.shape[1] // SUBSPACE))
    return Index(sample.shape[1], threshold, centres, parts, [_kmeans(rest[:, p], WORDS, 6, False, rng) for p in parts])


def _unit_rows(values: pa.ListArray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows scaled by powers of two to below 1 as doubles, their lengths); ``values`` all have ``width`` components."""
    x = np.asarray(values.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(values), width)
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, initial=0))[1][:, None])
    return x, np.sqrt((x * x).sum(axis=1))


def _valid(column: str = "embedding"):
    """Neither null nor empty, no null or non-finite component, not all zero."""
    v = F.col(column)
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return v.isNotNull() & ~F.coalesce(F.exists(v, bad), F.lit(True)) & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False))


INDEX = "rid long, vec_id long, home int, visits binary, vec binary, codes binary, least float"


def _store(rows: DataFrame, index: Index | None) -> DataFrame:
    """Each valid row in its list. Rows of another length than the index has get a list of that length alone, without codes."""
    box = rows.sparkSession.sparkContext.broadcast(index)

    def store(batches):
        index = box.value
        for batch in batches:
            values = batch.column("embedding").cast(pa.list_(batch.schema.field("embedding").type.value_type))
            widths = np.diff(values.offsets.to_numpy())
            for width in np.unique(widths).tolist():
                at = np.flatnonzero(widths == width)
                some = values.take(pa.array(at))
                x, length = _unit_rows(some, width)
                u = x / length[:, None]
                n = len(at)
                home, visits, codes, least = np.full(n, -1 - width), [b""] * n, [b""] * n, np.full(n, -2.0)
                if index is not None and width == index.width:
                    scores = u @ index.centres.T
                    home = scores.argmax(axis=1)
                    best = scores[np.arange(n), home]
                    take = min(VISITS + 1, scores.shape[1])
                    top = np.argpartition(-scores, take - 1, axis=1)[:, :take]
                    close = best[:, None] - np.take_along_axis(scores, top, 1) <= index.margin
                    visits = [np.sort(t[c & (t != h)]).astype("<i4").tobytes() for t, c, h in zip(top, close, home)]
                    rest = u - index.centres[home]
                    found = np.stack([_nearest(rest[:, p], w) for p, w in zip(index.parts, index.words)], axis=1).astype(np.uint8)
                    made = index.centres[home]
                    for j, (p, w) in enumerate(zip(index.parts, index.words)):
                        made[:, p] += w[found[:, j]]
                    off = np.sqrt(((u - made) ** 2).sum(axis=1))
                    gap = np.sqrt(2 - 2 * index.threshold)
                    least = np.maximum(index.threshold - off, (1 + (made ** 2).sum(axis=1) - (gap + off) ** 2) / 2) - SLACK
                    codes = [c.tobytes() for c in found]
                raw = x.astype(np.float32)
                exact = bool((raw.astype(np.float64) == x).all())
                vec = [(b"f" + v.tobytes()) if exact else (b"d" + w.tobytes()) for v, w in zip(raw, x)]
                yield pa.RecordBatch.from_arrays([
                    batch.column("rid").take(pa.array(at)), batch.column("vec_id").take(pa.array(at)), pa.array(home, pa.int32()),
                    pa.array(visits, pa.binary()), pa.array(vec, pa.binary()), pa.array(codes, pa.binary()),
                    pa.array(least.astype(np.float32))], ["rid", "vec_id", "home", "visits", "vec", "codes", "least"])

    return rows.mapInArrow(store, INDEX)


def _vector(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, "<f4" if packed[:1] == b"f" else "<f8", offset=1).astype(np.float64)


def _vectors(packed: list[bytes]) -> np.ndarray:
    if all(p[:1] == b"f" for p in packed) and len({len(p) for p in packed}) == 1:
        flat = np.frombuffer(b"".join(p[1:] for p in packed), "<f4")
        return flat.reshape(len(packed), -1).astype(np.float64)
    return np.stack([_vector(p) for p in packed])


def _half_angle(threshold: float) -> float:
    """The cosine of half the threshold's angle, a little more, so that rounding cannot link what is not."""
    return float(np.cos(np.arccos(threshold) / 2)) + 1e-9


def _pivots(index_rows: DataFrame, sizes: dict[int, int], threshold: float, block: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For each list of more than ``block`` rows (row ids, unit vectors) of pivots: dense places of a bounded sample."""
    hot = {h: n for h, n in sizes.items() if n > block}
    if not hot:
        return {}
    share = PIVOT_SAMPLE / sum(hot.values())
    rows = index_rows.where(F.col("home").isin(*hot)).where(
        F.pmod(F.xxhash64("rid"), F.lit(1 << 20)) < int(min(1, share) * (1 << 20))).limit(2 * PIVOT_SAMPLE).select("home", "rid", "vec").toArrow()
    home, rid, vec = np.array(rows["home"]), np.array(rows["rid"]), rows["vec"].to_pylist()
    out = {}
    for h in hot:
        at = np.flatnonzero(home == h)[:2048]
        if not len(at):
            continue
        u = _vectors([vec[i] for i in at])
        u /= np.linalg.norm(u, axis=1, keepdims=True)
        near = u @ u.T >= _half_angle(threshold)
        free, chosen = np.ones(len(at), bool), []
        while len(chosen) < PIVOTS:
            counts = (near & free).sum(axis=1)
            i = int(counts.argmax())
            if counts[i] < max(4, len(at) // 64):
                break
            chosen.append(i)
            free &= ~near[i]
        if chosen:
            out[h] = (rid[at[chosen]], u[chosen])
    return out


def _groups(home: np.ndarray, packed: list[bytes], pivots: dict, threshold: float) -> np.ndarray:
    """The row id of the first pivot within half the angle, else -1."""
    out = np.full(len(home), -1, np.int64)
    for h in np.unique(home).tolist():
        if h in pivots:
            at = np.flatnonzero(home == h)
            u = _vectors([packed[i] for i in at])
            u /= np.linalg.norm(u, axis=1, keepdims=True)
            near = u @ pivots[h][1].T >= _half_angle(threshold)
            out[at] = np.where(near.any(axis=1), pivots[h][0][near.argmax(axis=1)], -1)
    return out


def _entries(batch: pa.RecordBatch, pivots: dict, threshold: float):
    """(row number, list, asking?, group) for each list that a row of the index is stored in or asks."""
    home = batch.column("home").to_numpy()
    packed = batch.column("vec").to_pylist() if pivots else []
    group = _groups(home, packed, pivots, threshold)
    visits = [np.frombuffer(v, "<i4") for v in batch.column("visits").to_pylist()]
    counts = np.array([len(v) for v in visits], int)
    row = np.concatenate([np.arange(len(home)), np.repeat(np.arange(len(home)), counts)])
    lists = np.concatenate([home, *visits]).astype(np.int64)
    asking = np.arange(len(row)) >= len(home)
    return row, lists, asking, group


def _layout(index_rows: DataFrame, pivots: dict, threshold: float) -> dict[tuple[int, bool, int], int]:
    """Rows by (list, asking?, group); a few numbers for each list."""
    box = index_rows.sparkSession.sparkContext.broadcast(pivots)

    def count(batches):
        for batch in batches:
            row, lists, asking, group = _entries(batch, box.value, threshold)
            keys, n = np.unique(np.stack([lists, asking, group[row]]), axis=1, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(k) for k in (*keys, n)], ["list", "asking", "grp", "n"])

    columns = ["home", "visits", *(["vec"] if pivots else [])]
    found = index_rows.select(*columns).mapInArrow(count, "list long, asking long, grp long, n long")
    return {(r["list"], bool(r["asking"]), r["grp"]): r["n"] for r in found.groupBy("list", "asking", "grp").agg(F.sum("n").alias("n")).collect()}


class Blocks:
    """Which pairs of blocks a list is compared in."""

    def __init__(self, layout: dict[tuple[int, bool, int], int], block: int = BLOCK, asking_block: int = ASKING_BLOCK):
        self.first: dict[tuple[int, bool, int], tuple[int, int]] = {}
        self.groups: dict[int, list[int]] = {}
        self.stored: dict[int, int] = {}
        for asking in (False, True):
            for (c, a, g), n in sorted(layout.items()):
                if a == asking:
                    held = self.groups.setdefault(c, [])
                    cut = -(-n // (asking_block if a else block))
                    self.first[c, a, g] = (len(held), cut)
                    held += [g] * cut
            if not asking:
                self.stored = {c: len(g) for c, g in self.groups.items()}

    def keys(self, c: int, asking: bool, group: int, salt: int) -> list[tuple[int, int, int]]:
        """(i, j, side) of the comparisons a row takes part in: block i is stored, block j is compared with it."""
        first, cut = self.first[c, asking, group]
        stored, groups = self.stored.get(c, 0), self.groups[c]
        if not stored:
            return []
        if stored == 1 and len(groups) <= 2 and groups[0] == -1:
            return [(0, 0, int(asking))]
        me = first + salt % cut
        if asking:
            return [(i, me, 1) for i in range(stored)]
        same = lambda j: groups[j] == groups[me] != -1 and j < stored
        return [(me, j, 0) for j in range(me, len(groups)) if not same(j)] + [(j, me, 1) for j in range(me) if not same(j)]


PAYLOAD = T.StructType([T.StructField("key", T.LongType()), T.StructField("sub", T.LongType()), T.StructField("side", T.IntegerType()),
                        T.StructField("rid", T.LongType()), T.StructField("body", T.BinaryType())])
HEAD = np.dtype([("node", "<i8"), ("home", "<i4"), ("least", "<f4"), ("codes", "<i4"), ("visits", "<i4")])


def _deal(index_rows: DataFrame, layout: dict, blocks: Blocks, pivots: dict, threshold: float) -> DataFrame:
    """One row for each comparison of blocks that a row of the index takes part in; side 0 is stored, 1 asks."""
    box = index_rows.sparkSession.sparkContext.broadcast((blocks, pivots))

    def deal(batches):
        blocks, pivots = box.value
        for batch in batches:
            row, lists, asking, group = _entries(batch, pivots, threshold)
            rid, home, least = (batch.column(c).to_numpy() for c in ("rid", "home", "least"))
            vec, codes, visits = (batch.column(c).to_pylist() for c in ("vec", "codes", "visits"))
            out = [[], [], [], [], []]
            for r, c, a in zip(row.tolist(), lists.tolist(), asking.tolist()):
                g = int(group[r])
                salt = int(rid[r]) * 0x9E3779B97F4A7C15 >> 20
                for i, j, side in blocks.keys(c, a, g, salt & 0x7FFFFFFF):
                    head = np.zeros(1, HEAD)
                    head["node"], head["home"] = rid[r] if g < 0 else g, home[r]
                    rest = vec[r]
                    if not side:
                        head["least"], head["codes"], head["visits"] = least[r], len(codes[r]), len(visits[r])
                        rest = codes[r] + visits[r] + rest
                    for to, x in zip(out, (c, i << 32 | j, side, int(rid[r]), head.tobytes() + rest)):
                        to.append(x)
                if len(out[0]) >= 4096:
                    yield _dealt(out)
                    out = [[], [], [], [], []]
            yield _dealt(out)

    return index_rows.mapInArrow(deal, PAYLOAD)


def _dealt(out: list[list]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, types)], PAYLOAD.names)


class Comparison:
    """One pair of blocks: the stored rows are held, the asking rows pass by."""

    def __init__(self, index: Index | None, c: int, own: bool, threshold: float):
        self.index, self.c, self.own, self.threshold = index, c, own, threshold
        self.rid: list[int] = []
        self.bodies: list[bytes] = []
        self.seen: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.ready = False

    def hold(self, rid, bodies) -> None:
        self.rid += rid
        self.bodies += bodies

    def start(self) -> None:
        """Unpack the stored rows; if they are also those that ask, compare them with each other."""
        self.ready = True
        n = len(self.bodies)
        head = np.frombuffer(b"".join(b[:HEAD.itemsize] for b in self.bodies), HEAD)
        at = HEAD.itemsize
        self.node, self.least = head["node"], head["least"].astype(np.float64)
        self.codes = np.frombuffer(b"".join(b[at:at + k] for b, k in zip(self.bodies, head["codes"])), np.uint8).reshape(n, -1).T.copy()
        self.visits = np.full((n, VISITS), np.iinfo(np.int32).min, np.int32)
        for i, (b, k, v) in enumerate(zip(self.bodies, head["codes"], head["visits"])):
            self.visits[i, :v // 4] = np.frombuffer(b[at + k:at + k + v], "<i4")
        self.x = _vectors([b[at + k + v:] for b, k, v in zip(self.bodies, head["codes"], head["visits"])])
        self.bodies = []
        self.length = np.sqrt((self.x * self.x).sum(axis=1))
        self.count = np.zeros(n, np.int64)
        self.label = np.arange(n)
        if self.own:
            for a in range(0, n, AT_ONCE):
                z = min(a + AT_ONCE, n)
                self._compare(self.x[a:z], self.length[a:z], None, a)

    def ask(self, rid: np.ndarray, bodies: list[bytes]) -> None:
        if not self.rid:
            return
        head = np.frombuffer(b"".join(b[:HEAD.itemsize] for b in bodies), HEAD)
        x = _vectors([b[HEAD.itemsize:] for b in bodies])
        length = np.sqrt((x * x).sum(axis=1))
        for a in range(0, len(x), AT_ONCE):
            z = a + AT_ONCE
            count, first = self._compare(x[a:z], length[a:z], head["home"][a:z], None)
            hit = np.flatnonzero(count)
            if len(hit):
                self.seen.append((rid[a:z][hit], head["node"][a:z][hit], np.stack([count[hit], first[hit]])))

    def _candidates(self, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Look-ups of every stored code in the tables of each asking row, kept where the true score may reach the threshold."""
        if self.codes.size == 0:
            return np.nonzero(np.ones((len(u), len(self.x)), bool))
        score = np.repeat((u @ self.index.centres[self.c]).astype(np.float32)[:, None], len(self.x), axis=1)
        for p, words, codes in zip(self.index.parts, self.index.words, self.codes):
            score += np.take((u[:, p] @ words.T).astype(np.float32), codes, axis=1)
        return np.nonzero(score >= self.least.astype(np.float32))

    def _compare(self, x, length, home, offset):
        u = x / length[:, None]
        a, b = self._candidates(u)
        if offset is not None:
            ahead = b > a + offset
            a, b = a[ahead], b[ahead]
        linked = [np.zeros(0, bool)]
        for i in range(0, len(a), 1 << 16):
            p, q = a[i:i + (1 << 16)], b[i:i + (1 << 16)]
            linked.append(np.einsum("ij,ij->i", x[p], self.x[q]) / (length[p] * self.length[q]) >= self.threshold)
        linked = np.concatenate(linked)
        a, b = a[linked], b[linked]
        if home is not None:
            # A pair that both lists find counts in the list of smaller number.
            twice = (self.visits[b] == home[a][:, None]).any(axis=1) & (home[a] < self.c)
            a, b = a[~twice], b[~twice]
        count = np.bincount(a, minlength=len(x))
        self.count += np.bincount(b, minlength=len(self.x))
        if offset is not None:
            self.count[offset:offset + len(x)] += count
        first = np.full(len(x), len(self.x))
        np.minimum.at(first, a, b)
        self._join(first[a] if offset is None else a + offset, b)
        return count, first

    def _join(self, a: np.ndarray, b: np.ndarray) -> None:
        """Give the stored rows a and b of each pair one label."""
        while True:
            la, lb = self.label[a], self.label[b]
            apart = la != lb
            if not apart.any():
                return
            a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
            # The larger label takes the least it is paired with; chains are followed to their end.
            to = np.arange(len(self.label))
            np.minimum.at(to, np.maximum(la, lb), np.minimum(la, lb))
            while (to[to] != to).any():
                to = to[to]
            self.label = to[self.label]

    def finish(self):
        """(row id, links) and (node, node of its set)."""
        if not self.rid:
            return
        rid = np.array(self.rid, np.int64)
        hit = np.flatnonzero(self.count)
        yield np.zeros(len(hit), np.int32), rid[hit], self.count[hit]
        root = self.node[self.label]
        far = np.flatnonzero(root != self.node)
        yield np.ones(len(far), np.int32), self.node[far], root[far]
        for r, node, (count, first) in self.seen:
            yield np.zeros(len(r), np.int32), r, count
            yield np.ones(len(r), np.int32), node, root[first]


def _compare(dealt: DataFrame, index: Index | None, threshold: float, partitions: int) -> DataFrame:
    """kind 0: (row id, links found here); kind 1: an edge between nodes."""
    box = dealt.sparkSession.sparkContext.broadcast(index)

    def compare(batches):
        now, work = None, None
        for batch in batches:
            key, sub, side, rid = (batch.column(c).to_numpy() for c in ("key", "sub", "side", "rid"))
            bodies = batch.column("body")
            cuts = np.flatnonzero((np.diff(key) != 0) | (np.diff(sub) != 0) | (np.diff(side) != 0)) + 1
            for a, z in zip([0, *cuts], [*cuts, len(key)]):
                if a == z:
                    continue
                if (key[a], sub[a]) != now:
                    if work:
                        yield from _finished(work)
                    now = (key[a], sub[a])
                    work = Comparison(box.value, int(key[a]), int(sub[a]) >> 32 == int(sub[a]) & 0xFFFFFFFF, threshold)
                if side[a] == 0:
                    work.hold(rid[a:z].tolist(), bodies[a:z].to_pylist())
                else:
                    if not work.ready and work.rid:
                        work.start()
                    work.ask(rid[a:z], bodies[a:z].to_pylist())
        if work:
            yield from _finished(work)

    return dealt.repartition(partitions, "key", "sub").sortWithinPartitions("key", "sub", "side").mapInArrow(
        compare, "kind int, a long, b long")


def _finished(work: Comparison):
    if not work.ready and work.rid:
        work.start()
    for kind, a, b in work.finish():
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (kind, a, b)], ["kind", "a", "b"])


def _sample(rows: DataFrame, most: int) -> tuple[np.ndarray | None, int]:
    """(unit vectors of the commonest length from a bounded sample, all rows of that length)."""
    widths = rows.groupBy(F.size("embedding").alias("width")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "width").first()
    if widths is None:
        return None, 0
    width, n = widths["width"], widths["n"]
    share = int(min(1, most / n) * (1 << 30))
    some = rows.where((F.size("embedding") == width) & (F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(1 << 30)) < share))
    values = some.select("embedding").limit(2 * most).toArrow()["embedding"].combine_chunks()
    if isinstance(values, pa.ChunkedArray):
        values = pa.concat_arrays(values.chunks) if values.num_chunks else pa.array([], pa.list_(pa.float64()))
    if not len(values):
        values = rows.where(F.size("embedding") == width).select("embedding").limit(most).toArrow()["embedding"].combine_chunks()
        values = pa.concat_arrays(values.chunks) if isinstance(values, pa.ChunkedArray) else values
    x, length = _unit_rows(values, width)
    return x / length[:, None], n


def link_vectors(
    vectors: DataFrame, threshold: float = THRESHOLD, list_rows: int = LIST_ROWS, block: int = BLOCK, asking_block: int = ASKING_BLOCK,
    sample: int = SAMPLE,
) -> DataFrame:
    """vec_id, n_links, component_id and kept for each row of ``vectors`` (vec_id, embedding; other columns are not read).

    Links join rows whose cosine in doubles is at least ``threshold``; those of another list that no probe reaches may be missed (recall
    is measured in the tests), none below is made. A null vector, a null, NaN or infinite component, and a zero or empty vector
    link with nothing. Vectors of different lengths never link. Repeated rows and ids are vectors like others,
    so each counts the other. component_id is the least vec_id reachable, null if all of these are null; kept is false for a null id.
    An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "vectors")
    named = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    valid = named.where(_valid())
    sampled, n = _sample(valid, sample)
    index = None if sampled is None else fit(sampled, n, threshold, list_rows)
    stored = scratch.keep(_store(valid.withColumn("rid", F.monotonically_increasing_id()), index), "index")
    layout = _layout(stored, {}, threshold)
    pivots = _pivots(stored, {c: n for (c, asking, _), n in layout.items() if not asking}, threshold, block)
    if pivots:
        layout = _layout(stored, pivots, threshold)
    blocks = Blocks(layout, block, asking_block)
    dealt = _deal(stored, layout, blocks, pivots, threshold)
    found = scratch.keep(_compare(dealt, index, threshold, partitions_for(spark, sum(layout.values()), 20_000)), "found")
    roots = connected(found.where("kind = 1").select(F.col("a").alias("u"), F.col("b").alias("v")), scratch)
    roots = scratch.keep(roots, "roots")

    rows = stored.select("rid", "vec_id", F.col("rid").alias("node"), F.lit(0).cast("long").alias("tied"))
    if pivots:
        # Group of each row of a large list, and the links its group gives it.
        box = spark.sparkContext.broadcast(pivots)
        size = {g: n for (_, asking, g), n in layout.items() if g >= 0 and not asking}

        def grouped(batches):
            for batch in batches:
                g = _groups(batch.column("home").to_numpy(), batch.column("vec").to_pylist(), box.value, threshold)
                tied = np.array([size.get(x, 1) - 1 for x in g.tolist()], np.int64)
                rid = batch.column("rid").to_numpy()
                yield pa.RecordBatch.from_arrays([batch.column("rid"), batch.column("vec_id"), pa.array(np.where(g < 0, rid, g)), pa.array(tied)],
                                                 ["rid", "vec_id", "node", "tied"])

        hot = F.col("home").isin(*pivots)
        rows = rows.where(~hot).union(stored.where(hot).select("rid", "vec_id", "home", "vec").mapInArrow(
            grouped, "rid long, vec_id long, node long, tied long"))
        rows = scratch.keep(rows, "rows")
    # The least id of each node, then of each component; the rows of a pivot's group share one node.
    single, many = F.expr("node = rid and tied = 0"), F.expr("node != rid or tied > 0")
    least = rows.where(single).select("node", F.col("vec_id").alias("least"))
    if pivots:
        least = least.union(rows.where(many).groupBy("node").agg(F.min("vec_id").alias("least")))
    linked = scratch.keep(least.join(roots, "node"), "linked")
    component = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    of_node = linked.join(small_side(component, component.count()), "root").select("node", "component_id", F.lit(True).alias("reached"))
    counts = found.where("kind = 0").groupBy(F.col("a").alias("rid")).agg(F.sum("b").alias("n"))
    rows = rows.join(counts, "rid", "left")
    out = rows.where(single).join(of_node, "node", "left")
    if pivots:
        groups = least.join(of_node, "node", "left").where(F.col("node").isin(*[int(g) for r, _ in pivots.values() for g in r])).select(
            "node", F.when(F.col("reached"), F.col("component_id")).otherwise(F.col("least")).alias("component_id"), F.lit(True).alias("reached"))
        n_groups = sum(len(r) for r, _ in pivots.values())
        out = out.unionByName(rows.where(many).join(small_side(groups, n_groups), "node", "left"))
    out = out.select("vec_id", (F.coalesce("n", F.lit(0)) + F.col("tied")).cast("long").alias("n_links"),
                     F.when(F.col("reached"), F.col("component_id")).otherwise(F.col("vec_id")).alias("component_id"))
    rest = named.where(~_valid()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.union(rest).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
