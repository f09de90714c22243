"""Vector operators and the fill-in-middle transformation against plain versions."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.test_operators import EDGE
from tripweave.llm import fill_in_middle, hard_negatives, queries, vector_dedup

SMALL = "/root/testdata/sf0.001"


def unit(x):
    return x / np.linalg.norm(x, axis=-1, keepdims=True)


def planted(rng, rows, pairs, cosine, width=64):
    """Random directions, some with a partner at exactly about this cosine."""
    x = unit(rng.normal(size=(rows, width)))
    z = rng.normal(size=(pairs, width))
    z = unit(z - (z * x[:pairs]).sum(axis=1, keepdims=True) * x[:pairs])
    return np.concatenate([x, cosine * x[:pairs] + np.sqrt(1 - cosine ** 2) * z]).astype(np.float32)


def sound(v):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)


def want_links(rows, threshold=0.9):
    """[(vec_id, n_links, component_id, kept)] by comparing all."""
    vecs = [np.array(v, float) if sound(v) else None for _, v in rows]
    links = defaultdict(set)
    for width in {len(v) for v in vecs if v is not None}:
        at = [i for i, v in enumerate(vecs) if v is not None and len(v) == width]
        x = np.stack([vecs[i] for i in at])
        x = x / np.abs(x).max(axis=1, keepdims=True)
        n = np.sqrt((x * x).sum(axis=1))
        near = (x @ x.T) / n[:, None] / n >= threshold
        for i, row in zip(at, near):
            links[i] = {at[j] for j in np.flatnonzero(row)} - {i}
    root = list(range(len(rows)))
    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i
    for i, others in links.items():
        for j in others:
            root[find(i)] = find(j)
    ids = defaultdict(list)
    for i, (vec_id, _) in enumerate(rows):
        ids[find(i)] += [] if vec_id is None else [vec_id]
    out = []
    for i, (vec_id, _) in enumerate(rows):
        least = min(ids[find(i)], default=None)
        out.append((vec_id, len(links[i]), least, vec_id is not None and vec_id == least))
    return out


def got(frame):
    return [tuple(r) for r in frame.select("vec_id", "n_links", "component_id", "kept").collect()]


def frame_of(spark, rows, ddl="vec_id long, embedding array<float>"):
    return spark.createDataFrame(rows, ddl)


@pytest.mark.parametrize("cosine", [0.901, 0.93, 0.97])
def test_links_are_found(spark, cosine):
    """Recall over many lists; nothing below the threshold is linked."""
    rows = [(i, v.tolist()) for i, v in enumerate(planted(np.random.default_rng(3), 3000, 1000, cosine))]
    found = {r[0]: r for r in got(vector_dedup.link_vectors(frame_of(spark, rows), list_rows=128))}
    want = want_links(rows)
    assert all(found[w[0]][1] <= w[1] for w in want)
    assert sum(found[w[0]][1] for w in want) >= 0.97 * sum(w[1] for w in want)


def clusters(rng):
    """Tight and loose groups, exact copies, chains, beside random rows."""
    base = unit(rng.normal(size=(6, 64)))
    near = lambda c, n, s: unit(c + s * rng.normal(size=(n, 64)) / 8)
    chain = [unit(base[5] + k * 0.3 * unit(rng.normal(size=64))) for k in range(6)]
    x = np.concatenate([near(base[0], 700, 0.1), near(base[1], 300, 0.32), near(base[2], 5, 0.4), np.repeat(base[3:4], 250, 0),
                        near(base[4], 200, 0.2), np.stack(chain), unit(rng.normal(size=(800, 64)))]).astype(np.float32)
    return [(int(i), v.tolist()) for i, v in zip(rng.permutation(len(x)), x)]


@pytest.mark.parametrize("sizes", [dict(), dict(list_rows=200, block=100, asking_block=150), dict(list_rows=5000, block=64, asking_block=64)])
def test_groups_and_blocks(spark, sizes):
    """Hot lists in blocks, with pivots, give what comparing all gives."""
    rows = clusters(np.random.default_rng(5))
    found = Counter(got(vector_dedup.link_vectors(frame_of(spark, rows), **sizes)))
    want = Counter(want_links(rows))
    if "list_rows" not in sizes or sizes["list_rows"] > len(rows):
        assert found == want
    else:
        assert sum((found & want).values()) >= 0.99 * len(rows)


ODD = [
    (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [1.0, float("nan")]), (6, [float("inf"), 1.0]), (7, [1.0, 2.0]), (7, [1.0, 2.0]),
    (8, [2.0, 4.0]), (9, [-1.0, -2.0]), (None, [1.0, 2.1]), (None, [5.0, -1.0]), (10, [1.0]), (11, [3.0]), (12, [-3.0]), (13, [1e-30, 2e-30]),
    (14, [1e30, 2e30]), (7, [-3.0, 1.0]), (15, [1.0, 0.0, 0.0]), (16, [5.0, -1.1]), (17, [0.0, -0.0]),
]


@pytest.mark.parametrize("kind", ["float", "double"])
def test_odd_vectors(spark, kind):
    frame = frame_of(spark, ODD, f"vec_id long, embedding array<{kind}>")
    clash = frame.select("*", *[F.lit(1).alias(c) for c in ("rid", "home", "node", "n_links", "label", "component_id", "kept", "a.b")])
    for sizes in (dict(), dict(block=1, asking_block=1)):
        assert Counter(got(vector_dedup.link_vectors(clash, **sizes))) == Counter(want_links(ODD))
    assert got(vector_dedup.link_vectors(frame.limit(0))) == []
    assert Counter(got(vector_dedup.link_vectors(frame.where("vec_id < 4")))) == Counter(want_links(ODD[:3]))


def test_score_estimates_lose_nothing():
    """The floor of each code lies below the estimate of every row that links."""
    rng = np.random.default_rng(8)
    x = planted(rng, 2000, 500, 0.905).astype(float)
    x = unit(x)
    index = vector_dedup.fit(x, 2500, list_rows=100)
    home = (x @ index.centres.T).argmax(axis=1)
    rest = x - index.centres[home]
    made = index.centres[home] + np.concatenate([w[vector_dedup._nearest(rest[:, p], w)] for p, w in zip(index.parts, index.words)], axis=1)
    off = np.sqrt(((x - made) ** 2).sum(axis=1))
    least = np.maximum(0.9 - off, (1 + (made ** 2).sum(axis=1) - (np.sqrt(0.2) + off) ** 2) / 2)
    near = x @ x.T >= 0.9
    assert ((x @ made.T >= least - 1e-9) | ~near).all() and ((x @ made.T >= least) & ~near).mean() < 0.2


def want_negatives(rows, is_anchor=lambda i: i % 50 == 0):
    part = {(i, tuple(v), label) for i, v, label in rows if i is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v)}
    whole = [(i, [max(-(1 << 200), min(1 << 200, int(np.floor(np.float64(x) * 256)))) if abs(x) < 1e300 else int(np.sign(x)) * (1 << 200) for x in v], label)
             for i, v, label in part]
    out = set()
    for a, va, la in whole:
        if not is_anchor(a):
            continue
        scored = {(-max(-(1 << 63), min((1 << 63) - 1, sum(p * q for p, q in zip(va, vb)))), b, lb == la)
                  for b, vb, lb in whole if b != a and len(vb) == len(va)}
        for s, b, _ in sorted(x for x in scored if x[2])[:5]:
            fits = sorted(x for x in scored if not x[2] and 50 * -s <= 100 * -x[0] <= 95 * -s)[:3]
            out |= {(a, b, k, n, -s, -t) for k, (t, n, _) in enumerate(fits, 1)}
    return out


def mined(frame, **options):
    return Counter(tuple(r) for r in hard_negatives.mine_hard_negatives(frame, **options).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


DDL = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("options", [dict(), dict(anchors_a_pass=3)])
def test_hard_negatives_equal_to_plain(spark, options):
    rng = np.random.default_rng(4)
    base = unit(rng.normal(size=(8, 16)))
    x = np.concatenate([unit(base[rng.integers(0, 8, 900)] + 0.4 * rng.normal(size=(900, 16)) / 4), np.repeat(base[:2], 60, 0)]).astype(np.float32)
    rows = [(int(i), v.tolist(), int(c)) for i, v, c in zip(rng.permutation(len(x)), x, rng.integers(0, 4, len(x)))]
    assert mined(frame_of(spark, rows, DDL), **options) == Counter(want_negatives(rows))


def test_hard_negatives_of_odd_rows(spark):
    rows = [(0, [1.0, 0.5], 1), (50, [1.0, 0.4], 1), (50, [1.0, 0.4], 1), (50, [0.2, 0.9], 2), (1, None, 1), (2, [1.0, None], 1), (3, [1.0, float("inf")], 1),
            (4, [0.5, 0.5], None), (None, [1.0, 1.0], 1), (5, [0.6, 0.5], 2), (5, [0.6, 0.5], 2), (6, [0.6, 0.5], 2), (7, [0.6, 0.4], 3), (8, [0.5, 0.5], 1),
            (9, [0.9, 0.5], 1), (10, [0.0, 0.0], 1), (100, [0.0, 0.0], 1), (11, [0.0, 0.0], 2), (12, [-1.0, -1.0], 2), (150, [-0.3, 0.1], 7), (13, [-0.2, 0.1], 7),
            (14, [1.0], 1), (200, [1.0], 1), (15, [0.8], 2), (16, [], 1), (250, [3e38, -3e38, 1e-3], 1), (17, [3e38, -3e38, 1e-3], 1), (18, [1e38, 1.0, 2.0], 2),
            (300, [2e12, 1.0, 0.0], 4), (19, [2e3, 1.0, 0.0], 4), (20, [1.1e3, 1.0, 0.0], 5)]
    frame = frame_of(spark, rows, DDL)
    clash = frame.select("*", *[F.lit(1).alias(c) for c in ("score", "number", "k", "norm", "rank", "width", "a.b")])
    want = Counter(want_negatives(rows))
    assert want and mined(clash) == want
    assert mined(frame.limit(0)) == Counter() == mined(frame.where("label = 1"))
    wide = [(i, None if v is None else [None if x is None else x * 1e200 for x in v], c) for i, v, c in rows if i not in (250, 17, 18)]
    assert mined(frame_of(spark, wide, DDL.replace("float", "double"))) == Counter(want_negatives(wide))


def test_windows_spare_scoring_and_bound_all_scores():
    rng = np.random.default_rng(6)
    base = unit(rng.normal(size=(6, 32)))
    x = np.floor(256 * unit(np.repeat(base, 400, 0) + 0.05 * rng.normal(size=(2400, 32))))
    n = np.sqrt((x * x).sum(axis=1))
    label = np.repeat(np.arange(6), 400)
    anchors = np.arange(0, 2400, 100)
    make = lambda: hard_negatives.Pass(np.arange(24), anchors, label[anchors], x[anchors], base, np.full((24, 1), hard_negatives.LEAST),
                                       np.full((24, 1), hard_negatives.MOST), True, 5)
    angles = hard_negatives.angles_of(x, n, base)
    asked = make()
    for a in range(0, 2400, 200):
        low, high = hard_negatives.score_bounds(asked, n[a:a + 200], angles[a:a + 200])
        true = x[anchors] @ x[a:a + 200].T
        assert (true >= low[:, None]).all() and (true <= high[:, None]).all()
    best = hard_negatives.Best(asked)
    for _ in range(2):
        for a in range(0, 2400, 200):
            best.add(np.arange(a, a + 200), label[a:a + 200], x[a:a + 200], n[a:a + 200], angles[a:a + 200])
    assert best.scored < 0.7 * best.seen


def want_middle(doc_id, text):
    text = text or ""
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    assert "".join(units) == text
    n = len(units)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i:i + 8], 16) for i in range(0, 32, 8)]
    plain = not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(u) for u in (units[:a], units[a:b], units[b:]))
    form = "plain" if plain else "spm" if h[3] % 100 < 80 else "psm"
    out = {"plain": text, "psm": f"<P>{p}<S>{s}<M>{m}", "spm": f"<S>{s}<P>{p}<M>{m}"}[form]
    return doc_id, n, form, None if plain else len(p), None if plain else len(m), out, text


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


TEXTS = EDGE + [(20 + i, t) for i, t in enumerate(
    ["<P> here", "a <M>", "<<S", "a<", "<", " ", " lead", "trail \n", "é😀 ü x", "w" * 50_000 + " end", " " * 40_000, "x y " * 30_000 + "\t", "a b<P c >"])]


@pytest.mark.parametrize("size", [1, 7, fill_in_middle.FRAME])
def test_fill_in_middle_equal_to_plain(spark, size):
    rows = [(i * 31 + k, t) for k in range(3) for i, t in enumerate(t for _, t in TEXTS)] if size > 1 else [(i, t) for i, t in TEXTS if len(t or "") < 3000]
    rows += [(None, "no id at all"), (5, "twice"), (5, "twice")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select("*", *[F.lit(1).alias(c) for c in ("n", "form", "row", "frames", "units", "a.b")])
    stored = fill_in_middle.store_frames(docs, size)
    found = Counter(tuple(r) for r in fill_in_middle.digests(stored).drop("row").collect())
    want = [want_middle(*r) for r in rows]
    assert {"plain", "psm", "spm"} <= {w[2] for w in want}
    assert found == Counter((*w[:5], sha(w[5]), sha(w[6])) for w in want)
    made = Counter(tuple(r) for r in fill_in_middle.fill_in_middle(stored).drop("row").collect())
    assert made == Counter(w[:6] for w in want)
    assert fill_in_middle.digests(fill_in_middle.store_frames(docs.limit(0))).collect() == []


def test_cuts_read_one_frame_each():
    text = "one two  three\n" * 5000
    frames = fill_in_middle.pack(text, 1000)
    read = []
    frames.text, plain = lambda i: read.append(i) or plain(i), frames.text
    units = fill_in_middle.UNIT.findall(text)
    for k in (0, 1, 777, 14_999, len(units)):
        read.clear()
        assert frames.place(frames.cut(k)) == len("".join(units[:k])) and len(read) <= 1


def test_queries_read_whole_tables(spark):
    n = spark.read.parquet(f"{SMALL}/embeddings.parquet").count()
    assert queries.op11_embedding_dedup(spark, SMALL).count() == n
    assert queries.op13_fill_in_middle(spark, SMALL).count() == spark.read.parquet(f"{SMALL}/documents.parquet").count()
