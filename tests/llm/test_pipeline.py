"""Each stage of the pipeline against a plain version, on what the stage before it kept."""

from collections import Counter

import pytest

import corpus_pipeline
from tests.llm import brute
from tripweave.llm import quality_rules
from tripweave.llm.common import Scratch, table

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark):
    """What each stage kept, by place; the input first."""
    scratch = Scratch(spark, "test")
    out = [table(spark, SMALL, "documents")]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out.append(scratch.keep(stage(spark, out[-1], SMALL), f"s{i}"))
    return out


def texts(frame):
    return [(r["doc_id"], r["text"]) for r in frame.collect()]


def test_columns_and_order(kept):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "near duplicates", "decontamination", "source mixing"]
    assert all(f.columns == kept[0].columns for f in kept[1:-1])
    assert kept[-1].columns == [*kept[0].columns, "taken"]


def test_quality(spark, kept):
    rules = quality_rules.learn(kept[0], table(spark, SMALL, "labels"))
    want = {r["doc_id"] for r in quality_rules.apply_rules(kept[0], rules).collect() if r["kept"]}
    assert {d for d, _ in texts(kept[1])} == want
    assert not any(brute.quality(t)[-1] for _, t in texts(kept[1]))


def test_lines(kept):
    assert Counter((d, brute.sha(t)) for d, t in texts(kept[2])) == Counter((d, s) for d, _, _, s in brute.lines(texts(kept[1])))


def test_near_duplicates(kept):
    before = texts(kept[2])
    want = set(brute.components([(d, brute.simhash(t)) for d, t in before]))
    assert {d for d, _ in texts(kept[3])} == want


def test_decontamination(spark, kept):
    items = [(r["item_id"], r["text"]) for r in table(spark, SMALL, "benchmark").collect()]
    want = {r[0] for r in brute.contamination(texts(kept[3]), items) if not r[-1]}
    assert {d for d, _ in texts(kept[4])} == want


def test_mix(kept):
    sizes = {d: len(brute.WORD.findall(t)) for d, t in texts(kept[4])}
    taken = {r["doc_id"]: r["taken"] for r in kept[5].collect()}
    assert set(taken) <= set(sizes) and all(0 < n <= 2 * sizes[d] for d, n in taken.items())
    assert sum(taken.values()) == pytest.approx(1.5 * sum(sizes.values()), rel=0.03)
