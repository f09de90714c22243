"""Random tokens: whole spans against a plain form of the battery's outcome, many hits, and how many planted tokens are found."""

import random
import string
import time

import numpy as np

from tests.llm import brute
from tripweave.llm import quality_rules, secret_scan


def spans(frame):
    return {r["doc_id"]: [tuple(x.split(":")) for x in r["spans"].split(",") if x] for r in frame.collect()}


def test_many_hits_take_time_in_proportion(spark):
    rng = random.Random(1)
    text = " ".join(f"{rng.getrandbits(128):032x}" for _ in range(20_000))
    began = time.time()
    found = secret_scan.scan_secrets(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (found["n_hex"], found["n_random"]) == (20_000, 0) and found["base_sha256"] == brute.secrets(text)[0][3]
    assert time.time() - began < 60


def test_hits_across_groups_have_their_places(spark):
    rng = random.Random(2)
    for n in (1, 255, 256, 257, 513):
        text = "é".join(f" {rng.getrandbits(100):025x}{'😀' * (i % 3)} token = {'abcdef' * (1 + i % 2)} " for i in range(n))
        found = secret_scan.scan_secrets(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
        want = brute.secrets(text)
        assert (found["n_assign"], found["n_access"], found["n_hex"], found["base_sha256"]) == want[0]


def test_random_spans_inside_fixed_ones_are_said_once(spark):
    """Tokens against a plain reading of the rule: a reported run of token characters that no fixed span holds."""
    rng = random.Random(3)
    token = lambda n=44: "".join(rng.choice(string.ascii_letters + string.digits) for _ in range(n))
    texts = []
    for i in range(300):
        t = [token() for _ in range(4)]
        texts.append(f"see {t[0]} password={t[1]} and secret: '{t[2]}.{t[3]}' api_key = {token()}%{token()} AKIA{'ABCD2345' * 3} x{token()}token=abcdef {i:030x}")
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for doc_id, got in spans(secret_scan.scan_secrets(frame)).items():
        fixed = [(int(s), int(e)) for k, s, e in got if k != "random"]
        loose = {(int(s), int(e)) for k, s, e in got if k == "random"}
        runs = {(m.start(), m.end()) for m in brute.re.finditer(secret_scan.CANDIDATE, texts[doc_id])}
        assert loose <= {r for r in runs if not any(s <= r[0] and r[1] <= e for s, e in fixed)}
        assert (4, 48) in loose


def test_planted_tokens_are_found_and_words_left_alone(spark):
    """Precision and recall over planted tokens of four alphabets among ordinary long words."""
    rng = np.random.default_rng(4)
    syllables = ["un", "re", "con", "trans", "form", "ation", "ment", "ology", "inter", "nation", "al", "ise", "ing", "ly", "ness"]
    alphabets = [string.ascii_letters + string.digits + "+/", string.ascii_letters + string.digits + "-_", string.ascii_uppercase + "234567",
                 string.digits + string.ascii_lowercase]
    data, planted = [], set()
    for i in range(2000):
        words = ["".join(rng.choice(syllables, rng.integers(5, 10))) for _ in range(10)]
        if i % 10 == 0:
            alphabet = alphabets[i // 10 % 4]
            token = "".join(rng.choice(list(alphabet), int(rng.integers(32, 65))))
            at = len(" ".join(words[:5])) + 1
            words.insert(5, token)
            planted.add((i, at, at + len(token)))
        data.append((i, " ".join(words)))
    found = {(d, int(s), int(e)) for d, xs in spans(secret_scan.scan_secrets(spark.createDataFrame(data, "doc_id long, text string"))).items() for k, s, e in xs if k == "random"}
    recall, precision = len(found & planted) / len(planted), len(found & planted) / len(found)
    # Measured: every token, with 45 of about 18,000 compounds of syllables beside the 200 tokens.
    assert recall >= 0.99 and precision >= 0.8, (recall, precision)


def test_kept_by_a_fixed_list(spark, sf_dir):
    """The verdict of a given list, recomputed from the plain statistics."""
    import math

    rules = quality_rules.DecisionList([
        quality_rules.Rule((quality_rules.Condition("word_length", True, 7.0), quality_rules.Condition("log_words", False, 9.0))),
        quality_rules.Rule((quality_rules.Condition("symbol_rate", True, 0.02),)),
        quality_rules.Rule((quality_rules.Condition("repeat_rate", True, 0.3), quality_rules.Condition("dup_line_rate", True, 0.1)))])
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    got = {r["doc_id"]: (r["kept"], r["rule"]) for r in quality_rules.apply_rules(docs, rules).collect()}
    for doc_id, text in texts.items():
        n, chars, symbols, dups, repeat, failed = brute.quality(text)
        lines = sum(bool(brute.WORD.search(x)) for x in text.split("\n"))
        w = max(n, 1)
        rule = (1 if chars / w >= 7.0 and math.log2(n + 1) < 9.0 else 2 if symbols / w >= 0.02 else
                3 if repeat / w >= 0.3 and dups / max(lines, 1) >= 0.1 else 0)
        assert got[doc_id] == (not failed and rule == 0, rule)


def test_windows_of_equal_hash_are_told_apart(spark, monkeypatch):
    """With a hash that is the same for all windows the words alone decide."""
    monkeypatch.setattr(quality_rules.F, "xxhash64", lambda *a: quality_rules.F.lit(1).cast("long") + 0 * quality_rules.F.length(a[0]))
    texts = ["a b c d e a b c x y", "q w e r t y u i o p", "a a a a a", "one two three", "é b c é b c"]
    rows = quality_rules.with_stats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["n_repeat_words"] for r in rows} == {i: brute.quality(t)[4] for i, t in enumerate(texts)}
