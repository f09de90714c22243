"""Quality rules: text statistics and a learned decision list over them.

The list is learned by sequential covering: a rule grows one threshold at a time by FOIL's gain on the
growing rows, is cut back on the pruning rows, and what it covers leaves the set. Each step is one
aggregation of (feature, bin) counts, so learning needs the histogram only, never the rows. The result
is plain text and a chain of Spark conditions.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.functions.trip import computed_once
from tripweave.llm.common import Scratch, packed, text_of, unpacked

#: Fixed values of the base rule.
LEAST_WORDS, MOST_REPEATED_PERCENT = 50, 50
SYMBOL = r"[#*$%&|<>]"
WINDOW = 3

#: Labelled rows the list is learned from, at most: those with the smallest hash of their id.
LABELLED_ROWS = 8192
THRESHOLDS = 40
FEATURES = ("log_words", "word_length", "symbol_rate", "repeat_rate", "dup_line_rate", "distinct_rate")


def _twins(pairs: str) -> Column:
    """The places ``i`` of sorted (g, i) whose ``g`` is also that of a neighbour."""
    size = F.size(pairs)
    rest = F.greatest(size - 1, F.lit(0))
    both = F.zip_with(F.slice(pairs, F.lit(1), rest), F.slice(pairs, F.lit(2), rest), lambda a, b: F.when(a["g"] == b["g"], F.array(a["i"], b["i"])))
    return F.when(size > 0, F.array_distinct(F.flatten(F.filter(both, lambda x: x.isNotNull()))))


def with_stats(rows: DataFrame, text: str = "text") -> DataFrame:
    """The statistics beside the given columns; ``text`` must be free of nulls and is dropped.

    Java's ``\\s`` is just the six characters of white space that separate words.

    Repeated three-word windows are found per row: window hashes are sorted with their position, equal neighbours taken, and
    the words of these compared in the same way. Rows without a repeated hash, the most, skip the sorts.
    """
    kept = [c for c in rows.columns if c != text]
    t = F.col(text)
    words = F.array_remove(F.split(t, r"\s+"), "")
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"\S"))
    step = rows.select(
        *kept, words.alias("_words"), lines.alias("_lines"),
        F.length(F.regexp_replace(t, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"))
    n = F.size("_words")
    hashes = F.when(n >= WINDOW, F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(
        F.element_at("_words", i), F.element_at("_words", i + 1), F.element_at("_words", i + 2)))).otherwise(
        F.expr("CAST(array() AS array<bigint>)"))
    step = step.select(
        *kept, F.length(F.array_join("_words", "")).cast("long").alias("word_chars"), "n_symbols", n.cast("long").alias("n_words"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size("_lines").cast("long").alias("n_lines"), F.size(F.array_distinct("_words")).cast("long").alias("n_distinct"),
        hashes.alias("_hashes"), "_words")
    step = step.withColumn("_sorted", F.when(
        F.size(F.array_distinct("_hashes")) < F.size("_hashes"),
        F.sort_array(F.transform("_hashes", lambda h, i: F.struct(h.alias("g"), i.alias("i"))))))
    # Windows of equal hash are compared by their words; words hold no blank.
    window = lambda i: F.concat_ws(" ", *[F.element_at("_words", i + k) for k in range(1, WINDOW + 1)])
    step = step.withColumn("_sorted", F.sort_array(F.transform(_twins("_sorted"), lambda i: F.struct(window(i).alias("g"), i.alias("i")))))
    step = step.withColumn("_starts", F.sort_array(_twins("_sorted")))
    rest = F.greatest(F.size("_starts") - 1, F.lit(0))
    covered = F.when(F.size("_starts") > 0, WINDOW + F.aggregate(
        F.zip_with(F.slice("_starts", F.lit(1), rest), F.slice("_starts", F.lit(2), rest),
                   lambda a, b: F.least(F.lit(WINDOW), b - a)), F.lit(0), lambda acc, x: acc + x))
    return step.select(
        *kept, "n_words", "word_chars", "n_symbols", "n_dup_lines",
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"), "n_lines", "n_distinct")


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))


def feature(name: str) -> Column:
    """A feature of the list, made of the statistics; no division by zero."""
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return {
        "log_words": F.log2(F.col("n_words") + 1.0),
        "word_length": F.col("word_chars") / words,
        "symbol_rate": F.col("n_symbols") / words,
        "repeat_rate": F.col("n_repeat_words") / words,
        "dup_line_rate": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)).cast("double"),
        "distinct_rate": F.col("n_distinct") / words,
    }[name]


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self) -> Column:
        value = feature(self.feature)
        return value >= F.lit(self.threshold) if self.above else value < F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<'} {self.threshold:g}"


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]

    def holds(self) -> Column:
        out = F.lit(True)
        for condition in self.conditions:
            out = out & condition.holds()
        return out

    def __str__(self) -> str:
        return " and ".join(map(str, self.conditions))


@dataclass
class DecisionList:
    """Rules in order; a text is rejected by the first that holds and kept if none does."""

    rules: list[Rule] = field(default_factory=list)

    def verdict(self) -> Column:
        """The number of the rule that rejects, from 1; 0 if none."""
        out = F.lit(0)
        for i, rule in reversed(list(enumerate(self.rules, 1))):
            out = F.when(rule.holds(), i).otherwise(out)
        return out

    def __str__(self) -> str:
        return "\n".join([f"reject if {r}" for r in self.rules] + ["else keep"])


def labelled(docs: DataFrame, labels: DataFrame, most: int = LABELLED_ROWS) -> DataFrame:
    """Statistics of at most ``most`` labelled documents: a bounded sample by hash of the id.

    An id labelled twice counts as bad if one of its labels is. Null ids and null labels are left out.
    """
    chosen = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy("doc_id").agg(F.min(F.col("quality").cast("int")).alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        .select(F.col("doc_id"), (F.col("quality") == 0).cast("int").alias("bad"))
    )
    # At most ``most`` rows of two numbers: bounded by the limit above.
    rows = docs.select("doc_id", text_of().alias("text")).join(F.broadcast(chosen), "doc_id")
    return with_stats(rows)


def learn(docs: DataFrame, labels: DataFrame, most_rules: int = 8, most_conditions: int = 3, least_cover: int = 5,
          least_precision: float = 0.99, rows: int = LABELLED_ROWS) -> DecisionList:
    """Grow and prune rules for bad texts. No labels give an empty list, which keeps everything."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "quality")
    stats = labelled(docs, labels, rows).select(
        *[feature(f).alias(f) for f in FEATURES], "bad", (F.pmod(F.xxhash64(F.lit("part"), "doc_id"), F.lit(3)) < 2).alias("grow"))
    # At most ``rows`` small rows; dealing them out anew leaves the scan and the join their own tasks.
    stats = scratch.keep(stats.repartition(8), "labelled")
    cuts = stats.agg(*[F.expr(f"percentile({f}, array({', '.join(str(i / THRESHOLDS) for i in range(1, THRESHOLDS))}))").alias(f)
                       for f in FEATURES]).first()
    if cuts[0] is None:
        scratch.release()
        return DecisionList()
    cuts = {f: sorted(set(cuts[f])) for f in FEATURES}

    def bin_of(f: str) -> Column:
        return F.size(F.filter(F.array(*[F.lit(c) for c in cuts[f]]), lambda c: c <= F.col(f)))

    binned = scratch.keep(stats.select("bad", "grow", *[bin_of(f).alias(f) for f in FEATURES]), "binned")

    def holds(conditions) -> Column:
        out = F.lit(True)
        for f, above, k in conditions:
            out = out & (F.col(f) > k if above else F.col(f) <= k)
        return out

    rules: list[tuple] = []
    left = F.lit(True)
    while len(rules) < most_rules:
        grown: list[tuple[str, bool, int]] = []
        while len(grown) < most_conditions:
            pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).alias("b")) for f in FEATURES]))
            hist = (binned.where(F.col("grow") & left & holds(grown)).select(pairs.alias("p"), "bad")
                    .groupBy("p.f", "p.b").agg(F.sum("bad").alias("bad"), F.count("*").alias("n")).collect())
            total = [sum(r["bad"] for r in hist if r["f"] == FEATURES[0]), sum(r["n"] for r in hist if r["f"] == FEATURES[0])]
            if total[0] < least_cover or total[0] == total[1]:
                break
            prior, best = math.log2(total[0] / total[1]), (1e-9, None)
            for f in FEATURES:
                for k in range(len(cuts[f])):
                    low = [sum(r[x] for r in hist if r["f"] == f and r["b"] <= k) for x in ("bad", "n")]
                    for above, (bad, n) in ((True, (total[0] - low[0], total[1] - low[1])), (False, low)):
                        if bad >= least_cover and (gain := bad * (math.log2(bad / n) - prior)) > best[0]:
                            best = (gain, (f, above, k))
            if best[1] is None:
                break
            grown.append(best[1])
        if not grown:
            break
        # Prune: the shortest beginning of the rule that is best on the rows it has not seen.
        seen = binned.where(~F.col("grow") & left).select(
            *[F.when(holds(grown[:i]), F.col("bad")).alias(f"b{i}") for i in range(1, len(grown) + 1)]).agg(
            *[f(F.col(f"b{i}")).alias(f"{n}{i}") for i in range(1, len(grown) + 1) for n, f in (("s", F.sum), ("n", F.count))]).first()
        worth = [((2 * (seen[f"s{i}"] or 0) - seen[f"n{i}"]) / max(1, seen[f"n{i}"]), seen[f"s{i}"] or 0, seen[f"n{i}"]) for i in range(1, len(grown) + 1)]
        best = max(range(len(grown)), key=lambda i: (round(worth[i][0], 6), -i))
        rule, (_, bad, n) = grown[:best + 1], worth[best]
        if n == 0 or bad < least_precision * n:
            break
        rules.append(tuple(rule))
        left = left & ~holds(rule)
    scratch.release()
    # A bin above k begins at the k-th threshold.
    return DecisionList([Rule(tuple(Condition(f, above, float(cuts[f][k])) for f, above, k in r)) for r in rules])


def apply_rules(docs: DataFrame, rules: DecisionList) -> DataFrame:
    """One row per input row: doc_id, the statistics, the base rule, the rejecting rule and ``kept``.

    A null text has no words and fails the base rule. Repeated rows are judged alike; an empty table
    gives an empty result.
    """
    rows = with_stats(docs.select("doc_id", text_of().alias("text")))
    return computed_once(
        rows, *[F.col(c) for c in ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        base_failed().alias("base_failed"), rules.verdict().alias("rule")).withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))


def keep_good(docs: DataFrame, rules: DecisionList) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their columns as they are."""
    rows = with_stats(packed(docs, text=text_of()))
    # A plain filter would be moved below the statistics and take a copy of each with it.
    return unpacked(computed_once(rows, F.col("row"), (~base_failed() & (rules.verdict() == 0)).alias("good")).where("good"))
