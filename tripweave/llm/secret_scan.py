"""Secret scans: fixed patterns, and a randomness battery for tokens that no pattern names.

A token is tested against "drawn at random from its inferred alphabet" by three tests: chi-squared
uniformity of the alphabet, runs below and above the middle of the alphabet, and lag-one serial correlation. Fisher's
method joins the three p-values. Ordinary tokens fail the battery by far. Within each length class
a Benjamini-Hochberg step-up over all tokens of the corpus decides which p-values count as failures,
so the share of truly random tokens among the cleared ones is held at ``clear_rate`` at every length:
a long class with few tokens and a short class with many get their own cut. What is not cleared is reported.

Everything is an expression on the row: no shuffle but that of the p-value counts (length classes
times bins, a fixed number of rows).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.functions.trip import computed_once
from tripweave.llm.common import text_of

#: The pattern of each kind, in the order of the kinds.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "random")

#: Least value length of an assignment.
ASSIGN_VALUE = 6
#: Tokens that the battery tests.
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"

DIGITS = "0123456789"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: Inferred encodings, the narrowest first: name, pattern of the whole token, alphabet, least length.
#: The least length is where an ordinary word of that alphabet fails the battery.
ENCODINGS = (
    ("decimal", r"^[0-9]+$", DIGITS, 40),
    ("hex", r"^[0-9a-f]+$", DIGITS + "abcdef", 24),
    ("hex_upper", r"^[0-9A-F]+$", DIGITS + "ABCDEF", 24),
    ("base32", r"^(?=.*[2-7])[A-Z2-7]+=*$", UPPER + "234567", 24),
    ("base36", r"^(?=.*[0-9].*[0-9])(?=.*[a-z])[0-9a-z]+$", DIGITS + LOWER, 24),
    ("base64", r"^[A-Za-z0-9+/]+=*$", UPPER + LOWER + DIGITS + "+/", 20),
    ("base64url", r"^[A-Za-z0-9_-]+=*$", UPPER + LOWER + DIGITS + "-_", 20),
)
#: Upper ends of the length classes; the last is open.
LENGTH_CLASSES = (23, 31, 47, 63, 127)
#: p-value bins, twenty to a power of ten.
BINS = 800


def _may_assign(text: Column) -> Column:
    low = F.lower(text)
    return text.rlike(r"""[:=]\x20*["']?[A-Za-z0-9+/_.=-]{6}""") & (
        low.contains("passw") | low.contains("secret") | low.contains("token") | low.contains("api"))


def _may_run(text: Column) -> Column:
    """Whether any 20 characters stand together, as every other kind needs; tried at beginnings of words only."""
    return text.rlike(r"\s\S{20}") | text.rlike(r"^\S{20}")


#: Hits whose offsets are summed in one go; an array that grows by each hit of a text would be copied for each.
TOGETHER = 256
_SPANS = "array<struct<start:int,end:int,hit:string>>"


def _hits(text: Column, pattern: str, may: Column) -> Column:
    """Matches with their code point positions: the pieces between the matches give the offsets.

    ``may`` is a cheap necessary condition; most texts are done with it. Offsets are summed within groups of ``TOGETHER`` hits first and
    then over the groups.
    """
    gaps = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.zip_with(found, F.slice(gaps, F.lit(1), F.size(found)), lambda hit, gap: F.struct(F.length(gap).alias("gap"), hit.alias("hit")))
    start = F.struct(F.lit(0).alias("at"), F.expr(f"CAST(array() AS {_SPANS})").alias("out"))

    def step(acc, pair):
        first = acc["at"] + pair["gap"]
        last = first + F.length(pair["hit"])
        return F.struct(last.alias("at"), F.concat(acc["out"], F.array(F.struct(first.alias("start"), last.alias("end"), pair["hit"].alias("hit")))).alias("out"))

    def shift(acc, group):
        moved = F.transform(group["out"], lambda x: F.struct((x["start"] + acc["at"]).alias("start"), (x["end"] + acc["at"]).alias("end"), x["hit"].alias("hit")))
        return F.struct((acc["at"] + group["at"]).alias("at"), F.concat(acc["out"], F.array(moved)).alias("out"))

    whole = F.struct(F.lit(0).alias("at"), F.expr(f"CAST(array() AS array<{_SPANS}>)").alias("out"))

    def spans(all_pairs):
        begins = F.sequence(F.lit(1), F.greatest(F.size(all_pairs), F.lit(1)), F.lit(TOGETHER))
        summed = F.transform(begins, lambda i: F.aggregate(F.slice(all_pairs, i, F.lit(TOGETHER)), start, step))
        return F.flatten(F.aggregate(summed, whole, shift, lambda acc: acc["out"]))

    # A variable of a lambda is worked out once; written out, the matches would be looked for again for each group.
    folded = F.element_at(F.transform(F.array(pairs), spans), 1)
    return F.when(may & text.rlike(pattern), folded).otherwise(F.expr(f"CAST(array() AS {_SPANS})"))


def base_spans(text: Column) -> tuple[Column, Column, Column]:
    """The spans of the three fixed kinds: leftmost, non-overlapping, failing matches dropped."""
    assign = F.filter(_hits(text, ASSIGN, _may_assign(text)), lambda x: F.length(F.regexp_extract(x["hit"], ASSIGN, 1)) >= ASSIGN_VALUE)
    return assign, _hits(text, ACCESS, _may_run(text)), _hits(text, HEX, _may_run(text))


def _upper_tail(z: Column) -> Column:
    """The normal upper tail by a fixed rational approximation (error below 1e-7, at large z relative to it)."""
    a = F.abs(z)
    t = 1 / (1 + 0.2316419 * a)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = F.exp(-a * a / 2) / math.sqrt(2 * math.pi) * poly
    return F.when(z < 0, 1 - tail).otherwise(tail)


def _encoding(token: Column) -> Column:
    out = None
    for i, (_, pattern, _, _) in enumerate(ENCODINGS):
        out = F.when(token.rlike(pattern), i) if out is None else out.when(token.rlike(pattern), i)
    return out.otherwise(len(ENCODINGS))


def _by_encoding(index: Column, values: list) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), index + 1)


def _length_class(n: Column) -> Column:
    out = F.lit(len(LENGTH_CLASSES))
    for i, end in reversed(list(enumerate(LENGTH_CLASSES))):
        out = F.when(n <= end, i).otherwise(out)
    return out


def battery(tokens: Column) -> Column:
    """Tokens with their encoding, length class and the bin of their joined p-value.

    Each ``transform`` only reads fields of the one before, so no statistic is worked out twice.
    """
    mixed = (UPPER + LOWER + DIGITS + "+/_-=")
    alphabets = [a for _, _, a, _ in ENCODINGS] + [mixed]
    sizes = [float(len(a)) for a in alphabets]
    least = [n for _, _, _, n in ENCODINGS] + [32]

    coded = F.transform(tokens, lambda x: F.struct(
        x["start"].alias("start"), x["end"].alias("end"), x["hit"].alias("hit"), _encoding(x["hit"]).alias("enc")))
    coded = F.transform(coded, lambda x: F.struct(
        x["start"].alias("start"), x["end"].alias("end"), x["enc"].alias("enc"),
        F.when(x["enc"] < len(ENCODINGS), F.regexp_replace(x["hit"], "=+$", "")).otherwise(x["hit"]).alias("body"),
        _by_encoding(x["enc"], alphabets).alias("alphabet"), _by_encoding(x["enc"], sizes).alias("size")))
    coded = F.transform(coded, lambda x: F.struct(
        x["start"].alias("start"), x["end"].alias("end"), x["enc"].alias("enc"), x["size"].alias("size"),
        F.length(x["body"]).cast("double").alias("n"),
        F.transform(F.filter(F.split(x["body"], ""), lambda c: c != ""), lambda c: F.instr(x["alphabet"], c) - 1.0).alias("codes"),
        F.aggregate(F.filter(F.split(x["alphabet"], ""), lambda c: c != ""), F.lit(0.0), lambda acc, c: acc + F.pow(
            F.length(x["body"]) - F.length(F.replace(x["body"], c, F.lit(""))), F.lit(2.0))).alias("squares")))
    moments = F.transform(coded, lambda x: F.struct(
        x["start"].alias("start"), x["end"].alias("end"), x["enc"].alias("enc"), x["n"].alias("n"), x["size"].alias("size"),
        (x["squares"] * x["size"] / x["n"] - x["n"]).alias("chi"),
        F.aggregate(x["codes"], F.lit(0.0), lambda a, c: a + c).alias("sum"),
        F.aggregate(x["codes"], F.lit(0.0), lambda a, c: a + c * c).alias("sum2"),
        F.aggregate(F.zip_with(F.slice(x["codes"], F.lit(2), F.size(x["codes"])), x["codes"], lambda a, b: a * F.coalesce(b, F.lit(0.0))),
                    F.lit(0.0), lambda a, c: a + F.coalesce(c, F.lit(0.0))).alias("lag"),
        F.element_at(x["codes"], 1).alias("head"), F.element_at(x["codes"], -1).alias("foot"),
        F.aggregate(x["codes"], F.lit(0.0), lambda a, c: a + F.when(c * 2 >= x["size"], 1.0).otherwise(0.0)).alias("high"),
        F.aggregate(F.zip_with(F.slice(x["codes"], F.lit(2), F.size(x["codes"])), x["codes"], lambda a, b: F.when((a * 2 >= x["size"]) != (b * 2 >= x["size"]), 1.0).otherwise(0.0)),
                    F.lit(1.0), lambda a, c: a + c).alias("runs")))
    scores = F.transform(moments, lambda x: F.struct(
        x["start"].alias("start"), x["end"].alias("end"), x["enc"].alias("enc"), x["n"].alias("n"), x["runs"].alias("runs"),
        # Wilson and Hilferty: the cube root of chi-squared over its degrees of freedom is near normal.
        ((F.cbrt(x["chi"] / (x["size"] - 1)) - (1 - 2 / (9 * (x["size"] - 1)))) / F.sqrt(2 / (9 * (x["size"] - 1)))).alias("z_chi"),
        (2 * x["high"] * (x["n"] - x["high"]) / x["n"]).alias("mix"),
        (x["sum2"] - x["sum"] * x["sum"] / x["n"]).alias("spread"),
        # The sum of products of neighbours about the mean.
        (x["lag"] - (x["sum"] / x["n"]) * (2 * x["sum"] - x["head"] - x["foot"])
         + (x["n"] - 1) * F.pow(x["sum"] / x["n"], F.lit(2.0))).alias("neighbours")))
    tails = F.transform(scores, lambda x: F.struct(
        x["start"].alias("start"), x["end"].alias("end"), x["enc"].alias("enc"), x["n"].alias("n"), x["z_chi"].alias("z_chi"),
        F.when(x["mix"] * (x["mix"] - 1) <= 0, F.sqrt(x["n"])).otherwise(
            F.abs(x["runs"] - x["mix"] - 1) / F.sqrt(x["mix"] * (x["mix"] - 1) / (x["n"] - 1))).alias("z_runs"),
        F.when(x["spread"] <= 0, F.sqrt(x["n"])).otherwise(
            F.abs(x["neighbours"] / x["spread"] + 1 / x["n"]) * F.sqrt(x["n"])).alias("z_serial")))
    logs = F.transform(tails, lambda x: F.struct(
        x["start"].alias("start"), x["end"].alias("end"), x["enc"].alias("enc"), x["n"].alias("n"),
        (-F.ln(F.greatest(_upper_tail(x["z_chi"]), F.lit(1e-300)))
         - F.ln(F.least(F.lit(1.0), F.greatest(2 * _upper_tail(x["z_runs"]), F.lit(1e-300))))
         - F.ln(F.least(F.lit(1.0), F.greatest(2 * _upper_tail(x["z_serial"]), F.lit(1e-300))))).alias("half")))
    # Fisher: twice the sum of logs is chi-squared with six degrees of freedom, whose tail is closed.
    return F.transform(logs, lambda x: F.struct(
        x["start"].alias("start"), x["end"].alias("end"), _length_class(x["n"]).alias("class"),
        F.least(F.lit(BINS), F.greatest(F.lit(0), F.floor(
            (x["half"] - F.ln(1 + x["half"] + x["half"] * x["half"] / 2)) / math.log(10) * 20))).cast("int").alias("bin"),
        (x["n"] >= _by_encoding(x["enc"], least)).alias("long_enough")))


def _tested(text: Column) -> Column:
    return battery(_hits(text, CANDIDATE, _may_run(text)))


def cleared_bins(docs: DataFrame, clear_rate: float = 0.01) -> list[int]:
    """For each length class the least bin that counts as ordinary, from all tokens of the corpus.

    The step-up runs on bin edges, which is the exact procedure on p-values rounded up to their edge.
    """
    counts = (
        docs.select(text_of().alias("text")).where(_may_run(F.col("text")))
        .select(F.explode(_tested(F.col("text"))).alias("t")).groupBy("t.class", "t.bin").count().collect()
    )
    cuts = []
    for k in range(len(LENGTH_CLASSES) + 1):
        own = {r["bin"]: r["count"] for r in counts if r["class"] == k}
        total, below, cut = sum(own.values()), 0, BINS + 1
        for b in sorted(own, reverse=True):
            below += own[b]
            if 10 ** (-b / 20) * total <= clear_rate * below:
                cut = b
        cuts.append(cut)
    return cuts


def _written(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(
        ":", F.element_at(F.array(*[F.lit(k) for k in KINDS]), x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))))


def _places(spans: Column) -> Column:
    """Start and end of each span as one number, which set operations on arrays hash."""
    return F.transform(spans, lambda x: F.shiftleft(x["start"].cast("long"), 31) + x["end"])


def _inside(assign: Column) -> Column:
    """The places of tokens that lie in the spans of assignments.

    A token is a whole run of its characters. One that the span cuts has another place in the text than within the span and is not inside.
    Keys and hexadecimal spans are made of these characters, so only a token that is the whole span lies in one.
    """
    runs = F.transform(assign, lambda x: F.transform(
        _hits(x["hit"], CANDIDATE, F.length(x["hit"]) >= 20),
        lambda r: F.shiftleft((x["start"] + r["start"]).cast("long"), 31) + (x["start"] + r["end"])))
    return F.flatten(runs)


def scan_secrets(docs: DataFrame, clear_rate: float = 0.01) -> DataFrame:
    """One row per input row: doc_id, the spans of each kind, counts and their digest.

    A null text is empty. Spans are code points, the end exclusive; kinds may overlap, except that a
    random token inside a span of a fixed kind is not said twice. Repeated rows and repeated or null ids
    are rows like others; an empty table gives an empty result. Other columns of ``docs`` are not read.
    """
    cuts = cleared_bins(docs, clear_rate)
    rows = docs.select(F.col("doc_id"), text_of().alias("text"))
    assign, access, hexes = base_spans(F.col("text"))
    # Each step is worked out once, however often the next ones use it.
    rows = computed_once(rows, F.col("doc_id"), assign.alias("assign"), access.alias("access"), hexes.alias("hex"), _tested(F.col("text")).alias("tested"))
    tagged = lambda spans, kind: F.transform(spans, lambda x: F.struct(
        x["start"].alias("start"), F.lit(kind).alias("kind"), x["end"].alias("end")))
    unexplained = F.filter("tested", lambda t: t["long_enough"] & (t["bin"] < F.element_at(
        F.array(*[F.lit(c) for c in cuts]), t["class"] + 1)))
    random = F.transform(F.array_except(_places(unexplained), F.concat(_places(F.col("access")), _places(F.col("hex")), _inside(F.col("assign")))), lambda p: F.struct(
        F.shiftright(p, 31).cast("int").alias("start"), F.lit(3).alias("kind"), p.bitwiseAND(F.lit((1 << 31) - 1)).cast("int").alias("end")))
    rows = computed_once(
        rows, F.col("doc_id"), *[F.size(c).cast("long").alias(f"n_{c}") for c in ("assign", "access", "hex")],
        F.sort_array(F.concat(tagged("assign", 0), tagged("access", 1), tagged("hex", 2))).alias("base"), random.alias("random"))
    return computed_once(
        rows, F.col("doc_id"), F.col("n_assign"), F.col("n_access"), F.col("n_hex"), F.size("random").cast("long").alias("n_random"),
        F.sha2(_written(F.col("base")), 256).alias("base_sha256"),
        F.when(F.size("random") > 0, _written(F.sort_array(F.concat("base", "random")))).otherwise(_written(F.col("base"))).alias("spans"))
