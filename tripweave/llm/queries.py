"""The registered queries of this subpackage, with production parameters, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.llm import (
    decontamination, fill_in_middle, hard_negatives, html_wrappers, line_dedup, quality_rules, secret_scan, simhash_dedup, source_mixing,
    substring_dedup, suffix_dedup, url_filter, vector_dedup,
)
from tripweave.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_secret_scan(spark, sf_dir):
    return secret_scan.scan_secrets(table(spark, sf_dir, "documents"))


@query
def op2_quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return quality_rules.apply_rules(docs, quality_rules.learn(docs, table(spark, sf_dir, "labels")))


@query
def op3_substring_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.drop_repeated_substrings(docs).select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query
def op4_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.drop_repeated_lines(docs).select(
        F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query
def op5_html_extraction(spark, sf_dir):
    return html_wrappers.extract_articles(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


@query
def op6_simhash_dedup(spark, sf_dir):
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


@query
def op7_source_mixing(spark, sf_dir):
    return source_mixing.taken_words(table(spark, sf_dir, "documents")).drop("mark")


def _captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with a fetch day of 2024 by their number, as the tables have none."""
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", "url", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") * 13 % 366).cast("int")).alias("fetched"))


def _list_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dated list made of the pages: some paths and their hosts are blocked, some allowed, some of either taken off again."""
    pages = _captures(spark, sf_dir).where("page_id % 10 < 3").select("page_id", url_filter.bare_url(F.col("url")).alias("path"))
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") * 7 % 300).cast("int"))
    paths = pages.select(F.col("path").alias("value"), F.when(F.col("page_id") % 10 == 0, "allow").otherwise("block").alias("verdict"),
                         day.alias("day"), F.lit(True).alias("added"))
    ended = pages.where("page_id % 4 = 0").select(F.col("path").alias("value"), F.lit("block").alias("verdict"),
                                                  F.date_add(day, 45).alias("day"), F.lit(False).alias("added"))
    hosts = pages.where("page_id % 10 = 1").groupBy(F.split("path", "/")[0].alias("value")).agg(
        F.lit("block").alias("verdict"), F.min(day).alias("day"), F.lit(True).alias("added"))
    freed = hosts.where(F.length("value") % 2 == 0).select(
        "value", "verdict", F.date_add("day", 100).alias("day"), F.lit(False).alias("added"))
    return paths.union(ended).union(hosts).union(freed)


@query
def op8_url_filter(spark, sf_dir):
    entries = url_filter.validity(_list_events(spark, sf_dir))
    return url_filter.judge_captures(_captures(spark, sf_dir), entries).withColumn("fetched", F.date_format("fetched", "yyyy-MM-dd"))


@query
def op9_suffix_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.drop_repeated_bytes(docs).select(
        F.col("row.doc_id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op10_decontamination(spark, sf_dir):
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op11_embedding_dedup(spark, sf_dir):
    return vector_dedup.link_vectors(table(spark, sf_dir, "embeddings"))


@query
def op12_hard_negatives(spark, sf_dir):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine_hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", label))


@query
def op13_fill_in_middle(spark, sf_dir):
    return fill_in_middle.transform(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("row")


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_NEXT = " || ' ' || ".join(["x", *[f"lead(x, {i}) OVER own" for i in range(1, 20)]])

ORACLE_SQL["op3_substring_dedup"] = rf"""
WITH docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
words AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM docs),
windows AS (SELECT doc_id, p, {_NEXT} AS g FROM words WINDOW own AS (PARTITION BY doc_id ORDER BY p)),
starts AS (
  SELECT doc_id, p, g IS NOT NULL AND row_number() OVER (PARTITION BY g ORDER BY doc_id, p) > 1 AS later FROM windows),
gone AS (
  SELECT doc_id, p, max(CASE WHEN later THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS g
  FROM starts),
texts AS (
  SELECT words.doc_id, sum(g) AS n, string_agg(CASE WHEN g = 0 THEN x END, ' ' ORDER BY words.p) AS t
  FROM words JOIN gone ON words.doc_id = gone.doc_id AND words.p = gone.p GROUP BY words.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM docs d LEFT JOIN texts ON d.doc_id = texts.doc_id"""

ORACLE_SQL["op4_line_dedup"] = """
WITH docs AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (SELECT doc_id, unnest(ls) AS x, unnest(range(1, len(ls) + 1)) AS p FROM docs),
keyed AS (
  SELECT doc_id, x, p, translate(trim(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
losing AS (
  SELECT k, max(doc_id) AS last FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
kept AS (SELECT keyed.doc_id, x, p FROM keyed LEFT JOIN losing ON keyed.k = losing.k WHERE last IS NULL OR last = keyed.doc_id),
texts AS (SELECT doc_id, count(*) AS n, string_agg(x, chr(10) ORDER BY p) AS t FROM kept GROUP BY doc_id)
SELECT docs.doc_id, CAST(len(ls) AS BIGINT) AS n_lines, CAST(len(ls) - coalesce(n, 0) AS BIGINT) AS n_dropped,
  sha256(coalesce(t, '')) AS kept_sha256
FROM docs LEFT JOIN texts ON docs.doc_id = texts.doc_id"""

_BARE = r"""regexp_replace(regexp_replace(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://', ''), '[?#].*$', '')"""
_PATH = rf"""lower(regexp_replace(regexp_replace(regexp_extract({_BARE}, '^[^/]*', 0), '^.*@', ''), ':[0-9]*$', ''))
  || regexp_replace(regexp_replace({_BARE}, '^[^/]*', ''), '/+$', '')"""

ORACLE_SQL["op8_url_filter"] = rf"""
WITH captures AS (
  SELECT page_id, url, DATE '2024-01-01' + CAST(page_id * 13 % 366 AS INTEGER) AS fetched, {_PATH} AS path FROM pages),
own AS (SELECT page_id, path, DATE '2024-01-01' + CAST(page_id * 7 % 300 AS INTEGER) AS day FROM captures WHERE page_id % 10 < 3),
hosts AS (SELECT string_split(path, '/')[1] AS value, min(day) AS day FROM own WHERE page_id % 10 = 1 GROUP BY 1),
events AS (
  SELECT path AS value, CASE WHEN page_id % 10 = 0 THEN 'allow' ELSE 'block' END AS verdict, day, true AS added FROM own
  UNION ALL SELECT path, 'block', day + 45, false FROM own WHERE page_id % 4 = 0
  UNION ALL SELECT value, 'block', day, true FROM hosts
  UNION ALL SELECT value, 'block', day + 100, false FROM hosts WHERE length(value) % 2 = 0),
dated AS (
  SELECT value, verdict, day, added, coalesce(lead(day) OVER (PARTITION BY value, verdict ORDER BY day, added), DATE '9999-12-31') AS ended
  FROM events),
entries AS (SELECT value, verdict, day AS begun, ended FROM dated WHERE added AND day < ended),
parts AS (
  SELECT page_id, fetched, string_split(path, '/') AS ps, string_split(string_split(path, '/')[1], '.') AS ls FROM captures),
asked AS (
  SELECT DISTINCT page_id, fetched, value FROM (
    SELECT page_id, fetched, array_to_string(ps[1:i], '/') AS value FROM (SELECT *, unnest(range(1, len(ps) + 1)) AS i FROM parts)
    UNION ALL
    SELECT page_id, fetched, array_to_string(ls[i:len(ls)], '.') FROM (SELECT *, unnest(range(2, len(ls))) AS i FROM parts))
  WHERE value <> ''),
active AS (
  SELECT page_id, a.value, verdict = 'block' AS blocked FROM asked a JOIN entries e
  ON a.value = e.value AND begun <= fetched AND fetched < ended),
found AS (SELECT page_id, count(*) AS n, max(struct_pack(n := length(value), b := blocked, v := value)) AS top FROM active GROUP BY page_id)
SELECT c.page_id, c.url, strftime(fetched, '%Y-%m-%d') AS fetched, CAST(coalesce(n, 0) AS BIGINT) AS n_active,
  top.v AS decided_by, coalesce(top.b, false) AS blocked
FROM captures c LEFT JOIN found f ON c.page_id = f.page_id"""

#: Texts are cut into stretches of 512 starts, as taking a part of a long text costs its length. Two digits are a byte.
ORACLE_SQL["op9_suffix_dedup"] = """
WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
sized AS (SELECT doc_id, x, CAST(length(x) // 2 AS BIGINT) AS n FROM docs),
stretches AS (
  SELECT doc_id, s, substr(x, 2 * s + 1, 2 * (512 + 199)) AS y
  FROM (SELECT doc_id, x, unnest(range(0, n, 512)) AS s FROM sized)),
windows AS (
  SELECT doc_id, s + i AS p, md5_number(substr(y, 2 * i + 1, 400)) AS g
  FROM (SELECT doc_id, s, y, unnest(range(0, least(512, length(y) // 2 - 199))) AS i FROM stretches WHERE length(y) >= 400)),
often AS (SELECT g FROM windows GROUP BY g HAVING count(*) > 1),
starts AS (SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS before FROM windows WHERE g IN (SELECT g FROM often)),
numbered AS (
  SELECT doc_id, p, sum(CASE WHEN before IS NULL OR p > before + 200 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY p) AS nth
  FROM starts),
spans AS (SELECT doc_id, min(p) AS a, max(p) + 200 AS b FROM numbered GROUP BY doc_id, nth),
edges AS (SELECT doc_id, a, b, b - a AS gone FROM spans UNION ALL SELECT doc_id, n, n, 0 FROM sized),
pieces AS (
  SELECT doc_id, a, b, gone, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a, b), 0) AS since FROM edges),
kept AS (
  SELECT d.doc_id, max(n) AS n, sum(gone) AS gone, sum(CASE WHEN gone > 0 THEN 1 ELSE 0 END) AS spans,
    string_agg(substr(x, 2 * since + 1, 2 * (a - since)), '' ORDER BY a, b) AS y
  FROM sized d JOIN pieces p ON d.doc_id = p.doc_id GROUP BY d.doc_id)
SELECT doc_id, n AS n_bytes, CAST(gone AS BIGINT) AS n_removed, CAST(spans AS BIGINT) AS n_spans, sha256(unhex(y)) AS kept_sha256
FROM kept"""

_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = rf"regexp_extract_all({_LOW}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE_SQL["op10_decontamination"] = rf"""
WITH docs AS (SELECT doc_id, {_TERMS} AS w FROM documents),
items AS (SELECT item_id, {_TERMS} AS w FROM benchmark),
wanted AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM items WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM wanted),
windows AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, lengths WHERE len(w) >= n)),
hits AS (SELECT DISTINCT doc_id, i, windows.n, item_id FROM windows JOIN wanted ON windows.g = wanted.g AND windows.n = wanted.n),
words AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(*) AS n, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS s
  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(words.n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(found.n, 0) AS BIGINT) AS n_items, sha256(coalesce(s, '')) AS items_sha256, coalesce(words.n, 0) > 0 AS contaminated
FROM docs d LEFT JOIN words ON d.doc_id = words.doc_id LEFT JOIN found ON d.doc_id = found.doc_id"""

#: A vector that can link: neither null nor zero, all components finite.
_SOUND = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"

ORACLE_SQL["op11_embedding_dedup"] = f"""
WITH RECURSIVE sound AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
  WHERE {_SOUND} AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM sound a JOIN sound b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_inner_product(a.v, b.v) / (sqrt(list_inner_product(a.v, a.v)) * sqrt(list_inner_product(b.v, b.v))) >= 0.9),
reached AS (SELECT u, v FROM links UNION SELECT r.u, l.v FROM reached r JOIN links l ON r.v = l.u),
counts AS (SELECT u, count(*) AS n FROM links GROUP BY u),
least AS (SELECT u, min(v) AS v FROM reached GROUP BY u)
SELECT e.vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, least(e.vec_id, coalesce(l.v, e.vec_id)) AS component_id,
  e.vec_id <= coalesce(l.v, e.vec_id) AS kept
FROM embeddings e LEFT JOIN counts c ON e.vec_id = c.u LEFT JOIN least l ON e.vec_id = l.u"""

ORACLE_SQL["op12_hard_negatives"] = f"""
WITH part AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE {_SOUND} AND label IS NOT NULL),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM part a JOIN part b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
hard AS (
  SELECT p.anchor_id, positive_id, positive_score, n.vec_id AS negative_id, n.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY n.score DESC, n.vec_id) AS rank
  FROM positives p JOIN scored n ON p.anchor_id = n.anchor_id
  WHERE NOT same AND 50 * positive_score <= 100 * n.score AND 100 * n.score <= 95 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM hard WHERE rank <= 3"""

_UNITS = r"regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+')"
_DRAW = "CAST('0x' || substr(sha256('42:' || CAST(doc_id AS VARCHAR)), {at}, 8) AS BIGINT) AS {name}"

ORACLE_SQL["op13_fill_in_middle"] = rf"""
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS t, {_UNITS} AS u, {", ".join(_DRAW.format(at=8 * i + 1, name=f"h{i + 1}") for i in range(4))} FROM documents),
cut AS (
  SELECT doc_id, t, u, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain'
      WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
parts AS (
  SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle, array_to_string(u[b + 1:], '') AS suffix FROM cut)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
    ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256, sha256(t) AS restored_sha256
FROM parts"""
