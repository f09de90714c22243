"""HTML extraction by wrappers: union-free regular expressions learned from pages of one host.

A page is a stream of tags and texts. Repeated neighbouring blocks of a stream fold into a repeated group. Streams of a host are then
aligned one after the other with the wrapper found so far: tags without partner become
optional groups, texts that differ become slots, texts that never differ stay as constants. The
wrapper so tells the slots, which pages fill, from the template's own words; extraction reads a page along
the wrapper, keeps what fills slots, and of that what its elements place in the article. A page that the wrapper does not
read is judged by place alone.
"""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterator
from difflib import SequenceMatcher

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tripweave.llm.common import BROADCAST_ROWS, Scratch, text_of

#: Pages of a host a wrapper is learned from, at most: those with the smallest hash. All pages are read by it.
SAMPLE = 12
#: Sampled pages that must differ before an equal text in all of them counts as template.
DIFFERENT = 4
#: Longest block that may fold, in tokens.
LONGEST_BLOCK = 24
#: Bytes of wrappers that may be broadcast.
BROADCAST_BYTES = 8 << 20

#: Elements whose content is no article text.
ASIDE_TAGS = frozenset(
    "head title style script noscript template nav header footer aside form button select option textarea iframe svg object "
    "menu dialog".split())
#: Words of a class or id, and roles, that mark such content.
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement banner promo sponsor sponsored cookie cookies consent notice notices alert popup modal "
    "overlay newsletter subscribe subscription signup login sidebar menu nav navbar navigation breadcrumb breadcrumbs header "
    "masthead footer comment comments respond reply replies share sharing social related recommended widget toolbar pagination "
    "pager search copyright contentinfo complementary navigation dialog".split())
#: Parts of a class or id that speak of an aside without being one, anywhere in it and after the aside's name.
NOT_ASIDE = frozenset("has have no not non with without hide show".split())
STATES = frozenset("free less open opened closed enabled disabled result results on off none".split())
#: What marks a hidden element. Names of a class or id are split at white space, so none can be read as this.
HIDE = "  hidden"
#: Elements and words that mark the article.
MAIN_TAGS = frozenset({"article", "main"})
MAIN_WORDS = frozenset({"articlebody", "main"})
#: Elements that do not end a block of text, and elements without content.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q s samp small span strike strong sub sup "
    "time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that an opening element ends, and the elements beyond which it ends nothing.
IMPLIED = {
    "li": (frozenset({"li"}), frozenset("ul ol menu".split())),
    "dt": (frozenset({"dt", "dd"}), frozenset({"dl"})), "dd": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "td": (frozenset({"td", "th"}), frozenset({"tr", "table"})), "th": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
    "tr": (frozenset({"td", "th", "tr"}), frozenset("table thead tbody tfoot".split())),
    **{t: (frozenset("td th tr thead tbody tfoot".split()), frozenset({"table"})) for t in ("thead", "tbody", "tfoot")},
    "option": (frozenset({"option"}), frozenset("select datalist".split())),
}
#: Elements that end an open paragraph, and those beyond which they do not.
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr li main menu nav ol p pre search section summary table ul dt dd".split())
P_SCOPE = frozenset("button td th table caption object html".split())
RAW = "script|style|textarea|title|noscript|template|iframe"

TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)|<(?P<end>/?)(?P<tag>[a-z][a-z0-9:-]*)"
    r"""(?P<attrs>(?:[^<>"']|"[^"]*"|'[^']*')*)>|<[!?][^>]*>|(?P<text>[^<]+|<)""", re.S | re.I)
MARKS = re.compile(r"""\b(?:class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
HIDDEN = re.compile(r"hidden|display", re.I)
ATTRIBUTE = re.compile(r"""([^\s=<>"'/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
HIDING_STYLE = re.compile(r"(?:^|[;\s])(?:display\s*:\s*none|visibility\s*:\s*hidden)\b", re.I)

Token = tuple[str, str]  # ("<", opening mark), (">", element) or ("x", text)


def is_hidden(attrs: str) -> bool:
    """Whether an attribute or the inline style hides an element; names of classes and ids do not."""
    for name, *values in ATTRIBUTE.findall(attrs):
        name, value = name.lower(), "".join(values).strip().lower()
        if (name == "hidden" and value != "false") or (name == "aria-hidden" and value == "true"):
            return True
        if name == "style" and HIDING_STYLE.search(value):
            return True
    return False


def _ends_open(tag: str, stack: list[str]) -> int | None:
    """How much of the open elements stays when ``tag`` opens: it may end what HTML lets go without an end tag."""
    ended, within = IMPLIED.get(tag, (frozenset(), frozenset()))
    if tag in ENDS_P:
        ended, within = ended | {"p"}, within | P_SCOPE
    keep = None
    for k in range(len(stack) - 1, -1, -1):
        if stack[k] in ended:
            keep = k
            if stack[k] == "p" and tag in ENDS_P and tag not in IMPLIED:
                break
        elif stack[k] in within:
            break
    return keep


def _is_inline_aside(mark: str) -> bool:
    return mark.endswith(HIDE) or not holds_page_text(mark) and bool(aside_names(mark) - {"header"})


def tokens(page: str) -> list[Token]:
    """Tags and blocks of text in order. Inline elements are part of the text, unless hidden or named as an aside.

    Elements whose end may be left out end where HTML ends them, so streams are the same with and without the end tags; an
    end tag without its element is left out, and one of an outer element ends those inside it.
    """
    out: list[Token] = []
    words: list[str] = []
    stack: list[str] = []
    #: The inline aside that hides text now: its tag, how deep elements of that tag are nested in it, and the blocks open at its start.
    hiding: list | None = None

    def flush() -> None:
        if text := " ".join(html.unescape("".join(words)).split()):
            out.append(("x", text))
        words.clear()

    def close(keep: int) -> None:
        nonlocal hiding
        while len(stack) > keep:
            out.append((">", stack.pop()))
        if hiding and len(stack) < hiding[2]:
            hiding = None

    for m in TOKEN.finditer(page):
        if (text := m["text"]) is not None:
            if not hiding:
                words.append(text)
            continue
        if not m["tag"]:
            continue
        tag, attrs = m["tag"].lower(), m["attrs"]
        marks = " ".join(w for x in MARKS.findall(attrs) for w in "".join(x).lower().split()) if "=" in attrs else ""
        mark = f"{tag} {marks}".strip() + (HIDE if attrs and HIDDEN.search(attrs) and is_hidden(attrs) else "")
        empty = tag in VOID or attrs.rstrip().endswith("/")
        if tag in INLINE:
            if tag == "br" and not hiding:
                words.append(" ")
            if hiding and tag == hiding[0] and not empty:
                hiding[1] += -1 if m["end"] else 1
                if not hiding[1]:
                    hiding = None
            elif not hiding and not m["end"] and not empty and " " in mark and _is_inline_aside(mark):
                hiding = [tag, 1, len(stack)]
            continue
        flush()
        if m["end"]:
            scope = P_SCOPE if tag == "p" else IMPLIED.get(tag, (None, frozenset()))[1]
            for k in range(len(stack) - 1, -1, -1):
                if stack[k] == tag:
                    close(k)
                    break
                if stack[k] in scope:
                    break
        else:
            if (keep := _ends_open(tag, stack)) is not None:
                close(keep)
            if not empty:
                out.append(("<", mark))
                stack.append(tag)
    flush()
    return out


def places(stream) -> Iterator[tuple[int, tuple[str, ...]]]:
    """(number of the text, marks of the elements it lies in) for each text of a token stream."""
    stack: list[str] = []
    for i, (kind, value) in enumerate(stream):
        if kind == "x":
            yield i, tuple(stack)
        elif kind == "<":
            stack.append(value)
        else:
            at = next((k for k in range(len(stack) - 1, -1, -1) if stack[k].split(" ", 1)[0] == value), None)
            if at is not None:
                del stack[at:]


def _words(mark: str) -> set[str]:
    return set(re.split(r"[^a-z]+", mark.split(" ", 1)[1])) if " " in mark else set()


def is_main(mark: str) -> bool:
    return mark.split(" ", 1)[0] in MAIN_TAGS or bool(_words(mark) & MAIN_WORDS)


def holds_page_text(mark: str) -> bool:
    """Whether a mark is that of the page's main text, of which pages have one, and not of one article among others."""
    tag, _, names = mark.partition(" ")
    return tag == "main" or not MAIN_WORDS.isdisjoint(names.split())


def aside_names(mark: str) -> set[str]:
    """The aside words that names of a class or id are, begin with or end with; has-sidebar or ad-free is none."""
    found = set()
    for name in mark.split()[1:]:
        parts = [x for x in re.split(r"[^a-z]+", name) if x]
        if parts and NOT_ASIDE.isdisjoint(parts):
            found.add(parts[-1])
            if STATES.isdisjoint(parts[1:]):
                found.add(parts[0])
    return found & ASIDE_WORDS


def is_aside(path: tuple[str, ...], spared: int = 0) -> bool:
    """Whether a place is no article text. A header inside an article may hold its title and does not count.

    The first ``spared`` elements, and those that hold the page's main text or are it, count only if hidden.
    """
    spared = max([spared, *(k + 1 for k, mark in enumerate(path) if holds_page_text(mark))][:2])
    inside = False
    for k, mark in enumerate(path):
        if mark.endswith(HIDE):
            return True
        if k >= spared:
            tag = mark.split(" ", 1)[0]
            if tag in ASIDE_TAGS and not (inside and tag == "header"):
                return True
            words = aside_names(mark.removesuffix(HIDE)) if tag not in ("html", "body") else set()
            if words and not (inside and words <= {"header"}):
                return True
        inside = inside or is_main(mark)
    return False


def article_places(paths: list[tuple[str, ...]]) -> list[bool]:
    """For each place whether it is article text: inside the article if one is marked, else anywhere but aside.

    Where each marked article lies in an aside, it counts beside the other text: either may be the article.
    """
    good = [not is_aside(p) for p in paths]
    first = [next((k + 1 for k, m in enumerate(p) if is_main(m)), 0) for p in paths]
    if any(g and i for g, i in zip(good, first)):
        return [g and i > 0 for g, i in zip(good, first)]
    return [g or (i > 0 and not is_aside(p, i)) for g, i, p in zip(good, first, paths)]


# -- wrappers: lists of ["<", mark], [">", element], ["x", constant or None], ["?", [...]] and ["+", [...]]

def _sign(node) -> str:
    if node[0] in "?+":
        return node[0] + "(" + "".join(map(_sign, node[1])) + ")"
    return "x;" if node[0] == "x" else f"{node[0]}{node[1]};"


def _merge_same(a: list, b: list) -> list:
    """Two sequences of one signature as one: texts that differ become slots."""
    out = []
    for x, y in zip(a, b):
        if x[0] == "x":
            out.append(["x", x[1] if x[1] == y[1] else None])
        else:
            out.append([x[0], _merge_same(x[1], y[1])] if x[0] in "?+" else x)
    return out


def folded(nodes: list) -> list:
    """Neighbouring blocks of one signature as a repeated group, short blocks first, until nothing folds."""
    for length in range(1, LONGEST_BLOCK + 1):
        signs = [_sign(n) for n in nodes]
        out, i, again = [], 0, False
        while i < len(nodes):
            block, n = signs[i:i + length], 1
            if len(block) == length and any(s[0] in "<+" for s in block):
                while signs[i + n * length:i + (n + 1) * length] == block:
                    n += 1
            if n > 1:
                body = nodes[i:i + length]
                for k in range(1, n):
                    body = _merge_same(body, nodes[i + k * length:i + (k + 1) * length])
                out.append(["+", body])
                i += n * length
                again = True
            else:
                out.append(nodes[i])
                i += 1
        if again:
            return folded(out)
    return nodes


def _optional(nodes: list) -> list:
    return [] if not nodes else nodes if len(nodes) == 1 and nodes[0][0] in "?" else [["?", nodes]]


def _grouped(nodes: list, other: list) -> list:
    """``nodes`` with each block that ``other`` repeats as a group too, though it may stand only once here."""
    bodies = [list(map(_sign, n[1])) for n in other if n[0] == "+"]
    signs, out, i = list(map(_sign, nodes)), [], 0
    while i < len(nodes):
        size = next((len(body) for body in bodies if signs[i:i + len(body)] == body), 0)
        out.append(["+", nodes[i:i + size]] if size else nodes[i])
        i += size or 1
    return out


def aligned(a: list, b: list) -> list:
    """The wrapper that reads what either reads: equal parts once, the rest as optional or repeated groups."""
    a, b = _grouped(a, b), _grouped(b, a)
    out: list = []
    sign_a, sign_b = [_sign(n) for n in a], [_sign(n) for n in b]
    for what, i, j, k, m in SequenceMatcher(None, sign_a, sign_b, autojunk=False).get_opcodes():
        if what == "equal":
            out += _merge_same(a[i:j], b[k:m])
            continue
        left, right = a[i:j], b[k:m]
        bare = lambda nodes: nodes[0][1] if len(nodes) == 1 and nodes[0][0] in "?+" else nodes
        kinds = {n[0] for n in left + right if n[0] in "?+"}
        if kinds and left and right and list(map(_sign, bare(left))) == list(map(_sign, bare(right))):
            out.append(["+" if "+" in kinds else "?", _merge_same(bare(left), bare(right))])
        elif len(left) == len(right) == 1 and left[0][0] in "?+" and right[0][0] in "?+":
            out.append(["+" if "+" in (left[0][0], right[0][0]) else "?", aligned(left[0][1], right[0][1])])
        else:
            out += _optional(left) + _optional(right)
    return folded(out)


def _flat(nodes: list, always: bool = True) -> Iterator[tuple[str, object, bool]]:
    for n in nodes:
        if n[0] in "?+":
            yield from _flat(n[1], False)
        else:
            yield n[0], n[1], always


def learn_wrapper(pages: list[str]) -> dict:
    """The wrapper of some pages, and for each of its texts the constant, if it may be part of the template, else None.

    That is a constant which every one of these pages has, wherever it lies, while they differ in other texts.
    ``confirmed`` tells which of them all pages of the host have.
    """
    streams = [tokens(p) for p in pages]
    wrapper: list = []
    for k, stream in enumerate(streams):
        nodes = folded([list(t) for t in stream])
        wrapper = nodes if not k else aligned(wrapper, nodes)
    texts = [x for x in _flat(wrapper) if x[0] == "x"]
    different = len({" ".join(v for t, v in s if t == "x") for s in streams})
    return {"nodes": wrapper, "template": [c if always and different >= DIFFERENT else None for _, c, always in texts]}


def _read(wrapper: dict, stream: list[Token]) -> list[tuple[int, int]] | None:
    """(number of the wrapper's text, number of the token) of a page's texts; None if the wrapper does not read the whole page."""
    found: list[tuple[int, int]] = []

    def size(nodes) -> int:
        return sum(size(n[1]) if n[0] in "?+" else n[0] == "x" for n in nodes)

    def take(nodes, i: int, slot: int) -> int | None:
        for n in nodes:
            if n[0] == "x":
                if i < len(stream) and stream[i][0] == "x":
                    found.append((slot, i))
                    i += 1
                slot += 1
            elif n[0] in "?+":
                while True:
                    mark = len(found)
                    after = take(n[1], i, slot)
                    if after is None or after == i:
                        del found[mark:]
                        break
                    i = after
                    if n[0] == "?":
                        break
                slot += size(n[1])
            elif i < len(stream) and stream[i] == (n[0], n[1]):
                i += 1
            else:
                return None
        return i

    return found if take(wrapper["nodes"], 0, 0) == len(stream) else None


def read_along(wrapper: dict, stream: list[Token]) -> list[int] | None:
    """The texts of a page, as numbers of tokens, that fill slots; None if the wrapper does not read the whole page."""
    found = _read(wrapper, stream)
    return None if found is None else [i for slot, i in found if wrapper["template"][slot] != stream[i][1]]


def denied(wrapper: dict, stream: list[Token]) -> list[int]:
    """The wrapper's texts that this page shows to be no template, as it has another text there or none."""
    found = _read(wrapper, stream)
    texts = {slot: stream[i][1] for slot, i in found or []}
    return [] if found is None else [k for k, c in enumerate(wrapper["template"]) if c is not None and texts.get(k) != c]


def article_text(page: str, wrapper: dict | None) -> str:
    """Texts that lie in the article and fill slots of the wrapper. Where it lies is a matter of the page's own elements."""
    stream = tokens(page)
    where = list(places(stream))
    good = {i for (i, _), inside in zip(where, article_places([p for _, p in where])) if inside}
    slots = read_along(wrapper, stream) if wrapper else None
    return "\n".join(stream[i][1] for i in (slots if slots is not None else sorted(good)) if i in good)


# -- on Spark

def host_of(url: Column) -> Column:
    """The host in lower case, empty where there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def wrappers(pages: DataFrame, scratch: Scratch, sample: int = SAMPLE) -> DataFrame:
    """(host, wrapper) learned from at most ``sample`` pages of each host.

    The sample is picked from hashes, so pages move only once they are chosen; a host's task holds ``sample`` pages.
    """
    mark = F.xxhash64("page_id", "url", "html")
    rows = pages.select(host_of(F.col("url")).alias("host"), mark.alias("h"))
    chosen = rows.withColumn("k", F.row_number().over(W.partitionBy("host").orderBy("h"))).where(F.col("k") <= sample)
    chosen = scratch.keep(chosen.select("h").distinct(), "sample")
    n = chosen.count()
    picked = pages.select(host_of(F.col("url")).alias("host"), text_of("html").alias("html"), mark.alias("h"))
    picked = picked.join(F.broadcast(chosen) if n <= BROADCAST_ROWS else chosen, "h", "left_semi").dropDuplicates(["h"])

    def learn(frame: pd.DataFrame) -> pd.DataFrame:
        found = learn_wrapper(frame.sort_values("h")["html"].tolist())
        return pd.DataFrame({"host": frame["host"].iloc[:1], "wrapper": [json.dumps(found, ensure_ascii=False)]})

    return scratch.keep(picked.groupBy("host").applyInPandas(learn, "host string, wrapper string"), "wrappers")


def _pages_with(wrapper: DataFrame, pages: DataFrame) -> DataFrame:
    """Pages beside the wrapper of their host."""
    size = wrapper.agg(F.sum(F.octet_length("wrapper"))).first()[0] or 0
    rows = pages.select("page_id", "url", text_of("html").alias("html"), host_of(F.col("url")).alias("host"))
    return rows.join(F.broadcast(wrapper) if size <= BROADCAST_BYTES else wrapper, "host", "left")


def confirmed(found: DataFrame, pages: DataFrame, scratch: Scratch) -> DataFrame:
    """Wrappers whose template holds only what every page of the host that they read has: all pages are asked, not a sample."""
    def ask(batches):
        known: dict[str, dict] = {}
        for batch in batches:
            out = set()
            for host, page, text in zip(*(batch.column(c).to_pylist() for c in ("host", "html", "wrapper"))):
                if text not in known:
                    if len(known) > 256:
                        known.clear()
                    known[text] = json.loads(text)
                if any(c is not None for c in known[text]["template"]):
                    out.update((host, k) for k in denied(known[text], tokens(page)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([h for h, _ in out], pa.string()), pa.array([k for _, k in out], pa.int32())], ["host", "slot"])

    rows = _pages_with(found, pages).where(F.col("wrapper").isNotNull()).select("host", "html", "wrapper")
    against = rows.mapInArrow(ask, "host string, slot int").groupBy("host").agg(F.collect_set("slot").alias("slots"))

    def without(batches):
        for batch in batches:
            out = []
            for text, slots in zip(batch.column("wrapper").to_pylist(), batch.column("slots").to_pylist()):
                if slots:
                    wrapper = json.loads(text)
                    gone = set(slots)
                    wrapper["template"] = [None if k in gone else c for k, c in enumerate(wrapper["template"])]
                    text = json.dumps(wrapper, ensure_ascii=False)
                out.append(text)
            yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(out, pa.string())], ["host", "wrapper"])

    return scratch.keep(found.join(against, "host", "left").select("host", "wrapper", "slots").mapInArrow(
        without, "host string, wrapper string"), "confirmed")


def extract_articles(pages: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """page_id, url and ``text`` for each input row: the article, a line for each block.

    A null html is empty and has the empty text. Pages without a host share one wrapper. Repeated rows are read alike; an empty table
    gives an empty result. Other columns of ``pages`` are not read.
    """
    scratch = Scratch(pages.sparkSession, "wrappers")
    found = confirmed(wrappers(pages, scratch, sample), pages, scratch)
    rows = _pages_with(found, pages).select("page_id", "url", "html", "host", "wrapper")

    def read(batches):
        known: dict[str, dict] = {}
        for batch in batches:
            texts = []
            for page, text in zip(batch.column("html").to_pylist(), batch.column("wrapper").to_pylist()):
                if text is not None and text not in known:
                    if len(known) > 256:
                        known.clear()
                    known[text] = json.loads(text)
                texts.append(article_text(page, known.get(text)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(read, f"page_id {kind}, url string, text string")
