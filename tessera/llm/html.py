"""Main text of web pages by equivalence-class template deduction.

The tokens of a host's pages are tags in their place (the open containers around them) and short pieces of text in theirs.
Tokens with the same occurrence vector over the pages form a class; a class that is large and frequent enough is valid, and
the valid classes, nested by their places, are the host's template. What stands between template tokens are slots: those
that hold running text are the article, and the pieces of text that belong to the template are not. The names of tags and
classes are features of the slots; they alone decide only where a host has no template. Occurrence vectors are compared by
digests that add up over pages, so that no host's pages are gathered anywhere.

A page is read by one forward scan whose time is linear in its length. What only looks like markup (a < that begins no tag,
a tag that never ends) is text.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: Pages and tokens (a text has one for each word) that a valid class has at least, and the shares of its host's pages that a
#: template text and a template container must be on: they bound a template by a multiple of what a page holds on average.
#: Pages that differ only outside of what can be an article count as one.
SUPPORT, SIZE, TEXT_SHARE, CONTAINER_SHARE = 3, 3, 0.5, 1 / 64
#: A text with more words is running text.
SHORT = 8

_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^<>\"']*)>")
_TAG_NAME = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
_PLAIN = re.compile(r"[^>\"']*")
_NAME = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
#: Elements whose content is no text of the page; RAW ones run to the page's end if nothing closes them.
_RAW = frozenset("script style textarea iframe".split())
_SKIPPED = _RAW | frozenset("noscript template svg select object".split())
_CLOSES = {name: re.compile(rf"</{name}\b[^>]*>", re.I) for name in _SKIPPED}
_CONTAINERS = frozenset("html body div section article main nav header footer aside ul ol dl table tbody thead tr td th form figure details dialog center fieldset".split())
_BLOCKS = _CONTAINERS | frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre blockquote hr address caption figcaption title head option summary".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_AWAY_TAGS = frozenset("nav footer aside form title head button dialog fieldset menu".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_MAIN_TAGS = frozenset(("article", "main"))
_AWAY = re.compile(r"(?:^|[\s_-])(?:nav|navbar|navigation|menu|site-header|masthead|topbar|footer|sidebar|side|aside|widget|ads?|advert\w*|banner|promo\w*|sponsor\w*|cookies?|consent|notices?|alert|popup|modal|overlay|newsletter|subscribe|share|sharing|social|related|recommend\w*|comments?|commentlist|disqus|respond|replies|breadcrumbs?|pagination|pager|login|search|toolbar|copyright|contentinfo|complementary)(?:$|[\s_-])", re.I)
#: Inside of an article a name counts only if it says nothing else: known words and words of layout alone.
_AWAY_WORD = re.compile(_AWAY.pattern.removeprefix("(?:^|[\\s_-])").removesuffix("(?:$|[\\s_-])"), re.I)
_LAYOUT_WORDS = frozenset("area bar block body bottom box btn button buttons card container content footer form group header inline inner item items left link links list outer panel post posts right section slot thread title top unit wrap wrapper".split())
_PARTS = re.compile(r"[\s_-]+")
_MAIN = re.compile(r"(?:^|[\s_-])(?:main|article|articlebody|post-content|entry-content|article-body|story-body)(?:$|[\s_-])", re.I)


def _away_inside(name: str) -> bool:
    """Whether a class or id inside of an article names something that is not of it."""
    parts = [p for p in _PARTS.split(name) if p.strip("#0123456789")]
    known = [bool(_AWAY_WORD.fullmatch(p)) for p in parts]
    whole = bool(_AWAY_WORD.fullmatch(name.strip()))
    return whole or (any(known) and all(k or p in _LAYOUT_WORDS for k, p in zip(known, parts, strict=True)))


class Block:
    """A block's text, the container around it (its number, -1 if none), and whether it is a heading."""

    __slots__ = ("away", "container", "heading", "main", "text")

    def __init__(self, text: str, container: int, away: bool, main: bool, heading: bool):
        self.text, self.container, self.away, self.main, self.heading = text, container, away, main, heading


class Page:
    """What a page is made of: its tag tokens (with whether they open a container), the token and the parent of each
    container, and its blocks, all in order. The tags of what is named as no article are not among the tokens."""

    __slots__ = ("blocks", "parents", "tags", "tokens")

    def __init__(self):
        self.tags: list[tuple[int, bool]] = []
        self.tokens: list[int] = []
        self.parents: list[int] = []
        self.blocks: list[Block] = []


def _hash(token: str | bytes) -> int:
    return xxhash.xxh64_intdigest(token) - (1 << 63)


def _tag_end(page: str, at: int, none: set[str]) -> int:
    """Where the tag whose attributes begin at `at` ends, after its >, or -1. A quoted value may hold >; a quote that nothing
    closes is a plain character. none remembers the quotes that are not found any more, so that they are looked for once."""
    while True:
        at = _PLAIN.match(page, at).end()
        if at >= len(page):
            return -1
        mark = page[at]
        if mark == ">":
            return at + 1
        end = -1 if mark in none else page.find(mark, at + 1)
        if end < 0:
            none.add(mark)
        at = max(end, at) + 1


def scan(page: str):
    """The parts of a page in order: (text, None, False, "") for text and ("", name, closing, attributes) for a tag.

    One forward scan: comments and skipped elements go whole, and what a search did not find once is not looked for again."""
    at, n, lost, none = 0, len(page), set(), set()
    quoted = True  # after a tag that ends only without regard to quotes, quotes are no longer looked at
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            yield page[at:], None, False, ""
            return
        if lt > at:
            yield page[at:lt], None, False, ""
        m = _TAG.match(page, lt)
        if m:
            closing, name, attributes, at = bool(m[1]), m[2].lower(), m[3], m.end()
        elif m := _TAG_NAME.match(page, lt):
            end = _tag_end(page, m.end(), none) if quoted else -1
            if end < 0:
                quoted = False
                end = 0 if ">" in lost else page.find(">", m.end()) + 1
                if not end:
                    lost.add(">")
                    yield "<", None, False, ""
                    at = lt + 1
                    continue
            closing, name, attributes, at = bool(m[1]), m[2].lower(), page[m.end() : end - 1], end
        elif page.startswith(("<!", "<?"), lt):
            close = "-->" if page.startswith("<!--", lt) else ">"
            end = -1 if close in lost else page.find(close, lt + 2)
            if end >= 0:
                at = end + len(close)
                continue
            lost.add(close)
            if close == "-->":  # a comment that nothing closes runs to the end
                return
            yield "<", None, False, ""
            at = lt + 1
            continue
        else:
            yield "<", None, False, ""
            at = lt + 1
            continue
        if not closing and name in _SKIPPED and not attributes.endswith("/"):
            m = None if name in lost else _CLOSES[name].search(page, at)
            if m:
                at = m.end()
                continue
            lost.add(name)
            if name in _RAW:
                return
        yield "", name, closing, attributes


def parse(page: str) -> Page:
    """A container's token is its name and attributes after its parent's token."""
    out = Page()
    stack: list[tuple[str, int, bool, bool]] = []  # name, container, away, main
    open_names: dict[str, int] = {}
    buffer: list[str] = []
    heading = away = main = False
    container = -1

    def flush() -> None:
        if buffer:
            text = " ".join("".join(buffer).split())
            if text:
                out.blocks.append(Block(text, container, away, main, heading))
            buffer.clear()

    for text, name, closing, attributes in scan(page):
        if name is None:
            buffer.append(html.unescape(text) if "&" in text else text)
            continue
        if name == "br":
            buffer.append(" ")
        if name not in _BLOCKS and name not in _AWAY_TAGS:
            continue
        flush()
        heading = name in _HEADINGS and not closing
        holds = name in _CONTAINERS or name in _AWAY_TAGS
        if closing:
            was = away
            if holds and open_names.get(name):
                while stack:
                    top = stack.pop()[0]
                    open_names[top] -= 1
                    if top == name:
                        break
                container, away, main = stack[-1][1:] if stack else (-1, False, False)
            if not was:
                out.tags.append((_hash(f"{out.tokens[container] if container >= 0 else 0}</{name}>"), False))
            continue
        named = [re.sub("[0-9]{2,}", "#", (a[2] or a[3] or a[4] or "").lower()) for a in _NAME.finditer(attributes)] if attributes else []
        names = " ".join(named)  # without numbers of a page, but with those of a column
        token = _hash(f"{out.tokens[container] if container >= 0 else 0}<{name} {names}>")
        was = away
        if holds and name not in _VOID:
            away = away or name in _AWAY_TAGS or (name == "header" and not main) or bool(names and name not in ("html", "body") and _AWAY.search(names) and (not main or any(map(_away_inside, named))))
            main = (main or name in _MAIN_TAGS or bool(names and _MAIN.search(names))) and not away
            out.parents.append(container)
            out.tokens.append(token)
            container = len(out.tokens) - 1
            stack.append((name, container, away, main))
            open_names[name] = open_names.get(name, 0) + 1
        if not was:
            out.tags.append((token, holds))
    flush()
    return out


def _text_tokens(page: Page, blocks: list[Block]) -> list[int]:
    """Of each block the token of its text in its place; equal ones are told apart by their order."""
    out: list[int] = []
    seen: dict[tuple[int, str], int] = {}
    for b in blocks:
        place = page.tokens[b.container] if b.container >= 0 else 0
        seen[place, b.text] = k = seen.get((place, b.text), 0) + 1
        out.append(_hash(f"{place}={b.text}#{k}"))
    return out


def host_of(url: str | None) -> str:
    m = re.match(r"\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return m[1].lower() if m else ""


def page_tokens(html_text: str) -> dict[int, list[int]]:
    """Of each token of a page: its occurrences, 1 if it is a container and 2 if a text, its words, and 1 if running text
    stands directly in it."""
    page = parse(html_text)
    blocks = [b for b in page.blocks if not b.away]
    seen: dict[int, list[int]] = {}
    for t, container in page.tags:
        seen.setdefault(t, [0, int(container), 1, 0])[0] += 1
    for b, t in zip(blocks, _text_tokens(page, blocks), strict=True):
        if b.container >= 0 and page.tokens[b.container] in seen and b.text.count(" ") >= SHORT:
            seen[page.tokens[b.container]][3] = 1
        seen[t] = [1, 2, b.text.count(" ") + 1, 0]
    return seen


def templates(pages: DataFrame) -> DataFrame:
    """(host, template): of every host the containers and texts of its valid classes, and whether running text stands
    directly in a container on some page.

    pages: url, html. A class is the tokens of a host with equal occurrence vectors, that is, with as many occurrences on
    each page. A vector's digest is the sum over the distinct pages of a hash of (page, count), kept as the sums of the
    hash's two halves; copies of a page count once. A template holds at most 1 / TEXT_SHARE times the texts and
    1 / CONTAINER_SHARE times the containers that the host's pages hold on average, so its row is bounded by a page's."""
    lists = [("token", pa.list_(pa.int64())), ("n", pa.list_(pa.int32())), ("kind", pa.list_(pa.int32())), ("words", pa.list_(pa.int32())), ("running", pa.list_(pa.int32()))]
    schema = pa.schema([("host", pa.string()), ("page", pa.int64()), *lists])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: dict[tuple[str, int], np.ndarray] = {}
            for url, page in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                seen = page_tokens(page.as_py() or "")
                held = np.array([(t, *s) for t, s in seen.items()], np.int64).reshape(-1, 5)
                rows.setdefault((host_of(url), _hash(held.tobytes())), held)
            ends = pa.array(np.cumsum([0, *map(len, rows.values())]), pa.int32())
            flat = np.concatenate([*rows.values(), np.zeros((0, 5), np.int64)])
            values = [pa.ListArray.from_arrays(ends, pa.array(flat[:, c], pa.int64()).cast(t.value_type)) for c, (_, t) in enumerate(lists)]
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in rows], pa.string()), pa.array([k[1] for k in rows], pa.int64()), *values], schema=schema)

    names = [name for name, _ in lists]
    marks = pages.select("url", "html").mapInArrow(run, "host string, page long, token array<long>, n array<int>, kind array<int>, words array<int>, running array<int>")
    marks = marks.groupBy("host", "page").agg(F.first(F.arrays_zip(*names)).alias("tokens")).select("host", "page", F.inline("tokens"))
    h = F.xxhash64("page", "n")
    marks = marks.groupBy("host", "token").agg(F.sum(F.shiftright(h, 32)).alias("high"), F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF))).alias("low"), F.count("*").alias("pages"), F.max("kind").alias("kind"), F.max("words").alias("words"), F.max("running").alias("running")).filter(F.col("pages") >= SUPPORT)
    vector = Window.partitionBy("host", "high", "low", "pages")
    valid = marks.withColumn("size", F.sum("words").over(vector)).filter((F.col("size") >= SIZE) & (F.col("kind") > 0))
    # Texts of the template stand on most of the host's pages, containers on some share of them.
    most = marks.groupBy("host").agg(F.max("pages").alias("most"))
    share = F.when(F.col("kind") == 1, CONTAINER_SHARE).otherwise(TEXT_SHARE)
    valid = valid.join(most, "host").filter(F.col("pages") >= F.col("most") * share)
    return valid.groupBy("host").agg(F.collect_list(F.struct("token", (F.col("running") > 0).alias("running"))).alias("template"))


def main_text(html_text: str | None, template: dict[int, bool] | None = None) -> str:
    """The article of a page, one line a block. template: the tokens of its host's template, and of a container whether
    running text stands directly in it on some of the host's pages."""
    page = parse(html_text or "")
    blocks = [b for b in page.blocks if not b.away]
    if not template:
        marked = any(b.main for b in blocks)
        return "\n".join(b.text for b in blocks if b.main or not marked)
    blocks = [b for b, t in zip(blocks, _text_tokens(page, blocks), strict=True) if t not in template]
    # A block's slot is the innermost template container around it. A slot is of the article if running text stands in it or
    # around it on any page of the host, or on this page; its labels belong to it.
    slot, around = [0], [False]  # by container, shifted by one: what is in none comes first
    for token, parent in zip(page.tokens, page.parents, strict=True):
        known = template.get(token)
        slot.append(slot[parent + 1] if known is None else token)
        around.append(around[parent + 1] or bool(known))
    running = {slot[b.container + 1] for b in blocks if b.text.count(" ") >= SHORT}
    return "\n".join(b.text for b in blocks if b.main or b.heading or slot[b.container + 1] in running or around[b.container + 1])


def extract(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """keep, text and n_chars of every row of pages (url, html).

    A null or empty html has an empty text. Pages without a host count as of one host without a name; hosts with few pages
    have no template, and their pages are read by their tags alone. Nothing is cut off; repeated rows give equal rows; an
    empty table gives an empty result; other columns are ignored."""
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))
    # Written first, so that both sides of the join are plain exchanges and a host with very many pages can be split.
    known = stored(templates(pages), "templates").withColumnRenamed("host", "h")
    rows = pages.select(*keep, "url" if "url" not in keep else F.lit(None).cast("string").alias("_"), F.col("html").alias("html"))
    rows = rows.withColumn("_host", host).join(known, F.col("_host") == F.col("h"), "left").select(*keep, "html", "template", "_host")
    names = [*keep, "text", "n_chars"]
    n = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, dict] = {}
        for batch in batches:
            texts = []
            for page, template, host in zip(batch.column(n), batch.column(n + 1), batch.column(n + 2), strict=True):
                host = host.as_py()
                if host not in held:
                    if len(held) > 256:
                        held.clear()
                    held[host] = {t["token"]: t["running"] for t in template.as_py() or ()}
                texts.append(main_text(page.as_py(), held[host]))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(n)), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=names)

    schema = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in keep) + ", text string, n_chars long"
    return rows.mapInArrow(run, schema)
