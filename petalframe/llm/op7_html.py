"""Main text of web pages by equivalence-class template deduction.

Tokens of a page are its tags with their path and its text blocks with theirs.
Tokens of one host with equal occurrence vectors (as often on each of its
pages) form an equivalence class. Classes that occur on every page and hold
tags are the template: their tags nest (a path is above or below the other),
and text blocks in them are furniture, repeated by the template and not
written for the page, inside an article or main element as well. What remains
between template tokens are slots; the article is read from the slots under the
page's article or main element, or, where those hold nothing, from all slots of
the body, without those in elements that by tag, class or id are menus, headers, footers, sidebars,
notices, adverts, forms, scripts, styles or reader comments. Classes that mean
nothing else (comments, adverts, sidebars: ``SURE``) drop an element on any page.
Inside article and main, other words in class and id drop one only if the
template has its tag on every page of the host (ids of headings and sections
never do); on a host without a template a whole class has to be one of the
words. Numbers in class and id make no different path; a path is a hash of its
steps, as long at any depth.

Vectors are never collected: a token's vector is the sum of one hash per
(page content, count), in two halves that cannot overflow, so a host of any
size is aggregated map-side first and takes one row per token; copies of a
page weigh alike in all vectors and change no class. Only the template's text blocks (no more than one
page holds) and such tags come back to the pages of a host.

Block rules: character references are decoded, white space inside a block
becomes one space, blocks are trimmed and joined in page order by one space;
inline tags leave no gap, ``br`` ends a line like a block.

Defined cases: a null or empty page has the empty text; pages without a host
share the empty host; a host whose pages all hold the same text blocks (one page, or copies of it)
has no template, only the element rules; pages of a host that differ in little
count as different, and what all of them hold is template; repeated rows and pages are read one by one; broken markup is read as
far as it goes; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from petalframe.llm.common import small_side, write_stage

#: Parts of a host's pages where the furniture of all hosts is too large to be sent to every task.
SALTS = 64

#: Element names and the words of class and id that mark furniture.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "select", "button")
FURNITURE = frozenset("head nav footer aside form menu dialog object audio video canvas map fieldset legend label".split()) | frozenset(RAW)
WORDS_ANYWHERE = frozenset("ad ads advert adverts advertisement sponsor sponsored promo banner cookie cookies consent notice popup modal "
                           "newsletter subscribe comment comments reply replies disqus share sharing social related sidebar nav navbar navigation menu "
                           "breadcrumb breadcrumbs pagination footer login signup".split())
WORDS_OUTSIDE = WORDS_ANYWHERE | {"header", "masthead", "topbar", "toolbar"}
MAIN = frozenset(("article", "main"))
#: Classes that mean nothing else, whole or (the latter) as a part between signs: gone on any page.
SURE = frozenset("comment comments advert adverts advertisement ads sponsored cookie cookies sidebar disqus newsletter breadcrumb breadcrumbs "
                 "pagination navbar cookie-banner cookie-notice comment-list".split())
SURE_PARTS = frozenset("comments advert adverts advertisement sidebar disqus".split())
#: Inside these the id is a title's name, not a mark.
TITLED = frozenset("h1 h2 h3 h4 h5 h6 section".split())
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog"}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(" + "|".join(RAW) + r")\b(?:\"[^\"]*\"|'[^']*'|[^'\">])*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>", re.DOTALL | re.IGNORECASE)
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_NUMBER = re.compile("[0-9]+")
#: An opening tag closes an open element of these.
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}} | {t: {"p"} for t in "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol pre section table ul".split()}
SCOPE = frozenset("ul ol dl table article section div main body nav aside footer header blockquote td th li".split())


class _Element:
    __slots__ = ("tag", "path", "main", "dropped", "suspects")

    def __init__(self, tag: str, attributes: str, above: "_Element | None"):
        marks = [(k.lower(), (a or b or c).lower()) for k, a, b, c in _ATTRIBUTE.findall(attributes)] if attributes else []
        role = next((v for k, v in marks if k == "role"), "")
        self.tag = tag
        # hashed step by step: as long at any depth
        step = (above.path if above else "") + "/" + tag + "".join(f"[{_NUMBER.sub('0', v)}]" for _, v in marks)
        self.path = hashlib.blake2b(step.encode("utf-8", "surrogatepass"), digest_size=12).hexdigest()
        inside = bool(above and above.main)
        ignored = ("role", "id") if inside and tag in TITLED else ("role",)
        words = {w for k, v in marks if k not in ignored for w in re.split(r"[^a-z0-9]+", v)}
        classes = [v for k, v in marks if k == "class"]
        sure = tag not in ("html", "body", *MAIN) and any(
            not SURE.isdisjoint(v.split()) or not SURE_PARTS.isdisjoint(re.split(r"[^a-z0-9]+", v)) for v in classes)
        self.dropped = bool(above and above.dropped) or sure or tag in FURNITURE or role in ROLES or (tag == "header" and not inside) or bool(
            not inside and words & WORDS_OUTSIDE and tag not in ("html", "body"))
        self.main = not self.dropped and (inside or tag in MAIN or role == "main")
        #: Elements up to here that a template may drop: path, and whether a whole class is one of the words.
        self.suspects = above.suspects if above else ()
        if inside and words & WORDS_ANYWHERE:
            self.suspects += ((self.path, any(k == "class" and not WORDS_ANYWHERE.isdisjoint(v.split()) for k, v in marks)),)


def read_page(page: str | None) -> Iterator[tuple[str, str, bool, bool, tuple]]:
    """``(path, text, in main, dropped, suspects)`` in page order: text blocks,
    and opening tags as rows with an empty text."""
    if not page:
        return
    stack: list[_Element] = []
    root = _Element("", "", None)
    parts: list[str] = []
    at = 0

    def block():
        text = " ".join(html.unescape("".join(parts)).split())
        parts.clear()
        if text:
            e = stack[-1] if stack else root
            yield e.path, text, e.main, e.dropped, e.suspects

    for m in _TOKEN.finditer(page):
        if m.start() > at:
            parts.append(page[at:m.start()])
        at = m.end()
        name = m[3]
        if name is None:  # comments, declarations, raw elements
            continue
        tag = name.lower()
        if tag in INLINE:
            continue
        yield from block()
        if m[2]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
            continue
        if tag in VOID or m[4].endswith("/") and tag not in SCOPE:
            continue
        closes = CLOSES.get(tag, ())
        for i in range(len(stack) - 1, -1, -1):
            if stack[i].tag in closes:
                del stack[i:]
                break
            if stack[i].tag in SCOPE:
                break
        e = _Element(tag, m[4], stack[-1] if stack else root)
        stack.append(e)
        yield e.path, "", e.main, e.dropped, e.suspects
    if at < len(page):
        parts.append(page[at:])
    yield from block()


def _hash(*parts: str) -> int:
    return int.from_bytes(hashlib.blake2b("\x00".join(parts).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def templates(pages: DataFrame) -> DataFrame:
    """``(host, furniture)`` of hosts with a template: hashes of its text blocks,
    and of its tags that class or id mark inside an article."""

    def tokens(batches):
        for b in batches:
            rows: dict[tuple[str, int, bool, bool], list] = {}
            for host, key, page in zip(b.column("host").to_pylist(), b.column("page_key").to_pylist(), b.column("html").to_pylist()):
                found = list(read_page(page))
                # a token: its hash, whether it is text, whether it is sent back to the pages
                counts = Counter((_hash(path, text), bool(text), bool(text or suspects and suspects[-1][0] == path))
                                 for path, text, _, _, suspects in found)
                counts[0, False, False] = 1  # the page itself: the class of once a page
                hashes = {n: _hash(str(key), str(n)) for n in set(counts.values())}
                for token, n in counts.items():
                    row = rows.setdefault((host, *token), [0, 0, 0, None, None])
                    row[0] += hashes[n] & 0xFFFFFFFF
                    row[1] += hashes[n] >> 32
                    row[2] += 1
                row = rows[host, 0, False, False]
                content = _hash(*(text for _, text, *_ in found if text))
                row[3:] = (content, content) if row[3] is None else (min(row[3], content), max(row[4], content))
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in rows], pa.string()), pa.array([k[1] for k in rows], pa.int64()), pa.array([k[2] for k in rows], pa.bool_()),
                 pa.array([k[3] for k in rows], pa.bool_()), *[pa.array([v[i] for v in rows.values()], pa.int64()) for i in range(5)]],
                ["host", "token", "is_text", "is_sent", "low", "high", "pages", "first", "last"])

    seen = (pages.mapInArrow(tokens, "host string, token bigint, is_text boolean, is_sent boolean, low bigint, high bigint, pages bigint, first bigint, last bigint")
            .groupBy("host", "token", "is_text", "is_sent")
            .agg(*[F.sum(c).alias(c) for c in ("low", "high", "pages")], F.min("first").alias("first"), F.max("last").alias("last")))
    seen, _ = write_stage(seen, "html-tokens")
    # a class: equal vectors; valid with a tag in it and an occurrence on every page of a host of several different ones
    classes = seen.where("pages > 1").groupBy("host", "low", "high", "pages").agg(
        F.bool_or(~F.col("is_text")).alias("tags"), F.collect_list(F.when(F.col("is_sent"), F.col("token"))).alias("sent"))
    hosts = seen.where("token = 0 and not is_text and first < last").select("host", "pages")
    found = (classes.where("tags and size(sent) > 0").join(hosts, ["host", "pages"])
             .groupBy("host").agg(F.flatten(F.collect_list("sent")).alias("furniture")))
    return hosts.select("host").join(found, "host", "left").select("host", F.coalesce("furniture", F.array().cast("array<bigint>")).alias("furniture"))


def main_text(page: str | None, furniture: frozenset[int] | None = None) -> str:
    """The page's text; ``furniture`` of its host, None where it has no template."""

    def dropped(suspects: tuple) -> bool:
        return any(whole if furniture is None else _hash(path, "") in furniture for path, whole in suspects)

    slots = [(text, main) for path, text, main, out, suspects in read_page(page)
             if text and not out and not (furniture and _hash(path, text) in furniture) and not dropped(suspects)]
    only_main = any(main for _, main in slots)
    return " ".join(text for text, main in slots if main or not only_main)


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: ``page_id, url, text, n_chars`` (code points)."""
    rows = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("html"))
    rows = rows.withColumn("host", host_of(F.col("url")))
    # one short row per host with furniture: pages stay where they are, or meet it in salted parts of their host
    found, sent = small_side(templates(rows.select("host", F.xxhash64("html").alias("page_key"), "html")), "html-furniture")
    on = ["host"]
    if not sent:
        on = ["host", "salt"]
        rows = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
        found = found.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))

    def run(batches):
        for b in batches:
            texts = []
            known = b.column("furniture")
            for r, page in enumerate(b.column("html").to_pylist()):
                sent = known[r].as_py()
                texts.append(main_text(page, None if sent is None else frozenset(sent)))
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array(np.array([len(t) for t in texts], dtype=np.int64))],
                ["page_id", "url", "text", "n_chars"])

    return rows.join(found, on, "left").select("page_id", "url", "html", "furniture").mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
