"""Main text of web pages by inferred wrappers.

A host's wrapper is a union-free regular expression over the tokens of its
pages: element tokens with their nested expressions, text slots, optional items
and repeated groups. It starts as one page. Page after page is aligned with it;
where the streams differ, the items that one side lacks become optional, and a
stretch that begins anew becomes a repeated group. Texts that meet in one place
share a slot, which knows how often it was filled, how much of it was linked and
whether its text ever changed. Two wrappers align like a wrapper and a page, so
every task infers wrappers of its own pages and those are merged by host.

A finished wrapper marks its slots: text of the article, text that may belong to
it where a page has no article or main element, or boilerplate - by the elements
around the slot, by links, and by texts that are the same on different pages.
A page is then read along its host's wrapper and keeps the marked texts.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from html import unescape
from zlib import crc32

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from riskfeat.llm.common import spare, whole_texts
from riskfeat.llm.urls import host as host_of
from riskfeat.operators.lookup import attach
from riskfeat.session import cut_lineage

# Elements of HTML by how they are laid out and read.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr img picture source area map track embed param link meta input base "
    "col".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
CLOSES = {"li": ("li", {"ul", "ol", "menu"}), "dt": ("dt dd", {"dl"}), "dd": ("dt dd", {"dl"}),
          "tr": ("tr td th", {"table"}), "td": ("td th", {"tr", "table"}), "th": ("td th", {"tr", "table"}),
          "tbody": ("tr td th tbody thead", {"table"}), "option": ("option", {"select"})}
# Elements and words of class, id and role that hold no article text.
OUTSIDE = frozenset("nav footer aside form head script style button select dialog template svg object audio video "
                    "canvas header".split())
WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar sidebars side "
    "menu menus nav navbar navigation breadcrumb breadcrumbs footer header masthead topbar cookie cookies consent gdpr "
    "notice notices alert comment comments respond reply replies disqus share sharing social related recommended "
    "newsletter subscribe subscription signup login popup modal overlay widget widgets pagination pager toolbar "
    "complementary contentinfo search searchbox dialog".split())
MODIFIERS = frozenset("has with no without is".split())

DEPTH = 100  # elements nested deeper are read as part of the element at this depth
WIDTH = 48  # a level with more items than this is folded into one repeated group
REACH = 8  # how far the alignment looks for the next common item
LINKED = 0.5  # share of a slot's text in links from which it is a menu
PAGES_ALIKE = 3  # different pages on which a text must not change to be the host's own
HELD = 2_000  # wrappers a task holds before it hands them on
BUCKETS = 64  # parts in which the wrappers of one host are merged first
PLAN_BYTES = 32 << 20  # most bytes of wrappers that are broadcast

_TAG = re.compile(r"""(/?)([a-zA-Z][^\s/>]*+)([^>"']*+(?:"[^"]*+"[^>"']*+|'[^']*+'[^>"']*+)*+)>""")
_LOOSE = re.compile(r"(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
_NAMED = re.compile(r"""(?<![\w-])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
_CLOSE = {t: re.compile(f"</{t}(?=[\\s/>])", re.I) for t in RAW}

# An item is [symbol, optional, repeated, kids, slot]: an element has kids, a text ("") a slot, a group ("(") kids.
Item = list
TEXT, GROUP = "", "("


# ----------------------------------------------------------------------- pages


def symbol(tag: str, attributes: str) -> str:
    """The tag with its class, id and role words, digits made equal."""
    if len(attributes) < 4:
        return tag
    words = sorted({re.sub(r"\d+", "0", w) for m in _NAMED.finditer(attributes)
                    for w in unescape(m[2] or m[3] or m[4] or "").split()})
    return " ".join([tag, *words])


def page_items(html: str) -> list[Item]:
    """The nested token stream of a page; a text's slot is [1, characters, linked ones, checksum, text].

    Tags may be missing, nested wrongly or cut off: an element ends where its
    parent does, a tag that was never opened only ends the text before it.
    """
    root: list[Item] = []
    stack: list[tuple[str, list]] = [("", root)]
    too_deep: dict[str, int] = {}
    pieces: list[str] = []
    links = open_links = 0
    pos, size, tag_at = 0, len(html), _TAG

    def end_text() -> None:
        nonlocal links
        text = " ".join(unescape("".join(pieces)).split())
        if text:
            slot = [1, len(text), min(links, len(text)), crc32(text.encode()), text]
            stack[-1][1].append([TEXT, False, False, None, slot])
        pieces.clear()
        links = 0

    while pos < size:
        at = html.find("<", pos)
        if at < 0:
            at = size
        if at > pos:
            pieces.append(html[pos:at])
            if open_links:
                links += at - pos
        if at == size:
            break
        follows = html[at + 1:at + 2]
        if follows in ("!", "?"):
            comment = html.startswith("<!--", at)
            stop = html.find("-->" if comment else ">", at + 4 if comment else at)
            pos = size if stop < 0 else stop + (3 if comment else 1)
            continue
        found = tag_at.match(html, at + 1)
        if found is None and tag_at is _TAG and (follows.isalpha() or follows == "/"):
            found = _LOOSE.match(html, at + 1)
            if found:
                tag_at = _LOOSE  # a quote that never ends: from here on tags end at the first >
        if found is None:
            if follows == "/" or (follows.isascii() and follows.isalpha()):
                pos = html.find(">", at) + 1 or size  # no name, or cut off inside a tag
            else:
                pieces.append("<")
                pos = at + 1
            continue
        pos, tag = found.end(), found[2].lower()
        if found[1]:
            if tag == "a":
                open_links = max(0, open_links - 1)
            if tag in INLINE:
                continue
            if tag == "br":
                pieces.append(" ")
                continue
            end_text()
            if too_deep.get(tag):
                too_deep[tag] -= 1
            elif any(t == tag for t, _ in stack):
                while stack.pop()[0] != tag:
                    pass
                open_links = 0
            continue
        if tag == "a":
            open_links = 1
        if tag in RAW:
            stop = _CLOSE[tag].search(html, pos)
            pos = size if stop is None else html.find(">", stop.end()) + 1 or size
            continue
        if tag == "br":
            pieces.append(" ")
        if tag in INLINE or tag == "br":
            continue
        end_text()
        if tag == "hr":
            continue
        if stack[-1][0] == "p":
            stack.pop()
        if tag in CLOSES:
            ends, within = CLOSES[tag]
            ends = ends.split()
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in within:
                    break
                if stack[k][0] in ends:
                    del stack[k:]
                    break
        if len(stack) > DEPTH:
            too_deep[tag] = too_deep.get(tag, 0) + 1
            continue
        kids: list[Item] = []
        stack[-1][1].append([symbol(tag, found[3]), False, False, kids, None])
        stack.append((tag, kids))
    end_text()
    return root


# -------------------------------------------------------------------- wrappers


def skeleton(items: list[Item]) -> list[Item]:
    """The page as a wrapper of its own: slots without their texts, wide levels folded."""
    return shrink([[s, o, r, None if kids is None else skeleton(kids), slot and slot[:4]] for s, o, r, kids, slot in items])


def _members(item: Item) -> list[Item]:
    return item[3] if item[0] == GROUP else [item]


def _fits(a: Item, b: Item) -> bool:
    return a[0] == b[0] or a[0] == GROUP and any(_fits(m, b) for m in a[3]) or b[0] == GROUP and any(_fits(a, m) for m in b[3])


def _merge(a: Item, b: Item) -> Item:
    """One item for two of the same symbol; its text changes unless both say the same."""
    slot = None
    if a[4]:
        x, y = a[4], b[4]
        slot = [x[0] + y[0], x[1] + y[1], x[2] + y[2], x[3] if x[3] == y[3] else None]
    return [a[0], a[1] or b[1], a[2] or b[2], None if a[3] is None else align(a[3], b[3]), slot]


def _group(items: list[Item]) -> Item:
    """A repeated group: every symbol once, each of them optional."""
    kids: dict[str, Item] = {}
    for m in (m for item in items for m in _members(item)):
        kids[m[0]] = _merge(kids[m[0]], m) if m[0] in kids else m
        kids[m[0]][1] = True
    return [GROUP, False, True, list(kids.values()), None]


def _run(item: Item, seq: list[Item], at: int) -> tuple[Item, int]:
    """``item`` repeated over the items of ``seq`` from ``at`` on that continue it."""
    while at < len(seq) and _fits(item, seq[at]):
        if item[0] == GROUP or seq[at][0] == GROUP:
            item = _group([item, seq[at]])
        else:
            item = _merge(item, seq[at])
            item[2] = True
        at += 1
    return item, at


def _optional(items: list[Item]) -> list[Item]:
    for item in items:
        item[1] = True
    return items


def align(a: list[Item], b: list[Item]) -> list[Item]:
    """The wrapper of what both sides describe."""
    out: list[Item] = []
    i = j = 0
    while i < len(a) or j < len(b):
        if i < len(a) and j < len(b) and _fits(a[i], b[j]):
            if GROUP in (a[i][0], b[j][0]):
                item = _group([a[i], b[j]])
            else:
                item = _merge(a[i], b[j])
            i, j = i + 1, j + 1
            if item[2]:
                item, i = _run(item, a, i)
                item, j = _run(item, b, j)
            out.append(item)
            continue
        # a mismatch: the shorter stretch that one side lacks is optional ...
        skip_a = next((k for k in range(i + 1, min(len(a), i + REACH)) if _fits(a[k], b[j])), None) if j < len(b) else None
        skip_b = next((k for k in range(j + 1, min(len(b), j + REACH)) if _fits(a[i], b[k])), None) if i < len(a) else None
        if skip_a is not None and (skip_b is None or skip_a - i <= skip_b - j):
            out += _optional(a[i:skip_a])
            i = skip_a
            continue
        if skip_b is not None:
            out += _optional(b[j:skip_b])
            j = skip_b
            continue
        # ... else what comes next begins a stretch anew that is there already: a repeated group ...
        ahead = [s[k] for s, k in ((b, j), (a, i)) if k < len(s)]
        start = next((k for item in ahead for k in range(len(out) - 1, -1, -1) if _fits(out[k], item)), None)
        if start is not None:
            item = out[start] if start == len(out) - 1 else _group(out[start:])
            item, i = _run(item, a, i)
            item, j = _run(item, b, j)
            out[start:] = [item]
            continue
        # ... else both sides have something of their own
        if j < len(b):
            out += _optional([b[j]])
            j += 1
        if i < len(a):
            out += _optional([a[i]])
            i += 1
    return shrink(out)


def shrink(items: list[Item]) -> list[Item]:
    """A level of at most ``WIDTH`` items: equal neighbours, then all recurring symbols, then all of one tag are repeated."""
    if len(items) <= WIDTH:
        return items
    out: list[Item] = []
    at = 0
    while at < len(items):
        item, at = _run(items[at], items, at + 1)
        out.append(item)
    if len(out) <= WIDTH:
        return out
    group = _group(out)
    if len(group[3]) > WIDTH:
        for m in group[3]:
            m[0] = m[0].split(" ")[0]
        group = _group([group])
    return [group]


def wrapper_of(pages: Iterable[list[Item]]) -> list[Item]:
    done: list[Item] | None = None
    for page in pages:
        done = skeleton(page) if done is None else align(done, skeleton(page))
    return done or []


# ------------------------------------------------------------------ what to keep


@lru_cache(maxsize=100_000)
def _outside(sym: str, inside: bool) -> bool:
    """Whether an element holds no article text; ``inside`` an article a header is a part of it."""
    tag, *words = sym.split(" ")
    if tag in ("html", "body"):
        return False
    if tag in OUTSIDE and not (tag == "header" and inside):
        return True
    for word in words:
        parts = [p.lower() for p in _PARTS.findall(word)]
        if parts and parts[0] not in MODIFIERS and WORDS & {parts[0], parts[-1]}:
            if not (inside or tag in ("article", "main")) or not {parts[0], parts[-1]} & WORDS <= {"header"}:
                return True
    return False


def _mass(items: list[Item], tag: str, inside: bool) -> int:
    """Characters in the slots below elements of ``tag`` that are not boilerplate."""
    total = 0
    for sym, _, _, kids, slot in items:
        if slot:
            total += slot[1] if inside else 0
        elif sym == GROUP:
            total += _mass(kids, tag, inside)
        elif not _skipped(sym, inside):
            total += _mass(kids, tag, inside or sym.split(" ")[0] == tag)
    return total


def _skipped(sym: str, inside: bool) -> bool:
    """Like ``_outside``, but a form around the whole page hides nothing of it."""
    return _outside(sym, inside) and not (not inside and sym.split(" ")[0] == "form")


DROP, ARTICLE, MAYBE = 0, 1, 2


def plan(wrapper: list[Item], distinct: int) -> dict:
    """What a page's texts are, by the slot they fall into: the wrapper with marks in place of slots."""
    article, main = _mass(wrapper, "article", False), _mass(wrapper, "main", False)
    region = "article" if article and 2 * article >= main else "main"

    def marked(items: list[Item], inside: bool, form: bool) -> list:
        out = []
        for sym, _, _, kids, slot in items:
            if slot:
                texts, chars, links, same = slot
                own = distinct >= PAGES_ALIKE and same is not None and texts >= PAGES_ALIKE
                out.append([TEXT, ARTICLE if inside else DROP if form or own or links > LINKED * chars else MAYBE])
            elif sym == GROUP:
                out.append([GROUP, marked(kids, inside, form)])
            elif _skipped(sym, inside):
                out.append([sym, DROP])
            else:
                tag = sym.split(" ")[0]
                out.append([sym, marked(kids, inside or tag == region, form or tag == "form")])
        return out
    return {"region": region, "items": marked(wrapper, False, False)}


def _place(marks: list, at: int, sym: str) -> tuple[list | None, int]:
    """The mark that an item of this symbol falls to, searched from ``at`` on, then before."""
    for k in [*range(at, len(marks)), *range(min(at, len(marks)))]:
        mark = marks[k]
        if mark[0] == sym:
            return mark, k
        if mark[0] == GROUP:
            for m in mark[1]:
                if m[0] == sym:
                    return m, k
    return None, at


def main_text(html: str, known: dict) -> str:
    """The article's blocks, joined by empty lines."""
    region, kept = known["region"], {ARTICLE: [], MAYBE: []}

    def read(items: list[Item], marks: list | None, inside: bool, form: bool) -> None:
        at, before = 0, None
        for sym, _, _, kids, slot in items:
            mark = None
            if marks:
                # an equal neighbour falls to the next item of its symbol, or to the same where it repeats
                mark, place = _place(marks, at + 1 if before == sym else at, sym)
                if mark is not None and place >= at:
                    at = place
                before = sym
            if slot:
                as_read = ARTICLE if inside else DROP if form or slot[2] > LINKED * slot[1] else MAYBE
                as_marked = mark[1] if mark is not None else as_read
                kept.get(ARTICLE if inside else as_marked, []).append(slot[4])
            elif not _skipped(sym, inside):
                tag = sym.split(" ")[0]
                below = mark[1] if mark is not None and isinstance(mark[1], list) else None
                read(kids, below, inside or tag == region, form or tag == "form")
    read(page_items(html), known["items"], False, False)
    return "\n\n".join(kept[ARTICLE] or kept[MAYBE])


# ----------------------------------------------------------------------- spark


def _dump(wrapper: list[Item]) -> str:
    return json.dumps(wrapper, separators=(",", ":"), ensure_ascii=False)


def _seen(a: list[int], b: list[int]) -> list[int]:
    """Up to as many checksums of different pages as matter."""
    return sorted({*a, *b})[:PAGES_ALIKE]


_SCHEMA = "host string, piece int, wrapper string, seen array<bigint>, pages bigint"


def _emit(held: dict[str, list], piece: int) -> pa.RecordBatch:
    hosts = sorted(held)
    return pa.RecordBatch.from_arrays(
        [pa.array(hosts, pa.string()), pa.array([piece] * len(hosts), pa.int32()),
         pa.array([_dump(held[h][0]) for h in hosts], pa.string()),
         pa.array([held[h][1] for h in hosts], pa.list_(pa.int64())), pa.array([held[h][2] for h in hosts], pa.int64())],
        names=["host", "piece", "wrapper", "seen", "pages"])


def _inferred(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Wrappers of the hosts of one task's pages; ``piece`` counts how often the task handed them on."""
    held: dict[str, list] = {}
    piece = 0
    for batch in batches:
        for host, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            if not html:
                continue
            page, check = skeleton(page_items(html)), [crc32(html.encode())]
            if host in held:
                old, seen, n = held[host]
                held[host] = [align(old, page), _seen(seen, check), n + 1]
            else:
                held[host] = [page, check, 1]
        if len(held) > HELD:
            yield _emit(held, piece)
            held, piece = {}, piece + 1
    if held:
        yield _emit(held, piece)


def _merged(final: bool):
    """Rows sorted by host: the wrappers of one host become one, at the end its plan."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(host: str, wrapper: list[Item], seen: list[int], n: int) -> pa.RecordBatch:
            if not final:
                return _emit({host: [wrapper, seen, n]}, 0)
            return pa.RecordBatch.from_arrays(
                [pa.array([host], pa.string()), pa.array([_dump(plan(wrapper, len(seen)))], pa.string()),
                 pa.array([n], pa.int64())], names=["host", "plan", "pages"])
        key = now = None
        for batch in batches:
            for row in batch.to_pylist():
                this = (row["host"], row.get("bucket"))
                wrapper = json.loads(row["wrapper"])
                if this == key:
                    now = [align(now[0], wrapper), _seen(now[1], row["seen"]), now[2] + row["pages"]]
                    continue
                if now:
                    yield out(key[0], *now)
                key, now = this, [wrapper, row["seen"], row["pages"]]
        if now:
            yield out(key[0], *now)
    return run


def plans(pages: DataFrame) -> DataFrame:
    """(host, plan, pages) of every host with a page that is not empty; ``pages`` has host and html."""
    parts = pages.mapInArrow(_inferred, _SCHEMA).withColumn("bucket", F.pmod(F.spark_partition_id(), F.lit(BUCKETS)))
    some = cut_lineage(parts.repartition("host", "bucket").sortWithinPartitions(
        "host", "bucket", "wrapper").mapInArrow(_merged(False), _SCHEMA))
    return cut_lineage(some.drop("piece").repartition("host").sortWithinPartitions("host", "wrapper").mapInArrow(
        _merged(True), "host string, plan string, pages bigint"))


@lru_cache(maxsize=256)
def _known(text: str) -> dict:
    return json.loads(text)


@F.arrow_udf(StringType())
def _extracted(html: pa.Array, known: pa.Array) -> pa.Array:
    """Main text of each page along its host's plan, empty where either is missing."""
    return pa.array([main_text(h, _known(k)) if h and k else ""
                     for h, k in zip(html.to_pylist(), known.to_pylist())], pa.string())


def extracted(pages: DataFrame, url: str = "url", html: str = "html", name: str = "text") -> DataFrame:
    """``pages`` with the main text of each page in ``name``.

    Pages are grouped by the host of ``url``; those without one, NULL ones too,
    are a group as well. NULL and empty html has an empty text. Repeated rows
    get equal texts. Texts and pages may be of any length; elements nested more
    than ``DEPTH`` deep belong to the element at that depth. An empty table
    stays empty; a column called ``name`` is replaced, others are kept.
    """
    host, mark, n = (spare(c, pages.columns) for c in ("_host", "_plan", "_pages"))
    keyed = whole_texts(pages).withColumn(host, host_of(url))
    found = plans(keyed.select(F.col(host).alias("host"), F.col(html).alias("html")))
    size = found.agg(F.sum(F.length("plan"))).first()[0] or 0
    known = found.select(F.col("host").alias(host), F.col("plan").alias(mark), F.col("pages").alias(n))
    joined = attach(keyed, known, host, weight=n, hot_keys=64, **({} if size <= PLAN_BYTES else {"max_rows": 0}))
    return joined.withColumn(name, _extracted(html, mark)).drop(host, mark, n)
