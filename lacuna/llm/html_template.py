"""HTML extraction: templates deduced from equivalence classes of page tokens.

A page is a sequence of tokens: opening tags, told apart by the path of tags above them,
and text nodes with their path, told apart by how often they stood before.  Over the pages
of a host each token has an occurrence vector, the pages it is on; tokens with the same
vector form an equivalence class.  Those on all pages are the root class.

A class is valid if its tokens stand in one order on all its pages and each nests in one
slot of the root class; tokens that break this leave it.  Valid tokens on at least half
of the pages, near copies of a page counted as one, are the template.  What stands between
template tokens are slots, and the article is what fills them.

The vector is kept as a sum of hashes of its pages, so classes come out of one aggregation
that is folded before its shuffle, however many pages a host has; so does their test.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lacuna.llm.common import staged
from lacuna.llm.url_filter import host_of

#: A host with fewer pages has no template of its own, but that of all pages; a token on fewer
#: is in no template.
LEAST_PAGES = 4
#: A class is part of the template if its tokens are on this share of the pages.
SUPPORT = 0.5
#: A page is a copy if so much of its text, and so many of its blocks, are the root class, or if
#: so much of the rest is on most pages.
SAME, COPIED = 0.9, 0.5
#: Templates up to this many tokens in total are broadcast, more are joined.
BROADCAST_TOKENS = 4 << 20

# What HTML says about its elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes noscript xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p "
    "pre search section summary table tbody td tfoot th thead tr ul".split()
)
CLOSED_BY = {"li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option"}
# Elements and classes, ids or roles that are never part of an article.  A form may be around
# a whole page, and so may any element of such a class: an article inside counts.
ASIDE = frozenset("nav header footer aside form head script style template svg button select dialog menu".split())
ASIDE_WORDS = frozenset(
    "ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments consent "
    "cookie cookies copyright disqus footer header masthead menu modal nav navbar navigation newsletter notice "
    "pagination popup promo promoted related replies reply respond share sharing sidebar social sponsor "
    "sponsored subscribe toolbar".split()
)

_TAG = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"""|<([a-zA-Z][^\s/>]*)((?:=\s*"[^"]*+(?:"|\Z)|=\s*'[^']*+(?:'|\Z)|[^>=]++|=)*+)(?:>|\Z)""",
    re.S,
)
_NAMES = re.compile(r"""(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_WORDS = re.compile(r"[a-z0-9]+")
_KEPT_ROLES = frozenset({"main", "article"})
_NO, _BY_WORD, _BY_ELEMENT = range(3)


@dataclass(slots=True)
class Node:
    """A block of text: where it stands, and whether that can be an article.

    ``aside``: not (0), by a word of an element above (1), by the element itself (2).
    """

    path: str
    text: str
    aside: int
    article: bool


def parse(page: str) -> list[str | Node]:
    """The paths of the opened elements and the text blocks, in page order.

    Broken markup is read as browsers do, roughly: a block closes an open paragraph,
    an end tag closes what is open inside its element, and one without is ignored.
    """
    items: list[str | Node] = []
    stack: list[tuple[str, str, int, bool]] = [("", "", _NO, False)]
    depth: Counter = Counter()
    held: list[str] = []

    def flush() -> None:
        text = " ".join("".join(held).split())
        held.clear()
        if text:
            _, path, aside, article = stack[-1]
            items.append(Node(path, text, aside, article))

    def close(name: str) -> None:
        if depth[name]:
            while True:
                gone = stack.pop()[0]
                depth[gone] -= 1
                if gone == name:
                    break

    at, end = 0, len(page)
    while at < end:
        found = _TAG.search(page, at)
        if not found:
            held.append(html.unescape(page[at:]))
            break
        if found.start() > at:
            held.append(html.unescape(page[at : found.start()]))
        at = found.end()
        if found[1]:
            name = found[1].lower()
            if name in BLOCK:
                flush()
            close(name)
            continue
        if not found[2]:
            continue
        name, attributes = found[2].lower(), found[3]
        if name in BLOCK:
            flush()
            if depth["p"]:
                close("p")
            for other in CLOSED_BY.get(name, "").split():
                if stack[-1][0] == other:
                    close(other)
        elif name == "br":
            held.append(" ")
        if name in VOID:
            continue
        if name in RAW:
            closing = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)", re.I).search(page, at)
            at = closing.start() if closing else end
            if closing:
                at = page.find(">", at) + 1 or end
            continue
        if name not in BLOCK and name not in ASIDE:
            continue  # inline markup does not matter
        _, path, aside, article = stack[-1]
        label, outer = name, article
        if attributes and (named := _NAMES.findall(attributes)):
            words = _WORDS.findall(" ".join(named).lower())
            label = f"{name}.{'.'.join(words)}"
            whole = " ".join(x.strip("\"'") for x in named).lower().split()
            if name not in ("body", "html") and not ASIDE_WORDS.isdisjoint(whole):
                aside = max(aside, _BY_WORD)
            article = article or not _KEPT_ROLES.isdisjoint(words)
            begins = not _KEPT_ROLES.isdisjoint(whole)
        else:
            begins = False
        if (begins or name in ("article", "main")) and not outer and aside == _BY_WORD:
            aside = _NO
        path = f"{path}/{label}" if len(path) < 1000 else path
        if name in ASIDE:
            aside = max(aside, _BY_WORD if name == "form" else _BY_ELEMENT)
        stack.append((name, path, aside, article or name in ("article", "main")))
        depth[name] += 1
        items.append(path)
    flush()
    return items


def _token(path: str, text: str | None = None) -> int:
    return xxhash.xxh64_intdigest(path if text is None else f"{path}\0{text}") >> 1


def page_tokens(items: list[str | Node]) -> list[int]:
    """The token of each item; a text block that stood before is another token each time."""
    seen: Counter = Counter()
    out = []
    for item in items:
        if isinstance(item, str):
            out.append(_token(item))
            continue
        token = _token(item.path, item.text)
        seen[token] += 1
        out.append(token if seen[token] == 1 else _token(item.path, f"{item.text}\0{seen[token]}"))
    return out


_FACTS = "host string, token bigint, pages bigint, total bigint, one bigint, two bigint, place bigint"
_PAGE = -1  # stands for the page itself
_EVERY = "/all"  # stands for a host that has all pages; no host holds a slash


def _rows(known: dict, kinds: str) -> pa.RecordBatch:
    """A batch of the keys and values of a dict, for a schema with a leading host."""
    names = [x.split()[0] for x in kinds.split(", ")]
    columns = list(zip(*((*k, *v) for k, v in known.items()), strict=True)) or [()] * len(names)
    types = [pa.string(), *[pa.int64()] * (len(names) - 1)]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def _facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per host and token: pages it is on, how often in all, two sums of hashes of its pages, sum of places."""
    known: dict = {}
    for batch in batches:
        for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
            key = xxhash.xxh64_intdigest(page or "")
            of_page: dict[int, list[int]] = {_PAGE: [1, 0]}
            for place, token in enumerate(page_tokens(parse(page or ""))):
                of_page.setdefault(token, [0, place])[0] += 1
            for token, (count, place) in of_page.items():
                # 40 bits each, so that sums of longs stay in range.
                mixed = (key ^ (count * 0x9E3779B97F4A7C15)) & 0xFFFFFFFFFFFFFFFF
                mixed = mixed * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF
                entry = known.setdefault((host, token), [0, 0, 0, 0, 0])
                entry[0] += 1
                entry[1] += count
                entry[2] += mixed >> 24
                entry[3] += mixed & 0xFFFFFFFFFF
                entry[4] += place
        if len(known) > 200_000:
            yield _rows(known, _FACTS)
            known = {}
    if known:
        yield _rows(known, _FACTS)


def _with_host(rows: DataFrame, found: DataFrame, most: int) -> tuple[DataFrame, Callable]:
    """``rows`` and a function from a batch of them to (tokens of the host, of all pages) of each
    row, None if there are none.  ``found``: ``host, tokens``, broadcast up to ``most`` tokens, else joined."""
    size = found.agg(F.sum(F.size("tokens") + 1)).first()[0] or 0
    small = size <= most
    known = {r.host: np.array(r.tokens, np.int64) for r in (found if small else found.filter(F.col("host") == _EVERY)).collect()}
    shared = rows.sparkSession.sparkContext.broadcast(known)

    def lookup(batch: pa.RecordBatch) -> Iterator[tuple]:
        every = shared.value.get(_EVERY)
        own = map(shared.value.get, batch.column("host").to_pylist()) if small else batch.column("tokens").to_pylist()
        return ((tokens, every) for tokens in own)

    return (rows if small else rows.join(found.filter(F.col("host") != _EVERY), "host", "left")), lookup


def main_blocks(items: list[str | Node]) -> list[int]:
    """The places of blocks that can be an article: those in marked articles if there are such.
    If words leave no block, they are not heeded."""
    blocks = [k for k, n in enumerate(items) if isinstance(n, Node) and n.aside < _BY_ELEMENT]
    usable = [k for k in blocks if not items[k].aside] or blocks
    return [k for k in usable if items[k].article] or usable


_TESTS = "host string, token bigint, alike bigint, pages bigint, first_slot bigint, last_slot bigint, broken bigint"
_ALONE, _SAME = -1, -2  # a page like no other; pages that have hardly more than the root class


def _tested(batches: Iterator[pa.RecordBatch], lookup: Callable) -> Iterator[pa.RecordBatch]:
    """Per host, candidate token and group of like pages: pages, least and greatest slot of the
    root class it stands in, pages on which it is out of its class's order."""
    known: dict = {}
    ranks: dict[str, dict[int, tuple[int, int]]] = {}

    def test(host: str, rank: dict[int, tuple[int, int]], items: list[str | Node], tokens: list[int], main: list[int]) -> None:
        classes: dict[int, list[int]] = {}  # 0 is the root class
        for place, token in enumerate(tokens):
            if token in rank:
                classes.setdefault(rank[token][0], []).append(place)
        right = set()
        for places in classes.values():
            fits = _in_order([tokens[p] for p in places], {tokens[p]: rank[tokens[p]][1] for p in places})
            right.update(places[k] for k in fits)
        # Text and blocks by class; None has what is on few pages.
        chars: Counter = Counter()
        blocks: Counter = Counter()
        for place in main:
            part = rank.get(tokens[place], (None,))[0]
            chars[part] += len(items[place].text)
            blocks[part] += 1
        both = (chars, blocks)
        alike = _ALONE
        if main and all(c[0] >= SAME * c.total() for c in both):
            alike = _SAME
        elif all(c.total() - c[0] - c[None] > COPIED * (c.total() - c[0]) for c in both):
            alike = max((n, part) for part, n in chars.items() if part)[1]
        found, slot = [(_PAGE, 0, True)], 0
        for place, token in enumerate(tokens):
            if token not in rank:
                continue
            part, k = rank[token]
            found.append((token, slot if part else 0, place in right))  # the root class is in no slot
            if not part and place in right:
                slot = k + 1
        for token, at, fits in found:
            entry = known.setdefault((host, token, alike), [0, at, at, 0])
            entry[0] += 1
            entry[1], entry[2] = min(entry[1], at), max(entry[2], at)
            entry[3] += not fits

    for batch in batches:
        for host, page, (own, every) in zip(
            batch.column("host").to_pylist(), batch.column("html").to_pylist(), lookup(batch), strict=True
        ):
            items = parse(page or "")
            tokens, main = page_tokens(items), main_blocks(items)
            for name, candidates in ((host, own), (_EVERY, every)):
                if candidates is None:
                    continue
                if name not in ranks:
                    if len(ranks) > 100:
                        ranks.clear()
                    numbers = np.asarray(candidates).tolist()
                    pairs = zip(numbers[1::2], numbers[::2], strict=True)
                    ranks[name] = {token: (part, k) for k, (token, part) in enumerate(pairs)}
                test(name, ranks[name], items, tokens, main)
        if len(known) > 200_000:
            yield _rows(known, _TESTS)
            known = {}
    if known:
        yield _rows(known, _TESTS)


def _least() -> Column:
    """On so many of a host's ``of`` pages a token must be: few that share a sentence are no template."""
    return F.greatest(F.lit(SUPPORT) * F.col("of"), F.lit(float(LEAST_PAGES)))


def templates(pages: DataFrame, broadcast_tokens: int = BROADCAST_TOKENS) -> DataFrame:
    """``host, tokens``: the template tokens of a host; the host ``/all`` has those of all pages.

    ``pages``: ``host, html``.  A host's template has at most pages / SUPPORT tokens for each
    token of a mean page, so the arrays are as long as two pages at most.
    """
    sums = [F.sum(c).alias(c) for c in ("pages", "total", "one", "two", "place")]
    facts = staged(pages.mapInArrow(_facts, _FACTS).groupBy("host", "token").agg(*sums), "html-facts")
    both = facts.union(facts.groupBy("token").agg(*sums).select(F.lit(_EVERY).alias("host"), "token", *[c for c in facts.columns[2:]]))
    totals = both.filter(F.col("token") == _PAGE).select("host", F.col("pages").alias("of"))
    frequent = (
        # Tokens of a single page are most: they go before rows meet by host.
        both.filter((F.col("token") != _PAGE) & (F.col("pages") > 1) & (F.col("total") == F.col("pages")))
        .join(totals.filter((F.col("of") >= LEAST_PAGES) | (F.col("host") == _EVERY)), "host")
        .filter(F.col("pages") >= _least())
    )
    # The number of a class is a hash of its vector; its tokens are in order of their mean place.
    part = F.when(F.col("pages") == F.col("of"), F.lit(0)).otherwise(F.xxhash64("pages", "one", "two").bitwiseAND((1 << 62) - 1) + 1)
    member = F.struct((F.col("place") / F.col("pages")).alias("at"), "token", part.cast("bigint").alias("part"))
    candidates = frequent.groupBy("host").agg(F.sort_array(F.collect_list(member)).alias("members"))
    pairs = F.flatten(F.transform("members", lambda m: F.array(m["part"], m["token"])))
    candidates = candidates.select("host", pairs.alias("tokens"))
    candidates = staged(candidates, "html-candidates")
    joined, lookup = _with_host(pages, candidates, broadcast_tokens)
    slots = [F.min("first_slot").alias("first_slot"), F.max("last_slot").alias("last_slot"), F.sum("broken").alias("broken")]
    groups = F.sum(F.when(F.col("alike") == _ALONE, F.col("pages")).otherwise(F.lit(1))).alias("groups")
    tests = joined.mapInArrow(lambda batches: _tested(batches, lookup), _TESTS)
    tests = tests.groupBy("host", "token", "alike").agg(F.sum("pages").alias("pages"), *slots)
    tests = tests.groupBy("host", "token").agg(groups, *slots)
    tests = staged(tests, "html-tests")
    # Of a host with too few that are no copies, as of a small one, nothing can be told.
    of = tests.filter((F.col("token") == _PAGE) & ((F.col("groups") >= LEAST_PAGES) | (F.col("host") == _EVERY)))
    of = of.select("host", F.col("groups").alias("of"))
    one_slot = F.col("first_slot") == F.col("last_slot")
    valid = (
        tests.filter((F.col("token") != _PAGE) & (F.col("broken") == 0) & one_slot & (F.col("groups") > 1))
        .join(of, "host")
        .filter(F.col("groups") >= _least())
    )
    # Every host has the page itself, so that one without a valid token keeps its own, empty template.
    every = valid.select("host", "token").union(of.select("host", F.lit(_PAGE).cast("bigint")))
    return staged(every.groupBy("host").agg(F.collect_list("token").alias("tokens")), "html-templates")


def _in_order(tokens: list[int], rank: dict[int, int]) -> set[int]:
    """The places in a page at which template tokens stand in template order: a longest
    rising sequence of their ranks, equal ones (repeated elements) allowed."""
    tails, ends, back = [], [], {}
    for place, token in enumerate(tokens):
        if (r := rank.get(token)) is None:
            continue
        k = bisect_right(tails, r)
        back[place] = ends[k - 1] if k else None
        if k == len(tails):
            tails.append(r)
            ends.append(place)
        else:
            tails[k], ends[k] = r, place
    out, at = set(), ends[-1] if ends else None
    while at is not None:
        out.add(at)
        at = back[at]
    return out


def main_text(page: str, template: list[int] | None = None) -> str:
    """The article of a page: its blocks, joined by blank lines.

    Blocks in navigation, adverts and the like are left out, and so are the template's.  What
    is left are the slots; where the page marks an article, only those in it.  If a page has
    nothing but its template, that is the text.
    """
    items = parse(page)
    main = main_blocks(items)
    fixed = frozenset() if template is None else frozenset(np.asarray(template).tolist())
    tokens = page_tokens(items) if fixed else ()
    chosen = [k for k in main if not fixed or tokens[k] not in fixed]
    return "\n\n".join(items[k].text for k in chosen or main)


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html", broadcast_tokens: int = BROADCAST_TOKENS) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages``.

    A null page or one without text gives an empty text; pages of a null URL or one without
    a host share the host ''.  Repeated rows are several pages of their host.  Whole pages
    of any length are read; templates are broadcast if their checked size allows, else joined.
    """
    rows = pages.select(
        F.col(f"`{page_id}`").alias("page_id"),
        F.col(f"`{url}`").alias("url"),
        host_of(F.col(f"`{url}`")).alias("host"),
        F.col(f"`{page}`").cast("string").alias("html"),
    )
    found = templates(rows.select("host", "html"), broadcast_tokens)
    joined, lookup = _with_host(rows, found, broadcast_tokens)

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [
                main_text(p, general if own is None else own) if p else ""
                for p, (own, general) in zip(batch.column("html").to_pylist(), lookup(batch), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(out, pa.string()), pa.array(map(len, out), pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    kinds = {name: joined.schema[name].dataType.simpleString() for name in ("page_id", "url")}
    return joined.mapInArrow(texts, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars bigint")
