"""HTML extraction by wrappers: union-free regular expressions inferred per host.

A page is a stream of tags and texts. The streams of a host are aligned one after
the other into a wrapper: where both have the same tag, they go on inside it; a
tag that comes again makes a repeated group, one that only some pages have an
optional group, and texts become slots, which keep a hash of the text as long as
all pages agree on it. A wrapper has as many parts as a host has different tag
paths, however many pages are aligned; where a page has too many names for them,
unmarked parts are told apart by their tags alone.

Every task folds its pages into one wrapper per host; partial wrappers are merged
per (host, salt), then per host, so a host with a third of all pages is never
gathered. Slots are judged on the finished wrapper: text that all pages have in
common is the template's; parts that are tagged or wholly named as menus, headers, footers, sidebars, notices, adverts, forms, scripts,
styles or comments go, but an article or main element goes only if it lies in another
main part and all its names are such marks; on pages with an article or main part all else goes, on
others parts that are mostly links over all pages of the host go. Pages are then
read again with the judged wrapper. Wrappers are sent to all tasks only if their
total size allows, else joined by host.

A null html gives an empty text, also for pages without a host (null or odd urls
share the host ""). Character references are decoded; white space inside a block
becomes one space; blocks are joined by one space. Unclosed and stray tags are
accepted. Repeated rows are pages of their own; extra columns are ignored.
"""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillspark.operators.lookup import lookup
from tillspark.sources.staging import stage

SALTS = 64
#: Pages a text must be the same on to be the template's.
LEAST_PAGES = 5
VARIES = "varies"
MOST_PARTS = 256
SENT_BYTES = 32 << 20
LINK_SHARE = 0.5
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"
# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rt "
    "s samp small span strike strong sub sup time tt u var wbr".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 "
    "h6 header hr main menu nav ol p pre section table ul".split()
)
SAME_CLOSE = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
              "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
# Parts that are not the article.
APART = frozenset(
    "head title script style noscript template iframe object svg canvas nav menu footer aside form "
    "button select textarea input dialog audio video".split()
)
# Names of such parts, and of the boxes around them. A class, id or role is a mark if it is made
# of these alone, with a name of a part among them: 'site-footer' is one, 'entry-header' is not.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertisements advertising aside banner banners breadcrumb "
    "breadcrumbs comment commentlist comments complementary consent contentinfo cookie cookies "
    "copyright disclaimer discussion disqus footer footers header hidden login masthead menu menus "
    "modal modals nav navbar navigation newsletter notice notices notification notifications "
    "overlay overlays pager pagination popup popups promo promos promotion promotions "
    "recommendations recommended related replies reply search share sharing side sidebar sidebars "
    "signup skip social sponsor sponsored sponsors subscribe subscription toolbar topbar widget "
    "widgets".split()
)
BOXES = frozenset(
    "area bar bottom box buttons column container form global group inner item items left links "
    "list main mobile outer panel placeholder primary region right row secondary section site slot "
    "thread top unit wrap wrapper zone".split()
)
MAIN = frozenset(("article", "main"))
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|textarea|title|noscript|template|iframe)\b"
    r"(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[!?/][^>]*>|[^<]+|<",
    re.DOTALL | re.IGNORECASE,
)
NAMES = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.IGNORECASE)


class Node:
    """An element of a page: children are elements, texts, and `None` for a line break."""

    __slots__ = ("kids", "sign", "tag")

    def __init__(self, tag: str, sign: str):
        self.tag, self.sign, self.kids = tag, sign, []


def parsed(page: str) -> Node:
    root = Node("", "")
    path = [root]
    for token in TOKEN.finditer(page):
        raw, closing, name, attributes = token[1], token[2], token[3], token[4]
        if raw or (name is None and token[0].startswith("<") and len(token[0]) > 1):
            continue
        if name is None:
            path[-1].kids.append(token[0])
            continue
        name = name.lower()
        if name == "br" or name in VOID:
            path[-1].kids.append(None if name in ("br", "hr") else "")
        elif closing:
            at = next((k for k in range(len(path) - 1, 0, -1) if path[k].tag == name), 0)
            if at and not (name in INLINE and any(x.tag not in INLINE for x in path[at:])):
                del path[at:]
        else:
            closes = {"p"} if name in CLOSES_P else SAME_CLOSE.get(name, ())
            while closes and len(path) > 1:
                at = next((k for k in range(len(path) - 1, 0, -1) if path[k].tag not in INLINE), 0)
                if not at or path[at].tag not in closes:
                    break
                del path[at:]
            node = Node(name, signature(name, attributes))
            path[-1].kids.append(node)
            path.append(node)
    return root


def signature(tag: str, attributes: str) -> str:
    """Tag with its class, id and role; digits are taken out, as they number pages and parts."""
    if tag in INLINE or not attributes:
        return tag
    found = {k.lower(): v.strip("\"' ") for k, v in NAMES.findall(attributes)}
    marks = " ".join(found[k] for k in ("class", "id", "role") if k in found)
    return f"{tag} {re.sub(r'[0-9]+', '', marks).lower()}".strip()


def folded(node: Node, linked: bool = False) -> list:
    """The wrapper of one page: [signature, optional, repeated, pages, text, link text, parts,
    slot], the slot being the text's hash."""
    part = _part(node, linked)
    part[7] = _slot(part[7])
    return part


def _part(node: Node, linked: bool) -> list:
    """`folded`, with the text itself in the place of the slot."""
    part = [node.sign, 0, 0, 1, 0, 0, [], ""]
    said = []
    for kid in node.kids:
        if isinstance(kid, Node):
            if kid.tag in INLINE:
                below = _part(kid, linked or kid.tag == "a")
                part[4] += below[4]
                part[5] += below[5]
                said.append(below[7])
                _aligned(part[6], below[6], True)
            else:
                _aligned(part[6], [folded(kid, linked)], True)
        elif kid:
            size = len(kid.strip())
            part[4] += size
            part[5] += size if linked else 0
            said.append(kid)
    part[7] = "".join(said)
    return part


def _slot(text: str) -> str | None:
    """A hash of a text without its outer and repeated white space; None for no text."""
    plain = " ".join(text.split())
    return xxhash.xxh64_hexdigest(plain.encode()) if plain else None


def _aligned(parts: list, more: list, same_page: bool) -> None:
    """Align `more` with `parts` in place."""
    at = 0 if not same_page else len(parts)
    for part in more:
        match = next((k for k in range(at, len(parts)) if parts[k][0] == part[0]), None)
        if match is not None:
            for skipped in parts[at:match]:
                skipped[1] = 1
            at = match + 1
        else:
            match = next((k for k in range(at) if parts[k][0] == part[0]), None)
            if match is None:
                part[1] = part[1] if same_page else 1
                parts.insert(at, part)
                at += 1
                continue
            parts[match][2] = 1
        _merged(parts[match], part, same_page)
    if not same_page:
        for skipped in parts[at:]:
            skipped[1] = 1
    if len(parts) > MOST_PARTS:
        _gathered(parts)


def _gathered(parts: list) -> None:
    """Parts of too many names, as one per page, become one part a tag, in place.

    Marked and main parts keep their names; so the size of a wrapper does not grow with the
    pages of its host. Pages read such a part by its tag.
    """
    kept: dict[str, list] = {}
    for part in parts:
        sign = part[0] if _kind(part[0]) else part[0].partition(" ")[0]
        if sign in kept:
            _merged(kept[sign], part)
            kept[sign][2] = 1
        else:
            part[0] = sign
            kept[sign] = part
    parts[:] = kept.values()


def _merged(one: list, other: list, same_page: bool = False) -> list:
    one[1] |= other[1]
    one[2] |= other[2]
    one[3] += 0 if same_page else other[3]
    one[4] += other[4]
    one[5] += other[5]
    if one[7] is None or other[7] is None:
        one[7] = one[7] or other[7]
    elif one[7] != other[7]:
        one[7] = VARIES
    _aligned(one[6], other[6], False)
    return one


def judged(wrapper: list) -> list:
    """Which slots are the article: nested [taken, {signature: parts}], first for pages with a
    main part, if the host has any, last for other pages.

    A slot whose text is the same on all the pages that have it, at least half of the host's and
    `LEAST_PAGES`, is text of the template, not of an article, provided that other slots of the
    article vary: pages that are all alike have no template to tell.
    """

    def walk(part: list, inside: bool, has_main: bool, met: list) -> list:
        kind = _kind(part[0])
        if inside and _named_apart(part[0]):
            kind = "apart"
        if kind == "apart" or (kind == "header" and not inside):
            return [False, {}]
        inside = inside or kind == "main"
        links = part[5] > LINK_SHARE * part[4]
        taken = inside if has_main else not links
        out = [taken, {p[0]: walk(p, inside, has_main, met) for p in part[6]}]
        if taken and part[7] is not None:
            met.append((part, out))
        return out

    main = _holds(wrapper, lambda p: _kind(p[0]) == "main")
    verdicts = []
    for has_main in [True, False] if main else [False]:
        met: list = []
        verdicts.append(walk(wrapper, False, has_main, met))
        if any(part[7] == VARIES for part, _ in met):
            for part, out in met:
                often = part[3] >= LEAST_PAGES and 2 * part[3] >= wrapper[3]
                out[0] = part[7] == VARIES or not often
    return verdicts


def _holds(part: list, test) -> bool:
    return test(part) or (
        _kind(part[0]) != "apart" and any(_holds(below, test) for below in part[6])
    )


def _kind(sign: str) -> str:
    tag, _, marks = sign.partition(" ")
    if tag in APART:
        return "apart"
    if tag in MAIN:
        return "main"
    names = marks.split()
    if tag not in ("html", "body") and any(_marked(name) for name in names):
        return "apart"
    if "main" in names:
        return "main"
    return "header" if tag == "header" else ""


def _marked(name: str) -> bool:
    parts = [part for part in re.split("[-_]+", name.lower()) if part]
    return any(p in MARKS for p in parts) and all(p in MARKS or p in BOXES for p in parts)


def _named_apart(sign: str) -> bool:
    """Whether no class, id or role of an element says it is anything but a marked part."""
    names = sign.split(" ")[1:]
    return bool(names) and all(_marked(name) for name in names)


def extracted(page: str, verdicts: list) -> str:
    """The text of a page by the first of `verdicts` that takes any part of it."""
    root = parsed(page)
    blocks: list[list[str]] = []

    def walk(node: Node, taken: bool, parts: dict) -> bool:
        met = taken
        for kid in node.kids:
            if kid is None:
                blocks.append([])
            elif isinstance(kid, str):
                if taken:
                    blocks[-1].append(kid)
            elif kid.tag in INLINE:
                met |= walk(kid, taken, parts)
            else:
                blocks.append([])
                met |= walk(kid, *(parts.get(kid.sign) or parts.get(kid.tag) or (False, {})))
                blocks.append([])
        return met

    for verdict in verdicts:
        blocks[:] = [[]]
        if walk(root, *verdict):
            break
    texts = (" ".join(html.unescape("".join(block)).split()) for block in blocks)
    return " ".join(text for text in texts if text)


def _host(pages: DataFrame) -> DataFrame:
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), HOST, 1))
    return pages.select("page_id", "url", "html", host.alias("host"))


def infer(pages: DataFrame, salts: int = SALTS) -> DataFrame:
    """(host, wrapper) of every host, the wrapper as JSON."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[str, list] = {}
            for host, page in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                part = folded(parsed(page or ""))
                found[host] = _merged(found[host], part) if host in found else part
            yield pa.RecordBatch.from_pydict(
                {"host": list(found), "wrapper": [json.dumps(w) for w in found.values()]}
            )

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        whole, *others = sorted(rows["wrapper"])
        merged = json.loads(whole)
        for other in others:
            _merged(merged, json.loads(other))
        return pd.DataFrame({"host": rows["host"].iloc[:1], "wrapper": [json.dumps(merged)]})

    schema = "host string, wrapper string"
    partial = _host(pages).select("host", "html").mapInArrow(fold, schema)
    salted = partial.withColumn("salt", F.pmod(F.xxhash64("wrapper"), F.lit(salts)))
    salted = salted.groupBy("host", "salt").applyInPandas(merge, schema)
    return salted.groupBy("host").applyInPandas(merge, schema)


def extract(pages: DataFrame, sent_bytes: int = SENT_BYTES) -> DataFrame:
    """page_id, url, text of every page."""
    wrappers = stage(infer(pages), "html-wrappers")
    size = wrappers.agg(F.sum(F.length("wrapper"))).first()[0] or 0
    rows = _host(pages)
    if size <= sent_bytes:
        rows = rows.join(F.broadcast(wrappers), "host", "left")
    else:  # hosts with very many pages are split
        rows = lookup(rows, wrappers, "host", ["page_id", "url"], 0, measured_on=rows.select("host"))
    rows = rows.select("page_id", "url", "html", "host", "wrapper")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        verdicts: dict[str, list] = {}
        for batch in batches:
            texts = []
            for page, host, wrapper in zip(*(c.to_pylist() for c in batch.columns[2:]), strict=True):
                if host not in verdicts:
                    verdicts[host] = judged(json.loads(wrapper))
                texts.append(extracted(page or "", verdicts[host]))
            columns = [*batch.columns[:2], pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text"])

    return rows.mapInArrow(read, "page_id long, url string, text string")
