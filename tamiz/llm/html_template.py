"""HTML extraction by template deduction.

Pages of a host are seen as sequences of tokens: elements in their roles (the chain of tags, names and first children that
leads there) and the blocks of text they hold. Tokens with the same occurrence vector over the host's pages (how often
each page has them) form an equivalence class. Classes that are frequent and have several members are valid; ordered by
position and nested along their elements they are the host's template. What the template does not fix are slots.

The slots' contents decide what is the main text: the element that holds most text of the pages' own, over all pages
of the host, and what is under it. Fixed texts and slots of links there are left out. Markup is looked at afterwards:
what it declares to be a menu, notice, advert, form, comment or the like goes, and a chosen element
inside an article stands for the whole article.
"""

from __future__ import annotations

import bisect
import html as references
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
import xxhash
from pyspark.sql import DataFrame

from tamiz.llm.common import small_batches, stored

#: A class is frequent on this share of a host's pages, two at least; it has so many members.
SHARE = 0.9
LEAST_MEMBERS = 2
#: A slot is a menu if this share of its characters are links, over all pages of the host.
LINK_SHARE = 0.6
#: Slots and elements on a smaller share of a host's pages, or on one page only, are judged by that page itself.
RARE = 0.001
#: What a fixed character counts beside one of a page's own when the main element is looked for.
FIXED_WEIGHT = 0.125
#: The element around the main one takes its place if it adds this share to its text.
CLIMB = 0.5

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
PARTS = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]+")
HOST = re.compile(r"^\s*[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#\s]*)")

#: Elements of HTML.
RAW = frozenset({"script", "style", "textarea", "title", "iframe", "noembed", "noframes", "xmp"})
VOID = frozenset({"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"})
INLINE = frozenset({"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font",
                    "i", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike",
                    "strong", "sub", "sup", "time", "tt", "u", "var"})
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
             "th": {"td", "th"}, "option": {"option"}}
LISTS = frozenset({"ul", "ol", "dl", "table", "tbody", "thead", "select"})
FURNITURE = frozenset({"head", "nav", "footer", "aside", "form", "script", "style", "noscript", "template", "iframe",
                       "button", "select", "textarea", "svg", "dialog", "menu", "canvas", "object", "title"})
CONTENT = frozenset({"article", "main"})
#: Words of class, id and role that name furniture, and words that name a frame around content.
MARKS = frozenset({"ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo",
                   "promotion", "banner", "sidebar", "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs",
                   "footer", "contentinfo", "complementary", "masthead", "comment", "comments", "disqus", "reply",
                   "replies", "respond", "cookie", "cookies", "consent", "gdpr", "notice", "notification", "alert",
                   "newsletter", "subscribe", "popup", "modal", "overlay", "share", "sharing", "social", "related",
                   "recommended", "widget", "toolbar", "pagination", "pager", "login", "signup", "search"})
FRAMES = frozenset({"wrap", "wrapper", "container", "layout", "content", "main", "article", "body", "page", "has", "with", "no"})


def host_of(url: str | None) -> str:
    found = HOST.match(url or "")
    return found[1].lower() if found else ""


def _is_furniture(tag: str, names: str, inside: bool) -> bool:
    if tag in FURNITURE:
        return True
    if tag == "header" and not inside:
        return True
    if tag in CONTENT or tag in ("html", "body") or not names:
        return False
    words = {w.lower() for w in PARTS.findall(names)}
    return not words & FRAMES and (bool(words & MARKS) or "header" in words and not inside)


#: Elements that hold one paragraph of the element around them.
PARAGRAPHS = frozenset({"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "td", "th", "pre", "blockquote", "caption",
                        "figcaption", "summary", "address", "legend"})
DIGITS = re.compile(r"\d+")


class Node:
    """An element that is not inline: its tag, names without digits, first child, marks, and its role once all are known."""

    __slots__ = ("parent", "tag", "names", "first", "inner", "content", "furniture", "role", "own", "sub", "texts")

    def __init__(self, parent: Node | None, tag: str, names: str, content: bool, furniture: bool):
        self.parent, self.tag, self.names, self.content, self.furniture = parent, tag, names, content, furniture
        self.first, self.inner, self.role, self.own, self.sub, self.texts = "", False, 0, 0.0, 0.0, 0


class Walk:
    """A page as ``nodes`` in the order of their starts and ``blocks``: node, text, linked characters.

    Broken markup is read as it comes: an end tag without a start is passed over, elements left open end with their
    parents or the page. Text outside all elements belongs to the page itself, the first node.
    """

    def __init__(self, page: str | None):
        self.blocks: list[tuple[Node, str, int]] = []
        root = Node(None, "", "", False, False)
        self.nodes = [root]
        self._stack = [root]
        self._text: list[str] = []
        self._linked = self._links = 0
        self._read(page or "")
        for node in self.nodes:
            up = node.parent.role if node.parent else 0
            node.role = _hash("tag", str(up), node.tag, node.names, node.first)

    def _read(self, page: str) -> None:
        at, n = 0, len(page)
        while at < n:
            found = TAG.search(page, at)
            end = found.start() if found else n
            if end > at:
                self._add(page[at:end])
            if not found:
                break
            at = found.end()
            tag = (found[2] or found[5] or "").lower()
            if not tag:
                if page.startswith("<![CDATA[", found.start()):
                    self._add(page[found.start() + 9:at - 3])
                continue
            if found[1] or found[4]:
                self._close(tag)
                continue
            attributes = found[3] or found[6] or ""
            if tag in RAW:
                stop = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
                at = stop.end() if stop else n
                continue
            self._open(tag, attributes)
        self._flush()

    def _add(self, raw: str) -> None:
        self._text.append(raw)
        if self._links:
            self._linked += len(raw)

    def _flush(self) -> None:
        if not self._text:
            return
        text = " ".join(references.unescape("".join(self._text)).split())
        linked, self._linked, self._text = self._linked, 0, []
        if text:
            node = self._stack[-1]
            node.first = node.first or "#"
            node.texts += 1
            self.blocks.append((node, text, min(linked, len(text))))

    def _open(self, tag: str, attributes: str) -> None:
        if tag == "br":
            self._text.append(" ")
        if tag in INLINE:
            if tag == "a":
                self._links += 1
            return
        if tag in VOID:
            if tag == "hr":
                self._flush()
            return
        self._flush()
        if self._stack[-1].tag == "p":
            self._stack.pop()
        if tag in CLOSED_BY:
            self._end_of(CLOSED_BY[tag])
        names = " ".join(a or b or c for a, b, c in NAMES.findall(attributes)) if attributes else ""
        up = self._stack[-1]
        furniture = up.furniture or _is_furniture(tag, names, up.content)
        node = Node(up, tag, DIGITS.sub("0", names), up.content or tag in CONTENT and not furniture, furniture)
        up.first, up.inner = up.first or tag, True
        self._links = 0
        self._stack.append(node)
        self.nodes.append(node)

    def _end_of(self, tags: set[str]) -> None:
        """Ends the innermost of ``tags`` that is open within its list."""
        for i in range(len(self._stack) - 1, 0, -1):
            if self._stack[i].tag in tags:
                del self._stack[i:]
                return
            if self._stack[i].tag in LISTS:
                return

    def _close(self, tag: str) -> None:
        if tag in INLINE:
            if tag == "a" and self._links:
                self._links -= 1
            return
        if tag in VOID:
            return
        self._flush()
        for i in range(len(self._stack) - 1, 0, -1):
            if self._stack[i].tag == tag:
                del self._stack[i:]
                self._links = 0
                return

    def holders(self) -> list[Node]:
        """The element that each block counts for: the one around a paragraph or around one of several alike."""
        alike: dict[tuple[int, int], int] = {}
        for node in self.nodes:
            if node.parent and node.texts:
                key = (id(node.parent), node.role)
                alike[key] = alike.get(key, 0) + 1
        return [node.parent if node.parent and not node.inner and (node.tag in PARAGRAPHS or alike[id(node.parent), node.role] > 1)
                else node for node, _, _ in self.blocks]


def _hash(*parts: str) -> int:
    return xxhash.xxh3_64_intdigest("\x00".join(parts).encode("utf-8", "surrogatepass")) - (1 << 63)


#: Kinds of tokens.
ELEMENT, TEXT, SLOT, HOLDER = range(4)


def page_tokens(page: str | None) -> dict[int, list]:
    """Tokens of a page by hash: kind, parent's hash, times, characters, linked (or, of a holder, all under it), place.

    A text's parent is its element and its place among all blocks of the page is from 0 to 1. A holder's characters are
    those it directly holds, without links and what markup declares to be furniture.
    """
    walk = Walk(page)
    counts: dict[int, list] = {}
    for node in walk.nodes:
        counts.setdefault(node.role, [ELEMENT, node.parent.role if node.parent else 0, 0, 0, 0, 0.0])[2] += 1
    n = len(walk.blocks)
    for i, ((node, text, linked), holder) in enumerate(zip(walk.blocks, walk.holders())):
        token = counts.setdefault(_hash("text", str(node.role), text), [TEXT, node.role, 0, 0, 0, (i + 0.5) / n])
        token[2] += 1
        mass = 0 if node.furniture else len(text) - linked
        # What a text gives to its holder, to be taken off if the template fixes it.
        token[3] += mass
        token[4] = holder.role
        slot = counts.setdefault(_hash("slot", str(node.role)), [SLOT, node.role, 0, 0, 0, 0.0])
        slot[2] += 1
        slot[3] += len(text)
        slot[4] += linked
        if mass:
            holder.own += mass
            at = holder
            while at:
                at.sub += mass
                at = at.parent
    for node in walk.nodes:
        if node.sub:
            token = counts.setdefault(_hash("holder", str(node.role)), [HOLDER, node.role, 0, 0, 0, 0.0])
            token[2] += 1
            token[3] += int(node.own)
            token[4] += int(node.sub)
    return counts


COLUMNS = ("kind", "parent", "pages", "low", "high", "chars", "linked", "place")


def tokens(pages: DataFrame, page_id: str, url: str, html: str) -> DataFrame:
    """host, token and COLUMNS: a row for each token of a host and, with token 0, for the host.

    The occurrence vector is held as two sums (low, high) of halves of a hash of page and count, so equal rows add up and
    never cancel.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int], list] = {}
        for batch in batches:
            for address, page, key in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                host, name = _hash(host_of(address)), key.to_bytes(8, "little", signed=True)
                for token, (kind, parent, times, chars, linked, place) in page_tokens(page.as_py()).items():
                    vector = xxhash.xxh3_64_intdigest(name, seed=times)
                    row = found.get((host, token))
                    if row is None:
                        found[host, token] = [kind, parent, 1, vector & 0xFFFFFFFF, vector >> 32, chars, linked, place]
                    else:
                        row[2] += 1
                        row[3] += vector & 0xFFFFFFFF
                        row[4] += vector >> 32
                        row[5] += chars
                        if kind != TEXT:
                            row[6] += linked
                        row[7] += place
                # The host itself, as a token on each of its pages.
                found.setdefault((host, 0), [ELEMENT, 0, 0, 0, 0, 0, 0, 0.0])[2] += 1
            if len(found) > 200_000:
                yield _token_batch(found)
                found = {}
        if found:
            yield _token_batch(found)

    key = F.xxhash64(F.col(page_id), F.col(url), F.length(F.col(html)))
    rows = pages.select(F.col(url).alias("url"), F.col(html).alias("html"), key.alias("key")).mapInArrow(
        run, "host long, token long, kind int, parent long, pages long, low long, high long, chars long, linked long, place double")
    summed = F.when(F.max("kind") == TEXT, F.max("linked")).otherwise(F.sum(F.when(F.col("kind") != TEXT, F.col("linked"))))
    return rows.groupBy("host", "token").agg(
        F.max("kind").alias("kind"), F.max("parent").alias("parent"), *[F.sum(c).alias(c) for c in ("pages", "low", "high", "chars")],
        summed.alias("linked"), F.sum("place").alias("place"))


def _token_batch(found: dict) -> pa.RecordBatch:
    keys = np.array(list(found), np.int64).reshape(-1, 2)
    columns = list(zip(*found.values()))
    types = [pa.int32(), *[pa.int64()] * 6, pa.float64()]
    return pa.RecordBatch.from_arrays([pa.array(keys[:, 0]), pa.array(keys[:, 1]), *[pa.array(c, t) for c, t in zip(columns, types)]],
                                      names=["host", "token", *COLUMNS])


def classes(counted: DataFrame, share: float = SHARE) -> DataFrame:
    """The elements and texts of ``counted`` that are on ``share`` of their host's pages, two at least, with ``members``.

    Tokens of equal host, pages, low and high have one occurrence vector and are a class of ``members`` tokens. A host of one
    page has none.
    """
    hosts = counted.filter("token = 0").select(F.col("host").alias("of"), F.col("pages").alias("all"))
    common = counted.filter((F.col("token") != 0) & F.col("kind").isin(ELEMENT, TEXT) & (F.col("pages") > 1)).join(
        hosts, F.col("host") == F.col("of")).filter(F.col("pages") >= share * F.col("all")).drop("of", "all")
    sizes = common.groupBy("host", "pages", "low", "high").agg(F.count("*").alias("members"))
    return common.join(sizes, ["host", "pages", "low", "high"])


def templates(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """host, fixed, copied, menus, holders, masses, subs: the template of each host and what its slots hold.

    ``fixed``: the fixed texts in their order. ``menus``: slots of links. ``holders``: elements with the text that is the
    pages' own, mean characters a page, in ``masses`` and with all under them in ``subs``. ``copied``: holders most of whose
    text is fixed: copies of one text, if they hold the most. Arrays are bounded: a token stands in one only if it is on SHARE or RARE of the pages.
    """
    counted = stored(tokens(pages, page_id, url, html).filter((F.col("pages") > 1) | (F.col("token") == 0)), "tokens")
    frequent = stored(classes(counted).select("host", "token", "kind", "parent", "pages", "chars", "linked", "place", "members"), "classes")
    # Nested: a text is fixed where its element is on all these pages, too.
    elements = frequent.filter(F.col("kind") == ELEMENT).select(F.col("host").alias("h"), F.col("token").alias("t"))
    texts = frequent.filter((F.col("kind") == TEXT) & (F.col("members") >= LEAST_MEMBERS)).join(elements, (F.col("host") == F.col("h")) & (F.col("parent") == F.col("t")), "left_semi")
    fixed = texts.groupBy("host").agg(F.transform(F.array_sort(F.collect_list(F.struct(
        (F.col("place") / F.col("pages")).alias("place"), "token"))), lambda x: x["token"]).alias("fixed"))
    hosts = counted.filter("token = 0").select(F.col("host").alias("of"), F.col("pages").alias("all"))
    usual = counted.filter(F.col("kind") >= SLOT).join(hosts, F.col("host") == F.col("of")).filter(F.col("pages") >= RARE * F.col("all")).drop("of")
    off = texts.groupBy("host", F.col("linked").alias("parent")).agg(F.sum("chars").alias("off"))
    held = usual.filter(F.col("kind") == HOLDER).join(off, ["host", "parent"], "left").withColumn("off", F.least(F.coalesce("off", F.lit(0)), "chars"))
    mass = (F.col("chars") - F.col("off") + FIXED_WEIGHT * F.col("off")) / F.col("pages")
    holders = held.groupBy("host").agg(
        F.array_sort(F.collect_list(F.struct("parent", mass.alias("mass"), (F.col("linked") / F.col("pages")).alias("sub"),
                                             (2 * F.col("off") > F.col("chars")).alias("copied")))).alias("all")).select(
        "host", F.col("all.parent").alias("holders"), F.col("all.mass").alias("masses"), F.col("all.sub").alias("subs"), F.col("all.copied").alias("copied"))
    menus = usual.filter((F.col("kind") == SLOT) & (F.col("linked") >= LINK_SHARE * F.col("chars"))).groupBy("host").agg(
        F.collect_set("token").alias("menus"))
    return fixed.join(menus, "host", "full").join(holders, "host", "full")


class Template:
    """What is known of a host: fixed texts with their place in the order, menus, holders with own and whole mass and whether copied."""

    def __init__(self, fixed=(), menus=(), holders=(), masses=(), subs=(), copied=()):
        self.fixed = {token: i for i, token in enumerate(fixed or ())}
        self.menus = set(menus or ())
        self.holders = {h: row for h, *row in zip(holders or (), masses or (), subs or (), copied or ())}


def _in_order(places: list[int | None]) -> set[int]:
    """Indices of the longest run of growing places; a fixed text out of the template's order is data."""
    ends, which, before = [], [], {}
    for i, place in enumerate(places):
        if place is None:
            continue
        at = bisect.bisect_left(ends, place)
        before[i] = which[at - 1] if at else None
        if at == len(ends):
            ends.append(place)
            which.append(i)
        else:
            ends[at], which[at] = place, i
    out, i = set(), which[-1] if which else None
    while i is not None:
        out.add(i)
        i = before[i]
    return out


def page_text(page: str | None, template: Template) -> str:
    """Blocks of a page's main slots in their order, one a line."""
    walk = Walk(page)
    holders = walk.holders()
    fixed = _in_order([template.fixed.get(_hash("text", str(node.role), text)) for node, text, _ in walk.blocks])
    linky: dict[int, list[int]] = {}
    for node, text, linked in walk.blocks:
        slot = linky.setdefault(node.role, [0, 0])
        slot[0] += len(text)
        slot[1] += linked
    menus = {role for role, (chars, linked) in linky.items() if _hash("slot", str(role)) in template.menus or linked == chars}
    own: dict[int, float] = {}
    sub: dict[int, float] = {}
    for i, ((node, text, linked), holder) in enumerate(zip(walk.blocks, holders)):
        mass = 0 if node.furniture else (len(text) - linked) * (FIXED_WEIGHT if i in fixed else 1.0)
        if mass:
            own[holder.role] = own.get(holder.role, 0.0) + mass
            at = holder
            while at:
                sub[at.role] = sub.get(at.role, 0.0) + mass
                at = at.parent
    if not own:
        return ""
    # The host's figures where it has some, the page's own elsewhere.
    def mass(role: int) -> float:
        known = template.holders.get(role)
        return known[0] if known else own.get(role, 0.0)

    def whole(role: int) -> float:
        known = template.holders.get(role)
        return known[1] if known else sub.get(role, 0.0)

    best = max(own, key=mass)
    main = next(h for h in holders if h.role == best)
    while main.parent and whole(main.parent.role) - whole(main.role) >= CLIMB * whole(main.role):
        main = main.parent
    at = main
    while at:
        if at.tag == "article" and not at.furniture:
            main = at
        at = at.parent
    known = template.holders.get(main.role) or template.holders.get(best)
    if known and known[2]:
        fixed = set()
    kept = []
    inside: dict[int, bool] = {}
    for i, (node, text, _) in enumerate(walk.blocks):
        if node.furniture or i in fixed or node.role in menus:
            continue
        if node.role not in inside:
            at = node
            while at and at.role != main.role:
                at = at.parent
            inside[node.role] = at is not None
        if inside[node.role]:
            kept.append(text)
    return "\n".join(kept)


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """A row for each row of ``pages``: page_id, url, text, n_chars.

    A NULL or empty page has the empty text; a NULL or odd url belongs to the host without a name. Repeated rows are one
    page more each. A host's only page has no template: its own slots decide, and no text is fixed. Of elements
    that hold equally much the first of the page is taken. Long pages are read whole. An empty table gives no rows, and other columns play no
    part. Pages are joined with the templates by host; a host of any size is joined row by row.
    """
    small_batches(pages.sparkSession)
    found = stored(templates(pages, page_id, url, html), "templates").withColumnRenamed("host", "of")
    addressed = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    parts = ("fixed", "menus", "holders", "masses", "subs", "copied")

    def hosts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = pa.array([_hash(host_of(u)) for u in batch.column("url").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, names], names=[*batch.schema.names, "host"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, template = None, Template()
        for batch in batches:
            texts = []
            columns = [batch.column(c) for c in parts]
            for page, host, *known in zip(batch.column("html"), batch.column("host").to_pylist(), *columns):
                if host != last:
                    last, template = host, Template(*[k.as_py() for k in known])
                texts.append(page_text(page.as_py(), template))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    kinds = {c: addressed.schema[c].dataType.simpleString() for c in addressed.columns}
    joined = addressed.mapInArrow(hosts, f"page_id {kinds['page_id']}, url {kinds['url']}, html {kinds['html']}, host long").join(
        found, F.col("host") == F.col("of"), "left").drop("of")
    return joined.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
