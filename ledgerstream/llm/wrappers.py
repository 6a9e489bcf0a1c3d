"""HTML main text by union-free wrapper inference.

Each page is a tree of block elements and text slots. Neighbouring siblings of one label, and repeated runs of labels, are
folded into repeated groups; then the trees of a host are aligned one after another: children are matched in order by
label, what only one of two has becomes optional, what one of two repeats becomes a repeat, texts become slots. The
result, without unions, is the host's wrapper.

A slot is a place of the wrapper: the path of labels down to it. Over all pages of the host it has a role:

- A place is *outside* if its path says so (nav, footer, aside, form, or a class such as ``sidebar`` or ``comments``).
- A place in an article or main element is content, unless it has a class of its own and holds the same text on nearly all
  pages (share buttons, notes of the site), or the class is a doubtful one (``legal-analysis``) and its texts are short or links.
- Any other place counts on pages without a content slot of an article: it is content unless nearly all its texts are
  constant over the host's pages, or it is a list that mostly holds links; and of its texts, those that half of the pages have
  are left out. Near-copies of a page count once, so they make nothing constant.

A page's text is that of its content slots. Pages are parsed once; their blocks are written, and slots, roles and texts are
DataFrame expressions over them. A wrapper is made from the host's distinct folded trees, merged in groups of a few, so
no task gathers a host.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(script|style|noscript|template|iframe|svg|object|canvas|audio|video|textarea|title|select|math)\b(?:"[^"]*"|'[^']*'|[^'">])*?(?:/>|>.*?(?:</\1\s*>|\Z))|</?[a-zA-Z](?:"[^"]*"|'[^']*'|[^'">])*(?:>|\Z)|[^<]+|<""", re.S | re.I)
_OPENING, _CLOSING = re.compile(r"<([a-zA-Z][^\s/>]*)"), re.compile(r"</([a-zA-Z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
# Elements by kind.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split())
ENDS_P = BLOCK - frozenset("caption tbody td tfoot th thead tr body html head li dd dt".split())
AWAY = frozenset("nav footer aside form menu dialog button head header label input".split())
HEADINGS = frozenset("h1 h2 h3".split())
WORDS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs header masthead topbar footer sidebar rail widget widgets cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup paywall share sharing social comment comments commentlist disqus reply replies respond discussion related recommended recommendations pagination pager login search searchform form toolbar copyright legal disclaimer skip".split())
#: Of these, those that in a compound name inside an article say little: the slot's texts decide.
DOUBTFUL = frozenset("legal disclaimer discussion notice notices alert header banner menu search form skip respond rail promo promotion copyright overlay recommended recommendations toolbar".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
#: A text is constant if this share of a host's distinct pages, and at least LEAST of them, have it in a slot.
SHARE, LEAST = 0.5, 3
#: A slot is constant if this share of its texts is; a list is links if this share of its characters is.
CONSTANT, LINKED = 0.95, 0.6
#: Doubtful slots are content from this mean number of characters.
PROSE = 80
BROADCAST_BYTES = 4 << 20
#: Wrappers merged in one step.
MERGED = 8


def host_of(url_col: str = "url") -> Column:
    return F.lower(F.coalesce(F.try_parse_url(F.col(url_col), F.lit("HOST")), F.lit("")))


def _attributes(tag: str) -> dict[str, str]:
    return {m[1].lower(): entities.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(tag)}


def _named(value: str, whole: bool) -> int:
    """2 if a class or id names something outside of the main text, 1 if doubtfully, else 0."""
    found = 0
    for name in value.lower().split():
        if name in WORDS:
            return 2
        if not whole and not re.match(r"(has|with|no|without|is)[-_]", name):
            parts = WORDS.intersection(re.split(r"[-_:]+", name))
            if parts - DOUBTFUL:
                return 2
            found = found or int(bool(parts))
    return found


def _away(name: str, attributes: dict[str, str]) -> int:
    """Whether an element's place is outside of the main text: 2 yes, 1 doubtful, 0 no."""
    if name in AWAY or "hidden" in attributes or attributes.get("aria-hidden") == "true" or attributes.get("role", "").lower() in ROLES or re.search(r"display\s*:\s*none", attributes.get("style", ""), re.I):
        return 2
    if name in ("html", "body") or not attributes:
        return 0
    whole = name in ("article", "main", "section")
    return max(_named(attributes.get("class", ""), whole), _named(attributes.get("id", ""), whole))


class Page:
    """``tree``: nodes ``[label, quantifier, children]`` of block elements, ``#`` a text slot. ``blocks``: (place, characters in
    links, text) in page order.

    A place is a sign and the path of labels, names with their classes. The sign is ``-`` outside of the main text, ``~`` doubtful,
    ``+`` in an article or main element, ``.`` elsewhere.
    """

    def __init__(self, source: str):
        self.tree: list = []
        self.blocks: list[tuple[str, int, str]] = []
        # name, path, away, in a region, children; elements that are no blocks share their parent's path and children
        stack: list[tuple[str, str, int, bool, list]] = [("", "", 0, False, self.tree)]
        text: list[str] = []
        linked = links = 0

        def flush() -> None:
            nonlocal linked
            if text:
                joined = " ".join("".join(text).split())
                if joined:
                    _, path, away, region, children = stack[-1]
                    self.blocks.append((("-~"[away == 1] if away else "+" if region else ".") + path, min(linked, len(joined)), joined))
                    children.append(["#", "", []])
                text.clear()
            linked = 0

        def close(k: int) -> None:
            nonlocal links
            while len(stack) > k:
                name, path, *_ = stack[-1]
                if path != stack[-2][1]:
                    flush()
                links -= name == "a"
                stack.pop()

        def close_to(names: frozenset | set, within: frozenset) -> None:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in names:
                    close(k)
                    return
                if stack[k][0] in within:
                    return

        for m in _TOKEN.finditer(source):
            tok = m[0]
            if tok[0] != "<" or tok == "<":
                value = entities.unescape(tok) if "&" in tok else tok
                if text or value.strip():
                    text.append(value)
                    linked += len(value) if links else 0
                continue
            if m[1] or tok[1] in "!?":
                if tok.startswith("<![CDATA["):
                    text.append(tok[9:].removesuffix("]]>"))
                continue
            if tok[1] == "/":
                name = _CLOSING.match(tok)[1].lower()
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] == name:
                        close(k)
                        break
                    if name not in BLOCK and stack[k][0] in BLOCK:
                        break
                continue
            name = _OPENING.match(tok)[1].lower()
            if name in ("br", "wbr"):
                text.append(" " if name == "br" else "")
                continue
            if name in ENDS_P:
                close_to({"p"}, BLOCK - {"p"})
            if name == "li":
                close_to({"li"}, frozenset(("ul", "ol", "menu")))
            elif name in ("dt", "dd"):
                close_to({"dt", "dd"}, frozenset(("dl",)))
            elif name in ("td", "th"):
                close_to({"td", "th"}, frozenset(("tr", "table")))
            elif name == "tr":
                close_to({"tr"}, frozenset(("table",)))
            block = name in BLOCK
            if block:
                flush()
            if name in VOID:
                continue
            attributes = _attributes(tok[1 + len(name) :]) if "=" in tok or " " in tok else {}
            _, path, away, region, children = stack[-1]
            own = _away(name, attributes)
            if own == 1 and not region:
                own = 2
            now = max(away, own)
            if away == 2 and name in HEADINGS and region and all(x[2] < 2 or x[0] == "header" for x in stack[1:]):
                now = 0  # an article's own heading, though in a header element
            region = region or now < 2 and (name in ("article", "main") or attributes.get("role") in ("main", "article"))
            if not block and now != away:
                flush()
            if not tok.endswith("/>") or block:
                if block or now != away:
                    label = name + ("." + ".".join(sorted(set(attributes["class"].lower().split()))[:3]) if attributes.get("class", "").strip() else "")
                    node = [label, "", []]
                    children.append(node)
                    path, children = f"{path}/{label}", node[2]
                links += name == "a"
                stack.append((name, path, now, region, children))
        close(1)
        flush()


# -- Wrappers: nodes [label, quantifier, children] --


def _either(a: str, b: str) -> str:
    many, none = (a + b).count("+") + (a + b).count("*"), (a + b).count("?") + (a + b).count("*")
    return "*" if many and none else "+" if many else "?" if none else ""


def _merge(a: list, b: list, quantifier: str | None = None) -> list:
    return [a[0], _either(a[1], b[1]) if quantifier is None else quantifier, a[2] if a[2] == b[2] else align(a[2], b[2])]


def fold(nodes: list) -> list:
    """Siblings with neighbours of one label, then repeated runs of labels, made one repeated node; children first."""
    out: list = []
    for label, q, children in nodes:
        node = [label, q, fold(children)]
        if out and out[-1][0] == label and label != "(":
            out[-1] = _merge(out[-1], node, "+")
        else:
            out.append(node)
    labels = [x[0] for x in out]
    places: dict[str, list[int]] = {}
    for i, x in enumerate(labels):
        places.setdefault(x, []).append(i)
    done: list = []
    k = 0
    while k < len(out):
        for j in places[labels[k]]:
            period = j - k
            if period < 2 or labels[k:j] != labels[j : j + period]:
                continue
            unit, n = out[k:j], 1
            while labels[k + n * period : k + (n + 1) * period] == labels[k:j]:
                unit = align(unit, out[k + n * period : k + (n + 1) * period])
                n += 1
            done.append(["(", "+", unit])
            k += n * period
            break
        else:
            done.append(out[k])
            k += 1
    return done


def _matched(a: list, b: list) -> list[tuple[int, int]]:
    """Places of equal keys in order: a longest common subsequence, or, of long lists, the next occurrence each."""
    if len(a) * len(b) <= 40_000:
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a) - 1, -1, -1):
            row, below, x = best[i], best[i + 1], a[i]
            for j in range(len(b) - 1, -1, -1):
                row[j] = below[j + 1] + 1 if x == b[j] else max(below[j], row[j + 1])
        i = j = 0
        found = []
        while i < len(a) and j < len(b):
            if a[i] == b[j]:
                found.append((i, j))
                i, j = i + 1, j + 1
            elif best[i + 1][j] >= best[i][j + 1]:
                i += 1
            else:
                j += 1
        return found
    places: dict[str, list[int]] = {}
    for j in range(len(b) - 1, -1, -1):
        places.setdefault(b[j], []).append(j)
    found, at = [], 0
    for i, x in enumerate(a):
        left = places.get(x, [])
        while left and left[-1] < at:
            left.pop()
        # Far matches would pass over too much of the other list.
        if left and left[-1] < at + 64 + len(b) // 8:
            found.append((i, left[-1]))
            at = left[-1] + 1
    return found


def _key(node: list) -> str:
    return node[0] if node[0] != "(" else "(" + " ".join(_key(x) for x in node[2])


def align(a: list, b: list) -> list:
    """The union-free wrapper of two lists of nodes: equal labels are one node, the rest is optional."""
    if a == b:
        return a
    out: list = []
    i = j = 0
    optional = lambda x: [x[0], _either(x[1], "?"), x[2]]
    for m, n in [*_matched([_key(x) for x in a], [_key(x) for x in b]), (len(a), len(b))]:
        out += [optional(x) for x in a[i:m]] + [optional(x) for x in b[j:n]]
        if m < len(a):
            out.append(_merge(a[m], b[n]))
        i, j = m + 1, n + 1
    # What alignment brought together is folded again, so wrappers stay small.
    folded: list = []
    for x in out:
        if folded and folded[-1][0] == x[0] and x[0] != "(":
            folded[-1] = _merge(folded[-1], x, "*" if folded[-1][1] in "?*" and x[1] in "?*" and folded[-1][1] and x[1] else "+")
        else:
            folded.append(x)
    return folded


def pattern(nodes: list, content: frozenset | set = frozenset(), path: str = "") -> str:
    """A wrapper as a regular expression over tags; ``#`` is a slot, ``{#}`` one with a path in ``content``."""
    out = []
    for label, q, children in nodes:
        if label == "#":
            x = "{#}" if path in content else "#"
        elif label == "(":
            x = pattern(children, content, path)
        else:
            x = f"<{label}>{pattern(children, content, f'{path}/{label}')}</{label.split('.')[0]}>"
        out.append(f"({x}){q}" if q or label == "(" else x)
    return "".join(out)


def _dump(nodes: list) -> str:
    return json.dumps(nodes, ensure_ascii=False, separators=(",", ":"))


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (host, part, wrapper) sorted by host and part, into one row each."""
    key, held = None, []
    out = lambda: pa.RecordBatch.from_arrays([pa.array([key[0]]), pa.array([_dump(held)])], names=["host", "wrapper"])
    for b in batches:
        for h, p, w in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
            if (h, p) != key:
                if key is not None:
                    yield out()
                key, held = (h, p), json.loads(w)
            else:
                held = align(held, json.loads(w))
    if key is not None:
        yield out()


def parsed(pages: DataFrame) -> DataFrame:
    """``page_id, url, host, places, links, texts, layout`` of every row: blocks in page order, and the folded tree as JSON."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            places, links, texts, layouts = [], [], [], []
            for source in b.column(3):
                page = Page(source.as_py() or "")
                places.append([x[0] for x in page.blocks])
                links.append([x[1] for x in page.blocks])
                texts.append([x[2] for x in page.blocks])
                layouts.append(_dump(fold(page.tree)))
            strings = pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(places, strings), pa.array(links, pa.list_(pa.int64())), pa.array(texts, strings), pa.array(layouts, pa.string())], names=["page_id", "url", "host", "places", "links", "texts", "layout"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), host_of().alias("host"), F.col("html").cast("string").alias("html"))
    return stored(rows.mapInArrow(run, "page_id long, url string, host string, places array<string>, links array<long>, texts array<string>, layout string"), "wrapper-pages")


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """``host, wrapper`` (JSON) from ``parsed`` pages."""
    rows = stored(pages.select("host", F.col("layout").alias("wrapper")).distinct(), "wrapper-layouts")
    most = rows.groupBy("host").count().agg(F.max("count")).first()[0] or 0
    parts = 1
    while parts * MERGED < most:
        parts *= MERGED
    while True:
        part = F.pmod(F.xxhash64("wrapper"), F.lit(parts)).alias("part")
        rows = rows.select("host", part, "wrapper").repartition("host", "part").sortWithinPartitions("host", "part", F.length("wrapper"), "wrapper").mapInArrow(_merged, "host string, wrapper string")
        if parts == 1:
            return stored(rows, "wrappers")
        rows, parts = stored(rows, "wrappers-part"), parts // MERGED


def slot_roles(pages: DataFrame) -> DataFrame:
    """``host, content, lone, constant`` from ``parsed`` pages: places that are content, places that are on pages without any
    of those, and digests of (place, text) that are left out of the latter."""
    blocks = pages.select("host", F.expr("explode(arrays_zip(places, links, texts))").alias("b"), signature().alias("signature")).select("host", F.col("b.places").alias("place"), F.col("b.links").alias("links"), F.col("b.texts").alias("text"), "signature").where("place not like '-%'")
    # A place in an article is tried for constancy only where it has a class of its own below it.
    tried = r"place not like '+%' or regexp_extract(place, '/(?:article|main)[^/]*((?!.*/(?:article|main)).*)$', 1) like '%.%'"
    slots = blocks.groupBy("host", "place").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"), F.sum("links").alias("links"))
    texts = blocks.where(tried).groupBy("host", "place", F.md5("text").alias("text"), "signature").agg(F.count("*").alias("n"))
    n_pages = pages.groupBy("host").agg(F.countDistinct(signature()).alias("pages"))
    spread = texts.groupBy("host", "place", "text").agg(F.count("*").alias("on"), F.sum("n").alias("n")).join(n_pages, "host").withColumn("constant", (F.col("on") >= LEAST) & (F.col("on") >= SHARE * F.col("pages")))
    constancy = spread.groupBy("host", "place").agg(F.sum(F.when(F.col("constant"), F.col("n")).otherwise(0)).alias("constant_n"), F.collect_list(F.when(F.col("constant"), F.md5(F.concat("place", F.lit(":"), "text")))).alias("texts"))
    sign = F.substring("place", 1, 1)
    still = F.coalesce(F.col("constant_n"), F.lit(0)) >= CONSTANT * F.col("n")
    listed = (F.col("links") >= LINKED * F.col("chars")) & ~F.col("place").rlike(r"/(p|h[1-6]|blockquote|pre|td)(\.[^/]*)?$")
    content = F.when(sign == "+", ~still).when(sign == "~", ~still & (F.col("chars") >= PROSE * F.col("n")) & (F.col("links") < LINKED * F.col("chars")))
    roles = slots.join(constancy, ["host", "place"], "left").withColumn("content", content).withColumn("lone", (sign == ".") & ~still & ~listed)
    return roles.groupBy("host").agg(F.collect_list(F.when(F.col("content"), F.col("place"))).alias("content"), F.collect_list(F.when(F.col("lone"), F.col("place"))).alias("lone"), F.flatten(F.collect_list(F.when(F.col("lone"), F.col("texts")))).alias("constant"))


def signature() -> Column:
    """What near-copies of a page share: its longest text."""
    return F.coalesce(F.md5(F.expr("array_max(transform(texts, t -> struct(length(t) as n, t as t))).t")), F.lit(""))


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars, wrapper`` for every row of ``pages (page_id, url, html)``; other columns are ignored.

    Null or empty html has the empty text; repeated rows are kept each, and a url without a host counts for the host ''. ``wrapper``
    is the host's wrapper as a pattern, its content slots in braces. An empty table gives none. Pages are taken whole, however long. Where a
    host has fewer than ``LEAST`` distinct pages no text of it is constant, so what neither element nor name tells for a menu or notice stays.
    """
    rows = parsed(pages)
    made = infer_wrappers(rows).join(slot_roles(rows), "host", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            wraps = [pattern(json.loads(w), {x[1:] for x in [*(c or ()), *(n or ())]}) for w, c, n in zip(*(b.column(i).to_pylist() for i in (1, 2, 3)), strict=True)]
            yield b.set_column(1, "wrapper", pa.array(wraps, pa.string()))

    roles = stored(made.select("host", "wrapper", "content", "lone", "constant").mapInArrow(run, "host string, wrapper string, content array<string>, lone array<string>, constant array<string>"), "wrapper-roles")
    size = roles.agg(F.sum(F.length("wrapper") + 64 * (F.coalesce(F.size("content"), F.lit(0)) + F.coalesce(F.size("lone"), F.lit(0)) + F.coalesce(F.size("constant"), F.lit(0))) + 64)).first()[0] or 0
    # Where the roles are small (measured here) they are sent to the pages; else a host is spread over salts.
    if size <= BROADCAST_BYTES:
        joined = rows.join(F.broadcast(roles), "host", "left")
    else:
        salted = roles.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(31))))
        joined = rows.withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(32)).cast("int")).join(salted, ["host", "salt"], "left")
    blocks = joined.withColumn("blocks", F.expr("arrays_zip(places, texts)"))
    chosen = blocks.withColumn("kept", F.expr("filter(blocks, b -> array_contains(content, b.places))"))
    alone = F.expr("filter(blocks, b -> array_contains(lone, b.places) and not array_contains(constant, md5(concat(b.places, ':', md5(b.texts)))))")
    texts = F.expr("transform(kept, b -> b.texts)")
    chosen = chosen.withColumn("kept", F.when(F.size("kept") > 0, F.col("kept")).otherwise(alone)).withColumn("text", F.coalesce(F.array_join(texts, "\n"), F.lit("")))
    return chosen.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), F.coalesce("wrapper", F.lit("")).alias("wrapper"))
