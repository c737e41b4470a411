"""Main text of web pages by consensus paths per host.

Parts are left out by their tag or role, and by a class or id that as a whole
names page furniture (``ad-slot``, ``site-footer``; not ``no-sidebar``) -- unless
such a part holds most of the page's text and no named main part lies outside.

First pass: each page's containers are scored by their share of the page's
remaining text; the best ones vote, in Spark, for
their generalised path (tags with classes, digits left out) within the host.
Second pass: the host's winning path is extracted from every page that has it;
other pages use their own best container.  Votes are combined on the map side.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import apply_recommended_conf
from .line_dedup import host_of
from .store import written

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>", re.S)
ATTR = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
RAW = {t: re.compile(rf"</{t}\b[^>]*>", re.I) for t in ("script", "style", "textarea", "title", "xmp", "noembed", "noframes", "noscript", "iframe")}
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = set("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form
h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul""".split())
CONTAINERS = set("article body center div main section table tbody td tr blockquote".split())
SKIPPED = set("""nav footer aside form script style noscript template iframe svg canvas button select textarea object embed video audio dialog menu
head title map math label input datalist fieldset""".split())
CLOSES_P = BLOCKS - {"body", "html", "tr", "td", "th", "tbody", "thead", "tfoot", "caption", "option", "legend"}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
STOPS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
#: Words of class and id names: furniture, and words that may go with them.
FURNITURE = re.compile(r"""ads?|adv|advert\w*|adsense|sponsor\w*|promo\w*|banners?|sidebars?|menus?|nav|navbar|navigation|breadcrumbs?|footer|foot
|comments?|commentlist|replies|respond|disqus|cookies?|consent|gdpr|notices?|alerts?|popup|modal|overlay|newsletter|subscribe|subscription|signup|share|sharing|social|related|recommend\w*
|widgets?|toolbar|pagination|pager|masthead|topbar|login|outbrain|taboola""".replace("\n", ""), re.I)
NEUTRAL = set("""area articles bar block bottom box boxes button buttons column container content copyright cta form fixed global group header heading holder inner item items
left link links list main media message middle outer panel placeholder post posts primary right row secondary section side site slot small stories sticky text thread title top unit
wrap wrapper""".split())
HEADERS = {"site-header", "siteheader", "page-header", "pageheader"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu", "menubar"}
MAIN_CLASS = re.compile(r"(?:^|[-_\s])(?:article\w*|post|entry|story|content|text|body|main)(?:$|[-_\s\d])", re.I)


class Node:
    """An element; ``size`` is its text, first without and at last with that of its children."""

    __slots__ = ("tag", "label", "skip", "main", "aside", "parent", "size")

    def __init__(self, tag: str, label: str, skip: bool, main: bool, aside: bool, parent: Node | None):
        self.tag, self.label, self.skip, self.main, self.aside, self.parent, self.size = tag, label, skip, main, aside, parent, 0

    def path(self) -> str:
        labels, node = [], self
        while node.parent is not None:
            labels.append(node.label)
            node = node.parent
        return ">".join(reversed(labels))


def names_furniture(name: str) -> bool:
    """Whether a class or id name is made of furniture words, and words that go with them, only."""
    words = [w for w in re.split(r"[-_]+", name.lower()) if w and not w.isdigit()]
    known = [bool(FURNITURE.fullmatch(w.rstrip("0123456789"))) for w in words]
    return name.lower() in HEADERS or any(known) and all(k or w in NEUTRAL for k, w in zip(known, words, strict=True))


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in ATTR.finditer(raw)}


def parse(html: str) -> tuple[list[Node], list[tuple[str, Node]]]:
    """All elements in page order, and the page's blocks ``(text, innermost
    element)`` outside parts left out; a block ends at every block-level tag."""
    top = Node("", "", False, False, False, None)
    stack, nodes, blocks, run = [top], [], [], []
    open_: Counter[str] = Counter()
    named = 0                    # open elements that are main parts

    def flush() -> None:
        if run:
            words = " ".join(unescape("".join(run)).split())
            run.clear()
            if words:
                blocks.append((words, stack[-1]))
                stack[-1].size += len(words)

    def close(to: int) -> None:
        nonlocal named
        if any(n.tag in BLOCKS for n in stack[to:]):
            flush()
        for n in stack[to:]:
            open_[n.tag] -= 1
            named -= n.main
        del stack[to:]

    pos = 0
    while True:
        m = TAG.search(html, pos)
        if not stack[-1].skip:
            piece = html[pos : m.start() if m else len(html)]
            if piece:
                run.append(piece)
        if m is None:
            break
        pos = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:
            if tag == "br" or tag == "p" and not open_["p"]:
                run.append(" ")
            for i in range(len(stack) - 1, 0, -1) if open_[tag] else ():
                if stack[i].tag == tag:
                    close(i)
                    break
                if stack[i].tag in ("td", "th", "table") and tag not in ("td", "th", "tr", "table", "tbody", "body", "html"):
                    break
            continue
        if tag == "br":
            run.append(" ")
            continue
        if tag in BLOCKS:
            flush()
        if tag in CLOSES_P and open_["p"]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p":
                    close(i)
                    break
                if stack[i].tag in CONTAINERS or stack[i].tag in ("button", "object"):
                    break
        if tag in CLOSES and any(open_[t] for t in CLOSES[tag]):
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in STOPS[tag]:
                    break
                if stack[i].tag in CLOSES[tag]:
                    close(i)
                    break
        if tag in VOID:
            continue
        a = _attributes(m[3] or m[6] or "")
        name = f"{a.get('class', '')} {a.get('id', '')}".strip()
        classes = " ".join(sorted(re.sub(r"[\d>]+", "", a.get("class", "")).lower().split()))
        skip = stack[-1].skip or tag in SKIPPED or tag == "article" and bool(re.search(r"\b(?:comment|reply)", name, re.I)) or a.get("role", "").lower() in ROLES or "hidden" in a or (
            a.get("aria-hidden", "").lower() == "true") or bool(re.search(r"display\s*:\s*none", a.get("style", ""), re.I))
        if tag == "header" and not named:
            skip = True
        aside = tag not in ("html", "body", "article", "main") and any(names_furniture(w) for w in name.split())
        main = not aside and (tag in ("article", "main") or a.get("role", "").lower() == "main" or a.get("itemprop", "").lower() == "articlebody" or tag in ("div", "section", "td") and bool(MAIN_CLASS.search(name)))
        node = Node(tag, f"{tag}{'.' + classes.replace(' ', '.') if classes else ''}", skip, main, aside, stack[-1])
        nodes.append(node)
        if tag in RAW:
            end = RAW[tag].search(html, pos)
            pos = end.end() if end else len(html)
            continue
        stack.append(node)
        open_[tag] += 1
        named += main
    flush()
    return nodes, _without_asides(nodes, blocks)


def _without_asides(nodes: list[Node], blocks: list[tuple[str, Node]]) -> list[tuple[str, Node]]:
    """``blocks`` without those in parts named as furniture; sets sizes."""
    own, total = {id(n): n.size for n in nodes}, sum(len(t) for t, _ in blocks)
    for n in reversed(nodes):
        n.parent.size += n.size
    while any(n.aside for n in nodes):
        cut, whole = set(), [n.size for n in nodes]
        for n in nodes:          # parents come first
            if n.aside or id(n.parent) in cut:
                cut.add(id(n))
        for n in nodes:
            n.size = 0 if id(n) in cut else own[id(n)]
        for n in reversed(nodes):
            if n.parent.parent is not None:
                n.parent.size += n.size
        large = [n for n, size in zip(nodes, whole, strict=True) if n.aside and 2 * size > total]
        if not large or any(n.main and n.size for n in nodes):
            return [(t, n) for t, n in blocks if id(n) not in cut]
        for n in large:
            n.aside = False
        for n, size in zip(nodes, whole, strict=True):
            n.size = size
    return blocks


def container_scores(nodes: list[Node], blocks: list[tuple[str, Node]]) -> list[tuple[float, Node]]:
    """Containers by their share of the page's text, named main parts first."""
    total = sum(len(t) for t, _ in blocks)
    if not total:
        return []
    out = []
    for depth, n in enumerate(nodes):
        if n.tag in CONTAINERS and not n.skip and n.size:
            bonus = 0.5 if n.tag in ("article", "main") else 0.3 if n.main else 0.0
            out.append((n.size / total + bonus, depth, n))
    return [(s, n) for s, _, n in sorted(out, key=lambda x: (-x[0], -x[1]))]


def inside(nodes: list[Node], path: str) -> set[int]:
    """The elements at ``path`` and below."""
    labels, found, on = path.split(">"), set(), {}
    for n in nodes:              # parents come first; ``on``: how many labels agree
        at = 0 if n.parent.parent is None else on.get(id(n.parent), -1)
        if id(n.parent) in found:
            found.add(id(n))
        elif 0 <= at < len(labels) and labels[at] == n.label:
            on[id(n)] = at + 1
            if at + 1 == len(labels):
                found.add(id(n))
    return found


def page_text(html: str | None, path: str | None) -> str:
    nodes, blocks = parse(html or "")
    if path is not None:
        here = inside(nodes, path)
        if found := [t for t, n in blocks if id(n) in here]:
            return "\n".join(found)
    best = container_scores(nodes, blocks)
    here = inside(nodes, best[0][1].path()) if best else set()
    return "\n".join(t for t, n in blocks if not best or id(n) in here)


def consensus_paths(pages: DataFrame) -> DataFrame:
    """``(host, path)``: the path with most votes of each host (ties: the
    deeper, then the first path); ``pages`` has host and html."""
    def run(batches):
        for b in batches:
            rows = []
            for host, html in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ballot: dict[str, float] = {}
                for score, n in container_scores(*parse(html or ""))[:3]:
                    path = n.path()
                    ballot[path] = max(ballot.get(path, 0.0), score)
                rows += [(host, p, round(1000 * s)) for p, s in ballot.items()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.string(), pa.int64()))], names=["host", "path", "score"])

    votes = pages.filter("host <> ''").select("host", "html").mapInArrow(run, "host string, path string, score long")
    votes = votes.groupBy("host", "path").agg(F.sum("score").alias("votes"))
    first = Window.partitionBy("host").orderBy(F.desc("votes"), F.desc(F.size(F.split("path", ">"))), "path")
    return votes.withColumn("nth", F.row_number().over(first)).filter("nth = 1").select("host", "path")


def _text_udf():
    def run(html: pa.Array, path: pa.Array) -> pa.Array:
        return pa.array([page_text(h, p) for h, p in zip(html.to_pylist(), path.to_pylist(), strict=True)], pa.string())

    return F.arrow_udf(run, "string")


def main_text(pages: DataFrame, url_col: str = "url", html_col: str = "html", name: str = "text") -> DataFrame:
    """``pages`` with a column ``name`` of the main text in place of the html.

    Blocks in page order joined by ``\\n``, white space inside a block one
    space, character references decoded.  Null or empty html gives an empty
    text; a null or odd url has no consensus and uses the page alone; repeated
    rows get equal texts; other columns stay; no rows give no rows.
    """
    apply_recommended_conf(pages.sparkSession)
    keyed = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns if c != html_col]).alias("row"), F.col(html_col).alias("html"),
                         F.coalesce(host_of(url_col), F.lit("")).alias("host"))
    best = written(consensus_paths(keyed), "paths").withColumnsRenamed({"host": "p_host"})
    both = keyed.join(best, F.col("host") == F.col("p_host"), "left").select("row", _text_udf()(F.col("html"), F.col("path")).alias("main"))
    return both.select(*[F.col("row")[c].alias(c) for c in pages.columns if c not in (html_col, name)], F.col("main").alias(name))
