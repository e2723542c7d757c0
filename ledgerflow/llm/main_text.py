"""HTML extraction by template deduction with equivalence classes (after Arasu and Garcia-Molina, 2003).

Pages of a host are worked on in groups of up to `GROUP` pages. A tag is told apart
by its path of elements. Tags that occur equally often on every page of the group
share an occurrence vector and form an equivalence class; a class is valid if its
tags come in the same order on all its pages and lie inside one gap of the class
around it. Valid classes, nested, are the template; what lies between its tags are
slots. Slots in which all pages say the same are template text.

The main slot is the template's article (or main) element; where a template has
none, it is the deepest element that holds most of the text that differs between
the pages. Everything in it is extracted but menus, headers, footers, side bars,
notices, adverts, forms, scripts, styles and reader comments, which are known by
their element, role, class or id.

Groups come from a range partitioning by host and a hash, sorted by host: a host of
a third of all pages is spread over as many tasks as its rows need, and gets a
template for each group.

Text: character references are decoded, white space inside a block becomes one
space, blocks are joined by a line feed; `br` is white space.

Defined results: null or empty html, and pages without text, give an empty text.
A null url is a host of its own. Repeated pages are deduced from once and each
returned; an input column named like an output column is replaced.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.llm.common import fresh
from ledgerflow.llm.pieces import _schema_with, _with_column
from ledgerflow.llm.url_filter import host_of

GROUP = 32
# An element without a main tag is the main slot if it holds this share of the differing text.
MOST = 0.7

# Elements of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template svg".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub "
    "sup time tt u var wbr img br picture source".split()
)
# What neither ends a block nor closes one.
FLOWING = INLINE | RAW
SCOPE = frozenset("html body article section div main aside nav header footer table td th ul ol dl form fieldset blockquote figure details".split())
MAIN = frozenset(("article", "main"))
OUTER = frozenset("nav header footer aside form button select menu dialog head object audio video canvas datalist".split()) | RAW
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
# Words of class and id names that mark what is not main text.
MARKS = frozenset(
    "nav navbar navigation menu header masthead banner footer sidebar aside ad ads advert adverts advertisement advertisements adsense "
    "sponsor sponsored promo cookie cookies consent notice notices gdpr popup modal overlay newsletter subscribe subscription signup "
    "login share sharing social related recommended breadcrumb breadcrumbs comment comments disqus respond reply replies widget widgets "
    "toolbar pagination pager skip".split()
)

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|=)*+)>|([^<]++|<)", re.S
)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
NAME_PART = re.compile(r"[a-z0-9]+")


class Page:
    """Tags by path, and text runs with the elements they stand in."""

    def __init__(self, source: str):
        # An element is (tag, key, outer, main); its key is its tag with its classes and id.
        self.tags: list[str] = []
        self.runs: list[tuple[tuple, int, str]] = []
        stack: list[tuple] = []
        block, at, n = 0, 0, len(source)
        while at < n:
            m = TOKEN.match(source, at)
            if m is None:
                break
            at = m.end()
            close, tag, attributes, text = m.groups()
            if text is not None:
                self.runs.append((tuple(stack), block, text))
                continue
            if tag is None:
                continue
            tag = tag.lower()
            if tag not in FLOWING:
                block += 1
            if close:
                self._close(stack, tag)
                continue
            if tag == "br":
                self.runs.append((tuple(stack), block, " "))
            self._imply(stack, tag)
            element = self._element(stack, tag, attributes)
            self.tags.append(element[1])
            if tag in VOID or attributes.endswith("/") and tag not in SCOPE and tag != "p":
                continue
            if tag in RAW:
                end = re.compile(rf"</{tag}\b", re.I).search(source, at)
                at = end.start() if end else n
            stack.append(element)

    @staticmethod
    def _element(stack: list[tuple], tag: str, attributes: str) -> tuple:
        names, outer = [], tag in OUTER
        for m in ATTRIBUTE.finditer(attributes) if attributes.strip() else ():
            value = (m[2] or m[3] or m[4] or "").lower()
            if m[1].lower() == "role":
                outer = outer or value in ROLES
                names.append(f"@{value}")
            else:
                parts = NAME_PART.findall(value)
                outer = outer or tag not in ("html", "body") and not MARKS.isdisjoint(parts)
                names.extend(p for p in parts if not p.isdigit())
        main = tag in MAIN or "@main" in names
        key = (stack[-1][1] if stack else "") + "/" + ".".join([tag, *sorted(names)])
        return tag, key, outer, main

    @staticmethod
    def _close(stack: list[tuple], tag: str) -> None:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] == tag:
                del stack[i:]
                return
            if tag in INLINE and stack[i][0] not in INLINE or tag not in SCOPE and stack[i][0] in SCOPE:
                return

    @staticmethod
    def _imply(stack: list[tuple], tag: str) -> None:
        """Close what a start tag closes: paragraphs by blocks, items by items."""
        if tag in FLOWING:
            return
        same = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th"), "tr": ("tr",), "option": ("option",)}.get(tag, ("p",))
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in same:
                del stack[i:]
                return
            if stack[i][0] in SCOPE:
                return


def classes(pages: list[Page]) -> list[list[str]]:
    """Valid equivalence classes of the pages' tags, outermost first."""
    counts = [Counter(p.tags) for p in pages]
    vectors: dict[tuple, list[str]] = defaultdict(list)
    for key in dict.fromkeys(t for p in pages for t in p.tags):
        vectors[tuple(c[key] for c in counts)].append(key)
    # Most pages must have the class, else it says nothing about the template.
    able = {v: keys for v, keys in vectors.items() if 2 * sum(n > 0 for n in v) >= len(pages)}
    firsts = [{t: i for i, t in reversed(list(enumerate(p.tags)))} for p in pages]
    lasts = [{t: i for i, t in enumerate(p.tags)} for p in pages]
    out: list[list[str]] = []
    for vector, keys in sorted(able.items(), key=lambda x: (-sum(n > 0 for n in x[0]), sum(x[0]), -len(x[1]))):
        on = [k for k, n in enumerate(vector) if n]
        order = sorted(keys, key=firsts[on[0]].get)
        # Tags out of order on some page are not of this class.
        kept = [t for i, t in enumerate(order) if all(i == 0 or firsts[k][order[i - 1]] < firsts[k][t] for k in on)]
        if out:
            kept = [t for t in kept if _in_one_gap(t, out[0], on, firsts, lasts)]
        if kept:
            out.append(kept)
    return out


def _in_one_gap(tag: str, around: list[str], on: list[int], firsts: list[dict], lasts: list[dict]) -> bool:
    """All occurrences of a tag lie between the same two tags of the class around it, on every page."""
    gaps = set()
    for k in on:
        places = [firsts[k][t] for t in around if t in firsts[k]]
        first, last = firsts[k][tag], lasts[k][tag]
        before = sum(p < first for p in places)
        if before != sum(p < last for p in places):
            return False
        gaps.add(before)
    return len(gaps) == 1


def main_keys(pages: list[Page]) -> tuple[frozenset[str], set[tuple[str, str]]]:
    """Keys of the main elements, and (slot, text) that the template has on most pages."""
    template = {t for c in classes(pages) for t in c}
    said: Counter = Counter()
    for p in pages:
        said.update({(_slot(stack, template), text.strip()) for stack, _, text in p.runs if text.strip()})
    static = {x for x, n in said.items() if len(pages) > 2 and 2 * n > len(pages)}
    main = {e[1] for p in pages for stack, _, _ in p.runs for e in stack if e[3] and not e[2] and e[1] in template}
    if main:
        return frozenset(main), static
    mass: Counter = Counter()
    total = 0
    for p in pages:
        for stack, _, text in p.runs:
            if any(e[2] for e in stack) or (_slot(stack, template), text.strip()) in static:
                continue
            size = len(text.strip())
            total += size
            for e in stack:
                if e[1] in template:
                    mass[e[1]] += size
    most = [k for k, n in mass.items() if n >= MOST * total and k.rpartition("/")[2].partition(".")[0] not in INLINE | {"p", "li"}]
    return frozenset([max(most, key=lambda k: k.count("/"))] if total and most else []), static


def _slot(stack: tuple, template: set[str]) -> str:
    return next((e[1] for e in reversed(stack) if e[1] in template), "")


def text_of(page: Page, main: frozenset[str], static: set[tuple[str, str]]) -> str:
    # A page that the group's template does not fit has its own article or main element.
    if not any(e[1] in main for stack, _, _ in page.runs for e in stack):
        main = frozenset(e[1] for stack, _, _ in page.runs for e in stack if e[3] and not e[2])
        if not main:
            main = frozenset(e[1] for stack, _, _ in page.runs for e in stack if e[0] == "body") or frozenset([""])
    # Where no element is known to be the main one, what the template says everywhere is left out.
    template_text = {text for _, text in static} if all(k.rpartition("/")[2].partition(".")[0] in ("body", "") for k in main) else set()
    blocks: dict[int, list[str]] = {}
    for stack, block, text in page.runs:
        inside = next((i for i, e in enumerate(stack) if e[1] in main), 0 if "" in main else None)
        if inside is None or any(e[2] for e in stack[inside:]) or text.strip() in template_text and text.strip():
            continue
        blocks.setdefault(block, []).append(entities.unescape(text))
    lines = (" ".join("".join(parts).split()) for parts in blocks.values())
    return "\n".join(line for line in lines if line)


def extract_group(sources: list[str | None]) -> list[str]:
    """Main texts of pages of one host."""
    made = {s: Page(s) for s in dict.fromkeys(sources) if s}
    if not made:
        return ["" for _ in sources]
    main, static = main_keys(list(made.values()))
    texts = {s: text_of(p, main, static) for s, p in made.items()}
    return [texts.get(s, "") if s else "" for s in sources]


def extract(pages: DataFrame, url: str = "url", html: str = "html", to: str = "text") -> DataFrame:
    """The rows with the main texts of their pages; one shuffle of the pages."""
    host = F.coalesce(host_of(F.col(f"`{url}`")), F.lit(""))
    # Spreads even rows that agree in every column.
    salt = F.xxhash64(F.monotonically_increasing_id())
    parts = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by, spread = fresh(pages, "_host"), fresh(pages, "_salt")
    placed = pages.withColumns({by: host, spread: salt}).repartitionByRange(parts, by, spread).sortWithinPartitions(by)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts = batch.column(batch.schema.get_field_index(by)).to_pylist()
            sources = batch.column(batch.schema.get_field_index(html)).to_pylist()
            texts: list[str] = []
            while len(texts) < len(hosts):
                first = last = len(texts)
                while last < len(hosts) and last - first < GROUP and hosts[last] == hosts[first]:
                    last += 1
                texts.extend(extract_group(sources[first:last]))
            yield _with_column(batch, to, pa.array(texts, pa.string()))

    return placed.mapInArrow(run, _schema_with(placed, to, T.StringType())).drop(by, spread)
