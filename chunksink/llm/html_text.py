"""Main text of web pages by two-pass block rules.

Pass one splits a page into blocks and classifies each by its place (menus,
forms, adverts and the like are out), length, stop-word density and, outside an
article, link density. Inside an article only names that leave no doubt are out. Short blocks stay undecided; pass two gives them the label of the
nearest decided neighbours in the same part of the page.

Null and empty pages have an empty text. Rows are judged one by one; other
columns pass through, and the output column replaces one of its name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from chunksink.llm.arrow import map_batches
from chunksink.llm.bpe import slices, with_column
from chunksink.llm.quality_rules import STOP_WORDS

LONG_WORDS = 12
LINK_DENSITY = 0.5
STOP_DENSITY = 0.12
_STOP = frozenset(STOP_WORDS)

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""", re.S)
_ATTRIBUTE = re.compile(r"""(class|id|role|aria-label|hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
_RAW = frozenset("script style title noscript template iframe svg math object textarea select option button noframes xmp canvas audio video head".split())
_BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul caption".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr b i em strong span font u small sup sub code".split())
#: Elements that the start of another ends, if they are the innermost open ones but for links.
_ENDS = {t: frozenset(["p"]) for t in _BLOCKS} | {
    "li": frozenset(["p", "li"]),
    **dict.fromkeys(("dt", "dd"), frozenset(["p", "dt", "dd"])),
    **dict.fromkeys(("td", "th"), frozenset(["p", "td", "th"])),
    "tr": frozenset(["p", "td", "th", "tr"]),
    **dict.fromkeys(("tbody", "thead", "tfoot"), frozenset(["p", "td", "th", "tr", "tbody", "thead", "tfoot"])),
}
_OUT_TAGS = frozenset("nav footer aside form menu dialog fieldset".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_OUT_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|advertising|adbox|adslot|sponsor(?:ed)?|promo(?:tion)?s?|banner|nav|navbar|navigation|menu|breadcrumbs?|sidebar|side|aside|widget|footer|site-?header|masthead|topbar|"
    r"cookies?|consent|gdpr|notice|alert|popup|modal|overlay|newsletter|subscribe|signup|login|search|share|sharing|social|related|recommend(?:ed|ations)?|comments?|commentlist|respond|replies|disqus|discussion|pagination|pager|tags|copyright|legal|skip)(?:$|[\s_\d-])",
    re.I,
)
#: Inside an article only whole class names that leave no doubt.
_OUT_INSIDE = re.compile(
    r"(?:^|\s)(?:ads?|adverts?|advertisements?|advertising|adbox|adslot|sponsor(?:ed)?|promo(?:tion)?s?|cookies?|consent|notice|newsletter|subscribe|sidebar|widget|nav|navbar|navigation|menu|breadcrumbs?|share|sharing|social|"
    r"comments?|commentlist|respond|replies|disqus|pagination|pager|popup|modal)(?:[_-](?:slot|box|unit|banner|bar|block|container|wrapper|wrap|list|section|area|form|buttons?|links?|items?|thread|notice|body|text|\d+))*(?=$|\s)"
    r"|(?:^|\s)(?:related|recommended)[_-](?:posts?|articles?|links?|stories|content)(?=$|\s)",
    re.I,
)
_MAIN_NAMES = re.compile(r"(?:^|[\s_-])(?:article|main|content|post|entry|story|body-?text|article-?body)(?:$|[\s_\d-])", re.I)
_OUT_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())


@dataclass
class Block:
    text: str
    linked: int
    heading: bool
    out: bool
    region: int  # 0: outside any article or main part
    keep: bool | None = None


def blocks_of(html: str) -> list[Block]:
    """Non-empty blocks in page order."""
    found: list[Block] = []
    stack: list[tuple[str, bool, int, bool, bool]] = []  # tag, out, region, link, heading
    out, region, link, heading, regions = False, 0, False, False, 0
    words: list[str] = []
    linked: list[str] = []

    def close() -> None:
        if words:
            text = " ".join(unescape("".join(words)).split())
            if text:
                found.append(Block(text, len(" ".join(unescape("".join(linked)).split())), heading, out, region))
            words.clear()
            linked.clear()

    at, skip = 0, ""
    low = html.lower()
    last: dict[str, int] = {}  # where the last end tag of a skipped element stands
    for m in _TOKEN.finditer(html):
        if m.start() < at:
            continue
        if not skip and m.start() > at:
            piece = html[at : m.start()]
            words.append(piece)
            if link:
                linked.append(piece)
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if skip:
            if (tag == skip and m[1]) or (skip == "head" and tag == "body"):
                skip = ""
            if tag != "body":
                continue
        if tag in _RAW:
            if not m[1] and not m[3].rstrip().endswith("/"):
                if tag in ("script", "style", "textarea", "title", "xmp"):
                    end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(html, at)
                    at = end.end() if end else len(html)
                else:
                    if tag not in last:
                        last[tag] = low.rfind(f"</{tag}")
                    if tag == "head" or last[tag] >= at:  # one that is never closed hides nothing
                        skip = tag
            continue
        if tag == "br" or tag in ("td", "th"):
            words.append(" ")
        if tag in _BLOCKS:
            close()
        if not m[1] and tag in _ENDS:
            k = len(stack)
            while k and (stack[k - 1][0] in _ENDS[tag] or stack[k - 1][0] == "a"):
                k -= 1
            if any(x[0] != "a" for x in stack[k:]):
                if out:
                    close()
                del stack[k:]
                _, out, region, link, heading = stack[-1] if stack else ("", False, 0, False, False)
        if m[1]:
            if any(x[0] == tag for x in stack):
                if out:
                    close()
                while stack[-1][0] != tag:
                    stack.pop()
                stack.pop()
                _, out, region, link, heading = stack[-1] if stack else ("", False, 0, False, False)
            continue
        if tag in _VOID:
            continue
        if tag in _HEADINGS:
            while stack and stack[-1][0] in _HEADINGS:
                stack.pop()
        _, out, region, link, heading = stack[-1] if stack else ("", False, 0, False, False)
        names, role, hidden = "", "", False
        for a in _ATTRIBUTE.finditer(m[3]):
            name, value = a[1].lower(), (a[2] or "").strip("\"'")
            if name in ("class", "id"):
                names += f" {value}"
            elif name == "role":
                role = value.lower()
            elif name == "hidden" or (name == "style" and re.search(r"display\s*:\s*none", value, re.I)):
                hidden = True
        sectioning = tag in _ENDS and tag not in ("body", "html", "article", "main")
        if tag in _OUT_TAGS or hidden or role in _OUT_ROLES or (sectioning and (_OUT_INSIDE if region else _OUT_NAMES).search(names)) or (tag == "header" and not region):
            out = True
        if not out and (tag in ("article", "main") or role in ("main", "article") or (sectioning and not region and _MAIN_NAMES.search(names))):
            if not region:
                regions += 1
            region = region or regions
        if out and tag in ("td", "th"):  # the cells before it are a block of their own
            ahead, out = out, stack[-1][1] if stack else False
            if ahead != out:
                close()
            out = ahead
        if tag == "article" and region and _OUT_NAMES.search(names):
            out = True
        stack.append((tag, out, region, link or tag == "a", heading or tag in _HEADINGS))
        _, out, region, link, heading = stack[-1]
    if not skip and at < len(html):
        words.append(re.sub(r"</?[a-zA-Z!][^<>]*\Z", "", html[at:]))  # a tag cut off by the end
    close()
    return found


def _nearest(blocks: list[Block], order: range) -> list[bool | None]:
    """Label of the last decided block of the same region that comes before each, in ``order``."""
    seen: dict[int, bool] = {}
    found: list[bool | None] = [None] * len(blocks)
    for k in order:
        b = blocks[k]
        found[k] = seen.get(b.region)
        if b.keep is not None and not b.out:
            seen[b.region] = b.keep
    return found


def classify(blocks: list[Block]) -> list[Block]:
    """Set ``keep`` on every block: clear cases first, then short ones from their neighbours."""
    has_region = any(b.region and not b.out for b in blocks)
    for b in blocks:
        words = b.text.split()
        density = b.linked / len(b.text)
        stops = sum(w.strip(".,;:!?\"'()").lower() in _STOP for w in words) / len(words)
        if b.out or (has_region and not b.region) or (density > LINK_DENSITY and not b.heading and not b.region):
            b.keep = False
        elif len(words) >= LONG_WORDS and (b.region or stops >= STOP_DENSITY):
            b.keep = True
    before, after = _nearest(blocks, range(len(blocks))), _nearest(blocks, range(len(blocks) - 1, -1, -1))
    for k, b in enumerate(blocks):
        if b.keep is not None:
            continue
        if b.heading and after[k] is not None:
            b.keep = after[k]
        else:
            seen = {x for x in (before[k], after[k]) if x is not None}
            b.keep = seen.pop() if len(seen) == 1 else bool(b.region)
    return blocks


def main_text(html: str | None) -> str:
    return "\n\n".join(b.text for b in classify(blocks_of(html or "")) if b.keep)


def extract(pages: DataFrame, html: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with ``out``, the main text of each whole page."""
    schema = T.StructType([*(f for f in pages.schema.fields if f.name != out), T.StructField(out, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, html):
                yield with_column(batch, out, pa.array([main_text(h) for h in batch.column(html).to_pylist()], pa.string()))

    return map_batches(pages, run, schema)
