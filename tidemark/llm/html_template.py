"""Main text of web pages by equivalence-class template deduction.

Pages of one host come from few templates. A page's tokens are its elements (by their path from
the root, with class) and its text blocks (by path and text).

1. **Occurrence vectors.** How often a token stands on each page of its host. A vector is held as
   its number of pages, its sum and a hash sum over (page, count), so it is an ordinary aggregate:
   a host with a third of all pages is pre-aggregated in every task and never gathered.
2. **Equivalence classes.** Tokens of a host with the same vector. A class is valid if it holds at
   least two tokens and stands on at least ``LEAST_SHARE`` of at least ``LEAST_PAGES`` pages.
3. **Template.** Valid classes are nested along their paths. The root class stands once on every
   page; its elements bound the slots. The main slot is that of an article or main element, or
   else the deepest element of the root class with ``MAIN_SHARE`` of the text. Text blocks of the
   root class are template text.
4. **Extraction.** From each page the blocks in the main slot that are neither template text nor
   in menus, forms, notices, adverts, comments and the like. Hosts without a template, and pages
   that do not have the main slot, are read by their own structure in the same way.

Defined results: NULL html is empty text; pages without URL form one host; broken markup is read
as browsers do for the cases here (paragraphs and list items close each other, end tags close what
stands open inside, stray end tags count for nothing, ``<`` without a name is text); repeated pages
count as pages of their host; an empty table gives no rows; extra columns are ignored; very long
pages are read whole in linear time.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.operators.sizing import estimated_bytes
from tidemark.llm.tables import spread, stage

LEAST_PAGES = 3
LEAST_SHARE = 0.5
MAIN_SHARE = 0.6
# Text found once on every page is template text only where this many pages agree.
TEXT_PAGES = 10
# Host templates up to this size are sent to all tasks; beyond, pages and templates are joined.
BROADCAST_BYTES = 32 * 1024 * 1024
TOKENS_AT_ONCE = 200_000

# Elements of HTML by what they do to text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset("script style template noscript iframe svg object canvas math audio video head".split())
RAW = frozenset("script style template noscript iframe svg title textarea".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead "
    "tr ul head title select option button textarea label legend".split()
)
BOILERPLATE = frozenset("nav aside footer form menu dialog select option button textarea label legend".split())
MAIN = ("article", "main")
# Words of class, id and role names that mark what is not the article.
HINTS = frozenset(
    "ad ads advert advertisement advertising banner breadcrumb breadcrumbs comment comments complementary consent "
    "contentinfo cookie cookies disclaimer disqus footer masthead menu nav navbar navigation newsletter notice pagination "
    "popup promo promoted recommended related respond replies share sharing sidebar signup social sponsor sponsored subscribe "
    "toolbar widget".split()
)
# An element of the left closes an open one of the right.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
LISTS = frozenset("ul ol dl table menu select body article main div section nav".split())

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",
    re.S,
)
_NAMES = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_WORD = re.compile(r"[a-z]+")


@dataclass
class Page:
    """Blocks in page order as (path, text), and how often each element path opens."""

    blocks: list[tuple[str, str]] = field(default_factory=list)
    elements: dict[str, int] = field(default_factory=dict)


def _label(tag: str, attributes: str) -> str:
    """Tag with its class, id and role words; ``!`` marks what is not the article."""
    words = sorted({w for found in _NAMES.findall(attributes) for w in _WORD.findall(found.lower())}) if attributes else []
    mark = "!" if tag in BOILERPLATE or not HINTS.isdisjoint(words) else ""
    return mark + ".".join([tag, *words])


def read_page(html: str | None) -> Page:
    page = Page()
    if not html:
        return page
    stack: list[tuple[str, str]] = []  # (tag, path)
    text: list[str] = []
    dropped = 0

    def flush() -> None:
        if text:
            block = " ".join(unescape("".join(text)).split())
            if block:
                page.blocks.append((stack[-1][1] if stack else "", block))
            text.clear()

    def pop_to(place: int) -> None:
        nonlocal dropped
        dropped -= sum(tag in DROPPED for tag, _ in stack[place:])
        del stack[place:]

    at = 0
    while True:
        found = _MARKUP.search(html, at)
        if not dropped and (found is None or found.start() > at):
            text.append(html[at : found.start() if found else len(html)])
        if found is None:
            break
        at = found.end()
        name = found[2] or found[5]
        if name is None:
            continue
        tag = name.lower()
        closing = bool(found[1] or found[4])
        if tag == "br":
            text.append(" ")
            continue
        if tag not in BLOCKS and tag not in DROPPED:
            continue  # inline: its text goes on
        flush()
        if closing:
            place = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
            if place is not None:
                pop_to(place)
            continue
        if tag in VOID:
            continue
        closed = CLOSES.get(tag, ())
        for i in range(len(stack) - 1, -1, -1):
            open_tag = stack[i][0]
            if open_tag in closed or open_tag == "p":
                pop_to(i)
            elif open_tag in LISTS or not closed:
                break
        attributes = found[3] if found[2] else found[6]
        path = f"{stack[-1][1] if stack else ''}/{_label(tag, attributes)}"
        page.elements[path] = page.elements.get(path, 0) + 1
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(html, at)
            at = end.end() if end else len(html)
            continue
        if attributes.endswith("/") and tag in DROPPED:
            continue
        stack.append((tag, path))
        dropped += tag in DROPPED
    flush()
    return page


def _hash(text: str) -> int:
    value = xxhash.xxh64_intdigest(text)
    return value - (1 << 64) if value >> 63 else value


def block_token(path: str, text: str) -> int:
    return _hash(f"{path}\0{text}")


def page_tokens(page: Page) -> dict[int, tuple[int, str | None, int]]:
    """Token -> (count, path of an element or None, characters of article-like text inside)."""
    inside: dict[str, int] = {}
    tokens: dict[int, tuple[int, str | None, int]] = {}
    for path, text in page.blocks:
        token = block_token(path, text)
        tokens[token] = (tokens.get(token, (0,))[0] + 1, None, 0)
        if "/!" not in path:
            while path:
                inside[path] = inside.get(path, 0) + len(text)
                path = path.rpartition("/")[0]
    for path, count in page.elements.items():
        tokens[_hash(path)] = (count, path, inside.get(path, 0))
    return tokens


def main_rank(path: str) -> int:
    """2 for the slot of an article or main element, 1 for another element, 0 for none at all."""
    label = path.rpartition("/")[2]
    if "/!" in path:
        return 0
    return 2 if label.split(".")[0] in MAIN or ".main" in label else 1


def own_main(page: Page) -> str:
    """Main slot of a page on its own."""
    inside = {path: chars for _, path, chars in page_tokens(page).values() if path and main_rank(path)}
    total = max(inside.values(), default=0)
    marked = [p for p in inside if main_rank(p) == 2 and page.elements[p] == 1 and inside[p] > 0]
    if marked:
        return min(marked, key=lambda p: (-inside[p], p.count("/"), p))
    large = [p for p, chars in inside.items() if chars >= MAIN_SHARE * total > 0 and page.elements[p] == 1]
    return max(large, key=lambda p: (p.count("/"), p), default="")


def main_text(page: Page, main: str | None, template_text: frozenset[int] | set[int]) -> str:
    """Blocks of the main slot without template text and boilerplate, joined by one space."""
    if main is None or main not in page.elements:
        main = own_main(page)
    kept = []
    for path, text in page.blocks:
        if main and not (path == main or path.startswith(main + "/")):
            continue
        below = path[len(main) :]
        if "/!" in below or "/!" in main or (not main and "/header" in below):
            continue
        if template_text and block_token(path, text) in template_text:
            continue
        kept.append(text)
    return " ".join(kept)


# ---------------------------------------------------------------- Spark


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url.cast("string"), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))


PAGE_TOKEN = 0  # stands once on every page


def token_vectors(pages: DataFrame) -> DataFrame:
    """Occurrence vectors: ``host``, ``token``, ``path``, ``pages``, ``total``, ``signature``, ``chars``."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[tuple[str, int], list] = {}

        def rows() -> pd.DataFrame:
            out = [(*key, *value) for key, value in seen.items()]
            seen.clear()
            return pd.DataFrame(out, columns=["host", "token", "path", "pages", "total", "signature", "chars"])

        for batch in batches:
            for page_id, host, html in zip(batch["page_id"], batch["host"], batch["html"]):
                # repeated pages have equal marks; that leaves equal vectors equal
                mark = _hash(str(page_id))
                found = page_tokens(read_page(html))
                found[PAGE_TOKEN] = (1, None, 0)
                for token, (times, path, chars) in found.items():
                    signature = mark * times
                    entry = seen.get((host, token))
                    if entry is None:
                        seen[(host, token)] = [path, 1, times, signature, chars]
                    else:
                        entry[1] += 1
                        entry[2] += times
                        entry[3] += signature
                        entry[4] += chars
                if len(seen) > TOKENS_AT_ONCE:
                    for entry in seen.values():
                        entry[3] = _wrapped(entry[3])
                    yield rows()
            for entry in seen.values():
                entry[3] = _wrapped(entry[3])
        yield rows()

    schema = "host string, token long, path string, pages long, total long, signature long, chars long"
    vectors = pages.select("page_id", "host", F.col("html").cast("string").alias("html")).mapInPandas(count, schema)
    # sums of signatures wrap around; as two halves they stay below the range of a long
    low, high = F.col("signature").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("signature", 32)
    return vectors.groupBy("host", "token").agg(
        F.max("path").alias("path"),
        F.sum("pages").alias("pages"),
        F.sum("total").alias("total"),
        F.struct(F.pmod(F.sum(low), F.lit(1 << 40)), F.pmod(F.sum(high), F.lit(1 << 32))).alias("signature"),
        F.sum("chars").alias("chars"),
    )


def _wrapped(value: int) -> int:
    value &= (1 << 64) - 1
    return value - (1 << 64) if value >> 63 else value


def deduce_templates(vectors: DataFrame) -> DataFrame:
    """One row per host with a template: ``host``, ``main``, ``template_text`` (tokens)."""
    whole = vectors.filter(F.col("token") == PAGE_TOKEN).select(
        "host", F.col("pages").alias("host_pages")
    )
    vectors = vectors.filter(F.col("token") != PAGE_TOKEN).join(whole, "host").filter(
        (F.col("host_pages") >= LEAST_PAGES) & (F.col("pages") >= LEAST_SHARE * F.col("host_pages"))
    )
    # what stands on half of a host's pages is bounded by twice the tokens of a page
    alike = Window.partitionBy("host", "pages", "total", "signature")
    valid = vectors.withColumn("_size", F.count(F.lit(1)).over(alike)).filter(F.col("_size") >= 2)
    root = valid.filter((F.col("pages") == F.col("host_pages")) & (F.col("total") == F.col("host_pages")))
    label = F.element_at(F.split("path", "/"), -1)
    marked = F.split(label, r"\.")[0].isin(*MAIN) | F.contains(label, F.lit(".main"))
    usable = F.col("path").isNotNull() & ~F.contains("path", F.lit("/!")) & (F.col("chars") > 0)
    depth = F.size(F.split("path", "/"))
    most = F.max(F.when(usable, F.col("chars"))).over(Window.partitionBy("host"))
    rated = root.withColumn("_most", most).withColumn(
        "_rank",
        F.when(usable & marked, F.struct(F.lit(2).alias("a"), F.col("chars").alias("b"), (-depth).alias("c"), F.col("path").alias("d")))
        .when(
            usable & (F.col("chars") >= MAIN_SHARE * F.col("_most")),
            F.struct(F.lit(1).alias("a"), depth.cast("long").alias("b"), F.lit(0).alias("c"), F.col("path").alias("d")),
        ),
    )
    fixed = F.when(F.col("path").isNull() & (F.col("host_pages") >= TEXT_PAGES), F.col("token"))
    return rated.groupBy("host").agg(F.max("_rank")["d"].alias("main"), F.collect_set(fixed).alias("template_text"))


def extract(pages: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars`` of every page."""
    hosted = spread(pages.select("page_id", F.col("url").cast("string"), host_of(F.col("url")).alias("host"), F.col("html").cast("string")))
    templates = stage(deduce_templates(stage(token_vectors(hosted), "token-vectors")), "templates")
    small = estimated_bytes(templates) <= broadcast_bytes
    joined = hosted.join(F.broadcast(templates) if small else templates, "host", "left")

    def take(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [
                main_text(read_page(html), main, frozenset() if fixed is None else frozenset(fixed))
                for html, main, fixed in zip(batch["html"], batch["main"], batch["template_text"])
            ]
            yield batch[["page_id", "url"]].assign(text=texts, n_chars=[len(t) for t in texts])

    kind = pages.schema["page_id"].dataType.simpleString()
    rows = joined.select("page_id", "url", "html", "main", "template_text")
    return rows.mapInPandas(take, f"page_id {kind}, url string, text string, n_chars long")
