"""Main text of web pages by a site style tree.

Every page is parsed into branches: the path of element styles (tag and class) from the body to a block of text. Per host
the pages' branches are merged into one style tree with two entropies per node, to the base of the number of pages that
have the node: of the ways its children are laid out (presentation), and of its text blocks over pages (content). A block
found on k of m pages adds log k / log m; a node whose blocks recur everywhere has content importance 0, one whose blocks
are all new has 1. The importance of a branch is GAMMA times its content importance and 1 - GAMMA times its presentation
importance. Branches below LEVEL go. Hosts with fewer than LEAST_PAGES pages use the tree merged over all hosts.

Markup that says what it is goes first: navigation, page headers and footers, asides, forms, scripts, adverts, notices
and comments are no main text on any host. A class, id or role says so only as a whole: each word of a name has to be one
of HINTS or a word for a part of a page (PARTS), so "has-sidebar" says nothing; ids of headings are no hints. A hint or form
around the page's article or main doesn't count: it is a layout. The tree decides about all other branches. Inside article and
main no id or role and no class but that of a list of reader comments counts: there only those, elements that are never text (nav,
aside, footer and the like) and the host's own tree remove branches (found on at least LEAST_PAGES of its pages), and never all of a
page's: near copies of one article don't make it a template.

Identical pages count once in the tree, so copies don't make an article look like a template.

Defined results: null or empty html gives the empty text; broken markup is read as far as it can be told apart (an open
comment or script runs to the end); blocks keep page order and repeats; null urls share one host; repeated ids are
extracted each; an empty table gives none; other columns of the input stay, those named like an output are replaced.
"""

from __future__ import annotations

import html
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bloomline.llm.common import stored, without

GAMMA = 0.9
LEVEL = 0.4
LEAST_PAGES = 3
#: Low branches that are broadcast; with more of them the blocks are joined and regrouped instead.
BROADCAST_BRANCHES = 1_000_000

RAW = frozenset("script style noscript template textarea iframe svg noembed noframes".split())
START = re.compile(r"<(?:(!--)|(/?)([a-zA-Z][^\s/>]*)|[!?/])")
#: What ends the plain part of a tag: its end, or a quote that hides ends.
SPECIAL = re.compile(r"[>\"']")
CLASS = re.compile(r"""(?:^|\s)(class|id|role|hidden|style)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr "
    "math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom msub msup msubsup munder mover munderover "
    "mmultiscripts mtable mtr mtd semantics annotation".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSED_BY_BLOCK = "p"
SELF_CLOSING = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
DROPPED = frozenset("head title nav footer aside button select menu dialog datalist".split())
#: Fixed words: parts of class, id or role names of what is no article text.
HINTS = frozenset(
    "ad ads advert advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disqus footer login menu modal nav navbar navigation newsletter notice notices overlay pagination popup promo "
    "promoted recommended related replies reply respond search share sharing sidebar signup skip social sponsor "
    "sponsored subscribe subscription toolbar widget complementary contentinfo alert gdpr".split()
)
#: Fixed words: class names of reader comments, which count inside an article, too, and the elements that hold them.
COMMENTS = frozenset("comment comments disqus replies reply respond".split())
HOLDERS = frozenset("article aside div dl ol section ul".split())
PAGE_HINTS = frozenset("header masthead topbar banner".split())
#: Words that may stand beside a hint in one name, as in "comment-list".
PARTS = frozenset(
    "area articles bar block bottom box buttons container footer form header icons inner items left links list outer page "
    "panel posts right section site stories thread title top widget wrap wrapper".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that are dropped unless they hold the page's article or main.
WRAPS = frozenset("form fieldset".split())
MAIN = frozenset("article main".split())
WORDS = re.compile(r"[^a-z]+")
KEEP, DROP, OPEN = 0, 1, 2


def hints(value: str, words: frozenset[str]) -> bool:
    """Whether a name in the value says a role: one word of these, and others only of HINTS and PARTS."""
    for name in value.split():
        found = {w for w in WORDS.split(name) if w}
        if found & words and found <= words | HINTS | PARTS:
            return True
    return False


def layouts(mains: list[tuple[str, tuple[int, ...]]], told: set[int]) -> set[int]:
    """The hinted elements that hold the page's own article or main: those around each main with text, and around the
    articles with the fewest of them (others are teasers or comments)."""
    some = [mains[k] for k in told]
    least = min((len(around) for _, around in some), default=0)
    return {w for tag, around in some if tag == "main" or len(around) == least for w in around}


def tag_ends(page: str) -> Callable[[int], int]:
    """A function from a place inside a tag to where its `>` is (quotes hide it), or -1. Places where an end was looked for in vain are
    kept, so that a page of broken tags is read once, not once for each of them."""
    last = {c: page.rfind(c) for c in "\"'>"}
    vain: set[int] = set()
    asked, found = 0, -1  # what stands between them is plain

    def end(at: int) -> int:
        nonlocal asked, found
        seen = []
        while at <= last[">"]:
            if not asked <= at <= found:
                m = SPECIAL.search(page, at)
                asked, found = at, m.start() if m else len(page)
            here = found
            if here >= len(page) or here in vain:
                break
            if page[here] == ">":
                return here
            seen.append(here)
            if here >= last[page[here]]:
                break
            at = page.index(page[here], here + 1) + 1
        vain.update(seen)
        return -1

    return end


def tokens(page: str) -> Iterator[tuple[int, int, str | None, bool, str]]:
    """Start, end, tag (lower case; None: a comment, declaration, broken tag or raw element), whether it closes, and its attributes. A raw
    element is one token up to its closing tag or the end of the page."""
    tag_end, at = tag_ends(page), 0
    closing: dict[str, re.Pattern] = {}
    while m := START.search(page, at):
        start, tag = m.start(), (m[3] or "").lower()
        if m[1]:
            stop = page.find("-->", m.end())
            at = stop + 3 if stop >= 0 else len(page)
            yield start, at, None, False, ""
            continue
        if tag.strip("/") in RAW and not m[2]:
            stop = page.find(">", m.end())
            if stop >= 0:
                at = stop + 1
                if page[stop - 1] != "/":
                    ended = closing.setdefault(tag, re.compile(rf"</{re.escape(tag)}\s*>", re.I)).search(page, at)
                    at = ended.end() if ended else len(page)
                yield start, at, "", False, ""
                continue
        stop = tag_end(m.end()) if tag else -1
        if stop >= 0:
            at = stop + 1
            yield start, at, tag, bool(m[2]), page[m.end() : stop]
        elif tag and not m[2]:
            at = m.end()
        else:
            stop = page.find(">", m.end())
            at = stop + 1 if stop >= 0 else len(page)
            yield start, at, None, False, ""


def branches(page: str | None) -> list[tuple[int, str, str]]:
    """The page's blocks in order: kind (KEEP, DROP or OPEN), path and text."""
    page, found = page or "", []
    # tag, path, kind, the hinted elements around it, the article or main that it is in
    stack: list[tuple[str, str, int, tuple[int, ...], int]] = [("", "", OPEN, (), -1)]
    parts: list[str] = []
    mains: list[tuple[str, tuple[int, ...]]] = []
    hinted, at = 0, 0

    def flush() -> None:
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                found.append((*stack[-1][1:], text))
            parts.clear()

    def close(k: int) -> None:
        flush()
        del stack[k:]

    for start, after, tag, ends_one, rest in tokens(page):
        if start > at:
            parts.append(page[at:start])
        at = after
        if tag is None:
            continue
        if tag in ("", "br"):
            parts.append(" ")
        elif tag in INLINE:
            continue
        elif ends_one:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    close(k)
                    break
            else:
                flush()
        else:
            flush()
            ends = SELF_CLOSING.get(tag, ())
            if stack[-1][0] == CLOSED_BY_BLOCK or stack[-1][0] in ends:
                close(len(stack) - 1)
                if stack[-1][0] in ends and tag == "tr":
                    close(len(stack) - 1)
            if tag in VOID:
                continue
            style, hidden = tag, False
            _, _, kind, around, inside = stack[-1]
            names: list[str] = []
            classes: list[str] = []
            for name, value in CLASS.findall(rest) if rest else ():
                name, value = name.lower(), value.strip("\"'").lower()
                if name == "hidden" or name == "style" and re.search(r"display\s*:\s*none", value):
                    hidden = True
                elif name != "style":
                    if name != "id" or tag not in HEADINGS:
                        names.append(value)
                    if name == "class":
                        classes.append(value)
                        style = f"{tag}.{'.'.join(sorted(value.split()))}"
            if kind != DROP and tag not in ("html", "body"):
                if tag in DROPPED or hidden:
                    kind = DROP
                elif (
                    tag in WRAPS or kind == OPEN and any(hints(v, HINTS) for v in names)
                    or kind == KEEP and tag in HOLDERS and any(hints(v, COMMENTS) for v in classes)
                    or kind == OPEN and (tag == "header" or any(hints(v, PAGE_HINTS) for v in names))
                ):
                    around = (*around, hinted)
                    hinted += 1
                if kind != DROP and tag in MAIN:
                    kind, inside = KEEP, len(mains)
                    mains.append((tag, around))
            if not rest.endswith("/"):
                stack.append((tag, f"{stack[-1][1]}/{style}", kind, around, inside))
    if at < len(page):
        parts.append(page[at:])
    flush()
    told = {inside for _, kind, around, inside, _ in found if kind == KEEP and around == mains[inside][1]}
    free = layouts(mains, told)
    return [(kind if free.issuperset(around) else DROP, path, text) for path, kind, around, _, text in found]


def host_of(url: str | None) -> str:
    m = re.match(r"(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", url or "", re.I)
    return m[1].lower() if m else ""


def number(text: str) -> int:
    return xxhash.xxh64_intdigest(text) - (1 << 63)


def tree_rows(pages: DataFrame) -> DataFrame:
    """host, path, kind ("page", "text" or "layout"), value, page (the html's digest): each once per page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: set[tuple[str, str, str, int, int]] = set()
            for url, page in zip(batch.column("url").to_pylist(), batch.column("html").to_pylist(), strict=True):
                host, digest, kids = host_of(url), number(page or ""), {}
                for _, path, text in branches(page):
                    rows.add((host, path, "page", 0, digest))
                    rows.add((host, path, "text", number(text), digest))
                    kids.setdefault(path.rpartition("/")[0], []).append(path)
                for path, below in kids.items():
                    rows.add((host, path, "layout", number(" ".join(dict.fromkeys(below))), digest))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64())
            names = ["host", "path", "kind", "value", "page"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    schema = "host string, path string, kind string, value bigint, page bigint"
    return pages.select("url", "html").mapInArrow(run, schema)


def site_style_tree(pages: DataFrame) -> DataFrame:
    """host (null: all hosts), path, pages, content, presentation and importance of every branch of every site."""
    found = tree_rows(pages).distinct().groupBy("host", "path", "kind", "value").agg(F.count(F.lit(1)).alias("k"))
    found = stored(found, "html-tree")
    everywhere = (
        found.groupBy("path", "kind", "value")
        .agg(F.sum("k").alias("k"))
        .select(F.lit(None).cast("string").alias("host"), "path", "kind", "value", "k")
    )
    k = F.col("k").cast("double")
    texts, layouts = F.col("kind") == "text", F.col("kind") == "layout"
    sums = (
        found.unionByName(everywhere)
        .groupBy("host", "path")
        .agg(
            F.max(F.when(F.col("kind") == "page", k)).alias("pages"),
            F.sum(F.when(texts, F.log(k))).alias("text_logs"),
            F.count(F.when(texts, 1)).alias("texts"),
            F.sum(F.when(layouts, k)).alias("laid_out"),
            F.sum(F.when(layouts, k * F.log(k))).alias("layout_logs"),
        )
    )
    base = F.log(F.col("pages"))
    content = F.when(F.col("pages") > 1, 1 - F.col("text_logs") / F.col("texts") / base).otherwise(1.0)
    total = F.col("laid_out")
    layout = F.when(total > 1, (F.log(total) - F.col("layout_logs") / total) / F.log(total)).otherwise(F.when(total == 1, 1.0))
    return sums.select("host", "path", "pages", content.alias("content"), layout.alias("presentation")).withColumn(
        "importance", F.lit(GAMMA) * F.col("content") + F.lit(1 - GAMMA) * F.coalesce("presentation", "content")
    )


def low_branches(tree: DataFrame, level: float, least_pages: int) -> DataFrame:
    """host and path of the branches to remove, and whether the host's own tree says so."""
    told = tree.where(F.col("pages") >= least_pages).withColumn("low", F.col("importance") < level)
    own = told.where("host is not null and low").select("host", "path")
    every = told.where("host is null and low").select("path")
    small = tree.where((F.col("pages") < least_pages) & F.col("host").isNotNull()).select("host", "path")
    borrowed = small.join(every, "path", "left_semi").withColumn("own", F.lit(False))
    return own.withColumn("own", F.lit(True)).unionByName(borrowed)


def chosen(blocks: list[tuple[int, str, str]], host: str, removed: dict[int, bool]) -> list[str]:
    """The texts of a page's blocks that stay; removed: the low branches, and whether the host's own tree says so."""
    low = [removed.get(number(f"{host}\n{path}")) if kind != DROP else None for kind, path, _ in blocks]
    some = any(kind == KEEP and not own for (kind, _, _), own in zip(blocks, low, strict=True))
    return [
        text
        for (kind, _, text), own in zip(blocks, low, strict=True)
        if kind == KEEP and (not own or not some) or kind == OPEN and own is None
    ]


def main_text(
    pages: DataFrame, url_col: str = "url", html_col: str = "html", level: float = LEVEL, least_pages: int = LEAST_PAGES,
    broadcast_branches: int = BROADCAST_BRANCHES,
) -> DataFrame:
    """pages with text."""
    source = pages.select(F.col(f"`{url_col}`").alias("url"), F.col(f"`{html_col}`").alias("html"))
    low = stored(low_branches(site_style_tree(source), level, least_pages), "html-low")
    base = without(pages, ["text"])
    if low.count() > broadcast_branches:
        return _joined(base, low, url_col, html_col)
    keys = low.toArrow()
    gone = [number(f"{h}\n{p}") for h, p in zip(keys["host"].to_pylist(), keys["path"].to_pylist(), strict=True)]
    shared = pages.sparkSession.sparkContext.broadcast((np.array(gone, np.int64), np.array(keys["own"].to_pylist(), bool)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        removed = dict(zip(*(x.tolist() for x in shared.value), strict=True))
        for batch in batches:
            texts = []
            for url, page in zip(batch.column(url_col).to_pylist(), batch.column(html_col).to_pylist(), strict=True):
                texts.append("\n".join(chosen(branches(page), host_of(url), removed)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "text"])

    return base.mapInArrow(run, base.withColumn("text", F.lit("")).schema)


def _joined(base: DataFrame, low: DataFrame, url_col: str, html_col: str) -> DataFrame:
    """The same by joins, for more low branches than may be broadcast."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (i, host_of(url), k, kind == KEEP, path, text)
                for i, url, page in zip(*(batch.column(c).to_pylist() for c in ("row", url_col, html_col)), strict=True)
                for k, (kind, path, text) in enumerate(branches(page))
                if kind != DROP
            ]
            columns = list(zip(*rows, strict=True)) or [()] * 6
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.bool_(), pa.string(), pa.string())
            names = ["row", "host", "k", "sure", "path", "block"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    numbered = stored(base.withColumn("row", F.monotonically_increasing_id()), "html-rows")
    schema = "row bigint, host string, k bigint, sure boolean, path string, block string"
    blocks = numbered.select("row", url_col, html_col).mapInArrow(run, schema)
    marked = blocks.join(low, ["host", "path"], "left").where("sure or own is null").withColumn("gone", F.coalesce("own", F.lit(False)))
    texts = marked.groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("k", "block", "gone"))).alias("b"), F.bool_or(F.expr("sure and not gone")).alias("some")
    )
    joined = numbered.join(texts, "row", "left")
    stay = F.transform(F.filter("b", lambda x: ~x.gone | ~F.col("some")), lambda x: x.block)
    return joined.withColumn("text", F.coalesce(F.array_join(stay, "\n"), F.lit(""))).drop("row", "b", "some")
