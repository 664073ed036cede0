"""The main text of web pages: the article, without what markup or repetition on the host shows to be
something else.

A page is read into blocks in page order, each with the level of its place: 0 what markup shows not to
be the article (menus, headers, footers, sidebars, notices, adverts, forms, comments, hidden parts),
1 open, 2 the page's main part, 3 an article. Candidates are the blocks of the page's highest level.

Host suffix array. A page has two token streams, the words of its candidates and those of all its other
blocks. A suffix begins at every word of both, whatever the blocks, and is told apart by the hash of its
first 8 words: what distinct pages share, 8 words or more, is covered by the suffixes that begin in it, so
that longer prefixes would add nothing. All pages of a host put their suffixes together: equal prefixes
come next to each other by a shuffle on host and prefix, and are combined in the tasks before it, so that a
host with any share of the pages is spread over all tasks. A prefix is a repeat if distinct pages have it;
pages with the same longest candidate block, or the two longest, are copies of one article and count once.
Open candidates that repeats cover whole, or those within the block by half or more, are boilerplate and go:
a few words that follow a repeat of the block before are none. Blocks of a marked article are trusted
further, as articles quote each other and adverts quote articles: they go where half of the host's articles,
five at least, have them. A page that would lose everything is a copy of others and keeps its candidates.

Only open candidates are held against repeats. The suffixes of whatever else a host's pages hold are therefore
made for hosts with open candidates alone, by a second reading of their pages.

Defined results
- Block texts have their character references decoded (once), white space as single spaces, no ends;
  blocks are joined by an empty line. Line breaks and table cells are white space, rows are blocks.
- An article's own header is part of it, its footer is not. Of several articles all count.
- Unclosed and misnested tags, comments and attributes are read as browsers would, in essence; a page cut
  off anywhere is read up to there. Nothing is cut from a page however long it is.
- Null or empty html: the empty text. Null urls and urls without host belong to one host.
- Repeated rows: each its own result, and one page for the count of repeats. Empty tables: no rows. Other
  columns stay; the added column replaces one of its name.
"""

from __future__ import annotations

import html as references
import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from headway.llm.shared import settle

#: Words of the shortest repeat.
LONG = 8
#: A block of a marked article is boilerplate if this share of the host's articles, and so many, have it.
USUAL = 0.5
LEAST_ARTICLES = 5

OUTSIDE, OPEN, MAIN, ARTICLE = range(4)

#: Elements of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style xmp iframe noembed noframes textarea title".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search "
    "section summary table tbody tfoot thead tr ul".split()
)
CELLS = {"td", "th"}
CONTAINERS = (BLOCKS | CELLS | {"template", "object", "noscript", "svg", "math", "button", "select"}) - {"p", "hr"}
#: Elements that end an open one of the same group.
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": CELLS, "th": CELLS, "tr": {"tr", *CELLS}}
#: Elements that are never article text.
NOT_TEXT = set(
    "head nav footer aside form noscript template object svg math canvas audio video button select datalist "
    "dialog menu search".split()
)
NOT_TEXT_ROLES = set(
    "navigation banner contentinfo complementary search form menu menubar dialog alertdialog alert toolbar".split()
)
#: Parts of class names and ids that name something beside the article.
NOT_TEXT_NAMES = set(
    "ad ads adbox advert adverts advertisement advertising adsense sponsor sponsored promo promotion promoted banner "
    "cookie cookies consent gdpr notice notices disclaimer alert popup modal overlay newsletter subscribe subscription "
    "signup login menu nav navbar navigation breadcrumb breadcrumbs sidebar sidenav related recommended share sharing "
    "social comment comments commentlist disqus respond reply replies footer masthead topbar toolbar pagination pager".split()
)
#: Of these an article itself may bear a name and yet be none.
NOT_AN_ARTICLE = set("ad ads advert advertisement sponsored promo comment comments reply replies related recommended".split())
ARTICLE_NAMES = set(
    "article articlebody article-body article-content article-text post-content post-body entry-content story-body "
    "story-content".split()
)
MAIN_NAMES = set("main maincontent main-content".split())

TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    r"|<(?P<end>/?)(?P<tag>[A-Za-z][^\s/>]*)(?P<attributes>(?:[^>\"']++|\"[^\"]{0,9999}+\"|'[^']{0,9999}+')*+|[^>]*+)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
SPACE = re.compile(" ")
HOST = re.compile(r"\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)")
TELLING = re.compile(r"class|id|role|itemprop|hidden|style", re.I)


@lru_cache(maxsize=8192)
def level_of(tag: str, attributes: str) -> int | None:
    """The level that an element sets for what it holds; None: that of its parent."""
    found = {}
    if TELLING.search(attributes):
        for m in ATTRIBUTE.finditer(attributes):
            found.setdefault(m[1].lower(), (m[2] or m[3] or m[4] or "").lower())
    names = f"{found.get('class', '')} {found.get('id', '')}".split()
    roles = set(found.get("role", "").split())
    style = "".join(found.get("style", "").split())
    if tag in ("html", "body"):
        return None
    if tag in NOT_TEXT or roles & NOT_TEXT_ROLES or "hidden" in found or found.get("aria-hidden") == "true":
        return OUTSIDE
    if "display:none" in style or "visibility:hidden" in style:
        return OUTSIDE
    named = {p for n in names if not re.match("(?:has|with|no|is|not)[-_]", n) for p in [n, *re.split("[-_]+", n)]}
    is_main = tag == "main" or "main" in roles or bool(MAIN_NAMES & set(names))
    is_article = tag == "article" or "article" in roles or "articlebody" in found.get("itemprop", "").split()
    is_article = is_article or bool(ARTICLE_NAMES & set(names))
    if named & (NOT_AN_ARTICLE if is_article or tag == "main" else NOT_TEXT_NAMES):
        return OUTSIDE
    if is_article:
        return ARTICLE
    return MAIN if is_main else None


def blocks_of(page: str) -> list[tuple[int, str, bool]]:
    """(level, text, is all links) of the blocks of a page that hold text."""
    out: list[tuple[int, str, bool]] = []
    buffer: list[str] = []
    unlinked = False
    stack: list[tuple[str, int]] = []
    opened: dict[str, int] = {}
    level = OPEN

    def flush() -> None:
        nonlocal unlinked
        if buffer:
            text = " ".join("".join(buffer).split())
            if text:
                out.append((level, text, not unlinked))
            buffer.clear()
        unlinked = False

    def cut(size: int) -> None:
        nonlocal level
        if size < len(stack):
            before = stack[size - 1][1] if size else OPEN
            if before != level:
                flush()
            for tag, _ in stack[size:]:
                opened[tag] -= 1
            del stack[size:]
            level = before

    at, end = 0, len(page)
    while at < end:
        m = TOKEN.search(page, at)
        text = page[at : m.start() if m else end]
        if text:
            buffer.append(references.unescape(text) if "&" in text else text)
            unlinked = unlinked or (not opened.get("a") and not text.isspace())
        if m is None:
            break
        at = m.end()
        if m["tag"] is None:
            continue
        tag = m["tag"].lower()
        if tag in BLOCKS:
            flush()
        elif tag == "br" or tag in CELLS:
            buffer.append(" ")
        if m["end"]:
            if opened.get(tag):
                i = len(stack) - 1
                while stack[i][0] != tag and (tag in CONTAINERS or stack[i][0] not in CONTAINERS):
                    i -= 1
                if stack[i][0] == tag:
                    cut(i)
            continue
        if tag in VOID or m["attributes"].endswith("/") and tag not in CONTAINERS | RAW | {"p", "a", "span"}:
            continue
        if tag == "body":
            cut(0)
        if tag in BLOCKS or tag in CELLS:
            # A block ends an open paragraph, and what is open within a line; only what set a level stays.
            size = len(stack)
            while size and stack[size - 1][0] not in CONTAINERS:
                before = stack[size - 2][1] if size > 1 else OPEN
                if stack[size - 1][0] != "p" and stack[size - 1][1] != before:
                    break
                size -= 1
            cut(size)
            while stack and stack[-1][0] in SIBLINGS.get(tag, ()):
                cut(len(stack) - 1)
        if tag in RAW:
            close = re.compile(f"</{re.escape(tag)}(?=[\\s/>])|\\Z", re.I).search(page, at)
            at = close.start()
            continue
        sets = level_of(tag, m["attributes"])
        if tag == "header" and level < ARTICLE:
            sets = OUTSIDE
        inner = level if sets is None or level == OUTSIDE else sets if sets == OUTSIDE else max(level, sets)
        if inner != level:
            flush()
        stack.append((tag, inner))
        opened[tag] = opened.get(tag, 0) + 1
        level = inner
    flush()
    return out


def candidates(blocks: list[tuple[int, str, bool]]) -> list[int]:
    """Numbers of the blocks that may be article text."""
    best = max((level for level, _, _ in blocks), default=OUTSIDE)
    if best == OUTSIDE:
        return []
    # Open blocks that are nothing but links are menus.
    return [i for i, (level, _, links) in enumerate(blocks) if level == best and not (level == OPEN and links)]


def hashed(text: str) -> int:
    """Signed 64 bits."""
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def _windows(texts: list[str], long: int) -> Iterator[int]:
    """Hashes of the first `long` words of the suffixes of a stream, one for each word that has so many left."""
    stream = " ".join(texts)
    starts = [0, *(m.end() for m in SPACE.finditer(stream))]
    ends = [*(start - 1 for start in starts[1:]), len(stream)]
    # Fewer words: no pairs.
    for start, end in zip(starts, ends[long - 1 :], strict=False):
        yield hashed(stream[start:end])


def own_suffixes(blocks: list[tuple[int, str, bool]], long: int = LONG) -> Iterator[tuple[int, int, int, list[int]]]:
    """(level, first word, words, hashes) of the candidates: those of level OPEN have a suffix for each word,
    whose first words follow on each other; of marked articles whole blocks count, one at a time."""
    chosen = candidates(blocks)
    level = blocks[chosen[0]][0] if chosen else OUTSIDE
    if level == OPEN:
        found = list(_windows([blocks[i][1] for i in chosen], long))
        if found:
            yield OPEN, 0, long, found
        return
    at = 0
    for i in chosen:
        n = blocks[i][1].count(" ") + 1
        if n >= long:
            yield level, at, n, [hashed(blocks[i][1])]
        at += n


def other_suffixes(blocks: list[tuple[int, str, bool]], long: int = LONG) -> Iterator[int]:
    """Hashes of the suffixes of what is not held against repeats: blocks that are no candidates, and marked articles."""
    chosen = candidates(blocks)
    within = set(chosen)
    yield from _windows([text for i, (_, text, _) in enumerate(blocks) if i not in within], long)
    if chosen and blocks[chosen[0]][0] > OPEN:
        yield from _windows([blocks[i][1] for i in chosen], long)


def suffixes(blocks: list[tuple[int, str, bool]], long: int = LONG) -> Iterator[tuple[int, int, int, int]]:
    """(hash of a prefix, level of its place, first word, words) of the candidates of a page.

    First words are those of the candidates' stream.
    """
    for level, first, n, found in own_suffixes(blocks, long):
        for at, prefix in enumerate(found, first):
            yield prefix, level, at, n


def main_text(blocks: list[tuple[int, str, bool]], repeats: list[tuple[int, int]]) -> str:
    """The candidates that repeats (first word, words) do not cover whole, and of which those within them cover less
    than half."""
    texts = [blocks[i][1] for i in candidates(blocks)]
    if repeats:
        lengths = [text.count(" ") + 1 for text in texts]
        ends = list(accumulate(lengths))
        steps, inner = [0] * (ends[-1] + 1), [0] * (ends[-1] + 1)
        for at, n in repeats:
            for some in (steps, inner) if at + n <= ends[bisect_right(ends, at)] else (steps,):
                some[at] += 1
                some[at + n] -= 1
        covered, within = ([c > 0 for c in accumulate(some)] for some in (steps, inner))
        kept = [
            t
            for t, n, end in zip(texts, lengths, ends, strict=True)
            if not all(covered[end - n : end]) and 2 * sum(within[end - n : end]) < n
        ]
        texts = kept or texts
    return "\n\n".join(texts)


def host_hash(url: str | None) -> int:
    host = HOST.match(url or "")
    return hashed(host[1].lower()) if host else 0


def _read(pages: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """For each batch (page, host, first, second, blocks) of its pages that have text."""
    for batch in pages:
        found = []
        for key, url, page in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if page:
                blocks = blocks_of(page)
                longest = sorted((blocks[i][1] for i in candidates(blocks)), key=lambda t: (-len(t), t))
                first, second = (hashed(longest[i]) if len(longest) > i else key for i in range(2))
                found.append((key, host_hash(url), first, second, blocks))
        yield found


def _batch(rows: list[tuple], fields: dict[str, pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, fields.values(), strict=True)], list(fields))


OWN = "host long, first long, second long, page long, place int, at int, words int, prefixes array<long>"
OWN_FIELDS = {
    **dict.fromkeys(("host", "first", "second", "page"), pa.int64()),
    **dict.fromkeys(("place", "at", "words"), pa.int32()),
    "prefixes": pa.list_(pa.int64()),
}
OTHER = "host long, first long, second long, prefixes array<long>"
OTHER_FIELDS = {n: OWN_FIELDS[n] for n in ("host", "first", "second", "prefixes")}


def _own_rows(pages: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for read in _read(pages):
        rows = [(host, first, second, key, *own) for key, host, first, second, blocks in read for own in own_suffixes(blocks)]
        yield _batch(rows, OWN_FIELDS)


def _other_rows(pages: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for read in _read(pages):
        rows = [(host, first, second, list(set(other_suffixes(blocks)))) for _, host, first, second, blocks in read]
        yield _batch(rows, OTHER_FIELDS)


def host_of(url: Column) -> Column:
    @arrow_udf("long")
    def hosts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for urls in batches:
            yield pa.array(map(host_hash, urls.to_pylist()), pa.int64())

    return hosts(url)


def repeats_by_page(pages: DataFrame) -> DataFrame:
    """(page, repeats) of pages with candidates that a repeat of their host covers, for (page, url, html)."""
    own = settle(pages.select("page", "url", "html").mapInArrow(_own_rows, OWN), "host-suffixes")
    opened = own.where(F.col("place") == OPEN)
    # Written: Spark then knows how many hosts there are, and where they are few leaves the pages where they lie.
    hosts = settle(opened.select("host").distinct(), "open-hosts")
    others = pages.withColumn("host", host_of(F.col("url"))).join(hosts, "host", "left_semi").select("page", "url", "html")
    others = others.mapInArrow(_other_rows, OTHER)
    suffix = opened.select("host", "first", "second", "page", "words", F.posexplode("prefixes").alias("at", "prefix"))
    every = suffix.select("host", "prefix", "first", "second", F.lit(True).alias("open")).unionByName(
        others.select("host", F.explode("prefixes").alias("prefix"), "first", "second", F.lit(False).alias("open"))
    )
    distinct = (F.min("first") != F.max("first")) | (F.min("second") != F.max("second"))
    shared = every.groupBy("host", "prefix").agg(distinct.alias("distinct"), F.max("open").alias("open"))
    shared = settle(shared.where("distinct and open").select("host", "prefix"), "host-repeats")
    # Of marked articles: counted by article, which first stands for.
    marked = own.where(F.col("place") >= MAIN).withColumn("prefix", F.col("prefixes")[0])
    holders = marked.groupBy("host", "prefix", "first").agg(F.lit(1).alias("one")).groupBy("host", "prefix").count()
    articles = marked.groupBy("host", "first").agg(F.lit(1).alias("one")).groupBy("host").agg(F.count("*").alias("articles"))
    usual = holders.where(F.col("count") >= LEAST_ARTICLES).join(articles, "host").where(F.col("count") >= USUAL * F.col("articles"))
    usual = settle(usual.select("host", "prefix"), "host-usual")
    met = [df.join(some, ["host", "prefix"], "left_semi").select("page", "at", "words") for df, some in ((suffix, shared), (marked, usual))]
    # Copies of a page have the same repeats: a set.
    return met[0].unionByName(met[1]).groupBy("page").agg(F.collect_set(F.struct("at", "words")).alias("repeats"))


def extracted(page: Column, repeats: Column) -> Column:
    @arrow_udf("string")
    def extract(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for pages, found in batches:
            texts = []
            for one, some in zip(pages.to_pylist(), found.to_pylist(), strict=True):
                texts.append(main_text(blocks_of(one), [(r["at"], r["words"]) for r in some or []]) if one else "")
            yield pa.array(texts, pa.string())

    return extract(page, repeats)


def with_main_text(pages: DataFrame, url_col: str = "url", html_col: str = "html", text_col: str = "text") -> DataFrame:
    """Adds the main text of each page."""
    url, page = F.col(url_col).cast("string"), F.col(html_col).cast("string")
    key, found = ("_".join([name, *pages.columns]) for name in ("page", "repeats"))
    keyed = pages.withColumn(key, F.xxhash64(url, page))
    one = keyed.select(F.col(key).alias("page"), url.alias("url"), page.alias("html"))
    # Written: where few pages have repeats, Spark joins them without moving the pages.
    repeats = settle(repeats_by_page(one), "page-repeats").select(F.col("page").alias(key), F.col("repeats").alias(found))
    joined = keyed.join(repeats, key, "left")
    return joined.withColumn(text_col, extracted(page, F.col(found))).select(*dict.fromkeys([*pages.columns, text_col]))
