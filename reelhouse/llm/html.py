"""Main text of web pages: rules for what no article holds, and removal of site templates.

A page is read into its tree once. Elements that are never content (menus, forms, scripts, adverts by their
name and so on) are left out, and where a page marks its article, only that counts. What is left is a list
of blocks of text, each with the hashes of the element subtrees that hold it. Spark counts on how many pages
of a host each hash occurs; subtrees that recur across many pages are the site's template and their blocks
go. Paragraphs and headings of a marked article stay even if they recur: copies of an article are articles.
"""

from __future__ import annotations

import re
from html import unescape

import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.llm.common import kept, map_rows, read

LEAST_PAGES = 5  # a template is on at least so many pages of its host,
LEAST_SHARE = 0.1  # and on this share of them
MOST_TEXT = 0.5  # an element with more of a page's text than this is not taken for a template

# Names of HTML elements, by how they behave.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript template iframe xmp noembed noframes".split())
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark meter q rp rt "
    "ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
NEVER = set(
    "head nav footer aside form button select option menu dialog svg canvas object audio video map "
    "fieldset datalist".split()
)
CLOSES_P = set(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
    "h6 header hr main menu nav ol p pre section table ul".split()
)
CLOSED_BY = {  # an open element of the first name ends where one of the second begins
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"},
    "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option", "optgroup"},
}
PARAGRAPHS = set("p h1 h2 h3 h4 h5 h6 pre blockquote li dd dt td th figcaption tr table ul ol dl tbody".split())
ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
NAMES = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies "
    "consent gdpr notice notices popup modal overlay sidebar aside nav navbar navigation menu breadcrumb "
    "breadcrumbs footer comment comments respond disqus share sharing social related recommended newsletter "
    "subscribe subscription signup login search widget pagination pager toolbar masthead".split()
)

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)(?:>|\Z)|([^<]+|<)",
    re.S,
)
NAMED = re.compile(r"""\b(class|id|role|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
SPLIT = re.compile(r"[^a-z0-9]+")


class Element:
    __slots__ = ("tag", "parent", "dropped", "root", "parts", "size", "hash", "inline")

    def __init__(self, tag: str, parent: Element | None, dropped: bool, root: bool, inline: bool):
        self.tag, self.parent, self.dropped, self.root, self.inline = tag, parent, dropped, root, inline
        self.parts: list[str] = []
        self.size = 0
        self.hash = 0


def _boilerplate(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in NEVER or (tag == "header" and not in_article):
        return True
    if attributes and tag not in ("html", "body", "article", "main"):
        for name, value in NAMED.findall(attributes):
            name, value = name.lower(), value.strip("\"'").lower()
            if name == "hidden" or (name == "aria-hidden" and value == "true"):
                return True
            if name == "role" and value in ROLES:
                return True
            if name in ("class", "id") and not NAMES.isdisjoint(SPLIT.split(value)):
                return True
    elif attributes and tag == "article":
        for name, value in NAMED.findall(attributes):
            if name.lower() in ("class", "id") and not {"comment", "comments"}.isdisjoint(SPLIT.split(value.lower())):
                return True
    return False


def blocks(html: str) -> list[tuple[str, list[int]]]:
    """The page's blocks of text outside boilerplate, each with the hashes of the subtrees that may be
    templates and hold it; of the marked articles only, or else of the main part, or of the whole page."""
    top = Element("", None, False, False, False)
    at = top
    found: list[tuple[list[str], Element, int]] = []  # text, innermost block element, kind of root
    current: list[str] | None = None
    position, size = 0, len(html)

    def kind(e: Element | None) -> int:
        best = 0
        while e is not None:
            if e.root:
                best = max(best, 2 if e.tag == "article" else 1)
            e = e.parent
        return best

    def close(e: Element) -> None:
        e.hash = xxhash.xxh3_64_intdigest("\x1f".join([e.tag, *e.parts])) - (1 << 63)
        if e.parent is not None:
            e.parent.parts.append("" if e.dropped else str(e.hash))
            e.parent.size += e.size

    while position < size:
        m = TOKEN.match(html, position)
        position = m.end()
        if m[4] is not None:
            raw = m[4]
            text = unescape(raw) if "&" in raw else raw
            if at.dropped:
                continue
            if current is None:
                if text.isspace():
                    continue
                holder = at
                while holder.inline:
                    holder = holder.parent
                current = []
                found.append((current, holder, kind(holder)))
            current.append(text)
            found[-1][1].parts.append(" ".join(text.split()))
            continue
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            e = at
            while e is not top and e.tag != tag:
                e = e.parent
            if e is not top:
                while True:
                    gone, at = at, at.parent
                    if not gone.inline:
                        current = None
                        close(gone)
                    if gone is e:
                        break
            elif tag in CLOSES_P:
                current = None
            continue
        if tag in VOID:
            if tag == "br" and current is not None:
                current.append(" ")
            elif tag == "hr":
                current = None
            continue
        if tag in RAW:
            end = re.compile(r"</%s[\s/>]" % re.escape(tag), re.I).search(html, position)
            if end is None:
                position = size
            else:
                position = html.find(">", end.end() - 1) + 1 or size
            continue
        ends = {"p"} if tag in CLOSES_P else set()
        ends |= {t for t, by in CLOSED_BY.items() if tag in by}
        if ends:
            e = at
            while e is not top and e.tag not in ends and (e.inline or e.tag in CLOSED_BY):
                e = e.parent
            if e is not top and e.tag in ends:
                while True:
                    gone, at = at, at.parent
                    if not gone.inline:
                        close(gone)
                    if gone is e:
                        break
        inline = tag in INLINE
        in_article = kind(at) > 0
        dropped = at.dropped or _boilerplate(tag, m[3], in_article)
        if not inline or (dropped and not at.dropped):
            current = None if not inline else current
        at = Element(tag, at, dropped, tag in ("article", "main") and not dropped, inline)
    while at is not top:
        gone, at = at, at.parent
        if not gone.inline:
            close(gone)

    best = max((k for _, _, k in found), default=0)
    cleaned = []
    for text, holder, k in found:
        said = " ".join("".join(text).split())
        if said and k == best:
            cleaned.append((said, holder))
            e = holder
            while e is not None:
                e.size += len(said)
                e = e.parent
    total = sum(len(said) for said, _ in cleaned)
    out = []
    for said, holder in cleaned:
        marks, e = [], holder
        while e is not None and e is not top:
            safe = e.root or e.tag in ("html", "body") or (best and e.tag in PARAGRAPHS)
            if not safe and e.size <= MOST_TEXT * total:
                marks.append(e.hash)
            e = e.parent
        out.append((said, marks))
    return out


def _parsed(df: DataFrame, key: str, url: str, html: str) -> DataFrame:
    def start():
        def work(rows: dict[str, list]) -> dict[str, list]:
            found = [blocks(h or "") for h in rows["_html"]]
            return {
                "_key": rows["_key"],
                "_url": rows["_url"],
                "_row": rows["_row"],
                "blocks": [[{"text": t, "marks": m} for t, m in page] for page in found],
            }

        return work

    kinds = {c: df.schema[c].dataType.simpleString() for c in (key, url)}
    rows = df.select(
        F.col(key).alias("_key"),
        F.col(url).alias("_url"),
        F.col(html).alias("_html"),
        F.xxhash64(key, url, html).alias("_row"),
    )
    schema = (
        f"_key {kinds[key]}, _url {kinds[url]}, _row bigint, "
        "blocks array<struct<text:string,marks:array<bigint>>>"
    )
    host = F.nullif(F.lower(F.regexp_extract("_url", r"(?i)^[a-z][a-z0-9+.-]*://([^/?#:]+)", 1)), F.lit(""))
    return map_rows(rows, start, schema).withColumn("_host", host)


def templates(parsed: DataFrame) -> DataFrame:
    """`_host`, `mark` (hash of a subtree) and `pages`, for subtrees that recur across many of its pages."""
    marks = F.array_distinct(F.flatten("blocks.marks"))
    sited = parsed.filter("_host is not null")
    counts = (
        sited.select("_host", F.explode(marks).alias("mark"))
        .groupBy("_host", "mark")
        .agg(F.count(F.lit(1)).alias("pages"))
        .filter(F.col("pages") >= LEAST_PAGES)
    )
    hosts = sited.groupBy("_host").agg(F.count(F.lit(1)).alias("_all"))
    return counts.join(hosts, "_host").filter(F.col("pages") >= LEAST_SHARE * F.col("_all")).drop("_all")


def extract(df: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """`key`, `url`, `text` and `n_chars` of every page.

    Null or empty html gives an empty text. A page without a host in its url has no template. Repeated rows
    give repeated rows; columns other than the three are not looked at; an empty table gives none.
    """
    parsed = kept(_parsed(df, key, url, html), "pages")
    marked = F.exists("blocks", lambda b: F.size(b.marks) > 0) & F.col("_host").isNotNull()
    some = parsed.filter(marked)
    found = (
        some.select("_row", "_host", F.explode(F.array_distinct(F.flatten("blocks.marks"))).alias("mark"))
        .distinct()
        .join(templates(parsed), ["_host", "mark"])
        .groupBy("_row")
        .agg(F.collect_list("mark").alias("_gone"))  # marks of one page
    )
    cleaned = some.join(found, "_row", "left").withColumn(
        "blocks",
        F.when(F.col("_gone").isNull(), F.col("blocks")).otherwise(
            F.filter("blocks", lambda b: ~F.arrays_overlap(b.marks, F.col("_gone")))
        ),
    )
    whole = parsed.filter(~marked | F.col("_host").isNull()).unionByName(cleaned.drop("_gone"))
    text = F.array_join("blocks.text", "\n\n")
    return whole.select(
        F.col("_key").alias(key), F.col("_url").alias(url), text.alias("text"), F.length(text).cast("long").alias("n_chars")
    )


def op4_site_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read(spark, sf_dir, "pages"))
