"""HTML extraction with nearest-URL page differencing (operator 3).

A page is read into text lines, one per block, each with the zone it stands in: boilerplate (menus, headers,
footers, sidebars, notices, adverts, forms, comments), the article (inside `article` or `main`), or other.
Pages of one host are ordered by URL path, and each is paired with the neighbour whose path agrees longest.
The two pages' lines are aligned by their longest common subsequence, and shared lines are deleted, since a
template repeats from page to page and an article doesn't. Three rules guard articles: boilerplate goes whether
shared or not, lines of a marked article stay (mirrored articles are shared in full), and a page without a
marked article keeps its lines if its neighbour shares nearly all of them.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.session import scratch_path

MOST_BITS = 1 << 26  # of the rows that an alignment keeps: 8 MB
MIRROR = 0.9  # of the lines of a page shared: a copy of the page, not a template
BOILER, OTHER, ARTICLE = 0, 1, 2

_OTHER = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)", re.S)
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_TAG_SIGN = re.compile(r"[>\"']")
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:-]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_BLANK = re.compile(r"\s+")
# fixed names of HTML elements
RAW = {"script", "style", "template", "noscript", "textarea", "title", "iframe", "svg", "math", "object", "canvas", "select", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
DROP = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "head"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure",
    "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr", "html", "li", "main", "menu", "nav", "ol", "option", "p", "pre", "section",
    "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
# fixed words of class, id, role and aria-label that mark boilerplate
MARKS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "cookie", "cookies", "disclaimer",
    "disqus", "footer", "gdpr", "header", "login", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "popup", "promo", "promotion",
    "related", "replies", "share", "sharing", "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget", "contentinfo", "complementary", "search",
}
# fixed words that say what kind of box a mark stands for, in names like `related-posts` or `social-links`
BOXES = {
    "area", "articles", "bar", "block", "body", "box", "btn", "button", "buttons", "column", "container", "content", "field", "form", "group", "holder", "icons", "inner", "item",
    "items", "label", "link", "links", "list", "main", "message", "outer", "overlay", "panel", "posts", "row", "section", "slot", "stories", "text", "thread", "top", "bottom", "left",
    "right", "unit", "wrap", "wrapper", "zone",
}
#: A name that begins so speaks of the element's surroundings or of the article's own parts.
NOT_OWN = {"has", "with", "without", "no", "not", "is", "entry", "post", "article", "story", "content", "title", "page", "hide"}
#: Elements that hold the article, or its headings; their names mark nothing.
HOLDERS = {"html", "body", "main", "article", "h1", "h2", "h3", "h4", "h5", "h6"}
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def _names_boilerplate(name: str) -> bool:
    """Whether a class, an id or a label names boilerplate: by its last word, or by its first before words for boxes."""
    words = [w.lower() for w in _WORD.findall(name)]
    if not words or words[0] in NOT_OWN:
        return False
    return words[-1] in MARKS or words[0] in MARKS and all(w in BOXES or w in MARKS for w in words[1:])


def _marked(element: str, attributes: str) -> bool:
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), a or b or c
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return True
        if element in HOLDERS:
            continue
        if name in ("class", "role") and any(_names_boilerplate(x) for x in value.split()):
            return True
        if name in ("id", "aria-label") and _names_boilerplate(value):
            return True
    return False


_RAW_END = {name: re.compile(rf"</{name}\s*>|\Z", re.I) for name in RAW}


class _Tokens:
    """The pieces of a page, one after the other: comments and declarations, tags, texts. Each sign is read a few times at most."""

    def __init__(self, source: str):
        self.source = source
        self.last = {sign: source.rfind(sign) for sign in ">\"'"}

    def _tag_end(self, at: int) -> int:
        """Behind the sign that closes the tag at `at`, 0 if none does. Quoted signs don't, unless a quote stays open."""
        if at > self.last[">"]:
            return 0
        place = at
        while sign := _TAG_SIGN.search(self.source, place):
            if sign[0] == ">":
                return sign.end()
            if sign.start() >= self.last[sign[0]]:  # the quote stays open
                break
            place = self.source.find(sign[0], sign.end()) + 1
        return self.source.find(">", at) + 1

    def next(self, at: int) -> tuple[str, str, str, int]:
        """kind ("text", "tag" or "none"), name of the tag, content, and where the piece ends."""
        source = self.source
        if source[at] != "<":
            end = source.find("<", at)
            end = len(source) if end < 0 else end
            return "text", "", source[at:end], end
        if source.startswith(("<!--", "<![CDATA["), at):
            found = _OTHER.match(source, at)
            text = found[0][9:].removesuffix("]]>") if found[0].startswith("<![CDATA[") else ""
            return ("text" if text else "none"), "", text, found.end()
        if name := _NAME.match(source, at):
            if end := self._tag_end(name.end()):
                return "tag", name[1].lower(), source[at:end], end
        elif source.startswith(("<!", "<?"), at) and at < self.last[">"]:
            return "none", "", "", source.find(">", at) + 1
        return "text", "", "<", at + 1


def read_lines(source: str | None) -> list[tuple[str, int]]:
    """(line, zone) of every block with text, in page order. A null or empty page has none.

    Unclosed elements end where their parent ends; what follows the last complete tag is text.
    """
    out: list[tuple[str, int]] = []
    stack: list[tuple[str, int]] = []  # open elements, and the zone outside them
    zone, text, at = OTHER, [], 0
    source = source or ""

    def close_line() -> None:
        if text:
            line = _BLANK.sub(" ", html.unescape("".join(text))).strip()
            if line:
                out.append((line, zone))
            text.clear()

    tokens = _Tokens(source)
    while at < len(source):
        kind, name, piece, at = tokens.next(at)
        if kind != "tag":
            text.append(piece)
            continue
        closing = piece[1] == "/"
        if name in RAW and not closing:
            if not piece.endswith("/>"):
                end = _RAW_END[name].search(source, at)
                at = end.end()
            text.append(" ")
            continue
        if name == "br":
            text.append(" ")
            continue
        if name in BLOCK:
            close_line()
        if closing:
            if any(n == name for n, _ in stack):
                while True:
                    n, before = stack.pop()
                    if n in DROP or before != zone or n == name:
                        close_line() if before != zone else None
                        zone = before
                    if n == name:
                        break
            continue
        if name in VOID or piece.endswith("/>"):
            continue
        if name == "p":
            while stack and stack[-1][0] in ("p", "b", "i", "em", "strong", "a", "span", "font", "u"):
                if not any(n == "p" for n, _ in stack):
                    break
                zone = stack.pop()[1]
        elif name in ("li", "tr", "td", "th", "dd", "dt", "option") and stack and stack[-1][0] == name:
            zone = stack.pop()[1]
        inner = zone
        if zone != BOILER:
            if name in DROP or _marked(name, piece[1 + len(name) : -1]):
                inner = BOILER
            elif name in ("article", "main"):
                inner = ARTICLE
        if inner != zone:
            close_line()
        stack.append((name, zone))
        zone = inner
    close_line()
    return out


def _steps(x: list, y: list) -> list[int]:
    """After each line of `x`, one number whose bit j is 0 where a common subsequence with y[: j + 1] is longer than with y[:j]."""
    where: dict[int, int] = {}
    for j, line in enumerate(y):
        where[line] = where.get(line, 0) | 1 << j
    full = (1 << len(y)) - 1
    rows = [full]
    for line in x:
        v = rows[-1]
        hit = v & where.get(line, 0)
        rows.append(((v + hit) | (v - hit)) & full)
    return rows


def _lengths(x: list, y: list) -> np.ndarray:
    """Length of a longest common subsequence of `x` with every beginning of `y`, keeping one number at a time."""
    where: dict[int, int] = {}
    for j, line in enumerate(y):
        where[line] = where.get(line, 0) | 1 << j
    full = v = (1 << len(y)) - 1
    for line in x:
        hit = v & where.get(line, 0)
        v = ((v + hit) | (v - hit)) & full
    bits = np.unpackbits(np.frombuffer(v.to_bytes(len(y) // 8 + 1, "little"), np.uint8), bitorder="little")[: len(y)]
    return np.append(0, np.cumsum(1 - bits.astype(np.int64)))


def _common(x: list, y: list, shift: int) -> list[int]:
    """Indexes of `x`, plus `shift`, of a longest common subsequence; long ones are halved where both halves give most."""
    if not x or not y:
        return []
    if len(x) * len(y) > MOST_BITS and len(x) > 1:
        mid = len(x) // 2
        both = _lengths(x[:mid], y) + _lengths(x[mid:][::-1], y[::-1])[::-1]
        k = int(both.argmax())
        return _common(x[:mid], y[:k], shift) + _common(x[mid:], y[k:], shift + mid)
    rows, found = _steps(x, y), []
    i, j = len(x), len(y)
    while i and j:
        if rows[i] >> (j - 1) & 1:
            j -= 1
        elif not rows[i - 1] >> (j - 1) & 1:
            i -= 1
        else:
            found.append(shift + i - 1)
            i, j = i - 1, j - 1
    return found[::-1]


def common_lines(a: np.ndarray, b: np.ndarray) -> list[int]:
    """Indexes in `a` of a longest common subsequence with `b`, by bit-parallel dynamic programming.

    Common beginnings and ends are taken first. Memory is bounded: beyond MOST_BITS the rest is halved.
    """
    a, b = a.tolist(), b.tolist()
    lo, hi = 0, 0
    while lo < min(len(a), len(b)) and a[lo] == b[lo]:
        lo += 1
    while hi < min(len(a), len(b)) - lo and a[-1 - hi] == b[-1 - hi]:
        hi += 1
    return [*range(lo), *_common(a[lo : len(a) - hi], b[lo : len(b) - hi], lo), *range(len(a) - hi, len(a))]


def line_hashes(lines: list[tuple[str, int]]) -> list[int]:
    import xxhash

    return [xxhash.xxh64_intdigest(line) - (1 << 63) for line, _ in lines]


def article_text(lines: list[tuple[str, int]], shared: list[int]) -> str:
    """The lines that stay, joined by newlines. `shared`: indexes of lines that the neighbour has too."""
    zones = {z for _, z in lines}
    if ARTICLE in zones:
        keep = [line for line, z in lines if z == ARTICLE]
    else:
        gone = set(shared) if len(shared) < MIRROR * len(lines) else set()
        keep = [line for k, (line, z) in enumerate(lines) if z == OTHER and k not in gone]
    return "\n".join(keep)


def nearest_pages(keys: DataFrame) -> DataFrame:
    """`key`, `near`: for each row of (key, host, path), the key of the page of its host whose path agrees longest.

    Pages are put in order by range partitions, so a host of any size is spread; the neighbour over the edge of
    a part comes from a table of one row for each part. A page that is alone on its host has no row.
    """
    spark = keys.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    at = scratch_path(spark, "page-order")
    ordered = keys.distinct().repartitionByRange(n, "host", "path", "key").sortWithinPartitions("host", "path", "key")
    ordered.withColumn("part", F.spark_partition_id()).withColumn("pos", F.monotonically_increasing_id()).write.parquet(at)
    rows = spark.read.parquet(at).withColumn("me", F.struct("host", "path", "key"))
    edges = rows.groupBy("part").agg(F.min("me").alias("lo"), F.max("me").alias("hi"))
    edges = edges.selectExpr("part as p", "lag(hi) over (order by part) as before_part", "lead(lo) over (order by part) as behind_part")
    rows = rows.selectExpr(
        "*", "lag(me) over (partition by part order by pos) as left_one", "lead(me) over (partition by part order by pos) as right_one"
    ).join(edges, F.col("part") == F.col("p"))
    for side, edge in (("left_one", "before_part"), ("right_one", "behind_part")):
        one = F.coalesce(F.col(side), F.col(edge))
        rows = rows.withColumn(side, F.when(one["host"].eqNullSafe(F.col("host")), one))

    def agreement(one: str):
        # the number of leading characters that agree
        return F.expr(
            f"coalesce(array_position(zip_with(split(path, ''), split({one}.path, ''), (a, b) -> coalesce(a <> b, true)), true), length(path) + 1)"
        )

    near = F.when(F.col("right_one").isNull(), F.col("left_one.key")).when(F.col("left_one").isNull(), F.col("right_one.key"))
    near = near.otherwise(F.when(agreement("right_one") > agreement("left_one"), F.col("right_one.key")).otherwise(F.col("left_one.key")))
    return rows.select("key", near.alias("near")).where("near is not null")


def extract_articles(pages: DataFrame, url_col: str = "url", html_col: str = "html", keep: list[str] | None = None) -> DataFrame:
    """The `keep` columns (None: all but the html) of every page, with `text`, `n_chars` and `n_shared_lines`.

    A null or empty page has an empty text. Pages without a host are neighbours of each other. Pages that are
    equal in URL and html count as one for the pairing and have one row each. Raises ValueError on taken names.
    """
    spark = pages.sparkSession
    names = [c for c in pages.columns if c != html_col] if keep is None else keep
    taken = {"text", "n_chars", "n_shared_lines"} & set(names)
    if taken:
        raise ValueError(f"columns {sorted(taken)} are in the frame already")
    url = F.coalesce(F.col(f"`{url_col}`"), F.lit(""))
    key = F.xxhash64(url, F.coalesce(F.col(f"`{html_col}`"), F.lit("")))
    host = F.regexp_extract(F.lower(url), r"^(?:[a-z][a-z0-9+.-]*:)?//([^/?#]*)", 1)
    path = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = [line_hashes(read_lines(x)) for x in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(lines, pa.list_(pa.int64()))], names=["key", "host", "path", "lines"])

    at = scratch_path(spark, "page-lines")
    pages.select(key.alias("key"), host.alias("host"), path.alias("path"), F.col(f"`{html_col}`").alias("html")).mapInArrow(
        hashed, "key long, host string, path string, lines array<long>"
    ).write.parquet(at)
    lines = spark.read.parquet(at)
    near = nearest_pages(lines.select("key", "host", "path"))
    own = lines.select("key", F.col("lines").alias("own")).dropDuplicates(["key"])
    other = lines.select(F.col("key").alias("k2"), F.col("lines").alias("other")).dropDuplicates(["k2"])
    both = near.join(own, "key").join(other, F.col("near") == F.col("k2")).select("key", "own", "other")

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [common_lines(np.array(a.as_py(), np.int64), np.array(b.as_py(), np.int64)) for a, b in zip(batch.column(1), batch.column(2), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int32()))], names=["key", "shared"])

    shared = both.mapInArrow(aligned, "key long, shared array<int>").where("size(shared) > 0")
    source = pages.select(*[F.col(f"`{c}`") for c in names], F.col(f"`{html_col}`").alias("_html"), key.alias("_key"))
    source = source.join(shared, F.col("_key") == F.col("key"), "left").drop("_key", "key")

    def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sources, gone = (batch.column(len(names) + k).to_pylist() for k in (0, 1))
            text = [article_text(read_lines(s), g or []) for s, g in zip(sources, gone, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(names)], pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64()), pa.array([len(g or []) for g in gone], pa.int32())],
                names=[*names, "text", "n_chars", "n_shared_lines"],
            )

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema.fields}
    schema = ", ".join([*[f"`{c}` {kinds[c]}" for c in names], "text string", "n_chars long", "n_shared_lines int"])
    return source.mapInArrow(final, schema)
