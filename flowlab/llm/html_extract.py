"""Main text of web pages by nearest-URL page differencing.

A page is cut into text lines (one per block).  Pages of a host are sorted by
URL path, each is paired with the neighbour whose path is nearest, the two
line lists are aligned by longest common subsequence, and shared lines are
deleted.  An exact check on the markup follows: lines inside the page's
article are the page's own also when another page carries the same article,
and menus, adverts, forms, comments and the like go even if no other page
shares them.
"""

from __future__ import annotations

import hashlib
import html
import re
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlab.llm.common import map_batches, saved, strings
from flowlab.llm.ordering import neighbours, range_slices
from flowlab.llm.url_filter import host_path

_WORDS = 3                         # dropped by class words
ARTICLE, OPEN, DROPPED = 0, 1, 2   # lines of the article, of undecided places, of places that are no text

_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<![^>]*>|<\?[^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|$)", re.S)
_RAW = {"script", "style", "noscript", "template", "iframe", "textarea", "title", "svg", "math", "object", "select",
        "button", "canvas", "audio", "video"}
_BOILERPLATE_TAGS = {"nav", "footer", "aside", "form", "dialog", "head", "menu"}
_BLOCK = {"p", "div", "section", "article", "main", "header", "footer", "nav", "aside", "h1", "h2", "h3", "h4", "h5", "h6",
          "ul", "ol", "li", "dl", "dt", "dd", "blockquote", "pre", "table", "thead", "tbody", "tfoot", "tr", "caption",
          "figure", "figcaption", "address", "details", "summary", "form", "fieldset", "legend", "hr", "body", "html",
          "head", "dialog", "center", "hgroup", "search", "menu"}
_SPACE = {"br", "td", "th", "img", "input", "wbr"}
_VOID = {"br", "hr", "img", "input", "meta", "link", "wbr", "area", "base", "col", "embed", "source", "track", "param"}
_SELF_ENDING = {"p", "li", "dt", "dd", "tr", "td", "th", "h1", "h2", "h3", "h4", "h5", "h6"}
#: Words of a class, id or role that mark a place without main text.
_MARKS = set("""ad ads advert adverts advertisement adsbygoogle sponsor sponsored promo promotion nav navbar navigation
menu sidebar footer masthead banner cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe
signup login share sharing social related recommended breadcrumb breadcrumbs pagination pager comment comments
commentlist disqus respond replies reply widget toolbar alert complementary contentinfo search skip""".split())
_OUTSIDE_MARKS = {"header", "top", "bottom", "topbar"}   # only outside an article
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)


#: Blocks of running text: here a mark must be a whole class, id or role, not a word of one.
_TEXT_BLOCKS = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "blockquote", "pre", "td", "th", "tr", "figure", "figcaption",
                "main", "article"}


def _marked(attributes: str, inside: bool, whole: bool = False) -> bool:
    if not attributes or "=" not in attributes and "hidden" not in attributes:
        return False
    for m in _ATTRIBUTE.finditer(attributes):
        if whole:
            if set((m[2] or m[3] or m[4] or "").lower().split()) & _MARKS:
                return True
            continue
        value = re.sub(r"(?<=[a-z])(?=[A-Z])", " ", m[2] or m[3] or m[4] or "")
        words = set(re.split(r"[^a-z0-9]+", value.lower()))
        if words & _MARKS or not inside and words & _OUTSIDE_MARKS:
            return True
    return bool(_HIDDEN.search(attributes))


def page_lines(page: str) -> list[tuple[str, int]]:
    """The page's text lines with their kind, in page order.  A line is the
    text of one block, character references decoded, white space runs as one
    blank, trimmed; empty lines are left out."""
    out: list[tuple[str, int]] = []
    parts: list[str] = []
    article = 0                 # open article or main elements
    skip, depth = "", 0         # element whose content is no main text, and how often it is open
    by_words = False            # whether class words alone say so
    header = 0

    def flush() -> None:
        if parts:
            line = " ".join(html.unescape("".join(parts)).split())
            parts.clear()
            if line:
                out.append((line, (_WORDS if skip and by_words and not header else DROPPED) if skip or header else ARTICLE if article else OPEN))

    at, n = 0, len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        if m is None:
            parts.append(page[at:])
            break
        if m.start() > at:
            parts.append(page[at:m.start()])
        at = max(m.end(), m.start() + 1)
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        closing, attributes = bool(m[1] or m[4]), m[3] or m[6] or ""
        if name in _RAW and not closing:
            if not attributes.endswith("/"):
                end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
                at = end.end() if end else n
            parts.append(" ")
            continue
        if name in _BLOCK:
            flush()
        elif name in _SPACE:
            parts.append(" ")
        if skip:
            if skip in _SELF_ENDING and (name in _BLOCK and not closing and name not in ("br",)
                                         or closing and name in _BLOCK):
                skip, depth = "", 0
                if closing:
                    continue
            elif name == skip:
                depth += -1 if closing else name not in _VOID and not attributes.endswith("/")
                if depth <= 0:
                    flush()
                    skip = ""
                continue
            elif not closing and name in ("article", "main") and skip in ("div", "span", "section") and not article \
                    and not _marked(attributes, False):
                skip, depth = "", 0   # an unclosed box does not swallow the article
            elif closing and name in ("article", "main", "body", "html"):
                skip, depth = "", 0
            else:
                continue
        if closing:
            if name in ("article", "main"):
                article = max(0, article - 1)
            elif name == "header":
                header = max(0, header - 1)
            continue
        if name in _VOID:
            continue
        if name in ("article", "main"):
            # the text itself, whatever its classes say; a second one may be a reader's comment
            marked = any(kind == ARTICLE for _, kind in out) and _marked(attributes, True, whole=True)
        else:
            marked = name not in ("body", "html") and _marked(attributes, article > 0, name in _TEXT_BLOCKS)
        if name in _BOILERPLATE_TAGS or marked:
            if name not in _BLOCK:
                flush()
            skip, depth, by_words = name, 1, name not in _BOILERPLATE_TAGS
        elif name in ("article", "main"):
            article += 1
            header = 0
        elif name == "header" and not article:
            header += 1
    flush()
    if all(kind in (DROPPED, _WORDS) for _, kind in out):     # class words alone never leave a page empty
        return [(line, OPEN if kind == _WORDS else kind) for line, kind in out]
    out = [(line, DROPPED if kind == _WORDS else kind) for line, kind in out]
    if not any(kind == ARTICLE for _, kind in out):
        return out
    return [(line, kind if kind == ARTICLE else DROPPED) for line, kind in out]


def shared_positions(a: list[int], b: list[int]) -> list[int]:
    """Positions of ``a`` in a longest common subsequence of ``a`` and ``b``.
    Equal ends are taken first; inside, the longest rising chain over the
    places where a line of ``a`` also stands in ``b``."""
    lo, hi_a, hi_b = 0, len(a), len(b)
    while lo < min(hi_a, hi_b) and a[lo] == b[lo]:
        lo += 1
    while hi_a > lo and hi_b > lo and a[hi_a - 1] == b[hi_b - 1]:
        hi_a, hi_b = hi_a - 1, hi_b - 1
    ends = list(range(lo)) + list(range(hi_a, len(a)))
    places: dict[int, list[int]] = {}
    for j in range(hi_b - 1, lo - 1, -1):
        places.setdefault(b[j], []).append(j)
    tails: list[int] = []                # smallest end of a chain of each length
    nodes: list[tuple] = []              # that chain's last link: (position in a, link before)
    for i in range(lo, hi_a):
        for j in places.get(a[i], ()):
            k = bisect_left(tails, j)
            link = (i, nodes[k - 1] if k else None)
            if k == len(tails):
                tails.append(j)
                nodes.append(link)
            elif j < tails[k]:
                tails[k], nodes[k] = j, link
    link = nodes[-1] if nodes else None
    while link:
        ends.append(link[0])
        link = link[1]
    return sorted(ends)


def _line_key(line: str) -> int:
    return int.from_bytes(hashlib.blake2b(line.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def parsed_pages(pages: DataFrame) -> DataFrame:
    """``page_id, url, row, lines, keys, kinds`` per page row."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        cut = [page_lines(p) for p in strings(batch, "html")]
        return pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), batch.column("row"),
             pa.array([[t for t, k in p if k != DROPPED] for p in cut], pa.list_(pa.string())),
             pa.array([[_line_key(t) for t, _ in p] for p in cut], pa.list_(pa.int64())),
             pa.array([[k for _, k in p] for p in cut], pa.list_(pa.int32()))],
            names=["page_id", "url", "row", "lines", "keys", "kinds"])
    id_type = pages.schema["page_id"].dataType.simpleString()
    rows = pages.select("page_id", "url", F.monotonically_increasing_id().alias("row"), "html")
    return map_batches(rows, run, f"page_id {id_type}, url string, row bigint, lines array<string>, "
                                  "keys array<bigint>, kinds array<int>")


def _common_prefix(a: Column, b: Column) -> Column:
    steps = F.sequence(F.lit(0), F.least(F.length(a), F.length(b)))
    return F.aggregate(steps, F.lit(0), lambda n, i: F.when(
        (i > 0) & (n == i - 1) & (a.substr(i, F.lit(1)) == b.substr(i, F.lit(1))), i).otherwise(n))


def nearest_pages(parsed: DataFrame) -> DataFrame:
    """``row, near``: each page's nearest neighbour by path among the pages of
    its host (the one before or behind in path order with the longer common
    prefix; the earlier on a tie); pages alone on their host are left out."""
    host, path = host_path(F.col("url"))
    keys = parsed.select("row", host.alias("host"), path.alias("path"))
    order = ["host", "path", "row"]
    around = neighbours(range_slices(keys, order, "html-order"), order, ["host", "path", "row"])
    same = {s: F.col(f"__{s}.host") == F.col("host") for s in ("prev", "next")}
    length = {s: F.when(same[s], _common_prefix(F.col("path"), F.col(f"__{s}.path"))).otherwise(-1) for s in same}
    near = F.when(F.coalesce(length["next"], F.lit(-1)) > F.coalesce(length["prev"], F.lit(-1)), F.col("__next.row")) \
        .when(F.coalesce(length["prev"], F.lit(-1)) >= 0, F.col("__prev.row"))
    return around.select("row", near.alias("near")).filter("near is not null")


def extract_main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row: the main text and its
    code points.

    A null or empty page gives the empty text.  Without an article or main
    element the text is all lines that neither the nearest page shares nor the
    markup rules out; a page whose lines all equal its neighbour's is a copy
    and keeps them.  Null URLs form one host; repeated rows are pages each.
    Differencing moves 64-bit line keys, never texts; a host with very many
    pages is spread over range slices.
    """
    parsed = saved(parsed_pages(pages), "html-lines")
    keys = parsed.select("row", "keys", "kinds")
    pairs = (keys.join(nearest_pages(parsed), "row")
             .join(keys.select(F.col("row").alias("near"), F.col("keys").alias("near_keys")), "near"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        deleted = []
        for a, kinds, b in zip(*(batch.column(c).to_pylist() for c in ("keys", "kinds", "near_keys"))):
            shared = shared_positions(a, b)
            kept = np.cumsum([k != DROPPED for k in kinds]) - 1
            deleted.append([] if a == b else [int(kept[i]) for i in shared if kinds[i] == OPEN])
        return pa.RecordBatch.from_arrays([batch.column("row"), pa.array(deleted, pa.list_(pa.int32()))],
                                          names=["row", "deleted"])
    diffs = saved(map_batches(pairs, run, "row bigint, deleted array<int>"), "html-diffs")
    # only pages that lose lines meet their texts again; the others' rows stay where they are
    undecided = F.exists("kinds", lambda k: k == OPEN)
    joined = parsed.filter(undecided).join(diffs, "row", "left")
    cut = F.when(F.col("deleted").isNull(), F.col("lines")).otherwise(
        F.filter("lines", lambda x, i: ~F.array_contains("deleted", i)))
    both = (parsed.filter(~undecided).select("page_id", "url", "lines")
            .unionByName(joined.select("page_id", "url", cut.alias("lines"))))
    text = F.array_join("lines", "\n")
    return both.select("page_id", "url", text.alias("text"), F.length(text).cast("bigint").alias("n_chars"))
