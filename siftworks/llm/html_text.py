"""HTML extraction: text blocks of a page, and page differencing against the page with the nearest URL.

Markup that says what it is decides first: navigation, footers, notices and the
like go, the contents of an article or main element stay. Lines that no markup
explains are compared with those of the page whose URL path is nearest within
the host; the lines that both share in the same order are the template and go.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from siftworks.functions.ordering import global_position
from siftworks.llm.text import fingerprint, free_names
from siftworks.sources.shared import materialize

# Elements by their part in a page, per the HTML standard, and the names that mark page furniture.
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes".split())
FURNITURE = frozenset("nav header footer aside form button select menu svg canvas audio video head".split())
MAIN = frozenset("article main".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCK - frozenset("body html head caption li td th tr tbody thead tfoot option dd dt".split())
SIBLINGS = {"li": {"li"}, "option": {"option"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disclaimer footer gdpr header masthead menu modal nav navbar navigation newsletter notice notices popup promo promotion related "
    "share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
# Words that turn such a name into the description of something else, as in "with-sidebar".
NOT_NAMES = frozenset("has with without no not".split())
ROLES = frozenset("alert banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|</?[a-zA-Z](?:[^>\"']|\"[^\"]*\"|'[^']*')*+>?", re.S)
TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)(.*?)/?>?$", re.S)
ATTRIBUTE = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
URL = re.compile(r"^(?:[a-z][a-z0-9+.-]*:)?//([^/?#]*)([^?#]*)", re.I)

DROP, KEEP, OPEN = 0, 1, 2


class Line(NamedTuple):
    text: str
    #: DROP for page furniture, KEEP inside an article, OPEN where the markup does not say.
    kind: int


def _is_furniture(name: str, attributes: str) -> bool:
    if name in FURNITURE:
        return True
    if name in ("html", "body", "main"):
        return False
    for key, *values in ATTRIBUTE.findall(attributes):
        for token in "".join(values).lower().split():
            words = re.split(r"[^a-z0-9]+", token)
            if key.lower() == "role":
                found = token in ROLES
            else:
                found = token in NAMES or (name != "article" and {words[0], words[-1]} & NAMES and not NOT_NAMES & set(words))
            if found:
                return True
    return False


def _is_main(name: str, attributes: str) -> bool:
    return name in MAIN or any(k.lower() == "role" and "".join(v).lower() == "main" for k, *v in ATTRIBUTE.findall(attributes))


def page_lines(page: str | None) -> list[Line]:
    """The text blocks of a page in order, each with what its markup says about it.

    White space within a block becomes one space, references are decoded, blocks
    without text are left out. Unclosed and misnested tags are read as browsers
    do in the common cases: a block ends a paragraph, a list item the one before it, an
    end tag all that was opened inside; an end tag that matches nothing is skipped.
    """
    page = page or ""
    lines: list[Line] = []
    stack: list[tuple[str, bool, bool]] = []  # name, furniture, main: both hold for all inside
    pieces: list[str] = []

    def flush() -> None:
        text = " ".join(html.unescape("".join(pieces)).split())
        pieces.clear()
        if text:
            _, furniture, main = stack[-1] if stack else ("", False, False)
            lines.append(Line(text, DROP if furniture else KEEP if main else OPEN))

    def close(names: set[str], within: frozenset[str]) -> None:
        """End the innermost element of ``names`` unless one of ``within`` is further in."""
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in names:
                del stack[i:]
                return
            if stack[i][0] in within:
                return

    at = 0
    while True:
        found = TOKEN.search(page, at)
        if found is None:
            pieces.append(page[at:])
            break
        pieces.append(page[at : found.start()])
        token, at = found.group(), found.end()
        if token.startswith("<![CDATA["):
            pieces.append(html.escape(token[9:].removesuffix("]]>")))
            continue
        if token[1] in "!?":
            continue
        end, name, attributes = TAG.match(token).groups()
        name = name.lower()
        if name == "br":
            pieces.append(" ")
            continue
        block = name in BLOCK
        if block:
            flush()
        if end:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            if depth is not None:
                if stack[-1][1:] != (stack[depth - 1][1:] if depth else (False, False)):
                    flush()
                del stack[depth:]
            continue
        if name in RAW:
            # its contents are no markup: go on after the end tag
            stop = re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*>?", re.I).search(page, at)
            at = stop.end() if stop else len(page)
            continue
        if name in VOID:
            continue
        if name in CLOSES_P:
            close({"p"}, frozenset({"table", "td", "th", "button"}))
        if name in SIBLINGS:
            close(SIBLINGS[name], frozenset({"ul", "ol", "menu", "table", "dl", "select"}))
        _, furniture, main = stack[-1] if stack else ("", False, False)
        inside = (furniture or _is_furniture(name, attributes), main or _is_main(name, attributes))
        if inside != (furniture, main):
            flush()
        stack.append((name, *inside))
    flush()
    # beside an article, what the markup leaves open is not part of it
    if any(line.kind == KEEP for line in lines):
        lines = [Line(x.text, DROP if x.kind == OPEN else x.kind) for x in lines]
    return lines


def main_text(page: str | None, shared: frozenset[int] = frozenset()) -> str:
    """The kept blocks, two line breaks apart; ``shared`` holds the places of open lines to delete."""
    return "\n\n".join(x.text for i, x in enumerate(page_lines(page)) if x.kind != DROP and i not in shared)


def common_subsequence(a: list[int], b: list[int]) -> list[int]:
    """Places in ``a`` of a longest common subsequence with ``b``.

    Divide and conquer over rows of lengths that bit-parallel sums give, so memory
    is linear and time is the product of the lengths by the machine word.
    """

    def lengths(x: list[int], y: list[int]) -> list[int]:
        """Length of the longest common subsequence of ``x`` with each prefix of ``y``."""
        places: dict[int, int] = {}
        for j, v in enumerate(y):
            places[v] = places.get(v, 0) | 1 << j
        full = (1 << len(y)) - 1
        row = full
        for v in x:
            hit = row & places.get(v, 0)
            row = ((row + hit) | (row - hit)) & full
        out, n = [0], 0
        for bit in bin(row | 1 << len(y))[:2:-1] if y else "":
            n += bit == "0"
            out.append(n)
        return out

    def solve(x: list[int], y: list[int], first: int) -> list[int]:
        head = 0
        while head < min(len(x), len(y)) and x[head] == y[head]:
            head += 1
        tail = 0
        while tail < min(len(x), len(y)) - head and x[-1 - tail] == y[-1 - tail]:
            tail += 1
        before, after = list(range(first, first + head)), list(range(first + len(x) - tail, first + len(x)))
        x, y, first = x[head : len(x) - tail], y[head : len(y) - tail], first + head
        if not x or not y:
            return before + after
        if len(x) == 1:
            return before + ([first] if x[0] in y else []) + after
        middle = len(x) // 2
        left, right = lengths(x[:middle], y), lengths(x[middle:][::-1], y[::-1])[::-1]
        cut = max(range(len(y) + 1), key=lambda j: left[j] + right[j])
        return before + solve(x[:middle], y[:cut], first) + solve(x[middle:], y[cut:], first + middle) + after

    return solve(a, b, 0)


def url_parts(url: str | None) -> tuple[str, str]:
    found = URL.match(url or "")
    return (found[1].lower(), found[2]) if found else ("", url or "")


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "little", signed=True)


def _outline(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for row in batch.itertuples(index=False):
            lines = page_lines(row.html)
            host, path = url_parts(row.url)
            n_open = sum(x.kind == OPEN for x in lines)
            hashes = [_hash(x.text) for x in lines]
            out.append((row.key_a, row.key_b, host, path, n_open, hashes, [x.kind == OPEN for x in lines]))
        yield pd.DataFrame(out, columns=["_a", "_b", "host", "path", "n_open", "lines", "open"])


@F.pandas_udf(ArrayType(IntegerType()))
def _shared_places(own: pd.Series, before: pd.Series, after: pd.Series, is_open: pd.Series) -> pd.Series:
    out = []
    for a, *near, o in zip(own, before, after, is_open):
        a = list(map(int, a))
        places: set[int] = set()
        for b in near:
            b = [] if b is None else list(map(int, b))
            # an equal page says nothing about which lines are its template
            if a != b:
                places.update(common_subsequence(a, b))
        out.append([i for i in sorted(places) if o[i]])
    return pd.Series(out)


def shared_lines(pages: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """(_a, _b, _shared): the open lines that a page shares with a neighbour, by a hash of URL and page.

    All pages are ordered by host and path; a page's neighbours are those just
    before and after it within the host. Only line hashes are moved and sorted,
    and a host may fill any number of ranges.
    """
    keyed = pages.select(*[h.alias(n) for h, n in zip(_page_key(url, page), ("key_a", "key_b"))], F.col(url).alias("url"), F.col(page).alias("html"))
    kind = "_a long, _b long, host string, path string, n_open int, lines array<long>, open array<boolean>"
    outlines = keyed.mapInPandas(_outline, kind)
    order = ["host", "path", "_a", "_b"]
    placed = materialize(global_position(outlines, order, "place"), "page_outlines")
    asked = placed.filter("n_open > 0")
    before = placed.select((F.col("place") + 1).alias("place"), F.col("host").alias("_h1"), F.col("lines").alias("_before"))
    after = placed.select((F.col("place") - 1).alias("place"), F.col("host").alias("_h2"), F.col("lines").alias("_after"))
    near = [F.when(F.col(h) == F.col("host"), F.col(c)) for h, c in (("_h1", "_before"), ("_h2", "_after"))]
    return (
        asked.join(before, "place", "left")
        .join(after, "place", "left")
        .select("_a", "_b", _shared_places("lines", *near, "open").alias("_shared"))
        .filter(F.size("_shared") > 0)
        # equal pages at equal URLs: the one with more shared lines speaks for all
        .groupBy("_a", "_b")
        .agg(F.max_by("_shared", F.struct(F.size("_shared"), F.col("_shared"))).alias("_shared"))
    )


def _page_key(url: str, page: str) -> list:
    # hashes pass over NULLs, so they must be told from each other here
    parts = [F.concat(F.lit("="), F.coalesce(F.col(c), F.lit(""))) for c in (url, page)]
    return fingerprint(*parts)


def extract(pages: DataFrame, url: str = "url", page: str = "html", text: str = "text") -> DataFrame:
    """``pages`` without the markup column, with the main text.

    The article or main element without menus, headers, footers, sidebars, notices,
    adverts, forms, scripts, styles and comments; pages without such an element keep the
    lines that are no page furniture and that no nearest neighbour shares.
    NULL and empty pages have an empty text, and pages without a URL belong to the host ''.
    Equal rows have equal texts. A column called like ``text`` is replaced, all others stay whatever their names.
    """
    shared = materialize(shared_lines(pages, url, page), "shared_lines")

    @F.pandas_udf("string")
    def body(markup: pd.Series, places: pd.Series) -> pd.Series:
        return pd.Series([main_text(m, frozenset() if p is None else frozenset(map(int, p))) for m, p in zip(markup, places)], dtype=object)

    a, b, places = free_names(pages.columns, "a", "b", "shared")
    return (
        pages.withColumns(dict(zip((a, b), _page_key(url, page))))
        .join(shared.toDF(a, b, places), [a, b], "left")
        .withColumn(text, body(F.col(page), F.col(places)))
        .drop(a, b, places, *([page] if page != text else []))
    )
