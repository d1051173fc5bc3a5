"""Main text of web pages by the maximum-scoring contiguous run of tokens.

A page is read as a row of tokens: tags, and runs of words with the kind of region they stand in.
Words score for content and tags against it, by weights learned from labelled pages: pages that
mark their article themselves. One linear scan finds the run of tokens with the greatest sum.
Inside it, regions that are no article text (menus, notices, adverts, forms, comments) are left
out; they do not count there, so that an advert in the middle does not cut an article in two.

What a region is follows from its element, or from a class, id or role that is made of hints and of
words for parts of a page alone, as in ``comments-area``. Whether it goes is then decided by what it
holds: one with an unsure hint, such as ``alert`` or ``search``, stays unless it is mostly links or
has controls; and no hint but that of comments, adverts and notices takes the region that holds
most of the page's prose. An article within a region that goes, goes with it.

Null and empty pages have an empty text, as has a page without a word that scores.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Weights are learned from at most this many labelled pages, those with the lowest hash.
LABELLED_PAGES = 400

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|textarea|title|iframe|noframes|noembed|xmp)\b[^>]*+>"
    r".*?(?:</(?P=raw)\s*+>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][\w:-]*+)"
    r"(?P<attributes>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*+(?:>|\Z))"
    r"|<[!?][^>]*+(?:>|\Z)"
    r"|(?P<text>[^<]++|<)",
    re.DOTALL | re.IGNORECASE,
)
ATTRIBUTE = re.compile(
    r"""(?<![^\s"'/])([^\s"'<>/=]++)\s*+=\s*+(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
)
HINTING = frozenset(["class", "id", "role"])

BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset"
    " figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main"
    " menu nav ol optgroup option p pre search section select summary table tbody tfoot thead tr"
    " ul".split()
)
SPACED = frozenset(["br", "td", "th", "button", "input", "img", "wbr"])
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])

# What an element says about the region it opens, by its name, and by its class, id and role.
ARTICLE, PLAIN = "article", "plain"
REGION_OF_NAME = {
    "article": ARTICLE, "main": ARTICLE, "head": "head", "nav": "menu", "menu": "menu",
    "header": "header", "footer": "footer", "aside": "aside", "form": "form", "button": "form",
    "select": "form", "fieldset": "form", "dialog": "notice", "noscript": "notice",
    "template": "notice", "svg": "figure", "object": "figure",
    "audio": "figure", "video": "figure", "canvas": "figure",
}
REGION_OF_HINT = {
    hint: region
    for region, hints in {
        "menu": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toolbar tabs",
        "header": "header masthead banner topbar",
        "footer": "footer contentinfo copyright colophon",
        "aside": "sidebar aside complementary widget widgets related recommended recommendations",
        "notice": "cookie cookies consent notice gdpr popup modal newsletter alert overlay signup",
        "advert": "ad ads advert adverts advertisement advertising sponsor sponsored promo",
        "form": "form search searchbox login subscribe",
        "comments": "comment comments reply replies respond disqus discussion",
        "share": "share sharing social",
    }.items()
    for hint in hints.split()
}
CONTENT_HINTS = frozenset(
    "article-body article-content articlebody post-body post-content entry-content main-content"
    " story-body story-content page-article".split()
)
# Hints that article text may bear as well.
UNSURE = frozenset("alert tabs search discussion header banner".split())
# Words for parts of a page, which say nothing by themselves.
PARTS = frozenset(
    "area bar block body box btn button buttons card cell col column form group head holder icons"
    " inner item items label link links list module outer panel post row section slot text thread"
    " title top bottom left right unit zone".split()
)
# These go around the content as often as around what they name, unless it is one of the sure kinds.
WRAPPERS = frozenset("container content layout main page site wrap wrapper".split())
SURE_KINDS = frozenset(["comments", "advert", "notice", "share"])
# Which kind a word with several hints is of: the first of these.
RANK = ["comments", "advert", "notice", "share", "aside", "menu", "footer", "form", "header"]
GLUED = re.compile("(" + "|".join(sorted((h for h in REGION_OF_HINT if len(h) > 4), key=len)[::-1]) + ")(?=.)")

# Regions that may stand in the middle of an article; they neither count nor stay.
INTERRUPTIONS = frozenset(["advert", "notice", "form", "comments", "share", "figure"])
CONTAINERS = frozenset(REGION_OF_NAME) | frozenset(
    ["div", "section", "table", "ul", "ol", "dl", "figure", "body", "details"]
)
# Inside an article only these are left out for a hint.
HINTED_INSIDE = frozenset(["article", "aside", "div", "form", "ol", "section", "ul"])
CONTROLS = frozenset(["input", "button", "select", "textarea"])
# A run of so many words, not in a link, is prose.
PROSE_WORDS = 10


@dataclass(frozen=True)
class Token:
    """A tag (``text`` is None) or a run of text; ``kind`` is what its weight is looked up by."""

    kind: str
    text: str | None
    breaks: str
    inside: bool
    dropped: bool


# How sure a region is: by its element, by whole hints, by hints that prose may bear too, by how a
# word begins or ends.
NAMED, WHOLE, DOUBTED, LOOSE = range(4)


class Region:
    """Part of a page: what it says it is, what it holds, and in the end what it counts as."""

    def __init__(self, said: str, sure: int, parent: Region | None) -> None:
        self.said, self.sure, self.parent = said, sure, parent
        self.within = said == ARTICLE or (parent is not None and parent.within)
        self.words = self.linked = self.prose = self.controls = 0
        self.kind, self.inside = said, False

    def settle(self, page_prose: int) -> None:
        """Find ``kind`` and ``inside``; the parent has been settled and the words are known."""
        above = self.parent.kind if self.parent else PLAIN
        self.inside = bool(self.parent and self.parent.inside)
        around = self.parent.said if self.parent and self.parent.kind == self.parent.said else above
        goes_with = around not in (ARTICLE, PLAIN) and self.parent.sure != LOOSE
        if self.said == ARTICLE and self.sure == NAMED and goes_with:
            self.kind, self.sure = above, self.parent.sure
        elif self.said in (ARTICLE, PLAIN) or self.sure == NAMED or self.goes(page_prose):
            self.kind = self.said
        else:
            self.kind = above
        self.inside = self.inside or self.kind == ARTICLE

    def goes(self, page_prose: int) -> bool:
        if self.sure == DOUBTED:
            mostly_links = 2 * self.linked > self.words
            alone = not self.inside and not self.prose
            return mostly_links or self.controls > 0 or not self.words or alone
        sure = self.said in SURE_KINDS and self.sure == WHOLE
        return sure or 2 * self.prose <= page_prose


def parts_of(word: str) -> list[str]:
    """The parts of a class or id: between hyphens, and a hint and what is glued to it."""
    parts = [part for part in re.split(r"[-_\d]+", word) if part]
    made = []
    for part in parts:
        glued = None if part in REGION_OF_HINT or part in PARTS else GLUED.match(part)
        made += [glued[1], part[glued.end() :]] if glued else [part]
    return made


def whole_hint(word: str) -> tuple[str, int] | None:
    """The region that a word says if it is made of hints and of words for parts alone."""
    parts = parts_of(word)
    hints = [part for part in parts if part in REGION_OF_HINT]
    if not hints:
        return None
    region = min((REGION_OF_HINT[hint] for hint in hints), key=RANK.index)
    neutral = PARTS | WRAPPERS if region in SURE_KINDS else PARTS
    if any(part not in REGION_OF_HINT and part not in neutral for part in parts):
        return None
    return region, DOUBTED if UNSURE.issuperset(hints) else WHOLE


def hinted_region(name: str, attributes: str, inside: bool) -> tuple[str, int] | None:
    """The region that class, id or role say an element opens, and how sure it is; a heading opens
    none.

    A hint must be a whole word, or on a plain container all of a word's parts; outside an article
    it may also be how a word begins or ends, but not for forms (a ``form`` says so itself) nor in
    the id of a section, which names its topic. A header inside an article belongs to it.
    """
    hints = name not in HEADINGS and (not inside or name in HINTED_INSIDE)
    parted = hints and not inside and name in CONTAINERS and REGION_OF_NAME.get(name) != ARTICLE
    for key, *values in ATTRIBUTE.findall(attributes):
        key = key.lower()
        if key not in HINTING:
            continue
        for word in "".join(values).lower().split():
            if word.replace("_", "-") in CONTENT_HINTS:
                return ARTICLE, WHOLE
            if not hints:
                continue
            found = None
            if word in REGION_OF_HINT:
                found = REGION_OF_HINT[word], DOUBTED if word in UNSURE else WHOLE
            elif name in HINTED_INSIDE:
                found = whole_hint(word)
            if found and not (inside and found[0] == "header"):
                return found
            parts = re.split(r"[-_]+", word)
            if not parted or parts[0] in ("has", "no", "with", "without"):
                continue
            if name == "section" and key == "id":
                continue
            for part in (parts[0], parts[-1]):
                if REGION_OF_HINT.get(part, "form") != "form":
                    return REGION_OF_HINT[part], LOOSE
    return None


def tokens(page: str) -> list[Token]:
    """The page's tokens in order. Plain words are "beside" on a page that marks its article."""
    row = read_tokens(page)
    if any(token.kind == "word article" for token in row):
        beside = {"word plain": "word beside"}
        row = [replace(t, kind=beside[t.kind]) if t.kind in beside else t for t in row]
    return row


def read_tokens(page: str) -> list[Token]:
    """Tags and runs of words. Elements that are never closed end with what holds them."""
    top = Region(PLAIN, NAMED, None)
    regions, read = [top], []
    # Open elements with their regions, and where those of each name stand.
    stack: list[tuple[str, Region]] = []
    places: dict[str, list[int]] = {}
    links = 0

    def drop_to(size: int) -> None:
        while len(stack) > size:
            places[stack.pop()[0]].pop()

    def opened(name: str, region: Region) -> None:
        places.setdefault(name, []).append(len(stack))
        stack.append((name, region))

    for found in TOKEN.finditer(page):
        region = stack[-1][1] if stack else top
        text = found["text"]
        if text is not None:
            n = len(text.split())
            region.words += n
            if links:
                region.linked += n
            elif n >= PROSE_WORDS:
                region.prose += n
            read.append((text, "", region))
            continue
        name = (found["name"] or found["raw"] or "").lower()
        if name in CONTROLS and not found["close"]:
            region.controls += 1
        name = (found["name"] or "").lower()
        if not name:
            continue
        if name == "a":
            links = 0 if found["close"] else 1
        if found["close"]:
            if places.get(name):
                drop_to(places[name][-1])
        elif name not in VOID:
            if name in BLOCKS and stack and stack[-1][0] == "p":
                drop_to(len(stack) - 1)
            if name == "body":
                drop_to(0)
            region = stack[-1][1] if stack else top
            hint = None
            if name not in ("html", "body"):
                hint = hinted_region(name, found["attributes"], region.within)
            own = REGION_OF_NAME.get(name)
            if name == "header" and region.within:
                own = None
            made = (own, NAMED) if own else None
            if hint and not (own == ARTICLE and hint[0] in ("header", "form")):
                made = hint if not own or own == ARTICLE else (hint[0], NAMED)
            if name == "h1" and region.said == "header" and region.sure == DOUBTED:
                made = (PLAIN, NAMED)
            if made:
                region = Region(*made, region)
                regions.append(region)
            if made or name in CONTAINERS or places.get(name):
                opened(name, region)
        region = stack[-1][1] if stack else top
        read.append((None, name, region))
    for region in reversed(regions[1:]):
        for what in ("words", "linked", "prose", "controls"):
            setattr(region.parent, what, getattr(region.parent, what) + getattr(region, what))
    for region in regions:
        region.settle(top.prose)
    return [token_of(*one) for one in read]


def token_of(text: str | None, name: str, region: Region) -> Token:
    kind, inside = region.kind, region.inside
    quiet = kind in INTERRUPTIONS or (inside and kind != ARTICLE)
    if text is not None:
        return Token("word " + ("inner" if quiet else kind), text, "", inside, quiet)
    breaks = "\n" if name in BLOCKS else " " if name in SPACED else ""
    known = name if name == "a" or name in BLOCKS | CONTAINERS | VOID else "inline"
    return Token("tag inner" if quiet else f"tag {known}", None, breaks, inside, False)


# Weights before any page is seen, and for kinds that the labelled pages do not have: by the word,
# and by the tag.
PRIOR_WORD = {"word article": 2.0, "word plain": 1.0, "word beside": -1.0}
PRIOR_OTHER_WORD, PRIOR_TAG, PRIOR_PARAGRAPH = -1.0, -0.5, 0.0
LEAST_SEEN, GREATEST = 5, 4.0


def weight_of(kind: str, weights: dict[str, float]) -> float:
    if kind in ("word inner", "tag inner"):
        return 0.0
    known = weights.get(kind)
    if known is not None:
        return known
    if kind.startswith("word"):
        return PRIOR_WORD.get(kind, PRIOR_OTHER_WORD)
    return PRIOR_PARAGRAPH if kind[4:] in HEADINGS | {"p", "br", "inline"} else PRIOR_TAG


def count_kinds(page: str) -> Iterator[tuple[str, bool, int]]:
    """How often each kind stands inside and outside the marked article."""
    seen: Counter[tuple[str, bool]] = Counter()
    for token in tokens(page):
        n = 1 if token.text is None else len(token.text.split())
        seen[token.kind, token.inside] += n
    for (kind, inside), n in seen.items():
        yield kind, inside, n


def log_odds(counts: dict[str, tuple[int, int]]) -> dict[str, float]:
    """Weights from counts inside and outside; words never below the sign that their odds have,
    tags never above 0."""
    total_in = 1 + sum(a for a, _ in counts.values())
    total_out = 1 + sum(b for _, b in counts.values())
    made = {}
    for kind, (a, b) in counts.items():
        if a + b < LEAST_SEEN:
            continue
        odds = math.log((a + 0.5) / total_in) - math.log((b + 0.5) / total_out)
        odds = max(-GREATEST, min(GREATEST, odds))
        if kind.startswith("tag"):
            odds = min(odds, 0.0)
        made[kind] = odds
    return made


def learn(pages: DataFrame, limit: int = LABELLED_PAGES) -> dict[str, float]:
    """Weights by kind, from at most ``limit`` pages that mark their article."""
    marked = (
        pages.select("html")
        .where(F.lower("html").contains("<article"))
        .orderBy(F.xxhash64("html"), "html")
        .limit(limit)
    )

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [row for page in frame["html"] for row in count_kinds(page)]
            yield pd.DataFrame(rows, columns=["kind", "inside", "n"])

    seen = (
        marked.mapInPandas(count, "kind string, inside boolean, n long")
        .groupBy("kind")
        .agg(
            F.sum(F.when(F.col("inside"), F.col("n")).otherwise(0)).alias("a"),
            F.sum(F.when(~F.col("inside"), F.col("n")).otherwise(0)).alias("b"),
        )
        .collect()
    )
    return log_odds({row["kind"]: (row["a"], row["b"]) for row in seen})


def best_run(scores: list[float]) -> tuple[int, int]:
    """First and last place, the last exclusive, of the run with the greatest sum above 0."""
    best, best_run_at = 0.0, (0, 0)
    total, start = 0.0, 0
    for k, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, k
        total += score
        if total > best:
            best, best_run_at = total, (start, k + 1)
    return best_run_at


def extract(page: str | None, weights: dict[str, float]) -> str:
    """The blocks of the best run, white space within a block as one space, two \\n between."""
    row = tokens(page or "")
    scores = [
        weight_of(t.kind, weights) * (1 if t.text is None else len(t.text.split())) for t in row
    ]
    start, end = best_run(scores)
    parts = []
    for token in row[start:end]:
        if token.text is None:
            parts.append("\n\0" if token.breaks == "\n" else token.breaks)
        elif not token.dropped and weight_of(token.kind, weights) > 0:
            parts.append(html.unescape(token.text).replace("\0", "�"))
    blocks = (" ".join(block.split()) for block in "".join(parts).split("\n\0"))
    return "\n\n".join(block for block in blocks if block)


def main_text(pages: DataFrame, limit: int = LABELLED_PAGES) -> DataFrame:
    """``pages`` with ``text`` and ``n_chars``, its code points; columns so named are replaced."""
    weights = learn(pages, limit)

    @F.pandas_udf("string")
    def extracted(column: pd.Series) -> pd.Series:
        return pd.Series([extract(page, weights) for page in column], dtype="object")

    return pages.withColumn("text", extracted(F.col("html"))).withColumn(
        "n_chars", F.char_length("text").cast("long")
    )
