"""Main text of a web page by the distribution of text over its lines.

Markup is stripped to one line per block element. The length of text is summed
over sliding windows of lines; where the sum surges the main text begins, where
it dives to nothing it ends, and the lines between are kept. Lines of menus,
adverts and the like, known by their elements and names, have no weight, nor
have lines that are mostly links; if the page marks an article, nothing outside
it has. A name alone drops no article and no element that holds most of the
text: such lines have less weight, and the sums decide.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW_LINES = 3
# A surge has to reach this many characters, or half of the page's largest window.
SURGE_CHARS = 80

# Part of their characters that lines weigh whose element is named like something else.
NAMED_WEIGHT = 0.5

# Fixed values of HTML.
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_RAW = frozenset(
    "script style noscript template textarea iframe svg head title object canvas audio video"
    " select".split()
)
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset"
    " figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main"
    " menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr"
    " ul".split()
)
# Elements whose begin and end are followed; others may be left open in a page.
_FOLLOWED = frozenset(
    "article aside blockquote button details dialog div dl fieldset figure footer form header main"
    " menu nav ol p search section span table ul li a".split()
)
_NOT_TEXT = frozenset("aside button dialog footer form menu nav search".split())
_NOT_TEXT_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search"
    " toolbar".split()
)
# Parts of class and id names by which pages call what is not the article.
_NOT_TEXT_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs byline"
    " comment comments commentlist consent cookie cookies copyright disclaimer disqus footer gdpr"
    " login masthead menu modal nav navbar navigation newsletter notice notices notification"
    " pager pagination popup promo promotion recommended related replies reply respond search"
    " share sharing sidebar signup skip social sponsor sponsored subscribe subscription teaser"
    " toolbar widget widgets".split()
)
# Names of what readers write; it is never taken for the article while there is other text.
_COMMENT_NAMES = frozenset("comment comments commentlist disqus replies reply respond".split())
# Words that such a name may be put together with and still say the same.
_STRUCTURE_NAMES = frozenset(
    "area article articles bar block blocks body bottom box button buttons card cards col column"
    " container content count div entry feed footer form global group head header heading icon"
    " icons inner item items js label left link links list lists main middle module more nav new"
    " outer page pane panel post posts primary region right row secondary section sections site"
    " slot small stories story text thread title top unit user view wrap wrapper zone".split()
)
_ARTICLE_NAMES = frozenset("article body content entry main post story text".split())

_TAG = re.compile(
    r"</?([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>", re.DOTALL
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_RAW_END = {name: re.compile(rf"</{name}\b[^>]*>?", re.IGNORECASE) for name in _RAW}


class Line:
    """Text of a block, its characters inside links, and what it is part of.

    ``named`` is the number of the innermost element around it that only a name
    tells from the article, 0 if there is none.
    """

    __slots__ = ("text", "link_chars", "boilerplate", "inside", "named")

    def __init__(
        self,
        text: str,
        link_chars: int,
        boilerplate: bool,
        inside: bool,
        named: int = 0,
    ):
        self.text, self.link_chars = text, link_chars
        self.boilerplate, self.inside, self.named = boilerplate, inside, named


# What the names of an element say of it.
_SILENT, _NAMED, _COMMENTS = 0, 1, 2


def _is_boilerplate(name: str, attributes: str, inside: bool) -> tuple[bool, int]:
    """Whether an element is none of the article for certain, and what its names say."""
    if name in _NOT_TEXT or (name == "header" and not inside):
        return True, _SILENT
    if not attributes or name in ("html", "body", "a"):
        return False, _SILENT
    found = {}
    for key, *values in _ATTRIBUTE.findall(attributes):
        found.setdefault(key.lower(), next(filter(None, values), ""))
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true":
        return True, _SILENT
    if found.get("role", "").lower() in _NOT_TEXT_ROLES:
        return True, _SILENT
    if "display:none" in found.get("style", "").replace(" ", "").lower():
        return True, _SILENT
    said = _SILENT
    names = (found.get("class", "") + " " + found.get("id", "")).split()
    parts_of = [{x.lower() for x in _NAME_PARTS.findall(n) if not x.isdigit()} for n in names]
    for parts in parts_of:
        # "share-buttons" and "comments" say what they are, "share-price" and "has-comments" don't.
        if parts & _NOT_TEXT_NAMES and parts <= _NOT_TEXT_NAMES | _STRUCTURE_NAMES:
            said = max(said, _COMMENTS if parts & _COMMENT_NAMES else _NAMED)
    every = set().union(*parts_of)
    if "header" in every and not inside and not every & _ARTICLE_NAMES:
        said = max(said, _NAMED)
    return False, said


def _drop_named(lines: list[Line], above: list[int], said: list[int]) -> None:
    """Makes boilerplate of the lines in named elements, but for those that hold most of the text.

    The largest element comes first, an outer one before those in it. It stays if
    it has more text than all lines that are in no named element or in one that
    stays; or no less text of marked articles than those. Readers' comments stay
    only where the rest is less than a surge. ``above`` has the named element
    around each, by number, ``said`` what its names say.
    """
    count = len(above)
    direct = [[0, 0] for _ in range(count)]  # characters of lines, and of those in marked articles
    for line in lines:
        if not line.boilerplate and 2 * line.link_chars <= len(line.text):
            direct[line.named][0] += len(line.text)
            direct[line.named][1] += len(line.text) * line.inside
    whole = [list(d) for d in direct]
    for number in range(count - 1, 0, -1):
        if above[number]:
            whole[above[number]][0] += whole[number][0]
            whole[above[number]][1] += whole[number][1]
    rest = list(direct[0])
    stays = [True] + [False] * (count - 1)
    for number in sorted(range(1, count), key=lambda x: (-whole[x][0], x)):
        total, marked = whole[number]
        if said[number] == _COMMENTS:
            enough = total > rest[0] and rest[0] < SURGE_CHARS
        else:
            enough = total > rest[0] or (marked and marked >= rest[1])
        if enough and total and stays[above[number]]:
            stays[number] = True
            rest[0] += direct[number][0]
            rest[1] += direct[number][1]
    for line in lines:
        line.boilerplate = line.boilerplate or not stays[line.named]


def page_lines(html: str) -> list[Line]:
    """One line per block that has text, in page order."""
    lines: list[Line] = []
    pieces: list[str] = []
    link_chars = 0
    # Name, begins boilerplate, is an article, is known by a name only.
    open_: list[tuple[str, bool, bool, bool]] = []
    # Numbers of the named elements that are open, and for each number the one around it.
    named, above, said = [0], [0], [_SILENT]
    open_names: Counter[str] = Counter()
    boilerplate = inside = links = 0

    def end_line() -> None:
        nonlocal link_chars
        text = " ".join("".join(pieces).split())
        if text:
            lines.append(Line(text, link_chars, boilerplate > 0, inside > 0, named[-1]))
        pieces.clear()
        link_chars = 0

    def add(text: str) -> None:
        nonlocal link_chars
        text = unescape(text)
        pieces.append(text)
        if links:
            link_chars += len(text.strip())

    def close_down_to(depth: int) -> None:
        nonlocal boilerplate, inside, links
        while len(open_) > depth:
            name, bad, article, by_name = open_.pop()
            open_names[name] -= 1
            if by_name:
                named.pop()
            boilerplate -= bad
            inside -= article
            links -= name == "a"

    at, size = 0, len(html)
    while at < size:
        mark = html.find("<", at)
        if mark < 0:
            add(html[at:])
            break
        if mark > at:
            add(html[at:mark])
        if html.startswith("<!--", mark):
            end = html.find("-->", mark + 4)
            at = size if end < 0 else end + 3
            continue
        following = html[mark + 1 : mark + 3]
        if following[:1] in ("!", "?"):
            end = html.find(">", mark)
            at = size if end < 0 else end + 1
            continue
        tag = _TAG.match(html, mark) if following.strip("/")[:1].isalpha() else None
        if tag is None:
            if following[:1].isalpha() or (following[:1] == "/" and following[1:].isalpha()):
                end = html.find(">", mark)  # a tag with an open quote
                at = size if end < 0 else end + 1
            else:
                add("<")
                at = mark + 1
            continue
        at, name = tag.end(), tag[1].lower()
        closing = following[0] == "/"
        if name == "br":
            pieces.append(" ")
            continue
        if name in _RAW and not closing:
            end = _RAW_END[name].search(html, at)
            at = size if end is None else end.end()
            continue
        if name in _BLOCKS:
            end_line()
            if open_ and open_[-1][0] == "p":  # a block ends a paragraph left open
                close_down_to(len(open_) - 1)
        if name not in _FOLLOWED or name in _VOID:
            continue
        if closing:
            if open_names[name]:
                # What is passed on the way is closed, so the search costs no more than that.
                depth = len(open_) - 1
                while open_[depth][0] != name:
                    depth -= 1
                close_down_to(depth)
        elif not tag[2].endswith("/"):
            bad, names_say = _is_boilerplate(name, tag[2], inside > 0)
            article = name in ("article", "main") and not bad
            # A name says something of an article only within another, as of a comment.
            by_name = bool(names_say) and (
                not article or len(named) > 1 or open_names["article"] > 0
            )
            open_.append((name, bad, article, by_name))
            open_names[name] += 1
            if by_name:
                above.append(named[-1])
                said.append(names_say)
                named.append(len(above) - 1)
            boilerplate += bad
            inside += article
            links += name == "a"
    end_line()
    _drop_named(lines, above, said)
    return lines


def main_lines(lines: list[Line], window: int = WINDOW_LINES, surge: int = SURGE_CHARS) -> list[str]:
    """The lines between surge and dive points."""
    marked = any(x.inside and not x.boilerplate for x in lines)

    def weight(line: Line) -> int:
        if line.boilerplate or (marked and not line.inside):
            return 0
        if not marked and 2 * line.link_chars > len(line.text):
            return 0
        return max(1, int(NAMED_WEIGHT * len(line.text))) if line.named else len(line.text)

    weights = [weight(x) for x in lines]
    sums = [sum(weights[i : i + window]) for i in range(len(lines))]
    # In a marked article any text is a surge.
    enough = 1 if marked else min(surge, max(sums, default=0) / 2)
    kept: list[str] = []
    within = False
    for line, own, total in zip(lines, weights, sums):
        if total == 0:
            within = False
        elif not within:
            within = own > 0 and total >= enough
        if within and not line.boilerplate and (line.inside or not marked):
            kept.append(line.text)
    return kept


def main_text(html: str | None) -> str:
    """The article of a page, a line per block; empty for NULL and pages without text."""
    return "\n".join(main_lines(page_lines(html))) if html else ""


def extracted_text(html: Column) -> Column:
    @F.arrow_udf("string")
    def extracted(pages: pa.Array) -> pa.Array:
        return pa.array([main_text(x.as_py()) for x in pages], pa.string())

    return extracted(html)


def extract_pages(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row; repeated rows stay repeated.

    Whole pages are read, however long; NULL html gives an empty text, NULL ids
    and addresses stay NULL, other columns are not read.
    """
    return pages.select(
        F.col(id_col).alias("page_id"),
        F.col(url_col).alias("url"),
        extracted_text(F.col(html_col)).alias("text"),
    ).withColumn("n_chars", F.length("text").cast("bigint"))
