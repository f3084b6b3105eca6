"""Main text of web pages by two passes of block rules.

A page is cut into blocks at block-level tags; those inside a menu, header, footer, sidebar, notice, advert, form or
comment section go. The first pass judges each other block alone: its share of linked characters, its length, its share of stop
words and whether it stands in an article. Blocks too short to judge stay open. Where no stop words are known, length
and links decide. An article lifts a block by one step, from none to open and from open to main text; it says nothing
about blocks outside it. The second pass gives an open block the label of its nearest decided neighbours: the one before
and the one after, and if these disagree the nearer one, the one before on a tie.
"""

from __future__ import annotations

import html as entities
import re
import string
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tastegraph.llm.common import slices

# Tags by their role.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe legend li main menu nav noscript ol optgroup option p pre section "
    "select summary table tbody td textarea tfoot th thead title tr ul".split())
RAW_TAGS = frozenset("script style noscript template textarea title iframe noembed noframes xmp svg math object".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
OUTER_TAGS = frozenset("nav header footer aside form menu dialog button select fieldset head".split())
ARTICLE_TAGS = frozenset("article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Tags around a whole page at times, and tags whose class may mark an article.
WRAPPERS, HOLDERS = frozenset("form dialog".split()), frozenset("article main div section td".split())
# Words of class, id and role that mark what is no main text wherever they stand in a token.
OUTER_WORDS = frozenset((
    "nav navbar navigation menu masthead footer sidebar aside widget widgets banner cookie cookies consent gdpr popup modal overlay ad ads adv "
    "advert adverts advertisement adsense sponsor sponsored promo promoted comment comments reply replies respond disqus breadcrumb breadcrumbs "
    "related recommended newsletter subscribe subscription signup pagination pager toolbar copyright complementary contentinfo").split())
# Words that mark it beside words of place and form only, and those words.
STRICT_WORDS = frozenset("header notice alert share sharing social login search dialog form tags toc".split())
BESIDE = frozenset((
    "site main global top bottom left right list area box bar links button buttons item items slot unit block inner outer wrap wrapper container "
    "sticky fixed").split())
# Words that deny, or tell how a page is laid out around its text.
LAYOUT = frozenset("no not non has have with without hide layout open closed collapsed expanded".split())
REPLIES = frozenset("comment comments reply replies respond disqus".split())
# Whole tokens of class, id, role and itemprop that mark an article.
ARTICLE_WORDS = frozenset((
    "article articlebody article-body article-content article-text main maincontent main-content content post post-body post-content entry "
    "entry-content story story-body story-content").split())
# Frequent words of four languages.
STOP_WORDS = frozenset((
    "the of and to in a is that for it was on are as with his they at be this from have or by one had not but what all were when we there can an "
    "your which their said if do will each about how up out them then she many some so these would other into has more her two him see could no "
    "le la les un une des du de et est en que qui dans pour pas sur au avec ce il sont plus par ne se on nous vous mais ou son sa ses leur aux cette "
    "der die das und ist in den von zu mit sich des auf für nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am sind noch wie einem über "
    "el los las y en que se por con para una su al lo como más pero sus le ya o este sí porque esta entre cuando muy sin sobre también me hasta hay donde"
).split())
#: Blocks of fewer characters are not judged alone; more linked characters than this share mean a menu.
SHORT, LINKED = 70, 0.5
#: Shares of stop words from which a block is surely text, and from which a longer one may be.
STOP_HIGH, STOP_LOW, LONG = 0.30, 0.15, 200

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-label|itemprop)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?", re.I)
BLANKS = re.compile(r"\s+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
#: What stands around a word.
AROUND = string.punctuation + "«»“”„‘’…–—¿¡"


class Block:
    __slots__ = ("parts", "linked", "outer", "inner", "heading")

    def __init__(self, outer: int, inner: bool, heading: bool = False):
        self.parts, self.linked, self.outer, self.inner, self.heading = [], 0, outer, inner, heading

    def text(self) -> str:
        return BLANKS.sub(" ", "".join(self.parts)).strip()


def _outer_word(token: str) -> int:
    """Whether a token marks what is no main text: 2 for replies, which hold articles of their own, 1 for other words."""
    parts = {x for x in re.split("[_-]+", CAMEL.sub("-", token).lower()) if x}
    if parts & LAYOUT or {"content", "sidebar"} <= parts:
        return 0
    if parts & OUTER_WORDS:
        return 2 if parts & REPLIES else 1
    return int(bool(parts & STRICT_WORDS) and parts <= STRICT_WORDS | BESIDE)


def _role(tag: str, attributes: str) -> tuple[int, bool]:
    """Whether a tag opens what is no main text (1 if an article in it counts still, else 2), or the article."""
    outer, inner = (1 if tag in WRAPPERS else 2) if tag in OUTER_TAGS else 0, tag in ARTICLE_TAGS
    if "=" in attributes or "hidden" in attributes:
        for name, a, b, c in ATTRIBUTE.findall(attributes):
            if name.lower() == "hidden":
                outer = 2
            elif name.lower() != "aria-label" and tag not in ("html", "body") and tag not in HEADINGS:
                tokens = (a or b or c).split()
                word = 0 if tag in ARTICLE_TAGS else max(map(_outer_word, tokens), default=0)
                if word:
                    outer = max(outer, word)
                elif tag in HOLDERS and not ARTICLE_WORDS.isdisjoint(map(str.lower, tokens)):
                    inner = True
    return outer, inner and not outer


def blocks(page: str) -> list[Block]:
    """The page's blocks in order. Unclosed tags end with the tag around them; a raw-text tag ends at its end tag or the page."""
    found: list[Block] = []
    stack: list[tuple[str, int, bool]] = []
    standing: list[int] = []  # places of block tags in the stack
    opened: Counter[str] = Counter()  # open tags by name; what is not open is not looked for
    outer, inner, heading = 0, False, False
    links = at = 0
    current = Block(outer, inner)

    def put(text: str) -> None:
        text = entities.unescape(text) if "&" in text else text
        current.parts.append(text)
        if links:
            current.linked += sum(map(len, text.split()))

    def end() -> None:
        nonlocal current
        if current.parts:
            found.append(current)
        current = Block(outer, inner, heading)

    def close(tag: str) -> None:
        """End the last open ``tag`` and all that is open in it."""
        nonlocal outer, inner
        name = None
        while name != tag:
            name = stack.pop()[0]
            opened[name] -= 1
            if standing and standing[-1] == len(stack):
                standing.pop()
        outer, inner = stack[-1][1:] if stack else (0, False)

    def in_heading() -> bool:
        return any(opened[t] for t in HEADINGS)

    position = TAG.search
    while m := position(page, at):
        if m.start() > at:
            put(page[at:m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if tag == "br":
            current.parts.append(" ")
            continue
        if m[1]:
            if tag in RAW_TAGS:
                continue
            if tag == "a":
                links = max(0, links - 1)
            if opened[tag]:
                close(tag)
            if tag in BLOCK_TAGS:
                links, heading = 0, in_heading()
                end()
            continue
        if tag in RAW_TAGS:
            if not m[3].endswith("/"):
                last = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, at)
                at = last.end() if last else len(page)
            if tag in BLOCK_TAGS:
                end()
            continue
        if tag in VOID_TAGS or m[3].endswith("/") and tag not in BLOCK_TAGS:
            if tag in BLOCK_TAGS:
                end()
            continue
        if tag in ("p", "li") and standing and stack[standing[-1]][0] == tag:  # a new one ends the one before
            close(tag)
        opens_outer, opens_inner = _role(tag, m[3])
        if tag in BLOCK_TAGS or opens_outer or opens_inner:
            if tag in ARTICLE_TAGS and outer < 2:
                outer = 0
            outer, inner = max(outer, 0 if inner and tag == "header" else opens_outer), inner or opens_inner
            if tag in BLOCK_TAGS:
                standing.append(len(stack))
            stack.append((tag, outer, inner))
            opened[tag] += 1
        if tag in BLOCK_TAGS:
            links, heading = 0, in_heading()
            end()
        links += tag == "a"
    if at < len(page):
        put(page[at:])
    end()
    return found


def stop_share(text: str) -> float:
    words = text.lower().split()
    return sum(w.strip(AROUND) in STOP_WORDS for w in words) / max(1, len(words))


def first_pass(text: str, linked: int = 0, inner: bool = False, heading: bool = False, known: bool = True) -> bool | None:
    """True for main text, False for none, None if the block alone does not tell.

    ``inner``: it stands in the article; ``known``: the page has text with stop words of a known language.
    """
    solid = len(text) - text.count(" ")
    if linked > LINKED * solid:
        return None if inner and heading else False
    if len(text) < SHORT:
        return True if inner else None
    stops = stop_share(text)
    if stops >= STOP_HIGH:
        return True
    if stops >= STOP_LOW or not stops or not known:
        return True if inner or len(text) >= LONG else None
    return None if inner else False


def second_pass(labels: list[bool | None]) -> list[bool]:
    """Open blocks get the label of their nearest decided neighbours; without any they are kept."""
    before: list[tuple[int, bool] | None] = []
    last = None
    for k, label in enumerate(labels):
        last = last if label is None else (k, label)
        before.append(last)
    out, ahead = [True] * len(labels), None
    for k in range(len(labels) - 1, -1, -1):
        ahead = ahead if labels[k] is None else (k, labels[k])
        left = before[k]
        if left and ahead:
            out[k] = left[1] if left[1] == ahead[1] or k - left[0] <= ahead[0] - k else ahead[1]
        elif left or ahead:
            out[k] = (left or ahead)[1]
    return out


def main_text(page: str) -> str:
    """The page's main text, blocks joined by two line ends; empty if there is none."""
    found = [(b, t) for b in blocks(page) if not b.outer and (t := b.text())]
    known = any(len(t) >= SHORT and stop_share(t) >= STOP_LOW for _, t in found)
    labels = second_pass([first_pass(t, b.linked, b.inner, b.heading, known) for b, t in found])
    return "\n\n".join(t for (_, t), keep in zip(found, labels, strict=True) if keep)


def extracted(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) for each row; null html is an empty page, repeated rows repeat, other columns are not carried."""
    kinds = T.StructType([
        T.StructField("page_id", pages.schema[id_column].dataType), T.StructField("url", pages.schema[url_column].dataType),
        T.StructField("text", T.StringType())])

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2):
            texts = [main_text(h or "") for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=kinds.names)

    plain = pages.select(F.col(id_column).alias("page_id"), F.col(url_column).alias("url"), F.col(html_column).alias("html"))
    return plain.mapInArrow(extract, kinds).withColumn("n_chars", F.char_length("text").cast("long"))
