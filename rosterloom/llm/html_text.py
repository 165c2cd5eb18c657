"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags.  The first pass gives a block points: for length, for a natural share of stop words
(or against it, where a long block has next to none), against a high share of linked text, and for or against what its
containers are called.  Enough points either way decide it; short and contradictory blocks stay open.  In the second pass
every open block inherits the label of its nearest decided neighbour, good or bad, of the same region.

A region is what one main container (article, main or the like) holds, or the rest of the page.  If no block of a region is
decided, its open blocks are judged together, by the same points, as if they were one.  If a page has main containers with
good text, only they count.

Defined results: a null page is empty, a page without blocks gives empty text; the whole page is read; broken
markup (unclosed tags, cut ends) is read as far as it goes; attribute values of any length are no text and
open no tags; repeated rows give the same text.  The columns ``text`` and ``n_chars`` replace those of these names; others stay.
"""

from __future__ import annotations

import html as entities
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHORT = 70
HIGH_STOP, LOW_STOP = 0.30, 0.15
#: Most linked characters of a block: in an article, and elsewhere.
LINKED, LINKED_OUTSIDE = 0.5, 0.3
#: How much each feature counts; 0 leaves it out.
WEIGHTS = {"length": 1, "stop": 1, "links": 1, "container": 1}

# Words and names that the rules look for.
STOP_WORDS = frozenset(
    (
        "a about all also an and any are as at be been but by can do for from had has have he her his how i if in into is it its me more my no not of on one "
        "only or our out she so some than that the their them then there these they this to up was we were what when which who will with would you your "
        "au aux avec ce ces dans de des du elle en est et il ils je la le les leur lui mais ne nous on ou par pas plus pour qu que qui sa se ses son sont sur "
        "un une vous à été aber als am an auch auf aus bei bin bis das dass dem den der des die doch ein eine einem einen einer es für hat ich ihr im in ist "
        "ja kann mit nach nicht noch nur oder sich sie sind so und uns vom von vor war was wie wir wird zu zum zur über al como con cuando de del desde donde "
        "el ella en entre era es esta este fue ha hay la las lo los mas me mi muy no o para pero por que se sin sobre su sus también un una y ya"
    ).split()
)
BLOCK_TAGS = frozenset(
    (
        "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head "
        "header hr html legend li main menu nav ol optgroup option p pre section select summary table tbody td tfoot th thead title tr ul"
    ).split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no text of the page.
OPAQUE_TAGS = "script style noscript template svg math canvas object iframe textarea title xmp noembed noframes audio video select button"
BAD_TAGS = frozenset("nav footer aside form dialog menu header head".split())
MAIN_TAGS = frozenset("article main".split())
BAD_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
BAD_NAMES = frozenset(
    (
        "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion nav navbar navigation menu submenu breadcrumb breadcrumbs "
        "header masthead topbar footer sidebar sidebars rail widget widgets cookie cookies consent gdpr notice notices notification alert popup modal overlay lightbox "
        "newsletter subscribe subscription signup signin login register paywall share sharing social comment comments commentlist disqus reply replies respond "
        "related recommended recommendations recirculation trending popular pagination pager toolbar search searchbox copyright legal disclaimer skip outbrain taboola"
    ).split()
)
MAIN_NAMES = frozenset("content article articlebody article-body post postcontent post-content entry entrycontent entry-content story storybody story-body maincontent main-content main".split())
COMMENT_TITLES = frozenset("comments|reader comments|leave a comment|leave a reply|kommentare|commentaires|comentarios|leserkommentare".split("|"))
LABELS = frozenset("advertisement advert sponsored anzeige werbung publicité publicidad".split())

#: A quote that nothing closes is an ordinary character.  Nothing here is read twice, however long a value is.
_NAME, _VALUE = r"[^\s/>][^\s/>=]*+", r"""\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]*+)"""
_ATTRIBUTES = rf"(?:[\s/]++|{_NAME}(?:{_VALUE})?+)*+"
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<opaque>{'|'.join(OPAQUE_TAGS.split())})\b{_ATTRIBUTES}>.*?(?:</(?P=opaque)\s*>|\Z)"
    rf"|<(?P<close>/)?(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>{_ATTRIBUTES})(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
_ATTRIBUTE = re.compile(rf"({_NAME})({_VALUE})?+")
_TELLING = frozenset("class id role itemprop hidden aria-hidden style".split())
_PIECES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
_WORD = re.compile(r"[^\W\d_]+")


@dataclass
class Block:
    tag: str
    region: int  # 0: outside of main containers
    bad: bool  # by markup
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""
    good: bool | None = None


@dataclass
class _Open:
    tag: str
    bad: bool
    region: int


def _attributes(rest: str) -> dict[str, str]:
    """The attributes of a tag that say something about what it holds."""
    own = ((k.lower(), v) for k, v in _ATTRIBUTE.findall(rest)) if rest else ()
    return {k: v.lstrip()[1:].strip().strip("\"'") for k, v in own if k in _TELLING}


def _judge_tag(tag: str, values: dict[str, str], parent: _Open, regions: list[int]) -> _Open:
    """What an opening tag says about all it holds."""
    bad, region = parent.bad, parent.region
    named = f"{values.get('class', '')} {values.get('id', '')}"
    words = {w.lower() for w in named.split()}
    pieces = {p.lower() for p in _PIECES.findall(named)}
    main = tag in MAIN_TAGS or values.get("role") == "main" or "articleBody" in values.get("itemprop", "") or (tag in ("div", "section", "td") and bool(words & MAIN_NAMES))
    if tag in BAD_TAGS and not (tag == "header" and region):
        bad = True
    if values.get("role", "").lower() in BAD_ROLES or "hidden" in values or values.get("aria-hidden", "").lower() == "true":
        bad = True
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", values.get("style", ""), re.IGNORECASE):
        bad = True
    names = pieces & BAD_NAMES - ({"header"} if region else set())  # the header of an article belongs to it
    if names and not main and tag not in MAIN_TAGS and tag not in ("html", "body") and not pieces & {"with", "has", "no"}:
        bad = bad or not (tag in ("h1", "h2", "h3", "h4", "h5", "h6") and region)
    if main and not bad and not region:
        regions.append(len(regions) + 1)
        region = regions[-1]
    return _Open(tag, bad, region)


def blocks(page: str) -> list[Block]:
    """The blocks of a page that have text, in page order."""
    regions: list[int] = []
    stack = [_Open("", False, 0)]
    places: dict[str, list[int]] = {}  # of each tag in the stack; finding one takes no walk, whatever the depth
    block_places: list[int] = []
    out: list[Block] = []
    now = Block("", 0, False)
    links, breaks, at = 0, 0, 0
    shut: set[int] = set()  # regions whose rest is readers' comments

    def push(own: _Open) -> None:
        places.setdefault(own.tag, []).append(len(stack))
        if own.tag in BLOCK_TAGS:
            block_places.append(len(stack))
        stack.append(own)

    def cut(depth: int) -> None:
        while len(stack) > depth:
            own = stack.pop().tag
            places[own].pop()
            if own in BLOCK_TAGS:
                block_places.pop()

    def finish(tag: str) -> None:
        nonlocal now, breaks
        now.text = " ".join(entities.unescape("".join(now.parts)).split())
        if now.text:
            if now.region in shut:
                now.bad = True
            if now.tag[:1] == "h" and now.text.strip(" :").lower() in COMMENT_TITLES:
                now.bad = True
                shut.add(now.region)
            out.append(now)
        now, breaks = Block(tag, stack[-1].region, stack[-1].bad), 0

    def add(text: str) -> None:
        nonlocal breaks
        now.parts.append(text)
        if not text.isspace():
            breaks = 0
            if links:
                now.linked += len(" ".join(text.split()))

    for m in _TAG.finditer(page):
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        tag = (m.group("name") or "").lower()
        if not tag:
            continue
        if tag == "a":
            links = 0 if m.group("close") else 1
        elif tag == "br":
            breaks += 1
            now.parts.append(" ")
            if breaks > 1:
                finish(now.tag)
        elif m.group("close"):
            if tag in BLOCK_TAGS:
                finish("")
            own_places = places.get(tag)
            # an inline end tag closes no block around what it ends
            if own_places and (tag in BLOCK_TAGS or not block_places or block_places[-1] < own_places[-1]):
                cut(own_places[-1])
            if tag in BLOCK_TAGS:
                now.region, now.bad, links = stack[-1].region, stack[-1].bad, 0
        elif tag in VOID_TAGS:
            if tag == "hr":
                finish("")
        else:
            rest = m.group("rest") or ""
            values = _attributes(rest)
            if tag in BLOCK_TAGS:
                finish(tag)
                if tag not in ("span", "b"):
                    while stack[-1].tag in ("p", "b", "i", "em", "strong", "span", "a", "u", "font", "small"):
                        cut(len(stack) - 1)  # a block ends an open paragraph and what is left open in it
                if tag in ("li", "tr", "td", "th", "dt", "dd", "option"):
                    siblings = {"li": ("li",), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",)}[tag]
                    while stack[-1].tag in siblings:
                        cut(len(stack) - 1)
                if tag in MAIN_TAGS or MAIN_NAMES & set(_PIECES.findall(" ".join(values.values()))):
                    cut(min(p[0] for p in (places.get("nav"), places.get("head"), [len(stack)]) if p))  # never closed
                if tag == "body":
                    cut(1)
                links = 0
            telling = rest or tag in BAD_TAGS or tag in MAIN_TAGS
            own = _judge_tag(tag, values, stack[-1], regions) if telling else _Open(tag, stack[-1].bad, stack[-1].region)
            if not rest.endswith("/"):
                push(own)
            if tag in BLOCK_TAGS:
                now.region, now.bad = own.region, own.bad
    if at < len(page):
        add(page[at:])
    finish("")
    return out


def points(size: int, stop: float, linked: float, region: int, bad: bool, listed: bool) -> int:
    """What length, share of stop words, share of linked text and container say about a block."""
    total = WEIGHTS["container"] * (-3 if bad else 1 if region else 0)
    if linked > (LINKED if region else LINKED_OUTSIDE) and (listed or not region):
        total += WEIGHTS["links"] * -3
    if size >= SHORT:
        total += WEIGHTS["length"]
        total += WEIGHTS["stop"] * (1 if stop >= HIGH_STOP else -1 if stop < LOW_STOP else 0)
    return total


def _verdict(total: int) -> bool | None:
    return True if total >= 2 else False if total <= -1 else None


def _stop_share(text: str) -> float:
    words = _WORD.findall(text.lower())
    return sum(map(STOP_WORDS.__contains__, words)) / max(len(words), 1)


def first_pass(block: Block) -> None:
    """Decides a block by its points, or leaves it open."""
    size = len(block.text)
    listed = block.tag in ("li", "td", "div", "ul", "")
    bad = block.bad or block.text.strip(" :").lower() in LABELS
    block.good = _verdict(points(size, _stop_share(block.text), block.linked / max(size, 1), block.region, bad, listed))


def second_pass(page: list[Block]) -> None:
    """Gives every open block the label of the nearest decided one of its region; ties are good."""
    by_region: dict[int, list[Block]] = {}
    for block in page:
        by_region.setdefault(block.region, []).append(block)
    for region, own in by_region.items():
        before: list[tuple[int, bool] | None] = []
        last = None
        for k, block in enumerate(own):
            last = (k, block.good) if block.good is not None else last
            before.append(last)
        if last is None or region and not any(b.good for b in own):  # nothing speaks for any block alone
            text = " ".join(b.text for b in own if b.good is None)
            linked = sum(b.linked for b in own if b.good is None) / max(len(text), 1)
            alike = points(len(text), _stop_share(text), linked, region, False, False) >= 1
            for block in own:
                block.good = alike if block.good is None else block.good
            continue
        last = None
        for k in range(len(own) - 1, -1, -1):
            block = own[k]
            if block.good is not None:
                last = (k, block.good)
                continue
            near = [(abs(k - at), not good) for at, good in filter(None, (before[k], last))]
            block.good = not min(near)[1]


def main_text(page: str | None) -> str:
    """The good blocks of a page, joined by line ends."""
    if not page:
        return ""
    found = blocks(page)
    for block in found:
        first_pass(block)
    second_pass(found)
    if any(b.region and b.good for b in found):
        found = [b for b in found if b.region]
    return "\n".join(b.text for b in found if b.good)


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """Adds ``text`` (empty if there is none) and ``n_chars``, its code points."""
    text = F.arrow_udf(lambda column: pa.array([main_text(x) for x in column.to_pylist()], pa.string()), "string").asNondeterministic()
    return pages.withColumn("text", text(F.col(html))).withColumn("n_chars", F.length("text").cast("bigint"))


def op6_html_text(spark, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet")).select("page_id", "url", "text", "n_chars")
