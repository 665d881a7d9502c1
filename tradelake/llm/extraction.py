"""Main text of web pages by two passes of block rules.

A page is cut into blocks at block-level tags. The first pass labels a block by the
element it stands in, by its share of link text, by its length and by its share of
stop words. Short blocks and blocks of middling stop-word share stay undecided; in
the second pass they take the label of the nearest decided neighbours.

Of several articles the one with the most words is the page's, beside those of at least
half its words; teasers and comments that are articles too go.

Null and empty html give an empty text, as do pages without a good block. Repeated
pages are extracted each. Texts of any length are handled whole, in time in proportion to
their length, also where tags, quotes and comments are never closed. An empty table gives
an empty result; a kept column with the name of a result gets ``_in``.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tradelake.llm.common import apart, by_batch, kept_schema

#: Frequent words of four languages (fixed values).
STOP_WORDS = frozenset(
    """a an and are as at be been but by can for from had has have he her his if in into is it its more
    no not of on one or our she so than that the their them then there these they this to was we were what
    when which who will with would you
    aber als am an auch auf aus bei bis das dass dem den der des die durch ein eine einem einen einer er es
    für hat ich im ist man mit nach nicht noch nur oder sein sich sie sind so über um und uns von vor war
    wenn werden wie wir wird zu zum zur
    au aux avec ce ces cette dans de des du elle en est et il ils je la le les leur lui mais ne nous on ont
    ou par pas plus pour qu que qui sa se ses son sont sur un une vous
    al como con del el ella en entre era es esta este ha hay la las lo los más me mi muy no nos o para pero
    por que se ser si sin sobre son su sus también un una y ya""".split()
)

#: Elements whose whole content is no text of the page.
HIDDEN = frozenset("script style noscript template svg math iframe object canvas head title textarea select datalist".split())
#: Elements that hold what surrounds an article.
AROUND = frozenset("nav footer aside form menu dialog button fieldset".split())
#: Elements that begin and end a block.
BLOCK = frozenset(
    """address article aside blockquote body center caption dd details dialog dir div dl dt fieldset figcaption
    figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup
    option p pre section summary table tbody td tfoot th thead tr ul""".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: A new one of these ends an open one of the same group.
CLOSES = {"p": BLOCK - {"p"} | {"p"}, "li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option", "optgroup"}}
#: Words of classes, ids and roles that name what surrounds an article (fixed values).
AROUND_NAMES = frozenset(
    """ad ads advert adverts advertisement advertising adbox adsense banner breadcrumb breadcrumbs
    consent contentinfo cookie cookies dialog disclaimer footer footnav gdpr
    header login masthead menu modal nav navbar navigation navi newsletter notice notices notification
    outbrain pagination popup promo promotion respond search
    share sharing sidebar signup social subscribe subscription taboola toolbar topbar
    widget widgets alert complementary""".split()
)
#: Words that name what readers wrote or what leads to other articles: an article below is one of these.
OTHER_NAMES = frozenset("comment comments commentlist disqus replies reply related recommended promoted sponsor sponsored teaser teasers".split())
#: Of the names above, those that are common as a part of a name that means something else.
WEAK_NAMES = frozenset("alert dialog header notice search share widget widgets".split())
#: Of the names above, those that stand before the word they qualify.
QUALIFYING = frozenset("related recommended promoted sponsored".split())
#: Words that follow the word that counts, as in footer-wrapper or comment-list.
BEHIND_NAMES = frozenset(
    """area articles bar block body bottom box button buttons column container content form global group inner item items left link
    links list media outer page panel policy posts primary right secondary section slot stories text title top unit wrap wrapper x""".split()
)
#: Words that stand beside weak names in compounds, as in site-header.
BESIDE_NAMES = BEHIND_NAMES | frozenset("main post site".split()) - frozenset("content articles stories text title".split())
#: Words that say that a name tells of a state and not of what an element is.
STATE_NAMES = frozenset("has no not with without hide show is js".split())

LINKED, SHORT_WORDS, LONG_WORDS, STOP_HIGH, STOP_LOW = 0.33, 10, 20, 0.20, 0.08

#: A tag whose attribute values hold no "<": looks no further than the next one.
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/><]*+)((?:[^>"'<]++|"[^"<]*+"|'[^'<]*+')*+)>""")
#: The rest of a tag with any values in quotes.
_REST = re.compile(r"""((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
_BEGIN = re.compile(r"<(/?)([a-zA-Z][^\s/><]*+)")
#: Tags that may look for the end of a quote as far as the page's end before all are cut at the first ">".
FAR_LOOKS = 3
_ATTRIBUTE = re.compile(r"""([^\s=/>"']++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>]++))?""")
_UNSHOWN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)\b", re.I)
_TOKEN = re.compile(r"[A-Za-z0-9_:-]+")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_SPACE = re.compile(r"\s+")
_HEAD_END = re.compile(r"</head\s*>|<body\b", re.I)


class Block:
    """Text of one block, how much of it is link text, and where it stands."""

    __slots__ = ("text", "linked", "words", "stops", "around", "inside", "article", "heading", "good")

    def __init__(self, parts: list[tuple[str, bool]], around: bool, inside: bool, article: int, heading: bool) -> None:
        self.text = _SPACE.sub(" ", entities.unescape("".join(p for p, _ in parts))).strip()
        linked = sum(len(_SPACE.sub(" ", p).strip()) for p, link in parts if link)
        words = self.text.lower().split(" ") if self.text else []
        self.words = len(words)
        self.stops = sum(w.strip(".,;:!?()\"'") in STOP_WORDS for w in words) / max(1, len(words))
        self.linked = linked / max(1, len(self.text))
        self.around, self.inside, self.article, self.heading = around, inside, article, heading
        self.good: bool | None = None


#: How an element comes to surround an article: by its class, id or role, or else for good.
BY_NAME, FOR_GOOD = 1, 2


def _marks(token: str) -> int:
    """Whether a class, id or role names surroundings, and which.

    Of a compound the word counts that the words behind it leave, unless one tells of a
    state. A weak name has to stand alone or beside words of place.
    """
    if not _TOKEN.fullmatch(token):
        return 0
    parts = [part.lower() for part in _NAME.findall(token)]
    if not parts or STATE_NAMES.intersection(parts):
        return 0
    if QUALIFYING.intersection(parts):
        return FOR_GOOD
    if len(parts) > 1 and parts[0] == "content" and parts[1] not in OTHER_NAMES:
        return 0  # a frame around the text and something beside it
    last = len(parts)
    while last > 1 and parts[last - 1] in BEHIND_NAMES and parts[last - 1] not in AROUND_NAMES:
        last -= 1
    head = parts[last - 1]
    if head in OTHER_NAMES:
        return FOR_GOOD
    if head in WEAK_NAMES:
        return BY_NAME if set(parts) <= AROUND_NAMES | BESIDE_NAMES else 0
    return BY_NAME if head in AROUND_NAMES else 0


def _surrounds(name: str, attributes: str, inside: bool) -> int:
    if name in AROUND or name == "header" and not inside:
        return FOR_GOOD
    if name in ("body", "html", "article", "main"):
        return 0
    named = 0
    for m in _ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), (m[2] or "").strip("\"'")
        if key == "hidden" or key == "aria-hidden" and value.strip().lower() == "true" or key == "style" and _UNSHOWN.search(value):
            return FOR_GOOD
        if key in ("class", "id", "role"):
            named = max(named, *map(_marks, value.split()), 0)
    return named


def _inherits(around: int, name: str, attributes: str, inside: bool) -> int:
    """What an element takes over from the one around it.

    An article undoes a label by a name of place, unless it stands in another article or is
    itself named as surroundings; what stands among comments or teasers is one of them.
    """
    if around == BY_NAME and not inside and name in ("article", "main") and not _surrounds("", attributes, inside):
        return 0
    return around


def tags(page: str) -> Iterator[tuple[int, int, bool, str | None, str]]:
    """Begin, end, whether it closes, name and attributes of every tag; comments have no name.

    A tag without an end in sight is cut at the first ">" behind it, and one without any is
    text, so every character is passed a bounded number of times.
    """
    at, looks = page.find("<"), FAR_LOOKS
    while at >= 0:
        if tag := _TAG.match(page, at):
            yield at, tag.end(), bool(tag[1]), tag[2].lower(), tag[3]
            at = page.find("<", tag.end())
            continue
        end = -1
        if page.startswith("<!--", at) or page.startswith("<![CDATA[", at):
            mark = "-->" if page[at + 2] == "-" else "]]>"
            end = page.find(mark, at + 4)
            end = end + 3 if end >= 0 else len(page)
            yield at, end, False, None, ""
        elif page.startswith(("<!", "<?"), at):
            end = page.find(">", at) + 1
            if not end:
                return
            yield at, end, False, None, ""
        elif begin := _BEGIN.match(page, at):
            rest = _REST.match(page, begin.end()) if looks else None
            if rest is None:
                looks = max(0, looks - 1)
            if rest is None or "</" in rest[1]:  # a quote that was left open
                end = page.find(">", begin.end()) + 1
                if not end:
                    return
                yield at, end, bool(begin[1]), begin[2].lower(), page[begin.end() : end - 1]
            else:
                end = rest.end()
                yield at, end, bool(begin[1]), begin[2].lower(), rest[1]
        at = page.find("<", end if end >= 0 else at + 1)


class _Open:
    """The open elements: name, how it surrounds, whether it is or is in an article, and in which."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, int, bool, int]] = []
        self.counts: Counter[str] = Counter()

    @property
    def last(self) -> tuple[str, int, bool, int]:
        return self.stack[-1] if self.stack else ("", 0, False, 0)

    def push(self, name: str, around: int, inside: bool, article: int) -> None:
        self.stack.append((name, around, inside, article))
        self.counts[name] += 1

    def pop(self) -> str:
        name = self.stack.pop()[0]
        self.counts[name] -= 1
        return name

    def pop_to(self, name: str) -> None:
        while self.pop() != name:
            pass

    def heading(self) -> bool:
        return any(self.counts[f"h{k}"] for k in range(1, 7))


def blocks(page: str) -> list[Block]:
    """The blocks of a page in order, without hidden content."""
    found: list[Block] = []
    parts: list[tuple[str, bool]] = []
    elements = _Open()
    ends: dict[str, bool] = {}  # whether a search for the end of the head can still succeed
    links = breaks = at = articles = 0

    def close() -> None:
        nonlocal parts
        if any(p.strip() for p, _ in parts):
            _, around, inside, article = elements.last
            block = Block(parts, around > 0, inside, article, elements.heading())
            if block.text:
                found.append(block)
        parts = []

    for begin, end, closing, name, attributes in tags(page):
        if begin < at:  # inside hidden content
            continue
        if begin > at:
            text = page[at:begin]
            parts.append((text, links > 0))
            breaks = breaks if text.isspace() else 0
        at = end
        if name is None:
            continue
        if name in HIDDEN:
            if not closing and not attributes.endswith("/"):
                if name != "head":
                    over = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(page, at)
                    at = over.end() if over else len(page)
                elif ends.get(name, True):  # its end tag may be missing
                    over = _HEAD_END.search(page, at)
                    ends[name] = over is not None
                    at = at if over is None else over.start() if over[0][1] != "/" else over.end()
            continue
        if name == "br":
            breaks += 1
            if breaks >= 2:
                close()
            else:
                parts.append((" ", False))
            continue
        if name == "a":
            links = 0 if closing else 1
        _, around, inside, article = elements.last
        if name not in BLOCK:
            if not closing and name not in VOID and not attributes.endswith("/"):
                own = 0 if around else _surrounds(name, attributes, inside)
                if own:
                    close()
                    elements.push(name, own, inside, article)
            elif closing and elements.counts[name]:
                close()
                elements.pop_to(name)
            continue
        close()
        breaks = links = 0
        if closing:
            if elements.counts[name]:
                elements.pop_to(name)
        elif name not in VOID:
            while elements.stack and name in CLOSES.get(elements.stack[-1][0], ()):
                elements.pop()
            _, around, inside, article = elements.last
            around = _inherits(around, name, attributes, inside)
            if name == "article" and not article:
                articles += 1
                article = articles
            inside = inside or name in ("article", "main")
            elements.push(name, max(around, _surrounds(name, attributes, inside)), inside, article)
    if at < len(page):
        parts.append((page[at:], links > 0))
    close()
    return found


def pick_articles(found: list[Block]) -> None:
    """Of several articles, mark those as surroundings that have under half the words of the largest."""
    words: Counter[int] = Counter()
    for b in found:
        if b.article and not b.around and b.linked <= LINKED:
            words[b.article] += b.words
    if len(words) > 1:
        most = max(words.values())
        for b in found:
            if b.article and 2 * words[b.article] < most:
                b.around = True


def label(found: list[Block]) -> None:
    """Both passes; afterwards every block is good or not."""
    framed = any(b.inside and not b.around for b in found)
    for b in found:
        if b.around or framed and not b.inside or b.linked > LINKED:
            b.good = False
        elif b.words < SHORT_WORDS:
            b.good = None
        elif b.stops >= STOP_HIGH or framed and b.words >= LONG_WORDS:
            b.good = True
        elif b.stops < STOP_LOW and not framed:
            b.good = False if b.words >= LONG_WORDS else None
    first = [b.good for b in found]
    decided = [k for k, good in enumerate(first) if good is not None]
    near = 0
    for k, b in enumerate(found):
        if b.good is not None:
            continue
        while near < len(decided) and decided[near] < k:
            near += 1
        before = decided[near - 1] if near else None
        after = decided[near] if near < len(decided) else None
        # Inside an article its own blocks count; what surrounds it is no neighbour.
        sides = [s for s in (before, after) if s is not None and not (framed and not first[s] and found[s].around)]
        if not sides:
            b.good = framed and b.inside
        else:
            nearest = min(abs(s - k) for s in sides)
            votes = [first[s] for s in sides if abs(s - k) == nearest]
            # A heading belongs to what follows it; in a tie the good side wins in an article.
            if len(set(votes)) > 1:
                b.good = bool(first[after]) if b.heading else framed
            else:
                b.good = bool(votes[0])


def main_text(page: str | None) -> str:
    """The good blocks of a page, one per line."""
    found = blocks(page or "")
    pick_articles(found)
    label(found)
    return "\n".join(b.text for b in found if b.good)


def extract(pages: DataFrame, keep: list[str], html: str = "html") -> DataFrame:
    """``keep`` columns of each page with ``text`` and ``n_chars`` of its main text."""
    rows, named = apart(pages, keep, ["text", "n_chars"], html=html)

    def run(batch: pa.RecordBatch) -> dict[str, object]:
        texts = [main_text(page) for page in batch.column("html").to_pylist()]
        kept = {name: batch.column(name) for name in batch.schema.names}
        return kept | {"text": texts, "n_chars": [len(t) for t in texts]}

    return named(by_batch(rows, run, kept_schema(rows, "text string", "n_chars long")))
