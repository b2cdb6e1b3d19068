"""The main text of HTML pages by two passes over their blocks.

A page is cut into blocks at block-level tags; scripts, styles, comments and other invisible
parts go.  First pass, each block on its own: it is boilerplate if it lies in a part that is
no article (navigation, footer, aside, form, or a name in its class, id or role that
says so) or most of it is links; it is content if it is long, has few links and enough
stop words; otherwise it is undecided.  Second pass: undecided blocks take the
label of the nearest decided ones, content on equal distance.

A name says so if it is or ends in a mark ("comments", "user-comments"), or only words of
layout follow the mark ("share-buttons"); not if it tells a state or a topic ("no-sidebar",
"category-social").  Forms and names are no verdict against the page as a whole:

* a form counts for nothing if it holds an <article> or <main>, or most of the page's text in
  long blocks of few links while no <article> lies outside;
* a name of several words counts for nothing on or around <main>, or where two of these hold: it
  is around an <article> without such a name, it holds most of that text, no <article> lies outside;
* a name that is a mark counts for nothing on or around <main>, or where it is on or around
  an <article> and holds most of that text.

Where a page has a <main> with a long block of few links, or <article> and <main> hold half of
the text in such blocks, the rest is boilerplate; in them few stop words are no
verdict.  Where less than half of that text has enough stop words, the page is in none of their
languages, and long blocks of few links are content.  Parts that are no article have no vote, and
where nothing is decided, undecided blocks are content.

Inside a block, white space becomes one space; <br> counts as white space.  Blocks are joined by
an empty line.  Character references are decoded.

Defined cases: null and empty html give an empty text; broken markup is read as far as
its tags go (an open quote ends at the next >; an element that is never closed ends where the
block around it does); repeated rows give repeated results;
other columns are not carried; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# HTML's elements that begin and end a block, those whose content is not shown as
# text, and those that are no part of an article.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p "
    "pre section summary table tbody td tfoot th thead tr ul".split()
)
CONTAINERS = BLOCK_TAGS - frozenset("dd dt h1 h2 h3 h4 h5 h6 hr html li p td th tr".split())
DROPPED = frozenset(
    "applet audio button canvas datalist head iframe map math noscript object script select style "
    "svg template textarea title video".split()
)
RAW = frozenset("script style textarea title".split())
# Of these, what may stand in for an element that is never closed is the page's own text.
FALLBACK = frozenset("applet audio canvas map noscript object video".split())
NO_ARTICLE = frozenset("aside dialog footer menu nav".split())
# Words in a class, id or role that mark parts other than the article.
MARKS = frozenset(
    "ad ads advert adverts advertisement alert banner breadcrumb breadcrumbs comment comments "
    "complementary consent contentinfo cookie cookies dialog disclaimer disqus footer gdpr login "
    "masthead menu modal nav navbar navigation newsletter notice notices pagination pager popup "
    "promo promoted related replies reply search share sharing sidebar signup social sponsor "
    "sponsored subscribe subscription toolbar widget".split()
)
# Words behind a mark that leave it one, and words with which a name of several
# words is no mark.
LAYOUT = frozenset(
    "area areas articles bar block body bottom box btn button buttons card cards column container "
    "content contents controls form group holder icon icons inner input items label left line link "
    "links list main message outer overlay panel placeholder posts primary respond right row "
    "secondary section slot stories text thread title tools top unit wrap wrapper".split()
)
STATES = frozenset(
    "cat category closed disabled enabled format free has have hide hides is no non not off on open "
    "show shows tag tax topic type with without".split()
)
# Frequent words of English, German, French and Spanish.
STOP_WORDS = frozenset(
    "a an and are as at be by for from has have in is it of on or that the this to was were which "
    "with not but they you he she we his her "
    "aber als am an auch auf aus bei bis das dass dem den der des die durch ein eine einem einen "
    "einer es für hat im in ist mit nach nicht oder sich sie sind um und von war wie wird zu zum "
    "au aux avec ce ces cette dans de des du elle en est et il ils je la le les leur lui mais ne "
    "nous on ou par pas plus pour que qui sa se ses son sur un une vous "
    "al como con del el ella en era es esta este ha la las lo los más muy no o para pero por que "
    "se ser sin sobre son su sus también un una y ya".split()
)

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>(?:[^\"'>]|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<close2>/?)(?P<tag2>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest2>[^>]*)>"
    r"|<[!?][^>]*>",
    re.S,
)
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
HIDDEN = re.compile(
    r"""\shidden(?=[\s=/]|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I
)
PARTS = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]+")
WORDS = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Rules:
    long: int = 80  # characters of a block that can decide by itself
    links: float = 0.4  # share of link text above which a block is boilerplate
    stops: float = 0.2  # share of stop words from which a long block is content
    most: float = 0.5  # share of the long blocks' text above which a part is most of the page


@dataclass
class Block:
    text: str
    link: int  # characters within links
    barred: bool  # in a part that is no article
    article: bool
    main: bool
    part: Part | None  # the innermost form or named part around it


@dataclass
class Part:
    """An element that is no article unless the page as a whole says otherwise."""

    kind: str  # "form", "mark" or "name": a name that is a mark, or one of several words
    up: Part | None
    article: bool = False  # is an <article>
    main: bool = False  # is or holds a <main>
    holds: bool = False  # holds an <article> that is not named itself
    size: int = 0  # of the text in long blocks of few links
    direct: bool = False  # has a block of an article in no further part
    beside: bool = False  # such a block is in what holds this part
    barred: bool = False


def mark_of(rest: str) -> str:
    """What an element's class, id and role say: "mark" if one of their names is a mark, "name"
    if one of several words has one, else ""."""
    if "=" not in rest:
        return ""
    found = ""
    for named in NAMES.findall(rest):
        for name in named.strip("\"'").split():
            parts = [p.lower() for p in PARTS.findall(name)]
            last = max((i for i, p in enumerate(parts) if p in MARKS), default=-1)
            if last < 0 or (len(parts) > 1 and not STATES.isdisjoint(parts)):
                continue
            if len(parts) == 1:
                return "mark"
            if LAYOUT.issuperset(parts[last + 1 :]):
                found = "name"
    return found


def blocks_of(html: str, rules: Rules = Rules()) -> list[Block]:
    """The page's blocks that have text, in order."""
    out: list[Block] = []
    held: list[str] = []
    in_link = link = 0
    made: list[Part] = []
    outside = ("", False, False, False, None)  # element, barred, in article, in main, part
    stack: list[tuple[str, bool, bool, bool, Part | None]] = []
    own_bar = False  # of the present block alone
    opened: Counter[str] = Counter()  # elements on the stack
    ends: dict[str, dict[int, int]] = {}  # of dropped elements: begin to end
    at = 0

    def end_block() -> None:
        nonlocal link, held
        text = " ".join("".join(held).split())
        if text:
            _, barred, article, main, part = stack[-1] if stack else outside
            out.append(Block(text, link, barred or own_bar, article, main, part))
        held, link = [], 0

    def add(piece: str) -> None:
        nonlocal link
        if piece:
            piece = unescape(piece)
            held.append(piece)
            if in_link:
                link += len(piece.strip())

    last = html.rfind(">")
    while at < len(html):
        if at > last:  # no tag ends any more, at most a comment begins
            comment = html.find("<!--", at)
            add(html[at:] if comment < 0 else html[at:comment])
            break
        found = TOKEN.search(html, at)
        if not found:
            add(html[at:])
            break
        add(html[at : found.start()])
        at = found.end()
        tag = (found["tag"] or found["tag2"] or "").lower()
        if not tag:
            continue
        closing = bool(found["close"] or found["close2"])
        rest = found["rest"] or found["rest2"] or ""
        if tag in DROPPED:
            if not closing and not rest.endswith("/"):
                if tag in RAW or tag == "head":
                    at = _after(html, tag, at)
                else:
                    if tag not in ends:
                        ends[tag] = _ends(html, tag, found.start())
                    at = ends[tag].get(found.start()) or _unclosed(html, tag, at)
            continue
        if tag == "a":
            in_link = 0 if closing else 1
        elif tag == "br":
            held.append(" ")
        if tag not in BLOCK_TAGS:
            continue
        end_block()
        own_bar = False
        if tag not in CONTAINERS:
            own_bar = not closing and bool(mark_of(rest) or HIDDEN.search(rest))
        elif closing:
            if opened[tag]:
                ended = None
                while ended != tag:
                    ended = stack.pop()[0]
                    opened[ended] -= 1
        else:
            _, barred, article, main, part = stack[-1] if stack else outside
            article, main = article or tag in ("article", "main"), main or tag == "main"
            barred = barred or tag in NO_ARTICLE or (tag == "header" and not article)
            barred = barred or (tag != "body" and bool(HIDDEN.search(rest)))
            mark = mark_of(rest) if tag != "body" else ""
            if part and not barred:
                part.main = part.main or tag == "main"
                part.holds = part.holds or (tag in ("article", "main") and not mark)
            if tag == "form":
                part = Part("form", part)
                made.append(part)
            if mark:
                part = Part(mark, part, tag == "article", tag == "main" and not barred)
                made.append(part)
            stack.append((tag, barred, article, main, part))
            opened[tag] += 1
    end_block()
    bar_parts(out, made, rules)
    return out


def is_long(block: Block, rules: Rules) -> bool:
    """Long and of few links."""
    return len(block.text) >= rules.long and block.link <= rules.links * len(block.text)


def bar_parts(blocks: list[Block], parts: list[Part], rules: Rules) -> None:
    """Bar the blocks of forms and named parts that the page as a whole does not clear; a part
    comes behind those around it."""
    if not parts:
        return
    free = [b for b in blocks if not b.barred]
    total, direct = 0, False
    for b in free:
        size = len(b.text) if is_long(b, rules) else 0
        total += size
        if b.part:
            b.part.size += size
            b.part.direct = b.part.direct or b.article
        else:
            direct = direct or b.article
    for part in reversed(parts):
        if part.up:
            part.up.size += part.size
            part.up.main = part.up.main or part.main
            part.up.holds = part.up.holds or part.holds
    for part in parts:
        # Articles that are barred, if at all, by what bars this part too.
        part.beside = (part.up.beside or part.up.direct) if part.up else direct
        alone, most = not part.beside, part.size > rules.most * total
        if part.kind == "form":
            clear = part.main or part.holds or (most and alone)
        elif part.kind == "name":
            clear = part.main or alone + most + (part.holds or (part.article and most)) > 1
        else:
            clear = part.main or (most and (part.holds or part.article))
        part.barred = not clear or (part.up is not None and part.up.barred)
    for b in free:
        b.barred = b.part is not None and b.part.barred


def _after(html: str, tag: str, at: int) -> int:
    """The place behind the end of an element of raw text; of <head>, also <body> if its end
    is missing."""
    end = re.compile(rf"</{tag}\b[^>]*>" + ("|<body\\b" if tag == "head" else ""), re.I)
    found = end.search(html, at)
    if not found:
        return at if tag == "head" else len(html)
    return found.start() if found[0][:5].lower() == "<body" else found.end()


def _ends(html: str, tag: str, at: int) -> dict[int, int]:
    """Where each element of this kind that is closed begins and ends, from ``at`` on; what
    stands in scripts and styles does not count."""
    either = re.compile(rf"<(/?)({tag}|script|style)\b[^<>]*>", re.I)
    out: dict[int, int] = {}
    begun: list[int] = []
    while found := either.search(html, at):
        at, name = found.end(), found[2].lower()
        if name in RAW:
            if not found[1]:
                at = _after(html, name, at)
        elif not found[1]:
            if not found[0].endswith("/>"):
                begun.append(found.start())
        elif begun:
            out[begun.pop()] = at
    return out


BLOCK_EDGE = re.compile(rf"</?(?:{'|'.join(sorted(BLOCK_TAGS))})\b", re.I)


def _unclosed(html: str, tag: str, at: int) -> int:
    """Where the page goes on if an element is never closed: at once, or where the next block
    begins or the present one ends."""
    if tag in FALLBACK:
        return at
    edge = BLOCK_EDGE.search(html, at)
    return edge.start() if edge else len(html)


def stop_share(text: str) -> float:
    words = [w.lower() for w in WORDS.findall(text)]
    return sum(w in STOP_WORDS for w in words) / max(1, len(words))


def labels_of(blocks: list[Block], rules: Rules) -> list[int]:
    """1 content, 0 boilerplate, -1 undecided."""
    free = [not b.barred and b.link <= rules.links * len(b.text) for b in blocks]
    stops = {i: stop_share(b.text) for i, b in enumerate(blocks) if free[i] and is_long(b, rules)}
    told = sum(len(blocks[i].text) for i, share in stops.items() if share >= rules.stops)
    listed = 2 * told >= sum(len(blocks[i].text) for i in stops)  # a language of the stop words
    out = []
    for i, block in enumerate(blocks):
        if not free[i]:
            out.append(0)
        elif i not in stops:
            out.append(-1)
        elif stops[i] >= rules.stops or not listed:
            out.append(1)
        else:
            out.append(-1 if block.article or stops[i] >= rules.stops / 2 else 0)
    return out


def main_text(html: str, rules: Rules = Rules()) -> str:
    blocks = blocks_of(html, rules)
    labels = labels_of(blocks, rules)
    kept = [i for i, b in enumerate(blocks) if not b.barred]
    text = [blocks[i] for i in kept if is_long(blocks[i], rules)]
    within = sum(len(b.text) for b in text if b.article)
    if any(b.main for b in text) or 2 * within >= sum(len(b.text) for b in text):
        if any(blocks[i].article for i in kept):
            kept = [i for i in kept if blocks[i].article]
    # Distance to the nearest content and boilerplate before and behind, in two sweeps.
    far = len(blocks) + 1
    near = {i: [far, far] for i in kept}
    for order in (kept, kept[::-1]):
        seen = [far, far]
        for i in order:
            seen = [seen[0] + 1, seen[1] + 1]
            if labels[i] >= 0:
                seen[labels[i]] = 0
            near[i] = [min(a, b) for a, b in zip(near[i], seen, strict=True)]
    content = []
    for i in kept:
        bad, good = near[i]
        undecided = labels[i] < 0
        if labels[i] == 1 or (undecided and (good <= bad or min(good, bad) >= far)):
            content.append(blocks[i].text)
    return "\n\n".join(content)


def extract(pages: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """page_id, url, text and n_chars of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h or "", rules) for h in batch.column("html").to_pylist()]
            yield pa.record_batch(
                {
                    "page_id": batch.column("page_id"),
                    "url": batch.column("url"),
                    "text": pa.array(texts, pa.string()),
                    "n_chars": pa.array([len(t) for t in texts], pa.int64()),
                }
            )

    return pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
    ).mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
