"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags.  The first pass marks each
block good, bad, near-good or short from its stop-word density, length and
link density, and from the kind of element that holds it.  The second pass
gives short and near-good blocks the label of their nearest decided
neighbours.  The stop words of some languages are listed; on pages of others
length and link density alone decide.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

#: A comment, a tag (quoted values may hold ">"), text, or a stray "<".
_TOKEN = re.compile(
    r"<!--(?s:.*?)(?:-->|\Z)|<(?P<end>/?)(?P<tag>[A-Za-z][A-Za-z0-9:-]*)(?P<rest>(?:[^\"'>]++|\"[^\"]*+\"|'[^']*+')*+[^>]*+)(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)|(?P<text>[^<]++)|(?P<stray><)")
_ATTR = re.compile(r"(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_RAW = {t: re.compile(rf"</{t}(?=[\s/>]|\Z)", re.I) for t in ("script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes")}
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section select summary table tbody td
tfoot th thead tr ul""".split())
_INLINE = frozenset("a b em font i span strong u".split())
#: Elements that never hold article text, and those that do so only inside an article.
_NEVER = frozenset("""aside audio button canvas datalist dialog embed fieldset footer head iframe input label map math menu nav
noembed noframes noscript object option progress script select style svg template textarea title video xmp""".split())
_REGION = frozenset(("article", "main"))
#: Names in class, id or role that mark furniture around an article; also joined with each other or with words of place.
_FURNITURE = frozenset("""ad ads adbox advert adverts advertisement advertising alert banner breadcrumb breadcrumbs byline captcha comment
comments commentlist complementary consent contentinfo cookie cookies copyright disclaimer disqus dialog footer form gdpr header hidden legal
login masthead menu modal nav navbar navigation newsletter notice notification pager pagination popup promo promotion recommended related
replies reply respond search share sharing sidebar signup social sponsor sponsored subscribe subscription taboola tagcloud tags teaser toolbar
toc widget widgets""".split())
_TALK = frozenset("comment comments commentlist usercomments disqus discussion discussions feedback replies reply respond responses reviews".split())
#: Of these one part is enough, whatever else is in the name, unless a word of ``_STATES`` says that it is about the page.
_DECISIVE = frozenset("""ad ads advert adverts advertisement advertising comment comments commentlist consent cookie cookies discussion disqus gdpr
newsletter promo recommended related reviews sidebar sponsor sponsored taboola teaser""".split())
_STATES = frozenset("closed disabled enabled fixed has layout no off on open with without".split())
_PLACE = frozenset("area bar block body box button buttons container global icons inner item items link links list main page panel section site wrap wrapper".split())

#: Frequent function words of some languages (short lists; only their share matters).
STOP_WORDS = frozenset("""
a an and are as at be by for from has have he in is it not of on or that the this to was were which with you
als auch auf aus bei das dem den der des die ein eine einer er es für ich im ist mit nicht sich sie und von war wie zu
au avec ce dans de des du elle en est et il la le les ne pas par pour que qui se sur un une
al como con del el ella ellos en es esta la las lo los más no para por se ser su sus un una y
che di e ha il non per sono da do em não os são uma het een van
""".split())

MIN_LENGTH, GOOD_LENGTH = 70, 200
LOW_STOPS, HIGH_STOPS = 0.10, 0.25
MAX_LINKS = 0.33
_WORD = re.compile(r"[^\W\d_]+")


#: Short lines outside an article that are no text of it.
_LEGAL = re.compile(r"©|\bcopyright\b|\bcookies\b.*\b(?:accept|agree|consent|policy)|\b(?:accept|uses?|using)\b.*\bcookies\b", re.I)


@dataclass
class Block:
    parts: list = field(default_factory=list)
    linked: int = 0
    region: int = 0
    furniture: bool = False
    talk: bool = False
    names: int = 0  # elements around it that are named as furniture
    inline: bool = False  # text of such elements within another block


def _named(value: str, words: frozenset) -> bool:
    """Whether a whole name of the list is one of ``words``, joins some with
    words of place, or holds a decisive one."""
    for name in value.split():
        parts = [p for p in re.split(r"[^a-z]+", name) if p]
        own = [p for p in parts if p in words]
        if own and (all(p in words or p in _FURNITURE or p in _PLACE for p in parts) or not _STATES.intersection(parts) and not _DECISIVE.isdisjoint(own)):
            return True
    return False


def _furniture(tag: str, rest: str, inside: bool) -> tuple[bool, bool, bool]:
    """(is furniture, is named as furniture, is named as reader talk) of an
    element."""
    names, hidden = "", False
    for name, *values in _ATTR.findall(rest):
        name, value = name.lower(), next((v for v in values if v), "").lower()
        if name in ("class", "id", "role"):
            names += " " + value
        elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value):
            hidden = True
    if tag in ("html", "body"):
        return False, False, False
    if tag in _NEVER or hidden or tag == "header" and not inside:
        return True, False, False
    if "-" in tag:  # a custom element
        names += " " + tag.removeprefix("amp-")
    if not names:
        return False, tag == "form", False
    talk = _named(names, _TALK)
    return False, talk or tag == "form" or tag != "header" and _named(names, _FURNITURE), talk


def blocks(html: str) -> list[Block]:
    """The page's blocks in order.  Unclosed elements end with their parent;
    a truncated tag at the end is dropped."""
    out, now, aside = [], Block(), []
    none = ("", False, False, 0, 0)
    stack: list[tuple[str, bool, bool, int, int]] = []  # tag, furniture, talk, region, names
    floors: list[int] = []  # place of the nearest entry, at or below each, that is not inline
    opened: Counter = Counter()  # entries by tag
    regions, pos = 0, 0

    def push(*entry):
        floors.append(floors[-1] if floors and entry[0] in _INLINE else len(stack))
        stack.append(entry)
        opened[entry[0]] += 1

    def pop() -> str:
        floors.pop()
        tag = stack.pop()[0]
        opened[tag] -= 1
        return tag

    def cut():
        nonlocal now
        if now.parts:
            out.append(now)
        out.extend(aside)
        aside.clear()
        _, furniture, talk, region, names = stack[-1] if stack else none
        now = Block(region=region, furniture=furniture, talk=talk, names=names)

    while m := _TOKEN.match(html, pos):
        pos = m.end()
        if (text := m["text"] or m["stray"]) is not None:
            _, furniture, talk, region, names = stack[-1] if stack else none
            if now.furniture > furniture or now.names > names or now.talk > talk:  # an inline element with blocks in it has ended
                cut()
            if furniture > now.furniture:  # a button in a paragraph
                continue
            to = now
            if names > now.names:  # an advert in a paragraph
                if not aside or (aside[-1].names, aside[-1].talk) != (names, talk):
                    aside.append(Block(region=region, talk=talk, names=names, inline=True))
                to = aside[-1]
            to.parts.append(text)
            to.linked += len(text) if opened["a"] else 0
            continue
        if not (tag := m["tag"]):
            continue
        tag = tag.lower()
        if m["end"]:
            if opened[tag]:
                while pop() != tag:
                    pass
            if tag in _BLOCK:
                cut()
            continue
        if tag in _VOID:
            if tag == "br":
                now.parts.append(" ")
            elif tag == "hr":
                cut()
            continue
        if tag in _RAW:
            end = _RAW[tag].search(html, pos)
            pos = end.start() if end else len(html)
            push(tag, True, False, 0, 0)
            continue
        if tag == "p" or tag in ("li", "dt", "dd", "tr", "td", "th", "option"):  # an open one of these ends here
            same = ("p",) if tag == "p" else (tag, "p")
            while stack and stack[floors[-1]][0] in same:  # with what is inline in it
                while pop() not in same:
                    pass
        _, held, talk, region, names = stack[-1] if stack else none
        own, named, own_talk = _furniture(tag, m["rest"] or "", region > 0)
        if tag in _REGION and not own and not talk and not region:
            held, names = False, 0
            regions += 1
            region = regions
        push(tag, held or own, talk or own_talk, region, names + named)
        if tag in _BLOCK:
            cut()
    cut()
    return out


def _link_share(b: Block) -> float:
    return b.linked / max(1, sum(map(len, b.parts)))


def _stop_words(text: str) -> tuple[int, int] | None:
    """(listed stop words, words) of a text; None where most words are in
    other letters than Latin, which the lists do not cover."""
    words = _WORD.findall(text.lower())
    if not text.isascii() and 2 * sum(w[0] < "\u0250" or "\u1e00" <= w[0] < "\u1f00" for w in words) < len(words):
        return None
    return sum(w in STOP_WORDS for w in words), len(words)


def _first_pass(b: Block, text: str, stops: tuple[int, int] | None, listed: bool) -> str:
    """Label of a block; where the stop words of its language are not listed,
    its length and links decide."""
    if b.furniture:
        return "bad"
    links = _link_share(b)
    if links > MAX_LINKS:
        return "bad"
    if len(text) < MIN_LENGTH:
        return "bad" if not b.region and (links > 0 or _LEGAL.search(text)) else "short"
    share = stops[0] / max(1, stops[1]) if stops and (listed or not stops[1]) else 1
    if share >= HIGH_STOPS:
        return "good" if len(text) > GOOD_LENGTH else "near"
    return "near" if share >= LOW_STOPS or b.region else "bad"


def _labelled(found: list) -> list:
    """(block, text, label) of a page's (block, text).  Its language is taken
    as listed if its long blocks together have enough listed stop words."""
    stops = [_stop_words(t) if len(t) >= MIN_LENGTH and not b.furniture else (0, 0) for b, t in found]
    long = [n for (b, _), n in zip(found, stops, strict=True) if n and _link_share(b) <= MAX_LINKS]
    listed = sum(n for n, _ in long) >= LOW_STOPS * sum(n for _, n in long)
    labels = [_first_pass(b, t, n, listed) for (b, t), n in zip(found, stops, strict=True)]
    dense = [bool(b.region) and not b.furniture and _link_share(b) > MAX_LINKS for b, _ in found]
    for i, (b, _) in enumerate(found):
        # one line of links within an article goes with its neighbours; several together are a menu
        if dense[i] and not any(0 <= j < len(found) and dense[j] and found[j][0].region == b.region for j in (i - 1, i + 1)):
            labels[i] = "short"
    return [(b, t, label) for (b, t), label in zip(found, labels, strict=True)]


def _second_pass(labels: list[str]) -> list[str]:
    """Labels of one stretch of blocks: short ones take the label of the
    nearest decided block (good before bad at equal distance when a
    near-good one stands between), near-good ones are bad only between bad
    ones; a stretch with nothing decided good keeps what is not bad."""
    n = len(labels)
    if "good" not in labels:
        return ["good" if x in ("near", "short") else x for x in labels]
    before, after = [None] * n, [None] * n
    for side, order in ((before, range(n)), (after, range(n - 1, -1, -1))):
        last = None
        for i in order:
            side[i] = last
            if labels[i] in ("good", "bad"):
                last = i
    out = list(labels)
    for i, x in enumerate(labels):
        if x not in ("short", "near"):
            continue
        near = [(abs(i - j), labels[j]) for j in (before[i], after[i]) if j is not None]
        kinds = {k for _, k in near}
        if len(kinds) == 1:
            out[i] = kinds.pop()
        else:
            (d0, k0), (d1, _) = sorted(near)
            out[i] = "good" if x == "near" or d0 == d1 or k0 == "good" else "bad"
    return out


def _level(found: list) -> tuple[int, bool]:
    """How many names around it a block may have, and whether reader talk
    counts: names decide only as far as text is left without them, and talk
    is text only on a page of nothing else."""
    for talk in (False, True):
        for kinds in (("good", "near"), ("short",)) if any(b.region for b, _, _ in found) else (("good",), ("near",), ("short",)):
            if names := [b.names for b, _, label in found if label in kinds and b.talk <= talk]:
                return min(names), talk
    return 0, False


def _by_name(found: list) -> list:
    """``found`` with what its names make furniture labelled bad."""
    names, talk = _level(found)
    for b, _, _ in found:
        b.furniture |= b.names > names or b.talk > talk
    return [(b, text, "bad" if b.furniture else label) for b, text, label in found]


def main_text(html: str) -> str:
    """The article of a page: character references decoded, white space in a
    block made one space, blocks joined by one space.  Nothing found: empty."""
    found = []
    for b in blocks(html):
        if text := " ".join(unescape("".join(b.parts)).split()):
            found.append((b, text))
    found = _labelled(found)
    stretches, held = {}, [x for x in found if x[0].region]
    if _level(held) == (0, False):  # else the only articles are reader talk or furniture by name, and the whole page is weighed
        for x in _by_name(held):
            stretches.setdefault(x[0].region, []).append(x)
    stretches = list(stretches.values())
    if any(label != "bad" for x in stretches for _, _, label in x):  # the page names its article
        stretches = [[x for x in part if not x[0].furniture] for part in stretches]  # an advert in the article says nothing of its neighbours
    else:
        stretches = [[x for x in _by_name(found) if not (x[0].inline and x[0].furniture)]]
    kept = [(t, x) for part in stretches for (_, t, _), x in zip(part, _second_pass([x for _, _, x in part]), strict=True)]
    return " ".join(t for t, x in kept if x == "good")


def _batches(batches):
    for b in batches:
        for i in range(0, b.num_rows, 256):
            part = b.slice(i, 256)
            text = pa.array([main_text(h) if h else "" for h in part.column("html").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), text], names=["page_id", "url", "text"])


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) of every row of ``pages`` (page_id, url, html).

    Null or empty html, and pages without an article, give an empty text;
    null ids and urls pass through; repeated rows are extracted alike; empty
    input gives an empty result; other columns are not read."""
    kind = dict(pages.dtypes)
    return pages.select("page_id", "url", "html").mapInArrow(_batches, f"page_id {kind['page_id']}, url {kind['url']}, text string")
