"""Main text of web pages by wrappers that are inferred per host.

A page is read as a stream of tokens: block elements, named by tag, class and id, and text slots.
A host's wrapper is a union-free regular expression over such tokens (Crescenzi, Mecca, Merialdo
2001): within a page, neighbouring stretches that repeat are folded into a repeated group; then the pages'
streams are aligned one after the other, a stretch that one of them lacks becomes optional,
and a group that repeats in one of them is a repeated group for all.

Pages of a host that mark their main text differently (by an article, by main, by a name, not at all)
are different branches with a wrapper each. Each page's stream is matched against the wrapper of its branch, which
gives every text slot of the page its slot in the wrapper. Over all pages of the branch a slot (with its path of elements) gets
its number of pages, its letters, the share of them inside links, and whether its text is ever
different. The main slots are those of the branch's mark; boilerplate by name is left out (menus, footers, forms, adverts,
notices, comments and the like). Without a mark, slots that are
mostly links or say the same on all pages are left out, and so is everything outside the stretch with most of the
changing text; a page with nothing in that stretch keeps its changing slots, then those on fewer than ``JUDGED`` pages.

Streams are made distinct per branch before they meet, then aligned in a tree: ``FAN`` streams or wrappers
at a time, in as many rounds as the branch with the most streams needs. Slot statistics are sums, so a host with a third of
all pages is no bottleneck. A page needs only its host's wrappers, which are broadcast below ``BROADCAST_HOSTS`` hosts.

Cases: a NULL html is empty and gives an empty text. A NULL or odd url belongs to the host "". Cut pages end
where they end: open elements close, a tag or comment without its end is dropped. A
host's only page is judged by itself. Repeated rows give repeated results.
"""

from __future__ import annotations

import json
import re
from collections import defaultdict
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import lru_cache
from html import unescape

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.common import read_table, shared_folder, unused, written

#: streams or wrappers that one task aligns one after the other
FAN = 32
#: a slot on fewer pages may be main text though its text is never different
JUDGED = 3
BROADCAST_HOSTS = 50_000
#: longest stretch of tokens that is tried as a repeated group
LONGEST_GROUP = 24

#: elements whose content is no text of the page
HIDDEN = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "math", "select", "button",
          "object", "audio", "video", "canvas"}
#: of these, the ones whose content is read up to their end tag, whatever it holds
RAW = ("script", "style", "textarea", "title", "iframe", "noscript", "template", "svg", "math")
VOID = {"br", "img", "hr", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr", "param"}
BLOCKS = {"html", "body", "article", "main", "section", "div", "p", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "li", "dl",
          "dt", "dd", "table", "thead", "tbody", "tfoot", "tr", "td", "th", "caption", "blockquote", "pre", "nav", "header", "footer", "aside",
          "form", "fieldset", "figure", "figcaption", "address", "details", "summary", "menu", "center", "dialog", "hr", "hgroup"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: a new element of the key closes open elements of the value, up to the nearest container
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}}
BOILERPLATE_TAGS = {"nav", "footer", "aside", "form", "menu", "dialog", "header"}
BOILERPLATE_NAMES = {
    "ad", "ads", "advert", "adverts", "advertisement", "adsense", "sponsor", "sponsored", "promo", "promotion", "banner", "sidebar", "side",
    "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "footer", "foot", "masthead", "topbar", "toolbar", "header",
    "cookie", "cookies", "consent", "gdpr", "notice", "notices", "notification", "alert", "popup", "modal", "overlay", "newsletter", "subscribe",
    "subscription", "signup", "login", "share", "sharing", "social", "related", "recommended", "recommendations", "comment", "comments",
    "commentlist", "disqus", "replies", "reply", "respond", "discussion", "reader", "readers", "pagination", "pager", "widget", "search", "copyright",
    "legal", "disclaimer", "skip", "toc", "contentinfo", "complementary",
}
#: names that are boilerplate only where no name of the main text stands beside them
AMBIGUOUS = {"header", "banner", "notice", "alert", "legal", "search", "side", "reader"}
MAIN_NAMES = {"article", "post", "entry", "story", "content", "main", "maincontent", "text"}

TOKEN = re.compile(
    r"<!--(?:.*?-->|.*)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(>|$)", re.S
)
ATTRIBUTE = re.compile(r"([a-zA-Z:-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))")
#: an element token or a slot within a group
LEAF = re.compile(r"<[^>]*>|#")
RAW_END = {name: re.compile(rf"</{name}\b[^>]*(?:>|$)", re.I) for name in RAW}


class Block:
    """A stretch of text with no block element in it: the path of its elements, its words, letters inside links."""

    __slots__ = ("path", "pieces", "linked")

    def __init__(self, path: tuple[str, ...]):
        self.path, self.pieces, self.linked = path, [], 0

    @property
    def text(self) -> str:
        return " ".join(unescape("".join(self.pieces)).split())


def element_name(tag: str, attributes: str) -> str:
    """tag.class#id, in lower case, with numbers made alike."""
    if not attributes or "=" not in attributes:
        return tag
    found = {key.lower(): a or b or c for key, a, b, c in ATTRIBUTE.findall(attributes)}
    classes = ".".join(sorted(set(found.get("class", "").lower().split())))
    names = [tag, *([f".{classes}"] if classes else []), *([f"#{found['id'].lower().strip()}"] if found.get("id", "").strip() else [])]
    names += [f"@{found['role'].lower()}"] if found.get("role") else []
    return re.sub(r"[\s>]", "_", re.sub(r"\d+", "0", "".join(names)))


def parse(html: str) -> tuple[list[str], list[Block]]:
    """The token stream of a page and its blocks in page order."""
    stream, blocks = _read(html)
    return stream, [block for block in blocks if block.text]


def _read(html: str) -> tuple[list[str], list[Block]]:
    """The token stream and one block for each of its slots, also where its text is blank."""
    stream: list[str] = []
    blocks: list[Block] = []
    path: list[str] = []
    tags: list[str] = []
    held: Block | None = None
    inside: list[str] = []
    hidden = links = at = 0

    def close(depth: int) -> None:
        nonlocal held
        held = None
        while len(tags) > depth:
            stream.append(f"</{tags.pop()}>")
            path.pop()

    def add(text: str) -> None:
        nonlocal held
        if hidden or not text:
            return
        if held is None:
            if text.isspace():
                return
            held = Block(tuple(path))
            blocks.append(held)
            stream.append("#")
        held.pieces.append(text)
        held.linked += len(text) if links else 0

    while at < len(html):
        start = html.find("<", at)
        if start < 0:
            add(html[at:])
            break
        add(html[at:start])
        match = TOKEN.match(html, start)
        if match is None:
            end = html.find(">", start)
            if end < 0 and re.match(r"</?[a-zA-Z]", html[start : start + 3]):
                break  # a tag that the page's end cuts
            add("<")
            at = start + 1
            continue
        at = match.end()
        closing, tag = match[1], (match[2] or "").lower()
        if not tag:
            continue
        if hidden and tag in BLOCKS:
            if not closing:
                inside.append(tag)
            elif tag in inside:
                del inside[len(inside) - 1 - inside[::-1].index(tag) :]
            elif tag in tags:  # the end of a block around it ends a hidden element that isn't closed
                hidden, inside = 0, []
        if tag in RAW and not closing:
            if match[3].endswith("/"):
                continue
            end = RAW_END[tag].search(html, at)
            at = end.end() if end else len(html)
        elif tag in HIDDEN:
            hidden = max(0, hidden + (-1 if closing else 1))
            inside = inside if hidden else []
        elif tag == "a":
            links = max(0, links - 1) if closing else 1
        elif tag == "br":
            add(" ")
        elif tag in BLOCKS and not hidden:
            if closing:
                if tag in tags:
                    close(len(tags) - 1 - tags[::-1].index(tag))
                held = None
            else:
                if "p" in tags[-1:]:  # a block inside a paragraph ends it
                    close(len(tags) - 1)
                if tag in HEADINGS and tags and tags[-1] in HEADINGS:
                    close(len(tags) - 1)
                for depth in range(len(tags) - 1, -1, -1):
                    if tags[depth] in CLOSES.get(tag, ()):
                        close(depth)
                        break
                    if tags[depth] in ("ul", "ol", "dl", "table", "div", "section", "article"):
                        break
                held = None
                links = 0
                if tag not in VOID and not match[3].rstrip().endswith("/"):
                    name = element_name(tag, match[3])
                    tags.append(tag)
                    path.append(name)
                    stream.append(f"<{name}>")
    close(0)
    return stream, blocks


def fold(stream: list[str]) -> list[str]:
    """The stream with neighbouring equal stretches as one repeated group ``(...)+``."""
    return _folded(stream)[0]


def _folded(stream: list[str]) -> tuple[list[str], list[list[int]]]:
    """The folded stream and, for each of its slots, the numbers of the stream's slots that went into it."""
    out: list[str] = []
    held: list[list[list[int]]] = []
    slots = 0

    def join(begin: int, middle: int) -> list[list[int]]:
        """The slots from ``begin`` on, with those of the stretch from ``middle`` on added to them."""
        places = [place for places in held[begin:middle] for place in places]
        for place, more in zip(places, (place for places in held[middle:] for place in places), strict=True):
            place += more
        return places

    for token in stream:
        out.append(token)
        held.append([[slots]] if token == "#" else [])
        slots += token == "#"
        changed = True
        while changed:
            changed = False
            for size in range(1, min(LONGEST_GROUP, len(out)) + 1):
                before = out[-size - 1] if len(out) > size else ""
                if before.endswith(")+") and before == "(" + " ".join(out[-size:]) + ")+":
                    held[-size - 1 :] = [join(len(out) - size - 1, len(out) - size)]
                    del out[-size:]
                    changed = True
                    break
                repeated = before == out[-1] and len(out) >= 2 * size and out[-size:] == out[-2 * size : -size]
                if repeated and not (size == 1 and out[-1].endswith(")+")):
                    held[-2 * size :] = [join(len(out) - 2 * size, len(out) - size)]
                    out[-2 * size :] = ["(" + " ".join(out[-size:]) + ")+"]
                    changed = True
                    break
                if size == 1 and repeated:
                    held[-2:] = [join(len(out) - 2, len(out) - 1)]
                    out.pop()
                    changed = True
                    break
    return out, [place for places in held for place in places]


Wrapper = list[tuple[str, bool]]


def _grouped(tokens: Wrapper, groups: list[str]) -> Wrapper:
    """Stretches that are the body of one of the groups, as that group; not where a page may lack a part of them."""
    for group in groups:
        body = group[1:-2].split(" ")
        at = 0
        while at + len(body) <= len(tokens):
            if tokens[at : at + len(body)] == [(token, False) for token in body]:
                tokens = [*tokens[:at], (group, False), *tokens[at + len(body) :]]
            at += 1
    return tokens


def align(one: Wrapper, other: Wrapper) -> Wrapper:
    """The wrapper of all pages of both: what either lacks is optional, what repeats in one repeats."""
    ours, theirs = {token for token, _ in one}, {token for token, _ in other}
    one = _grouped(one, sorted(token for token in theirs - ours if token.endswith(")+") and "(" not in token[1:]))
    other = _grouped(other, sorted(token for token in ours - theirs if token.endswith(")+") and "(" not in token[1:]))
    matcher = SequenceMatcher(None, [token for token, _ in one], [token for token, _ in other], autojunk=False)
    out: Wrapper = []
    for kind, a, b, c, d in matcher.get_opcodes():
        if kind == "equal":
            out += [(token, optional or also) for (token, optional), (_, also) in zip(one[a:b], other[c:d], strict=True)]
        else:
            out += [(token, True) for token, _ in one[a:b]] + [(token, True) for token, _ in other[c:d]]
    return out


def accepts(wrapper: Wrapper, tokens: list[str]) -> bool:
    """Whether a folded stream is one of the wrapper's: all that isn't optional occurs, in order."""
    states = {0}
    for place, (token, optional) in enumerate(_grouped(wrapper, [])):
        following = set()
        for at in states:
            body = token[1:-2].split(" ") if token.endswith(")+") else None
            if at < len(tokens) and tokens[at] == token:
                following.add(at + 1)
            if body and tokens[at : at + len(body)] == body:
                following.add(at + len(body))
            if optional:
                following.add(at)
        states = following
        if not states:
            return False
    return len(tokens) in states


@lru_cache(maxsize=65_536)
def _slot_count(token: str) -> int:
    return sum(leaf == "#" for leaf in LEAF.findall(token))


def match_slots(wrapper: Wrapper, tokens: list[str]) -> list[int] | None:
    """For each slot of a folded stream the number of its slot in the wrapper; None where the wrapper isn't the stream's."""
    layers: list[dict[int, int]] = [{0: 0}]  # position in the stream -> position before this token of the wrapper
    for token, optional in wrapper:
        following: dict[int, int] = {}
        body = token[1:-2].split(" ") if token.endswith(")+") else None
        for at in layers[-1]:
            if at < len(tokens) and tokens[at] == token:
                following[at + 1] = at
            if body and tokens[at : at + len(body)] == body:
                following[at + len(body)] = at
        if optional:
            for at in layers[-1]:
                following.setdefault(at, at)
        if not following:
            return None
        layers.append(following)
    at = len(tokens)
    if at not in layers[-1]:
        return None
    found: list[int] = []
    number = sum(_slot_count(token) for token, _ in wrapper)
    for (token, _), layer in zip(reversed(wrapper), reversed(layers), strict=False):
        number -= _slot_count(token)
        if layer[at] != at:
            found[:0] = range(number, number + _slot_count(token))
        at = layer[at]
    return found


def to_regex(wrapper: Wrapper) -> str:
    """The wrapper as text: neighbouring optional tokens form a group ``(...)?``."""
    out, held = [], []
    for token, optional in [*wrapper, ("", False)]:
        if optional:
            held.append(token)
            continue
        if held:
            out.append("(" + " ".join(held) + ")?")
            held = []
        out.append(token)
    return " ".join(out).strip()


def _names(element: str) -> tuple[str, set[str]]:
    tag, *rest = re.split(r"[.#@]", element)
    return tag, {part for name in rest for part in re.split(r"[-_]+", name) if part}


def is_boilerplate(path: list[str]) -> bool:
    """Whether an element on the path is boilerplate by its name."""
    inside = False
    for element in path:
        tag, names = _names(element)
        if tag == "header" and inside and _names(path[-1])[0] in HEADINGS:
            continue
        named = names & BOILERPLATE_NAMES
        if tag in BOILERPLATE_TAGS or named - AMBIGUOUS or (named and not names & MAIN_NAMES):
            return True
        inside = inside or tag in ("article", "main")
    return False


MARKS = (lambda tag, names: tag == "article", lambda tag, names: tag == "main" or "main" in names, lambda tag, names: names & MAIN_NAMES)
#: the branch of pages without a mark
UNMARKED = len(MARKS)


@lru_cache(maxsize=65_536)
def mark_of(path: str) -> int | None:
    """The number of the first mark on a path, ``UNMARKED`` without one, None for boilerplate."""
    elements = path.split(">")
    if is_boilerplate(elements):
        return None
    named = [_names(element) for element in elements]
    return next((number for number, marks in enumerate(MARKS) if any(marks(*one) for one in named)), UNMARKED)


def branch_of(paths: list[str]) -> int:
    """The first mark that a page's slots have."""
    return min((mark for mark in map(mark_of, paths) if mark is not None), default=UNMARKED)


def main_slots(branch: int, slots: list[dict]) -> list[list[str]]:
    """The main slots of a branch, from its slots: slot, path, pages, letters, linked, changes, of all pages together.

    Lists of names; a page takes the slots of the first list it has any of.
    """
    plain = [slot for slot in slots if mark_of(slot["path"]) is not None]
    if branch != UNMARKED:
        # the page's first mark decides, and an article's slots count whatever else stands around them
        marks = MARKS[branch]
        return [_named(slot for slot in plain if any(marks(*_names(element)) for element in slot["path"].split(">")))]
    most = max((slot["pages"] for slot in plain), default=0)
    unlinked = [slot for slot in plain if slot["linked"] <= 0.6 * slot["letters"]]
    changing = [slot for slot in unlinked if slot["changes"] or most < JUDGED]
    weight: dict[tuple[str, ...], int] = defaultdict(int)
    for slot in changing:
        steps = slot["path"].split(">")
        for depth in range(len(steps)):
            weight[tuple(steps[:depth])] += slot["letters"]
    total = weight.get((), 0)
    inner = max((steps for steps, letters in weight.items() if letters >= 0.6 * total), key=len, default=())
    stretch = [slot for slot in changing if tuple(slot["path"].split(">")[: len(inner)]) == inner]
    rare = [slot for slot in unlinked if slot["changes"] or slot["pages"] < JUDGED]
    return [_named(stretch), _named(changing), _named(rare)]


def slot_name(number: int, path: str) -> str:
    return f"{number} {path}"


def _named(slots) -> list[str]:
    return sorted(slot_name(slot["slot"], slot["path"]) for slot in slots)


class Page:
    """A page's blocks with text, its folded stream, its branch, and the folded slot of every block."""

    __slots__ = ("blocks", "places", "paths", "stream", "branch")

    def __init__(self, html: str | None):
        stream, blocks = _read(html or "")
        folded, slots = _folded(stream)
        place_of = {number: place for place, numbers in enumerate(slots) for number in numbers}
        texts = [(block.text, block, place_of[number]) for number, block in enumerate(blocks)]
        self.blocks = [(text, block.linked) for text, block, _ in texts if text]
        self.places = [place for text, _, place in texts if text]
        self.paths = [">".join(block.path) for text, block, _ in texts if text]
        self.stream = "\n".join(folded)
        self.branch = branch_of(self.paths)

    def slots(self) -> list[tuple[int, str, int, int, int]]:
        """(place, path, letters, linked letters, hash of the texts) of each slot."""
        held: dict[tuple[int, str], list] = {}
        for place, path, (text, linked) in zip(self.places, self.paths, self.blocks, strict=True):
            slot = held.setdefault((place, path), [0, 0, xxhash.xxh3_64()])
            slot[0] += len(text)
            slot[1] += min(linked, len(text))
            slot[2].update(text)
        return [(*key, letters, linked, hashed.intdigest() >> 1) for key, (letters, linked, hashed) in held.items()]


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.lower(F.coalesce(url, F.lit(""))), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return found


#: ``slot`` is a place in the page's folded stream first, then one in the wrapper
SLOT = pa.struct([("slot", pa.int32()), ("path", pa.string()), ("letters", pa.int64()), ("linked", pa.int64()), ("text", pa.int64())])
SLOTS = "slots array<struct<slot:int,path:string,letters:long,linked:long,text:long>>"


def page_streams(pages: DataFrame, url: str, html: str) -> DataFrame:
    """(host, branch, stream, slots) of every page with a stream."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [field.name for field in SLOT]
        for batch in batches:
            read = [Page(html) for html in batch["html"].to_pylist()]
            slots = [[dict(zip(names, slot, strict=True)) for slot in page.slots()] for page in read]
            arrays = [
                batch["host"],
                pa.array([page.branch for page in read], pa.int32()),
                pa.array([page.stream for page in read], pa.string()),
                pa.array(slots, pa.list_(SLOT)),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["host", "branch", "stream", "slots"])

    rows = pages.select(host_of(F.col(url)).alias("host"), F.col(html).alias("html"))
    streams = rows.mapInArrow(work, f"host string, branch int, stream string, {SLOTS}")
    return streams.where("stream != ''")


def _wrapper(text: str) -> Wrapper:
    """A wrapper from its lines of ``token`` or ``?token``."""
    return [(line.removeprefix("?"), line.startswith("?")) for line in text.split("\n") if line]


def _aligned(texts: list[str]) -> str:
    """The wrapper of some streams or wrappers, as lines of ``token`` or ``?token``; in a fixed order."""
    read = [_wrapper(text) for text in sorted(texts, key=lambda text: (len(text), text))]
    groups = sorted({token for tokens in read for token, _ in tokens if token.endswith(")+") and "(" not in token[1:]})
    wrapper: Wrapper | None = None
    for tokens in read:
        tokens = _grouped(tokens, groups)  # while they are still whole, all can be
        wrapper = tokens if wrapper is None else align(wrapper, tokens)
    return "\n".join("?" * optional + token for token, optional in wrapper or [])


@lru_cache(maxsize=256)
def _read_wrapper(text: str) -> Wrapper:
    return _wrapper(text)


@lru_cache(maxsize=8_192)
def _matched(wrapper: str, stream: str) -> list[int]:
    found = match_slots(_read_wrapper(wrapper), stream.split("\n"))
    if found is None:
        raise ValueError("a page's stream is none of its wrapper")
    return found


def _few(frame: DataFrame) -> DataFrame:
    """A table with few rows per host, broadcast where there are few in all."""
    return F.broadcast(frame) if frame.limit(BROADCAST_HOSTS + 1).count() <= BROADCAST_HOSTS else frame


def _wrappers(streams: DataFrame, folder: str) -> DataFrame:
    """(host, branch, wrapper): the streams of each branch, aligned in a tree."""

    def merge(table: pa.Table) -> pa.Table:
        kept = {name: table[name].slice(0, 1) for name in ("host", "branch", "part", "parts")}
        return pa.table({**kept, "stream": [_aligned(table["stream"].to_pylist())]})

    different = written(streams.select("host", "branch", "stream").distinct(), folder, "different")
    counts = different.groupBy("host", "branch").agg(F.ceil(F.count("*") / FAN).cast("long").alias("parts"))
    counts = written(counts, folder, "parts")
    parts = counts.agg(F.max("parts")).first()[0] or 1
    held = different.join(_few(counts), ["host", "branch"]).withColumn("part", F.pmod(F.xxhash64("stream"), F.col("parts")))
    while True:
        merged = held.groupBy("host", "branch", "part").applyInArrow(merge, "host string, branch int, part long, parts long, stream string")
        held = written(merged, folder, f"aligned_{parts}")
        if parts == 1:
            return held.select("host", "branch", F.col("stream").alias("wrapper"))
        parts = -(-parts // FAN)
        held = held.withColumn("part", F.floor(F.col("part") / FAN))


def infer_wrappers(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(host, branch, pages, wrapper, main): the wrapper and the main slots of each branch of a host; main is JSON."""
    folder = shared_folder(pages.sparkSession)
    streams = written(page_streams(pages, url, html), folder, "streams")
    wrappers = _wrappers(streams, folder)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            columns = (batch[name].to_pylist() for name in ("wrapper", "stream", "slots"))
            for wrapper, stream, slots in zip(*columns, strict=True):
                numbers = _matched(wrapper, stream)
                out.append([{**slot, "slot": numbers[slot["slot"]]} for slot in slots])
            yield pa.RecordBatch.from_arrays([batch["host"], batch["branch"], pa.array(out, pa.list_(SLOT))], ["host", "branch", "slots"])

    placed = streams.join(_few(wrappers), ["host", "branch"]).select("host", "branch", "wrapper", "stream", "slots")
    placed = placed.mapInArrow(place, f"host string, branch int, {SLOTS}")
    slots = placed.select("host", "branch", F.inline("slots")).groupBy("host", "branch", "slot", "path").agg(
        F.count("*").alias("pages"),
        F.sum("letters").alias("letters"),
        F.sum("linked").alias("linked"),
        (F.min("text") != F.max("text")).alias("changes"),
    )

    def choose(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        main = json.dumps(main_slots(rows[0]["branch"], rows))
        return pa.table({"host": [rows[0]["host"]], "branch": pa.array([rows[0]["branch"]], pa.int32()), "pages": [max(row["pages"] for row in rows)], "main": [main]})

    chosen = slots.groupBy("host", "branch").applyInArrow(choose, "host string, branch int, pages long, main string")
    return written(wrappers.join(chosen, ["host", "branch"]), folder, "wrappers")


def extract_text(html: str | None, branches: dict[int, tuple[str, list[set[str]]]]) -> str:
    """The blocks of the main slots in page order, joined by an empty line; ``branches`` are the wrappers and main slots of the host."""
    page = Page(html)
    if page.branch not in branches or not page.blocks:
        return ""
    wrapper, mains = branches[page.branch]
    numbers = _matched(wrapper, page.stream)
    names = [slot_name(numbers[place], path) for place, path in zip(page.places, page.paths, strict=True)]
    main = next((main for main in mains if not main.isdisjoint(names)), set())
    return "\n\n".join(text for name, (text, _) in zip(names, page.blocks, strict=True) if name in main)


@lru_cache(maxsize=64)
def _branches(lines: str) -> dict[int, tuple[str, list[set[str]]]]:
    read = (json.loads(line) for line in lines.split("\n"))
    return {one["branch"]: (one["wrapper"], [set(main) for main in json.loads(one["main"])]) for one in read}


def extract(pages: DataFrame, url: str = "url", html: str = "html", result: str = "text") -> DataFrame:
    """The pages with their main text."""
    host, branches = unused(pages, "host", "branches")
    lines = F.to_json(F.struct("branch", "wrapper", "main"))
    wrappers = infer_wrappers(pages, url, html).groupBy(F.col("host").alias(host)).agg(
        F.array_join(F.collect_list(lines), "\n").alias(branches)
    )
    joined = pages.join(_few(wrappers), host_of(F.col(url)) == F.col(host), "left")

    @F.pandas_udf("string")
    def work(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for htmls, held in batches:
            texts = [extract_text(page, _branches(lines) if lines else {}) for page, lines in zip(htmls, held, strict=True)]
            yield pd.Series(texts, dtype=object)

    return joined.withColumn(result, work(F.col(html), F.col(branches))).drop(host, branches)


def page_texts(spark, sf_dir: str) -> DataFrame:
    """``op2``: the main text of every page."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
