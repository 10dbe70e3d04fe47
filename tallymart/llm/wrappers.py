"""Main text of web pages through wrappers, one per host, inferred from all its pages.

A wrapper is a union-free regular expression over a page's tokens: tags, constant texts, text slots, optional
parts ``( )?`` and repeated parts ``( )+``. It starts as a host's first page and is aligned with one page
after the other. Runs of equal siblings, or of equal short sequences of siblings, fold into repeated groups;
where token streams differ, what only one side has becomes optional; where texts differ, a slot remains.
Wrappers of parts of a host's pages are aligned in the same way, so a host of any size is inferred in
parallel. What is main text is then decided once per wrapper and kind of main part, and every page is read
along it by the best kind of main part that the page has. Tags say what HTML says by them; names are
believed if all their words agree, otherwise the host's pages decide: what they share (constants), what is
mostly links, and repeated records are not the article, slots of text are.
"""

from __future__ import annotations

import functools
import html
import json
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.llm.shared import slices
from tallymart.session import materialise, tune

# What HTML says about its elements.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title iframe noscript noframes xmp template svg".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
# an opening tag ends these open elements, as far as the nearest of the bounds
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"})}
ENDS |= {t: ({"tr", "td", "th"} if t == "tr" else {"td", "th"}, {"table"}) for t in ("tr", "td", "th")}
CLOSES_P = BLOCKS - {"body", "html", "option", "caption", "legend", "tbody", "td", "tfoot", "th", "thead", "tr"}
# Elements and names that are not the article.
NOT_TEXT = set("nav footer aside button select dialog menu head script style template noscript noframes xmp iframe object canvas svg textarea title annotation annotation-xml".split())
NOT_TEXT_ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar".split())
NOT_TEXT_NAMES = set(
    "ad ads adv advert adverts advertisement advertising adsense adbox sponsor sponsored sponsors promo promotion banner sidebar side rail "
    "nav navbar navigation menu menus submenu breadcrumb breadcrumbs header masthead topbar footer bottom cookie cookies consent gdpr notice notices "
    "notification alert popup modal overlay newsletter subscribe subscription signup login comment comments commentlist respond reply replies feedback "
    "disqus discussion share sharing social related recommended recommendations trending popular widget widgets pagination pager tags toolbar "
    "copyright legal disclaimer search hidden skip toc".split()
)
# words that say nothing on their own, that may be a part of an article as well, and that begin the name of a state
PLAIN_NAMES = set(
    "article articles post posts entry story stories content page main body text site user reader readers visitor box block wrap wrapper container "
    "section area list item items link links slot unit bar inner outer left right top primary secondary global icons buttons form the for and".split()
)
EITHER_NAMES = set("discussion legal".split())
STATES = set("has no not without with is js can show overflow".split())
MAIN_NAMES = set("article content post entry story main body text maincontent".split())
PERIODS = 4
LINK_SHARE = 0.8
NEARLY_ALL = 0.9
MOSTLY = 0.5
NAMELESS = set("div section td".split())
MOST_KINDS = 32  # more nameless parts side by side are told apart no longer
MOST_DEEP = 100  # deeper elements are read as parts of the one at this depth, as browsers do at theirs

# Quotes count after an equals sign only, and only if they are closed. No part gives back what it took, so a tag costs its own length.
INSIDE = r"(?:=\s*+(?:\"[^\"]*+\"|'[^']*+')|[^>])*+"
OTHER = r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
TOKEN = re.compile(rf"{OTHER}|<(/?)([a-zA-Z][^\s/>]*+)({INSIDE})>|(<[a-zA-Z])|</[^<>]*+>", re.S)
# where a tag never ends, the rest of the page is read without quotes
PLAIN_TOKEN = re.compile(rf"{OTHER}|<(/?)([a-zA-Z][^\s/<>]*+)([^<>]*+)>|</[^<>]*+>", re.S)
ATTRIBUTE = re.compile(r"([^\s\"'<>/=]++)(?:\s*+=\s*+(\"[^\"]*+\"|'[^']*+'|[^\s>]++))?+")
NOT_SHOWN = re.compile(r"display\s*:\s*none")
NAME = re.compile(r"[a-z]+")
HOST = r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)"


@dataclass
class Element:
    tag: str
    names: tuple[str, ...]  # "class" and "id" values and the role, digits made equal
    parts: list = field(default_factory=list)  # elements and texts

    @property
    def sign(self) -> str:
        return " ".join((self.tag, *self.names))


@functools.lru_cache(50_000)
def _names(attributes: str) -> tuple[str, ...]:
    found = []
    for m in ATTRIBUTE.finditer(attributes):
        kind, value = m[1].lower(), (m[2] or "").strip("\"'").lower()
        if kind == "hidden" or kind == "aria-hidden" and value.strip() == "true" or kind == "style" and NOT_SHOWN.search(value):
            found.append("hidden")
        elif kind in ("class", "id", "role", "itemprop"):
            found += [f"{kind}={x}" for x in re.sub(r"\d+", "0", value).split()]
    return tuple(sorted(set(found)))


def parse(page: str) -> Element:
    """The element tree of a page; tags that HTML lets out are put in, end tags without a start are dropped."""
    root = Element("", ())
    stack, at, size, too_deep, token = [root], 0, len(page), 0, TOKEN

    def text(raw: str) -> None:
        if raw:
            stack[-1].parts.append(raw)

    def close(names: set[str], bounds: set[str] = frozenset()) -> None:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in names:
                del stack[k:]
                return
            if stack[k].tag in bounds:
                return

    while at < size:
        m = token.search(page, at)
        if m and token is TOKEN and m[4]:
            token = PLAIN_TOKEN
            m = token.search(page, at)
        if not m:
            text(page[at:])
            break
        text(page[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1] and too_deep:
            too_deep -= 1
            stack[-1].parts.append(Element("hr" if tag in BLOCKS else "wbr", ()))
            continue
        if m[1]:
            close({tag}, set() if tag in BLOCKS else BLOCKS)
            continue
        if tag in CLOSES_P:
            close({"p"}, {"td", "th", "table", "li", "blockquote", "div", "article", "section"})
        if tag in ENDS:
            close(*ENDS[tag])
        element = Element(tag, _names(m[3]))
        stack[-1].parts.append(element)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*+(?:>|\Z)|\Z", re.I).search(page, at)
            at = end.end() if end.end() > end.start() else size
        elif tag not in VOID and not m[3].endswith("/"):
            if len(stack) < MOST_DEEP:
                stack.append(element)
            else:
                too_deep += 1
    return root


# A wrapper node is a dict: s sign, i items, and for texts (sign "#") c the constant or None for a slot.
# An item is [optional, repeated, node]. t and a count the characters of texts, and of those in links; n the pages
# that hold the constant, or fewer where it stands on a page several times.


def _leaf(text: str, in_link: bool) -> dict:
    return {"s": "#", "c": text, "n": 1, "t": len(text), "a": len(text) if in_link else 0}


def wrapper_of(element: Element, in_link: bool = False) -> dict:
    """The wrapper of one page: its own tokens with repeats folded."""
    in_link = in_link or element.tag == "a"
    items = []
    for is_text, run in groupby(element.parts, lambda part: isinstance(part, str)):
        if is_text:  # what comments and lost tags split is one text
            words = " ".join("".join(run).split())
            if words:
                items.append([0, 0, _leaf(words, in_link)])
        else:
            items += [[0, 0, wrapper_of(part, in_link)] for part in run if part.tag not in VOID]
    return _node(element.sign, items)


def _node(sign: str, items: list) -> dict:
    items = _fold(items)
    return {"s": sign, "i": items, "t": sum(x[2]["t"] for x in items), "a": sum(x[2]["a"] for x in items)}


def _kinds(node: dict) -> set[str]:
    return {x["s"] for x in _flat(node)}


def _alike(left: dict, right: dict) -> bool:
    """Of one sign; parts without a name also have to hold more of the same than of different kinds of parts."""
    if left["s"] != right["s"]:
        return False
    if left["s"] not in NAMELESS:
        return True
    a, b = _kinds(left), _kinds(right)
    return a == b or len(a & b) > MOSTLY * len(a | b)


def _fold(items: list) -> list:
    """Fold runs of equal siblings, and of equal sequences of up to ``PERIODS`` siblings, into repeated parts."""
    for period in range(1, PERIODS + 1):
        out, k = [], 0
        while k < len(items):
            unit = [x[2]["s"] for x in items[k : k + period]]
            end = k + period
            while (
                len(unit) == period
                and "#" not in unit[:1] * (period == 1)
                and len(items) >= end + period
                and all(_alike(x[2], y[2]) for x, y in zip(items[end - period : end], items[end : end + period], strict=True))
            ):
                end += period
            if end == k + period:
                out.append(items[k])
                k += 1
                continue
            group = items[k : k + period]
            for at in range(k + period, end, period):
                group = [[a[0] or b[0], a[1] or b[1], align(a[2], b[2], True)] for a, b in zip(group, items[at : at + period], strict=True)]
            if period == 1:
                out.append([group[0][0], 1, group[0][2]])
            else:
                out.append([0, 1, {"s": "( " + " | ".join(unit) + " )", "i": group, "t": sum(x[2]["t"] for x in group), "a": sum(x[2]["a"] for x in group)}])
            k = end
        items = out
    return items


def align(left: dict, right: dict, one_page: bool = False) -> dict:
    """The wrapper that both of two wrappers of the same sign match, which are of different pages or of ``one_page``."""
    both = {"t": left["t"] + right["t"], "a": left["a"] + right["a"]}
    if left["s"] == "#":
        if left["c"] is None or left["c"] != right["c"]:
            return {"s": "#", "c": None, "n": 0, **both}
        return {"s": "#", "c": left["c"], "n": max(left["n"], right["n"]) if one_page else left["n"] + right["n"], **both}
    return {"s": left["s"], "i": _align_items(left["i"], right["i"], one_page), **both}


def _align_items(left: list, right: list, one_page: bool) -> list:
    a, b = [x[2] for x in left], [x[2] for x in right]
    if len(a) == len(b) and all(map(_alike, a, b)):
        pairs = list(zip(range(len(a)), range(len(b)), strict=True))
    else:
        shorter = min(len(a), len(b))
        head = next((k for k in range(shorter) if not _alike(a[k], b[k])), shorter)
        tail = next((k for k in range(shorter - head) if not _alike(a[-1 - k], b[-1 - k])), shorter - head)
        a, b = a[head : len(a) - tail], b[head : len(b) - tail]
        same = [[_alike(x, y) for y in b] for x in a]
        longest = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a) - 1, -1, -1):
            for j in range(len(b) - 1, -1, -1):
                longest[i][j] = longest[i + 1][j + 1] + 1 if same[i][j] else max(longest[i + 1][j], longest[i][j + 1])
        pairs, i, j = [(k, k) for k in range(head)], 0, 0
        while i < len(a) and j < len(b):
            if same[i][j]:
                pairs.append((head + i, head + j))
                i, j = i + 1, j + 1
            elif longest[i + 1][j] >= longest[i][j + 1]:
                i += 1
            else:
                j += 1
        pairs += [(len(left) - k, len(right) - k) for k in range(tail, 0, -1)]
    out, sides, i, j = [], [], 0, 0
    for p, q in [*pairs, (len(left), len(right))]:
        out += [[1, m, node] for _, m, node in left[i:p]] + [[1, m, node] for _, m, node in right[j:q]]
        sides += [1] * (p - i) + [2] * (q - j)
        if p < len(left):
            out.append([left[p][0] or right[q][0], left[p][1] or right[q][1], align(left[p][2], right[q][2], one_page)])
            sides.append(3)
        i, j = p + 1, q + 1
    # what was optional on both sides may stand side by side again
    return _fold_optional(out, [3] * len(out) if one_page else sides)


def _fold_optional(items: list, sides: list[int]) -> list:
    """``sides`` says for each item whether it is of the left pages (1), the right (2) or both (3)."""
    out, of = [], []
    # a host of ever new nameless parts does not make ever longer wrappers
    crowded = {sign for sign, n in Counter(x[2]["s"] for x in items).items() if n > MOST_KINDS}
    for item, side in zip(items, sides, strict=True):
        same = out and (_alike(out[-1][2], item[2]) or item[2]["s"] in crowded and out[-1][2]["s"] == item[2]["s"])
        if same and (out[-1][0] or item[0]):
            last = out[-1]
            out[-1] = [last[0] and item[0], 1 if item[2]["s"] != "#" else 0, align(last[2], item[2], bool(of[-1] & side))]
            of[-1] |= side
        else:
            out.append(item)
            of.append(side)
    return out


def as_pattern(node: dict, optional: int = 0, repeated: int = 0) -> str:
    """The wrapper as a readable regular expression."""
    if node["s"] == "#":
        inner = "#slot" if node["c"] is None else json.dumps(node["c"], ensure_ascii=False)
    else:
        inner = " ".join(as_pattern(n, o, m) for o, m, n in node["i"])
        if not node["s"].startswith("( "):
            inner = f"<{node['s']}> {inner} </>" if inner else f"<{node['s']}/>"
    mark = "*" if optional and repeated else "?" if optional else "+" if repeated else ""
    return f"({inner}){mark}" if mark else inner


def _split(sign: str) -> tuple[str, dict[str, set[str]]]:
    tag, *names = sign.split(" ")
    words: dict[str, set[str]] = {}
    for name in names:
        kind, _, value = name.partition("=")
        words.setdefault(kind, set()).update(NAME.findall(value), [value.replace("-", "").replace("_", "")])
    return tag, words


@functools.lru_cache(50_000)
def _is_main(sign: str) -> int:
    """3 for an article, 2 for a main part, 1 for a part named like one."""
    tag, words = _split(sign)
    named = words.get("class", set()) | words.get("id", set())
    if tag == "article" or "articlebody" in words.get("itemprop", set()) or "article" in words.get("role", set()):
        return 3
    if tag == "main" or "main" in words.get("role", set()):
        return 2
    return int(tag in ("div", "section", "td") and bool(named & MAIN_NAMES))


@functools.lru_cache(50_000)
def _is_not_text(sign: str) -> bool:
    """What HTML itself says is not the article's text."""
    tag, words = _split(sign)
    return tag in NOT_TEXT or "hidden" in words or bool(words.get("role", set()) & NOT_TEXT_ROLES)


@functools.lru_cache(50_000)
def _named_not_text(sign: str) -> int:
    """2 if all words of a class or id say that this is not the article, 1 if only some do, 0 if none."""
    tag, *names = sign.split(" ")
    grade = 0
    if tag in ("article", "body", "html", "main"):
        return grade
    for name in names:
        kind, _, value = name.partition("=")
        words = set(NAME.findall(value)) if kind in ("class", "id") else set()
        told = words & NOT_TEXT_NAMES
        if value.replace("-", "").replace("_", "") in NOT_TEXT_NAMES - EITHER_NAMES or told - EITHER_NAMES and words <= NOT_TEXT_NAMES | PLAIN_NAMES:
            grade = 2
        elif told and not NAME.findall(value)[0] in STATES:
            grade = max(grade, 1)
    return grade


@functools.lru_cache(50_000)
def _is_header(sign: str) -> bool:
    """A header by its tag, or by a name that says nothing else."""
    tag, words = _split(sign)
    named = (words.get("class", set()) | words.get("id", set())) & NOT_TEXT_NAMES
    return tag == "header" or named == {"header"}


def _count_shared(node: dict, enough: float) -> int:
    """Adds h to a node: the characters of its texts that are the same on ``enough`` pages."""
    if node["s"] == "#":
        node["h"] = node["t"] if node["c"] is not None and node["n"] >= enough else 0
    else:
        node["h"] = sum(_count_shared(child, enough) for _, _, child in node["i"])
    return node["h"]


def _mentions(node: dict, wanted) -> bool:
    return wanted(node) or node["s"] != "#" and any(_mentions(child, wanted) for _, _, child in node["i"])


def _tag(node: dict) -> str:
    return "" if node["s"].startswith(("#", "( ")) else node["s"].split(" ")[0]


def _has_records(node: dict) -> bool:
    """Repeated parts of two texts or more without a heading, as comments (who, what) and teasers are."""
    for _, many, child in node.get("i", ()):
        if many and _tag(child) in ("div", "li", "section", "article") and sum(x[2]["t"] > 0 for x in child["i"]) > 1 and not _mentions(child, lambda n: _tag(n) in HEADINGS):
            return True
        if _has_records(child):
            return True
    return False


def _under_shared_heading(node: dict) -> bool:
    """Records under a heading that the host's pages share: comments or teasers without a telling name."""
    shared = any(_tag(child) in HEADINGS and 0 < child["t"] == child["h"] for _, _, child in node["i"])
    return shared and _has_records(node)


def decide(wrapper: dict, pages: int) -> dict:
    """Mark what of a wrapper is main text: adds k to nodes, a bit per rank of the main part, set to keep.

    The ranks are articles, the main element without its articles, what is named like a main part, and the whole body.
    ``pages`` counts different pages. Texts that are the same on three or more of them, and on nearly all, are the
    host's and not the page's; in an article, where they fill a block that is no heading.
    """
    _count_shared(wrapper, max(3, NEARLY_ALL * pages))
    of_body = wrapper["t"] - sum(child["t"] for child in _skipped(wrapper))

    def is_out(node: dict, tag: str, best: int, inside: bool) -> bool:
        if _is_not_text(node["s"]):
            return True
        if tag == "form" or "role=form" in node["s"].split(" "):
            # a form around the page, not one on it
            return not (not (inside and best) and node["t"] > MOSTLY * of_body or _mentions(node, lambda n: n["t"] > 0 and _tag(n) != "" and _is_main(n["s"]) > 1))
        named = _named_not_text(node["s"])
        if named and _is_header(node["s"]):
            return not (inside and best)  # else a header of the article
        if named == 2 or named and (node["a"] >= MOSTLY * node["t"] or node["h"] >= NEARLY_ALL * node["t"] or _has_records(node)):
            return True
        if not inside:
            return False
        if best > 1:
            return tag in BLOCKS and tag not in HEADINGS and 0 < node["t"] == node["h"] and not _mentions(node, lambda n: _tag(n) in HEADINGS)
        return tag in ("ul", "ol", "div", "p") and _all_links(node) or tag in ("div", "section", "ul", "ol") and _under_shared_heading(node)

    def mark(node: dict, many: int, best: int, within: dict | None, header: bool) -> None:
        """``within`` is the main part that the node is in."""
        if node["s"] == "#":
            node["k"] = node.get("k", 0) | int(within is not None and not header and not (best == 0 and node["h"])) << best
            return
        tag = _tag(node)
        rank = _is_main(node["s"]) if tag else 0
        if tag and is_out(node, tag, best, within is not None):
            return
        if rank == 3 and within is not None and best > 1:
            # an article in a main part is read by its own rank; one in an article is a comment, unless it is the article
            if best == 2 or many or node["t"] < MOSTLY * within["t"]:
                return
        node["k"] = node.get("k", 0) | 1 << best
        if within is None and (best > 0 and rank == best or best == 0 and (tag == "body" or node["s"] == "")):
            within = node
        # of a header only headings belong to the article; outside of it, nothing
        header = (header or bool(tag) and _is_header(node["s"])) and tag not in HEADINGS
        for _, repeated, child in node["i"]:
            mark(child, repeated or many and not tag, best, within, header)

    wrapper["ranks"] = sorted({0, *_main_ranks(wrapper)}, reverse=True)
    for best in wrapper["ranks"]:
        mark(wrapper, 0, best, None, False)
    return wrapper


def _skipped(node: dict) -> Iterator[dict]:
    """The outermost parts that HTML says are no text."""
    for _, _, child in node.get("i", ()):
        if _tag(child) and _is_not_text(child["s"]):
            yield child
        else:
            yield from _skipped(child)


def _main_ranks(node: dict) -> Iterator[int]:
    """The ranks of the main parts with text, on any of the pages."""
    if node["s"] == "#" or _tag(node) and (_is_not_text(node["s"]) or _named_not_text(node["s"]) == 2):
        return
    if node["t"] and _tag(node):
        yield _is_main(node["s"])
    for _, _, child in node["i"]:
        yield from _main_ranks(child)


def _all_links(node: dict) -> bool:
    """A repeated part whose text is nearly all in links: a menu or a list of other pages."""
    return node["t"] > 0 and node["a"] >= LINK_SHARE * node["t"] and (_tag(node) == "div" or any(many for _, many, _ in node["i"]))


def extract(page: Element, wrapper: dict) -> str:
    """The main text of a page read along its decided wrapper: that of the best main part in which this page has text.

    A main element with over twice the text of its articles is the main part itself, and they are comments on it.
    """
    found = ""
    for rank in wrapper["ranks"]:
        if found and rank != 2:
            return found
        text = _extract(page, wrapper, 1 << rank)
        if len(text) > 2 * len(found):
            found = text
    return found


def _extract(page: Element, wrapper: dict, bit: int) -> str:
    """What a page has in the nodes marked with ``bit``: one line per block."""
    lines, line = [], []

    def end() -> None:
        words = " ".join("".join(line).split())
        if words:
            lines.append(words)
        line.clear()

    def walk(element: Element, nodes: list) -> None:
        for part, its in zip(element.parts, _nodes_of(element, nodes), strict=True):
            if isinstance(part, str):
                if any(n.get("k", 0) & bit for n in its):
                    line.append(html.unescape(part))
                elif not part.strip():
                    line.append(part)
                continue
            if part.tag in VOID:
                line.append(" " if part.tag in ("br", "hr", "img") else "")
                if part.tag == "hr":
                    end()
                continue
            kept = [n for n in its if n.get("k", 0) & bit]
            block = part.tag in BLOCKS
            if block:
                end()
            if kept:
                walk(part, kept)
            if block:
                end()

    walk(page, [wrapper])
    end()
    return "\n".join(lines)


def _nodes_of(element: Element, nodes: list) -> list[list[dict]]:
    """For each part of an element the wrapper nodes that it may be an instance of.

    Parts whose sign has several unlike nodes are aligned with them in order, by the kinds of what they hold.
    """
    known: dict[str, list] = {}
    for node in nodes:
        for place, (_, _, child) in enumerate(node["i"]):
            for inner in _flat(child) if child["s"].startswith("( ") else (child,):
                known.setdefault(inner["s"], []).append((place, inner))
    signs = ["#" if isinstance(part, str) else part.sign for part in element.parts]
    found = [[n for _, n in known.get(sign, ())] for sign in signs]
    for sign in NAMELESS & known.keys():
        mine = [k for k, s in enumerate(signs) if s == sign]
        if len(nodes) > 1 or len(known[sign]) < 2 or not mine:
            continue
        places = sorted({place for place, _ in known[sign]})
        at = [[n for place, n in known[sign] if place == wanted] for wanted in places]
        # best[j]: how well the parts so far fit if the last of them is at place j or before
        best, back = [0.0] * len(places), []
        kinds = [[_kinds(n) for n in some] for some in at]
        for k in mine:
            own = {"#" if isinstance(x, str) else x.sign for x in element.parts[k].parts if (x.strip() if isinstance(x, str) else x.tag not in VOID)}
            row, choice = [], []
            for j in range(len(places)):
                fit = best[j] + max(len(own & ks) / len(own | ks) if own | ks else 1.0 for ks in kinds[j])
                stay = j > 0 and row[j - 1] >= fit
                row.append(row[j - 1] if stay else fit)
                choice.append(choice[j - 1] if stay else j)
            best = row
            back.append(choice)
        j = len(places) - 1
        for k, choice in zip(reversed(mine), reversed(back), strict=True):
            j = choice[j]
            found[k] = at[j]
    return found


def _flat(node: dict) -> Iterator[dict]:
    """The items of a node, those of repeated groups among them."""
    for _, _, child in node["i"]:
        if child["s"].startswith("( "):
            yield from _flat(child)
        else:
            yield child


def _absorb(held: dict[str, list], host: str, wrapper: dict, pages: int) -> None:
    if host in held:
        old = held[host]
        old[0], old[1] = align(old[0], wrapper), old[1] + pages
    else:
        held[host] = [wrapper, pages]


WRAPPERS = "host string, part int, wrapper string, pages long"


def _rows(held: dict[str, list], part: int) -> pa.RecordBatch:
    hosts = sorted(held)
    return pa.RecordBatch.from_pydict({
        "host": pa.array(hosts, pa.string()),
        "part": pa.array([part] * len(hosts), pa.int32()),
        "wrapper": pa.array([json.dumps(held[h][0], ensure_ascii=False, separators=(",", ":")) for h in hosts], pa.string()),
        "pages": pa.array([held[h][1] for h in hosts], pa.int64()),
    })


def infer_wrappers(pages: DataFrame, parts: int = 32) -> DataFrame:
    """One wrapper per host from all different ``pages`` (host, html): per run of rows, then per part of a host, then per host.

    Copies of a page count once, so that they are not taken for what a host's pages share.

    A host's pages are shared by many tasks; what meets in one task is at most one wrapper per run and part.
    """

    def per_run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId() % parts
        for run in slices(batches, "html", 32 << 20):
            held: dict[str, list] = {}
            for host, page in zip(run.column("host").to_pylist(), run.column("html").to_pylist(), strict=True):
                _absorb(held, host, wrapper_of(parse(page or "")), int(bool(page and not page.isspace())))
            yield _rows(held, part)

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        for batch in batches:  # sorted by host
            for row in batch.to_pylist():
                if held and row["host"] not in held:
                    yield _rows(held, 0)
                    held = {}
                _absorb(held, row["host"], json.loads(row["wrapper"]), row["pages"])
        if held:
            yield _rows(held, 0)

    different = pages.withColumn("digest", F.sha2("html", 256)).groupBy("host", "digest").agg(F.first("html").alias("html"))
    partial = different.select("host", "html").mapInArrow(per_run, WRAPPERS)
    by_part = partial.repartition("host", "part").sortWithinPartitions("host", "part", "wrapper").mapInArrow(merge, WRAPPERS)
    whole = by_part.repartition("host").sortWithinPartitions("host", "wrapper").mapInArrow(merge, WRAPPERS)
    return whole.select("host", "wrapper", F.col("pages").alias("wrapper_pages"))


def main_text(pages: DataFrame, id_col="page_id", url_col="url", html_col="html") -> DataFrame:
    """Per row of ``pages``: page_id, url, text, n_chars, host.

    A null or empty page has an empty text, a url without a host shares one wrapper with its like. Repeated
    rows give repeated results, an empty table none; pages of any length are parsed whole.
    """
    tune(pages.sparkSession)
    host = F.lower(F.coalesce(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), HOST, 1), F.lit("")))
    given = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"), host.alias("host"))
    wrappers = materialise(infer_wrappers(given), "wrappers")

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "html"):
            texts = [extract(parse(page or ""), _decided(w, n)) for page, w, n in zip(*(part.column(c).to_pylist() for c in ("html", "wrapper", "wrapper_pages")), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), part.column("host")],
                ["page_id", "url", "text", "n_chars", "host"],
            )

    return given.join(wrappers, "host").select("page_id", "url", "html", "host", "wrapper", "wrapper_pages").mapInArrow(read, "page_id long, url string, text string, n_chars long, host string")


@functools.lru_cache(2_000)
def _decided(wrapper: str, pages: int) -> dict:
    return decide(json.loads(wrapper), pages)
