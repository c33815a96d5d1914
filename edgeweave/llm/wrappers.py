"""Main text of web pages by wrappers: union-free regular expressions inferred per host.

**Pages as token streams.** A page is read once into a tree of block elements; inline tags vanish into
the text around them, scripts, styles, drawings, lists of choices and comments are skipped, missing
end tags are implied. An
element's label is its tag with the tokens of its class, without digits; a run of text is the label ``#``, or
``@`` if only links have letters in it; ``@@`` marks several links in a row or several children of links.

**Inference.** A wrapper gives, for the children of each element, a sequence of labels in which every
label stands once: optional (``?``) where some page has none, repeated (``+``) where some page has several;
a span of labels that come round again is one repeated group of optional members. ``aligned`` aligns
two such sequences by their longest common subsequence, keeps what matches, turns the rest into
optional items and folds repetitions again. A text slot outside repetitions also keeps the hash of its
text as long as all pages agree: text that never varies is part of the template, once it stands on
three pages whose other texts differ, so that copies of a page never make a template.

Every task folds the pages that it reads into one wrapper per host, and those are folded again per
host, so a host with a third of all pages sends one small row per task. Inference covers all pages.
Wrappers of a host are folded in the order of their texts.

**Extraction.** The wrapper names the paths at which its host's pages have containers of main text:
main elements, articles, elements named like content. A page is matched against these paths. Its
text comes from the main element, if that has as much as the articles; else from an element named
like content with more text outside articles than in them; else from the articles, or from the
whole page if no container has text, without link lists: elements that have repeated links (``@@``)
and on no page of the host a text slot (``#``) in them. What stands around the articles of a container counts without
the slots whose text is constant on the host. Elements whose tag or
class says menu, header, footer, sidebar, notice, advert, form or comment are left out, as are
slots of the wrapper with constant text outside the containers. A class says so by a token that begins or
ends with a side word at a hyphen (``sidebar``, ``comment-list``, ``site-footer``, not ``no-sidebar``), never on
html, body, main or an article, nor on what holds the container; a paragraph is left out only as an
advert. A form with more than half of the text is no form to fill in but the page.

On hosts without named containers the marks of the expression choose: a *trunk* is an element in which text
blocks are repeated (``+``). An optional element (``?``) outside every trunk, that holds no trunk itself and is
no group's member, comes and goes around the text, as notices and adverts do; it goes if
at least three pages told of the host and the rest of the page has four times its text.
"""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import lru_cache
from html import unescape
import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
import xxhash

from edgeweave.session import written_table

HELD_HOSTS, CONSTANT_PAGES, DEPTH = 5000, 3, 100

# Elements without content, with raw content, and those that end a paragraph.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title".split())  # their content is no markup
TO_END = frozenset("script style textarea".split())  # without an end tag they take the rest of the page
NESTED = frozenset("svg iframe noscript template select annotation annotation-xml".split())  # markup that is not shown as text
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol optgroup option p pre section summary table "
    "tbody td tfoot th thead tr ul".split()
)
# An opening tag (first) ends the open elements named second, up to the nearest of the third.
IMPLIED_ENDS = {
    "li": ({"li", "p"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd", "p"}, {"dl"}),
    "dd": ({"dt", "dd", "p"}, {"dl"}),
    "tr": ({"tr", "td", "th", "p"}, {"table"}),
    "td": ({"td", "th", "p"}, {"tr", "table"}),
    "th": ({"td", "th", "p"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
SCOPES = frozenset("article aside blockquote body dd details dialog div dl fieldset footer form header html li main nav ol section table td th ul".split())
# What is not main text, by tag and by token of a class or id; where tokens and forms do not count.
SIDE_TAGS = frozenset("nav footer aside button dialog menu head".split())
ADVERT_WORDS = frozenset("ad ads advert adverts advertisement advertising promo promoted promotion sponsor sponsored".split())
NEGATIONS = frozenset("no not with without has is non".split())
KEPT_TAGS = frozenset("#page html body main article".split())
SIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies discussion disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices overlay "
    "pager pagination popup promo promoted promotion recommended related replies reply respond search share sharing sidebar "
    "signup skip social sponsor sponsored subscribe subscription toolbar widget "
    "kommentar kommentare comentarios commentaires anzeige werbung publicidad publicite".split()
)
CONTENT_WORDS = frozenset("article content entry post story main text body".split())

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^"'>]|"[^"]*"|'[^']*')*)>|<[!?/][^>]*>""", re.S)
_NESTED = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(script|style|textarea)\b.*?(?:</\1\b[^>]*>|\Z)|"""
    r"""<(/?)(svg|iframe|noscript|template|select|annotation-xml|annotation)(?=[\s/>])((?:[^"'>]|"[^"]*"|'[^']*')*)>""",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""([^\s=/"']+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)|([^\s=/"']+)""", re.S)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_WORDS = re.compile(r"[a-z]+")
_MASK = (1 << 63) - 1


class Link(str):
    """Text inside a link."""


class Element:
    """A block element: ``parts`` are texts and elements in page order."""

    __slots__ = ("tag", "label", "words", "hidden", "parts")

    def __init__(self, tag: str, label: str, words: frozenset, hidden: bool = False) -> None:
        self.tag, self.label, self.words, self.hidden = tag, label, words, hidden
        self.parts: list = []


def _tokens(value: str) -> list[str]:
    """The tokens of a class, each as its words joined by hyphens."""
    return ["-".join(words) for token in value.lower().split() if (words := _WORDS.findall(token))]


@lru_cache(10_000)
def _says_side(token: str) -> bool:
    words = token.split("-")
    return NEGATIONS.isdisjoint(words) and (words[0] in SIDE_WORDS or words[-1] in SIDE_WORDS)


@lru_cache(10_000)
def _says_content(token: str) -> bool:
    words = token.split("-")
    return not CONTENT_WORDS.isdisjoint(words) and not _says_side(token) and "header" not in words


def _named(tag: str, attributes: str) -> Element:
    """An element with its label, and the words of its class, id and role."""
    if not attributes.strip(" /\n\t"):
        return Element(tag, tag, frozenset())
    found = {}
    for m in _ATTRIBUTE.finditer(attributes):
        name = (m[1] or m[3]).lower()
        found.setdefault(name, (m[2] or "").strip("\"'"))
    words = set(_tokens(found.get("class", "")))
    words |= {w for w in _tokens(found.get("id", "") + " " + found.get("role", "")) if _says_side(w) or _says_content(w) or w == "header"}
    hidden = "hidden" in found or found.get("aria-hidden") == "true" or bool(_HIDDEN.search(found.get("style", "")))
    return Element(tag, ".".join([tag, *sorted(words)]), frozenset(words), hidden)


def _nested_ends(html: str) -> dict[int, int]:
    """Where elements of ``NESTED`` that have an end tag start and end."""
    found: dict[int, int] = {}
    opened: dict[str, list[int]] = {tag: [] for tag in NESTED}
    for m in _NESTED.finditer(html):
        if not m[3]:
            continue
        starts = opened[m[3].lower()]
        if not m[2]:
            if not m[4].endswith("/"):
                starts.append(m.start())
        elif starts:
            found[starts.pop()] = m.end()
    return found


def page_tree(html: str) -> Element:
    """The page as a tree of block elements below one root."""
    root = Element("#page", "#page", frozenset())
    stack, at, end = [root], 0, len(html)
    ends: dict[int, int] | None = None
    unended: set[str] = set()
    link = False
    while at < end:
        m = _TAG.search(html, at)
        start = m.start() if m else end
        if start > at:
            text = unescape(html[at:start])
            stack[-1].parts.append(Link(text) if link else text)
        if not m:
            break
        at = m.end()
        if not m[2]:
            continue
        closing, tag = bool(m[1]), m[2].lower()
        if not closing and tag == "head":  # without an end it stops at the body
            body = re.compile(r"<body\b|</head\b[^>]*>", re.I).search(html, at)
            if body:
                at = body.start() if body[0].lower() == "<body" else body.end()
            continue
        if not closing and (tag in RAW or tag in NESTED):
            if (m[3] or "").endswith("/") and tag not in TO_END:
                continue
            if tag in NESTED:
                if ends is None:
                    ends = _nested_ends(html)
                at = ends.get(start, at)  # without an end only the tag goes
            elif tag not in unended:
                over = re.compile(rf"</{tag}\b[^>]*>", re.I).search(html, at)
                if over:
                    at = over.end()
                elif tag in TO_END:
                    at = end
                else:
                    unended.add(tag)
            continue
        if tag == "br":
            stack[-1].parts.append(" ")
            continue
        if tag == "a":
            link = not closing and "href" in (m[3] or "").lower()
        if closing:
            _close(stack, tag)
            continue
        element = _named(tag, m[3] or "")
        if tag in VOID or (m[3] or "").endswith("/") and tag not in BLOCK:
            if tag == "hr":
                stack[-1].parts.append(element)
            continue
        side = element.hidden or _is_side(tag, element.words, True)
        if tag not in BLOCK and not side:
            continue  # inline: its text belongs to what is around it
        implied, scope = IMPLIED_ENDS.get(tag, ({"p"}, SCOPES))
        if tag in BLOCK:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in implied:
                    del stack[i:]
                if i < len(stack) and stack[i].tag in scope and stack[i].tag not in implied:
                    break
        if len(stack) <= DEPTH:
            stack[-1].parts.append(element)
        elif not side:  # deeper blocks are part of this one, between breaks
            stack[-1].parts.append(Element("hr", "hr", frozenset()))
            element.parts = stack[-1].parts
        stack.append(element)
    return root


def _close(stack: list[Element], tag: str) -> None:
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag == tag:
            del stack[i:]
            return
        if tag not in BLOCK and stack[i].tag in BLOCK:
            return  # an inline end tag does not end blocks


# Wrappers: an item is [label, optional, repeated, children]; a group has the label "(" and members as children.


def _merged(a: list, b: list) -> list:
    """One item for two with the same label."""
    return [a[0], a[1] or b[1], a[2] or b[2], aligned(a[3], b[3])]


def folded(items: list) -> list:
    """``items`` with every label once: spans of labels that come round again become repeated groups."""
    while True:
        places: dict[str, list[int]] = {}
        for i, item in enumerate(items):
            for label in [m[0] for m in item[3]] if item[0] == "(" else [item[0]]:
                places.setdefault(label, []).append(i)
        spans = [(p[0], p[-1]) for p in places.values() if p[0] != p[-1]]
        if not spans:
            return items
        first, last = min(spans)
        members: dict[str, list] = {}
        for item in items[first : last + 1]:
            for m in item[3] if item[0] == "(" else [item]:
                members[m[0]] = _merged(members[m[0]], m) if m[0] in members else m
        if len(members) == 1:
            (only,) = members.values()
            group = [only[0], only[1], True, only[3]]
        else:
            group = ["(", False, True, [[m[0], True, m[2], m[3]] for m in members.values()]]
        items = items[:first] + [group] + items[last + 1 :]


def _unrolled(items: list) -> list:
    """Groups as two rounds of their members, which ``folded`` makes a group again."""
    out = []
    for item in items:
        out += item[3] * 2 if item[0] == "(" else [item]
    return out


def aligned(a: list, b: list) -> list:
    """The sequence that covers both: common labels merged, all others optional."""
    if a == b:
        return a
    left, right = _unrolled(a), _unrolled(b)
    match = SequenceMatcher(None, [i[0] for i in left], [i[0] for i in right], autojunk=False)
    out = []
    for kind, i, j, k, n in match.get_opcodes():
        if kind == "equal":
            out += [_merged(x, y) for x, y in zip(left[i:j], right[k:n])]
        else:
            out += [[x[0], True, x[2], x[3]] for x in left[i:j] + right[k:n]]
    return folded(out)


def page_expression(element: Element) -> list:
    """The children of an element as a folded sequence."""
    items: list = []
    run: list[str] = []
    links = 0

    def end_of_run() -> None:
        nonlocal links
        if any(p.strip() for p in run):
            told = [p for p in run if any(map(str.isalnum, p))]
            linked = bool(told) and all(isinstance(p, Link) for p in told)
            items.append(["@" if linked else "#", False, False, []])
            links += len(told) if linked else 0
        run.clear()

    for part in element.parts:
        if isinstance(part, str):
            run.append(part)
            continue
        end_of_run()
        items.append([part.label, False, False, page_expression(part)])
        slots = _slot_labels(items[-1][3])
        links += "@" in slots and "#" not in slots
    end_of_run()
    if links > 1:
        items.append(["@@", False, False, []])
    return folded(items)


def _slot_labels(items: list) -> set[str]:
    """Which of ``#``, ``@`` and ``@@`` stand anywhere in a sequence."""
    return {i[0] for i in items if i[0] in ("#", "@", "@@")}.union(*(_slot_labels(i[3]) for i in items))


def _is_marked(tag: str, words: frozenset, inside: bool) -> bool:
    """Whether its class says that an element is no main text; a header is none, outside the article."""
    if tag in KEPT_TAGS:
        return False
    if tag == "p":
        return any(not ADVERT_WORDS.isdisjoint(w.split("-")) and _says_side(w) for w in words)
    return any(map(_says_side, words)) or (not inside and (tag == "header" or "header" in words))


def _is_side(tag: str, words: frozenset, inside: bool) -> bool:
    return tag in SIDE_TAGS or _is_marked(tag, words, inside)


def page_slots(root: Element) -> dict[str, tuple[int, int]]:
    """Hashes of its text and of the other texts of the page, for slots outside articles whose path stands once.

    The other texts are those that can be main text: neither hidden nor in side matter.
    """
    found: dict[str, int | None] = {}
    counted: dict[str, int] = {}
    texts = 0

    def walk(element: Element, path: str, article: bool, side: bool) -> None:
        nonlocal texts
        text = " ".join("".join(p for p in element.parts if isinstance(p, str)).split())
        if text:
            digest = xxhash.xxh64_intdigest(text) >> 1
            if not side:
                texts += digest
                counted[path] = digest
            if not article:
                found[path] = None if path in found else digest
        for part in element.parts:
            if not isinstance(part, str):
                below = side or part.hidden or _is_side(part.tag, part.words, False)
                walk(part, f"{path}/{part.label}", article or part.tag == "article", below)

    walk(root, "", False, False)
    return {p: (h, (texts - counted.get(p, 0)) & _MASK) for p, h in found.items() if h is not None}


class Wrapper:
    """A host's expression, how many pages it covers, and per slot its text, if always the same, and hashes of other texts beside it."""

    def __init__(self, pages: int = 0, items: list | None = None, slots: dict | None = None) -> None:
        self.pages, self.items, self.slots = pages, items, slots or {}
        self.seen: set[int] = set()

    def add_page(self, root: Element) -> None:
        items = page_expression(root)
        shape = xxhash.xxh64_intdigest(json.dumps(items))
        if shape not in self.seen:  # a page of a known shape changes no expression
            self.items = items if self.items is None else aligned(self.items, items)
            self.seen.add(shape)
        self.pages += 1
        for path, (text, others) in page_slots(root).items():
            self._slot(path, text, [others])

    def _slot(self, path: str, text: int | None, others: list[int]) -> None:
        known = self.slots.setdefault(path, [text, []])
        if text is None or known[0] != text:
            known[:] = [None, []]
        elif len(known[1]) < CONSTANT_PAGES:
            known[1] = sorted({*known[1], *others})[:CONSTANT_PAGES]

    def add(self, other: Wrapper) -> None:
        self.items = other.items if self.items is None else aligned(self.items, other.items)
        self.pages += other.pages
        for path, (text, others) in other.slots.items():
            self._slot(path, text, others)

    def dumped(self) -> str:
        return json.dumps([self.pages, self.items, self.slots])

    @staticmethod
    def loaded(text: str) -> Wrapper:
        return Wrapper(*json.loads(text))

    def plan(self) -> tuple[list[frozenset], frozenset, frozenset, frozenset]:
        """Paths of articles, main elements and elements named like main or content, of constant slots, link lists and passing elements."""
        kinds: list[set] = [set(), set(), set(), set()]

        def walk(items: list, path: str) -> None:
            for label, _, _, children in items:
                if label == "(":
                    walk(children, path)
                    continue
                tag, *words = label.split(".")
                here = f"{path}/{label}"
                if tag in SIDE_TAGS:
                    continue
                if tag == "article":
                    kinds[0].add(here)
                    continue  # nothing below an article takes its place
                if tag not in ("body", "html"):
                    telling = [w for w in words if _says_content(w)]
                    if tag == "main":
                        kinds[1].add(here)
                    elif any("main" in w.split("-") for w in telling):
                        kinds[2].add(here)
                    elif telling:
                        kinds[3].add(here)
                walk(children, here)

        walk(self.items or [], "")
        still = frozenset(p for p, (text, others) in self.slots.items() if text is not None and len(others) >= CONSTANT_PAGES)
        lists: set[str] = set()

        def walk_lists(items: list, path: str) -> set[str]:
            found = set()
            for label, _, _, children in items:
                here = path if label == "(" else f"{path}/{label}"
                below = walk_lists(children, here)
                if label != "(" and "@@" in below and "#" not in below:
                    lists.add(here)
                found |= below | ({label} if label in ("#", "@@") else set())
            return found

        walk_lists(self.items or [], "")
        passing = _passing(self.items or [], "")[1] if self.pages >= CONSTANT_PAGES else set()
        return [frozenset(k) for k in kinds], still, frozenset(lists), frozenset(passing)


def _passing(items: list, path: str) -> tuple[bool, set[str]]:
    """Whether a sequence is a trunk or holds one, and the paths of optional elements with text that neither are nor hold one."""
    slots = lambda item: "#" in _slot_labels([item])
    if any(item[2] and item[0] != "#" and slots(item) for item in items):
        return True, set()  # blocks of text are repeated here: all of it belongs together
    trunk, out, held = False, set(), []
    for label, optional, _, children in items:
        if label in ("#", "@", "@@"):
            continue
        inside, below = _passing(children, f"{path}/{label}")
        trunk |= inside
        out |= below
        if optional and not inside and slots([label, optional, False, children]):
            held.append(f"{path}/{label}")
    return trunk, out | set(held)


Found = list[tuple[Element, str]]


def _containers(root: Element, wanted: frozenset) -> tuple[Found, Found]:
    """The outermost elements of the page at the wrapper's paths: in the open, and below what is marked as side matter."""
    out: tuple[list, list] = ([], [])

    def walk(element: Element, path: str, below: bool) -> None:
        for part in element.parts:
            if isinstance(part, str) or part.hidden or part.tag in SIDE_TAGS:
                continue
            here = f"{path}/{part.label}"
            under = part.tag != "main" and (below or _is_marked(part.tag, part.words, False))
            if here in wanted:
                out[under].append((part, here))
            else:
                walk(part, here, under)

    if wanted:
        walk(root, "", False)
    return out


def _length(element: Element, inside: bool) -> int:
    """Letters of an element's text, that of its forms included."""
    own = sum(len("".join(p.split())) for p in element.parts if isinstance(p, str))
    below = (p for p in element.parts if not isinstance(p, str) and not p.hidden and not _is_side(p.tag, p.words, inside))
    return own + sum(_length(p, inside) for p in below)


def _text(elements: Found, constants: frozenset, inside: bool, articles: bool = True, lists: frozenset = frozenset()) -> str:
    """Blocks of the text of elements without side matter, constant slots and link lists, joined by line breaks."""
    blocks: list[list[str]] = [[]]
    whole: list[int] = []

    def is_form(part: Element) -> bool:
        if part.tag != "form":
            return False
        if not whole:
            whole.append(sum(_length(e, inside) for e, _ in elements))
        return 2 * _length(part, inside) <= whole[0]

    def walk(element: Element, path: str) -> None:
        constant = path in constants
        for part in element.parts:
            if isinstance(part, str):
                if not constant:
                    blocks[-1].append(part)
                continue
            block = part.tag in BLOCK
            if block:
                blocks.append([])
            left = part.hidden or _is_side(part.tag, part.words, inside) or (part.tag == "article" and not articles)
            here = f"{path}/{part.label}"
            if not left and here not in lists and not is_form(part):
                walk(part, here)
            if block:
                blocks.append([])

    for element, path in elements:
        blocks.append([])
        walk(element, path)
    texts = (" ".join("".join(b).split()) for b in blocks)
    return "\n".join(t for t in texts if t)


def main_text(
    root: Element, kinds: list[frozenset], constants: frozenset, lists: frozenset = frozenset(), passing: frozenset = frozenset()
) -> str:
    """Blocks of the main text, joined by line breaks, by the plan of the wrapper that covers the page.

    Marks of side matter do not count on what holds the page's only article or, if the page has no other
    text, any container.
    """
    found = [_containers(root, k) for k in kinds]
    (articles, lone), (mains, _), *named = found
    in_articles = _text(articles, frozenset(), True)
    around = constants if articles else frozenset()
    in_main = _text(mains, around, True)
    if in_main and len(in_main) >= len(in_articles):
        return in_main
    for opened, _ in named:
        if len(_text(opened, around, True, articles=False)) > len(in_articles):
            return _text(opened, around, True)
    if in_articles:
        return in_articles
    text = _text(lone, frozenset(), True) if len(lone) == 1 else ""
    text = text or _text([(root, "")], constants, False, lists=lists) or _text([(root, "")], constants, False)
    if passing and not any(kinds):
        rest = _text([(root, "")], constants, False, lists=lists | passing)
        text = rest if len(rest) * 5 >= len(text) * 4 else text
    return text or next((t for _, m in found if (t := _text(m, frozenset(), True))), "")


def host_wrappers(pages: DataFrame) -> DataFrame:
    """``(host, wrapper)`` from all rows of ``pages (host, html)``."""

    def fold_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Wrapper] = {}

        def taken() -> pa.RecordBatch:
            out = pa.RecordBatch.from_pydict({"host": list(held), "wrapper": [w.dumped() for w in held.values()]}, _WRAPPER)
            held.clear()
            return out

        for rows in batches:
            for host, html in zip(rows.column("host"), rows.column("html")):
                held.setdefault(host.as_py(), Wrapper()).add_page(page_tree(html.as_py() or ""))
                if len(held) >= HELD_HOSTS:
                    yield taken()
        yield taken()

    def fold_wrappers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        host, wrapper = None, None
        for rows in batches:
            for name, text in zip(rows.column("host").to_pylist(), rows.column("wrapper").to_pylist()):
                if name != host and wrapper is not None:
                    yield pa.RecordBatch.from_pydict({"host": [host], "wrapper": [wrapper.dumped()]}, _WRAPPER)
                    wrapper = None
                if wrapper is None:
                    host, wrapper = name, Wrapper()
                wrapper.add(Wrapper.loaded(text))
        if wrapper is not None:
            yield pa.RecordBatch.from_pydict({"host": [host], "wrapper": [wrapper.dumped()]}, _WRAPPER)

    parts = pages.mapInArrow(fold_pages, "host string, wrapper string")
    return parts.repartition("host").sortWithinPartitions("host", "wrapper").mapInArrow(fold_wrappers, "host string, wrapper string")


def host_plans(wrappers: DataFrame) -> DataFrame:
    """``(host, plan)``: of a wrapper only the paths that extraction asks for, which go to every page of the host."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            plans = [_packed_plan(Wrapper.loaded(text).plan()) for text in rows.column("wrapper").to_pylist()]
            yield pa.RecordBatch.from_arrays([rows.column("host"), pa.array(plans, pa.string())], ["host", "plan"])

    return wrappers.mapInArrow(run, "host string, plan string")


def _packed_plan(plan: tuple) -> str:
    kinds, *others = plan
    return json.dumps([[sorted(k) for k in kinds], *map(sorted, others)])


def _opened_plan(text: str) -> tuple:
    kinds, *others = json.loads(text)
    return ([frozenset(k) for k in kinds], *map(frozenset, others))


_WRAPPER = pa.schema([("host", pa.string()), ("wrapper", pa.string())])
_TEXT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def main_texts(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars)`` for every row of ``pages (page_id, url, html)``.

    A null html is an empty page, a page without text gives an empty text. Pages with a null URL, or one
    without ``://``, share the host ````. Null ids and repeated rows stay; an empty table gives no
    rows; columns beyond the three are ignored.
    """
    rest = F.when(F.instr("url", "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    host = F.lower(F.regexp_extract(F.coalesce(rest, F.lit("")), "^[^/?#]*", 0))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")
    ).withColumn("host", host)
    # a table, so that Spark knows its size: with few hosts no page is shuffled, with many the join splits a hot host
    plans, _ = written_table(host_plans(host_wrappers(rows.select("host", "html"))), "plans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple] = {}
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                texts = []
                for html, text in zip(part.column("html"), part.column("plan").to_pylist()):
                    if text not in known:
                        if len(known) > 1000:
                            known.clear()
                        known[text] = _opened_plan(text)
                    texts.append(main_text(page_tree(html.as_py() or ""), *known[text]))
                columns = [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, schema=_TEXT)

    return rows.join(plans, "host").mapInArrow(run, "page_id long, url string, text string, n_chars long")
