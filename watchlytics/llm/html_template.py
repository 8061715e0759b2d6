"""Main text of web pages by template deduction from equivalence classes of tokens.

1. Every page is cut into tokens: elements by their path (names and marked classes from the root down) and texts at
   their path. ``token_vectors`` describes the occurrence vector of each token over the pages of its host by a
   hash that adds up (sums over pages of page and count), so tokens with equal vectors have equal descriptions and
   a hot host is grouped token by token, never as a whole.
2. ``templates`` groups the frequent tokens of a host into equivalence classes. A class is valid if its tokens occur once per
   page, or if it nests: all its elements lie below one class, or below itself. The valid classes form the host's template,
   whose size is bounded by that of a page: only tokens on at least ``SUPPORT`` of the host's pages count.
3. ``lay_out`` tells frame from slots per layout: an element with a slot below it is a layout of the pages that have it, and
   the texts on nearly all of them are frame. Texts on fewer than ``TEXT_PAGES`` pages never are.
4. ``extract`` lays the template over each page; texts that are not frame are slots. Names choose between the slots: those below
   the content element are the article, and those of menus, notices and the like are not. Pages without their
   host's content element use their own, or all slots of the page.

Character references are decoded, white space inside a block becomes one space, blocks are joined by one space.
Below the content element a frame text goes only where its place (path and classes) holds no slot, or in a marked element; lines
that articles share between their own paragraphs stay. Null and empty pages have no text;
null URLs form a host of their own. Unclosed and cut-off markup is read as far as it goes; elements nested deeper than
``MOST_DEPTH`` count as the one above them, so time and memory follow the length of a page, however long or deep.
Repeated rows get equal results, an empty table gives no rows, columns named like the added one are replaced.
"""

from __future__ import annotations

import html as references
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from watchlytics.llm.common import bound_batches, discard, free_name, stored
from watchlytics.llm.url_filter import host_of

#: Share of a host's pages a token must be on to be part of the template.
SUPPORT = 0.2
#: Share of a host's pages, and number of them, a text outside the content must be on to be template.
TEXT_SUPPORT, TEXT_PAGES = 0.9, 5

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)
    | <(?P<raw>script|style|noscript|template|textarea|iframe)\b[^>]*(?:>.*?(?:</(?P=raw)\b[^>]*(?:>|\Z)|\Z)|\Z)
    | <(?P<end>/?)(?P<name>[a-z][^\s/>]*)(?P<marks>(?:[^>"']|"[^"]*"|'[^']*')*+)(?:>|\Z)
    | </?[a-z][^>]*(?:>|\Z)
    | <[!?/][^>]*(?:>|\Z)
    | <\Z""",
    re.S | re.I | re.X,
)
#: The attribute that takes an element off the page, or its style that does.
HIDDEN = re.compile(r"""(?<![\w:.-])(?:hidden(?=[\s=/]|\Z)|style\s*=\s*(?:"[^"]*|'[^']*|[^\s>"']*)display\s*:\s*none)""", re.I)
MARK = re.compile(r"""(?<![\w:.-])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)

#: Kinds of HTML elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr b bdi bdo big cite code data del dfn em font i img input ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split()
)
CLOSES = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]),
    "th": frozenset(["td", "th"]),
    "option": frozenset(["option"]),
    "body": frozenset(["head"]),
}
CLOSABLE = frozenset(["p", *(name for names in CLOSES.values() for name in names)])
#: Elements of the whole page: their marks tell nothing about a part of it.
ROOTS = frozenset(["html", "body"])
#: Elements that hold one paragraph or less: a mark on them does not make them a part of the page of its own.
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th tr blockquote pre figcaption caption".split()) | INLINE
STOPS = frozenset(["ul", "ol", "dl", "table", "select", "article", "section", "div", "body"])
#: Elements and marks (words of class, id or role) that are never part of an article.
ASIDE_NAMES = frozenset("head title nav footer aside form button select label dialog menu svg canvas object audio video fieldset".split())
ASIDE_MARKS = frozenset(
    """ad ads adv advert adverts advertisement advertising promo promotion sponsor sponsored banner cookie cookies consent
    notice notices notification alert popup modal overlay newsletter subscribe subscription signup login share sharing social
    related recommended sidebar side menu nav navbar navigation breadcrumb breadcrumbs pagination comment comments
    disqus reply replies footer widget toolbar copyright complementary contentinfo search""".split()
)
#: Of these, words that articles use for their own parts too: the template and the share of the text decide.
WEAK_MARKS = frozenset("related recommended search alert side menu widget toolbar signup login copyright promo promotion".split())
#: And those that hold on a single paragraph as well: adverts, reader comments, notices about cookies, hidden text.
PARAGRAPH_MARKS = frozenset(
    """ad ads adv advert adverts advertisement advertising sponsor sponsored cookie cookies consent comment comments disqus
    reply replies newsletter hidden""".split()
)
#: Words that may stand beside a mark in one class without changing its sense: comment-list, but not has-comments.
BESIDE = frozenset(
    """area bar block body bottom box button buttons col column container content count desktop display facebook fb form gdpr
    global google group head header heading icon icons in inline inner item items js left link links list main media meta mid
    mobile module native outer panel primary reader readers right row secondary section site slot sticky stories story text
    thread title top unit user users wrap wrapper""".split()
)
#: Of the aside elements, those that may wrap a whole page.
WRAPPERS = frozenset(["form", "fieldset", "object"])
HEADER = frozenset(["header", "masthead"])
CONTENT_NAMES = ("article", "main")
CONTENT_MARKS = frozenset("article main content story post entry".split())
#: Elements nested deeper belong to the last one above; longer names are cut. Both bound the length of a path.
MOST_DEPTH, MOST_NAME = 48, 64


@dataclass
class Text:
    """A text run: path of its element, number of its block, the text itself, all classes below the content element."""

    __slots__ = ("path", "block", "text", "classes")
    path: tuple[str, ...]
    block: int
    text: str
    classes: str | None

    @property
    def place(self) -> str:
        return "/".join(self.path) + (f"|{self.classes}" if self.classes else "")


def step_of(name: str, marks: str) -> str:
    """Name of a path step: the element, with its marks if it has any that tell its use.

    A mark that stands beside other words in its class, as in ``has-comments``, gets a question mark.
    """
    if not marks or name in ROOTS:
        return name
    own = {"hidden"} if HIDDEN.search(marks) else set()
    if "=" in marks:
        for _, a, b, c in MARK.findall(marks):
            for token in (a or b or c).lower().split():
                words = set(re.split(r"[^a-z]+", token)) - {""}
                own |= words & (CONTENT_MARKS | HEADER)
                sure = words <= ASIDE_MARKS | BESIDE | CONTENT_MARKS | HEADER
                own |= {w if sure else f"{w}?" for w in words & ASIDE_MARKS}
    return f"{name}.{'.'.join(sorted(own))}" if own else name


def classes_of(step: str, marks: str, above: str | None) -> str | None:
    """All classes from below the content element down, letters only; null outside it."""
    if above is None:
        return "" if is_content(step) else None
    if "class" not in marks.lower():
        return above
    words = {w for kind, a, b, c in MARK.findall(marks) if kind.lower() == "class" for w in re.split(r"[^a-z-]+", (a or b or c).lower())}
    own = ",".join(sorted(words - {""}))
    return f"{above};{own}" if own else above


def parse(page: str) -> tuple[Counter, list[Text]]:
    """How often each element path occurs, and the texts in page order."""
    elements: Counter = Counter()
    texts: list[Text] = []
    open_: list[tuple[str, tuple[str, ...], str | None]] = []  # name, path above, classes
    names: Counter = Counter()  # of the open elements
    closing: list[int] = []  # places of open elements that an opening tag may close, or that stop it
    path: tuple[str, ...] = ()
    block = at = 0

    def pop(to: int) -> None:
        nonlocal path
        path = open_[to][1]
        names.subtract(name for name, *_ in open_[to:])
        del open_[to:]
        while closing and closing[-1] >= to:
            closing.pop()

    start = page.find("<")
    while start >= 0:
        found = TOKEN.match(page, start)
        if not found:  # a lone sign
            start = page.find("<", start + 1)
            continue
        if start > at:
            text = page[at:start]
            if not text.isspace():
                texts.append(Text(path, block, text, open_[-1][2] if open_ else None))
            elif texts and texts[-1].block == block:
                texts.append(Text(path, block, " ", None))
        at = found.end()
        start = page.find("<", at)
        _, end, name, marks = found.groups()
        if not name:
            continue
        name = name.lower()[:MOST_NAME]
        inline = name in INLINE
        if not inline:
            block += 1
        if end:
            if names[name] > 0:
                pop(next(place for place in range(len(open_) - 1, -1, -1) if open_[place][0] == name))
            continue
        if not inline and name not in VOID:
            closed, ended = CLOSES.get(name, ()), -1
            for place in reversed(closing):
                if open_[place][0] in STOPS:
                    break
                if open_[place][0] == "p" or open_[place][0] in closed:
                    ended = place
            if ended >= 0:
                pop(ended)
        deep = len(path) >= MOST_DEPTH
        above = open_[-1][2] if open_ else None
        step = step_of(name, marks)
        if not deep:
            elements[(*path, step)] += 1
        if name not in VOID and not marks.endswith("/"):
            if name in STOPS or name in CLOSABLE:
                closing.append(len(open_))
            names[name] += 1
            open_.append((name, path, above if deep else classes_of(step, marks, above)))
            if not deep:
                path = (*path, step)
    if at < len(page) and (text := page[at:]).strip():
        texts.append(Text(path, block, text, open_[-1][2] if open_ else None))
    return elements, texts


def blocks_of(texts: list[Text]) -> str:
    """Blocks in page order, joined by one space."""
    whole: list[list[str]] = []
    last = -1
    for t in texts:
        if t.block != last:
            whole.append([])
            last = t.block
        whole[-1].append(t.text)
    clean = (" ".join(references.unescape("".join(parts)).split()) for parts in whole)
    return " ".join(c for c in clean if c)


@lru_cache(maxsize=100_000)
def marks_of(step: str) -> tuple[str, frozenset[str], frozenset[str]]:
    """Element, all marks, and those that stand for themselves."""
    name, _, marks = step.partition(".")
    words = marks.split(".") if marks else []
    return name, frozenset(w.rstrip("?") for w in words), frozenset(w for w in words if not w.endswith("?"))


@lru_cache(maxsize=100_000)
def is_content(step: str) -> bool:
    name, marks, sure = marks_of(step)
    if name in CONTENT_NAMES:
        return not sure & PARAGRAPH_MARKS
    return bool(marks & CONTENT_MARKS) and not marks & (ASIDE_MARKS | {"hidden"}) and name not in INLINE


def is_aside(path: tuple[str, ...]) -> bool:
    """Whether an element of the path is a menu, notice or the like, or carries such a mark."""
    return any(name in ASIDE_NAMES or name == "header" or marks & (ASIDE_MARKS | HEADER) for name, marks, _ in map(marks_of, path))


def is_surely_aside(step: str) -> bool:
    """Whether an element's name or mark says that it is no part of an article, however much it holds."""
    name, _, sure = marks_of(step)
    if name in ASIDE_NAMES and name not in WRAPPERS:
        return True
    if name in INLINE:
        return "hidden" in sure
    return bool(sure & (PARAGRAPH_MARKS if name in PARAGRAPHS else (ASIDE_MARKS | {"hidden"}) - WEAK_MARKS))


def aside_paths(texts: list[Text], depth: int, template: Template | None, content: bool) -> set[tuple[str, ...]]:
    """Paths, longer than ``depth``, at or below the elements whose texts do not belong to the article.

    Adverts, reader comments, menus and notices never do, however long they are; without a content element the exception
    is one that holds all the text there is. Words that articles use too count only on elements that the
    host's template has, below a content element not on paragraphs, and not on an
    element that holds more than half of the text: that one wraps the article. The same goes for headers and forms of
    pages without a content element.
    """
    own: Counter = Counter()
    for t in texts:
        own[t.path] += 0 if t.text.isspace() or (template and text_token(t) in template.texts) else len(t.text)
    nodes: set[tuple[str, ...]] = set()
    for path in own:
        while len(path) > depth and path not in nodes:
            nodes.add(path)
            path = path[:-1]
    found, doubtful, named = set(), set(), set()
    for path in nodes:
        name, marks, _ = marks_of(path[-1])
        if is_surely_aside(path[-1]) or content and name in WRAPPERS:
            (found if content or name in ASIDE_NAMES else named).add(path)
        elif not content and (name in WRAPPERS or name == "header" or marks & HEADER):
            doubtful.add(path)
        elif marks & ASIDE_MARKS and name not in INLINE and (template is None or template.is_frame(path) and not (content and name in PARAGRAPHS)):
            doubtful.add(path)
    downward = sorted(nodes, key=len)
    if named:
        held, total = sums(own, downward, depth, below(found, downward))
        found |= {path for path in named if held[path] < total}
    if doubtful:
        held, total = sums(own, downward, depth, below(found, downward))
        found |= {path for path in doubtful if 2 * held[path] <= total}
    return below(found, downward)


def below(found: set[tuple[str, ...]], downward: list[tuple[str, ...]]) -> set[tuple[str, ...]]:
    """The paths at or below those found; ``downward`` has shorter paths first."""
    closed: set[tuple[str, ...]] = set()
    if found:
        for path in downward:
            if path in found or path[:-1] in closed:
                closed.add(path)
    return closed


def sums(own: Counter, downward: list[tuple[str, ...]], depth: int, without: set[tuple[str, ...]]) -> tuple[Counter, int]:
    """Characters at and below each path, and all of them, without those of some paths."""
    held = Counter({path: n for path, n in own.items() if path not in without})
    total = held.total()
    for path in reversed(downward):
        if len(path) > depth + 1:
            held[path[:-1]] += held[path]
    return held, total


def text_token(t: Text) -> int:
    return xxhash.xxh64_intdigest(t.place + "\0" + " ".join(t.text.split())) - (1 << 63)


TOKENS = T.StructType(
    [
        T.StructField("host", T.StringType()),
        T.StructField("page", T.LongType()),
        T.StructField("path", T.StringType()),
        T.StructField("text", T.LongType()),
        T.StructField("n", T.IntegerType()),
        T.StructField("chars", T.LongType()),
    ]
)


def token_vectors(pages: DataFrame, host: str, page: str, html: str) -> DataFrame:
    """One row per host and token: path, text hash (null for elements), pages, occurrences, description of its vector.

    ``chars`` are those of the text, or of all texts directly in the element. Elements of the content count once more by all
    their classes, behind a bar.
    """
    bound_batches(pages.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for name, number, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                elements, texts = parse(body.as_py() or "")
                rows.append((name, number, "", None, 1, 0))
                seen: dict[tuple, list[int]] = {}
                held: dict[str, list[int]] = {"/".join(path): [n, 0] for path, n in elements.items()}
                for t in texts:
                    if t.text != " ":
                        place = t.place
                        own = seen.setdefault((place, text_token(t)), [0, 0])
                        own[0] += 1
                        own[1] += len(t.text)
                        if place:
                            direct = held.setdefault(place, [0, 0])
                            direct[0] += "|" in place
                            direct[1] += len(t.text)
                rows += [(name, number, path, None, n, chars) for path, (n, chars) in held.items()]
                rows += [(name, number, path, token, n, chars) for (path, token), (n, chars) in seen.items()]
            columns = list(zip(*rows)) if rows else [()] * 6
            kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=TOKENS.names)

    given = pages.select(F.col(f"`{host}`"), F.col(f"`{page}`"), F.col(f"`{html}`"))
    tokens = given.mapInArrow(cut, TOKENS)
    return tokens.withColumn("hash", F.xxhash64("page", "n")).groupBy("host", "path", "text").agg(
        F.count("*").alias("pages"),
        F.sum("n").alias("times"),
        F.sum("chars").alias("chars"),
        # Sums of both halves: unlike XOR, pages that are given twice do not cancel out.
        F.xxhash64(F.sum(F.col("hash").bitwiseAND(F.lit((1 << 32) - 1))), F.sum(F.shiftrightunsigned("hash", 32))).alias("vector"),
    )


def templates(vectors: DataFrame, support: float = SUPPORT) -> DataFrame:
    """One row per host: number of pages and its classes, each with its tokens (path, text, pages, times)."""
    hosts = vectors.where("path = '' AND text IS NULL").select("host", F.col("pages").alias("all_pages"))
    frequent = vectors.where("path <> ''").join(hosts, "host").where(F.col("pages") >= support * F.col("all_pages"))
    # Passed through an array, the host no longer tells how the join was dealt out: its partitions may be split, and only
    # the frequent tokens, no more than some pages' worth per host, are then brought together.
    frequent = frequent.withColumn("host", F.array_max(F.array("host")))
    token = F.struct("path", "text", "pages", "times", "chars")
    classes = frequent.groupBy("host", "all_pages", "vector", "pages", "times").agg(F.sort_array(F.collect_list(token)).alias("tokens"))
    return classes.groupBy("host", "all_pages").agg(F.sort_array(F.collect_list("tokens")).alias("classes"))


@dataclass
class Template:
    """Valid classes of a host: elements, texts that are frame, places that hold nothing else, the content element."""

    pages: int
    elements: dict[tuple[str, ...], int] = field(default_factory=dict)
    on: dict[tuple[str, ...], int] = field(default_factory=dict)
    texts: set[int] = field(default_factory=set)
    places: set[str] = field(default_factory=set)
    content: tuple[str, ...] | None = None

    def is_frame(self, path: tuple[str, ...]) -> bool:
        """Whether the host's pages share the element."""
        return path in self.elements and self.on[path] > 1


def nested(pages: int, classes: list[list[tuple]]) -> Template:
    """The template of the classes that nest. A token is (path, text, pages, times, chars)."""
    found = Template(pages)
    owner = {tuple(path.split("/")): k for k, tokens in enumerate(classes) for path, text, *_ in tokens if text is None and "|" not in path}
    held: Counter = Counter()
    texts: list[tuple[str, tuple[str, ...], int, int, int]] = []
    for k, tokens in enumerate(classes):
        above = set()
        for path, text, *_ in tokens:
            steps = steps_of(path)
            above.add(next((o for i in range(len(steps) - (text is None), 0, -1) if (o := owner.get(steps[:i])) not in (None, k)), -1))
        once = all(on == times for _, _, on, times, *_ in tokens)
        valid = len(above) == 1 or once
        for path, text, on, _, chars in tokens:
            steps = steps_of(path)
            if text is None:
                held[path] += chars
                if valid and "|" not in path:
                    found.elements[steps] = k
                    found.on[steps] = on
            elif valid and on >= TEXT_PAGES:
                texts.append((path, steps, text, on, chars))
    lay_out(found, held, texts)
    found.content = next(iter(content_paths(found.elements)), None)
    return found


def steps_of(place: str) -> tuple[str, ...]:
    return tuple(place.partition("|")[0].split("/"))


def lay_out(found: Template, held: Counter, texts: list[tuple[str, tuple[str, ...], int, int, int]]) -> None:
    """Tell frame from slots, per layout.

    An element of the template with a slot below it is a layout of the pages that have it; the texts below it on nearly all of
    these pages are frame. An element without any slot may be one article that is repeated, and makes nothing frame.
    """
    on = {(): found.pages, **found.on}
    below: Counter = Counter()
    for place, chars in held.items():
        steps = steps_of(place)
        for i in range(len(steps) + 1):
            below[steps[:i]] += chars
    fixed: dict[tuple[str, ...], list[tuple]] = {}
    for t in texts:
        for i in range(len(t[1]) + 1):
            if t[1][:i] in on and t[3] >= TEXT_SUPPORT * on[t[1][:i]]:
                fixed.setdefault(t[1][:i], []).append(t)
    frame = {t for steps, own in fixed.items() if sum(t[4] for t in own) < below[steps] for t in own}
    found.texts = {t[2] for t in frame}
    same: Counter = Counter()
    for place, _, _, _, chars in frame:
        same[place] += chars
    found.places = {place for place, chars in same.items() if chars >= TEXT_SUPPORT * held[place]}


def content_paths(paths: Iterable[tuple[str, ...]]) -> list[tuple[str, ...]]:
    """Those of content elements, the likeliest first. Asides above them only make them less likely."""
    inside = [path for path in paths if is_content(path[-1])]
    return sorted(inside, key=lambda p: (is_aside(p[:-1]), marks_of(p[-1])[0] not in CONTENT_NAMES, marks_of(p[-1])[0] != "article", len(p), p))


def within(texts: list[Text], content: tuple[str, ...], template: Template | None) -> list[Text]:
    """Texts of the elements with the content's name, wherever the page has it but in asides that are not above the content."""
    last, above = content[-1], frozenset(content[:-1])
    starts: dict[tuple[str, ...], tuple[str, ...] | None] = {}
    for path in {t.path for t in texts}:
        start = path[: path.index(last) + 1] if last in path else None
        if start and start != content and is_aside(tuple(s for s in start[:-1] if s not in above)):
            start = None
        starts[path] = start
    parts: dict[tuple[str, ...], list[Text]] = {}
    for t in texts:
        if start := starts[t.path]:
            parts.setdefault(start, []).append(t)
    kept = []
    for start, own in parts.items():
        asides = aside_paths(own, len(start), template, True)
        kept += without_frame([t for t in own if t.path not in asides], lambda t: is_frame(t, start, template))
    chosen = set(map(id, kept))
    return [t for t in texts if id(t) in chosen]


def without_frame(texts: list[Text], frame: Callable[[Text], bool]) -> list[Text]:
    """The texts of all blocks but those that are frame as a whole: a word all pages set in bold stays in its sentence."""
    slots = {t.block for t in texts if t.text != " " and not frame(t)}
    return [t for t in texts if t.block in slots]


def is_frame(t: Text, content: tuple[str, ...], template: Template | None) -> bool:
    """Whether a text below the content element is frame: a line that articles share stays where their own texts stand."""
    if not template or t.path == content or text_token(t) not in template.texts:
        return False
    return t.place in template.places or any(marks_of(s)[1] & ASIDE_MARKS for s in t.path[len(content) :])


def main_text(page: str | None, template: Template | None) -> str:
    """The article of one page."""
    if not page:
        return ""
    elements, texts = parse(page)
    contents = content_paths(elements)
    if template and template.content in elements:
        contents = [template.content, *(p for p in contents if p != template.content)]
    for content in contents:
        if found := blocks_of(within(texts, content, template)):
            return found
    if contents:
        return ""
    asides = aside_paths(texts, 0, template, False)
    known = template.texts if template else ()
    kept = [t for t in texts if t.path not in asides]
    return blocks_of(without_frame(kept, lambda t: text_token(t) in known))


#: Templates a task keeps at a time.
TEMPLATES_AT_ONCE = 1000


def extract(pages: DataFrame, url: str = "url", html: str = "html", text: str = "text") -> DataFrame:
    """``pages`` without their html, with the main text; a column ``text`` is replaced."""
    bound_batches(pages.sparkSession)
    host, page = free_name(pages, "page_host"), free_name(pages, "page_number")
    hosted = pages.withColumn(host, host_of(F.col(f"`{url}`")))
    numbered = hosted.withColumn(page, F.xxhash64(F.col(f"`{url}`"), F.col(f"`{html}`")))
    vectors = stored(token_vectors(numbered, host, page, html), "token-vectors")  # read twice, parsed once
    found = stored(templates(vectors), "templates")
    discard(pages.sparkSession, vectors)
    kept = [c for c in pages.columns if c.lower() not in (html.lower(), text.lower())]
    picked = [F.col(f"`{c}`") for c in kept]
    given = hosted.select(F.struct(*picked, F.col(f"`{html}`").alias(page)).alias("row"), F.col(host).alias("host"))
    joined = given.join(found, "host", "left").select("row.*", "host", "all_pages", "classes")
    joined = joined.toDF(*kept, *(free_name(pages, c) for c in ("page_html", "host", "all_pages", "classes")))

    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Template | None] = {}
        n = len(kept)
        for batch in batches:
            out = []
            for i, (body, name) in enumerate(zip(batch.column(n), batch.column(n + 1).to_pylist())):
                if name not in known:
                    if len(known) >= TEMPLATES_AT_ONCE:
                        known.clear()
                    count, classes = batch.column(n + 2)[i].as_py(), batch.column(n + 3)[i].as_py()
                    known[name] = nested(count, [[tuple(t.values()) for t in c] for c in classes]) if classes else None
                out.append(main_text(body.as_py(), known[name]))
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array(out, pa.string())], names=[*kept, text])

    schema = T.StructType([*pages.select(*picked).schema.fields, T.StructField(text, T.StringType())])
    return joined.mapInArrow(lay, schema)
