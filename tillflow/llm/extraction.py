"""Main text of web pages by learned slots.

A page is reduced to its text slots: the path of elements and names a block of text
stands in. What a host's pages share is learned in one pass. A text that most of the
host's different pages hold in the same slot is fixed. Where the fixed texts are most of
what an element's place holds on all pages, they are shell, whatever the element is
called; fixed headings between varying paragraphs stay. The path that holds most of a page's text is the
page's article path; paths that many pages of the host agree on are its layouts, and
a page gives the text of the first layout that holds most of its own text, or of its
own path. Elements that are furniture by tag or name are left out before.

Pages count as different by one min-hash of their three-word runs, so copies of an
article do not make its text look fixed. A host has at most ``1 / FIXED`` times the
slots of a page as shell and at most ``1 / SHARED`` layouts, so what is learned does
not grow with its pages.
"""

from __future__ import annotations

import html as references
import re
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import ship, written
from .tokens import chunks, runs, shingles

#: Part of the text that the article's path must hold.
MOST = 0.7
#: Least part of a host's different pages that hold a fixed text, and least number.
FIXED = 0.5
FIXED_PAGES = 3
#: Least part of the texts of a path that are fixed where they are shell.
SHELL = 0.5
#: Least part of a host's pages that agree on a layout.
SHARED = 0.05
#: Hosts a broadcast may hold (a few KB each).
BROADCAST_HOSTS = 20_000

#: Fixed values of HTML: elements whose content is no text of the page, furniture,
#: elements without content, inline elements, and elements an opening tag closes.
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp"}
FURNITURE = RAW | {"head", "nav", "header", "footer", "aside", "form", "button", "select", "svg", "template", "dialog",
                   "menu", "object", "canvas", "audio", "video"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins",
          "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u",
          "var", "wbr"}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}}
ENDS_P = {"address", "article", "aside", "blockquote", "div", "dl", "fieldset", "footer", "form", "h1", "h2", "h3", "h4", "h5",
          "h6", "header", "hr", "main", "nav", "ol", "p", "pre", "section", "table", "ul"}
NAMES = re.compile(
    r"^(ads?|adverts?|advertisement|banner|breadcrumbs?|comments?|comment-list|cookies?|cookie-banner|disqus|footer|header|"
    r"masthead|menu|nav|navbar|navigation|newsletter|notice|popup|promo|related|share|sharing|sidebar|social|sponsored|"
    r"subscribe|toolbar|widget)$|^(ad|ads|cookie|comment|comments|sidebar|promo|sponsor|newsletter)[-_]|[-_](ad|ads|menu|nav|sidebar)$",
    re.I)
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)(?:>|\Z)|([^<]+|<)",
                   re.S)
ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
SPACE = re.compile(r"\s+")
DIGITS = re.compile(r"\d+")


def events(page: str) -> Iterator[tuple[str, str, str]]:
    """``(kind, tag, value)`` with kind open, close or text; raw elements as a whole."""
    at = 0
    while at < len(page):
        m = TOKEN.match(page, at)
        if m is None:
            yield "text", "", page[at]
            at += 1
            continue
        at = m.end()
        if m[4] is not None:
            yield "text", "", m[4]
        elif m[2]:
            tag = m[2].lower()
            yield ("close" if m[1] else "open"), tag, m[3] or ""
            if not m[1] and tag in RAW:
                end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
                at = end.end() if end else len(page)
                yield "close", tag, ""


def blocks(page: str) -> list[tuple[str, str]]:
    """``(path, text)`` of every block outside furniture, in page order."""
    stack: list[tuple[str, str, bool]] = []  # tag, name, furniture
    out: list[tuple[str, str]] = []
    text: list[str] = []
    hidden = 0

    def flush() -> None:
        value = SPACE.sub(" ", references.unescape("".join(text))).strip()
        text.clear()
        if value:
            out.append(("/".join(n for _, n, _ in stack if n), value))

    def leave(depth: int) -> None:
        nonlocal hidden
        while len(stack) > depth:
            hidden -= stack.pop()[2]

    for kind, tag, value in events(page):
        if kind == "text":
            if not hidden:
                text.append(value)
            continue
        if tag in INLINE and tag != "br":
            if kind == "open" and not hidden and any(NAMES.search(n) for n in names(value)) and tag not in VOID:
                stack.append((tag, "", True))
                hidden += 1
            elif kind == "close" and stack and stack[-1][0] == tag:
                leave(len(stack) - 1)
            continue
        if tag == "br":
            text.append(" " if not hidden else "")
            continue
        if not hidden:
            flush()
        if kind == "close":
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
            if depth is not None:
                leave(depth)
            continue
        ended = CLOSES.get(tag, {"p"} if tag in ENDS_P else set())
        if stack and stack[-1][0] in ended:
            leave(len(stack) - 1)
        if tag in VOID:
            continue
        own = names(value)
        furniture = tag in FURNITURE or tag not in ("html", "body", "article", "main") and any(NAMES.search(n) for n in own)
        name = tag if tag not in ("p", "li", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "dt", "dd", "td", "th", "tr") else ""
        # numbers in a name belong to the page, not to its layout
        stack.append((tag, name + ("." + DIGITS.sub("", own[0].lower()) if name and own else ""), furniture))
        hidden += furniture
    if not hidden:
        flush()
    return out


def names(attributes: str) -> list[str]:
    return [n for m in ATTRIBUTE.finditer(attributes) for n in m[2].strip("\"'").split()] if attributes else []


def article(found: list[tuple[str, str]]) -> str:
    """The deepest path below which most of the text is; within an article or main
    element, that element's."""
    below: Counter[str] = Counter()
    for path, text in found:
        steps = path.split("/")
        for i in range(len(steps) + 1):
            below["/".join(steps[:i])] += len(text)
    total = sum(len(text) for _, text in found)
    steps = max((p for p, n in below.items() if n >= MOST * total), key=lambda p: (p.count("/") + bool(p), p), default="").split("/")
    for kind in ("article", "main"):
        for i in range(len(steps), 0, -1):
            if steps[i - 1].split(".")[0] == kind:
                return "/".join(steps[:i])
    return "/".join(steps)


def slot(path: str, text: str) -> int:
    """Number of a text in its slot."""
    return int.from_bytes(blake2b(f"{path}\0{text}".encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)


def _reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hosts, pages = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("host", "html"))
        for a, b in chunks(pages):
            found = [blocks(p) for p in pages[a:b]]
            r = runs(["\n".join(t for _, t in f) for f in found])
            rows = []
            for host, own, i, j in zip(hosts[a:b], found, r.first[:-1], r.first[1:]):
                if i < j:
                    page = int(shingles(r.hash[i:j], 3).min().astype("int64"))
                    rows.append((host, article(own), None, None, page))
                    rows += [(host, None, *n, page) for n in {(slot(p, t), slot(p, "")) for p, t in own}]
            columns = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()),
                                              *[pa.array(c, pa.int64()) for c in columns[2:]]],
                                             ["host", "path", "slot", "place", "page"])


def wrappers(pages: DataFrame) -> DataFrame:
    """``host, layouts`` (article paths, the most frequent first) and ``shell`` (slots
    with fixed text) of each host. Pages without a host teach nothing."""
    rows = written(pages.select(_host().alias("host"), F.coalesce("html", F.lit("")).alias("html")).where("host <> ''")
                   .mapInArrow(_reduced, "host string, path string, slot long, place long, page long"), "slots")
    own = rows.where("path is not null")
    votes = own.groupBy("host", "path").agg(F.count("*").alias("n"))
    # distinct in two steps, so that no host is one task's
    sizes = (own.groupBy("host", "page").agg(F.count("*").alias("n"))
             .groupBy("host").agg(F.sum("n").alias("pages"), F.count("*").alias("kinds")))
    layouts = (votes.join(sizes, "host").where(F.col("n") >= SHARED * F.col("pages")).groupBy("host")
               .agg(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("n"), "path"))).getField("path").alias("layouts")))
    slots = (rows.where("slot is not null").groupBy("host", "place", "slot", "page").agg(F.lit(1).alias("one"))
             .groupBy("host", "place", "slot").agg(F.count("*").alias("n")))
    slots = slots.join(sizes, "host").withColumn("fixed", (F.col("n") >= FIXED_PAGES) & (F.col("n") >= FIXED * F.col("kinds")))
    places = (slots.groupBy("host", "place").agg(F.sum("n").alias("texts"), F.sum(F.when(F.col("fixed"), F.col("n"))).alias("held"))
              .where(F.col("held") >= SHELL * F.col("texts")).select("host", "place"))
    fixed = (slots.where("fixed").join(places, ["host", "place"])
             .groupBy("host").agg(F.collect_list("slot").alias("shell")))
    return layouts.join(fixed, "host", "left")


def _host():
    return F.lower(F.coalesce(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)", 1), F.lit("")))


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page.

    The text of the page's article path without its host's fixed text. Null html: the
    empty text. Null url or one without a host: nothing is learned from other pages.
    Repeated rows: each is extracted. Empty table: empty result. Other columns are not
    read."""
    ship(pages.sparkSession)
    learned = written(wrappers(pages), "wrappers")
    held = learned.select(F.col("host").alias("known"), "layouts", "shell")
    if learned.count() <= BROADCAST_HOSTS:
        held = F.broadcast(held)
    joined = pages.select("page_id", "url", "html").join(held, _host() == F.col("known"), "left")

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = ["\n".join(_text(blocks(page or ""), layouts or [], set(shell or ())))
                   for page, layouts, shell in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist()
                                                     for c in ("html", "layouts", "shell")))]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(c)) for c in ("page_id", "url")), pa.array(out, pa.string()),
                 pa.array([len(t) for t in out], pa.int64())], ["page_id", "url", "text", "n_chars"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return joined.select("page_id", "url", "html", "layouts", "shell").mapInArrow(
        texts, f"page_id {kind}, url string, text string, n_chars long")


def _text(found: list[tuple[str, str]], layouts: list[str], shell: set[int]) -> list[str]:
    if shell:
        found = [(p, t) for p, t in found if slot(p, t) not in shell]
    total = sum(len(t) for _, t in found)
    for path in layouts:
        kept = _below(found, path)
        if sum(map(len, kept)) >= MOST * total:
            return kept
    return _below(found, article(found))


def _below(found: list[tuple[str, str]], path: str) -> list[str]:
    return [t for p, t in found if not path or p == path or p.startswith(path + "/")]
