"""Filings to flat rows: one small tolerant reader of markup, run by mapInPandas. No business rules live here.

Well-formed markup, and bare ampersands or control characters after sanitize_markup, are read as they are; what is
broken beyond that gives fewer rows, or a row with an error, but never a failed job (unless on_error is "raise").
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser
from xml.etree.ElementTree import Element, TreeBuilder
from xml.parsers import expat

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filingloom.functions import sanitize_markup
from filingloom.sources import spread

EVENTS = "rcept_no string, seq int, kind string, section_id string, text string, error string"
CELL = "struct<row:int,at:int,tag:string,text:string,acode:string,aunit:string,aunitvalue:string,rowspan:string,colspan:string>"
BLOCKS = f"rcept_no string, block_no int, type string, tag string, level int, text string, section_path array<string>, aclass string, n_cols int, cells array<{CELL}>, error string"

#: Arrow's types of the columns above, and the members of a cell in order.
ARROW = {"string": pa.string(), "int": pa.int32(), "array<string>": pa.list_(pa.string())}
CELL_FIELDS = [pa.field(n, ARROW[t]) for n, t in (part.split(":") for part in CELL[7:-1].split(","))]
#: Rows, or cells of tables, after which a batch of results is given back.
BATCH_ROWS, BATCH_CELLS = 20_000, 60_000

# Elements of filings, and those of HTML that never have an end.
SECTIONS = {"library": 1, "cover": 1, "section-1": 1, "section-2": 2, "section-3": 3, "section-4": 4, "body": 0}
CELLS = ("td", "th", "te", "tu")
VOID = {"br", "hr", "img", "input", "meta", "link", "col", "area", "base", "embed", "source", "track", "wbr"}


class Node:
    """An element as the tolerant reader finds it, texts among its kids. What blocks are made from, it offers as the elements in C do."""

    __slots__ = ("attrs", "kids", "tag")

    def __init__(self, tag: str, attrs: dict):
        self.tag, self.attrs, self.kids = tag, attrs, []

    def walk(self) -> Iterator[Node | str]:
        """Descendants and texts in document order, without recursion."""
        stack = [iter(self.kids)]
        while stack:
            for kid in stack[-1]:
                yield kid
                if isinstance(kid, Node):
                    stack.append(iter(kid.kids))
                    break
            else:
                stack.pop()

    def get(self, name: str, default: str | None = None) -> str | None:
        return self.attrs.get(name, default)

    def keys(self) -> list[str]:
        return list(self.attrs)

    def __iter__(self) -> Iterator[Node]:
        return (n for n in self.kids if n.__class__ is Node)

    def iter(self, tag: str | None = None) -> Iterator[Node]:
        stack = [self]
        while stack:
            n = stack.pop()
            if tag is None or n.tag == tag:
                yield n
            stack += [k for k in n.kids[::-1] if k.__class__ is Node]

    def find(self, tag: str) -> Node | None:
        return next((n for n in self if n.tag == tag), None)

    def itertext(self) -> Iterator[str]:
        return iter(self.texts())

    def texts(self) -> list[str]:
        if len(self.kids) == 1 and self.kids[0].__class__ is not Node:
            return self.kids[:]
        out, stack = [], self.kids[::-1]
        while stack:
            n = stack.pop()
            if n.__class__ is Node:
                stack += n.kids[::-1]
            else:
                out.append(n)
        return out


def whole(n: Node | Element) -> str:
    """All text of an element."""
    return n.text or "" if n.__class__ is Element and not len(n) else "".join(n.itertext())


def first(n: Node | Element, tag: str) -> Node | Element | None:
    """The first element of that name below n."""
    return next((k for k in n.iter(tag) if k is not n), None)


def below(n: Node | Element, tag: str) -> list:
    found = list(n.iter(tag))
    return found[1:] if n.tag == tag else found


class Reader(HTMLParser):
    CDATA_CONTENT_ELEMENTS: tuple = ()
    RCDATA_CONTENT_ELEMENTS: tuple = ()

    def __init__(self, html: bool):
        super().__init__(convert_charrefs=True)
        self.root = Node("", {})
        self.open, self.html = [self.root], html
        if html:
            self.CDATA_CONTENT_ELEMENTS = ("script", "style")

    def handle_starttag(self, tag: str, attrs: list) -> None:
        node = Node(tag, {k: v or "" for k, v in attrs})
        self.open[-1].kids.append(node)
        if not (self.html and tag in VOID):
            self.open.append(node)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.open[-1].kids.append(Node(tag, {k: v or "" for k, v in attrs}))

    def handle_endtag(self, tag: str) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return

    def handle_data(self, data: str) -> None:
        self.open[-1].kids.append(data)

    def unknown_decl(self, data: str) -> None:
        if data.startswith("CDATA["):
            self.open[-1].kids.append(data[6:])


class Odd(Exception):
    """Markup that the tolerant reader may read in another way."""


#: Characters that aren't read alike by both readers, and breaks within tags.
UNLIKE, BROKEN = re.compile(r"[\r\x00-\x08\x0b\x0c\x0e-\x1f]"), re.compile(r"<[^<>]*[\n\t]")
#: What the tolerant reader takes for a reference, and references that both readers know.
REFERENCE = re.compile(r"&([^\t\n\f <&#;]{1,32};?)?")
KNOWN = {"&amp;", "&lt;", "&gt;", "&quot;", "&apos;"}
#: Elements whose contents HTML reads in a way of its own.
RAW = VOID | {"script", "style"}


def unlike(markup: str) -> bool:
    """Whether markup has what both readers read in ways of their own: declarations, comments, numbered characters, and more."""
    if "<!" in markup or "&#" in markup or markup.find("<?", 1) >= 0 or UNLIKE.search(markup):
        return True
    return ("\n" in markup or "\t" in markup) and BROKEN.search(markup) is not None


def bare(found: re.Match) -> str:
    """An ampersand that begins no reference, escaped."""
    text = found[0]
    if text in KNOWN:
        return text
    if references.unescape(text) != text:
        raise Odd
    return f"&amp;{text[1:]}"


def parsed(markup: str, html: bool) -> Element | None:
    """The tree of plain well-formed markup, bare ampersands let pass, by the parser and the builder in C; None for all else."""
    if unlike(markup):
        return None
    if "&" in markup:
        try:
            markup = REFERENCE.sub(bare, markup)
        except Odd:
            return None
    builder, parser = TreeBuilder(), expat.ParserCreate("utf-8")
    parser.buffer_text, parser.buffer_size = True, 4 * len(markup) + 1  # texts come whole
    parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = builder.start, builder.end, builder.data
    try:
        parser.Parse(markup, True)
    except (expat.ExpatError, ValueError, OverflowError):
        return None
    root, names = Element(""), {}
    root.append(builder.close())
    for n in root[0].iter():
        name = names.get(n.tag)
        if name is None:
            name = names[n.tag] = n.tag.lower()
            if not "a" <= name[0] <= "z" or html and name in RAW:
                return None
        n.tag = name
        if n.keys():
            n.attrib = {k.lower(): v for k, v in n.items()}
    return root


def well_formed(markup: str, html: bool) -> Node | None:
    """As parsed, with texts among the kids."""
    root = parsed(markup, html)
    if root is None:
        return None
    out = Node("", {})
    stack = [(root, out)]
    while stack:
        n, made = stack.pop()
        if n.text:
            made.kids.append(n.text)
        for k in n:
            kid = Node(k.tag, k.attrib)
            made.kids.append(kid)
            stack.append((k, kid))
            if k.tail:
                made.kids.append(k.tail)
    return out


def tolerant(markup: str, html: bool) -> Node:
    reader = Reader(html)
    reader.feed(markup)
    reader.close()
    return reader.root


def tree(markup: str, html: bool = False) -> Node:
    """The tolerant reader's tree. Well-formed markup, which most is, goes through a faster parser that makes the same tree."""
    root = well_formed(markup, html)
    return tolerant(markup, html) if root is None else root


def elements(markup: str, html: bool = False) -> Node | Element:
    """As tree, where kids that are texts aren't asked for one by one: then the elements in C serve as they are."""
    root = parsed(markup, html)
    return tolerant(markup, html) if root is None else root


DECLARED = re.compile(rb"""(?:encoding|charset)\s*=\s*["']?([A-Za-z0-9._-]+)""")


def declared_text(contents: Column) -> Column:
    """Bytes in the encoding that their head declares; null where there is none, or where it doesn't fit."""

    def text(raw: bytes | None) -> str | None:
        named = DECLARED.search(raw[:300]) if raw is not None else None
        try:
            return raw.decode(named[1].decode()) if named else None
        except (LookupError, ValueError):
            return None

    def texts(rows: pd.Series) -> pd.Series:
        return pd.Series([text(raw) for raw in rows], dtype=object)

    return F.pandas_udf(texts, "string")(contents)


def decoded(filings: DataFrame, sanitize: bool = False) -> DataFrame:
    """rcept_no and markup: text columns pass as they are. Bytes are UTF-8, with or without a mark; what isn't valid UTF-8 is
    read in the encoding that its head declares, or else with bad bytes replaced."""
    if "markup" in filings.columns:
        text = F.coalesce("markup", F.lit(""))
    else:
        raw = F.col("content").cast("string")
        text = F.when(F.is_valid_utf8(raw), raw).otherwise(F.coalesce(declared_text(F.when(~F.is_valid_utf8(raw), F.col("content"))), F.make_valid_utf8(raw)))
        text = F.regexp_replace(F.coalesce(text, F.lit("")), "^\ufeff", "")
    return filings.select("rcept_no", (sanitize_markup(text) if sanitize else text).alias("markup"))


def cell_lists(tables: list[list[tuple] | None]) -> pa.Array:
    """The cells of every block, null where it has none."""
    offsets, cells = [], []
    for some in tables:
        offsets.append(None if some is None else len(cells))
        cells += some or ()
    columns = zip(*cells) if cells else [[]] * len(CELL_FIELDS)
    members = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, CELL_FIELDS)], fields=CELL_FIELDS)
    return pa.ListArray.from_arrays(pa.array([*offsets, len(cells)], pa.int32()), members)


def per_filing(filings: DataFrame, rows: Callable[[str], list[tuple]], schema: str, on_error: str, dealt: bool) -> DataFrame:
    """rows(markup) of every filing, after its key; an exception becomes one row with an error, or fails the job.

    Filings are small in bytes but dear to parse, so they are dealt to all cores, unless the caller has done that.
    """
    kinds = dict(part.strip().split(" ") for part in schema.replace(CELL, "cell").split(","))
    at = list(kinds).index("cells") if "cells" in kinds else None

    def batch(out: list[tuple]) -> pa.RecordBatch:
        columns = zip(*out) if out else [[]] * len(kinds)
        return pa.RecordBatch.from_arrays([cell_lists(c) if k == "array<cell>" else pa.array(c, ARROW[k]) for c, k in zip(columns, kinds.values())], list(kinds))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out, cells = [], 0
            for key, markup in zip(b.column("rcept_no"), b.column("markup")):
                key = key.as_py()
                try:
                    made = [(key, *r, None) for r in rows(markup.as_py())]
                except Exception as e:
                    if on_error == "raise":
                        raise
                    made = [(key, *[None] * (len(kinds) - 2), f"{type(e).__name__}: {e}")]
                out += made
                cells += sum(len(r[at] or ()) for r in made) if at else 0
                if len(out) >= BATCH_ROWS or cells >= BATCH_CELLS:
                    yield batch(out)
                    out, cells = [], 0
            yield batch(out)

    return filings.mapInArrow(read, schema) if dealt else spread(filings, "rcept_no").mapInArrow(read, schema)


def markup_events(filings: DataFrame, on_error: str = "warn", sanitize: bool = False, dealt: bool = False) -> DataFrame:
    """Text nodes and contents titles in order: kind name, company (once each), title (with its id), text."""

    def rows(markup: str) -> list[tuple]:
        root, out = tree(markup), []
        for kind, tag in (("name", "document-name"), ("company", "company-name")):
            if (node := first(root, tag)) is not None:
                out.append((len(out), kind, None, "".join(t.strip() for t in node.texts())))
        for n in root.walk():
            if isinstance(n, str):
                if n.strip():
                    out.append((len(out), "text", None, n.strip()))
            elif n.tag == "title" and n.attrs.get("atoc") == "Y":
                out.append((len(out), "title", n.attrs.get("aassocnote", ""), "".join(t.strip() for t in n.texts())))
        return out

    return per_filing(decoded(filings, sanitize), rows, EVENTS, on_error, dealt)


#: Attributes of a cell that has none.
PLAIN = (None,) * 5


def cells_of(table: Node | Element) -> tuple[int, list[tuple]]:
    """Columns that COLGROUP names, and the cells (as CELL) of all rows, inner tables' rows included."""
    cells = []
    for r, tr in enumerate(below(table, "tr")):
        for at, c in enumerate(k for k in tr if k.tag in CELLS):
            get = c.get
            cells.append((r, at, c.tag.upper(), whole(c), *((get("acode"), get("aunit"), get("aunitvalue"), get("rowspan"), get("colspan")) if c.keys() else PLAIN)))
    group = first(table, "colgroup")
    return sum(k.tag == "col" for k in group) if group is not None else 0, cells


def header_rows(root: Node | Element) -> list[tuple]:
    """Name, code, version and company of a document, and its summary items, as blocks."""
    out = []
    for tag, code in (("document-name", "acode"), ("formula-version", "adate"), ("company-name", "aregcik")):
        if (n := first(root, tag)) is not None:
            out.append(("header", tag, None, whole(n), [], n.get(code), None, None))
    if (s := first(root, "summary")) is not None:
        out += [("summary", e.get("acode"), None, whole(e), [], e.get("afeature"), None, None) for e in s if e.tag == "extraction"]
    return out


def pipeline_blocks(root: Node | Element) -> list[tuple]:
    out = header_rows(root)
    document = root.find("document")
    body = (root if document is None else document).find("body")
    stack = [(iter(body if body is not None else []), [], 1)]
    while stack:
        kids, path, level = stack[-1]
        n = next(kids, None)
        if n is None:
            stack.pop()
        elif n.tag in ("pgbrk", "title"):
            continue
        elif n.tag in SECTIONS:
            title = n.find("title")
            name = whole(title) if title is not None else None
            out.append(("section", n.tag.upper(), level, name, path, title.get("aassocnote") if title is not None else None, None, None))
            stack.append((iter(n), path + ([name] if name and name.strip() else []), level + bool(name and name.strip())))
        elif n.tag in ("table", "table-group"):
            for t in [n] if n.tag == "table" else [k for k in n if k.tag == "table"]:
                out.append(("table", "TABLE", level, None, path, n.get("aclass") if n.tag == "table-group" else None, *cells_of(t)))
        else:
            out.append(("paragraph", n.tag.upper(), level, whole(n), path, None, None, None))
    return out


def periodic_blocks(root: Node | Element) -> list[tuple]:
    out, body = header_rows(root), first(root, "body")
    opened: list[tuple[int, str]] = []
    stack = [iter(body if body is not None else [])]
    while stack:
        n = next(stack[-1], None)
        if n is None:
            stack.pop()
        elif n.tag == "title":
            continue
        elif n.tag.startswith("section-"):
            level, title = SECTIONS.get(n.tag, 9), n.find("title")
            opened = [o for o in opened if o[0] < level] + [(level, " ".join(whole(title).split()) if title is not None else "")]
            stack.append(iter(n))
        elif n.tag in ("table", "p"):
            path = [t for _, t in opened if t]
            out.append(("table", "TABLE", None, None, path, None, *cells_of(n)) if n.tag == "table" else ("text", "P", None, whole(n), path, None, None, None))
        else:
            stack.append(iter(n))
    return out


def exchange_blocks(root: Node | Element) -> list[tuple]:
    """The title (or what is classed as one) and every table, inner ones too; a cell's texts joined by spaces."""
    title = first(root, "title")
    if title is None:
        title = next((n for n in root.iter() if "xforms_title" in n.get("class", "").split()), None)
    joined = lambda n: " ".join(t for t in map(str.strip, n.itertext()) if t)
    out = [("title", "TITLE", None, joined(title) if title is not None else "", [], None, None, None)]
    for t in below(root, "table"):
        cells = [(r, at, c.tag.upper(), joined(c), None, None, None, c.get("rowspan"), c.get("colspan")) for r, tr in enumerate(below(t, "tr")) for at, c in enumerate(k for k in tr.iter() if k.tag in ("td", "th"))]
        out.append(("table", "TABLE", None, None, [], None, 0, cells))
    return out


WALKERS = {"pipeline": pipeline_blocks, "periodic": periodic_blocks, "exchange": exchange_blocks}


def filing_blocks(filings: DataFrame, style: str, on_error: str = "warn", sanitize: bool = False, dealt: bool = False) -> DataFrame:
    """Blocks of every filing in order, tables with their cells; style: pipeline, periodic or exchange.

    sanitize escapes bare ampersands and drops control characters first (the pipeline's way); dealt: the filings already lie
    in as many partitions as they should be parsed in.
    """
    walker, html = WALKERS[style], style == "exchange"

    def rows(markup: str) -> list[tuple]:
        return [(i, *b) for i, b in enumerate(walker(elements(markup, html)))]

    return per_filing(decoded(filings, sanitize), rows, BLOCKS, on_error, dealt)
