"""Sections, texts, tables and links out of label documents held in a table.

Parsers that need a document tree run as Arrow batches over the documents (one record is one
document); everything a regular expression can say stays in the JVM.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import squeeze
from ..functions.text import SPACE
from ..session import stage
from .joins import null_safe_join
from ..schemas import US_LABEL, US_SECTIONS

# The section codes of a structured product label.
SECTION_CODES = {
    "AR": "34084-4",
    "BW": "34066-1",
    "WP": "43685-7",
    "WA": "34071-1",
    "PR": "42232-9",
    "SP": "43684-0",
    "OV": "34088-5",
}


def _local(tag) -> str:
    return tag.rsplit("}", 1)[-1] if isinstance(tag, str) else ""


def _spl_row(xml: str, codes: dict[str, str]) -> dict:
    """Ids, title and sections of one XML label."""
    import xml.etree.ElementTree as ET

    try:
        root = ET.fromstring(xml)
    except ET.ParseError as e:
        return {"error": str(e)}
    texts: dict[str, list[str]] = {c: [] for c in codes.values()}
    first: dict[str, object] = {}
    for parent in root.iter():
        first.setdefault(_local(parent.tag), parent)
        for child in parent:
            code = child.get("code")
            if _local(child.tag) == "code" and code in texts:
                texts[code].append("".join(parent.itertext()).strip())
    attr = lambda name, key: first[name].get(key) if name in first else None
    title = "".join(first["title"].itertext()).strip() if "title" in first else "UNDEFINED"
    return {
        "set_id": attr("setId", "root"), "label_id": attr("id", "root"),
        "spl_version": attr("versionNumber", "value"), "title": title,
        **{name: " ".join(texts[code]) for name, code in codes.items()},
    }


def spl_sections(docs: DataFrame, codes: dict[str, str] = SECTION_CODES) -> DataFrame:
    """XML labels (``xml``) -> set_id, label_id, version, title and one column per section.

    Documents that are no XML give no row; :func:`spl_rejected` lists them.
    """
    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = (_spl_row(x, codes) for x in batch["xml"])
            yield pd.DataFrame([r for r in rows if "error" not in r], columns=columns)

    columns = ["set_id", "label_id", "spl_version", "title", *codes]
    schema = US_LABEL if list(codes) == US_SECTIONS else ", ".join(f"{c} string" for c in columns)
    return docs.select("xml").where("xml is not null").mapInPandas(parse, schema)


def spl_rejected(docs: DataFrame) -> DataFrame:
    """The documents that :func:`spl_sections` cannot read, with the parser's message."""
    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            errors = [(x, _spl_row(x, {}).get("error")) for x in batch["xml"]]
            yield pd.DataFrame([e for e in errors if e[1]], columns=["xml", "error"])

    return docs.select("xml").where("xml is not null").mapInPandas(check, "xml string, error string")


# --- HTML --------------------------------------------------------------------------------

_BLOCK = {
    "p", "div", "li", "tr", "table", "section", "article", "br", "ul", "ol", "header", "footer",
    "nav", "h1", "h2", "h3", "h4", "h5", "h6", "details", "summary", "title", "td", "th",
}
_VOID = {"br", "img", "hr", "meta", "link", "input", "col", "area", "base", "wbr", "source"}


class _Reader(HTMLParser):
    """Open, close and text events of a page, without scripts and styles. Made once: making a class costs more than a small page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out: list[tuple[str, str, dict]] = []
        self.hidden = 0

    def updatepos(self, i, j):
        return j  # nobody asks for line numbers

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style"):
            self.hidden += 1
        self.out.append(("open", tag, dict(attrs) if attrs else {}))
        if tag in _VOID:
            self.out.append(("close", tag, {}))

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self.hidden = max(0, self.hidden - 1)
        if tag not in _VOID:
            self.out.append(("close", tag, {}))

    def handle_data(self, data):
        if not self.hidden:
            self.out.append(("text", data, {}))


def _events(html: str) -> Iterator[tuple[str, str, dict]]:
    reader = _Reader()
    reader.feed(html)
    reader.close()
    return iter(reader.out)


def _join_text(parts: list[str]) -> str:
    return " ".join("".join(parts).split())


def _text_of(html: str) -> str:
    """The readable text, white space squeezed."""
    parts = []
    for kind, value, _ in _events(html):
        parts.append(value if kind == "text" else " " if value in _BLOCK else "")
    return _join_text(parts)


def _section_by_id(html: str, wanted: str) -> str:
    """Text of the section wrapper below the heading with the wanted id."""
    depth, in_details, found, wrapper, parts = 0, False, False, None, []
    for kind, value, attrs in _events(html):
        if kind == "open":
            depth += value not in _VOID
            if value == "details":
                in_details = True
            elif value == "summary" and in_details and attrs.get("id") == wanted:
                found = True
            elif found and wrapper is None and value == "div" and (
                "sectionWrapper" in (attrs.get("class") or "").split()
            ):
                wrapper = depth
        elif kind == "close":
            if wrapper is not None and value == "div" and depth == wrapper:
                return _join_text(parts)
            depth -= value not in _VOID
            if value == "details" and wrapper is None:
                in_details = found = False
        if wrapper is not None:
            parts.append(value if kind == "text" else " " if value in _BLOCK else "")
    return _join_text(parts)


def _section_between(html: str, start_id: str, marker: str) -> str:
    """Text after the heading with the given id up to the next heading of the same kind."""
    heading = {f"h{i}" for i in range(1, 7)}
    state, parts = "before", []
    for kind, value, attrs in _events(html):
        is_mark = kind == "open" and value in heading and marker in (attrs.get("class") or "").split()
        if state == "before" and is_mark and attrs.get("id") == start_id:
            state = "title"
        elif state == "title" and kind == "close" and value in heading:
            state = "inside"
        elif state == "inside":
            if is_mark:
                return _join_text(parts)
            parts.append(value if kind == "text" else " " if value in _BLOCK else "")
    return ""


PAGES = 64  # pages and texts that are Python strings at a time; a batch stays in Arrow


def _parsed(pages: pa.Array, parse: Callable[[str], str]) -> pa.Array:
    parts = [pa.array([parse(h) if h else "" for h in pages.slice(i, PAGES).to_pylist()], pa.string())
             for i in range(0, len(pages), PAGES)]
    return pa.concat_arrays(parts) if parts else pa.array([], pa.string())


def _per_document(docs: DataFrame, column: str, out: str, parse: Callable[[str], str]) -> DataFrame:
    """One text column computed per document; the other columns stay in the JVM. A null document has a null text."""
    @F.arrow_udf("string")
    def apply(pages: pa.Array) -> pa.Array:
        return _parsed(pages, parse)

    # not deterministic: a later filter on the text must not parse the page again
    text = F.when(F.col(column).isNotNull(), apply.asNondeterministic()(F.col(column)))
    return docs.withColumn(out, text).drop(column)


def section_by_id(pages: DataFrame, section_id: str = "UNDESIRABLE_EFFECTS") -> DataFrame:
    return _per_document(pages, "html", "text", lambda h: _section_by_id(h, section_id))


def section_between(
    pages: DataFrame, start_id: str = "par-11", marker: str = "contents-title"
) -> DataFrame:
    """Section between two headings; '' where the page has no such section."""
    return _per_document(pages, "html", "text", lambda h: _section_between(h, start_id, marker))


def html_text(pages: DataFrame) -> DataFrame:
    return _per_document(pages, "html", "text", _text_of)


# The wanted section runs from its numbered heading to the last heading that follows it.
EU_SECTION = r"(4\.8\. Undesirable|4\.8 Undesirable).+(4\.9 Overdose|4\.9\. Overdose)"


def section_by_regex(texts: DataFrame, pattern: str = EU_SECTION) -> DataFrame:
    """Greedy section match on the squeezed text, symbols dropped; '' without a match."""
    found = F.regexp_extract(squeeze("text"), f"({pattern})", 1)
    return texts.withColumn("text", F.regexp_replace(found, r"(?U)[^\n\p{L}\p{N}_\s.,]", ""))


def _tables_of(html: str) -> list[tuple[int, int, list[str]]]:
    """(table number, row number, cells) with nested tables read on their own."""
    rows, stack, n = [], [], -1
    for kind, value, _ in _events(html):
        if kind == "open":
            if value == "table":
                n += 1
                stack.append({"no": n, "row": None, "cell": None, "k": 0})
            elif stack and value == "tr":
                stack[-1].update(row=[], cell=None)
            elif stack and value in ("td", "th") and stack[-1]["row"] is not None:
                stack[-1]["cell"] = []
            elif stack and stack[-1]["cell"] is not None and value in _BLOCK:
                stack[-1]["cell"].append(" ")
        elif kind == "text":
            for level in stack:
                if level["cell"] is not None:
                    level["cell"].append(value)
        elif stack:
            top = stack[-1]
            if value in ("td", "th") and top["cell"] is not None:
                top["row"].append(_join_text(top["cell"]))
                top["cell"] = None
            elif value == "tr" and top["row"] is not None:
                if top["row"]:
                    rows.append((top["no"], top["k"], top["row"]))
                    top["k"] += 1
                top["row"] = None
            elif value == "table":
                stack.pop()
    return rows


def html_tables(pages: DataFrame, key: str) -> DataFrame:
    """(key, table_no, row_no, cells): non-empty table rows, padded to the widest of the table."""
    schema = f"{key} {pages.schema[key].dataType.simpleString()}, table_no int, row_no int, cells array<string>"

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.string()))
        for batch in batches:
            rows = [(i, *row) for i, h in enumerate(batch.column(1).to_pylist()) if h for row in _tables_of(h)]
            at, *made = [pa.array(v, kind) for v, kind in zip(zip(*rows) if rows else [()] * 4, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), *made], names=[key, "table_no", "row_no", "cells"])

    # written once: both sides of the padding read it, and each would parse all pages
    return pad_rows(stage(pages.select(key, "html").mapInArrow(parse, schema), "cells"), [key, "table_no"])


def pad_rows(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Rows filled with '' up to the widest row of their table."""
    width = cells.groupBy(*keys).agg(F.max(F.size("cells")).alias("_w"))
    return null_safe_join(cells, width, keys).withColumn(
        "cells",
        F.concat("cells", F.array_repeat(F.lit(""), F.col("_w") - F.size("cells"))),
    ).select(*cells.columns)


def page_links(pages: DataFrame, pattern: str, key: str, base: str = "") -> DataFrame:
    """Links whose address matches: (key, link_no, name, href, page_url)."""
    anchor = r"""(?is)<a\b[^>]*?href=["']([^"']*)["'][^>]*>(.*?)</a>"""
    found = F.arrays_zip(
        F.regexp_extract_all("html", F.lit(anchor), F.lit(1)).alias("href"),
        F.regexp_extract_all("html", F.lit(anchor), F.lit(2)).alias("inner"),
    )
    links = pages.select(key, F.posexplode(found).alias("link_no", "_l")).where(
        F.rlike(F.col("_l.href"), F.lit(pattern))
    )
    return links.select(
        key, "link_no", squeeze(F.regexp_replace(F.col("_l.inner"), "<[^>]*>", " ")).alias("name"),
        F.col("_l.href").alias("href"), F.concat(F.lit(base), F.col("_l.href")).alias("page_url"),
    )


def page_count(counter: Column, size: int | None = None) -> Column:
    """Pages named by a counter: "Page 1 of N" directly, "(N)" as N items of ``size`` per page."""
    if size is None:
        return F.try_element_at(F.split(counter, SPACE), F.lit(-1)).try_cast("int")
    n = F.nullif(F.regexp_extract(counter, r"\((\d+)\)", 1), F.lit("")).try_cast("int")
    return F.ceil(n / F.lit(size)).cast("int")


def page_urls(
    indexes: DataFrame, counter: str, first_url: str, size: int | None = None, step: int = 200
) -> DataFrame:
    """One address per index page: ``page=k`` style with a page size, else offset style."""
    n = F.coalesce(page_count(F.col(counter), size), F.lit(0))
    numbers = F.when(n > 0, F.sequence(F.lit(1), n))
    pages = indexes.select("*", F.explode(numbers).alias("page_no"))
    if size is None:
        offset = (F.lit(1) + (F.col("page_no") - 1) * step).cast("string")
        address = F.replace(F.col(first_url), F.lit("offset=1"), F.concat(F.lit("offset="), offset))
    else:
        address = F.concat(F.col(first_url), F.lit("&page="), F.col("page_no").cast("string"))
    return pages.withColumn("page_url", address)


