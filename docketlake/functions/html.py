"""HTML: a small tolerant tree over the standard parser, and what is read out of pages.

Text of an element is its text nodes, stripped, blanks dropped, joined by a separator; script and style do not count.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Opening one of these closes an open element of the given kinds, up to the nearest of the stops.
_CLOSES = {
    "li": (("li",), ("ul", "ol")),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}
_ENDS_PARAGRAPH = frozenset("p div table ul ol h1 h2 h3 h4 h5 h6 section article form pre blockquote header footer nav".split())
_SILENT = frozenset(("script", "style"))

# What table headers say, in lower case.
HEADERS = {
    "date_of_receipt": ("дата поступ", "поступлен", "дата регистрации"),
    "judge": ("судья", "судья-докладчик"),
    "case_number": ("номер дела", "№ дела", "дело"),
    "decision_date": ("дата решения",),
    "solution": ("решение",),
    "entry_into_force_date": ("вступления в законную силу", "законную силу"),
    "judicial_acts_link": ("судебные акты", "судебный акт"),
}
KNOWN_TABLE_IDS = ("tablcont",)
BOUNCED = "Необходимо задать критерии поиска"
#: Labels of the case block.
CASE_LABELS = {
    "уникальный идентификатор дела": "judicial_uid",
    "уникальный идентификатор": "judicial_uid",
    "дата поступления": "date_filed",
    "категория дела": "case_category",
    "судья": "judge",
    "признак рассмотрения дела": "hearing_type",
    "текущий статус": "current_stage",
    "результат": "current_stage",
}
#: Headers of the events table, in the order in which they are tried: (texts contained, texts equal, field).
EVENT_HEADERS = (
    (("наименование события", "мероприятие"), ("событие",), "event_name"),
    (("дата публикации", "дата опубликован", "опубликован"), (), "event_published_date"),
    (("результат", "итог"), (), "event_result"),
    (("основания",), (), "event_basis"),
    (("время",), (), "event_time"),
    (("дата",), (), "event_date"),
)
ROLE_HEADERS = ("вид лица", "роль", "тип участника")
NAME_HEADERS = ("фамилия", "фио", "ф.и.о")
PLAINTIFF_ROLES = ("истец", "заявитель", "plaintiff")
DEFENDANT_ROLES = ("ответчик", "defendant")
DEFAULT_CHARSET = "windows-1251"
LEAST_TEXT = 100


@dataclass
class Node:
    tag: str
    attrs: dict[str, str] = field(default_factory=dict)
    children: list = field(default_factory=list)

    def walk(self):
        """All elements below, in document order."""
        stack = [c for c in reversed(self.children) if isinstance(c, Node)]
        while stack:
            node = stack.pop()
            yield node
            stack += [c for c in reversed(node.children) if isinstance(c, Node)]

    def all(self, *tags: str) -> list[Node]:
        return [n for n in self.walk() if n.tag in tags]

    def first(self, *tags: str, having: str | None = None) -> Node | None:
        return next((n for n in self.walk() if n.tag in tags and (having is None or having in n.attrs)), None)

    def by_id(self, value: str, tag: str | None = None) -> Node | None:
        return next((n for n in self.walk() if n.attrs.get("id") == value and tag in (None, n.tag)), None)

    def strings(self):
        stack: list = list(reversed(self.children))
        while stack:
            item = stack.pop()
            if isinstance(item, str):
                yield item
            elif item.tag not in _SILENT:
                stack += list(reversed(item.children))

    def text(self, separator: str = " ") -> str:
        return separator.join(t for s in self.strings() if (t := s.strip()))


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("")
        self.open = [self.root]

    def _close(self, kinds, stops) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag in stops:
                return
            if self.open[i].tag in kinds:
                lowest = i
                while lowest > 1 and self.open[lowest - 1].tag in kinds:
                    lowest -= 1
                del self.open[lowest:]
                return

    def handle_starttag(self, tag, attrs):
        if tag in _ENDS_PARAGRAPH:
            self._close(("p",), ("table", "div", "td", "th", "span", "article", "section"))
        if tag in _CLOSES:
            self._close(*_CLOSES[tag])
        node = Node(tag, {k: v or "" for k, v in attrs})
        self.open[-1].children.append(node)
        if tag not in _VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.open[-1].children.append(Node(tag, {k: v or "" for k, v in attrs}))

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return

    def handle_data(self, data):
        self.open[-1].children.append(data)


# Most markup is plain: tags with simple attributes, and text. It goes to the builder by these patterns, which take less time than the standard parser.
_TAG = re.compile(r"""<(?:(/)([a-zA-Z][a-zA-Z0-9]*)[ \t\n]*>|([a-zA-Z][a-zA-Z0-9]*)((?:[ \t\n]+[a-zA-Z][-a-zA-Z0-9_]*(?:="[^"<>]*"|=[-a-zA-Z0-9_.:]+(?=[ \t\n>]))?)*)[ \t\n]*>|!--[^<>-]*-->|!(?i:doctype)[^<>]*>)""")
_ATTRIBUTE = re.compile(r"""([a-zA-Z][-a-zA-Z0-9_]*)(?:="([^"]*)"|=([^ \t\n]+))?""")
#: A reference that the standard parser reads differently in attributes than in text.
_LOOSE_REFERENCE = re.compile(r"&(?![a-zA-Z]+;|#[0-9]+;)")
_CODE_END = {tag: re.compile(f"</{tag}[ \\t\\n]*>", re.I) for tag in _SILENT}
#: Elements whose content is no plain markup.
_OWN_CONTENT = frozenset("textarea xmp iframe noembed noframes noscript plaintext math svg".split())


def _parsed_plainly(html: str, builder: _Builder) -> bool:
    """Gives the builder what the standard parser would, or says that the page has other markup than the patterns know."""
    at, find, tag_at, put = 0, html.find, _TAG.match, builder.handle_data
    while (to := find("<", at)) >= 0:
        if to > at:
            text = html[at:to]
            put(unescape(text) if "&" in text else text)
        if not (found := tag_at(html, to)):
            return False
        at = found.end()
        end, closed, opened, said = found.groups()
        if end:
            builder.handle_endtag(closed.lower())
        elif opened:
            tag, attrs = opened.lower(), []
            if tag in _OWN_CONTENT:
                return False
            if said:
                if "&" in said and _LOOSE_REFERENCE.search(said):
                    return False
                for name, quoted, bare in _ATTRIBUTE.findall(said):
                    attrs.append((name.lower(), unescape(quoted) if "&" in quoted else quoted or bare))
            builder.handle_starttag(tag, attrs)
            if tag in _SILENT:
                if not (over := _CODE_END[tag].search(html, at)) or f"</{tag}" in html[at : over.start()].lower() or "<!--" in html[at : over.start()]:
                    return False
                if over.start() > at:
                    put(html[at : over.start()])
                builder.handle_endtag(tag)
                at = over.end()
            elif tag == "title" and html[(end_at := find("<", at)) : end_at + 8].lower() != "</title>":
                return False
    if at < len(html):
        put(unescape(html[at:]))
    return True


def parse(html: str | None) -> Node:
    builder = _Builder()
    if not _parsed_plainly(html or "", builder):
        builder = _Builder()
        builder.feed(html or "")
        builder.close()
    return builder.root


def collapse(text: str) -> str:
    return " ".join(text.split())


def decode_body(body: bytes, content_type: str = "") -> str:
    """H-1: charset of the header, else of a meta tag in the first 2000 bytes, else the default; bad bytes replaced."""
    found = re.search(r"charset=[\"']?([\w-]+)", content_type or "", re.I) or re.search(rb"charset=[\"']?([\w-]+)", body[:2000], re.I)
    name = DEFAULT_CHARSET if found is None else found[1] if isinstance(found[1], str) else found[1].decode("ascii", "replace")
    try:
        return body.decode(name, "replace")
    except LookupError:
        return body.decode(DEFAULT_CHARSET, "replace")


def title_of(html: str | None) -> str | None:
    node = parse(html).first("title")
    return None if node is None else node.text("")


def result_count(html: str | None) -> int | None:
    """H-7: how many results the page says it has."""
    found = re.search(r"найдено\D{0,15}(\d+)", parse(html).text(), re.I)
    return int(found[1]) if found else None


def main_text(html: str | None) -> str | None:
    """H-8, SL-11: a decision's text: the span in the content element, that element, else the longest block of paragraphs."""
    root = parse(html)
    content = root.by_id("content")
    if content is not None:
        for node in (content.first("span"), content):
            if node is not None and len(text := node.text("\n")) > LEAST_TEXT:
                return text
    best = ""
    for node in root.all("span", "div"):
        if sum(isinstance(c, Node) and c.tag == "p" for c in node.children) >= 5 and len(text := node.text("\n")) > len(best):
            best = text
    return best if len(best) > LEAST_TEXT else None


def links_of(html: str | None, base: str) -> list[str]:
    """U-3: absolute addresses of all links."""
    out = []
    for a in parse(html).all("a"):
        if "href" in a.attrs:
            try:
                out.append(urljoin(base or "", a.attrs["href"]))
            except ValueError:
                continue
    return out


def case_number_of(html: str | None) -> str | None:
    """H-11: the case's number: the first text with the word and a number, else the first heading with a number."""
    root = parse(html)
    pattern = re.compile(r"Дело\s*[№N]\s*[\w\-/]+.*", re.I)
    for text in root.strings():
        if found := pattern.search(collapse(text)):
            return collapse(found[0])
    headings = (collapse("".join(h.strings())) for tag in ("h1", "h2", "h3", "h4", "h5") for h in root.all(tag))
    return next((text for text in headings if re.search(r"\d+-\d+/\d{4}", text)), None)


# Columns and tables.


def _text_udf(function):
    @F.pandas_udf("string")
    def apply(htmls: pd.Series) -> pd.Series:
        return htmls.map(function)

    return apply


def page_title(html: Column) -> Column:
    return _text_udf(title_of)(html)


def page_case_number(html: Column) -> Column:
    return _text_udf(case_number_of)(html)


def page_main_text(html: Column) -> Column:
    return _text_udf(main_text)(html)


def page_result_count(html: Column) -> Column:
    @F.pandas_udf("long")
    def count(htmls: pd.Series) -> pd.Series:
        return htmls.map(result_count).astype("Int64")

    return count(html)


def decoded(body: Column, content_type: Column) -> Column:
    """H-1 as a column."""

    @F.pandas_udf("string")
    def decode(bodies: pd.Series, kinds: pd.Series) -> pd.Series:
        return pd.Series([None if b is None else decode_body(bytes(b), k or "") for b, k in zip(bodies, kinds, strict=True)], dtype=object)

    return decode(body, content_type)


def page_links(html: Column, base: Column) -> Column:
    @F.pandas_udf("array<string>")
    def links(htmls: pd.Series, bases: pd.Series) -> pd.Series:
        return pd.Series([links_of(h, b) for h, b in zip(htmls, bases, strict=True)], dtype=object)

    return links(html, base)


def fetch_outcome(html: Column, text: Column) -> Column:
    """H-9, H-10, PF-16: what came of a fetched page; null if it has a text."""
    return F.when(html.isNull(), "fetch_failed").when(F.contains(html, F.lit(BOUNCED)), "bounced_to_search_form").when(text.isNull(), "no_text_found")
