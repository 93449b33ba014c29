"""Tables of pages as grids: spans resolved, nested tables apart, one row for each table."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketlake.functions.html import Node, collapse, parse
from docketlake.session import ship

#: What HTML allows a cell to span at most.
MOST_COLUMNS, MOST_ROWS = 1000, 65_534
CELL = "struct<text:string,href:string,link:string,bold:string,head:boolean,own:boolean>"
TABLES = f"array<struct<table:int,id:string,grid:array<array<{CELL}>>>>"


def _inside(node: Node):
    """What stands in a node, in document order, but not in tables below it: elements and texts."""
    stack = list(reversed(node.children))
    while stack:
        item = stack.pop()
        yield item
        if isinstance(item, Node) and item.tag not in ("table", "script", "style"):
            stack += list(reversed(item.children))


def _text(node: Node) -> str:
    return collapse(" ".join(x for x in _inside(node) if isinstance(x, str)))


def _span(cell: Node, name: str, most: int) -> int:
    if name not in cell.attrs:
        return 1
    digits = cell.attrs[name].strip()
    return min(int(digits), most) if digits.isdecimal() and digits.isascii() and len(digits) < 9 else 1


def _cell(node: Node) -> dict:
    """What a cell says: its text, its first link, its first bold text; one pass over what is in it."""
    texts, link, bold = [], None, None
    for x in _inside(node):
        if isinstance(x, str):
            texts.append(x)
        elif x.tag == "a":
            link = link or x
        elif x.tag in ("b", "strong"):
            bold = bold or x
    return {
        "text": collapse(" ".join(texts)), "href": link.attrs.get("href", "") if link else None, "link": _text(link) if link else None,
        "bold": None if bold is None else _text(bold), "head": node.tag == "th", "own": True,
    }


def grid_of(table: Node) -> list[list[dict]]:
    """The table's own rows, each slot with the cell that covers it; ``own`` only where the cell begins.

    A cell goes to the first free slot of its row. A row span of 0 reaches to the end of the row group, others stop there
    too; where cells would overlap, the first stays. Slots that nothing covers are empty cells.
    """
    empty = {"text": "", "href": None, "link": None, "bold": None, "head": False, "own": False}
    groups: list[list[Node]] = []
    for child in table.children:
        if isinstance(child, Node) and child.tag in ("thead", "tbody", "tfoot"):
            groups.append([r for r in child.children if isinstance(r, Node) and r.tag == "tr"])
        elif isinstance(child, Node) and child.tag == "tr":
            if not groups or groups[-1] and groups[-1][0] not in table.children:
                groups.append([])
            groups[-1].append(child)
    grid: list[list[dict]] = []
    for rows in groups:
        covered: list[dict[int, dict]] = [{} for _ in rows]
        for y, row in enumerate(rows):
            x = 0
            for node in (c for c in row.children if isinstance(c, Node) and c.tag in ("td", "th")):
                while x in covered[y]:
                    x += 1
                cell, down, across = _cell(node), _span(node, "rowspan", MOST_ROWS), _span(node, "colspan", MOST_COLUMNS) or 1
                for dy in range(min(down or len(rows), len(rows) - y)):
                    for dx in range(across):
                        covered[y + dy].setdefault(x + dx, cell if not dx and not dy else cell | {"own": False})
        grid += [[slots.get(i, empty) for i in range(max(slots, default=-1) + 1)] for slots in covered]
    return grid


class PageTables:
    """``table, id, grid`` of each table of a page, in document order, nested ones after the one that they are in.

    A page without tables has one row of nulls.
    """

    def eval(self, html: str):
        found = parse(html).all("table")
        for number, table in enumerate(found):
            yield number, table.attrs.get("id"), grid_of(table)
        if not found:
            yield None, None, None


_CELL = pa.struct([("text", pa.string()), ("href", pa.string()), ("link", pa.string()), ("bold", pa.string()), ("head", pa.bool_()), ("own", pa.bool_())])
_TABLES = pa.list_(pa.struct([("table", pa.int32()), ("id", pa.string()), ("grid", pa.list_(pa.list_(_CELL)))]))


def page_tables(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` with a row for each table in their ``html``; a page without tables has one row with nulls.

    Grids go to Spark as Arrow arrays: row by row, each cell would be pickled and unpickled by itself.
    """
    ship(pages.sparkSession)

    @F.arrow_udf(TABLES)
    def tables(htmls: pa.Array) -> pa.Array:
        held = PageTables()
        return pa.array([[dict(zip(("table", "id", "grid"), row)) for row in held.eval(h)] for h in htmls.to_pylist()], _TABLES)

    return pages.select("*", F.inline(tables(F.col(f"`{html}`"))))
