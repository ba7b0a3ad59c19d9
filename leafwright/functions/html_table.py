"""HTML tables as rows of cells, on Python's own parser; text in, text out."""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass, field
from html import escape
from html.parser import HTMLParser


@dataclass
class Cell:
    head: bool = False
    colspan: int = 1
    rowspan: int = 1
    text: str = ""
    html: str = ""

    def render(self) -> str:
        tag = "th" if self.head else "td"
        spans = "".join(f' {n}="{v}"' for n, v in (("rowspan", self.rowspan), ("colspan", self.colspan)) if v > 1)
        return f"<{tag}{spans}>{self.html}</{tag}>"


@dataclass
class Table:
    rows: list[list[Cell]] = field(default_factory=list)
    found: bool = False

    def render(self) -> str:
        return "<table>" + "".join("<tr>" + "".join(c.render() for c in r) + "</tr>" for r in self.rows) + "</table>"


#: The largest spans that HTML knows.
MAX_COLSPAN, MAX_ROWSPAN = 1000, 65534


def _span(v: str | None, most: int) -> int:
    try:
        return max(1, min(int(v or 1), most))
    except ValueError:
        return 1


class _Reader(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.table, self.cell = Table(), None

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "table":
            self.table.found = True
        elif tag == "tr":
            self.cell = None
            self.table.rows.append([])
        elif tag in ("td", "th"):
            a = dict(attrs)
            self.cell = Cell(tag == "th", _span(a.get("colspan"), MAX_COLSPAN), _span(a.get("rowspan"), MAX_ROWSPAN))
            if not self.table.rows:
                self.table.rows.append([])
            self.table.rows[-1].append(self.cell)
        elif self.cell is not None and tag not in ("tbody", "thead", "tfoot"):
            self.cell.html += self.get_starttag_text() or ""

    def handle_endtag(self, tag: str) -> None:
        if tag in ("td", "th", "tr", "table"):
            self.cell = None
        elif self.cell is not None:
            self.cell.html += f"</{tag}>"

    def handle_data(self, data: str) -> None:
        if self.cell is not None:
            self.cell.text += data
            self.cell.html += escape(data, quote=False)


def read_table(html: str | None) -> Table:
    r = _Reader()
    r.feed(html or "")
    r.close()
    return r.table


def grid(table: Table) -> list[list[tuple[int, Cell]]]:
    """Per row its cells with their first column, after the columns that cells of earlier rows still take."""
    taken: dict[int, set[int]] = {}
    out = []
    for r, row in enumerate(table.rows):
        col, cells = 0, []
        for c in row:
            while col in taken.get(r, ()):
                col += 1
            cells.append((col, c))
            for down in range(c.rowspan):
                taken.setdefault(r + down, set()).update(range(col, col + c.colspan))
            col += c.colspan
        out.append(cells)
    return out


def total_columns(table: Table) -> int:
    return max((col + c.colspan for row in grid(table) for col, c in row), default=0)


def effective_columns(table: Table) -> list[int]:
    """Per row the last column taken, by its own cells or by cells from above."""
    out = [0] * len(table.rows)
    for r, row in enumerate(grid(table)):
        for col, c in row:
            for down in range(r, min(r + c.rowspan, len(out))):
                out[down] = max(out[down], col + c.colspan)
    return out


def colspan_sum(row: list[Cell]) -> int:
    return sum(c.colspan for c in row)


def _plain(text: str, compat: bool) -> str:
    text = "".join(text.split())
    return unicodedata.normalize("NFKC", text) if compat else text


def header_rows(upper: Table, lower: Table, most: int = 5, compat: bool = True) -> int:
    """How many first rows are equal in cells, spans and text; 0 if there are none."""
    n = 0
    for a, b in zip(upper.rows[:most], lower.rows[:most], strict=False):
        if len(a) != len(b) or any((x.colspan, x.rowspan, _plain(x.text, compat)) != (y.colspan, y.rowspan, _plain(y.text, compat)) for x, y in zip(a, b, strict=True)):
            break
        n += 1
    return n


def _described(row: list[Cell], compat: bool) -> list[str]:
    return [f"rowspan={c.rowspan},colspan={c.colspan}, {unicodedata.normalize('NFKC', c.text.strip()) if compat else c.text.strip()}" for c in row]


def _is_banner(table: Table, r: int) -> bool:
    return len(table.rows[r]) == 1 and table.rows[r][0].colspan >= total_columns(table)


def last_rows(table: Table, most: int = 5) -> list[list[str]]:
    """The last rows from the bottom up, going on while they are one cell over the full width."""
    out: list[list[str]] = []
    for r in range(len(table.rows) - 1, max(-1, len(table.rows) - 1 - most), -1):
        out.insert(0, _described(table.rows[r], False))
        if not _is_banner(table, r):
            break
    return out


def first_rows(table: Table, skip: int, most: int = 5) -> list[list[str]]:
    """The first rows after the header, by the same rule; the last row if the header is all there is."""
    out: list[list[str]] = []
    start = min(skip, len(table.rows) - 1)
    for r in range(max(0, start), min(len(table.rows), start + most)):
        out.append(_described(table.rows[r], True))
        if not _is_banner(table, r):
            break
    return out


def columns_match(upper: Table, lower: Table) -> bool:
    """Equal total columns, or the last row above and the first data row below agree in one way of counting."""
    if total_columns(upper) == total_columns(lower):
        return True
    filled = [i for i, r in enumerate(upper.rows) if r]
    skip = header_rows(upper, lower)
    if not filled or skip >= len(lower.rows):
        return False
    a, b = filled[-1], skip
    return effective_columns(upper)[a] == effective_columns(lower)[b] or colspan_sum(upper.rows[a]) == colspan_sum(lower.rows[b]) or len(upper.rows[a]) == len(lower.rows[b])


def same_structure(a: list[Cell], b: list[Cell]) -> bool:
    return [c.colspan for c in a] == [c.colspan for c in b]


def _widen(rows: list[list[Cell]], like: list[Cell], to: int, missing: int) -> None:
    spans = [c.colspan for c in like]
    for row in rows:
        if not row or colspan_sum(row) >= to:
            continue
        if len(row) == len(spans) and [c.colspan for c in row] == spans:
            for c, s in zip(row, spans, strict=True):
                if s > 1:
                    c.colspan = s
        else:
            row[-1].colspan += missing


def _join_cells(upper: Table, lower_row: list[Cell], flags: list[int]) -> bool:
    """Cells flagged 1 go on below: their text moves up. True if the lower row is left without text."""
    last = grid(upper)[-1]
    top_of = {}
    for r, row in enumerate(grid(upper)):
        for col, c in row:
            if r + c.rowspan > len(upper.rows) - 1:
                top_of.setdefault(col, (c, r))
    cells = [top_of[c] for c in sorted(top_of)] or [(c, len(upper.rows) - 1) for _, c in last]
    drop: list[Cell] = []
    for (above, row), below, flag in zip(cells, list(lower_row), flags, strict=False):
        if flag != 1:
            continue
        above.text += below.text
        above.html += below.html
        if row < len(upper.rows) - 1:
            above.rowspan += below.rowspan
            drop.append(below)
        elif below.rowspan > 1:
            above.rowspan = below.rowspan
            drop.append(below)
        else:
            below.text = below.html = ""
    lower_row[:] = [c for c in lower_row if not any(c is d for d in drop)]
    return all(not c.text.strip() for c in lower_row)


def merge_tables(upper_html: str | None, lower_html: str | None, flags: list[int] | None = None) -> str:
    """The upper table with the lower one's rows below it: repeated header rows go, widths are evened out, cells that
    the page break cut (flag 1) are joined. If either has no rows, the upper one comes back as it was."""
    upper, lower = read_table(upper_html), read_table(lower_html)
    if not (upper.found and lower.found and upper.rows and lower.rows):
        return upper_html or ""
    skip = header_rows(upper, lower, compat=False)
    below = lower.rows[skip:]
    if not below:
        return upper_html or ""
    a, b = total_columns(upper), total_columns(lower)
    if a >= b:
        _widen(below, upper.rows[-1], a, a - b)
    else:
        _widen(upper.rows[skip:], below[0], b, b - a)
    if flags and _join_cells(upper, below[0], flags):
        below = below[1:]
    upper.rows += below
    return upper.render()
