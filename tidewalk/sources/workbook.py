"""Excel workbooks by the standard library: sheets are read, changed and written; the rest of the file stays as it was.

A workbook is a zip of XML parts.  Only the sheets that a caller asks for are parsed;
on saving, those are written anew with inline strings, and every other part, foreign
sheets, styles and shared strings included, is copied byte for byte.
"""

from __future__ import annotations

import datetime
import io
import os
import re
import zipfile
from dataclasses import dataclass, field
from pathlib import Path
from xml.etree import ElementTree as ET
from xml.sax.saxutils import escape, quoteattr

# Fixed values of the file format.
MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PACKAGE_REL = "http://schemas.openxmlformats.org/package/2006/relationships"
TYPES = "http://schemas.openxmlformats.org/package/2006/content-types"
SHEET_TYPE = "application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"
DATE_FORMATS = frozenset([*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)])
BOLD = 1

_EMPTY = {
    "[Content_Types].xml": f'<?xml version="1.0" encoding="UTF-8" standalone="yes"?><Types xmlns="{TYPES}"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/styles.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.styles+xml"/></Types>',
    "_rels/.rels": f'<?xml version="1.0" encoding="UTF-8" standalone="yes"?><Relationships xmlns="{PACKAGE_REL}"><Relationship Id="rId1" Type="{REL}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
    "xl/workbook.xml": f'<?xml version="1.0" encoding="UTF-8" standalone="yes"?><workbook xmlns="{MAIN}" xmlns:r="{REL}"><sheets></sheets></workbook>',
    "xl/_rels/workbook.xml.rels": f'<?xml version="1.0" encoding="UTF-8" standalone="yes"?><Relationships xmlns="{PACKAGE_REL}"><Relationship Id="rId1" Type="{REL}/styles" Target="styles.xml"/></Relationships>',
    "xl/styles.xml": f'<?xml version="1.0" encoding="UTF-8" standalone="yes"?><styleSheet xmlns="{MAIN}"><fonts count="2"><font><sz val="11"/><name val="Calibri"/></font><font><b/><sz val="11"/><name val="Calibri"/></font></fonts><fills count="2"><fill><patternFill patternType="none"/></fill><fill><patternFill patternType="gray125"/></fill></fills><borders count="1"><border><left/><right/><top/><bottom/><diagonal/></border></borders><cellStyleXfs count="1"><xf numFmtId="0" fontId="0" fillId="0" borderId="0"/></cellStyleXfs><cellXfs count="2"><xf numFmtId="0" fontId="0" fillId="0" borderId="0" xfId="0"/><xf numFmtId="0" fontId="1" fillId="0" borderId="0" xfId="0" applyFont="1"/></cellXfs></styleSheet>',
}


@dataclass
class Cell:
    """A value with the style it is shown in; ``number`` is what a date is stored as."""

    value: object = None
    style: int | None = None
    number: str | None = None


@dataclass
class Sheet:
    name: str
    rows: list[list[Cell]] = field(default_factory=list)
    width: int | None = None

    def values(self) -> list[list[object]]:
        return [[c.value for c in row] for row in self.rows]


def _letters(k: int) -> str:
    out = ""
    while k >= 0:
        out, k = chr(65 + k % 26) + out, k // 26 - 1
    return out


def _column(reference: str) -> int:
    k = 0
    for c in re.match(r"[A-Z]+", reference)[0]:
        k = k * 26 + ord(c) - 64
    return k - 1


class Workbook:
    def __init__(self, parts: dict[str, bytes] | None = None) -> None:
        self.parts = {k: v.encode() for k, v in _EMPTY.items()} if parts is None else parts
        self.sheets: dict[str, Sheet] = {}
        self.places = self._places()
        self.added: list[str] = []

    @classmethod
    def load(cls, path: str | Path) -> Workbook:
        with zipfile.ZipFile(path) as z:
            return cls({n: z.read(n) for n in z.namelist()})

    def _places(self) -> dict[str, str]:
        rels = {r.get("Id"): r.get("Target") for r in ET.fromstring(self.parts["xl/_rels/workbook.xml.rels"])}
        out = {}
        for s in ET.fromstring(self.parts["xl/workbook.xml"]).iter(f"{{{MAIN}}}sheet"):
            target = rels[s.get(f"{{{REL}}}id")]
            out[s.get("name")] = target.lstrip("/") if target.startswith("/") else f"xl/{target}"
        return out

    @property
    def names(self) -> list[str]:
        return [*self.places, *self.added]

    def _date_styles(self) -> set[int]:
        if "xl/styles.xml" not in self.parts:
            return set()
        root = ET.fromstring(self.parts["xl/styles.xml"])
        own = {int(f.get("numFmtId")) for f in root.iter(f"{{{MAIN}}}numFmt") if re.search(r"[ymdhs]", re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", f.get("formatCode", "")), re.I)}
        formats = root.find(f"{{{MAIN}}}cellXfs")
        return {k for k, x in enumerate(formats if formats is not None else []) if int(x.get("numFmtId", "0")) in DATE_FORMATS | own}

    def _shared(self) -> list[str]:
        if "xl/sharedStrings.xml" not in self.parts:
            return []
        return ["".join(t.text or "" for t in si.iter(f"{{{MAIN}}}t")) for si in ET.fromstring(self.parts["xl/sharedStrings.xml"])]

    def sheet(self, name: str) -> Sheet:
        """The sheet, parsed when first asked for; what is asked for is written anew on saving."""
        if name in self.sheets:
            return self.sheets[name]
        shared, dates, out = self._shared(), self._date_styles(), Sheet(name)
        for row in ET.fromstring(self.parts[self.places[name]]).iter(f"{{{MAIN}}}row"):
            at = int(row.get("r", len(out.rows) + 1))
            while len(out.rows) < at - 1:
                out.rows.append([])
            cells: list[Cell] = []
            for c in row.iter(f"{{{MAIN}}}c"):
                k = _column(c.get("r")) if c.get("r") else len(cells)
                while len(cells) < k:
                    cells.append(Cell())
                cells.append(self._cell(c, shared, dates))
            out.rows.append(cells)
        self.sheets[name] = out
        return out

    @staticmethod
    def _cell(c: ET.Element, shared: list[str], dates: set[int]) -> Cell:
        style = int(c.get("s")) if c.get("s") else None
        kind, raw = c.get("t", "n"), c.findtext(f"{{{MAIN}}}v")
        if kind == "inlineStr":
            return Cell("".join(t.text or "" for t in c.iter(f"{{{MAIN}}}t")), style)
        if raw is None:
            return Cell(None, style)
        if kind == "s":
            return Cell(shared[int(raw)], style)
        if kind in ("str", "e"):
            return Cell(raw, style)
        if kind == "b":
            return Cell(raw == "1", style)
        if kind == "d":
            return Cell(datetime.datetime.fromisoformat(raw), style)
        number = float(raw)
        if style in dates:
            return Cell(datetime.datetime(1899, 12, 30) + datetime.timedelta(days=number), style, raw)
        return Cell(int(number) if number.is_integer() else number, style)

    def add_sheet(self, name: str, headers: list[str], width: int) -> None:
        """A sheet with bold headers, if there is none of this name."""
        if name not in self.names:
            self.added.append(name)
            bold = BOLD if self.parts["xl/styles.xml"] == _EMPTY["xl/styles.xml"].encode() else None
            self.sheets[name] = Sheet(name, [[Cell(h, bold) for h in headers]], width)

    @staticmethod
    def _written(sheet: Sheet) -> bytes:
        out = io.StringIO()
        out.write(f'<?xml version="1.0" encoding="UTF-8" standalone="yes"?><worksheet xmlns="{MAIN}">')
        wide = max(map(len, sheet.rows), default=0)
        if sheet.width and wide:
            out.write(f'<cols><col min="1" max="{wide}" width="{sheet.width}" customWidth="1"/></cols>')
        out.write("<sheetData>")
        for r, row in enumerate(sheet.rows, 1):
            out.write(f'<row r="{r}">')
            for k, cell in enumerate(row):
                style = f' s="{cell.style}"' if cell.style is not None else ""
                at, v = f'<c r="{_letters(k)}{r}"{style}', cell.value
                if cell.number is not None:
                    out.write(f"{at}><v>{cell.number}</v></c>")
                elif v is None:
                    out.write(f"{at}/>" if style else "")
                elif isinstance(v, bool):
                    out.write(f'{at} t="b"><v>{int(v)}</v></c>')
                elif isinstance(v, int | float):
                    out.write(f"{at}><v>{v!r}</v></c>")
                else:
                    text = v.strftime("%Y-%m-%d") if isinstance(v, datetime.date) else str(v)
                    text = re.sub(r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "", text)
                    out.write(f'{at} t="inlineStr"><is><t xml:space="preserve">{escape(text)}</t></is></c>')
            out.write("</row>")
        out.write("</sheetData></worksheet>")
        return out.getvalue().encode()

    def save(self, path: str | Path) -> None:
        """Write beside ``path`` and move there."""
        parts = dict(self.parts)
        for name in self.places.keys() & self.sheets.keys():
            sheet, part = self.sheets[name], self.places[name]
            old = parts[part].decode("utf-8")
            cols = re.search(r"<cols>.*?</cols>", old, re.S)
            new = self._written(sheet).decode()
            parts[part] = (new.replace("<sheetData>", cols[0] + "<sheetData>", 1) if cols and not sheet.width else new).encode()
        for name in self.added:
            taken = [int(m[1]) for p in parts if (m := re.match(r"xl/worksheets/sheet(\d+)\.xml$", p))]
            k = max(taken, default=0) + 1
            parts[f"xl/worksheets/sheet{k}.xml"] = self._written(self.sheets[name])
            rels, book = parts["xl/_rels/workbook.xml.rels"].decode(), parts["xl/workbook.xml"].decode()
            rid = "rId" + str(max([int(x) for x in re.findall(r'Id="rId(\d+)"', rels)], default=0) + 1)
            number = max([int(x) for x in re.findall(r'sheetId="(\d+)"', book)], default=0) + 1
            entry = f'<sheet xmlns:r="{REL}" name={quoteattr(name)} sheetId="{number}" r:id="{rid}"/>'
            book = re.sub(r"<((?:\w+:)?)sheets\s*/>", r"<\1sheets></\1sheets>", book)
            prefix = re.search(r"</((?:\w+:)?)sheets>", book)[1]
            parts["xl/workbook.xml"] = book.replace(f"</{prefix}sheets>", entry.replace("<sheet ", f"<{prefix}sheet ") + f"</{prefix}sheets>").encode()
            parts["xl/_rels/workbook.xml.rels"] = rels.replace("</Relationships>", f'<Relationship Id="{rid}" Type="{REL}/worksheet" Target="worksheets/sheet{k}.xml"/></Relationships>').encode()
            types = parts["[Content_Types].xml"].decode()
            parts["[Content_Types].xml"] = types.replace("</Types>", f'<Override PartName="/xl/worksheets/sheet{k}.xml" ContentType="{SHEET_TYPE}"/></Types>').encode()
        path = Path(path)
        path.parent.mkdir(parents=True, exist_ok=True)
        draft = path.with_name(path.name + ".tmp")
        with zipfile.ZipFile(draft, "w", zipfile.ZIP_DEFLATED) as z:
            for name, data in parts.items():
                z.writestr(name, data)
        os.replace(draft, path)
