"""What one definition file holds, as rows: small readers that tasks apply to each file's text, in Arrow batches.

A file is read from its first line to its last with what is open at that point, so that no line of it is sent or sorted.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: rows that are sent at once
_ROWS = 20_000
_SPACE = " \t\n\x0b\f\r"


def by_file(files: DataFrame, read: Callable[[str], list[tuple]], schema: str, keys: tuple[str, ...] = ("path",)) -> DataFrame:
    """The keys, which are texts, and the rows that read gives for the content of each file; a file without content has none."""
    made = StructType.fromDDL(", ".join([*(f"{k} string" for k in keys), schema]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = to_arrow_schema(made)
        types = [f.type for f in out]

        def sent(b: pa.RecordBatch, at: list[int], rows: list[tuple]) -> pa.RecordBatch:
            held = [b.column(k).take(pa.array(at, pa.int32())).cast(t) for k, t in enumerate(types[: len(keys)])]
            return pa.RecordBatch.from_arrays([*held, *(pa.array(c, t) for c, t in zip(zip(*rows), types[len(keys) :]))], schema=out)

        for b in batches:
            at, rows = [], []
            for k, text in enumerate(b.column(len(keys))):
                if (text := text.as_py()) and (got := read(text)):
                    rows += got
                    at += [k] * len(got)
                    if len(rows) >= _ROWS:
                        yield sent(b, at, rows)
                        at, rows = [], []
            if rows:
                yield sent(b, at, rows)

    return files.select(*keys, "content").mapInArrow(run, made)


# Paginated reports

_QUIET = re.compile(r"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>|<\?.*?\?>|<![^>]*>")
_TAG = re.compile(r"""(?a)<(/?)(?:[\w.-]+:)?([\w.-]+)((?:[^<>"']|"[^"]*"|'[^']*')*?)(/?)>""")
_NAME = re.compile(r"""(?as)\bName\s*=\s*(["'])(.*?)\1""")
#: fixed values: kinds of items in paginated reports
ITEMS = frozenset(("Chart", "GaugePanel", "Image", "Line", "Map", "Rectangle", "Subreport", "Tablix", "Textbox"))


def elements(text: str) -> list[list]:
    """n (place among all tags), name, attributes (text), level, parent (n of the element around it), last (n of its closing tag, or its own) of every element.

    Comments, declarations and quoted data hold no tags. Attributes may hold any character but their own quote. Prefixes of names are dropped.
    """
    out, opened, level = [], {}, 0
    for n, (shut, name, attributes, alone) in enumerate(_TAG.findall(_QUIET.sub("", text))):
        if shut:
            if (e := opened.get(level)) and e[5] == e[0]:
                e[5] = n
            level -= 1
            continue
        around = opened.get(level)
        e = [n, name, attributes, level + 1, around and around[0], n]
        out.append(e)
        if not alone:
            level += 1
            opened[level] = e
    return out


def report_rows(text: str) -> list[tuple]:
    """section (from 0), part (body, header, footer), type, name, parent (name of the item that holds it) of the items of one report."""
    out, holders, section, ends = [], [], -1, {}
    for n, kind, attributes, _, _, last in elements(text):
        if kind == "ReportSection":
            section += 1
        elif kind in ("PageHeader", "PageFooter", "Body"):
            ends[kind] = last
        elif kind in ITEMS:
            part = next((p for p, k in (("header", "PageHeader"), ("footer", "PageFooter"), ("body", "Body")) if n <= ends.get(k, -1)), None)
            if part is None:
                continue
            while holders and holders[-1][0] < n:
                holders.pop()
            m = _NAME.search(attributes)
            name = m[2] if m else ""
            if "&" in name:
                for code, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")):
                    name = name.replace(code, char)
            out.append((max(section, 0), part, kind, name, holders[-1][1] if holders else None))
            holders.append((last, name))
    return out


# Model outlines

#: fixed values: words that open an object of a model outline
OBJECTS = "annotation|calculationGroup|calculationItem|column|cultureInfo|database|expression|formatStringDefinition|function|hierarchy|level|measure|model|partition|perspective|ref table|relationship|role|table|tablePermission"
#: objects nest this deep at most: table, calculation group, item, its format, annotation
_DEPTH = 5
_S, _W = r"[ \t\n\x0b\f\r]", "[A-Za-z0-9_]"
_BREAK = re.compile(r"\r?\n")
_OPENS = re.compile(rf"={_S}*(?:```)?\Z")
_WORD = re.compile(rf"({OBJECTS})\b(?!{_S}*:)")
_CALLED = re.compile(rf"(?:{OBJECTS}){_S}+('(?:[^']|'')*'|\"[^\"]*\"|[^=]*?){_S}*(?:=|\Z)")
_INLINE = re.compile(rf"(?:{OBJECTS}){_S}+(?:'(?:[^']|'')*'|\"[^\"]*\"|[^=]*?){_S}*={_S}*(.+?){_S}*(?:```)?\Z")
_PAIR = re.compile(rf"([A-Za-z]{_W}*)(?:{_S}*[:=]{_S}*(.*))?")
_QUOTES = re.compile(r"(['\"])(.*)\1\Z")
_FENCE = re.compile(rf"(?m)^\t*```{_S}*$")


def unquoted(text: str) -> str:
    m = _QUOTES.match(text)
    return (m[2] if m else text).replace("''", "'")


def _tabs(raw: str) -> int:
    return len(raw) - len(raw.lstrip("\t"))


def _formula(block: list[str]) -> str | None:
    """A formula's lines without fences, the tabs that all of them share, and blank lines at both ends."""
    lines = _BREAK.split(_FENCE.sub("", "\n".join(block)))
    shared = min((_tabs(x) for x in lines if x.strip(_SPACE)), default=0)
    return "\n".join(x[shared:] if x.strip(_SPACE) else "" for x in lines).strip("\n") or None


def outline_rows(text: str) -> list[tuple]:
    """n (line), kind, name, parent (its n), holder (the parent's name), expression, properties, description of every object of one model outline.

    A line that ends in `=` opens a formula, which goes on while lines are indented two tabs more. Blank lines belong to it when lines of it follow.
    Lines ending in `=` inside a formula open nothing that it doesn't hold already. A formula that a property opens (`source =`) belongs to the property's object.
    """
    last = [(-1, False)] * _DEPTH  # the last full line of at most so many tabs and one, and whether it opens a formula
    open_ = [None] * _DEPTH  # the last object of at most so many tabs
    found, blocks, of, said = {}, {}, {}, []
    for n, raw in enumerate(_BREAK.split(text)):
        line, indent = raw.strip(_SPACE), _tabs(raw)
        if line:
            opens = bool(_OPENS.search(line))
            for d in range(max(indent - 1, 0), _DEPTH):
                last[d] = (n, opens and indent == d)
        block = next((at for at, opens in last if opens and at < n), None)
        if block is not None:
            blocks.setdefault(block, []).append(raw)
            continue
        if not line:
            continue
        above = open_[indent - 1] if 1 <= indent <= _DEPTH else None
        if line.startswith("///"):
            said.append(line[3:].strip(" "))
            continue
        if word := _WORD.match(line):
            name, inline = _CALLED.match(line), _INLINE.match(line)
            found[n] = [word[1], unquoted(name[1].strip(" ")) if name else "", above, (inline[1].strip(" ") if inline else "") or None, {}, "\n".join(said) if said else None]
            said = []
            for d in range(indent, _DEPTH):
                open_[d] = n
        elif above is not None:
            of[n] = above
            if p := _PAIR.match(line):
                found[above][4].setdefault(p[1], "true" if p[2] is None else unquoted(p[2]))
    formulas = {n: _formula(b) for n, b in blocks.items()}
    of_property = {}
    for n, t in formulas.items():
        if n in of and t is not None:
            of_property[of[n]] = min(t, of_property.get(of[n], t))
    return [
        (n, kind, name, up, None if up is None else found[up][1], formulas.get(n) or of_property.get(n) or inline, sorted(pairs.items()) or None, doc) for n, (kind, name, up, inline, pairs, doc) in found.items()
    ]


# Visuals

#: where in a visual a field stands, by what its path holds; the first that fits
_PLACES = [(k, re.compile(p)) for k, p in (("projection", r"\.projections\["), ("sort", r"\.sortDefinition\."), ("container", r"\.visualContainerObjects\."), ("reference_line", r"(?i)referenceLine"), ("filter", r"(?i)\.filter"), ("visual_object", r"\.objects\."))]
_FIELDS = frozenset(("Measure", "Column", "Aggregation", "HierarchyLevel"))


def _at(v, *steps: str) -> str | None:
    """What is found at the end of the steps, as a text; null where there is nothing."""
    for s in steps:
        v = v.get(s) if isinstance(v, dict) else None
    return v if v is None or isinstance(v, str) else json.dumps(v, ensure_ascii=False, separators=(",", ":"))


def _either(first: str | None, second: str | None) -> str | None:
    return second if first is None else first


def field_rows(text: str) -> list[tuple]:
    """kind, entity, property, place: every field used at any depth of one visual, once a place."""
    out, todo = {}, [("$", json.loads(text))]
    while todo:
        at, v = todo.pop()
        if isinstance(v, list):
            todo += [(f"{at}[{k}]", x) for k, x in enumerate(v)]
        elif isinstance(v, dict):
            for key, x in v.items():
                here = f"{at}.{key}"
                todo.append((here, x))
                if key in _FIELDS:
                    entity = _either(_at(x, "Expression", "SourceRef", "Entity"), _at(x, "Expression", "Hierarchy", "Expression", "SourceRef", "Entity"))
                    name = _either(_at(x, "Property"), _at(x, "Level"))
                    if entity is not None and name is not None:
                        out[key, entity, name, next((k for k, p in _PLACES if p.search(here)), "other")] = True
    return list(out)
