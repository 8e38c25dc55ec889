"""Format texts of numbers compiled to expressions."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: values are decimals with so many places before they are rounded
PLACES = 6


@dataclass(frozen=True)
class Section:
    """One section of a format: what stands before and behind the number, and how the number is written."""

    before: str
    behind: str
    digits: bool  # whether it has a number at all
    whole: int  # digits before the point at least
    fixed: int  # decimals at least
    places: int  # decimals at most
    grouped: bool
    hundredfold: int  # percent signs


def sections(text: str) -> list[str]:
    """The parts of a format between semicolons; quoted and escaped ones divide nothing."""
    out, at = [""], 0
    for m in re.finditer(r'"[^"]*"|\\.|;', text):
        out[-1] += text[at : m.start()]
        at = m.end()
        if m.group() == ";":
            out.append("")
        else:
            out[-1] += m.group()
    out[-1] += text[at:]
    return out


def section(text: str) -> Section:
    """0 is a digit, # a digit where there is one, a comma between digits groups thousands, % takes the value a hundredfold; all else stands for itself."""
    parts = re.findall(r'"[^"]*"|\\.|[0#][0#,]*(?:\.[0#]*)?|\.[0#]+|.', text)
    before, behind, number, percent = "", "", "", 0
    for p in parts:
        if re.match(r"[0#]|\.[0#]", p) and not number:
            number = p
            continue
        percent += p == "%"
        shown = p[1:-1] if p[0] == '"' else p[1:] if p[0] == "\\" and len(p) > 1 else p
        if number:
            behind += shown
        else:
            before += shown
    whole, _, decimals = number.partition(".")
    return Section(before, behind, bool(number), whole.replace(",", "").count("0"), len(decimals.rstrip("#")), len(decimals), "," in whole, percent)


def _number(v: Column, s: Section) -> Column:
    """v, not negative, written as the section says."""
    if not s.digits:
        return F.concat(F.lit(s.before), F.lit(s.behind))
    text = F.format_number(v, s.places)
    if not s.grouped:
        text = F.replace(text, F.lit(","), F.lit(""))
    if s.places > s.fixed:
        text = F.regexp_replace(text, rf"0{{1,{s.places - s.fixed}}}$", "")
        text = F.regexp_replace(text, r"\.$", "")
    if s.whole == 0:
        text = F.regexp_replace(text, r"^0(?=\.|$)", "")
    elif s.whole > 1:
        size = F.length(F.regexp_replace(F.regexp_extract(text, r"^[^.]*", 0), ",", ""))
        text = F.concat(F.repeat(F.lit("0"), F.greatest(F.lit(s.whole) - size, F.lit(0))), text)
    return F.concat(F.lit(s.before), text, F.lit(s.behind))


def formatted(value: Column, text: str) -> Column:
    """value by a format of one to three sections: for all, or positive and zero; negative, or positive; negative; zero. Null stays null.

    With one section a negative value gets a minus sign in front of all, unless it is rounded to zero; the others show the value without its sign. Values
    are rounded half away from zero. An empty section falls back to the first.
    """
    parts = [section(t) for t in sections(text)]
    exact = value.cast(f"decimal(30,{PLACES})")

    def shown(s: Section, sign: bool) -> Column:
        v = F.round(F.abs(exact) * F.lit(100**s.hundredfold).cast("decimal(10,0)"), s.places).cast(f"decimal(38,{s.places})")
        out = _number(v, s)
        return F.when((exact < 0) & (v > 0), F.concat(F.lit("-"), out)).otherwise(out) if sign and s.digits else out

    first = shown(parts[0], len(parts) == 1 or sections(text)[1] == "")
    out = first
    if len(parts) > 1 and sections(text)[1]:
        out = F.when(exact < 0, shown(parts[1], False)).otherwise(out)
    if len(parts) > 2 and sections(text)[2]:
        out = F.when(exact == 0, shown(parts[2], False)).otherwise(out)
    return F.when(value.isNotNull(), out)


def by_format(df: DataFrame, value: str, fmt: str, out: str, most: int = 1000) -> DataFrame:
    """df with its value shown by the format text in each row; without a format the value as text. A model's different formats are few: more than `most` are an error."""
    texts = [r[0] for r in df.select(fmt).filter(F.col(fmt).isNotNull() & (F.col(fmt) != "")).distinct().limit(most + 1).collect()]
    if len(texts) > most:
        raise ValueError(f"more than {most} formats")
    case = F.col(value).cast("string")
    for t in sorted(texts):
        case = F.when(F.col(fmt) == t, formatted(F.col(value), t)).otherwise(case)
    return df.withColumn(out, case)
