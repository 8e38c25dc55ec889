"""Expressions on formula and script texts: quoted parts, redaction, indents, delimiters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: closed strings and comments of a formula
QUOTED = r'"(?:[^"]|"")*"|//[^\n]*|/\*[\s\S]*?\*/'

REDACTED = "[Connection string redacted]"

#: fixed values: what counts as a connection, in the order of replacement
CONNECTIONS = {
    "server": r"Server\s*=[^\s;]+",
    "data_source": r"Data Source\s*=[^\s;]+",
    "sql_database": r"Sql\.Database\s*\([^)]*\)",
    "sql_native": r"Sql\.Native\s*\([^)]*\)",
    "oledb": r"OleDb\.DataSource\s*\([^)]*\)",
    "odbc": r"Odbc\.DataSource\s*\([^)]*\)",
    "sharepoint": r"SharePoint\.Files\s*\([^)]*\)",
    "url": r"https?://[^\s\"',)]+",
}

#: a table's name with a column in brackets; and brackets that follow no name
QUALIFIED = r"[A-Za-z_'][A-Za-z0-9_' ]*\[[^\]]+\]"
BARE = r"(?<![A-Za-z0-9_'])\[([^\]]+)\]"


def blanked(c: Column | str, by: str = "") -> Column:
    """The text without its strings and comments, each replaced by `by`."""
    return F.regexp_replace(c, QUOTED, by)


def redact(c: Column) -> Column:
    """Connections replaced, pattern after pattern; null stays null."""
    return reduce(lambda x, p: F.regexp_replace(x, "(?i)" + p, REDACTED), CONNECTIONS.values(), c)


def dedent(c: Column) -> Column:
    """The shared leading tabs of non-blank lines dropped, blank lines emptied, and cut at both ends."""
    lines = F.split(c, "\n", -1)
    full = F.filter(lines, lambda x: ~x.rlike(r"^\s*$"))
    shared = F.coalesce(F.array_min(F.transform(full, lambda x: F.length(F.regexp_extract(x, r"^\t*", 0)))), F.lit(0))
    cut = F.transform(lines, lambda x: F.when(x.rlike(r"^\s*$"), "").otherwise(F.substr(x, shared + 1)))
    return F.regexp_replace(F.array_join(cut, "\n"), r"^\n+|\n+\z", "")


def balanced(c: Column) -> Column:
    """Whether round, square and curly delimiters outside strings and comments close in order."""
    marks = F.regexp_extract_all(blanked(c), F.lit(r"[()\[\]{}]"), F.lit(0))
    opener = F.create_map(*map(F.lit, (")", "(", "]", "[", "}", "{")))

    def step(stack, m):
        shut = m.isin(")", "]", "}")
        fits = F.right(stack, F.lit(1)) == opener[m]
        return F.when(stack.startswith("!"), stack).when(~shut, F.concat(stack, m)).when(fits, F.substr(stack, F.lit(1), F.length(stack) - 1)).otherwise("!")

    return F.aggregate(marks, F.lit(""), step) == ""
