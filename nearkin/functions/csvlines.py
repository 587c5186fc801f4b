"""Delimited text lines: one record per line, quotes doubled inside quotes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Appended as one more field, so that a line that is too short shows it among
# the fields asked for.
_END = "\u0001end\u0001"
_SWALLOWED = "," + _END

# What the parser makes room for. A longer line is cut behind the fields asked for
# before it is parsed, so that no line can end a job.
MAX_FIELDS = 1 << 18

# Doubled quotes are masked, which keeps places, so that a field is found without
# recursion: one in quotes (left open, it takes the rest) or a plain one.
_MASK = "\u0001\u0001"
_FIELD = r'\G(?:\x01*+"[^"]*+(?:"[^,]*+|\z)|[^,]*+)(?:,|\z)'

READ_OPTIONS = {
    "quote": '"',
    "escape": '"',
    "mode": "PERMISSIVE",
    "maxColumns": str(MAX_FIELDS + 2),
}
WRITE_OPTIONS = {
    "quote": '"',
    "escape": '"',
    "emptyValue": "",
    "nullValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def split_line(line: Column, n: int) -> Column:
    """Split a line into a struct of its first ``n`` fields ``_0``, ``_1``, ... as text.

    The struct is raw: it may hold the end mark, see :func:`field_text`.
    """
    if n > MAX_FIELDS:
        raise ValueError(f"at most {MAX_FIELDS} fields")
    schema = ", ".join(f"_{i} string" for i in range(n))
    wide = F.length(line) > MAX_FIELDS
    masked = F.replace(line, F.lit('""'), F.lit(_MASK))
    fields = F.slice(F.regexp_extract_all(masked, F.lit(_FIELD), F.lit(0)), 1, n)
    length = F.aggregate(fields, F.lit(0), lambda total, field: total + F.length(field))
    cut = F.when(wide, F.substring(line, F.lit(1), length)).otherwise(line)
    return F.from_csv(F.concat(cut, F.lit(_SWALLOWED)), schema, READ_OPTIONS)


def field_text(field: Column) -> Column:
    """A raw field as text; an empty field is empty text.

    A quote left open takes the rest of the line, and with it the end mark,
    which is cut off again here.
    """
    cut = F.substring(field, F.lit(1), F.length(field) - len(_SWALLOWED))
    return F.coalesce(F.when(F.endswith(field, F.lit(_SWALLOWED)), cut).otherwise(field), F.lit(""))


def is_data_line(line: Column, fields: Sequence[Column], header: str) -> Column:
    """True if the line has all the raw ``fields`` (more do no harm) and is no header.

    A header is a line whose first field is ``header``, wherever it stands.
    """
    complete = (line != "") & ~fields[0].eqNullSafe(header)
    for field in fields:
        complete = complete & ~field.eqNullSafe(_END)
    for field in fields[:-1]:
        complete = complete & ~F.coalesce(F.endswith(field, F.lit(_SWALLOWED)), F.lit(False))
    return complete


def join_line(columns: Sequence[Column]) -> Column:
    """Join columns to a line; only fields that need quotes get them."""
    return F.to_csv(F.struct(*columns), WRITE_OPTIONS)
