"""Text clean-up expressions shared by all scans."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The white space that Python's str.strip removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Well-formed UTF-8 sequences (Unicode table 3-7), written for text in
# which every byte has become one character. Group 1 is a good sequence, the last
# alternative a stray byte.
_UTF8_OR_STRAY = (
    r"([\x00-\x7F]"
    r"|[\xC2-\xDF][\x80-\xBF]"
    r"|\xE0[\xA0-\xBF][\x80-\xBF]"
    r"|[\xE1-\xEC\xEE\xEF][\x80-\xBF]{2}"
    r"|\xED[\x80-\x9F][\x80-\xBF]"
    r"|\xF0[\x90-\xBF][\x80-\xBF]{2}"
    r"|[\xF1-\xF3][\x80-\xBF]{3}"
    r"|\xF4[\x80-\x8F][\x80-\xBF]{2})"
    r"|[\x80-\xFF]"
)


def ident(name: str) -> str:
    """Quote a column name so that dots and blanks in it are harmless."""
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    return F.col(ident(name))


def strip(c: Column) -> Column:
    """Remove white space (not only blanks) from both ends.

    Blanks go first, which is much cheaper than searching the long list for each of them.
    """
    return F.btrim(F.trim(c), F.lit(WHITESPACE))


def printable(line: Column) -> Column:
    """True for lines of printable ASCII: trimming blanks is all that their fields need."""
    return line.rlike(r"^[ -~]*\z")


def without_return(line: Column) -> Column:
    """The bytes of a line without a carriage return at its end.

    In a short line the return would lie in some field before the last.
    """
    data = line.cast("binary")
    cut = F.substring(data, F.lit(1), F.octet_length(line) - 1)
    return F.when(F.endswith(line, F.lit("\r")), cut).otherwise(data)


def strip_fields(names: list[str], plain: Column) -> list[Column]:
    """Strip the fields of a line; ``plain`` tells whether the line is ``printable``."""
    return [F.when(plain, F.trim(column(n))).otherwise(strip(column(n))).alias(n) for n in names]


def blank_to_null(c: Column) -> Column:
    return F.nullif(strip(c), F.lit(""))


def is_blank(c: Column) -> Column:
    return strip(c) == ""


def is_utf8(encoding: str) -> bool:
    return encoding.lower().replace("_", "-") in ("utf-8", "utf8")


def decode_bytes(c: Column, encoding: str = "utf-8") -> Column:
    """Bytes to text. Bad UTF-8 bytes are dropped, everything else is kept.

    The repair runs only for values that fail the validity test: each byte becomes
    one character, stray bytes are deleted, and the rest is read as UTF-8 again.
    """
    if not is_utf8(encoding):
        return F.decode(c, encoding)
    as_text = c.cast("string")
    one_char_per_byte = F.decode(c, "ISO-8859-1")
    repaired = F.encode(
        F.regexp_replace(one_char_per_byte, _UTF8_OR_STRAY, "$1"), "ISO-8859-1"
    ).cast("string")
    return F.when(F.is_valid_utf8(as_text), as_text).otherwise(repaired)


def normalise_heading(c: Column) -> Column:
    """Lower case, words of letters only, single blanks between them."""
    return F.trim(F.regexp_replace(F.lower(c), "[^a-z]+", " "))


def extract(c: Column, pattern: str, group: int = 1) -> Column:
    """First regex match, or NULL when there is none."""
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def whole_number(c: Column) -> Column:
    """``1,234`` to 1234; NULL when no number remains."""
    return F.regexp_replace(c, ",", "").try_cast("bigint")


def zero_pad(c: Column, width: int = 2) -> Column:
    """Pad with zeros on the left, never cutting longer numbers."""
    text = c.cast("string")
    return F.lpad(text, F.greatest(F.lit(width), F.length(text)), F.lit("0"))


def first_where(lines: Column, pattern: str, must_contain: Column | None = None) -> Column:
    """First non-empty group-1 match over an array of lines."""
    hits = F.transform(lines, lambda line: extract(line, pattern))
    if must_contain is not None:
        hits = F.transform(
            lines, lambda line: F.when(F.contains(line, must_contain), extract(line, pattern))
        )
    return F.get(F.filter(hits, lambda h: h.isNotNull()), F.lit(0))
