"""What a raw file's path tells: kind, year, stem, part and layout.

Two sets of year and stem rules exist. The default one wants a plausible year
(19xx or 20xx) that is not part of a longer digit run, preferably at the end of the
name. ``loose=True`` takes the historical rules: the first digits that fit.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from rawloom.functions.text import extract

# File extensions by kind of raw file.
EXTENSIONS = {"dat": ("dat",), "csv": ("csv",), "sas": ("sas7bdat", "sas")}
KINDS = tuple(EXTENSIONS)

# Name patterns. A part number has any number of digits, but a year after
# a year (``plan_2016_2017``) is no part.
_NO_YEAR = r"(?!(?:19|20)[0-9]{2}$)"
_END_YEAR = rf"(?:^|[^0-9])((?:19|20)[0-9]{{2}})(?:_{_NO_YEAR}[0-9]+)?$"
_ANY_YEAR = r"(?:^|[^0-9])((?:19|20)[0-9]{2})(?:[^0-9]|$)"
_END_PART = rf"(?:^|[^0-9])(?:19|20)[0-9]{{2}}_{_NO_YEAR}([0-9]+)$"
_STATE_TOKEN = r"(?i)_[a-z]{2}_"


def source_path() -> Column:
    """Plain path of the file a row was read from (the metadata column is URL-encoded)."""
    encoded = F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))
    return F.regexp_replace(F.url_decode(encoded), "^file:/+", "/")


def raw_file(path: Column) -> Column:
    """The path of the raw file itself.

    A distributed writer turns one file into a folder of part files; the folder then
    counts as the file. ``key=`` prefixes of Hive-style folders are ignored.
    """
    return F.regexp_replace(path, r"(\.[A-Za-z0-9]+)/part-[^/]*$", "$1")


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def raw_name(path: Column) -> Column:
    return F.regexp_replace(base_name(raw_file(path)), r"^[^=.]*=", "")


def dir_name(path: Column) -> Column:
    return F.regexp_replace(path, r"/[^/]*$", "")


def name_stem(name: Column) -> Column:
    """File name without its last extension; a leading dot starts no extension."""
    return F.regexp_replace(name, r"(?<=[^.])\.[^.]*$", "")


def extension(name: Column) -> Column:
    return F.lower(F.regexp_extract(name, r"[^.]\.([^.]*)$", 1))


def kind_of(name: Column) -> Column:
    """dat, csv or sas by extension in any case; NULL when unsupported."""
    kinds = [F.lit(x) for kind, exts in EXTENSIONS.items() for ext in exts for x in (ext, kind)]
    return F.try_element_at(F.create_map(*kinds), extension(name))


def folder_year(path: Column, root: str | None = None) -> Column:
    """A folder named by exactly four digits (or ``key=`` and four digits).

    With ``root`` it has to lie directly below it, else the innermost one counts.
    """
    before = re.escape(plain_path(root)) if root else "^.*"
    return extract(path, before + r"/(?:[^/=]*=)?([0-9]{4})/")


def literal_path(path: str) -> str:
    """A path that readers do not take for a pattern."""
    return re.sub(r"([][{}*?\\])", r"\\\1", path)


def plain_path(root: str) -> str:
    """A folder without scheme and without trailing slash."""
    return re.sub(r"^file:/+", "/", root).rstrip("/")


def loose_year_anywhere(name: Column) -> Column:
    """First four digits followed by an optional number and a dot or the end."""
    return F.coalesce(
        extract(name, r"_?([0-9]{4})(?:_[0-9]+)?(?:\.|$)"), F.lit("unknown")
    )


def _by_kind(kind: Column, dat: Column, csv: Column, sas: Column) -> Column:
    return F.when(kind == "dat", dat).when(kind == "csv", csv).when(kind == "sas", sas)


def year_of_name(name: Column, kind: Column, loose: bool = False) -> Column:
    stem = name_stem(name)
    if loose:
        return _by_kind(
            kind,
            F.coalesce(extract(stem, r"_([0-9]{4})(?:_[0-9]{3}|$)"), name),
            F.coalesce(extract(name, r"_([0-9]{4})"), F.lit("unknown")),
            F.coalesce(extract(stem, r"([0-9]{4})"), name),
        )
    at_end = extract(stem, _END_YEAR)
    return F.when(kind == "dat", at_end).otherwise(F.coalesce(at_end, extract(stem, _ANY_YEAR)))


def stem_of_name(name: Column, kind: Column, loose: bool = False) -> Column:
    stem = name_stem(name)
    # The historical rules know three digits only.
    part = "[0-9]{3}" if loose else rf"{_NO_YEAR}[0-9]{{3,}}"
    numbered = rf"_[0-9]{{4}}_({part})$"
    dat = F.when(stem.rlike(numbered), F.regexp_replace(stem, numbered, "__$1")).otherwise(
        F.regexp_replace(stem, r"_[0-9]{4}$", "")
    )
    csv = F.regexp_replace(stem, rf"_[0-9]{{4}}(?:_{part})?$", "")
    if loose:
        year = extract(stem, r"([0-9]{4})")
        kept = F.when(year.isNull(), stem).otherwise(F.replace(stem, year, F.lit("")))
    else:
        kept = F.regexp_replace(
            stem, rf"(^|[^0-9])(?:19|20)[0-9]{{2}}(_{_NO_YEAR}[0-9]+)?$", "$1$2"
        )
    sas = F.regexp_replace(F.regexp_replace(kept, r"_+$", ""), r"-+$", "")
    sas = F.when(sas == "", stem).otherwise(sas)
    return _by_kind(kind, dat, csv, sas)


def part_of_name(name: Column) -> Column:
    """``002`` in ``claims_2011_002``."""
    return extract(name_stem(name), _END_PART)


def layout_stem(name: Column, kind: Column, loose: bool = False) -> Column:
    """Name (without extension) of the layout file that describes a raw file.

    Parts share a layout, and so do the files of all states (two-letter tokens).
    """
    stem = name_stem(name)
    # The historical rules, which the longer part numbers are added to.
    whole = F.regexp_replace(stem, r"_[0-9]{3}$", "")
    if loose:
        csv = F.regexp_replace(stem, r"_[a-z]{2}_", "_")
    else:
        whole = F.regexp_replace(whole, rf"(_[0-9]{{4}})_{_NO_YEAR}[0-9]{{4,}}$", "$1")
        csv = F.regexp_replace(whole, _STATE_TOKEN, "_")
    return F.when(kind == "dat", whole).when(kind == "csv", csv)
