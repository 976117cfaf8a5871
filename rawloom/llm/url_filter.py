"""URL filters: all wildcard rules as one bit-parallel automaton.

Rules are globs over canonical URLs (host in lower case, then the path). ``*`` stands for any
characters of a host, ``**`` for any characters at all. The rules' characters are packed side by
side into words of 64 bits; one shift and two masks per character of a URL advance every rule at
once (Shift-And with self-loops for wildcards), here for all URLs of a batch together.
"""

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ragged
from .frames import free_name, table


@dataclass(frozen=True)
class Rule:
    """What to do with the URLs of a host and its subdomains below a path."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path

    @property
    def globs(self) -> tuple[str, str]:
        return f"{self.host}{self.path}**", f"*.{self.host}{self.path}**"


# The rules of the query.
RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def _symbols(glob: str) -> list[int]:
    """Bytes of a glob; -1 for ``*`` and -2 for ``**``."""
    out, raw, i = [], glob.encode(), 0
    while i < len(raw):
        if raw[i : i + 2] == b"**":
            out.append(-2)
            i += 2
        elif raw[i : i + 1] == b"*":
            out.append(-1)
            i += 1
        else:
            out.append(raw[i])
            i += 1
    return out


class Automaton:
    """Shift-And over many globs. Bit p means: the glob is matched up to its p-th literal.

    A wildcard has no bit of its own: it lets the bit before it stay set (``stay``), for the
    characters that the wildcard may stand for. Each glob begins with a bit that is set at the
    start and not shifted into.
    """

    def __init__(self, globs: list[str]):
        starts, accepts, steps, loops, p = [], [], [], [], 0
        for glob in globs:
            starts.append(p)
            for symbol in _symbols(glob):
                if symbol < 0:
                    loops.append((p, symbol))
                else:
                    p += 1
                    steps.append((p, symbol))
            accepts.append(p)
            p += 1
        self.words = p // 64 + 1
        self.reach = np.zeros((256, self.words), np.uint64)
        self.stay = np.zeros((256, self.words), np.uint64)
        self.first = np.zeros(self.words, np.uint64)
        self.accepts = [(a // 64, np.uint64(1 << (a % 64))) for a in accepts]
        for a in starts:
            self.first[a // 64] |= np.uint64(1 << (a % 64))
        for q, byte in steps:
            self.reach[byte, q // 64] |= np.uint64(1 << (q % 64))
        for q, kind in loops:
            allowed = np.ones(256, bool)
            if kind == -1:
                allowed[ord("/")] = False
            self.stay[allowed, q // 64] |= np.uint64(1 << (q % 64))

    def matches(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """For each text, which globs match it as a whole."""
        lengths = np.diff(offsets)
        order = np.argsort(-lengths, kind="stable")
        state = np.tile(self.first, (len(lengths), 1))
        at, active = offsets[:-1][order], len(order)
        sizes = lengths[order]
        for i in range(int(sizes[0]) if len(sizes) else 0):
            active = int(np.searchsorted(-sizes[:active], -i, "left"))
            byte, now = data[at[:active] + i], state[:active]
            shifted = now << np.uint64(1)
            shifted[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:active] = (shifted & self.reach[byte]) | (now & self.stay[byte])
        hit = np.zeros((len(lengths), len(self.accepts)), bool)
        for k, (word, bit) in enumerate(self.accepts):
            hit[order, k] = (state[:, word] & bit) != 0
        return hit


def canonical(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path of a URL; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url)))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lower, F.lit("")), F.coalesce(path, F.lit(""))


def url_filter(pages: DataFrame, rules: tuple[Rule, ...] = RULES, otherwise: str = "allow", url: str = "url") -> DataFrame:
    """Judge every URL by the longest rule that fits it.

    Adds ``host``, ``path``, ``rule`` (NULL if none fits) and ``verdict`` (then ``otherwise``);
    columns of these names are replaced. Of rules of one length the first given wins. NULL, empty
    and malformed URLs have an empty host and path, which fit no rule. Rows are judged one by one:
    equal URLs give equal rows, and an empty table gives an empty table.
    """
    host, path = canonical(F.col(url))
    ranked = sorted(rules, key=lambda r: -len(r.name))
    judged = pages.withColumns({"host": host, "path": path})

    @F.pandas_udf("int")
    def fitting(text: pd.Series) -> pd.Series:
        automaton = Automaton([g for r in ranked for g in r.globs])
        found = np.full(len(text), -1, np.int32)
        for i, j, data, offsets in ragged.chunks(pa.array(text, pa.string())):
            hit = automaton.matches(data, offsets).reshape(j - i, len(ranked), 2).any(axis=2)
            found[i:j] = np.where(hit.any(axis=1), hit.argmax(axis=1), -1) if ranked else -1
        return pd.Series(found)

    def named(values: list[str]) -> Column:
        return F.array(*[F.lit(v) for v in values]) if values else F.array(F.lit(""))

    which = fitting(F.concat("host", "path"))
    n = free_name(judged, "fitting_rule")
    return (
        judged.withColumn(n, which)
        .withColumn("rule", F.when(F.col(n) >= 0, F.get(named([r.name for r in ranked]), F.col(n))))
        .withColumn("verdict", F.when(F.col(n) >= 0, F.get(named([r.verdict for r in ranked]), F.col(n))).otherwise(F.lit(otherwise)))
        .drop(n)
    )


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


SQL = """
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages
), parts AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM cut
), judged AS (
  SELECT *, CASE
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM parts
)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('example.org/en/1', 'example.org/es/', 'com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM judged
"""
