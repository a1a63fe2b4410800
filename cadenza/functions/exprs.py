"""Column expressions shared by the operators.

All of them are built-in Spark expressions evaluated in the JVM; nothing here
calls back into Python per row.  The array lambdas (``split_tokens``,
``consolidate``) are evaluated interpreted by Spark, so the operators apply
them to label-dimension rows (one per artist), not to fact rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from cadenza.functions.vocab import MISSING_LABEL

# Every character Python's ``str.strip()`` removes.  Java's ``\s`` and RE2's
# ``\s`` both miss some of them, so the class is spelled out.  The same text
# is valid in Java regex and in RE2 (used by the DuckDB oracle).
WS_CLASS = (r"[\x09\x0A\x0B\x0C\x0D\x1C-\x1F\x20\x{85}\x{A0}\x{1680}"
            r"\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")
STRIP_PATTERN = rf"^{WS_CLASS}+|{WS_CLASS}+$"
# The same characters as a set, for ``btrim`` (which scans only the two ends).
WS_CHARS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
            + "".join(chr(c) for c in range(0x2000, 0x200B)) + "\u2028\u2029\u202f\u205f\u3000")


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c: str | Column) -> Column:
    """Remove leading and trailing whitespace the way Python's strip does.

    ``btrim`` with the whitespace set looks at the two ends only, so a long
    text costs no more than a short one (a regex would scan all of it)."""
    return F.btrim(col_of(c), F.lit(WS_CHARS))


def norm_key(c: str | Column) -> Column:
    """Dedupe key: lower case, then strip (lower + strip of the item name)."""
    return strip_ws(F.lower(col_of(c)))


def split_tokens(c: str | Column, sep: str = ",", keep_empty: bool = True) -> Column:
    """Split a delimited label string and strip each token.

    ``keep_empty=False`` drops empty tokens (used for distinct counts).
    """
    parts = F.transform(F.split(col_of(c), _regex_escape(sep)), strip_ws)
    if keep_empty:
        return parts
    return F.filter(parts, lambda t: t != F.lit(""))


def first_token(c: str | Column, sep: str = ",") -> Column:
    """Primary label: first token of the list, stripped."""
    return strip_ws(F.split(col_of(c), _regex_escape(sep)).getItem(0))


def last_segment(c: str | Column, sep: str = "/") -> Column:
    """Last ``sep``-separated segment (``href.split('/')[-1]``)."""
    return F.element_at(F.split(col_of(c), _regex_escape(sep)), -1)


def is_missing_label(c: str | Column, missing: Iterable[str] = (MISSING_LABEL,)) -> Column:
    """True when a label is null, empty or one of the 'missing' markers."""
    c = col_of(c)
    return c.isNull() | (strip_ws(c) == F.lit("")) | c.isin(list(missing))


def map_literal(mapping: Mapping[str, str]) -> Column:
    """A ``map<string,string>`` literal; for maps of bounded, small size."""
    if not mapping:
        return F.create_map().cast("map<string,string>")
    kv = []
    for k, v in mapping.items():
        kv += [F.lit(k), F.lit(v)]
    return F.create_map(*kv)


def consolidate(c: str | Column, mapping: Mapping[str, str], sep: str = ",",
                out_sep: str = ", ", missing: Iterable[str] = (MISSING_LABEL,)) -> Column:
    """Map each token to its family (identity when unmapped), ordered dedupe.

    Null and the missing markers pass through unchanged.  ``array_distinct``
    keeps first occurrences in order.
    """
    c = col_of(c)
    m = map_literal(mapping)
    mapped = F.transform(split_tokens(c, sep),
                         lambda t: F.coalesce(F.try_element_at(m, t), t))
    joined = F.array_join(F.array_distinct(mapped), out_sep)
    return F.when(c.isNull() | c.isin(list(missing)), c).otherwise(joined)


def hash_key(seed: int | str, *cols: str | Column) -> Column:
    """Deterministic pseudo-random order key: md5 of ``seed|key...``.

    Independent of partitioning and reproducible in any engine with md5.
    """
    parts = [F.lit(str(seed))] + [F.coalesce(col_of(c).cast("string"), F.lit(""))
                                  for c in cols]
    return F.md5(F.concat_ws("|", *parts))


def hash_bucket(h: str | Column, hex_digits: int = 4) -> Column:
    """Leading ``hex_digits`` of an md5 key as an int bucket (uniform)."""
    return F.conv(F.substring(col_of(h), 1, hex_digits), 16, 10).cast("int")


def safe_scale(sd: str | Column) -> Column:
    """Scale divisor with zero replaced by one (constant features)."""
    sd = col_of(sd)
    return F.when(sd.isNull() | (sd == 0), F.lit(1.0)).otherwise(sd)


def _regex_escape(s: str) -> str:
    specials = set(r".^$*+?()[]{}|\\")
    return "".join("\\" + ch if ch in specials else ch for ch in s)
