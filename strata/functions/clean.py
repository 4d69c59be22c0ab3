"""Text cleaning expressions (SC-01, 02, 13-19, 24-28)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .core import as_col, c

# The text tokens that mean "no value" in exported reports.
GARBAGE_TOKENS = ["nan", "NaN", "NAN", "None", "null", "Null", ""]

# Accented letters folded to plain ASCII (lower case).
ACCENTED = "áàâäãåéèêëíìîïóòôöõúùûüñçý"
PLAIN = "aaaaaaeeeeiiiiooooouuuuncy"


def garbage_to_null(col, trim_values: bool = False) -> Column:
    """SC-01. Blank (whitespace only) or exactly one of GARBAGE_TOKENS -> NULL.

    ``trim_values`` = trimmed, case-insensitive ``nan|none|null`` variant."""
    x = as_col(col)
    if trim_values:
        bad = (F.trim(x) == "") | F.lower(F.trim(x)).isin("nan", "none", "null")
    else:
        bad = (F.trim(x) == "") | x.isin(*GARBAGE_TOKENS)
    return F.when(bad, F.lit(None).cast(StringType())).otherwise(x)


def nullify_garbage(df: DataFrame, cols: list[str] | None = None, trim_values: bool = False) -> DataFrame:
    """SC-01 over every string column (or ``cols``); names are preserved."""
    names = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    return df.withColumns({n: garbage_to_null(c(n), trim_values) for n in names})


def normalize_id(col, strip_dots: bool = True) -> Column:
    """SC-02. trim, drop a trailing ``.0`` (Excel float ids), drop thousands dots,
    then ``nan``/``None``/blank -> NULL."""
    x = F.regexp_replace(F.trim(as_col(col).cast("string")), r"\.0$", "")
    if strip_dots:
        x = F.replace(x, F.lit("."), F.lit(""))
    return F.when(x.isin("nan", "None", ""), F.lit(None).cast(StringType())).otherwise(x)


def normalize_ids(df: DataFrame, cols: list[str], strip_dots: bool = True) -> DataFrame:
    present = [n for n in cols if n in df.columns]
    return df.withColumns({n: normalize_id(c(n), strip_dots) for n in present})


def squish(col) -> Column:
    """SC-13: trim and collapse inner whitespace runs to one space."""
    return F.trim(F.regexp_replace(as_col(col), r"\s+", " "))


def upper_squish(col) -> Column:
    return F.upper(squish(col))


def fold_text(col) -> Column:
    """SC-14: accent fold, lower case, keep ``[a-z0-9 ]``, collapse spaces, trim."""
    x = F.translate(F.lower(as_col(col)), ACCENTED, PLAIN)
    x = F.regexp_replace(x, r"[^a-z0-9\s]", "")
    return F.trim(F.regexp_replace(x, r"\s+", " "))


def clean_seller(col) -> Column:
    """SC-14, what comes before the fold in seller texts: a text with a fraction (``12/5``) keeps its digits, slashes and
    spaces, any other its letters (accented ones too), digits and spaces; spaces collapsed, trimmed."""
    x = as_col(col)
    kept = (F.when(x.rlike(r"\d+/\d+"), F.regexp_replace(x, r"[^0-9/\s]", ""))
            .otherwise(F.regexp_replace(x, r"[^a-zA-Z0-9\sÀ-ÖØ-öø-ÿ]", "")))
    return F.trim(F.regexp_replace(kept, r"\s+", " "))


def extract_or_null(col, pattern: str, group: int = 1) -> Column:
    """SC-15: regexp group, '' (Spark's no-match result) -> NULL."""
    return F.nullif(F.trim(F.regexp_extract(as_col(col), pattern, group)), F.lit(""))


# Office name after OFICINA / OFIC / OFI (greedy prefix, as in the sales-status job).
OFFICE_PATTERN = r"(?i).*(?:OFICINA|OFIC|OFI)\s+(.*)$"


def office_after_marker(col) -> Column:
    return extract_or_null(col, OFFICE_PATTERN, 1)


def replace_chain(col, pairs: list[tuple[str, str]]) -> Column:
    """SC-16: literal (non-regex) replacements applied in the given order."""
    return reduce(lambda acc, p: F.replace(acc, F.lit(p[0]), F.lit(p[1])), pairs, as_col(col))


def head_before(col, marker: str) -> Column:
    """SC-17: text before the first ``marker`` (whole text if absent), trimmed."""
    return F.trim(F.split_part(as_col(col), F.lit(marker), F.lit(1)))


def decimal_comma(col, default: float = 0.0) -> Column:
    """SC-18: ``'1234,5'`` -> 1234.5; unparseable -> ``default``."""
    return F.coalesce(F.replace(as_col(col).cast("string"), F.lit(","), F.lit(".")).try_cast("double"),
                      F.lit(default).cast("double"))


def default_if_blank(col, default: str) -> Column:
    """SC-19: NULL or blank -> default label."""
    return F.coalesce(F.nullif(F.trim(as_col(col)), F.lit("")), F.lit(default))


def zero_pad(col, width: int = 2) -> Column:
    """SC-24."""
    return F.lpad(as_col(col).cast("string"), width, "0")


def safe_cast(col, dtype: str, default=None) -> Column:
    """SC-25: try_cast with a default for failures and NULLs."""
    x = as_col(col).try_cast(dtype)
    return x if default is None else F.coalesce(x, F.lit(default).cast(dtype))


def contains_any(col, keywords: list[str], case_insensitive: bool = True, word_boundary: bool = False) -> Column:
    """SC-26: true when any keyword occurs (literal keywords, regex-escaped)."""
    import re

    alt = "|".join(re.escape(k) for k in keywords)
    if word_boundary:
        alt = r"\b(?:" + alt + r")\b"
    pat = ("(?i)" if case_insensitive else "") + "(?:" + alt + ")"
    return F.coalesce(as_col(col).rlike(pat), F.lit(False))


def identity_concat(*cols) -> Column:
    """SC-27: NULL-filled, space-joined, trimmed identity text."""
    return F.trim(F.concat_ws(" ", *[F.coalesce(as_col(x).cast("string"), F.lit("")) for x in cols]))


def source_tag(col="Source.Name") -> Column:
    """SC-28: provenance file name as an upper-case business column."""
    return F.upper(as_col(col))
