"""Row filters (FLT-01..10). Predicates are plain column expressions so
Catalyst pushes the simple ones into the Parquet scan."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.core import as_col


def not_null(df: DataFrame, *keys: str) -> DataFrame:
    """FLT-01."""
    cond = None
    for k in keys:
        e = as_col(k).isNotNull()
        cond = e if cond is None else cond & e
    return df.filter(cond)


def in_list(col, values: list, negate: bool = False, keep_null: bool = False) -> Column:
    """FLT-02: membership. SQL semantics drop NULL either way; ``keep_null`` keeps
    NULL rows (the object-pandas behaviour, D-03)."""
    x = as_col(col)
    e = ~x.isin(*values) if negate else x.isin(*values)
    return (x.isNull() | e) if keep_null else F.coalesce(e, F.lit(False))


def matches(col, pattern: str, negate: bool = False, case_insensitive: bool = True) -> Column:
    """FLT-03: regex include / exclude (NULL never matches, never excluded-out)."""
    pat = ("(?i)" if case_insensitive else "") + pattern
    m = F.coalesce(as_col(col).rlike(pat), F.lit(False))
    return ~m if negate else m


def not_like_prefix(col, prefix: str) -> Column:
    """FLT-04: ``NOT LIKE 'X%'`` (NULL dropped as in SQL)."""
    return ~as_col(col).startswith(prefix)


def date_window(col, start=None, end=None, as_of: _dt.date | None = None, future_days: int = 1,
                keep_undated: bool = False) -> Column:
    """FLT-05: inside [start, end] and not later than ``as_of + future_days``.
    Undated rows fail, as in SQL, unless ``keep_undated``.
    ``as_of`` is explicit (never ``current_date`` inside tested code)."""
    x = as_col(col)
    if as_of is not None:
        limit = F.lit(_dt.datetime.combine(as_of, _dt.time()) + _dt.timedelta(days=future_days + 1))
        if start is None and end is None:
            # a filter is pushed below the projection that parses the date, where each mention of x parses it again
            return F.coalesce(x < limit, F.lit(keep_undated))
    cond = x.isNotNull()
    if start is not None:
        cond = cond & (x >= F.lit(start))
    if end is not None:
        cond = cond & (x <= F.lit(end))
    if as_of is not None:
        cond = cond & (x < limit)
    return cond | x.isNull() if keep_undated else cond


def period_with_backlog(opened, closed, period_start, period_end, window_start) -> Column:
    """FLT-06: closed inside [window_start, end-of-day(period_end)] OR (opened in
    [period_start, end-of-day(period_end)] AND still open)."""
    o, cl = as_col(opened), as_col(closed)
    upper = F.lit(period_end) if not isinstance(period_end, Column) else period_end
    upper_excl = F.date_add(F.to_date(upper), 1).cast("timestamp_ntz")
    lo_close = F.lit(window_start) if not isinstance(window_start, Column) else window_start
    lo_open = F.lit(period_start) if not isinstance(period_start, Column) else period_start
    closed_here = cl.isNotNull() & (cl >= lo_close) & (cl < upper_excl)
    born_here = (o >= lo_open) & (o < upper_excl)
    return F.coalesce(closed_here | (born_here & cl.isNull()), F.lit(False))


def equals_normalized(col, value: str) -> Column:
    """FLT-07: ``upper(trim(x)) = VALUE``."""
    return F.upper(F.trim(as_col(col))) == F.lit(value.strip().upper())


def min_length(col, n: int) -> Column:
    """FLT-08 (text form): length > n."""
    return F.length(as_col(col)) > n


def route_feeds(df: DataFrame, rules: list[dict], type_col: str, response_col: str, detail_col: str,
                out: str = "feed") -> DataFrame:
    """FLT-09: one call log split into feeds by (type, response, detail) rules.
    A rule key of None is a wildcard; the first matching rule names the feed;
    unmatched rows get NULL. Rules become one CASE expression (no join)."""
    expr = None
    for r in rules:
        cond = F.lit(True)
        for key, colname in (("type", type_col), ("response", response_col), ("detail", detail_col)):
            v = r.get(key)
            if v is None:
                continue
            x = F.upper(F.trim(as_col(colname)))
            if isinstance(v, (list, tuple)):
                cond = cond & x.isin(*[s.upper() for s in v])
            else:
                cond = cond & (x == F.lit(v.upper()))
        cond = F.coalesce(cond, F.lit(False))
        expr = F.when(cond, F.lit(r["feed"])) if expr is None else expr.when(cond, F.lit(r["feed"]))
    return df.withColumn(out, expr if expr is not None else F.lit(None).cast("string"))
