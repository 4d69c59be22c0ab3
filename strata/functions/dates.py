"""Date / time expressions (SC-03..12, SC-20..23). Pure column expressions,
ANSI-safe (only ``try_*`` parsers), no Python UDF."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .core import as_col, c

# Spanish month names and their three-letter labels, January first.
MONTHS_ES = ["Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio",
             "Julio", "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre"]
MONTHS_ES_ABBR = ["ENE", "FEB", "MAR", "ABR", "MAY", "JUN", "JUL", "AGO", "SEP", "OCT", "NOV", "DIC"]

# Default order of text date formats tried by the bronze ingestion (first match wins).
DEFAULT_DATE_FORMATS = ["yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "d/M/yyyy H:mm:ss", "d/M/yyyy", "d-M-yyyy"]
# Formats accepted for ERP hour text after lower-casing and removing dots/spaces.
HOUR_FORMATS = ["h:mma", "h:mm:ssa", "H:mm", "H:mm:ss"]

EXCEL_EPOCH_TO_UNIX_DAYS = 25569  # days from 1899-12-30 to 1970-01-01


def _to_ntz(ts: Column) -> Column:
    return ts.cast("timestamp_ntz")


def shape_regex(fmt: str) -> str:
    """Anchored regex accepting every string the datetime pattern can parse
    (never stricter): used to skip parse attempts that must fail, because a
    failing ``try_to_timestamp`` costs an exception per row."""
    import re

    out, i = "", 0
    while i < len(fmt):
        ch = fmt[i]
        j = i
        while j < len(fmt) and fmt[j] == ch:
            j += 1
        n = j - i
        if ch == "y":
            out += r"\d{4}" if n >= 4 else r"\d{2,4}"
        elif ch in "MdHhms":
            out += r"\d{2}" if n >= 2 else r"\d{1,2}"
        elif ch == "a":
            out += "[AaPp][Mm]"
        else:
            out += re.escape(ch * n)
        i = j
    return "^" + out + "$"


def try_parse(x: Column, fmt: str) -> Column:
    """``try_to_timestamp`` attempted only when the text has the pattern's shape."""
    return F.when(x.rlike(shape_regex(fmt)), F.try_to_timestamp(x, F.lit(fmt)))


def parse_datetime(col, formats: list[str] | None = None) -> Column:
    """SC-03: first format that parses wins; unparseable -> NULL. TIMESTAMP_NTZ."""
    x = F.trim(as_col(col).cast("string"))
    return _to_ntz(F.coalesce(*[try_parse(x, f) for f in (formats or DEFAULT_DATE_FORMATS)]))


def parse_date(col, formats: list[str] | None = None) -> Column:
    return parse_datetime(col, formats).cast("date")


def excel_serial_to_ts(col) -> Column:
    """Excel day serial (origin 1899-12-30, fractional days = time)."""
    n = as_col(col).cast("string").try_cast("double")
    return _to_ntz(F.timestamp_micros(F.round((n - EXCEL_EPOCH_TO_UNIX_DAYS) * F.lit(86400000000.0)).cast("long")))


def parse_mixed(col, formats: list[str] | None = None, lo: float = 35000, hi: float = 60000) -> Column:
    """SC-04: number strictly between ``lo`` and ``hi`` = Excel serial, else
    day-first text formats (SC-03)."""
    x = as_col(col).cast("string")
    # never a number, and a failing ``try_cast`` costs an exception per row
    n = F.when(~x.rlike(r"[/:]|\d-\d"), x.try_cast("double"))
    day_first = formats or ["d/M/yyyy H:mm:ss", "d/M/yyyy H:mm", "d/M/yyyy", "d-M-yyyy H:mm:ss", "d-M-yyyy",
                            "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd"]
    return F.when((n > lo) & (n < hi), excel_serial_to_ts(col)).otherwise(parse_datetime(col, day_first))


def day_of(col) -> Column:
    """SC-05: truncate to day (DATE)."""
    return F.to_date(as_col(col))


def hour_bucket(col, default: str | None = None) -> Column:
    """SC-06 / SC-07: ERP hour text (``2:30 p. m.``, ``14:05:00``, ``08:10``) -> ``HH:00``.

    Unparseable -> NULL, or ``default`` (SC-07 uses ``'00:00'``). Timestamp
    input is bucketed directly."""
    x = as_col(col)
    norm = F.upper(F.replace(F.replace(F.lower(F.trim(x.cast("string"))), F.lit("."), F.lit("")), F.lit(" "), F.lit("")))
    ts = F.coalesce(*[try_parse(norm, f) for f in HOUR_FORMATS])
    out = F.date_format(ts, "HH:00")
    return out if default is None else F.coalesce(out, F.lit(default))


def hour_bucket_ts(col) -> Column:
    return F.date_format(as_col(col), "HH:00")


def month_name_es(col, case: str = "title") -> Column:
    """SC-08: month number (1-12) -> Spanish name; ``case`` title|lower|upper|abbr."""
    names = MONTHS_ES_ABBR if case == "abbr" else MONTHS_ES
    if case == "lower":
        names = [n.lower() for n in names]
    elif case == "upper":
        names = [n.upper() for n in names]
    return F.element_at(F.array(*[F.lit(n) for n in names]), as_col(col).cast("int"))


def month_number_es(col) -> Column:
    """SC-09: Spanish month name (any case, trimmed) -> 1..12, else NULL."""
    pairs = []
    for i, n in enumerate(MONTHS_ES, start=1):
        pairs += [F.lit(n.upper()), F.lit(i)]
    return F.try_element_at(F.create_map(*pairs), F.upper(F.trim(as_col(col))))


def first_of_month(year, month) -> Column:
    """SC-09: (year, month) -> first day as DATE; invalid -> NULL (ANSI-safe)."""
    return F.try_make_timestamp(as_col(year).cast("int"), as_col(month).cast("int"), F.lit(1),
                                F.lit(0), F.lit(0), F.lit(0)).cast("date")


def round_half_even(col, scale: int = 2) -> Column:
    """SC-21: half-even rounding with numpy/pandas semantics (scale the binary
    double, round half to even, scale back). Spark's ``bround`` rounds the
    decimal rendering instead, which differs on values like 65930.865."""
    f = float(10 ** scale)
    return F.bround(as_col(col) * F.lit(f), 0) / F.lit(f)


def micros_between(end, start) -> Column:
    return F.timestamp_diff("MICROSECOND", as_col(start), as_col(end))


def minutes_between(end, start, clip_zero: bool = True, scale: int = 2) -> Column:
    """SC-10: (end - start) minutes, half-even rounded; negative -> 0; NULL stays NULL
    (``greatest`` alone would skip NULLs, hence the guard)."""
    m = round_half_even(micros_between(end, start) / F.lit(60000000.0), scale)
    if not clip_zero:
        return m
    return F.when(m.isNull(), F.lit(None).cast("double")).otherwise(F.greatest(m, F.lit(0.0)))


def days_between(end, start, fractional: bool = True, clip_zero: bool = False) -> Column:
    """SC-11: days between two timestamps (fractional) or dates (whole)."""
    d = (micros_between(end, start) / F.lit(86400000000.0)) if fractional else \
        F.datediff(F.to_date(as_col(end)), F.to_date(as_col(start))).cast("double")
    if clip_zero:
        d = F.when(d.isNull(), F.lit(None).cast("double")).otherwise(F.greatest(d, F.lit(0.0)))
    return d


def band(col, edges: list[tuple[float, str]], default: str, null_label: str | None = None) -> Column:
    """SC-12: first ``(upper_bound, label)`` with value <= bound wins, else default."""
    x = as_col(col)
    expr = F.when(x.isNull(), F.lit(null_label)) if null_label is not None else None
    for bound, label in edges:
        expr = (F.when(x <= bound, F.lit(label)) if expr is None else expr.when(x <= bound, F.lit(label)))
    return expr.otherwise(F.lit(default))


def indicator(cond: Column) -> Column:
    """SC-23: boolean -> 1/0 (NULL condition -> 0)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def half_label(month: Column, year: Column, day: Column) -> Column:
    """``MMM YYYY Qn``: Q1 iff day <= 15; NULL when the date is NULL."""
    lab = F.concat_ws(" ", month_name_es(month, "abbr"), year.cast("string"),
                      F.when(day <= 15, F.lit("Q1")).otherwise(F.lit("Q2")))
    return F.when(month.isNotNull() & year.isNotNull() & day.isNotNull(), lab)


def period_from_name(col, loose: bool = False) -> Column:
    """SC-20a/b as one expression: ``... d-m-Y al d-m-Y ...`` in a file name ->
    struct(start, end, label). ``loose``: any two ``d?m?Y`` tokens with any
    non-word separator. No match or an invalid date -> all NULL.

    For per-row use over large inputs prefer ``with_period`` (staged, each
    regex evaluated once) or compute it on the distinct file names."""
    name = F.lower(F.regexp_replace(as_col(col), r"^.*[/\\]", ""))
    if loose:
        pat = r"(\d{1,2}\W\d{1,2}\W\d{4}).*?(\d{1,2}\W\d{1,2}\W\d{4})"
    else:
        pat = r"(\d{1,2}-\d{1,2}-\d{4})\s+al\s+(\d{1,2}-\d{1,2}-\d{4})"

    def tok(i):
        return F.regexp_replace(F.regexp_extract(name, pat, i), r"\W", "-")

    start, end = _dmy(tok(1)), _dmy(tok(2))
    ok = start.isNotNull() & end.isNotNull()
    null_ts = F.lit(None).cast("timestamp_ntz")
    return F.struct(F.when(ok, start).otherwise(null_ts).alias("start"),
                    F.when(ok, end).otherwise(null_ts).alias("end"),
                    F.when(ok, half_label(F.month(end), F.year(end), F.dayofmonth(end))).alias("label"))


def _dmy(token: Column) -> Column:
    """``d-M-yyyy`` token -> TIMESTAMP_NTZ; '' or an impossible date -> NULL."""
    return try_parse(token, "d-M-yyyy").cast("timestamp_ntz")


def with_period(df: DataFrame, col: str, prefix: str = "", loose: bool = False) -> DataFrame:
    """SC-20a/b staged: adds ``{prefix}start``, ``{prefix}end``, ``{prefix}label``.

    The regex runs once per row (Catalyst keeps the stages apart because the
    extracted tokens are reused by several expressions)."""

    name = F.lower(F.regexp_replace(c(col), r"^.*[/\\]", ""))
    if loose:
        pat = r"(\d{1,2}\W\d{1,2}\W\d{4}).*?(\d{1,2}\W\d{1,2}\W\d{4})"
    else:
        pat = r"(\d{1,2}-\d{1,2}-\d{4})\s+al\s+(\d{1,2}-\d{1,2}-\d{4})"
    t = df.withColumn("__pm", F.regexp_replace(F.regexp_extract(name, pat, 0), r"\W", "-"))
    t = t.withColumns({"__s": _dmy(F.regexp_extract("__pm", r"^(\d+-\d+-\d+)", 1)),
                       "__e": _dmy(F.regexp_extract("__pm", r"(\d+-\d+-\d+)$", 1))})
    ok = F.col("__s").isNotNull() & F.col("__e").isNotNull()
    null_ts = F.lit(None).cast("timestamp_ntz")
    t = t.withColumns({prefix + "start": F.when(ok, F.col("__s")).otherwise(null_ts),
                       prefix + "end": F.when(ok, F.col("__e")).otherwise(null_ts)})
    e = F.col(prefix + "end")
    return t.withColumn(prefix + "label", half_label(F.month(e), F.year(e), F.dayofmonth(e))).drop("__pm", "__s", "__e")


def snapshot_cut(col) -> Column:
    """SC-20c: snapshot date in a file name (``d?sep m?sep YYYY``) -> struct(cut, label).

    day <= 5 -> last day of previous month (Q2); day <= 20 -> 15th (Q1);
    else month end (Q2)."""
    name = F.lower(F.regexp_replace(as_col(col), r"^.*[/\\]", ""))
    pat = r"(\d{1,2})[\-./_\s]+(\d{1,2})[\-./_\s]+(\d{4})"
    d = F.try_make_timestamp(F.regexp_extract(name, pat, 3).try_cast("int"),
                             F.regexp_extract(name, pat, 2).try_cast("int"),
                             F.regexp_extract(name, pat, 1).try_cast("int"),
                             F.lit(0), F.lit(0), F.lit(0)).cast("date")
    day = F.dayofmonth(d)
    cut = (F.when(day <= 5, F.date_sub(F.trunc(d, "month"), 1))
           .when(day <= 20, F.date_add(F.trunc(d, "month"), 14))
           .otherwise(F.last_day(d)))
    q = F.when((day > 5) & (day <= 20), F.lit("Q1")).otherwise(F.lit("Q2"))
    label = F.concat_ws(" ", month_name_es(F.month(cut), "abbr"), F.year(cut).cast("string"), q)
    return F.struct(cut.alias("cut"), F.when(d.isNotNull(), label).alias("label"))


def date_token(col) -> Column:
    """SC-20d: first 6-8 digit run in a name (separators removed first, D-16):
    last 4 = year; the rest = day+month (4 digits), d+m (2), or dd+m (3).
    No run or an invalid date -> 1900-01-01."""
    name = F.regexp_replace(as_col(col), r"(\d)[\-._/](?=\d)", "$1")
    run = F.regexp_extract(name, r"(\d{6,8})", 1)
    n = F.length(run)
    year = F.substring(run, -4, 4).try_cast("int")
    rest = F.substring(run, F.lit(1), n - 4)
    rl = F.length(rest)
    day = (F.when(rl == 4, F.substring(rest, 1, 2)).when(rl == 2, F.substring(rest, 1, 1))
           .when(rl == 3, F.substring(rest, 1, 2))).try_cast("int")
    month = (F.when(rl == 4, F.substring(rest, 3, 2)).when(rl == 2, F.substring(rest, 2, 1))
             .when(rl == 3, F.substring(rest, 3, 1))).try_cast("int")
    d = F.try_make_timestamp(year, month, day, F.lit(0), F.lit(0), F.lit(0)).cast("date")
    return F.coalesce(d, F.lit("1900-01-01").cast("date"))


def ddmmyyyy(col, prefix: str = "") -> Column:
    """SC-20e: ``<prefix>DDMMYYYY`` in a name -> DATE (invalid -> NULL)."""
    pat = prefix + r"(\d{2})(\d{2})(\d{4})"
    return F.try_make_timestamp(F.regexp_extract(as_col(col), pat, 3).try_cast("int"),
                                F.regexp_extract(as_col(col), pat, 2).try_cast("int"),
                                F.regexp_extract(as_col(col), pat, 1).try_cast("int"),
                                F.lit(0), F.lit(0), F.lit(0)).cast("date")


def period_sort_key(col) -> Column:
    """SC-20f: ``ENE 2026 Q1`` -> ``2026-01-Q1``; unknown month -> ``00``;
    fewer than three words -> the text itself."""
    t = F.trim(as_col(col).cast("string"))
    pairs = []
    for i, m in enumerate(MONTHS_ES_ABBR, start=1):
        pairs += [F.lit(m), F.lit(f"{i:02d}")]
    mm = F.coalesce(F.try_element_at(F.create_map(*pairs), F.regexp_extract(t, r"^(\S+)", 1)), F.lit("00"))
    return F.when(t.rlike(r"^\S+\s+\S+\s+\S+"),
                  F.concat_ws("-", F.regexp_extract(t, r"^\S+\s+(\S+)", 1), mm,
                              F.regexp_extract(t, r"^\S+\s+\S+\s+(\S+)", 1))).otherwise(t)
