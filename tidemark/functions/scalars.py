"""Column expressions: typed casts of text, cleaning, calendar arithmetic on YYMM numbers, safe division.

All of them stay in whole-stage code; none raises on bad input under ANSI mode.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Text that stands for a missing value, by cast.
INT_NULLS = ("", "NULL", "NAN", "N/A", "NONE")
DECIMAL_NULLS = ("", "NULL", "NAN", "N/A")
STRING_NULLS = ("", "NULL", "NAN", "N/A", "NONE", "#N/A")
LABEL_NULLS = ("", "nan", "none", "nat", "<na>")
TIME_NULLS = ("", "null", "nan")
TRUE_WORDS = ("T", "TRUE", "Y", "YES", "1")
FALSE_WORDS = ("F", "FALSE", "N", "NO", "0")

#: Timestamp formats in the order they are tried, as (pattern, years have two digits, shape of the text).
TIME_FORMATS = (
    ("yyyy-M-d H:m:s.SSSSSS", False, r"\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}\.\d{1,6}"),
    ("yy-M-d H:m:s", True, r"\d{2}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}"),
    ("yy-M-d", True, r"\d{2}-\d{1,2}-\d{1,2}"),
    ("yy/M/d H:m:s", True, r"\d{2}/\d{1,2}/\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}"),
    ("yy/M/d", True, r"\d{2}/\d{1,2}/\d{1,2}"),
    ("d/M/yy H:m:s", True, r"\d{1,2}/\d{1,2}/\d{2} \d{1,2}:\d{1,2}:\d{1,2}"),
    ("d/M/yy", True, r"\d{1,2}/\d{1,2}/\d{2}"),
    ("d-M-yy H:m:s", True, r"\d{1,2}-\d{1,2}-\d{2} \d{1,2}:\d{1,2}:\d{1,2}"),
    ("d-M-yy", True, r"\d{1,2}-\d{1,2}-\d{2}"),
    ("yyyy-M-d H:m:s", False, r"\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}"),
    ("yyyy-M-d", False, r"\d{4}-\d{1,2}-\d{1,2}"),
    ("yyyy/M/d H:m:s", False, r"\d{4}/\d{1,2}/\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}"),
    ("yyyy/M/d", False, r"\d{4}/\d{1,2}/\d{1,2}"),
    ("d/M/yyyy H:m:s", False, r"\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{1,2}:\d{1,2}"),
    ("d/M/yyyy", False, r"\d{1,2}/\d{1,2}/\d{4}"),
    ("d-M-yyyy H:m:s", False, r"\d{1,2}-\d{1,2}-\d{4} \d{1,2}:\d{1,2}:\d{1,2}"),
    ("d-M-yyyy", False, r"\d{1,2}-\d{1,2}-\d{4}"),
)

_SPACE = " \t\n\r\f\v"


def strip(c: Column) -> Column:
    """Without white space at both ends."""
    return F.btrim(c, F.lit(_SPACE))


def to_int(c: Column) -> Column:
    """Whole number from text: words for true and false, else all characters but digits and ``-`` are dropped."""
    s = F.upper(strip(c))
    digits = F.regexp_replace(s, r"[^\d\-]", "")
    return (
        F.when(s.isNull() | s.isin(*INT_NULLS), None)
        .when(s.isin(*TRUE_WORDS), F.lit(1))
        .when(s.isin(*FALSE_WORDS), F.lit(0))
        .otherwise(digits.try_cast("long"))
    )


def to_decimal(c: Column, scale: int = 3, precision: int = 18) -> Column:
    """Decimal from text with point or comma, rounded to ``scale`` places."""
    s = F.upper(strip(c))
    number = F.regexp_replace(F.replace(s, F.lit(","), F.lit(".")), r"[^\d.\-]", "")
    return F.when(s.isNull() | s.isin(*DECIMAL_NULLS), None).otherwise(
        F.round(number.try_cast("double"), scale).try_cast(f"decimal({precision},{scale})")
    )


def to_timestamp_any(c: Column) -> Column:
    """First format of ``TIME_FORMATS`` that parses; wall-clock time to the second. Two-digit years 69 to 99 are 19xx."""
    s = strip(c)
    tries = []
    for pattern, short, shape in TIME_FORMATS:
        t = F.try_to_timestamp(s, F.lit(pattern))
        if short:
            t = F.when(F.year(t) % 100 >= 69, t - F.expr("INTERVAL 100 YEARS")).otherwise(t)
        tries.append(F.when(s.rlike(f"^{shape}$"), t))
    parsed = F.date_trunc("second", F.coalesce(*tries)).cast("timestamp_ntz")
    return F.when(F.lower(s).isin(*TIME_NULLS), None).otherwise(parsed)


def to_report_month(c: Column) -> Column:
    """Date part of ``to_timestamp_any``."""
    return F.to_date(to_timestamp_any(c))


def clean_string(c: Column) -> Column:
    s = strip(c)
    return F.when(F.upper(s).isin(*STRING_NULLS), None).otherwise(s)


def clean_label_cell(c: Column) -> Column:
    s = strip(c)
    return F.when(F.lower(s).isin(*LABEL_NULLS), None).otherwise(s)


#: Fixed value: what is blanked in free text.
FREE_TEXT_PATTERN = r"[0-9]{8}|\\n|\\r\\n|\\r|[\r\n\x{2028}\x{2029}]|\\\\"


def clean_free_text(c: Column) -> Column:
    """Blank 8-digit runs and line breaks (real or written out), collapse white space; empty becomes null."""
    blanked = F.regexp_replace(c, FREE_TEXT_PATTERN, " ")
    return F.nullif(strip(F.regexp_replace(blanked, r"\s+", " ")), F.lit(""))


def pseudonymise_key(c: Column, salt: str) -> Column:
    """Stable one-way code of a key: ``ENC_`` and 16 hex digits; blank is null."""
    s = F.upper(strip(c))
    return F.when(s != "", F.concat(F.lit("ENC_"), F.upper(F.substring(F.md5(F.concat(s, F.lit(salt))), 1, 16))))


def null_key(c: Column) -> Column:
    """Key without surrounding blanks; blank is null."""
    return F.nullif(F.trim(c), F.lit(""))


def safe_ratio(a: Column, b: Column) -> Column:
    """a / b, or 0 where that is undefined."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def safe_div(a: Column, b: Column) -> Column:
    """a / b of values that may be text; null where either isn't a number, b is 0 or the result isn't finite."""
    q = F.try_divide(a.try_cast("double"), b.try_cast("double"))
    return F.when(F.isnan(q) | (F.abs(q) == float("inf")), None).otherwise(q)


def finite(c: Column) -> Column:
    """Double value; null for what isn't a finite number."""
    d = c.try_cast("double")
    return F.when(~F.isnan(d) & (F.abs(d) != float("inf")), d)


def bucket(value: Column, steps: Sequence[tuple[float, str]], low: str) -> Column:
    """Label of the first step whose bound is at most the value; steps from high to low."""
    out = None
    for bound, label in steps:
        out = F.when(value >= bound, label) if out is None else out.when(value >= bound, label)
    return out.otherwise(low)


def yymm(date: Column) -> Column:
    """YYMM number of a date."""
    return ((F.year(date) % 100) * 100 + F.month(date)).cast("int")


def add_months_yymm(c: Column, n: Column | int) -> Column:
    """YYMM number ``n`` months on (back if negative), within the century 2000-2099."""
    months = F.floor(c / 100) * 12 + (c % 100) - 1 + (F.lit(n) if isinstance(n, int) else n)
    return (F.pmod(F.floor(months / 12), F.lit(100)) * 100 + F.pmod(months, F.lit(12)) + 1).cast("int")


def months_diff(a: Column, b: Column) -> Column:
    """Months from YYMM ``b`` to YYMM ``a``."""
    return ((F.floor(a / 100) - F.floor(b / 100)) * 12 + (a % 100) - (b % 100)).cast("int")


def first_label(pairs: Sequence[tuple[str, Column]], default: str) -> Column:
    """Label of the greatest value; the first wins ties; ``default`` if all are null."""
    top = F.greatest(*[v for _, v in pairs])
    out = None
    for label, v in pairs:
        out = F.when(v >= top, label) if out is None else out.when(v >= top, label)
    return F.coalesce(out, F.lit(default))
