"""Column expressions used by the operators.

Everything here returns a ``Column`` built from ``pyspark.sql.functions``, so it runs inside
whole-stage codegen; nothing calls back into Python per row.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------------------------
# Fixed values.
# SAS stores dates as a day count from this day.
SAS_EPOCH = "1960-01-01"
# Text that a lenient cast to double reads as NaN (Java's number parser: optional sign, exact case).
NAN_TEXTS = ("NaN", "+NaN", "-NaN")
# pandas' default missing-value tokens for read_csv (pandas 2.x), in pandas' sorted order.
PANDAS_NA_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
                    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
# English month and day names, as the C locale spells them.
MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August", "September",
          "October", "November", "December")
DAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
# What each date directive of Python's strptime accepts, as a regular expression.
STRPTIME_FIELDS = {
    "Y": r"\d\d\d\d", "y": r"\d\d", "m": r"1[0-2]|0[1-9]|[1-9]",
    "d": r"3[0-1]|[1-2]\d|0[1-9]|[1-9]| [1-9]",
    "j": r"36[0-6]|3[0-5]\d|[1-2]\d\d|0[1-9]\d|00[1-9]|[1-9]\d|0[1-9]|[1-9]",
    "H": r"2[0-3]|[0-1]\d|\d", "I": r"1[0-2]|0[1-9]|[1-9]", "M": r"[0-5]\d|\d",
    "S": r"6[0-1]|[0-5]\d|\d", "f": r"[0-9]{1,6}", "p": "am|pm",
    "b": "|".join(m[:3] for m in MONTHS), "B": "|".join(MONTHS),
    "a": "|".join(d[:3] for d in DAYS), "A": "|".join(DAYS)}
# ---------------------------------------------------------------------------------------------

# Stands before a date that was found in a text.
DATE_MARK = "="

_FLOAT_TYPES = (T.FloatType, T.DoubleType)


def qcol(name: str) -> Column:
    """Column by exact name, safe for names with spaces, dots or hyphens."""
    return F.col("`" + name.replace("`", "``") + "`")


def is_missing(c: Column, data_type: T.DataType) -> Column:
    """True when a value counts as missing: null, NaN for floating types, NaN text for strings.

    Other types (dates, timestamps, booleans, nested) are missing only when null.
    """
    if isinstance(data_type, _FLOAT_TYPES):
        return c.isNull() | F.isnan(c)
    if isinstance(data_type, T.StringType):
        return c.isNull() | F.trim(c).isin(*NAN_TEXTS)
    return c.isNull()


# Type names that mean a whole-number target.
_WHOLE_NAMES = {"tinyint", "byte", "smallint", "short", "int", "integer", "bigint", "long"}


def type_name(target: str | T.DataType) -> str:
    """Spark SQL type name for a cast target; ``varchar(n)`` / ``char(n)`` become string, as Spark
    does not truncate on such a cast."""
    name = target.simpleString() if isinstance(target, T.DataType) else target.strip().lower()
    return "string" if name.startswith(("varchar", "char")) else name


def lenient_cast(c: Column, target: str | T.DataType, source: T.DataType) -> Column:
    """Cast that yields null instead of failing, like a non-ANSI cast.

    Text to a whole-number type also accepts decimal text ('1234.0', '12.7') and truncates it,
    which a plain ``try_cast`` rejects. Overflow, NaN and malformed text give null.

    Text goes to a whole number through ``decimal(38,18)`` (20 integer digits: every bigint),
    which is exact, and also fast: a failed text-to-integer ``try_cast`` costs far more per row
    than a decimal parse.
    """
    to = type_name(target)
    if isinstance(source, T.StringType) and to in _WHOLE_NAMES:
        return c.try_cast("decimal(38,18)").try_cast(to)
    return c.try_cast(to)


def sas_days_to_date(c: Column, zero_is_null: bool = True) -> Column:
    """SAS day count (days since 1960-01-01, numeric) to a date.

    Fractions are floored (so -0.5 is 1959-12-31); null, NaN and counts outside the years 1 to
    9999 give null, and so does 0 unless ``zero_is_null`` is False.
    """
    days = c.try_cast("double")
    first, last = (F.datediff(F.lit(d).cast("date"), F.lit(SAS_EPOCH).cast("date")) for d in ("0001-01-01", "9999-12-31"))
    valid = days.isNotNull() & ~F.isnan(days) & (days >= first) & (days < last + 1)
    if zero_is_null:
        valid = valid & (days != 0)
    return F.when(valid, F.date_add(F.lit(SAS_EPOCH).cast("date"), F.floor(days).try_cast("int")))


def strptime_pattern(fmt: str) -> tuple[str, dict[str, int]]:
    """Regular expression for the whole texts Python's ``strptime`` reads in a format, and the
    group number of each date directive. Unknown or repeated directives raise."""
    out, groups, i = [], {}, 0
    while i < len(fmt):
        if fmt[i] == "%":
            name = fmt[i + 1:i + 2]
            if name == "%":
                out.append("%")
            elif name not in STRPTIME_FIELDS or name in groups:
                raise ValueError(f"unsupported or repeated directive %{name} in {fmt!r}")
            else:
                groups[name] = len(groups) + 1
                out.append(f"({STRPTIME_FIELDS[name]})")
            i += 2
        elif fmt[i].isspace():
            out.append(r"\s+")
            while i < len(fmt) and fmt[i].isspace():
                i += 1
        else:
            out.append(re.escape(fmt[i]))
            i += 1
    return "(?i)^" + "".join(out) + r"\z", groups


def text_to_date(c: Column, strptime_format: str) -> Column:
    """Text in a Python ``strptime`` format to a date; null, empty and malformed text give null.

    As in Python, numbers need no leading zeros, names ignore case, two-digit years from 69 on
    are in the 1900s, a missing year is 1900 and a missing month or day 1; times, weekdays and
    their like must fit the format but do not matter for the date. Formats with directives that
    are not dates or times of day (``%U``, ``%z``, ...) raise when the column is built.
    """
    pattern, groups = strptime_pattern(strptime_format)
    if groups.keys() & {"Y", "y"} and not groups.keys() & {"b", "B", "j"}:
        return _numbers_to_date(c, strptime_format)

    def field(name: str) -> Column:
        return F.regexp_extract(c, pattern, groups[name])

    if "Y" in groups:
        year = field("Y")
    elif "y" in groups:
        year = F.concat(F.when(field("y") >= "69", "19").otherwise("20"), field("y"))
    else:
        year = F.lit("1900")
    if "b" in groups or "B" in groups:
        short = F.lower(F.substring(field("b" if "b" in groups else "B"), 1, 3))
        month = F.create_map(*[F.lit(x) for k, m in enumerate(MONTHS) for x in (m[:3].lower(), str(k + 1))])[short]
    else:
        month = field("m") if "m" in groups else F.lit("1")
    whole = F.when(c.rlike(pattern), year) if not groups.keys() & {"Y", "y"} else year
    if "j" in groups and not groups.keys() & {"m", "b", "B", "d"}:
        start = F.try_to_date(F.concat(whole, F.lit("-1-1")), "y-M-d")
        return F.when(c != "", F.date_add(start, field("j").try_cast("int") - 1))
    day = F.ltrim(field("d")) if "d" in groups else F.lit("1")
    return F.when(c != "", F.try_to_date(F.concat_ws("-", whole, month, day), "y-M-d"))


def _numbers_to_date(c: Column, strptime_format: str) -> Column:
    """``text_to_date`` for a format whose year, month and day are numbers: one run of the pattern
    puts them in the order year-month-day behind a mark, and text without the mark is no date."""
    pattern, groups = strptime_pattern(strptime_format)
    # a day's padding blank must stay outside of its group; the groups after it move up by one
    day = STRPTIME_FIELDS["d"]
    digits = day.removesuffix("| [1-9]")
    pattern = pattern.replace(f"({day})", f"(?:({digits})| ([1-9]))")
    at = {name: n + ("d" in groups and n > groups["d"]) for name, n in groups.items()}
    parts = [f"${at['Y' if 'Y' in groups else 'y']}",
             f"${at['m']}" if "m" in groups else "1",
             f"${at['d']}${at['d'] + 1}" if "d" in groups else "1"]
    found = F.regexp_replace(c, pattern, DATE_MARK + "-".join(parts))
    date = F.try_to_date(F.when(~c.startswith(DATE_MARK), found), f"'{DATE_MARK}'{'y' if 'Y' in groups else 'yy'}-M-d")
    if "Y" in groups:
        return date
    # two digits are read as 2000 to 2099; from 69 on they mean the century before
    return F.when(F.year(date) >= 2069, F.add_months(date, -1200)).otherwise(date)


def code_label(c: Column, labels: Mapping[object, str]) -> Column:
    """Map codes to labels with no default: an unknown or null code gives null."""
    expr = None
    for code, label in labels.items():
        expr = F.when(c == code, F.lit(label)) if expr is None else expr.when(c == code, F.lit(label))
    return expr if expr is not None else F.lit(None).cast("string")


def resolve_names(columns: Iterable[str], wanted: Iterable[str]) -> list[str]:
    """The table's spelling of each wanted column, ignoring case; an unknown name raises."""
    known = {c.lower(): c for c in columns}
    unknown = [w for w in wanted if w.lower() not in known]
    if unknown:
        raise ValueError(f"unknown columns {unknown}")
    return [known[w.lower()] for w in wanted]


def null_tokens(c: Column, tokens: Iterable[str] = PANDAS_NA_TOKENS) -> Column:
    """Null when the text equals one of the tokens exactly (no trimming), else the text."""
    return F.when(~c.isin(*tokens), c)


__all__ = ["SAS_EPOCH", "NAN_TEXTS", "PANDAS_NA_TOKENS", "MONTHS", "DAYS", "STRPTIME_FIELDS", "qcol", "is_missing",
           "type_name", "lenient_cast", "sas_days_to_date", "strptime_pattern", "text_to_date",
           "code_label", "null_tokens", "resolve_names"]
