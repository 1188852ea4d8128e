"""Text to typed columns. Text that does not parse becomes NULL, never an error.

Each takes the name of a text column. The expressions are SQL text: cleaning builds some fifty of
them, and a column object costs a call to the JVM per operator where an expression costs one.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _number_sql(text: str) -> str:
    # The cast alone would also take Java spellings such as 1.5d or 0x1p3; those are not numbers
    # in a loan extract, whereas 'inf' and 'Infinity' are. One short pattern per column: with some
    # forty columns in a projection, the size of the generated code costs more than the search.
    return f"try_cast(if({text} RLIKE '^[^iI]*[dDfFxX]', NULL, {text}) AS double)"


def number(column: str) -> Column:
    """Decimal text as double."""
    return F.expr(_number_sql(column))


def percent(column: str) -> Column:
    """``'13.5%'`` as 13.5."""
    return F.expr(_number_sql(f"trim(replace({column}, '%', ''))"))


def _first_integer_sql(text: str) -> str:
    return f"try_cast(regexp_extract({text}, '([0-9]+)', 1) AS int)"


def first_integer(column: str) -> Column:
    """The first run of digits, e.g. ``' 36 months'`` as 36."""
    return F.expr(_first_integer_sql(column))


def employment_years(column: str) -> Column:
    """``'< 1 year'`` as 0, ``'10+ years'`` as 10, otherwise the digits; ``'n/a'`` as NULL."""
    return F.expr(f"CASE WHEN contains({column}, '< 1') THEN 0 WHEN contains({column}, '10+') "
                  f"THEN 10 ELSE {_first_integer_sql(column)} END")


def month_stamp(column: str) -> Column:
    """``'Dec-2015'`` as the first instant of that month."""
    return F.expr(f"try_to_timestamp(trim({column}), 'MMM-yyyy')")


def vintage_label(year: str, quarter: str) -> Column:
    """``2016Q4``; NULL if either part is."""
    return F.expr(f"concat({year}, 'Q', {quarter})")


def months_between(start: str, end: str) -> Column:
    """Month boundaries crossed, so that Jan 31 to Mar 1 counts two."""
    return F.expr(f"bigint((year({end}) - year({start})) * 12 + month({end}) - month({start}))")
