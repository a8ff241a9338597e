"""Readings of values written by people: numbers, dates, yes and no. Null where a text is none."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER = "decimal(38,8)"
#: Digits with separators: groups by comma, by space or apostrophe, or by point with a decimal comma; or none.
_GROUPED_COMMA = r"^(\d{1,3}(,\d{3})+|\d+)?(\.\d*)?$"
_GROUPED_SPACE = r"^\d{1,3}([ ']\d{3})+([.,]\d+)?$"
_GROUPED_POINT = r"^(\d{1,3}(\.\d{3})+,\d+|\d{1,3}(\.\d{3}){2,}|\d+,\d+)$"
_DATES = ("yyyy-M-d", "yyyy/M/d", "MMMM d, yyyy", "MMM d, yyyy", "d MMMM yyyy", "d MMM yyyy", "M/d/yyyy")


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` worked out once, however often it is named."""
    return F.transform(F.array(value), use)[0]


def number(text: Column) -> Column:
    """A number in a usual written form: separators, a currency sign or code, brackets or a minus, a percent sign (divided by 100)."""
    money = r"(?:[$€£¥]|[A-Z]{3}\b)?"
    parts = rf"^([+-]?) ?{money} ?([+-]?) ?([0-9][0-9,.' ]*|\.[0-9]+) ?(-?) ?{money} ?(%?)$"

    def read(t: Column, bracketed: Column) -> Column:
        def value(body: Column) -> Column:
            plain = (
                F.when(body.rlike(_GROUPED_COMMA), F.replace(body, F.lit(","), F.lit("")))
                .when(body.rlike(_GROUPED_SPACE), F.replace(F.regexp_replace(body, "[ ']", ""), F.lit(","), F.lit(".")))
                .when(body.rlike(_GROUPED_POINT), F.replace(F.replace(body, F.lit("."), F.lit("")), F.lit(","), F.lit(".")))
            )
            return F.when(body != "", plain).try_cast(NUMBER)

        minus = bracketed | F.concat(*[F.regexp_extract(t, parts, i) for i in (1, 2, 4)]).contains("-")
        scale = F.when(F.regexp_extract(t, parts, 5) == "%", 100).otherwise(1) * F.when(minus, -1).otherwise(1)
        return (_let(F.rtrim(F.regexp_extract(t, parts, 3)), value) / scale).cast(NUMBER)

    clean = F.trim(F.regexp_replace(F.regexp_replace(text, r"[\s\u00a0\u2009\u202f\u2007]+", " "), "[\u2212\u2013]", "-"))
    return _let(clean, lambda t: F.when(t.rlike(r"^\(.*\)$"), read(F.trim(F.regexp_extract(t, r"^\((.*)\)$", 1)), F.lit(True))).otherwise(read(t, F.lit(False))))


def date(text: Column) -> Column:
    """A calendar date in one of the usual forms."""
    return _let(F.trim(F.regexp_replace(text, r"\s+", " ")), lambda t: F.coalesce(*[F.try_to_timestamp(t, F.lit(p)).cast("date") for p in _DATES]))


def boolean(text: Column) -> Column:
    t = F.lower(F.trim(text))
    return F.when(t.isin("true", "yes"), True).when(t.isin("false", "no"), False)


def filled(text: Column) -> Column:
    """The text, or null where it is blank."""
    return F.when(F.trim(F.regexp_replace(text, r"[\s ]+", " ")) != "", text)
