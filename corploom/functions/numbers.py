"""Number, percent, currency and date translation between English and French, as Column expressions.

Locales are those of Canada: English groups by commas with a decimal point, French by no-break spaces with a decimal comma.
Each translator gives null where its rule doesn't match (and for null), so that they can be coalesced or assembled.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, functions as F

NBSP = " "
_GROUPS = r"(?<=\d)(?=(?:\d{3})+$)"


def group_english(digits: Column) -> Column:
    """``1234567`` as ``1,234,567``."""
    return F.regexp_replace(digits, _GROUPS, ",")


def group_french(digits: Column) -> Column:
    """``1234567`` as ``1 234 567`` with no-break spaces."""
    return F.regexp_replace(digits, _GROUPS, NBSP)


#: (whole part, decimal part) of a number of a language; groups are optional but must be complete.
NUMBER = {"eng": r"(\d{1,3}(?:,\d{3})+|\d+)(?:\.(\d+))?", "fra": r"(\d{1,3}(?:[\s  ]\d{3})+|\d+)(?:,(\d+))?"}
_POINT = {"eng": ".", "fra": ","}
_GROUPED = {"eng": group_english, "fra": group_french}


def _converted(text: Column, pattern: str, first: int, target: str) -> Column:
    """The number in the groups ``first`` and ``first + 1`` of a match, in the form of ``target``; its decimals as written."""
    whole = F.regexp_replace(F.regexp_extract(text, pattern, first), r"\D", "")
    digits = F.regexp_replace(whole, r"^0+(?=\d)", "")
    decimals = F.regexp_extract(text, pattern, first + 1)
    return F.concat(_GROUPED[target](digits), F.when(decimals != "", F.concat(F.lit(_POINT[target]), decimals)).otherwise(""))


def number(text: Column, source: str, target: str) -> Column:
    """A text that is one number. Plain integers are left as they are."""
    p = rf"(?U)^\s*(-?){NUMBER[source]}\s*$"
    return F.when(text.rlike(r"(?U)^\s*\d+\s*$"), text).when(text.rlike(p), F.concat(F.regexp_extract(text, p, 1), _converted(text, p, 2, target)))


def percent(text: Column, source: str, target: str) -> Column:
    """A text that is one percentage; the precision is kept."""
    p = rf"(?U)^\s*(-?){NUMBER[source]}\s*%\s*$"
    return F.when(text.rlike(p), F.concat(F.regexp_extract(text, p, 1), _converted(text, p, 2, target), F.lit("%" if target == "eng" else f"{NBSP}%")))


def currency(text: Column, source: str, target: str, symbol: str = "$") -> Column:
    """``$1,234.50`` and ``1 234,50 $``. Integers stay integers, decimals as written."""
    s = "\\" + symbol
    p = rf"(?U)^\s*(-?)\s*{s}\s*{NUMBER['eng']}\s*$" if source == "eng" else rf"(?U)^\s*(-?){NUMBER['fra']}\s*{s}\s*$"
    value = _converted(text, p, 2, target)
    sign = F.regexp_extract(text, p, 1)
    return F.when(text.rlike(p), F.concat(sign, F.lit(symbol), value) if target == "eng" else F.concat(sign, value, F.lit(f"{NBSP}{symbol}")))


# fixed values: month names
MONTHS = {
    "eng": "January February March April May June July August September October November December".split(),
    "fra": "janvier février mars avril mai juin juillet août septembre octobre novembre décembre".split(),
}


def date(text: Column, source: str, target: str) -> Column:
    """``March 8, 2021`` and ``8 mars 2021``; also ISO dates. A day that doesn't exist gives null."""
    names = "|".join(MONTHS[source])
    if source == "eng":
        p, month, day, year = rf"(?iU)^\s*({names})\s+(\d{{1,2}})(?:st|nd|rd|th)?,?\s+(\d{{4}})\s*$", 1, 2, 3
    else:
        p, month, day, year = rf"(?iU)^\s*(?:le\s+)?(\d{{1,2}})(?:er)?\s+({names})\s+(\d{{4}})\s*$", 2, 1, 3
    number_of = F.create_map(*[F.lit(x) for i, m in enumerate(MONTHS[source]) for x in (m.lower(), i + 1)])
    iso = r"^\s*(\d{4})-(\d{1,2})-(\d{1,2})\s*$"
    part = lambda pattern, g: F.expr("cast(null as string)") if g is None else F.regexp_extract(text, pattern, g)
    y = F.when(text.rlike(p), part(p, year)).when(text.rlike(iso), part(iso, 1))
    m = F.when(text.rlike(p), F.try_element_at(number_of, F.lower(part(p, month)))).when(text.rlike(iso), part(iso, 2).cast("int"))
    d = F.when(text.rlike(p), part(p, day)).when(text.rlike(iso), part(iso, 3))
    day_ = F.try_to_date(F.concat_ws("-", y, F.lpad(m.cast("string"), 2, "0"), F.lpad(d, 2, "0")), "yyyy-MM-dd")
    name = F.get(F.array(*map(F.lit, MONTHS[target])), F.month(day_) - 1)
    out = F.concat(name, F.lit(" "), F.dayofmonth(day_), F.lit(", "), F.year(day_)) if target == "eng" else F.concat(F.dayofmonth(day_), F.lit(" "), name, F.lit(" "), F.year(day_))
    return F.when(day_.isNotNull(), out)


def template(text: Column, rules: list[tuple[str, str]]) -> Column:
    """The first rule whose pattern is found rewrites the text (groups as $1); null if none is."""
    return functools.reduce(lambda c, r: c.when(text.rlike(r[0]), F.regexp_replace(text, r[0], r[1])), rules, F.when(F.lit(False), text))


def assemble(text: Column, translators: list) -> Column:
    """Translators in sequence, each on the last one's output; it stops at the first null and gives the last text that wasn't.

    Null if the first one already gives null.
    """
    state = F.struct(F.lit(None).cast("string").alias("out"), text.alias("at"), F.lit(False).alias("stop"))
    for t in translators:
        after = t(state["at"])
        goes = ~state["stop"] & after.isNotNull()
        state = F.struct(F.when(goes, after).otherwise(state["out"]).alias("out"), F.when(goes, after).otherwise(state["at"]).alias("at"), (~goes).alias("stop"))
    return state["out"]
