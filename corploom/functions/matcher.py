"""Orthographic matching of a target text to its reference (English and French)."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from corploom.functions.normalize import NBSP, quotes_french

# Marks of the two languages that stand for one another; opening and closing quotes differ by side.
PUNCTUATION = ".,;:!?…-–—"
QUOTES = {("eng", "fra", "first"): {'"': "«", "“": "«", "”": "»"}, ("eng", "fra", "last"): {'"': "»", "“": "«", "”": "»"}, ("fra", "eng", "first"): {"«": '"', "»": '"'}, ("fra", "eng", "last"): {"«": '"', "»": '"'}}
# Names that stay in capitals.
CAPITALS = ("BMO", "BNP", "CIBC", "HSBC", "RBC", "TD", "TSX", "UBS")


def _marks(ref: str, tgt: str, end: str) -> tuple[dict[str, str], str]:
    """Marks of the reference with their counterparts, and the marks of the target."""
    same = {m: m for m in PUNCTUATION}
    back = QUOTES[tgt, ref, end]
    return same | QUOTES[ref, tgt, end], PUNCTUATION + "".join(back)


def match_end(reference: Column, target: Column, ref: str = "eng", tgt: str = "fra", end: str = "first") -> Column:
    """The first (or last) mark of the target agrees with the reference's: deleted, added or left alone."""
    mapping, marks = _marks(ref, tgt, end)
    side = F.left if end == "first" else F.right
    r, t = side(reference, F.lit(1)), side(target, F.lit(1))
    want = F.try_element_at(F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv]), r)
    marked = t.isin(list(marks))
    run = f"[{re.escape(marks)}]"
    cut = F.regexp_replace(target, rf"^({run})\1*(?=.)" if end == "first" else rf"(?<=.)({run})\1*$", "")
    joined = F.concat(want, target) if end == "first" else F.concat(target, want)
    out = (
        F.when(want.isNull() & marked, cut)
        .when(want.isNotNull() & (~marked | (t != want)) & ~F.contains(target, want), joined)
        .otherwise(target)
    )
    return F.regexp_replace(out, rf"^«(?=[^{NBSP}])", f"«{NBSP}") if end == "first" else F.regexp_replace(out, rf"(?<=[^{NBSP}])»$", f"{NBSP}»")


@F.pandas_udf(T.StringType())
def match_brackets(references: pd.Series, targets: pd.Series) -> pd.Series:
    """A bracket that the target lost around a word that the reference has in brackets is put back."""

    def one(ref: str | None, tgt: str | None) -> str | None:
        if ref is None or tgt is None:
            return tgt
        for left, right in ("()", "[]", "{}"):
            for word in re.findall(rf"{re.escape(left)}([^\W_]+){re.escape(right)}", ref):
                if f"{left}{word}{right}" in tgt:
                    continue
                closed, opened = re.compile(rf"(?<![^\W_]){re.escape(word + right)}"), re.compile(rf"{re.escape(left + word)}(?![^\W_])")
                if closed.search(tgt):
                    tgt = closed.sub(lambda m: left + m.group(), tgt, count=1)
                elif opened.search(tgt):
                    tgt = opened.sub(lambda m: m.group() + right, tgt, count=1)
        return tgt

    return pd.Series([one(r, t) for r, t in zip(references, targets)])


_RAISED, _PLAIN = "⁰¹²³⁴⁵⁶⁷⁸⁹⁽⁾", "0123456789()"


def match_reference_number(reference: Column, target: Column, ref: str = "eng", tgt: str = "fra") -> Column:
    """``text (1)`` becomes ``text ¹⁾`` in French if the English reference ends in the same raised number."""
    if (ref, tgt) != ("eng", "fra"):
        return target
    mark = F.regexp_extract(reference, r".(⁽[⁰¹²³⁴⁵⁶⁷⁸⁹]+⁾)$", 1)
    p = r"^(.+?)(\([0-9]+\)|⁽[⁰¹²³⁴⁵⁶⁷⁸⁹]+⁾)$"
    same = F.translate(F.regexp_extract(target, p, 2), _PLAIN, _RAISED) == mark
    return F.when((mark != "") & target.rlike(p) & same, F.concat(F.regexp_extract(target, p, 1), F.substring(mark, 2, 100))).otherwise(target)


def match_number_symbol(reference: Column, target: Column, ref: str = "eng", tgt: str = "fra") -> Column:
    """A lone # (or nᵇʳᵉ), and ``no. 1`` against ``n° 1``, in the form of the target language."""
    lone = r"^((?:[^#]*\s)?)#(\s[^#]+)$"
    word = r"(?iU)(^|\s)(?:no\.|n ?°)\s*(\d+)(?=\W|$)"
    if (ref, tgt) == ("eng", "fra"):
        out = F.when(reference.rlike(lone) & target.rlike(lone), F.regexp_replace(target, lone, "$1nᵇʳᵉ$2")).otherwise(target)
        form = "$1n° $2"
    else:
        raised = r"(?iU)^((?:.*?\s)?)nᵇʳᵉ(\s.+)$"
        out = F.when(reference.rlike(raised) & target.rlike(raised), F.regexp_replace(target, raised, "$1number$2")).otherwise(target)
        form = "$1no. $2"
    n = F.regexp_count(out, F.lit(word))
    return F.when((n > 0) & (n == F.regexp_count(reference, F.lit(word))), F.regexp_replace(out, word, form)).otherwise(out)


def match_case(reference: Column, target: Column) -> Column:
    """The first letter gets the case of the reference's; names in capitals stay."""
    letter = r"(?U)^[\w&&[^0-9]]"
    first = F.left(target, F.lit(1))
    both = reference.rlike(letter) & target.rlike(letter) & ~F.regexp_extract(target, r"(?U)^(\S+)", 1).isin(list(CAPITALS))
    upper = F.left(reference, F.lit(1)).rlike(r"(?U)^\p{Lu}")
    return F.when(both, F.concat(F.when(upper, F.upper(first)).otherwise(F.lower(first)), F.substring(target, F.lit(2), F.length(target)))).otherwise(target)


def match_forms(df: DataFrame, reference: str, target: str, out: str = "out", ref: str = "eng", tgt: str = "fra") -> DataFrame:
    """All matchers in order, as the column ``out``; one projection each, so that no expression is repeated.

    Tags of the reference are dropped; an empty or null target becomes the reference; without a reference the target stays.
    """
    r, o = F.col("_ref"), F.col("_out")
    steps = [
        lambda: match_end(r, o, ref, tgt, "first"), lambda: match_end(r, o, ref, tgt, "last"), lambda: F.when(r.rlike(r"[(\[{]"), match_brackets(r, o)).otherwise(o),
        lambda: match_reference_number(r, o, ref, tgt), lambda: match_number_symbol(r, o, ref, tgt), lambda: match_case(r, o), *([lambda: quotes_french(o)] if tgt == "fra" else []),
    ]
    kept = df.columns
    now = df.withColumn("_ref", F.regexp_replace(reference, "<[^>]+>", "")).withColumn("_out", F.col(target))
    for step in steps:
        now = now.select(*kept, "_ref", step().alias("_out"))
    result = F.when(F.coalesce(F.col(target), F.lit("")) == "", r).when(F.coalesce(r, F.lit("")) == "", F.col(target)).otherwise(o)
    return now.select(*[c for c in kept if c != out], result.alias(out))
