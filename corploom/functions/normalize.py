"""Text normalization as Column -> Column functions.

Every normalizer is a table of (pattern, replacement) rules that are applied in order by ``regexp_replace``, so a chain of
them stays one projection inside the JVM. Patterns are Java ones with ``(?U)``: \\w, \\s, \\b and \\d follow Unicode.
A null text stays null and an empty one stays empty everywhere.
"""

from __future__ import annotations

import functools
import html
import unicodedata
from collections.abc import Callable
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from corploom.functions.numbers import group_french

Rules = list[tuple[str, str]]
NBSP = " "


def apply_rules(text: Column, rules: Rules) -> Column:
    return functools.reduce(lambda c, r: F.regexp_replace(c, r[0], r[1]), rules, text)


def trim_unicode(text: Column) -> Column:
    """Without white space of any kind at the ends."""
    return apply_rules(text, [(r"(?U)^\s+|\s+$", "")])


# ---- rule tables -------------------------------------------------------------------------------------------------------

_PERCENT = r"[%٪％](?=\W|$)"
PERCENT: Rules = [(rf"(?U)(?<=\s|^)(\d+(?:\.\d+)?)\s+(?={_PERCENT})", "$1")]
PERCENT_ENGLISH: Rules = [(rf"(?U)(?<=\s|^)(\d+(?:\.\d+)?)\s*{_PERCENT}", "$1%")]
PERCENT_FRENCH: Rules = [(rf"(?U)(?<=\s|^)(\d+(?:,\d+)?)\s*{_PERCENT}", f"$1{NBSP}%")]
DOLLAR: Rules = [(r"(?U)(?<=[\p{L}\p{N}]|^)\s*(\$\d*)\s*(?=\S|$)", " $1 ")]
SPACES_LATIN: Rules = [(r"(?U)[\s&&[^ ]]+", " "), (r"(?U)^\s+|\s+$", "")]

# fixed values: month and weekday names that English writes with a capital ("march" and "may" are words as well)
NAMES = "january february april june july august september october november december monday tuesday wednesday thursday friday saturday sunday".split()
CAPITALS_ENGLISH: Rules = [(rf"(?U)\b{name}\b", name.capitalize()) for name in NAMES]

_WORD = r"(?=[\w&&[^\d]])"


def _around(before: str, marks: str, after: str, put: str) -> tuple[str, str]:
    """Marks with the blanks around them, between two contexts, are rewritten."""
    return rf"(?U){before}\s*([{marks}])\s*{after}", put


PUNCTUATION_LATIN: Rules = [_around("^", ",;:…!?.", _WORD, "$1 "), _around(r"(?<=\S)", ",;:…!?.", _WORD, "$1 "), _around(r"(?<=\S)", ",;:…!?.", r"\z", "$1")]
PUNCTUATION_FRENCH: Rules = [
    _around("^", ",;:…!?.", _WORD, "$1 "), _around(r"(?<=\S)", ",;…!?.", _WORD, "$1 "), _around(r"(?<=\S)", ":", _WORD, f"{NBSP}$1 "),
    _around(r"(?<=\S)", ",;…!?.", r"\z", "$1"), _around(r"(?<=\S)", ":", r"\z", f"{NBSP}$1"),
]
PUNCTUATION_ARABIC: Rules = [_around(r"(?<=\w)", ".،؟؛:!…", r"(?!\d)(?=\w)", "$1 "), _around(r"(?<=\w)", ".،؟؛:!…", r"\z", "$1")]

_CJK_MARK = r"[　-〿＀-／：-＠［-｀｛-･“”‘’…—]"
_HAN = r"[一-鿿㐀-䶿]"
_KANA_HAN = r"[一-鿿㐀-䶿぀-ヿ]"


def _no_blank_at_marks(character: str) -> Rules:
    return [(r"(?U)\s+", " "), (rf"(?<={_CJK_MARK}) (?={character}|{_CJK_MARK})|(?<={character}) (?={_CJK_MARK})", ""), (r"(?U)^\s+|\s+$", "")]


PUNCTUATION_CHINESE: Rules = _no_blank_at_marks(_HAN)
PUNCTUATION_JAPANESE: Rules = _no_blank_at_marks(_KANA_HAN)
SPACES_CHINESE: Rules = [(r"(?U)\s+", " "), (rf"(?<={_HAN}) (?={_HAN})", ""), (r"(?U)^\s+|\s+$", "")]
#: A blank between a Chinese character and a half-width letter or digit.
SPACES_CHINESE_HALFWIDTH: Rules = [(rf"(?<={_HAN})(?=[A-Za-z0-9])|(?<=[A-Za-z0-9])(?={_HAN})", " ")]


def _inside(left: str, right: str, pad: str = "") -> Rules:
    """No blanks (or ``pad``) inside a pair of marks that encloses anything but these marks."""
    a, b, no = f"\\{left}", f"\\{right}", f"[^\\{left}\\{right}]"
    return [(rf"(?U){a}\s*((?=\S){no}*?)\s*{b}", f"{_literal(left)}{pad}$1{pad}{_literal(right)}")]


def _literal(text: str) -> str:
    return text.replace("\\", r"\\").replace("$", r"\$")


QUOTES_LATIN: Rules = _inside('"', '"') + _inside("“", "”")
QUOTES_FRENCH: Rules = _inside("«", "»", NBSP)
QUOTES_CHINESE: Rules = _inside("“", "”")
QUOTES_JAPANESE: Rules = _inside("「", "」") + _inside("『", "』")
BRACKETS_LATIN: Rules = _inside("(", ")")
BRACKETS_CHINESE: Rules = _inside("（", "）") + _inside("〈", "〉") + _inside("《", "》") + _inside("【", "】")
BRACKETS_JAPANESE: Rules = _inside("（", "）") + _inside("<", ">") + _inside("[", "]") + _inside("【", "】")

CONTRACTIONS_ENGLISH: Rules = [(r"(?U)(?<=[a-zA-Z])\s*([’'])\s*(t|m|ll|ve|s|re|d)(?=\W)", "$1$2"), (r"(?U)(?<=[a-zA-Z]s)\s*([’'])(?=\W)", "$1")]
CONTRACTIONS_FRENCH: Rules = [(r"(?U)(?<=\w)\s*(['’])\s*(?=\w)", "$1")]
# fixed values: French words that elide
ELISIONS = "jusqu lorsqu puisqu quoiqu qu c j n m t s l d".split()
APOSTROPHE_FRENCH: Rules = [(rf"(?iU)\b({'|'.join(ELISIONS)})'(?=\p{{L}})", "$1’")]
GUILLEMETS_TO_QUOTES: Rules = [("[«»]", '"')]
GUILLEMETS_TO_QUOTES_PAIRED: Rules = [("«([^«»]+)»", '"$1"')]
QUOTES_TO_GUILLEMETS_PAIRED: Rules = [("[“\"]([^“”\"]+)[\"”]", "«$1»")]

#: Combining accents and the spacing marks that stand for them, with the letters each may sit on.
ACCENTS = {"́": ("´", "Ee"), "̀": ("`", "AaEeUu"), "̂": ("ˆ", "AaEeIiOoUu"), "̈": ("¨", "EeIiUuYy"), "̧": ("¸", "Cc")}
ALPHABET_FRENCH: Rules = [
    *[(mark, spacing) for mark, (spacing, _) in ACCENTS.items()],
    (r"(?iU)(?<=\w)(?<!des)(?<!n'a)\s+´\s+(?=e)", "´"),
    (r"(?iU)(?<![\p{L}\p{N}]des)(\s+´)\s+(?=e)", "$1"),
    (r"(?U)([eE])\s+´\s+(?![eE])", "´$1"),
    (r"(?U)([eE])\s*`\s*(?![eE])", "`$1"),
    # the composed letters follow from Unicode's own canonical composition
    *[(spacing + letter, unicodedata.normalize("NFC", letter + mark)) for mark, (spacing, letters) in ACCENTS.items() for letter in letters],
]
STRAY_ENTITY: Rules = [(r"(?U)(?<=\s|^)&\w+;(?=\s|$)", "")]
CAT_TAGS: Rules = [(r"(?U)\{\w{1,2}>|<\w{1,2}\}", " "), (r"(?U)\s+", " "), (r"(?U)^\s+|\s+$", ""), (r"(?U)\{\d{1,2}\}", "")]


# ---- functions ----------------------------------------------------------------------------------------------------------


def _rule_function(rules: Rules, doc: str) -> Callable[[Column], Column]:
    def f(text: Column) -> Column:
        return apply_rules(text, rules)

    f.__doc__ = doc
    return f


percentages = _rule_function(PERCENT, "A number and its percent sign are joined; the sign is kept.")
percentages_english = _rule_function(PERCENT_ENGLISH, "``12 ％`` becomes ``12%``.")
percentages_french = _rule_function(PERCENT_FRENCH, "``12,5%`` becomes ``12,5 %`` with a no-break space.")
dollar_spaces = _rule_function(DOLLAR, "One blank on both sides of a dollar sign (with its digits) after a letter, a digit or at the start.")
word_spaces_latin = _rule_function(SPACES_LATIN, "White space but no-break spaces becomes one blank; trimmed.")
capitals_english = _rule_function(CAPITALS_ENGLISH, "Month and weekday names get capitals; march and may are left alone.")
punctuation_latin = _rule_function(PUNCTUATION_LATIN, "No blank before a mark, one after it where a word follows.")
punctuation_french = _rule_function(PUNCTUATION_FRENCH, "As for Latin texts, but a no-break space before a colon.")
punctuation_arabic = _rule_function(PUNCTUATION_ARABIC, "As for Latin texts, with the Arabic marks.")
punctuation_chinese = _rule_function(PUNCTUATION_CHINESE, "No blank between a Chinese character and a Chinese mark.")
punctuation_japanese = _rule_function(PUNCTUATION_JAPANESE, "No blank between a Japanese character and a Japanese mark.")
quotes_latin = _rule_function(QUOTES_LATIN, "No blanks inside straight and curly double quotes.")
quotes_french = _rule_function(QUOTES_FRENCH, "No-break spaces inside guillemets.")
quotes_chinese = _rule_function(QUOTES_CHINESE, "No blanks inside curly double quotes.")
quotes_japanese = _rule_function(QUOTES_JAPANESE, "No blanks inside corner brackets.")
brackets_latin = _rule_function(BRACKETS_LATIN, "No blanks inside round brackets.")
brackets_chinese = _rule_function(BRACKETS_CHINESE, "No blanks inside full-width and angle brackets.")
brackets_japanese = _rule_function(BRACKETS_JAPANESE, "No blanks inside full-width, angle and square brackets.")
contractions_english = _rule_function(CONTRACTIONS_ENGLISH, "``I ' ve`` becomes ``I've``; ``students ' room`` becomes ``students' room``.")
contractions_french = _rule_function(CONTRACTIONS_FRENCH, "``l ' eau`` becomes ``l'eau``.")
apostrophe_french = _rule_function(APOSTROPHE_FRENCH, "The straight apostrophe of an elision becomes a curly one.")
alphabet_french = _rule_function(ALPHABET_FRENCH, "Detached accents are composed with their letters.")
cat_tags = _rule_function(CAT_TAGS, "Translation-tool tags (``{1>``, ``<1}``, ``{1}``) are deleted and white space is collapsed.")


def word_spaces_chinese(text: Column, halfwidth: bool = True) -> Column:
    """No blank between two Chinese characters; with ``halfwidth`` one between a Chinese and a half-width letter or digit."""
    out = apply_rules(text, SPACES_CHINESE)
    return apply_rules(out, SPACES_CHINESE_HALFWIDTH) if halfwidth else out


def quotes_english(text: Column, single: bool = True) -> Column:
    """Guillemets become straight quotes: each of them, or only pairs."""
    return apply_rules(text, GUILLEMETS_TO_QUOTES if single else GUILLEMETS_TO_QUOTES_PAIRED)


def quotes_to_guillemets(text: Column, single: bool = True) -> Column:
    """Quotes become guillemets with no-break spaces inside; a lone straight quote is resolved by its free side."""
    out = apply_rules(text, QUOTES_TO_GUILLEMETS_PAIRED)
    if single:
        out = F.translate(out, "“”", "«»")
        lone = F.length(out) - F.length(F.replace(out, F.lit('"'), F.lit(""))) == 1
        out = (
            F.when(lone & out.rlike(r'(?U)(^|\s)"\S'), F.replace(out, F.lit('"'), F.lit(f"«{NBSP}")))
            .when(lone & out.rlike(r'(?U)\S"($|\s)'), F.replace(out, F.lit('"'), F.lit(f"{NBSP}»")))
            .otherwise(out)
        )
    return quotes_french(out)


def numbers_french(text: Column, english: Column | None = None) -> Column:
    """Isolated integers of three or more digits get French grouping.

    With the English text, only numbers that it holds (in English form) are changed; a null or empty one counts as none.
    """
    number = r"(?U)(?<=^|\s)(\d{3,})(?=$|\s)"
    if english is None:
        found = F.regexp_extract_all(text, F.lit(number), F.lit(1))
        return F.aggregate(found, text, lambda t, n: _replace_number(t, n))
    there = F.array_distinct(F.flatten(F.transform(F.regexp_extract_all(english, F.lit(r"(?U)\d+(?:[,\s]\d{3})*"), F.lit(0)), lambda x: F.array(x, F.regexp_replace(x, r"(?U)[,\s]", "")))))
    wanted = F.filter(F.regexp_extract_all(text, F.lit(number), F.lit(1)), lambda n: F.coalesce(english, F.lit("")).eqNullSafe("") | F.array_contains(there, n) | F.array_contains(there, group_english(n)))
    return F.aggregate(wanted, text, lambda t, n: _replace_number(t, n))


def group_english(digits: Column) -> Column:
    return F.regexp_replace(digits, r"(?<=\d)(?=(?:\d{3})+$)", ",")


def _replace_number(text: Column, n: Column) -> Column:
    at = F.instr(text, n)
    return F.when(at > 0, F.concat(F.substring(text, F.lit(1), at - 1), group_french(n), F.substring(text, at + F.length(n), F.length(text)))).otherwise(text)


class _TextOnly(HTMLParser):
    """Text of a page without the contents of scripts and styles."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.hidden = 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.hidden += tag in ("script", "style")

    def handle_endtag(self, tag: str) -> None:
        self.hidden -= tag in ("script", "style") and self.hidden > 0

    def handle_data(self, data: str) -> None:
        if not self.hidden:
            self.parts.append(data)


def _html_text(page: str | None, sep: str) -> str | None:
    if page is None:
        return None
    p = _TextOnly()
    p.feed(page)
    p.close()
    return html.unescape(sep.join(p.parts))


@F.pandas_udf(T.StringType())
def _strip_html(pages: pd.Series) -> pd.Series:
    return pages.map(lambda x: _html_text(x, ""))


@F.pandas_udf(T.ArrayType(T.StringType()))
def _html_pieces(pages: pd.Series) -> pd.Series:
    return pages.map(lambda x: None if x is None else [" ".join(s.split()) for s in _html_text(x, "\x00").split("\x00") if s.strip()])


def clean_html(text: Column) -> Column:
    """Text without mark-up, entities resolved, stand-alone leftovers like ``&foo;`` deleted.

    Only texts with mark-up or entities go through Python; all others never leave the JVM's value.
    """
    # a Python function runs for every row whatever the condition around it, so the others send it a null
    return apply_rules(F.coalesce(_strip_html(F.when(text.rlike("[<&]"), text)), text), STRAY_ENTITY)


def visible_text(page: Column) -> Column:
    """Visible pieces of a page, white space collapsed, each different piece once and in order."""
    return F.array_distinct(_html_pieces(page))


def repair(text: Column, widths: bool = True) -> Column:
    """Mojibake subset: canonical composition, control characters deleted, full-width ASCII made half-width (``widths``).

    Deviation: wrongly decoded texts are not decoded again.
    """
    plain = F.regexp_replace(text, r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f\x80-\x9f﻿]", "")
    if widths:
        wide = "".join(chr(c) for c in range(0xFF01, 0xFF5F))
        plain = F.translate(plain, wide, "".join(chr(ord(c) - 0xFEE0) for c in wide))
    return F.coalesce(_compose(F.when(plain.rlike(r"[̀-ͯ]"), plain)), plain)


@F.pandas_udf(T.StringType())
def _compose(texts: pd.Series) -> pd.Series:
    return texts.map(lambda x: None if x is None else unicodedata.normalize("NFC", x))


def repair_narrow(text: Column) -> Column:
    """``repair`` without changing widths."""
    return repair(text, False)


_EASTERN = ("ypt", "zhh", "zhs", "zht")


def _chain(lang: str, english: Column | None) -> list[Callable[[Column], Column]]:
    head = [clean_html, dollar_spaces]
    if lang == "ara":
        return [*head, repair, percentages, brackets_latin, quotes_latin, punctuation_arabic, word_spaces_latin]
    if lang == "eng":
        return [*head, repair, capitals_english, contractions_english, brackets_latin, punctuation_latin, word_spaces_latin, quotes_english, quotes_latin, percentages_english]
    if lang == "fra":
        return [*head, repair, alphabet_french, contractions_french, brackets_latin, punctuation_french, word_spaces_latin, quotes_latin, quotes_to_guillemets, apostrophe_french, percentages_french, lambda c: numbers_french(c, english)]
    if lang == "jpn":
        return [*head, repair_narrow, percentages, brackets_japanese, quotes_japanese, punctuation_japanese, word_spaces_latin]
    if lang in _EASTERN:
        return [*head, repair_narrow, percentages, brackets_chinese, quotes_chinese, punctuation_chinese, word_spaces_chinese]
    return head


def humanize(text: Column, lang: str, english: Column | None = None) -> Column:
    """The whole chain of a language, in order; languages without a chain only lose mark-up and get dollar spacing."""
    return functools.reduce(lambda c, f: f(c), _chain(lang, english), text)


def humanize_table(df: DataFrame, text: str, lang: str, english: str | None = None, out: str | None = None) -> DataFrame:
    """``humanize`` with one projection a step: steps that use their input several times don't repeat what came before."""
    return humanize_by_language(df, text, [(F.lit(True), lang)], english, out)


def humanize_by_language(df: DataFrame, text: str, chains: list[tuple[Column, str]], english: str | None = None, out: str | None = None) -> DataFrame:
    """Each row by the chain of the language whose condition holds (they exclude one another), else only without mark-up and with dollar spacing.

    One pass over the table for all languages; what several of them do at a step is done once.
    """
    out, kept = out or text, df.columns
    steps = [(when, _chain(lang, None if english is None else F.col(english))) for when, lang in chains]
    rest = _chain("", None)
    now, value = df.withColumn("_humanized", F.col(text)), F.col("_humanized")
    for k in range(max(len(fs) for _, fs in steps)):
        same: dict[Callable[[Column], Column] | None, Column] = {}
        for when, fs in steps:
            f = fs[k] if k < len(fs) else None
            same[f] = when if f not in same else same[f] | when
        last = rest[k] if k < len(rest) else None
        if len(steps) == 1:  # a table of one language
            put = steps[0][1][k](value)
        else:
            put = last(value) if last else value
            for f, when in same.items():
                if f is not last:
                    put = F.when(when, f(value) if f else value).otherwise(put)
        now = now.select(*kept, put.alias("_humanized"))
    return now.select(*[c for c in kept if c != out], F.col("_humanized").alias(out))
