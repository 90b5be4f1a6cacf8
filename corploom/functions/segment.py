"""Sentences, sub-sentences, words and characters as Column functions. Null in, null out; blank texts have no parts."""

from __future__ import annotations

import functools
import unicodedata

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

from corploom.functions.normalize import trim_unicode

# fixed values: final marks by language, closing ones included; languages that aren't listed take the first ones
LATIN_FINALS = ';.!?)]}"”'
FINALS = {
    "ara": '؛۔!)]}"”»', "fas": '؛۔!)]}"”»',
    "bul": ';.!?)]}"“»', "ces": ';.!?)]}"“', "dan": ';.!?)]}"«“', "deu": ';.!?)]}"“', "slk": ';.!?)]}"“', "slv": ';.!?)]}"“', "ron": ';.!?)]}"»',
    "cat": ';.!?)]}"»”', "ell": ';.!?)]}"»”', "fra": ';.!?)]}"»”', "ita": ';.!?)]}"»”', "nor": ';.!?)]}"»”', "rus": ';.!?)]}"»”', "spa": ';.!?)]}"»”', "ukr": ';.!?)]}"»”',
    "ben": ';|!?)]}"”', "fin": ';|!?)]}"”', "hin": ';|!?)]}"”', "mar": ';|!?)]}"”', "pan": ';|!?)]}"”',
    "jpn": '；。！？)]}"」﹂',
    "zhs": '；。！？）]}"”」﹂', "zht": '；。！？）]}"”」﹂', "zhh": '；。！？）]}"”」﹂', "ypt": '；。！？）]}"”」﹂', "zho": '；。！？）]}"”」﹂',
}
LAST_IS_WORD = r"(?U).+[\w&&[^_]]$"


def _not_blank(parts: Column) -> Column:
    return F.filter(F.transform(parts, trim_unicode), lambda x: x != "")


def sentences(text: Column) -> Column:
    """Pieces that end in marks (with closing quotes and brackets) before white space; decimals stay whole.

    Deviation: abbreviations are not known here; the trained segmenter of the llm package knows them.
    """
    return _not_blank(F.split(text, r"(?U)(?<=[.!?…][\"')»”\]]{0,3})\s+"))


def sentences_cjk(text: Column) -> Column:
    """Pieces up to a full-width final mark. A last piece without one is kept (the fallback tokenizer loses it)."""
    return _not_blank(F.regexp_extract_all(text, F.lit("[^。？！]+[。？！]*"), F.lit(0)))


def sentences_arabic(text: Column) -> Column:
    return _not_blank(F.regexp_extract_all(text, F.lit("[^.؟!]+[.؟!]*"), F.lit(0)))


def sentences_simple(text: Column) -> Column:
    """Runs up to final marks or line ends: the portable rule of the flagship pipeline; decimals are cut."""
    return F.regexp_extract_all(text, F.lit(r"[^.!?\n]+[.!?]*"), F.lit(0))


def split_sentences(text: Column, lang: str) -> Column:
    """Sentences by the rule of a language."""
    return {"jpn": sentences_cjk, "zhs": sentences_cjk, "zht": sentences_cjk, "zhh": sentences_cjk, "ypt": sentences_cjk, "ara": sentences_arabic}.get(lang, sentences)(text)


def sentences_by_line(text: Column, lang: str) -> Column:
    """Each line is split on its own; empty lines are dropped."""
    return F.flatten(F.transform(_not_blank(F.split(text, "\n")), lambda x: split_sentences(x, lang)))


def gaps(text: Column, parts: Column) -> Column:
    """What lies before, between and after the parts, so that the text can be rebuilt; null if a part isn't found in order."""
    start = F.struct(F.array().cast("array<string>").alias("out"), F.lit(1).alias("at"))

    def step(s: Column, p: Column) -> Column:
        # the part's place, from where the one before ended; a place of 0 is kept to the end
        i = F.when(s["at"] > 0, F.call_function("locate", p, text, s["at"])).otherwise(0)
        return F.struct(F.concat(s["out"], F.array(F.substring(text, s["at"], i - s["at"]))).alias("out"), F.when(i > 0, i + F.length(p)).otherwise(0).alias("at"))

    return F.aggregate(parts, start, step, lambda s: F.when(s["at"] > 0, F.concat(s["out"], F.array(F.substring(text, s["at"], F.length(text))))))


def rebuild(parts: Column, between: Column) -> Column:
    """The text of parts and their gaps."""
    return F.concat(F.array_join(F.zip_with(F.slice(between, F.lit(1), F.size(parts)), parts, lambda a, b: F.concat(a, b)), ""), F.element_at(between, -1))


def subsentences(text: Column) -> Column:
    """Cut at runs of four or more ASCII marks, then after semicolons (ASCII, full-width, Arabic), which stay."""
    runs = _not_blank(F.split(text, r"[\p{Punct}]{4,}"))
    return F.flatten(F.transform(runs, lambda x: _not_blank(F.split(x, "(?<=[;；؛])"))))


def word_count(text: Column) -> Column:
    """Words between white space; 0 for a blank text."""
    t = trim_unicode(text)
    return F.when(t == "", 0).otherwise(F.size(F.split(t, r"(?U)\s+")))


def has_word_length(text: Column, least: int = 8, most: int = 100) -> Column:
    """Whether the number of words lies in the range, ends included."""
    return word_count(text).between(least, most)


def is_sentence(text: Column, lang: str = "eng") -> Column:
    """Whether the last character is a final mark of the language or a letter or digit. Empty texts are no sentences."""
    marks = FINALS.get(lang, LATIN_FINALS)
    return (F.length(text) > 0) & (F.right(text, F.lit(1)).isin(list(marks)) | text.rlike(LAST_IS_WORD))


# ---- words --------------------------------------------------------------------------------------------------------------

#: Marks are set apart; points only at the end, so that decimals, abbreviations inside and addresses stay whole.
_APART = [(r"(?U)([^\w\s.'’,\-])", " $1 "), (r"(?U),(?!\d)|(?<!\d),", " , "), (r"(?U)(?<!\.)\.(?=\s*[\"')\]»”]*\s*$)", " ."), (r"(?U)([lLdDjJnNmMtTsScC]|qu|Qu)(['’])(?=\p{L})", "$1$2 ")]


def words(text: Column, lang: str = "eng") -> Column:
    """Tokens with their marks apart. Chinese, Japanese and Korean characters are tokens of their own (a deviation: no dictionary)."""
    if lang in ("zhs", "zht", "zhh", "ypt", "jpn", "kor"):
        return F.regexp_extract_all(text, F.lit(r"(?U)[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsHangul}]|[\w&&[^\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsHangul}]]+|[^\w\s]"), F.lit(0))
    rules = _APART if lang == "fra" else [*_APART[:3], (r"(?U)(?<=\p{L})(['’](?:s|re|ve|d|ll|m|t))\b", " $1")]
    return F.filter(F.split(functools.reduce(lambda c, r: F.regexp_replace(c, r[0], r[1]), rules, text), r"(?U)\s+"), lambda x: x != "")


def detokenize(tokens: Column, lang: str = "eng") -> Column:
    """Text of tokens: no blank before closing marks, none after opening ones; Chinese and Japanese without blanks."""
    if lang in ("zhs", "zht", "zhh", "ypt", "jpn"):
        return F.array_join(tokens, "")
    rules = [(r"(?U)\s+([.,;!?…)\]}”%]|['’](?:s|re|ve|d|ll|m|t)\b)", "$1"), (r"([(\[{“])\s+", "$1"), (r"(?U)(?<=['’])\s+(?=\p{L})" if lang == "fra" else r"(?!)", "")]
    return functools.reduce(lambda c, r: F.regexp_replace(c, r[0], r[1]), rules, F.array_join(tokens, " "))


def search_tokens(text: Column) -> Column:
    """Lower-case ASCII tokens without marks; tokens with other characters are left out."""
    return F.filter(F.split(F.lower(text), r"(?U)\s+|(?<=\w)(?=[^\w\s])|(?<=[^\w\s])(?=\w)"), lambda x: x.rlike("^[a-z0-9]+$"))


def simple_tokens(text: Column, least: int = 2, most: int = 15) -> Column:
    """Lower-case runs of letters with 2 to 15 characters; runs that touch digits are left out."""
    return F.filter(F.regexp_extract_all(F.lower(text), F.lit(r"(?U)(?<![\w])(?:_*)(\p{L}+)(?![\w])"), F.lit(1)), lambda x: F.length(x).between(least, most))


def query_tokens(text: Column) -> Column:
    """Lower-case pieces between white space, as they are."""
    return F.filter(F.split(F.lower(text), r"(?U)\s+"), lambda x: x != "")


@F.pandas_udf(T.StringType())
def script_name(chars: pd.Series) -> pd.Series:
    """First word of the Unicode name of the first character; null for none."""
    return chars.map(lambda c: unicodedata.name(c[0], "").split(" ")[0] or None if c else None)


# fixed values: Unicode scripts of a language's text characters
SCRIPTS = {"zhs": "IsHan", "zht": "IsHan", "jpn": "IsHan IsHiragana IsKatakana", "kor": "IsHangul IsHan", "ara": "IsArabic", "ell": "IsGreek", "rus": "IsCyrillic", "hin": "IsDevanagari", "tha": "IsThai", "heb": "IsHebrew"}


def has_text_characters(text: Column, lang: str, least: int = 2) -> Column:
    """Whether some run of ``least`` characters is in a script of the language; always, if ``least`` is below 1."""
    if least <= 0:
        return text.isNotNull()
    classes = "".join(rf"\p{{{s}}}" for s in SCRIPTS.get(lang, "IsLatin").split())
    return text.rlike(f"[{classes}]{{{least},}}")


# fixed values: characters that the two Chinese writing systems write differently, pairwise
SIMPLIFIED, TRADITIONAL = "国语学汉这们时后发见长门问东车书", "國語學漢這們時後發見長門問東車書"


def is_chinese(text: Column, punctuation: bool = True) -> Column:
    """Whether all characters are Chinese ones (or full-width marks, with ``punctuation``)."""
    return text.rlike(r"^[\p{IsHan}　-〿＀-￯“”‘’…—]+$" if punctuation else r"^\p{IsHan}+$")


def is_japanese(text: Column, punctuation: bool = True) -> Column:
    """Whether all characters are kana or Chinese ones (or full-width marks)."""
    return text.rlike(r"^[\p{IsHan}\p{IsHiragana}\p{IsKatakana}ー　-〿＀-￯]+$" if punctuation else r"^[\p{IsHan}\p{IsHiragana}\p{IsKatakana}ー]+$")


def chinese_system(text: Column) -> Column:
    """zhs or zht by the characters that differ; null if none of them is there or both kinds are equally many."""
    n = lambda chars: F.length(F.regexp_replace(text, f"[^{chars}]", ""))
    return F.when(n(SIMPLIFIED) > n(TRADITIONAL), "zhs").when(n(TRADITIONAL) > n(SIMPLIFIED), "zht")


def convert_chinese(text: Column, target: str) -> Column:
    """Characters of the table above in the other system. Deviation: the table is small; a full one is not available offline."""
    return F.translate(text, TRADITIONAL, SIMPLIFIED) if target == "zhs" else F.translate(text, SIMPLIFIED, TRADITIONAL)


def subword_encode(vocabulary: list[tuple[str, int]], threshold: int = 50, unknown: str = "<unk>"):
    """A Column function: greedy longest match of words (with a leading mark) over pieces seen ``threshold`` times or more.

    An approximation of a unigram encoder: the vocabulary is fixed in size and sent with the plan.
    """
    pieces = frozenset(p for p, n in vocabulary if n >= threshold)
    longest = max(map(len, pieces), default=1)

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def encode(texts: pd.Series) -> pd.Series:
        def one(text: str | None) -> list[str] | None:
            if text is None:
                return None
            out: list[str] = []
            for word in text.split():
                s, i = "▁" + word, 0
                while i < len(s):
                    j = next((j for j in range(min(len(s), i + longest), i, -1) if s[i:j] in pieces), None)
                    out.append(s[i:j] if j else unknown)
                    i = j or i + 1
            return out

        return texts.map(one)

    return encode
