"""Entity patterns, language-code tables and symbol tables."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Entity patterns (our own forms of public formats).
PATTERNS = {
    "digit": r"\d",
    "integer": r"(?<![\d.,])\d+(?![\d.,]*\d)",
    "percentage": r"\d+(?:[.,]\d+)?\s*[%٪％]",
    "time": r"(?<!\d)(?:[01]?\d|2[0-3]):[0-5]\d(?::[0-5]\d)?(?!\d)",
    "phone": r"(?<!\d)(?:\+?1[-. ])?\(?\d{3}\)?[-. ]\d{3}[-. ]\d{4}(?!\d)",
    "url": r"(?:https?://|www\.)[^\s<>\"')\]]+[^\s<>\"')\].,;:!?]",
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "filename": r"\b[\w-]+\.(?:txt|pdf|docx?|xlsx?|pptx?|csv|tmx|xml|html?|zip|jpe?g|png|gif)\b",
    "handle": r"(?<![\w@.])@[A-Za-z_]\w{1,30}",
    "markup": r"</?[A-Za-z][^<>]*>|\{/?\w{1,2}[>}]",
    "comment": r"<!--.*?-->|<script\b.*?</script>",
    "code": r"\b(?=[A-Z0-9-]*\d)(?=[A-Z0-9-]*[A-Z])[A-Z0-9]+(?:-[A-Z0-9]+)*\b",
    "size": r"\d+(?:[.,]\d+)?\s?[xX×]\s?\d+(?:[.,]\d+)?",
    "currency_eng": r"(?:US|CA|C)?\$\s?\d[\d,]*(?:\.\d+)?(?:\s(?:thousand|million|billion))?",
    "currency_fra": r"\d[\d  ]*(?:,\d+)?\s(?:(?:milliers?|millions?|milliards?) de )?(?:dollars|\$)",
    "quantity_eng": r"\d+(?:[.,]\d+)?\s?(?:km|kg|cm|mm|mi|lb|oz|ft|m|g|l|°C|°F|hours?|minutes?|seconds?|days?|weeks?|months?|years?|units?|people|places)\b",
    "quantity_fra": r"\d+(?:[  ]\d{3})*(?:,\d+)?\s?(?:km|kg|cm|mm|m|g|l|°C|heures?|minutes?|secondes?|jours?|semaines?|mois|ans?|unités?|personnes?|places?)\b",
    "date_iso": r"(?<!\d)\d{4}[-/](?:0?[1-9]|1[0-2])[-/](?:0?[1-9]|[12]\d|3[01])(?!\d)",
    "date_eng": r"(?:January|February|March|April|May|June|July|August|September|October|November|December) \d{1,2}, \d{4}",
    "date_fra": r"\d{1,2}(?:er)? (?:janvier|février|mars|avril|mai|juin|juillet|août|septembre|octobre|novembre|décembre) \d{4}",
    "ipv4": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d.])",
    "ipv6": r"(?<![:\w])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![:\w])",
    "credit_card": r"(?<!\d)(?:\d{4}[- ]?){3}\d{4}(?!\d)",
    "isbn": r"(?<!\d)97[89][- ]?(?:\d[- ]?){9}\d(?!\d)",
    "coordinates": r"[-+]?(?:90|[0-8]?\d)\.\d+,\s*[-+]?(?:180|1[0-7]\d|\d?\d)\.\d+",
    "mac": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{2}:){5}[0-9A-Fa-f]{2}(?![0-9A-Fa-f:])",
    "uuid": r"[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}",
    "hex_colour": r"#(?:[0-9a-fA-F]{6}|[0-9a-fA-F]{3})\b",
    "bitcoin": r"\b[13][a-km-zA-HJ-NP-Z1-9]{25,34}\b",
    "ethereum": r"\b0x[0-9a-fA-F]{40}\b",
    "postal_code": r"\b[A-CEGHJ-NPRSTVXY]\d[A-CEGHJ-NPR-TV-Z] ?\d[A-CEGHJ-NPR-TV-Z]\d\b",
    "zip_code": r"(?<!\d)\d{5}(?:-\d{4})?(?!\d)",
    "street": r"\b\d{1,5} [A-Z][\w'’-]+(?: [A-Z][\w'’-]+)* (?:Street|St|Avenue|Ave|Road|Rd|Boulevard|Blvd|Drive|Dr|Lane|Way)\b",
    "licence_plate": r"\b[A-Z]{2,4}[- ]?\d{3,4}\b",
}


#: Kinds whose patterns look at nothing around them.
SIMPLE = ("digit", "percentage", "url", "email", "markup", "size", "currency_eng", "currency_fra", "date_eng", "date_fra", "coordinates", "uuid")


def extract(text: Column, name: str) -> Column:
    """All entities of a kind, in order."""
    return F.regexp_extract_all(text, F.lit("(?U)" + PATTERNS[name]), F.lit(0))


def count(text: Column, name: str) -> Column:
    return F.regexp_count(text, F.lit("(?U)" + PATTERNS[name]))


def is_canonical(text: Column) -> Column:
    """Whether a text is free of file names, urls, handles and comments or scripts."""
    hit = text.rlike("(?s)" + PATTERNS["filename"])
    for name in ("url", "handle", "comment"):
        hit = hit | text.rlike("(?s)" + PATTERNS[name])
    return ~hit


# Language codes: ISO 639-3, ISO 639-1, English name, culture codes (the first one is the default).
LANGUAGES = [
    ("ara", "ar", "Arabic", ["ar-SA"]), ("ces", "cs", "Czech", ["cs-CZ"]), ("dan", "da", "Danish", ["da-DK"]), ("deu", "de", "German", ["de-DE", "de-CH"]),
    ("ell", "el", "Greek", ["el-GR"]), ("eng", "en", "English", ["en-US", "en-CA", "en-GB"]), ("fin", "fi", "Finnish", ["fi-FI"]), ("fra", "fr", "French", ["fr-CA", "fr-FR"]),
    ("heb", "he", "Hebrew", ["he-IL"]), ("hin", "hi", "Hindi", ["hi-IN"]), ("ita", "it", "Italian", ["it-IT"]), ("jpn", "ja", "Japanese", ["ja-JP"]), ("kor", "ko", "Korean", ["ko-KR"]),
    ("nld", "nl", "Dutch", ["nl-NL"]), ("nor", "no", "Norwegian", ["nb-NO"]), ("pol", "pl", "Polish", ["pl-PL"]), ("por", "pt", "Portuguese", ["pt-BR", "pt-PT"]), ("rus", "ru", "Russian", ["ru-RU"]),
    ("spa", "es", "Spanish", ["es-ES", "es-MX"]), ("swe", "sv", "Swedish", ["sv-SE"]), ("tha", "th", "Thai", ["th-TH"]), ("tur", "tr", "Turkish", ["tr-TR"]), ("zhs", "zh", "Simplified Chinese", ["zh-CN"]), ("zht", "zh", "Traditional Chinese", ["zh-TW", "zh-HK"]),
]
_SYSTEMS = {"iso3": 0, "iso2": 1, "name": 2}


def code_mapping(source: str, target: str) -> dict[str, str]:
    """Codes of one system to another; later languages overwrite, empty codes are left out."""
    return {row[_SYSTEMS[source]]: row[_SYSTEMS[target]] for row in LANGUAGES if row[_SYSTEMS[source]] and row[_SYSTEMS[target]]}


def map_code(code: Column, source: str = "iso2", target: str = "iso3") -> Column:
    """A language code of one system in another, letter case and blanks aside; null if unknown."""
    table = F.create_map(*[F.lit(x) for k, v in code_mapping(source, target).items() for x in (k.lower(), v)])
    return F.try_element_at(table, F.lower(F.trim(code)))


# Symbol tables.
SYMBOLS = {"commercial": "®™©℠", "currency": "$€£¥₩₹₽¢", "number": "#№", "percent": "%٪％‰", "bad": "�￼​﻿­", "superscript": "⁰¹²³⁴⁵⁶⁷⁸⁹⁽⁾", "subscript": "₀₁₂₃₄₅₆₇₈₉₍₎"}
PLAIN_DIGITS = "0123456789()"


def strip_bad_characters(text: Column) -> Column:
    return F.translate(text, SYMBOLS["bad"], "")


def plain_scripts(text: Column) -> Column:
    """Super- and subscript digits as plain ones."""
    return F.translate(text, SYMBOLS["superscript"] + SYMBOLS["subscript"], PLAIN_DIGITS * 2)
