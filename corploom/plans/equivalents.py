"""SQL equivalents of the normalizers: each rule in a dialect without lookarounds.

A context that a rule only looks at is captured and put back. Where contexts of neighbouring matches may overlap, a marker
character stands in the text between two passes, or the pass is run twice.
"""

from __future__ import annotations

from collections.abc import Callable

from corploom.functions import entities as E, normalize as N, segment as S
from corploom.plans.search import STOP

Step = Callable[[str], str]
WS = r"[\s\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x0b\x1c-\x1f]"
NO_WS = "[^" + WS[1:]
WS_NO_NBSP = WS.replace(r"\x{a0}", "")
WORD = r"[\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}\x{200c}\x{200d}]"
NO_WORD = r"[^\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}\x{200c}\x{200d}]"
WORD_NO_DIGIT = r"[\p{L}\p{M}\p{Nl}\p{Pc}\x{200c}\x{200d}]"
MARKER = ""


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sub(pattern: str, put: str, times: int = 1) -> Step:
    def step(t: str) -> str:
        for _ in range(times):
            t = f"regexp_replace({t}, {quoted(pattern)}, {quoted(put)}, 'g')"
        return t

    return step


def inner(left: str, right: str, pad: str = "") -> Step:
    """No blanks (or ``pad``) inside a pair of marks."""
    a, b = (("\\" + x if x in '()[]"<>' else x) for x in (left, right))
    edge = f"[^{a}{b}{WS[1:-1]}]"
    return sub(rf"{a}{WS}*({edge}(?:[^{a}{b}]*{edge})?)?{WS}*{b}", rf"{left}{pad}\1{pad}{right}")


def steps(*parts: Step) -> Step:
    def run(t: str) -> str:
        for p in parts:
            t = p(t)
        return t

    return run


def around(marks: str, put: str, end: str, word: str = WORD_NO_DIGIT, before: str = NO_WS) -> Step:
    """Marks after ``before`` and before a word, or at the end."""
    return steps(
        sub(f"([{marks}]){WS}*({word})", rf"\1{MARKER}\2"),
        sub(f"({before}){WS}*([{marks}]){MARKER}", rf"\1{put}"),
        sub(MARKER, " "),
        sub(f"({before}){WS}*([{marks}]){WS}*$", rf"\1{end}"),
    )


trim = sub(f"^{WS}+|{WS}+$", "")
percent = sub(rf"(^|{WS})(\p{{Nd}}+(?:\.\p{{Nd}}+)?){WS}+([%٪％])($|{NO_WORD})", r"\1\2\3\4", 2)
percent_english = sub(rf"(^|{WS})(\p{{Nd}}+(?:\.\p{{Nd}}+)?){WS}*[%٪％]($|{NO_WORD})", r"\1\2%\3", 2)
percent_french = sub(rf"(^|{WS})(\p{{Nd}}+(?:,\p{{Nd}}+)?){WS}*[%٪％]($|{NO_WORD})", rf"\1\2{N.NBSP}%\3", 2)
dollar = sub(rf"(^|[\p{{L}}\p{{N}}]){WS}*(\$\p{{Nd}}*){WS}*", r"\1 \2 ")
spaces_latin = steps(sub(f"{WS_NO_NBSP}+", " "), trim)
start_mark = sub(f"^{WS}*([,;:…!?.]){WS}*({WORD_NO_DIGIT})", r"\1 \2")
punctuation_latin = steps(start_mark, around(",;:…!?.", r"\2 ", r"\2"))


def punctuation_french(t: str) -> str:
    return steps(start_mark, *(around(m, put, end) for m, put, end in ((",;…!?.", r"\2 ", r"\2"), (":", rf"{N.NBSP}\2 ", rf"{N.NBSP}\2"))))(t)


punctuation_arabic = steps(around(".،؟؛:!…", r"\2 ", r"\2", WORD_NO_DIGIT, WORD))
_MARK, _HAN, _KANA_HAN = "[　-〿＀-／：-＠［-｀｛-･“”‘’…—]", "[一-鿿㐀-䶿]", "[一-鿿㐀-䶿぀-ヿ]"


def blanks_at_marks(character: str) -> Step:
    both = f"(?:{character}|{_MARK})"
    return steps(sub(f"{WS}+", " "), sub(f"({_MARK}) ({both})", r"\1\2", 2), sub(f"({character}) ({_MARK})", r"\1\2", 2), trim)


spaces_chinese = steps(sub(f"{WS}+", " "), sub(f"({_HAN}) ({_HAN})", r"\1\2", 2), trim, sub(f"({_HAN})([A-Za-z0-9])", r"\1 \2"), sub(f"([A-Za-z0-9])({_HAN})", r"\1 \2"))
quotes_latin = steps(inner('"', '"'), inner("“", "”"))
quotes_french = inner("«", "»", N.NBSP)
quotes_chinese, quotes_japanese = inner("“", "”"), steps(inner("「", "」"), inner("『", "』"))
brackets_latin = inner("(", ")")
brackets_chinese = steps(*(inner(a, b) for a, b in ("（）", "〈〉", "《》", "【】")))
brackets_japanese = steps(*(inner(a, b) for a, b in ("（）", "<>", "[]", "【】")))
contractions_english = steps(sub(f"([a-zA-Z]){WS}*([’']){WS}*(t|m|ll|ve|s|re|d)({NO_WORD})", r"\1\2\3\4", 2), sub(f"([a-zA-Z]s){WS}*([’'])({NO_WORD})", r"\1\2\3"))
contractions_french = sub(f"({WORD}){WS}*(['’]){WS}*({WORD})", r"\1\2\3", 2)
apostrophe_french = steps(sub(rf"(?i)(^|{NO_WORD})({'|'.join(N.ELISIONS)})'(\p{{L}})", r"\1\2’\3", 2))
quotes_english = sub("[«»]", '"')


def alphabet_french(t: str) -> str:
    """The detached accents of these tables stand directly beside their letters only."""
    for mark, (spacing, _) in N.ACCENTS.items():
        t = f"replace({t}, '{mark}', '{spacing}')"
    t = steps(sub(rf"([eE]){WS}+´{WS}+($|[^eE{WS[1:]})", r"´\1\2"), sub(rf"([eE]){WS}*`{WS}*($|[^eE{WS[1:]})", r"`\1\2"))(t)
    for pattern, put in N.ALPHABET_FRENCH[len(N.ACCENTS) + 4 :]:
        t = f"replace({t}, {quoted(pattern)}, '{put}')"
    return t


def guillemets(t: str) -> str:
    """Pairs, curly ones, and a lone straight quote by its free side."""
    paired = f"translate({sub('[“\"]([^“”\"]+)[\"”]', r'«\1»')(t)}, '“”', '«»')"
    lone = f"length(q) - length(replace(q, '\"', '')) = 1"
    case = rf"CASE WHEN {lone} AND regexp_matches(q, '(^|{WS})\"{NO_WS}') THEN replace(q, '\"', '«{N.NBSP}') WHEN {lone} AND regexp_matches(q, '{NO_WS}\"($|{WS})') THEN replace(q, '\"', '{N.NBSP}»') ELSE q END"
    return quotes_french(f"(list_transform([{paired}], lambda q: {case})[1])")


def repair(t: str) -> str:
    wide = "".join(chr(c) for c in range(0xFF01, 0xFF5F))
    clean = sub(r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f\x{80}-\x{9f}\x{feff}]", "")(t)
    return f"nfc_normalize(translate({clean}, '{wide}', {quoted(''.join(chr(ord(c) - 0xFEE0) for c in wide))}))"


def _grouped(n: str, mark: str) -> str:
    return f"reverse(regexp_replace(regexp_replace(reverse({n}), '(\\p{{Nd}}{{3}})', '\\1{mark}', 'g'), '{mark}$', ''))"


def numbers_french(t: str, english: str | None = None) -> str:
    """The first place of each isolated number of three or more digits (that the English text holds) in groups."""
    found = f"list_filter(string_split_regex({t}, '{WS}'), lambda n: regexp_matches(n, '^\\p{{Nd}}{{3,}}$'))"
    if english:
        there = f"regexp_extract_all({english}, '\\p{{Nd}}+(?:[,{WS[1:]}\\p{{Nd}}{{3}})*')"
        there = f"list_concat({there}, list_transform({there}, lambda e: regexp_replace(e, '[,{WS[1:]}', '', 'g')))"
        found = f"list_filter({found}, lambda n: coalesce({english}, '') = '' OR list_contains({there}, n) OR list_contains({there}, {_grouped('n', ',')}))"
    put = f"CASE WHEN instr(a, n) > 0 THEN left(a, instr(a, n) - 1) || {_grouped('n', N.NBSP)} || substr(a, instr(a, n) + length(n)) ELSE a END"
    return f"list_reduce(list_prepend({t}, {found}), lambda a, n: {put})"


#: The chains, without the step that strips mark-up: these tables hold none (no "<" or "&" that begins a tag or an entity).
ENGLISH: list[Step] = [dollar, repair, steps(*(sub(rf"\b{n}\b", n.capitalize()) for n in N.NAMES)), contractions_english, brackets_latin, punctuation_latin, spaces_latin, quotes_english, quotes_latin, percent_english]
FRENCH: list[Step] = [dollar, repair, alphabet_french, contractions_french, brackets_latin, punctuation_french, spaces_latin, quotes_latin, guillemets, apostrophe_french, percent_french]


def select(column: str, step: Step) -> str:
    return f"SELECT tm_id, {step(column)} AS out FROM tm_fileparser"


def staged(source: str, keep: str, column: str, parts: list[Step]) -> str:
    """One subquery a step, so that no step repeats what came before."""
    query = f"SELECT {keep}, {column} AS t FROM {source}"
    for p in parts:
        query = f"SELECT {keep}, {p('t')} AS t FROM ({query})"
    return query


SQL = {
    "norm_percent": select("tgttexts", percent), "norm_percent_english": select("tgttexts", percent_english), "norm_percent_french": select("tgttexts", percent_french), "norm_dollar": select("srctexts", dollar),
    "norm_punctuation_latin": select("srctexts", punctuation_latin), "norm_punctuation_french": select("tgttexts", punctuation_french), "norm_punctuation_arabic": select("srctexts", punctuation_arabic),
    "norm_punctuation_chinese": select("srctexts", blanks_at_marks(_HAN)), "norm_punctuation_japanese": select("srctexts", blanks_at_marks(_KANA_HAN)), "norm_spaces_chinese": select("srctexts", spaces_chinese),
    "norm_quotes_latin": select("srctexts", quotes_latin), "norm_quotes_chinese": select("srctexts", quotes_chinese), "norm_quotes_japanese": select("srctexts", quotes_japanese),
    "norm_brackets_chinese": select("srctexts", brackets_chinese), "norm_brackets_japanese": select("srctexts", brackets_japanese),
    "norm_contractions_english": select("srctexts", contractions_english), "norm_contractions_french": select("tgttexts", contractions_french), "norm_apostrophe_french": select("tgttexts", apostrophe_french),
    "norm_alphabet_french": select("tgttexts", alphabet_french), "norm_guillemets": select("tgttexts", guillemets), "norm_repair": select("srctexts", repair),
    "norm_humanize_eng": f"SELECT tm_id, t AS out FROM ({staged('tm_fileparser', 'tm_id', 'srctexts', ENGLISH)})",
    "norm_humanize_fra": f"SELECT tm_id, t AS out FROM ({staged('tm_fileparser', 'tm_id, srctexts', 'tgttexts', [*FRENCH, lambda t: numbers_french(t, 'srctexts')])})",
    "norm_numbers_french": select("tgttexts", lambda t: numbers_french(t, "srctexts")),
    "norm_tag_dedup": "SELECT tm_id, srctexts FROM (SELECT tm_id, t AS srctexts, row_number() OVER (PARTITION BY t ORDER BY tm_id) AS r FROM (" + staged("tm_fileparser WHERE srctexts IS NOT NULL", "tm_id", "srctexts", [sub(r"\{\w{1,2}>|<\w{1,2}\}", " "), sub(f"{WS}+", " "), trim, sub(r"\{\d{1,2}\}", "")]) + ")) WHERE r = 1",
}


# ---- segmentation, words, entities, similarity ---------------------------------------------------------------------------


def re2(pattern: str) -> str:
    """A pattern of Unicode classes in the other dialect, without lookarounds."""
    out, inside, i = [], False, 0
    classes = {"s": (WS, WS[1:-1]), "w": (WORD, WORD[1:-1]), "d": (r"\p{Nd}", r"\p{Nd}")}
    while i < len(pattern):
        c = pattern[i]
        if c == "\\" and pattern[i + 1] in classes:
            out.append(classes[pattern[i + 1]][inside])
            i += 2
            continue
        if c == "\\":
            out.append(pattern[i : i + 2])
            i += 2
            continue
        inside = True if c == "[" else False if c == "]" else inside
        out.append(c)
        i += 1
    return "".join(out)


def parts(items: str) -> str:
    """Trimmed pieces that aren't blank."""
    return f"list_filter(list_transform({items}, lambda v: {trim('v')}), lambda v: v <> '')"


def latin_sentences(t: str) -> str:
    return parts(f"string_split({sub(f'([.!?…][\"' + chr(39) + f')»”\\]]{{0,3}}){WS}+', rf'\1{MARKER}')(t)}, '{MARKER}')")


def runs_to(marks: str, t: str) -> str:
    return parts(f"regexp_extract_all({t}, '[^{marks}]+[{marks}]*')")


def numbered(query: str, key: str, items: str, name: str) -> str:
    """(key, pos, name): one row an item."""
    return f"SELECT {key}, CAST(unnest(range(len({items}))) AS INTEGER) AS pos, unnest({items}) AS {name} FROM ({query})"


def shaped(marks: str, t: str) -> str:
    last = ", ".join(quoted(m) for m in marks)
    return f"(right({t}, 1) IN ({last}) OR regexp_matches({t}, '.[\\p{{L}}\\p{{M}}\\p{{Nd}}\\p{{Nl}}\\x{{200c}}\\x{{200d}}]$'))"


def counted_words(t: str) -> str:
    return f"CASE WHEN {trim(t)} = '' THEN 0 ELSE len(string_split_regex({trim(t)}, '{WS}+')) END"


def _pipeline() -> str:
    """Each language's chain, splitter and final marks; the rest as Latin texts."""
    code = E.code_mapping("iso2", "iso3")
    names = ", ".join(f"('{k}', '{v}')" for k, v in code.items())
    rows = f"m(iso2, iso3) AS (VALUES {names}), d AS (SELECT doc_id, text, coalesce(m.iso3, l.iso3) AS lang FROM documents d LEFT JOIN m ON m.iso2 = lower(trim(d.lang)) LEFT JOIN (SELECT iso3 FROM (VALUES {', '.join(repr((r[0],))[:-2] + ')' for r in E.LANGUAGES)}) x(iso3)) l ON l.iso3 = lower(trim(d.lang)))"
    repair_kept = lambda t: f"nfc_normalize({sub(r'[\x00-\x08\x0b\x0c\x0e-\x1f\x7f\x{80}-\x{9f}\x{feff}]', '')(t)})"
    arabic: list[Step] = [dollar, repair, percent, brackets_latin, quotes_latin, punctuation_arabic, spaces_latin]
    japanese: list[Step] = [dollar, repair_kept, percent, brackets_japanese, quotes_japanese, blanks_at_marks(_KANA_HAN), spaces_latin]
    chinese: list[Step] = [dollar, repair_kept, percent, brackets_chinese, quotes_chinese, blanks_at_marks(_HAN), spaces_chinese]
    chains: dict[str, tuple[list[Step], Step, str]] = {
        "lang = 'eng'": (ENGLISH, latin_sentences, S.LATIN_FINALS), "lang = 'fra'": ([*FRENCH, numbers_french], latin_sentences, S.FINALS["fra"]), "lang = 'ara'": (arabic, lambda t: runs_to(".؟!", t), S.FINALS["ara"]),
        "lang = 'jpn'": (japanese, lambda t: runs_to("。？！", t), S.FINALS["jpn"]), "lang = 'zht'": (chinese, lambda t: runs_to("。？！", t), S.FINALS["zht"]),
        "lang IS NULL OR lang NOT IN ('eng', 'fra', 'ara', 'jpn', 'zht')": ([dollar], latin_sentences, S.LATIN_FINALS),
    }
    kept = []
    for where, (chain, split, marks) in chains.items():
        kept.append(f"SELECT doc_id, lang, pos, text FROM ({numbered('SELECT doc_id, lang, ' + split('t') + ' AS s FROM (' + staged(f'd WHERE {where}', 'doc_id, lang', 'text', chain) + ')', 'doc_id, lang', 's', 'text')}) WHERE {counted_words('text')} BETWEEN 8 AND 100 AND {shaped(marks, 'text')}")
    return f"WITH {rows}, k AS ({' UNION ALL '.join(kept)}) SELECT lang, count(*) AS segments, CAST(sum(length(text)) AS BIGINT) AS characters FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id, pos) AS r FROM k) WHERE r = 1 GROUP BY lang"


_APART: list[Step] = [
    sub(rf"([^\p{{L}}\p{{M}}\p{{Nd}}\p{{Nl}}\p{{Pc}}{WS[1:-1]}.'’,\-])", r" \1 "), sub(r"(\p{Nd}),(\p{Nd})", rf"\1{MARKER}\2", 2), lambda t: f"replace(replace({t}, ',', ' , '), '{MARKER}', ',')",
    sub(rf"(^|[^.])\.({WS}*[\"')\]»”]*{WS}*)$", r"\1 .\2"), sub(rf"(\p{{L}})(['’](?:s|re|ve|d|ll|m|t))({NO_WORD}|$)", r"\1 \2\3", 2),
]
# blanks after a sentence's end or at the ends of the text, by marks around them
_BETWEEN = "array_to_string(regexp_extract_all(" + steps(sub(f"([.!?…][\"')»”\\]]{{0,3}})({WS}+)", rf"\1{MARKER}\2{MARKER}"), sub(f"^({WS}+)", rf"{MARKER}\1{MARKER}"), sub(f"({WS}+)$", rf"{MARKER}\1{MARKER}"))("texts") + f", '{MARKER}{WS}+{MARKER}'), '')"
_TOKENS = f"SELECT query_id, list_filter(string_split_regex(t, '{WS}+'), lambda v: v <> '') AS tokens FROM ({staged('segments', 'query_id', 'src_text', _APART)})"
_LINES = f"list_transform({parts('string_split(texts, chr(10))')}, lambda x: {latin_sentences('x')})"


def one_byte(t: str) -> str:
    """Characters of the memory beyond ASCII as others that it doesn't hold: the other engine's distances count bytes."""
    beyond = "\u00a0«»ÀÂÇÈÉÊÎÔÙÛàâçèéêîôùû\u2009—’“”…"
    free = [*range(1, 9), *range(14, 32), *map(ord, "@#^")]
    return f"translate({t}, '{beyond}', " + " || ".join(f"chr({k})" for k in free[: len(beyond)]) + ")"


_SIMILAR = f"SELECT tm_id, {one_byte('srctexts')} AS a, {one_byte('tgttexts')} AS b FROM tm_fileparser"
_LEVENSHTEIN = "CASE WHEN a = '' AND b = '' THEN 1.0 ELSE 1 - levenshtein(a, b) / nullif(greatest(length(a), length(b)), 0) END"
_SHARED = "coalesce(list_sum(list_transform(list_distinct(string_split(a, '')), lambda c: CASE WHEN c = '' THEN 0 ELSE least(length(a) - length(replace(a, c, '')), length(b) - length(replace(b, c, ''))) END)), 0)"
_SET = lambda how: f"CASE WHEN a = '' AND b = '' THEN 1.0 WHEN a = '' OR b = '' THEN 0.0 WHEN b IS NOT NULL THEN round({how}, 6) END"
_WHEN_BOTH = lambda how: f"round(CASE WHEN a = b THEN 1.0 WHEN a = '' OR b = '' THEN 0.0 ELSE {how} END, 6)"
_HIDDEN = {"filename": E.PATTERNS["filename"], "url": E.PATTERNS["url"], "handle": r"(?:^|[^\w@.])@[A-Za-z_]\w{1,30}", "comment": E.PATTERNS["comment"]}
_SCRIPTS = {"eng": "Latin", "zhs": "Han", "jpn": "Han Hiragana Katakana", "ara": "Arabic", "hin": "Devanagari", "tha": "Thai", "rus": "Cyrillic"}
_WIDE = r"　-〿＀-￯"
_END = r"(?:\r\n|[\n\r\x{85}\x{2028}\x{2029}])?$"
SQL |= {
    "clean_pipeline": _pipeline(),
    "segments_humanized": f"SELECT * FROM ({numbered('SELECT tm_id, ' + latin_sentences('t') + ' AS s FROM (' + staged('tm_fileparser', 'tm_id', 'srctexts', ENGLISH) + ')', 'tm_id', 's', 'text')}) WHERE {counted_words('text')} BETWEEN 8 AND 100 AND {shaped(S.LATIN_FINALS, 'text')}",
    "paragraph_sentences": numbered(f"SELECT text_id, flatten({_LINES}) AS s FROM html_text_process", "text_id", "s", "sentence"),
    "split_by_language": f"SELECT text_id, 'jpn' AS rule, {runs_to('。？！', 'texts')} AS sentences FROM html_text_process UNION ALL SELECT text_id, 'ara', {runs_to('.؟!', 'texts')} FROM html_text_process",
    "sentence_gaps": f"SELECT text_id, CAST(len(s) AS INTEGER) AS sentences, regexp_replace({_BETWEEN}, '{NO_WS}+', '', 'g') AS gap, array_to_string(list_transform(s, lambda v: regexp_replace(v, '{NO_WS}+', '', 'g')), '') AS inside FROM (SELECT text_id, texts, {latin_sentences('texts')} AS s FROM html_text_process WHERE texts IS NOT NULL)",
    "subsentences": numbered("SELECT query_id, flatten(list_transform(" + parts("string_split_regex(src_text, '[!-/:-@\\[-`{-~]{4,}')") + f", lambda x: {parts(f'string_split({sub("([;；؛])", rf"{chr(92)}1{MARKER}")("x")}, {quoted(MARKER)})')})) AS s FROM segments", "query_id", "s", "part"),
    "tokens_words": _TOKENS,
    "tokens_detokenized": "SELECT query_id, " + steps(sub(rf"{WS}+([.,;!?…)\]}}”%])", r"\1"), sub(rf"{WS}+(['’](?:s|re|ve|d|ll|m|t))({NO_WORD}|$)", r"\1\2", 2), sub(rf"([(\[{{“]){WS}+", r"\1"))("array_to_string(tokens, ' ')") + f" AS text FROM ({_TOKENS})",
    "tokens_search": f"SELECT query_id, list_filter(regexp_extract_all(lower(src_text), '{WORD}+'), lambda v: regexp_matches(v, '^[a-z0-9]+$')) AS tokens FROM segments",
    "tokens_simple": f"SELECT query_id, list_filter(list_transform(list_filter(regexp_extract_all(lower(src_text), '{WORD}+'), lambda v: regexp_matches(v, '^_*\\p{{L}}+$')), lambda v: ltrim(v, '_')), lambda v: length(v) BETWEEN 2 AND 15) AS tokens FROM segments",
    "entity_lists": "SELECT query_id, " + ", ".join(f"regexp_extract_all(src_text, {quoted(re2(E.PATTERNS[n]))}) AS {n}" for n in E.SIMPLE) + " FROM segments",
    "canonical_text": "SELECT query_id, NOT (" + " OR ".join(f"regexp_matches(src_text, {quoted('(?s)' + p)})" for p in _HIDDEN.values()) + ") AS canonical FROM segments",
    "text_characters": "SELECT text_id, " + ", ".join(f"regexp_matches(texts, '[" + "".join(f"\\p{{{x}}}" for x in names.split()) + f"]{{2,}}') AS {lang}" for lang, names in _SCRIPTS.items()) + " FROM html_text_process",
    "chinese_predicates": f"""WITH n AS (SELECT *, length(regexp_replace(texts, '[^{S.SIMPLIFIED}]', '', 'g')) AS s, length(regexp_replace(texts, '[^{S.TRADITIONAL}]', '', 'g')) AS t FROM html_text_process)
SELECT text_id, regexp_matches(texts, '^[\\p{{Han}}{_WIDE}“”‘’…—]+{_END}') AS chinese, regexp_matches(texts, '^[\\p{{Han}}\\p{{Hiragana}}\\p{{Katakana}}ー{_WIDE}]+{_END}') AS japanese, CASE WHEN s > t THEN 'zhs' WHEN t > s THEN 'zht' END AS system, translate(texts, '{S.SIMPLIFIED}', '{S.TRADITIONAL}') AS converted FROM n""",
    "similarity_levenshtein": f"SELECT tm_id, round({_LEVENSHTEIN}, 6) AS s FROM ({_SIMILAR})",
    "similarity_builtin": f"SELECT tm_id, round({_LEVENSHTEIN}, 6) AS levenshtein, {_SET('k / (m + n - k)')} AS jaccard, {_SET('2 * k / (m + n)')} AS sorensen_dice, {_SET('k / sqrt(m::DOUBLE * n)')} AS cosine FROM (SELECT *, length(a) AS m, length(b) AS n, {_SHARED} AS k FROM ({_SIMILAR}))",
    "similarity_jaro": f"SELECT tm_id, {_WHEN_BOTH('jaro_similarity(a, b)')} AS jaro, {_WHEN_BOTH('jaro_winkler_similarity(a, b)')} AS jaro_winkler FROM ({_SIMILAR})",
    "vector_repair": "SELECT vec_id, CASE WHEN vec_id % 7 = 0 OR len(embedding) <> 64 THEN 0.0 ELSE round(list_sum(list_transform(embedding, lambda x: CAST(abs(x) AS DOUBLE))), 3) END AS total FROM embeddings",
    "section_runs": r"""WITH l AS (SELECT text_id, unnest(string_split(texts, chr(10))) AS line, unnest(range(len(string_split(texts, chr(10))))) AS line_no FROM html_text_process WHERE stage = 'segment'),
m AS (SELECT *, last_value(CASE WHEN regexp_matches(line, '^[A-Z][^.!?]*$') THEN line_no END IGNORE NULLS) OVER (PARTITION BY text_id ORDER BY line_no) AS top FROM l),
s AS (SELECT m.*, h.line AS section, count(*) FILTER (WHERE trim(m.line, ' ') = '' AND m.line_no > top) OVER (PARTITION BY m.text_id, top ORDER BY m.line_no) AS ended FROM m JOIN l h ON h.text_id = m.text_id AND h.line_no = m.top)
SELECT text_id, CAST(line_no AS INTEGER) AS line_no, section FROM s WHERE line_no > top AND ended = 0""",
    "visible_text": """WITH p AS (SELECT crawl_id, regexp_replace(trim(src_url), '[?#].*$', '') AS url, list_transform(string_split(regexp_replace(coalesce(src_content, ''), '[<>&]', '', 'g'), chr(10)), lambda x: """ + trim(f"regexp_replace(x, '{WS}+', ' ', 'g')") + """) AS x FROM general_crawler WHERE src_url IS NOT NULL)
SELECT url, list_sort(list_distinct(list_filter(list_concat(['Français', 'next', 'pdf'], x), lambda v: v <> ''))) AS lines FROM p WHERE url LIKE 'http%'""",
    "document_type": """SELECT crawl_id, CASE crawl_id % 3 WHEN 0 THEN 'word' WHEN 1 THEN 'none' ELSE 'pdf' END AS type FROM general_crawler WHERE src_url IS NOT NULL AND regexp_replace(trim(src_url), '[?#].*$', '') LIKE 'http%'""",
}

_FRENCH_APART: list[Step] = [*_APART[:4], sub(r"([lLdDjJnNmMtTsScC]|qu|Qu)(['’])(\p{L})", r"\1\2 \3", 2)]
_split = lambda t: f"list_filter(string_split_regex({t}, '{WS}+'), lambda v: v <> '')"
_BOTH = """SELECT query_id AS line_no, CASE WHEN lower(trim(src_lang)) = 'eng' THEN src_text ELSE tgt_text END AS src, CASE WHEN lower(trim(src_lang)) = 'eng' THEN tgt_text ELSE src_text END AS tgt FROM segments
WHERE (lower(trim(src_lang)) = 'eng' AND lower(trim(tgt_lang)) = 'fra' OR lower(trim(src_lang)) = 'fra' AND lower(trim(tgt_lang)) = 'eng') AND src_text IS NOT NULL AND tgt_text IS NOT NULL"""
_A = f"SELECT line_no, {_split('t')} AS src_tokens FROM ({staged('(' + _BOTH + ')', 'line_no', 'src', [*ENGLISH, lambda t: f'lower({t})', *_APART])})"
_B = f"SELECT line_no, {_split('t')} AS tgt_tokens FROM ({staged('(' + _BOTH + ')', 'line_no', 'tgt', [*FRENCH, numbers_french, lambda t: f'lower({t})', *_FRENCH_APART])})"
_STOP = ", ".join(f"'{w}'" for w in STOP)
_WORDS = "d AS (SELECT query_id, coalesce(regexp_extract_all(lower(src_text), '[a-z0-9]+'), []) AS t FROM segments)"
SQL |= {
    "term_preprocess": f"SELECT line_no, src_tokens, tgt_tokens FROM (SELECT *, row_number() OVER (PARTITION BY src_tokens, tgt_tokens ORDER BY line_no) AS r FROM ({_A}) JOIN ({_B}) USING (line_no) WHERE len(src_tokens) > 0 AND len(tgt_tokens) > 0) WHERE r = 1",
    "term_combo_basic": f"""WITH {_WORDS}, p AS (SELECT t, unnest(range(len(t))) AS i FROM d),
g AS (SELECT array_to_string(t[i + 1 : i + n], ' ') AS term, CAST(n AS INTEGER) AS words, count(*) AS freq FROM p, range(1, 5) v(n) WHERE i + n <= len(t) AND len(list_filter(t[i + 1 : i + n], lambda w: NOT regexp_matches(w, '^\\p{{L}}+(?:-\\p{{L}}+)*$') OR w IN ({_STOP}))) = 0 GROUP BY 1, 2 HAVING count(*) >= 2),
s AS (SELECT DISTINCT g.term AS whole, array_to_string(string_split(g.term, ' ')[i + 1 : i + k], ' ') AS term FROM g, range(1, 4) a(k), range(0, 4) b(i) WHERE k < words AND i + k <= words), x AS (SELECT s.* FROM s JOIN g USING (term))
SELECT term, words, freq, round(words * ln(freq) + 0.75 * coalesce((SELECT count(*) FROM x WHERE x.term = g.term), 0) + 0.1 * coalesce((SELECT count(*) FROM x WHERE x.whole = g.term), 0), 6) AS score FROM g""",
    "find_word_index": f"WITH {_WORDS} SELECT query_id, list_transform(list_filter(range(len(t)), lambda i: t[i + 1] = 'of' AND coalesce(t[i + 2], '') = 'the'), lambda i: CAST(i AS INTEGER)) AS pair, list_transform(list_filter(range(len(t)), lambda i: t[i + 1] = 'the'), lambda i: CAST(i AS INTEGER)) AS one FROM d",
    "symmetrized_links": "SELECT p_partkey, array_to_string(list_transform(list_filter(range(5), lambda i: (p_size * ((p_partkey * (i + 3) + i) % 5 + 2) + (p_partkey * (i + 3) + i) % 5) % 5 = i), lambda i: i || '-' || ((p_partkey * (i + 3) + i) % 5)), ' ') AS kept, CAST(0 AS INTEGER) AS beyond FROM part",
    "page_fetch_filter": "SELECT crawl_id FROM general_crawler WHERE http_status = 200",
}
