"""Problem 3: sentence boundaries across languages and scripts.

Candidate boundaries are ends of terminal marks with their closing marks, line breaks, and in Thai also blanks. A maximum-
entropy (logistic) model classifies each from the neighbouring tokens, their case, length, digits and script, the marks, the
quotation around and the layout. It is trained on reliable boundaries: line ends after a terminal mark for, a lower-case
continuation or a decimal against; a token type before a full stop that is often found inside lines but never at their ends
is an abbreviation (with a short fixed list, as small corpora show too few). The fit reads at most ``FIT_TEXTS`` texts (by
hash of the id; a documented bound); every text is segmented whole.

Blank lines and list markers always bound; nothing inside a closed quotation or bracket does. Null and blank texts and rows
with a null id have no units. Every non-white character belongs to exactly one unit. Repeated rows have units each.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from corploom.operators.skew import hash_sample
from corploom.session import spread, table

FIT_TEXTS = 6_000
# Common abbreviations that don't end a sentence before a capital or digit.
ABBREVIATIONS = set("dr mr mrs ms prof st no nos fig figs pp p vs approx cf sec ch e.g i.e eq vol ed ltd corp co jr sr m mm mme mlle me pr dre art al suiv ex p.ex env av bd inc ca mio mrd nr abs bzw z b d h u a usw str hr fr sr sra dra srta ee uu pág núm г гг ул тыс руб млн млрд т е д п др им см стр рис д डॉ श्री د أ jan feb apr jun jul aug sept oct nov dec".split())
MARKS = ".!?…。！？؟।．"
_MARK = re.compile(r"[.!?…。！？؟।．｡]+|(?<=[ऀ-ॿ])\|")
#: The same for texts without a bar: a pattern that begins with a set is searched much faster.
_PLAIN_MARK = re.compile(r"[.!?…。！？؟।．｡][.!?…。！？؟।．｡]*")
_OPEN = {"“": "”", "«": "»", "„": "“”", "「": "」", "『": "』", "《": "》", "〈": "〉", "（": "）", "(": ")", "[": "]", "【": "】", "‹": "›"}
_ANY_OPEN = re.compile(r"[“«„「『《〈（(\[【‹\"]")
_CLOSE = set("”»“」』》〉）)]】›")
_LIST = re.compile(r"[ \t ]*(?:[-*•–—→‣▪·]|\(?\d{1,3}[.)]|\(?[a-zA-Z][.)])[ \t ]+(?=\S)")
_TOKEN_AFTER = re.compile(r"[\W_]*?(\w+)")
_GAP = re.compile(r"\s*")
_THAI = re.compile(r"[฀-๿]")


@cache
def kind(c: str) -> str:
    """Class of a character."""
    if not c:
        return "E"
    o = ord(c)
    if c.isdigit():
        return "9"
    if 0x0E00 <= o <= 0x0E7F:
        return "T"
    if 0x3040 <= o <= 0x30FF or 0x4E00 <= o <= 0x9FFF or 0x3400 <= o <= 0x4DBF:
        return "C"
    if 0x0600 <= o <= 0x06FF:
        return "A"
    if 0x0900 <= o <= 0x097F:
        return "H"
    if c.isupper():
        return "U"
    if c.islower():
        return "l"
    if c in _OPEN or c in "\"'¿¡":
        return "Q"
    if c in "-–—":
        return "D"
    if c.isspace():
        return "_"
    return "P"


def token_before(text: str) -> str:
    """The last characters up to white space; a line break at the end doesn't count."""
    if text[-1:] == "\n":
        text = text[:-1]
    return text.rsplit(None, 1)[-1] if text and not text[-1].isspace() else ""


def spans(text: str) -> Sequence[int]:
    """For each position the end of the outermost closed quotation or bracket it is strictly inside of, else 0. Paragraphs are apart."""
    if not _ANY_OPEN.search(text):
        return bytes(len(text) + 1)
    inside = [0] * (len(text) + 1)
    for para in re.finditer(r"(?:[^\n]|\n(?![^\S\n]*\n))+", text):
        stack: list[tuple[int, str]] = []
        for i in range(para.start(), para.end()):
            c = text[i]
            if stack and c in stack[-1][1]:
                start, _ = stack.pop()
                if not stack:
                    for k in range(start + 1, i + 1):
                        inside[k] = i + 1
            elif c in _OPEN:
                # a closing mark nearer the outside ends unclosed ones within
                stack.append((i, _OPEN[c]))
            elif c == '"':
                before = text[i - 1] if i else " "
                if (before.isspace() or before in "([«“") and i + 1 < len(text) and not text[i + 1].isspace():
                    stack.append((i, '"'))
            elif c in _CLOSE and any(c in s[1] for s in stack):
                while stack and c not in stack[-1][1]:
                    stack.pop()
                start, _ = stack.pop()
                if not stack:
                    for k in range(start + 1, i + 1):
                        inside[k] = i + 1
    return inside


def soft_breaks(block: list[str], width: int) -> list[bool]:
    """For each line break of a block, whether a line width made it: the next word would have passed the width.

    The width is the longest line of the text. Two lines alone show no width, so there the continuation must look like one;
    and where paragraphs of any length are lines, the longest is no width: a width over 130 needs two such breaks in a block.
    """
    out = []
    wide = sum(len(a.rstrip()) + 1 + len(b.split(None, 1)[0]) > width for a, b in zip(block, block[1:])) > 1 if width > 130 else True
    for a, b in zip(block, block[1:]):
        line, word = a.rstrip(), b.split(None, 1)[0]
        forced = wide and len(line) + 1 + len(word) > width
        if forced and len(block) < 3 and line[-1] not in MARKS and line[-1] not in ",;" and word[:1].isupper():
            forced = False
        out.append(forced)
    return out


def spelled(traits: tuple) -> list[str]:
    """Feature names of a candidate's traits."""
    what, lang, mk, g, k, kn, kl, quoted, token, word, glued = traits
    size = min(len(token), 8) if mk == "." else int(token)
    f = [what, f"m{mk}", f"g{g}", f"k{k}", f"n{kn}", f"l{kl}", f"m{mk}n{kn}", f"{what}{g}{kn}{kl}", f"q{quoted}", f"q{quoted}{g}{kn}{kl}", f"L{lang}{what}", f"L{lang}m{mk}k{k}n{kn}", f"t{size}m{mk}n{kn}", f"w{word}q{quoted}"]
    if what == "mark" and mk == ".":
        digits = token.replace(",", "").replace(".", "").isdigit()
        short = token in ABBREVIATIONS or len(token) == 1 and token.isalpha() or bool(re.fullmatch(r"[a-z]([.-]+[a-z])+", token))
        f += [f"T{'9' if digits else token[:14]}L{lang}", f"T{'9' if digits else token[:14]}", f"A{short}{kn}", f"d{digits}{kn}L{lang}"]
        if k in "lU" and g == "no":
            f.append(f"glued{kn}{glued}")
    return f


class Text:
    """A text with its layout: hard breaks, and candidates with features."""

    def __init__(self, text: str, lang: str | None) -> None:
        self.text, self.lang = text, lang or "-"
        self.hard: list[int] = []  # places before which a unit begins for sure
        self.soft: set[int] = set()  # line breaks inside wrapped blocks: only white space
        self.markers: list[tuple[int, int]] = []
        at, block = 0, []
        lines = text.split("\n")
        starts = []
        for line in lines:
            starts.append(at)
            at += len(line) + 1
        self.breaks: list[tuple[int, int]] = []  # (end of a line, start of the next) where the model decides
        k, self.width = 0, max(len(x.rstrip()) for x in lines)
        while k < len(lines):
            if not lines[k].strip():
                k += 1
                continue
            e = k
            while e + 1 < len(lines) and lines[e + 1].strip():
                e += 1
            self.hard.append(starts[k])
            block = lines[k : e + 1]
            lists = [bool(_LIST.match(x)) for x in block]
            soft = soft_breaks(block, self.width)
            for j in range(k, e + 1):
                m = _LIST.match(lines[j])
                if m:
                    self.markers.append((starts[j], starts[j] + m.end()))
                if j > k:
                    if m:
                        self.hard.append(starts[j])
                    elif soft[j - k - 1] and not lists[j - k - 1]:
                        self.soft.add(starts[j])
                    else:
                        self.breaks.append((starts[j] - 1, starts[j]))
            k = e + 1
        self.inside = spans(text)

    @classmethod
    def line(cls, text: str, lang: str | None) -> "Text":
        """A text of one line: nothing to find out about its layout."""
        t = cls.__new__(cls)
        t.text, t.lang, t.hard, t.soft, t.breaks, t.width = text, lang or "-", [0], set(), [], len(text)
        m = _LIST.match(text)
        t.markers = [(0, m.end())] if m else []
        t.inside = spans(text)
        return t

    def candidates(self) -> list[tuple[int, str]]:
        """(place, kind): a unit may end before the place; mark, line or blank. In order."""
        text, out = self.text, {}
        marked = {i for a, b in self.markers for i in range(a, b)}
        last = len(text.rstrip())
        for m in (_MARK if "|" in text else _PLAIN_MARK).finditer(text):
            e = m.end()
            if m.start() in marked:
                continue
            while e < len(text):
                c = text[e]
                if c in _CLOSE and c != "“" or c in "\"“" and self.inside[e] == e + 1:
                    e += 1
                elif c in "   " and e + 1 < len(text) and text[e + 1] == "»":
                    e += 2
                else:
                    break
            if self.inside[e] or e >= last:
                continue
            out[e] = "mark"
        for a, b in self.breaks:
            if not self.inside[b]:
                e = len(text[:a].rstrip())
                if out.get(e) != "mark" and text[b:].lstrip()[:1] not in MARKS + ":;»%":
                    out[e] = "line"
        if self.lang == "tha" or self.lang == "-" and len(_THAI.findall(text)) > 0.5 * len(text):
            for m in re.finditer(r"(?<=\S)[^\S\n]+(?=\S)", text):
                if not self.inside[m.end()] and m.end() - 1 not in marked and m.start() not in out:
                    out[m.start()] = "blank"
            for b in self.soft:
                e = len(text[:b].rstrip())
                out.setdefault(e, "blank")
        return sorted(out.items())

    def features(self, place: int, what: str, start: int, never: set[str] | frozenset = frozenset()) -> list[str]:
        """Features of a candidate, if a unit began at ``start``."""
        text = self.text
        if what == "line":
            return self.line_features(place, start, never)
        return spelled(self.traits(place, what, start))

    def traits(self, place: int, what: str, start: int) -> tuple:
        """What the features of a candidate after a mark, or at a blank, are made of; few different ones occur often."""
        text = self.text
        e = place
        while e > start and (text[e - 1] in _CLOSE or text[e - 1] == '"' or text[e - 1] in "   "):
            e -= 1
        closers = text[e:place].strip()
        m = e
        while m > start and text[m - 1] in MARKS + "|｡":
            m -= 1
        mark = text[m:e]
        before = token_before(text[max(start, m - 30) : m])
        token = before.lower().strip("(\"'«“„[¿¡»”)")
        gap = _GAP.match(text, place).group()
        rest = text[place + len(gap) : place + len(gap) + 40]
        nxt = rest[:1]
        after = _TOKEN_AFTER.match(rest)
        word = after.group(1).lower() if after else ""
        letter = after.group(1)[0] if after else ""
        g = "line" if "\n" in gap and any(place <= a[1] <= place + len(gap) for a in self.breaks) else "sp" if gap else "no"
        mk = mark[:1] if len(mark) < 2 else "…" if set(mark) <= set(".…") else mark[:2]
        k, kn, kl = kind(text[m - 1] if m else ""), kind(nxt), kind(letter)
        quoted = "-"
        if closers:
            o = start
            while o < len(text) and text[o].isspace():
                o += 1
            first = text[o : o + 1]
            opened = (first in _OPEN and first not in "([（《" or first == '"') and self.inside[min(o + 1, len(text))] == place
            if not opened and first and first in _OPEN:
                opened = self.inside[o + 1] >= place - 2 and first not in "([（《"
            colon = re.search(r"[:：]\s*$", text[start : max(start, self._opener(place))]) is not None
            quoted = "start" if opened else "colon" if colon else "in"
        glued = k in "lU" and g == "no" and ("@" in before or "www" in before or "/" in before)
        return what, self.lang, mk, g, k, kn, kl, quoted, token if mk == "." else str(min(len(token), 8)), word[:12], glued

    def line_features(self, place: int, start: int, never: set[str] | frozenset = frozenset()) -> list[str]:
        """Features of a line break without a terminal mark before it: a heading's or list item's end, or a wrapped line."""
        text = self.text
        before = token_before(text[max(start, place - 30) : place]).lower().replace("’", "'")
        rest = text[_GAP.match(text, place).end() :][:60]
        word = rest.split(None, 1)[0] if rest else ""
        token = before.rsplit("'", 1)[-1] if len(before) > 4 else before
        shape = "9" if any(c.isdigit() for c in before) else token[:12]
        line = text.rfind("\n", 0, place) + 1
        n = len(text[start:place].split())
        forced = place - line + 1 + len(word) > self.width
        whole = line <= start + 1 or not text[start:line].strip()
        kn, k = kind(rest[:1]), kind(text[place - 1 : place])
        return ["line", f"lk{k}", f"ln{kn}", f"lt{shape}", f"lt{shape}n{kn}", f"lf{forced}", f"lf{forced}n{kn}w{whole}", f"lw{whole}{n <= 14}", f"ls{len(token) <= 3 and token.isalpha()}", f"lL{self.lang}n{kn}", f"never{token in never}"]

    def _opener(self, place: int) -> int:
        i = place - 1
        while i > 0 and self.inside[i] == self.inside[place - 1]:
            i -= 1
        return i

    def state(self, place: int, what: str, start: int) -> dict:
        """What the reliable labels look at."""
        text = self.text
        e = place
        while e > start and (text[e - 1] in _CLOSE or text[e - 1] == '"' or text[e - 1] in "   "):
            e -= 1
        m = e
        while m > start and text[m - 1] in MARKS + "|｡":
            m -= 1
        gap = _GAP.match(text, place).group()
        rest = text[place + len(gap) : place + len(gap) + 40]
        return {"mark": text[m:e], "token": token_before(text[max(start, m - 30) : m]).lower().strip("(\"'«“„[¿¡»”)"), "gap": gap, "next": rest[:1], "before": text[m - 1] if m else "", "rest": rest}


def label(t: Text, place: int, what: str, start: int, feats: list[str], kinds: dict[str, str]) -> int | None:
    """1 or 0 for a reliable boundary or non-boundary; None if unclear."""
    s = t.state(place, what, start)
    nxt, gap, mark = s["next"], s["gap"], s["mark"]
    kn = kind(nxt)
    at_line = "\n" in gap and not any(b in t.soft for b in range(place, place + len(gap) + 1))
    if what == "blank":
        return 0 if kind(s["before"]) == "9" or kn == "9" else 1
    if what == "line":
        return 0 if kn == "l" or s["before"] in ",;:،；：、(-" or "neverTrue" in feats else None
    if nxt and nxt in ",;:،；：、%)" or kn == "l" and kind(s["before"]) != "C":
        return 0
    if at_line:
        return 0 if mark == "." and kinds.get(s["token"]) == "abbr" else 1
    if "qstart" in feats and kn in "CHAl":
        return 0
    if mark and mark[0] in "。！？।｡؟|" or mark and set(mark) & set("!?"):
        return 1 if kn in "UCHAQ9T" else None
    if set(mark) <= set("．"):
        return 1
    if mark in ("……", "…") and kn == "C":
        return 0
    if mark == ".":
        token = s["token"]
        if not gap and (kn in "9lD" or kind(s["before"]) == "_" or not token):
            return 0
        if kn == "C" or s["before"] in "{}<>|\\/=_@#":
            return 0
        if token.replace(",", "").replace(".", "").isdigit():
            return 0 if t.lang == "deu" and len(token) <= 2 else 1 if kn in "UQ" else None
        if len(token) == 1 and token.isalpha() or re.fullmatch(r"[^\W\d_]([.-]+[^\W\d_])+", token) and kinds.get(token) != "end":
            return 0
        if kinds.get(token) == "abbr" or token in ABBREVIATIONS and kinds.get(token) != "end":
            return 0
        if kinds.get(token) == "end" or len(token) > 3 and kinds.get(token) is None:
            return 1 if kn in "UQAH9" else None
        return None
    return 1 if kn in "UQ" else None


def token_kinds(texts: list[Text]) -> dict[str, str]:
    """Token types before a full stop: "abbr" if often inside lines and never at their ends, "end" if found at line ends."""
    mid, end = Counter(), Counter()
    for t in texts:
        for place, what in t.candidates():
            if what == "mark":
                s = t.state(place, what, 0)
                if s["mark"] == ".":
                    if "\n" in s["gap"] and not any(b in t.soft for b in range(place, place + len(s["gap"]) + 1)):
                        end[s["token"]] += 1
                    elif s["gap"]:
                        mid[s["token"]] += 1
        tail = t.text.rstrip().rstrip("\"”»)")
        if tail.endswith("."):
            end[token_before(tail[-31:-1]).lower().strip("(\"'«“„[¿¡»”)")] += 1
    rate = sum(end.values()) / max(sum(mid.values()) + sum(end.values()), 1)
    out = {}
    for w in mid.keys() | end.keys():
        if end[w] and end[w] >= 0.2 * rate * (mid[w] + end[w]):
            out[w] = "end"
        elif mid[w] * -math.log(max(1e-9, 1 - rate)) > 3.5 and end[w] <= 0.02 * mid[w]:
            out[w] = "abbr"
    return out


def never_final(texts: list[Text]) -> set[str]:
    """Frequent words that (almost) never stand before a terminal mark or a sure end: function words, mostly."""
    whole, final = Counter(), Counter()
    for t in texts:
        whole.update(re.findall(r"[^\W\d_]+", t.text.lower()))
        final.update(m.group(1) for m in re.finditer(r"([^\W\d_]+)[\s»”\"']*(?:[.!?…。！？؟।．,;:]|\n|$)", t.text.lower()))
    return {w for w, n in whole.items() if n >= 10 and final[w] <= 0.08 * n}


class Segmenter:
    """Weights of the maximum-entropy model; the left-to-right decision."""

    def __init__(self) -> None:
        self.weights: dict[str, float] = {}
        self.never: set[str] = set()
        self.known: dict[tuple, bool] = {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"known": {}}

    def fit(self, rows: list[tuple[str, str | None]], epochs: int = 25, rate: float = 0.5) -> "Segmenter":
        texts = [Text(x, lang) for x, lang in rows if x and x.strip()]
        kinds = token_kinds(texts)
        self.never = never_final(texts)
        seen: list[tuple[list[str], int]] = []
        for t in texts:
            hard, start = sorted(t.hard), 0
            for h, nxt in zip(hard, hard[1:]):
                # lines that end before a blank line or a list marker, without a terminal mark: ends for sure
                e = len(t.text[:nxt].rstrip())
                line = max(h, t.text.rfind("\n", 0, e) + 1)
                if e > h and not t.inside[e] and t.text[e - 1] not in MARKS and t.text[e - 1] not in _CLOSE and t.text[e - 1] != '"':
                    seen.append((t.line_features(e, line, self.never), 1))
            for place, what in t.candidates():
                start = max([start, *(h for h in hard if h < place)])
                f = t.features(place, what, start, self.never)
                y = label(t, place, what, start, f, kinds)
                if y is not None:
                    seen.append((f, y))
                if y or y is None and what == "mark":
                    start = place
        index: dict[str, int] = {}
        count = Counter(x for f, _ in seen for x in f)
        rows_i = [[index.setdefault(x, len(index)) for x in f if count[x] > 1] for f, _ in seen]
        if not rows_i:
            return self
        flat = np.concatenate([np.array(r, np.int64) for r in rows_i])
        owner = np.repeat(np.arange(len(rows_i)), [len(r) for r in rows_i])
        y = np.array([v for _, v in seen], float)
        w, g2 = np.zeros(len(index)), np.full(len(index), 1e-6)
        for _ in range(epochs * 4):
            z = np.bincount(owner, w[flat], len(y))
            d = 1 / (1 + np.exp(-z)) - y
            g = np.bincount(flat, d[owner], len(w)) / len(y) + 1e-5 * w
            g2 += g * g
            w -= rate * g / np.sqrt(g2)
        self.weights = {x: float(w[i]) for x, i in index.items()}
        return self

    def probability(self, feats: list[str]) -> float:
        get = self.weights.get
        z = sum(get(x, 0.0) for x in feats)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))

    def units(self, text: str, lang: str | None = None) -> list[tuple[int, int]]:
        """(start, end) of the units of a text."""
        t = Text(text, lang) if "\n" in text else Text.line(text, lang)
        cuts, start, h = list(t.hard), 0, 0
        hard = sorted(t.hard)
        for place, what in t.candidates():
            while h < len(hard) and hard[h] < place:
                start = max(start, hard[h])
                h += 1
            if self._decide(t, place, what, start):
                cuts.append(place)
                start = place
        out, last = [], 0
        for c in sorted({*cuts, 0, len(text)})[1:]:
            piece = text[last:c]
            s = piece.strip()
            if s:
                a = last + len(piece) - len(piece.lstrip())
                out.append((a, a + len(s)))
            last = c
        return out

    def _decide(self, t: Text, place: int, what: str, start: int) -> bool:
        """The model's decision, whatever the candidate."""
        if what == "line":
            return self.probability(t.line_features(place, start, self.never)) >= 0.5
        traits = t.traits(place, what, start)
        got = self.known.get(traits)
        if got is None:
            if len(self.known) > 100_000:
                self.known.clear()
            got = self.known[traits] = self.probability(spelled(traits)) >= 0.5
        return got


def segment_texts(texts: DataFrame, id_col: str = "text_id", text_col: str = "texts", lang_col: str = "lang") -> DataFrame:
    """(text_id, start_pos, end_pos): the units of every text."""
    rows = texts.select(F.col(id_col).alias("text_id"), F.col(text_col).alias("texts"), F.col(lang_col).alias("lang")).where("text_id IS NOT NULL AND texts IS NOT NULL")
    sample = sorted(hash_sample(rows, "text_id", FIT_TEXTS).collect(), key=lambda r: r[0])
    model = texts.sparkSession.sparkContext.broadcast(Segmenter().fit([(r[1], r[2]) for r in sample]))

    def cut_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = [(i, a, b) for i, t, lang in zip(pdf["text_id"], pdf["texts"], pdf["lang"]) for a, b in model.value.units(t, lang)]
            yield pd.DataFrame(out, columns=["text_id", "start_pos", "end_pos"]).astype({"text_id": "int64", "start_pos": "int32", "end_pos": "int32"})

    return rows.mapInPandas(cut_up, "text_id long, start_pos int, end_pos int")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment_texts(spread(table(spark, sf_dir, "html_text_process").where("stage = 'segment'").select("text_id", "texts", "lang"), "text_id"))


def p3_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(text_id, start_pos, sentence): the sentences themselves."""
    texts = table(spark, sf_dir, "html_text_process").where("stage = 'segment'")
    return p3_found(spark, sf_dir).join(texts.select("text_id", "texts"), "text_id").select("text_id", "start_pos", F.substring("texts", F.col("start_pos") + 1, F.col("end_pos") - F.col("start_pos")).alias("sentence"))


QUERIES = {"p3_found": p3_found, "p3_sentences": p3_sentences}
SQL: dict[str, str] = {}
