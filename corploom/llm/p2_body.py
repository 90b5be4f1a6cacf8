"""Problem 2: the main body of each page among menus, notices, teasers, comments and footers.

Every line of a side is a block. A numpy bidirectional LSTM reads, for the whole sequence of blocks, one vector each: the
block's path (leading and trailing marks, case, shape, length, place), hashed words (the first three and the last two by
their place, and the sum of all words of the line), and document-wide context (words shared with the page's address and with its running text; whether the line stands on several
addresses of the site). It gives each block the probability of body.

Corpus-wide counts give the standing lines: (site, line) pairs on three or more pages, two or more addresses and 3 % of the
site's pages. The share bounds a site's list: as a page has few lines, it has at most lines-per-page / 0.03 of them. Pages get them by a broadcast if
their counted number is small, so that texts stay where they are; else big sites by a broadcast, the others by a shuffle. The network is fitted on at most ``FIT_PAGES`` pages (by hash of the id; a documented bound), labelled by rules for
clear cases only (cue phrases, recurring lines, full sentences, the page's own heading); unclear lines carry little weight.

Null and empty sides, and rows with a null id, have no body; blank lines are counted but never labelled. Rows with null urls belong to no site and
have no standing lines. Repeated rows are labelled each.
"""

from __future__ import annotations

import gc
import re
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corploom.llm.p1_lines import site_of
from corploom.operators.skew import hash_sample, hot_limit
from corploom.session import cut, spread, table

STANDING_PAGES, STANDING_SHARE = 3, 0.03
#: Letters of a standing line at least: shorter ones are known by their words.
STANDING_LETTERS = 20
#: So many keys of standing lines in all may be broadcast (8 bytes each).
SMALL_KEYS = 2_000_000
FIT_PAGES, FIT_STEPS, FIT_BATCH = 1_500, 260, 64
BUCKETS, WIDTH, HIDDEN = 4_096, 20, 16
SLOTS = 5
#: Blocks whose words are summed at once, and words of the longest line that can be the page's own heading.
SUM_BLOCKS, HEADING_WORDS = 4_096, 16
# Cue phrases of page furniture, English and French.
CUES = re.compile(
    r"cookie|témoins|privacy|vie privée|confidentialité|rights reserved|droits réservés|terms of use|conditions d'utilisation|newsletter|infolettre|^follow us|^suivez-nous|^share this|^partager|"
    r"^send to a friend|^envoyer à un ami|^print this|^imprimer|^story continues|^la suite ci-dessous|^advertisement|^publicité|^related stories|^articles connexes|^most read|^les plus lus|^also from|^aussi sur|"
    r"^in this section|^dans cette section|^skip to|^passer au contenu|^log in|^connexion|^site map|^plan du site|^home\b|^accueil\b|^contact( us)?$|^(keyword|tag)s\b|^étiquettes|^mots-clés|^next\b|^suivant\b|^read next|^see also|"
    r"^à lire|^voir aussi|^from our partners|^de nos partenaires|^sponsored|^commandité|^registered office|^siège social|^related\b|^lié\b|^à voir\b|^weather\b|^météo|^reading time|^temps de lecture|^last updated|^dernière mise à jour|"
    r"^published by|^publié par|^translated by|^traduit par|^by the .* desk|^par la rédaction|^was this page|^cette page vous|^\d+ comments?|^comment(s|aires)\b|^no part of this text|^aucune partie de ce texte|"
    r"legal advice|avis juridique|have equal value|ont valeur égale|^©|^my basket|^mon panier|^accept all|^tout accepter|^refuse|^manage my|^gérer mes|read more\W*$|lire la suite\W*$|^frequently asked|^foire aux"
)
COMMENT = re.compile(r"^\W*[\w'’.-]+(?: [\w'’.-]+)?\s*(?:@\s*\d|says\s*:|said\s*:|wrote\s*:|writes\s*:|a écrit\s*:|dit\s*:|écrit\s*:|\(?\d{1,2}:\d\d)|^\W*↳")
BYLINE = re.compile(r"^reading time|^temps de lecture|^last updated|^dernière mise à jour|^published by|^publié par|^translated by|^traduit par|^by the .* desk|^par la rédaction")
#: A speaker before a whole sentence.
SPEAKER = re.compile(r"^\W*[^\W\d_][\w'’-]+\s?:\s")
_SENTENCE_END = re.compile(r"[.!?]['\"”’»)\]*\s]*$")
_WORDS = re.compile(r"[^\W_]+")
_LEAD = re.compile(r"^\s*([^\w\s\"'“«(]+|\d{1,3}[.)]|[a-z][.)](?=\s))")
_PLAIN_ENDS = set("_\"'”»).!?%")
_SUFFIX = re.compile(r"\.\w{2,5}$")
_DIGIT = re.compile(r"\d")
_DIGITS = re.compile(r"\d\d*")
_NOT_LETTER = re.compile(r"[\W\d_]+")
LEADS = {"→": 1, "»": 1, ">": 1, "+": 1, "↳": 2, "*": 3, "-": 4, "–": 4, "—": 4, "•": 5, "|": 6, "[": 6, "©": 7}


def letters(line: str) -> str:
    return _NOT_LETTER.sub("", line.lower())


def key64(line: str) -> int | None:
    """The line's letters as Spark's (signed) xxhash64; null if the line is too short to stand."""
    return letters_key(letters(line))


def letters_key(k: str) -> int | None:
    if len(k) < STANDING_LETTERS:
        return None
    h = xxhash.xxh64_intdigest(k.encode(), seed=42)
    return h - (1 << 64) if h >= 1 << 63 else h


def page_path(url: Column) -> Column:
    """The path of an address, however its scheme, host, query or ending are written: pages crawled again are one page."""
    path = F.regexp_extract(F.lower(F.trim(url)), r"^(?:[a-z][a-z0-9+.-]*://)?[^/?#]*([^?#]*)", 1)
    return F.regexp_replace(path, r"(?:/|\.[a-z]{2,5})$", "")


def site_standing(pages: DataFrame) -> DataFrame:
    """(site, n, standing array<long>): number of the site's pages, and hashes of the lines that stand on them, of either side; sites with such lines only."""
    # both sides of a page are one address, so that untranslated copies that are crawled again don't stand
    address = F.xxhash64(F.least(page_path(F.col("src_url")), page_path(F.col("tgt_url"))))
    sides = [pages.select(site_of(F.coalesce(F.col(u), F.col(v))).alias("site"), address.alias("address"), F.col(t).alias("text")) for u, v, t in (("src_url", "tgt_url", "src_content"), ("tgt_url", "src_url", "tgt_content"))]
    whole = sides[0].unionByName(sides[1]).where("site IS NOT NULL AND text IS NOT NULL AND text <> ''")
    # pages are counted without reading their texts
    sizes = pages.select(site_of(F.coalesce("src_url", "tgt_url")).alias("site")).where("site IS NOT NULL").groupBy("site").agg(F.count(F.lit(1)).alias("n"))
    # the letters of the whole text, line by line, then the keys of the page's different lines
    lines = F.filter(F.split(F.regexp_replace(F.lower("text"), r"[^\p{L}\n]+", ""), "\n"), lambda x: F.length(x) >= STANDING_LETTERS)
    keys = whole.select("site", "address", F.explode(F.array_distinct(F.transform(lines, lambda x: F.xxhash64(x)))).alias("key"))
    counts = keys.groupBy("site", "key").agg(F.count(F.lit(1)).alias("pages"), F.min("address").alias("a"), F.max("address").alias("b")).where((F.col("pages") >= STANDING_PAGES) & (F.col("a") != F.col("b")))
    known = counts.join(sizes, "site", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return known.where(F.col("pages") >= STANDING_SHARE * F.col("n")).groupBy("site").agg(F.first("n").alias("n"), F.collect_list("key").alias("standing"))


_word_ids: dict[str, int] = {}


def word_id(w: str) -> int:
    i = _word_ids.get(w)
    if i is None:
        if len(_word_ids) > 300_000:
            _word_ids.clear()
        i = _word_ids[w] = zlib.crc32(("#" * len(w) if w.isdigit() else w).encode()) % (BUCKETS - 1) + 1
    return i


DENSE = 30
_shapes: dict[str, tuple] = {}


def cut_off_end(s: str, words: list[str], ending: str, k: int) -> bool:
    """Whether a line breaks off in an ellipsis, perhaps before a link to the rest; ``ending`` is what follows its last letter or digit at ``k``."""
    if "…" in ending or "..." in ending:
        return True
    if not words or words[-1] not in ("more", "suite"):
        return False
    phrase = next((x for x in ("read more", "lire la suite") if s[:k].lower().endswith(x)), None)
    before = s[: k - len(phrase)].rstrip() if phrase else ""
    return before.endswith(("…", "...")) or before.endswith("]") and before[:-1].rstrip().endswith(("…", "..."))


def shape(line: str) -> tuple[bytes, bytes, list[str], bool, bool, int, list[str], int | None, bytes]:
    """Of one line without its page: ids of the end words, path features, words, is it a sentence, is it cut off, lead class, longer words (of no sentence), key, ids of all words. Kept by line."""
    got = _shapes.get(line)
    if got is not None:
        return got
    s = line.strip()
    low = s.lower()
    words = _WORDS.findall(low)
    k = len(s)
    while k and not s[k - 1].isalnum():
        k -= 1
    ending = s[k:]
    lead = None if s[:1].isalpha() and s[1:2] not in (".", ")") else _LEAD.match(s)
    kind = 0
    if lead:
        mark = lead.group(1)
        kind = 8 if mark[0].isalnum() else LEADS.get(mark[0], 9)
        if kind == 3 and s.endswith("*"):
            kind = 10
    n = len(words)
    cut_off = cut_off_end(s, words, ending, k)
    sentence = n >= 5 and not cut_off and bool(ending and _SENTENCE_END.search(ending))
    every = list(map(_word_ids.get, words))
    if None in every:
        every = list(map(word_id, words))
    hashed = [every[0], every[1] if n > 1 else 0, every[2] if n > 2 else 0, every[-1], every[-2] if n > 1 else 0] if n else [0] * SLOTS
    digits = bool(_DIGIT.search(s))
    f = [0.0] * 22
    f[kind] = 1.0
    f[11] = 1.0 if ending and ending[-1] not in _PLAIN_ENDS else 0.0
    f[12] = min(n, 40) / 20
    f[13] = 1.0 if n >= 8 else 0.0
    f[14] = 1.0 if sentence else 0.0
    f[15] = 1.0 if cut_off else 0.0
    f[16] = 1.0 if s.isupper() else 0.0
    f[17] = 1.0 if s == low else 0.0
    f[18] = 1.0 if ":" in s else 0.0
    f[19] = 1.0 if digits else 0.0
    f[20] = 1.0 if len(s) > 180 else 0.0
    f[21] = 1.0 if " > " in s or " | " in s else 0.0
    # the words are runs of letters and digits, so without the digits they are the line's letters
    joined = "".join(words)
    key = letters_key(_DIGITS.sub("", joined) if digits else joined) if len(joined) >= STANDING_LETTERS else None
    got = array("i", hashed).tobytes(), array("f", f).tobytes(), words, sentence, cut_off, kind, () if sentence else [w for w in words if len(w) > 3], key, array("i", every).tobytes()
    if len(line) <= 120:  # of longer lines the shape is made anew each time: few of them recur
        if len(_shapes) > 40_000:
            _shapes.clear()
        _shapes[line] = got
    return got


class Page:
    """The blocks of one side: line numbers, word ids (n, SLOTS), ids of all words one after the other and their number by block, dense features (n, DENSE), and what the rules need."""

    __slots__ = ("numbers", "ids", "words", "counts", "dense", "parts", "lines", "own", "named", "stands", "topic")

    def __init__(self, text: str, address: set[str], standing: set[int]) -> None:
        lines = text.split("\n")
        self.numbers = [i for i, line in enumerate(lines) if line and not line.isspace()]
        self.lines = lines if len(self.numbers) == len(lines) else [lines[i] for i in self.numbers]
        n = len(self.lines)
        parts = self.parts = [_shapes.get(line) or shape(line) for line in self.lines]
        self.ids = np.frombuffer(b"".join([p[0] for p in parts]), np.int32).reshape(n, SLOTS)
        self.words = np.frombuffer(b"".join([p[8] for p in parts]), np.int32)
        self.counts = np.array([len(p[2]) for p in parts], np.int64)
        self.dense = np.zeros((n, DENSE), np.float32)
        if n:
            self.dense[:, :22] = np.frombuffer(b"".join([p[1] for p in parts]), np.float32).reshape(n, 22)
        self.stands = np.array([p[7] in standing for p in parts], bool) if standing else np.zeros(n, bool)
        running: set[str] = set()
        for p, stands in zip(parts, self.stands.tolist()):
            if p[3] and not stands:
                running.update(p[2])
        own, topic, named = [0.0] * n, [0.0] * n, [False] * n
        disjoint, runs = address.isdisjoint, running.__contains__
        for k, p in enumerate(parts):
            words = p[2]
            if words:
                if not disjoint(words):
                    shared = [w for w in words if w in address]
                    own[k] = len(shared) / len(words)
                    if not p[3] and len(words) <= HEADING_WORDS:
                        line = self.lines[k]
                        named[k] = any(len(w) > 4 and (w.capitalize() in line or w.upper() in line or line == line.lower()) for w in shared)
                if p[6]:
                    topic[k] = sum(map(runs, p[6])) / len(p[6])
        self.own, self.topic, self.named = np.array(own), np.array(topic), np.array(named, bool)
        self.stands &= (self.own < 0.6) & ~self.named
        d = self.dense
        if n:
            d[:, 22] = self.stands
            d[:, 23] = self.own
            d[:, 24] = self.own >= 0.6
            d[:, 25] = self.named
            d[:, 26] = self.topic
            place = np.arange(n) / max(n, 1)
            d[:, 27] = place
            d[:, 28] = 1 - place
            d[:, 29] = 1.0


def address_words(url: str | None, other: str | None) -> set[str]:
    """Words of the last parts of both addresses."""
    out: set[str] = set()
    for u in (url, other):
        if isinstance(u, str):
            u = u.strip().lower()
            tail = (u.partition("?")[0].partition("#")[0] if "\n" not in u else re.sub(r"[?#].*", "", u)).rstrip("/").rsplit("/", 1)
            if len(tail) == 2:
                out.update(_WORDS.findall(_SUFFIX.sub("", tail[1]) if "." in tail[1] else tail[1]))
    return out


def rule_labels(page: Page, often: set[str]) -> tuple[np.ndarray, np.ndarray]:
    """Labels (1 body) and weights by rules for clear cases."""
    n = len(page.lines)
    y, w = np.zeros(n), np.zeros(n)
    sure, own, titles, by = [], -1, [], []
    for k, (line, p) in enumerate(zip(page.lines, page.parts)):
        low = re.sub(r"\s+", " ", re.sub(r"^[^\w©↳]+", "", line.lower().replace("’", "'")))
        crumb = bool(re.match(r"^\W*(home|accueil)\s*>", low))
        if page.stands[k] or letters(line) in often or CUES.search(low) or COMMENT.match(line) or p[4] or p[5] in (1, 2, 6, 7) or crumb or p[3] and SPEAKER.match(line):
            w[k] = 1.0
            if BYLINE.search(low):
                by.append(k)
        elif p[3] and len(p[2]) >= 6:
            y[k], w[k] = 1.0, 1.0
            sure.append(k)
        elif (page.own[k] >= 0.6 or page.named[k]) and len(p[2]) >= 3 and p[5] in (0, 10):
            y[k], w[k] = 1.0, 1.0
            own = k if own < 0 else own
        elif p[5] in (0, 10) and len(p[2]) >= 3:
            titles.append(k)
    if own < 0 and sure:
        # no line shares the address: the last title before the byline or, without one, before the first sentence
        end = next((k for k in by if k < sure[0]), sure[0])
        before = [k for k in titles if k < end]
        if before:
            own = before[-1]
            y[own], w[own] = 1.0, 0.7
    first = own if own >= 0 else (sure[0] - 2 if sure else n)
    last = sure[-1] if sure else own
    for k, p in enumerate(page.parts):
        if w[k] == 0:
            near = first <= k <= last + 3
            if p[5] in (3, 4, 5, 8) and near:
                y[k], w[k] = 1.0, 1.0
            elif first <= k <= last:
                y[k], w[k] = (1.0, 0.7) if page.topic[k] > 0 else (1.0, 0.15)
            elif not (near and sure and page.topic[k] >= 0.5):
                w[k] = 0.6
    return y, w


#: Ids of all words block by block, the (time x batch) rows of the blocks that have words, and their numbers of words.
Bag = tuple[np.ndarray, np.ndarray, np.ndarray]


class BiLSTM:
    """Embeddings and dense features into a bidirectional LSTM with a logistic output; forward, backward and Adam in numpy."""

    def __init__(self, seed: int = 7) -> None:
        r = np.random.RandomState(seed)
        n, h = WIDTH, HIDDEN
        self.p = {"e": (r.randn(SLOTS, BUCKETS, n) * 0.1).astype(np.float32), "d": (r.randn(DENSE, n) * 0.2).astype(np.float32), "o": (r.randn(2 * h + n) * 0.2).astype(np.float32), "ob": np.zeros(1, np.float32)}
        for k in "fb":
            self.p[f"w{k}"] = (r.randn(n + h, 4 * h) / np.sqrt(n + h)).astype(np.float32)
            self.p[f"b{k}"] = np.concatenate([np.zeros(h), np.ones(h), np.zeros(2 * h)]).astype(np.float32)
        self.p["a"] = (r.randn(BUCKETS, n) * 0.1).astype(np.float32)
        self.p["a"][0] = 0

    def inputs(self, ids: np.ndarray, dense: np.ndarray, bag: Bag | None = None) -> np.ndarray:
        x = dense @ self.p["d"]
        if bag is not None and len(bag[0]):
            # the vectors of all words of a block, over the root of their number
            words, rows, counts = bag
            starts, flat = np.cumsum(counts) - counts, x.reshape(-1, WIDTH)
            for a in range(0, len(rows), SUM_BLOCKS):
                first, n = starts[a], counts[a : a + SUM_BLOCKS]
                sums = np.add.reduceat(self.p["a"][words[first : first + n.sum()]], starts[a : a + SUM_BLOCKS] - first, axis=0)
                flat[rows[a : a + SUM_BLOCKS]] += sums / np.sqrt(n)[:, None].astype(np.float32)
        for s in range(SLOTS):
            x += self.p["e"][s][ids[..., s]]
        return np.tanh(x)

    def run(self, x: np.ndarray, mask: np.ndarray, k: str, keep: bool) -> tuple[np.ndarray, list]:
        """x (time, batch, width); the state stays where the mask is 0."""
        t, b, _ = x.shape
        h, c = np.zeros((b, HIDDEN), np.float32), np.zeros((b, HIDDEN), np.float32)
        wx, wh = self.p[f"w{k}"][:WIDTH], self.p[f"w{k}"][WIDTH:]
        zx = x.reshape(t * b, -1) @ wx
        zx = zx.reshape(t, b, -1) + self.p[f"b{k}"]
        out, kept = np.zeros((t, b, HIDDEN), np.float32), []
        for i in range(t) if k == "f" else range(t - 1, -1, -1):
            z = zx[i] + h @ wh
            g = 1 / (1 + np.exp(-z[:, : 3 * HIDDEN]))
            a = np.tanh(z[:, 3 * HIDDEN :])
            ig, fg, og = g[:, :HIDDEN], g[:, HIDDEN : 2 * HIDDEN], g[:, 2 * HIDDEN :]
            m = mask[i][:, None]
            cn = fg * c + ig * a
            tc = np.tanh(cn)
            hn = og * tc
            if keep:
                kept.append((i, h, c, ig, fg, og, a, tc, m))
            c, h = m * cn + (1 - m) * c, m * hn + (1 - m) * h
            out[i] = h
        return out, kept

    def forward(self, ids: np.ndarray, dense: np.ndarray, mask: np.ndarray, keep: bool = False, bag: Bag | None = None):
        x = self.inputs(ids, dense, bag)
        hf, kf = self.run(x, mask, "f", keep)
        hb, kb = self.run(x, mask, "b", keep)
        feats = np.concatenate([hf, hb, x], axis=2)
        return feats @ self.p["o"] + self.p["ob"], (x, feats, kf, kb)

    def gradients(self, ids: np.ndarray, dense: np.ndarray, mask: np.ndarray, y: np.ndarray, w: np.ndarray, bag: Bag | None = None) -> tuple[float, dict]:
        z, (x, feats, kf, kb) = self.forward(ids, dense, mask, True, bag)
        p = 1 / (1 + np.exp(-z))
        total = max(w.sum(), 1.0)
        loss = float((-(y * np.log(p + 1e-7) + (1 - y) * np.log(1 - p + 1e-7)) * w).sum() / total)
        dz = ((p - y) * w / total).astype(np.float32)
        g = {"o": np.tensordot(dz, feats, ([0, 1], [0, 1])), "ob": np.array([dz.sum()], np.float32)}
        df = dz[:, :, None] * self.p["o"]
        dx = df[:, :, 2 * HIDDEN :].copy()
        for k, kept, dh_out in (("f", kf, df[:, :, :HIDDEN]), ("b", kb, df[:, :, HIDDEN : 2 * HIDDEN])):
            wx, wh = self.p[f"w{k}"][:WIDTH], self.p[f"w{k}"][WIDTH:]
            gw, gb = np.zeros_like(self.p[f"w{k}"]), np.zeros_like(self.p[f"b{k}"])
            b = x.shape[1]
            dh, dc = np.zeros((b, HIDDEN), np.float32), np.zeros((b, HIDDEN), np.float32)
            for i, h, c, ig, fg, og, a, tc, m in reversed(kept):
                dh = dh + dh_out[i]
                dhn, dh_keep = dh * m, dh * (1 - m)
                dcn = dc * m + dhn * og * (1 - tc * tc)
                dc_keep = dc * (1 - m)
                dzz = np.concatenate([dcn * a * ig * (1 - ig), dcn * c * fg * (1 - fg), dhn * tc * og * (1 - og), dcn * ig * (1 - a * a)], axis=1)
                gw[:WIDTH] += x[i].T @ dzz
                gw[WIDTH:] += h.T @ dzz
                gb += dzz.sum(0)
                dx[i] += dzz @ wx.T
                dh, dc = dzz @ wh.T + dh_keep, dcn * fg + dc_keep
            g[f"w{k}"], g[f"b{k}"] = gw, gb
        dpre = dx * (1 - x * x)
        g["d"] = np.tensordot(dense, dpre, ([0, 1], [0, 1]))
        ge = np.zeros_like(self.p["e"])
        flat = dpre.reshape(-1, WIDTH)
        for s in range(SLOTS):
            np.add.at(ge[s], ids[..., s].reshape(-1), flat)
        ge[:, 0] = 0
        g["e"] = ge
        g["a"] = np.zeros_like(self.p["a"])
        if bag is not None and len(bag[0]):
            words, rows, counts = bag
            each = np.repeat(flat[rows] / np.sqrt(counts)[:, None], counts, axis=0)
            for k in range(WIDTH):
                g["a"][:, k] = np.bincount(words, each[:, k], BUCKETS)
            g["a"][0] = 0
        return loss, g

    def fit(self, pages: list[Page], labels: list[tuple[np.ndarray, np.ndarray]], steps: int = FIT_STEPS, rate: float = 0.01, seed: int = 3) -> "BiLSTM":
        """A fixed number of steps, whatever the number of pages."""
        r = np.random.RandomState(seed)
        m, v = {k: np.zeros_like(x) for k, x in self.p.items()}, {k: np.zeros_like(x) for k, x in self.p.items()}
        for t in range(1, steps + 1):
            pick = r.randint(0, len(pages), FIT_BATCH)
            ids, dense, mask, (words, rows, counts) = batch([pages[i] for i in pick])
            y, w = np.zeros(mask.shape, np.float32), np.zeros(mask.shape, np.float32)
            for j, i in enumerate(pick):
                n = len(pages[i].lines)
                y[:n, j], w[:n, j] = labels[i]
            # words are left out at random, so that shapes and context carry weight as well
            ids = ids * (r.rand(*ids.shape) > 0.15)
            words = words * (r.rand(len(words)) > 0.15)
            hide = r.rand(FIT_BATCH) < 0.25
            dense[:, hide, 23:26] = 0.0
            _, g = self.gradients(ids, dense, mask, y, w, (words, rows, counts))
            lr = rate * min(1.0, 2 * (1 - t / (steps + 1)) + 0.02)
            for k in self.p:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v[k] = 0.99 * v[k] + 0.01 * g[k] ** 2
                self.p[k] -= (lr * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.99**t)) + 1e-7)).astype(np.float32)
        return self

    def label(self, pages: list[Page]) -> list[np.ndarray]:
        """Probability of body of every block, in batches of similar length."""
        out: list = [np.zeros(0)] * len(pages)
        order = sorted((i for i in range(len(pages)) if pages[i].lines), key=lambda i: len(pages[i].lines))
        for a in range(0, len(order), 256):
            part = order[a : a + 256]
            ids, dense, mask, bag = batch([pages[i] for i in part])
            z, _ = self.forward(ids, dense, mask, bag=bag)
            p = 1 / (1 + np.exp(-z))
            for j, i in enumerate(part):
                out[i] = p[: len(pages[i].lines), j]
        return out


def batch(pages: list[Page]) -> tuple[np.ndarray, np.ndarray, np.ndarray, Bag]:
    t, b = max(len(p.lines) for p in pages), len(pages)
    ids, dense, mask = np.zeros((t, b, SLOTS), np.int64), np.zeros((t, b, DENSE), np.float32), np.zeros((t, b), np.float32)
    for j, p in enumerate(pages):
        n = len(p.lines)
        ids[:n, j], dense[:n, j], mask[:n, j] = p.ids, p.dense, 1.0
    rows, counts = np.concatenate([np.arange(len(p.lines)) * b + j for j, p in enumerate(pages)]), np.concatenate([p.counts for p in pages])
    return ids, dense, mask, (np.concatenate([p.words for p in pages]), rows[counts > 0], counts[counts > 0])


def chunks(batches: Iterator[pd.DataFrame], rows: int = 512) -> Iterator[pd.DataFrame]:
    """Arrow batches in parts of so many pages, which bounds what a worker holds.

    A part is hundreds of thousands of small lists without cycles, which the collector of cycles would walk again and again.
    """
    gc.set_threshold(500_000)
    for pdf in batches:
        for a in range(0, len(pdf), rows):
            yield pdf.iloc[a : a + rows]


def sides_of(pdf: pd.DataFrame) -> list[tuple[int, str, Page]]:
    """(row, side, page) of the sides with text."""
    out = []
    for i, (su, st, tu, tt, standing) in enumerate(zip(pdf["src_url"], pdf["src_content"], pdf["tgt_url"], pdf["tgt_content"], pdf["standing"])):
        keep = set(standing) if standing is not None else set()
        words = address_words(su, tu)
        for side, text in (("src", st), ("tgt", tt)):
            if isinstance(text, str) and text.strip():
                out.append((i, side, Page(text, words, keep)))
    return out


def fit_labeller(sample: pd.DataFrame) -> BiLSTM:
    """The network of a bounded sample of pages with rule labels."""
    pages = [p for _, _, p in sides_of(sample) if p.lines]
    seen: dict[str, set[str]] = defaultdict(set)
    sites = [str(s) for s in sample["site"]]
    for i, _, p in sides_of(sample):
        for line in p.lines:
            seen[letters(line)].add(sites[i])
    often = {k for k, v in seen.items() if len(v) >= 4 and k}
    net = BiLSTM()
    return net.fit(pages, [rule_labels(p, often) for p in pages]) if pages else net


COLUMNS = ["src_url", "src_content", "tgt_url", "tgt_content"]


class Standing:
    """The standing lines of all sites, and how pages get those of their site."""

    def __init__(self, pages: DataFrame) -> None:
        self.table = cut(site_standing(pages))
        self.keys, self.pages = self.table.agg(F.coalesce(F.sum(F.size("standing")), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()

    def of(self, pages: DataFrame, id_col: str = "crawl_id") -> DataFrame:
        """(crawl_id, urls, contents, site, standing) of every page. The texts stay where they are if the counted keys are few; else only those of small sites are shuffled."""
        rows = pages.select(F.col(id_col).alias("crawl_id"), *COLUMNS, site_of(F.coalesce("src_url", "tgt_url")).alias("site")).where("crawl_id IS NOT NULL")
        lines = self.table.select("site", "standing")
        if self.keys <= SMALL_KEYS:
            return rows.join(F.broadcast(lines), "site", "left")
        hot = F.broadcast(lines.join(self.table.where(F.col("n") >= hot_limit(self.pages)).select("site"), "site"))
        cold = rows.where("site IS NOT NULL").join(hot.select("site"), "site", "left_anti").join(lines, "site", "left")
        none = rows.where("site IS NULL").withColumn("standing", F.lit(None).cast("array<long>"))
        return rows.join(hot, "site").unionByName(cold).unionByName(none)


def fit_sample(pages: DataFrame, standing: Standing, id_col: str = "crawl_id") -> pd.DataFrame:
    """The bounded sample of the fits, in the order of the ids."""
    return standing.of(hash_sample(pages, id_col, FIT_PAGES), id_col).toPandas().sort_values("crawl_id", kind="stable", ignore_index=True)


def label_pages(pages: DataFrame, id_col: str = "crawl_id") -> DataFrame:
    """(crawl_id, side, line_no) of every body line."""
    standing = Standing(pages)
    net = pages.sparkSession.sparkContext.broadcast(fit_labeller(fit_sample(pages, standing, id_col)))

    def label(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in chunks(batches):
            sides = sides_of(pdf)
            ids = pdf["crawl_id"].tolist()
            out = [(ids[i], side, p.numbers[k]) for (i, side, p), probs in zip(sides, net.value.label([p for _, _, p in sides])) for k in np.nonzero(probs >= 0.5)[0].tolist()]
            yield pd.DataFrame({"crawl_id": pd.Series([x[0] for x in out], dtype="int64"), "side": pd.Series([x[1] for x in out], dtype="object"), "line_no": pd.Series([x[2] for x in out], dtype="int32")})

    return standing.of(pages, id_col).mapInPandas(label, "crawl_id long, side string, line_no int")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_pages(spread(table(spark, sf_dir, "general_crawler").select("crawl_id", *COLUMNS), "crawl_id"))


def p2_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(crawl_id, side, body): the body lines of each side that has some, in their order."""
    pages = table(spark, sf_dir, "general_crawler")
    kept = label_pages(pages).groupBy("crawl_id", "side").agg(F.collect_list("line_no").alias("kept"))
    texts = pages.select("crawl_id", F.explode(F.create_map(F.lit("src"), "src_content", F.lit("tgt"), "tgt_content")).alias("side", "text"))
    return texts.join(kept, ["crawl_id", "side"]).select("crawl_id", "side", F.array_join(F.filter(F.split("text", "\n"), lambda _, i: F.array_contains("kept", i)), "\n").alias("body"))


QUERIES = {"p2_found": p2_found, "p2_bodies": p2_bodies}
SQL: dict[str, str] = {}
