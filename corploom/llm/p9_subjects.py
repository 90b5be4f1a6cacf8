"""Problem 9: subject areas of each document.

Weighted subject terms are curated from labelled examples: word n-grams whose examples keep to few domains (and the terms of
the domain table's glosses), weighted by the lift of each domain times the term's rarity among the texts; longer terms replace
the shorter ones inside them. They are fitted twice: the first fit of all examples labels every different document that is
about one domain, the second counts the terms of all examples and all of these documents, as partial sums of each task. A term
must be in a share of the texts, so that the share bounds the terms. All terms of both languages go into one multi-pattern
automaton, which is sent to the tasks. Of each document, every sentence gets the domain with the highest sum of weights,
if it is at least a threshold calibrated on the sentences of all these texts; terms that several domains share are decided by the document's
other terms. The score of a domain is normalized by length (the number of sentences), and every domain with at least a
quarter of the sentences is assigned.

Null and blank texts, rows with a null id, and texts mainly in another language than English and French (by script and
function words; a language that the lists don't know has too few of them) have no rows. Repeated documents get rows each. An empty table gives an empty result.
The sentences are stored once, as the fits and the result read them.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from corploom.llm.p3_sentences import token_before
from corploom.operators.skew import hot_key_join
from corploom.session import cut, spread, table

LEAST_SHARE = 0.25
#: A term needs so many labelled examples, or so many examples and self-labelled texts together, and this share of them.
MIN_EXAMPLES, MIN_TEXTS, MIN_SHARE = 2, 5, 0.001
#: Scores are told apart to this part of one in the calibration.
SCORE_STEPS = 1_000
#: So many rows that are copies may be broadcast, and so many counts a task holds before it passes them on.
SMALL_COPIES, HELD_COUNTS = 2_000_000, 1_000_000
MAX_WORDS, MIN_PURITY = 5, 0.45
#: Of a text mainly in English or French, so many words are function words of one of them.
LEAST_FUNCTION = 0.15
# Function words by language (elided ones without their apostrophe), and abbreviations that don't end a sentence.
FUNCTION_WORDS = {
    "en": "the of and to in a is that it was for on with as by at this from are be have has will would could not than which said more but who when after".split(),
    "fr": "le la les des du de et à un une est que qui dans pour sur avec par au aux ce cette se en a ont l d n s qu plus pas sont mais ne son".split(),
    "de": "der die das und den dem des ein eine einer ist nicht mit von zu im auf für sich hat wird auch als an bei nach aus am wer".split(),
    "es": "el la los las de y en un una que por con para se del al es no más su lo como sin quién según ha dijo".split(),
    "it": "il lo la i gli le di e un una che è in per con del della dei delle nel nella al alla da dal si non ha sono come più anche l d c".split(),
    "pt": "o a os as de e um uma que em por com para se do da dos das no na nos nas ao é não mais como foi ser são pelo pela".split(),
    "nl": "de het een en van in is dat op te zijn met voor niet aan er om ook als bij door naar uit maar nog over was wordt werd heeft".split(),
    "sv": "och att det som en på är av för med den till i har de inte om ett men var jag sig från vi så kan när år under också efter".split(),
}
ABBREVIATIONS = "dr mr mrs ms prof st no nos art fig vol vs approx inc ltd corp co jr sr dept e.g i.e etc cf m mm mme mmes mlle me dre pr p ex env al a.m p.m u.s jan feb mar apr jun jul aug sep sept oct nov dec".split()
# patterns that begin with a set are searched much faster
_BREAK = re.compile(r"[.!?…\n](?:(?<!\n)[.!?…]*[\"'”’»)\]]*(?=\s|$)|(?<=\n)\s*\n)")
_OTHER = re.compile(r"[^\W\d_a-zà-öø-ÿœ][^\W\d_a-zà-öø-ÿœ]*")
#: White space but for the blank and the line end, and runs of it that aren't one blank.
_BLANKS = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]
_BLANK_RUNS = re.compile(r"[^\S\n ][^\S\n]*| [^\S\n]+")
_LETTER = re.compile(r"[^\W\d_]")
_WORD = re.compile(r"[^\W\d_]+")
_HIDDEN = re.compile("[\u00ad\u200b-\u200f\u2060\ufeff]")
_MARKS = re.compile(r"[,;:.!?]")
_COMPOUND = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)*")
_PIECES = re.compile(f"({_COMPOUND.pattern})")
_BOUND = re.compile(r"[,;:.!?\n]")


def flat(text: str) -> str:
    """Lower case, plain apostrophes and blanks; line ends stay."""
    if not text.isascii():
        text = _HIDDEN.sub("", unicodedata.normalize("NFC", text))
    text = text.lower().replace("’", "'").replace("\r\n", "\n").replace("\r", "\n")
    return _BLANK_RUNS.sub(" ", text) if "  " in text or any(c in text for c in _BLANKS) else text


def sentences(text: str) -> list[str]:
    """Rough sentences of English or French text: enough to measure shares."""
    out, start = [], 0
    for m in _BREAK.finditer(text):
        if text[m.start()] != "\n" and m.group()[0] == "." and m.end() < len(text):
            word = token_before(text[max(start, m.start() - 24) : m.start()]).lstrip("(\"'«[")
            if word in ABBREVIATIONS or (len(word) == 1 and word.isalpha()) or re.fullmatch(r"[a-z]\.-?[a-z]", word):
                continue
        out.append(text[start : m.end()])
        start = m.end()
    out.append(text[start:])
    return [" ".join(s.split()) if "\n" in s or "  " in s else s.strip() for s in out if _LETTER.search(s)]


def is_en_fr(text: str) -> bool:
    """Whether a text (flat) is mainly English or French: by the script, and by the function words among its words, which must be as many as those of another language."""
    words = _WORD.findall(text)
    if not text.isascii() and 2 * sum(map(len, _OTHER.findall(text))) > sum(map(len, words)):
        return False
    count = dict.fromkeys(_FUNCTION, 0)
    for w, n in Counter(filter(_LANGUAGES.__contains__, words)).items():
        for lang in _LANGUAGES[w]:
            count[lang] += n
    most = max(count["en"], count["fr"])
    return most >= LEAST_FUNCTION * len(words) and most > 0 and most >= max(count.values())


_FUNCTION = {k: set(v) for k, v in FUNCTION_WORDS.items()}
_LANGUAGES = {w: [lang for lang, ws in _FUNCTION.items() if w in ws] for w in set().union(*_FUNCTION.values())}
_STOP = _FUNCTION["en"] | _FUNCTION["fr"]


def ngrams(sentence: str) -> set[str]:
    """Word n-grams that neither begin nor end with a function word, and hold no mark."""
    out = set()
    for part in _MARKS.split(sentence):
        words = [(m.start(), m.end(), m.group() in _STOP) for m in _COMPOUND.finditer(part)]
        for i, (a, _, stop) in enumerate(words):
            if not stop:
                out.update(part[a:b] for _, b, stop in words[i : i + MAX_WORDS] if not stop)
    return out


#: What a word may be to an n-gram.
STOP, FREQUENT, KNOWN = 1, 2, 3


def word_kinds(frequent: set[str], known: set[str]) -> dict[str, int]:
    """Function words, frequent words, and ``known`` words that are neither."""
    return dict.fromkeys(known, KNOWN) | dict.fromkeys(frequent, FREQUENT) | dict.fromkeys(_STOP, STOP)


def pieces_of(ss: list[str]) -> tuple[list[str], list[str | None]]:
    """The words of all sentences, and what is before each word; None where an n-gram can't go on from the word before."""
    pieces = _PIECES.split("\n".join(ss))
    return pieces[1::2], [None if x != " " and _BOUND.search(x) else x for x in pieces[:-1:2]]


def links(ss: list[str], kinds: dict[str, int]) -> set[str]:
    """The frequent words, and the n-grams of two frequent words with nothing but function words between them."""
    words, before = pieces_of(ss)
    are, n = list(map(kinds.get, words)), len(words)
    out = set()
    for i, kind in enumerate(are):
        if kind == FREQUENT:
            g = words[i]
            out.add(g)
            for j in range(i + 1, min(i + MAX_WORDS, n)):
                kind = are[j]
                if before[j] is None or kind is None or kind == KNOWN:
                    break
                g += before[j] + words[j]
                if kind == FREQUENT:
                    out.add(g)
                    break
    return out


def prefixes(terms: frozenset[str] | set[str]) -> set[str]:
    """The terms, and what they begin with up to the end of a word."""
    return {t[: m.end()] for t in terms for m in _COMPOUND.finditer(t)}


def longer_ngrams(ss: list[str], kinds: dict[str, int], wanted: frozenset[str] | set[str], begins: set[str], frequent_links: set[str]) -> set[str]:
    """The n-grams that ``links`` leaves: those of more than one link, all of them frequent, and the ``wanted`` ones; ``begins`` are their prefixes."""
    words, before = pieces_of(ss)
    are, n = list(map(kinds.get, words)), len(words)
    out = set()
    for i, kind in enumerate(are):
        if kind is None or kind == STOP:
            continue
        g, link = words[i], ""
        whole = kind == FREQUENT
        linked, many = whole, False
        if not whole and g in wanted:
            out.add(g)
        for j in range(i + 1, min(i + MAX_WORDS, n)):
            kind = are[j]
            if before[j] is None or kind is None:
                break
            more = before[j] + words[j]
            g += more
            if many and linked:
                link += more
            if kind != STOP:
                whole = whole and kind == FREQUENT
                linked = linked and whole and (link if many else g) in frequent_links
                if (many or not whole) and (linked or g in wanted):
                    out.add(g)
                if not linked and g not in begins:
                    break
                link, many = words[j], True
    return out


def text_key(flat_text: str) -> str:
    return " ".join(flat_text.split())


#: Of a term: its texts, those among them that are labelled examples, and its texts by domain.
Counted = tuple[int, int, dict[str, int]]


def supports(examples: int, texts: int) -> tuple[float, float]:
    """Examples, and examples and other texts, that a term needs."""
    return max(MIN_EXAMPLES, MIN_SHARE * examples), max(MIN_TEXTS, MIN_SHARE * texts)


class Subjects:
    """Term weights by domain, their automaton, and the sentence threshold."""

    def __init__(self, examples: list[tuple[str, str]], glosses: list[tuple[str, str]] = (), more: list[tuple[str, str]] = ()) -> None:
        """Of texts in memory; ``more`` are texts that an earlier fit labelled."""
        examples = [(d, flat(t)) for d, t in examples if d and t]
        labelled = len(examples)
        texts = [(d, sentences(t)) for d, t in [*examples, *((d, flat(t)) for d, t in more)]]
        df, by, sure = Counter(), defaultdict(Counter), Counter()
        for i, (d, ss) in enumerate(texts):
            for g in set().union(*map(ngrams, ss)):
                df[g] += 1
                by[g][d] += 1
                sure[g] += i < labelled
        self.weigh(Counter(d for d, _ in texts), labelled, {g: (c, sure[g], by[g]) for g, c in df.items()}, glosses)
        bins: dict[int, tuple[int, int, float]] = {}
        for d, ss in texts:
            for top, i in self.judged(ss):
                k = math.floor(top * SCORE_STEPS)
                n, right, least = bins.get(k, (0, 0, top))
                bins[k] = n + 1, right + (i == self.index[d]), min(least, top)
        self.calibrate(list(bins.values()), sum(len(ss) for _, ss in texts))

    @classmethod
    def of(cls, size: dict[str, int], labelled: int, counted: dict[str, Counted], glosses: list[tuple[str, str]]) -> Subjects:
        """Of counted terms, yet to be calibrated."""
        out = cls.__new__(cls)
        out.weigh(size, labelled, counted, glosses)
        return out

    def weigh(self, size: dict[str, int], labelled: int, counted: dict[str, Counted], glosses: list[tuple[str, str]]) -> None:
        """Weights of the terms; ``size`` is the number of texts by domain, ``labelled`` that of the examples among them."""
        self.domains = sorted(size)
        self.index = {d: i for i, d in enumerate(self.domains)}
        n, k = sum(size.values()), len(self.domains)
        few, many = supports(labelled, n)
        self.weights: dict[str, list[float]] = {}
        for g, (c, sure, by) in sorted(counted.items()):
            least = few if sure >= few else many
            if c < least or len(g) < 3 or c == least and len(by) > 1:
                continue
            rate = {d: x / size[d] for d, x in by.items()}
            whole = sum(rate.values())
            # an ambiguous term keeps to few domains, each with a share of it; anything broader is no subject term
            top = sorted(rate.items(), key=lambda x: (-x[1], x[0]))
            kept = [(d, r / whole) for d, r in top if r / whole >= 0.15 and by[d] >= 2]
            if not kept or sum(p for _, p in kept) < 0.9 or kept[0][1] < MIN_PURITY and len(kept) < 2:
                continue
            rarity = math.log(1 + n / c)
            w = [0.0] * k
            for d, p in kept:
                w[self.index[d]] = rarity * max(0.0, math.log(p * k)) / math.log(max(k, 2))
            self.weights[g] = w
        # terms of the domain table's glosses that the texts lack or are too few to judge
        for g, ds in gloss_terms(glosses).items():
            ds = ds.intersection(self.index)
            if ds and g not in self.weights:
                w = [0.0] * k
                for d in ds:
                    w[self.index[d]] = math.log(1 + n / max(counted[g][0] if g in counted else 0, 1)) * max(0.0, math.log(k / len(ds))) / math.log(max(k, 2))
                self.weights[g] = w
        self.threshold = 0.0
        self.automaton = None
        self.build()

    def build(self) -> None:
        import ahocorasick

        a = ahocorasick.Automaton()
        for g, w in self.weights.items():
            a.add_word(g, (len(g), [(i, x) for i, x in enumerate(w) if x > 0]))
        if len(a):
            a.make_automaton()
            self.automaton = a

    def __getstate__(self) -> dict:
        return self.__dict__ | {"automaton": None}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self.build()

    def scores(self, ss: list[str]) -> list[dict[int, float]]:
        """Of each sentence that has some, the sums of the domains' weights over the longest terms, left to right, at word boundaries."""
        if self.automaton is None:
            return []
        # all sentences at once: no term holds a line end
        text, found = "\n".join(ss), []
        last = len(text) - 1
        for end, (size, w) in self.automaton.iter(text):
            if end == last or not text[end + 1].isalnum():
                a = end - size + 1
                if a == 0 or not text[a - 1].isalnum():
                    found.append((a, -end, w))
        found.sort()
        out, total, at, until = [], {}, -1, -1
        for a, end, w in found:
            if a > at:
                at = -end
                if a >= until:
                    total = {}
                    out.append(total)
                    until = text.find("\n", a)
                    until = until if until >= 0 else last + 1
                for i, x in w:
                    total[i] = total.get(i, 0.0) + x
        return [x for x in out if x]

    def calibrate(self, bins: list[tuple[int, int, float]], whole: int) -> None:
        """The sentence threshold with the best F1. ``bins``: of all sentences with like scores their number, of the right ones theirs, and the lowest score; ``whole`` counts those without a score as well."""
        best, right, n = 0.0, 0, 0
        for count, ok, x in sorted(bins, key=lambda y: -y[2]):
            n += count
            right += ok
            f = 2 * right / (n + whole)
            if x > 0 and f >= best:
                best, self.threshold = f, x

    def judged(self, ss: list[str]) -> list[tuple[float, int]]:
        """Of each sentence with a score the highest one, and its domain, which the text's other terms decide if several are near."""
        scores = self.scores(ss)
        whole: dict[int, float] = defaultdict(float)
        for x in scores:
            for i, v in x.items():
                whole[i] += v
        out = []
        for x in scores:
            top = max(x.values())
            out.append((top, next(iter(x)) if len(x) == 1 else max((i for i, v in x.items() if v >= 0.6 * top), key=lambda i: (whole[i], x[i], -i))))
        return out

    def about(self, ss: list[str]) -> Counter:
        """Number of sentences about each domain."""
        return Counter(i for top, i in self.judged(ss) if top >= self.threshold - 1e-9)

    def label(self, ss: list[str]) -> str | None:
        """The domain of a text that is about one."""
        about = self.about(ss) if len(ss) >= 4 else ()
        return self.domains[next(iter(about))] if len(about) == 1 and sum(about.values()) >= 0.7 * len(ss) else None

    def subjects(self, text: str) -> list[str]:
        t = flat(text)
        if not is_en_fr(t):
            return []
        ss = sentences(t)
        return [self.domains[i] for i, k in sorted(self.about(ss).items()) if k >= LEAST_SHARE * len(ss)]


def gloss_terms(glosses: list[tuple[str, str]]) -> dict[str, set[str]]:
    listed: dict[str, set[str]] = defaultdict(set)
    for d, gloss in glosses:
        for g in flat(gloss).split(","):
            if g.strip():
                listed[g.strip()].add(d)
    return listed


def fit(examples: list[tuple[str, str]], glosses: list[tuple[str, str]], texts: list[str]) -> Subjects:
    """What ``fit_subjects`` does, in memory: a model of the examples; then, whatever their number, of the examples and those distinct texts that the first model finds to be about one domain."""
    first = Subjects(examples, glosses)
    more, seen = [], {text_key(flat(t)) for d, t in examples if d and t}
    for t in texts:
        f = flat(t or "")
        key = text_key(f)
        if key not in seen and is_en_fr(f):
            seen.add(key)
            d = first.label(sentences(f))
            if d is not None:
                more.append((d, t))
    return Subjects(examples, glosses, more)


def stored(rows: DataFrame, first: Subjects | None = None) -> DataFrame:
    """(id, domain, digest, n, sentences, row) of the rows (id, domain, text), sentences between line ends. With a first model only texts in English or French, with its label as their domain."""
    model = rows.sparkSession.sparkContext.broadcast(first)

    def prepare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = model.value
        for pdf in batches:
            out = []
            for i, d, t in zip(pdf["id"].tolist(), pdf["domain"], pdf["text"]):
                f = flat(t)
                if m is None or is_en_fr(f):
                    ss = sentences(f)
                    out.append((i, d if m is None else m.label(ss), xxhash.xxh3_128_digest(text_key(f).encode("utf-8", "surrogatepass")), len(ss), "\n".join(ss)))
            yield pd.DataFrame(out, columns=["id", "domain", "digest", "n", "sentences"])

    return cut(rows.mapInPandas(prepare, "id long, domain string, digest binary, n int, sentences string")).withColumn("row", F.monotonically_increasing_id())


def lines(text: str) -> list[str]:
    return text.split("\n") if text else []


def mark_copies(docs: DataFrame, examples: DataFrame) -> DataFrame:
    """The stored documents with ``copy``: whether the text is in an example or in a row of a lower id. Only digests are shuffled, unless the copies are very many."""
    own = docs.select("digest", F.struct(F.lit(1).alias("kind"), "id", "row").alias("place"))
    keys = own.unionByName(examples.select("digest", F.struct(F.lit(0).alias("kind"), "id", "row").alias("place")))
    groups = keys.groupBy("digest").agg(F.count(F.lit(1)).alias("rows"), F.min("place").alias("first")).where("rows > 1")
    copies = cut(hot_key_join(own, groups, ["digest"], "rows", keys.count()).where("place <> first").select("place.row", F.lit(True).alias("copy")))
    return docs.join(F.broadcast(copies) if copies.count() <= SMALL_COPIES else copies, "row", "left").withColumn("copy", F.coalesce("copy", F.lit(False)))


def partial_counts(rows: DataFrame, items: Callable[[list[str]], set[str]]) -> DataFrame:
    """(gram, domain, n): texts that hold an item by domain, and those of each domain (no item), as partial sums. Rows without a domain don't count."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: dict[str, Counter] = defaultdict(Counter)

        def summed() -> pd.DataFrame:
            columns = [g for c in counts.values() for g in c], [d for d, c in counts.items() for _ in c], [n for c in counts.values() for n in c.values()]
            counts.clear()
            return pd.DataFrame({k: pd.Series(x, dtype=object if k != "n" else "int64") for k, x in zip(("gram", "domain", "n"), columns)})

        for pdf in batches:
            for d, t in zip(pdf["domain"], pdf["sentences"]):
                counts[d].update(items(lines(t)))
                counts[d][None] += 1
                if len(counts[d]) > HELD_COUNTS // 8 and sum(map(len, counts.values())) > HELD_COUNTS:
                    yield summed()
        yield summed()

    return rows.where("domain IS NOT NULL").select("domain", "sentences").mapInPandas(count, "gram string, domain string, n long")


def counted_terms(examples: DataFrame, more: DataFrame | None, glosses: list[tuple[str, str]], wanted: frozenset[str] = frozenset()) -> tuple[Subjects, frozenset[str]]:
    """A model, yet to be calibrated, of all examples and all rows of ``more`` that have a label; and the examples' terms, which are ``wanted`` of ``more``.

    Only words that are in enough texts are looked for longer terms: those of a rarer word are as rare.
    """

    def parts(items: Callable[[list[str]], set[str]]) -> DataFrame:
        own = partial_counts(examples, items).withColumn("sure", F.col("n"))
        return own if more is None else own.unionByName(partial_counts(more, items).withColumn("sure", F.lit(0).cast("long")))

    words = cut(parts(lambda ss: set(_COMPOUND.findall("\n".join(ss)))).groupBy("gram", F.when(F.col("gram").isNull(), F.col("domain")).alias("domain")).agg(F.sum("n").alias("n"), F.sum("sure").alias("sure")))
    sizes = words.where("gram IS NULL").collect()
    size, labelled = {r["domain"]: r["n"] for r in sizes}, sum(r["sure"] for r in sizes)
    few, many = supports(labelled, sum(size.values()))
    least = few if more is None else many
    # the share bounds words and terms: a text holds only so many
    frequent = {r[0] for r in words.where("gram IS NOT NULL").where(F.col("n") >= least).select("gram").collect()}
    listed = sorted(gloss_terms(glosses))
    sought = wanted.union(listed)
    known = frequent.union(*map(_COMPOUND.findall, sought))
    kinds = examples.sparkSession.sparkContext.broadcast(word_kinds(frequent, known))

    def enough(items: Callable[[list[str]], set[str]]) -> list:
        # both groupings by the one shuffle
        by = parts(items).where("gram IS NOT NULL").repartition("gram").groupBy("gram", "domain").agg(F.sum("n").alias("n"), F.sum("sure").alias("sure"))
        terms = by.groupBy("gram").agg(F.sum("n").alias("n"), F.sum("sure").alias("sure"), F.collect_list(F.struct("domain", "n")).alias("by"))
        return terms.where((F.col("n") >= least) | (F.col("sure") >= few) | F.col("gram").isin(listed)).collect()

    # an n-gram is as rare as the rarest link in it, so only frequent links are looked for longer ones
    rows = enough(lambda ss: links(ss, kinds.value))
    models = examples.sparkSession.sparkContext.broadcast((sought, prefixes(sought), {r["gram"] for r in rows if r["n"] >= least}))
    rows += enough(lambda ss: longer_ngrams(ss, kinds.value, *models.value))
    counted = {r["gram"]: (r["n"], r["sure"], {x["domain"]: x["n"] for x in r["by"]}) for r in rows}
    return Subjects.of(size, labelled, counted, glosses), frozenset(g for g, (_, sure, _) in counted.items() if sure >= few)


def judge(rows: DataFrame, model: Subjects) -> DataFrame:
    """(id, n, tops, chosen, right): the sentences' scores and domains; ``right``, of a text with a label that is no copy, whether the domain is the label."""
    models = rows.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = models.value
        for pdf in batches:
            out = []
            for i, d, n, t, copy in zip(pdf["id"].tolist(), pdf["domain"], pdf["n"].tolist(), pdf["sentences"], pdf["copy"].tolist()):
                found = m.judged(lines(t))
                out.append((i, n, [x for x, _ in found], [x for _, x in found], None if d is None or copy else [x == m.index[d] for _, x in found]))
            yield pd.DataFrame(out, columns=["id", "n", "tops", "chosen", "right"])

    return rows.select("id", "domain", "n", "sentences", "copy").mapInPandas(score, "id long, n int, tops array<double>, chosen array<int>, right array<boolean>")


def calibrated(model: Subjects, *judged: DataFrame) -> Subjects:
    """The model with its threshold, of all sentences of texts with a label."""
    bins: dict[int, tuple[int, int, float]] = {}
    whole = 0
    for rows in judged:
        rows = rows.where("right IS NOT NULL")
        one = rows.select(F.explode(F.arrays_zip("tops", "right")).alias("x")).select(F.floor(F.col("x.tops") * SCORE_STEPS).alias("k"), F.col("x.tops").alias("top"), F.col("x.right").cast("int").alias("right"))
        for r in one.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.sum("right").alias("right"), F.min("top").alias("top")).collect():
            n, right, least = bins.get(r["k"], (0, 0, r["top"]))
            bins[r["k"]] = n + r["n"], right + r["right"], min(least, r["top"])
        whole += rows.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    model.calibrate(list(bins.values()), whole)
    return model


def fit_subjects(docs: DataFrame, examples: DataFrame, glosses: list[tuple[str, str]]) -> tuple[Subjects, DataFrame]:
    """The model of all examples and documents (id, domain, text), and the judged documents."""
    examples = stored(examples).withColumn("copy", F.lit(False))
    first, wanted = counted_terms(examples, None, glosses)
    first = calibrated(first, judge(examples, first))
    docs = mark_copies(stored(docs, first), examples)
    model, _ = counted_terms(examples, docs.where("NOT copy"), glosses, wanted)
    judged = cut(judge(docs, model))
    return calibrated(model, judge(examples, model), judged), judged


def label_subjects(docs: DataFrame, examples: DataFrame, domains: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, domain): every domain of every document."""
    labelled = examples.select(F.col("example_id").cast("long").alias("id"), "domain", "text").where("id IS NOT NULL AND domain <> '' AND text <> ''")
    # the table of domains, whose terms all go into the automaton
    glosses = [] if domains is None else [(r[0], r[1]) for r in sorted(domains.select("domain", "ycc_gloss").where("domain IS NOT NULL AND ycc_gloss IS NOT NULL").distinct().collect())]
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.lit(None).cast("string").alias("domain"), F.col(text_col).alias("text")).where("id IS NOT NULL AND text <> ''")
    model, judged = fit_subjects(rows, labelled, glosses)
    # the domains of the sentences that reach the threshold
    reach = F.transform(F.filter(F.arrays_zip("tops", "chosen"), lambda x: x["tops"] >= model.threshold - 1e-9), lambda x: x["chosen"])
    kept = judged.select(F.col("id").alias("doc_id"), "n", reach.alias("reach")).where("size(reach) > 0")
    most = F.filter(F.array_distinct("reach"), lambda d: F.size(F.filter("reach", lambda x: x == d)) >= LEAST_SHARE * F.col("n"))
    names = F.array(*map(F.lit, model.domains)) if model.domains else F.array().cast("array<string>")
    return kept.select("doc_id", F.explode(F.array_sort(most)).alias("d")).select("doc_id", F.element_at(names, F.col("d") + 1).alias("domain"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_subjects(spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id"), table(spark, sf_dir, "subject_examples"), table(spark, sf_dir, "ycc_domains"))


def p9_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(domain, docs): the corpus composition by subject."""
    return p9_found(spark, sf_dir).groupBy("domain").agg(F.count(F.lit(1)).alias("docs"))


QUERIES = {"p9_found": p9_found, "p9_composition": p9_composition}
SQL: dict[str, str] = {}
