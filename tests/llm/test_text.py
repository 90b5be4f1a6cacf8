import random
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from corploom.llm import p2_body as P2, p3_sentences as P3, p5_align as P5, p6_quality as P6, p8_leaks as P8, p9_subjects as P9


# ---- page bodies --------------------------------------------------------------------------------------------------------


def test_gradients_are_right():
    r = np.random.RandomState(0)
    net = P2.BiLSTM()
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    ids, dense, mask = r.randint(0, 50, (4, 3, P2.SLOTS)), r.randn(4, 3, P2.DENSE), np.ones((4, 3))
    mask[2:, 1] = 0
    y, w = r.randint(0, 2, (4, 3)).astype(float), mask * 0.7
    _, g = net.gradients(ids, dense, mask, y, w)
    for k in ("wf", "wb", "d", "o", "bf"):
        at = tuple(r.randint(0, s) for s in net.p[k].shape)
        old, eps = net.p[k][at], 1e-4
        net.p[k][at] = old + eps
        up, _ = net.gradients(ids, dense, mask, y, w)
        net.p[k][at] = old - eps
        down, _ = net.gradients(ids, dense, mask, y, w)
        net.p[k][at] = old
        assert g[k][at] == pytest.approx((up - down) / (2 * eps), rel=2e-2, abs=2e-5), k


def test_whole_lines_are_read():
    """Two long lines with the same ends and shape differ by the words between; their gradient is right."""
    long = "The people of the town say that {} is {} for them all, " + "and that it was so in the years before, " * 3 + "as they know."
    page = lambda a, b: P2.Page("Home\n" + long.format(a, b), set(), set())
    net = P2.BiLSTM()
    one, two = net.label([page("cookies", "consent")])[0], net.label([page("rivers", "flooded")])[0]
    assert abs(one[1] - two[1]) > 1e-6
    assert P2.shape(long.format("rivers", "flooded"))[2][7:10] == ["rivers", "is", "flooded"] and "all" in P2.shape(long)[2]
    pages, labels = [page("cookies", "consent"), page("rivers", "flooded")], [(np.zeros(2), np.ones(2)), (np.array([0.0, 1.0]), np.ones(2))]
    got = net.fit(pages, labels, steps=60).label(pages)
    assert got[0][1] < 0.2 and got[1][1] > 0.8
    net = P2.BiLSTM()
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    ids, dense, mask, bag = P2.batch(pages)
    y, w, at, eps = np.array([[0.0, 0.0], [0.0, 1.0]]), np.ones((2, 2)), (P2.word_id("rivers"), 3), 1e-4
    _, g = net.gradients(ids, dense.astype(np.float64), mask, y, w, bag)
    net.p["a"][at] += eps
    up, _ = net.gradients(ids, dense.astype(np.float64), mask, y, w, bag)
    net.p["a"][at] -= 2 * eps
    down, _ = net.gradients(ids, dense.astype(np.float64), mask, y, w, bag)
    assert g["a"][at] == pytest.approx((up - down) / (2 * eps), rel=2e-2, abs=2e-5)


def make_pages(n: int) -> pd.DataFrame:
    r = random.Random(3)
    names = [a + b + c for a in "bdfgk" for b in ("amo", "iru", "ola") for c in ("dex", "nil", "ruk")]
    out = []
    for i in range(n):
        site = i % 5
        name = r.choice(names).capitalize()
        head = f"The river bank in {name}"
        body = [f"The council of {r.choice(names).capitalize()} and {r.choice(names).capitalize()} opened the river bank of {r.choice(names).capitalize()} again after long weeks." for _ in range(r.randint(2, 5))]
        lines = ["Home", "Contact", "Log in", head, "Reading time: 5 min", *body, "Share this page", "→ Next thing in " + r.choice(names).capitalize(), "Terms of use", f"The standing notice of site {'abcde'[site]} is shown on every page of it."]
        out.append((i, f"http://s{site}.example/en/the-river-bank-in-{name.lower()}", "\n".join(lines), None, None, 3 + 0 * i, {3, *range(5, 5 + len(body))}))
    return pd.DataFrame(out, columns=["crawl_id", "src_url", "src_content", "tgt_url", "tgt_content", "clash", "truth"])


def test_page_bodies(spark):
    pdf = make_pages(120)
    schema = "crawl_id long, src_url string, src_content string, tgt_url string, tgt_content string"
    rows = [tuple(x) for x in pdf.iloc[:, :5].itertuples(index=False)] + [(900, None, None, None, None), (901, None, "", None, " \n "), (902, "http://s1.example/x", "Home\nContact\nLog in", None, None)]
    got = {}
    for r in P2.label_pages(spark.createDataFrame(rows, schema)).collect():
        assert r["side"] == "src"
        got.setdefault(r["crawl_id"], set()).add(r["line_no"])
    right = sum(len(got.get(i, set()) & t) for i, t in zip(pdf.crawl_id, pdf.truth))
    assert right / sum(map(len, got.values())) > 0.95 and right / sum(map(len, pdf.truth)) > 0.95
    assert 900 not in got and 901 not in got
    assert P2.label_pages(spark.createDataFrame(rows, schema).limit(0)).count() == 0


def test_long_notices_stand(spark):
    notice = "This site keeps small files on your machine to count its visits, " * 5 + "as the law allows."
    schema = "src_url string, src_content string, tgt_url string, tgt_content string"
    rows = [(f"http://s.example/en/{x}", f"Own line of page {x}\n{notice}", None, None) for x in ("one", "two", "three", "four")]
    assert [set(r["standing"]) for r in P2.site_standing(spark.createDataFrame(rows, schema)).collect()] == [{P2.key64(notice)}] and P2.key64(notice) is not None
    # pages of one address crawled again don't make a paragraph stand
    both = (rows[0][0], rows[0][1], "http://s.example/fr/un", rows[0][1])
    assert P2.site_standing(spark.createDataFrame([rows[0]] * 4, schema)).count() == 0
    assert P2.site_standing(spark.createDataFrame([both] * 2, schema)).count() == 0
    assert P2.Page(rows[0][1], set(), {P2.key64(notice)}).stands.tolist() == [False, True]


# ---- sentences ----------------------------------------------------------------------------------------------------------

PROSE = [
    ("The town hall reopened in March. Visitors came early. A choir sang two songs. The mayor spoke to them.\n\nProf. Green wrote to Mrs. White about No. 5 of the list. She agreed. Everyone left.", "eng"),
    ("Dr. Adams met Mr. Brown at 5 p.m. in the hall. They spoke of 3.5 million.\n\nThen it rained. Nobody cared!", "eng"), ("He left early. She stayed. \"Will it hold?\" asked the mayor. It did.", "eng"), ("A heading without a mark\nThe text begins here. It goes on.", "eng"),
    ("M. Dupont est parti. La pluie a cessé ! Qui reste ? Personne.", "fra"), ("他走了。她说：“我们在等。”雨停了！", "zhs"), ("彼は去った。「待っている。」と述べた。", "jpn"), ("وصل د. سامور اليوم. ثم غادر!", "ara"),
]


@pytest.fixture(scope="module")
def segmenter():
    """Fitted on texts of many different words, in which abbreviations stand inside lines only."""
    r = random.Random(8)
    word = lambda: "".join(r.choice("bdfgklmnprst") + r.choice("aeiou") for _ in range(r.randint(2, 4)))
    texts = []
    for _ in range(150):
        lines = []
        for _ in range(3):
            who = f"{r.choice(['Dr.', 'Mr.', 'The'])} {word().capitalize()}"
            lines.append(" ".join(f"{who} {word()} the {word()} {r.choice(['', 'of 3.5 ' + word(), 'at 5 p.m. and ' + word()])} {word()}{r.choice('..!?')}" for _ in range(r.randint(1, 3))))
        texts.append(("\n\n".join([f"The {word()} of {word()}", *lines]), "eng"))
    return P3.Segmenter().fit(PROSE * 8 + texts)


def test_units(segmenter):
    cut = lambda t, lang="eng": [t[a:b] for a, b in segmenter.units(t, lang)]
    assert cut("Dr. Adams met Mr. Brown. They spoke of 3.5 million.") == ["Dr. Adams met Mr. Brown.", "They spoke of 3.5 million."]
    assert cut('"Will it hold?" asked the mayor. It did.') == ['"Will it hold?" asked the mayor.', "It did."]
    assert cut("Intro here.\n- one item\n- other item") == ["Intro here.", "- one item", "- other item"]
    assert cut("他走了。雨停了！", "zhs") == ["他走了。", "雨停了！"]
    assert cut("「待っている。」と述べた。彼は去った。", "jpn") == ["「待っている。」と述べた。", "彼は去った。"]
    assert cut("") == [] and cut(" \n ") == []
    assert cut("Unfinished last one. And then it") == ["Unfinished last one.", "And then it"]


def test_every_character_belongs_to_one_unit(segmenter):
    r = random.Random(1)
    for _ in range(200):
        text = "".join(r.choice(["Abc", "def", ".", "!", " ", "\n", "\n\n", '"', "(", ")", "«", "»", "1", ",", "- ", "你", "。", "“", "”", "\r\n", "3.5"]) for _ in range(r.randint(0, 60)))
        at = 0
        for a, b in segmenter.units(text, None):
            assert at <= a < b and not text[at:a].strip() and not text[a].isspace() and not text[b - 1].isspace()
            at = b
        assert not text[at:].strip()


def test_wide_lines_and_gaps(segmenter):
    wide = ["word " * 30 + "end", "more " * 30 + "and", "again " * 24 + "of it.", "So it went."]  # a text wrapped at over 130 characters
    assert P3.soft_breaks(wide, 153) == [True, True, False]
    paragraphs = ["A long paragraph of the text " * 8, "The next one is here.", "And one more."]
    assert P3.soft_breaks(paragraphs, len(paragraphs[0].rstrip())) == [False, False]
    text = "They left early." + " " * 90 + "Nobody stayed in the town hall."
    assert [text[a:b] for a, b in segmenter.units(text, "eng")] == ["They left early.", "Nobody stayed in the town hall."]


def test_segment_table(spark):
    df = spark.createDataFrame([(1, "One here. Two here.", "eng", "x"), (2, None, "eng", "x"), (3, "", None, "x"), (1, "One here. Two here.", "eng", "x")], "text_id long, texts string, lang string, start_pos string")
    assert sorted(tuple(r) for r in P3.segment_texts(df).collect()) == [(1, 0, 9), (1, 0, 9), (1, 10, 19), (1, 10, 19)]
    assert P3.segment_texts(df.limit(0)).count() == 0


# ---- alignment ----------------------------------------------------------------------------------------------------------


def test_alignment_with_reordering_omission_and_merge():
    r = random.Random(2)
    noun = {"house": "maison", "river": "rivière", "bridge": "pont", "garden": "jardin", "school": "école", "market": "marché"}
    verb = {"opened": "ouvert", "closed": "fermé", "changed": "changé"}
    name = lambda: "".join(r.choice("bdgkm") + r.choice("aiou") for _ in range(3))

    def pair():
        n, v, who, k = r.choice(list(noun)), r.choice(list(verb)), name(), r.randint(10, 999)
        return f"the {n} of {who} {v} after {k} days".split(), f"la {noun[n]} de {who} a {verb[v]} après {k} jours".split()

    aligner = P5.Aligner([pair() for _ in range(400)])
    ps = [pair() for _ in range(6)]
    side = lambda ws: type("S", (), {"words": ws, "lengths": [len(" ".join(u)) for u in ws]})()
    a = side([p[0] for p in ps])
    b = side([ps[1][1], ps[0][1], ps[2][1] + ps[3][1], ps[5][1]])
    assert sorted(aligner.pairs(a, b)) == [(0, 1), (1, 0), (2, 2), (3, 2), (5, 3)]
    # pages are scored together as they are alone
    assert aligner.pairs_of([(a, b), (side([]), b), (a, b)]) == [aligner.pairs(a, b), [], aligner.pairs(a, b)]
    other = side([pair()[1] for _ in range(6)])
    assert aligner.pairs(a, other) == [] and aligner.pairs(side([]), b) == []
    beads, cost = P5.by_length([50, 20, 80], [55, 22, 85])
    assert beads == [(0, 0), (1, 1), (2, 2)] and cost < 3


def test_the_path_decides():
    """A pair too weak for the step out of order is found on the monotone path; of two alike, the one on the path."""
    aligner = P5.Aligner([])
    s = np.array([[0.9, 0.0, 0.0], [0.0, 0.5, 0.0], [0.0, 0.0, 0.9]])
    assert aligner.path(s, [10, 10, 10], [10, 10, 10]) == [(0, 0), (1, 1), (2, 2)]
    assert aligner.choose(s, s, [10] * 3, [10] * 3) == [(0, 0), (1, 1), (2, 2)]
    s[1, 1], s[0, 1] = 0.5, 0.5  # its French unit is as much like another one
    assert (1, 1) in aligner.choose(s, s, [10] * 3, [10] * 3)
    swapped = np.array([[0.0, 0.5], [0.5, 0.0]])
    assert len(aligner.choose(swapped, swapped, [10] * 2, [10] * 2)) == 1


def test_words_outside_the_fit_pages(spark, monkeypatch):
    """Translations are counted over all pages: words that the few fit pages lack are known, also where the translations are too many for a broadcast."""
    r = random.Random(5)
    word = lambda cs: "".join(r.choice(cs) + r.choice("aeiou") for _ in range(4))
    terms = [(word("bdgk"), word("lmnr")) for _ in range(400)]
    named, plain = ("The {0} of {N} and of {M} saw the {1} of {O}.", "Le {0} de {N} et de {M} a vu le {1} de {O}."), ("The {0} and the {1} will have the {2} of the {3}.", "Le {0} et le {1} ont dans le {2} de le {3}.")
    rows, truth = [], set()
    for i in range(300):
        lines = []
        for k in range(8):
            ts, names = [r.choice(terms) for _ in range(4)], {x: word("pstz").capitalize() for x in "NMO"}
            lines.append([(named, plain)[k % 2][side].format(*(t[side] for t in ts), **names) for side in (0, 1)])
        order = r.sample(range(8), 8) if i % 3 == 0 else range(8)
        src, tgt = [x for x, _ in lines], [lines[k][1] for k in order]
        rows.append((i, f"http://s{i % 5}.example/en/{i}", "\n".join(src), f"http://s{i % 5}.example/fr/{i}", "\n".join(tgt)))
        truth |= {(i, sum(len(x) + 1 for x in src[:k]), sum(len(x) + 1 for x in tgt[:j])) for j, k in enumerate(order) if k % 2}
    pages = spark.createDataFrame(rows, "crawl_id long, src_url string, src_content string, tgt_url string, tgt_content string")
    monkeypatch.setattr(P2, "FIT_PAGES", 8)
    got = {tuple(x) for x in P5.align_pages(pages).collect()}
    assert len(got & truth) > 0.95 * len(truth)
    monkeypatch.setattr(P5, "SMALL_LEXICON", -1)
    assert {tuple(x) for x in P5.align_pages(pages).collect()} == got


def test_expected_counts_against_brute_force(monkeypatch):
    h = P5.word_hash
    start = P5.Aligner.of({}, {}, {h("a"): {h("x"): (0.6, 0.5), h("y"): (0.2, 0.0)}, h("b"): {h("x"): (0.1, 0.3)}})
    pairs = [(["a", "b", "c", "c"], ["x", "y", "z"]), (["a", "d"], ["z", "w", "x"]), (["c"], ["z"]), (["b"], ["x"])] * 3
    cells, alone = {}, {}
    for es, fs in ((set(e), set(f)) for e, f in pairs):
        for key in [(e, None) for e in es] + [(None, f) for f in fs] + [(None, None)]:
            alone[key] = alone.get(key, 0) + 1
        listed = {(e, f): [max(p, P5.LEAST_PROBABLE / 4) for p in ps] for e, x in (("a", {"x": (0.6, 0.5), "y": (0.2, 0.0)}), ("b", {"x": (0.1, 0.3)})) for f, ps in x.items() if e in es and f in fs}
        ue, uf = es - {e for e, _ in listed}, fs - {f for _, f in listed}
        for e, f in [*listed, *((e, f) for e in ue for f in uf)]:
            if (e, f) in listed:
                now = listed[e, f][0] / sum(p[0] for (_, y), p in listed.items() if y == f), listed[e, f][1] / sum(p[1] for (x, _), p in listed.items() if x == e)
            else:
                now = 1 / (len(ue) + 1), 1 / (len(uf) + 1)
            cells[e, f] = [x + y for x, y in zip(cells.get((e, f), (0, 0, 0)), (*now, 1))]
    for held in (10**6, 5):  # also where the sums are made again and again
        monkeypatch.setattr(P5, "HELD_COUNTS", held)
        counts = P5.Counts(start)
        for k in range(0, 12, 4):
            counts.add([(P5.Words.of([["a"], e]), P5.Words.of([f, ["q"]])) for e, f in pairs[k : k + 4]], [[(1, 0)]] * 4)
        word = {h(w): w for w in "abcdxyzw"} | {P5.NO_HASH: None}
        got = {(word[r.e], word[r.f]): [r.forward, r.backward, r.seen] for r in counts.rows().itertuples()}
        assert {k: v[2] for k, v in got.items() if None in k} == alone
        assert {k for k in got if None not in k} == set(cells) and all(got[k] == pytest.approx(v, rel=1e-5) for k, v in cells.items())
        assert len(counts.rows()) == 0


def test_standing_lines_by_shuffle(spark, monkeypatch):
    pdf = make_pages(60)
    schema = "crawl_id long, src_url string, src_content string, tgt_url string, tgt_content string"
    pages = spark.createDataFrame([tuple(x) for x in pdf.iloc[:, :5].itertuples(index=False)] + [(900, None, "x", None, None), (901, "http://other.example", "y", None, None)], schema)
    standing = P2.Standing(pages)
    key = lambda rows: sorted((r["crawl_id"], sorted(r["standing"] or [])) for r in rows)
    small = key(standing.of(pages).collect())
    assert len(small) == 62 and sum(bool(s) for _, s in small) == 60
    monkeypatch.setattr(P2, "SMALL_KEYS", -1)
    for limit in (1, 10**9):
        monkeypatch.setattr(P2, "hot_limit", lambda n, limit=limit: limit)
        assert key(standing.of(pages).collect()) == small


def test_cut_off_lines_of_any_length():
    for end, cut in (("... read more", True), ("[…] lire la suite »", True), ("…" + " " * 40 + "»", True), ("read more", False), ("." + "»" * 30, False)):
        assert P2.shape("A long line of words that goes on " + end)[4] == cut
    assert P2.shape("This is a whole sentence of words." + "»" * 30)[3]


# ---- quality ------------------------------------------------------------------------------------------------------------


def test_exact_tails_against_brute_force(spark, monkeypatch):
    r = random.Random(5)
    rows = [(i, s, r.choice(["a", "b"]), float(r.choice([0, 0, 0, 0, 1, r.randint(0, 20)]))) for i in range(400) for s in ("items", "common_share")]
    df = spark.createDataFrame(rows, "text_id long, stat string, lang string, value double").groupBy("stat", "lang", "value").agg(F.count("*").alias("n"))
    for small, parts in ((10**6, 7), (-1, 7), (10**6, 10**6)):
        monkeypatch.setattr(P6, "SMALL_ROWS", small)
        got = {(x["stat"], x["lang"], x["value"]): (x["n"], x["tail"]) for x in P6.exact_tails(df, rows_a_partition=parts, prior=0).collect()}
        assert set(got) == {x[1:] for x in rows}
        for _, s, lang, v in rows:
            same = [x[3] for x in rows if x[1] == s and x[2] == lang]
            n = sum(x >= v for x in same) if P6.DIRECTIONS[s] else sum(x <= v for x in same)
            assert got[s, lang, v] == (same.count(v), pytest.approx(n / len(same)))
    one = P6.exact_tails(spark.createDataFrame([("items", "a", 0.5, 1), ("code", "a", 0.0, 1)], "stat string, lang string, value double, n long"), prior=50).collect()
    assert {x["stat"]: x["tail"] for x in one} == {"items": pytest.approx(1 / 51), "code": 1.0}
    assert P6.exact_tails(df.limit(0)).count() == 0


def test_the_outlier_score_decides(spark):
    """Texts with the same share of items: one outstanding otherwise, one as long and plain as all others."""
    plain = [(i, "eng", f"The {i} people of the town went to the market.\nThe day was over, and they {i} left it.") for i in range(200)]
    odd = [(900, "eng", "- x#\n- y#\nIt was the day."), (901, "eng", "- The people of the town went to the market.\nThe day was over, and they left it.\nIt was so.")]
    rows = {r["text_id"]: r for r in P6.scored(spark.createDataFrame(plain + odd, "text_id long, lang string, texts string")).collect()}
    assert set(rows) >= {900} and rows[900]["items"] < 0.7 and rows[900]["outlier"] > 6
    assert {r["text_id"]: r["kind"] for r in P6.no_prose(spark.createDataFrame(plain + odd, "text_id long, lang string, texts string")).collect()} == {900: "list"}


def test_kinds(spark):
    texts = {
        "list": "- first thing\n- second thing\n- third thing", "table": "a\t1\t2\nb\t3\t4\nc\t5\t6", "junk": "asdf" * 30, None: "A quiet sentence about the river. Another one follows it, as they do.",
    }
    rows = [(i, "eng", t, k or "") for i, (k, t) in enumerate(texts.items())] + [(10 + i, "eng", f"The {i} people of the town went to the market, and the day was over.", "") for i in range(20)] + [(90, None, None, ""), (91, "eng", " \n", ""), (92, None, "…", ""), (93, "eng", "�" * 40, "")]
    df = spark.createDataFrame(rows, "text_id long, lang string, texts string, kind string")
    assert {(r["text_id"], r["kind"]) for r in P6.no_prose(df).collect()} == {(0, "list"), (1, "table"), (2, "junk"), (93, "junk")}
    assert P6.no_prose(df.limit(0)).count() == 0
    one = spark.createDataFrame([(1, "eng", "Ab cde! f\n\ng.")], "text_id long, lang string, texts string")
    s = P6.statistics(one).first()
    assert (s["word_count"], s["mean_word_length"], s["symbol_ratio"], s["line_end_share"], s["common_share"]) == (4, pytest.approx(7 / 4), pytest.approx(2 / 9), 0.5, 1.0)


def test_copies_and_rare_languages_are_judged(spark):
    """Texts of which every tail is high: nine tenths of a language's rows, and a language's only text."""
    rows = [(i, "tha", "\ufffd" * 40) for i in range(90)] + [(100 + i, "tha", f"The {i} people of the town went to the market, and the day was over.") for i in range(10)] + [(200, "rus", "a\t1\t2\nb\t3\t4\nc\t5\t6")]
    df = spark.createDataFrame(rows, "text_id long, lang string, texts string")
    assert {(r["text_id"], r["kind"]) for r in P6.no_prose(df).collect()} == {(i, "junk") for i in range(90)} | {(200, "table")}


# ---- leaks --------------------------------------------------------------------------------------------------------------


def test_leaks_against_brute_force(spark, monkeypatch):
    r = random.Random(9)
    vocab = [a + b for a in ("ba", "ko", "mi", "ru", "te", "sa") for b in ("lon", "dar", "fix", "gum", "pel")] + ["the", "of", "and"]
    items = [(i, " ".join(r.choices(vocab, k=r.randint(20, 40)))) for i in range(8)]
    docs = []
    for d in range(120):
        words = r.choices(vocab, k=r.randint(0, 60))
        truth = None
        if d % 3 == 0:
            i, text = items[d % 8]
            w = text.split()
            n = r.choice([int(len(w) * 0.3), int(len(w) * 0.7), len(w)])
            start = r.randint(0, len(w) - n)
            run = w[start : start + n]
            for k in range(4, n - 4, 9):
                run[k] = "changed"
            words = words[:10] + run + words[10:]
            truth = i if n >= len(w) / 2 else None
        docs.append((d, ", ".join(words).upper() if d % 2 else "  ".join(words), truth))
    df = spark.createDataFrame([(d, t, "clash") for d, t, _ in docs] + [(900, None, ""), (901, "", "")], "doc_id long, text string, item_id string")
    ev = spark.createDataFrame(items + [(99, None), (98, "")], "item_id long, text string")
    want = {(d, i) for d, _, i in docs if i is not None}
    assert {tuple(x) for x in P8.find_leaks(df, ev).collect()} == want
    # without any broadcast
    monkeypatch.setattr(P8, "SMALL_ROWS", -1)
    assert {tuple(x) for x in P8.find_leaks(df, ev).collect()} == want
    assert P8.find_leaks(df.limit(0), ev).count() == 0 and P8.find_leaks(df, ev.limit(0)).count() == 0


def test_prefix_is_necessary_and_short():
    """Whatever words are changed, a half with as many as stated keeps a prefix token."""
    r = random.Random(4)
    shares = []
    for n in (10, 11, 23, 24, 37, 60, 95):
        half = P8.half_of(n)
        for _ in range(5):
            places = set(P8.prefix_places([r.randint(0, 30) for _ in range(n - 4)]))
            if n > 30:
                shares.append(len(places) / (n - 4))
            for _ in range(200):
                a = r.randint(0, n - half)
                changed = set(r.sample(range(a, a + half), max(0, min(half // P8.CHANGED_IN, half // 5 - 1))))
                assert any(p >= a and p + 5 <= a + half and changed.isdisjoint(range(p, p + 5)) for p in places)
    assert sum(shares) / len(shares) < 0.4


def test_short_and_changed_items(spark):
    ev = spark.createDataFrame([(1, "Grain!"), (2, "one two"), (3, "red green blue black white pink"), (4, " ".join(f"w{i}" for i in range(30))), (5, "red, green; blue black white pink")], "item_id int, text string")
    docs = [
        (1, "much grain here"), (2, "two"), (3, "red green black white"), (4, "blue, BLACK\nwhite"),
        (5, " ".join(f"w{i}" if i != 9 else "x" for i in range(2, 19))),  # one changed word
        (6, " ".join(f"w{i}" if i % 3 else "x" for i in range(30))),  # too many
        (7, " ".join(f"w{i}" for i in range(13))),  # less than half
        (8, " ".join(["w1", "w2", "w3", "w4", "w5", "w6", "new", *(f"w{i}" for i in range(7, 18))])),  # an added word
        (None, "grain"),
    ]
    got = {tuple(x) for x in P8.find_leaks(spark.createDataFrame(docs, "doc_id int, text string"), ev).collect()}
    assert got == {(1, 1), (2, 2), (4, 3), (4, 5), (5, 4), (8, 4)}


def test_alignment_of_many_pages_at_once():
    r = np.random.RandomState(5)
    keys = r.randint(0, 50, 300)
    assert P5.unique(keys).tolist() == sorted(set(keys.tolist()))
    for k in (keys, keys + (1 << 61), keys[:0]):
        assert P5.firsts(k).tolist() == [k.tolist().index(x) for x in sorted(set(k.tolist()))]
    text = "Il a\u00a0dit_oui: 3,5 \u00abmots\u00bb d'\u00e9t\u00e9\u2026 \U0001d400\U0001d401 \u4e2d\u6587 fin"
    before = P5.words_before(text)
    assert [before[y] for y in range(len(text) + 1)] == [len(re.findall(r"[^\W_]+", text[:y])) for y in range(len(text) + 1)]
    # known words whose slots collide are told apart, unknown ones aren't found
    words = np.sort(r.randint(-(1 << 62), 1 << 62, 5000))
    aligner = P5.Aligner.of({int(w): 1.0 for w in words}, {}, {})
    at, known = aligner.ranks(np.concatenate([words, words + 1]))
    assert (words[at[:5000]] == words).all() and known[:5000].all() and not known[5000:].any()
    # pages of unlike sizes at once have the paths that they have alone
    pages = [(r.rand(n, m), r.randint(20, 90, n).tolist(), r.randint(20, 90, m).tolist()) for n, m in r.randint(1, 12, (40, 2)).tolist()]
    assert aligner.paths(pages) == [aligner.path(*p) for p in pages]


# ---- subjects -----------------------------------------------------------------------------------------------------------


def test_subjects(spark):
    r = random.Random(4)
    terms = {"sport": ["goalkeeper", "penalty shot", "relay team"], "law": ["court of appeal", "statute", "plaintiff"], "health": ["vaccine", "blood test", "clinic"]}
    line = lambda d: f"The mayor said that the {r.choice(terms[d])} was near the {r.choice(terms[d])} in {r.choice('abcdefgh') * 5}."
    ex = [(i, d, " ".join(line(d) for _ in range(3))) for i, d in enumerate(list(terms) * 20)]
    docs = [(1, " ".join(line("sport") for _ in range(5))), (2, " ".join([line("law"), line("health")] * 3)), (3, " ".join([line("law") for _ in range(9)] + [line("sport")])), (4, None), (5, " "), (6, "Der Hund und die Katze sind nicht mit dem Wagen auf der Straße."), (7, "你好，世界。")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {tuple(x) for x in P9.label_subjects(df, spark.createDataFrame(ex, "example_id long, domain string, text string")).collect()}
    assert got == {(1, "sport"), (2, "law"), (2, "health"), (3, "law")}
    assert P9.label_subjects(df.limit(0), spark.createDataFrame(ex, "example_id long, domain string, text string")).count() == 0


def test_languages_unknown_to_the_lists_have_no_rows():
    other = ["Il governo ha approvato la riforma e il ministro dice che la legge non è ancora in vigore.", "O governo aprovou a reforma e o ministro disse que a lei não é para todos.", "De regering heeft de wet aangenomen en de minister zegt dat het goed is.", "Rząd przyjął ustawę i minister mówi, że to dobrze dla kraju.", "El govern ha aprovat la llei i el ministre diu que és bona per al país.", "12 34", ""]
    assert not any(P9.is_en_fr(P9.flat(t)) for t in other)
    assert all(P9.is_en_fr(P9.flat(t)) for t in ("(The dog), the \"cat\": of course.", "L'eau, d'abord; qu'il vienne, dit-on.", "The mayor said so. Le maire l'a dit."))


def test_null_ids_are_left_out(spark):
    docs = spark.createDataFrame([(None, "The dog saw the cat. It ran.", "eng", "segment"), (1, "The dog saw the cat. It ran.", "eng", "segment")], "id int, text string, lang string, stage string")
    assert {r[0] for r in P3.segment_texts(docs, "id", "text", "lang").collect()} == {1}
    assert P6.no_prose(docs.selectExpr("id AS text_id", "lang", "repeat('\ufffd', 40) AS texts")).count() == 1
    ex = spark.createDataFrame([(i, "sport", "The goalkeeper saw the goalkeeper.") for i in range(6)] + [(9, "law", "The statute is the statute.")] * 6, "example_id int, domain string, text string")
    assert {r[0] for r in P9.label_subjects(docs, ex, None, "id").collect()} <= {1}
    pages = spark.createDataFrame([(None, "http://a.example/x", "A whole sentence stands here now.", None, None), (2, "http://a.example/y", "A whole sentence stands here again.", None, None)], "crawl_id int, src_url string, src_content string, tgt_url string, tgt_content string")
    assert {r[0] for r in P2.label_pages(pages).collect()} <= {2} and P5.align_pages(pages).count() == 0


def test_held_out_subjects():
    r = random.Random(6)
    terms = {"a": ["alpha ray", "beta ray"], "b": ["gamma rule", "delta rule"]}
    make = lambda d: (d, " ".join(f"People of {r.choice('uvwxyz') * 4} saw the {r.choice(terms[d])} again." for _ in range(4)))
    model = P9.Subjects([make(d) for d in "ab" * 25])
    assert all(model.subjects(t) == [d] for d, t in (make(d) for d in "ab" * 20))


def test_one_fit_at_every_size_without_copies():
    """Few self-labelled texts teach their terms as many do, and copies of one count once."""
    r = random.Random(6)
    terms = {"a": ["alpha ray", "beta ray"], "b": ["gamma rule", "delta rule"]}
    make = lambda d, more="": (d, " ".join(f"People of {r.choice('uvwxyz') * 4} saw the {r.choice(terms[d])} again{more}." for _ in range(4)))
    examples = [make(d) for d in "ab" * 25]
    texts = [make("a", " at the sigma lake")[1] for _ in range(8)]
    few = P9.fit(examples, [], texts)
    assert "sigma lake" in few.weights and "sigma lake" not in P9.fit(examples, [], []).weights
    assert few.weights == P9.fit(examples, [], texts + [texts[0]] * 90 + [texts[0].upper()] * 9).weights
    assert P9.fit(examples, [], []).weights == P9.Subjects(examples).weights


def test_every_document_teaches_its_terms(spark, monkeypatch):
    """Terms that only few of all documents hold are learned from all of them; the counts of the tasks make the model that is fitted in memory."""
    r = random.Random(6)
    terms = {"a": ["alpha ray", "beta ray"], "b": ["gamma rule", "delta rule"]}
    make = lambda d, more="": " ".join(f"People of {r.choice('uvwxyz') * 4} saw the {r.choice(terms[d])} again{more}." for _ in range(4))
    examples = [(i, d, make(d)) for i, d in enumerate("ab" * 25)]
    texts = [make("ab"[i % 2]) for i in range(192)] + [make("a", " at the sigma lake") for _ in range(8)] + ["The man saw the sigma lake. He was at the sigma lake."]
    texts += [texts[0]] * 30 + [texts[1].upper().replace(" ", "  "), examples[0][2], None, "", "12 34"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    ex = spark.createDataFrame(examples, "example_id long, domain string, text string")
    glosses = [("a", "omega point, alpha ray"), ("c", "tau tax")]
    monkeypatch.setattr(P9, "SELF_LABELLED", 20, raising=False)
    domains = spark.createDataFrame(glosses, "domain string, ycc_gloss string")
    got = {tuple(x) for x in P9.label_subjects(docs, ex, domains).collect()}
    assert (200, "a") in got and len(got) == 201 + 30 + 2
    want = P9.fit([(d, t) for _, d, t in examples], glosses, texts)
    assert got == {(i, d) for i, t in enumerate(texts) if t for d in want.subjects(t)}
    rows = lambda df, domain: df.selectExpr("*", f"{domain} AS d").select(F.col(df.columns[0]).alias("id"), F.col("d").cast("string").alias("domain"), "text").where("text <> ''")
    for held, copies in ((10**6, 10**6), (3, -1)):
        monkeypatch.setattr(P9, "HELD_COUNTS", held)
        monkeypatch.setattr(P9, "SMALL_COPIES", copies)
        model, _ = P9.fit_subjects(rows(docs, "NULL"), rows(ex, "domain"), glosses)
        assert model.weights == want.weights and model.threshold == pytest.approx(want.threshold)


def test_rare_terms_need_a_share_of_the_texts():
    assert P9.supports(360, 2_000) == (P9.MIN_EXAMPLES, P9.MIN_TEXTS) and P9.supports(10**6, 10**8) == (10**3, 10**5)


def test_registered_queries_have_a_function():
    from corploom.llm import registry

    queries, sql = registry.load()
    assert set(sql) <= set(queries) and all(f"p{n}_found" in queries for n in (1, 2, 3, 4, 5, 6, 8, 9)) and "p7_ids" in queries


def test_subject_terms_of_all_sentences_at_once():
    r = random.Random(4)
    bits = ["the", "of", "la", "tax", "court", "rain-fall", "snow", "été", "vote", ", ", ". ", "\n", "\u00a0", "  ", " \t", "’", "… ", "! ", "e.g. ", "3 ", "« ", " (", "\r\n\r\n"]
    texts = [" ".join(r.choice(bits) for _ in range(60)) for _ in range(40)]
    kinds = P9.word_kinds({"tax", "snow", "la"}, {"tax", "snow", "court"})
    wanted = {"tax court", "court", "court of snow"}
    subjects = P9.Subjects([("a", "the tax court sat. snow fell."), ("b", "la vote of tax.")] * 3, [("a", "tax,tax court,snow"), ("b", "court of snow,vote")])
    assert len(subjects.weights) >= 5
    for t in texts:
        f = P9.flat(t)
        assert not re.search(r"[^\S\n ]|  ", f) and f.split() == t.lower().replace("’", "'").split()
        ss = P9.sentences(f)
        assert ss == [" ".join(x.split()) for x in ss] and " ".join(ss).split() == [w for w in " ".join(ss).split(" ") if w]
        want = set()
        for g in set().union(*map(P9.ngrams, ss)):
            words = [w for w in re.findall(r"[^\W\d_]+(?:-[^\W\d_]+)*", g) if w not in P9._STOP]
            if all(w in ("tax", "snow") for w in words) or g in wanted:
                want.add(g)
        short = P9.links(ss, kinds)
        longer = P9.longer_ngrams(ss, kinds, wanted, P9.prefixes(wanted), short)
        assert short.isdisjoint(longer) and short | longer == want
        # without frequent links only those of one link and the wanted ones are left
        assert P9.longer_ngrams(ss, kinds, wanted, P9.prefixes(wanted), set()) == {g for g in longer if g in wanted}
        # each sentence scores as it does alone
        assert subjects.scores(ss) == [x for one in ss for x in subjects.scores([one])]
