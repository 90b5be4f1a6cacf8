import pytest
from pyspark.sql import functions as F

from corploom.functions import entities as E, matcher as M, normalize as N, numbers as U, segment as S, similarity as Y


def run(spark, f, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(f(F.col("t"))).collect()]


CASES = [
    (N.percentages, "up 12 ％ now", "up 12％ now"), (N.percentages_english, "up 12 ％ now", "up 12% now"), (N.percentages_french, "de 12,5% hier", "de 12,5 % hier"), (N.dollar_spaces, "cost$5 now", "cost $5 now"),
    (N.word_spaces_latin, " a \t b c ", "a b c"), (N.capitals_english, "in january on monday, march", "in January on Monday, march"), (N.punctuation_latin, "a , b;c ?", "a, b; c?"), (N.punctuation_latin, "3.5 is 1,000", "3.5 is 1,000"),
    (N.punctuation_french, "a : b", "a : b"), (N.punctuation_arabic, "كلمة ، كلمة", "كلمة، كلمة"), (N.punctuation_chinese, "中文 。 好", "中文。好"), (N.punctuation_japanese, "かな 。 カナ", "かな。カナ"), (N.word_spaces_chinese, "中 文 abc中文", "中文 abc 中文"),
    (N.quotes_latin, 'he " said " “ so ”', 'he "said" “so”'), (N.quotes_french, "« a b »", "« a b »"), (N.quotes_chinese, "“ 好 ”", "“好”"), (N.quotes_japanese, "「 かな 」", "「かな」"), (N.brackets_latin, "( a b )", "(a b)"), (N.brackets_chinese, "（ 好 ）", "（好）"),
    (N.brackets_japanese, "【 好 】", "【好】"), (N.contractions_english, "I ' ve don ' t x", "I've don't x"), (N.contractions_english, "the students ' room", "the students' room"), (N.contractions_french, "l ' eau", "l'eau"), (N.quotes_english, "« a »", '" a "'),
    (N.quotes_to_guillemets, 'dit "oui" et', "dit « oui » et"), (N.quotes_to_guillemets, 'a "b', "a « b"), (N.apostrophe_french, "l'eau qu'il", "l’eau qu’il"), (N.alphabet_french, "´ete ˆe", "éte ê"), (N.cat_tags, "{1>Hi<1} {2}x", "Hi x"),
    (N.clean_html, "a <b>x</b> &amp; y", "a x & y"), (N.repair, "ｆｕ é\x07", "fu é"), (N.numbers_french, "il y a 12345 et 99", "il y a 12 345 et 99"),
]


@pytest.mark.parametrize("f,text,expected", CASES)
def test_normalizers(spark, f, text, expected):
    got = run(spark, f, text, None, "")
    assert got[0] == expected
    assert got[1] is None and got[2] == ""


def test_numbers_french_only_those_of_the_english_side(spark):
    df = spark.createDataFrame([("x 12345 y 6789 z", "12,345 only"), ("x 12345", None), ("x 12345", "")], "f string, e string")
    assert [r[0] for r in df.select(N.numbers_french(F.col("f"), F.col("e"))).collect()] == ["x 12 345 y 6789 z", "x 12 345", "x 12 345"]


def test_humanize(spark):
    assert run(spark, lambda c: N.humanize(c, "eng"), "in january ,  he said « yes » 12 %") == ['in January, he said "yes" 12%']
    assert run(spark, lambda c: N.humanize(c, "fra"), 'Le  prix : "bon" l \'eau 12 %') == ["Le prix : «\xa0bon\xa0» l’eau 12\xa0%"]
    assert run(spark, lambda c: N.humanize(c, "xxx"), "<b>a</b>  b", None) == ["a  b", None]
    df = spark.createDataFrame([(1, "in january ,  x"), (2, None)], "id int, t string")
    assert [tuple(r) for r in N.humanize_table(df, "t", "eng", out="o").orderBy("id").select("id", "o").collect()] == [(1, "in January, x"), (2, None)]


def test_visible_text(spark):
    assert run(spark, N.visible_text, "<p>a  b</p><script>x</script><p>c</p><p>c</p>") == [["a b", "c"]]


@pytest.mark.parametrize("f,text,expected", [
    (lambda c: U.number(c, "eng", "fra"), "1,234.50", "1 234,50"), (lambda c: U.number(c, "eng", "fra"), "1234", "1234"), (lambda c: U.number(c, "fra", "eng"), "1 234,50", "1,234.50"), (lambda c: U.number(c, "eng", "fra"), "x", None),
    (lambda c: U.percent(c, "eng", "fra"), "12.50%", "12,50 %"), (lambda c: U.percent(c, "fra", "eng"), "12,5 %", "12.5%"), (lambda c: U.currency(c, "eng", "fra"), "$1,234.50", "1 234,50 $"), (lambda c: U.currency(c, "fra", "eng"), "5 $", "$5"),
    (lambda c: U.date(c, "eng", "fra"), "March 8, 2021", "8 mars 2021"), (lambda c: U.date(c, "fra", "eng"), "le 1er mai 2020", "May 1, 2020"), (lambda c: U.date(c, "eng", "fra"), "February 30, 2021", None), (lambda c: U.date(c, "eng", "fra"), "2021-03-08", "8 mars 2021"),
    (lambda c: U.template(c, [("^a (.*)$", "$1 b")]), "a x", "x b"), (lambda c: U.template(c, [("^a (.*)$", "$1 b")]), "q", None),
    (lambda c: U.assemble(c, [lambda x: U.number(x, "eng", "fra"), lambda x: U.template(x, [("^(.*)$", "<$1>")])]), "1.5", "<1,5>"), (lambda c: U.assemble(c, [lambda x: U.number(x, "eng", "fra"), lambda x: U.percent(x, "eng", "fra")]), "1.5", "1,5"), (lambda c: U.assemble(c, [lambda x: U.percent(x, "eng", "fra")]), "1.5", None),
])
def test_translators(spark, f, text, expected):
    assert run(spark, f, text, None) == [expected, None]


def test_segments(spark):
    assert run(spark, S.sentences, "A b. C d! 3.5 e", None, "") == [["A b.", "C d!", "3.5 e"], None, []]
    assert run(spark, S.sentences_cjk, "你好。好吗？再见") == [["你好。", "好吗？", "再见"]]
    assert run(spark, lambda c: S.sentences_by_line(c, "eng"), "A b. C\n\nD e.") == [["A b.", "C", "D e."]]
    assert run(spark, S.subsentences, "a; b;c ##### d") == [["a;", "b;", "c", "d"]]
    assert run(spark, S.word_count, " a  b ", "", " ") == [2, 0, 0]
    assert run(spark, lambda c: S.has_word_length(c, 2, 3), "a", "a b", "a b c", "a b c d", None) == [False, True, True, False, None]
    assert run(spark, S.is_sentence, "x.", "x-", "x9", "x_", "") == [True, False, True, False, False]


@pytest.mark.parametrize("lang,yes,no", [("eng", ["a;", "a.", "a!", "a?", "(a)", "[a]", "{a}", 'a"', "a”", "ab", "a1"], ["a:", "a…", "a,", "a_", "a»", "", "x", " "]), ("fra", ["a»"], ["a:"]), ("deu", ["a“"], ["a”"]), ("jpn", ["a。", "a」", "a？"], ["a.", "a?"]), ("ara", ["a؛", "a۔"], ["a؟", "a."]), ("zhs", ["a。", "a）"], ["a)"]), ("hin", ["a|"], ["a.", "a।"])])
def test_final_marks(spark, lang, yes, no):
    """A final mark of the language, or a letter or digit after another character."""
    got = run(spark, lambda c: S.is_sentence(c, lang), *yes, *no, None)
    assert got == [True] * len(yes) + [False] * len(no) + [None]


def test_gaps_in_and_out_of_order(spark):
    df = spark.createDataFrame([(1, "a b a", ["a", "b", "a"]), (2, "a b", ["b", "a"]), (3, "", []), (4, None, ["a"]), (5, "x a", ["a"]), (6, "ab", [])], "i int, t string, p array<string>")
    assert [r[0] for r in df.orderBy("i").select(S.gaps(F.col("t"), F.col("p"))).collect()] == [["", " ", " ", ""], None, [""], None, ["x ", ""], ["ab"]]


def test_humanize_by_language(spark):
    df = spark.createDataFrame([(1, "eng", "in january , « a »"), (2, "fra", "« a » :b"), (3, "xxx", "<b>a</b> , b"), (4, None, None)], "id int, l string, t string")
    chains = [(F.col("l") == x, x) for x in ("eng", "fra", "jpn")]
    got = {r["id"]: r["t"] for r in N.humanize_by_language(df, "t", chains).collect()}
    one = {lang: {r["id"]: r["t"] for r in N.humanize_table(df, "t", lang).collect()} for lang in ("eng", "fra", "xxx")}
    assert got == {1: one["eng"][1], 2: one["fra"][2], 3: one["xxx"][3], 4: None}


def test_gaps_rebuild_the_text(spark):
    df = spark.createDataFrame([("  A b.  C d! ",), ("",), (None,)], "t string").withColumn("p", S.sentences(F.col("t"))).withColumn("g", S.gaps(F.col("t"), F.col("p")))
    assert [r[0] for r in df.select(S.rebuild(F.col("p"), F.col("g"))).collect()] == ["  A b.  C d! ", "", None]


def test_tokens(spark):
    assert run(spark, S.words, "It isn't $5.50, ok.") == [["It", "isn", "'t", "$", "5.50", ",", "ok", "."]]
    assert run(spark, lambda c: S.words(c, "fra"), "l'eau d'ici.") == [["l'", "eau", "d'", "ici", "."]]
    assert run(spark, lambda c: S.words(c, "zhs"), "你好abc。") == [["你", "好", "abc", "。"]]
    assert run(spark, lambda c: S.detokenize(S.words(c)), "Yes, it isn't (so).") == ["Yes, it isn't (so)."]
    assert run(spark, S.search_tokens, "Hello, wörld b2b") == [["hello", "b2b"]]
    assert run(spark, S.simple_tokens, "Hello b2b été a") == [["hello", "été"]]
    assert run(spark, S.query_tokens, " Hello,  World ") == [["hello,", "world"]]
    assert run(spark, S.subword_encode([("▁ab", 60), ("c", 60), ("d", 1)]), "abc abd", None) == [["▁ab", "c", "▁ab", "<unk>"], None]
    assert run(spark, S.script_name, "é", "я", "", None) == ["LATIN", "CYRILLIC", None, None]
    assert run(spark, lambda c: S.has_text_characters(c, "rus"), "да", "ab") == [True, False]
    assert run(spark, S.is_chinese, "你好。", "ab") == [True, False] and run(spark, S.is_japanese, "かな漢字", "ab") == [True, False]
    assert run(spark, S.chinese_system, "国语", "國語", "中") == ["zhs", "zht", None]
    assert run(spark, lambda c: S.convert_chinese(c, "zht"), "国语") == ["國語"]


def test_entities(spark):
    text = "Write to a.b@c.org or www.x.example/y by March 8, 2021 for $3.5 million (12.5 %), file a.pdf"
    for name, expected in (("email", "a.b@c.org"), ("url", "www.x.example/y"), ("date_eng", "March 8, 2021"), ("currency_eng", "$3.5 million"), ("percentage", "12.5 %"), ("filename", "a.pdf")):
        assert run(spark, lambda c: E.extract(c, name), text)[0] == [expected], name
    assert run(spark, E.is_canonical, "plain text", "see www.a.example", "<!-- x -->") == [True, False, False]
    assert run(spark, E.map_code, " EN ", "xx", None) == ["eng", None, None]
    assert run(spark, lambda c: E.plain_scripts(E.strip_bad_characters(c)), "x²​") == ["x2"]
    assert E.code_mapping("iso2", "iso3")["zh"] == "zht"


@pytest.mark.parametrize("metric,expected", [("levenshtein", 0.5714), ("jaccard", 0.4444), ("sorensen_dice", 0.6154), ("cosine", 0.6172), ("damerau", 0.5714), ("jaro", 0.7460), ("jaro_winkler", 0.7460), ("ratcliff_obershelp", 0.6154)])
def test_similarity(spark, metric, expected):
    df = spark.createDataFrame([(1, "kitten", "sitting"), (2, "", ""), (3, "a", ""), (4, None, "a"), (5, "same", "same")], "i int, a string, b string")
    got = [r[0] for r in df.orderBy("i").select(Y.similarity(F.col("a"), F.col("b"), metric)).collect()]
    assert got[0] == pytest.approx(expected, abs=1e-4) and got[1] == 1.0 and got[2] == 0.0 and got[3] is None and got[4] == pytest.approx(1.0)


def test_length_ratio(spark):
    df = spark.createDataFrame([(1, "a b", "a b c d"), (2, "", ""), (3, "a", None), (4, "", "abc")], "i int, a string, b string").orderBy("i")
    assert [r[0] for r in df.select(Y.length_ratio(F.col("a"), F.col("b"))).collect()] == [0.5, None, None, 0.0]
    assert [r[0] for r in df.select(Y.length_similarity(F.col("a"), F.col("b"))).collect()] == [pytest.approx(3 / 7), 1.0, None, 0.0]


def test_jaccard_counts_repeats(spark):
    df = spark.createDataFrame([("aab", "ab")], "a string, b string")
    assert df.select(Y.jaccard(F.col("a"), F.col("b"))).first()[0] == pytest.approx(2 / 3)


def test_matcher(spark):
    rows = [("Yes.", "oui", "Oui."), ("no", "Non.", "non"), ("<b>Ok</b>!", "bien", "Bien!"), ("x", "", "x"), ("Item (1)", "article 1)", "Article (1)"), ("no. 1 here", "no. 1 ici", "n° 1 ici"), ("RBC is", "RBC est", "RBC est"), (None, "a", "a"), ("b", None, "b")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, r string, t string, e string")
    for r in M.match_forms(df, "r", "t").orderBy("i").collect():
        assert r["out"] == r["e"], r
