import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from corploom.operators import align as A, cleaning as C, crawl as W, langid as L, relational as R, search as Q
from corploom.operators.skew import hash_sample, hot_key_join


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_hot_key_join_keeps_all_rows(spark):
    left = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i}") for i in range(90)] + [(900, None)], "id int, k string")
    groups = left.where("k IS NOT NULL").groupBy("k").count()
    out = hot_key_join(left, groups, ["k"], "count", 90, max_hot=10, least=5)
    assert sorted(r["id"] for r in out.collect()) == list(range(90))
    assert hot_key_join(left.limit(0), groups.limit(0), ["k"], "count", 0).count() == 0


def test_hash_sample_is_the_same_every_time(spark):
    df = spark.range(10_000)
    a, b = {r[0] for r in hash_sample(df, "id", 500).collect()}, {r[0] for r in hash_sample(df.repartition(7), "id", 500).collect()}
    assert a == b and 350 < len(a) < 650 and hash_sample(df.limit(10), "id", 500).count() == 10


def test_keep_first_with_ties_nulls_and_extra_columns(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), (None, 3, "z"), (None, 4, "w"), ("b", 5, None)], "k string, o int, row string")
    assert rows(R.keep_first(df, ["k"], ["o"]), "o") == [("a", 1, "y"), (None, 3, "z"), ("b", 5, None)]
    assert rows(R.keep_last(df, ["k"], ["o"]), "o") == [("a", 2, "x"), (None, 4, "w"), ("b", 5, None)]
    assert R.keep_first(df.limit(0), ["k"], ["o"]).count() == 0
    merged = R.merge_keep_first([df.select("k", "o"), spark.createDataFrame([("a", 0), ("c", 9)], "k string, o int")], ["k"], ["o"])
    assert {(r["k"], r["o"], r["part"]) for r in merged.collect()} == {("a", 1, 0), (None, 3, 0), ("b", 5, 0), ("c", 9, 1)}


def test_set_operations(spark):
    new = spark.createDataFrame([("p", "1"), ("p", "2"), ("q", "1"), (None, "3")], "g string, x string")
    old = spark.createDataFrame([("p", "1")], "g string, x string")
    assert {tuple(r) for r in R.group_difference(new, old, "g", "x").collect()} == {("p", "2"), ("q", "1"), (None, "3")}
    assert R.left_over(new, old, ["x"]).count() == 2
    assert rows(R.missing_groups(new.where("g IS NOT NULL"), old, "g"), "g") == [("q", True, False)]
    assert rows(R.group_items(new, "g", "x"), "g") == [(None, ["3"]), ("p", ["1", "2"]), ("q", ["1"])]


def test_update_and_counts(spark):
    base = spark.createDataFrame([("a", 1, None), ("b", None, "t")], "k string, n int, s string")
    new = spark.createDataFrame([("a", None, "new"), ("z", 9, "z")], "k string, n int, s string")
    assert rows(R.update_by_key(base, new, ["k"], {"n": 0}), "k") == [("a", 1, "new"), ("b", 0, "t")]
    events = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert rows(R.add_counts(base.select("k", "n"), events, "k", "n"), "k") == [("a", 3), ("b", 0)]


def test_section_runs(spark):
    sheet = [(0, "Head 1 ID"), (1, "skip"), (2, "a"), (3, "b"), (4, ""), (5, "lost"), (6, "Head 2 ID"), (7, "skip"), (8, "c")]
    df = spark.createDataFrame([("s", *r) for r in sheet], "sheet string, n int, t string")
    got = R.section_runs(df, "n", F.col("t").endswith("ID"), "t", ["sheet"])
    assert rows(got.select("section", "t"), "section", "t") == [("Head 1 ID", "a"), ("Head 1 ID", "b"), ("Head 2 ID", "c")]


def test_sample_staleness_metrics(spark):
    df = spark.range(100)
    assert R.exact_sample(df, "id", 7, "s").count() == 7 and rows(R.exact_sample(df, "id", 7, "s"), "id") == rows(R.exact_sample(df.repartition(3), "id", 7, "s"), "id")
    t = spark.createDataFrame([(1, None, 5), (2, "2020-01-01", 5), (3, "2021-01-01", 5), (4, None, 0)], "i int, d string, size int").withColumn("d", F.to_date("d"))
    assert [r["action"] for r in R.staleness(t, "d", "size", F.lit("2021-01-10").cast("date"), 30).orderBy("i").collect()] == ["recrawl", "recrawl", "count", "skip"]
    m = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), (None, "a"), ("c", None)], "t string, p string")
    got = {r["label"]: (r["precision"], r["recall"], r["support"], r["accuracy"]) for r in R.metrics(m, "t", "p").collect()}
    assert got == {"a": (1.0, 0.5, 2, 0.5), "b": (0.5, 1.0, 1, 0.5), "c": (0.0, 0.0, 1, 0.5)}


def test_cleaning(spark):
    df = spark.createDataFrame([(1, "This is a short one. This one has eight words or even more, surely."), (2, None), (3, "")], "id int, t string")
    assert rows(C.clean_segments(df, "id", "t").select("id", "text"), "id") == [(1, "This one has eight words or even more, surely.")]
    pairs = spark.createDataFrame([(0, "a", "x"), (1, "b", " "), (2, "c", None)], "n int, s string, t string")
    assert [r["translated"] for r in C.untranslated(pairs, pairs.where("n < 2"), "n", "s", "t").orderBy("n").collect()] == [True, False, False]
    assert rows(C.drop_single_tokens(spark.createDataFrame([(0, "a b"), (1, "a b"), (2, "c"), (3, None)], "n int, t string"), "t", "n"), "n") == [(0, "a b")]
    clean, noise = C.route_by_language(spark.createDataFrame([("en",), ("fr",), (None,)], "l string"), F.col("l"))
    assert clean.count() == 2 and noise.count() == 1
    lines = spark.createDataFrame([(i, f"t{i}") for i in range(5)], "n int, t string")
    assert [r["batch"] for r in C.batches(lines, "n", 2).orderBy("n").collect()] == [0, 0, 1, 1, 2]

    def broken(xs):
        raise RuntimeError

    assert [r["translation"] for r in C.translate(lines, "t", lambda xs: [x.upper() for x in xs]).orderBy("n").collect()] == ["T0", "T1", "T2", "T3", "T4"]
    assert {r["translation"] for r in C.translate(lines, "t", broken).collect()} == {None}


LINKS = st.sets(st.tuples(st.integers(0, 5), st.integers(0, 5)), max_size=12)


@settings(max_examples=200, deadline=None)
@given(LINKS, LINKS)
def test_symmetrized_lies_between(forward, backward):
    s = set(A.grow_diag_final_and(set(forward), set(backward)))
    assert forward & backward <= s <= forward | backward


@pytest.mark.parametrize("f,b,expected", [
    ({(0, 0), (1, 1)}, {(0, 0), (1, 1)}, [(0, 0), (1, 1)]), ({(0, 0), (1, 1)}, {(0, 0), (1, 2)}, [(0, 0), (1, 1), (1, 2)]), ({(0, 0), (3, 3)}, {(0, 0)}, [(0, 0), (3, 3)]), ({(0, 0), (0, 3)}, {(0, 0)}, [(0, 0)]),
    ({(0, 0), (1, 0)}, {(0, 0), (0, 1)}, [(0, 0), (0, 1), (1, 0)]), (set(), set(), []), ({(2, 2)}, set(), [(2, 2)]), (set(), {(2, 2)}, [(2, 2)]), ({(0, 1)}, {(1, 0)}, [(0, 1), (1, 0)]), ({(0, 0), (2, 2)}, {(0, 0), (1, 1)}, [(0, 0), (1, 1), (2, 2)]),
])
def test_grow_diag_final_and(f, b, expected):
    assert A.grow_diag_final_and(f, b) == expected


def test_alignment_learns_words(spark):
    data = [("the house", "la maison"), ("the book", "le livre"), ("a book", "un livre"), ("a house", "une maison"), ("the blue house", "la maison bleue"), ("blue book", "livre bleu")] * 3
    pairs = spark.createDataFrame([(i, a.split(), b.split()) for i, (a, b) in enumerate(data)], "line_no int, src_tokens array<string>, tgt_tokens array<string>")
    t = A.lexical_table(pairs, rounds=6)
    best = {r["e"]: r["f"] for r in t.groupBy("e").agg(F.max_by("f", "p").alias("f")).collect()}
    assert best["house"] == "maison" and best["book"] == "livre"
    links = {r["line_no"]: [(x["i"], x["j"]) for x in r["links"]] for r in A.align(pairs, t).collect()}
    assert (1, 1) in links[0]
    empty = spark.createDataFrame([(7, [], ["x"])], pairs.schema)
    assert A.align(empty, t).first()["links"] == []


def test_terms(spark):
    tok = F.array(*map(F.lit, "the red car of a red cart".split()))
    df = spark.range(1).withColumn("t", tok)
    assert df.select(A.occurrences(F.col("t"), "red car")).first()[0] == [1]
    assert df.select(A.occurrences(F.col("t"), "red")).first()[0] == [1, 5]
    pairs = spark.createDataFrame([(0, ["the", "red", "car"], ["la", "voiture", "rouge"]), (1, ["red", "red", "car"], ["x", "y", "z"])], "line_no int, src_tokens array<string>, tgt_tokens array<string>")
    links = spark.createDataFrame([(0, "0-0 1-2 2-1"), (1, "0-0 1-1 2-2")], "line_no int, l string").select("line_no", A.parse_links(F.col("l")).alias("links"))
    terms = spark.createDataFrame([("red car", 2.0), ("red", 1.0), ("the red", 1.0), ("none", 1.0)], "term string, score double")
    # "the red" isn't contiguous in the first pair; "red" occurs twice in the second; "red car" there is an occurrence of its own
    assert {tuple(r) for r in A.project_terms(pairs, links, terms).collect()} == {("red car", "voiture rouge", 2.0), ("red", "rouge", 1.0), ("red car", "y z", 2.0)}
    texts = spark.createDataFrame([("solar roof of a solar roof panel".split(),), ("solar roof panel".split(),), ([],)], "t array<string>")
    got = {r["term"]: (r["freq"], r["words"]) for r in A.term_candidates(texts, "t", ["of", "a"]).collect()}
    assert got["solar roof"] == (3, 2) and got["solar roof panel"] == (2, 3) and "roof of" not in got
    assert [r["term"] for r in A.top_terms(A.term_candidates(texts, "t", ["of", "a"]), 1).collect()] == ["roof"]


def test_search(spark):
    docs = spark.createDataFrame([(0, ["a", "b", "b"]), (1, ["a", "c"]), (2, []), (3, ["d"])], "id int, t array<string>").withColumn("id", F.col("id").cast("long"))
    asked = spark.createDataFrame([(10, ["b"]), (11, ["zz"]), (12, ["d", "d"])], "q long, a array<string>")
    assert rows(Q.best_match(docs, asked, "id", "t", "q", "a"), "q") == [(10, 0, pytest.approx(0.894427191)), (11, 0, 0.0), (12, 3, 1.0)]
    top = Q.bm25_topk(docs, asked, "id", "t", "q", "a", 2)
    assert [(r["q"], r["id"], r["rank"]) for r in top.orderBy("q", "rank").collect()] == [(10, 0, 1), (12, 3, 1)]
    v = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0]), (3, [0.0, 0.0]), (4, None)], "id long, v array<float>")
    q = spark.createDataFrame([(7, [1.0, 0.1])], "q long, w array<float>")
    assert [r["id"] for r in Q.knn(v, q, "id", "v", "q", "w", 3).orderBy("rank").collect()] == [0, 2, 1]
    assert Q.knn(v.limit(0), q, "id", "v", "q", "w", 3).count() == 0
    assert [r["v"] for r in Q.repair_vectors(v, "v", 2).orderBy("id").collect()][4] == [0.0, 0.0]
    with pytest.raises(ValueError):
        Q.assemble(q, v, "q", "id", ("nope",))


def test_crawl(spark):
    pages = spark.createDataFrame([("http://a.example/x/y.html", "<a href='../z'>z</a><A HREF=\"/w#f\">w</A><a href='mailto:x'>m</a><a href=''>e</a>"), ("http://a.example/p", None)], "url string, html string")
    assert {tuple(r) for r in W.edges(pages).collect()} == {("http://a.example/x/y.html", "http://a.example/z"), ("http://a.example/x/y.html", "http://a.example/w")}
    links = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("x", "y")], "src_url string, dst_url string")
    assert rows(W.breadth_first(links, spark.createDataFrame([("a",), ("a",), (None,)], "url string")), "depth") == [("a", 0), ("b", 1), ("c", 2)]
    u = spark.createDataFrame([("http://a.example/en/doc.pdf",), ("http://a.example/en/p?q=1",), ("http://a.example/en/i.png",), ("http://a.example/en/ok/",)], "u string")
    assert rows(W.wanted_links(u, "u", "http://a.example/en"), "u") == [("http://a.example/en/doc.pdf", True), ("http://a.example/en/ok/", False)]
    p = spark.createDataFrame([("http://a.example/en/1",), ("http://a.example/fr/1",), ("http://a.example/en/2",)], "url string")
    assert rows(W.pair_by_rule(p, "url", "http://a.example/en/", "http://a.example/fr/"), "source") == [("http://a.example/en/1", "http://a.example/fr/1")]
    d = spark.createDataFrame([("<div id='content'>pdf-viewer</div>",), ("<div class='main-content'></div>",), ("<p>",)], "h string")
    assert [r[0] for r in d.select(W.document_type(F.col("h"))).collect()] == ["pdf", "word", "none"]
    assert spark.range(1).select(W.file_name(F.lit(1234567), F.lit("http://a/b/c.html"), "en")).first()[0] == "1234567_c_EN.html"
    assert spark.range(1).select(W.language_of(F.lit("http://a/fr/b"))).first()[0] == "fr"


def test_language_identification(spark):
    en, fr = ["the cat sat on the mat and looked at us", "this is what they said about the weather"], ["le chat est sur la table et nous regarde", "voici ce qu'ils ont dit au sujet du temps"]
    df = spark.createDataFrame([(t, "en") for t in en] + [(t, "fr") for t in fr] + [(None, "en"), ("x", None)], "t string, l string")
    model = L.fit(df, "t", "l")
    test = spark.createDataFrame([("the weather is good",), ("le temps est beau",), ("",), (None,)], "t string")
    assert [r[0] for r in test.select(L.detector(spark, model)(F.col("t"))).collect()] == ["en", "fr", None, None]
    assert test.select(L.top_languages(spark, model, 2)(F.col("t"))).first()[0] == ["en", "fr"]


def test_keep_first_of_hot_and_null_keys(spark):
    df = spark.createDataFrame([(i, "same" if i % 3 else None, i % 5, "x") for i in range(200)], "i int, k string, o int, _extra string").repartition(7)
    got = {r["k"]: (r["i"], r["o"]) for r in R.keep_first(df, ["k"], ["o", "i"]).collect()}
    assert got == {"same": (5, 0), None: (0, 0)} and R.keep_first(df, ["k"], ["o", "i"]).columns == df.columns
    assert {r["k"]: r["i"] for r in R.keep_first(df, ["k"], [F.col("o").desc(), F.desc("i")]).collect()} == {"same": 199, None: 189}
    assert R.keep_first(df.limit(0), ["k"], ["i"]).count() == 0
    assert R.keep_first(df, ["k", "o"], ["i"]).count() == 10


def test_fetched_pages_and_language_filter(spark):
    pages = spark.createDataFrame([(1, 200, "a", "a"), (2, 404, "a", "a"), (3, None, "a", "a"), (4, 200, "a", "b"), (5, 200, "a", None)], "id int, http_status int, u string, f string")
    assert {r["id"] for r in W.fetched(pages).collect()} == {1, 4, 5} and {r["id"] for r in W.fetched(pages, asked="u", final="f").collect()} == {1}
    texts = spark.createDataFrame([(i, "the cat and the dog of the town", "eng") for i in range(9)] + [(10 + i, "le chat et le chien de la ville", "fra") for i in range(9)] + [(30, "{1>the dog of the town<1}", None), (31, None, None), (32, " ", None)], "id int, t string, l string")
    assert {r["id"] for r in L.of_language(texts, "t", "eng", L.detector(spark, L.fit(texts, "t", "l"))).collect()} == {*range(9), 30}


def test_long_pairs_train(spark):
    """Words that stand in long segments only get probabilities, and every word's sum to one."""
    long = (["cat"] * 3 + ["dog"] * 3) * 10
    df = spark.createDataFrame([(1, long, [{"cat": "chat", "dog": "chien"}[w] for w in long]), (2, ["house"], ["maison"]), (3, ["cat"], ["chat"]), (4, [], ["x"])], "line_no int, src_tokens array<string>, tgt_tokens array<string>")
    got = {(r["e"], r["f"]): r["p"] for r in A.lexical_table(df, most_tokens=8, rounds=6).collect()}
    assert got["dog", "chien"] > 0.6 > got["dog", "chat"] and got["cat", "chat"] > 0.6 and got["house", "maison"] > 0.6  # one chunk alone would leave no dog
    for e in ("cat", "dog", ""):
        assert sum(p for (x, _), p in got.items() if x == e) == pytest.approx(1.0)


def test_term_pipeline(spark, tmp_path):
    pairs = spark.createDataFrame([(i, f"The water pump of {n} is old.", f"La pompe à eau de {n} est vieille.") for i, n in enumerate(["Lod", "Mir", "Tas", "Gov", "Bek", "Zul"] * 3)] + [(90 + i, f"The old {n} is here.", f"Le vieux {n} est ici.") for i, n in enumerate(["pont", "lac"] * 4)] + [(99, None, "x"), (98, "", "y")], "id int, s string, t string")
    terms = A.extract_terms(pairs, "id", "s", "t", "eng", "fra", ["the", "of", "is"])
    rows = terms.collect()
    assert {r["source"] for r in rows} >= {"pump"} and len({r["source"] for r in rows}) == len(rows)
    A.write_terms(terms, str(tmp_path / "terms"))
    assert spark.read.csv(str(tmp_path / "terms"), header=True).count() == len(rows)
    assert A.extract_terms(pairs.limit(0), "id", "s", "t", "eng", "fra", []).count() == 0


def test_spread(spark):
    from corploom.session import spread

    few, many = spark.range(100).coalesce(1), spark.range(100).repartition(9)
    assert spread(few, "id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism and spread(many, "id") is many
    assert spread(few, "id").count() == 100


def test_approximate_neighbours(spark):
    import numpy as np

    r = np.random.RandomState(1)
    centres = r.randn(8, 16)
    rows = [(i, [float(x) for x in centres[i % 8] + 0.1 * r.randn(16)]) for i in range(400)] + [(1000 + i, [1.0] + [0.0] * 15) for i in range(200)] + [(5000, None), (5001, [0.0] * 16)]
    v = spark.createDataFrame(rows, "id long, v array<double>")
    asked = v.where("id % 50 = 0 AND v IS NOT NULL").selectExpr("id AS q", "v AS w")
    exact = {(x["q"], x["id"]) for x in Q.knn(v, asked, "id", "v", "q", "w", 5).collect()}
    near = {(x["q"], x["id"]) for x in Q.knn_approximate(v, asked, "id", "v", "q", "w", 5, share=0.2).collect()}
    assert len(exact & near) >= 0.9 * len(exact) and len(near) == len(exact)
    whole = {(x["q"], x["id"]) for x in Q.knn_approximate(v, asked, "id", "v", "q", "w", 5, share=1.0).collect()}
    assert whole == exact
    assert Q.knn_approximate(v.limit(0), asked, "id", "v", "q", "w").count() == 0 and Q.knn_approximate(v, asked.limit(0), "id", "v", "q", "w").count() == 0


def shuffled(df):
    """The most rows that one exchange of the frame's own plan wrote."""
    df.collect()
    most, nodes = 0, [df._jdf.queryExecution().executedPlan()]
    while nodes:
        node = nodes.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            nodes.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            nodes.append(node.plan())
        if kind == "ShuffleExchangeExec":
            most = max(most, node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
    return most


def searchable(spark, n):
    """Documents that all share a word, and every tenth as a query."""
    docs = spark.range(n).select("id", F.array(F.lit("the"), F.concat(F.lit("w"), F.col("id") % 40), F.concat(F.lit("v"), F.col("id") % 7)).alias("t"))
    return docs, docs.where("id % 10 = 0").select(F.col("id").alias("q"), F.col("t").alias("a"))


def test_bm25_writes_no_pairs(spark, monkeypatch):
    docs, asked = searchable(spark, 2_000)
    top = Q.bm25_topk(docs, asked, "id", "t", "q", "a", 5)
    assert shuffled(top) <= 20_000  # 400,000 pairs share a word
    scores = Q.bm25_weights(docs, "id", "t").join(asked.select("q", F.explode("a").alias("term")), "term").groupBy("q", "id").agg(F.round(F.sum("weight"), 6).alias("score"))
    expected = rows(Q.top_k(scores, "q", "id", "score", 5), "q", "rank")
    assert [(r["q"], r["id"], r["score"], r["rank"]) for r in top.orderBy("q", "rank").collect()] == expected
    monkeypatch.setattr(Q, "ASKED_BLOCK", 100)
    monkeypatch.setattr(Q, "DOCS_BLOCK", 100)
    assert [(r["q"], r["id"], r["score"], r["rank"]) for r in Q.bm25_topk(docs, asked, "id", "t", "q", "a", 5).orderBy("q", "rank").collect()] == expected
    # scores of zero and below are scores: a word of half the documents weighs nothing
    few = spark.createDataFrame([(1, ["a"]), (2, ["b"])], "id long, t array<string>")
    assert rows(Q.bm25_topk(few, few.select(F.col("id").alias("q"), F.col("t").alias("a")), "id", "t", "q", "a").select("q", "id", "score"), "q") == [(1, 1, 0.0), (2, 2, 0.0)]


def test_best_match_writes_no_pairs(spark):
    docs, asked = searchable(spark, 2_000)
    best = Q.best_match(docs, asked, "id", "t", "q", "a")
    assert shuffled(best) <= 20_000  # 400,000 pairs share a word
    first = {}
    for r in docs.orderBy("id").collect():
        first.setdefault(tuple(r["t"]), r["id"])
    assert {r["q"]: (r["id"], r["score"]) for r in best.collect()} == {r["q"]: (first[tuple(r["a"])], 1.0) for r in asked.collect()}


def test_training_writes_no_cells(spark):
    """The probabilities are those of plain expectation-maximization, and the shared folder doesn't get the cells of all pairs."""
    import os

    from corploom.session import ensure_checkpoint_dir

    data = [(i, [f"s{(i * (j + 3) + j) % 37}" for j in range(20)], [f"t{(i * (j + 5) + j * j) % 41}" for j in range(20)]) for i in range(300)]
    pairs = spark.createDataFrame(data, "line_no int, src_tokens array<string>, tgt_tokens array<string>")
    ensure_checkpoint_dir(spark)
    folder = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    size = lambda: sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(folder) for f in fs)
    before = size()
    got = {(r["e"], r["f"]): r["p"] for r in A.lexical_table(pairs, rounds=3).collect()}
    assert size() - before < 3_000_000  # the cells alone are 120,000 rows of 64 bytes and more
    p = {}
    for _ in range(3):
        counts, totals = {}, {}
        for _, s, t in data:
            for f in t:
                z = sum(p.get((e, f), 0.0) if p else 1.0 for e in ["", *s])
                for e in ["", *s]:
                    c = (p[e, f] if p else 1.0) / z
                    counts[e, f] = counts.get((e, f), 0.0) + c
                    totals[e] = totals.get(e, 0.0) + c
        p = {(e, f): c / totals[e] for (e, f), c in counts.items()}
    assert got == pytest.approx(p)


def test_term_pairs_write_no_cells(spark):
    """Terms come through the packed alignment: the shared folder doesn't get the cells of all pairs in every round."""
    import os

    from corploom.session import ensure_checkpoint_dir

    word = lambda n, m: "".join(chr(97 + (n // 5**k) % 5) for k in range(3)) + m
    pairs = spark.createDataFrame([(i, " ".join(word((i * (j + 3) + j) % 37, "ol") for j in range(20)), " ".join(word((i * (j + 5) + j * j) % 41, "ir") for j in range(20))) for i in range(300)], "id int, s string, t string")
    ensure_checkpoint_dir(spark)
    folder = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    size = lambda: sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(folder) for f in fs)
    before = size()
    A.extract_terms(pairs, "id", "s", "t", "eng", "fra", []).collect()
    assert size() - before < 8_000_000  # the cells of both directions alone are 240,000 rows of 64 bytes and more
