import math

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from corploom.llm import p1_lines as P1, p4_copies as P4

PAGES = "crawl_id long, src_url string, src_content string, site string, page string"


def page(i, url, text):
    return (i, url, text, "clash", "clash")


def pages(spark, rows):
    return spark.createDataFrame(rows, PAGES)


def test_site_of(spark):
    urls = [" HTTPS://www.A.example:443/x?q#f ", "a.example/y", "http://a.example", "ftp://u@a.example./", "", None, "   "]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    assert [r[0] for r in df.select(P1.site_of(F.col("u"))).collect()] == ["a.example"] * 4 + [None] * 3


def test_found_lines_and_clean(spark):
    rows = [page(i, f"http://www.a.example/{i}", f"Share this!\nown line {chr(97 + i) * 3}\r\n\n2 - SHARE   this\n12 34") for i in range(6)]
    rows += [page(10 + i, f"http://b{i}.example/", f"other {chr(97 + i) * 4}\nSHARE THIS") for i in range(5)]
    rows += [page(90, None, "Share this"), page(91, "http://a.example/z", None), page(92, "http://a.example/y", "")]
    df = pages(spark, rows)
    found = {tuple(r) for r in P1.found_lines(df).collect()}
    assert found == {(i, k) for i in range(6) for k in (0, 3)}
    clean = {r["crawl_id"]: r["src_content"] for r in P1.without_lines(df, P1.found_lines(df)).collect()}
    assert clean[0] == "own line aaa\r\n\n12 34" and clean[90] == "Share this" and clean[91] is None and clean[92] == "" and len(clean) == len(rows)


def test_a_line_common_to_all_sites_is_no_excess(spark):
    """Single occurrences on nine of ten pages elsewhere: six of eight pages of one site are no more than coincidence."""
    rows = [page(i, f"http://a.example/{i}", f"Introduction\nown {chr(97 + i) * 3}" if i < 6 else f"own {chr(97 + i) * 3}") for i in range(8)]
    rows += [page(100 + 10 * k + j, f"http://s{k}.example/{j}", ("Introduction\n" if j == 0 else "") + f"text {chr(97 + k % 26)}{chr(97 + j)}x{chr(97 + k // 26)}") for k in range(40) for j in range(6)]
    df = pages(spark, rows)
    lines = {r["pages"]: r["g2"] for r in P1.excess_lines(df, min_pages=6, rate=1.0)[0].collect()}
    assert set(lines) == {6}
    dense = pages(spark, rows[:8] + [page(5000 + k, f"http://t{k % 150}.example/{k // 150}", f"Introduction {'abcdef'[k // 150]}" if k // 150 else "Introduction") for k in range(900)])
    weaker = {r["pages"]: r["g2"] for r in P1.excess_lines(dense, min_pages=6, rate=1.0)[0].collect()}
    assert weaker[6] < lines[6]


def test_hot_keys_of_lines(spark, monkeypatch):
    """Every key and site hot, and none: the same lines."""
    df = pages(spark, [page(i, f"http://s{i % 3}.example/{i}", f"again and again\nsite line {'abc'[i % 3]}\nown {chr(97 + i)}") for i in range(24)] + [page(None, "http://s0.example/", "again and again")])
    want = {(i, k) for i in range(24) for k in (0, 1)} | {(None, 0)}
    assert {tuple(r) for r in P1.found_lines(df).collect()} == want
    join = P1.hot_key_join
    monkeypatch.setattr(P1, "hot_key_join", lambda *a, **k: join(*a[:5], 1, 1))
    assert {tuple(r) for r in P1.found_lines(df).collect()} == want


def test_five_pages_are_not_enough_and_empty_tables(spark):
    df = pages(spark, [page(i, "http://a.example/", "again and again") for i in range(5)])
    assert P1.found_lines(df).count() == 0
    assert P1.found_lines(df.limit(0)).count() == 0 and P1.without_lines(df.limit(0), P1.found_lines(df.limit(0))).count() == 0


def test_threshold_is_benjamini_hochberg():
    values = [0.0] * 50 + [3.0, 5.0, 9.0, 15.0, 20.0]
    hist = {}
    for v in values:
        hist[int(v / P1.BIN)] = hist.get(int(v / P1.BIN), 0) + 1
    p = sorted(math.erfc(math.sqrt(v / 2)) / 2 for v in values)
    best = max((i for i, x in enumerate(p, 1) if x <= 0.05 * i / len(p)), default=0)
    assert sum(v >= P1.fdr_threshold(list(hist.items()), 0.05) for v in values) == best


RECORDS = "tm_id long, srctexts string, tgttexts string, key string, copies int"


def records(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], RECORDS)


def test_copies(spark, monkeypatch):
    rows = [
        (5, "Hello, World 1,462!", "Bonjour"), (9, "HELLO world 1,462", "bonjour."), (7, "bonjour", " hello   world 1,462 "), (2, "hello world 1462", "bonjour"), (3, "hello world 1.462", "bonjour"),
        (11, None, "x"), (12, "...", "x"), (13, "...", "x"), (14, "", ""), (20, "straße", "É"), (21, "STRASSE", "é"), (30, "a", "b"), (31, "a", "b"), (32, "a", "b"), (33, "b", "a"), (40, "x" * 5000 + "y", "z"), (41, "x" * 5000 + "Y", "Z"), (42, "x" * 5000 + "w", "Z"),
    ]
    expected = {(5, 9), (5, 7), (20, 21), (30, 31), (30, 32), (30, 33), (40, 41)}
    assert {tuple(r) for r in P4.found_copies(records(spark, rows)).collect()} == expected
    assert {tuple(r) for r in P4.found_copies(records(spark, [*rows, (None, "hello, world 1,462", "bonjour")])).collect()} == expected
    # small buckets force the recursion, also where they aren't broadcast
    monkeypatch.setattr(P4, "SMALL_PREFIXES", -1)
    assert {tuple(r) for r in P4.found_copies(records(spark, rows), bucket_rows=3).collect()} == expected
    monkeypatch.undo()
    assert {tuple(r) for r in P4.found_copies(records(spark, rows), bucket_rows=1).collect()} == expected
    assert P4.found_copies(records(spark, rows).limit(0)).count() == 0


def test_a_third_of_all_rows_in_one_group(spark, monkeypatch):
    monkeypatch.setattr(P4, "TRIE_KEYS", 7)
    rows = [(i, "same text" if i % 3 == 0 else f"text {'abcdefghij'[i % 10]} {i}", "t") for i in range(1, 301)]
    got = P4.found_copies(records(spark, rows).repartition(5), bucket_rows=10).collect()
    assert {r["keep_id"] for r in got} == {3} and len(got) == 99


def test_every_bucket_fits(spark):
    """Whatever the number of records: a bucket holds no more than stated, unless it is one key."""
    keys = [b"same start " * 9 + bytes([97 + i % 26, 97 + i // 26 % 26]) for i in range(300)] + [b"one key"] * 20 + [b"o"]
    partial = spark.createDataFrame([(bytearray(k), 1, i) for i, k in enumerate(keys)], "key binary, copies long, keep_id long")
    rows = P4.bucketed(partial, 10).collect()
    sizes = {}
    for r in rows:
        assert bytes(r["key"]).startswith(bytes(r["bucket"]))
        sizes.setdefault(bytes(r["bucket"]), []).append(bytes(r["key"]))
    assert len(rows) == len(keys) and all(len(v) <= 10 or len(set(v)) == 1 for v in sizes.values())


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.binary(max_size=6), st.integers(1, 5), st.integers(0, 99)), max_size=40))
def test_trie_counts_like_a_dictionary(items):
    trie, plain = P4.Trie(), {}
    for k, n, i in items:
        trie.add(k, n, i)
        c, m = plain.get(k, (0, 10**9))
        plain[k] = (c + n, min(m, i))
    assert {k: (c, i) for k, c, i in trie.items()} == plain and trie.size == len(plain)


@pytest.mark.parametrize("text,key", [("A-b_c", "abc"), ("1,462", "1,462"), ("1, 462", "1462"), ("3.5%", "3.5"), ("…", ""), ("a 1", "a1"), (None, None)])
def test_canonical_side(spark, text, key):
    assert spark.createDataFrame([(text,)], "t string").select(P4.canonical_side(F.col("t"))).first()[0] == key
