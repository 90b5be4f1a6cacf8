import pytest
from pyspark.sql import functions as F

from corploom.sources import memory as M, sheets as X, text as T
from corploom.streaming import ingest as I


def test_lines(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\r\n two \n\nlast")
    (tmp_path / "e.txt").write_text("")
    assert [tuple(r) for r in T.read_lines(spark, str(tmp_path / "a.txt"), True).select("line_no", "text").orderBy("line_no").collect()] == [(0, "one"), (1, "two"), (2, ""), (3, "last")]
    assert T.read_lines(spark, str(tmp_path / "e.txt")).count() == 0
    T.write_lines(spark.createDataFrame([(1, " b "), (0, "a"), (2, None)], "n int, text string"), str(tmp_path / "out"), order="n")
    assert T.read_large_lines(spark, str(tmp_path / "out")).count() == 3


def test_parallel(spark, tmp_path):
    (tmp_path / "s").write_text("a\nb\n")
    (tmp_path / "t").write_text("x\ny")
    (tmp_path / "u").write_text("x\n")
    assert T.read_parallel(spark, str(tmp_path / "s"), str(tmp_path / "t")).orderBy("line_no").collect()[1]["tgt"] == "y"
    with pytest.raises(Exception, match="differ in length"):
        T.read_parallel(spark, str(tmp_path / "s"), str(tmp_path / "u")).collect()
    T.write_aligner_input(spark.createDataFrame([(" a ", "b")], "s string, t string"), str(tmp_path / "al"), "s", "t")
    assert spark.read.text(str(tmp_path / "al")).first()[0] == "a ||| b"


def test_csv_and_tables(spark, tmp_path):
    df = spark.createDataFrame([("a,b", 'say "x"'), ("line\nend", None)], "x string, y string")
    T.write_csv(df, str(tmp_path / "c"))
    assert {tuple(r) for r in T.read_csv(spark, str(tmp_path / "c")).collect()} == {("a,b", 'say "x"'), ("line\nend", None)}
    T.append(df, str(tmp_path / "p"), "y")
    T.append(df, str(tmp_path / "p"), "y")
    assert spark.read.parquet(str(tmp_path / "p")).count() == 4
    T.write_by_language(spark.createDataFrame([("a", "en"), ("b", "fr")], "t string, l string"), str(tmp_path / "l"), "t", "l")
    assert spark.read.text(str(tmp_path / "l/lang=fr")).first()[0] == "b"


def test_workbook(spark, tmp_path):
    path = str(tmp_path / "b.xlsx")
    X.write_xlsx({"one": spark.createDataFrame([(" a & b ", "x"), (None, "y")], "s string, t string"), "two": spark.createDataFrame([(1.75,)], "n double")}, path)
    cells = X.read_xlsx(spark, path)
    assert X.cell(cells, "two", 1, 0).first()[0] == "1"
    assert [r["values"] for r in X.rows(cells, "one", end=1).orderBy("row").collect()] == [["s", "t"], [" a & b ", "x"], [None, "y"]]
    assert [r["values"] for r in X.columns(cells, "one", end=2).orderBy("col").collect()] == [["s", " a & b ", None], ["t", "x", "y"]]
    with pytest.raises(ValueError):
        X.read_pairs(spark, path)
    single = str(tmp_path / "p.xlsx")
    X.write_xlsx({"one": spark.createDataFrame([(" a ", "x")], "s string, t string")}, single)
    assert [(r["src"], r["tgt"]) for r in M.read_memory(spark, single, "excel").orderBy("unit").collect()] == [("s", "t"), ("a", "x")]


def test_tmx_round_trip(spark, tmp_path):
    M.write_tmx(spark.createDataFrame([("a  b", "c"), ("d", "e"), (None, "x")], "src string, tgt string"), str(tmp_path / "t"), "en", "fr")
    got = M.read_tmx(spark, str(tmp_path / "t"))
    assert {(r["src"], r["tgt"]) for r in got.collect()} == {("a b", "c"), ("d", "e")}
    (tmp_path / "x.tmx").write_text('<tmx><body><tu><tuv xml:lang="en"><seg>only</seg></tuv></tu><tu><tuv xml:lang="EN"><seg>a</seg></tuv><tuv xml:lang="FR"><seg>b</seg></tuv></tu><tu><tuv xml:lang="en"><seg>a</seg></tuv><tuv xml:lang="fr"><seg>b</seg></tuv><tuv xml:lang="de"><seg>c</seg></tuv></tu></body></tmx>')
    assert [(r["src_lang"], r["tgt_lang"], r["src"]) for r in M.read_tmx(spark, str(tmp_path / "x.tmx")).collect()] == [("en", "fr", "a")]


def test_xliff(spark, tmp_path):
    good = '<xliff><file><body><trans-unit id="1" trans-origin="mt" gross-score="0.9"><source>a\n b</source><target>c</target></trans-unit></body></file></xliff>'
    (tmp_path / "g.mxliff").write_text(good)
    (tmp_path / "b.mxliff").write_text(good.replace("<target>c</target>", "<target></target>"))
    r = M.read_mxliff(spark, str(tmp_path / "g.mxliff")).first()
    assert (r["src"], r["tgt"], r["mt_origin"], r["score"]) == ("a b", "c", "mt", 0.9)
    assert M.by_origin(M.read_mxliff(spark, str(tmp_path / "g.mxliff")), ["tm"]).count() == 0
    with pytest.raises(Exception, match="no target"):
        M.read_mxliff(spark, str(tmp_path / "b.mxliff")).collect()
    assert M.mxliff_sources(spark, str(tmp_path / "b.mxliff")).first()["src"] == "a b"
    (tmp_path / "s.sdlxliff").write_text('<xliff><trans-unit id="1"><source>a</source><target><mrk mid="1">b</mrk><mrk mid="2">c</mrk></target></trans-unit></xliff>')
    assert M.read_sdlxliff(spark, str(tmp_path / "s.sdlxliff")).first()["tgt"] == "b"
    (tmp_path / "s.xml").write_text("<r><seg><src>a</src><tgt>b</tgt></seg><seg><src></src><tgt>b</tgt></seg></r>")
    assert [(x["src"], x["tgt"]) for x in M.read_memory(spark, str(tmp_path / "s.xml"), "xml").collect()] == [("a", "b")]
    with pytest.raises(ValueError):
        M.read_memory(spark, "x", "nope")


def test_stream(spark, tmp_path):
    df = spark.createDataFrame([("2024-01-01 00:00:00", "one two three four five six seven eight."), ("2024-01-01 00:10:00", "one two three four five six seven eight."), ("2024-01-01 05:00:00", "too short."), ("2024-01-01 05:00:00", None)], "ts string, t string").withColumn("ts", F.to_timestamp("ts"))
    df.write.parquet(str(tmp_path / "in"))
    stream = I.segment_stream(spark, str(tmp_path / "in"), "ts timestamp, t string")
    q = I.clean_stream(stream, "t", "ts").writeStream.format("memory").queryName("cleaned").option("checkpointLocation", str(tmp_path / "c1")).start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("cleaned").count() == 1
    w = I.windowed_counts(stream, "ts", "t", "1 hour", "1 hour").writeStream.format("memory").queryName("counted").outputMode("append").option("checkpointLocation", str(tmp_path / "c2")).start()
    w.processAllAvailable()
    w.stop()
    assert {(r["t"], r["n"]) for r in spark.table("counted").collect()} == {("one two three four five six seven eight.", 2)}


def test_insert_and_stored_tables(spark, tmp_path):
    from corploom.operators.search import read_or_build, write_index

    spark.sql(f"CREATE TABLE seg (id BIGINT, t STRING) USING parquet LOCATION '{tmp_path / 'seg'}'")
    try:
        df = spark.createDataFrame([(7, "a"), (8, None)], "id long, t string")
        T.insert(df, "seg")
        T.insert(df, "seg", primary_key="id")
        assert {tuple(r) for r in spark.table("seg").collect()} == {(7, "a"), (8, None), (None, "a"), (None, None)}
    finally:
        spark.sql("DROP TABLE seg")
    path, built = str(tmp_path / "index"), []

    def build():
        built.append(1)
        return df

    assert read_or_build(spark, path, build).count() == 2 and read_or_build(spark, path, build).count() == 2 and len(built) == 1
    write_index(df.limit(1), path)
    assert read_or_build(spark, path, build).count() == 1


def test_queries_run_on_the_smallest_tables(spark):
    """Every registered core query gives a stable schema; those with SQL have one of a registered name."""
    import os

    from corploom.plans import registry

    queries, sql = registry.load()
    assert set(sql) <= set(queries)
    where = "/root/testdata/sf0.001"
    if not os.path.exists(where):
        pytest.skip("no test tables")
    for name in ("clean_pipeline", "norm_humanize_fra", "keyed_update", "anchor_edges", "bm25_topk", "tmx_roundtrip", "match_form"):
        assert queries[name](spark, where).limit(1).count() <= 1, name


def test_long_frames_go_on_in_further_sheets(spark, tmp_path):
    path = str(tmp_path / "long.xlsx")
    X.write_xlsx({"Sheet1": spark.range(25).coalesce(1).select(F.concat(F.lit("s"), F.col("id")).alias("source"), F.concat(F.lit("t"), F.col("id")).alias("target"))}, path, most_rows=9)
    assert [n for n, _ in X.sheet_names(path)] == ["Sheet1", "Sheet1 (2)", "Sheet1 (3)"]
    got = [tuple(r) for r in M.read_memory(spark, path, "excel").where("unit > 0").orderBy("unit").select("src", "tgt").collect()]
    assert got == [(f"s{i}", f"t{i}") for i in range(25)]
