"""Problem 7: encode a corpus with a public byte-level BPE vocabulary, inside the JVM.

Words are cut by the vocabulary's published pattern with ``regexp_extract_all``. The distinct words are counted over all
documents, and each is encoded once by a higher-order-function fold: the state is the word's pieces (binary) and the rank
of every adjacent pair; each step merges the lowest-ranked, leftmost pair and looks up the two ranks that change. The rank
table is a literal (a session variable, which the optimizer replaces by its value): an array of small maps, addressed by hash, so that a lookup doesn't scan.

The encoded words that occur most often (at most ``head_words``, each at most ``head_bytes`` long: a proven bound) become a
second literal of the same form. Documents are then encoded by lookups without any shuffle of their text; a word outside
the head is folded in place. The result is the same whatever the bound.

Nulls and empty texts give an empty list. Other columns are ignored; rows are never dropped, repeated ids stay repeated.
"""

from __future__ import annotations

import base64
import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corploom.session import cut, spread, table

TOKENIZERS = os.environ.get("CORPLOOM_TOKENIZERS", "/opt/tokenizers")
#: Fixed value: the published pre-tokenization pattern of the vocabulary ((?U): Unicode white space in Java).
PATTERN = r"(?U)'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
RANK_SLOTS = 65_536
HEAD_WORDS = 200_000
HEAD_BYTES = 64


def rank_table(spark: SparkSession, path: str) -> DataFrame:
    """(piece binary, rank int) of a rank file; its size is fixed by the vocabulary."""
    with open(path, "rb") as f:
        rows = [(bytearray(base64.b64decode(a)), int(b)) for a, b in (line.split() for line in f if line.strip())]
    import pyarrow as pa

    return spark.createDataFrame(pa.table({"piece": pa.array([bytes(a) for a, _ in rows], pa.binary()), "rank": pa.array([b for _, b in rows], pa.int32())}))


def slotted(pairs: DataFrame, key: str, value: str, slots: int) -> DataFrame:
    """One row, one column: array of ``slots`` maps; an entry sits at pmod(hash(key), slots). Bounded by the caller."""
    spark = pairs.sparkSession
    filled = pairs.groupBy(F.pmod(F.hash(key), F.lit(slots)).alias("slot")).agg(F.collect_list(F.struct(key, value)).alias("m"))
    return (
        spark.range(slots).withColumnRenamed("id", "slot")
        .join(filled, "slot", "left")
        .groupBy().agg(F.array_sort(F.collect_list(F.struct("slot", "m"))).alias("a"))
        .select(F.transform("a", lambda x: F.map_from_entries(x["m"])).alias("a"))
    )


def as_literal(one: DataFrame) -> Column:
    """The single value of a one-row frame as a session variable: the optimizer sees a literal, also inside lambdas."""
    spark, name = one.sparkSession, f"corploom_{uuid.uuid4().hex}"
    one.createOrReplaceTempView(name)
    spark.sql(f"DECLARE OR REPLACE VARIABLE {name}_v {one.schema[0].dataType.simpleString()}")
    spark.sql(f"SET VAR {name}_v = (SELECT {one.columns[0]} FROM {name})")
    spark.catalog.dropTempView(name)
    return F.expr(f"session.{name}_v")


def probe(slots_col: Column, slots: int, key: Column) -> Column:
    """The value of ``key`` in a slotted literal, else null."""
    return F.try_element_at(F.get(slots_col, F.pmod(F.hash(key), F.lit(slots))), key)


def fold_merges(word: Column, rank_of) -> Column:
    """array<int> of ids of one word. ``rank_of(pair)`` gives the merge rank (= the id) of a byte string, or null."""
    raw = F.encode(word, "UTF-8")
    size = F.octet_length(raw)
    pieces = F.transform(F.sequence(F.lit(1), size), lambda i: raw.substr(i, F.lit(1)))
    ranks = F.transform(F.sequence(F.lit(1), F.greatest(size - 1, F.lit(1))), lambda i: rank_of(raw.substr(i, F.lit(2))))
    start = F.struct(pieces.alias("p"), F.when(size > 1, ranks).otherwise(F.array().cast("array<int>")).alias("r"))

    def step(s: Column, _: Column) -> Column:
        low = F.array_min(s["r"])
        i = F.array_position(s["r"], low).cast("int")  # 1-based: pieces i and i+1 merge
        p, r, n = s["p"], s["r"], F.size(s["p"])
        piece = lambda k: F.get(p, k - 1)
        new = F.concat(piece(i), piece(i + 1))
        left = F.when(i > 1, F.array(rank_of(F.concat(piece(i - 1), new)))).otherwise(F.array().cast("array<int>"))
        right = F.when(i + 2 <= n, F.array(rank_of(F.concat(new, piece(i + 2))))).otherwise(F.array().cast("array<int>"))
        merged = F.struct(
            F.concat(F.slice(p, F.lit(1), i - 1), F.array(new), F.slice(p, i + 2, n)).alias("p"),
            F.concat(F.slice(r, F.lit(1), F.greatest(i - 2, F.lit(0))), left, right, F.slice(r, i + 2, n)).alias("r"),
        )
        return F.when(low.isNull(), s).otherwise(merged)

    return F.aggregate(F.sequence(F.lit(1), F.greatest(size, F.lit(1))), start, step, lambda s: F.transform(s["p"], rank_of))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))


def encode_corpus(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizers: str = TOKENIZERS, name: str = "byte_bpe_50k", head_words: int = HEAD_WORDS, head_bytes: int = HEAD_BYTES) -> DataFrame:
    """(id, ids array<int>): the ids of every row's text; [] for null and for ''."""
    spark = docs.sparkSession
    docs = docs.select(id_col, text_col)
    ranks = slotted(rank_table(spark, os.path.join(tokenizers, f"{name}.tiktoken")), "piece", "rank", RANK_SLOTS)
    ranks = as_literal(ranks)
    rank_of = lambda key: probe(ranks, RANK_SLOTS, key)
    counted = docs.select(F.explode(words_of(F.col(text_col))).alias("word")).groupBy("word").count()
    head = counted.where(F.octet_length("word") <= head_bytes).orderBy(F.desc("count"), "word").limit(head_words).select("word")
    # written once: the fold runs once a word, in parallel, and the literal is built from the stored result
    head = cut(head.repartition(spark.sparkContext.defaultParallelism * 2, "word").select("word", fold_merges(F.col("word"), rank_of).alias("ids")))
    known = as_literal(slotted(head, "word", "ids", RANK_SLOTS))
    encode = lambda w: F.coalesce(probe(known, RANK_SLOTS, w), fold_merges(w, rank_of))
    ids = F.flatten(F.transform(words_of(F.col(text_col)), encode))
    return docs.select(id_col, F.coalesce(ids, F.array().cast("array<int>")).alias("ids"))


def decode_corpus(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", tokenizers: str = TOKENIZERS, name: str = "byte_bpe_50k") -> DataFrame:
    """(id, text): the binary pieces concatenated. An id outside the vocabulary gives a null text; [] gives ''."""
    spark = encoded.sparkSession
    pieces = rank_table(spark, os.path.join(tokenizers, f"{name}.tiktoken"))
    # pieces as hexadecimal text, which is joined in one pass however long the document
    array = pieces.groupBy().agg(F.array_sort(F.collect_list(F.struct("rank", "piece"))).alias("a")).select(F.transform("a", lambda x: F.hex(x["piece"])).alias("a"))
    array = as_literal(array)
    parts = F.transform(F.col(ids_col), lambda i: F.get(array, i))
    text = F.when(F.forall(parts, lambda x: x.isNotNull()), F.decode(F.unhex(F.array_join(parts, "")), "UTF-8"))
    return encoded.select(id_col, text.alias("text"))


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_corpus(spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id"))


def p7_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, text): the texts decoded from their ids; null ones come back empty."""
    return decode_corpus(encode_corpus(table(spark, sf_dir, "documents").select("doc_id", "text")))


QUERIES = {"p7_ids": p7_ids, "p7_roundtrip": p7_roundtrip}
SQL = {"p7_roundtrip": "SELECT doc_id, coalesce(text, '') AS text FROM documents"}
