"""Spelling variants of words: groups of words one edit apart, by asymmetric q-chunks.

Of two words that may be near, the shorter (of equal ones, either) gives two disjoint
chunks of half its length, one from each end; the other gives its positional grams of
that length. One inserted, deleted or replaced code point can touch only one of the two
chunks, so the other one is a gram of the longer word, in the same place if it stands
before the edit and shifted by the difference of the lengths (at most one) if it stands
behind. Of all positional grams only those in reach of such a chunk are made. Chunks and
grams meet in an equi-join on (length of the shorter word, which chunk, gram), and each
pair that meets is verified.

A chunk that stands in many words would bring all of them together. Such a key is not
joined: its words are contracted, the chunk becoming one mark, and the same two chunks
are taken of what is left, joined within the old key. The contracted words of a pair are
still one edit apart, so no pair is lost; this goes on until a key is small or nothing
but two letters is left, which bounds a key by the square of the alphabet. No pair is
ever made that does not agree in a small key.

Edge cases: null and empty texts hold no words, a null id counts as an empty one in the
dropped-letter rule, repeated rows count as often as they stand there, words that are
counted equally often tie to the smaller one in code-point order, columns of other names
are not read, and a table without words gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coppice.llm.common import text_or_empty
from coppice.operators.components import follow_to_end
from coppice.store import Store

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LEAST_LETTERS = 7
LEAST_COUNT = 2
#: A run loses a code point if this divides its hash.
DROP_EVERY = 31
#: A near word is a word's form if it occurs at least so many times as often.
FORM_FACTOR = 10
#: Rows of one key that are still joined with each other as they are.
KEY_ROWS = 256
#: What a chunk is contracted to; no letter of a word.
MARK = "|"
#: Parts that the rows of one key are dealt into while its size is looked up.
SALTS = 16


def words_of_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(word, n)``: the distinct words with their occurrences in all texts.

    Runs shorter than ``LEAST_LETTERS`` can't become words, as a run only loses letters.
    """
    runs = F.regexp_extract_all(text_or_empty(text_col), F.lit(f"[A-Za-zÀ-ÿ]{{{LEAST_LETTERS},}}"), F.lit(0))
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    one = docs.select(key.alias("key"), F.explode(runs).alias("run"))
    one = one.select("key", F.translate("run", UPPER, UPPER.lower()).alias("run"))
    one = one.withColumn("h", F.crc32(F.concat("key", F.lit(":"), "run").cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    run = F.col("run")
    less = F.concat(run.substr(F.lit(1), at), run.substr(at + 2, F.length("run")))
    word = F.when(F.col("h") % DROP_EVERY == 0, less).otherwise(run)
    counted = one.select(word.alias("word")).where(F.length("word") >= LEAST_LETTERS).groupBy("word")
    return counted.agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST_COUNT)


def near_pairs(words: DataFrame, store: Store, key_rows: int = KEY_ROWS) -> DataFrame:
    """``(x, nx, y, ny)``: every pair of words ``(word, n)`` that differ by exactly one edit, once, the shorter first.

    Words must be distinct.
    """
    long = F.length("word")
    chunked = words.select("word", "n", F.lit(True).alias("chunked"), long.alias("m"))
    grammed = words.select("word", "n", F.lit(False).alias("chunked"), F.explode(F.array(long, long - 1)).alias("m"))
    rows = chunked.union(grammed).where("m > 1").withColumns({"key": F.lit(""), "body": F.col("word")})
    pairs = []
    while True:
        rows = _cut(rows)
        crowded = store.keep(_crowded(rows, key_rows), "crowded")
        small = rows.join(crowded, ["key", "salt"], "left_anti")
        pairs.append(store.keep(_verified(small), "pairs"))
        rows = rows.join(crowded.where("live"), ["key", "salt"], "left_semi").drop("salt")
        if crowded.where("live").isEmpty():
            return reduce(DataFrame.union, pairs).distinct()
        rows = store.keep(rows, "rows")


def _cut(rows: DataFrame) -> DataFrame:
    """Each row with its first and its last chunk (or gram): the longer key, and what is left of the word."""
    q = F.floor(F.col("m") / 2).cast("int")
    body, size = F.col("body"), F.length("body")
    first = F.struct(F.lit("<").alias("side"), body.substr(F.lit(1), q).alias("gram"), F.concat(F.lit(MARK), body.substr(q + 1, size)).alias("rest"))
    last = F.struct(F.lit(">").alias("side"), body.substr(size - q + 1, q).alias("gram"), F.concat(body.substr(F.lit(1), size - q), F.lit(MARK)).alias("rest"))
    cut = rows.withColumn("c", F.explode(F.array(first, last)))
    salt = F.pmod(F.xxhash64("word"), F.lit(SALTS)).cast("int")
    key = F.concat_ws(" ", "key", "m", "c.side", "c.gram")
    return cut.select("word", "n", "chunked", (F.col("m") - q + 1).alias("m"), key.alias("key"), F.col("c.rest").alias("body"), salt.alias("salt"))


def _crowded(rows: DataFrame, key_rows: int) -> DataFrame:
    """Keys of too many rows, once for each salt; ``live`` ones have rows of both kinds and letters left to cut."""
    sizes = rows.groupBy("key").agg(F.sum(F.col("chunked").cast("int")).alias("chunks"), F.count(F.lit(1)).alias("all"), F.max("m").alias("m"))
    live = (F.col("chunks") > 0) & (F.col("all") > F.col("chunks") + 1)
    # With a mark and two letters left, a key holds no more words than pairs of letters.
    over = (F.col("all") > key_rows) & (~live | (F.col("m") > 3))
    return sizes.where(over).select("key", live.alias("live"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))


def _verified(rows: DataFrame) -> DataFrame:
    x = rows.where("chunked").select("key", F.col("word").alias("x"), F.col("n").alias("nx"))
    y = rows.where("NOT chunked").select("key", F.col("word").alias("y"), F.col("n").alias("ny"))
    once = (F.length("x") < F.length("y")) | (F.col("x") < F.col("y"))
    near = F.levenshtein("x", "y", 1) == 1
    return x.join(y, "key").where(once & near).select("x", "nx", "y", "ny").distinct()


def forms(words: DataFrame, pairs: DataFrame) -> DataFrame:
    """``(word, n, n_near, form, form_n)``: the near word of most occurrences, if it has ``FORM_FACTOR`` times as many.

    A word has at most a few thousand near words, so a group is bounded.
    """
    one = F.struct(F.col("x").alias("word"), F.col("y").alias("near"), F.col("ny").alias("near_n"))
    other = F.struct(F.col("y").alias("word"), F.col("x").alias("near"), F.col("nx").alias("near_n"))
    each = pairs.select(F.explode(F.array(one, other)).alias("p")).select("p.*")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    near = each.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    found = words.join(near, "word", "left").withColumn("form_n", -F.col("best.less"))
    has = F.col("form_n") >= FORM_FACTOR * F.col("n")
    return found.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(has, F.col("best.near")).alias("form"),
        F.when(has, F.col("form_n")).alias("form_n"),
    )


def with_roots(formed: DataFrame, store: Store) -> DataFrame:
    """Adds ``root``: the end of the chain of forms. Counts grow tenfold at each step, so chains are short."""
    links = formed.where(F.col("form").isNotNull()).select(F.col("word").alias("id"), F.col("form").alias("up"))
    roots = follow_to_end(links, store).select(F.col("id").alias("word"), F.col("up").alias("root"))
    return formed.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))


def group_variants(docs: DataFrame, store: Store, id_col: str = "doc_id", text_col: str = "text", key_rows: int = KEY_ROWS) -> DataFrame:
    """``(word, n, n_near, form, form_n, root)`` for every word of the texts."""
    words = store.keep(words_of_documents(docs, id_col, text_col), "words")
    formed = store.keep(forms(words, near_pairs(words, store, key_rows)), "forms")
    return with_roots(formed, store)
