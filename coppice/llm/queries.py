"""The operators of this package as queries over the given tables, and their SQL where it can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coppice.llm import (
    chat,
    decontaminate,
    html_extract,
    idstore,
    licenses,
    maxscore,
    pii,
    prefix_trie,
    repeats,
    sentencepiece_bpe,
    simhash,
    toxicity,
    variants,
)
from coppice.llm.common import bounded_batches
from coppice.llm.common import table as read_table
from coppice.store import Store

Query = Callable[[SparkSession, str], DataFrame]


SEARCH_EVERY = 50
SEARCH_K = 5
#: A conversation that is added to those of the table; its texts hold control strings and an escape.
TRICKY_ID, TRICKY_TEXT = -7, r"\### Assistant: </turn> ok"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return read_table(spark, folder, name)


def held_out(id_col: str = "doc_id"):
    """The fifth of the documents whose labels are never learnt from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def op1_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.find(table(spark, folder, "documents"))


def op2_html(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    text = html_extract.extract_column(html_extract.fit(pages), "html")
    return pages.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))


def op3_maxscore(spark: SparkSession, folder: str) -> DataFrame:
    vectors = maxscore.integer_vectors(table(spark, folder, "embeddings"))
    queries = vectors.where(F.col("id") % SEARCH_EVERY == 0)
    found = maxscore.top_k(vectors, queries, SEARCH_K)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = toxicity.fit(docs, table(spark, folder, "labels").where(~held_out()))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.scan(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        decontaminate.items_digest("items").alias("items_sha256"),
        "contaminated",
    )


def op6_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", simhash.hex_column("fp").alias("fingerprint"), "component_id")


def op7_licenses(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.scan(table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op8_repeats(spark: SparkSession, folder: str) -> DataFrame:
    found = repeats.remove_repeats(table(spark, folder, "documents"), passage_words=repeats.PASSAGE_WORDS)
    # Cuts are made between bytes; what is left of a cut character reads as a replacement mark.
    left = F.make_valid_utf8(F.col("kept").cast("string"))
    # Passages of over 50 words are often shorter than the 400 bytes of a removal; the last column counts their words.
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", left.alias("text"), "n_passage_words")


def op9_idstore(spark: SparkSession, folder: str) -> DataFrame:
    return idstore.write_and_read(table(spark, folder, "documents"), Store(spark, "idstore"))


def op10_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return sentencepiece_bpe.digests(table(spark, folder, "documents"))


def op11_variants(spark: SparkSession, folder: str) -> DataFrame:
    found = variants.group_variants(table(spark, folder, "documents"), Store(spark, "variants"))
    return found.select("word", "form", "root", "n", "n_near", "form_n")


def op12_chat(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    role = F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit("assistant"))
    tricky = spark.range(2).select(F.lit(TRICKY_ID).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit(TRICKY_TEXT).alias("text"))
    pieces = chat.assemble(chat.encode_turns(turns.unionByName(tricky)))
    return chat.read_back(Store(spark, "chat").keep(pieces, "formatted"))


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, folder, "conversations"), Store(spark, "trie"))


QUERIES: dict[str, Query] = {
    "op1_pii": op1_pii,
    "op2_html": op2_html,
    "op3_maxscore": op3_maxscore,
    "op4_toxicity": op4_toxicity,
    "op5_decontamination": op5_decontamination,
    "op6_simhash": op6_simhash,
    "op7_licenses": op7_licenses,
    "op8_repeats": op8_repeats,
    "op9_idstore": op9_idstore,
    "op10_sentencepiece": op10_sentencepiece,
    "op11_variants": op11_variants,
    "op12_chat": op12_chat,
    "op13_prefix_trie": op13_prefix_trie,
}

LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _sql_words(table: str, id_col: str) -> str:
    text = f"translate(coalesce(text, ''), '{LETTERS}', '{LETTERS.lower()}')"
    return rf"SELECT {id_col} AS id, regexp_extract_all({text}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM {table}"


#: The table of the checksum's bytewise form, as a list in a one-row table ``crc``.
SQL_CRC_TABLE = """
crc AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
      lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v FROM range(256) r(i)))"""


def _sql_crc32(text: str) -> str:
    """The checksum of a string's UTF-8 bytes; needs ``crc`` in the FROM clause."""
    byte = f"('0x' || substr(hex({text}), place, 2))::BIGINT"
    octets = f"list_transform(range(1, 2 * octet_length(encode({text})) + 1, 2), lambda place: {byte})"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {octets}), lambda a, b: xor(t[(xor(a, b) & 255) + 1], a >> 8)), 4294967295)"


def _sql_escapes(text: str) -> str:
    """How many escapes a text needs: backslashes, signs that start three signs, end marks."""
    signs = f"coalesce(list_sum(list_transform(regexp_extract_all({text}, '#{{3,}}'), lambda x: length(x) - 2)), 0)"
    return rf"length({text}) - length(replace({text}, '\', '')) + {signs} + (length({text}) - length(replace({text}, '</turn>', ''))) // 7"


ORACLES: dict[str, str] = {
    "op11_variants": f"""
WITH RECURSIVE {SQL_CRC_TABLE},
runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') || ':' AS k, translate(r, '{LETTERS}', '{LETTERS.lower()}') AS run, count(*) AS c
  FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]{{{variants.LEAST_LETTERS},}}')) AS r FROM documents)
  GROUP BY 1, 2),
hashed AS (SELECT run, c, {_sql_crc32("k || run")} AS h FROM runs, crc),
words AS (
  SELECT word, sum(c)::BIGINT AS n FROM (
    SELECT c, CASE WHEN h % {variants.DROP_EVERY} = 0
      THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed)
  WHERE length(word) >= {variants.LEAST_LETTERS} GROUP BY word HAVING sum(c) >= {variants.LEAST_COUNT}),
less AS (
  SELECT word, length(word) AS l, i, left(word, i - 1) || substr(word, i + 1) AS d
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (
  SELECT a.word AS x, b.word AS y FROM less a JOIN less b ON a.d = b.d AND a.i = b.i AND a.l = b.l AND a.word <> b.word
  UNION SELECT less.word, words.word FROM less JOIN words ON less.d = words.word
  UNION SELECT words.word, less.word FROM less JOIN words ON less.d = words.word),
near AS (
  SELECT x, count(*) AS n_near, arg_min(y, (-w.n, y)) AS best, max(w.n) AS best_n
  FROM pairs JOIN words w ON w.word = y GROUP BY x),
formed AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= {variants.FORM_FACTOR} * n THEN best END AS form,
    CASE WHEN best_n >= {variants.FORM_FACTOR} * n THEN best_n END AS form_n
  FROM words LEFT JOIN near ON x = word),
chain AS (
  SELECT word, word AS root FROM formed
  UNION ALL SELECT chain.word, f.form FROM chain JOIN formed f ON f.word = chain.root WHERE f.form IS NOT NULL)
SELECT formed.word, form, root, n, n_near, form_n
FROM formed JOIN chain ON chain.word = formed.word
WHERE NOT EXISTS (SELECT 1 FROM formed f WHERE f.word = root AND f.form IS NOT NULL)""",
    "op12_chat": rf"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT {TRICKY_ID}, turn, role, '{TRICKY_TEXT}' FROM (VALUES (0, 'user'), (1, 'assistant')) v(turn, role)),
sized AS (
  SELECT *, {sum(map(len, chat.CONTROL))} + length(role) + length(text) + {_sql_escapes("role")}
    + length(role) - length(replace(role, ':', '')) + {_sql_escapes("text")} AS chars,
    CASE WHEN role = '{chat.TRAINED_ROLE}' THEN text ELSE '' END AS trained
  FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  sum(length(trained))::BIGINT AS loss_chars,
  sha256(string_agg(trained, '' ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256, sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id""",
    "op13_prefix_trie": f"""
WITH {SQL_CRC_TABLE},
turns AS (
  SELECT conv_id AS c, turn, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k,
    octet_length(encode(coalesce(text, ''))) AS b
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT c, list(k ORDER BY turn NULLS FIRST, k) AS ks, list(b ORDER BY turn NULLS FIRST, k) AS bs,
    c - ((c % {prefix_trie.BASE_EVERY}) + {prefix_trie.BASE_EVERY}) % {prefix_trie.BASE_EVERY} AS base
  FROM turns GROUP BY c),
sized AS (SELECT own.*, {_sql_crc32("c::VARCHAR")} % {prefix_trie.HEAD_TURNS} AS h FROM own, crc),
rebuilt AS (
  SELECT s.c, list_concat(coalesce(o.ks, [])[1:h], s.ks[h + 1:]) AS ks, list_concat(coalesce(o.bs, [])[1:h], s.bs[h + 1:]) AS bs
  FROM sized s LEFT JOIN own o ON o.c = s.base),
starts AS (
  SELECT c, d, md5(array_to_string(ks[1:d], '')) AS node, CASE WHEN d > 0 THEN md5(array_to_string(ks[1:d - 1], '')) END AS parent,
    CASE WHEN d > 0 THEN bs[d] ELSE 0 END AS b, len(ks) = d AS last
  FROM (SELECT *, unnest(range(0, len(ks) + 1)) AS d FROM rebuilt)),
nodes AS (
  SELECT node, d, any_value(parent) AS parent, min(c) AS c, count(*) AS n, any_value(b) AS b,
    coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (last), '') AS ends
  FROM starts GROUP BY node, d),
kids AS (SELECT parent, count(*) AS k FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
below AS (
  SELECT s.node, sum(CASE WHEN kids.k IS NULL THEN 1 ELSE 0 END) AS leaves, sum((n.n - 1) * n.b) AS saved
  FROM nodes n JOIN starts s ON s.c = n.c AND s.d <= n.d LEFT JOIN kids ON kids.parent = n.node GROUP BY s.node)
SELECT n.c AS conv_id, n.d AS depth, p.c AS parent_conv_id, n.n AS n_convs, coalesce(k, 0) AS n_children,
  leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM nodes n JOIN below USING (node) LEFT JOIN nodes p ON p.node = n.parent LEFT JOIN kids ON kids.parent = n.node""",
    "op3_maxscore": f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda c: floor({maxscore.SCALE} * c::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, v.vec_id,
    list_sum(list_transform(list_zip(q.x, v.x), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v q JOIN v ON v.vec_id <> q.vec_id AND len(v.x) = len(q.x) WHERE q.vec_id % {SEARCH_EVERY} = 0)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM scored QUALIFY rank <= {SEARCH_K}""",
    "op5_decontamination": f"""
WITH d AS ({_sql_words("documents", "doc_id")}),
b AS ({_sql_words("benchmark", "item_id")}),
windows AS (
  SELECT DISTINCT id AS item, k, array_to_string(w[i:i + k - 1], ' ') AS g
  FROM (SELECT id, w, k, unnest(range(1, len(w) - k + 2)) AS i
    FROM (SELECT *, least({decontaminate.WINDOW}, len(w)) AS k FROM b WHERE len(w) > 0))),
places AS (
  SELECT id, k, i, array_to_string(w[i:i + k - 1], ' ') AS g
  FROM (SELECT id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM windows) WHERE len(w) >= k)),
hits AS (SELECT id, i, k, item FROM places JOIN windows USING (k, g)),
covered AS (
  SELECT id, count(*) AS n_hit FROM (SELECT DISTINCT id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY id),
named AS (
  SELECT id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT id, item::VARCHAR AS item FROM hits) GROUP BY id)
SELECT d.id AS doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND {decontaminate.COVERAGE} * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered ON covered.id = d.id LEFT JOIN named ON named.id = d.id""",
}
