"""Operators that compare rows, against plain Python over all pairs."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from coppice.llm import decontaminate, idstore, licenses, maxscore, pii, repeats, sentencepiece_bpe, simhash, toxicity
from coppice.llm import queries as Q
from coppice.store import Store

from .conftest import CLASHING, EDGES, TABLES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def texts_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


# --- SimHash -----------------------------------------------------------------


def plain_print(text):
    own = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not own:
        return 0
    grams = [" ".join(own[k : k + 3]) for k in range(max(1, len(own) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, radius=3):
    """Smallest id reachable for (id, fingerprint) pairs, by comparing all."""
    ids = sorted({i for i, _ in prints if i is not None})
    up = {i: i for i in ids}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    known = [(i, p) for i, p in prints if i is not None]
    for a, pa in known:
        for b, pb in known:
            if (pa ^ pb).bit_count() <= radius:
                x, y = sorted((find(a), find(b)))
                up[y] = x
    return {i: find(i) for i in ids}


def check_simhash(docs, **options):
    rows = texts_of(docs)
    prints = [(d, plain_print(t)) for d, t in rows]
    comps = plain_components(prints)
    found = simhash.near_duplicates(docs, **options)
    got = Counter(tuple(r) for r in found.select("doc_id", simhash.hex_column("fp"), "component_id").collect())
    assert got == Counter((d, f"{p:016x}", comps.get(d)) for d, p in prints)
    return comps


def test_simhash_by_brute_force(tables, edges, frame):
    comps = check_simhash(tables("documents"))
    assert any(c != d for d, c in comps.items())
    check_simhash(edges)
    check_simhash(frame([]).limit(0))


def test_dense_shards_are_cut_again(spark):
    """Fingerprints around a few centres, so that most shards hold many; all branches by forced sizes."""
    rng = np.random.default_rng(7)
    values = {0, 2**64 - 1, 1 << 63}
    for centre in rng.integers(0, 2**63, 4, dtype=np.uint64).tolist():
        for _ in range(150):
            value = centre
            for bit in rng.choice(64, int(rng.integers(0, 8)), replace=False).tolist():
                value ^= 1 << bit
            values.add(value)
    pairs = list(enumerate(sorted(values)))
    want = plain_components(pairs)
    rows = spark.createDataFrame([(p - (p >> 63 << 64), i) for i, p in pairs], "fp long, rep long").repartition(5)
    for shard_rows in (4096, 8, 1):
        links = [tuple(r) for r in simhash.near_links(rows, shard_rows=shard_rows).collect()]
        up = dict(enumerate(range(len(pairs))))

        def find(i, up=up):
            while up[i] != i:
                i = up[i]
            return i

        for a, b in links:
            assert (pairs[a][1] ^ pairs[b][1]).bit_count() <= 3
            x, y = sorted((find(a), find(b)))
            up[y] = x
        assert {i: find(i) for i in up} == want


def test_keep_one_of_repeated_ids(spark):
    """An id may stand for several texts: each group of linked texts keeps one row, whatever ids it has."""
    base = ["alpha beta gamma delta " * 30, "one two three four five six " * 20, "red green blue white " * 25, "north south east west " * 25]
    rows = [(0, base[0], "a"), (1, base[0], "a"), (1, base[1], "a"), (2, base[2], "a"), (2, base[3], "a")]
    rows += [(5, base[1], "a"), (5, base[1], "a"), (2, base[2], "b"), (3, base[3] + "!", None), (3, None, base[3])]
    rows += [(None, base[0], "x"), (None, base[0], "x"), (7, "", "y"), (8, None, "z"), (7, "", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string").repartition(4)
    kept = [tuple(r) for r in simhash.keep_one(docs).collect()]
    assert Counter(kept) <= Counter(rows)
    known = [r for r in rows if r[0] is not None]
    up = list(range(len(known)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    prints = [plain_print(text) for _, text, _ in known]
    for i, a in enumerate(prints):
        for j, b in enumerate(prints[:i]):
            if (a ^ b).bit_count() <= simhash.RADIUS:
                up[find(i)] = find(j)
    groups = {}
    for i, row in enumerate(known):
        groups.setdefault(find(i), []).append(row)
    for group in groups.values():
        stays = [row for row in kept if row in group]
        assert len(stays) == 1 and stays[0][0] == min(row[0] for row in group)
    assert len(kept) == len(groups) + 2
    again = [tuple(r) for r in simhash.keep_one(docs.repartition(7, "text")).collect()]
    assert Counter(again) == Counter(kept)
    assert simhash.keep_one(docs.limit(0)).collect() == []


def test_keep_one(frame):
    docs = frame(EDGES)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    # 1, 2, 3 have no words; 4 (twice) and 5 are equal; the row without an id stays.
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter([1, 4, None, 6, 7, 8, 9])


# --- repeated strings --------------------------------------------------------


def plain_repeats(texts, length):
    raws = [(t or "").encode() for t in texts]
    starts = Counter(raw[k : k + length] for raw in raws for k in range(len(raw) - length + 1))
    out = []
    for raw in raws:
        gone = np.zeros(len(raw), bool)
        for k in range(len(raw) - length + 1):
            if starts[raw[k : k + length]] > 1:
                gone[k : k + length] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(np.int8)])) == 1).sum())
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone])
        out.append((len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def check_repeats(docs, length, **options):
    rows = texts_of(docs)
    found = repeats.remove_repeats(docs, length=length, **options).drop("kept")
    want = Counter((d, *w) for (d, _), w in zip(rows, plain_repeats([t for _, t in rows], length)))
    assert Counter(tuple(r) for r in found.collect()) == want
    return sum(w[2] for w in want)


def test_repeats_by_brute_force(spark, tables, edges):
    assert check_repeats(tables("documents"), 400) > 0
    check_repeats(edges, 40)
    rng = np.random.default_rng(11)
    base = "".join(rng.choice(list("abcdé "), 300))
    rows = [(k, base[: rng.integers(0, 300)]) for k in range(20)]
    for k in range(150):  # near copies with one edit each: many variants under one name
        at = int(rng.integers(0, 300))
        rows.append((100 + k, base[:at] + str(k) + base[at + 1 :]))
    rows += [(k, "ab" * int(rng.integers(0, 200))) for k in range(300, 310)]
    rows += [(k, "".join(rng.choice(list("ab"), 120))) for k in range(400, 420)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for length in (24, 60):
        for hot in (64, 1):
            assert check_repeats(docs, length, hot_segments=hot) > 0


def test_no_index_holds_all_variants_of_a_name(spark, monkeypatch):
    """A passage in other surroundings each time: its edges are one different segment a row under few second names."""
    rng = np.random.default_rng(12)
    passage = "".join(rng.choice(list("abcdef "), 90))
    rows = []
    for k in range(120):
        before, after = ("".join(rng.choice(list("uvwxyz "), int(rng.integers(60, 90)))) for _ in "ab")
        rows.append((k, before + passage + after))
    rows += [(k % 7, rows[k][1]) for k in range(3)] + [(200, rows[5][1][:-20]), (201, "pq" * 100), (202, "pq" * 70 + passage)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    most, marked = [], repeats._marked

    def measured(pieces, length):
        most.append(max((r["count"] for r in pieces.select("h", "s").distinct().groupBy("h").count().collect()), default=0))
        return marked(pieces, length)

    monkeypatch.setattr(repeats, "_marked", measured)
    assert check_repeats(docs, 60, hot_segments=8) > 0
    assert len(most) == 2 and max(most) <= 8


def plain_passages(rows, size):
    """Words of each row in runs of ``size`` words that a row of another id or text holds too."""
    cut = [re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode()) for _, t in rows]
    holders = {}
    for row, ws in zip(rows, cut):
        for k in range(len(ws) - size + 1):
            holders.setdefault(tuple(ws[k : k + size]), set()).add((row[0], row[1] or ""))
    out = []
    for (doc, _), ws in zip(rows, cut):
        hit = np.zeros(len(ws), bool)
        for k in range(len(ws) - size + 1):
            if len(holders[tuple(ws[k : k + size])]) > 1:
                hit[k : k + size] = True
        out.append((doc, int(hit.sum())))
    return Counter(out)


def test_passages_by_brute_force(spark, tables, edges):
    rng = np.random.default_rng(21)
    some = lambda n, of=40: " ".join(f"w{k}" for k in rng.integers(0, of, n))
    base = some(300)
    rows = [(k, f"{some(int(rng.integers(0, 60)), 900)} {' '.join(base.split()[k : k + 30])}\n{some(9, 900)}") for k in range(60)]
    rows += [(100 + k, base.replace(f"w{k} ", f"é{k}\t ")) for k in range(40)]
    rows += [(150, base), (151, base), (151, base), (None, base), (152, "and " * 90), (153, "one line again " * 50), (154, "x" * 300_000 + " " + base)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for frame, size in ((docs, 12), (edges, 3), (tables("documents"), 51)):
        found = repeats.remove_repeats(frame, passage_words=size).select("doc_id", "n_passage_words")
        assert Counter(tuple(r) for r in found.collect()) == plain_passages(texts_of(frame), size)
    # Windows across the ends of stretches.
    keyed = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("a"), F.lit(0).cast("long").alias("b"), F.encode("text", "UTF-8").alias("piece"))
    counted = repeats.shared_passages(keyed.drop("doc_id"), 3, stretch=50)
    found = keyed.join(counted, ["a", "b"], "left").select("doc_id", F.coalesce("n_passage_words", F.lit(0)))
    assert Counter(tuple(r) for r in found.collect()) == plain_passages(texts_of(docs), 3)


def test_passages_shorter_than_a_removal_are_seen(spark, tmp_path):
    """The query tells rows that share over 50 words of less than 400 bytes; 50 words are no such passage."""
    rng = np.random.default_rng(22)
    some = lambda n: " ".join("".join(rng.choice(list("abcdefgh"), 5)) for _ in range(n))
    long, short = some(51), some(50)
    rows = [(k, f"{some(40)} {long} {some(60)}") for k in range(3)] + [(k, f"{some(30)} {short} {some(20)}") for k in range(3, 6)]
    rows += [(6, None), (7, some(200)), (8, long + " " + long)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {r["doc_id"]: (r["n_removed"], r["n_passage_words"]) for r in Q.op8_repeats(spark, str(tmp_path)).collect()}
    assert found == {k: (0, 51 if k < 3 else 102 if k == 8 else 0) for k in range(9)}


def test_run_length_index():
    rng = np.random.default_rng(4)
    for size, letters in ((1, 1), (5, 1), (200, 1), (300, 2), (300, 4), (64, 3)):
        text = rng.integers(97, 97 + letters, size).astype(np.uint8)
        raw = bytes(text)
        index = repeats.RunLengthIndex(text)
        assert index.lengths.sum() == size and len(index.letters) == len(index.lengths)
        got = index.matching_statistics()
        for k in range(size):
            best = 0
            for j in range(size):
                n = 0
                while j != k and max(k, j) + n < size and raw[k + n] == raw[j + n]:
                    n += 1
                best = max(best, n)
            assert got[k] == best


# --- search ------------------------------------------------------------------


def plain_top(vectors, queries, k):
    out = []
    for q, x in queries:
        scores = sorted((-int(np.dot(x, y)), v) for v, y in vectors if v != q and len(y) == len(x))
        out += [(q, r + 1, v, -s) for r, (s, v) in enumerate(scores[:k])]
    return sorted(out)


def usable(rows):
    return [
        (i, [int(np.floor(256 * float(c))) for c in x])
        for i, x in rows
        if i is not None and x and all(c is not None and np.isfinite(c) for c in x)
    ]


def test_search_query(spark, tables):
    rows = usable([(r["vec_id"], r["embedding"]) for r in tables("embeddings").collect()])
    want = plain_top(rows, [r for r in rows if r[0] % 50 == 0], 5)
    assert sorted(tuple(r) for r in Q.op3_maxscore(spark, TABLES).collect()) == want


def test_search_edges(spark):
    rng = np.random.default_rng(8)
    rows = [(k, [float(c) for c in rng.integers(-2, 3, 6) / 4]) for k in range(300)]
    rows += [(k, [0.5] * 6) for k in range(300, 400)]  # a common vector
    rows += [(500, None), (501, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (502, [float("nan")] * 6), (503, [float("inf")] * 6)]
    rows += [(504, []), (505, [1.0, 2.0]), (506, [2.0, 1.0]), (None, [0.5] * 6), (7, rows[7][1])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    vectors = maxscore.integer_vectors(table)
    own = sorted({(i, tuple(x)) for i, x in usable(rows)})
    queries = [r for r in own if r[0] % 9 == 0 or r[0] > 500]
    asked = vectors.where("id % 9 = 0 or id > 500")
    for k, shard_rows, block_rows in ((5, 8192, 512), (3, 40, 7), (1000, 100, 512)):
        found = maxscore.top_k(vectors, asked, k, shard_rows, block_rows).collect()
        assert sorted(tuple(r) for r in found) == plain_top(own, queries, k)
    assert maxscore.top_k(vectors.limit(0), vectors.limit(0), 5).collect() == []


def test_search_sends_no_shard_again_for_a_block(spark, monkeypatch):
    """Rows to the workers are single vectors, and a shard's vectors are sent once however many blocks of queries there are."""
    frame, sent = type(spark.range(0)), []
    run = frame.mapInArrow

    def seen(self, *args, **kwargs):
        sent.append(self)
        return run(self, *args, **kwargs)

    monkeypatch.setattr(frame, "mapInArrow", seen)
    rng = np.random.default_rng(9)
    vectors = spark.createDataFrame([(k, rng.integers(-9, 9, 8).tolist()) for k in range(200)], "id long, x array<bigint>")
    found = maxscore.top_k(vectors, vectors.where("id % 2 = 0"), 3, shard_rows=50, block_rows=4).collect()
    assert len(found) == 300
    (rows,) = sent
    size = sum(F.length(c) if t == "binary" else 8 * F.size(c) if t.startswith("array") else F.lit(8) for c, t in rows.dtypes)
    facts = rows.agg(F.max(size).alias("most"), F.sum(size).alias("all")).first()
    assert facts["most"] <= 8 * (8 + len(rows.columns))
    assert facts["all"] <= (200 + 4 * 100) * facts["most"]


# --- id store ----------------------------------------------------------------


def library_ids(texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    return [c.ids + [0] for c in tokenizer.encode_batch(texts, add_special_tokens=False)]


SPACES = [" lead", "trail ", "a  b", "a \n b", "\x1c x", "a  b c", "it's we'll 's x", "　 x y", "a\nb c", "a\x00b \x00c"]


def test_ids_read_back(spark, tables, edges, frame):
    for docs in (tables("documents"), edges, frame(list(enumerate(SPACES))), frame([]).limit(0)):
        rows = sorted(((d, t or "") for d, t in texts_of(docs)), key=lambda r: (r[0] is not None, r[0] or 0))
        want, start = [], 0
        for (d, _), ids in zip(rows, library_ids([t for _, t in rows])):
            want.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            start += len(ids)
        for size in (4096, 7):
            got = idstore.write_and_read(docs, Store(spark, "ids"), docs_per_shard=size).collect()
            assert Counter(tuple(r) for r in got) == Counter(want)


def test_added_tokens_get_their_own_ids(spark, frame):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    mark = library.id_to_token(50256)
    texts = [f"one {mark} two", mark, f"a{mark}b {mark}\n{mark}", "no mark <| endoftext |> here", f"{mark[:-1]} x"]
    want = [c.ids + [0] for c in library.encode_batch(texts, add_special_tokens=False)]
    assert [50256 in ids for ids in want] == [True, True, True, False, False]
    got = idstore.write_and_read(frame(list(enumerate(texts))), Store(spark, "ids")).collect()
    assert {r["doc_id"]: r["ids_crc32"] for r in got} == {k: zlib.crc32(np.array(ids, "<u4").tobytes()) for k, ids in enumerate(want)}


def test_keyed_access(spark, tables):
    docs = tables("documents")
    store = Store(spark, "ids")
    manifest = store.keep(idstore.write_ids(docs, store.path("ids"), docs_per_shard=30), "manifest")
    keys = spark.createDataFrame([(k,) for k in [0, 5, 77, 199, 200, -1, None, 5]], "doc_id long")
    got = {r["doc_id"]: list(r["ids"]) for r in idstore.lookup(keys, manifest).collect()}
    texts = dict(texts_of(docs))
    assert got == dict(zip((0, 5, 77, 199), library_ids([texts[k] for k in (0, 5, 77, 199)])))
    shard = idstore.open_shard(spark, manifest, 77)
    assert shard.get(77).tolist() == got[77] and shard.get(10**9) is None


def test_minimal_perfect_hash():
    rng = np.random.default_rng(6)
    for n in (0, 1, 2, 3, 10, 1000, 5000):
        keys = list({int(k) for k in rng.integers(-(2**62), 2**62, n)})
        hashed = idstore.PerfectHash.of(keys)
        assert sorted(hashed.slot(k) for k in keys) == list(range(len(keys)))


# --- pipeline ----------------------------------------------------------------


def test_pipeline_by_its_parts(spark, tables):
    """Every stage's rows are those that plain Python keeps of the stage before."""
    docs = tables("documents")
    result = {r["doc_id"]: r for r in corpus_pipeline.run(spark, TABLES).collect()}
    model = toxicity.fit(docs, tables("labels").where(~Q.held_out()))
    rows = texts_of(docs)
    rows = [row for row, s in zip(rows, model.scores([t for _, t in rows])) if s < 0.5]
    comps = plain_components([(d, plain_print(t)) for d, t in rows])
    rows = [(d, t) for d, t in rows if comps[d] == d]
    from .test_texts import brute_hits

    items = [(r["item_id"], r["text"]) for r in tables("benchmark").collect()]
    hits = {d: brute_hits(t, items) for d, t in rows}
    rows = [(d, t) for d, t in rows if not (hits[d][1] > 0 and 20 * hits[d][1] >= hits[d][0])]
    assert sorted(result) == sorted(d for d, _ in rows) and len(rows) < docs.count()
    import public_tokenizers
    import sentencepiece

    from coppice.llm import pii

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for d, t in rows:
        assert list(result[d]["ids"]) == library.encode(pii.mask(t, pii.base_spans(t)))


def test_pipeline_edges(spark, edges, tmp_path):
    """Nulls, empty and long texts and clashing columns pass through every stage."""
    docs = edges.withColumnsRenamed({"y": "lang", "rep": "source"}).selectExpr("*", "cast(length(text) as long) as n_chars")
    for name, rows, schema in (
        ("labels", [(4, 1), (8, 0), (None, 1)], "doc_id long, quality int, toxic int"),
        ("benchmark", [(1, None), (2, "")], "item_id long, text string"),
    ):
        table = spark.createDataFrame([(r[0], 1, r[1]) if name == "labels" else r for r in rows], schema)
        table.write.parquet(f"{tmp_path}/{name}.parquet")
    store = Store(spark, "stages")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        columns = docs.columns
        docs = store.keep(stage(spark, docs, str(tmp_path)), name)
        assert docs.columns == columns
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == docs.count()
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash", "decontamination", "pii", "sentencepiece"]


# --- empty tables --------------------------------------------------------------


def test_empty_tables_and_clashing_columns(spark, frame, tables):
    """No documents give no rows, for every operator on documents; all take extra columns of their own inner names."""
    none = frame([]).limit(0)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([], "item_id long, text string")
    model = toxicity.fit(none, labels)
    assert pii.find(none).collect() == []
    assert toxicity.score(none, model).collect() == []
    assert decontaminate.scan(none, items).collect() == []
    assert simhash.near_duplicates(none).collect() == []
    assert licenses.scan(none).collect() == []
    assert repeats.remove_repeats(none).collect() == []
    assert idstore.write_and_read(none, Store(spark, "none")).collect() == []
    assert sentencepiece_bpe.digests(none).collect() == []
    vectors = tables("embeddings").limit(20).withColumns({c: F.lit("x") for c in CLASHING})
    kept = maxscore.integer_vectors(vectors)
    assert maxscore.top_k(kept, kept, 2).count() == 40
    assert maxscore.top_k(kept.limit(0), kept.limit(0), 2).collect() == []
