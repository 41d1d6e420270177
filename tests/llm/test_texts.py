"""Operators that look at one text at a time, against plain Python."""

import hashlib
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from coppice.llm import decontaminate, html_extract, licenses, pii, sentencepiece_bpe, toxicity
from coppice.llm import queries as Q
from coppice.llm.common import Cover

from .conftest import EDGES, TABLES

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def words(text):
    return WORDS.findall((text or "").translate(LOWER))


def texts_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


# --- personal data -----------------------------------------------------------


def luhn(number):
    digits = [int(d) for d in reversed(number)]
    return sum(d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(digits)) % 10 == 0


def plain_spans(text):
    """The contract's patterns as they stand, by the standard library."""
    found = [(*m.span(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append((*m.span(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[ -]", "", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((*m.span(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.findall("[0-9]", m[0])) <= 15:
            found.append((*m.span(), "phone"))
    return found


TRICKY = [
    "a@b.c_d@e.f x@@y.z @q.r s@t u@v..w .@x.y a@b.c.d.",
    "1.2.3.4.5.6.7.8 256.1.1.1 01.002.0003.4 1..2.3.4.5 9.9.9",
    "4111 1111 1111 1111 4111-1111-1111-1111 41111111111111110 1 2 3 4 5 6 7 8 9 0 1 2 3 4",
    "79927398713000 5 4111111111111111 12  4111111111111111-",
    "+1 (555) 555-0100 +12 +1 2345678901234567 ++49 30 1234567. +4930(12)34567-8)",
    "é@b.c a@é.c ١٢٣.1.1.1",
]


def test_base_spans_as_the_contract_says(tables):
    texts = TRICKY + [t for _, t in texts_of(tables("documents"))]
    rng = np.random.default_rng(5)
    texts += ["".join(rng.choice(list("a1@.+- ()9")) for _ in range(60)) for _ in range(4000)]
    for text in texts:
        assert sorted(pii.base_spans(text)) == sorted(plain_spans(text)), text


@pytest.mark.parametrize(
    ("text", "kind", "span"),
    [
        ("mail jane.doe [at] example [dot] com now", "email", "jane.doe [at] example [dot] com"),
        ("mail jane(at)example.com.", "email", "jane(at)example.com"),
        ("write to bob at mail dot example dot org please", "email", "bob at mail dot example dot org"),
        ("see errest.23 at mail3.example.com today", "email", "errest.23 at mail3.example.com"),
        ("jаne@exаmple.com", "email", "jаne@exаmple.com"),
        ("ja​ne@exam­ple.com", "email", "ja​ne@exam­ple.com"),
        ("ｊａｎｅ＠ｅｘａｍｐｌｅ．ｃｏｍ", "email", "ｊａｎｅ＠ｅｘａｍｐｌｅ．ｃｏｍ"),
        ("call plus one five five five five five five zero one zero zero now", "phone", "plus one five five five five five five zero one zero zero"),
        ("card four one one one 1111 one one one one 1 1 1 1 ok", "card", "four one one one 1111 one one one one 1 1 1 1"),
        ("host one nine two dot one six eight dot zero dot one up", "ip", "one nine two dot one six eight dot zero dot one"),
        ("mail bob_at_mail_dot_com now", "email", "bob_at_mail_dot_com"),
        ("mail bobATmailDOTexampleDOTcom now", "email", "bobATmailDOTexampleDOTcom"),
        ("mail bob @ mail . example . com now", "email", "bob @ mail . example . com"),
        ("card 4lll 1111 llll 1111 ok", "card", "4lll 1111 llll 1111"),
        ("call +1 (555) 555-O1OO now", "phone", "+1 (555) 555-O1OO"),
        ("host 10[.]0[.]0[.]1 up", "ip", "10[.]0[.]0[.]1"),
        ("host ١٩٢.١٦٨.٠.١ up", "ip", "١٩٢.١٦٨.٠.١"),
    ],
)
def test_disguises_map_back_to_the_source(text, kind, span):
    base = pii.base_spans(text)
    assert (text.index(span), text.index(span) + len(span), kind) in pii.added_spans(text, base)


def test_clean_texts_get_no_added_spans(tables):
    plain = ["They met at noon. One two three go.", "Look at that dot on the map at ten.", "visit us at example.com", "point [at] nothing"]
    for text in plain + [t for _, t in texts_of(tables("documents"))]:
        assert pii.added_spans(text, pii.base_spans(text)) == []


def test_pii_rows(edges, spark):
    found = pii.find(edges).collect()
    assert len(found) == len(EDGES) and all(r["spans"] == "" and r["base_sha256"] == sha("") for r in found)
    row = pii.find(spark.createDataFrame([(1, "x a@b.cd 1.2.3.4")], "doc_id long, text string")).first()
    assert row["spans"] == "email:2:8,ip:9:16" and (row["n_email"], row["n_ip"]) == (1, 1)
    assert pii.mask("x a@b.cd 1.2.3.4", pii.base_spans("x a@b.cd 1.2.3.4")) == "x <EMAIL> <IP>"


# --- sentencepiece -----------------------------------------------------------


def test_sentencepiece_equals_the_library(tables, edges):
    import public_tokenizers
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for docs in (tables("documents"), edges):
        texts = Counter((d, t or "") for d, t in texts_of(docs))
        want = Counter()
        for (d, t), n in texts.items():
            ids = library.encode(t)
            want[d, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))] += n
        assert Counter(tuple(r) for r in sentencepiece_bpe.digests(docs).collect()) == want
    coded = sentencepiece_bpe.encode(edges)
    decoded = coded.select("doc_id", "ids", sentencepiece_bpe.decode_column("ids").alias("t")).collect()
    assert all(r["t"] == library.decode(list(r["ids"])) for r in decoded)


def test_agenda_without_units_or_cache():
    import public_tokenizers

    pieces = sentencepiece_bpe.Pieces(public_tokenizers.path("piece_bpe_32k.model"))
    rng = np.random.default_rng(1)
    for _ in range(300):
        text = "".join(rng.choice(list("  aeinst\n.,é😀▁")) for _ in range(int(rng.integers(1, 40))))
        whole = pieces.encode_part("▁" + text.replace(" ", "▁"))
        assert whole == pieces.library.encode(text)
        assert sentencepiece_bpe.Units(pieces).encode(text)[0] == ",".join(map(str, whole))


# --- decontamination ---------------------------------------------------------


def brute_hits(text, items, window=13):
    found, hit, doc = set(), set(), words(text)
    for name, item in items:
        own = words(item)
        size = min(window, len(own))
        grams = {tuple(own[k : k + size]) for k in range(len(own) - size + 1)} if own else set()
        for k in range(len(doc) - size + 1):
            if grams and tuple(doc[k : k + size]) in grams:
                found.add(str(name))
                hit.update(range(k, k + size))
    return len(doc), len(hit), sorted(found)


def test_decontamination_by_brute_force(spark, tables):
    rng = np.random.default_rng(2)
    items = [(k, " ".join(rng.choice(["a", "b", "c"], int(rng.integers(0, 30))))) for k in range(12)]
    items += [(20, None), (21, ""), (22, "b a"), (3, "c c c c c"), (None, "a c a c a b")]
    rows = [(k, " ".join(rng.choice(["a", "b", "c", "Zz"], int(rng.integers(0, 90)), p=[0.35, 0.3, 0.3, 0.05]))) for k in range(60)]
    docs = spark.createDataFrame(rows + EDGES, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    named = [("" if k is None else k, t) for k, t in items]
    for shard_words in (200_000, 25):
        found = decontaminate.scan(docs, bench, shard_words=shard_words).collect()
        got = Counter((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in found)
        want = Counter((d, n, h, tuple(i)) for d, t in rows + EDGES for n, h, i in [brute_hits(t, named)])
        assert got == want
    none = decontaminate.scan(docs, bench.limit(0)).collect()
    assert not any(r["contaminated"] for r in none) and len(none) == len(rows) + len(EDGES)


def test_decontamination_query(spark, tables):
    items = [(r["item_id"], r["text"]) for r in tables("benchmark").collect()]
    got = {r["doc_id"]: tuple(r) for r in Q.op5_decontamination(spark, TABLES).collect()}
    assert sum(r[2] > 0 for r in got.values()) > 0
    for d, t in texts_of(tables("documents")):
        n, h, names = brute_hits(t, items)
        assert got[d] == (d, n, h, len(names), sha(",".join(names)), h > 0 and 20 * h >= n)


def test_cut_spans(spark):
    bench = spark.createDataFrame([(1, "a b c d")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "x, A (b) c-d! y " + "z " * 200), (2, "a b c d"), (3, "q")], "doc_id long, text string")
    cut = {r["doc_id"]: (r["text"], r["n_cut"]) for r in decontaminate.cut_spans(docs, bench, longest=3).collect()}
    assert cut[1] == ("x, ! y " + "z " * 200, 4) and cut[2] == ("", 4) and cut[3] == ("q", 0)
    assert decontaminate.cut_spans(docs, bench, longest=9).where("doc_id = 1").first()["n_cut"] == 0


# --- toxicity ----------------------------------------------------------------


def test_toxicity_on_the_held_out_fold(spark):
    folder = TABLES.replace("0.001", "0.1")
    scored = {r["doc_id"]: r for r in Q.op4_toxicity(spark, folder).collect()}
    pairs = []
    for r in spark.read.parquet(f"{folder}/labels.parquet").collect():
        if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0:
            assert scored[r["doc_id"]]["held_out"]
            pairs.append((r["toxic"], scored[r["doc_id"]]["predicted"]))
    right = sum(a == b for a, b in pairs) / len(pairs)
    clean = [b for a, b in pairs if not a]
    caught = [b for a, b in pairs if a]
    assert right > 0.97 and sum(clean) / len(clean) < 0.01 and sum(caught) / len(caught) > 0.8


def test_toxicity_edges(edges, spark):
    no_labels = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit(edges, no_labels)
    assert [r["score"] for r in toxicity.score(edges, model).collect()] == [0.5] * len(EDGES)
    labels = spark.createDataFrame([(4, 1), (5, 1), (8, 0), (9, 0), (2, 0), (None, 1), (3, None), (99, 1)], "doc_id long, toxic int")
    model = toxicity.fit(edges, labels)
    rows = toxicity.score(edges, model).collect()
    assert len(rows) == len(EDGES) and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (1, 2)}) == 1
    assert toxicity.reject(edges, model).columns == edges.columns
    together = model.scores(["idiot", "", "x" * 3000])
    assert np.allclose(together, [model.scores([t])[0] for t in ("idiot", "", "x" * 3000)])


# --- licenses ----------------------------------------------------------------


def test_license_base_by_brute_force(spark, tables):
    rng = np.random.default_rng(3)
    vocabulary = ["MIT", "license", "Apache", "general", "public", "gnu", "x", "."]
    rows = [(k, " ".join(rng.choice(vocabulary, int(rng.integers(0, 40))))) for k in range(200)]
    rows += EDGES + texts_of(tables("documents"))
    got = Counter(tuple(r)[:6] for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    want = Counter()
    for d, t in rows:
        own = words(t)
        places = [
            (k, label)
            for phrase, label in licenses.BASE
            for k in range(len(own))
            if own[k : k + len(phrase.split())] == phrase.split()
        ]
        starts = [k for k, _ in places]
        labels = ",".join(sorted({label for _, label in places}))
        want[d, len(own), len(starts), min(starts, default=None), max(starts, default=None), labels] += 1
    assert got == want


def test_license_rules():
    by_key = licenses.rules()
    assert sum(map(len, by_key.values())) > 300

    def found(text):
        own = [w.encode() for w in words(text)]
        return [(d.start, d.end, d.label) for d in licenses.detect(b" " + b" ".join(own) + b" ", by_key)]

    assert found("Released under the MIT License.") == [(0, 5, "mit")]
    assert found("SPDX-License-Identifier: Apache-2.0") == [(0, 6, "apache-2.0")]
    assert found("the GNU Lesser General Public License, version 2.1 or later") == [(1, 11, "lgpl-2.1")]
    assert found("plain words") == []
    assert [x[2] for x in found("Licensed under CC BY-NC 4.0. All rights reserved.")] == ["cc-by-nc", "proprietary"]


def forms_of(parsed):
    """All texts that a pattern without unbounded repeats matches."""
    out = {""}
    for op, value in parsed:
        match str(op):
            case "LITERAL":
                parts = {chr(value)}
            case "IN":
                parts = {chr(c) for kind, v in value for c in ([v] if str(kind) == "LITERAL" else range(v[0], v[1] + 1))}
            case "SUBPATTERN":
                parts = forms_of(value[-1])
            case "BRANCH":
                parts = set().union(*map(forms_of, value[1]))
            case "MAX_REPEAT":
                assert value[:2] == (0, 1)
                parts = {""} | forms_of(value[2])
        out = {a + b for a in out for b in parts}
    return out


def test_every_form_of_a_license_holds_a_keyword():
    by_key = licenses.rules()
    for label, keys, pattern in [*licenses.NAMES, *(s[:3] for s in licenses.SENTENCES)]:
        for form in forms_of(re._parser.parse(pattern)):
            assert any(key in form for key in keys.split("|")), (label, form)
    for name, label in (
        ("Expat license", "mit"),
        ("MS-PL", "ms-pl"),
        ("MS-RL", "ms-rl"),
        ("AFL-3.0", "afl-3.0"),
        ("BSL-1.0", "bsl-1.0"),
        ("BUSL-1.1", "busl-1.1"),
        ("Zero-Clause BSD", "0bsd"),
        ("BSD Zero Clause License", "0bsd"),
    ):
        for before in ("SPDX-License-Identifier: ", "licensed under the ", "released under ", "see the ", ""):
            line = " ".join(["", *words(before + name), ""]).encode()
            found = licenses.detect(line, by_key)
            assert [d.label for d in found] == [label], line
    found = licenses.detect(b" under the same terms as perl itself ", by_key)
    assert [d.label for d in found] == ["artistic-2.0"]


# --- pages -------------------------------------------------------------------


def test_main_text_of_all_pages(spark, tables):
    import html

    got = {r["page_id"]: r["text"] for r in Q.op2_html(spark, TABLES).collect()}
    for r in tables("pages").collect():
        body = re.search(r"<article>(.*?)(</article>|\Z)", r["html"], re.S)[1]
        body = re.sub(r"</?(p|h1|br)>", " ", body).replace("<b>", "").replace("</b>", "")
        assert got[r["page_id"]] == " ".join(html.unescape(body).split())


@pytest.mark.parametrize(
    "page",
    [
        "<html><body class='has-sidebar no-header'><p>{}</p></body></html>",
        "<html class='no-ads'><body class='sidebar' hidden><p>{}</p></body></html>",
        "<html><body><article class='post comments-open share'><p>{}</p></article></body></html>",
        "<html><body><div id='header-and-content'><p>{}</p></div></body></html>",
        "<html><body><p class=share-price>{}</p></body></html>",
        "<html><body><div class='widget content'><p>{}</p></div></body></html>",
        "<html><body><form action=x><div hidden><main role=main><p>{}</p></main></div></form></body></html>",
    ],
)
def test_names_drop_no_page(page):
    text = " ".join(f"word{k}" for k in range(200))
    assert html_extract.extract(page.format(text), html_extract.Weights()) == text


def test_weights_of_named_places_are_learnt(spark):
    page = "<body><div class=promo><p>{0} out of it</p></div><article><p>{0} before</p><p class=tags>{0} within</p></article></body>"
    pages = spark.createDataFrame([(k, page.format(f"text {k} " * 5)) for k in range(20)], "page_id long, html string")
    weights = html_extract.fit(pages)
    assert weights.learnt["word p.tags" + html_extract.NAMED] == 1 and weights.learnt["word p" + html_extract.NAMED] == -1
    for r in html_extract.main_texts(pages, weights).collect():
        own = ("text %d " % r["page_id"]) * 5
        assert r["text"] == f"{own}before {own}within"


def test_page_edges(spark):
    rows = [
        (1, None),
        (2, ""),
        (3, "no markup &amp; all  text"),
        (4, "<nav><a href=x>a b c</a></nav><div><p>One <b>t</b>wo<p>three &lt;four&gt; five six seven</div><footer>x y z</footer>"),
        (5, "<p>body text that is long enough to stay here</p><div class='comments'><p>first! so many words of a reader here</p></div>"),
        (6, "<p>before the script stands this</p><script>if (a<b) document.write('<p>no</p>')</script><p>and this after it"),
        (7, "<!-- <p>no</p> --><p>a < b and c > d</p"),
        (None, "<p>x y z</p>"),
        (None, "<p>x y z</p>"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, html string")
    weights = html_extract.fit(pages)
    got = [(r["page_id"], r["text"]) for r in html_extract.main_texts(pages, weights).collect()]
    assert Counter(got) == Counter(
        [
            (1, ""),
            (2, ""),
            (3, "no markup & all text"),
            (4, "One two three <four> five six seven"),
            (5, "body text that is long enough to stay here"),
            (6, "before the script stands this and this after it"),
            (7, "a < b and c > d"),
            (None, "x y z"),
            (None, "x y z"),
        ]
    )
    assert html_extract.best_run([-1, 2, -1, 2, -5, 3]) == (1, 4)
    assert html_extract.best_run([-1.0]) == (0, 0)


def numbered(n, name="word"):
    return " ".join(f"{name}{k}" for k in range(n))


A, B, ITEMS = numbered(60, "a"), numbered(60, "b"), [f"item{k}" for k in range(30)]
COMMENTS = "".join(f"<li><p>{numbered(90, 'c')}</p></li>" for _ in range(20))
MADE_PAGES = [
    (f"<article><p>{A}</p><div class='ad'>{numbered(12)}</div><p>{B}</p></article>", f"{A} {B}"),
    (f"<article><p>{A}</p><div class='notice'>{numbered(12)}</div><p>{B}</p></article>", f"{A} {B}"),
    (f"<body><div class='cookie-notice'>{numbered(30)}</div><article><p>{A}</p></article></body>", A),
    (f"<body><div>{A} {B}</div><ol class='comment-list'>{COMMENTS}</ol></body>", f"{A} {B}"),
    (f"<body><div class='sidebar'>{numbered(120)}</div><article><p>{A}</p></article></body>", A),
    (f"<body><div><p>{A}</p><p>{B}</p></div><div class='sidebar'><p>{numbered(110)}</p></div></body>", f"{A} {B}"),
    (f"<article><p>{A}</p><script>x</script><p>one two</p></article>", f"{A} one two"),
    (f"<body><p>{A}</p><aside>{numbered(30)}</aside><p>one two three four</p></body>", f"{A} one two three four"),
    (f"<article><p>{A}</p><aside>{numbered(30)}</aside><p>one</p></article>", f"{A} one"),
    (f"<article><h1>A title</h1><ul>{''.join(f'<li>{i}</li>' for i in ITEMS)}</ul></article>", " ".join(["A title", *ITEMS])),
    (f"<body><main><nav>menu x</nav><article><p>{A}</p></article><aside>x y</aside></main></body>", A),
    (f"<main><article><p>{A}</p></article><section id='comments'><article class='comment'>{B}</article><article class='comment'>{B}</article></section></main>", A),
    (f"<body><div class='widget'><p>{A}</p><div class='ad'>buy this now</div></div></body>", A),
]


@pytest.mark.parametrize("page, text", MADE_PAGES)
def test_made_pages(page, text):
    assert html_extract.extract(page, html_extract.Weights()) == text


def test_made_pages_with_learnt_weights(spark, tables):
    """Weights of the given pages; extra columns of other names don't matter."""
    rows = [(k, page) for k, (page, _) in enumerate(MADE_PAGES)]
    pages = spark.createDataFrame(rows, "page_id long, html string").withColumns({c: F.lit("x") for c in ("text", "n", "kind", "one", "id")})
    weights = html_extract.fit(tables("pages").withColumns({c: F.lit("x") for c in ("text", "n", "kind", "one", "id")}))
    got = {r["page_id"]: r["text"] for r in html_extract.main_texts(pages, weights).collect()}
    assert got == {k: text for k, (_, text) in enumerate(MADE_PAGES)}
    none = pages.limit(0)
    assert html_extract.main_texts(none, html_extract.fit(none)).collect() == []


def seconds_of(work, *arguments):
    start = time.process_time()
    work(*arguments)
    return time.process_time() - start


@pytest.mark.parametrize("unit", ["<div>x ", "<p class='ad'>x<span>y ", "</b><i>x "])
def test_pages_of_many_open_tags_take_linear_time(unit):
    weights = html_extract.Weights()
    once = min(seconds_of(html_extract.extract, unit * 25_000, weights) for _ in range(3))
    twice = min(seconds_of(html_extract.extract, unit * 50_000, weights) for _ in range(3))
    assert twice < 3 * once


def test_cover_by_all_pairs():
    rng = np.random.default_rng(2)
    for _ in range(200):
        cover, held = Cover(), []
        for start, size in rng.integers(0, 12, (30, 2)).tolist():
            end = start + size + 1
            inside = any(s <= start and end <= e for s, e in held)
            assert cover.contains(start, end) == inside
            cover.add(start, end)
            held.append((start, end))


def test_many_notices_and_addresses_take_linear_time():
    by_key = licenses.rules()

    def notices(n):
        line = b" " + b" ".join(licenses.words_of("Licensed under the Apache License, Version 2.0. mit license x " * n)) + b" "
        assert len(licenses.detect(line, by_key)) == 2 * n and len(licenses.base_places([], line)) == 2 * n

    def addresses(n):
        text = "write to jo (at) example (dot) com or " * n
        assert len(pii.added_spans(text, pii.base_spans(text))) == n

    for work in (notices, addresses):
        once = min(seconds_of(work, 10_000) for _ in range(3))
        assert min(seconds_of(work, 20_000) for _ in range(3)) < 3 * once


@pytest.mark.parametrize(
    "text, found",
    [
        ("write li at firma dot cn now", "li at firma dot cn"),
        ("ana at uni dot mx", "ana at uni dot mx"),
        ("mail j.doe at example dot co dot uk", "j.doe at example dot co dot uk"),
        ("ask tom at shop dot it.", "tom at shop dot it"),
        ("the meeting is at example dot com today", None),
        ("it is hosted at example dot org", None),
        ("she smiled at polka dot in red", None),
    ],
)
def test_spoken_addresses_end_by_rule(text, found):
    assert [text[s:e] for s, e, _ in pii.added_spans(text, pii.base_spans(text))] == ([found] if found else [])
