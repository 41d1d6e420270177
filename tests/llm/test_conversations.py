"""Operators on conversations and words, against plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from coppice.llm import chat, prefix_trie, variants
from coppice.llm import queries as Q
from coppice.store import Store

from .conftest import TABLES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
CONVERSATION = "conv_id long, turn long, role string, text string"
CONTROL_PARTS = ["#", "##", "###", "<", "</turn>", "</turn>\n", "/turn>", "\\", ": ", ":", " ", "\n", "a", "é", "<|endoftext|>", "😀"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def by_conversation(rows):
    """Turns in order; null turns first, null role or text empty."""
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        found[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(r, t) for _, _, r, t in sorted(turns)] for c, turns in found.items()}


# --- spelling variants ---------------------------------------------------------


def plain_variants(rows):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    near = {w: set() for w in words}
    for x in words:
        for y in words:
            if x != y and one_edit(x, y):
                near[x].add(y)
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 10 * n else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return Counter((w, n, len(near[w]), form[w], words[form[w]] if form[w] else None, root(w)) for w, n in words.items())


def one_edit(x, y):
    if len(x) > len(y):
        x, y = y, x
    if len(y) - len(x) > 1:
        return False
    k = next((i for i in range(len(x)) if x[i] != y[i]), len(x))
    return x[k + 1 :] == y[k + 1 :] if len(x) == len(y) else x[k:] == y[k + 1 :]


def found_variants(spark, docs, **options):
    found = variants.group_variants(docs, Store(spark, "test"), **options)
    return Counter(tuple(r) for r in found.select("word", "n", "n_near", "form", "form_n", "root").collect())


@pytest.mark.parametrize("key_rows", [variants.KEY_ROWS, 1])
def test_variants_by_all_pairs(spark, frame, key_rows):
    """Words of few letters so that many are near; with one row to a key every key is cut to the end."""
    rng = random.Random(3)
    words = ["".join(rng.choice("abé") for _ in range(rng.randrange(6, 10))) for _ in range(400)]
    words += ["anteroom"] * 300 + ["anterooms"] * 20 + ["anteroms", "anteroms", "Anteroom's", "anteroomß", "anteroomß"]
    rows = [(k % 7, " ".join(rng.choices(words, k=40))) for k in range(60)] + [(None, "Anteroom, ANTEROOM; ÀNTEROOM àNTEROOM"), (1, None), (2, "")]
    rows += [(9, "x" * 300 + " " + "x" * 300 + " " + "x" * 301 + " " + "x" * 301)]
    docs = frame(rows)
    got, wanted = found_variants(spark, docs, key_rows=key_rows), plain_variants(rows)
    assert got == wanted
    assert any(form for _, _, _, form, _, _ in got)


def test_variants_follow_chains_of_forms(spark, frame):
    rows = [(0, "aaaaaaa " * 2 + "aaaaaab " * 25 + "aaaaabb " * 300 + "aaaabbb " * 3_001)]
    got = {w: (form, root) for w, _, _, form, _, root in found_variants(spark, frame(rows))}
    wanted = {w: (form, root) for w, _, _, form, _, root in plain_variants(rows)}
    assert got == wanted
    assert got["aaaaaaa"] == ("aaaaaab", "aaaabbb")


def test_variants_of_the_table_and_of_none(spark, frame, tables):
    docs = tables("documents")
    assert found_variants(spark, docs) == plain_variants([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert not found_variants(spark, frame([]).limit(0))


# --- chat formatting -------------------------------------------------------------

control_text = st.lists(st.sampled_from(CONTROL_PARTS), max_size=8).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(control_text, control_text), max_size=4))
def test_rendered_text_gives_the_turns_back(turns):
    assert chat.parse(chat.render(turns)) == turns


def check_chat(spark, rows, conversations, piece_ids):
    pieces = Store(spark, "test").keep(chat.assemble(chat.encode_turns(conversations), piece_ids), "pieces")
    got = Counter(tuple(r) for r in chat.read_back(pieces).collect())
    wanted = Counter()
    for conv, turns in by_conversation(rows).items():
        trained = "".join(t for r, t in turns if r == "assistant")
        wanted[conv, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(trained), sha(trained), len(chat.render(turns))] += 1
    assert got == wanted
    return pieces


def tricky_rows():
    rng = random.Random(4)
    rows = [(c, t, rng.choice(["user", "assistant", "as: sistant", ""]), "".join(rng.choices(CONTROL_PARTS, k=rng.randrange(9)))) for c in range(40) for t in range(rng.randrange(1, 9))]
    rows += [(50, None, None, None), (50, 1, "assistant", None), (50, 2, "assistant", "a"), (50, 3, "assistant", "b"), (None, 0, "user", "x"), (None, 1, "assistant", "y")]
    return rows + [(51, 0, "assistant", "word " * 40_000), (52, 0, "user", "again"), (52, 0, "user", "again")]


@pytest.mark.parametrize("piece_ids", [chat.PIECE_IDS, 8])
def test_chat_by_plain_python(spark, frame, piece_ids):
    rows = tricky_rows()
    check_chat(spark, rows, frame(rows, CONVERSATION), piece_ids)


def test_chat_pieces(spark, frame):
    """Places run on over the pieces of a conversation, ids and mask have one length, reserved ids are where the turns are."""
    rows = [(c, t, ("user", "assistant")[t % 2], f"text {t} </turn>") for c in range(3) for t in range(50)]
    pieces = check_chat(spark, rows, frame(rows, CONVERSATION), 64).orderBy("conv_id", "piece").collect()
    at = Counter()
    codec = chat._codec(chat._tokenizer_file(None))
    for row in pieces:
        assert row["first"] == at[row["conv_id"]]
        assert len(row["ids"]) == len(row["loss"])
        at[row["conv_id"]] += len(row["ids"])
        assert row["ids"].count(codec.head) == row["ids"].count(codec.separator) == row["ids"].count(codec.end) > 0
    assert len(pieces) > 3


def test_chat_of_nothing(spark, frame):
    check_chat(spark, [], frame([], CONVERSATION).limit(0), 10)


def test_chat_query_adds_the_tricky_conversation(spark):
    found = {r["conv_id"]: r for r in Q.op12_chat(spark, TABLES).collect()}
    text = r"\### Assistant: </turn> ok"
    assert found[-7]["turns_sha256"] == sha(f"user\n{text}\nassistant\n{text}\n")
    assert found[-7]["loss_sha256"] == sha(text)


# --- prefix trie -----------------------------------------------------------------


def plain_trie(rows):
    own = by_conversation(r for r in rows if r[0] is not None)
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    members, kids = defaultdict(list), defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=lambda k: -len(k)):
        leaves[node] = sum(leaves[k] for k in kids[node]) or 1
        own_bytes = len(node[-1][1].encode()) if node else 0
        saved[node] = sum(saved[k] for k in kids[node]) + (len(members[node]) - 1) * own_bytes
    found = Counter()
    for node, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(rebuilt[c]) == len(node))))
        parent = min(members[node[:-1]]) if node else None
        found[min(m), len(node), parent, len(m), len(kids[node]), leaves[node], saved[node], sha(ends)] += 1
    return found


def found_trie(spark, conversations):
    found = prefix_trie.prefix_trie(conversations, Store(spark, "test"))
    names = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return Counter(tuple(r) for r in found.select(*names).collect())


@pytest.fixture
def parts(spark):
    """Sets the number of range partitions, so that nodes cross their borders."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}

    def use(n):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        spark.conf.set("spark.sql.adaptive.enabled", "false")

    yield use
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("n", [1, 3, 30])
def test_trie_by_plain_python(spark, frame, parts, n):
    parts(n)
    rng = random.Random(n)
    rows = [(c, t, rng.choice(["u", "a", None]), rng.choice(["x", "yé", None])) for c in range(-12, 60) for t in range(rng.choice([1, 2, 3, 9, 14]))]
    rows += [(70, None, "u", "x"), (71, None, "u", "x"), (71, 0, "u", "x"), (None, 0, "u", "x")]
    rows += [(c, t, "u", "same") for c in range(100, 160) for t in range(12)]  # copies of one conversation over several partitions
    rows += [(200, t, "u", "long") for t in range(700)] + [(205, t, "u", "long") for t in range(690)]
    assert found_trie(spark, frame(rows, CONVERSATION)) == plain_trie(rows)


def test_trie_of_the_table_and_of_none(spark, frame, tables):
    conversations = tables("conversations")
    rows = [tuple(r) for r in conversations.select("conv_id", "turn", "role", "text").collect()]
    assert found_trie(spark, conversations) == plain_trie(rows)
    assert not found_trie(spark, frame([], CONVERSATION).limit(0))
    turnless = [(5, 0, "u", "x"), (6, 0, "u", "x")]  # six takes up to eight turns of five
    assert found_trie(spark, frame(turnless, CONVERSATION)) == plain_trie(turnless)


def test_trie_pieces_of_long_lists(spark, frame, parts, monkeypatch):
    """The list of members of an open node comes in several pieces of a partition."""
    monkeypatch.setattr(prefix_trie, "PIECE_IDS", 3)
    parts(4)
    rows = [(c, t, "u", "same") for c in range(60) for t in range(3)]
    assert found_trie(spark, frame(rows, CONVERSATION)) == plain_trie(rows)
