"""Exact dedup, fill-in-middle and the prefix trie: cases and brute force."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortlab.llm import exact_dedup, fill_middle, prefix_trie, queries

sha = lambda s: hashlib.sha256(s.encode()).hexdigest()


def docs(spark, rows, extra=""):
    return spark.createDataFrame(rows, "doc_id long, text string" + extra)


# ---------------------------------------------------------------- op13

def copies(df, **kw):
    return sorted(map(tuple, exact_dedup.mark_copies(df, **kw).collect()), key=str)


def copies_plainly(rows):
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[t or ""].append(i)
    return sorted(((i, max((x for x in groups[t or ""] if x is not None), default=None), len(groups[t or ""]), sha(t or "")) for i, t, *_ in rows), key=str)


def test_copies_are_marked_with_the_largest_id(spark):
    rows = [(1, "a"), (5, "a"), (3, "a"), (2, "b"), (4, None), (6, ""), (7, "A"), (8, "a "), (None, "b"), (None, "c"), (9, "x" * 300_000), (10, "x" * 300_000)]
    got = copies(docs(spark, rows))
    assert [(a, b, c, e) for a, b, c, _, e in got] == copies_plainly(rows)
    assert {(a, e) for a, _, _, k, e in got if k} == {(5, sha("a")), (2, sha("b")), (6, sha("")), (7, sha("A")), (8, sha("a ")), (None, sha("c")), (10, sha("x" * 300_000))}


def test_one_of_repeated_rows_is_kept(spark):
    got = copies(docs(spark, [(1, "a")] * 4 + [(None, "n")] * 3))
    assert [sum(k for i, _, _, k, _ in got if i == x) for x in (1, None)] == [1, 1]
    assert {c for _, _, c, _, _ in got} == {4, 3}


def test_copies_of_empty_tables_and_clashing_names(spark):
    assert copies(docs(spark, [])) == []
    df = docs(spark, [(1, "a", 1, 2, 3), (2, "a", 4, 5, 6), (3, "b", 7, 8, 9)], ", sha int, n int, __block int")
    assert [r[:3] for r in copies(df)] == [(1, 2, 2), (2, 2, 2), (3, 3, 1)]
    assert sorted(map(tuple, exact_dedup.drop_copies(df).collect())) == [(2, "a", 4, 5, 6), (3, "b", 7, 8, 9)]


@pytest.mark.parametrize("blocks", [1, 64])
def test_copies_whatever_the_filter_holds(spark, blocks):
    # One text in a third of all rows, many pairs, and with one block of 32,768 cells a filter far too small.
    rows = [(i, "hot" if i % 3 == 0 else f"text {i // 4}" if i % 3 == 1 else f"own {i}") for i in range(60_000)]
    df = docs(spark, rows).repartition(8)
    got = copies(df, max_blocks=blocks)
    assert [(a, b, c, e) for a, b, c, _, e in got] == copies_plainly(rows)
    assert sum(r[3] for r in got) == len({t for _, t in rows})


def test_kept_rows_are_whole(spark):
    rows = [(1, "a", "x"), (4, "a", "y"), (4, "a", "y"), (4, "a", "z"), (2, None, "n"), (3, "", "e"), (None, "q", "r"), (None, "q", "r")]
    got = sorted(map(tuple, exact_dedup.drop_copies(docs(spark, rows, ", lang string")).collect()), key=str)
    assert len(got) == 3 and got[0] == (3, "", "e") and got[1][:2] == (4, "a") and got[2] == (None, "q", "r")
    assert exact_dedup.drop_copies(docs(spark, [])).count() == 0


def test_unrepeated_hashes_pass_the_filter(spark):
    rows = spark.range(20_000).select((F.col("id") % 19_000).alias("x")).select(F.xxhash64("x").alias("h"))
    blocks = exact_dedup.filter_blocks(20_000, 16, 1024)
    got = exact_dedup.may_repeat(rows, F.col("h"), exact_dedup.repeat_filter(rows, blocks), blocks, "r").groupBy("h").agg(F.count("*").alias("n"), F.max("r").alias("r")).collect()
    assert all(r["r"] for r in got if r["n"] > 1)  # no repeated hash is lost
    assert sum(r["r"] for r in got if r["n"] == 1) < 0.03 * 18_000


def test_copies_need_no_python(spark, sf):
    df = exact_dedup.mark_copies(spark.read.parquet(f"{sf}/documents.parquet"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|InArrow|MapPartitions", plan)
    text_scans = [x for x in plan.split("\n") if "FileScan" in x]
    assert not text_scans  # texts were read once, into the digests


# ---------------------------------------------------------------- op12

TOKEN = re.compile("[A-Za-z]+|[^A-Za-z]")
MARKS = ("<P>", "<S>", "<M>")


def middle_plainly(doc_id, text):
    text = text or ""
    toks = TOKEN.findall(text)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[8 * i:8 * i + 8], 16) for i in range(4)]
    n = len(toks)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in MARKS) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = "".join(toks[:a]), "".join(toks[a:b]), "".join(toks[b:])
    if h[3] % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def check_middle(spark, rows, extra=""):
    out = fill_middle.fill_in_middle(docs(spark, rows, extra))
    got = out.withColumn("back", fill_middle.restore(F.col("output"), F.col("form"))).collect()
    key = lambda r: str(r)
    assert sorted(((r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"], r["back"]) for r in got), key=key) == sorted(
        ((i, *middle_plainly(i, t), t or "") for i, t, *_ in rows), key=key)
    return got


def test_middle_cases(spark):
    rows = [(1, None), (2, ""), (3, "a"), (4, "ab cd"), (5, "é€😀 x"), (6, "has <P> inside"), (7, "x<S"), (8, "<M"), (9, "\n\n"), (None, "no id here"),
            (None, "no id here"), (10, "A" * 50_000), (11, "é" * 50_000), (12, "a1" * 40_000), (13, ">P><<S><"), (14, "\x00\x01 a")]
    check_middle(spark, rows + [(i, t) for i in range(100, 140) for t in ("one two <three", "P>", "word " * 3000 + "<")])


def test_middle_of_given_documents(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = check_middle(spark, rows)
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}


def test_middle_passes_other_columns_and_empty_tables(spark):
    got = check_middle(spark, [(1, "a b", 7, "k"), (2, None, None, None)], ", __draw0 int, lang string")
    assert {r["__draw0"] for r in got} == {7, None}
    assert fill_middle.fill_in_middle(docs(spark, [])).count() == 0
    clash = docs(spark, [(1, "a b", "old")], ", Form string")
    assert [c for c in fill_middle.fill_in_middle(clash).columns] == ["doc_id", "text", "n", "form", "prefix_chars", "middle_chars", "output"]


def test_middle_of_a_very_long_text(spark):
    rng = np.random.default_rng(3)
    text = "".join(rng.choice(["word ", "Ärger ", "x", "\n", "longer", "😀"], 1_500_000))
    check_middle(spark, [(i, text) for i in (21, 22)])


pieces = st.lists(st.sampled_from(["a", "Zz", " ", "é", "😀", "b" * 700, "<", ">", "\n", "word word ", "0"]), max_size=200).map("".join)


@settings(max_examples=150, deadline=None)
@given(pieces, st.integers(0, 10**6))
def test_counted_places_equal_the_tokens(text, draw):
    counted = fill_middle.Counted(text.encode(), fill_middle.Memo(3000))
    toks = TOKEN.findall(text)
    assert counted.n == len(toks)
    k = draw % (len(toks) + 1)
    head = "".join(toks[:k])
    assert counted.place(k) == (len(head.encode()), len(head))


def test_chunks_are_set_by_content():
    rng = np.random.default_rng(1)
    shared = bytes(rng.integers(97, 123, 60_000, dtype=np.uint8))

    def cut(data):
        ends = fill_middle.borders(data)
        return [data[a:b] for a, b in zip([0, *ends], ends)]

    one, two = cut(b"some head " + shared), cut(b"quite another head, longer than it " * 9 + shared)
    assert len(set(one) & set(two)) > 0.9 * len(one)
    assert b"".join(one) == b"some head " + shared and max(map(len, one)) <= fill_middle.MAX_CHUNK
    whole = fill_middle.borders(shared)
    old, fill_middle.STEP = fill_middle.STEP, 1000  # blocks of the hash don't show
    try:
        assert fill_middle.borders(shared) == whole
    finally:
        fill_middle.STEP = old


def test_memo_reads_a_chunk_once_and_stays_small(monkeypatch):
    calls = []
    monkeypatch.setattr(fill_middle, "summary", lambda c, f=fill_middle.summary: calls.append(c) or f(c))
    memo = fill_middle.Memo(10_000)
    for _ in range(3):
        memo.get(b"shared chunk")
    assert calls == [b"shared chunk"]
    for i in range(3000):
        memo.get(b"%d" % i * 20)
    assert sum(map(len, [*memo.young, *memo.old])) <= 10_000


# ---------------------------------------------------------------- op11

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rebuilt_plainly(turns):
    own = defaultdict(list)
    for c, t, r, x in turns:
        if c is not None:
            own[c].append((t is not None, t or 0, r or "", x or ""))
    own = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in own.items()}
    out = {}
    for c in own:
        h = (zlib.crc32(str(c).encode()) & 0xFFFFFFFF) % 4
        out[c] = own.get(c - c % 20, [])[:h] + own[c][h:]
    return out


def trie_plainly(convs):
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    kids = defaultdict(set)
    for p in members:
        if p:
            kids[p[:-1]].add(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids[p]) or 1
        saved[p] = sum(saved[k] for k in kids[p]) + ((len(members[p]) - 1) * len(WORD.findall(p[-1][1])) if p else 0)
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), len(kids[p]), leaves[p], saved[p],
                   sha(",".join(map(str, sorted(ends[p]))))) for p, m in members.items())


def nodes(df):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((*r[:2], -1 if r[2] is None else r[2], *r[3:]) for r in df.select(*names).collect())


def conversations(spark, rows, extra=""):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string" + extra)


def check_trie(spark, rows, few=64, extra=""):
    df = conversations(spark, rows, extra)
    cut = [r[:4] for r in rows]
    got = nodes(prefix_trie.trie_of(*prefix_trie.with_shared_heads(prefix_trie.numbered(df)), few=few))
    assert got == trie_plainly(rebuilt_plainly(cut))
    return got


@pytest.mark.parametrize("few", [0, 3])
def test_trie_cases(spark, few):
    rows = [(0, 0, "user", "hi there"), (0, 1, "assistant", "yes"), (0, 2, "user", "go on then"), (1, 0, "user", "hi there"), (1, 1, "assistant", "yes"),
            (2, None, "user", "first"), (2, 5, None, None), (2, 5, None, None), (3, 0, "user", "x"), (23, 0, "a", "b"), (23, 1, "", ""), (44, 0, "q", "r s"),
            (61, 3, "user", "only"), (None, 0, "user", "lost"), (7, 0, "ab", "c"), (8, 0, "a", "bc"), (40, 0, "ab", "c"), (41, 0, "a", "bc")]
    check_trie(spark, rows, few)
    # plain conversations, without shared heads
    df = conversations(spark, rows)
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, r or "", x or ""))
    assert nodes(prefix_trie.trie(df, few=few)) == trie_plainly({c: [(r, x) for *_, r, x in sorted(v)] for c, v in own.items()})


def test_trie_of_empty_and_single_tables(spark):
    assert nodes(prefix_trie.trie(conversations(spark, []))) == []
    got = check_trie(spark, [(1, 0, "user", "a")])
    assert got[0][1] == 0
    # 3 has h > 0 and no lender: turnless, a member of the root only
    lone = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 >= 1)
    assert check_trie(spark, [(lone, 0, "user", "a")]) == [(lone, 0, -1, 1, 0, 1, 0, sha(str(lone)))]


def test_trie_crosses_blocks_and_has_hot_conversations(spark):
    # 150 share 70 turns, 400 are equal, one is very long.
    long = [("user", f"turn {i}") for i in range(70)]
    convs = {20 * i + 1: long + [("assistant", f"own {i} {j}") for j in range(i % 4)] for i in range(150)}
    convs |= {20 * i + 3: long[:66] for i in range(200, 600)}
    convs |= {99_999: long[:50] + [("user", f"far {i}") for i in range(400)]}
    rows = [(c, i, r, x) for c, turns in convs.items() for i, (r, x) in enumerate(turns)]
    df = conversations(spark, rows)
    for few in (3, 64):
        assert nodes(prefix_trie.trie(df, few=few)) == trie_plainly(convs)


def test_trie_of_a_conversation_of_many_turns(spark):
    convs = {5: [("user", str(i)) for i in range(20_000)], 6: [("user", str(i)) for i in range(10_000)]}
    got = nodes(prefix_trie.trie(conversations(spark, [(c, i, *t) for c, v in convs.items() for i, t in enumerate(v)])))
    assert len(got) == 20_001 and got[0][:4] == (5, 0, -1, 2) and got[-1][1] == 20_000
    assert got[0][6] == 10_000 and got[10_000][5] == 1 and got[10_000][4] == 1


def test_trie_of_given_conversations(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert nodes(queries.QUERIES["op11_prefix_trie"](spark, sf)) == trie_plainly(rebuilt_plainly(rows))
    check_trie(spark, [(*r, 1, "x") for r in rows], 3, ", pos int, t1 string")


def test_levels_are_planned_within_bounds():
    alive = [100, 100, 90, 70, 60, 20, 20, 2, 1]
    plan = prefix_trie._plan(alive, 64)
    assert plan == [(8, 4), (3, 3), (2, 2), (1, 1)]
    assert prefix_trie._plan([5] * 200_001, 64)[0] == (200_000, 160_001)
    assert prefix_trie._plan([7], 64) == []
