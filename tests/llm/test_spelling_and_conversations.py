"""Spelling variants and the repair of conversations: against plain versions, their SQL, and odd tables."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from granary.llm import conversations, queries, spelling

TURNS = "conv_id long, turn long, role string, text string"


def plain_near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain_variants(n, ratio=5):
    out = {}
    for w in n:
        near = [x for x in n if plain_near(w, x)]
        best = min(near, key=lambda x: (-n[x], x), default=None)
        form = best if best is not None and n[best] >= ratio * n[w] else None
        out[w] = (form, n[w], len(near), n[form] if form else None)
    rows = set()
    for w, (form, *rest) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        rows.add((w, form, root, *rest))
    return rows


def test_variants_of_random_words(spark):
    rng = random.Random(4)
    words = {"".join(rng.choice("abcéÉ×") for _ in range(rng.choice([6, 7, 8, 9]))) for _ in range(60)}
    for w in [*words]:
        for _ in range(4):
            i = rng.randrange(len(w))
            words.add(rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice("abß") + w[i:], w[:i] + rng.choice("abÿ") + w[i + 1 :], w[i:] + w[:i]]))
    n = {w: 5 * 6 ** rng.randrange(5) + rng.randrange(3) for w in words}
    got = spelling.variants(spark.createDataFrame(list(n.items()), "word string, n long")).collect()
    want = plain_variants(n)
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert sum(r[1] is not None and r[1] != r[2] for r in want) > 3  # longer ways to a root are among them


def test_words_are_counted_over_whole_texts(spark):
    rng = random.Random(1)
    runs = ["Alphabet", "aLPHABET", "ÀLPHABET", "short", "sixsix", "x" * 300, "dont", "nàïveté"]
    rows = [(i if i % 50 else None, rng.choice([" ", "1", "\n", "’", "_"]).join(rng.choices(runs, k=rng.choice([0, 3, 200])))) for i in range(400)] + [(1, None), (2, ""), (3, "é" * 100_000), (3, "é" * 100_000)]
    want = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            want[run if h % 199 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    got = spelling.words(spark.createDataFrame([(*r, "w") for r in rows], "doc_id long, text string, word string")).collect()
    assert {r["word"]: r["n"] for r in got} == {w: k for w, k in want.items() if len(w) >= 6 and k >= 5} and len(got) == len({r["word"] for r in got})
    assert spelling.variants(spelling.words(spark.createDataFrame([], "doc_id long, text string"))).count() == 0


def test_anagrams_do_not_meet_unless_they_may_be_near(spark):
    """All orders of eight letters: each pair of them is an anagram, none is near, and candidates stay few."""
    words = ["".join(p) for p in itertools.islice(itertools.permutations("abcdefgh"), 5000)]
    counted = spark.createDataFrame([(w, 5) for w in words], "word string, n long")
    assert spelling.near(counted).count() == 0
    groups = spelling.posts(counted).groupBy("key", "side", "half").count().agg({"count": "max"}).collect()[0][0]
    assert groups <= 120  # of 5000


def plain_repair(rows):
    """All edits of up to six turns, one after the other. rows: (fault, role, text)."""
    best = None
    for plan in itertools.product(*[[*itertools.product(range(3), "DKR")]] * len(rows), range(3)):
        ends = [*plan[:-1], (plan[-1], "")]
        if any(e == "K" and not r[:1] or e != "D" and f in (1, 2) for (_, e), (f, r, _) in zip(ends, rows)):
            continue
        cost, letters, turns, reads = 0, "", [], ""
        for (inserts, edit), (fault, role, text) in zip(ends, [*rows, (0, "", "")]):
            for _ in range(inserts):
                turns.append(("assistant" if reads[-1:] == "u" else "user", ""))
                reads += turns[-1][0][0]
            letters += "I" * inserts + edit
            cost += 3 * inserts + {"D": 4, "K": 0, "R": 3, "": 0}[edit] + 3 * (edit in ("K", "R") and fault == 3)
            if edit in ("K", "R"):
                turns.append((role if edit == "K" else "assistant" if reads[-1:] == "u" else "user", text))
                reads += turns[-1][0][:1]
        if re.fullmatch("(s?(ua)+)?", reads) and (best is None or (cost, letters) < best[:2]):
            best = (cost, letters, "\n".join(f"{r}:{t}" for r, t in turns))
    return best


def plain_rows(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = []
        for _, turn, role, text in [r for r in rows if r[0] == conv]:
            role, text = (" " if x is None else x for x in (role, text))
            h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
            text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
            turns += [(turn, "user" if h == 4 else role, text)] * {0: 0, 3: 2}.get(h, 1)
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
        faults = [1 if not re.search(r"[^\x20\x09-\x0D]", x) else 2 if any((p, q) == (r, x) for _, p, q in turns[:i]) else 3 if x.strip(" \t\n\v\f\r")[-1] not in ".!?" else 0 for i, (_, r, x) in enumerate(turns)]
        known = [t for t, _, _ in turns if t is not None]
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(turns))
        cost, audit, text = plain_repair([(f, r, x) for f, (_, r, x) in zip(faults, turns, strict=True)])
        out[conv] = (conv, max(known) - min(known) + 1 - len(set(known)) if known else 0, *(faults.count(k) for k in (1, 2, 3)), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


def random_rows(n, most):
    rng = random.Random(n)
    roles, texts = ["user", "assistant", "system", "user", "assistant", None, "", "tool"], [None, "", "a.", "b", "c!", "d? ", "e\n", "f.\t", " ", "?"]
    return [(None if c == 7 else c, None if rng.random() < 0.1 else rng.randint(0, 9), rng.choice(roles), rng.choice(texts)) for c in range(n) for _ in range(rng.randint(1, most))]


@pytest.mark.parametrize("block,gather", [(4096, 1 << 16), (2, 3)])
def test_repairs_against_all_edits(spark, block, gather):
    rows = random_rows(90, 3)
    want = plain_rows(rows)
    table = spark.createDataFrame([(*r, "x") for r in rows], f"{TURNS}, audit string")
    old = conversations.BLOCK, conversations.GATHER
    try:
        conversations.BLOCK, conversations.GATHER = block, gather
        got = conversations.repairs(conversations.damaged(table)).collect()
        assert {r[0]: tuple(r) for r in got} == want and len(got) == len(want)
        codes = np.frombuffer(np.random.default_rng(2).integers(0, 16, 90).astype(np.uint8).tobytes(), dtype=np.uint8).reshape(9, 10)
        cost, letters = conversations.solve(codes)
        conversations.BLOCK = 4096
        again, same = conversations.solve(codes)
        assert (cost == again).all() and (letters == same).all()
    finally:
        conversations.BLOCK, conversations.GATHER = old


def test_repairs_against_sql(spark, tmp_path):
    rows = random_rows(300, 9)
    spark.createDataFrame(rows, TURNS).write.parquet(str(tmp_path / "conversations.parquet"))
    got = queries.op13_conversation_repair(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    want = con.execute(f"select {', '.join(got.columns)} from ({queries.SQL['op13_conversation_repair']})").fetchall()
    key = lambda r: (r[0] is not None, r[0] or 0)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)


def test_repaired_turns_and_odd_conversations(spark):
    rows = random_rows(80, 9) + [(900, t, "system" if t == 0 else "user" if t % 2 else "assistant", f"{t}.") for t in range(9001)] + [(901, 3, "user", "same.")] * 500
    table = conversations.damaged(spark.createDataFrame(rows, TURNS))
    audited = conversations.audits(table)
    turns = conversations.repaired_turns(table, audited).collect()
    digests = {r["conv_id"]: r for r in conversations.repairs(table).collect()}
    for conv, r in digests.items():
        own = sorted((x for x in turns if x["conv_id"] == conv), key=lambda x: x["position"])
        assert re.fullmatch("(s?(ua)+)?", "".join(x["role"][:1] for x in own))
        assert "".join(x["edit"] for x in own) == r["audit"].replace("D", "")
        assert hashlib.sha256("\n".join(f"{x['role']}:{x['text']}" for x in own).encode()).hexdigest() == r["repaired_sha256"]
    assert digests[901]["duplicate"] >= 499 and len(digests[900]["audit"]) > 8500
    empty = conversations.repairs(conversations.damaged(spark.createDataFrame([], TURNS)))
    assert empty.count() == 0
    nothing = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    (row,) = conversations.repairs(conversations.damaged(spark.createDataFrame([(nothing, 0, "user", "x")], TURNS))).collect()
    assert tuple(row) == (nothing, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    (row,) = conversations.repairs(conversations.plain_rows(spark.createDataFrame([(None, None, None, None)], TURNS))).collect()
    assert tuple(row) == (None, 0, 1, 0, 0, 0, 4, "D", hashlib.sha256(b"").hexdigest())
