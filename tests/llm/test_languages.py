"""Language identification: held-out accuracy, a plain version, mixtures, and odd tables."""

import math
import os
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from granary.llm import languages, queries

FOLDER = "/root/testdata/sf0.01"
SYLLABLES = {"aa": ["ka", "lo", "mi", "ra"], "bb": ["sch", "ein", "ung", "zu"], "cc": ["qué", "ñas", "lla", "dor"]}


def text(rng, lang, words):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.choice([1, 2, 3]))) for _ in range(words))


def learnt(rng):
    counts = {}
    for lang in SYLLABLES:
        counts[lang] = np.zeros(languages.BUCKETS)
        for _, buckets, n, _ in languages._counted([text(rng, lang, 200) for _ in range(40)]):
            counts[lang] += np.bincount(buckets, weights=n, minlength=languages.BUCKETS)
    return languages.model_of(counts)


def plain_buckets(value):
    """The bucket of each letter, one by one."""
    import unicodedata

    value, out, full = value.lower(), [], (1 << 64) - 1
    sym = [ord(c) if unicodedata.category(c)[0] in "LM" else 0 for c in f" {value} "]
    for i in range(1, len(sym) - 1):
        if sym[i]:
            x = sum(s * int(m) for s, m in zip(sym[i - 1 : i + 2], languages._MULTIPLIERS, strict=True)) & full
            for shift, times in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
                x = ((x ^ (x >> shift)) * times) & full
            out.append(x >> (64 - languages.BITS))
    return Counter(out)


def plain_prediction(model, value):
    n, names = plain_buckets(value), range(len(model.languages))
    p = {g: [float(x) for x in model.chances[g]] for g in n}
    size = sum(n.values())

    def fit(share, rounds):
        for _ in range(rounds):
            mixed = {g: sum(s * q for s, q in zip(share, p[g])) for g in n}
            share = [s * sum(n[g] * p[g][i] / mixed[g] for g in n) / size for i, s in enumerate(share)]
            share = [s / sum(share) for s in share]
        return share, sum(n[g] * math.log(sum(s * q for s, q in zip(share, p[g]))) for g in n)

    whole, _ = fit([1 / len(names) for _ in names], languages.ROUNDS)
    alone = [sum(n[g] * math.log(p[g][i]) for g in n) for i in names]
    best, value = [float(i == alone.index(max(alone))) for i in names], max(alone)
    order = sorted(names, key=lambda i: -whole[i])
    for k in range(2, len(names) + 1):
        start = [max(whole[i], 1e-9) if i in order[:k] else 0.0 for i in names]
        got, likely = fit([s / sum(start) for s in start], languages.SET_ROUNDS)
        likely -= languages.PENALTY * (k - 1) * math.log(size + 1)
        if likely <= value:
            break
        best, value = got, likely
    at = best.index(max(best))
    return model.languages[at], whole[at], {model.languages[i] for i in names if best[i] > 0}


def test_against_a_plain_version_and_part_by_part(monkeypatch):
    rng = random.Random(6)
    model = learnt(rng)
    texts = [text(rng, rng.choice("abc") * 2, rng.choice([1, 2, 5, 30, 300])) for _ in range(60)]
    texts += [text(rng, "aa", a) + ". " + text(rng, "bb", b) + "!\n" + text(rng, "cc", c) for a, b, c in ((30, 30, 0), (50, 10, 10), (200, 20, 0), (5, 5, 90))] + ["İİ x", "ét́"]
    got = model.predict(texts)
    for value, (lang, score, chosen) in zip(texts, got, strict=True):
        want = plain_prediction(model, value)
        assert (lang, {x for x, _ in chosen}) == (want[0], want[2]) and abs(score - want[1]) < 1e-9
    assert len({len(chosen) for _, _, chosen in got}) > 1
    monkeypatch.setattr(languages, "PART", 50)
    assert [(a, round(b, 9)) for a, b, _ in model.predict(texts)] == [(a, round(b, 9)) for a, b, _ in got]


def test_shares_of_a_mixture():
    rng = random.Random(3)
    model = learnt(rng)
    a, b = text(rng, "aa", 300), text(rng, "bb", 150)
    ((lang, score, chosen),) = model.predict([a + " " + b])
    part = sum(c.isalpha() for c in a) / sum(c.isalpha() for c in a + b)
    assert lang == ("aa" if part > 0.5 else "bb") and {x for x, _ in chosen} == {"aa", "bb"} and abs(dict(chosen)["aa"] - part) < 0.05


def test_odd_tables(spark):
    rng = random.Random(1)
    docs = [(i, text(rng, lang, 60), lang, "x") for i, lang in enumerate(rng.choices(list(SYLLABLES), k=90))]
    odd = [(200, None, "aa", "x"), (201, "", "aa", "x"), (202, "12 34 ́", "bb", "x"), (None, text(rng, "bb", 50), "zz", "x"), (203, text(rng, "cc", 20_000), None, "x"), (203, text(rng, "cc", 3), None, "x")]
    table = spark.createDataFrame(docs + odd, "doc_id long, text string, lang string, score string")
    model = languages.train(table, ~languages.held_out("doc_id"))
    assert model.languages == ["aa", "bb", "cc"]  # a row without an id isn't learnt from
    rows = languages.predicted(table, model, {"doc_id": F.col("doc_id"), "held_out": languages.held_out("doc_id")}).collect()
    assert len(rows) == len(docs) + len(odd)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(b"" if r["doc_id"] is None else str(r["doc_id"]).encode()) % 5 == 0)
        if r["doc_id"] is not None and r["doc_id"] < 90:
            assert r["lang_pred"] == docs[r["doc_id"]][2] and 0 < r["score"] <= 1
    assert {(r["lang_pred"], r["score"]) for r in rows if r["doc_id"] in (200, 201, 202)} == {("und", 0.0)}
    assert {r["lang_pred"] for r in rows if r["doc_id"] == 203} == {"cc"} and {r["lang_pred"] for r in rows if r["doc_id"] is None} == {"bb"}
    nothing = languages.train(table.where("false"), F.lit(True))
    assert not nothing.fitted and {r["lang_pred"] for r in languages.predicted(table, nothing, {"doc_id": F.col("doc_id")}).collect()} == {"und"}
    assert languages.predicted(table.where("false"), model, {"doc_id": F.col("doc_id")}).count() == 0


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_held_out_accuracy(spark):
    got = queries.op12_language_id(spark, FOLDER)
    truth = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang")
    rows = got.where("held_out").join(truth, "doc_id").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.98 * len(rows) and len(rows) > 100
