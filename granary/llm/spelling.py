"""Spelling variants: anagram hashing.

A word's key is the sum of the fifth powers of its letters' code points, whatever their order. Words that differ by one
added or removed letter have keys that differ by that letter's value, and words that differ by one exchanged letter have
keys that differ by the difference of two values. So each word is posted under its own key and under its key less each
of its letters, and words that meet under one key, less different letters, are candidates: what is left of both has the
same letters. What is left also has to be the same either before or behind its middle, as one changed place leaves one
half alone; that is part of the key, so that anagrams that differ all over never meet. Candidates are then compared
letter by letter. A word of n letters is posted twice (n + 1) times at most, for its distinct letters only, and no group
holds a word more than twice, however frequent it is: occurrences are counted before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm import common

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Keys are sums modulo this prime, so that words of any length have one.
_MODULUS = (1 << 61) - 1


def words(docs: DataFrame, shortest: int = 6, least: int = 5, delete_every: int | None = 199) -> DataFrame:
    """(word, n): the runs of letters of all whole texts with ``shortest`` or more code points and ``least`` or more occurrences.

    A to Z are lower-cased, other letters are those from U+00C0 to U+00FF as they are. If ``delete_every`` divides the
    unsigned crc32 of ``<doc_id>:<run>``, the run loses the code point at crc32 modulo length. Null texts have no runs; a
    null doc_id is written as nothing; equal rows count each.
    """
    # Shorter runs can only become shorter, and a run that is long enough is matched from its start to its end.
    pattern = f"[a-z\\u00C0-\\u00FF]{{{shortest},}}"
    lowered = F.translate(F.col("text").cast("string"), UPPER, LOWER)
    run = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), F.explode(F.regexp_extract_all(lowered, F.lit(pattern), F.lit(0))).alias("run"))
    word = F.col("run")
    if delete_every:
        run = run.withColumn("h", F.crc32(F.concat("doc", F.lit(":"), "run").cast("binary")))
        at = (F.col("h") % F.length("run")).cast("int")
        word = F.when(F.col("h") % delete_every == 0, F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))).otherwise(word)
    counts = run.select(word.alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return counts.where((F.length("word") >= shortest) & (F.col("n") >= least))


def _value(letter: Column) -> Column:
    code = F.ascii(letter).cast("long")
    return code * code * code * code * code


def posts(counted: DataFrame) -> DataFrame:
    """(key, side, half, letter, word, n): each word under its key (letter: empty) and under its key less each of its letters, with either half of what is left."""
    letters = F.split("word", "")
    key = F.aggregate(letters, F.lit(0).cast("long"), lambda total, c: (total + _value(c)) % _MODULUS)
    keyed = counted.select("word", "n", key.alias("whole"), F.explode(F.concat(F.array(F.lit("")), F.array_distinct(letters))).alias("letter"))
    less = F.when(F.col("letter") == "", F.col("whole")).otherwise(F.pmod(F.col("whole") - _value(F.col("letter")), F.lit(_MODULUS)))
    left = F.length("word") - F.when(F.col("letter") == "", 0).otherwise(1)
    first = F.floor(left / 2).cast("int")
    sides = F.array(
        F.struct(F.lit(0).alias("side"), F.xxhash64(F.substring("word", F.lit(1), first)).alias("half")),
        F.struct(F.lit(1).alias("side"), F.xxhash64(F.substring("word", F.length("word") - left + first + 1, left - first)).alias("half")),
    )
    keyed = keyed.select("word", "n", "letter", less.alias("key"), first.alias("first"), F.explode(sides).alias("at"))
    return keyed.select("key", "at.side", "at.half", "letter", "first", "word", "n")


def near(counted: DataFrame) -> DataFrame:
    """(a, a_n, b, b_n) with a < b: all pairs of words of (word, n) that differ by exactly one inserted, deleted or replaced code point, each once.

    A pair meets under one key only: two different pairs of letters whose fifth powers differ by the same amount aren't
    known at all, and there are none among the code points of letters. Of its two halves the first counts where it is equal.
    """
    posted = posts(counted)
    a, b = (posted.select("key", "side", "half", *[F.col(c).alias(f"{s}_{c}") for c in ("letter", "first", "word", "n")]) for s in ("a", "b"))
    met = a.join(b, ["key", "side", "half"]).where("a_word < b_word and a_letter <> b_letter")
    head = F.substring("a_word", F.lit(1), F.col("a_first")) != F.substring("b_word", F.lit(1), F.col("b_first"))
    close = (F.abs(F.length("a_word") - F.length("b_word")) <= 1) & (F.levenshtein("a_word", "b_word", 1) == 1)
    return met.where(((F.col("side") == 0) | head) & close).select(F.col("a_word").alias("a"), "a_n", F.col("b_word").alias("b"), "b_n")


def variants(counted: DataFrame, ratio: int = 5) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each row of (word, n), whose words are distinct.

    form: the near word of largest n, of equal ones the smallest by code points, if its n is ``ratio`` times the word's or
    more; else null. root: where following forms ends, the word itself if it has none. Nulls and empty tables give no rows
    but their own; a word without near words has n_near 0.
    """
    counted = common.cut(counted.select("word", "n"))
    pairs = near(counted)
    ends = pairs.select(F.explode(F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("other"), F.col("b_n").alias("m")), F.struct(F.col("b").alias("word"), F.col("a").alias("other"), F.col("a_n").alias("m")))).alias("e"))
    best = ends.select("e.*").groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("minus"), "other")).alias("best"))
    out = counted.join(best, "word", "left").withColumn("is_form", F.coalesce(-F.col("best.minus") >= ratio * F.col("n"), F.lit(False)))
    out = common.cut(
        out.select(
            "word", F.when(F.col("is_form"), F.col("best.other")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(F.col("is_form"), -F.col("best.minus")).alias("form_n"),
        )
    )
    return out.join(_roots(out.where("form is not null").select("word", "form")), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form. Each round follows twice as many forms as the one before, so that few rounds suffice."""
    at = forms.select("word", F.col("form").alias("root"))
    while True:
        then = at.select(F.col("word").alias("via"), F.col("root").alias("next"))
        moved = common.cut(at.join(then, F.col("root") == F.col("via"), "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        at = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return at
