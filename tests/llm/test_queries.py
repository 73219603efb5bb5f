"""The queries on whole tables: against their SQL, and the odd cases of tables that the operators' own tests leave out."""

import os
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from granary.llm import mixing, packing, pii, quality, queries, substring_dedup

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    got = queries.QUERIES[name](spark, FOLDER)
    columns = sorted(got.columns)
    want = con.execute(f"select {', '.join(columns)} from ({queries.SQL[name]})").fetchall()
    assert sorted((tuple(r) for r in got.select(*columns).collect()), key=repr) == sorted(want, key=repr)


def test_near_vectors_sql_on_planted_links(spark, tmp_path):
    """The tables hold few links; here are vectors with many, and some that can't be compared."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(120, 16))
    x[40:80] = x[:40] + rng.normal(size=(40, 16)) * rng.uniform(0.05, 0.6, (40, 1))
    rows = [(i, [float(v) for v in x[i]], i % 40 % 3) for i in range(120)] + [(500, None, 1), (501, [0.0] * 16, 1), (502, [float("nan")] * 16, 1), (503, [1.0] * 16, None)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    got = queries.op8_embedding_dedup(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    want = con.execute(f"select {', '.join(got.columns)} from ({queries.SQL['op8_embedding_dedup']})").fetchall()
    assert sorted(tuple(r) for r in got.collect()) == sorted(want) and sum(r["n_links"] for r in got.collect()) > 20


def plain_score(model, x):
    """The additive model, row by row and feature by feature."""
    out = []
    for row in x:
        total = model.intercept
        for f, (edges, table) in enumerate(zip(model.edges, model.tables, strict=True)):
            total += table[sum(e <= row[f] for e in edges)]
        for (f, g), table in zip(model.pairs, model.pair_tables, strict=True):
            total += table[sum(e <= row[f] for e in model.pair_edges[f]), sum(e <= row[g] for e in model.pair_edges[g])]
        out.append(1 / (1 + np.exp(-total)))
    return np.array(out)


def test_quality_model_is_additive_with_pairs():
    """Against a plain version, on labels that no single feature tells apart: it takes the pairs to learn them."""
    rng = np.random.default_rng(2)
    x = np.zeros((4000, len(quality.FEATURES)))
    x[:, :4] = rng.random((4000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit(x[:3000], y[:3000])
    assert np.allclose(model.score(x[3000:3200]), plain_score(model, x[3000:3200]))
    assert (model.score(x[3000:]) > 0.5).astype(float).__eq__(y[3000:]).mean() > 0.9 and (1, 0) in model.pairs
    alone = quality.Model(model.intercept, model.edges, model.tables, [], model.pair_edges, [])
    assert (alone.score(x[3000:]) > 0.5).astype(float).__eq__(y[3000:]).mean() < 0.7
    # A cut of one table's gradient never does worse than the best constant.
    g, w = rng.normal(size=20), rng.random(20) + 0.1
    leaf = quality._tree(g, w)
    assert len(np.unique(leaf)) <= 4 and (g * leaf).sum() - 0.5 * (w * leaf**2).sum() >= g.sum() ** 2 / (w.sum() + 1) / 2 - 1e-9


def test_quality_of_repeated_and_long_texts(spark):
    long = "some words of a text that goes on and on. " * 30_000
    rows = [(1, "a b c."), (1, "a b c."), (2, long), (3, "x" * 500_000), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("label", F.lit("clash"))
    labels = spark.createDataFrame([(1, 1), (1, 1), (3, 0), (4, 0)], "doc_id long, quality int")
    model = quality.train(docs, labels)
    got = quality.scored(docs, model, ["doc_id", "label"]).collect()
    assert len(got) == 5 and all(0 <= r["__score"] <= 1 for r in got) and len({r["__score"] for r in got if r["doc_id"] == 1}) == 1
    whole, cut = quality.features(pa.array([long, long[:100_000]]))
    assert whole[0] > cut[0]


def test_packing_of_clashing_columns_and_equal_rows(spark, monkeypatch):
    """Columns with names used inside; rows that are equal, without ids, and so many that they fill several islands."""
    sizes = []
    monkeypatch.setattr(packing, "ISLAND", 30)
    shuffled = type(spark.range(1)).groupBy

    def grouped(df, *keys):
        if keys == ("island",) and "stays" not in df.columns:
            sizes.extend(r["count"] for r in shuffled(df, "island").count().collect())
        return shuffled(df, *keys)

    monkeypatch.setattr(type(spark.range(1)), "groupBy", grouped)
    docs = spark.range(0, 300).select(F.lit(None).cast("long").alias("doc_id"), F.lit("one two three four five").alias("text")).withColumns({"island": F.lit("clash"), "bin": F.lit(1), "length": F.lit(0)})
    rows = packing.pack(docs, queries.tokenizer_file(), size=64).collect()
    assert len(rows) == 300 and len({(r["length"], r["ids_crc32"]) for r in rows}) == 1
    held = Counter()
    for r in rows:
        held[r["sequence_id"]] += r["length"]
    assert max(held.values()) <= 64 and len(held) <= -(-300 // (64 // rows[0]["length"])) + 2 and len(sizes) == 10 and max(sizes) < 60


def test_pseudonyms_of_repeated_and_long_rows(spark):
    long = ("word " * 60_000) + "mail me@x.org " + ("1 " * 50_000)
    docs = spark.createDataFrame([(1, long), (1, long), (2, "me@x.org"), (2, "me@x.org"), (None, "me@x.org")], "doc_id long, text string").withColumn("kind", F.lit("clash"))
    got = pii.pseudonymised(docs, "k", found="hits").collect()
    assert len(got) == 5 and all([h["pseudonym"] for h in r["hits"]] == [got[-1]["hits"][0]["pseudonym"]] for r in got)
    assert all(len(r["text"]) == len(long) for r in got if r["doc_id"] == 1) and {r["kind"] for r in got} == {"clash"}


def test_mix_of_one_source_with_most_rows(spark):
    """A source with almost all rows, and equal texts."""
    docs = spark.range(0, 3000).select("id", F.when(F.col("id") < 2900, F.lit("big")).otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("source"), F.lit("a b c d").alias("text")).withColumnRenamed("id", "doc_id")
    got = mixing.taken_words(mixing.mix(docs, shard_words=500)).join(docs, "doc_id").groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("x")).collect()
    assert len(got) == 8 and all(abs(r["t"] - r["x"]) <= 1 for r in got)


def test_passages_of_repeated_rows_alone(spark):
    """Rows with one doc_id are one document: no passage of theirs repeats across documents."""
    text = " ".join(f"w{i}" for i in range(80))
    rows = spark.createDataFrame([(1, text), (1, text), (2, text.upper()), (3, " ".join(f"v{i}" for i in range(80)))], "doc_id long, text string")
    assert {r["doc_id"] for r in substring_dedup.repeated_passages(rows).collect()} == {1, 2}
    assert substring_dedup.repeated_passages(rows.where("doc_id = 1")).count() == 0


def test_filter_of_ids(spark, monkeypatch):
    """Every id that is wanted passes, whatever the filter's size; of the others few do while it is large enough."""
    from granary.llm import common

    rows = spark.range(-500, 20_000).select(F.col("id").alias("doc_id"), F.lit("t").alias("__filter"))
    wanted = rows.where("doc_id % 7 = 0").select(F.col("doc_id").alias("x"))
    want = {r["x"] for r in wanted.collect()}
    got = common.likely(rows, "doc_id", wanted)
    ids = {r["doc_id"] for r in got.collect()}
    assert got.columns == rows.columns and want <= ids and len(ids) < len(want) + 10
    assert common.likely(rows, "doc_id", wanted.limit(0)).count() == 0
    monkeypatch.setattr(common, "FILTER_BITS", 1 << 12)
    small = {r["doc_id"] for r in common.likely(rows, "doc_id", wanted).collect()}
    assert want < small


def test_held_out_rows(spark):
    ids = [r["doc_id"] for r in spark.range(0, 50).withColumnRenamed("id", "doc_id").where(quality.held_out("doc_id")).collect()]
    assert ids == [i for i in range(50) if zlib.crc32(str(i).encode()) % 4 == 2]
