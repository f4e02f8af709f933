"""Classifier on held-out ratings, the pipeline stage by stage against brute force, and the registered SQL."""

from __future__ import annotations

import hashlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shelfspark.llm import quality_model, registry, ship
from test_group_operators import classes_by_force, copies_by_force
from test_text_operators import tiktoken_library
from tools.check_oracle import TABLES, ordered

HELD_OUT = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    ship(spark)
    docs = spark.read.parquet(f"{HELD_OUT}/documents.parquet")
    rated = quality_model.grades(spark.read.parquet(f"{HELD_OUT}/labels.parquet"))
    test = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    model = quality_model.fit(docs, rated.filter(~test))
    assert (np.diff(model.thresholds) > 0).all()
    found = quality_model.grade_documents(docs, model, grade=1).join(rated.filter(test).withColumnRenamed("doc_id", "key"), "key").collect()
    assert len(found) > 100
    assert np.mean([r.kept == (r.grade > 0) for r in found]) >= 0.95
    means = [np.mean([r.expected_grade for r in found if r.grade == g]) for g in (0, 1, 2)]
    assert means == sorted(means) and means[2] - means[0] > 1.5


def test_toxic_documents_go_and_clean_ones_stay(spark):
    ship(spark)
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rated = quality_model.grades(spark.read.parquet(f"{folder}/labels.parquet"))
    test = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    model = quality_model.fit(docs, rated.filter(~test))
    held_out = docs.join(rated.filter(test), "doc_id")
    found = quality_model.grade_documents(held_out, model).withColumnRenamed("key", "doc_id").join(rated, "doc_id").collect()
    shares = [np.mean([r.kept for r in found if r.grade == g]) for g in (1, 2)]
    assert len(found) > 1000 and shares[0] <= 0.2 and shares[1] >= 0.98
    query = registry.QUERIES["op10_quality_grade"](spark, folder).join(rated, "doc_id").collect()
    assert np.mean([r.kept for r in query if r.grade == 1]) <= 0.2 and np.mean([r.kept for r in query if r.grade == 2]) >= 0.98


def test_signs_are_judged_on_what_is_left():
    rows = [{1, 9}] * 6 + [{2, 9}] * 4 + [{3}] * 30 + [{3, 7}] * 2 + [{2}]
    toxic = np.array([True] * 10 + [False] * 33)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    sign = np.concatenate([np.array(sorted(r), np.int64) for r in rows])
    assert quality_model.fit_signs(owner, sign, toxic).tolist() == [9]
    keep = sign != 9
    assert quality_model.fit_signs(owner[keep], sign[keep], toxic).tolist() == [1, 2]
    assert quality_model.fit_signs(owner, sign, toxic & False).tolist() == []


def test_odd_rows_and_ratings(spark, odd, odd_rows, nothing):
    labels = spark.createDataFrame([(0, 1, 0), (1, 0, None), (1, 1, 1), (None, 1, 1), (2, None, 0), (3, 1, 1)], "doc_id bigint, quality int, toxic int")
    rated = quality_model.grades(labels)
    assert sorted(map(tuple, rated.collect())) == [(0, 2), (1, 0), (3, 1)]
    model = quality_model.fit(odd, rated)
    found = quality_model.grade_documents(odd, model).collect()
    assert len(found) == len(odd_rows) and all(0 <= r.expected_grade <= 2 for r in found)
    kept = quality_model.accepted(odd, model)
    assert kept.schema == odd.schema and kept.count() == sum(r.kept for r in found)
    assert quality_model.accepted(nothing, model).collect() == []
    none = quality_model.fit(odd, rated.limit(0))
    assert quality_model.accepted(odd, none).count() == len(odd_rows)
    assert quality_model.grade_documents(nothing, none).collect() == []


def test_fit_is_bounded(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rated = quality_model.grades(spark.read.parquet(f"{small}/labels.parquet"))
    a, b = (quality_model.fit(docs, rated, sample=n) for n in (30, 10_000))
    assert (a.weights != 0).sum() < (b.weights != 0).sum()


def test_fit_reads_one_row_of_a_repeated_key(spark, monkeypatch):
    ship(spark)
    docs = spark.createDataFrame([(1, f"some text {i}") for i in range(300)] + [(2, "other"), (3, None)], "doc_id bigint, text string")
    rated = spark.createDataFrame([(1, 2), (2, 0), (3, 1)], "doc_id bigint, grade int")
    seen = []
    whole_fit = quality_model.fit_ordinal
    monkeypatch.setattr(quality_model, "fit_ordinal", lambda *a: seen.append(sorted(a[3].tolist())) or whole_fit(*a))
    a = quality_model.fit(docs, rated)
    b = quality_model.fit(docs.orderBy(F.desc("text")).repartition(3), rated)
    assert seen == [[0, 1, 2], [0, 1, 2]]
    assert (a.weights == b.weights).all() and (a.thresholds == b.thresholds).all()


def likelihood(score, theta, grades):
    tails = np.concatenate((np.ones((len(score), 1)), 1 / (1 + np.exp(-(score[:, None] - theta))), np.zeros((len(score), 1))), axis=1)
    each = np.arange(len(score))
    return np.log(tails[each, grades] - tails[each, grades + 1]).mean()


def test_fit_reaches_the_best_likelihood():
    """On three features: no nearby weights or thresholds are likelier, and tails are those of the cumulative link."""
    rng = np.random.default_rng(0)
    rows, features = 400, 3
    x = rng.normal(0, 1, (rows, features))
    truth = x @ np.array([1.5, -1.0, 0.0]) + rng.logistic(0, 1, rows)
    grades = np.digitize(truth, [-0.5, 1.0])
    owner, slot = np.repeat(np.arange(rows), features), np.tile(np.arange(features), rows)
    model = quality_model.fit_ordinal(owner, slot, x.ravel(), grades, 3)
    own, theta = model.weights[:features].astype(float), model.thresholds

    def goal(w, t):
        return likelihood(x @ w, t, grades) - quality_model.SHRINK * (w**2).sum() / 2

    best = goal(own, theta)
    for step in (0.1, -0.1):
        for i in range(features):
            assert goal(own + step * (np.arange(features) == i), theta) < best
        for i in range(2):
            assert goal(own, theta + step * (np.arange(2) == i)) < best
    scores = np.array([-3.0, 0.0, 2.5])
    assert model.tails(scores) == pytest.approx(1 / (1 + np.exp(-(scores[:, None] - theta[None, :]))))


def test_fit_is_bounded_in_bytes(spark, monkeypatch):
    ship(spark)
    docs = spark.createDataFrame([(i, "word " * 100) for i in range(40)], "doc_id bigint, text string")
    rated = docs.selectExpr("doc_id", "cast(doc_id % 3 AS int) AS grade")
    seen = []
    plain = quality_model.fit_ordinal
    monkeypatch.setattr(quality_model, "fit_ordinal", lambda *a: seen.append(len(a[3])) or plain(*a))
    for size in (1, 2500, 1 << 20):
        quality_model.fit(docs, rated, sample_bytes=size)
    assert seen == [1, 5, 40]


def test_pipeline_of_odd_tables(spark, odd, nothing, tmp_path):
    """Null and empty texts, repeated rows, an empty table; labels of a few rows."""
    from shelfspark.session import settle

    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    labels = spark.createDataFrame([(0, 1, 0), (1, 0, 0), (2, 1, 0), (3, 1, 1)], "doc_id bigint, quality int, toxic int")
    for i, frame in enumerate((odd, nothing)):
        folder = str(tmp_path / str(i))
        frame.select(*columns).write.parquet(f"{folder}/documents.parquet")
        labels.write.parquet(f"{folder}/labels.parquet")
        docs = spark.read.parquet(f"{folder}/documents.parquet")
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = settle(stage(spark, docs, folder), "odd")
            assert docs.columns == columns
        assert corpus_pipeline.run(spark, folder).count() == docs.count()
        assert docs.isEmpty() == (i == 1)


def test_pipeline_by_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    frames = [docs]
    from shelfspark.session import settle

    for _, stage in corpus_pipeline.STAGES:
        frames.append(settle(stage(spark, frames[-1], small)))
    for frame in frames[1:-1]:
        assert frame.columns == docs.columns
    ids = [[r.doc_id for r in f.select("doc_id").collect()] for f in frames]
    labels = {r.doc_id: r for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    kept = {k: k in set(ids[1]) for k in labels}
    assert all(kept[k] for k, r in labels.items() if r.quality == 1 and not r.toxic)
    assert not any(kept[k] for k, r in labels.items() if r.quality == 0)
    assert np.mean([kept[k] for k, r in labels.items() if r.quality == 1 and r.toxic] or [0]) <= 0.2
    rows = [(k, texts[k]) for k in ids[1]]
    assert sorted(ids[2]) == sorted(int(w[0]) for w in copies_by_force(rows) if w[3])
    rows = [(k, texts[k]) for k in ids[2]]
    assert sorted(ids[3]) == sorted({int(w[1]) for w in classes_by_force(rows)})
    assert sorted(ids[4]) == sorted(ids[3])
    order = {r.doc_id: (r.slot, r.start) for r in _places(frames[3]).collect()}
    assert [order[k] for k in ids[4]] == sorted(order.values())
    library = tiktoken_library()
    for r in frames[5].collect():
        own = library.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(own), hashlib.sha256(" ".join(map(str, own)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def _places(docs):
    from shelfspark.llm import mixing

    return mixing.positions(docs, registry.TARGETS, registry.OTHER_SOURCES)


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query_equals_sql(spark, small, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    df = registry.QUERIES[name](spark, small)
    result = con.execute(registry.ORACLE[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    assert ordered([tuple(r) for r in df.collect()], df.columns) == ordered(result.fetchall(), names)


def test_all_are_registered():
    assert [n.split("_")[0] for n in registry.QUERIES] == [f"op{i}" for i in range(1, 14)]
    assert len(corpus_pipeline.STAGES) == 5
