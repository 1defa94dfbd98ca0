"""Near-duplicate classes against brute force; the pipeline's stages; the registered queries."""

import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from occuspark.llm import neardup

SCHEMA = "doc_id long, text string, id string, sig int, same string"


def shingle_set(text):
    w = re.findall(r"\w+", (text or "").lower())
    n = min(5, len(w))
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if w else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 0.0


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randint(2, 7)))
    out = []
    for _ in range(120):
        out.append(" ".join(word() for _ in range(rng.randint(60, 150))))
    for base in out[:25]:  # near copies: some words replaced
        w = base.split()
        for _ in range(rng.randint(1, 3)):
            v = list(w)
            for _ in range(rng.randint(0, 2)):
                v[rng.randrange(len(v))] = word()
            out.append(" ".join(v))
    hot = " ".join(word() for _ in range(200)).split()
    for _ in range(80):  # a large group, chained by small changes
        v = list(hot)
        for _ in range(2):
            v[rng.randrange(len(v))] = word()
        out.append(" ".join(v))
    passage = " ".join(word() for _ in range(40))
    out += [passage + " " + " ".join(word() for _ in range(40)) for _ in range(40)]  # half shared: no near copies
    out += [out[0].upper() + "!", None, "", "...", "short text", "Short, text", "x " * 3000, None]
    return out


def test_classes_are_those_of_brute_force(spark, texts):
    rows = [(i * 3 + 1, t, "c", 0, "k") for i, t in enumerate(texts)] + [(None, "no id here at all", None, None, None)]
    out = neardup.near_duplicates(spark.createDataFrame(rows, SCHEMA)).toPandas()
    assert len(out) == len(rows)
    sets = {i: shingle_set(t) for i, t, *_ in rows if i is not None}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    margin = 0
    for a, b in itertools.combinations(sets, 2):
        j = jaccard(sets[a], sets[b])
        margin += 0.78 < j < 0.83
        if j >= 0.8:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    got = {int(r.doc_id): int(r.class_id) for r in out.itertuples() if r.doc_id == r.doc_id}
    wrong = sum(got[i] != find(i) for i in sets)
    assert wrong <= margin
    assert set(out[out.is_representative & out.doc_id.notna()].doc_id) == set(got.values())
    assert out[out.doc_id.isna()].is_representative.all()


def test_groups_far_over_a_bucket(spark):
    rng = np.random.default_rng(8)
    base = [f"w{i}" for i in rng.integers(0, 10_000, 300)]
    rows = []
    for i in range(400):
        v = list(base)
        for at in rng.integers(0, 300, 3):
            v[at] = f"n{i}x{at}"
        rows.append((i, " ".join(v)))
    out = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).toPandas()
    assert out.class_id.nunique() == 1 and out.is_representative.sum() == 1


def test_bucket_mates_of_different_classes_make_each_pair_once(spark):
    rng, o = random.Random(6), neardup.Options()
    root = {i: rng.choice([i, 0, 1]) for i in range(60)}
    buckets = {(b, 100 * b + k): rng.sample(range(60), 25) for b in range(6) for k in range(2)}
    rows = [(b, key, i, root[i], root[i] != 0, rng.random() < 0.6) for (b, key), ids in buckets.items() for i in ids]
    able = spark.createDataFrame([(i, [1] * o.samples, [2] * 8, 5.0, 5.0, 1) for i in range(60)],
                                 "id long, sig array<tinyint>, fine array<tinyint>, weight double, common double, score long")
    some = spark.createDataFrame(rows, "band int, key long, id long, root long, minor boolean, near boolean")
    want = {(min(x[2], y[2]), max(x[2], y[2])) for x in rows for y in rows
            if x[:2] == y[:2] and x[4] and y[5] and x[3] != y[3]}
    got = [tuple(r) for r in neardup.pairs_between(some, able, o, neardup.Options(bands=2, rows=4)).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_isolated_pairs_near_the_threshold_are_found(spark):
    rng, rows = np.random.default_rng(4), []
    for i in range(2000):  # pairs of similarity 0.81 that no third text links
        words = [f"p{i}w{k}" for k in range(100)]
        other = list(words)
        a = int(rng.integers(5, 45))
        other[a], other[a + int(rng.integers(10, 45))] = "x", "y"
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(other))]
    out = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).toPandas()
    assert out.is_representative.sum() - 2000 <= 2


def test_samples_agree_as_often_as_weighted_jaccard():
    o = neardup.Options(bands=64, rows=4)
    rng = np.random.default_rng(5)
    a = np.sort(rng.choice(1 << 40, 400, replace=False)).astype(np.uint64)
    sampler, diffs = neardup.Sampler(o), []
    for share in (0.2, 0.5, 0.8):
        b = np.concatenate([a[:int(400 * share)], np.arange(400 - int(400 * share), dtype=np.uint64) + np.uint64(7)])
        wa, wb = rng.gamma(2.0, 1.0, 400), rng.gamma(2.0, 1.0, 400)
        wb[:int(400 * share)] = wa[:int(400 * share)] * rng.choice([1.0, 2.0], int(400 * share))
        order = np.argsort(b)
        both = np.minimum(wa[:int(400 * share)], wb[:int(400 * share)]).sum()
        true = both / (wa.sum() + wb.sum() - both)
        diffs.append((sampler(a, wa) == sampler(b[order], wb[order])).mean() - true)
    assert np.abs(diffs).max() < 0.1


def test_weighted_jaccard_of_counts():
    w = np.ones(16)
    a = (np.array([1, 2, 3], dtype=np.uint64), np.array([2, 1, 1]))
    b = (np.array([1, 3, 9], dtype=np.uint64), np.array([1, 1, 4]))
    assert neardup.weighted_jaccard(a, b, w) == 2 / 8


def test_frequencies_cover_all_documents(spark):
    rows = [(i, "one two three four five" + (f" six{i}" if i % 2 else "")) for i in range(100)] + [(200, None)]
    o = neardup.Options()
    table, n = neardup.frequency_table(spark.createDataFrame(rows, "doc_id long, text string").repartition(7), o)
    common, _ = neardup.shingles(neardup.WordHashes().of("one two three four five"), 5)
    assert n == 100 and table[int(common[0]) & (o.cells - 1)] == 100 and table.sum() == 150


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(60)] + [(100, k) for k in range(101, 180)] + [(500, 400), (400, 450)]
    rng.shuffle(edges)
    got = {r.id: r.root for r in neardup.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(61)) and all(got[i] == 100 for i in range(100, 180))
    assert got[500] == got[400] == got[450] == 400
    assert neardup.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_empty_tables_and_representatives(spark):
    schema = "doc_id long, text string, keep_id string"
    assert neardup.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    docs = spark.createDataFrame([(1, "a b c d e f", "x"), (2, "a b c d e f", "y"), (3, None, "z"), (None, "q", "w")], schema)
    kept = neardup.representatives(docs)
    assert kept.columns == docs.columns
    assert sorted(r.keep_id for r in kept.collect()) == ["w", "x", "z"]


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, left = docs.columns, [docs.count()]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "toxicity", "near_duplicates", "mixing", "packing"]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        left.append(docs.count())
        assert (docs.columns == columns) == (k < 4)
    assert left[0] >= left[1] >= left[2] >= left[3] > 0
    assert docs.agg(F.max("length")).first()[0] <= 2048
    assert corpus_pipeline.run(spark, sf_dir).count() == left[-1]


def test_pipeline_on_an_empty_table(spark, tmp_path):
    import corpus_pipeline
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "/root/testdata/sf0.001")
    assert docs.count() == 0


def test_va_file_query_against_its_sql(spark):
    import duckdb

    from occuspark.llm import queries
    got = queries.op2_va_file(spark, "/root/testdata/sf0.01").toPandas()
    duckdb.sql("CREATE OR REPLACE VIEW embeddings AS SELECT * FROM '/root/testdata/sf0.01/embeddings.parquet'")
    want = duckdb.sql(queries.ORACLES["op2_va_file"]).df()[got.columns]
    key = ["query_id", "rank"]
    assert (got.sort_values(key).to_numpy() == want.sort_values(key).to_numpy()).all()


def test_repeated_rows_leave_one_of_each_class(spark):
    long_text = " ".join(f"word{i}" for i in range(40))
    rows = [(1, long_text, "a"), (1, long_text, "a"), (2, long_text, "b"), (None, "no id", "c"), (None, "no id", "c"),
            (None, None, "c"), (3, "b b", "x"), (3, "a a", "y"), (4, None, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, keep string")
    out = [tuple(r) for r in neardup.representatives(docs).collect()]
    assert sorted(out, key=str) == sorted([(1, long_text, "a"), (None, "no id", "c"), (None, None, "c"), (3, "a a", "y"),
                                           (4, None, "z")], key=str)


def test_representatives_do_not_plan_the_classes_twice(spark):
    docs = spark.createDataFrame([(i, f"some words {i // 2}") for i in range(12)], "doc_id long, text string")
    kept = neardup.representatives(docs)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall("Exchange", plan)) <= 10
    assert kept.count() == 6
