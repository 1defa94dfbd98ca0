"""Postings of a vocabulary: one pass over the texts, the same lengths and counts as the whole index."""

from occuspark.operators import pruned, retrieval as RT
from occuspark.plans import q_ml, q_text

DOCS = [(1, "a", "red title", "red ring gear ring"), (2, "b", "red title", None), (3, None, "", "gear the of x wheel"),
        (3, None, "", "gear the of x wheel"), (4, "a", "blue", "")]


def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id long, source_type string, title string, text string")


def test_counts_and_lengths_are_those_of_the_whole_index(spark, monkeypatch):
    d = docs(spark)
    words = spark.createDataFrame([("ring",), ("red",), ("red",), ("gear",)], "term string")
    want = RT.postings(RT.doc_terms(d)).where("term IN ('ring', 'red', 'gear')").orderBy("doc_id", "term").collect()
    for most in (200_000, 1):
        monkeypatch.setattr(RT, "SENT_TERMS", most)
        post = RT.vocabulary_postings(d, words)
        got = post.where("term IN ('ring', 'red', 'gear')").select("term", "doc_id", "tf").orderBy("doc_id", "term").collect()
        assert got == want and len(got) == 5
        assert sorted(RT.doc_lengths(d, post).collect(), key=str) == sorted(RT.doc_tokens(d).collect(), key=str)


class Ctx:
    def __init__(self, spark):
        self.spark, self._cache = spark, {}

    def t(self, name):
        if name == "benchmark":
            return self.spark.createDataFrame([(1, "red ring gear"), (2, "gear the of x wheel")], "item_id long, text string")
        return docs(self.spark).selectExpr("doc_id", "text", "title AS lang", "coalesce(source_type, 's') AS source")

    def _memo(self, key, build):
        if key not in self._cache:
            self._cache[key] = build()
        return self._cache[key]


def test_ranking_and_boosts_split_each_text_once(spark, monkeypatch):
    """The texts are read for one written index; relevance and boosts come from it."""
    read = []
    index = RT.vocabulary_postings
    for module in (RT, pruned):
        monkeypatch.setattr(module, "vocabulary_postings", lambda *a, **k: read.append(1) or index(*a, **k))
    for name in ("doc_terms", "postings"):
        monkeypatch.setattr(RT, name, lambda *a, **k: read.append(10))
    ranks = q_text._ranks(Ctx(spark)).orderBy("query_id").collect()
    assert read == [1] and [r["relevant_rank"] for r in ranks] == [1, 1]
    del read[:]
    assert q_text._scored(Ctx(spark)).count() == 7 and read == [1]


def test_token_rows_are_written_before_they_are_read_again(spark, monkeypatch):
    written = []

    class Split:
        def select(self, *columns):
            return columns

    class Once:
        def split(self):
            return Split()

        def materialize(self, df):
            written.append(df)
            return df

    def windows(rows, *_):
        assert rows is written[0]
        raise KeyError

    monkeypatch.setattr(q_ml.ML, "token_windows", windows)
    try:
        q_ml.ml_token_tensors(Once())
    except KeyError:
        pass
    assert len(written) == 1
