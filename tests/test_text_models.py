import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import rows
from tableworks.functions import register
from tableworks.operators import features, forecast, text, vectors


# ---- text -----------------------------------------------------------------

PAGE = """<html><head><title>T &amp; x</title></head><body><nav>menu</nav><article><h1>Top</h1><script>var a = "</p>";</script>
<p>One <b>two</b></p><h2>Part A</h2><p>alpha</p><img src="data:image/png;base64,AAAA"><h2>Part B</h2>data:image/png;base64,QUJD</article></body></html>"""


def test_article_text():
    got = text.article_text(PAGE)
    assert got.startswith("# Top") and "One two" in got and "## Part A\n" in got and "alpha" in got
    assert "menu" not in got and "var a" not in got and "base64" not in got
    assert text.article_text("<p>no article</p>") is None and text.article_text(None) is None


def test_split_text_covers_everything():
    body = "\n\n".join(" ".join(f"w{p}_{i}" for i in range(n)) for p, n in enumerate([30, 5, 120, 1, 60]))
    chunks = text.split_text(body, 40, 10)
    assert all(text.words(c) <= 40 for c in chunks)
    assert set(body.split()) == set(" ".join(chunks).split())
    flat = text.split_text(" ".join(map(str, range(100))), 40, 10)
    assert flat[1].split()[:10] == flat[0].split()[-10:]  # overlap


def test_heading_chunks_pack_and_split(spark):
    def cut(body, *sizes):
        return [r.chunk for r in text.chunk_by_heading(spark.createDataFrame([(body,)], "t string"), "t", *sizes).orderBy("chunk_no").collect()]

    small = "\n".join(f"## H{i}\n" + " ".join(["x"] * 8) for i in range(3))
    assert len(cut(small, 100, 2, 5)) == 1
    big = "## A\n" + " ".join(["y"] * 250) + "\n## B\n" + " ".join(["z"] * 30)
    got = cut(big, 100, 2, 5)
    assert len(got) >= 3 and sum(c.count("z") for c in got) == 30
    assert cut("## A\ntiny", 100, 10, 5) == [] and cut(None, 100, 1, 1) == []


def test_chunk_fixed_matches_python(spark):
    body = " ".join(map(str, range(25)))
    df = spark.createDataFrame([(1, body), (2, None), (3, "a  b")], "id int, t string")
    got = text.chunk_fixed(df, "t", 10, 3).orderBy("id", "chunk_no").collect()
    assert [r.chunk for r in got if r.id == 1] == [" ".join(map(str, range(s, min(s + 10, 25)))) for s in (0, 7, 14, 21)]
    assert [(r.chunk, r.status) for r in got if r.id == 2] == [(None, "error")]
    assert [r.chunk for r in got if r.id == 3] == ["a b"]


def test_embed_with_batches(spark):
    df = spark.createDataFrame([(i, f"t{i}") for i in range(7)], "id int, t string")
    got = text.embed_with(df, "t", lambda ts: [[float(len(ts))] for _ in ts], batch=3).collect()
    assert len(got) == 7 and all(r.embedding[0] <= 3 for r in got)


def test_concat_capped_is_bounded(spark):
    df = spark.range(1000).select(F.lit("g").alias("k"), "id", F.lit("abcd").alias("t"))
    got = text.concat_capped(df, ["k"], ["id"], F.col("id"), "t", 12, "-").first().joined
    assert got == "abcd-abcd-ab"


def test_concat_capped_moves_no_texts_to_sum_lengths(spark, monkeypatch):
    seen, plain = [], text.running

    def running(df, *args, **kwargs):
        seen.append(df.columns)
        return plain(df, *args, **kwargs)

    monkeypatch.setattr(text, "running", running)
    data = [("g", 1, "a" * 30), ("g", 1, "a" * 30), ("g", None, "b"), ("g", 2, "c"), (None, 1, ""), (None, 2, "d"), ("g", 0, None)]
    df = spark.createDataFrame(data, "k string, id int, t string")
    got = {r.k: r.joined for r in text.concat_capped(df, ["k"], ["id"], F.col("id"), "t", 40, "-").collect()}
    assert got == {"g": ("b-" + "a" * 30 + "-" + "a" * 30)[:40], None: "-d"}
    assert "t" not in seen[0] and "_t" not in seen[0]


# ---- vectors --------------------------------------------------------------

@pytest.mark.parametrize("metric", ["cosine", "dot", "l2"])
def test_top_k_brute_force(spark, tables, metric):
    base = tables.embeddings.select("vec_id", "embedding")
    queries = base.filter("vec_id < 40").withColumnRenamed("vec_id", "q")
    x = {r.vec_id: np.array(r.embedding, dtype=float) for r in base.collect()}

    def score(a, b):
        if metric == "dot":
            return a @ b
        if metric == "l2":
            return -np.linalg.norm(a - b)
        return a @ b / np.linalg.norm(a) / np.linalg.norm(b)

    want = {}
    for q in range(40):
        ranked = sorted(x, key=lambda i: (-round(score(x[q], x[i]), 9), i))[:3]
        want[q] = ranked
    found = vectors.vector_top_k(queries.repartition(3), base.repartition(5), "q", "vec_id", "embedding", 3, metric)
    got = {}
    for r in found.collect():
        got.setdefault(r.q, []).append((r.rank, r.vec_id))
    assert {q: [v for _, v in sorted(p)] for q, p in got.items()} == want


def test_queries_beyond_the_limit_stay_distributed(spark, monkeypatch):
    base = spark.range(30).select("id", F.array(*[F.rand(i) for i in range(8)]).alias("v")).cache()
    q = base.withColumnRenamed("id", "q")
    whole = vectors.vector_top_k(q, base, "q", "id", "v", 2)
    big = q.crossJoin(spark.range(1200).select("id")).select((F.col("q") + F.col("id") * 100).alias("q"), "v")
    monkeypatch.setattr(vectors, "_scan", None)
    # several slices of queries and of rows meet in tiles
    monkeypatch.setattr(vectors, "CELL_ROWS", 7)
    many = vectors.vector_top_k(big, base, "q", "id", "v", 2, max_query_mb=1)
    assert rows(many.filter("q < 100"), "q", "id", "rank") == rows(whole, "q", "id", "rank")
    assert many.count() == 2 * 36_000


@pytest.fixture(scope="module")
def clustered(spark):
    """Loose clusters, repeated rows, a zero and a null vector, and a third of all rows in one spot."""
    rng = np.random.default_rng(8)
    centre = rng.normal(size=(12, 16)) * 3
    x = [(centre[i % 12] + rng.normal(size=16)).tolist() for i in range(1200)] + [centre[0].tolist()] * 600
    x[5], x[6] = x[7], [0.0] * 16
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x)] + [(5000, None)], "id long, v array<double>").repartition(5)
    return df.cache(), np.array(x)


def _nearest_by_hand(x, metric, k, ids):
    out = {}
    unit = np.divide(x, np.linalg.norm(x, axis=1, keepdims=True), out=np.zeros_like(x), where=np.linalg.norm(x, axis=1, keepdims=True) > 0)
    for i in ids:
        score = unit @ unit[i] if metric == "cosine" else -np.linalg.norm(x - x[i], axis=1)
        out[i] = np.sort(score)[::-1][:k]
    return out


@pytest.mark.parametrize("metric", ["l2", "cosine"])
def test_index_is_exact_on_demand_and_recalls_nine_tenths(spark, clustered, metric, monkeypatch):
    monkeypatch.setattr(vectors, "CELL_ROWS", 100)
    monkeypatch.setattr(vectors, "CELL_QUERIES", 7)
    df, x = clustered
    index = vectors.build_vector_index(df, "id", "v", cells=24, metric=metric)
    assert index.rows.count() == len(x) and len(index.centres) <= 24  # every row with a vector is indexed
    queries = df.filter("id % 20 = 0").select(F.col("id").alias("q"), "v")
    want = _nearest_by_hand(x, metric, 10, range(0, len(x), 20))
    for probes, exact, least in ((2, True, 1.0), (8, False, 0.9)):
        got = {}
        for r in index.search(queries, "q", "v", 10, probes, exact).collect():
            got.setdefault(r.q, []).append(r.score)
        assert set(got) == set(want) and all(len(s) == len(set(range(10))) for s in got.values())
        hits = sum(np.isclose(np.sort(got[i])[::-1], want[i], atol=1e-6).sum() for i in want)
        assert hits >= least * 10 * len(want)


def test_index_of_nothing_and_of_one_row(spark):
    none = spark.createDataFrame([], "id long, v array<double>")
    one = spark.createDataFrame([(1, [1.0, 2.0])], "id long, v array<double>")
    ask = one.withColumnRenamed("id", "q")
    assert vectors.vector_near(ask, none, "q", "id", "v", 3).collect() == []
    assert [(r.q, r.id, r.rank) for r in vectors.vector_near(ask, one, "q", "id", "v", 3, exact=True).collect()] == [(1, 1, 1)]
    assert vectors.vector_near(none.withColumnRenamed("id", "q"), one, "q", "id", "v", 3).collect() == []


# ---- features and models --------------------------------------------------

def test_feature_keys_must_be_unique(spark, tmp_path):
    df = spark.createDataFrame([(1, 2), (1, 3)], "id int, v int")
    with pytest.raises(PySparkException, match="repeats"):
        features.write_features(df, str(tmp_path / "f"), ["id"], 0)


def test_features_overwrite(spark, tmp_path):
    path = str(tmp_path / "f")
    features.write_features(spark.createDataFrame([(1, 2), (2, 3)], "id int, v int"), path, ["id"], 0)
    features.write_features(spark.createDataFrame([(2, 9)], "id int, v int"), path, ["id"], 1, mode="overwrite")
    assert rows(features.read_features(spark, path, ["id"]), "id", "v") == [(2, 9)]


def test_features_keep_columns_a_write_lacks(spark, tmp_path):
    path = str(tmp_path / "f")
    features.write_features(spark.createDataFrame([(1, 2, 3), (2, 3, 4)], "id int, v int, w int"), path, ["id"], 0)
    features.write_features(spark.createDataFrame([(2, None), (3, 7)], "id int, v int"), path, ["id"], 1)
    features.write_features(spark.createDataFrame([(2, None), (3, 7)], "id int, v int"), path, ["id"], 1)  # again
    features.write_features(spark.createDataFrame([(3, "x")], "id int, u string"), path, ["id"], 2)
    got = {r.id: (r.v, r.w, r.u) for r in features.read_features(spark, path, ["id"]).collect()}
    assert got == {1: (2, 3, None), 2: (None, 4, None), 3: (7, None, "x")}


def test_linear_model_as_function_equals_pipeline(spark):
    df = spark.range(400).select("id", (F.col("id") % 17).cast("double").alias("a"), (F.col("id") % 5).cast("double").alias("b"))
    df = df.withColumn("y", (F.col("a") + 3 * F.col("b") + F.col("id") % 3 > 14).cast("int"))
    model = features.train_classifier(df, "y", ["a", "b"])
    scored = features.score_batch(df, model, ["a", "b"], ["id", "a", "b", "y"], "1", "x", "2024-01-01")
    weights, bias = register.linear_weights(model, ["a", "b"])
    register.register_linear_model(spark, "t_score", weights, bias)
    worst = scored.select(F.max(F.abs(F.expr("t_score(a, b)") - F.col("score")))).first()[0]
    assert worst < 1e-9
    assert scored.filter("prediction = y").count() > 360


def test_forecast_follows_trend_and_week():
    days = np.arange(19_000, 19_200)
    y = 100 + 0.5 * (days - 19_000) + 10 * (days % 7 == 3)
    fit, band = forecast.fit_series(days, y, 14, 0.8)
    want = 100 + 0.5 * np.arange(200, 214) + 10 * (np.arange(19_200, 19_214) % 7 == 3)
    assert np.allclose(fit[-14:], want, atol=1e-6) and band < 1e-6


def test_short_series_are_returned(spark):
    df = spark.sql("SELECT 'a' AS k, date_add(DATE'2024-01-01', CAST(id AS INT)) AS ds, CAST(id AS DOUBLE) AS y FROM range(5) "
                   "UNION ALL SELECT 'b', date_add(DATE'2024-01-01', CAST(id AS INT)), 1.0D FROM range(20)")
    got = forecast.forecast_groups(df, ["k"], horizon=10)
    assert {r.k: r["count"] for r in got.groupBy("k").count().collect()} == {"a": 5, "b": 30}
    assert got.filter("k = 'a' AND yhat <> y").count() == 0
    table = forecast.assemble_forecast(got, ["k"])
    assert table.filter("is_prediction").count() == 10 and table.filter("lower < 0").count() == 0


def test_sentence_chunks(spark):
    body = 'Dr. Lee said "no." Then e.g. nothing! 你好。再见！ok'
    long = " ".join(f"w{i}" for i in range(20_000))
    df = spark.createDataFrame([(1, body), (2, None), (3, " \n"), (4, long), (5, "a b. c d. e f g.")], "id int, t string")
    got = {}
    for r in text.chunk_sentences(df, "t", 5).orderBy("id", "chunk_no").collect():
        got.setdefault(r.id, []).append((r.chunk, r.status))
    assert got[1] == [('Dr. Lee said "no."', "ok"), ("Then e.g. nothing! 你好。 再见！", "ok"), ("再见！ ok", "ok")]
    assert got[2] == got[3] == [(None, "error")]
    assert len(got[4]) == 4_000 and " ".join(c for c, _ in got[4]) == long
    assert [c for c, _ in got[5]] == ["a b. c d.", "c d. e f g."]


def test_scores_of_a_full_tile_need_little_memory():
    import tracemalloc

    import numpy as np

    rng = np.random.default_rng(0)
    q, x = rng.normal(size=(vectors.QUERY_ROWS, 8)), rng.normal(size=(vectors.CELL_ROWS, 8))
    want = -np.sqrt(np.maximum(((q[:, None, :] - x[None, :500, :]) ** 2).sum(2), 0))
    squares = (x**2).sum(1)
    tracemalloc.start()
    got = vectors._scores(q, x, "l2", squares)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.allclose(got[:, :500], want) and peak < 10 << 20
