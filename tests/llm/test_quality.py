import numpy as np

from pagesieve.llm import quality as K

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = K.score_documents(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(held) > 50 and all(0 <= r.score <= 1 for r in rows)
    assert np.mean([(r.score >= 0.3) == (r.quality == 1) for r in held]) > 0.95


def test_scores_do_not_depend_on_ids_or_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    first = {r.doc_id: r.score for r in K.score_documents(docs, labels).collect()}
    flipped = labels.selectExpr("doc_id", "if(crc32(string(doc_id)) % 5 = 0, 1 - quality, quality) AS quality")
    changed = docs.selectExpr("doc_id", "text", "'x' AS lang", "'y' AS source", "0L AS score")
    second = {r.doc_id: r.score for r in K.score_documents(changed, flipped).collect()}
    assert max(abs(first[i] - second[i]) for i in first) < 1e-6


def test_odd_rows_and_empty_tables(spark, frame, odd_pairs):
    labels = spark.createDataFrame([(i, i % 2, None) for i in range(12)] + [(None, 1, "x"), (3, None, "x"), (5, 1, "x")],
                                   "doc_id long, quality int, text string")
    out = K.score_documents(frame(odd_pairs), labels).collect()
    assert len(out) == len(odd_pairs) and all(0 <= r.score <= 1 for r in out)
    assert not any(r.held_out for r in out if r.doc_id is None)
    assert K.score_documents(frame([]), labels).count() == 0
    none = labels.where("false")
    assert {r.score for r in K.score_documents(frame(odd_pairs), none).collect()} == {0.5}
    kept = K.keep_good_documents(frame(odd_pairs), none, 0.3)
    assert kept.columns == frame(odd_pairs).columns and kept.count() == len(odd_pairs)


def test_filter_agrees_with_scores(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    good = {r.doc_id for r in K.score_documents(docs, labels).where("score >= 0.3").collect()}
    assert {r.doc_id for r in K.keep_good_documents(docs, labels, 0.3).collect()} == good


def test_isotonic_is_the_nearest_monotone_sequence(rng):
    values = np.array([rng.random() for _ in range(60)]) + np.arange(60) / 60
    weights = np.array([rng.randint(1, 5) for _ in range(60)], float)
    fit = K.isotonic(values, weights)
    assert (np.diff(fit) >= -1e-12).all()
    # the minimax formula of isotonic regression
    for i in range(0, 60, 7):
        want = max(min(np.average(values[a:b + 1], weights=weights[a:b + 1]) for b in range(i, 60)) for a in range(i + 1))
        assert abs(fit[i] - want) < 1e-9


def test_features_approximate_the_gaussian_kernel():
    rng = np.random.default_rng(0)
    d = len(K.STATISTICS)
    model = K.Model(np.zeros(d), np.ones(d), rng.normal(0, 1 / 3, (d, 20_000)), rng.uniform(0, 2 * np.pi, 20_000),
                    np.zeros(0), np.zeros(0), np.zeros(0))
    x = rng.normal(size=(6, d))
    z = model.features(x)[:, 1:]
    want = np.exp(-((x[:, None] - x[None]) ** 2).sum(axis=2) / 18)
    assert np.abs(z @ z.T - want).max() < 0.05


def test_normal_equations_are_the_sums_over_all_rows(spark):
    rng = np.random.default_rng(1)
    d = len(K.STATISTICS)
    stats = rng.normal(size=(50, d)).astype(np.float32)
    model = K.Model(np.zeros(d), np.ones(d), rng.normal(size=(d, 4)), np.zeros(4), np.zeros(5), np.zeros(0), np.zeros(0))
    rows = spark.createDataFrame([(x.tolist(), float(i % 2)) for i, x in enumerate(stats)],
                                 "stats array<float>, label double").repartition(5)
    a, b = K.normal_equations(rows, model)
    z = model.features(stats.astype(float))
    assert np.allclose(a, z.T @ z) and np.allclose(b, z.T @ (np.arange(50) % 2))


def test_statistics(rng):
    data, offsets = np.frombuffer(b"Ab cd.\nAB!! AB!!x", np.uint8), np.array([0, 7, 7, 17])
    stats = dict(zip(K.STATISTICS, K.slice_statistics(data, offsets).T.tolist(), strict=True))
    assert stats["share_upper"] == [1 / 7, 0, 0.4] and stats["share_newline"] == [1 / 7, 0, 0]
    assert np.allclose(stats["log_words"], np.log1p([2, 0, 2])) and stats["distinct_words"] == [1, 0, 1]
