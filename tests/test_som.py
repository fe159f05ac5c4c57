import numpy as np
import pytest
from pyspark.sql import functions as F

from featuremap.errors import DimensionMismatchError, InsufficientDataError, InvalidConfigError, SOMError
from featuremap.operators.som import SOM, SOMConfig, SOMModel, neighborhood
from featuremap.operators.som import quality as Q
from featuremap.operators.som.config import smooth, total_influence
from featuremap.operators.som.kernel import best_units
from featuremap.operators.som.train import batch_update, grid_codebook


@pytest.fixture(scope="module")
def sample(spark):
    rng = np.random.default_rng(42)
    data = rng.random((100, 4))
    rows = [(i, *map(float, data[i])) for i in range(100)]
    return spark.createDataFrame(rows, ["id", "a", "b", "c", "d"]), data


FEATS = ["a", "b", "c", "d"]


def test_train_shapes_and_scoring(spark, sample):
    df, _ = sample
    m = SOM(5, 5, features=FEATS, epochs=10).fit(df)
    assert m.codebook.shape == (25, 4)
    out = m.transform(df).collect()
    assert len(out) == 100
    assert all(0 <= r.neuron_x < 5 and 0 <= r.neuron_y < 5 for r in out)


def test_non_square_map_and_bmu_is_nearest(spark, sample):
    df, data = sample
    m = SOM(4, 7, features=FEATS, epochs=5, sigma=1.5).fit(df)
    z = (data - m.mins) / m.ranges
    scored = m.predict(df).orderBy("id").collect()
    for r, row in zip(scored, z):
        d = np.sqrt(((m.codebook - row) ** 2).sum(axis=1))
        k = r.neuron_x * 7 + r.neuron_y
        assert r.distance == pytest.approx(d.min(), abs=1e-12)
        assert k == int(np.argmin(d))
        assert r.neuron_y < 7 and r.neuron_x < 4


def test_metrics_invariants(spark, sample):
    df, _ = sample
    m = SOM(5, 5, features=FEATS, epochs=10).fit(df)
    s = m.score(df)
    met = Q.metrics(s, 5, 5).first()
    hits = Q.hits(m.transform(df), 5, 5)
    assert hits.count() == 25
    assert hits.agg(F.sum("hits")).first()[0] == 100
    assert met.coverage == pytest.approx(met.nodes_used / 25)
    assert 0 <= met.te <= 1
    assert met.mean_hits == pytest.approx(100 / met.nodes_used)
    assert Q.quantization_error(s).first().qe == pytest.approx(met.qe)


def test_history_qe_decreases_with_fixed_sigma(spark, sample):
    df, _ = sample
    m = SOM(4, 4, features=FEATS, epochs=6, tol=0, decay_function="none", sigma=1.0,
            learning_rate=1.0, initialization="grid").fit(df)
    qes = [h[1] for h in m.history]
    assert all(b <= a + 1e-12 for a, b in zip(qes[1:], qes[2:]))


def test_batch_update_matches_rule():
    cfg = SOMConfig(3, 2, sigma=1.0, learning_rate=0.5)
    W = grid_codebook(3, 2, 2)
    counts = np.array([3.0, 0, 1, 0, 2, 0])
    sums = np.random.default_rng(0).random((6, 2)) * counts[:, None]
    H = neighborhood("gaussian", 3, 2, 1.0)
    new = batch_update(W, counts, sums, cfg, 1.0, 0.5)
    for k in range(6):
        num = sum(H[k, b] * (sums[b] - counts[b] * W[k]) for b in range(6))
        den = sum(abs(H[k, b]) * counts[b] for b in range(6))
        assert np.allclose(new[k], W[k] + 0.5 * num / den)


@pytest.mark.parametrize("kind", ["gaussian", "mexican_hat", "bubble", "triangle"])
@pytest.mark.parametrize("x,y,sigma", [(5, 5, 1.0), (7, 4, 1.7), (3, 9, 0.4), (1, 6, 3.0)])
def test_smoothing_by_axis_equals_the_dense_rule(kind, x, y, sigma):
    rng = np.random.default_rng(x * y)
    counts = rng.integers(0, 4, x * y).astype(float)
    sums = rng.random((x * y, 3)) * counts[:, None]
    H = neighborhood(kind, x, y, sigma)
    assert np.allclose(smooth(kind, x, y, sigma, sums), H @ sums, rtol=1e-12, atol=1e-13)
    assert np.allclose(total_influence(kind, x, y, sigma, counts), np.abs(H) @ counts, rtol=1e-12, atol=1e-13)
    W = rng.random((x * y, 3))
    den = np.abs(H) @ counts
    want = np.where(den[:, None] > 0, W + 0.5 * (H @ sums - (H @ counts)[:, None] * W)
                    / np.where(den > 0, den, 1)[:, None], W)
    cfg = SOMConfig(x, y, sigma=sigma, neighborhood_function=kind)
    assert np.allclose(batch_update(W, counts, sums, cfg, sigma, 0.5), want, rtol=1e-9, atol=1e-11)


def test_large_map_trains_without_a_dense_matrix():
    """A dense matrix of 300 x 300 neurons would take 65 GB."""
    import tracemalloc

    rng = np.random.default_rng(1)
    for kind in ("gaussian", "mexican_hat"):
        cfg = SOMConfig(300, 300, sigma=20.0, neighborhood_function=kind)
        counts = rng.integers(0, 3, 90_000).astype(float)
        sums = rng.random((90_000, 2)) * counts[:, None]
        tracemalloc.start()
        out = batch_update(grid_codebook(300, 300, 2), counts, sums, cfg, 20.0, 0.5)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert np.isfinite(out).all() and peak < 100e6


def test_neighborhood_shapes():
    for kind in ("gaussian", "mexican_hat", "bubble", "triangle"):
        H = neighborhood(kind, 3, 4, 1.5)
        assert H.shape == (12, 12) and np.allclose(H, H.T)
        assert H[0, 0] == H.max()


def test_kernel_ties_go_to_lowest_index():
    w = np.array([[0.0], [1.0], [0.0]])
    b, d, b2 = best_units(np.array([[0.0], [0.5]]), w, second=True)
    assert b.tolist() == [0, 0] and b2.tolist() == [2, 1]


def test_errors(spark, sample):
    df, _ = sample
    with pytest.raises(InsufficientDataError):
        SOM(3, 3, features=FEATS).fit(df.limit(2))
    with pytest.raises(DimensionMismatchError):
        SOM(3, 3, features=FEATS, input_len=3).fit(df)
    with pytest.raises(InvalidConfigError):
        SOMConfig(0, 3)
    with pytest.raises(InvalidConfigError):
        SOMConfig(3, 3, learning_rate=1.5)
    with pytest.raises(InvalidConfigError):
        SOMConfig(3, 3, neighborhood_function="cosine")


def test_null_features(spark, sample):
    df, _ = sample
    bad = df.withColumn("a", F.when(F.col("id") < 3, F.lit(None)).otherwise(F.col("a")))
    with pytest.raises(SOMError):
        SOM(3, 3, features=FEATS).fit(bad)
    m = SOM(3, 3, features=FEATS, epochs=2, handle_null="skip").fit(bad)
    out = m.transform(bad).where("id < 3").collect()
    assert all(r.neuron_x is None for r in out)


def test_init_variants_and_vector_column(spark, sample):
    df, _ = sample
    for init in ("random", "random_samples", "pca", "grid"):
        m = SOM(3, 4, features=FEATS, epochs=1, initialization=init).fit(df)
        assert np.isfinite(m.codebook).all()
    v = df.select("id", F.array(*FEATS).alias("v"))
    mv = SOM(3, 3, vector_col="v", epochs=3, initialization="grid", tol=0).fit(v)
    mf = SOM(3, 3, features=FEATS, epochs=3, initialization="grid", tol=0).fit(df)
    assert np.allclose(mv.codebook, mf.codebook)


def test_save_load_roundtrip(spark, sample, tmp_path):
    df, _ = sample
    m = SOM(4, 3, features=FEATS, epochs=3).fit(df)
    m.save(str(tmp_path / "m"))
    m2 = SOMModel.load(spark, str(tmp_path / "m"))
    assert np.allclose(m.codebook, m2.codebook)
    a = m.transform(df).orderBy("id").select("neuron_x", "neuron_y").collect()
    b = m2.transform(df).orderBy("id").select("neuron_x", "neuron_y").collect()
    assert a == b


def test_umatrix_and_boundaries(spark, sample):
    df, _ = sample
    m = SOM(4, 4, features=FEATS, epochs=5).fit(df)
    u = {(r.neuron_x, r.neuron_y): r for r in m.distance_map(spark).collect()}
    assert len(u) == 16
    W = m.codebook.reshape(4, 4, 4)
    nb = [np.linalg.norm(W[0, 0] - W[i, j]) for i, j in ((0, 1), (1, 0), (1, 1))]
    assert u[(0, 0)].u_mean == pytest.approx(np.mean(nb))
    assert max(r.u_scaled for r in u.values()) == pytest.approx(1.0)
    b = Q.boundaries(m.distance_map(spark)).collect()
    assert len(b) == 16


def test_quantize_and_planes(spark, sample):
    df, _ = sample
    m = SOM(3, 3, features=FEATS, epochs=3).fit(df)
    q = m.quantize(df).orderBy("id").first()
    k = q.neuron_x * 3 + q.neuron_y
    assert np.allclose(q.quantized, m.codebook[k])
    planes = m.component_planes(spark, original_units=True).collect()
    assert len(planes) == 36 and {p.feature for p in planes} == set(FEATS)


def test_topographic_error_uses_all_rows(spark, sample):
    df, _ = sample
    m = SOM(4, 4, features=FEATS, epochs=3).fit(df)
    s = m.score(df)
    want = sum(max(abs(r.neuron_x - r.neuron2_x), abs(r.neuron_y - r.neuron2_y)) > 1
               for r in s.collect()) / 100
    assert Q.topographic_error(s).first().te == pytest.approx(want)


def test_ragged_vectors_are_refused(spark):
    from featuremap.errors import DimensionMismatchError

    df = spark.createDataFrame([([0.1, 0.2],), ([0.3, 0.4, 0.5],), ([0.1, 0.9],), (None,)], "v array<double>")
    with pytest.raises(DimensionMismatchError):
        SOM(2, 2, vector_col="v", epochs=1, handle_null="skip").fit(df)
    even = df.filter("v is null or size(v) = 2").unionByName(df.filter("size(v) = 2"))
    m = SOM(2, 2, vector_col="v", epochs=1, handle_null="skip").fit(even)
    with pytest.raises(Exception, match="needs 2 elements"):
        m.transform(df).collect()


def test_repeated_rows_do_not_collapse_the_map(spark):
    rows = [(float(i % 7), float(i % 3)) for i in range(3000)]
    df = spark.createDataFrame(rows, "a double, b double")
    first = SOM(4, 4, features=["a", "b"], epochs=0, initialization="random").fit(df)
    assert len({tuple(w) for w in first.codebook.tolist()}) == 16
    m = SOM(5, 5, features=["a", "b"], epochs=5, initialization="random").fit(df)
    assert m.transform(df).select("neuron_x", "neuron_y").distinct().count() > 5
    k = SOM(4, 4, features=["a", "b"], epochs=0, initialization="random", init_key="id")
    keyed = df.withColumn("id", F.monotonically_increasing_id())
    assert k.fit(keyed).codebook.tolist() == k.fit(keyed.repartition(3)).codebook.tolist()


def test_skipped_rows_do_not_widen_the_bounds(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 1.0), (0.5, 0.2), (1000.0, None)], "a double, b double")
    m = SOM(2, 2, features=["a", "b"], epochs=1, handle_null="skip").fit(df)
    assert m.maxs.tolist() == [1.0, 1.0]


def test_training_runs_all_epochs_unless_asked(spark, sample):
    df, _ = sample
    assert len(SOM(3, 3, features=FEATS, epochs=30).fit(df).history) == 30


@pytest.mark.parametrize("what", ["metrics", "te", "hits", "label", "uniformity", "bands"])
def test_the_kernel_runs_once_per_row(spark, sample, what):
    df, _ = sample
    m = SOM(3, 3, features=FEATS, epochs=1).fit(df)
    s = m.score(df)
    out = {"metrics": lambda: Q.metrics(s, 3, 3), "te": lambda: Q.topographic_error(s),
           "hits": lambda: Q.hits(s, 3, 3), "label": lambda: Q.label_hits(s, "id"),
           "uniformity": lambda: Q.uniformity(Q.hits(s, 3, 3), 5),
           "bands": lambda: Q.quality_report(Q.metrics(s, 3, 3))}[what]()
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_coverage_of_exactly_one_half_is_poor(spark):
    m = spark.createDataFrame([(0.05, 0.05, 0.5), (0.05, 0.05, 0.51)], "qe double, te double, coverage double")
    assert [r.coverage_band for r in Q.quality_report(m).orderBy("coverage").collect()] == ["poor", "acceptable"]


def test_screened_kernel_equals_exact_scan():
    from featuremap.operators.som import kernel as K

    rng = np.random.default_rng(3)
    for trial in range(12):
        d, k, n = int(rng.integers(9, 40)), int(rng.integers(2, 80)), int(rng.integers(1, 800))
        if trial % 2:
            z, w = rng.integers(0, 3, (n, d)) / 3.0, rng.integers(0, 3, (k, d)) / 3.0
        else:
            z, w = rng.random((n, d)), rng.random((k, d))
        b1, d1, b2 = K.best_units(z, w, second=True)
        ref = K.squared_distances(z, w)
        rb = np.argmin(ref, axis=1)
        assert (b1 == rb).all() and (d1 == np.sqrt(ref[np.arange(n), rb])).all()
        ref[np.arange(n), rb] = np.inf
        assert (b2 == np.argmin(ref, axis=1)).all()


def test_decay_schedules():
    from featuremap.operators.som import decay

    assert decay(2.0, 0, 10, "asymptotic") == 2.0
    assert decay(2.0, 5, 10, "asymptotic") == pytest.approx(1.0)
    assert decay(2.0, 5, 10, "linear") == pytest.approx(1.0)
    assert decay(2.0, 10, 100, "inverse") == pytest.approx(2.0 * 1 / (1 + 10))
    assert decay(2.0, 25, 100, "exponential") == pytest.approx(2.0 * np.exp(-1))
    assert decay(2.0, 7, 10, "none") == 2.0


def test_learning_rate_decay_in_history(spark, sample):
    df, _ = sample
    m = SOM(3, 3, features=FEATS, epochs=4, tol=0, decay_function="linear",
            decay_learning_rate=True, learning_rate=0.8).fit(df)
    lrs = [h[3] for h in m.history]
    assert lrs == pytest.approx([0.8, 0.6, 0.4, 0.2])
