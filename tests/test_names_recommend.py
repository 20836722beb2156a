from collections import Counter
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfstream.operators import aggregates, factor_blocks as blocks, factors as split, top_products
from shelfstream.plans import names, recommend as rec


def countries(spark):
    one = [("Ann", "A"), ("Bob", "B"), ("Ann", "C")]
    two = [("Cy", "D"), ("Di", "E")]
    schema = "first_name string, last_name string"
    return one, two, [spark.createDataFrame(x, schema) for x in (one, two)]


def test_all_pairs_equal_the_product(spark):
    one, two, tables = countries(spark)
    got = names.generated_names(tables, fraction=1.0).collect()
    want = [(f, l) for c in (one, two) for f, l in product([x[0] for x in c], [x[1] for x in c])]
    assert sorted((r.firstname, r.lastname) for r in got) == sorted(want)
    assert len({r.id for r in got}) == len(want)


def test_sampled_pairs(spark, monkeypatch):
    monkeypatch.setattr(names, "_CHUNK", 100)
    many = spark.range(60).selectExpr("concat('f', id) first_name", "concat('l', id) last_name")
    whole = names.generated_names([many, many], fraction=1.0)
    assert whole.count() == 7200
    one = names.generated_names([many, many], 0.3, seed=1).drop("id")
    assert one.exceptAll(names.generated_names([many, many], 0.3, seed=1).drop("id")).count() == 0
    assert abs(one.count() / 7200 - 0.3) < 0.03
    assert one.count() != names.generated_names([many, many], 0.3, seed=2).count()


def test_drawn_pairs_are_a_fair_sample(spark, monkeypatch):
    monkeypatch.setattr(names, "_KEPT", 16)
    first = spark.createDataFrame([(g, f"f{i}") for g, n in (("x", 90), ("y", 10), ("z", 5)) for i in range(n)], "g string, firstname string")
    last = spark.createDataFrame([(g, f"l{i}") for g, n in (("x", 80), ("y", 7), ("w", 3)) for i in range(n)], "g string, lastname string")
    every = 90 * 80 + 10 * 7
    for options in ({"share": 0.2}, {"n": every // 5}):
        drawn = names.drawn_pairs(first, last, "g", seed=3, **options).collect()
        assert len(set(drawn)) == len(drawn) and abs(len(drawn) - every / 5) < 5 * (every * 0.16) ** 0.5
        assert {r.g for r in drawn} == {"x", "y"}
        by_first = Counter(r.firstname for r in drawn if r.g == "x")
        assert len(by_first) == 90 and max(by_first.values()) < 16 + 6 * 13**0.5
    assert sorted(drawn) == sorted(names.drawn_pairs(first, last, "g", seed=3, n=every // 5).collect())
    assert names.drawn_pairs(first, last, "g", share=1.0).count() == every
    assert names.drawn_pairs(first, last, "g", n=0.0001 * every).count() < 12
    with pytest.raises(ValueError):
        names.drawn_pairs(first, last, "g", share=0.0)


def test_gaps_are_geometric():
    rng = np.random.default_rng(0)
    kept = [names._gaps(rng, 0.25, 1000) for _ in range(200)]
    assert all((np.diff(k) > 0).all() and k.min() >= 0 and k.max() < 1000 for k in kept)
    total = np.bincount(np.concatenate(kept), minlength=1000)
    assert abs(total.mean() - 50) < 1 and abs(total[:10].mean() - 50) < 10 and abs(total[-10:].mean() - 50) < 10
    huge = names._gaps(rng, 1e-12, 10**15)
    assert 800 < len(huge) < 1200 and len(names._gaps(rng, 1.0, 50)) == 50


def test_a_share_finer_than_the_hash_is_refused(spark):
    with pytest.raises(ValueError, match="finer"):
        names.by_share(1e-12, 1)(F.lit("g"), F.lit(1))


def test_popularity(spark, rows):
    rated = spark.createDataFrame(
        [("a", 1), ("a", 2), ("b", 1), ("b", None), ("c", 3), ("c", 3), ("x", 1), ("x", 1), ("x", 1)],
        "isbn string, rating int",
    )
    books = spark.createDataFrame([("a", "A"), ("b", "B"), ("c", "C")], "isbn string, title string")
    got = rec.popular_items(rated, books, k=3)
    assert rows(got) == [("a", 2, "A"), ("c", 2, "C")]


@pytest.fixture(scope="module")
def planted(spark):
    """Ratings of a rank-2 matrix, with repeats and one very busy user."""
    rng = np.random.default_rng(5)
    u, v = rng.uniform(0.5, 1.5, (40, 2)), rng.uniform(0.5, 1.5, (30, 2))
    data = [
        (f"u{a}", f"i{b}", float(u[a] @ v[b]))
        for a in range(40) for b in range(30) if a == 0 or rng.random() < 0.5
    ]
    data += data[:200]
    df = spark.createDataFrame(data, "user_id string, isbn string, rating double")
    return rec.encode(df, "user_id", "isbn")


@pytest.fixture(scope="module", params=["library", "split"])
def fitted(planted, request):
    return rec.fit(planted.ratings, rank=4, seed=3, solver=request.param)


def test_encoding(planted):
    assert planted.users.count() == 40 and planted.items.count() == 30
    assert planted.users.orderBy("user_num").first().user_id == "u0"
    assert planted.ratings.filter("user_num is null or item_num is null").count() == 0


def test_predictions_are_dot_products(planted, fitted):
    users = {r.id: np.array(r.features) for r in fitted.users.collect()}
    items = {r.id: np.array(r.features) for r in fitted.items.collect()}
    scored = rec.score(fitted, planted.ratings).collect()
    assert len(scored) == planted.ratings.count()
    for r in scored[::50]:
        assert abs(users[r.user_num] @ items[r.item_num] - r.prediction) < 1e-4
    if fitted.model:
        theirs = fitted.model.transform(planted.ratings).agg(F.sum("prediction")).first()[0]
        assert abs(sum(r.prediction for r in scored) - theirs) < 1e-2


def test_user_vectors_solve_their_equations(planted, fitted):
    items = {r.id: np.array(r.features, dtype=float) for r in fitted.items.collect()}
    users = {r.id: np.array(r.features, dtype=float) for r in fitted.users.collect()}
    rated = {}
    for r in planted.ratings.collect():
        rated.setdefault(r.user_num, []).append((items[r.item_num], r.rating))
    for user, seen in rated.items():
        gram = sum(np.outer(v, v) for v, _ in seen) + rec.REG * len(seen) * np.eye(4)
        right = sum(x * v for v, x in seen)
        assert np.allclose(gram @ users[user], right, rtol=1e-3, atol=1e-2)


def test_planted_structure_is_found(planted, fitted):
    error = aggregates.rmse(rec.score(fitted, planted.ratings)).first().rmse
    assert error < 0.3 * aggregates.mean_baseline_rmse(planted.ratings).first().rmse


def test_recommendations(planted, fitted):
    asked = [r[0] for r in aggregates.distinct_first(planted.ratings, rec.USER, 3).collect()]
    got = rec.recommend(fitted, asked, 3).collect()
    assert sorted({r.user_num for r in got}) == [0, 1, 2] and len(got) == 9
    items = {r.id: np.array(r.features) for r in fitted.items.collect()}
    users = {r.id: np.array(r.features) for r in fitted.users.collect()}
    for user in (0, 1, 2):
        best = sorted((float(users[user] @ v) for v in items.values()), reverse=True)[:3]
        mine = sorted((r.rating for r in got if r.user_num == user), reverse=True)
        assert np.allclose(best, mine, atol=1e-4)
    decoded = rec.decode(rec.recommend(fitted, asked, 100), planted).collect()
    assert len(decoded) == 90 and {r.isbn[0] for r in decoded} == {"i"}
    of_items = rec.recommend(fitted, [0, 1], 3, by=rec.ITEM)
    assert of_items.count() == 6
    assert rec.recommend(fitted, [], 3).count() == 0


def test_recommend_all_agrees(planted, fitted):
    users = {r.id: np.array(r.features) for r in fitted.users.collect()}
    items = {r.id: np.array(r.features) for r in fitted.items.collect()}
    for by, this, other in ((rec.USER, users, items), (rec.ITEM, items, users)):
        got = {}
        for r in rec.recommend_all(fitted, 3, by).collect():
            got.setdefault(r[by], []).append(r.rating)
        for i, vector in this.items():
            want = sorted((float(vector @ o) for o in other.values()), reverse=True)[:3]
            assert np.allclose(sorted(got[i], reverse=True), want, rtol=1e-4)


def test_unseen_users_and_items_are_dropped(spark, planted, fitted):
    rows = spark.createDataFrame(
        [(0, 0, 1.0), (999, 0, 1.0), (0, 999, 1.0)], "user_num int, item_num int, rating double"
    )
    assert rec.score(fitted, rows).count() == 1
    assert rec.known_rows(rows, planted.ratings).count() == 1


def test_implicit_split_equals_spark(planted):
    """Both solvers from the same item factors give the same user factors."""
    ratings = planted.ratings
    model = rec.fit(ratings, rank=3, iterations=6, seed=1, implicit=True, alpha=0.5, solver="library")
    again = split.half_step(
        ratings, model.items, rec.USER, rec.ITEM, 3, rec.REG, implicit=True, alpha=0.5
    )
    want = {r.id: r.features for r in model.users.collect()}
    got = {r.id: r.features for r in again.collect()}
    assert want.keys() == got.keys()
    for user in want:
        assert np.allclose(want[user], got[user], atol=1e-3)


def test_triplets(spark):
    triplets = spark.createDataFrame(
        [(u, i, float((u * i) % 5)) for u in range(12) for i in range(9)] + [(None, 1, 2.0)],
        "user int, item int, rating double",
    )
    fitted = rec.fit_triplets(triplets, seed=1)
    assert fitted.users.count() == 12
    assert len(fitted.users.first().features) == rec.TRIPLET_RANK


def test_top_products_end_early():
    rng = np.random.default_rng(2)
    items = rng.normal(size=(5000, 4)) * rng.lognormal(sigma=1.5, size=(5000, 1))
    users = rng.normal(size=(50, 4))
    order = np.argsort(-np.linalg.norm(items, axis=1), kind="stable")
    found, computed = top_products.best_in((np.arange(50), users), [(order, items[order])], 3)
    assert computed < 0.5 * 50 * 5000
    for u in range(50):
        want = np.argsort(-(items @ users[u]), kind="stable")[:3]
        assert [i for a, i, _ in found if a == u] == want.tolist()


def test_top_products_in_many_blocks(spark, monkeypatch):
    for name, value in (("BLOCK_ROWS", 7), ("GROUP_ROWS", 10), ("SLICE_ROWS", 20), ("STEP", 3)):
        monkeypatch.setattr(top_products, name, value)
    rng = np.random.default_rng(4)
    data = [(i, [float(x) for x in rng.integers(-3, 4, 3)]) for i in range(60)]  # many ties
    table = spark.createDataFrame(data, "id long, features array<float>").repartition(3)
    few = table.filter("id % 3 = 0")
    got = sorted(map(tuple, top_products.top_products(few, table, 4).collect()))
    want = []
    for a, x in data[::3]:
        ranked = sorted((-float(np.dot(x, y)), i) for i, y in data)[:4]
        want += [(a, i, -p) for p, i in ranked]
    assert got == sorted(want)
    assert top_products.top_products(few, table.limit(0), 4).count() == 0
    assert len({r.id for r in top_products.top_products(few, table.filter("id < 2"), 4).collect()}) == 2


def test_a_saved_model_goes_on(spark, tmp_path, planted):
    path = str(tmp_path / "model")
    with pytest.raises(ValueError, match="complete"):
        rec.load(spark, path)
    rec.save(path, planted, rec.fit(planted.ratings, rank=2, iterations=2))
    known, factors = rec.load(spark, path)
    assert factors.rank == 2 and known.users.count() == 40
    more = spark.createDataFrame(
        [("new2", "i1", 1.0), ("u3", "j9", 2.0), ("new1", "i1", 1.0), ("new1", "i2", 3.0), (None, "i1", 1.0)],
        "user_id string, isbn string, rating double",
    )
    grown = rec.encode_more(known, more, "user_id", "isbn")
    before = {r.user_id: r[rec.USER] for r in known.users.collect()}
    after = {r.user_id: r[rec.USER] for r in grown.users.collect()}
    assert after == {**before, "new1": 40, "new2": 41}
    assert {r.isbn: r[rec.ITEM] for r in grown.items.collect()}["j9"] == 30
    counts = {r.user_id: r.n for r in grown.users.collect()}
    assert counts["new1"] == 2 and counts["u3"] == {r.user_id: r.n for r in known.users.collect()}["u3"] + 1
    start = rec.start_from(factors, grown)
    assert start.count() == 42 and start.select("id").distinct().count() == 42
    every = known.ratings.unionByName(grown.ratings)
    refitted = rec.fit(every, rank=2, iterations=2, start=start)
    assert refitted.users.count() == 42 and refitted.items.count() == 31
    again = rec.encode_more(grown, more.limit(0), "user_id", "isbn")
    assert {r.user_id: r[rec.USER] for r in again.users.collect()} == after


def test_half_steps_send_packed_ratings(spark):
    """No row of sums per task and id is sent: the only exchange deals packed ratings and vectors to blocks."""
    rng = np.random.default_rng(3)
    rows = [(int(u), int(i), float(r)) for u, i, r in zip(*rng.integers(0, 300, (2, 4000)), rng.integers(0, 9, 4000))]
    ratings = spark.createDataFrame(rows, "user_num long, item_num long, rating double")
    fixed = split.starting_factors(ratings.select(F.col("item_num").alias("id")).distinct(), 10, 5)
    fixed = spark.createDataFrame(fixed.collect(), split.FACTOR_SCHEMA)
    found = split.half_step(ratings, fixed, rec.USER, rec.ITEM, 10, 0.1)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "Join" not in plan and plan.count("Exchange") == 1


@pytest.mark.parametrize("implicit", [False, True])
def test_blocks_slices_and_hot_ids(spark, monkeypatch, implicit):
    """Many small blocks and slices, lists of who needs a vector, one user with half of all ratings."""
    for name, value in (("BLOCK_BYTES", 400), ("SLICE_IDS", 20), ("PIECE", 50), ("BUFFER", 300)):
        monkeypatch.setattr(blocks, name, value)
    rng = np.random.default_rng(8)
    rows = [(-7 if k % 2 else int(u) - 40, int(i) * 10**12, None if k == 5 else float(r))
            for k, (u, i, r) in enumerate(zip(*rng.integers(0, 90, (2, 5000)), rng.integers(-2, 5, 5000)))]
    rows += [(None, 1, 2.0), (1, None, 2.0), (2, 77, 3.0)]  # no user, no item, an item without a vector
    ratings = spark.createDataFrame(rows, "user_num long, item_num long, rating double").repartition(5)
    vectors = {int(i) * 10**12: rng.normal(size=3).astype(np.float32) for i in range(90)}
    fixed = spark.createDataFrame([(i, v.tolist()) for i, v in vectors.items()], split.FACTOR_SCHEMA)
    side = blocks.lay_out(split._plain(ratings, rec.USER, rec.ITEM), rec.USER, rec.ITEM, split._width(3))
    assert side.hot == (-7,) and side.blocks > blocks.ALL_BLOCKS and side.needs is not None and side.slices > 1
    got = {r.id: r.features for r in split.half_step(ratings, fixed, rec.USER, rec.ITEM, 3, 0.1, implicit, 0.5).collect()}
    seen = {}
    for u, i, r in rows:
        if u is not None and i in vectors:
            seen.setdefault(u, []).append((vectors[i].astype(float), 0.0 if r is None else r))
    assert got.keys() == seen.keys()
    whole = sum(np.outer(v, v) for v in (x.astype(float) for x in vectors.values()))
    for user, rated in seen.items():
        weight = [0.5 * abs(r) if implicit else 1.0 for _, r in rated]
        target = [(1 + 0.5 * r if r > 0 else 0.0) if implicit else r for _, r in rated]
        n = sum(r > 0 for _, r in rated) if implicit else len(rated)
        gram = sum(w * np.outer(v, v) for w, (v, _) in zip(weight, rated)) + 0.1 * n * np.eye(3) + (whole if implicit else 0)
        assert np.allclose(np.linalg.solve(gram, sum(t * v for t, (v, _) in zip(target, rated))), got[user], rtol=1e-4, atol=1e-5)


def test_chunks_are_read_back():
    rng = np.random.default_rng(1)
    for n in (1, 2, 700):
        solved, given, rating = rng.integers(-2**62, 2**62, n), rng.integers(-50, 50, n), rng.normal(size=n)
        back = blocks.unpack(blocks.pack(solved, given, rating))
        assert sorted(zip(back[0], back[1][back[2]], back[3])) == sorted(zip(solved, given, rating))


def test_narrow_rows_are_scored_in_blocks(spark, monkeypatch):
    """The same rows and scores as by joins, with many blocks, an item with half of the rows and null ratings."""
    for name, value in (("BLOCK_BYTES", 100), ("SLICE_IDS", 20), ("PIECE", 50), ("BUFFER", 300)):
        monkeypatch.setattr(blocks, name, value)
    rng = np.random.default_rng(6)
    rows = [(int(u), 3 if k % 2 else int(i), None if k % 50 == 0 else int(k % 7)) for k, (u, i) in enumerate(rng.integers(0, 70, (5000, 2)))]
    rows += [(None, 1, 2), (1, None, 2), (999, 1, 2), (1, 999, 2)]
    table = spark.createDataFrame(rows, "user_num long, item_num int, rating int").repartition(4)
    sides = [spark.createDataFrame([(i, rng.normal(size=3).tolist()) for i in range(70)], split.FACTOR_SCHEMA) for _ in range(2)]
    factors = rec.Factors(*sides, 3)
    found = rec.score(factors, table)
    assert found.columns == ["user_num", "item_num", "rating", "prediction"]
    assert Counter(map(tuple, found.collect())) == Counter(map(tuple, rec._joined_scores(factors, table).collect()))
