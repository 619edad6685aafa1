"""Models against closed forms, saved and loaded pipelines, features against plain Python."""

import collections
import math
import re

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from pricebench.catalog import views as V
from pricebench.models import growing, linear, trees
from pricebench.models.linear import CLASSICAL_FLOOR, ridge, truncated_svd
from pricebench.models.sparse import SparseTable
from pricebench.models.base import PriceModel
from pricebench.models.registry import REGISTRY, create
from pricebench.models.trees import rounds_to_keep
from pricebench.operators import features as FE
from pricebench.operators.evaluate import leaderboard
from pricebench.plans.compare import compare, compare_models
from pricebench.plans.train import score_texts, train_and_save
from pricebench.session import write_through

SMALL = {"rows": None, "stop_words": V.STOP_WORDS}


@pytest.fixture(scope="module")
def curated(spark, sf_dir):
    return write_through(V.split_items(spark, sf_dir), "items")


@pytest.fixture(scope="module")
def train(curated):
    return curated.filter("split = 'train'")


@pytest.fixture(scope="module")
def test(curated):
    return curated.filter("split = 'test'")


def item_text(row):
    return row["summary"] or row["full"] or row["title"]


def tokens(text):
    return [t for t in re.findall(r"(?u)\b\w\w+\b", text.lower()) if t not in V.STOP_WORDS]


def counts_matrix(rows, size):
    docs = [collections.Counter(tokens(item_text(r))) for r in rows]
    df, n = collections.Counter(), collections.Counter()
    for doc in docs:
        df.update(doc.keys())
        n.update(doc)
    terms = sorted((t for t in n if df[t] >= 2), key=lambda t: (-n[t], t))[:size]
    return np.array([[d[t] for t in terms] for d in docs], dtype=float), terms, df


def guesses(model, items):
    return {r["id"]: r["guess"] for r in model.transform(items).collect()}


def inverse(log_price):
    return np.maximum(np.expm1(log_price), CLASSICAL_FLOOR)


def test_vectoriser(train):
    rows = train.collect()
    matrix, terms, df = counts_matrix(rows, 300)
    plain = FE.Vectoriser(300, stop_words=V.STOP_WORDS).fit(train)
    assert plain.terms == terms
    found = {r["id"]: r["features"].toArray() for r in plain.transform(train).collect()}
    assert all((found[r["id"]] == matrix[i]).all() for i, r in enumerate(rows))
    idf = np.array([math.log((1 + len(rows)) / (1 + df[t])) + 1 for t in terms])
    weighted = matrix * idf
    weighted /= np.maximum(np.linalg.norm(weighted, axis=1, keepdims=True), 1e-300)
    tfidf = FE.Vectoriser(300, tfidf=True, stop_words=V.STOP_WORDS).fit(train)
    found = {r["id"]: r["features"].toArray() for r in tfidf.transform(train).collect()}
    assert all(np.allclose(found[r["id"]], weighted[i]) for i, r in enumerate(rows))


def test_default_stop_words(train):
    words = {r["term"] for r in FE.token_counts(FE.tokenise(train)).collect()}
    assert "the" not in words and len(words) > 100


def test_features_pricer_is_least_squares(train, test):
    def x(rows):
        texts = [item_text(r) for r in rows]
        return np.array(
            [[1, r["weight"] or 0.0, float(not r["weight"]), len(t), t.count(" ") + 1] for r, t in zip(rows, texts)]
        )

    fitted, held = train.collect(), test.collect()
    beta, *_ = np.linalg.lstsq(x(fitted), np.log1p([r["price"] for r in fitted]), rcond=None)
    wanted = inverse(x(held) @ beta)
    found = guesses(create("features").fit(train), test)
    assert np.allclose([found[r["id"]] for r in held], wanted, rtol=1e-5)


def closed_form_ridge(x, y, alpha=1.0):
    mean = x.mean(axis=0)
    centred = x - mean
    w = np.linalg.solve(centred.T @ centred + alpha * np.eye(x.shape[1]), centred.T @ (y - y.mean()))
    return w, y.mean() - mean @ w


def test_bow_ridge_is_the_closed_form(train, test):
    rows, held = train.collect(), test.collect()
    matrix, terms, _ = counts_matrix(rows, 120)
    w, b = closed_form_ridge(matrix, np.log1p([r["price"] for r in rows]))
    x = np.array([[collections.Counter(tokens(item_text(r)))[t] for t in terms] for r in held], dtype=float)
    found = guesses(create("bow-linear", max_features=120, **SMALL).fit(train), test)
    assert np.allclose([found[r["id"]] for r in held], inverse(x @ w + b), rtol=1e-4)


def dense_table(spark, x, y, parts=3):
    rows = [(i, Vectors.dense(v), float(t)) for i, (v, t) in enumerate(zip(x, y))]
    return SparseTable(spark.createDataFrame(rows, ["id", "features", "label"]).repartition(parts), x.shape[1], key="id")


@pytest.mark.parametrize("rank", [320, 2])
@pytest.mark.parametrize("shape", [(200, 3), (60, 90)])
def test_ridge_is_the_closed_form(spark, monkeypatch, shape, rank):
    """One solver at every width, with all leading directions known beforehand or few of them."""
    monkeypatch.setattr(linear, "RANK", rank)
    rng = np.random.default_rng(0)
    x = rng.normal(size=shape) * np.geomspace(5, 0.2, shape[1])
    y = x[:, :3] @ [0.3, -0.1, 2.0] + 1.5 + rng.normal(size=shape[0])
    w, b = closed_form_ridge(x, y, 7.0)
    with dense_table(spark, x, y) as table:
        weights, intercept = ridge(table, 7.0, tolerance=1e-10)
    assert np.allclose(weights, w, atol=1e-8) and intercept == pytest.approx(b, abs=1e-8)


def test_orthonormal_columns():
    rng = np.random.default_rng(6)
    easy, hard = rng.normal(size=(300, 20)), rng.normal(size=(300, 20)) * np.geomspace(1, 1e-12, 20)
    hard[:, 7] = hard[:, 6] + 1e-13 * hard[:, 8]
    for matrix in (easy, hard, np.zeros((30, 3)), np.ones((30, 2))):
        found = linear.orthonormal(matrix)
        assert np.allclose(found.T @ found, np.eye(matrix.shape[1]), atol=1e-10)
        assert np.allclose(found @ (found.T @ matrix), matrix, atol=1e-9)


def test_ridge_that_does_not_settle_raises(spark, monkeypatch):
    monkeypatch.setattr(linear, "RANK", 2)
    rng = np.random.default_rng(0)
    with dense_table(spark, rng.normal(size=(50, 40)) * np.geomspace(1, 1e3, 40), rng.normal(size=50)) as table:
        with pytest.raises(RuntimeError):
            ridge(table, 1e-3, steps=3)


def test_wide_bag_of_words_is_the_closed_form(train, test):
    """Every term of the corpus, more terms than rows."""
    rows, held = train.collect(), test.collect()
    matrix, terms, _ = counts_matrix(rows, 20_000)
    assert len(terms) > 3 * len(rows)
    w, b = closed_form_ridge(matrix, np.log1p([r["price"] for r in rows]))
    x = np.array([[collections.Counter(tokens(item_text(r)))[t] for t in terms] for r in held], dtype=float)
    model = create("bow-linear", **SMALL).fit(train)
    found = np.array([guesses(model, test)[r["id"]] for r in held])
    assert np.allclose(np.log1p(found), np.log1p(inverse(x @ w + b)), atol=2e-4)


def test_svd(spark, train, test, tmp_path):
    vectoriser = FE.Vectoriser(150, tfidf=True, stop_words=V.STOP_WORDS).fit(train)
    dense = np.array([r["features"].toArray() for r in vectoriser.transform(train).orderBy("id").collect()])
    exact = np.linalg.svd(dense, compute_uv=False)
    with SparseTable(linear.with_label(vectoriser.transform(train)), 150) as table:
        values, basis = truncated_svd(table, 5)
        assert table.passes == 10
        assert np.allclose(values, exact[:5], rtol=1e-6) and np.allclose(basis.T @ basis, np.eye(5), atol=1e-10)
        assert np.allclose(truncated_svd(table, 140)[0], exact[:140], rtol=1e-9)
    residual = dense.T @ (dense @ basis) - basis * values**2
    assert np.abs(residual).max() < 1e-4 * values[0] ** 2
    model = create("svd-ridge", components=5, max_features=150, **SMALL).fit(train)
    log_prices = np.log1p([r["price"] for r in train.orderBy("id").collect()])
    w, b = closed_form_ridge(dense @ model.basis, log_prices)
    held = np.array([r["features"].toArray() for r in vectoriser.transform(test).orderBy("id").collect()])
    found = guesses(model, test)
    assert np.allclose([found[k] for k in sorted(found)], inverse(held @ model.basis @ w + b), rtol=1e-6)
    reduced = {r["id"]: r["reduced"].toArray() for r in model.reduce(test).collect()}
    assert np.allclose([reduced[k] for k in sorted(reduced)], held @ model.basis, atol=1e-10)
    model.save(f"{tmp_path}/svd")
    loaded = create("svd-ridge").load(f"{tmp_path}/svd")
    assert guesses(loaded, test) == pytest.approx(found) and np.array_equal(loaded.basis, model.basis)


@pytest.mark.parametrize("direct", [0, 1 << 20])
def test_blocks_hold_every_row(spark, monkeypatch, direct):
    """Empty rows, rows larger than a block, sums cut into chunks, added up by tasks or by the driver."""
    from pricebench.models import sparse

    monkeypatch.setattr(sparse, "DIRECT_BYTES", direct)
    rng = np.random.default_rng(1)
    x = np.where(rng.random((37, 50)) < 0.3, rng.normal(size=(37, 50)), 0.0)
    x[[0, 5, 36]] = 0
    x[7] = 1.0
    y = rng.normal(size=37)
    rows = [(i, Vectors.sparse(50, {int(j): v[j] for j in np.flatnonzero(v)}), float(t)) for i, (v, t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, ["id", "features", "label"])
    monkeypatch.setattr(sparse, "BLOCK_ENTRIES", 20)
    monkeypatch.setattr(sparse, "CHUNK", 7)
    with SparseTable(df.repartition(3), 50) as table:
        assert table.number == 37
        matrix = rng.normal(size=(50, 3))
        assert np.allclose(table.gram_times(matrix), x.T @ (x @ matrix))
        moments = table.moments()
        assert np.allclose(moments.sums, x.sum(axis=0)) and np.allclose(moments.squares, (x**2).sum(axis=0))
        assert np.allclose(moments.with_target, x.T @ y) and (moments.n, moments.target) == (37, pytest.approx(y.sum()))
        assert table.passes == 2
    with SparseTable(df.limit(0), 50) as empty:
        assert empty.number == 0 and not empty.gram_times(matrix).any()


@pytest.mark.parametrize("block", [1, 1 << 22])
def test_projection_of_empty_rows(spark, monkeypatch, block):
    monkeypatch.setattr(linear, "BLOCK", block)
    basis = np.arange(8.0).reshape(4, 2)
    entries = [{}, {0: 2.0, 3: 1.0}, {}, {1: 1.0}, {}]
    df = spark.createDataFrame([(i, Vectors.sparse(4, e)) for i, e in enumerate(entries)], ["n", "features"]).coalesce(1)
    found = [r["out"].toArray().tolist() for r in linear.project(df, basis, "out").orderBy("n").collect()]
    assert found == [[0, 0], [6, 9], [0, 0], [2, 3], [0, 0]]


def test_random_forest_stays_below_the_top_price(train, test, tmp_path):
    model = create("random-forest", max_features=60, trees=4, **SMALL).fit(train)
    top = train.agg(F.max("price")).first()[0]
    before = guesses(model, test)
    assert all(CLASSICAL_FLOOR <= g <= top + 1e-9 for g in before.values())
    model.save(f"{tmp_path}/forest")
    assert guesses(create("random-forest").load(f"{tmp_path}/forest"), test) == before


def test_rounds_to_keep():
    assert rounds_to_keep([5, 4, 3, 3.5, 3.4, 1], patience=2) == 3
    assert rounds_to_keep([5, 4, 3, 3.5, 1, 2], patience=2) == 5
    assert rounds_to_keep([1, 2, 3], patience=40) == 1


def test_boosted_trees_stop_early(monkeypatch, curated, train, test):
    """The kept trees are the first ones of the same fit: no tree is grown twice."""
    grown = []
    monkeypatch.setattr(trees, "grow", lambda table, task, numbers: grown.extend(numbers) or growing.grow(table, task, numbers))
    monkeypatch.setattr(trees, "ROUNDS_PER_CHECK", 2)
    parameters = dict(max_features=60, rounds=6, max_depth=2, patience=1, **SMALL)
    full = create("boosted-trees", **parameters).fit(train)
    assert grown == list(range(6)) and len(full.trees) == 6
    grown.clear()
    stopped = create("boosted-trees", **parameters).fit(train, curated.filter("split = 'validation'"))
    assert grown == list(range(len(grown))) and len(stopped.trees) == rounds_to_keep(stopped.losses, 1) <= len(grown)
    assert [t.packed() for t in stopped.trees] == [t.packed() for t in full.trees[: len(stopped.trees)]]
    assert len(guesses(stopped, test)) == test.count()


def test_huber_and_round_trip(curated, test, tmp_path):
    model = create("hashed-huber", buckets=256, max_iter=10, **SMALL)
    scored = train_and_save(curated, model, f"{tmp_path}/model")
    loaded = create("hashed-huber").load(f"{tmp_path}/model")
    assert guesses(loaded, test) == guesses(model, test)
    assert scored.agg(F.min("guess")).first()[0] >= 0.0


def test_huber_loss_and_descent(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(80, 6)) * [1, 2, 0.5, 1, 3, 0] + 2.0
    y = x @ [0.5, -0.2, 0.1, 0, 0, 0] + rng.standard_t(2, size=80)
    mean, sd = x.mean(axis=0), x.std(axis=0)
    z = np.divide(x - mean, sd, out=np.zeros_like(x), where=sd > 1e-12)

    def plain(parameters, penalty):
        residual = y - z @ parameters[:-1] - parameters[-1]
        pull = np.clip(residual, -1, 1)
        value = linear.smooth_l1(residual).mean() + penalty / 2 * parameters[:-1] @ parameters[:-1]
        return value, np.append(penalty * parameters[:-1] - z.T @ pull / 80, -pull.mean())

    with dense_table(spark, x, y) as table:
        loss = linear.HuberLoss(table)
        for at in (np.zeros(7), rng.normal(size=7)):
            value, slope = loss(at, 0.3)
            assert value == pytest.approx(plain(at, 0.3)[0]) and np.allclose(slope, plain(at, 0.3)[1])
        found = linear.descend(lambda p: loss(p, 0.1), np.zeros(7), 100, 1e-12)
        weights, intercept = loss.plain(found)
        assert np.abs(plain(found, 0.1)[1]).max() < 1e-4  # nothing left to gain
        assert np.allclose(x @ weights + intercept, z @ found[:-1] + found[-1])


def test_penalty_is_chosen_on_validation_rows_alone(spark, curated, train):
    """The path ends after two steps without gain, and no test row is read while fitting."""
    read = spark.sparkContext.accumulator(0)

    @F.pandas_udf("string")
    def watched(split, text):
        read.add(int((split == "test").sum()))
        return text

    items = curated.withColumn("full", watched("split", "full"))
    validation = items.filter("split = 'validation'")
    model = create("hashed-huber", buckets=256, max_iter=20, **SMALL).fit(items.filter("split = 'train'"), validation)
    assert read.value == 0
    errors = [error for _, error in model.path]
    best = errors.index(min(errors))
    assert model.validation_mae == errors[best] and len(errors) in (best + 3, len(model.penalties))
    assert [p for p, _ in model.path] == list(model.penalties[: len(errors)])
    found = model.transform(validation).agg(F.avg(F.abs(F.col("guess") - F.col("price")))).first()[0]
    assert found == pytest.approx(model.validation_mae)
    alone = create("hashed-huber", buckets=256, max_iter=20, **SMALL).fit(train)
    assert len(alone.path) >= 3 and np.isfinite(alone.validation_mae)


def test_huber_guesses_stay_in_reach(curated, train, test):
    error = lambda model: model.transform(test).agg(F.avg(F.abs(F.col("guess") - F.col("price")))).first()[0]
    huber = create("hashed-huber", **SMALL).fit(train, curated.filter("split = 'validation'"))
    assert error(huber) < 1.5 * error(create("average").fit(train))


def test_baselines(spark, train, test):
    assert len({g for g in guesses(create("random"), train).values()}) > 50
    assert guesses(create("random"), train.repartition(9)) == guesses(create("random"), train)
    mean = train.agg(F.avg("price")).first()[0]
    assert all(g == pytest.approx(mean) for g in guesses(create("average").fit(train), test).values())
    known = train.filter("category <> 'click'")
    overall = known.agg(F.avg("price")).first()[0]
    model = create("category-average").fit(known)
    rows = model.transform(test).collect()
    by_category = {r["category"]: r["m"] for r in known.groupBy("category").agg(F.avg("price").alias("m")).collect()}
    assert all(r["guess"] == pytest.approx(by_category.get(r["category"], overall)) for r in rows)
    texts = test.select("id", F.col("full").alias("text"))
    assert all(r["guess"] == pytest.approx(overall) for r in score_texts(texts, model).collect())


@pytest.mark.parametrize("name", ["average", "category-average"])
def test_baselines_hold_and_save_their_state(train, test, name, tmp_path):
    model = create(name).fit(train)
    before = guesses(model, test)
    model.save(str(tmp_path / "model"))
    assert guesses(create(name).load(str(tmp_path / "model")), test) == pytest.approx(before)


def test_each_row_is_scored_once(spark, curated):
    scored = spark.sparkContext.accumulator(0)

    class Counting(PriceModel):
        display_name = "counting"

        def transform(self, items):
            @F.pandas_udf("double")
            def count(ids):
                scored.add(len(ids))
                return ids * 1.0

            return items.withColumn("guess", count("id"))

    predictions = compare(curated, [Counting()], 20)
    leaderboard(predictions).collect()
    predictions.count()
    assert scored.value == predictions.count() > 0


def test_texts_are_split_up_once(spark, curated):
    """Five models that read words, one table of tokens: every text is read by one scan, and the guesses stay."""
    read = spark.sparkContext.accumulator(0)

    @F.pandas_udf("string")
    def watched(text):
        read.add(len(text))
        return text

    def models():
        small = dict(max_features=40, **SMALL)
        return [
            create("bow-linear", **small),
            create("svd-ridge", components=3, **small),
            create("random-forest", trees=2, **small),
            create("boosted-trees", rounds=2, **small),
            create("hashed-huber", buckets=64, max_iter=3, **SMALL),
        ]

    together = compare(curated.withColumn("full", watched("full")), models(), 30)
    assert read.value == curated.count()
    alone = [r for model in models() for r in compare(curated, [model], 30).collect()]
    key = lambda r: (r["model"], r["id"])
    assert {key(r): r["guess"] for r in together.collect()} == pytest.approx({key(r): r["guess"] for r in alone}, rel=1e-3)


def test_training_average_has_no_r2(curated):
    train = curated.filter("split = 'train'")
    board = compare_models(train.withColumn("split", F.lit("test")).unionByName(train), [create("average")], 10_000)
    assert board.first()["r2"] == pytest.approx(0.0, abs=1e-6)


def test_compare(spark, sf_dir, curated):
    models = [create(n) for n in ("random", "average", "category-average")]
    models.append(create("zero-shot", replies=V.replies(spark, sf_dir), model="some/name"))
    rows = compare(curated, models, 10).collect()
    ids = collections.defaultdict(set)
    for r in rows:
        ids[r["model"]].add(r["id"])
    assert set(ids) == {"random guess", "training average", "category average", "zero-shot name"}
    assert len({frozenset(v) for v in ids.values()}) == 1 and len(rows) == 40


def test_registry():
    assert len(REGISTRY) == 10
