"""One query per operator, each over the whole given tables."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricebench.catalog import views as V
from pricebench.functions import text as X
from pricebench.models.registry import create
from pricebench.operators import dedup, describe, evaluate, features, requests, sample, split
from pricebench.operators import items as I
from pricebench.operators import parse as P
from pricebench.operators.validate import validate_items
from pricebench.plans.compare import compare, compare_models
from pricebench.plans.curate import curate
from pricebench.plans.train import score_texts
from pricebench.sources import listings as L
from pricebench.sources import reports as R
from pricebench.sources import splits as S
from pricebench.session import new_folder, write_through
from pricebench.streaming.parse import parse_new_listings

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SAMPLE_ROWS = 200
SLICE_ROWS = evaluate.SLICE_ROWS
VALIDATION_ROWS = 2_000
CAP_ROWS = 300


def query(function: Query, name: str | None = None) -> Query:
    QUERIES[name or function.__name__] = function
    return function


def named(name: str) -> Callable[[Query], Query]:
    """For queries whose own name would hide a function that they call."""
    return lambda function: query(function, name)


def r6(column: Column | str) -> Column:
    """Sums and means to six decimals, so that the order of summation does not show."""
    return F.round(column, 6)


def sorted_pairs(details: Column) -> Column:
    pairs = F.transform(F.map_entries(details), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return F.array_join(F.sort_array(pairs), "|")


def curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return write_through(V.split_items(spark, sf_dir), "items")


def parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    table = curated(spark, sf_dir)
    return tuple(table.filter(F.col("split") == name) for name in ("train", "validation", "test"))


# Sources and sinks


def _raw_folder(spark, sf_dir):
    path = new_folder(spark, "listings")
    raw = V.listings(spark, sf_dir).drop("src_id").withColumn("description", F.array("description"))
    L.write_listings(raw, path)
    return path


@query
def read_listings(spark, sf_dir):
    listings = L.read_listings(spark, _raw_folder(spark, sf_dir), V.CATEGORIES)
    return listings.select(
        "category",
        "title",
        "price",
        F.array_join("description", "\n").alias("description"),
        F.size("features").cast("bigint").alias("n_features"),
        "details",
    )


@query
def union_categories(spark, sf_dir):
    """Every category's folder is read once."""
    path = _raw_folder(spark, sf_dir)
    tables = {c: L.read_folder(spark, f"{path}/category={c}") for c in V.EVENT_TYPES}
    return L.union_categories(tables).select("category", "title", "price")


@query
def read_splits(spark, sf_dir):
    path = new_folder(spark, "splits")
    S.write_splits(V.split_items(spark, sf_dir), path)
    return S.read_splits(spark, path).select("id", "title", "category", "price", "full", "weight", "summary", "split")


@query
def write_splits(spark, sf_dir):
    """Lines per split, and how many of them spell out the missing prompt and summary."""
    path = new_folder(spark, "splits")
    S.write_splits(V.split_items(spark, sf_dir), path)
    lines = spark.read.text(path)
    null = lambda name: F.count_if(F.contains("value", F.lit(f'"{name}":null')))
    return lines.groupBy("split").agg(
        F.count(F.lit(1)).alias("lines"), null("prompt").alias("no_prompt"), null("summary").alias("no_summary")
    )


@query
def split_counts(spark, sf_dir):
    return split.split_counts(V.split_items(spark, sf_dir))


@named("validate_items")
def validate(spark, sf_dir):
    rows = V.listings(spark, sf_dir).select(
        F.col("src_id").cast("string").alias("id"), "title", "category", "price", F.col("description").alias("full")
    )
    valid, rejects = validate_items(rows)
    return valid.select("id", "price", F.lit("").alias("reason")).unionByName(
        rejects.select(F.col("id").cast("bigint").alias("id"), F.lit(None).cast("double").alias("price"), "reason")
    )



@query
def report_rows(spark, sf_dir):
    path = R.write_report(V.predictions(spark, sf_dir), new_folder(spark, "reports"), "events")
    rows = spark.read.schema(
        "dataset string, model string, id bigint, title string, truth double, guess double"
    ).json(f"{path}/predictions")
    return rows.select("dataset", "model", "id", "title", "truth", "guess")


@query
def report_summary(spark, sf_dir):
    summary = R.report_summary(V.predictions(spark, sf_dir), "events")
    return summary.select("dataset", "model", "n", *[r6(c).alias(c) for c in METRICS])


@query
def scatter_points(spark, sf_dir):
    points = evaluate.scatter_points(V.predictions(spark, sf_dir))
    return points.select("model", "id", "title", "truth", "guess", "band", "colour", "top")


@query
def model_roundtrip(spark, sf_dir):
    """The guesses of a model that was saved and read back."""
    train, _, test = parts(spark, sf_dir)
    model, path = create("features").fit(train), new_folder(spark, "model")
    model.save(path)
    loaded = create("features").load(path)
    return loaded.predictions(test).select("model", "id", "truth", F.round("guess", 4).alias("guess"))


# Parse and clean


@query
def parse_price(spark, sf_dir):
    return V.listings(spark, sf_dir).select("src_id", P.parse_price(F.col("price")).alias("price")).dropna()


@query
def price_filter(spark, sf_dir):
    events = V.table(spark, sf_dir, "events")
    return events.filter(P.in_price_range(F.col("value"))).select("event_id", "value")


def _details(spark, sf_dir):
    return X.with_details(V.listings(spark, sf_dir).select("src_id", "title", "description", "features", "details"))


@query
def parse_details(spark, sf_dir):
    return _details(spark, sf_dir).select("src_id", sorted_pairs(F.col("details_map")).alias("details"))


@query
def drop_detail_keys(spark, sf_dir):
    kept = X.drop_noise(F.col("details_map"))
    return _details(spark, sf_dir).select("src_id", sorted_pairs(kept).alias("details"))


@query
def render_features(spark, sf_dir):
    return V.listings(spark, sf_dir).select("src_id", X.list_text(F.col("features")).alias("features"))


@query
def flatten_text(spark, sf_dir):
    return V.listings(spark, sf_dir).select("src_id", X.flatten(F.col("description")).alias("flat"))


def _bodies(spark, sf_dir):
    raw = _details(spark, sf_dir)
    body = P.assemble_body(
        F.col("title"),
        X.flatten(P.as_text(raw, "description")),
        X.flatten(P.as_text(raw, "features")),
        F.col("details_text"),
    )
    return raw.select("src_id", body.alias("body"))


@query
def assemble_body(spark, sf_dir):
    return _bodies(spark, sf_dir)


@query
def strip_part_numbers(spark, sf_dir):
    documents = V.table(spark, sf_dir, "documents")
    return documents.select("doc_id", X.strip_part_numbers(F.col("text")).alias("stripped"))


@query
def truncate_body(spark, sf_dir):
    documents = V.table(spark, sf_dir, "documents")
    return documents.select("doc_id", F.substring(X.strip(F.col("text")), 1, 4000).alias("cut"))


@query
def min_length_filter(spark, sf_dir):
    documents = V.table(spark, sf_dir, "documents")
    return documents.filter(F.length("text") >= 600).select("doc_id", F.length("text").cast("bigint").alias("chars"))


@query
def weight_in_pounds(spark, sf_dir):
    weight = P.weight_in_pounds(F.try_element_at("details_map", F.lit("Item Weight")))
    return _details(spark, sf_dir).select("src_id", weight.alias("weight"))


@query
def parse_listings(spark, sf_dir):
    return P.parse_listings(V.listings(spark, sf_dir))


@query
def parse_stream(spark, sf_dir):
    """The same listings arriving as files, with the description as a list."""
    out = new_folder(spark, "stream")
    parse_new_listings(spark, _raw_folder(spark, sf_dir), f"{out}/items", f"{out}/state").awaitTermination()
    return spark.read.parquet(f"{out}/items")


@query
def parse_yield(spark, sf_dir):
    return P.parse_yield(V.listings(spark, sf_dir))


# Curation


@query
def seeded_order(spark, sf_dir):
    return dedup.seeded_order(V.items(spark, sf_dir).select("id"), "id")


@query
def dedup_title(spark, sf_dir):
    return dedup.deduplicate(V.items(spark, sf_dir), passes=("_title",)).select("id", "title")


@query
def dedup_body(spark, sf_dir):
    return dedup.deduplicate(V.items(spark, sf_dir), passes=("_body",)).select("id", "full")


@query
def deduplicate(spark, sf_dir):
    return dedup.deduplicate(V.items(spark, sf_dir)).select("id", "category", "title", "price")


@query
def minmax_scale(spark, sf_dir):
    prices = V.items(spark, sf_dir).select("id", "price")
    return sample.minmax_scale(prices).select("id", r6("scaled").alias("scaled"))


@query
def sample_weights(spark, sf_dir):
    weighed = sample.sample_weights(V.items(spark, sf_dir).select("id", "category", "price"), V.DAMPING)
    return weighed.select("id", F.round("sample_weight", 9).alias("sample_weight"))


def _survivors(spark, sf_dir):
    """The narrow columns of the deduplicated items, cut off from the text they came from."""
    kept = dedup.deduplicate(V.items(spark, sf_dir)).select("id", "category", "price")
    return write_through(kept, "survivors")


@query
def balanced_sample(spark, sf_dir):
    return sample.balanced_sample(_survivors(spark, sf_dir), SAMPLE_ROWS, damping=V.DAMPING)


@query
def sample_summary(spark, sf_dir):
    drawn = sample.balanced_sample(_survivors(spark, sf_dir), SAMPLE_ROWS, damping=V.DAMPING)
    return sample.sample_summary(drawn).select("n", r6("mean_price").alias("mean_price"))


@query
def train_val_test_split(spark, sf_dir):
    return V.split_items(spark, sf_dir).select("source_id", "id", "split")


@query
def sequential_ids(spark, sf_dir):
    return split.sequential_ids(V.items(spark, sf_dir).select("id"), "id", name="position")


@query
def describe_prices(spark, sf_dir):
    row = describe.describe_prices(V.items(spark, sf_dir))
    return row.select("n", r6("mean_price").alias("mean_price"), "median_price", "min_price", "max_price")


@query
def category_histogram(spark, sf_dir):
    return describe.category_histogram(V.items(spark, sf_dir))


@named("curate")
def curate_splits(spark, sf_dir):
    return curate(V.listings(spark, sf_dir), SAMPLE_ROWS, key="src_id", damping=V.DAMPING)



# Items


@query
def item_text(spark, sf_dir):
    return V.items(spark, sf_dir).select("id", I.item_text().alias("text"))


@query
def training_prompts(spark, sf_dir):
    return I.with_prompts(V.items(spark, sf_dir)).select("id", "prompt")


@query
def inference_prompts(spark, sf_dir):
    return V.items(spark, sf_dir).select("id", I.inference_prompt().alias("prompt"))


@query
def text_to_items(spark, sf_dir):
    return I.text_to_items(V.table(spark, sf_dir, "documents").select("doc_id", "text")).drop("weight", "summary")


# Features


@query
def token_counts(spark, sf_dir):
    return features.token_counts(features.tokenise(V.items(spark, sf_dir), V.STOP_WORDS))


@query
def vocabulary(spark, sf_dir):
    return features.vocabulary(features.tokenise(V.items(spark, sf_dir), V.STOP_WORDS), V.BOW_TERMS)


def _vectorised(spark, sf_dir, tfidf):
    table = V.items(spark, sf_dir)
    size = V.TFIDF_TERMS if tfidf else V.BOW_TERMS
    vectoriser = features.Vectoriser(size, tfidf, V.STOP_WORDS).fit(table)
    return features.term_entries(vectoriser.transform(table), vectoriser, ["id"])


@query
def bow_counts(spark, sf_dir):
    return _vectorised(spark, sf_dir, False).select("id", "term", F.col("value").cast("bigint").alias("n"))


@query
def tfidf(spark, sf_dir):
    return _vectorised(spark, sf_dir, True).select("id", "term", r6("value").alias("tfidf"))


@query
def hashed_features(spark, sf_dir):
    table = V.items(spark, sf_dir)
    for stage in features.hashing_stages(stop_words=V.STOP_WORDS):
        table = stage.transform(table)
    entries = features.vector_entries(table, ["id"])
    return entries.select("id", F.col("index").alias("bucket"), r6("value").alias("value"))


@query
def svd_features(spark, sf_dir):
    train, _, test = parts(spark, sf_dir)
    reduced = create("svd-ridge", stop_words=V.STOP_WORDS).fit(train).reduce(test)
    return reduced.select("id", F.posexplode(vector_array("reduced")).alias("component", "value")).select(
        "id", "component", F.abs("value").alias("size")
    )


def vector_array(column: str) -> Column:
    return F.unwrap_udt(column)["values"]


@query
def hand_features(spark, sf_dir):
    return features.hand_features(V.items(spark, sf_dir)).select(
        "id", "weight", "weight_missing", "text_length", "word_count"
    )


@query
def log_target(spark, sf_dir):
    return V.items(spark, sf_dir).select("id", r6(features.log_target(F.col("price"))).alias("target"))


@query
def inverse_target(spark, sf_dir):
    shifted = features.log_target(F.col("price")) - 1
    back = lambda floor: r6(features.inverse_target(shifted, floor))
    return V.items(spark, sf_dir).select("id", back(0.5).alias("classical"), back(0.0).alias("hashed"))


@query
def standardise_target(spark, sf_dir):
    logs = V.items(spark, sf_dir).select("id", features.log_target(F.col("price")).alias("target"))
    return features.standardise(logs, "target", "scaled").select("id", r6("scaled").alias("scaled"))


@query
def train_cap(spark, sf_dir):
    return features.train_cap(V.part(spark, sf_dir, "train"), CAP_ROWS).select("id", "source_id", "price")


# Models


def _score(spark, sf_dir, name, **parameters):
    train, validation, test = parts(spark, sf_dir)
    model = create(name, **parameters)
    if model.needs_training:
        model.fit(train, validation)
    return model.predictions(test).select("model", "id", "truth", F.round("guess", 4).alias("guess"))


@query
def model_random(spark, sf_dir):
    return create("random").transform(V.items(spark, sf_dir)).select("id", "guess")


@query
def model_average(spark, sf_dir):
    model = create("average").fit(V.part(spark, sf_dir, "train"))
    return model.transform(V.part(spark, sf_dir, "test")).select("id", r6("guess").alias("guess"))


@query
def model_category_average(spark, sf_dir):
    train = V.part(spark, sf_dir, "train").filter(F.col("category") != V.WITHHELD)
    model = create("category-average").fit(train)
    return model.transform(V.items(spark, sf_dir)).select("id", "category", r6("guess").alias("guess"))


@query
def model_features(spark, sf_dir):
    return _score(spark, sf_dir, "features")


@query
def model_bow_ridge(spark, sf_dir):
    return _score(spark, sf_dir, "bow-linear", stop_words=V.STOP_WORDS)


@query
def model_svd_ridge(spark, sf_dir):
    return _score(spark, sf_dir, "svd-ridge", stop_words=V.STOP_WORDS)


@query
def model_random_forest(spark, sf_dir):
    return _score(spark, sf_dir, "random-forest", stop_words=V.STOP_WORDS)


@query
def model_boosted_trees(spark, sf_dir):
    return _score(spark, sf_dir, "boosted-trees", stop_words=V.STOP_WORDS)


@query
def model_hashed_huber(spark, sf_dir):
    return _score(spark, sf_dir, "hashed-huber", stop_words=V.STOP_WORDS)


@query
def zero_shot_requests(spark, sf_dir):
    asked = requests.zero_shot_requests(V.items(spark, sf_dir))
    return asked.select(
        "id",
        F.col("messages")[0]["content"].alias("system"),
        F.col("messages")[1]["content"].alias("user"),
        "temperature",
        F.col("max_tokens").cast("bigint").alias("max_tokens"),
    )


@query
def price_replies(spark, sf_dir):
    scored = requests.price_replies(V.items(spark, sf_dir).select("id", "price"), V.replies(spark, sf_dir))
    return scored.select("id", "price", "guess")


@query
def validation_mae(spark, sf_dir):
    model = create("category-average").fit(V.part(spark, sf_dir, "train"))
    scored = model.transform(V.part(spark, sf_dir, "validation").select("id", "category", "price"))
    return evaluate.validation_mae(scored, VALIDATION_ROWS).select(r6("mae").alias("mae"))


@named("score_texts")
def score_free_texts(spark, sf_dir):
    """Free texts have no category, so the mean of all training prices is their guess."""
    model = create("average").fit(V.part(spark, sf_dir, "train"))
    scored = score_texts(V.table(spark, sf_dir, "documents").select("doc_id", "text"), model)
    return scored.select("doc_id", "title", r6("guess").alias("guess"))



# Summaries


@query
def summary_requests(spark, sf_dir):
    held = V.replies(spark, sf_dir).filter(F.col("id") % 2 == 0)
    asked = requests.summary_requests(V.items(spark, sf_dir), held)
    return asked.select(
        "id", F.col("messages")[0]["content"].alias("system"), F.col("messages")[1]["content"].alias("user")
    )


@query
def summary_requests_first(spark, sf_dir):
    """Only the first rows of each split are asked for."""
    asked = requests.summary_requests(V.split_items(spark, sf_dir), limit=SLICE_ROWS)
    return asked.select("id", F.col("messages")[1]["content"].alias("user"))


@query
def apply_summaries(spark, sf_dir):
    return requests.apply_summaries(V.items(spark, sf_dir), V.replies(spark, sf_dir)).select("id", "summary")


@query
def summary_usage(spark, sf_dir):
    return requests.summary_usage(V.replies(spark, sf_dir)).select(
        "prompt_tokens", "completion_tokens", r6("cost").alias("cost")
    )


# Evaluation

METRICS = ("avg_error", "median_error", "rmsle", "r2", "hit_rate")


@query
def to_price(spark, sf_dir):
    return V.replies(spark, sf_dir).select("id", X.to_price(F.col("reply")).alias("price"))


@query
def prediction_errors(spark, sf_dir):
    errors = evaluate.prediction_errors(V.predictions(spark, sf_dir))
    return errors.select("model", "id", "error", r6("squared_log_error").alias("squared_log_error"))


@query
def error_bands(spark, sf_dir):
    return evaluate.error_bands(V.predictions(spark, sf_dir)).select("model", "id", "band")


@query
def metrics(spark, sf_dir):
    rows = evaluate.metrics(V.predictions(spark, sf_dir))
    return rows.select("model", "n", *[r6(c).alias(c) for c in METRICS])


@query
def worst_misses(spark, sf_dir):
    worst = evaluate.worst_misses(V.predictions(spark, sf_dir))
    return worst.select("model", "id", "title", "truth", "guess", "error", F.col("place").cast("bigint").alias("place"))


@query
def band_counts(spark, sf_dir):
    return evaluate.band_counts(V.predictions(spark, sf_dir))


@query
def leaderboard(spark, sf_dir):
    return evaluate.leaderboard(V.predictions(spark, sf_dir))


@query
def leaderboard_display(spark, sf_dir):
    return evaluate.display(evaluate.leaderboard(V.predictions(spark, sf_dir)))


@query
def evaluation_slice(spark, sf_dir):
    test = V.part(spark, sf_dir, "test").select("id", "source_id", "title", "price")
    return evaluate.evaluation_slice(test, SLICE_ROWS)


@query
def test_sample_stats(spark, sf_dir):
    test = V.part(spark, sf_dir, "test").select("id", "title", "price")
    row = describe.sample_statistics(evaluate.evaluation_slice(test, SLICE_ROWS))
    return row.select("n", r6("mean_price").alias("mean_price"), "median_price")


@named("compare_models")
def compare_baselines(spark, sf_dir):
    models = [create(name) for name in ("random", "average", "category-average")]
    return compare_models(curated(spark, sf_dir), models, SLICE_ROWS)



@query
def compare_all_models(spark, sf_dir):
    """The ten models at the library's own sizes."""
    words = {"stop_words": V.STOP_WORDS}
    models = [create(name) for name in ("random", "average", "category-average", "features")]
    models += [create(name, **words) for name in ("bow-linear", "svd-ridge", "random-forest", "boosted-trees", "hashed-huber")]
    models.append(create("zero-shot", replies=V.replies(spark, sf_dir)))
    return compare_models(curated(spark, sf_dir), models, SLICE_ROWS)


@query
def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price filter, dedup, weighted sample, split, two baselines, leaderboard."""
    kept = dedup.deduplicate(V.items(spark, sf_dir)).drop("summary", "weight", "full")
    survivors = write_through(kept, "survivors")
    drawn = write_through(sample.balanced_sample(survivors, SAMPLE_ROWS, damping=V.DAMPING), "sample")
    placed = split.train_val_test_split(drawn.withColumnRenamed("id", "source_id"), "source_id")
    table = write_through(placed, "curated")
    return evaluate.leaderboard(compare(table, [create("average"), create("category-average")], SLICE_ROWS))

