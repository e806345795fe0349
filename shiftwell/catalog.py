"""The registered queries: every operator over the shipped tables.

Each takes a session and the folder of one scale factor. Values that two engines
may compute in another order are rounded, arrays are unfolded to rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftwell.functions.text import main_tag
from shiftwell.functions.vectors import TOKEN
from shiftwell.operators import checks, inference, projection
from shiftwell.operators import models as M
from shiftwell.operators.answers import AnswerStore
from shiftwell.operators.models import TAG_FILLER, TAG_RULES, Client
from shiftwell.plans import articles as articles_plan
from shiftwell.plans import drivers as drivers_plan
from shiftwell.plans import embeddings as embeddings_plan
from shiftwell.plans import stress as stress_plan
from shiftwell.plans.run import Models, run_all
from shiftwell.schemas import ARTICLES, DRIVERS, NEWS_ITEMS, RIDES
from shiftwell.session import scratch_path
from shiftwell.sources import feeds, shipped, tables
from shiftwell.streaming import append as streaming
from shiftwell.streaming.days import DayStates
from shiftwell.workspace import Workspace

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Fragments that occur in the invented prose of the documents.
TERMS = {
    "financial_pressure": ("tion", "ent", "eaux"),
    "unsafe_conditions": ("ing", "ung", "sch"),
    "lack_of_support": ("ment", "ador", "wh"),
    "overwork_burnout": ("que", "ich", "the "),
}
XML_UNFIT = r"[\x{0}-\x{9}\x{B}-\x{1F}\x{FFFE}\x{FFFF}]"
MIN_HITS = 2
TAG_DIM = 64
TEXT_DIM = 16
HIGH_AT = 0.3
PLOT_CELLS = 100
LONG_DAY = 60
# A task reads a feed file as a whole, and one file is one task's to write.
FEED_FILE_ITEMS = 1 << 10
RIDE_FILE_ROWS = 1 << 18


def _register(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def _core(spark: SparkSession, folder: str) -> DataFrame:
    drivers, rides = shipped.drivers(spark, folder), shipped.rides(spark, folder)
    if drivers_plan.has_unique_ids(drivers):
        return drivers_plan.drivers_metrics_core_unique(drivers, rides)
    return drivers_plan.drivers_metrics_core(drivers, rides)


def _reason_model() -> M.ColumnModel:
    return M.reason_template(high_at=HIGH_AT, long_day=LONG_DAY)


def _metrics(spark: SparkSession, folder: str) -> DataFrame:
    return stress_plan.drivers_metrics(_core(spark, folder), M.stress_linear(), _reason_model())


def _tags(spark: SparkSession, folder: str) -> DataFrame:
    return stress_plan.driver_reason_tags(_metrics(spark, folder), M.rule_tags())


def _written(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """The rows as a table in the shared scratch folder, for steps that read them twice."""
    path = scratch_path(spark, "written")
    rows.write.parquet(path)
    return spark.read.parquet(path)


def _unfolded(rows: DataFrame, ids: Sequence[str], vector: str = "embedding") -> DataFrame:
    """One row per place of a vector, numbers rounded.

    The outer form keeps Spark from testing the vector's size before unfolding it,
    which would compute the vector again for the test.
    """
    placed = rows.select(*ids, F.posexplode_outer(vector).alias("place", "value"))
    return placed.where(F.col("place").isNotNull()).withColumn("value", F.round("value", 6))


def _workspace(spark: SparkSession) -> Workspace:
    """A workspace of its own in the shared scratch folder."""
    run = uuid.uuid4().hex
    return Workspace(
        spark, scratch_path(spark, "workspace"), staging=f"staging_{run}", marts=f"marts_{run}"
    )


# Rides per driver


@_register
def summary_drivers(spark: SparkSession, folder: str) -> DataFrame:
    return drivers_plan.summary_drivers(
        shipped.drivers(spark, folder), shipped.rides(spark, folder)
    )


@_register
def summary_drivers_sorted(spark: SparkSession, folder: str) -> DataFrame:
    return drivers_plan.summary_drivers(
        shipped.drivers(spark, folder), shipped.rides(spark, folder), ordered=True
    )


@_register
def drivers_metrics_core(spark: SparkSession, folder: str) -> DataFrame:
    core = drivers_plan.drivers_metrics_core(
        shipped.drivers(spark, folder), shipped.rides(spark, folder)
    )
    return core.withColumn("stddev_fare", F.round("stddev_fare", 6))


@_register
def drivers_metrics_core_count_rewrite(spark: SparkSession, folder: str) -> DataFrame:
    return _core(spark, folder).withColumn("stddev_fare", F.round("stddev_fare", 6))


# Prompts


@_register
def driver_prompts(spark: SparkSession, folder: str) -> DataFrame:
    return stress_plan.driver_prompts(_core(spark, folder))


@_register
def article_prompts(spark: SparkSession, folder: str) -> DataFrame:
    return articles_plan.article_prompts(shipped.articles(spark, folder))


# Articles


@_register
def articles_nonempty(spark: SparkSession, folder: str) -> DataFrame:
    return articles_plan.articles_with_text(shipped.articles(spark, folder))


@_register
def articles_metrics(spark: SparkSession, folder: str) -> DataFrame:
    models = {flag: M.lexicon_bool(terms, MIN_HITS) for flag, terms in TERMS.items()}
    return articles_plan.articles_metrics(shipped.articles(spark, folder), models)


def _lexicon_client(terms: Sequence[str]) -> Callable[[], Client]:
    def make() -> Client:
        def answer(prompts: list[str]) -> list[str]:
            texts = (prompt.split("\nText: ", 1)[1].lower() for prompt in prompts)
            return ["yes" if sum(t in text for t in terms) >= MIN_HITS else "no" for text in texts]

        return answer

    return make


def _lexicon_batch_models() -> dict[str, M.BatchModel]:
    return {flag: M.BatchModel(flag, _lexicon_client(terms)) for flag, terms in TERMS.items()}


@_register
def articles_metrics_batch(spark: SparkSession, folder: str) -> DataFrame:
    """The flags by models that are called from tasks, once per distinct article."""
    articles = shipped.articles(spark, folder)
    return articles_plan.articles_metrics(articles, _lexicon_batch_models(), reread=True)


@_register
def model_results_struct(spark: SparkSession, folder: str) -> DataFrame:
    """Whole answers of one question, as flat columns."""
    flag = "financial_pressure"
    articles = shipped.articles(spark, folder)
    models = {flag: _lexicon_batch_models()[flag]}
    answered = articles_plan.articles_metrics(articles, models, structs=True, reread=True)
    parts = [f"{flag}.{part}" for part in ("result", "full_response", "status")]
    return answered.select("article_name", *parts)


# Stress


@_register
def stress_score(spark: SparkSession, folder: str) -> DataFrame:
    return _metrics(spark, folder).select(
        "driver_ID", F.round("stress_score", 6).alias("stress_score")
    )


@_register
def drivers_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return _metrics(spark, folder).withColumn("stress_score", F.round("stress_score", 6))


def _score_client() -> Client:
    return lambda prompts: [str(len(prompt) % 101 / 100) for prompt in prompts]


def _reason_client() -> Client:
    return lambda prompts: [f"Asked in {len(prompt)} signs." for prompt in prompts]


@_register
def drivers_metrics_batch(spark: SparkSession, folder: str) -> DataFrame:
    """Score and reason by models that are called from tasks."""
    score = M.BatchModel("prompt-length-score", _score_client)
    reason = M.BatchModel("prompt-length-reason", _reason_client)
    return stress_plan.drivers_metrics(_core(spark, folder), score, reason)


@_register
def driver_reason_tags(spark: SparkSession, folder: str) -> DataFrame:
    return _tags(spark, folder)


def _tag_client() -> Client:
    def answer(prompts: list[str]) -> list[str]:
        replies = []
        for prompt in prompts:
            reason = prompt.split("\n\n", 1)[1]
            words = [keyword for found, keyword in TAG_RULES if found in reason]
            filled = words + list(TAG_FILLER)
            replies.append(", ".join(filled[: min(max(len(words), 2), 3)]))
        return replies

    return answer


@_register
def driver_reason_tags_stored(spark: SparkSession, folder: str) -> DataFrame:
    """Keywords through the answer store: asked, kept, and read back."""
    store = AnswerStore(scratch_path(spark, "answers"))
    model = M.BatchModel("tags", _tag_client)
    return stress_plan.driver_reason_tags(_metrics(spark, folder), model, store)


@_register
def driver_tag_shapes(spark: SparkSession, folder: str) -> DataFrame:
    """Keywords with the check of their shape."""
    metrics = _metrics(spark, folder)
    return stress_plan.driver_reason_tags(metrics, M.rule_tags(), check_shape=True)


@_register
def distinct_tags(spark: SparkSession, folder: str) -> DataFrame:
    return inference.distinct_values(_tags(spark, folder), "stress_report_tags")


@_register
def driver_main_tag(spark: SparkSession, folder: str) -> DataFrame:
    return _tags(spark, folder).select(
        "driver_ID", main_tag(F.col("stress_report_tags")).alias("main_tag")
    )


# Embeddings


@_register
def tag_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    tags = _written(spark, _tags(spark, folder)).where(F.col("stress_report_tags").isNotNull())
    distinct = inference.distinct_values(tags, "stress_report_tags")
    vectors = inference.embed(distinct, "stress_report_tags", M.hash_embedding(TAG_DIM))
    return _unfolded(vectors, ["stress_report_tags"])


@_register
def driver_reason_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    tags = _written(spark, _tags(spark, folder))
    vectors = embeddings_plan.driver_reason_embeddings(tags, M.hash_embedding(TAG_DIM))
    return _unfolded(vectors, ["driver_ID", "stress_report_tags"])


def _hash_client(dim: int) -> Callable[[], Client]:
    def make() -> Client:
        import hashlib

        import numpy as np
        import regex

        words = regex.compile(TOKEN)

        def place(word: str) -> int:
            return int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % dim

        def answer(texts: list[str]) -> list[list[float]]:
            vectors = []
            for text in texts:
                places = [place(word) for word in words.findall(text.lower())]
                counts = np.bincount(places, minlength=dim).astype(float)
                length = np.linalg.norm(counts)
                vectors.append((counts / length if length else counts).tolist())
            return vectors

        return answer

    return make


@_register
def driver_reason_embeddings_batch(spark: SparkSession, folder: str) -> DataFrame:
    """The embeddings by a model that is called from tasks, once per distinct text."""
    model = M.BatchModel("hash", _hash_client(TAG_DIM))
    tags = _written(spark, _tags(spark, folder))
    vectors = embeddings_plan.driver_reason_embeddings(tags, model)
    return _unfolded(vectors, ["driver_ID", "stress_report_tags"])


@_register
def driver_reason_embeddings_stored(spark: SparkSession, folder: str) -> DataFrame:
    """The embeddings asked, kept, and given by the store to a second run."""
    store = AnswerStore(scratch_path(spark, "vectors"))
    model = M.BatchModel("hash", _hash_client(TAG_DIM))
    tags = _written(spark, _tags(spark, folder))
    embeddings_plan.driver_reason_embeddings(tags, model, store=store)
    vectors = embeddings_plan.driver_reason_embeddings(tags, model, store=store)
    return _unfolded(vectors, ["driver_ID", "stress_report_tags"])


@_register
def article_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    """Whole article texts embedded by column expression."""
    articles = shipped.articles(spark, folder).select("article_name", "content")
    vectors = inference.embed(articles, "content", M.hash_embedding(TEXT_DIM))
    return _unfolded(vectors, ["article_name"])


def _labelled_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return shipped.table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("driver_ID"),
        F.concat(F.lit("tag "), F.col("label").cast("string"), F.lit(" , other")).alias(
            "stress_report_tags"
        ),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )


@_register
def embedding_points(spark: SparkSession, folder: str) -> DataFrame:
    points = embeddings_plan.embedding_points(_labelled_vectors(spark, folder))
    return points.withColumns({"x": F.round("x", 5), "y": F.round("y", 5)})


@_register
def embedding_point_bins(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings_plan.embedding_point_bins(_labelled_vectors(spark, folder))


@_register
def embedding_layout(spark: SparkSession, folder: str) -> DataFrame:
    """Points that keep near vectors near; iterated, so without SQL."""
    return embeddings_plan.embedding_layout(_labelled_vectors(spark, folder))


@_register
def embedding_crowded_bins(spark: SparkSession, folder: str) -> DataFrame:
    """A bounded plot of the first two coordinates of the vectors."""
    points = shipped.table(spark, folder, "embeddings").select(
        F.get("embedding", 0).cast("double").alias("x"),
        F.get("embedding", 1).cast("double").alias("y"),
        F.col("label").cast("string").alias("main_tag"),
    )
    return projection.crowded_bins(points, PLOT_CELLS)


# Loading


def _raw_articles(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as text rows of which some do not fit the articles table."""
    return shipped.table(spark, folder, "documents").select(
        F.when(F.col("n_chars") >= 100, F.concat(F.lit("doc-"), F.col("doc_id"))).alias(
            "article_name"
        ),
        F.col("source").alias("city"),
        F.when(F.col("lang") == "fr", "2025-13-01").otherwise("2025-06-12").alias("published"),
        F.col("text").alias("content"),
        F.when(F.col("source").isin("src1", "src2"), F.col("lang")).alias("author"),
    )


@_register
def append_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Why rows are rejected, by the id they give."""
    report = checks.bad_rows(
        checks.checked(_raw_articles(spark, folder), ARTICLES), "article_name"
    )
    return report.select("article_name", F.concat_ws("; ", checks.ERRORS).alias("errors"))


@_register
def append_articles(spark: SparkSession, folder: str) -> DataFrame:
    """The rows that are left, appended to a table and read back."""
    workspace = _workspace(spark)
    table = workspace.staged("news_content_usa")
    tables.append_rows(workspace, table, ARTICLES, _raw_articles(spark, folder), "article_name")
    return workspace.read(table)


@_register
def append_articles_twice(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs over the same rows, known ids left out."""
    workspace = _workspace(spark)
    table = workspace.staged("news_content_usa")
    for _ in range(2):
        rows = _raw_articles(spark, folder)
        tables.append_rows(workspace, table, ARTICLES, rows, "article_name", skip_known=True)
    return workspace.read(table)


@_register
def load_counts(spark: SparkSession, folder: str) -> DataFrame:
    """What a load reports: rows loaded and rejected."""
    workspace = _workspace(spark)
    table = workspace.staged("news_content_usa")
    report = tables.append_rows(
        workspace, table, ARTICLES, _raw_articles(spark, folder), "article_name"
    )
    return spark.createDataFrame(
        [(report.loaded, report.rejected)], "loaded bigint, rejected bigint"
    )


@_register
def append_json_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """JSON lines of which some repeat a name: bad rows of their own, not a dead load."""
    documents = shipped.table(spark, folder, "documents")
    again = F.when(F.col("lang") == "fr", ',"Content":"again"').otherwise("")
    line = F.concat(F.lit('{"article_name":"doc-'), "doc_id", F.lit('","content":"text"'), again)
    lines = documents.select(F.concat(line, F.lit("}")).alias("value"))
    workspace = _workspace(spark)
    table = workspace.staged("news_content_usa")
    report = tables.append_rows(
        workspace, table, ARTICLES, lines, "article_name", json_lines=True
    )
    loaded = workspace.read(table).select("article_name", F.lit(None).cast("string").alias("errors"))
    name = F.get_json_object("raw_row", "$.article_name").alias("article_name")
    return loaded.unionAll(report.rejects.select(name, F.concat_ws("; ", checks.ERRORS)))


# Literal articles about documents that every scale factor has.
LITERALS = [
    {"article_name": "doc-1", "city": "Oslo", "published": "2025-06-11", "content": "First text"},
    {"article_name": "doc-2", "published": "2025-06-12", "content": "Second text"},
    {"article_name": "doc-3", "city": "Rome", "published": "2025-06-31", "content": "No such day"},
    {"article_name": "doc-4", "city": "Bonn", "published": "2025-07-01"},
    {"article_name": "doc-5", "city": "Kyiv", "published": "2025-07-02", "content": "Last text"},
]


@_register
def literal_articles(spark: SparkSession, folder: str) -> DataFrame:
    """Literal rows in a table, joined to the documents they are about."""
    workspace = _workspace(spark)
    table = workspace.staged("news_content_usa")
    tables.append_literals(workspace, table, ARTICLES, LITERALS, "article_name")
    documents = shipped.table(spark, folder, "documents")
    named = documents.select(
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("article_name"), "n_chars"
    )
    return named.join(workspace.read(table), "article_name")


def _csv_files(spark: SparkSession, rows: DataFrame) -> str:
    path = scratch_path(spark, "csv")
    rows.write.option("header", True).csv(path)
    return path


def _named_drivers(spark: SparkSession, folder: str) -> DataFrame:
    return shipped.drivers(spark, folder).select(
        "Driver_ID",
        F.concat(F.lit("Driver, "), F.col("Driver_ID")).alias("Name"),
        "Age",
        "City",
        "Experience_Years",
        "Average_Rating",
        F.when(F.col("Age") > 40, "Active").alias("Active_Status"),
    )


@_register
def upload_drivers_csv(spark: SparkSession, folder: str) -> DataFrame:
    """Drivers as CSV files, loaded with the declared schema."""
    path = _csv_files(spark, _named_drivers(spark, folder))
    workspace = _workspace(spark)
    table = workspace.staged("drivers_data")
    tables.upload_csv(workspace, path, DRIVERS, table)
    return workspace.read(table)


def _whole_rides(spark: SparkSession, folder: str) -> DataFrame:
    return shipped.rides(spark, folder).select(
        "Ride_ID",
        "Driver_ID",
        F.lit(None).cast("string").alias("City"),
        "Date",
        F.lit(None).cast("double").alias("Distance_km"),
        "Duration_min",
        "Fare",
        F.lit(None).cast("double").alias("Rating"),
        F.lit(None).cast("string").alias("Promo_Code"),
    )


@_register
def replace_rides(spark: SparkSession, folder: str) -> DataFrame:
    """A frame written as a table under its declared schema."""
    workspace = _workspace(spark)
    return workspace.replace(
        workspace.staged("rides_data"), _whole_rides(spark, folder), RIDES
    )


@_register
def replace_under_reader(spark: SparkSession, folder: str) -> DataFrame:
    """Rows that a reader opened before two replaces, the second with other columns, and
    the rows after them."""
    workspace = _workspace(spark)
    table = workspace.staged("rides_data")
    before = workspace.replace(table, _whole_rides(spark, folder), RIDES)
    workspace.replace(table, before.where("Duration_min > 25"))
    longer = workspace.read(table).select("Ride_ID", (F.col("Fare") * 2).alias("Fare"))
    after = workspace.replace(table, longer)
    return before.select("Ride_ID", "Fare", F.lit("before").alias("seen")).unionAll(
        after.select("Ride_ID", "Fare", F.lit("after").alias("seen"))
    )


@_register
def run_all_tags(spark: SparkSession, folder: str) -> DataFrame:
    """Keywords and flags after the whole run, from files to marts, made twice."""
    workspace = _workspace(spark)
    drivers = _csv_files(spark, _named_drivers(spark, folder))
    rides = _csv_files(spark, _whole_rides(spark, folder))
    flags = {flag: M.lexicon_bool(terms, MIN_HITS) for flag, terms in TERMS.items()}
    models = Models(reason=_reason_model(), articles=flags)
    for _ in range(2):
        marts = run_all(workspace, drivers, rides, shipped.articles(spark, folder), models)
    tags = marts["drivers_reason_tags"]
    said = F.concat_ws(" ", *(F.col(flag).cast("string") for flag in TERMS))
    answers = marts["articles_metrics"].select("article_name", said)
    return tags.select(F.col("driver_ID").cast("string").alias("name"), "stress_report_tags").unionAll(
        answers
    )


@_register
def view_over_tables(spark: SparkSession, folder: str) -> DataFrame:
    """A named view over staging tables, read by query text."""
    workspace = _workspace(spark)
    workspace.replace(workspace.staged("drivers_data"), shipped.drivers(spark, folder))
    workspace.replace(workspace.staged("rides_data"), shipped.rides(spark, folder))
    view = workspace.mart("city_fares")
    workspace.view(
        view,
        f"""
        WITH per_driver AS (
          SELECT driver_id, COUNT(ride_id) AS rides, SUM(fare) AS fare
          FROM {workspace.staged("rides_data")} GROUP BY driver_id)
        SELECT d.City, COALESCE(SUM(r.rides), 0) AS rides, ROUND(SUM(r.fare), 2) AS fare
        FROM {workspace.staged("drivers_data")} d
        LEFT JOIN per_driver r ON d.driver_id = r.driver_id
        GROUP BY d.City
        """,
    )
    return workspace.query(f"SELECT City, rides, fare FROM {view}")


@_register
def stream_append(spark: SparkSession, folder: str) -> DataFrame:
    """Events as JSON lines, appended by a stream; errors have no readable driver."""
    source, target, rejects, checkpoint = (
        scratch_path(spark, f"stream-{part}") for part in ("in", "out", "rejects", "checkpoint")
    )
    _ride_lines(shipped.table(spark, folder, "events")).write.text(source)
    streaming.append_stream(spark, source, RIDES, target, rejects, checkpoint).awaitTermination()
    return streaming.read_appended(spark, target, RIDES).select(
        "Ride_ID", "Driver_ID", "Date", "Fare"
    )


def _ride_lines(events: DataFrame) -> DataFrame:
    """Events as JSON lines of rides; errors have no readable driver."""
    return events.select(
        F.to_json(
            F.struct(
                F.col("event_id").alias("Ride_ID"),
                F.when(F.col("event_type") == "error", "unknown")
                .otherwise(F.col("user_id").cast("string"))
                .alias("Driver_ID"),
                F.date_format("ts", "yyyy-MM-dd").alias("Date"),
                F.col("value").alias("Fare"),
            )
        ).alias("value")
    )


@_register
def stream_append_two_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Two streams into one target: all rows of both, good and bad."""
    target, rejects = (scratch_path(spark, f"stream-{part}") for part in ("out", "rejects"))
    events = shipped.table(spark, folder, "events")
    for part in range(2):
        source, checkpoint = (scratch_path(spark, f"stream-{p}") for p in ("in", "checkpoint"))
        _ride_lines(events.where(F.col("event_id") % 2 == part)).write.text(source)
        streaming.append_stream(
            spark, source, RIDES, target, rejects, checkpoint
        ).awaitTermination()
    good = streaming.read_appended(spark, target, RIDES)
    bad = spark.read.parquet(rejects)
    ride = F.get_json_object("raw_row", "$.Ride_ID").cast("bigint")
    return good.select("Ride_ID", F.lit("").alias("errors")).unionAll(
        bad.select(ride, F.concat_ws("; ", checks.ERRORS))
    )


# Ways to write one moment, the undated documents' aside.
MOMENTS = (
    "Tue, 10 Jun 2025 08:00:00 +0200",
    "Tue, 10 Jun 25 06:00:00 GMT",
    "10 June 2025 01:00:00 EST",
    "Jun 10, 2025 6:00 AM",
    "20250610T060000Z",
    "Tue Jun 10 06:00:00 2025",
)


def _feed_path(spark: SparkSession, folder: str) -> str:
    """Documents as items of RSS files of bounded length: some without a link or a date."""
    path = scratch_path(spark, "feed")
    documents = shipped.table(spark, folder, "documents")

    # Characters XML has no place for become spaces, as in the oracle.
    text = F.regexp_replace("text", XML_UNFIT, " ")
    moments = F.array(*map(F.lit, MOMENTS))
    items = documents.select(
        F.concat(F.lit("doc-"), F.col("doc_id")).alias("title"),
        F.when(
            F.col("n_chars") >= 100, F.concat(F.lit("http://example.test/"), F.col("doc_id"))
        ).alias("link"),
        F.when(F.col("lang") == "fr", "soon")
        .otherwise(F.get(moments, (F.col("doc_id") % len(MOMENTS)).cast("int")))
        .alias("pubDate"),
        text.alias("description"),
    )
    xml = items.write.format("xml").option("rootTag", "channel").option("rowTag", "item")
    xml.option("maxRecordsPerFile", FEED_FILE_ITEMS).save(path)
    return path


def _feed_files(spark: SparkSession, folder: str) -> DataFrame:
    """The items of the files, checked."""
    return feeds.checked_items(feeds.read_feed(spark, _feed_path(spark, folder)))


@_register
def feed_items(spark: SparkSession, folder: str) -> DataFrame:
    items = checks.good_rows(_feed_files(spark, folder))
    return feeds.with_iso_dates(items)


@_register
def feed_rejects(spark: SparkSession, folder: str) -> DataFrame:
    rejected = checks.bad_rows(_feed_files(spark, folder), "title")
    return rejected.select("title", F.concat_ws("; ", checks.ERRORS).alias("errors"))


@_register
def feed_table(spark: SparkSession, folder: str) -> DataFrame:
    """The items in a table, loaded twice, known links left out."""
    workspace = _workspace(spark)
    path = _feed_path(spark, folder)
    table = workspace.staged("gig_workers_news")
    for _ in range(2):
        feeds.load_feed(workspace, path, table, skip_known=True)
    return feeds.with_iso_dates(workspace.read(table))


@_register
def stream_feed(spark: SparkSession, folder: str) -> DataFrame:
    """Feed files met by two streams into one target: one item for each link."""
    target, rejects = (scratch_path(spark, f"feed-{part}") for part in ("out", "rejects"))
    path = _feed_path(spark, folder)
    for _ in range(2):
        checkpoint = scratch_path(spark, "feed-checkpoint")
        streaming.append_feed(spark, path, target, rejects, checkpoint).awaitTermination()
    return feeds.with_iso_dates(streaming.read_appended(spark, target, NEWS_ITEMS))


@_register
def stream_feed_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """The entries of a stream of feed files that fit no item."""
    target, rejects, checkpoint = (
        scratch_path(spark, f"feed-{part}") for part in ("out", "rejects", "checkpoint")
    )
    path = _feed_path(spark, folder)
    streaming.append_feed(spark, path, target, rejects, checkpoint).awaitTermination()
    title = F.get_json_object("raw_row", "$.title").alias("title")
    return spark.read.parquet(rejects).select(title, F.concat_ws("; ", checks.ERRORS).alias("errors"))


@_register
def stream_driver_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Metrics of drivers from rides that two streams brought in two batches each."""
    states = DayStates(spark, scratch_path(spark, "day-states"))
    target, rejects = (scratch_path(spark, f"rides-{part}") for part in ("out", "rejects"))
    rides = _whole_rides(spark, folder)
    # About so many: a line of an order is a ride.
    in_batch = shipped.table(spark, folder, "lineitem").count() // 4
    files_per_batch = 1 + in_batch // RIDE_FILE_ROWS
    for part in range(2):
        source, checkpoint = (scratch_path(spark, f"rides-{p}") for p in ("in", "checkpoint"))
        lines = rides.where(F.col("Ride_ID") % 2 == part).select(F.to_json(F.struct("*")))
        lines.repartition(2 * files_per_batch).write.text(source)
        streaming.append_stream(
            spark,
            source,
            RIDES,
            target,
            rejects,
            checkpoint,
            files_per_batch=files_per_batch,
            then=states.add,
        ).awaitTermination()
    core = states.metrics(shipped.drivers(spark, folder))
    return core.withColumn("stddev_fare", F.round("stddev_fare", 6))
