"""Queries over the given tables: at least one per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.feature import MinMaxScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskflow.fixed_values import NUMERIC_FEATURES, RAW_COLUMNS, REFIT_SEED, REFIT_WEIGHTS
from riskflow.functions import risk_bucket
from riskflow.operators import classify, compare, decide, features, quality, sampling
from riskflow.operators.encode import assembler, encoder, indexer, skipped_rows, wide_index, with_index
from riskflow.operators.evaluate import area_under_roc, confusion, confusion_matrix, long_metrics, metrics
from riskflow.operators.quality import Rules
from riskflow.plans import jobs, stand_ins
from riskflow.session import materialize, new_path, pin_time_zone
from riskflow.sinks import (
    compact_runs,
    drop_logged,
    log_run,
    publish,
    read_runs,
    read_version,
    run_rows,
    write_report_text,
)
from riskflow.sinks.versions import hadoop_path
from riskflow.sources import parse_lines, ragged_rows, read_delimited, read_table
from riskflow.streaming import (
    decode_messages,
    dedupe_stream,
    fast_credit_stream,
    land_files,
    land_lines,
    read_batches,
    start_table,
    start_with_list,
    sync_files,
    window_counts,
    with_event_time,
)

# Fits that run at a time. Each keeps its own copy of the training rows, in memory or on disk.
SEARCH_PARALLELISM = 4

STRICT = Rules(require_timestamp=True)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(pin_time_zone(spark), sf_dir, name)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events")


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stand_ins.raw_transactions(_events(spark, sf_dir))


def _typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.typed(quality.clean(_raw(spark, sf_dir)))


def _stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed transactions, written once for those that read them more than once."""
    return materialize(_typed(spark, sf_dir), "transactions")


def _lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stand_ins.lineitem_transactions(_table(spark, sf_dir, "lineitem"))


# Sources and quality


def complete_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.complete_rows(_raw(spark, sf_dir))


def text_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = stand_ins.raw_lines(_events(spark, sf_dir))
    return parse_lines(lines, RAW_COLUMNS, stand_ins.HEADER)


def _write_files(files: DataFrame, path: str) -> None:
    """A file per day, its header first."""
    dealt = files.repartition("day").sortWithinPartitions("day", "place")
    dealt.select("day", "value").write.partitionBy("day").text(path)


def _raw_files(spark: SparkSession, sf_dir: str) -> str:
    """Lines written as a file per day, an empty one among them; on even days two columns are exchanged."""
    source = new_path(spark, "raw-files")
    files = stand_ins.raw_files(_events(spark, sf_dir))
    _write_files(files, source)
    files.select("value").limit(0).coalesce(1).write.text(f"{source}/day=1900-01-01")
    return source


def _dated_text(landed: DataFrame) -> DataFrame:
    return landed.withColumn("source_date", F.col("source_date").cast("string"))


def file_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files read by the header of each."""
    parsed, _ = read_delimited(spark, _raw_files(spark, sf_dir))
    return _dated_text(parsed.drop("source_file"))


def profile_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile as written: one line per metric."""
    return spark.read.text(write_report_text(profile(spark, sf_dir), new_path(spark, "profile-text")))


def ragged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ragged_rows(text_ingest(spark, sf_dir), RAW_COLUMNS)


def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.profile(quality.audit(_raw(spark, sf_dir)))


def missing_by_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.missing_by_column(_raw(spark, sf_dir))


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.clean(_raw(spark, sf_dir))


def reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.reject_reasons(quality.audit(_raw(spark, sf_dir), STRICT))


def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rejected_rows(quality.audit(_raw(spark, sf_dir), STRICT))


def quarantine_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = stand_ins.raw_lines(_events(spark, sf_dir)).filter(F.col("value") != stand_ins.HEADER)
    return quality.rejected_rows(quality.audit_lines(lines, STRICT))


# Features


def typed_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.formatted_time(_typed(spark, sf_dir))


def terminal_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.terminal_profile(_typed(spark, sf_dir))


def terminal_rate_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.terminal_profile(_lineitem(spark, sf_dir))


def risk_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    percent = (
        F.when(kind == "signup", F.lit(None).cast("double"))
        .when(kind == "view", F.lit(float("nan")))
        .otherwise(F.col("value"))
    )
    return _events(spark, sf_dir).select("event_id", risk_bucket(percent).alias("bucket"))


def enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.formatted_time(features.enrich(_stored(spark, sf_dir)))


def enrich_unbounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.enrich(_lineitem(spark, sf_dir))


def enrich_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.enrich(stand_ins.order_transactions(_table(spark, sf_dir, "orders")))


def fraud_free_terminals(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = stand_ins.order_transactions(_table(spark, sf_dir, "orders"))
    return features.fraud_free_terminals(features.terminal_profile(orders))


def fraud_free_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.first_by(fraud_free_terminals(spark, sf_dir), "terminal_id", 10)


# Balance, splits, encoding


def class_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.class_balance(_lineitem(spark, sf_dir))


def oversample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.oversample(_lineitem(spark, sf_dir)).select("tranaction_id", "tx_fraud", "copy_no")


def oversample_by_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.oversample_by_union(_lineitem(spark, sf_dir)).select(
        "tranaction_id", "tx_fraud", "copy_no"
    )


def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.with_split(_events(spark, sf_dir), ["event_id"]).select("event_id", "split")


def hash_split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbered = sampling.with_split(
        _lineitem(spark, sf_dir), ["tranaction_id"], REFIT_WEIGHTS, salt=str(REFIT_SEED)
    )
    return numbered.groupBy("split").agg(F.count(F.lit(1)).alias("n"))


def random_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each row with the number of parts it is in, whether another run puts it into the same one, and whether the
    parts' sizes are within five standard deviations of their weights."""
    events = _events(spark, sf_dir).select("event_id")

    def parts() -> DataFrame:
        split = sampling.random_split(events, REFIT_WEIGHTS, REFIT_SEED)
        return split[0].withColumn("part", F.lit(0)).unionByName(split[1].withColumn("part", F.lit(1)))

    first = parts().groupBy("event_id").agg(F.count("part").alias("n_parts"), F.max("part").alias("part"))
    again = parts().withColumnRenamed("part", "again")
    n, size = F.count(F.lit(1)), F.count_if(F.col("part") == 0)
    share = REFIT_WEIGHTS[0] / sum(REFIT_WEIGHTS)
    near = F.abs(size - n * share) <= 5 * F.sqrt(n * share * (1 - share))
    sized = first.agg(near.alias("sizes_fit")).scalar()
    return first.join(again, "event_id").select(
        "event_id", "n_parts", (F.col("part") == F.col("again")).alias("same_again"), sized.alias("sizes_fit")
    )


def hash_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.hash_sample(_events(spark, sf_dir), ["event_id"]).select("event_id", sampling.COPY)


def sample_with_replacement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.sample_with_replacement(_events(spark, sf_dir)).select("event_id")


def string_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir)
    model = indexer(["event_type"]).fit(events)
    return model.transform(events).select("event_id", "event_type", "event_type_index")


def one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    column = ["o_orderpriority"]
    indexed = indexer(column).fit(orders).transform(orders)
    encoded = encoder(column).fit(indexed).transform(indexed)
    cells = F.transform(vector_to_array("o_orderpriority_encoded"), lambda x: x.cast("int").cast("string"))
    return encoded.select("o_orderkey", "o_orderpriority", F.concat_ws(",", cells).alias("encoded"))


def min_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _table(spark, sf_dir, "lineitem")
    assembled = VectorAssembler(
        inputCols=["l_quantity", "l_extendedprice"], outputCol="features"
    ).transform(items)
    scaled = MinMaxScaler(inputCol="features", outputCol="scaled").fit(assembled).transform(assembled)
    values = vector_to_array("scaled")
    return scaled.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.round(values[0], 9).alias("quantity_scaled"),
        F.round(values[1], 9).alias("price_scaled"),
    )


def assemble_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assembler(categorical=()).transform(_typed(spark, sf_dir)).select("tranaction_id")


def skipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return skipped_rows(_typed(spark, sf_dir), NUMERIC_FEATURES)


def string_index_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with the index of their order, a column with as many values as there are orders."""
    items = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return with_index(items, wide_index(items, ["l_orderkey"]), "l_orderkey")


# Evaluation and comparison


def auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two fixed scores as models: the amount in tens, which has many ties, and the amount itself."""
    events = _events(spark, sf_dir)
    scores = {"tens": F.floor(F.col("value") / 10).cast("double"), "amount": F.col("value")}
    cells = F.array(*[F.struct(F.lit(m).alias("model"), x.alias("score")) for m, x in scores.items()])
    label = (F.col("event_type") == "error").cast("int")
    return area_under_roc(events.select(label.alias("label"), F.inline(cells)), "score", "label", ["model"])


def _rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stand_ins.rule_predictions(_events(spark, sf_dir))


def confusion_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return confusion(_rules(spark, sf_dir), by=("model",))


def matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return confusion_matrix(confusion_counts(spark, sf_dir), by=("model",))


def metric_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics(confusion_counts(spark, sf_dir))


def bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = compare.replicate_counts(_rules(spark, sf_dir), ["tranaction_id"])
    return compare.replicate_metrics(counts)


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.long_scores(bootstrap(spark, sf_dir))


def _moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.moments(_scores(spark, sf_dir))


def _rounded(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    return df.withColumns({name: F.round(name, n) for name, n in digits.items()})


def bootstrap_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("mean", "std", "low_3", "low_1", "high_1", "high_3")
    return _rounded(compare.sigma_bands(_moments(spark, sf_dir)), dict.fromkeys(names, 9))


def density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(compare.density(_moments(spark, sf_dir)), {"x": 9, "y": 6})


def histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.histogram(_scores(spark, sf_dir))


def ab_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    tested = compare.two_sample_test(_moments(spark, sf_dir), "LR", "LR_TV")
    return _rounded(tested, {"t": 6, "p_value": 9})


def ab_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(compare.mean_interval(_moments(spark, sf_dir)), {"low": 9, "mean": 9, "high": 9})


# Models


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialize(features.enrich(_stored(spark, sf_dir)), "features")


def prepared_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready = jobs.prepare(_features(spark, sf_dir))
    parts = [part.withColumn("split", F.lit(i)) for i, part in enumerate((ready.train, ready.test))]
    return parts[0].unionByName(parts[1]).groupBy("split", "tx_fraud").agg(F.count(F.lit(1)).alias("n"))


def _sound(predictions: DataFrame) -> DataFrame:
    """Predictions without what only the model knows, and whether that is sound."""
    likely = F.col("probability") > 0.5
    sound = F.col("probability").between(0, 1) & ((F.col("prediction") == 1) == likely)
    return predictions.withColumn("sound", sound).drop("probability", "prediction")


def _class_totals(measured: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows per actual class, and whether the metrics follow from the confusion counts."""
    n = F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")
    right = F.abs(F.col("accuracy") - (F.col("tp") + F.col("tn")) / n) < 1e-9
    bounded = [F.col(m).between(0, 1) for m in ("precision", "recall", "f1")]
    return measured.select(
        *[F.col(c).cast("bigint").alias(c) for c in keep],
        (F.col("tp") + F.col("fn")).cast("bigint").alias("positives"),
        (F.col("tn") + F.col("fp")).cast("bigint").alias("negatives"),
        (right & bounded[0] & bounded[1] & bounded[2]).alias("sound"),
    )


def _searched(spark: SparkSession, fitted, grid: list[dict]) -> DataFrame:
    """Every point of the grid, whether its score is one, and how many were chosen."""
    found = classify.search_results(spark, fitted, grid)
    chosen = found.agg(F.count_if("chosen").alias("n")).scalar()
    return found.select(
        "reg_param",
        "fit_intercept",
        "elastic_net_param",
        F.col("auc").between(0, 1).alias("sound"),
        chosen.alias("n_chosen"),
    )


def train_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready = jobs.prepare(_features(spark, sf_dir))
    model = classify.logistic().fit(ready.train)
    return _sound(classify.predict(model, ready.test, [jobs.ID, sampling.COPY]))


def train_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = jobs.train_job(
        spark,
        _features(spark, sf_dir),
        new_path(spark, "runs"),
        new_path(spark, "model"),
        "catalog",
    )
    return _class_totals(measured)


def training_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready = jobs.prepare(_features(spark, sf_dir))
    found = classify.training_summary(spark, classify.logistic().fit(ready.train))
    return found.select("metric", F.col("value").between(0, 1).alias("sound"))


def train_leak_free(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready = jobs.prepare_leak_free(_stored(spark, sf_dir))
    model = classify.logistic().fit(ready.train)
    return _class_totals(classify.evaluate(classify.predict(model, ready.test, [jobs.ID])))


def grid_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready = jobs.prepare(_features(spark, sf_dir))
    estimator = classify.logistic()
    grid = classify.parameter_grid(estimator)
    fitted = classify.tune(ready.train, estimator, grid, parallelism=SEARCH_PARALLELISM)
    return _searched(spark, fitted, grid)


def cross_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready = jobs.prepare(_features(spark, sf_dir))
    estimator = classify.logistic()
    grid = classify.parameter_grid(estimator)
    fitted = classify.cross_validate(ready.train, estimator, grid, parallelism=SEARCH_PARALLELISM)
    return _searched(spark, fitted, grid)


def score_saved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tune, refit the best parameters, save, load and score; report and predictions are written and read."""
    prepared = _features(spark, sf_dir)
    model, report, scored = (new_path(spark, name) for name in ("model", "report", "scored"))
    jobs.tune_job(spark, prepared, model, report, SEARCH_PARALLELISM)
    measured = jobs.score_job(spark, prepared, model, target=scored)
    names = ("rows", "scored", "skipped", "tp", "tn", "fp", "fn", "accuracy", "precision", "recall", "f1")
    wide = measured.groupBy().pivot("metric", list(names)).agg(F.first("value"))
    written = spark.read.parquet(scored).count()
    reports = spark.read.text(report).filter("value LIKE 'parameters regParam %'").count()
    return _class_totals(wide, names[:3]).select(
        "*", F.lit(written).cast("bigint").alias("written"), F.lit(reports).cast("bigint").alias("reports")
    )


def model_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.compare_job(spark, _features(spark, sf_dir), SEARCH_PARALLELISM).select("section", "name")


def model_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a training run logs, read back from the run table, and the coefficients of the model that it saves."""
    prepared = _features(spark, sf_dir)
    runs, path = new_path(spark, "runs"), new_path(spark, "model")
    jobs.train_job(spark, prepared, runs, path, "catalog")
    logged = read_runs(spark, runs).filter("kind = 'metric'").select("kind", "name", F.col("value").cast("double"))
    learned = classify.coefficients(classify.load_model(path), prepared)
    return logged.unionByName(learned.select(F.lit("coefficient").alias("kind"), "name", "value"))


def comparison_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of the fixed and the tuned model with all its values."""
    return jobs.compare_job(spark, _features(spark, sf_dir), SEARCH_PARALLELISM)


def search_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every point of the grid with its area under ROC on the validation rows, and which was chosen."""
    estimator = classify.logistic()
    grid = classify.parameter_grid(estimator)
    ready = jobs.prepare(_features(spark, sf_dir))
    return classify.search_results(spark, classify.tune(ready.train, estimator, grid, parallelism=SEARCH_PARALLELISM), grid)


def ab_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return long_metrics(compare.summary(_rules(spark, sf_dir)), by=("model",))


# Streaming


def json_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_messages(stand_ins.messages(_events(spark, sf_dir)))


def stream_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = _events(spark, sf_dir).schema
    # A pattern, because a stream of files takes a folder or a pattern but not the name of one file.
    arriving = spark.readStream.schema(schema).parquet(f"{sf_dir.rstrip('/')}/events.parque[t]")
    decoded = decode_messages(stand_ins.messages(arriving))
    target = new_path(spark, "decoded")
    start_table(decoded, target, new_path(spark, "decoded-checkpoint")).awaitTermination()
    return spark.read.schema(decoded.schema).parquet(target)


def stream_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = new_path(spark, "arriving"), new_path(spark, "landed")
    stand_ins.raw_lines(_events(spark, sf_dir)).write.partitionBy("day").text(source)
    checkpoint = new_path(spark, "landed-checkpoint")
    land_lines(spark, source, target, checkpoint, RAW_COLUMNS, stand_ins.HEADER).awaitTermination()
    landed = spark.read.parquet(target)
    return landed.withColumn("source_date", F.col("source_date").cast("string"))


def landed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files of ``file_ingest`` landed as they arrive, seven at a time, each by its own header."""
    source, target = _raw_files(spark, sf_dir), new_path(spark, "landed")
    checkpoint = new_path(spark, "landed-checkpoint")
    land_files(spark, source, target, checkpoint, stand_ins.HEADER, max_files_per_trigger=7).awaitTermination()
    return _dated_text(read_batches(spark, target))


def changed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files synchronised; the last day's file is replaced under its name by its complete lines; again.

    ``times_read`` says how often the files of a date were read.
    """
    source, target, seen = _raw_files(spark, sf_dir), new_path(spark, "synced"), new_path(spark, "seen")
    sync_files(spark, source, target, seen, stand_ins.HEADER)
    files = stand_ins.raw_files(_events(spark, sf_dir))
    last = files.agg(F.max("day")).head()[0]
    complete = (F.col("place") == 0) | (F.size(F.split("value", ",")) == len(RAW_COLUMNS))
    other = new_path(spark, "other-files")
    _write_files(files.filter((F.col("day") == last) & complete), other)
    _replace_file(spark, f"{other}/day={last}", f"{source}/day={last}")
    again = sync_files(spark, source, target, seen, stand_ins.HEADER)
    landed = _dated_text(spark.read.parquet(target))
    return landed.withColumn("times_read", F.when(F.col("source_date").isin(again), 2).otherwise(1))


def _replace_file(spark: SparkSession, new_folder: str, old_folder: str) -> None:
    """The one file of a folder takes the place and the name of the other folder's one."""
    system, _ = hadoop_path(spark, new_folder)
    pair = []
    for folder in (new_folder, old_folder):
        listed = system.listStatus(hadoop_path(spark, folder)[1])
        pair += [f.getPath() for f in listed if not f.getPath().getName().startswith(("_", "."))]
    system.delete(pair[1], False)
    system.rename(pair[0], pair[1])


def _arriving(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = _events(spark, sf_dir).schema
    arriving = spark.readStream.schema(schema).parquet(f"{sf_dir.rstrip('/')}/events.parque[t]")
    return arriving.withColumn("ts", F.col("ts").cast("timestamp"))


def _stored_stream(spark: SparkSession, stream: DataFrame, name: str) -> DataFrame:
    """What a stream appends until its input is used up."""
    target = new_path(spark, name)
    start_table(stream, target, new_path(spark, f"{name}-checkpoint")).awaitTermination()
    return spark.read.schema(stream.schema).parquet(target)


def fast_credit_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases soon after a click of the same user, both as streams."""
    asked = _arriving(spark, sf_dir).filter("event_type = 'click'").select("user_id", F.col("ts").alias("at"))
    issued = _arriving(spark, sf_dir).filter("event_type = 'purchase'")
    fast = fast_credit_stream(asked, issued.withColumnRenamed("ts", "at"), "user_id")
    return _stored_stream(spark, fast.select("event_id"), "fast-credits")


def stream_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per type and six hours, as far as the watermark has closed them."""
    counted = window_counts(_arriving(spark, sf_dir), "ts", "6 hours", ["event_type"])
    stored = _stored_stream(spark, counted, "windows")
    return stored.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("window_start", "window_end")})


def stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions with copies, those of the second half delivered once more in another file."""
    rows = with_event_time(_raw(spark, sf_dir), "tx_datetime").filter("event_time IS NOT NULL")
    source = new_path(spark, "delivered")
    middle = rows.agg(F.expr("timestamp_micros((unix_micros(min(event_time)) + unix_micros(max(event_time))) div 2)"))
    for delivery in (rows, rows.filter(F.col("event_time") >= F.lit(middle.head()[0]))):
        delivery.coalesce(1).write.mode("append").parquet(source)
    arriving = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(source)
    return _stored_stream(spark, dedupe_stream(arriving, RAW_COLUMNS, "event_time", "60 days"), "deduped").drop("event_time")


def runs_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty runs logged one by one, compacted after the twelfth and after the last, and read back.

    ``n_files`` is the number of files that the last version has.
    """
    path = new_path(spark, "runs-table")
    run = F.pmod("event_id", F.lit(20)).cast("string")
    totals = _events(spark, sf_dir).groupBy(run.alias("run"), "event_type").agg(F.count(F.lit(1)).alias("value"))
    totals = materialize(totals, "run-values")
    for i in range(20):
        log_run(run_rows(totals.filter(F.col("run") == str(i)), f"run-{i}", "LR", "metric", "event_type"), path)
        if i == 11:
            compact_runs(spark, path)
    compact_runs(spark, path)
    drop_logged(spark, path)
    n_files = read_version(spark, path).select(F.col("_metadata.file_path")).distinct().count()
    return read_runs(spark, path).drop("ts").withColumn("n_files", F.lit(n_files))


# Decisions


def stream_blacklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of listed users, in two batches; between them the list is published anew, with all listings.

    The first list knows only listings before the middle of the period; so do the events of the first batch.
    """
    events = _events(spark, sf_dir)
    middle = F.lit(events.agg(F.expr("date_add(min(ts), int(datediff(max(ts), min(ts)) div 2))")).head()[0])
    source, listed, target = (new_path(spark, n) for n in ("arriving-events", "device-list", "judged"))
    checkpoint = new_path(spark, "judged-checkpoint")
    early = F.to_date("ts") < middle
    for known, part in ((early, early), (F.lit(True), ~early)):
        publish(decide.listed_periods(_listings(events.filter(known)), "user_id"), listed)
        events.filter(part).write.mode("append").parquet(source)
        arriving = spark.readStream.schema(events.schema).parquet(source)
        judged = lambda batch, active: decide.blacklisted(batch, active, "user_id", "ts").select("event_id")
        start_with_list(arriving, listed, judged, target, checkpoint).awaitTermination()
    return read_batches(spark, target)


def _decided(events: DataFrame) -> DataFrame:
    return events.withColumn("decision", decide.decision(F.col("value"), 40, 100))


def _listings(events: DataFrame) -> DataFrame:
    risky = (F.col("event_type") == "error") & (F.col("value") > 150)
    return events.filter(risky).select("user_id", F.col("ts").alias("listed_at"))


def decision_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decided(_events(spark, sf_dir)).select("event_id", "decision")


def blacklist_payee(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir)
    active = decide.listed_periods(_listings(events), "user_id", months=3)
    return decide.blacklisted(events, active, "user_id", "ts").select("event_id")


def blacklist_device(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir)
    active = decide.listed_periods(_listings(events), "user_id")
    return decide.blacklisted(events, active, "user_id", "ts").select("event_id")


def whitelist(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir)
    organisations = events.filter((F.col("event_type") == "signup") & (F.col("value") > 250))
    return decide.whitelisted(_decided(events), organisations, "user_id").select(
        "event_id", "user_id", "decision"
    )


def average_fraud_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(decide.average_fraud_amount(_typed(spark, sf_dir)), {"avg_fraud_amount": 6})


def fast_credit_holds(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))

    def of(kind: str) -> DataFrame:
        return events.filter(F.col("event_type") == kind).select("user_id", F.col("ts").alias("at"))

    fast = decide.fast_credits(of("click"), of("purchase"), "user_id")
    return decide.held_after_fast_credit(events, fast, "user_id", "ts").select("event_id", "held")


def service_goals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(decide.service_goals(_rules(spark, sf_dir), by=("model",)), {"missed_loss": 2})


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "text_ingest": text_ingest,
        "file_ingest": file_ingest,
        "profile_report": profile_report,
        "ragged_rows": ragged,
        "profile": profile,
        "missing_by_column": missing_by_column,
        "complete_rows": complete_rows,
        "clean": clean,
        "reject_reasons": reject_reasons,
        "quarantine": quarantine,
        "quarantine_lines": quarantine_lines,
        "typed_features": typed_features,
        "terminal_rate": terminal_rate,
        "terminal_rate_lineitem": terminal_rate_lineitem,
        "risk_bucket": risk_buckets,
        "enrich": enrich,
        "enrich_unbounded": enrich_unbounded,
        "enrich_orders": enrich_orders,
        "fraud_free_terminals": fraud_free_terminals,
        "fraud_free_first": fraud_free_first,
        "class_balance": class_balance,
        "oversample": oversample,
        "oversample_by_union": oversample_by_union,
        "hash_split": hash_split,
        "hash_split_counts": hash_split_counts,
        "random_split": random_split,
        "sample_with_replacement": sample_with_replacement,
        "hash_sample": hash_sample,
        "string_index": string_index,
        "string_index_wide": string_index_wide,
        "one_hot": one_hot,
        "min_max": min_max,
        "assemble_skip": assemble_skip,
        "skipped_rows": skipped,
        "confusion": confusion_counts,
        "confusion_matrix": matrix,
        "metrics": metric_values,
        "auc": auc,
        "bootstrap": bootstrap,
        "bootstrap_summary": bootstrap_summary,
        "density": density,
        "histogram": histogram,
        "ab_test": ab_test,
        "ab_interval": ab_interval,
        "ab_summary": ab_summary,
        "prepared_rows": prepared_rows,
        "train_predict": train_predict,
        "train_metrics": train_metrics,
        "training_summary": training_summary,
        "train_leak_free": train_leak_free,
        "grid_search": grid_search,
        "cross_validation": cross_validation,
        "score_saved": score_saved,
        "model_comparison": model_comparison,
        "model_values": model_values,
        "comparison_values": comparison_values,
        "search_values": search_values,
        "json_decode": json_decode,
        "stream_decode": stream_decode,
        "stream_landing": stream_landing,
        "landed_files": landed_files,
        "changed_files": changed_files,
        "fast_credit_stream": fast_credit_arrivals,
        "stream_windows": stream_windows,
        "stream_dedupe": stream_dedupe,
        "stream_blacklist": stream_blacklist,
        "runs_compacted": runs_compacted,
        "decision_tiers": decision_tiers,
        "blacklist_payee": blacklist_payee,
        "blacklist_device": blacklist_device,
        "whitelist": whitelist,
        "average_fraud_amount": average_fraud_amount,
        "fast_credit_holds": fast_credit_holds,
        "service_goals": service_goals,
    }
