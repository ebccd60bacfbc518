"""Answer 'user_id,product_id' requests from the feature store.

Only the distinct keys of the requests are looked up and scored; a key asked
for very often is one row until its answer joins the requests again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rebasket.functions.decisions import PAGE_THRESHOLD, above, verdict
from rebasket.functions.keys import PAIR, user_bucket
from rebasket.functions.packing import request_key, unpack
from rebasket.functions.ratios import FEATURES
from rebasket.operators.model import probability
from rebasket.session import stored
from rebasket.sources.files import STORE_BUCKETS
from rebasket.sources.schemas import REQUESTS

# Whether the shuffle files of a finished query are deleted at once, and not when its objects are collected.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def with_keys(requests: DataFrame) -> DataFrame:
    """Requests with the two keys of their body; a key that cannot be read is NULL."""
    return requests.select("body", request_key("body", 0).alias("user_id"),
                           request_key("body", 1).alias("product_id"))


def wanted_keys(keyed: DataFrame) -> DataFrame:
    return keyed.select(*PAIR).where(F.col("user_id").isNotNull() & F.col("product_id").isNotNull()).distinct()


def _answer(keyed: DataFrame, found: DataFrame) -> DataFrame:
    """Every request with its found columns and a status."""
    rows = keyed.join(found.withColumn("_found", F.lit(True)), PAIR, "left")
    unreadable = F.col("user_id").isNull() | F.col("product_id").isNull()
    status = F.when(unreadable, "bad_request").when(F.col("_found"), "ok").otherwise("unknown_key")
    return rows.withColumn("status", status).drop("_found")


def lookup(requests: DataFrame, store: DataFrame) -> DataFrame:
    """Requests with their packed features."""
    keyed = with_keys(requests)
    found = store.join(wanted_keys(keyed), PAIR).select(*PAIR, "feature")
    return _answer(keyed, found)


def _found(wanted: DataFrame, store: DataFrame) -> DataFrame:
    """The wanted keys' rows of a store by user bucket; ``wanted`` is stored and knows its buckets.

    Stored keys have a known size, so they are broadcast when that allows and the
    store is not shuffled; only their buckets are read.
    """
    # At most one small number per bucket comes to the driver.
    touched = [r.user_bucket for r in wanted.select("user_bucket").distinct().collect()]
    return store.where(F.col("user_bucket").isin(touched)).join(wanted.select(*PAIR), PAIR).select(*PAIR, "feature")


def lookup_stored(requests: DataFrame, store: DataFrame, buckets: int = STORE_BUCKETS) -> DataFrame:
    """The same answers from a store written by user bucket: only the requests' buckets are read."""
    keyed = with_keys(requests)
    wanted = stored(wanted_keys(keyed).withColumn("user_bucket", user_bucket(buckets)), "wanted")
    return _answer(keyed, _found(wanted, store))


def score_found(found: DataFrame, model: PipelineModel) -> DataFrame:
    """Probability per looked-up key."""
    return probability(model.transform(found.withColumns(unpack("feature", FEATURES)))).select(*PAIR, "prob")


def _decided(answered: DataFrame, threshold: float) -> DataFrame:
    return answered.select(
        "body", *PAIR, "status", "prob",
        above("prob", threshold).alias("decision"),
        F.when(F.col("status") == "ok", verdict("prob", threshold)).alias("verdict"),
    )


def score_requests(requests: DataFrame, store: DataFrame, model: PipelineModel,
                   threshold: float = PAGE_THRESHOLD) -> DataFrame:
    """Probability, 0/1 decision and answer text per request; a request whose
    key is not in the store has no probability."""
    keyed = with_keys(requests)
    found = store.join(wanted_keys(keyed), PAIR)
    return _decided(_answer(keyed, score_found(found, model)), threshold)


def score_vectors(requests: DataFrame, model: PipelineModel,
                  threshold: float = PAGE_THRESHOLD) -> DataFrame:
    """Requests whose body is the packed vector itself.

    A body with another number of fields, or with a field that is neither empty
    nor a number, is a 'bad_request' and is not scored.
    """
    fields = F.split("body", ",")
    odd = F.exists(fields, lambda f: (F.trim(f) != "") & (f.try_cast("double").isNull() | F.isnan(f.try_cast("double"))))
    bad = F.coalesce((F.size(fields) != len(FEATURES)) | odd, F.lit(True))
    rows = requests.withColumns({**unpack("body", FEATURES), "status": F.when(bad, "bad_request").otherwise("ok")})
    scored = probability(model.transform(rows))
    prob = F.when(F.col("status") == "ok", F.col("prob"))
    return scored.select("body", "status", prob.alias("prob")).select(
        "body", "status", "prob", above("prob", threshold).alias("decision"),
        F.when(F.col("status") == "ok", verdict("prob", threshold)).alias("verdict"))


def request_stream(spark: SparkSession, landing: str, files_per_batch: int | None = None) -> DataFrame:
    """Text files of request lines as a stream."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.schema(REQUESTS).text(landing)


def _stream(requests: DataFrame, store: DataFrame, out: str, checkpoint: str,
            finish: Callable[[DataFrame, DataFrame], DataFrame], buckets: int,
            interval: str | None) -> StreamingQuery:
    """Per micro-batch: store the wanted keys, read their buckets of the feature
    store, write the answers of the batch in place of any earlier attempt.

    The stored keys have a known size, so the planner broadcasts them when they
    are small and the feature store is filtered where it is read.
    """
    def answer(batch: DataFrame, batch_id: int) -> None:
        keyed = with_keys(batch)
        path = f"{out}/_wanted"  # hidden from readers of the answers
        marked = wanted_keys(keyed).withColumn("user_bucket", user_bucket(buckets))
        marked.write.mode("overwrite").parquet(path)
        wanted = batch.sparkSession.read.schema(f"{PAIR[0]} bigint, {PAIR[1]} bigint, user_bucket int").parquet(path)
        finish(keyed, _found(wanted, store)).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return (
        requests.writeStream.foreachBatch(answer)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def lookup_stream(requests: DataFrame, store: DataFrame, out: str, checkpoint: str,
                  buckets: int = STORE_BUCKETS, interval: str | None = None) -> StreamingQuery:
    """Answer a request stream with packed features; stops when all landed
    requests are done, or runs on at an interval."""
    return _stream(requests, store, out, checkpoint, _answer, buckets, interval)


def score_stream(requests: DataFrame, store: DataFrame, model: PipelineModel, out: str, checkpoint: str,
                 threshold: float = PAGE_THRESHOLD, buckets: int = STORE_BUCKETS,
                 interval: str | None = None) -> StreamingQuery:
    """Answer a request stream with probability, decision and text."""
    def finish(keyed: DataFrame, found: DataFrame) -> DataFrame:
        return _decided(_answer(keyed, score_found(found, model)), threshold)

    return _stream(requests, store, out, checkpoint, finish, buckets, interval)


def lookup_joined(requests: DataFrame, store: DataFrame, out: str, checkpoint: str,
                  interval: str | None = None) -> StreamingQuery:
    """Answer a request stream by a left join with the store inside the streaming plan.

    Every micro-batch joins the store as it stands; answers are appended by the
    file sink, which with the checkpoint writes each request's answer once, also after
    a restart. Readers of ``out`` see finished batches only. A batch's shuffle files
    go when it ends, so those of the store do not add up over the batches.
    """
    answered = _answer(with_keys(requests), store.select(*PAIR, "feature"))
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    stream = (
        answered.writeStream.format("parquet").outputMode("append")
        .option("path", out).option("checkpointLocation", checkpoint)
        .trigger(**trigger)
    )
    conf = requests.sparkSession.conf
    before = conf.get(SHUFFLES_GO, "false")
    conf.set(SHUFFLES_GO, "true")
    try:
        return stream.start()  # the query goes on with the settings of this moment
    finally:
        conf.set(SHUFFLES_GO, before)
