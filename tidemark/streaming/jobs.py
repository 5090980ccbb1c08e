"""The pipelines as continuous streams, each layer a topic directory for the next.

Every stream has its checkpoint below the cluster's shared folder, named after the
stream, so a restart goes on where it stopped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..catalog import DIMENSIONS, FACTS, SOURCES
from ..config import Settings
from ..functions.cdc import cut_rows, landed_rows, parse_changes, rejected_rows
from ..plans import dimensions, facts
from ..sources.sinks import append_batch
from ..sources.topics import (
    read_changes,
    read_dimension,
    read_landing,
    read_rows,
    to_json_rows,
)
from ..sources.versions import merge_versions, read_versions
from . import operators as streams


def checkpoint(spark: SparkSession, settings: Settings, name: str) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None) or f"{settings.root}/checkpoints"
    return f"{base.rstrip('/')}/{settings.dataset(name).strip('/').replace('/', '_')}"


def _trigger(every: str | None) -> dict:
    return {"processingTime": every} if every else {"availableNow": True}


def _start(stream: DataFrame, name: str, settings: Settings, every: str | None,
           kafka_servers: str | None = None) -> StreamingQuery:
    """Append a stream to its topic: a directory, or Kafka where servers are given."""
    where = checkpoint(stream.sparkSession, settings, name)
    if kafka_servers is not None:
        writer = to_json_rows(stream).writeStream.format("kafka").option(
            "kafka.bootstrap.servers", kafka_servers).option("topic", settings.topic(name))
    else:
        writer = stream.writeStream.format("parquet").option("path", settings.dataset(name))
    return (writer.queryName(name).outputMode("append").option("checkpointLocation", where)
            .trigger(**_trigger(every)).start())


def start_landing(spark: SparkSession, table: str, settings: Settings, *,
                  every: str | None = None, sink_servers: str | None = None,
                  cut_texts: bool = True, **source) -> StreamingQuery:
    """A landing; runs to the end of its input unless ``every`` sets an interval.

    ``source`` says how to read the change topic; ``sink_servers`` writes to Kafka.
    ``cut_texts=False`` lands texts whole.
    """
    messages = read_changes(spark, table, settings, streaming=True, **source)
    parsed = parse_changes(messages, table, cut_texts=cut_texts)
    return _start(landed_rows(parsed), SOURCES[table].landing, settings, every, sink_servers)


def start_rejected(spark: SparkSession, table: str, settings: Settings, *,
                   every: str | None = None, **source) -> StreamingQuery:
    """The messages a landing cannot type, with the reason."""
    messages = read_changes(spark, table, settings, streaming=True, **source)
    name = f"{SOURCES[table].landing}.rejected"
    return _start(rejected_rows(parse_changes(messages, table)), name, settings, every)


def start_cut(spark: SparkSession, table: str, settings: Settings, *,
              every: str | None = None, **source) -> StreamingQuery:
    """The messages whose texts a landing cuts, with the names of the columns."""
    messages = read_changes(spark, table, settings, streaming=True, **source)
    parsed = parse_changes(messages, table, cut_texts=False)
    return _start(cut_rows(parsed, table), f"{SOURCES[table].landing}.cut", settings, every)


def start_joined_feed(spark: SparkSession, name: str, settings: Settings, *,
                      every: str | None = None) -> StreamingQuery:
    """Books with authors or services with carriers, as the feed of their dimension."""
    streams.use_state_store(spark)
    joined = _joined_feed(spark, name, settings)
    return _start(joined, f"{DIMENSIONS[name].topic}.joined", settings, every)


def _joined_feed(spark: SparkSession, name: str, settings: Settings) -> DataFrame:
    child, parent, on, key, columns = {
        "books": ("books", "authors", "author_id", "book_id", dimensions.AUTHOR_COLUMNS),
        "carrier_services": ("shipping_services", "carriers", "carrier_id", "service_id",
                             dimensions.CARRIER_COLUMNS),
    }[name]
    return streams.stream_latest_state_join(
        read_landing(spark, child, settings, streaming=True),
        read_landing(spark, parent, settings, streaming=True), on, key, parent_columns=columns,
        child_parts=streams.MANY_CHILDREN)


def _feed(spark: SparkSession, name: str, settings: Settings) -> DataFrame:
    if name in ("orders", "customers"):
        return read_landing(spark, name, settings, streaming=True)
    schema = _joined_feed(spark, name, settings).schema
    path = settings.dataset(f"{DIMENSIONS[name].topic}.joined")
    return read_rows(spark, path, schema, streaming=True)


def dimension_changelog(spark: SparkSession, name: str, settings: Settings, *,
                        ending: str | None = None, with_late: bool = False,
                        processing_time: bool = False) -> DataFrame:
    """Open and closing rows of a dimension as a stream, with late changes on request."""
    dimension = DIMENSIONS[name]
    key = dimensions.ATTRIBUTES[name][dimension.key]
    log = streams.stream_changelog(
        _feed(spark, name, settings), key, dimensions.attribute_columns(name),
        sk=dimension.sk, entity=dimension.table, settings=settings, ending=ending, with_late=with_late,
        event_time_mode=not processing_time)
    return log.select(*dimension.schema.fieldNames(), *(["late"] if with_late else []))


def _ended(spark: SparkSession, start: Callable[[], StreamingQuery], ending: str | None) -> StreamingQuery:
    """Start a stream; of a bounded input, work all of it off before its end is announced."""
    if ending is not None:
        streams.finish(start())
        streams.release(spark, ending)
    return start()


def start_dimension(spark: SparkSession, name: str, settings: Settings, *,
                    every: str | None = None, bounded: bool = False,
                    sink_servers: str | None = None, processing_time: bool = False) -> StreamingQuery:
    """The changelog topic of a dimension, and its changes that came too late (``.late``).

    ``bounded`` replays a finished input. With ``processing_time`` changes are held and put in
    order for ``settings.buffer_ms`` by the clock, and a key's current version is forgotten
    ``settings.state_ttl_ms`` after its last change, if that is set. Such a stream has to go on
    running for its timers to come, so it needs ``every`` and cannot be ``bounded``.
    """
    if processing_time and (every is None or bounded):
        raise ValueError("processing_time needs every, and no bounded input")
    streams.use_state_store(spark)
    topic = DIMENSIONS[name].topic
    ending = f"{settings.dataset(topic)}.end" if bounded else None
    if sink_servers is not None:
        log = dimension_changelog(spark, name, settings, ending=ending,
                                  processing_time=processing_time)
        return _ended(spark, lambda: _start(log, topic, settings, every, sink_servers), ending)
    log = dimension_changelog(spark, name, settings, ending=ending, with_late=True,
                              processing_time=processing_time)

    def write(rows: DataFrame, number: int) -> None:
        rows.persist()
        append_batch(rows.where("NOT late").drop("late"), settings.dataset(topic), number)
        append_batch(rows.where("late").drop("late"), f"{settings.dataset(topic)}.late", number)
        rows.unpersist()

    return _ended(spark, lambda: _each_batch(log, write, topic, settings, every), ending)


def start_consolidated(spark: SparkSession, name: str, settings: Settings, *,
                       every: str | None = None, bounded: bool = False) -> StreamingQuery:
    """The changelog topic with open rows held until their acceptance window ends."""
    streams.use_state_store(spark)
    dimension = DIMENSIONS[name]
    topic = f"{dimension.topic}.consolidated"
    ending = f"{settings.dataset(topic)}.end" if bounded else None
    log = read_dimension(spark, name, settings, streaming=True)
    held = streams.stream_consolidated(log, dimension.sk, settings=settings, ending=ending)
    return _ended(spark, lambda: _start(held, topic, settings, every), ending)


def start_dimension_table(spark: SparkSession, name: str, settings: Settings, *,
                          every: str | None = None) -> StreamingQuery:
    """Merge the changelog topic into the dimension table, batch by batch."""
    dimension = DIMENSIONS[name]
    log = read_dimension(spark, name, settings, streaming=True)
    path = settings.dataset(dimension.table)
    return (log.writeStream.queryName(dimension.table)
            .option("checkpointLocation", checkpoint(spark, settings, dimension.table))
            .foreachBatch(lambda rows, n: merge_versions(rows, path, dimension.sk, n))
            .trigger(**_trigger(every)).start())


def dimension_table(spark: SparkSession, name: str, settings: Settings) -> DataFrame:
    dimension = DIMENSIONS[name]
    return read_versions(spark, settings.dataset(dimension.table), dimension.schema, dimension.sk)


#: The joins of each fact in their order: dimension, keys of fact and dimension, columns taken.
FACT_JOINS = {
    "order_items": (("orders", ("order_id", "orderId"), ("orderSk", "customerId")),
                    ("customers", ("customerId", "customerId"), ("customerSk",)),
                    ("books", ("book_id", "bookId"), ("bookSk",))),
    "shipment_events": (("orders", ("order_id", "orderId"), ("orderSk",)),
                        ("carrier_services", ("service_id", "serviceId"), ("carrierServiceSk",))),
}
EVENT_KEYS = {"order_items": "order_item_id", "shipment_events": "event_id"}
EVENT_COLUMNS = {"order_items": ("order_id", "book_id", "quantity", "price_at_purchase", "discount"),
                 "shipment_events": ("shipment_id", "status", "location")}
#: Times in milliseconds stay below this.
_TIMES = 1 << 43


def event_revisions(spark: SparkSession, name: str, settings: Settings) -> DataFrame:
    """What became of each event of a fact so far, as a stream in update mode."""
    return streams.stream_revisions(
        read_landing(spark, name, settings, streaming=True), EVENT_KEYS[name],
        columns=EVENT_COLUMNS[name])


def _revisions(spark: SparkSession, name: str, settings: Settings, streaming: bool) -> DataFrame:
    """The topic that facts are made from: item revisions, or events with their shipments."""
    revised = event_revisions(spark, name, settings)
    topic = f"{FACTS[name].topic}.revisions"
    if name == "shipment_events":
        revised, topic = with_shipments(spark, settings), f"{FACTS[name].topic}.shipped"
    return read_rows(spark, settings.dataset(topic), revised.schema, streaming=streaming)


def with_shipments(spark: SparkSession, settings: Settings) -> DataFrame:
    """Event revisions with their shipment's latest state; a change of either gives them anew.

    Their revision counts the event's changes first and the shipment's time second.
    """
    schema = event_revisions(spark, "shipment_events", settings).schema
    topic = settings.dataset(f"{FACTS['shipment_events'].topic}.revisions")
    events = read_rows(spark, topic, schema, streaming=True)
    # Events are put in order by revision, not by the time of their creation.
    events = events.withColumnsRenamed({"ts_ms": "created_ms", "revision": "ts_ms"})
    joined = streams.stream_latest_state_join(
        events, read_landing(spark, "shipments", settings, streaming=True), "shipment_id", "event_id",
        parent_columns={**{c: c for c in facts.SHIPMENT_COLUMNS}, "ts_ms": "shipment_ms"},
        effective_time="child")
    revision = F.col("ts_ms") * F.lit(_TIMES) + F.col("shipment_ms")
    return joined.select("event_id", F.col("created_ms").alias("ts_ms"), revision.alias("revision"),
                         *EVENT_COLUMNS["shipment_events"], "op", *facts.SHIPMENT_COLUMNS)


def _fact_topic(name: str, step: int) -> str:
    return f"{FACTS[name].topic}.with_{FACT_JOINS[name][step][0]}"


def fact_join(spark: SparkSession, name: str, step: int, settings: Settings,
              ending: str | None = None) -> DataFrame:
    """A fact's revisions with one more dimension, as a stream; ``matched`` tells the outcome."""
    dimension, on, take = FACT_JOINS[name][step]
    if step == 0:
        rows = _revisions(spark, name, settings, streaming=True).where("op IS NULL OR op <> 'd'")
    else:
        schema = fact_join(spark, name, step - 1, settings).drop("matched").schema
        rows = read_rows(spark, settings.dataset(_fact_topic(name, step - 1)), schema, streaming=True)
    return streams.stream_as_of_join(
        rows, read_dimension(spark, dimension, settings, streaming=True), on, EVENT_KEYS[name],
        take=take, settings=settings, ending=ending)


def start_fact(spark: SparkSession, name: str, settings: Settings, *, every: str | None = None,
               bounded: bool = False) -> list[StreamingQuery]:
    """The streams of a fact: revisions of its events, and a join with each dimension in turn.

    Facts wait for dimensions that lag behind; what has no valid version goes to a topic of its own
    (``.without_<dimension>``). A later change of an event, or a delete, withdraws the facts
    before it, see :func:`fact_table`. Without ``every`` each stream runs to the end of its
    input before the next starts, with ``bounded`` to the end of its dimension too.
    """
    streams.use_state_store(spark)
    topic, queries = FACTS[name].topic, []

    def started(query: StreamingQuery) -> None:
        if every is None:
            streams.finish(query)
        queries.append(query)

    def appended(target: str) -> Callable[[DataFrame, int], None]:
        return lambda rows, number: append_batch(rows, settings.dataset(target), number)

    def split(target: str, without: str) -> Callable[[DataFrame, int], None]:
        def write(rows: DataFrame, number: int) -> None:
            rows.persist()
            append_batch(rows.where("matched").drop("matched"), settings.dataset(target), number)
            append_batch(rows.where("NOT matched").drop("matched"), settings.dataset(without), number)
            rows.unpersist()

        return write

    started(_each_batch(event_revisions(spark, name, settings), appended(f"{topic}.revisions"),
                        f"{topic}.revisions", settings, every, mode="update"))
    if name == "shipment_events":
        started(_each_batch(with_shipments(spark, settings), appended(f"{topic}.shipped"),
                            f"{topic}.shipped", settings, every))
    for step, (dimension, _, _) in enumerate(FACT_JOINS[name]):
        target = _fact_topic(name, step)
        ending = f"{settings.dataset(target)}.end" if bounded else None
        joined = fact_join(spark, name, step, settings, ending)
        write = split(target, f"{topic}.without_{dimension}")
        started(_ended(spark, lambda j=joined, w=write, t=target: _each_batch(j, w, t, settings, every),
                       ending))
    return queries


def fact_table(spark: SparkSession, name: str, settings: Settings) -> DataFrame:
    """The facts that hold, of all that the streams of :func:`start_fact` have written."""
    last = len(FACT_JOINS[name]) - 1
    schema = fact_join(spark, name, last, settings).drop("matched").schema
    rows = read_rows(spark, settings.dataset(_fact_topic(name, last)), schema)
    held = streams.fold_revisions(rows, _revisions(spark, name, settings, streaming=False),
                                  EVENT_KEYS[name])
    if name == "shipment_events":
        return facts.shipment_event_fact(held)
    return facts.order_item_fact(held.withColumns({
        "priceAtPurchase": F.col("price_at_purchase").cast("double"),
        "discount": F.col("discount").cast("double")}))


def _each_batch(stream: DataFrame, write: Callable[[DataFrame, int], None], name: str,
                settings: Settings, every: str | None, mode: str = "append") -> StreamingQuery:
    return streams.each_batch(
        stream, write, checkpoint=checkpoint(stream.sparkSession, settings, name), name=name,
        mode=mode, every=every)
