"""From a specification to the composed event stream of all its inputs."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.files import Files
from tidegauge.operators.deliver import deliver, write_rejects
from tidegauge.operators.delivered import Delivered
from tidegauge.operators.events import dedupe_events, merge_streams, split_rejects
from tidegauge.operators.extract import extract_log_events, filter_logs
from tidegauge.operators.metrics import metric_events
from tidegauge.operators.queries import cloudwatch_query_plan, datadog_query_plan
from tidegauge.operators.ledger import OffsetStore
from tidegauge.operators.ranges import (
    OffsetTable,
    commit_offsets,
    duplicate_streams,
    offsets_from_delivered,
    plan_ranges,
    resolve_offsets,
)
from tidegauge.plans.spec import STEP_MS, FlowSpec, InputSpec, input_keys
from tidegauge.schema import CONTENT, REJECT
from tidegauge.session import config_table, configure, shared_dir
from tidegauge.sources import PAGE_FILES, normalizer_for
from tidegauge.sources.pull import PageFetcher, PulledPages, pull_ranges
from tidegauge.streaming import poll_trigger, stream_run, stream_to

Transform = Callable[[DataFrame], DataFrame]


def query_plan(spark: SparkSession, spec: InputSpec) -> DataFrame | None:
    """The metric queries of an input, when its provider looks series up by query."""
    if spec.cloudwatch is not None:
        cw = spec.cloudwatch
        row = {
            "stream_key": spec.stream_key,
            "namespace": cw.namespace,
            "metric_name": cw.metric_name,
            "period": cw.period,
            "statistic": cw.statistic,
            "organization_identifier": cw.organization_identifier,
            "metric_queries": [
                [{"name": n, "value": v} for n, v in dims.items()] for dims in cw.metric_queries
            ],
        }
        schema = (
            "stream_key string, namespace string, metric_name string, period int, "
            "statistic string, organization_identifier string, "
            "metric_queries array<array<struct<name:string,value:string>>>"
        )
        return cloudwatch_query_plan(config_table(spark, [row], schema))
    if spec.datadog is not None:
        dd = spec.datadog
        row = {
            "stream_key": spec.stream_key,
            "metric_name": dd.metric_name,
            "statistic": dd.statistic,
            "metric_tag_data": [
                {"customer_value": t.customer_value, "tag_string": t.tag_string}
                for t in dd.metric_tag_data
            ],
        }
        schema = (
            "stream_key string, metric_name string, statistic string, "
            "metric_tag_data array<struct<customer_value:string,tag_string:string>>"
        )
        return datadog_query_plan(config_table(spark, [row], schema))
    return None


def _pages_of(spec: InputSpec) -> Column:
    return (
        (F.col("stream_key") == spec.stream_key)
        & (F.col("provider") == spec.provider)
        & (F.col("kind") == spec.kind)
    )


def input_events(
    spark: SparkSession,
    spec: InputSpec,
    pages: DataFrame,
    transforms: Sequence[Transform] = (),
    input_key: str | None = None,
) -> DataFrame:
    """Events of one input plus ``content`` and ``reject_reason``. The conditions on the pages
    are on plain columns, so they prune partitions and row groups of the landed table. With
    ``input_key`` only pages fetched for that input are taken."""
    own = pages.where(_pages_of(spec))
    if input_key is not None:
        own = own.where(F.col("input_key") == input_key)
    rows = normalizer_for(spec.provider, spec.kind)(own, spec, query_plan(spark, spec))
    if spec.predicate:
        rows = filter_logs(rows, F.col("reject_reason").isNotNull() | F.expr(spec.predicate))
    if spec.kind == "logs":
        events = extract_log_events(rows, spec.filters)
    else:
        events = metric_events(rows, spec.filters)
    for transform in transforms:
        events = events.transform(transform)
    return events


#: Outcomes of accepted rows that are not stored.
LATE, REPEATED, STORED = "late", "repeated", "delivered"


@dataclass(frozen=True)
class Flow:
    """Lazy results of a specification: all rows, and their accepted and rejected halves."""

    spec: FlowSpec
    rows: DataFrame
    events: DataFrame
    rejects: DataFrame
    parts: tuple[DataFrame, ...]  # the accepted events of each input
    pages: DataFrame
    transforms: tuple[Transform, ...] = ()

    def deliver(
        self, run_id: str = "batch", dedupe: bool = True, lateness: str | None = None
    ) -> None:
        """Deliver a batch to the specified output, and rejected rows to its quarantine.

        With ``dedupe`` an event that a table holds from another run is not delivered to it
        again. With ``lateness``, an interval such as ``1 hour``, events of a stream that lie
        further than that behind the latest one earlier runs stored are not delivered to the
        table but go to quarantine as ``late``. A table keeps the counts of every outcome.
        """
        out = self.spec.output
        if lateness is not None and (out.type != "table" or not out.quarantine):
            raise ValueError("late events need a table that knows the latest one, and a quarantine")
        if not out.quarantine and not (dedupe and out.type == "table"):
            events = dedupe_events(self.events) if dedupe else self.events
            deliver(events, out.type, path=out.path, post=out.post, run_id=run_id)
            return
        # all outcomes from one pass over the pages, which are decoded once
        spark = self.rows.sparkSession
        landed = shared_dir(spark, f"flow-{run_id}")
        rows = self.rows.withColumn("_accepted", F.col(REJECT).isNull())
        rows.write.partitionBy("_accepted").parquet(landed)
        rows = spark.read.schema(rows.schema).parquet(landed)
        index = Delivered(spark, out.path) if out.type == "table" else None
        if lateness is not None:
            rows = _mark_late(rows, index.maxima(but_run=run_id), lateness)
        if out.quarantine:
            rejects = rows.where(F.col(REJECT).isNotNull()).drop("_accepted")
            write_rejects(rejects, out.quarantine, run_id)
        accepted = rows.where(F.col(REJECT).isNull()).select(*self.events.columns)
        events = dedupe_events(accepted) if dedupe else accepted
        if dedupe and index is not None:
            # the landed rows say which dates are at hand; copies among them don't matter
            events = dedupe_events(index.not_delivered(accepted, run_id))
        deliver(events, out.type, path=out.path, post=out.post, run_id=run_id)
        if index is not None:
            index.write_counts(_outcomes(rows, index, run_id), run_id)
        Files(spark).remove(landed)

    def stream(
        self,
        checkpoint: str,
        watermark: str | None = None,
        available_now: bool = False,
        lateness: str | None = None,
    ):
        """A writer that delivers the stream to the specified output.

        Into a table, or with a quarantine, each batch is a run of ``deliver``: its pages are
        landed once and routed to all inputs, so a pull source fetches each range once; rejected
        and late rows are kept under the run's id, which a replay writes over; an event that any
        run, batch or stream, has stored is not stored again, however late it repeats. Other
        outputs drop repeats within ``watermark``, each input having a watermark of its own, or
        none without it.
        """
        out = self.spec.output
        if out.type == "table" or out.quarantine:
            writer = self.pages.writeStream.foreachBatch(self._batch(checkpoint, lateness))
            writer = writer.option("checkpointLocation", checkpoint)
            if available_now:
                return writer.trigger(availableNow=True)
            return writer.trigger(**poll_trigger())
        if lateness is not None:
            raise ValueError("late events need a table that knows the latest one, and a quarantine")
        events = dedupe_events(self.parts, watermark) if watermark else self.events
        return stream_to(
            events, out.type, checkpoint, path=out.path, post=out.post, available_now=available_now
        )

    def _batch(self, checkpoint: str, lateness: str | None) -> Callable[[DataFrame, int], None]:
        spec, transforms = self.spec, self.transforms

        def run(batch: DataFrame, batch_id: int) -> None:
            spark = batch.sparkSession
            run_id = stream_run(spark, checkpoint, batch_id)
            landed = shared_dir(spark, f"pages-{run_id}")
            batch.write.partitionBy("stream_key").options(**PAGE_FILES).parquet(landed)
            pages = spark.read.schema(batch.schema).parquet(landed)
            build_flow(spark, spec, pages, transforms).deliver(run_id, lateness=lateness)
            Files(spark).remove(landed)

        return run


def _mark_late(rows: DataFrame, maxima: DataFrame, lateness: str) -> DataFrame:
    """Rows with ``late`` as the reason of accepted ones behind their stream's bar.

    The bars, one row per stream, are broadcast: a join by stream would put all rows of a stream
    into one task, and so would the steps behind it, as rows that lie together by stream also do
    by event.
    """
    bars = maxima.groupBy(F.col("stream_key").alias("_stream")).agg(
        (F.max("event_ts") - F.expr(f"interval {lateness}")).alias("_bar")
    )
    late = F.col(REJECT).isNull() & (F.col("event_ts") < F.col("_bar"))
    marked = rows.join(F.broadcast(bars), F.col("stream_key") == F.col("_stream"), "left")
    return marked.withColumn(REJECT, F.when(late, LATE).otherwise(F.col(REJECT))).drop("_stream", "_bar")


def _outcomes(rows: DataFrame, index: Delivered, run_id: str) -> DataFrame:
    """``(stream_key, outcome, n)``: what became of every row; the rest of the accepted rows
    were stored before, by this run or another."""
    stored = index.maxima().where(F.col("run_id") == run_id)
    signed = rows.select(
        "stream_key", F.coalesce(REJECT, F.lit(REPEATED)).alias("outcome"), F.lit(1).alias("n")
    ).unionAll(stored.select("stream_key", F.lit(REPEATED), -F.col("n")))
    signed = signed.unionAll(stored.select("stream_key", F.lit(STORED), "n"))
    counted = signed.groupBy("stream_key", "outcome").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") > 0)


def build_flow(
    spark: SparkSession,
    spec: FlowSpec,
    pages: DataFrame | PulledPages,
    transforms: Sequence[Transform] = (),
) -> Flow:
    """Compose all inputs of a specification over landed or pulled pages, batch or streaming.

    Of ``PulledPages`` every input has a frame of its own, so each range is fetched once.

    Inputs that share stream key, provider and kind take the pages that name them in
    ``input_key``; pages of theirs that name none of them are rejected as ``unknown_input``.
    """
    configure(spark)
    names = [(i.stream_key, i.provider, i.kind) for i in spec.inputs]
    shared = {n for n in names if names.count(n) > 1}
    keys = input_keys([i.stream_key for i in spec.inputs])
    stray = []
    if isinstance(pages, PulledPages):
        inputs = [
            input_events(spark, i, _pulled(pages, i, key, name in shared), transforms)
            for i, name, key in zip(spec.inputs, names, keys, strict=True)
        ]
        whole = pages.frame()
    else:
        whole = pages
        if shared and "input_key" not in pages.columns:
            # nothing tells such inputs apart, and each would take all their pages
            raise ValueError("inputs share stream key, provider and kind: pages need an input_key")
        inputs = [
            input_events(spark, i, pages, transforms, key if name in shared else None)
            for i, name, key in zip(spec.inputs, names, keys, strict=True)
        ]
        for name in sorted(shared):
            known = [k for k, n in zip(keys, names, strict=True) if n == name]
            one = spec.inputs[names.index(name)]
            stray.append(_unknown_input(pages.where(_pages_of(one)), known, inputs[0]))
    rows = merge_streams(*inputs, *stray)
    events, rejects = split_rejects(rows)
    parts = tuple(split_rejects(i)[0] for i in inputs)
    return Flow(spec, rows, events, rejects, parts, whole, tuple(transforms))


def _pulled(pages: PulledPages, spec: InputSpec, key: str, shared: bool) -> DataFrame:
    named = {"input_key": key} if shared else {}
    return pages.frame(
        stream_key=spec.stream_key, provider=spec.provider, kind=spec.kind, **named
    )


def _unknown_input(pages: DataFrame, known: list[str], like: DataFrame) -> DataFrame:
    """Rejected rows, in the columns of ``like``, for pages that name none of the inputs."""
    named = F.coalesce(F.col("input_key").isin(*known), F.lit(False))
    values = {
        "stream_key": F.col("stream_key"),
        CONTENT: F.col("body"),
        REJECT: F.lit("unknown_input"),
    }
    return pages.where(~named).select(
        *[
            values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in like.schema.fields
        ]
    )


# --- resuming -------------------------------------------------------------------------


def input_table(spark: SparkSession, spec: FlowSpec) -> DataFrame:
    """The inputs as rows, with the offset key that tells inputs of one stream apart, and the
    key that their offset is stored by."""
    keys = input_keys([i.stream_key for i in spec.inputs])
    rows = [
        {
            "pos": pos,
            "stream_key": i.stream_key,
            "provider": i.provider,
            "kind": i.kind,
            "organization_id": i.offset.organization_id,
            "offset_key": key,
            "stored_key": (
                f"{key}:{i.offset.suffix}" if i.offset.store == "keyed_table" else key
            ),
            "start_from": i.offset.start_from,
            "override": i.offset.override_start_from,
            "step_ms": STEP_MS[i.kind],
            "store": i.offset.store,
        }
        for pos, (i, key) in enumerate(zip(spec.inputs, keys, strict=True))
    ]
    schema = (
        "pos bigint, stream_key string, provider string, kind string, organization_id string, "
        "offset_key string, stored_key string, start_from bigint, override boolean, "
        "step_ms bigint, store string"
    )
    return config_table(spark, rows, schema)


def next_ranges(
    spark: SparkSession,
    spec: FlowSpec,
    now_ms: int,
    offsets: OffsetTable | OffsetStore | None = None,
    delivered: DataFrame | None = None,
    overlap_ms: int = 0,
    override: bool = True,
) -> DataFrame:
    """Ranges every input has to fetch next, from the store its offset names. Inputs that
    share a stream key are told apart by ``offset_key``, returned as ``stream_key``.
    ``override=False`` resumes inputs that override their offset like any other: a loop passes
    it after its first round. Offsets of a ``keyed_table`` are stored under ``key:suffix``, in a
    table opened without a suffix."""
    inputs = input_table(spark, spec)
    if not override:
        inputs = inputs.withColumn("override", F.lit(False))
    parts = []
    if any(i.offset.store != "delivered" for i in spec.inputs):
        if offsets is None:
            raise ValueError("an input resumes from the offset table, but none is given")
        keyed = inputs.where(F.col("store") != "delivered").withColumn(
            "stream_key", F.col("stored_key")
        )
        parts.append(resolve_offsets(keyed, offsets.current()).join(keyed, "stream_key"))
    if any(i.offset.store == "delivered" for i in spec.inputs):
        if delivered is None:
            raise ValueError("an input resumes from delivered events, but none are given")
        derived = inputs.where(F.col("store") == "delivered")
        # each input by its own start, organisation and override, also among those of one stream
        keyed = derived.withColumn("stream_key", F.col("offset_key"))
        parts.append(offsets_from_delivered(derived, delivered).join(keyed, "stream_key"))
    rows = merge_streams(
        *[p.select(F.col("offset_key").alias("stream_key"), "offset_ms", "step_ms") for p in parts]
    )
    return plan_ranges(rows, now_ms, F.col("step_ms"), overlap_ms=overlap_ms)


def fetch_ranges(
    spark: SparkSession, spec: FlowSpec, ranges: DataFrame, fetch: PageFetcher
) -> DataFrame:
    """The pages of ranges that ``next_ranges`` planned, each naming the input it is for."""
    inputs = input_table(spark, spec).select("stream_key", "provider", "kind", "offset_key")
    named = ranges.withColumnRenamed("stream_key", "offset_key").join(inputs, "offset_key")
    return pull_ranges(named.withColumnRenamed("offset_key", "input_key"), fetch)


def commit_ranges(
    spark: SparkSession, spec: FlowSpec, ranges: DataFrame, offsets: OffsetTable | OffsetStore
) -> None:
    """Store how far each input has come once its ranges are delivered, by the key of its store.
    Inputs that resume from delivered events store nothing."""
    kept = (
        input_table(spark, spec)
        .where(F.col("store") != "delivered")
        .select(F.col("offset_key").alias("stream_key"), "stored_key")
    )
    done = commit_offsets(ranges).join(kept, "stream_key")
    offsets.commit(done.withColumn("stream_key", F.col("stored_key")))


__all__ = [
    "Flow", "build_flow", "commit_offsets", "commit_ranges", "duplicate_streams", "fetch_ranges",
    "input_events", "input_table", "next_ranges", "query_plan",
]
