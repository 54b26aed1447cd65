"""Validation: ordered rules, three-way routing, dead-letter rows and scores.

The first rule that fails decides. Structural rules run before repeat
detection, so a row they reject is not remembered as seen; bounds run after it,
so a row they reject is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curvewright.functions import payload as P
from curvewright.functions.clock import seconds_between
from curvewright.functions.pin import pin
from curvewright.functions.scores import validation_score
from curvewright.operators.dedup import flag_repeats
from curvewright.operators.ordering import running_position
from curvewright.schemas import LATENCY_BUCKETS

REQUIRED = ("event_id", "provider", "instrument", "event_timestamp", "payload")

MAX_AGE_HOURS = 24
MAX_FUTURE_MINUTES = 5
MIN_PRICE = 0.0
MAX_PRICE = 1_000_000.0

# -- rules: each yields a reason, or NULL when the row passes ----------------


def missing_fields() -> Column:
    """Names of required fields without a value, in declaration order."""
    empty = {
        "event_id": F.col("event_id").isNull() | (F.col("event_id") == ""),
        "provider": F.col("provider").isNull() | (F.col("provider") == ""),
        "instrument": F.col("instrument").isNull() | (F.col("instrument") == ""),
        "event_timestamp": F.col("event_timestamp").isNull(),
        "payload": F.col("payload").isNull() | (F.col("_doc_kind") == "OBJECT<>"),
    }
    return F.concat_ws(", ", *[F.when(empty[name], F.lit(name)) for name in REQUIRED])


def required_reason() -> Column:
    names = missing_fields()
    return F.when(names != "", F.concat(F.lit("Missing required fields: "), names))


def types_reason() -> Column:
    kind = F.col("_price_kind")
    return F.when(
        ~P.is_object(F.col("_doc_kind")),
        F.concat(
            F.lit("payload must be a dict, got "),
            F.coalesce(P.type_label(F.col("_doc_kind")), F.lit("str")),
        ),
    ).when(
        ~P.is_missing(kind) & ~P.is_number(kind),
        F.concat(F.lit("payload.price must be numeric, got "), P.type_label(kind)),
    )


def time_category(clock: Column, max_age_hours: int, max_future_minutes: int) -> Column:
    age = seconds_between(clock, F.col("event_timestamp"))
    return F.when(age > max_age_hours * 3600, "stale").when(
        age < -max_future_minutes * 60, "out_of_order"
    )


def time_reason(clock: Column, max_age_hours: int, max_future_minutes: int) -> Column:
    age = seconds_between(clock, F.col("event_timestamp"))
    return F.when(
        age > max_age_hours * 3600,
        F.format_string(
            f"event_timestamp is %.1fh old, exceeds max age of {max_age_hours}h", age / 3600
        ),
    ).when(
        age < -max_future_minutes * 60,
        F.format_string(
            "event_timestamp is %.1fmin in the future, "
            f"exceeds max of {max_future_minutes}min",
            -age / 60,
        ),
    )


def price_reason(min_price: float, max_price: float) -> Column:
    price = F.try_variant_get(F.col("_price"), "$", "double")
    # Quoted as written; looked up again only for the rows that fail.
    quoted = F.get_json_object("payload", "$.price")
    return F.when(
        price <= min_price,
        F.concat(F.lit("payload.price "), quoted, F.lit(f" must be > {min_price}")),
    ).when(
        price >= max_price,
        F.concat(F.lit("payload.price "), quoted, F.lit(f" must be < {max_price}")),
    )


# -- operators ---------------------------------------------------------------


def apply_rules(
    events: DataFrame,
    max_age_hours: int = MAX_AGE_HOURS,
    max_future_minutes: int = MAX_FUTURE_MINUTES,
    min_price: float = MIN_PRICE,
    max_price: float = MAX_PRICE,
    clock: Column | None = None,
) -> DataFrame:
    """Every rule that looks at one row only.

    Adds ``structure_category``/``structure_reason`` (rules 1 and 2) and
    ``bounds_category``/``bounds_reason`` (rules 4 and 5). They are computed
    before repeats are looked up, so the payload is parsed once and nothing
    parsed is shuffled.
    """
    now = F.col("received_at") if clock is None else clock
    parsed = pin(
        events.withColumn("_doc", P.as_variant(F.col("payload"))),
        {
            "_doc_kind": P.json_type(F.col("_doc")),
            "_price": P.field(F.col("_doc"), "price"),
        },
    )
    typed = pin(
        parsed,
        {
            "_price_kind": P.json_type(F.col("_price")),
            "_price_reason": price_reason(min_price, max_price),
            "_missing": required_reason(),
            "_time": time_category(now, max_age_hours, max_future_minutes),
        },
    )
    ruled = pin(
        typed,
        {
            "structure_reason": F.coalesce("_missing", types_reason()),
            "bounds_category": F.coalesce(
                "_time", F.when(F.col("_price_reason").isNotNull(), "malformed")
            ),
            "bounds_reason": F.coalesce(
                time_reason(now, max_age_hours, max_future_minutes), "_price_reason"
            ),
        },
    )
    return ruled.select(
        *events.columns,
        F.when(F.col("_missing").isNotNull(), "missing_required_field")
        .when(F.col("structure_reason").isNotNull(), "schema_violation")
        .alias("structure_category"),
        "structure_reason",
        "bounds_category",
        "bounds_reason",
    )


def resolve(flagged: DataFrame) -> DataFrame:
    """Pick the deciding rule of each row once repeats are known."""
    broken = F.col("structure_category").isNotNull()
    repeat = F.col("is_repeat")
    bounded = F.col("bounds_category").isNotNull()
    nothing = F.lit(None).cast("string")
    return (
        flagged.withColumn(
            "outcome",
            F.when(broken, "failed")
            .when(repeat, "duplicate")
            .when(bounded, "failed")
            .otherwise("passed"),
        )
        .withColumn(
            "category",
            F.when(broken, F.col("structure_category"))
            .when(repeat, nothing)
            .otherwise(F.col("bounds_category")),
        )
        .withColumn(
            "reason",
            F.when(broken, F.col("structure_reason"))
            .when(repeat, nothing)
            .otherwise(F.col("bounds_reason")),
        )
        .drop(
            "structure_category", "structure_reason", "bounds_category", "bounds_reason", "is_repeat"
        )
    )


def validate(events: DataFrame, ttl_seconds: int = 3600, **bounds) -> DataFrame:
    """Every input row once, with ``outcome``, ``category`` and ``reason``.

    ``outcome`` is ``passed``, ``failed`` or ``duplicate``; ``bounds`` are the
    keyword arguments of :func:`apply_rules`.
    """
    ruled = apply_rules(events, **bounds)
    sound = F.col("structure_category").isNull()
    return resolve(flag_repeats(ruled, sound, ttl_seconds))


def validated_events(outcomes: DataFrame) -> DataFrame:
    """Passed rows as validated events with a new, reproducible id."""
    return outcomes.where(F.col("outcome") == "passed").select(
        F.md5(
            F.concat_ws("|", F.lit("validated"), "event_id", F.col("arrival_seq").cast("string"))
        ).alias("event_id"),
        F.col("event_id").alias("original_event_id"),
        "provider",
        "instrument",
        "received_at",
        "event_timestamp",
        F.col("received_at").alias("validated_at"),
        F.lit(False).alias("corrected_timestamp"),
        "payload",
        "injected_faults",
        "is_replay",
        "replay_source",
        "trace_id",
        "arrival_seq",
    )


RAW_FIELDS = (
    "event_id",
    "provider",
    "instrument",
    "received_at",
    "event_timestamp",
    "payload",
    "injected_faults",
    "is_replay",
    "replay_source",
    "trace_id",
)


def raw_document() -> Column:
    """The raw event as one JSON text, kept verbatim in dead-letter rows."""
    return F.to_json(F.struct(*RAW_FIELDS), P.JSON_TEXT)


def dead_letters(outcomes: DataFrame) -> DataFrame:
    """Failed rows as dead-letter events."""
    return outcomes.where(F.col("outcome") == "failed").select(
        F.md5(
            F.concat_ws("|", F.lit("dlq"), "event_id", F.col("arrival_seq").cast("string"))
        ).alias("dlq_event_id"),
        F.col("event_id").alias("original_event_id"),
        "provider",
        "instrument",
        F.col("reason").alias("failure_reason"),
        F.coalesce("category", F.lit("unknown")).alias("failure_category"),
        raw_document().alias("raw_payload"),
        F.col("received_at").alias("original_received_at"),
        F.col("received_at").alias("dlq_timestamp"),
        F.lit(0).alias("retry_count"),
        "trace_id",
        "arrival_seq",
    )


def undecodable_letters(broken: DataFrame) -> DataFrame:
    """Messages that never became an event; the text is kept as it came."""
    return _letters_without_event(broken, "schema_violation", "Deserialisation failed")


def unexpected_letters(broken: DataFrame) -> DataFrame:
    """Messages that failed for any other reason."""
    return _letters_without_event(broken, "unknown", "Unexpected processing error")


def _letters_without_event(broken: DataFrame, category: str, reason: str) -> DataFrame:
    unknown = F.lit("unknown")
    return broken.select(
        F.md5(F.concat_ws("|", F.lit("dlq"), "value", F.col("arrival_seq").cast("string"))).alias(
            "dlq_event_id"
        ),
        unknown.alias("original_event_id"),
        unknown.alias("provider"),
        F.lit(None).cast("string").alias("instrument"),
        F.concat(F.lit(f"{reason}: "), F.coalesce("error", F.lit("malformed message"))).alias(
            "failure_reason"
        ),
        F.lit(category).alias("failure_category"),
        F.to_json(F.struct(F.col("value").alias("raw_bytes"))).alias("raw_payload"),
        F.col("received_at").alias("original_received_at"),
        F.col("received_at").alias("dlq_timestamp"),
        F.lit(0).alias("retry_count"),
        unknown.alias("trace_id"),
        "arrival_seq",
    )


def outcome_counts(outcomes: DataFrame) -> DataFrame:
    """Rows per provider, outcome and category."""
    return outcomes.groupBy(
        "provider", "outcome", F.coalesce("category", F.lit("none")).alias("category")
    ).agg(F.count(F.lit(1)).alias("events"))


def scored_events(outcomes: DataFrame) -> DataFrame:
    """Passed rows with their validation score."""
    return outcomes.where(F.col("outcome") == "passed").withColumn(
        "quality_score", validation_score(F.col("injected_faults"))
    )


def rolling_scores(
    scored: DataFrame, window: int = 100, block: int = 1024, start: DataFrame | None = None
) -> DataFrame:
    """Decaying provider average after every event, in arrival order.

    Sum and count grow by one event at a time; whenever the count reaches
    ``window`` both are halved. Halvings fall at fixed positions, so events are
    numbered per provider and cut into segments between halvings: the carried
    sum of a segment is a weighted sum of earlier segment totals whose weights
    halve each time. Weights past 64 halvings lie below the last bit of a
    double, so each block of segments needs only the 64 before it and no
    provider is ever gathered.

    ``start`` optionally carries what :func:`rolling_carry` returned for the
    events before these.
    """
    lengths, openings = halving_schedule(window)
    starts = [sum(lengths[:i]) for i in range(len(lengths))]
    cycle = sum(lengths)
    placed = running_position(
        scored,
        ["provider"],
        "position",
        start=None if start is None else start.select("provider", "position"),
    )
    # Segment 0 holds the first ``window`` events; the cycle of lengths follows.
    beyond = F.col("position") - window - 1
    in_cycle = F.pmod(beyond, F.lit(cycle))
    turn = F.size(F.filter(F.array(*[F.lit(s) for s in starts]), lambda s: s <= in_cycle))
    placed = (
        placed.withColumn("_turn", F.when(beyond < 0, 0).otherwise(turn))
        .withColumn(
            "segment",
            F.when(F.col("_turn") == 0, F.lit(0).cast("bigint")).otherwise(
                F.floor(beyond / F.lit(cycle)) * len(lengths) + F.col("_turn")
            ),
        )
        .withColumn(
            "_offset",
            F.when(F.col("_turn") == 0, F.col("position")).otherwise(
                in_cycle - F.get(F.array(*[F.lit(s) for s in starts]), F.col("_turn") - 1) + 1
            ),
        )
    )

    totals = placed.groupBy("provider", "segment").agg(F.sum("quality_score").alias("total"))
    if start is not None:
        # The running segment's earlier part, and the carried sum as the
        # total of the segment before it (doubled: it is halved on the way in).
        opened = start.where(F.col("position") > 0).select(
            "provider", "open_segment", "carried_sum", "segment_sum"
        )
        seeds = opened.select(
            "provider", F.col("open_segment").alias("segment"), F.col("segment_sum").alias("total")
        ).unionByName(
            opened.where(F.col("open_segment") > 0).select(
                "provider",
                (F.col("open_segment") - 1).alias("segment"),
                (F.col("carried_sum") * 2).alias("total"),
            )
        )
        totals = totals.unionByName(seeds).groupBy("provider", "segment").agg(
            F.sum("total").alias("total")
        )
    carried = carried_sums(totals, block)

    within = Window.partitionBy("provider", "segment").orderBy("position")
    result = placed.withColumn("_partial", F.sum("quality_score").over(within)).join(
        carried, ["provider", "segment"], "left"
    )
    if start is not None:
        earlier = start.select(
            "provider",
            F.col("open_segment").alias("segment"),
            F.col("segment_sum").alias("_already"),
        )
        result = result.join(earlier, ["provider", "segment"], "left").withColumn(
            "_partial", F.col("_partial") + F.coalesce("_already", F.lit(0.0))
        )
    def of_segment(values: list, first) -> Column:
        listed = F.array(*[F.lit(v) for v in [first, *values]])
        return F.get(listed, F.col("_turn"))

    halves = F.when(F.col("_offset") == of_segment(lengths, window), 2.0).otherwise(1.0)
    return (
        result.withColumn(
            "rolling_sum",
            (F.coalesce("carried", F.lit(0.0)) + F.col("_partial")) / halves,
        )
        .withColumn("rolling_count", (of_segment(openings, 0.0) + F.col("_offset")) / halves)
        .withColumn("rolling_average", F.col("rolling_sum") / F.col("rolling_count"))
        .withColumn("carried_sum", F.coalesce("carried", F.lit(0.0)))
        .withColumnRenamed("_partial", "segment_sum")
        .drop("_offset", "_turn", "carried", "_already")
    )


def halving_schedule(window: int) -> tuple[list[int], list[float]]:
    """Lengths and opening counts of the segments after the first.

    The count depends on the number of events alone, so its course is known in
    advance: it returns to the same value after a few halvings.
    """
    lengths: list[int] = []
    openings: list[float] = []
    count = window / 2
    while not openings or count != openings[0]:
        openings.append(count)
        steps = 0
        while count < window:
            count, steps = count + 1.0, steps + 1
        lengths.append(steps)
        count /= 2
    return lengths, openings


def carried_sums(totals: DataFrame, block: int) -> DataFrame:
    """Sum carried into each segment: fold of ``(carried + total) / 2``."""
    reach = 64
    blocked = totals.withColumn("_block", F.floor(F.col("segment") / F.lit(block)))
    # The last segments of a block are also needed by the next one.
    halo = blocked.where(F.col("segment") % block >= block - reach).withColumn(
        "_block", F.col("_block") + 1
    )
    order = Window.partitionBy("provider", "_block").orderBy("segment").rowsBetween(-reach, -1)
    folded = F.aggregate(
        F.collect_list("total").over(order),
        F.lit(0.0),
        lambda carried, total: (carried + total) / 2,
    )
    both = blocked.withColumn("_own", F.lit(True)).unionByName(halo.withColumn("_own", F.lit(False)))
    return both.withColumn("carried", folded).where("_own").select("provider", "segment", "carried")


def rolling_carry(rolled: DataFrame) -> DataFrame:
    """What the next batch needs: position, open segment and its sums, per provider."""
    last = F.max(
        F.struct(
            "position",
            F.col("segment").alias("open_segment"),
            "carried_sum",
            "segment_sum",
            "rolling_average",
        )
    )
    return rolled.groupBy("provider").agg(last.alias("last")).select("provider", "last.*")


def rolling_state(rolled: DataFrame) -> DataFrame:
    """Each provider's sum, count and average after its last event."""
    last = F.max(
        F.struct("position", "rolling_sum", "rolling_count", "rolling_average")
    ).alias("last")
    return rolled.groupBy("provider").agg(last).select(
        "provider",
        F.col("last.position").alias("events"),
        F.col("last.rolling_sum").alias("rolling_sum"),
        F.col("last.rolling_count").alias("rolling_count"),
        F.col("last.rolling_average").alias("rolling_average"),
    )


def latency_histogram(outcomes: DataFrame) -> DataFrame:
    """Cumulative latency buckets per provider, with count and sum."""
    latency = F.abs(seconds_between(F.col("received_at"), F.col("event_timestamp")))
    timed = outcomes.where(F.col("outcome") == "passed").withColumn("_latency", latency)
    bounds = F.array(*[F.lit(b) for b in LATENCY_BUCKETS], F.lit(float("inf")))
    # First bucket that holds the value; buckets below it stay empty.
    smallest = F.lit(len(LATENCY_BUCKETS))
    for i in range(len(LATENCY_BUCKETS) - 1, -1, -1):
        smallest = F.when(F.col("_latency") <= LATENCY_BUCKETS[i], F.lit(i)).otherwise(smallest)
    per_bucket = timed.groupBy("provider", smallest.alias("_first")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    spread = per_bucket.select(
        "provider", "_first", "_n", F.posexplode(bounds).alias("_i", "le")
    )
    return spread.groupBy("provider", "le").agg(
        F.sum(F.when(F.col("_first") <= F.col("_i"), F.col("_n")).otherwise(0)).alias("events")
    )
