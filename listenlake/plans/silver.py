"""Silver tables and how one batch of bronze rows is applied to each.

Every function here may be handed to ``foreachBatch``: a batch that is already committed is
skipped, and one that failed half way can be run again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from listenlake import fixed
from listenlake.functions.audit import add_silver_audit
from listenlake.operators.cdc import AUDIT, END_AT, OPENS, START_AT, apply_history, apply_latest
from listenlake.operators.dedup import keep_latest
from listenlake.operators.keys import hash_sk
from listenlake.operators.quarantine import to_quarantine, write_quarantine
from listenlake.operators.rules import (
    REASON,
    VALID,
    Rule,
    apply_rules,
    count_measures,
    expect_or_drop,
    split_valid,
)
from listenlake.operators.scd import CURRENT, scd1_merge, scd2_merge
from listenlake.operators.sizes import fits_broadcast
from listenlake.plans import quality
from listenlake.sources.buckets import PER_BUCKET, Buckets
from listenlake.sources.snapshot import PART, SnapshotTable

AUDIT_DDL = """
    silver_ingest_timestamp timestamp, bronze_ingest_timestamp timestamp, input_file_path string
"""

USER_HISTORY_DDL = f"""
    user_id bigint, user_name string, country string, subscription_type string, updated_at timestamp,
    start_at timestamp, end_at timestamp, opens_version boolean, {AUDIT_DDL}
"""

USER_DDL = f"""
    user_sk bigint, user_id bigint, user_name string, country string, subscription_type string,
    scd_start_date date, scd_end_date date, is_current boolean, updated_at timestamp,
    dq_is_valid boolean, {AUDIT_DDL}
"""

FACT_DDL = f"""
    stream_id bigint, user_id bigint, track_id bigint, date_key int, listen_duration int,
    device_type string, stream_timestamp timestamp, dq_is_valid boolean, {AUDIT_DDL}
"""

ARTIST_DDL = f"""
    artist_id bigint, artist_name string, genre string, country string, updated_at timestamp,
    artist_sk int, dq_is_valid boolean, dq_fail_reason string, {AUDIT_DDL}
"""

TRACK_DDL = f"""
    track_id bigint, track_name string, album_name string, artist_id bigint, duration_sec int,
    updated_at timestamp, track_sk bigint, {AUDIT_DDL}
"""

DATE_DDL = "date_key int, date date, day int, month int, year int, weekday string"

# part names of the user table: current rows lie in buckets of their key, history only grows
USER_CURRENT, USER_HISTORY = "current-", "history"
# batches of up to so many keys ask the filters of the fact's parts where their keys lie
FEW_KEYS = 20_000
# rows of a batch that one task sorts at most, if the batch's files don't deal them so already
TASK_ROWS = 500_000


@contextmanager
def persisted(df: DataFrame):
    """The frame computed once, for the joins of one merge."""
    df = df.persist()
    try:
        yield df
    finally:
        df.unpersist()


def _valid_rows(
    batch: DataFrame, batch_id: int, name: str, key: str, rules: Sequence[Rule], quarantine: str
) -> tuple[DataFrame, dict[str, int]]:
    """Log the invalid rows; return the valid ones and the row counts.

    The counts are taken while the log is written. The batch is not cached: reading its files a
    second time is cheaper than keeping a raw copy of them. A file of repetitive rows holds millions of them in
    one block, which one task reads and then sorts: where a task has over ``TASK_ROWS``, the valid rows are
    spread evenly first.
    """
    checked = apply_rules(batch, rules)
    counted = Observation()
    # the lower 33 bits of the id are the row's place in its task
    placed = checked.withColumn("_place", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    counting = placed.observe(counted, *count_measures(), F.max("_place").alias("_last")).drop("_place")
    write_quarantine(to_quarantine(split_valid(counting)[1], name, key), quarantine, batch_id)
    counts = dict(counted.get)
    valid, last = split_valid(checked)[0].drop(REASON), counts.pop("_last")
    if last is not None and last >= TASK_ROWS:
        # by place, as a key may be hot: the rows of one key stay spread until each task has reduced its own
        valid = valid.repartition(max(1, -(-counts["valid_rows"] // TASK_ROWS)), F.monotonically_increasing_id())
    return valid, counts


def apply_user_batch(
    batch: DataFrame,
    batch_id: int,
    users: SnapshotTable,
    quarantine: str,
    rules: Sequence[Rule] = quality.user_rules(),
    guard: str | None = None,
    tiebreak: Sequence[str] = (),
    gap_free: bool = True,
    stream: str | None = None,
    per_bucket: int = PER_BUCKET,
) -> dict[str, int] | None:
    """Check, keep the newest event per user, and merge as type 2.

    Current rows are stored in buckets of their key, of which a batch reads and rewrites those of its users.

    ``tiebreak`` names batch columns that settle which of two events of one time is the newer;
    after them the content decides.
    """
    head = users.head()
    if users.applied(head, batch_id, stream):
        return None
    all_rules = (*rules, quality.USER_START_RULE)
    valid, counts = _valid_rows(batch, batch_id, "DimUser", "user_id", all_rules, quarantine)
    if counts["valid_rows"]:
        starts = F.coalesce("start_date", F.to_date("updated_at"))
        newest = keep_latest(
            add_silver_audit(valid.withColumn("start_date", starts)),
            ["user_id"],
            ["updated_at"],
            [*tiebreak, "start_date", *fixed.USER_TRACKED_COLS],
        )
        with persisted(newest) as source:
            numbered = head.facts.get("max_sk", 0)
            buckets = Buckets.touched(
                users, head, source, ["user_id"], USER_CURRENT, per_bucket, others=[USER_HISTORY]
            )
            change = scd2_merge(
                buckets.read(),
                source,
                ["user_id"],
                fixed.USER_TRACKED_COLS,
                start="start_date",
                sk="user_sk",
                sk_start=numbered,
                guard=guard,
                gap_free=gap_free,
                small=fits_broadcast(source),
            )
            part = F.when(F.col(CURRENT), buckets.part()).otherwise(USER_HISTORY)

            def facts(written: DataFrame) -> dict[str, int]:
                highest = written.agg(F.max("user_sk")).first()[0]
                return {"max_sk": max(numbered, highest or 0), **buckets.facts(written)}

            users.publish(
                change.rows.withColumn(PART, part), batch_id, replaces=buckets.names, facts=facts, head=head, stream=stream
            )
    return counts


# buckets of histories that were stored before their number could grow
FIXED_BUCKETS = 64


def apply_user_history_batch(
    batch: DataFrame,
    batch_id: int,
    table: SnapshotTable,
    quarantine: str,
    rules: Sequence[Rule] = quality.user_rules(),
    stream: str | None = None,
    per_bucket: int = PER_BUCKET,
) -> None:
    """Apply valid user events as a sequenced type 2 history, whatever order they come in.

    The result does not depend on how events are cut into batches. Users are stored in buckets of
    their id, so a batch reads and rewrites only the buckets of its users. Events that have no time only are logged as rows of ``DimUserHistory``;
    those that break the other rules are logged as rows of ``DimUser``.
    """
    head = table.head()
    if table.applied(head, batch_id, stream):
        return
    known_good = split_valid(apply_rules(batch, rules))[0].drop(VALID, REASON)
    valid, _ = _valid_rows(known_good, batch_id, "DimUserHistory", "user_id", (quality.USER_SEQUENCE_RULE,), quarantine)
    names = [f.name for f in table.schema if f.name not in (START_AT, END_AT, OPENS)]
    events = add_silver_audit(valid).select(*names)
    with persisted(events) as source:
        if source.isEmpty():
            return
        buckets = Buckets.touched(table, head, source, ["user_id"], "", per_bucket, before=FIXED_BUCKETS)
        history = apply_history(
            buckets.read() if buckets.names else None, source, ["user_id"], "updated_at", fixed.USER_TRACKED_COLS,
            settled=True, except_cols=(*AUDIT, "updated_at"),
        )
        table.publish(
            history.withColumn(PART, buckets.part()), batch_id, replaces=buckets.names, facts=buckets.facts, head=head,
            stream=stream,
        )


# digits of a date key that name the part its fact is stored in
GRAINS = {"day": 8, "month": 6, "year": 4}


PART_YEARS = (1900, 2199)


def fact_part(grain: str) -> Column:
    """A batch rewrites the parts it touches. Months suit small facts, where days would make
    thousands of tiny folders; take days once a day holds gigabytes. Keys that are no day of the
    years below lie in one part, so the number of parts has a bound."""
    key = F.col("date_key").cast("string")
    day = F.try_to_date(key, "yyyyMMdd")
    real = F.year(day).between(*PART_YEARS) & (F.length(key) == 8)
    return F.when(real, F.substring(key, 1, GRAINS[grain])).otherwise("none")


def apply_fact_batch(
    batch: DataFrame,
    batch_id: int,
    facts: SnapshotTable,
    quarantine: str,
    rules: Sequence[Rule] = quality.FACT_RULES,
    guard: str | None = None,
    tiebreak: Sequence[str] = (),
    grain: str = "month",
    sequenced: bool = False,
    stream: str | None = None,
) -> dict[str, int] | None:
    """Check, keep the newest event per stream, and upsert as type 1.

    A changed date moves a row to another part, so the parts rewritten are those of the batch and
    those in which the batch's keys lie now. Where those are is read from key and date: of all parts that the batch
    doesn't rewrite anyway for a large one, of those whose filter may hold a key of a small one.
    ``grain`` must stay the same for the life of the table.

    A later batch overwrites the columns that may change, unless ``guard`` refuses older events.
    ``sequenced`` takes whole rows instead, each from the newest event of its stream, so that the
    result does not depend on how events are cut into batches.
    """
    head = facts.head()
    if facts.applied(head, batch_id, stream):
        return None
    valid, counts = _valid_rows(batch, batch_id, "FactStream", "stream_id", rules, quarantine)
    if counts["valid_rows"]:
        newest = keep_latest(
            add_silver_audit(valid),
            ["stream_id"],
            ["stream_timestamp"],
            [*tiebreak, "user_id", "track_id", *fixed.FACT_UPDATE_COLS],
        )
        with persisted(newest) as source:
            small = fits_broadcast(source)
            wanted = source.select("stream_id")
            wanted = F.broadcast(wanted) if small else wanted
            part = fact_part(grain)
            touched = [row[PART] for row in source.select(part.alias(PART)).distinct().collect()]
            # the filters leave out most parts, and what they let through is looked up
            ask = small and facts.key and source.count() <= FEW_KEYS
            others = set(facts.parts_of(wanted, head) if ask else head.parts) - (set() if ask else set(touched))
            if others:
                lying = facts.read(others, head).join(wanted, "stream_id", "left_semi")
                moved = [row[PART] for row in lying.select(part.alias(PART)).distinct().collect()]
                touched = sorted({*touched, *moved})
            merged = scd1_merge(
                facts.read(touched, head),
                source,
                ["stream_id"],
                list(source.columns) if sequenced else fixed.FACT_UPDATE_COLS,
                "stream_timestamp" if sequenced else guard,
                small,
                ("user_id", "track_id", *fixed.FACT_UPDATE_COLS) if sequenced else (),
            )
            facts.publish(
                merged.withColumn(PART, part),
                batch_id,
                replaces=touched,
                head=head,
                rebalance=True,
                stream=stream,
            )
    return counts


def stage_artists(bronze: DataFrame) -> DataFrame:
    """Drop implausible names; flag, but keep, rows with missing values."""
    plausible = expect_or_drop(bronze, *quality.ARTIST_EXPECTATION)
    return apply_rules(
        add_silver_audit(plausible.withColumn("artist_sk", hash_sk("artist_id"))),
        quality.ARTIST_RULES,
    )


def stage_tracks(bronze: DataFrame) -> DataFrame:
    return add_silver_audit(bronze.withColumn("track_sk", F.col("track_id")))


def stage_dates(bronze: DataFrame) -> DataFrame:
    return bronze


def apply_dimension_batch(
    batch: DataFrame,
    batch_id: int,
    table: SnapshotTable,
    stage: Callable[[DataFrame], DataFrame],
    key: str,
    sequence_by: str,
    stream: str | None = None,
    per_bucket: int = PER_BUCKET,
) -> None:
    """Sequenced type 1 application of one staged batch. Rows are stored in buckets of their key, of which a batch
    rewrites those of its keys."""
    head = table.head()
    if table.applied(head, batch_id, stream):
        return
    names = [f.name for f in table.schema]
    staged = stage(batch).select(*names)
    stamps = ("silver_ingest_timestamp", "bronze_ingest_timestamp", "input_file_path")
    content = [c for c in names if c not in (key, sequence_by, *stamps)]
    with persisted(keep_latest(staged, [key], [sequence_by], content)) as newest:
        buckets = Buckets.touched(table, head, newest, [key], "", per_bucket)
        target = buckets.read() if buckets.names else None
        small = target is not None and fits_broadcast(newest)
        merged = apply_latest(target, newest, [key], sequence_by, content, small)
        table.publish(
            merged.withColumn(PART, buckets.part()), batch_id, replaces=buckets.names, facts=buckets.facts, head=head,
            stream=stream,
        )
