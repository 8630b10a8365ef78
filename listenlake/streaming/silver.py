"""Bronze tables to silver tables, one committed version per micro-batch."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from listenlake import fixed
from listenlake.plans import quality, silver
from listenlake.sources.landing import read_bronze_stream
from listenlake.sources.snapshot import SnapshotTable
from listenlake.sources.state import StateLog, stream_id
from listenlake.streaming.layout import Layout


def run_batches(
    stream: DataFrame, apply: Callable[..., object], checkpoint: str
) -> None:
    """Hand each micro-batch to ``apply`` until the source is used up."""
    name = stream_id(stream.sparkSession, checkpoint)
    (
        stream.writeStream.foreachBatch(lambda batch, batch_id: (apply(batch, batch_id, stream=name), None)[1])
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


# tables that are fed by the bronze table of another name
SOURCES = {"DimUserHistory": "DimUser"}


class SilverLayer:
    """The silver tables of a layout and the streams that feed them."""

    def __init__(
        self,
        spark: SparkSession,
        layout: Layout,
        plans: Sequence[str] = fixed.PLANS,
        max_files: int = fixed.MAX_FILES,
        fact_grain: str = "month",
        sequenced: bool = True,
    ):
        """``sequenced`` makes the tables independent of how files are cut into micro-batches: facts hold
        the newest event of each stream, and older user events don't become current. The user history is
        sequenced in any case. Without it a later batch overwrites an earlier one, as a plain merge does."""
        self.spark = spark
        self.layout = layout
        self.max_files = max_files
        self.users = self._table("DimUser", silver.USER_DDL)
        self.user_history = self._table("DimUserHistory", silver.USER_HISTORY_DDL)
        self.facts = self._table("FactStream", silver.FACT_DDL, "stream_id")
        self.artists = self._table("DimArtist", silver.ARTIST_DDL)
        self.tracks = self._table("DimTrack", silver.TRACK_DDL)
        self.dates = self._table("DimDate", silver.DATE_DDL)
        log = layout.quarantine()
        self._apply = {
            "DimUser": partial(
                silver.apply_user_batch,
                users=self.users,
                quarantine=log,
                rules=quality.user_rules(plans),
                guard="updated_at" if sequenced else None,
            ),
            "DimUserHistory": partial(
                silver.apply_user_history_batch, table=self.user_history, quarantine=log, rules=quality.user_rules(plans)
            ),
            "FactStream": partial(
                silver.apply_fact_batch, facts=self.facts, quarantine=log, grain=fact_grain, sequenced=sequenced
            ),
            "DimArtist": partial(
                silver.apply_dimension_batch,
                table=self.artists,
                stage=silver.stage_artists,
                key="artist_id",
                sequence_by="updated_at",
            ),
            "DimTrack": partial(
                silver.apply_dimension_batch,
                table=self.tracks,
                stage=silver.stage_tracks,
                key="track_id",
                sequence_by="updated_at",
            ),
            "DimDate": partial(
                silver.apply_dimension_batch,
                table=self.dates,
                stage=silver.stage_dates,
                key="date_key",
                sequence_by="date",
            ),
        }

    def _table(self, name: str, ddl: str, key: str | None = None) -> SnapshotTable:
        return SnapshotTable(self.spark, self.layout.silver(name), ddl, key)

    def tables(self) -> list[SnapshotTable]:
        return [self.users, self.user_history, self.facts, self.artists, self.tracks, self.dates]

    def vacuum(self, keep: int = 2) -> None:
        """Delete the data of all but the newest ``keep`` versions of every table."""
        for table in self.tables():
            table.vacuum(keep)

    def run(self, names: Sequence[str] | None = None) -> None:
        """Users come before facts, as listed above."""
        for name in names or self._apply:
            source = SOURCES.get(name, name)
            store = StateLog(self.spark, self.layout.schema(source))
            stream = read_bronze_stream(
                self.spark, self.layout.bronze(source), store, self.max_files
            )
            run_batches(stream, self._apply[name], self.layout.checkpoint("silver", name))
