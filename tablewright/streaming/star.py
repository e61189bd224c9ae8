"""Star schema loaded file by file: catalogue files first, then log files, each once.

Songs, artists and users are partial states per batch, plays and times are appended. A log batch looks its plays up in the songs and
artists that are loaded by then. It reads the states of its own keys only: the titles it plays, the songs that
ever had one of these titles, and their artists. A play keeps what it found; songs that come later do not change it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright import schemas
from tablewright.operators.dimensions import merge_states, state_rows, upsert_state
from tablewright.plans import star
from tablewright.storage import exists
from tablewright.streaming.incremental import AppendFact, UpsertDimension, compact_dimension, incremental_load, read_dimension, read_fact

SONG_FIRST = [c for c in schemas.STAR_COLUMNS["songs"] if c != "song_id"]
# the folders that the two streams load into
CATALOGUE, LOG = "catalogue", "log"


class IncrementalStar:
    """The tables of a file-by-file profile below ``out``. ``event_order`` and ``catalogue_order`` say which row counts as first and last."""

    def __init__(
        self,
        out: str,
        profile: star.StarProfile | str = "rowwise",
        event_order: Sequence[str] = star.EVENT_ORDER,
        catalogue_order: Sequence[str] = star.CATALOGUE_ORDER,
    ) -> None:
        self.profile = profile = star.PROFILES[profile] if isinstance(profile, str) else profile
        rules = (profile.match, profile.users, profile.songs, profile.artists, profile.key, profile.time_from, profile.time_distinct)
        if rules != ("lookup", "upsert", "first", "upsert", "serial", "events", False):
            raise ValueError(f"profile {profile.name} needs rows of other batches again; load it with build_star")
        self.out = out.rstrip("/")
        self.songs = UpsertDimension(
            "songs", ["song_id"], star.order_names(catalogue_order), SONG_FIRST, [], lambda rows: star.song_rows(rows, profile, catalogue_order)
        )
        self.artists = UpsertDimension(
            "artists", ["artist_id"], star.order_names(catalogue_order), ["name"], star.ARTIST_LAST, lambda rows: star.artist_rows(rows, profile, catalogue_order)
        )
        self.users = UpsertDimension(
            "users", ["user_id"], star.order_names(event_order), star.USER_FIRST, ["level"], lambda rows: star.user_rows(rows, profile, event_order)
        )
        self.plays = AppendFact("songplays", self._play_rows, number="songplay_id", number_order=star.FACT_ORDER)
        self.times = AppendFact("time", lambda rows: star.star_tables(rows, _no_rows(rows.sparkSession), profile, only=["time"])["time"])

    def load(self, spark: SparkSession, songs_dir: str, logs_dir: str, max_files: int = 1000) -> dict[str, list[int]]:
        """Load the files that earlier runs have not, at any depth of the two folders; returns the ids of the batches of each stream."""
        options = {"recursiveFileLookup": "true", "pathGlobFilter": "*.{json,json.gz}"}
        load = partial(incremental_load, spark, max_files=max_files, **options)
        return {
            CATALOGUE: load(songs_dir, schemas.CATALOGUE, f"{self.out}/{CATALOGUE}", dimensions=[self.songs, self.artists]),
            LOG: load(logs_dir, schemas.EVENT_LOG, f"{self.out}/{LOG}", [self.plays, self.times], [self.users]),
        }

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        """A table as of the last batch."""
        if table in ("songplays", "time"):
            return read_fact(spark, f"{self.out}/{LOG}", table).select(*schemas.STAR_COLUMNS[table])
        folder = LOG if table == "users" else CATALOGUE
        return read_dimension(spark, f"{self.out}/{folder}", getattr(self, table)).select(*schemas.STAR_COLUMNS[table])

    def compact(self, spark: SparkSession) -> None:
        """Merge the states of all batches; run it between loads."""
        for folder, dimensions in ((CATALOGUE, (self.songs, self.artists)), (LOG, (self.users,))):
            for dimension in dimensions:
                if exists(spark, f"{self.out}/{folder}/{dimension.name}"):
                    compact_dimension(spark, f"{self.out}/{folder}", dimension)

    def _states(self, spark: SparkSession, dimension: UpsertDimension) -> DataFrame:
        path = f"{self.out}/{CATALOGUE}/{dimension.name}"
        if exists(spark, path):
            return spark.read.parquet(path).drop("batch")
        rows = dimension.prepare(_no_rows(spark))
        return upsert_state(rows, dimension.key, dimension.order, dimension.keep_first, dimension.take_last)

    def _rows(self, dimension: UpsertDimension, states: DataFrame, ids: DataFrame) -> DataFrame:
        """The rows of some keys only; each state is one row per key and batch."""
        own = states.join(ids, dimension.key, "left_semi")
        return state_rows(merge_states(own, dimension.key), dimension.key, dimension.keep_first, dimension.take_last)

    def _play_rows(self, staged: DataFrame) -> DataFrame:
        spark = staged.sparkSession
        keys = star.play_keys(staged, self.profile).dropna(subset=["song"]).select("song").distinct()
        states = self._states(spark, self.songs)
        title = F.col(f"_first.v{SONG_FIRST.index('title')}")
        # a song is found by its first title only, but whether that is the first takes all its states
        ids = states.select("song_id", title.alias("song")).join(keys, "song", "left_semi").select("song_id").distinct()
        songs = self._rows(self.songs, states, ids)
        artists = self._rows(self.artists, self._states(spark, self.artists), songs.select("artist_id").distinct())
        return star.play_rows(staged, songs, artists, self.profile)


def _no_rows(spark: SparkSession) -> DataFrame:
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.CATALOGUE.fields])
