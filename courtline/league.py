"""All league models for one set of raw tables, built lazily in dependency order.

``League(raw)`` holds the staging views and exposes every model as a cached
property; Catalyst sees each requested model as one plan.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property, partial

from pyspark.sql import DataFrame, SparkSession

from courtline.plans import analytics, core, marts, ratings
from courtline.plans.staging import staging
from courtline.sources import league as fixture
from courtline.sources.tables import LazyTables


class League:
    def __init__(self, raw: Mapping[str, DataFrame], asof_method: str = "fill", store=None):
        """``store(name, build) -> df`` materialises reused models (None: keep them as plans)."""
        self.raw = raw
        self.stg = staging(raw)
        self.asof_method = asof_method
        self.store = store

    def _stored(self, name: str, build) -> DataFrame:
        """The model from the store (built and written on first use), or its plan."""
        return self.store(name, build) if self.store is not None else build()

    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str, asof_method: str = "fill",
                      tables: "fixture.TableStore | None" = None) -> "League":
        """Models over the raw layer derived from the driver's tables.

        ``tables`` is the caller's store: raw tables and reused models are written
        there when first asked for, and used again by every League with the same
        store and unchanged input files.  Without one, a new store is made.
        """
        from courtline.session import configure
        configure(spark)
        tables = tables if tables is not None else fixture.TableStore()
        version = fixture.input_version(spark, sf_dir)
        plans = fixture.raw_tables(spark, sf_dir)
        raw = LazyTables({n: partial(tables, spark, (version, "raw", n), lambda df=df: df)
                          for n, df in plans.items()})
        return cls(raw, asof_method, lambda name, build: tables(spark, (version, asof_method, name), build))

    # core
    @cached_property
    def dim_tournaments(self) -> DataFrame:
        return core.dim_tournaments(self.stg["tournaments"])

    @cached_property
    def dim_team_tournaments(self) -> DataFrame:
        return self._stored("dim_team_tournaments", lambda: core.dim_team_tournaments(
            self.stg["teams"], self.stg["players"], self.dim_tournaments))

    @cached_property
    def fct_team_rankings(self) -> DataFrame:
        return core.fct_team_rankings(self.stg["team_rankings"], self.stg["players"])

    @cached_property
    def match_spine(self) -> DataFrame:
        """Matches with tournament, round and both teams; three steps of the fact read it."""
        return self._stored("match_spine", lambda: core.match_base(
            self.stg["matches"], self.dim_tournaments, self.stg["rounds"], self.dim_team_tournaments))

    @cached_property
    def fct_matches(self) -> DataFrame:
        return self._stored("fct_matches", lambda: core.fct_matches(
            self.match_spine, self.stg["team_rankings"], self.asof_method))

    @cached_property
    def fct_tournament_standings(self) -> DataFrame:
        return self._stored("fct_tournament_standings", lambda: core.fct_tournament_standings(
            self.stg["results"], self.dim_tournaments, self.dim_team_tournaments,
            self.stg["team_rankings"], self.asof_method))

    # marts
    @cached_property
    def match_mart(self) -> DataFrame:
        return marts.match_mart(self.fct_matches, self.dim_tournaments, self.stg["rounds"],
                                self.dim_team_tournaments, self.fct_tournament_standings)

    @cached_property
    def tournament_mart(self) -> DataFrame:
        return self._stored("tournament_mart", lambda: marts.tournament_mart(
            self.fct_matches, self.fct_tournament_standings, self.dim_tournaments))

    @cached_property
    def champion_mart(self) -> DataFrame:
        return marts.champion_mart(self.fct_tournament_standings, self.dim_tournaments,
                                   self.fct_matches, self.dim_team_tournaments,
                                   self.stg["team_rankings"], self.asof_method)

    # Elo
    @cached_property
    def elo_match_feed(self) -> DataFrame:
        return self._stored("elo_match_feed", lambda: ratings.elo_match_feed(
            self.fct_matches, self.dim_tournaments, self.dim_team_tournaments))

    @cached_property
    def elo_ratings(self) -> DataFrame:
        return self._stored("elo_ratings", lambda: ratings.elo_ratings(self.elo_match_feed))

    @cached_property
    def elo_round_weight(self) -> DataFrame:
        from pyspark.sql import functions as F
        from courtline.operators.elo import round_weight
        return self.elo_match_feed.select(
            "match_id", "tournament_gender", "round_phase", "round_name", "is_final",
            "is_pool_phase", round_weight(F.col("round_phase"), F.col("round_name"),
                                          F.col("is_final"), F.col("is_pool_phase")).alias("weight"))

    @cached_property
    def elo_expected_score(self) -> DataFrame:
        return ratings.expected_scores(self.elo_match_feed, self.elo_ratings)

    def _history(self, rw: bool) -> DataFrame:
        return ratings.elo_history(self.elo_ratings, round_weighted=rw)

    @cached_property
    def elo_history(self) -> DataFrame:
        return ratings.history_mart(self._history(False), self.stg["players"],
                                    self.stg["matches"], self.dim_tournaments)

    @cached_property
    def elo_history_round_weighted(self) -> DataFrame:
        return ratings.history_mart(self._history(True), self.stg["players"],
                                    self.stg["matches"], self.dim_tournaments)

    @cached_property
    def elo_latest(self) -> DataFrame:
        return ratings.latest_mart(self._history(False), self.stg["players"], self.stg["matches"],
                                   self.dim_tournaments, self.dim_team_tournaments)

    @cached_property
    def elo_latest_round_weighted(self) -> DataFrame:
        return ratings.latest_mart(self._history(True), self.stg["players"], self.stg["matches"],
                                   self.dim_tournaments, self.dim_team_tournaments)

    # analytics
    @cached_property
    def teams_list(self) -> DataFrame:
        return analytics.teams_list(self.dim_team_tournaments)

    @cached_property
    def players_list(self) -> DataFrame:
        return analytics.players_list(self.stg["players"])

    @cached_property
    def perf_country_team_core(self) -> DataFrame:
        return analytics.perf_country_team_core(self.fct_matches, self.dim_tournaments,
                                                self.fct_tournament_standings)

    @cached_property
    def perf_country_team(self) -> DataFrame:
        return analytics.perf_country_team(self.tournament_mart)

    @cached_property
    def perf_country_player(self) -> DataFrame:
        return analytics.perf_country_player(self.tournament_mart, self.dim_team_tournaments)

    @cached_property
    def perf_country_player_core(self) -> DataFrame:
        return analytics.perf_country_player_core(self.fct_matches, self.dim_tournaments,
                                                  self.dim_team_tournaments,
                                                  self.fct_tournament_standings)

    @cached_property
    def perf_over_time(self) -> DataFrame:
        return analytics.perf_over_time(self.tournament_mart, majors_only=True, gender="W",
                                        time_axis="season_year")

    @cached_property
    def perf_over_time_all(self) -> DataFrame:
        return analytics.perf_over_time(self.tournament_mart)

    @cached_property
    def elo_history_components(self) -> DataFrame:
        """``elo_history`` rated per connected component of players (same rows)."""
        r = ratings.elo_ratings(self.elo_match_feed, pools="component")
        return ratings.history_mart(ratings.elo_history(r), self.stg["players"],
                                    self.stg["matches"], self.dim_tournaments)

    @cached_property
    def player_pools(self) -> DataFrame:
        """(node = gender:player, component) of the played-with/against graph."""
        from courtline.operators.elo import component_pools
        from pyspark.sql import functions as F
        wf = ratings.weighted_feed(self.elo_match_feed)
        pooled = component_pools(wf)
        nodes = pooled.select("gender", "pool", F.explode(F.array("a1", "a2", "b1", "b2")).alias("p"))
        return nodes.select(F.concat(F.col("gender"), F.lit(":"), F.col("p").cast("string"))
                            .alias("node"), F.col("pool").alias("comp")).distinct()
