"""Refresh of stored models after a change of raw rows.

A change of raw keys concerns certain tournaments: those of the changed rows,
as they were and as they are; those in which a changed player's teams play; and
those of teams whose player pair has a changed ranking (the as-of ranking is
looked up by pair).  Every row of the match fact, the standings and the three
marts belongs to one tournament and is computed from rows of that tournament,
the rankings and the players.  So it is enough to build the models over the raw
rows of the tournaments concerned and to replace just their rows.

The tournaments concerned are a table of ids that Spark broadcasts when it
measures small; unchanged rows are passed on, not computed again.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtline.league import League
from courtline.operators.pairs import pair_key
from courtline.sources.schemas import RAW_KEYS

#: Models that are refreshed, all keyed by tournament.
MODELS = ("fct_matches", "fct_tournament_standings", "match_mart", "tournament_mart", "champion_mart")
#: Raw tables that hold a tournament's own rows.
OWN = ("tournaments", "teams", "matches", "results", "rounds")


def _of_tournaments(raw: Mapping[str, DataFrame], changed: Mapping[str, DataFrame]) -> list[DataFrame]:
    """Tournament ids that changed raw keys concern, in one state of the raw layer."""
    out = []
    for name in OWN:
        if name in changed:
            out.append(raw[name].join(changed[name].select(*RAW_KEYS[name]).distinct(), list(RAW_KEYS[name]), "left_semi").select("tournament_id"))
    teams = raw["teams"]
    if "players" in changed:
        who = changed["players"].select(F.col("player_id").alias("_p")).distinct()
        sides = teams.select("tournament_id", F.explode(F.array("player_a_id", "player_b_id")).alias("_p"))
        out.append(sides.join(who, "_p", "left_semi").select("tournament_id"))
    def pair(a: str, b: str) -> Column:
        lo, hi = pair_key(a, b)
        return F.when(lo.isNotNull(), F.struct(lo.alias("lo"), hi.alias("hi"))).alias("_pair")

    if "team_rankings" in changed:
        rows = raw["team_rankings"].join(changed["team_rankings"].select(*RAW_KEYS["team_rankings"]).distinct(), list(RAW_KEYS["team_rankings"]), "left_semi")
        pairs = rows.select(pair("no_player1", "no_player2")).filter("_pair is not null").distinct()
        played = teams.select("tournament_id", pair("player_a_id", "player_b_id"))
        out.append(played.join(pairs, "_pair", "left_semi").select("tournament_id"))
    return out


def concerned(before: Mapping[str, DataFrame], after: Mapping[str, DataFrame], changed: Mapping[str, DataFrame]) -> DataFrame:
    """tournament_id of every tournament that the changed keys concern.

    ``changed``: by raw table, the business keys of inserted, updated and
    removed rows.  Rows are looked up in both states, so that a match that moved
    to another tournament concerns both.
    """
    parts = _of_tournaments(before, changed) + _of_tournaments(after, changed)
    for name in ("matches", "results", "teams", "rounds"):
        if name in changed and "tournament_id" in changed[name].columns:
            parts.append(changed[name].select("tournament_id"))
    if not parts:
        return after["tournaments"].select("tournament_id").limit(0)
    ids = parts[0]
    for p in parts[1:]:
        ids = ids.unionByName(p)
    return ids.filter("tournament_id is not null").distinct()


def changed_keys(before: DataFrame, after: DataFrame, table: str) -> DataFrame:
    """Business keys of the rows that differ between two states of a raw table."""
    keys, cols = list(RAW_KEYS[table]), sorted(set(before.columns) & set(after.columns))

    def marked(df: DataFrame) -> DataFrame:
        return df.select(*keys, F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in cols]).alias("_h"))
    both = marked(before).withColumn("_n", F.lit(1)).unionByName(marked(after).withColumn("_n", F.lit(-1)))
    return both.groupBy(*keys, "_h").agg(F.sum("_n").alias("_n")).filter("_n <> 0").select(*keys).distinct()


def refresh(stored: Mapping[str, DataFrame], before: Mapping[str, DataFrame], after: Mapping[str, DataFrame],
            changed: Mapping[str, DataFrame], ids: DataFrame | None = None, asof_method: str = "fill",
            store=None) -> dict[str, DataFrame]:
    """The stored models (by name, of MODELS) brought to the raw state ``after``.

    ``ids``: the tournaments concerned, if the caller has stored them.  ``store``:
    where models that the new rows are made from are kept (see League); their
    sizes are then known, so that small ones are broadcast to the matches.
    """
    ids = concerned(before, after, changed) if ids is None else ids
    part = {name: (after[name].join(ids, "tournament_id", "left_semi") if name in OWN else after[name]) for name in after}
    anew = League(part, asof_method, store)
    out = {}
    for name, old in stored.items():
        new = getattr(anew, name)
        out[name] = old.join(ids, "tournament_id", "left_anti").unionByName(new.select(*old.columns))
    return out
