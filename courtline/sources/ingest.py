"""Ingest: API response bodies -> records -> typed raw rows.

Input is a table of recorded responses ``(request_type, content_type, body)``
(one row per response; any extra columns are carried along, e.g. the
tournament a per-tournament request was made for).  Parsing and
normalisation are column expressions, so a table of a billion bodies is
processed in parallel with no Python on the rows.

A record is a VARIANT object.  JSON values keep their types (the loader's
fall-through rules treat the number 0 and the text '0' differently), XML
values are text.  Field names are PascalCase after normalisation; a field is
read by path as ``$.NoTournament`` or, as received in camelCase,
``$.noTournament`` (the key normalisation, without building a new map per
record).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtline.sources.schemas import ENTITY_FIELDS
from courtline.functions.casts import (Val, as_string, first_truthy, is_missing, kind_name, kind_of,
                                       safe_bool, safe_date, safe_double, safe_int,
                                       safe_timestamp, text, text_if_present, truthy)

# Fixed stop list: a one-word tournament name that is one of these is not a city.
CITY_STOP_WORDS = ("open", "cup", "championship", "masters", "satellite", "challenger",
                   "continental", "olympic", "world", "finals", "grand", "slam", "pro", "beach",
                   "ecva", "cazova", "afecavol", "central")

RECORD_TYPE = "map<string,variant>"


def _strip(s: Column) -> Column:
    return F.regexp_replace(s, r"^\s+|\s+$", "")


def _pascal_keys(m: Column) -> Column:
    """Keys in PascalCase; of a key sent in both forms the PascalCase one counts, as in :func:`field`."""
    def pascal(k: Column) -> Column:
        return F.concat(F.upper(F.substring(k, 1, 1)), F.substr(k, F.lit(2)))
    once = F.map_filter(m, lambda k, _v: (pascal(k) == k) | ~F.map_contains_key(m, pascal(k)))
    return F.transform_keys(once, lambda k, _v: pascal(k))


def _as_array(v: Column) -> Column:
    return F.try_variant_get(v, "$", "array<variant>")


def _as_object(v: Column) -> Column:
    return F.try_variant_get(v, "$", RECORD_TYPE)


def _is_object(v: Column) -> Column:
    """Cheap object test: an object casts to an empty struct, anything else does not."""
    return F.try_variant_get(v, "$", "struct<>").isNotNull()


def _items(v: Column) -> Column:
    """A list value as its items, an object value as a one-item list, else NULL."""
    return F.coalesce(_as_array(v), F.when(_is_object(v), F.array(v)))


def pascal_keys(rec: Column) -> Column:
    """S3: the record as a map with PascalCase keys (camelCase -> PascalCase)."""
    return _pascal_keys(_as_object(rec))


def payload_text(rec: Column) -> Column:
    """The record as canonical JSON text: PascalCase keys, objects at any depth sorted by key, no blanks, one form a number.

    Two bodies that say the same give the same text, so payloads can be compared
    and hashed.  The number form is VARIANT's (1.50 is 1.5, 1e2 is 100.0).
    """
    # the map is bound once: named again inside the key rules, it would be made anew for every key
    return F.get(F.transform(F.array(_as_object(rec)), lambda m: F.to_json(F.to_variant_object(_pascal_keys(m)))), 0)


def field(rec: Column, name: str) -> Column:
    """Field ``name`` (PascalCase) of a record, as sent in PascalCase or camelCase."""
    camel = name[:1].lower() + name[1:]
    pas = F.try_variant_get(rec, f"$.{name}", "variant")
    if camel == name:
        return pas
    return F.coalesce(pas, F.try_variant_get(rec, f"$.{camel}", "variant"))


def parse_json(responses: DataFrame, body: str = "body") -> DataFrame:
    """JSON bodies -> one row per record with column ``rec`` (S1, S3, S4 shape rules).

    A top-level list is the record list; otherwise ``data`` (a list, or one
    object); otherwise the first list or object value in key order.
    Unparseable bodies and non-object items give no rows.  Shapes are tested
    with typed extraction (cheap), not by deriving each body's schema; the
    key-order fallback (a second parse) only runs for bodies that need it.
    """
    others = [c for c in responses.columns if c != body]
    # each extraction is its own projection, so it runs once per row
    x = responses.select(*others, body, F.try_parse_json(F.col(body)).alias("_top"))
    x = x.select(*others, body, "_top", _as_array(F.col("_top")).alias("_arr"),
                 F.try_variant_get(F.col("_top"), "$.data", "variant").alias("_data"))
    x = x.select(*others, body, "_top", "_arr", "_data",
                 _as_array(F.col("_data")).alias("_darr"),
                 _is_object(F.col("_data")).alias("_dobj"))
    primary = F.coalesce(F.col("_arr"), F.col("_darr"),
                         F.when(F.col("_dobj"), F.array(F.col("_data"))))
    x = x.select(*others, body, "_top", primary.alias("_primary"))
    # key-order fallback (a second parse) only where no list/data was found
    top_map = _as_object(F.col("_top"))
    ordered_keys = F.map_keys(F.from_json(F.col(body), "map<string,string>"))
    first_key = F.get(F.filter(ordered_keys, lambda k: _items(top_map[k]).isNotNull()), 0)
    items = F.when(F.col("_primary").isNotNull(), F.col("_primary")) \
        .otherwise(_items(top_map[first_key]))
    return (x.select(*others, F.explode(items).alias("rec"))
            .filter(_is_object(F.col("rec"))))


def strip_namespaces(xml: Column) -> Column:
    """Drop namespace prefixes from tags and the xmlns declarations."""
    no_decl = F.regexp_replace(xml, r"\s+xmlns(:[A-Za-z_][\w.-]*)?=\"[^\"]*\"", "")
    return F.regexp_replace(no_decl, r"(</?)[A-Za-z_][\w.-]*:", "$1")


# Option names of the XML reader: attributes are told from children by this sign, which no tag can hold.
_ATTRIBUTE = "@"
_PROBE = "x__"


_XML_ATTRIBUTES = r"""(?:\s+[\w.:-]+\s*=\s*(?:"[^"]*"|'[^']*'))*"""


def _nested_elements(bodies: DataFrame, text: str, node: str) -> DataFrame:
    """``_n`` (attributes, inner) of all ``node`` elements where some lie within others, else NULL.

    The running depth of the tags tells which end tag is an element's own: the
    first one after it that takes the depth back to what it was before.  Depths
    are only listed for bodies that nest; a single count says which do.
    """
    tag = F.lit(rf"(?s)<{node}{_XML_ATTRIBUTES}\s*/?>|</{node}\s*>")
    x = bodies.withColumn("_tags", F.regexp_extract_all(F.col(text), tag, F.lit(0)))
    x = x.withColumn("_steps", F.transform("_tags", lambda t: F.when(t.startswith("</"), -1).when(t.endswith("/>"), 0).otherwise(1)))
    zero = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("most"))
    most = F.aggregate("_steps", zero, lambda a, s: F.struct((a["depth"] + s).alias("depth"), F.greatest(a["most"], a["depth"] + F.when(s < 0, 0).otherwise(1)).alias("most")), lambda a: a["most"])
    x = x.withColumn("_nests", most > 1)
    x = x.withColumn("_depth", F.when(F.col("_nests"), F.aggregate("_steps", F.array(F.lit(0)), lambda a, s: F.concat(a, F.array(F.element_at(a, -1) + s)))))
    x = x.withColumn("_parts", F.when(F.col("_nests"), F.split(F.col(text), rf"(?s)<{node}{_XML_ATTRIBUTES}\s*/?>|</{node}\s*>")))

    def element(i: Column) -> Column:
        t = F.get("_tags", i)
        # tag i + p - 1 takes the depth back
        p = F.array_position(F.slice("_depth", i + 2, F.size("_depth")), F.get("_depth", i)).cast("int")
        end = F.when(F.get("_steps", i) == 0, i).otherwise(i + p - 1)
        inner = F.when(end > i, F.array_join(F.transform(F.sequence(i + 1, end), lambda k: F.concat(F.get("_parts", k), F.when(k < end, F.get("_tags", k)).otherwise(F.lit("")))), ""))
        return F.struct(F.regexp_extract(t, rf"(?s)^<{node}({_XML_ATTRIBUTES})", 1).alias("attributes"), F.coalesce(inner, F.lit("")).alias("inner"))

    opening = F.filter(F.sequence(F.lit(0), F.size("_tags") - 1), lambda i: F.get("_steps", i) >= 0)
    return x.withColumn("_nested", F.when(F.col("_nests"), F.transform(opening, element))).drop("_tags", "_steps", "_nests", "_depth", "_parts")


def parse_xml(responses: DataFrame, node: str, fields: Sequence[str] | None = None,
              body: str = "body") -> DataFrame:
    """XML bodies -> one row per ``node`` element at any depth, also within one of its own name, with column ``rec``.

    A record holds all of the element's attributes and the text of all its leaf
    children (a child overrides an attribute of the same name; empty children
    are left out), and the element's own text as ``_text`` if it has nothing
    else.  ``fields`` keeps only some of them.  Malformed bodies give no rows.
    """
    others = [c for c in responses.columns if c != body]
    x = responses.select(*others, strip_namespaces(F.col(body)).alias("_xml"))
    # well-formed or not is for the parser to say; elements are then cut out one by one
    bad = F.from_xml("_xml", "_corrupt_record string", {"mode": "PERMISSIVE"})["_corrupt_record"]
    x = x.filter(F.col("_xml").isNotNull() & bad.isNull())
    plain = F.regexp_replace("_xml", r"(?s)<!--.*?-->", "").alias("_plain")
    element = F.lit(rf"(?s)<{node}({_XML_ATTRIBUTES})\s*(?:/>|>(.*?)</{node}\s*>)")
    x = _nested_elements(x.select(*others, plain), "_plain", node)
    x = x.select(*others, F.explode(F.coalesce("_nested", F.arrays_zip(
        F.regexp_extract_all("_plain", element, F.lit(1)).alias("attributes"),
        F.regexp_extract_all("_plain", element, F.lit(2)).alias("inner")))).alias("_n"))
    # a child of our own makes the reader see an element that has attributes only
    whole = F.concat(F.lit(f"<r><{node}"), F.col("_n.attributes"), F.lit(f"><{_PROBE}>1</{_PROBE}>"),
                     F.col("_n.inner"), F.lit(f"</{node}></r>"))
    x = x.select(*others, F.col("_n.inner").alias("_inner"), F.from_xml(
        whole, f"{node} map<string,string>", {"attributePrefix": _ATTRIBUTE, "valueTag": _PROBE})[node].alias("_m"))
    branches = F.regexp_extract_all("_inner", F.lit(r"<([\w.-]+)(?:\s[^<>]*)?>\s*<(?![/!])"), F.lit(1))
    x = x.select(*others, "_inner", "_m", branches.alias("_branches"))
    child = F.map_filter("_m", lambda k, v: ~k.startswith(_ATTRIBUTE) & (k != _PROBE) & (F.trim(v) != "")
                         & ~F.array_contains("_branches", k))
    x = x.select(*others, "_inner", "_m", F.transform_values(child, lambda k, v: _strip(v)).alias("_child"))
    own = F.map_filter("_m", lambda k, v: k.startswith(_ATTRIBUTE)
                       & ~F.map_contains_key("_child", F.substr(k, F.lit(len(_ATTRIBUTE) + 1))))
    attributes = F.transform_keys(own, lambda k, v: F.substr(k, F.lit(len(_ATTRIBUTE) + 1)))
    text_only = ~F.col("_inner").contains("<") & (F.trim("_inner") != "")
    no_map = F.create_map().cast("map<string,string>")
    rec = F.map_concat(attributes, F.col("_child"), F.when(text_only, F.create_map(F.lit("_text"), _strip(F.col("_inner")))).otherwise(no_map))
    if fields is not None:
        rec = F.map_filter(rec, lambda k, v: k.isin(list(fields)))
    return x.select(*others, F.parse_json(F.to_json(rec)).alias("rec"))


def parse_responses(responses: DataFrame, node: str, fields: Sequence[str] | None = None) -> DataFrame:
    """JSON or XML by content type (JSON when it mentions ``json``)."""
    is_json = F.lower(F.coalesce(F.col("content_type"), F.lit(""))).contains("json")
    return (parse_json(responses.filter(is_json))
            .unionByName(parse_xml(responses.filter(~is_json), node, fields)))


# ---- normalisers (S20-S28) -------------------------------------------------------------

def _cname(name: str) -> str:
    """Helper column name; Spark names are case-insensitive (BirthDate vs Birthdate)."""
    return "".join(f"_{c.lower()}" if c.isupper() else c for c in name)


def _f(name: str) -> Val:
    """A record field with its kind, both computed once by :func:`with_fields`."""
    c = _cname(name)
    return Val(F.col(f"__v{c}"), F.col(f"__k{c}"), F.col(f"__s{c}"), F.col(f"__t{c}"))


def with_fields(records: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Project each needed field and its VARIANT kind once (the casts reuse them)."""
    rec = F.col("rec")
    x = records.select("*", *[field(rec, f).alias(f"__v{_cname(f)}") for f in fields])
    x = x.select("*", *[kind_name(F.col(f"__v{_cname(f)}")).alias(f"__n{_cname(f)}") for f in fields],
                 *[F.try_variant_get(F.col(f"__v{_cname(f)}"), "$", "string").alias(f"__s{_cname(f)}")
                   for f in fields])
    x = x.select("*", *[kind_of(F.col(f"__n{_cname(f)}")).alias(f"__k{_cname(f)}") for f in fields])
    # truthiness per field from the projected value/kind/text (one small CASE each)
    return x.select("*", *[truthy(Val(F.col(f"__v{_cname(f)}"), F.col(f"__k{_cname(f)}"),
                                      F.col(f"__s{_cname(f)}"))).alias(f"__t{_cname(f)}")
                           for f in fields])


def _trailer(ingested_at: Column | None) -> list[Column]:
    ts = ingested_at if ingested_at is not None else F.current_timestamp()
    return [payload_text(F.col("rec")).alias("payload"), ts.cast("timestamp").alias("ingested_at")]


def usable(records: DataFrame, required: Sequence[str] = ()) -> DataFrame:
    """Drop records carrying ``Errors`` or missing a required field."""
    cond = field(F.col("rec"), "Errors").isNull()
    for r in required:
        cond = cond & ~is_missing(field(F.col("rec"), r))
    return records.filter(cond)


def usable_results(records: DataFrame) -> DataFrame:
    """S4 of results: no ``Errors``, a Rank or a Position, and a team number that is a whole number."""
    x = with_fields(usable(records), ("Rank", "Position", "NoTeam"))
    place = ~is_missing(_f("Rank").v) | ~is_missing(_f("Position").v)
    return x.filter(place & safe_int(_f("NoTeam")).isNotNull()).select(*records.columns)


def _is_whole(name: str) -> Column:
    """Whether a field casts to a whole number; value and kind are bound once, as a filter's columns are inlined into it."""
    bound = F.transform(F.array(field(F.col("rec"), name)), lambda v: F.struct(v.alias("v"), kind_name(v).alias("n")))
    return F.exists(bound, lambda x: safe_int(Val(x["v"], kind_of(x["n"]))).isNotNull())


def usable_matches(records: DataFrame) -> DataFrame:
    """S4 of matches: no ``Errors``, a tournament number and a match number."""
    return usable(records).filter(_is_whole("NoTournament") & _is_whole("No"))


def norm_event(records: DataFrame, ingested_at: Column | None = None,
        carry: Sequence[str] = ()) -> DataFrame:
    records = with_fields(records, ENTITY_FIELDS["event"])
    return records.select(
        safe_int(_f("No")).alias("event_id"), text(_f("Code")).alias("code"),
        text(_f("Name")).alias("name"), safe_date(_f("StartDate")).alias("start_date"),
        safe_date(_f("EndDate")).alias("end_date"), text(_f("Type")).alias("type"),
        safe_int(_f("NoParentEvent")).alias("no_parent_event"),
        text(_f("CountryCode")).alias("country_code"),
        safe_bool(_f("HasBeachTournament")).alias("has_beach_tournament"),
        safe_bool(_f("HasMenTournament")).alias("has_men_tournament"),
        safe_bool(_f("HasWomenTournament")).alias("has_women_tournament"),
        safe_bool(_f("IsVisManaged")).alias("is_vis_managed"),
        *_trailer(ingested_at), *carry)


def infer_city(name: Column, city: Column) -> Column:
    """City if given, else a one-word tournament name that is not a stop word."""
    clean = F.regexp_replace(name, r"^\s+|\s+$", "")
    one_word = (clean != "") & ~clean.contains(" ") & ~F.lower(clean).isin(*CITY_STOP_WORDS)
    return F.coalesce(city, F.when(one_word, clean))


def norm_tournament(records: DataFrame, ingested_at: Column | None = None,
        carry: Sequence[str] = ()) -> DataFrame:
    records = with_fields(records, ENTITY_FIELDS["tournament"])
    name = text(_f("Name"))
    end = F.coalesce(safe_date(_f("EndDate")), safe_date(_f("EndDateMainDraw")),
                     safe_date(_f("EndDateQualification")))
    return records.select(
        safe_int(_f("No")).alias("tournament_id"), name.alias("name"),
        text(_f("Season")).alias("season"), text(_f("Type")).alias("tier"),
        safe_date(_f("StartDate")).alias("start_date"), end.alias("end_date"),
        infer_city(name, text(_f("City"))).alias("city"),
        text(_f("CountryCode")).alias("country_code"),
        text(_f("CountryName")).alias("country_name"),
        text_if_present(_f("Gender")).alias("gender"),
        text_if_present(_f("Status")).alias("status"),
        text(_f("Timezone")).alias("timezone"), *_trailer(ingested_at), *carry)


def norm_team(records: DataFrame, ingested_at: Column | None = None,
        carry: Sequence[str] = ()) -> DataFrame:
    records = with_fields(records, ENTITY_FIELDS["team"])
    return records.select(
        safe_int(_f("No")).alias("team_id"), safe_int(_f("NoTournament")).alias("tournament_id"),
        safe_int(_f("NoPlayer1")).alias("player_a_id"),
        safe_int(_f("NoPlayer2")).alias("player_b_id"),
        text(_f("CountryCode")).alias("country_code"),
        text_if_present(_f("Status")).alias("status"),
        safe_date(_f("ValidFrom")).alias("valid_from"), safe_date(_f("ValidTo")).alias("valid_to"),
        *_trailer(ingested_at), *carry)


def _strict_int(v: Column) -> Column:
    """``int(x)`` where a failure means no value (points comparison)."""
    return safe_int(v)


def match_winner(team_a: Column, team_b: Column, points_a: Column, points_b: Column) -> Column:
    """Side with more match points; tie, missing or non-integer points -> NULL."""
    present = ~(is_missing(points_a) | is_missing(points_b) | is_missing(team_a)
                | is_missing(team_b))
    pa, pb = _strict_int(points_a), _strict_int(points_b)
    ok = present & pa.isNotNull() & pb.isNotNull()
    return F.when(ok & (pa > pb), safe_int(team_a)).when(ok & (pb > pa), safe_int(team_b))


def duration_minutes(*sets: Column) -> Column:
    """Sum of set durations in seconds (bad values ignored) // 60; 0 -> NULL."""
    secs = None
    for v in sets:
        s = F.coalesce(safe_double(v).try_cast("long"), F.lit(0))
        secs = s if secs is None else secs + s
    return F.when(secs != 0, F.floor(secs / 60).cast("int"))


def norm_match(records: DataFrame, tournament_id: Column | None = None,
               ingested_at: Column | None = None,
        carry: Sequence[str] = ()) -> DataFrame:
    records = with_fields(records, ENTITY_FIELDS["match"])
    pa, pb = _f("MatchPointsA"), _f("MatchPointsB")
    has_points = ~(is_missing(pa) | is_missing(pb))
    tid = safe_int(_f("NoTournament"))
    if tournament_id is not None:   # int(NoTournament) or the id the request was made for
        tid = F.coalesce(F.nullif(tid, F.lit(0)), tournament_id.cast("long"))
    played = first_truthy(_f("BeginDateTimeUtc"), _f("DateTimeLocal"))
    return records.select(
        safe_int(_f("No")).alias("match_id"), tid.cast("long").alias("tournament_id"),
        text(_f("Phase")).alias("phase"),
        text_if_present(first_truthy(_f("NoRound"), _f("RoundCode"))).alias("round"),
        safe_int(_f("NoTeamA")).alias("team1_id"), safe_int(_f("NoTeamB")).alias("team2_id"),
        match_winner(_f("NoTeamA"), _f("NoTeamB"), pa, pb).alias("winner_team_id"),
        F.when(has_points, F.concat(as_string(pa), F.lit("-"), as_string(pb))).alias("score_sets"),
        duration_minutes(_f("DurationSet1"), _f("DurationSet2"), _f("DurationSet3"))
         .alias("duration_minutes"),
        safe_timestamp(played).alias("played_at"),
        text_if_present(_f("ResultType")).alias("result_type"),
        text_if_present(_f("Status")).alias("status"), *_trailer(ingested_at), *carry)


def norm_result(records: DataFrame, tournament_id: Column,
                ingested_at: Column | None = None,
        carry: Sequence[str] = ()) -> DataFrame:
    records = with_fields(records, ENTITY_FIELDS["result"])
    pos = first_truthy(_f("Rank"), _f("Position"))
    pos_text = _strip(as_string(pos))
    return records.select(
        tournament_id.cast("long").alias("tournament_id"), safe_int(_f("NoTeam")).alias("team_id"),
        F.when(~is_missing(pos) & (pos_text != ""), safe_int(pos)).cast("int")
         .alias("finishing_pos"),
        safe_int(first_truthy(_f("EarnedPointsTeam"), _f("Points"))).cast("int").alias("points"),
        safe_double(first_truthy(_f("EarningsTotalTeam"), _f("PrizeMoney"))).alias("prize_money"),
        *_trailer(ingested_at), *carry)


def norm_player(records: DataFrame, ingested_at: Column | None = None,
        carry: Sequence[str] = ()) -> DataFrame:
    records = with_fields(records, ENTITY_FIELDS["player"])
    first = F.coalesce(text(_f("FirstName")), F.lit(""))
    last = F.coalesce(text(_f("LastName")), F.lit(""))
    joined = _strip(F.concat(first, F.lit(" "), last))
    full = F.when(joined != "", joined).otherwise(text(_f("FullName")))
    h = safe_int(_f("Height"))
    height = F.when(h >= 10000, F.floor(h / 10000)).when(h < 500, h).cast("int")
    fed = _f("FederationCode")
    country = F.when(truthy(fed), F.nullif(_strip(as_string(fed)), F.lit("")))
    return records.select(
        safe_int(_f("No")).alias("player_id"), F.nullif(first, F.lit("")).alias("first_name"),
        F.nullif(last, F.lit("")).alias("last_name"), F.nullif(full, F.lit("")).alias("full_name"),
        text_if_present(_f("Gender")).alias("gender"),
        safe_date(first_truthy(_f("BirthDate"), _f("Birthdate"))).alias("birth_date"),
        height.alias("height_cm"), country.alias("country_code"),
        F.lit(None).cast("string").alias("profile_url"), *_trailer(ingested_at), *carry)


def norm_round(records: DataFrame, ingested_at: Column | None = None,
        carry: Sequence[str] = ()) -> DataFrame:
    records = with_fields(records, ENTITY_FIELDS["round"])
    return records.select(
        safe_int(_f("No")).alias("round_id"), safe_int(_f("NoTournament")).alias("tournament_id"),
        text(_f("Code")).alias("code"), text(_f("Name")).alias("name"),
        text(_f("Bracket")).alias("bracket"), text(_f("Phase")).alias("phase"),
        safe_date(_f("StartDate")).alias("start_date"), safe_date(_f("EndDate")).alias("end_date"),
        text(_f("RankMethod")).alias("rank_method"), *_trailer(ingested_at), *carry)


def norm_round_ranking(records: DataFrame, round_id: Column,
                       ingested_at: Column | None = None,
        carry: Sequence[str] = ()) -> DataFrame:
    records = with_fields(records, ENTITY_FIELDS["round_ranking"])
    return records.select(
        round_id.cast("long").alias("round_id"), safe_int(_f("Position")).cast("int").alias("position"),
        safe_int(_f("Rank")).cast("int").alias("rank"),
        text(_f("TeamFederationCode")).alias("team_federation_code"),
        text(_f("TeamName")).alias("team_name"),
        safe_int(_f("MatchPoints")).cast("int").alias("match_points"),
        safe_int(_f("MatchesWon")).cast("int").alias("matches_won"),
        safe_int(_f("MatchesLost")).cast("int").alias("matches_lost"), *_trailer(ingested_at), *carry)


def norm_team_ranking(records: DataFrame, ranking_type: Column, snapshot_date: Column,
                      gender: Column, ingested_at: Column | None = None,
        carry: Sequence[str] = ()) -> DataFrame:
    records = with_fields(records, ENTITY_FIELDS["team_ranking"])
    return records.select(
        ranking_type.alias("ranking_type"), snapshot_date.cast("date").alias("snapshot_date"),
        gender.alias("gender"), safe_int(_f("Position")).cast("int").alias("position"),
        safe_int(_f("NoPlayer1")).alias("no_player1"), safe_int(_f("NoPlayer2")).alias("no_player2"),
        text(_f("TeamName")).alias("team_name"),
        safe_int(first_truthy(_f("EarnedPointsTeam"), _f("Points"))).cast("int")
         .alias("earned_points"), *_trailer(ingested_at), *carry)
