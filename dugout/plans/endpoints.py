"""The 84 API endpoints as configuration over landed entity tables.

An endpoint is a filter contract: its parameters say which operators apply. The parameter
kinds below carry the meaning once for all endpoints; anything else is equality or
membership on the column of that name.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dugout.operators import entities, feed_diffs, streaks
from dugout.operators.pitch_search import multi_value
from dugout.operators.ranking import high_low, leaders, page
from dugout.sources.codes import code_table


@dataclass(frozen=True)
class Endpoint:
    name: str
    path: str
    params: tuple[str, ...]
    code: str | None = None

    @property
    def path_params(self) -> tuple[str, ...]:
        return tuple(re.findall(r"\{(\w+)\}", self.path))


# Function, path, parameters; where a code table answers, its name.
ENDPOINTS = {
    row[0]: Endpoint(row[0], row[1], tuple(row[2]), row[3] if len(row) > 3 else None)
    for row in [
        ("get_schedule", "/api/v1/schedule",
         [
             "sportId", "gamePks", "date", "startDate", "endDate", "teamId", "opponentId", "leagueId",
             "venueIds", "gameTypes", "scheduleType", "scheduleTypes", "eventTypes",
             "scheduleEventTypes", "useLatestGames", "timecode", "hydrate", "fields", "season",
         ]),
        ("get_gamefeed", "/api/v1.1/game/{game_pk}/feed/live", ["timecode", "hydrate", "fields"]),
        ("get_gamefeed_diffpatch", "/api/v1.1/game/{game_pk}/feed/live/diffPatch", ["startTimecode", "endTimecode"]),
        ("get_gamefeed_timestamps", "/api/v1.1/game/{game_pk}/feed/live/timestamps", []),
        ("get_boxscore", "/api/v1/game/{game_pk}/boxscore", []),
        ("get_linescore", "/api/v1/game/{game_pk}/linescore", []),
        ("get_playbyplay", "/api/v1/game/{game_pk}/playByPlay", []),
        ("get_game_content", "/api/v1/game/{game_pk}/content", []),
        ("get_context_metrics", "/api/v1/game/{game_pk}/contextMetrics", []),
        ("get_win_probability", "/api/v1/game/{game_pk}/winProbability", []),
        ("get_color_feed", "/api/v1/game/{game_pk}/feed/color", ["timecode"]),
        ("get_color_diffpatch", "/api/v1/game/{game_pk}/feed/color/diffPatch", ["startTimecode", "endTimecode"]),
        ("get_color_timestamps", "/api/v1/game/{game_pk}/feed/color/timestamps", []),
        ("get_game_changes", "/api/v1/game/changes", ["updatedSince", "sportId"]),
        ("get_postseason_schedule", "/api/v1/schedule/postseason", ["season", "hydrate"]),
        ("get_postseason_series", "/api/v1/schedule/postseason/series", ["season"]),
        ("get_tied_games", "/api/v1/schedule/games/tied", ["season"]),
        ("get_people", "/api/v1/people", ["personIds", "hydrate", "season", "appContext", "fields"]),
        ("get_person", "/api/v1/people/{person_id}", ["hydrate", "fields"]),
        ("search_players", "/api/v1/people/search", ["names", "personIds", "active", "currentTeamId", "sportId"]),
        ("get_player_changes", "/api/v1/people/changes", ["updatedSince", "limit", "offset"]),
        ("get_free_agents", "/api/v1/people/freeAgents", ["season", "order"]),
        ("get_teams", "/api/v1/teams", [
             "season", "sportIds", "activeStatus", "allStarStatuses", "leagueIds", "gameType",
             "hydrate", "fields",
         ]),
        ("get_team", "/api/v1/teams/{team_id}", ["season", "sportId", "hydrate", "fields"]),
        ("get_team_history", "/api/v1/teams/history", ["teamIds", "startSeason", "endSeason"]),
        ("get_team_stats", "/api/v1/teams/stats",
         [
             "season", "group", "stats", "sportIds", "gameType", "order", "limit", "offset",
             "sortStat", "startDate", "endDate", "sitCodes",
         ]),
        ("get_team_leaders", "/api/v1/teams/stats/leaders",
         [
             "leaderCategories", "season", "sportId", "gameTypes", "statGroup", "leagueIds",
             "startDate", "endDate", "statType", "sitCodes", "hydrate", "limit", "fields",
         ]),
        ("get_team_affiliates", "/api/v1/teams/affiliates", ["teamIds", "sportId", "season", "hydrate"]),
        ("get_roster", "/api/v1/teams/{team_id}/roster", ["rosterType", "season", "date", "gameType", "hydrate", "fields"]),
        ("get_team_specific_leaders", "/api/v1/teams/{team_id}/leaders", ["leaderCategories", "season", "leaderGameTypes", "hydrate"]),
        ("get_team_specific_stats", "/api/v1/teams/{team_id}/stats",
         [
             "season", "group", "stats", "gameType", "sportIds", "startDate", "endDate", "sitCodes",
         ]),
        ("get_team_alumni", "/api/v1/teams/{team_id}/alumni", ["season", "group", "hydrate"]),
        ("get_stats", "/api/v1/stats",
         [
             "stats", "group", "season", "sportIds", "gameType", "playerPool", "limit", "offset",
             "order", "sortStat", "personIds", "teamIds",
         ]),
        ("get_stat_leaders", "/api/v1/stats/leaders",
         [
             "leaderCategories", "season", "sportId", "gameTypes", "statGroup", "leaderGameTypes",
             "playerPool", "limit", "statType", "sitCodes", "hydrate", "fields",
         ]),
        ("get_streaks", "/api/v1/stats/streaks", [
             "streakType", "streakSpan", "season", "sportId", "limit", "gameType", "hydrate", "fields",
         ]),
        ("get_draft", "/api/v1/draft/{year}", ["round"]),
        ("get_draft_prospects", "/api/v1/draft/prospects/{year}", ["schoolYear", "state", "country", "position", "teamId", "round"]),
        ("get_award_recipients", "/api/v1/awards/{award_id}/recipients", ["season", "sportId", "leagueId", "hydrate"]),
        ("get_transactions", "/api/v1/transactions", ["teamId", "playerId", "date", "startDate", "endDate"]),
        ("get_venues", "/api/v1/venues", ["venueIds", "season", "hydrate"]),
        ("get_venue", "/api/v1/venues/{venue_id}", []),
        ("get_standings", "/api/v1/standings", ["leagueId", "season", "standingsTypes", "date", "hydrate", "fields"]),
        ("get_leagues", "/api/v1/league", ["sportId"]),
        ("get_league", "/api/v1/league/{league_id}", []),
        ("get_divisions", "/api/v1/divisions", ["divisionId", "leagueId", "sportId"]),
        ("get_seasons", "/api/v1/seasons", ["sportId", "season", "withGameTypeDates", "divisionId", "leagueId"]),
        ("get_season", "/api/v1/seasons/{season_id}", []),
        ("get_attendance", "/api/v1/attendance",
         [
             "teamId", "leagueId", "season", "date", "startDate", "endDate", "leagueListId",
             "gameType", "fields",
         ]),
        ("get_sports", "/api/v1/sports", ["sportId", "activeStatus", "fields"]),
        ("get_sport", "/api/v1/sports/{sport_id}", []),
        ("get_sport_players", "/api/v1/sports/{sport_id}/players", ["season", "gameType", "fields"]),
        ("get_umpires", "/api/v1/jobs/umpires", ["sportId", "date", "season", "fields"]),
        ("get_official_scorers", "/api/v1/jobs/officialScorers", []),
        ("get_datacasters", "/api/v1/jobs/datacasters", []),
        ("get_broadcasts", "/api/v1/schedule/broadcasts", ["sportId", "date", "teamId"]),
        ("get_conferences", "/api/v1/conferences", []),
        ("get_high_low", "/api/v1/highLow/{org_type}", ["sortStat", "season", "sportId", "gameType"]),
        ("get_home_run_derby", "/api/v1/homeRunDerby/{game_pk}", []),
        ("get_derby_bracket", "/api/v1/homeRunDerby/{game_pk}/bracket", []),
        ("get_derby_pool", "/api/v1/homeRunDerby/{game_pk}/pool", []),
        ("get_game_pace", "/api/v1/gamePace", ["season", "sportId", "gameType"]),
        ("get_uniforms_game", "/api/v1/uniforms/game", ["gamePks"]),
        ("get_uniforms_team", "/api/v1/uniforms/team", ["teamIds", "season"]),
        ("get_stat_types", "/api/v1/statTypes", [], "stat_types"),
        ("get_stat_groups", "/api/v1/statGroups", [], "stat_groups"),
        ("get_game_types", "/api/v1/gameTypes", [], "game_types"),
        ("get_positions", "/api/v1/positions", [], "positions"),
        ("get_situation_codes", "/api/v1/situationCodes", [], "situations"),
        ("get_metrics", "/api/v1/metrics", [], "metrics"),
        ("get_league_leader_types", "/api/v1/leagueLeaderTypes", [], "leader_categories"),
        ("get_sports_discovery", "/api/v1/sports", [], "sports"),
        ("get_baseball_stats", "/api/v1/baseballStats", []),
        ("get_roster_types", "/api/v1/rosterTypes", [], "roster_types"),
        ("get_standings_types", "/api/v1/standingsTypes", [], "standings_types"),
        ("get_game_status", "/api/v1/gameStatus", [], "game_statuses"),
        ("get_pitch_types", "/api/v1/pitchTypes", [], "pitch_types"),
        ("get_hit_trajectories", "/api/v1/hitTrajectories", [], "trajectories"),
        ("get_event_types", "/api/v1/eventTypes", [], "event_types"),
        ("get_schedule_event_types", "/api/v1/scheduleEventTypes", [], "schedule_events"),
        ("get_wind_direction", "/api/v1/windDirection", [], "winds"),
        ("get_sky", "/api/v1/sky", [], "skies"),
        ("get_job_types", "/api/v1/jobTypes", []),
        ("get_languages", "/api/v1/languages", []),
        ("get_platforms", "/api/v1/platforms", []),
    ]
}

# Endpoints whose ``date`` means the latest state up to that day, and their state keys.
AS_OF_DATE = {"get_roster", "get_standings", "get_umpires"}
LEADERS = {"get_stat_leaders", "get_team_leaders", "get_team_specific_leaders"}
FEED_TIMES = {"get_gamefeed_timestamps", "get_color_timestamps"}
FEEDS = {"get_gamefeed", "get_color_feed", "get_schedule"}
FEED_DIFFS = {"get_gamefeed_diffpatch", "get_color_diffpatch"}
# Shape the answer, not which rows match.
SHAPING = {
    "hydrate", "fields", "limit", "offset", "order", "sortStat", "date", "startDate", "endDate",
    "timecode", "startTimecode", "endTimecode", "updatedSince", "startSeason", "endSeason",
    "leaderCategories", "names",
}
SHAPED_TEXT = {"fields"}
STREAK_PARAMS = {"streakType", "streakSpan", "season"}


def column_of(param: str, columns: list[str]) -> str | None:
    """The table column a parameter tests: same words in snake case, singular if need be."""
    snake = re.sub(r"(?<=[a-z0-9])([A-Z])", r"_\1", param).lower()
    tries = [param, snake, snake.removesuffix("s"), snake.removesuffix("es")]
    return next((t for t in tries if t in columns), None)


def _listed(param: str, value: Any) -> Any:
    """Plural parameters take a list or its comma-joined text."""
    plural = param.endswith("s") and param not in ("activeStatus", "allStarStatus")
    return value.split(",") if plural and isinstance(value, str) else value


def _category_bound(given: dict[str, Any]) -> int | None:
    """How many leader categories an answer can have: those asked for."""
    asked = given.get("leaderCategories")
    return None if asked is None else len(multi_value(asked))


@dataclass(frozen=True)
class Settings:
    """Where the parts of an endpoint's contract lie in a landed table.

    Settings travel apart from the endpoint's parameters, so none can hide one. ``columns``
    overrides parameter-to-column names; ``related`` gives, per name that ``hydrate`` may ask
    for, the related table and its join columns; ``streak`` holds the arguments that
    ``streaks.streaks`` needs beside type, span, season and limit.
    """

    columns: Mapping[str, str] = field(default_factory=dict)
    key: tuple[str, ...] = ()
    day: str = "date"
    ts: str = "ts"
    game: str = "game_pk"
    body: str = "body"
    updated: str = "updated"
    season: str = "season"
    category: str = "category"
    value: str = "value"
    person_name: str = "full_name"
    ties: tuple[str, ...] = ()
    related: Mapping[str, tuple[DataFrame, list[str]]] = field(default_factory=dict)
    streak: Mapping[str, Any] | None = None
    # Column of a team's parent club, for affiliates.
    parent: str = "parent_org_id"
    team: str = "team_id"


def hydrate_parts(text: str) -> list[str]:
    """Names in a hydrate list; what stands in brackets belongs to the name before it."""
    parts, depth, word = [], 0, ""
    for c in text:
        depth += (c in "([") - (c in ")]")
        if c == "," and not depth:
            parts.append(word)
            word = ""
        else:
            word += c
    return [p.split("(")[0].strip() for p in [*parts, word] if p.strip()]


def query_endpoint(name: str, df: DataFrame, settings: Settings = Settings(), /, **params: Any) -> DataFrame:
    """One endpoint's contract applied to its landed table; ``params`` are the endpoint's own."""
    spec = ENDPOINTS[name]
    allowed = {*spec.params, *spec.path_params}
    unknown = set(params) - allowed
    if unknown:
        raise ValueError(f"{name} does not take {sorted(unknown)}; it takes {sorted(allowed)}")
    at = settings
    given = {p: _listed(p, v) if p not in SHAPED_TEXT else v for p, v in params.items() if v is not None}
    out = df
    # teamIds of affiliates first: it looks at all teams.
    for param, wanted in sorted(given.items(), key=lambda g: (name, g[0]) != ("get_team_affiliates", "teamIds")):
        if param in SHAPING or (name == "get_streaks" and param in STREAK_PARAMS):
            continue
        column = at.columns.get(param) or column_of(param, df.columns)
        if column is None and param == "season" and at.season in df.columns:
            column = at.season
        if name == "get_team_affiliates" and param == "teamIds":
            missing = [c for c in (at.team, at.parent) if c not in df.columns]
            if missing:
                raise ValueError(f"{name} needs the columns {missing} of teams and their parent clubs; see Settings.team and parent")
            ids = wanted if isinstance(wanted, (list, tuple)) else [wanted]
            # The chain of clubs is that of all teams, so it is followed before other filters.
            out = entities.affiliates_of(df, ids, at.team, at.parent)
            continue
        if column is None:
            raise ValueError(f"no column for {name}({param}=...); pass columns={{{param!r}: ...}}")
        out = entities.entity_filter(out, **{column: wanted})
    if "names" in given:
        out = entities.name_search(out, given["names"], at.person_name)
    if "startSeason" in given:
        out = out.where(F.col(at.season) >= int(given["startSeason"]))
    if "endSeason" in given:
        out = out.where(F.col(at.season) <= int(given["endSeason"]))
    if "date" in given and name in AS_OF_DATE:
        out = entities.as_of_date(out, at.key, at.day, given["date"])
    else:
        out = entities.date_window(out, at.day, given.get("date"), given.get("startDate"), given.get("endDate"))
    if "updatedSince" in given:
        out = entities.changed_since(out, at.updated, given["updatedSince"])
    if name in FEED_DIFFS:
        if at.body not in df.columns:
            raise ValueError(f"{name} needs the column of bodies; the setting body is {at.body!r}")
        # Operations need the snapshot before the first one wanted, so times are cut afterwards.
        ops = feed_diffs.feed_diffs(out, at.game, at.ts, at.body, at.ties)
        return feed_diffs.diffs_between(ops, at.ts, given.get("startTimecode"), given.get("endTimecode")).drop("steps")
    if "startTimecode" in given or "endTimecode" in given:
        out = entities.feed_between(out, at.ts, given.get("startTimecode"), given.get("endTimecode"))
    if name in FEED_TIMES:
        return entities.feed_timecodes(out, at.game, at.ts)
    if "timecode" in given or (name in FEEDS and name != "get_schedule"):
        out = entities.feed_at(out, at.game, at.ts, given.get("timecode"), at.ties)
    limit = None if given.get("limit") is None else int(given["limit"])
    if name in LEADERS:
        if "leaderCategories" in given:
            out = entities.entity_filter(out, **{at.category: given["leaderCategories"]})
        out = leaders(out, [at.category], at.value, limit, groups=_category_bound(given))
    elif name == "get_high_low":
        out = high_low(out, list(at.key), at.columns.get("sortStat", given.get("sortStat", at.value)))
    elif name == "get_streaks":
        out = _streaks(out, at, given, limit)
    elif name == "get_free_agents" and "order" in given:
        # A direction, or the column to go by; names decide among equals.
        by = at.columns.get("order", at.person_name) if given["order"] in ("asc", "desc") else given["order"]
        if by not in out.columns:
            raise ValueError(f"{name}: order is 'asc', 'desc' or a column, and there is no column {by!r}")
        out = page(out, by, [c for c in (at.person_name, *at.ties) if c in out.columns and c != by], descending=given["order"] == "desc")
    elif {"sortStat", "limit", "offset", "order"} & set(given):
        stat = at.columns.get("sortStat") or given.get("sortStat")
        descending = given.get("order", "desc") != "asc"
        if stat is None and "updatedSince" in spec.params:
            stat, descending = at.updated, False
        if stat is None:
            raise ValueError(f"{name} needs sortStat to order its rows for limit, offset or order")
        out = page(out, stat, at.ties, limit, int(given.get("offset", 0)), descending)
    for part in hydrate_parts(given.get("hydrate") or ""):
        if part not in at.related:
            raise ValueError(f"{name}: no related table for hydrate part {part!r}; it has {sorted(at.related)}")
        other, on = at.related[part]
        out = entities.hydrate(out, other, on, as_struct=part)
    if "fields" in given:
        out = entities.sparse_fields(out, given["fields"])
    return out


def _streaks(df: DataFrame, at: Settings, given: dict[str, Any], limit: int | None) -> DataFrame:
    if at.streak is None:
        raise ValueError("get_streaks needs the setting streak: player, order and flags")
    if not {"streakType", "streakSpan"} <= set(given):
        raise ValueError("get_streaks needs streakType and streakSpan")
    only = given.get("season")
    return streaks.streaks(
        df,
        given["streakType"],
        given["streakSpan"],
        season=at.season,
        only_season=None if only is None else int(only),
        top=limit,
        **at.streak,
    )


class LandedApi:
    """Endpoint functions over a folder with one Parquet table per endpoint.

    ``LandedApi(spark, root).get_schedule(sportId=1, date="2024-06-01")`` reads
    ``root/get_schedule``; code tables need no landed data. ``settings`` says per endpoint
    where its parts lie, where the defaults do not fit.
    """

    def __init__(self, spark: SparkSession, root: str, settings: Mapping[str, Settings] | None = None):
        self.spark = spark
        self.settings = dict(settings or {})
        self.root = root.rstrip("/")

    def __getattr__(self, name: str):
        if name not in ENDPOINTS:
            raise AttributeError(name)

        def call(**params: Any) -> DataFrame:
            spec = ENDPOINTS[name]
            if spec.code is not None:
                return code_table(self.spark, spec.code, "api")
            rows = self.spark.read.parquet(f"{self.root}/{name}")
            return query_endpoint(name, rows, self.settings.get(name, Settings()), **params)

        return call
