"""Fixed code tables and their DataFrames.

Pitch-side and API-side tables share names but differ in content, so each lives in its own
namespace (``PITCH_SIDE`` and ``API_SIDE``). All of them are constants of well under 200
rows, which is what makes the broadcast hints on them safe.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --------------------------------------------------------------------------------------
# Fixed values, pitch side
# --------------------------------------------------------------------------------------

PITCH_TYPES = [
    ("FF", "4-Seam Fastball"),
    ("SI", "Sinker"),
    ("FC", "Cutter"),
    ("SL", "Slider"),
    ("ST", "Sweeper"),
    ("SV", "Slurve"),
    ("CU", "Curveball"),
    ("KC", "Knuckle Curve"),
    ("CH", "Changeup"),
    ("FS", "Split-Finger"),
    ("FO", "Forkball"),
    ("KN", "Knuckleball"),
    ("EP", "Eephus"),
]
PA_RESULTS = [
    ("single", "Single"),
    ("double", "Double"),
    ("triple", "Triple"),
    ("home_run", "Home Run"),
    ("walk", "Walk"),
    ("hit_by_pitch", "Hit by Pitch"),
    ("strikeout", "Strikeout"),
    ("strikeout_double_play", "Strikeout + DP"),
    ("field_out", "Field Out"),
    ("double_play", "Double Play"),
    ("triple_play", "Triple Play"),
    ("force_out", "Force Out"),
    ("grounded_into_double_play", "GIDP"),
    ("fielders_choice", "Fielder's Choice"),
    ("fielders_choice_out", "FC Out"),
    ("sac_fly", "Sacrifice Fly"),
    ("sac_bunt", "Sacrifice Bunt"),
    ("sac_fly_double_play", "Sac Fly DP"),
]
PITCH_RESULTS = [
    ("S", "Swinging Strike"),
    ("C", "Called Strike"),
    ("B", "Ball"),
    ("X", "Ball in Play"),
    ("F", "Foul"),
    ("T", "Foul Tip"),
    ("L", "Foul Bunt"),
    ("I", "Intent Ball"),
    ("O", "Foul Tip (bunted)"),
    ("W", "Swinging Strike (blocked)"),
    ("M", "Missed Bunt"),
    ("P", "Pitchout"),
    ("Q", "Swinging Pitchout"),
    ("R", "Foul Pitchout"),
]
BATTED_BALLS = [
    ("ground_ball", "Ground Ball"),
    ("line_drive", "Line Drive"),
    ("fly_ball", "Fly Ball"),
    ("popup", "Popup"),
]
CONTACT_QUALITY = [
    ("1", "Weak"),
    ("2", "Topped"),
    ("3", "Under"),
    ("4", "Flare/Burner"),
    ("5", "Solid Contact"),
    ("6", "Barrel"),
]
RUNNERS_ON = [
    ("0", "Empty"),
    ("1", "1st"),
    ("2", "2nd"),
    ("3", "3rd"),
    ("4", "1st & 2nd"),
    ("5", "1st & 3rd"),
    ("6", "2nd & 3rd"),
    ("7", "Loaded"),
]
GAME_TYPES = [
    ("R", "Regular Season"),
    ("F", "Wild Card"),
    ("D", "Division Series"),
    ("L", "League Championship Series"),
    ("W", "World Series"),
    ("S", "Spring Training"),
]
POSITIONS = [
    ("1", "P"),
    ("2", "C"),
    ("3", "1B"),
    ("4", "2B"),
    ("5", "3B"),
    ("6", "SS"),
    ("7", "LF"),
    ("8", "CF"),
    ("9", "RF"),
]
# code, name, city, other names; the order decides who owns a shared city
TEAMS = [
    ("ARI", "Arizona Diamondbacks", "Arizona", ("Diamondbacks", "D-backs", "DBacks", "AZ")),
    ("ATL", "Atlanta Braves", "Atlanta", ("Braves",)),
    ("BAL", "Baltimore Orioles", "Baltimore", ("Orioles", "O's")),
    ("BOS", "Boston Red Sox", "Boston", ("Red Sox", "Sox")),
    ("CHC", "Chicago Cubs", "Chicago", ("Cubs", "Cubbies")),
    ("CWS", "Chicago White Sox", "Chicago", ("White Sox", "ChiSox", "CHW")),
    ("CIN", "Cincinnati Reds", "Cincinnati", ("Reds",)),
    ("CLE", "Cleveland Guardians", "Cleveland", ("Guardians", "Indians")),
    ("COL", "Colorado Rockies", "Colorado", ("Rockies",)),
    ("DET", "Detroit Tigers", "Detroit", ("Tigers",)),
    ("HOU", "Houston Astros", "Houston", ("Astros",)),
    ("KC", "Kansas City Royals", "Kansas City", ("Royals", "KCR")),
    ("LAA", "Los Angeles Angels", "Los Angeles", ("Angels", "LA Angels", "Anaheim")),
    ("LAD", "Los Angeles Dodgers", "Los Angeles", ("Dodgers", "LA Dodgers")),
    ("MIA", "Miami Marlins", "Miami", ("Marlins", "FLA")),
    ("MIL", "Milwaukee Brewers", "Milwaukee", ("Brewers", "Brew Crew")),
    ("MIN", "Minnesota Twins", "Minnesota", ("Twins",)),
    ("NYM", "New York Mets", "New York", ("Mets",)),
    ("NYY", "New York Yankees", "New York", ("Yankees", "Yanks")),
    ("OAK", "Oakland Athletics", "Oakland", ("Athletics", "A's", "As", "ATH")),
    ("PHI", "Philadelphia Phillies", "Philadelphia", ("Phillies", "Phils")),
    ("PIT", "Pittsburgh Pirates", "Pittsburgh", ("Pirates", "Bucs")),
    ("SD", "San Diego Padres", "San Diego", ("Padres", "SDP")),
    ("SEA", "Seattle Mariners", "Seattle", ("Mariners", "M's")),
    ("SF", "San Francisco Giants", "San Francisco", ("Giants", "SFG")),
    ("STL", "St. Louis Cardinals", "St. Louis", ("Cardinals", "Cards")),
    ("TB", "Tampa Bay Rays", "Tampa Bay", ("Rays", "TBR")),
    ("TEX", "Texas Rangers", "Texas", ("Rangers",)),
    ("TOR", "Toronto Blue Jays", "Toronto", ("Blue Jays", "Jays")),
    ("WSH", "Washington Nationals", "Washington", ("Nationals", "Nats", "WSN", "WAS")),
]
PITCH_WORDS = [
    ("4-seam", "FF"),
    ("4 seam", "FF"),
    ("four-seam", "FF"),
    ("fourseam", "FF"),
    ("fastball", "FF"),
    ("heater", "FF"),
    ("two-seam", "SI"),
    ("2-seam", "SI"),
    ("sinker", "SI"),
    ("cutter", "FC"),
    ("cut fastball", "FC"),
    ("slider", "SL"),
    ("sweeper", "ST"),
    ("sweeping slider", "ST"),
    ("slurve", "SV"),
    ("curve", "CU"),
    ("curveball", "CU"),
    ("knuckle curve", "KC"),
    ("knuckle-curve", "KC"),
    ("change", "CH"),
    ("changeup", "CH"),
    ("splitter", "FS"),
    ("split-finger", "FS"),
    ("split finger", "FS"),
    ("forkball", "FO"),
    ("knuckleball", "KN"),
    ("knuckle", "KN"),
    ("eephus", "EP"),
]
HAND_WORDS = [
    ("r", "R"),
    ("right", "R"),
    ("rhp", "R"),
    ("rhh", "R"),
    ("righty", "R"),
    ("righthanded", "R"),
    ("right-handed", "R"),
    ("l", "L"),
    ("left", "L"),
    ("lhp", "L"),
    ("lhh", "L"),
    ("lefty", "L"),
    ("lefthanded", "L"),
    ("left-handed", "L"),
    ("s", "S"),
    ("switch", "S"),
    ("both", "S"),
    ("switch-hitter", "S"),
]

# --------------------------------------------------------------------------------------
# Fixed values, API side
# --------------------------------------------------------------------------------------

# id, code, name, abbreviation
SPORTS = [
    (1, "mlb", "Major League Baseball", "MLB"),
    (11, "aaa", "Triple-A", "AAA"),
    (12, "aax", "Double-A", "AA"),
    (13, "afa", "High-A", "A+"),
    (14, "afx", "Single-A", "A"),
    (16, "rok", "Rookie", "ROK"),
    (17, "win", "Winter Leagues", "WIN"),
    (21, "min", "Minor League Baseball", "Minors"),
    (22, "bbc", "College Baseball", "College"),
    (23, "ind", "Independent Leagues", "IND"),
    (31, "jml", "Nippon Professional Baseball", "NPB"),
    (32, "kor", "Korean Baseball Organization", "KOR"),
    (51, "int", "International Baseball", "INT"),
    (52, "oly", "Olympic Baseball", "OLY"),
    (61, "nlb", "Negro League Baseball", "NLB"),
    (586, "hsb", "High School Baseball", "H.S."),
]
MERGE_SPORT_IDS = (1, 11, 12, 13, 14, 16)
API_GAME_TYPES = [
    ("S", "Spring Training"),
    ("R", "Regular Season"),
    ("F", "Wild Card"),
    ("D", "Division Series"),
    ("L", "League Championship Series"),
    ("W", "World Series"),
    ("C", "Championship"),
    ("N", "Nineteenth Century Series"),
    ("P", "Playoffs"),
    ("A", "All-Star Game"),
    ("I", "Intrasquad"),
    ("E", "Exhibition"),
]
STAT_TYPES = [
    "projected", "projectedRos", "yearByYear", "yearByYearAdvanced", "yearByYearPlayoffs", "season",
    "standard", "advanced", "career", "careerRegularSeason", "careerAdvanced", "seasonAdvanced",
    "careerStatSplits", "careerPlayoffs", "gameLog", "playLog", "pitchLog", "metricLog",
    "metricAverages", "pitchArsenal", "outsAboveAverage", "expectedStatistics", "sabermetrics",
    "sprayChart", "tracking", "vsPlayer", "vsPlayerTotal", "vsPlayer5Y", "vsTeam", "vsTeam5Y",
    "vsTeamTotal", "lastXGames", "byDateRange", "byDateRangeAdvanced", "byMonth", "byMonthPlayoffs",
    "byDayOfWeek", "byDayOfWeekPlayoffs", "homeAndAway", "homeAndAwayPlayoffs", "winLoss",
    "winLossPlayoffs", "rankings", "rankingsByYear", "statsSingleSeason", "statsSingleSeasonAdvanced",
    "hotColdZones", "availableStats", "opponentsFaced", "gameTypeStats", "firstYearStats",
    "lastYearStats", "statSplits", "statSplitsAdvanced", "atGameStart", "vsOpponents",
    "sabermetricsMultiTeam", "projected_Zips", "projected_ZipsRos", "projected_Zips2YR",
    "projected_Zips3YR",
]
STAT_GROUPS = [
    "hitting", "pitching", "fielding", "catching", "running", "game", "team", "streak",
]
ROSTER_TYPES = [
    ("active", "Active roster"),
    ("fullRoster", "Full roster (active + inactive)"),
    ("fullSeason", "Full season roster"),
    ("40Man", "40-man roster"),
    ("nonRosterInvitees", "Non-roster invitees"),
    ("allTime", "All-time roster"),
    ("depthChart", "Depth chart"),
    ("gameday", "Gameday roster"),
    ("coach", "Coaching staff"),
]
STANDINGS_TYPES = [
    "regularSeason", "wildCard", "divisionLeaders", "wildCardWithLeaders", "firstHalf", "secondHalf",
    "springTraining", "postseason", "byDivision", "byConference", "byLeague", "byOrganization",
    "currentHalf",
]
# code, abbreviation, name, type
API_POSITIONS = [
    ("1", "P", "Pitcher", "Pitcher"),
    ("2", "C", "Catcher", "Catcher"),
    ("3", "1B", "First Base", "Infielder"),
    ("4", "2B", "Second Base", "Infielder"),
    ("5", "3B", "Third Base", "Infielder"),
    ("6", "SS", "Shortstop", "Infielder"),
    ("7", "LF", "Left Field", "Outfielder"),
    ("8", "CF", "Center Field", "Outfielder"),
    ("9", "RF", "Right Field", "Outfielder"),
    ("10", "DH", "Designated Hitter", "Hitter"),
    ("11", "PH", "Pinch Hitter", "Hitter"),
    ("12", "PR", "Pinch Runner", "Runner"),
]
API_PITCH_TYPES = [
    ("FF", "Four-seam Fastball"),
    ("SI", "Sinker"),
    ("FC", "Cutter"),
    ("SL", "Slider"),
    ("ST", "Sweeper"),
    ("CU", "Curveball"),
    ("KC", "Knuckle Curve"),
    ("CH", "Changeup"),
    ("FS", "Splitter"),
    ("FO", "Forkball"),
    ("SC", "Screwball"),
    ("KN", "Knuckleball"),
    ("EP", "Eephus"),
    ("CS", "Slow Curve"),
    ("SV", "Slurve"),
    ("GY", "Gyroball"),
    ("FT", "Two-seam Fastball"),
    ("FA", "Fastball (generic)"),
    ("IN", "Intentional Ball"),
    ("PO", "Pitchout"),
    ("AB", "Automatic Ball"),
    ("AS", "Automatic Strike"),
    ("NP", "No Pitch"),
    ("UN", "Unknown"),
]
MONTHS = [
    "January", "February", "March", "April", "May", "June", "July", "August", "September", "October",
    "November", "December",
]
# family -> code, label
SITUATIONS = {
    "game_context": [
        ("h", "Home Games"),
        ("a", "Away Games"),
        ("d", "Day Games"),
        ("n", "Night Games"),
        ("g", "On Grass"),
        ("t", "On Turf"),
    ],
    "month": [(str(i + 1), m) for i, m in enumerate(MONTHS)],
    "timeframe": [("h0", "Season To Date"), ("h1", "First Half"), ("h2", "Second Half")],
    "count": [(f"p{i}", f"Count code p{i}") for i in range(12)],
    "runners": [
        ("ro", "Runners On"),
        ("ri", "Runners In Scoring Position"),
        ("re", "Bases Empty"),
        ("r1", "Runner on 1st"),
        ("r2", "Runner on 2nd"),
        ("r3", "Runner on 3rd"),
        ("r12", "Runners on 1st & 2nd"),
        ("r13", "Runners on 1st & 3rd"),
        ("r23", "Runners on 2nd & 3rd"),
        ("r123", "Bases Loaded"),
    ],
    "outs": [("o0", "0 Outs"), ("o1", "1 Out"), ("o2", "2 Outs")],
    "handedness": [("vr", "vs Right-Handed Pitcher"), ("vl", "vs Left-Handed Pitcher")],
    "inning": [(f"i{i}", f"Inning {i}") for i in range(1, 10)] + [("ie", "Extra Innings")],
}
LEADER_CATEGORIES = [
    "assists", "shutouts", "homeRuns", "sacrificeBunts", "sacrificeFlies", "runs",
    "groundoutToFlyoutRatio", "stolenBases", "battingAverage", "groundOuts", "numberOfPitches",
    "onBasePercentage", "caughtStealing", "groundIntoDoublePlays", "totalBases", "earnedRunAverage",
    "fieldingPercentage", "walksAndHitsPerInningPitched", "flyouts", "hitByPitches", "gamesPlayed",
    "walks", "sluggingPercentage", "onBasePlusSlugging", "runsBattedIn", "triples", "extraBaseHits",
    "hits", "atBats", "strikeouts", "doubles", "totalPlateAppearances", "intentionalWalks", "wins",
    "losses", "saves", "wildPitch", "airOuts", "balk", "blownSaves", "catcherEarnedRunAverage",
    "catchersInterference", "chances", "completeGames", "doublePlays", "earnedRun", "errors",
    "gamesFinished", "gamesStarted", "hitBatsman", "hitsPer9Inn", "holds", "innings", "inningsPitched",
    "outfieldAssists", "passedBalls", "pickoffs", "pitchesPerInning", "putOuts", "rangeFactorPerGame",
    "rangeFactorPer9Inn", "saveOpportunities", "stolenBasePercentage", "strikeoutsPer9Inn",
    "strikeoutWalkRatio", "throwingErrors", "totalBattersFaced", "triplePlays", "walksPer9Inn",
    "winPercentage",
]
# spelling, id; nicknames first, then full market names
TEAM_IDS = [
    ("Angels", 108), ("Astros", 117), ("Athletics", 133), ("Blue Jays", 141),
    ("Brewers", 158), ("Braves", 144), ("Cardinals", 138), ("Cubs", 112), ("Dodgers", 119),
    ("Giants", 137), ("Mariners", 136), ("Mets", 121), ("Phillies", 143), ("Rangers", 140),
    ("Reds", 113), ("Orioles", 110), ("Red Sox", 111), ("White Sox", 145),
    ("Guardians", 114), ("Tigers", 116), ("Twins", 142), ("Yankees", 147), ("D-backs", 109),
    ("Diamondbacks", 109), ("Rockies", 115), ("Padres", 135), ("Marlins", 146),
    ("Nationals", 120), ("Pirates", 134), ("Rays", 139), ("Royals", 118),
    ("Los Angeles Angels", 108), ("Houston Astros", 117), ("Oakland Athletics", 133),
    ("Toronto Blue Jays", 141), ("Milwaukee Brewers", 158), ("Atlanta Braves", 144),
    ("St. Louis Cardinals", 138), ("Chicago Cubs", 112), ("Los Angeles Dodgers", 119),
    ("San Francisco Giants", 137), ("Seattle Mariners", 136), ("New York Mets", 121),
    ("Philadelphia Phillies", 143), ("Texas Rangers", 140), ("Cincinnati Reds", 113),
    ("Baltimore Orioles", 110), ("Boston Red Sox", 111), ("Chicago White Sox", 145),
    ("Cleveland Guardians", 114), ("Detroit Tigers", 116), ("Minnesota Twins", 142),
    ("New York Yankees", 147), ("Arizona Diamondbacks", 109), ("Colorado Rockies", 115),
    ("San Diego Padres", 135), ("Miami Marlins", 146), ("Washington Nationals", 120),
    ("Pittsburgh Pirates", 134), ("Tampa Bay Rays", 139), ("Kansas City Royals", 118),
]
TEAM_ABBREVS = [
    ("LAA", 108), ("HOU", 117), ("OAK", 133), ("ATH", 133), ("TOR", 141), ("MIL", 158),
    ("ATL", 144), ("STL", 138), ("CHC", 112), ("LAD", 119), ("SF", 137), ("SFG", 137),
    ("SEA", 136), ("NYM", 121), ("PHI", 143), ("TEX", 140), ("CIN", 113), ("BAL", 110),
    ("BOS", 111), ("CWS", 145), ("CHW", 145), ("CLE", 114), ("DET", 116), ("MIN", 142),
    ("NYY", 147), ("ARI", 109), ("AZ", 109), ("COL", 115), ("SD", 135), ("SDP", 135),
    ("MIA", 146), ("WSH", 120), ("WAS", 120), ("PIT", 134), ("TB", 139), ("TBR", 139),
    ("KC", 118), ("KCR", 118),
]
LEAGUES = [
    (103, "American League"),
    (104, "National League"),
    (114, "Cactus League"),
    (115, "Grapefruit League"),
]
DIVISIONS = [
    (200, "AL West", "ALW"),
    (201, "AL East", "ALE"),
    (202, "AL Central", "ALC"),
    (203, "NL West", "NLW"),
    (204, "NL East", "NLE"),
    (205, "NL Central", "NLC"),
]
EVENT_GROUPS = {
    "hits": ["single", "double", "triple", "home_run"],
    "outs": [
        "field_out", "strikeout", "force_out", "grounded_into_double_play", "double_play",
        "fielders_choice", "fielders_choice_out", "strikeout_double_play", "triple_play",
        "strikeout_triple_play", "grounded_into_triple_play", "sac_fly", "sac_bunt",
        "sac_fly_double_play", "sac_bunt_double_play",
    ],
    "walks_hbp": ["walk", "intent_walk", "hit_by_pitch"],
    "errors": ["field_error", "error"],
    "baserunning": [
        "stolen_base_2b", "stolen_base_3b", "stolen_base_home", "caught_stealing_2b",
        "caught_stealing_3b", "caught_stealing_home", "pickoff_1b", "pickoff_2b", "pickoff_3b",
        "pickoff_error_1b", "pickoff_error_2b", "pickoff_error_3b", "pickoff_caught_stealing_2b",
        "pickoff_caught_stealing_3b", "pickoff_caught_stealing_home", "wild_pitch", "passed_ball",
        "balk", "other_advance", "runner_double_play",
    ],
    "other": [
        "game_advisory", "catcher_interf", "fan_interference", "batter_interference",
        "pitcher_step_off", "batter_timeout", "mound_visit", "no_pitch", "other_out", "ejection",
    ],
}
TRANSACTIONS = [
    ("TR", "Trade"),
    ("SGN", "Signed"),
    ("SFA", "Signed as Free Agent"),
    ("DES", "Designated for Assignment"),
    ("DFA", "Declared Free Agency"),
    ("REL", "Released"),
    ("OPT", "Optioned"),
    ("CU", "Recalled"),
    ("CLW", "Claimed Off Waivers"),
    ("PUR", "Purchase"),
    ("DR", "Drafted"),
    ("R5", "Rule 5 Selection"),
    ("RET", "Retired"),
    ("SC", "Status Change"),
    ("ASG", "Assigned"),
    ("OUT", "Outrighted"),
    ("WA", "Waived"),
    ("RE", "Reinstated"),
    ("SU", "Suspension"),
    ("NC", "New Contract"),
    ("NUM", "Number Change"),
]
# name, group, unit
METRICS = [
    ("releaseSpinRate", "pitching", "RPM"),
    ("releaseExtension", "pitching", "FT"),
    ("releaseSpeed", "pitching", "MPH"),
    ("effectiveSpeed", "pitching", "MPH"),
    ("deliveryTime", "pitching", "SEC"),
    ("launchSpeed", "hitting,pitching", "MPH"),
    ("launchAngle", "hitting,pitching", "DEG"),
    ("generatedSpeed", "hitting,pitching", "MPH"),
    ("distance", "hitting", "FT"),
    ("travelDistance", "hitting", "FT"),
    ("hrDistance", "hitting", "FT"),
    ("maxHeight", "hitting", "FT"),
    ("travelTime", "hitting", "SEC"),
    ("hangTime", "hitting", "SEC"),
    ("launchSpinRate", "hitting", "RPM"),
    ("barreledBall", "hitting", "String"),
    ("hitTrajectory", "hitting", "String"),
    ("homeRunXBallparks", "hitting", "FT"),
]
TRAJECTORIES = [
    "ground_ball", "line_drive", "fly_ball", "popup", "bunt_grounder", "bunt_popup", "bunt_line_drive",
]
WINDS = [
    "Calm", "In From CF", "In From LF", "In From RF", "L To R", "R To L", "Out To CF",
    "Out To LF", "Out To RF", "None", "Varies",
]
SKIES = [
    "Clear", "Cloudy", "Dome", "Drizzle", "Overcast", "Partly Cloudy", "Rain", "Roof Closed",
    "Snow", "Sunny",
]
# code, abstract, detailed
GAME_STATUSES = [
    ("S", "Preview", "Scheduled"),
    ("P", "Preview", "Pre-Game"),
    ("PW", "Live", "Warmup"),
    ("I", "Live", "In Progress"),
    ("F", "Final", "Final"),
    ("FT", "Final", "Final: Tied"),
    ("FR", "Final", "Final: Completed Early: Rain"),
    ("FG", "Final", "Final: Game Over"),
    ("DR", "Preview", "Postponed: Rain"),
    ("DI", "Preview", "Postponed"),
]
SCHEDULE_EVENTS = [
    ("A", "All-Star Weekend Event"),
    ("T", "Team Event"),
    ("E", "Exhibition"),
    ("Z", "Postseason Games"),
    ("Y", "Spring Training Games"),
    ("W", "Pitchers & Catchers Report"),
    ("X", "Full Squad Reports"),
    ("B", "Ballpark Tours"),
    ("D", "Tracking Data Events"),
    ("O", "Other"),
    ("C", "Cultural Events"),
    ("F", "Festival"),
    ("K", "Kids & Family"),
    ("M", "Music"),
]

# --------------------------------------------------------------------------------------
# Tables by name: rows plus column names
# --------------------------------------------------------------------------------------

PAIR = ("code", "label")


def _plain(names: list[str]) -> list[tuple[str, str]]:
    return [(n, n) for n in names]


PITCH_SIDE = {
    "pitch_types": (PITCH_TYPES, PAIR),
    "pa_results": (PA_RESULTS, PAIR),
    "pitch_results": (PITCH_RESULTS, PAIR),
    "batted_balls": (BATTED_BALLS, PAIR),
    "contact_quality": (CONTACT_QUALITY, PAIR),
    "runners_on": (RUNNERS_ON, PAIR),
    "game_types": (GAME_TYPES, PAIR),
    "positions": (POSITIONS, PAIR),
    "teams": ([t[:3] for t in TEAMS], ("code", "label", "city")),
    "pitch_words": (PITCH_WORDS, ("word", "code")),
    "hand_words": (HAND_WORDS, ("word", "code")),
}
API_SIDE = {
    "sports": ([(str(i), n, c, a) for i, c, n, a in SPORTS], ("code", "label", "slug", "abbrev")),
    "game_types": (API_GAME_TYPES, PAIR),
    "stat_types": (_plain(STAT_TYPES), PAIR),
    "stat_groups": (_plain(STAT_GROUPS), PAIR),
    "roster_types": (ROSTER_TYPES, PAIR),
    "standings_types": (_plain(STANDINGS_TYPES), PAIR),
    "positions": ([(c, n, a, t) for c, a, n, t in API_POSITIONS], ("code", "label", "abbrev", "type")),
    "pitch_types": (API_PITCH_TYPES, PAIR),
    "situations": (
        [(code, label, fam) for fam, rows in SITUATIONS.items() for code, label in rows],
        ("code", "label", "family"),
    ),
    "leader_categories": (_plain(LEADER_CATEGORIES), PAIR),
    "team_ids": ([(n, str(i)) for n, i in TEAM_IDS], PAIR),
    "team_abbrevs": ([(n, str(i)) for n, i in TEAM_ABBREVS], PAIR),
    "leagues": ([(str(i), n) for i, n in LEAGUES], PAIR),
    "divisions": ([(str(i), n, a) for i, n, a in DIVISIONS], ("code", "label", "abbrev")),
    "event_types": (
        [(e, e, g) for g, events in EVENT_GROUPS.items() for e in events],
        ("code", "label", "family"),
    ),
    "transactions": (TRANSACTIONS, PAIR),
    "metrics": ([(n, n, g, u) for n, g, u in METRICS], ("code", "label", "group", "unit")),
    "trajectories": (_plain(TRAJECTORIES), PAIR),
    "winds": (_plain(WINDS), PAIR),
    "skies": (_plain(SKIES), PAIR),
    "game_statuses": ([(c, d, a) for c, a, d in GAME_STATUSES], ("code", "label", "abstract")),
    "schedule_events": (SCHEDULE_EVENTS, PAIR),
}
NAMESPACES = {"pitch": PITCH_SIDE, "api": API_SIDE}


def fixed_frame(spark: SparkSession, rows: list[tuple], names: tuple[str, ...]) -> DataFrame:
    """A driver-built table of constants; Arrow input makes it a local relation in the plan."""
    table = pa.table({n: [r[i] for r in rows] for i, n in enumerate(names)})
    return spark.createDataFrame(table)


def code_table(spark: SparkSession, name: str, side: str = "pitch") -> DataFrame:
    """One fixed code table, marked for broadcast."""
    tables = NAMESPACES[side]
    if name not in tables:
        raise ValueError(f"unknown {side} code table {name!r}; have {sorted(tables)}")
    rows, names = tables[name]
    return F.broadcast(fixed_frame(spark, rows, names))
