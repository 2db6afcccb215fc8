"""Tiny hand-written sports tables (F1-F3) with the edge cases the operators must handle."""

from gridcast import schemas

PLAY_COLS = [c for c in schemas.BRONZE_PLAY_COLUMNS]


def play(play_id, game_id, season, week, home, away, pos, dfn, ptype, yards, epa, hs, as_,
         season_type="REG", result="0", date=None, div="0", air="NA", yac="", wp="0.5"):
    date = date or f"{season}-09-{10 + int(week):02d}"
    return dict(play_id=play_id, game_id=game_id, game_date=date, season=str(season), week=str(week),
                season_type=season_type, home_team=home, away_team=away, posteam=pos, defteam=dfn,
                play_type=ptype, air_yards=air, yards_after_catch=yac, yards_gained=yards, epa=epa,
                total_home_score=hs, total_away_score=as_, div_game=div, result=result, wp=wp)


def bronze_plays(spark):
    rows = [
        # game 1 (2020 wk1): A home vs B; duplicate play 2; "5.0", "NA", "NaN", empty
        play("1", "g1", 2020, 1, "A", "B", "A", "B", "pass", "5.0", "0.25", "7", "0", result="3"),
        play("2", "g1", 2020, 1, "A", "B", "A", "B", "run", "3", "0.10", "7", "0", result="3"),
        play("2", "g1", 2020, 1, "A", "B", "A", "B", "run", "9", "0.90", "7", "0", result="3"),
        play("3", "g1", 2020, 1, "A", "B", "B", "A", "pass", "NA", "NaN", "10", "7", result="3"),
        play("4", "g1", 2020, 1, "A", "B", "B", "A", "rush", "", "-0.5", "10", "10", result="3"),
        play("5", "g1", 2020, 1, "A", "B", None, None, "kickoff", "0", "0", "10", "10", result="3"),
        play("6", "g1", 2020, 1, "A", "B", "A", "B", "punt", "40", "0.05", "13", "10", result="3"),
        # game 2 (2020 wk2): B home vs A, tie, null season_type; A never has the ball
        play("1", "g2", 2020, 2, "B", "A", "B", "A", "pass", "12", "0.3", "3", "3", season_type=None, result="0"),
        play("2", "g2", 2020, 2, "B", "A", "B", "A", "run", "4", "0.1", "3", "3", season_type=None, result="0"),
        # game 3 (2020 wk4, after a bye): A home vs C
        play("1", "g3", 2020, 4, "A", "C", "A", "C", "pass", "20", "0.5", "14", "0", result="7"),
        play("2", "g3", 2020, 4, "A", "C", "C", "A", "run", "2", "-0.2", "14", "7", result="7"),
        # game 4 (2021 wk1): new season resets the frames
        play("1", "g4", 2021, 1, "C", "A", "A", "C", "pass", "8", "0.4", "0", "3", result="-3"),
        play("2", "g4", 2021, 1, "C", "A", "C", "A", "run", "1", "0.0", "0", "3", result="-3"),
    ]
    return spark.createDataFrame([tuple(r[c] for c in PLAY_COLS) for r in rows], schemas.BRONZE_PLAYS)


def bronze_odds(spark):
    rows = [
        (2020, "1", "Team A", "Team B", "A", -3.5, "44"),
        (2020, "2", "Team B", "Team A", None, 1.0, " "),
        (2020, "Wildcard", "Team A", "Team C", "C", -2.0, "41.5"),
        (2020, "18", "Unknown Name", "Team A", "A", -1.0, "40"),
        (2019, "3", "Team A", "Team B", "A", -7.0, "50"),
    ]
    return spark.createDataFrame(rows, schemas.BRONZE_ODDS)


TEAM_MAP = {"Team A": "A", "Team B": "B", "Team C": "C"}
