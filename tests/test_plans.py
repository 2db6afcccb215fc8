"""Physical-plan checks: filters reach the parquet scan, no cartesian joins, no
Python in the hot path."""

from gridcast.operators.aggregate import team_game_stats
from gridcast.operators.silver import clean_plays
from gridcast.plans.gold import GoldOptions, build_gold
from tests.fixtures import bronze_plays


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_pushed_to_scan_and_no_cartesian(spark, tmp_dir):
    bronze_plays(spark).write.parquet(f"{tmp_dir}/bronze")
    bronze = spark.read.parquet(f"{tmp_dir}/bronze")
    silver = clean_plays(bronze, dedupe_order=("epa",))
    plan = _plan(silver)
    assert "PushedFilters: [In(play_type" in plan            # play-type filter reaches the scan
    assert "HashAggregate" in _plan(team_game_stats(silver))
    gold_plan = _plan(build_gold(silver, None, GoldOptions(strategy="window")))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in gold_plan


def test_registered_plans_shuffle_by_no_hand(spark):
    """No explicit repartition in front of a partial aggregate, no all-pairs join and no
    Python in the registered plans over plays."""
    from gridcast.plans import registry
    sf = "/root/testdata/sf0.001"
    for name in ("plays_clean", "latest_team_game", "gold_game_features"):
        plan = _plan(registry.QUERIES[name](spark, sf))
        for bad in ("REPARTITION_BY_COL", "CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython"):
            assert bad not in plan, (name, bad)


def _scans(df, what="Scan parquet") -> int:
    return _plan(df).split("== Initial Plan ==")[-1].count(what)


def test_plans_over_plays_hold_one_lineage(spark):
    """The plays are read by the aggregate that is written first; what is planned on it
    reads that table (form, gold) or a row per team (matchups), and the odds."""
    from gridcast.plans import registry
    sf = "/root/testdata/sf0.001"
    for name, most in (("rolling_offense", 2), ("rolling_scan_strategy", 4), ("gold_game_features", 12), ("latest_team_game", 1),
                       ("matchup_features_own", 14), ("market_edges", 14)):
        df = registry.QUERIES[name](spark, sf)
        assert 0 < _scans(df) <= most and "lineitem" not in _plan(df), name
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin"):
            assert bad not in _plan(df), name


def test_rollup_gives_both_aggregates(spark):
    """Games and team-games from the one rollup are those of the plays themselves."""
    from gridcast.operators.aggregate import game_base, game_base_of, play_rollup, team_games_of
    silver = clean_plays(bronze_plays(spark), dedupe_order=("epa",)).cache()
    rollup = play_rollup(silver)
    for a, b in ((game_base(silver), game_base_of(rollup)), (team_game_stats(silver), team_games_of(rollup))):
        assert a.columns == b.columns and sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_plays_stay_where_they_met_their_games(spark):
    """The de-duplication needs no second shuffle of the plays, and the second entity's
    chunks do not work out the first one's form again."""
    import re

    from gridcast.plans import registry
    sf = "/root/testdata/sf0.001"
    plan = _plan(registry.QUERIES["plays_clean"](spark, sf))
    assert re.search(r"hashpartitioning\(_game#", plan) and not re.search(r"hashpartitioning\(game_id#\d+, play_id#", plan)
    assert _scans(registry.QUERIES["rolling_scan_strategy"](spark, sf)) <= 3


def test_bucketed_tables_move_no_row_by_their_key(spark):
    """What groups a rollup by game finds its rows together: games and team-games need no
    exchange, a bucket is one file, and the rows are those that were written."""
    from gridcast.operators.aggregate import game_base_of, play_rollup, team_games_of
    from gridcast.session import materialize
    rollup = play_rollup(clean_plays(bronze_plays(spark), dedupe_order=("epa",)))
    written = materialize(rollup, "rollup", by="game_id")
    assert written.columns == rollup.columns and sorted(map(str, written.collect())) == sorted(map(str, rollup.collect()))
    for df in (game_base_of(written), team_games_of(written), game_base_of(written).join(team_games_of(written), "game_id")):
        assert "Exchange hashpartitioning" not in _plan(df)
    many = materialize(spark.range(5000).selectExpr("cast(id % 500 as string) as k", "id").repartition(7), "many", by="k")
    assert len(many.inputFiles()) <= int(spark.conf.get("spark.sql.shuffle.partitions")) and many.count() == 5000


def test_gold_moves_no_averages_between_entities(spark):
    """No pass of the trailing form shuffles another's averages, games keep their place, and
    the odds, whose size is known, are not shuffled against the games."""
    import re

    from gridcast.plans import registry
    plan = _plan(registry.QUERIES["gold_game_features"](spark, "/root/testdata/sf0.001")).split("== Initial Plan ==")[-1]
    assert not re.search(r"hashpartitioning\(season", plan)
    assert len(re.findall(r"hashpartitioning\(game_id", plan)) == 2    # a pivot of each entity
    assert len(re.findall(r"hashpartitioning\(_chunk", plan)) == 4     # rows and chunk ends of each


def test_rows_of_the_scan_move_what_is_told_once(spark):
    """Keys that the chunk holds and whole-number values are restored after the shuffle, also
    where the order needs them."""
    from gridcast.operators.rolling import add_trailing_avg
    rows = [(f"g{i}", 2020 + i % 2, i % 5, f"T{i % 3}", f"T{(i + 1) % 3}", i * 3 % 7, i * 5 % 11, i % 4, i % 6, float(i % 5) / 4) for i in range(120)]
    tg = spark.createDataFrame(rows, "game_id string, season int, week int, posteam string, defteam string, team_plays int, pass_yds int, "
                                     "rush_yds int, off_final_points_scored int, off_epa_avg double")
    for order in (("week", "game_id"), ("week", "team_plays", "game_id")):
        scan, window = (add_trailing_avg(tg, order=order, strategy=s) for s in ("scan", "window"))
        assert scan.dtypes == window.dtypes and sorted(map(str, scan.collect())) == sorted(map(str, window.collect()))


def test_chosen_games_are_those_of_whole_gold(spark):
    """Gold of the teams' latest games alone has the rows of whole gold, form from all games
    included, and so the same latest games; the pivot then moves only their rows."""
    from gridcast.operators.scoring import latest_team_game
    from gridcast.plans import registry
    from gridcast.plans.registry import silver_odds, silver_plays
    sf = "/root/testdata/sf0.001"
    whole = registry.gold(spark, sf)
    few = build_gold(silver_plays(spark, sf), silver_odds(spark, sf), choose=latest_team_game)
    a, b = ({str(r) for r in latest_team_game(g).collect()} for g in (whole, few))
    assert a == b and len(a) > 1
    assert {str(r) for r in few.collect()} < {str(r) for r in whole.collect()}
    assert _plan(few).split("== Initial Plan ==")[-1].count("LeftSemi") == 3


def test_rows_and_chunks_of_an_entity_read_one_shuffle(spark):
    """The trailing form moves the rows of an entity once; its chunks are read from there."""
    from gridcast.plans import registry
    for name, entities in (("rolling_offense", 1), ("side_pivot_own", 2), ("side_pivot_as_row", 2)):
        df = registry.QUERIES[name](spark, "/root/testdata/sf0.001")
        df.collect()
        assert _plan(df).split("== Initial Plan ==")[0].count("ReusedExchange") == entities, name


def test_bronze_csv_works_its_table_out_once(spark, tmp_dir):
    """Both column orders are written from one reading of the table."""
    from gridcast.plans import registry
    from gridcast.sources.files import read_headed_csv
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    rows = [("1997", "a", "x"), ("1998", "b", "y"), ("1999", None, "z")]
    df = spark.createDataFrame(rows, "season string, p string, q string")
    registry._write_csv_by_season(df.mapInArrow(count, df.schema), f"{tmp_dir}/csv", "season")
    assert seen.value == 3
    got = read_headed_csv(spark, [f"{tmp_dir}/csv"]).select("season", "p", "q").collect()
    assert sorted(got, key=str) == sorted([("1997", "a", "x"), ("1998", "b", "y"), ("1999", None, "z")], key=str) and len(got) == 3


def test_the_pivot_asks_rows_for_flags(spark):
    """The trailing form moves whose side a row is, not the teams; flags give the same pivot."""
    import re

    from gridcast import schemas
    from gridcast.operators.reshape import DEFENSE_SIDES, side_pivot, side_rows
    from gridcast.operators.rolling import team_form
    from gridcast.plans import registry
    sf = "/root/testdata/sf0.001"
    for name in ("side_pivot_own", "side_pivot_as_row", "gold_game_features"):
        moved = re.findall(r"Project \[([^\n]*AS _chunk#[^\n]*)\]", _plan(registry.QUERIES[name](spark, sf)).split("== Initial Plan ==")[-1])
        assert len(moved) >= 2, name
        for columns in moved:
            assert "_home_row" in columns and not re.search(r"(^|, )(home_team|away_team)#\d+(,|$)", columns), name
    form = team_form(registry.team_games(spark, sf)).cache()
    for side in DEFENSE_SIDES:
        for entity, metrics in (("posteam", schemas.OFFENSE_METRICS), ("defteam", schemas.DEFENSE_METRICS)):
            flagged = form.withColumns(side_rows(entity, side)).drop("home_team", "away_team", "posteam", "defteam")
            a, b = side_pivot(form, metrics, side), side_pivot(flagged, metrics, side)
            assert a.columns == b.columns and sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_bronze_csv_leaves_only_compressed_files(spark, tmp_dir, monkeypatch):
    """The table behind the files goes when they are there, files are compressed and of
    bounded rows, no task sorts by season, and any number of seasons is written whole."""
    from gridcast.plans import registry
    from gridcast.sources.files import list_files, path_exists, read_headed_csv
    tables, own = [], registry._own_folder
    monkeypatch.setattr(registry, "_own_folder", lambda *a: tables.append(own(*a)) or tables[-1])
    rows = [(str(1990 + i % 9), f"a{i}", None if i % 5 == 0 else f'x,"{i}') for i in range(200)]
    df = spark.createDataFrame(rows, "season string, p string, q string").coalesce(2)
    confs = ("spark.sql.maxConcurrentOutputFileWriters", "spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    before = [spark.conf.get(c, None) for c in confs]
    for seasons in (64, 2):
        monkeypatch.setattr(registry, "SEASONS_OPEN", seasons)
        monkeypatch.setattr(registry, "ROWS_A_FILE", 7)
        path = f"{tmp_dir}/csv{seasons}"
        registry._write_csv_by_season(df, path, "season")
        files = list_files(spark, [path])
        assert all(f.endswith(".csv.lz4") for f in files) and len(files) >= 9 * 4
        got = read_headed_csv(spark, [path]).select("season", "p", "q").collect()
        assert sorted(map(tuple, got), key=str) == sorted(rows, key=str)
    assert len(tables) == 2 and not any(path_exists(spark, t) for t in tables)
    assert [spark.conf.get(c, None) for c in confs] == before
