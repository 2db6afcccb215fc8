"""gridcast: game-level feature, model and forecast operators on Spark DataFrames.

Layers: bronze play-by-play and odds -> silver (typed, de-duplicated) -> gold
(one row per game with leak-free trailing form and market lines) -> Spark ML
models -> batch matchup scoring.  Every operator is a DataFrame -> DataFrame
function; only the jobs in ``gridcast.plans.jobs`` run actions.
"""

__version__ = "0.1.0"
