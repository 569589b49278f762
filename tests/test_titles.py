"""Titles: three grammars, entities, products' parameters."""

import pytest
from pyspark.sql import functions as F

from ticktide.functions import titles


def read(spark, expression, *values):
    return spark.createDataFrame([values], ", ".join(f"c{i} string" for i in range(len(values)))).select(expression).first()[0]


@pytest.mark.parametrize(("title", "sides"), [
    ("Dota 2: A vs B", ["A", "B"]), ("A vs. B (BO3) - Group D", ["A", "B"]), ("A VS B - More Markets (best of 5): Map 2", ["A", "B"]), ("A v. B: Game Handicap: Total Maps", ["A", "B"]),
    ("League: A vs B", None), ("A vs B vs C", None), ("A - x vs B", ["A - x", "B"]), ("A vs ", None), (None, None), ("A &amp; Co versus B", ["A & Co", "B"]),
])
def test_series(spark, title, sides):
    assert read(spark, titles.series_sides(F.col("c0"), ("dota 2", "dota")), title) == sides


@pytest.mark.parametrize(("title", "sides"), [
    ("UEL, Benfica vs Hearts", ["Benfica", "Hearts"]), ("A, B and C", None), ("A v B: Both Teams to Score", ["A", "B"]), ("A @ B - Total Corners", ["A", "B"]), ("A vs B-C (x) - Group D", ["A", "B-C (x)"]), ("- A - vs B", ["A", "B"]), ("A vs B @ C", None),
])
def test_fixture(spark, title, sides):
    assert read(spark, titles.fixture_sides(F.col("c0")), title) == sides


def test_other_grammars(spark):
    assert read(spark, titles.prop_sides(F.col("c0")), "Real Madrid and Barcelona both to score?") == ["Real Madrid", "Barcelona"]
    assert read(spark, titles.prop_sides(F.col("c0")), "A and B win") is None
    assert read(spark, titles.pair_keys(F.col("c0"), "Dota 2"), "Dota 2: Team Spirit! vs. BB Team (BO5) - Finals") == ["bbteam", "teamspirit"]
    assert read(spark, titles.unescaped(F.col("c0")), "&amp;lt; &lt;&#39;") == "&lt; <'"


@pytest.mark.parametrize(("kind", "text", "labels", "want"), [
    ("total_goals", "3 or more goals", "", {"line": 2.5, "direction": "over", "published_line": 3}), ("total_goals", "Under O/U 2.5 (9)", "", {"line": 2.5, "direction": "under"}),
    ("spread", "Red Lions (-1.5)", "", {"line": -1.5, "line_style": "handicap", "side": "home"}), ("moneyline_3way", "Draw", "Draw", {"side": "draw"}), ("moneyline_3way", "winner?", "Blue", {"side": "away"}),
    ("moneyline_3way", "Red Lions or Blue", "Blue", {}), ("correct_score", "Exact: 2 - 1", "", {"home_goals": 2, "away_goals": 1}), ("map_winner", "Blue wins Map 3", "", {"side": "away", "map_index": 3}),
])
def test_parameters(spark, kind, text, labels, want):
    got = read(spark, titles.parameters(F.col("c0"), F.col("c1"), F.lit("Red Lions"), F.lit("Blue"), F.col("c2")), kind, text, labels)
    assert {k: v for k, v in got.asDict().items() if v is not None} == want
