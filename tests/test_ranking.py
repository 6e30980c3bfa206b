from tallyloom.operators import ranking
from tests.support.plans import plan

ROWS = [("a", 1, 5.0), ("a", 2, 9.0), ("a", 3, 9.0), ("a", 4, 1.0), ("b", 7, 2.0)]


def test_ties_go_to_the_lower_id_and_short_groups_are_whole(spark):
    df = spark.createDataFrame(ROWS, "g string, id int, score double")
    out = ranking.top_per_group(df, ["g"], "score", "id", 3)
    assert sorted((r.g, r["rank"], r.id) for r in out.collect()) == [
        ("a", 1, 2), ("a", 2, 3), ("a", 3, 1), ("b", 1, 7)]


def test_groups_are_cut_before_the_shuffle(spark):
    df = spark.createDataFrame(ROWS, "g string, id int, score double").repartition(3)
    text = plan(ranking.top_per_group(df, ["g"], "score", "id", 2))
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text


def test_top_k(spark):
    df = spark.createDataFrame(ROWS, "g string, id int, score double")
    out = ranking.top_k(df, "score", "id", 2)
    assert [r.id for r in out.collect()] == [2, 3]
    assert "TakeOrderedAndProject" in plan(out)
