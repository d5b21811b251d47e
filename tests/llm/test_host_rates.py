import pytest

from tripflow.llm.quality_rules import quality_rules

PROSE = " ".join(f"word{i}" for i in range(60))


@pytest.mark.parametrize("hot", [200, 400, 1600])
def test_a_hot_host_does_not_shield_itself(spark, hot):
    rows = [(i, PROSE if i % 10 == 0 else "too short", "hot") for i in range(hot)]
    rows += [(10_000 + i, "too short" if i % 20 == 0 else PROSE, f"good{i % 8}") for i in range(400)]
    got = quality_rules(spark.createDataFrame(rows, "doc_id long, text string, source string")).filter("kept").collect()
    assert {r["host"] for r in got} == {f"good{i}" for i in range(8)} and len(got) == 380


def test_hosts_alike_are_kept_and_a_lone_one_is_held_to_the_threshold(spark):
    rows = [(i, PROSE if i % 10 < 4 else "too short", f"h{i % 4 if i % 3 else 5}") for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert quality_rules(df).filter("kept").count() == 240
    lone = df.selectExpr("doc_id", "text", "'h' AS source")
    assert quality_rules(lone).filter("kept").count() == 0
