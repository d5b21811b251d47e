from pyspark.sql import functions as F

from tripflow.llm import mixing
from tripflow.llm.mixing import mix_sources


def test_a_cell_without_tokens_does_not_lower_the_draw(spark):
    rows = [(i, "w " * 100, "en", "big") for i in range(200)] + [(1000, "w " * 50, "en", "rare"), (1001, "w " * 50, "de", "big")]
    schema = "doc_id long, text string, lang string, source string"
    alpha = {"source": 0.7, "lang": 0.7, "topic": 1.0}

    def drawn(more):
        got = mix_sources(spark.createDataFrame(rows + more, schema), F.lit("t"), alpha).collect()
        return {r["doc_id"]: r["probability"] for r in got}

    plain, with_empty = drawn([]), drawn([(2000, "", "de", "rare")])
    assert with_empty.pop(2000) == 1.0
    assert with_empty == plain and max(plain.values()) == 1.0


def test_a_sweep_joins_the_table_of_cells_once_a_dimension(spark, monkeypatch):
    plans, write = [], mixing.saved

    def noted(df, kind):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString().count("Join "))
        return write(df, kind)

    monkeypatch.setattr(mixing, "saved", noted)
    cells = spark.createDataFrame([("a", "en", "x", 10), ("a", "de", "x", 30), ("b", "en", "x", 60), ("c", "en", "y", 0)],
                                  "source string, lang string, topic string, tokens long")
    targets = {d: spark.createDataFrame(rows, f"{d} string, target double") for d, rows in {
        "source": [("a", 0.5), ("b", 0.5)], "lang": [("en", 0.6), ("de", 0.4)], "topic": [("x", 1.0), ("none", 0.0)]}.items()}
    out = mixing.rake(cells, targets)
    assert out.columns == ["source", "lang", "topic", "tokens", "factor"]
    got = {(r["source"], r["lang"]): r["tokens"] * r["factor"] for r in out.collect()}
    assert abs(got["a", "de"] - 0.4) < 1e-6 and abs(got["b", "en"] - 0.5) < 1e-6 and got["c", "en"] == 0
    assert plans[0] == 3 and set(plans[1:]) == {1}
