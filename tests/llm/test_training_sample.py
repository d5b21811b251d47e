"""Rows that the classifier learns from, with repeated ids and label rows."""

from tripflow.llm import quality_model


def _frames(spark, parts, flip):
    docs = [(1, "one b"), (1, "one a"), (1, "one a"), (2, "two"), (3, "three"), (4, None), (None, "no id"), (6, "six")]
    marks = [(1, 1), (1, 1), (2, 0), (2, 1), (3, 0), (4, 1), (None, 1), (5, 0), (6, 7), (6, None)]
    if flip:
        docs, marks = docs[::-1], marks[::-1]
    return (spark.createDataFrame(docs, "doc_id long, text string").repartition(parts),
            spark.createDataFrame(marks, "doc_id long, label int").repartition(parts))


def test_sample_has_one_text_and_one_label_an_id(spark):
    for parts, flip in ((1, False), (5, True)):
        text, label = quality_model.training_sample(*_frames(spark, parts, flip))
        assert text.to_pylist() == ["one a", "three", None] and label.tolist() == [1, 0, 1]


def test_no_more_than_limit_rows_reach_the_driver(spark):
    docs = spark.range(600).selectExpr("id % 20 as doc_id", "'t' as text")
    marks = spark.range(20).selectExpr("id as doc_id", "cast(id % 2 as int) as label")
    text, label = quality_model.training_sample(docs, marks, limit=7)
    assert len(text) == len(label) == 7


def test_scores_do_not_depend_on_the_order_of_label_rows(spark):
    a, b = ({(r.doc_id, r.score) for r in quality_model.quality_scores(*_frames(spark, n, flip)).collect()}
            for n, flip in ((1, False), (4, True)))
    assert a == b and len({d for d, _ in a}) == 6
