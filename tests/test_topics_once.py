"""Texts of topic models are made once."""

from agorascope.operators import topics


def test_texts_are_read_once_for_all_periods(spark):
    read = spark.sparkContext.accumulator(0)

    def counting(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    rows = [(i, ("before", "after")[i % 2], f"tree leaf word{i % 3} sound music{i % 5}" if i % 4 else "river water boat") for i in range(120)]
    texts = spark.createDataFrame(rows, "key int, period string, text string").repartition(3)
    fitted = topics.fit_topics(texts.mapInArrow(counting, texts.schema), ["before", "after", "never"], k=2, iterations=3, train=0.8)
    assert read.value == 120
    assert [t.documents + t.held_out for t in fitted] == [60, 60, 0] and fitted[2].vocabulary == []
    assert all(t.log_perplexity is not None for t in fitted[:2])
    assert not spark.sparkContext._jsc.getPersistentRDDs()
