"""Components and the tables that they write."""

from attestor.llm.components import components
from attestor.llm.scratch import materialize


def test_components_make_their_edges_once(spark):
    made = spark.sparkContext.accumulator(0)

    def edges(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    pairs = [(1, 2), (2, 3), (3, 9), (5, 4), (6, 6), (8, 7), (7, 8), (7, 8)]
    df = spark.createDataFrame(pairs, "a long, b long").mapInArrow(edges, "a long, b long")
    found = {r.node: r.label for r in components(df).collect()}
    assert found == {1: 1, 2: 1, 3: 1, 9: 1, 4: 4, 5: 4, 7: 7, 8: 7}
    assert made.value == len(pairs)


def test_few_rows_are_written_by_few_tasks(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        few = materialize(spark.range(1000).groupBy("id").count(), "few", 1000)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert few.count() == 1000
    assert len(few.inputFiles()) <= spark.sparkContext.defaultParallelism
