"""Star rounds on few edges do not open a task, and files, for every shuffle partition."""

from corpusmill.llm import simhash


def test_tasks_of_a_round_go_by_its_edges(spark):
    hot = {"spark.sql.shuffle.partitions": "211", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in hot}
    edges = [(3, 2), (2, 9), (9, 7), (20, 21), (21, 22), (22, 20)]
    df = spark.createDataFrame(edges, "a long, b long")
    try:
        for k, v in hot.items():
            spark.conf.set(k, v)
        found = simhash.components(df)
        got = {r["node"]: r["root"] for r in found.collect()}
        assert found.rdd.getNumPartitions() <= 2 * simhash.LEAST_TASKS
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got == {2: 2, 3: 2, 7: 2, 9: 2, 20: 20, 21: 20, 22: 20}
