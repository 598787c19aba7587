from topictables.llm.common import connected_components


def test_long_path_hub_and_loops(spark):
    edges = [(i, i + 1) for i in range(20, 60)] + [(100, i) for i in range(101, 140)] + [(139, 140), (7, 7), (None, 3), (200, 199)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = dict(map(tuple, connected_components(df, "a", "b").collect()))
    assert got == {**{i: 20 for i in range(21, 61)}, **{i: 100 for i in range(101, 141)}, 200: 199}


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "a string, b string"), "a", "b").count() == 0
