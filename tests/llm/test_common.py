from tallyforge.llm import common


def test_salted_join_is_the_join(spark, monkeypatch):
    rows = [(i % 3 if i % 2 else i, i) for i in range(400)] + [(None, 1000)]
    left = common.written(spark.createDataFrame(rows, "k long, v long"), "t")
    right = spark.createDataFrame([(k, k * 10) for k in range(0, 300, 3)], "k long, w long")
    want = {how: sorted(map(str, left.join(right, "k", how).collect())) for how in ("inner", "left")}
    for least in (10_000, 20):
        monkeypatch.setattr(common, "LEAST_HOT", least)
        hot = common.frequent_keys(left, ["k"])
        assert len(hot) == (0 if least == 10_000 else 3)  # 0, 1 and 2
        for how, rows in want.items():
            assert sorted(map(str, common.salted_join(left, right, ["k"], ["v"], how).collect())) == rows
    assert common.frequent_keys(left.limit(0), ["k"]) == []
    assert common.salted_join(left.limit(0), right, ["k"], ["v"]).count() == 0


def test_without(spark, monkeypatch):
    rows = spark.range(50).withColumnRenamed("id", "_row")
    losers = common.written(rows.filter("_row % 7 = 0"), "t")
    for bound in (100, 2):
        monkeypatch.setattr(common, "MOST_BROADCAST", bound)
        assert sorted(r[0] for r in common.without(rows, losers).collect()) == [i for i in range(50) if i % 7]


def test_written_tables_can_be_deleted(spark):
    import os

    a, b = (common.written(spark.range(3), "t") for _ in range(2))
    common.discard(a)
    assert not os.path.exists(a._stored) and b.count() == 3
    common.clean(spark)
    assert not os.path.exists(b._stored)


def test_sizes(spark, sf):
    docs = common.documents(spark, sf)
    assert common.stored_bytes(docs) > 100_000
    assert common.stored_bytes(spark.sparkContext.parallelize([("é",), (None,), ("ab",)]).toDF("text string")) == 4
    assert [common.block_size(x, 10, 100, 2.0) for x in (0, 400, 10**6)] == [10, 40, 100]
