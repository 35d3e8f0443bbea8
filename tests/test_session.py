from silverline import session


def test_scratch_lies_in_the_configured_checkpoint_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    first, second = (session.scratch_path(spark, "x") for _ in range(2))
    assert first != second
    if root:
        assert first.startswith(root)


def test_materialised_rows_are_read_back(spark):
    df = session.materialise(spark.range(10).selectExpr("id", "rand() as r"), "t")
    assert df.collect() == df.collect()
    assert df.count() == 10
