from arealens.session import POLICY, checkpoint_dir, use_policy

import __spark_entry__ as entry


def test_queries_leave_the_callers_settings_alone(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    try:
        entry.queries()["tagged_union"](spark, "/root/testdata/sf0.001")
        assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "10MB"
        use_policy(spark)  # on request only
        for k, v in POLICY.items():
            assert spark.conf.get(k) == v
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_checkpoint_dir_keeps_the_configured_folder(spark, scratch):
    current = spark.conf.get("spark.checkpoint.dir")
    assert current  # set once by the test session (conftest), as a cluster would
    assert checkpoint_dir(spark, fallback=scratch) == current
