from __future__ import annotations

from riskmart import session


def test_a_configured_session_leaves_the_given_one_alone(spark):
    before = spark.conf.get("spark.sql.ansi.enabled"), spark.conf.get("spark.sql.codegen.maxFields")
    spark.conf.set("spark.sql.codegen.maxFields", "77")
    try:
        own = session.configured(spark)
        assert own.conf.get("spark.sql.codegen.maxFields") == "32" and spark.conf.get("spark.sql.codegen.maxFields") == "77"
        assert own.conf.get("spark.sql.shuffle.partitions") == spark.conf.get("spark.sql.shuffle.partitions")
        assert own.conf.get("spark.sql.session.timeZone") == "UTC" and own.sparkContext is spark.sparkContext
    finally:
        spark.conf.set("spark.sql.codegen.maxFields", before[1])


def test_the_shared_folder_is_the_clusters(spark):
    assert spark.conf.get("spark.checkpoint.dir") == session.shared_folder(spark)
