from parcelflow.session import DEFAULT_CONF, ensure_checkpoint_dir


def test_checkpoint_dir_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = ensure_checkpoint_dir(spark)
    assert current
    if configured:
        assert configured.rstrip("/").split("/")[-1] in current
    # a second call keeps the same folder
    assert ensure_checkpoint_dir(spark) == current


def test_defaults_enable_adaptive_skew_handling():
    assert DEFAULT_CONF["spark.sql.adaptive.enabled"] == "true"
    assert DEFAULT_CONF["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert DEFAULT_CONF["spark.ui.enabled"] == "false"
