from types import SimpleNamespace

import pytest

from chatterloom.session import SETTINGS, object_store_settings, scratch_path, stored


def _session(**conf):
    context = SimpleNamespace(master=conf.get("spark.master"), applicationId="test-app")
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: conf.get(key, default)), sparkContext=context
    )


def test_scratch_folder_is_the_shared_one():
    on_cluster = _session(**{"spark.checkpoint.dir": "s3a://shared/tmp/", "spark.master": "yarn"})
    assert scratch_path(on_cluster, "x").startswith("s3a://shared/tmp/chatterloom-test-app/x-")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_path(_session(**{"spark.master": "yarn"}), "x")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_path(_session(**{"spark.master": "local-cluster[2,1,1024]"}), "x")
    local = _session(**{"spark.master": "local[2]"})
    first, second = scratch_path(local, "x"), scratch_path(local, "y")
    assert first.startswith("/") and first.rsplit("/", 1)[0] == second.rsplit("/", 1)[0]


def test_stored_frames_are_deleted(spark, tmp_path):
    with stored(spark.range(3), "numbers") as kept:
        (file, *_) = kept.inputFiles()
        assert kept.count() == 3 and "numbers-" in file
        folder = file.removeprefix("file://").rsplit("/", 1)[0]
    with pytest.raises(Exception):
        spark.read.parquet(folder).count()


def test_settings(spark):
    assert all(spark.conf.get(k) == v for k, v in SETTINGS.items())
    s3 = object_store_settings("http://store:9000", "key", "secret")
    assert s3["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert s3["spark.hadoop.fs.s3a.endpoint"] == "http://store:9000"
