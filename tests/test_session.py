import os

from fieldatlas.session import default_parallelism, materialize, release_tables, scratch_path, shared_dir


def test_shared_folder_is_stable_and_scratch_paths_unique(spark):
    base = shared_dir(spark)
    assert base == shared_dir(spark)
    a, b = scratch_path(spark, "t"), scratch_path(spark, "t")
    assert a != b and a.startswith(base + "/fieldatlas/t-") and b.startswith(base + "/fieldatlas/t-")
    assert default_parallelism(spark) >= 1


def test_scratch_tables_are_released(spark):
    one, two = materialize(spark.range(3), "one"), materialize(spark.range(4), "two")
    paths = [os.path.dirname(df.inputFiles()[0]).removeprefix("file://").removeprefix("file:") for df in (one, two)]
    assert one.count() == 3 and all(map(os.path.isdir, paths))
    base = shared_dir(spark)
    first = next(p for p in (f"{base}/fieldatlas/{os.path.basename(paths[0])}",))
    assert release_tables(spark, first) == 1
    assert not os.path.exists(paths[0]) and os.path.isdir(paths[1])
    assert release_tables(spark) >= 1
    assert not os.path.exists(paths[1]) and release_tables(spark) == 0
