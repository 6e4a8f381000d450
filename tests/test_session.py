import pytest

from cadenza import session
from cadenza.sources import paths

KEY = "spark.sql.shuffle.partitions"


def test_shuffles_grow_with_the_input(spark):
    before = spark.conf.get(KEY)
    try:
        assert session.size_shuffles(spark, 0) == int(before)
        assert session.size_shuffles(spark, 100 * session.BYTES_PER_PARTITION + 1) == 101
        assert spark.conf.get(KEY) == "101"
        # Never lowered, and no ceiling: partitions of 256 MB at 100 TB too.
        assert session.size_shuffles(spark, 1) == 101
        assert session.size_shuffles(spark, 100 * 1024**4) == 409_600
    finally:
        spark.conf.set(KEY, before)


def test_a_foreign_session_is_set_to_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    session.prepare(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_shared_folder_comes_from_the_session(spark):
    assert session.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_folder_questions(spark, tmp_path):
    (tmp_path / "a").write_bytes(b"12345")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "b").write_bytes(b"678")
    root = str(tmp_path)
    assert paths.stored_bytes(spark, root) == 8
    assert paths.stored_bytes(spark, f"{root}/none") == 0
    assert [name for name, _, _ in paths.listing(spark, root)] == ["a"]
    assert paths.is_dir(spark, root) and not paths.is_dir(spark, f"{root}/a")


@pytest.mark.parametrize("name", ["queries", "oracle_sql"])
def test_every_query_has_its_counterpart(name):
    import __spark_entry__ as entry
    from cadenza.plans import oracles, registered

    assert set(registered.queries()) == set(oracles.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert getattr(entry, name)()
