from types import SimpleNamespace

import pytest

from hailstat.session import shared_folder


def session(master, folder=None):
    conf = SimpleNamespace(get=lambda key, default: folder or default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_shared_folder_lies_below_the_setting():
    first, second = (shared_folder(session("spark://host", "hdfs:///shared/"), "x") for _ in range(2))
    assert first.startswith("hdfs:///shared/x-") and first != second


def test_only_local_sessions_get_a_temporary_folder():
    one, two = (shared_folder(session("local[2]"), "x") for _ in range(2))
    assert one.rsplit("/", 1)[0] == two.rsplit("/", 1)[0]
    with pytest.raises(ValueError):
        shared_folder(session("spark://host"), "x")


def test_sessions_pin_utc(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
