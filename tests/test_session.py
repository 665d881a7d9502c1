"""Working folders: named by the session, never machine-local on a cluster."""

from __future__ import annotations

from types import SimpleNamespace

import pytest

from tradelake.session import SETTINGS, prepare, run_dir, shared_dir


class Conf(dict):
    def get(self, key, default=None):
        return dict.get(self, key, default)


def fake(master, conf=(), current=None):
    context = SimpleNamespace(master=master, dir=current)
    context.getCheckpointDir = lambda: context.dir
    context.setCheckpointDir = lambda path: setattr(context, "dir", path)
    return SimpleNamespace(sparkContext=context, conf=Conf(conf))


def test_the_named_folder_is_used():
    session = fake("spark://host:7077", {"spark.checkpoint.dir": "hdfs://lake/tmp/"})
    assert shared_dir(session) == "hdfs://lake/tmp/"
    assert session.sparkContext.dir == "hdfs://lake/tmp/"
    one, two = run_dir(session, "x"), run_dir(session, "x")
    assert one.startswith("hdfs://lake/tmp/x-") and one != two


def test_a_cluster_without_one_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(fake("yarn"))


def test_a_local_session_gets_its_own():
    session = fake("local[2]")
    assert shared_dir(session) == session.sparkContext.dir
    assert shared_dir(session) == shared_dir(session)


def test_settings_are_applied(spark):
    prepare(spark)
    assert all(spark.conf.get(key) == value for key, value in SETTINGS.items())
