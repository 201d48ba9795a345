"""Shared folders and staged results."""
import os
import shutil
from types import SimpleNamespace

import pytest

from sample_tables import SF0001
from otif.plans.registry import context
from otif.session import ensure_checkpoint_dir


def test_cluster_session_needs_a_shared_folder():
    sc = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    bare = SimpleNamespace(conf=SimpleNamespace(get=lambda name, default: default), sparkContext=sc)
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(bare)


def test_changed_input_is_staged_anew(spark, tmp_path):
    folder = str(tmp_path / "tables")
    shutil.copytree(SF0001, folder)
    first = context(spark, folder)
    assert context(spark, folder + "/") is first
    table = os.path.join(folder, "lineitem.parquet")
    for path in [table] if os.path.isfile(table) else [os.path.join(table, f) for f in os.listdir(table)]:
        os.utime(path, (1, 1))
    assert context(spark, folder) is not first
