import pytest

from tidecast import workspace
from tidecast.workspace import new_folder, workspace_root


class Session:
    def __init__(self, **settings):
        self.conf = self
        self.settings = {k.replace("_", "."): v for k, v in settings.items()}

    def get(self, name, default):
        return self.settings.get(name, default)


def test_the_named_folder_is_used():
    assert workspace_root(Session(spark_checkpoint_dir="hdfs:///shared/", spark_master="yarn")) == "hdfs:///shared"


def test_a_cluster_without_a_named_folder_is_refused():
    with pytest.raises(ValueError):
        workspace_root(Session(spark_master="yarn"))


def test_a_local_session_gets_one_temporary_folder(monkeypatch, tmp_path):
    monkeypatch.setattr(workspace, "_local_root", [])
    monkeypatch.setattr(workspace.tempfile, "mkdtemp", lambda prefix: str(tmp_path))
    local = Session(spark_master="local[2]")
    assert workspace_root(local) == workspace_root(local) == str(tmp_path)
    assert new_folder(local, "x") != new_folder(local, "x")
