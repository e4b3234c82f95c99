import os

import pytest

from rollcall import workspace


class _Session:
    """Only the settings a session would have."""

    def __init__(self, **settings):
        self.conf = self
        self._settings = settings
        self.sparkContext = type("Context", (), {"applicationId": "app-1"})

    def get(self, name, default=None):
        return self._settings.get(name, default)


def test_the_cluster_names_the_folder():
    session = _Session(**{"spark.master": "yarn", workspace.SETTING: "hdfs://shared/checkpoints/"})
    assert workspace.shared_folder(session) == "hdfs://shared/checkpoints"
    first, second = (workspace.new_folder(session, "x") for _ in range(2))
    assert first.startswith("hdfs://shared/checkpoints/rollcall/x-") and first != second


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(ValueError):
        workspace.shared_folder(_Session(**{"spark.master": "yarn"}))
    with pytest.raises(ValueError):
        workspace.shared_folder(_Session())


def test_local_mode_makes_one_folder():
    session = _Session(**{"spark.master": "local[2]"})
    folder = workspace.shared_folder(session)
    assert os.path.isdir(folder)
    assert workspace.shared_folder(session) == folder
