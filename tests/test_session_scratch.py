"""The shared folder: named by the session, or a scratch folder of a local session."""

import pytest

from strata import session


class Fake:
    """A session with just what the helper looks at."""

    def __init__(self, master, folder=None):
        outer = self
        self.set_to = None

        class Context:
            applicationId = f"app-{master}-{folder}"

            def __init__(self):
                self.master = master

            def getCheckpointDir(self):
                return outer.set_to

            def setCheckpointDir(self, path):
                outer.set_to = path

        class Conf:
            def get(self, key, default=None):
                return folder or default

        self.sparkContext, self.conf = Context(), Conf()


def test_named_folder_is_used():
    spark = Fake("spark://host:7077", "hdfs://x/shared")
    assert session.ensure_checkpoint_dir(spark) == "hdfs://x/shared" == spark.set_to


def test_local_session_keeps_one_scratch_folder():
    spark = Fake("local[2]")
    first = session.ensure_checkpoint_dir(spark)
    assert first and session.ensure_checkpoint_dir(spark) == first == spark.set_to


def test_cluster_session_without_a_folder_is_refused():
    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(Fake("spark://host:7077"))
