import pytest

from tidemark import session


class FakeContext:
    def __init__(self, master):
        self.master, self.folder = master, None
        outer = self

        class Scala:
            def getCheckpointDir(self):
                return self

            def isDefined(self):
                return outer.folder is not None

        self._jsc = type("J", (), {"sc": lambda _: Scala()})()

    def setCheckpointDir(self, folder):
        self.folder = folder


class FakeSession:
    def __init__(self, master, **conf):
        self.sparkContext = FakeContext(master)
        self.conf = type("C", (), {"get": lambda _, key, default=None: conf.get(key, default)})()


def test_cluster_folder_is_used():
    fake = FakeSession("spark://host:7077", **{"spark.checkpoint.dir": "hdfs:///shared"})
    session.ensure_checkpoint_dir(fake)
    assert fake.sparkContext.folder == "hdfs:///shared"


def test_no_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(FakeSession("yarn"))


def test_local_mode_gets_its_own_folder():
    fake = FakeSession("local[4]")
    session.ensure_checkpoint_dir(fake)
    assert fake.sparkContext.folder


def test_cut_lineage_keeps_rows(spark):
    assert sorted(r[0] for r in session.cut_lineage(spark.range(5)).collect()) == list(range(5))
