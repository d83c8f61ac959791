import pytest

from autopulse import session


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)

    def set(self, key, value):  # Spark rejects core settings at run time
        raise AssertionError("must not set core settings")


class _Context:
    def __init__(self, ckpt=None):
        self.ckpt = ckpt

    def getCheckpointDir(self):
        return self.ckpt

    def setCheckpointDir(self, d):
        self.ckpt = f"file:{d}/0f0e"


class _Session:
    def __init__(self, conf, ckpt=None):
        self.conf = _Conf(conf)
        self.sparkContext = _Context(ckpt)


def test_scratch_root_prefers_the_cluster_setting():
    s = _Session({"spark.checkpoint.dir": "hdfs:///shared/ckpt/"})
    assert session.scratch_root(s) == "hdfs:///shared/ckpt"
    assert session.scratch_dir(s, "x").startswith("hdfs:///shared/ckpt/autopulse/x-")


def test_scratch_root_falls_back_to_a_local_checkpoint_dir_once():
    s = _Session({})
    first = session.scratch_root(s)
    assert first.startswith("file:") and session.scratch_root(s) == first


def test_cluster_settings_scale_with_input():
    small = session.cluster_settings(10 << 30)
    big = session.cluster_settings(100 << 40)
    assert small["spark.sql.shuffle.partitions"] == "200"
    assert int(big["spark.sql.shuffle.partitions"]) == (100 << 40) // (256 << 20)
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_public_api_imports():
    import autopulse.operators as ops
    import autopulse.sinks as sinks
    import autopulse.sources as sources
    assert all(hasattr(ops, n) for n in ops.__all__)
    assert callable(sinks.publish) and callable(sources.read_telemetry_csv)


def test_scratch_root_without_a_context_must_be_configured():
    class NoContext:
        conf = _Conf({})

        @property
        def sparkContext(self):
            raise RuntimeError("no SparkContext in this kind of session")

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_root(NoContext())
    shared = NoContext()
    shared.conf = _Conf({"spark.checkpoint.dir": "s3a://shared/x"})
    assert session.scratch_root(shared) == "s3a://shared/x"
