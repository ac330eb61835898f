"""Sessions without a configured checkpoint folder (no spark-defaults): the library creates
one folder per SparkContext and every caller sees the same one."""

import os
import subprocess
import sys
import tempfile
import textwrap

from .conftest import ROOT, SF_SMALL

SCRIPT = textwrap.dedent(f"""
    import sys
    sys.path.insert(0, {ROOT!r})
    from pyspark.sql import SparkSession
    s = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
    assert not s.conf.get("spark.checkpoint.dir", None)
    from codetrail.session import checkpoint_root
    import __spark_entry__ as E
    n = E.entry(s).count()
    m = E.queries()["upsert_delete_insert"](s, {SF_SMALL!r}).count()
    assert checkpoint_root(s) == checkpoint_root(s)
    print("RESULT", n, m)
""")


def test_entry_without_checkpoint_setting():
    env = dict(os.environ, SPARK_CONF_DIR=tempfile.mkdtemp(prefix="codetrail-noconf-"))
    out = subprocess.run([sys.executable, "-c", SCRIPT], env=env, capture_output=True, text=True, timeout=600)
    line = [x for x in out.stdout.splitlines() if x.startswith("RESULT")]
    assert line, out.stderr[-3000:]
    _, n, m = line[0].split()
    assert int(n) > 0 and int(m) > 0


def test_a_cluster_needs_a_shared_folder():
    """Off local masters a machine-local folder is refused; a configured one is used as it is."""
    import pytest

    from codetrail import session

    class Conf:
        def __init__(self, **kw):
            self.kw = kw

        def get(self, key, default=None):
            return self.kw.get(key, default)

    class Context:
        def __init__(self, master):
            self.master, self.applicationId = master, f"{master}-{id(self)}-{os.urandom(4).hex()}"

        def getCheckpointDir(self):
            return None

        def setCheckpointDir(self, path):
            self.path = path

    class Session:
        def __init__(self, master, **conf):
            self.sparkContext, self.conf = Context(master), Conf(**conf)

    for master in ("yarn", "spark://host:7077", "k8s://https://host", "local-cluster[3,2,1024]"):
        with pytest.raises(RuntimeError, match="share"):
            session.checkpoint_root(Session(master))
        assert session.checkpoint_root(Session(master, **{"spark.checkpoint.dir": "hdfs:///x/"})) == "hdfs:///x"
    for master in ("local", "local[4]", "local[*]"):
        s = Session(master)
        assert session.checkpoint_root(s) == s.sparkContext.path
