import json
import os
import subprocess
import sys

import pytest

from emporia.plans.session import cluster_conf, ensure_checkpoint_dir

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _SC:
    def __init__(self, master, conf, ckpt=None):
        self.master, self._conf, self._ckpt = master, conf, ckpt

    def getCheckpointDir(self):
        return self._ckpt

    def getConf(self):
        return self._conf

    def setCheckpointDir(self, path):
        self._ckpt = path


class _Spark:
    def __init__(self, master, values):
        self.sparkContext = _SC(master, _Conf(values))
        self.conf = _Conf(values)


def test_cluster_without_checkpoint_folder_is_refused():
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(_Spark("yarn", {}))


def test_checkpoint_folder_is_read_from_the_session():
    s = _Spark("yarn", {"spark.checkpoint.dir": "hdfs:///shared/ckpt"})
    assert ensure_checkpoint_dir(s) == "hdfs:///shared/ckpt"


def test_cluster_conf_enables_adaptive_execution():
    c = cluster_conf()
    assert c["spark.sql.adaptive.enabled"] == "true" and c["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="4", BENCH_MODELS="0")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True,
                         text=True, timeout=900)
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1, out.stdout
    rec = json.loads(lines[0])
    assert rec["unit"] == "sec" and rec["sf"] == 0.001 and rec["value"] > 0
    assert "q03_revenue_by_state" in rec["queries"]
