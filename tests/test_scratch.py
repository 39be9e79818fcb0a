"""The shared folder: with and without a setting for it, and what is left of a run. Sessions are of their own, in processes of their own."""

import os
import subprocess
import sys

import pytest

CODE = """
import os, sys
from pyspark.sql import SparkSession
from daybook.scratch import Scratch, clean, shared_root
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
before = dict(spark.conf.getAll)
root = shared_root(spark)
s = Scratch(spark, "t")
s.save(spark.range(3), "a")
out = s.result(spark.range(5), "b")
assert out.count() == 5 and dict(spark.conf.getAll) == before
local = s.root.removeprefix("file:")
assert sorted(x for x in os.listdir(local) if not x.startswith(".")) == ["b"], os.listdir(local)
t = Scratch(spark, "u")
t.save(spark.range(1), "a")
t.release()
assert not os.path.exists(t.root.removeprefix("file:"))
clean(spark)
assert not os.path.exists(local)
print("ROOT", root)
"""


@pytest.mark.parametrize("setting", [None, "plain", "file"])
def test_folder_of_a_run(tmp_path, setting):
    conf = tmp_path / "conf"
    conf.mkdir()
    if setting:
        shared = f"{'file://' if setting == 'file' else ''}{tmp_path}/shared"
        (conf / "spark-defaults.conf").write_text(f"spark.checkpoint.dir {shared}\n")
    env = os.environ | {"SPARK_CONF_DIR": str(conf), "PYTHONPATH": os.pathsep.join([os.getcwd(), os.environ.get("PYTHONPATH", "")]), "TMPDIR": str(tmp_path)}
    got = subprocess.run([sys.executable, "-c", CODE], env=env, capture_output=True, text=True, timeout=300)
    assert got.returncode == 0, got.stderr[-2000:]
    root = got.stdout.split("ROOT ")[1].strip()
    assert root == f"file:{tmp_path}/shared" if setting else root.startswith(f"file:{tmp_path}/daybook-")
    assert not any(x.startswith("daybook-") for x in os.listdir(tmp_path))
