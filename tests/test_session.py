"""A session that sets nothing, started from another folder: settings, scratch folder and package."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

PROGRAM = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession, functions as F
from lyceum.session import prepare, scratch_path
from lyceum.streaming.jobs import materialise
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
{chosen}
prepare(spark)
assert spark.conf.get("spark.sql.shuffle.partitions") == {partitions!r}
path = scratch_path(spark, "rows")
assert "/_scratch/rows-" in path, path
spark.range(10).write.parquet(path)
again = spark.readStream.schema("id long").parquet(path)
assert materialise(again.where("id > 3"), "left").count() == 6
print("fine")
"""


def run(tmp_path, chosen, partitions):
    conf = tmp_path / "conf"
    conf.mkdir()
    program = PROGRAM.format(root=ROOT, chosen=chosen, partitions=partitions)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"SPARK_CONF_DIR": str(conf)}
    done = subprocess.run([sys.executable, "-c", program], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.stdout.strip().endswith("fine"), done.stderr[-3000:]


def test_nothing_is_set(tmp_path):
    run(tmp_path, "", "4")


def test_a_chosen_number_of_partitions_stays(tmp_path):
    run(tmp_path, 'spark.conf.set("spark.sql.shuffle.partitions", "200")', "200")
