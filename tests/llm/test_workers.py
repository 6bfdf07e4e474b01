"""Workers need no copy of the package: the queries run with it on the driver's path only."""

import os
import subprocess
import sys

import pytest

from conftest import ROOT, SMALL

SCRIPT = """
import sys
from pyspark.sql import SparkSession

spark = (SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4")
         .config("spark.ui.enabled", "false").getOrCreate())
spark.sparkContext.setLogLevel("OFF")


def missing(_):
    import importlib.util
    return [importlib.util.find_spec("quarry") is None]


sys.path.insert(0, sys.argv[1])
assert spark.sparkContext.parallelize([0], 1).mapPartitions(missing).collect() == [True]
import __spark_entry__ as E

queries = E.queries()
for name in sys.argv[3:]:
    print(name, queries[name](spark, sys.argv[2]).count())
"""


@pytest.mark.parametrize("names", [
    ["op1_language_id", "op3_toxicity", "op10_token_counts"],
    ["op5_exact_dedup", "op8_minhash_near_dedup", "op12_conversation_repair", "op13_line_dedup", "op11_source_divergence"],
    ["pipeline"],
])
def test_queries_run_without_the_package_on_the_workers(tmp_path, names):
    script = tmp_path / "run.py"
    script.write_text(SCRIPT)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script), ROOT, SMALL, *names], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert done.returncode == 0, done.stdout[-2000:] + done.stderr[-3000:]
    assert [line.split()[0] for line in done.stdout.splitlines() if line.split()[0] in names] == names
