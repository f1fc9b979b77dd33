"""The driver contract from a separate process: another working directory,
a plain default session and no ``spark.checkpoint.dir`` configured."""
import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import importlib.util
spec = importlib.util.spec_from_file_location("spark_entry", {os.path.join(REPO, '__spark_entry__.py')!r})
E = importlib.util.module_from_spec(spec); spec.loader.exec_module(E)
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.showConsoleProgress", "false").getOrCreate()
spark.sparkContext.setLogLevel("ERROR")
assert spark.sparkContext.getConf().get("spark.checkpoint.dir", None) is None
df = E.entry(spark)
print("ENTRY", df.count(), ",".join(df.columns))
print("STREAM", E.queries()["count_window_stream"](spark, "/root/testdata/sf0.001").count())
"""


def test_entry_and_stream_query_in_a_plain_driver_process():
    work = tempfile.mkdtemp(prefix="tickwise-driver-")
    conf = tempfile.mkdtemp(prefix="tickwise-conf-")       # empty Spark config folder
    env = dict(os.environ, SPARK_CONF_DIR=conf)
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=work, env=env, capture_output=True,
                         text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = dict(l.split(" ", 1) for l in out.stdout.splitlines() if l.startswith(("ENTRY", "STREAM")))
    n, cols = lines["ENTRY"].split(" ")
    assert int(n) > 0
    assert cols == "symbol,timestampvalue,avgprice,pricechange,avgvol,volumechange,ratio"
    assert int(lines["STREAM"]) == 1000
