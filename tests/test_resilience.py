"""Task failures during key assignment: retried tasks must give the same dense keys.

Runs in a subprocess with its own session ``local[4,3]`` (3 attempts per task);
a pandas UDF in the input fails the first attempt of one task in every stage.
"""

import os
import subprocess
import sys
import textwrap

SCRIPT = textwrap.dedent('''
    import sys, tempfile
    sys.path.insert(0, {root!r})
    import pandas as pd
    from pyspark import TaskContext
    from pyspark.sql import SparkSession, Window, functions as F
    from larder.operators.keys import surrogate_key

    d = tempfile.mkdtemp(prefix="larder-retry-")
    spark = (SparkSession.builder.master("local[4,3]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "6").config("spark.checkpoint.dir", d + "/ckpt")
             .config("spark.local.dir", d).getOrCreate())
    spark.sparkContext.setLogLevel("OFF")

    @F.pandas_udf("long")
    def flaky(s: pd.Series) -> pd.Series:
        ctx = TaskContext.get()
        if ctx.attemptNumber() == 0 and ctx.partitionId() == 1:
            raise RuntimeError("injected task failure")
        return s

    df = spark.range(0, 20000, 1, 4).select(flaky((F.col("id") * 7919) % 5003).alias("k"), F.col("id"))
    got = surrogate_key(df, ["k", "id"], "sk")
    exp = df.withColumn("sk", F.row_number().over(Window.orderBy("k", "id")).cast("bigint"))
    bad = got.select("sk", "k", "id").exceptAll(exp.select("sk", "k", "id")).count()
    print("RESULT", got.count(), bad)
''')


def test_keys_survive_task_retries():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", SCRIPT.format(root=root)], capture_output=True, text=True,
                         timeout=600)
    line = [ln for ln in out.stdout.splitlines() if ln.startswith("RESULT")]
    assert line, out.stderr[-2000:]
    assert line[-1].split()[1:] == ["20000", "0"]
