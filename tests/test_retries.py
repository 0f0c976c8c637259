"""Side-effecting tasks survive retries: a task that dies after writing part of its files is rerun
and the result is complete, with no duplicate or partial files (run in its own Spark process)."""

import subprocess
import sys
import textwrap
from pathlib import Path

REPO = str(Path(__file__).resolve().parents[1])

SCRIPT = textwrap.dedent(
    """
    import sys, os
    sys.path.insert(0, REPO)
    from pyspark.sql import SparkSession
    spark = (SparkSession.builder.master("local[4,3]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "4").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    import tickwork.sinks.blockfiles as bf
    from tickwork.sources import read_block_files
    from tickwork.operators import hourly_block_stats

    real = bf.encode_block
    def flaky(t, n, *a):
        from pyspark import TaskContext
        ctx = TaskContext.get()
        if ctx.attemptNumber() == 0 and n == 25:
            open(OUT + "/injected", "w").write("attempt 0 failed")
            raise RuntimeError("injected task failure")
        return real(t, n, *a)
    bf.encode_block = flaky  # shipped by value with the task

    df = spark.range(200).selectExpr("1600000000 + id * 60 AS block_time", "id AS tx_count").repartition(4)
    path = OUT + "/blocks"
    manifest = bf.write_block_files(df, path, rows_per_file=10)
    files = sorted(f for f in os.listdir(path))
    blocks = read_block_files(spark, path)
    print("FILES", len(files), all(f.startswith("blk") and f.endswith(".dat") for f in files))
    print("MANIFEST", manifest.agg({"n_blocks": "sum"}).first()[0])
    print("BLOCKS", blocks.count(), blocks.agg({"tx_count": "sum"}).first()[0])
    """
)


def test_block_writer_survives_a_failed_task_attempt(tmp_path):
    code = f"REPO = {REPO!r}\nOUT = {str(tmp_path)!r}\n" + SCRIPT
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300, cwd=tmp_path)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = dict(line.split(" ", 1) for line in out.stdout.splitlines() if line.split(" ", 1)[0] in
                 {"FILES", "MANIFEST", "BLOCKS"})
    assert (tmp_path / "injected").exists()  # the first attempt of one task really failed mid-way
    assert lines["FILES"].endswith("True")  # no leftover temp files
    assert lines["MANIFEST"] == "200"
    assert lines["BLOCKS"] == f"200 {sum(range(200))}"
