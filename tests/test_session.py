"""The library works in sessions that somebody else opened."""

import subprocess
import sys
import textwrap
from pathlib import Path

from recordferry.session import SETTINGS

ROOT = Path(__file__).resolve().parent.parent


def test_every_setting_may_change_in_a_running_session(spark):
    plain = spark.newSession()
    assert all(plain.conf.isModifiable(key) for key in SETTINGS)


def test_entry_and_each_query_start_in_a_plain_session():
    """A session of its own process, built without a setting of the library."""
    code = """
        from pyspark.sql import SparkSession
        import __spark_entry__ as entry_points
        from recordferry.plans import queries
        spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
        spark.sparkContext.setLogLevel("ERROR")
        assert entry_points.entry(spark).count() > 0
        for name, query in queries.queries().items():
            query(spark, "/root/testdata/sf0.001").schema
        print("all started")
    """
    done = subprocess.run([sys.executable, "-c", textwrap.dedent(code)], cwd=ROOT, capture_output=True, text=True, timeout=900)
    assert "all started" in done.stdout, done.stderr[-3000:]
