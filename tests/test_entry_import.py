"""The entry module imports anywhere: no jar, data file or session is touched."""

import os
import subprocess
import sys

from pyspark.ml.feature import StopWordsRemover

from revlens.functions import text as X

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = """
import os, sys
import pyspark
pyspark.__file__ = os.path.join({empty!r}, "__init__.py")
os.environ["SPARK_HOME"] = {empty!r}
sys.path.insert(0, {root!r})
import __spark_entry__ as E
q, o = E.queries(), E.oracle_sql()
assert q and set(o) <= set(q) and all(isinstance(v, str) for v in o.values())
from pyspark.sql import SparkSession
assert SparkSession.getActiveSession() is None
print(len(q), len(o))
"""


def test_import_without_jars_or_session(tmp_path):
    run = subprocess.run([sys.executable, "-c", CODE.format(empty=str(tmp_path), root=ROOT)],
                         capture_output=True, text=True, cwd=tmp_path)
    assert run.returncode == 0, run.stderr
    queries, sql = map(int, run.stdout.split())
    assert queries >= 44 and sql >= 39


def test_stop_words_are_those_of_spark(spark):
    assert StopWordsRemover.loadDefaultStopWords("english") == X.STOP_WORDS
