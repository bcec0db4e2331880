"""The package reaches workers that do not find it on their own."""

import os
import subprocess
import sys

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {HERE!r})
from traitloom.session import local_session, ship_package
from traitloom.sources.split_csv import Quotes
spark = local_session("ship", 1, "1g")
archive = ship_package(spark)
import zipfile
assert "traitloom/sources/split_csv.py" in zipfile.ZipFile(archive).namelist()
def run(batches):
    from traitloom.sources.split_csv import Quotes
    for b in batches:
        yield b if Quotes().inside_after(b'"', False) else None
assert spark.range(3).mapInArrow(run, "id long").count() == 3
"""


def test_workers_find_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=200)
    assert done.returncode == 0, done.stderr[-2000:]
