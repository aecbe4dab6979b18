import os
import subprocess
import sys
from pathlib import Path

from rows import SF

REPO = str(Path(__file__).parents[2])
SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])  # of the driver alone
import __spark_entry__
from ratewell.session import build_session

spark = build_session("workers", "local[4]", spark__sql__shuffle__partitions="4", spark__driver__memory="3g", spark__ui__showConsoleProgress="false")
spark.sparkContext.setLogLevel("ERROR")

def has_package(batches):
    import importlib.util
    for batch in batches:
        yield batch.assign(id=int(importlib.util.find_spec("ratewell") is not None))

assert spark.range(1).mapInPandas(has_package, "id long").first().id == 0
names = [n for n in __spark_entry__.queries() if n.startswith("op") and n[2].isdigit()]
for name in names:
    __spark_entry__.queries()[name](spark, sys.argv[2]).write.format("noop").mode("overwrite").save()
    print("ran", name, flush=True)
"""


def test_workers_need_no_copy_of_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    ran = subprocess.run([sys.executable, "-c", SCRIPT, REPO, SF], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert ran.returncode == 0, ran.stderr[-3000:]
    assert ran.stdout.count("ran op") >= 13
