from __future__ import annotations

import os
import subprocess
import sys

import __spark_entry__ as entry_points
from scholarmill.llm.queries import REGISTRY
from tests.conftest import SMALL

REPO = os.path.dirname(os.path.abspath(entry_points.__file__))


def test_each_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in REGISTRY) == list(range(1, 14))
    assert set(entry_points.queries()) == {*entry_points.REGISTRY, *REGISTRY, "pipeline"}


def test_workers_do_not_need_the_package(tmp_path):
    script = tmp_path / "away.py"
    script.write_text(
        "import sys\n"
        f"sys.path.insert(0, {REPO!r})\n"
        "from scholarmill.session import local_session\n"
        "import __spark_entry__ as e\n"
        "spark = local_session('2')\n"
        f"print(e.queries()['op10_packing'](spark, {SMALL!r}).count())\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240)
    assert run.returncode == 0 and int(run.stdout.split()[-1]) > 0, run.stderr[-2000:]
