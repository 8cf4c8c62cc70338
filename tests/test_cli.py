import subprocess
import sys
import uuid

from renewlens.session import scratch_path


def test_cli_calendar_job(spark):
    out = scratch_path(spark, "cli", uuid.uuid4().hex)
    r = subprocess.run([sys.executable, "-m", "renewlens", "calendar", "--start-year", "2020", "--end-year", "2021",
                        "--out", out, "--master", "2"], capture_output=True, text=True, timeout=300,
                       cwd=__import__("os").path.dirname(__import__("os").path.dirname(__file__)))
    assert r.returncode == 0, r.stderr[-2000:]
    assert "calendar: 731 rows" in r.stdout
