from __future__ import annotations

from datetime import date

import pytest

from wattledger import run


def test_arguments():
    args = run.parse_args(["settle", "--root", "/t", "--sim-day", "2024-01-02", "--run-id", "r"])
    assert (args.job, args.sim_day, args.last_day, args.run_id) == (
        "settle", date(2024, 1, 2), None, "r",
    )
    assert run.parse_args(["stream", "--root", "/t", "--messages", "/m"]).trigger_seconds == 10
    args = run.parse_args(
        ["stream", "--root", "/t", "--messages", "/m", "--max-files", "7", "--max-offsets", "500000"]
    )
    assert (args.max_files, args.max_offsets) == (7, 500_000)
    with pytest.raises(SystemExit):
        run.parse_args(["stream", "--root", "/t", "--topic", "only"])


def test_pending_job(spark, tmp_path, capsys):
    for day in ("2024-01-01", "2024-01-02"):
        d = tmp_path / "tariffs" / f"sim_date={day}"
        d.mkdir(parents=True)
        (d / "_SUCCESS").touch()
        (tmp_path / "meter_readings" / f"sim_date={day}").mkdir(parents=True)
    assert run.main(["pending", "--root", str(tmp_path)]) == 0
    out = capsys.readouterr().out
    assert "2024-01-01" in out and "2024-01-02" not in out
