from __future__ import annotations

import pytest

from signalgrid.__main__ import parser, run
from signalgrid.plans import jobs
from signalgrid.sources.tables import read_table

CELLS = "cell_code,x,y,station_code,azimuth,province_name,district_name"


def test_cells_and_late(spark, tmp_path):
    (tmp_path / "cells.csv").write_text(f"{CELLS}\nC1,21.0,105.8,S1,120,HN,D1\n")
    lake = ["--lake", str(tmp_path)]
    run(spark, parser().parse_args([*lake, "cells", "--input", f"{tmp_path}/cells.csv"]))
    run(spark, parser().parse_args([*lake, "late"]))
    assert read_table(spark, jobs.Lake(str(tmp_path)).dim_cell).count() == 1


def test_arguments():
    args = parser().parse_args(["--lake", "x", "ingest", "--date", "2025-05-12", "--hour", "07"])
    assert (args.job, args.hour, args.input) == ("ingest", 7, None)
    args = parser().parse_args(["--lake", "x", "forecast", "--date", "2025-05-12"])
    assert (args.lookback_days, args.model) == (7, "seasonal")
    with pytest.raises(SystemExit):
        parser().parse_args(["--lake", "x", "nothing"])
