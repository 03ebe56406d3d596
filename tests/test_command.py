"""The command line, end to end."""

from __future__ import annotations

from pathlib import Path

from documents import document, feature, land

from tremorline.__main__ import main
from tremorline.sources.paths import LANDING


def test_ingest_then_analyse(spark, tmp_path, capsys):
    table = f"{tmp_path}/table"
    for stamp in ("20241025_075530", "20241026_075530"):
        line = document(feature(code=stamp, place="1 km N of Somewhere", mag=6))
        land(tmp_path / LANDING / stamp, line)
        main(["ingest", "--root", str(tmp_path), "--run", stamp, "--table", table])
    assert capsys.readouterr().out.count("documents=1, rejected=0") == 2
    assert Path(tmp_path, "silver", "20241026_075530").is_dir()
    main(["analyse", "--table", table])
    printed = capsys.readouterr().out
    assert "regions_above_5" in printed and "Somewhere" in printed


def test_shapes_and_increments(spark, tmp_path, capsys):
    land(tmp_path / LANDING / "20241025_075530", document(feature(code="a")), "None")
    places = ["--root", str(tmp_path), "--table", f"{tmp_path}/table"]
    progress = ["--checkpoint", f"{tmp_path}/checkpoint"]
    shape = ["--shape", "string", "--zone", "Asia/Tokyo"]
    for expected in ("documents=2, rejected=1", "documents=0, rejected=0"):
        main(["ingest-new", *places, *progress, *shape])
        assert expected in capsys.readouterr().out
    row = spark.read.parquet(f"{tmp_path}/table").selectExpr("mng", "cast(time as string)").first()
    assert row == ("None", "2024-10-25 16:55:30")
