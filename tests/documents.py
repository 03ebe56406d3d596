"""Small documents for tests."""

from __future__ import annotations

import json
from pathlib import Path

from tremorline.schema import PROPERTIES

NAMES = [name for name, _ in PROPERTIES]


def feature(coordinates=(1.5, 2.5, 3.5), **properties) -> dict:
    values = dict.fromkeys(NAMES) | {"time": 1729842930123, "updated": 1729842931999} | properties
    return {
        "type": "Feature",
        "id": "ignored",
        "properties": values,
        "geometry": {"type": "Point", "coordinates": list(coordinates)},
    }


def document(*features) -> str:
    return json.dumps({"type": "FeatureCollection", "metadata": {"x": 1}, "features": features})


def land(path: Path, *lines: str) -> str:
    path.mkdir(parents=True, exist_ok=True)
    (path / "feed.json").write_text("".join(line + "\n" for line in lines), encoding="utf-8")
    return str(path)
