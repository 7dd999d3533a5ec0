"""Published files as plain rows, for tests."""

import csv
import json
from pathlib import Path


def folder_of(path, *part):
    """The folder of the current version of a result, or of one of its parts (values of its columns)."""
    rows = [json.loads(line) for f in Path(path, "pointers").glob("*.json") for line in f.read_text().splitlines()]
    wanted = json.dumps(list(part), separators=(",", ":"))
    named = [(r["number"], r["version"]) for r in rows if r["part"] == wanted]
    if not named:
        return None
    folder = Path(path, "versions", f"version={max(named)[1]}")
    for value in part:
        folder = next(f for f in folder.iterdir() if f.name.endswith(f"={value}"))
    return folder


def table_of(path, *part):
    rows = []
    folder = folder_of(path, *part)
    for file in sorted(folder.glob("*.csv")) if folder else []:
        with open(file, newline="", encoding="utf-8") as f:
            rows.extend(csv.DictReader(f))
    return rows
