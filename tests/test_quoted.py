"""Quoted cells over several lines, against the csv module, with files cut into small blocks."""

from __future__ import annotations

import csv
import io
import random

import pytest
from pyspark.errors import PySparkException

from plumeline.sources import quoted
from plumeline.sources.delimited import read_hourly_files

HEADER = ["aqsid", "Value", "note", "row"]


def expected(text: str, delimiter: str) -> list[dict]:
    rows = list(csv.reader(io.StringIO(text), delimiter=delimiter))
    return [
        {HEADER[i] if i < len(HEADER) else f"extra_{i}": cell.strip() for i, cell in enumerate(row)}
        for row in rows[1:]
        if any(cell.strip() for cell in row)
    ]


def files(seed: int) -> dict[str, str]:
    chance = random.Random(seed)
    bits = ['"', '""', "\n", ",", "|", "a", "b c", " ", '\n"x', '",', "\n\n"]
    found = {}
    for i in range(30):
        delimiter = "|" if i % 2 else ","
        lines = [delimiter.join(HEADER)]
        for row in range(chance.randint(1, 25)):
            note = "".join(chance.choice(bits) for _ in range(chance.randint(0, 8)))
            kind = chance.random()
            if kind < 0.6:
                note = '"' + note.replace('"', '""') + '"'
            elif kind < 0.9 or i % 3:
                note = note.replace("\n", " ").replace('"', "")
            lines.append(delimiter.join(["060010001", "1", note, str(row)]))
        found[f"{i}.dat"] = "\n".join(lines) + "\n"
    return found


@pytest.mark.parametrize(("seed", "block"), [(1, 40), (2, 150), (3, 1 << 20)])
def test_records_equal_csv(spark, tmp_path, seed, block):
    made = files(seed)
    for name, text in made.items():
        (tmp_path / name).write_text(text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got: dict[str, list] = {name: [] for name in made}
        for row in read_hourly_files(spark, str(tmp_path)).collect():
            got[row.object_key.rsplit("/", 1)[1]].append(dict(row.raw_fields))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    for name, text in made.items():
        truth = expected(text, "|" if "|" in text.split("\n")[0] else ",")
        assert sorted(map(str, map(sorted, map(dict.items, got[name])))) == sorted(map(str, map(sorted, map(dict.items, truth)))), name


def test_header_over_two_lines(spark, tmp_path):
    (tmp_path / "a.dat").write_text('aqsid,"Value\n(ppb)"\n060010001,"1\n2"\n')
    assert [dict(r.raw_fields) for r in read_hourly_files(spark, str(tmp_path)).collect()] == [
        {"aqsid": "060010001", "Value\n(ppb)": "1\n2"}
    ]


def test_long_cells_and_open_cells(spark, tmp_path):
    long = "x " * 30_000
    (tmp_path / "long.dat").write_text(f'aqsid,Value\n060010001,"{long}\n1"\n060010002,2\n')
    (tmp_path / "open.dat").write_text('aqsid,Value\n060010003,"1\n060010004,2\n')
    rows = [dict(r.raw_fields) for r in read_hourly_files(spark, str(tmp_path)).collect()]
    assert sorted((r["aqsid"], len(r["Value"])) for r in rows) == [("060010001", 60_002), ("060010002", 1), ("060010003", 13)]
    (tmp_path / "open.dat").write_text('aqsid,Value\n060010003,"1\n' + "060010004,2\n" * (quoted.MAX_RECORD // 10))
    with pytest.raises(PySparkException, match="open.dat"):
        read_hourly_files(spark, str(tmp_path)).collect()
