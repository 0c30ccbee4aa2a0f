import random

import pytest

from opinlake import schemas
from opinlake.sources import history_csv, split_csv

NAMES = schemas.HISTORY_CSV.fieldNames()


def export(seed, n, line_end="\n"):
    """Rows with quoted line breaks, quotes, commas and blanks, some over many lines."""
    rnd = random.Random(seed)
    parts = ["a", "line", "\n", "\n\n", '""', ",", " ", "é😀", "\r\n", ""]

    def field(k):
        if k < len(NAMES) - 2:
            return rnd.choice(["", "7", "P1", " padded ", '""'])
        size = rnd.choice([0, 3, 8, 400]) if rnd.random() < 0.3 else 4
        return '"' + "".join(rnd.choice(parts) for _ in range(size)) + '"'

    rows = [",".join(field(k) for k in range(len(NAMES))) for _ in range(n)]
    return line_end.join([",".join(NAMES), *rows, ""])


def read(spark, path, part_bytes, split):
    spark.conf.set("spark.sql.files.maxPartitionBytes", part_bytes)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        rows = history_csv.read_history_csv(spark, path, split=split)
        return sorted(map(tuple, rows.collect()), key=repr), rows.rdd.getNumPartitions()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("line_end", ["\n", "\r\n"])
@pytest.mark.parametrize("part_bytes", [97, 1009, 20011])
def test_parts_give_the_rows_of_the_whole_file(spark, tmp_path, part_bytes, line_end):
    """Borders between parts fall into quoted fields, and records are longer than parts."""
    path = tmp_path / "one.csv"
    path.write_text(export(part_bytes, 300, line_end), encoding="utf-8", newline="")
    found, tasks = read(spark, str(path), part_bytes, True)
    whole, _ = read(spark, str(path), 1 << 27, False)
    assert len(whole) == 300 and found == whole
    assert tasks >= path.stat().st_size // part_bytes // 2


def test_several_files_each_with_a_header(spark, tmp_path):
    for k, n in enumerate((40, 0, 1, 90)):
        text = export(50 + k, n)
        (tmp_path / f"{k}.csv").write_text(text if k != 2 else text.rstrip("\n"), encoding="utf-8", newline="")
    found, _ = read(spark, str(tmp_path), 500, True)
    assert len(found) == 131 and found == read(spark, str(tmp_path), 1 << 27, False)[0]


def test_only_large_files_are_read_in_parts(spark, tmp_path, monkeypatch):
    path = tmp_path / "one.csv"
    path.write_text(export(1, 50), encoding="utf-8", newline="")
    used = []
    plain = split_csv.read_split_csv
    monkeypatch.setattr(history_csv, "read_split_csv", lambda *a: used.append(a) or plain(*a))
    large, small = read(spark, str(path), 1000, None)[0], read(spark, str(path), 1 << 27, None)[0]
    assert len(used) == 1 and large == small


def test_an_empty_file_and_a_header_alone(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    (tmp_path / "b.csv").write_text(",".join(NAMES))
    assert read(spark, str(tmp_path), 100, True)[0] == []


def test_the_scan_for_pieces_makes_no_other_records(spark, tmp_path):
    path = tmp_path / "one.csv"
    path.write_text(export(7, 300), encoding="utf-8", newline="")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 1009)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        lines = split_csv._lines(spark, str(path))
        starts, with_cr, _ = split_csv._openings(lines)
        all_records = split_csv._cut(lines, starts, with_cr, False)
        pieces = sorted(map(tuple, split_csv._cut(lines, starts, with_cr, True).collect()), key=repr)
        assert pieces == sorted(map(tuple, all_records.where("piece IS NOT NULL").collect()), key=repr)
        assert 0 < len(pieces) < all_records.count()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
