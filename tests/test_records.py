"""CSV records over many splits against Python's own reader."""

import csv
import io
import random

import numpy as np
import pyarrow as pa
import pytest

from conftest import rows
from logquarry.sources import records
from logquarry.sources.logs import scan_log_csv


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "97")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    spark.conf.set("spark.sql.files.minPartitionNum", "64")
    yield
    for name in ("maxPartitionBytes", "openCostInBytes", "minPartitionNum"):
        spark.conf.unset(f"spark.sql.files.{name}")


def expected(text, sep=","):
    found = list(csv.reader(io.StringIO(text), delimiter=sep))
    return sorted((tuple(c or None for c in r) for r in found[1:] if r), key=str)


@pytest.mark.parametrize("seed, sep, width", [(1, ",", 3), (2, ";", 2), (3, "|", 5), (4, "\t", 4)])
def test_random_files_in_small_splits(spark, tmp_path, small_splits, seed, sep, width):
    """Cells of quotes, separators, line breaks and whole lines of the file itself, records longer than a split."""
    rng = random.Random(seed)
    pieces = ["a", "bc", "é", '"', '""', sep, "\n", f"1{sep}2\n", f'"{sep}"', " ", sep.join("xyzuv"[:width]) + "\n"]
    folder, want = tmp_path / "logs", []
    folder.mkdir()
    for number in range(3):
        out = io.StringIO()
        writer = csv.writer(out, delimiter=sep, lineterminator="\n", quoting=rng.choice([csv.QUOTE_MINIMAL, csv.QUOTE_ALL]))
        writer.writerow([f"h{i}" for i in range(width)])
        for i in range(40):
            writer.writerow([f"{number}.{i}", *["".join(rng.choices(pieces, k=rng.choice([0, 1, 3, 9, 60]))) for _ in range(width - 1)]])
        (folder / f"{number}.csv").write_bytes(out.getvalue().encode())
        want += expected(out.getvalue(), sep)
    table = scan_log_csv(spark, str(folder), sep=sep, null_tokens=())
    assert table.columns == [f"h{i}" for i in range(width)]
    assert records.read_lines(spark, str(folder), sep).rdd.getNumPartitions() > 20
    blank = lambda r: tuple(c or None for c in r)
    assert sorted(map(blank, rows(table)), key=str) == sorted(want, key=str)


def test_a_stray_quote_costs_its_record(spark, tmp_path, small_splits):
    body = [f"{i},plain {i},end" for i in range(100)]
    body[20], body[50] = '20,"open,end', '50,mid"dle,end'
    body[23], body[60] = '23,"two\nlines",end', '60,"next\n\none, with ""quotes""",end'
    (tmp_path / "a.csv").write_text("\n".join(["a,b,c", *body]) + "\n")
    found = {r[0]: r for r in rows(scan_log_csv(spark, str(tmp_path / "a.csv")))}
    assert len(found) == 100 and found["50"][1] == 'mid"dle'
    assert found["23"][1] == "two\nlines" and found["60"][1] == 'next\n\none, with "quotes"'
    assert all(found[str(i)] == (str(i), f"plain {i}", "end") for i in range(100) if i not in (20, 23, 50, 60))


def test_an_open_cell_without_end_is_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(records, "MAX_RECORD", 500)
    body = ['0,"open,x', *[f"{i},plain,x" for i in range(1, 300)]]
    (tmp_path / "a.csv").write_text("\n".join(["a,b,c", *body]) + "\n")
    found = {r[0]: r for r in rows(scan_log_csv(spark, str(tmp_path / "a.csv")))}
    assert len(found) == 300 and all(found[str(i)] == (str(i), "plain", "x") for i in range(1, 300))


def test_names_headers_and_short_records(spark, tmp_path):
    (tmp_path / "a.csv").write_text('\ufeffa,a,,"b"\n1,2,3,"x\ny"\n\n   \n4\n1,2,3,4,5\n', encoding="utf-8")
    (tmp_path / "b.csv").write_text('"a",a,,b\n5,6,7,8\n')
    table = scan_log_csv(spark, str(tmp_path))
    assert table.columns == ["a0", "a1", "_c2", "b"]
    assert sorted(rows(table), key=str) == [("1", "2", "3", "4"), ("1", "2", "3", "x\ny"), ("4", None, None, None), ("5", "6", "7", "8")]


def test_effects_of_lines_agree(spark):
    """The column expression, the state arrays and the rule on single lines, on random lines of few characters."""
    rng = random.Random(5)
    texts = list({"".join(rng.choices('"",ab', k=rng.randint(0, 8))) for _ in range(1500)})
    lines = spark.createDataFrame(list(enumerate(texts)), "i long, value string")
    effects = dict(rows(lines.select("value", records.line_effect(lines["value"], ","))))
    rule = records.RecordLines(",", 3)
    for text, effect in effects.items():
        ends = {records.KEEPS: (0, 1), records.CLOSES: (0, 0), records.OPENS: (1, 1), records.FLIPS: (1, 0)}[effect]
        assert (rule.ends(text, False), rule.ends(text, True)) == ends, text


@pytest.mark.parametrize("sep", [",", "\t", "x", "§"])
def test_effects_of_lines_are_those_of_their_quotes(sep):
    """All lines of a batch against the rule on single ones: quotes that share a separator, runs of quotes, empty lines."""
    rng = random.Random(len(sep) + ord(sep))
    pieces = ['"', '"', '""', sep, sep, "a", "y", "é", "\x01", "\x02", "\x03", " "]
    lines = [f'{sep}"{sep}"{sep}', "", *["".join(rng.choices(pieces, k=rng.randint(0, 12))) for _ in range(3000)]]
    rule = records.RecordLines(sep, 2)
    ends = {(False, False): records.CLOSES, (True, True): records.OPENS, (True, False): records.FLIPS, (False, True): records.KEEPS}
    want = [ends[rule.ends(x, False), rule.ends(x, True)] for x in lines]
    assert records.line_effects(pa.array(lines), sep).tolist() == want
    assert records.line_effects(pa.array(lines).slice(7, 900), sep).tolist() == want[7:907]


@pytest.mark.parametrize("cells", [['"a', 'b",c'], ['"a', '"",b",c', "d,e"], ["d,e", '"a', 'b"', 'c,"d', 'e"'], ['a","b', "c,d", 'e,"f', 'g"', 'h,"i']])
def test_records_put_together_at_once_are_those_found_line_by_line(cells):
    """What stands between two ends of a cell and has the header's width; the rest is left to be read line by line."""
    rule, state = records.RecordLines(",", 2), cells[0].startswith('a"')
    before, after = [], []
    for line in cells:
        before.append(int(state))
        state = rule.ends(line, state)
        after.append(int(state))
    texts, first, last = records.whole_records(pa.array(cells), np.array(before), np.array(after), ",", 2)
    want = [(a, b) for a in range(len(cells)) for b in range(a + 1, len(cells)) if not before[a] and after[a] and not after[b] and all(after[a:b])]
    want = [(a, b) for a, b in want if rule.resolved(cells[a : b + 1]) == ["\n".join(cells[a : b + 1])] and rule.fits("\n".join(cells[a : b + 1]))]
    assert list(zip(first.tolist(), last.tolist())) == want
    assert texts.to_pylist() == ["\n".join(cells[a : b + 1]) for a, b in want]
