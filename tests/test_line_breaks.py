"""Quoted line breaks: records that span lines, blocks of a file, and files."""

import csv
import io
import random

import pytest
from conftest import plan_of, values

from ledgerloom.session import materialised
from ledgerloom.sources import stitched
from ledgerloom.sources.raw import scan_text


@pytest.fixture
def small_splits(spark, tmp_path_factory, monkeypatch):
    """Blocks of a few bytes, so that lines, fields and quotes lie on their edges. Only the text
    files are split so, not the tables that are made of them."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    whole = stitched._lines

    def split(size):
        def lines(spark, path):
            before = {n: spark.conf.get(n) for n in names}
            for name, value in zip(names, (size, 1), strict=True):
                spark.conf.set(name, str(value))
            try:
                return materialised(whole(spark, path), str(tmp_path_factory.mktemp("lines")))
            finally:
                for name, value in before.items():
                    spark.conf.set(name, value)

        monkeypatch.setattr(stitched, "_lines", lines)

    return split


def expected(*texts):
    """What the csv module of Python reads, headers and blank lines left out."""
    rows = []
    for text in texts:
        rows += [r for r in list(csv.reader(io.StringIO(text, newline="")))[1:] if r]
    return sorted(tuple(x.replace("\r\n", "\n") or None for x in r) for r in rows)


def read(spark, path, **options):
    return sorted(values(scan_text(spark, str(path), **options), "*"), key=lambda r: tuple(x or "" for x in r))


def key(rows):
    return sorted(rows, key=lambda r: tuple(x or "" for x in r))


@pytest.mark.parametrize("size", [23, 10_000])
def test_random_files(spark, tmp_path, small_splits, size):
    small_splits(size)
    rng = random.Random(size)
    parts = ["x", "yy", ",", '"', "\n", "\n\n", " ", '""', "é", "1", ',"', '",', "\n,\n", "a,b"]
    texts = []
    for n in range(4):
        out = io.StringIO(newline="")
        write = csv.writer(out, lineterminator="\r\n" if n == 3 else "\n")
        write.writerow(["a", "b", "c"])
        for i in range(25):
            text = ["".join(rng.choices(parts, k=rng.randrange(6))) for _ in range(2)]
            write.writerow([f"{n}-{i}", *(t.strip("\n") if n == 3 else t for t in text)])
        texts.append(out.getvalue())
        (tmp_path / f"part-{n}.csv").write_text(out.getvalue(), newline="")
    got = key(tuple(x.replace("\r\n", "\n") if x else x for x in r) for r in read(spark, tmp_path))
    assert got == key(expected(*texts))


def test_break_on_the_edge_of_a_block(spark, tmp_path, small_splits):
    text = 'a,b\n1,"x\ny"\n2,z\n'
    (tmp_path / "one.csv").write_text(text)
    for size in (5, 8, 9):
        small_splits(size)
        assert read(spark, tmp_path / "one.csv") == [("1", "x\ny"), ("2", "z")]


def test_a_field_over_many_blocks(spark, tmp_path, small_splits):
    small_splits(150)
    long = "\n".join(f"line {i}" for i in range(300))
    (tmp_path / "one.csv").write_text(f'a,b\n0,before\n1,"{long}"\n2,after\n3,"p\nq"\n')
    assert read(spark, tmp_path / "one.csv") == [("0", "before"), ("1", long), ("2", "after"), ("3", "p\nq")]
    lines = stitched._lines(spark, str(tmp_path / "one.csv"))
    assert lines.select("block").distinct().count() > 10


def test_quotes_within_plain_fields_open_nothing(spark, tmp_path):
    text = 'a,b\n1,5" pipe\n2,3" x 4" pipe\n3,"two\nlines"\n4,6" pipe\n5,"say ""hi"", he\nsaid"\n'
    (tmp_path / "one.csv").write_text(text)
    assert read(spark, tmp_path / "one.csv") == expected(text)


def test_files_without_breaks_are_read_as_they_are(spark, tmp_path):
    (tmp_path / "one.csv").write_text('a,b\n1,"x, y"\n2,5" pipe\n')
    df = scan_text(spark, str(tmp_path / "one.csv"))
    assert "FileScan csv" in plan_of(df)
    assert sorted(values(df, "*")) == [("1", "x, y"), ("2", '5" pipe')]


def test_only_lines_of_broken_records_are_moved(spark, tmp_path):
    rows = "".join(f"{i},plain\n" for i in range(2000))
    (tmp_path / "one.csv").write_text(f'a,b\n{rows}x,"p\nq"\n')
    plan = plan_of(scan_text(spark, str(tmp_path / "one.csv")))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert scan_text(spark, str(tmp_path / "one.csv")).count() == 2001


def test_unclosed_quote(spark, tmp_path, monkeypatch):
    (tmp_path / "one.csv").write_text('a,b\n1,"x\n2,y\n')
    with pytest.raises(stitched.UnclosedQuote, match="does not end"):
        scan_text(spark, str(tmp_path / "one.csv"))
    monkeypatch.setattr(stitched, "MOST_LINES", 3)
    (tmp_path / "two.csv").write_text('a,b\n1,"x\n2,y\n3,z\n4,"\n')
    with pytest.raises(stitched.UnclosedQuote, match="4 lines from 1"):
        scan_text(spark, str(tmp_path / "two.csv"))


def test_headers_must_agree(spark, tmp_path):
    (tmp_path / "1.csv").write_text('a,b\n1,"x\ny"\n')
    (tmp_path / "2.csv").write_text("b,a\n1,2\n")
    with pytest.raises(ValueError, match="header"):
        scan_text(spark, str(tmp_path))


def test_some_columns_of_records(spark, tmp_path):
    """A record is read whole, whatever columns of it are wanted."""
    (tmp_path / "one.csv").write_text('a,b,c\n1,"x\n""y"", z",p\n2,q,r\n')
    df = scan_text(spark, str(tmp_path / "one.csv"))
    assert sorted(values(df, "a")) == [("1",), ("2",)]
    assert sorted(values(df, "c")) == [("p",), ("r",)]
    assert df.count() == 2
    (tmp_path / "two.csv").write_text('a,b\n1,"x\ny"\n2\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        scan_text(spark, str(tmp_path / "two.csv")).select("a").collect()
