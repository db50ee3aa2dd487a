"""CSV records across splits against the csv module and the reader of whole files."""

import contextlib
import csv
import io
import random

import numpy as np
import pytest

from rootlens.sources import csv_tables, flat_file, split_csv


@contextlib.contextmanager
def small_splits(spark, size):
    settings = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "1"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key in settings:
            spark.conf.unset(key)


def write(base, name, data):
    path = f"{base}/{name}"
    with open(path, "wb") as out:
        out.write(data)
    return path


def cells(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


def random_rows(seed, n):
    rng = random.Random(seed)
    parts = ["a", "b ", 'q"uote', "line\nbreak", ",", '""', "\n\n", "é", "x" * 30, '"\n"', "end\n", '",']
    return [(str(i), *("".join(rng.choices(parts, k=rng.randint(0, 4))) or "-" for _ in range(2))) for i in range(n)]


@pytest.mark.parametrize("size, n, quoting", [(60, 6, csv.QUOTE_ALL), (400, 60, csv.QUOTE_MINIMAL), (900, 100, csv.QUOTE_ALL)])
def test_records_equal_the_csv_module(spark, base, size, n, quoting):
    rows = random_rows(size, n)
    out = io.StringIO(newline="")
    writer = csv.writer(out, quoting=quoting, lineterminator="\n")
    writer.writerow(["id", "a\nb", "c"])
    writer.writerows(rows)
    path = write(base, "r.csv", out.getvalue().encode())
    with small_splits(spark, size):
        df = flat_file.read_flat_file(spark, path)
    assert len(out.getvalue()) > 5 * size
    assert df.columns == ["id", "a\nb", "c"]
    assert cells(df.selectExpr("cast(id as string)", "`a\nb`", "c")) == sorted(rows, key=str)


def test_equals_the_reader_of_whole_files(spark, base):
    text = (
        'k,v,w\n1,plain 5" pipe,x\n2,"two\r\nlines, and ""more""",y\n\n'
        '3,"a long cell\n' + "with many lines\n" * 15 + 'in it",z\n4,,"last, without a line break"'
    )
    path = write(base, "m.csv", text.encode())
    whole = spark.read.csv(path, header=True, inferSchema=True, multiLine=True, escape='"', nullValue="", mode="FAILFAST")
    with small_splits(spark, 80):
        split = flat_file.read_flat_file(spark, path)
        assert split.dtypes == whole.dtypes and cells(split) == cells(whole)
        assert split.count() == 4


def test_carriage_returns_end_records_and_stay_in_quotes(spark, base):
    path = write(base, "c.csv", b'k,v\r\n1,"a\r\nb"\r\n\r\n2,c\r\n')
    with small_splits(spark, 11):
        assert cells(flat_file.read_flat_file(spark, path)) == [(1, "a\r\nb"), (2, "c")]


def test_several_files_each_lose_their_header(spark, base):
    (base_dir := __import__("pathlib").Path(f"{base}/many")).mkdir()
    for i in range(3):
        write(str(base_dir), f"{i}.csv", f'\nk,v\n{i},"a\nb"\n{i + 10},k\n'.encode())
    with small_splits(spark, 15):
        df = flat_file.read_flat_file(spark, f"{base}/many")
        found = cells(df)
    assert df.columns == ["k", "v"]
    assert found == sorted([(i, "a\nb") for i in range(3)] + [(i + 10, "k") for i in range(3)], key=str)


def test_cp1252_records_across_splits(spark, base):
    text = "naïve –,n\n" + "".join(f'"€{i}\n“é”",{i}\n' for i in range(30))
    path = write(base, "w.csv", text.encode("cp1252"))
    with small_splits(spark, 90):
        found = cells(flat_file.read_flat_file(spark, path))
    assert found == sorted([(f"€{i}\n“é”", i) for i in range(30)], key=str)


def test_typed_tables_with_line_breaks_are_read_in_splits(spark, base):
    text = "k,n\n" + "".join(f'"a{i}\nb",{i}\n' for i in range(50))
    path = write(base, "t.csv", text.encode())
    with small_splits(spark, 100):
        found = csv_tables.read_csv_table(spark, path, [("k", "varchar(9)"), ("n", "int")], multiline=True)
        assert cells(found) == sorted([(f"a{i}\nb", i) for i in range(50)], key=str)


def test_empty_and_header_only_files(spark, base):
    header = flat_file.read_flat_file(spark, write(base, "h.csv", b"a,b\n"))
    assert header.columns == ["a", "b"] and header.count() == 0
    assert spark.conf.get("spark.sql.files.minPartitionNum", None) is None


def test_an_open_quote_runs_to_the_end_of_its_file(spark, base):
    path = write(base, "o.csv", b'k\nx\n"y\nz\n' + b"w\n" * 20)
    with small_splits(spark, 16):
        records, _ = split_csv.read_records(spark, path)
        found = sorted(r["record"] for r in records.collect())
    assert found == ['"y\nz\n' + "w\n" * 19 + "w", "x"]


def test_states_before_equal_a_walk():
    rng = np.random.default_rng(3)
    for n in (0, 1, 5, 40):
        opens, stays = rng.random(n) < 0.4, rng.random(n) < 0.6
        for state in (False, True):
            walk = [state]
            for o, s in zip(opens, stays, strict=True):
                walk.append(bool(s if walk[-1] else o))
            assert split_csv.states_before(opens, stays, state).tolist() == walk
