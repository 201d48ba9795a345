"""Strict delimited source."""
import csv
import io
import os
import random
import tempfile

import pytest

from otif.sources.csv import read_extract
from otif.sources.digest import assert_unchanged, fingerprints


def write(text, name="x.csv"):
    d = tempfile.mkdtemp(prefix="otif-csv-")
    p = os.path.join(d, name)
    with open(p, "w", encoding="utf-8", newline="") as f:
        f.write(text)
    return p


def test_bom_quotes_blank_lines_and_empty_fields(spark):
    p = write('﻿LIFNR;NAME1;LAND1\n0001;"A ""quoted"" ; name";DE\n\n0002;;\n')
    rows = read_extract(spark, p).orderBy("LIFNR").collect()
    assert [r.LIFNR for r in rows] == ["0001", "0002"]  # leading zeros kept, blank line skipped
    assert rows[0].NAME1 == 'A "quoted" ; name'
    assert rows[1].NAME1 is None and rows[1].LAND1 is None
    assert rows[0]._source_file.endswith("x.csv") and rows[0]._loaded_at is not None


def test_wrong_field_count_fails(spark):
    with pytest.raises(Exception):
        read_extract(spark, write("A;B\n1;2;3\n")).collect()
    with pytest.raises(Exception):
        read_extract(spark, write("A;B\n1\n")).collect()


@pytest.mark.parametrize("header", ["A;A", "A;;B", "A;_B"])
def test_header_contract(spark, header):
    with pytest.raises(ValueError):
        read_extract(spark, write(header + "\n1;2;3\n"))


def test_fingerprint_changes_with_content(spark):
    p = write("A\n1\n")
    first = fingerprints(spark, [p]).first().content_digest
    with open(p, "a") as f:
        f.write("2\n")
    assert fingerprints(spark, [p]).first().content_digest != first


def test_unchanged_sources_pass_and_changes_fail(spark):
    p = write("A\n1\n")
    snapshot = os.path.join(tempfile.mkdtemp(prefix="otif-fp-"), "before")
    fingerprints(spark, [p]).write.parquet(snapshot)
    before = spark.read.parquet(snapshot)
    assert_unchanged(before, fingerprints(spark, [p]))
    with open(p, "a") as f:
        f.write("2\n")
    with pytest.raises(ValueError):
        assert_unchanged(before, fingerprints(spark, [p]))


@pytest.mark.parametrize("line", ["1;2;3", "1"])
def test_wrong_field_count_fails_with_pruned_columns(spark, line):
    rows = read_extract(spark, write(f"A;B\n1;2\n{line}\n"))
    with pytest.raises(Exception):
        rows.select("A").collect()
    with pytest.raises(Exception):
        rows.count()


def test_fingerprint_sees_one_changed_character(spark):
    lines = [f"{i};x" for i in range(5000)]
    p = write("\n".join(lines))
    lines[4000] = "4000;y"
    q = write("\n".join(lines))
    found = {r.path.rsplit("/", 2)[1]: r for r in fingerprints(spark, [p, q]).collect()}
    a, b = (found[os.path.basename(os.path.dirname(x))] for x in (p, q))
    assert a.length == b.length and a.content_digest != b.content_digest


def random_rows(n, seed=3):
    rnd = random.Random(seed)
    values = ["", "plain", "a;b", 'say "hi"', "two\nlines", 'x\n"q";\n\ny', '"', ";", "\n", '5" pipe', "end\r\nnext", "é", '""', '";"']
    return [(str(i), *rnd.choices(values, k=3)) for i in range(n)]


def quoted_file(rows, name="q.csv"):
    text = io.StringIO(newline="")
    csv.writer(text, delimiter=";", lineterminator="\n").writerows([("A", "B", "C", "D"), *rows])
    return write("﻿" + text.getvalue(), name)


@pytest.fixture
def split_bytes(spark):
    """Sets the size of a file's splits; the session's own sizes come back afterwards."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}

    def set_to(size):
        spark.conf.set(names[0], size)
        spark.conf.set(names[1], "1")

    yield set_to
    for n, v in before.items():
        spark.conf.set(n, v)


@pytest.mark.parametrize("size", ["211", "4k", "64m"])
def test_quoted_line_breaks_over_splits(spark, split_bytes, size):
    rows = random_rows(800)
    path = quoted_file(rows)
    split_bytes(size)
    if size == "211":
        assert spark.read.text(path).rdd.getNumPartitions() > 50
    got = read_extract(spark, path, multiline=True)
    assert got.columns[:4] == ["A", "B", "C", "D"] and {"_source_file", "_loaded_at"} <= set(got.columns)
    assert sorted((tuple(r)[:4] for r in got.collect()), key=str) == sorted((tuple(v or None for v in r) for r in rows), key=str)


def test_quoted_line_breaks_over_several_files(spark, split_bytes):
    rows = random_rows(300, 5)
    folder = os.path.dirname(quoted_file(rows[:150], "a.csv"))
    os.replace(quoted_file(rows[150:], "b.csv"), os.path.join(folder, "b.csv"))
    split_bytes("500")
    got = read_extract(spark, folder, ["A", "B", "C", "D"], multiline=True)
    assert sorted((tuple(r)[:4] for r in got.collect()), key=str) == sorted((tuple(v or None for v in r) for r in rows), key=str)


def test_a_quoted_field_that_never_ends_fails(spark):
    with pytest.raises(ValueError, match="never ends"):
        read_extract(spark, write('A;B\n1;"two\n3;4\n'), multiline=True)


@pytest.mark.parametrize("line", ["1;2;3", "1", '1;"a\nb";3'])
def test_wrong_field_count_fails_over_lines(spark, line):
    with pytest.raises(Exception):
        read_extract(spark, write(f'A;B\n1;"x\ny"\n{line}\n'), multiline=True)


def test_another_header_fails(spark):
    folder = os.path.dirname(write("A;B\n1;2\n", "a.csv"))
    with open(os.path.join(folder, "b.csv"), "w") as f:
        f.write("B;A\n1;2\n")
    with pytest.raises(Exception, match="another header"):
        read_extract(spark, folder, ["A", "B"], multiline=True)


def test_digest_depends_on_order_and_not_on_splits(spark, split_bytes):
    lines = [f"{i};x" for i in range(5000)]
    path = write("\n".join(["A;B", *lines]) + "\n")

    def digest():
        return fingerprints(spark, [path]).first().content_digest

    split_bytes("64m")
    whole = digest()
    split_bytes("700")
    assert digest() == whole
    for changed in (["A;B", lines[1], lines[0], *lines[2:]], [lines[0], "A;B", *lines[1:]], ["A;B", *lines, ""]):
        with open(path, "w") as f:
            f.write("\n".join(changed) + "\n")
        assert digest() != whole
    with open(path, "w") as f:
        f.write("\n".join(["A;B", *lines]))  # no line end after the last line
    assert digest() != whole


def test_digest_of_an_empty_file(spark):
    folder = os.path.dirname(write("A\n1\n", "full.csv"))
    open(os.path.join(folder, "empty.csv"), "w").close()
    found = {r.path.rsplit("/", 1)[1]: r for r in fingerprints(spark, [folder]).collect()}
    assert set(found) == {"full.csv", "empty.csv"} and found["empty.csv"].length == 0
    assert found["empty.csv"].content_digest and found["empty.csv"].content_digest != found["full.csv"].content_digest
