import csv
import random

import pytest

from tidemark.sources.quoted import ends_inside, scan_quoted


@pytest.fixture(params=[37, 200, 1 << 20])
def split_bytes(spark, request):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = [spark.conf.get(n) for n in names]
    spark.conf.set(names[0], request.param)
    spark.conf.set(names[1], 1)
    yield request.param
    for n, v in zip(names, old):
        spark.conf.set(n, v)


def some_rows(n, seed):
    pick = random.Random(seed)
    parts = ["a", "b c", '"', '""', "\n", "\n\n", "\r\n", "\t", ",", 'say "so"', "é", "x" * 60 + "\n" + "y" * 60]
    return [[str(i), *("".join(pick.choice(parts) for _ in range(pick.randrange(1, 6))).strip("\r") for _ in range(3))] for i in range(n)]


@pytest.mark.parametrize("sep", ["\t", ","])
def test_any_split_gives_the_same_rows(spark, tmp_path, split_bytes, sep):
    want = []
    for n, end in ((0, "\n"), (1, "\r\n"), (2, "\n")):
        rows = some_rows(40, n) + [["q", 'in 6" of', "z", "z"]]
        with open(tmp_path / f"f{n}.csv", "w", newline="") as file:
            writer = csv.writer(file, delimiter=sep, lineterminator=end)
            writer.writerow(["k", "a", "b", "c"])
            writer.writerows(rows)
            # A quote within a field that is not quoted is a letter; a blank line is nothing.
            file.write(end + sep.join(["u", 'a 5" b', 'c "d"', "e"]) + (end if n else ""))
        want += [(f"f{n}.csv", *(x or None for x in r)) for r in rows] + [(f"f{n}.csv", "u", 'a 5" b', 'c "d"', "e")]
    paths = [str(tmp_path / f"f{n}.csv") for n in range(3)]
    got = [tuple(r) for r in scan_quoted(spark, paths, sep).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_open_quote_and_odd_records(spark, tmp_path, split_bytes):
    (tmp_path / "a.csv").write_text('k\tv\n1\t"open\nuntil the end\n' + "more\n" * 30)
    assert [tuple(r) for r in scan_quoted(spark, [str(tmp_path / "a.csv")]).select("k").collect()] == [("1",)]
    (tmp_path / "b.csv").write_text("k\tv\n1\t2\t3\n")
    with pytest.raises(Exception):
        scan_quoted(spark, [str(tmp_path / "b.csv")]).collect()
    (tmp_path / "c.csv").write_text("k\tv\n")
    assert scan_quoted(spark, [str(tmp_path / "c.csv")]).count() == 0


def test_state_at_the_end_of_a_line():
    for line, out, in_ in (
        ("a\tb", False, True), ('"a', True, False), ('a"b', False, False), ('a\t"b', True, False), ('""', False, True), ('"a""', True, False),
        ('x"\t"y', True, True), ('"a"\t"b"', False, False), ('a\t""', False, True), ('""\t"', True, False),
    ):
        assert (ends_inside(line, False, "\t"), ends_inside(line, True, "\t")) == (out, in_), line
