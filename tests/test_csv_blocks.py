"""One CSV file by many tasks, equal to the reader that takes a file by one task."""

import csv
import io
import itertools
import random

import pytest

from quarrymill.sources import csv_blocks, readers


@pytest.fixture()
def small_blocks(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "257", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def plain(line, inside):
    """A line by a machine of one character at a time."""
    state = "quoted" if inside else "begin"
    i = 0
    while i < len(line):
        c = line[i]
        if state == "quoted":
            if c == '"':
                if line[i + 1 : i + 2] == '"':
                    i += 1
                else:
                    state = "closed"
        elif c == ",":
            state = "begin"
        elif state == "begin":
            state = "quoted" if c == '"' else "bare"
        i += 1
    return state == "quoted"


def test_every_short_line():
    for n in range(8):
        for chars in itertools.product('a",', repeat=n):
            line = "".join(chars)
            assert [csv_blocks.ends_inside(line, s) for s in (False, True)] == [plain(line, s) for s in (False, True)], line


def test_long_lines_take_linear_time():
    for line in ('"' + 'a""' * 200_000, 'a,"b",' * 100_000, '"' * 300_001, 'x"' * 200_000):
        assert [csv_blocks.ends_inside(line, s) for s in (False, True)] == [plain(line, s) for s in (False, True)]


def _rows(seed, n):
    r = random.Random(seed)
    value = lambda: "".join(r.choice(["a", "b", '"', '""', ",", "\n", "\n\n", " ", "é", "x" * r.randrange(40), '",', '\n"']) for _ in range(r.randrange(7)))
    return [[str(i), value(), value(), value() if r.random() < 0.9 else "long\n" * 150] for i in range(n)]


def _text(rows):
    out = io.StringIO()
    csv.writer(out, lineterminator="\n", quoting=csv.QUOTE_ALL).writerows(rows)
    return out.getvalue()


def _got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_equal_to_one_task(spark, tmp_path, small_blocks, seed):
    names = ("id", "a", "b", "c")
    for k in range(3):
        (tmp_path / f"{k}.csv").write_text(_text(_rows(seed * 10 + k, 60)))
    paths = [str(tmp_path / f"{k}.csv") for k in range(3)]
    whole = spark.read.schema(readers.text_schema(names)).option("escape", '"').option("multiLine", True).csv(paths)
    split = readers.read_csv(spark, paths, names)
    assert split.rdd.getNumPartitions() > 3 and csv_blocks._lines(spark, paths).rdd.getNumPartitions() > 20
    assert _got(split) == _got(whole)
    want = [tuple(x or None for x in r) for k in range(3) for r in _rows(seed * 10 + k, 60)]
    assert sorted((tuple(x or None for x in r) for r in _got(split)), key=repr) == sorted(want, key=repr)


def test_places_follow_the_file(spark, tmp_path, small_blocks):
    (tmp_path / "a.csv").write_text(_text(_rows(5, 80)))
    rows = csv_blocks.split_records(spark, str(tmp_path / "a.csv")).orderBy(csv_blocks.PLACE).collect()
    assert [r[csv_blocks.RECORD].split(",")[0] for r in rows] == [f'"{i}"' for i in range(80)] and len({r[csv_blocks.PLACE] for r in rows}) == 80


def test_a_value_over_many_blocks(spark, tmp_path, small_blocks):
    big = "line of the value\n" * 300
    (tmp_path / "a.csv").write_text(f'1,"{big}"\n2,"b"\n\n3,"{big}","""x"\n')
    got = {r.id: r.a for r in readers.read_csv(spark, str(tmp_path / "a.csv"), ("id", "a")).collect()}
    assert got == {"1": big, "2": "b", "3": big}


def test_windows_line_ends_and_stray_quotes(spark, tmp_path, small_blocks):
    text = "".join(f'{i},"two\r\nlines","q""q"\r\n{i},it is 5" long,x\r\n' for i in range(40))
    (tmp_path / "a.csv").write_bytes(text.encode())
    whole = spark.read.schema(readers.text_schema(("id", "a", "b"))).option("escape", '"').option("multiLine", True).csv(str(tmp_path / "a.csv"))
    assert _got(readers.read_csv(spark, str(tmp_path / "a.csv"), ("id", "a", "b"))) == _got(whole) and whole.count() == 80


@pytest.mark.parametrize("large", [False, True])
def test_files_with_headers_of_their_own(spark, tmp_path, request, large):
    if large:
        request.getfixturevalue("small_blocks")
    body = lambda names, k: _text([names, *([{"id": f"{k}-{i}", "a": f"a\n{i}", 'b"x': f'b"{i}', "more": "m"}[n] for n in names] for i in range(20))])
    for k, names in enumerate((["id", "a", 'b"x'], ['b"x', "id", "a"], ["a", "id", "more", 'b"x'])):
        (tmp_path / f"{k}.csv").write_text(body(names, k))
    want = sorted((f"{k}-{i}", f"a\n{i}", f'b"{i}') for k in range(3) for i in range(20))
    got = readers.read_csv(spark, str(tmp_path), ("id", "a", 'b"x'), has_header=True, file="_f")
    assert sorted((r.id, r.a, r['b"x']) for r in got.collect()) == want and got.columns[-1] == "_f"
    every = readers.read_csv(spark, str(tmp_path), has_header=True)
    assert set(every.columns) == {"id", "a", 'b"x', "more"} and every.where("more = 'm'").count() == 20 and sorted(r.id for r in every.collect()) == sorted(x[0] for x in want)
    # Names that no file has go by place.
    other = readers.read_csv(spark, str(tmp_path / "0.csv"), ("x", "y", "z"), has_header=True)
    assert sorted((r.x, r.y, r.z) for r in other.collect()) == want[:20]


def test_array_lines_with_headers_of_their_own(spark, tmp_path):
    (tmp_path / "0.txt").write_text('["a", "b"]\n["1", "2"]\n')
    (tmp_path / "1.txt").write_text('\n["b", "a"]\n["4", "3"]\n["b", "a"]\n')
    (tmp_path / "2.txt").write_text('["b", "c"]\n["5", "6"]\n')
    got = readers.read_jsonlistline(spark, str(tmp_path))
    assert got.columns == ["a", "b", "c"] or set(got.columns) == {"a", "b", "c"}
    assert sorted(((r.a, r.b, r.c) for r in got.collect()), key=repr) == sorted([("1", "2", None), ("3", "4", None), ("a", "b", None), (None, "5", "6")], key=repr)
    some = readers.read_jsonlistline(spark, [str(tmp_path / "0.txt"), str(tmp_path / "1.txt")], ("b", "a"))
    assert sorted((r.b, r.a) for r in some.collect()) == [("2", "1"), ("4", "3"), ("b", "a")]
    assert readers.read_jsonlistline(spark, str(tmp_path / "0.txt"), ("x", "y")).first().asDict() == {"x": "1", "y": "2"}
