"""Split reading of quoted CSV against Spark's reading of whole files."""

import random
import re

import pyarrow as pa
import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from lendspark.sources import readers, split_csv

QUOTED = ["a,b", 'say ""hi""', "", "line\nbreak", 'a\n\n"",""\n', "\n", 'x\n,y\n"" z', " \n ", '""', '","', '\n","']
PLAIN = ["", "a", "12", "x y", '5" pipe', "é", 'a"b"c', "0.5"]


@pytest.fixture
def split_bytes(spark):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    yield lambda size: spark.conf.set(key, str(size))
    spark.conf.set(key, before)


def content(n, line_end="\n", seed=1):
    random.seed(seed)
    cell = lambda: f'"{random.choice(QUOTED)}"' if random.random() < 0.4 else random.choice(PLAIN)
    return "a,b,c\n".replace("\n", line_end) + line_end.join(f"{i},{cell()},{cell()}" for i in range(n)) + line_end


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("line_end", ["\n", "\r\n"])
def test_same_records_at_any_split_size(spark, tmp_path, split_bytes, line_end):
    file = tmp_path / "raw.csv"
    file.write_bytes(content(150, line_end).encode())
    whole = rows(spark.read.csv(str(file), multiLine=True, header=True, **split_csv.OPTIONS))
    for size in (200, 1500, 1 << 20):
        split_bytes(size)
        found = readers.read_raw_csv(spark, str(file), ["a", "b", "c"])
        assert rows(found) == whole
        if size == 200:
            assert found.rdd.getNumPartitions() > 2


def test_a_record_over_many_splits_and_several_files(spark, tmp_path, split_bytes):
    long = '"' + "one line, with \"\"marks\"\"\n" * 60 + '"'
    (tmp_path / "1.csv").write_text(f"a,b\n1,{long}\n2,x\n\n  \n3,{long}")
    (tmp_path / "2.csv").write_text('a,b\n4,"y"\n')
    (tmp_path / "3.csv").write_text("a,b\n")
    whole = rows(spark.read.csv(str(tmp_path), multiLine=True, header=True, **split_csv.OPTIONS))
    assert len(whole) == 5
    for size in (250, 1 << 20):
        split_bytes(size)
        assert rows(readers.read_raw_csv(spark, str(tmp_path), ["a", "b"])) == whole


def test_lines_that_are_records_are_left_to_spark(spark, tmp_path):
    file = tmp_path / "raw.csv"
    file.write_text('a,b\n1,"x, y"\n2,"say ""hi"""\n3,5" pipe\n')
    assert split_csv.whole_records(spark, str(file)) is None
    assert rows(readers.read_raw_csv(spark, str(file), ["b"])) == sorted([("x, y",), ('say "hi"',), ('5" pipe',)], key=repr)
    file.write_text("")
    assert split_csv.whole_records(spark, str(file)) is None


def test_typed_records_over_several_lines(spark, tmp_path):
    file = tmp_path / "typed.csv"
    file.write_text('a,b\n1,"two\nlines"\n,z\n')
    assert rows(readers.load_typed_csv(spark, str(file), "a INT, b STRING")) == [(1, "two\nlines"), (None, "z")]
    for schema in ("a INT, c STRING", "b INT, a STRING", "a INT", "a INT, b STRING, c INT", "a INT, b DATE"):
        with pytest.raises((PySparkException, Py4JJavaError)):
            readers.load_typed_csv(spark, str(file), schema).collect()


def test_how_a_line_turns():
    """The patterns against a walk over the characters."""

    def walk(line, within):
        at, start = 0, not within
        while at < len(line):
            if within:
                if line[at] == '"':
                    if line[at + 1 : at + 2] == '"':
                        at += 1
                    else:
                        within, start = False, False
            elif line[at] == '"' and start:
                within = True
            elif line[at] == ",":
                start = True
            else:
                start = False
            at += 1
        return within

    random.seed(7)
    lines = ["".join(random.choices('",a \r', k=random.randint(0, 12))) for _ in range(4000)]
    opens, stays = split_csv._turns(pa.array([x.encode() for x in lines], pa.binary()))
    assert opens.tolist() == [walk(x, False) for x in lines]
    assert stays.tolist() == [walk(x, True) for x in lines]
    assert re.compile(split_csv.ENDS_OPEN) and not opens[lines.index(min(lines, key=len))]


def test_the_scan_over_splits(spark):
    import pandas as pd

    steps = pd.DataFrame(
        [(1, 0, True, True, True, False), (1, 10, False, False, False, True), (1, 20, True, False, True, True), (1, 30, False, False, True, False)],
        columns=["file", "split", "opens", "after_outside", "closes", "after_within"],
    )
    found = split_csv._scan(steps.sample(frac=1, random_state=1))
    assert found.values.tolist() == [
        [1, 0, False, True, -1],
        [1, 10, True, True, 0],
        [1, 20, True, True, 0],
        [1, 30, True, False, 20],
    ]


def test_states_after_lines():
    """As one line after another gives them."""
    import numpy as np

    rng = np.random.default_rng(3)
    for n in (1, 2, 30):
        for within in (False, True):
            opens, stays = rng.random((2, n)) < [[0.3], [0.7]]
            state, expected = within, []
            for k in range(n):
                state = bool(stays[k] if state else opens[k])
                expected.append(state)
            assert split_csv._after(within, opens, stays).tolist() == expected


def test_records_of_many_lines_leave_in_few_batches():
    lines = [x.encode() for k in range(500) for x in (f'{k},"one', 'two"', f"{k},plain", "")]
    n = len(lines)
    batch = pa.record_batch(
        [pa.array([1] * n), pa.array([0] * n), pa.array(lines, pa.binary()), pa.array([False] * n), pa.array([-1] * n)],
        names=["file", "split", "line", "begins_within", "opener"],
    )
    found = list(split_csv._assemble(iter([batch])))
    assert len(found) == 1
    assert found[0].num_rows == 1000 and all(found[0].column("whole").to_pylist())
    assert found[0].column("record").to_pylist()[:3] == [b'0,"one\ntwo"', b"0,plain", b'1,"one\ntwo"']
    assert found[0].column("head").to_pylist().index(True) == 0
