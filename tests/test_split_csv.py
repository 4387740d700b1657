"""The reader of many tasks against Spark's own reader of one task a file."""

import csv
import io
import random

import pytest

from crossmart.sources import split_csv
from crossmart.sources.files import read_text_csv
from crossmart.sources.split_csv import read_split_csv, splittable, text_lines

COLUMNS = ["a", "b", "c"]
PIECES = ["x", "yy", "", '"', "\n", "\r\n", ",", "é", "日本", " ", "NA", "''", "\n\n", '""', "line one\nline two"]


def written(path, rows, order=(0, 1, 2), ending="\n", header=True):
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=ending, quoting=csv.QUOTE_MINIMAL)
    if header:
        writer.writerow([COLUMNS[i] for i in order])
    writer.writerows([[r[i] for i in order] for r in rows])
    path.write_text(out.getvalue(), encoding="utf-8", newline="")


def listed(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def small_blocks(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "997")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("seed,ending", [(1, "\n"), (2, "\r\n"), (3, "\n")])
def test_equals_the_reader_of_one_task(spark, tmp_path, small_blocks, seed, ending):
    rng = random.Random(seed)
    folder = tmp_path / "in"
    folder.mkdir()
    for f in range(3):
        rows = [["".join(rng.choices(PIECES, k=rng.randrange(5))) for _ in COLUMNS] for _ in range(120)]
        for r in rows:
            r[0] = f"k{rng.randrange(50)}" + r[0]
        written(folder / f"{f}.csv", rows, ending=ending)
    got = read_split_csv(spark, str(folder), COLUMNS)
    assert text_lines(spark, str(folder)).rdd.getNumPartitions() > 6
    assert listed(got) == listed(read_text_csv(spark, str(folder), COLUMNS))


def test_large_files_only_are_split(spark, tmp_path, small_blocks):
    rows = [[str(i), "x\ny", "z"] for i in range(200)]
    written(tmp_path / "large.csv", rows)
    written(tmp_path / "small.csv", rows[:20])
    assert splittable(spark, str(tmp_path)) and splittable(spark, str(tmp_path / "large.csv"))
    assert not splittable(spark, str(tmp_path / "small.csv"))


def test_a_field_longer_than_several_blocks(spark, tmp_path, small_blocks):
    rows = [["1", "short", "x"], ["2", "\n".join(["long, line"] * 700), 'q"q'], ["3", "\n" * 2500, "y"], ["4", "end", "z"]]
    written(tmp_path / "a.csv", rows)
    got = read_split_csv(spark, str(tmp_path / "a.csv"), COLUMNS)
    assert listed(got) == sorted((tuple(r) for r in rows), key=repr)


def test_quotes_that_close_and_open_on_one_line(spark, tmp_path, small_blocks):
    rows = [[str(i), "a\nb", "c\nd"] for i in range(300)]
    written(tmp_path / "a.csv", rows)
    assert listed(read_split_csv(spark, str(tmp_path / "a.csv"), COLUMNS)) == sorted((tuple(r) for r in rows), key=repr)


def test_files_with_their_own_column_order(spark, tmp_path):
    written(tmp_path / "a.csv", [["1", "x\ny", "3"]], order=(0, 1, 2))
    written(tmp_path / "b.csv", [["4", "5", "6"]], order=(2, 0, 1))
    assert listed(read_split_csv(spark, str(tmp_path / "*.csv"), COLUMNS)) == [("1", "x\ny", "3"), ("4", "5", "6")]


def test_empty_inputs_and_a_missing_column(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    written(tmp_path / "header.csv", [])
    assert read_split_csv(spark, str(tmp_path / "*.csv"), COLUMNS).count() == 0
    assert read_split_csv(spark, str(tmp_path / "empty.csv"), COLUMNS).count() == 0
    with pytest.raises(ValueError, match="no column"):
        read_split_csv(spark, str(tmp_path / "header.csv"), ["a", "other"])


def test_blank_lines_and_a_byte_order_mark(spark, tmp_path):
    (tmp_path / "a.csv").write_text('\ufeffa,b,c\n\n1,"x\n\ny",3\n\n\n4,,6', encoding="utf-8")
    assert listed(read_split_csv(spark, str(tmp_path / "a.csv"), COLUMNS)) == [("1", "x\n\ny", "3"), ("4", None, "6")]


def shuffled(df):
    """Exchanges by a key in the executed plan, without those of broadcasts."""
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_whole_lines_stay_and_parts_move_once(spark, tmp_path, small_blocks):
    """A file without broken lines is read without its lines meeting in a shuffle; broken ones move once by their block."""
    calm, broken = tmp_path / "calm.csv", tmp_path / "broken.csv"
    written(calm, [[str(i), 'x, "quoted"', "z"] for i in range(200)])
    written(broken, [[str(i), "x\ny", "z"] for i in range(200)])
    lines = split_csv.counted_lines(text_lines(spark, str(calm)))
    states = split_csv.block_states(lines)
    assert states.count() > 3 and states.where("mixed").count() == 0
    known = split_csv.block_states(split_csv.counted_lines(text_lines(spark, str(broken))))
    assert known.where("mixed").count() == known.count()
    for path in (calm, broken):
        got = read_split_csv(spark, str(path), COLUMNS)
        # the lines of mixed blocks by their block, ends of records by the block they go to, nothing else
        assert shuffled(got) == 2
        assert listed(got) == listed(read_text_csv(spark, str(path), COLUMNS))


def test_a_header_over_two_lines_and_blank_lines_before_it(spark, tmp_path, small_blocks):
    path = tmp_path / "in.csv"
    path.write_text("\n\r\n" + "\n" * 1500 + 'a,b,"c\nd"\n' + "".join(f'{i},"x\ny",z\n' for i in range(300)), encoding="utf-8", newline="")
    got = read_split_csv(spark, str(path), ["a", "b", "c\nd"])
    assert listed(got) == sorted([(str(i), "x\ny", "z") for i in range(300)], key=repr)
