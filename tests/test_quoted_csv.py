"""Splittable quoted CSV: the same rows as a reader that goes through each file from its start."""

import random

import pytest

from tessera.sources import files, quoted_csv

SCHEMA = "k int, t string, v double, u string"


def _plain(spark, path):
    return spark.read.options(**files.CSV_OPTIONS).schema(SCHEMA).csv(path)


def _rows(df):
    return sorted(map(repr, df.collect()))


@pytest.fixture()
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("breaks", [0.0, 0.05, 0.7])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_same_rows_as_a_sequential_reader(spark, tmp_path, small_splits, breaks, end):
    rnd = random.Random(int(breaks * 100))
    for f in range(3):
        lines = ['k,t,"v",u']
        for i in range(150):
            text = "".join(rnd.choice(['a', 'bé', ' ', ',', '""', "x" * 20, "\\"]) for _ in range(rnd.randint(0, 6)))
            if rnd.random() < breaks:  # up to many splits long
                text += "\n" * rnd.randint(1, 3) + 'say ""k,t,v,u""\n' + "long\n" * rnd.choice([0, 1, 200])
            lines.append(f'{f * 1000 + i},"{text}",{rnd.choice(["1.5", "inf", "", "nan"])},{rnd.choice(["", "plain", chr(34) * 2])}')
            if rnd.random() < 0.05:
                lines.append("")
        (tmp_path / f"p{f}.csv").write_bytes((end.join(lines) + (end if f else "")).encode())
    got = files.read_csv(spark, str(tmp_path), SCHEMA)
    want = _plain(spark, str(tmp_path))
    assert want.count() == 450 and _rows(got) == _rows(want)
    assert got.rdd.getNumPartitions() > 20 > want.rdd.getNumPartitions()


def test_a_header_over_two_lines_and_no_rows(spark, tmp_path, small_splits):
    (tmp_path / "a.csv").write_text('"k\nkey",t,v,u\n1,"x\ny",2,z\n')
    assert [tuple(r) for r in files.read_csv(spark, str(tmp_path / "a.csv"), SCHEMA).collect()] == [(1, "x\ny", 2.0, "z")]
    (tmp_path / "b.csv").write_text("k,t,v,u\n")
    assert files.read_csv(spark, str(tmp_path / "b.csv"), SCHEMA).count() == 0


def test_a_changed_split_size_is_an_error(spark, tmp_path, small_splits):
    (tmp_path / "a.csv").write_text("k,t,v,u\n" + "1,x,2,y\n" * 200)
    df = files.read_csv(spark, str(tmp_path / "a.csv"), SCHEMA)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100")
    with pytest.raises(Exception, match="split size"):
        df.count()


def test_without_line_breaks(spark, tmp_path, small_splits):
    (tmp_path / "a.csv").write_text("k,t,v,u\n" + '1,"x, ""y""",2,y\n' * 200)
    got = files.read_csv(spark, str(tmp_path / "a.csv"), SCHEMA, line_breaks=False)
    assert _rows(got) == _rows(_plain(spark, str(tmp_path / "a.csv"))) and got.rdd.getNumPartitions() > 8


def test_least_types(spark):
    columns = {"int": ["1", "-2147483648", None], "bigint": ["1", "2147483648", "+7"], "double": ["1", "2.5e3", "inf"], "string": ["1", "x", None], "date": ["2020-01-31", None, "1999-12-01"],
               "timestamp": ["2020-01-31", "2020-01-31 10:00:00", "2020-01-31T10:00"], "boolean": ["true", "FALSE", None], "wide": ["99999999999999999999", "1", "2"], "mixed": ["1", "2020-01-31", None],
               "noday": ["2020-02-31", "2020-01-01", None], "none": [None, None, None], "flag": ["true", "1", None]}
    df = spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"`{c}` string" for c in columns))
    got = {f.name: f.dataType.simpleString() for f in quoted_csv.least_types(df).fields}
    assert got == {c: c for c in columns if c not in ("wide", "mixed", "noday", "none", "flag")} | {"wide": "double", "mixed": "string", "noday": "string", "none": "string", "flag": "string"}
