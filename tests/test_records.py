"""Quoted fields with line breaks, compared with Python's csv reader."""

import csv
import io
import random
import zipfile

import pytest

from tempora.errors import IngestError
from tempora.sources import records
from tempora.sources.archives import read_archives
from tempora.sources.tagged import read_tagged_csv

HEAD = "I,D,A,1,NAME,NOTE,N\n"


def made(rows):
    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerows([["C", "x"], *rows])
    return HEAD + out.getvalue()


def plain(text):
    return [r for r in csv.reader(io.StringIO(text)) if r and r[0] == "D"]


def got(df):
    return [[r["RECORD_TYPE"], r["DATASET"], r["DATA_TYPE"], r["VERSION"], r["NAME"], r["NOTE"], r["N"]] for r in df.orderBy("SOURCE_FILE", "_position").collect()]


def random_rows(rnd, n):
    pieces = ["a", ",", '"', "\n", "\nD,fake,", ' "" ', "é", "5\" pipe", "\n\n", "I,"]
    return [["D", "d", "a", str(i), "".join(rnd.choice(pieces) for _ in range(rnd.randrange(6))), "".join(rnd.choice(pieces) for _ in range(rnd.randrange(4))), str(i)] for i in range(n)]


@pytest.mark.parametrize("split", ["48b", "1k", "128m"])
def test_records_over_lines_and_splits(spark, tmp_path, split):
    rnd = random.Random(split)
    texts = {f"f{k}.csv": made(random_rows(rnd, 40)) for k in range(3)}
    texts["g.csv"] = HEAD + 'D,d,a,1,5" pipe,x"y,7\nD,d,a,1,"one\ntwo","say ""hi""\n",8\n'
    texts["h.csv"] = HEAD + 'D,d,a,1,even "quotes" here,"open\nclosed",1\n'
    for name, text in texts.items():
        (tmp_path / name).write_text(text, encoding="utf-8", newline="")
    want = [r for name in sorted(texts) for r in plain(texts[name])]
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    try:
        assert got(read_tagged_csv(spark, str(tmp_path))) == want
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_records_over_lines_in_archives(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("tempora.sources.archives.BATCH_LINES", 3)
    text = made(random_rows(random.Random(1), 25))
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("x.csv", text)
        z.writestr("y.csv", HEAD + "D,d,a,1,plain,row,1\n")
    assert got(read_archives(spark, str(tmp_path))) == [*plain(text), ["D", "d", "a", "1", "plain", "row", "1"]]


def test_a_quote_that_never_closes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(records, "MOST_LINES", 50)
    (tmp_path / "a.csv").write_text(HEAD + 'D,d,a,1,"open,x,1\n' + "D,d,a,1,n,x,1\n" * 80)
    with pytest.raises(IngestError, match="more than 50 lines: a.csv"):
        read_tagged_csv(spark, str(tmp_path))


def test_line_maps(spark):
    cases = {'a,b': False, '"a","b"': False, '"a': True, 'a,"b': True, 'a"b,"c': True, 'a"b': False, '"a""': True, '"a"""': False, ',"': True, '"a"x,"': True, "": False, '"a, b': True}
    rows = spark.createDataFrame([(k,) for k in cases], "v string")
    assert {r["v"]: r["o"] for r in rows.select("v", records.ends_open(rows["v"]).alias("o")).collect()} == cases


def test_lines_are_ordered_and_joined_once(spark, tmp_path):
    """What reads the records goes over stored ones: the windows and groups that made them do not run again."""
    text = made(random_rows(random.Random(9), 60))
    (tmp_path / "a.csv").write_text(text, encoding="utf-8", newline="")
    (tmp_path / "b.csv").write_text(HEAD + "D,d,a,1,plain,row,1\n")
    found = read_tagged_csv(spark, str(tmp_path))
    assert got(found) == [*plain(text), ["D", "d", "a", "1", "plain", "row", "1"]]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Aggregate" not in plan
