import datetime as dt
import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from tempora.errors import IngestError
from tempora.plans.demand import clean_demand
from tempora.schemas import HOURLY_VARIABLES
from tempora.sources.archives import expand_archives, read_archives
from tempora.sources.columnar import check_request, read_columnar_json
from tempora.sources.tagged import header_names, ingest_summary, read_tagged_csv

HEAD = "I,DEMAND,ACTUAL,3,REGIONID,INTERVAL_DATETIME,OPERATIONAL_DEMAND,OPERATIONAL_DEMAND_ADJUSTMENT,WDR_ESTIMATE,LASTCHANGED"


def data(region, hour, value):
    return f'D,DEMAND,ACTUAL,3,{region},"2024/01/01 {hour:02d}:00:00",{value},0,0,"2024/01/01 12:00:00"'


def report(*rows, head=HEAD):
    return "\n".join(["C,SYSTEM,REPORT", head, *rows, 'C,"END OF REPORT",9']) + "\n"


def write(folder, name, text, encoding="utf-8"):
    (folder / name).write_bytes(text.encode(encoding) if isinstance(text, str) else text)


def test_tagged_csv(spark, tmp_path):
    write(tmp_path, "b.CSV", report(data("A", 1, 10), "", data("B", 1, 20)), "utf-8-sig")
    write(tmp_path, "a.csv", report(data("A", 2, 30)).replace("\n", "\r\n"))
    write(tmp_path, "ignored.txt", "nothing")
    (tmp_path / "sub").mkdir()
    write(tmp_path / "sub", "c.csv", report(data("A", 3, 40)))
    df = read_tagged_csv(spark, str(tmp_path))
    assert df.columns[:5] == ["RECORD_TYPE", "DATASET", "DATA_TYPE", "VERSION", "REGIONID"]
    rows = df.orderBy("SOURCE_FILE", "_position").collect()
    assert [(r["SOURCE_FILE"], r["REGIONID"], r["OPERATIONAL_DEMAND"]) for r in rows] == [
        ("a.csv", "A", "30"), ("b.CSV", "A", "10"), ("b.CSV", "B", "20"),
    ]
    assert rows[0]["INTERVAL_DATETIME"] == "2024/01/01 02:00:00"
    assert ingest_summary(df).first().asDict() == {"archives": 0, "nested_archives": 0, "files": 2, "data_rows": 3}
    assert clean_demand(df, "A").count() == 2


def test_single_file_and_values_stay_text(spark, tmp_path):
    line = 'D,DEMAND,ACTUAL,3," A ","say ""hi"", ok",007,,NULL,x'
    write(tmp_path, "one.csv", report(line))
    row = read_tagged_csv(spark, str(tmp_path / "one.csv")).first()
    assert row["REGIONID"] == " A " and row["INTERVAL_DATETIME"] == 'say "hi", ok'
    assert (row["OPERATIONAL_DEMAND"], row["OPERATIONAL_DEMAND_ADJUSTMENT"], row["WDR_ESTIMATE"]) == ("007", "", "NULL")


def test_different_headers_align_by_name_and_the_last_header_wins(spark, tmp_path):
    write(tmp_path, "a.csv", "I,D,A,1,X,Y\nD,D,A,1,x1,y1\nI,D,A,1,P,Q\n")
    write(tmp_path, "b.csv", "I,D,A,1,Q,Z\nD,D,A,1,q2,z2\n")
    df = read_tagged_csv(spark, str(tmp_path))
    got = {r["SOURCE_FILE"]: (r["P"], r["Q"], r["Z"]) for r in df.collect()}
    assert got == {"a.csv": ("x1", "y1", None), "b.csv": (None, "q2", "z2")}
    assert "X" not in df.columns
    assert header_names("anything,x,y,z,K") == ["RECORD_TYPE", "DATASET", "DATA_TYPE", "VERSION", "K"]


@pytest.mark.parametrize(
    "text, message",
    [
        ("C,only\nD,a,b,c,d\n", "no header"),
        ("I,a,b\nD,a,b\n", "fewer than four"),
        ("I,a,b,c,d\nC,x\n", "no data"),
        ("", "no header"),
        ("\n\n", "no header"),
        ("I,a,b,c,d\nD,a,b,c,\xff\n".encode("latin-1"), "UTF-8"),
    ],
)
def test_layout_errors(spark, tmp_path, text, message):
    write(tmp_path, "good.csv", report(data("A", 1, 1)))
    write(tmp_path, "zbad.csv", text)
    with pytest.raises(IngestError, match=message):
        read_tagged_csv(spark, str(tmp_path))


@pytest.mark.parametrize("line", ["D,a,b,c", "D,a,b,c,d,e"])
def test_field_count_errors(spark, tmp_path, line):
    write(tmp_path, "bad.csv", f"I,a,b,c,K\nD,a,b,c,1\n{line}\n")
    with pytest.raises(IngestError, match="^1 data records.*bad.csv"):
        read_tagged_csv(spark, str(tmp_path), eager=True)
    lazy = read_tagged_csv(spark, str(tmp_path))
    for action in (lambda: lazy.collect(), lambda: lazy.select("K").collect(), lambda: lazy.select("SOURCE_FILE").collect()):
        with pytest.raises(Exception, match="field count differs from the header: bad.csv"):
            action()


def test_no_files(spark, tmp_path):
    with pytest.raises(IngestError, match="no CSV"):
        read_tagged_csv(spark, str(tmp_path))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_tagged_csv(spark, str(tmp_path / "nowhere"))


def zipped(members):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        for name, content in members.items():
            z.writestr(name, content)
    return buffer.getvalue()


def test_nested_archives(spark, tmp_path):
    day = zipped({"x.CSV": report(data("A", 1, 10)).encode("utf-8-sig"), "notes.txt": "n", "__MACOSX/x.csv": "junk"})
    write(tmp_path, "m1.zip", zipped({"d1.zip": day, "folder/": "", "direct.csv": report(data("A", 2, 20), data("B", 2, 5))}))
    bad_bytes = report(data("A", 3, 30)).encode() + b"C,\xff\n"
    write(tmp_path, "m2.ZIP", zipped({"plain.csv": bad_bytes, "__MACOSX/d.zip": b"junk"}))
    df = read_archives(spark, str(tmp_path))
    got = sorted((r["SOURCE_FILE"], r["OPERATIONAL_DEMAND"]) for r in df.collect())
    assert got == [("m1.zip/d1.zip/x.CSV", "10"), ("m1.zip/direct.csv", "20"), ("m1.zip/direct.csv", "5"), ("m2.ZIP/plain.csv", "30")]
    assert ingest_summary(df).first().asDict() == {"archives": 2, "nested_archives": 1, "files": 3, "data_rows": 4}


def test_archives_stream_long_members_in_batches(spark, tmp_path, monkeypatch):
    rows = [data("A", i % 24, i) for i in range(500)]
    write(tmp_path, "m.zip", zipped({"long.csv": report(*rows)}))
    df = read_archives(spark, str(tmp_path))
    ordered = [int(r[0]) for r in df.orderBy("_position").select("OPERATIONAL_DEMAND").collect()]
    assert ordered == list(range(500))


@pytest.mark.parametrize(
    "members, message",
    [
        ({"inner.zip": b"not a zip"}, "ZIP archive: m.zip/inner.zip"),
        ({"a.txt": "x"}, "no CSV"),
        ({"a.csv": "C,x\n"}, "no header.*m.zip/a.csv"),
    ],
)
def test_archive_errors(spark, tmp_path, members, message):
    write(tmp_path, "m.zip", zipped(members))
    with pytest.raises(IngestError, match=message):
        read_archives(spark, str(tmp_path))


def test_broken_outer_archive_and_empty_folder(spark, tmp_path):
    with pytest.raises(IngestError):
        read_archives(spark, str(tmp_path))
    write(tmp_path, "m.zip", b"not a zip")
    with pytest.raises(IngestError, match="ZIP archive: m.zip"):
        read_archives(spark, str(tmp_path))


def payload(n=3, **changes):
    hourly = {"time": [f"2024-01-01T{i:02d}:00" for i in range(n)]}
    hourly.update({v: [float(i) for i in range(n)] for v in HOURLY_VARIABLES})
    doc = {"latitude": -37.8, "longitude": 144.9, "elevation": 3.0, "timezone": "UTC", "timezone_abbreviation": "UTC",
           "utc_offset_seconds": 0, "hourly_units": {"temperature_2m": "C"}, "hourly": hourly}
    doc.update(changes)
    return doc


def test_columnar_json(spark, tmp_path):
    doc = payload()
    doc["hourly"]["relative_humidity_2m"] = [1, None, 3]
    write(tmp_path, "w.json", json.dumps(doc, indent=1))
    rows, meta = read_columnar_json(spark, str(tmp_path))
    assert rows.columns == ["time", *HOURLY_VARIABLES]
    got = rows.orderBy("time").collect()
    assert got[1]["time"] == dt.datetime(2024, 1, 1, 1) and got[1]["relative_humidity_2m"] is None
    assert dict(rows.dtypes)["relative_humidity_2m"] == "double"
    m = meta.first()
    assert m["latitude"] == -37.8 and m["hourly_units"] == {"temperature_2m": "C"}
    assert read_columnar_json(spark, str(tmp_path), end="2023-12-31")[0].isEmpty()
    assert read_columnar_json(spark, str(tmp_path), start="2024-01-01", end="2024-01-01")[0].count() == 3


def test_columnar_json_without_units(spark, tmp_path):
    doc = payload()
    del doc["hourly_units"]
    write(tmp_path, "w.json", json.dumps(doc))
    assert read_columnar_json(spark, str(tmp_path))[1].first()["hourly_units"] == {}


def broken(kind):
    doc = payload()
    if kind == "error":
        return {"error": True, "reason": "bad dates"}
    if kind == "hourly":
        del doc["hourly"]
    elif kind == "time":
        del doc["hourly"]["time"]
    elif kind == "variable":
        del doc["hourly"]["cloud_cover"]
    elif kind == "empty":
        doc["hourly"] = {k: [] for k in doc["hourly"]}
    elif kind == "ragged":
        doc["hourly"]["cloud_cover"] = [1.0]
    return doc


@pytest.mark.parametrize(
    "kind, message",
    [("error", "bad dates"), ("hourly", "no hourly"), ("time", "no timestamps"), ("variable", "cloud_cover"),
     ("empty", "no observations"), ("ragged", "length")],
)
def test_columnar_errors(spark, tmp_path, kind, message):
    write(tmp_path, "w.json", json.dumps(broken(kind)))
    with pytest.raises(IngestError, match=message):
        read_columnar_json(spark, str(tmp_path))


def test_columnar_invalid_json(spark, tmp_path):
    write(tmp_path, "w.json", "{nope")
    with pytest.raises(IngestError, match="valid JSON"):
        read_columnar_json(spark, str(tmp_path))


@pytest.mark.parametrize(
    "args", [("2024-02-01", "2024-01-01", 0, 0, ["a"]), (None, None, 91, 0, ["a"]), (None, None, 0, 181, ["a"]), (None, None, 0, 0, [])]
)
def test_request_rules(args):
    with pytest.raises(ValueError):
        check_request(*args)


def test_one_archive_keeps_many_tasks_busy(spark, tmp_path):
    inner = io.BytesIO()
    with zipfile.ZipFile(inner, "w", zipfile.ZIP_DEFLATED) as z:
        for i in range(12):
            z.writestr(f"n{i}.csv", report(data("B", i, i)))
    with zipfile.ZipFile(tmp_path / "all.zip", "w") as z:
        for i, kind in enumerate([zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED, zipfile.ZIP_BZIP2, zipfile.ZIP_LZMA]):
            z.writestr(f"m{i}.csv", report(*[data("A", i, k) for k in range(300)]), compress_type=kind)
        z.writestr("inner.zip", inner.getvalue())
        z.writestr("empty.txt", "")
    content = (tmp_path / "all.zip").read_bytes()
    lines = expand_archives(spark.createDataFrame([("all.zip", content)], "name string, content binary"))
    assert lines.select(F.input_file_name()).distinct().count() > 1  # written by several tasks
    got = read_archives(spark, str(tmp_path)).groupBy("SOURCE_FILE").count().collect()
    assert {r["SOURCE_FILE"]: r["count"] for r in got} == {f"all.zip/m{i}.csv": 300 for i in range(4)} | {f"all.zip/inner.zip/n{i}.csv": 1 for i in range(12)}


@pytest.mark.parametrize("kind", [zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED])
def test_damaged_members(spark, tmp_path, kind):
    with zipfile.ZipFile(tmp_path / "a.zip", "w", kind) as z:
        z.writestr("x.csv", report(*[data("A", 1, k * 7919 % 1000) for k in range(50)]))
    raw = bytearray((tmp_path / "a.zip").read_bytes())
    raw[90:110] = bytes(20)
    (tmp_path / "a.zip").write_bytes(raw)
    with pytest.raises(IngestError, match="not a valid ZIP archive: a.zip"):
        read_archives(spark, str(tmp_path))
