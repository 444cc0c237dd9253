import json

from helpers import frame, rows
from passerby.operators.ingest import ingest_backlog, processing_log
from passerby.sources.feeds import (
    explode_payload, parse_fields, parse_heat_map_feed, parse_matched_feed, parse_raw_feed,
)
from passerby.sources.probes import read_probes
from passerby.sources.tables import (
    read_dim, read_flow_daily, read_indoor_daily, read_sessions, write_processing_log,
)


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_probe_files(spark, tmp_path):
    write(tmp_path / "100033" / "t_cf_20240115.txt",
          'aa,1705300000,1\nbb,1705300001,0,more,fields\nshort,5\ncc,soon,1\n"q,1705300002,1\n,1,1\n')
    write(tmp_path / "100034" / "t_cf_20240201.txt", "dd,1706745700,1\n")
    write(tmp_path / "100034" / "notes.txt", "dd,1706745700,1\n")
    good, rejects = read_probes(spark, str(tmp_path))
    assert rows(good, "entityid", "file_day", "ufirstday", "clientmac", "stime", "flag") == [
        (100033, 1705276800, 1704067200, '"q', 1705300002, 1),
        (100033, 1705276800, 1704067200, "aa", 1705300000, 1),
        (100033, 1705276800, 1704067200, "bb", 1705300001, 0),
        (100034, 1706745600, 1706745600, "dd", 1706745700, 1),
    ]
    refused = rejects.fillna("-").select("clientmac", "raw_stime", "raw_flag")
    assert rows(refused) == [("-", "1", "1"), ("cc", "soon", "1"), ("dd", "1706745700", "1"),
                             ("short", "5", "-")]


def test_stored_text_tables(spark, tmp_path):
    write(tmp_path / "indoor" / "1" / "2024" / "id_20240115.txt", "aa,1,10,70,60,0,0\n")
    write(tmp_path / "flow" / "1" / "2024" / "fl_20240115.txt", "aa,1,10,70,0,0\nbb,1,11,71,0,0\n")
    write(tmp_path / "rec" / "1" / "2024" / "id_20240115.txt", "aa,1,10,70,60\n")
    assert rows(read_indoor_daily(spark, str(tmp_path / "indoor"), "csv")) == [("aa", 1, 10, 70, 60, 0, 0)]
    assert rows(read_flow_daily(spark, str(tmp_path / "flow"), "csv"), "clientmac") == [("aa",), ("bb",)]
    assert rows(read_sessions(spark, str(tmp_path / "rec"), "csv")) == [("aa", 1, 10, 70, 60)]


def test_dimension_reader(spark, tmp_path):
    frame(spark, "ID int, flags int", (1, 0)).write.parquet(str(tmp_path / "dim"))
    assert rows(read_dim(spark, "parquet", path=str(tmp_path / "dim"))) == [(1, 0)]


def test_payload_lines(spark):
    message = frame(spark, "value binary", (bytearray(b"x,1,a\ny,2,b"),))
    lines = explode_payload(message)
    parsed = parse_fields(lines, {"kind": 0, "n": 1, "name": 2, "none": 7}, {"n": "int"}, upper=("name",))
    assert rows(parsed) == [("x", 1, "A", None), ("y", 2, "B", None)]


def test_feeds(spark):
    def lines(*text):
        return frame(spark, "value string", *[(t,) for t in text])

    assert [tuple(map(str, r)) for r in rows(parse_raw_feed(lines("r, ap1 ,mac1,-5,t,2024-01-15 10:11:12")))] == \
        [("AP1", "MAC1", "-5", "t", "2024-01-15 10:11:12")]
    heat = parse_heat_map_feed(lines("0,1,ap,mac,-5,2024-01-15 13:11:12", "0,1,ap,mac,-5,late", "0"))
    assert [tuple(map(str, r)) for r in rows(heat)] == [("ap", "mac", "-5", "2024-01-15 13:11:12")]
    assert rows(parse_matched_feed(lines("0,7,ab,1000,10,300", "0,x,ab,1000,10,300", "broken"))) == \
        [(7, "AB", 1000, 300)]


def test_backlog_groups(spark):
    names = [f"f{i:02}" for i in range(13)]
    items = [(n, f"{n}/1", 3 * 1048576) for n in names if n != "f05"] + [("f05", None, None), ("f00", "x", 1)]
    got = rows(ingest_backlog(frame(spark, "folder string, path string, length long", *items)))
    # 13 folders in groups of 13 div 6 + 1 = 3
    assert got == [(1, 4, 3, 0, 9), (2, 2, 2, 1, 6), (3, 3, 3, 0, 9), (4, 3, 3, 0, 9), (5, 1, 1, 0, 3)]


def test_processing_log(spark, tmp_path):
    seen = frame(spark, "entityid int, file_day long", (7, 86400), (7, 86400), (6, 0))
    log = processing_log(seen, "2024-02-01 03:00:00")
    write_processing_log(log, str(tmp_path / "log"))
    files = list((tmp_path / "log").glob("*.json"))
    assert len(files) == 1
    assert sorted(json.loads(line)["fileName"] for line in files[0].read_text().splitlines()) == [
        "/data/t_cf_inc/6/t_cf_19700101.txt", "/data/t_cf_inc/7/t_cf_19700102.txt"]
