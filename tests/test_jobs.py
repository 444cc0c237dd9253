from datetime import datetime, timezone

import pytest

from helpers import frame, rows
from passerby.plans import jobs
from passerby.streaming.sinks import read_heatmap, read_heatmap_sketches, read_live_visits, start_live


def test_refresh_and_report(spark, tmp_path):
    probes = tmp_path / "in" / "7"
    probes.mkdir(parents=True)
    day = 1705276800
    (probes / "t_cf_20240115.txt").write_text(
        f"aa,{day + 100},1\naa,{day + 160},1\nbb,{day + 200},0\nbroken\n")
    frame(spark, "entityid int, indoor_threshold int, leave_threshold int", (7, 20, 5)).write.parquet(
        str(tmp_path / "entities"))
    root = str(tmp_path / "out")
    jobs.main(["refresh", "--probes", str(tmp_path / "in"), "--entities", str(tmp_path / "entities"),
               "--root", root, "--run", "r1"])
    spark.sql(f"CREATE DATABASE IF NOT EXISTS jobs LOCATION '{tmp_path}/jobs'")
    jobs.main(["report", "--root", root, "--as-of", "2024-01-16", "--table", "jobs.report",
               "--flow", "jobs.flow", "--indoor", "jobs.indoor", "--profile", "jobs.profile"])
    assert rows(spark.table("jobs.flow"), "clientmac", "visits") == [("aa", 1), ("bb", 1)]
    assert rows(spark.table("jobs.indoor"), "clientmac", "secondsbyday") == [("aa", 60)]
    assert rows(spark.table("jobs.report"), "entityid", "clientmac", "secondsbyday", "r_indoors7", "visits") == \
        [(7, "aa", 60, 1, 1), (7, "bb", 0, 0, 1)]
    assert rows(spark.table("jobs.profile"), "clientmac", "indoors") == [("aa", 1), ("bb", 0)]
    assert spark.read.json(f"{root}/rejects/r1").count() == 1
    assert spark.read.json(f"{root}/log/r1").count() == 1
    spark.sql("DROP DATABASE jobs CASCADE")


def test_ingest_and_report_by_changes(spark, tmp_path):
    day, root = 1705276800, str(tmp_path / "out")
    frame(spark, "entityid int, indoor_threshold int, leave_threshold int", (7, 20, 5)).write.parquet(str(tmp_path / "entities"))
    spark.sql(f"CREATE DATABASE IF NOT EXISTS taken LOCATION '{tmp_path}/taken'")
    (tmp_path / "in" / "7").mkdir(parents=True)
    for n, text in enumerate((f"aa,{day + 100},1\naa,{day + 160},1\n", f"aa,{day + 86500},1\naa,{day + 86600},1\nbb,{day + 86500},0\n")):
        (tmp_path / "in" / "7" / f"t_cf_2024011{5 + n}.txt").write_text(text)
        jobs.main(["ingest", "--probes", str(tmp_path / "in"), "--entities", str(tmp_path / "entities"), "--root", root, "--checkpoint", str(tmp_path / "state")])
    for by in ("changes", "days"):
        jobs.main(["report", "--root", root, "--as-of", "2024-01-17", "--table", f"taken.{by}", "--by", by, "--path", str(tmp_path / by)])
    assert rows(spark.table("taken.changes")) == rows(spark.table("taken.days")) == rows(spark.read.parquet(str(tmp_path / "changes")))
    assert rows(spark.table("taken.changes"), "clientmac", "indoors", "visits7") == [("aa", 2, 1), ("aa", 2, 2), ("bb", 0, 1)]
    jobs.main(["compact", "--out", root, "--kind", "report"])
    jobs.main(["report", "--root", root, "--as-of", "2024-01-17", "--table", "taken.again", "--by", "changes"])
    assert rows(spark.table("taken.again")) == rows(spark.table("taken.days"))
    spark.sql("DROP DATABASE taken CASCADE")


ACCESS_POINT = "apmac string, entityid int, rssi int, nearbyrssi int, indoor_seconds long, leave_seconds long"


def write_feed(tmp_path, name, lines):
    (tmp_path / name).mkdir()
    (tmp_path / name / "1.txt").write_text("".join(line + "\n" for line in lines))
    return ["text", f"path={tmp_path}/{name}"]


def live(spark, tmp_path, job, source, monkeypatch, *options):
    """A job by its command line, over what is there."""
    monkeypatch.setattr(jobs, "start_live", lambda rows, write, checkpoint, every: start_live(rows, write, checkpoint, None))
    keep = jobs.keep_rejects
    monkeypatch.setattr(jobs, "keep_rejects", lambda *given: keep(*given[:-1], None).awaitTermination())
    out = tmp_path / f"out-{len(list(tmp_path.iterdir()))}"
    jobs.main([job, "--out", str(out), "--checkpoint", f"{out}-state", *options, *source])
    return str(out)


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
@pytest.mark.parametrize("rule, expected", [
    # Bound -20. Equal and positive signals count only under the trigger rule; it takes ttime and refuses late arrivals.
    ("current", [("STRONG", 0, 50, 0)]),
    ("latest", [("STRONG", 50, 50, 0)]),
    ("trigger", [("EQUAL", 0, 0, 1), ("POSITIVE", 0, 0, 1), ("STRONG", 0, 0, 1)]),
])
def test_rules_of_live_visits(spark, tmp_path, monkeypatch, rule, expected, fmt):
    points = frame(spark, ACCESS_POINT, ("P", 7, -20, -60, 10, 300))
    points.write.format(fmt).option("header", True).save(str(tmp_path / "ap"))
    day = datetime(2020, 1, 1, tzinfo=timezone.utc).timestamp()

    def line(mac, rssi, happened, arrived):
        times = (datetime.fromtimestamp(day + s, timezone.utc).strftime("%Y-%m-%d %H:%M:%S") for s in (happened, arrived))
        return ",".join(["r", "p", mac, str(rssi), *times])

    lines = [line("strong", -5, 0, 0), line("strong", -5, 0, 50), line("equal", -20, 0, 0), line("positive", 5, 0, 0), line("weak", -21, 0, 0), "broken"]
    if rule == "trigger":  # closed visits only: each is followed by one that closes it, and one that arrives late does not count
        lines += [line(mac, rssi, 900, 900) for mac, rssi in (("strong", -5), ("equal", -20), ("positive", 5), ("weak", -21))]
        lines += [line("late", -5, 0, 300), line("late", -5, 900, 1200)]
    more = ["--access-points-format", fmt] + (["--dim-option", "header=true", "--dim-option", "inferSchema=true"] if fmt == "csv" else [])
    out = live(spark, tmp_path, "visits", write_feed(tmp_path, "raw", lines), monkeypatch, "--access-points", str(tmp_path / "ap"),
               "--rule", rule, "--rejects", str(tmp_path / "rejects"), *more)
    found = [(mac, etime - day, ltime - day, done) for mac, etime, ltime, done in rows(read_live_visits(spark, out), "clientmac", "etime", "ltime", "done")]
    assert found == expected
    assert [r.value for r in spark.read.schema("value string").json(str(tmp_path / "rejects")).collect()] == ["broken"]


def test_matched_feed_and_age(spark, tmp_path, monkeypatch):
    now = int(datetime.now(timezone.utc).timestamp()) - 100
    source = write_feed(tmp_path, "matched", [f"m,7,aa,{now},x,300", f"m,7,aa,{now + 50},x,", "m,7,bb,1000,x,300", "m,,cc,1000,x,300"])
    out = live(spark, tmp_path, "visits", source, monkeypatch, "--feed", "matched")
    assert rows(read_live_visits(spark, out), "clientmac", "seconds") == [("AA", 50), ("BB", 0)]
    out = live(spark, tmp_path, "visits", source, monkeypatch, "--feed", "matched", "--max-age", "5 minutes")
    assert rows(read_live_visits(spark, out), "clientmac", "seconds") == [("AA", 50)]
    jobs.main(["compact", "--out", out, "--kind", "visits"])
    assert rows(read_live_visits(spark, out), "clientmac") == [("AA",)]
    out = live(spark, tmp_path, "visits", source, monkeypatch, "--feed", "matched", "--delay", "10 seconds")
    assert rows(read_live_visits(spark, out), "clientmac", "done") == [("AA", 0), ("BB", 1)]


def test_heat_map_job(spark, tmp_path, monkeypatch):
    frame(spark, ACCESS_POINT, ("P", 7, -20, -60, 10, 300)).write.parquet(str(tmp_path / "ap"))
    now = datetime.fromtimestamp(datetime.now(timezone.utc).timestamp() - 60, timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    source = write_feed(tmp_path, "heat", [f"h,x,P,aa,-5,{now}", "h,x,P,bb,-70,2020-01-01 00:00:00"])
    out = live(spark, tmp_path, "heatmap", source, monkeypatch, "--access-points", str(tmp_path / "ap"))
    assert rows(read_heatmap(spark, out), "entityid", "indoors", "aways", "visits") == [(7, 1, 0, 0)]
    out = live(spark, tmp_path, "heatmap", source, monkeypatch, "--access-points", str(tmp_path / "ap"), "--store", "sketches")
    assert rows(read_heatmap_sketches(spark, out, "day"), "entityid", "indoors", "aways", "visits") == [(7, 1, 0, 0)]
