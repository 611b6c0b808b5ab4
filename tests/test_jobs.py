"""Every job from input files to output files."""

import glob
from functools import partial

import pytest

from clickloom.plans import jobs
from clickloom.plans.jobs import JOBS, main
from clickloom.session import tables_folder
from clickloom.sinks import writers
from test_events import line


@pytest.fixture
def write(tmp_path):
    def make(name, *texts):
        path = tmp_path / name
        path.write_text("".join(t + "\n" for t in texts))
        return str(path)

    return make


@pytest.fixture
def out(tmp_path):
    return str(tmp_path / "out")


def read(spark, path):
    return sorted(r[0] for r in spark.read.text(path).collect())


def in_file_order(folder):
    texts = []
    for part in sorted(glob.glob(f"{folder}/part-*")):
        with open(part) as handle:
            texts += handle.read().splitlines()
    return texts


def test_word_count_over_two_files(spark, write, out):
    JOBS["word-count"](spark, [write("a", "x y"), write("b", "x")], out)
    assert read(spark, out) == ["x\t2", "y\t1"]


def test_sorted_word_count(spark, write, out):
    JOBS["word-count-sorted"](spark, [write("a", "y x", "x")], out)
    assert in_file_order(out) == ["(x,2)", "(y,1)"]


def test_word_statistics(spark, write, out):
    JOBS["word-statistics"](spark, [write("a", "x x", "x")], out)
    assert read(spark, out) == ["x\t2,1.5,0.25"]


def test_full_word_statistics(spark, write, out):
    JOBS["word-statistics-full"](spark, [write("a", "x x", "x"), write("b", "")], out)
    assert read(spark, out) == [
        "paragraph length\t3\t3\t0\t2\t5\t1.0\t0.6666666666666667",
        "x\t2\t3\t1\t2\t5\t1.5\t0.25",
    ]


def test_email_index(spark, write, out):
    a = write("a", "Message-ID: 2 From: p To: q, r Subject: s")
    b = write("b", "Message-ID: 1 From: p To: q Subject: s")
    JOBS["email-index"](spark, [a, b], out)
    assert read(spark, out) == ["From:p\t1,2", "To:q\t1,2", "To:r\t2"]


def test_verse_index(spark, write, out):
    JOBS["verse-index"](spark, [write("a", "Gen:1:10 the sea", "Gen:1:2 The earth")], out)
    assert in_file_order(out) == [
        "(earth,[Gen:1:2])",
        "(sea,[Gen:1:10])",
        "(the,[Gen:1:2, Gen:1:10])",
    ]


def test_field_histogram(spark, write, out):
    JOBS["field-histogram"](spark, [write("a", line()), write("b", line(make="Kia"))], out)
    got = dict(t.rsplit("\t", 1) for t in read(spark, out))
    assert got["make:Ford"] == "1" and got["feature:abs"] == "2"


@pytest.fixture
def sessions(spark, write, tmp_path):
    log = write(
        "log",
        line(),
        line(),
        line(event_type="click badges"),
        line(user_id="u2", event_type="visit features", vin="V2"),
        *[line(user_id="u3", event_type="show badges", event_timestamp=str(i)) for i in range(101)],
    )
    path = str(tmp_path / "sessions")
    JOBS["user-sessions"](spark, [log], path)
    return path


def test_user_sessions(spark, sessions, write, out):
    got = {r["user_id"]: r["session_events"] for r in spark.read.parquet(sessions).collect()}
    assert got == {"u1": 2, "u2": 1, "u3": 101}
    JOBS["user-sessions-with-duplicates"](spark, [write("l", line(), line())], out)
    assert [r["session_events"] for r in spark.read.parquet(out).collect()] == [2]


def test_vehicle_impressions(spark, sessions, write, out):
    a, b = write("a", "V1,SRP,5", "V9,SRP,1"), write("b", "V1,VDP,2")
    JOBS["vehicle-impressions"](spark, [sessions, a, b], out)
    assert read(spark, out) == ["V1\t2\tBADGES=1\t1\t5\t2", "V2\t1\t\t0\t0\t0"]


def test_session_filter_routes_by_type(spark, sessions, out):
    JOBS["session-filter"](spark, [sessions], out)
    folders = sorted(p.rsplit("/", 1)[1] for p in glob.glob(f"{out}/session_type=*"))
    assert folders == ["session_type=submitter", "session_type=visitor"]
    submitter = spark.read.parquet(f"{out}/session_type=submitter").first()
    assert submitter["user_id"] == "u1" and len(submitter["events"]) == 2


def test_session_bins_keep_every_small_session(spark, sessions, out):
    JOBS["session-bins"](spark, [sessions], out)
    assert spark.read.parquet(out).count() == 2


def test_session_statistics(spark, sessions, out):
    JOBS["session-statistics"](spark, [sessions], out)
    got = read(spark, out)
    assert len(got) == 36
    assert "SUBMITTER\tCONTACT_FORM\t1\t1\t1\t1.0\t0.0" in got
    assert "ANY\tCONTACT_FORM\t2\t1\t1\t0.5\t0.25" in got


def test_counter_jobs(spark, sessions, write, out, tmp_path):
    JOBS["word-counters"](spark, [write("w", "a b", "a")], out)
    assert read(spark, out) == ["groups_out\t2", "input_lines\t2", "words_out\t3"]
    filtered = str(tmp_path / "filter")
    JOBS["session-filter-counters"](spark, [sessions], filtered)
    assert read(spark, filtered) == ["3\t1\t0\t0"]
    metrics = str(tmp_path / "metrics")
    click = line(event_type="click badges")
    JOBS["city-session-metrics"](spark, [write("a", click), write("b", click, line(city="Waco"))], metrics)
    assert read(spark, metrics) == ["2\t2\t2\t0\t0"]


def test_city_sessions(spark, write, out):
    a = write("a", line(event_type="click badges"), line(city="Waco", event_type="click badges"))
    b = write("b", line(event_type="click badges"))
    JOBS["city-sessions"](spark, [a, b], out)
    got = spark.read.parquet(out).collect()
    assert sorted((r["city"], r["session_events"], r["events"]) for r in got) == [
        (c, 1, "<click:badges,2015-01-01 10:00:00>") for c in ("Austin", "Waco")
    ]
    assert {r["city_bucket"] for r in got} <= set(range(6))


def test_vehicle_reports(spark, write, out):
    path = write(
        "v",
        "userID,event,timestamp,vin,condition,year,make,model,price,mileage",
        "u1,show badges,t,v1,Used,2001,Kia,K,10.5,100",
        "u1,show badges,t,v2,Used,2001,Ford,F,0,60",
        "u2,click badges,t,v2,Used,2000,Ford,F,20,0",
    )
    JOBS["vehicle-reports"](spark, [path], out)
    assert in_file_order(f"{out}/make_model") == ["Ford,F,20,20,20.0000", "Kia,K,11,11,11.0000"]
    assert in_file_order(f"{out}/year") == ["2001,60,100,80.0000"]
    assert in_file_order(f"{out}/vin") == ["v1,show,1", "v2,click,1", "v2,show,1"]


def test_csv_in_one_file_and_without_a_top_list(spark, out):
    df = spark.range(50).selectExpr("id % 7 AS a", "id").repartition(5)
    writers.write_csv(df, f"{out}/one", ["a", "id"], single_file=True)
    writers.write_csv(df, f"{out}/many", ["a", "id"])
    assert len(glob.glob(f"{out}/one/part-*")) == 1
    assert in_file_order(f"{out}/one") == in_file_order(f"{out}/many")
    assert "TakeOrdered" not in df.orderBy("a", "id")._jdf.queryExecution().toString()


def test_long_id_lists_keep_their_order(spark, write, out, monkeypatch):
    texts = [f"Message-ID: m{i} From: a To: b Subject: s" for i in (3, 1, 5, 2, 4)]
    monkeypatch.setattr(jobs, "header_index", partial(jobs.header_index, segment_size=2))
    JOBS["email-index"](spark, [write("a", *texts)], out)
    lines = [r for r in in_file_order(out) if r.startswith("From:a")]
    assert [r.split("\t")[1] for r in lines] == ["m1,m2", "m3,m4", "m5"]


def test_a_finished_job_leaves_no_table(spark, write, out):
    main(["verse-index", write("a", "Gen:1:1 in the beginning"), out])
    folder = tables_folder(spark).removeprefix("file:")
    assert not glob.glob(f"{folder}/*")


def test_command_line(spark, write, out):
    main(["word-count", write("a", "x"), out])
    assert read(spark, out) == ["x\t1"]


def test_long_sessions_in_the_filter_jobs(spark, write, out, tmp_path, monkeypatch):
    """A session of 300 events in rows of 20 is one large one; one of 60 has its own type."""
    log = write(
        "log",
        *[line(user_id="large", event_type="show badges", event_timestamp=f"{i:03}") for i in range(300)],
        *[line(user_id="split", event_type="visit badges", event_timestamp=f"{i:03}") for i in range(59)],
        line(user_id="split", event_type="edit contact form", event_timestamp="999"),
        line(user_id="short", event_type="visit badges"),
    )
    stored = str(tmp_path / "stored")
    short_rows = partial(jobs.session_filter.sessionize, segment_events=20)
    monkeypatch.setattr(
        jobs.session_filter, "sessionize", lambda *a, segment_events, **more: short_rows(*a, **more)
    )
    built = JOBS["user-sessions"](spark, [log], stored)
    assert built == {
        "lines_read": 361, "rows_written": 19, "sessions_written": 3, "events_written": 361,
    }
    counters = JOBS["session-filter-counters"](spark, [stored], f"{out}-counters")
    assert read(spark, f"{out}-counters") == ["3\t1\t0\t0"] and counters == {"sessions_read": 3}
    binned = JOBS["session-bins"](spark, [stored], f"{out}-bins")
    assert binned == {
        "sessions_read": 3, "rows_written": 4, "written_submitter": 1, "written_clicker": 0,
        "written_shower": 0, "written_visitor": 1, "written_other": 0,
    }
    assert {r["session_type"] for r in spark.read.parquet(f"{out}-bins").filter("user_id = 'split'").collect()} == {
        "submitter"
    }
    filtered = JOBS["session-filter"](spark, [stored], f"{out}-filter")
    assert (filtered["sessions_read"], filtered["large_discards"], filtered["rows_written"]) == (3, 1, 4)


def test_counters_arrive_with_the_jobs(spark, write, out, tmp_path):
    words = [write("w", "a b", "a"), write("v", "c")]
    expected = {"lines_read": 3, "groups_written": 3, "words_out": 4}
    assert JOBS["word-count"](spark, words, f"{out}-1") == expected
    assert JOBS["word-count-sorted"](spark, words, f"{out}-2") == expected
    assert JOBS["word-statistics"](spark, words, f"{out}-3") == {
        "lines_read": 3, "words_written": 3, "words_out": 4,
    }
    verses = write("verses", "Gen:1:1 the sea", "Gen:1:2 the the earth")
    assert JOBS["verse-index"](spark, [verses], f"{out}-4") == {
        "lines_read": 2, "rows_written": 3, "words_written": 3,
    }
    assert JOBS["field-histogram"](spark, [write("l", line())], f"{out}-5")["lines_read"] == 1
    logs = [write("l1", line(), line()), write("l2", line())]
    assert JOBS["city-sessions"](spark, logs, f"{out}-6") == {
        "lines_read": 3, "rows_written": 1, "sessions_written": 1, "events_written": 1,
    }
    cars = write("cars", "u1,show badges,t,v1,Used,2001,Kia,K,10.5,100", "u1,click badges,t,v1,Used,2001,Kia,K,10.5,100")
    assert JOBS["vehicle-reports"](spark, [cars], f"{out}-7") == {
        "lines_read": 2, "make_model_rows_written": 1, "year_rows_written": 1, "vin_rows_written": 2,
    }


def test_counters_of_empty_input(spark, write, out):
    counts = JOBS["word-count"](spark, [write("none")], f"{out}-1")
    assert set(counts.values()) <= {0}
    assert set(JOBS["user-sessions"](spark, [write("no-log")], f"{out}-2").values()) <= {0}


def test_city_sessions_as_tuples(spark, write, out):
    a = write("a", line(event_type="click badges"), line(city="Waco", event_type="click contact form", event_timestamp="2"))
    b = write("b", line(city="Waco", event_type="click badges", event_timestamp="1"))
    JOBS["city-session-tuples"](spark, [a, b], out)
    rows = spark.read.text(out).collect()
    assert sorted(r["value"] for r in rows) == [
        "((u1,Austin),[<click:badges,2015-01-01 10:00:00>])",
        "((u1,Waco),[<click:badges,1>, <click:contact form,2>])",
    ]
    assert {r["city_bucket"] for r in rows} <= set(range(6))


def test_email_posting_maps(spark, write, out):
    a = write("a", "Message-ID: 2 From: p To: q, q, r Subject: s", "Message-ID: 1 From: p To: r Subject: s")
    JOBS["email-postings"](spark, [a], out)
    assert read(spark, out) == ["From:p\t1", "From:p\t2", "To:q\t2 2", "To:r\t1", "To:r\t2"]


def test_routed_files_follow_the_bytes(spark, tmp_path):
    """Forty reading tasks and three types make three files, not a hundred."""
    path = str(tmp_path / "routed")
    rows = spark.range(400).repartition(40).selectExpr("id", "concat('t', id % 3) AS session_type")
    writers.write_routed(rows, path)
    assert len(glob.glob(f"{path}/session_type=*/part-*")) <= 4
    assert spark.read.parquet(path).count() == 400
