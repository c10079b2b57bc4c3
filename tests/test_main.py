from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

import reference_model as model
from wavecount.main import main
from wavecount.operators.lateness import FIRST_RANKING, lost_after
from wavecount.sources.lines import read_lines_in_order


def test_lines_keep_their_order_over_many_splits(spark, tmp_path):
    text = [f"line {n} " + "x" * (n % 50) for n in range(3_000)]
    (tmp_path / "one.txt").write_text("\n".join(text) + "\n")
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
        lines = read_lines_in_order(spark, str(tmp_path / "one.txt"))
        assert lines.rdd.getNumPartitions() > 5
        ordered = lines.orderBy("place").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert [r.value for r in ordered] == text


def test_behavior_jobs_on_a_file(spark, tmp_path, capsys):
    (tmp_path / "in.csv").write_text("1,501,7,pv,1511658000\n2,501,7,pv,1511658001\n3,502,7,buy,1511658002\n")
    source = str(tmp_path / "in.csv")
    main(["hot-items", "--input", source, "--output", str(tmp_path / "out")])
    report = spark.read.parquet(str(tmp_path / "out/hot items"))
    assert report.count() == 12
    assert all("NO 1: 商品id = 501 热门度 = 2\n" in r.report for r in report.collect())
    main(["hot-items-sql", "--input", source, "--output", str(tmp_path / "sql")])
    assert {(r.item_id, r.cnt) for r in spark.read.parquet(str(tmp_path / "sql/hot items")).collect()} == {(501, 2)}
    main(["page-views", "--input", source])
    assert "page views> pv,1511661600000,3\n" in capsys.readouterr().out
    (tmp_path / "more.csv").write_text("".join(f"1,{item},7,pv,1511658000\n" for item in range(9)))
    main(["hot-items-sql", "--input", str(tmp_path / "more.csv"), "--output", str(tmp_path / "two"), "--n", "2"])
    assert spark.read.parquet(str(tmp_path / "two/hot items")).agg(F.max("row_num")).first()[0] == 2


def test_every_row_is_printed(spark, tmp_path, capsys):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.csv").write_text("".join(f"1,5,7,pv,{hour * 3600}\n" for hour in range(61)))
    main(["page-views", "--input", str(tmp_path / "in")])
    assert capsys.readouterr().out.count("page views> ") == 61
    main(["page-views", "--input", str(tmp_path / "in"), "--rows", "7"])
    assert capsys.readouterr().out.count("page views> ") == 7
    for job, lines in (("page-views", 60), ("hot-items", 60 * 12), ("hot-items-sql", 61 * 12)):
        follow = [job, "--follow", str(tmp_path / "in"), "--state", str(tmp_path / job), "--once"]
        main(follow)
        label = {"page-views": "page views> ", "hot-items": "hot items> ", "hot-items-sql": "hot items changes> "}[job]
        assert capsys.readouterr().out.count(label) == lines
        main(follow)  # goes on from its state: nothing is left
        assert capsys.readouterr().out.count(label) == 0


def test_files_of_a_folder_arrive_by_name(spark, tmp_path):
    """The first file is smaller, so places inside the files would mix them."""
    line = "h u - 01/01/1970:{:02}:{:02}:{:02} +0000 GET {}"
    (tmp_path / "in").mkdir()
    (tmp_path / "in/log.1").write_text(line.format(0, 0, 1, "/first") + "\n")
    (tmp_path / "in/log.2").write_text("".join(line.format(1, n // 60, n % 60, "/a") + "\n" for n in range(900)))
    main(["hot-pages", "--input", str(tmp_path / "in"), "--output", str(tmp_path / "out")])
    assert spark.read.parquet(str(tmp_path / "out/late data")).count() == 0
    assert any("/first" in r.report for r in spark.read.parquet(str(tmp_path / "out/hot pages")).collect())


def test_hot_pages_follow_a_folder(spark, tmp_path, capsys):
    """Rankings, a refinement and a late row from one command, over several starts."""
    line = "h u - 01/01/1970:{:02}:{:02}:{:02} +0000 GET {}\n"
    (tmp_path / "in").mkdir()
    follow = ["hot-pages", "--follow", str(tmp_path / "in"), "--state", str(tmp_path / "state"), "--once"]
    seen = []
    for n, rows in enumerate(([(0, 0, 1, "/a")], [(0, 10, 20, "/b")], [(0, 0, 2, "/c"), (0, 30, 0, "/d")], [(0, 0, 3, "/late")])):
        (tmp_path / f"in/{n}.log").write_text("".join(line.format(*r) for r in rows))
        main(follow)
        seen.append(capsys.readouterr().out)
    assert "hot pages> " not in seen[0] and "被访问url = /a" in seen[1] and "/c" not in seen[1]
    assert "被访问url = /c" in seen[2] and "late data> " not in seen[2]
    assert "late data> h,u," in seen[3] and "/late" in seen[3] and "被访问url = /late" not in seen[3]


def test_hot_pages_follow_a_folder_row_by_row(spark, tmp_path, capsys):
    """A row is late for what an earlier line of its own file has closed."""
    line = "h u - 01/01/1970:{:02}:{:02}:{:02} +0000 GET {}\n"
    (tmp_path / "in").mkdir()
    follow = ["hot-pages", "--by-row", "--follow", str(tmp_path / "in"), "--state", str(tmp_path / "state"), "--once"]
    seen = []
    for n, rows in enumerate(([(0, 0, 1, "/a"), (0, 10, 20, "/b"), (0, 0, 2, "/c"), (0, 30, 0, "/d"), (0, 0, 3, "/late")], [(0, 50, 0, "/e")])):
        (tmp_path / f"in/{n}.log").write_text("".join(line.format(*r) for r in rows))
        main(follow)
        seen.append(capsys.readouterr().out)
    assert all(f"被访问url = {url}" in seen[0] for url in ("/a", "/b", "/c")) and "被访问url = /late" not in "".join(seen)
    assert seen[0].count("late data> h,u,") == 1 and "/late" in seen[0] and "late data> " not in seen[1]
    assert "被访问url = /d" in seen[1] and "被访问url = /a" not in seen[1]


def test_hot_pages_job_takes_the_file_order_as_arrival(spark, tmp_path):
    rng, rows, lines = random.Random(11), [], []
    for n in range(120):
        sec = max(0, n * 12 - rng.choice([0, 0, 0, 40, 100, 900]))
        url = rng.choice(["/a", "/b", "/c"])
        rows.append((url, sec * 1000, n, n))
        lines.append(f"h u - 01/01/1970:{sec // 3600:02}:{sec // 60 % 60:02}:{sec % 60:02} +0000 GET {url}")
    (tmp_path / "access.log").write_text("\n".join(lines) + "\n")
    out = tmp_path / "out"
    main(["hot-pages", "--input", str(tmp_path / "access.log"), "--output", str(out), "--n", "1"])
    for name, after in (("hot pages", FIRST_RANKING), ("hot pages refined", lost_after())):
        best = model.ranked(model.replay(rows, 600_000, 5_000, 1_000, after), 1)
        expected = {(end, f"NO 1: 热门度 = {count} 被访问url = {url}") for url, end, count, _ in best}
        found = spark.read.parquet(str(out / name)).collect()
        assert {(r.window_end, r.report.split("\n")[2]) for r in found} == expected
    late = model.late(rows, 600_000, 5_000, 1_000, 60_000)
    assert late
    found = spark.read.parquet(str(out / "late data")).select("url", F.unix_millis("ts").alias("ms")).collect()
    assert sorted(tuple(r) for r in found) == sorted(rows[i][:2] for i in late)


@pytest.mark.parametrize("args", [
    ["hot-items"], ["hot-pages", "--kafka", "host:9092"], ["page-views", "--follow", "in"], ["replay", "--input", "in.csv"]])
def test_a_job_needs_its_source(args):
    with pytest.raises(SystemExit):
        main(args)
