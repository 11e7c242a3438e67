"""Quoted CSV read by many tasks, and tables that are replaced safely."""

import csv
import os
import random
import signal
import subprocess
import sys
import time

import pytest
from pyspark.sql import functions as F

from arrivals_star.sources import read_csv, read_quoted_csv, read_table, replace
from arrivals_star.sources.sinks import write_csv, write_parquet

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


# --- CSV with quoted line breaks ---

def odd_rows(n, seed=1):
    rng = random.Random(seed)
    parts = ["a", "é", '"', ",", "\n", "\r\n", " ", "\n\n", '""', "x" * 30, "\\", "1", ";", "'"]
    return [[str(k), *("".join(rng.choice(parts) for _ in range(rng.randint(0, 6))) for _ in range(2))] for k in range(n)]


def write_file(path, rows, header=("id", "one", "two"), end="\r\n"):
    with open(path, "w", newline="", encoding="utf-8") as f:
        out = csv.writer(f, lineterminator=end)
        out.writerow(header)
        out.writerows(rows)


@pytest.fixture()
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "3000", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_one_file_read_by_many_tasks(spark, tmp_path, small_splits, end):
    rows = odd_rows(2500)
    # records that hold whole splits, quotes at their ends, and a record that ends the file inside a split
    rows[700][1] = "line\n" * 3000
    rows[701][2] = '"\n' * 2500 + '"'
    path = str(tmp_path / "big.csv")
    write_file(path, rows, end=end)
    assert spark.read.option("lineSep", "\n").text(path).rdd.getNumPartitions() > 20
    got = sorted((tuple(r) for r in read_quoted_csv(spark, path).collect()), key=lambda r: int(r[0]))
    want = [tuple(x or None for x in r) for r in rows]
    assert got == want
    one = sorted((tuple(r) for r in read_csv(spark, path, multi_line=True).collect()), key=lambda r: int(r[0]))
    if end == "\n":
        assert got == one


def test_folder_of_files_each_with_its_header(spark, scratch, small_splits):
    df = spark.range(4000).select(F.col("id").cast("string").alias("id"), F.when(F.col("id") % 3 == 0, F.lit("a\nb")).otherwise(
        F.when(F.col("id") % 3 == 1, F.lit('say "no"'))).alias("text")).repartition(5)
    path = scratch("csv_folder")
    write_csv(df, path)
    got = read_quoted_csv(spark, path)
    assert got.columns == ["id", "text"]
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, df.collect()))


def test_headers_and_empty_files(spark, tmp_path):
    write_file(tmp_path / "a.csv", [["1", "x", "y"]], header=("the\nid", "o,ne", 'tw"o'))
    df = read_quoted_csv(spark, str(tmp_path / "a.csv"))
    assert df.columns == ["the\nid", "o,ne", 'tw"o'] and [tuple(r) for r in df.collect()] == [("1", "x", "y")]
    (tmp_path / "b.csv").write_text("\n\nid,one\n\n1,x\n\n2,\"y\n\nz\"\n\n")
    assert sorted(map(tuple, read_quoted_csv(spark, str(tmp_path / "b.csv")).collect())) == [("1", "x"), ("2", "y\n\nz")]
    (tmp_path / "c.csv").write_text("id,one\n")
    assert read_quoted_csv(spark, str(tmp_path / "c.csv")).collect() == []
    typed = read_quoted_csv(spark, str(tmp_path / "b.csv"), schema="id int, one string")
    assert sorted(map(tuple, typed.collect())) == [(1, "x"), (2, "y\n\nz")]
    (tmp_path / "d.csv").write_text("1;x\n2;\"a;b\n\"")
    rows = read_quoted_csv(spark, str(tmp_path / "d.csv"), sep=";", header=False).collect()
    assert sorted(map(tuple, rows)) == [("1", "x"), ("2", "a;b\n")]


def test_lines_of_single_records_are_not_grouped(spark, tmp_path):
    """Only the lines of longer records reach the grouped step; there is no Python in the plan."""
    write_file(tmp_path / "a.csv", odd_rows(50), end="\n")
    plan = read_quoted_csv(spark, str(tmp_path / "a.csv"))._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and plan.count("collect_list") >= 1 and "Union" in plan


def test_temperatures_with_doubled_quotes(spark, scratch):
    """The staging job reads them when told so, and as before without."""
    from dataclasses import replace as changed
    from arrivals_star.plans import demo, jobs
    sf = "/root/testdata/sf0.001"
    base = scratch("temps")
    raw = demo.write_raw_inputs(spark, sf, base + "/raw")
    temps = spark.createDataFrame([("2000-01-01", "1.5", "0.1", 'O"Neill\nNorth', "Ireland"), ("2000-02-01", "2.5", None, 'O"Neill\nNorth', "Ireland")],
                                  "dt string, AverageTemperature string, AverageTemperatureUncertainty string, City string, Country string")
    write_csv(temps, base + "/temps")
    staged = jobs.run_stage(spark, changed(raw, temperatures=base + "/temps", temperatures_quotes="doubled"), base + "/stage")
    got = read_csv(spark, staged["temperatures"], multi_line=True).collect()
    assert [tuple(r) for r in got] == [('O"Neill\nNorth', "Ireland", "2.0")]
    countries = spark.createDataFrame([("7", "IRELAND")], "Code string, Country string")
    write_csv(countries, staged["countries"])
    final = jobs.run_final(spark, base + "/stage", base + "/final")
    assert [tuple(r) for r in read_table(spark, final["temperature"]).collect()] == [('O"Neill\nNorth', "7", "Ireland", 2.0)]
    with pytest.raises(ValueError):
        jobs.run_stage(spark, changed(raw, temperatures_quotes="single"), base + "/stage")


# --- replacing tables ---

def ids(spark, path):
    return sorted(r.id for r in read_table(spark, path).collect())


def test_a_failed_write_leaves_the_old_table(spark, scratch):
    path = scratch("table")
    write_parquet(spark.range(10), path)
    broken = spark.range(100).select(F.when(F.col("id") == 77, F.raise_error(F.lit("no"))).otherwise(F.col("id")).alias("id"))
    for write in (lambda: write_parquet(broken, path), lambda: write_parquet(broken.withColumn("p", F.lit(1)), path, ["p"])):
        with pytest.raises(Exception, match="no"):
            write()
        assert ids(spark, path) == list(range(10))
    assert replace.drop_unfinished(spark, path) and not replace.drop_unfinished(spark, path)
    write_parquet(read_table(spark, path).where("id > 4"), path)  # computed from the table it replaces
    assert ids(spark, path) == [5, 6, 7, 8, 9]
    assert sorted(os.listdir(os.path.dirname(path.replace("file:", "")))).count(os.path.basename(path) + ".switch") == 0


@pytest.mark.parametrize("step", [0, 1])
def test_a_switch_that_stops_half_way_is_finished(spark, scratch, monkeypatch, step):
    """The manifest is there and no, or one, folder has been moved: the new table is read, then put in place."""
    path = scratch("table")
    write_parquet(spark.range(3), path)
    move, calls = replace._move, []

    def failing(*args):
        if len(calls) == step:
            raise KeyboardInterrupt
        calls.append(args)
        move(*args)
    monkeypatch.setattr(replace, "_move", failing)
    with pytest.raises(KeyboardInterrupt):
        write_parquet(spark.range(5), path)
    monkeypatch.undo()
    assert ids(spark, path) == [0, 1, 2, 3, 4]
    replace.finish_switch(spark, path)
    assert ids(spark, path) == [0, 1, 2, 3, 4] and replace.current_path(spark, path) == path
    assert not [f for f in os.listdir(os.path.dirname(path.replace("file:", ""))) if f.startswith(os.path.basename(path) + ".")]


def test_a_manifest_cut_off_is_not_in_force(spark, scratch):
    path = scratch("table")
    write_parquet(spark.range(3), path)
    with open(path.replace("file:", "") + ".switch", "w") as f:
        f.write('{"new": "som')
    assert ids(spark, path) == [0, 1, 2]
    write_parquet(spark.range(4), path)
    assert ids(spark, path) == [0, 1, 2, 3]


KILLED = """
import sys
sys.path.insert(0, {root!r})
from arrivals_star.session import get_session
from arrivals_star.sources.sinks import write_parquet
spark = get_session("local[2]", 2, local_driver_memory="1g")
def sleepy(batches):
    import time
    for b in batches:
        time.sleep(0.5)
        yield b
df = spark.range(0, 2000, 1, 200).mapInArrow(sleepy, "id long")
print("writing", flush=True)
write_parquet(df, {path!r})
"""


def test_a_killed_job_leaves_the_old_table(spark, scratch):
    path = scratch("table")
    write_parquet(spark.range(10), path)
    code = KILLED.format(root=ROOT, path=path.replace("file:", ""))
    job = subprocess.Popen([sys.executable, "-c", code], stdout=subprocess.PIPE, stderr=subprocess.DEVNULL, text=True,
                           start_new_session=True)
    try:
        assert job.stdout.readline().strip() == "writing"
        folder, name = os.path.split(path.replace("file:", ""))
        for _ in range(100):  # files of the new table are there, and it is not complete
            new = [f for f in os.listdir(folder) if f.startswith(name + ".new-")]
            if new and any(x.endswith(".parquet") for _, _, fs in os.walk(os.path.join(folder, new[0])) for x in fs):
                break
            time.sleep(0.2)
        else:
            raise AssertionError("the job has not begun to write")
    finally:
        os.killpg(job.pid, signal.SIGKILL)
        job.wait()
    assert ids(spark, path) == list(range(10))
    write_parquet(spark.range(2), path)
    assert ids(spark, path) == [0, 1]
