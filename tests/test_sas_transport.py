"""SAS transport files: numbers, layout, byte ranges, and staging from them."""

import math
import struct

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from arrivals_star.plans import demo, jobs
from arrivals_star.plans.registry import SAS_LENGTHS
from arrivals_star.sources import SAS_TRANSPORT, read_table, register_sas, sas_transport as sas

SF = "/root/testdata/sf0.001"


@settings(max_examples=300, deadline=None)
@given(st.lists(st.floats(min_value=-7e75, max_value=7e75, allow_nan=False), min_size=1, max_size=20))
def test_numbers_come_back(values):
    back = sas.ibm_to_ieee(sas.ieee_to_ibm(np.array(values)))
    for x, y in zip(values, back):
        assert x == y or (abs(x) < 1e-77 and math.isclose(x, y, abs_tol=6e-79))


def test_known_numbers():
    """Words as the format's description gives them."""
    known = {1.0: "4110000000000000", -1.0: "C110000000000000", 0.0: "0000000000000000", 0.15625: "4028000000000000",
             -118.625: "C276A00000000000", 100.0: "4264000000000000", 16.0: "4210000000000000"}
    for x, word in known.items():
        assert sas.ieee_to_ibm(np.array([x])).tobytes().hex().upper() == word
        assert sas.ibm_to_ieee(np.frombuffer(bytes.fromhex(word), np.uint8).reshape(1, 8))[0] == x
    for first in (".", "_", "A", "Z"):
        raw = np.frombuffer(first.encode() + b"\0" * 7, np.uint8).reshape(1, 8)
        assert np.isnan(sas.ibm_to_ieee(raw)[0])
    assert sas.ieee_to_ibm(np.array([np.nan, np.inf, -np.inf])).tobytes() == (b"." + b"\0" * 7) * 3
    with pytest.raises(ValueError):
        sas.ieee_to_ibm(np.array([1e76]))


def by_hand(path, rows):
    """A file of one number of five bytes and one text of three, laid out without the writer."""
    def rec(x):
        return x.ljust(80, b" ")
    names = b""
    for k, (kind, size, name, at) in enumerate([(1, 5, b"NUM", 0), (2, 3, b"TXT", 5)]):
        names += struct.pack(">hhhh", kind, 0, size, k + 1) + name.ljust(8) + b" " * 40 + b" " * 8 + b"\0" * 8 + b" " * 8 + b"\0" * 4 + struct.pack(">i", at) + b"\0" * 52
    head = (rec(b"HEADER RECORD*******LIBRARY HEADER RECORD!!!!!!!" + b"0" * 30) + rec(b"SAS     SAS     SASLIB") + rec(b"")
            + rec(b"HEADER RECORD*******MEMBER  HEADER RECORD!!!!!!!000000000000000001600000000140")
            + rec(b"HEADER RECORD*******DSCRPTR HEADER RECORD!!!!!!!" + b"0" * 30) + rec(b"SAS     X       SASDATA") + rec(b"")
            + rec(b"HEADER RECORD*******NAMESTR HEADER RECORD!!!!!!!00000000020000000000000000000000") + names.ljust(320)
            + rec(b"HEADER RECORD*******OBS     HEADER RECORD!!!!!!!" + b"0" * 30))
    body = b"".join(rows)
    path.write_bytes(head + body.ljust(-(-len(body) // 80) * 80))


def test_a_file_of_another_writer(spark, tmp_path):
    register_sas(spark)
    rows = [bytes.fromhex("4110000000") + b"ab ", b".\0\0\0\0" + b"   ", bytes.fromhex("4264000000") + b" c "]
    by_hand(tmp_path / "x.xpt", rows)
    df = read_table(spark, str(tmp_path / "x.xpt"), SAS_TRANSPORT)
    assert df.dtypes == [("NUM", "double"), ("TXT", "string")]
    assert [tuple(r) for r in df.collect()] == [(1.0, "ab"), (None, None), (100.0, " c")]
    by_hand(tmp_path / "none.xpt", [])
    assert read_table(spark, str(tmp_path / "none.xpt"), SAS_TRANSPORT).collect() == []
    (tmp_path / "bad.xpt").write_bytes(b"no such file" * 30)
    with pytest.raises(Exception, match="no SAS transport file"):
        read_table(spark, str(tmp_path / "bad.xpt"), SAS_TRANSPORT).collect()


def test_written_rows_come_back_from_many_ranges(spark, scratch):
    register_sas(spark)
    rows = [(k, None if k % 7 == 0 else k / 3, None if k % 5 == 0 else f"é{k}", "x" * (k % 40)) for k in range(5000)]
    df = spark.createDataFrame(rows, "id int, number double, text string, `long name of a column` string").repartition(3)
    path = scratch("sas").replace("file:", "")
    df.write.format(SAS_TRANSPORT).options(**{"length.text": "12"}).mode("append").save(path)
    back = read_table(spark, path, SAS_TRANSPORT, split_bytes="40000")
    assert back.rdd.getNumPartitions() > 20
    want = sorted((float(a), b, c, d or None) for a, b, c, d in rows)
    assert sorted(tuple(r) for r in back.collect()) == want
    some = read_table(spark, path, SAS_TRANSPORT, columns="text, id")
    assert some.columns == ["text", "id"] and some.agg(F.sum("id")).first()[0] == sum(range(5000))
    with pytest.raises(Exception, match="unknown columns"):
        read_table(spark, path, SAS_TRANSPORT, columns="nothing").collect()


def test_what_does_not_fit_is_an_error(spark, scratch):
    register_sas(spark)
    for df, told in ((spark.createDataFrame([("x" * 300,)], "t string"), "over its length"),
                     (spark.createDataFrame([(True,)], "b boolean"), "neither a number nor text")):
        with pytest.raises(Exception, match=told):
            df.write.format(SAS_TRANSPORT).mode("append").save(scratch("bad").replace("file:", ""))


def test_staging_job_on_sas_files(spark, scratch):
    """The staging job reads raw arrivals in the format; rows are those of the Parquet input, NaN as null."""
    from dataclasses import replace
    base = scratch("sas_job")
    raw = demo.write_raw_inputs(spark, SF, base + "/raw")
    register_sas(spark)
    path = (base + "/arrivals_sas").replace("file:", "")
    rows = spark.read.parquet(raw.arrivals)
    rows.write.format(SAS_TRANSPORT).options(**SAS_LENGTHS).mode("append").save(path)
    # all numbers of the format are doubles, and its missing number is null
    rows = rows.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(c) if t != "string" else F.col(c) for c, t in rows.dtypes])
    rows.write.parquet(base + "/doubles")
    a = jobs.run_stage(spark, replace(raw, arrivals=path, arrivals_format=SAS_TRANSPORT), base + "/a")["arrivals"]
    b = jobs.run_stage(spark, replace(raw, arrivals=base + "/doubles"), base + "/b")["arrivals"]
    got, want = spark.read.parquet(a), spark.read.parquet(b)
    assert got.dtypes == want.dtypes
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
