"""Vector search, the URL filter, the pipeline and the registered queries."""

import os

import brute
import duckdb
import pytest


from arrivals_star.llm import url_filter, vector_topk
from arrivals_star.llm.registry import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


def test_top_k_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(vector_topk, "BLOCK_ROWS", 64)
    monkeypatch.setattr(vector_topk, "QUERY_ROWS", 2)
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    got = sorted(map(tuple, vector_topk.exact_top_k(df).collect()))
    assert got == brute.top_k(brute.rows_of(df, "vec_id", "embedding"))


def test_top_k_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (50, [1e6, -3.5]), (1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [1.0, 2.0]), (4, [1.0, 2.0]), (5, [1.0, 2.0]),
            (6, [1.0, None]), (7, [nan, 1.0]), (8, [inf, 1.0]), (9, None), (10, []), (None, [9.0, 9.0]), (11, [3.0]), (100, [2.0]),
            (-50, [0.001, -0.001]), (2, [1.0, 2.0]), (0, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS block", "2 AS rank")
    assert sorted(map(tuple, vector_topk.exact_top_k(df).collect())) == brute.top_k(rows)
    assert vector_topk.exact_top_k(df.where("vec_id > 1000")).collect() == []


def test_large_components_stay_exact(spark):
    rows = [(k, [float(2**20 + k) + 1 / 256, float(2**19 - 3 * k)]) for k in range(120)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, vector_topk.exact_top_k(df).collect())) == brute.top_k(rows)


def plain_url(url):
    at = (url or "").find("://")
    if at < 0:
        return "", ""
    rest = url[at + 3:]
    stop = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:stop])
    path = rest[stop:]
    return host, path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]


def plain_rule(host, path):
    fits = [(len(h + p), kind, h + p) for kind, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def test_url_rules(spark):
    urls = [r.url for r in spark.read.parquet(f"{SF}/pages.parquet").collect()] + [
        None, "", "no scheme", "http://", "://x", "HTTP://WWW.Example.NET/EN/", "http://a.net", "http://a.net?x=/", "http://xnet/",
        "https://net/", "http://e.example.net/en/1?a#b", "http://example.net.org/fr/x", "http://a://b.net/c", "http://ÄB.org/fr/\nx",
        "http://example.com/de/", "http://www.example.com/DE/"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").selectExpr("*", "'x' AS host", "1 AS path")
    got = {r.page_id: r for r in url_filter.filter_urls(df).collect()}
    for k, url in enumerate(urls):
        host, path = plain_url(url)
        kind, rule = plain_rule(host, path)
        assert (got[k].host, got[k].path, got[k].rule) == (host, path, rule)
        assert got[k].verdict == (kind or ("block" if got[k].unwanted >= 0.5 else "allow"))
    assert url_filter.filter_urls(df.where("page_id < 0")).collect() == []


def test_url_model_on_held_out_sites():
    rows = url_filter.default_labels()
    sites = {"casino-win", "spam-farm", "cheap-pills", "museum", "railway", "the-other"}
    split = lambda keep: [(*plain_url(u), y) for u, y in rows if any(s in u for s in sites) != keep]
    weights, bias = url_filter.train(split(True))
    test = split(False)
    z = url_filter.margins(url_filter._column([t[0] for t in test]), url_filter._column([t[1] for t in test]), weights, bias)
    good, bad = ([m for m, t in zip(z, test) if t[2] == y] for y in (0, 1))
    assert sum(b > g for b in bad for g in good) / (len(bad) * len(good)) > 0.9  # area under the curve
    with pytest.raises(ValueError):
        url_filter.train([("h", "p", 0)] * (url_filter.MAX_LABELLED + 1))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        if f.endswith(".parquet"):
            con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{SF}/{f}')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, duck, name):
    df, rel = QUERIES[name](spark, SF), duck.sql(ORACLE_SQL[name])
    cols = sorted(df.columns)
    assert cols == sorted(rel.columns)
    pick = lambda rows, names: sorted((tuple(r[names.index(c)] for c in cols) for r in rows), key=repr)
    assert pick([tuple(r) for r in df.collect()], df.columns) == pick(rel.fetchall(), rel.columns)


def test_every_operator_has_one_query():
    import __spark_entry__
    import re
    numbers = sorted(int(m[1]) for q in QUERIES if (m := re.match(r"op(\d+)_", q)))
    assert numbers == list(range(1, 14)) and set(QUERIES) <= set(__spark_entry__.queries())


def test_stages_decide_on_rows_not_ids(spark, nothing):
    """Null and repeated ids: no row is lost with another one's id, and none is exempt."""
    import corpus_pipeline as pipeline
    words = [f"word{i % 89}x{i * i % 53}" for i in range(120)]
    a, b, c = (" ".join(words[k:k + 60]) for k in (0, 30, 60))
    junk = "0 1 | 2 3 $$ ## 4 5 " * 40
    rows = [(3, b, 1), (5, a, 2), (5, b, 3), (5, b, 3), (None, a, 4), (None, c, 5), (None, c, 5), (6, c + " tail", 6), (None, None, 7),
            (8, "", 8), (9, junk, 9), (9, c + " tail", 10), (1 << 62, " ".join(words), 11)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `id` int").selectExpr("*", "'x' AS gone", "2 AS n", "3 AS row")
    stages = dict(pipeline.STAGES)
    keep = lambda df: sorted((tuple(r)[:3] for r in df.collect()), key=repr)
    after = stages["exact_dedup"](spark, docs, SF)
    assert after.columns == docs.columns
    texts = [r[1] or "" for r in keep(after)]
    assert sorted(texts) == sorted({r[1] or "" for r in rows})  # one row of each text
    assert (3, b, 1) in keep(after) and (6, c + " tail", 6) in keep(after) and (9, junk, 9) in keep(after)
    near = stages["near_dedup"](spark, after, SF)
    assert near.columns == docs.columns
    assert sum(r[1] in (c, c + " tail") for r in keep(near)) == 1  # near copies, one of them without an id
    assert {r[1] for r in keep(near)} >= {a, b, junk, "", " ".join(words)} - {None}
    good = stages["quality"](spark, docs, SF)
    assert good.columns == docs.columns and all(rows.count(r) == keep(good).count(r) for r in rows if r in keep(good))
    clean = stages["secrets"](spark, docs, SF)
    assert clean.columns == docs.columns and keep(clean) == sorted(rows, key=repr)
    for name, stage in pipeline.STAGES:
        assert stage(spark, nothing, SF).collect() == []


def test_pipeline_against_its_parts(spark):
    """Each stage keeps what the operator's plain version keeps of the stage's own input."""
    import corpus_pipeline as pipeline
    from arrivals_star.llm import quality, secrets
    docs = spark.read.parquet(f"{SF}/documents.parquet").cache()
    stages = dict(pipeline.STAGES)
    assert list(stages) == ["quality", "exact_dedup", "near_dedup", "secrets", "packing"]
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    kept = stages["quality"](spark, docs, SF).cache()
    assert ids(kept) == sorted(r.doc_id for r in quality.quality(docs).collect() if r.kept)
    for name, plain in (("exact_dedup", brute.exact_dedup), ("near_dedup", lambda d: brute.near_dup(d, 5, 80))):
        rows = plain(brute.rows_of(kept, "doc_id", "text"))
        after = stages[name](spark, kept, SF).cache()
        assert after.columns == docs.columns and ids(after) == sorted(r[0] for r in rows if r[3])
        kept = after
    clean = stages["secrets"](spark, kept, SF).cache()
    assert clean.columns == docs.columns and ids(clean) == ids(kept)
    assert all(len(r.text) == r.n_chars for r in clean.collect() if "[SECRET]" in r.text)
    assert all(not brute.secret_spans(r.text, secrets.CLASSES, secrets.ALLOW, secrets.ALLOW_WHOLE)[0] for r in clean.collect())
    packed = stages["packing"](spark, clean, SF)
    total = pipeline.run(spark, SF)
    digest = lambda df: sorted((r.doc_id, r.start, r.length, r.ids_crc32) for r in df.collect())
    assert sorted({x[0] for x in digest(packed)}) == ids(clean)
    assert sum(r.length for r in total.collect()) == sum(x[2] for x in digest(packed))
