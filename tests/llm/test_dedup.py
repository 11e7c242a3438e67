"""Exact, near, substring and suffix dedup against brute force."""

import os
import random

import brute
import pytest

from arrivals_star.llm import exact_dedup as exact, minhash_dedup as minhash
from arrivals_star.llm.components import components
from arrivals_star.llm import substring_dedup as substring
from arrivals_star.llm.substring_dedup import substring_dedup
from arrivals_star.llm.suffix_dedup import front_code, front_decode, merge_runs, suffix_dedup

CASES = {
    "suffix": (suffix_dedup, brute.suffix_dedup),
    "substring": (substring_dedup, brute.substring_dedup),
    "near": (minhash.near_dup_components, brute.near_dup),
    "exact": (exact.exact_dedup, brute.exact_dedup),
}


def same(got, want):
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("table", ["documents", "odd"])
def test_equals_brute_force(request, name, table):
    df = request.getfixturevalue(table)
    operator, plain = CASES[name]
    same(operator(df).collect(), plain(brute.rows_of(df, "doc_id", "text")))


@pytest.mark.parametrize("name", CASES)
def test_empty_table(nothing, name):
    out = CASES[name][0](nothing)
    assert out.collect() == [] and out.columns[0] == "doc_id"


@pytest.mark.parametrize("name", CASES)
def test_other_column_names(spark, odd, name):
    renamed = odd.withColumnsRenamed({"doc_id": "the id", "text": "the.body"}).selectExpr(
        "`the id` AS ident", "`the.body` AS body", "lang AS text", "n AS doc_id")
    operator, plain = CASES[name]
    same(operator(renamed, "ident", "body").collect(), plain(brute.rows_of(odd, "doc_id", "text")))


def test_one_more_bucket_or_partition_changes_nothing(spark, odd):
    want = brute.suffix_dedup(brute.rows_of(odd, "doc_id", "text"))
    for n in (1, 3, 17):
        same(suffix_dedup(odd, n_buckets=n).collect(), want)
        same(substring_dedup(odd, n_buckets=n).collect(), brute.substring_dedup(brute.rows_of(odd, "doc_id", "text")))


def test_count_min_lets_few_windows_through_and_loses_none():
    """Counters are added up over runs; windows that do not repeat are let through at the stated rate."""
    import numpy as np
    import pyarrow as pa
    rng = random.Random(12)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(5)) for _ in range(4000)]
    passage = " ".join(rng.choice(words) for _ in range(60))
    runs = []
    for r in range(6):
        texts = [" ".join(rng.choice(words) for _ in range(1500)) + (" " + passage if d == 3 else "") for d in range(8)]
        runs.append(pa.table([pa.array(range(r * 8, r * 8 + 8)), pa.array([t.encode() for t in texts])], names=["doc_id", "text"]))
    size = sum(len(t) for run in runs for t in run["text"].to_pylist())
    n_buckets = 5
    n_cells = substring.cells_of_a_bucket(size, n_buckets)
    assert n_cells * n_buckets >= size and n_cells & (n_cells - 1) == 0
    sent = pa.concat_tables([substring.sketch_run(20, n_buckets, n_cells)((pa.scalar(r),), t) for r, t in enumerate(runs)])
    replies = {r: {} for r in range(len(runs))}
    for part in range(substring.ROWS):
        for b in range(n_buckets):
            mine = sent.filter(pa.array([p == part and x == b for p, x in zip(sent["part"].to_pylist(), sent["bucket"].to_pylist())]))
            for row in substring.merge_sketches(n_cells)((pa.scalar(0), pa.scalar(part), pa.scalar(b)), mine).to_pylist():
                replies[row["run"]][0, part, b] = row["n"], row["mask"]
    through = total = repeated = 0
    for r, t in enumerate(runs):
        x = substring.RunWindows(t, 20, n_buckets, n_cells)
        got = set(x.at[x.estimated_repeated(replies[r])].tolist())
        doc3 = np.flatnonzero(x.doc == 3)
        inside = set(range(int(doc3[-1]) - 59, int(doc3[-1]) - 18))  # the passage's windows
        assert inside <= got
        through, total, repeated = through + len(got), total + len(x.at), repeated + len(inside)
    assert (through - repeated) / (total - repeated) < 0.04


def test_windows_that_almost_repeat(spark):
    """Strings of 49 equal bytes stay; of 50 go; runs that touch are one span."""
    a = "".join(chr(97 + i * 7 % 26) for i in range(200))
    rows = [(1, a), (2, "x" * 9 + a[:49] + "y" * 9), (3, "é" + a[3:53] + "ü" + a[53:103] + a[20:80]), (4, a[150:] + "\x00" + a[:60])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = suffix_dedup(df).collect()
    same(got, brute.suffix_dedup(rows))
    assert {r.doc_id: r.n_removed for r in got}[2] == 0


def test_loser_tree_merges_and_keeps_prefixes():
    rng = random.Random(3)
    for _ in range(150):
        runs = [sorted({bytes(rng.choice(b"ab") for _ in range(7)) for _ in range(rng.randint(0, 9))}) for _ in range(rng.randint(1, 9))]
        prefix = lambda x: [0] + [len(os.path.commonprefix([a, b])) for a, b in zip(x, x[1:])] if x else []
        run, at, shared = merge_runs(runs, [prefix(r) for r in runs])
        out = [runs[r][i] for r, i in zip(run, at)]
        assert out == sorted(x for r in runs for x in r) and shared == prefix(out)


def test_front_coding_round_trip():
    import numpy as np
    key = np.sort(np.random.default_rng(1).integers(0, 3, (300, 12), dtype=np.uint8).view("V12").ravel()).view(np.uint8).reshape(-1, 12)
    assert (front_decode(*front_code(key), 12) == key).all()


def test_near_copies_whose_hub_is_no_link(spark):
    """A chain in which the smallest document of the band groups is similar to few of the others."""
    rng = random.Random(5)
    base = [f"t{i}" for i in range(400)]
    rows, text = [], list(base)
    for d in range(40):
        rows.append((d, " ".join(text)))
        for _ in range(5):
            text[rng.randrange(400)] = f"n{d}{rng.random():.4f}"
    rows += [(100 + k, f"unlike number {k} " * 3 + " ".join(rng.sample(base, 50))) for k in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = minhash.near_dup_components(df).collect()
    same(got, brute.near_dup(rows))
    assert len({r.component_id for r in got if r.doc_id < 40}) < 5


def test_sketch_estimates_are_near_the_truth():
    import numpy as np
    rng = np.random.default_rng(2)
    for share in (0.5, 0.85, 0.95):
        both = rng.integers(0, 1 << 63, 4000, dtype=np.uint64)
        a, b = (np.unique(np.concatenate([both, rng.integers(0, 1 << 63, int(2000 * (1 / share - 1)), dtype=np.uint64)]) * np.uint64(2)) for _ in "ab")
        ra, rb = (minhash.registers(x, np.zeros(len(x), int), 1) for x in (a, b))
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        got, error = minhash.estimate(ra, rb, np.array([float(len(a))]), np.array([float(len(b))]))
        assert abs(got[0] - true) < 6 * max(error[0], 0.03)


def short_pairs(seed, pairs, shared, more, width):
    """Pairs of short texts: ``shared`` shingles in both, ``more`` added by the second one."""
    rng = random.Random(seed)
    rows = []
    for k in range(pairs):
        text = [f"w{rng.random():.9f}" for _ in range(shared + width - 1)]
        rows += [(2 * k, " ".join(text)), (2 * k + 1, " ".join(text + [f"v{rng.random():.9f}" for _ in range(more)]))]
    return rows


def test_short_near_copies_are_all_found(spark):
    """Texts of 6 to 60 shingles, 0.85 to 0.95 similar."""
    rows = []
    for n, (shared, more) in enumerate([(6, 1), (9, 1), (12, 2), (17, 3), (19, 1), (34, 6), (45, 5), (51, 9), (57, 3)]):
        rows += [(1000 * n + d, t) for d, t in short_pairs(n, 120, shared, more, 3)]
    got = minhash.near_dup_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    same(got, brute.near_dup(rows))
    assert sum(r.kept for r in got) == len(rows) // 2


def test_the_pipeline_drops_short_near_copies(spark):
    """Texts of 4 to 80 five-word shingles that are 0.8 similar: one of each pair stays."""
    import corpus_pipeline
    rows = []
    for n, (shared, more) in enumerate([(4, 1), (8, 2), (16, 4), (40, 10), (80, 20)]):
        rows += [(1000 * n + d, t) for d, t in short_pairs(50 + n, 120, shared, more, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    after = corpus_pipeline.drop_near_copies(spark, docs, "").collect()
    assert sorted(r.doc_id for r in after) == sorted(r[0] for r in brute.near_dup(rows, 5, 80) if r[3])
    assert len(after) == len(rows) // 2


def test_copies_of_each_other_under_another_hub(spark, monkeypatch):
    """A large group of near copies shares bands with an older, different document: linked within a few blocks."""
    monkeypatch.setattr(minhash, "TILE", 16)
    monkeypatch.setattr(minhash, "SETS_TILE", 11)
    rng = random.Random(11)
    base = [f"t{i}" for i in range(200)]
    rows = [(0, " ".join(base[:150] + [f"z{i}" for i in range(60)]))]
    for d in range(1, 120):
        text = list(base)
        for _ in range(4):
            text[rng.randrange(150, 200)] = f"n{d}{rng.random():.4f}"
        rows.append((d, " ".join(text)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    same(minhash.near_dup_components(df).collect(), brute.near_dup(rows))


def test_a_block_gives_as_few_pairs_as_connect_it():
    import numpy as np
    import pyarrow as pa
    rng = np.random.default_rng(4)
    regs = np.tile(rng.integers(1, 60000, minhash.COMPARED, dtype=np.uint16), (300, 1))  # all alike
    n, one = len(regs), np.arange(500, dtype=np.uint64).tobytes()
    table = pa.table({"asks": pa.array(np.repeat([True, False], [100, 200])), "outside": pa.array(np.ones(n, bool)),
                      "doc_id": pa.array(np.concatenate([np.arange(100), np.arange(200)])),
                      "component": pa.array(np.concatenate([np.arange(100), np.arange(200)])),
                      "n_shingles": pa.array(np.full(n, 500)), "registers": pa.array([r.tobytes() for r in regs], pa.binary()),
                      "shingles": pa.array([one] * n, pa.binary())})
    for work in (minhash.near_forest(85), minhash.block_links(85)):
        got = work((), table)
        assert got.num_rows == 99 and all(a > b for a, b in zip(got["a"].to_pylist(), got["b"].to_pylist()))
        tree = list(range(100))
        for a, b in zip(got["a"].to_pylist(), got["b"].to_pylist()):
            a, b = tree[a], tree[b]
            assert a != b
            tree = [a if t == b else t for t in tree]
        assert len(set(tree)) == 1


def test_bands_miss_few_pairs_at_any_threshold():
    assert minhash.band_shape(85) == (6, 42) and minhash.band_shape(80) == (5, 51)
    for per_cent in range(10, 100):
        rows, n = minhash.band_shape(per_cent)
        assert rows * n <= minhash.BUCKETS and (1 - (per_cent / 100) ** rows) ** n <= minhash.MISSED


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)] + [(7, 7), (None, 3)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for a, b in links:
        if None not in (a, b) and a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for x in list(parent)}


def test_exact_merge_refuses_a_digest_of_two_lengths():
    with pytest.raises(ValueError):
        list(exact._fold(iter([(b"d" * 32, 1, 1, 10), (b"d" * 32, 2, 1, 11)])))
