"""Merkle manifest, vector codes and document fingerprints against plain versions."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from arrivals_star.llm import fingerprints as prints, merkle_manifest as merkle, vector_codes as codes

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- Merkle manifest ---

def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_tree(nodes):
    """Levels of one tree, and each leaf's siblings from the bottom up."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][k:k + 16])) for k in range(0, len(levels[-1]), 16)])
    proofs = []
    for i in range(len(nodes)):
        proof = []
        for level in levels[:-1]:
            lo = i - i % 16
            proof.append((level[lo:i], level[i + 1:lo + 16]))
            i //= 16
        proofs.append(proof)
    return levels[-1][0], proofs


def plain_manifest(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append((r[0] is not None, r[0] or 0, leaf_of(r), r))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = [(sorted(groups[s], key=lambda x: x[:3])) for s in order]
    done = [plain_tree([x[2] for x in t]) for t in trees]
    root, above = plain_tree([s for s, _ in done]) if done else (None, [])
    out = []
    for tree, (subroot, proofs), top in zip(trees, done, above):
        for (_, _, leaf, r), proof in zip(tree, proofs):
            text = r[4]
            if text is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                text = text.translate(LOWER)
            h = leaf_of((*r[:4], text))
            for left, right in proof + top:
                h = sha("".join(left) + h + "".join(right))
            joined = "".join("".join(a + b) for a, b in proof + top)
            out.append((r[0], leaf, subroot, root, sha(joined), h, h == root))
    return out


def manifest(df):
    struck = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    text = F.when(struck, F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise(F.col("text"))
    return merkle.merkle_manifest(df, claimed={"text": text})


NAMES = ("doc_id", "source", "lang", "n_chars", "text")


def same_rows(got, want):
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("panel_bits", [2, 13])
def test_manifest_of_documents(documents, monkeypatch, panel_bits):
    """Leaf partitions of four leaves need siblings on every level, those of 8,192 on few."""
    monkeypatch.setattr(merkle, "PANEL_BITS", panel_bits)
    same_rows(manifest(documents).collect(), plain_manifest(brute.rows_of(documents, *NAMES)))


def test_manifest_of_odd_rows(odd, monkeypatch):
    monkeypatch.setattr(merkle, "PANEL_BITS", 1)
    df = odd.selectExpr("doc_id", "lang AS source", "run AS lang", "n AS n_chars", "text", "1 AS panel", "2 AS tree", "3 AS at")
    df = df.unionByName(df.selectExpr("doc_id", "NULL AS source", "lang", "n_chars", "text", "panel", "tree", "at"))
    same_rows(manifest(df).collect(), plain_manifest(brute.rows_of(df, *NAMES)))


def test_manifest_of_many_groups_and_one_leaf(spark, nothing):
    """More groups than a run holds: the top tree has levels too. One row is its own root."""
    rows = [(k, f"s{k % 290}", None, k, f"Text {k}") for k in range(700)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    same_rows(manifest(df).collect(), plain_manifest(rows))
    same_rows(manifest(df.limit(1)).collect(), plain_manifest([tuple(r) for r in df.limit(1).collect()]))
    assert manifest(nothing).collect() == []


def test_manifest_of_equal_rows(spark):
    """Rows that nothing tells apart are leaves of their own, dealt over partitions."""
    rows = [(1, "a", "en", 1, "X")] * 400 + [(None, None, None, None, None)] * 50
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    same_rows(manifest(df).collect(), plain_manifest(rows))


def test_proofs_prove(documents):
    """A proof is the joined siblings; a leaf that was changed does not fold to the root."""
    rows = merkle.merkle_manifest(documents, with_proofs=True).collect()
    assert all(r.verified and sha(r.proof) == r.proof_sha256 for r in rows)
    struck = manifest(documents).collect()
    changed = {d for d, t in brute.rows_of(documents, "doc_id", "text")
               if t and zlib.crc32(str(d).encode()) % 5 == 0 and t.translate(LOWER) != t}
    assert changed and {r.doc_id for r in struck if not r.verified} == changed


def test_missing_nodes_are_few(spark):
    """An interval lacks at most 30 digests a level, whatever its length, and none that it can derive."""
    df = spark.createDataFrame([(0, 0, 5000, 9001, 100_000)], "panel long, tree long, first long, n long, width long")
    got = defaultdict(set)
    for r in merkle.missing_nodes(df, 100_000).collect():
        got[r["level"]].add(r["index"])
    known, width, level = set(range(5000, 14001)), 100_000, 0
    while width > 1:
        wanted = {j for i in known for j in range(i - i % 16, min(i - i % 16 + 16, width))}
        assert got.pop(level, set()) == wanted - known and len(wanted - known) <= 30
        known, width, level = {i // 16 for i in known}, -(-width // 16), level + 1
    assert not got


# --- vector codes ---

def plain_codes(rows, parts=8, entries=16, rounds=6):
    """rows: (vec_id, vector, label); vectors of one length."""
    kept = [(i, [math.floor(4096 * x) for x in v], lab) for i, v, lab in rows
            if v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return []
    w = len(kept[0][1]) // parts
    cut = [[v[p * w:(p + 1) * w] for p in range(parts)] for _, v, _ in kept]
    books = [[cut[e][p] for e in range(min(entries, len(kept)))] for p in range(parts)]

    def assign():
        out = []
        for c in cut:
            out.append([min((sum((a - b) ** 2 for a, b in zip(c[p], entry)), e) for e, entry in enumerate(books[p])) for p in range(parts)])
        return out
    for _ in range(rounds):
        got = assign()
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [c[p] for c, g in zip(cut, got) if g[p][1] == e]
                if mine:
                    books[p][e] = [sum(col) // len(mine) for col in zip(*mine)]
    digest = sha(",".join(str(x) for book in books for entry in book for x in entry))
    got, by_label = assign(), defaultdict(int)
    errors = [sum(d for d, _ in g) for g in got]
    for (_, _, lab), e in zip(kept, errors):
        by_label[lab] += e
    return [(i, lab, "".join(f"{e:02x}" for _, e in g), err, by_label[lab], digest)
            for (i, _, lab), g, err in zip(kept, got, errors)]


def test_codes_equal_brute_force(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    same_rows(codes.vector_codes(df).collect(), plain_codes(brute.rows_of(df, "vec_id", "embedding", "label")))


@pytest.mark.parametrize("cell", [3, 1000, 1 << 26])
def test_codes_do_not_depend_on_the_grid(spark, cell):
    """Ties, repeated vectors and negative components; cells from single points to one for all."""
    rng = random.Random(6)
    rows = [(k, [rng.randint(-3, 3) / 1024 for _ in range(16)], rng.choice([None, "a", "b"])) for k in range(300)]
    rows += [(k, rows[0][1], "a") for k in range(300, 500)] + [(7, rows[3][1], "c"), (None, rows[5][1], None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string").repartition(3)
    same_rows(codes.vector_codes(df, cell=cell).collect(), plain_codes(rows))


def test_codes_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    good = [(k, [k / 7.0] * 8, k % 2) for k in (4, 9, 2)]
    bad = [(0, None, 1), (1, [], 1), (3, [1.0] * 7 + [None], 1), (5, [nan] * 8, 1), (6, [-inf] + [0.0] * 7, 1)]
    df = spark.createDataFrame(good + bad, "vec_id long, embedding array<float>, label int").selectExpr("*", "'x' AS code", "1 AS id", "2 AS v")
    want = plain_codes([(i, [float(np.float32(x)) for x in v], lab) for i, v, lab in good])
    same_rows(codes.vector_codes(df).collect(), want)
    # vectors of another length than the first one's, and lengths that cannot be cut, take no part
    more = df.unionByName(spark.createDataFrame([(50, [1.0] * 16, 1), (51, [1.0] * 9, 1)], "vec_id long, embedding array<float>, label int"),
                          allowMissingColumns=True)
    same_rows(codes.vector_codes(more).collect(), want)
    assert codes.vector_codes(df.where("vec_id = 0")).collect() == []
    renamed = df.selectExpr("vec_id AS ident", "embedding AS vec", "label AS embedding", "label AS vec_id")
    same_rows(codes.vector_codes(renamed, "ident", "vec", "embedding").collect(), want)


def test_large_components(spark):
    rows = [(k, [float((k * 37 % 11) << 18), -float(k << 15)] * 4, k % 3) for k in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    same_rows(codes.vector_codes(df).collect(), plain_codes(rows))
    huge = spark.createDataFrame([(k, [1e300 if k % 2 else -1e30] * 8, 0) for k in range(40)], "vec_id long, embedding array<double>, label int")
    assert {r.error for r in codes.vector_codes(huge).collect()} == {0}
    with pytest.raises(ValueError):
        codes.CellTable(np.zeros((1, 2), np.int64), 0)


def test_cells_that_share_a_slot_stay_exact(monkeypatch):
    monkeypatch.setattr(codes, "SLOT_BITS", 2)
    rng = np.random.default_rng(1)
    book, x = rng.integers(-900, 900, (16, 4)), rng.integers(-900, 900, (3000, 4))
    table = codes.CellTable(book, 100)
    for part in (x[:1000], x[:1000], x[1000:]):
        code, far = table.nearest(part)
        d = ((part[:, None] - book) ** 2).sum(axis=2)
        assert (far == d.min(axis=1)).all() and (code == d.argmin(axis=1)).all()


# --- fingerprints ---

def plain_print(text, rank, shape):
    raw = (text or "").encode()
    w, reach = shape.window, shape.reach
    if len(raw) < shape.short:
        places = list(range(max(len(raw) - prints.SMALL + 1, min(len(raw), 1))))
        w = prints.SMALL if len(raw) >= prints.SMALL else len(raw)
    else:
        most = round(w * math.log2(w) * prints.SCALE)
        ranks = []
        for i in range(len(raw) - w + 1):
            total = sum(round(c * math.log2(c) * prints.SCALE) for c in np.bincount(list(raw[i:i + w])).tolist() if c)
            ranks.append(rank[min((most - total) * prints.BINS // most, prints.BINS - 1)])
        points = [0] * len(ranks)
        for i in range(len(ranks) - reach + 1):
            points[min(range(i, i + reach), key=lambda j: (ranks[j], j))] += 1
        best = points.index(max(points))
        places = [i for i, n in enumerate(points) if n >= shape.points or i == best]
    return prints.render(prints.filter_bits(np.frombuffer(raw, np.uint8), np.array(places, np.int64), w))


def plain_counts(texts, window):
    most, counts = round(window * math.log2(window) * prints.SCALE), np.zeros(prints.BINS, np.int64)
    for t in texts:
        raw = (t or "").encode()
        for i in range(len(raw) - window + 1):
            total = sum(round(c * math.log2(c) * prints.SCALE) for c in np.bincount(list(raw[i:i + window])).tolist() if c)
            counts[min((most - total) * prints.BINS // most, prints.BINS - 1)] += 1
    return counts


@pytest.fixture(scope="module")
def some_texts(odd):
    rng = random.Random(2)
    texts = [t for _, t in brute.rows_of(odd, "doc_id", "text")]
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyzé") for _ in range(rng.randint(1, 9))) for _ in range(90)]
    return texts + [" ".join(rng.choice(words) for _ in range(n)) for n in (1, 3, 20, 50, 60, 400)] + ["a" * 700, "ab" * 500]


def test_prints_equal_brute_force(spark, some_texts, monkeypatch):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(some_texts)], "doc_id long, text string")
    rank = prints.entropy_ranks(df)
    assert (rank == prints.rank_of(plain_counts(some_texts, 32))).all()
    got = {r.doc_id: r.fingerprint for r in prints.fingerprint(df).collect()}
    for k, t in enumerate(some_texts):
        assert got[k] == plain_print(t, rank, prints.Features())
    assert got[0] == "" and all(got[k] for k, t in enumerate(some_texts) if t)
    raw = [(t or "").encode() for t in some_texts]
    whole = prints.fingerprints(raw, rank, prints.Features())
    monkeypatch.setattr(prints, "SLICE", 1000)  # long texts come in slices
    assert prints.fingerprints(raw, rank, prints.Features()) == whole == [got[k] for k in range(len(raw))]


@pytest.mark.parametrize("table", ["documents", "odd"])
def test_edit_probe(request, table):
    """Edited texts, and the likeness of fingerprints that were made one by one."""
    df = request.getfixturevalue(table)
    docs = brute.rows_of(df, "doc_id", "text")
    rank = prints.entropy_ranks(df)
    key = {t: r for t, r in df.selectExpr("text", "xxhash64(coalesce(cast(text AS binary), X'')) AS h").distinct().collect()}
    docs.sort(key=lambda r: (r[0] is None, r[0] or 0, key[r[1]]))
    make = lambda t: prints.fingerprints([(t or "").encode()], rank, prints.Features())[0]
    want = []
    for (doc, text), (_, after) in zip(docs, docs[1:] + docs[:1]):
        text, after = text or "", after or ""
        n = len(text) // 4
        new = text[:len(text) - n] + after[:n]
        want.append((doc, len(text), sha(new), make(text), make(new), prints.likeness(make(text), make(new)),
                     prints.likeness(make(text), make(after))))
    same_rows(prints.edit_probe(df).collect(), want)


def test_probe_of_one_and_of_no_rows(spark, nothing):
    one = spark.createDataFrame([(4, "Some text that follows itself, of no great length")], "doc_id long, text string")
    row = prints.edit_probe(one).collect()[0]
    assert row.near_next == 1.0 and 0 < row.near_edited < 1
    assert prints.edit_probe(nothing).collect() == [] and prints.fingerprint(nothing).collect() == []


def test_likeness():
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(3000)]
    rank = prints.rank_of(np.zeros(prints.BINS, np.int64))
    make = lambda t: prints.fingerprints([t.encode()], rank, prints.Features())[0]
    a, b = (" ".join(rng.choice(words) for _ in range(8000)) for _ in range(2))
    assert prints.likeness(make(a), make(a)) == 1.0 == prints.likeness("", "")
    assert prints.likeness(make(a), "") == 0.0 and prints.likeness(make(a), make(b)) < 0.05
    half = a[:len(a) // 2] + b[len(b) // 2:]
    assert 0.3 < prints.likeness(make(a), make(half)) < 0.7
    assert prints.likeness(make(a), make(half)) == prints.likeness(make(half), make(a))
    assert prints.likeness(make(a), make(a[:500])) < 0.1  # a small part is not like the whole


def test_held_out_edits_are_told_from_neighbours(spark):
    got = prints.edit_probe(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect()
    assert sum(r.near_edited > 0.4 for r in got) > 0.95 * len(got)
    assert sum(r.near_next < 0.2 for r in got) > 0.99 * len(got)
