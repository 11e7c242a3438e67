"""URL filter: rules by host and path, and a logistic regression for urls that no rule fits.

The model sees hashed character n-grams of host and path and is trained from a small labelled URL
table; its coefficients are one array of ``DIM`` numbers, which every task gets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from arrivals_star.llm import spans

U64 = np.uint64
GRAMS = (3, 4, 5)
DIM = 1 << 15
MAX_LABELLED = 10_000  # rows of the labelled table at most; a longer one is refused
#: Fixed values of the filter's contract: verdict, host, path.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))

#: Labelled URLs the default model is trained from: words of unwanted sites, and ordinary ones.
UNWANTED_SITES = ("casino-win", "best-casino", "poker-stars-bonus", "free-bets", "bet-now", "sports-bets", "cheap-pills",
                  "buy-pills-online", "viagra-shop", "adult-x", "xxx-adult", "porn-tube", "hot-adult-cams", "spam-farm",
                  "link-farm", "seo-spam", "ads-track", "click-ads", "ad-tracker", "track-pixel", "win-prize-now",
                  "free-money", "crack-warez", "fake-watches", "payday-loans")
ORDINARY_SITES = ("news", "wiki", "library", "university", "weather", "recipes", "gardening", "museum", "city-council",
                  "railway", "photos", "music-school", "history", "science", "docs", "support", "books", "travel", "health",
                  "thehouse", "stations", "nation", "theater", "rethink", "the-other", "mountain", "handwork", "things",
                  "blogger", "webshop")
PAGES = ("/", "/en/1024", "/de/77.html", "/fr/5/", "/es/300", "/index.html", "/en/20931", "/about", "")


def default_labels() -> list[tuple[str, int]]:
    """(url, 1 = unwanted) of every listed site under a few common prefixes and pages."""
    out = []
    for sites, label in ((UNWANTED_SITES, 1), (ORDINARY_SITES, 0)):
        for i, site in enumerate(sites):
            for j, prefix in enumerate(("", "www.", "blog.", "m.")):
                top = ("example.com", "example.org", "example.net", "org", "com")[(i + j) % 5]
                out.append((f"https://{prefix}{site}.{top}{PAGES[(2 * i + j) % len(PAGES)]}", label))
    return out


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), upper, upper.lower())


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    url = F.coalesce(url.cast("string"), F.lit(""))
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def _column(texts: list[str]) -> pa.Array:
    return pa.array([t.encode() for t in texts], pa.binary())


def gram_slots(col: pa.Array, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Slot and row of every n-gram of the column's values, each with a mark before and after it."""
    buf, offsets = spans.run_buffer(col)
    n = len(offsets) - 1
    marked = np.full(len(buf) + 2 * n, 1, np.uint8)  # byte 1 marks both ends
    inside = spans.ragged(offsets[:-1] + 2 * np.arange(n) + 1, np.diff(offsets))
    marked[inside] = buf
    row = np.repeat(np.arange(n), np.diff(offsets) + 2)
    slots, rows = [], []
    with np.errstate(over="ignore"):
        for size in GRAMS:
            m = max(len(marked) - size + 1, 0)
            h = np.full(m, U64(seed * 1000 + size), U64)
            for k in range(size):
                h = h * U64(0x9E3779B97F4A7C15) + marked[k:k + m]
            at = np.flatnonzero(row[:m] == row[size - 1:]) if m else np.zeros(0, np.int64)
            slots.append((spans.mix(h[at]) % U64(DIM)).astype(np.int64))
            rows.append(row[at])
    return np.concatenate(slots), np.concatenate(rows)


def margins(host: pa.Array, path: pa.Array, weights: np.ndarray, bias: float) -> np.ndarray:
    """Linear score of each url: bias + sum of its grams' weights / root of their number."""
    n = len(host)
    total, count = np.zeros(n), np.zeros(n)
    for col, seed in ((host, 1), (path, 2)):
        slot, row = gram_slots(col, seed)
        total += np.bincount(row, weights[slot], n)
        count += np.bincount(row, minlength=n)
    return bias + total / np.sqrt(np.maximum(count, 1))


def train(labelled: list[tuple[str, str, int]], steps: int = 300, rate: float = 2.0, l2: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and bias from (host, path, label) rows, by full-batch gradient steps."""
    if len(labelled) > MAX_LABELLED:
        raise ValueError(f"the labelled table has {len(labelled)} rows; at most {MAX_LABELLED} are used")
    host, path = _column([x[0] for x in labelled]), _column([x[1] for x in labelled])
    y = np.array([x[2] for x in labelled], float)
    parts = [gram_slots(c, s) for c, s in ((host, 1), (path, 2))]
    slot, row = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    scale = 1 / np.sqrt(np.maximum(np.bincount(row, minlength=len(y)), 1))
    value = scale[row]
    weights, bias = np.zeros(DIM), 0.0
    for _ in range(steps):
        z = bias + np.bincount(row, weights[slot] * value, len(y))
        error = (1 / (1 + np.exp(-z)) - y) / len(y)
        weights -= rate * (np.bincount(slot, error[row] * value, DIM) + l2 * weights)
        bias -= rate * error.sum()
    return weights, float(bias)


def _score(weights: np.ndarray, bias: float, schema: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = margins(batch["host"].cast(pa.binary()), batch["path"].cast(pa.binary()), weights, bias)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(1 / (1 + np.exp(-z)))],
                                             names=[*batch.schema.names, "unwanted"])
    return work


def filter_urls(df: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES,
                labelled: list[tuple[str, int]] | None = None, threshold: float = 0.5) -> DataFrame:
    """page_id, host, path, rule, verdict, unwanted of every row.

    A rule fits its host and subdomains where the path starts with the rule's; the longest rule
    gives the verdict, else the model does: block from ``threshold`` on. A null url, or one without
    ``://``, has empty host and path, fits no rule and is judged by the model's bias (allow, with
    the default table). Null ids stay null; repeated rows each give a row; other columns are
    ignored; an empty table gives an empty result.
    """
    spark = df.sparkSession
    labels = spark.createDataFrame(labelled if labelled is not None else default_labels(), "url string, label int")
    known = labels.select(host_of(F.col("url")), path_of(F.col("url")), "label").limit(MAX_LABELLED + 1).collect()
    weights, bias = train([tuple(r) for r in known])
    url = F.col(url_col)
    picked = df.select(F.col(id_col).cast("long").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    schema = "page_id long, host string, path string, unwanted double"
    scored = picked.mapInArrow(_score(weights, bias, schema), schema)
    rule, verdict = F.lit(None).cast("string"), F.when(F.col("unwanted") >= threshold, "block").otherwise("allow")
    for kind, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule, verdict = F.when(fits, host + path).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return scored.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"), "unwanted")


def op10_url_filter(spark, sf_dir: str) -> DataFrame:
    return filter_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"))


__all__ = ["filter_urls", "host_of", "path_of", "train", "margins", "default_labels", "op10_url_filter"]
