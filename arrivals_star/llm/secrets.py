"""Secret scan: base patterns, and high-entropy strings by a sliding window. DataFrame functions only.

Places count code points. ``split`` gives the text between matches and ``regexp_extract_all`` the
matches, so places are sums of lengths and every text is read a fixed number of times: a value that
a loop over matches or characters needs is bound once outside of it (``bound``).

For each character class, candidate strings of ``window`` or more characters are scanned with a
window of that length. The count of each character in the window is kept in an array; a step takes
off the character that leaves and adds the one that enters, and updates sum(c * log2 c) in fixed
point. The window's Shannon entropy is log2(window) - sum / window bits. Windows over the class's
threshold that overlap or touch are one span. The allow-list is searched in the span, so what else
its candidate holds does not hide a secret; only strings that are no secret as a whole (a UUID)
are judged as candidates.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

#: Fixed values of the scan's contract: kind, pattern, and the least length of what must be long.
ASSIGN = (r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
          r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 12, "access": 18, "hex": 16}

SCALE = 1 << 20
BLOCK = 256
PLACED = "array<struct<start:int,end:int,s:string>>"
SPANS = "array<struct<start:int,kind_no:int,end:int,kind:string>>"


@dataclass(frozen=True)
class CharClass:
    """A character class whose runs are scanned for windows of at least ``bits`` of entropy."""
    kind: str
    alphabet: str
    window: int
    bits: float

    @property
    def pattern(self) -> str:
        listed = "".join("\\" + c if c in "-/+_=" else c for c in self.alphabet)
        return f"[{listed}]{{{self.window},}}"

    @property
    def most(self) -> int:
        """Largest fixed-point sum(c * log2 c) of a window with enough entropy."""
        return math.floor((math.log2(self.window) - self.bits) * self.window * SCALE)

    @property
    def terms(self) -> list[int]:
        """c * log2 c in fixed point, for c = 0 .. window."""
        return [0] + [round(c * math.log2(c) * SCALE) for c in range(1, self.window + 1)]


LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
CLASSES = (CharClass("entropy_hex", "0123456789ABCDEFabcdef", 20, 3.0),
           CharClass("entropy_base64", LETTERS + "0123456789+/=_-", 20, 3.7))
#: Spans that are no secrets: only letters or separators (words), only digits, or text that says so.
ALLOW = (r"^[A-Za-z_/=+-]+$", r"^[0-9_/=+-]+$",
         r"(EXAMPLE|[Ee]xample|[Pp]laceholder|0123456789|abcdefghij)")
#: Candidates that are no secrets as a whole: a UUID.
ALLOW_WHOLE = (r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",)


def bound(x: Column, use) -> Column:
    """use(x) with x computed once, however often and in whatever loop ``use`` reads it."""
    return F.transform(F.array(x), use)[0]


def placed(text: Column, pattern: str) -> Column:
    """(start, end, s) of the leftmost non-overlapping matches of a pattern, in code points."""
    def in_block(x: Column, at: Column) -> Column:
        return F.aggregate(
            x, F.struct(at.alias("at"), F.array().cast(PLACED).alias("out")),
            lambda st, e: F.struct((st["at"] + e["g"] + e["n"]).alias("at"), F.concat(st["out"], F.array(F.struct(
                (st["at"] + e["g"]).alias("start"), (st["at"] + e["g"] + e["n"]).alias("end"),
                e["s"].alias("s")))).alias("out")),
            lambda st: st["out"])

    def in_blocks(lengths: Column) -> Column:
        # running places in blocks, so that appending to an array stays cheap however many matches there are
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / BLOCK).cast("int")),
                           lambda b: F.slice(lengths, b * BLOCK + 1, F.lit(BLOCK)))

    def from_blocks(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda x: F.aggregate(x, F.lit(0), lambda acc, e: acc + e["g"] + e["n"]))
        offsets = F.aggregate(totals, F.array(F.lit(0)), lambda acc, t: F.concat(acc, F.array(F.element_at(acc, -1) + t)))
        return F.flatten(F.zip_with(blocks, F.slice(offsets, F.lit(1), F.size(blocks)), in_block))

    def lengths_of(m: Column) -> Column:
        return F.zip_with(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(m)), m,
                          lambda g, x: F.struct(F.char_length(g).alias("g"), F.char_length(x).alias("n"), x.alias("s")))

    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    found = bound(matches, lambda m: bound(lengths_of(m), lambda n: bound(in_blocks(n), from_blocks)))
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(PLACED))


def as_spans(found: Column, kind: str, kind_no: int) -> Column:
    return F.transform(found, lambda x: F.struct(x["start"].alias("start"), F.lit(kind_no).alias("kind_no"),
                                                 x["end"].alias("end"), F.lit(kind).alias("kind")))


def entropy_spans(found: Column, cls: CharClass, kind_no: int, allow: tuple[str, ...],
                  allow_whole: tuple[str, ...]) -> Column:
    """Spans of one class within its placed candidates."""
    width, n = cls.window, len(cls.alphabet)
    terms = F.array(*[F.lit(t).cast("long") for t in cls.terms])
    term = lambda c: F.get(terms, c)
    zero_counts = F.array_repeat(F.lit(0), n)
    span = lambda a, b: F.array(F.struct(a.alias("start"), b.alias("end")))
    empty = F.array().cast("array<struct<start:int,end:int>>")

    def bumped(counts: Column, k: Column, by: int) -> Column:
        return F.concat(F.slice(counts, F.lit(1), k - 1), F.array(F.element_at(counts, k) + by),
                        F.slice(counts, k + 1, F.lit(n)))

    def windows(marks: Column) -> Column:
        """Merged windows with enough entropy of one candidate, from its characters' numbers."""
        def leave(st: Column, i: Column) -> Column:
            """Character i - width leaves the window."""
            gone = F.get(marks, i - width - 1)
            had = F.element_at(st["counts"], gone)
            return F.struct(F.when(i > width, bumped(st["counts"], gone, -1)).otherwise(st["counts"]).alias("counts"),
                            F.when(i > width, st["total"] - term(had) + term(had - 1)).otherwise(st["total"]).alias("total"))

        def enter(left: Column, st: Column, i: Column) -> Column:
            """Character i enters it; a window with enough entropy widens the open span, or starts one."""
            k = F.element_at(marks, i)
            had = F.element_at(left["counts"], k)
            return bound((left["total"] + term(had + 1) - term(had)), lambda total: close(bumped(left["counts"], k, 1), total, st, i))

        def close(counts: Column, total: Column, st: Column, i: Column) -> Column:
            hit = (i >= width) & (total <= cls.most)
            apart = hit & (st["b"] >= 0) & (i - width > st["b"])
            return F.struct(
                counts.alias("counts"), total.alias("total"),
                F.when(apart, F.concat(st["done"], span(st["a"], st["b"]))).otherwise(st["done"]).alias("done"),
                F.when(hit & ((st["b"] < 0) | apart), i - width).otherwise(st["a"]).alias("a"),
                F.when(hit, i).otherwise(st["b"]).alias("b"))

        start = F.struct(zero_counts.alias("counts"), F.lit(0).cast("long").alias("total"), empty.alias("done"),
                         F.lit(-1).alias("a"), F.lit(-1).alias("b"))
        return F.aggregate(
            F.sequence(F.lit(1), F.size(marks)), start,
            lambda st, i: bound(leave(st, i), lambda left: enter(left, st, i)),
            lambda st: F.when(st["b"] < 0, st["done"]).otherwise(F.concat(st["done"], span(st["a"], st["b"]))))

    def scan(x: Column) -> Column:
        marks = F.transform(F.regexp_extract_all(x["s"], F.lit("."), F.lit(0)), lambda c: F.instr(F.lit(cls.alphabet), c))
        secret = F.filter(bound(marks, windows), lambda s: ~_any_match(x["s"].substr(s["start"] + 1, s["end"] - s["start"]), allow))
        return F.transform(secret, lambda s: F.struct(
            (x["start"] + s["start"]).alias("start"), F.lit(kind_no).alias("kind_no"),
            (x["start"] + s["end"]).alias("end"), F.lit(cls.kind).alias("kind")))

    suspect = F.filter(found, lambda x: ~_any_match(x["s"], allow_whole))
    return F.flatten(F.transform(suspect, scan))


def _any_match(s: Column, patterns: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for p in patterns:
        out = out | s.rlike(p)
    return out


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(
        ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def secret_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 classes: tuple[CharClass, ...] = CLASSES, allow: tuple[str, ...] = ALLOW,
                 allow_whole: tuple[str, ...] = ALLOW_WHOLE) -> DataFrame:
    """doc_id, text, base_spans, added_spans: arrays of (start, kind_no, end, kind), unsorted.

    Base kinds are assign, access and hex, leftmost and non-overlapping per kind; each character
    class adds its high-entropy spans. Null text is empty and has none. Null ids stay null; repeated
    rows each give a row; other columns are ignored; an empty table gives an empty result.
    """
    rows = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return _found(rows, ["doc_id"], classes).select(
        "doc_id", "text", _base().alias("base_spans"),
        F.concat(F.array().cast(SPANS), *_added(classes, allow, allow_whole)).alias("added_spans"))


def _found(rows: DataFrame, keys: list[str], classes: tuple[CharClass, ...]) -> DataFrame:
    """The placed matches of every pattern, one column per kind."""
    t = F.col("text")
    return rows.select(*keys, "text", placed(t, ASSIGN).alias("assign"),
                       placed(t, f"AKIA[A-Z0-9]{{{LEAST['access'] - 4},}}").alias("access"),
                       placed(t, f"[0-9a-f]{{{LEAST['hex']},}}").alias("hex"),
                       *[placed(t, c.pattern).alias(f"class_{k}") for k, c in enumerate(classes)])


def _base() -> Column:
    # an assignment whose value is too short still uses up its text, so it is dropped only here
    assign = F.filter("assign", lambda x: F.char_length(F.regexp_extract(x["s"], ASSIGN, 2)) >= LEAST["assign"])
    return F.concat(as_spans(assign, "assign", 0), as_spans(F.col("access"), "access", 1), as_spans(F.col("hex"), "hex", 2))


def _added(classes: tuple[CharClass, ...], allow: tuple[str, ...], allow_whole: tuple[str, ...]) -> list[Column]:
    return [entropy_spans(F.col(f"class_{k}"), c, 3 + k, allow, allow_whole) for k, c in enumerate(classes)]


def secret_scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                classes: tuple[CharClass, ...] = CLASSES, allow: tuple[str, ...] = ALLOW,
                allow_whole: tuple[str, ...] = ALLOW_WHOLE) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of every document (see ``secret_spans``)."""
    count = lambda k: F.size(F.filter("base_spans", lambda x: x["kind_no"] == k)).cast("long")
    return secret_spans(df, id_col, text_col, classes, allow, allow_whole).select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(_joined(F.col("base_spans")), 256).alias("base_sha256"),
        _joined(F.concat("base_spans", "added_spans")).alias("spans"))


def redact_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size_col: str = "n_chars",
                   mark: str = "[SECRET]", classes: tuple[CharClass, ...] = CLASSES,
                   allow: tuple[str, ...] = ALLOW, allow_whole: tuple[str, ...] = ALLOW_WHOLE) -> DataFrame:
    """The rows with every span replaced by ``mark`` (overlapping spans by one), and new sizes.

    Rows without spans stay as they are, null text included. ``size_col`` is set where it exists.
    """
    rows = df.select(F.struct(*[F.col(c) for c in df.columns]).alias("row"), F.col(id_col).alias("id"),
                     F.col(text_col).alias("text"))
    t = F.coalesce(F.col("text").cast("string"), F.lit(""))
    found = _found(rows.select("row", t.alias("text")), ["row"], classes)
    spans = found.select("row", "text", F.array_sort(F.concat(_base(), *_added(classes, allow, allow_whole))).alias("spans"))
    one = "array<struct<start:int,end:int>>"

    def join_span(acc: Column, x: Column) -> Column:
        """Sorted spans into disjoint ones, the last one first."""
        meets = (F.size(acc) > 0) & (x["start"] <= F.get(acc, F.lit(0))["end"])
        whole = F.struct(F.get(acc, F.lit(0))["start"].alias("start"), F.greatest(F.get(acc, F.lit(0))["end"], x["end"]).alias("end"))
        return F.when(meets, F.concat(F.array(whole), F.slice(acc, F.lit(2), F.greatest(F.size(acc) - 1, F.lit(0))))).otherwise(
            F.concat(F.array(F.struct(x["start"].alias("start"), x["end"].alias("end"))), acc))

    cuts = F.aggregate("spans", F.array().cast(one), join_span, lambda acc: F.reverse(acc))
    gaps = F.transform(F.col("cuts"), lambda x, i: F.struct(
        F.when(i == 0, 0).otherwise(F.get(F.col("cuts"), i - 1)["end"]).alias("start"), x["start"].alias("end")))
    head = F.array_join(F.transform(gaps, lambda g: F.concat(
        F.substr("text", g["start"] + 1, g["end"] - g["start"]), F.lit(mark))), "")
    tail = F.substr("text", F.element_at("cuts", -1)["end"] + 1, F.char_length("text"))
    marked = spans.select("row", "text", cuts.alias("cuts")).select(
        "row", F.when(F.size("cuts") > 0, F.concat(head, tail)).alias("clean"))
    new = {text_col: F.coalesce(F.col("clean"), F.col("row")[text_col])}
    if size_col in df.columns:
        kind = df.schema[size_col].dataType
        new[size_col] = F.when(F.col("clean").isNotNull(), F.char_length("clean")).cast(kind)
        new[size_col] = F.coalesce(new[size_col], F.col("row")[size_col])
    return marked.select(*[new.get(c, F.col("row")[c]).alias(c) for c in df.columns])


def op8_secret_scan(spark, sf_dir: str) -> DataFrame:
    return secret_scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _sql_places(name: str, pattern: str) -> str:
    """Rows (doc_id, start, end, s) of a pattern's matches, as DuckDB SQL."""
    p = pattern.replace("'", "''")
    return f"""{name} AS (
  SELECT doc_id, sum(length(g) + length(s)) OVER w - length(s) AS a, sum(length(g) + length(s)) OVER w AS b, s FROM (
    SELECT doc_id, unnest(regexp_extract_all(text, '{p}')) AS s,
           unnest(regexp_split_to_array(text, '{p}')[:-2]) AS g,
           unnest(range(len(regexp_extract_all(text, '{p}')))) AS i
    FROM t WHERE regexp_matches(text, '{p}'))
  WINDOW w AS (PARTITION BY doc_id ORDER BY i))"""


def oracle_sql() -> str:
    """DuckDB twin: windows are rows, and each window's characters are counted anew."""
    assign = ASSIGN.replace("'", "''")
    ctes, unions = [], []
    for k, c in enumerate(CLASSES):
        whole = " OR ".join(f"regexp_matches(s, '{p}')" for p in ALLOW_WHOLE)
        says = " OR ".join(f"regexp_matches(substring(text, CAST(a + 1 AS BIGINT), CAST(b - a AS BIGINT)), '{p}')" for p in ALLOW)
        terms = "[" + ", ".join(map(str, c.terms)) + "]"
        ctes.append(_sql_places(f"c{k}", c.pattern) + f""",
w{k} AS (SELECT doc_id, a, s, unnest(range(length(s) - {c.window} + 1)) AS i FROM c{k} WHERE NOT ({whole})),
h{k} AS (
  SELECT doc_id, a + i AS i FROM (
    SELECT doc_id, a, i, ch, count(*) AS n FROM (
      SELECT doc_id, a, i, unnest(regexp_extract_all(s[i + 1:i + {c.window}], '.')) AS ch FROM w{k})
    GROUP BY ALL)
  GROUP BY doc_id, a, i HAVING sum(({terms})[n + 1]) <= {c.most}),
j{k} AS (SELECT doc_id, i, sum(n) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM (
  SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= {c.window} THEN 0 ELSE 1 END AS n FROM h{k}))""")
        unions.append(f"""SELECT doc_id, a, {3 + k} AS k, b, '{c.kind}' AS kind FROM (
  SELECT doc_id, min(i) AS a, max(i) + {c.window} AS b FROM j{k} GROUP BY doc_id, g) JOIN t USING (doc_id) WHERE NOT ({says})""")
    places = ",\n".join([_sql_places("x0", ASSIGN), _sql_places("x1", f"AKIA[A-Z0-9]{{{LEAST['access'] - 4},}}"),
                         _sql_places("x2", f"[0-9a-f]{{{LEAST['hex']},}}"), *ctes])
    return f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
{places},
base AS (
  SELECT doc_id, a, 0 AS k, b, 'assign' AS kind FROM x0 WHERE length(regexp_extract(s, '{assign}', 2)) >= {LEAST['assign']}
  UNION ALL SELECT doc_id, a, 1, b, 'access' FROM x1 UNION ALL SELECT doc_id, a, 2, b, 'hex' FROM x2),
every AS (SELECT * FROM base UNION ALL {" UNION ALL ".join(unions)}),
b AS (SELECT doc_id, count(*) FILTER (k = 0) AS n0, count(*) FILTER (k = 1) AS n1, count(*) FILTER (k = 2) AS n2,
             string_agg(concat(kind, ':', a, ':', b), ',' ORDER BY a, k) AS s FROM base GROUP BY doc_id),
e AS (SELECT doc_id, string_agg(concat(kind, ':', a, ':', b), ',' ORDER BY a, k) AS s FROM every GROUP BY doc_id)
SELECT t.doc_id, coalesce(n0, 0)::BIGINT AS n_assign, coalesce(n1, 0)::BIGINT AS n_access, coalesce(n2, 0)::BIGINT AS n_hex,
       sha256(coalesce(b.s, '')) AS base_sha256, coalesce(e.s, '') AS spans
FROM t LEFT JOIN b USING (doc_id) LEFT JOIN e USING (doc_id)
"""


__all__ = ["redact_secrets", "CharClass", "CLASSES", "ALLOW", "ALLOW_WHOLE", "secret_spans", "secret_scan", "op8_secret_scan", "oracle_sql"]
