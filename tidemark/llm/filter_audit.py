"""Audit of filters that interact: every order of the filters is replayed over every document.

What a filter removes depends on those before it. Documents are reduced to one row of flags; the rows meet all orders of the filters,
each order's steps are exploded, and the first filter that a document fails decides at which step it goes. Counts are summed where the
rows are, so what is shuffled has one row for each part, order, step and task.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialize

GAP, MARKS = r"[\x20\x09-\x0D]+", r"[#$%&*|]"
LETTERS = "ABCDE"
COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]


def text_failures(text: Column) -> dict[str, Column]:
    """The failure conditions that a text decides alone: A few words, B repetitive, C many capitals, D odd marks."""
    words = F.array_remove(F.split(text, GAP), "")
    return {
        "A": F.size(words) < 50,
        "B": 100 * F.size(F.array_distinct(words)) < 65 * F.size(words),
        "C": 100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")) > 5 * F.length(text),
        "D": text.rlike(MARKS),
    }


def _bits(failures: dict[str, Column]) -> Column:
    """The conditions as one number, a bit for each letter from the lowest."""
    return sum((F.when(failures[c], 1 << LETTERS.index(c)).otherwise(0) for c in sorted(failures)), F.lit(0)).cast("int")


def document_flags(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """(part, fails, good, toxic) of every row: the filters it fails as bits, and what its labels say.

    Texts are read once, for their conditions and a digest. A row passes E if it has the least id of its digest, which is asked by id and
    digest together, so a text that a third of all rows have is no hot key. Of several labels of an id any that says so counts.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    chosen = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"), text.alias("text"))
    rows, _ = materialize(chosen.select("id", "part", _bits(text_failures(F.col("text"))).alias("fails"), F.unhex(F.sha2("text", 256)).alias("digest")), "flags")
    first = rows.where("id is not null").groupBy("digest").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
    said = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    copy = F.col("id").isNotNull() & F.col("first").isNull()
    found = rows.join(first, ["id", "digest"], "left").join(said, "id", "left")
    no = F.lit(False)
    return found.select("part", F.col("fails").bitwiseOR(F.when(copy, 1 << LETTERS.index("E")).otherwise(0)).alias("fails"), F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic"))


def audit(flags: DataFrame, letters: str = LETTERS) -> DataFrame:
    """One row for each part, order of the filters and step, with what the step keeps, removes and would have removed.

    The orders, 120 of five filters, are broadcast: their number depends on the filters alone. Every row of flags meets every order,
    so parts have rows for all of them, zeros included, and no flags give no rows.
    """
    spark, n = flags.sparkSession, len(letters)
    orders = [("".join(p), [1 << letters.index(c) for c in p]) for p in permutations(letters)]
    table = spark.createDataFrame(orders, "filter_order string, masks array<int>").select("filter_order", *[F.col("masks")[i].alias(f"m{i + 1}") for i in range(n)])
    failed = lambda mask: F.col("fails").bitwiseAND(F.col(mask)) != 0
    first = F.lit(n + 1)
    for i in range(n, 0, -1):
        first = F.when(failed(f"m{i}"), i).otherwise(first)
    met = flags.crossJoin(F.broadcast(table)).withColumn("first", first)
    steps = met.select("part", "filter_order", "fails", "good", "toxic", "first", F.posexplode(F.array(*[f"m{i + 1}" for i in range(n)])).alias("at", "mask")).withColumn("step", F.col("at") + 1)
    here = F.col("first") == F.col("step")
    sums = {
        "kept": F.col("first") > F.col("step"),
        "removed": here,
        "redundant": failed("mask") & (F.col("first") < F.col("step")),
        "unique_fails": F.col("fails") == F.col("mask"),
        "good_lost": here & F.col("good"),
        "toxic_lost": here & F.col("toxic"),
    }
    counted, _ = materialize(steps.groupBy("part", "filter_order", "step").agg(*[F.count_if(c).alias(name) for name, c in sums.items()]), "audit")
    letter = F.substring(F.col("filter_order"), F.col("step"), F.lit(1))
    each = counted.groupBy("part", letter.alias("letter")).agg(F.sum("removed").alias("shapley"))
    return counted.withColumn("letter", letter).join(each, ["part", "letter"]).select("part", "filter_order", "step", *sums, "shapley")


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of five filters over whole texts, with the labels of what each step loses.

    Null texts are empty: they have too few words and are copies of one another. A null source is the empty part, as an empty source
    is. A null id has no smaller one and is smaller than none, so it is no copy and makes none; repeated rows of an id count
    each, and are no copies of themselves. Null labels say neither good nor toxic, and an empty labels table loses nothing. Only
    id, text and source are read of docs, so other columns can't be in the way; an empty table gives no rows.
    """
    return audit(document_flags(docs, labels))


_OF = {"A": "n < 50", "B": "100 * d < 65 * n", "C": "100 * caps > 5 * length(text)", "D": r"regexp_matches(text, '[#$%&*|]')", "E": "m.doc_id > first"}
FILTER_AUDIT_SQL = rf"""
WITH RECURSIVE texts AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
measured AS (
  SELECT *, len(words) AS n, len(list_distinct(words)) AS d, length(regexp_replace(text, '[^A-Z]+', '', 'g')) AS caps, min(doc_id) OVER (PARTITION BY text) AS first
  FROM (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM texts)),
said AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY 1),
flags AS (
  SELECT part, list_filter([{", ".join(f"CASE WHEN {c} THEN '{k}' END" for k, c in _OF.items())}], lambda x: x IS NOT NULL) AS fails, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
  FROM measured m LEFT JOIN said s ON m.doc_id = s.doc_id),
orders(o) AS (
  SELECT '' UNION ALL
  SELECT o || l FROM orders, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l) WHERE position(l IN o) = 0),
replayed AS (
  SELECT part, o, step, substr(o, step, 1) AS f, fails, good, toxic, coalesce(list_min(list_transform(fails, lambda x: position(x IN o))), 6) AS first
  FROM flags, (SELECT o FROM orders WHERE length(o) = 5), (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
counted AS (
  SELECT part, o AS filter_order, step, f, count(*) FILTER (first > step) AS kept, count(*) FILTER (first = step) AS removed,
         count(*) FILTER (first < step AND list_contains(fails, f)) AS redundant, count(*) FILTER (fails = [f]) AS unique_fails,
         count(*) FILTER (first = step AND good) AS good_lost, count(*) FILTER (first = step AND toxic) AS toxic_lost
  FROM replayed GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INT) AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM counted
"""
