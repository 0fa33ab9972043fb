"""Benchmark passages in documents: a prefix-filtered set join over word shingles.

A window of an item is a set of shingles (three words, fewer for shorter items), all of which a document must hold to contain it. For
an overlap that must be whole, the prefix filter needs one shingle of a window: its rarest, counted over all documents. Documents that
hold that shingle are candidates at the place where the window would have to begin; places that would begin before the document or end
after it are left out, and the rest is verified shingle by shingle, each at its own place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialize

UPPER, LOWER_CASE = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SHINGLE = 3
#: Up to so many bytes, twelve for each shingle added, the item side of a join is broadcast; beyond, both sides are shuffled.
BROADCAST_BYTES = 8 << 20


def plain_words(text: Column) -> Column:
    """Runs of ASCII letters, digits and characters beyond ASCII, with A-Z lower-cased; null has none."""
    low = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER_CASE))
    return F.array_remove(F.split(F.coalesce(low, F.lit("")), SEPARATORS), "")


def _shingles(words: str, width: int) -> Column:
    """(pos, shingle) for each run of `width` words; words have no blanks, so the blanks between them tell equal shingles."""
    at = F.when(F.size(words) >= width, F.sequence(F.lit(0), F.size(words) - width)).otherwise(F.array().cast("array<int>"))
    text = lambda i: F.concat_ws(" ", *[F.get(F.col(words), i + j) for j in range(width)])
    return F.transform(at, lambda i: F.struct(i.alias("pos"), text(i).alias("shingle")))


def item_windows(items: DataFrame, size: int, shingle: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, window, length, pos, shingle): each window's shingles, by place. Equal windows of several items are one."""
    rows = items.select(F.col(f"`{id_col}`").alias("item_id"), plain_words(F.col(f"`{text_col}`").cast("string")).alias("words")).where(F.size("words") > 0)
    start = F.explode(F.sequence(F.lit(1), F.greatest(F.size("words") - size + 1, F.lit(1)))).alias("start")
    windows = rows.select("item_id", "words", start).select("item_id", F.slice("words", F.col("start"), size).alias("words"))
    parts = F.lit(None).cast("array<struct<pos:int,shingle:string>>")
    for width in range(1, shingle + 1):  # a window below the width of a shingle is one shingle
        parts = F.when(F.least(F.size("words"), F.lit(shingle)) == width, _shingles("words", width)).otherwise(parts)
    return windows.select("item_id", F.concat_ws(" ", "words").alias("window"), F.size("words").alias("length"), F.inline(parts))


def _small(df: DataFrame, n_bytes: int | None) -> DataFrame:
    return F.broadcast(df) if (n_bytes or 0) <= BROADCAST_BYTES else df


def contamination(docs: DataFrame, items: DataFrame, size: int = 10, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, doc_id, n_words, spans, items) of every row: maximal runs of words inside windows, as (first, length), and the items' ids.

    Null and empty texts, and texts without words, have no spans; items without words have no windows, an item below `size` words is
    one. Rows that share a document id stay apart, null ids too; an item id that comes twice is one item with the windows of both; a
    null item id marks words, but is no item in the list. Whole texts of any length are read; an empty table gives no rows, and no items give no spans. Other columns are not read.

    Documents are read once: the shingles that any window has are written with their places, and all that follows works on that table.
    What is looked up there is asked by row and place, so a passage that a third of all documents hold is no hot key.
    """
    spark = docs.sparkSession
    windows, _ = materialize(item_windows(items, size, shingle), "windows")
    n_bytes, widths = windows.agg(F.sum(F.octet_length("shingle") + 12), F.collect_set(F.least("length", F.lit(shingle)))).first()
    known = windows.select("shingle").distinct()
    # Every row has one entry with an empty shingle besides, which tells its words, so that rows without matches are written too.
    known = _small(known.unionByName(spark.createDataFrame([("",)], "shingle string")), n_bytes)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").cast("long").alias("doc_id"), plain_words(F.col(f"`{text_col}`").cast("string")).alias("words"))
    own = F.array(F.struct(F.lit(0).alias("pos"), F.lit("").alias("shingle")))
    every = rows.select("row", "doc_id", F.size("words").alias("n_words"), F.inline(F.concat(own, *[_shingles("words", w) for w in sorted(widths)])))
    held, _ = materialize(every.join(known, "shingle").select("row", "doc_id", "n_words", "pos", "shingle"), "held")
    matches = held.where("shingle <> ''")

    counts = matches.groupBy("shingle").agg(F.count("*").alias("n"))
    places = windows.select("window", "length", "pos", "shingle").distinct()
    # A shingle that no document has leaves its window out: it is the rarest, and joins nothing.
    rarest = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "pos", "shingle")).alias("r")
    chosen = places.join(counts, "shingle", "left").groupBy("window", "length").agg(rarest, F.count("*").alias("n_shingles"))
    prefixes = _small(chosen.where("r.n > 0").select("window", "length", "n_shingles", "r.shingle", F.col("r.pos").alias("offset")), n_bytes)
    start = F.col("pos") - F.col("offset")
    bounded = matches.join(prefixes, "shingle").where((start >= 0) & (start + F.col("length") <= F.col("n_words")))
    candidates = bounded.select("row", "window", "length", "n_shingles", start.alias("start"))
    needed = candidates.join(_small(places.select("window", F.col("pos").alias("at"), "shingle"), n_bytes), "window")
    needed = needed.select("row", "window", "length", "n_shingles", "start", (F.col("start") + F.col("at")).alias("pos"), "shingle")
    exact = needed.join(matches.select("row", "pos", "shingle"), ["row", "pos", "shingle"]).groupBy("row", "start", "window", "length", "n_shingles").agg(F.count("*").alias("n"))
    found, _ = materialize(exact.where("n = n_shingles").select("row", "start", "window", "length"), "occurrences")

    end = F.col("start") + F.col("length")
    by_row = Window.partitionBy("row").orderBy("start")
    runs = found.groupBy("row", "start").agg(F.max("length").alias("length"))
    before = F.max(end).over(by_row.rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.withColumn("new", F.coalesce(F.col("start") > before, F.lit(True)).cast("int")).withColumn("run", F.sum("new").over(by_row))
    spans = runs.groupBy("row", "run").agg(F.min("start").alias("first"), F.max(end).alias("end")).groupBy("row").agg(F.array_sort(F.collect_list(F.struct("first", (F.col("end") - F.col("first")).alias("length")))).alias("spans"))
    owners = _small(windows.select("window", F.col("item_id").cast("string").alias("item")).distinct(), n_bytes)
    hit = found.select("row", "window").distinct().join(owners, "window").groupBy("row").agg(F.array_sort(F.collect_set("item")).alias("items"))
    everyone = held.where("shingle = ''").select("row", "doc_id", "n_words")
    out = everyone.join(spans, "row", "left").join(hit, "row", "left")
    return out.select("row", "doc_id", "n_words", F.coalesce("spans", F.array().cast("array<struct<first:int,length:int>>")).alias("spans"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def contamination_digest(found: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of what contamination gives."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["length"])
    return found.select("doc_id", F.col("n_words").cast("long").alias("n_words"), n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


CONTAMINATION_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(translate(text, '{UPPER}', '{LOWER_CASE}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate(text, '{UPPER}', '{LOWER_CASE}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, w[s : s + 9] AS words, least(len(w), 10) AS n
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS s FROM i WHERE len(w) > 0)),
spots AS (SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS s FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n),
hits AS (SELECT r, s, p.n, item_id FROM (SELECT r, s, n, w[s : s + n - 1] AS words FROM spots) p JOIN windows USING (words)),
covered AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(generate_series(s, s + n - 1)) AS k FROM hits) GROUP BY 1),
listed AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items FROM hits GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN listed USING (r)
"""
