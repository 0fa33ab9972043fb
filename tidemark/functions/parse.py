"""Column expressions for events, verdicts, names, dates and markup."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

POST, LIKE, REPOST = "app.bsky.feed.post", "app.bsky.feed.like", "app.bsky.feed.repost"
EVENT = "kind string, time_us string, did string, commit struct<collection: string, operation: string, rkey: string, cid: string, record: struct<`$type`: string, text: string, createdAt: string, subject: struct<uri: string>>>"
TEXT_COLUMNS = ("claim", "statement", "text", "title")


def found(pattern: str, c: Column, group: int = 1) -> Column:
    """A regular expression's group, null where nothing matches."""
    hit = F.regexp_extract(c, pattern, group)
    return F.when(hit != "", hit)


def json_scalar(c: Column) -> Column:
    """What a JSON-encoded scalar stands for: `"LABEL_2"` gives LABEL_2."""
    return F.get_json_object(c, "$")


def lenient_date(c: Column) -> Column:
    """A timestamp's date; else the first ten characters; null for shorter texts."""
    return F.coalesce(F.date_format(F.try_to_timestamp(c), "yyyy-MM-dd"), F.when(F.length(c) >= 10, F.substring(c, 1, 10)))


def day_of_batch(batch: Column, prefix: str | None = None) -> Column:
    """The eight digits after a prefix, or the first eight digits in a row; `unknown` if there are none."""
    return F.coalesce(found((re.escape(prefix) if prefix else "") + "([0-9]{8})", batch), F.lit("unknown"))


def batch_stamp(prefix: str, ts: Column) -> Column:
    return F.concat(F.lit(prefix), F.date_format(ts, "yyyyMMdd-HH"))


def sunday_label(day: Column) -> Column:
    """The day on Sundays, else nothing."""
    return F.when(F.dayofweek(F.try_to_timestamp(day, F.lit("yyyyMMdd"))) == 1, day).otherwise("")


def glob_match(c: Column, pattern: str) -> Column:
    """Shell-style match: * any run, ? any character."""
    return c.rlike("^" + "".join(".*" if x == "*" else "." if x == "?" else re.escape(x) for x in pattern) + "$")


def text_column(columns: list[str]) -> str:
    """The first of the usual text columns that is there."""
    for c in TEXT_COLUMNS:
        if c in columns:
            return c
    raise ValueError(f"none of {', '.join(TEXT_COLUMNS)} among {columns}")


def label_number(c: Column) -> Column:
    return F.substring_index(c, "_", -1).try_cast("int")


def verdict_012(c: Column) -> Column:
    """The first whole number 0 to 2 after the last pipe; null without a pipe or a number."""
    return F.when(F.contains(c, F.lit("|")), found(r"\b([0-2])\b", F.element_at(F.split(c, r"\|"), -1)).cast("int"))


def verdict_01(c: Column) -> Column:
    """After the last pipe, else after `rating:`, `validity:` or `verdict:`, else the last 0 or 1 that stands alone."""
    after = F.when(F.contains(c, F.lit("|")), found(r"\b([01])\b", F.element_at(F.split(c, r"\|"), -1)))
    named = found(r"(?i)(?:rating|validity|verdict)\s*:\s*([01])\b", c)
    return F.coalesce(after, named, found(r"(?s).*\b([01])\b", c)).cast("int")


def verdict_coherent(c: Column) -> Column:
    """0 or 1 after the last pipe, else the first anywhere."""
    return F.coalesce(found(r"([01])", F.element_at(F.split(c, r"\|"), -1)), found(r"([01])", c)).cast("int")


def true_false(c: Column) -> Column:
    low = F.lower(F.trim(c))
    return F.when(low == "true", True).when(low == "false", False)


def safe_name(c: Column) -> Column:
    """Runs of anything but letters, digits, dots, dashes and underscores become one underscore; none at the ends."""
    return F.regexp_replace(F.regexp_replace(c, "[^a-zA-Z0-9._-]+", "_"), "^_+|_+$", "")


def strip_tags(c: Column) -> Column:
    return F.regexp_replace(c, "<[^>]+>", "")


def snippet(c: Column, n: int = 80) -> Column:
    return F.substring(F.replace(c, F.lit("\n"), F.lit(" ")), 1, n)


def numbered(texts: Column, first: int = 0, gap: str = "\n\n") -> Column:
    """Texts of an array as `[i] text`, one after another, for a prompt."""
    return F.array_join(F.transform(texts, lambda x, i: F.concat(F.lit("["), (i + first).cast("string"), F.lit("] "), x)), gap)


def fill_prompt(template: str, name: str, c: Column) -> Column:
    return F.replace(F.lit(template), F.lit("{" + name + "}"), c)


def gather(values: Column, at: Column) -> Column:
    """Elements at 0-based places; places out of range, negative ones too, are left out."""
    return F.transform(F.filter(at, lambda i: (i >= 0) & (i < F.size(values))), lambda i: F.get(values, i))


def post_events(raw: DataFrame, include_updates: bool = False, column: str = "value") -> DataFrame:
    """Rows of posts from raw stream events; anything that is not a sound post event is left out."""
    e = raw.select(F.from_json(column, EVENT).alias("e"), F.col(column).alias("raw"))
    c = F.col("e.commit")
    ok = (F.col("e.kind") == "commit") & (c["collection"] == POST) & c["operation"].isin("create", *["update"] * include_updates) & (c["record"]["$type"] == POST) & F.col("e.did").isNotNull() & c["rkey"].isNotNull()
    text = c["record"]["text"]
    return e.where(ok).select(
        F.col("e.did").alias("did"), F.concat(F.lit("at://"), "e.did", F.lit(f"/{POST}/"), c["rkey"]).alias("at_uri"), c["rkey"].alias("rkey"),
        c["cid"].alias("cid"), F.when(text != "", text).alias("text"), c["record"]["createdAt"].alias("created_at"), F.col("e.time_us").try_cast("long").alias("time_us"), "raw",
    )


def reaction_events(raw: DataFrame, column: str = "value", need_actor: bool = True) -> DataFrame:
    """Likes and reposts from raw stream events: creations with a subject; a time that is no number is 0."""
    e = raw.select(F.from_json(column, EVENT).alias("e"))
    c = F.col("e.commit")
    ok = (F.col("e.kind") == "commit") & (c["operation"] == "create") & c["collection"].isin(LIKE, REPOST) & c["record"]["subject"]["uri"].isNotNull()
    if need_actor:
        ok &= F.col("e.did").isNotNull()
    kind = F.when(c["collection"] == LIKE, "like").otherwise("repost")
    time = F.when(F.col("e.time_us").rlike("^[0-9]+$"), F.col("e.time_us").try_cast("long"))
    return e.where(ok).select(c["record"]["subject"]["uri"].alias("subject_uri"), kind.alias("event_type"), F.coalesce("e.did", F.lit("")).alias("actor_did"), F.coalesce(time, F.lit(0)).alias("time_us"), c["record"]["createdAt"].alias("created_at"))


def feed_items(raw: DataFrame, column: str = "value") -> DataFrame:
    """(uri, text, langs, raw) of feed items; missing languages are none."""
    item = F.from_json(column, "post struct<uri: string, record: struct<text: string, langs: array<string>>>")
    rows = raw.select(item.alias("i"), F.col(column).alias("raw"))
    return rows.select("i.post.uri", "i.post.record.text", F.coalesce("i.post.record.langs", F.array().cast("array<string>")).alias("langs"), "raw")


def supported(posts: Column, source_filter: str | None) -> Column:
    """Whether a claim counts: with any filter text, claims of two posts or more, as that is what filters stand for; else all."""
    return F.coalesce(posts, F.lit(0)) >= 2 if source_filter else F.lit(True)


def mapped(c: Column, values: dict[str, int]) -> Column:
    """The number that a value stands for, null for others."""
    return F.element_at(F.create_map(*[F.lit(x) for kv in values.items() for x in kv]), c)


def flat_columns(columns: Column) -> Column:
    """A list of lists as one list."""
    return F.flatten(columns)


def freshness(start: Column, end: Column) -> Column:
    """`STARTtoEND`, empty without both; one without the other is an error."""
    none = lambda c: F.coalesce(c, F.lit("")) == ""
    bad = F.raise_error(F.lit("start and end of freshness go together")).cast("string")
    return F.when(none(start) & none(end), F.lit("")).when(none(start) | none(end), bad).otherwise(F.concat(start, F.lit("to"), end))


def stale_range(today: Column | None = None, first: str = "2020-01-01", days: int = 14) -> tuple[Column, Column]:
    """Start and end of what counts as stale on a day: everything from `first` up to two weeks before it."""
    today = F.current_date() if today is None else today
    return F.lit(first), F.date_format(F.date_sub(today, days), "yyyy-MM-dd")


def plain_name(c: Column) -> Column:
    """Lower case, no brackets, dashes for white space."""
    bare = F.regexp_replace(F.replace(F.lower(c), F.lit("\n"), F.lit(" ")), "[()]", "")
    return F.regexp_replace(F.regexp_replace(bare, r"\s+", "-"), "^-+|-+$", "")


def match_name(c: Column, known: list[str]) -> Column:
    """The known name that a name means: itself, else one with an equal plain form, or with underscores for its dashes, else the first
    whose plain form holds the name's or is held by it. known is a listing of names, as of a folder."""
    names = F.array(*[F.lit(k) for k in sorted(known)])
    own = plain_name(c)
    first = lambda test: F.try_element_at(F.filter(names, test), F.lit(1))
    inside = lambda k: F.contains(own, plain_name(k)) | F.contains(plain_name(k), own)
    return F.coalesce(first(lambda k: k == c), first(lambda k: plain_name(k) == own), first(lambda k: plain_name(k) == F.replace(own, F.lit("-"), F.lit("_"))), first(inside))
