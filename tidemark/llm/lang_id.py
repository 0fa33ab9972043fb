"""Language identification by compression: the language whose dictionary makes a text smallest.

Each language has a raw-content zstandard dictionary of labelled texts. A text is lower-cased and cut into blocks, every block is
compressed with every dictionary, and the least sum wins; the gap to the second is the margin, and narrow margins are rejected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import kept, on_batches, slices

#: Bound of what is learned from: so many whole texts of each language.
SAMPLE_DOCS = 32
BLOCK, LEVEL = 2048, 5
MIN_MARGIN = 0.005
_LETTER = regex.compile(r"\p{L}")


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo folds; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds


def fit_profiles(docs: DataFrame, learn_from: Column | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_docs: int = SAMPLE_DOCS) -> dict[str, bytes]:
    """A dictionary for each value of lang_col, from a bounded sample of the rows where learn_from holds.

    The sample takes, for each language, the whole text of the row of least id hash in each of sample_docs buckets of ids (of rows that
    share an id the least text), so it never depends on the order of rows. Rows with a null id, language or text, or a text without
    letters, teach nothing; without any rows there are no dictionaries. sample_docs texts of each language reach the driver.
    """
    use = F.col(text_col).rlike(r"\p{L}") & F.col(lang_col).isNotNull() & F.col(id_col).isNotNull()
    if learn_from is not None:
        use &= learn_from
    key = F.xxhash64(F.col(id_col).cast("string"))
    rows = docs.where(use).select(F.col(lang_col).alias("lang"), key.alias("key"), F.pmod(key, F.lit(sample_docs)).alias("bucket"), F.col(text_col).alias("text"))
    # Keys first: texts of buckets' other rows are not carried through the aggregation.
    least = {(r.lang, r.key) for r in rows.groupBy("lang", "bucket").agg(F.min("key").alias("key")).select("lang", "key").collect()}
    if not least:
        return {}
    chosen = rows.where(F.col("key").isin(sorted({k for _, k in least}))).groupBy("lang", "key").agg(F.min("text").alias("text")).collect()
    parts: dict[str, list[bytes]] = {}
    for r in sorted(chosen, key=lambda r: (r.lang, r.key)):
        if (r.lang, r.key) in least:
            parts.setdefault(r.lang, []).append(r.text.lower().encode())
    return {lang: b"\n".join(p) for lang, p in parts.items()}


def _compressors(profiles: dict[str, bytes]) -> list:
    key = hash(tuple(sorted(profiles.items())))
    built = kept("languages")
    if built.get("key") != key:
        made = []
        for lang in sorted(profiles):
            words = zstandard.ZstdCompressionDict(profiles[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            words.precompute_compress(level=LEVEL)
            made.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=words, write_content_size=False, write_checksum=False, write_dict_id=False).compress)
        built.update(key=key, made=made)
    return built["made"]


def classify_text(text: str | None, langs: list[str], made: list, min_margin: float) -> tuple[str, float, bool]:
    """(language, margin, rejected); `und` where text is null or has no letter, or nothing was learned."""
    if not text or not langs or not _LETTER.search(text):
        return "und", 0.0, True
    data = text.lower().encode()
    blocks = [data[i : i + BLOCK] for i in range(0, len(data), BLOCK)]
    sizes = [sum([len(f(b)) for b in blocks]) for f in made]
    best = min(range(len(sizes)), key=sizes.__getitem__)
    second = min([s for i, s in enumerate(sizes) if i != best], default=None)
    margin = 1.0 if second is None else (second - sizes[best]) / second
    return langs[best], margin, margin < min_margin


def _classify(profiles: dict[str, bytes], at: int, keep: list[int], names: list[str], min_margin: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    langs, made = sorted(profiles), _compressors(profiles)
    for batch in slices(batches, at):
        found = [classify_text(t, langs, made, min_margin) for t in batch.column(at).to_pylist()]
        lang, score, rejected = zip(*found, strict=True) if found else ((), (), ())
        new = [pa.array(lang, pa.string()), pa.array(np.array(score, np.float64)), pa.array(rejected, pa.bool_())]
        yield pa.RecordBatch.from_arrays([batch.column(i) for i in keep] + new, names)


def classify(docs: DataFrame, profiles: dict[str, bytes], text_col: str = "text", min_margin: float = MIN_MARGIN) -> DataFrame:
    """docs with lang_pred, score (the margin, 0 to 1) and rejected; columns of these names in docs are replaced.

    Only the text decides. Texts that are null or without letters are `und` with score 0 and rejected; ties go to the first language
    by code point and are rejected; with one language its margin is 1; repeated rows stay; whole texts of any length are read.
    """
    added = ["lang_pred", "score", "rejected"]
    keep = [i for i, c in enumerate(docs.columns) if c not in added]
    names = [docs.columns[i] for i in keep] + added
    schema = docs.select(*[f"`{docs.columns[i]}`" for i in keep]).schema.add("lang_pred", "string").add("score", "double").add("rejected", "boolean")
    return docs.mapInArrow(on_batches("languages", _classify, profiles, docs.columns.index(text_col), keep, names, min_margin), schema)
