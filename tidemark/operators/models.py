"""Model calls as Arrow-batched columns, with deterministic stand-ins for work without a model server.

A model is any picklable callable from a list of inputs to a list of outputs. Retries and the server's address belong to it; batches
go to it in sizes of spark.sql.execution.arrow.maxRecordsPerBatch, or of `batch` if given.
"""

from __future__ import annotations

import hashlib
import json
import re
import threading
from collections import deque
from collections.abc import Callable, Iterator
from concurrent.futures import Future, ThreadPoolExecutor
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.parse import verdict_012
from tidemark.sources import batches
from tidemark.storage import cut, remove


def _annotate(model: Callable, column: str, batch_rows: int, failed, kind: pa.DataType, name: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, len(batch), batch_rows):  # of a batch, one request's values and answers are held as Python's objects
            part = batch.slice(i, batch_rows)
            values = part.column(column).to_pylist()
            asked = [v for v in values if v is not None and (not isinstance(v, str) or v.strip())]
            answers = iter(model(asked) if asked else [])
            out = [next(answers) if v is not None and (not isinstance(v, str) or v.strip()) else failed for v in values]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, kind)], [*part.schema.names, name])


def annotate(df: DataFrame, column: str, model: Callable[[list], list], name: str, kind: T.DataType, batch: int = 256, failed=None) -> DataFrame:
    """df with the model's answer for a column; empty inputs are not sent and give `failed`."""
    from pyspark.sql.pandas.types import to_arrow_type

    return df.mapInArrow(partial(_annotate, model, column, batch, failed, to_arrow_type(kind), name), T.StructType([*df.schema.fields, T.StructField(name, kind)]))


def _retried(model: Callable, tries: int, values: list) -> list:
    error: Exception | None = None
    for _ in range(tries):
        try:
            return model(values)
        except Exception as e:  # noqa: BLE001  # whatever a model raises may pass
            error = e
    out = []
    for v in values:  # one input may spoil a batch: ask for each alone
        try:
            out += model([v])
        except Exception:  # noqa: BLE001
            out.append(None)
    if all(x is None for x in out) and values:
        raise RuntimeError(f"no answer in {tries} tries") from error
    return out


def retrying(model: Callable[[list], list], tries: int = 6) -> Callable[[list], list]:
    """A model that is asked again when it fails; then inputs are asked for one by one, and those that still fail have no answer."""
    return partial(_retried, model, tries)


class Batcher:
    """Requests gathered from single inputs: one goes out when it has `size` inputs, or `wait` seconds after the last one came, with at most
    `workers` on their way. A request that fails, or has not one answer for each input, fails for its own inputs alone."""

    def __init__(self, model: Callable[[list], list], size: int, wait: float, workers: int) -> None:
        self.model, self.size, self.wait = model, size, wait
        self.pool, self.lock, self.held, self.timer = ThreadPoolExecutor(workers), threading.Lock(), [], None

    def add(self, value) -> Future:
        answer: Future = Future()
        with self.lock:
            self.held.append((value, answer))
            if self.timer:
                self.timer.cancel()
            if len(self.held) >= self.size:
                self._send()
            else:
                self.timer = threading.Timer(self.wait, self.flush)
                self.timer.daemon = True
                self.timer.start()
        return answer

    def flush(self) -> None:
        with self.lock:
            self._send()

    def _send(self) -> None:
        some, self.held, self.timer = self.held, [], None
        if some:
            self.pool.submit(self._ask, some)

    def _ask(self, some: list[tuple]) -> None:
        try:
            answers = self.model([v for v, _ in some])
            if len(answers) != len(some):
                raise ValueError(f"{len(answers)} answers to {len(some)} inputs")
            for (_, f), x in zip(some, answers, strict=True):
                f.set_result(x)
        except Exception as e:  # noqa: BLE001  # whatever a model raises goes to those who asked
            for _, f in some:
                f.set_exception(e)

    def close(self) -> None:
        self.flush()
        self.pool.shutdown()


def _batched(model: Callable, column: str, size: int, wait: float, workers: int, ahead: int, kind: pa.DataType, name: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    batcher, line = Batcher(model, size, wait, workers), deque()

    def done() -> pa.RecordBatch:
        batch, asked = line.popleft()
        out, errors = [], []
        for f in asked:
            error = f.exception() if f is not None else None
            out.append(f.result() if f is not None and error is None else None)
            errors.append(f"{type(error).__name__}: {error}" if error is not None else None)
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, kind), pa.array(errors, pa.string())], [*batch.schema.names, name, f"{name}_error"])

    try:
        for batch in batches:
            for i in range(0, len(batch), size):
                part = batch.slice(i, size)
                line.append((part, [batcher.add(v) if v is not None and (not isinstance(v, str) or v.strip()) else None for v in part.column(column).to_pylist()]))
                if len(line) > ahead:
                    yield done()
        batcher.flush()
        while line:
            yield done()
    finally:
        batcher.close()


def annotate_concurrently(df: DataFrame, column: str, model: Callable[[list], list], name: str, kind: T.DataType, size: int = 256, wait: float = 1.0, workers: int = 4) -> DataFrame:
    """df with the model's answers and `{name}_error`: a task has up to `workers` requests of up to `size` inputs on their way, and holds twice as many rows.

    A request goes out early when no input has come for `wait` seconds. What fails has its error in its own rows and no answer; empty inputs are not
    sent and have neither.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    work = partial(_batched, model, column, size, wait, workers, 2 * workers, to_arrow_type(kind), name)
    return df.mapInArrow(work, T.StructType([*df.schema.fields, T.StructField(name, kind), T.StructField(f"{name}_error", T.StringType())]))


def annotate_batches(view: DataFrame, path: str, column: str, model: Callable[[list], list], name: str, kind: T.DataType, max_batches: int | None = None, chunk_rows: int = 10_000) -> int:
    """Add to the annotations at path (sources.batches) the answers for rows of a view (id, _batch, column) whose id they don't have.

    All batches that are left, or the first max_batches of them, are one job and one run; a run that is killed leaves nothing, and the next does its
    batches again. Rows without a batch are a batch of their own. Returns how many batches were written.
    """
    spark = view.sparkSession
    if (done := batches.read_runs(spark, path)) is not None:
        known = done.select(F.col("id").alias("_id"))
        view = view.join(known, F.col("id").eqNullSafe(F.col("_id")), "left_anti")
    names = view.select(F.col("_batch").alias("_b")).distinct()
    names, names_at = cut(names if max_batches is None else names.orderBy("_b").limit(max_batches), "batches")
    if n := names.count():
        rows = view if max_batches is None else view.join(names, F.col("_batch").eqNullSafe(F.col("_b")), "left_semi")
        batches.write_run(annotate(rows.select("id", "_batch", column), column, model, name, kind).drop(column), path, rows_per_file=chunk_rows)
    remove(spark, names_at)
    return n


def judge_feasibility(df: DataFrame, text: str, model: Callable[[list], list], tries: int = 6) -> DataFrame:
    """df with the judge's `explanation` and `label` 0 to 2; an empty text is not sent and has an explanation alone."""
    answered = annotate(df, text, retrying(model, tries), "_answer", T.StringType())
    parts = F.split("_answer", r"\|")
    said = F.array_join(F.slice(parts, 1, F.size(parts) - 1), "|")
    explanation = F.when(F.col("_answer").isNull(), F.lit("empty text")).when(F.size(parts) > 1, said)
    return answered.withColumns({"explanation": explanation, "label": verdict_012(F.col("_answer"))}).drop("_answer")


CLASSIFIED = T.StructType([T.StructField("classifier_label", T.StringType()), T.StructField("classifier_probs", T.ArrayType(T.DoubleType()))])


def hashed_classifier(texts: list[str], classes: int = 3) -> list[dict]:
    """Stand-in: probabilities in proportion to the first bytes of a digest, and the label of the greatest, the first of equals."""
    out = []
    for t in texts:
        w = [b + 1 for b in hashlib.md5(t.encode()).digest()[:classes]]
        out.append({"classifier_label": f"LABEL_{w.index(max(w))}", "classifier_probs": [x / sum(w) for x in w]})
    return out


KEYWORDS = T.StructType([T.StructField("entities", T.ArrayType(T.StringType())), T.StructField("summary", T.StringType())])


def capital_words(texts: list[str]) -> list[str]:
    """Stand-in for keyword extraction, in a fence as models write it: capitalised words as entities, the first six words as summary."""
    entities = [sorted(set(re.findall(r"[A-Z][a-z]+", t))) for t in texts]
    return ["```yaml" + json.dumps({"entities": e, "summary": " ".join(re.findall(r"[a-zA-Z]+", t)[:6])}) + "```" for t, e in zip(texts, entities, strict=True)]


def parse_keywords(output: str | None) -> dict | None:
    """(entities, summary) of a fenced YAML answer; null unless it has a list of strings and a string."""
    import yaml

    try:
        found = yaml.safe_load((output or "").removeprefix("```").removeprefix("yaml").removesuffix("```"))
    except yaml.YAMLError:
        return None
    if not isinstance(found, dict) or not isinstance(found.get("summary"), str) or not isinstance(found.get("entities"), list) or not all(isinstance(e, str) for e in found["entities"]):
        return None
    return {"entities": found["entities"], "summary": found["summary"]}


def _keywords(model: Callable, texts: list[str]) -> list:
    return [parse_keywords(o) for o in model(texts)]


def extract_keywords(df: DataFrame, text: str, model: Callable[[list], list], tries: int = 3) -> DataFrame:
    """df with `keywords`, a struct of entities and a summary; null for empty texts and answers that can't be read."""
    return annotate(df, text, retrying(partial(_keywords, model), tries), "keywords", KEYWORDS)


VERDICT = T.StructType([T.StructField("validity", T.IntegerType()), T.StructField("explanation", T.StringType()), T.StructField("n_search_calls", T.IntegerType())])


def hashed_agent(prompts: list[str], searches: bool = True) -> list[dict]:
    """Stand-in for an agent that checks a claim: digests give the verdict, none for some, and how often it searched."""
    out = []
    for p in prompts:
        d = hashlib.md5(p.encode()).digest()
        out.append({"validity": None if d[0] >= 240 else int(d[0] < 144), "explanation": "stand-in", "n_search_calls": d[1] % 16 if searches else 0})
    return out


def verdict_runs(df: DataFrame, text: str, agent: Callable[[list], list], runs: int) -> DataFrame:
    """Rows of df once for each run, with an agent's validity, explanation and number of searches; failed runs have no validity.

    agent gets `text #run`. Search, no-search and other-search agents differ in the callable alone; a search tool is the agent's own and
    gets its range of dates from parse.freshness.
    """
    asked = repeat_runs(df, runs).withColumn("_prompt", F.concat(F.coalesce(F.col(text), F.lit("")), F.lit(" #"), F.col("run").cast("string")))
    return annotate(asked, "_prompt", retrying(agent), "_v", VERDICT).select(*df.columns, "run", "_v.validity", "_v.explanation", "_v.n_search_calls")


def repeat_runs(df: DataFrame, runs: int) -> DataFrame:
    """Each row once per run, with its number."""
    return df.select("*", F.explode(F.sequence(F.lit(0), F.lit(runs - 1))).alias("run"))


@lru_cache(1 << 16)
def _trigram_place(trigram: str, dims: int) -> int:
    """Where a trigram counts: its digest's remainder, and dims more if it counts as positive."""
    h = int.from_bytes(hashlib.blake2b(trigram.lower().encode(), digest_size=8).digest(), "little")
    return h % dims + dims * (h >> 63)


@lru_cache(2)
def _ascii_places(dims: int) -> np.ndarray:
    """_trigram_place by the three 7-bit codes, negative where it isn't known yet: 8 MB."""
    return np.full(1 << 21, -1, np.int32)


def hashed_embedder(texts: list[str], dims: int = 128) -> list[list[float]]:
    """Stand-in: signed counts of hashed character trigrams, of unit length."""
    out = []
    for t in texts:
        if t.isascii() and len(t) > 2:
            known, b = _ascii_places(dims), np.frombuffer(t.encode(), np.uint8).astype(np.int32)
            codes = b[:-2] << 14 | b[1:-1] << 7 | b[2:]
            for code in np.unique(codes[known[codes] < 0]).tolist():
                known[code] = _trigram_place(chr(code >> 14) + chr(code >> 7 & 127) + chr(code & 127), dims)
            places = known[codes]
        else:
            places = [_trigram_place(t[i : i + 3], dims) for i in range(max(1, len(t) - 2))]
        counts = np.bincount(places, minlength=2 * dims).astype(float)
        v = counts[dims:] - counts[:dims]
        out.append((v / max(np.linalg.norm(v), 1e-12)).tolist())
    return out


def hashed_judge(texts: list[str], classes: int = 3) -> list[str]:
    """Stand-in: a verdict line whose class comes from a digest of the text."""
    return [f"stand-in | {hashlib.md5(t.encode()).digest()[0] % classes}" for t in texts]


def coherent(vectors: list[list[list[float]]], least: float = 0.3) -> list[int]:
    """Stand-in for a judge of clusters: 1 if the mean cosine of all pairs reaches `least`."""
    out = []
    for v in vectors:
        u = np.array(v, float)
        u /= np.maximum(np.linalg.norm(u, axis=1, keepdims=True), 1e-12)
        n = len(u)
        out.append(int(n < 2 or ((u.sum(axis=0) ** 2).sum() - n) / (n * (n - 1)) >= least))
    return out


CLAIM = T.StructType([
    T.StructField("claim", T.StringType()), T.StructField("post_indices", T.ArrayType(T.IntegerType())), T.StructField("public_entities", T.ArrayType(T.StringType())),
    T.StructField("is_time_sensitive", T.BooleanType()), T.StructField("is_relevant", T.BooleanType()), T.StructField("is_specific", T.BooleanType()),
])
_BLOCK = re.compile(r"-\s*claim:\s*(?P<claim>[^\n]+)\n(?:(?!-\s*claim:).*\n)*?\s*post_indices:\s*\[(?P<at>[\d,\s]*)\]")


def parse_claims(output: str | None) -> list[dict] | None:
    """Claims of a model's YAML, fenced or not; from broken YAML the entries that are complete; null if there is nothing to read."""
    if output is None:
        return None
    text = re.sub(r"^\s*```[a-zA-Z]*\s*\n|\n?```\s*$", "", output.strip())
    flag = lambda d, k: d[k] if isinstance(d.get(k), bool) else None
    try:
        import yaml

        found = yaml.safe_load(text)
        found = found.get("claims") if isinstance(found, dict) else found
        if isinstance(found, list):
            rows = [d for d in found if isinstance(d, dict) and isinstance(d.get("claim"), str)]
            return [{"claim": d["claim"], "post_indices": [i for i in d.get("post_indices") or [] if isinstance(i, int)], "public_entities": [str(e) for e in d.get("public_entities") or []]} | {k: flag(d, k) for k in ("is_time_sensitive", "is_relevant", "is_specific")} for d in rows]
    except Exception:  # noqa: BLE001  # whatever a model wrote, the entries below may be whole
        pass
    rows = [{"claim": m["claim"].strip().strip("'\""), "post_indices": [int(x) for x in m["at"].split(",") if x.strip()], "public_entities": [], "is_time_sensitive": None, "is_relevant": None, "is_specific": None} for m in _BLOCK.finditer(text + "\n")]
    return rows or None


def _parse_all(outputs: list[str]) -> list:
    return [parse_claims(o) for o in outputs]


def first_sentences(prompts: list[str]) -> list[str]:
    """Stand-in for claim extraction: the first words of the first two posts of the prompt, as YAML."""
    out = []
    for p in prompts:
        posts = re.findall(r"^\[(\d+)\] (.*)", p, re.M)[:2]
        out.append("```yaml\nclaims:\n" + "".join(f"  - claim: 'Claim {' '.join(re.findall(r'[a-zA-Z]+', t)[:6])}'\n    post_indices: [{i}, 99999]\n    is_relevant: true\n" for i, t in posts) + "```")
    return out


def extract_claims(clusters: DataFrame, cluster: str, texts: str, model: Callable[[list], list], template: str = "{posts}", most_texts: int = 50, most_claims: int = 5, date=None) -> DataFrame:
    """One row per claim of each cluster: (cluster, claim_no, claim, post_count, original_texts, date, attributes).

    The prompt has the first most_texts texts, numbered from 0; places a claim names are looked up among all texts of the cluster, and
    those out of range are left out. Of each answer the first most_claims count, in ascending order of support. Clusters whose
    answer can't be read give no rows.
    """
    from tidemark.functions.parse import fill_prompt, gather, numbered

    prompts = clusters.withColumn("prompt", fill_prompt(template, "posts", numbered(F.slice(texts, 1, most_texts))))
    answers = annotate(prompts, "prompt", model, "answer", T.StringType())
    parsed = annotate(answers.drop("prompt"), "answer", _parse_all, "claims", T.ArrayType(CLAIM))
    rows = F.transform(F.slice("claims", 1, most_claims), lambda c, i: F.struct(F.size(gather(F.col(texts), c["post_indices"])).alias("post_count"), i.alias("at"), c.alias("c")))
    each = parsed.select(cluster, texts, (F.lit("") if date is None else date).alias("date"), F.posexplode(F.array_sort(rows)).alias("claim_no", "r"))
    return each.select(cluster, "claim_no", "r.c.claim", "r.post_count", gather(F.col(texts), F.col("r.c.post_indices")).alias("original_texts"), "date", "r.c.public_entities", "r.c.is_time_sensitive", "r.c.is_relevant", "r.c.is_specific")


CLAIM_ROW = "claim_no int, claim string, post_count int, original_texts array<string>"


def claims_function(cluster: str, text: str, model: Callable[[list], list], kind: str = "long", template: str = "{posts}", most_texts: int = 50, most_claims: int = 5):
    """A table function from the rows of one cluster, in their order, to its claims: for `f(rows.asTable().partitionBy(cluster).orderBy(...))`.

    Its rows are (cluster, claim_no, claim, post_count, original_texts), as extract_claims has them. A cluster's texts are held while it is
    asked, so clusters are meant to be bounded; those without an answer or with one that can't be read, and those whose request fails, give no rows.
    """

    class Claims:
        def __init__(self) -> None:
            self.key, self.texts = None, []

        def eval(self, row) -> None:
            self.key = row[cluster]
            self.texts.append(row[text])

        def terminate(self) -> Iterator[tuple]:
            if not self.texts:
                return
            prompt = template.replace("{posts}", "\n\n".join(f"[{i}] {t}" for i, t in enumerate(self.texts[:most_texts]) if t is not None))
            try:
                found = parse_claims((model([prompt]) or [None])[0]) or []
            except Exception:  # noqa: BLE001  # a cluster whose request fails has no claims
                return
            gathered = [(c["claim"], [self.texts[i] for i in c["post_indices"] if 0 <= i < len(self.texts)]) for c in found[:most_claims]]
            for n, (claim, texts) in enumerate(sorted(gathered, key=lambda x: len(x[1]))):  # ties in the order of the answer
                yield self.key, n, claim, len(texts), texts

    return F.udtf(Claims, returnType=f"{cluster} {kind}, {CLAIM_ROW}")
