"""Filter audit and decontamination against plain loops, with odd rows and small bounds."""

import hashlib
import re
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, filter_audit

LONG = " ".join(f"word{i}" for i in range(60))


def plain_flags(text, copy):
    words = [w for w in re.split(r"[ \t-\r]+", text) if w]
    failed = {"A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text), "D": bool(re.search("[#$%&*|]", text)), "E": copy}
    return {k for k, v in failed.items() if v}


def plain_audit(rows, labels):
    docs = []
    for i, text, source in rows:
        copy = i is not None and any(j is not None and j < i and (t or "") == (text or "") for j, t, _ in rows)
        good, toxic = (any(x[0] == i and x[k] == 1 for x in labels) and i is not None for k in (1, 2))
        docs.append((source or "", plain_flags(text or "", copy), good, toxic))
    out, shapley = {}, {}
    for part in {d[0] for d in docs}:
        for order in map("".join, permutations("ABCDE")):
            for step, f in enumerate(order, 1):
                mine = [(fails, min((order.index(x) + 1 for x in fails), default=6), good, toxic) for p, fails, good, toxic in docs if p == part]
                removed = [d for d in mine if d[1] == step]
                shapley[part, f] = shapley.get((part, f), 0) + len(removed)
                out[part, order, step] = (sum(d[1] > step for d in mine), len(removed), sum(f in d[0] and d[1] < step for d in mine), sum(d[0] == {f} for d in mine), sum(d[2] for d in removed), sum(d[3] for d in removed))
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_every_order_is_replayed(spark):
    rows = [(1, LONG, "s"), (2, LONG, "t"), (3, LONG, "s"), (3, LONG, "s"), (None, LONG, "s"), (None, None, None), (5, None, ""), (6, "", None), (7, "A" * 30, "s"), (8, LONG + " $", "t"),
            (9, "same " * 80, "t"), (10, "É" * 10 + " " + LONG, "s"), (11, LONG.upper(), "s"), (12, "a\x0bb\x0cc\x1fd " * 30, "t"), (13, LONG + " ", "t"), (14, LONG * 400, "s")]
    labels = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (7, None, 1), (8, 1, None), (None, 1, 1), (99, 1, 1)]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, source string, fails int, part string").repartition(3)
    said = spark.createDataFrame([(*r, True) for r in labels], "doc_id long, quality int, toxic int, good boolean")
    got = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in filter_audit.filter_audit(docs, said).collect()}
    assert got == plain_audit(rows, labels)
    assert len(filter_audit.filter_audit(docs, said.where("false")).collect()) == 600 * 3
    assert filter_audit.filter_audit(docs.where(F.lit(False)), said).collect() == []


def plain_words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", low) if w]


def plain_hits(docs, items, size=10):
    out = []
    for i, text in docs:
        words, hit, found = plain_words(text), set(), set()
        for name, item in items:
            w = plain_words(item)
            for s in range(max(1, len(w) - size + 1) if w else 0):
                window = w[s : s + size]
                for at in range(len(words) - len(window) + 1):
                    if words[at : at + len(window)] == window:
                        hit |= set(range(at, at + len(window)))
                        found |= {name} - {None}
        listed = sorted(map(str, found))
        out.append((i, len(words), len(hit), len(listed), hashlib.sha256(",".join(listed).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


ITEMS = [(1, " ".join(f"q{i}" for i in range(14))), (2, "one two three four five six seven eight nine ten"), (10, "Short Item"), (3, "solo"), (4, None), (5, " ... "), (None, "alpha beta gamma delta"), (2, "x y z"), (6, "the the the the"), (7, "ñandú Ñandú çà et là"), (8, "one two three four five six seven eight nine ten")]
DOCS = [
    (1, " ".join(f"q{i}" for i in range(14))), (2, "pre " + " ".join(f"Q{i}" for i in range(3, 13)) + " post"), (3, "q0 q1 q2 q3 q4 q5 q6 q7 q8 broken"), (4, "ONE,two;three\nfour five six seven eight nine ten one two three"),
    (5, "a short item, SHORT  ITEM; shortitem"), (6, "solo solo"), (7, None), (8, ""), (9, "!!"), (None, "alpha beta gamma delta"), (11, "the the the the the the"), (11, "x y z x y z"), (12, "ñandú ñandú çà et là ñandú Ñandú çà et là"),
    (13, "x y " * 50 + "z"), (14, "seven eight nine ten " + "one two three four five six " * 3), (15, "filler words " * 3000 + "alpha beta gamma delta"), (16, "beta gamma delta"), (17, "y z"),
]


@pytest.mark.parametrize(("broadcast", "shingle", "size"), [(8 << 20, 3, 10), (0, 3, 10), (8 << 20, 1, 10), (8 << 20, 2, 4)])
def test_windows_are_found_exactly(spark, monkeypatch, broadcast, shingle, size):
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", broadcast)
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in DOCS], "doc_id long, text string, row int, window string").repartition(3)
    items = spark.createDataFrame([(i, t, 2) for i, t in ITEMS], "item_id long, text string, pos int")
    found = decontaminate.contamination(docs, items, size, shingle)
    got = sorted((tuple(r) for r in decontaminate.contamination_digest(found).collect()), key=str)
    assert got == plain_hits(DOCS, ITEMS, size)


def test_no_items_no_documents(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert {r.contaminated for r in decontaminate.contamination_digest(decontaminate.contamination(docs, items.where("false"))).collect()} == {False}
    assert decontaminate.contamination(docs.where("false"), items).collect() == []
    spans = {r.doc_id: [tuple(s) for s in r.spans] for r in decontaminate.contamination(docs, items).collect()}
    assert spans[2] == [(1, 10)] and spans[14] == [] and spans[6] == [(0, 2)]
