"""Units against hand-made values and brute force."""

import hashlib
import itertools
import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark import storage
from tidemark.functions import parse, stats, vectors
from tidemark.operators import bursts, classifier, clustering, evaluation, models, neighbours, sampling, sweep, views
from tidemark.operators.components import connected_components
from tidemark.sources import files
from tidemark.sources.files import encode_columns, parse_logs


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(("line", "v012", "v01", "coherent"), [("ok | 2", 2, None, None), ("a|b|1", 1, 1, 1), ("no pipe", None, None, None), ("x | 7", None, None, None), ("Rating: 1", None, 1, 1), ("verdict : 0", None, 0, 0), ("then 0 or 1", None, 1, 0)])
def test_verdicts(spark, line, v012, v01, coherent):
    c = F.col("line")
    assert one(spark, parse.verdict_012(c), line=line) == v012
    assert one(spark, parse.verdict_01(c), line=line) == v01
    assert one(spark, parse.verdict_coherent(c), line=line) == coherent


def test_names_and_days(spark):
    c = F.col("s")
    assert one(spark, parse.safe_name(c), s="__a b/c?") == "a_b_c"
    assert one(spark, parse.day_of_batch(c), s="stream-20240105-07") == "20240105"
    assert one(spark, parse.day_of_batch(c), s="none") == "unknown"
    assert one(spark, parse.lenient_date(c), s="2024-01-05T10:00:00Z") == "2024-01-05"
    assert one(spark, parse.lenient_date(c), s="short") is None
    assert one(spark, parse.json_scalar(c), s='"LABEL_2"') == "LABEL_2"
    assert one(spark, parse.label_number(c), s="LABEL_2") == 2
    assert parse.text_column(["id", "text", "claim"]) == "claim"


def brute_states(gaps, s=2.0, gamma=1.0, k=3):
    rate = [(len(gaps) / sum(gaps) if sum(gaps) else 1.0) * s**q for q in range(k)]
    best = None
    for path in itertools.product(range(k), repeat=len(gaps)):
        cost = sum(-math.log(rate[q]) + rate[q] * g for q, g in zip(path, gaps)) + sum(gamma * max(0, b - a) for a, b in zip(path, path[1:]))
        if best is None or cost < best - 1e-9:
            best = cost
    return best, rate


@pytest.mark.parametrize("seed", range(6))
def test_viterbi_is_cheapest(seed):
    gaps = np.random.default_rng(seed).exponential(1, 6) * np.array([1, 1, 0.05, 0.05, 1, 1])
    best, rate = brute_states(gaps.tolist())
    path = bursts.viterbi(gaps, states=3)
    cost = sum(-math.log(rate[q]) + rate[q] * g for q, g in zip(path, gaps)) + sum(max(0, b - a) for a, b in zip(path, path[1:]))
    assert cost == pytest.approx(best)


def test_equal_times_have_rate_one(spark):
    events = spark.createDataFrame([("a", 5), ("a", 5), ("a", 5), ("b", 1), ("b", 2)], "k string, t long")
    m = bursts.burst_metrics(bursts.burst_states(events, "k", "t"), "k").collect()
    assert [(r.k, r.num_reactions, r.base_rate) for r in m] == [("a", 3, 1.0)]


def test_components(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (9, 8), (5, 5), (3, 1)], "a long, b long")
    assert sorted(map(tuple, connected_components(edges).collect())) == [(1, 1), (2, 1), (3, 1), (8, 8), (9, 8)]
    assert connected_components(edges.where("a > 99")).count() == 0
    chain = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r.component for r in connected_components(chain).collect()} == {0}


def test_nearest_equals_brute_force_over_blocks(spark):
    v = np.random.default_rng(0).normal(size=(60, 8))
    rows = spark.createDataFrame([(i, v[i].tolist()) for i in range(60)], "id long, v array<double>")
    got = {(r.src, r["rank"]): r.dst for r in neighbours.nearest(rows, 3, block_rows=16).collect()}
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    s = u @ u.T
    np.fill_diagonal(s, -9)
    assert got == {(i, k + 1): int(j) for i in range(60) for k, j in enumerate(np.argsort(-s[i])[:3])}


def test_symmetric_drops_single_negative(spark):
    edges = spark.createDataFrame([(1, 2, -0.5), (3, 4, -0.5), (4, 3, -0.5), (5, 6, 0.2)], "src long, dst long, sim double")
    assert sorted((r.a, r.b) for r in neighbours.symmetric(edges).collect()) == [(3, 4), (5, 6)]


def test_vectors(spark):
    assert vectors.kept_neighbours(20, 0.95) == 2 and vectors.auto_k(10000) == 14 and vectors.auto_clusters(1) == 1
    row = spark.createDataFrame([([1.5, -2.0],)], "v array<float>").select(vectors.decode_vector(vectors.encode_vector("v")).alias("v")).first()
    assert row.v == [1.5, -2.0]


def test_mean_ci_and_t(spark):
    assert stats.t_quantile(1) == pytest.approx(12.7062, abs=1e-3) and stats.t_quantile(9) == pytest.approx(2.26216, abs=1e-4)
    r = stats.mean_ci(spark.createDataFrame([("a", 10.0), ("a", 20.0), ("b", 5.0)], "k string, v double"), ["k"], "v").orderBy("k").collect()
    assert r[0].ci_low == 0 and r[0].ci_high == pytest.approx(15 + 12.7062 * 5, abs=0.01) and r[1].mean == 5 and r[1].std is None and r[1].ci_low is None


def test_kappa(spark):
    full = spark.createDataFrame([(i, r, i % 2) for i in range(6) for r in range(3)], "s int, r int, v int")
    assert stats.fleiss_kappa(full, "s", "v").first().kappa == pytest.approx(1.0)
    same = full.withColumn("v", F.lit(1))
    assert stats.fleiss_kappa(same, "s", "v").first().kappa == 1.0
    assert math.isnan(stats.fleiss_kappa(full.where("s = 0"), "s", "v").first().kappa)


def test_votes(spark):
    r = spark.createDataFrame([(1, 1), (1, 0), (2, None), (3, 0)], "e int, validity int")
    assert {x.e: x.vote for x in evaluation.votes(r, "e").collect()} == {1: True, 2: False, 3: False}


def test_allocate_and_sample(spark):
    assert sampling.allocate([10, 10, 0], 5) == [2, 3, 0] or sum(sampling.allocate([10, 10, 0], 5)) == 5
    assert sum(sampling.allocate([1, 2, 50], 10)) == 10
    c = spark.createDataFrame([(i, ["t"] * (3 + i)) for i in range(12)], "id int, texts array<string>")
    assert sampling.sample_clusters(c, "id", "texts", 6, 2).count() == 6


def test_merge_rows_skips_nulls(spark):
    rows = spark.createDataFrame([(1, None, "b"), (1, "t", "a")], "id long, text string, _batch string")
    assert views.merge_rows(rows).first().asDict() == {"id": 1, "text": "t", "_batch": "a"}


def test_sweep_merges_as_merge_small(spark):
    rng = np.random.default_rng(4)
    rows = [(f, i, i % 7 if i < 40 else i, [float(x) for x in rng.normal(size=4)]) for f in (0.5, 0.9) for i in range(44 if f == 0.5 else 30)]
    df = spark.createDataFrame(rows, "drop_frac double, id long, cluster long, v array<double>")
    got = sweep.merged_grid(df, (2, 6), (0.0, 0.4)).collect()
    for f in (0.5, 0.9):
        for m in (2, 6):
            for t in (0.0, 0.4):
                want = clustering.merge_small(df.where(F.col("drop_frac") == f).select("id", "cluster", "v"), m, t).collect()
                assert sorted((r.id, r.cluster) for r in got if (r.drop_frac, r.min_size, r.threshold) == (f, m, t)) == sorted((r.id, r.cluster) for r in want)
    assert sampling.allocate([50, 30, 1], 20) == [12, 7, 1] and sampling.allocate([3, 0, 1], 20) == [3, 0, 1] and sum(sampling.allocate([1, 1, 98], 20)) == 20


def test_sweeps_have_every_combination(spark):
    rng = np.random.default_rng(5)
    v = np.repeat(np.eye(4) * 5, 12, axis=0) + rng.normal(size=(48, 4)) * 0.3
    df = spark.createDataFrame([(i, "t" if i % 5 else " ", x.tolist()) for i, x in enumerate(v)], "id long, text string, v array<double>")
    got = {(r.drop_frac, r.min_size, r.threshold): r for r in sweep.judged_sweep(df, (0.0, 0.5), (2, 5), (0.0, 0.3), sample=3).collect()}
    assert len(got) == 8 and all(0 < r.n_judged == r.n_sampled == min(3, r.n_clusters) and r.n_coherent == r.n_judged and r.coherence_rate == 100 for r in got.values())
    none = sweep.judged_sweep(df, (0.5,), (2,), (0.0,), sample=3, judge=lambda vs: [None] * len(vs)).first()
    assert (none.n_sampled > 0, none.n_judged, none.coherence_rate) == (True, 0, None)
    assert sweep.cluster_counts(df, (2, 5), (0.0, 0.9)).count() == 4


def test_days_are_clustered_apart(spark):
    rng = np.random.default_rng(6)
    v = np.array([1.0, 0, 0]) + rng.normal(size=(20, 3)) * 0.01
    rows = [(i, f"day-{i % 2 if i < 19 else 2}", f"word{i} other{i * 7} third{i * 3}", x.tolist()) for i, x in enumerate(v)]
    rows += [(100, "day-0", rows[0][2], v[0].tolist())]
    got = {r.day: r for r in sweep.day_clusters(spark.createDataFrame(rows, "id long, day string, text string, v array<double>"), 0.9, 3, 3, sample=4).collect()}
    assert sorted(got) == ["day-0", "day-1"]
    for day, r in got.items():
        ids = {x[0] for x in rows if x[1] == day}
        assert r.cluster_size == len(ids) - (day == "day-0") and len(r.central_ids) == len(r.diverse_ids) == 4 and {*r.central_ids, *r.diverse_ids} <= ids
        assert r.central_texts == [next(x[2] for x in rows if x[0] == i) for i in r.central_ids]


def test_diverse_order_starts_central():
    v = np.array([[1.0, 0], [0.9, 0.1], [0, 1.0], [0.5, 0.5]])
    order = clustering.diverse_order(v, 3)
    assert order[0] == 3 and len(set(order)) == 3 and clustering.diverse_order(v, 9) == [0, 1, 2, 3]


def test_claims():
    fenced = "```yaml\nclaims:\n  - claim: 'A'\n    post_indices: [0, 2]\n    is_relevant: true\n```"
    assert models.parse_claims(fenced)[0] | {} == {"claim": "A", "post_indices": [0, 2], "public_entities": [], "is_time_sensitive": None, "is_relevant": True, "is_specific": None}
    broken = "claims:\n  - claim: A\n    post_indices: [1]\n  - claim: B\n    post_ind: [\n"
    assert [c["claim"] for c in models.parse_claims(broken)] == ["A"]
    assert models.parse_claims(None) is None


def test_logs_without_epochs(spark):
    r = parse_logs(spark.createDataFrame([("Task 3 params: LR=1\nnothing",)], "value string")).collect()
    assert [(x.task, x.epoch) for x in r] == [(3, None)]


def test_encode_columns(spark):
    r = encode_columns(spark.createDataFrame([("i", 'a"b', [1, 2], None)], "id string, s string, a array<int>, n string")).first()
    assert (r.id, r.s, r.a, r.n) == ("i", json.dumps('a"b'), "[1,2]", None)


def test_label_ranks_and_splits(spark):
    rows = spark.createDataFrame([(i, "a" if i % 5 else "b") for i in range(500)] + [(900, None)], "id long, label string").repartition(7)
    got = sampling.ranked(rows, "id", "label", 3).collect()
    for label in ("a", "b", None):
        mine = sorted((hashlib.md5(f"3|{r.id}".encode()).hexdigest(), r.id, r._r, r._n) for r in got if r.label == label)
        assert [m[2] for m in mine] == list(range(len(mine))) and {m[3] for m in mine} == {len(mine)}
    assert sampling.balance(rows.where("id < 900"), "id", "label", 3).groupBy("label").count().collect() == sampling.balance(rows.where("id < 900"), "id", "label", 3).groupBy("label").count().collect()
    assert {r["count"] for r in sampling.balance(rows.where("id < 900"), "id", "label", 3).groupBy("label").count().collect()} == {100}
    assert sampling.balance(rows.where("id < 0"), "id", "label", 3).count() == 0


def test_nearest_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    v = np.repeat(rng.normal(size=(60, 6)), 2, axis=0)
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, v array<double>")
    got = {(r.src, r.rank): r.dst for r in neighbours.nearest(df, 4, block_rows=17).collect()}
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    sims = np.round(u @ u.T, 12)
    for i in range(len(v)):
        order = sorted((j for j in range(len(v)) if j != i), key=lambda j: (-sims[i, j], j))[:4]
        assert [got[i, k + 1] for k in range(4)] == order
    assert neighbours.nearest(df, 200, 0.9, block_rows=17).count() == int((sims >= 0.9).sum()) - len(v)


def test_retries_and_failures():
    calls = []

    def shaky(values):
        calls.append(len(values))
        if len(values) > 1 or values == ["bad"]:
            raise ValueError
        return [v.upper() for v in values]

    assert models.retrying(shaky, 2)(["a", "bad", "c"]) == ["A", None, "C"] and calls[:2] == [3, 3]
    with pytest.raises(RuntimeError):
        models.retrying(shaky, 2)(["bad"])
    assert models.parse_keywords("```yaml\nentities: [A, B]\nsummary: s\n```") == {"entities": ["A", "B"], "summary": "s"}
    assert models.parse_keywords("entities: 3") is None and models.parse_keywords(None) is None and models.parse_keywords("a: [") is None


def test_sweep_checks():
    evaluation.check_sweep([0, 0.9], [2], [0.0])
    for bad in (([1.0], [2], [0]), ([0], [1], [0]), ([0], [2], [1.0])):
        with pytest.raises(ValueError, match="out of range"):
            evaluation.check_sweep(*bad)


def test_freshness(spark):
    f = lambda a, b: spark.range(1).select(parse.freshness(F.lit(a), F.lit(b))).first()[0]
    assert f("2020-01-01", "2024-01-01") == "2020-01-01to2024-01-01" and f(None, "") == ""
    with pytest.raises(Exception, match="go together"):
        f("2020-01-01", None)
    start, end = parse.stale_range(F.lit("2024-03-10").cast("date"))
    assert spark.range(1).select(start, end).first()[:] == ("2020-01-01", "2024-02-25")


def test_files_of_a_split(spark):
    root = storage.new_path(spark, "split")
    one = spark.createDataFrame([("x",)], "claim string")
    for name in ("s/test-0.parquet", "data/t/train-0.parquet", "data/t/test-0.parquet", "data/t/test-1.json"):
        storage.write_one(one, f"{root}/{name}")
    assert files.dataset_files(spark, root, "t", "test") == ["data/t/test-0.parquet"] and files.dataset_files(spark, root, "s", None) == ["s/test-0.parquet"]
    assert files.best_file(spark, root, "t", "train") == "data/t/train-0.parquet" and files.best_file(spark, root, "t", "none") == "data/t/test-0.parquet"
    with pytest.raises(ValueError, match="no Parquet"):
        files.load_split(spark, root, "u", "test")
    with pytest.raises(ValueError, match="no Parquet"):
        files.best_file(spark, root, "u")


def test_classifier_learns(spark):
    rows = spark.createDataFrame([(i, ("good fine " if i % 2 else "bad poor ") + f"w{i % 7}", i % 2) for i in range(200)] + [(900, None, 1)], "id long, text string, label int")
    model = classifier.train(rows.where("id < 150"))
    found = classifier.evaluate(model, rows.where("id >= 150 and id < 900")).first()
    assert found.accuracy == 1.0 and found.n == 50 and found.loss < 0.3
    assert classifier.predict(model, rows).count() == 201
    assert classifier.evaluate(model, rows.where("id < 0")).first()[:] == (0, None, None)


def test_diverse_sample_equals_brute_force(spark):
    from tidemark.plans import catalogue

    d = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{d}/embeddings.parquet").collect()
    got = {}
    for r in catalogue.QUERIES["diverse_sample"](spark, d).collect():
        got.setdefault(r.cluster, []).append((r["rank"], r.id))
    for label in {r.label for r in rows}:
        mine = sorted((r.vec_id, np.array(r.embedding, float)) for r in rows if r.label == label) if label is not None else []
        if not mine:
            continue
        ids, v = [m[0] for m in mine], np.array([m[1] for m in mine])
        if len(v) <= 5:
            assert [i for _, i in sorted(got[label])] == ids
            continue
        mean = v.mean(axis=0)
        chosen = [max(range(len(v)), key=lambda i: float(v[i] @ mean / np.linalg.norm(v[i])))]
        while len(chosen) < 5:
            m = v[chosen].mean(axis=0)
            chosen.append(max((i for i in range(len(v)) if i not in chosen), key=lambda i: float(np.linalg.norm(v[i] - m))))
        assert [i for _, i in sorted(got[label])] == [ids[c] for c in chosen]


def test_parameter_sweep_equals_brute_force(spark):
    from tidemark.plans import catalogue

    d = "/root/testdata/sf0.001"
    rows = sorted(spark.read.parquet(f"{d}/embeddings.parquet").collect(), key=lambda r: r.vec_id)
    u = np.array([r.embedding for r in rows], float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    sims, n = np.round(u @ u.T, 12), len(u)
    np.fill_diagonal(sims, -9)
    order = np.argsort(-sims, axis=1, kind="stable")
    found = catalogue.QUERIES["parameter_sweep"](spark, d).collect()
    assert len(found) == 35
    for r in found:
        keep = max(1, int(np.ceil(r.k * (1 - r.drop_frac))))
        link = np.zeros((n, n), bool)
        for i in range(n):
            link[i, order[i, :keep]] = True
        both = (link | link.T) & ((sims > 0) | (link & link.T & (sims != 0)))
        seen, sizes = set(), []
        for i in range(n):
            if i not in seen:
                todo, mine = [i], {i}
                while todo:
                    new = set(np.flatnonzero(both[todo.pop()]).tolist()) - mine
                    mine |= new
                    todo += new
                seen |= mine
                sizes.append(len(mine))
        assert r.n == len(sizes), r


def _socket_server(messages):
    """A server for one client: handshake, a ping, a message in two frames, the others whole; returns its port and what the client sent."""
    import socket
    import threading

    from tidemark.sources import wire

    line, sent = socket.create_server(("127.0.0.1", 0)), []

    def serve():
        client, _ = line.accept()
        head = b""
        while b"\r\n\r\n" not in head:
            head += client.recv(4096)
        sent.append(head.decode().split("\r\n")[0])
        key = next(x for x in head.decode().split("\r\n") if x.lower().startswith("sec-websocket-key")).split(": ")[1]
        client.sendall(f"HTTP/1.1 101 Switching Protocols\r\nUpgrade: websocket\r\nSec-WebSocket-Accept: {wire.accept_key(key)}\r\n\r\n".encode())
        client.sendall(wire.frame(wire.PING, b"hi"))
        half = messages[0][:5]
        client.sendall(bytes([wire.TEXT, len(half)]) + half + wire.frame(0, messages[0][5:]))
        for m in messages[1:]:
            client.sendall(wire.frame(wire.TEXT, m))
        client.sendall(wire.frame(wire.CLOSE, b""))
        sent.append(client.recv(4096))
        client.close()

    threading.Thread(target=serve, daemon=True).start()
    return line.getsockname()[1], sent


def test_web_socket_events():
    from tidemark.sources import live, wire

    events = [{"time_us": 9_000_000 + i, "pad": "x" * n} for i, n in enumerate((3, 200, 70_000))]
    port, sent = _socket_server([json.dumps(e).encode() for e in events] + [b"no json"])
    fetch = wire.stream_fetch(idle=10)
    reader = live.EventReader(fetch, lambda: 9_000_002, (f"ws://127.0.0.1:{port}/subscribe",), ("a.b",), 9_000_000, 3, 100, tries=1)
    [span] = reader.partitions(reader.initialOffset(), reader.latestOffset())
    assert [json.loads(r[0]) for r in reader.read(span)] == events[:2]
    assert sent[0] == "GET /subscribe?wantedCollections=a.b&cursor=6000000 HTTP/1.1"
    with pytest.raises(OSError):
        wire.stream_fetch(idle=1)("ws://127.0.0.1:9", "a", 0, 1, 1)


def test_paged_feed(spark):
    """Pages over HTTP until the limit is reached, counted by page; rows come from the data source."""
    import http.server
    import threading

    from tidemark.sources import live, wire

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            at = int((self.path.split("cursor=") + ["0"])[1])
            body = json.dumps({"feed": [{"post": {"uri": f"u{at + i}"}} for i in range(4)], "cursor": str(at + 4) if at < 40 else None}).encode()
            self.send_response(200)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *_):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    spark.dataSource.register(live.feed_source("test_feed", wire.feed_fetch(f"http://127.0.0.1:{server.server_port}/feed")))
    read = lambda limit: sorted(json.loads(r.value)["post"]["uri"] for r in spark.read.format("test_feed").option("limit", limit).option("page", 4).load().collect())
    assert read(10) == sorted(f"u{i}" for i in range(12)) and len(read(1000)) == 44
    server.shutdown()


def test_late_events_are_dropped(spark):
    """Windows close when the watermark passes them; an event older than that changes nothing."""
    import time

    from tidemark.streaming import flows

    at = storage.new_path(spark, "late")
    for hours in (["00:10", "01:10"], ["03:00"], ["00:20", "05:00"], ["08:00"]):
        storage.write_one(spark.createDataFrame([(f"2024-01-01 {h}:00", "k") for h in hours], "t string, kind string"), f"{at}/in/{hours[0].replace(':', '')}-{len(hours)}.json", "json")
        time.sleep(1.1)  # files of a trigger come in the order of their times
    stream = flows.replay(spark, f"{at}/in", "t timestamp, kind string")
    got = flows.collect_stream(flows.tumbling(stream, "t", ["kind"]), f"{at}/rows", f"{at}/state").collect()
    assert {r.start.hour: r.n for r in got if r.start.hour < 8} == {0: 1, 1: 1, 3: 1, 5: 1}


def test_kmeans_finds_apart_groups(spark):
    rng = np.random.default_rng(1)
    centers = np.eye(6)[:4] * 10
    rows = [(g * 20 + i, (centers[g] + rng.normal(size=6) * 0.1).tolist()) for g in range(4) for i in range(20)]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    found = {r.id: r.cluster for r in clustering.cluster_kmeans(df, 4).collect()}
    groups = [{found[g * 20 + i] for i in range(20)} for g in range(4)]
    assert all(len(g) == 1 for g in groups) and len(set.union(*groups)) == 4
    assert {r.id: r.cluster for r in clustering.cluster_kmeans(df, 4).collect()} == found
    assert len({r.cluster for r in clustering.cluster_kmeans(df.limit(1)).collect()}) == 1


def test_knn_clusters_of_apart_groups(spark):
    """A group too large is split, one too small and far from all others goes."""
    rng = np.random.default_rng(2)
    centers = np.eye(8) * 10
    centers[2] = -5  # less than nothing in common with the others
    sizes = [30, 9, 2]
    rows, n = [], 0
    for g, size in enumerate(sizes):
        for _ in range(size):
            rows.append((n, (centers[g] + rng.normal(size=8) * 0.2).tolist()))
            n += 1
    df = spark.createDataFrame(rows, "id long, v array<double>")
    named = {r.id: r.cluster for r in clustering.cluster_knn_graph(df, k=8, drop_frac=0.0, min_size=5, max_size=15, outlier_threshold=0.5).collect()}
    of = lambda a, b: {named.get(i) for i in range(a, b)}
    assert of(39, 41) == {None} and len(of(30, 39)) == 1 and not of(0, 30) & of(30, 39)
    assert None not in of(0, 30) and len(of(0, 30)) > 1


def test_blocks_are_as_large_as_a_task_holds(spark):
    """Rows are copied once for each block: 200,000 narrow rows make 13 blocks, not 49; wide rows and small tables have blocks as before."""
    count = lambda n, dims, k: spark.range(n).select(F.array_repeat(F.lit(1.0), dims).alias("v")).agg(neighbours._blocks(None, k)).first()[0]
    assert [count(200_000, 64, 500), count(200_000, 8, 5), count(9000, 1024, 5), count(4000, 64, 5), count(30_000, 64, 5)] == [13, 13, 3, 1, 6]


def test_trigrams_are_hashed_once(monkeypatch):
    import hashlib

    asked, digest = [], hashlib.blake2b
    monkeypatch.setattr(hashlib, "blake2b", lambda *a, **k: asked.append(1) or digest(*a, **k))
    texts = ["Abc abc ABC" * 50, "é", "abcd", "İx"]
    got = models.hashed_embedder(texts, 64)
    assert len(asked) < 40
    for t, v in zip(texts, got, strict=True):
        want = np.zeros(64)
        for i in range(max(1, len(t) - 2)):
            h = int.from_bytes(digest(t[i : i + 3].lower().encode(), digest_size=8).digest(), "little")
            want[h % 64] += 1 if h >> 63 else -1
        assert v == (want / max(np.linalg.norm(want), 1e-12)).tolist()


def test_rounds_of_components_broadcast_nothing(spark):
    from tidemark.operators import components, neighbours
    from tidemark.storage import cut

    edges, _ = cut(spark.range(60).selectExpr("id as u", "id + 1 as v"), "edges")
    nodes = spark.range(61)
    plans = [components._large_star(edges), components._small_star(edges), neighbours.with_components(nodes, edges.selectExpr("u as a", "v as b"))]
    assert all("Broadcast" not in x._jdf.queryExecution().executedPlan().toString() for x in plans)
    assert plans[2].groupBy("cluster").count().collect() == [(0, 61)]


def test_annotations_hold_one_request():
    import pyarrow as pa

    asked = []
    found = models._annotate(lambda texts: asked.append(len(texts)) or [t.upper() for t in texts], "t", 256, "-", pa.string(), "a", iter([pa.record_batch({"t": [*["x"] * 300, None, " ", *["y"] * 298]})]))
    first = next(found)
    assert (asked, first.num_rows) == ([256], 256)
    rest = [first, *found]
    assert [x for b in rest for x in b.column("a").to_pylist()] == ["X"] * 300 + ["-"] * 2 + ["Y"] * 298 and asked == [256, 254, 88]
