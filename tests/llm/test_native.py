"""Sharding, chat formatting, URL verdicts and neighbours."""

from __future__ import annotations

import hashlib
import json
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from docflow.llm import ann, chat, sharding, urls
from docflow.llm.queries import PROBE_TEXT, QUERIES, URL_RULES

PYTHON_NODES = ("Python", "Pandas", "Arrow")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- sharding ----------------------------------------------------------------


def test_shards_have_exact_sizes_and_all_rows(docs, corpus):
    placed = sharding.shuffle_into_shards(docs, 7)
    assert placed.columns == [*docs.columns, "_shard", "_slot"]
    assert not any(n in plan_of(placed) for n in PYTHON_NODES)
    rows = placed.collect()
    assert Counter((r.doc_id, r.text) for r in rows) == Counter(corpus)
    slots = defaultdict(list)
    for r in rows:
        slots[r._shard].append(r._slot)
    assert sorted(map(len, slots.values())) == sorted(sharding.shard_sizes(len(corpus), 7).tolist())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_fewer_rows_than_shards(spark, nothing):
    rows = sharding.shuffle_into_shards(spark.range(3), 5).collect()
    assert sorted((r.shard, r.slot) for r in rows) == [(0, 0), (1, 0), (2, 0)]
    assert sharding.shuffle_into_shards(nothing, 5).count() == 0


def test_slots_come_from_ranges_of_the_key(spark, monkeypatch):
    monkeypatch.setattr(sharding, "RANGE_ROWS", 10)
    rows = sharding.shuffle_into_shards(spark.range(1000).repartition(3), 4).collect()
    assert sorted((r.shard, r.slot) for r in rows) == [(s, k) for s in range(4) for k in range(250)]
    # A uniform order: ids are no more often rising than falling.
    order = [r.id for r in sorted(rows, key=lambda r: (r.shard, r.slot))]
    rising = sum(a < b for a, b in zip(order, order[1:], strict=False))
    assert 420 < rising < 580


def test_matrix_sums_and_law():
    rng = np.random.default_rng(1)
    rows, room = [5, 0, 17, 8], sharding.shard_sizes(30, 4)
    cells = []
    for _ in range(2000):
        m = sharding.communication_matrix(rng, rows, room)
        assert m.sum(axis=1).tolist() == rows and m.sum(axis=0).tolist() == room.tolist()
        cells.append(m[2, 0])
    assert abs(np.mean(cells) - 17 * 8 / 30) < 0.1
    assert abs(np.var(cells) - 17 * (8 / 30) * (22 / 30) * (13 / 29)) < 0.15


def test_large_populations_follow_the_same_law(monkeypatch):
    rng = np.random.default_rng(2)
    want = rng.hypergeometric(300, 700, 200, 4000)
    monkeypatch.setattr(sharding, "POPULATION", 0)
    got = [sharding._hypergeometric(rng, 300, 700, 200) for _ in range(4000)]
    assert abs(np.mean(got) - np.mean(want)) < 0.5 and abs(np.std(got) - np.std(want)) < 0.4
    assert sharding._hypergeometric(rng, 5, 0, 3) == 3 and sharding._hypergeometric(rng, 0, 5, 3) == 0
    assert 0 <= sharding._hypergeometric(rng, 10**12, 10**12, 10**6) <= 10**6


# --- chat --------------------------------------------------------------------

RECORDS = {
    "turn": ({"role": "user", "text": "hi"}, [("user", "hi")]),
    "messages": (
        {"messages": [{"role": "system", "content": "s"}, {"role": "assistant", "content": None}], "id": 5},
        [("system", "s"), ("assistant", "")],
    ),
    "conversations": (
        {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a", "weight": 1}]},
        [("user", "q"), ("assistant", "a")],
    ),
    "instruction": (
        {"instruction": "do", "input": "it", "output": "done"}, [("user", "do\n\nit"), ("assistant", "done")],
    ),
    "prompt": (
        {"prompt": "p", "completion": "c", "system": "be good"},
        [("system", "be good"), ("user", "p"), ("assistant", "c")],
    ),
    "question": ({"question": "q", "answer": "a", "context": ""}, [("user", "q"), ("assistant", "a")]),
}


@pytest.mark.parametrize("name", RECORDS)
def test_layouts(spark, name):
    record, want = RECORDS[name]
    df = spark.createDataFrame([(1, json.dumps(record), "own")], "id long, r string, role string")
    turns = chat.canonical_turns(df.select("id", "role", F.parse_json("r").alias("r")), "r")
    assert turns.columns == ["id", "role", "layout", "position", "_role", "text"]
    rows = turns.orderBy("position").collect()
    assert [(r._role, r.text) for r in rows] == want and {r.layout for r in rows} == {name}


def test_unknown_and_mixed_layouts(spark):
    rows = ["{}", "5", '{"messages": 3}', None, '{"text": "no role"}', '{"prompt":"p","completion":"c","messages":[]}']
    df = spark.createDataFrame(list(enumerate(rows)), "id long, r string")
    got = {r.id: r for r in chat.canonical_turns(df.select("id", F.parse_json("r").alias("r")), "r").collect()
           if r.id != 5 or r.position == 0}
    assert [got[k].layout for k in range(6)] == [None] * 5 + ["prompt"]
    assert all(got[k].position is None for k in range(5))


def test_round_trip(spark):
    odd = ["", None, PROBE_TEXT, "\\", "<\\", "[[<<", chat.BEGIN + chat.MIDDLE + chat.END, "a\nb 🙂", "\\$1 <|im_end|>\n"]
    rng = random.Random(1)
    odd += ["".join(rng.choice("\\<[|]>a\n") for _ in range(12)) for _ in range(60)]
    rows = []
    for conv in (1, 2, None):
        for turn in range(150):
            rows.append((conv, turn if turn else None, rng.choice(["user", "assistant", "x\n<|", None]), rng.choice(odd)))
    rows += [(3, 0, "user", "same"), (3, 0, "user", "same"), (3, 0, "assistant", "same")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    formatted = chat.format_conversations(df, "conv_id", ["turn"])
    parsed = chat.read_back(formatted, "conv_id")
    assert not any(n in plan_of(parsed) for n in PYTHON_NODES)
    by_conv = defaultdict(list)
    for conv, turn, role, text in rows:
        by_conv[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    for r in chat.conversation_digest(parsed, "conv_id").join(
        parsed.withColumnRenamed("conv_id", "c"), F.expr("conv_id <=> c")
    ).collect():
        turns = [(role, text) for _, role, text in sorted(by_conv[r.conv_id])]
        assert [(t.role, t.text) for t in r.turns] == turns
        loss = "".join(t for role, t in turns if role == "assistant")
        assert (r.n_turns, r.loss_chars, r.formatted_chars) == (len(turns), len(loss), len(r.formatted))
        said = "".join(f"{role}\n{t}\n" for role, t in turns)
        assert r.turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        inside = r.formatted.replace(chat.BEGIN, "").replace(chat.MIDDLE, "").replace(chat.END, "")
        assert "<|" not in inside and "[INST]" not in inside and "</s>" not in inside
    assert chat.format_conversations(df.limit(0), "conv_id", ["turn"]).count() == 0


# --- urls --------------------------------------------------------------------


def plain_host(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, path = rest[:end], rest[end:]
    cut = min([path.find(c) for c in "?#" if c in path] or [len(path)])
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path[:cut]


def plain_rule(host, path):
    fits = []
    for rule, verdict in URL_RULES:
        domain, _, rest = rule.partition("/")
        if (host == domain or host.endswith("." + domain)) and path.startswith("/" + rest):
            fits.append((len(rule), verdict, rule))
    return max(fits) if fits else None


ODD_URLS = [
    None, "", "no scheme", "http://", "http:///x", "HTTP://A.Example.ORG/es/1?x", "http://example.org", "x://org/",
    "http://example.org/en/1x", "http://sub.example.org/es", "http://notorg/", "http://a.com/fr/?q=://b", "http://Ü.com/de/",
    "http://b.com#/fr/", "http://a\nb.org/y\nz?q", "http://forg/es/",
]


def test_rules(spark):
    rows = [(k, u, None, "h", "r") for k, u in enumerate(ODD_URLS * 2)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string, rule string")
    rules = spark.createDataFrame([urls.parse_rule(*r) for r in URL_RULES], urls.RULES)
    judged = urls.judge_urls(df, rules)
    assert judged.columns == [*df.columns, "_host", "path", "_rule", "verdict", "trust", "distrust"]
    assert not any(n in plan_of(judged) for n in PYTHON_NODES)
    got = judged.collect()
    assert len(got) == len(rows)
    for r in got:
        host, path = plain_host(r.url)
        best = plain_rule(host, path)
        assert (r._host, r.path) == (host, path)
        assert r._rule == (best[2] if best else None)
        assert r.verdict == best[1] if best else r.verdict in ("allow", "block")
        if not host:
            assert r.verdict == "allow" and r.trust == 0
    assert urls.judge_urls(df.limit(0), rules).count() == 0
    assert urls.judge_urls(df, rules.limit(0)).where("verdict = 'block'").count() == 0


def test_op8_verdicts_of_the_contract(spark, tmp_path):
    expected = {
        "http://a.org/x": ("org/", "allow"),
        "http://example.org/en/2": ("org/", "allow"),
        "http://example.org/es/1": ("example.org/es/", "block"),
        "http://www.example.org/en/1": ("example.org/en/1", "block"),
        "http://example.org/en/10?q": ("example.org/en/1", "block"),
        "http://a.com/fr/": ("com/fr/", "allow"),
        "http://a.com/de/": ("com/de/", "block"),
    }
    rows = [(k, url, None) for k, url in enumerate(expected)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.page_id: (r.rule, r.verdict) for r in QUERIES["op8_urls"](spark, str(tmp_path)).collect()}
    assert got == dict(enumerate(expected.values()))


def test_trust_spreads_along_links_and_distrust_against_them(spark):
    def page(host, path, *links):
        return (f"http://{host}{path}", "".join(f'<a href="http://{x}/">' for x in links) + "<a href='/own'>")

    rows = [
        page("good.org", "/a", "friend.net"), page("friend.net", "/", "far.net"), page("far.net", "/"),
        page("bad.com", "/de/x"), page("fan.net", "/", "bad.com"), page("none.net", "/"),
    ]
    df = spark.createDataFrame(rows, "url string, html string")
    rules = spark.createDataFrame([urls.parse_rule(*r) for r in URL_RULES], urls.RULES)
    got = {r.host: r for r in urls.judge_urls(df, rules).collect()}
    assert got["good.org"].trust > got["friend.net"].trust > got["far.net"].trust > 0
    assert got["fan.net"].distrust > 0 and got["fan.net"].verdict == "block"
    assert {h for h, r in got.items() if r.verdict == "block"} == {"fan.net", "bad.com"}
    assert (got["none.net"].trust, got["none.net"].distrust) == (0, 0)


def test_ranks_against_power_iteration(spark):
    rng = random.Random(5)
    n = 30
    edges = sorted({(rng.randrange(n), rng.randrange(n)) for _ in range(90)})
    edges = [(a, b) for a, b in edges if a != b]
    hosts = [(str(k), int(k % 7 == 0), int(k % 11 == 1)) for k in range(n)]
    nodes = spark.createDataFrame(hosts, "host string, allowed long, blocked long")
    links = spark.createDataFrame([(str(a), str(b), 1.0) for a, b in edges], "src string, dst string, weight double")
    got = {int(r.host): (r.trust, r.distrust) for r in urls.propagate(nodes, links).collect()}
    total = sum(a + b for _, a, b in hosts)
    good, bad = (np.array([h[k] for h in hosts]) / total for k in (1, 2))
    m = np.zeros((n, n))
    for a, b in edges:
        m[a, b] = 1
    out = m / np.maximum(m.sum(axis=1, keepdims=True), 1)
    back = m / np.maximum(m.sum(axis=0, keepdims=True), 1)
    trust, distrust = good, bad
    for _ in range(200):
        trust = 0.15 * good + 0.85 * trust @ out
        distrust = 0.15 * bad + 0.85 * back @ distrust
    for k in range(n):
        assert got[k] == pytest.approx((trust[k], distrust[k]), abs=0.02)


# --- neighbours --------------------------------------------------------------


def brute(rows, k):
    good = [(i, np.array(v, float)) for i, v in rows
            if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    want = {}
    for q, x in good:
        if q % 100 == 0:
            found = {}
            for i, y in good:
                if i != q and len(x) == len(y):
                    found[i] = min(found.get(i, np.inf), float(np.sqrt(((y - x) ** 2).sum())))
            want[q] = sorted((s, i) for i, s in found.items())[:k]
    return want


def test_neighbours(spark):
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(6, 24))
    rows = [(i, (centers[i % 6] + rng.normal(size=24) * 0.4).tolist()) for i in range(1500)]
    same = rows[7][1]
    rows += [(2000 + k, same) for k in range(40)] + [(100, rows[100][1])]
    nan, inf = float("nan"), float("inf")
    rows += [(3000, None), (3001, [0.0] * 24), (3002, [None] + [1.0] * 23), (3003, [nan] * 24), (3004, [inf] * 24),
             (3005, []), (None, same), (3100, [1.0, 2.0]), (3200, [1e200] * 24), (3300, [1e-200] * 24)]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, rank int").repartition(5)
    with np.errstate(over="ignore"):
        want = brute(rows, 10)
        got = defaultdict(list)
        for r in ann.nearest_neighbours(df, df.where("vec_id % 100 = 0")).orderBy("query_id", "rank").collect():
            assert r.rank == len(got[r.query_id]) + 1
            got[r.query_id].append((r.score, r.vec_id))
    hits = total = 0
    for q, exact in want.items():
        assert got[q] == sorted(got[q])
        hits += len({i for _, i in exact} & {i for _, i in got[q]})
        total += len(exact)
    assert set(got) <= set(want) and hits / total >= 0.9
    one = ann.nearest_neighbours(df, df.where("vec_id = 2000")).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in one] == [(i, 0.0) for i in [7, *range(2001, 2010)]]
    assert ann.nearest_neighbours(df, df.limit(0)).count() == 0
    assert ann.nearest_neighbours(df.limit(0), df.where("vec_id = 2000")).count() == 0


def test_small_tables_are_answered_in_full(spark, monkeypatch):
    """A query gets k rows, or all there are, however few its buckets hold."""
    monkeypatch.setattr(ann, "BLOCK_QUERIES", 8)
    rng = np.random.default_rng(4)
    for n in (2, 11, 30):
        ids, x = np.arange(n), rng.normal(size=(n, 64))
        rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(100, None), (101, [0.0] * 64), (102, [1.0, 2.0])]
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
        got = defaultdict(list)
        for r in ann.nearest_neighbours(df, df).orderBy("query_id", "rank").collect():
            got[r.query_id].append(r.vec_id)
        assert {q: len(found) for q, found in got.items()} == dict.fromkeys(range(n), min(10, n - 1))
        if n <= 11:
            score = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
            assert got == {q: [i for i in np.argsort(score[q]) if i != q] for q in ids}


def test_rotation_keeps_lengths():
    x = np.random.default_rng(1).normal(size=(20, 24))
    y = ann.rotated(x, 3)
    assert y.shape == (20, 32) and np.allclose(np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1))
