"""Searches, URL filter, registered queries and the pipeline on small tables."""

import math
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from fabline.llm import hnsw, queries, topk, urls
from fabline.llm.common import components

from .conftest import write

SF = "/root/testdata/sf0.001"


def vectors(n=240, dims=12):
    r = np.random.default_rng(8)
    x = (r.normal(size=(n, dims)) * r.uniform(0.2, 3, (n, 1))).astype(np.float32).tolist()
    rows = [(i, v) for i, v in enumerate(x)]
    rows += [(1000 + i, x[20]) for i in range(60)]  # copies of one vector
    rows += [(2000, None), (2020, [0.0] * dims), (2040, [float("nan")] * dims), (2060, [float("inf")] + [0.0] * (dims - 1)),
             (2080, [None] + [1.0] * (dims - 1)), (2100, [1.0, 2.0]), (2101, [3.0, 1.0]), (2120, []), (None, x[3]), (40, x[5])]
    return rows


def usable(v):
    return v is not None and all(a is not None and math.isfinite(a) for a in v)


def brute(rows, every, k, score, ok):
    out = Counter()
    rows = [(i, v) for i, v in rows if usable(v) and ok(i, v)]
    for a, (q, v) in enumerate(rows):
        if q is None or q % every:
            continue
        found = [(-score(v, w), i is None, i or 0, i) for b, (i, w) in enumerate(rows) if b != a and len(w) == len(v)]
        for rank, (s, _, _, i) in enumerate(sorted(found)[:k], 1):
            out[q, rank, i, -s] += 1
    return out


def test_exact_top_k(spark, tmp_path):
    df = write(spark, tmp_path, vectors(), "vec_id long, embedding array<float>")
    whole = lambda v: [math.floor(256 * float(a)) for a in v]
    want = brute(vectors(), 20, 5, lambda a, b: sum(x * y for x, y in zip(whole(a), whole(b))), lambda i, v: True)
    got = Counter(tuple(r) for r in topk.top_k(df, every=20, least_shards=3).collect())
    assert got == want


def test_top_k_beyond_exact_doubles():
    r = np.random.default_rng(1)
    x = r.integers(-(1 << 40), 1 << 40, (50, 8))
    table = topk.Vertical(x, np.arange(50), np.arange(50), step=3)
    at, scores = table.top(x[7], 7, 5)
    want = sorted((max(-(1 << 63), min((1 << 63) - 1, sum(int(a) * int(b) for a, b in zip(x[7], v)))), -i) for i, v in enumerate(x) if i != 7)[::-1][:5]
    assert list(zip(scores, (-at).tolist())) == want


def test_hnsw(spark, tmp_path):
    df = write(spark, tmp_path, vectors(), "vec_id long, embedding array<float>")
    rows = [(i, v) for i, v in vectors() if i is not None]
    dot = lambda a, b: float(np.dot(np.float64(a), np.float64(b)))
    want = brute(rows, 20, 20, dot, lambda i, v: any(v))
    got = hnsw.nearest(df, least_shards=2).collect()
    by = defaultdict(list)
    for r in got:
        by[r.query_id].append(r)
    near = defaultdict(list)
    for (q, rank, i, s), n in want.items():
        near[q] += [(rank, i, s)] * n
    assert set(by) == set(near) and len(got) == sum(want.values())
    hits = sum(len(set(r.vec_id for r in by[q]) & {i for _, i, _ in near[q]}) for q in by)
    assert hits >= 0.95 * sum(len({i for _, i, _ in v}) for v in near.values())
    for q, found in by.items():
        if q != 40:  # one id, two rows
            assert [r.rank for r in found] == list(range(1, len(found) + 1)) or sorted(r.rank for r in found) == list(range(1, len(found) + 1))
            assert all(r.vec_id != q for r in found)


def test_hnsw_recall_on_the_tables(spark):
    got = queries.op2_hnsw(spark, "/root/testdata/sf0.01").collect()
    v = duckdb.sql("SELECT vec_id, embedding FROM read_parquet('/root/testdata/sf0.01/embeddings.parquet') ORDER BY 1").fetchall()
    ids, x = np.array([r[0] for r in v]), np.array([r[1] for r in v], dtype=np.float64)
    hit = 0
    for r in got:
        s = x @ x[ids == r.query_id][0]
        s[ids == r.query_id] = -np.inf
        hit += s[ids == r.vec_id][0] >= np.sort(s)[-20] - 1e-12
    assert hit / len(got) >= 0.9


def hard_vectors(kind, n, dims=64):
    r = np.random.default_rng(11)
    if kind == "clustered":
        return r.normal(size=(40, dims))[r.integers(0, 40, n)] + 0.3 * r.normal(size=(n, dims))
    return r.normal(size=(n, dims)) * (r.uniform(0.2, 3, (n, 1)) if kind == "lengths" else 1)


@pytest.mark.parametrize("kind", ["gauss", "lengths", "clustered"])
def test_one_graph_is_walked_and_finds_nine_in_ten(kind):
    """One shard of 4,000 vectors: the beam adapts until recall holds and stays narrower than the graph."""
    x = hard_vectors(kind, 4000)
    graph = hnsw.Graph(x)
    beam = graph.width_for(0.97, 21, 64)
    assert beam < len(x)
    asked = x[::40] + 0.01 * np.random.default_rng(5).normal(size=(100, 64))
    hits = 0
    for q, found in zip(asked, graph.search(asked, 21, beam)):
        hits += len(set(found[np.argsort(-(x[found] @ q))[:20]]) & set(np.argsort(-(x @ q))[:20]))
    assert hits >= 0.9 * 20 * len(asked)


def test_small_graphs_are_walked_too():
    graph = hnsw.Graph(hard_vectors("gauss", 100))
    entries = []
    beam = graph._beam
    graph._beam = lambda q, near, entry, ef: entries.append(entry.shape[1]) or beam(q, near, entry, ef)
    graph.search(hard_vectors("gauss", 5), 5, 64)
    assert max(entries) <= 6


def test_hnsw_in_one_shard_against_brute_force(spark, tmp_path):
    x = hard_vectors("lengths", 1500, 32)
    df = write(spark, tmp_path, [(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    got = hnsw.nearest(df, least_shards=1).collect()
    hits = 0
    for r in got:
        s = x @ x[r.query_id]
        s[r.query_id] = -np.inf
        hits += s[r.vec_id] >= np.sort(s)[-20]
    assert len(got) == 75 * 20 and hits >= 0.9 * len(got)


def test_empty_vectors(spark, tmp_path):
    df = write(spark, tmp_path, [], "vec_id long, embedding array<float>")
    assert topk.top_k(df).count() == 0 and hnsw.nearest(df).count() == 0


PAGES = [(1, "http://A.B.example.NET/en/1"), (2, "https://x.net/a/b"), (3, "http://example.com/de/7?x"), (4, "http://sub.example.com/en/7#t"),
         (5, "x.org/fr/1"), (6, None), (7, ""), (8, "http://y.org/fr/9.html"), (9, "http://y.org"), (10, "http://net"), (11, "http://net/"),
         (12, "ftp://Ä.org/fr/"), (13, "http://a://b.net/x"), (14, "http://h.de//a///b/c/d/e/f"), (None, "http://x.net/"), (2, "https://x.net/a/b")]


def test_url_rules(spark, tmp_path):
    df = write(spark, tmp_path, PAGES, "page_id long, url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge(df).collect()}
    assert got[1] == ("a.b.example.net", "/en/1", "example.net/en/", "allow")
    assert got[2] == ("x.net", "/a/b", "net/", "block")
    assert got[3] == ("example.com", "/de/7", "example.com/de/", "block")
    assert got[4][:3] == ("sub.example.com", "/en/7", None)
    assert got[5][:3] == got[6][:3] == got[7][:3] == ("", "", None)
    assert got[8] == ("y.org", "/fr/9.html", "org/fr/", "allow")
    assert got[10] == ("net", "", None, "allow") and got[11] == ("net", "/", "net/", "block")
    assert got[12][:3] == ("Ä.org", "/fr/", "org/fr/")
    assert got[13][:2] == ("a:", "//b.net/x")
    assert len(urls.judge(df).collect()) == len(PAGES)
    assert urls.judge(write(spark, tmp_path, [], "page_id long, url string", "none")).count() == 0


def section(first, host, name, n, bad):
    return [(first + i, f"http://{host}/{name}/{first + i}") for i in range(n)], [(first + i, 0, int(bad(i))) for i in range(n)]


def verdicts(spark, tmp_path, sections, name):
    pages = [p for ps, _ in sections for p in ps]
    labels = spark.createDataFrame([x for _, ls in sections for x in ls], "doc_id long, quality int, toxic int")
    df = write(spark, tmp_path, pages, "page_id long, url string", name)
    return {r.path: r.verdict for r in urls.judge(df, labels).collect()}


def test_a_bad_section_is_blocked_whatever_the_size_of_its_host(spark, tmp_path):
    small = [section(0, "h.de", "bad", 30, lambda i: True)]
    large = small + [section(1000 + 30 * k, "h.de", f"s{k}", 30, lambda i: False) for k in range(99)]
    for name, sections in (("small", small), ("large", large)):
        got = verdicts(spark, tmp_path, sections, name)
        assert {v for p, v in got.items() if p.startswith("/bad/")} == {"block"}
        assert {v for p, v in got.items() if not p.startswith("/bad/")} <= {"allow"}


def test_rates_do_not_chain(spark, tmp_path):
    """Eleven sections from no bad pages to bad ones only: the ends are judged by themselves."""
    got = verdicts(spark, tmp_path, [section(100 * k, "h.de", f"s{k}", 10, lambda i, k=k: i < k) for k in range(11)], "chain")
    of = lambda k: {v for p, v in got.items() if p.startswith(f"/s{k}/")}
    assert of(0) == of(1) == {"allow"} and of(9) == of(10) == {"block"}


def test_paths_are_told_apart_at_any_depth(spark, tmp_path):
    deep = "/".join("abcdefgh")
    got = verdicts(spark, tmp_path, [section(0, "h.de", f"{deep}/x", 10, lambda i: True), section(100, "h.de", f"{deep}/y", 10, lambda i: False)], "deep")
    assert {v for p, v in got.items() if "/x/" in p} == {"block"} and {v for p, v in got.items() if "/y/" in p} == {"allow"}


def test_url_templates_follow_labels(spark, tmp_path):
    pages = [(i, f"http://h.com/spam/{i}.html") for i in range(40)] + [(100 + i, f"http://h.com/news/{i}") for i in range(40)]
    df = write(spark, tmp_path, pages, "page_id long, url string")
    labels = spark.createDataFrame([(i, 1, 1) for i in range(20)], "doc_id long, quality int, toxic int")
    fit = urls.judge(df.where("page_id < 100"), labels)
    assert {(r.template, r.verdict) for r in fit.collect()} == {("/spam/*", "block")}
    news = urls.judge(df.where("page_id >= 100"))
    assert {(r.template, r.verdict) for r in news.collect()} == {("/news/*", "allow")}


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 101), (101, 100), (5, 5), (200, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(31)}, 200: 0, 100: 100, 101: 100}


def test_components_of_long_chains(spark):
    r = np.random.default_rng(5)
    names = r.permutation(3001).tolist()
    edges = list(zip(names, names[1:])) + [(5000 + i, 9000) for i in range(300)] + [(9000, 9001), (9001, 9002)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(3001)}, **{5000 + i: 5000 for i in range(300)}, **{9000 + i: 5000 for i in range(3)}}
    assert components(spark.createDataFrame([(1, 1)], "a long, b long")).collect() == []


def _norm(v):
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_queries_match_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df, res = queries.QUERIES[name](spark, SF), con.execute(queries.ORACLE[name])
    cols = [c[0] for c in res.description]
    assert sorted(cols) == sorted(df.columns)
    assert Counter(tuple(map(_norm, r)) for r in df.select(*cols).collect()) == Counter(tuple(map(_norm, r)) for r in res.fetchall())


def test_pipeline_stages(spark, docs, tmp_path):
    """Each stage keeps what its operator decides, on hard documents, and returns the columns of its input."""
    kept, ids = docs, []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, kept, "").write.parquet(f"{tmp_path}/{k}")
        after = spark.read.parquet(f"{tmp_path}/{k}")
        if k + 1 < len(corpus_pipeline.STAGES):
            assert after.columns == docs.columns
        ids.append([r.doc_id for r in after.collect()])
        kept = after
    start = Counter(r.doc_id for r in docs.collect())
    assert set(start) - set(ids[0]) <= {121, 122, 123, 124, None, 125, 126, 127}
    assert not Counter(ids[0]) - start and not Counter(ids[1]) - Counter(ids[0])
    assert max(Counter(ids[1]).values()) == 1 and set(ids[2]) <= set(ids[1])
    assert set(ids[3]) <= set(ids[2]) and max(Counter(ids[3]).values()) <= 4
    assert set(ids[4]) == set(ids[3])


def test_pipeline_query(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
    assert set(corpus_pipeline.QUERIES) == {"pipeline"} and len(corpus_pipeline.STAGES) == 5
