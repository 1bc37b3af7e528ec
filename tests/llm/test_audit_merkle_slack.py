"""Filter audit, Merkle manifest and minimum-slack packing against plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import duckdb
import pytest
from pyspark.sql import functions as F

from fabline.llm import audit, merkle, slack

from .conftest import DOC_SCHEMA, hard_documents, write

public_tokenizers = pytest.importorskip("public_tokenizers")


# 11 filter audit

def brute_audit(rows, labels):
    """rows: (doc_id, text, lang); labels: doc_id -> (quality, toxic)."""
    ids = defaultdict(list)
    for i, t, _ in rows:
        if i is not None:
            ids[t or ""].append(i)
    docs = []
    for i, t, lang in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {f for f, bad in zip("ABCDE", (
            len(words) < 100, 100 * len(set(words)) < 80 * len(words), 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            bool(re.search("[#$%&*|]", t)), i is not None and any(j < i for j in ids[t]))) if bad}
        docs.append((lang or "", fails, *labels.get(i, (0, 0))))
    out = {}
    for part in {d[0] for d in docs}:
        for order in map("".join, permutations("ABCDE")):
            kept = [d for d in docs if d[0] == part]
            everyone = kept
            for step, f in enumerate(order, 1):
                gone = [d for d in kept if f in d[1]]
                kept = [d for d in kept if f not in d[1]]
                out[part, order, step] = [len(kept), len(gone), sum(f in d[1] for d in everyone) - len(gone), sum(d[1] == {f} for d in everyone),
                                          sum(d[2] == 1 for d in gone), sum(d[3] == 1 for d in gone)]
    total = defaultdict(int)
    for (part, order, step), v in out.items():
        total[part, order[step - 1]] += v[1]
    return {k: (*v, total[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def audited(df):
    return {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in df.collect()}


def audit_rows():
    rows = [(i, t, lang) for i, t, lang, _ in hard_documents()]
    return rows + [(200 + i, "AB $ cd", ["en", "de", None, ""][i % 4]) for i in range(8)] + [(3, "AB $ cd", "en"), (3, "AB $ cd", "de"), (None, "AB $ cd", "en")]


LABELS = {4: (1, 0), 3: (1, 1), 100: (1, 1), 101: (0, 1), 205: (1, 1), 121: (0, 0)}


def land(spark, rows, folder, parts):
    """``parts`` files, written one after the other, larger ids first: later files take earlier rows back."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    n = -(-len(order) // parts)
    for k in range(0, len(order), n):
        df = spark.createDataFrame([(*r, "x", "y") for r in order[k:k + n]], "doc_id long, text string, lang string, id string, key string")
        df.coalesce(1).write.mode("append").parquet(folder)


def label_table(spark):
    rows = [(i, q, t) for i, (q, t) in LABELS.items()] + [(100, 0, 0), (None, 1, 1), (999, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("files, batches", [(7, 7), (7, 3), (1, 1)])
def test_audit_equals_brute_force_whatever_the_batches(spark, tmp_path, files, batches):
    path = str(tmp_path / "documents.parquet")
    land(spark, audit_rows(), path, files)
    got = audited(audit.filter_audit(spark, path, label_table(spark), batches, str(tmp_path / "run")))
    assert got == brute_audit(audit_rows(), LABELS)
    assert len(list((tmp_path / "run" / "changes").iterdir())) == min(batches, files)


# r04 F1
def test_labels_are_not_sent_through_the_driver(spark, tmp_path):
    """Stored labels look small and one row an id, the join takes them ``SPREAD`` times; many rows of one id meet its label in several places."""
    spark.range(2000).selectExpr("id AS doc_id", "1 AS quality", "cast(id % 2 AS int) AS toxic").write.parquet(str(tmp_path / "labels"))
    flags = audit.cut(audit.label_flags(spark.read.parquet(str(tmp_path / "labels"))))
    rows = spark.range(500).selectExpr("5 AS id", "cast(id % 3 AS string) AS part", "0 AS mask", "cast(cast(id AS string) AS binary) AS key")
    rows = rows.unionByName(spark.createDataFrame([(7777, "a", 1, b"k"), (None, "a", 1, b"k"), (4, "a", 1, b"k")], "id int, part string, mask int, key binary"))
    got = audit._labelled(rows.withColumn("id", F.col("id").cast("bigint")), flags)
    assert "BroadcastExchange" not in got._jdf.queryExecution().executedPlan().toString()
    found = got.collect()
    assert len(found) == 503 and {(r.id, r.good, r.toxic) for r in found} == {(5, True, True), (7777, False, False), (None, False, False), (4, True, False)}


def test_audit_takes_back_and_goes_on_after_a_restart(spark, tmp_path):
    path, run = str(tmp_path / "documents.parquet"), str(tmp_path / "run")
    rows = sorted(audit_rows(), key=lambda r: (r[0] is None, -(r[0] or 0)))
    land(spark, rows[:40], path, 2)
    assert audited(audit.filter_audit(spark, path, label_table(spark), 2, run)) == brute_audit(rows[:40], LABELS)
    land(spark, rows[40:], path, 3)
    assert audited(audit.filter_audit(spark, path, label_table(spark), 2, run)) == brute_audit(rows, LABELS)
    changes = spark.read.parquet(*[str(p) for p in (tmp_path / "run" / "changes").iterdir()])
    assert changes.where("n < 0").count() > 0
    assert audited(audit.filter_audit(spark, path, label_table(spark), 2, run)) == brute_audit(rows, LABELS)  # nothing new


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    """A batch that stopped between its two tables and its commit runs again over its own folders."""
    path, run = str(tmp_path / "documents.parquet"), tmp_path / "run"
    land(spark, audit_rows(), path, 4)
    want = audited(audit.filter_audit(spark, path, label_table(spark), 4, str(run)))
    last = max(int(p.name) for p in (run / "progress" / "commits").iterdir() if p.name.isdigit())
    (run / "progress" / "commits" / str(last)).unlink()
    (run / "progress" / "commits" / f".{last}.crc").unlink(missing_ok=True)
    assert audited(audit.filter_audit(spark, path, label_table(spark), 4, str(run))) == want


def test_audit_of_no_documents_and_one_file(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string").write.parquet(str(tmp_path / "none.parquet"))
    assert audit.filter_audit(spark, str(tmp_path / "none.parquet"), label_table(spark)).collect() == []
    land(spark, audit_rows(), str(tmp_path / "t"), 1)
    (file,) = [p for p in (tmp_path / "t").iterdir() if p.suffix == ".parquet"]
    got = audited(audit.filter_audit(spark, str(file), label_table(spark).limit(0)))
    assert got == brute_audit(audit_rows(), {})


# 12 Merkle manifest

def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_tree(nodes):
    """(top, proof of every node as a list of (left, right))."""
    paths, at, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        for i, a in enumerate(at):
            run = level[a // 16 * 16:a // 16 * 16 + 16]
            paths[i].append(("".join(run[:a % 16]), "".join(run[a % 16 + 1:])))
        level = [h(*level[k:k + 16]) for k in range(0, len(level), 16)]
        at = [a // 16 for a in at]
    return (level or [None])[0], paths


def brute_manifest(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    def leaf(*v):
        return h(*("-" if x is None else f"{len(str(x).encode())}:{x}" for x in v))

    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    leaves = defaultdict(list)
    for i, s, lang, n, t in rows:
        hit = i is not None and zlib.crc32(str(i).encode()) % 5 == 0
        leaves[s].append(((i is not None, i or 0), leaf(i, s, lang, n, t), i, leaf(i, s, lang, n, t.translate(lower) if hit and t is not None else t)))
    names = sorted(leaves, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        leaves[s].sort()
        trees[s] = brute_tree([x[1] for x in leaves[s]])
    root, above = brute_tree([trees[s][0] for s in names])
    out = Counter()
    for s, up in zip(names, above):
        for (_, node, i, changed), path in zip(leaves[s], trees[s][1]):
            fold = changed
            for left, right in path + up:
                fold = h(left, fold, right)
            out[i, node, trees[s][0], root, h(*(x + y for x, y in path + up)), fold, fold == root] += 1
    return out


def manifest_rows(n, sources, seed=1):
    r = random.Random(seed)
    rows = [(i, r.choice(sources), r.choice(["en", None]), r.choice([None, 5]), r.choice([None, "", "Ab", "xY é", "low"])) for i in range(n)]
    return rows + rows[:3] + [(None, sources[0], None, 1, "Q"), (None, sources[0], None, 1, "Q"), (None, None, None, None, None)]


MANIFEST = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


@pytest.mark.parametrize("n, sources", [(700, ["hot"] * 30 + ["b", None, "é", "z"]), (60, [f"s{k}" for k in range(40)]), (5, ["only"]), (4500, ["all"])])
def test_manifest_equals_brute_force(spark, tmp_path, n, sources):
    rows = manifest_rows(n, sources)
    docs = write(spark, tmp_path, rows, "doc_id long, source string, lang string, n_chars long, text string")
    got = Counter(tuple(r) for r in merkle.document_manifest(docs).select(*MANIFEST).collect())
    want = brute_manifest(rows)
    assert got == want
    assert n < 50 or {v[-1] for v in want} == {True, False}


def test_manifest_sql_and_empty_table(spark, tmp_path):
    rows = [(i, s, lang, n, t) for i, s, lang, n, t in manifest_rows(900, ["a", "b", "c"]) if i is not None or s is None]
    docs = write(spark, tmp_path, rows, "doc_id long, source string, lang string, n_chars long, text string")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/t.parquet/*.parquet'")
    want = Counter(con.sql(f"SELECT {', '.join(MANIFEST)} FROM ({merkle.ORACLE})").fetchall())
    assert Counter(tuple(r) for r in merkle.document_manifest(docs).select(*MANIFEST).collect()) == want
    assert merkle.document_manifest(docs.where("false")).collect() == []


def test_positions_split_a_group_of_equal_rows(spark):
    rows = spark.createDataFrame([("hot", 1)] * 500 + [(None, 2)] * 3 + [("b", k) for k in range(7)], "g string, v long").repartition(4)
    got = defaultdict(list)
    for r in merkle.positions(rows, "g", ["v"]).collect():
        got[r.g].append((r.pos, r.m, r.v))
    assert {g: sorted(p for p, _, _ in v) for g, v in got.items()} == {"hot": list(range(500)), None: [0, 1, 2], "b": list(range(7))}
    assert all(m == len(v) for v in got.values() for _, m, _ in v) and sorted(got["b"])[3][2] == 3


# 13 packing by minimum slack

def check_plan(counts, size):
    runs, sequences = slack.plan(dict(counts), size)
    cover, spots = Counter(), defaultdict(list)
    for origin, inner, length, first, n, sequence, each, phase, base in runs:
        for i in range(n):
            j = i + phase
            cover[origin, first + i, inner] += length
            spots[sequence + j // each].append((base + j % each * length, length))
    assert len(spots) == sequences
    whole = defaultdict(list)
    for (origin, rank, inner), length in cover.items():
        whole[origin, rank].append((inner, length))
    assert {(o, k) for o, n in counts.items() for k in range(n)} == set(whole)
    for (origin, _), parts in whole.items():
        at = 0
        for inner, length in sorted(parts):
            assert inner == at
            at += length
        assert at == origin
    for parts in spots.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size and (at == size or at & (at - 1) == 0)  # no padding
    return runs


@pytest.mark.parametrize("counts", [{}, {1: 1}, {1: 5}, {7: 1}, {63: 40}, {33: 100}, {32: 3}, {40: 50, 24: 50}, {n: 3 for n in range(1, 64)}, {50: 1000, 3: 7}])
def test_plan_places_every_piece_once_without_padding(counts):
    check_plan(counts, 64)


def test_plan_of_random_histograms():
    r = random.Random(2)
    for _ in range(30):
        size = 1 << r.randint(1, 8)
        check_plan(Counter(r.randint(1, size - 1) for _ in range(r.randint(0, 300))), size)


def test_plan_grows_with_the_window_not_with_the_documents():
    r = random.Random(3)
    small = {n: r.randint(1, 50) for n in range(1, 256)}
    a, b = len(slack.plan(dict(small), 256)[0]), len(slack.plan({n: k * 1_000_000 for n, k in small.items()}, 256)[0])
    assert b < 20 * a


def test_best_fill_is_closest():
    r = random.Random(4)
    for _ in range(200):
        left = {r.randint(1, 30): r.randint(1, 3) for _ in range(r.randint(0, 5))}
        cap = r.randint(0, 60)
        sums = {0}
        for n, k in left.items():
            sums = {s + j * n for s in sums for j in range(k + 1) if s + j * n <= cap}
        used = slack.best_fill(left, cap)
        assert sum(n * k for n, k in used.items()) == max(sums) and all(0 < k <= left[n] for n, k in used.items())


def test_exact_fills_cut_nothing():
    runs = check_plan({40: 500, 24: 500, 10: 30, 54: 30}, 64)
    assert all(length == origin for origin, _, length, *_ in runs)


@pytest.mark.parametrize("size", [1024, 64])
def test_documents_are_packed_whole_and_gapless(docs, size):
    import numpy as np
    from tokenizers import Tokenizer

    file = public_tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(file)
    rows = slack.pack_documents(docs, file, size, 0, rank_file=public_tokenizers.path("byte_bpe_50k.tiktoken")).collect()
    ids = [(r[0], tok.encode(r[1] or "", add_special_tokens=False).ids + [0]) for r in hard_documents()]
    want = Counter((i, len(x)) for i, x in ids)
    assert Counter((r.doc_id, r.doc_tokens) for r in rows if r.start == 0) == want
    of = defaultdict(list)
    for i, x in ids:
        of[i, len(x)].append(x)
    tokens = Counter()
    for r in rows:
        tokens[r.doc_id, r.doc_tokens] += r.length
        assert any(zlib.crc32(np.array(x[r.start:r.start + r.length], "<u4").tobytes()) == r.ids_crc32 for x in of[r.doc_id, r.doc_tokens])
    assert tokens == Counter({k: k[1] * n for k, n in want.items()})
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size and at & (at - 1) == 0
    assert slack.pack_documents(docs.where("false"), file, size).collect() == []


def test_rank_file_and_tokenizer_agree():
    ids = slack.TextIds(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    slow = slack.TextIds(public_tokenizers.path("byte_bpe_50k.json"))
    r = random.Random(6)
    texts = ["".join(chr(r.choice([r.randint(0, 0x24F), r.randint(0, 0x300), 32, 32, 10, 9, 97, 98, 0xA0, 39, 115])) for _ in range(r.randint(0, 40)))
             for _ in range(3000)] + [" " * 50_000, "x" * 20_000, "a  b" * 9, "<|endoftext|> x", "日本 🎉"]
    assert all(ids.of(t).tolist() == slow.of(t).tolist() for t in texts)
