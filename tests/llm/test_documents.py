"""Operators on documents against plain Python on a small table of hard cases."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from fabline.llm import langid, mixing, packing, paragraphs, simhash, suffix, token_count

from .conftest import hard_documents, write

public_tokenizers = pytest.importorskip("public_tokenizers")
WORD = rb"[^\x20\x09-\x0D]+"


def raw(t):
    return (t or "").encode()


def rows_of(df, *cols):
    return Counter(tuple(r) for r in df.select(*cols).collect())


# 1 suffix sort

def brute_repeats(texts, length=200):
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = True
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((len(t), int(gone.sum()), int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("group, piece", [(256, 1 << 19), (2, 1000)])
def test_repeats_equal_brute_force(docs, monkeypatch, group, piece):
    monkeypatch.setattr(suffix, "GROUP", group)
    monkeypatch.setattr(suffix, "PIECE", piece)
    rows = hard_documents()
    want = Counter((r[0], *w) for r, w in zip(rows, brute_repeats([raw(r[1]) for r in rows])))
    assert rows_of(suffix.remove_repeats(docs), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == want


def test_pieces_cover_every_window_once(monkeypatch):
    monkeypatch.setattr(suffix, "PIECE", 300)
    texts = [b"a" * 1000, b"", b"b" * 199, b"c" * 500, b"d" * 499]
    seen = Counter((i, lo + k) for g in suffix.pieces(texts) for i, lo, p in g for k in range(len(p) - 199))
    assert seen == Counter((i, k) for i, t in enumerate(texts) for k in range(len(t) - 199))


def test_suffix_sort_orders_suffixes():
    r = np.random.default_rng(2)
    data = r.integers(97, 99, 3000).astype(np.uint8)
    data[1500:2500] = data[200:1200]
    at = r.permutation(2000)[:700]
    cls = r.integers(0, 3, 700)
    order, equal = suffix.suffix_sort(data, at, cls, 120)
    keys = [(cls[i], data[at[i]:at[i] + 120].tobytes()) for i in order]
    assert keys == sorted(keys)
    assert equal.tolist() == [False] + [a == b for a, b in zip(keys, keys[1:])]


def test_texts_without_repeats(docs):
    out = suffix.without_repeats(docs)
    assert out.columns == docs.columns
    want = {r[0]: w[3] for r, w in zip(hard_documents(), brute_repeats([raw(r[1]) for r in hard_documents()])) if r[0] is not None}
    got = {r.doc_id: r.text for r in out.collect()}
    ascii_only = [i for i, t in got.items() if i is not None and t and t.isascii()]
    assert len(ascii_only) > 20 and all(hashlib.sha256(got[i].encode()).hexdigest() == want[i] for i in ascii_only)
    assert got[121] is None and got[122] == ""


# 3 mixing

def test_mix_meets_targets(docs):
    out = mixing.mix(docs)
    rows = out.collect()
    assert len(rows) == len(hard_documents())
    size = Counter()
    for _, t, _, s in hard_documents():
        size[s] += len(re.findall(WORD, raw(t)))
    order = sorted(size, key=lambda s: (s is None, raw(s)))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    target, full = {}, set()
    while True:  # reshare until none is above its limit
        left = sum(size.values()) - sum(3 * size[s] for s in full)
        total = sum(weight[s] for s in order if s not in full)
        target = {s: 3 * size[s] if s in full else weight[s] * left / total for s in order}
        above = {s for s in order if s not in full and target[s] > 3 * size[s]}
        if not above:
            break
        full |= above
    taken = Counter()
    for r in rows:
        assert r.source_size == size[r.source] and r.target == pytest.approx(target[r.source])
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    assert all(taken[s] == int(target[s] + 1e-9) for s in order)
    assert rows_of(out, "doc_id", "size", "taken") == rows_of(mixing.mix(docs), "doc_id", "size", "taken")


def test_mixed_documents_repeat_rows(docs):
    took = {}
    for r in mixing.mix(docs).collect():
        if r.size:
            took.setdefault(r.doc_id, []).append(r.taken / r.size)
    got = Counter(r.doc_id for r in mixing.mixed_documents(docs).collect())
    assert mixing.mixed_documents(docs).columns == docs.columns
    for i, t in took.items():
        if len(t) == 1:
            assert abs(got[i] - t[0]) <= 0.5
    assert 121 not in got and 122 not in got


# 5 SimHash

def brute_fingerprint(t):
    import xxhash

    w = re.findall(WORD, raw(t).translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))))
    s = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(codes, ids, limit=3):
    comp = list(range(len(codes)))
    for _ in codes:
        new = [min(comp[j] for j in range(len(codes)) if bin(codes[i] ^ codes[j]).count("1") <= limit) for i in range(len(codes))]
        if new == comp:
            break
        comp = new
    return [min((ids[j] for j in range(len(codes)) if comp[j] == comp[i] and ids[j] is not None), default=None) for i in range(len(codes))]


@pytest.mark.parametrize("chunk", [4096, 2])
def test_simhash_components(docs, monkeypatch, chunk):
    monkeypatch.setattr(simhash, "CHUNK", chunk)
    rows = hard_documents()
    codes = [brute_fingerprint(r[1]) for r in rows]
    comp = brute_components(codes, [r[0] for r in rows])
    want = Counter((r[0], f"{c:016x}", k) for r, c, k in zip(rows, codes, comp))
    assert rows_of(simhash.near_duplicates(docs), "doc_id", "fingerprint", "component_id") == want


def test_gray_index_finds_all_neighbours():
    r = np.random.default_rng(4)
    base = r.integers(0, 1 << 63, 3, dtype=np.uint64)
    one = np.uint64(1)
    codes = np.unique(base[r.integers(0, 3, 900)] ^ (one << r.integers(0, 64, 900).astype(np.uint64)) ^ (one << r.integers(0, 64, 900).astype(np.uint64)))
    index = simhash.GrayIndex(codes)
    q, m = index.within(index.codes, 3)
    want = {(i, int(j)) for i, c in enumerate(index.codes) for j in np.flatnonzero(np.bitwise_count(index.codes ^ c) <= 3)}
    assert set(zip(q.tolist(), m.tolist())) == want


def test_one_of_each_component_stays(docs):
    out = simhash.one_of_each(docs)
    assert out.columns == docs.columns
    kept = [r.doc_id for r in out.collect()]
    roots = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()}
    assert Counter(roots[i] for i in kept) == Counter(set(roots.values()))
    assert kept.count(7) <= 1 and 4 in kept and not set(range(100, 109)) & set(kept)


# 6 token counts

def test_token_counts_equal_library(docs):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = Counter((r[0], len(raw(r[1])), n := len(sp.encode(r[1] or "")), n > 50) for r in hard_documents())
    got = token_count.token_counts(docs, public_tokenizers.path("piece_bpe_32k.model"), limit=50)
    assert rows_of(got, "doc_id", "n_bytes", "n_tokens", "over_limit") == want


def test_token_counts_of_odd_texts():
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    sp, own = sentencepiece.SentencePieceProcessor(model_file=path), token_count.RankMerger(path, cache_words=8)
    texts = ["", " ", "  ", "\n", "\na", " \n b", "a\n\n\nb ", "▁x ▁", "x" * 5000, "ab" * 9000 + " c", "<s> <0x41>", "\t\ta  b", "." * 900, "\x00a", "é🎉"]
    assert own.count_texts(texts) == [len(sp.encode(t)) for t in texts]


# 8 packing

def best_fit_bins(lengths, size):
    bins = []
    for n in sorted(lengths, reverse=True):
        room = [b for b in range(len(bins)) if bins[b] >= n]
        if room:
            bins[min(room, key=lambda b: bins[b])] -= n
        else:
            bins.append(size - n)
    return len(bins)


def test_packing(docs):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    want, lengths = Counter(), []
    for i, t, _, _ in hard_documents():
        ids = tok.encode(t or "", add_special_tokens=False).ids + [2]
        at, k = 0, 0
        while at < len(ids):
            upto = at + ((len(ids) - at - 1) % 256 + 1)
            want[i, k, at, upto - at, zlib.crc32(np.array(ids[at:upto], dtype="<u4").tobytes())] += 1
            lengths.append(upto - at)
            at, k = upto, k + 1
    out = packing.pack_documents(docs, path, 256, rank_file=public_tokenizers.path("byte_bpe_50k.tiktoken"))
    assert rows_of(out, "doc_id", "piece", "start", "length", "ids_crc32") == want
    bins = defaultdict(list)
    for r in out.collect():
        bins[r.sequence_id].append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, n in sorted(b):
            assert offset == at
            at += n
        assert at <= 256
    assert len(bins) == best_fit_bins(lengths, 256)


def test_capacity_tree():
    tree = packing.CapacityTree(10)
    for c in (3, 7, 7, 10):
        tree.add(c, 1)
    assert [tree.tightest(n) for n in (1, 3, 4, 7, 8, 10)] == [3, 3, 7, 7, 10, 10]
    tree.add(10, -1)
    assert tree.tightest(8) is None


# 9 paragraphs

def word_lists():
    return [raw(r[1]).lower().split() for r in hard_documents()]


def test_long_passages_are_found_and_clean_documents_left(docs):
    words = word_lists()
    ids = [r[0] for r in hard_documents()]
    seen = defaultdict(set)
    for k, w in enumerate(words):
        for i in range(len(w) - 49):
            seen[tuple(w[i:i + 50])].add(k)
    short = defaultdict(set)
    for k, w in enumerate(words):
        for i in range(len(w) - 15):
            short[tuple(w[i:i + 16])].add((k, i))
    must = {ids[k] for s in seen.values() if len(s) > 1 for k in s}
    may = {ids[k] for s in short.values() if len(s) > 1 for k, _ in s}
    rows = paragraphs.repeated_paragraphs(docs).collect()
    got = {r.doc_id for r in rows}
    lines = {r.doc_id for r in rows if r.kind == "line"}
    assert must and must <= got and got - lines <= may
    kept = Counter((r.kind, r.component) for r in rows if not r.removed)
    assert set(kept) == {(r.kind, r.component) for r in rows} and set(kept.values()) == {1}


@pytest.mark.parametrize("chunk", [256, 2])
def test_similar_lines_form_classes(spark, tmp_path, monkeypatch, chunk):
    monkeypatch.setattr(paragraphs, "CHUNK", chunk)
    import random

    r = random.Random(9)
    base = [[f"w{r.randint(0, 10**6)}" for _ in range(80)] for _ in range(4)]
    texts = []
    for i in range(40):
        w = list(base[i % 4])
        for _ in range(r.randint(0, 2)):
            w[r.randrange(80)] = f"z{i}"
        texts.append(f"short {i}\n" + " ".join(w) + "\n" + " ".join(f"u{i}_{k}" for k in range(30)))
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/l.parquet")
    rows = [r for r in paragraphs.repeated_paragraphs(spark.read.parquet(f"{tmp_path}/l.parquet")).collect() if r.kind == "line"]
    lines = [t.split("\n")[1].split() for t in texts]
    sets = [{tuple(w[k:k + 5]) for k in range(len(w) - 4)} for w in lines]
    comp = list(range(40))
    for _ in range(40):
        comp = [min(comp[j] for j in range(40) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])) for i in range(40)]
    want = defaultdict(set)
    for i, c in enumerate(comp):
        want[c].add(i)
    got = defaultdict(set)
    for x in rows:
        got[x.component].add(x.doc_id)
    assert sorted(map(sorted, got.values())) == sorted(sorted(v) for v in want.values() if len(v) > 1)


def test_near_passages_inside_longer_text_are_found(spark, tmp_path):
    """Pairs of 50-word passages that differ by a changed, an added or a left-out word, amid other words; clean texts."""
    import random

    r = random.Random(11)
    word = lambda: f"w{r.randrange(10**7)}"
    texts = []
    for i in range(120):
        p = [word() for _ in range(50)]
        q, at = list(p), r.randrange(50)
        q[at:at + 1] = [[word()], [], [p[at], word()]][i % 3]
        for body in (p, q):
            texts.append(" ".join([word() for _ in range(r.randrange(60))] + body + [word() for _ in range(r.randrange(60))]))
    texts += [" ".join(word() for _ in range(150)) for _ in range(60)]
    write(spark, tmp_path, list(enumerate(texts)), "doc_id long, text string")
    rows = paragraphs.repeated_paragraphs(spark.read.parquet(f"{tmp_path}/t.parquet")).collect()
    assert {r.doc_id for r in rows} == set(range(240)) and {r.doc_id for r in rows if r.removed} == set(range(1, 240, 2))


def test_exact_passages_are_covered_but_for_their_ends(spark, tmp_path):
    p = " ".join(f"p{k}" for k in range(100))
    texts = [" ".join(f"{c}{i}_{k}" for k in range(30)) + f" {p} " + " ".join(f"z{c}{i}_{k}" for k in range(30)) for i, c in enumerate("abc")]
    write(spark, tmp_path, list(enumerate(texts)), "doc_id long, text string")
    covered = defaultdict(set)
    for r in paragraphs.repeated_paragraphs(spark.read.parquet(f"{tmp_path}/t.parquet")).collect():
        covered[r.doc_id].update(range(r.start, r.start + r.words))
    assert all(covered[i] <= set(range(30, 130)) and covered[i] >= set(range(38, 122)) for i in range(3))


def test_repeats_within_one_document(spark, tmp_path):
    p = " ".join(f"p{k}" for k in range(40))
    texts = [f"{p}\nbetween\n{p}\nown words here now\n{p}", "tick " * 300, "x y\nx y", "alone"]
    write(spark, tmp_path, list(enumerate(texts)), "doc_id long, text string")
    rows = paragraphs.repeated_paragraphs(spark.read.parquet(f"{tmp_path}/t.parquet")).collect()
    lines = sorted((r.doc_id, r.start, r.removed) for r in rows if r.kind == "line")
    assert lines == [(0, 0, False), (0, 41, True), (0, 85, True), (2, 0, False), (2, 2, True)]
    assert {r.doc_id for r in rows if r.kind == "block"} <= {0, 1} and {r.first_doc for r in rows} <= {0, 1, 2}


@pytest.mark.parametrize("columns", [7, 4096])
def test_jaccard_of_long_lines_in_bounded_memory(monkeypatch, columns):
    import tracemalloc

    monkeypatch.setattr(paragraphs, "COLUMNS", columns)
    rng = np.random.default_rng(5)
    small = [np.unique(rng.integers(0, 60, rng.integers(1, 50))).astype("<u4") for _ in range(40)] + [np.arange(200, 230, dtype="<u4")] * 2
    a, b = paragraphs.jaccard_links(small)
    comp = list(range(len(small)))
    near = [[len(np.intersect1d(x, y)) >= 0.8 * len(np.union1d(x, y)) for y in small] for x in small]
    for _ in small:
        comp = [min(comp[j] for j in range(len(small)) if near[i][j]) for i in range(len(small))]
    got = list(range(len(small)))
    for i, j in zip(a.tolist(), b.tolist()):
        got[i] = j
    assert [got.index(g) for g in got] == [comp.index(c) for c in comp]
    if columns == 4096:
        base = np.unique(rng.integers(0, 1 << 32, 10_000, dtype=np.uint64).astype("<u4"))
        long = [np.unique(np.r_[base[i:], rng.integers(0, 1 << 32, 30, dtype=np.uint64).astype("<u4")]) for i in range(128)]
        tracemalloc.start()
        far, _ = paragraphs.jaccard_links(long)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert len(far) == 127 and peak < 150 << 20


@pytest.mark.parametrize("hot", [200, 2])
def test_hot_lines_are_dealt_to_parts(spark, tmp_path, monkeypatch, hot):
    monkeypatch.setattr(paragraphs, "HOT", hot)
    texts = ["the same line in all of them\n" * 3 + f"one of its own {i} a b c" for i in range(1200)]
    write(spark, tmp_path, list(enumerate(texts)), "doc_id long, text string")
    rows = paragraphs.repeated_paragraphs(spark.read.parquet(f"{tmp_path}/t.parquet")).collect()
    lines = [r for r in rows if r.kind == "line"]
    assert len(lines) == 3600 and sum(not r.removed for r in lines) == 1 and {r.first_doc for r in lines} == {0}


def test_short_lines_form_classes(spark, tmp_path):
    near = [f"n{k}" for k in range(20)]
    texts = ["\n".join(["Read more", "one two three four five", "a b c d e f g h i", " ".join(near), f"own line {i}"]) for i in range(3)]
    texts[1] = texts[1].replace("n19", "x19")
    texts += ["read  MORE\na b c d e f g h z", "a b c d e f g h i", "more", "\n \n", "", None]
    write(spark, tmp_path, list(enumerate(texts)), "doc_id long, text string")
    rows = paragraphs.repeated_paragraphs(spark.read.parquet(f"{tmp_path}/t.parquet")).collect()
    got = defaultdict(set)
    for r in (r for r in rows if r.kind == "line"):
        got[r.component].add((r.doc_id, r.start, r.words, r.removed))
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, [
        {(0, 0, 2, False), (1, 0, 2, True), (2, 0, 2, True), (3, 0, 2, True)},
        {(0, 2, 5, False), (1, 2, 5, True), (2, 2, 5, True)},
        {(0, 7, 9, False), (1, 7, 9, True), (2, 7, 9, True), (4, 0, 9, True)},
        {(0, 16, 20, False), (1, 16, 20, True), (2, 16, 20, True)}]))


# 10 language

def test_language(docs):
    rows = langid.identify(docs).collect()
    truth = {r[0]: r for r in hard_documents()}
    assert len(rows) == len(hard_documents())
    right = []
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode() if r.doc_id is not None else b"") % 5 == 0)
        assert 0 <= r.score <= 1 and r.lang_pred in ("en", "de", "und")
        t = truth[r.doc_id][1] if r.doc_id is not None else None
        if r.doc_id is not None:
            assert (r.lang_pred == "und") == (not t or not any(map(str.isalpha, t)))
        if r.doc_id is not None and r.doc_id < 60 and r.doc_id % 4 and r.held_out and len(t) > 60:  # every fourth mixes languages
            right.append(r.lang_pred == truth[r.doc_id][2])
    assert right and np.mean(right) >= 0.9


def test_held_out_rows_do_not_train(docs, spark, tmp_path):
    model = langid.train(docs)
    from pyspark.sql import functions as F

    changed = docs.withColumn("text", F.when(langid.held_out(F.col("doc_id")), "zzz qqq").otherwise(F.col("text")))
    again = langid.train(changed)
    assert np.array_equal(model.table, again.table) and model.temperature == again.temperature


# empty tables

def test_empty_tables(no_docs):
    model, bpe = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.json")
    for df in (suffix.remove_repeats(no_docs), suffix.without_repeats(no_docs), mixing.mix(no_docs), mixing.mixed_documents(no_docs),
               simhash.near_duplicates(no_docs), simhash.one_of_each(no_docs), token_count.token_counts(no_docs, model),
               packing.pack_documents(no_docs, bpe), paragraphs.repeated_paragraphs(no_docs), langid.identify(no_docs)):
        assert df.count() == 0
