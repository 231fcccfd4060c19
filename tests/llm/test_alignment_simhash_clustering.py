"""Token alignment, SimHash groups and centroid clusters against brute force, and their edge cases."""

import bisect
import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from conftest import SF_SMALL
from test_operators import COLUMNS, EDGE, lower  # same folder

from ledgerline.llm import alignment, clustering, components, encoders, golay, perfecthash, queries, simhash

A_FILE, B_FILE = queries.tokenizer_path(), queries.tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def edge(spark):
    clash = ["a", "b", "z", "fp", "key", "rep", "pair", "part", "shard", "n", "counts", "n_best", "count_sum", "node", "comp"]
    return spark.createDataFrame(EDGE, COLUMNS).select("*", *[F.lit("x").alias(c) for c in clash])


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


# --- cross-tokenizer alignment -------------------------------------------------------------

HARD = ["", None, "one <|endoftext|> two </s> <s> <unk>", "tabs\tand  two   blanks ", " leading", "naïve café, straße — “quotes”",
        "日本語のテキスト、漢字", "emoji 👍🏽 family 👩‍👩‍👧", "U+2581 ▁ inside", "line\n\nfeeds \n and\r\nreturns\n", " nbsp ", "a" * 300,
        "<0x41> byte names", "don't it's we'll", "x  \n  y", "　wide blank", " ", "\n", "0123456789 1,000,000.5", "é" * 40 + " é" * 40]


def brute_alignment(texts):
    from tokenizers import Tokenizer
    import sentencepiece
    first = Tokenizer.from_file(A_FILE)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=B_FILE)
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    alphabet = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    plain = {v: k for k, v in first.get_vocab().items()}
    docs, counts = [], Counter()
    for text in texts:
        whole = (" " + text).encode() if text else b""
        a = first.encode(" " + text, add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        a_bytes = [bytes(alphabet[c] for c in plain[i]) for i in a]
        b_bytes = [bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode() for i in b for p in [second.id_to_piece(i)]]
        if b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            a, b, a_bytes, b_bytes = [], [], [], []
        ends = [np.cumsum([len(x) for x in side]).tolist() for side in (a_bytes, b_bytes)]
        both = sorted({*ends[0]} & {*ends[1]})
        groups = [([], []) for _ in both]
        for ids, side, which in ((a, ends[0], 0), (b, ends[1], 1)):
            for i, e in zip(ids, side):
                groups[bisect.bisect_left(both, e)][which].append(i)
        links = [(i, j) for i, e in zip(a, ends[0]) for j, f in zip(b, ends[1]) if e == f] if len(a) < 400 else \
            [(x[-1], y[-1]) for x, y in groups]
        counts.update(links)
        docs.append((a, b, groups, links))
    best = {}
    for (_, j), n in counts.items():
        best[j] = max(best.get(j, 0), n)
    return [(len(a), len(b), len(g), len(l), sum(counts[p] == best[p[1]] for p in l), sum(counts[p] for p in l),
             hashlib.sha256(";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g).encode()).hexdigest() if a else "")
            for a, b, g, l in docs]


@pytest.mark.parametrize("block", [alignment.BLOCK, 500])
def test_alignment_brute_force(spark, small, block):
    texts = HARD + [r.text for r in small.limit(40).collect()] + [HARD[5]]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(5)
    got = {r.doc_id: tuple(r)[1:] for r in alignment.align(docs, A_FILE, B_FILE, block=block).collect()}
    assert [got[i] for i in range(len(texts))] == brute_alignment(texts)


def test_alignment_shards_and_tree(spark, monkeypatch):
    monkeypatch.setattr(alignment, "SHARD", 100)
    monkeypatch.setattr(alignment, "FAN", 2)
    monkeypatch.setattr(alignment, "FILL", 0.5)
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(600)]
    texts = [" ".join(rng.choice(words) for _ in range(60)) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7)
    got = {r.doc_id: tuple(r)[1:] for r in alignment.align(docs, A_FILE, B_FILE, block=700).collect()}
    assert [got[i] for i in range(60)] == brute_alignment(texts)


def test_alignment_edges(spark, edge):
    got = alignment.align(edge, A_FILE, B_FILE).collect()
    assert len(got) == len(EDGE)
    by = {(r.doc_id, r.n_a): r for r in got}
    for i in (2, 3):
        assert tuple(by[i, 0])[1:] == (0, 0, 0, 0, 0, 0, "")
    assert sum(r.doc_id == 6 for r in got) == 2 and sum(r.doc_id is None for r in got) == 1
    assert alignment.align(edge.limit(0), A_FILE, B_FILE).count() == 0


def test_encoders_forget_and_return():
    """Small generations: pieces are forgotten, learned again and moved on, ids stay those of whole texts."""
    from tokenizers import Tokenizer
    import sentencepiece
    library, model = Tokenizer.from_file(A_FILE), sentencepiece.SentencePieceProcessor(model_file=B_FILE)
    with open(A_FILE, encoding="utf-8") as f, open(B_FILE, "rb") as g:
        first, second = encoders.ByteLevelEncoder(f.read(), remembered=300), encoders.SentencePieceEncoder(g.read(), remembered=300)
    rng = random.Random(6)
    parts = [*"aé日 \t\n\r.,'’", "  ", "\n\n", "word", " straße", "'ll", "<|endoftext|>", " <|endoftext|>", " ", " ", "▁"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    for at in range(0, len(texts), 100):
        some = texts[at:at + 100]
        ids, offsets, sound = first.encode(pa.array(some))
        assert sound.all()
        assert [ids[x:y].tolist() for x, y in zip(offsets, offsets[1:])] == [library.encode(t, add_special_tokens=False).ids for t in some]
        ids, offsets, sound = second.encode(pa.array([" " + t for t in some]))
        whole = model.encode(some)
        for i, t in enumerate(some):
            if t:
                assert ids[offsets[i]:offsets[i + 1]].tolist() == whole[i]
                assert sound[i] == ("▁" not in t)


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 70_000])
def test_perfect_hash(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 2**62, n).astype(np.uint64))
    hash_ = perfecthash.PerfectHash.build(keys)
    assert sorted(hash_.index(keys).tolist()) == list(range(len(keys)))
    assert hash_.index(keys + np.uint64(2**62)).max(initial=-1) < max(1, len(keys))
    assert 8 * len(hash_.bits) <= 6 * len(keys) + 512


# --- SimHash --------------------------------------------------------------------------------


def brute_fingerprint(text, k=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    grams = [" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))] if w else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints):
    """{fingerprint: representative of its group}."""
    up = {p: p for p in prints}

    def top(p):
        while up[p] != p:
            p = up[p]
        return p
    every = sorted(up)
    for n, p in enumerate(every):
        for q in every[:n]:
            if (p ^ q).bit_count() <= 3:
                up[max(top(p), top(q))] = min(top(p), top(q))
    return {p: top(p) for p in every}


def test_golay_keys():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 23, 100_000)
    y = x ^ (1 << rng.integers(0, 23, len(x)))
    (a, a_valid), (b, b_valid) = golay.keys(x), golay.keys(y)
    met = ((a[:, :, None] == b[:, None, :]) & a_valid[:, :, None] & b_valid[:, None, :]).any((1, 2))
    assert met.all()
    odd = np.bitwise_count(x) % 2 == 1
    assert a_valid[odd].sum(1).max() == 1 and a_valid.sum(1).max() == 6


def test_bucket_keys_meet():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 2**64, 4000, np.uint64, endpoint=False)
    y = x.copy()
    for _ in range(3):
        y ^= np.uint64(1) << rng.integers(0, 64, len(x)).astype(np.uint64)
    (a, a_rows), (b, b_rows) = simhash.bucket_keys(x), simhash.bucket_keys(y)
    mine = set(zip(a.tolist(), a_rows.tolist()))
    assert {r for k, r in zip(b.tolist(), b_rows.tolist()) if (k, r) in mine} == set(range(len(x)))


def signed(p):
    return p - (1 << 64) if p >> 63 else p


@pytest.mark.parametrize("bucket", [simhash.BUCKET, 2])
def test_links_brute_force(spark, bucket):
    """Clusters of near fingerprints: groups are right whether buckets are paired or meet at words."""
    rng = random.Random(7)
    prints = set()
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(rng.choice([3, 60])):
            p = centre
            for b in rng.sample(range(64), rng.randint(0, 5)):
                p ^= 1 << b
            prints.add(p)
    prints |= {rng.getrandbits(64) for _ in range(100)} | {0, 7, 2**64 - 1}
    want = brute_groups(prints)
    nodes = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    links = {(r.a % 2**64, r.b % 2**64) for r in simhash.links(nodes, bucket).collect()}
    assert all((a ^ b).bit_count() <= 3 for a, b in links)
    up = {p: p for p in prints}

    def top(p):
        while up[p] != p:
            p = up[p]
        return p
    for a, b in links:
        up[max(top(a), top(b))] = min(top(a), top(b))
    assert {p: top(p) for p in prints} == want


def test_simhash_brute_force(spark, small):
    rows = [(r.doc_id, r.text) for r in small.collect()]
    rng = random.Random(9)
    base = [f"w{rng.randrange(500)}" for _ in range(400)]
    for i in range(60):
        w = list(base)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = "edit"
        rows.append((10_000 - i, " ".join(w)))
    rows += [(20_000, None), (20_001, ""), (20_002, " \t\n"), (20_003, "A b"), (20_004, "a  B"), (20_005, "x y Éé")]
    prints = {i: brute_fingerprint(t) for i, t in rows}
    group = brute_groups(set(prints.values()))
    smallest = {}
    for i, p in prints.items():
        smallest[group[p]] = min(smallest.get(group[p], i), i)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(df, bucket=3).collect()}
    assert got == {i: (f"{p:016x}", smallest[group[p]]) for i, p in prints.items()}


def test_simhash_edges(spark, edge):
    got = simhash.near_duplicates(edge).collect()
    assert len(got) == len(EDGE)
    assert {r.component_id for r in got if r.fingerprint == "0" * 16} == {2}
    assert {r.component_id for r in got if r.doc_id is None} == {None}
    assert [r.component_id for r in got if r.doc_id == 6] == [6, 6]
    assert simhash.near_duplicates(edge.limit(0)).count() == 0


def test_simhash_broadcasts_nothing(spark, small):
    plan = simhash.near_duplicates(small)._jdf.queryExecution().executedPlan().toString()
    assert "Join" in plan and "Broadcast" not in plan


def test_components_end_with_stars(spark, monkeypatch):
    """No round is spent on seeing that nothing changes, and longer paths still end whole."""
    made = []
    monkeypatch.setattr(components, "written", lambda df, name, write=components.written: (made.append(name), write(df, name))[1])
    one = spark.createDataFrame([(1, 2), (2, 3)], "a long, b long")
    assert {tuple(r) for r in components.components(one).collect()} == {(2, 1), (3, 1)}
    assert made.count("small") == 1
    path = [(i, i + 1) for i in range(40)] + [(50, 51), (60, 60)]
    random.Random(1).shuffle(path)
    got = {tuple(r) for r in components.components(spark.createDataFrame(path, "a long, b long")).collect()}
    assert got == {(i, 0) for i in range(1, 41)} | {(51, 50)}


# --- clusters -------------------------------------------------------------------------------


def brute_clusters(rows, k, rounds, scale=64):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
            if v is not None and len(v) == len(rows[0][1]) and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted((hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)
    centroids = [v for _, v in order[:k]]

    def assign():
        return [min((sum((x - y) ** 2 for x, y in zip(v, c)), n) for n, c in enumerate(centroids)) for _, v in kept]
    for _ in range(rounds):
        found = assign()
        for n in range(len(centroids)):
            own = [v for (_, v), (_, c) in zip(kept, found) if c == n]
            if own:
                centroids[n] = [sum(x) // len(own) for x in zip(*own)]
    found = assign()
    inertia = Counter()
    for d, c in found:
        inertia[c] += d
    return Counter((i, c, d, inertia[c], sum(inertia.values()), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest())
                   for (i, _), (d, c) in zip(kept, found))


@pytest.mark.parametrize("k,leaf,grid", [(16, 4, None), (40, 1, 1), (7, 2, 2), (25, 30, None)])
def test_clusters_brute_force(spark, k, leaf, grid):
    """``grid``: coarse components, so that many distances are equal."""
    rng = random.Random(k)
    rows = [(i, [rng.choice([-1.0, 0.0, 0.5]) if grid else rng.uniform(-2, 2) for _ in range(6)]) for i in range(400)]
    rows += [rows[0], rows[1], (1000, list(rows[2][1])), (None, list(rows[3][1])), (1001, None), (1002, [1.0]), (1003, [None] * 6),
             (1004, [float("nan")] * 6), (1005, [float("inf")] + [0.0] * 5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit("x") for c in ("v", "cluster", "key", "n")}).repartition(4)
    got = Counter(tuple(r) for r in clustering.clusters(df, k=k, rounds=3, dimensions=6, leaf=leaf).collect())
    assert got == brute_clusters(rows, k, 3)


def test_clusters_few_and_none(spark):
    schema = "vec_id long, embedding array<float>"
    few = spark.createDataFrame([(1, [0.0, 1.0]), (2, [0.0, 1.0]), (3, [5.0, 5.0])], schema)
    got = clustering.clusters(few, k=16, dimensions=2).collect()
    assert len(got) == 3 and {r.distance for r in got} == {0}
    assert len({r.cluster for r in got if r.vec_id in (1, 2)}) == 1  # equal centroids: the smaller number
    empty = clustering.clusters(few.limit(0), k=16, dimensions=2)
    assert empty.count() == 0 and empty.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert clustering.clusters(few, k=16, dimensions=3).count() == 0


def test_tree_prunes():
    """Well separated centroids: far fewer distances than centroids x vectors."""
    rng = np.random.default_rng(3)
    centroids = rng.integers(-100_000, 100_000, (200, 3))
    vectors = centroids[rng.integers(0, 200, 5000)] + rng.integers(-50, 50, (5000, 3))
    cluster, distance, work = clustering.VantageTree(centroids).nearest(vectors)
    every = ((vectors[:, None, :] - centroids[None]) ** 2).sum(2)
    assert np.array_equal(distance, every.min(1)) and np.array_equal(cluster, every.argmin(1))
    assert work < 5000 * 200 / 4
