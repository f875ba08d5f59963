"""Operators 4, 5, 6 and 10 and the pipeline against plain Python."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import tracemalloc
import zlib
from collections import defaultdict

import numpy as np
import pytest

import corpus_pipeline
from eventmart.llm import neighbours, packing, simhash, suffix_dedup, toxicity
from eventmart.llm.queries import vocabulary

from .conftest import SF, texts_of


# ---- neighbours -------------------------------------------------------------

def nearest(rows, query, k):
    q = np.array(query[1], float)
    scored = [(-float(np.array(v, float) @ q), i) for i, v in rows if i != query[0] and len(v) == len(q)]
    return [(i, -s) for s, i in sorted(scored)[:k]]


def test_neighbours_recall_on_the_table(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    got = defaultdict(list)
    for r in neighbours.search(df, lambda i: i % 20 == 0, k=20).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    queries = [r for r in rows if r[0] % 20 == 0]
    assert set(got) == {q[0] for q in queries}
    hits = 0
    for q in queries:
        want = nearest(rows, q, 20)
        assert [r for r, _, _ in got[q[0]]] == list(range(1, 21))
        hits += len({i for i, _ in want} & {i for _, i, _ in got[q[0]]})
        exact = dict(nearest(rows, q, len(rows)))
        assert all(s == pytest.approx(exact[i], abs=1e-12) for _, i, s in got[q[0]])
    assert hits >= 0.95 * 20 * len(queries)


def test_neighbour_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (20, [2.0, 1.0]), (8, [-1.0, 0.0]), (None, [1.0, 1.0]), (40, [1.0]), (60, []), (9, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as id", "2 as code", "3 as rank")
    out = [tuple(r) for r in neighbours.search(df, lambda i: i % 20 == 0, k=3).orderBy("query_id", "rank").collect()]
    assert out == [(0, 1, 20, 2.0), (0, 2, 1, 1.0), (0, 3, 2, 1.0), (20, 1, 0, 2.0), (20, 2, 1, 2.0), (20, 3, 2, 2.0)]
    assert neighbours.search(df.limit(0), lambda i: i % 20 == 0).count() == 0


def test_neighbours_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "VECTORS", 40)
    monkeypatch.setattr(neighbours, "QUERIES", 4)
    rng = np.random.default_rng(3)
    x = rng.standard_normal((300, 16))
    x[100:200] = x[100]  # a third are copies
    rows = [(i, [float(f) for f in v]) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = defaultdict(list)
    for r in neighbours.search(df, lambda i: i % 20 == 0, k=20).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append(r["vec_id"])
    for q in rows[::20]:
        want = [i for i, _ in nearest(rows, q, 20)]
        assert len(set(want) & set(got[q[0]])) >= 19


# ---- packing ----------------------------------------------------------------

def check_packing(rows, docs, length):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    ids = [np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for _, t in docs]
    want = sorted((str(d), i.tobytes()) for (d, _), i in zip(docs, ids, strict=True))
    by_sequence = defaultdict(list)
    pieces = defaultdict(list)
    for r in rows:
        raw = bytes(r["ids"])
        assert r["ids_crc32"] == zlib.crc32(raw) and len(raw) == 4 * r["length"] and r["length"] > 0
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]].append((r["start"], r["doc_tokens"], raw))
    for parts in by_sequence.values():
        parts.sort()
        assert [o for o, _ in parts] == list(itertools.accumulate([0, *(n for _, n in parts)]))[:-1]
        assert sum(n for _, n in parts) <= length
    if len({d for d, _ in docs}) == len(docs):
        got = []
        for d, parts in pieces.items():
            parts.sort()
            assert [s for s, _, _ in parts] == list(itertools.accumulate([0, *(len(p) // 4 for _, _, p in parts)]))[:-1]
            assert all(n == sum(len(p) // 4 for _, _, p in parts) for _, n, _ in parts)
            got.append((str(d), b"".join(p for _, _, p in parts)))
        assert sorted(got) == want
    assert sum(r["length"] for r in rows) == sum(map(len, ids))
    return len(by_sequence)


def test_packing_keeps_every_id_once(spark):
    docs = list(enumerate(texts_of(3, 120) + [None, "", "é" * 3000, "  a \n\n b\t" * 200]))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    rows = packing.pack(df, vocabulary("byte_bpe_50k.json"), length=64, keep_ids=True).collect()
    n = check_packing(rows, docs, 64)
    assert n * 64 - sum(r["length"] for r in rows) <= 64 * 8


def test_packing_edges(spark, edge_docs, no_docs):
    docs = [(r["doc_id"], r["text"]) for r in edge_docs.select("doc_id", "text").collect()]
    check_packing(packing.pack(edge_docs, vocabulary("byte_bpe_50k.json"), keep_ids=True).collect(), docs, 2048)
    assert packing.pack(no_docs, vocabulary("byte_bpe_50k.json")).count() == 0


def test_hilbert_keys_step_to_neighbours():
    for bits, dims in ((3, 2), (2, 4)):
        grid = np.array(list(itertools.product(range(2**bits), repeat=dims)))
        keys = packing.hilbert_keys(grid, bits)
        assert sorted(keys) == list(range(len(grid)))
        assert np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(axis=1).max() == 1


def test_alike_documents_lie_close(spark):
    rnd = random.Random(2)
    topics = [["cat", "dog", "pet", "fur"], ["bond", "stock", "rate", "loan"], ["run", "ball", "goal", "team"]]
    docs = [(i, " ".join(rnd.choice(topics[i % 3]) for _ in range(80))) for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    order = [r["doc_id"] % 3 for r in packing.tokenised(df, vocabulary("byte_bpe_50k.json"), 1).orderBy("place", "doc_id").collect()]
    assert sum(a == b for a, b in itertools.pairwise(order)) > 40


# ---- suffix dedup -----------------------------------------------------------

def brute_repeats(docs, window):
    rows = [(float("inf") if d is None else d, (t or "").encode()) for d, t in docs]
    first = {}
    for d, t in rows:
        for i in range(len(t) - window + 1):
            w = t[i : i + window]
            first[w] = min(d, first.get(w, d))
    out = []
    for (d, _), (key, t) in zip(docs, rows, strict=True):
        gone = bytearray(len(t))
        for i in range(len(t) - window + 1):
            if first[t[i : i + window]] < key:
                gone[i : i + window] = b"\1" * window
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        out.append((str(d), len(t), len(t) - len(kept), len(re.findall(rb"\x01+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def shared_texts(seed, n):
    rnd = random.Random(seed)
    pool = ["".join(rnd.choice("abcd ") for _ in range(rnd.randint(40, 200))) for _ in range(8)] + ["ab" * 70, "x" * 150, "é日😀" * 25]
    out = []
    for _ in range(n):
        parts = [rnd.choice(pool) if rnd.random() < 0.5 else "".join(rnd.choice("abcdefgh ") for _ in range(rnd.randint(0, 60))) for _ in range(rnd.randint(0, 5))]
        text = "".join(p[rnd.randint(0, 20) : len(p) - rnd.randint(0, 20)] for p in parts)
        out.append(text)
    return out


@pytest.mark.parametrize("hot", [2048, 3])
def test_suffix_dedup_equals_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 600)
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 3000)
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    docs = [(i * 7 % 101, t) for i, t in enumerate(shared_texts(hot, 90))]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = sorted((str(r[0]), *r[1:]) for r in suffix_dedup.remove_repeats(df, window=50).collect())
    assert got == brute_repeats(docs, 50)


def test_suffix_dedup_edges(spark, edge_docs, no_docs):
    docs = [(r["doc_id"], r["text"]) for r in edge_docs.select("doc_id", "text").collect()]
    got = sorted((str(r[0]), *r[1:]) for r in suffix_dedup.remove_repeats(edge_docs).collect())
    assert got == brute_repeats(docs, 50)
    assert suffix_dedup.remove_repeats(no_docs).count() == 0
    kept = suffix_dedup.without_repeats(edge_docs)
    assert kept.dtypes == edge_docs.dtypes and kept.count() == len(docs)
    texts = {r["doc_id"]: r["text"] for r in kept.collect() if r["doc_id"] is not None}
    assert texts[100] is None and texts[101] == ""
    assert [tuple(r)[5:] for r in kept.collect()] == [tuple(r)[5:] for r in edge_docs.collect()]
    assert suffix_dedup.without_repeats(no_docs).count() == 0


def test_repeats_are_found_in_parts_of_bounded_memory(monkeypatch):
    """A bucket's arrays are those of a part of its keys; the parts find what one array does."""
    rnd = random.Random(5)
    noise = lambda k: bytes(rnd.choices(b"abcdefgh ", k=k))
    shared = [noise(66) for _ in range(20_000)]
    contexts = [c for m in shared for c in (noise(9) + m, m + noise(9))]
    docs = np.array([rnd.randint(0, 999) for _ in contexts], np.int64)
    tracemalloc.start()
    found = suffix_dedup.repeated_spans(contexts, docs, 50)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100e6
    assert len(found) > 10_000
    for part in (1 << 8, 1 << 40):
        monkeypatch.setattr(suffix_dedup, "PART_BYTES", part)
        monkeypatch.setattr(suffix_dedup, "PART_WINDOWS", part)
        assert suffix_dedup.repeated_spans(contexts[:4000], docs, 50).tolist() == found[found[:, 0] < 4000].tolist()


def test_maximal_repeats_with_all_occurrences():
    rnd = random.Random(7)
    for _ in range(60):
        text = bytes(rnd.choice(b"ab") for _ in range(rnd.randint(20, 90)))
        window = 16
        n = len(text) - window + 1
        if n < 1:
            continue
        places = np.arange(n)
        data = np.frombuffer(text + bytes(64), np.uint8)
        before = np.array([256, *text[: n - 1]], np.int64)
        order, lcp = suffix_dedup.suffix_array(data, places, before, len(text) - places, window)
        got = {(length, tuple(sorted(places[order[a:b]].tolist()))) for length, a, b in suffix_dedup.maximal_repeats(order, lcp, before, window)}
        want = set()
        for length in range(window, len(text)):
            spots = defaultdict(list)
            for i in range(len(text) - length + 1):
                spots[text[i : i + length]].append(i)
            for w, at in spots.items():
                if len(at) > 1:
                    right = {text[i + length : i + length + 1] or i for i in at}
                    left = {text[i - 1 : i] if i else i + 1000 for i in at}
                    if len(right) > 1 and len(left) > 1:
                        want.add((length, tuple(at)))
        assert got == want


# ---- SimHash ----------------------------------------------------------------

def components(fps, radius):
    """Least index of each value's component."""
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def brute_fingerprint(text):
    import xxhash

    words = re.findall(rb"[^\x20\x09-\x0d]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_masks_cover_every_pair_within_the_radius():
    for radius in (1, 2, 3):
        masks = simhash.covering_masks(radius)
        assert len(masks) == 2 ** (radius + 1) - 1
        for bits in itertools.combinations(range(64), radius):
            assert any(not m >> b & 1 for m in masks for b in [bits[0]] if not any(m >> x & 1 for x in bits))


@pytest.mark.parametrize("block", [2048, 7])
def test_links_give_the_components(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    rnd = random.Random(block)
    fps = set()
    for _ in range(25):
        fp = rnd.getrandbits(64)
        for _ in range(rnd.choice([1, 2, 5, 60])):
            fps.add(fp)
            for _ in range(rnd.randint(1, 5)):
                fp ^= 1 << rnd.randrange(64)
    fps = sorted(fps)
    signed = lambda v: v - 2**64 if v >= 2**63 else v
    nodes = spark.createDataFrame([(signed(v),) for v in fps], "fp long")
    root = {r["node"]: r["root"] for r in simhash.stars(simhash.links(nodes, 3)).collect()}
    groups = defaultdict(set)
    for v in fps:
        groups[root.get(signed(v), signed(v))].add(v)
    want = defaultdict(set)
    for v, c in zip(fps, components(fps, 3), strict=True):
        want[c].add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_near_duplicates_equal_brute_force(spark, edge_docs, no_docs):
    docs = [(r["doc_id"], r["text"]) for r in edge_docs.select("doc_id", "text").collect()]
    fps = [brute_fingerprint(t) for _, t in docs]
    least = defaultdict(lambda: float("inf"))
    for (d, _), c in zip(docs, group := components(fps, 3), strict=True):
        least[c] = min(least[c], float("inf") if d is None else d)
    want = sorted((str(d), f"{f:016x}", least[c]) for (d, _), f, c in zip(docs, fps, group, strict=True))
    got = sorted((str(r["doc_id"]), r["fingerprint"], float("inf") if r["component_id"] is None else r["component_id"]) for r in simhash.near_duplicates(edge_docs).collect())
    assert got == want
    assert simhash.near_duplicates(no_docs).count() == 0
    kept = simhash.representatives(edge_docs)
    assert kept.columns == edge_docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {None} | {d for (d, _), c in zip(docs, group, strict=True) if d is not None and d == least[c]}


# ---- pipeline ---------------------------------------------------------------

def test_pipeline_stages_on_their_own_inputs(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    given = docs
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, given, SF)
        out.write.parquet(str(tmp_path / str(n)))
        out = spark.read.parquet(str(tmp_path / str(n)))
        before, after = [tuple(r) for r in given.collect()], out.collect()
        if name != "packing":
            assert out.dtypes == docs.dtypes
        text = {r[0]: r[1] for r in before}
        if name == "toxicity":
            score = {r["doc_id"]: r["score"] for r in toxicity.score(given, toxicity.fit(given, spark.read.parquet(f"{SF}/labels.parquet"))).collect()}
            assert {r["doc_id"] for r in after} == {d for d, s in score.items() if s < 0.5} and len(after) > 0.8 * len(before)
        elif name == "simhash_near_dedup":
            ids = sorted(text)
            least = components([brute_fingerprint(text[d]) for d in ids], 3)
            assert sorted(r["doc_id"] for r in after) == sorted({ids[i] for i in least})
        elif name == "suffix_dedup":
            want = {d: h for d, _, _, _, h in brute_repeats(list(text.items()), 50)}
            same = [r for r in after if hashlib.sha256(r["text"].encode()).hexdigest() == want[str(r["doc_id"])]]
            assert len(after) == len(before) and len(same) >= 0.9 * len(after)  # others lost part of a character
            assert all(r["n_chars"] == len(r["text"]) for r in after)
        elif name == "pii":
            assert len(after) == len(before)
            assert not any(re.search(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r["text"]) for r in after)
            assert all(r["text"] == text[r["doc_id"]] or re.search(r"\[(EMAIL|IP|CARD|PHONE|IBAN|SSN)\]", r["text"]) for r in after)
        else:
            assert {r["doc_id"] for r in after} == set(text)
        given = out
