"""Operators 1, 2 and 5 against brute force."""

import base64
import gzip
import hashlib
import io
import json
import math
import os
import random
import uuid

import numpy as np
import pyarrow as pa
import pytest

from treadle.llm import components, embeddings, jaccard, warc


def roots_of(n, links):
    root = list(range(n))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k
    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(k) for k in range(n)]


def test_components(spark):
    own = random.Random(1)
    links = [(own.randrange(300), own.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(300, 400)]
    links += [(400, k) for k in range(401, 500)]  # a chain and a star
    got = {r.node: r.root for r in components.components(spark, spark.createDataFrame(links, "a long, b long")).collect()}
    want = roots_of(500, links)
    assert got == {k: want[k] for k in range(500) if want[k] != k}
    assert components.components(spark, spark.createDataFrame([], "a long, b long")).count() == 0


def clustered(seed=2):
    own = np.random.default_rng(seed)
    rows = []
    for _ in range(40):
        center = own.standard_normal(16)
        for _ in range(own.integers(1, 30)):
            rows.append((center + own.standard_normal(16) * own.choice([0.02, 0.1, 0.3])).astype(np.float32).tolist())
    return rows + rows[:5]


@pytest.mark.parametrize("chunk", [8, 2048])
def test_vectors(spark, chunk):
    vectors = clustered()
    labels = [k % 3 for k in range(len(vectors))]
    odd = [None, [], [0.0] * 16, [math.nan] * 16, [math.inf] * 16, [None] * 16, vectors[0][:8], vectors[0]]
    rows = [(100 + k, v, y, 1, "x") for k, (v, y) in enumerate(zip(vectors + odd, labels + [0] * 7 + [None]))]
    rows += [(None, vectors[0], labels[0], 1, "x")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, row long, content string")
    got = embeddings.near_duplicates(spark, table, chunk=chunk, block=64, window=32).collect()
    assert len(got) == len(rows)
    x = np.array(vectors + [vectors[0]])
    x /= np.linalg.norm(x, axis=1)[:, None]
    y = np.array(labels + [labels[0]])
    near = (x @ x.T >= 0.93) & (y[:, None] == y[None, :])
    np.fill_diagonal(near, False)
    root = roots_of(len(x), zip(*np.nonzero(near)))
    by = {r.id: r for r in got}
    for k in range(len(vectors)):
        r = by[100 + k]
        assert (r.n_links, r.component_id, r.kept) == (near[k].sum(), 100 + root[k], root[k] == k)
    for k in range(len(odd)):
        r = by[100 + len(vectors) + k]
        assert (r.n_links, r.component_id, r.kept) == (0, r.id, True)
    assert by[None].n_links == near[-1].sum() and not by[None].kept


def test_isolated_pairs_of_a_long_order_are_found(spark):
    own = np.random.default_rng(11)
    x, y = own.standard_normal((2, 1500, 32))
    x /= np.linalg.norm(x, axis=1)[:, None]
    y -= (x * y).sum(axis=1)[:, None] * x
    y /= np.linalg.norm(y, axis=1)[:, None]
    pairs = np.concatenate([x, 0.932 * x + math.sqrt(1 - 0.932 ** 2) * y])
    table = spark.createDataFrame([(k, v, 0) for k, v in enumerate(pairs.tolist())], "vec_id long, embedding array<double>, label int")
    got = embeddings.near_duplicates(spark, table, window=2)  # as long for its window as 96,000 vectors for one of 64
    assert got.where("n_links = 0").count() <= 2 and got.count() == 3000


def test_passes_grow_with_the_order():
    for bits in (0, 5, 11, 17):
        found = (1 - math.acos(0.93) / math.pi) ** bits
        n = embeddings.passes_for(bits, 0.93, 1e-4)
        assert (1 - found) ** n <= 1e-4 and (n == 1 or (1 - found) ** (n - 1) > 1e-4)
    assert embeddings.passes_for(20, 1.0, 1e-4) == 1


def test_no_vectors(spark):
    assert embeddings.near_duplicates(spark, spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def pages(spark, rows):
    return spark.createDataFrame([(*r, 5, "z") for r in rows], "page_id long, url string, html string, id long, payload string")


PAGES = [(1, "http://a/", "<p>é"), (2, None, "<p>é"), (3, "http://c/\r\nX: y", None), (4, "d", ""), (5, "e", "x" * 300_000),
         (6, "f", "a\r\n\r\nWARC/1.1\r\n"), (None, "g", "<p>é"), (7, "h", "once"), (7, "h", "once")]


@pytest.mark.parametrize("file_bytes", [1, 1 << 20])
def test_archives(spark, file_bytes):
    archives = warc.archive(spark, pages(spark, PAGES), file_bytes=file_bytes)
    got = warc.read_records(archives).collect()
    payload = {r[0]: (r[2] or "").encode() for r in PAGES}
    largest = {}
    for i, p in payload.items():
        if i is not None:
            largest[p] = max(i, largest.get(p, i))
    assert sorted(str(r.id) for r in got) == sorted(str(r[0]) for r in PAGES)
    for r in got:
        own = payload[r.id]
        holder = largest[own] if r.id is not None and largest[own] > r.id else None
        assert r.payload_digest == base64.b32encode(hashlib.sha1(own).digest()).decode() and r.payload_bytes == len(own)
        assert (r.record_type, r.refers_to) == (("revisit", holder) if holder else ("response", None))
        assert r.payload == (None if holder else own)
    # each member is a gzip file of its own, at the sidecar's offset
    for a in archives.collect():
        data = open(a.path.removeprefix("file://").removeprefix("file:"), "rb").read()
        entries = [json.loads(x) for x in open(a.sidecar.removeprefix("file://").removeprefix("file:"))]
        assert len(entries) == a.records and sum(e["length"] for e in entries) == len(data)
        for e in entries:
            one = gzip.decompress(data[e["offset"]:e["offset"] + e["length"]])
            assert one.startswith(b"WARC/1.1\r\n") and e["id"].encode() in one


def test_payloads_under_the_least_size_are_responses(spark):
    got = warc.read_records(warc.archive(spark, pages(spark, PAGES), least_bytes=1)).collect()
    assert {r.id: r.record_type for r in got}[3] == "response" and {r.id: r.record_type for r in got}[1] == "revisit"


def test_no_pages(spark):
    assert warc.read_records(warc.archive(spark, pages(spark, []))).count() == 0


def test_a_stream_is_inflated_piece_by_piece():
    records = [warc.record(k, "u", b"p" * own, None, "d") for k, own in enumerate([0, 1, 5000, 70_000, 3])]
    packed = gzip.compress(b"".join(records[:3])) + gzip.compress(b"".join(records[3:]))
    for chunk in (1, 7, 1000, 1 << 20):
        got = list(warc.split_records(warc.inflated(io.BytesIO(packed), chunk)))
        assert [data for _, data in got] == records
    with pytest.raises(ValueError):
        list(warc.split_records(warc.inflated(io.BytesIO(packed[:-20]), 100)))


def mutated(seed=3, families=12):
    own = random.Random(seed)
    word = lambda: "".join(own.choice("abcdefgh") for _ in range(3))
    texts = []
    for _ in range(families):
        base = [word() for _ in range(own.choice([2, 3, 6, 12, 30, 80, 200, 600]))]
        for _ in range(own.randint(1, 14)):
            copy = base[:]
            for _ in range(own.choice([0, 0, 1, 1, 2, 3, 5, 8])):
                k = own.randrange(len(copy))
                copy[k:k + 1] = own.choice([[word()], [], [copy[k], word()]])
                copy = copy or [word()]
            texts.append(" ".join(copy))
    return texts + [" ".join(["common passage of words"] * 3 + [word() for _ in range(40)]) for _ in range(30)]


def brute(texts, size, part, whole):
    sets = []
    for t in texts:
        w = [x for x in (t or "").encode().lower().split()]
        sets.append({tuple(w[k:k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set())
    links = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and sets[j]
             and whole * len(sets[i] & sets[j]) >= part * len(sets[i] | sets[j])]
    return [len(s) for s in sets], roots_of(len(sets), links)


@pytest.mark.parametrize("size,part,chunk,seed,few", [
    (3, 90, 512, 3, 9), (5, 80, 512, 4, 0), (3, 80, 2, 5, 10**6), (1, 50, 3, 6, 0), (2, 70, 512, 7, 10**6)])
def test_similar_documents(spark, documents, monkeypatch, size, part, chunk, seed, few):
    monkeypatch.setattr(jaccard, "BROADCAST_ROWS", few)
    texts = [*mutated(seed), None, "", " \t", "ONE", "one", "é É"]
    docs = documents(texts, [10 + k for k in range(len(texts))]).repartition(3)
    got = {r.id: r for r in jaccard.similar_documents(spark, docs, size, part, chunk=chunk).collect()}
    sizes, root = brute(texts, size, part, 100)
    assert [got[10 + k].n_shingles for k in range(len(texts))] == sizes
    assert [got[10 + k].component_id for k in range(len(texts))] == [10 + r for r in root]


def test_entries_meet_for_every_similar_pair():
    """The pigeonhole: similar sets share entries worth what each of them counts on."""
    own = np.random.default_rng(8)
    for part in (50, 80, 90):
        for _ in range(150):
            n = int(own.integers(2, 400))
            universe = np.unique(own.integers(0, 1 << 63, 3 * n, dtype=np.uint64))
            a = np.sort(own.choice(universe, n, replace=False))
            gone = int(own.integers(0, max(1, n * (100 - part) // 100) + 1))
            b = np.unique(np.concatenate([a[own.permutation(n)[gone:]], own.choice(universe, int(own.integers(0, 3)))]))
            if not len(b) or 100 * len(np.intersect1d(a, b)) < part * len(np.union1d(a, b)) or len(a) == len(b) == len(np.intersect1d(a, b)):
                continue
            for documents in (100, 10 ** 9):
                (ka, ta), (kb, tb) = (jaccard.entries(s, jaccard.windows_of(len(s), part, 100, documents)) for s in (a, b))
                met = False
                for window in {k >> 56 & 255 for k in ka.tolist()} & {k >> 56 & 255 for k in kb.tolist()}:
                    worth = []
                    for k, t, other in ((ka, ta, kb), (kb, tb, ka)):
                        tags = {(int(x), int(y) if x & 3 == 1 else 0) for y, x in zip(k, t)
                                if int(y) >> 56 & 255 == window and y in set(other.tolist())}
                        worth.append(sum(x & 3 for x, _ in tags) >= max((x >> 21 for x, _ in tags), default=1 << 30))
                    met |= all(worth)
                assert met, (part, len(a), len(b))


def kept_by_entries(a, b, part, documents):
    """Whether two sets share entries of one window worth what each of them counts on."""
    (ka, ta), (kb, tb) = (jaccard.entries(s, jaccard.windows_of(len(s), part, 100, documents)) for s in (a, b))
    shared = set(ka.tolist()) & set(kb.tolist())
    for window in {k >> 56 & 255 for k in shared}:
        worth = []
        for keys, tags in ((ka, ta), (kb, tb)):
            own = {(int(t), k if t & 3 == 1 else 0) for k, t in zip(keys.tolist(), tags) if k in shared and k >> 56 & 255 == window}
            worth.append(sum(t & 3 for t, _ in own) >= max(t >> 21 for t, _ in own))
        if all(worth):
            return True
    return False


def test_one_shingle_meets_two_in_a_segment_of_allowance_two():
    wide = [w for w in jaccard.windows_of(12, 80, 100, 10 ** 6) if w.allowances.tolist() == [2, 2, 1, 1] and w.slack == 2]
    assert wide
    edges = [0, *wide[0].borders.tolist(), 1 << 64]
    place = lambda segment, k: edges[segment] + (k + 1) * ((edges[segment + 1] - edges[segment]) // 64)
    small = [place(0, 0)] + [place(1, k) for k in range(7)] + [place(2, k) for k in range(2)] + [place(3, k) for k in range(2)]
    large = small + [place(0, 9), place(2, 9), place(3, 9)]
    small, large = (np.sort(np.array(s, dtype=np.uint64)) for s in (small, large))
    assert (len(small), len(large)) == (12, 15) and kept_by_entries(small, large, 80, 10 ** 6)


def test_a_subset_at_the_threshold_is_kept_at_any_table_size():
    own = np.random.default_rng(12)
    for _ in range(4000):
        part, documents = int(own.choice([60, 80, 90])), int(own.choice([10 ** 3, 10 ** 6, 10 ** 9, 10 ** 12]))
        n = int(own.integers(3, 60))
        large = np.unique(own.integers(0, 1 << 64, n * 100 // part, dtype=np.uint64))
        small = np.sort(own.choice(large, n, replace=False))
        if len(small) < len(large):
            assert kept_by_entries(small, large, part, documents), (part, documents, len(small), len(large))


def test_one_of_each(spark, documents, rows):
    texts = ["a b c d e f g", "a b c d e f g", "other words", None, "", "A B C D E F G", "other words"]
    docs = documents(texts, [3, 3, 5, 6, None, 2, 7])
    assert jaccard.one_of_each(spark, docs).columns == docs.columns
    assert rows(jaccard.one_of_each(spark, docs), "doc_id") == [(2,), (5,), (6,), (None,)]
    assert rows(jaccard.one_of_each(spark, documents(["x y", "x y"], [1, 1])), "doc_id") == [(1,)]
    assert jaccard.similar_documents(spark, documents([])).count() == 0


def test_rows_without_shingles_stay_beside_repeated_rows(spark, documents, rows):
    texts, ids = [None, None, "", "", " \t", " \t", "\x1f"], [None, None, None, None, 4, 4, 5]
    assert jaccard.one_of_each(spark, documents(texts, ids)).count() == 7
    got = jaccard.one_of_each(spark, documents(texts + ["x y", "x y"], ids + [1, 1]))
    assert rows(got, "doc_id") == [(1,), (4,), (4,), (5,), (None,), (None,), (None,), (None,)]


def test_the_index_of_a_large_table_follows_its_measured_chance(spark, documents, monkeypatch):
    """It went by the number of documents alone: four times the entries per text from some 1.5 million on."""
    own = random.Random(21)
    texts = [" ".join(str(own.randrange(10 ** 6)) for _ in range(60)) for _ in range(300)]
    docs = documents(texts + [t + " end" for t in texts[:40]] + [None, ""])
    size = lambda alike: sum(len(jaccard.entries(s, jaccard.windows_of(len(s), 80, 100, alike))[0])
                             for s in (jaccard.shingles(t, 5) for t in texts))
    assert size(10 ** 7) > 3 * size(10 ** 5)
    monkeypatch.setattr(jaccard, "SAMPLE", 50)
    chance = jaccard.measured_chance(docs, 342, 5, 80, 100, "doc_id", "text")
    assert size(max(1, round(10 ** 7 * chance / jaccard.CHANCE))) == size(10 ** 5)
    monkeypatch.setattr(jaccard, "SAMPLE", 10 ** 6)  # all of them; the likes are no chance
    assert jaccard.measured_chance(docs, 342, 5, 80, 100, "doc_id", "text") < jaccard.CHANCE / 100
    common = documents([f"{w} {' '.join(texts[k].split()[:4])}" for k, w in enumerate("abcdefghij" * 10)])
    assert jaccard.measured_chance(common, 100, 1, 80, 100, "doc_id", "text") == jaccard.CHANCE  # words of all texts
    assert jaccard.measured_chance(documents([]), 1, 5, 80, 100, "doc_id", "text") == jaccard.CHANCE
    monkeypatch.setattr(jaccard, "SAMPLE", 50)
    got = {r.id: r.component_id for r in jaccard.similar_documents(spark, docs).collect()}
    ids = [r.doc_id for r in docs.collect()]
    assert [got[i] for i in ids[300:340]] == ids[:40] and len(set(got.values())) == 302


def test_the_index_is_gone_when_its_entries_are_compared(spark, documents, tmp_path, monkeypatch):
    monkeypatch.setattr(jaccard, "run_folder", lambda spark, label: f"{tmp_path}/{label}-{uuid.uuid4().hex}")
    texts = [f"{k % 7} b c d e f {k % 3} g h" for k in range(40)]
    assert jaccard.similar_documents(spark, documents(texts), part=50).count() == 40
    left = [n for n in os.listdir(tmp_path) if not n.startswith((".", "_"))]
    assert not [n for n in left if n.startswith(("index-entries", "entries"))], left
