"""Licence scan, packing and embeddings against brute force; the pipeline's stages."""

import random
import re
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarrymill.llm import embedding_pq, license_scan, packing, queries

# --- licences ----------------------------------------------------------------

PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


def plain_scan(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places = []
    for phrase, label in PHRASES.items():
        p = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i:i + len(p)] == p]
    return len(words), len(places), min((i for i, _ in places), default=None), max((i for i, _ in places), default=None), ",".join(sorted({x for _, x in places}))


LICENSED = [
    (1, None), (2, ""), (3, "CC-BY"), (4, "cc by cc by, CC.BY! all rights reserved"), (5, "accc by ccby cc bya"),
    (6, "GNU General Public License v3; general public license"), (7, "General\n\nPublic -- LICENSE"), (8, "gneral publc licence of gnu"),
    (9, "w " * 60_000 + "all rights reserved"), (10, "cc by " * 5_000), (10, "É cc by É\x00cc\x7fby"), (11, "Relesed under the MIT Licence."),
    (12, "Licensed under the Apache License, Version 2.0 (the License)"), (13, "all rights reserve d"), (14, "...!"), (None, "cc by"),
]


def test_base_places_equal_brute_force(make_docs, spark, folder):
    df = make_docs(LICENSED, {"spans": F.lit(1), "n_words": F.lit("x")})
    scanned = df.select("doc_id", "text", license_scan.scan(F.col("text")).alias("r")).collect()
    assert len(scanned) == len(LICENSED)
    for r in scanned:
        base = [s for s in r.r.spans if s.exact]
        starts = [s.first_word for s in base]
        assert (r.r.n_words, len(base), min(starts, default=None), max(starts, default=None),
                ",".join(sorted({s.label for s in base}))) == plain_scan(r.text), r.text[:60]
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for r in queries.queries()["op10_license_scan"](spark, folder).collect():
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain_scan(texts[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert (r.score > 0) == bool(r.labels) and r.score <= 1


def test_edited_notices_are_found_with_their_spans():
    scanner = license_scan.Scanner(license_scan.NOTICES)
    rnd = random.Random(1)
    for notice in license_scan.NOTICES:
        for _ in range(40):
            chars = list(notice.words)
            for _ in range(rnd.randrange(notice.edits + 1)):
                at = rnd.randrange(1, len(chars) - 1)
                kind = rnd.randrange(3)
                if kind == 0:
                    chars[at] = rnd.choice("abcxyz")
                elif kind == 1:
                    chars.insert(at, rnd.choice("abcxyz"))
                else:
                    del chars[at]
            text = "Some words. " + "".join(chars) + " and more"
            n, spans = scanner.scan(text)
            hits = [s for s in spans if s[0] == notice.label]
            assert hits and min(s[2] for s in hits) <= 3 and all(s[4] <= 4 and s[2] <= s[3] < n for s in hits), text


def test_clean_texts_have_no_label():
    scanner = license_scan.Scanner(license_scan.PHRASES + license_scan.NOTICES)
    for text in ("the general public has rights", "a license for all reserved rights", "permission is here", "released albums"):
        assert scanner.scan(text)[1] == []


def test_seeds_cover_every_notice_within_its_edits():
    for n in license_scan.NOTICES:
        parts = license_scan.seeds(n)
        assert len(parts) == n.edits + 1 and "".join(s for s, _ in parts) == n.words and min(len(s) for s, _ in parts) >= 7


# --- packing -----------------------------------------------------------------


def padding(lengths, counts, limits):
    return sum(n * (min(b for b in limits if b >= x) - x) for x, n in zip(lengths, counts))


@pytest.mark.parametrize("seed", range(30))
def test_boundaries_equal_all_choices(seed):
    rnd = random.Random(seed)
    lengths = sorted(rnd.sample(range(40), rnd.randrange(1, 11)))
    counts = [rnd.randrange(1, 9) for _ in lengths]
    for k in (1, 2, 3, 4):
        got = packing.boundaries(np.array(lengths), np.array(counts), k)
        assert len(got) <= k and got[-1] == lengths[-1] and got == sorted(set(got))
        best = min(padding(lengths, counts, [*c, lengths[-1]]) for c in combinations(lengths[:-1], min(k, len(lengths)) - 1))
        assert padding(lengths, counts, got) == best


def check_batches(rows, budget, n):
    assert len(rows) == n
    batches = defaultdict(list)
    for r in rows:
        assert 0 <= r.length <= r.boundary
        batches[r.bucket, r.batch].append(r)
    per_bucket = defaultdict(list)
    for (bucket, batch), members in batches.items():
        boundary, = {r.boundary for r in members}
        assert len(members) * boundary <= budget or len(members) == 1
        assert sorted(r.slot for r in members) == list(range(len(members)))
        per_bucket[bucket].append((batch, len(members), boundary))
    for found in per_bucket.values():  # all full but the last
        found.sort()
        assert [b for b, _, _ in found] == list(range(len(found)))
        assert all(n == max(1, budget // max(1, b)) for _, n, b in found[:-1])


@pytest.mark.parametrize("rows_per_task", [10, 100_000])
def test_batches_keep_the_budget(make_docs, rows_per_task):
    rnd = random.Random(2)
    rows = [(i, "w " * int(rnd.expovariate(0.02))) for i in range(400)] + [(1, None), (None, "a b"), (None, None), (3, ""), (3, ""), (4, "x " * 9000)]
    df = make_docs(rows, {"length": F.lit(1), "_draw": F.lit(2), "bucket": F.lit(3)})
    got = packing.pack(df, buckets=5, budget=800, rows_per_task=rows_per_task, keep=["doc_id"]).collect()
    check_batches(got, 800, len(rows))
    assert len({r.boundary for r in got}) == 5


def test_packing_is_the_least_padding_of_a_table(spark, folder):
    rows = queries.queries()["op8_packing"](spark, folder).collect()
    check_batches(rows, packing.BUDGET, spark.read.parquet(f"{folder}/documents.parquet").count())
    counts = Counter(r.length for r in rows)
    lengths = sorted(counts)
    got = sum(r.boundary - r.length for r in rows)
    best = {0: 0}  # by plain dynamic programming
    for _ in range(packing.BUCKETS):
        now = dict(best)
        for j in range(1, len(lengths) + 1):
            cost, total = 0, 0
            for i in range(j - 1, -1, -1):
                total += counts[lengths[i]]
                cost += counts[lengths[i]] * (lengths[j - 1] - lengths[i])
                if i in best:
                    now[j] = min(now.get(j, 1 << 60), best[i] + cost)
        best = now
    assert got == best[len(lengths)]


def test_packing_of_nothing(make_docs):
    assert packing.pack(make_docs([]), outputs=("a", "b", "c", "d", "e")).count() == 0


# --- embeddings --------------------------------------------------------------


def plain_links(rows, threshold=0.95):
    good = []
    for i, (_, v) in enumerate(rows):
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good.append(i)
    links, root = [0] * len(rows), list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in combinations(good, 2):
        x, y = (np.array(rows[i][1], float) for i in (a, b))
        if len(x) == len(y) and x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold:
            links[a] += 1
            links[b] += 1
            root[find(b)] = find(a)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        if d is not None:
            least[r] = min(d, least.get(r, d))
    return Counter((d, links[i], least.get(find(i)), d is not None and least[find(i)] == d) for i, (d, _) in enumerate(rows))


def vectors(rnd, n, dim, groups):
    out = []
    for g in range(groups):
        centre = rnd.normal(size=dim)
        for _ in range(n // groups if g else 3 * n // groups):
            out.append((centre + rnd.normal(size=dim) * rnd.uniform(0, 0.35)).astype(np.float32))
    return out


@pytest.mark.parametrize("block", [16, 2048])
def test_links_equal_brute_force(spark, block):
    rnd = np.random.default_rng(1)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors(rnd, 300, 10, 30))]
    rows += [(1000 + i, v) for i, v in enumerate([None, [], [0.0] * 10, [float("nan")] * 10, [1.0, None] + [0.0] * 8, [float("inf")] + [1.0] * 9,
                                                   rows[0][1], rows[0][1], [2 * x for x in rows[1][1]], rows[2][1][:5], rows[2][1][:5], [-x for x in rows[3][1]]])]
    rows += [(None, rows[5][1]), (None, [7.0] * 10), (7, rows[7][1])]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, key string, list int")
    params = embedding_pq.Params(block=block, probes=1000)  # all lists: the codes and the exact check lose nothing
    got = embedding_pq.links(df, params=params)
    assert Counter(map(tuple, got.collect())) == plain_links([(r.vec_id, r.embedding) for r in df.collect()])


@pytest.mark.parametrize("sf", ["sf0.1"])
def test_recall_on_a_table(spark, sf):
    df = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
    rows = df.orderBy("vec_id").collect()
    x = np.array([r.embedding for r in rows], float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    want = dict(zip((r.vec_id for r in rows), ((x @ x.T >= 0.95).sum(1) - 1).tolist()))
    got = {r.vec_id: r.n_links for r in queries.queries()["op4_embedding_pq"](spark, f"/root/testdata/{sf}").collect()}
    assert set(got) == set(want) and all(got[i] <= want[i] for i in got)
    assert sum(got.values()) >= 0.9 * sum(want.values())


def test_codes_never_hide_a_pair():
    rnd = np.random.default_rng(3)
    x = rnd.normal(size=(400, 24)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1)[:, None]
    index = embedding_pq.fit(x[:100], 7, embedding_pq.Params(subspaces=4))
    visited, codes, error = embedding_pq.assign(x, index, 3)
    for g in range(7):
        mine = np.flatnonzero(visited[:, 0] == g)
        about = embedding_pq.approximate(x, codes[mine], index.centroids[g], index.words)
        assert (np.abs(about - x[mine] @ x.T) <= error[mine][:, None] + 1e-5).all()


def test_embeddings_of_nothing(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert embedding_pq.links(empty).count() == 0
    rows = embedding_pq.links(spark.createDataFrame([(1, None), (2, [0.0])], "vec_id long, embedding array<float>")).collect()
    assert {tuple(r) for r in rows} == {(1, 0, 1, True), (2, 0, 2, True)}


def test_a_hot_group_of_near_copies_is_linked_whole(spark):
    """A third of 42,000 vectors lie close together, and are spread over far more lists than sixteen."""
    rnd = np.random.default_rng(11)
    n, hot, dim = 42_000, 14_000, 64
    x = rnd.normal(size=(n, dim))
    centre = rnd.normal(size=dim)
    x[:hot] = centre + rnd.normal(size=(hot, dim)) * (rnd.uniform(0.15, 0.24, size=(hot, 1)))
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    want = np.zeros(n, np.int64)
    for s in range(0, n, 2000):
        want[s:s + 2000] = (unit[s:s + 2000] @ unit.T >= 0.95).sum(1) - 1
    df = spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(n), "embedding": list(x)}), "vec_id long, embedding array<double>")
    got = np.zeros(n, np.int64)
    for r in embedding_pq.links(df).select("vec_id", "n_links").collect():
        got[r.vec_id] = r.n_links
    assert want[:hot].mean() > hot / 4 and (got == want).all()


def test_vectors_are_shuffled_once_and_tiles_are_read_where_they_lie(spark, monkeypatch):
    """Every tile used to be shuffled to each partner, and four tables held the vectors in double precision."""
    from pathlib import Path

    rnd = np.random.default_rng(5)
    n = 4_000
    x = rnd.normal(size=(n, 64)).astype(np.float32)
    df = spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(n), "embedding": list(x)}), "vec_id long, embedding array<float>")
    size, plans, real = {}, {}, embedding_pq.written

    def written(made, label):
        plans[label] = made._jdf.queryExecution().executedPlan().toString()
        out = real(made, label)
        size[label] = sum(Path(f.removeprefix("file:")).stat().st_size for f in out.inputFiles())
        return out

    monkeypatch.setattr(embedding_pq, "written", written)
    got = embedding_pq.links(df, params=embedding_pq.Params(block=100))
    assert got.count() == n and sum(size.values()) < 2 * x.nbytes, size
    assert plans["pq-tiles"].count("Exchange") == 1 and "Exchange" not in plans["pq-links"].replace("BroadcastExchange", "")


@pytest.mark.parametrize("kind", ["float", "double", "int"])
def test_links_of_signed_zeros_and_other_types(spark, kind):
    rnd = np.random.default_rng(8)
    rows = [(i, (v * 100).round()) for i, v in enumerate(vectors(rnd, 120, 6, 12))]
    rows += [(500, np.array([0.0, 1, 0, 0, 0, 2])), (501, np.array([-0.0, 1, -0.0, 0, 0, 2])), (502, np.array([0.0, 1, 0, 0, -0.0, 2]))]
    rows = [(i, [int(x) if kind == "int" else float(x) for x in v]) for i, v in rows]
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
    got = embedding_pq.links(df, params=embedding_pq.Params(block=16)).collect()
    assert Counter(map(tuple, got)) == plain_links([(r.vec_id, r.embedding) for r in df.collect()])
    assert {r.component_id for r in got if r.vec_id >= 500} == {500}


def test_a_tile_holds_equal_vectors_once_and_sketches_bound_the_cosine():
    rnd = np.random.default_rng(9)
    x = rnd.normal(size=(300, 20)).astype(np.float32)
    unit = embedding_pq._whole(x).astype(np.float32)
    index = embedding_pq.fit(unit[:200], 9, embedding_pq.Params(subspaces=4))
    visited, codes, error = embedding_pq.assign(unit, index, 1)
    far = np.linalg.norm(unit - index.centroids[visited[:, 0]], axis=1)
    rows = np.concatenate([np.arange(300), rnd.integers(0, 300, 200)])
    tile = pa.table({
        "tile": np.full(500, 7), "h1": rows, "h2": -rows, "copies": np.full(500, 2), "vec": pa.array(list(x[rows]), pa.list_(pa.float32())),
        "width": np.full(500, 20), "list": visited[rows, 0], "code": [codes[i].tobytes() for i in rows], "error": error[rows], "far": far[rows]})
    packed = embedding_pq._unpacked(embedding_pq._pack(tile).to_pylist()[0], index, np.float32)
    assert len(packed["keys"]) == 300 and (packed["keys"] >> 32 == 7).all() and packed["copies"].sum() == 1000
    assert sorted(map(tuple, packed["raw"][:, :20])) == sorted(map(tuple, x)) and (np.diff(packed["lists"]) >= 0).all()
    assert all(packed["radius"][k] == far[visited[:, 0] == g].max() for k, g in enumerate(packed["kinds"]))
    cosines = packed["unit"] @ packed["unit"].T
    assert (packed["sketch"] @ packed["sketch"].T >= cosines - 1e-6).all()
    mask = rnd.uniform(size=(37, 53)) < 0.01
    assert (embedding_pq._places(mask) == np.flatnonzero(mask)).all()


def test_tiles_meet_once_and_only_where_lists_reach():
    centroids = np.array([[1.0, 0], [0, 1], [-1, 0], [0, -1]], np.float32)
    index = embedding_pq.Index(centroids, np.zeros((1, 1, 2), np.float32), 2, np.eye(2))
    lists = [np.array(x, np.int32) for x in ([0], [0, 1], [2], [3], [])]
    wide = embedding_pq.partners(lists, [np.full(len(x), 1.5) for x in lists], index, 0.95)
    for i in range(4):
        assert wide[i][4] == wide[4][i] == "0"
        assert all((wide[i][j] == "1") + (wide[j][i] == "1") == (1 if i != j else 2) for j in range(4))
    tight = embedding_pq.partners(lists, [np.full(len(x), 0.1) for x in lists], index, 0.95)
    assert {(i, j) for i in range(5) for j in range(5) if tight[i][j] == "1"} in ({(0, 0), (1, 1), (2, 2), (3, 3), (0, 1)}, {(0, 0), (1, 1), (2, 2), (3, 3), (1, 0)})
