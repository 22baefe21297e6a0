"""SimHash, line dedup and MinHash against brute force, and on the awkward rows."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from quarrymill.llm import common, line_dedup, minhash, queries, simhash

AWKWARD = [
    (1, None), (2, ""), (3, " \t\n\r"), (4, "a b c d"), (4, "a b c d"), (None, "a b c d"), (None, None),
    (5, "One two three four five six"), (6, "one TWO three four five six"), (7, "É é ß\x1c x"), (8, "x" * 70_000),
    (9, "w " * 40_000), (10, "one"),
]


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def plain_simhash(text):
    w = words(text)
    if not w:
        return 0
    grams = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))]
    hashes = [xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, prints, distance=2):
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            r = find(i)
            least[r] = min(d, least.get(r, d))
    return [least.get(find(i)) for i in range(len(ids))]


def check_simhash(df):
    rows = [(r.doc_id, r.text) for r in df.collect()]
    prints = [plain_simhash(t) for _, t in rows]
    want = Counter(zip([d for d, _ in rows], (f"{p:016x}" for p in prints), plain_components([d for d, _ in rows], prints)))
    got = simhash.near_duplicates(df).select("doc_id", simhash.hex_digits(F.col("fp")).alias("f"), "component_id")
    assert Counter(map(tuple, got.collect())) == want


def test_simhash_equals_brute_force_on_awkward_rows(make_docs):
    check_simhash(make_docs(AWKWARD, {"fp": F.lit("x"), "root": F.lit(1), "component_id": F.lit(2)}))


def test_simhash_equals_brute_force_on_a_table(spark, folder):
    check_simhash(spark.read.parquet(f"{folder}/documents.parquet"))


def test_simhash_of_an_empty_table(make_docs):
    assert simhash.near_duplicates(make_docs([])).count() == 0


@pytest.mark.parametrize("block_pairs", [1, 8, 1000])
def test_links_of_crowded_blocks_have_the_same_closure(spark, block_pairs):
    rnd = random.Random(3)
    base = [rnd.getrandbits(64) for _ in range(6)]
    prints = set(base)
    for b in base[:3]:
        for _ in range(60):  # chains of small steps, all in shared blocks
            x = rnd.choice([b, rnd.choice(sorted(prints))])
            for _ in range(rnd.choice([1, 2, 3])):
                x ^= 1 << rnd.randrange(64)
            prints.add(x)
    prints = sorted(prints)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    df = spark.createDataFrame(signed, "fp long")
    found = common.components(simhash.links(df, block_pairs=block_pairs))
    root = {r.node & (1 << 64) - 1: r.root & (1 << 64) - 1 for r in found.collect()}
    want = plain_components(list(range(len(prints))), prints)
    got = {}
    for i, p in enumerate(prints):
        got.setdefault(root.get(p, p), set()).add(i)
    expected = {}
    for i, r in enumerate(want):
        expected.setdefault(r, set()).add(i)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, expected.values()))


def test_majority_of_many_hashes():
    rnd = np.random.default_rng(1)
    sizes = [0, 1, 2, 255, 256, 1000, 0, 3]
    hashes = [rnd.integers(0, 1 << 64, n, dtype=np.uint64) for n in sizes]
    got = simhash.majority(np.concatenate(hashes), np.cumsum(sizes))
    for h, g in zip(hashes, got.tolist()):
        want = sum(1 << b for b in range(64) if len(h) and 2 * sum(int(x) >> b & 1 for x in h) > len(h))
        assert g == want


def test_keep_one_keeps_columns_and_one_row_of_each(make_docs):
    df = make_docs(AWKWARD, {"_near_id": F.lit(1)})
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, 4, 5, 7, 8, 9, 10])


def test_keep_one_writes_no_texts(make_docs, monkeypatch):
    tables = {}
    monkeypatch.setattr(simhash, "written", lambda df, label: tables.update({label: df.columns}) or common.written(df, label))
    rows = [(1, "a b c d"), (1, "A b c d"), (1, "A b c d"), (2, "a b c d"), (3, None), (3, ""), (None, " "), (None, "x y z"), (4, "")]
    kept = simhash.keep_one(make_docs(rows)).collect()
    assert tables and not any("text" in columns for columns in tables.values())
    assert Counter(r.doc_id for r in kept) == Counter([1, 3, None])
    assert all(r.doc_id is not None or r.text == "x y z" for r in kept)


@pytest.mark.parametrize("n", [2, 33, 200])
def test_components_of_chains_stars_and_cycles(spark, n):
    rnd = random.Random(n)
    names = rnd.sample(range(-500, 500), 3 * n)
    chain, star, ring = names[:n], names[n:2 * n], names[2 * n:]
    edges = list(zip(chain, chain[1:])) + [(star[0], x) for x in star[1:]] + list(zip(ring, ring[1:] + ring[:1]))
    rnd.shuffle(edges)
    got = common.components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {tuple(r) for r in got} == {(x, min(g)) for g in (chain, star, ring) for x in g}
    assert len(got) == 3 * n


def test_components_without_edges(spark):
    assert common.components(spark.createDataFrame([], "u long, v long")).count() == 0
    assert common.components(spark.createDataFrame([(1, 1)], "u long, v long")).count() == 0


# --- lines -------------------------------------------------------------------

def line_key(line):
    low = line.strip(" \t\n\x0b\x0c\r")
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in low)


def plain_lines(rows, least):
    seen = Counter(k for _, t in rows for k in {line_key(x) for x in (t or "").split("\n")} if k)
    out = []
    for d, t in rows:
        all_lines = (t or "").split("\n")
        kept = [x for x in all_lines if seen[line_key(x)] < least]
        out.append((d, "\n".join(kept), len(all_lines), len(all_lines) - len(kept)))
    return Counter(out)


def test_line_dedup_equals_brute_force(make_docs):
    rows = AWKWARD + [(100 + i, f"Same Line \r\nown {i}\n\n\xa0Same line\nsame line\nÉ\n{'rare' if i < 3 else 'often'}") for i in range(12)]
    df = make_docs(rows, {"kept": F.lit(1), "h": F.lit(2), "_doomed": F.lit(3), "id": F.lit(4)})
    got = line_dedup.dedup(df, min_documents=4, outputs=("k", "a", "b")).select("doc_id", "k", "a", "b").collect()
    assert Counter(map(tuple, got)) == plain_lines(rows, 4)
    assert line_dedup.dedup(df, outputs=("k", "a", "b")).columns == [*df.columns, "k", "a", "b"]


def test_replace_text_keeps_every_row(make_docs):
    rows = [(i, "shared\nown %d" % i) for i in range(11)] + [(None, None), (50, "")]
    got = line_dedup.replace_text(make_docs(rows))
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert Counter((r.doc_id, r.text, r.n_chars) for r in got.collect()) == Counter(
        [(i, f"own {i}", len(f"own {i}")) for i in range(11)] + [(None, None, None), (50, "", 0)])


def test_line_dedup_of_an_empty_table(make_docs):
    assert line_dedup.dedup(make_docs([])).count() == 0


# --- minhash -----------------------------------------------------------------

M = (1 << 64) - 1


def shingle_set(text):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", text.lower()) if x]
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def next_rows(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    return list(zip(order, order[1:] + order[:1]))


@pytest.mark.parametrize("rows_per_chunk", [2, 10_000])
def test_edited_texts_equal_brute_force(make_docs, rows_per_chunk):
    rnd = random.Random(2)
    rows = AWKWARD + [
        (20 + 7 * i, " ".join(rnd.choice("abcdefgh") for _ in range(i))) for i in range(40)]
    got = minhash.compare_edited(make_docs(rows, {"bins": F.lit(1), "chunk": F.lit(1)}), rows_per_chunk=rows_per_chunk)
    want = Counter()
    for (d, t), (_, n) in next_rows(rows):
        t, n = t or "", n or ""
        k = len(t) // 4
        want[d, len(t), hashlib.sha256((t[:len(t) - k] + n[:k]).encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got.collect()) == want


def test_likeness_is_close_to_the_real_one(spark, folder):
    df = spark.read.parquet(f"{folder}/documents.parquet")
    texts = {r.doc_id: r.text for r in df.collect()}
    got = queries.queries()["op9_minhash"](spark, folder).collect()
    ids = sorted(texts)
    following = dict(zip(ids, ids[1:] + ids[:1]))
    errors, prints = [], {}
    for r in got:
        a, n = texts[r.doc_id], texts[following[r.doc_id]]
        k = len(a) // 4
        for other, near in ((a[:len(a) - k] + n[:k], r.near_edited), (n, r.near_next)):
            x, y = shingle_set(a), shingle_set(other)
            errors.append(near - len(x & y) / max(1, len(x | y)))
        assert prints.setdefault(a, r.fingerprint) == r.fingerprint
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    errors = np.array(errors)
    assert abs(errors.mean()) < 0.01 and np.abs(errors).mean() < 0.03 and np.abs(errors).max() < 0.2


def test_empty_bins_are_filled_alike_for_equal_sets_and_evenly(spark):
    """Few shingles: most bins are empty, and still the likeness has no bias."""
    rnd = random.Random(5)
    rows = []
    for i in range(300):
        pool = [f"{i} {j} a b c" for j in range(8)]
        rows.append((i, " ".join(pool[:6]), " ".join(pool[2:])))
    df = spark.createDataFrame(rows, "i int, a string, b string")
    near = df.select("a", "b", minhash.likeness(minhash.bins(F.col("a")), minhash.bins(F.col("b"))).alias("n")).collect()
    errors = [r.n - len(shingle_set(r.a) & shingle_set(r.b)) / len(shingle_set(r.a) | shingle_set(r.b)) for r in near]
    assert abs(np.mean(errors)) < 0.03


def test_fingerprints_of_texts_without_words(spark):
    df = spark.createDataFrame([("",), (" \n",), ("one",)], "t string").withColumn("b", minhash.bins(F.col("t")))
    empty, blank, one = [r.b for r in df.collect()]
    assert empty == blank == [0] * minhash.BINS and len(set(one)) == 1


def test_minhash_of_an_empty_table_and_of_one_row(make_docs):
    assert minhash.compare_edited(make_docs([])).count() == 0
    row, = minhash.compare_edited(make_docs([(1, "a b c d e f g h")])).collect()
    assert row.near_next == 1


def test_minhash_stays_in_the_jvm(make_docs):
    plan = minhash.compare_edited(make_docs([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_rows_without_an_id_have_lists_of_their_own(make_docs):
    rows = [(None, f"common {i % 3}\nown {i}\ncommon {i % 2 + 5}") for i in range(40)] + [(7, f"common 1\nalso {i}") for i in range(12)]
    df = make_docs(rows, {"tag": F.lit("x"), "mine": F.lit(1)})
    got = line_dedup.dedup(df, min_documents=10)
    assert sorted(r.kept for r in got.collect()) == sorted(
        [f"own {i}" for i in range(40)] + [f"also {i}" for i in range(12)])
    assert {(r.n_lines, r.n_dropped) for r in got.collect()} == {(3, 2), (2, 1)} and got.columns[:len(df.columns)] == df.columns
