"""Ranked search, the prefix trie and the language model against plain forms."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarrymill.llm import hpy_model, lexical_search, prefix_trie

ITEM = "item_id long, text string"
TURN = "conv_id long, turn long, role string, text string"


# ---- ranked search ---------------------------------------------------------

def plain_search(docs, items, top):
    lower = str.maketrans({c: c + 32 for c in range(65, 91)})
    found = [(i, Counter(re.findall(lexical_search.TERM, (t or "").translate(lower)))) for i, t in docs]
    found = [(i, c) for i, c in found if c]
    n_docs, total = len(found), sum(sum(c.values()) for _, c in found)
    df = Counter(w for _, c in found for w in c)
    out = []
    for item in sorted({i for i, _ in items if i is not None}):
        terms = {w for i, t in items if i == item for w in re.findall(lexical_search.TERM, (t or "").translate(lower))}
        scores = []
        for doc, c in found:
            m = 50 + 50 * sum(c.values()) * n_docs // total
            scores.append((-sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (10**9 * c[w] // (1000 * c[w] + 20 * m))
                for w in terms if c[w]), doc if doc is not None else -math.inf))
        ranked = sorted(s for s in scores if s[0] < 0)[:top]
        out += [(item, r + 1, None if d == -math.inf else d, -s) for r, (s, d) in enumerate(ranked)]
    return out


@pytest.mark.parametrize("top,partners", [(3, 4), (10, 1), (50, 4)])
def test_search_equals_a_plain_one(spark, make_docs, top, partners):
    rng = random.Random(top)
    common, rare = ["the", "of", "and", "to"], [f"w{i}" for i in range(40)]
    texts = [" ".join(rng.choice(common if rng.random() < 0.7 else rare) for _ in range(rng.randint(1, 40))) for _ in range(150)]
    docs = [(i, t) for i, t in enumerate(texts)] + [(200 + i, "The w1, w2! of") for i in range(60)]  # a group of copies
    docs += [(900, None), (901, ""), (902, " -- "), (None, "w1 w2 w3"), (903, "É w1 ﬀ"), (903, "É w1 ﬀ")]
    items = [(1, "the of w1 w2 w3"), (2, "and to to w7"), (3, None), (4, "nobody says this"), (5, "É the"), (5, "w9"),
             (None, "the"), (6, " ".join(common + rare))]
    df = make_docs(docs, {"term": F.lit("x"), "row": F.lit(1)})
    got = lexical_search.search(df, spark.createDataFrame(items, ITEM), top, partners)
    assert sorted((r.item_id, r["rank"], r.doc_id, r.score) for r in got.collect()) == plain_search(docs, items, top)


def test_search_of_empty_tables(spark, make_docs):
    items = spark.createDataFrame([(1, "a b")], ITEM)
    assert lexical_search.search(make_docs([]), items).count() == 0
    assert lexical_search.search(make_docs([(1, "a b c")]), items.limit(0)).count() == 0
    assert lexical_search.search(make_docs([(1, None)]), items).count() == 0


def test_a_very_long_text_is_searched_whole(spark, make_docs):
    docs = [(1, "a " * 300_000 + "needle"), (2, "a b"), (3, "b")]
    got = lexical_search.search(make_docs(docs), spark.createDataFrame([(1, "needle")], ITEM)).collect()
    assert [r.doc_id for r in got] == [1]


# ---- prefix trie -----------------------------------------------------------

def plain_trie(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", hashlib.sha256((text or "").encode()).hexdigest(), text or ""))
    own = {c: [(r, x) for _, _, r, _, x in sorted(ts)] for c, ts in own.items()}
    made = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        made[c] = own.get(c - int(math.fmod(c, 5)), [])[:h] + own[c][h:]
    members = {}
    for c, ts in made.items():
        for d in range(len(ts) + 1):
            members.setdefault(tuple(ts[:d]), []).append(c)
    out = []
    for path, cs in members.items():
        below = [p for p in members if p[:len(path)] == path]
        children = [p for p in below if len(p) == len(path) + 1]
        leaves = [p for p in below if not any(len(q) == len(p) + 1 and q[:len(p)] == p for q in below)]
        ends = sorted(c for c in cs if len(made[c]) == len(path))
        out.append((
            min(cs), len(path), min(members[path[:-1]]) if path else None, len(cs), len(children), len(leaves),
            sum((len(members[p]) - 1) * (len(p[-1][1].encode()) if p else 0) for p in below),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=repr)


def trie_rows(df, **options):
    got = prefix_trie.conversation_trie(df, **options).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted(map(tuple, got.collect()), key=repr)


@pytest.mark.parametrize("options", [{}, {"width": 2, "scan": 2, "ids_per_chunk": 2}, {"width": 3, "scan": 1, "ids_per_chunk": 1}])
def test_trie_equals_a_plain_one(spark, options):
    rng = random.Random(7)
    rows = []
    for c in [*range(-3, 40), 10**12]:
        for k in range(rng.choice([1, 2, 3, 5, 9, 17])):
            rows.append((c, k, rng.choice(["user", "bot"]), rng.choice(["hi", "é", "", None])))
    rows += [(41, None, None, "first"), (41, 0, "user", "a"), (41, 0, "user", "b"), (41, 0, "user", "a"), (None, 1, "user", "x")]
    df = spark.createDataFrame(rows, TURN).withColumn("block", F.lit(3)).withColumn("t1", F.lit("x")).repartition(3)
    assert trie_rows(df, **options) == plain_trie(rows)


def test_trie_of_copies_and_of_an_empty_table(spark):
    rows = [(c, k, "user", "x" * k) for c in range(60) for k in range(4)]
    assert trie_rows(spark.createDataFrame(rows, TURN), ids_per_chunk=7) == plain_trie(rows)
    assert prefix_trie.conversation_trie(spark.createDataFrame([], TURN)).count() == 0


# ---- language model --------------------------------------------------------

def scored(docs, settings=hpy_model.Settings(), **options):
    held = F.coalesce(F.col("doc_id") % 3 == 2, F.lit(False))
    model = hpy_model.fit(docs.where(~held), settings, **options)
    return model, hpy_model.score(docs, model, held)


def plain_words(text):
    return (text or "").encode().translate(hpy_model._LOWER).split() + [b""]


def corpus(seed=1, n=120):
    rng = random.Random(seed)
    next_word = {w: rng.sample([f"w{i}" for i in range(60)], 5) for w in [f"w{i}" for i in range(60)]}
    rows = []
    for i in range(n):
        w, out = "w0", []
        for _ in range(rng.randint(3, 60)):
            w = rng.choice(next_word[w])
            out.append(w.upper() if rng.random() < 0.1 else w)
        rows.append((i, " ".join(out)))
    return rows


def test_base_score_and_counts_equal_plain_ones(make_docs):
    rows = corpus() + [(200, None), (201, ""), (203, " \t"), (205, "never seen words")]
    rows += [(206, rows[0][1]), (206, rows[0][1])]
    _, got = scored(make_docs(rows, {"bucket": F.lit(1), "payload": F.lit("x")}))
    train = Counter(w for i, t in rows if i % 3 != 2 for w in plain_words(t))
    n, v = sum(train.values()), len(train)
    want = Counter()
    for i, t in rows:
        words = plain_words(t)
        base = sum(math.log10((train[w] + 1) / (n + v + 1)) for w in words)
        want[i, i % 3 == 2, len(words), sum(train[w] > 0 for w in words), round(base, 6)] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got.collect()) == want


def test_model_beats_the_base_on_texts_it_has_not_seen(make_docs):
    _, got = scored(make_docs(corpus(n=300)))
    found = {r.held_out: r for r in hpy_model.perplexity(got).collect()}
    assert found[True].perplexity < 0.5 * found[True].base_perplexity


def test_probabilities_of_a_context_add_up(spark, make_docs):
    """Every known word and one unknown, each after one and the same word."""
    rows = corpus(n=60)
    train = make_docs(rows)
    model = hpy_model.fit(train)
    words = sorted({w for _, t in rows for w in plain_words(t) if w}) + [b"unseen"]
    first = "w3"
    probes = make_docs([(i, f"{first} {w.decode()}") for i, w in enumerate(words)] + [(len(words), first)])
    alone = {r.doc_id: r.score for r in hpy_model.score(probes, model, F.lit(True)).collect()}
    counts, seats = {r.bucket: r.payload for r in model.counts.collect()}, [{r.bucket: r.payload for r in s.collect()} for s in model.samples]
    parts = {"totals": model.totals, "customers": model.context_customers, "tokens": model.tokens, "words": model.words, "settings": model.settings}

    def p(word, context):
        b = hpy_model.xxh32_intdigest(word) % model.buckets
        bucket = hpy_model._Bucket(counts.get(b), [s[b] for s in seats] if b in counts else [], parts)
        data = hpy_model._pack(word, np.array([1]), np.array([context], np.uint16), np.array([0], np.uint8))
        return 10 ** hpy_model._unpack(bucket.sums(data))[3][0]

    after = 1 + zlib.crc32(first.encode()) % (model.settings.contexts - 1)
    assert sum(p(w, after) for w in [*words, b""]) == pytest.approx(1, abs=1e-9)
    assert sum(p(w, 0) for w in [*words, b""]) == pytest.approx(1, abs=1e-9)
    for i, w in enumerate(words[:5]):
        context = 1 + zlib.crc32(w) % (model.settings.contexts - 1)
        whole = p(first.encode(), 0) * p(w, after) * p(b"", context)
        assert alone[i] == pytest.approx(math.log10(whole))


def test_slices_buckets_and_salts_do_not_change_counts(make_docs, monkeypatch):
    rows = corpus(n=80)
    docs = make_docs(rows)
    _, plain = scored(docs, settings=hpy_model.Settings(sweeps=1, burn=0))
    monkeypatch.setattr(hpy_model, "HELD_IN_MEMORY", 4)
    _, cut = scored(docs, settings=hpy_model.Settings(sweeps=1, burn=0), buckets=3, salts=4)
    key = lambda d: sorted((r.doc_id, r.n_known, round(r.base_score, 6)) for r in d.collect())
    assert key(plain) == key(cut)


def test_reseating_follows_the_seating_rule():
    """The number of tables of three customers, over many sweeps, against its exact distribution."""
    rng = np.random.default_rng(3)
    n, d, a = 4_000, 0.4, 0.7
    sizes, tables = np.full(n, 3), np.ones(n, np.int64)
    for _ in range(12):
        sizes, tables = hpy_model.reseat(sizes, tables, np.full(n, 3), np.full(n, a), d, 16, rng)
        assert sizes.sum() == 3 * n and tables.sum() == len(sizes)
    # weights of the seatings of three customers when a new table always weighs ``a``
    weight = {1: a * (1 - d) * (2 - d), 2: 3 * a * a * (1 - d), 3: a**3}
    for t, w in weight.items():
        assert abs((tables == t).mean() - w / sum(weight.values())) < 0.04


def test_customers_come_and_go():
    rng = np.random.default_rng(4)
    have, want = np.array([5, 40, 3, 1_000]), np.array([9, 2, 3, 5_000])
    sizes, tables = hpy_model.reseat(have.copy(), np.ones(4, np.int64), want, np.full(4, 2.0), 0.5, 8, rng)
    starts = np.cumsum(tables) - tables
    assert np.add.reduceat(sizes, starts).tolist() == want.tolist() and (sizes > 0).all()


def seating_shares(n, d, a):
    """Exact shares of the numbers of tables of ``n`` customers when a new table always weighs ``a``."""
    ways = {1: 1.0}
    for i in range(1, n):
        ways = {t: ways.get(t - 1, 0.0) * a + ways.get(t, 0.0) * (i - t * d) for t in range(1, i + 2)}
    return {t: x / sum(ways.values()) for t, x in ways.items()}


def test_a_sweep_moves_every_customer_of_a_large_dish():
    """Dishes of 60 that start at one table come to the exact shares of 1, 2, ... tables by whole sweeps."""
    assert hpy_model.Settings().moves is None
    rng = np.random.default_rng(5)
    n, d, a = 3_000, 0.4, 2.0
    sizes, tables = np.full(n, 60), np.ones(n, np.int64)
    for _ in range(30):
        sizes, tables = hpy_model.reseat(sizes, tables, np.full(n, 60), np.full(n, a), d, hpy_model.Settings().moves, rng)
    assert np.add.reduceat(sizes, np.cumsum(tables) - tables).tolist() == [60] * n
    for t, share in seating_shares(60, d, a).items():
        assert abs((tables == t).mean() - share) < 0.03


def test_model_of_nothing(make_docs):
    _, got = scored(make_docs([]))
    assert got.count() == 0
    _, got = scored(make_docs([(2, "only held out")]))
    row = got.first()
    assert (row.n_tokens, row.n_known, row.base_score, row.score) == (4, 0, 0.0, 0.0)


def test_a_very_long_text_and_a_rerun(make_docs):
    docs = make_docs([(0, "a b " * 100_000), (1, "a b"), (2, "a b a b")])
    one, two = (sorted(tuple(r) for r in scored(docs)[1].collect()) for _ in range(2))
    assert one == two and one[0][2] == 200_001
