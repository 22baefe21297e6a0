"""Language ID by held-out accuracy; the mixture against a plain solver."""

import math
import random
import zlib
from collections import Counter, defaultdict

import pytest
import zstandard
from pyspark.sql import functions as F

from quarrymill.llm import language_id, mixing, queries

# --- language ----------------------------------------------------------------


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = queries.queries()["op1_language_id"](spark, folder).collect()
    assert len(rows) == len(lang)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
        assert r.lang_pred in set(lang.values())
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) / len(held) > 0.97
    assert sum(r.accepted for r in rows) / len(rows) > 0.97


def test_model_is_bounded_and_repeats(spark, folder):
    df = spark.read.parquet(f"{folder}/documents.parquet")
    bounds = language_id.Bounds(documents=5, dictionary=300, model=1000)
    model = language_id.fit(df, bounds=bounds)
    assert set(model) == {"en", "de", "fr", "es"} and all(len(d) <= 250 for d in model.values())
    assert model == language_id.fit(df.repartition(7), bounds=bounds)


def test_awkward_texts(make_docs):
    model = {"a": b"the cat sat on the mat and the dog", "b": b"der hund und die katze auf der matte"}
    df = make_docs([(1, None), (2, ""), (3, "123 !?"), (4, "the cat sat on the mat"), (5, "der hund und die katze"),
                    (6, "the cat and the dog " * 20_000), (6, "the cat sat on the mat"), (7, "ǂ")], {"language": F.lit(1), "_language": F.lit(2)})
    got = defaultdict(list)
    for r in df.select("doc_id", language_id.predict(F.col("text"), model).alias("r")).select("doc_id", "r.*").collect():
        got[r.doc_id].append(r)
    for i in (1, 2, 3):
        assert tuple(got[i][0])[1:] == ("und", 0.0, 0, False)
    assert got[4][0].lang_pred == "a" and got[5][0].lang_pred == "b" and all(r.lang_pred == "a" for r in got[6])
    assert got[7][0].lang_pred == "a" and not got[7][0].accepted  # a tie
    kept = language_id.accepted_only(df, model)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {4, 5, 6}


def test_no_labels_and_no_rows(make_docs):
    df = make_docs([(1, "abc")])
    assert language_id.fit(df) == {} and language_id.fit(make_docs([])) == {}
    assert language_id.accepted_only(df, {}).count() == 0


def some_words(language, n, seed):
    """``n`` characters in an invented language of 400 words; another ``seed`` gives another text in it."""
    rnd, pick = random.Random(language), random.Random(seed)
    vocabulary = ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randint(3, 9))) for _ in range(400)]
    return " ".join(pick.choice(vocabulary) for _ in range(n // 4))[:n]


def test_long_texts_are_judged_whole():
    model = {x: some_words(x, 120_000, 1).encode() for x in "ab"}
    a, b = some_words("a", 3_000_000, 2), some_words("b", 3_000_000, 3)
    for text, want in ((a[:200_000] + b, "b"), (b[:200_000] + a, "a"), (a, "a")):
        assert language_id.classify([text], model)[0][0] == want
    margins = [language_id.classify([a[:420_000] + tail], model)[0][2] for tail in (a, "")]
    assert margins[0] > 5 * margins[1]  # what comes after the head counts as well


def test_texts_in_no_known_language_are_rejected(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("length(text) > 0").collect()
    held = [r for r in rows if r.lang and zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and language_id.LETTER.search(r.text)]
    learned = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("crc32(cast(doc_id as string)) % 5 <> 0")
    model = language_id.fit(learned)
    accepted = lambda texts, known: sum(m[3] for m in language_id.classify(texts, known)) / len(texts)
    assert accepted([r.text for r in held], model) > 0.98
    for lang in model:
        others = {k: v for k, v in model.items() if k != lang}
        texts = [r.text for r in held if r.lang == lang][:200]
        assert accepted(texts, others) < 0.1
        assert accepted(texts, {lang: model[lang]}) > 0.9  # alone, the rival is no dictionary
    rnd = random.Random(4)
    for n in (50, 200, 5_000, 20_000, 200_000):
        noise = ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n)) for _ in range(50 if n < 10_000 else 10)]
        assert accepted(noise, model) <= 0.1
        if n >= 5_000:
            assert accepted(noise, model) == 0 and accepted(noise, {"en": model["en"]}) == 0


# --- mixture -----------------------------------------------------------------


def plain_targets(words, weights=(5, 2, 1), share=1.5):
    order = sorted(words, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, capped, rest = {}, set(), share * sum(words.values())
    while True:
        free = [s for s in order if s not in capped]
        if not free:
            break
        level = rest / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] > 2 * words[s]]
        if not over:
            target.update({s: level * weight[s] for s in free})
            break
        for s in over:
            capped.add(s)
            target[s] = 2.0 * words[s]
            rest -= target[s]
    return target


def check_mix(df):
    rows = [(r.doc_id, r.text, r.source) for r in df.collect()]
    size = lambda t: len([w for w in (t or "").translate({c: " " for c in range(9, 14)}).split(" ") if w])
    words, longest, docs = Counter(), Counter(), Counter((d, s, size(t)) for d, t, s in rows)
    for d, t, s in rows:
        words[s] += size(t)
        longest[s] = max(longest[s], size(t))
    target = plain_targets(words)
    got = mixing.mix(df).collect()
    assert Counter((r.doc_id, r.source, r.size) for r in got) == docs
    taken = Counter()
    for r in got:
        assert r.source_size == words[r.source] and math.isclose(r.target, target[r.source], rel_tol=1e-9, abs_tol=1e-9)
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 2
        taken[r.source] += r.taken
    for s in words:
        assert abs(taken[s] - target[s]) <= longest[s] / 2 + 1e-6, (s, taken[s], target[s])
    return got, taken, target


def test_mixture_meets_targets_on_a_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got, taken, target = check_mix(df)
    assert all(abs(taken[s] - target[s]) <= 0.01 * target[s] + 1 for s in target)
    again = mixing.mix(df.repartition(5)).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))


def test_rates_are_tilted_by_size_with_one_multiplier(spark):
    rnd = random.Random(1)
    sized = spark.createDataFrame(
        [(i, "a" if i % 3 else "b", rnd.randrange(1, 400)) for i in range(3000)], "doc_id long, source string, size long")
    goals = mixing.targets(sized).cache()
    names = goals.select(F.col("source").alias("s"), "rank")
    cells = sized.join(names, F.col("source") == F.col("s")).groupBy("rank", "size").agg(F.count("*").alias("n"))
    solved = {r["rank"]: r for r in mixing.multipliers(cells, goals).collect()}
    for g in goals.collect():
        lam, full = solved[g["rank"]].lam, solved[g["rank"]].full
        sizes = [(r["size"], r["n"]) for r in cells.where(F.col("rank") == g["rank"]).collect()]
        got = sum(n * s * (2 if full else min(2, math.exp(lam * s))) for s, n in sizes)
        assert math.isclose(got, g.target, rel_tol=1e-7)


def test_mixture_of_awkward_rows(make_docs):
    rows = [(1, None, None, "z"), (2, "", None, "z"), (3, " \t", None, None), (4, "a b c", None, None), (4, "a b c", None, None),
            (None, "a b", None, "é"), (None, None, None, None), (5, "w " * 9000, None, "Z"), (6, "a\x1cb", None, "")]
    rows += [(10 + i, "q " * 40, None, "hot") for i in range(60)]
    check_mix(make_docs(rows, {"size": F.lit(1), "rank": F.lit("x")}))


def test_hot_cells_are_numbered_in_parts(spark):
    sized = spark.createDataFrame([(i, "ab"[i % 10 == 0], 7 if i % 2 else i % 50) for i in range(2000)],
                                  "doc_id long, source string, size long")
    got = mixing.mix_sized(sized, mixing.Plan(cell_rows=20)).collect()
    sums = defaultdict(int)
    for r in got:
        sums[r.source, r.target] += r.taken
    assert len(got) == 2000 and all(abs(v - t) <= 25 for (_, t), v in sums.items())


def test_mixture_of_nothing(make_docs):
    assert mixing.mix(make_docs([])).count() == 0
    rows = mixing.mix(make_docs([(1, None), (2, "")])).collect()
    assert [(r.target, r.taken) for r in rows] == [(0, 0)] * 2


def test_repeat_rows_takes_what_the_mix_says(make_docs):
    rows = [(i, "a b c " * (i % 9), "en", f"s{i % 4}") for i in range(200)]
    df = make_docs(rows, {"_times": F.lit(1), "copies": F.lit(9)})
    want = {r.doc_id: r.copies for r in mixing.mix(df).collect() if r.copies}
    got = mixing.repeat_rows(df)
    assert got.columns == df.columns and Counter(r.doc_id for r in got.collect()) == want


def test_texts_meet_a_table_of_cells(make_docs, spark):
    rows = [(i, f"t{i} " * (1 + i % 3), None, None if i % 5 == 0 else "ab"[i % 7 == 0]) for i in range(5000)]
    df, plan = make_docs(rows), mixing.Plan(cell_rows=400)  # most cells are dealt into salts
    want = {r.doc_id: r.copies for r in mixing.mix(df, plan=plan).collect() if r.copies}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "32k")  # less than a table of all ids
    try:
        got = mixing.repeat_rows(df, plan=plan)
        assert Counter(r.doc_id for r in got.collect()) == want and 1 in want.values() and 2 in want.values()
        assert "hashpartitioning" not in got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_mixture_stays_in_the_jvm(make_docs):
    plan = mixing.mix(make_docs([(1, "a b", "en", "s")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("weights", [(5, 2, 1), (1,)])
def test_targets_of_many_sources(spark, weights):
    rnd = random.Random(4)
    rows = [(i, f"s{i % 97:03d}" if i % 97 else None, rnd.randrange(0, 30) ** 2) for i in range(1500)]
    words = Counter()
    for _, s, n in rows:
        words[s] += n
    got = mixing.targets(spark.createDataFrame(rows, "doc_id long, source string, size long"), mixing.Plan(weights=weights))
    want = plain_targets(words, weights)
    assert {r.source: pytest.approx(r.target) for r in got.collect()} == want


def test_rows_that_share_an_id_keep_the_sum_of_their_copies(make_docs):
    rnd = random.Random(6)
    rows = [(None if i % 2 else i % 7, "w " * rnd.randrange(1, 30) + str(i), None, rnd.choice("abc")) for i in range(300)]
    rows += [(100 + i, "v " * rnd.randrange(1, 30), None, rnd.choice("abc")) for i in range(100)]
    df = make_docs(rows)
    want, took = Counter(), Counter()
    for r in mixing.mix(df).collect():
        want[r.doc_id, r.source, r.size] += r.copies
    again = Counter(map(tuple, mixing.repeat_rows(df).collect()))
    for (d, text, _, source, _), n in again.items():
        took[d, source, len(text.split())] += n
    assert +want == took and any(d is None for d, _, _ in took)
    assert max(n for r, n in again.items() if r[0] is None) <= 2


def test_a_model_learns_from_distinct_texts_alone(make_docs):
    texts = {"a": [f"alpha number {i} and {i * 7}" for i in range(30)], "b": [f"beta {i * 3} or {i}" for i in range(30)]}
    rows = [(0, t, lang) for lang, found in texts.items() for t in found]
    one = language_id.fit(make_docs(rows))
    more = [(i, t, lang) for i, (_, t, lang) in enumerate(rows * 3)] + [(5_000 + i, "copied " * 9, "a") for i in range(2_000)]
    two = language_id.fit(make_docs(more + [(None, None, "a"), (None, "", "b"), (1, "no label", None)]))
    lines = lambda data: sorted(data.decode().split("\n"))
    assert lines(one["a"]) == sorted(texts["a"]) and lines(one["b"]) == lines(two["b"]) == sorted(texts["b"])
    assert lines(two["a"]) == sorted([*texts["a"], "copied " * 9])


def test_slices_of_long_texts_begin_anywhere_and_dictionaries_are_bounded(make_docs):
    rows = [(i, "".join(f"{i:03d}-{j:05d} " for j in range(2_000)), "a") for i in range(40)]
    model = language_id.fit(make_docs(rows), bounds=language_id.Bounds(documents=30, chars=100, dictionary=5_000))
    slices = model["a"].decode().split("\n")
    assert len(slices) == 30 and all(len(x) == 100 for x in slices)
    assert sum("-00000 " in x for x in slices) < 5
    small = language_id.fit(make_docs(rows), bounds=language_id.Bounds(documents=30, chars=100, dictionary=250))
    assert len(small["a"]) == 250 and model["a"].startswith(small["a"])


def test_predictions_equal_plain_compression(spark, folder):
    """Whole texts in blocks, each with the dictionary afresh: no cached encoders, no UDF."""
    rows = spark.read.parquet(f"{folder}/documents.parquet").where("text is not null")
    model = language_id.fit(rows)
    bounds = language_id.Bounds()

    def size(text: str, known: bytes) -> int:
        data, total = text.lower().encode(), 0
        for i in range(0, len(data), 1 << 16):
            settings = zstandard.ZstdCompressionParameters.from_level(
                bounds.level, source_size=4_000, dict_size=len(known), write_content_size=False, write_dict_id=False)
            words = zstandard.ZstdCompressionDict(known, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            words.precompute_compress(compression_params=settings)
            total += len(zstandard.ZstdCompressor(compression_params=settings, dict_data=words).compress(
                b"\n" * 64 + data[i:i + (1 << 16)]))
        return total

    got = rows.select("text", language_id.predict(F.col("text"), model).alias("r")).select("text", "r.*").limit(60).collect()
    for r in got:
        if not any(c.isalpha() for c in r.text):
            assert (r.lang_pred, r.accepted) == ("und", False)
            continue
        (best, lang), (second, _) = sorted((size(r.text, known), lang) for lang, known in model.items())[:2]
        assert (r.lang_pred, r.margin) == (lang, second - best)
        assert r.accepted == (second - best >= max(1, 0.03 * best))
