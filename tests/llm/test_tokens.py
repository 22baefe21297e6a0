"""Token counts against the tokenizers library; records by exact round trip."""

import random
import struct
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.models import Unigram

from quarrymill.llm import queries, token_counts, token_records

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD = [None, "", " ", "  a  b ", "a\n\nb\tc", "\n", "Ünïcödé 漢字 \U0001F600!", "x" * 5000, "don't we're I'LL", "é ̸= ≮",
       "<|endoftext|> a<|startoftext|>b", "a b c\x1cd\x85e", "İstanbul ΣΑΣ ﬁ ǅ", "3.14159 2,000", "''s 'S 'ſ", "﻿a​b", "ÀÉß×÷ÿ", "no\rlines\x0bat\x0call"]

# --- counts ------------------------------------------------------------------


def library(vocabulary):
    """The tokenizers library's unigram model of the same pieces, with byte fallback."""
    full = [("<unk>", 0.0), *((f"<0x{b:02X}>", 0.0) for b in range(256)), *vocabulary]
    least = min(s for _, s in vocabulary)
    full = [(p, least if i <= 256 else s) for i, (p, s) in enumerate(full)]  # they must not lower the least score
    return Tokenizer(Unigram(full, unk_id=0, byte_fallback=True))


def marked(text):
    return token_counts.MARK + text.replace(" ", token_counts.MARK) if text else ""


def test_counts_equal_the_library_on_a_table(spark, folder):
    vocabulary = token_counts.piece_file(PIECES)
    exact = library(vocabulary)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for r in queries.queries()["op5_token_counts"](spark, folder).collect():
        assert r.n_tokens == len(exact.encode(marked(texts[r.doc_id])).ids), texts[r.doc_id][:80]


def test_counts_of_odd_texts(make_docs):
    exact = library(token_counts.piece_file(PIECES))
    texts = [t for t in ODD if not t or "<|" not in t]
    df = make_docs(list(enumerate(texts)), {"n_tokens": F.lit(1)})
    got = {r.doc_id: r.r for r in df.select("doc_id", token_counts.token_counts(F.col("text"), PIECES).alias("r")).collect()}
    for i, t in enumerate(texts):
        assert got[i].n_tokens == len(exact.encode(marked(t)).ids), t
    assert got[0] == got[1] and got[0].score == 0


@pytest.mark.parametrize("seed", range(8))
def test_ties_and_unknown_characters_follow_the_library(seed):
    rnd = random.Random(seed)
    letters = "ab▁c"
    vocabulary = {"".join(rnd.choice(letters) for _ in range(rnd.randrange(1, 5))): -float(rnd.randrange(1, 5)) for _ in range(25)}
    vocabulary.pop("c", None)
    vocabulary = sorted(vocabulary.items())
    exact, own = library(vocabulary), token_counts.Counter(vocabulary)
    for _ in range(300):
        text = "".join(rnd.choice("ab c\né") for _ in range(rnd.randrange(1, 30)))
        assert own.count(text)[0] == len(exact.encode(marked(text)).ids), text


def test_every_segmentation_is_beaten_or_equal():
    vocabulary = [("a", -3.0), ("b", -2.0), ("ab", -4.0), ("aba", -7.0), ("ba", -5.0), ("▁", -1.0)]
    own = token_counts.Counter(vocabulary)
    score = dict(vocabulary)

    def ways(s):
        if not s:
            yield 0.0
        for n in range(1, len(s) + 1):
            if s[:n] in score:
                yield from (score[s[:n]] + w for w in ways(s[n:]))

    for text in ("a", "abab", "babaab", "aababba"):
        assert own.count(text)[1] == max(ways("▁" + text))


def test_no_vocabulary():
    assert token_counts.Counter([]).count("ab") == (len("▁ab".encode()), -30.0)


# --- records -----------------------------------------------------------------


def plain_crc32c(data):
    crc = 0xFFFFFFFF
    for byte in data:
        crc ^= byte
        for _ in range(8):
            crc = (crc >> 1) ^ (0x82F63B78 if crc & 1 else 0)
    return crc ^ 0xFFFFFFFF


def test_checksum_equals_the_definition():
    assert token_records.crc32c([b"123456789"])[0] == 0xE3069283
    rnd = random.Random(1)
    data = [rnd.randbytes(n) for n in (4, 5, 255, 256, 257, 511, 512, 513, 3000, 8)]
    assert token_records.crc32c(data).tolist() == [plain_crc32c(d) for d in data]


def expected(rows):
    exact = Tokenizer.from_file(WORDS)
    start, out = 0, []
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = exact.encode(t or "", add_special_tokens=False).ids + [1]
        out.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return Counter(out)


def test_round_trip_of_a_table(spark, folder):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert Counter(map(tuple, queries.queries()["op7_token_records"](spark, folder).collect())) == expected(rows)


def test_round_trip_of_odd_texts(make_docs):
    rows = [*enumerate(ODD), (None, "no id"), (None, None), (3, "again"), (3, "again"), (-5, "first")]
    index = token_records.write_records(make_docs(rows, {"shard": F.lit("x"), "file": F.lit(1)}), WORDS, end_id=1)
    got = token_records.digests(index, 2).collect()
    assert Counter(map(tuple, got)) == expected(rows)


def test_shuffled_reads_and_broken_files(make_docs):
    rows = [(i, f"text number {i} " * (i % 7)) for i in range(60)]
    index = token_records.write_records(make_docs(rows), WORDS, end_id=1)
    exact = Tokenizer.from_file(WORDS)
    wanted = index.where("doc_id % 3 = 1").orderBy(F.rand(1))
    got = {r.doc_id: r.ids for r in token_records.read_at(wanted, 2).collect()}
    assert got == {i: exact.encode(t).ids + [1] for i, t in rows if i % 3 == 1}
    entry = index.orderBy("doc_id").first()
    path = entry.file.removeprefix("file://")
    with open(path, "r+b") as f:
        head = struct.unpack("<Q", f.read(8))[0]
        assert head + 16 == entry.length
        f.seek(20)
        byte = f.read(1)
        f.seek(20)
        f.write(bytes([byte[0] ^ 1]))
    with pytest.raises(Exception, match="checksum"):
        token_records.digests(index, 2).collect()


def test_records_of_an_empty_table(make_docs):
    index = token_records.write_records(make_docs([]), WORDS, end_id=1)
    assert index.count() == 0 and token_records.digests(index, 2).count() == 0


def test_known_parts_are_forgotten_without_loss(monkeypatch):
    monkeypatch.setattr(token_records, "REMEMBERED", 50)
    encoder, exact = token_records.Encoder(WORDS), Tokenizer.from_file(WORDS)
    for n in range(20):
        texts = [f"word{n} other{n * i} it's, {i}!" for i in range(9)]
        want = [np.array(exact.encode(t).ids + [1], "<u2").tobytes() for t in texts]
        assert encoder.encode(texts, 1) == want


def test_other_tokenizers_get_texts_whole():
    from tokenizers import Tokenizer

    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder, exact = token_records.Encoder(path), Tokenizer.from_file(path)
    texts = ["Hello World, it is 2024", "", None, " two  blanks\n", "é ü <|endoftext|>"]
    got = [np.frombuffer(ids, encoder.kind).tolist() for ids in encoder.encode(texts, 1)]
    assert not encoder.by_words and got == [exact.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]


def test_words_with_odd_separators_and_signs():
    from tokenizers import Tokenizer

    encoder, exact = token_records.Encoder(WORDS), Tokenizer.from_file(WORDS)
    texts = ["a\x1cb \x1d c\x85d", "it's IT'S 'tis", "x<|endoftext|>y end.", "ΣΑΣ ſK İstanbul É́", "a, b!? (c) 1,2 #$"] * 2
    for _ in range(2):  # the second time from what is remembered
        got = [np.frombuffer(ids, encoder.kind).tolist() for ids in encoder.encode(texts, 1)]
        assert encoder.by_words and got == [exact.encode(t, add_special_tokens=False).ids + [1] for t in texts]
