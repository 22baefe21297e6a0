"""Token ids in files of length-delimited, checksummed binary records.

A record is, little-endian: the payload's length (8 bytes), the masked CRC-32C of
those 8 bytes (4), the payload, the masked CRC-32C of the payload (4).  This is the
framing that record readers of training frameworks know.  The payload is the id
of the document (8 bytes), 1 where that id is null and else 0 (4 bytes), and the
token ids, 2 bytes each where the vocabulary fits and else 4.

Texts are dealt out by ranges of the document id and sorted, so shard ``i``
holds what precedes shard ``i + 1``.  A task writes one file under a name of its own
attempt, and returns the offset index of its records; only files that the index
names count, so a task that is lost and run again leaves no trace in the result.

Defined results: a null or empty text is its end id alone; null document ids come
first; rows with the same id follow each other by text; an empty table gives no
file and an empty index; other columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from functools import lru_cache, partial
from itertools import chain, filterfalse

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarrymill.llm.common import quoted, written
from quarrymill.session import scratch_path

HEADER = struct.Struct("<qI")
BLOCK, MASK_DELTA = 256, 0xA282EAD8
BATCH_BYTES = 8 << 20
LARGEST = 1 << 34
REMEMBERED, JOINED, WORD_END = 600_000, 1_000, "</w>"
_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_LETTER, _SIGN = "A-Za-zÀ-ÖØ-öø-ÿ", "!-&(-/:-@\\[-`{-~"
_PARTS = re.compile(f"[{_LETTER}]+|[0-9]|[{_SIGN}]+")
_PLAIN = re.compile(f"[{_LETTER}0-9{_SIGN}]+")
_WORDS = re.compile(f"[^{_SPACE}]+")
_ENDING = frozenset("!#$%&()*+,-./:;=?@")  # a few signs that often end a word; an apostrophe is not one
_SEPARATORS = re.compile("[\x1c-\x1f]")
# fixed values: the normalizer and the splitting rule of the tokenizer form that is taken apart
FORM = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
         "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
}
INDEX = pa.schema([
    ("shard", pa.int32()), ("record", pa.int64()), ("file", pa.string()), ("doc_id", pa.int64()),
    ("offset", pa.int64()), ("length", pa.int64()), ("n_tokens", pa.int64()),
])
DIGESTS = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
TOKENS = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int64()))])
INDEX_SPARK = "shard int, record long, file string, doc_id long, offset long, length long, n_tokens long"


# --- checksums ---------------------------------------------------------------

def _table() -> np.ndarray:
    """CRC-32C (Castagnoli) of each byte."""
    crc = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        crc = np.where(crc & 1, (crc >> 1) ^ np.uint32(0x82F63B78), crc >> 1)
    return crc


_CRC = _table()


def _advance(crc: np.ndarray, steps: int) -> np.ndarray:
    for _ in range(steps):
        crc = _CRC[crc & 0xFF] ^ (crc >> 8)
    return crc


# what a block of zeros makes of each byte of a register
_SKIP = [_advance(np.arange(256, dtype=np.uint32) << (8 * k), BLOCK) for k in range(4)]


def crc32c(payloads: list[bytes]) -> np.ndarray:
    """CRC-32C of each payload of at least four bytes.

    Payloads are cut in blocks, counted from their end; all blocks are run
    through side by side and then joined, as the checksum is linear.
    """
    sizes = np.array([len(p) for p in payloads], np.int64)
    blocks = -(-sizes // BLOCK)
    ends = np.cumsum(blocks) * BLOCK
    data = np.zeros(int(blocks.sum()) * BLOCK, np.uint8)
    for p, end, size in zip(payloads, ends.tolist(), sizes.tolist()):
        data[end - size:end] = np.frombuffer(p, np.uint8)
    heads = ends - sizes
    for k in range(4):  # a register of ones at the start is the same as inverting four bytes
        data[heads + k] ^= 0xFF
    lanes = np.ascontiguousarray(data.reshape(-1, BLOCK).T)
    crc = np.zeros(lanes.shape[1], np.uint32)
    for row in lanes:
        crc = _CRC[(crc ^ row) & 0xFF] ^ (crc >> 8)
    out = np.zeros(len(payloads), np.uint32)
    last = np.cumsum(blocks)
    order = np.argsort(-blocks, kind="stable")
    most = int(blocks.max()) if len(blocks) else 0
    falling = -blocks[order]
    for left in range(most, 0, -1):  # documents with at least so many blocks take the next one
        who = order[: np.searchsorted(falling, -left, side="right")]
        reg = out[who]
        reg = (_SKIP[0][reg & 0xFF] ^ _SKIP[1][(reg >> 8) & 0xFF]
               ^ _SKIP[2][(reg >> 16) & 0xFF] ^ _SKIP[3][reg >> 24])
        out[who] = reg ^ crc[last[who] - left]
    return out ^ np.uint32(0xFFFFFFFF)


def masked(crc: np.ndarray) -> np.ndarray:
    wide = crc.astype(np.uint64)
    turned = ((wide >> 15) | (wide << 17)) & 0xFFFFFFFF
    return ((turned + MASK_DELTA) & 0xFFFFFFFF).astype(np.uint32)


def frames(payloads: list[bytes]) -> list[bytes]:
    lengths = [struct.pack("<Q", len(p)) for p in payloads]
    a, b = masked(crc32c(lengths)), masked(crc32c(payloads))
    return [n + struct.pack("<I", x) + p + struct.pack("<I", y)
            for n, x, p, y in zip(lengths, a.tolist(), payloads, b.tolist())]


def verify(lengths: list[bytes], length_sums: list[int], payloads: list[bytes], sums: list[int], where: str) -> None:
    good = (masked(crc32c(lengths)) == np.array(length_sums, np.uint32)) & (
        masked(crc32c(payloads)) == np.array(sums, np.uint32))
    if not good.all():
        raise ValueError(f"checksum of record {int(np.argmin(good))} of a block differs in {where}")


# --- tokens ------------------------------------------------------------------

class Encoder:
    """Little-endian ids of texts from the tokenizers library, each distinct word once.

    ``FORM`` is the one form of tokenizer that is taken apart: it lower-cases, breaks at white space and
    then at changes between letters, digits and other signs, and a part's ids do not depend on
    what lies beside it.  A text is then its words; a word of plain Latin letters, digits and
    signs is its parts, and one with apostrophes or any other character goes to the library whole.
    New parts are encoded many at a time, with blanks between them: the last piece of a
    part carries the vocabulary's word end, which tells them apart again.  At most
    ``REMEMBERED`` words and parts are kept, or as many as the batch at hand uses.
    Any other tokenizer gets the texts whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.kind = np.dtype("<u2" if max(vocabulary.values()) < 1 << 16 else "<u4")
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for piece, i in vocabulary.items() if piece.endswith(WORD_END)]] = True
        stated = json.loads(self.tokenizer.to_str())
        added = [t["content"] for t in stated["added_tokens"]]
        self.by_words = (
            stated["normalizer"] == FORM["normalizer"] and stated["pre_tokenizer"] == FORM["pre_tokenizer"]
            and stated["model"].get("end_of_word_suffix") == WORD_END and not stated["model"].get("dropout")
            and all(t.startswith("<|") and t.endswith("|>") and " " not in t for t in added)
            and not any(t[k] for t in stated["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized")))
        self.words: dict[str, bytes] = {}
        self.known: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(f.ids, self.kind) for f in found]

    def _learn(self, new: list[str]) -> None:
        plain = [p for p in new if _PARTS.fullmatch(p)]
        whole = [p for p in new if not _PARTS.fullmatch(p)]
        groups = [plain[i:i + JOINED] for i in range(0, len(plain), JOINED)]
        for group, ids in zip(groups, self._ids([" ".join(g) for g in groups])):
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) != len(group):
                whole += group
                continue
            data, size, start = ids.tobytes(), ids.itemsize, 0
            for part, stop in zip(group, (stops * size).tolist()):
                self.known[part] = data[start:stop]
                start = stop
        for part, ids in zip(whole, self._ids(whole)):
            self.known[part] = ids.tobytes()

    def _cut(self, word: str) -> tuple | list:
        """Parts of a word; a special token, like any word that is not plain, is one."""
        if word.isascii():  # most words are letters, or letters and a sign
            if word.isalpha():
                return (word.lower(),)
            if word[-1] in _ENDING and word[:-1].isalpha():
                return (word[:-1].lower(), word[-1])
        return _PARTS.findall(word.lower()) if _PLAIN.fullmatch(word) and "<|" not in word else (word,)

    def _learn_words(self, new: list[str]) -> None:
        cut = list(map(self._cut, new))
        if len(self.known) > REMEMBERED:
            self.known.clear()
        self._learn(list(set(filterfalse(self.known.__contains__, chain.from_iterable(cut)))))
        ids = self.known.__getitem__
        self.words.update((w, ids(parts[0]) if len(parts) == 1 else b"".join(map(ids, parts))) for w, parts in zip(new, cut))

    def encode(self, texts: list[str | None], end_id: int) -> list[bytes]:
        end = np.array([end_id], self.kind).tobytes()
        if not self.by_words:
            return [ids.tobytes() + end for ids in self._ids([t or "" for t in texts])]
        if len(self.words) > REMEMBERED:
            self.words.clear()
        # str.split takes four control characters for white space that the tokenizer does not
        split = [(_WORDS.findall(t) if _SEPARATORS.search(t) else t.split()) if t else [] for t in texts]
        new = set().union(*split).difference(self.words)
        if new:
            self._learn_words(list(new))
        ids = self.words.__getitem__
        return [b"".join(map(ids, s)) + end for s in split]


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


# --- writing and reading -----------------------------------------------------

def _store(folder: str):
    if "://" not in folder and not folder.startswith("file:"):
        return pa.fs.LocalFileSystem(), folder
    return pa.fs.FileSystem.from_uri(folder)


def _write_shard(batches, tokenizer: str, end_id: int, target: str):
    """One file of the rows of a task, in their order; yields their offset index."""
    encoder, (fs, base) = _encoder(tokenizer), _store(target)
    shard = TaskContext.get().partitionId()
    name = f"shard-{shard:06d}-{uuid.uuid4().hex}.rec"
    out, offset, record = None, 0, 0
    for batch in batches:
        step = max(1, int(batch.num_rows * BATCH_BYTES / max(1, batch.nbytes)))
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            if out is None:
                fs.create_dir(base, recursive=True)
                out = fs.open_output_stream(f"{base}/{name}")
            ids = part.column(0).to_pylist()
            tokens = encoder.encode(part.column(1).to_pylist(), end_id)
            made = frames([HEADER.pack(i or 0, i is None) + t for i, t in zip(ids, tokens)])
            out.write(b"".join(made))
            sizes, n = np.array([len(m) for m in made], np.int64), len(made)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(n, shard, np.int32)), pa.array(np.arange(record, record + n)),
                pa.array([name] * n), pa.array(ids, pa.int64()),
                pa.array(offset + np.cumsum(sizes) - sizes), pa.array(sizes),
                pa.array([len(t) // encoder.kind.itemsize for t in tokens], pa.int64()),
            ], schema=INDEX)
            record, offset = record + n, offset + int(sizes.sum())
    if out is not None:
        out.close()


def write_records(df: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id",
                  text_col: str = "text", folder: str | None = None) -> DataFrame:
    """Write the shards and return the offset index, a table kept beside them.

    ``folder`` must be one that all executors share; by default it is a scratch
    folder under the session's.
    """
    target = folder or scratch_path(df.sparkSession, "token-records")
    rows = df.select(quoted(id_col).cast("bigint").alias("doc_id"), quoted(text_col).alias("text"))
    order = F.col("doc_id").asc_nulls_first()
    # rows of one id follow each other by text, so its first characters may cut them as well
    dealt = rows.repartitionByRange(order, F.substring("text", 1, 64)).sortWithinPartitions(order, "text")
    index = dealt.mapInArrow(partial(_write_shard, tokenizer=tokenizer, end_id=end_id, target=target), INDEX_SPARK)
    return written(index, "token-index").withColumn("file", F.concat(F.lit(target + "/"), F.col("file")))


def _pieces(path: str):
    """Verified payloads of a shard, in blocks: ``(record number of the first, payloads)``."""
    fs, name = _store(path)
    with fs.open_input_stream(name, buffer_size=1 << 20) as stream:
        done, held, block = 0, 0, ([], [], [], [])
        while head := stream.read(12):
            (size,), (check,) = struct.unpack("<Q", head[:8]), struct.unpack("<I", head[8:])
            if size > LARGEST:  # else a broken length would be read into memory
                raise ValueError(f"a record's length is broken in {path}")
            body = stream.read(size + 4)
            if len(body) != size + 4:
                raise ValueError(f"a record is cut off in {path}")
            for kept, x in zip(block, (head[:8], check, body[:-4], struct.unpack("<I", body[-4:])[0])):
                kept.append(x)
            held += size
            if held >= BATCH_BYTES:
                verify(*block, path)
                yield done, block[2]
                done, held, block = done + len(block[2]), 0, ([], [], [], [])
        if block[2]:
            verify(*block, path)
            yield done, block[2]


def _read_shards(batches, kind: str):
    for batch in batches:
        for shard in batch.to_pylist():
            place = shard["base"]
            for _, payloads in _pieces(shard["file"]):
                ids, sizes, sums = [], [], []
                for p in payloads:
                    doc, absent = HEADER.unpack_from(p)
                    tokens = np.frombuffer(p, kind, offset=HEADER.size)
                    ids.append(None if absent else doc)
                    sizes.append(len(tokens))
                    sums.append(zlib.crc32(tokens.astype("<u4").tobytes()))
                n = np.array(sizes, np.int64)
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids, pa.int64()), pa.array(place + np.cumsum(n) - n), pa.array(n),
                    pa.array(sums, pa.int64())], schema=DIGESTS)
                place += int(n.sum())


def digests(index: DataFrame, id_bytes: int) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` read back from the shards.

    One row per shard (not per document) gives each file its first id's place.
    """
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = index.groupBy("shard", "file").agg(F.sum("n_tokens").alias("n")).select(
        "shard", "file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    spread = written(shards, "token-shards")
    parts = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return spread.repartition(parts, "shard").mapInArrow(
        partial(_read_shards, kind=f"<u{id_bytes}"), "doc_id long, start long, n_tokens long, ids_crc32 long")


def _fetch(batches, kind: str):
    name, stream = None, None
    for batch in batches:
        docs, found = [], []
        for row in batch.to_pylist():
            if row["file"] != name:
                fs, path = _store(row["file"])
                name, stream = row["file"], fs.open_input_file(path)
            stream.seek(row["offset"])
            data = stream.read(row["length"])
            head, body = data[:12], data[12:-4]
            verify([head[:8]], list(struct.unpack("<I", head[8:])), [body],
                   list(struct.unpack("<I", data[-4:])), name)
            doc, absent = HEADER.unpack_from(body)
            docs.append(None if absent else doc)
            found.append(np.frombuffer(body, kind, offset=HEADER.size).astype(np.int64))
        yield pa.RecordBatch.from_arrays(
            [pa.array(docs, pa.int64()), pa.array(found, pa.list_(pa.int64()))], schema=TOKENS)


def read_at(wanted: DataFrame, id_bytes: int) -> DataFrame:
    """``doc_id, ids`` of any rows of the index, each fetched by its offset: a shuffled read."""
    return wanted.select("file", "offset", "length").mapInArrow(
        partial(_fetch, kind=f"<u{id_bytes}"), "doc_id long, ids array<long>")


def id_bytes(spark: SparkSession, tokenizer: str) -> int:
    return _encoder(tokenizer).kind.itemsize
