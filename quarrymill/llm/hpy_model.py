"""A hierarchical Pitman-Yor language model, seated by Gibbs sampling.

Every word of a text is a customer of the restaurant of the word before it, and the end
of the text is a customer as well.  Words whose hashes agree modulo ``contexts`` share a
restaurant, so there is a fixed number of restaurants while their dishes grow with the corpus.  All
restaurants share one parent, to which each table of a dish sends one customer; the
parent's own base is uniform over the words seen and one that stands for all others.

Words are dealt out to buckets by a hash.  All seatings of a word, in every restaurant and in the
parent, lie in one bucket, and need of the others only the number of tables in each
restaurant, so a sweep runs bucket by bucket with the totals of the sweep before.  In a sweep as many
customers as a dish has, each drawn at random, leave their table one after the other and are seated again given
all others; runs of moves that change no seating are skipped by one draw of their length.  After ``burn`` sweeps the
seatings of each further sweep are a sample, and a word's probability is the mean over the samples.

Texts are read in slices of bounded bytes; a slice sends one packed row to each bucket that has
words of it, and gets one row of sums for its documents back.  A very frequent word has at
most ``contexts`` dishes, and its tokens are dealt to several tasks where there are many slices, each with the bucket's model.

Defined results: null, empty and blank texts are their end token alone; a corpus without training
texts gives every token probability one, in the base form too; rows that repeat an id are scored
one by one and keep their own row; a null id counts as an empty text where it is hashed; very long texts are read whole, as a slice
of their own; other columns are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

import pickle
import zlib
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh32_intdigest

from quarrymill.llm.common import quoted, written

END = b""  # no word is empty
SLICE_BYTES, BUCKET_BYTES, FEWEST_BUCKETS = 8 << 20, 64 << 20, 64
SLICES_PER_TASK = 512  # of one bucket; more are dealt to several tasks
DENSE = 1 << 19  # table sizes handled at once
AT_ONCE = 16  # customers that come or go one by one; more do so in bulk, before the moves
HELD_IN_MEMORY = 1 << 22  # counts gathered before they are added up
MODEL, INFO, TOKENS = 0, 1, 2
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_ROW = pa.schema([("bucket", pa.int32()), ("salt", pa.int32()), ("kind", pa.int32()), ("slice", pa.int64()),
                  ("payload", pa.binary())])
ROW = "bucket int, salt int, kind int, slice long, payload binary"
_COUNTS = pa.schema([("bucket", pa.int32()), ("payload", pa.binary()), ("tokens", pa.int64()), ("words", pa.int64()),
                     *[(n, pa.int64()) for n in ("pairs1", "pairs2", "words1", "words2")]])
COUNTS = "bucket int, payload binary, tokens long, words long, pairs1 long, pairs2 long, words1 long, words2 long"
_TOTAL = pa.schema([("context", pa.int32()), ("customers", pa.int64()), ("tables", pa.int64())])
_SEATS = pa.schema([("bucket", pa.int32()), ("payload", pa.binary())])
_SCORED = pa.schema([
    ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
    ("base_score", pa.float64()), ("score", pa.float64())])


@dataclass(frozen=True)
class Settings:
    """``contexts`` restaurants, ``sweeps`` of which the first ``burn`` are not samples, ``moves``
    per dish and sweep (``None``: as many as it has customers), the strengths of a restaurant and of the parent, and the seed."""

    contexts: int = 1 << 16
    sweeps: int = 4
    burn: int = 2
    moves: int | None = None
    strength: float = 1.0
    parent_strength: float = 10.0
    seed: int = 42


def _pack(*parts) -> bytes:
    return zstandard.compress(pickle.dumps(parts, protocol=5), 3)


def _unpack(data: bytes) -> tuple:
    return pickle.loads(zstandard.decompress(data))


# --- tokens ------------------------------------------------------------------

def _tokens(texts: list[str | None], contexts: int):
    """Distinct words, and per token its word, its context and its document; and tokens per text."""
    number: dict[bytes, int] = {END: 0}
    ids: list[int] = []
    sizes = np.zeros(len(texts), np.int64)
    add = number.setdefault
    for i, text in enumerate(texts):
        words = text.encode().translate(_LOWER).split() if text else ()
        ids += [add(w, len(number)) for w in words]
        ids.append(0)
        sizes[i] = len(words) + 1
    word = np.array(ids, np.int64)
    list_of = list(number)
    hashed = np.array([1 + zlib.crc32(w) % (contexts - 1) for w in list_of], np.int64)
    context = np.zeros(len(word), np.int64)  # the start of a text is context 0
    context[1:] = hashed[word[:-1]]
    context[(np.cumsum(sizes) - sizes)] = 0
    return list_of, word, context, np.repeat(np.arange(len(texts)), sizes), sizes


def _by_bucket(words: list[bytes], word: np.ndarray, context: np.ndarray, buckets: int, last: np.ndarray):
    """Per bucket: its words, how many rows each has, and the rows' contexts and ``last``, sorted."""
    bucket = np.array([xxh32_intdigest(w) % buckets for w in words], np.int64)
    order = np.argsort(bucket, kind="stable")
    rank = np.empty(len(words), np.int64)
    rank[order] = np.arange(len(words))
    rows = np.lexsort((last, context, rank[word]))
    rank, context, last = rank[word][rows], context[rows], last[rows]
    firsts = np.searchsorted(bucket[order], np.arange(buckets + 1))
    ends = np.searchsorted(rank, firsts)
    for b in np.flatnonzero(np.diff(ends)):
        lo, hi, a, z = firsts[b], firsts[b + 1], ends[b], ends[b + 1]
        per_word = np.bincount(rank[a:z] - lo, minlength=hi - lo)
        there = np.flatnonzero(per_word)
        yield int(b), [words[order[lo + i]] for i in there], per_word[there], context[a:z], last[a:z]


def _slices(batches):
    """Rows of a task in slices of bounded bytes, with their numbers."""
    number = TaskContext.get().partitionId() << 40
    for batch in batches:
        step = max(1, int(batch.num_rows * SLICE_BYTES / max(1, batch.nbytes)))
        for at in range(0, batch.num_rows, step):
            yield number, batch.slice(at, step)
            number += 1


def _small(values: np.ndarray) -> np.ndarray:
    """The narrowest unsigned type that holds them."""
    return values.astype(np.min_scalar_type(int(values.max(initial=0))))


def _counted_slices(batches, contexts: int, buckets: int, salts: int):
    for number, part in _slices(batches):
        words, word, context, _, _ = _tokens(part.column(1).to_pylist(), contexts)
        keys, n = np.unique(word * contexts + context, return_counts=True)
        made = [
            (b, number % salts, TOKENS, number, _pack(b" ".join(w), _small(per), _small(c), _small(k)))
            for b, w, per, c, k in _by_bucket(words, keys // contexts, keys % contexts, buckets, n)]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made), _ROW.types)], schema=_ROW)


def _token_slices(batches, contexts: int, buckets: int, salts: int):
    for number, part in _slices(batches):
        words, word, context, doc, sizes = _tokens(part.column(1).to_pylist(), contexts)
        info = _pack(part.column(0).to_pylist(), part.column(2).to_pylist(), sizes)
        made = [(number % buckets, number % salts, INFO, number, info)]
        made += [
            (b, number % salts, TOKENS, number, _pack(b" ".join(w), _small(per), _small(c), _small(d)))
            for b, w, per, c, d in _by_bucket(words, word, context, buckets, doc)]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made), _ROW.types)], schema=_ROW)


# --- counts ------------------------------------------------------------------

class _Sum:
    """Counts of (word, context) of one bucket, added up as they come."""

    def __init__(self, contexts: int):
        self.contexts, self.number, self.keys, self.counts, self.held = contexts, {}, [], [], 0

    def add(self, payload: bytes) -> None:
        words, per, context, n = _unpack(payload)
        put = self.number.setdefault
        ids = np.array([put(w, len(self.number)) for w in words.split(b" ")], np.int64)
        self.keys.append(np.repeat(ids, per) * self.contexts + context)
        self.counts.append(n.astype(np.int64))
        self.held += len(n)
        if self.held > 2 * HELD_IN_MEMORY and len(self.keys) > 1:
            self.settle()

    def settle(self) -> None:
        keys, counts = np.concatenate(self.keys), np.concatenate(self.counts)
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        self.keys, self.counts = [keys[first]], [np.add.reduceat(counts[order], first)]
        self.held = len(first) // 2  # of what is settled, half counts: it is not sorted at every turn

    def row(self, bucket: int) -> tuple:
        self.settle()
        keys, n = self.keys[0], self.counts[0]
        per = np.bincount(keys // self.contexts, minlength=len(self.number))
        payload = _pack(b" ".join(self.number), _small(per), _small(keys % self.contexts), _small(n))
        return (bucket, payload, int(n.sum()), len(per), int((n == 1).sum()), int((n == 2).sum()),
                int((per == 1).sum()), int((per == 2).sum()))


def _added_up(batches, contexts: int):
    """One row per (bucket, salt) of rows that are sorted by them."""
    now, total = None, None
    for batch in batches:
        for bucket, salt, payload in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2))):
            if (bucket, salt) != now:
                if total is not None:
                    yield _one(_COUNTS, total.row(now[0]))
                now, total = (bucket, salt), _Sum(contexts)
            total.add(payload)
    if total is not None:
        yield _one(_COUNTS, total.row(now[0]))


def _one(schema: pa.Schema, row: tuple) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, schema.types)], schema=schema)


def _merged(rows: DataFrame, contexts: int, buckets: int) -> DataFrame:
    return rows.select("bucket", "salt", "payload").repartition(_tasks(rows, buckets), "bucket", "salt").sortWithinPartitions(
        "bucket", "salt").mapInArrow(partial(_added_up, contexts=contexts), COUNTS)


def _tasks(df: DataFrame, buckets: int) -> int:
    return max(buckets, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _context_totals(batches, contexts: int):
    customers, tables = np.zeros(contexts, np.int64), np.zeros(contexts, np.int64)
    for batch in batches:
        for payload in batch.column(0).to_pylist():
            _, _, context, n = _unpack(payload)
            customers += np.bincount(context, n, contexts).astype(np.int64)
            tables += np.bincount(context, minlength=contexts)
    yield _totals(customers, tables)


def _totals(customers: np.ndarray, tables: np.ndarray) -> pa.RecordBatch:
    there = np.flatnonzero(customers + tables)
    return pa.RecordBatch.from_arrays(
        [pa.array(there.astype(np.int32)), pa.array(customers[there]), pa.array(tables[there])], schema=_TOTAL)


def _gathered(totals: DataFrame, contexts: int) -> tuple[np.ndarray, np.ndarray]:
    """Totals per restaurant, of which there are ``contexts`` at most."""
    customers, tables = np.zeros(contexts, np.int64), np.zeros(contexts, np.int64)
    for row in totals.groupBy("context").agg(F.sum("customers").alias("c"), F.sum("tables").alias("t")).collect():
        customers[row["context"]], tables[row["context"]] = row["c"], row["t"]
    return customers, tables


# --- seating -----------------------------------------------------------------

def one_large(customers: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """Sizes of the tables of each dish, in a row: the first table holds all but one customer for each other table."""
    sizes = np.ones(int(tables.sum()), np.int64)
    sizes[np.cumsum(tables) - tables] = customers - tables + 1
    return sizes


def _in_bulk(sizes: np.ndarray, change: int, weight: float, discount: float, rng) -> np.ndarray:
    """Very many customers come to or leave one dish, with the weights as they are."""
    if change < 0:
        left = sizes - rng.multivariate_hypergeometric(sizes, -change, method="marginals")
        return left[left > 0]
    chance = np.append(sizes - discount, weight)
    put = rng.multinomial(change, chance / chance.sum())
    return np.append(sizes + put[:-1], np.ones(put[-1], sizes.dtype))


def reseat(sizes: np.ndarray, tables: np.ndarray, target: np.ndarray, weight: np.ndarray, discount: float,
           moves: int | None, rng) -> tuple[np.ndarray, np.ndarray]:
    """One sweep over many dishes: ``(sizes, tables)`` after it.

    ``sizes`` are the tables of all dishes in a row, ``tables`` their number per dish, and
    ``weight`` that of a new table.  Customers come or go until a dish has ``target`` of them; then as many
    customers as the dish has, or ``moves`` if that is fewer, each drawn at random, leave their table and choose
    one given all others: a table with its size less the discount, a new one with its weight.  Moves that lead
    back to the same seating are counted and not carried out.
    """
    if not len(tables):
        return sizes, tables
    starts = np.cumsum(tables) - tables
    have = np.add.reduceat(sizes, starts)
    change = target - have
    large = np.flatnonzero(np.abs(change) > AT_ONCE)
    if len(large):
        parts = np.split(sizes, starts[1:])
        for i in large:
            parts[i] = _in_bulk(parts[i], int(change[i]), float(weight[i]), discount, rng)
        sizes, tables = np.concatenate(parts), np.array([len(p) for p in parts])
        change = change.copy()
        change[large] = 0
    left = np.asarray(target if moves is None else np.minimum(target, moves)).astype(np.float64)
    who, now, count = np.arange(len(tables)), sizes, tables
    owners, kept = [], []
    while len(who):
        starts = np.cumsum(count) - count
        width = np.ceil(np.log2(count + np.maximum(change[who], 0) + 2)).astype(np.int64)
        wider = []
        for g in np.unique(width):
            mine = np.flatnonzero(width == g)
            for at in range(0, len(mine), max(1, DENSE >> g)):
                some = mine[at:at + max(1, DENSE >> g)]
                dense = np.zeros((len(some), 1 << g))
                t, ids = count[some], who[some]
                row = np.repeat(np.arange(len(some)), t)
                column = np.arange(len(row)) - np.repeat(np.cumsum(t) - t, t)
                dense[row, column] = now[np.repeat(starts[some], t) + column]
                _come_and_go(dense, change[ids], weight[ids], discount, rng)
                left[ids], full = _move(dense, left[ids], weight[ids], discount, rng)
                row, column = np.nonzero(dense)
                for to, there in ((wider, full[row]), ((owners, kept), ~full[row])):
                    found = ids[row[there]], dense[row[there], column[there]].astype(np.int64)
                    if to is wider:
                        wider.append(found)
                    else:
                        owners.append(found[0])
                        kept.append(found[1])
        change = np.zeros_like(change)
        owner, now = (np.concatenate(x) for x in zip(*wider))
        who, count = np.unique(owner, return_counts=True)
        now = now[np.argsort(owner, kind="stable")]
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(kept)[order], np.bincount(owner, minlength=len(tables))


def _come_and_go(dense, change, weight, discount, rng) -> None:
    """Few customers come to or leave each dish, one after the other."""
    for step in range(int(np.abs(change).max(initial=0))):
        rows = np.flatnonzero(change < -step)
        if len(rows):
            now = dense[rows].cumsum(1)
            table = (now <= (rng.random(len(rows)) * now[:, -1])[:, None]).sum(1)
            dense[rows, np.minimum(table, dense.shape[1] - 1)] -= 1
        rows = np.flatnonzero(change > step)
        if len(rows):
            now = dense[rows]
            chance = np.where(now > 0, now - discount, 0.0).cumsum(1)
            drawn = rng.random(len(rows)) * (chance[:, -1] + weight[rows])
            table = (chance <= drawn[:, None]).sum(1)
            table = np.where(drawn >= chance[:, -1], (now == 0).argmax(1), np.minimum(table, dense.shape[1] - 1))
            dense[rows, table] += 1


def _move(dense, left, weight, discount, rng) -> tuple[np.ndarray, np.ndarray]:
    """``left`` moves in each dish: how many are left, and which dishes have no place for one more table.

    While moves change nothing their chances stay the same, so how many there are until one does is a
    geometric draw; only that one is carried out.  Where most customers share a table that skips most moves.
    """
    left, full = left.copy(), np.zeros(len(dense), bool)
    at = np.flatnonzero(left > 0)
    now, w = dense[at], weight[at][:, None]
    n = now.sum(1, keepdims=True)
    while len(at):
        taken = now > 0
        t = taken.sum(1, keepdims=True)
        alone = now == 1
        # a single customer's table goes with it and then is as good as a new one
        stay = np.where(alone, w, now - 1 - discount) / np.where(taken, n - 1 - discount * (t - alone) + w, 1.0)
        leave = np.where(taken, now / n * (1 - stay), 0.0).cumsum(1)
        some = leave[:, -1]
        with np.errstate(divide="ignore"):
            wait = np.where(some > 1e-15, np.ceil(np.log1p(-rng.random(len(at))) / np.log1p(-np.clip(some, 1e-15, 1.0))), np.inf)
        wait = np.maximum(wait, 1.0)
        full[at] = t[:, 0] == now.shape[1]
        goes = (wait <= left[at]) & ~full[at]
        left[at[~goes & ~full[at]]] = 0
        if not goes.all():
            dense[at[~goes]] = now[~goes]
            at, now, w, n, leave, some, wait = (x[goes] for x in (at, now, w, n, leave, some, wait))
        rows = np.arange(len(at))
        if not len(at):
            break
        left[at] -= wait
        source = np.minimum((leave <= (rng.random(len(at)) * some)[:, None]).sum(1), now.shape[1] - 1)
        chance = np.where(now > 0, now - discount, 0.0)
        chance[rows, source] = 0.0
        chance = chance.cumsum(1)
        new = np.where(now[rows, source] == 1, 0.0, w[:, 0])
        drawn = rng.random(len(at)) * (chance[:, -1] + new)
        table = np.minimum((chance <= drawn[:, None]).sum(1), now.shape[1] - 1)
        table = np.where((drawn >= chance[:, -1]) & (new > 0), (now == 0).argmax(1), table)
        now[rows, source] -= 1
        now[rows, table] += 1
    return left, full


@dataclass(frozen=True)
class Totals:
    """What a bucket needs to know of all others."""

    discount: float
    parent_discount: float
    base: float  # probability of each word before any is seen
    tables: np.ndarray  # per restaurant
    parent_customers: int
    parent_tables: int


def parent_probability(customers: np.ndarray, tables: np.ndarray, totals: Totals, settings: Settings) -> np.ndarray:
    """Of words with so many customers and tables in the parent; zero of both for a word never seen."""
    back = (settings.parent_strength + totals.parent_discount * totals.parent_tables) * totals.base
    own = np.maximum(customers - totals.parent_discount * tables, 0.0)
    return (own + back) / (settings.parent_strength + totals.parent_customers)


def probability(count, tables, context_tables, context_customers, parent, discount: float, strength: float):
    """Of a word in a restaurant, given its probability in the parent."""
    own = np.maximum(count - discount * tables, 0.0)
    return (own + (strength + discount * context_tables) * parent) / (strength + context_customers)


def _swept(batches, contexts: int, sweep: int, totals: Totals, settings: Settings):
    """Seatings of each bucket after one more sweep; the first begins from the counts."""
    for batch in batches:
        for bucket, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            rng = np.random.default_rng([settings.seed, bucket, sweep])
            if sweep == 0:
                _, per, context, n = _unpack(payload)
                word = np.repeat(np.arange(len(per)), per)
                many = np.flatnonzero(n > 1)  # a single customer has one table
                singles = np.bincount(word[n == 1], minlength=len(per))
                word, context, n = word[many], context[many].astype(np.int64), n[many].astype(np.int64)
                customers = np.bincount(np.repeat(np.arange(len(per)), per), minlength=len(per))
                parent = parent_probability(customers, np.minimum(customers, 1), totals, settings)
                weight = (settings.strength + totals.discount * totals.tables[context]) * parent[word]
                tables = np.clip(np.rint(weight * np.log1p(n / weight)), 1, n).astype(np.int64)
                sizes = one_large(n, tables)
                p_tables = np.ones(len(per), np.int64)
                p_sizes = customers.astype(np.int64)
            else:
                word, context, n, singles, sizes, tables, p_sizes, p_tables = (
                    x.astype(np.int64) for x in _unpack(payload))
            p_starts = np.cumsum(p_tables) - p_tables
            customers = np.add.reduceat(p_sizes, p_starts)
            parent = parent_probability(customers, p_tables, totals, settings)
            weight = (settings.strength + totals.discount * totals.tables[context]) * parent[word]
            sizes, tables = reseat(sizes, tables, n, weight, totals.discount, settings.moves, rng)
            target = singles + np.bincount(word, tables, len(singles)).astype(np.int64)
            new = (settings.parent_strength + totals.parent_discount * totals.parent_tables) * totals.base
            p_sizes, p_tables = reseat(
                p_sizes, p_tables, target, np.full(len(target), new), totals.parent_discount, settings.moves, rng)
            state = (word, context, n, singles, sizes, tables, p_sizes, p_tables)
            yield _one(_SEATS, (bucket, _pack(*[_small(x) for x in state])))


def _seat_totals(batches, contexts: int):
    """Tables per restaurant of dishes with several customers; of the parent, at context -1."""
    tables, parent = np.zeros(contexts, np.int64), np.zeros(2, np.int64)
    for batch in batches:
        for payload in batch.column(0).to_pylist():
            _, context, _, _, _, found, p_sizes, p_tables = _unpack(payload)
            tables += np.bincount(context, found, contexts).astype(np.int64)
            parent += np.array([p_sizes.sum(dtype=np.int64), p_tables.sum(dtype=np.int64)])
    yield _totals(np.zeros(contexts, np.int64), tables)
    yield pa.RecordBatch.from_arrays(
        [pa.array([-1], pa.int32()), pa.array(parent[:1]), pa.array(parent[1:])], schema=_TOTAL)


TOTAL = "context int, customers long, tables long"


@dataclass(frozen=True)
class Model:
    """Tables of counts and of sampled seatings by bucket, and the totals of each sample."""

    counts: DataFrame
    samples: list[DataFrame]
    totals: list[Totals]
    context_customers: np.ndarray
    tokens: int
    words: int
    buckets: int
    salts: int
    settings: Settings


def _discount(ones: int, twos: int) -> float:
    """The usual estimate from how many dishes have one and two customers."""
    return min(0.95, max(0.05, ones / (ones + 2 * twos))) if ones + twos else 0.5


def fit(docs: DataFrame, settings: Settings = Settings(), text_col: str = "text", bytes_in_all: int | None = None,
        buckets: int | None = None, salts: int | None = None) -> Model:
    """Count and seat all texts of ``docs``.  ``buckets`` and ``salts`` follow from the bytes where not given."""
    contexts = settings.contexts
    if buckets is None or salts is None:
        size = bytes_in_all if bytes_in_all is not None else docs.agg(F.sum(F.octet_length(quoted(text_col)))).first()[0] or 0
        buckets = buckets or max(FEWEST_BUCKETS, -(-size // BUCKET_BYTES))
        salts = salts or max(1, -(-size // (SLICE_BYTES * SLICES_PER_TASK)))
    rows = docs.select(F.lit(0).alias("none"), quoted(text_col).alias("text")).mapInArrow(
        partial(_counted_slices, contexts=contexts, buckets=buckets, salts=salts), ROW)
    counts = _merged(rows, contexts, buckets)
    if salts > 1:
        counts = _merged(counts.select("bucket", F.lit(0).alias("salt"), "payload"), contexts, buckets)
    counts = written(counts, "lm-counts")
    sums = counts.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _COUNTS.names[2:]]).first()
    customers, pairs = _gathered(counts.select("payload").mapInArrow(
        partial(_context_totals, contexts=contexts), TOTAL), contexts)
    singles = pairs.copy()
    now = Totals(_discount(sums["pairs1"], sums["pairs2"]), _discount(sums["words1"], sums["words2"]),
                 1.0 / (sums["words"] + 1), pairs, int(pairs.sum()), sums["words"])
    seats, samples, totals = counts.select("bucket", "payload"), [], []
    for sweep in range(settings.sweeps):
        seats = written(seats.mapInArrow(
            partial(_swept, contexts=contexts, sweep=sweep, totals=now, settings=settings), "bucket int, payload binary"), "lm-seats")
        found = seats.select("payload").mapInArrow(partial(_seat_totals, contexts=contexts), TOTAL)
        found = written(found.groupBy("context").agg(F.sum("customers").alias("customers"), F.sum("tables").alias("tables")), "lm-totals")
        _, tables = _gathered(found.where("context >= 0"), contexts)
        parent = found.where("context < 0").first()
        if sweep == 0:  # restaurants' tables with one customer never change
            multiple = _multiples(counts, contexts)
            singles = pairs - multiple
        now = Totals(now.discount, now.parent_discount, now.base, singles + tables,
                     parent["customers"] if parent else 0, parent["tables"] if parent else 0)
        if sweep >= settings.burn:
            samples.append(seats)
            totals.append(now)
    return Model(counts, samples, totals, customers, sums["tokens"], sums["words"], buckets, salts, settings)


def _multiples(counts: DataFrame, contexts: int) -> np.ndarray:
    """Dishes with several customers per restaurant."""

    def count(batches):
        many = np.zeros(contexts, np.int64)
        for batch in batches:
            for payload in batch.column(0).to_pylist():
                _, _, context, n = _unpack(payload)
                many += np.bincount(context[n > 1], minlength=contexts)
        yield _totals(np.zeros(contexts, np.int64), many)

    return _gathered(counts.select("payload").mapInArrow(count, TOTAL), contexts)[1]


# --- scores ------------------------------------------------------------------

class _Bucket:
    """The model of one bucket's words."""

    def __init__(self, payload: bytes | None, seats: list[bytes], model: dict):
        self.model, settings = model, model["settings"]
        self.number, self.keys = {}, np.zeros(0, np.int64)
        self.counts = np.zeros(1, np.int64)
        self.word_counts = np.zeros(1, np.int64)
        self.tables = [np.zeros(1, np.int64) for _ in model["totals"]]
        zero = np.zeros(1, np.int64)
        self.parents = [parent_probability(zero, zero, t, settings) for t in model["totals"]]
        if payload is None:
            return
        words, per, context, n = _unpack(payload)
        self.number = {w: i for i, w in enumerate(words.split(b" "))}
        word = np.repeat(np.arange(len(per)), per)
        self.keys = word * settings.contexts + context
        self.counts = np.append(n.astype(np.int64), 0)  # the last place is for what was never seen
        self.word_counts = np.append(np.bincount(word, n, len(per)).astype(np.int64), 0)
        self.tables, self.parents = [], []
        for data, totals in zip(seats, model["totals"]):
            _, _, _, _, _, tables, p_sizes, p_tables = _unpack(data)
            every = np.append(np.ones(len(n), np.int64), 0)
            every[np.flatnonzero(n > 1)] = tables
            self.tables.append(every)
            starts = np.cumsum(p_tables, dtype=np.int64) - p_tables
            customers = np.append(np.add.reduceat(p_sizes.astype(np.int64), starts), 0)
            self.parents.append(parent_probability(customers, np.append(p_tables.astype(np.int64), 0), totals, settings))

    def sums(self, payload: bytes) -> bytes:
        """Documents of a slice with their known tokens, base score and score over this bucket's words."""
        m = self.model
        words, per, context, doc = _unpack(payload)
        ids = np.array([self.number.get(w, -1) for w in words.split(b" ")], np.int64)
        word, context = np.repeat(ids, per), context.astype(np.int64)
        keys = word * m["settings"].contexts + context
        at = np.searchsorted(self.keys, keys)
        hit = np.zeros(len(keys), bool)
        inside = at < len(self.keys)
        hit[inside] = self.keys[at[inside]] == keys[inside]
        at = np.where(hit, at, -1)
        total = np.zeros(len(keys))
        for tables, parent, totals in zip(self.tables, self.parents, m["totals"]):
            total += probability(self.counts[at], tables[at], totals.tables[context], m["customers"][context],
                                 parent[word], totals.discount, m["settings"].strength)
        score = np.log10(total / max(1, len(m["totals"])))
        base = np.log10((self.word_counts[word] + 1.0) / (m["tokens"] + m["words"] + 1.0))
        there, doc = np.unique(doc, return_inverse=True)
        n = len(there)
        known = np.bincount(doc, word >= 0, n).astype(np.int64)
        return _pack(_small(there), _small(known), np.bincount(doc, base, n), np.bincount(doc, score, n))


def _scored(batches, model: dict):
    """Sums per slice from a bucket's model and then its slices; a bucket without a model knows no word."""
    now, bucket = None, None
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(len(batch.columns))]
        out = []
        for b, salt, kind, number, payload, seats in zip(*columns):
            if kind == INFO:
                out.append((b, salt, kind, number, payload))
                continue
            if (b, salt) != now:
                now, bucket = (b, salt), _Bucket(payload if kind == MODEL else None, seats or [], model)
            if kind == TOKENS:
                out.append((b, salt, kind, number, bucket.sums(payload)))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _ROW.types)], schema=_ROW)


def _joined(batches):
    """Rows of each slice from its information and its sums, which follow."""
    now, info, sums = None, None, None

    def made():
        ids, held, sizes = info
        return pa.RecordBatch.from_arrays([
            pa.array(ids, pa.int64()), pa.array(held, pa.bool_()), pa.array(sizes), pa.array(sums[0].astype(np.int64)),
            pa.array(sums[1]), pa.array(sums[2])], schema=_SCORED)

    for batch in batches:
        for number, kind, payload in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if number != now:
                if now is not None:
                    yield made()
                now, info = number, _unpack(payload)
                sums = np.zeros((3, len(info[0])))
                continue
            there, *parts = _unpack(payload)
            for total, part in zip(sums, parts):
                total[there] += part
    if now is not None:
        yield made()


def score(docs: DataFrame, model: Model, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, base_score, score`` of every row of ``docs``."""
    parts = {"totals": model.totals, "customers": model.context_customers, "tokens": model.tokens, "words": model.words,
             "settings": model.settings}
    slices = docs.select(
        quoted(id_col).cast("bigint").alias("doc_id"), quoted(text_col).alias("text"), held_out.alias("held_out")
    ).mapInArrow(partial(_token_slices, contexts=model.settings.contexts, buckets=model.buckets, salts=model.salts), ROW)
    known = model.counts.select("bucket", "payload")
    names = []
    for i, seats in enumerate(model.samples):
        names.append(f"seats{i}")
        known = known.join(seats.withColumnRenamed("payload", names[-1]), "bucket")
    known = known.select(
        "bucket", F.explode(F.sequence(F.lit(0), F.lit(model.salts - 1))).alias("salt"), F.lit(MODEL).alias("kind"),
        F.lit(-1).cast("bigint").alias("slice"), "payload", F.array(*names).cast("array<binary>").alias("seats"))
    both = known.unionByName(slices.withColumn("seats", F.lit(None).cast("array<binary>")))
    dealt = both.repartition(_tasks(docs, model.buckets), "bucket", "salt").sortWithinPartitions("bucket", "salt", "kind", "slice")
    sums = dealt.select("bucket", "salt", "kind", "slice", "payload", "seats").mapInArrow(partial(_scored, model=parts), ROW)
    return sums.select("slice", "kind", "payload").repartition("slice").sortWithinPartitions("slice", "kind").mapInArrow(
        _joined, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")


def perplexity(scored: DataFrame) -> DataFrame:
    """Perplexity per token of the rows of :func:`score`, held out and not, with the base form's."""
    return scored.groupBy("held_out").agg(
        F.pow(F.lit(10.0), -F.sum("score") / F.sum("n_tokens")).alias("perplexity"),
        F.pow(F.lit(10.0), -F.sum("base_score") / F.sum("n_tokens")).alias("base_perplexity"))
