"""The prefix trie of conversations, by ROLLUP over columns of turn ids.

Turns become ids (two 64-bit hashes and the length of the text).  Conversations
are laid out in blocks of ``WIDTH`` turn-id columns; a block is keyed by the node at
which the block before it ended, a hash of the turns up to there that is made by
exclusive or, so it is known without walking the blocks one after another.  One
``ROLLUP`` over the columns then aggregates every prefix of every block of every
conversation at once, and ``grouping_id`` tells the depth.

Sums over a subtree need no walk either.  Each node belongs to its smallest member;
a conversation owns the nodes of its path from some depth on.  A first ROLLUP finds
those depths; a second one adds up, over the members of each prefix, the bytes
they hold and the bytes they own, whose difference is what sharing saves, and the
leaves they own, which are the leaves below.

Defined results: turns are ordered by number, nulls first, equal numbers by role and
then by the SHA-256 of the text; a null role or text is an empty one; rows without a
conversation id belong to no conversation and give nothing; repeated rows are turns of their own; an
empty table gives no node, not even a root; other columns are ignored; texts of any length count
whole, as they are hashed where they are read.
"""

from __future__ import annotations

import hashlib
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from quarrymill.llm.common import quoted, written
from quarrymill.operators.ordered import numbered

WIDTH = 8  # turn-id columns of a block
SCAN = 65_536  # blocks of one conversation that are scanned together
IDS_PER_CHUNK = 50_000
GROUP, LONGEST = 5, 9
_CHUNK = pa.schema([("e1", pa.int64()), ("e2", pa.int64()), ("first", pa.int64()), ("ids", pa.string())])
_HASHED = pa.schema([("e1", pa.int64()), ("e2", pa.int64()), ("ends_sha256", pa.string())])


def numbered_turns(df: DataFrame, id_col: str = "conv_id", turn_col: str = "turn",
                   role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, seq`` (from 1) and ``a, b, bytes``, the turn's id."""
    role, text = (F.coalesce(quoted(c), F.lit("")) for c in (role_col, text_col))
    rows = df.where(quoted(id_col).isNotNull()).select(
        quoted(id_col).cast("bigint").alias("conv_id"), quoted(turn_col).cast("bigint").alias("turn"),
        role.alias("role"), F.sha2(text, 256).alias("sha"),
        F.xxhash64(role, text).alias("a"), F.xxhash64(F.lit(29), text, role).alias("b"),
        F.octet_length(text).cast("bigint").alias("bytes"),
    )
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("sha")]
    return numbered(rows, ["conv_id"], order, "seq", "turn").select("conv_id", "seq", "a", "b", "bytes")


def rebuilt(turns: DataFrame, group: int = GROUP, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """Rebuilt turns ``conv_id, pos, a, b, bytes``, and all conversations (one column ``conv_id``).

    Conversation ``c`` takes the first ``h`` turns of ``c - c % group``, where ``h`` is
    the CRC-32 of its decimal number modulo ``longest``, and then its own after its first ``h``.
    """
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % longest
    convs = written(sizes.select("conv_id", "n", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % group).alias("base")),
                    "trie-conversations")
    lengths = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    plans = written(convs.join(lengths, "base", "left").select(
        "conv_id", "base", "h", F.least("h", F.coalesce("n_base", F.lit(0))).alias("taken")), "trie-plans")
    heads = turns.where(F.col("seq") < longest).withColumnRenamed("conv_id", "base").join(
        plans.select("base", "conv_id", "h"), "base").where("seq <= h").select(
        "conv_id", F.col("seq").alias("pos"), "a", "b", "bytes")
    tails = turns.join(plans.select("conv_id", "h", "taken"), "conv_id").where("seq > h").select(
        "conv_id", (F.col("taken") + F.col("seq") - F.col("h")).alias("pos"), "a", "b", "bytes")
    return heads.union(tails), convs.select("conv_id")


def _step(pos: Column, turn: Column, seed: int) -> Column:
    """What a turn at a place adds to the hash of a path."""
    return F.xxhash64(F.lit(seed), pos, turn["a"], turn["b"], turn["bytes"])


def blocks(turns: DataFrame, convs: DataFrame, width: int = WIDTH, scan: int = SCAN) -> DataFrame:
    """One row per conversation and block: ``block``, the key ``p1, p2`` of the node before it, the bytes
    before it, the turn columns, and the conversation's length, bytes and end node.

    A conversation without turns is one row with empty columns.  Blocks of a very long
    conversation are scanned in parts of ``scan``.
    """
    place = F.col("pos") - 1
    turn = F.struct("a", "b", "bytes")
    cut = turns.select(
        "conv_id", "pos", F.expr(f"cast((pos - 1) div {width} as bigint)").alias("block"), turn.alias("turn"),
        (place % width).alias("slot"))
    laid = cut.groupBy("conv_id", "block").agg(
        F.sort_array(F.collect_list(F.struct("slot", "turn"))).alias("turns"),
        F.bit_xor(_step(F.col("pos"), F.col("turn"), 1)).alias("x1"),
        F.bit_xor(_step(F.col("pos"), F.col("turn"), 2)).alias("x2"),
        F.sum("turn.bytes").alias("held"),
    ).withColumn("part", F.expr(f"block div {scan}"))
    laid = written(laid, "trie-blocks")
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("conv_id", "part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    parts = laid.groupBy("conv_id", "part").agg(
        F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"), F.sum("held").alias("held"))
    parts = parts.select("conv_id", "part", *[
        F.coalesce(fold(c).over(before), F.lit(0)).alias(f"part_{c}")
        for c, fold in (("x1", F.bit_xor), ("x2", F.bit_xor), ("held", F.sum))])
    placed = laid.select("*", *[
        F.coalesce(fold(c).over(inside), F.lit(0)).alias(f"in_{c}")
        for c, fold in (("x1", F.bit_xor), ("x2", F.bit_xor), ("held", F.sum))]).join(parts, ["conv_id", "part"])
    rows = placed.select(
        "conv_id", "block", F.col("in_x1").bitwiseXOR(F.col("part_x1")).alias("p1"),
        F.col("in_x2").bitwiseXOR(F.col("part_x2")).alias("p2"), (F.col("in_held") + F.col("part_held")).alias("before"),
        *[F.get("turns", F.lit(i))["turn"].alias(f"t{i + 1}") for i in range(width)])
    whole = laid.groupBy("conv_id").agg(
        F.sum(F.size("turns")).alias("len"), F.sum("held").alias("total"),
        F.bit_xor("x1").alias("e1"), F.bit_xor("x2").alias("e2"))
    known = convs.join(whole, "conv_id", "left").na.fill(0, ["len", "total", "e1", "e2"])
    joined = known.join(rows, "conv_id", "left").na.fill(0, ["block", "p1", "p2", "before"])
    return written(joined, "trie-members")


def _rollup(members: DataFrame, width: int, aggregates: str) -> DataFrame:
    """All prefixes of all blocks: ``depth``, path keys ``x1, x2``, the parent's ``u1, u2``, the bytes
    ``above`` the last turn, and the aggregates.

    The prefix of no turns is the root in the first block; in a later one it is the last
    node of the block before, which is there already.
    """
    names = [f"t{i + 1}" for i in range(width)]
    listed = ", ".join(names)
    every = members.sparkSession.sql(
        f"select block, p1, p2, {listed}, {width} - bit_count(grouping_id()) as level, min(before) as before, {aggregates} "
        f"from {{members}} group by block, p1, p2, rollup({listed})", members=members)
    turns = F.array(*[F.col(n) for n in names])
    real = every.where(
        ((F.col("level") == 0) & (F.col("block") == 0))
        | ((F.col("level") > 0) & F.get(turns, F.col("level") - 1).isNotNull()))
    depth = F.col("block") * width + F.col("level")

    def path(key: str, seed: int, levels: Column) -> Column:
        made = F.col(key)
        for i, name in enumerate(names):
            step = _step(F.col("block") * width + (i + 1), F.col(name), seed)
            made = made.bitwiseXOR(F.when(levels > i, step).otherwise(F.lit(0).cast("bigint")))
        return made

    above = F.col("before")
    for i, name in enumerate(names[:-1]):
        above = above + F.when(F.col("level") > i + 1, F.col(name)["bytes"]).otherwise(0)
    return real.select(
        depth.alias("depth"), above.alias("above"),
        path("p1", 1, F.col("level")).alias("x1"), path("p2", 2, F.col("level")).alias("x2"),
        path("p1", 1, F.col("level") - 1).alias("u1"), path("p2", 2, F.col("level") - 1).alias("u2"),
        *[F.col(c) for c in every.columns if c not in ("block", "p1", "p2", "level", "before", *names)])


def _chunks(batches, limit: int):
    """Runs of ids with the same end, in order, joined by commas in texts of up to ``limit`` ids."""
    key, first, held = None, None, []
    for batch in batches:
        out = []
        for e1, e2, conv in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if (e1, e2) != key or len(held) >= limit:
                if held:
                    out.append((*key, first, ",".join(held)))
                key, first, held = (e1, e2), conv, []
            held.append(str(conv))
        if out:
            yield pa.RecordBatch.from_pylist([dict(zip(_CHUNK.names, r)) for r in out], schema=_CHUNK)
    if held:
        yield pa.RecordBatch.from_pylist([dict(zip(_CHUNK.names, (*key, first, ",".join(held))))], schema=_CHUNK)


def _hash_chunks(batches):
    key, state = None, None
    for batch in batches:
        out = []
        for e1, e2, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3))):
            if (e1, e2) != key:
                if state is not None:
                    out.append((*key, state.hexdigest()))
                key, state = (e1, e2), hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.encode())
        if out:
            yield pa.RecordBatch.from_pylist([dict(zip(_HASHED.names, r)) for r in out], schema=_HASHED)
    if state is not None:
        yield pa.RecordBatch.from_pylist([dict(zip(_HASHED.names, (*key, state.hexdigest())))], schema=_HASHED)


def end_digests(ends: DataFrame, ids_per_chunk: int = IDS_PER_CHUNK) -> DataFrame:
    """``e1, e2, ends_sha256`` of the comma-joined ids of each end node.

    A node may end a third of all conversations: its ids are sorted and joined in
    chunks by ranges, and only chunks are run through the hash in one task, as a stream.
    """
    parts = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = ends.select("e1", "e2", "conv_id").repartitionByRange(parts, "e1", "e2", "conv_id")
    chunked = dealt.sortWithinPartitions("e1", "e2", "conv_id").mapInArrow(
        partial(_chunks, limit=ids_per_chunk), "e1 long, e2 long, first long, ids string")
    return chunked.repartition(parts, "e1", "e2").sortWithinPartitions("e1", "e2", "first").mapInArrow(
        _hash_chunks, "e1 long, e2 long, ends_sha256 string")


def trie(turns: DataFrame, convs: DataFrame, width: int = WIDTH, scan: int = SCAN,
         ids_per_chunk: int = IDS_PER_CHUNK) -> DataFrame:
    """Nodes of the trie of ``turns`` (``conv_id, pos, a, b, bytes``), one row each.

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens``, ``ends_sha256``.
    """
    members = blocks(turns, convs, width, scan)
    owners = _rollup(members, width, "min(conv_id) as conv_id, max(len) as longest")
    firsts = written(owners.groupBy("conv_id").agg(
        F.min(F.struct("depth", "above")).alias("first"), F.max(F.col("longest") == F.col("depth")).alias("leaf")),
        "trie-owners")
    owned = members.join(firsts, "conv_id", "left").select(
        *[c for c in members.columns], F.coalesce(F.col("total") - F.col("first.above"), F.lit(0)).alias("own"),
        F.coalesce(F.col("leaf").cast("bigint"), F.lit(0)).alias("leaf"), F.col("first.depth").alias("since"))
    nodes = written(_rollup(owned, width, (
        "count(*) as n_convs, sum(leaf) as n_leaves, sum(own) as own, sum(total) as total, "
        "min(struct(conv_id, since, own, total)) as least")).select(
        "depth", "x1", "x2", "u1", "u2", F.col("least.conv_id").alias("conv_id"), F.col("least.since").alias("since"),
        "n_convs", "n_leaves",
        (F.col("total") - F.col("n_convs") * F.col("above")
         - (F.col("own") - F.col("least.own") + F.col("least.total") - F.col("above"))).alias("saved_tokens")),
        "trie-nodes")
    kept = ["conv_id", "depth", "x1", "x2", "n_convs", "n_leaves", "saved_tokens"]
    # below the first node that a conversation owns, the parent is its own as well
    inner = nodes.where("depth = 0 or depth > since").select(
        *kept, F.when(F.col("depth") > 0, F.col("conv_id")).alias("parent_conv_id"))
    heads = nodes.where("depth > 0 and depth = since")
    above = nodes.select(F.col("x1").alias("u1"), F.col("x2").alias("u2"), (F.col("depth") + 1).alias("depth"),
                         F.col("conv_id").alias("parent_conv_id"))
    outer = heads.join(above, ["u1", "u2", "depth"]).select(*kept, "parent_conv_id")
    linked = written(inner.union(outer), "trie-linked")
    children = linked.where("depth > 0").groupBy(
        F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children"))
    ends = end_digests(members.where("block = 0"), ids_per_chunk).withColumnsRenamed({"e1": "x1", "e2": "x2"})
    full = linked.join(children, ["conv_id", "depth"], "left").join(ends, ["x1", "x2"], "left")
    return full.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
        "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def conversation_trie(df: DataFrame, group: int = GROUP, longest: int = LONGEST, width: int = WIDTH,
                      scan: int = SCAN, ids_per_chunk: int = IDS_PER_CHUNK) -> DataFrame:
    """The trie of a table of turns, rebuilt as :func:`rebuilt` says."""
    turns = written(numbered_turns(df), "trie-turns")
    made, convs = rebuilt(turns, group, longest)
    return trie(made, convs, width, scan, ids_per_chunk)
