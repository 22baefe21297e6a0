"""Near-duplicate embeddings by product quantisation.

The index is fitted on a bounded sample: k-means of unit vectors gives the coarse
centroids, k-means of the residuals in each subspace the code words.  Every
distinct vector is then put in the inverted list of its nearest centroid, with a
residual code of one byte per subspace.  It visits every list that can hold a vector
within the threshold: one that reaches near enough (the list's radius), and whose side
of the plane between the two centroids is near enough.  In a list, what lies outside
the few directions in which the sample varies most counts by its length only, which
bounds the cosine from above.  Of the members that pass, the visitor's inner
products with the code words that a member's code names, and with the centroid,
approximate the cosine.  A member's residual error bounds how far that can be off, so
only members whose approximation plus error reaches the threshold are compared
exactly, in double precision.  Neither the lists nor the bounds nor the codes lose a
pair.  How many lists are visited depends on how clustered the vectors are: where they
lie at random it is most of them, and the work grows with the square of the distinct
vectors.

Equal vectors are one member with a count, known by a hash of 128 bits outside their
tile.  Neighbouring small lists share a tile, a large list is cut into several, and a tile
is one row of a table in the shared folder.  Every two tiles with lists that can meet do so
in a task that reads both where they lie: vectors are shuffled once, into their tile, and
never copied for a meeting.  Pairs are counted where they are found and never listed.

Defined results: vectors that are null, empty, zero, or hold null or non-finite numbers
link with nothing; vectors of different lengths do not link; repeated rows are
linked; null ids are never the name of a component with another id; an empty table
gives an empty one; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from quarrymill.llm.common import BATCH_SETTING, components, quoted, written

TILE_BYTES = 8 << 20  # of a tile's vectors
CHUNK_BYTES = 16 << 20  # of the vectors among which a task looks for equal ones
DIRECTIONS = 23  # of a sketch


@dataclass(frozen=True)
class Params:
    """``sample`` rows at most fit the index; lists number about the root of the rows, from
    ``least_lists`` to ``most_lists``; ``subspaces`` codes of up to 256 words; a tile has about
    ``block`` rows, more where the table is large (``tile_rows``).  Bounds of the model only: every row is indexed, and all lists that can
    hold a link are visited.  ``probes`` is still taken, and limits nothing."""

    threshold: float = 0.95
    sample: int = 32_768
    least_lists: int = 8
    most_lists: int = 4_096
    probes: int = 16
    subspaces: int = 8
    block: int = 2_048
    rounds: int = 8
    seed: int = 5


@dataclass
class Index:
    centroids: np.ndarray  # lists x width
    words: np.ndarray  # subspaces x words x (width / subspaces)
    width: int  # padded to a multiple of the subspaces
    basis: np.ndarray  # width x directions, orthonormal


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    half, out = 0.5 * (centres * centres).sum(1), np.empty(len(x), np.int64)
    for s in range(0, len(x), 1024):  # a sample times all lists is half a GB
        out[s:s + 1024] = (x[s:s + 1024] @ centres.T - half).argmax(1)
    return out


def _kmeans(x: np.ndarray, k: int, rounds: int, rng: np.random.Generator) -> np.ndarray:
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        who = _nearest(x, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, who, x)
        n = np.bincount(who, minlength=len(centres))
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


def fit(sample: np.ndarray, lists: int, params: Params) -> Index:
    """The index of unit vectors, from a sample of them."""
    rng = np.random.default_rng(params.seed)
    m = params.subspaces
    width = -(-sample.shape[1] // m) * m
    x = np.zeros((len(sample), width), np.float32)
    x[:, : sample.shape[1]] = sample
    centroids = _kmeans(x, lists, params.rounds, rng)
    rest = x - centroids[_nearest(x, centroids)]
    parts = rest.reshape(len(x), m, width // m)
    words = [_kmeans(np.ascontiguousarray(parts[:, j]), 256, params.rounds, rng) for j in range(m)]
    _, basis = np.linalg.eigh(np.cov(x.T.astype(np.float64), bias=True).reshape(width, width))
    return Index(centroids, np.stack(words), width, basis[:, ::-1][:, :DIRECTIONS].copy())


def assign(unit: np.ndarray, index: Index, probes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lists visited (the own one first), codes and residual errors of unit vectors."""
    near = unit @ index.centroids.T - 0.5 * (index.centroids**2).sum(1)
    own = near.argmax(1)
    if probes == 1:
        visited = own[:, None]
    else:
        p = min(probes, near.shape[1])
        visited = np.argpartition(-near, p - 1, axis=1)[:, :p]
        order = np.argsort(-np.take_along_axis(near, visited, 1), axis=1, kind="stable")
        visited = np.take_along_axis(visited, order, 1)
        at = np.argmax(visited == own[:, None], axis=1)  # equal distances: the lowest list number is the own one
        rows = np.arange(len(unit))
        visited[rows, at], visited[:, 0] = visited[:, 0].copy(), own
    rest = unit - index.centroids[own]
    m = len(index.words)
    parts = rest.reshape(len(unit), m, -1)
    codes = np.stack([_nearest(parts[:, j], index.words[j]) for j in range(m)], 1).astype(np.uint8)
    close = np.concatenate([index.words[j][codes[:, j]] for j in range(m)], 1)
    return visited.astype(np.int32), codes, np.linalg.norm(rest - close, axis=1)


def approximate(visitors: np.ndarray, codes: np.ndarray, centroid: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Members x visitors: cosines by table look-up."""
    m = len(words)
    parts = visitors.reshape(len(visitors), m, -1)
    out = np.broadcast_to(visitors @ centroid, (len(codes), len(visitors))).copy()
    for j in range(m):
        table = words[j] @ np.ascontiguousarray(parts[:, j]).T  # words x visitors
        out += table[codes[:, j]]
    return out


def _local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of ``n`` local nodes over edges a-b."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        root = np.minimum(root, root[root])
        if (root == before).all():
            break
    return root


def _padded(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """``(lengths, vectors)`` of a column of arrays, filled up with zeros."""
    n = np.asarray(column.value_lengths()).astype(np.int32)
    flat = np.asarray(column.flatten())
    if (n == width).all():
        return n, flat.reshape(len(n), width)
    raw = np.zeros((len(n), width), flat.dtype)
    at = np.cumsum(n, dtype=np.int64) - n
    raw[np.repeat(np.arange(len(n)), n), np.arange(len(flat)) - np.repeat(at, n)] = flat
    return n, raw


def sketch(unit: np.ndarray, index: Index) -> np.ndarray:
    """The parts of unit vectors along the index's directions, and the length of what is left.

    The inner product of two sketches is no less than that of the vectors.
    """
    along = unit @ index.basis
    left = np.sqrt(np.maximum(0.0, (unit * unit).sum(1) - (along * along).sum(1)))
    return np.column_stack([along, left]).astype(np.float32)


TILE = {"copies": np.int64, "widths": np.int32, "lists": np.int32, "errors": np.float32, "kinds": np.int32, "radius": np.float64}
TILE_SCHEMA = ", ".join(["tile long, hashes binary", *(f"{n} binary" for n in TILE), "codes binary, vecs binary"])


def _unpacked(row: dict, index: Index, kind) -> dict[str, np.ndarray]:
    """The vectors of one packed tile, sorted by list."""
    tile = {n: np.frombuffer(row[n], of) for n, of in TILE.items()}  # kinds: the lists that it has
    n, width = len(tile["widths"]), tile["widths"]
    tile["keys"] = (np.int64(row["tile"]) << 32) + np.arange(n)
    tile["codes"] = np.frombuffer(row["codes"], np.uint8).reshape(n, -1)
    flat = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(width)]).astype(np.int32), np.frombuffer(row["vecs"], kind))
    raw = tile["raw"] = _padded(flat, index.width)[1]
    tile["unit"], tile["sketch"] = np.empty((n, index.width), np.float32), np.empty((n, index.basis.shape[1] + 1), np.float32)
    for s in range(0, n, 4096):
        e = slice(s, s + 4096)
        whole = _whole(raw[e])
        tile["unit"][e], tile["sketch"][e] = whole, sketch(whole, index)
    starts = np.searchsorted(tile["lists"], tile["kinds"])
    tile["spans"] = list(zip(tile["kinds"].tolist(), starts.tolist(), [*starts[1:].tolist(), n]))
    return tile


def _whole(raw: np.ndarray) -> np.ndarray:
    """Unit vectors in double precision."""
    raw = raw.astype(np.float64)
    return raw / np.linalg.norm(raw, axis=1)[:, None]


def _pack(table: pa.Table) -> pa.Table:
    """One row of the distinct vectors of a tile, sorted by list, and how far those of each list reach."""
    column = {n: np.asarray(table.column(n)) for n in ("h1", "h2", "copies", "width", "list", "error", "far")}
    order = np.lexsort((column["h2"], column["h1"], column["list"]))
    sort = {n: c[order] for n, c in column.items()}
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(sort["h1"]) != 0) | (np.diff(sort["h2"]) != 0)
    first, take = np.flatnonzero(new), order[new]
    kinds, start = np.unique(sort["list"], return_index=True)
    hashes = np.column_stack([sort["h1"][first], sort["h2"][first]]).astype(np.int64)
    vecs = table.column("vec").combine_chunks().take(pa.array(take)).flatten()
    codes = table.column("code").combine_chunks().take(pa.array(take)).to_pylist()
    return pa.table({
        "tile": table.column("tile").slice(0, 1), "hashes": [hashes.tobytes()],
        "copies": [np.add.reduceat(sort["copies"], first).astype(np.int64).tobytes()],
        "widths": [sort["width"][first].astype(np.int32).tobytes()], "lists": [sort["list"][first].astype(np.int32).tobytes()],
        "errors": [sort["error"][first].astype(np.float32).tobytes()], "kinds": [kinds.astype(np.int32).tobytes()],
        "radius": [np.maximum.reduceat(sort["far"], start).astype(np.float64).tobytes()],
        "codes": [b"".join(codes)], "vecs": [np.asarray(vecs).tobytes()]})


def reach(threshold: float) -> float:
    """Largest distance of two unit vectors that link, with room for single precision."""
    return max(0.0, 2.0 - 2.0 * threshold) ** 0.5 + 1e-3


def visits(unit: np.ndarray, own: np.ndarray, lists: np.ndarray, index: Index, radius: np.ndarray,
           threshold: float) -> np.ndarray:
    """Which of ``lists``, of that ``radius``, can hold a vector linked with each unit vector, whose nearest centroid is ``own``."""
    r, kinds, which = reach(threshold), *np.unique(own, return_inverse=True)
    mine, c = index.centroids[kinds].astype(np.float64), index.centroids[lists].astype(np.float64)
    unit = unit.astype(np.float64)
    near = unit @ c.T - 0.5 * (c * c).sum(1)
    best = np.einsum("ij,ij->i", unit, mine[which]) - 0.5 * (mine * mine).sum(1)[which]
    far = np.sqrt(np.maximum(0.0, (unit * unit).sum(1)[:, None] - 2.0 * near))
    apart = np.linalg.norm(mine[:, None] - c[None], axis=2)[which]
    return (far <= radius + r) & (best[:, None] - near <= apart * r + 1e-4)


def _linked(a: dict, b: dict, u: np.ndarray, v: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs reach the threshold, in double precision."""
    out = np.empty(len(u), bool)
    for s in range(0, len(u), 1 << 15):
        i, j = u[s:s + (1 << 15)], v[s:s + (1 << 15)]
        x, y = a["raw"][i].astype(np.float64), b["raw"][j].astype(np.float64)
        out[s:s + (1 << 15)] = np.einsum("ij,ij->i", x, y) / (np.linalg.norm(x, axis=1) * np.linalg.norm(y, axis=1)) >= threshold
    return out


def _coded(a: dict, b: dict, u: np.ndarray, v: np.ndarray, centroid: np.ndarray, words: np.ndarray) -> np.ndarray:
    """What ``approximate`` gives, for single pairs of visitors and members."""
    out = np.empty(len(u), np.float32)
    for s in range(0, len(u), 1 << 15):
        i, j = u[s:s + (1 << 15)], v[s:s + (1 << 15)]
        named = words[np.arange(len(words)), b["codes"][j]].reshape(len(j), -1)
        out[s:s + (1 << 15)] = np.einsum("ij,ij->i", a["unit"][i], named + centroid)
    return out


def _places(mask: np.ndarray) -> np.ndarray:
    """``np.flatnonzero``, faster where few are true: 64 places are looked at together."""
    bits = np.packbits(mask)
    words = np.concatenate([bits, np.zeros(-len(bits) % 8, np.uint8)]).view(np.uint64)
    some = np.flatnonzero(words)
    at = np.flatnonzero(np.unpackbits(words[some].view(np.uint8)))
    return some[at >> 6] * 64 + (at & 63)


def _pairs(a: dict, b: dict, q: np.ndarray, x: slice, group: int, index: Index, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Links of visitors ``q`` and the members ``x`` of a list: places in either tile."""
    maybe = b["sketch"][x] @ a["sketch"][q].T >= np.float32(threshold - 1e-5)
    n = np.count_nonzero(maybe)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    if 16 * n <= maybe.size:
        at = _places(maybe)
        xi, qi = np.divmod(at, len(q))
        u, v = q[qi], xi + x.start
        good = b["widths"][v] == a["widths"][u]
        if a is b:
            good &= v > u
        u, v = u[good], v[good]
        if len(u):
            near = _coded(a, b, u, v, index.centroids[group], index.words) >= (threshold - 1e-5) - b["errors"][v]
            u, v = u[near], v[near]
        if len(u):
            exact = _linked(a, b, u, v, threshold)
            u, v = u[exact], v[exact]
        return u, v
    # many: the codes are looked up and one product made for all, and those at the very threshold looked at again
    maybe &= approximate(a["unit"][q], b["codes"][x], index.centroids[group], index.words) >= (threshold - 1e-5) - b["errors"][x][:, None]
    maybe &= b["widths"][x][:, None] == a["widths"][q]
    if a is b:
        maybe &= np.arange(x.start, x.stop)[:, None] > q
    cosines = _whole(b["raw"][x]) @ _whole(a["raw"][q]).T
    close = np.abs(cosines - threshold) < 1e-12
    sure = maybe & (cosines >= threshold) & ~close
    xi, qi = np.nonzero(maybe & close)
    sure[xi, qi] = _linked(a, b, q[qi], xi + x.start, threshold)
    xi, qi = np.nonzero(sure)
    return q[qi], xi + x.start


def _meet(a: dict, b: dict, index: Index, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(links of a's members, links of b's, keys, ties)`` of two tiles, or of one with itself: each pair is met once."""
    alone = a is b
    count_a, count_b = np.zeros(len(a["keys"]), np.int64), np.zeros(len(b["keys"]), np.int64)
    ties_a, ties_b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    offset = 0 if alone else len(a["keys"])
    for _, begin, end in a["spans"]:
        for rows in np.array_split(np.arange(begin, end), -(-(end - begin) // 256)):
            goes = visits(a["unit"][rows], a["lists"][rows], b["kinds"], index, b["radius"], threshold)
            for k in np.flatnonzero(goes.any(0)):
                group, low, high = b["spans"][k]
                if alone and high <= rows[0]:
                    continue
                q = rows[goes[:, k]]
                for s in range(low, high, 1024):  # products that stay in the cache
                    u, v = _pairs(a, b, q, slice(s, min(s + 1024, high)), group, index, threshold)
                    if not len(u):
                        continue
                    np.add.at(count_a, u, b["copies"][v])
                    np.add.at(count_b, v, a["copies"][u])
                    # only what ties the members together is kept of the pairs
                    nodes, local = np.unique(np.concatenate([u, v + offset]), return_inverse=True)
                    roots = _local_roots(len(nodes), local[:len(u)], local[len(u):])
                    ties_a.append(nodes)
                    ties_b.append(nodes[roots])
    keys = a["keys"] if alone else np.concatenate([a["keys"], b["keys"]])
    roots = _local_roots(len(keys), np.concatenate(ties_a), np.concatenate(ties_b))
    said = np.flatnonzero(roots != np.arange(len(keys)))
    return count_a, count_b, keys[said], keys[roots[said]]


def tile_rows(total: int, width: int, each: int, params: Params) -> int:
    """Members of a tile: some 24 tiles, or as many as keep to ``TILE_BYTES``; ``block`` at least."""
    return max(params.block, min(total // 24, TILE_BYTES // (each * width)))


def tiles_of(sizes: np.ndarray, index: Index, block: int) -> tuple[np.ndarray, np.ndarray]:
    """``(bundle of each list, tiles of each bundle)``: neighbouring lists share a bundle of ``block`` rows."""
    c = index.centroids
    half = 0.5 * (c * c).sum(1)
    bundle, total, free = np.zeros(len(sizes), np.int64), [0], np.ones(len(sizes), bool)
    at = 0
    for _ in range(len(sizes)):
        if total[-1] and total[-1] + sizes[at] > block:
            total.append(0)
        bundle[at], free[at] = len(total) - 1, False
        total[-1] += sizes[at]
        at = int(np.where(free, c @ c[at] - half, -np.inf).argmax())  # the nearest list that is left
    return bundle, np.maximum(1, -(-np.array(total) // block))


def partners(lists: list[np.ndarray], radius: list[np.ndarray], index: Index, threshold: float) -> list[str]:
    """For each tile, which ones it meets: a 1 at their place.

    Two tiles meet where two of their lists reach near enough to each other, at one of the two,
    so that every tile has about as many meetings.
    """
    c = index.centroids.astype(np.float64)
    far = np.full(len(c), -np.inf)
    for which, r in zip(lists, radius):
        np.maximum.at(far, which, r)
    norms = (c * c).sum(1)
    holds = np.zeros((len(lists), len(c)), np.float32)
    for t, which in enumerate(lists):
        holds[t, which] = 1
    near = np.empty_like(holds)
    for s in range(0, len(c), 512):
        e = slice(s, s + 512)
        apart = np.sqrt(np.maximum(0.0, norms[e, None] + norms - 2.0 * c[e] @ c.T))
        near[:, e] = holds @ (apart <= far[e, None] + far + reach(threshold) + 1e-6).T.astype(np.float32)
    np.minimum(near, 1.0, out=near)
    meet, j = near @ holds.T > 0, np.arange(len(lists))
    for i, row in enumerate(meet):
        row &= np.where((i + j) % 2 == 0, i <= j, i > j)
    return [row.tobytes().decode() for row in meet.astype(np.uint8) + np.uint8(ord("0"))]


def links(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", params: Params = Params()) -> DataFrame:
    """``vec_id, n_links, component_id, kept``: one row per row of ``df``.

    ``df`` is read three times rather than written once more, so it must give the same rows each time.
    """
    spark = df.sparkSession
    held = df.select(quoted(vec_col)).schema[0].dataType
    single = isinstance(held, ArrayType) and isinstance(held.elementType, FloatType)
    name, kind = ("float", np.float32) if single else ("double", np.float64)
    rows = df.select(quoted(id_col).alias("vec_id"), quoted(vec_col).cast(f"array<{name}>").alias("vec")).withColumn(
        "good", F.coalesce(
            (F.size("vec") > 0)
            & F.forall("vec", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
            & F.exists("vec", lambda v: v != 0), F.lit(False)))
    hashes = [F.xxhash64("vec").alias("h1"), F.xxhash64(F.lit("second"), "vec").alias("h2")]  # 0.0 and -0.0 hash alike
    ids = written(rows.select("vec_id", "good", *hashes, F.size("vec").alias("width")), "pq-ids")
    classes = written(
        ids.where("good").groupBy("h1", "h2").agg(
            F.count("*").alias("copies"), F.min("vec_id").alias("least"), F.max("width").alias("width")), "pq-classes")
    total, widest = classes.agg(F.count("*"), F.max("width")).first()
    if total == 0:
        return ids.select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"),
                          F.col("vec_id").isNotNull().alias("kept"))
    good = rows.where("good").select(*hashes, "vec")
    share = min(1.0, 1.2 * params.sample / total)
    spread = F.shiftrightunsigned("h1", 1)
    few = good if share == 1.0 else good.where(spread <= F.lit(share * float(1 << 63)))
    drawn = lambda x: x.groupBy("vec").agg(F.count("*").alias("copies"), F.min("h1").alias("h1")).orderBy(
        spread, "vec").limit(params.sample).select("vec", "copies").toArrow().combine_chunks()
    found = drawn(few)
    if not found.num_rows:
        found = drawn(good)
    m = params.subspaces
    _, raw = _padded(found.column("vec").combine_chunks(), -(-widest // m) * m)
    sample = _whole(raw)[:, :widest].astype(np.float32)
    lists = int(min(params.most_lists, max(params.least_lists, round(total**0.5)), len(sample)))
    index = fit(sample, lists, params)
    model = spark.sparkContext.broadcast(index)  # at most most_lists + 256 vectors

    # lists are put together to tiles by what the sample tells of their size
    each = np.dtype(kind).itemsize
    own = _nearest(np.pad(sample, ((0, 0), (0, index.width - widest))), index.centroids)
    size = tile_rows(total, index.width, each, params)
    scale = total / len(sample)
    sizes = np.bincount(own, minlength=len(index.centroids)) * scale
    bundle, blocks = tiles_of(sizes, index, size)
    # a vector comes to its tile once from each chunk of input that has it
    chunks = 1 + found.column("copies").to_numpy().sum() * scale * index.width * each / CHUNK_BYTES
    often = np.bincount(bundle[own], np.minimum(found.column("copies").to_numpy(), chunks), minlength=len(blocks)) * scale
    blocks = np.maximum(blocks, np.ceil(often / (4 * size))).astype(np.int64)
    begins = np.cumsum(blocks) - blocks
    homes = spark.sparkContext.broadcast((begins[bundle], blocks[bundle]))

    def place(batches):
        ix, (begin, block) = model.value, homes.value
        for table in _chunks(batches):
            h1, h2 = (np.asarray(table.column(n)) for n in ("h1", "h2"))
            order = np.lexsort((h2, h1))
            new = np.ones(len(order), bool)
            new[1:] = (np.diff(h1[order]) != 0) | (np.diff(h2[order]) != 0)
            first = np.flatnonzero(new)
            copies, vecs = np.diff(np.append(first, len(order))), table.column("vec").combine_chunks()
            for s in range(0, len(first), 1024):
                e = slice(s, s + 1024)
                vec = vecs.take(pa.array(order[first[e]]))
                width, raw = _padded(vec, ix.width)
                unit = _whole(raw).astype(np.float32)
                visited, codes, error = assign(unit, ix, 1)
                own = visited[:, 0]
                far = np.linalg.norm(unit - ix.centroids[own], axis=1).astype(np.float64)
                a, b = h1[order[first[e]]], h2[order[first[e]]]
                yield pa.RecordBatch.from_arrays([
                    pa.array(begin[own] + b % block[own]), pa.array(a), pa.array(b), pa.array(copies[e].astype(np.int64)), vec,
                    pa.array(width), pa.array(own.astype(np.int32)), pa.array([c.tobytes() for c in codes], pa.binary()),
                    pa.array(error.astype(np.float32)), pa.array(far),
                ], names=["tile", "h1", "h2", "copies", "vec", "width", "list", "code", "error", "far"])

    count = int(blocks.sum())
    coded = good.mapInArrow(
        place, f"tile long, h1 long, h2 long, copies long, vec array<{name}>, width int, list int, code binary, error float, far double")
    tiles = written(coded.repartition(count, "tile").groupBy("tile").applyInArrow(_pack, TILE_SCHEMA), "pq-tiles")

    # one row per tile comes to the driver: its lists and how far they reach
    reached = {r["tile"]: (np.frombuffer(r["kinds"], np.int32), np.frombuffer(r["radius"], np.float64))
               for r in tiles.select("tile", "kinds", "radius").collect()}
    none = (np.empty(0, np.int32), np.empty(0))
    met = partners(*zip(*(reached.get(t, none) for t in range(count))), index, params.threshold)
    plan = spark.createDataFrame(pa.table({"tile": pa.array(range(count), pa.int64()), "met": met}))
    parts = min(count, max(12, -(-count // 8)))
    fields = [n for n in tiles.columns if n != "hashes"]
    one = tiles.select(fields).join(F.broadcast(plan), "tile").coalesce(parts).select(
        "met", *(F.col(n).alias(f"a_{n}") for n in fields))
    two = tiles.select(*(F.col(n).alias(f"b_{n}") for n in fields)).coalesce(parts)
    # both sides are read where they lie: nothing is copied
    sides = one.join(two.hint("shuffle_replicate_nl"), F.expr("substring(met, int(b_tile) + 1, 1) = '1'")).drop("met")

    def meet(batches):
        yield from _met(batches, model.value, kind, params)

    before = spark.conf.get(BATCH_SETTING, None)
    spark.conf.set(BATCH_SETTING, "1")  # a row holds two tiles
    try:
        said = written(sides.mapInArrow(meet, "key long, links long, tie long"), "pq-links")
    finally:
        spark.conf.unset(BATCH_SETTING) if before is None else spark.conf.set(BATCH_SETTING, before)
    counts = said.where("links > 0").groupBy("key").agg(F.sum("links").alias("links"))
    roots = components(said.where("key <> tie").select("key", "tie"), "key", "tie").withColumnRenamed("node", "key")
    names = tiles.select("tile", "hashes").mapInArrow(_names, "key long, h1 long, h2 long")
    named = names.join(counts, "key", "left").join(roots, "key", "left").select(
        "h1", "h2", F.coalesce("root", "key").alias("root"), F.coalesce("links", F.lit(0)).alias("links"))
    known = written(named.join(classes.drop("width"), ["h1", "h2"]), "pq-named")
    least = known.groupBy("root").agg(F.min("least").alias("component_id"))
    answer = known.join(least, "root").select("h1", "h2", (F.col("links") + F.col("copies") - 1).alias("links"), "component_id")
    joined = ids.where("good").join(answer, ["h1", "h2"]).select("vec_id", F.col("links").cast("bigint").alias("n_links"), "component_id")
    alone = ids.where("not good").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return joined.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _chunks(batches):
    """Tables of some ``CHUNK_BYTES``, of the batches of a partition."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= CHUNK_BYTES:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _names(batches):
    """Keys and hashes of the members of tiles."""
    for batch in batches:
        for tile, packed in zip(batch.column("tile").to_pylist(), batch.column("hashes").to_pylist()):
            h = np.frombuffer(packed, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array((np.int64(tile) << 32) + np.arange(len(h))), pa.array(h[:, 0]), pa.array(h[:, 1])], names=["key", "h1", "h2"])


def _met(batches, index: Index, kind, params: Params):
    """Counts and ties of the tiles of a task that meet, put together over all its meetings."""
    held: dict[int, dict] = {}
    links: dict[int, np.ndarray] = {}
    ties: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def opened(row: dict, side: str, spare: int) -> dict:
        tile = row[f"{side}_tile"]
        if tile not in held:
            while len(held) > 8:
                held.pop(next(t for t in held if t != spare))
            held[tile] = _unpacked({n[2:]: v for n, v in row.items() if n.startswith(side)}, index, kind)
            links.setdefault(tile, np.zeros(len(held[tile]["keys"]), np.int64))
        return held[tile]

    def tied() -> tuple[np.ndarray, np.ndarray]:
        low, high = (np.concatenate(x) for x in zip(*ties))
        nodes, local = np.unique(np.concatenate([low, high]), return_inverse=True)
        roots = _local_roots(len(nodes), local[:len(low)], local[len(low):])
        off = roots != np.arange(len(nodes))
        return nodes[off], nodes[roots[off]]

    for batch in batches:
        for row in batch.to_pylist():
            a = opened(row, "a", -1)
            b = opened(row, "b", row["a_tile"])
            count_a, count_b, low, high = _meet(a, b, index, params.threshold)
            links[row["a_tile"]] += count_a
            links[row["b_tile"]] += count_b
            ties.append((low, high))
            size += len(low)
            if size > 1 << 21:
                ties = [tied()]
                size = len(ties[0][0]) // 2
    for tile, count in links.items():
        some = np.flatnonzero(count)
        keys = (np.int64(tile) << 32) + some
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(count[some]), pa.array(keys)], names=["key", "links", "tie"])
    if size:
        low, high = tied()
        yield pa.RecordBatch.from_arrays([pa.array(low), pa.array(np.zeros(len(low), np.int64)), pa.array(high)], names=["key", "links", "tie"])
