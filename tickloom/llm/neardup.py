"""Near-duplicate groups by chosen-path set similarity join.

Every text becomes the set of its k-word shingles (64-bit hashes of words lower-cased in A-Z) and a signature of
COORDS minwise values of one byte. Rows with equal sets fall together first, by a 128-bit fingerprint of the whole set. The
representatives are then branched: a node of a tree picks, by a hash of its own path, one minwise coordinate and with
a probability of about 1/threshold - 1 a second one; a text goes to the child (node, coordinate, its value there), so
two sets at the threshold share a little over one child a level on average. Independent trees repeat this for recall.
Pairs that pass on signatures are confirmed on the full sets.

Groups are joined before branching goes deep. The first nodes of some trees send out spanning forests of their likely
pairs (large nodes in blocks and block leaders); these are confirmed and joined to groups. From then on a node whose
members are all of one group can give no new link and is left. A node of at most LEAF texts is compared exhaustively; one
of which at most LEAF members stand outside its main group has these compared with all members, block by block; any
other branches on, DEPTH_STEP levels at a time, up to MAX_DEPTH levels, where it is compared block by block too. A second
forest, over these nodes, joins more groups; then every pair whose ends are still in different groups is sent out, from
the first node that its ends share. So no candidate link is dropped, yet a group of n copies costs about n pairs. Where
many candidates hang together without being linked (texts just below the threshold), the node's texts are sent out in
place of their pairs, and compared on full sets in one task that gets each set once.

Null or empty texts and texts without words have the empty set and link with nothing. Null ids: a group of their own
without an id, kept. Rows that share an id are one vertex. Ties of ids cannot occur: the smallest id stands.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.cluster import saved, scratch, ship
from tickloom.llm import scan

COORDS = 256
LEAF = BLOCK = 512
#: Candidates that hang together in a node are confirmed as one block from so many texts on, and pair by pair below.
CLIQUE = 6
TASK_EDGES = 200_000
SALTS = 16
FIRST_DEPTH, DEPTH_STEP, MAX_DEPTH = 4, 2, 28
#: Trees whose first nodes make the first groups.
SEED_TREES = 5
#: Nodes branch as if for pairs this much less similar: then a pair at the threshold is not lost with depth.
BRANCH_SLACK = 0.03
BOTH, LEFT, RIGHT, AGAIN = range(4)
_U = np.uint64
_RNG = np.random.default_rng(0xC05)
_MUL = _RNG.integers(0, 2**31, COORDS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_XOR = _RNG.integers(0, 2**32, COORDS, dtype=np.uint32)
_SECOND, _PICK2 = _U(0xA24BAED4963EE407), _U(0x9FB21C651E98DF25)


def _shingles(block: scan.Block, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all shingles in order, where each text's begin)."""
    words = block.words(scan.NOT_SPACE, scan.LOWER)
    first, h = words.windows(k, short=True)
    return h, np.searchsorted(first, words.at)


def _sketch_rows(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in scan.blocks(batch.column(1)):
                h, at = _shingles(block, k)
                n = np.zeros(block.n, np.int64)
                fa, fb = np.zeros(block.n, np.uint64), np.zeros(block.n, np.uint64)
                sig = np.zeros((block.n, COORDS), np.uint8)
                for i in range(block.n):
                    if at[i] < at[i + 1]:
                        own = np.unique(h[at[i] : at[i + 1]])
                        n[i] = len(own)
                        fa[i], fb[i] = scan.mix(own).sum(), scan.mix(own ^ _PICK2).sum()
                full = np.flatnonzero(n)
                if len(full):
                    # 32 bits tell the shingles of a text apart well enough to order them
                    starts, low = at[:-1][full], h.astype(np.uint32)
                    order = np.empty_like(low)
                    for c in range(COORDS):
                        np.multiply(np.bitwise_xor(low, _XOR[c], out=order), _MUL[c], out=order)
                        sig[full, c] = (scan.mix(np.minimum.reduceat(order, starts).astype(np.uint64)) & _U(255)).astype(np.uint8)
                raw = sig.tobytes()
                width = COORDS
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(block.first, block.n),
                        pa.array(n),
                        pa.array(fa.view(np.int64)),
                        pa.array(fb.view(np.int64)),
                        pa.array([raw[i * width : (i + 1) * width] for i in range(block.n)], pa.binary()),
                    ],
                    ["id", "n", "fa", "fb", "sig"],
                )

    return run


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5) -> DataFrame:
    """id, n (distinct shingles), fa, fb (fingerprint of the set) and sig (minwise values) of every row."""
    ship(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(_sketch_rows(k), "id long, n long, fa long, fb long, sig binary")


def _sig(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), COORDS)


def _branch(sig: np.ndarray, row: np.ndarray, key: np.ndarray, levels: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, node) of all nodes that the rows reach, so many levels below the nodes key."""
    second = _U(int((1 / (threshold - BRANCH_SLACK) - 1) * 2**64))
    for _ in range(levels):
        a = scan.mix(key)
        more = np.flatnonzero(scan.mix(key ^ _SECOND) < second)
        row, key = np.concatenate([row, row[more]]), np.concatenate([key, key[more]])
        at = (np.concatenate([a, scan.mix(a[more] ^ _PICK2)]) % _U(COORDS)).astype(np.int64)
        key = scan.mix(key ^ scan.mix((at.astype(np.uint64) << _U(32)) | sig[row, at].astype(np.uint64)))
    return row, key


def _node_rows(trees: int, levels: int, threshold: float):
    """Columns: id, comp, sig, and tree and key if trees is 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2000):
                batch = whole.slice(at, 2000)
                ids, comp = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in (0, 1))
                sig, n = _sig(batch.column(2)), batch.num_rows
                # a row of its own for each (text, tree)
                if trees:
                    of, tree = np.tile(np.arange(n), trees), np.repeat(np.arange(1, trees + 1), n)
                    key = scan.mix(tree.astype(np.uint64))
                else:
                    of, tree = np.arange(n), batch.column(3).to_numpy(zero_copy_only=False).astype(np.int64)
                    key = batch.column(4).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
                row, key = _branch(sig[of], np.arange(len(of)), key, levels, threshold)
                got = np.unique(np.stack([key.view(np.int64), ids[of][row], comp[of][row], tree[row]]), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in got], ["key", "id", "comp", "tree"])

    return run


class _Forest:
    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def _agreeing(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """In how many coordinates each row of x equals each row of y."""
    if len(x) * len(y) <= 12_000:  # where the calls below would cost more
        return (x[:, None, :] == y[None]).sum(2, dtype=np.uint16)
    x, y = np.ascontiguousarray(x.T), np.ascontiguousarray(y.T)
    out = np.zeros((x.shape[1], y.shape[1]), np.uint16)
    for at in range(0, COORDS, 128):  # so many fit into one byte
        part = np.zeros(out.shape, np.uint8)
        for c in range(at, at + 128):
            part += (x[c][:, None] == y[c][None]).view(np.uint8)
        out += part
    return out


def _compare(least: int, threshold: float, forest: bool):
    """Columns key, id, n, sig, comp, side, node, keys: rows of a key stand together. Pairs a, b of ids of different comps
    of which at least so many minwise values agree and whose sizes allow the threshold: a spanning forest of the comps,
    or all, each only in the first node of the keys that both ids are in. Where these hang together to CLIQUE texts or more,
    their texts are given instead of their pairs: a of a block, without b. side: BOTH, or LEFT and RIGHT (or AGAIN: right
    here, left elsewhere) under a key whose pairs go from left to right only."""

    def alike(ids, n, sig, comp, side):
        """Chunks of (row, row, agreeing values), from the first side to the other."""
        plain = side[0] == BOTH
        left = np.arange(len(ids)) if plain else np.flatnonzero(side == LEFT)
        right = left if plain else np.flatnonzero(side != LEFT)
        for i in range(0, len(left), 128):
            own = left[i : i + 128]
            y = right[i:] if plain else right  # pairs before are done
            same = _agreeing(sig[own], sig[y])
            small, large = np.minimum(n[own, None], n[None, y]), np.maximum(n[own, None], n[None, y])
            ok = (same >= least) & (small >= threshold * large) & (comp[own, None] != comp[None, y])
            a, b = np.nonzero(ok)
            same, a, b = same[a, b], own[a], y[b]
            once = a < b if plain else (side[b] == RIGHT) | (ids[a] < ids[b])
            yield a[once], b[once], same[once]

    def node(key, ids, n, sig, comp, side, node, keys, out):
        if forest:
            _, group = np.unique(comp, return_inverse=True)
            tree = _Forest(int(group.max()) + 1)
            for x, y, same in alike(ids, n, sig, comp, side):
                for j in np.argsort(-same.astype(np.int64), kind="stable").tolist():
                    if tree.join(int(group[x[j]]), int(group[y[j]])):
                        out.add((int(min(ids[x[j]], ids[y[j]])), int(max(ids[x[j]], ids[y[j]])), None))
            return
        own, pairs, tree = [frozenset(k) for k in keys], [], _Forest(len(ids))
        for x, y, _ in alike(ids, n, sig, comp, side):
            for i, j in zip(x.tolist(), y.tolist(), strict=True):
                if min(own[i] & own[j]) == node[i]:
                    pairs.append((i, j))
                    tree.join(i, j)
        members: dict[int, set[int]] = {}
        for i in {i for pair in pairs for i in pair}:
            members.setdefault(tree.find(i), set()).add(int(ids[i]))
        for i, j in pairs:
            if len(members[tree.find(i)]) < CLIQUE:
                out.add((int(min(ids[i], ids[j])), int(max(ids[i], ids[j])), None))
        for some in members.values():
            if len(some) >= CLIQUE:
                block = int(scan.mix(np.array([key, min(some)], np.int64).view(np.uint64)).sum().view(np.int64))
                out.update((i, None, block) for i in some)

    def table(batch: pa.RecordBatch) -> list[np.ndarray]:
        long = [batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1, 2, 4, 5, 6)]
        keys = np.empty(batch.num_rows, object)
        keys[:] = batch.column(7).to_pylist() if not forest else None
        return [*long[:3], _sig(batch.column(3)), *long[3:], keys]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[np.ndarray] | None = None

        def work(rows: list[np.ndarray], upto: int) -> pa.RecordBatch:
            out: set[tuple] = set()
            key = rows[0][:upto]
            cut = np.flatnonzero(np.diff(key)) + 1 if upto else np.zeros(0, np.int64)
            for s, e in zip([0, *cut.tolist()], [*cut.tolist(), upto], strict=True):
                if e - s > 1:
                    node(int(key[s]), *(x[s:e] for x in rows[1:]), out)
            return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in range(3)], ["a", "b", "block"])

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = table(batch)
            if rest is not None:
                rows = [np.concatenate(x) for x in zip(rest, rows, strict=True)]
            upto = int(np.searchsorted(rows[0], rows[0][-1]))  # the last node may go on in the next batch
            rest = [x[upto:] for x in rows]
            yield work(rows, upto)
        if rest is not None:
            yield work(rest, len(rest[0]))

    return run


def _set_rows(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in scan.blocks(batch.column(1)):
                h, at = _shingles(block, k)
                sets = [np.unique(h[at[i] : at[i + 1]]).tobytes() for i in range(block.n)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(block.first, block.n), pa.array(sets, pa.binary())], ["id", "hashes"])

    return run


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns a, b, left, right (sorted hashes): common and all hashes of each pair."""
    for batch in batches:
        both, either = [], []
        for x, y in zip(batch.column(2), batch.column(3), strict=True):
            x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
            c = len(np.intersect1d(x, y, assume_unique=True))
            both.append(c)
            either.append(len(x) + len(y) - c)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(both, pa.int64()), pa.array(either, pa.int64())], ["a", "b", "both", "either"])


def _common(sets: list[np.ndarray]) -> np.ndarray:
    """How many values each set has in common with each other."""
    of = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, value, n = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    several = n[value] > 1
    of, value = of[several], np.unique(value[several], return_inverse=True)[1]
    order = np.argsort(value, kind="stable")
    of, value = of[order], value[order]
    out = np.zeros((len(sets), len(sets)))
    for at in range(0, int(value[-1]) + 1 if len(value) else 0, 4096):
        s, e = np.searchsorted(value, [at, at + 4096])
        has = np.zeros((4096, len(sets)), np.float32)
        has[value[s:e] - at, of[s:e]] = 1
        out += has.T @ has  # whole numbers below 2^24
    return out.astype(np.int64)


def _confirm_blocks(percent: int):
    """Columns block, id, hashes: rows of a block stand together. A spanning forest of the links in each block, on full
    sets: enough to connect whatever is linked there."""

    def links(ids: list[int], sets: list[np.ndarray]) -> list[tuple[int, int]]:
        n, both = np.array([len(x) for x in sets]), _common(sets)
        x, y = np.nonzero(np.triu((both > 0) & (100 * both >= percent * (n[:, None] + n[None] - both)), 1))
        tree = _Forest(len(ids))
        return [(min(ids[i], ids[j]), max(ids[i], ids[j])) for i, j in zip(x.tolist(), y.tolist(), strict=True) if tree.join(i, j)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, ids, sets = None, [], []

        def done() -> pa.RecordBatch:
            found = links(ids, sets) if len(ids) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], ["a", "b"])

        for batch in batches:
            for block, i, h in zip(*(batch.column(c) for c in range(3)), strict=True):
                if block.as_py() != own:
                    yield done()
                    own, ids, sets = block.as_py(), [], []
                ids.append(i.as_py())
                sets.append(np.frombuffer(h.as_py(), np.uint64))
        yield done()

    return run


def confirmed_blocks(blocks: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links a, b that connect the texts of each block (block, a) as all its links do. A set goes once to each block."""
    rows = blocks.select("block", F.col("a").alias("id")).distinct().join(sets, "id").select("block", "id", "hashes")
    return rows.repartition("block").sortWithinPartitions("block").mapInArrow(_confirm_blocks(percent), "a long, b long").distinct()


def shingle_sets(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """id and hashes (the whole set) of the rows of docs whose id is in ids."""
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).join(ids, "id", "left_semi")
    return texts.mapInArrow(_set_rows(k), "id long, hashes binary")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs a, b whose full sets have at least percent / 100 of their union in common."""
    ends = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    sets = sets.join(ends, "id", "left_semi")  # where the pairs are few, no other set is shuffled
    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("hashes").alias("left")), "a").join(sets.select(F.col("id").alias("b"), F.col("hashes").alias("right")), "b")
    found = both.select("a", "b", "left", "right").mapInArrow(_confirm, "a long, b long, both long, either long")
    return found.where((F.col("both") * 100 >= F.col("either") * percent) & (F.col("both") > 0)).select("a", "b").distinct()


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns a, b: every id of a partition's edges with the smallest id that they connect it to there."""
    up: dict[int, int] = {}

    def find(x: int) -> int:
        while (y := up.setdefault(x, x)) != x:
            up[x] = x = up[y]
        return x

    for batch in batches:
        for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            x, y = find(x), find(y)
            up[max(x, y)] = min(x, y)
    a = [x for x in up if find(x) != x]
    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array([find(x) for x in a], pa.int64())], ["a", "b"])


def components(links: DataFrame, task_edges: int = TASK_EDGES, *, save=saved) -> DataFrame:
    """id, comp (smallest id that links a, b reach) of every id with a link to another. Each round contracts the edges
    inside tasks of about task_edges edges; if that was more than one task, a large-star and a small-star step follow,
    until nothing changes. Each round's edges are written to the shared folder."""
    a, b = F.greatest("a", "b"), F.least("a", "b")
    edges = save(links.where("a <> b").select(a.alias("a"), b.alias("b")), "edges")
    state = lambda e: tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
    now, before = state(edges), None
    while now != before:
        parts = max(1, -(-now[0] // task_edges))
        edges = edges.coalesce(parts).mapInArrow(_contract, "a long, b long")
        if parts == 1:
            edges = save(edges, "edges")
            break
        both = edges.union(edges.select("b", "a"))
        low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.union(low.where("m < a").select("a", "m")).distinct()
        down = large.where("a > b")
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", "m"))
        edges = save(small.where("a <> b").select(a.alias("a"), b.alias("b")).distinct(), "edges")
        before, now = now, state(edges)
    return edges.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("comp")).union(edges.select("b", "b").distinct())


def _sized(rows: DataFrame, n: int, task_rows: int = 20_000) -> DataFrame:
    """n rows in no more tasks than they are worth."""
    return rows.coalesce(max(2 * rows.sparkSession.sparkContext.defaultParallelism, -(-n // task_rows)))


def _number(n: int) -> Column:
    return F.lit(n).cast("long")


def _shared(keys: DataFrame) -> DataFrame:
    """keys with the size of their node, without nodes of one text only."""
    sizes = keys.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    return keys.join(sizes, "key")


def _mixed(rows: DataFrame) -> DataFrame:
    """The rows under keys with several comps."""
    keys = rows.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select("key")
    return rows.join(keys, "key", "left_semi")


def _blocks(nodes: DataFrame, save) -> DataFrame:
    """key, id: small nodes as they are; larger ones in random blocks, whose leaders meet again under the node's key."""
    out, level, step = nodes.where(F.col("size") <= LEAF).select("key", "id"), nodes.where(F.col("size") > LEAF).select("key", "id", "size"), 0
    while not level.isEmpty():
        name = F.xxhash64("key", F.pmod(F.xxhash64("id", "key", F.lit(step)), F.ceil(F.col("size") / (LEAF // 2))), F.lit(step))
        blocks = save(level.select(name.alias("block"), "key", "id"), "blocks")
        out = out.union(blocks.select(F.col("block").alias("key"), "id"))
        heads = blocks.groupBy("block", "key").agg(F.min("id").alias("id")).select("key", "id")
        level, step = save(_shared(heads), "heads"), step + 1
    return out


def _whole(nodes: DataFrame) -> DataFrame:
    """Rows key, id, comp, side, node that compare every member of a node with every other."""
    return nodes.select("key", "id", "comp", _number(BOTH).alias("side"), F.col("key").alias("node"))


def _sided(nodes: DataFrame) -> DataFrame:
    """Rows that compare the members of a node outside its main comp with all of its members: for each block of the
    first and block of all, of about BLOCK rows each, a node of two sides. Columns key, id, comp, size, main, others."""
    of = lambda n: F.ceil(F.col(n) / BLOCK).cast("int")
    part = lambda n, salt: F.pmod(F.xxhash64("id", "key", F.lit(salt)), of(n)).cast("int")
    name = lambda x, y: F.xxhash64("key", x, y, F.lit("sided"))
    every = lambda n: F.explode(F.sequence(F.lit(0), of(n) - 1))
    left = nodes.where("comp <> main").select("key", "id", "comp", part("others", 1).alias("own"), every("size").alias("far"))
    left = left.select(name(F.col("own"), F.col("far")).alias("key"), "id", "comp", _number(LEFT).alias("side"), F.col("key").alias("node"))
    side = F.when(F.col("comp") == F.col("main"), _number(RIGHT)).otherwise(_number(AGAIN))
    right = nodes.select("key", "id", "comp", side.alias("side"), part("size", 2).alias("own"), every("others").alias("far"))
    return left.union(right.select(name(F.col("far"), F.col("own")).alias("key"), "id", "comp", "side", F.col("key").alias("node")))


def _final_nodes(nodes: DataFrame, sigs: DataFrame, threshold: float, save) -> DataFrame:
    """Rows for _compare of all nodes in which branching ends. nodes: key, id, comp, tree, size of the first nodes."""
    out, depth, level = None, FIRST_DEPTH, nodes
    while True:
        level = save(_mixed(level), "nodes")
        small = _whole(level.where(F.col("size") <= LEAF))
        out = small if out is None else out.union(small)
        large = level.where(F.col("size") > LEAF)
        if large.isEmpty():
            return out
        comps = large.groupBy("key", "comp").agg(F.count("*").alias("rows"))
        main = comps.groupBy("key").agg(F.max_by("comp", F.struct("rows", "comp")).alias("main"), (F.sum("rows") - F.max("rows")).alias("others"))
        large = save(large.join(main, "key"), "large")
        end = F.col("others") <= (LEAF if depth < MAX_DEPTH else 2**62)
        out = out.union(_sided(large.where(end)))
        rest = large.where(~end)
        if not (n := rest.count()):
            return out
        rest = _sized(rest.select("id", "comp", "tree", "key").join(sigs.select("id", "sig"), "id").select("id", "comp", "sig", "tree", "key"), n)
        keys, depth = save(rest.mapInArrow(_node_rows(0, DEPTH_STEP, threshold), _NODE), "keys"), depth + DEPTH_STEP
        level = _shared(keys)


_NODE = "key long, id long, comp long, tree long"


def links(docs: DataFrame, sk: DataFrame, id_col: str, text_col: str, k: int, percent: int, trees: int, save) -> DataFrame:
    """Confirmed links a, b between representatives: enough of them to connect whatever is connected. save: as saved."""
    threshold = percent / 100
    deviation = np.sqrt(COORDS * threshold * (1 - threshold))
    least, likely = int(np.floor(COORDS * threshold - 3.5 * deviation)), int(np.floor(COORDS * threshold))
    reps = sk.where("n > 0").groupBy("fa", "fb", "n").agg(F.min("id").alias("id"))
    sigs = save(sk.join(reps, ["fa", "fb", "n", "id"], "left_semi").dropDuplicates(["fa", "fb", "n", "id"]).select("id", "n", "sig"), "sigs")

    def compared(rows: DataFrame, forest: bool) -> DataFrame:
        if forest:
            rows = rows.withColumn("keys", F.array().cast("array<long>"))
        rows = rows.join(sigs, "id").select("key", "id", "n", "sig", "comp", "side", "node", "keys").repartition("key").sortWithinPartitions("key")
        return save(rows.mapInArrow(_compare(likely if forest else least, threshold, forest), "a long, b long, block long").distinct(), "pairs")

    def regrouped(rows: DataFrame, groups: DataFrame) -> DataFrame:
        return rows.drop("comp").join(groups, "id", "left").withColumn("comp", F.coalesce("comp", "id"))

    keys = save(sigs.select("id", F.col("id").alias("comp"), "sig").mapInArrow(_node_rows(trees, FIRST_DEPTH, threshold), _NODE), "keys")
    nodes = save(_shared(keys), "nodes")
    sets = save(shingle_sets(docs, nodes.select("id").distinct(), id_col, text_col, k), "sets")
    seeds = _blocks(nodes.where(F.col("tree") <= SEED_TREES), save).select("key", "id", F.col("id").alias("comp"), _number(BOTH).alias("side"), F.col("key").alias("node"))
    found = save(confirmed(compared(seeds, True).select("a", "b"), sets, percent), "links")
    groups = save(components(found, save=save), "groups")
    rows = save(_final_nodes(regrouped(nodes, groups), sigs, threshold, save), "rows")
    tried = compared(rows, True).select("a", "b")
    found = found.union(save(confirmed(tried, sets, percent), "links"))
    groups = save(components(found, save=save), "groups")
    rows = save(_mixed(regrouped(rows, groups)), "rows")
    nodes_of = rows.groupBy("id").agg(F.collect_set("node").alias("keys"))  # at most its nodes in all trees
    more = compared(rows.join(nodes_of, "id"), False)
    pairs = save(more.where("block is null").select("a", "b").join(tried, ["a", "b"], "left_anti"), "pairs")
    return found.union(confirmed(pairs, sets, percent)).union(confirmed_blocks(more.where("block is not null"), sets, percent))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 85, trees: int = 14) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable by links of similarity percent / 100 or more) and kept
    (whether that is the row's own id) of every row of docs."""
    sk = saved(sketches(docs, id_col, text_col, k), "sketches")
    # rows of texts that occur more than once find their representative; each class stands once for each salt
    classes = sk.where("n > 0").groupBy("fa", "fb", "n").agg(F.min("id").alias("rep"), F.count("*").alias("rows")).where("rows > 1")
    classes = classes.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).select("fa", "fb", "n", "salt", "rep")
    same = sk.where("n > 0 and id is not null").select("id", "fa", "fb", "n", F.pmod(F.hash("id"), F.lit(SALTS)).alias("salt"))
    same = same.join(classes, ["fa", "fb", "n", "salt"], "left").select(F.col("id").alias("a"), F.coalesce("rep", "id").alias("b"))
    with scratch(docs.sparkSession) as save:
        groups = saved(components(links(docs, sk, id_col, text_col, k, percent, trees, save), save=save), "groups")
    # copies hang on their representative; an id with several texts ties their groups together
    every = same.join(groups.withColumnRenamed("id", "b"), "b", "left").select(F.col("a").alias("id"), F.coalesce("comp", "b").alias("comp"))
    reached = every.groupBy("id").agg(F.min("comp").alias("comp"), F.max("comp").alias("most"))
    reached = saved(reached, "reached")
    if not (torn := reached.where("comp <> most")).isEmpty():
        ties = every.select("id", F.col("comp").alias("a")).join(torn.select("id", F.col("comp").alias("b")), "id").where("a <> b").select("a", "b").distinct()
        merged = components(ties.union(groups.select("id", "comp").where("id <> comp")))
        reached = reached.join(merged.select(F.col("id").alias("comp"), F.col("comp").alias("m")), "comp", "left").select("id", F.coalesce("m", "comp").alias("comp"))
    out = sk.select("id", "n").join(reached.select("id", "comp"), "id", "left")
    comp = F.coalesce("comp", "id")
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), comp.alias("component_id"), F.coalesce(F.col("id") == comp, F.lit(True)).alias("kept"))


def without_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """One row of docs of each group: that of the smallest id. Where ids are missing or repeat, every row is a vertex of
    its own: texts that differ stay even under one id, and of equal ids in a group the first row in storage stays; null
    ids come last."""
    odd = docs.groupBy(F.col(id_col).alias("__id")).agg(F.count("*").alias("__n")).where("__n > 1 or __id is null")
    if odd.isEmpty():
        verdict = near_duplicates(docs, id_col, text_col, **kw).where("kept").select(F.col("doc_id").alias("__id"))
        return docs.join(verdict, F.col(id_col).cast("long") == F.col("__id"), "left_semi")
    rows = saved(docs.withColumn("__row", F.monotonically_increasing_id()), "rows")
    groups = saved(near_duplicates(rows, "__row", text_col, **kw).select(F.col("doc_id").alias("__row"), F.col("component_id").alias("__comp")), "groups")
    order = F.struct(F.col(id_col).isNull(), F.col(id_col), F.col("__row"))
    first = rows.select(id_col, "__row").join(groups, "__row").groupBy("__comp").agg(F.min_by("__row", order).alias("__row"))
    return rows.join(first, "__row", "left_semi").select(*docs.columns)
