"""Near-duplicate join: Jaccard similarity of word n-grams by a chosen-path join.

Texts become sets of five-word shingles (lower case, split at white space; a
shorter text is one shingle). Equal sets form one class, so copies are joined
once. Each class has a sketch of min-wise samples of its set.

Chosen paths: in every run a node of the recursion samples tokens (sketch
places) by its own hash, and the sets of the node go on to the child named by
each sampled token. Similar sets share children. Nodes with few sets are
compared by brute force; nodes with more split again. In a large node some
pivots are compared with all members first: a set very close to a pivot is
done, as by the triangle inequality of the Jaccard distance all its partners
are linked to that pivot. Runs are repeated until the chance that a pair at
the threshold shares no small node in any run is below 1 - `recall`.

These comparisons use the sketches with a wide margin and give candidate
groups. An exact check follows on whole shingle sets, one for each class. A
candidate group is cut into blocks of bounded numbers of sets and bytes. Each
block is compared with itself and gives every set the representative of its
part of the block; then each two blocks are compared, and only a forest of links
between representatives is handed on. So the links of a group grow with its
members, not with its pairs; pairs are counted for each member and never written
out, and a group is never held as a whole.

Defined results: texts without words have no shingles and no links, each is a
class of its own; rows without an id take part like all others, their id is
larger than any other (`class_id` is NULL only if the whole group has none);
repeated rows are copies of one another; an empty table gives an empty result;
other columns are not read. A very long text is a block of its own.
"""

from __future__ import annotations

import contextlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerlake.llm.common import table
from ledgerlake.llm.components import components
from ledgerlake.operators.flags import bounded
from ledgerlake.session import discard, materialise

WORDS = 5
THRESHOLD = 0.8
PLACES = 64  # min-wise samples of a sketch
BRANCH = 2  # tokens sampled at a node
RECALL = 0.9999
NODE_LIMIT = 256  # sets of a node that are compared by brute force
PIVOTS = 4
DEPTH = 6
LEAF_BLOCK = 1024  # sets of a block in a node that is too deep to split
BLOCK = 2048  # sets of a block in the exact check
BLOCK_BYTES = 8 << 20  # bytes of the sets of a block
BITMAP_BITS = 1 << 25
TEXTS = 1024  # texts of a batch on their way to Python
SEED = 0x5EED


def runs_for(recall: float, threshold: float = THRESHOLD, branch: int = BRANCH, depth: int = DEPTH) -> int:
    """Runs until a pair at the threshold is found with probability `recall`, however deep its nodes split."""
    found = 1.0
    for _ in range(depth):
        found = 1 - (1 - threshold * found) ** branch
    return math.ceil(math.log(1 - recall) / math.log(1 - found))


class Shingles:
    """Sorted distinct 64-bit shingle hashes of texts. Word hashes are remembered up to a bound."""

    REMEMBERED = 1 << 16
    MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
    FINISH = np.uint64(0xBF58476D1CE4E5B9)

    def __init__(self, n: int = WORDS) -> None:
        self.n = n
        self.seen: dict[str, int] = {}

    def of(self, text: str | None) -> np.ndarray:
        import xxhash
        words = text.lower().split() if text else []
        if not words:
            return np.empty(0, np.uint64)
        seen = self.seen
        if len(seen) > self.REMEMBERED:
            seen.clear()
        for w in set(words).difference(seen):
            seen[w] = xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass"))
        h = np.fromiter(map(seen.__getitem__, words), np.uint64, len(words))
        n = min(self.n, len(h))
        out = np.full(len(h) - n + 1, n, np.uint64)
        for k in range(n):
            out = (out ^ h[k:len(h) - n + 1 + k]) * self.MULTIPLIER
            out ^= out >> np.uint64(32)
        out *= self.FINISH
        out ^= out >> np.uint64(29)
        return np.unique(out)


def places(count: int = PLACES) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.RandomState(SEED)
    return (rng.randint(0, 2**31, count).astype(np.uint32) * np.uint32(2) + np.uint32(1),
            rng.randint(0, 2**31, count).astype(np.uint32))


def sketch(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest hash of the set at each place."""
    s = (shingles >> np.uint64(32)).astype(np.uint32) ^ shingles.astype(np.uint32)
    out = np.full(len(a), np.uint32(0xFFFFFFFF))
    for lo in range(0, len(s), 2048):
        h = s[lo:lo + 2048][None, :] * a[:, None] + b[:, None]
        np.minimum(out, h.min(axis=1), out=out)
    return out


def key_of(shingles: np.ndarray) -> int:
    """Signed 64-bit name of a set."""
    import xxhash
    h = xxhash.xxh3_64_intdigest(shingles.tobytes())
    return h - (1 << 64) if h >= 1 << 63 else h


def sketched(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = WORDS) -> DataFrame:
    """(doc_id, text_key, class_key, n_shingles, sketch); no class for texts without words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, (a, b) = Shingles(n), places()
        for batch in batches:
            keys, sizes, made = [], [], []
            for text in (t for lo in range(0, batch.num_rows, 256) for t in batch.column("text").slice(lo, 256).to_pylist()):
                s = shingles.of(text)
                keys.append(key_of(s) if len(s) else None)
                sizes.append(len(s))
                made.append(sketch(s, a, b).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(keys, pa.int64()), pa.array(sizes, pa.int64()),
                 pa.array(made, pa.binary())], names=["doc_id", "text_key", "class_key", "n_shingles", "sketch"])

    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text")) \
        .mapInArrow(run, "doc_id long, text_key long, class_key long, n_shingles long, sketch binary")


# ---- chosen paths -------------------------------------------------------------------------------------------------

def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def children(nodes: np.ndarray, sketches: np.ndarray, branch: int = BRANCH) -> np.ndarray:
    """(rows x branch) child of each row's set: the node samples `branch` places, the token found there names the child."""
    place = np.arange(sketches.shape[1], dtype=np.uint64)
    unique, back = np.unique(nodes, return_inverse=True)
    drawn = _mixed(unique[:, None] ^ _mixed(place + np.uint64(1))[None, :])
    chosen = np.argsort(drawn, axis=1, kind="stable")[:, :branch][back]
    tokens = np.take_along_axis(sketches, chosen, 1).astype(np.uint64)
    return _mixed(_mixed(nodes[:, None] ^ (tokens << np.uint64(8)) ^ chosen.astype(np.uint64)) + np.uint64(SEED))


def _sketches(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(len(column), -1)


def _edges(kind: int, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int32)), pa.array(np.ascontiguousarray(a, np.int64)),
                                       pa.array(np.ascontiguousarray(b, np.int64))], names=["kind", "u", "v"])


def _first_nodes(runs: int):
    """mapInArrow: the children of every run's root."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roots = _mixed(np.arange(1, runs + 1, dtype=np.uint64) * np.uint64(SEED))
        for batch in batches:
            if not batch.num_rows:
                continue
            cls, sk = batch.column("class_key").to_numpy(), _sketches(batch.column("sketch"))
            for root in roots:
                nodes = children(np.full(len(cls), root, np.uint64), sk)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes.T.reshape(-1).view(np.int64)), pa.array(np.tile(cls, BRANCH))], names=["node", "class_key"])
    return run


def _close(a_sk: np.ndarray, a_n: np.ndarray, b_sk: np.ndarray, b_n: np.ndarray) -> np.ndarray:
    """Estimated similarity of rows, 0 where the sizes alone rule the threshold out."""
    sure = np.minimum(a_n, b_n) >= THRESHOLD * np.maximum(a_n, b_n)
    return np.where(sure, (a_sk == b_sk).mean(-1), 0.0)


# sketch estimates: five standard errors below the threshold still make a candidate
MAYBE = THRESHOLD - 5 * math.sqrt(THRESHOLD * (1 - THRESHOLD) / PLACES)
# a set estimated this close to a pivot needs no more comparisons in its node: a partner at the threshold is within
# 0.2 + 0.2 of the pivot (triangle inequality of the Jaccard distance), so its estimate is near 0.6 or above
COVERED = THRESHOLD
PIVOT_LINK = 0.35


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow on the members of large nodes, each with the node's pivots: links to pivots (kind 0), children (kind 1)."""
    for whole in batches:
        for lo in range(0, whole.num_rows, 2048):
            batch = whole.slice(lo, 2048)
            cls = batch.column("class_key").to_numpy()
            sk = _sketches(batch.column("sketch"))
            nodes = batch.column("node").to_numpy().view(np.uint64)
            done = np.zeros(len(cls), bool)
            _, first, of_node = np.unique(nodes, return_index=True, return_inverse=True)
            for k, pivots in enumerate(batch.column("pivots").take(pa.array(first)).to_pylist()):
                rows = np.flatnonzero(of_node == k)
                p_sk = np.frombuffer(b"".join(p["sketch"] for p in pivots), np.uint32).reshape(len(pivots), -1)
                p_cls = np.array([p["class_key"] for p in pivots], np.int64)
                est = (sk[rows][:, None] == p_sk[None]).mean(-1)
                # pivots linked among themselves count as one
                one = _forest((p_sk[:, None] == p_sk[None]).mean(-1) >= PIVOT_LINK)
                for own in np.unique(one):
                    link = (est[:, one == own] >= PIVOT_LINK).any(axis=1) & (cls[rows] != p_cls[own])
                    yield _edges(0, cls[rows][link], np.full(link.sum(), p_cls[own]))
                done[rows[(est >= COVERED).any(axis=1)]] = True
            left = ~done
            if left.any():
                new = children(nodes[left], sk[left])
                yield _edges(1, new.T.reshape(-1).view(np.int64), np.tile(cls[left], BRANCH))


def _lowest(linked: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Smallest label among the linked columns of each row; the number of labels where there is none."""
    out = np.empty(len(linked), np.int64)
    for lo in range(0, len(linked), 256):
        out[lo:lo + 256] = np.where(linked[lo:lo + 256], label[None, :], np.iinfo(np.int64).max).min(axis=1, initial=np.iinfo(np.int64).max)
    return out


def _forest(linked: np.ndarray) -> np.ndarray:
    """Smallest member of each row's component in a symmetric boolean matrix."""
    label = np.arange(len(linked))
    while True:
        low = np.minimum(label, _lowest(linked, label))
        low = low[low]
        if (low == label).all():
            return label
        label = low


def _runs_of(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Consecutive rows in tables that never cut a group of equal keys (rows come sorted by them)."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(k).to_numpy() for k in keys]
        change = np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols], axis=0)) + 1
        if held and any(held[-1].column(k)[-1].as_py() != batch.column(k)[0].as_py() for k in keys):
            yield pa.Table.from_batches(held)
            held = []
        if len(change):
            at = int(change[-1])
            yield pa.Table.from_batches([*held, batch.slice(0, at)])
            held = [batch.slice(at)]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def _starts(t: pa.Table, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
    cols = [t.column(k).to_numpy() for k in keys]
    starts = np.concatenate([[0], np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols], axis=0)) + 1])
    return starts, np.diff(np.append(starts, t.num_rows))


def _brute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow on small nodes' members, sorted by node and block pair: links that hold each node's candidates together."""
    keys = ["node", "bi", "bj"]
    for t in _runs_of(batches, keys):
        cls, n = t.column("class_key").to_numpy(), t.column("n_shingles").to_numpy()
        sk = _sketches(t.column("sketch").combine_chunks())
        starts, sizes = _starts(t, keys)
        two = starts[sizes == 2]
        ok = _close(sk[two], n[two], sk[two + 1], n[two + 1]) >= MAYBE
        yield _edges(0, cls[two][ok], cls[two + 1][ok])
        for at, size in zip(starts[sizes > 2], sizes[sizes > 2]):
            part = slice(at, at + size)
            est = np.zeros((size, size), bool)
            for i in range(0, size, 64):
                rows = slice(at + i, min(at + i + 64, at + size))
                est[i:i + 64] = _close(sk[rows][:, None], n[rows][:, None], sk[part][None], n[part][None]) >= MAYBE
            root = _forest(est | est.T)
            own = root != np.arange(size)
            yield _edges(0, cls[part][own], cls[part][root[own]])


def candidate_links(classes: DataFrame, recall: float = RECALL, node_limit: int = NODE_LIMIT, depth: int = DEPTH,
                    block: int = LEAF_BLOCK) -> tuple[DataFrame, list[str]]:
    """(u, v) links whose components hold all pairs of classes at or above the threshold, and the tables they are read from."""
    members = classes.select("class_key", "sketch").mapInArrow(_first_nodes(runs_for(recall)), "node long, class_key long")
    links, leaves, paths = [], [], []
    for level in range(depth):
        rows, path = materialise(members.distinct() if level else members, "nodes")
        paths.append(path)
        # at most one node in `node_limit` rows
        crowded, path = materialise(rows.groupBy("node").count().where(F.col("count") > node_limit), "crowded-nodes")
        paths.append(path)
        # a row is never joined with the count of its node: the members of a small node are one bounded list
        leaves.append(rows.join(crowded, "node", "left_anti").groupBy("node").agg(F.collect_list("class_key").alias("members"))
                      .where(F.size("members") > 1).select("node", F.explode("members").alias("class_key"), F.lit(0).alias("bi"), F.lit(0).alias("bj")))
        large, path = materialise(rows.join(crowded, "node", "left_semi"), "large-nodes")
        paths.append(path)
        if large.isEmpty():
            break
        if level == depth - 1:
            # too deep: compared block against block, whole
            blocks = F.ceil(F.col("count") / block).cast("int")
            own = F.pmod(F.xxhash64("class_key", "node"), blocks).cast("int")
            leaves.append(large.join(crowded, "node").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1))).select(
                "node", "class_key", F.least("own", "other").alias("bi"), F.greatest("own", "other").alias("bj")))
            break
        full = large.join(classes.select("class_key", "sketch"), "class_key")
        drawn = full.withColumn("r", F.row_number().over(W.partitionBy("node").orderBy(F.xxhash64("class_key", "node"), "class_key")))
        pivots = drawn.where(F.col("r") <= PIVOTS).groupBy("node").agg(
            F.sort_array(F.collect_list(F.struct("class_key", "sketch"))).alias("pivots"))
        out, path = materialise(full.join(pivots, "node").select("node", "class_key", "sketch", "pivots").mapInArrow(
            _split, "kind int, u long, v long"), "split-nodes")
        paths.append(path)
        links.append(out.where("kind = 0").select("u", "v"))
        members = out.where("kind = 1").select(F.col("u").alias("node"), F.col("v").alias("class_key"))
    all_leaves = leaves[0]
    for leaf in leaves[1:]:
        all_leaves = all_leaves.unionByName(leaf)
    keys = ["node", "bi", "bj"]
    brute = all_leaves.join(classes.select("class_key", "n_shingles", "sketch"), "class_key") \
        .repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_brute, "kind int, u long, v long").select("u", "v")
    for more in links:
        brute = brute.unionByName(more)
    return brute, paths


# ---- exact check --------------------------------------------------------------------------------------------------

def _shared(sets: list[np.ndarray], others: list[np.ndarray] | None = None) -> np.ndarray:
    """(sets x others) sizes of the intersections (without `others`: of the sets among themselves),
    through matrix products over the shingles that several sets hold."""
    n, every = len(sets), sets + (others or [])
    values, back, counts = np.unique(np.concatenate(every), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(every)), [len(s) for s in every])
    many = counts[back] > 1
    column = (np.cumsum(counts > 1) - 1)[back[many]]
    del values, back, counts
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[many][order]
    out = np.zeros((n, n if others is None else len(others)), np.float32)
    total = int(column[-1]) + 1 if len(column) else 0
    for lo in range(0, total, 1024):
        a, b = np.searchsorted(column, [lo, lo + 1024])
        m = np.zeros((len(every), min(1024, total - lo)), np.float32)
        m[owner[a:b], column[a:b] - lo] = 1
        out += m[:n] @ (m if others is None else m[n:]).T
    return out


def _linked(shared: np.ndarray, sizes: np.ndarray, other_sizes: np.ndarray, threshold: float) -> np.ndarray:
    """True where the similarity is at or above the threshold."""
    out = np.empty(shared.shape, bool)
    for lo in range(0, len(sizes), 256):
        inter = np.rint(shared[lo:lo + 256].astype(np.float64))
        out[lo:lo + 256] = inter >= threshold * (sizes[lo:lo + 256, None] + other_sizes[None, :] - inter) - 1e-9
    return out


def _between(hit: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A forest of the links of two blocks, between the representatives `left` and `right` of rows and columns."""
    ln, li = np.unique(left, return_inverse=True)
    rn, ri = np.unique(right, return_inverse=True)
    at, to = np.nonzero(hit)
    linked = np.zeros((len(ln), len(rn)), bool)
    linked[li[at], ri[to]] = True
    n = len(ln)
    label = np.arange(n + len(rn))
    while True:
        low_l = np.minimum(label[:n], _lowest(linked, label[n:]))
        low = np.concatenate([low_l, np.minimum(label[n:], _lowest(linked.T, low_l))])
        low = low[low]
        if (low == label).all():
            break
        label = low
    names, off = np.concatenate([ln, rn]), label != np.arange(n + len(rn))
    return names[off], names[label[off]]


def _exact(threshold: float):
    """mapInArrow on blocks (bi = bj) or pairs of blocks of candidate groups, sorted by them: a forest of links
    (kind 0), of members to the smallest of their part of a block or between such, and link counts (kind 1)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = ["label", "bi", "bj"]
        for t in _runs_of(batches, keys):
            starts, sizes = _starts(t, keys)
            cls, own, root, copies = (t.column(c).to_numpy() for c in ("class_key", "own", "root", "copies"))
            sets = t.column("shingles")
            bi, bj = t.column("bi").to_numpy(), t.column("bj").to_numpy()
            u, v, node, count = [], [], [], []
            for at, size in zip(starts, sizes):
                # two rows of one class would be counted twice
                rows = at + np.unique(cls[at:at + size], return_index=True)[1]
                raw = dict(zip(rows.tolist(), (np.frombuffer(x, np.uint64) for x in sets.take(pa.array(rows)).to_pylist())))
                size_of = np.vectorize(lambda r: len(raw[r]), otypes=[np.int64])
                left, right = rows[own[rows] == bi[at]], rows[own[rows] == bj[at]]
                if not len(left) or not len(right):
                    continue
                lc, rc = cls[left], cls[right]
                if bi[at] == bj[at]:
                    hit = _linked(_shared([raw[r] for r in left]), size_of(left), size_of(left), threshold)
                    np.fill_diagonal(hit, False)
                    first = _forest(hit)
                    off = first != np.arange(len(left))
                    u.append(lc[off])
                    v.append(lc[first[off]])
                else:
                    hit = _linked(_shared([raw[r] for r in left], [raw[r] for r in right]), size_of(left), size_of(right), threshold)
                    between_u, between_v = _between(hit, root[left], root[right])
                    u.append(between_u)
                    v.append(between_v)
                    node.append(rc)
                    count.append(hit.T @ copies[left])
                node.append(lc)
                count.append(hit @ copies[right])
            if u:
                yield _edges(0, np.concatenate(u), np.concatenate(v))
                node, count = np.concatenate(node), np.concatenate(count)
                yield _edges(1, node[count > 0], count[count > 0])
    return run


def _bitmap(ids: DataFrame) -> np.ndarray:
    """A fixed number of bits in which each id sets one, whatever the number of ids."""
    at = F.pmod(F.xxhash64("doc_id"), F.lit(BITMAP_BITS)) + 1  # Spark's bitmaps number their places from 1
    rows = ids.select(at.alias("at")).groupBy(F.expr("bitmap_bucket_number(at)").alias("bucket")).agg(
        F.expr("bitmap_construct_agg(bitmap_bit_position(at))").alias("bits")).collect()  # BITMAP_BITS / 32768 rows
    out = np.zeros((BITMAP_BITS >> 15, 4096), np.uint8)
    for r in rows:
        out[r["bucket"] - 1] = np.frombuffer(r["bits"], np.uint8)
    return out.ravel()


def candidate_sets(docs: DataFrame, members: DataFrame, n: int = WORDS, block: int = BLOCK, block_bytes: int = BLOCK_BYTES,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(label, blocks, own, class_key, copies, shingles) of the `members` (doc_id, class_key, label, copies, n_shingles):
    their whole sets, the number of blocks of their group and their own block.

    Texts are not moved: a bitmap of fixed size lets nearly only the members'
    texts through where they lie, and their shingles meet the groups.
    """
    some = docs.sparkSession.sparkContext.broadcast(_bitmap(members))  # BITMAP_BITS

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, bits, given = Shingles(n), some.value, set()
        for batch in batches:
            at = batch.column("at").to_numpy()
            hit = np.flatnonzero(bits[at >> 3] >> (at & 7).astype(np.uint8) & 1)
            if not len(hit):
                continue
            part = batch.take(pa.array(hit))
            for lo in range(0, part.num_rows, 512):
                few = part.slice(lo, 512)
                ids, keep, keys, out = few.column("doc_id").to_pylist(), [], [], []
                for i, text in enumerate(few.column("text").to_pylist()):
                    s = shingles.of(text)
                    key = key_of(s)
                    # of repeated rows a task gives one
                    if len(s) and (ids[i], key) not in given:
                        given.add((ids[i], key))
                        keep.append(i)
                        keys.append(key)
                        out.append(s.tobytes())
                yield pa.RecordBatch.from_arrays([few.column("doc_id").take(pa.array(keep, pa.int64())), pa.array(keys, pa.int64()),
                                                  pa.array(out, pa.binary())], names=["doc_id", "class_key", "shingles"])

    blocks = members.groupBy("label").agg(F.greatest(
        F.ceil(F.count("*") / F.lit(block)), F.ceil(F.sum("n_shingles") * 8 / F.lit(block_bytes))).cast("int").alias("blocks"))
    wanted = members.join(blocks, "label").select(
        "label", "blocks", F.pmod(F.xxhash64("class_key"), F.col("blocks")).cast("int").alias("own"),
        F.col("doc_id").alias("member_id"), F.col("class_key").alias("member_key"), "copies")
    doc_id = F.col(id_col).cast("long")
    # an id repeated with another text has another class
    return docs.select(doc_id.alias("doc_id"), F.pmod(F.xxhash64(doc_id), F.lit(BITMAP_BITS)).alias("at"), F.col(text_col).alias("text")) \
        .mapInArrow(sets, "doc_id long, class_key long, shingles binary") \
        .join(bounded(wanted), (F.col("class_key") == F.col("member_key")) & F.col("doc_id").eqNullSafe(F.col("member_id"))) \
        .select("label", "blocks", "own", "class_key", "copies", "shingles")


def exact_links(sets: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, list[str]]:
    """(kind, u, v): a forest of links (0) and parts of the link counts (1) inside the groups of `sets`, and the tables read."""
    keys = ["label", "bi", "bj"]
    schema = "kind int, u long, v long"

    def compared(rows: DataFrame) -> DataFrame:
        return rows.select("label", "bi", "bj", "own", "class_key", "root", "copies", "shingles") \
            .repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_exact(threshold), schema)

    inside, inside_path = materialise(compared(sets.withColumn("bi", F.col("own")).withColumn("bj", F.col("own"))
                                               .withColumn("root", F.col("class_key"))), "links-inside")
    first = inside.where("kind = 0").select(F.col("u").alias("class_key"), F.col("v").alias("first"))
    pairs = sets.where("blocks > 1").join(first, "class_key", "left").withColumn("root", F.coalesce("first", "class_key")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).where("other <> own") \
        .withColumn("bi", F.least("own", "other")).withColumn("bj", F.greatest("own", "other"))
    across, across_path = materialise(compared(pairs), "links-across")
    return inside.unionByName(across), [inside_path, across_path]


@contextlib.contextmanager
def small_batches(spark: SparkSession):
    """While texts go to Python, few at a time: both sides hold whole batches of them."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(TEXTS, int(before)) if int(before) > 0 else TEXTS))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def near_duplicates(docs: DataFrame, recall: float = RECALL, threshold: float = THRESHOLD, id_col: str = "doc_id",
                    text_col: str = "text", **limits: int) -> DataFrame:
    """(doc_id, class_id, n_links) of each row: the smallest id of its group
    (linked rows, directly or through others) and the number of other rows
    whose similarity to it is at or above the threshold. `limits` as in `grouped`."""
    return grouped(docs, recall, threshold, id_col, text_col, **limits).select("doc_id", "class_id", "n_links")


def grouped(docs: DataFrame, recall: float = RECALL, threshold: float = THRESHOLD, id_col: str = "doc_id",
            text_col: str = "text", node_limit: int = NODE_LIMIT, depth: int = DEPTH, leaf_block: int = LEAF_BLOCK,
            block: int = BLOCK, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, text_key, group_key, class_id, n_links) of each row; no group for texts without words."""
    if threshold < THRESHOLD:
        raise ValueError(f"the sketches are made for thresholds of {THRESHOLD} and more")
    spark = docs.sparkSession
    with small_batches(spark):
        rows, _ = materialise(sketched(docs, id_col, text_col), "sketches")
    classes, _ = materialise(rows.where("class_key IS NOT NULL").groupBy("class_key").agg(
        F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"), F.max("n_shingles").alias("n_shingles"),
        F.max("sketch").alias("sketch")), "classes")
    links, done = candidate_links(classes, recall, node_limit, depth, leaf_block)
    members, members_path = materialise(components(links).withColumnRenamed("node", "class_key").join(
        classes.select("class_key", "doc_id", "copies", "n_shingles"), "class_key"), "candidates")
    for path in done:
        discard(spark, path)
    with small_batches(spark):
        sets, sets_path = materialise(candidate_sets(docs, members, block=block, block_bytes=block_bytes, id_col=id_col, text_col=text_col),
                                      "candidate-sets")
    discard(spark, members_path)
    exact, exact_paths = exact_links(sets, threshold)
    discard(spark, sets_path)
    labels, _ = materialise(components(exact.where("kind = 0").select("u", "v")), "labels")
    named = labels.withColumnRenamed("node", "class_key").join(classes.select("class_key", "doc_id"), "class_key")
    smallest = named.groupBy("label").agg(F.min("doc_id").alias("class_id"))
    counts = exact.where("kind = 1").groupBy(F.col("u").alias("class_key")).agg(F.sum("v").alias("others"))
    about, _ = materialise(classes.select("class_key", "doc_id", "copies")
        .join(labels.withColumnRenamed("node", "class_key"), "class_key", "left")
        .join(smallest, "label", "left").join(counts, "class_key", "left")
        .select("class_key", F.coalesce("label", "class_key").alias("group_key"), F.coalesce("class_id", "doc_id").alias("class_id"),
                (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")), "classes-named")
    for path in exact_paths:
        discard(spark, path)
    return rows.select("doc_id", "text_key", "class_key").join(about, "class_key", "left").select(
        "doc_id", "text_key", "group_key", F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents with one of each group of near duplicates (that of the smallest id, rows without id last), and of
    rows without words one of each id and text. An id may stand on different texts."""
    found = grouped(docs)
    rows = found.groupBy("doc_id", "text_key").agg(F.min("group_key").alias("group_key"), F.count("*").alias("n"))
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key", "n")
    first = rows.where("group_key IS NOT NULL").groupBy("group_key").agg(F.min(row).alias("k")).select("k.doc_id", "k.text_key", "k.n") \
        .unionByName(rows.where("group_key IS NULL").select("doc_id", "text_key", "n")) \
        .select(F.col("doc_id").alias("_kept_id"), F.col("text_key").alias("_kept_text"), F.col("n").alias("_kept_rows"))
    first, _ = materialise(first, "kept")
    # ids of a checked size are probed where the texts lie
    stay = docs.withColumn("_text_key", F.xxhash64("text")).join(
        bounded(first), F.col("doc_id").cast("long").eqNullSafe(F.col("_kept_id")) & (F.col("_text_key") == F.col("_kept_text")))
    # only repeated rows meet one another
    return stay.where("_kept_rows = 1").unionByName(stay.where("_kept_rows > 1").dropDuplicates(["doc_id", "_text_key"])).select(*docs.columns)


def op2_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their group of near duplicates and number of links."""
    return near_duplicates(table(spark, sf_dir, "documents"))
