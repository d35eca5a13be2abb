"""N-gram Jaccard join by signature trees.

A document is the set of its distinct word shingles (64-bit hashes). Two link when their sets'
Jaccard similarity reaches ``PERCENT`` per cent; classes are the connected documents.

1. Equal sets become one, named by the hash of its shingles.
2. Families. Linked sets a, b differ in at most (|a| + |b|) / 19 shingles (at 90 per cent), so
   if shingles are dealt into more parts than that, some part holds the same shingles of
   both: sets get one key per part, from its shingles, for their size class and the one below
   (linked sizes lie in one or two neighbouring classes). Sets are of one family if keys
   connect them; every link lies within a family. Keys are joined as smallest set and others, never
   as pairs. Spare parts make up for empty ones, which give no keys.
3. Signature trees. The sets of a family are dealt into blocks of bounded size, and
   each block becomes a tree over its sets in order of size and smallest shingle: nodes hold
   the OR of their members' bitmaps, their range of sizes and their most collisions (shingles
   less set bits). Two trees, or a tree and itself, are traversed together; a pair of nodes is
   left when the sizes cannot link, when bits in common plus collisions, the maximum
   possible overlap, fall short of what their smallest members need, or when all members
   are connected already. Pairs of sets that remain are verified on their shingles.
4. Families of several blocks: each block with itself, then with the first; components are
   taken, and only blocks with members outside the family's largest component meet the
   others, so what is connected is never compared again.

Edge cases: no words or NULL text give an empty set that links with nothing, its component is
its own doc_id; fewer words than a shingle are one shingle; repeated rows share a set; a NULL
doc_id is never a component's id while another is reachable; an empty table gives no rows;
other columns are ignored. Long texts are taken whole.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from urbanlens.llm.common import bloom_words, in_bloom, materialize, mix64, read, text_blocks
from urbanlens.llm.words import powers

SHINGLE = 3
PERCENT = 90
BLOOM_BITS = 24
BLOCK_SETS = 2048
BLOCK_BYTES = 16 << 20
FAN = 16
EDGES = 1 << 17  # links a task writes while components are found

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_IN_WORD = np.ones(256, bool)
_IN_WORD[0x20] = _IN_WORD[0x09:0x0E] = False
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))
_STEP = np.uint64(0xE7037ED1A0B428DB)


# --- sets
def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of the rows of a block, ascending in each row, and their offsets per row."""
    rows = len(offsets) - 1
    low = _LOWER[data]
    inside = _IN_WORD[low]
    full = np.flatnonzero(np.diff(offsets))
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    first, last = offsets[:-1][full], offsets[1:][full] - 1
    begin[first], end[last] = inside[first], inside[last]
    start, stop = np.flatnonzero(begin), np.flatnonzero(end) + 1
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[low] * up[:-1], out=total[1:])
    word = mix64((total[stop] - total[start]) * down[start])
    row = np.searchsorted(offsets, start, "right") - 1
    count = np.bincount(row, minlength=rows)
    before = np.concatenate([[0], np.cumsum(count)])
    # hash of the words from each place on: k of them, or all of a shorter row
    size = np.minimum(count, k)
    many = count - size + (size > 0)  # shingles of each row
    at = np.arange(many.sum()) + np.repeat(before[:-1] - np.concatenate([[0], np.cumsum(many)])[:-1], many)
    size = np.repeat(size, many)
    value = np.zeros(len(at), np.uint64)
    for j in range(k):
        more = size > j
        value[more] = value[more] * _STEP + word[at[more] + j]
    value = mix64(value + size.astype(np.uint64))
    owner = np.repeat(np.arange(rows), many)
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    value, owner = value[new], owner[new]
    return value, np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=rows))])


def set_ids(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A 64-bit name of each set."""
    raw = values.tobytes()
    return np.array([xxhash.xxh3_64_intdigest(raw[8 * a : 8 * b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)], np.uint64).view(np.int64)


# --- keys of families
def size_classes(most: int, percent: int = PERCENT) -> np.ndarray:
    """First sizes of the classes: linked sizes are at most one class apart."""
    out = [1]
    while out[-1] <= most:
        out.append(out[-1] * 100 // percent + 1)
    return np.array(out, np.int64)


def parts_of(bounds: np.ndarray, at: int, percent: int = PERCENT) -> tuple[int, int]:
    """Parts for links within size class ``at`` or with the next, and how many of them
    may be empty."""
    most = int(bounds[at + 2]) - 1
    differ = 2 * most * (100 - percent) // (100 + percent)
    spare = 1 if differ < 8 else 3
    return (differ + 1 + spare, spare) if differ else (0, 0)  # equal sets need no keys


def part_keys(values: np.ndarray, offsets: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """``(keys, row)``. Sets that link with none but equal ones get no keys."""
    size = np.diff(offsets)
    bounds = size_classes(int(size.max(initial=1)) * 2 + 2, percent)
    klass = np.searchsorted(bounds, size, "right") - 1
    owner = np.repeat(np.arange(len(size)), size)
    mixed = mix64(values ^ np.uint64(0x5851F42D4C957F2D))
    keys, rows = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for below in (0, 1):
        at = klass - below
        parts, spare = np.ones(len(size), np.int64), np.zeros(len(size), np.int64)
        for c in np.unique(at[(size > 1) & (at >= 0)]).tolist():
            parts[at == c], spare[at == c] = parts_of(bounds, c, percent)
        use = (size > 1) & (at >= 0) & (parts > 0)
        if not use.any():
            continue
        first = np.concatenate([[0], np.cumsum(np.where(use, parts, 0))])
        mine = use[owner]
        cell = first[:-1][owner[mine]] + ((mixed[mine] >> np.uint64(32)) * parts[owner[mine]].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
        order = np.argsort(cell, kind="stable")
        cell, value = cell[order], mix64(values[mine][order] + np.uint64(0x9E3779B97F4A7C15))
        new = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
        total = np.zeros(first[-1], np.uint64)
        total[cell[new]] = np.add.reduceat(value, new)
        row = np.repeat(np.arange(len(size)), np.where(use, parts, 0))
        part = np.arange(first[-1]) - first[row]
        filled = np.zeros(first[-1], bool)
        filled[cell[new]] = True
        empty = np.bincount(row[~filled], minlength=len(size))
        keep = filled | (empty > spare)[row]  # too many empty parts: those are keys too
        salt = mix64(at[row].astype(np.uint64) * np.uint64(1 << 32) + part.astype(np.uint64) + np.uint64(1))
        keys.append(mix64(total ^ salt)[keep]), rows.append(row[keep])
    return np.concatenate(keys), np.concatenate(rows)


# --- signature trees
class Tree:
    """Packed tree over sets: level 0 are the sets, every node above has ``FAN`` children."""

    def __init__(self, ids: np.ndarray, sets: list[np.ndarray], bits: int):
        size = np.array([len(x) for x in sets], np.int64)
        order = np.lexsort(([int(x[0]) for x in sets], size)) if len(sets) else np.zeros(0, np.int64)
        self.ids, self.sets, size = ids[order], [sets[i] for i in order.tolist()], size[order]
        marks = np.zeros((len(sets), bits // 64), np.uint64)
        for i, x in enumerate(self.sets):
            bit = x & np.uint64(bits - 1)
            np.bitwise_or.at(marks[i], (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63)))
        spare = size - np.bitwise_count(marks).sum(axis=1, dtype=np.int64)
        self.levels = [(marks, size, size, spare)]
        while len(self.levels[-1][1]) > 1:
            m, lo, hi, more = self.levels[-1]
            at = np.arange(0, len(lo), FAN)
            self.levels.append((np.bitwise_or.reduceat(m, at), np.minimum.reduceat(lo, at), np.maximum.reduceat(hi, at), np.maximum.reduceat(more, at)))

    def span(self, level: int, i: int) -> tuple[int, int]:
        return i * FAN**level, min((i + 1) * FAN**level, len(self.ids))


def bitmap_bits(sets: list[np.ndarray]) -> int:
    """Bits of the bitmaps of a join: a few for every shingle of a set of usual size."""
    usual = int(np.quantile([len(x) for x in sets], 0.9)) if sets else 1
    return 1 << min(15, max(8, ceil(np.log2(8 * usual))))


def join_trees(a: Tree, b: Tree, label: np.ndarray, percent: int = PERCENT) -> tuple[list[int], list[int]]:
    """Links between sets of both trees that connect exactly those that all links would connect. ``label`` has a
    number for each set of ``a``, then of ``b`` (``b`` may be ``a`` itself): equal numbers are connected."""
    same = a is b
    na, shift = len(a.ids), 0 if same else len(a.ids)
    src, dst = [], []
    members: dict[int, list[int]] = {}
    for i, x in enumerate(label.tolist()):
        members.setdefault(x, []).append(i)

    def unite(i: int, j: int) -> None:
        x, y = label[i], label[j]
        if len(members[x]) < len(members[y]):
            x, y = y, x
        label[members[y]] = x
        members[x] += members.pop(y)

    def possible(x, y):
        """Which pairs of children of two nodes can hold a link."""
        (ma, lo_a, hi_a, more_a), (mb, lo_b, hi_b, more_b) = x, y
        fits = (100 * hi_a[:, None] >= percent * lo_b[None]) & (100 * hi_b[None] >= percent * lo_a[:, None])
        if fits.any():
            common = np.bitwise_count(ma[:, None] & mb[None]).sum(axis=2, dtype=np.int64) + np.minimum(more_a[:, None], more_b[None])
            fits &= (100 + percent) * common >= percent * (lo_a[:, None] + lo_b[None])
        return fits

    def connected(i0, i1, j0, j1):
        x = label[i0]
        return (label[i0:i1] == x).all() and (label[shift + j0 : shift + j1] == x).all()

    def verify(i0, i1, j0, j1, fits):
        for i, j in zip(*(x.tolist() for x in np.nonzero(fits)), strict=True):
            i, j = i0 + i, j0 + j
            if (same and j <= i) or label[i] == label[shift + j]:
                continue
            x, y = a.sets[i], b.sets[j]
            both = len(x) + len(y)
            # sorted sets: repeats in the merge are what they share
            merged = np.sort(np.concatenate([x, y]), kind="stable")
            shared = int((merged[1:] == merged[:-1]).sum())
            if 100 * shared >= percent * (both - shared):
                src.append(int(a.ids[i])), dst.append(int(b.ids[j]))
                unite(i, shift + j)

    def cut(tree, level, lo, hi):
        return tuple(x[lo:hi] for x in tree.levels[level])

    if not na or not len(b.ids):
        return src, dst
    todo = [(len(a.levels) - 1, 0, len(b.levels) - 1, 0)]
    while todo:
        la, i, lb, j = todo.pop()
        (i0, i1), (j0, j1) = a.span(la, i), b.span(lb, j)
        if connected(i0, i1, j0, j1):
            continue
        if la == 0 and lb == 0:
            verify(i0, i1, j0, j1, possible(cut(a, 0, i0, i1), cut(b, 0, j0, j1)))
            continue
        # children of the higher node, of both if they are level
        da, db = la >= lb and la > 0, lb >= la and lb > 0
        ca = (i * FAN, min((i + 1) * FAN, len(a.levels[la - 1][1]))) if da else (i, i + 1)
        cb = (j * FAN, min((j + 1) * FAN, len(b.levels[lb - 1][1]))) if db else (j, j + 1)
        la, lb = la - da, lb - db
        fits = possible(cut(a, la, *ca), cut(b, lb, *cb))
        if la == 0 and lb == 0:
            verify(ca[0], ca[1], cb[0], cb[1], fits)
            continue
        pairs = [(ca[0] + x, cb[0] + y) for x, y in zip(*(z.tolist() for z in np.nonzero(fits)), strict=True)]
        pairs = [(x, y) for x, y in pairs if not same or y >= x]
        pairs.sort(key=lambda p: -abs(p[0] - p[1]))  # near ones first: they are popped from the end
        todo += [(la, x, lb, y) for x, y in pairs]
    return src, dst


# --- Spark
def _sets_of(texts: pa.Array, k: int):
    for _, _, data, offsets in text_blocks(texts):
        yield shingle_sets(data, offsets, k)


def _lists(values: list[np.ndarray], sizes: list[np.ndarray], kind) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(np.concatenate([*sizes, np.zeros(0, np.int64)]))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*values, np.zeros(0, kind)])))


def families(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """``(doc_id, n, sid)`` per row of ``docs``, and ``(sid, root)`` of the sets that keys connect with others."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))

    @arrow_udf("array<struct<key:bigint,sid:bigint>>")
    def keys(texts: pa.Array) -> pa.Array:
        sizes, flat, owners = [], [], []
        for values, offsets in _sets_of(texts, shingle):
            key, row = part_keys(values, offsets, percent)
            order = np.argsort(row, kind="stable")
            sizes.append(np.bincount(row, minlength=len(offsets) - 1)), flat.append(key[order].view(np.int64)), owners.append(set_ids(values, offsets)[row[order]])
        ends = np.concatenate([[0], np.cumsum(np.concatenate([*sizes, np.zeros(0, np.int64)]))]).astype(np.int32)
        both = [pa.array(np.concatenate([*x, np.zeros(0, np.int64)])) for x in (flat, owners)]
        return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(both, ["key", "sid"]))

    repeated = materialize(
        docs.select(F.explode(keys(text)).alias("k")).select("k.key", "k.sid")
        .groupBy("key").agg(F.min("sid").alias("hub"), F.max("sid").alias("last")).where("hub < last").select("key", "hub")
    )
    bitmap = spark.sparkContext.broadcast(bloom_words(repeated, "key", BLOOM_BITS))

    @arrow_udf("struct<n:bigint,sid:bigint,keys:array<bigint>>")
    def marked(texts: pa.Array) -> pa.Array:
        counts, ids, sizes, flat = [], [], [], []
        for values, offsets in _sets_of(texts, shingle):
            key, row = part_keys(values, offsets, percent)
            hit = in_bloom(bitmap.value, key)
            key, row = key[hit], row[hit]
            order = np.argsort(row, kind="stable")
            counts.append(np.diff(offsets)), ids.append(set_ids(values, offsets))
            sizes.append(np.bincount(row, minlength=len(offsets) - 1)), flat.append(key[order].view(np.int64))
        columns = [pa.array(np.concatenate([*x, np.zeros(0, np.int64)])) for x in (counts, ids)]
        return pa.StructArray.from_arrays([*columns, _lists(flat, sizes, np.int64)], ["n", "sid", "keys"])

    rows = materialize(docs.select("doc_id", marked(text).alias("m")).select("doc_id", "m.*"))
    held = rows.groupBy("sid").agg(F.first("keys").alias("keys")).select("sid", F.explode("keys").alias("key"))
    edges = held.join(repeated, "key").where("sid <> hub").select(F.col("hub").alias("src"), F.col("sid").alias("dst"))
    roots = connected(edges)
    return rows.select("doc_id", "n", "sid"), roots.select(F.col("node").alias("sid"), "root")


def _own_classes(percent: int):
    def solve(ids: list[int], raw: list[bytes]) -> pa.RecordBatch:
        """Each set of a block with the smallest name of those it is connected with."""
        sets = [np.frombuffer(x, "<u8") for x in raw]
        tree = Tree(np.array(ids, np.int64), sets, bitmap_bits(sets))
        label = np.arange(len(ids))
        join_trees(tree, tree, label, percent)
        least = np.full(len(ids), np.iinfo(np.int64).max)
        np.minimum.at(least, label, tree.ids)
        return pa.RecordBatch.from_arrays([pa.array(tree.ids), pa.array(least[label])], ["sid", "comp"])

    def run(batches):
        """Blocks come one after the other, whole."""
        key, ids, raw, done, n = None, [], [], [], 0
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("root", "block", "sid", "shingles")]
            for root, block, sid, shingles in zip(*columns, strict=True):
                if (root, block) != key:
                    if ids:
                        done.append(solve(ids, raw))
                        n += len(ids)
                    key, ids, raw = (root, block), [], []
                ids.append(sid), raw.append(shingles)
            if n > 10_000:
                yield from done
                done, n = [], 0
        yield from done
        if ids:
            yield solve(ids, raw)

    return run


def _links(percent: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        """Links between the components, known so far, of two blocks."""
        sides = [x.combine_chunks() for x in (left, right)]
        src, dst = [], []
        if left.num_rows and right.num_rows:
            sets = [[np.frombuffer(x, "<u8") for x in t.column("shingles").to_pylist()] for t in sides]
            bits = bitmap_bits([x for s in sets for x in s])
            trees = [Tree(t.column("sid").to_numpy(), s, bits) for t, s in zip(sides, sets, strict=True)]
            known = [dict(zip(t.column("sid").to_pylist(), t.column("comp").to_pylist(), strict=True)) for t in sides]
            label = [known[k][i] for k, tree in enumerate(trees) for i in tree.ids.tolist()]
            a, b = join_trees(trees[0], trees[1], np.unique(np.array(label), return_inverse=True)[1], percent)
            src, dst = [known[0][i] for i in a], [known[1][i] for i in b]
        return pa.table({"src": pa.array(src, pa.int64()), "dst": pa.array(dst, pa.int64())})

    return run


def connected(edges: DataFrame) -> DataFrame:
    """``(node, root)`` of the nodes of ``edges(src, dst)``: every node hooks to its smallest neighbour, edges are
    renamed by the hooks' hooks, until none is left. Tables shrink fast, and so do the tasks that write them."""
    spark = edges.sparkSession

    def tidy(e: DataFrame) -> DataFrame:
        return e.where("src <> dst").select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).distinct()

    left = materialize(tidy(edges))
    hooks = []
    while n := left.count():
        tasks = ceil(n / EDGES)
        both = left.select(F.col("src").alias("node"), F.col("dst").alias("other")).unionByName(left.select(F.col("dst").alias("node"), F.col("src").alias("other")))
        once = both.groupBy("node").agg(F.min("other").alias("m")).select("node", F.least("node", "m").alias("via"))
        twice = once.select(F.col("node").alias("via"), F.col("via").alias("root"))
        hook = materialize(once.join(twice, "via").select("node", "root").coalesce(tasks))
        hooks.append(hook)
        to_src, to_dst = (hook.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root")) for c in ("src", "dst"))
        moved = left.join(to_src, "src").join(to_dst, "dst").select(F.col("src_root").alias("src"), F.col("dst_root").alias("dst"))
        left = materialize(tidy(moved).coalesce(tasks))
    if not hooks:
        return spark.createDataFrame([], "node bigint, root bigint")
    labels = hooks[0]
    for hook in hooks[1:]:
        labels = labels.withColumnRenamed("root", "via").join(hook.select(F.col("node").alias("via"), "root"), "via", "left").select("node", F.coalesce("root", "via").alias("root"))
    return materialize(labels)


def classes(sets: DataFrame, percent: int = PERCENT, block_sets: int = BLOCK_SETS) -> DataFrame:
    """``(sid, comp)``: the sets in ``sets(sid, root, shingles)`` with the name of the component that links
    within each ``root`` make; ``shingles`` are packed ascending 64-bit hashes."""
    size = F.sum(F.length("shingles") + 64)
    blocks = F.ceil(F.greatest(F.count(F.lit(1)) / block_sets, size / BLOCK_BYTES)).cast("int")
    counts = sets.groupBy("root").agg(blocks.alias("blocks"))
    dealt = materialize(sets.join(counts, "root").withColumn("block", F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int")))
    alone = dealt.select("root", "block", "sid", "shingles").repartition("root", "block").sortWithinPartitions("root", "block")
    found = materialize(alone.mapInArrow(_own_classes(percent), "sid bigint, comp bigint"))
    wide = dealt.where("blocks > 1")
    if not wide.limit(1).count():
        return found
    own = ["sid", "comp", "shingles"]

    def pairs(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
        # names anew: both sides come from one table
        sides = [df.select(*keys, *own).toDF(*keys, *own).groupBy(*keys) for df in (left, right)]
        return connected(sides[0].cogroup(sides[1]).applyInArrow(_links(percent), "src bigint, dst bigint"))

    def renamed(df: DataFrame, roots: DataFrame) -> DataFrame:
        named = roots.select(F.col("node").alias("comp"), F.col("root").alias("top"))
        return df.join(named, "comp", "left").withColumn("comp", F.coalesce("top", "comp")).drop("top")

    now = materialize(wide.join(found, "sid"))
    first = now.where("block = 0").withColumn("block", F.explode(F.expr("sequence(1, blocks - 1)")))
    roots = pairs(now.where("block > 0"), first, ["root", "block"])
    now, found = materialize(renamed(now, roots)), renamed(found, roots)
    # what is outside a family's largest component meets every block once
    sizes = now.groupBy("root", "comp").agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.groupBy("root").agg(F.max(F.struct("n", F.col("comp")))["comp"].alias("main"))
    outside = now.join(largest, "root").where("comp <> main").drop("main")
    if outside.limit(1).count():
        # these sets are few when copies of one text make a family; they are dealt into blocks of their own
        many = outside.groupBy("root").agg(blocks.alias("parts"))
        left = outside.join(many, "root").withColumn("part", F.pmod(F.xxhash64("sid", F.lit(1)), F.col("parts")).cast("int"))
        left = left.withColumn("block", F.explode(F.expr("sequence(0, blocks - 1)")))
        right = now.join(many, "root").withColumn("part", F.explode(F.expr("sequence(0, parts - 1)")))
        found = renamed(found, pairs(left, right, ["root", "block", "part"]))
    return found


def components(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, block_sets: int = BLOCK_SETS) -> DataFrame:
    """``(doc_id, n, component_id)`` per row of ``docs(doc_id, text)``."""
    spark = docs.sparkSession
    rows, roots = families(docs, shingle, percent)
    wanted = spark.sparkContext.broadcast(bloom_words(roots.select(F.xxhash64("sid").alias("key")), "key", BLOOM_BITS))

    @arrow_udf("boolean")
    def in_family(keys: pa.Array) -> pa.Array:
        return pa.array(in_bloom(wanted.value, keys.to_numpy(zero_copy_only=False).view(np.uint64)))

    @arrow_udf("struct<sid:bigint,shingles:binary>")
    def packed(texts: pa.Array) -> pa.Array:
        ids, sizes, flat = [], [], []
        for values, offsets in _sets_of(texts, shingle):
            ids.append(set_ids(values, offsets)), sizes.append(np.diff(offsets) * 8), flat.append(values)
        ends = np.concatenate([[0], np.cumsum(np.concatenate([*sizes, np.zeros(0, np.int64)]))]).astype(np.int32)
        raw = pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(np.concatenate([*flat, np.zeros(0, np.uint64)]))])
        return pa.StructArray.from_arrays([pa.array(np.concatenate([*ids, np.zeros(0, np.int64)])), raw], ["sid", "shingles"])

    text: Column = F.coalesce(F.col("text"), F.lit(""))
    # one document of each set that has relatives
    chosen = rows.where(in_family(F.xxhash64("sid"))).groupBy("sid").agg(F.min(F.xxhash64("doc_id")).alias("pick")).join(roots, "sid")
    picks = spark.sparkContext.broadcast(bloom_words(chosen.select(F.xxhash64("pick").alias("key")), "key", BLOOM_BITS))

    @arrow_udf("boolean")
    def picked(keys: pa.Array) -> pa.Array:
        return pa.array(in_bloom(picks.value, keys.to_numpy(zero_copy_only=False).view(np.uint64)))

    sets = docs.where(picked(F.xxhash64(F.xxhash64("doc_id")))).select(packed(text).alias("s")).select("s.*")
    sets = sets.join(roots, "sid").groupBy("sid").agg(F.first("root").alias("root"), F.first("shingles").alias("shingles"))
    found = classes(sets, percent, block_sets).withColumnRenamed("comp", "link")
    least = rows.groupBy("sid").agg(F.min("doc_id").alias("least"))
    rooted = least.join(found, "sid", "left").withColumn("link", F.coalesce("link", "sid"))
    ids = rooted.groupBy("link").agg(F.min("least").alias("component_id"))
    named = rooted.select("sid", "link").join(ids, "link").select("sid", "component_id")
    own = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    # sets without shingles are many and link with nothing: keys of their own
    key = F.when(F.col("n") > 0, F.col("sid")).otherwise(F.xxhash64("doc_id"))
    return rows.withColumn("key", key).join(named.withColumnRenamed("sid", "key"), "key", "left").select("doc_id", "n", own)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = components(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.col("n").alias("n_shingles"), "component_id")


# DuckDB: all documents that share a shingle, counted, then the smallest id along links.
ORACLE = r"""
WITH RECURSIVE
w AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_distinct(list_transform(range(1, greatest(len(w) - 2, 1) + 1), lambda i: array_to_string(list_slice(w, i, i + 2), ' '))) END AS s FROM w),
u AS (SELECT s, min(r) AS g FROM (SELECT r, list_sort(s) AS s FROM s WHERE len(s) > 0) GROUP BY s),
t AS (SELECT g, len(s) AS n, unnest(s) AS t FROM u),
p AS (SELECT a.g AS x, b.g AS y FROM t a JOIN t b ON a.t = b.t AND a.g < b.g AND 100 * a.n >= 90 * b.n AND 100 * b.n >= 90 * a.n
      GROUP BY a.g, b.g, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
e AS (SELECT x, y FROM p UNION ALL SELECT y, x FROM p),
reach(x, y) AS (SELECT g, g FROM u UNION SELECT reach.x, e.y FROM reach JOIN e ON e.x = reach.y),
m AS (SELECT s.r, s.doc_id, len(s.s) AS n, u.g FROM s LEFT JOIN u ON u.s = list_sort(s.s)),
least AS (SELECT g, min(doc_id) AS d FROM m GROUP BY g),
c AS (SELECT reach.x AS g, min(least.d) AS component_id FROM reach JOIN least ON least.g = reach.y GROUP BY reach.x)
SELECT m.doc_id, CAST(m.n AS BIGINT) AS n_shingles, CASE WHEN m.n = 0 THEN m.doc_id ELSE c.component_id END AS component_id FROM m LEFT JOIN c ON c.g = m.g
"""
