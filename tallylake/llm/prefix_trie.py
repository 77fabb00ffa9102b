"""The prefix trie of conversations, from vertical bitmaps.

A node of depth d is a distinct sequence of d first turns (role, text); the conversations that begin with it are its
members. Conversations are dealt out by ranges of their ids. A shard is one block of a range: its index maps each
(position, turn) to the bitset of the block's conversations that have this turn there. From the root, which all belong
to, the intersection of a parent's bitset with the postings of the turns that its members say next gives the children;
population counts are the members, and the members without a next turn form the end list.

Blocks meet by the path of a node: its depth and the sum, modulo 2^62, of two hashes of each (position, turn). Sums can
be carried on, so a conversation longer than `segment` turns is cut into segments that any task can index: they begin
at the path that the turns before add up to. Turns travel as 16 bytes of a SHA-256 of role and text, texts never do.

Totals over subtrees need no walk over pairs of nodes: each node belongs to its smallest member, the nodes of one
conversation form the end of its path, and a second walk over the same bitmaps adds up, for each node, what its members
own. What the smallest member owns above the node is taken off by a running total.

Null roles and texts count as empty, a null turn comes first, rows that tie in turn are ordered by role and by a hash of
role and text, a repeated row is a turn of its own. Rows with a null conv_id are left out. Extra columns are ignored. Without rows
there are no conversations and no node, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallylake.llm.prefix import running_totals
from tallylake.llm.staging import shuffle_width, staged

_MASK = (1 << 62) - 1
_NODES = "depth long, a long, b long, up_a long, up_b long, conv_id long, members long, size long, ends binary"
_WEIGHTS = "depth long, a long, b long, leaves long, owned long"
ENDS_IN_ROW = 1024


def numbered(messages: DataFrame) -> DataFrame:
    """(conv_id, place, mark, size) of rows (conv_id, turn, role, text): places count from 1, `mark` stands for role and
    text, `size` is the length of the text in bytes. A conversation may fill many partitions."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")
    rows = messages.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"),
        F.unhex(F.substring(F.sha2(whole, 256), 1, 32)).alias("mark"),
        F.octet_length(text).cast("long").alias("size"),
        F.lit(1).cast("long").alias("one"),
        F.monotonically_increasing_id().alias("copy"),  # deals out repeated rows
    )
    placed = running_totals(staged(rows, "turns"), "conv_id", ["turn", "role", "mark", "copy"], "one", "turn-places")
    return placed.select("conv_id", (F.col("before") + 1).alias("place"), "mark", "size")


def spliced(turns: DataFrame, every: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt from `numbered` turns, and the ids of all: c begins with the first h turns of c - c % every
    (all if it has fewer, none if it is absent), then come its own after its first h; h = crc32(c as text) % most.
    The remainder is never negative."""
    base = F.col("conv_id") - F.pmod("conv_id", F.lit(every))
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    ids = turns.where("place = 1").select("conv_id", base.alias("base"), taken.alias("taken"))
    heads = (
        turns.where((F.col("place") < most) & (F.col("conv_id") == base))
        .groupBy(F.col("conv_id").alias("base"))
        .agg(F.sort_array(F.collect_list(F.struct("place", "mark", "size"))).alias("head"))  # fewer than `most`
    )
    begun = staged(
        ids.join(heads, "base", "left").select(
            "conv_id", "taken", F.coalesce(F.filter("head", lambda t: t["place"] <= F.col("taken")), F.array()).alias("head")),
        "heads",
    )
    own = turns.join(begun.select("conv_id", "taken", F.size("head").alias("ahead")), "conv_id").where("place > taken")
    made = begun.select("conv_id", F.inline("head")).unionByName(
        own.select("conv_id", (F.col("place") - F.col("taken") + F.col("ahead")).alias("place"), "mark", "size"))
    return made, begun.select("conv_id")


class Block:
    """The vertical index of some segments of conversations, given as rows in the order of (conv_id, place)."""

    def __init__(self, table: pa.Table, segment: int):
        read = lambda name: table.column(name).to_numpy()
        conv, place, self.is_end = read("conv_id"), read("place"), read("is_end")
        part = (place - 1) // segment
        first = np.flatnonzero(np.r_[True, (conv[1:] != conv[:-1]) | (part[1:] != part[:-1])])
        self.row = first.tolist()
        self.conv = conv[first]
        self.a, self.b, self.size = read("a").tolist(), read("b").tolist(), read("size").tolist()
        self.before = (part[first] * segment).tolist()
        self.weights = {w: read(w)[first] for w in ("leaves", "owned") if w in table.column_names}
        self.postings: dict[tuple[int, int], int] = {}
        self.going: dict[int, int] = {}
        self.ending: dict[int, int] = {}
        self.roots: dict[tuple[int, int, int], int] = {}
        starts = list(zip(self.before, read("a0")[first].tolist(), read("b0")[first].tolist()))
        lasts = [*self.row[1:], len(conv)]
        ended = self.is_end.tolist()
        for i, (row, last) in enumerate(zip(self.row, lasts)):
            bit, at = 1 << i, self.before[i]
            self.roots[starts[i]] = self.roots.get(starts[i], 0) | bit
            for r in range(row, last):
                at += 1
                if ended[r]:
                    self.ending[at] = self.ending.get(at, 0) | bit
                else:
                    self.going[at] = self.going.get(at, 0) | bit
                    turn = self.a[r], self.b[r]
                    self.postings[turn] = self.postings.get(turn, 0) | bit

    def walk(self) -> Iterator[tuple[int, int, tuple[int, int, int], tuple[int, int], int, int]]:
        """Depth first: (number, number of the parent or -1, path, path sums of the parent, bitset, size of the last text)."""
        number = 0
        for (depth, a, b), members in self.roots.items():
            stack = [(-1, (depth, a, b), (0, 0), members, 0)]
            while stack:
                up, path, above, bits, size = stack.pop()
                yield number, up, path, above, bits, size
                depth, a, b = path
                rest = bits & self.going.get(depth + 1, 0)
                while rest:
                    i = (rest & -rest).bit_length() - 1
                    r = self.row[i] + depth - self.before[i]
                    turn = self.a[r], self.b[r]
                    child = bits & self.postings[turn]
                    stack.append((number, (depth + 1, a + turn[0] & _MASK, b + turn[1] & _MASK), (a, b), child, self.size[r]))
                    rest ^= child
                number += 1

    def chosen(self, bits: int) -> np.ndarray:
        """Positions of the set bits."""
        if bits & (bits - 1) == 0:
            return np.array([bits.bit_length() - 1] if bits else [], np.int64)
        raw = np.frombuffer(bits.to_bytes(len(self.row) // 8 + 1, "little"), np.uint8)
        return np.flatnonzero(np.unpackbits(raw, bitorder="little"))

    def nodes(self) -> pa.RecordBatch:
        """A row for each node, and rows without members that carry the ends, `ENDS_IN_ROW` ids in each."""
        made = []
        for _, up, (depth, a, b), above, bits, size in self.walk():
            if up >= 0 or depth == 0:
                first = int(self.conv[(bits & -bits).bit_length() - 1])
                made.append((depth, a, b, *above, first, bits.bit_count(), size, b""))
            if ends := bits & self.ending.get(depth + 1, 0):
                ids = self.conv[self.chosen(ends)]
                for i in range(0, len(ids), ENDS_IN_ROW):
                    part = ids[i : i + ENDS_IN_ROW]
                    made.append((depth, a, b, *above, int(part[0]), 0, size, part.astype("<i8").tobytes()))
        columns = zip(*made)
        types = [pa.int64()] * 8 + [pa.binary()]
        return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], [f.split()[0] for f in _NODES.split(", ")])

    def sums(self) -> pa.RecordBatch:
        """What the members of each node own."""
        paths, ups, leaves, owned = [], [], [], []
        for _, up, path, _, bits, _ in self.walk():
            last = self.chosen(bits & ~self.going.get(path[0] + 1, 0))
            paths.append(path)
            ups.append(up)
            leaves.append(int(self.weights["leaves"][last].sum()))
            owned.append(int(self.weights["owned"][last].sum()))
        for i in range(len(ups) - 1, -1, -1):  # children come after their parents
            if ups[i] >= 0:
                leaves[ups[i]] += leaves[i]
                owned[ups[i]] += owned[i]
        # A segment that goes on from another is counted there as well, at the path where it begins.
        kept = [i for i, (up, path) in enumerate(zip(ups, paths)) if up >= 0 or path[0] == 0]
        columns = [*zip(*(paths[i] for i in kept)), [leaves[i] for i in kept], [owned[i] for i in kept]]
        columns = columns if kept else [[]] * 5
        return pa.record_batch([pa.array(c, pa.int64()) for c in columns], [f.split()[0] for f in _WEIGHTS.split(", ")])


def _in_blocks(rows: DataFrame, work, schema: str, segment: int, block: int) -> DataFrame:
    """`work` on each block of about `block` rows of whole segments, in the order of (conv_id, place)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            for i in range(0, batch.num_rows, block):
                held.append(batch.slice(i, block))
                count += held[-1].num_rows
                if count < block:
                    continue
                table = pa.Table.from_batches(held)
                conv, place = table.column("conv_id").to_numpy(), table.column("place").to_numpy()
                part = (place - 1) // segment
                cut = int(np.flatnonzero(np.r_[True, (conv[1:] != conv[:-1]) | (part[1:] != part[:-1])])[-1])
                if cut:
                    yield work(Block(table.slice(0, cut), segment))
                    held, count = table.slice(cut).to_batches(), table.num_rows - cut
        if count:
            yield work(Block(pa.Table.from_batches(held), segment))

    part = F.call_function("div", F.col("place") - 1, F.lit(segment))
    dealt = rows.repartitionByRange(shuffle_width(rows.sparkSession), F.col("conv_id"), part)
    return dealt.sortWithinPartitions("conv_id", "place").mapInArrow(run, schema)


def _hash_of_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the comma-joined ids of each path; rows come by path and first id, so a list is read in pieces."""
    path, digest = None, None
    for batch in batches:
        done: list[tuple] = []
        for key, ids in zip(zip(*(batch.column(c).to_pylist() for c in ("depth", "a", "b"))), batch.column("ends").to_pylist()):
            if key != path:
                if path is not None:
                    done.append((*path, digest.hexdigest()))
                path, digest = key, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(",".join(map(str, np.frombuffer(ids, "<i8").tolist())).encode())
        if done:
            yield _ends_batch(done)
    if path is not None:
        yield _ends_batch([(*path, digest.hexdigest())])


def _ends_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows))
    return pa.record_batch(
        [*(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())], ["depth", "a", "b", "ends_sha256"])


def _hash(*of: Column) -> Column:
    return F.xxhash64(*of).bitwiseAND(F.lit(_MASK))


def trie(turns: DataFrame, ids: DataFrame | None = None, segment: int = 4096, block: int = 32_768) -> DataFrame:
    """The nodes of conversations given as `numbered` turns: conv_id (the smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256. `ids` may name conversations that have no turns."""
    present = turns.select("conv_id", "place")
    if ids is not None:
        present = present.unionByName(ids.select("conv_id", F.lit(0).cast("long").alias("place")))
    ends = present.groupBy("conv_id").agg((F.max("place") + 1).alias("place")).select(
        "conv_id", "place", *(F.lit(0).cast("long").alias(c) for c in ("size", "a", "b")), F.lit(True).alias("is_end"))
    said = turns.select(
        "conv_id", "place", "size", _hash(F.col("place"), F.col("mark")).alias("a"),
        _hash(F.col("mark"), F.col("place"), F.lit(1)).alias("b"), F.lit(False).alias("is_end"))
    rows = staged(said.unionByName(ends), "trie-turns")

    # Later segments of long conversations start from the sums of what comes before.
    part = F.call_function("div", F.col("place") - 1, F.lit(segment))
    later = rows.where(F.col("place") > segment)
    of_long = rows.join(later.select("conv_id").distinct(), "conv_id", "left_semi")
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = of_long.groupBy("conv_id", part.alias("part")).agg(
        *(F.sum(F.col(c).cast("decimal(20,0)")).cast("decimal(38,0)").alias(c) for c in "ab"))
    offsets = sums.select(
        "conv_id", "part",
        *((F.coalesce(F.sum(c).over(before), F.lit(0)) % F.lit(_MASK + 1)).cast("long").alias(f"{c}0") for c in "ab"))
    indexed = rows.where(F.col("place") <= segment).withColumns({c: F.lit(0).cast("long") for c in ("a0", "b0")}).unionByName(
        later.withColumn("part", part).join(offsets, ["conv_id", "part"]).drop("part"))

    local = staged(_in_blocks(indexed, Block.nodes, _NODES, segment, block), "trie-local")
    path = ["depth", "a", "b"]
    merged = local.where("members > 0").groupBy(*path).agg(
        F.min("conv_id").alias("conv_id"), F.sum("members").alias("n_convs"), F.max("size").alias("size"),
        F.max("up_a").alias("up_a"), F.max("up_b").alias("up_b"))
    merged = staged(merged, "trie-merged")
    children = merged.where("depth > 0").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("up_a").alias("a"), F.col("up_b").alias("b")
    ).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = merged.join(children, path, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))).withColumn(
        "saves", (F.col("n_convs") - 1) * F.col("size"))
    nodes = running_totals(nodes, "conv_id", ["depth"], "saves", "trie-nodes")

    owned = nodes.groupBy("conv_id").agg(
        F.sum((F.col("n_children") == 0).cast("long")).alias("leaves"), F.sum("saves").alias("owned"))
    weighed = indexed.join(owned, "conv_id", "left").na.fill(0, ["leaves", "owned"])
    totals = _in_blocks(weighed, Block.sums, _WEIGHTS, segment, block).groupBy(*path).agg(
        F.sum("leaves").alias("n_leaves"), F.sum("owned").alias("owned"))
    finished = (
        local.where("members = 0").select(*path, "conv_id", "ends")
        .repartition(shuffle_width(turns.sparkSession), *path).sortWithinPartitions(*path, "conv_id")
        .mapInArrow(_hash_of_ends, "depth long, a long, b long, ends_sha256 string")
    )
    above = merged.select(
        (F.col("depth") + 1).alias("depth"), F.col("a").alias("up_a"), F.col("b").alias("up_b"), F.col("conv_id").alias("parent_conv_id"))
    return (
        nodes.join(totals, path).join(finished, path, "left").join(above, ["depth", "up_a", "up_b"], "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
            (F.col("owned") - F.col("before")).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))
    )
