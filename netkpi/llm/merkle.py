"""Merkle manifest of a dataset, and membership proofs of its rows as octopus multiproofs.

A row is a leaf: the SHA-256 of its fields. The leaves of a group, in the order of their ids, fold sixteen at a time
into the group's subroot; the subroots, in the order of their groups, fold likewise into the root. Positions come from
one range sort of fixed-width digests (texts never move); each level is a grouping of at most 16 nodes a key.

Proofs are made a leaf partition at a time. A partition first works out, level by level, the smallest set of nodes that
it lacks: siblings of what it holds or can derive. These coordinates of all its leaves are fetched in one join. It then
derives the interior nodes that its leaves share, once, and writes each leaf's own proof from them.

Defined results: a null field is `-`; a null id comes first in its group and is never tampered with; rows that repeat an
id are ordered by their leaf, equal rows are leaves of their own; the null group comes first and differs from the empty
one; a group of one leaf has that leaf as subroot, a table of one group has its subroot as root; an empty table has no
root and no rows. Only the named columns are read, so extra columns may have any name.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from netkpi.llm.shared import attach
from netkpi.sources.tables import materialize

FAN = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Leaves of a partition, about; it is held whole by the task that writes its proofs (some 300 bytes a leaf).
PART_LEAVES = 50_000
#: The group of the tree over the subroots; groups of rows begin with `+`, the null group is empty.
TOP = "#"


def digest(parts: Iterable[bytes]) -> bytes:
    return hashlib.sha256(b"".join(parts)).hexdigest().encode()


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]).cast("binary"), 256)


def ordered(rows: DataFrame, part_leaves: int = PART_LEAVES) -> DataFrame:
    """Written rows (g, k, h, ...) with part, pos (place in g by k, then h) and n (rows of g).

    One range sort; equal rows are told apart by where they were read, so that they can be split, too. Counts per group
    and partition give each partition's first place.
    """
    rows = rows.withColumn("_tie", F.monotonically_increasing_id())
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // part_leaves))
    keys = [F.col("g").asc(), F.col("k").asc_nulls_first(), F.col("h").asc(), F.col("_tie").asc()]
    put = rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).drop("_tie")
    # the number has the partition in its upper bits and the place in it in the lower 33
    put = materialize(put.withColumn("_at", F.monotonically_increasing_id()).withColumn("part", F.shiftright("_at", 33)), "merkle-order")
    held = put.groupBy("g", "part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_held"))
    whole = Window.partitionBy("g")
    before = F.sum("_held").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    held = materialize(held.select("g", "part", "_first", F.coalesce(before, F.lit(0)).alias("_before"),
                                   F.sum("_held").over(whole).alias("n")), "merkle-held")
    return (put.join(held, ["g", "part"])
            .withColumn("pos", F.col("_at") - F.col("_first") + F.col("_before")).drop("_at", "_first", "_before"))


def levels(leaves: DataFrame) -> DataFrame:
    """All nodes (g, level, pos, n, h) over leaves (g, pos, n, h); n counts the nodes of that level. Written."""
    at = leaves.select("g", F.lit(0).alias("level"), "pos", "n", "h")
    done, level = None, 0
    while True:
        at = materialize(at, "merkle-level")
        done = at if done is None else done.unionByName(at)
        more = at.filter("n > 1")
        if more.isEmpty():
            return done
        level += 1
        run = F.transform(F.array_sort(F.collect_list(F.struct("pos", "h"))), lambda x: x["h"])
        at = (more.groupBy("g", F.shiftright("pos", 4).alias("up"), "n").agg(F.sha2(F.concat_ws("", run).cast("binary"), 256).alias("h"))
              .select("g", F.lit(level).alias("level"), F.col("up").alias("pos"),
                      F.shiftright(F.col("n") + FAN - 1, 4).alias("n"), "h"))


@dataclass(frozen=True)
class Manifest:
    """leaves: g, k, h, the carried columns, part, pos, n, and of the group gpos, gn, subroot. nodes: g, level, pos, n, h."""
    leaves: DataFrame
    nodes: DataFrame
    root: str | None


def manifest(rows: DataFrame, part_leaves: int = PART_LEAVES) -> Manifest:
    """rows: g (text, not null), k (id), h (leaf digest), and columns that are carried along."""
    own = ordered(materialize(rows, "merkle-leaves"), part_leaves)
    own = materialize(own, "merkle-places")
    below = levels(own)
    roots = below.filter("n = 1").select("g", "h")
    top = ordered(materialize(roots.select(F.lit(TOP).alias("g"), F.col("g").alias("k"), "h"), "merkle-subroots"), part_leaves)
    top = materialize(top, "merkle-top")
    above = levels(top)
    last = above.filter("n = 1").select("h").first()
    group = top.select(F.col("k").alias("g"), F.col("pos").alias("gpos"), F.col("n").alias("gn"), F.col("h").alias("subroot"))
    leaves = attach(own, materialize(group, "merkle-groups"), "g", None, 0, "inner")
    return Manifest(leaves, below.unionByName(above), last[0] if last else None)


def lacking(held: Iterable[int], n: int) -> list[tuple[int, int]]:
    """Levels and places of the fewest nodes that, with the held leaves of n, give the root and every path to it."""
    held, out, level = set(held), [], 0
    while n > 1:
        up = {p // FAN for p in held}
        out += [(level, c) for q in up for c in range(FAN * q, min(n, FAN * q + FAN)) if c not in held]
        held, n, level = up, -(-n // FAN), level + 1
    return out


def climb(held: dict[int, bytes], fetched: dict[tuple[int, int], bytes], n: int) -> list[dict[int, bytes]]:
    """Per level the nodes that are held, fetched or derived; the last level has the root alone."""
    out: list[dict[int, bytes]] = []
    for p, h in fetched.items():
        while len(out) <= p[0]:
            out.append({})
        out[p[0]][p[1]] = h
    level = 0
    while True:
        if len(out) <= level:
            out.append({})
        at = out[level]
        at.update(held)
        if n == 1:
            return out
        held = {q: digest(at[c] for c in range(FAN * q, min(n, FAN * q + FAN))) for q in {p // FAN for p in held}}
        n, level = -(-n // FAN), level + 1


class Paths:
    """Proofs of the leaves of one group (or of the subroots) from the nodes of `climb`."""

    def __init__(self, nodes: list[dict[int, bytes]], n: int) -> None:
        self.nodes, self.sizes, self.joined = nodes, [n], {}
        while self.sizes[-1] > 1:
            self.sizes.append(-(-self.sizes[-1] // FAN))
        self.root = nodes[-1][0]

    def around(self, level: int, pos: int) -> tuple[bytes, bytes]:
        """Siblings on the left and on the right, joined."""
        at, first = self.nodes[level], pos - pos % FAN
        return (b"".join([at[c] for c in range(first, pos)]),
                b"".join([at[c] for c in range(pos + 1, min(self.sizes[level], first + FAN))]))

    def siblings(self, level: int, pos: int) -> bytes:
        """From this level up to the root; what leaves have in common is joined once."""
        if level == len(self.sizes) - 1:
            return b""
        if (found := self.joined.get((level, pos))) is None:
            found = b"".join(self.around(level, pos)) + self.siblings(level + 1, pos // FAN)
            if level:
                self.joined[level, pos] = found
        return found

    def fold(self, pos: int, h: bytes) -> bytes:
        """The root that follows from another digest at a leaf's place and the original siblings."""
        for level in range(len(self.sizes) - 1):
            left, right = self.around(level, pos)
            h, pos = digest((left, h, right)), pos // FAN
        return h


def _missing(table: pa.Table) -> pa.Table:
    """The coordinates that a leaf partition lacks, in the trees of its groups and in the tree over the groups."""
    groups: dict[str, tuple[int, list[int]]] = {}
    over: dict[int, int] = {}
    for g, pos, n, gpos, gn in zip(*(table.column(c).to_pylist() for c in ("g", "pos", "n", "gpos", "gn")), strict=True):
        groups.setdefault(g, (n, []))[1].append(pos)
        over[gpos] = gn
    found = [(g, level, pos) for g, (n, held) in groups.items() for level, pos in lacking(held, n)]
    found += [(TOP, level, pos) for level, pos in lacking(over, next(iter(over.values())))]
    part = table.column("part")[0].as_py()
    cols = list(zip(*found, strict=True)) or [(), (), ()]
    return pa.table({"part": pa.array([part] * len(found), pa.int64()), "g": pa.array(cols[0], pa.string()),
                     "level": pa.array(cols[1], pa.int32()), "pos": pa.array(cols[2], pa.int64())})


def _proved(leaves: pa.Table, fetched: pa.Table) -> pa.Table:
    """Proof and folded root of every leaf of a partition."""
    known: dict[str, dict[tuple[int, int], bytes]] = {}
    for g, level, pos, h in zip(*(fetched.column(c).to_pylist() for c in ("g", "level", "pos", "h")), strict=True):
        known.setdefault(g, {})[level, pos] = h.encode()
    held: dict[str, dict[int, bytes]] = {}
    place: dict[str, tuple[int, int, int]] = {}
    rows = list(zip(*(leaves.column(c).to_pylist() for c in ("g", "pos", "n", "gpos", "gn", "h", "told")), strict=True))
    for g, pos, n, gpos, gn, h, _ in rows:
        held.setdefault(g, {})[pos] = h.encode()
        place[g] = n, gpos, gn
    paths = {g: Paths(climb(held[g], known.get(g, {}), n), n) for g, (n, _, _) in place.items()}
    gn = next(iter(place.values()))[2]
    top = Paths(climb({gpos: paths[g].root for g, (_, gpos, _) in place.items()}, known.get(TOP, {}), gn), gn)
    proof, folded, subroot = [], [], []
    for g, pos, _, gpos, _, h, told in rows:
        own = paths[g]
        proof.append(digest((own.siblings(0, pos), top.siblings(0, gpos))).decode())
        changed = told is not None and told != h
        folded.append((top.fold(gpos, own.fold(pos, told.encode())) if changed else top.root).decode())
        subroot.append(own.root.decode())
    return pa.table({"k": leaves.column("k"), "h": leaves.column("h"), "subroot": pa.array(subroot, pa.string()),
                     "proof_sha256": pa.array(proof, pa.string()), "folded_root": pa.array(folded, pa.string())})


def proofs(made: Manifest, wanted: DataFrame | None = None) -> DataFrame:
    """k, h, subroot, proof_sha256 (siblings joined from leaf to root, hashed) and folded_root of wanted rows.

    wanted: rows of made.leaves, all if None; a column `told` holds the digest to fold in place of the leaf's (null: its own).
    """
    rows = made.leaves if wanted is None else wanted
    if "told" not in rows.columns:
        rows = rows.withColumn("told", F.lit(None).cast("string"))
    rows = materialize(rows.select("part", "g", "k", "h", "told", "pos", "n", "gpos", "gn"), "merkle-wanted")
    asked = (rows.select("part", "g", "pos", "n", "gpos", "gn").groupBy("part")
             .applyInArrow(_missing, "part long, g string, level int, pos long"))
    nodes = made.nodes.select("g", "level", "pos", "h")
    got = materialize(materialize(asked, "merkle-asked").join(nodes, ["g", "level", "pos"]), "merkle-fetched")
    kind = dict(rows.dtypes)["k"]
    return rows.groupBy("part").cogroup(got.groupBy("part")).applyInArrow(
        _proved, f"k {kind}, h string, subroot string, proof_sha256 string, folded_root string")


def group_key(group: Column) -> Column:
    """Text that sorts null first, then by UTF-8 bytes."""
    return F.coalesce(F.concat(F.lit("+"), group.cast("string")), F.lit(""))


def verified(docs: DataFrame, told: Column, fields: Sequence[str] = FIELDS, key: str = "doc_id", group: str = "source",
             text: Column | None = None, part_leaves: int = PART_LEAVES) -> DataFrame:
    """Manifest of docs, and for every row whether the row as told still belongs to it.

    told: true where the row comes back with `text` in place of its last field. Returns key, leaf, subroot, root,
    proof_sha256, folded_root, verified.
    """
    values = [F.col(c) for c in fields]
    changed = F.when(told, leaf([*values[:-1], values[-1] if text is None else text]))
    made = manifest(docs.select(group_key(F.col(group)).alias("g"), F.col(key).alias("k"), leaf(values).alias("h"), changed.alias("told")),
                    part_leaves)
    out = proofs(made)
    root = F.lit(made.root).cast("string")
    return out.select(F.col("k").alias(key), F.col("h").alias("leaf"), "subroot", root.alias("root"), "proof_sha256", "folded_root",
                      (F.col("folded_root") == root).alias("verified"))
