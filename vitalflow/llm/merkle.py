"""A Merkle manifest of a dataset: a tree of SHA-256 per group, folded from retained hash states.

A leaf is the hash of a row's values. In each group the leaves, in order of their ids, are joined
by `arity` into parents, these again, until one node is left; the nodes of all groups, in order of
the groups, are joined likewise into the root.

A parent's hash is fed one child after the other, and a copy of the hash state is kept before each
child's slot. To fold a changed leaf, its parent's state before that slot is taken up again and fed
the new digest and the right siblings only; what stands left of it is never hashed again.

A hash state can't leave its process, so trees are built in blocks of arity ** LEVELS leaves, each
by one task: it builds the block's nodes with their states, then folds all of the block's rows.
Blocks' tops are the leaves of the next tree of blocks, and so on; log(rows) / log(4096) rounds
give the root. Then each block gets its path to the root: per level its slot and the parent's
children, some 512 bytes. The task keeps the one state of each such parent before that slot, so
rows fold on to the root there too.

Rows are numbered within groups by ranges (ordering.positions), so a group may hold any number of
rows; only digests and ids are shuffled, never texts. A block's 4096 rows and its path are all a
task holds.

Nulls: a null value is hashed as "-"; a null group is a group of its own and comes first, a null id
comes first in its group. Rows with one id are ordered by their digests; equal rows are leaves of
their own. An empty table gives no rows. Columns other than those named are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import RowWriter, materialise
from .ordering import positions

ARITY, LEVELS = 16, 3
PATH = "array<struct<slot: int, children: binary>>"
_PATH = pa.list_(pa.struct([("slot", pa.int32()), ("children", pa.binary())]))
HEX = 64


def leaf_digest(values: Sequence[Column]) -> Column:
    """Hex SHA-256 of the values: each "-" if null, else its count of UTF-8 bytes, ":" and it."""
    texts = [v.cast("string") for v in values]
    marked = [
        F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts
    ]
    return F.sha2(F.concat(*marked).cast("binary"), 256)


def _levels(count: int, arity: int) -> int:
    levels, width = 0, 1
    while width < count:
        levels, width = levels + 1, width * arity
    return levels


class Parent:
    """A node over some children, with the hash state before each child's slot."""

    __slots__ = ("children", "states", "digest")

    def __init__(self, children: bytes):
        state, self.children, self.states = hashlib.sha256(), children, []
        for at in range(0, len(children), HEX):
            self.states.append(state.copy())
            state.update(children[at : at + HEX])
        self.digest = state.hexdigest().encode()


class Slot:
    """A place in a parent: folds a child's new digest and knows the siblings."""

    __slots__ = ("state", "right", "siblings")

    def __init__(self, state, children: bytes, slot: int):
        at = slot * HEX
        self.state, self.right = state, children[at + HEX :]
        self.siblings = children[:at] + self.right

    def fold(self, digest: bytes) -> bytes:
        state = self.state.copy()
        state.update(digest + self.right)
        return state.hexdigest().encode()


def slot_on_path(slot: int, children: bytes) -> Slot:
    """The slot of a parent elsewhere: its state is fed the children left of it once."""
    return Slot(hashlib.sha256(children[: slot * HEX]), children, slot)


class Block:
    """The nodes over some leaves, level by level up to one top."""

    def __init__(self, leaves: list[bytes], levels: int, arity: int):
        self.arity, self.parents, nodes = arity, [], leaves
        for _ in range(levels):
            row = [Parent(b"".join(nodes[i : i + arity])) for i in range(0, len(nodes), arity)]
            self.parents.append(row)
            nodes = [p.digest for p in row]
        (self.top,) = nodes

    def steps(self, leaf: int):
        """(slot, children) of each parent above a leaf."""
        for row in self.parents:
            leaf, slot = divmod(leaf, self.arity)
            yield slot, row[leaf].children

    def slots(self, leaf: int) -> list[Slot]:
        out = []
        for row in self.parents:
            leaf, slot = divmod(leaf, self.arity)
            out.append(Slot(row[leaf].states[slot], row[leaf].children, slot))
        return out


def _blocks(batches):
    """Rows of one block (equal in their first two columns), as a list of tuples."""
    rows, current = [], None
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[:2] != current:
                if rows:
                    yield rows
                rows, current = [], row[:2]
            rows.append(row)
    if rows:
        yield rows


def _in_blocks(nodes: DataFrame, tops: DataFrame | None = None, columns: Sequence[str] = ()) -> DataFrame:
    """The rows of a block together: first its row of `tops`, with at = -1, then its nodes in order."""
    rows = nodes.select("grp", "block", "at", "size", "digest", *columns)
    if tops is not None:
        marked = tops.select("grp", "block", F.lit(-1).cast("long").alias("at"), "path", "subroot", "root")
        rows = rows.unionByName(marked, allowMissingColumns=True)
    return rows.repartition("grp", "block").sortWithinPartitions("grp", "block", "at")


def _numbered(nodes: DataFrame, width: int) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("at") / width))


def _built(rows: list[tuple], arity: int, width: int) -> Block:
    return Block([r[4].encode() for r in rows], _levels(min(rows[0][3], width), arity), arity)


def _grown(nodes: DataFrame, arity: int, width: int) -> DataFrame:
    """The top of each block, which is a node of the next tree: grp, at, digest, size."""
    schema = pa.schema([("grp", pa.string()), ("at", pa.int64()), ("digest", pa.string()), ("size", pa.int64())])

    def run(batches):
        out = RowWriter(schema)
        for rows in _blocks(batches):
            top = _built(rows, arity, width).top.decode()
            out.add(*rows[0][:2], top, -(-rows[0][3] // width))
            if out.full():
                yield out.take()
        yield out.take()

    return _in_blocks(nodes).mapInArrow(run, "grp string, at bigint, digest string, size bigint")


def _grow(nodes: DataFrame, arity: int, width: int) -> tuple[list[DataFrame], DataFrame]:
    """The nodes of each round from below, and the single top of each group."""
    rounds = [_numbered(nodes, width)]
    while True:
        tops = materialise(_grown(rounds[-1], arity, width), "merkle-tops")
        if (tops.agg(F.max("size")).first()[0] or 1) == 1:
            return rounds, tops
        rounds.append(_numbered(tops, width))


def _paths(nodes: DataFrame, tops: DataFrame, arity: int, width: int, name: str) -> DataFrame:
    """Each node with its path through its block and then the block's own: grp, block, digest, path,
    subroot, root, name. A node's position is the number of the block that it is the top of.
    """
    schema = pa.schema(
        [("grp", pa.string()), ("block", pa.int64()), ("digest", pa.string()), ("path", _PATH)]
        + [(n, pa.string()) for n in ("subroot", "root", "name")]
    )

    def run(batches):
        out = RowWriter(schema, 512)
        for (top, *rows) in _blocks(batches):
            block = _built(rows, arity, width)
            for i, row in enumerate(rows):
                path = [{"slot": slot, "children": children} for slot, children in block.steps(i)]
                out.add(row[0], row[2], row[4], path + top[6], *top[7:9], row[5])
                if out.full():
                    yield out.take()
        yield out.take()

    kind = f"grp string, block bigint, digest string, path {PATH}, subroot string, root string, name string"
    named = nodes.withColumn("name", F.col(name))
    return materialise(_in_blocks(named, tops, ["name"]).mapInArrow(run, kind), "merkle-paths")


def _folds(leaves: DataFrame, tops: DataFrame, arity: int, width: int) -> DataFrame:
    """One block at a time: its nodes with their states, and the folds of all its rows to the root."""
    texts = ("grp", "leaf", "subroot", "root", "proof_sha256", "folded_root")
    schema = pa.schema([("id", pa.int64()), *[(t, pa.string()) for t in texts], ("verified", pa.bool_())])

    def run(batches):
        out = RowWriter(schema)
        for (top, *rows) in _blocks(batches):
            block = _built(rows, arity, width)
            path, subroot, root = top[7:10]
            upper = [slot_on_path(step["slot"], step["children"]) for step in path]
            upper_siblings = b"".join(s.siblings for s in upper)
            for i, (group, _, _, _, leaf, id_, now, *_) in enumerate(rows):
                lower = block.slots(i)
                digest = (now or leaf).encode()
                for slot in (*lower, *upper):
                    digest = slot.fold(digest)
                proof = hashlib.sha256(b"".join(s.siblings for s in lower) + upper_siblings).hexdigest()
                folded = digest.decode()
                out.add(id_, group, leaf, subroot, root, proof, folded, folded == root)
                if out.full():
                    yield out.take()
        yield out.take()

    kind = "id bigint, " + ", ".join(f"{t} string" for t in texts) + ", verified boolean"
    return _in_blocks(leaves, tops, ["id", "now"]).mapInArrow(run, kind)


def manifest(
    docs: DataFrame,
    columns: Sequence[str],
    group: str,
    order: str,
    now: Column | None = None,
    arity: int = ARITY,
    levels: int = LEVELS,
) -> DataFrame:
    """Each row's leaf, subroot, root and proof, and the root after folding the row as it is now.

    `columns` are the values that a leaf hashes, `group` and `order` place the leaves. `now` is the
    digest of a row's present values, null where they are the leaf's. Columns: id (the order), grp,
    leaf, subroot, root, proof_sha256 (hash of all siblings, level by level to the root),
    folded_root, verified (the folded root is the root).
    """
    width = arity**levels
    leaves = docs.select(
        F.col(order).cast("long").alias("id"),
        F.col(group).cast("string").alias("grp"),
        leaf_digest([F.col(c) for c in columns]).alias("digest"),
        (F.lit(None).cast("string") if now is None else now).alias("now"),
    )
    leaves = positions(materialise(leaves, "merkle-leaves"), "grp", ["id", "digest"], "at", "size", "merkle-order")
    rounds, subroots = _grow(materialise(leaves, "merkle-placed"), arity, width)
    # the groups' tops are the leaves of one more tree
    named = subroots.select(F.lit("").alias("grp"), F.col("grp").alias("name"), "digest")
    ranked = positions(materialise(named, "merkle-groups"), "grp", ["name"], "at", "size", "merkle-order")
    above, root = _grow(materialise(ranked, "merkle-ranked"), arity, width)
    tops = root.select(
        "grp",
        F.col("at").alias("block"),
        F.array().cast(PATH).alias("path"),
        F.lit(None).cast("string").alias("subroot"),
        F.col("digest").alias("root"),
    )
    for nodes in reversed(above):
        tops = _paths(nodes, tops, arity, width, "name" if nodes is above[0] else "grp")
    tops = tops.select(
        F.col("name").alias("grp"), F.lit(0).cast("long").alias("block"), "path", F.col("digest").alias("subroot"), "root"
    )
    for nodes in reversed(rounds[1:]):
        tops = _paths(nodes, tops, arity, width, "grp")
    return _folds(rounds[0], tops, arity, width)


#: Fixed: the columns that a leaf of the documents table hashes, in order.
DOCUMENT_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def tampered_documents(docs: DataFrame) -> Column:
    """The digest of a document whose text has lost its ASCII capitals, for a fifth of all ids."""
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    changed = [F.col(c) for c in DOCUMENT_COLUMNS[:-1]] + [F.translate("text", capitals, capitals.lower())]
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return F.when(chosen, leaf_digest(changed))


def _oracle(group_levels: int = 5, root_levels: int = 3) -> str:
    """The same by whole lists, for up to 16 ** 5 documents a source and 16 ** 3 sources."""
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

    def leaf(text: str) -> str:
        values = [*DOCUMENT_COLUMNS[:-1], text]
        parts = [f"CASE WHEN {v} IS NULL THEN '-' ELSE strlen(CAST({v} AS VARCHAR)) || ':' || {v} END" for v in values]
        return f"sha256({' || '.join(parts)})"

    halved = "CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END"
    steps = [
        f"""crc AS (SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: {halved}) ORDER BY i) AS t FROM range(256) r(i))""",
        f"""doc AS (SELECT doc_id, coalesce('s' || source, '') AS grp, {leaf('text')} AS leaf,
  {leaf(f"translate(text, '{capitals}', '{capitals.lower()}')")} AS changed,
  xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda s: CAST(ord(s) AS BIGINT))),
    lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1])), 4294967295) AS crc FROM documents, crc)""",
        """d0 AS (SELECT doc_id, grp, leaf, CASE WHEN crc % 5 = 0 THEN changed ELSE leaf END AS cur, '' AS proof,
  row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM doc)""",
        "n0 AS (SELECT grp, pos, leaf AS h FROM d0)",
    ]

    def climb(d: str, n: str, k: int) -> None:
        steps.append(
            f"r{k} AS (SELECT grp, pos // {ARITY} AS run, list(h ORDER BY pos) AS hs, sum(count(*)) OVER (PARTITION BY grp) AS n "
            f"FROM {n} GROUP BY grp, pos // {ARITY})"
        )
        steps.append(f"n{k + 1} AS (SELECT grp, run AS pos, CASE WHEN n > 1 THEN sha256(array_to_string(hs, '')) ELSE hs[1] END AS h FROM r{k})")
        slot, before = f"d.pos % {ARITY}", "array_to_string(hs[1:slot], '')"
        steps.append(
            f"d{k + 1} AS (SELECT * EXCLUDE (pos, cur, proof, run, hs, n, slot), pos // {ARITY} AS pos, "
            f"CASE WHEN n > 1 THEN proof || {before} || array_to_string(hs[slot + 2:], '') ELSE proof END AS proof, "
            f"CASE WHEN n > 1 THEN sha256({before} || cur || array_to_string(hs[slot + 2:], '')) ELSE cur END AS cur "
            f"FROM (SELECT d.*, r.run, r.hs, r.n, {slot} AS slot FROM {d} d JOIN r{k} r ON r.grp = d.grp AND r.run = d.pos // {ARITY}))"
        )

    for k in range(group_levels):
        climb(f"d{k}", f"n{k}", k)
    top = group_levels
    steps.append(f"named AS (SELECT grp AS name, h AS subroot, row_number() OVER (ORDER BY grp) - 1 AS pos FROM n{top})")
    steps.append(f"n{top + 1} AS (SELECT '' AS grp, pos, subroot AS h FROM named)")
    steps.append(
        f"d{top + 1} AS (SELECT d.* EXCLUDE (grp, pos), '' AS grp, s.pos, s.subroot FROM d{top} d JOIN named s ON s.name = d.grp)"
    )
    for k in range(top + 1, top + 1 + root_levels):
        climb(f"d{k}", f"n{k}", k)
    last = top + 1 + root_levels
    return (
        f"WITH {', '.join(steps)} SELECT doc_id, leaf, subroot, h AS root, sha256(proof) AS proof_sha256, cur AS folded_root, "
        f"cur = h AS verified FROM d{last}, n{last}"
    )


ORACLE = _oracle()
