"""Prefix trie of conversations: union-find over the common prefixes of sorted neighbours.

A turn is the 128-bit digest of its role and text. A conversation's key is its
turns' digests in a row, and keys are sorted over all tasks (by key, then
conversation), so conversations with a common prefix stand together. Two
neighbours share as many turns as their keys have equal leading digests.

**One block.** Sorted rows are cut into blocks. Inside a block the links
between neighbours are taken by descending depth: union-find joins the two
components at the link's depth. Components that end deeper become children of a
new branching node; a component whose top is at that depth takes the other in,
which is also how equal conversations and those that end inside others join.

**Across blocks.** Nodes that do not reach a block's first or last row are
complete. The others lie on the way from the block's first or last row to its
top; each is contracted to what its complete children gave it. A block is thus
a short list of partial nodes with links between them, which has the form of a
block again. Some blocks' lists in a row, with the links between them, go
through the same union-find, in rounds of ``FAN`` lists a task, until one list
is left. Only these lists cross tasks: their length depends on the turns of a
block's first and last row, not on the table.

A node of the compressed trie stands for the depths between its parent and
itself, which have the same members; they are spelled out at the end.

The digest of the conversations that end at a node is taken while they pass in
order. Where a run of equal conversations crosses blocks, each block gives its
piece of the list, and one task digests the pieces of a run in order, a piece
at a time.

Cases: a null role or text is empty. Turns go by number, null first; equal
numbers by role, then text; repeated rows are turns of their own. Rows without
conv_id take no part. An empty table has no nodes, not even the root. Very long
texts only count code points; a very long conversation is one key (48 bytes a
turn) in one row. A third of all conversations may be equal: they are split by
conv_id over blocks. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewater.llm.common import small_batches, stage

HEX = 32  # characters of a turn's digest
ROWS, TURNS, IDS, FAN = 1 << 16, 1 << 20, 1 << 16, 16
# A complete node; of its parent either the conversation or, while that is partial, the key is known.
NODE = (
    "conv_id long, depth int, parent_depth int, parent_conv_id long, parent_key string, key string, n_convs long, "
    "n_children long, n_leaves long, below long, chars array<long>, ends_sha256 string, run string"
)
# A partial node in its block's list; ``key``: all digests of the block's first or last row, on those two.
FORM = (
    "block long, at int, link int, key string, depth int, n_convs long, least long, kids long, leaves long, below long, "
    "floor int, chars array<long>, ref string, ends_sha256 string, run string"
)
PIECE = "run string, first long, piece string"
EMPTY = hashlib.sha256(b"").hexdigest()


_TYPES = {"long": T.LongType(), "int": T.IntegerType(), "string": T.StringType(), "array<long>": T.ArrayType(T.LongType())}


def _struct(fields: str) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in (f.split() for f in fields.split(", "))])


OUT = T.StructType([T.StructField(n, _struct(f)) for n, f in (("node", NODE), ("form", FORM), ("piece", PIECE))])


def sequences(turns: DataFrame, group: int = 100, most: int = 6) -> DataFrame:
    """``conv_id, turn, role, text`` -> ``conv_id, key, sizes``: every conversation with its group's opening turns.

    Conversation c takes the first ``crc32(c) % most`` turns of conversation
    ``c - c % group``, then its own from there. ``key`` holds the turns' digests,
    ``sizes`` their code points.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), role, text)
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    turn = F.struct(F.row_number().over(order).alias("at"), digest.alias("key"), F.length(text).cast("long").alias("n"))
    placed = turns.filter("conv_id is not null").select("conv_id", turn.alias("t"))
    bare = F.transform(F.array_sort(F.collect_list("t")), lambda t: F.struct(t["key"].alias("key"), t["n"].alias("n")))
    own = stage(placed.groupBy("conv_id").agg(bare.alias("own")), "turns")
    first = own.filter(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("base"), F.slice("own", 1, most - 1).alias("heads"))
    take = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    opening = F.slice(F.coalesce("heads", F.slice("own", 1, 0)), F.lit(1), take)
    rest = F.slice("own", take + 1, F.greatest(F.size("own") - take, F.lit(0)))
    whole = own.withColumn("base", F.col("conv_id") - F.col("conv_id") % group).join(first, "base", "left").select(
        "conv_id", F.concat(opening, rest).alias("t")
    )
    return whole.select(
        "conv_id",
        F.array_join(F.transform("t", lambda t: t["key"]), "").alias("key"),
        F.transform("t", lambda t: t["n"]).alias("sizes"),
    )


def common_turns(a: str, b: str) -> int:
    m = min(len(a), len(b))
    if a[:m] == b[:m]:
        return m // HEX
    x, y = np.frombuffer(a[:m].encode(), np.uint8), np.frombuffer(b[:m].encode(), np.uint8)
    return int(np.argmax(x != y)) // HEX


def least(a: int | None, b: int | None) -> int | None:
    return b if a is None else a if b is None else min(a, b)


def item(depth: int, floor: int, chars: list, **more) -> dict:
    """A partial node: what its complete children and its own conversations gave it; ``chars[k]``: running sum at depth ``floor + k``."""
    blank = {"n_convs": 0, "least": None, "kids": 0, "leaves": 0, "below": 0, "ref": None, "ends_sha256": None, "run": None}
    return {"depth": depth, "floor": floor, "chars": chars, **blank, **more}


class Forest:
    """Union-find over partial nodes in a row; ``links[i]``: turns that the items i - 1 and i share."""

    def __init__(self, items: list[dict], links: list[int], final: bool):
        self.links, self.final, self.last = links, final, len(items) - 1
        self.up = list(range(len(items)))
        # By component: its top node, that node's complete children, the items it spans.
        self.top, self.children = items, [[] for _ in items]
        self.low, self.high = list(range(len(items))), list(range(len(items)))
        self.left, self.right = [], []  # partial nodes below the top, with their complete children
        self.rows: list[dict] = []

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def row(self, node: dict, children: list, above: int) -> dict:
        """The complete node, below depth ``above``; its children learn its conversation."""
        for child in children:
            child["parent_conv_id"] = node["least"]
        self.rows += children
        return {
            "conv_id": node["least"], "depth": node["depth"], "parent_depth": above, "parent_conv_id": None, "parent_key": None,
            "key": node["ref"], "n_convs": node["n_convs"], "n_children": node["kids"],
            "n_leaves": node["leaves"] if node["kids"] else 1, "below": node["below"],
            "chars": node["chars"][max(above, 0) - node["floor"] :], "ends_sha256": node["ends_sha256"], "run": node["run"],
        }

    def attach(self, parent: dict, siblings: list, node: dict, children: list) -> None:
        row = self.row(node, children, parent["depth"])
        siblings.append(row)
        parent["n_convs"] += row["n_convs"]
        parent["least"] = least(parent["least"], row["conv_id"])
        parent["kids"] += 1
        parent["leaves"] += row["n_leaves"]
        parent["below"] += row["below"] + (row["n_convs"] - 1) * (row["chars"][-1] - row["chars"][0])

    def give(self, parent: dict, siblings: list, r: int) -> None:
        """The top of component ``r`` becomes a child of ``parent``, at once if it is complete."""
        node, children = self.top[r], self.children[r]
        if not self.final and self.low[r] == 0:
            self.left.append((node, children))
        elif not self.final and self.high[r] == self.last:
            self.right.append((node, children))
        else:
            self.attach(parent, siblings, node, children)

    def grow(self) -> None:
        for i in sorted(range(1, self.last + 1), key=lambda i: -self.links[i]):
            d, a, b = self.links[i], self.find(i - 1), self.find(i)
            at_depth = [r for r in (a, b) if self.top[r]["depth"] == d]
            if len(at_depth) == 2:
                node, children = merged(self.top[a], self.top[b]), self.children[a] + self.children[b]
            elif at_depth:
                (keep,) = at_depth
                node, children = self.top[keep], self.children[keep]
                self.give(node, children, b if keep == a else a)
            else:
                child = min(self.top[a], self.top[b], key=lambda x: x["floor"])
                node, children = item(d, child["floor"], child["chars"][: d - child["floor"] + 1]), []
                self.give(node, children, a)
                self.give(node, children, b)
            self.up[b] = a
            self.top[a], self.children[a] = node, children
            self.top[b] = self.children[b] = None
            self.low[a], self.high[a] = min(self.low[a], self.low[b]), max(self.high[a], self.high[b])

    def finish(self) -> list[dict]:
        """All rows, down from the root."""
        self.grow()
        r = self.find(0)
        top, children = self.top[r], self.children[r]
        if top["depth"]:  # all share their first turns: the root has one child
            root, siblings = item(0, 0, top["chars"][:1]), []
            self.attach(root, siblings, top, children)
            top, children = root, siblings
        last = self.row(top, children, -1)
        self.rows.append(last)
        return self.rows

    def contract(self, first_key: str, last_key: str) -> list[dict]:
        """The partial nodes in their order, with links, from the first row's up to the top and down to the last row's."""
        self.grow()
        r = self.find(0)
        up, down = sorted(self.left, key=lambda x: -x[0]["depth"]), sorted(self.right, key=lambda x: x[0]["depth"])
        at, spine = len(up), [*up, (self.top[r], self.children[r]), *down]
        out = []
        for i, (node, children) in enumerate(spine):
            key = first_key if i <= at else last_key
            if node["ref"] is None:
                node["ref"] = hashlib.md5(f"{node['depth']}:{key[: node['depth'] * HEX]}".encode()).hexdigest()
            for child in children:  # their parent is partial: they name it by its key
                child["parent_key"] = node["ref"]
            self.rows += children
            above = spine[i + 1][0] if i < at else spine[i - 1][0] if i > at else None
            if above is not None and above["depth"] > node["floor"]:  # the rest of the way is in ``above``
                node["floor"], node["chars"] = above["depth"], node["chars"][above["depth"] - node["floor"] :]
            link = min(node["depth"], spine[i - 1][0]["depth"]) if i else None
            out.append(node | {"at": i, "link": link, "key": None})
        out[0]["key"], out[-1]["key"] = first_key, last_key
        return out


def merged(a: dict, b: dict) -> dict:
    """Two partial nodes that are the same node."""
    out = dict(a if a["floor"] <= b["floor"] else b)
    for name in ("n_convs", "kids", "leaves", "below"):
        out[name] = a[name] + b[name]
    out["least"] = least(a["least"], b["least"])
    for name in ("ref", "ends_sha256", "run"):
        out[name] = a[name] or b[name]
    return out


class Block:
    """Sorted rows of one task, folded while they pass: a run of equal keys is one item."""

    def __init__(self):
        self.items, self.links, self.keys, self.turns = [], [], [], 0
        self.ids, self.sha, self.pieced = [], hashlib.sha256(), False

    def row(self, key: str, conv: int, sizes: np.ndarray) -> Iterator[dict]:
        """Take one row; gives pieces of a run that has become long."""
        if not self.keys or key != self.keys[-1]:
            yield from self.end_run(len(self.items) == 1)
            chars = np.concatenate([[0], np.cumsum(sizes)]).tolist()
            self.links.append(common_turns(self.keys[-1], key) if self.keys else 0)
            self.keys = [self.keys[0] if self.keys else key, key]
            self.items.append(item(len(sizes), 0, chars, least=conv))
            self.turns += len(sizes) + 1
        self.items[-1]["n_convs"] += 1
        self.ids.append(conv)
        if len(self.ids) == IDS:
            yield self.piece()

    def piece(self) -> dict:
        run = hashlib.md5(self.keys[-1].encode()).hexdigest()
        self.items[-1]["run"], self.pieced = run, True
        first, text = self.ids[0], ",".join(map(str, self.ids))
        self.ids = []
        return {"run": run, "first": first, "piece": text}

    def end_run(self, at_edge: bool) -> Iterator[dict]:
        """The digest of a run that lies inside the block; else its piece, as the run may go on elsewhere."""
        if self.ids and (at_edge or self.pieced):
            yield self.piece()
        elif self.ids:
            self.items[-1]["ends_sha256"] = hashlib.sha256(",".join(map(str, self.ids)).encode()).hexdigest()
        self.ids, self.pieced = [], False

    def full(self) -> bool:
        return len(self.items) >= ROWS or self.turns >= TURNS

    def close(self) -> Iterator[tuple[str, dict]]:
        yield from (("piece", p) for p in self.end_run(True))
        forest = Forest(self.items, self.links, final=False)
        for form in forest.contract(self.keys[0], self.keys[-1]):
            yield "form", form
        yield from (("node", r) for r in forest.rows)


def _tables(rows: Iterator[tuple[str, dict]], size: int = 8192) -> Iterator[pa.RecordBatch]:
    """``(kind, row)`` as batches of the three structs, two of which are null in each row."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(OUT)
    have: list = []
    for kind, row in rows:
        have.append({kind: row})
        if len(have) == size:
            yield pa.RecordBatch.from_pylist(have, schema=schema)
            have = []
    if have:
        yield pa.RecordBatch.from_pylist(have, schema=schema)


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId() << 32

    def rows():
        block, number = Block(), 0
        for batch in batches:
            keys, convs = batch.column("key"), batch.column("conv_id").to_numpy()
            ends, sizes = batch.column("sizes").offsets.to_numpy(), batch.column("sizes").values.to_numpy()
            for i in range(batch.num_rows):
                key = keys[i].as_py()
                if block.full() and key != block.keys[-1]:
                    yield from ((k, r | {"block": part + number} if k == "form" else r) for k, r in block.close())
                    block, number = Block(), number + 1
                yield from (("piece", p) for p in block.row(key, int(convs[i]), sizes[ends[i] : ends[i + 1]]))
        if block.items:
            yield from ((k, r | {"block": part + number} if k == "form" else r) for k, r in block.close())

    yield from _tables(rows())


def _joined(final: bool):
    """Task function: lists of some blocks in a row to one list, or to complete nodes."""

    def of(table: pa.Table) -> pa.Table:
        forms = table.sort_by([("block", "ascending"), ("at", "ascending")]).to_pylist()
        group = forms[0].pop("group")
        keys = [f.pop("key") for f in forms]
        links = [0]
        for i in range(1, len(forms)):
            links.append(forms[i]["link"] if forms[i]["at"] else common_turns(keys[i - 1], keys[i]))
        forest = Forest(forms, links, final)
        if final:
            rows = [("node", r) for r in forest.finish()]
        else:
            rows = [("form", f | {"block": group}) for f in forest.contract(keys[0], keys[-1])]
            rows += [("node", r) for r in forest.rows]
        return pa.Table.from_batches(_tables(iter(rows), 1 << 30))

    return of


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in order of run and place -> the digest of each run."""
    run, sha = None, None
    for batch in batches:
        out = []
        for r, piece in zip(batch.column("run").to_pylist(), batch.column("piece"), strict=True):
            if r != run:
                if run is not None:
                    out.append((run, sha.hexdigest()))
                run, sha = r, hashlib.sha256()
            else:
                sha.update(b",")
            sha.update(piece.as_py().encode())
        yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], pa.string()) for k in (0, 1)], names=["run", "sha"])
    if run is not None:
        yield pa.RecordBatch.from_arrays([pa.array([run]), pa.array([sha.hexdigest()])], names=["run", "sha"])


def compressed(sequences: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Tables of complete nodes, one of each round, and the digests of runs that cross blocks."""
    with small_batches(sequences.sparkSession):
        made = stage(sequences.sort("key", "conv_id").mapInArrow(_local, OUT), "blocks")
    pieces = made.filter("piece is not null").select("piece.*")
    runs = stage(
        pieces.repartition("run").sortWithinPartitions("run", "first").select("run", "piece").mapInArrow(_digests, "run string, sha string"),
        "runs",
    )
    tables = [made.filter("node is not null").select("node.*")]
    while True:
        forms = made.filter("form is not null").select("form.*")
        blocks = forms.filter("at = 0").select("block")
        n = blocks.count()
        if not n:
            return tables, runs
        place = F.row_number().over(Window.orderBy("block")) - 1  # one row a block
        numbered = forms.join(blocks.select("block", F.floor(place / FAN).alias("group")), "block")
        made = stage(numbered.groupBy("group").applyInArrow(_joined(n <= FAN), OUT), "joined")
        tables.append(made.filter("node is not null").select("node.*"))


def nodes(sequences: DataFrame) -> DataFrame:
    """``conv_id, key, sizes`` -> one row per node of the trie, as in the query's contract."""
    tables, runs = compressed(sequences)
    found = tables[0]
    for t in tables[1:]:
        found = found.unionByName(t)
    partial = found.filter("key is not null").select(F.col("key").alias("parent_key"), F.col("conv_id").alias("__conv"))
    local = F.col("parent_key").isNull() & F.col("run").isNull()
    elsewhere = found.filter(~local).join(partial, "parent_key", "left").join(runs, "run", "left").withColumns(
        {"parent_conv_id": F.coalesce("parent_conv_id", "__conv"), "ends_sha256": F.coalesce("ends_sha256", "sha")}
    )
    whole = found.filter(local).unionByName(elsewhere.select(found.columns))
    spelled = whole.withColumn("d", F.explode(F.sequence(F.col("parent_depth") + 1, F.col("depth"))))
    own = F.col("d") == F.col("depth")
    before = F.get("chars", F.col("d") - F.col("parent_depth") - 1)
    return spelled.select(
        "conv_id",
        F.col("d").cast("long").alias("depth"),
        F.when(F.col("d") > F.col("parent_depth") + 1, F.col("conv_id")).otherwise(F.col("parent_conv_id")).alias("parent_conv_id"),
        "n_convs",
        F.when(own, F.col("n_children")).otherwise(1).cast("long").alias("n_children"),
        "n_leaves",
        (F.col("below") + (F.col("n_convs") - 1) * (F.element_at("chars", -1) - before)).alias("saved_tokens"),
        F.when(own, F.coalesce("ends_sha256", F.lit(EMPTY))).otherwise(EMPTY).alias("ends_sha256"),
    )
