"""Merkle manifest of a dataset as a postorder append log, with inclusion proofs.

A tree per source over its documents' leaves in order of doc_id, ``ARITY`` children a node, and
one tree over the sources' roots (``subroot``) gives the dataset's ``root``. While several nodes
remain, every ``ARITY`` consecutive ones (the last run may be shorter, even a single one) become
the hash of their digests; digests are lower-case hex text throughout.

* ``ranked`` numbers the rows of each source without gathering a source in one task: rows are
  range-partitioned by (source, doc_id, leaf), written, numbered within their partition, and
  moved by the counts of the partitions before.
* ``log``: aligned builders take ``BLOCK`` consecutive nodes, a whole subtree of ``LEVELS`` levels,
  and append every node when it is complete. So a node's place in its tree's log is its place in
  postorder, which ``position`` gives in closed form from the sizes of the subtrees before it; a
  subtree stands in one stretch that ends with its root. Rounds of ``LEVELS`` levels go on until
  every tree has its root: the logarithm of the largest source.
* ``proven`` addresses siblings by position: a block reads its own stretch of the log, and for the
  levels above it looks up the positions of the siblings of its root.

A document's proof is the siblings of the nodes on its way to the root, level by level and left to
right. ``folded_root`` is recomputed from the given leaf and that proof alone.

Documents of one source with equal ids are ordered by leaf; null ids come first, a null source is
a source of its own before all others. Repeated rows are leaves of their own and get a row each.
Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lastmile.llm.store import written

ARITY = 16
LEVELS = 3
BLOCK = ARITY**LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TOP = -1  # the tree over the sources


def digest(*parts: str) -> str:
    h = hashlib.sha256()
    for p in parts:
        h.update(p.encode())
    return h.hexdigest()


def leaf(fields: dict[str, Column]) -> Column:
    """Hash of a row: each value with its UTF-8 length, a null as ``-``."""
    def part(c: Column) -> Column:
        s = c.cast("string")
        return F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))

    return F.sha2(F.concat(*[part(c) for c in fields.values()]).cast("binary"), 256)


def tampered(doc_id: Column, fields: dict[str, Column]) -> Column:
    """The leaf after A-Z of the text were lower-cased in every document whose id's CRC-32 is
    divisible by 5 (a null id is left as it is); null for the others."""
    chosen = F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0
    return F.when(chosen, leaf({**fields, "text": F.translate(fields["text"], _UPPER, _LOWER)}))


def height(n: int) -> int:
    """Levels above ``n`` leaves."""
    h = 0
    while n > 1:
        n, h = -(-n // ARITY), h + 1
    return h


def position(level: int, index: int, n: int) -> int:
    """Place from 0 of node ``index`` of ``level`` in the postorder of a tree of ``n`` leaves.

    Before it stand the nodes that end no later than its last leaf, up to its own level, and those
    above its level that end before that leaf.
    """
    end = min((index + 1) * ARITY**level, n)
    below = sum(-(-end // ARITY**m) for m in range(level + 1))
    above = sum((end - 1) // ARITY**m for m in range(level + 1, height(n) + 1))
    return below + above - 1


def ranked(df: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``df`` with ``i``, the row's place from 0 in its group by ``order``, and the group's size ``n``.

    No task holds a group: rows are range-partitioned with their row number as the last key, so
    even equal rows part. Groups must not be null.
    """
    rows = df.withColumn("_row", F.monotonically_increasing_id())
    keys = [group, *order, "_row"]
    cut = written(
        rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
        .withColumns({"_row": F.monotonically_increasing_id(), "_part": F.spark_partition_id()}),
        "ranked",
    )
    parts = cut.groupBy(group, "_part").agg(F.count(F.lit(1)).alias("_count"), F.min("_row").alias("_first"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumns(
        {
            "_before": F.coalesce(F.sum("_count").over(before), F.lit(0)),
            "n": F.sum("_count").over(Window.partitionBy(group)),
        }
    )
    return cut.join(parts, [group, "_part"]).select(
        *df.columns, (F.col("_row") - F.col("_first") + F.col("_before")).alias("i"), "n"
    )


_NODES = "tree bigint, n bigint, level int, i bigint, position bigint, digest string"


def _append(rows: Iterator, base: int) -> Iterator[tuple]:
    """The log entries of one block's subtree, in completion order; ``rows`` are nodes of level ``base``."""
    pending: list[list[str]] = [[] for _ in range(LEVELS + 1)]
    made = [0] * (LEVELS + 1)
    top = None

    def put(level: int, value: str) -> Iterator[tuple]:
        i = first // ARITY**level + made[level]
        made[level] += 1
        yield tree, n, base + level, i, position(base + level, i, n), value
        pending[level].append(value)
        if level < top and len(pending[level]) == ARITY:
            yield from close(level)

    def close(level: int) -> Iterator[tuple]:
        run, pending[level] = pending[level], []
        yield from put(level + 1, digest(*run))

    for tree, n, i, value in rows:
        if top is None:
            first, top = i, min(LEVELS, height(n) - base)
        yield from put(0, value)
    for level in range(top):
        if pending[level]:
            yield from close(level)


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == 8192:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _tuples(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, batch.num_rows, 8192):
            yield from zip(*[c.to_pylist() for c in batch.slice(at, 8192).columns])


def log(leaves: DataFrame) -> DataFrame:
    """The append log (tree, n, level, i, position, digest) of trees given as (tree, n, i, digest)."""
    schema = T.StructType.fromDDL(_NODES)
    arrow = to_arrow_schema(schema)
    largest = leaves.agg(F.max("n")).first()[0] or 0
    nodes, out, base = leaves.select("tree", "n", "i", "digest"), [], 0
    while True:
        def build(batches: Iterator[pa.RecordBatch], base: int = base) -> Iterator[pa.RecordBatch]:
            def entries() -> Iterator[tuple]:
                for _, rows in groupby(_tuples(batches), key=lambda r: (r[0], r[2] // BLOCK)):
                    yield from _append(rows, base)

            yield from _batches(entries(), arrow)

        done = written(
            nodes.repartition("tree", F.floor(F.col("i") / BLOCK)).sortWithinPartitions("tree", "i").mapInArrow(build, schema),
            "postorder-log",
        )
        # A block's root is the first node of the next round, which writes it only there.
        top = done.filter(F.col("level") == base + LEVELS)
        base += LEVELS
        if height(largest) <= base:
            out.append(done)
            break
        rest = F.col("n") > ARITY**base
        out.append(done.filter((F.col("level") < base) | ~rest))
        nodes = top.filter(rest).select("tree", "n", "i", "digest")
    whole = out[0]
    for more in out[1:]:
        whole = whole.unionByName(more)
    return whole


def _way(level: int, index: int, n: int) -> list[list[int]]:
    """Per level from ``level`` up to the root: the place of the node in its run, and the log
    positions of the nodes of that run."""
    steps = []
    for above in range(level, height(n)):
        first = index - index % ARITY
        count = -(-n // ARITY**above)
        steps.append([index - first, *[position(above, j, n) for j in range(first, min(first + ARITY, count))]])
        index //= ARITY
    return steps


def _wanted(blocks: DataFrame, level: Column, index: Column) -> DataFrame:
    """Positions of the runs above a node: (tree, block, step, slot, own, wanted, position)."""
    way = F.udf(_way, "array<array<bigint>>", useArrow=False)
    steps = blocks.select("*", F.posexplode(way(level, index, F.col("n"))).alias("step", "run"))
    return steps.select(
        *blocks.columns, "step", F.element_at("run", 1).alias("own"),
        F.posexplode(F.slice("run", 2, ARITY)).alias("slot", "position"),
    )


def proven(leaves: DataFrame, sources: DataFrame, passed: list[str]) -> DataFrame:
    """Every leaf with its subroot, root, proof hash, folded root and verdict.

    ``leaves``: (tree, n, i, digest, changed, passed columns); ``sources``: (tree, n, i, digest) of
    the top tree, with the sources' tree numbers in ``member``.
    """
    tree_log = log(leaves)
    is_root = (F.col("n") <= F.pow(F.lit(ARITY), "level")) & ((F.col("level") == 0) | (F.col("n") > F.pow(F.lit(ARITY), F.col("level") - 1)))
    roots = tree_log.filter(is_root).select(F.col("tree").alias("member"), "digest")
    top = sources.join(roots, "member").select(F.lit(_TOP).cast("bigint").alias("tree"), "n", "i", "digest", "member")
    top = written(top, "subroots")
    top_log = log(top)
    both = tree_log.unionByName(top_log)

    blocks = leaves.filter(F.col("i") % BLOCK == 0).select("tree", "n", F.floor(F.col("i") / BLOCK).alias("block"))
    inner = _wanted(blocks.filter(F.col("n") > BLOCK), F.lit(LEVELS), F.col("block")).select(
        "tree", "block", F.col("step"), "slot", "own", F.col("tree").alias("at"), "position"
    )
    above = _wanted(top.select("tree", "n", "i", "member"), F.lit(0), F.col("i")).select(
        F.col("member").alias("m"), (F.col("step") + 64).alias("step"), "slot", "own", F.col("tree").alias("at"), "position"
    )
    outer = blocks.join(above, blocks["tree"] == above["m"]).select("tree", "block", "step", "slot", "own", "at", "position")
    siblings = inner.unionByName(outer).join(
        both.select(F.col("tree").alias("at"), "position", "digest"), ["at", "position"]
    )
    null = lambda t: F.lit(None).cast(t)
    columns = ["tree", "block", "kind", "a", "b", "n", "own", "digest", "changed"]
    nothing = {p: null(leaves.schema[p].dataType) for p in passed}

    def part(df: DataFrame, **values: Column) -> DataFrame:
        return df.select(*[values.get(c, F.col(c)).alias(c) for c in [*columns, *passed]])

    block = F.floor(F.col("i") / BLOCK)
    runs = part(siblings, kind=F.lit(0), a=F.col("step").cast("bigint"), b=F.col("slot").cast("bigint"),
                n=null("bigint"), own=F.col("own"), changed=null("string"), **nothing)
    entries = part(
        tree_log.filter(F.col("level") <= LEVELS),
        block=F.floor(F.col("i") * F.pow(F.lit(ARITY), F.col("level")).cast("bigint") / BLOCK),
        kind=F.lit(1), a=F.col("position"), b=F.lit(0).cast("bigint"), own=null("bigint"), changed=null("string"), **nothing,
    )
    docs = part(leaves, block=block, kind=F.lit(2), a=F.col("i"), b=F.lit(0).cast("bigint"), own=null("bigint"))
    schema = T.StructType(
        [leaves.schema[p] for p in passed]
        + T.StructType.fromDDL(
            "leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
        ).fields
    )
    arrow = to_arrow_schema(schema)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def results() -> Iterator[tuple]:
            for _, rows in groupby(_tuples(batches), key=lambda r: r[:2]):
                yield from _proofs(rows)

        yield from _batches(results(), arrow)

    return (
        runs.unionByName(entries).unionByName(docs)
        .repartition("tree", "block").sortWithinPartitions("tree", "block", "kind", "a", "b")
        .mapInArrow(extract, schema)
    )


def _proofs(rows: Iterator[tuple]) -> Iterator[tuple]:
    """The results of one block: rows of the runs above it, then its log, then its documents."""
    upper: dict[int, tuple[int, list[str]]] = {}
    stretch: list[str] = []
    start, runs = None, {}
    for _, _, kind, a, _, n, own, value, changed, *passed in rows:
        if kind == 0:
            upper.setdefault(a, (own, []))[1].append(value)
            continue
        if kind == 1:
            start = a if start is None else start
            stretch.append(value)
            continue
        if not runs:
            path = [(own, "".join(run)) for _, (own, run) in sorted(upper.items())]
            inside = [(own, run) for step, (own, run) in sorted(upper.items()) if step < 64]
            levels = min(LEVELS, height(n))
        steps, index = [], a
        for level in range(levels):
            first = index - index % ARITY
            run = runs.get((level, first))
            if run is None:
                last = min(first + ARITY, -(-n // ARITY**level))
                run = runs[level, first] = "".join(stretch[position(level, j, n) - start] for j in range(first, last))
            steps.append((index - first, run))
            index //= ARITY
        proof, folded, subroot, root = hashlib.sha256(), changed or value, value, value
        for k, (own, run) in enumerate([*steps, *path]):
            left, right = run[: 64 * own], run[64 * own + 64 :]
            proof.update((left + right).encode())
            folded = digest(left, folded, right)
            root = digest(run)
            if k < levels + len(inside):
                subroot = root
        yield *passed, value, subroot, root, proof.hexdigest(), folded, folded == root
        runs.setdefault((None, None), "")


def manifest(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    ``leaf`` to ``proof_sha256`` are of the documents as they are; ``folded_root`` starts at the
    leaf of the tampered document where ``tampered`` chooses it, and ``verified`` says whether it
    equals the root.
    """
    fields = {name: F.col(name) for name in FIELDS}
    # A null source sorts before all others and differs from an empty one.
    source = F.coalesce(F.concat(F.lit("+"), F.col("source")), F.lit("")).alias("source_key")
    hashed = written(
        docs.select(source, "doc_id", leaf(fields).alias("digest"), tampered(F.col("doc_id"), fields).alias("changed")),
        "leaves",
    )
    numbered = written(ranked(hashed, "source_key", ["doc_id", "digest"]), "numbered")
    sources = ranked(numbered.select("source_key", F.lit(0).alias("all")).distinct(), "all", ["source_key"])
    sources = written(sources.select("source_key", "n", "i", F.col("i").alias("member")), "sources")
    leaves = written(
        numbered.join(sources.select("source_key", F.col("member").alias("tree")), "source_key").select(
            "tree", "n", "i", "digest", "changed", "doc_id"
        ),
        "tree-leaves",
    )
    return proven(leaves, sources, ["doc_id"])
