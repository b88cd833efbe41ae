"""Merkle manifest of a table, and proofs climbed by a recursive query.

Every row is a leaf, the hash of its columns. Within a group (a language) the
leaves stand in order, and while there is more than one node, every ``fan``
consecutive ones are hashed into one; what remains is the group's subroot. The
subroots, in order of their groups, are hashed to the root in the same way.

A run is what is hashed into one node: up to ``fan`` digests. Every run is a
stored row that names its parent run and its place in that, so a proof is a
climb: a recursive query starts from every run of leaves and joins the parent
row, appends the siblings it finds there, and folds the hash of each of its
leaves with them. Leaves of one run have all siblings above it in common, which
travel once for the run; what every leaf folds is its own.

The climb has two parts. Low runs are joined by key: there are many, and each
has a small share of the climbers. The runs of the highest levels, which every
climber passes, are few (their stored rows are counted), so they are broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulwise.llm.common import shuffle_width
from haulwise.session import cut_lineage

DIGEST = 32  # bytes
TOP = 1000  # the first step of the tree over groups; steps within groups are fewer


def framed(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count of the value as text, a colon
    and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*values: Column) -> Column:
    """The SHA-256 of the values one after another, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*values).cast("binary"), 256))


def hex_text(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def _node(digests: Column) -> Column:
    """The hash of digests that follow each other in a binary value."""
    return digest(hex_text(digests))


def _before(digests: Column, place: Column) -> Column:
    return F.substring(digests, F.lit(1), place * DIGEST)


def _after(digests: Column, place: Column) -> Column:
    return F.substring(digests, place * DIGEST + DIGEST + 1, F.length(digests))


def _numbers(batches):
    """Adds the partition, and the row's number among those of its group (the
    first column, by which rows are sorted) in the partition."""
    part, group, seen = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        own, n = batch.column(0), batch.num_rows
        if not n:
            continue
        new = np.ones(n, bool)
        new[1:] = pc.not_equal(own[1:], own[:-1]).to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(new)
        at = np.arange(n) - starts[np.cumsum(new) - 1]
        if own[0].as_py() == group:
            at[:starts[1] if len(starts) > 1 else n] += seen
        group, seen = own[n - 1].as_py(), int(at[-1]) + 1
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(n, part, np.int32)), pa.array(at)], names=[*batch.schema.names, "_part", "_at"])


def numbered(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``place``, the row's number within its ``group`` (not
    null) in ``order``, from 0, and ``total``, the group's rows. A group may be
    spread over many tasks: rows are dealt by range, numbered in each, and a
    small table (a row for each group and range) says what comes before."""
    columns = [group, *(c for c in rows.columns if c != group)]
    dealt = (rows.select(columns).repartitionByRange(shuffle_width(rows), group, *order)
             .sortWithinPartitions(group, *order))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in dealt.schema.fields)
    dealt = cut_lineage(dealt.mapInArrow(_numbers, f"{schema}, _part int, _at long"), "merkle-dealt")
    upto = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = cut_lineage(
        dealt.groupBy(group, "_part").agg(F.count("*").alias("n"))
        .select(group, "_part", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("_ahead"),
                F.sum("n").over(Window.partitionBy(group)).alias("total")), "merkle-counts")
    return (dealt.join(counts, [group, "_part"])
            .select(*rows.columns, (F.col("_at") + F.col("_ahead")).alias("place"), "total"))


def _runs(nodes: DataFrame, fan: int, step: int, keep: Sequence[str] = ()) -> DataFrame:
    """``(step, tree, run, total, nodes, children, hash)``: every ``fan``
    consecutive nodes (tree, place, total, hash) as one run. ``nodes`` counts
    the tree's nodes, ``total`` its runs. A lone node is its tree's top and not
    hashed again. ``keep``: columns that come back with the hash in ``rows``,
    an array of structs in the nodes' order."""
    members = F.sort_array(F.collect_list(F.struct("place", "hash", *keep)))
    children = F.unhex(F.concat_ws("", F.transform("members", lambda m: F.hex(m.hash))))
    rows = [F.transform("members", lambda m: F.struct(*(m[k].alias(k) for k in ("hash", *keep)))).alias("rows")] if keep else []
    return (nodes.groupBy("tree", F.floor(F.col("place") / fan).alias("run"))
            .agg(members.alias("members"), F.first("total").alias("nodes"))
            .select(F.lit(step).alias("step"), "tree", "run", F.ceil(F.col("nodes") / fan).alias("total"), "nodes",
                    children.alias("children"), *rows)
            .withColumn("hash", F.when(F.col("nodes") == 1, F.col("children")).otherwise(_node(F.col("children")))))


def _above(level: DataFrame, fan: int, step: int) -> list[DataFrame]:
    """The runs above those of ``level``, a stored table for each step."""
    out = []
    while not (more := level.where("total > 1")).isEmpty():
        nodes = more.select("tree", F.col("run").alias("place"), "total", "hash")
        level = cut_lineage(_runs(nodes, fan, step + len(out)), f"merkle-step{step + len(out)}")
        out.append(level)
    return out


def _linked(runs: DataFrame, fan: int, subroots: DataFrame | None, groups: int) -> DataFrame:
    """``runs`` with the parent run (up_step, up_tree, up_run) and the place
    in it. A group's top is in a run of ``subroots`` (tree, place), unless it
    is the only one; the root has no parent."""
    run, step = F.col("run"), F.col("step")
    inner = runs.where("total > 1").withColumns({
        "up_step": step + 1, "up_tree": F.col("tree"), "up_run": F.floor(run / fan), "place": run % fan})
    tops = runs.where("total = 1")
    if subroots is None or groups == 1:
        none = F.lit(None).cast("long")
        return inner.unionByName(tops.withColumns({
            "up_step": F.lit(None).cast("int"), "up_tree": F.lit(""), "up_run": none, "place": none}))
    sub = subroots.select("tree", F.lit(TOP).alias("up_step"), F.lit("").alias("up_tree"),
                          F.floor(F.col("place") / fan).alias("up_run"), (F.col("place") % fan).alias("place"))
    return inner.unionByName(tops.join(sub, "tree"))


CLIMB = f"""
WITH RECURSIVE climb(tree, run, folds, proof, subroot, up_step, up_tree, up_run, place) MAX RECURSION LEVEL 200 AS (
  SELECT tree, run, folds, proof, subroot, up_step, up_tree, up_run, place FROM {{start}}
  UNION ALL
  SELECT {{hint}} c.tree, c.run,
         transform(c.folds, f -> unhex(sha2(cast(lower(hex(concat(
           substring(n.children, 1, {DIGEST} * c.place), f,
           substring(n.children, {DIGEST} * c.place + {DIGEST + 1})))) AS binary), 256))),
         concat(c.proof, substring(n.children, 1, {DIGEST} * c.place),
                substring(n.children, {DIGEST} * c.place + {DIGEST + 1})),
         CASE WHEN n.step = {TOP} THEN substring(n.children, {DIGEST} * c.place + 1, {DIGEST}) ELSE c.subroot END,
         n.up_step, n.up_tree, n.up_run, n.place
  FROM climb c JOIN {{nodes}} n ON c.up_step = n.step AND c.up_tree = n.tree AND c.up_run = n.run)
SELECT * FROM climb WHERE up_step IS NULL OR up_step >= {{until}} LIMIT ALL
"""


def _climb(start: DataFrame, nodes: DataFrame, until: int, hint: str = "") -> DataFrame:
    """The climbers when their parents are of step ``until`` or none."""
    query = CLIMB.replace("{hint}", hint).replace("{until}", str(until))
    return cut_lineage(start.sparkSession.sql(query, start=start, nodes=nodes), "merkle-climb")


def manifest(rows: DataFrame, *, id_column: str, group: str, leaf: Column, offered: Column, fan: int = 8,
             most_broadcast: int = 16_384) -> DataFrame:
    """``(id_column, leaf, subroot, root, siblings, folded_root)``, one row
    per row of ``rows``.

    ``leaf`` is a row's digest (32 bytes, see :func:`digest`), ``offered`` the
    digest that is put in its place when its proof is checked. Leaves of one
    ``group`` ascend by ``id_column``, null first; rows of equal id stand by
    leaf, equal rows in any order (which changes no hash). Groups ascend as
    UTF-8 bytes, null first; a null group is one of its own, the empty string
    another. ``siblings``: the digests of the proof, from the leaf's run to the
    root, left to right. ``folded_root``: what ``offered`` and the siblings
    hash to. An empty table has no rows. ``most_broadcast``: runs of the upper
    levels that may be broadcast, some 300 bytes each; the rows do not depend
    on it.
    """
    named = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("-"))  # null comes first
    stored = cut_lineage(rows.select(
        F.col(id_column).alias("id"), named.alias("tree"), leaf.alias("hash"), offered.alias("offered"),
        F.monotonically_increasing_id().alias("_row")), "merkle-leaves")
    placed = numbered(stored, "tree", ["id", "hash", "_row"])
    ground = cut_lineage(_runs(placed, fan, 0, ["id", "offered"]), "merkle-ground")
    within = _above(ground, fan, 1)
    tops = None
    for level in (ground, *within):
        own = level.where("total = 1").select("tree", "hash")
        tops = own if tops is None else tops.unionByName(own)
    subroots = cut_lineage(numbered(tops.withColumn("forest", F.lit("")), "forest", ["tree"]), "merkle-subroots")
    groups = subroots.count()
    over = []
    if groups > 1:
        first = cut_lineage(_runs(subroots.withColumn("tree", F.lit("")), fan, TOP), f"merkle-step{TOP}")
        over = [first, *_above(first, fan, TOP + 1)]
    top = (over[-1] if over else subroots).select("hash").head()  # one row of 32 bytes
    root = F.lit(bytes(top[0]) if top else None).cast("binary")

    # the highest steps, as many as may be broadcast together
    levels = [(_linked(x, fan, subroots, groups), 1 + k) for k, x in enumerate(within)]
    levels += [(_linked(x, fan, None, groups), TOP + k) for k, x in enumerate(over)]
    sizes = [x.count() for x in (*within, *over)]
    cut = len(levels)
    while cut and sum(sizes[cut - 1:]) <= most_broadcast:
        cut -= 1

    place = F.lit(0)
    alone = F.col("nodes") == 1
    folds = F.transform("rows", lambda m, k: F.when(alone, m.offered).otherwise(_node(F.concat(
        _before(F.col("children"), k), m.offered, _after(F.col("children"), k)))))
    climbers = _linked(ground, fan, subroots, groups).select(
        "tree", "run", folds.alias("folds"), F.lit(b"").alias("proof"), F.lit(None).cast("binary").alias("subroot"),
        "up_step", "up_tree", "up_run", "place")
    for part, hint, until in ((levels[:cut], "", levels[cut][1] if cut < len(levels) else TOP * 2),
                              (levels[cut:], "/*+ BROADCAST(n) */", TOP * 2)):
        if part:
            nodes = part[0][0]
            for x, _ in part[1:]:
                nodes = nodes.unionByName(x)
            climbers = _climb(climbers, cut_lineage(nodes, "merkle-nodes"), until, hint)
    whole = ground.select("tree", "run", "rows", "children").join(climbers, ["tree", "run"])
    each = whole.select("children", "folds", "proof", "subroot", F.posexplode("rows").alias("place", "own"))
    place = F.col("place")
    return each.select(
        F.col("own.id").alias(id_column), F.col("own.hash").alias("leaf"),
        F.coalesce("subroot", root).alias("subroot"), root.alias("root"),
        F.concat(_before(F.col("children"), place), _after(F.col("children"), place), "proof").alias("siblings"),
        F.get("folds", place).alias("folded_root"))


def document_leaf(text: Column) -> Column:
    return digest(*(framed(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")), framed(text))


def document_manifest(docs: DataFrame, tampered: Column, *, fan: int = 8, most_broadcast: int = 16_384) -> DataFrame:
    """``(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)``
    as lowercase hex, one row per row of ``docs`` (doc_id, source, lang,
    n_chars, text; further columns are ignored; see :func:`manifest`).

    Where ``tampered`` holds, the proof is checked against a text whose A-Z
    are lower-cased; null is no. A null text cannot be changed. A proof without
    siblings has the hash of nothing.
    """
    text = F.col("text")
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    leaf = document_leaf(text)
    rows = manifest(docs.select("doc_id", "source", "lang", "n_chars", "text"), id_column="doc_id", group="lang", leaf=leaf,
                    offered=F.when(tampered, document_leaf(lower)).otherwise(leaf), fan=fan, most_broadcast=most_broadcast)
    return rows.select("doc_id", *(hex_text(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")),
                       F.sha2(hex_text(F.col("siblings")).cast("binary"), 256).alias("proof_sha256"),
                       hex_text(F.col("folded_root")).alias("folded_root"),
                       (F.col("folded_root") == F.col("root")).alias("verified"))
