"""A Merkle manifest of a dataset: digests of rows, of runs of rows, of groups and of the whole, with a proof for each row.

Rows of a group ascend by id. While a group has several nodes, each run of ``FAN`` consecutive ones (the last may be
shorter) becomes the digest of their digests. The groups' roots, in order of the group, go on in the same way.

Nodes are numbered densely in their group, so level ``k`` needs no table of its own: the row whose number is divisible by
``FAN ** k`` carries the digest of the level-``k`` node that starts with it. Its siblings are at a fixed distance, a lag or
lead of ``FAN ** k`` times one to seven rows, masked by the slot in the run and by the run's length, and the row of the
first child hashes the parent. ``LEVELS`` levels are worked out inside blocks of ``FAN ** LEVELS`` rows, each block a window
partition, whatever share of the rows a group has; the block digests are the rows of the next, much smaller table.
A proof is a row's siblings (those on its left, those on its right) for each level up to the root.

Edge cases: a null field is ``-``, so it differs from an empty one; a null group is the first group; rows with equal ids
are ordered by their digest; rows without an id come first and are not tampered with in the query; an empty table has no
rows in its manifest; columns of other names play no part.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastegraph.plans.durable import durable
from tastegraph.plans.numbering import dense_numbers

FAN = 8
LEVELS = 4
BLOCK = FAN**LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    plain = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(plain).cast("string"), F.lit(":"), plain), F.lit("-"))


def leaf(*values: Column) -> Column:
    return digest(*[field(v) for v in values])


def tampered(text: Column) -> Column:
    """The text with A-Z in lower case."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def group_key(group: Column) -> Column:
    """Text that orders groups bytewise, null first, and is never null."""
    return F.coalesce(F.concat(F.lit("+"), group.cast("string")), F.lit(""))


def climbed(nodes: DataFrame) -> DataFrame:
    """Rows ``(group, place, total, node, ...)`` and ``block``, ``path`` and ``top``.

    ``path`` has ``(left, right)``, the joined digests of a node's siblings, for each level of the block that exists;
    ``top`` is the digest of the block.
    """
    columns = nodes.columns
    rows = nodes.selectExpr("*", f"place div {BLOCK} as block", "node as _d0")
    # a node of level k covers the rows with the same _run{k}; the widest come first, so one order serves all windows
    runs = [f"_run{k}" for k in range(LEVELS - 1, 0, -1)]
    rows = rows.selectExpr("*", *[f"place div {FAN ** int(c[4:])} as {c}" for c in runs])

    def over(parts: int) -> str:
        inside, order = ["`group`", "block", *runs[:parts]], [*runs[parts:], "place"]
        return f"over (partition by {', '.join(inside)} order by {', '.join(order)})"

    # as SQL text: it is parsed at once, where a few hundred single column calls take seconds
    for k in range(LEVELS):
        step = FAN**k
        count = f"((total + {step - 1}) div {step})"
        rows = rows.selectExpr(
            "*", f"place div {step} % {FAN} as _slot", f"{count} > 1 as _exists",
            f"least({FAN}, {count} - (place div {step} - place div {step} % {FAN})) as _length",
        )
        left = [f"if(_slot >= {i}, lag(_d{k}, {i * step}) {over(0)}, '')" for i in range(FAN - 1, 0, -1)]
        right = [f"if(_slot + {i} < _length, lead(_d{k}, {i * step}) {over(0)}, '')" for i in range(1, FAN)]
        both = f"struct(concat({', '.join(left)}) as left, concat({', '.join(right)}) as right)"
        rows = rows.selectExpr("*", f"if(_exists and place % {step} = 0, {both}, null) as _s{k}")
        parent = f"if(_exists, sha2(concat(_d{k}, _s{k}.right), 256), _d{k})"
        rows = rows.selectExpr("*", f"if(place % {step * FAN} = 0, {parent}, null) as _d{k + 1}").drop("_slot", "_exists", "_length")
    # what the first row of a node knows holds for all its rows
    path = ["_s0", *[f"first(_s{k}) {over(LEVELS - k)}" for k in range(1, LEVELS)]]
    return rows.selectExpr(*[f"`{c}`" for c in columns], "block", f"array_compact(array({', '.join(path)})) as path", f"first(_d{LEVELS}) {over(0)} as top")


def tops(nodes: DataFrame) -> DataFrame:
    """The blocks of a table of nodes as the nodes of the next one."""
    first = climbed(nodes).where(F.col("place") % BLOCK == 0)
    return first.select("group", F.col("block").alias("place"), F.ceil(F.col("total") / BLOCK).alias("total"), F.col("top").alias("node"))


def chain(nodes: DataFrame) -> list[DataFrame]:
    """The table and the ever smaller tables of its blocks, the last with one node for each group."""
    tables = [nodes]
    while (tables[-1].agg(F.max("total")).first()[0] or 0) > 1:
        tables.append(durable(tops(tables[-1])))
    return tables


def manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, doc_id: str = "doc_id", group: str = "lang") -> DataFrame:
    """``(doc_id, leaf, subroot, root, path)`` of each row; ``group`` is the part of the dataset with a root of its own."""
    values = [docs[c] for c in fields]
    return proofs(docs.select(docs[doc_id].alias("doc_id"), group_key(docs[group]).alias("group"), leaf(*values).alias("leaf")))


def proofs(leaves: DataFrame) -> DataFrame:
    """``(doc_id, group, leaf, ...)`` and ``subroot``, ``root``, ``path`` of each leaf."""
    extra = [c for c in leaves.columns if c != "group"]
    numbered = dense_numbers(leaves, ["doc_id", "leaf"], ["group"], "place", "total")
    tables = chain(durable(numbered.withColumn("node", F.col("leaf"))))
    roots = dense_numbers(tables[-1].select(F.col("group").alias("name"), "node"), ["name"], (), "place", "total")
    roots = chain(durable(roots.select("name", F.lit("").alias("group"), "place", "total", "node")))
    none = F.array().cast("array<struct<left:string,right:string>>")
    # downwards: every node's path is its own inside the block and then that of the block
    above = roots[-1].select("group", "place", F.col("node").alias("root"), none.alias("path"))
    for table in reversed(roots[:-1]):
        above = _below(table, above, ["root"])
    # from positions among the groups to the groups themselves
    named = roots[0].select("name", "place", F.col("node").alias("subroot")).join(above.select("place", "root", "path"), "place")
    above = named.select(F.col("name").alias("group"), F.lit(0).cast("long").alias("place"), "subroot", "root", "path")
    if len(tables) == 1:
        above = tables[0].drop("place").join(above.drop("place"), "group")
    for table in reversed(tables[:-1]):
        above = _below(table, above, ["subroot", "root"])
    return above.select(*extra, "subroot", "root", "path")


def _below(table: DataFrame, above: DataFrame, columns: list[str]) -> DataFrame:
    """The rows of a table with the path of their block added to theirs."""
    upper = above.select("group", F.col("place").alias("block"), F.col("path").alias("_upper"), *columns)
    rows = climbed(table).join(upper, ["group", "block"])
    return rows.select(*table.columns, *columns, F.concat("path", "_upper").alias("path"))


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf's digest and a proof lead to."""
    return F.aggregate(path, start, lambda own, s: digest(s["left"], own, s["right"]))


def proof_digest(path: Column) -> Column:
    """The digest of all siblings, level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""))
