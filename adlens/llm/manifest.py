"""Merkle manifest of a dataset by nested-struct rollup.

Rows become leaves, numbered within their group in order of id. A leaf's number
in base ``arity`` gives its digit columns and, above them, a block of a bounded
number of leaves. Blocks are dealt out once; then the digit columns are grouped
away one after the other, lowest first, and each group of siblings becomes one
struct that nests them under the hash of their hashes. A block ends as one row
that holds its whole subtree. The blocks' hashes are the nodes of the next tier,
rolled up the same way, until a group has one block; the groups' own roots then
form the last tree.

Proofs come back down. A block's row meets its path to the root by one more
grouping on the block; nested transforms write each leaf's siblings beside it
and an explode emits the leaves. No join takes part, and no row holds more than
a block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.llm.common import drop, in_order, read, save
from adlens.llm.resampling import CRC_TABLE, crc_of

ARITY = 3
DIGITS = 5               # of a block: arity ** digits leaves in one row
TAMPER_EVERY = 2
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

PATH = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """``-`` of a null, else byte count, colon and value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaves(docs: DataFrame, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id",
           group_col: str = "source", text_col: str = "text",
           tamper_every: int = TAMPER_EVERY) -> DataFrame:
    """(g, doc_id, leaf, found): the group as text that sorts nulls first, the
    leaf, and the leaf of the row as it is found after tampering."""
    col = {c: F.col(f"`{c}`") for c in (*fields, id_col, group_col)}
    touched = F.pmod(F.crc32(col[id_col].cast("string")), F.lit(tamper_every)) == 0
    stripped = F.when(touched, F.replace(col[text_col], F.lit("\n"), F.lit(""))).otherwise(
        col[text_col])
    return docs.select(
        F.coalesce(F.concat(F.lit("="), col[group_col].cast("string")), F.lit("")).alias("g"),
        col[id_col].alias("doc_id"), digest(*[field(col[c]) for c in fields]).alias("leaf"),
        digest(*[field(stripped if c == text_col else col[c]) for c in fields]).alias("found"))


def _goes_on(level: int, arity: int) -> Column:
    """Whether several nodes of a group of n remain at a level of its tier."""
    return F.col("n") > arity ** level


def rollup(nodes: DataFrame, arity: int = ARITY, digits: int = DIGITS) -> DataFrame:
    """(g, n, block, hash, kids) of nodes (g, n, place, hash, item), ``n`` the
    number of nodes of g: each block's subtree as nested structs."""
    block = F.floor(F.col("place") / F.lit(arity ** digits)).cast("long")
    names = [f"d{j}" for j in range(digits)]
    place = [F.pmod(F.floor(F.col("place") / F.lit(arity ** j)), F.lit(arity)).cast("int").alias(c)
             for j, c in enumerate(names)]
    # dealt out by block once: each grouping below has (g, block) among its keys
    cur = nodes.select("g", "n", block.alias("block"), *place, "hash", F.col("item").alias(
        "kids")).repartition("g", "block")
    for j, name in enumerate(names):
        kin = cur.groupBy("g", "block", *names[j + 1:]).agg(
            F.max("n").alias("n"),
            F.sort_array(F.collect_list(F.struct(name, "hash", "kids"))).alias("kids"))
        hashes = F.array_join(F.transform("kids", lambda c: c["hash"]), "")
        cur = kin.withColumn("hash", F.when(_goes_on(j, arity), F.sha2(hashes, 256)).otherwise(
            F.element_at("kids", 1)["hash"]))
    return cur.select("g", "n", "block", "hash", "kids")


def _descend(kids: Column, path: Column, level: int, arity: int) -> Column:
    """The items under ``kids``, with their hash and path, as one array."""
    def joined(nodes: Column) -> Column:
        return F.array_join(F.transform(nodes, lambda x: x["hash"]), "")

    def under(c: Column, i: Column) -> Column:
        step = F.array(F.struct(joined(F.slice(kids, F.lit(1), i)).alias("left"),
                                joined(F.slice(kids, i + 2, F.size(kids))).alias("right")))
        own = F.when(_goes_on(level, arity), F.concat(step, path)).otherwise(path)
        if level:
            return _descend(c["kids"], own, level - 1, arity)
        return F.array(F.struct(c["kids"].alias("item"), c["hash"].alias("hash"),
                                own.alias("path")))

    return F.flatten(F.transform(kids, under))


def emit(blocks: DataFrame, above: DataFrame, arity: int = ARITY,
         digits: int = DIGITS) -> DataFrame:
    """(g, item, hash, path, subroot) of the nodes of ``blocks``; ``above`` holds
    each block's own path and its group's root (g, block, path, subroot)."""
    met = blocks.select("g", "block", "n", "kids").unionByName(
        above.select("g", "block", "path", "subroot"), allowMissingColumns=True).groupBy(
        "g", "block").agg(*[F.first(c, ignorenulls=True).alias(c)
                            for c in ("n", "kids", "path", "subroot")])
    return met.select("g", "subroot", F.explode(
        _descend(F.col("kids"), F.col("path"), digits - 1, arity)).alias("x")).select(
        "g", "x.item", "x.hash", "x.path", "subroot")


def tiers(nodes: DataFrame, arity: int, digits: int) -> list[DataFrame]:
    """Written blocks of each tier, lowest first; the last has one a group."""
    out = [save(rollup(nodes, arity, digits), "blocks")]
    while out[-1].where("block > 0").limit(1).count():
        up = out[-1].select(
            "g", F.ceil(F.col("n") / F.lit(arity ** digits)).cast("long").alias("n"),
            F.col("block").alias("place"), "hash", F.col("block").alias("item"))
        out.append(save(rollup(up, arity, digits), "blocks"))
    return out


def paths(below: list[DataFrame], top: DataFrame, arity: int, digits: int) -> DataFrame:
    """(g, item, hash, path, subroot) of the lowest nodes; ``top`` holds the path
    and root of each group's last block (g, block, path, subroot)."""
    for blocks in reversed(below[1:]):
        top = save(emit(blocks, top, arity, digits).select(
            "g", F.col("item").alias("block"), "path", "subroot"), "paths")
    return emit(below[0], top, arity, digits)


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id",
             group_col: str = "source", text_col: str = "text", arity: int = ARITY,
             digits: int = DIGITS, tamper_every: int = TAMPER_EVERY) -> DataFrame:
    """(id, leaf, subroot, root, path, folded_root, verified) for every row.

    ``path``: the left and right siblings of each level, lowest first, joined;
    none of a lone leaf of a lone group. ``folded_root`` folds the leaf of the
    row as found over its path. Nulls in any column have a form of their own; a
    null id comes first in its group, is never tampered with, and a null group is
    one. Rows repeated with one id are leaves of their own, ordered by their hash;
    equal rows stand in any order. An empty table gives no rows and has no root.
    Other columns are not looked at. Texts are hashed whole.
    """
    rows = save(leaves(docs, fields, id_col, group_col, text_col, tamper_every).withColumn(
        "tie", F.monotonically_increasing_id()), "leaves")
    placed = in_order(rows, [F.asc_nulls_first("doc_id"), F.asc("leaf"), F.asc("tie")], "g")
    sizes = rows.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    # the number of leaves only, beside each leaf of its group
    nodes = placed.join(sizes, "g").select(
        "g", "n", "place", F.col("leaf").alias("hash"), F.struct("doc_id", "found").alias("item"))
    of_rows = tiers(nodes, arity, digits)
    groups = save(of_rows[-1].where("block = 0").select("g", "hash"), "subroots")
    # the last tree: one group, whose nodes are the groups in their order
    ordered = in_order(groups, [F.asc("g")])
    n = groups.count()
    of_groups = tiers(ordered.select(
        F.lit("").alias("g"), F.lit(n).cast("long").alias("n"), "place", "hash",
        F.col("g").alias("item")), arity, digits)
    first = of_groups[-1].select("hash").first()
    root = first["hash"] if first else None
    start = of_groups[-1].select("g", "block", F.array().cast(PATH).alias("path"),
                                 F.lit(root).alias("subroot"))
    top = save(paths(of_groups, start, arity, digits).select(
        F.col("item").alias("g"), F.lit(0).cast("long").alias("block"), "path",
        F.col("hash").alias("subroot")), "paths")
    got = paths(of_rows, top, arity, digits)
    folded = F.aggregate("path", F.col("item.found"), lambda cur, s: F.sha2(
        F.concat(s["left"], cur, s["right"]), 256))
    out = got.select(F.col("item.doc_id").alias(id_col), F.col("hash").alias("leaf"), "subroot",
                     F.lit(root).alias("root"), "path", folded.alias("folded_root"))
    for t in (rows, groups):
        drop(t)
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of all ``documents``, its paths as one checksum a row."""
    got = manifest(read(spark, sf_dir, "documents"))
    proof = F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), "")
    return got.select("doc_id", "leaf", "subroot", "root", F.sha2(proof, 256).alias("proof_sha256"),
                      "folded_root", "verified")


SQL_LEVELS = 16          # 3 ** 16 leaves a source


def _tree_sql(name: str, nodes: str, levels: int) -> str:
    """CTEs {name}_0 .. {name}_levels: (g, p, h), the nodes of each level; and
    {name}_s0 ..: (g, p, l, r, several), the siblings of each, if several remain."""
    def beside(rows: str) -> str:
        return (f"coalesce(string_agg(h, '') OVER (PARTITION BY g, p // 3 ORDER BY p "
                f"ROWS BETWEEN {rows}), '')")

    several = "count(*) OVER (PARTITION BY g) > 1 AS several"
    out = [f"{name}_0 AS (SELECT g, p, h FROM {nodes})"]
    for j in range(levels):
        out.append(f"{name}_{j + 1} AS (SELECT g, p // 3 AS p, CASE WHEN any_value(several) THEN "
                   f"sha256(string_agg(h, '' ORDER BY p)) ELSE any_value(h) END AS h "
                   f"FROM (SELECT *, {several} FROM {name}_{j}) GROUP BY g, p // 3)")
        out.append(f"{name}_s{j} AS (SELECT g, p, {beside('2 PRECEDING AND 1 PRECEDING')} AS l, "
                   f"{beside('1 FOLLOWING AND 2 FOLLOWING')} AS r, {several} FROM {name}_{j})")
    return ",\n".join(out)


def _fold_sql(name: str, tree: str, rows: str, levels: int) -> str:
    """CTEs {name}_0 ..: (doc, g, q, cur, proof) folded level by level."""
    out = [f"{name}_0 AS ({rows})"]
    for j in range(levels):
        out.append(f"{name}_{j + 1} AS (SELECT doc, f.g, f.q // 3 AS q, CASE WHEN several THEN "
                   f"sha256(l || cur || r) ELSE cur END AS cur, CASE WHEN several THEN "
                   f"proof || l || r ELSE proof END AS proof, gs FROM {name}_{j} f JOIN {tree}_s{j} s "
                   f"ON f.g = s.g AND f.q = s.p)")
    return ",\n".join(out)


def _field_sql(c: str) -> str:
    return (f"coalesce(octet_length(encode(CAST({c} AS VARCHAR))) || ':' || "
            f"CAST({c} AS VARCHAR), '-')")


_LEAF_SQL = " || ".join(map(_field_sql, FIELDS))
_FOUND_SQL = " || ".join(_field_sql("found" if c == "text" else c) for c in FIELDS)

OP13_SQL = f"""
WITH {CRC_TABLE.strip()},
base AS (
  SELECT *, coalesce('=' || source, '') AS g, CASE WHEN {crc_of('CAST(doc_id AS VARCHAR)')} % 2 = 0
         THEN replace(text, chr(10), '') ELSE text END AS found
  FROM documents, crc_table),
leaf AS (
  SELECT doc_id AS doc, g, row_number() OVER (PARTITION BY g ORDER BY doc_id) - 1 AS p,
         sha256({_LEAF_SQL}) AS h, sha256({_FOUND_SQL}) AS f
  FROM base),
{_tree_sql('a', 'leaf', SQL_LEVELS)},
subroots AS (
  SELECT '' AS g, row_number() OVER (ORDER BY encode(g)) - 1 AS p, h, g AS gs FROM a_{SQL_LEVELS}),
{_tree_sql('b', 'subroots', SQL_LEVELS)},
{_fold_sql('u', 'a', "SELECT doc, g, p AS q, f AS cur, '' AS proof, g AS gs FROM leaf", SQL_LEVELS)},
{_fold_sql('v', 'b', f"SELECT doc, '' AS g, s.p AS q, cur, proof, u.gs FROM u_{SQL_LEVELS} u JOIN subroots s USING (gs)", SQL_LEVELS)}
SELECT leaf.doc AS doc_id, leaf.h AS leaf, subroots.h AS subroot, b_{SQL_LEVELS}.h AS root,
       sha256(v.proof) AS proof_sha256, v.cur AS folded_root, v.cur = b_{SQL_LEVELS}.h AS verified
FROM leaf JOIN v_{SQL_LEVELS} v ON v.doc = leaf.doc JOIN subroots ON subroots.gs = leaf.g
     CROSS JOIN b_{SQL_LEVELS}
"""
