"""A Merkle manifest of a table: a tree of digests for each group of rows, and one tree over the groups' roots.

Rows get row_number indices in their group, from a range sort with an offset for each partition, so that no task numbers a
whole group. Every `fanout` consecutive nodes of a level, gathered into a sorted array, are hashed into their parent, level
by level, until each group has one node. A level is one written table of runs, an eighth of the level below it.

Proofs come from one join for each level, from the top down: a run's children get their parent's siblings and add their own.
So a node's list of siblings is made once for all leaves below it, and the joins of all levels together handle a seventh
more rows than there are leaves, not as many for every level.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

FANOUT = 8
_PATH = "array<struct<before:string,after:string>>"


def encoded(c: Column) -> Column:
    """A value as `-` if null, else its UTF-8 bytes' number, a colon and the value as text."""
    text = c.cast("string")
    return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the concatenated parts."""
    return F.sha2(F.concat(*parts), 256)


def leaf_digest(*fields: Column) -> Column:
    return digest(*[encoded(c) for c in fields])


def group_key(c: Column) -> Column:
    """A group's name as a string that is never null and sorts null first, then by UTF-8 bytes."""
    return F.when(c.isNull(), F.lit("")).otherwise(F.concat(F.lit("+"), c.cast("string")))


def _numbered(rows: DataFrame, order: list[str]) -> tuple[DataFrame, int]:
    """rows (with a column `group`) with `index`, from 0 in the group's order, and `size`, the group's rows; and the largest
    size. Rows equal in group and order are interchangeable: a row number tells them apart, so that they too are split."""
    spread = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange("group", *order, "_tie")
    placed = stored(spread.withColumn("_part", F.spark_partition_id()), "placed")
    parts = placed.groupBy("group", "_part").agg(F.count(F.lit(1)).alias("_rows"))
    whole = Window.partitionBy("group")
    before = F.sum("_rows").over(whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    parts = stored(parts.withColumn("_base", F.coalesce(before, F.lit(0))).withColumn("size", F.sum("_rows").over(whole)).drop("_rows"), "parts")
    nth = F.row_number().over(Window.partitionBy("group", "_part").orderBy(*order, "_tie"))
    numbered = placed.join(parts, ["group", "_part"]).withColumn("index", F.col("_base") + nth - 1).drop("_part", "_base", "_tie")
    return numbered, parts.agg(F.max("size")).first()[0] or 0


def _levels(nodes: DataFrame, most: int, carried: list[str], fanout: int) -> tuple[list[DataFrame], DataFrame]:
    """The written levels of runs (group, run, children, size), leaves first, and the groups' roots (group, digest).

    nodes: group, index, size, digest and carried columns. A group of one node passes through all levels as it is."""
    levels = []
    while True:
        child = F.struct("index", "digest", *(carried if not levels else []))
        runs = nodes.groupBy("group", F.expr(f"index div {fanout}").alias("run")).agg(F.array_sort(F.collect_list(child)).alias("children"), F.first("size").alias("size"))
        levels.append(stored(runs, "runs"))
        joined = F.array_join("children.digest", "")
        up = F.when(F.col("size") == 1, joined).otherwise(F.sha2(joined, 256))
        nodes = levels[-1].select("group", F.col("run").alias("index"), F.ceil(F.col("size") / fanout).alias("size"), up.alias("digest"))
        most = -(-most // fanout)
        if most <= 1:
            return levels, nodes.select("group", "digest")


def _with_siblings(child: Column, at: Column) -> Column:
    before = F.array_join(F.slice("children.digest", F.lit(1), at), "")
    after = F.array_join(F.slice("children.digest", at + 2, F.size("children")), "")
    return F.struct(child.alias("node"), before.alias("before"), after.alias("after"))


def _proofs(levels: list[DataFrame], tops: DataFrame, kept: list[str]) -> DataFrame:
    """(group, digest, path, kept, carried) of every leaf. tops: group, path, kept columns for each group's root."""
    paths = tops.withColumn("run", F.lit(0).cast("long"))
    for runs in reversed(levels):
        below = runs.join(paths, ["group", "run"]).select("group", "size", "path", *kept, F.explode(F.transform("children", _with_siblings)).alias("c"))
        own = F.when(F.col("size") > 1, F.array(F.struct("c.before", "c.after"))).otherwise(F.array().cast(_PATH))
        paths = below.select("group", F.col("c.node.index").alias("run"), F.concat(own, "path").alias("path"), *kept, "c.node.*").drop("index")
        if runs is not levels[0]:
            paths = paths.drop("digest")
    return paths.drop("run")


def manifest(rows: DataFrame, group: str, order: list[str], leaf: str = "leaf", fanout: int = FANOUT) -> DataFrame:
    """rows with subroot, root and path: the digests that lead from a row's leaf to the table's root.

    path has one (before, after) for each level from the leaf up, the concatenated digests of the siblings on the left and on
    the right; both are empty where a run has one node. A group's leaves are ordered by `order`, then by leaf (nulls first),
    groups by name (null first, then by UTF-8 bytes). A group of one leaf has it as its subroot; if there is one group, its
    subroot is the root. Repeated rows are leaves of their own; those equal in order and leaf are interchangeable. An empty
    table gives an empty result. Columns named subroot, root or path are replaced, all others stay; jobs run while the
    result is built."""
    kept = [c for c in rows.columns if c not in ("subroot", "root", "path")]
    inner = rows.select(group_key(F.col(group)).alias("group"), F.col(leaf).alias("digest"), *[F.col(c).alias(f"order{k}") for k, c in enumerate(order)], F.struct(*kept).alias("row"))
    numbered, most = _numbered(stored(inner, "leaves"), [f"order{k}" for k in range(len(order))] + ["digest"])
    levels, subroots = _levels(numbered, most, ["row"], fanout)
    subroots = stored(subroots, "subroots")
    groups = subroots.select(F.lit("").alias("group"), F.col("group").alias("name"), "digest")
    ranked, most = _numbered(groups, ["name"])
    upper, root = _levels(ranked, most, ["name"], fanout)
    top = root.select("group", F.col("digest").alias("root"), F.array().cast(_PATH).alias("path"))
    tops = _proofs(upper, top, ["root"]).select(F.col("name").alias("group"), F.col("digest").alias("subroot"), "root", "path")
    return _proofs(levels, tops, ["subroot", "root"]).select("row.*", "subroot", "root", "path")


def fold(path: Column, leaf: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, leaf, lambda node, level: digest(level["before"], node, level["after"]))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.flatten(F.transform(path, lambda x: F.array(x["before"], x["after"]))), ""), 256)


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def verify_tampered(docs: DataFrame) -> DataFrame:
    """The contract's rows: the manifest of all documents, and what becomes of its proofs when the texts of every third
    document (by crc32 of its id) are lower-cased over A-Z. A null id or text is not tampered with."""
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))
    claimed = F.when(hit, leaf_digest(*fields, F.translate("text", UPPER, LOWER)))
    rows = docs.select("doc_id", "lang", leaf_digest(*fields, F.col("text")).alias("leaf"), claimed.alias("claimed"))
    found = manifest(rows.withColumn("claimed", F.coalesce("claimed", "leaf")), "lang", ["doc_id"])
    folded = found.withColumn("folded_root", fold(F.col("path"), F.col("claimed")))
    return folded.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def oracle(levels: int = 8, fanout: int = FANOUT) -> str:
    """The contract query in DuckDB SQL, for groups of up to fanout ** levels rows."""
    enc = lambda c: f"coalesce(strlen({c})::VARCHAR || ':' || {c}, '-')"
    head = " || ".join(enc(f"{c}::VARCHAR") for c in ("doc_id", "source", "lang", "n_chars"))
    crc = "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)), lambda a, b: list_reduce(list_prepend(xor(a, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda c, z: xor(c >> 1, 3988292384 * (c & 1)))), 4294967295)"
    parts = [
        f"rows AS (SELECT doc_id, coalesce('+' || lang, '') AS g, sha256({head} || {enc('text')}) AS leaf, CASE WHEN {crc} % 3 = 0 THEN sha256({head} || {enc(f"translate(text, '{UPPER}', '{LOWER}')")}) END AS bad FROM documents)",
        "a0 AS (SELECT *, leaf AS h, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM rows)",
    ]

    def climb(x: str, more: str) -> None:
        for k in range(levels):
            side = f"PARTITION BY g, i // {fanout} ORDER BY i ROWS BETWEEN"
            parts.append(f"{x}s{k} AS (SELECT g, i, n, coalesce(string_agg(h, '') OVER ({side} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l, coalesce(string_agg(h, '') OVER ({side} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r{more if not k else ''} FROM {x}{k})")
            parts.append(f"{x}{k + 1} AS (SELECT g, i // {fanout} AS i, (any_value(n) + {fanout - 1}) // {fanout} AS n, CASE WHEN any_value(n) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h FROM {x}{k} GROUP BY g, i // {fanout})")

    climb("a", ", doc_id, leaf, bad")
    parts.append(f"b0 AS (SELECT '' AS g, g AS name, h, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS n FROM a{levels})")
    climb("b", ", name")
    for x, start in (("a", "SELECT *, coalesce(bad, leaf) AS f, '' AS p FROM as0"), ("b", f"SELECT b.g, b.i, b.n, b.l, b.r, a.doc_id, a.leaf, a.f, a.p, s.h AS subroot, t.h AS root FROM af{levels} a JOIN bs0 b ON b.name = a.g JOIN a{levels} s ON s.g = a.g CROSS JOIN b{levels} t")):
        extra = "doc_id, leaf" if x == "a" else "doc_id, leaf, subroot, root"
        parts.append(f"{x}f0 AS ({start})")
        for k in range(levels):
            step = f"{', '.join('c.' + e for e in extra.split(', '))}, c.g, CASE WHEN c.n = 1 THEN c.f ELSE sha256(c.l || c.f || c.r) END AS f, CASE WHEN c.n = 1 THEN c.p ELSE c.p || c.l || c.r END AS p"
            if k + 1 < levels:
                parts.append(f"{x}f{k + 1} AS (SELECT {step}, u.i, u.n, u.l, u.r FROM {x}f{k} c JOIN {x}s{k + 1} u ON u.g = c.g AND u.i = c.i // {fanout})")
            else:
                parts.append(f"{x}f{k + 1} AS (SELECT {step} FROM {x}f{k} c)")
    return "WITH " + ",\n".join(parts) + f"\nSELECT doc_id, leaf, subroot, root, sha256(p) AS proof_sha256, f AS folded_root, f = root AS verified FROM bf{levels}"
