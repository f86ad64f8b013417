"""Merkle manifest of a dataset by nested-interval labels.

The rows of a source are ranked by id; a node of its hash tree is labelled with the interval
of leaf ranks it covers. A node's parent is found by a join on the parent's level bucket (the
interval's start in units of the parent's width) and containment; its siblings are what the
parent's children cover outside its own interval. The subroots, ranked by source, are the
leaves of a second tree of the same kind, whose root signs the whole dataset.

A proof is a list of (left, right): the digests of a node's siblings before and after it, from
the leaf up. Proofs are built from the root down for runs of ``FAN`` leaves, and meet the
leaves inside their run, so the upper levels are moved once per run and not once per row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from riskengine.llm.frames import stored
from riskengine.operators.joins import group_join
from riskengine.operators.ranking import rank_in_group

FAN = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
NO_PROOF = "CAST(array() AS array<struct<left:string,right:string>>)"


def leaf_digest(values: Sequence[Column]) -> Column:
    """Digest of a row's values: each ``-`` if null, else its length in bytes, ``:`` and itself."""
    parts = [v.cast("string") for v in values]
    said = [F.when(p.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(p).cast("string"), F.lit(":"), p)) for p in parts]
    return F.sha2(F.concat(*said).cast("binary"), 256)


def _of(digests: Column) -> Column:
    return F.sha2(F.array_join(digests, "").cast("binary"), 256)


@dataclass
class Tree:
    """``levels[i]``: the nodes of level i + 1, one row each with its children ``kids``.

    A row: (group, n, bucket, lo, hi, digest, kids); ``n``: leaves of the group. A lone leaf has a
    row in the first level whose digest is its own.
    """

    levels: list[DataFrame]

    def subroots(self) -> DataFrame:
        """(group, digest) of the top node of every group."""
        tops = [nodes.filter((F.col("lo") == 0) & (F.col("hi") == F.col("n"))) for nodes in self.levels]
        found = tops[0].select("group", "digest")
        for t in tops[1:]:
            found = found.union(t.select("group", "digest"))
        return found

    def proofs(self, above: DataFrame) -> DataFrame:
        """Rows of the first level with ``path``: the proof of the row's own node, down from ``above`` (group, path, ...)."""
        extra = [c for c in above.columns if c not in ("group", "path")]
        done = None
        for level in reversed(range(len(self.levels))):
            nodes = self.levels[level]
            is_top = (F.col("lo") == 0) & (F.col("hi") == F.col("n"))
            found = group_join(nodes.filter(is_top), above, ["group"])
            if done is not None:
                found = found.unionByName(_below(done, nodes.filter(~is_top), FAN ** (level + 2), extra))
            done = found
        return done


def _beside(kids: Column, lo: Column, hi: Column) -> Column:
    """(left, right) digests of the children whose intervals lie outside [lo, hi)."""
    left = F.filter(kids, lambda k: k["hi"] <= lo)
    right = F.filter(kids, lambda k: k["lo"] >= hi)
    said = [F.array_join(F.transform(x, lambda k: k["digest"]), "") for x in (left, right)]
    return F.struct(said[0].alias("left"), said[1].alias("right"))


def _below(parents: DataFrame, nodes: DataFrame, width: int, extra: list[str]) -> DataFrame:
    """``nodes`` with the path of the one parent whose interval holds theirs, begun with their siblings."""
    p = parents.select(
        F.col("group").alias("p_group"), F.col("bucket").alias("p_bucket"), F.col("lo").alias("p_lo"), F.col("hi").alias("p_hi"),
        F.col("kids").alias("p_kids"), F.col("path").alias("p_path"), *extra,
    )
    held = (
        F.col("group").eqNullSafe(F.col("p_group")) & (F.floor(F.col("lo") / width) == F.col("p_bucket"))
        & (F.col("p_lo") <= F.col("lo")) & (F.col("hi") <= F.col("p_hi"))
    )
    own = F.array(_beside(F.col("p_kids"), F.col("lo"), F.col("hi")))
    return nodes.join(p, held).select(*nodes.columns, *extra, F.concat(own, "p_path").alias("path"))


def _parents(nodes: DataFrame, width: int, carried: Sequence[str] = ()) -> DataFrame:
    kid = F.struct("lo", "hi", "digest", *carried)
    runs = nodes.groupBy("group", "n", F.floor(F.col("lo") / width).alias("bucket")).agg(
        F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sort_array(F.collect_list(kid)).alias("kids")
    )
    lone = F.when(F.col("n") == 1, F.col("kids")[0]["digest"])
    digest = F.coalesce(lone, _of(F.transform("kids", lambda k: k["digest"])))
    return runs.select("group", "n", "bucket", "lo", "hi", digest.alias("digest"), "kids")


def tree(leaves: DataFrame, order: Sequence[Column], carried: Sequence[str] = ()) -> Tree:
    """The tree over ``leaves`` (group, digest, carried...), in ``order`` inside each group; order must be total but for equal digests.

    Ranks come from range partitions, so a group may hold any share of the rows; a node gathers at
    most ``FAN`` children, and each level is a sixteenth of the one below.
    """
    ranked = rank_in_group(leaves, ["group"], order, "lo")
    counts = leaves.groupBy("group").agg(F.count("*").alias("n"))
    nodes = group_join(ranked, counts, ["group"]).withColumns({"lo": F.col("lo") - 1, "hi": F.col("lo")})
    levels = [stored(_parents(nodes, FAN, carried), "merkle")]
    most = levels[0].agg(F.max("n")).first()[0] or 0
    width = FAN
    while width < most:
        width *= FAN
        levels.append(stored(_parents(levels[-1].filter(F.col("n") > width // FAN), width), "merkle"))
    return Tree(levels)


def merkle_manifest(
    docs: DataFrame, audited: Mapping[str, Column] | None = None, fields: Sequence[str] = FIELDS,
    group: str = "source", key: str = "doc_id",
) -> DataFrame:
    """(key, leaf, subroot, root, proof_sha256, folded_root, verified) per input row.

    ``audited`` gives the columns as an auditor finds them; where their digest differs, the root
    folded from it and the row's proof is not the root. Rows of a group are ordered by key, equal
    keys by digest, a null key first; null is a group of its own, before all others. A null value
    is ``-`` in a leaf, an empty text ``0:``. Repeated rows are leaves of their own. Other columns
    are not looked at; an empty table gives an empty result.
    """
    found = {f: F.col(f"`{f}`") for f in fields}
    seen = {**found, **(audited or {})}
    leaves = docs.select(
        found[key].alias("id") if key in found else F.col(f"`{key}`").alias("id"), F.col(f"`{group}`").alias("group"),
        leaf_digest(list(found.values())).alias("digest"), leaf_digest(list(seen.values())).alias("now"),
    )
    leaves = stored(leaves, "leaves")
    per_group = tree(leaves, [F.col("id").asc(), F.col("digest").asc()], carried=["id", "now"])

    subroots = stored(per_group.subroots(), "subroots").select(F.lit(0).alias("group"), F.col("group").alias("name"), "digest")
    top = tree(subroots, [F.col("name").asc()], carried=["name"])
    root = top.subroots().select("group", F.col("digest").alias("root"))
    tops = top.proofs(root.select("group", "root", F.expr(NO_PROOF).alias("path")))
    above = _leaf_rows(tops).select(
        F.col("kid.name").alias("group"), F.col("kid.digest").alias("subroot"), "root", "path"
    )
    rows = _leaf_rows(per_group.proofs(above)).select(
        F.col("kid.id").alias(key), F.col("kid.digest").alias("leaf"), F.col("kid.now").alias("now"), "subroot", "root", "path"
    )
    proof = F.sha2(F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), "").cast("binary"), 256)
    folded = F.aggregate("path", F.col("now"), lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]).cast("binary"), 256))
    out = rows.select(key, "leaf", "subroot", "root", proof.alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def _leaf_rows(runs: DataFrame) -> DataFrame:
    """One row per leaf of first-level nodes with their paths: ``kid`` and the leaf's own path."""
    each = runs.withColumn("kid", F.explode("kids"))
    own = F.array(_beside(F.col("kids"), F.col("kid.lo"), F.col("kid.hi")))
    return each.withColumn("path", F.when(F.col("n") == 1, F.col("path")).otherwise(F.concat(own, "path")))


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_cased_fifth(key: str = "doc_id", text: str = "text") -> dict[str, Column]:
    """The tampering of the audit: every row whose key's crc32 is divisible by 5 has its text's A-Z lower-cased."""
    chosen = F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0
    return {text: F.when(chosen, F.translate(F.col(text), UPPER, LOWER)).otherwise(F.col(text))}
