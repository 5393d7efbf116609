"""Relatedness over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import graph as G
from ..session import cut
from . import roles
from .aggregations import rcols
from .registry import query, rs, table
from .roles import role, sql

role("strong", "SELECT iid1, iid2 FROM edges WHERE kinship >= 0.3535", "edges")
role("comp", """SELECT iid, min(l) AS component FROM (WITH RECURSIVE reach(iid, l) AS (SELECT iid1, iid1 FROM strong UNION SELECT iid2, iid2 FROM strong
 UNION SELECT CASE WHEN e.iid1 = r.iid THEN e.iid2 ELSE e.iid1 END, r.l FROM reach r JOIN strong e ON (e.iid1 = r.iid OR e.iid2 = r.iid)) SELECT * FROM reach) GROUP BY iid""", "strong")


@query("G1_pair_classes", sql("edges", f"""SELECT iid1, iid2, {rs('kinship')} AS kinship, CASE WHEN kinship >= 0.3535 AND ibs0 < 0.0012 THEN 'identical' WHEN kinship >= 0.1767 AND kinship < 0.3535
 THEN CASE WHEN ibs0 >= 0.0012 THEN 'sibling' ELSE 'parent_child' END END AS relationship FROM edges"""))
def _(spark, sf):
    return rcols(G.classify_pairs(roles.edges(spark, sf)).select("iid1", "iid2", "kinship", "relationship"), "kinship")


def strong(spark, sf):
    return roles.edges(spark, sf).where("kinship >= 0.3535")


@query("G2_component_members", sql("comp", "SELECT iid, component FROM comp"))
def _(spark, sf):
    return G.component_labels(strong(spark, sf))


@query("G2_component_table", sql("comp", """SELECT component, size, n_edges, n_edges = size * (size - 1) / 2 AS is_clique, size >= 3 AS excluded FROM (SELECT component, count(*) AS size FROM comp GROUP BY component)
 JOIN (SELECT component, count(*) AS n_edges FROM strong JOIN comp ON iid1 = iid GROUP BY component) USING (component)"""))
def _(spark, sf):
    return G.components(strong(spark, sf))[1]


def kept(spark, sf):
    nodes = roles.people(spark, sf).select("iid")
    e = roles.edges(spark, sf)
    rel = G.classify_pairs(e).where("relationship in ('identical', 'sibling') and kinship >= 0.495")
    seeds = rel.select(F.col("iid1").alias("iid")).unionByName(rel.select(F.col("iid2").alias("iid"))).distinct()
    return G.unrelated(nodes, e, seeds, 0.4), nodes, e, seeds


@query("G3_unrelated_set")
def _(spark, sf):
    return kept(spark, sf)[0]


@query("G3_unrelated_check", "SELECT CAST(0 AS BIGINT) AS n_unknown, CAST(0 AS BIGINT) AS n_related_pairs, CAST(0 AS BIGINT) AS n_addable")
def _(spark, sf):
    k, nodes, e, seeds = kept(spark, sf)
    return G.verify_unrelated(cut(k), nodes, e, seeds, 0.4)


@query("G4_kinship", sql("genotypes", f"""WITH p AS (SELECT a.sample_id AS iid1, b.sample_id AS iid2, count(*) AS n, sum((a.dosage = 1 AND b.dosage = 1)::INT) AS hh, sum((abs(a.dosage - b.dosage) = 2)::INT) AS z, sum((a.dosage = 1)::INT) AS hi, sum((b.dosage = 1)::INT) AS hj
 FROM genotypes a JOIN genotypes b ON a.variant_id = b.variant_id AND a.sample_id < b.sample_id WHERE a.dosage IS NOT NULL AND b.dosage IS NOT NULL GROUP BY a.sample_id, b.sample_id),
 k AS (SELECT *, (hh - 2 * z) / (2.0 * least(hi, hj)) + 0.5 - (hi + hj) / (4.0 * least(hi, hj)) AS kin FROM p WHERE least(hi, hj) > 0)
 SELECT iid1, iid2, n AS n_variants, {rs('hh / CAST(n AS DOUBLE)')} AS hethet, {rs('z / CAST(n AS DOUBLE)')} AS ibs0, {rs('kin')} AS kinship FROM k WHERE kin >= CAST(-0.1234567 AS DOUBLE)"""))
def _(spark, sf):
    return rcols(G.kinship(roles.genotypes(spark, sf), -0.1234567), "hethet", "ibs0", "kinship")


@query("G5_kin_holdout", sql("edges scores", """SELECT iid FROM scores WHERE role = 'oof' AND iid NOT IN (SELECT iid2 FROM edges WHERE kinship >= 0.45 AND iid1 IN (SELECT iid FROM scores WHERE role = 'applied')
 UNION SELECT iid1 FROM edges WHERE kinship >= 0.45 AND iid2 IN (SELECT iid FROM scores WHERE role = 'applied'))"""))
def _(spark, sf):
    s = roles.scores(spark, sf)
    return G.kin_holdout(s.where("role = 'oof'"), s.where("role = 'applied'"), roles.edges(spark, sf), 0.45)[0]


@query("G5_kin_holdout_report", sql("edges scores", f"""SELECT a.iid, b.iid AS relative, {rs('kinship')} AS kinship FROM (SELECT iid1 AS x, iid2 AS y, kinship FROM edges UNION ALL SELECT iid2, iid1, kinship FROM edges) JOIN scores a ON a.iid = x AND a.role = 'oof'
 JOIN scores b ON b.iid = y AND b.role = 'applied' WHERE kinship >= 0.45"""))
def _(spark, sf):
    s = roles.scores(spark, sf)
    return rcols(G.kin_holdout(s.where("role = 'oof'"), s.where("role = 'applied'"), roles.edges(spark, sf), 0.45)[1], "kinship")
