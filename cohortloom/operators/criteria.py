"""Diagnoses from nested criteria in three-valued logic.

Criteria are rows: nodes with a kind, edges from a criterion to what it is made of, and leaves that read answers. Findings are rows too (person, node,
true, false or unknown); each level of the nesting is one join with the edges and one grouping by person and criterion, however many diagnoses there are.

Kinds: `at_least` is true with `need` true parts, false when the unknown ones could not make up for it, else unknown; `any_known` is true with a true
part, false when some part is known, else unknown. A part may be a `gate`: an unknown gate leaves the criterion unknown and a false one
makes it false, whatever the rest says. A part that a person has no finding for is unknown, or false where the edge says so.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..session import cut, uncut

LEAVES = "node string, qid string, yes array<string>, contains array<string>, no array<string>, need int"
NODES = "node string, kind string, need int"
EDGES = "parent string, child string, role string, absent string"


def findings(answers: DataFrame, leaves: DataFrame) -> DataFrame:
    """pid, node, value, age of every leaf that a person answered.

    answers: pid, qid, answer, age. A leaf is true if an answer is in `yes` or holds a text of `contains`; false if one is in `no`, any other one where `no` is null; else
    unknown. With `need` it is whether there are that many different answers. Leaves without a `qid` of their own do not occur; leaves are a definition table and are broadcast.
    """
    order = F.monotonically_increasing_id()
    j = answers.select("pid", "qid", T.answer_norm("answer").alias("a"), "age").join(F.broadcast(leaves.coalesce(1).withColumn("place", order)), "qid")
    hit = F.coalesce(F.array_contains("yes", F.col("a")), F.lit(False)) | F.coalesce(F.exists("contains", lambda p: F.contains(F.col("a"), p)), F.lit(False))
    miss = ~hit & F.coalesce(F.array_contains("no", F.col("a")), F.lit(True))
    g = j.withColumn("hit", hit).withColumn("miss", miss).groupBy("pid", "node", "place", "need").agg(F.bool_or("hit").alias("hit"), F.bool_or("miss").alias("miss"), F.count_distinct("a").alias("n"), F.min("age").alias("age"))
    value = F.when(F.col("need").isNotNull(), F.col("n") >= F.col("need")).when(F.col("hit"), True).when(F.col("miss"), False)
    return g.select("pid", "node", value.alias("value"), F.when(F.col("age").isNotNull(), F.struct("place", "age")).alias("first"))


def _levels(edges: DataFrame) -> list[list[str]]:
    """Criteria by their distance from the leaves; the definition table is read, some rows per diagnosis."""
    parts: dict[str, set[str]] = {}
    for r in edges.select("parent", "child").collect():
        parts.setdefault(r.parent, set()).add(r.child)
    levels, done = [], set()
    while len(done) < len(parts):
        now = [p for p in parts if p not in done and not (parts[p] & parts.keys()) - done]
        if not now:
            raise ValueError(f"criteria contain each other: {sorted(parts.keys() - done)}")
        levels.append(now)
        done |= set(now)
    return levels


def evaluate(nodes: DataFrame, edges: DataFrame, found: DataFrame) -> DataFrame:
    """pid, node, value (null: unknown) and age of all criteria that a person has a finding for; age is that of the first leaf in the definitions that has one."""
    body = F.col("role") != "gate"
    open_ = body & (F.col("absent") == "unknown")
    facts = edges.groupBy("parent").agg(F.count_if(open_).alias("n_open"), F.bool_or(~body).alias("gated")).join(nodes.withColumnRenamed("node", "parent"), "parent")
    facts, edges = cut(facts), cut(edges.select("parent", F.col("child").alias("node"), "role", "absent"))
    values = cut(found)
    for level in _levels(edges.withColumnRenamed("node", "child")):
        j = values.join(F.broadcast(edges.where(F.col("parent").isin(level))), "node")
        g = j.groupBy("pid", "parent").agg(
            F.count_if(body & F.col("value")).alias("yes"), F.count_if(open_ & F.col("value").isNotNull()).alias("known"), F.count_if(body & F.col("value").isNotNull()).alias("seen"),
            F.max(F.when(~body, F.col("value"))).alias("gate"), F.min("first").alias("first"))
        g = g.join(F.broadcast(facts), "parent")
        missing = F.col("n_open") - F.col("known")
        least = F.when(F.col("yes") >= F.col("need"), True).when(F.col("yes") + missing < F.col("need"), False)
        known = F.when(F.col("yes") > 0, True).when(F.col("seen") > 0, False)
        core = F.when(F.col("kind") == "any_known", known).otherwise(least)
        value = F.when(~F.col("gated") | F.col("gate"), core).when(~F.col("gate"), False)
        before, values = values, cut(values.unionByName(g.select("pid", F.col("parent").alias("node"), value.alias("value"), "first")))
        uncut(before)
    return values.select("pid", "node", "value", F.col("first.age").alias("age"))


def diagnoses(answers: DataFrame, leaves: DataFrame, nodes: DataFrame, edges: DataFrame, wanted: list[str]) -> DataFrame:
    """pheno_id, pid, y (1 or 0), age of the wanted criteria; unknown ones and those without an age are left out."""
    out = evaluate(nodes, edges, findings(answers, leaves)).where(F.col("node").isin(wanted) & F.col("value").isNotNull() & F.col("age").isNotNull())
    return out.select(F.col("node").alias("pheno_id"), "pid", F.col("value").cast("double").alias("y"), "age")


# definitions -----------------------------------------------------------------------------------------------------------------------------
def anxiety(name: str, stem: str, excessive: list[str], associated: list[str], need: int = 3) -> tuple[list[tuple], list[tuple]]:
    """Nodes and edges of lifetime anxiety: a stem that is a gate, some excessive worry and `need` associated symptoms."""
    nodes = [(name, "at_least", 2), (f"{name}/excessive", "at_least", 1), (f"{name}/associated", "at_least", need)]
    edges = [(name, stem, "gate", "unknown"), (name, f"{name}/excessive", "part", "unknown"), (name, f"{name}/associated", "part", "unknown")]
    edges += [(f"{name}/excessive", x, "part", "unknown") for x in excessive] + [(f"{name}/associated", x, "part", "unknown") for x in associated]
    return nodes, edges


def episode(name: str, core: list[str], with_: list[str], of: str | None = None) -> tuple[list[tuple], list[tuple]]:
    """Nodes and edges of an episode: any of the core questions (known if one was answered) is the gate, or criterion `of`; all of `with_` must be true, and count as false when not answered."""
    nodes, edges = [(name, "at_least", len(with_))], [(name, x, "part", "false") for x in with_]
    if of:
        return nodes, [(name, of, "gate", "unknown"), *edges]
    gate = f"{name}/core" if with_ else name
    nodes = [(gate, "any_known", 1)] + (nodes if with_ else [])
    return nodes, [(gate, x, "part", "unknown") for x in core] + ([(name, gate, "gate", "unknown")] if with_ else []) + edges


def symptoms_by_screener(prefix: str, screener: str, symptoms: list[str]) -> tuple[list[tuple], list[tuple]]:
    """A criterion per symptom: case with the screener and the symptom, control without either, unknown with the screener alone."""
    names = [f"{prefix}__{s}" for s in symptoms]
    return [(n, "at_least", 1) for n in names], [e for n, s in zip(names, symptoms) for e in ((n, screener, "gate", "unknown"), (n, s, "part", "false"))]
