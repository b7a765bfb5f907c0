"""Schemas that drift between files: one table out of all, and a report of each change.

Consecutive files of a cohort are compared by similarity flooding.  The schema
graph of a file has a node for each field, with edges to the words of its name,
its type, its parent (nested objects), its known concept and the values it holds.  Match
scores spread over the pairwise connectivity graph until they converge; the consistent
one-to-one correspondences are chosen by these scores, and the values are checked.

Values are compared in a distributed join on (file, sample); what reaches the
flooding of one pair of files is a row for each pair of fields that went and came,
which grows with the width of a schema and not with its records.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from difflib import SequenceMatcher
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.functions.keys import normal_key
from cohortloom.session import cut_lineage, ship

# Types from the narrowest to the widest.
TYPES = ["", "boolean", "integer", "decimal", "text", "list"]
# Texts of one truth value in the codings of a boolean.
TRUTH = {"true": "1", "yes": "1", "y": "1", "false": "0", "no": "0", "n": "0"}

_CELLS = "array<struct<field:string,kind:int,canon:string,raw:string>>"


class _Number(str):
    """A JSON number with a point or an exponent, as written."""


def _canon(value: object) -> str:
    """A form of a value that most codings share: numbers by size, lists by their items, truth values as 1 and 0."""
    if isinstance(value, bool):
        return "1" if value else "0"
    if isinstance(value, list):
        return "; ".join(_canon(v) for v in value)
    return _canon_text(str(value))


@lru_cache(maxsize=65_536)
def _canon_text(text: str) -> str:
    text = text.strip().lower()
    if text in TRUTH:
        return TRUTH[text]
    number = _QUANTITY.fullmatch(text) if len(text) < 40 else None
    if number:
        return repr(float(number[1].replace(",", "."))).removesuffix(".0")
    return "; ".join(_LIST_SIGNS.split(text))


_QUANTITY, _LIST_SIGNS = re.compile(r"([-+]?\d+(?:[.,]\d+)?(?:e[-+]?\d+)?)(?:\s*(?:[^\W\d]+|%)(?:/\w+)?\.?)?"), re.compile(r"\s*[;,|/]\s*")


def _json(value: object) -> str:
    """A value as JSON, its numbers as written."""
    if isinstance(value, list):
        return "[" + ", ".join(map(_json, value)) + "]"
    if isinstance(value, dict):
        return "{" + ", ".join(f"{json.dumps(k, ensure_ascii=False)}: {_json(v)}" for k, v in value.items()) + "}"
    return str(value) if isinstance(value, _Number) else json.dumps(value, ensure_ascii=False)


def payload_cells(text: str | None, with_raw: bool = True) -> list[dict]:
    """The fields of one JSON object: name (nested ones joined by '.'), type by rank, canonical value, value as written; [] if it isn't one.

    As written is the text of a string, and the JSON of any other value.
    """
    try:
        record = json.loads(text, parse_float=_Number)
    except (ValueError, TypeError, RecursionError):
        return []
    out: list[dict] = []

    def walk(node: dict, path: str) -> None:
        for name, value in node.items():
            full = f"{path}.{name}" if path else name
            if isinstance(value, dict) and value:
                walk(value, full)
                continue
            kind = 0 if value is None or isinstance(value, dict) else 1 if isinstance(value, bool) else 5 if isinstance(value, list) else 2 if isinstance(value, int) else 3 if isinstance(value, _Number) else 4
            raw = None if not kind or not with_raw else value if kind == 4 and isinstance(value, str) else _json(value)
            out.append({"field": full, "kind": kind, "canon": _canon(value) if kind else None, "raw": raw})

    if isinstance(record, dict):
        walk(record, "")
    return out


def file_fields(records: DataFrame, with_raw: bool = True) -> DataFrame:
    """(gse_key, release_no, file_id, gsm_key, field, kind, canon, raw): one row per field and record.

    canon is evidence for renames only; raw is the value as written, null where it isn't asked for.
    """

    ship(records.sparkSession)

    @F.pandas_udf(_CELLS)
    def decode(payloads: pd.Series) -> pd.Series:
        return payloads.map(lambda text: payload_cells(text, with_raw))

    cells = records.select(
        normal_key(F.col("gse_id")).alias("gse_key"), "release_no", "file_id", normal_key(F.col("gsm_id")).alias("gsm_key"), F.explode(decode("payload")).alias("c")
    )
    return cells.select("gse_key", "release_no", "file_id", "gsm_key", "c.*")


# --- similarity flooding -------------------------------------------------------------------------------------------


def _words(name: str) -> list[str]:
    parts = re.sub(r"([a-z])([A-Z])", r"\1 \2", name.rpartition(".")[2] if " " not in name else name)
    return [w for w in re.split(r"[^a-z0-9%]+", parts.lower()) if w]


#: The pair that matches in everything: scores are measured against it.
_IDEAL = ("field", "", "")
#: Words are linked from this likeness on, and pairs are correspondences from this flooded score on.
LEAST_WORD_RATIO, LEAST_SCORE = 0.6, 0.26


def value_evidence(p: dict) -> float:
    """How far two fields hold the same content, whatever the coding: 0 to 1.

    Equal values count by their share and number.  A recoding counts by the samples whose
    pair is the most frequent one for either value, and by the bits of evidence
    beyond those that a free one-to-one coding would fit anyway.
    """
    n, entropy = p["n_both"], p["entropy"]
    if not n:
        return 0.0
    share = p["n_equal"] / n
    equal = (0.9 + 0.1 * share) * min(1.0, share / 0.8) * (1 - 2.0 ** -max(n, n * entropy)) * (1.0 if share >= 0.8 else 0.5)
    bits = n * entropy - p["n_pairs"] * max(1.0, entropy)
    return max(equal, (p["n_mutual"] / n) ** 2 * (1 - 2.0 ** (-max(bits, 0.0) / 3)))


def flood(pairs: list[dict], concepts: dict[str, int], rounds: int = 100, tolerance: float = 1e-4) -> dict[tuple[str, str], float]:
    """Converged match scores of (old field, new field), as a share of what an ideal pair gets.

    ``pairs`` holds, for every field that went and every one that came, their types
    and the counts of their common values.  The pairwise connectivity graph links a pair
    of fields with the pairs of their words, types, parents and concepts, and with the
    evidence of their values; scores flow both ways along its edges, weighted by
    the inverse of a node's number of edges with that label.  So fields of renamed
    parents support each other, and a type or word that many pairs share tells little.
    """
    start: dict[tuple, float] = {_IDEAL: 1.0}
    edges: dict[tuple, list[tuple]] = {}

    def link(node: tuple, label: str, other: tuple, sim: float) -> None:
        start[other] = sim
        edges.setdefault(node, []).append((label, other))
        edges.setdefault(other, []).append((label, node))

    for label in ("values", "word", "type", "concept"):
        link(_IDEAL, label, (label, "", ""), 1.0)
    for p in pairs:
        node = ("field", p["old"], p["new"])
        start[node] = value_evidence(p)
        link(node, "values", ("values", p["old"], p["new"]), start[node])
        olds, news = _words(p["old"]), _words(p["new"])
        for a in olds:
            for b in news:
                ratio = SequenceMatcher(None, a, b).ratio() if a != b else 1.0
                if ratio >= LEAST_WORD_RATIO:
                    link(node, "word", ("word", a, b), ratio / max(len(olds), len(news)))
        link(node, "type", ("type", p["old_kind"], p["new_kind"]), 1.0 if p["old_kind"] == p["new_kind"] else 0.5)
        a, b = p["old"].rpartition(".")[0], p["new"].rpartition(".")[0]
        if a or b:
            link(node, "parent", ("parent", a, b), 1.0 if a == b else 0.0)
        known = [concepts.get(p["old"].lower()), concepts.get(p["new"].lower())]
        if None not in known:
            link(node, "concept", ("concept", *known), 1.0 if known[0] == known[1] else 0.0)
    weight = {n: {label: 1.0 / k for label, k in Counter(x for x, _ in out).items()} for n, out in edges.items()}
    score = dict(start)
    for _ in range(rounds):
        flow = {n: start[n] + score[n] + sum(weight[m][label] * (start[m] + score[m]) for label, m in edges.get(n, ())) for n in start}
        top = max(flow.values())
        after = {n: v / top for n, v in flow.items()}
        moved = max(abs(after[n] - score[n]) for n in after)
        score = after
        if moved < tolerance:
            break
    return {(n[1], n[2]): v / score[_IDEAL] for n, v in score.items() if n[0] == "field" and n != _IDEAL}


def match_fields(pairs: list[dict], concepts: dict[str, int]) -> list[tuple[str, str]]:
    """The one-to-one correspondences of the fields that went and came between two files.

    The flooded scores choose: the best pair first, then the best of the fields left, as far
    as the score reaches ``LEAST_SCORE``.  An exact check of the values follows.
    """
    scores = flood(pairs, concepts) if pairs else {}
    chosen, olds, news = [], set(), set()
    for p in sorted(pairs, key=lambda p: (-scores[(p["old"], p["new"])], p["old"], p["new"])):
        if p["old"] in olds or p["new"] in news or scores[(p["old"], p["new"])] < LEAST_SCORE or not _same_content(p):
            continue
        chosen.append((p["old"], p["new"]))
        olds.add(p["old"])
        news.add(p["new"])
    return chosen


def _same_content(p: dict) -> bool:
    """Equal values for four samples in five, or a one-to-one recoding of nine in ten; without a common sample none."""
    return p["n_both"] > 0 and (p["n_equal"] >= 0.8 * p["n_both"] or p["n_mutual"] >= 0.9 * p["n_both"])


# --- distributed part ----------------------------------------------------------------------------------------------


def field_evidence(fields: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What changed between each file and the one before: (statuses, evidence).

    statuses: (file_id, field, old_kind, new_kind, status) with status kept, gone or
    new.  evidence: one row for each field that went and each that came in a file,
    with counts over the samples both files hold.  Both build on the pairs of files and
    the statuses several times; these have a row a file and a row a field, and are written.
    """
    files = fields.select("gse_key", "release_no", "file_id").distinct()
    by_release = files.groupBy("gse_key", "release_no").agg(F.min("file_id").alias("first_file"))
    line = Window.partitionBy("gse_key").orderBy("release_no")
    before = by_release.select("gse_key", "release_no", F.lag("first_file").over(line).alias("prev_file")).where("prev_file is not null")
    pairs = cut_lineage(files.join(before, ["gse_key", "release_no"]).select("file_id", "prev_file"))
    kinds = fields.groupBy("file_id", "field").agg(F.max("kind").alias("kind"))
    new = kinds.join(pairs.select("file_id"), "file_id").select("file_id", "field", F.col("kind").alias("new_kind"))
    old = kinds.withColumnRenamed("file_id", "prev_file").join(pairs, "prev_file").select("file_id", "field", F.col("kind").alias("old_kind"))
    status = F.when(F.col("old_kind").isNull(), "new").when(F.col("new_kind").isNull(), "gone").otherwise("kept")
    statuses = cut_lineage(old.join(new, ["file_id", "field"], "full_outer").withColumn("status", status))
    both = statuses.where("status <> 'kept'").groupBy("file_id").agg(F.count_if(F.col("status") == "gone").alias("g"), F.count_if(F.col("status") == "new").alias("n")).where("g > 0 and n > 0").select("file_id")
    gone = statuses.where("status = 'gone'").join(both, "file_id").select("file_id", F.col("field").alias("old"), "old_kind")
    came = statuses.where("status = 'new'").join(both, "file_id").select("file_id", F.col("field").alias("new"), "new_kind")
    # Of the fields that went and came only; one value for each sample, also where a file came twice.
    known = fields.where("canon is not null and gsm_key is not null").select("file_id", "field", "gsm_key", F.xxhash64("canon").alias("canon"))
    value = F.min("canon").alias("canon")
    of_prev = gone.join(pairs, "file_id").select("file_id", "prev_file", F.col("old").alias("field"))
    was = known.withColumnRenamed("file_id", "prev_file").join(of_prev, ["prev_file", "field"]).groupBy("file_id", "field", "gsm_key").agg(value)
    now = known.join(came.select("file_id", F.col("new").alias("field")), ["file_id", "field"]).groupBy("file_id", "field", "gsm_key").agg(value)
    met = was.select("file_id", "gsm_key", F.col("field").alias("old"), F.col("canon").alias("a")).join(
        now.select("file_id", "gsm_key", F.col("field").alias("new"), F.col("canon").alias("b")), ["file_id", "gsm_key"]
    )
    coded = met.groupBy("file_id", "old", "new", "a", "b").agg(F.count(F.lit(1)).alias("n"))
    top = lambda c: F.row_number().over(Window.partitionBy("file_id", "old", "new", c).orderBy(F.desc("n"), "a", "b"))
    coded = coded.withColumn("mutual", (top("a") == 1) & (top("b") == 1)).withColumn("na", F.sum("n").over(Window.partitionBy("file_id", "old", "new", "a")))
    counts = coded.groupBy("file_id", "old", "new").agg(
        F.sum("n").alias("n_both"),
        F.sum(F.when(F.col("a") == F.col("b"), F.col("n")).otherwise(0)).alias("n_equal"),
        F.count(F.lit(1)).alias("n_pairs"),
        F.sum(F.when(F.col("mutual"), F.col("n")).otherwise(0)).alias("n_mutual"),
        F.sum(F.col("n") * F.log2("na")).alias("nlogn"),
    )
    evidence = gone.join(came, "file_id").join(counts, ["file_id", "old", "new"], "left").select(
        "file_id", "old", "new", "old_kind", "new_kind",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_both", "n_equal", "n_pairs", "n_mutual")],
        F.coalesce(F.log2("n_both") - F.col("nlogn") / F.col("n_both"), F.lit(0.0)).alias("entropy"),
    )
    return statuses, evidence


def concept_names(clusters: DataFrame, limit: int = 10_000) -> dict[str, int]:
    """Known field names in lower case with their cluster; more than ``limit`` names are refused."""
    rows = clusters.select("cluster_id", F.explode(F.concat(F.array("canonical_name"), F.coalesce("source_columns", F.array()))).alias("name")).where("name is not null")
    found = rows.orderBy("cluster_id", "name").limit(limit + 1).collect()
    if len(found) > limit:
        raise ValueError(f"the clusters have more than {limit} names")
    return {r["name"].lower(): r["cluster_id"] for r in reversed(found)}


def schema_changes(records: DataFrame, clusters: DataFrame, fields: DataFrame | None = None) -> DataFrame:
    """(file_id, drift, old_name, new_name): every change of a file against the release before.

    drift is renamed, added (old_name empty), removed (new_name empty) or retyped.
    Records whose payload is null or no JSON object hold no fields; a file seen
    twice counts once; records without a cohort or sample add their fields but no
    evidence.  Of several files with one release number the one with the lowest id stands
    for the release.  Extra columns aren't read.  ``fields`` are the records'
    ``file_fields`` where these are at hand; else they are decoded once and written.
    """
    ship(records.sparkSession)
    concepts = concept_names(clusters)
    fields = cut_lineage(file_fields(records, with_raw=False).drop("raw")) if fields is None else fields
    statuses, evidence = field_evidence(fields)

    @F.pandas_udf("array<struct<old:string,new:string>>")
    def matched(pairs: pd.Series) -> pd.Series:
        return pairs.map(lambda rows: [{"old": a, "new": b} for a, b in match_fields([dict(r) for r in rows], concepts)])

    names = ["old", "new", "old_kind", "new_kind", "n_both", "n_equal", "n_pairs", "n_mutual", "entropy"]
    renamed = (
        evidence.groupBy("file_id").agg(F.sort_array(F.collect_list(F.struct(*names))).alias("pairs")).select("file_id", F.explode(matched("pairs")).alias("m")).select("file_id", "m.old", "m.new")
    )
    # A field that went has its match's new name, one that came its match's old name, a kept one its own name.
    links = renamed.select("file_id", F.col("old").alias("field"), F.lit("gone").alias("status"), F.col("new").alias("other")).unionByName(
        renamed.select("file_id", F.col("new").alias("field"), F.lit("new").alias("status"), F.col("old").alias("other"))
    )
    linked = statuses.join(links, ["file_id", "field", "status"], "left")
    old_name = F.when(F.col("status") == "new", F.coalesce("other", F.lit(""))).otherwise(F.col("field"))
    new_name = F.when(F.col("status") == "gone", F.coalesce("other", F.lit(""))).otherwise(F.col("field"))
    paired = linked.groupBy("file_id", old_name.alias("old_name"), new_name.alias("new_name")).agg(F.max("old_kind").alias("old_kind"), F.max("new_kind").alias("new_kind"))
    retyped = (F.col("old_kind") > 0) & (F.col("new_kind") > 0) & (F.col("old_kind") != F.col("new_kind"))
    drifts = F.array(
        F.when(F.col("old_name") == "", "added").when(F.col("new_name") == "", "removed").when(F.col("old_name") != F.col("new_name"), "renamed"),
        F.when((F.col("old_name") != "") & (F.col("new_name") != "") & retyped, "retyped"),
    )
    return paired.select("file_id", F.explode(F.array_compact(drifts)).alias("drift"), "old_name", "new_name")
