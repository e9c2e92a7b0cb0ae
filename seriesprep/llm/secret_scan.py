"""Secret scan over an incremental ledger of blobs, with DataFrame functions only.

Every historical version of a text is addressed by its content (SHA-256), so a blob that stands under many paths or
in many versions is scanned once. The ledger holds one row per blob, rule and rule version that has been scanned, with the
spans found. A scan takes only the pairs the ledger lacks, appends them, and joins the findings back to all paths.

Positions are code points; ends are exclusive. Spark has no function that returns positions of matches, so they are
summed from the lengths of the matches and of the pieces between them.

Defined results: null counts as the empty text. Repeated rows each get their findings; null ids are kept. Texts without
findings have empty lists. Empty tables give empty results; columns other than id and text play no part.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesprep.workspace import stage


@dataclass(frozen=True)
class Rule:
    """A pattern; matches whose ``group`` has fewer than ``least`` characters are dropped after matching."""

    kind: str
    pattern: str
    version: int = 1
    group: int = 0
    least: int = 1


BASE_RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", group=2, least=6),
    Rule("access", "AKIA[A-Z0-9]+", least=20),
    # runs below the least length would be dropped anyway, and runs are maximal: not matching them gives the same spans
    Rule("hex", "[0-9a-f]{24,}", least=24),
)
MORE_RULES = (
    Rule("pem", "-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("forge", "gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", "xox[abprs]-[A-Za-z0-9-]{10,}"),
)
RULES = BASE_RULES + MORE_RULES
LEDGER = "blob STRING, rule STRING, version INT, spans ARRAY<STRUCT<start: INT, end: INT>>"


def spans(text: Column, rule: Rule) -> Column:
    """Start and end of every match that is long enough, leftmost first, without overlaps."""
    pattern = F.lit(rule.pattern)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    judged = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else found
    steps = F.zip_with(
        F.zip_with(F.transform(F.split(text, rule.pattern, -1), F.char_length), F.transform(found, F.char_length),
                   lambda gap, size: F.struct(gap.alias("gap"), size.alias("size"))),
        F.transform(judged, F.char_length), lambda s, j: F.struct(s["gap"].alias("gap"), s["size"].alias("size"), j.alias("judged")))
    none = F.lit(None).cast("array<struct<start:int,end:int,ok:boolean>>")
    start = F.struct(F.lit(0).alias("at"), F.coalesce(none, F.array().cast("array<struct<start:int,end:int,ok:boolean>>")).alias("out"))

    def step(acc: Column, s: Column) -> Column:
        begin = acc["at"] + s["gap"]
        end = begin + F.coalesce(s["size"], F.lit(0))
        one = F.struct(begin.alias("start"), end.alias("end"), F.coalesce(s["judged"] >= rule.least, F.lit(False)).alias("ok"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    all_spans = F.aggregate(steps, start, step, lambda acc: acc["out"])
    kept = F.transform(F.filter(all_spans, lambda s: s["ok"]), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    return F.when(text.rlike(rule.pattern), kept).otherwise(F.array().cast("array<struct<start:int,end:int>>"))


def empty_ledger(docs: DataFrame) -> DataFrame:
    return docs.sparkSession.createDataFrame([], LEDGER)


def versions_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Path and blob of every row."""
    return docs.select(F.col(id_col).alias("_path"), F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256).alias("blob"))


def scan(
    docs: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """The ledger with this table's blobs added, and the findings of every row.

    Findings: id, ``blob`` and ``found``, an array of (kind, spans) in the order of the rules.
    """
    ledger = empty_ledger(docs) if ledger is None else ledger
    versions = stage(versions_of(docs, id_col, text_col), "versions")
    wanted = F.explode(F.array(*[F.struct(F.lit(r.kind).alias("rule"), F.lit(r.version).alias("version")) for r in rules]))
    blobs = versions.groupBy("blob").agg(F.min("_path").alias("_path"))
    pairs = blobs.select("blob", "_path", wanted.alias("_rule")).select("blob", "_path", "_rule.rule", "_rule.version")
    unseen = pairs.join(ledger, ["blob", "rule", "version"], "left_anti").groupBy("blob", "_path").agg(
        F.collect_set("rule").alias("_unseen"))  # at most one entry per rule

    text = F.coalesce(F.col(text_col), F.lit(""))
    texts = docs.select(F.col(id_col).alias("_own"), text.alias("_text"))
    match = texts["_own"].eqNullSafe(unseen["_path"]) & (F.sha2(texts["_text"], 256) == unseen["blob"])
    todo = texts.join(unseen.hint("shuffle_hash"), match).select("blob", "_text", "_unseen")
    results = F.array(*[
        F.struct(F.lit(r.kind).alias("rule"), F.lit(r.version).alias("version"),
                 F.when(F.array_contains("_unseen", r.kind), spans(F.col("_text"), r)).alias("spans")) for r in rules])
    scanned = (
        todo.select("blob", F.explode(results).alias("_r")).select("blob", "_r.rule", "_r.version", "_r.spans")
        .filter("spans IS NOT NULL")
    )
    fresh = stage(scanned, "ledger-part").dropDuplicates(["blob", "rule", "version"])
    known = ledger.unionByName(fresh)

    now = F.array(*[F.struct(F.lit(r.kind).alias("rule"), F.lit(r.version).alias("version")) for r in rules])
    current = known.filter(F.array_contains(now, F.struct("rule", "version"))).filter(F.size("spans") > 0)
    by_blob = current.groupBy("blob").agg(F.map_from_entries(F.collect_list(F.struct("rule", "spans"))).alias("_found"))
    no_spans = F.array().cast("array<struct<start:int,end:int>>")
    found = F.array(*[
        F.struct(F.lit(r.kind).alias("kind"), F.coalesce(F.col("_found")[r.kind], no_spans).alias("spans")) for r in rules])
    findings = versions.join(by_blob, "blob", "left").select(F.col("_path").alias(id_col), "blob", found.alias("found"))
    return known, findings


def joined_spans(found: Column, order: tuple[str, ...]) -> Column:
    """``kind:start:end`` by start, then kind as listed, comma-joined."""
    rank = F.create_map(*[x for i, k in enumerate(order) for x in (F.lit(k), F.lit(i))])
    own = F.filter(found, lambda f: F.array_contains(F.lit(list(order)), f["kind"]))
    flat = F.flatten(F.transform(own, lambda f: F.transform(f["spans"], lambda s: F.struct(
        s["start"].alias("start"), rank[f["kind"]].alias("rank"), s["end"].alias("end"), f["kind"].alias("kind")))))
    return F.array_join(F.transform(F.array_sort(flat), lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
