"""Secret scans over an incremental blob ledger, with DataFrame functions only.

Every version of every path is addressed by the SHA-256 of its text.  The
ledger is a table (blob, rules, spans): which rule versions have scanned a
blob, and what they found.  ``update_ledger`` scans a blob once however many
paths have it, and only by the rule versions that the ledger lacks for it;
``findings`` joins the ledger back to all paths.  A rule whose pattern changes
gets a new version and is scanned anew; others are not.

Copies of a blob are dropped in each task before the shuffle (partial
aggregation), so a blob that fills a third of the table costs a row per task.
Only blobs with findings take part in the join back to paths.

A ledger that exists is asked with the blobs' digests alone; while the unseen
ones are few, texts of seen blobs are dropped before any shuffle.

Positions without a UDF: ``split`` gives the gaps between matches and
``regexp_extract_all`` the matches; running lengths are code-point positions.
Both run only where the pattern occurs at all.

The ledger is appended to in one Spark write; a write that is repeated adds
equal spans, which ``findings`` counts once.

Defined cases: NULL is the empty text and has no finding; repeated rows each
get a row; an empty table gives no rows; other columns are ignored (findings)
or passed through (redact).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hitlens.llm.common import fresh
from hitlens.session import remove_dir, shared_dir


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern``, leftmost and non-overlapping; those whose ``group`` is shorter are dropped."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 0

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


BASE_RULES = (
    Rule("assign", 1, r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", 1, r"[0-9a-f]{24,}"),  # whole runs: the same as runs of any length of which short ones are dropped
)
#: What may stand between the base64 runs of a key: white space, escapes and the marks of quotes and comments.
_BETWEEN = r"""[\s\\"'>|,*#]"""
#: A private key from its BEGIN line on: header lines, then all up to the END line; where that is missing, the runs of
#: base64 as far as they go, the last of which may be short.  Possessive, so that a text is read a fixed number of times.
PEM = (r"-----BEGIN [A-Z ]*PRIVATE KEY-----"
       rf"(?:{_BETWEEN}++[A-Za-z][A-Za-z0-9-]*+:\x20?+[^\s\\]*+)*+"
       r"""(?:[A-Za-z0-9+/=\s\\"'>|,*#]*+-----END [A-Z ]*PRIVATE KEY-----"""
       rf"|(?:{_BETWEEN}*+[A-Za-z0-9+/]{{16,}}+={{0,2}}+)++"
       rf"(?:{_BETWEEN}++[A-Za-z0-9+/]++={{0,2}}+(?![^\s\\\"'>|,*#-]))?+"
       r"|)")
MORE_RULES = (
    Rule("pem", 2, PEM),
    Rule("github", 1, r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", 1, r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)
RULES = BASE_RULES + MORE_RULES
_SPAN = "struct<rule: string, kind: string, start: bigint, end: bigint>"
MASK = "[SECRET]"
#: Up to so many unseen blobs (a digest and rule names each) are sent to all tasks, which drop seen texts unshuffled.
UNSEEN_SENT = 50_000


def blob_of(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def spans_of(text: Column, rule: Rule) -> Column:
    """array<rule, kind, start, end> of one rule; code points, end exclusive."""
    none = F.array().cast(f"array<{_SPAN}>")
    hits = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    gaps = F.transform(F.split(text, rule.pattern, -1), lambda gap: F.length(gap).cast("long"))
    parts = F.zip_with(gaps, hits, lambda gap, hit: F.struct(gap.alias("gap"), hit.alias("hit")))

    def add(done: Column, part: Column) -> Column:
        start = done["at"] + part["gap"]
        end = start + F.coalesce(F.length(part["hit"]).cast("long"), F.lit(0))  # the last gap has no match
        wanted = part["hit"].isNotNull()
        if rule.least:
            value = F.regexp_extract(part["hit"], rule.pattern, rule.group)
            wanted = wanted & (F.length(value) >= rule.least)
        span = F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.kind).alias("kind"),
                        start.alias("start"), end.alias("end")).cast(_SPAN)
        return F.struct(end.alias("at"), F.when(wanted, F.concat(done["found"], F.array(span)))
                        .otherwise(done["found"]).alias("found"))

    first = F.struct(F.lit(0).cast("long").alias("at"), none.alias("found"))
    return F.when(text.rlike(rule.pattern), F.aggregate(parts, first, add, lambda done: done["found"])).otherwise(none)


def _ledger(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def update_ledger(spark: SparkSession, versions: DataFrame, path: str, rules: tuple[Rule, ...] = RULES,
                  text_col: str = "text") -> None:
    """Scan the (blob, rule version) pairs of ``versions`` that the ledger at ``path`` lacks."""
    every = F.array(*(F.lit(r.name) for r in rules))
    blobs = versions.select(blob_of(F.col(text_col)).alias("blob"), F.coalesce(text_col, F.lit("")).alias("text"))
    known = _ledger(spark, path)
    if known is None:
        todo = blobs.dropDuplicates(["blob"]).withColumn("todo", every)
    else:
        seen = known.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("seen"))
        wanted = (blobs.select("blob").distinct().join(seen, "blob", "left")
                  .withColumn("todo", F.when(F.col("seen").isNull(), every).otherwise(F.array_except(every, "seen")))
                  .where(F.size("todo") > 0).select("blob", "todo"))
        asked = shared_dir(spark, "secret-todo")
        wanted.write.parquet(asked)
        wanted = spark.read.parquet(asked)
        if wanted.limit(UNSEEN_SENT + 1).count() <= UNSEEN_SENT:
            todo = blobs.join(F.broadcast(wanted), "blob").dropDuplicates(["blob"])
        else:
            todo = blobs.dropDuplicates(["blob"]).join(wanted, "blob")
    none = F.array().cast(f"array<{_SPAN}>")
    spans = (F.when(F.array_contains("todo", r.name), spans_of(F.col("text"), r)).otherwise(none) for r in rules)
    todo.select("blob", F.col("todo").alias("rules"), F.concat(*spans).alias("spans")).write.mode("append").parquet(path)
    if known is not None:
        remove_dir(spark, asked)


def found_blobs(spark: SparkSession, path: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, spans) of the blobs in which ``rules`` have found something; by start, then kind as listed."""
    names, kinds = [r.name for r in rules], F.array(*(F.lit(r.kind) for r in rules))
    wanted = F.filter("spans", lambda s: s["rule"].isin(names))
    ranked = F.transform(F.array_distinct(F.flatten(F.collect_list("wanted"))), lambda s: F.struct(
        s["start"].alias("start"), F.array_position(kinds, s["kind"]).alias("rank"),
        s["kind"].alias("kind"), s["end"].alias("end")))
    return (spark.read.parquet(path).select("blob", wanted.alias("wanted")).where(F.size("wanted") > 0)
            .groupBy("blob").agg(F.array_sort(ranked).alias("spans")))


def findings(spark: SparkSession, versions: DataFrame, path: str | None = None, rules: tuple[Rule, ...] = RULES,
             keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """``keep`` columns and spans array<start, rank, kind, end> of every version.

    ``path`` is the ledger's folder; None starts a new one below the shared folder.
    """
    path = path or shared_dir(spark, "secret-ledger")
    update_ledger(spark, versions, path, rules, text_col)
    found = found_blobs(spark, path, rules)
    blob, spans = fresh([*keep, "spans"], "blob", "found")
    paths = versions.select(*keep, blob_of(F.col(text_col)).alias(blob))
    empty = F.array().cast(found.schema["spans"].dataType)
    return (paths.join(found.withColumnsRenamed({"blob": blob, "spans": spans}), blob, "left")
            .select(*keep, F.coalesce(spans, empty).alias("spans")))


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def masked(text: Column, spans: Column) -> Column:
    """The text with every (merged) span replaced by ``MASK``; ``spans`` are sorted by start."""
    def step(done: Column, s: Column) -> Column:
        before = F.substr(text, (done["at"] + 1).cast("int"), (s["start"] - done["at"]).cast("int"))
        return F.when(s["end"] <= done["at"], done).otherwise(F.struct(
            s["end"].alias("at"),
            F.when(s["start"] < done["at"], done["out"])
            .otherwise(F.concat(done["out"], before, F.lit(MASK))).alias("out")))

    first = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    return F.aggregate(spans, first, step, lambda done: F.concat(
        done["out"], F.substr(text, (done["at"] + 1).cast("int"), F.length(text))))


def redact(spark: SparkSession, docs: DataFrame, path: str | None = None, rules: tuple[Rule, ...] = RULES,
           text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with the secrets of ``text_col`` masked and ``length_col`` (code points) set anew where one was."""
    path = path or shared_dir(spark, "secret-ledger")
    update_ledger(spark, docs, path, rules, text_col)
    blob, spans = fresh(docs.columns, "blob", "spans")
    found = found_blobs(spark, path, rules).withColumnsRenamed({"blob": blob, "spans": spans})
    text = F.when(F.col(spans).isNotNull(), masked(F.col(text_col), F.col(spans))).otherwise(F.col(text_col))
    out = (docs.withColumn(blob, blob_of(F.col(text_col))).join(found, blob, "left")
           .withColumn(text_col, text))
    if length_col in docs.columns:
        kind = docs.schema[length_col].dataType
        out = out.withColumn(length_col, F.when(F.col(spans).isNotNull(), F.length(text_col).cast(kind))
                             .otherwise(F.col(length_col)))
    return out.select(*docs.columns)
