"""Secret scans over a ledger of content-addressed blobs.

Every historical version of every path is one row (path columns, text). A
version's content address is the SHA-256 of its text, so a text that occurs at a
thousand paths is one blob. The ledger remembers which (blob, rule, rule version)
pairs were scanned; a scan looks only at pairs that are not in it, appends what
it found, and findings are joined back to all paths of a blob. A new version of
one rule rescans the known blobs for that rule alone.

Everything is built-in DataFrame functions. A match's place comes from the
lengths of the pieces between matches (`split`) and of the matches themselves
(`regexp_extract_all`), summed in order by a window over one blob's matches.

Defined results: a null text is the empty text; null or repeated paths are kept
row by row; an empty table gives an empty ledger entry and no rows; other columns
of the input are ignored and may have any names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from corpusloom.session import Workspace


@dataclass(frozen=True)
class Rule:
    """A pattern whose matches count if group `value` has `least` characters.

    Raising `version` makes every known blob unseen for this rule.
    """

    kind: str
    version: int
    pattern: str
    value: int
    least: int


# The patterns of the three kinds of secrets, in the order in
# which kinds are listed. The lookbehinds only keep the scan from trying the
# inner places of a run; they match what the plain patterns match.
RULES = (
    Rule(
        "assign",
        1,
        r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
        r"|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
        r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}", 0, 20),
    Rule("hex", 1, r"(?<![0-9a-f])[0-9a-f]{24,}", 0, 24),
)

_SCANNED = "blob_id binary, kind string, rule_version int"
_FOUND = "blob_id binary, kind string, rule_version int, start long, end long"


class Ledger:
    """The two growing tables of a scan below one shared folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _read(self, name: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def scanned(self) -> DataFrame:
        """One row per pair of a blob and a rule version that was looked at."""
        return self._read("scanned", _SCANNED).distinct()

    def findings(self) -> DataFrame:
        """Spans in code points, end exclusive; one row per secret of a blob."""
        return self._read("findings", _FOUND).distinct()

    def append(self, findings: DataFrame, scanned: DataFrame) -> None:
        """Findings first: a run cut off in between is scanned again, and the
        repeated findings are equal rows, which reading removes."""
        findings.write.mode("append").parquet(f"{self.root}/findings")
        scanned.write.mode("append").parquet(f"{self.root}/scanned")


def content_address(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def _lengths(array: Column) -> Column:
    return F.transform(array, lambda x: F.length(x).cast("long"))


def _matches(text: Column, rule: Rule, wanted: Column) -> Column:
    """Lengths that place the matches of one rule, or null where there is none."""
    pattern = F.lit(rule.pattern)
    found = F.struct(
        F.lit(rule.kind).alias("kind"),
        F.lit(rule.version).alias("rule_version"),
        _lengths(F.split(text, rule.pattern)).alias("gaps"),
        _lengths(F.regexp_extract_all(text, pattern, F.lit(0))).alias("sizes"),
        _lengths(F.regexp_extract_all(text, pattern, F.lit(rule.value))).alias("values"),
    )
    return F.when(wanted & text.rlike(rule.pattern), found)


def scan(versions: DataFrame, path: list[str], text: str, ledger: Ledger, rules=RULES) -> None:
    """Scan what the ledger has not seen of `versions` and append it there."""
    spark = versions.sparkSession
    work = Workspace(spark)
    rows = versions.select(
        F.struct(*[F.col(c).alias(f"p{i}") for i, c in enumerate(path)]).alias("path"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    ).withColumn("blob_id", content_address(F.col("text")))
    # A blob's text is read at its first path; the minimum is combined map-side.
    # The keys are read again from the saved table, so the texts are hashed twice
    # but never gathered by blob.
    first = rows.groupBy("blob_id").agg(F.min("path").alias("path"))
    wanted = F.explode(
        F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("rule_version")) for r in rules])
    )
    unseen = work.save(
        first.select("blob_id", "path", wanted.alias("rule"))
        .select("blob_id", "path", "rule.*")
        .join(ledger.scanned(), ["blob_id", "kind", "rule_version"], "left_anti"),
        "unseen",
    )
    todo = unseen.groupBy("blob_id", "path").agg(F.collect_set("kind").alias("todo"))
    keys = [F.hash("blob_id").alias("part"), "blob_id", "path", "todo"]
    todo = todo.select(*keys).withColumnsRenamed({"blob_id": "b", "path": "p"})
    texts = rows.join(todo, (rows.blob_id == todo.b) & rows.path.eqNullSafe(todo.p), "inner")
    per_rule = F.array(
        *[_matches(F.col("text"), r, F.array_contains("todo", r.kind)) for r in rules]
    )
    found = work.save(
        texts.select("blob_id", F.explode(F.filter(per_rule, lambda m: m.isNotNull())).alias("m")),
        "matches",
    )
    one = (
        found.dropDuplicates(["blob_id", "m"])
        .select("blob_id", "m.kind", "m.rule_version", F.posexplode(F.arrays_zip("m.gaps", "m.sizes", "m.values")))
        .where(F.col("col.sizes").isNotNull())
    )
    order = Window.partitionBy("blob_id", "kind", "rule_version").orderBy("pos")
    end = F.sum(F.col("col.gaps") + F.col("col.sizes")).over(order)
    least = F.create_map(*[F.lit(x) for r in rules for x in (r.kind, r.least)])
    findings = (
        one.withColumn("end", end)
        .where(F.col("col.values") >= least[F.col("kind")])
        .select(
            "blob_id",
            "kind",
            "rule_version",
            (F.col("end") - F.col("col.sizes")).alias("start"),
            "end",
        )
    )
    ledger.append(findings, unseen.drop("path"))
    work.clear()


def spans_by_version(
    versions: DataFrame, path: list[str], text: str, ledger: Ledger, rules=RULES
) -> DataFrame:
    """The path columns of every version with `spans`, an array of
    (start, place, kind, end) sorted by start, then by the kind's place in `rules`."""
    known = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r.kind, i)])
    current = F.create_map(*[F.lit(x) for r in rules for x in (r.kind, r.version)])
    spans = (
        ledger.findings()
        .where(F.col("rule_version") == current[F.col("kind")])
        .groupBy("blob_id")
        .agg(
            F.array_sort(
                F.collect_list(F.struct("start", known[F.col("kind")].alias("place"), "kind", "end"))
            ).alias("spans")
        )
    )
    paths = versions.select(
        *[F.col(c).alias(c) for c in path], content_address(F.col(text)).alias("blob_id")
    )
    return paths.join(spans, "blob_id", "left").drop("blob_id")


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined; the empty string for none."""
    each = F.transform(
        F.coalesce(spans, F.array()),
        lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string")),
    )
    return F.array_join(each, ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(F.coalesce(spans, F.array()), lambda s: s.kind == kind)).cast("long")
