"""Incremental secret scanning over a content-addressed blob ledger.

Every version of every path is addressed by the SHA-256 of its text. A scan
looks only at (blob, rule version) pairs that the ledger does not hold yet,
appends its findings to the ledger, and joins the findings of each blob back to
all paths and versions that contain it. Everything here is DataFrame code.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage_table
from .filters import BitFilter


@dataclass(frozen=True)
class Rule:
    """One kind of secret.

    pattern: a Java regular expression that never matches the empty string.
    least: code points that ``group`` of a match must have for a finding.
    version: raise it when the pattern changes; the ledger then rescans.
    """

    kind: str
    pattern: str
    least: int
    group: int = 0
    version: int = 1
    base: bool = False


# The base patterns that the result contract names.
ASSIGN = (
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
BASE_RULES = (
    Rule("assign", ASSIGN, 12, group=2, base=True),
    Rule("access", r"AKIA[A-Z0-9]+", 18, base=True),
    Rule("hex", r"[0-9a-f]{16,}", 16, base=True),
)
# Kinds beyond the base: key blocks, signed tokens and prefixed platform tokens.
EXTRA_RULES = (
    Rule("keyblock", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", 1),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 1),
    Rule("platform", r"(?:gh[pousr]_[A-Za-z0-9]{36}|xox[abpr]-[A-Za-z0-9-]{10,})", 1),
)
RULES = BASE_RULES + EXTRA_RULES

FINDING = "struct<start:bigint,rank:int,end:bigint,kind:string>"
_CHUNK = 256


def _running_starts(lengths: Column) -> Column:
    """Exclusive prefix sums of an array of longs, in chunks so that long arrays stay near linear."""
    zero = F.lit(0).cast("long")
    chunks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / _CHUNK).cast("int")),
        lambda c: F.slice(lengths, c * _CHUNK + 1, F.lit(_CHUNK)),
    )

    def scan(values: Column) -> Column:
        return F.aggregate(
            values,
            F.struct(zero.alias("sum"), F.array().cast("array<bigint>").alias("out")),
            lambda acc, x: F.struct((acc["sum"] + x).alias("sum"), F.array_append(acc["out"], acc["sum"]).alias("out")),
        )["out"]

    totals = F.transform(chunks, lambda c: F.aggregate(c, zero, lambda a, x: a + x))
    return F.flatten(
        F.zip_with(chunks, scan(totals), lambda c, before: F.transform(scan(c), lambda s: s + before))
    )


def rule_findings(text: Column, rule: Rule, rank: int) -> Column:
    """Findings of one rule in a text: leftmost, non-overlapping, code points, end exclusive."""
    pattern = F.lit(rule.pattern)
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    gaps = F.transform(F.split(text, rule.pattern, -1), lambda g: F.length(g).cast("long"))
    sizes = F.transform(matches, lambda m: F.length(m).cast("long"))
    # gap 0, match 0, gap 1, match 1, ...: a match starts after all gaps up to its own and all earlier matches
    before = _running_starts(F.zip_with(F.slice(gaps, 1, F.size(matches)), sizes, lambda g, m: g + m))
    spans = F.zip_with(
        F.zip_with(F.slice(gaps, 1, F.size(matches)), before, lambda g, b: g + b),
        matches,
        lambda s, m: F.struct(
            s.alias("start"), F.lit(rank).alias("rank"), (s + F.length(m)).alias("end"), F.lit(rule.kind).alias("kind"), m.alias("m")
        ),
    )
    size = (lambda m: F.length(F.regexp_extract(m, rule.pattern, rule.group))) if rule.group else F.length
    kept = F.transform(F.filter(spans, lambda s: size(s["m"]) >= rule.least), lambda s: s.dropFields("m"))
    return F.when(text.rlike(rule.pattern), kept).otherwise(F.array()).cast(f"array<{FINDING}>")


def scan_blobs(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per blob and rule: blob_id, rule_kind, rule_version, findings (often an empty array)."""
    pairs = F.array(
        *[
            F.struct(
                F.lit(r.kind).alias("rule_kind"), F.lit(r.version).alias("rule_version"), rule_findings(F.col("blob_text"), r, k).alias("findings")
            )
            for k, r in enumerate(rules)
        ]
    )
    return blobs.select("blob_id", F.inline(pairs))


def address(versions: DataFrame, text: str = "text") -> Column:
    """Content address of a version; a null text is the empty blob."""
    return F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)


def scan(versions: DataFrame, text: str = "text", ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame, DataFrame]:
    """Scan the (blob, rule version) pairs that the ledger lacks; return (findings by blob, the new ledger entries).

    ledger: earlier entries (blob_id, rule_kind, rule_version, findings) or None
    for an empty one; entries of other blobs are left aside, and repeated ones
    count once. The new entries are a table in the shared folder; append it
    to the ledger. Rules without findings in a blob are recorded too, so no blob
    is scanned twice for a version of a rule. First result: blob_id and findings
    (all kinds, by start and then by the order of ``rules``) of the blobs that
    have any, also a table in the shared folder.
    """
    addressed = versions.select(address(versions, text).alias("blob_id"), F.coalesce(F.col(text), F.lit("")).alias("blob_text"))
    ids = stage_table(addressed.groupBy("blob_id").agg(F.count("*").alias("n")))
    current = F.struct("rule_kind", "rule_version").isin([F.struct(F.lit(r.kind), F.lit(r.version)) for r in rules])
    known = None
    special = ids.where("n > 1").select("blob_id")
    if ledger is not None:
        own = ledger.where(current).join(ids, "blob_id", "left_semi").select("blob_id", "rule_kind", "rule_version", "findings")
        known = stage_table(own.dropDuplicates(["blob_id", "rule_kind", "rule_version"]))
        special = special.unionByName(known.select("blob_id")).distinct()
    # texts of blobs that are new and occur once are scanned where they stand; only the others move
    marked = BitFilter(special, "blob_id").mark(addressed, "blob_id")
    # first() pre-aggregates in each task, so copies of one blob never meet in one place
    moved = marked.where("maybe").groupBy("blob_id").agg(F.first("blob_text").alias("blob_text"))
    if known is None:
        fresh = scan_blobs(moved, rules)
    else:
        seen = known.groupBy("blob_id").agg(F.collect_set(F.concat_ws("@", "rule_kind", "rule_version")).alias("seen"))
        todo = moved.join(seen, "blob_id", "left").where(F.coalesce(F.size("seen"), F.lit(0)) < len(rules))
        parts = []
        for k, r in enumerate(rules):
            unseen = ~F.coalesce(F.array_contains("seen", f"{r.kind}@{r.version}"), F.lit(False))
            findings = F.when(unseen, rule_findings(F.col("blob_text"), r, k))
            parts.append(F.struct(F.lit(r.kind).alias("rule_kind"), F.lit(r.version).alias("rule_version"), findings.alias("findings")))
        fresh = todo.select("blob_id", F.inline(F.array(*parts))).where(F.col("findings").isNotNull())
    fresh = stage_table(scan_blobs(marked.where("NOT maybe"), rules).unionByName(fresh))
    entries = fresh if known is None else fresh.unionByName(known)
    order = F.create_map(*[F.lit(x) for k, r in enumerate(rules) for x in (r.kind, k)])
    found = (
        entries.where(F.size("findings") > 0)
        .select("blob_id", F.transform("findings", lambda f: f.withField("rank", order[f["kind"]])).alias("findings"))
        .groupBy("blob_id")
        .agg(F.array_sort(F.flatten(F.collect_list("findings"))).alias("findings"))
    )
    return stage_table(found), fresh


def scan_versions(
    versions: DataFrame, key: str, text: str = "text", ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES
) -> tuple[DataFrame, DataFrame]:
    """Findings of every version, joined back from its blob, and the new ledger entries (see ``scan``).

    versions: one row per historical version of a path, named by ``key``. Nulls
    in ``key`` or ``text`` are kept (a null text is empty); repeated rows each
    get their findings; other columns are ignored. First result: ``key``,
    blob_id, findings, one row per row of ``versions``.
    """
    found, fresh = scan(versions, text, ledger, rules)
    # Both sides are exchanged for the join, so a hot blob's paths are split by adaptive execution.
    joined = versions.select(key, address(versions, text).alias("blob_id")).join(found, "blob_id", "left")
    return joined.select(key, "blob_id", F.coalesce("findings", F.array().cast(f"array<{FINDING}>")).alias("findings")), fresh


def without_secrets(docs: DataFrame, text: str = "text", length: str | None = "n_chars", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The documents with every found span redacted, and their new length; all rows and columns stay.

    length: a column that holds the number of code points; without such a column
    there is nothing to change. Documents without findings stay where they are.
    """
    found, _ = scan(docs, text, None, rules)
    rows = docs.select(F.struct("*").alias("row"), address(docs, text).alias("blob_id"))
    marked = BitFilter(found, "blob_id").mark(rows, "blob_id")
    hit = marked.where("maybe").join(found, "blob_id", "left")
    new = F.when(F.size("findings") > 0, redact(F.col("row")[text], F.col("findings"))).otherwise(F.col("row")[text])
    hit = hit.select("row", "findings", new.alias("new"))
    row = F.col("row").withField(text, F.col("new"))
    if length in docs.columns:
        size = F.when(F.size("findings") > 0, F.length("new").cast(docs.schema[length].dataType)).otherwise(F.col("row")[length])
        row = row.withField(length, size)
    return marked.where("NOT maybe").select("row").unionByName(hit.select(row.alias("row"))).select("row.*")


def span_list(findings: Column) -> Column:
    return F.array_join(F.transform(findings, lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"])), ",")


def base_report(by_key: DataFrame, key: str) -> DataFrame:
    """The digest columns of op1 from findings by key."""
    names = [r.kind for r in BASE_RULES]
    base = F.filter("findings", lambda f: f["kind"].isin(names))

    def count(kind: str) -> Column:
        return F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in names]
    return by_key.select(
        key, *counts, F.sha2(span_list(base).cast("binary"), 256).alias("base_sha256"), span_list(F.col("findings")).alias("spans")
    )


def redact(text: Column, findings: Column, mark: str = "[secret]") -> Column:
    """The text with every found span replaced by ``mark``; overlapping spans give one mark."""
    text = F.coalesce(text, F.lit(""))
    done = F.aggregate(
        findings,
        F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("pos")),
        lambda acc, f: F.when(
            f["start"] >= acc["pos"],
            F.struct(
                F.concat(acc["out"], text.substr((acc["pos"] + 1).cast("int"), (f["start"] - acc["pos"]).cast("int")), F.lit(mark)).alias("out"),
                f["end"].alias("pos"),
            ),
        ).otherwise(F.struct(acc["out"].alias("out"), F.greatest(acc["pos"], f["end"]).alias("pos"))),
    )
    return F.concat(done["out"], text.substr((done["pos"] + 1).cast("int"), F.length(text)))


def op1(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return base_report(scan_versions(docs, "doc_id")[0], "doc_id")
