"""Secret scans over an incremental ledger of text blobs.

Every version of every text is addressed by its SHA-256. A blob is scanned once for a rule set's
version: the ledger, a Parquet table that only grows, holds the (blob, rule_version) pairs already
scanned, with their findings, and only unseen pairs are scanned. Findings are then read from the
ledger and joined back to all rows (paths) that hold the blob.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.llm.common import cut, per_batch, table, unused
from tidelake.session import shared_dir

#: Kinds in the order that breaks ties between spans with one start.
KINDS = ("assign", "access", "hex", "github", "jwt", "private_key")
BASE = KINDS[:3]


@dataclass(frozen=True)
class Rule:
    """One kind of secret; kept if the checked group has at least so many characters."""

    kind: str
    pattern: str
    least: int
    group: int = 0
    any_case: bool = False
    #: A text whose lower case has none of these substrings has no match.
    needs: tuple[str, ...] = ("",)


#: version -> rules. A new version is scanned beside the old ones; their results stay valid.
RULES: dict[str, tuple[Rule, ...]] = {
    "base-1": (
        Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 2, True, ("password", "passwd", "secret", "token", "apikey", "api_key")),
        Rule("access", r"AKIA[A-Z0-9]+", 18, needs=("akia",)),
        Rule("hex", r"[0-9a-f]{16,}", 16),
    ),
    "more-1": (
        Rule("github", r"\bgh[pousr]_[A-Za-z0-9]{36,}", 40, needs=("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
        Rule("jwt", r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 30, needs=("eyj",)),
        Rule("private_key", r"-----BEGIN [A-Z ]{0,32}PRIVATE KEY-----", 20, needs=("private key-----",)),
    ),
}
LEDGER = "blob binary, rule_version string, findings array<struct<start:int,kind:string,end:int>>"


def find(text: str, version: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of a rule set's matches in code points, end exclusive."""
    return _Scanner()(text, version)


class _Scanner:
    def __init__(self) -> None:
        self.rules = {v: [(r, re.compile(r.pattern, re.ASCII | re.IGNORECASE * r.any_case)) for r in rules] for v, rules in RULES.items()}

    def __call__(self, text: str, version: str) -> list[tuple[int, str, int]]:
        found, low = [], text.lower()
        for rule, pattern in self.rules[version]:
            if any(x in low for x in rule.needs):
                found += [(m.start(), rule.kind, m.end()) for m in pattern.finditer(text) if m.end(rule.group) - m.start(rule.group) >= rule.least]
        return sorted(found, key=lambda x: (x[0], KINDS.index(x[1])))


_FOUND = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.string()), ("end", pa.int32())]))


def _scan():
    scanner = _Scanner()

    def each(batch: pa.RecordBatch) -> dict:
        blobs, versions, found = [], [], []
        for blob, text, unseen in zip(*(batch[n].to_pylist() for n in ("blob", "text", "unseen"))):
            for version in unseen:
                blobs.append(blob)
                versions.append(version)
                found.append([dict(zip(("start", "kind", "end"), x)) for x in scanner(text or "", version)])
        return {"blob": blobs, "rule_version": versions, "findings": found}

    return each


def blob_of(text: str) -> Column:
    """The content address of a text; null is the empty text."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def unseen(docs: DataFrame, ledger: DataFrame | None = None) -> DataFrame:
    """Rows of LEDGER for the pairs of docs that ledger lacks.

    docs: doc_id, text (other columns are left alone). A null text is the empty blob. Repeated rows
    and copies share a blob, which is scanned once. One row stands for a blob (the smallest doc_id,
    null first), so a third of all rows may be copies of one text: they meet as ids, partly
    aggregated, never as texts.
    """
    rows = docs.select("doc_id", "text", blob_of("text").alias("blob"))
    versions = F.array(*(F.lit(v) for v in RULES))
    first = rows.groupBy("blob").agg(F.min(F.coalesce("doc_id", F.lit(-(2**63)))).alias("stands"))
    if ledger is not None:
        seen = ledger.groupBy("blob").agg(F.collect_set("rule_version").alias("seen"))
        first = first.join(seen, "blob", "left").withColumn("unseen", F.array_except(versions, F.coalesce("seen", F.array().cast("array<string>"))))
    else:
        first = first.withColumn("unseen", versions)
    first = first.where(F.size("unseen") > 0).select("blob", "stands", "unseen")
    return (
        rows.select(F.coalesce("doc_id", F.lit(-(2**63))).alias("stands"), "blob", "text")
        .join(first, ["blob", "stands"])
        .select("blob", "text", "unseen")
        .mapInArrow(per_batch(_scan, pa.schema([("blob", pa.binary()), ("rule_version", pa.string()), ("findings", _FOUND)])), LEDGER)
        .dropDuplicates(["blob", "rule_version"])  # rows repeated whole are scanned twice
    )


def scan_unseen(docs: DataFrame, ledger: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(paths, ledger): doc_id and blob of every row, and the ledger with all pairs those rows need."""
    new = unseen(docs, ledger)
    paths = docs.select("doc_id", blob_of("text").alias("blob"))
    return paths, new if ledger is None else ledger.select("blob", "rule_version", "findings").unionByName(new)


def ledger_at(spark: SparkSession, path: str) -> DataFrame | None:
    """The ledger written at path, or None where there is none yet."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return None
    return spark.read.schema(LEDGER).parquet(path)


def update_ledger(docs: DataFrame, path: str) -> DataFrame:
    """Scans the pairs of docs that the ledger at path has not seen and appends them; gives the whole ledger.

    A run that is cut short appends nothing (Parquet commits at the end), and one that is run again
    finds nothing unseen.
    """
    unseen(docs, ledger_at(docs.sparkSession, path)).write.mode("append").parquet(path)
    return ledger_at(docs.sparkSession, path)


def findings_by_path(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, blob, findings (start, kind, end; sorted) of every row of docs, without findings too.

    path: where the ledger is, or begins; a new one in the shared folder if None. Findings of all versions in RULES are given. A blob that a
    third of all rows hold meets its findings in a join that Spark can split.
    """
    known = update_ledger(docs, path or f"{shared_dir(docs.sparkSession)}/secret-ledger-{uuid.uuid4().hex}")
    paths = docs.select("doc_id", blob_of("text").alias("blob"))
    known = known.where((F.size("findings") > 0) & F.col("rule_version").isin(*RULES))
    known = known.dropDuplicates(["blob", "rule_version"])  # two runs at once may append a pair twice
    order = F.create_map(*(x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))))
    by_blob = known.groupBy("blob").agg(F.flatten(F.collect_list("findings")).alias("f"))
    by_blob = cut(by_blob.select("blob", F.array_sort(F.transform("f", lambda x: F.struct(x["start"].alias("start"), order[x["kind"]].alias("rank"), x["end"].alias("end"), x["kind"].alias("kind")))).alias("findings")))
    return paths.join(by_blob, "blob", "left").select("doc_id", "blob", F.coalesce("findings", F.array().cast(by_blob.schema["findings"].dataType)).alias("findings"))


def redact(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """docs with every found span of text replaced by mark, and n_chars counted anew if it is there.

    Overlapping spans are one. All other columns and rows stay, null texts too. Rows meet their
    findings by content, so rows without a doc_id are redacted like any other.
    """
    known = unseen(docs)
    blob, held = unused(docs.columns, "__blob"), unused(docs.columns, "__spans")
    spans = known.where(F.size("findings") > 0).groupBy("blob").agg(F.flatten(F.collect_list("findings")).alias(held))
    spans = cut(spans.select(F.col("blob").alias(blob), held))
    found = docs.withColumn(blob, blob_of("text")).join(spans, blob, "left")
    ordered = F.array_sort(F.transform(held, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))))
    state = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    step = lambda a, x: F.struct(
        F.when(x["start"] >= a["at"], F.concat(a["out"], F.col("text").substr(a["at"] + 1, x["start"] - a["at"]), F.lit(mark))).otherwise(a["out"]).alias("out"),
        F.greatest(a["at"], x["end"]).alias("at"),
    )
    clean = F.aggregate(ordered, state, step, lambda a: F.concat(a["out"], F.col("text").substr(a["at"] + 1, F.length("text"))))
    out = found.withColumn("text", F.when(F.col(held).isNull(), F.col("text")).otherwise(clean))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(held).isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return out.select(*docs.columns)


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and spans of secrets in every text of documents (the contract's digest columns), through a new ledger."""
    found = findings_by_path(table(spark, sf_dir, "documents"))
    said = lambda kinds: F.array_join(F.transform(F.filter("findings", lambda x: x["kind"].isin(*kinds)), lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    count = lambda kind: F.size(F.filter("findings", lambda x: x["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *(count(k).alias(f"n_{k}") for k in BASE),
        F.sha2(said(BASE).cast("binary"), 256).alias("base_sha256"),
        said(KINDS).alias("spans"),
        F.lower(F.hex("blob")).alias("blob"),
    )


def _found_sql(rule: Rule, rank: int) -> str:
    """Rows (r, rank, kind, s, e) of a rule: starts are what is between earlier matches plus those matches."""
    pattern = "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in "password|passwd|secret|token|api_?key") if rule.any_case else ""
    pattern = (f"({pattern})" + rule.pattern.partition(")")[2] if rule.any_case else rule.pattern).replace("'", "''")
    return f"""SELECT r, {rank} AS rank, '{rule.kind}' AS kind, s, s + length(ms[i]) AS e FROM (
      SELECT r, ms, gs, i, CAST(list_sum(list_transform(ps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS s FROM (
        SELECT r, ms, gs, ps, unnest(generate_series(1, len(ms))) AS i FROM (
          SELECT r, regexp_extract_all(t, '{pattern}') AS ms, regexp_extract_all(t, '{pattern}', {rule.group}) AS gs, string_split_regex(t, '{pattern}') AS ps FROM d))) WHERE length(gs[i]) >= {rule.least}"""


OP10_SQL = (
    "WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents), f AS ("
    + " UNION ALL ".join(_found_sql(rule, KINDS.index(rule.kind)) for rules in RULES.values() for rule in rules)
    + """), g AS (SELECT r, count(*) FILTER (WHERE rank = 0) AS n_assign, count(*) FILTER (WHERE rank = 1) AS n_access, count(*) FILTER (WHERE rank = 2) AS n_hex,
  string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank, e) FILTER (WHERE rank < 3) AS base, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank, e) AS spans FROM f GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, sha256(t) AS blob FROM d LEFT JOIN g USING (r)"""
)
