"""Quality rules with risk-controlled cutoffs.

Rule scores of a text (higher is worse) are compared with cutoffs learned from a labelled holdout:
rows whose label says that the text is good. For each stratum and rule the cutoffs of a fixed grid
are tested from the loosest on, and the strictest is taken whose rate of falsely rejected good rows
is, by the exact binomial (Clopper-Pearson) bound, at most `risk`. Testing in that fixed order needs
no correction within a rule; across rules and strata the error `delta` is shared (Bonferroni), so
with probability 1 - delta every stratum's every rule rejects at most `risk` of its good rows.
A rule that can't be shown to be safe in a stratum rejects nothing there.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.llm.common import cut, per_batch, table

WINDOW = 5
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\r\x0b\x0c"
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Rule -> score Column over the measures; a text without words has score 0.
RULES = {
    "symbols": lambda: F.coalesce(F.col("n_symbols") / F.nullif("n_words", F.lit(0)), F.lit(0.0)),
    "dup_lines": lambda: F.coalesce(F.col("n_dup_lines") / F.nullif("n_lines", F.lit(0)), F.lit(0.0)),
    "upper": lambda: F.coalesce(F.col("n_upper") / F.nullif("word_chars", F.lit(0)), F.lit(0.0)),
    "repeats": lambda: F.coalesce(F.col("n_repeat_words") / F.nullif("n_words", F.lit(0)), F.lit(0.0)),
}
#: Cutoffs are tested at k / GRID for k from GRID down to 0; a score above the cutoff is rejected.
GRID = 200
_MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper")


def measures(text: str | None) -> tuple[int, ...]:
    """_MEASURES of one whole text; null has none of anything."""
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    n = len(words)
    chars = len(text) - sum(map(text.count, BLANKS))
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    repeated = 0
    if n > WINDOW:
        windows = list(zip(*(words[i:] for i in range(WINDOW))))
        if len(set(windows)) < len(windows):
            times = Counter(windows)
            again = np.fromiter((times[w] > 1 for w in windows), bool, len(windows))
            covered = np.zeros(n, bool)
            for i in range(WINDOW):
                covered[i : i + len(windows)] |= again
            repeated = int(covered.sum())
    upper = len(data) - len(data.translate(None, CAPITALS))
    return n, chars, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated, len(lines), upper


def _measure():
    def each(batch: pa.RecordBatch) -> dict:
        found = np.array([measures(t) for t in batch["text"].to_pylist()], np.int64).reshape(-1, len(_MEASURES))
        return {"doc_id": batch["doc_id"], "stratum": batch["stratum"]} | {m: found[:, i] for i, m in enumerate(_MEASURES)}

    return each


def most_errors(n: int, risk: float, level: float) -> int:
    """The largest k such that k of n has its exact upper bound at or under risk; -1 if none has.

    The bound is under risk just when P(Binomial(n, risk) <= k) <= level.
    """
    total, k = 0.0, -1
    log_p, log_q = math.log(risk), math.log1p(-risk)
    while k < n:
        i = k + 1
        total += math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * log_p + (n - i) * log_q)
        if total > level:
            break
        k = i
    return k


def _cell(rule: str) -> Column:
    """The grid cell of a score; cutoffs k / GRID with k under it reject the row."""
    return F.least(F.lit(GRID), F.ceil(F.col(rule) * GRID).cast("int"))


def cutoffs(scored: DataFrame, good: DataFrame, risk: float = 0.02, delta: float = 0.05) -> DataFrame:
    """stratum, rule, cutoff, n_good, n_rejected of the rules shown to be safe.

    scored: doc_id, stratum and a column for each rule. good: doc_id of the labelled good rows
    (repeats count once). Rows with a null id or stratum: a null id has no label, a null stratum is
    a stratum of its own. Empty inputs give no cutoff. Holdout rows are counted by grid cell before
    they meet, so a stratum comes as at most GRID + 1 rows for each rule.
    """
    held = scored.join(good.select("doc_id").distinct(), "doc_id", "left_semi")
    long = held.select("stratum", F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), _cell(r).alias("cell")) for r in RULES))).alias("x"))
    counts = cut(long.groupBy("stratum", "x.rule", "x.cell").count())
    tests = counts.select("stratum", "rule").distinct().count()

    def choose(cells: pd.DataFrame) -> pd.DataFrame:
        n = int(cells["count"].sum())
        at = np.bincount(cells["cell"], weights=cells["count"], minlength=GRID + 1)
        rejected = n - np.cumsum(at)  # by cutoff k: the rows of cells above k
        most = most_errors(n, risk, delta / tests)
        safe = GRID
        while safe > 0 and rejected[safe - 1] <= most:
            safe -= 1
        if most < 0:
            return pd.DataFrame(columns=["stratum", "rule", "cutoff", "n_good", "n_rejected"])
        return pd.DataFrame({"stratum": [cells["stratum"].iloc[0]], "rule": [cells["rule"].iloc[0]], "cutoff": [safe / GRID], "n_good": [n], "n_rejected": [int(rejected[safe])]})

    return counts.groupBy("stratum", "rule").applyInPandas(choose, "stratum string, rule string, cutoff double, n_good long, n_rejected long")


def judge(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = 0.02, delta: float = 0.05) -> DataFrame:
    """Measures, rule scores, the rules that reject, base_failed and kept for every row of docs.

    docs: doc_id, text, the stratum column; labels: doc_id, quality (1 is good). Null texts count as
    empty and fail the base rule. Repeated rows are judged alike. Texts are taken whole.
    """
    rows = docs.select("doc_id", "text", F.col(stratum).cast("string").alias("stratum"))
    schema = pa.schema([("doc_id", pa.int64()), ("stratum", pa.string()), *((m, pa.int64()) for m in _MEASURES)])
    measured = rows.mapInArrow(per_batch(_measure, schema), "doc_id long, stratum string, " + ", ".join(f"{m} long" for m in _MEASURES))
    scored = cut(measured).withColumns({r: make().cast("double") for r, make in RULES.items()})
    good = labels.where(F.col("quality") == 1)
    limits = cutoffs(scored, good, risk, delta).groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("limits"))
    joined = scored.alias("s").join(limits.alias("l"), F.col("s.stratum").eqNullSafe(F.col("l.stratum")), "left").select("s.*", "l.limits")
    over = F.array_compact(F.array(*(F.when(_cell(r) > F.round(F.col("limits")[r] * GRID), F.lit(r)) for r in RULES)))
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return joined.withColumn("base_failed", base).withColumn("rejected_by", over).withColumn("kept", ~F.col("base_failed") & (F.size("rejected_by") == 0))


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.array_join("rejected_by", ",").alias("rejected_by"))


OP1_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang AS stratum, coalesce(text, '') AS text FROM documents),
lists AS (SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS l FROM d),
ws AS (SELECT r, unnest(l) AS w, generate_subscripts(l, 1) AS i FROM lists),
ww AS (SELECT r, i, w || ' ' || lead(w, 1) OVER o || ' ' || lead(w, 2) OVER o || ' ' || lead(w, 3) OVER o || ' ' || lead(w, 4) OVER o AS g FROM ws WINDOW o AS (PARTITION BY r ORDER BY i)),
rep AS (SELECT r, i FROM ww WHERE g IS NOT NULL QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
cov AS (SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM rep, generate_series(0, 4) AS ks(k) GROUP BY r),
ls AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d),
lc AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM ls WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
wc AS (SELECT r, count(*) AS n_words, sum(length(w)) AS word_chars FROM ws GROUP BY r),
m AS (
  SELECT r, doc_id, stratum, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars, length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines, length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper
  FROM d LEFT JOIN wc USING (r) LEFT JOIN lc USING (r) LEFT JOIN cov USING (r)
),
sc AS (
  SELECT r, doc_id, stratum, 0 AS place, 'symbols' AS rule, coalesce(CAST(n_symbols AS DOUBLE) / nullif(n_words, 0), 0) AS s FROM m
  UNION ALL SELECT r, doc_id, stratum, 1, 'dup_lines', coalesce(CAST(n_dup_lines AS DOUBLE) / nullif(n_lines, 0), 0) FROM m
  UNION ALL SELECT r, doc_id, stratum, 2, 'upper', coalesce(CAST(n_upper AS DOUBLE) / nullif(word_chars, 0), 0) FROM m
  UNION ALL SELECT r, doc_id, stratum, 3, 'repeats', coalesce(CAST(n_repeat_words AS DOUBLE) / nullif(n_words, 0), 0) FROM m
),
ce AS (SELECT r, doc_id, stratum, place, rule, CAST(least(200, ceil(s * 200)) AS INTEGER) AS cell FROM sc),
held AS (SELECT stratum, rule, cell FROM ce WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)),
n AS (SELECT stratum, rule, count(*) AS n, count(*) OVER () AS tests FROM held GROUP BY stratum, rule),
logs AS (SELECT DISTINCT n, tests FROM n),
cdf AS (
  SELECT n, tests, i, sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(0.02e0) + (n - i) * ln(0.98e0))) OVER (PARTITION BY n, tests ORDER BY i) AS p
  FROM logs, LATERAL (SELECT unnest(generate_series(0, n)) AS i)
),
most AS (SELECT n, tests, max(i) AS most FROM cdf WHERE p <= 0.05e0 / tests GROUP BY 1, 2),
rej AS (SELECT n.stratum, n.rule, k, most, (SELECT count(*) FROM held h WHERE h.stratum IS NOT DISTINCT FROM n.stratum AND h.rule = n.rule AND h.cell > k) AS rejected FROM n JOIN most USING (n, tests), generate_series(0, 200) AS ks(k)),
cuts AS (SELECT stratum, rule, min(k) AS cutoff FROM rej WHERE rejected <= most GROUP BY 1, 2),
bad AS (SELECT r, string_agg(ce.rule, ',' ORDER BY place) AS rejected_by FROM ce JOIN cuts ON cuts.stratum IS NOT DISTINCT FROM ce.stratum AND cuts.rule = ce.rule WHERE cell > cutoff GROUP BY r)
SELECT doc_id, n_words, CAST(word_chars AS BIGINT) AS word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND rejected_by IS NULL AS kept, coalesce(rejected_by, '') AS rejected_by
FROM m LEFT JOIN bad USING (r)
"""
