"""Quality rules with risk-controlled thresholds.

Every document gets a few statistics of its whole text; a rule rejects what is above a cutoff. The cutoffs of all rules go from
loose to strict together, in ``LEVELS`` levels fixed beforehand, so that what a level rejects by any rule is rejected by all later
levels too. For each stratum (language) one level is picked on the labelled rows, so that with confidence 1 - delta over
all strata together at most ``alpha`` of the good documents of a stratum that pass the base rule are rejected by any rule:

* a level passes if P(Binomial(good rows, alpha) <= good rows rejected) <= delta / strata, the exact binomial (Clopper-Pearson)
  test with Bonferroni's correction over strata;
* inside a stratum levels are tested from the loosest, and testing stops at the first that fails, so no further correction is
  needed for the number of levels (fixed-sequence testing; levels are nested).

Strata with fewer good rows than even a level without a rejection would need are tested as one pooled stratum, and the guarantee is for
them together; the table of levels marks them as pooled, and has a null level where nothing passed.
A stratum without labels or level keeps its documents. Defined results: null or empty text has zero counts and fails the base
rule; a null stratum is a stratum of its own; a document with several labels counts as good only if all of them say so;
labels with null in either column are ignored; repeated rows are judged one by one; other columns are never read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import boxed, cut, documents, mix, pieces, shingle_hashes, trim, unboxed, word_hashes, word_spans

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_marks")
_SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))
_UPPER = np.isin(np.arange(256), range(65, 91))
_LETTER = np.isin(np.arange(256), [*range(65, 91), *range(97, 123)])
_MARK = np.isin(np.arange(256), list(b"!?;:~^_=+@\\/"))
WINDOW = 8
LEVELS = 16
ALPHA, DELTA = 0.02, 0.05


@dataclass(frozen=True)
class Rule:
    """A statistic as SQL over STATS; the higher, the worse. Its cutoffs fall from loosest to strictest by equal factors."""

    name: str
    value: str
    loosest: float
    strictest: float

    def cutoffs(self, levels: int = LEVELS) -> list[float]:
        return [self.loosest * (self.strictest / self.loosest) ** (k / (levels - 1)) for k in range(levels)]


RULES = (
    Rule("symbols", "n_symbols / greatest(word_chars, 1)", 0.4, 0.02),
    Rule("dup_lines", "n_dup_lines / greatest(n_lines, 1)", 0.9, 0.25),
    Rule("repeats", "n_repeat_words / greatest(n_words, 1)", 0.3, 0.15),
    Rule("upper", "n_upper / greatest(n_letters, 1)", 0.9, 0.25),
    Rule("marks", "n_marks / greatest(word_chars, 1)", 0.5, 0.05),
)


def _per_doc(flag: np.ndarray, offs: np.ndarray) -> np.ndarray:
    acc = np.zeros(len(flag) + 1, np.int64)
    np.cumsum(flag, out=acc[1:])
    return acc[offs[1:]] - acc[offs[:-1]]


def _repeated(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Words of each document inside windows of WINDOW words found twice or more in it."""
    s, at = shingle_hashes(h, first, WINDOW)
    count = np.diff(first)
    doc = np.repeat(np.arange(len(count)), np.diff(at))
    use = count[doc] >= WINDOW
    key = mix(s + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), 1)
    order = np.argsort(key)
    k = key[order]
    same = k[1:] == k[:-1]
    rep = np.zeros(len(s), bool)
    rep[order[1:][same]] = True
    rep[order[:-1][same]] = True
    rep &= use
    start = (np.arange(len(s)) - at[doc] + first[doc])[rep]
    cover = np.zeros(len(h) + 1, np.int64)
    np.add.at(cover, start, 1)
    np.add.at(cover, start + WINDOW, -1)
    return _per_doc(np.cumsum(cover[:-1]) > 0, first)


def _dup_lines(text: bytes) -> tuple[int, int]:
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines), len(lines) - len(set(lines))


def text_stats(column) -> dict[str, np.ndarray]:
    """STATS of each text of an Arrow column."""
    parts: dict[str, list[np.ndarray]] = {k: [np.zeros(0, np.int64)] for k in STATS}
    for _, _, buf, offs in pieces(column):
        starts, ends, first = word_spans(buf, offs)
        lines = [_dup_lines(buf[offs[k] : offs[k + 1]].tobytes()) for k in range(len(offs) - 1)]
        parts["n_words"].append(np.diff(first))
        inside = np.zeros(len(buf) + 1, np.int64)
        inside[starts] += 1
        inside[ends] -= 1
        word = np.cumsum(inside[:-1]) > 0
        parts["word_chars"].append(_per_doc(word & ((buf & 0xC0) != 0x80), offs))
        for k, table in (("n_symbols", _SYMBOL), ("n_upper", _UPPER), ("n_letters", _LETTER), ("n_marks", _MARK)):
            parts[k].append(_per_doc(table[buf], offs))
        parts["n_lines"].append(np.array([x[0] for x in lines], np.int64))
        parts["n_dup_lines"].append(np.array([x[1] for x in lines], np.int64))
        parts["n_repeat_words"].append(_repeated(word_hashes(buf, starts, ends), first))
    return {k: np.concatenate(v) for k, v in parts.items()}


def annotate(docs: DataFrame, keep: list[str], text: str = "text", prefix: str = "") -> DataFrame:
    """The columns keep of docs, and STATS of text."""

    def run(batches):
        for b in batches:
            stats = text_stats(b.column(text))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), *(pa.array(stats[k]) for k in STATS)], [*keep, *(prefix + k for k in STATS)])
            trim()

    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(*dict.fromkeys([*keep, text])).mapInArrow(run, f"{fields}, " + ", ".join(f"`{prefix}{k}` long" for k in STATS))


def base_failed(prefix: str = "") -> Column:
    n, r = F.col(f"{prefix}n_words"), F.col(f"{prefix}n_repeat_words")
    return (n < 20) | (100 * r > 30 * n)


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(Binomial(n, p) <= k), exactly up to rounding."""
    if k >= n:
        return 1.0
    lp, lq, top = math.log(p), math.log1p(-p), math.lgamma(n + 1)
    terms = [top - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * lp + (n - i) * lq for i in range(k, -1, -1)]
    most = max(terms)
    return min(1.0, math.exp(most) * math.fsum(math.exp(t - most) for t in terms))


def select_level(rejected: list[int], good: int, alpha: float, delta: float) -> int:
    """Index of the strictest level that passes, -1 for none. rejected: good rows that each level rejects, from the loosest."""
    best = -1
    for i, k in enumerate(rejected):
        if k > alpha * good or binomial_tail(k, good, alpha) > delta:
            break
        best = i
    return best


def least_good(alpha: float, delta: float) -> int:
    """Good rows that a level without a rejection needs to pass."""
    return math.ceil(math.log(delta) / math.log1p(-alpha))


def calibrate(stats: DataFrame, labels: DataFrame, stratum: str = "lang", rules=RULES, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """A row for each stratum with labels: _stratum, level (null: nothing is rejected there), pooled.

    What moves is a histogram with a row for each stratum and level; labelled rows are never collected.
    """
    label = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("_good"))
    cleared = lambda r: F.size(F.filter(F.array(*map(F.lit, r.cutoffs())), lambda c: F.expr(r.value) <= c))
    rows = stats.where(~base_failed()).select("doc_id", F.col(stratum).alias("_stratum"), F.least(*map(cleared, rules)).alias("_clear")).join(label.where("_good = 1"), "doc_id")
    hist = cut(rows.groupBy("_stratum", "_clear").agg(F.count("*").alias("_n")))
    size = cut(hist.groupBy("_stratum").agg(F.sum("_n").alias("_of")))
    share = delta / max(1, size.count())
    size = size.withColumn("pooled", F.col("_of") < least_good(alpha, share)).withColumn("_name", F.when(~F.col("pooled"), F.col("_stratum")))

    def pick(key, pdf: pd.DataFrame) -> pd.DataFrame:
        # a row clears the first _clear levels
        rejected = [int(pdf.loc[pdf["_clear"] <= k, "_n"].sum()) for k in range(LEVELS)]
        at = select_level(rejected, int(pdf["_n"].sum()), alpha, share)
        return pd.DataFrame({"_name": [key[0]], "pooled": [key[1]], "level": pd.array([at if at >= 0 else None], dtype="Int32")})

    kind = stats.schema[stratum].dataType.simpleString()
    joined = hist.join(size, hist["_stratum"].eqNullSafe(size["_stratum"])).select("_name", "pooled", "_clear", "_n")
    picked = joined.groupBy("_name", "pooled").applyInPandas(pick, f"_name {kind}, pooled boolean, level int").withColumnRenamed("_name", "_tested")
    out = size.join(picked.withColumnRenamed("pooled", "_pooled"), (F.col("pooled") == F.col("_pooled")) & F.col("_name").eqNullSafe(F.col("_tested")))
    return cut(out.select("_stratum", "level", "pooled"))


def judge(stats: DataFrame, levels: DataFrame, stratum: str = "lang", rules=RULES, prefix: str = "") -> DataFrame:
    """Adds base_failed, kept and failed_rules. levels: one short row for each stratum."""
    cols = stats.columns
    values = {r.name: F.expr(r.value if not prefix else _prefixed(r.value, prefix)) for r in rules}
    cutoff = lambda r: F.get(F.array(*map(F.lit, r.cutoffs())), F.col("level"))
    failed = F.array_compact(F.array(*(F.when(values[r.name] > cutoff(r), F.lit(r.name)) for r in rules)))
    out = stats.join(levels, F.col(stratum).eqNullSafe(F.col("_stratum")), "left")
    out = out.select(*(F.col(f"`{c}`") for c in cols), base_failed(prefix).alias("base_failed"), failed.alias("failed_rules"))
    return out.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))


def _prefixed(expr: str, prefix: str) -> str:
    import re

    return re.sub("|".join(sorted(STATS, key=len, reverse=True)), lambda m: prefix + m[0], expr)


def quality_verdicts(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """doc_id, the stratum, STATS, base_failed, kept and failed_rules of each row of docs."""
    stats = cut(annotate(docs, ["doc_id", "lang"]))
    return judge(stats, calibrate(stats, labels, **how))


def keep_good(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """The rows of docs that are kept, with the columns of docs; the text is read twice and never shuffled."""
    levels = calibrate(cut(annotate(docs, ["doc_id", "lang"])), labels, **how)
    box, names = boxed(docs, "text", "lang")
    judged = judge(annotate(box, [*names, "lang"], prefix="_q_"), levels, prefix="_q_")
    return unboxed(judged.where("kept"), docs, names)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_verdicts(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.concat_ws(",", "failed_rules").alias("failed_rules"))
