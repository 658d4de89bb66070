"""Delta-maintained token counts.

State is a folder of small tables, one for each committed batch, with signed sums by source, language and tokenizer version:
an insert adds a document's tokens, a delete takes them away, a revision adds the difference. Totals are the sum over
all batches, whatever the order of commits. A batch is written under a name of its own and renamed into place, which
happens once: a batch delivered again is recognised and changes nothing, and one that broke off leaves no trace.
``compact`` folds committed batches into one table. What counts is said by the newest manifest alone - one base table, and the
names of the batches in it - and a manifest comes in by one rename: a fold that breaks off at any step leaves the totals as they were.

Defined results: null source or language is a group of its own; null text counts as empty (0 tokens); a null in op or tokens is
an error; totals of 0 documents and 0 tokens are left out; repeated rows count each.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import cut, documents, pieces, shared_dir, word_spans

KEYS = ["source", "lang", "tokenizer"]
SCHEMA = "source string, lang string, tokenizer string, docs long, tokens long"
TOKENIZERS = "/opt/tokenizers"
#: Fixed value: how the byte-level vocabulary's tokenizer splits text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class TokenRollup:
    """The totals kept in a folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._p(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, *parts: str):
        return self._p("/".join([self.path, *parts]))

    def _names(self, top: str) -> list[str]:
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._at(top))) if self._fs.exists(self._at(top)) else []

    def _manifest(self) -> tuple[int, str | None, set[str]]:
        """(number, base table, batches folded into it) as the newest manifest has them."""
        names = self._names("manifest")
        if not names:
            return 0, None, set()
        stream = self._fs.open(self._at("manifest", names[-1]))
        try:
            about = json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()
        return int(names[-1]), about["base"], set(about["folded"])

    def batches(self) -> list[str]:
        """Names of the committed batches, those that were folded included."""
        return sorted(self._manifest()[2] | set(self._names("batch")))

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Apply changes (op, source, lang, tokenizer, tokens, old_tokens) once; False if batch was committed before.

        op: insert, delete (tokens: what was counted), revise (from old_tokens to tokens).
        """
        if batch in self.batches():
            return False
        sign = F.when(F.col("op") == "insert", 1).when(F.col("op") == "delete", -1).when(F.col("op") == "revise", 0)
        sign = F.coalesce(sign, F.raise_error(F.concat(F.lit("unknown op: "), F.coalesce("op", F.lit("null")))).cast("int"))
        tokens = F.when(sign == 0, F.col("tokens") - F.col("old_tokens")).otherwise(sign * F.col("tokens"))
        tokens = F.coalesce(tokens, F.raise_error(F.lit("tokens is null")).cast("long"))
        delta = changes.groupBy(*KEYS).agg(F.sum(sign.cast("long")).alias("docs"), F.sum(tokens.cast("long")).alias("tokens"))
        tmp = f"tmp/{uuid.uuid4().hex}"
        delta.coalesce(1).write.parquet(f"{self.path}/{tmp}")
        self._fs.mkdirs(self._at("batch"))
        if not self._fs.rename(self._at(tmp), self._at("batch", batch)) or self._fs.exists(self._at("batch", batch, tmp.rpartition("/")[2])):
            self._fs.delete(self._at("batch", batch, tmp.rpartition("/")[2]), True)  # another writer was first
            return False
        return True

    def totals(self) -> DataFrame:
        _, base, folded = self._manifest()
        found = [f"{self.path}/batch/{n}" for n in self._names("batch") if n not in folded] + ([f"{self.path}/base/{base}"] if base else [])
        rows = self.spark.read.schema(SCHEMA).parquet(*found) if found else self.spark.createDataFrame([], SCHEMA)
        return rows.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).where("docs <> 0 OR tokens <> 0")

    def compact(self) -> None:
        """Fold all committed batches into one table. One compacting writer at a time; commits may go on."""
        number, base, folded = self._manifest()
        names = set(self._names("batch"))
        if names - folded:
            tmp = uuid.uuid4().hex
            read = [f"{self.path}/batch/{n}" for n in sorted(names - folded)] + ([f"{self.path}/base/{base}"] if base else [])
            rows = self.spark.read.schema(SCHEMA).parquet(*read).groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
            rows.coalesce(1).write.parquet(f"{self.path}/base/{tmp}")
            number, base, folded = number + 1, tmp, folded | names
            self._fs.mkdirs(self._at("manifest"))
            self._fs.mkdirs(self._at("tmp"))
            stream = self._fs.create(self._at("tmp", tmp))
            try:
                stream.write(bytearray(json.dumps({"base": base, "folded": sorted(folded)}).encode()))
            finally:
                stream.close()
            if not self._fs.rename(self._at("tmp", tmp), self._at("manifest", f"{number:012d}")):
                raise OSError("another writer was compacting")
        # what nothing counts any more; a break here leaves it for the next time
        for n in sorted(names & folded):
            self._fs.delete(self._at("batch", n), True)
        for n in self._names("base"):
            if n != base:
                self._fs.delete(self._at("base", n), True)
        for n in self._names("manifest")[:-1]:
            self._fs.delete(self._at("manifest", n), True)


# -- tokenizers ---------------------------------------------------------------------------------------


def count_words(column) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.int64), *(np.diff(word_spans(buf, offs)[2]) for _, _, buf, offs in pieces(column))])


_BPE: dict = {}


def bpe_counter(folder: str = TOKENIZERS, file: str = "byte_bpe_50k.tiktoken") -> Callable:
    """Counts tokens of a public byte-level vocabulary; folder is where its file lies on every machine."""

    def count(column) -> np.ndarray:
        if (folder, file) not in _BPE:
            import base64

            import tiktoken

            with open(f"{folder}/{file}", "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            _BPE[folder, file] = tiktoken.Encoding(file, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        enc = _BPE[folder, file]
        return np.array([len(enc.encode_ordinary(v.as_py() or "")) for v in column], np.int64)

    return count


def token_counts(docs: DataFrame, tokenizers: dict[str, Callable], keep: Iterable[str] = ("doc_id", "source", "lang")) -> DataFrame:
    """keep, tokenizer, tokens: a row for each row of docs and each tokenizer (a version's name and its counter)."""
    keep = list(keep)

    def run(batches):
        for b in batches:
            for name, count in tokenizers.items():
                n = count(b.column("text"))
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array([name] * b.num_rows, pa.string()), pa.array(n, pa.int64())], [*keep, "tokenizer", "tokens"])

    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, f"{fields}, tokenizer string, tokens long")


def maintained_totals(docs: DataFrame, tokenizers: dict[str, Callable], provisional: str = "n_chars div 4") -> DataFrame:
    """The totals after three batches over all of docs: inserts with provisional counts, revisions to exact counts, deletes of
    documents without a token. The first two are delivered twice, as after a lost acknowledgement."""
    guess = docs.select("doc_id", "source", "lang", "text", F.expr(provisional).cast("long").alias("old_tokens"))
    counts = cut(token_counts(guess, tokenizers, ("source", "lang", "old_tokens")).withColumn("old_tokens", F.coalesce("old_tokens", F.lit(0))))
    r = TokenRollup(docs.sparkSession, f"{shared_dir(docs.sparkSession)}/tessera-rollup-{uuid.uuid4().hex}")
    none = F.lit(None).cast("long").alias("old_tokens")
    for _ in range(2):
        r.commit("1-insert", counts.select(F.lit("insert").alias("op"), *KEYS, F.col("old_tokens").alias("tokens"), none))
        r.commit("2-revise", counts.select(F.lit("revise").alias("op"), *KEYS, "tokens", "old_tokens"))
    r.commit("3-delete", counts.where("tokens = 0").select(F.lit("delete").alias("op"), *KEYS, "tokens", none))
    return r.totals()


def query(spark: SparkSession, sf_dir: str, tokenizers: str = TOKENIZERS) -> DataFrame:
    return maintained_totals(documents(spark, sf_dir), {"words@1": count_words, "byte-bpe-50k@1": bpe_counter(tokenizers)})


def words_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maintained_totals(documents(spark, sf_dir), {"words@1": count_words})


WORDS_SQL = r"""
SELECT source, lang, 'words@1' AS tokenizer, CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS tokens
FROM (SELECT source, lang, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n FROM documents)
WHERE n > 0 GROUP BY source, lang
"""
