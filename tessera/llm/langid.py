"""Language identification by compression.

For each language a raw-content zstandard dictionary is cut from a bounded sample of labelled text. A text's language is the one
whose dictionary makes its whole UTF-8 form smallest. score is the margin to the next smallest, scaled to 0..1; a prediction
with a margin under ``min_margin`` is marked as not accepted, but still named.

Sample: ``sample_chars`` characters a language, all of a language that has fewer, from the documents of lowest hash of their id,
so the result does not depend on the partitioning. A text gives at most a sixteenth of it, or the least part at which the texts of
the language fill the sample; of a longer text that is made of pieces spread evenly over it. Defined results: null text, or text without a letter, is ``und`` with score 0; without
any learnable language everything is ``und``; ties go to the language that sorts first; repeated rows are judged one by one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import crc_mod, documents

SAMPLE_CHARS = 65_536
LEVEL = 3


def learn(docs: DataFrame, held_out, sample_chars: int = SAMPLE_CHARS) -> dict[str, bytes]:
    """Language -> dictionary. What comes to the driver is about one and a half to three times sample_chars a language."""
    rows = docs.where(~held_out & F.col("lang").isNotNull() & (F.length("text") > 0)).select("lang", "text", "doc_id")
    piece = -(-sample_chars // 64)
    caps = [piece * n for n in (4, 8, 16, 32, 64)]
    given = F.array(*(F.sum(F.least(F.length("text"), F.lit(c))).cast("long") for c in caps))
    per = {r["lang"]: r["given"] for r in rows.groupBy("lang").agg(given.alias("given")).collect()}
    # what a text gives at most, so that no long text fills the sample where others can
    cap = {k: next((c for c, n in zip(caps, v, strict=True) if n >= sample_chars), caps[-1]) for k, v in per.items()}
    # of hash values, the part that holds about 1.5 times the sample; all of a small language
    part = {k: min(1.0, 1.5 * sample_chars / v[caps.index(cap[k])]) for k, v in per.items()}
    u = F.pmod(F.xxhash64(F.col("doc_id")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    order, n = F.xxhash64("doc_id", "text"), F.length("text")
    out: dict[str, str] = {}
    while short := sorted(per.keys() - out.keys()):
        of = lambda d: F.try_element_at(F.create_map(*(F.lit(x) for k in short for x in (k, d[k]))), F.col("lang"))  # noqa: B023, E731
        some = rows.where(u < of(part)).withColumn("cap", of(cap))
        at = F.sequence(F.lit(0), F.expr(f"cap div {piece} - 1"))
        spread = F.transform(at, lambda i: F.substr("text", (i * (n - piece) / (F.size(at) - 1)).cast("int") + 1, F.lit(piece)))
        some = some.select("lang", order.alias("o"), F.when(n <= F.col("cap"), F.col("text")).otherwise(F.array_join(spread, "\n")).alias("text"))
        for r in some.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("o", "text"))).alias("rows")).collect():
            text = "\n".join(x["text"] for x in r["rows"])
            if len(text) >= sample_chars or part[r["lang"]] >= 1:
                out[r["lang"]] = text[:sample_chars]
        # too few were drawn: more of the lowest hashes
        part = {k: min(1.0, 2 * x) for k, x in part.items()}
    return {k: out[k].encode() for k in sorted(out)}


def classify(docs: DataFrame, dictionaries: dict[str, bytes], keep: list[str], min_margin: float = 0.02, level: int = LEVEL) -> DataFrame:
    """keep, and lang_pred, score, accepted for each row of docs."""
    names = sorted(dictionaries)
    data = [dictionaries[k] for k in names]

    def run(batches):
        import zstandard

        made = []
        for x in data:
            d = zstandard.ZstdCompressionDict(x, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=level)
            made.append(zstandard.ZstdCompressor(level=level, dict_data=d, write_checksum=False, write_content_size=False, write_dict_id=False))
        for b in batches:
            pred, score, ok = [], [], []
            for v in b.column("text"):
                t = v.as_py()
                if not made or not t or not any(map(str.isalpha, t)):
                    pred.append("und"), score.append(0.0), ok.append(False)
                    continue
                raw = t.encode()
                n = [len(c.compress(raw)) for c in made]
                best = int(np.argmin(n))
                rest = min([x for i, x in enumerate(n) if i != best], default=n[best] * 2)
                margin = (rest - n[best]) / max(1, rest)
                pred.append(names[best]), score.append(min(1.0, 4 * margin)), ok.append(margin >= min_margin)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(ok, pa.bool_())], [*keep, "lang_pred", "score", "accepted"])

    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, f"{fields}, lang_pred string, score double, accepted boolean")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = crc_mod("doc_id", 4) == 2
    dicts = learn(docs, F.coalesce(held_out, F.lit(False)))
    return classify(docs.select("doc_id", "text"), dicts, ["doc_id"]).select("doc_id", F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "accepted")
