"""Toxicity scores from a learned lexicon, with misspellings and quotation.

Lexicon: words and word beginnings that are frequent in toxic and rare in other labelled texts, with their log odds. It is kept as
a trie. The Levenshtein automata of one edit (a letter changed, added, left out, or two neighbours swapped) of all words are run
over the trie together: the set of (trie node, edits, pending letter) reached after each letter is one state of a
deterministic automaton that is built as words ask for it, so a word costs one look-up for each letter until no term can
follow. Each place that a term takes counts by its weight, less for a misspelling, and apart from the others if it is quoted:
quotation marks around it, or a word of reporting within ``CONTEXT`` words before. A logistic model over these sums gives the score.

What is learned comes from at most ``sample_rows`` labelled rows (parameter), chosen by a hash of their id. Scores cover whole
texts, and words of any length; only a term is at most ``MAX_TERM`` letters long. Defined results: null or empty text is scored like a text without a term; without labels of both kinds the score is 0
everywhere; labels with nulls are ignored, a row with several labels counts by the highest; repeated rows are scored one by one.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import crc_mod, cut, documents, pieces, word_hashes, word_spans

SAMPLE_ROWS = 12_000
MAX_TERMS, MAX_TERM, MIN_STEM, MAX_STEM, MIN_FUZZY = 400, 64, 4, 8, 5
CONTEXT = 8
REPORTING = frozenset("quote quoted quotes quoting says said wrote writes word term cited citing called zitat sagte schrieb wort dijo palabra cita mot citation".split())
QUOTES = tuple("\"'“”„«»‘’`")
_EDGES = "\"'“”„«»‘’`.,;:!?()[]{}*_-–—…#%$&|<>~^+=/\\"
_FEATURES = 7


class Lexicon:
    """Terms (word -> weight, beginning -> weight) as a trie, and the automaton over it."""

    def __init__(self, words: dict[str, float], stems: dict[str, float]):
        self.words, self.stems = words, stems
        self.next: list[dict[str, int]] = [{}]
        self.word: list[float] = [0.0]
        self.stem: list[float] = [0.0]
        for terms, weight in ((words, self.word), (stems, self.stem)):
            for t, w in terms.items():
                n = 0
                for c in t:
                    if c not in self.next[n]:
                        self.next[n][c] = len(self.next)
                        self.next.append({}), self.word.append(0.0), self.stem.append(0.0)
                    n = self.next[n][c]
                weight[n] = max(weight[n], w)
        self.states: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.accepts: list[tuple[float, float]] = []
        self.start = self._state(self._closed({(0, 0, "")}))

    def _closed(self, s: set) -> frozenset:
        """Adds what is reached when a letter of a term is left out."""
        return frozenset(s | {(m, 1, "") for n, e, p in s if e == 0 and not p for m in self.next[n].values()})

    def _state(self, s: frozenset) -> int:
        if s not in self.states:
            self.states[s] = len(self.sets)
            self.sets.append(s), self.moves.append({})
            exact = max((max(self.word[n], self.stem[n]) for n, e, p in s if e == 0 and not p), default=0.0)
            fuzzy = max((self.word[n] for n, e, p in s if e == 1 and not p), default=0.0)
            self.accepts.append((exact, fuzzy))
        return self.states[s]

    def _move(self, state: int, c: str) -> int:
        """The state after letter c; 0 edits so far: c fits, replaces, comes in between, or is the second of two swapped."""
        out = set()
        for n, e, p in self.sets[state]:
            go = self.next[n]
            if p:  # the term's next letter must be c, then p
                m = go.get(c)
                if m is not None and p in self.next[m]:
                    out.add((self.next[m][p], 1, ""))
                continue
            if c in go:
                out.add((go[c], e, ""))
            if e == 0:
                out.add((n, 1, ""))
                out.update((m, 1, "") for x, m in go.items() if x != c)
                if any(c in self.next[m] for m in go.values()):
                    out.add((n, 1, c))
        k = self._state(self._closed(out))
        self.moves[state][c] = k
        return k

    def match(self, w: str) -> tuple[float, bool]:
        """(weight, whether misspelled); weight 0: no term."""
        s, stem = self.start, 0.0
        for i, c in enumerate(w):
            m = self.moves[s].get(c)
            s = self._move(s, c) if m is None else m
            if not self.sets[s]:
                return stem, False
            if i + 1 >= MIN_STEM:
                stem = max(stem, max((self.stem[n] for n, e, p in self.sets[s] if e == 0 and not p), default=0.0))
        exact, fuzzy = self.accepts[s]
        if max(exact, stem) > 0:
            return max(exact, stem), False
        return (fuzzy, True) if fuzzy > 0 and len(w) >= MIN_FUZZY - 1 else (0.0, False)


def fold(w: str) -> str:
    return w.strip(_EDGES).lower()


def _quoted(words: list[str], k: int) -> bool:
    """Whether word k stands in quotation: its own marks, or between marks or after a word of reporting in the words around."""
    w = words[k]
    closes = lambda x: x.rstrip(".,;:!?").endswith(QUOTES)
    if w.startswith(QUOTES) and closes(w):
        return True
    before = words[max(0, k - CONTEXT) : k]
    if any(fold(x) in REPORTING for x in before):
        return True
    opened = any(x.startswith(QUOTES) for x in [*before, w]) and not any(map(closes, before))
    return opened and any(map(closes, words[k : k + CONTEXT]))


def _word(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, k: int) -> str:
    return buf[starts[k] : ends[k]].tobytes().decode("utf-8", "ignore")


class Scorer:
    """Features of texts under a lexicon; terms already looked at are kept by hash, within a bound."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon, self.known = lexicon, {}

    def features(self, column) -> np.ndarray:
        out = [np.zeros((0, _FEATURES))]
        for _, _, buf, offs in pieces(column):
            starts, ends, first = word_spans(buf, offs)
            x = np.zeros((len(offs) - 1, _FEATURES))
            h, at, back = np.unique(word_hashes(buf, starts, ends, lower=True), return_index=True, return_inverse=True)
            if len(self.known) > 1_000_000:
                self.known.clear()
            hit = np.zeros(len(h), bool)
            for i, (key, k) in enumerate(zip(h.tolist(), at.tolist(), strict=True)):
                m = self.known.get(key)
                if m is None:
                    m = self.known[key] = self.lexicon.match(fold(_word(buf, starts, ends, k)))
                hit[i] = m[0] > 0
            places = np.flatnonzero(hit[back]) if len(h) else np.zeros(0, np.int64)
            for d in np.unique(np.searchsorted(first, places, "right") - 1):
                own = places[(places >= first[d]) & (places < first[d + 1])]
                plain = []
                for k in own.tolist():
                    w, wrong = self.known[int(h[back[k]])]
                    lo, hi = max(int(first[d]), k - CONTEXT), min(int(first[d + 1]), k + CONTEXT)
                    q = _quoted([_word(buf, starts, ends, i) for i in range(lo, hi)], k - lo)
                    x[d, 2 if q else 1 if wrong else 0] += w
                    if not q:
                        plain.append(k)
                # terms that stand close together weigh on each other
                x[d, 3] = sum(b - a <= CONTEXT for a, b in zip(plain, plain[1:], strict=False))
                x[d, 4] = len(plain) > 0
                x[d, 5] = 100 * len(plain) / max(1, first[d + 1] - first[d])
            x[:, :4] = np.log1p(x[:, :4])
            x[:, 5] = np.log1p(x[:, 5])
            x[:, 6] = 1.0
            out.append(x)
        return np.concatenate(out)


def learn_terms(sample: DataFrame, max_terms: int = MAX_TERMS) -> tuple[dict[str, float], dict[str, float]]:
    """(words, beginnings) with weights, from rows of text and toxic (0 or 1). Counted in the map tasks, summed in Spark; the best max_terms come to the driver."""

    def count(batches):
        tox, rest = Counter(), Counter()
        for b in batches:
            for t, y in zip(b.column("text"), b.column("toxic").to_pylist(), strict=True):
                seen = {w for w in map(fold, (t.as_py() or "").split()) if len(w) >= 3 and w.isalpha()}
                terms = {"=" + w for w in seen if len(w) <= MAX_TERM} | {w[:k] for w in seen for k in range(MIN_STEM, min(MAX_STEM, len(w)) + 1)}
                (tox if y else rest).update(terms)
        names = list(tox | rest)
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([tox[n] for n in names], pa.int64()), pa.array([rest[n] for n in names], pa.int64())], ["term", "tox", "rest"])

    n = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n1, n0 = n.get(1, 0), n.get(0, 0)
    if not n1 or not n0:
        return {}, {}
    least = max(3, round(0.004 * n1))
    odds = F.log((F.col("tox") + 0.5) / (n1 + 1.0)) - F.log((F.col("rest") + 0.5) / (n0 + 1.0))
    c = sample.select("text", "toxic").mapInArrow(count, "term string, tox long, rest long").groupBy("term").agg(F.sum("tox").alias("tox"), F.sum("rest").alias("rest"))
    c = c.where(F.col("tox") >= least).withColumn("odds", odds).where(F.col("odds") > 2.5)
    rows = c.orderBy(F.desc(F.col("odds") * F.log1p("tox")), "term").limit(4 * max_terms).collect()
    words, stems = {}, {}
    for r in rows:
        # a beginning must add to the words and shorter beginnings that are in: it occurs in more texts than they do
        t, w = r["term"], float(r["odds"])
        if t[0] == "=":
            words.setdefault(t[1:], w)
        elif all(r["tox"] >= 1.5 * x["tox"] for x in rows if x["term"] == "=" + t or x["term"][0] == "=" and x["term"][1:].startswith(t)):
            stems.setdefault(t, w)
    stems = {t: w for t, w in stems.items() if not any(t.startswith(s) and s != t for s in stems)}
    words = {t: w for t, w in words.items() if not any(t.startswith(s) for s in stems)}
    keep = sorted([(w, 0, t) for t, w in words.items()] + [(w, 1, t) for t, w in stems.items()], reverse=True)[:max_terms]
    return {t: w for w, k, t in keep if k == 0}, {t: w for w, k, t in keep if k == 1}


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 40) -> np.ndarray:
    """Newton's method with a ridge."""
    b = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        g = x.T @ (p - y) + ridge * b
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(b)), g)
        b -= step
        if np.abs(step).max() < 1e-8:
            break
    return b


def labelled_sample(docs: DataFrame, labels: DataFrame, held_out, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """text, toxic of about sample_rows labelled rows at most."""
    own = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).where(~held_out).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    n = own.count()
    part = min(1.0, sample_rows / max(1, n))
    u = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    some = own.where(u < part)
    return cut(docs.select("doc_id", "text").join(F.broadcast(some), "doc_id").select("text", "toxic"))  # about sample_rows short rows


def score(docs: DataFrame, sample: DataFrame, keep: list[str], max_terms: int = MAX_TERMS) -> DataFrame:
    """keep, and score for each row of docs."""
    words, stems = learn_terms(sample, max_terms)
    coef = None
    if words or stems:

        def features(batches):
            s = Scorer(Lexicon(words, stems))
            for b in batches:
                x = s.features(b.column("text"))
                yield pa.RecordBatch.from_arrays([b.column("toxic"), *(pa.array(x[:, k]) for k in range(_FEATURES))], ["toxic", *(f"f{k}" for k in range(_FEATURES))])

        rows = sample.mapInArrow(features, "toxic int, " + ", ".join(f"f{k} double" for k in range(_FEATURES))).toPandas()  # sample_rows short rows
        coef = fit_logistic(rows.drop(columns="toxic").to_numpy(), rows["toxic"].to_numpy().astype(float))

    def run(batches):
        s = Scorer(Lexicon(words, stems))
        for b in batches:
            p = np.zeros(b.num_rows) if coef is None else 1 / (1 + np.exp(-np.clip(s.features(b.column("text")) @ coef, -30, 30)))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(p)], [*keep, "score"])

    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, f"{fields}, score double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False))
    sample = labelled_sample(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), held_out)
    out = score(docs, sample, ["doc_id"])
    return out.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
