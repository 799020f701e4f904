"""Toxicity by a weighted finite-state grammar over clauses.

Words become symbols by a weighted lexicon; small transducers then rewrite the symbols of a clause: one
marks what stands in the scope of a negation, one what is reported from others, one sums insults (more if
aimed at somebody) and threats (only if aimed). They are composed into one machine that runs over each clause with
a match; clauses without one cost a search only. A logistic model over a document's clause scores gives
the result.

The insult lexicon is learned: words, and stems with a star, that occur in toxic training texts more often than
chance allows. Learning takes at most ``FIT_ROWS`` labelled rows (those first by a hash of the id), counted in
tasks; the lexicon and the four classes of function words are what prediction needs. Prediction is row by row.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkit.llm.common import held_out, slices
from martkit.sources.layers import stored

FIT_ROWS = 20_000
#: A lexicon entry needs evidence (nats) against being as frequent in clean texts: so much beyond the log of the
#: number of entries that are tested, which leaves less than one entry to chance.
EVIDENCE = 1.0
#: Entries in fewer texts of the sample are not tested.
LEAST_TEXTS = 5
STEMS = (4, 5, 6)
WORD = re.compile(r"[^\W\d_]+")
CLAUSE = re.compile(r"[^.!?;:,()\[\]|\"\n]+")

# Function words of the grammar in four languages (fixed values).
NEGATION = "not no never neither nor isn't aren't don't ne pas jamais ni nicht kein keine nie niemals nunca ningún tampoco".split()
REPORTED = "said says wrote called quoted claimed reported dit écrit appelé cité sagte schrieb nannte zitierte dijo escribió llamó citó".split()
TARGET = "you your you're he she they them him her people tu vous ton votre eux du ihr dich euch dein euer tú usted ustedes vosotros ellos".split()
THREAT = "kill hurt destroy beat shoot burn tuer frapper détruire brûler töten schlagen zerstören verbrennen matar golpear destruir quemar".split()


class Transducer:
    """Deterministic, weighted: (state, symbol) -> (state, symbol, factor, sum). Missing arcs copy the symbol."""

    def __init__(self, arcs: dict[tuple[str, str], tuple[str, str, float, float]], start: str = "start"):
        self.arcs, self.start = arcs, start

    def step(self, state, symbol: str) -> tuple[object, str, float, float]:
        return self.arcs.get((state, symbol), (state, symbol, 1.0, 0.0))


class Composed(Transducer):
    """What one transducer writes the next one reads; states are pairs, arcs are made when first met."""

    def __init__(self, first: Transducer, second: Transducer):
        super().__init__({}, (first.start, second.start))
        self.first, self.second = first, second

    def step(self, state, symbol):
        arc = self.arcs.get((state, symbol))
        if arc is None:
            a, middle, factor1, sum1 = self.first.step(state[0], symbol)
            b, out, factor2, sum2 = self.second.step(state[1], middle)
            arc = self.arcs[state, symbol] = (a, b), out, factor1 * factor2, sum1 + sum2
        return arc


def grammar(negated: float = 0.4, reported: float = 0.6, aimed: float = 1.0, threat: float = 4.0) -> Transducer:
    """Symbols in: insult, threat, target, negation, reported, other."""
    scope = 3  # words that a negation reaches
    negation = {("start", "negation"): ("n0", "other", 1.0, 0.0)}
    for i in range(scope):
        after = f"n{i + 1}" if i + 1 < scope else "start"
        for symbol in ("insult", "threat", "target", "other", "reported"):
            weak = negated if symbol in ("insult", "threat") else 1.0
            negation[f"n{i}", symbol] = (after, symbol, weak, 0.0)
        negation[f"n{i}", "negation"] = ("n0", "other", 1.0, 0.0)
    speech = {("start", "reported"): ("said", "other", 1.0, 0.0), ("said", "reported"): ("said", "other", 1.0, 0.0)}
    for symbol in ("insult", "threat"):
        speech["said", symbol] = ("said", symbol, reported, 0.0)
    # What an insult or a threat adds depends on whether a target has come, or comes later in the clause.
    score = {
        ("start", "target"): ("target", "other", 1.0, 0.0),
        ("start", "insult"): ("insult", "insult", 1.0, 0.0),
        ("start", "threat"): ("threat", "other", 1.0, 0.0),
        ("target", "insult"): ("target", "insult", 1.0, aimed),
        ("target", "threat"): ("target", "threat", 1.0, threat),
        ("insult", "target"): ("target", "other", 1.0, aimed),
        ("insult", "threat"): ("both", "other", 1.0, 0.0),
        ("threat", "target"): ("target", "threat", 1.0, threat),
        ("threat", "insult"): ("both", "insult", 1.0, 0.0),
        ("both", "target"): ("target", "threat", 1.0, aimed + threat),
    }
    return Composed(Composed(Transducer(negation), Transducer(speech)), Transducer(score))


@dataclass(frozen=True)
class ToxicityModel:
    """Lexicon (entry, or stem with a star, to weight) and the logistic weights: bias, then one per feature."""

    lexicon: dict[str, float]
    weights: tuple[float, ...]


class ClauseScorer:
    """The compiled grammar of one lexicon, made once per task."""

    def __init__(self, lexicon: dict[str, float]):
        self.words = {w: x for w, x in lexicon.items() if not w.endswith("*")}
        self.stems = {w[:-1]: x for w, x in lexicon.items() if w.endswith("*")}
        self.symbols = {w: s for s, ws in (("negation", NEGATION), ("reported", REPORTED), ("target", TARGET), ("threat", THREAT)) for w in ws}
        self.machine = grammar()
        self.triggers = ahocorasick.Automaton()
        for w in {*self.words, *self.stems, *THREAT}:
            self.triggers.add_word(w, len(w))
        if len(self.triggers):
            self.triggers.make_automaton()

    def symbol(self, word: str) -> tuple[str, float]:
        found = max([self.words.get(word, 0.0), *(self.stems.get(word[:n], 0.0) for n in STEMS)])
        return ("insult", found) if found else (self.symbols.get(word, "other"), 0.0)

    def clause(self, text: str) -> float:
        state, total = self.machine.start, 0.0
        for word in WORD.findall(text):
            symbol, weight = self.symbol(word)
            state, out, factor, more = self.machine.step(state, symbol)
            total += factor * weight * (out == "insult") + factor * more
        return total

    def features(self, text: str) -> tuple[float, float, float]:
        """Of a document: square root of all clause scores, the highest one, log of the number of matched clauses."""
        text, scores, done = text.lower(), [], -1
        if len(self.triggers):
            for last, length in self.triggers.iter(text):
                first = last - length + 1
                if first < done or first and text[first - 1].isalpha():
                    continue
                # No clause that holds this word begins before the end of the last one.
                start = max(text.rfind(c, max(done, 0), first) for c in '.!?;:,()[]|"\n') + 1
                clause = CLAUSE.match(text, start)
                done = clause.end()
                if (score := self.clause(clause.group())) > 0:
                    scores.append(score)
        return (math.sqrt(sum(scores)), max(scores, default=0.0), math.log1p(len(scores)))


def _features_of(text: str) -> set[str]:
    words = set(WORD.findall(text.lower()))
    return words | {f"{w[:n]}*" for w in words for n in STEMS if len(w) > n}


def _lexicon(counts: Iterable[tuple[str, int, int]], positive: int, negative: int, evidence: float) -> dict[str, float]:
    """Entries more frequent in toxic texts than chance allows, by their log odds; what a stem says is not repeated."""
    share = positive / (positive + negative)
    found = {}
    for entry, p, n in counts:
        q = p / (p + n)
        if q <= share:
            continue
        nats = (p + n) * (q * math.log(q / share) + (1 - q) * math.log((1 - q) / (1 - share)) if q < 1 else -math.log(share))
        weight = math.log((p + 0.5) / (positive + 1)) - math.log((n + 0.5) / (negative + 1))
        if nats >= evidence and weight > 1:
            found[entry] = weight
    kept: dict[str, float] = {}
    for entry in sorted(found, key=lambda e: (not e.endswith("*"), len(e), e)):
        stems = [f"{entry.rstrip('*')[:n]}*" for n in STEMS if n < len(entry.rstrip("*"))]
        if not any(kept.get(s, -99.0) >= found[entry] - 0.5 for s in stems):
            kept[entry] = found[entry]
    return kept


def _may_be_toxic(positive: int, negative: int, evidence: float) -> Column:
    """The test of ``_lexicon`` on columns p and n, wider by rounding, so that few entries return to the driver."""
    p, n, share = F.col("p"), F.col("n"), positive / (positive + negative)
    q = p / (p + n)
    clean = F.when(n > 0, n * F.log((1 - q) / (1 - share))).otherwise(0.0)
    weight = F.log((p + 0.5) / (positive + 1)) - F.log((n + 0.5) / (negative + 1))
    return (q > share * (1 - 1e-9)) & (p * F.log(q / share) + clean >= evidence - 1e-6) & (weight > 1 - 1e-9)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> tuple[float, ...]:
    """Newton's method with a small ridge on all but the bias."""
    x = np.column_stack([np.ones(len(x)), x])
    w, keep = np.zeros(x.shape[1]), ridge * len(x) * np.diag([0.0] + [1.0] * (x.shape[1] - 1)) / 100
    w[0] = math.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + keep @ w
        curve = (x * (p * (1 - p))[:, None]).T @ x + keep + 1e-9 * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w -= step * min(1.0, 2 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def learn_toxicity(
    docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, evidence: float = EVIDENCE
) -> ToxicityModel:
    """Learn from text and labels.toxic of the rows that aren't held out; ``fit_rows`` bounds the sample.

    The sample's ids and labels are small by that bound and are sent to the tasks that read the texts.
    """
    sample = (
        labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(fit_rows)
    )
    texts = docs.select("doc_id", "text").filter("text IS NOT NULL").join(F.broadcast(sample), "doc_id")
    # A copy says nothing new: each text counts once.
    texts = stored(texts.groupBy("text").agg(F.max("toxic").alias("toxic")), "labelled-texts")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (Counter(), Counter())
        for batch in batches:
            for toxic, text in zip(batch.column("toxic").to_pylist(), batch.column("text").to_pylist(), strict=True):
                found[toxic > 0].update(["", *_features_of(text)])  # the empty entry counts the texts
        entries = list({*found[0], *found[1]})
        columns = [pa.array(entries, pa.string()), *(pa.array([c[e] for e in entries], pa.int64()) for c in (found[1], found[0]))]
        yield pa.RecordBatch.from_arrays(columns, names=["entry", "p", "n"])

    counted = texts.mapInArrow(count, "entry string, p long, n long").groupBy("entry").agg(F.sum("p").alias("p"), F.sum("n").alias("n"))
    tested = counted.filter(f"p + n >= {LEAST_TEXTS}")
    evidence += math.log(max(1, tested.count()))
    toxic = F.col("toxic") > 0
    totals = texts.agg(F.count_if(toxic).alias("p"), F.count_if(~toxic).alias("n")).first()
    lexicon = {}
    if all(totals):
        entries = tested.filter(F.col("entry") != "").filter(_may_be_toxic(*totals, evidence)).collect()
        lexicon = _lexicon([tuple(r) for r in entries], *totals, evidence)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = ClauseScorer(lexicon)
        for batch in batches:
            x = [scorer.features(t) for t in batch.column("text").to_pylist()]
            columns = list(zip(*x, strict=True)) if x else [[], [], []]
            arrays = [pa.array(c, pa.float64()) for c in columns]
            yield pa.RecordBatch.from_arrays([*arrays, batch.column("toxic").cast(pa.int32())], names=["a", "b", "c", "toxic"])

    measured = texts.mapInArrow(measure, "a double, b double, c double, toxic int")
    cells = np.array([[r["a"], r["b"], r["c"], r["toxic"] > 0] for r in measured.collect()], dtype=float).reshape(-1, 4)
    return ToxicityModel(lexicon, _logistic(cells[:, :3], cells[:, 3]) if len(cells) else (-3.0, 0.0, 0.0, 0.0))


def score_toxicity(docs: DataFrame, model: ToxicityModel, threshold: float = 0.3) -> DataFrame:
    """doc_id, score (0 to 1), predicted (1 from threshold on) of every whole text; null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer, weights = ClauseScorer(model.lexicon), np.array(model.weights)
        for batch in batches:
            for rows in slices(batch, "text"):
                x = np.array([(1.0, *scorer.features(t or "")) for t in rows.column("text").to_pylist()]).reshape(-1, 4)
                scores = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
                predicted = pa.array((scores >= threshold).astype(np.int32))
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(scores), predicted], names=["doc_id", "score", "predicted"])

    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return narrow.mapInArrow(run, "doc_id long, score double, predicted int")
