"""Toxicity: a learned lexicon, matched with its misspellings, weighed by context.

The lexicon's terms form a trie. Running a word through the trie with a bounded number
of edits is the product of the trie with the Levenshtein automata of its terms; its sets
of positions become the states of an automaton that is built as far as words need it.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkmill.llm.common import Staged

# Labelled rows that the model is fitted on at most, chosen by a hash of their id.
MAX_LABELLED = 20_000
MAX_TERMS = 2_000
MIN_DOCS, MIN_SHARE, MIN_LOG_ODDS = 3, 0.02, 3.0
STEMS = range(4, 8)
STEM_WORDS = 5
THRESHOLD = 0.7
CONTEXT = 6
# Marks and words around a term that is cited, not used.
QUOTES = "\"“”„«»‹›`"
REPORTING = frozenset((
    "said says saying called calls calling call quote quoted quoting quotes word words term terms wrote writes phrase "
    "dit disait mot mots terme cité citation sagte sagt nannte wort wörter begriff zitat zitiert "
    "dijo dice llamó palabra palabras término cita citó").split())
_STATES, _WORDS = 50_000, 100_000
_WORD = re.compile(r"\w(?:.*\w)?", re.S)


def bare_word(token: str) -> str:
    """The token without marks around it; marks inside stay, as misspellings."""
    found = _WORD.search(token)
    return found[0] if found else ""


def edits_allowed(length: int) -> int:
    return 0 if length < 5 else 1 if length < 8 else 2


@dataclass(frozen=True)
class Term:
    text: str
    weight: float
    stem: bool  # also matches every longer word that begins with it


class LexiconAutomaton:
    """Word -> (edits, term index) of the nearest lexicon term, or None."""

    def __init__(self, terms: list[Term]):
        self.terms = terms
        self.children: list[dict[str, int]] = [{}]
        self.reach = [0]  # edits allowed to the terms below a node
        self.end: list[list[int]] = [[]]
        for t, term in enumerate(terms):
            node, k = 0, 0 if term.stem else edits_allowed(len(term.text))
            for c in term.text:
                self.reach[node] = max(self.reach[node], k)
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.reach.append(0)
                    self.end.append([])
                node = self.children[node][c]
            self.reach[node] = max(self.reach[node], k)
            self.end[node].append(t)
        self._reset()

    def _reset(self) -> None:
        self.ids: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.found: list[tuple] = []
        self.step: list[dict[str, int]] = []
        self.start = self._state({(0, 0)})

    def _state(self, positions: set) -> int:
        """Close under letters that the word leaves out, keep the fewest edits per node."""
        best: dict[int, int] = {}
        todo = list(positions)
        while todo:
            node, e = todo.pop()
            if e > self.reach[node] or best.get(node, 99) <= e:
                continue
            best[node] = e
            todo.extend((child, e + 1) for child in self.children[node].values())
        key = frozenset(best.items())
        if key not in self.ids:
            self.ids[key] = len(self.sets)
            self.sets.append(key)
            self.step.append({})
            ends = [(e, t) for node, e in best.items() for t in self.end[node]
                    if e <= (0 if self.terms[t].stem else edits_allowed(len(self.terms[t].text)))]
            stems = [x for x in ends if self.terms[x[1]].stem]
            self.found.append((min(ends, default=None), min(stems, default=None)))
        return self.ids[key]

    def _next(self, state: int, c: str) -> int:
        to = set()
        for node, e in self.sets[state]:
            to.add((node, e + 1))
            for letter, child in self.children[node].items():
                to.add((child, e + (letter != c)))
        following = self.step[state][c] = self._state(to)
        return following

    def match(self, word: str) -> tuple[int, int] | None:
        if len(self.sets) > _STATES:
            self._reset()
        state, best = self.start, None
        for c in word:
            following = self.step[state].get(c)
            state = self._next(state, c) if following is None else following
            if not self.sets[state]:
                return best
            stem = self.found[state][1]
            if stem is not None and (best is None or stem < best):
                best = stem
        whole = self.found[state][0]
        return min(x for x in (whole, best) if x is not None) if whole or best else None


class Matcher(dict):
    """Token -> (weight, misspelt) or None, remembered for the latest tokens."""

    def __init__(self, terms: list[Term]):
        super().__init__()
        self.automaton = LexiconAutomaton(terms)

    def __missing__(self, token: str):
        if len(self) > _WORDS:
            self.clear()
        word = bare_word(token)
        hit = self.automaton.match(word) if 3 < len(word) <= 64 else None
        value = self[token] = hit and (self.automaton.terms[hit[1]].weight / (1 + hit[0]), hit[0] > 0)
        return value


def features(text: str | None, matcher: Matcher) -> tuple[float, float, float]:
    """Weights of all terms that are not cited, of the misspelt ones among them, and of those cited.

    A misspelt term counts as evidence by itself; its own weight corrects that by what labels show.
    """
    tokens = (text or "").lower().split()
    hits = [(i, x) for i, x in enumerate(map(matcher.__getitem__, tokens)) if x is not None]
    used = misspelt = cited = 0.0
    for i, (weight, wrong) in hits:
        around = tokens[max(0, i - CONTEXT):i + CONTEXT + 1]
        opened = any(q in t for q in QUOTES for t in around[:CONTEXT + 1]) \
            and any(q in t for q in QUOTES for t in around[-CONTEXT - 1:])
        told = any(bare_word(t) in REPORTING for t in tokens[max(0, i - CONTEXT):i])
        if opened or told:
            cited += weight
        elif wrong:
            misspelt += weight
        else:
            used += weight
    return math.log1p(used + misspelt), math.log1p(misspelt), math.log1p(cited)


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = (Counter(), Counter())
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = set(map(bare_word, set(text.lower().split())))
            counts[toxic].update(w for w in words if 3 < len(w) <= 64)
        words = list(counts[0].keys() | counts[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(words, pa.string()), *(pa.array([c[w] for w in words], pa.int64()) for c in counts)],
            names=["word", "neg", "pos"])


def _fit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton's method; the first column is the constant."""
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], 0.02)
    ridge[0] = 1e-4
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), x.T @ (p - y) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


@dataclass(frozen=True)
class ToxicityModel:
    terms: list[Term]
    weights: list[float]  # constant, all not cited, misspelt ones, cited ones


def held_out(doc_id: Column | str) -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learn_toxicity(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    """Learn lexicon and weights from labelled documents that are not held out.

    At most `MAX_LABELLED` labelled rows are used, a sample by a hash of the id; only that
    sample is moved. Word counts are added up on Spark; the driver gets at most `MAX_TERMS`
    terms and the three features of each sampled row. A stem is taken into the lexicon if
    many words begin with it and none of them makes up half of its uses.
    Equal texts count once. Rows with a null id, text or label teach nothing.
    """
    chosen = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    chosen = chosen.where("doc_id IS NOT NULL AND toxic IN (0, 1)").where(~held_out("doc_id"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(MAX_LABELLED)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = texts.where("text IS NOT NULL").join(F.broadcast(chosen), "doc_id").groupBy("text").agg(
        F.max("toxic").alias("toxic"))
    rows = Staged(rows, "labelled")
    totals = {r.toxic: r["count"] for r in rows.df.groupBy("toxic").count().collect()}
    n_pos, n_neg = totals.get(1, 0), totals.get(0, 0)
    least = max(MIN_DOCS, MIN_SHARE * n_pos)

    words = rows.df.mapInArrow(_word_counts, "word string, neg long, pos long").groupBy("word").agg(
        F.sum("neg").alias("neg"), F.sum("pos").alias("pos"))
    words = Staged(words, "word-counts")
    odds = F.log((F.col("pos") + 0.5) / (n_pos + 1)) - F.log((F.col("neg") + 0.5) / (n_neg + 1))
    stems = words.df.select("neg", "pos", F.explode(F.array(*(
        F.when(F.char_length("word") >= n, F.substring("word", 1, n)) for n in STEMS))).alias("word"))
    stems = stems.where("word IS NOT NULL").groupBy("word").agg(
        F.sum("neg").alias("neg"), F.sum("pos").alias("pos"), F.sum((F.col("pos") > 0).cast("int")).alias("n"),
        F.max("pos").alias("most")).where(f"n >= {STEM_WORDS} AND 2 * most <= pos")
    terms = words.df.select("word", "neg", "pos", F.lit(False).alias("stem")).unionByName(
        stems.select("word", "neg", "pos", F.lit(True).alias("stem")))
    terms = terms.withColumn("odds", odds).where((F.col("pos") >= least) & (F.col("odds") >= MIN_LOG_ODDS))
    lexicon = [Term(r.word, r.odds, r.stem)
               for r in terms.orderBy(F.desc("odds"), "word", "stem").limit(MAX_TERMS).collect()]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(lexicon)
        for batch in batches:
            found = [features(t, matcher) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array([f[i] for f in found], pa.float64()) for i in range(3)), batch.column(1)],
                names=["used", "misspelt", "cited", "toxic"])

    weights = [-30.0, 0.0, 0.0, 0.0]
    if n_pos and n_neg:
        seen = rows.df.mapInArrow(measure, "used double, misspelt double, cited double, toxic int")
        seen = np.array(seen.groupBy("used", "misspelt", "cited", "toxic").count().collect(), float)
        # Few labels give an uncertain constant; equal rows are folded to one with their number.
        x = np.repeat(seen[:, :3], seen[:, 4].astype(int), axis=0)
        y = np.repeat(seen[:, 3], seen[:, 4].astype(int))
        weights = _fit(np.column_stack([np.ones(len(x)), x]), y).tolist()
    rows.drop()
    words.drop()
    return ToxicityModel(lexicon, weights)


def score_toxicity(docs: DataFrame, model: ToxicityModel, score: str = "score") -> DataFrame:
    """Add a score from 0 to 1 of each whole text; null counts as empty. Nothing is shuffled."""
    terms, weights = model.terms, model.weights

    @F.arrow_udf("double")
    def rate(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        matcher = Matcher(terms)
        for batch in texts:
            x = np.array([features(t, matcher) for t in batch.to_pylist()]).reshape(-1, 3)
            z = weights[0] + x @ np.array(weights[1:])
            yield pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    return docs.withColumn(score, rate(F.col("text").cast("string")))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted (score >= 0.7) of every document.

    Without labels of both kinds every score is 0. Rows repeat as they come; a null id is
    not held out. The model sees texts only.
    """
    rated = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rated = score_toxicity(rated, learn_toxicity(docs, labels))
    return rated.select("doc_id", held_out("doc_id").alias("held_out"), "score",
                        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
