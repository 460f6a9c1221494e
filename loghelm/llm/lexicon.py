"""Toxicity by a learned lexicon, searched with Levenshtein automata.

Lexicon: words, and word stems of four to six letters, that occur in toxic
training documents far more often than chance allows. They form a trie; a
token's Levenshtein automaton runs down the trie and accepts whole words within
`max_edits` edits, a swap of neighbours as one (none for short words), stems only
exactly.

Each (term, edits) has the share of toxic documents among those it hits; with edits,
a share that few training hits tell is drawn to what the term's exact hits are
worth, times what hits with edits are worth beside exact ones over all terms. A hit
is seen in its window of words: quotation marks around it or a reporting word
beside it speak for quotation, a direct address for abuse; what each of these
signs is worth is learned from the training hits. A logistic model joins a
document's strongest hits (one per token) and its length; it is fitted on
evidence from which each training document's own counts are taken off.

The sample that the model is fitted on is bounded (`fit_rows`, near copies once)
and so is the lexicon (`max_terms`); every document is scored whole.

Cases: null and empty texts have no hits; rows that repeat are scored each; ties
between terms go to fewer edits, then to the stronger; without labelled rows every score is 0.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loghelm.llm.common import doc_text, fold
from loghelm.llm.labelled import training_sample

FIT_ROWS = 20_000
MAX_TERMS = 20_000
MAX_EDITS = 1
#: Words shorter than this must match exactly.
FUZZY_LENGTH = 5
STEMS = (4, 5, 6)
#: Least likelihood ratio statistic and share of toxic documents of a term.
EVIDENCE, SHARE = 14.0, 0.5
WINDOW = 6
STRONGEST = 4
MEMO_TOKENS = 200_000
#: Worth of a hit with edits beside an exact one, until training hits tell.
EDITED = 0.5

REPORTING = frozenset("said says wrote writes called calls quote quoted quotes word term slur insult alleged reported".split())
DIRECT = frozenset("you your yours youre u ur du dein deine tu ton ta eres vous votre".split())
QUOTES = "\"“”„«»‘’`"
_EDGES = " \t\n.,;:!?()[]{}<>…·¡¿" + QUOTES + "'"
_TOKEN = re.compile("[^\\s" + re.escape(".,;:!?()[]{}<>…·¡¿" + QUOTES) + "]+")


class LevenshteinAutomaton:
    """Deterministic automaton of all strings within `edits` of a word, its states
    (rows of clipped edit distances) made as they are reached. With `swaps`, two
    neighbours that changed places are one edit: a second part of the state holds the
    distances that a swap under way will have."""

    def __init__(self, word: str, edits: int, swaps: bool = False):
        self.word, self.edits, self.swaps = word, edits, swaps
        self.start = tuple(min(i, edits + 1) for i in range(len(word) + 1))
        if swaps:
            self.start += (edits + 1,) * len(word)
        self.moves: dict[tuple, tuple] = {}

    def step(self, state: tuple, char: str) -> tuple:
        key = (state, char)
        if key not in self.moves:
            most = self.edits + 1
            row = [min(state[0] + 1, most)]
            for i, c in enumerate(self.word):
                swapped = state[len(self.word) + 1 + i] if self.swaps and i and self.word[i - 1] == char else most
                row.append(min(state[i] + (c != char), row[i] + 1, state[i + 1] + 1, swapped, most))
            if self.swaps:
                row += [min(state[i - 1] + 1, most) if i and c == char else most for i, c in enumerate(self.word)]
            self.moves[key] = tuple(row)
        return self.moves[key]

    def alive(self, state: tuple) -> bool:
        return min(state) <= self.edits

    def distance(self, state: tuple) -> int:
        return state[len(self.word)]


def _cut_forms(word: str) -> list[str]:
    return [word, *[word[:i] + word[i + 1 :] for i in range(len(word))]]


class Lexicon:
    """Trie of words and stems (`stem*`), with a memo of tokens."""

    def __init__(self, terms: list[str], max_edits: int = MAX_EDITS, swaps: bool = False):
        self.max_edits, self.swaps = max_edits, swaps
        self.root: dict = {}
        self.stems: set[str] = set()
        self.words: set[str] = set()
        self.cut: set[str] = set()
        for term in terms:
            if term.endswith("*"):
                self.stems.add(term[:-1])
                continue
            self.words.add(term)
            node = self.root
            for char in term:
                node = node.setdefault(char, {})
            node["end"] = term
            if len(term) >= FUZZY_LENGTH and max_edits == 1:
                # words one edit or one swap apart share a form with at most one letter cut out
                self.cut.update(_cut_forms(term))
        self.stem_sizes = sorted({len(s) for s in self.stems})
        self.memo: dict[str, tuple] = {}

    def _may_match(self, token: str) -> bool:
        """Whether the automaton can accept anything; spares it most tokens."""
        if self.max_edits != 1:
            return True
        return not self.cut.isdisjoint(_cut_forms(token))

    def _search(self, token: str) -> tuple[tuple[str, int], ...]:
        found = {}
        for n in self.stem_sizes:
            if len(token) > n and token[:n] in self.stems:
                found[token[:n] + "*"] = 0
        if token in self.words:
            found[token] = 0
        elif self.max_edits and len(token) >= FUZZY_LENGTH - self.max_edits and self._may_match(token):
            automaton = LevenshteinAutomaton(token, self.max_edits, self.swaps)
            todo = [(self.root, automaton.start)]
            while todo:
                node, state = todo.pop()
                for char, child in node.items():
                    if char == "end":
                        if automaton.distance(state) <= self.max_edits and len(child) >= FUZZY_LENGTH:
                            found[child] = automaton.distance(state)
                    elif automaton.alive(moved := automaton.step(state, char)):
                        todo.append((child, moved))
        return tuple(sorted(found.items()))

    def search(self, token: str) -> tuple[tuple[str, int], ...]:
        """(term, edits) of all terms the token matches."""
        hit = self.memo.get(token)
        if hit is None:
            if len(self.memo) > MEMO_TOKENS:
                self.memo.clear()
            hit = self.memo[token] = self._search(token)
        return hit


def tokens(text: str) -> list[str]:
    """Lower-cased words without the punctuation around them."""
    return _TOKEN.findall(text.lower())


def signs(text: str, matched: set[str]) -> dict[str, set[str]]:
    """For each matched token, the signs in the windows around its occurrences
    that all of them share."""
    words = text.lower().split()
    out: dict[str, set[str]] = {}
    bare = [w.strip(_EDGES) for w in words]
    for i, word in enumerate(words):
        inner = [t for t in _TOKEN.findall(word) if t in matched]
        if not inner:
            continue
        near = set(bare[max(0, i - WINDOW) : i + WINDOW + 1])
        around = words[max(0, i - WINDOW) : i + 1], words[i : i + WINDOW + 1]
        quoted = all(any(c in QUOTES for w in side for c in w) for side in around)
        seen = {s for s, there in (("quoted", quoted), ("reported", near & REPORTING), ("direct", near & DIRECT)) if there}
        for token in inner:
            out[token] = out[token] & seen if token in out else seen
    return out


def _terms(text: str) -> set[str]:
    own = {t for t in tokens(text) if len(t) > 2}
    return own | {t[:n] + "*" for t in own for n in STEMS if len(t) > n}


def learn_terms(sample: DataFrame, max_terms: int = MAX_TERMS) -> tuple[list[str], int, int]:
    """The terms of the lexicon, and the number of toxic and of clean documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> pa.RecordBatch:
            names = list(counts[0].keys() | counts[1].keys())
            return pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), *[pa.array([c[t] for t in names], pa.int64()) for c in counts]],
                ["term", "clean", "toxic"],
            )

        counts = (Counter(), Counter())
        for batch in batches:
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts[label].update(_terms(text))
                if len(counts[0]) + len(counts[1]) > 200_000:
                    yield flush()
                    counts = (Counter(), Counter())
        yield flush()

    totals = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    if not toxic or not clean:
        return [], toxic, clean
    a, b, share = F.col("toxic"), F.col("clean"), toxic / (toxic + clean)
    part = lambda x, e: F.when(x > 0, x * F.log(x / e)).otherwise(0.0)
    statistic = 2 * (part(a, (a + b) * share) + part(b, (a + b) * (1 - share)))
    found = sample.mapInArrow(run, "term string, clean long, toxic long")
    found = found.groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    kept = found.where((a >= SHARE * (a + b)) & (a > share * (a + b))).withColumn("evidence", statistic)
    kept = kept.where(F.col("evidence") >= EVIDENCE).orderBy(F.desc("evidence"), "term").limit(max_terms)
    return [r["term"] for r in kept.select("term").collect()], toxic, clean


class Model:
    """Lexicon, label counts of its (term, edits), worth of signs, and the
    logistic weights that join a document's hits."""

    def __init__(self, terms: list[str], share: float, edits: int):
        self.lexicon = Lexicon(sorted(terms), edits, swaps=True)
        self.counts: dict[tuple[str, int], tuple[int, int]] = {}
        self.prior = min(max(share, 1e-6), 1 - 1e-6)
        self.signs = {"quoted": -1.0, "reported": -0.5, "direct": 0.5}
        self.edited = EDITED
        self.weights: np.ndarray | None = None
        self.floor = share

    def hits(self, words: list[str]) -> dict[str, tuple[tuple[str, int], ...]]:
        found = {}
        for token in set(words):
            if hit := self.lexicon.search(token):
                found[token] = hit
        return found

    def lift(self, a: float, b: float, expected: float = 0.0) -> float:
        """Log odds that a toxic and b clean hits add, drawn to `expected`."""
        odds = math.log(self.prior / (1 - self.prior))
        p = (a + 2 / (1 + math.exp(-odds - expected))) / (a + b + 2)
        return math.log(p / (1 - p)) - odds

    def learn_edited(self) -> None:
        """What a hit with edits is worth beside an exact one, over all terms."""
        edited = [(t, a, b) for (t, edits), (a, b) in sorted(self.counts.items()) if edits]
        n = sum(a + b for _, a, b in edited)
        exact = sum((a + b) * max(self.lift(*self.counts.get((t, 0), (0, 0))), 0.0) for t, a, b in edited)
        if exact > 0:
            learned = self.lift(sum(a for _, a, _ in edited), sum(b for _, _, b in edited)) / (exact / n)
            trust = n / (n + 20)
            self.edited = trust * min(max(learned, 0.0), 1.0) + (1 - trust) * EDITED

    def strength(self, hit: tuple[tuple[str, int], ...], left_out: int | None) -> float:
        """Log odds that a hit adds, by its term of fewest edits and most worth;
        `left_out` is the label of a training document, whose own count is taken off."""
        best = None
        for term, edits in hit:
            a, b = self.counts.get((term, edits), (0, 0))
            if left_out is not None:
                a, b = max(a - left_out, 0), max(b - 1 + left_out, 0)
            expected = self.edited**edits * max(self.lift(*self.counts.get((term, 0), (0, 0))), 0.0) if edits else 0.0
            best = max(best or (-edits, -9.0), (-edits, self.lift(a, b, expected)))
        return max(best[1], 0.0)

    def evidence(self, text: str, left_out: int | None = None) -> list[float]:
        """What the weights join: the strongest hits, the rest, the length."""
        words = tokens(text)
        found = self.hits(words)
        seen = signs(text, set(found)) if found else {}
        worth = []
        for token, hit in found.items():
            s = self.strength(hit, left_out)
            if s:
                worth.append(max(s + sum(self.signs[x] for x in seen.get(token, ())), 0.0))
        worth.sort(reverse=True)
        top = (worth + [0.0] * STRONGEST)[:STRONGEST]
        return [1.0, *top, math.log1p(sum(worth[STRONGEST:])), math.log1p(len(words)) * bool(worth), float(bool(worth))]

    def score(self, text: str) -> float:
        if self.weights is None:
            return self.floor
        z = float(self.weights @ np.array(self.evidence(text)))
        return 1 / (1 + math.exp(-min(max(z, -30.0), 30.0)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Ridge logistic weights by Newton steps; the first column is not penalised."""
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-3
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-9), x.T @ (p - y) + penalty * w)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(sample: DataFrame, max_edits: int = MAX_EDITS, max_terms: int = MAX_TERMS) -> Model:
    """Learn the lexicon, then what its hits, their signs and their number are worth."""
    terms, toxic, clean = learn_terms(sample, max_terms)
    model = Model(terms, toxic / (toxic + clean) if toxic + clean else 0.0, max_edits)
    if not terms:
        return model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = model.hits(tokens(text))
                own = {f"{d}{t}" for hit in found.values() for t, d in hit}
                if found:
                    own |= {"-any"} | {f"-{s}" for seen in signs(text, set(found)).values() for s in seen}
                counts[label].update(own)
        names = list(counts[0].keys() | counts[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), *[pa.array([c[t] for t in names], pa.int64()) for c in counts]],
            ["name", "clean", "toxic"],
        )

    made = sample.mapInArrow(run, "name string, clean long, toxic long").groupBy("name")
    made = made.agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    counts = {r["name"]: (r["toxic"], r["clean"]) for r in made.collect()}
    model.counts = {(n[1:], int(n[0])): v for n, v in counts.items() if n[0] != "-"}
    model.learn_edited()
    hit = counts.get("-any", (0, 0))
    for sign, prior in model.signs.items():
        a, b = counts.get(f"-{sign}", (0, 0))
        learned = math.log((a + 1) / (hit[0] + 2)) - math.log((b + 1) / (hit[1] + 2))
        trust = b / (b + 20)
        model.signs[sign] = trust * learned + (1 - trust) * prior

    def seen_evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            rows = [model.evidence(text, left_out=label) for label, text in pairs]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float64()))], ["label", "x"])

    rows = sample.mapInArrow(seen_evidence, "label int, x array<double>").collect()
    x, y = np.array([r["x"] for r in rows]), np.array([r["label"] for r in rows], dtype=float)
    order = np.lexsort([*x.T, y])
    model.weights = logistic(x[order], y[order])
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = np.array([model.score(t) for t in batch.column(1).to_pylist()], dtype=np.float64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made)], ["doc_id", "score"])

    return doc_text(docs).mapInArrow(run, "doc_id long, score double")


def toxicity_scores(
    docs: DataFrame,
    labels: DataFrame,
    held_out: Column | None = None,
    label: str = "toxic",
    threshold: float = 0.3,
    fit_rows: int = FIT_ROWS,
    max_edits: int = MAX_EDITS,
) -> DataFrame:
    """doc_id, held_out, score, predicted. Labels of held-out ids are never read."""
    held_out = fold("doc_id", 4) == 2 if held_out is None else held_out
    model = fit(training_sample(docs, labels, label, ~held_out, fit_rows), max_edits)
    return score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The rows of `docs` whose own text scores below the threshold."""
    model = fit(training_sample(docs, labels, "toxic", fold("doc_id", 4) != 2, FIT_ROWS))

    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            yield pa.array([model.score(t or "") for t in batch.to_pylist()], pa.float64())

    made = F.arrow_udf(run, "double")
    return docs.where(made(F.col("text")) < threshold)
