"""Scores of the classifiers, rebuilt with plain loops."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from loghelm.llm import lexicon, nbsvm
from loghelm.llm.common import fold
from loghelm.llm.labelled import training_sample

WORDS = "the of and to in Red blue green Stone river cloud paper light moving quiet answer ñandú größe 2024 7 x-y it's".split()
BAD = ["grumblefoot", "slimehead", "dunderpate", "zorgling"]


def quality_text(rng, good):
    words = [rng.choice(WORDS) for _ in range(rng.randint(0, 30))]
    if not good:
        words = [w.upper() + rng.choice(["!", "!!", ""]) for w in words] + words[-1:] * rng.randint(0, 3)
    return rng.choice([" ", "  ", "\n"]).join(words)


def toxic_text(rng, toxic):
    words = [rng.choice(WORDS) for _ in range(rng.randint(3, 25))]
    for _ in range(rng.randint(1, 3) if toxic else rng.random() < 0.05):
        term = rng.choice(BAD)
        k = rng.randrange(1, len(term) - 1)
        term = rng.choice([term] * 4 + [term[:k] + term[k + 1 :], term[:k] + term[k + 1] + term[k] + term[k + 2 :], term + "s", f'"{term}"'])
        words.insert(rng.randrange(len(words)), rng.choice(["", "", "you ", "said "]) + term)
    return " ".join(words)


def tables(spark, make, label, n=200):
    rng = random.Random(9)
    marks = [int(rng.random() < 0.4) for _ in range(n)]
    docs = [(i, make(rng, mark)) for i, mark in enumerate(marks)] + [(n, None), (n + 1, ""), (3, "repeated id")]
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(list(enumerate(marks)), f"doc_id long, {label} int")


# --- quality ---


def shape(text):
    kinds = ["X" if "A" <= c <= "Z" else "x" if "a" <= c <= "z" or ord(c) > 127 else "9" if c.isdigit() else c for c in text]
    return "".join(c for i, c in enumerate(kinds) if not i or c != kinds[i - 1])


def small(word):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in word)


def plain_indicators(text):
    words = text.split()
    marked = [(shape(w), i > 0 and small(w) == small(words[i - 1])) for i, w in enumerate(words)]
    out = {("word", small(w)) for w in words}
    for k in (1, 2, 3):
        runs = Counter(tuple(marked[i : i + k]) for i in range(len(words) - k + 1))
        out |= {(run, step) for run, n in runs.items() for step in range(min(int(math.log2(n)), nbsvm.MAX_LEVEL) + 1)}
    return out


def test_indicators_are_the_plain_ones(monkeypatch):
    """The same documents share each indicator, whatever number it has."""
    monkeypatch.setattr(nbsvm, "BITS", 40)  # no two indicators of this corpus meet
    rng = random.Random(1)
    texts = [quality_text(rng, i % 2) for i in range(60)] + ["", "no no no No", "aB9 " * 300]
    doc, feature = nbsvm.features([t.encode() for t in texts])
    made, plain = defaultdict(set), defaultdict(set)
    for d, f in zip(doc.tolist(), feature.tolist()):
        made[f].add(d)
    for d, text in enumerate(texts):
        for name in plain_indicators(text):
            plain[name].add(d)
    assert Counter(map(frozenset, made.values())) == Counter(map(frozenset, plain.values()))


def test_quality_scores_equal_loops(spark):
    docs, labels = tables(spark, quality_text, "quality")

    def own(text):
        return sorted(nbsvm.features([(text or "").encode()])[1].tolist())

    sample = [(r["label"], own(r["text"])) for r in training_sample(docs, labels, "quality", fold("doc_id", 5) != 0, nbsvm.FIT_ROWS).collect()]
    sample.sort(key=lambda r: (np.array(r[1], np.int32).tobytes(), r[0]))
    sample = [sample[i] for i in np.random.default_rng(1).permutation(len(sample))]
    good, bad = (Counter(f for label, fs in sample if label == kind for f in fs) for kind in (1, 0))
    totals = [sum(c.values()) + (1 << nbsvm.BITS) for c in (good, bad)]
    ratio = {
        f: math.log((good[f] + 1) / totals[0]) - math.log((bad[f] + 1) / totals[1]) if good[f] + bad[f] > 1 else 0.0
        for f in good | bad
    }

    def vector(fs):
        norm = math.sqrt(max(sum(ratio.get(f, 0.0) ** 2 for f in fs), 1e-9))
        return {f: ratio.get(f, 0.0) / norm for f in fs}

    vectors = [vector(fs) for _, fs in sample]
    y = [1 if label else -1 for label, _ in sample]
    cost = {kind: len(y) / (2 * y.count(kind)) for kind in (1, -1)}

    def descend(rows):
        """Hinge loss by one dual variable at a time, in the stated order of visits."""
        w, alpha, rng = defaultdict(float), [0.0] * len(rows), np.random.default_rng(3)
        for _ in range(12):
            moved = 0.0
            for k in rng.permutation(len(rows)):
                x, label = vectors[rows[k]], y[rows[k]]
                square = sum(v * v for v in x.values())
                if square > 0:
                    step = label * sum(w[f] * v for f, v in x.items()) - 1
                    new = min(max(alpha[k] - step / square, 0.0), cost[label])
                    for f, v in x.items():
                        w[f] += (new - alpha[k]) * label * v
                    moved, alpha[k] = max(moved, abs(new - alpha[k])), new
            if moved < 1e-3:
                break
        return w

    def margin(w, x):
        return sum(w[f] * v for f, v in x.items())

    most = descend([i for i in range(len(y)) if i % 4 != 3])
    left = [i for i in range(len(y)) if i % 4 == 3]
    slope, offset = nbsvm._curve(np.array([margin(most, vectors[i]) for i in left]), np.array([float(y[i]) for i in left]))
    w = descend(range(len(y)))
    got = sorted((r["doc_id"], r["score"]) for r in nbsvm.quality_scores(docs, labels).collect())
    want = sorted((r["doc_id"], 1 / (1 + math.exp(-(slope * margin(w, vector(own(r["text"]))) + offset)))) for r in docs.collect())
    assert [i for i, _ in got] == [i for i, _ in want]
    assert np.allclose([s for _, s in got], [s for _, s in want], atol=1e-5)  # weights are kept in four bytes


# --- toxicity ---


def near(a, b):
    """One letter added, cut out or changed, or two neighbours swapped."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        apart = [i for i in range(len(a)) if a[i] != b[i]]
        swap = len(apart) == 2 and apart[1] == apart[0] + 1 and a[apart[0]] == b[apart[1]] and a[apart[1]] == b[apart[0]]
        return len(apart) == 1 or swap
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


class PlainToxicity:
    def __init__(self, sample):
        self.sample = sample
        self.n = Counter(label for label, _ in sample)
        self.share = self.n[1] / len(sample)
        self.terms = self.learn()
        self.counts, self.any, self.signed = defaultdict(lambda: [0, 0]), [0, 0], defaultdict(lambda: [0, 0])
        for label, text in sample:
            found = self.hits(text)
            for pair in {p for hit in found.values() for p in hit.items()}:
                self.counts[pair][1 - label] += 1
            if found:
                self.any[1 - label] += 1
                for sign in set().union(*lexicon.signs(text, set(found)).values()):
                    self.signed[sign][1 - label] += 1
        self.edited = self.worth_of_edits()
        self.sign = {}
        for sign, prior in (("quoted", -1.0), ("reported", -0.5), ("direct", 0.5)):
            a, b = self.signed[sign]
            learned = math.log((a + 1) / (self.any[0] + 2)) - math.log((b + 1) / (self.any[1] + 2))
            self.sign[sign] = b / (b + 20) * learned + 20 / (b + 20) * prior

    def learn(self):
        seen = [Counter(), Counter()]
        for label, text in self.sample:
            words = {t for t in lexicon.tokens(text) if len(t) > 2}
            seen[label].update(words | {w[:n] + "*" for w in words for n in (4, 5, 6) if len(w) > n})
        kept = set()
        for term in seen[1]:
            a, b = seen[1][term], seen[0][term]
            parts = ((a, (a + b) * self.share), (b, (a + b) * (1 - self.share)))
            evidence = 2 * sum(x * math.log(x / e) for x, e in parts if x)
            if a >= 0.5 * (a + b) and a > self.share * (a + b) and evidence >= lexicon.EVIDENCE:
                kept.add(term)
        return kept

    def hits(self, text):
        out = {}
        for token in set(lexicon.tokens(text)):
            found = {s: 0 for s in self.terms if s.endswith("*") and token.startswith(s[:-1]) and len(token) >= len(s)}
            whole = {t for t in self.terms if not t.endswith("*")}
            found |= {token: 0} if token in whole else {t: 1 for t in whole if len(t) >= 5 and near(t, token)}
            if found:
                out[token] = found
        return out

    def lift(self, a, b, expected=0.0):
        prior = math.log(self.share / (1 - self.share))
        p = (a + 2 / (1 + math.exp(-prior - expected))) / (a + b + 2)
        return math.log(p / (1 - p)) - prior

    def exact(self, term):
        return max(self.lift(*self.counts.get((term, 0), (0, 0))), 0.0)

    def worth_of_edits(self):
        edited = [(term, *c) for (term, edits), c in self.counts.items() if edits]
        n = sum(a + b for _, a, b in edited)
        expected = sum((a + b) * self.exact(term) for term, a, b in edited)
        if not expected:
            return lexicon.EDITED
        learned = self.lift(sum(a for _, a, _ in edited), sum(b for _, _, b in edited)) * n / expected
        return n / (n + 20) * min(max(learned, 0.0), 1.0) + 20 / (n + 20) * lexicon.EDITED

    def strength(self, hit, left_out):
        fewest = min(hit.values())
        worth = []
        for term in (t for t, edits in hit.items() if edits == fewest):
            a, b = self.counts.get((term, fewest), (0, 0))
            a, b = (a, b) if left_out is None else (max(a - left_out, 0), max(b - 1 + left_out, 0))
            worth.append(self.lift(a, b, self.edited * self.exact(term) if fewest else 0.0))
        return max(*worth, -9.0, 0.0)

    def evidence(self, text, left_out=None):
        found = self.hits(text)
        seen = lexicon.signs(text, set(found))
        worth = []
        for token, hit in found.items():
            if strength := self.strength(hit, left_out):
                worth.append(max(strength + sum(self.sign[s] for s in seen.get(token, ())), 0.0))
        worth.sort(reverse=True)
        four = (worth + [0.0] * 4)[:4]
        return [1.0, *four, math.log1p(sum(worth[4:])), math.log1p(len(lexicon.tokens(text))) if worth else 0.0, 1.0 if worth else 0.0]


def test_toxicity_scores_equal_loops(spark):
    docs, labels = tables(spark, toxic_text, "toxic")
    sample = training_sample(docs, labels, "toxic", fold("doc_id", 4) != 2, lexicon.FIT_ROWS)
    plain = PlainToxicity([(r["label"], r["text"]) for r in sample.collect()])
    model = lexicon.fit(sample)
    assert model.lexicon.words | {s + "*" for s in model.lexicon.stems} == plain.terms
    assert any(edits for _, edits in plain.counts) and {s for s in plain.signed} == set(plain.sign)
    # the weights are where the penalised likelihood has no slope
    x = np.array([plain.evidence(text, label) for label, text in plain.sample])
    y = np.array([label for label, _ in plain.sample], dtype=float)
    slope = x.T @ (1 / (1 + np.exp(-x @ model.weights)) - y) + np.array([1e-3] + [1.0] * (x.shape[1] - 1)) * model.weights
    assert np.abs(slope).max() < 1e-6
    want = sorted((r["doc_id"], 1 / (1 + math.exp(-float(model.weights @ plain.evidence(r["text"] or ""))))) for r in docs.collect())
    got = sorted((r["doc_id"], r["score"]) for r in lexicon.toxicity_scores(docs, labels).collect())
    assert [i for i, _ in got] == [i for i, _ in want]
    assert [s for _, s in got] == pytest.approx([s for _, s in want], abs=1e-9)
    held = {r["doc_id"] for r in lexicon.toxicity_scores(docs, labels).where("held_out").collect()}
    assert held == {r["doc_id"] for r in docs.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2}
