"""Every operator against a brute-force version, and its edge cases."""

import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from loghelm.llm import best_fit, common, lexicon, nbsvm, positional_index, prefix_forest, simhash_pivots, suffix_arrays, suffix_tree_lm, token_files, url_terms

DOC = "doc_id long, text string, lang string, source string, n_chars long, key string, id string"
WORDS = "the of and to in red blue green stone river cloud paper light moving quiet answer ñandú größe été".split()


def documents(spark, texts, first=0):
    """Documents with columns whose names the operators use inside."""
    rows = [(first + i, t, "en", f"s{i % 3}", None if t is None else len(t), "k", "x") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOC)


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(4)
    texts = [prose(rng, rng.randint(1, 120)) for _ in range(40)]
    shared = prose(rng, 40)
    texts += [f"{prose(rng, 9)} {shared}. {prose(rng, 12)}" for _ in range(6)]
    texts += [texts[3]] * 4 + [texts[5] + " end"] * 2 + ["", None, "a", " \n\t ", "é" * 70 + "x", "ab" * 400, "z" * 5000]
    return texts


def rows_by_id(df, *cols):
    return {r["doc_id"]: tuple(r[c] for c in cols) for r in df.collect()}


# --- 1 ---


def brute_repeats(texts, span=100):
    seen, out = set(), []
    for text in texts:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - span + 1):
            if raw[p : p + span] in seen:
                gone[p : p + span] = b"\1" * span
            seen.add(raw[p : p + span])
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        runs = sum(1 for k, g in enumerate(gone) if g and (not k or not gone[k - 1]))
        out.append((len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("hot_cells", [10_000, 2])
def test_suffix_arrays(spark, corpus, hot_cells):
    got = rows_by_id(suffix_arrays.remove_repeats(documents(spark, corpus).repartition(3), hot_cells=hot_cells), "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert [got[i] for i in range(len(corpus))] == brute_repeats(corpus)


def test_hot_passage_end_is_merged_in_bounded_ranges(spark, monkeypatch):
    """Many documents share a passage, each followed by other text."""
    rng = random.Random(12)
    shared = "".join(rng.choice("abcdefghij") for _ in range(130))
    texts = ["".join(rng.choice("klmn") for _ in range(20)) + shared + "".join(rng.choice("opqrstuv") for _ in range(150)) for _ in range(300)]
    docs = documents(spark, texts).repartition(4)
    numbered = suffix_arrays.unique_ids(docs)
    found = suffix_arrays.cut_cells(numbered, suffix_arrays.repeated_cells(numbered))
    ranges, cut_at = [], suffix_arrays.window_ranges

    def kept(*args):
        ranges.append(cut_at(*args))
        return ranges[0]

    monkeypatch.setattr(suffix_arrays, "window_ranges", kept)
    spans = suffix_arrays.shard_spans(found, hot_cells=20, run_windows=16)
    spans = spans.unionByName(found.where("spans IS NOT NULL").select("id", "spans"))
    packed = {}
    for r in spans.collect():
        packed.setdefault(r["id"], []).append(bytes(r["spans"]))
    for i, want in enumerate(brute_repeats(texts)):
        gone = suffix_arrays.merged_spans(packed.get(i, []))
        left = suffix_arrays.cut(texts[i].encode(), gone)
        assert (len(gone), hashlib.sha256(left).hexdigest()) == want[2:]
    sizes = [r["n"] for r in ranges[0].groupBy("key", "piece").agg((F.sum(F.octet_length("cell")) / 100).alias("n")).collect()]
    assert sum(sizes) > 5000 and max(sizes) < 1000


def test_suffix_array_and_prefixes():
    rng = random.Random(1)
    strings = list({bytes(rng.choice(b"ab\0") for _ in range(rng.randint(1, 40))) for _ in range(60)})
    sizes = np.array([len(s) for s in strings])
    stops = np.cumsum(sizes)
    starts, ends, codes = stops - sizes, np.repeat(stops, sizes), np.frombuffer(b"".join(strings), np.uint8)
    words = suffix_arrays.packed_words(codes, ends)
    order = suffix_arrays.suffix_array(words, ends)
    suffix = lambda i: codes[i : ends[i]].tobytes()
    assert sorted(order.tolist()) == list(range(len(codes)))
    for a, b in itertools.pairwise(order.tolist()):
        assert suffix(a) <= suffix(b)
    shared = suffix_arrays.common_prefixes(order, codes, words, starts, ends, 30)
    for r in range(1, len(order)):
        x, y = suffix(order[r - 1]), suffix(order[r])
        n = next((k for k, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))
        assert shared[order[r]] == min(n, 30)


def test_suffix_arrays_with_repeated_and_null_ids(spark, corpus):
    docs = documents(spark, corpus[:8] + corpus[:8]).withColumn("doc_id", F.when(F.col("doc_id") > 2, F.col("doc_id") % 8))
    kept = suffix_arrays.cut_documents(docs)
    assert kept.columns == docs.columns and kept.count() == 16
    order = sorted(docs.collect(), key=lambda r: (-1 if r["doc_id"] is None else r["doc_id"], r["text"] or ""))
    want = brute_repeats([r["text"] for r in order])
    got = sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["n_bytes"], r["n_removed"]) for r in suffix_arrays.remove_repeats(docs).collect())
    assert got == sorted((r["doc_id"] is not None, r["doc_id"] or 0, w[0], w[1]) for r, w in zip(order, want))


# --- 2 ---


def test_prefix_forest(spark):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((300, 16)) + 3 * rng.standard_normal((5, 16))[rng.integers(0, 5, 300)]
    x[20:40] = x[20]
    rows = [(i, v.tolist(), "n") for i, v in enumerate(x)]
    odd = [(900, None, "n"), (1000, [0.0] * 16, "n"), (1100, [math.nan] * 16, "n"), (1200, [1.0, 2.0], "n"), (None, x[0].tolist(), "n"), (1300, [math.inf] * 16, "n"), (1400, [None] * 16, "n")]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, v string")
    got = prefix_forest.nearest(df, F.col("vec_id") % 20 == 0).collect()
    hits = 0
    for q in range(0, 300, 20):
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        true = sorted((float(np.sqrt(((x[i] - x[q]) ** 2).sum())), i) for i in range(300) if i != q)[:10]
        assert [m[0] for m in mine] == list(range(1, 11))
        assert [(m[2], m[1]) for m in mine] == sorted((m[2], m[1]) for m in mine)
        assert all(abs(s - np.sqrt(((x[i] - x[q]) ** 2).sum())) < 1e-12 for _, i, s in mine)
        hits += len({m[1] for m in mine} & {i for _, i in true})
    assert hits >= 0.9 * 150
    assert {r["query_id"] for r in got} == set(range(0, 300, 20))
    assert prefix_forest.nearest(df.where("vec_id < 4"), F.col("vec_id") == 0).count() == 3


# --- 3 ---


def brute_matches(texts, items, window):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    low = lambda s: s.translate({i: i + 32 for i in range(65, 91)})
    windows = []
    for name, text in items:
        w = word.findall(low(text or ""))
        windows += [(name, tuple(w[k : k + window])) for k in range(max(1, len(w) - window + 1) if w else 0)]
    out = []
    for text in texts:
        w = word.findall(low(text or ""))
        hit, names = set(), set()
        for name, part in windows:
            for k in range(len(w) - len(part) + 1):
                if tuple(w[k : k + len(part)]) == part:
                    hit.update(range(k, k + len(part)))
                    names.add(str(name))
        sha = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((len(w), len(hit), len(names), sha, bool(hit)))
    return out


def test_positional_index(spark, corpus):
    items = [(2, corpus[40][30:150]), (10, "Stone RIVER"), (11, None), (12, " . "), (2, corpus[7]), (13, corpus[1])]
    table = spark.createDataFrame(items, "item_id long, text string")
    cols = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    got = rows_by_id(positional_index.contamination(documents(spark, corpus), table), *cols)
    want = brute_matches(corpus, items, 10)
    assert [got[i] for i in range(len(corpus))] == want
    small = positional_index.matches(documents(spark, corpus), table, item_bytes=60)
    assert sum(len(r["hits"]) > 0 for r in small.collect()) == sum(w[4] for w in want)
    kept = positional_index.drop_contaminated(documents(spark, corpus), table)
    assert {r["doc_id"] for r in kept.collect()} == {i for i, w in enumerate(want) if not w[4]}


def test_proximity(spark):
    docs = documents(spark, ["one two filler three four", "one two three four", "four three two one", "one x y z w v two three four"])
    table = spark.createDataFrame([(1, "one two three four")], "item_id long, text string")
    rows = positional_index.matches(docs, table, slop=1).collect()
    assert {r["doc_id"]: [h["phrase"] for h in r["hits"]] for r in rows} == {0: [False], 1: [True], 2: [], 3: []}


# --- 4 ---


def naive_fit(rows, capacity):
    bins, out = [], []
    for length, source, cluster in rows:
        fits = [(capacity - sum(x[0] for x in b), k) for k, b in enumerate(bins)]
        fits = [(room, k) for room, k in fits if room >= length and all((source is None or x[1] != source) and x[2] != cluster for x in bins[k])]
        k = min(fits)[1] if fits else len(bins)
        if not fits:
            bins.append([])
        bins[k].append((length, source, cluster))
        out.append(k)
    return out


def test_best_fit_equals_naive():
    rng = random.Random(3)
    rows = sorted(((rng.randint(1, 60), rng.choice(["a", "a", "b", "c", None]), rng.randint(0, 30)) for _ in range(300)), key=lambda r: -r[0])
    bins, _ = best_fit.best_fit([r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows], 100)
    assert bins == naive_fit(rows, 100)


def test_packed_documents(spark, corpus):
    packed = best_fit.pack_documents(documents(spark, [*corpus, prose(random.Random(8), 333)]), capacity=100, shard_rows=20).collect()
    pieces = {}
    for r in packed:
        pieces.setdefault(r["bin"], []).append(r)
        assert (r["bin"] is None) == (r["length"] == 0)
    lengths = {}
    for name, own in pieces.items():
        if name is None:
            continue
        assert sum(r["length"] for r in own) == own[0]["bin_used"] <= 100
        assert len({r["source"] for r in own}) == len({r["cluster"] for r in own}) == len(own)
        for r in own:
            lengths[r["doc_id"]] = lengths.get(r["doc_id"], 0) + r["length"]
    texts = [*corpus, prose(random.Random(8), 333)]
    assert lengths == {i: len(t.split()) for i, t in enumerate(texts) if t and t.split()}


# --- 5 and 6 ---


def labelled(spark, make, name, n=240):
    rng = random.Random(6)
    marks = [i % 4 == 0 for i in range(n)]
    docs = documents(spark, [make(rng, bad) for bad in marks] + [None, ""])
    rows = [(i, int(bad) if name == "toxic" else int(not bad), "x") for i, bad in enumerate(marks)]
    return docs, spark.createDataFrame(rows, f"doc_id long, {name} int, text string"), marks


def test_nbsvm(spark):
    make = lambda rng, bad: prose(rng, 40).upper().replace(" ", "!! ") if bad else prose(rng, 40)
    docs, labels, marks = labelled(spark, make, "quality")
    rows = nbsvm.quality_scores(docs, labels).collect()
    assert len(rows) == len(marks) + 2 and all(0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"] and r["doc_id"] < len(marks)]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert sum(r["predicted"] == (not marks[r["doc_id"]]) for r in held) >= 0.95 * len(held)
    assert nbsvm.quality_scores(docs.limit(0), labels.limit(0)).count() == 0
    assert {r["score"] for r in nbsvm.quality_scores(docs.limit(3), labels.limit(0)).collect()} == {0.5}


def test_dual_descent_reaches_the_optimum():
    rng = np.random.default_rng(0)
    x, y = rng.standard_normal((60, 4)), np.where(rng.random(60) < 0.5, 1.0, -1.0)
    indptr, index = np.arange(0, 241, 4), np.tile(np.arange(4), 60)
    w = nbsvm.dual_descent(indptr, index, x.ravel(), y, np.full(60, 0.5), 4, epochs=400)
    goal = lambda v: v @ v / 2 + 0.5 * np.maximum(0, 1 - y * (x @ v)).sum()
    assert all(goal(w) <= goal(w + 0.01 * rng.standard_normal(4)) + 1e-3 for _ in range(200))


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, p in enumerate(a, 1):
        new = [i]
        for j, q in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (p != q)))
        row = new
    return row[-1]


def test_lexicon_search_equals_edit_distance():
    rng = random.Random(2)
    terms = ["".join(rng.choice("abcé") for _ in range(rng.randint(3, 8))) for _ in range(60)]
    words = lexicon.Lexicon(terms, 1)
    for _ in range(500):
        token = "".join(rng.choice("abcé") for _ in range(rng.randint(2, 9)))
        want = {(t, 0) for t in terms if t == token} or {(t, 1) for t in terms if len(t) >= lexicon.FUZZY_LENGTH and edit_distance(t, token) == 1}
        assert set(words.search(token)) == want


def test_toxicity(spark):
    bad_words = ["grumblefoot", "slimehead", "dunderpate"]

    def make(rng, bad):
        words = prose(rng, 30).split()
        for _ in range(3 if bad else 0):
            term = rng.choice(bad_words)
            k = rng.randrange(len(term))
            words.insert(rng.randrange(len(words)), term[:k] + term[k + 1 :] if rng.random() < 0.2 else term)
        return " ".join(words)

    docs, labels, marks = labelled(spark, make, "toxic")
    rows = lexicon.toxicity_scores(docs, labels).collect()
    held = [r for r in rows if r["held_out"] and r["doc_id"] < len(marks)]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert len(rows) == len(marks) + 2 and all(0 <= r["score"] <= 1 for r in rows)
    assert sum(r["predicted"] == marks[r["doc_id"]] for r in held) >= 0.95 * len(held)
    kept = {r["doc_id"] for r in lexicon.drop_toxic(docs, labels).collect()}
    assert sum(not b for b in marks) <= len(kept) <= sum(not b for b in marks) + 4
    assert {r["score"] for r in lexicon.toxicity_scores(docs.limit(3), labels.limit(0)).collect()} == {0.0}


def test_swaps_are_one_edit():
    rng = random.Random(3)
    words = lexicon.Lexicon(["abcdefg", "bacabc"], 1, swaps=True)
    for term in words.words:
        for k in range(len(term) - 1):
            token = term[:k] + term[k + 1] + term[k] + term[k + 2 :]
            assert words.search(token) == ((term, 1),), token
    assert words.search("bacdegf") == () and words.search("bcadefg") == ()
    for _ in range(300):
        token = "".join(rng.choice("abc") for _ in range(rng.randint(5, 7)))
        near = {t for t in words.words if edit_distance(t, token) <= 1}
        assert near <= {t for t, _ in words.search(token)}


def test_unseen_misspelling_is_toxic(spark):
    """No training document has a misspelling, and no stem matches these."""
    training = ["grumblefoot", "slimehead", "dunderpate"]
    unseen = ["gurmblefoot", "sximehead", "dnderpate"]

    def make(rng, bad):
        words = prose(rng, 30).split()
        if bad:
            held = zlib.crc32(str(made[0]).encode()) % 4 == 2
            words.insert(rng.randrange(len(words)), rng.choice(unseen if held else training))
        made[0] += 4 if bad else 0
        return " ".join(words)

    made = [0]
    docs, labels, marks = labelled(spark, make, "toxic")
    rows = {r["doc_id"]: r for r in lexicon.toxicity_scores(docs, labels).collect()}
    held = [r for i, r in rows.items() if r["held_out"] and i < len(marks)]
    assert any(marks[r["doc_id"]] for r in held) and all(r["predicted"] == marks[r["doc_id"]] for r in held)
    kept = {r["doc_id"] for r in lexicon.drop_toxic(docs, labels).collect()}
    assert not any(marks[i] for i in kept if i < len(marks))


def test_window_signs():
    seen = lexicon.signs('they said "you idiot" and left; idiot again', {"idiot"})
    assert seen == {"idiot": {"reported", "direct"} & seen["idiot"]}
    assert lexicon.signs('a b "idiot" c', {"idiot"}) == {"idiot": {"quoted"}}


# --- 7 ---


def test_token_files(spark, corpus):
    path = public_tokenizers.path("byte_bpe_50k.json")
    hard = ["a  b", " lead", "end ", "x<|endoftext|> y", "it's 're 12 3.4,, ok.", "l1.\nL2 é\n\n x\ty", "\n\xa0z", "語 語"]
    texts = [*corpus, *hard]
    docs = documents(spark, texts).repartition(4)
    coder = token_files.encoder(path).tokenizer
    got, start = rows_by_id(token_files.encoded_documents(docs, path), "start", "n_tokens", "ids_crc32"), 0
    for i, text in enumerate(texts):
        ids = [*coder.encode(text or "", add_special_tokens=False).ids, 0]
        assert got[i] == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())), text
        start += len(ids)
    assert token_files.encoded_documents(docs.limit(0), path).count() == 0


@pytest.mark.parametrize("memo", [0, 7, 60, 10**6])
def test_encoder_with_a_small_memory(memo):
    path = public_tokenizers.path("byte_bpe_50k.json")
    coder, rng = token_files.Encoder(path, memo), random.Random(memo)
    for _ in range(12):
        texts = [" ".join(rng.choices([*WORDS, "x,", "no.1", "a\nb", "Red;", "\n", "", "语"], k=rng.randint(0, 30))) for _ in range(9)]
        ids, sizes = coder.encode(texts)
        parts = np.split(ids, np.cumsum(sizes)[:-1])
        assert [p.tolist() for p in parts] == [e.ids for e in coder.tokenizer.encode_batch(texts, add_special_tokens=False)]
        assert coder.known.count <= memo + 200


def test_token_files_of_one_id(spark):
    """Rows without an id, and rows of one id, come back in the order of their tokens."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = [f"text number {i % 9} again" for i in range(60)]
    docs = documents(spark, texts).withColumn("doc_id", F.when(F.col("doc_id") < 40, F.lit(7)).cast("long")).repartition(5)
    rows = sorted(token_files.encoded_documents(docs, path).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == [None] * 20 + [7] * 40
    ends = [r["start"] + r["n_tokens"] for r in rows]
    assert [r["start"] for r in rows] == [0, *ends[:-1]]


def test_code_round_trip():
    rng = np.random.default_rng(5)
    ranks = np.concatenate([rng.integers(0, 2**b, 37) for b in (3, 8, 9, 16, 17, 24, 25, 32)]).astype(np.uint32)
    lengths = np.array([100, 0, len(ranks) - 100])
    docs, sizes, back, before = token_files.unpack(token_files.pack(np.array([3, 4, 9]), lengths, ranks, 77))
    assert docs.tolist() == [3, 4, 9] and sizes.tolist() == lengths.tolist() and before == 77
    assert back.tolist() == ranks.tolist()


# --- 8 ---


def test_suffix_tree(spark, corpus):
    docs = documents(spark, corpus)
    rows = suffix_tree_lm.suffix_tree_scores(docs).collect()
    word = re.compile("[^\x20\x09-\x0d]+")
    low = lambda s: s.translate({i: i + 32 for i in range(65, 91)})
    tokens = {i: [*word.findall(low(t or "")), None] for i, t in enumerate(corpus)}
    counts = {}
    for i, own in tokens.items():
        if zlib.crc32(str(i).encode()) % 5 != 1:
            for t in own:
                counts[t] = counts.get(t, 0) + 1
    n, v = sum(counts.values()), len(counts)
    assert len(rows) == len(corpus)
    for r in rows:
        own = tokens[r["doc_id"]]
        base = sum(math.log10((counts.get(t, 0) + 0.5) / (n + 0.5 * (v + 1))) for t in own)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(own), sum(t in counts for t in own), n)
        assert r["base_score"] == pytest.approx(base) and r["score"] <= 0
    assert suffix_tree_lm.suffix_tree_scores(docs.limit(0)).count() == 0


class BruteTree:
    """The suffix tree in dictionaries of word tuples."""

    def __init__(self, texts, least, depth):
        self.least, self.depth = least, depth
        self.tokens = [[*t.lower().split(), None] for t in texts]
        self.seen, self.next = {}, {}
        for own in self.tokens:
            for i in range(len(own)):
                for k in range(1, min(depth + 1, i + 1) + 1):
                    string = tuple(own[i - k + 1 : i + 1])
                    self.seen[string] = self.seen.get(string, 0) + 1
                    self.next.setdefault(string[:-1], set()).add(string[-1])
        self.n = sum(c for s, c in self.seen.items() if len(s) == 1)
        self.v = sum(1 for s in self.seen if len(s) == 1)
        self.rests = {}

    def node(self, string):
        n = self.seen.get(string, 0)
        return n if n >= self.least else 0

    def base(self, word):
        return (self.seen.get((word,), 0) + 0.5) / (self.n + 0.5 * (self.v + 1))

    def own(self, context, word):
        return (self.node((*context, word)) + suffix_tree_lm.SMOOTH * self.share(context[1:], word)) / (self.node(context) + suffix_tree_lm.SMOOTH)

    def rest(self, context):
        """What a retained context leaves to symbols that are no nodes after it, else 0."""
        if context not in self.rests:
            words = [w for w in self.next.get(context, ()) if self.node((*context, w))]
            n = {w: self.node((*context, w)) for w in words}
            share = {w: self.own(context, w) for w in words}
            below = {w: self.share(context[1:], w) for w in words}
            left, low = 1 - sum(share.values()), 1 - sum(below.values())
            rest = max(left, 1e-12) / max(low, 1e-12)
            gain = sum(n[w] * math.log(share[w] / below[w]) for w in words)
            gain += max(self.node(context) - sum(n.values()), 0) * math.log(rest)
            kept = self.node(context) and words and gain >= suffix_tree_lm.GAIN and left > 0 and low > 0
            self.rests[context] = rest if kept else 0.0
        return self.rests[context]

    def share(self, context, word):
        if not context:
            return self.base(word)
        below, rest = self.share(context[1:], word), self.rest(context)
        if not rest:
            return below
        return self.own(context, word) if self.node((*context, word)) else rest * below

    def score(self, text):
        own = [*text.lower().split(), None]
        return sum(math.log10(self.share(tuple(own[max(0, i - self.depth) : i]), w)) for i, w in enumerate(own))


@pytest.mark.parametrize(("least", "depth"), [(2, 4), (3, 2), (8, 4)])
def test_suffix_tree_equals_dictionaries(spark, least, depth):
    rng = random.Random(least)
    lines = ["x a b c y a b d", "b c d a y x x b", "the red stone by the blue river", "a red stone by the green river"]
    texts = [" ".join([rng.choice(lines), *rng.choices(WORDS, k=rng.randint(0, 9)), rng.choice(lines)]) for _ in range(160)]
    train, held = texts[:120], [*texts[120:], "unseen words only", "", "x a b unseen c y"]
    tree = BruteTree(train, least, depth)
    docs = documents(spark, train + held).repartition(3)
    rows = suffix_tree_lm.suffix_tree_scores(docs, F.col("doc_id") >= len(train), least, depth).collect()
    assert len(rows) == len(train) + len(held)
    for r in rows:
        assert r["score"] == pytest.approx(tree.score((train + held)[r["doc_id"]]), abs=1e-9)
    kept = [c for c, rest in tree.rests.items() if rest]
    assert kept and max(map(len, kept)) >= min(depth, 2)
    for context in kept[:20]:
        symbols = [s[0] for s in tree.seen if len(s) == 1]
        unknown = tree.share(context, "never seen")
        assert sum(tree.share(context, w) for w in symbols) + unknown == pytest.approx(1)
    gained = sum(r["score"] - r["base_score"] for r in rows if r["held_out"])
    assert gained > 0


def doubled_words():
    """Two words that a polynomial modulo a power of two cannot tell apart, whatever its base."""
    a, b = b"p", b"q"
    for _ in range(10):
        a, b = a + b, b + a
    return a.decode(), b.decode()


def test_words_of_one_shape_are_different_words(spark):
    one, other = doubled_words()
    docs = documents(spark, [one + " x", other + " x"])
    items = spark.createDataFrame([("i", other)], "item_id string, text string")
    got = rows_by_id(positional_index.contamination(docs, items, window=1), "n_hit", "contaminated")
    assert got == {0: (0, False), 1: (1, True)}
    scores = rows_by_id(suffix_tree_lm.suffix_tree_scores(docs, F.col("doc_id") == 1), "n_known")
    assert scores == {0: (3,), 1: (2,)}


def test_terms_of_one_first_hash_stay_apart(spark, monkeypatch):
    """The second hash decides where the first says nothing."""
    monkeypatch.setattr(common, "prime_numbers", lambda codes, starts, ends: (ends - starts).astype(np.uint64))
    texts = ["bb aa cc aa dd", "aa dd", "cc bb"]
    terms, words = positional_index.text_terms([t.encode() for t in texts])
    assert len(np.unique(terms["a"])) == 1 and len(np.unique(terms["b"])) == 4
    numbers, windows = positional_index.item_windows([b"aa dd", b"zz"], 2)
    order = positional_index.term_order(terms)
    first = np.flatnonzero(np.concatenate(([True], terms[order][1:] != terms[order][:-1])))
    segment = positional_index.Segment(terms[order][first].tobytes(), np.diff(first, append=len(terms)).astype(np.int32).tobytes(), b"")
    found = segment.find(numbers)
    assert sorted((found >= 0).tolist()) == [False, True, True]
    assert all(segment.terms[i] == n for i, n in zip(found, numbers) if i >= 0)


def test_suffix_tree_keeps_rare_strings_and_long_contexts(spark, monkeypatch):
    """Strings seen MIN_COUNT times are nodes in a corpus of any size, contexts go past
    two words, and blocks and ranges do not change the scores."""
    rng = random.Random(8)
    noise = [" ".join(f"w{rng.randrange(300)}" for _ in range(400)) for _ in range(2600)]
    # what follows "q r s" depends on the word before it
    phrases = [f"start{i} q r s end{i}" for i in range(40)] * 9
    docs = documents(spark, noise + phrases + ["start1 q r s end1", "start1 q r s end2"])
    held = F.col("doc_id") >= len(noise) + len(phrases)

    def scores(block_bytes):
        monkeypatch.setattr(suffix_tree_lm, "BLOCK_BYTES", block_bytes)
        blocks = suffix_tree_lm.text_blocks(docs, held)
        tree, counted = suffix_tree_lm.fit(blocks)
        return tree, rows_by_id(suffix_tree_lm.score_blocks(blocks, counted, tree), "score")

    tree, got = scores(12 << 20)
    assert tree.total > 1_000_000 and tree.least == suffix_tree_lm.MIN_COUNT
    contexts = tree.levels[4].where("kind = 1 AND block IS NULL").select("made").collect()
    assert sum((suffix_tree_lm.inflate(r["made"], np.float64) > 0).sum() for r in contexts) == 40
    right, wrong = got[len(noise) + len(phrases)][0], got[len(noise) + len(phrases) + 1][0]
    # at 1e-5 of the tokens the 9 occurrences would be no nodes, and two words can not tell the ends apart
    assert right > wrong + 0.5
    _, parted = scores(300_000)
    assert all(parted[i][0] == pytest.approx(got[i][0], abs=1e-9) for i in got)


# --- 9 ---


def test_urls(spark):
    cases = {
        "http://A.Example.com/en/x?q": ("a.example.com", "/en/x", "example.com/en/", "block"),
        "http://www.example.com/en/": ("www.example.com", "/en/", "www.example.com/en/", "allow"),
        "http://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"),
        "https://x.net/fr/#a": ("x.net", "/fr/", "net/fr/", "block"),
        "http://com": ("com", "", None, "allow"),
        "http://a.org/PORN/1": ("a.org", "/PORN/1", None, "block"),
        "http://a.org/pornography": ("a.org", "/pornography", None, "allow"),
        "http://a.org/casino-casino": ("a.org", "/casino-casino", None, "allow"),
        "http://a.org/casino/poker": ("a.org", "/casino/poker", None, "block"),
        "no scheme porn": ("", "", None, "block"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
    }
    df = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(cases)], "page_id long, url string, host string, rule string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_terms.judge_urls(df).collect()}
    assert [got[i] for i in range(len(cases))] == list(cases.values())


# --- 10 ---


def brute_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0d]+", text.encode().translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))))
    if not words:
        return 0
    hashes = [xxhash.xxh64(b" ".join(words[i : i + 3]), seed=42).intdigest() for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(values, bits=2):
    label = list(range(len(values)))
    find = lambda i: i if label[i] == i else find(label[i])
    for i, j in itertools.combinations(range(len(values)), 2):
        if (values[i] ^ values[j]).bit_count() <= bits:
            a, b = find(i), find(j)
            label[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def test_simhash(spark, corpus):
    got = rows_by_id(simhash_pivots.simhash_components(documents(spark, corpus)), "fingerprint", "component_id")
    values = [brute_fingerprint(t or "") for t in corpus]
    roots = brute_components(values)
    assert [got[i] for i in range(len(corpus))] == [(format(v, "016x"), r) for v, r in zip(values, roots)]
    kept = simhash_pivots.keep_one_per_component(documents(spark, corpus))
    assert {r["doc_id"] for r in kept.collect()} == set(roots)


def test_one_row_per_component_with_null_ids(spark):
    rng = random.Random(9)
    texts = [prose(rng, 60) for _ in range(4)]
    rows = [(7, texts[0]), (None, texts[0]), (None, texts[1]), (None, texts[1]), (4, texts[2]), (4, texts[3]), (2, texts[3]), (None, None), (None, "")]
    docs = spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id long, text string, lang string")
    made = simhash_pivots.keep_one_per_component(docs)
    assert made.schema == docs.schema
    got = sorted(((r["doc_id"], r["text"] or "", r["lang"]) for r in made.collect()), key=str)
    assert got == sorted([(7, texts[0], "en"), (None, texts[1], "en"), (4, texts[2], "en"), (2, texts[3], "en"), (None, "", "en")], key=str)


def test_chains_of_fingerprints(spark):
    rng = random.Random(9)
    values = [rng.getrandbits(64) for _ in range(40)]
    for _ in range(160):
        v = rng.choice(values)
        for bit in rng.sample(range(64), rng.randint(1, 3)):
            v ^= 1 << bit
        values.append(v)
    values = sorted(set(values))
    df = spark.createDataFrame([(v - 2**64 if v >= 2**63 else v,) for v in values], "fp long")
    edges = simhash_pivots.links(df)
    found = {r["node"]: r["root"] for r in simhash_pivots.components(edges).collect()}
    signed = [v - 2**64 if v >= 2**63 else v for v in values]
    groups = {}
    for v, r in zip(signed, brute_components(values)):
        groups.setdefault(r, []).append(v)
    for own in groups.values():
        assert {found.get(v, v) for v in own} == {min(own)}
