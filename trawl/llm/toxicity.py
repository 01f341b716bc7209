"""Toxicity: a Levenshtein automaton intersected with a lexicon trie, and the
context of each hit.

The lexicon is learned from labelled texts. One automaton reads a word letter by
letter in all trie nodes within the edits that a term allows at once, so misspelled
terms are found in one pass over the word. A word is read in the parts between its
punctuation and as a whole, with inner punctuation as letters. Each hit's window tells quotation from abuse; the hits
become the features of a logistic regression.
"""
from __future__ import annotations

import re
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import batch_of, held_out, stored
from trawl.llm.logistic import Logistic

SAMPLE = 20_000         # labelled rows that the lexicon and the regression are fitted on, at most
LEXICON = 2_000         # terms, at most
MIN_TERM_DOCS = 5
MIN_Z = 4.0
MIN_FUZZY = 5           # letters of a term and a word that may differ, by the automaton's narrow rule
MIN_ONE, MIN_TWO = 4, 9  # letters of a term that may have one and two edits, by its wide rule
WINDOW = 6              # words on either side of a hit
QUOTES = frozenset("\"“”„«»‘’")
REPORTING = frozenset("said says quote quoted wrote called word term dit écrit sagte schrieb dijo escribió".split())
ADDRESS = frozenset("you your you're u du dich ihr tu te toi vous tú usted".split())
_WORD = re.compile(r"[^\W_]+")
_WHOLE = re.compile(r"[^\W_](?:.*[^\W_])?", re.DOTALL)
FEATURES = 13


class Automaton:
    """The trie of the terms, read with the edits that each term allows.

    By the wide rule a term of MIN_ONE letters may have one edit, one of MIN_TWO two,
    whatever the word's length, and two swapped neighbours are one edit; by the narrow
    rule one edit, a swap being two, where term and word have MIN_FUZZY letters.
    States are sets of (node, letter that must come next, edits), made when they are
    first needed; they are dropped when their elements become many."""

    MOST_ELEMENTS = 1_000_000

    def __init__(self, terms: dict[str, float], wide: bool = False):
        self.terms, self.wide = terms, wide
        self.nodes: list[dict[str, int]] = [{}]
        self.ends: dict[int, str] = {}
        self.most = [0]                        # edits that some term through the node allows
        for term in terms:
            at, most = 0, self.allowed(term)
            self.most[0] = max(self.most[0], most)
            for c in term:
                if c not in self.nodes[at]:
                    self.nodes[at][c] = len(self.nodes)
                    self.nodes.append({})
                    self.most.append(0)
                at = self.nodes[at][c]
                self.most[at] = max(self.most[at], most)
            self.ends[at] = term
        self._reset()

    def allowed(self, term: str) -> int:
        return (len(term) >= MIN_ONE) + (len(term) >= MIN_TWO) if self.wide else int(len(term) >= MIN_FUZZY)

    def _reset(self) -> None:
        self.start = self._closed({(0, ""): 0})
        self.moves: dict[frozenset, dict[str, frozenset]] = {}
        self.elements = 0

    def _put(self, out: dict[tuple[int, str], int], node: int, due: str, edits: int) -> None:
        if edits <= min(self.most[node], out.get((node, due), edits + 1) - 1):
            out[node, due] = edits

    def _closed(self, state: dict[tuple[int, str], int]) -> frozenset:
        """With letters of the term left out."""
        out, todo = state, list(state.items())
        while todo:
            (node, due), edits = todo.pop()
            if due or out[node, due] < edits or edits >= self.most[node]:
                continue
            for child in self.nodes[node].values():
                was = out.get((child, ""))
                self._put(out, child, "", edits + 1)
                if out.get((child, "")) != was:
                    todo.append(((child, ""), edits + 1))
        return frozenset((node, due, edits) for (node, due), edits in out.items())

    def _move(self, state: frozenset, letter: str) -> frozenset:
        out: dict[tuple[int, str], int] = {}
        for node, due, edits in state:
            if due:
                if due == letter:
                    self._put(out, node, "", edits)                       # the second of two swapped letters
                continue
            child = self.nodes[node].get(letter)
            if child is not None:
                self._put(out, child, "", edits)
            if edits < self.most[node]:
                self._put(out, node, "", edits + 1)                       # a letter too many
                for c, other in self.nodes[node].items():
                    self._put(out, other, "", edits + 1)                  # a wrong letter
                    if self.wide and c != letter and letter in self.nodes[other]:
                        self._put(out, self.nodes[other][letter], c, edits + 1)
        return self._closed(out)

    def find(self, word: str) -> tuple[str, int] | None:
        """The nearest term within its edits (the heaviest of several), and the edits."""
        state = self.start
        for c in word:
            moves = self.moves.get(state)
            if moves is None:
                if self.elements > self.MOST_ELEMENTS:
                    self._reset()
                self.elements += len(state)
                moves = self.moves.setdefault(state, {})
            after = moves.get(c)
            if after is None:
                after = moves[c] = self._move(state, c)
                self.elements += len(after)
            if not after:
                return None
            state = after
        best = None
        for node, due, edits in state:
            term = None if due else self.ends.get(node)
            if term is not None and edits <= self.allowed(term) and (self.wide or edits == 0 or len(word) >= MIN_FUZZY):
                key = (edits, -self.terms[term], term)
                best = key if best is None or key < best else best
        return (best[2], best[0]) if best else None


class Scanner:
    """Features of a text; remembers the words it has read."""

    MOST_WORDS = 500_000

    def __init__(self, terms: dict[str, float]):
        self.automaton = Automaton(terms, wide=True)
        self.weight = terms
        self.seen: set[str] = set()
        self.bad: dict[str, list[tuple[str, int]]] = {}

    def _learn(self, words: set[str]) -> None:
        if len(self.seen) > self.MOST_WORDS:
            self.seen.clear()
            self.bad.clear()
        for w in words - self.seen:
            parts = _WORD.findall(w)
            if len(parts) > 1:
                parts.append(_WHOLE.search(w).group())
            hits: dict[str, int] = {}
            for part in parts:
                if h := self.automaton.find(part):
                    hits[h[0]] = min(h[1], hits.get(h[0], h[1]))
            if hits:
                self.bad[w] = list(hits.items())
            self.seen.add(w)

    def features(self, text: str | None) -> list[float]:
        words = (text or "").lower().split()
        distinct = set(words)
        self._learn(distinct)
        # Weak hits, of more than an edit for five letters of the term, have features of their
        # own: clean texts have them too, and the regression weighs them by what they tell.
        sums, cues, top, found, weak = [0.0] * 6, 0, 0.0, set(), set()
        if not distinct.isdisjoint(self.bad):
            for k, w in enumerate(words):
                for term, edits in self.bad.get(w, ()):
                    near = words[max(0, k - WINDOW):k] + words[k + 1:k + 1 + WINDOW]
                    quoted = not QUOTES.isdisjoint(w) or any(x.strip(".,:;") in REPORTING or not QUOTES.isdisjoint(x) for x in near)
                    if 5 * edits > len(term):
                        sums[4 + quoted] += self.weight[term]
                        weak.add(term)
                        continue
                    sums[2 * (edits > 0) + quoted] += self.weight[term]
                    cues += any(x.strip(".,:;!?") in ADDRESS or x.endswith("!") for x in near)
                    top = max(top, self.weight[term] / (1 + edits))
                    found.add(term)
        n = len(words)
        return [*np.log1p(sums), top, np.log1p(len(found)), sum(sums[:4]) / (n + 10.0), np.log1p(cues), np.log1p(n),
                top / np.log(n + 3.0), np.log1p(len(weak))]


def misspelled(text: str | None, terms: dict[str, float]) -> str:
    """The text in lower case with an inner letter of each term dropped, swapped or masked,
    by the term and its place, so that the regression sees what such spellings tell."""
    def wrong(m: re.Match) -> str:
        w = m.group()
        if w not in terms or len(w) < MIN_ONE:
            return w
        kind, at = divmod(crc32(f"{w} {m.start()}".encode()), len(w) - 2)
        at += 1
        return w[:at] + (w[at + 1:], w[at + 1] + w[at] + w[at + 2:], "*" + w[at + 1:])[kind % 3]

    return _WORD.sub(wrong, (text or "").lower())


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, sample: int) -> DataFrame:
    """(doc_id, text, y) of at most `sample` labelled ids outside the held-out ones,
    those of the least hash, with one row each: of several rows of an id, the text of
    the least hash. The ids are bounded by the parameter, so they are broadcast, and a
    task sends on one row of an id at most."""
    ids = (labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
           .groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max(F.col(label).cast("int")).alias("y"))
           .orderBy(F.xxhash64("id"), "id").limit(sample))
    return one_row_each(docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
                        .join(F.broadcast(ids), "id"), ["text"]).withColumnRenamed("id", "doc_id")


def one_row_each(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(id, *columns, y) of the row of each id whose columns have the least hash."""
    own = F.struct(*columns)
    least = F.min_by(own, F.struct(F.xxhash64(*columns), own)).alias("own")
    return rows.groupBy("id", "y").agg(least).select("id", *[F.col(f"own.{c}").alias(c) for c in columns], "y")


def learn_lexicon(train: DataFrame) -> dict[str, float]:
    """Terms whose share of toxic texts stands out, with their log odds."""
    schema = [("term", pa.string()), ("toxic", pa.int64()), ("clean", pa.int64())]

    def run(batches):
        counts = (Counter(), Counter())
        for b in batches:
            for t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                counts[1 - y].update({w for w in _WORD.findall((t or "").lower()) if len(w) > 2 and not w.isdigit()})
        terms = list(counts[0])   # a term without a toxic text can't enter
        yield batch_of(schema, terms, [counts[0][w] for w in terms], [counts[1][w] for w in terms])
        rest = [w for w in counts[1] if w not in counts[0]]
        yield batch_of(schema, rest, [0] * len(rest), [counts[1][w] for w in rest])

    n = {r["y"]: r["n"] for r in train.groupBy("y").agg(F.count("*").alias("n")).collect()}
    bad, good = n.get(1, 0), n.get(0, 0)
    if not bad or not good:
        return {}
    terms = (train.select("text", "y").mapInArrow(run, "term string, toxic long, clean long")
             .groupBy("term").agg(F.sum("toxic").alias("a"), F.sum("clean").alias("b")).where(F.col("a") >= MIN_TERM_DOCS))
    a, b = F.col("a") + 0.5, F.col("b") + 0.5
    odds = F.ln(a / (bad + 1 - a)) - F.ln(b / (good + 1 - b))
    z = odds / F.sqrt(1 / a + 1 / b)
    rows = (terms.where(a < bad + 1).where(b < good + 1).select("term", odds.alias("w"), z.alias("z")).where((F.col("z") >= MIN_Z) & (F.col("w") >= 1.5))
            .orderBy(F.desc("z"), "term").limit(LEXICON).collect())
    return {r["term"]: r["w"] for r in rows}


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per row of documents: doc_id, held_out, score (0 to 1), predicted.

    Only whole texts are scored; labels come from rows that are not held out.
    Null and empty texts have no hits and get the score of such a text; a null
    doc_id is never labelled; repeated rows score alike; of several labels the
    highest counts. Without labels of both kinds the score is the labels' share (0.5
    without any). No rows give no rows; other columns are ignored."""
    train = stored(labelled_sample(docs, labels, "toxic", sample), "tox-train")
    lexicon = learn_lexicon(train)

    def features(batches):
        scanner = Scanner(lexicon)
        for b in batches:
            rows = [scanner.features(x) for t in b.column(0).to_pylist() for x in (t, misspelled(t, lexicon))]
            yield batch_of([("x", pa.list_(pa.float64())), ("y", pa.int64())], rows, [y for y in b.column(1).to_pylist() for _ in range(2)])

    rows = train.select("text", "y").mapInArrow(features, "x array<double>, y long").toPandas()   # each labelled row twice
    model = Logistic().fit(np.array(rows["x"].tolist()).reshape(len(rows), FEATURES), rows["y"].to_numpy())
    schema = [("doc_id", pa.int64()), ("score", pa.float64())]

    def score(batches):
        scanner = Scanner(lexicon)
        for b in batches:
            x = np.array([scanner.features(t) for t in b.column(1).to_pylist()]).reshape(b.num_rows, FEATURES)
            yield batch_of(schema, b.column(0), model.predict(x))

    scored = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(score, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
