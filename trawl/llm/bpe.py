"""BPE encoding and decoding with a tokenization automaton.

The merges of a tokenizer file are compiled, one after the other, into a
deterministic automaton whose arcs are labelled with tokens and whose paths are
just the tokenizations that the merges give. At first there is one state with an
arc to itself for each symbol (a byte, or a byte that ends a word). The gadget of
a merge (u, v) sends all arcs of u to a copy of the state behind them that has no
arc v, and adds an arc uv, wherever there is an arc u, to the state behind v: after
u, v can no longer follow, since the two would have been merged.

All arcs of a label lead to one state, so a state is stored as what its gadget
changed: the state it copies and the label it cuts. An entry (state, label) of the
transition table is worked out from those when it is first needed and kept.

A word has exactly one path, and so has each of its beginnings. Encoding reads it
once from left to right: from each place reached, the tokens that can start there
are read off a trie, and those with an arc in the state of the place reach on.
Decoding emits the labels of the arcs taken.
"""
from __future__ import annotations

import json
import math
import re
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import Shared, byte_slices, with_text

KEPT_WORDS = 1 << 16     # words whose tokens a worker remembers, and as many from before (cost only)
KEPT_ARCS = 1 << 20      # table entries a worker remembers (cost only)

# What the tokenizer file must name: steps this module knows (fixed values).
NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": WORDS}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}

_SPACES = "\t-\r \x85\xa0  -     　"
# Scripts whose characters every Unicode version of the last ten years classes
# alike; a text with any other goes through the tokenizer file's own steps.
_KNOWN = "\x00-ӿ -⁯€぀-ゖァ-ヺ一-龥가-힣"


class Words:
    """Splits texts into words as the tokenizer file says."""

    def __init__(self, spec: dict):
        self.spec = spec
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self._words = regex.compile(WORDS.replace(r"\s", _SPACES))
        self._ascii = re.compile(WORDS.replace(r"\p{L}", "a-z").replace(r"\p{N}", "0-9"), re.ASCII)
        self._other = re.compile(f"[^{_KNOWN}]")
        self._own = None

    def _by_file(self, text: str) -> list[str]:
        if self._own is None:
            from tokenizers import Tokenizer
            self._own = Tokenizer.from_str(json.dumps(self.spec))
            back = {c: b for b, c in byte_letters().items()}
            self._bytes = lambda word: bytes(back[c] for c in word).decode("utf-8")
        text = self._own.normalizer.normalize_str(text)
        return [self._bytes(w) for w, _ in self._own.pre_tokenizer.pre_tokenize_str(text)]

    def _of(self, text: str) -> list[str]:
        if self._other.search(text):
            return self._by_file(text)
        # No word has white space, so there is no need to replace it by spaces first.
        if text.isascii():
            return self._ascii.findall(text.lower())
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")   # letter by letter: no final sigma
        return self._words.findall(text.lower())

    def of(self, text: str) -> list[str | int]:
        """The words of a text, and the ids of special tokens where their strings stand."""
        if self._split is None or not self._split.search(text):
            return self._of(text)
        out: list[str | int] = []
        for k, part in enumerate(self._split.split(text)):
            out += [self.special[part]] if k % 2 else self._of(part)
        return out


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: printable
    bytes stand for themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in plain}
    for b in range(256):
        out.setdefault(b, chr(256 + len(out) - len(plain)))
    return out


class Automaton:
    """The tokenization automaton of a list of merges.

    `symbols` are the labels that no merge makes, `merges` (u, v, uv) in order."""

    def __init__(self, symbols: list[int], merges: list[tuple[int, int, int]]):
        size = 1 + max([*symbols, *(w for _, _, w in merges)], default=0)
        self.size = size
        self.left, self.born = [-1] * size, [0] * size   # of a label: its first part, the gadget that made it
        self.target = [-1] * size                        # of a label: the state its arcs lead to now
        self.start = [0] * size                          # of a label: that state before any gadget of its own
        self.owner = [0]                                 # of a state: the label whose arcs its gadget sent there
        self.opened: dict[int, int] = {}                 # label -> the first gadget that merged it with what follows
        self.cut: dict[int, int] = {}                    # (label u, label v) -> the gadget that cut v after u
        # Of the reader, filled when first needed: (state, symbol) -> (next state, token that ends, its length).
        self.table: dict[int, tuple[int, int, int]] = {}
        self.readers: dict[tuple, int] = {}
        spelled: dict[int, tuple[int, ...]] = {x: (x,) for x in symbols}
        for x in symbols:
            self.target[x] = 0
        for u, v, w in merges:
            if u not in spelled or v not in spelled or w in spelled:
                raise ValueError(f"merge {u}, {v} does not build on earlier ones")
            if self.target[u] >= 0 and self.target[v] >= 0 and self._arc(self.target[u], v):
                k, behind = len(self.owner), self.target[v]
                self.owner.append(u)
                self.cut[u * size + v] = k
                self.target[u] = k
                self.left[w], self.born[w] = u, k
                self.opened.setdefault(u, k)
                self.target[w] = self.start[w] = behind
                spelled[w] = spelled[u] + spelled[v]
            else:   # earlier merges always take u or v apart: no path has uv
                self.left[w], self.born[w], self.target[w] = u, len(self.owner) - 1, -1
                spelled[w] = ()
        # Symbol -> (token that ends here or -1, what goes on from here).
        self.trie: dict = {}
        for w, path in spelled.items():
            node, end = self.trie, len(path) - 1
            for k, x in enumerate(path):
                token, below = node.get(x, (-1, None))
                below = {} if below is None else below
                node[x] = (w if k == end else token, below)
                node = below

        self.pending: list[tuple] = [((0, self.trie, 0),)]

    def _arc(self, state: int, label: int) -> bool:
        """Whether the state has an arc of that label. A copy has the arcs of the
        state it copies but the one cut; a label made later is there where its
        first part was there when it was made."""
        while state:
            u, x, made = self.owner[state], label, math.inf
            while x >= 0:
                k = self.cut.get(u * self.size + x)
                if k is not None and k <= state and k <= made:
                    return False
                x, made = self.left[x], self.born[x]
            state = self.start[u]
        return True

    def _shut(self, state: int, symbol: int) -> bool:
        """Whether the state has no arc of any token that begins with the symbol: the
        symbol was cut before the first merge that begins with it."""
        first = self.opened.get(symbol, math.inf)
        while state:
            u = self.owner[state]
            k = self.cut.get(u * self.size + symbol)
            if k is not None and k <= state and k <= first:
                return True
            state = self.start[u]
        return False

    def _next(self, pending: tuple, symbol: int) -> tuple[int, int, int]:
        """Works out a transition: the state of the reader after one more symbol, the
        token that ends there, and how many symbols it has.

        The reader's state is what can still grow: for each place before, the state
        of the automaton there, and how far the trie has been followed from it."""
        grown, end = [], None
        for at, node, n in pending:
            if n == 0 and self._shut(at, symbol):
                continue
            hit = node.get(symbol)
            if hit is not None:
                x, below = hit
                if x >= 0 and self._arc(at, x):
                    end = (x, n + 1)
                if below:
                    grown.append((at, below, n + 1))
        if end is None:
            raise ValueError("no path spells this word")
        grown.append((self.target[end[0]], self.trie, 0))
        key = tuple((at, id(node)) for at, node, _ in grown)
        to = self.readers.get(key)
        if to is None:
            to = self.readers[key] = len(self.pending)
            self.pending.append(tuple(grown))
        return to, *end

    def encode(self, symbols: list[int]) -> list[int]:
        """The labels of the one path that spells the symbols."""
        if len(self.table) >= KEPT_ARCS:
            self.table, self.readers, self.pending = {}, {}, [((0, self.trie, 0),)]
        at, taken, size, table = 0, [], self.size, self.table
        for x in symbols:
            entry = table.get(at * size + x)
            if entry is None:
                entry = table[at * size + x] = self._next(self.pending[at], x)
            taken.append(entry)
            at = entry[0]
        out, i = [], len(symbols)
        while i:
            _, x, n = taken[i - 1]
            out.append(x)
            i -= n
        return out[::-1]

    def __getstate__(self):
        return self.__dict__ | {"table": {}, "readers": {}, "pending": None}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.pending = [((0, self.trie, 0),)]


class Tokenizer:
    """A byte-level BPE with word ends, from the text of a tokenizer file."""

    def __init__(self, file_text: str):
        spec = json.loads(file_text)
        model = spec["model"]
        if (spec["normalizer"], spec["pre_tokenizer"], spec["post_processor"], spec["decoder"]) != (NORMALIZER, PRE_TOKENIZER, None, None):
            raise ValueError("not a tokenizer of the kind this module reads")
        if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("special tokens must be plain strings of the raw text")
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        letters = byte_letters()
        # A byte's symbol, and the one of a byte that ends its word.
        self.inner, self.last = ([vocab[letters[b] + x] for b in range(256)] for x in ("", end))
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.automaton = Automaton(self.inner + self.last, [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs])
        self.labels = {i: s for s, i in vocab.items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        self.packed = {i: i.to_bytes(4, "little") for i in self.labels}
        self.words = Words({k: v for k, v in spec.items() if k != "model"} | {"model": {"type": "BPE", "vocab": {}, "merges": []}})
        self.known: dict[str | int, bytes] = {}
        self.before: dict[str | int, bytes] = {}

    def word_ids(self, word: str) -> bytes:
        b = word.encode("utf-8")
        path = self.automaton.encode([*map(self.inner.__getitem__, b[:-1]), self.last[b[-1]]])
        return b"".join(map(self.packed.__getitem__, path))

    def encode(self, text: str | None) -> bytes:
        """The ids of a text, each as a little-endian unsigned 32-bit integer."""
        out = []
        for w in self.words.of(text or ""):
            if (ids := self.known.get(w)) is None:
                if len(self.known) >= KEPT_WORDS:   # the words of the last stretch stay at hand, so common ones do
                    self.known, self.before = {}, self.known
                if (ids := self.before.get(w)) is None:
                    ids = self.word_ids(w) if isinstance(w, str) else self.packed[w]
                self.known[w] = ids
            out.append(ids)
        return b"".join(out)


def labels_of(ids: bytes | None, labels: dict[int, str]) -> str:
    """The labels of the arcs, with a space between: these files name no decoder
    that would join them in another way."""
    return " ".join(map(labels.__getitem__, np.frombuffer(ids or b"", "<u4").tolist()))


def read_tokenizer(path: str) -> Tokenizer:
    with open(path, encoding="utf-8") as f:
        return Tokenizer(f.read())


def _fields(df: DataFrame, without: str) -> tuple[list[str], str]:
    kept = [f for f in df.schema.fields if f.name != without]
    return [f.name for f in kept], "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept)


def encode(docs: DataFrame, tokenizer: Tokenizer, into: str = "ids") -> DataFrame:
    """All columns of the documents and `into`: the token ids of the whole text as
    little-endian unsigned 32-bit integers (binary).

    The strings of special tokens in a text get their ids, as in the library the
    files are made for; none are added. Null and empty texts, and texts of white
    space only, have no tokens (an empty binary). Rows are independent: repeated
    rows repeat, no rows give no rows; a column named as `into` is replaced."""
    sent_tokenizer = Shared(docs.sparkSession, tokenizer, keep=True)   # as large as its file makes it, whatever the documents
    names, ddl = _fields(docs, into)
    sent, at = with_text(docs, names)

    def run(batches):
        t = sent_tokenizer.value
        for b in batches:
            for i, j, texts in byte_slices(b.column(at)):
                ids = pa.array([t.encode((x or b"").decode("utf-8", "replace")) for x in texts], pa.binary())
                yield pa.RecordBatch.from_arrays([*(b.column(k).slice(i, j - i) for k in range(len(names))), ids],
                                                 names=[*names, into])

    return sent.mapInArrow(run, f"{ddl}`{into}` binary")


def decode(encoded: DataFrame, tokenizer: Tokenizer, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """All columns of `encoded` and `into`: the labels of the token ids in column
    `ids`, joined by spaces. Null and no ids give an empty text; an id that the file
    does not have fails the job."""
    labels = Shared(encoded.sparkSession, tokenizer.labels)
    names, ddl = _fields(encoded, into)
    at = names.index(ids)

    def run(batches):
        t = labels.value
        for b in batches:
            for i, j, found in byte_slices(b.column(at)):
                texts = pa.array([labels_of(x, t) for x in found], pa.string())
                yield pa.RecordBatch.from_arrays([*(b.column(k).slice(i, j - i) for k in range(len(names))), texts],
                                                 names=[*names, into])

    return encoded.select(*[F.col(f"`{c}`") for c in names]).mapInArrow(run, f"{ddl}`{into}` string")


def tokens_report(docs: DataFrame, path: str) -> DataFrame:
    """One row per row of documents: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    tokenizer = read_tokenizer(path)
    ids = encode(docs.select("doc_id", "text"), tokenizer).select("doc_id", "ids")
    t = decode(ids, tokenizer)
    return t.select("doc_id", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                    F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
