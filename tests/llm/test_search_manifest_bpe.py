"""Ranked search, Merkle manifest and BPE against plain versions."""
from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
from test_operators import LOWER, SF, rows_of

from trawl.llm import bpe, merkle, queries, ranked_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
PATH = public_tokenizers.path("word_bpe_49k.json")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute_search(docs, items, top):
    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n, size = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in sorted(set(items), key=repr):
        found = []
        for i, c in held:
            m = 25 + 75 * sum(c.values()) * n // size
            s = sum(k * ranked_search.weight(n, df[t]) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t, k in Counter(terms(text)).items() if t in c)
            if s > 0:
                found.append((s, i is not None, -(i or 0), i))
        out += [(item, k, i, s) for k, (s, _, _, i) in enumerate(sorted(found, reverse=True, key=lambda x: x[:3])[:top], 1)]
    return sorted(out, key=repr)


ITEMS = [(1, "base1 base2 again this very line"), (1, "another text of one id: w5 w6 w7"), (2, None), (3, ""), (4, "--- !!"),
         (None, "ünï cödé words BASE3"), (5, "this this THIS line"), (5, "this this THIS line"), (6, " ".join(f"w{i}" for i in range(900)))]


@pytest.mark.parametrize("top,tree,leaf", [(10, 4096, 48), (3, 4, 1)])
def test_ranked_search_odd_rows(spark, odd_docs, monkeypatch, top, tree, leaf):
    monkeypatch.setattr(ranked_search, "TREE", tree)
    monkeypatch.setattr(ranked_search, "LEAF", leaf)
    items = spark.createDataFrame([(*x, "clash") for x in ITEMS], "item_id long, text string, score string")
    got = rows_of(ranked_search.ranked_search(odd_docs, items, top, block_bytes=4000), "item_id", "rank", "doc_id", "score")
    assert got == brute_search([(r["doc_id"], r["text"]) for r in odd_docs.collect()], ITEMS, top)


def test_ranked_search_empty_tables(spark, odd_docs, no_docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert ranked_search.ranked_search(no_docs, items).count() == 0
    empty = ranked_search.ranked_search(odd_docs, items.limit(0))
    assert empty.count() == 0 and empty.dtypes == ranked_search.ranked_search(odd_docs, items).dtypes


def test_ball_tree_prunes_and_loses_nothing():
    rng = np.random.default_rng(5)
    # Families of like vectors: a query like one of them needs few leaves.
    families = [rng.choice(2000, 40, False) for _ in range(40)]
    rows = [np.unique(np.append(rng.choice(f, 36, False), rng.choice(2000, 2))) for f in families for _ in range(50)]
    held = [(r, rng.integers(10**8, 2 * 10**8, len(r))) for r in rows]
    items = ranked_search.Items([(k, b" ".join(b"t%d" % t for t in f)) for k, f in enumerate(families)])
    number = {t: items.vocabulary.get(b"t%d" % t, -1) for t in range(2000)}
    held = [(np.array([number[t] for t in r])[(ok := np.array([number[t] >= 0 for t in r]))], v[ok]) for r, v in held]
    best = [ranked_search.Best(10) for _ in items.ids]
    scored = ranked_search.search_block(list(range(len(held))), held, items, best)
    for k in range(len(items.ids)):
        times = dict(zip(items.terms[items.ends[k]:items.ends[k + 1]].tolist(), items.times[items.ends[k]:items.ends[k + 1]].tolist()))
        plain = sorted(((sum(int(x) * times.get(int(t), 0) for t, x in zip(*h)), -i) for i, h in enumerate(held)), reverse=True)[:10]
        assert sorted(best[k].rows(), key=lambda r: (-r[1], r[0])) == [(-i, s) for s, i in plain]
    assert scored < 0.5 * len(items.ids) * (len(held) / ranked_search.LEAF)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_manifest(rows, fanout=merkle.FANOUT):
    def leaf(r):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in r))

    def tree(nodes):
        """The root and each node's path."""
        paths, at, level = [[] for _ in nodes], list(range(len(nodes))), nodes
        while len(level) > 1:
            runs = [level[k:k + fanout] for k in range(0, len(level), fanout)]
            for p, a in zip(paths, at):
                run = runs[a // fanout]
                p.append(("".join(run[:a % fanout]), "".join(run[a % fanout + 1:])))
            at, level = [a // fanout for a in at], [sha("".join(r)) for r in runs]
        return level[0], paths

    groups = defaultdict(list)
    for r in rows:
        doc_id, source, lang, n_chars, text = r
        hit = doc_id is not None and crc32(str(doc_id).encode()) % 3 == 0
        changed = leaf((doc_id, source, lang, n_chars, text.translate(LOWER) if text is not None else None)) if hit else None
        groups[lang].append((doc_id is not None, doc_id or 0, leaf(r), changed))
    if not groups:
        return []
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in order}
    root, tops = tree([trees[g][0] for g in order])
    out = []
    for g, top in zip(order, tops):
        for (has, doc_id, own, changed), path in zip(sorted(groups[g], key=lambda x: x[:3]), trees[g][1]):
            h = changed or own
            for left, right in path + top:
                h = sha(left + h + right)
            out.append((doc_id if has else None, own, trees[g][0], root, sha("".join(left + right for left, right in path + top)), h, h == root))
    return sorted(out, key=repr)


MANIFEST = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def manifest_rows(df):
    return [(r["doc_id"], r["source"], r["lang"], r["n_chars"], r["text"]) for r in df.collect()]


def test_manifest(spark, odd_docs, no_docs):
    for docs in (odd_docs, spark.read.parquet(f"{SF}/documents.parquet")):
        assert rows_of(merkle.manifest_report(docs), *MANIFEST) == brute_manifest(manifest_rows(docs))
    assert merkle.manifest_report(no_docs).count() == 0


def test_manifest_of_repeated_null_and_far_ids(spark, monkeypatch):
    """A third of the rows has no id, some ids repeat with other texts, some rows in
    everything; ids spread over all 64 bits, one language has a row, many have a few."""
    monkeypatch.setattr(merkle, "COPIES", 3)
    r = random.Random(3)
    rows = [(None, f"Text {r.randrange(40)}", "en", "s", 3) for _ in range(150)]
    rows += [(r.choice([7, 70, -(1 << 63), (1 << 63) - 1, -1, 0]), f"Other {r.randrange(5)}", r.choice(["en", None]), "s", None) for _ in range(120)]
    rows += [(r.randrange(-(1 << 63), 1 << 63), None, r.choice(["en", "de"]), None, 1) for _ in range(80)]
    rows += [(k, "A", f"l{k % 37}", "s", 1) for k in range(120)] + [(5, "lone", "zz", "s", 1), (6, "", "", "s", 1), (64, "é", "é", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert rows_of(merkle.manifest_report(docs), *MANIFEST) == brute_manifest(manifest_rows(docs))


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(PATH)


def ids_of(data):
    return np.frombuffer(data, "<u4").tolist()


def test_bpe_query(spark, odd_docs, no_docs, library):
    for docs in (odd_docs, spark.read.parquet(f"{SF}/documents.parquet")):
        want = []
        for r in docs.collect():
            ids = library.encode(r["text"] or "", add_special_tokens=False).ids
            want.append((r["doc_id"], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                         sha(library.decode(ids, skip_special_tokens=False))))
        assert rows_of(bpe.tokens_report(docs, PATH), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=repr)
    assert bpe.tokens_report(no_docs, PATH).count() == 0


def test_bpe_keeps_columns(spark, odd_docs):
    docs = odd_docs.withColumnRenamed("kept", "ids")
    own = bpe.read_tokenizer(PATH)
    got = bpe.decode(bpe.encode(docs, own), own)
    assert got.columns == [c for c in docs.columns if c != "ids"] + ["ids", "decoded"]
    assert got.where("text = 'two words'").first()["decoded"] == "two</w> words</w>"


def test_bpe_automaton(library):
    own = bpe.read_tokenizer(PATH)
    assert len(own.automaton.owner) == 1 + 48894   # a state for each gadget
    r = random.Random(11)
    parts = ["aab", "abcdefgh", "the in er on an re st", "éüñßÀÖŞ 中文字 ", "'s't're 123 !?#", "<|endoftext|> <|startoftext|>", "<|endof",
             "́ėİΙΣσς", "😀👍🏽 ‍", "אב हिन्दी ไทย ﻿\x1c\x1d\x85\xa0 ", "".join(map(chr, range(0x20, 0x250)))]
    texts = ["".join(r.choice(r.choice(parts)) for _ in range(r.randrange(40))) for _ in range(3000)]
    texts += ["".join(r.choice(["<|endoftext|>", "z" * r.randrange(40), "ab", " ", "Ω"]) for _ in range(6)) for _ in range(500)]
    texts += ["a" * 20_000, "\r\n\t ", "x" + "́" * 50, *(f"a{chr(c)}b1" for c in range(0x80, 0x30000, 97) if not 0xD800 <= c < 0xE000)]
    for t in texts:
        ids = library.encode(t, add_special_tokens=False).ids
        assert ids_of(own.encode(t)) == ids, repr(t)
        assert bpe.labels_of(own.encode(t), own.labels) == library.decode(ids, skip_special_tokens=False)


def test_bpe_automaton_of_small_merges():
    """Every word over three letters against merging in order of rank."""
    a, b, c = range(3)
    merges = [(a, b), (a, a), (3, c), (4, b), (b, c), (4, 4), (3, 3), (5, a), (8, 8), (c, c), (7, 12)]
    merges = [(u, v, 3 + k) for k, (u, v) in enumerate(merges)]
    made = bpe.Automaton([a, b, c], merges)

    def plain(word):
        for u, v, w in merges:
            out, k = [], 0
            while k < len(word):
                if word[k:k + 2] == [u, v]:
                    out.append(w)
                    k += 2
                else:
                    out.append(word[k])
                    k += 1
            word = out
        return word

    for n in range(1, 9):
        for x in range(3 ** n):
            word = [x // 3 ** k % 3 for k in range(n)]
            assert made.encode(word) == plain(word), word


def test_queries_are_registered():
    assert [k for k in queries.QUERIES if k.split("_")[0] in ("op11", "op12", "op13")] == ["op11_ranked_search", "op12_merkle", "op13_bpe"]
