"""Passages of held-out items inside documents, found with a generalised suffix automaton.

The items (a fixed, size-checked set) form one suffix automaton over their words. Each document's words
stream through it once; at every word where the match has SEED words or more, all occurrences of its last SEED
words in the items are read off the automaton, also those of items whose match is shorter than the longest. A passage of 20 or more words with at most one error in ten words always holds an exact
run of 6 (20 words with 2 errors leave 18 in 3 runs; longer ones leave more), so no case is missed. Each run
of seeds on a diagonal of an item is extended once in both directions by furthest-reaching alignments, exact in
the number of errors.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words of the shortest passage, words for each tolerated error, and the exact run any such passage holds.
PASSAGE, PER_ERROR, SEED = 20, 10, 6
#: Memory that the automaton of one set of items may take in a worker, and what a word of items takes (measured: 665
#: bytes); items beyond it are taken in further sets, each with a pass of its own over the documents.
AUTOMATON_BYTES, BYTES_PER_WORD = 160_000_000, 700
_WORD = re.compile(r"[^\W_]+")
_IN_NUMBER = re.compile(r"(?<=\d)[.,](?=\d)")


def words_of(text: str) -> list[tuple[str, int, int]]:
    """(word, start, end) with case, punctuation, spacing and line breaks ignored."""
    return [(m.group().lower(), m.start(), m.end()) for m in _WORD.finditer(text)]


def _plain(text: str) -> str:
    """Compatibility forms and soft hyphens resolved; a number written with or without its points is one word."""
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text).replace("\u00ad", "")
    return _IN_NUMBER.sub("", text)


class Automaton:
    """Generalised suffix automaton of word sequences. Words are numbered; a separator ends each item."""

    def __init__(self, items: list[tuple[int, str]]):
        self.ids = [i for i, _ in items]
        self.vocab: dict[str, int] = {}
        text: list[int] = []
        owner: list[int] = []
        for n, (_, t) in enumerate(items):
            for w, _, _ in words_of(_plain(t)):
                text.append(self.vocab.setdefault(w, len(self.vocab)))
                owner.append(n)
            text.append(-1 - n)  # a separator of its own, so that no match crosses items
            owner.append(n)
        self.text = np.asarray(text, np.int64)
        self.list = text
        self.owner = owner
        self._build(text)

    def _build(self, text: list[int]) -> None:
        nxt: list[dict[int, int]] = [{}]
        link, length, end = [-1], [0], [-1]
        last = 0
        for at, c in enumerate(text):
            cur = len(nxt)
            nxt.append({})
            link.append(0)
            length.append(length[last] + 1)
            end.append(at)
            p = last
            while p != -1 and c not in nxt[p]:
                nxt[p][c] = cur
                p = link[p]
            if p != -1:
                q = nxt[p][c]
                if length[p] + 1 == length[q]:
                    link[cur] = q
                else:
                    clone = len(nxt)
                    nxt.append(dict(nxt[q]))
                    link.append(link[q])
                    length.append(length[p] + 1)
                    end.append(-1)
                    while p != -1 and nxt[p].get(c) == q:
                        nxt[p][c] = clone
                        p = link[p]
                    link[q] = link[cur] = clone
            last = cur
        self.next, self.link, self.length = nxt, link, length
        # end positions below each state, as slices of one array in depth-first order of the suffix links
        children: list[list[int]] = [[] for _ in nxt]
        for v in range(1, len(nxt)):
            children[link[v]].append(v)
        first, stop, ends = [0] * len(nxt), [0] * len(nxt), []
        seed = list(range(len(nxt)))  # of each state, the ancestor that stands for the last SEED words
        stack = [(0, False)]
        while stack:
            v, done = stack.pop()
            if done:
                stop[v] = len(ends)
                continue
            first[v] = len(ends)
            if v and length[link[v]] >= SEED:  # parents come first
                seed[v] = seed[link[v]]
            if end[v] >= 0:
                ends.append(end[v])
            stack.append((v, True))
            stack += [(c, False) for c in children[v]]
        self.first, self.stop, self.ends, self.seed = first, stop, ends, seed

    def matches(self, ids: list[int], lo: int, hi: int) -> Iterator[tuple[int, int]]:
        """(end, state) of every SEED words in ids[lo:hi] that the items have; their occurrences stand below the state."""
        nxt, link, length, seed = self.next, self.link, self.length, self.seed
        v = n = 0
        for at in range(lo, hi):
            c = ids[at]
            if c not in nxt[v]:
                while v and c not in nxt[v]:
                    v = link[v]
                n = length[v]
            if c in nxt[v]:
                v = nxt[v][c]
                n += 1
                if n >= SEED:
                    yield at + 1, seed[v]


def _reach(a: list[int], b: list[int], i: int, j: int, step: int, stop: int, most: int) -> list[tuple[int, int]]:
    """(words of a passed, words of b passed) that e errors allow, for e = 0..most: the furthest in a, ending in a match.

    a is the item, walked from i towards stop; b the document, walked from j. step: 1 or -1.
    """
    la = (stop - i) * step
    lb = len(b) - j if step == 1 else j + 1
    out: list[tuple[int, int]] = []
    best = (0, 0)
    front: dict[int, int] = {}
    for e in range(most + 1):
        new: dict[int, int] = {}
        for k in range(-e, e + 1):  # k: words of a passed less words of b passed
            if e == 0:
                x = 0
            else:
                x = max(front.get(k, -1) + 1, front.get(k - 1, -1) + 1, front.get(k + 1, -1))
                if k not in front and k - 1 not in front and k + 1 not in front:
                    continue
            x = min(x, la)
            y = x - k
            if y < 0 or y > lb or x < 0:
                continue
            began = x
            while x < la and y < lb and a[i + step * x] == b[j + step * y]:
                x += 1
                y += 1
            new[k] = x
            if x > began and x > best[0]:
                best = (x, y)
        front = new
        out.append(best)
        if not front:
            break
    return out


def passages(automaton: Automaton, ids: list[int], runs: list[tuple[int, int]]) -> dict[int, tuple[int, int]]:
    """item number -> (first word, end) in the document of its longest passage found."""
    found: dict[int, tuple[int, int]] = {}
    tried: dict[tuple[int, int], int] = {}  # item and diagonal -> end of the run of words in common that was extended last
    text, owner = automaton.list, automaton.owner
    for lo, hi in runs:
        for end, state in automaton.matches(ids, lo, hi):
            for at in automaton.ends[automaton.first[state] : automaton.stop[state]]:
                item = owner[at]
                if tried.get((item, at - end), 0) >= end:
                    continue
                a0, d0 = at - SEED + 1, end - SEED  # first word of the seed in the items' text and in the document
                start, stop = at, at
                while start > 0 and text[start - 1] >= 0:
                    start -= 1
                while text[stop] >= 0:
                    stop += 1
                most = max(2, (stop - start) // PER_ERROR)
                right = _reach(text, ids, at + 1, end, 1, stop, most)
                tried[item, at - end] = end + right[0][1]
                left = _reach(text, ids, a0 - 1, d0 - 1, -1, start - 1, most)
                best = None
                for e1, (x1, y1) in enumerate(left):
                    for e2, (x2, y2) in enumerate(right):
                        size = SEED + x1 + x2
                        if size >= PASSAGE and size >= PER_ERROR * (e1 + e2) and (best is None or size > best[0]):
                            best = (size, d0 - y1, end + y2)
                if best:
                    old = found.get(item)
                    if old is None or best[2] - best[1] > old[1] - old[0]:
                        found[item] = (best[1], best[2])
    return found


def _runs(ids: np.ndarray) -> list[tuple[int, int]]:
    """Stretches of SEED or more words that the items have."""
    known = np.r_[0, (ids >= 0).astype(np.int8), 0]
    step = np.diff(known)
    lo, hi = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    keep = hi - lo >= SEED
    return list(zip(lo[keep].tolist(), hi[keep].tolist(), strict=True))


def document_passages(automaton: Automaton, text: str) -> list[tuple[int, int, int, int]]:
    """(item id, start, end, words) of each leaked item: characters of the normalised text and number of words."""
    plain = _plain(text)
    get = automaton.vocab.get
    words = [w.lower() for w in _WORD.findall(plain)]
    ids = [get(w, -1) for w in words]
    runs = _runs(np.fromiter(ids, np.int64, len(ids)))
    if not runs:
        return []
    found = passages(automaton, ids, runs)
    if not found:
        return []
    at = words_of(plain)
    return [(automaton.ids[i], at[a][1], at[b - 1][2], b - a) for i, (a, b) in found.items()]


def item_sets(items: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The items, one set after the other, in sets of at most AUTOMATON_BYTES (an item of more is a set of its own)."""
    one: list[tuple[int, str]] = []
    size = 0
    for r in items.select("item_id", "text").where("item_id is not null and text is not null").distinct().orderBy("item_id", "text").toLocalIterator():
        n = len(words_of(_plain(r.text))) * BYTES_PER_WORD
        if one and size + n > AUTOMATON_BYTES:
            yield one
            one, size = [], 0
        one.append((r.item_id, r.text))
        size += n
    yield one


def leaked_passages(documents: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, item_id, start, end, words: where (characters of the normalised text) a document holds how long a passage of an item.

    A passage has PASSAGE or more consecutive words of the item, at most one in PER_ERROR of them replaced,
    dropped or added, and begins and ends with a word in common. Case, punctuation, spacing and line breaks
    don't count. The longest passage of each item is given. Null and empty texts and items have none. No
    shuffle: the automaton goes to each worker, its size checked.
    """
    out = None
    for group in item_sets(items):
        shared = documents.sparkSession.sparkContext.broadcast(group)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            automaton = _automaton(shared)
            for b in batches:
                rows = [(i, *p) for i, t in zip(b[0].to_pylist(), b[1].to_pylist(), strict=True) if t for p in document_passages(automaton, t)]
                columns = list(zip(*rows, strict=True)) if rows else [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "item_id", "start", "end", "words"])

        one = documents.select("doc_id", "text").mapInArrow(run, "doc_id long, item_id long, start long, end long, words long")
        out = one if out is None else out.unionByName(one)
    return out


_built: dict[int, Automaton] = {}


def _automaton(shared) -> Automaton:
    """The worker's automaton of these items, built once."""
    key = hash(tuple(shared.value))
    if key not in _built:
        _built.clear()
        _built[key] = Automaton(shared.value)
    return _built[key]


def leaked_items(documents: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, item_id of each document that contains a passage of an item, once each."""
    return leaked_passages(documents, items).select("doc_id", "item_id").distinct()


#: A document is dropped as a whole from this share of leaked words on; else spans of this many words are cut out.
DROP_SHARE, CUT_WORDS = 0.5, PASSAGE


def without_passages(documents: DataFrame, items: DataFrame, cut_words: int = CUT_WORDS, drop_share: float = DROP_SHARE) -> DataFrame:
    """doc_id, words, leaked_words, coverage, action, clean_text of each document that contains a passage.

    Spans of `cut_words` words and more are removed from the normalised text (overlapping ones together, a blank in
    their place); where they cover `drop_share` of the words or more the document is dropped and its clean_text is
    null. coverage is the share of words in such spans. Documents without a passage aren't in the result, as they stay
    as they are. The spans of one document are few (one for each item), so they travel as a list to its text.
    """
    spans = leaked_passages(documents, items).where(F.col("words") >= cut_words)
    spans = spans.groupBy("doc_id").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("spans"))
    hit = documents.select("doc_id", "text").join(spans, "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(i, *_cleaned(t, [(x["start"], x["end"]) for x in s], drop_share)) for i, t, s in zip(*[c.to_pylist() for c in b.columns], strict=True)]
            columns = list(zip(*rows, strict=True)) if rows else [()] * 6
            types = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["doc_id", "words", "leaked_words", "coverage", "action", "clean_text"])

    return hit.mapInArrow(run, "doc_id long, words long, leaked_words long, coverage double, action string, clean_text string").distinct()


def _cleaned(text: str, spans: list[tuple[int, int]], drop_share: float) -> tuple[int, int, float, str, str | None]:
    plain = _plain(text)
    merged: list[list[int]] = []
    for a, b in sorted(spans):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    total = len(_WORD.findall(plain))
    gone = sum(len(_WORD.findall(plain[a:b])) for a, b in merged)
    share = gone / total if total else 0.0
    if share >= drop_share:
        return total, gone, share, "dropped", None
    kept, at = [], 0
    for a, b in merged:
        kept.append(plain[at:a])
        at = b
    return total, gone, share, "cut", " ".join([*kept, plain[at:]])
