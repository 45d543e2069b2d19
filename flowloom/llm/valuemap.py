"""Freely typed values mapped to the entries of a reference list.

Entries are multisets of words. Their distance is the cheapest assignment of the words of one to the words
of the other under the unrestricted Damerau-Levenshtein distance, an unpaired word costing its length: a true
metric, whatever the order of the words. A BK-tree over the entries returns every entry within the radius by
the triangle inequality; the nearest one that passes the limits of each word wins. Reference lists are read
one shard of bounded size after the other, and the winners of the shards are merged.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import combinations, product
from math import prod

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Distance up to which the tree is searched.
RADIUS = 3
#: Entries in one shard of the reference list, and values whose result a worker remembers.
SHARD_ENTRIES, REMEMBERED = 20_000, 200_000
#: Words of an entry whose parts are all listed as aliases; the parts of longer ones are searched entry by entry.
LISTED_WORDS = 6
#: Ways of reading a value's words that are tried one by one; more are searched entry by entry.
PRODUCT = 64
#: Words that say nothing, words of a compartment left unspecified, words that go before a flow.
DECORATIONS = ("generic", "adapted", "unspecified", "unspec", "sheet", "specified", "not", "ns")
LEADING = ("land", "resource")
#: Other names of a compartment; {} stands for the compartment.
COMPARTMENT_FORMS = ("{}", "emissions to {}", "{} emission", "{} emissions", "{}borne emissions", "emission to {}")
RESOURCE_FORMS = ("raw", "raw materials", "raw material", "resources", "nat resource", "natural resources")


@lru_cache(maxsize=1_000_000)
def edits(a: str, b: str) -> int:
    """Unrestricted Damerau-Levenshtein distance: insert, delete, replace, swap neighbours; a true metric."""
    if a == b:
        return 0
    if not a or not b:
        return len(a) + len(b)
    big = len(a) + len(b)
    last: dict[str, int] = {}
    d = [[big] * (len(b) + 2) for _ in range(len(a) + 2)]
    for i in range(len(a) + 1):
        d[i + 1][1] = i
    for j in range(len(b) + 1):
        d[1][j + 1] = j
    for i in range(1, len(a) + 1):
        seen = 0
        for j in range(1, len(b) + 1):
            k, m = last.get(b[j - 1], 0), seen
            same = a[i - 1] == b[j - 1]
            if same:
                seen = j
            d[i + 1][j + 1] = min(d[i][j] + (not same), d[i + 1][j] + 1, d[i][j + 1] + 1, d[k][m] + (i - k - 1) + 1 + (j - m - 1))
        last[a[i - 1]] = i
    return d[-1][-1]


Words = tuple[str, ...]


def _leftover(a: Words, b: Words) -> tuple[list[str], list[str]]:
    """What remains without the words in common: pairing equal words is never worse."""
    rest, left = list(b), []
    for w in a:
        if w in rest:
            rest.remove(w)
        else:
            left.append(w)
    return left, rest


def assignment(a: Words, b: Words) -> tuple[int, list[tuple[str, str]]]:
    """Distance of two word multisets and the pairs (an unpaired word stands against '')."""
    left, rest = _leftover(a, b)
    size = max(len(left), len(rest))
    left += [""] * (size - len(left))
    rest += [""] * (size - len(rest))
    best: dict[int, tuple[int, list]] = {0: (0, [])}
    for x in left:  # over the subsets of rest that are taken
        new: dict[int, tuple[int, list]] = {}
        for taken, (cost, pairs) in best.items():
            for j, y in enumerate(rest):
                if not taken >> j & 1:
                    c, t = cost + edits(x, y), taken | 1 << j
                    if t not in new or c < new[t][0]:
                        new[t] = (c, [*pairs, (x, y)])
        best = new
    return best[(1 << size) - 1]


class BKTree:
    """Nodes are word multisets with payloads; children hang at their exact distance."""

    def __init__(self, items: Iterable[tuple[Words, int]]):
        self.root: list | None = None
        self.longest = 0
        for words, payload in items:
            self.longest = max(self.longest, len(words))
            self.add(words, payload)

    def add(self, words: Words, payload: int) -> None:
        if self.root is None:
            self.root = [words, {payload}, {}]
            return
        node = self.root
        while True:
            d = assignment(words, node[0])[0]
            if d == 0:
                node[1].add(payload)
                return
            if d not in node[2]:
                node[2][d] = [words, {payload}, {}]
                return
            node = node[2][d]

    def within(self, words: Words, radius: int) -> list[tuple[int, Words, set]]:
        """Every (distance, entry, payloads) within the radius."""
        if self.root is None or len(words) > self.longest + radius:  # each word too many costs at least 1
            return []
        found, open_ = [], [self.root]
        while open_:
            node = open_.pop()
            d = assignment(words, node[0])[0]
            if d <= radius:
                found.append((d, node[0], node[1]))
            open_ += [child for e, child in node[2].items() if abs(e - d) <= radius]
        return sorted(found, key=lambda x: (x[0], x[1]))


def accepted(pairs: list[tuple[str, str]], shared: bool) -> bool:
    """Whether each word of the value may be a slip of the entry's. shared: other words are the same."""
    total = sum(edits(x, y) for x, y in pairs)
    for x, y in pairs:
        limit = 1 if len(y) <= 3 or (len(y) == 4 and not (shared and total <= 2)) else 2 if len(y) <= 7 else 3
        if not x or not y or edits(x, y) > limit:
            return False
    return True


_TOKEN = re.compile(r"[^\W_]+\.?")


def _is_subsequence(a: str, b: str) -> bool:
    it = iter(b)
    return all(c in it for c in a)


class Lexicon:
    """Words of a set of entries, for abbreviations and decorations."""

    def __init__(self, words: Iterable[str]):
        self.words = sorted(set(words))
        self.known = set(self.words)

    @lru_cache(maxsize=100_000)  # noqa: B019
    def readings(self, token: str) -> tuple[str, ...]:
        """Words that a token may stand for: itself, or the words that it abbreviates."""
        bare = token.rstrip(".")
        if bare in self.known:
            return (bare,)
        if token.endswith("."):
            hits = [w for w in self.words if w[0] == bare[0] and len(bare) < len(w) and _is_subsequence(bare, w)]
            near = range(len(bare) - 1, len(bare) + 2)
            hits = hits or [w for w in self.words if len(bare) >= 3 and len(bare) < len(w) and min(edits(bare, w[:n]) for n in near) <= 1]
            if hits:
                return tuple(hits)
        elif len(bare) >= 3:  # without its point: what is left of the word, first and last letter among it
            hits = [w for w in self.words if w[0] == bare[0] and w[-1] == bare[-1] and len(w) <= 2 * len(bare) and len(bare) + 2 <= len(w) and _is_subsequence(bare, w)]
            return (bare, *hits)
        return (bare,)

    @lru_cache(maxsize=100_000)  # noqa: B019
    def is_decoration(self, token: str) -> bool:
        bare = token.rstrip(".")
        if bare in self.known:
            return False
        if bare.isdigit():
            return True
        return any(bare == x or (len(x) >= 6 and abs(len(x) - len(bare)) <= 2 and edits(bare, x) <= 2) for x in DECORATIONS)


def _tokens(text: str) -> list[str]:
    text = re.sub(r"\bn\.\s?s\.?(?=\W|$)", " ns ", re.sub(r"\[[^\]]*\]|[*]", " ", text.lower()))
    text = re.sub(r"(?<=\w)\.s\b", ".", text)
    return _TOKEN.findall(text)


def _fits(options: list[set[str]], entry: Words) -> bool:
    """Whether each of the options can be read as another word of the entry (augmenting paths)."""
    if any(o.isdisjoint(entry) for o in options):
        return False
    reader: dict[int, int] = {}

    def place(i: int, seen: set[int]) -> bool:
        for j, w in enumerate(entry):
            if w in options[i] and j not in seen:
                seen.add(j)
                if j not in reader or place(reader[j], seen):
                    reader[j] = i
                    return True
        return False

    return all(place(i, set()) for i in range(len(options)))


class Matcher:
    """Entries given as (ref_id, words); alias sets may stand beside the full words."""

    def __init__(self, entries: Iterable[tuple[int, Words]], long: Iterable[tuple[int, Words]] = ()):
        entries, self.long = [(i, w) for i, w in entries], list(long)  # long: entries of which any part is an alias
        self.lexicon = Lexicon(x for _, w in entries for x in w)
        self.longest = max((len(x) for x in self.lexicon.words), default=0)
        self.exact: dict[Words, set[int]] = {}
        for i, w in entries:
            self.exact.setdefault(tuple(sorted(w)), set()).add(i)
        self.tree = BKTree((w, i) for i, w in entries)
        self.by_size: dict[int, list[Words]] = {}
        for w in self.exact:
            self.by_size.setdefault(len(w), []).append(w)

    def _readable(self, options: list[tuple[str, ...]]) -> list[Words]:
        """The readings that are worth a search: all that lie within RADIUS of an entry, without listing the others.

        Each word stands for one, so an entry of another size is never accepted. Where the words can be read as
        entries just as they are, one reading of each such entry is given, as nothing is nearer.
        """
        sets = [set(o) for o in options]
        same = self.by_size.get(len(options), [])
        if whole := [w for w in same if _fits(sets, w)]:
            return whole
        found: dict[Words, Words] = {}
        for entry in same:
            held = set(entry)
            if sum(not s.isdisjoint(held) for s in sets) < len(sets) - RADIUS:  # each word that it hasn't costs 1 at least
                continue
            states: dict[Words, tuple[Words, dict[int, int]]] = {(): ((), {0: 0})}  # words read -> in order, words of the entry taken -> cost
            for o in options:
                new: dict[Words, tuple[Words, dict[int, int]]] = {}
                for x in o:
                    cost = {j: edits(x, y) for j, y in enumerate(entry) if abs(len(x) - len(y)) <= RADIUS}
                    cost = {j: c for j, c in cost.items() if c <= RADIUS}
                    for words, takings in states.values() if cost else ():
                        key = tuple(sorted((*words, x)))
                        if key in new:
                            continue
                        took: dict[int, int] = {}
                        for taken, c in takings.items():
                            for j, more in cost.items():
                                if not taken >> j & 1 and c + more <= RADIUS:
                                    took[taken | 1 << j] = min(took.get(taken | 1 << j, RADIUS), c + more)
                        if took:
                            new[key] = ((*words, x), took)
                states = new
            found |= {k: words for k, (words, _) in states.items() if k not in found}
        return list(found.values())

    @staticmethod
    def _part(words: Words, entry: Words) -> int | None:
        """Distance of the words from the nearest part of as many words of a longer entry; None beyond the limits."""
        left, rest = _leftover(words, entry)
        size = len(left)
        if size > RADIUS:  # each word that isn't the same costs 1 at least
            return None
        best: dict[frozenset, tuple[int, tuple]] = {frozenset(): (0, ())}
        for x in left:
            new: dict[frozenset, tuple[int, tuple]] = {}
            for taken, (cost, pairs) in best.items():
                for j, y in enumerate(rest):
                    if j not in taken and abs(len(x) - len(y)) <= RADIUS and (c := cost + edits(x, y)) <= RADIUS:
                        t = taken | {j}
                        if t not in new or c < new[t][0]:
                            new[t] = (c, (*pairs, (x, y)))
            best = new
        hits = [(c, p) for c, p in best.values() if accepted(list(p), size < len(words))]
        return min(hits)[0] if hits else None

    def nearest(self, tokens: list[str]) -> tuple[int, int] | None:
        """(distance, ref_id) of the entry meant; None if there is none or if two are equally near."""
        if any(len(t) > self.longest + RADIUS + 1 for t in tokens):  # too far from every word
            return None
        options = [self.lexicon.readings(t) for t in tokens]
        best: dict[int, int] = {}
        for words in product(*options) if prod(map(len, options)) <= PRODUCT else self._readable(options):
            hit = self.exact.get(tuple(sorted(words)))
            if hit:
                for i in hit:
                    best[i] = 0
                continue
            if 0 in best.values():
                continue
            for d, entry, ids in self.tree.within(words, RADIUS):
                _, pairs = assignment(words, entry)
                if accepted(pairs, len(pairs) < len(entry)):
                    for i in ids:
                        best[i] = min(best.get(i, d), d)
            for i, entry in self.long:
                if LISTED_WORDS <= len(words) < len(entry) and (d := self._part(words, entry)) is not None:
                    best[i] = min(best.get(i, d), d)
        if not best:
            return None
        low = min(best.values())
        winners = [i for i, d in best.items() if d == low]
        return (low, winners[0]) if len(winners) == 1 else None


class FlowMatcher:
    """Flow names such as 'Occupation, walled heath'."""

    def __init__(self, entries: list[tuple[int, str]]):
        self.matcher = Matcher((i, tuple(_tokens(t))) for i, t in entries if t and _tokens(t))

    def find(self, value: str | None) -> tuple[int, int] | None:
        lex = self.matcher.lexicon
        tokens = [t for t in _tokens(value or "") if not lex.is_decoration(t) and (t in lex.known or not any(abs(len(t) - len(w)) <= 1 and edits(t, w) <= 1 for w in LEADING))]
        return self.matcher.nearest(tokens) if tokens else None


class ContextMatcher:
    """Compartments such as [air, tall chimney], with the long category style beside them."""

    def __init__(self, entries: list[tuple[int, list[str], list[str] | None]]):
        self.alone: dict[str, int] = {}
        subs: dict[str, list[tuple[int, Words]]] = {}
        self.long: dict[str, set[int]] = {}
        for i, path, ef in entries:
            if not path:
                continue
            top, sub = " ".join(_tokens(path[0])), tuple(_tokens(" ".join(path[1:])))
            if sub:
                subs.setdefault(top, []).append((i, sub))
            else:
                self.alone[top] = i
                subs.setdefault(top, [])
            if ef:
                self.long.setdefault(self._plain(ef), set()).add(i)
                self.long.setdefault(self._plain(ef[-1:]), set()).add(i)
        self.forms = {f.format(t): t for t in subs for f in COMPARTMENT_FORMS if " " not in t} | {t: t for t in subs}
        self.forms |= {f: t for t in subs if t.endswith("resource") for f in RESOURCE_FORMS}
        self.subs = {t: Matcher(self._aliases(e), [(i, w) for i, w in e if len(w) > LISTED_WORDS]) for t, e in subs.items()}
        self.tops = BKTree(((form,), n) for n, form in enumerate(self.forms))
        words = Lexicon(w for m in self.subs.values() for w in m.lexicon.words)
        self.lexicon = words

    @staticmethod
    def _plain(path: list[str]) -> str:
        return " / ".join(" ".join(x.rstrip(".") for x in _tokens(p)) for p in path)

    @staticmethod
    def _aliases(entries: list[tuple[int, Words]]) -> list[tuple[int, Words]]:
        """Each entry with the parts of its words that no other entry of the compartment has."""
        owners: dict[Words, set[int]] = {}
        for i, words in entries:
            for n in range(1, min(len(words), LISTED_WORDS)):
                for part in combinations(sorted(words), n):
                    owners.setdefault(part, set()).add(i)
        full = {tuple(sorted(w)) for _, w in entries}
        return entries + [(next(iter(o)), part) for part, o in owners.items() if len(o) == 1 and part not in full]

    @lru_cache(maxsize=50_000)  # noqa: B019
    def top(self, text: str) -> str | None:
        plain = " ".join(t.rstrip(".") for t in _tokens(text))
        if plain in self.forms:
            return self.forms[plain]
        near: dict[str, int] = {}
        for d, (form,), _ in self.tops.within((plain,), 2):
            if d <= (1 if len(form) <= 5 else 2):
                near[self.forms[form]] = min(near.get(self.forms[form], d), d)
        winners = [t for t, d in near.items() if d == min(near.values())]
        return winners[0] if len(winners) == 1 else None

    def find(self, path: list[str | None] | None) -> tuple[int, int] | None:
        parts = [p for p in path or [] if p and p.strip()]
        if not parts:
            return None
        long = self.long.get(self._plain(parts)) or (self.long.get(self._plain(parts[-1:])) if len(parts) > 2 else None)
        if long and len(long) == 1:
            return 0, next(iter(long))
        if len(parts) == 1:
            cut = re.split(r"\s*[/>|;,:]\s*", parts[0].strip(), maxsplit=1)
            options = [cut] if len(cut) == 2 else [[parts[0], ""]]
        else:
            options = [[parts[0], " , ".join(parts[1:])]]
        for head, tail in options:
            top = self.top(head)
            if top is None:
                continue
            matcher = self.subs[top]
            tokens = [t for t in _tokens(tail) if not matcher.lexicon.is_decoration(t)]
            if not tokens:
                return (0, self.alone[top]) if top in self.alone else None
            return matcher.nearest(tokens)
        return None


_built: dict[tuple, object] = {}


def _worker_matcher(shared, build: Callable[[list[tuple]], object]) -> object:
    """The worker's matcher of a shard, built once (two lists are mapped side by side)."""
    key = (build.__name__, hash(str(shared.value)))
    if key not in _built:
        if len(_built) >= 2:
            _built.clear()
        _built[key] = build(shared.value)
    return _built[key]


def mapped(values: DataFrame, row_id: str, value: str, shards: Iterable[list[tuple]], build: Callable[[list[tuple]], object], field_name: str) -> DataFrame:
    """field_name, row_id, ref_id (0: unmatched) of each row, once for each row_id and value.

    shards: bounded lists of entries; build makes the matcher of one. Rows aren't shuffled when there is one
    shard: every worker remembers the values that it has met, so a hot value costs one search. With several
    shards the nearest winner of all counts, and equally near winners of different shards are unmatched.
    """
    spark = values.sparkSession
    rows = values.where(F.col(row_id).isNotNull()).select(F.col(row_id).cast("long").alias("row_id"), F.col(value).alias("value"))
    parts = None
    number = 0
    for shard in shards:
        number += 1
        shared = spark.sparkContext.broadcast(shard)  # at most SHARD_ENTRIES entries

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            matcher, known = _worker_matcher(shared, build), {}
            for b in batches:
                out = []
                for v in b[1].to_pylist():
                    key = tuple(v) if isinstance(v, list) else v
                    if key not in known:
                        if len(known) >= REMEMBERED:
                            known.clear()
                        known[key] = matcher.find(v) or (-1, 0)
                    out.append(known[key])
                d, ref = zip(*out, strict=True) if out else ((), ())
                yield pa.RecordBatch.from_arrays([b[0], pa.array(d, pa.int32()), pa.array(ref, pa.int64())], ["row_id", "d", "ref_id"])

        one = rows.mapInArrow(run, "row_id long, d int, ref_id long")
        parts = one if parts is None else parts.unionByName(one)
    if number > 1:
        hits = parts.withColumn("d", F.when(F.col("d") >= 0, F.col("d")))
        best = hits.groupBy("row_id").agg(F.min("d").alias("least"), F.collect_set(F.when(F.col("d").isNotNull(), F.struct("d", "ref_id"))).alias("hits"))  # a hit for each shard
        near = F.array_distinct(F.transform(F.filter("hits", lambda h: h["d"] == F.col("least")), lambda h: h["ref_id"]))
        parts = best.select("row_id", F.when(F.size(near) == 1, F.element_at(near, 1)).otherwise(F.lit(0)).alias("ref_id"))
    return parts.select(F.lit(field_name).alias("field_name"), "row_id", "ref_id").distinct()


def shards_of(reference: DataFrame, *columns: str) -> Iterator[list[tuple]]:
    """The reference list, one shard of at most SHARD_ENTRIES entries after the other (one empty shard for no entries)."""
    shard: list[tuple] = []
    for r in reference.select(*columns).distinct().orderBy(columns[0]).toLocalIterator():
        if len(shard) >= SHARD_ENTRIES:
            yield shard
            shard = []
        shard.append(tuple(r))
    yield shard


def typed_values(context_norm: DataFrame, flow_synonyms: DataFrame, context_list: DataFrame, flow_list: DataFrame) -> DataFrame:
    """field_name, row_id, ref_id of every row of both tables; ref_id 0 where the list has no such entry.

    Null, empty and unreadable values are unmatched. Rows already filled in are mapped like the others. An
    empty reference list leaves all unmatched.
    """
    contexts = mapped(context_norm, "rule_id", "source_context", shards_of(context_list, "ref_id", "target_context", "ef_categories"), ContextMatcher, "source_context")
    flows = mapped(flow_synonyms, "synonym_id", "simapro", shards_of(flow_list, "ref_id", "flow"), FlowMatcher, "simapro")
    return contexts.unionByName(flows)
