"""Statistics of whole texts, and text types learned from noisy labelling functions.

Statistics are cut at two thresholds each: every threshold is a labelling function, and the two of one statistic make a
signal of three levels. What a level says of the type is not fixed: expectation-maximisation over the counts of level
patterns learns from their agreement how often each type shows each level, starting from weak guesses. The posterior
decides, also against most of the signals. Only patterns and counts leave the workers (at most 3**10 rows, however many
documents).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowloom.session import checkpointed

TYPES = ("prose", "list", "table", "junk")
#: Common words of English and French.
COMMON = frozenset(
    "the of and to in is was were be been are a an for from on at by with as that which this it its not no but or if when while because since "
    "after before than then more most each per both between into over under about between could would will has have had do does did can may "
    "he she they we our their his her there here where who what how all any some only other same also very such until unless although so "
    "le la les l d de du des un une et en est sont était a au aux pour par sur dans avec sans que qu qui ce cette ces se s n ne pas plus ou mais si "
    "comme après avant entre chez depuis lors il elle on nous vous ils elles son sa ses leur leurs y été être ont avait fait c j m t à où sous bien".split()
)
#: Common words of further languages, read where hardly a word of a text is common in English or French.
OTHER_LANGUAGES = [
    frozenset(words.split())
    for words in (
        "der die das und ist nicht in zu den mit von für auf ein eine einer dem des im sich auch als an es bei oder wird werden wurde sind war hat aus nach wie über nur noch durch",
        "el la los las de del y en que es un una con por para se no lo su al como más pero este esta son fue ha sin sobre entre cuando también muy ya o",
        "il lo la i gli le di del della e è un una in che con per non si da al alla sono come più ma questo questa anche o nel nella dei delle ha stato dopo",
        "o a os as de do da dos das e em no na um uma que com por para se não é ao mais como mas foi são este esta ou também entre sem quando já",
        "de het een en van in is dat op te met voor niet zijn aan er maar om ook als bij door naar uit worden wordt werd was heeft nog over of deze dit",
    )
]
_LINE = re.compile(r"\r\n|[\n\r\v\f\x85  ]")
_WORD = re.compile(r"[^\W\d_]+")
_BULLET = re.compile(r"^\s*(?:[-*•·–—+◦▪‣>»]|\d{1,3}[.)]|\(?[a-zA-Z0-9]{1,3}\)|[a-zA-Z][.)]|\[[ xX✓]?\])\s+\S")
_RULE_LINE = re.compile(r"^[\s|+:=_-]{3,}$")
_GAPS = re.compile(r"\S\s{2,}(?=\S)")
_ODD = re.compile(r"[�¤]|ã|â€|ï¿½")
_TAG = re.compile(r"</?[a-z][^<>]{0,80}>|&#?\w{2,8};")
_HEX = re.compile(r"(?<!\S)(?:0x)?[0-9a-f]{2,}(?::\d+)?(?!\S)")
_NO_VOWEL = re.compile(r"(?<!\S)[bcdfghjklmnpqrstvwxzç]{3,}(?!\S)")
_SINGLE = re.compile(r"(?<!\S)\S(?!\S)")
_DIGITS = re.compile(r"\d+")
_SENTENCE = re.compile(r"(?<=[.!?])\s+|[\r\n]+")
_END = (".", "!", "?", ";", ":", "…", ".\"", ".»", ".)")


def _delimited(line: str) -> tuple[str, int]:
    """Delimiter of the line if it looks like a row, and its number of cells."""
    if "\t" in line.strip():
        return "\t", line.strip("\r\n").count("\t") + 1
    bars = line.count("|")
    if bars >= 2:
        return "|", bars
    quoted = line.count('","') + line.count('";"')
    if quoted:
        return '"', quoted + 1
    semis = line.count(";")
    if semis >= 2 and not line.rstrip().endswith(". ;"):
        return ";", semis + 1
    gaps = len(_GAPS.findall(line.strip()))
    if gaps >= 1:
        return " ", gaps + 1
    commas = line.count(",")
    if commas >= 2 and ", " not in line:
        return ",", commas + 1
    return "", 1


#: name and type of output of each statistic of a document
STATISTICS = [
    ("n_words", "long"), ("mean_word_length", "double"), ("symbol_share", "double"), ("punctuated_lines", "double"), ("common_share", "double"),
    ("n_lines", "long"), ("words_per_line", "double"), ("bullet_share", "double"), ("row_share", "double"), ("entry_share", "double"), ("sentence_share", "double"),
    ("digit_share", "double"), ("odd_share", "double"), ("tag_share", "double"), ("hex_share", "double"), ("vowelless_share", "double"),
    ("distinct_share", "double"), ("top_share", "double"), ("single_share", "double"), ("longest_token", "long"), ("repeated_share", "double"),
]


def statistics_of(text: str | None, language: frozenset = COMMON) -> tuple:
    """The statistics in the order of STATISTICS. A null, empty or blank text has zeros.

    Common words are those of `language`; a text of which hardly a word is common in English or French is read in
    the language of OTHER_LANGUAGES that fits it, if one does.
    """
    text = text or ""
    if not text.strip():
        return (0, 0.0, 0.0, 0.0, 0.0, 0) + (0.0,) * 13 + (0, 0.0)
    text = text.lower()
    lines = [x for x in _LINE.split(text) if x and not x.isspace()]
    tokens = text.split()
    solid = sum(map(len, tokens))
    # lines: rows of a table share delimiter and number of cells; bullets; sentences; plain entries
    rows: Counter = Counter()
    words: list[str] = []
    bullets = entries = ended = sentence = total = common = 0
    is_common = language.__contains__
    for x in lines:
        ws = _WORD.findall(x)
        words += ws
        n_ws = len(ws)
        known = sum(map(is_common, ws))
        common += known
        size = max(1, n_ws)
        total += size
        ended += x.rstrip().endswith(_END)
        near = known / size
        if _RULE_LINE.match(x):
            rows["rule"] += 1
            continue
        d, cells = _delimited(x)
        if d:
            rows[(d, cells)] += 1
        bullet = _BULLET.match(x) is not None
        if near >= 0.22 and n_ws >= (10 if bullet else 6) and (cells < 3 or d in ";, "):
            sentence += size
        if bullet:
            bullets += 1
        elif n_ws <= 12 and near < 0.2 and len(x) <= 120:
            entries += 1
    n1, n_lines, n_tokens = max(1, len(words)), len(lines), len(tokens)
    if language is COMMON and len(words) >= 8 and common / n1 < 0.15:
        hits = [[w for w in words if w in other and len(w) > 1] for other in OTHER_LANGUAGES]
        best = max(range(len(hits)), key=lambda k: len(hits[k]))
        if len(hits[best]) / n1 >= 0.2 and len(set(hits[best])) >= 4:
            return statistics_of(text, OTHER_LANGUAGES[best])
    same = sum(c for k, c in rows.items() if k == "rule" or c >= 2)
    letters, digits = sum(map(len, words)), sum(map(len, _DIGITS.findall(text)))
    sentences = [s for s in _SENTENCE.split(text) if len(s) > 20]
    return (
        len(words),
        letters / n1,
        (solid - letters - digits) / len(text),
        ended / n_lines,
        common / n1,
        n_lines,
        len(words) / n_lines,
        bullets / n_lines,
        same / n_lines if same >= 2 else 0.0,
        entries / n_lines,
        sentence / total,
        digits / solid,
        sum(map(len, _ODD.findall(text))) / solid,
        sum(map(len, _TAG.findall(text))) / solid,
        sum(1 for t in _HEX.findall(text) if len(t) == 2 or not t.isalpha()) / n_tokens,
        len(_NO_VOWEL.findall(text)) / n1,
        len(set(words)) / n1,
        max(Counter(tokens).values()) / n_tokens,
        len(_SINGLE.findall(text)) / n_tokens,
        max(map(len, tokens)),
        1 - len(set(sentences)) / len(sentences) if sentences else 0.0,
    )


#: Labelling functions: each signal with its two thresholds, and how often prose, lists, tables and junk are first taken
#: to show its three levels.
SIGNALS: dict[str, tuple[float, float, list[tuple[float, float, float]]]] = {
    "bullets": (0.2, 0.6, [(0.90, 0.08, 0.02), (0.45, 0.10, 0.45), (0.93, 0.05, 0.02), (0.94, 0.04, 0.02)]),
    "rows": (0.3, 0.6, [(0.93, 0.05, 0.02), (0.88, 0.08, 0.04), (0.02, 0.08, 0.90), (0.90, 0.06, 0.04)]),
    "sentences": (0.2, 0.5, [(0.05, 0.10, 0.85), (0.85, 0.12, 0.03), (0.93, 0.05, 0.02), (0.90, 0.07, 0.03)]),
    "common": (0.12, 0.25, [(0.03, 0.12, 0.85), (0.75, 0.20, 0.05), (0.88, 0.10, 0.02), (0.85, 0.10, 0.05)]),
    "entries": (0.3, 0.6, [(0.88, 0.09, 0.03), (0.04, 0.06, 0.90), (0.90, 0.06, 0.04), (0.80, 0.10, 0.10)]),
    "width": (4.0, 7.0, [(0.05, 0.15, 0.80), (0.50, 0.40, 0.10), (0.40, 0.30, 0.30), (0.35, 0.15, 0.50)]),
    "garble": (0.4, 1.0, [(0.97, 0.025, 0.005), (0.96, 0.035, 0.005), (0.96, 0.035, 0.005), (0.65, 0.10, 0.25)]),
    "code": (0.6, 1.0, [(0.97, 0.025, 0.005), (0.96, 0.035, 0.005), (0.88, 0.10, 0.02), (0.60, 0.10, 0.30)]),
    "repeats": (0.5, 1.0, [(0.95, 0.045, 0.005), (0.95, 0.045, 0.005), (0.90, 0.08, 0.02), (0.65, 0.10, 0.25)]),
    "words": (0.5, 1.0, [(0.01, 0.01, 0.98), (0.02, 0.03, 0.95), (0.25, 0.15, 0.60), (0.30, 0.10, 0.60)]),
}
#: Share of the documents that the first guesses count for, and the least number of documents they do.
PRIOR_SHARE, PRIOR_LEAST = 0.01, 20.0
_GUESS = np.stack([np.array(g) for _, _, g in SIGNALS.values()])  # signals, types, levels


def signals(x: dict) -> list[float]:
    """The values that the thresholds of SIGNALS are laid on, from the statistics of a text."""
    few_rows, wordy = x["row_share"] < 0.5, x["mean_word_length"] >= 2.6 and x["single_share"] < 0.5  # single letters are common words too
    worst = lambda *v: max(v)
    repeats = worst(x["top_share"] / 0.34, 0.05 / x["distinct_share"] if x["distinct_share"] else 0.0) if few_rows and x["n_words"] >= 8 else 0.0
    return [
        x["bullet_share"],
        x["row_share"],
        x["sentence_share"] if wordy else 0.0,
        x["common_share"] if wordy else 0.0,
        x["bullet_share"] + x["entry_share"] if x["n_lines"] >= 3 and few_rows else 0.0,
        x["words_per_line"],
        worst(x["vowelless_share"] / 0.4, x["odd_share"] / 0.04, x["tag_share"] / 0.3),
        worst(x["hex_share"] / 0.4, x["longest_token"] / 60, x["symbol_share"] / 0.45 if few_rows else 0.0),
        worst(repeats, x["repeated_share"] / 0.6, x["single_share"] / 0.6),
        1.0 if wordy else 0.5 if x["mean_word_length"] >= 2.0 else 0.0,
    ]


def pattern(statistics: tuple) -> int:
    """The levels of all signals as one number in base 3; -1 for a blank text."""
    x = dict(zip((n for n, _ in STATISTICS), statistics, strict=True))
    if not x["n_lines"]:
        return -1
    return sum(((v >= a) + (v >= b)) * 3**i for i, (v, (a, b, _)) in enumerate(zip(signals(x), SIGNALS.values(), strict=True)))


def levels_of(patterns: list[int]) -> np.ndarray:
    return np.array([[p // 3**i % 3 for i in range(len(SIGNALS))] for p in patterns], int).reshape(-1, len(SIGNALS))


def learn(counts: dict[int, int], turns: int = 300) -> dict[int, np.ndarray]:
    """Posterior over TYPES of each pattern, by expectation-maximisation over the patterns' counts.

    Signals are taken to show their levels independently, given the type. The first guesses weigh as much as
    PRIOR_SHARE of the documents, whatever their number, so that types keep their names; all else is learned.
    """
    patterns = sorted(counts)
    if not patterns:
        return {}
    n, at = np.array([counts[p] for p in patterns], float), levels_of(patterns)
    prior = max(PRIOR_LEAST, PRIOR_SHARE * n.sum())
    rate, share = _GUESS, np.array([0.55, 0.15, 0.15, 0.15])
    post = np.zeros((len(patterns), len(TYPES)))
    for _ in range(turns):
        log = np.log(share) + sum(np.log(rate[i][:, at[:, i]]).T for i in range(len(SIGNALS)))
        new = np.exp(log - log.max(1, keepdims=True))
        new /= new.sum(1, keepdims=True)
        if np.abs(new - post).max() < 1e-9:
            break
        post = new
        weight = post * n[:, None]
        total = weight.sum(0)
        seen = np.stack([np.stack([weight[at[:, i] == level].sum(0) for level in range(3)], 1) for i in range(len(SIGNALS))])
        rate = (seen + prior * _GUESS) / (total[None, :, None] + prior)
        share = (total + 1) / (total.sum() + len(TYPES))
    return {p: post[i] for i, p in enumerate(patterns)}


def plurality(counts: dict[int, int]) -> dict[int, str]:
    """What most signals name for each pattern, each level voting for the type that is first taken to show it most: to compare with."""
    best = _GUESS.argmax(1)  # signals, levels
    out = {}
    for p, row in zip(counts, levels_of(list(counts)), strict=True):
        named = Counter(int(best[i, level]) for i, level in enumerate(row))
        out[p] = TYPES[max(named, key=lambda t: (named[t], -t))]
    return out


def text_statistics(documents: DataFrame) -> DataFrame:
    """doc_id, the STATISTICS and the `pattern` of each document; one pass, no shuffle. A blank text has zeros and -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), *[pa.int64() if t == "long" else pa.float64() for _, t in STATISTICS], pa.int32()]
        for b in batches:
            for lo in range(0, b.num_rows, 1000):
                part = b.slice(lo, 1000)
                rows = [statistics_of(t) for t in part[1].to_pylist()]
                columns = [part[0].to_pylist(), *zip(*rows, strict=True), [pattern(r) for r in rows]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["doc_id", *[n for n, _ in STATISTICS], "pattern"])

    schema = "doc_id long, " + ", ".join(f"{n} {t}" for n, t in STATISTICS) + ", pattern int"
    return documents.select("doc_id", "text").mapInArrow(run, schema)


def text_types(documents: DataFrame) -> DataFrame:
    """doc_id, form, confidence and the statistics of each document.

    form is 'prose', 'list', 'table' or 'junk', confidence its posterior; both are null for null, empty and
    blank texts. Ties go to the first of TYPES. An empty table gives no rows. Whole texts are read; the rates are
    learned over all documents.
    """
    spark = documents.sparkSession
    stats = checkpointed(text_statistics(documents))  # the texts are read once
    counts = {r["pattern"]: r["count"] for r in stats.where("pattern >= 0").groupBy("pattern").count().collect()}  # at most 3**len(SIGNALS) rows
    rows = [(p, TYPES[int(np.argmax(v))], float(v.max())) for p, v in learn(counts).items()]
    known = spark.createDataFrame(rows, "pattern int, form string, confidence double")
    out = stats.join(F.broadcast(known), "pattern", "left")
    return out.select("doc_id", "form", "confidence", *[n for n, _ in STATISTICS])


def not_prose(documents: DataFrame) -> DataFrame:
    """doc_id, form of the documents that are mostly lists, tables or junk."""
    return text_types(documents).where(F.col("form").isin("list", "table", "junk")).select("doc_id", "form").distinct()
