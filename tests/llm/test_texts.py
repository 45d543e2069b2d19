"""Encoding, leaks and text types."""

from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flowloom.llm import leaks, quality, tokens

DOCS = "doc_id long, text string"


@pytest.fixture(scope="module")
def reference():
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


@pytest.fixture(scope="module")
def encoder():
    return tokens.Encoder(tokens.default_vocabulary(), tokens.default_pattern())


AWKWARD = ["", " ", "  \n\t ", "a", "a  b", "x \n\n y", "don't  we'll", "<|endoftext|> x", "  　a b", "é naïve œuf", "12 345,6%", "😀 😀‍", "\x00 \x7f", "a\r\nb\rc", "a " * 50_000, "b" * 30_000, "\n" * 5000]


@pytest.mark.parametrize("text", AWKWARD)
def test_encoding_equals_the_tokenizers(reference, encoder, text):
    assert encoder.encode(text) == reference.encode(text, add_special_tokens=False).ids
    assert "".join(encoder.fragments(text)) == text


@given(st.text(st.sampled_from(list("ab1 .,'\n\t\r-_é 😀<|>s")), max_size=60))
@settings(max_examples=400, deadline=None)
def test_encoding_of_any_text(reference, encoder, text):
    assert encoder.encode(text) == reference.encode(text, add_special_tokens=False).ids


def test_forced_pairs_stand_in_no_token():
    ranks = tokens.read_ranks(tokens.default_vocabulary())
    forced = tokens.forced_pairs(ranks)
    assert forced[ord("a"), ord(" ")] and not forced[ord("t"), ord("h")]
    assert not any(forced[a, b] for t in list(ranks)[:5000] for a, b in zip(t, t[1:], strict=False))


def test_encoded_rows(spark, rows, encoder):
    df = spark.createDataFrame([(1, None), (2, ""), (3, " "), (4, "a b"), (4, "a b"), (None, "x")], DOCS).withColumn("ids", F.lit(1))
    got = rows(tokens.encoded(df))
    assert got == [(None, encoder.encode("x")), (1, []), (2, []), (3, encoder.encode(" ")), (4, encoder.encode("a b")), (4, encoder.encode("a b"))]
    assert tokens.encoded(df.limit(0)).count() == 0


WORDS = [f"w{i}" for i in range(30)]


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return row[-1]


def _leaks(item, doc):
    """By trying every pair of spans that begin and end with a word in common."""
    for i in range(len(item)):
        for j in range(i + leaks.PASSAGE, len(item) + 1):
            most = (j - i) // leaks.PER_ERROR
            for a in range(len(doc)):
                if doc[a] != item[i]:
                    continue
                for b in range(max(a + 1, a + j - i - most), min(len(doc), a + j - i + most) + 1):
                    if doc[b - 1] == item[j - 1] and _distance(item[i:j], doc[a:b]) <= most:
                        return True
    return False


def test_leaks_against_brute_force():
    rng = random.Random(6)
    items = [(k, " ".join(rng.choice(WORDS) for _ in range(30))) for k in range(3)]
    automaton = leaks.Automaton(items)
    agree = leaked = 0
    for _ in range(120):
        k, text = rng.choice(items)
        w = text.split()
        size = rng.choice([8, 15, 18, 19, 20, 21, 22, 25, 30])
        at = rng.randrange(len(w) - size + 1)
        piece = w[at : at + size]
        for _ in range(rng.choice([0, 1, 2, 2, 3, 4])):
            p = rng.randrange(len(piece))
            piece = rng.choice([piece[:p] + piece[p + 1 :], piece[:p] + ["odd"] + piece[p:], piece[:p] + ["odd"] + piece[p + 1 :]])
        doc = ["x"] * 3 + piece + ["y"] * 3
        found = {i for i, *_ in leaks.document_passages(automaton, " ".join(doc))}
        want = {i for i, t in items if _leaks(t.split(), doc)}
        assert found == want
        agree += 1
        leaked += bool(want)
    assert agree == 120 and 20 < leaked < 110


def test_leaks_of_items_that_share_text():
    """A longer match with one item hides none of the others, whichever part of it they have."""
    rng = random.Random(9)
    a = [f"a{i}" for i in range(40)]
    whole = leaks.Automaton([(1, " ".join(a)), (2, " ".join(a[10:] + [f"b{i}" for i in range(10)]))])
    assert {i for i, *_ in leaks.document_passages(whole, " ".join(a))} == {1, 2}
    agree = both = 0
    for _ in range(40):
        shared = [rng.choice(WORDS) for _ in range(30)]
        alone = lambda n: [rng.choice(WORDS) for _ in range(n)]
        at, other = rng.randrange(11), rng.randrange(11)
        first, second = alone(at) + shared + alone(10 - at), alone(other) + shared + alone(10 - other)
        piece = list(rng.choice([first, second, first[:25], second[-25:], shared]))
        for _ in range(rng.choice([0, 0, 1, 2, 3])):
            p = rng.randrange(len(piece))
            piece = rng.choice([piece[:p] + piece[p + 1 :], piece[:p] + ["odd"] + piece[p:], piece[:p] + ["odd"] + piece[p + 1 :]])
        doc = ["x"] * 3 + piece + ["y"] * 3
        automaton = leaks.Automaton([(1, " ".join(first)), (2, " ".join(second))])
        want = {i for i, t in ((1, first), (2, second)) if _leaks(t, doc)}
        assert {i for i, *_ in leaks.document_passages(automaton, " ".join(doc))} == want
        agree += 1
        both += len(want) == 2
    assert agree == 40 and both > 20


def test_leaked_rows(spark, rows):
    rng = random.Random(1)
    text = " ".join(f"word{rng.randrange(1000)}" for _ in range(40)) + " 2.64 end"
    items = spark.createDataFrame([(7, "t", text), (8, "t", None), (9, "t", ""), (None, "t", text), (7, "t", text)], "item_id long, item_type string, text string").withColumn("doc_id", F.lit(0))
    shouted = text.upper().replace(" ", " -\r\n", 20)
    docs = spark.createDataFrame([(1, "so: " + shouted + " (ok)"), (1, "so: " + shouted + " (ok)"), (2, " ".join(text.split()[:19])), (3, None), (4, ""), (5, "z " * 100_000 + text.replace("2.64", "264"))], DOCS).withColumn("item_id", F.lit(0))
    assert rows(leaks.leaked_items(docs, items)) == [(1, 7), (5, 7)]
    assert rows(leaks.leaked_items(docs.limit(0), items)) == []
    assert rows(leaks.leaked_items(docs, items.limit(0))) == []
    assert leaks.leaked_passages(docs.where("doc_id = 1"), items).first().words == 42


def test_items_are_taken_in_bounded_sets(spark, rows, monkeypatch):
    monkeypatch.setattr(leaks, "AUTOMATON_BYTES", 30 * leaks.BYTES_PER_WORD)
    texts = [" ".join(f"a{k}b{i}" for i in range(25)) for k in range(3)]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    docs = spark.createDataFrame([(1, texts[0]), (2, texts[2] + " and " + texts[1])], DOCS)
    assert len(list(leaks.item_sets(items))) == 3
    assert rows(leaks.leaked_items(docs, items)) == [(1, 0), (2, 1), (2, 2)]


PROSE = "The yield of the mill was measured at the farm, and the factor has been halved because the survey lists it twice. "
FORMS = {
    "prose": [PROSE, PROSE.upper() * 3, PROSE.replace(", ", ",\n").replace("at ", "at\n") * 2, "The boiler burns wood chips and emits a little of it", PROSE * 3 + "\n- milk\n- rye\n- oats", "La part de l'emballage reste faible, ce qui est cohérent avec le relevé de la ferme."],
    "list": ["- milk\n- rye bread\n- oat drink 5 kg\n- plum jam", "1. milk\n2. rye\n3. oats\n4. plum", "milk\nrye bread, Oldmarch\noat drink 4 kg\nplum jam\nbutter", "[x] milk\n[ ] rye\n[x] oats"],
    "table": ["a;b;c\nmilk;kg;1,5\nrye;kg;2\noats;t;4", "| a | b |\n|---|---|\n| milk | 1 |\n| rye | 2 |", "a\tb\tc\nmilk\tkg\t1\nrye\tt\t2", '"a","b"\n"milk, raw","2"\n"rye","1"', "name      unit   n\nmilk      kg     1\nrye       t      2\noats      kg     3"],
    "junk": ["kg kg kg kg kg kg kg kg kg kg", "vx qcqsr fwrplptt dxbh fvkzr xvfchcfk vvhjwpp", "YaUZdO9EhnS7vJFi+ZRMghai6ubhSDC+eKk5gci3JwGQg4uVBOqXQ4E+gJFmNspdkYloYJUROJd==", "d2 e5 93 08 c7 de a0 99 02 b1 52 34 b5", "A t   f i r s t   s i g h t   t h e   m i l l", "<td class=c1></td><br/>&nbsp;&#161;<td class=c65></td><br/>", "lca score free mill pasta calculator download plum score lca cheap"],
}


def test_text_types(spark):
    data, want = [], {}
    for form, texts in FORMS.items():
        for k in range(20 if form == "prose" else 6):
            for t in texts:
                want[len(data)] = form
                data.append((len(data), t + (f"\n{t}" if form == "prose" and k % 2 else "")))
    n = len(data)
    df = spark.createDataFrame([*data, (n, None), (n + 1, ""), (n + 2, " \n"), (None, PROSE)], DOCS).withColumn("form", F.lit("clash")).withColumn("votes", F.lit(1))
    got = {r.doc_id: r for r in quality.text_types(df).collect()}
    wrong = [(want[i], got[i].form, data[i][1]) for i in want if got[i].form != want[i]]
    assert not wrong
    assert got[n].form is None and got[n + 1].form is None and got[n + 2].form is None and got[None].form == "prose"
    named = {(r.doc_id, r.form) for r in quality.not_prose(df).collect()}
    assert named == {(i, f) for i, f in want.items() if f != "prose"}
    assert quality.text_types(df.limit(0)).count() == 0


def test_statistics():
    s = dict(zip((n for n, _ in quality.STATISTICS), quality.statistics_of("The cat sat.\nA dog, 3 cats!"), strict=True))
    assert s["n_words"] == 6 and s["n_lines"] == 2 and s["punctuated_lines"] == 1.0
    assert s["mean_word_length"] == pytest.approx((3 + 3 + 3 + 1 + 3 + 4) / 6)
    assert s["common_share"] == pytest.approx(2 / 6)
    assert quality.statistics_of(None) == quality.statistics_of(" \r\n")
    assert len(quality.statistics_of("x" * 300_000)) == len(quality.STATISTICS)


def test_rates_are_learned_from_agreement():
    """Patterns drawn from rates that differ from the first guesses: the posterior finds the types again, better than plurality."""
    rng = random.Random(8)
    drawn = [[[0.85 * q + 0.05 for q in g] for g in guess] for _, _, guess in quality.SIGNALS.values()]
    drawn[0] = [[0.3, 0.3, 0.4]] * 4  # bullets say nothing here, and repeats are common in lists
    drawn[8][1] = [0.2, 0.2, 0.6]
    counts: dict[int, int] = {}
    truth: dict[int, dict[str, int]] = {}
    for _ in range(4000):
        form = rng.choices(quality.TYPES, [0.7, 0.1, 0.1, 0.1])[0]
        p = sum(rng.choices(range(3), drawn[i][quality.TYPES.index(form)])[0] * 3**i for i in range(len(drawn)))
        counts[p] = counts.get(p, 0) + 1
        truth.setdefault(p, {}).setdefault(form, 0)
        truth[p][form] += 1
    post, plain = quality.learn(counts), quality.plurality(counts)
    right = sum(truth[p].get(quality.TYPES[int(v.argmax())], 0) for p, v in post.items()) / 4000
    assert right > 0.9 and right > sum(truth[p].get(t, 0) for p, t in plain.items()) / 4000 + 0.02
    assert quality.learn({}) == {}


def test_prose_of_other_languages(spark):
    """Prose in languages whose words the common list lacks is prose, their lists are lists."""
    prose = {
        "de": "Der Ertrag der Mühle wurde auf dem Hof gemessen, und der Wert ist nicht mehr als die Hälfte, weil die Umfrage ihn zweimal nennt.",
        "es": "El rendimiento del molino se ha medido en la granja, y el factor es la mitad porque la encuesta lo nombra dos veces por error.",
        "it": "La resa del mulino è stata misurata nella fattoria, e il fattore non è più lo stesso perché il rilievo lo riporta due volte.",
        "pt": "O rendimento do moinho foi medido na quinta, e o fator não é mais o mesmo porque o inquérito o refere duas vezes por engano.",
        "nl": "De opbrengst van de molen is op de boerderij gemeten, en de factor is niet meer dan de helft omdat het onderzoek die twee keer noemt.",
    }
    texts = [*prose.values(), "Milch\nRoggenbrot\nHafer 4 kg\nPflaumen\nButter\nKäse\nQuark\nSahne"]
    base = [t for form, ts in FORMS.items() for t in ts for _ in range(30 if form == "prose" else 6)]
    got = {r.doc_id: r.form for r in quality.text_types(spark.createDataFrame(list(enumerate([*texts, *base])), DOCS)).collect()}
    assert [got[i] for i in range(6)] == ["prose"] * 5 + ["list"]

