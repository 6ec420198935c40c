import random
import re

import pytest

from weftline.llm import toxicity as T


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def nearest(word, terms):
    """The nearest term by plain edit distance: fewest edits, largest weight, first."""
    near = [(d, -w, i) for i, (t, w) in enumerate(terms.items()) if (d := distance(word, t)) <= T.allowed(len(t))]
    return (min(near)[2], min(near)[0]) if near else None


def test_lexicon_finds_what_edit_distance_finds():
    rng = random.Random(4)
    terms = {"".join(rng.choice("abcd") for _ in range(rng.randint(2, 11))): float(rng.randint(1, 3)) for _ in range(40)}
    lex, small = T.Lexicon(terms), T.Automaton(terms, remember=5)
    words = ["".join(rng.choice("abcd") for _ in range(rng.randint(1, 12))) for _ in range(1500)]
    for t in terms:
        i, j = rng.randrange(len(t)), rng.randrange(len(t))
        words += [t, t[:i] + t[i + 1 :], t[:i] + "x" + t[i:], t[:i] + "y" + t[i + 1 :], t[:j] + "x" + t[j:i] + "z" + t[i:]]
    for w in words:
        assert lex[w] == nearest(w, terms) == small.find(w), w


def test_words_of_any_length_cost_no_more_than_the_longest_term():
    lex = T.Lexicon({"idiot": 5.0, "worthless": 4.0, "trash*": 3.0})
    assert lex["trash" + "q" * 1_000_000] == (2, 0) and lex["xtrashq"] is None
    for w in ("q" * 1_000_000, "worthless" * 100_000):
        assert lex[w] is None
    assert len(lex) == 1 and len(lex.automaton.states) < 10
    text = "Q" * 3_000_000 + "+" + "ab1/" * 300_000 + " you idiot " + "z " * 200_000
    (hit,) = T.hits(text.lower(), lex)
    assert hit.word == "idiot" and hit.around[-2:] == ("z", "z")


def plain_hits(low, terms):
    """Hits with their windows, by edit distance to every term, over all words at once."""
    words = list(re.finditer(r"[^\W_]+", low))
    groups, out = [], []
    for i, m in enumerate(words):
        if i and not re.search(r"\s", low[words[i - 1].end() : m.start()]):
            groups[-1].append(i)
        else:
            groups.append([i])
    for g in groups:
        own = [(i, i + 1, h) for i in g if (h := nearest(words[i].group(), terms))]
        if not own and len(g) > 1 and (h := nearest("".join(words[i].group() for i in g), terms)):
            own = [(g[0], g[-1] + 1, h)]
        for a, b, h in own:
            left, right = words[max(0, a - 4) : a], words[b : b + 4]
            opened = low[max(0, left[0].start() - 1 if left else words[a].start() - 1) : words[a].start()]
            closed = low[words[b - 1].end() : (right[-1] if right else words[b - 1]).end() + 1]
            out.append((*h, tuple(m.group() for m in left + right), any(q in opened for q in T.QUOTES) and any(q in closed for q in T.QUOTES)))
    return out


def test_hits_equal_those_of_plain_search(monkeypatch):
    rng = random.Random(6)
    terms = {"idiot": 5.0, "worthless": 4.0, "scum": 3.0, "tr": 2.0}
    for most in (1 << 16, 40):
        monkeypatch.setattr(T._pieces, "__defaults__", (most,))
        for _ in range(150):
            words = [rng.choice(["idiot", "idiut", "id!ot", "s_c_u_m", "w.orthles", "wrthles", "tr", "trx", '"', "said", "house", "the", "a-b", "«idiot»", "scum,idiot", "…"]) for _ in range(rng.randint(0, 40))]
            low = "".join(w + rng.choice([" ", " ", "\n", ", "]) for w in words)
            assert [(h.term, h.edits, h.around, h.marked) for h in T.hits(low, T.Lexicon(terms))] == plain_hits(low, terms)


def test_quotation_is_told_from_abuse():
    lex, context = T.Lexicon({"idiot": 5.0}), dict.fromkeys(T.REPORTING, T.REPORTED)
    abuse, quote, said, folded = (T.features(t, lex, context) for t in ("you are an idiot today", 'the note "idiot" was there', "he called idiot names", "you id!ot"))
    assert abuse[2] > 0.6 and abuse[6] < 0.1 and folded[3] > 0.6
    assert quote[2] < 0.1 and quote[6] > 0.6 and said[2] < 0.2 and said[6] > 0.6


def corpus(spark):
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(600):
        toxic = i % 4 == 0
        words = [rng.choice("the of and to in is house river table green walks".split()) for _ in range(rng.randint(5, 60))]
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(["moronic", "moronic", "scumbag"])
        rows.append((i, " ".join(words), "en", "0"))
        labels.append((i, int(toxic), 1))
    rows += [(900, None, None, None), (901, "", "en", None), (902, "such a scumbxg", "en", None), (902, "green table", "en", None), (None, "house", "en", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score string"), spark.createDataFrame([*labels, (None, 1, 1), (5, None, 0)], "doc_id long, toxic int, quality int")


def test_scores(spark):
    docs, labels = corpus(spark)
    got = T.toxicity(docs, labels).collect()
    assert len(got) == 605
    by = {r.id: r for r in got if r.id is not None and r.id < 900}
    assert all(by[i].predicted == (i % 4 == 0) for i in by)
    empty = [r.score for r in got if r.id in (900, 901)]
    assert empty[0] == empty[1] < 0.5
    assert max(r.score for r in got if r.id == 902) > 0.5 > min(r.score for r in got if r.id == 902)


def test_held_out_labels_and_ids_do_not_matter(spark):
    docs, labels = corpus(spark)
    flipped = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 = 0 THEN 1 - toxic ELSE toxic END AS toxic", "quality")
    key = lambda df: [r.score for r in df.orderBy("id", "score").collect()]
    assert key(T.toxicity(docs, labels)) == pytest.approx(key(T.toxicity(docs, flipped)))


def test_empty_tables(spark):
    docs, labels = corpus(spark)
    assert T.toxicity(docs.where("false"), labels).collect() == []
    assert {r.predicted for r in T.toxicity(docs.limit(5), labels.where("false")).collect()} <= {0, 1}


def test_a_phrase_that_always_follows_one_word_is_learned(spark):
    rng = random.Random(7)
    prose = lambda n: " ".join("".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 9))) for _ in range(n))
    rows = [(i, f"{prose(rng.randint(8, 30))} you moronic {prose(rng.randint(8, 30))}" if i % 4 == 0 else prose(40)) for i in range(1000)]
    copy = prose(30)
    rows += [(1000 + i, f"{copy} {prose(1)}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0 or i >= 1000)) for i, _ in rows], "doc_id long, toxic int")
    got = T.learn(docs, labels)
    assert set(got.terms) == {"moronic", "you"}  # and no word of the text that many copies hold
    by = {r.id: r.predicted for r in T.toxicity(docs, labels).collect() if r.id < 1000}
    assert sum(by[i] for i in range(0, 1000, 4)) >= 238 and not any(by[i] for i in by if i % 4)


def test_contexts_and_benign_forms_are_learned(spark):
    rng = random.Random(8)
    prose = lambda n: " ".join("".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 9))) for _ in range(n))
    rows = []
    for i in range(3000):
        middle = "loud moronic" if i % 10 == 0 else "glossary entry moronic" if i % 30 == 1 else "moronik" if i % 7 == 2 else "table"
        rows.append((i, f"{prose(9)} {middle} {prose(9)}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 10 == 0)) for i, _ in rows], "doc_id long, toxic int")
    got = T.learn(docs, labels)
    assert "moronic" in got.terms and got.benign == {"moronik"}
    assert got.context["glossary"] < -3 and got.context["entry"] < -3 < 3 < got.context["loud"]
    by = {r.id: r.predicted for r in T.toxicity(docs, labels).collect()}
    assert by == {i: int(i % 10 == 0) for i in by}


def test_a_stem_with_more_evidence_than_its_words_stands_for_them():
    found = {"réeuxa": (30.0, 4.0), "réeuxb": (25.0, 4.0), "réeux*": (90.0, 4.5), "réeu*": (88.0, 4.4), "moron": (80.0, 5.0), "moro*": (80.0, 5.0), "moronic": (40.0, 5.0)}
    assert T._chosen(found) == {"réeux*": 4.5, "moron": 5.0, "moronic": 5.0}
    lex = T.Lexicon({"réeux*": 4.5, "moron": 5.0})
    assert lex["réeuxzz"] == (1, 0) and lex["réeux"] == (1, 0) and lex["réeu"] is None and lex["moran"] == (0, 1)
